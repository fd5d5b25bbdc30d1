"""Licence scan by sentence rules.

A text is cut into sentences, each sentence is normalised and looked up in a table of known
licence sentences, and the identifiers found, in order, are matched against rules:
sequences of identifiers that together state one licence. The table is looked up by the
whole normalised sentence; only where a licence text leaves room for a name, a year or a
number does a sentence have a gap, and then its beginning finds it.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentaria.llm.common import table

# Names by which licences are referred to, as in public licence lists, and how notices spell them.
NAMES = {
    "MIT": ("MIT", "MIT License", "Expat License"),
    "ISC": ("ISC", "ISC License"),
    "0BSD": ("0BSD", "Zero-Clause BSD"),
    "Apache-2.0": ("Apache-2.0", "Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"),
    "BSD-2-Clause": ("BSD-2-Clause", "BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD-3-Clause", "BSD 3-Clause License", "New BSD License", "Modified BSD License"),
    "GPL-2.0-only": ("GPL-2.0-only", "GPL-2.0", "GNU General Public License, version 2", "GNU GPL v2", "GPLv2"),
    "GPL-2.0-or-later": ("GPL-2.0-or-later", "GPL-2.0+", "GNU General Public License, version 2 or later", "GNU General Public License, version 2 or any later version"),
    "GPL-3.0-only": ("GPL-3.0-only", "GPL-3.0", "GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL v3", "GPLv3"),
    "GPL-3.0-or-later": ("GPL-3.0-or-later", "GPL-3.0+", "GNU General Public License, version 3 or later", "GNU General Public License, version 3 or any later version"),
    "LGPL-2.1-only": ("LGPL-2.1-only", "LGPL-2.1", "GNU Lesser General Public License, version 2.1"),
    "LGPL-2.1-or-later": ("LGPL-2.1-or-later", "LGPL-2.1+", "GNU Lesser General Public License, version 2.1 or later"),
    "LGPL-3.0-only": ("LGPL-3.0-only", "LGPL-3.0", "GNU Lesser General Public License, version 3"),
    "AGPL-3.0-only": ("AGPL-3.0-only", "AGPL-3.0", "GNU Affero General Public License, version 3"),
    "AGPL-3.0-or-later": ("AGPL-3.0-or-later", "AGPL-3.0+", "GNU Affero General Public License, version 3 or later"),
    "MPL-2.0": ("MPL-2.0", "Mozilla Public License, version 2.0", "Mozilla Public License 2.0"),
    "EPL-1.0": ("EPL-1.0", "Eclipse Public License, version 1.0", "Eclipse Public License 1.0"),
    "EPL-2.0": ("EPL-2.0", "Eclipse Public License, version 2.0", "Eclipse Public License 2.0"),
    "CDDL-1.0": ("CDDL-1.0", "Common Development and Distribution License 1.0"),
    "BSL-1.0": ("BSL-1.0", "Boost Software License, Version 1.0", "Boost Software License 1.0"),
    "Zlib": ("Zlib", "zlib License"),
    "Unlicense": ("Unlicense", "The Unlicense"),
    "WTFPL": ("WTFPL", "Do What The Fuck You Want To Public License"),
    "CC0-1.0": ("CC0-1.0", "CC0", "CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal"),
    "OFL-1.1": ("OFL-1.1", "SIL Open Font License, Version 1.1", "SIL Open Font License 1.1"),
    "Artistic-2.0": ("Artistic-2.0", "Artistic License 2.0"),
    "PSF-2.0": ("PSF-2.0", "Python Software Foundation License 2.0"),
}
# The Creative Commons licences from their parts.
for _parts, _words in {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}.items():
    for _version in ("2.0", "2.5", "3.0", "4.0"):
        _own = f"CC {_parts} {_version}", f"CC-{_parts}-{_version}", f"Creative Commons {_words} {_version}"
        NAMES[f"CC-{_parts}-{_version}"] = (*_own, *(f"{name} {tail}" for name in (_own[0], _own[2]) for tail in ("International", "Unported")))

# How a notice names a licence; {} is the name.
PHRASES = (
    "{}", "{} license", "SPDX-License-Identifier: {}", "License: {}", "Licensed under {}", "Licensed under the {}", "Licensed under the {} license",
    "Licensed under a {} license", "Released under the {}", "Released under the {} license", "Released under {}", "Distributed under the {}",
    "Distributed under the {} license", "Distributed under the terms of the {}", "Available under the {}", "Available under the {} license",
    "This {what} is licensed under {}", "This {what} is licensed under the {}", "This {what} is licensed under the {} license",
    "This {what} is licensed under a {} license", "This {what} is licensed under the terms of the {}", "This {what} is licensed under the terms of the {} license",
    "This {what} is released under {}", "This {what} is distributed under {}", "This {what} is available under {}", "This {what} is released under the {}", "This {what} is released under the {} license", "This {what} is distributed under the {}",
    "This {what} is available under the {}", "Use of this source code is governed by a {} license", "Subject to the terms of the {}",
)
WORKS = ("work", "text", "document", "file", "project", "software", "program", "code", "content", "package", "library", "dataset", "article", "page")

# Sentences of standard licence texts and notices; a star is room for a name, a year or a number.
SENTENCES = {
    "copyright": ("Copyright * All rights reserved", "Copyright * all rights reserved", "(c) * All rights reserved"),
    "all-rights": ("All rights reserved", "All rights are reserved"),
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    ),
    "mit-notice": (
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
        "The above copyright notice and this permission notice (including the next paragraph) shall be included in all copies or substantial portions of the Software",
    ),
    "mit-warranty": (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    ),
    "mit-liability": (
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
    ),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    ),
    "0bsd-grant": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",),
    "isc-warranty": (
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS",
    ),
    "bsd-grant": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",),
    "bsd-source": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    ),
    "bsd-binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    ),
    "bsd-endorse": (
        "Neither the name of * may be used to endorse or promote products derived from this software without specific prior written permission",
        "3. Neither the name of * may be used to endorse or promote products derived from this software without specific prior written permission",
    ),
    "bsd-warranty": (
        "THIS SOFTWARE IS PROVIDED BY * \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED",
    ),
    "apache-name": (
        "Licensed under the Apache License, Version 2.0 (the \"License\")",
        "The * licenses this file to you under the Apache License, Version 2.0 (the \"License\")",
    ),
    "apache-comply": ("you may not use this file except in compliance with the License",),
    "apache-obtain": ("You may obtain a copy of the License at", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0"),
    "apache-unless": (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    ),
    "gpl-warranty": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    ),
    "gpl-copy": ("You should have received a copy of the GNU * Public License along with this *",),
    "mpl-subject": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",),
    "mpl-copy": ("If a copy of the MPL was not distributed with this file, You can obtain one at *",),
    "epl-1": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution *",),
    "epl-2": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at *",),
    "boost-grant": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following",
    ),
    "zlib-provided": ("This software is provided 'as-is', without any express or implied warranty",),
    "zlib-grant": (
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
    ),
    "unlicense": ("This is free and unencumbered software released into the public domain",),
    "unlicense-grant": (
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means",
    ),
    "wtfpl": ("Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed",),
    "cc0-waiver": (
        "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of their rights to the work worldwide under copyright law *",
        "To the extent possible under law, * has waived all copyright and related or neighboring rights to *",
    ),
    "public-domain": ("This {what} is in the public domain", "This {what} is released into the public domain", "Released into the public domain", "This {what} has been placed in the public domain"),
}
# The grants of the GNU licences from their parts.
_GNU = {"GPL": "", "LGPL": "Lesser ", "AGPL": "Affero "}
for _short, _kind in _GNU.items():
    SENTENCES[f"{_short}-any"] = tuple(
        f"{_start}redistribute it and/or modify it under the terms of the GNU {_kind}General Public License as published by the Free Software Foundation"
        for _start in ("This program is free software: you can ", "This program is free software; you can ", "This library is free software; you can ", "You can ")
    )
    for _version in {"GPL": ("2", "3"), "LGPL": ("2.1", "3"), "AGPL": ("3",)}[_short]:
        _head = f"redistribute it and/or modify it under the terms of the GNU {_kind}General Public License as published by the Free Software Foundation"
        for _start in ("This program is free software: you can ", "This program is free software; you can ", "This library is free software; you can ", "You can "):
            _later = f"{_start}{_head}, either version {_version} of the License, or (at your option) any later version"
            SENTENCES.setdefault(f"{_short}-{_version}-later", ())
            SENTENCES[f"{_short}-{_version}-later"] += (_later, _later.replace(", either version", "; either version"))
            SENTENCES.setdefault(f"{_short}-{_version}-only", ())
            SENTENCES[f"{_short}-{_version}-only"] += (f"{_start}{_head}, version {_version} of the License", f"{_start}{_head}, version {_version}", f"{_start}{_head}; version {_version} of the License")


@dataclass(frozen=True)
class Rule:
    """Sentence identifiers in the order they must come, with at most ``gap`` other sentences between two.

    ``covers`` are sentences beside a match, at most ``gap`` away, that then state nothing of their own.
    """

    licence: str
    sequence: tuple[str, ...]
    gap: int = 0
    covers: tuple[str, ...] = ()


_NOTICES = ("copyright", "all-rights")
# Which sentences, in which order, state which licence. Longer rules come before
# the shorter ones that they contain; a sentence used by one rule is not used again.
RULES = (
    Rule("MIT", ("mit-grant", "mit-notice", "mit-warranty"), 1, (*_NOTICES, "name:MIT", "mit-liability")),
    Rule("MIT", ("mit-grant", "mit-notice"), 1, (*_NOTICES, "name:MIT")),
    Rule("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-warranty"), 1, (*_NOTICES, "name:BSD-3-Clause")),
    Rule("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-warranty"), 1, (*_NOTICES, "name:BSD-2-Clause")),
    Rule("ISC", ("isc-grant",), 1, (*_NOTICES, "name:ISC", "isc-warranty")),
    Rule("0BSD", ("0bsd-grant",), 1, (*_NOTICES, "name:0BSD", "isc-warranty")),
    Rule("Apache-2.0", ("apache-name", "apache-comply", "apache-obtain", "apache-unless"), 1, (*_NOTICES, "name:Apache-2.0")),
    Rule("Apache-2.0", ("apache-name",), 1, (*_NOTICES, "apache-comply", "apache-obtain", "apache-unless")),
    *(
        Rule(f"{short}-{version}{'' if '.' in version else '.0'}-{'or-later' if end == 'later' else 'only'}", (f"{short}-{version}-{end}",), 1, (*_NOTICES, "gpl-warranty", "gpl-copy"))
        for short, versions in {"GPL": ("2", "3"), "LGPL": ("2.1", "3"), "AGPL": ("3",)}.items() for version in versions for end in ("later", "only")
    ),
    *(Rule(f"{short}-any", (f"{short}-any",), 1, (*_NOTICES, "gpl-warranty", "gpl-copy")) for short in ("GPL", "LGPL", "AGPL")),
    Rule("MPL-2.0", ("mpl-subject",), 1, (*_NOTICES, "mpl-copy")),
    Rule("EPL-1.0", ("epl-1",), 1, _NOTICES),
    Rule("EPL-2.0", ("epl-2",), 1, _NOTICES),
    Rule("BSL-1.0", ("boost-grant",), 1, (*_NOTICES, "name:BSL-1.0")),
    Rule("Zlib", ("zlib-provided", "zlib-grant"), 2, (*_NOTICES, "name:Zlib")),
    Rule("Unlicense", ("unlicense", "unlicense-grant"), 0, ("name:Unlicense",)),
    Rule("Unlicense", ("unlicense",)),
    Rule("WTFPL", ("wtfpl",), 2, ("name:WTFPL", *_NOTICES)),
    Rule("CC0-1.0", ("cc0-waiver",), 1, ("name:CC0-1.0",)),
    Rule("Public-Domain", ("public-domain",)),
    *(Rule(licence, (f"name:{licence}",), 1, _NOTICES) for licence in NAMES),
    Rule("Proprietary", ("all-rights",)),
    Rule("Proprietary", ("copyright",)),
)

_WORD = re.compile(r"[^\W_]+")
# A sentence ends at a line break, or at a mark before white space; a full stop inside a number does not end it.
_END = re.compile(r"[.!?;:]\s+|[\n\r]\s*")
_MARKS = ".!?;:"
#: Words of the longest known sentence with room for a name.
_ROOM = 24


def normalise(sentence: str) -> str:
    """Lower-case words and numbers with single spaces, the one spelling of licence that British and American texts share."""
    return " ".join("license" if w == "licence" else w for w in _WORD.findall(sentence.lower()))


def _every_sentence() -> Iterator[tuple[str, str]]:
    for name, sentences in SENTENCES.items():
        for sentence in sentences:
            for what in WORKS if "{what}" in sentence else ("",):
                yield name, sentence.replace("{what}", what)
    for licence, spellings in NAMES.items():
        for spelling in spellings:
            for phrase in PHRASES:
                if "{what}" not in phrase:
                    # a bare name must be the licence's full title, or words of a text would do
                    if phrase != "{}" or "icense" in spelling:
                        yield f"name:{licence}", phrase.replace("{}", spelling)
                else:
                    for what in WORKS:
                        yield f"name:{licence}", phrase.replace("{what}", what).replace("{}", spelling)


def _tables() -> tuple[dict[str, str], dict[str, list[tuple[re.Pattern, str, str]]]]:
    """Identifiers by whole normalised sentence, and patterns of those with room, and words they hold, by their first fixed word."""
    whole: dict[str, str] = {}
    roomy: dict[str, list[tuple[re.Pattern, str, str]]] = {}
    for name, sentence in _every_sentence():
        if "*" not in sentence:
            whole.setdefault(normalise(sentence), name)
            continue
        parts = [normalise(part) for part in sentence.split("*")]
        room = rf"(?:\S+ ){{1,{_ROOM}}}"
        pattern = "".join(re.escape(p) + (" " if p else "") + (room if i < len(parts) - 1 else "") for i, p in enumerate(parts))
        roomy.setdefault(parts[0].split(" ")[0], []).append((re.compile(pattern.strip() + r"\Z"), name, [p for p in parts if p][-1]))
    return whole, roomy


WHOLE, _ROOMY = _tables()
#: First words of all known sentences, and these in order.
_FIRST = {s.split(" ")[0] for s in WHOLE} | set(_ROOMY)
_SORTED = sorted(WHOLE)
#: Words of the longest sentence with room, by its first word.
_ROOMY_WORDS: dict[str, int] = {}
for _, _sentence in _every_sentence():
    if "*" in _sentence:
        _words = normalise(_sentence).split(" ")
        _ROOMY_WORDS[_words[0]] = max(_ROOMY_WORDS.get(_words[0], 0), len(_words) + _ROOM * _sentence.count("*"))


def identify(sentence: str) -> str | None:
    """Identifier of a normalised sentence, or None."""
    found = WHOLE.get(sentence)
    if found or not sentence:
        return found
    for pattern, name, held in _ROOMY.get(sentence.split(" ", 1)[0], ()):
        if held in sentence and (pattern.match(f"{sentence} ") or pattern.match(sentence)):
            return name
    return None


def _goes_on(words: str) -> bool:
    """Whether a known sentence may begin with these words and have more."""
    begin = f"{words} "
    at = bisect_left(_SORTED, begin)
    if at < len(_SORTED) and _SORTED[at].startswith(begin):
        return True
    return words.count(" ") + 1 < _ROOMY_WORDS.get(words.split(" ", 1)[0], 0)


def _has_mark_last(text: str, low: int, high: int) -> bool:
    """Whether a mark comes after the last word of ``text[low:high]``."""
    for at in range(high - 1, low - 1, -1):
        if text[at] in _MARKS:
            return True
        if text[at].isalnum() or text[at] == "_":
            return False
    return False


def sentence_ids(text: str | None) -> list[tuple[int, str]]:
    """``(sentence number, identifier)`` of the known sentences of a text, in order.

    Every text is cut. Licence texts are wrapped over lines: a line that may begin a known
    sentence is also tried together with the lines after it, as long as a known sentence
    goes on with them, and the longest one is taken. A line break ends a sentence in the
    numbers only after a mark or at a blank line.
    """
    if not text:
        return []
    text = text.lower()
    # begin, end and first word of each part; words are joined only where a known sentence may begin
    parts, number, breaks, at = [], [0], [], 0
    for end in _END.finditer(text):
        word = _WORD.search(text, at, end.start())
        parts.append((at, end.start(), word.group() if word else ""))
        blank = end.group().count("\n") > 1
        breaks.append(blank)
        marked = word and (blank or end.group()[0] in _MARKS or _has_mark_last(text, at, end.start()))
        number.append(number[-1] + bool(marked))
        at = end.end()
    word = _WORD.search(text, at)
    parts.append((at, len(text), word.group() if word else ""))
    breaks.append(True)
    out, skip = [], 0
    for i, (_, _, first) in enumerate(parts):
        if i < skip or ("license" if first == "licence" else first) not in _FIRST:
            continue
        best, joined = None, ""
        for j in range(i, len(parts)):
            begin, end, first = parts[j]
            if first:
                joined = f"{joined} {normalise(text[begin:end])}".strip()
                if found := identify(joined):
                    best = found, j
            if breaks[j] or not _goes_on(joined):
                break
        if best:
            out.append((number[i], best[0]))
            skip = best[1] + 1
    return out


def match_rules(found: list[tuple[int, str]]) -> list[tuple[str, int]]:
    """``(licence, first sentence)`` of every rule that fits, in the order of the text.

    Rules are tried in their order; each takes its sentences, and those it covers, away from later rules.
    """
    left = list(found)
    out = []
    for rule in RULES:
        at, size = 0, len(rule.sequence)
        while at + size <= len(left):
            part = left[at : at + size]
            near = all(b[0] - a[0] <= 1 + rule.gap for a, b in zip(part, part[1:]))
            if not near or tuple(name for _, name in part) != rule.sequence:
                at += 1
                continue
            out.append((rule.licence, part[0][0]))
            low, high = at, at + size
            # notices beside the match belong to it
            while low > 0 and left[low - 1][1] in rule.covers and left[low][0] - left[low - 1][0] <= 1 + rule.gap:
                low -= 1
            while high < len(left) and left[high][1] in rule.covers and left[high][0] - left[high - 1][0] <= 1 + rule.gap:
                high += 1
            del left[low:high]
            at = low
    return sorted(out, key=lambda x: (x[1], x[0]))


RESULT = "doc_id bigint, n_licence_sentences int, sentence_ids string, licences string, n_statements int"


def scan(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: what licence sentences and licences its text states.

    ``sentence_ids`` and ``licences`` are comma-joined, identifiers in the order of the text,
    licences sorted without repeats; both are empty where nothing is found, as for null and
    empty texts. ``n_statements`` counts matched rules. Whole texts are read row by row
    without a shuffle; null and repeated ids are rows like any other, and other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sentence_ids(t.as_py()) for t in batch.column(1)]
            stated = [match_rules(f) for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(f) for f in found], pa.int32()),
                    pa.array([",".join(name for _, name in f) for f in found], pa.string()),
                    pa.array([",".join(sorted({name for name, _ in s})) for s in stated], pa.string()),
                    pa.array([len(s) for s in stated], pa.int32()),
                ],
                names=[c.strip().split(" ")[0] for c in RESULT.split(",")],
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, RESULT)


def op4_sentence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
