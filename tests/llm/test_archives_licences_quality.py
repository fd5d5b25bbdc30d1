"""Archives by round trip, licence rules on small texts, the classifier on a held-out fold, stage order."""

import hashlib
import random
import re
import textwrap

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sentaria.llm import licenses, mil_quality, warc

PAGES = "page_id bigint, url string, html string, digest string"


def test_archive_round_trip(spark, tmp_path):
    long, other = "é" * 700, "x" * 1000
    pages = [(1, "u1", long, "d"), (5, "u5", long, "d"), (3, None, long, "d"), (2, "u2", "short", "d"), (4, "u4", "short", "d")]
    pages += [(6, "u6", None, "d"), (7, "a\r\nb", "", "d"), (8, "u8", other, "d"), (9, "u9", "z" * 600_000, "d"), (5, "u5", long, "d")]
    folder = str(tmp_path / "archives")
    manifest = warc.write_bundles(spark.createDataFrame(pages, PAGES), folder)
    rows = warc.read_frames(manifest, folder).collect()
    got = sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to or 0) for r in rows)
    want = []
    for page_id, _, html, _ in pages:
        data = (html or "").encode()
        revisit = html == long and page_id != 5
        want.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", 5 if revisit else 0))
    assert got == sorted(want)
    found = warc.fetch(spark, manifest, folder, [2, 9]).collect()
    assert sorted((r.page_id, len(r.payload)) for r in found) == [(2, 5), (9, 600_000)]
    nothing = warc.write_bundles(spark.createDataFrame([], PAGES), str(tmp_path / "none"))
    assert warc.read_frames(nothing, str(tmp_path / "none")).collect() == []


def test_licences(spark):
    notice = "All rights reserved."
    texts = [(1, notice), (2, "Some prose.\n" + notice + "\nMore prose."), (3, "Nothing of the kind."), (4, None), (5, ""),
             (6, "prose. " * 20_000 + notice), (1, notice), (None, notice)]
    df = spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id bigint, text string, licences string")
    rows = licenses.scan(df).collect()
    assert sorted((str(r.doc_id), r.licences) for r in rows) == sorted(
        (str(i), "Proprietary" if t and notice in t else "") for i, t in texts
    )
    assert licenses.scan(df.limit(0)).collect() == []


def test_classifier_on_the_held_out_fold(spark):
    rng = random.Random(4)
    words = "the river ran past old mills and quiet fields where people met to talk of weather".split()
    prose = lambda: " ".join(" ".join(rng.choices(words, k=rng.randrange(8, 16))).capitalize() + "." for _ in range(8))
    junk = lambda: " ".join("".join(rng.choices("0123456789#$%&{}|", k=rng.randrange(3, 12))) for _ in range(90))
    docs = [(i, prose() if i % 2 else junk(), "en") for i in range(300)]
    labels = spark.createDataFrame([(i, i % 2) for i, _, _ in docs], "doc_id bigint, quality int")
    df = spark.createDataFrame([*docs, (900, None, "en"), (901, "", "en"), (None, prose(), "en")], "doc_id bigint, text string, words string")
    scored = mil_quality.score_documents(df, mil_quality.train(df, labels)).collect()
    assert len(scored) == 303 and all(0 <= r.score <= 1 for r in scored)
    right = [(r.score >= 0.5) == bool(r.doc_id % 2) for r in scored if r.doc_id is not None and r.doc_id < 300]
    assert sum(right) >= 0.95 * len(right)
    kept = mil_quality.keep_good(df, labels)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in scored if r.score >= 0.5)


def test_stages_are_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "decontamination", "packing"]


# --- licence texts ------------------------------------------------------------

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""
GPL_2 = GPL.replace('software:','software;').replace('version 3','version 2')
GPL_ANY = GPL.replace(', either version 3 of the License, or (at your option) any later version','')
BSD_3 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT DAMAGES."""
BSD_2 = '\n\n'.join(p for p in BSD_3.split('\n\n') if not p.startswith('3.'))
MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"""
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""
NOTICE = "Copyright (c) 2019, Some Author. All rights reserved."
STANDARD = [
    (MIT, "MIT"), ("MIT License\n\nCopyright (c) 2020 A. Author\n\n" + MIT, "MIT"), ("MIT License\n\n" + MIT.split("\n\n")[0], "MIT"),
    ("\n\n".join(MIT.split("\n\n")[:2]), "MIT"), ("This project is licensed under the MIT License.", "MIT"), (ISC, "ISC"),
    (NOTICE + "\n\n" + ISC, "ISC"), (NOTICE + "\n\n" + BSD_2, "BSD-2-Clause"), (NOTICE + "\n\n" + BSD_3, "BSD-3-Clause"), (NOTICE, "Proprietary"),
    (APACHE, "Apache-2.0"), (NOTICE + "\n\n" + APACHE, "Apache-2.0"), ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
    (GPL, "GPL-3.0-or-later"), (GPL_2, "GPL-2.0-or-later"), (GPL.split("\n\n")[0], "GPL-3.0-or-later"), (GPL_ANY, "GPL-any"), (GPL_ANY.split("\n\n")[0], "GPL-any"),
    (GPL.replace("GNU General", "GNU Lesser General").replace("version 3", "version 2.1"), "LGPL-2.1-or-later"),
    (GPL.replace("GNU General", "GNU Affero General"), "AGPL-3.0-or-later"),
    (GPL.replace(", either version 3 of the License, or (at your option) any later version", ", version 2 of the License"), "GPL-2.0-only"),
    (BSD_3, "BSD-3-Clause"), (BSD_2, "BSD-2-Clause"), (MPL, "MPL-2.0"), ("All rights reserved.", "Proprietary"),
    ("This program is licensed under the terms of the GNU General Public License, version 3.", "GPL-3.0-only"),
    ("This program is licensed under the GNU General Public License, version 3 or later.", "GPL-3.0-or-later"),
    ("Released under the GNU General Public License version 2.", "GPL-2.0-only"),
    ("This library is licensed under the GNU Lesser General Public License version 2.1.", "LGPL-2.1-only"),
    ("This program is distributed under the GNU Affero General Public License version 3.", "AGPL-3.0-only"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "CC-BY-4.0"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.", "CC-BY-SA-3.0"),
    ("This work is licensed under CC BY-ND 4.0.", "CC-BY-ND-4.0"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "CC-BY-NC-4.0"),
    ("This work is released under CC0 1.0 Universal.", "CC0-1.0"), ("SPDX-License-Identifier: EPL-2.0", "EPL-2.0"),
    ("SPDX-License-Identifier: BSD-3-Clause", "BSD-3-Clause"), ("Distributed under the Boost Software License, Version 1.0.", "BSL-1.0"),
    (ZLIB, "Zlib"), (UNLICENSE, "Unlicense"), ("This work is released into the public domain.", "Public-Domain"),
]


@pytest.mark.parametrize("text, licence", STANDARD)
@pytest.mark.parametrize("columns, prefix", [(0, ""), (78, ""), (60, " * "), (48, "# ")])
def test_standard_texts_state_their_licence(text, licence, columns, prefix):
    if columns:
        wrapped = "\n\n".join(textwrap.fill(part, columns) for part in text.split("\n\n"))
        text = "\n".join((prefix + line).rstrip() for line in wrapped.split("\n"))
    text = "Some prose comes before.\n\n" + text + "\n\nAnd more of it after."
    assert {name for name, _ in licenses.match_rules(licenses.sentence_ids(text))} == {licence}


def every_pattern():
    for name, known in licenses._every_sentence():
        parts = [re.escape(licenses.normalise(p)) for p in known.split("*")]
        room = r"\S+(?: \S+){0,23}"
        words = [w for k, p in enumerate(parts) for w in ((room, p) if k else (p,)) if w]
        yield name, re.compile(" ".join(words)) if len(parts) > 1 else licenses.normalise(known)


PATTERNS = list(every_pattern())


def slow_identify(sentence):
    """Every known sentence tried, one after another."""
    for name, known in PATTERNS:
        if sentence == known if isinstance(known, str) else known.fullmatch(sentence):
            return name
    return None


def test_identifiers_equal_trying_every_sentence():
    draw = random.Random(3)
    known = [s.replace("*", "of Jo Doe nor others") for _, s in licenses._every_sentence()]
    for sentence in draw.sample(known, 40) + ["All rights", "", "the quick fox", "permission is"]:
        plain = licenses.normalise(sentence)
        assert licenses.identify(plain) == slow_identify(plain)
        words = plain.split(" ")
        at = draw.randrange(len(words))
        # one word more, less or another is no known sentence, unless it stands where a name may
        for other in ([*words[:at], *words[at + 1 :]], [*words[:at], "zebra", *words[at:]], [*words[:at], "zebra", *words[at + 1 :]]):
            changed = " ".join(other)
            assert licenses.identify(changed) == slow_identify(changed)


@pytest.mark.parametrize("text", [
    MIT.replace("free of charge", "for a fee").split("\n\n")[0], APACHE.replace("Apache License", "Apex License").split(".")[0],
    "This project is not licensed under the MIT License.", "The MIT licence is popular.", "Permission is hereby granted to park here.",
    "We redistribute food in the public domain of kindness.", "This work is licensed under the Terms of Service.", "version 3", "MIT", "Some rights reserved.",
])
def test_near_misses_state_nothing(text):
    assert licenses.match_rules(licenses.sentence_ids(text)) == []


@pytest.mark.parametrize("text, licence", [
    ("Old songs of the valley. Released under CC BY 4.0.", "CC-BY-4.0"), ("Released under the WTFPL.", "WTFPL"),
    ("Distributed under the EPL-2.0", "EPL-2.0"), ("This work is in the\npublic\ndomain.", "Public-Domain"),
    # more lines than words fit into fourteen
    (textwrap.fill(MIT, 24), "MIT"), ("\n".join(ISC.split()), "ISC"),
])
def test_every_text_is_cut_and_sentences_go_over_any_number_of_lines(text, licence):
    assert {name for name, _ in licenses.match_rules(licenses.sentence_ids(text))} == {licence}


def test_long_runs_of_spaces_and_marks_take_little_time():
    for text in (" " * 300_000, "!" * 300_000 + "a", ". " * 100_000):
        assert licenses.sentence_ids(text) == []


def test_sentences_too_far_apart_state_nothing():
    grant, notice, _ = MIT.split("\n\n")
    filler = " ".join(f"Other sentence number {i}." for i in range(5))
    assert licenses.match_rules(licenses.sentence_ids(f"{grant}\n\n{filler}\n\n{notice}")) == []


def test_seek_tables_name_every_frame(spark, tmp_path):
    folder = tmp_path / "archives"
    pages = spark.createDataFrame([(i, f"u{i}", f"page {i} " * 500, "d") for i in range(300)] + [(None, None, "no id", "d")], PAGES)
    manifest = warc.write_bundles(pages, str(folder), frame_bytes=20_000)
    frames = {(r.bundle, r.frame, r.frame_offset, r.frame_bytes) for r in manifest.collect()}
    told = set()
    for path in folder.iterdir():
        with path.open("rb") as file:
            told |= {(path.name, k, at, size) for k, (at, size, _) in enumerate(warc.read_seek_table(file, path.stat().st_size))}
    assert told == frames and len(frames) > 20
    assert warc.read_frames(manifest, str(folder)).filter("page_id IS NULL").count() == 1


def test_frames_are_read_by_many_tasks(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"u{i}", f"page {i} " * 500, "d") for i in range(300)], PAGES)
    manifest = warc.write_bundles(pages, str(tmp_path / "a"), frame_bytes=20_000)
    tasks = warc.read_frames(manifest, str(tmp_path / "a")).groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 1
