"""Packing by power-of-two decomposition.

A document's tokens are cut into pieces whose lengths are the powers of two of its length
in binary, with as many of the longest allowed as fit first. A sequence is one piece, so
none crosses documents and none is padded; equal lengths get neighbouring sequence ids,
which a loader reads as one bucket.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentaria.llm.common import numbered, stored, table

SEQUENCE_TOKENS = 1024
END_OF_TEXT = 0
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
#: Words whose ids a Python worker keeps. More words cost time, never a different result.
KEPT_WORDS = 250_000
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
# A space starts a new word wherever a visible character follows it.
_CUT = re.compile(r" (?=\S)")
_ODD_SPACE = re.compile(r" (?:\s|\Z)")
_BEYOND_LATIN = re.compile("[^\x00-ɏ]")


class WordIds(dict):
    """Ids of ' ' + word as little-endian bytes, computed at the first look.

    The tokenizer never joins a word with what precedes its space, so a text's ids are
    those of its words. Latin words take the rank form of the same vocabulary, which
    gives the same ids faster; a word with any other letter takes the tokenizer itself.
    """

    def __init__(self, folder: str | None = None):
        super().__init__()
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        at = (lambda name: f"{folder}/{name}") if folder else public_tokenizers.path
        self._full = Tokenizer.from_file(at(TOKENIZER))
        self._full.encode_special_tokens = True  # their strings in a text are ordinary text
        with open(at(RANKS), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._quick = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def encode(self, text: str) -> bytes:
        if _BEYOND_LATIN.search(text):
            ids = self._full.encode(text, add_special_tokens=False).ids
        else:
            ids = self._quick.encode_ordinary(text)
        return array("I", ids).tobytes()

    def __missing__(self, word: str) -> bytes:
        found = self.encode(" " + word)
        if len(self) < KEPT_WORDS:
            self[word] = found
        return found

    def of_text(self, text: str) -> bytes:
        words = _CUT.split(text) if _ODD_SPACE.search(text) else text.split(" ")
        first = self.encode(words[0]) if words[0] else b""
        return first + b"".join(map(self.__getitem__, words[1:]))


_WORDS: dict[str | None, WordIds] = {}


def token_ids(text: str | None, folder: str | None = None) -> np.ndarray:
    """Ids of a text as unsigned 32-bit numbers, without the closing id."""
    if folder not in _WORDS:
        _WORDS[folder] = WordIds(folder)
    return np.frombuffer(_WORDS[folder].of_text(text) if text else b"", "<u4")


def piece_lengths(n: int, longest: int = SEQUENCE_TOKENS) -> list[int]:
    """Lengths of the pieces of ``n`` tokens, longest first; all are powers of two."""
    whole, rest = divmod(n, longest)
    powers = [1 << k for k in range(longest.bit_length() - 1, -1, -1) if rest >> k & 1]
    return [longest] * whole + powers


def _batches(folder: str | None, longest: int):
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the sequence length must be a power of two")
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(token_ids(text.as_py(), folder), np.uint32(END_OF_TEXT)).astype("<u4")
                start = 0
                for length in piece_lengths(len(ids), longest):
                    rows.append((doc_id, start, length, zlib.crc32(ids[start : start + length]), len(ids)))
                    start += length
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    return cut


def pack(docs: DataFrame, longest: int = SEQUENCE_TOKENS, tokenizers: str | None = None) -> DataFrame:
    """One row for each piece: its document, place, length, checksum and sequence.

    ``tokenizers`` names a folder with the vocabulary files; the installed ones otherwise.
    A null or empty text is the closing id alone, one piece of length one. Rows with
    null or repeated ids are packed like any other. A very long text is tokenised whole and
    cut; it never leaves its task. Other columns are ignored. Sequence ids have no gaps: all
    pieces of the longest length come first, each length in the order of document and start.
    """
    # stored first: the sampling of the range shuffle below would tokenise everything once more
    pieces = stored(docs.select("doc_id", "text").mapInArrow(_batches(tokenizers, longest), PIECES), "pieces")
    rows, _ = numbered(
        pieces.withColumn("_shorter", -F.col("length")), "_shorter", "doc_id", "start", "ids_crc32",
        name="sequence_id", label="sequences",
    )
    return rows.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        F.lit(0).cast("bigint").alias("offset"),
    )


def op8_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
