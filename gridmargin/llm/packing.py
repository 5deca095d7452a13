"""Packing by power-of-two decomposition.

A document of n tokens is cut into full sequences and then into pieces of falling powers of
two, the binary digits of the rest. Every piece is a sequence of its own: pieces of equal
length form a bucket to draw batches from, no sequence crosses documents, none needs padding.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmargin.llm.common import table

# The split pattern of the word tokenizer.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
# Characters for which the pattern is known to act alike here and in the tokenizer.
_PLAIN = re.compile(r"[!-~À-ɏ]+")
END_ID = 1
_CACHED = 800_000
_encoders: dict[str, "WordEncoder"] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_characters() -> str:
    """Printable stand-ins of the 256 bytes in byte-level BPE, built by its rule."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return "".join(chr(b if b in shown else next(hidden)) for b in range(256))


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordEncoder:
    """Token ids of texts, by way of a bounded cache of words.

    The tokenizer never joins anything over white space, so the ids of a text are those of
    its words in turn. Plain words go straight to the tokenizer's BPE model; whatever holds
    other characters or a special token passes the whole tokenizer.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.shown = dict(enumerate(_byte_characters()))
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            shown = part.encode().decode("latin-1").translate(self.shown)
            ids = self.parts[part] = _packed([t.id for t in self.model.tokenize(shown)])
        return ids

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        if _PLAIN.fullmatch(text) and "<|" not in text:
            lower = text.lower()  # what the tokenizer's normaliser does to these characters
            if lower.isalpha():
                return self._part(lower)
            return b"".join(map(self._part, PIECES.findall(lower)))
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        words = (text or "").encode().split()
        if len(self.words) > _CACHED:
            self.words.clear()
        if len(self.parts) > _CACHED // 2:
            self.parts.clear()
        for word in set(words).difference(self.words):
            self.words[word] = self._word(word)
        return b"".join(map(self.words.__getitem__, words))


def encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker; its cache outlives a task."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def binary_lengths(n: int, longest: int) -> list[int]:
    """Lengths of the pieces of n tokens: full ones, then falling powers of two."""
    rest = n % longest
    return [longest] * (n // longest) + [
        1 << bit for bit in reversed(range(longest.bit_length() - 1)) if rest >> bit & 1
    ]


def pack_power_of_two(docs: DataFrame, tokenizer: str, longest: int = 2048) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text), one row and one sequence each.

    Columns: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens,
    sequence_id, offset (always 0) and bucket (log2 of the length). Every document ends with
    id 1, so a null or empty text is one piece of one token. A null doc_id and repeated rows
    are packed like any others; other columns are ignored. ``longest`` is a power of two.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        end = np.array([END_ID], "<u4").tobytes()
        ids_of = encoder(tokenizer)
        for batch in batches:
            rows, size = [], 0
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = ids_of.encode(text) + end
                start, total = 0, len(ids) // 4
                for length in binary_lengths(total, longest):
                    rows.append((doc_id, start, length, ids[4 * start : 4 * (start + length)], total))
                    start += length
                size += len(ids)
                if size > 1 << 23:
                    yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})
                    rows, size = [], 0
            if rows:
                yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    names = ["doc_id", "start", "length", "ids", "doc_tokens"]
    pieces = docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(
        cut, "doc_id long, start long, length long, ids binary, doc_tokens long"
    )
    return pieces.select(
        "*",
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        F.log2("length").cast("int").alias("bucket"),
    )


def op7_pack_power_of_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut and packed into sequences of at most 2048 tokens."""
    pieces = pack_power_of_two(table(spark, sf_dir, "documents"), default_tokenizer())
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )
