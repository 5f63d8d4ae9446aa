"""Best-fit packing of tokenised documents into sequences of fixed length.

A document's tokens end with a separator id.  Documents longer than a
sequence are cut into full pieces, the first of which takes the rest and may
be shorter.  Full pieces fill a sequence by themselves.  The others are dealt
at random into groups of about ``GROUP_PIECES`` and packed per group by
best-fit decreasing: pieces in order of falling length, each into the open
sequence with the least room that still holds it.  Room is a number from 0 to
the sequence length, so the open sequences are kept in one stack per room
value and a segment tree over these values finds the smallest room that fits
in logarithmic time.

A group wastes at most its last few sequences, so random groups of thousands
of pieces use few more sequences than packing all pieces together would (up to
0.5 % in simulations, see the README), and no task ever holds more than one group.

Null text counts as empty, and an empty document is its separator alone.
Rows with equal ids, equal rows and null ids are each packed as documents of
their own.  An empty table gives no rows.
"""
from __future__ import annotations

import json
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stage

MAX_TOKENS = 2048
SEPARATOR = 0
#: Pieces packed together by one call of the packer.
GROUP_PIECES = 10_000
#: Distinct words whose ids one Python worker remembers.
CACHE_WORDS = 500_000
#: Texts per worker on which the fast encoder is compared with ``tokenizers``.
PROBE_TEXTS = 4

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_ALONE = re.compile(r"(?<=\S) (?=\S)")


def _byte_alphabet() -> dict[str, int]:
    """Byte-level BPE files write each byte as a printable character: itself
    where it is printable Latin-1, else the next free one from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class WordEncoder:
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    Byte-level BPE never merges across a space that stands alone between two
    other characters, so a text is cut there and each word's ids (with its
    leading space) are remembered.  New words go through ``tiktoken`` with
    the vocabulary read from the ``tokenizers`` file: the same ids, several
    times as fast.  ``probe`` compares both on whole texts.
    """

    def __init__(self, tokenizer_path: str):
        import public_tokenizers
        import tiktoken
        with open(tokenizer_path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec.get("added_tokens", ())}
        back = _byte_alphabet()
        ranks = {bytes(back[c] for c in w): i for w, i in spec["model"]["vocab"].items() if w not in special}
        self._encode = tiktoken.Encoding(
            "words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self._path = tokenizer_path
        self._cache: dict[str, bytes] = {}

    def _ids(self, text: str) -> bytes:
        ids = array("I", self._encode(text))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        parts = text.split(" ")
        if len(parts) > 1 and "" in parts:
            parts = _ALONE.split(text)
        cache = self._cache
        out = [self._ids(parts[0])]
        get = cache.get
        ids = [get(w) for w in parts[1:]]
        if None in ids:
            for i, known in enumerate(ids):
                if known is None:
                    w = parts[i + 1]
                    # white space beside the cut: not a safe cut, so take the text whole
                    if w[0].isspace() or w[-1].isspace():
                        return b"".join(self._ids(" " * bool(j) + p) for j, p in enumerate(_ALONE.split(text)))
                    if (known := get(w)) is None:
                        if len(cache) >= CACHE_WORDS:
                            cache.clear()
                        known = cache[w] = self._ids(" " + w)
                    ids[i] = known
        if parts[0] and parts[0][-1].isspace() and len(parts) > 1:
            return b"".join(self._ids(" " * bool(j) + p) for j, p in enumerate(_ALONE.split(text)))
        return b"".join(out + ids)

    def probe(self, texts: list[str]) -> None:
        import numpy as np
        from tokenizers import Tokenizer
        plain = Tokenizer.from_file(self._path)
        plain.encode_special_tokens = True
        for text in texts:
            want = np.asarray(plain.encode(text, add_special_tokens=False).ids, dtype=np.uint32).tobytes()
            if want != self.encode(text):
                raise ValueError("the word encoder and tokenizers disagree")


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: full pieces of ``size``
    behind a first one that takes the rest."""
    if n <= size:
        return [(0, n)]
    first = n % size or size
    return [(0, first)] + [(s, size) for s in range(first, n, size)]


def tokenised_pieces(docs: DataFrame, tokenizer_path: str, size: int = MAX_TOKENS,
                     with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and, with
    ``with_ids``, the ids as little-endian bytes)."""
    schema = PIECES + (", ids binary" if with_ids else "")
    end = SEPARATOR.to_bytes(4, "little")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, probed = None, False
        for batch in batches:
            encoder = encoder or WordEncoder(tokenizer_path)
            out: list[list] = [[], [], [], [], []] + [[]] * with_ids
            ids_col, texts = batch.column(0).to_pylist(), batch.column(1)
            if not probed:
                encoder.probe([texts[i].as_py() or "" for i in range(min(PROBE_TEXTS, len(texts)))])
                probed = True
            for doc_id, text in zip(ids_col, texts, strict=True):
                ids = encoder.encode(text.as_py() or "") + end
                for k, (start, length) in enumerate(cut(len(ids) // 4, size)):
                    part = ids[4 * start:4 * (start + length)]
                    row = (doc_id, k, start, length, zlib.crc32(part), part)
                    for column, value in zip(out, row, strict=False):
                        column.append(value)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * with_ids
            names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=names)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(encode, schema)


class RoomTree:
    """Segment tree over room values 0..size: how many open sequences have
    each room; finds the smallest value with one at or above a given room."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, room: int, by: int) -> None:
        i = room + self.leaves
        while i:
            self.count[i] += by
            i >>= 1

    def tightest(self, room: int) -> int:
        """The smallest room >= ``room`` that is open, or -1."""
        count, i = self.count, room + self.leaves
        if count[i]:
            return room
        while i > 1:  # climb until a right sibling holds something, then descend to its leftmost
            if not i & 1 and count[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if count[2 * i] else 2 * i + 1
                return i - self.leaves
            i >>= 1
        return -1


def best_fit_decreasing(lengths: list[int], size: int) -> tuple[list[int], list[int]]:
    """(sequence, offset) of each length; sequences are numbered from 0."""
    tree, open_at = RoomTree(size), {}
    sequence, offset, n = [0] * len(lengths), [0] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        need = lengths[i]
        room = tree.tightest(need)
        if room < 0:
            at, room, n = n, size, n + 1
        else:
            at = open_at[room].pop()
            tree.add(room, -1)
        sequence[i], offset[i] = at, size - room
        if left := room - need:
            open_at.setdefault(left, []).append(at)
            tree.add(left, 1)
    return sequence, offset


def pack(pieces: DataFrame, size: int = MAX_TOKENS, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a table of pieces (any table with
    a ``length`` column from 1 to ``size``; ``doc_id`` and ``piece`` only
    spread it).  Sequence ids are unique but not consecutive."""
    pieces = stage(pieces, "pieces")
    groups = max(1, -(-pieces.where(F.col("length") < size).count() // group_pieces))
    full = (pieces.where(F.col("length") >= size)
            .withColumn("sequence_id", -1 - F.monotonically_increasing_id())
            .withColumn("offset", F.lit(0).cast("long")))
    schema = full.schema

    def fit(key: tuple, table: pa.Table) -> pa.Table:
        sequence, offset = best_fit_decreasing(table.column("length").to_pylist(), size)
        first = key[0].as_py() << 32
        return (table.drop_columns(["pack_group"])
                .append_column("sequence_id", pa.array([first + s for s in sequence], pa.int64()))
                .append_column("offset", pa.array(offset, pa.int64())))

    # equal rows would share a hash of their columns, so a running number spreads them
    rest = (pieces.where(F.col("length") < size)
            .withColumn("pack_group", F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()),
                                             F.lit(groups)).cast("long"))
            .groupBy("pack_group").applyInArrow(fit, schema))
    return full.unionByName(rest)


def pack_documents(docs: DataFrame, tokenizer_path: str, size: int = MAX_TOKENS) -> DataFrame:
    """Tokenise, cut and pack ``docs`` (doc_id, text; other columns are
    ignored): doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(tokenised_pieces(docs, tokenizer_path, size), size)
