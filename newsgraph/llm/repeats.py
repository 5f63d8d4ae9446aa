"""Removal of repeated passages: merged shard Burrows-Wheeler transforms.

A byte goes if some string of ``span`` bytes around it also starts anywhere
else, in the same text or another one; strings never cross texts and are judged
on the input.

**Symbols.**  Of every ``W`` neighbouring places the one with the least hash of
its next ``K`` bytes is an *anchor* (the last one of equals).  Anchors depend on
nearby bytes alone, so equal passages have equal anchors, whatever stands around
them.  From each anchor one *symbol* leads to the first anchor at least ``G``
bytes on: the bytes between.  With 3 W + G + K <= span + 3 the symbol of the
first anchor of any string of ``span`` bytes lies inside the string.

**Shards.**  Texts are dealt into shards of about ``SHARD_BYTES``.  A shard's
transform lists its anchors ordered by what follows them, each with the symbols
that lead to it (several ones may, as the symbols of a text overlap).

**Merging.**  The merged order of all shards is refined by one symbol a round.
It starts as one block; a block of anchors that agree in their next h symbols is
an interval of every shard's order.  Walking through the blocks, each symbol that
leads into a block puts its own anchor into that symbol's block of h + 1 symbols,
in the order met: the shard's next interleave.  No suffix is sorted anew.  The
shards exchange only the names of their blocks, and get back one bit for each:
whether the block holds two anchors or more over all shards.  Blocks of one
anchor leave; the bytes that a staying block agrees in are the common prefix of
its anchors, and a block whose common prefix reaches ``span`` is a *repeated
interval*: its bytes go, and it needs no more rounds.  span / G rounds end it.

**Ends.**  A repeated string may begin and end inside a symbol.  All strings with
the same first anchor have one common name; anchors with a repeated symbol
exchange (symbol, name).  Where a name is repeated, so are all its strings.
Behind a symbol with a name that is not, and whose strings hold a byte that no
repeated interval covers, one anchor of each name sends the names of its single
strings, and those found twice go.  A string that holds a symbol which is not
repeated is left out, exactly.

Every pass makes the shard's state anew from its text and the bits of all earlier
rounds, so nothing but the texts and the bits is kept: the bits take one eighth of
a byte per block.  Texts are written once into a table bucketed by shard; later
passes join the bits to it without moving the texts.  A name is sent once per
shard however often it stands there, so a passage that a third of all texts share
is one name a shard.  Names are 64-bit hashes; the chance that two different
strings among n share one is about n * n / 2 ** 65.

Null text counts as empty; texts shorter than ``span`` keep every byte, equal
texts of ``span`` bytes or more lose all.  A text of any length is one string
(a shard of its own where it is long).  Null and repeated ids and repeated rows
are rows of their own, extra columns are ignored, an empty table gives no rows.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import shared_folder, stage

SPAN = 200
K = 8
SHARD_BYTES = 4 << 20
#: Names that one bucket of the exchange holds, on average.
BUCKET_NAMES = 1 << 18
#: Places worked on at once.
SLICE = 1 << 17

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD2 = np.uint64(0xC2B2AE3D27D4EB4F)
_TIE = np.uint64((1 << 20) - 1)


def _stir(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _ODD
    return (h ^ (h >> np.uint64(29))) * _ODD2


def _mix(h: np.ndarray, x: np.ndarray) -> np.ndarray:
    return _stir((h * _ODD + _ODD2) ^ x)


def _runs(sizes: np.ndarray) -> np.ndarray:
    """0 .. sizes[0]-1, 0 .. sizes[1]-1, ..."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


class Shard:
    """Anchors, symbols and blocks of the texts of one shard."""

    def __init__(self, blob: bytes, ends: np.ndarray, span: int = SPAN):
        self.span, self.ends = span, ends
        self.w = span // 5
        self.g = (span + 3 - K - 3 * self.w) // 8 * 8
        self.n_words = -(-(self.g + self.w - 1) // 16)
        if 8 * self.n_words > self.g:
            raise ValueError("span is too short")
        self.rounds = -(-span // self.g)
        self.size = len(blob)
        padded = blob + bytes(16)
        self.words = np.ndarray((self.size + 8,), "<u8", padded, strides=(1,))
        self._find_anchors()
        self._make_symbols()
        n = len(self.at)
        self.depth = np.zeros(n, np.int64)             # symbols that some other anchor shares
        self.length = np.zeros(n, np.int64)            # their bytes
        self.end = np.arange(n)                        # the anchor behind them
        self.name = np.zeros(n, np.uint64)             # of the block of ``depth`` symbols
        self.live = np.ones(n, bool)                   # below span
        self.order = np.arange(n)                      # of the merged blocks' members here

    def _find_anchors(self) -> None:
        w, span = self.w, self.span
        begins = np.concatenate([[0], self.ends[:-1]])
        last = self.ends - (w + K - 1)                 # of places whose W places lie inside the text
        at, first, until = [], [], []
        for a in range(0, self.size, SLICE):
            b = min(a + SLICE, self.size)
            texts = np.arange(np.searchsorted(self.ends, a, "right"), np.searchsorted(begins, b, "left"))
            lo, hi = np.maximum(begins[texts], a), np.minimum(last[texts] + 1, b)
            texts, lo, hi = texts[hi > lo], lo[hi > lo], hi[hi > lo]
            if not len(texts):
                continue
            top = min(b + w - 1, self.size)
            h = (_stir(self.words[a:top] * _ODD) & ~_TIE) | (_TIE - np.arange(top - a, dtype=np.uint64))
            least, reach = h, 1
            while reach * 2 <= w:
                least, reach = np.minimum(least[:-reach], least[reach:]), reach * 2
            if reach < w and len(least) > w - reach:
                least = np.minimum(least[:reach - w], least[w - reach:])
            place = np.repeat(lo, hi - lo) + _runs(hi - lo)
            best = a + (_TIE - (least[place - a] & _TIE)).astype(np.int64)
            cut = np.flatnonzero(np.diff(best, prepend=-1))
            at.append(best[cut])
            first.append(place[cut])
            until.append(place[np.append(cut[1:], len(best)) - 1])
        at, first, until = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (at, first, until))
        new = np.diff(at, prepend=-1) != 0             # an anchor may go on from one slice into the next
        cut = np.flatnonzero(new)
        self.at, self.first = at[cut], first[cut]
        self.until = until[np.append(cut[1:], len(at))[:len(cut)] - 1] if len(cut) else until[:0]
        self.text = np.searchsorted(self.ends, self.at, "right")
        #: last string of ``span`` bytes that begins with this anchor
        self.until = np.minimum(self.until, self.ends[self.text] - span)

    def _make_symbols(self) -> None:
        n = len(self.at)
        to = np.searchsorted(self.at, self.at + self.g)
        ok = to < n
        ok[ok] = self.text[to[ok]] == self.text[ok]
        self.to = np.where(ok, to, -1)                 # the anchor that the symbol leads to
        self.symbol = np.zeros(n, np.uint64)
        for a in range(0, n, SLICE):
            t = a + np.flatnonzero(ok[a:a + SLICE])
            start, stop = self.at[t], self.at[to[t]]
            h = (stop - start).astype(np.uint64)
            for j in range(self.n_words):
                h = _mix(h, self.words[start + 8 * j])
                h = _mix(h, self.words[stop - 8 * (j + 1)])
            self.symbol[t] = h
        self.has = ok
        # anchors lead to later ones in order, so those that lead to one stand side by side
        leads = np.where(ok, to, n)
        anchors = np.arange(n)
        leads = np.maximum.accumulate(np.where(ok, to, 0)) if n else leads
        self.from_lo = np.searchsorted(leads, anchors, "left")
        self.from_hi = np.searchsorted(leads, anchors, "right")

    def step(self, h: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The interleave refined from h - 1 to h symbols: (anchors in the
        order of their blocks of h symbols, where each block begins, the
        blocks' names, whether a block holds several anchors)."""
        if h == 1:
            t = np.flatnonzero(self.has)
            t = t[np.argsort(self.symbol[t], kind="stable")]
            name = self.symbol[t]
            new = np.diff(name, prepend=name[:1]) != 0
        else:
            # through the blocks of h - 1 symbols in order, taking the symbols that lead to each anchor
            u = self.order
            sizes = self.from_hi[u] - self.from_lo[u]
            t = np.repeat(self.from_lo[u], sizes) + _runs(sizes)
            t = t[self.has[t]]
            block = self.name[self.to[t]]
            t_ok = self.live[t] & (self.depth[t] == h - 1)
            t, block = t[t_ok], block[t_ok]
            by_symbol = np.argsort(self.symbol_rank[t], kind="stable")
            t, block = t[by_symbol], block[by_symbol]
            name = _mix(block, self.symbol[t])
            new = np.diff(name, prepend=name[:1]) != 0
        if len(t):
            new[0] = True
        begin = np.flatnonzero(new)
        return t, begin, name[begin], np.diff(np.append(begin, len(t))) > 1

    def take(self, h: int, t: np.ndarray, begin: np.ndarray, names: np.ndarray, repeated: np.ndarray) -> None:
        """Go on with the blocks that are repeated over all shards."""
        sizes = np.diff(np.append(begin, len(t)))
        stays = np.repeat(repeated, sizes)
        if h == 1:
            self.symbol_rank = np.zeros(len(self.at), np.int64)
            self.symbol_rank[t] = np.repeat(np.arange(len(begin)), sizes)
        name = np.repeat(names, sizes)[stays]
        t = t[stays]
        after = self.to[t]
        length = self.at[after] - self.at[t] + (self.length[after] if h > 1 else 0)
        end = self.end[after] if h > 1 else after
        self.depth[t], self.length[t], self.end[t], self.name[t] = h, length, end, name
        self.order = t
        self.live[t[length >= self.span]] = False

    def covered(self) -> np.ndarray:
        """Which bytes lie in repeated intervals."""
        change = np.zeros(self.size + 1, np.int32)
        t = np.flatnonzero(self.length >= self.span)
        np.add.at(change, self.at[t], 1)
        np.add.at(change, self.at[t] + self.length[t], -1)
        return np.cumsum(change[:-1]) > 0

    def heads(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For the anchors that begin strings of ``span`` bytes and have a
        repeated symbol: (anchor, name of all its strings together, whether
        they hold a byte that is not covered)."""
        t = np.flatnonzero((self.depth > 0) & (self.until >= self.first))
        start, stop = self.first[t], self.until[t] + self.span
        h = _mix((self.at[t] - start).astype(np.uint64), (stop - start).astype(np.uint64))
        for j in range(-(-self.span // 8)):
            h = _mix(h, self.words[np.minimum(start + 8 * j, start + self.span - 8)])
        for j in range(-(-self.w // 8)):
            h = _mix(h, self.words[stop - 8 * (j + 1)])
        missing = np.concatenate([[0], np.cumsum(~self.covered())])
        return t, h, missing[stop] > missing[start]

    def pairs(self) -> tuple[np.ndarray, ...]:
        """The different (symbol, name) of ``heads``, sorted: (symbol, name,
        whether several anchors have it, whether one of them is open, the first
        of them), and for every anchor of ``heads`` the number of its pair."""
        t, h, is_open = self.heads()
        s = self.symbol[t]
        order = np.lexsort((h, s))
        new = np.ones(len(t), bool)
        new[1:] = (np.diff(s[order]) != 0) | (np.diff(h[order]) != 0)
        begin = np.flatnonzero(new)
        sizes = np.diff(np.append(begin, len(t)))
        first = order[begin]
        some_open = np.logical_or.reduceat(is_open[order], begin) if len(t) else is_open
        number = np.zeros(len(t), np.int64)
        number[order] = np.repeat(np.arange(len(begin)), sizes)
        return s[first], h[first], sizes > 1, some_open, t[first], t, number

    def strings(self, t: np.ndarray) -> np.ndarray:
        """Starts of the strings of ``span`` bytes whose first anchor is in
        ``t``, but for those that hold a symbol no other anchor shares."""
        # below span, the symbols up to the one behind the repeated ones are not shared
        beyond = self.to[self.end[t]]
        fence = np.where(self.live[t] & (beyond >= 0), self.at[beyond] - (self.span - self.w - K + 1), self.size)
        sizes = np.maximum(np.minimum(self.until[t] + 1, fence) - self.first[t], 0)
        return np.repeat(self.first[t], sizes) + _runs(sizes)

    def string_names(self, p: np.ndarray) -> np.ndarray:
        out = np.zeros(len(p), np.uint64)
        for a in range(0, len(p), SLICE):
            q = p[a:a + SLICE]
            h = np.full(len(q), self.span, np.uint64)
            for j in range(0, self.span - 7, 8):
                h = _mix(h, self.words[q + j])
            if self.span % 8:
                h = _mix(h, self.words[q + self.span - 8])
            out[a:a + SLICE] = h
        return out

    def replay(self, told: dict[int, np.ndarray]) -> None:
        """Bring the blocks to where the bits of all earlier rounds leave them."""
        self.told = told
        for h in sorted(told):
            if h <= self.rounds:
                t, begin, names, _ = self.step(h)
                bits = np.zeros(len(names), bool)
                bits[np.argsort(names, kind="stable")] = told[h]
                self.take(h, t, begin, names, bits)

    def ask(self, h: int) -> tuple[np.ndarray, np.ndarray]:
        """Names to be compared in round h (a refinement, or the strings),
        sorted, and which of them this shard holds several times itself."""
        if h <= self.rounds:
            _, _, names, many = self.step(h)
            order = np.argsort(names, kind="stable")
            return names[order], many[order]
        names, counts = np.unique(self.string_names(self.strings(self.pairs()[4][self.told[self.rounds + 2]])),
                                  return_counts=True)
        return names, counts > 1

    def removed(self) -> np.ndarray:
        """Which bytes go, after all rounds."""
        mask = self.covered()
        if self.rounds + 1 not in self.told:
            return mask
        *_, first, t, number = self.pairs()
        change = np.zeros(self.size + 1, np.int32)
        t = t[self.told[self.rounds + 1][number]]      # all strings of these anchors stand elsewhere too
        np.add.at(change, self.first[t], 1)
        np.add.at(change, self.until[t] + self.span, -1)
        if (bits := self.told.get(self.rounds + 3)) is not None:
            p = self.strings(first[self.told[self.rounds + 2]])
            _, which = np.unique(self.string_names(p), return_inverse=True)
            p = p[bits[which]]
            np.add.at(change, p, 1)
            np.add.at(change, p + self.span, -1)
        return mask | (np.cumsum(change[:-1]) > 0)


def shards(docs: DataFrame, span: int = SPAN, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The texts in shards, one row each, in a table bucketed by shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, texts, size = TaskContext.get().partitionId() << 33, [], [], 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([size], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([[len(x) for x in texts]], pa.list_(pa.int64())), pa.array([b"".join(texts)], pa.binary())],
                names=["shard", "size", "ids", "sizes", "blob"])

        for batch in batches:
            for i, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py() or b""
                if ids and size + len(text) > shard_bytes:
                    yield row()
                    number, ids, texts, size = number + 1, [], [], 0
                ids.append(i.as_py())
                texts.append(text)
                size += len(text)
        if ids:
            yield row()

    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").cast("binary").alias("text"))
    table = slim.mapInArrow(run, "shard long, size long, ids array<long>, sizes array<long>, blob binary")
    name = f"shards_{uuid.uuid4().hex}"
    (table.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "shard")
     .option("path", f"{shared_folder(spark)}/{name}").format("parquet").saveAsTable(name))
    return spark.table(name)


def _told(rows: list[dict] | None) -> dict[int, np.ndarray]:
    """Round -> bits, in the order of the names."""
    parts: dict[int, list] = {}
    for r in sorted(rows or [], key=lambda r: (r["round"], r["bucket"])):
        bits = np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=r["n"]).astype(bool)
        parts.setdefault(r["round"], []).append(bits)
    return {h: np.concatenate(x) for h, x in parts.items()}


def _with_bits(table: DataFrame, bits: DataFrame | None) -> DataFrame:
    if bits is None:
        return table.withColumn("told", F.lit(None).cast("array<struct<round:int,bucket:long,n:long,bits:binary>>"))
    told = bits.groupBy("shard").agg(F.collect_list(F.struct("round", "bucket", "n", "bits")).alias("told"))
    return table.join(told, "shard", "left")


def _ends(sizes: list[int]) -> np.ndarray:
    return np.cumsum(np.array(sizes, np.int64))


def _bits(x: np.ndarray) -> bytes:
    return np.packbits(x).tobytes()


def _flags(column: pa.ChunkedArray, sizes: list[int]) -> np.ndarray:
    return np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n).astype(bool)
                           for x, n in zip(column.to_pylist(), sizes)])


def _names(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u8") for x in column.to_pylist()]


def _groups(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    begin = np.flatnonzero(new)
    return begin, np.diff(np.append(begin, len(new)))


def merge_blocks(names: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Which names are there twice or more."""
    order = np.argsort(names, kind="stable")
    begin, sizes = _groups(np.diff(names[order], prepend=~names[order][:1]) != 0)
    out = np.zeros(len(names), bool)
    out[order] = np.repeat((sizes > 1) | np.logical_or.reduceat(many[order], begin), sizes)
    return out


def merge_pairs(symbols: np.ndarray, names: np.ndarray, many: np.ndarray,
                is_open: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs are there twice or more, and which one of each is to send
    its strings."""
    order = np.lexsort((names, symbols))
    s, x = symbols[order], names[order]
    new_s = np.diff(s, prepend=~s[:1]) != 0
    new = new_s | (np.diff(x, prepend=~x[:1]) != 0)
    begin, sizes = _groups(new)
    twice = (sizes > 1) | np.logical_or.reduceat(many[order], begin)
    lone = np.repeat(~twice & np.logical_or.reduceat(is_open[order], begin), sizes)
    begin_s, sizes_s = _groups(new_s)
    repeated, send = np.zeros(len(s), bool), np.zeros(len(s), bool)
    repeated[order] = np.repeat(twice, sizes)
    send[order] = new & np.repeat(np.logical_or.reduceat(lone, begin_s), sizes_s)
    return repeated, send


def exchange(table: DataFrame, bits: DataFrame | None, h: int, n_buckets: int, span: int) -> DataFrame:
    """Round h: (shard, round, bucket, n, bits) for the names of every shard.

    Rounds 1 .. R refine the interleave; round R + 1 compares the pairs of the
    ends and answers with the bits of two rounds; round R + 3 the strings."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, sizes, blob, told in zip(*batch.columns):
                s = Shard(blob.as_py(), _ends(sizes.as_py()), span)
                known = _told(told.as_py())
                before = {s.rounds + 1: 1, s.rounds + 3: s.rounds + 2}.get(h, h - 1)
                if before and before not in known:
                    continue                            # the round before left nothing
                s.replay(known)
                if h == s.rounds + 1:
                    key, name, many, is_open, *_ = s.pairs()
                else:
                    (key, many), name, is_open = s.ask(h), np.zeros(0, np.uint64), np.zeros(0, bool)
                bucket = ((key >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)
                cut = np.flatnonzero(np.diff(bucket.astype(np.int64), prepend=-1))
                part = [slice(a, b) for a, b in zip(cut, np.append(cut[1:], len(key)))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard.as_py()] * len(cut), pa.int64()), pa.array(bucket[cut].astype(np.int64)),
                     pa.array([key[p].astype("<u8").tobytes() for p in part], pa.binary()),
                     pa.array([name[p].astype("<u8").tobytes() for p in part], pa.binary()),
                     pa.array([_bits(many[p]) for p in part], pa.binary()),
                     pa.array([_bits(is_open[p]) for p in part], pa.binary())],
                    names=["shard", "bucket", "keys", "names", "many", "open"])

    def merge(group: pa.Table) -> pa.Table:
        """The shards' blocks of this bucket, merged."""
        keys = _names(group.column("keys"))
        sizes = [len(k) for k in keys]
        many = _flags(group.column("many"), sizes)
        if group.column("names")[0].as_py():
            answers = merge_pairs(np.concatenate(keys), np.concatenate(_names(group.column("names"))), many,
                                  _flags(group.column("open"), sizes))
        else:
            answers = (merge_blocks(np.concatenate(keys), many),)
        cuts = np.cumsum(sizes)[:-1]
        tables = [pa.table({
            "shard": group.column("shard"), "round": pa.array([h + i] * len(sizes), pa.int32()),
            "bucket": group.column("bucket"), "n": pa.array(sizes, pa.int64()),
            "bits": pa.array([_bits(x) for x in np.split(answer, cuts)], pa.binary())})
            for i, answer in enumerate(answers)]
        return pa.concat_tables(tables)

    asked = _with_bits(table.select("shard", "sizes", "blob"), bits).mapInArrow(
        ask, "shard long, bucket long, keys binary, names binary, many binary, open binary")
    return asked.groupBy("bucket").applyInArrow(merge, "shard long, round int, bucket long, n long, bits binary")


def remove_repeats(docs: DataFrame, span: int = SPAN, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_bytes, ``spans`` (start and length in bytes of the maximal
    removed runs) and ``kept`` (the bytes that stay) of every document."""
    table = shards(docs, span, shard_bytes)
    size = table.agg(F.sum("size")).first()[0] or 0
    sample = Shard(b"", np.zeros(0, np.int64), span)
    n_buckets = max(1, round(2 * size / (sample.w + 1) / BUCKET_NAMES))
    bits = None
    for h in [*range(1, sample.rounds + 2), sample.rounds + 3]:
        new = stage(exchange(table, bits, h, n_buckets, span), f"repeats-{h}")
        bits = new if bits is None else bits.unionByName(new)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, sizes, blob, told in zip(*batch.columns):
                blob, sizes = blob.as_py(), sizes.as_py()
                ends = _ends(sizes)
                shard = Shard(blob, ends, span)
                shard.replay(_told(told.as_py()))
                gone = shard.removed()
                data, kept, spans = np.frombuffer(blob, np.uint8), [], []
                for a, b in zip((ends - np.array(sizes, np.int64)).tolist(), ends.tolist()):
                    mask = gone[a:b]
                    if not mask.any():
                        kept.append(blob[a:b])
                        spans.append([])
                        continue
                    edge = np.flatnonzero(np.diff(mask.view(np.int8), prepend=0, append=0))
                    kept.append(data[a:b][~mask].tobytes())
                    spans.append([{"start": x, "length": y - x}
                                  for x, y in zip(edge[::2].tolist(), edge[1::2].tolist())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids.as_py(), pa.int64()), pa.array(sizes, pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
                     pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])

    return _with_bits(table.select("shard", "ids", "sizes", "blob"), bits).select(
        "ids", "sizes", "blob", "told").mapInArrow(
        cut, "doc_id long, n_bytes long, spans array<struct<start: bigint, length: bigint>>, kept binary")


def op13(docs: DataFrame) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"])
    return remove_repeats(docs).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))
