import hashlib
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from newsgraph.llm import order_minhash as om

MASK, PLACE = 2**64 - 1, (1 << 24) - 1


def h_text(s, seed=42):
    return xxhash.xxh64_intdigest(s.encode(), seed)


def h_long(v, seed):
    return xxhash.xxh64_intdigest(struct.pack("<Q", v & MASK), seed)


def signed(v):
    return v - 2**64 if v >= 2**63 else v


def brute(text):
    """Order MinHash over numbered word pairs, straight from its definition."""
    ws = []
    for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" "):
        ws += [w[i:i + 64] for i in range(0, len(w), 64)]
    seen, pairs = {}, []
    for i, w in enumerate(ws):
        k = (h_text(ws[i + 1], h_text(w)) if i + 1 < len(ws) else h_text(w)) >> 24
        n = seen[k] = seen.get(k, -1) + 1
        k = signed(k << 24) >> 24
        # Spark hashes an int as four bytes
        value = k if n == 0 else signed(xxhash.xxh64_intdigest(struct.pack("<i", n), h_long(k, 42))) >> 24
        pairs.append((value, i))
    slices = {}
    for value, i in sorted(pairs):
        slices.setdefault((value & (2**40 - 1)) >> 35, []).append((value, i))
    out = []
    for s in sorted(slices, key=lambda s: s if s < 16 else s - 32):
        acc = 42
        for value, _ in sorted(slices[s][:2], key=lambda x: x[1]):
            acc = h_long(value, acc)
        out.append(f"{s:02X}{acc >> 24:010X}")
    return ",".join(out)


def test_fingerprints_equal_brute_force(docs, odd_docs):
    for table in (docs, odd_docs):
        for r in table.select("text", om.fingerprint(F.col("text")).alias("f")).collect():
            assert r["f"] == brute(r["text"])


def neighbours(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    return {r: rows[(i + 1) % len(rows)] for i, r in enumerate(rows)}


@pytest.mark.parametrize("range_rows", [3, 40, 10**6])
def test_edited_texts_equal_brute_force(docs, odd_docs, monkeypatch, range_rows):
    monkeypatch.setattr(om, "RANGE_ROWS", range_rows)
    for table in (docs, odd_docs):
        after = neighbours([(r["doc_id"], r["text"] or "") for r in table.collect()])
        want = []
        for (doc_id, text), (_, following) in ((k, v) for k, v in after.items()):
            cut = len(text) // 3
            edited = text[:len(text) - cut] + following[:cut]
            want.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()))
        got = {(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in om.op10(table).collect()}
        assert got >= set(want) if table is odd_docs else got == set(want)


def test_likeness_orders_edits(docs):
    got = om.op10(docs).collect()
    assert len(got) == docs.count()
    long = [r for r in got if r["n_chars"] >= 400]
    assert sum(r["near_edited"] for r in long) / len(long) > 0.4
    assert sum(r["near_next"] for r in long) / len(long) < 0.1
    assert all(0 <= r[c] <= 1 for r in got for c in ("near_edited", "near_next"))


def test_order_matters(spark):
    text = " ".join(f"w{i}" for i in range(200))
    turned = " ".join([*(f"w{i}" for i in range(100, 200)), *(f"w{i}" for i in range(100))])
    row = spark.createDataFrame([(text, turned)], "a string, b string").select(
        om.likeness(om.fingerprint(F.col("a")), om.fingerprint(F.col("a"))),
        om.likeness(om.fingerprint(F.col("a")), om.fingerprint(F.col("b")))).first()
    assert row[0] == 1.0 and row[1] < 0.9


def test_one_row_and_no_rows(spark, no_docs):
    one = om.op10(spark.createDataFrame([(1, "abc def")], "doc_id long, text string")).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abc dab").hexdigest()
    assert om.op10(no_docs).collect() == []
