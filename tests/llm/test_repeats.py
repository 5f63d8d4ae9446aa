import hashlib
import random
from collections import Counter

import pytest

from newsgraph.llm import repeats


def brute(texts, span):
    """(n_bytes, n_removed, n_spans, digest) of every text."""
    seen = Counter(t[p:p + span] for t in texts for p in range(len(t) - span + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for p in range(len(t) - span + 1):
            if seen[t[p:p + span]] > 1:
                gone[p:p + span] = [True] * span
        n_spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), n_spans, hashlib.sha256(kept).hexdigest()))
    return out


def in_rounds(texts, span, per_shard):
    """The rounds without Spark, over shards of ``per_shard`` texts."""
    np = repeats.np
    parts = [texts[i:i + per_shard] for i in range(0, len(texts), per_shard)]
    told = [{} for _ in parts]

    def state(i):
        s = repeats.Shard(b"".join(parts[i]), repeats._ends([len(t) for t in parts[i]]), span)
        s.replay(told[i])
        return s

    def share(h, answers, sizes):
        for n, answer in enumerate(answers):
            for t, bits in zip(told, np.split(answer, np.cumsum(sizes)[:-1])):
                t[h + n] = bits

    rounds = repeats.Shard(b"", np.zeros(0, np.int64), span).rounds
    for h in [*range(1, rounds + 2), rounds + 3]:
        if h == rounds + 1:
            asked = [state(i).pairs()[:4] for i in range(len(parts))]
            answers = repeats.merge_pairs(*(np.concatenate(x) for x in zip(*asked)))
        else:
            asked = [state(i).ask(h) for i in range(len(parts))]
            answers = (repeats.merge_blocks(*(np.concatenate(x) for x in zip(*asked))),)
        share(h, answers, [len(x[0]) for x in asked])
    out = []
    for i, part in enumerate(parts):
        gone, a = state(i).removed(), 0
        for t in part:
            mask = gone[a:a + len(t)]
            edges = np.diff(mask.view(np.int8), prepend=0)
            kept = np.frombuffer(t, np.uint8)[~mask].tobytes()
            out.append((len(t), int(mask.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()))
            a += len(t)
    return out


def passages(rng, alphabet, n, copies):
    """Random texts with copied, cut and edited pieces of each other."""
    made = []
    for _ in range(n):
        t = bytearray(rng.choices(alphabet, k=rng.randrange(0, 500)))
        for _ in range(rng.randrange(copies)):
            if made:
                src = rng.choice(made)
                a = rng.randrange(len(src) + 1)
                at = rng.randrange(len(t) + 1)
                t[at:at] = src[a:a + rng.randrange(20, 400)]
        if t and rng.random() < 0.3:
            t[rng.randrange(len(t))] = rng.choice(alphabet)
        made.append(bytes(t))
    return made


@pytest.mark.parametrize("seed", range(12))
@pytest.mark.parametrize("alphabet", [b"ab", b"a", b"abcdefgh ", bytes(range(256))])
def test_rounds_equal_brute_force(seed, alphabet):
    rng = random.Random(seed)
    texts = passages(rng, alphabet, 25, 4)
    if seed % 3 == 0:
        texts += [b"period 7" * 60, b"xyz" * 100, b"", texts[0], texts[1] + b"!", b"period 7" * 31]
    span = rng.choice([80, 100, 117, 200])
    assert in_rounds(texts, span, rng.choice([1, 4, 100])) == brute(texts, span)


def test_slices_do_not_matter():
    texts = passages(random.Random(5), b"abc ", 30, 4)
    old, repeats.SLICE = repeats.SLICE, 61
    try:
        assert in_rounds(texts, 80, 7) == brute(texts, 80)
    finally:
        repeats.SLICE = old


def check(docs, span=repeats.SPAN, shard_bytes=repeats.SHARD_BYTES):
    rows = docs.select("doc_id", "text").collect()
    want = sorted((str(r["doc_id"]), *w) for r, w in zip(rows, brute([(r["text"] or "").encode() for r in rows], span)))
    out = repeats.remove_repeats(docs, span, shard_bytes).collect()
    got = sorted((str(r["doc_id"]), r["n_bytes"], sum(s["length"] for s in r["spans"]), len(r["spans"]),
                  hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in out)
    assert got == want
    return out


def test_table_equals_brute_force(docs):
    check(docs)
    out = check(docs, span=96, shard_bytes=20_000)
    text = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    for r in out:                                       # spans and kept bytes make up the text
        at, kept = 0, b""
        for s in r["spans"]:
            kept += text[r["doc_id"]][at:s["start"]]
            at = s["start"] + s["length"]
        assert kept + text[r["doc_id"]][at:] == bytes(r["kept"])


def test_query_digests(docs):
    rows = docs.select("doc_id", "text").collect()
    want = {r["doc_id"]: w for r, w in zip(rows, brute([(r["text"] or "").encode() for r in rows], 200))}
    assert {r["doc_id"]: tuple(r)[1:] for r in repeats.op13(docs).collect()} == want


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs)
    check(odd_docs, shard_bytes=1000)
    assert repeats.op13(no_docs).collect() == []


def test_too_short_a_span(docs):
    with pytest.raises(ValueError):
        repeats.remove_repeats(docs, span=30)
