import hashlib
import random
import re
import zlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from newsgraph.llm import prefix_trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs[c].append((turn is not None, turn or 0, digest(role, text), role, text))
    for turns in convs.values():
        turns.sort()
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        h, base = zlib.crc32(str(c).encode()) % 4, c - (abs(c) % 20) * (1 if c >= 0 else -1)
        turns = [t[3:] for t in convs.get(base, [])[:h]] + [t[3:] for t in turns[h:]]
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, m in members.items():
        own = (len(m) - 1) * (len(WORD.findall(node[-1][1])) if node else 0)
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += own
    key = lambda r: r[:2]
    return sorted(((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), children[n], leaves[n], saved[n],
                    hashlib.sha256(",".join(map(str, sorted(ends.get(n, [])))).encode()).hexdigest())
                   for n, m in members.items()), key=key)


def check(spark, rows, extra=""):
    table = spark.createDataFrame([(*r, *([None] * extra.count(","))) for r in rows],
                                  "conv_id long, turn long, role string, text string" + extra)
    got = sorted(map(tuple, prefix_trie.op12(table).collect()), key=lambda r: r[:2])
    assert got == brute(rows)
    return got


def test_table_equals_brute_force(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    got = sorted(map(tuple, prefix_trie.op12(table).collect()), key=lambda r: r[:2])
    assert got == brute([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])


def test_odd_rows(spark):
    rows = [(0, 0, "user", "a b"), (0, 1, "assistant", "c"), (0, None, None, None), (1, 0, "user", "a b"),
            (1, 0, "user", "a b"), (1, 0, "assistant", ""), (None, 0, "user", "lost"), (2, 3, "user", "x " * 50_000),
            (25, 0, "user", "a b"), (26, 0, "user", "a b"), (27, 0, "use", "ra b"), (-3, 0, "user", "a b"),
            (-3, 1, "user", None), (40, 0, "user", "only one"), (43, 0, "user", "gone"), (-1, 7, "", "")]
    check(spark, rows, ", near long, depth long, k1 long, place long, tokens string, digest string")


def test_empty(spark):
    table = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.op12(table).collect() == []
    assert prefix_trie.op12(spark.createDataFrame([(None, 1, "a", "b")], table.schema)).collect() == []


def test_long_and_alike_conversations(spark):
    rng = random.Random(7)
    rows = [(5, t, "user", f"long {t}") for t in range(700)]
    rows += [(c, t, "user", f"same {t}") for c in range(60, 400) for t in range(3)]
    rows += [(c, t, rng.choice("ab"), rng.choice("xy")) for c in range(1000, 1080) for t in range(rng.randrange(9))]
    check(spark, rows)


def plain_totals(parent, values):
    total = [list(v) for v in values]
    for i in range(len(parent) - 1, -1, -1):
        if parent[i] >= 0:
            total[parent[i]] = [a + b for a, b in zip(total[parent[i]], total[i])]
    return total


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(-1, 30), st.integers(-5, 9)), max_size=40))
def test_centroid_rollup(nodes):
    parent = [p if p < i else -1 for i, (p, _) in enumerate(nodes)]
    values = [(v, 1) for _, v in nodes]
    assert prefix_trie.centroid_rollup(parent, values) == plain_totals(parent, values)


def test_rollup_over_many_pieces(spark):
    rng = random.Random(3)
    rows, known = [], [(0, 0)]
    rows.append((0, 0, None, None, 1, 0))
    for near in range(1, 400):
        up = rng.choice(known[-30:] if near % 3 else known[:3])
        depth = up[1] + 1
        for d in range(depth, depth + rng.randrange(1, 30)):
            rows.append((near, d, *up, rng.randrange(5), 1))
            known.append((near, d))
            up = (near, d)
    rows.append((900, 3, None, None, 4, 1))
    forest = spark.createDataFrame(rows, "near long, depth long, up_near long, up_depth long, a long, b long")
    rows.sort(key=lambda r: r[1])
    at = {r[:2]: i for i, r in enumerate(rows)}
    want = plain_totals([at.get(r[2:4], -1) for r in rows], [r[4:] for r in rows])
    for limits in ({"spread": 8, "band": 4, "piece_nodes": 20}, {"spread": 2, "band": 1 << 20}, {}):
        got = {tuple(r)[:2]: list(r)[2:] for r in prefix_trie.rollup(forest, ["a", "b"], **limits).collect()}
        assert got == {r[:2]: w for r, w in zip(rows, want)}
