"""Prefix trie of conversations, rolled up by centroid decomposition.

A node stands for one sequence of the first d turns; the conversations that
begin with it are its members.  A node is named by its smallest member and its
depth, so the trie is a table of parent edges (``near``, ``depth``) ->
(``up_near``, ``up_depth``).

**Sequences.**  A turn's place and SHA-256 digest give two 64-bit hashes; a
sequence's key is the exclusive or of its turns' hashes (128 bits), which a
running window yields.  Conversations may be of any length: rows are range
partitioned by conversation and place, each range is summed by itself, and what
earlier ranges hold of a conversation that spans several is added (one row a
range).

**Rollup.**  The forest is cut into pieces of neighbouring nodes (``SPREAD``
conversations by ``BAND`` depths), and every piece is one group.  Within a piece
each component is split at its *centroid*, the node whose removal leaves parts of
at most half the size: the total of the centroid's side is added along the path
from the centroid to the component's top, and the parts are split in turn, so a
node is in at most log2(piece) components, however deep the tree.  Components
that hang on the same outer node are drawn together into one node of a smaller
forest, whose totals are found the same way (pieces ``WIDER`` times as wide), and are
then added where they hang before the pieces' own rollup.  A wide piece with more
than ``PIECE_NODES`` nodes is dealt out by the outer node; only once pieces are
``WIDEST`` (then one piece holds all) may they hold more, twice as many a level, so
that any forest ends.

Digests of member lists are made of sorted ranges: each range joins its ids, and
a node's digest reads them one after the other, keeping nothing but its state.

Turns are ordered by ``turn`` (null first), equal turns by the digest of role and
text.  Null role or text counts as empty.  Rows without a ``conv_id`` belong to no
conversation and make no node.  Repeated rows are turns of their own, extra
columns are ignored.  Without conversations the trie is empty, root included.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stage, words

#: Conversations that share their first turns are dealt in blocks of this size.
BLOCK = 20
#: So many kinds of shared beginnings: 0 .. HEADS - 1 turns.
HEADS = 4
SPREAD, BAND = 256, 64
PIECE_NODES = 1 << 15
WIDER = 64
WIDEST = 1 << 40

_NODE = ["near", "depth"]


# --- sequences -------------------------------------------------------------

def running(rows: DataFrame, key: str, order: list[str], sums: dict[str, tuple[str, Column]], name: str) -> DataFrame:
    """Add running totals within ``key`` along ``order`` (``out``: ("sum" or
    "xor", column)).  No key's rows need to fit into one task."""
    ranged = rows.repartitionByRange(key, *order).withColumn("_range", F.spark_partition_id())
    rows = stage(ranged, name)
    add = {"sum": F.sum, "xor": F.bit_xor}
    here = Window.partitionBy("_range", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    totals = rows.groupBy("_range", key).agg(*[add[how](c).alias(f"_{out}") for out, (how, c) in sums.items()])
    # only keys that lie in several ranges: at most two a range
    whole = Window.partitionBy(key)
    before = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = (totals.withColumn("_n", F.count("*").over(whole)).where("_n > 1")
               .select("_range", key, *[add[how](f"_{out}").over(before).alias(f"_{out}")
                                        for out, (how, _) in sums.items()]))
    out = rows.withColumns({out: add[how](c).over(here) for out, (how, c) in sums.items()})
    out = out.join(F.broadcast(carried), ["_range", key], "left")
    zero = F.lit(0).cast("long")
    plus = {"sum": lambda a, b: a + b, "xor": lambda a, b: a.bitwiseXOR(b)}
    return out.withColumns({o: plus[how](F.col(o), F.coalesce(F.col(f"_{o}"), zero))
                            for o, (how, _) in sums.items()}).drop("_range", *[f"_{o}" for o in sums])


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, digest of role and text, words in the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    return (conversations.where("conv_id is not null")
            .select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                    digest.alias("digest"), F.size(words(text)).cast("long").alias("tokens")))


def share_heads(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that share beginnings: each one starts with up to h turns
    of its block's first conversation.  Returns (conv_id, n_turns), one row a
    conversation, and (conv_id, place, digest, tokens), places from 1."""
    own = stage(running(turns, "conv_id", ["turn", "digest"], {"place": ("sum", F.lit(1).cast("long"))},
                        "trie-turns"), "trie-places")
    c = F.col("conv_id")
    sizes = own.groupBy("conv_id").agg(F.count("*").alias("n_own"))
    convs = sizes.select("conv_id", "n_own", (c - c % BLOCK).alias("base"),
                         (F.crc32(c.cast("string").cast("binary")) % HEADS).alias("h"))
    # of a base, only whether it has 0 .. HEADS - 1 turns matters
    bases = sizes.select(c.alias("base"), F.least("n_own", F.lit(HEADS - 1)).alias("n_base"))
    convs = stage(convs.join(bases, "base", "left").select(
        "conv_id", "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("taken"), "n_own"), "trie-convs")
    n_turns = F.col("taken") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))
    tail = (own.join(convs.select("conv_id", "h", "taken"), "conv_id").where(F.col("place") > F.col("h"))
            .select("conv_id", (F.col("taken") + F.col("place") - F.col("h")).alias("place"), "digest", "tokens"))
    head = (own.where(F.col("place") < HEADS).select(c.alias("base"), "place", "digest", "tokens")
            .join(convs.select("conv_id", "base", "h"), "base").where(F.col("place") <= F.col("h"))
            .select("conv_id", "place", "digest", "tokens"))
    return convs.select("conv_id", n_turns.alias("n_turns")), tail.unionByName(head)


def trie(convs: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes below the root and the end of every conversation that has a
    turn: (k1, k2, depth, near, up_near, n_convs, tokens) and (conv_id, k1, k2,
    depth)."""
    hashes = {f"h{i}": F.xxhash64(F.lit(i), "place", "digest") for i in (1, 2)}
    rows = running(turns.withColumns(hashes), "conv_id", ["place"],
                   {"k1": ("xor", F.col("h1")), "k2": ("xor", F.col("h2"))}, "trie-sequences")
    rows = stage(rows.select("conv_id", F.col("place").alias("depth"), "k1", "k2", "h1", "h2", "tokens"), "trie-rows")
    up = {f"p{i}": F.col(f"k{i}").bitwiseXOR(F.col(f"h{i}")) for i in (1, 2)}
    nodes = rows.withColumns(up).groupBy("depth", "k1", "k2").agg(
        F.min("conv_id").alias("near"), F.count("*").alias("n_convs"), F.min("tokens").alias("tokens"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"))
    nodes = stage(nodes, "trie-nodes")
    first = convs.agg(F.min("conv_id").alias("near"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                           F.col("near").alias("up_near"))
    deep = nodes.where("depth > 1").join(parents, ["depth", "p1", "p2"])
    top = nodes.where("depth = 1").withColumn("up_near", first.scalar())
    nodes = stage(deep.unionByName(top).drop("p1", "p2"), "trie-edges")
    ends = rows.join(convs.withColumnRenamed("n_turns", "depth"), ["conv_id", "depth"]).select(
        "conv_id", "depth", "k1", "k2")
    return nodes, ends


def end_digests(ends: DataFrame) -> DataFrame:
    """(k1, k2, depth, ends_sha256): of the ids that end at each node."""
    key = ["depth", "k1", "k2"]
    ranged = ends.repartitionByRange(*key, "conv_id").withColumn("_range", F.spark_partition_id())
    ranged = stage(ranged, "trie-ends")
    joined = ranged.groupBy("_range", *key).agg(F.array_join(F.transform(
        F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",").alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def row():
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in (*now, state.hexdigest())],
                                              names=[*key, "ends_sha256"])

        for batch in batches:
            for *node, ids in zip(*(batch.column(n).to_pylist() for n in (*key, "ids"))):
                if node == now:
                    state.update(b",")
                else:
                    if now is not None:
                        yield row()
                    now, state = node, hashlib.sha256()
                state.update(ids.encode())
        if now is not None:
            yield row()

    return (joined.repartition(*key).sortWithinPartitions(*key, "_range").select(*key, "ids")
            .mapInArrow(digest, "depth long, k1 long, k2 long, ends_sha256 string"))


# --- rollup ----------------------------------------------------------------

def centroid_rollup(parent: list[int], values: list[tuple[int, ...]]) -> list[list[int]]:
    """Totals over each node's subtree.  ``parent[i]`` is -1 or less than i."""
    n, width = len(parent), len(values[0]) if values else 0
    total = [[0] * width for _ in range(n)]
    within = [0] * n                                     # the component that a node is in
    children: list[list[int]] = [[] for _ in range(n)]
    tops: dict[int, list[int]] = {}
    top_of = list(range(n))
    for i, p in enumerate(parent):
        if p >= 0:
            children[p].append(i)
            top_of[i] = top_of[p]
        tops.setdefault(top_of[i], []).append(i)
    todo, made, size = list(tops.values()), 0, [0] * n
    while todo:
        part = todo.pop()                                # parents before children
        made += 1
        for i in part:
            within[i], size[i] = made, 1
        for i in reversed(part[1:]):
            size[parent[i]] += size[i]
        top = z = part[0]
        while True:                                      # to the centroid
            heavy = next((c for c in children[z] if within[c] == made and 2 * size[c] > len(part)), None)
            if heavy is None:
                break
            z = heavy
        # the centroid's side: itself and the parts below it, one for each child
        side: dict[int, list[int]] = {c: [] for c in children[z] if within[c] == made}
        piece_of = {z: None}
        above = []
        for i in part:
            if i == z:
                continue
            if (p := parent[i]) == z and i != top:
                piece_of[i] = i
            elif i != top and p in piece_of:
                piece_of[i] = piece_of[p]
            else:
                above.append(i)
                continue
            side[piece_of[i]].append(i)
        sums = [sum(values[i][k] for i in piece_of) for k in range(width)]
        i = z
        while True:                                      # along the path from the centroid to the top
            for k in range(width):
                total[i][k] += sums[k]
            if i == top:
                break
            i = parent[i]
        todo.extend(x for x in side.values() if x)
        if above:
            todo.append(above)
    return total


def _tree(group: pa.Table) -> tuple[list[int], list[int], list[int], list[tuple[int, int]]]:
    """Rows of a piece by depth: (row numbers, parents' positions or -1,
    positions of their tops, outer nodes)."""
    near, depth, up_near, up_depth = (group.column(c).to_pylist() for c in (*_NODE, "up_near", "up_depth"))
    order = sorted(range(len(near)), key=lambda i: depth[i])
    at = {(near[i], depth[i]): j for j, i in enumerate(order)}
    outer = [(up_near[i], up_depth[i]) for i in order]
    parent = [at.get(x, -1) if x[0] is not None else -1 for x in outer]
    top = list(range(len(order)))
    for j, p in enumerate(parent):
        if p >= 0:
            top[j] = top[p]
    return order, parent, top, outer


def _components(group: pa.Table) -> pa.Table:
    """Every node with the node that its component becomes: the first top of
    those that hang on the same outer node."""
    order, _, top, outer = _tree(group)
    near, depth = group.column("near").to_pylist(), group.column("depth").to_pylist()
    name: dict[tuple, tuple] = {}
    for j, t in enumerate(top):
        if j == t:
            name.setdefault(outer[t], (near[order[t]], depth[order[t]]))
    inner = [outer[t] for t in top]
    rows = [(near[i], depth[i], *name[o], *o) for i, o in zip(order, inner)]
    names = ["near", "depth", "c_near", "c_depth", "o_near", "o_depth"]
    return pa.table({n: pa.array([r[k] for r in rows], pa.int64()) for k, n in enumerate(names)})


def rollup(forest: DataFrame, measures: list[str], spread: int = SPREAD, band: int = BAND,
           piece_nodes: int = PIECE_NODES) -> DataFrame:
    """(near, depth, measures): each measure summed over the node's subtree.

    ``forest``: near, depth (long; together a node's name, a parent's depth is
    the smaller one), up_near, up_depth (the parent's name, null at a top) and
    the measures (long)."""
    forest = stage(forest.select(*_NODE, "up_near", "up_depth", *measures), "trie-forest")
    cut = lambda c, n: F.floor(F.col(c) / n) if n < WIDEST else F.lit(0).cast("long")
    region = [cut("near", spread).alias("_piece_near"), cut("depth", band).alias("_piece_depth")]
    sizes = (forest.groupBy(*region).agg(F.ceil(F.count("*") / piece_nodes).alias("_k")))
    many = sizes.where("_k > 1")
    # a region with too many nodes is dealt out by the outer node
    pieces = (forest.withColumns({"_piece_near": region[0], "_piece_depth": region[1]}).join(many, ["_piece_near", "_piece_depth"], "left")
              .withColumn("_piece_part", F.pmod(F.xxhash64("up_near", "up_depth"), F.coalesce("_k", F.lit(1)))).drop("_k"))
    pieces = stage(pieces, "trie-pieces")
    parts = stage(pieces.groupBy("_piece_near", "_piece_depth", "_piece_part").applyInArrow(
        _components, "near long, depth long, c_near long, c_depth long, o_near long, o_depth long"), "trie-parts")
    hanging = parts.where("o_near is not null")
    extra = None
    if not hanging.isEmpty():
        named = parts.join(forest.select(*_NODE, *measures), _NODE)
        sums = named.groupBy("c_near", "c_depth", "o_near", "o_depth").agg(*[F.sum(m).alias(m) for m in measures])
        sums = stage(sums, "trie-sums")
        holds = parts.select(F.col("near").alias("o_near"), F.col("depth").alias("o_depth"),
                             F.col("c_near").alias("up_near"), F.col("c_depth").alias("up_depth"))
        smaller = sums.join(holds, ["o_near", "o_depth"], "left").select(
            F.col("c_near").alias("near"), F.col("c_depth").alias("depth"), "up_near", "up_depth", *measures)
        below = rollup(smaller, measures, min(spread * WIDER, WIDEST), min(band * WIDER, WIDEST),
                       piece_nodes * (1 + (spread >= WIDEST)))
        extra = (sums.select("c_near", "c_depth", "o_near", "o_depth").where("o_near is not null")
                 .join(below.withColumnsRenamed({"near": "c_near", "depth": "c_depth"}), ["c_near", "c_depth"])
                 .groupBy(F.col("o_near").alias("near"), F.col("o_depth").alias("depth"))
                 .agg(*[F.sum(m).alias(f"_{m}") for m in measures]))

    def totals(group: pa.Table) -> pa.Table:
        order, parent, _, _ = _tree(group)
        columns = [group.column(m).to_pylist() for m in measures]
        found = centroid_rollup(parent, [tuple(c[i] for c in columns) for i in order])
        out = {n: pa.array([group.column(n)[i].as_py() for i in order], pa.int64()) for n in _NODE}
        return pa.table(out | {m: pa.array([x[k] for x in found], pa.int64()) for k, m in enumerate(measures)})

    if extra is not None:
        pieces = pieces.join(extra, _NODE, "left").withColumns(
            {m: F.col(m) + F.coalesce(F.col(f"_{m}"), F.lit(0)) for m in measures}).drop(*[f"_{m}" for m in measures])
    rolled = pieces.groupBy("_piece_near", "_piece_depth", "_piece_part").applyInArrow(
        totals, "near long, depth long, " + ", ".join(f"{m} long" for m in measures))
    return stage(rolled, "trie-totals")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of ``conversations`` with shared beginnings: one row per node."""
    convs, turns = share_heads(turns_of(conversations))
    convs = stage(convs, "trie-sizes")
    nodes, ends = trie(convs, turns)
    key = ["depth", "k1", "k2"]
    nodes = nodes.join(end_digests(ends), key, "left").drop("k1", "k2")
    zero = F.lit(0).cast("long")
    turnless = end_digests(convs.where("n_turns = 0").select("conv_id", *[zero.alias(k) for k in key]))
    root = (convs.agg(F.min("conv_id").alias("near"), F.count("*").alias("n_convs")).where("n_convs > 0")
            .select(zero.alias("depth"), "near", "n_convs", zero.alias("tokens"), F.lit(None).cast("long").alias("up_near"))
            .join(turnless.select("depth", "ends_sha256"), "depth", "left"))
    nodes = stage(nodes.unionByName(root), "trie-named")
    up_depth = F.when(F.col("up_near").isNotNull(), F.col("depth") - 1)
    children = (nodes.where("up_near is not null")
                .groupBy(F.col("up_near").alias("near"), (F.col("depth") - 1).alias("depth"))
                .agg(F.count("*").alias("n_children")))
    nodes = stage(nodes.join(children, _NODE, "left").withColumn("n_children", F.coalesce("n_children", zero)),
                  "trie-children")
    forest = nodes.select(*_NODE, "up_near", up_depth.alias("up_depth"),
                          (F.col("n_children") == 0).cast("long").alias("n_leaves"),
                          ((F.col("n_convs") - 1) * F.col("tokens")).alias("saved_tokens"))
    sums = rollup(forest, ["n_leaves", "saved_tokens"])
    return nodes.join(sums, _NODE).select(
        F.col("near").alias("conv_id"), "depth", F.col("up_near").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def op12(conversations: DataFrame) -> DataFrame:
    return conversation_trie(conversations)
