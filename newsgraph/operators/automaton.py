"""Phrases of a dictionary in texts, by an Aho-Corasick automaton.

A dictionary of checked size is sent to the workers, each of which builds the
automaton once and reads every text in one pass: no token becomes a row and
nothing is shuffled.  Texts are taken as tokens between single spaces; a phrase
matches a whole run of tokens, the longest one at a place, from left to right,
without overlaps.
"""
from __future__ import annotations

import sys
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES

# executors need pyarrow and ahocorasick, not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a batch that are Python objects at a time.
ROWS_AT_ONCE = 64


def small_rows(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> list[tuple] | None:
    """The rows of a dictionary (two string columns) whose values take at most
    ``max_bytes`` as counted by an aggregate, else None."""
    used = [F.coalesce(F.octet_length(c), F.lit(0)) + 8 for c in df.columns]
    size = df.agg(F.sum(used[0] + used[1]).alias("n")).first()["n"] or 0
    return None if size > max_bytes else [tuple(r) for r in df.collect()]


def build(phrases: list[str]) -> ahocorasick.Automaton:
    """An automaton of the distinct phrases, each between two spaces."""
    out = ahocorasick.Automaton()
    for p in set(phrases):
        out.add_word(f" {p} ", (len(p) + 2, p))
    out.make_automaton()
    return out


def find(automaton: ahocorasick.Automaton, text: str) -> list[tuple[int, str]]:
    """(token position, phrase) of the phrases of a text: at each place the
    longest, left to right, none inside another."""
    if not len(automaton):
        return []
    padded, longest = f" {text} ", {}
    for end, (size, phrase) in automaton.iter(padded):
        start = end - size + 1
        if size > longest.get(start, (0,))[0]:
            longest[start] = (size, phrase)
    out, reach, at, pos = [], 0, 0, 0
    for start in sorted(longest):
        if start >= reach:
            size, phrase = longest[start]
            pos += padded.count(" ", at, start)
            at = start
            out.append((pos, phrase))
            reach = start + size - 1             # the space behind may stand before the next phrase
    return out


def replace(tokens: list[str], runs: list[tuple[int, str]], values: dict[str, str]) -> str:
    """The tokens, the phrases among them replaced by their values, joined."""
    out, at = [], 0
    for pos, phrase in runs:
        out += tokens[at:pos]
        out.append(values[phrase])
        at = pos + phrase.count(" ") + 1
    return " ".join(out + tokens[at:])


def mentions(df: DataFrame, phrases: list[tuple[str, str]], text_col: str, id_col: str) -> DataFrame:
    """(id, pos, word, entity_group) of every phrase found in a text."""
    group: dict[str, str] = {}
    for phrase, g in sorted((p, g) for p, g in phrases if p is not None and g is not None):
        group.setdefault(phrase, g)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = build(list(group))
        for batch in batches:
            row, pos, word = [], [], []
            for i, text in enumerate(batch.column(1)):
                if text.is_valid:
                    for p, w in find(automaton, text.as_py()):
                        row.append(i)
                        pos.append(p)
                        word.append(w)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(pos, pa.int32()),
                 pa.array(word, pa.string()), pa.array([group[w] for w in word], pa.string())],
                names=[id_col, "pos", "word", "entity_group"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, F.col(text_col).cast("string")).mapInArrow(
        run, f"`{id_col}` {kind}, pos int, word string, entity_group string")


def translated(list_col: str | Column, glossary: dict[str, str]) -> Column:
    """The sentences of a list column, lower-cased runs of tokens that are in
    the glossary replaced.  A null list gives an empty one, a null sentence an
    empty sentence."""
    built: list[ahocorasick.Automaton] = []

    @F.arrow_udf("array<string>")
    def run(lists: pa.Array) -> pa.Array:
        if not built:
            built.append(build(list(glossary)))
        # a batch stays in Arrow's own form; only ROWS_AT_ONCE of its texts are Python strings at a time
        parts = [pa.array([], pa.list_(pa.string()))]
        for at in range(0, len(lists), ROWS_AT_ONCE):
            out = []
            for sentences in lists.slice(at, ROWS_AT_ONCE):
                done = []
                for s in (sentences.values if sentences.is_valid else ()):
                    tokens = s.as_py().split(" ") if s.is_valid else []
                    done.append(replace(tokens, find(built[0], " ".join([t.lower() for t in tokens])), glossary))
                out.append(done)
            parts.append(pa.array(out, pa.list_(pa.string())))
        return pa.concat_arrays(parts)

    return run(F.col(list_col) if isinstance(list_col, str) else list_col)
