"""Document fingerprints by order MinHash.

A text's k-mers are its runs of ``K`` words (a word longer than ``MAX_WORD``
characters counts as several).  Equal k-mers are numbered by occurrence, so a
text is a set of (k-mer, number) pairs, each with one 64-bit hash.  ``SLICES``
leading bits deal the pairs into slices, which play the part of independent
hash functions; from each slice the ``TUPLE`` pairs of the smallest hashes are
taken, put back into text order and hashed as a tuple.  The fingerprint lists
the slices that hold anything with their tuple's hash.  Two texts agree in a
slice only if they share its smallest pairs *in the same order*, which makes
the agreement sensitive to edit distance and not only to the shared words.
Most slices of a text under about 66 words hold a single pair, and a single
pair has no order: such fingerprints see reordering less (figures: README).

``likeness`` is the share of agreeing slices among those either text fills,
to the power 1 / TUPLE, an estimate of the share of common k-mers; it is 1
for two empty fingerprints.

Only DataFrame functions are used, and a text never leaves its row.  Sorting
works on packed 64-bit numbers: slice, hash and place (the places of words
beyond the ``PLACE_BITS``-bit range tie).  Null text counts as empty, with an
empty fingerprint.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import let, words

K = 2
MAX_WORD = 64
SLICE_BITS = 5
SLICES = 1 << SLICE_BITS
TUPLE = 2
PLACE_BITS = 24
#: Rows to a range of ids, and the number of ranges a table is cut into at most.
RANGE_ROWS, FAN_OUT = 2000, 64

_PLACE = (1 << PLACE_BITS) - 1


def _packed(hashed: Column, place: Column) -> Column:
    """The hash's leading bits with the place below them."""
    return hashed.bitwiseAND(F.lit(~_PLACE)).bitwiseOR(F.least(place.cast("long"), F.lit(_PLACE)))


def _hash(packed: Column) -> Column:
    return F.shiftright(packed, PLACE_BITS)


def units(text: Column) -> Column:
    """Words, the long ones cut."""
    cut = words(F.regexp_replace(text, rf"([^\x20\x09-\x0D]{{{MAX_WORD}}})", "$1 "))
    return let(words(text), lambda ws: F.when(F.exists(ws, lambda w: F.length(w) > MAX_WORD), cut).otherwise(ws))


def _is_first(s: Column, x: Column, i: Column) -> Column:
    return (i == 0) | (_hash(F.get(s, i - 1)) != _hash(x))


def _repeats(s: Column) -> Column:
    """Packed hashes of the (k-mer, occurrence number) pairs of the later
    occurrences: in sorted order those of a k-mer stand together."""
    def numbered(rest: Column) -> Column:
        first = F.filter(F.transform(rest, lambda x, i: F.when(_is_first(rest, x, i), i).otherwise(-1)),
                         lambda i: i >= 0)
        numbers = let(first, lambda f: F.flatten(F.transform(
            f, lambda a, r: F.sequence(F.lit(1), F.coalesce(F.get(f, r + 1), F.size(rest)) - a))))
        return F.zip_with(rest, numbers, lambda x, n: _packed(F.xxhash64(_hash(x), n), x.bitwiseAND(F.lit(_PLACE))))
    return F.sort_array(let(F.filter(s, lambda x, i: ~_is_first(s, x, i)), numbered))


def _smallest(s: Column) -> Column:
    """Of sorted packed pairs, the first ``TUPLE`` of every slice."""
    return F.filter(s, lambda x, i: (i < TUPLE) | (_slice(F.get(s, i - TUPLE)) != _slice(x)))


def _slice(packed: Column) -> Column:
    return F.shiftrightunsigned(packed, 64 - SLICE_BITS)


def _tuples(s: Column) -> Column:
    """Slice and tuple hash, as text, of each slice's pairs."""
    def tuple_of(x: Column, i: Column) -> Column:
        mine = F.filter(F.slice(s, i + 1, F.lit(TUPLE)), lambda y: _slice(y) == _slice(x))
        ordered = F.array_sort(mine, lambda a, b: F.when(
            a.bitwiseAND(F.lit(_PLACE)) < b.bitwiseAND(F.lit(_PLACE)), -1).otherwise(1))
        joined = F.xxhash64(F.transform(ordered, _hash))
        first = (i == 0) | (_slice(F.get(s, i - 1)) != _slice(x))
        return F.when(first, F.concat(F.lpad(F.hex(_slice(x)), 2, "0"),
                                      F.lpad(F.hex(F.shiftrightunsigned(joined, 24)), 10, "0")))
    return F.filter(F.transform(s, tuple_of), lambda t: t.isNotNull())


def fingerprint(text: Column) -> Column:
    """Fingerprint of a text column: ``slice hash`` entries, comma-joined."""
    kmers = let(units(F.coalesce(text.cast("string"), F.lit(""))), lambda ws: F.transform(
        ws, lambda w, i: _packed(F.xxhash64(w, *(F.get(ws, i + k) for k in range(1, K))), i)))

    def smallest(s: Column) -> Column:
        # a first occurrence keeps its k-mer's hash, so these are sorted already
        firsts = let(F.filter(s, lambda x, i: _is_first(s, x, i)), _smallest)
        return let(F.sort_array(F.concat(firsts, let(_repeats(s), _smallest))), _smallest)

    return F.array_join(let(let(F.sort_array(kmers), smallest), _tuples), ",")


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two fingerprints, 0 to 1."""
    parts = lambda x: F.array_remove(F.split(x, ","), "")
    slices = lambda x: F.transform(parts(x), lambda e: F.substring(e, 1, 2))
    both = F.size(F.array_intersect(parts(a), parts(b)))
    either = F.size(F.array_union(slices(a), slices(b)))
    return F.when(either == 0, 1.0).otherwise(F.pow(both / either, F.lit(1 / TUPLE)))


def _array(values: list) -> Column:
    return F.array(*(F.lit(v).cast("long") for v in values))


def with_next(docs: DataFrame, carry: list[str], tie: str) -> DataFrame:
    """``docs`` with ``next_X`` for each carried column X: its value in the
    next row by falling ``doc_id`` (nulls last; equal ids by ``tie``), and
    after the last row that of the first.

    The ids are cut into ranges of about ``RANGE_ROWS`` rows by percentiles;
    each range is one window partition.  The first row of a range is also put
    behind the last row of the range before it, and dropped after the window.
    Only ids at the range bounds reach the driver.
    """
    ids = docs.select("doc_id")
    n = ids.count()
    fan = min(FAN_OUT, max(1, round((n / RANGE_ROWS) ** 0.5)))
    cuts = max(1, fan * fan)
    shares = [i / cuts for i in range(1, cuts)] or [0.5]
    found = ids.agg(F.percentile_approx("doc_id", shares, 100 * cuts)).first()[0] or []
    bounds = sorted(found if cuts > 1 else [], reverse=True)
    rows = [bounds[i:i + fan] for i in range(0, len(bounds), fan)]
    top = [r[-1] for r in rows if len(r) == fan]  # a bound itself belongs to the range it opens from above
    inner = F.array(*(_array(r[:fan - 1] if len(r) == fan else r) for r in rows)) if rows else F.array(_array([]))
    below = lambda bound: bound > F.col("doc_id")
    if rows:
        outer = F.size(F.filter(_array(top), below)) if top else F.lit(0)
        place = outer * fan + F.size(F.filter(F.coalesce(F.get(inner, outer), _array([])), below))
    else:
        place = F.lit(0)
    last = cuts + 1  # null ids
    place = F.when(F.col("doc_id").isNull(), last).otherwise(place).cast("long")
    heads = {r["place"]: r["head"] for r in ids.select("doc_id", place.alias("place")).groupBy("place")
             .agg(F.max("doc_id").alias("head")).collect()}
    order = sorted(heads)
    head = _array([heads.get(p) for p in range(last + 1)])
    before = {p: order[i - 1] for i, p in enumerate(order)}
    before = _array([before.get(p) for p in range(last + 1)])
    here = F.struct(F.col("_range"), F.lit(False).alias("extra"))
    there = F.struct(F.get(before, F.col("_range")).alias("_range"), F.lit(True).alias("extra"))
    is_head = F.col("doc_id").eqNullSafe(F.get(head, F.col("_range")))
    spread = (docs.withColumn("_range", place)
              .withColumn("_at", F.explode(F.when(is_head, F.array(here, there)).otherwise(F.array(here)))))
    w = (Window.partitionBy(F.col("_at._range")).orderBy(F.col("_at.extra"), F.col("doc_id").desc_nulls_last(), tie))
    return (spread.withColumns({f"next_{c}": F.lead(c).over(w) for c in carry})
            .where(~F.col("_at.extra")).drop("_range", "_at"))


def op10(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    marked = slim.withColumn("fingerprint", fingerprint(F.col("text")))
    pairs = with_next(marked, ["text", "fingerprint"], "text")
    n = F.length("text").cast("long")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n.cast("int") - cut), F.substring("next_text", F.lit(1), cut))
    out = (pairs.withColumn("n_chars", n).withColumn("edited", edited)
           .withColumn("edited_fingerprint", fingerprint(F.col("edited"))))
    return out.select(
        "doc_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
