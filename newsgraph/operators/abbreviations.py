"""I4 with learned abbreviations: sentence cuts that know "Dr. Smith".

Kiss and Strunk, "Unsupervised Multilingual Sentence Boundary Detection",
Computational Linguistics 2006.  An abbreviation is a word type that nearly
always carries its period.  That is measured on the corpus itself: counts of
every type, a log-likelihood ratio of "the period belongs to the word" against
"it stands there by chance", and three factors for length, inner periods and
uses without a period.

Counting explodes the tokens of a text, but equal tokens are combined before
they are shuffled, so the shuffled rows grow with the vocabulary.  Cutting starts from the
plain rule of ``split_sentences_expr`` and glues a piece to the one before it
where that one ends in an abbreviation and the next word does not start a
sentence.  No token is shuffled there: the two word lists are looked up in the
row, in a hash table held as an array of buckets, while their measured bytes
are at most ``max_bytes``; beyond that the ends of pieces are joined with them.

Null texts count as none, and their sentence list is null.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from .common import BROADCAST_BYTES, attach_row

#: Published constants: the share of periods of a true abbreviation, the least score.
P_ABBREVIATION = 0.99
MIN_SCORE = 0.3
OPENERS = "^[\"'(\\[“‘«]+"
CLOSERS = "[^\\p{L}\\p{N}.]+$"
BUCKETS = 4096


def _bare(token: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(token, OPENERS, ""), CLOSERS, "")


def _type(bare: Column) -> Column:
    """Lower case, without one trailing period."""
    return F.regexp_replace(F.lower(bare), "\\.$", "")


def type_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``(type, n_dot, n_plain, n_lower, n_inside_upper)`` of the corpus: uses
    with and without a trailing period, uses that begin in lower case, and
    upper-case uses behind a word that ends no sentence.  A token is what
    stands between white space, without opening quotes and brackets and
    without closing marks other than the period; types without a letter are
    not counted."""
    toks = tx.bind(F.filter(F.split(F.col(text_col), f"{tx.WS}+"), lambda t: t != ""), lambda ts: F.transform(
        ts, lambda t, i: F.struct(t.alias("tok"), F.get(ts, i - 1).alias("prev"))))
    pairs = df.select(F.explode_outer(toks).alias("_p")).select("_p.tok", "_p.prev").where("tok IS NOT NULL")
    # equal tokens are counted before any pattern reads them; what stands before matters to capitals only
    inside = F.when(F.col("tok") == F.lower("tok"), False).otherwise(
        F.col("prev").isNotNull() & ~F.col("prev").rlike("[.!?:][^\\p{L}\\p{N}]*$"))
    tokens = pairs.groupBy("tok", inside.alias("_inside")).agg(F.count("*").alias("_n"))
    typed = tokens.withColumn("_b", _bare(F.col("tok"))).withColumn("type", _type(F.col("_b"))).where(
        F.col("type").rlike("\\p{L}"))
    dot = F.col("_b").endswith(".")
    count = lambda c: F.coalesce(F.sum(F.when(c, F.col("_n"))), F.lit(0))
    return typed.groupBy("type").agg(
        count(dot).alias("n_dot"), count(~dot).alias("n_plain"),
        count(F.col("_b").rlike("^\\p{Ll}")).alias("n_lower"),
        count(F.col("_b").rlike("^\\p{Lu}") & F.col("_inside")).alias("n_inside_upper"))


def abbreviations(counts: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """``(type, n_dot, n_plain, score)`` of the types that are abbreviations.

    ``counts`` is ``type_counts``; it is read twice, so materialise it.  The
    chance of a period is (periods + 1) / (tokens + 2), which keeps the
    logarithms finite on tiny and empty tables."""
    totals = counts.agg(((F.coalesce(F.sum("n_dot"), F.lit(0)) + 1)
                         / (F.coalesce(F.sum(F.col("n_dot") + F.col("n_plain")), F.lit(0)) + 2)).alias("_p"))
    t = attach_row(counts.where("n_dot > 0"), totals)
    letters = F.length(F.replace(F.col("type"), F.lit("."), F.lit("")))
    ratio = -2.0 * (F.col("n_dot") * (F.log("_p") - F.log(F.lit(P_ABBREVIATION)))
                    + F.col("n_plain") * (F.log(1 - F.col("_p")) - F.log(F.lit(1 - P_ABBREVIATION))))
    score = (ratio * F.exp(-letters.cast("double")) * (F.length("type") - letters + 1)
             * F.pow(letters.cast("double"), -F.col("n_plain").cast("double")))
    return t.select("type", "n_dot", "n_plain", score.alias("score")).where(F.col("score") >= min_score)


def starters(counts: DataFrame) -> DataFrame:
    """``(type)``: words whose capital shows a new sentence, as the corpus has
    them in lower case and never capitalised inside a sentence."""
    return counts.where("n_lower > 0 AND n_inside_upper = 0").select("type")


def _table(words: DataFrame) -> DataFrame:
    """One row ``_h``: a hash table of ``type`` as an array of buckets."""
    every = words.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("_k"))
    full = every.join(words.select(F.pmod(F.hash("type"), F.lit(BUCKETS)).alias("_k"), "type"), "_k", "left")
    return (full.groupBy("_k").agg(F.collect_list("type").alias("_w"))
            .agg(F.sort_array(F.collect_list(F.struct("_k", "_w"))).alias("_b")).select(F.col("_b._w").alias("_h")))


def _in(word: Column, table: Column) -> Column:
    return F.array_contains(F.get(table, F.pmod(F.hash(word), F.lit(BUCKETS))), word)


def _first(piece: Column) -> Column:
    """The word a piece starts with."""
    return _bare(F.regexp_extract(F.substring_index(piece, " ", 1), "^[^ \t\n\r\f]+", 0))


def _before(pieces: Column, i: Column) -> Column:
    """The type that the piece before ``i`` ends in, if with a period."""
    word = F.regexp_extract(F.substring_index(F.get(pieces, i - 1), " ", -1), "[^ \t\n\r\f]+$", 0)
    return F.when(F.get(pieces, i - 1).endswith("."), _type(F.regexp_replace(word, OPENERS, "")))


def _places(pieces: Column) -> Column:
    return F.when(F.size(pieces) > 0, F.sequence(F.lit(0), F.size(pieces) - 1)).otherwise(
        F.array().cast("array<int>"))


def _join(pieces: Column, heads: Column) -> Column:
    """The pieces, those between two heads joined to the first of them."""
    return F.transform(heads, lambda i, k: F.array_join(F.slice(
        pieces, i + 1, F.coalesce(F.get(heads, k + 1), F.size(pieces)) - i), " "))


def _glued(before_known: Column, first: Column, first_starts: Column) -> Column:
    return before_known & ~(first.rlike("^\\p{Lu}") & first_starts)


def _words_fit(words: DataFrame, max_bytes: int) -> bool:
    size = words.agg(F.coalesce(F.sum(F.length("type") * 4 + 24), F.lit(0)).alias("b")).first()["b"]
    return size <= max_bytes


def split_sentences_learned(df: DataFrame, abbrevs: DataFrame, starts: DataFrame, text_col: str = "text",
                            id_col: str = "article_id", out_col: str = "split_text",
                            max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """I4: sentences as an array, uncut behind an abbreviation unless the next
    word is a capitalised sentence starter.  Glued pieces are joined by one
    space.  ``id_col`` must be unique; rows with a null id keep the plain cut
    where the word lists are too large to be looked up in the row."""
    pieces = tx.split_sentences_expr(text_col)
    if _words_fit(abbrevs.select("type").unionByName(starts), max_bytes):
        def glued(s: Column, i: Column) -> Column:
            known_before = tx.bind(_before(s, i), lambda w: _in(w, F.col("_ab")))
            return F.when(known_before, tx.bind(_first(F.get(s, i)), lambda w: _glued(
                F.lit(True), w, _in(_type(w), F.col("_st"))))).otherwise(False)

        known = df.withColumn("_ab", _table(abbrevs).scalar()).withColumn("_st", _table(starts).scalar())
        cut = tx.bind(pieces, lambda s: F.when(s.isNotNull(), tx.bind(
            F.filter(_places(s), lambda i: ~glued(s, i)), lambda h: _join(s, h))))
        return known.withColumn(out_col, cut).drop("_ab", "_st")
    ends = df.select(id_col, F.posexplode_outer(tx.bind(pieces, lambda s: F.transform(
        s, lambda x, i: F.struct(_before(s, i).alias("before"), _first(x).alias("first"))))).alias("_i", "_e"))
    hits = (ends.where("_e.before IS NOT NULL")
            .select(id_col, "_i", F.col("_e.before").alias("type"), F.col("_e.first").alias("_f"),
                    _type(F.col("_e.first")).alias("_ft")).join(abbrevs.select("type"), "type")
            .join(starts.select(F.col("type").alias("_ft"), F.lit(True).alias("_st")), "_ft", "left")
            .where(_glued(F.lit(True), F.col("_f"), F.coalesce("_st", F.lit(False))))
            .groupBy(id_col).agg(F.collect_list("_i").alias("_gi")))
    glued = F.coalesce("_gi", F.array().cast("array<int>"))
    cut = tx.bind(pieces, lambda s: F.when(s.isNotNull(), tx.bind(
        F.array_except(_places(s), glued), lambda h: _join(s, h))))
    return df.join(hits, id_col, "left").withColumn(out_col, cut).drop("_gi")
