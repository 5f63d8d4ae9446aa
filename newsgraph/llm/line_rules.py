"""Line-first quality rules.

Every line of a text is judged by itself; lines that fail are removed, and a
document that loses more than ``MAX_LOSS`` of its word characters is
rejected, as is one that the base counts reject.  A line fails as

* symbols: more than ``MAX_SYMBOLS`` of its word characters are symbols;
* navigation: ``MIN_SEPARATORS`` or more free-standing separators, and at
  most ``MAX_ITEM_WORDS`` words to an item on average;
* shouting: ``MIN_MARKS`` or more exclamation marks, one to every
  ``WORDS_PER_MARK`` words or denser;
* unfinished: ``MIN_WORDS`` or more words without any sentence punctuation;
* boilerplate: nothing is left of it without the sentences that hold one of
  ``NOTICES``; these sentences go from every line, so one mention in a long line costs
  that sentence only;
* repetition: it equals an earlier line of the text.

Lines without a word are neither judged nor counted.  Only DataFrame
functions are used, and a document never leaves its row: lines, words and
word triples live in arrays.

Null text counts as having no words and is rejected; so is every text under
``MIN_DOC_WORDS`` words.  Rows with equal or null ids are judged as they are,
extra columns pass through ``judge`` unless they carry a result's name, which
is then replaced.  An empty table gives no rows.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import WS_CHARS, let, without, words

MIN_DOC_WORDS = 50
MAX_REPEATED = 50  # per cent of the words
MAX_LOSS = 0.5
MAX_SYMBOLS = 0.2
MIN_SEPARATORS = 3
MAX_ITEM_WORDS = 3
SEPARATORS = "|>»•·"
MIN_MARKS = 5
WORDS_PER_MARK = 3
MIN_WORDS = 30
SYMBOLS = "#*$%&|<>"
SENTENCE_MARKS = ".!?:;…。"
SENTENCE_END = r"(?<=[.!?…。])[ \t\x0B\f\r]+"
NOTICES = ("all rights reserved", "cookie policy", "enable javascript", "privacy policy",
           "sign in to continue", "subscribe to our newsletter", "terms of service", "terms of use")

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(without(text, chars))


def word_chars(text: Column) -> Column:
    return F.length(without(text, WS_CHARS))


def repeated_words(ws: Column) -> Column:
    """Words that lie in a window of three words found twice or more.

    Where all windows differ there are none.  Else the windows' hashes are
    sorted with their places; neighbours with equal hashes are repeats.  Of
    the places, sorted again, each covers as many new words as lie before the
    next one, three at most.
    """
    def places(hashed: Column) -> Column:
        def repeat(x: Column, i: Column) -> Column:
            near = lambda k: F.get(hashed, i + k)["h"].eqNullSafe(x["h"])
            return near(-1) | near(1)
        return F.sort_array(F.transform(F.filter(hashed, repeat), lambda x: x["p"]))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def count(windows: Column) -> Column:
        placed = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("p")))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(
            let(F.sort_array(placed), lambda hashed: let(places(hashed), covered)))

    windows = F.transform(F.slice(ws, F.lit(1), F.greatest(F.size(ws) - 2, F.lit(0))),
                          lambda w, i: F.xxhash64(w, F.get(ws, i + 1), F.get(ws, i + 2)))
    return let(windows, count)


def _has_notice(text: Column) -> Column:
    return let(F.lower(text), lambda low: reduce(lambda a, b: a | b, [low.contains(x) for x in NOTICES]))


def _without_notices(line: Column) -> Column:
    """The line's sentences that hold no notice."""
    return F.when(~_has_notice(line), line).otherwise(
        F.array_join(F.filter(F.split(line, SENTENCE_END), lambda x: ~_has_notice(x)), " "))


def line_fails(line: Column) -> Column:
    """Whether a line (with at least one word) fails a rule on its form.  Each
    rule first asks for a character it needs, so most lines are never cut into words."""
    n = F.size(words(line))
    separators = F.size(F.filter(words(line), lambda w: w.isin(*SEPARATORS)))
    marks = _count(line, "!")
    symbols = _count(line, SYMBOLS) > MAX_SYMBOLS * word_chars(line)
    menu = (line.rlike(f"[{SEPARATORS}]") & (separators >= MIN_SEPARATORS)
            & (n - separators <= MAX_ITEM_WORDS * (separators + 1)))
    shouting = (marks >= MIN_MARKS) & (marks * WORDS_PER_MARK >= n)
    unfinished = ~line.rlike(f"[{SENTENCE_MARKS}]") & (n >= MIN_WORDS)
    return symbols | menu | shouting | unfinished


def line_left(line: Column) -> Column:
    """What the rules leave of a line: nothing, or its sentences without a notice."""
    return F.when(line_fails(line), "").otherwise(_without_notices(line))


def judge(docs: DataFrame) -> DataFrame:
    """``docs`` with the base counts, ``base_failed``, ``lost_chars``,
    ``clean_text`` (what is left of the lines, joined) and ``kept``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: without(x, WS_CHARS) != "")

    def judged(lines: Column) -> Column:
        # each line once, where it stands first; a later equal line is a repetition
        def verdict(x: Column) -> Column:
            return let(line_left(x), lambda y: F.struct(y.alias("line"), word_chars(y).alias("chars"), (
                without(y, WS_CHARS) == "").alias("fails")))
        verdicts = F.transform(F.array_distinct(lines), verdict)
        return let(verdicts, lambda v: F.struct(
            (F.size(lines) - F.size(v)).cast("long").alias("n_dup_lines"),
            F.aggregate(v, F.lit(0).cast("long"), lambda a, x: a + x["chars"]).alias("left"),
            F.array_join(F.transform(F.filter(v, lambda x: ~x["fails"]), lambda x: x["line"]), "\n")
            .alias("clean_text")))

    facts = let(words(text), lambda ws: F.struct(
        F.size(ws).cast("long").alias("n_words"), F.length(F.array_join(ws, "")).cast("long").alias("word_chars"),
        repeated_words(ws).cast("long").alias("n_repeat_words")))
    out = docs.withColumns({"_facts": facts, "_judged": let(lines, judged),
                            "n_symbols": _count(text, SYMBOLS).cast("long")})
    out = out.withColumns({
        "n_words": F.col("_facts.n_words"), "n_repeat_words": F.col("_facts.n_repeat_words"),
        "word_chars": F.col("_facts.word_chars"), "n_dup_lines": F.col("_judged.n_dup_lines"),
        "lost_chars": F.col("_facts.word_chars") - F.col("_judged.left"), "clean_text": F.col("_judged.clean_text")})
    base = ((F.col("n_words") < MIN_DOC_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")))
    lost = F.col("lost_chars") > MAX_LOSS * F.col("word_chars")
    return out.withColumns({"base_failed": base, "kept": ~(base | lost)}).drop("_facts", "_judged")


_DIGEST = ["doc_id", *COUNTS, "base_failed", "kept"]


def op6(docs: DataFrame) -> DataFrame:
    return judge(docs).select(*_DIGEST)


def clean(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with the columns of ``docs`` and the text
    that is left of theirs.  A text that lost nothing is as it was, its blank
    lines included; ``n_chars``, where there is one, follows the text."""
    judged = judge(docs.withColumn("_whole", F.struct(*docs.columns))).where("kept")
    changed = (F.col("lost_chars") > 0) | (F.col("n_dup_lines") > 0)
    old = lambda c: F.col("_whole")[c]
    new = {"text": F.when(changed, F.col("clean_text")).otherwise(old("text"))}
    if "n_chars" in docs.columns:
        size = F.length("clean_text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(changed & old("n_chars").isNotNull(), size).otherwise(old("n_chars"))
    return judged.select(*(new.get(c, old(c)).alias(c) for c in docs.columns))


def _sql_count(text: str, chars: str) -> str:
    return f"length({text}) - length(translate({text}, '{chars}', ''))"


_WS_SQL = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
_NOTICES_SQL = "|".join(NOTICES)

SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT r, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM d
), win AS (
  SELECT r, p, ws[p] AS a, ws[p + 1] AS b, ws[p + 2] AS c
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS p FROM w)
), rep AS (
  SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM win) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT q) AS n_repeat_words
  FROM (SELECT r, p + unnest([0, 1, 2]) AS q FROM rep) GROUP BY r
), split AS (
  SELECT r, unnest(string_split(text, chr(10))) AS line FROM d
), lines AS (
  SELECT r, line, translate(line, {_WS_SQL}, '') AS solid,
         list_filter(string_split_regex(line, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
  FROM split WHERE translate(line, {_WS_SQL}, '') <> ''
), facts AS (
  SELECT r, line, count(*) AS copies, any_value(length(solid)) AS chars, any_value(len(ws)) AS n,
         any_value(len(list_filter(ws, lambda x: length(x) = 1 AND contains('{SEPARATORS}', x)))) AS seps,
         any_value({_sql_count('line', SYMBOLS)}) AS symbols,
         any_value({_sql_count('line', '!')}) AS marks,
         any_value({_sql_count('line', SENTENCE_MARKS)}) AS ends,
         any_value(list_filter(string_split(regexp_replace(line, '([.!?…。])[ \\t\\x0B\\f\\r]+', '\\1' || chr(1), 'g'),
                                            chr(1)),
                               lambda x: NOT regexp_matches(lower(x), '{_NOTICES_SQL}'))) AS sentences
  FROM lines GROUP BY r, line
), judged AS (
  SELECT r, copies, length(translate(array_to_string(sentences, ''), {_WS_SQL}, '')) AS chars,
         symbols > {MAX_SYMBOLS} * chars
         OR (seps >= {MIN_SEPARATORS} AND n - seps <= {MAX_ITEM_WORDS} * (seps + 1))
         OR (marks >= {MIN_MARKS} AND marks * {WORDS_PER_MARK} >= n)
         OR (n >= {MIN_WORDS} AND ends = 0) AS fails
  FROM facts
), per_doc AS (
  SELECT r, sum(copies) - count(*) AS dups, sum(CASE WHEN fails THEN 0 ELSE chars END) AS left_chars
  FROM judged GROUP BY r
), counts AS (
  SELECT d.doc_id, len(w.ws)::BIGINT AS n_words, length(translate(d.text, {_WS_SQL}, ''))::BIGINT AS word_chars,
         ({_sql_count('d.text', SYMBOLS)})::BIGINT AS n_symbols, coalesce(dups, 0)::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(left_chars, 0) AS left_chars
  FROM d JOIN w USING (r) LEFT JOIN covered USING (r) LEFT JOIN per_doc USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {MIN_DOC_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed,
       NOT (n_words < {MIN_DOC_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words
            OR word_chars - left_chars > {MAX_LOSS} * word_chars) AS kept
FROM counts
"""
