"""Column-level text functions (JVM-side, inside whole-stage codegen).

Every function here takes and returns ``Column`` objects so that the
optimizer sees plain expressions: no Python runs per row.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that must equal the reference's behaviour -------------
# Text normalisation, applied in this order:
#   '―' -> '-' ; '？' -> '-' ; '“' '”' -> '"' ; '’' '‘' -> "'" ;
#   literal backslash followed by 'n' -> ' ' ; newline -> ' ' ;
#   CJK unified ideographs U+4E00..U+9FFF are deleted.
NORMALIZE_FROM = "―？“”’‘"
NORMALIZE_TO = "--\"\"''"
CJK_RANGE = "[一-鿿]"
# A sentence ends at '.', '!' or '?' followed by whitespace.
SENTENCE_END = "([.!?])[ \t\n\r\f]+"
# Marker used to split; U+001F (unit separator) never occurs in prose.
UNIT_SEP = "\u001f"
# ------------------------------------------------------------------------

WORD_SPLIT = "[^\\p{L}\\p{N}]+"
WS = "[ \t\n\r\f]"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def normalize_text(col) -> Column:
    """The fixed character rewrites, in three passes over the string.

    The four single-character maps are one ``translate``; the two line-break
    forms are one alternation; the ideograph range is deleted last, as in
    the reference order (deletion cannot create a new match for the
    earlier rules that was not already matched before it).
    """
    c = F.translate(_c(col), NORMALIZE_FROM, NORMALIZE_TO)
    c = F.regexp_replace(c, "\\\\n|\n", " ")
    return F.regexp_replace(c, CJK_RANGE, "")


def strip_subword_marker(col) -> Column:
    """Remove one leading '##'."""
    return F.regexp_replace(_c(col), "^##", "")


def split_sentences_expr(col) -> Column:
    """I4: rule-based sentence split -> array<string>.

    Cut after '.', '!' or '?' followed by whitespace, trim each piece of
    surrounding whitespace, and drop empty pieces.  Null text -> null.
    """
    marked = F.regexp_replace(_c(col), SENTENCE_END, "$1" + UNIT_SEP)
    parts = F.split(marked, UNIT_SEP)
    trimmed = F.transform(parts, lambda s: F.regexp_replace(s, f"^{WS}+|{WS}+$", ""))
    return F.filter(trimmed, lambda s: s != F.lit(""))


def word_tokens(col) -> Column:
    """Lower-cased letter/digit runs -> array<string> (empty pieces removed)."""
    return F.filter(F.split(F.lower(_c(col)), WORD_SPLIT), lambda s: s != F.lit(""))


def bind(value, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often ``body``
    names it, also inside its lambdas and where the optimizer moves or copies
    the expression (a filter pushed below a projection inlines columns)."""
    return F.get(F.transform(F.array(_c(value)), body), 0)


def term_counts(toks) -> Column:
    """Distinct terms of a token array with their counts -> array<struct<term,
    n>> in term order: the array is sorted and its runs are measured, so no
    term becomes a row before it is counted.  Null array -> null."""
    def ends(arr):
        return F.filter(F.sequence(F.lit(1), F.size(arr)),
                        lambda i: (i == F.size(arr)) | (F.get(arr, i) != F.get(arr, i - 1)))

    def counts(arr):
        return bind(ends(arr), lambda e: F.transform(e, lambda to, k: F.struct(
            F.get(arr, to - 1).alias("term"), (to - F.coalesce(F.get(e, k - 1), F.lit(0))).alias("n"))))

    none = F.array().cast("array<struct<term:string,n:int>>")
    return bind(F.sort_array(F.filter(_c(toks), lambda t: t.isNotNull())),
                lambda arr: F.when(F.size(arr) > 0, counts(arr)).when(F.size(arr) == 0, none))


def shingles_of_tokens(toks, k: int = 3) -> Column:
    """Distinct word k-grams of a token array column (fewer than k tokens ->
    one shingle of all of them; no tokens -> empty).

    Built from k shifted slices zipped together: linear in the tokens.  Pass
    a *column reference* to an already projected token array, so the
    tokeniser runs once per row (see ``with_shingles``)."""
    toks = _c(toks)
    shifted = [F.slice(toks, i + 1, F.greatest(F.size(toks) - i, F.lit(0))) for i in range(k)]
    z = F.arrays_zip(*shifted)
    fields = [str(i) for i in range(k)]
    full = F.filter(z, lambda s: s[fields[-1]].isNotNull())
    grams = F.transform(full, lambda s: F.concat_ws(" ", *[s[f] for f in fields]))
    short = F.when((F.size(toks) > 0) & (F.size(toks) < k), F.array(F.array_join(toks, " ")))
    return F.array_distinct(F.coalesce(short, grams))


def shingle_hashes(toks, k: int, key) -> Column:
    """The distinct word k-grams of ``shingles_of_tokens`` as 64-bit hashes of
    ``key`` and the k-gram's words (no k-gram is joined to a string)."""
    toks, key = _c(toks), _c(key)
    z = F.arrays_zip(*[F.slice(toks, i + 1, F.greatest(F.size(toks) - (k - 1), F.lit(0))) for i in range(k)])
    grams = F.transform(z, lambda s: F.xxhash64(key, *[s[str(i)] for i in range(k)]))
    short = F.when((F.size(toks) > 0) & (F.size(toks) < k), F.array(F.xxhash64(key, F.array_join(toks, " "))))
    return F.array_distinct(F.coalesce(short, grams))


def paragraphs(col) -> Column:
    """Split raw text on newline runs, drop blank paragraphs."""
    parts = F.split(_c(col), "\n+")
    return F.filter(parts, lambda s: F.regexp_replace(s, f"{WS}+", "") != F.lit(""))


def prefix_until(list_col, n: int) -> Column:
    """take the first element; add the next while the accumulated length
    *before adding* is < n; concatenate without separator."""
    arr = _c(list_col)
    first = F.element_at(arr, 1)
    rest = F.slice(arr, 2, F.greatest(F.size(arr) - 1, F.lit(0)))
    return F.when(F.size(arr) >= 1, F.aggregate(
        rest, first, lambda acc, x: F.when(F.length(acc) < n, F.concat(acc, x)).otherwise(acc)))


def first_chars(col, n: int) -> Column:
    """First n characters (code points)."""
    return F.substring(_c(col), 1, n)


def first_words(col, n: int) -> Column:
    """First n whitespace tokens."""
    return F.slice(F.split(_c(col), f"{WS}+"), 1, n)


def strip_tco_links(col) -> Column:
    """Remove an https?://t.co link and everything after it on the line."""
    return F.regexp_replace(_c(col), "https?://t\\.co[^\n]*", "")


def join_paragraphs(list_col) -> Column:
    """Join a sentence/paragraph list with single spaces."""
    return F.array_join(_c(list_col), " ")


def with_prompt(col, prefix: str = "summarize: ") -> Column:
    """Prompt prefix for a generator."""
    return F.concat(F.lit(prefix), _c(col))


def fill_template(template_col, sbj_col, obj_col) -> Column:
    """I8: substitute {sbj} and {obj} in one pass over the template.

    The template is split on the placeholders first, so an entity text that
    itself contains '{obj}' is inserted literally and never re-expanded.
    """
    pieces = F.split(_c(template_col), "(?=\\{sbj\\}|\\{obj\\})|(?<=\\{sbj\\}|\\{obj\\})")
    return F.array_join(F.transform(pieces, lambda p: F.when(p == "{sbj}", _c(sbj_col))
                                    .when(p == "{obj}", _c(obj_col)).otherwise(p)), "")


def day_key(ts_col) -> Column:
    """yyyyMMdd day key of a timestamp/date."""
    return F.date_format(_c(ts_col), "yyyyMMdd")


def parse_day(col) -> Column:
    return F.to_date(_c(col), "yyyyMMdd")
