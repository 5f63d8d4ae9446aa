"""URL filter: word segmentation by unigram Viterbi, then naive Bayes.

A URL's host and path fall into chunks, the runs of letters between
punctuation and digits.  Each distinct chunk is cut into the words of the
highest unigram probability (Viterbi).  The unigram counts are those of the
chunks of all URLs in the table; the ``SEEDS`` count ``SEED_COUNT`` more each.  Whether a chunk is one
word itself is a question of how widely it is used: next to its count's logarithm it pays
``LETTER`` a letter, divided by the number of hosts that have it, so the name of one host falls into
words that stand alone elsewhere (``kitchengarden``), however many pages that host has, and
a word that many hosts use stays whole.  A word inside a longer chunk pays ``PART``; it has ``MIN_PART``
to ``MAX_WORD`` letters, or is a seed.  A run of letters that is no word pays ``LETTER`` a letter
and ``RUN`` besides.  Candidate words reach a chunk by a join of its substrings with the counts, so no
vocabulary has to fit anywhere.

No URL carries a label.  Those with a word of ``BLOCK_WORDS`` after
segmentation are the positive class, the others the negative one; a
multinomial naive Bayes over the segmented words, smoothed with the words'
overall shares (``SMOOTHING``), scores every URL from its host and path words.
A word that keeps company with block words thus counts too.  Positive scores
are blocked.  Rules go first: the longest rule that fits a host (or one of
its parent domains) and the beginning of the path decides.

A null URL, or one without ``://``, has an empty host and path; without words
it is allowed.  Rows are told apart even with equal or null ids; extra columns
are ignored; an empty table gives no rows.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.common import attach_row
from .shared import let, stage

# Rules (host and path as one string, verdict).
RULES = {
    "net/": "block",
    "example.net/en/": "allow",
    "example.com/de/": "block",
    "org/fr/": "allow",
}

# Words of hosts that crawls leave out (advertising, gambling,
# adult and pharmacy spam).
BLOCK_WORDS = ("ads", "adult", "bet", "bets", "betting", "casino", "cheap", "free", "gambling", "loan", "loans",
               "lottery", "pill", "pills", "poker", "porn", "sex", "spam", "track", "tracker", "tracking", "viagra",
               "win", "xxx")
# Other words that are often run together with these in hosts.
SEEDS = (*BLOCK_WORDS, "best", "blog", "buy", "club", "deal", "example", "farm", "game", "games", "live", "mail",
         "market", "news", "online", "page", "pharmacy", "shop", "site", "sports", "store", "the", "today", "top",
         "web", "world")
SEED_COUNT = 1000
MIN_PART, MAX_WORD = 4, 20
LETTER = 3.0
PART = 1.5
RUN = 10.0
SMOOTHING = 50.0


def url_parts(url: Column) -> Column:
    """(host, path) of a URL."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    upper = "".join(chr(c) for c in range(65, 91))
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*).*$"
    return F.struct(F.translate(F.regexp_extract(url, pattern, 1), upper, upper.lower()).alias("host"),
                    F.regexp_extract(url, pattern, 2).alias("path"))


def rule_of(host: Column, path: Column) -> Column:
    """The longest rule that fits, or null."""
    out = F.lit(None).cast("string")
    for rule in sorted(RULES, key=len):  # the longest is asked first
        domain, _, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + rest)
        out = F.when(fits, rule).otherwise(out)
    return out


def chunks(text: Column) -> Column:
    """Runs of letters, in lower case."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda c: c != "")


def best_words(chunk: str, known: list[tuple[int, int, float]], letter: float, run: float = 0.0) -> list[str]:
    """The chunk's words of the highest total score.  ``known``: (start,
    length, score) of its substrings; a run of letters that are no word
    scores ``run`` and ``letter`` for each.  Of equal scores a known word wins over a
    run, and the longer last word wins."""
    ends: dict[int, list[tuple[int, float]]] = {}
    for start, length, p in sorted(known):
        ends.setdefault(start + length, []).append((start, p))
    # best score of the letters so far, behind a word and behind a run
    word, loose = [0.0] + [-math.inf] * len(chunk), [-math.inf] * (len(chunk) + 1)
    word_from, run_from = [0] * (len(chunk) + 1), [0] * (len(chunk) + 1)
    for end in range(1, len(chunk) + 1):
        for start, p in ends.get(end, ()):
            if (score := max(word[start], loose[start]) + p) > word[end]:
                word[end], word_from[end] = score, start
        begin, go_on = word[end - 1] + run + letter, loose[end - 1] + letter
        loose[end], run_from[end] = (begin, end - 1) if begin > go_on else (go_on, run_from[end - 1])
    words, end = [], len(chunk)
    while end:
        start = word_from[end] if word[end] >= loose[end] else run_from[end]
        words.append(chunk[start:end])
        end = start
    return words[::-1]


def segment(counts: DataFrame) -> DataFrame:
    """chunk, words of every chunk of ``counts`` (chunk, n, hosts)."""
    spark = counts.sparkSession
    seeds = spark.createDataFrame([(w, SEED_COUNT, True) for w in SEEDS], "word string, n long, seed boolean")
    own = counts.select(F.col("chunk").alias("word"), "n", F.lit(False).alias("seed"))
    unigrams = own.unionByName(seeds).groupBy("word").agg(F.sum("n").alias("n"), F.max("seed").alias("seed"))
    total = unigrams.agg(F.coalesce(F.sum("n"), F.lit(1)).cast("double").alias("total"))
    parts = attach_row(unigrams.where(F.col("seed") | F.length("word").between(MIN_PART, MAX_WORD)), total).select(
        "word", (F.log(F.col("n") / F.col("total")) - PART).alias("p"))
    size = F.length("chunk")
    spans = counts.select("chunk", size.alias("size"), F.explode(F.sequence(F.lit(1), size)).alias("start")).select(
        "chunk", "size", "start",
        F.explode(F.sequence(F.lit(1), F.least(F.lit(MAX_WORD), size - F.col("start") + 1))).alias("length"))
    found = (spans.where(F.col("length") < F.col("size")).withColumn("word", F.expr("substring(chunk, start, length)"))
             .join(parts, "word").groupBy("chunk")
             .agg(F.collect_list(F.struct(F.col("start") - 1, "length", "p")).alias("known")))
    seeded = F.when(F.col("chunk").isin(*SEEDS), SEED_COUNT).otherwise(0)
    table = attach_row(counts.join(found, "chunk", "left"), total).withColumn(
        "whole", F.log((F.col("n") + seeded) / F.col("total"))
        - F.when(seeded == 0, LETTER * size / F.col("hosts")).otherwise(0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True)
            out = [best_words(chunk, [(0, len(chunk), whole), *(tuple(k.values()) for k in known or ())],
                              -LETTER, -math.log(total) - RUN) for chunk, known, whole, total in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.string()))],
                                             names=["chunk", "words"])

    return table.select("chunk", "known", "whole", "total").mapInArrow(run, "chunk string, words array<string>")


def word_weights(urls: DataFrame, segmented: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(chunk, weight, its heaviest word and that one's weight) and the one-row
    prior, from the URLs' chunks."""
    listed = segmented.withColumn("bad", F.arrays_overlap("words", F.array(*map(F.lit, BLOCK_WORDS))))
    spread = urls.select("row", F.explode("chunks").alias("chunk"))
    marked = spread.join(listed.where("bad").select("chunk"), "chunk").select("row").distinct()
    flagged = stage(urls.join(marked.withColumn("bad", F.lit(1)), "row", "left")
                    .select("row", "chunks", F.coalesce("bad", F.lit(0)).alias("bad")), "url-classes")
    per_chunk = (flagged.select("bad", F.explode("chunks").alias("chunk")).groupBy("chunk")
                 .agg(F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good")))
    words = (per_chunk.join(segmented, "chunk").select("bad", "good", F.explode("words").alias("word"))
             .groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")))
    totals = words.agg(F.coalesce(F.sum("bad"), F.lit(0)).alias("all_bad"),
                       F.coalesce(F.sum("good"), F.lit(0)).alias("all_good"))
    share = SMOOTHING * (F.col("bad") + F.col("good")) / (F.col("all_bad") + F.col("all_good"))
    weight = (F.log((F.col("bad") + share) / (F.col("all_bad") + SMOOTHING))
              - F.log((F.col("good") + share) / (F.col("all_good") + SMOOTHING)))
    weights = attach_row(words, totals).select("word", weight.alias("w"))
    per_word = segmented.select("chunk", F.explode("words").alias("word")).join(weights, "word")
    prior = flagged.agg((F.log(F.coalesce(F.sum("bad"), F.lit(0)) + 1)
                         - F.log(F.count("*") - F.coalesce(F.sum("bad"), F.lit(0)) + 1)).alias("prior"))
    heaviest = F.max(F.struct(F.col("w").alias("top"), F.col("word").alias("top_word"))).alias("heaviest")
    return per_word.groupBy("chunk").agg(F.sum("w").alias("w"), heaviest), prior


def judge(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule, score (log odds of the block class), top_word
    (the word that speaks most for it), verdict."""
    both = url_parts(F.col("url"))
    parts = let(both, lambda u: F.struct(
        u["host"].alias("host"), u["path"].alias("path"),
        F.concat(chunks(u["host"]), chunks(u["path"])).alias("chunks")))
    urls = stage(pages.select(F.monotonically_increasing_id().alias("row"), F.col("page_id").cast("long").alias("page_id"),
                              parts.alias("u")).select("row", "page_id", "u.*"), "urls")
    spread = urls.select("row", F.explode("chunks").alias("chunk"))
    # counted by (chunk, host) first: a chunk that all hosts have is no hot key
    per_host = (urls.select("host", F.explode("chunks").alias("chunk")).groupBy("chunk", "host")
                .agg(F.count("*").alias("n")))
    counts = stage(per_host.groupBy("chunk").agg(F.sum("n").alias("n"), F.count("*").alias("hosts")), "chunks")
    segmented = stage(segment(counts), "segments")
    weights, prior = word_weights(urls, segmented)
    scores = (spread.join(weights, "chunk").groupBy("row")
              .agg(F.sum("w").alias("w"), F.max("heaviest").alias("heaviest")))
    scored = attach_row(urls.drop("chunks").join(scores, "row", "left"), prior)
    host, path = F.col("host"), F.col("path")
    score = F.col("prior") + F.coalesce("w", F.lit(0.0))
    rule = rule_of(host, path)
    ruled = F.create_map(*(F.lit(x) for kv in RULES.items() for x in kv))
    verdict = F.coalesce(ruled[F.col("rule")], F.when(F.col("score") > 0, "block").otherwise("allow"))
    return (scored.select("page_id", "host", "path", rule.alias("rule"), score.alias("score"),
                          F.col("heaviest.top_word").alias("top_word"))
            .withColumn("verdict", verdict))


def op7(pages: DataFrame) -> DataFrame:
    return judge(pages).select("page_id", "host", "path", "rule", "verdict", "score", "top_word")
