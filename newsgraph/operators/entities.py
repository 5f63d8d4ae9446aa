"""Entity typing: D9 gazetteer mentions, F3 first mentions, D5 tag lookup,
E7 zero-shot top label, I13 coarse/fine typing, H3 ordering (J5)."""
from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scoring import char_overlap
from ..session import materialize, stage_table
from . import automaton
from .common import BROADCAST_BYTES, attach_row, bounded_broadcast, measured_broadcast


def gazetteer_mentions(df: DataFrame, gazetteer: DataFrame, text_col: str = "text",
                       id_col: str = "article_id", max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Dictionary NER.  ``gazetteer(phrase, entity_group)``; phrases are
    matched as whole runs of space-separated tokens, longest match first,
    left to right, without overlaps.  Returns ``(article_id, pos, word,
    entity_group)`` with ``pos`` the token position.

    A gazetteer of at most ``max_bytes`` (counted) goes to the workers as an
    automaton that reads each text once; a larger one is joined with the texts'
    token runs.  Rows without a phrase or group are no entries.  A phrase with several groups has the first of them."""
    rows = automaton.small_rows(gazetteer.select("phrase", "entity_group"), max_bytes)
    if rows is not None:
        return automaton.mentions(df, rows, text_col, id_col)
    return _mentions_by_join(df, gazetteer, text_col, id_col)


def _mentions_by_join(df: DataFrame, gazetteer: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """``gazetteer_mentions`` for a gazetteer of any size: one shuffled row for
    each token run as long as some phrase."""
    gazetteer = gazetteer.where("entity_group is not null").groupBy("phrase").agg(F.min("entity_group").alias("entity_group"))
    g = gazetteer.select(F.col("phrase"), "entity_group",
                         F.size(F.split("phrase", " ")).alias("plen"))
    max_len = g.agg(F.max("plen")).first()[0] or 1
    toks = df.select(id_col, F.posexplode(F.split(text_col, " ")).alias("pos", "tok"))
    w = W.partitionBy(id_col).orderBy("pos")
    grams = toks
    for i in range(1, max_len):
        grams = grams.withColumn(f"_n{i}", F.lead("tok", i).over(w))
    cands = []
    for ln in range(1, max_len + 1):
        parts = [F.col("tok")] + [F.col(f"_n{i}") for i in range(1, ln)]
        cands.append(grams.select(id_col, "pos", F.lit(ln).alias("plen"),
                                  F.concat_ws(" ", *parts).alias("phrase"),
                                  (F.col(f"_n{ln - 1}").isNotNull() if ln > 1 else F.lit(True)).alias("_ok")))
    allc = cands[0]
    for c in cands[1:]:
        allc = allc.unionByName(c)
    hits = allc.where("_ok").join(g, ["phrase", "plen"])
    # longest match at each start; then a left-to-right greedy pass over the
    # article's matches (one array per article, bounded by its text) keeps a
    # match only if it starts at or after the end of the last kept one
    best = (hits.groupBy(id_col, "pos")
            .agg(F.max_by(F.struct("plen", "phrase", "entity_group"), "plen").alias("m")))
    per = best.groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct("pos", "m"))).alias("ms"))
    init = F.struct(F.lit(0).alias("reach"),
                    F.array().cast("array<struct<pos:int,word:string,entity_group:string>>").alias("kept"))
    scan = F.aggregate("ms", init, lambda acc, x: F.when(
        x["pos"] >= acc["reach"],
        F.struct((x["pos"] + x["m"]["plen"]).alias("reach"),
                 F.concat(acc["kept"], F.array(F.struct(x["pos"].cast("int").alias("pos"),
                                                        x["m"]["phrase"].alias("word"),
                                                        x["m"]["entity_group"].alias("entity_group"))))
                 .alias("kept"))).otherwise(acc))
    return (per.select(id_col, F.explode(scan["kept"]).alias("k"))
            .select(id_col, "k.pos", "k.word", "k.entity_group"))


def first_mentions(mentions: DataFrame, id_col: str = "article_id") -> DataFrame:
    """first mention of each word in an article (its tag wins).  The first
    position is taken over the article's rows of the word, so mentions that
    are dealt by article already are not dealt again."""
    known = mentions.where(F.col(id_col).isNotNull() & F.col("word").isNotNull())
    first = F.min("pos").over(W.partitionBy(id_col, "word"))
    # (article, pos) identifies a mention, so this keeps one row
    return (known.withColumn("_first", first).where(F.col("pos") == F.col("_first"))
            .select(id_col, "pos", "word", "entity_group"))


def tag_to_coarse(first: DataFrame, tag_map: DataFrame) -> DataFrame:
    """Tag -> coarse class; unmapped tags get type 'none' and
    ``branch`` 1 (the MISC list), mapped ones ``branch`` 0."""
    tm = bounded_broadcast(tag_map.select("entity_group", "type").dropDuplicates(["entity_group"]))
    j = first.join(tm, "entity_group", "left")
    return j.select(*first.columns, F.coalesce("type", F.lit("none")).alias("type"),
                    F.when(F.col("type").isNull(), 1).otherwise(0).alias("branch"))


def top_label(words: DataFrame, labels: DataFrame, scorer=char_overlap,
              word_col: str = "word", out_col: str = "label") -> DataFrame:
    """Best candidate label per distinct word: highest score, ties to the
    lowest label ordinal.  ``labels(name, ord)`` is the candidate class list.

    ``scorer`` is either a column function ``(word, label) -> score`` —
    then the (small) label list is packed into one array, a global
    aggregate of one row, and every word scores it in-row, so no
    word x label join is materialised — or a score table ``(word, label,
    score)`` from a model, joined on the word; only the labels it scores
    are candidates, and a word it does not score gets the lowest-ordinal
    label."""
    d = words.select(word_col).distinct()
    if isinstance(scorer, DataFrame):
        labs = bounded_broadcast(labels.select("name", "ord"))
        sc = (scorer.select(F.col("word").alias(word_col), F.col("label").alias("name"), "score")
              .join(labs, "name"))
        # aggregate the label ordinal (fixed width: a hash aggregate), then
        # name it from the bounded label table
        best = (d.join(sc, word_col)
                .groupBy(word_col).agg(F.max_by("ord", F.struct("score", (-F.col("ord")).alias("o")))
                                       .alias("_o"))
                .join(labs.select(F.col("ord").alias("_o"), F.col("name").alias(out_col)), "_o")
                .drop("_o"))
        first = labels.agg(F.min_by("name", "ord").alias("_first"))
        return (attach_row(d.join(best, word_col, "left"), first)
                .select(word_col, F.coalesce(out_col, "_first").alias(out_col)))
    packed = labels.agg(F.sort_array(F.collect_list(F.struct("ord", "name"))).alias("_labs"))
    d = attach_row(d, packed)
    best = F.array_max(F.transform("_labs", lambda l: F.struct(
        scorer(F.col(word_col), l["name"]).alias("s"), (-l["ord"]).alias("o"), l["name"].alias("n"))))
    return d.select(word_col, best["n"].alias(out_col))


def seen_words(mentions: DataFrame) -> DataFrame:
    """The distinct (word, entity_group): what typing needs of the mentions
    before their first ones are known."""
    return mentions.select("word", "entity_group").distinct()


def coarse_types(mentions: DataFrame, tag_map: DataFrame, coarse: DataFrame,
                 scorer=char_overlap, id_col: str = "article_id", seen: DataFrame | None = None) -> DataFrame:
    """J5 first half: first mentions, tag lookup, and the zero-shot coarse
    label for the unmapped ones (scored once per distinct word).  The words
    are those of all mentions with an unmapped tag (``seen``, else found here),
    and their labels are broadcast where they are few enough, so that the
    mentions are not dealt by word."""
    t = tag_to_coarse(first_mentions(mentions, id_col), tag_map)
    misc = tag_to_coarse(seen if seen is not None else seen_words(mentions), tag_map).where("branch = 1")
    lab = measured_broadcast(top_label(misc, coarse, scorer))
    return (t.join(lab, "word", "left")
            .withColumn("type", F.when(F.col("branch") == 1, F.col("label")).otherwise(F.col("type")))
            .drop("label"))


def fine_types(coarse_df: DataFrame, fine: DataFrame, keep: str = "Person",
               scorer=char_overlap, id_col: str = "article_id", seen: DataFrame | None = None) -> DataFrame:
    """Entities typed ``keep`` stay coarse; all others get the best
    fine label among *all* fine classes.  Output order key ``eord`` puts the
    re-typed entities first and the kept ones last (H3), each in coarse
    order (mapped before unmapped, then position).  ``seen`` may give the
    words to score, at least those not typed ``keep``."""
    lab = measured_broadcast(top_label(seen if seen is not None else coarse_df.where(F.col("type") != keep),
                                       fine, scorer))
    j = coarse_df.join(lab, "word", "left")
    kept = F.col("type") == keep
    return j.select(id_col, F.col("word").alias("text"),
                    F.when(kept, F.col("type")).otherwise(F.col("label")).alias("type"),
                    F.struct(kept.cast("int").alias("k"), F.col("branch").alias("b"),
                             F.col("pos").alias("p")).alias("eord"))


def extract_entities(mentions: DataFrame, tag_map: DataFrame, onto: dict[str, DataFrame],
                     root: str = "Entity", keep: str = "Person", scorer=char_overlap,
                     id_col: str = "article_id", checkpoint: bool = True) -> DataFrame:
    """``(article_id, text, type, eidx)`` with ``eidx`` the 0-based
    position of the entity in the article's list."""
    from .ontology import class_levels
    coarse, fine = class_levels(onto["class"], root)
    seen = materialize(seen_words(mentions))
    ft = fine_types(coarse_types(mentions, tag_map, coarse, scorer, id_col, seen), fine, keep, scorer, id_col, seen)
    out = ft.withColumn("eidx", (F.row_number().over(W.partitionBy(id_col).orderBy("eord")) - 1).cast("int")) \
        .drop("eord")
    # the entity table feeds the pair join (twice), the naming of triplets
    # (twice) and the record; it is written once
    return stage_table(out, "entities") if checkpoint else out
