"""J1 task-list pipeline: named stages in the user's order, each replacing
the working table, each optionally writing its per-day output (B1/B7).

With a run folder it is resumable: a stage's table is kept under a key of
everything that went into it, and a rerun starts behind the last stage whose
table is there."""
from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.scoring import char_overlap
from ..operators import dedup, entities, relations, relevance, sentences
from ..session import materialize
from ..sinks.writers import stage_path, write_by_day, write_triplets
from ..sources import files


@dataclass
class PipelineConfig:
    """Everything the stages need; one object instead of the reference's
    two argument parsers."""
    output_path: str | None = None        # None: no per-stage files
    lang_mode: str = "ENG"                 # ENG / KOR (KOR dedups on text)
    relevance_scorer: object = None        # K1 scorer for `filter`
    relevance_threshold: float = -0.4
    token_labeler: Callable[[Column], Column] | None = None  # text -> array<struct<token,label>>
    eps: float = 0.35
    translate_fn: Callable[[Column], Column] | None = None
    glossary: DataFrame | dict | None = None
    translate_mode: int = 1
    summary_k: int = 3
    # extract_entities, extract_relations: D9 gazetteer (or mentions of a tagger), tags, ontology
    gazetteer: DataFrame | None = None     # (phrase, entity_group)
    mentions: DataFrame | None = None      # (article_id, pos, word, entity_group); instead of the gazetteer
    tag_map: DataFrame | None = None       # (entity_group, type)
    ontology: dict | None = None           # the five tables of read_ontology
    entity_scorer: object = char_overlap
    relation_scorer: object = None         # None: share of the hypothesis' tokens
    relation_threshold: float = 0.78
    premise_col: str = "translated_summary"
    extra_stages: dict = field(default_factory=dict)
    # resumable runs: names for settings that are no plain value ("field": "name of its version"),
    # and for extra stages ("stage": "version")
    versions: dict = field(default_factory=dict)


def preprocess(df: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Normalise the text; with a token labeler, keep the tokens whose
    label is not the language's drop label (1 for ENG, 0 otherwise)."""
    out = df.withColumn("text", tx.normalize_text("text"))
    if cfg.token_labeler is not None:
        drop = 1 if cfg.lang_mode == "ENG" else 0
        toks = cfg.token_labeler(F.col("text"))
        kept = F.filter(toks, lambda x: x["label"] != drop)
        out = out.withColumn("text", tx.strip_subword_marker(F.array_join(F.transform(kept, lambda x: x["token"]), " ")))
    return out


def filter_stage(df: DataFrame, cfg: PipelineConfig) -> DataFrame:
    if cfg.relevance_scorer is None:
        raise ValueError("filter needs PipelineConfig.relevance_scorer")
    return relevance.relevance_filter(df, cfg.relevance_scorer, cfg.relevance_threshold, keep_score=False)


def erase_similar_stage(df: DataFrame, cfg: PipelineConfig) -> DataFrame:
    text_col = "text" if cfg.lang_mode == "KOR" else "title"
    return dedup.erase_similar(df, cfg.eps, text_col=text_col)


def split_stage(df: DataFrame, cfg: PipelineConfig) -> DataFrame:
    return sentences.split_sentences(df)


def translate_stage(df: DataFrame, cfg: PipelineConfig) -> DataFrame:
    if cfg.glossary is not None and cfg.translate_mode == 1:
        return sentences.glossary_map(df, cfg.glossary)
    if cfg.translate_fn is None:
        raise ValueError("translate needs PipelineConfig.glossary or translate_fn")
    return sentences.translate(df, cfg.translate_fn, cfg.translate_mode)


def summarize_stage(df: DataFrame, cfg: PipelineConfig) -> DataFrame:
    base = df if "split_text" in df.columns else sentences.split_sentences(df)
    return sentences.extractive_summary(base, k=cfg.summary_k)


def _need(cfg: PipelineConfig, stage: str, *names: str) -> None:
    missing = [n for n in names if getattr(cfg, n) is None]
    if missing:
        raise ValueError(f"{stage} needs PipelineConfig.{', '.join(missing)}")


def entities_stage(df: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """J5 on the working table: ``found_entities array<struct<text,type>>`` of
    the premise text, in entity order; articles without any keep an empty list."""
    _need(cfg, "extract_entities", "tag_map", "ontology")
    found = cfg.mentions
    if found is None:
        _need(cfg, "extract_entities", "gazetteer")
        found = entities.gazetteer_mentions(df, cfg.gazetteer, cfg.premise_col)
    ents = entities.extract_entities(found, cfg.tag_map, cfg.ontology, scorer=cfg.entity_scorer)
    return relations.attach_entities(df.drop("found_entities"), ents)


def relations_stage(df: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """J6 on the working table: ``found_relations`` between the entities of
    ``found_entities``."""
    _need(cfg, "extract_relations", "ontology")
    if "found_entities" not in df.columns:
        raise ValueError("extract_relations needs the column found_entities; run extract_entities before it")
    ents = materialize(df.select("article_id", F.posexplode("found_entities").alias("eidx", "_e"))
                       .select("article_id", "eidx", "_e.text", "_e.type"))
    kw = {} if cfg.relation_scorer is None else {"scorer": cfg.relation_scorer}
    return relations.extract_relations(df.drop("found_entities", "found_relations"), ents, cfg.ontology,
                                       threshold=cfg.relation_threshold, premise_col=cfg.premise_col, **kw)


STAGES: dict[str, Callable[[DataFrame, PipelineConfig], DataFrame]] = {
    "preprocess": preprocess,
    "filter": filter_stage,
    "erase_similar": erase_similar_stage,
    "split_sentence": split_stage,
    "translate": translate_stage,
    "summarize": summarize_stage,
    "extract_entities": entities_stage,
    "extract_relations": relations_stage,
}

# The settings each stage reads: a change of one of them is a change of the stage.
STAGE_SETTINGS = {
    "preprocess": ("lang_mode", "token_labeler"),
    "filter": ("relevance_scorer", "relevance_threshold"),
    "erase_similar": ("lang_mode", "eps"),
    "split_sentence": (),
    "translate": ("glossary", "translate_fn", "translate_mode"),
    "summarize": ("summary_k",),
    "extract_entities": ("gazetteer", "mentions", "tag_map", "ontology", "entity_scorer", "premise_col"),
    "extract_relations": ("ontology", "relation_scorer", "relation_threshold", "premise_col"),
}

_DEFAULTS = PipelineConfig()


def stage_keys(tasks: list[str], cfg: PipelineConfig, input_version: str) -> list[str]:
    """One key per stage: a hash of the key before it, its name and its
    settings (the first key: of the input's version).

    Plain settings count by value.  A function, column or table cannot be
    hashed reliably, so it counts by the name that ``cfg.versions`` gives
    it; one without a name raises."""
    key = hashlib.sha256(f"input:{input_version}".encode()).hexdigest()
    keys = []
    for at, task in enumerate(tasks):
        settings = {}
        if task in cfg.extra_stages:
            if task not in cfg.versions:
                raise ValueError(f"a resumable run needs PipelineConfig.versions[{task!r}]")
            settings["stage"] = cfg.versions[task]
        else:
            for name in STAGE_SETTINGS[task]:
                value = getattr(cfg, name)
                if name in cfg.versions:
                    settings[name] = {"version": cfg.versions[name]}
                elif value is None or isinstance(value, (str, int, float)):
                    settings[name] = value
                elif value is getattr(_DEFAULTS, name):
                    settings[name] = {"default": name}
                else:
                    raise ValueError(f"a resumable run needs PipelineConfig.versions[{name!r}]")
        said = json.dumps([key, at, task, settings], sort_keys=True)
        key = hashlib.sha256(said.encode()).hexdigest()
        keys.append(key)
    return keys


def _publish(df: DataFrame, task: str, cfg: PipelineConfig) -> None:
    if cfg.output_path and task == "extract_relations":
        write_triplets(df, f"{cfg.output_path}/triplets", premise_col=cfg.premise_col)
    elif cfg.output_path:
        write_by_day(df, stage_path(cfg.output_path, task), "json")


def run_pipeline(df: DataFrame, tasks: list[str], cfg: PipelineConfig | None = None,
                 run_path: str | None = None, input_version: str | None = None) -> DataFrame:
    """Apply the named stages in order.  Unknown names fail before any work
    runs.  With ``output_path`` each stage's table is materialised once (a
    checkpoint into the shared folder), written per day under its stage folder
    (``extract_relations``: the triplet records, under ``triplets``), and is what
    the next stage reads, so no stage runs twice; without it the returned
    DataFrame stays lazy.

    ``run_path``, a folder all executors share, makes the run resumable:
    stage ``i`` is kept as Parquet in ``<run_path>/<i>-<stage>-<key>`` and marked
    done by one rename after its per-day output is written.  A rerun reads the
    last marked stage of its keys and runs only those behind it; a stage that
    failed half way has no mark and is written anew.  ``input_version``
    names the input's state (e.g. the version of a ``DayTable``): rows of
    another version never count as done."""
    cfg = cfg or PipelineConfig()
    registry = {**STAGES, **cfg.extra_stages}
    unknown = [t for t in tasks if t not in registry]
    if unknown:
        raise ValueError(f"unknown task(s) {unknown}; known: {sorted(registry)}")
    if run_path is not None:
        return _run_resumable(df, tasks, cfg, registry, run_path, input_version)
    for t in tasks:
        df = registry[t](df, cfg)
        if cfg.output_path:
            df = materialize(df)
            _publish(df, t, cfg)
    return df


def _run_resumable(df: DataFrame, tasks: list[str], cfg: PipelineConfig, registry: dict, run_path: str,
                   input_version: str | None) -> DataFrame:
    if input_version is None:
        raise ValueError("a resumable run needs input_version")
    spark = df.sparkSession
    keys = stage_keys(tasks, cfg, input_version)
    folders = [f"{run_path.rstrip('/')}/{i:02d}-{t}-{k[:32]}" for i, (t, k) in enumerate(zip(tasks, keys))]
    # the outputs' place is no setting of a stage: a mark holds for the place it was written to
    mark = "done-" + hashlib.sha256(str(cfg.output_path).encode()).hexdigest()[:16]
    first = 0
    for i in reversed(range(len(tasks))):
        if files.exists(spark, f"{folders[i]}/{mark}"):
            df, first = _read_stage(spark, folders[i]), i + 1
            break
    for task, folder in zip(tasks[first:], folders[first:]):
        registry[task](df, cfg).write.mode("overwrite").parquet(f"{folder}/rows")
        df = _read_stage(spark, folder)
        _publish(df, task, cfg)
        files.publish_text(spark, f"{folder}/{mark}", json.dumps({"stage": task}))
    return df


def _read_stage(spark, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/rows")
