"""D4 class closure, D6 class levels, D3/H4 ontology-compatible relations.

The ontology is five tables: ``class(name, parent)`` (a class may appear
with several parents), ``property(name, ord)``, ``domain(prop, class)``,
``range(prop, class)``, ``template(prop, ord, text)``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def class_closure(classes: DataFrame) -> DataFrame:
    """``(name, ancestor)`` reflexive-transitive closure of ``parent``.

    Breadth-first: each round joins the pairs found last with ``parent`` and
    keeps those not known yet, until none are new; several parents add no
    repeated pairs and a cycle ends like any other hierarchy.  Every round's
    pairs are materialised, so a round reads only the one before it."""
    edges = materialize(classes.where(F.col("parent").isNotNull()).select("name", "parent").distinct())
    names = classes.select("name").unionByName(edges.select(F.col("parent").alias("name"))).distinct()
    known = materialize(names.select("name", F.col("name").alias("ancestor")))
    new = known
    while True:
        step = (new.alias("p").join(edges.alias("e"), F.col("p.ancestor") == F.col("e.name"))
                .select(F.col("p.name").alias("name"), F.col("e.parent").alias("ancestor")).distinct())
        new = materialize(step.join(known, ["name", "ancestor"], "left_anti"))
        if new.isEmpty():
            return known
        known = known.unionByName(new)


def class_levels(classes: DataFrame, root: str = "Entity") -> tuple[DataFrame, DataFrame]:
    """Coarse classes = direct subclasses of ``root``; fine classes =
    direct subclasses of a coarse class.  Returns ``(coarse(name, ord),
    fine(name, ord))``, ordinals by name for a stable label order."""
    c = classes.select("name", "parent").distinct()
    coarse = c.where(F.col("parent") == root).select("name").distinct()
    fine = (c.join(coarse.withColumnRenamed("name", "parent"), "parent")
            .select("name").distinct())
    from pyspark.sql import Window as W
    o = W.orderBy("name")
    return (coarse.withColumn("ord", F.row_number().over(o) - 1),
            fine.withColumn("ord", F.row_number().over(o) - 1))


def candidate_relations(onto: dict[str, DataFrame]) -> DataFrame:
    """D3: ``(sbj_type, obj_type, prop, prop_ord)`` such that an ancestor of
    the subject type is in the property's domain and an ancestor of the
    object type is in its range.  A property with an empty domain or range
    matches nothing.  Computed once per ontology dict and kept in it."""
    if "_cands" in onto:
        return onto["_cands"]
    clo = class_closure(onto["class"])
    sd = (clo.join(onto["domain"], clo.ancestor == onto["domain"]["class"])
          .select(F.col("name").alias("sbj_type"), "prop").distinct())
    ro = (clo.join(onto["range"], clo.ancestor == onto["range"]["class"])
          .select(F.col("name").alias("obj_type"), "prop").distinct())
    props = onto["property"].select(F.col("name").alias("prop"), F.col("ord").alias("prop_ord"))
    onto["_cands"] = materialize(sd.join(ro, "prop").join(props, "prop")
                                 .select("sbj_type", "obj_type", "prop", "prop_ord"))
    return onto["_cands"]
