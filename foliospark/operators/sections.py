"""Sections of a volume: runs of entries under one heading, their continuation over ranges, ancestors, groups of two editions."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions.keys import ROOT
from foliospark.functions.similarity import jaro_winkler
from foliospark.functions.text import title_level
from foliospark.operators import blocks
from foliospark.operators.graph import components
from foliospark.operators.sequence import align_rows

THRESHOLD = 0.8


def ancestors(entities: DataFrame, depth: int = 100) -> DataFrame:
    """document, uuid, section_uuid, section_markdown: of each entity its nearest title of level 2 above it, else of level 1; null without.

    The titles of a document (few, and each is read by its document only) travel as one map; cycles end the walk.
    """
    titles = entities.where(F.col("entity") == "TITLE").groupBy("document").agg(F.map_from_entries(F.collect_list(F.struct("uuid", F.struct("parent_uuid", "markdown")))).alias("titles"))
    rows = entities.join(titles, "document", "left").select("document", "uuid", "parent_uuid", F.coalesce("titles", F.create_map().cast("map<string,struct<parent_uuid:string,markdown:string>>")).alias("titles"))
    up = lambda a: F.try_element_at(F.col("titles"), F.element_at(a, -1))["parent_uuid"]
    path = F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.array("parent_uuid"), lambda a, _: F.when(up(a).isNull() | F.array_contains(a, F.coalesce(up(a), F.lit(ROOT))), a).otherwise(F.concat(a, F.array(up(a)))))
    met = F.filter(F.transform(path, lambda u: F.struct(u.alias("uuid"), F.try_element_at(F.col("titles"), u)["markdown"].alias("markdown"))), lambda x: x["markdown"].isNotNull())
    rows = rows.withColumn("path", met)
    at = lambda n: F.get(F.filter("path", lambda x: title_level(x["markdown"]) == n), F.lit(0))
    return rows.withColumn("s", F.coalesce(at(2), at(1))).select("document", "uuid", F.col("s.uuid").alias("section_uuid"), F.col("s.markdown").alias("section_markdown"))


def continue_sections(records: DataFrame, size: int = blocks.SIZE) -> DataFrame:
    """records (volume, order, section, section_uuid, section_inserted): one under a heading put in by hand with the key of the record before takes that one's section_uuid.

    What is taken is passed on, so a run takes the uuid it begins with.
    """
    met = blocks.lagged(records, ["volume"], "order", {"section_uuid": "__uuid", "section": "__section"}, size)
    goes_on = F.col("section_inserted") & (F.coalesce("__uuid", F.lit("")) != "") & F.col("section").eqNullSafe(F.col("__section"))
    met = blocks.running_sum(met, ["volume"], "order", (~F.coalesce(goes_on, F.lit(False))).cast("int"), "__run", size).drop("__uuid", "__section")
    first = met.groupBy(F.col("volume").alias("__v"), F.col("__run").alias("__r")).agg(F.min_by("section_uuid", "order").alias("__first"))
    out = met.join(first, F.col("volume").eqNullSafe(F.col("__v")) & (F.col("__run") == F.col("__r")))
    return out.withColumn("section_uuid", F.col("__first")).select(*records.columns)


def runs(records: DataFrame, size: int = blocks.SIZE) -> DataFrame:
    """Adds run, from 0: a new one wherever (section_uuid, section) changes."""
    met = blocks.lagged(records.withColumn("__here", F.lit(True)), ["volume"], "order", {"section_uuid": "__uuid", "section": "__section", "__here": "__any"}, size)
    same = F.col("section_uuid").eqNullSafe(F.col("__uuid")) & F.col("section").eqNullSafe(F.col("__section")) & F.col("__any").isNotNull()
    out = blocks.running_sum(met, ["volume"], "order", (~same).cast("int"), "run", size)
    return out.withColumn("run", F.col("run") - 1).drop("__uuid", "__section", "__any", "__here")


def sections(records: DataFrame) -> DataFrame:
    """volume, run, section_uuid, section, first, last, entries."""
    return runs(records).groupBy("volume", "run", "section_uuid", "section").agg(F.min("order").alias("first"), F.max("order").alias("last"), F.count(F.lit(1)).alias("entries"))


def manual_groups(pairs: DataFrame) -> DataFrame:
    """side, uuid, group: connected components of hand-made pairs (left_uuid, right_uuid), named by their smallest left uuid."""
    edges = pairs.where((F.col("left_uuid") != "") & (F.col("right_uuid") != "")).select(F.concat(F.lit("l"), "left_uuid").alias("a"), F.concat(F.lit("r"), "right_uuid").alias("b"))
    # l stands before r: the smallest name of a component is that of a left section
    found = components(edges)
    return found.select(F.when(F.col("node").startswith("l"), "left").otherwise("right").alias("side"), F.expr("substring(node, 2)").alias("uuid"), F.expr("substring(root, 2)").alias("group"))


def align_pair(left: DataFrame, right: DataFrame, patch: DataFrame | None = None, threshold: float = THRESHOLD, pair: str = "pair") -> DataFrame:
    """pair, left_run, right_run, source of sections (pair, run, section, section_uuid): hand-made groups first, the rest in order by their keys.

    patch: left_uuid, right_uuid of sections. A section that it names, alone too, is never paired by its key; every left
    section of a group meets every right one.
    """
    if patch is None:
        return align_sections(left, right, threshold, pair).withColumn("source", F.lit("auto"))
    free = [df.join(patch.select(F.col(f"{side}_uuid").alias("section_uuid")).where(F.col("section_uuid") != "").distinct(), "section_uuid", "left_anti") for df, side in ((left, "left"), (right, "right"))]
    auto = align_sections(*free, threshold, pair).withColumn("source", F.lit("auto"))
    groups = manual_groups(patch)
    named = [df.select(pair, F.col("run").alias(f"{side}_run"), F.col("section_uuid").alias("uuid")).join(groups.where(F.col("side") == side), "uuid").select(pair, "group", f"{side}_run") for df, side in ((left, "left"), (right, "right"))]
    manual = named[0].join(named[1], [pair, "group"]).select(pair, "left_run", "right_run", F.lit("manual").alias("source"))
    return auto.unionByName(manual.select(*[F.col(c).cast(auto.schema[c].dataType) for c in auto.columns]))


def _key_rows(left: list[str], right: list[str]) -> Iterator[np.ndarray]:
    """Row after row of the keys' similarities; two keys are compared once, and rows of a key that comes again are held."""
    names = list(dict.fromkeys(right))
    of, often = {y: k for k, y in enumerate(names)}, Counter(left)
    at = np.array([of[y] for y in right], dtype=np.int64)
    held: dict[str, np.ndarray] = {}
    for x in left:
        row = held.get(x)
        if row is None:
            row = np.array([jaro_winkler(x, y) for y in names], dtype=float)
            if often[x] > 1:
                held[x] = row
        yield row[at]


def align_sections(left: DataFrame, right: DataFrame, threshold: float = THRESHOLD, pair: str = "pair") -> DataFrame:
    """pair, left_run, right_run: sections (pair, run, section, section_uuid) of two editions paired in order by their keys.

    Sections without a title's uuid are never paired. One task per pair of volumes, which have some hundred sections.
    """
    keep = lambda df: df.where(F.coalesce("section_uuid", F.lit("")) != "").select(pair, "run", "section")

    def work(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        a, b = a.sort_values("run"), b.sort_values("run")
        found = align_rows(_key_rows(a["section"].tolist(), b["section"].tolist()), len(a), len(b), threshold)
        return pd.DataFrame({pair: [key[0]] * len(found), "left_run": a["run"].to_numpy()[[i for i, _ in found]], "right_run": b["run"].to_numpy()[[j for _, j in found]]})

    kind = left.schema[pair].dataType.simpleString()
    return keep(left).groupBy(pair).cogroup(keep(right).groupBy(pair)).applyInPandas(work, f"`{pair}` {kind}, left_run long, right_run long")


def canonical_keys(groups: DataFrame) -> DataFrame:
    """side, section, canonical from groups (group_rank, side, section, left_rank): the key of a group's first left section; a later group wins."""
    first = groups.where(F.col("side") == "left").groupBy("group_rank").agg(F.min_by("section", "left_rank").alias("canonical"))
    return groups.join(first, "group_rank").groupBy("side", "section").agg(F.max_by("canonical", "group_rank").alias("canonical"))
