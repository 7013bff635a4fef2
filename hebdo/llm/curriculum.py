"""Mixing sources to target weights along a time-varying curriculum.

Targets share a budget of words by weight, none above a multiple of what its
source holds. A source's documents lie in a fixed random order on a line of
words; the target covers the line once, twice, ... up to its length. Over the
course of training each source's weight changes linearly; the integral of its
schedule, inverted at the cumulative demand of a document, is the position at
which the document is shown.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hebdo.llm.common import stash, text_or_empty

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class MixParams:
    weights: tuple[int, ...] = (5, 2, 1)     # by rank of the source, repeating
    slopes: tuple[float, ...] = (-0.5, 0.0, 0.5)  # weight over time: 1 + slope * (2 u - 1), repeating
    budget: float = 1.5                      # of all words
    repeats: int = 2                         # a source and a document are taken so many times at most
    buckets: int = 4096                      # slices of a source's line, so that no source meets in one task
    seed: int = 7


def _cycle(rank: Column, values: tuple) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), (F.pmod(rank - 1, F.lit(len(values))) + 1).cast("int"))


def targets(sources: DataFrame, params: MixParams) -> DataFrame:
    """sources(skey, source, source_size), one row per source -> with slope and target.

    The windows run over the table of sources only.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    s = (sources.withColumn("rank", rank).withColumn("weight", _cycle(F.col("rank"), params.weights))
         .withColumn("slope", _cycle(F.col("rank"), params.slopes))
         .withColumn("cap", (F.col("source_size") * params.repeats).cast("double")))
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    s = (s.withColumn("budget", F.sum("source_size").over(every) * params.budget)
         .withColumn("cap_before", F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap"))
         .withColumn("weight_from", F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("capped", F.col("weight") * (F.col("budget") - F.col("cap_before")) >= F.col("cap") * F.col("weight_from")))
    level = ((F.first("budget").over(every) - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(every), F.lit(0.0)))
             / F.sum(F.when(~F.col("capped"), F.col("weight"))).over(every))
    return s.withColumn("level", level).select(
        "skey", "source_size", "slope",
        F.when(F.col("capped"), F.col("cap")).otherwise(F.col("weight") * F.col("level")).alias("target"))


def position(share: Column, slope: Column) -> Column:
    """The time at which the integral of a linear schedule reaches ``share`` (both 0 to 1)."""
    root = F.sqrt(F.greatest((1 - slope) * (1 - slope) + 4 * slope * share, F.lit(0.0)))
    return F.when(slope == 0, share).otherwise((root - (1 - slope)) / (2 * slope))


def mix_plan(docs: DataFrame, params: MixParams | None = None, id_col: str = "doc_id",
             source_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``, range-sorted by first position:
    (id_col, skey, tie, size, source_size, target, taken, passes), passes being
    an array of (position, words) of the document's showings.

    A null text has size 0, a null source is a source of its own, last in
    order. Each source's taken words sum to its rounded target: the document
    on the boundary is taken in part. Rows equal in id, text and source are
    interchangeable, so reruns agree.
    """
    params = params or MixParams()
    text = text_or_empty(text_col)
    size = stash(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                             F.when(F.col(source_col).isNull(), "n").otherwise(
                                 F.concat(F.lit("s"), F.col(source_col))).alias("skey"),
                             F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
                             F.xxhash64(text).alias("tie")))
    size = size.withColumn("order", F.xxhash64(F.lit(params.seed), "id", "tie"))
    size = size.withColumn("bucket", F.pmod(F.shiftrightunsigned("order", 40), F.lit(params.buckets)))
    goal = targets(size.groupBy("skey").agg(F.first("source").alias("source"),
                                            F.sum("size").alias("source_size")), params)
    slices = size.groupBy("skey", "bucket").agg(F.sum("size").alias("words"))
    up_to = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    slices = (slices.withColumn("base", F.sum("words").over(up_to) - F.col("words")).drop("words").join(goal, "skey"))
    within = (Window.partitionBy("skey", "bucket").orderBy("order", "id", "tie", "size")
              .rowsBetween(Window.unboundedPreceding, 0))
    line = (size.withColumn("before", F.sum("size").over(within) - F.col("size"))
            .join(slices, ["skey", "bucket"]).withColumn("goal", F.floor(F.col("target") + 0.5))
            .withColumn("before", F.col("base") + F.col("before")))
    shown = []
    for i in range(params.repeats):
        start = F.col("before") + i * F.col("source_size")
        words = F.greatest(F.least(F.col("goal") - start, F.col("size")), F.lit(0))
        share = (start + words / 2) / F.greatest(F.col("goal"), F.lit(1))
        shown.append(F.struct(F.when(words > 0, position(share, F.col("slope"))).alias("position"),
                              words.alias("words")))
    passes = F.filter(F.array(*shown), lambda p: p["words"] > 0)
    return (line.withColumn("passes", passes)
            .withColumn("taken", F.aggregate("passes", F.lit(0).cast("long"), lambda a, p: a + p["words"]))
            .withColumn("first_position", F.get("passes", F.lit(0))["position"])
            .select(F.col("id").alias(id_col), "skey", "tie", "size", "source_size", "target", "taken",
                    "first_position", "passes")
            .repartitionByRange(F.col("first_position").asc_nulls_last(), F.col(id_col)))


def mixed(docs: DataFrame, plan: DataFrame, id_col: str = "doc_id", source_col: str = "source",
          text_col: str = "text") -> DataFrame:
    """``docs`` as the plan shows them: one row per showing, range-sorted by position.

    Texts are shown whole: the one document on its source's target edge stays if at
    least half of its words are taken, else that showing goes, so a source misses its
    target by at most half of one document. Null ids, sources and texts, repeated rows
    and columns of any name are carried as they are; an empty table gives no rows."""
    names, plan_id = docs.columns, id_col
    docs = docs.toDF(*(f"c{i}" for i in range(len(names))))
    id_col, source_col, text_col = (f"c{names.index(c)}" for c in (id_col, source_col, text_col))
    text = text_or_empty(text_col)
    name = F.when(F.col(id_col).isNull(), "n").otherwise(F.concat(F.lit("i"), F.col(id_col).cast("string")))
    keyed = (docs.withColumn("_skey", F.when(F.col(source_col).isNull(), "n").otherwise(
                 F.concat(F.lit("s"), F.col(source_col)))).withColumn("_tie", F.xxhash64(text)))
    nth = Window.partitionBy("_id", "_skey", "_tie").orderBy(F.lit(0))
    keyed = keyed.withColumn("_id", name).withColumn("_nth", F.row_number().over(nth))
    named = F.when(F.col(plan_id).isNull(), "n").otherwise(F.concat(F.lit("i"), F.col(plan_id).cast("string")))
    whole = F.filter("passes", lambda p: 2 * p["words"] >= F.col("size"))
    shown = (plan.select(named.alias("_id"), F.col("skey").alias("_skey"), F.col("tie").alias("_tie"),
                         whole.alias("_passes"))
             .withColumn("_nth", F.row_number().over(nth)))
    # rows equal in id, text and source are told apart by a condition that is no join key,
    # so the texts stay where the window put them and are not shuffled once more
    on = F.expr("k._id = p._id and k._skey = p._skey and k._tie = p._tie and k._nth - p._nth = 0")
    out = (keyed.alias("k").join(shown.alias("p"), on)
           .select("k.*", F.explode("p._passes.position").alias("_position")))
    return (out.repartitionByRange("_position", id_col).sortWithinPartitions("_position", id_col)
            .select(*(F.col(c).alias(n) for c, n in zip(docs.columns, names))))
