"""Mixing sources to target weights by systematic sampling.

Sources share a multiple of all words by weight; a target stops at a multiple of its source's own
words and the excess goes to the others by weight (water filling, solved in closed form over the
sorted ratios of cap and weight). Every document of a source expects target / source size copies.
Prefix sums of these expected copies over the documents of a source in order of size, plus one
offset per source, give a document one copy per integer boundary crossed.

A source may hold any share of the rows: ranks come from a range-partitioned copy of the small
columns, counted per partition and source, so no task sees a whole source. Only the table of sources
(a row per source) meets in one place. Copies are computed on 24-bit fixed-point integers, so
reruns agree and no rounding can add a copy beyond the cap.

Defined cases: null text has size 0; null sources are one source, last in order; a source without
words gets target 0 and no copies; rows that agree in all but columns unknown here are ordered
arbitrarily among themselves, with the same total; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidegauge.llm.common import blank_words, table, text_hash
from tidegauge.session import materialize

FIXED_POINT_BITS = 24
WEIGHTS = (3, 1, 2)


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """``source, source_size`` to ``source, source_size, target``; one row per source."""
    by_name, by_ratio = W.orderBy(F.col("source").asc_nulls_last()), W.orderBy("ratio", F.col("source").asc_nulls_last())
    everything = W.partitionBy()
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    steps = (
        sizes.withColumn("weight", weight)
        .withColumn("most", F.lit(float(cap)) * F.col("source_size"))
        .withColumn("ratio", F.col("most") / F.col("weight"))
        .withColumn("total", F.lit(float(share)) * F.sum("source_size").over(everything))
        .withColumn("weights", F.sum("weight").over(everything))
        .withColumn("capped", F.coalesce(F.sum("most").over(before), F.lit(0.0)))
        .withColumn("capped_weight", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("capped")) / (F.col("weights") - F.col("capped_weight")))
        # The first source below its cap has the level; those after it would subtract caps that are not reached.
        .withColumn("level", F.max(F.when(F.col("ratio") > F.col("level"), F.col("level"))).over(everything))
    )
    target = F.when(F.col("ratio") > F.col("level"), F.col("weight") * F.col("level")).otherwise(F.col("most"))
    return steps.select("source", "source_size", target.alias("target"))


def _offset(source: Column, seed: int) -> Column:
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, FIXED_POINT_BITS // 4), 16, 10).cast("long")


def copies(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, cap: float = 2.0,
           seed: int = 1, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           further: Sequence[str] = ()) -> DataFrame:
    """``doc_id, text_hash, source, size, source_size, target, rank, copies`` and the ``further`` columns, which
    also order rows that agree in all else; a row per input row."""
    small = docs.select(
        *further,
        F.col(id_col).alias("doc_id"), text_hash(F.col(text_col)).alias("text_hash"), F.col(source_col).alias("source"),
        F.size(blank_words(F.col(text_col))).cast("long").alias("size"),
    )
    order = [F.col("source").asc_nulls_last(), F.col("size"), F.col("doc_id"), F.col("text_hash"), *[F.col(c) for c in further]]
    ranged = materialize(small.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "mix-ranged")
    counts = materialize(ranged.groupBy("source", "part").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words")), "mix-counts")
    sizes = counts.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(sizes, weights, share, cap)
    earlier = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    unit = F.lit(1 << FIXED_POINT_BITS)
    rate = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * unit)).otherwise(0).cast("long")
    parts = (
        counts.withColumn("offset", F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("c")
        .join(targets.alias("t"), F.col("c.source").eqNullSafe(F.col("t.source")))
        .select("c.source", "c.part", "offset", "source_size", "target", rate.alias("rate"))
    )
    within = W.partitionBy("r.source", "r.part").orderBy("size", "doc_id", "text_hash", *further)
    ranked = (
        ranged.alias("r").join(parts.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source")) & (F.col("r.part") == F.col("p.part")))
        .withColumn("rank", F.col("offset") + F.row_number().over(within))
    )
    edge = lambda rank: F.shiftright(rank * F.col("rate") + _offset(F.col("r.source"), seed), FIXED_POINT_BITS)
    return ranked.select(
        *further, "doc_id", "text_hash", F.col("r.source").alias("source"), "size", "source_size", "target", "rank",
        (edge(F.col("rank")) - edge(F.col("rank") - 1)).alias("copies"),
    )


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, cap: float = 2.0, seed: int = 1) -> DataFrame:
    """The mixed corpus: each document's columns and ``copy`` (from 1), once per copy.

    Rows are numbered where they lie, in a written table, so a row that fills a third of the corpus
    meets its copies by as many different numbers, and whole texts move once.
    """
    rows = docs.select(F.struct("*").alias("row")).withColumn("number", F.monotonically_increasing_id())
    rows = materialize(rows, "mix-rows")
    plain = rows.select("number", "row.doc_id", "row.text", "row.source")
    taken = copies(plain, weights, share, cap, seed, further=["number"]).where("copies > 0").select("number", "copies")
    each = rows.join(taken, "number").select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy_number"))
    name = "copy"
    while name in docs.columns:
        name = "_" + name
    return each.select("row.*", F.col("copy_number").alias(name))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = copies(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP4_SQL = r"""
WITH docs AS (
    SELECT doc_id, source, coalesce(len(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')), 0)::BIGINT AS size
    FROM documents),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
    FROM docs GROUP BY source),
caps AS (SELECT *, 2.0::DOUBLE * source_size AS most, 2.0::DOUBLE * source_size / weight AS ratio FROM sources),
levels AS (
    SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
               - coalesce(sum(most) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / (sum(weight) OVER ()
               - coalesce(sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
    FROM caps),
solved AS (SELECT *, max(CASE WHEN ratio > level THEN level END) OVER () AS final FROM levels),
targets AS (SELECT source, source_size, CASE WHEN ratio > final THEN weight * final ELSE most END AS target FROM solved),
ranked AS (
    SELECT d.doc_id, d.size, t.source_size, t.target,
           row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) AS rank,
           CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size * 16777216)::BIGINT ELSE 0 END AS rate,
           ('0x' || substr(md5('1:' || coalesce(d.source, '')), 1, 6))::BIGINT AS start
    FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (((rank * rate + start) >> 24) - (((rank - 1) * rate + start) >> 24)))::BIGINT AS taken
FROM ranked
"""
