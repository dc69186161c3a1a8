"""Line dedup over overlapping three-line windows.

The lines of a document that hold more than white space are hashed three at a time. A window that
occurs more than once anywhere keeps its first occurrence, by document id and place; the positions
that later occurrences cover are merged and their lines removed. Blank lines always stay.

Only 128-bit hashes and positions are shuffled to find repeats. A window that fills a third of the
corpus is one partial minimum per task; the join that finds its later occurrences reads the repeats
from a written table, so adaptive execution can split a hot key. Text moves once, by document.

Defined cases: null text stays null and counts no lines; documents of fewer than three filled lines
have no window and stay whole; rows equal in id and text are one document and get equal results; a
null id sorts first; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.common import BLANKS, table, text_hash
from tidegauge.session import materialize

WINDOW = 3


def _windows(docs: DataFrame, window: int) -> DataFrame:
    """``h1, h2, id, hash, at``: each window's hash and the index of its first filled line."""
    filled = F.filter(F.split("text", "\n"), lambda line: F.length(F.btrim(line, F.lit(BLANKS))) > 0)
    lines = docs.select("id", "hash", filled.alias("filled")).where(F.size("filled") >= window)
    part = lambda i: [F.get(F.col("filled"), i + k) for k in range(window)]
    each = F.transform(F.sequence(F.lit(0), F.size("filled") - window), lambda i: F.struct(
        F.xxhash64(*part(i)).alias("h1"), F.xxhash64(F.lit(window), *reversed(part(i))).alias("h2"), i.alias("at")))
    # An outer explode: for an inner one the optimizer adds a filter with "filled" written into the lambda.
    return lines.select("id", "hash", F.explode_outer(each).alias("w")).where("w IS NOT NULL").select("w.h1", "w.h2", "id", "hash", "w.at")


def removed_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``id, hash, at`` of every occurrence of a window after its first."""
    windows = _windows(docs, window)
    repeats = materialize(
        windows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "hash", "at")).alias("first"))
        .where("n > 1").select("h1", "h2", "first"), "line-repeats")
    return windows.join(repeats, ["h1", "h2"]).where(~F.struct("id", "hash", "at").eqNullSafe(F.col("first"))).select("id", "hash", "at")


def dedup_lines(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row`` (the input row), ``n_lines``, ``n_removed`` and ``kept_text``, a row per input row."""
    keyed = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    keyed = keyed.withColumn("hash", text_hash(F.col("text")))
    covered = removed_windows(keyed, window).groupBy("id", "hash").agg(F.collect_set("at").alias("at"))
    both = keyed.alias("d").join(
        covered.alias("c"), F.col("d.id").eqNullSafe(F.col("c.id")) & (F.col("d.hash") == F.col("c.hash")), "left"
    ).select("d.row", "d.text", F.split("d.text", "\n").alias("lines"), "c.at")
    places = F.filter(F.transform("lines", lambda line, i: F.when(F.length(F.btrim(line, F.lit(BLANKS))) > 0, i)), lambda i: i.isNotNull())
    # Two references to a column keep the optimizer from writing its expression into a lambda.
    covers = F.transform("at", lambda a: F.transform(F.sequence(a, a + (window - 1)), lambda i: F.get(F.col("places"), i)))
    gone = F.when(F.col("places").isNotNull(), F.array_distinct(F.flatten(covers)))
    staying = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    cut = F.array_join(F.transform(staying, lambda i: F.get(F.col("lines"), i)), "\n")
    return both.withColumn("places", F.when(F.col("at").isNotNull(), places)).withColumn("gone", gone).select(
        "row", F.coalesce(F.when(F.col("text").isNotNull(), F.size("lines")), F.lit(0)).cast("long").alias("n_lines"),
        F.when(F.col("at").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_removed"),
        F.when(F.col("at").isNull(), F.col("text")).otherwise(cut).alias("kept_text"))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines, removed lines and the text that stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("row.doc_id", "n_lines", "n_removed", "kept_text")


OP1_SQL = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i
    FROM documents WHERE text IS NOT NULL),
filled AS (
    SELECT doc_id, i, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS place
    FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
windows AS (
    SELECT doc_id, place, line AS a, lead(line, 1) OVER w AS b, lead(line, 2) OVER w AS c
    FROM filled WINDOW w AS (PARTITION BY doc_id ORDER BY place)),
later AS (
    SELECT doc_id, place FROM windows WHERE c IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, place) > 1),
gone AS (SELECT DISTINCT f.doc_id, f.i FROM later l JOIN filled f ON f.doc_id = l.doc_id AND f.place BETWEEN l.place AND l.place + 2),
kept AS (
    SELECT l.doc_id, count(*) AS n_lines, count(g.i) AS n_removed,
           coalesce(string_agg(CASE WHEN g.i IS NULL THEN l.line END, chr(10) ORDER BY l.i), '') AS kept_text
    FROM lines l LEFT JOIN gone g USING (doc_id, i) GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, kept_text
FROM documents d LEFT JOIN kept USING (doc_id)
"""
