"""Benchmark decontamination as a prefix-filtered set join.

An item's windows are its runs of ten consecutive words (an item of fewer, but not none, is one
window). A document must hold all words of a window, so the necessary prefix of a window is its
rarest word: words are ordered by their count in the documents, and only the rarest of each window
is joined with the documents' words. The word's place inside the window bounds where the window
starts and must end in the document (position and length); what passes is verified word by word.

The items' side (words and windows) is broadcast when a count proves it small, else the joins
shuffle; the documents' words are read in place and never shuffled whole. Counts are partial sums.

Words compare with A-Z lower-cased and nothing else: keys of the joins are fully lower-cased, which
can only add candidates, and the verification compares exactly.

Defined cases: null and empty texts have no words and no hits; items without words have no window;
repeated items (id and text) count once; an item id with several texts counts once per document;
an item without an id hits words and contaminates, but has no name to be counted or listed by; rows equal in document id and text are one document; empty tables give no hits or no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.common import alnum_words, ascii_lower, broadcast_if, is_small, table, text_hash
from tidegauge.session import materialize

WINDOW = 10
#: Rows of the items' side up to which it is broadcast; beyond, the joins shuffle.
BROADCAST_ROWS = 200_000


def item_windows(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """``item_id, win`` (the window's words, lower-cased): a row per distinct pair."""
    words = items.select(F.col(id_col).cast("string").alias("item_id"), alnum_words(ascii_lower(F.col(text_col))).alias("words"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1)))
    each = F.transform(starts, lambda i: F.slice(F.col("words"), i, window))
    return words.where(F.size("words") > 0).select("item_id", F.explode_outer(each).alias("win")).distinct()


def _rarest(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Each window with the key and place of its prefix: the rarest of its words, ties by word and place."""
    placed = windows.select("win", F.posexplode("win").alias("place", "word")).withColumn("key", F.lower("word"))
    ranked = placed.join(counts, "key", "left").groupBy("win").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key", "place")).alias("rare"))
    return ranked.select("win", "rare.key", "rare.place", F.size("win").alias("len"))


def occurrences(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "item_id",
                text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Occurrences ``id, hash, win, start, len`` in ``docs`` (``id, hash, text``), and the items' windows."""
    pairs = materialize(item_windows(items, window, id_col, text_col), "item-windows")
    windows = pairs.select("win").distinct()
    small = is_small(pairs, BROADCAST_ROWS)
    words = docs.select("id", "hash", alnum_words(F.col("text")).alias("words"))
    vocabulary = windows.select(F.explode("win").alias("word")).select(F.lower("word").alias("key")).distinct()
    counts = (
        words.select(F.explode("words").alias("word")).select(F.lower("word").alias("key"))
        .join(broadcast_if(vocabulary, small), "key").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    )
    prefixes = materialize(_rarest(windows, counts), "item-prefixes")
    placed = words.select("id", "hash", "words", F.posexplode("words").alias("pos", "word"))
    start = F.col("pos") - F.col("place")
    candidates = placed.withColumn("key", F.lower("word")).join(broadcast_if(prefixes, small), "key").where(
        (start >= 0) & (start + F.col("len") <= F.size("words")))
    text = F.array_join(F.slice("words", start + 1, F.col("len")), " ")
    found = candidates.where(ascii_lower(text) == F.array_join("win", " "))
    return found.select("id", "hash", "win", start.alias("start"), "len"), pairs


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row`` (the input row), ``n_words, n_hit, n_items, items_sha256, contaminated``."""
    keyed = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    keyed = keyed.withColumn("hash", text_hash(F.col("text")))
    found, pairs = occurrences(keyed, items, window)
    found = materialize(found.distinct(), "item-occurrences")
    hit = found.select("id", "hash", F.explode(F.sequence("start", F.col("start") + F.col("len") - 1)).alias("at")).distinct()
    hit = hit.groupBy("id", "hash").agg(F.count(F.lit(1)).alias("n_hit"))
    named = found.select("id", "hash", "win").distinct().join(pairs, "win").select("id", "hash", "item_id").distinct()
    named = named.groupBy("id", "hash").agg(F.sort_array(F.collect_list("item_id")).alias("item_ids"))
    same = lambda a, b: F.col(f"{a}.id").eqNullSafe(F.col(f"{b}.id")) & (F.col(f"{a}.hash") == F.col(f"{b}.hash"))
    figures = hit.alias("h").join(named.alias("n"), same("h", "n"), "left").select("h.id", "h.hash", "n_hit", "item_ids")
    joined = keyed.withColumn("n_words", F.size(alnum_words(F.col("text"))).cast("long")).drop("text").alias("d").join(
        figures.alias("f"), same("d", "f"), "left")
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0))
    return joined.select("d.row", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
                         F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).select(
        "row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


OP3_SQL = r"""
WITH item_words AS (
    SELECT item_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
    FROM benchmark WHERE text IS NOT NULL),
item_windows AS (
    SELECT DISTINCT item_id, array_to_string(words[i:i + 9], ' ') AS win, least(len(words), 10) AS n
    FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 8, 2))) AS i FROM item_words WHERE len(words) > 0)),
doc_words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
    FROM documents),
doc_windows AS (
    SELECT doc_id, i, n, array_to_string(words[i:i + n - 1], ' ') AS win
    FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i
          FROM doc_words, (SELECT DISTINCT n FROM item_windows) WHERE len(words) >= n)),
found AS (SELECT d.doc_id, d.i, d.n, w.item_id FROM doc_windows d JOIN item_windows w ON d.win = w.win AND d.n = w.n),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""
