"""Quality rules: per-document rules, then host verdicts by empirical-Bayes shrinkage.

A document's rule figures come from its words, lines and symbols. Rule failures are counted per
host, a beta prior is fitted to the hosts' rates by the method of moments, and a host whose shrunk
rate reaches the limit is rejected with all its documents. Host counts are partial sums, so a host
of any size is one row per task in the shuffle; the prior is one row; verdicts join by host.

Defined cases: null and empty texts have no words and fail the base rule; documents without a host
get no host verdict; with fewer than two hosts, or equal rates, the prior is a weak one at the
overall rate; repeated rows count as often as they occur; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.common import BLANKS, blank_words, broadcast_if, is_small, table
from tidegauge.session import materialize

NOT_SYMBOL = "[^#*$%&|<>]+"
NOT_BLANK = r"[^\x20\x09-\x0D]+"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
HOST_LIMIT = 0.5
#: Hosts up to which the verdicts are broadcast; beyond, the join shuffles.
BROADCAST_HOSTS = 100_000


def with_repeated_words(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """``rows`` (with ``words``) and ``n_repeat_words``: words in windows found twice or more in their text.

    Window hashes are sorted with their positions only in texts that repeat one; gaps between the
    sorted positions of repeated windows then add up to the covered words. Every step is a column of
    its own, so that no lambda holds an array expression to be evaluated again per element.
    """
    starts = F.sequence(F.lit(0), F.size("words") - window)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(F.col("words"), i + k) for k in range(window)]))
    hashed = rows.withColumn("hashes", F.when(F.size("words") > window, hashes))
    sorted_ = hashed.withColumn("sorted", F.when(
        F.size(F.array_distinct("hashes")) < F.size("hashes"),
        F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    near = lambda i, d: F.get(F.col("sorted"), i + d)["h"]
    repeated = F.filter("sorted", lambda x, i: near(i, 1).eqNullSafe(x["h"]) | ((i > 0) & near(i, -1).eqNullSafe(x["h"])))
    at = F.sort_array(F.transform(repeated, lambda x: x["i"]))
    covered = F.aggregate("at", F.struct(F.lit(0).alias("n"), F.lit(-window).alias("end")), lambda acc, p: F.struct(
        (acc["n"] + F.least(F.lit(window), p + window - acc["end"])).alias("n"), (p + window).alias("end")),
        lambda acc: acc["n"])
    found = sorted_.withColumn("at", F.when(F.col("sorted").isNotNull(), at))
    return found.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("hashes", "sorted", "at")


def rule_figures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """``doc_id, host`` and the figures the rules look at, a row per input row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).cast("string").alias("host"), text.alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda line: F.length(F.btrim(line, F.lit(BLANKS))) > 0)
    blanks = F.length(F.regexp_replace("text", NOT_BLANK, ""))
    return with_repeated_words(rows.withColumns({"words": blank_words(F.col("text")), "lines": lines})).select(
        "doc_id", "host",
        F.size("words").cast("long").alias("n_words"),
        (F.length("text") - blanks).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", NOT_SYMBOL, "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
    ).withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def host_rates(figures: DataFrame) -> DataFrame:
    """``host, n, failed, rate``: failure rates shrunk towards an empirical beta prior."""
    hosts = figures.where("host IS NOT NULL").groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed"))
    raw = F.col("failed") / F.col("n")
    moments = hosts.agg(F.avg(raw).alias("m"), F.var_pop(raw).alias("v"), F.avg(1 / F.col("n")).alias("inverse"))
    # The spread of raw rates holds binomial noise m(1-m)/n; what is left is the hosts' own.
    noise = F.col("m") * (1 - F.col("m")) * F.col("inverse")
    own = F.greatest(F.col("v") - noise, F.lit(0.0))
    spread = F.col("m") * (1 - F.col("m"))
    strength = F.when(own > 0, F.least(F.greatest(spread / own - 1, F.lit(1.0)), F.lit(1000.0))).otherwise(F.lit(1000.0))
    prior = moments.select((F.col("m") * strength).alias("a"), ((1 - F.col("m")) * strength).alias("b"))
    return hosts.join(F.broadcast(prior)).select(  # the prior is one row
        "host", "n", "failed", ((F.col("failed") + F.col("a")) / (F.col("n") + F.col("a") + F.col("b"))).alias("rate"))


def judge(docs: DataFrame, limit: float = HOST_LIMIT, **columns: str) -> DataFrame:
    """The figures with ``host_rate`` and ``kept``: the document passes and its host is not rejected."""
    figures = materialize(rule_figures(docs, **columns), "quality-figures")
    rates = materialize(host_rates(figures).select("host", "rate"), "host-rates")
    rates = broadcast_if(rates.withColumnRenamed("rate", "host_rate"), is_small(rates, BROADCAST_HOSTS))
    return figures.join(rates, "host", "left").withColumn(
        "kept", ~F.col("base_failed") & (F.coalesce(F.col("host_rate"), F.lit(0.0)) < limit))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP7_SQL = r"""
WITH docs AS (
    SELECT doc_id, source AS host, coalesce(text, '') AS text,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents),
starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM docs WHERE len(words) >= 5),
windows AS (SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS w FROM starts),
repeated AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS c FROM windows),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM repeated WHERE c > 1) GROUP BY doc_id),
figures AS (
    SELECT d.doc_id, d.host, len(words)::BIGINT AS n_words,
           coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
           coalesce(h.n, 0)::BIGINT AS n_repeat_words
    FROM docs d LEFT JOIN hit h USING (doc_id)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM figures),
hosts AS (SELECT host, count(*) AS n, sum(base_failed::INT) AS failed FROM judged WHERE host IS NOT NULL GROUP BY host),
moments AS (SELECT avg(failed / n) AS m, var_pop(failed / n) AS v, avg(1 / n) AS inverse FROM hosts),
prior AS (
    SELECT m, CASE WHEN v > m * (1 - m) * inverse
                   THEN least(greatest(m * (1 - m) / (v - m * (1 - m) * inverse) - 1, 1.0), 1000.0) ELSE 1000.0 END AS s
    FROM moments),
rates AS (SELECT host, (failed + m * s) / (n + s) AS rate FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(rate, 0.0) < 0.5 AS kept
FROM judged LEFT JOIN rates USING (host)
"""
