"""From raw documents to a training mix, in five stages.

Every stage takes all that the one before it kept and is written and read again, so a lost executor
costs no earlier stage. Stages return the columns of ``documents``; the last one returns the
documents of the mix, a row per copy, with ``copy``.

Defined cases are those of the operators: a null text has no letter and goes with the first stage;
of rows equal in id and text all go or stay together until the mix; an empty table runs through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import decontaminate, language_id, line_dedup, mixing, ngram_join
from tidegauge.llm.common import table
from tidegauge.session import remove_folder, shared_path

#: How far the mean probability of the predicted language must lie between chance (one over the number
#: of learned languages) and certainty: of four even languages 0.4, of two 0.6, of a hundred 0.21.
SURE_SHARE = 0.2
#: Near copies share this percentage of their distinct runs of so many words, or more.
COPY_GRAM, COPY_PERCENT = 5, 80


def least_score(languages: int) -> float:
    """The score below which a document is rejected; with a single language to choose from none is."""
    chance = 1 / languages
    return chance + SURE_SHARE * (1 - chance) if languages > 1 else 0.0


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in no language that the network is sure of, go; without labels only the former."""
    model = language_id.fit(table(spark, sf_dir, "documents"), usable=language_id.fold() != language_id.HELD_OUT)
    if model is None:  # no labelled row: nothing can be judged but the letters
        return docs.where(F.col("text").rlike(r"\p{L}"))
    judged = language_id.predict(docs, model)
    kept = judged.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= least_score(len(model[1]))))
    return kept.select("row.*")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows are cut; what is left of a text may be empty."""
    cut = line_dedup.dedup_lines(docs)
    whole = F.col("n_removed") == 0
    length = F.length("kept_text").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None
    columns = []
    for name in docs.columns:
        column = F.col("row")[name]
        if name == "text":
            column = F.col("kept_text")
        elif name == "n_chars":
            column = F.when(whole, column).otherwise(length)
        columns.append(column.alias(name))
    return cut.select(*columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that line dedup has emptied go; of each class of near copies the smallest id stays."""
    return ngram_join.dedup(docs.where(F.length(F.btrim("text")) > 0), gram=COPY_GRAM, percent=COPY_PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    judged = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return judged.where(~F.col("contaminated")).select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row per copy of a document."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: The language network and the near-copy classes are not expressible in SQL; see the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written below the shared folder and read again.

    A stage's table is removed when the next one is written.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        kept = stage(spark, docs, sf_dir)
        path = shared_path(spark, f"pipeline-{name}")
        kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if before:
            remove_folder(spark, before)
        before = path
    return docs
