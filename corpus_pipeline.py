"""A training corpus from ``documents`` in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
result as a table in the shared folder and hands it to the next stage.  All stages
but the last return the columns of documents.  No stage caps or samples; the
classifier of the first stage fits on a bounded sample of labelled rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm import decontaminate, mixing, order_minhash, pii, toxicity
from waymark.llm.common import read, stored
from waymark.llm.queries import PII_KEY


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores under 0.5."""
    return toxicity.reject(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of least id, of each near-duplicate class."""
    return order_minhash.deduplicate(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def privacy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal values replaced by pseudonyms; n_chars follows the new text."""
    new = pii.pseudonymise(docs, PII_KEY)
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        new = new.withColumn("n_chars", F.when(F.col("n_pii") > 0, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
    return new.select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One epoch's copies at square-root-of-size source shares, shuffled."""
    return mixing.replicate(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("privacy", privacy_stage),
    ("mixing", mixing_stage),
]

#: The classifier and the sketches are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
