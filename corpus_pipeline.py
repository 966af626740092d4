"""The corpus pipeline: five stages over ``documents``, each on what the one before kept.

toxicity -> line dedup -> MinHash near-dedup -> benchmark decontamination ->
mixing. Every stage takes (spark, docs, sf_dir), its result is written as
Parquet and read again as the next one's ``docs``. All but the last return the
columns of ``documents``; the last one too, with a row per copy taken.

ORACLE_SQL is None: a trained classifier and a seeded selection cannot be said
in SQL. tests/llm/test_pipeline.py holds every stage against brute force.
"""

from pyspark.sql import DataFrame, SparkSession

from cloakline.llm import decontam, lines, minhash, mixing, toxicity
from cloakline.llm.common import scratch, table, text_batches
from cloakline.session import delete_path, scratch_scope, track_scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that a classifier trained on all labels rejects."""
    text_batches(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.reject_toxic(docs, model)


def stage_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that ten or more documents have."""
    text_batches(spark)
    return lines.dedup_lines(docs)


def stage_minhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates (five-word shingles, 0.8)."""
    text_batches(spark)
    return minhash.dedup(docs)


def stage_decontam(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold ten words in a row of a benchmark item."""
    text_batches(spark)
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def stage_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and select documents so that each source comes near its target."""
    text_batches(spark)
    return mixing.mix(docs)


STAGES = [
    ("toxicity", stage_toxicity),
    ("lines", stage_lines),
    ("minhash", stage_minhash),
    ("decontam", stage_decontam),
    ("mixing", stage_mixing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage wrote on its way, and its input, are deleted once its result is written."""
    docs, before = table(spark, sf_dir, "documents").select(*COLUMNS), None
    for name, stage in STAGES[:-1]:
        with scratch_scope(spark) as made:
            docs = scratch(stage(spark, docs, sf_dir), f"stage-{name}")
            result = made.pop()
        track_scratch(spark, result)
        if before is not None:
            delete_path(spark, before)
        before = result
    return STAGES[-1][1](spark, docs, sf_dir)
