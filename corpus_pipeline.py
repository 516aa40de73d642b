"""From raw documents to a training corpus, in stages that each store what they keep.

A stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.decontaminate import decontaminated
from barloom.llm.line_dedup import without_repeats
from barloom.llm.queries import MODEL
from barloom.llm.sentencepiece_codec import encode_decode
from barloom.llm.simhash import one_of_each
from barloom.llm.storage import stored
from barloom.llm.toxicity import learn_toxicity, score_toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def clean_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without toxic documents, by a chain fitted on the labelled ones among them."""
    chain = learn_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_toxicity(docs, chain).where("not is_toxic").select(docs.columns)


def new_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each without the lines that an earlier one has, or nearly so. n_chars
    follows the text."""
    kept = without_repeats(docs)
    return kept.withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), "n_chars"))


def one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id: three-word
    shingles, fingerprints that differ in at most three bits."""
    return one_of_each(docs, words=3, distance=3)


def unseen_by_tests(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a passage of the benchmark."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept document with its token ids."""
    return encode_decode(docs, MODEL, with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", clean_language),
    ("line_dedup", new_lines),
    ("simhash", one_of_copies),
    ("decontamination", unseen_by_tests),
    ("sentencepiece", encoded),
]
#: SQL can express neither the fitted chain nor the encoding.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each reading what the one before has stored."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
