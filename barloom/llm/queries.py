"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.conversation_repair import damaged, repair
from barloom.llm.decontaminate import contamination
from barloom.llm.interpolation import lm_scores
from barloom.llm.line_dedup import repeated_lines
from barloom.llm.merkle import folded, leaf_digest, manifest, proof_digest
from barloom.llm.ngram_join import similar_documents
from barloom.llm.oracle import ORACLE
from barloom.llm.quality_rules import cascade
from barloom.llm.secret_scans import scan_secrets
from barloom.llm.sentencepiece_codec import encode_decode
from barloom.llm.simhash import near_duplicates
from barloom.llm.token_counts import token_counts
from barloom.llm.toxicity import learn_toxicity, score_toxicity
from barloom.llm.warc import derivatives, responses

__all__ = ["ORACLE", "QUERIES"]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op1_sentencepiece(s, d):
    return encode_decode(documents(s, d).select("doc_id", "text"), MODEL, keep=["doc_id"])


@query
def op6_token_counts(s, d):
    return token_counts(documents(s, d).select("doc_id", "text"), MODEL, keep=["doc_id"])


@query
def op8_quality_rules(s, d):
    found = cascade(documents(s, d).select("doc_id", "text"), keep=["doc_id"], complete=True)
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                        "n_repeat_words", base_failed.alias("base_failed"), "kept")


@query
def op9_secret_scans(s, d):
    return scan_secrets(documents(s, d).select("doc_id", "text"), keep=["doc_id"])


@query
def op10_simhash(s, d):
    return near_duplicates(documents(s, d), words=3)


@query
def op7_decontamination(s, d):
    found = contamination(documents(s, d), s.read.parquet(f"{d}/benchmark.parquet"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


@query
def op4_lm_scoring(s, d):
    return lm_scores(documents(s, d))


@query
def op3_line_dedup(s, d):
    docs = documents(s, d)
    gone = repeated_lines(docs, of=False).groupBy("id", "row").agg(
        F.count("*").alias("n_removed"),
        F.array_join(F.array_sort(F.collect_list("line")), ",").alias("removed_lines"))
    n_lines = F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("bigint")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("row"))
    return docs.select("doc_id", n_lines.alias("n_lines"), F.xxhash64("text").alias("hash")).join(gone, same, "left").select(
        "doc_id", "n_lines", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("removed_lines", F.lit("")).alias("removed_lines"))


@query
def op2_toxicity(s, d):
    docs = documents(s, d).select("doc_id", "text")
    chain = learn_toxicity(docs, s.read.parquet(f"{d}/labels.parquet"))
    return score_toxicity(docs, chain, keep=["doc_id"])


@query
def op5_warc(s, d):
    pages = s.read.parquet(f"{d}/pages.parquet")
    found = derivatives(responses(pages), "page_id")
    return found.withColumn("block", F.decode("block", "UTF-8"))


@query
def op11_merkle(s, d):
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = F.translate("text", ascii_uppercase, ascii_lowercase)
    # Only what differs from the original goes along.
    tampered = F.when(changed & (lowered != F.col("text")),
                      leaf_digest(*(lowered if f == "text" else F.col(f) for f in fields)))
    rows = manifest(documents(s, d), fields, carry={"tampered": tampered})
    told = rows.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
        folded(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"))
    return told.withColumn("verified", F.col("folded_root") == F.col("root"))


@query
def op13_conversation_repair(s, d):
    original = s.read.parquet(f"{d}/conversations.parquet")
    report, _ = repair(damaged(original))
    named = original.select("conv_id").distinct()
    none = {c: F.lit(0) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    none |= {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit(""), 256)}
    # A conversation that lost all its rows has no report.
    return named.join(report.withColumnRenamed("conv_id", "id"), F.col("conv_id").eqNullSafe(F.col("id")), "left").select(
        "conv_id", *(F.coalesce(c, other).alias(c) for c, other in none.items()))


@query
def op12_ngram_join(s, d):
    return similar_documents(documents(s, d)).drop("class_id")
