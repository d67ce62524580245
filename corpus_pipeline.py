"""The corpus pipeline: documents in, encoded documents out. Every stage is one operator of tablewright.llm.

A stage takes the whole of what its predecessor kept and returns the columns of documents; the last returns the encoded form.
Extra columns of documents pass through the stages untouched. An empty table passes through all of them.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.llm import bpe, langid, minhash, mixing, pii
from tablewright.llm.common import unused
from tablewright.session import scratch_path

LANG_MODEL, BPE_RANKS = "piece_bpe_32k.model", "byte_bpe_50k.tiktoken"
PII_KEY = "pipeline"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents in which a language is recognised with a posterior of a half or more.

    The model learns from this stage's own rows that name a language. Null texts and texts without a letter go.
    Where there are texts but nothing names a language, nothing can be recognised: that is an error.
    """
    model = langid.train(docs, public_tokenizers.path(LANG_MODEL))
    if model is None and not docs.where(F.col("text").rlike(r"\p{L}")).isEmpty():
        raise ValueError("no text names its language in column lang: nothing to learn from")
    prefix = unused([c.lower().removesuffix("lang_pred").removesuffix("score") for c in docs.columns], "_id_")
    found = langid.identify(docs, model, carry=tuple(f"`{c}`" for c in docs.columns), prefix=prefix)
    return found.where(f"{prefix}lang_pred <> 'und' and {prefix}score >= 0.5").drop(f"{prefix}lang_pred", f"{prefix}score")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near-duplicates (five words, similarity 0.8), once."""
    groups = minhash.near_duplicates(docs, size=5, percent=80)
    name = unused(docs.columns, "_gone")
    gone = groups.where("not kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col("doc_id") == F.col(name), "left_anti").dropDuplicates(["doc_id", "text"])


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by format-preserving pseudonyms; n_chars follows the text where it changed."""
    count = unused(docs.columns, "_replaced")
    done = pii.pseudonymise(docs, PII_KEY, count=count)
    chars = F.when(F.col(count) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return done.withColumn("n_chars", chars).drop(count)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents so that sources mix by the square root of their characters, in random order."""
    return mixing.mix(docs, units=F.length(F.coalesce("text", F.lit(""))) + 1, extra=False)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of ids and of the bytes they decode to."""
    path = public_tokenizers.path(BPE_RANKS)
    return bpe.encode(docs, path, public_tokenizers.PATTERN, carry="doc_id long, lang string, source string", derive=bpe.digests(spark, path))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mixture", mixture),
    ("encoding", encoding)]

#: No SQL: language models, sketches and byte-pair merges have none. tests/llm holds the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each returns is written as Parquet to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
