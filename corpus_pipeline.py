"""The corpus pipeline: stages that each call one corpus operator on all that the stage before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of docs. A stage
decides by doc_id and text only; other columns pass through. Ties and repeated rows: toxicity, decontamination, secrets and
encoding treat equal texts alike and keep or drop all their rows; near copies keep one row. Null texts are empty ones, and
stay. Very long texts are handled whole. Empty input gives empty output with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import byte_bpe, decontaminate, ngram_join, secret_scan, toxicity
from tideline.llm.common import met, settled, slimmed, table, text_or_empty


#: Up to so many short rows a table of decisions is broadcast to the documents, else both are shuffled.
BROADCAST_ROWS = 100_000


def small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model doesn't call toxic. It learns from the labelled rows outside the held-out fold.

    The verdict depends on the text alone, so only the digests of rejected texts come back from the model: copies share one.
    """
    own = docs.withColumn("__digest", F.sha2(text_or_empty(), 256))
    judged = toxicity.scores(own, toxicity.learned(spark, docs, sf_dir), keep=["__digest"])
    gone = settled(judged.where("score >= 0.5").select("__digest").distinct(), "stage-toxic")
    return own.join(small(gone), "__digest", "left_anti").select(*docs.columns)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies: the one with the least doc_id (nulls last), of those the one with the least digest of its text.

    Each row goes by its own text, also where rows share a doc_id or have none; of equal rows one stays. Documents without
    words have no copies, and all stay.
    """
    slimmed(spark)
    digest = F.sha2(text_or_empty(), 256)
    own = docs.withColumn("__key", F.concat_ws(" ", digest, F.col("doc_id").cast("string")))
    rows = settled(ngram_join.classed(own, key="__key").where("label is not null").select("doc_id", "label", "key"), "stage-classes")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    least = settled(rows.groupBy("label").agg(F.min(place).alias("least")), "stage-least")
    gone = settled(met(rows, least, "label").where(F.col("key") != F.col("least.key")).select(F.col("key").alias("__key")).distinct(), "stage-gone")
    kept = own.join(small(gone), "__key", "left_anti")
    again = settled(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select(F.col("key").alias("__key")).join(gone, "__key", "left_anti"), "stage-again")
    once, several = kept.join(small(again), "__key", "left_anti"), kept.join(small(again), "__key", "left_semi")
    return once.select(*docs.columns).unionByName(several.dropDuplicates(["__key"]).select(*docs.columns))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by benchmark items."""
    slimmed(spark)
    names = docs.columns
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), keep=names)
    hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, x: n + x["e"] - x["s"])
    return found.where((hit == 0) | (20 * hit < F.col("n_words"))).select(*names)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each span of a secret in their texts replaced by [kind]."""
    own, names = docs.withColumn("__digest", F.sha2(text_or_empty(), 256)), docs.columns
    found = settled(secret_scan.scanned(own, doc_id="__digest").where("size(spans) > 0").dropDuplicates(["doc_id"]), "stage-spans")
    marked = own.join(small(found).select(F.col("doc_id").alias("__digest"), F.col("spans").alias("__spans")), "__digest", "left")
    text = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(secret_scan.masked(F.col("text"), F.col("__spans")))
    return marked.withColumn("text", text).select(*names)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens and digests of the ids and of the bytes decoded from them."""
    import public_tokenizers

    slimmed(spark)
    return byte_bpe.digests(docs, vocabulary=public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), pattern=public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near copies", near_copies_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("encoding", encoding_stage),
]

#: The toxicity model and the encoder can't be put in SQL; a brute-force version is in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
