"""The pipeline over documents: each stage takes (spark, docs, sf_dir) and returns what the next one reads.

Nulls, empty and very long texts, repeated rows, empty tables and extra columns are handled as each operator's docstring says;
every stage works on all rows that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm import byte_bpe, decontaminate, near_duplicates, rules, secrets
from stayline.llm.queries import tokenizer_file
from stayline.session import prepare_texts, scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the threshold table rejects go."""
    return rules.passing(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies stays, the one of the smallest id."""
    return near_duplicates.one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of benchmark windows are cut out; a document of which they are more than half goes."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.decontaminated(docs, benchmark).withColumn("n_chars", F.length("text").cast("long"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Real secrets are replaced by a mark."""
    return secrets.redacted(docs).withColumn("n_chars", F.length("text").cast("long"))


def bpe_round_trip(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text, and whether they decode to it."""
    vocabulary = tokenizer_file("byte_bpe_50k.json")
    texts = docs.withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256))
    decoded = byte_bpe.decode(byte_bpe.encode(texts, vocabulary), vocabulary)
    return decoded.select(
        "doc_id",
        "lang",
        "source",
        "n_chars",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        (F.sha2("decoded", 256) == F.col("text_sha256")).alias("round_trip"),
    )


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("BPE encoding and decoding", bpe_round_trip),
]

# Several stages have no SQL counterpart; tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; each result is written under the shared folder and read back."""
    docs, folder = prepare_texts(spark).read.parquet(f"{sf_dir}/documents.parquet"), scratch_path(spark, "pipeline")
    for at, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{at}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
