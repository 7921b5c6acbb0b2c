"""The corpus pipeline: toxicity, near duplicates, repeated passages, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs. All but the last return the
columns of documents, whatever further ones there are. Rows with null or empty
texts or null ids stay rows (a null text stays null until it is packed as the end
id alone); repeated rows are judged each, and the near-duplicate stage keeps one;
empty tables give empty results; texts of any length count whole. Without
labels no document is toxic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayframe.llm import near_dedup, packing, pii, substring_dedup, toxicity
from wayframe.llm.common import drop_path, fresh_path, materialize, table
from wayframe.llm.entries import tokenizer_file

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain doesn't reject, trained on the labels of those that are here."""
    judged = toxicity.classify(docs, table(spark, sf_dir, "labels"), keep=COLUMNS)
    return judged.where(~F.col("toxic")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates (five words, similarity 0.8): that of the smallest id.

    Rows are judged and dropped by id and text, so of several rows with one id
    only those linked to a smaller one go; of rows equal in both one stays. Rows
    with a null id, and those without words, stay.
    """
    named = docs.withColumn("_row", F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))))
    classes, _ = materialize(near_dedup.near_duplicates(named, key="_row", size=5, share=(80, 100)).where("_row is not null and n_shingles > 0"), "classes")
    left = named.join(classes.where(~F.col("kept")).select("_row").distinct(), "_row", "left_anti")
    again = classes.where("kept").groupBy("_row").agg(F.count("*").alias("_n")).where("_n > 1").select("_row")
    one = left.join(again, "_row", "left_semi").groupBy("_row").agg(F.min(F.struct(*COLUMNS)).alias("_one")).select("_one.*")
    return left.join(again, "_row", "left_anti").select(*COLUMNS).unionByName(one)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are removed; n_chars is that of the new text."""
    cleaned = substring_dedup.remove_repeats(docs)
    length = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars")
    return cleaned.select(*COLUMNS[:-1], length)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind; n_chars is that of the new text."""
    found = pii.find(docs, keep=("doc_id", "lang", "source", "n_chars"))
    length = F.when(F.col("spans") != "", F.length("masked_text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars")
    return found.select("doc_id", F.col("masked_text").alias("text"), "lang", "source", length)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens, with their token ids."""
    return packing.pack(docs, packing.word_encoder(tokenizer_file("word_bpe_49k.json")), end_id=2)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", drop_repeats),
    ("pii", mask_personal_data),
    ("packing", pack),
]

#: A trained classifier decides in the first stage, which SQL can't express; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over documents; each stage's output is written to the shared folder and read again."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(path)
        docs = spark.read.parquet(path)
        if last:
            drop_path(spark, last)
        last = path
    return docs
