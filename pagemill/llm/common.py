"""What the operators of this folder share: safe texts, written steps, words, labels and samples."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.session import working_folder

# A-Z to lower case, every other ASCII character that is not a letter or digit to a blank.
# Bytes from 0x80 on belong to characters of other alphabets and stay.
_WORD_TABLE = bytes(
    code + 32 if 65 <= code <= 90 else code if code >= 128 or chr(code).isalnum() else 32 for code in range(256)
)

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: a cut of lineage that survives executors."""
    spark = df.sparkSession
    root = working_folder(spark, name)
    df.write.option("compression", "zstd").parquet(root)
    return spark.read.schema(df.schema).parquet(root)


def words(text: str | None) -> list[bytes]:
    """Lower-cased ASCII letters, digits and non-ASCII characters in runs, as UTF-8. Null has none."""
    return text.encode("utf-8", "surrogatepass").translate(_WORD_TABLE).split() if text else []


def row_bucket(doc_id: Column, buckets: int) -> Column:
    """The crc32 of the id as text, modulo ``buckets``. Null ids are in bucket 0, as ids with an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(buckets)).cast("int")


def bucket_of(doc_id: int | None, buckets: int) -> int:
    return zlib.crc32(b"" if doc_id is None or doc_id != doc_id else str(int(doc_id)).encode()) % buckets


def known_labels(labels: DataFrame, label: str, usable: Column) -> DataFrame:
    """``doc_id, label`` where neither is null, the label is 0 or 1, and ``usable`` (a test on ``doc_id``) holds."""
    rows = labels.select("doc_id", F.col(label).cast("int").alias("label"))
    return rows.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & usable)


def base_rate(known: DataFrame) -> float:
    """Share of label 1 over all known labels, one half if there are none."""
    row = known.agg(F.count("label").alias("n"), F.sum("label").alias("ones")).first()
    return ((row["ones"] or 0) + 1) / (row["n"] + 2)


def labelled_sample(docs: DataFrame, known: DataFrame, per_class: int, max_chars: int) -> DataFrame:
    """``doc_id, text, label`` of at most ``per_class`` known labels of either class.

    Chosen by a hash of the id. Only ids of the sample, whose number is bounded by ``2 * per_class``, are
    broadcast; texts are not shuffled. Texts of over ``max_chars`` are left out of the sample, which so has a
    bounded size.
    """
    picked = None
    for value in (0, 1):
        part = known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked = part if picked is None else picked.unionByName(part)
    picked = picked.groupBy("doc_id").agg(F.max("label").alias("label"))
    texts = docs.select("doc_id", "text").where(F.coalesce(F.length("text"), F.lit(0)) <= max_chars)
    return texts.join(F.broadcast(picked), "doc_id")

