"""The corpus pipeline: stages that turn documents into packed training sequences.

1. quality     documents that the quality classifier rejects go
2. near_dedup  one document of each group of near-duplicates stays (5-word shingles, 0.8)
3. suffix_dedup  bytes that a repeated 100-byte string covers go; emptied documents go
4. mixing      copies of documents as source weights want; the copy at the budget's end is cut
5. packing     token sequences of 1024

Defined results: a null text is empty; empty and blank texts are one group of copies in near_dedup, of which the
smallest doc_id stays (a null id is the smallest), take no words in mixing and so are in no sequence; of rows listed
again one stays; a null source is a source of its own; ties go by doc_id, then by a hash of the text; an empty table
gives no rows. Columns of the input other than those of documents are not read, whatever their names.

Every stage works on all rows of its predecessor. ``run`` writes each stage's rows to the shared
folder and reads them again, so a lost executor never repeats more than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.llm import mixing, packing, quality, simhash, suffixes
from siftwork.llm.common import fresh_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text the classifier takes for label 1; texts are as they were."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    scored = quality.classify(docs, quality.train(docs, labels), *COLUMNS)
    return scored.where(F.col("score") >= 0.5).select(*COLUMNS)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: the smallest doc_id."""
    return simhash.one_of_each(docs.select(*COLUMNS))


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that repeat earlier; a cut inside a character drops its rest, and no other character."""
    found = suffixes.remove_repeats(docs.select(*COLUMNS), carry=("lang", "source"), characters=True)
    cut = found.withColumn("text", F.col("kept").cast("string")).where((F.size("spans") == 0) | (F.length(F.trim("text")) > 0))
    return cut.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every copy that the mix takes, as a row of its own; the copy at a source's end is cut."""
    return mixing.mix_documents(docs.select(*COLUMNS), "text").withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the rows in sequences of 1024 ids."""
    import public_tokenizers

    return packing.digest(packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("suffix_dedup", suffix_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Trained scores, fingerprints of many hashes and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; the rows of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = fresh_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
