"""A training corpus from raw documents: five stages, each written as Parquet and read again by the next.

Quality rules drop documents, near-duplicates leave one of each group, live-looking secrets are masked, sources are
mixed to their target weights (documents repeat or go), and what is left is packed into sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightsift.llm.common import materialize, table
from nightsift.llm.mixing import mixed
from nightsift.llm.packing import pack
from nightsift.llm.quality import judge
from nightsift.llm.secrets import masked, scan
from nightsift.llm.simhash import without_duplicates

#: Not expressible in SQL (a trained verdict comes first); tests hold each stage against a brute-force version.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return judge(docs, table(spark, sf_dir, "labels"), keep=True).where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: that of the least id."""
    return without_duplicates(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets that look live masked (and n_chars counted anew where they were)."""
    found = scan(docs, repo_col="lang", keep=True).withColumn("masked", masked(F.col("row.text"), F.col("live")))
    counted = F.when(F.size("live") > 0, F.length("masked").cast("long")).otherwise(F.col("row.n_chars"))
    new = {"text": F.col("masked").alias("text"), "n_chars": counted.alias("n_chars")}
    return found.select(*(new.get(c, F.col(f"row.`{c}`")) for c in docs.columns))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed(docs).withColumn("n_chars", F.length("text").cast("long"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents' pieces in the packed sequences."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality rules", quality), ("SimHash near-dedup", near_duplicates), ("secret scans", secrets), ("mixing sources to target weights", mixing), ("best-fit packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, applied to documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
