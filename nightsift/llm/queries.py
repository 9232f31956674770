"""The queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .alignment import align
from .common import crc_mod, table
from .filter_audit import audit
from .language import identify
from .line_dedup import drop_repeated_lines
from .merkle import fingerprints
from .mixing import mix
from .packing import pack
from .quality import judge
from .secrets import scan
from .simhash import near_duplicates
from .token_counts import count_tokens
from .toxicity import score
from .warc import round_trip


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), crc_mod("doc_id", 3) != 1)


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source is an owner, its documents in one language a repository."""
    return scan(table(spark, sf_dir, "documents"), repo_col="lang").drop("live")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"), crc_mod("doc_id", 4) != 2)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_repeated_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_toxicity, op2_source_mixing, op3_secret_scans, op4_best_fit_packing, op5_warc, op6_quality_rules, op7_token_counts, op8_fingerprints, op9_language_id, op10_simhash, op11_filter_audit, op12_tokenizer_alignment, op13_line_dedup)
}
