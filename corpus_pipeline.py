"""From raw documents to packed training sequences, in five stages.

Each stage takes the rows its predecessor kept, as a stored table, and returns
a DataFrame; all but the last return the columns of ``documents``. See the
operators for how they treat null and empty texts and repeated rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm import jaccard
from wardflow.llm.common import table
from wardflow.llm.decontaminate import decontaminate
from wardflow.llm.langid import identify
from wardflow.llm.packing import pack
from wardflow.llm.secret_scan import redact
from wardflow.session import materialize

VOCABULARY = "byte_bpe_50k.json"


def _same(frame: DataFrame, like: DataFrame) -> DataFrame:
    return frame.select(*[F.col(f"`{c}`") for c in like.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that are text of one of the languages; ``lang`` becomes the one identified.
    All other columns come back as they were, whatever their names."""
    own = [f"c{i}" for i in range(len(docs.columns))]
    name = dict(zip(docs.columns, own))
    kept = identify(docs.toDF(*own), name["text"], declared=F.col(name["lang"]), host=F.col(name["source"])).where("language_kept")
    return kept.withColumn(name["lang"], F.col("language")).select(*own).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies."""
    return jaccard.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that contain no item of the benchmark."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with secrets masked and ``n_chars`` counted anew."""
    clean = redact(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return _same(clean, docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows in sequences of at most 2048 tokens."""
    return pack(docs, public_tokenizers.path(VOCABULARY), keep_ids=False)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates),
          ("benchmark_decontamination", benchmark_decontamination), ("secret_scans", secret_scans), ("packing", packing)]

#: SQL can express neither the language model nor the packer; tests/llm compares
#: the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
