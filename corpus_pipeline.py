"""From raw documents to token ids, in stages that each keep, change or repeat documents.

Every stage takes all rows that the one before kept; rows are written as Parquet and read back in
between. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlane.llm import line_quality, mixing, pieces, secrets, simhash
from rosterlane.llm.common import fresh, kept_table, with_shared_folder

# Shingle words and bits of the near-duplicate stage.
SHINGLE_WORDS = 4
MAX_BITS = 4
# A quarter of the way from the sources' own shares to equal ones; no source is cut, and none is read
# more than four times.
MIXING = {"evenness": 0.25, "max_repeats": 4.0, "budget": None}

# The stages hold a trained model, connected components and a tokenizer: SQL can't express them.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose quality, by the field trained on the labels, is below one half."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    (score,) = fresh(docs, "line quality")
    return line_quality.scored(docs, labels, score).where(F.col(score) >= 0.5).drop(score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of every group of near copies, that of the smallest id."""
    return simhash.one_per_group(docs, SHINGLE_WORDS, MAX_BITS)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts by a mask; lengths follow."""
    cleaned = secrets.redacted(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents of small sources up to the limit; every document stays once at least."""
    return mixing.mixed_documents(docs, **MIXING)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_pieces, ids, decodes): the ids of every reading of a document, and
    whether decoding gives its text back."""
    coded = pieces.coded(docs.select("doc_id", "lang", "source", "text"), same="decodes")
    n_pieces = F.size("ids").cast("long").alias("n_pieces")
    return coded.select("doc_id", "lang", "source", n_pieces, "ids", "decodes")


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", near_duplicates),
    ("secret scans", secret_scans),
    ("mixing sources", mixing_sources),
    ("piece encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, over the documents of ``sf_dir``."""
    with_shared_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept_table(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
