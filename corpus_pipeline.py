"""From raw documents to packed sequences: toxic documents, repeated lines and near copies go, the rest is packed.

Each stage takes all that the one before kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.jaccard import near_groups
from spanloom.llm.lines import dedup_lines
from spanloom.llm.pack import pack
from spanloom.llm.toxic import fit_toxicity, score_toxicity
from spanloom.sources.stage import stage

TOXIC = 0.3
_ROW = "_document_row"
TOKENIZER = (
    public_tokenizers.path("byte_bpe_50k.json"),
    public_tokenizers.path("byte_bpe_50k.tiktoken"),
    public_tokenizers.PATTERN,
)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below ``TOXIC`` with a model of the labelled ones."""
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = score_toxicity(docs, model).where(F.col("toxicity") < TOXIC)
    return kept.select([c if c in ("doc_id", "text") else F.col(f"row.`{c}`") for c in docs.columns])


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a document of a larger id repeats. ``n_chars`` follows the text; a
    null text becomes an empty one, and a document that loses all lines stays with an empty text."""
    kept = dedup_lines(docs)
    new = {
        "doc_id": F.col("doc_id"),
        "text": F.col("kept"),
        "n_chars": F.length("kept").cast(docs.schema["n_chars"].dataType),
    }
    return kept.select([new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of the smallest id of each group of near copies; of rows with that id, or of rows without an
    id where no other is in the group, one row. A row without words is a group of its own."""
    rows = stage(docs.withColumn(_ROW, F.monotonically_increasing_id()), "numbered_documents")
    groups = near_groups(rows.select(_ROW, "text"), key=_ROW)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", _ROW))
    kept = groups.join(rows.select(_ROW, "doc_id"), _ROW).groupBy("component_id").agg(first[_ROW].alias(_ROW))
    return rows.join(kept, _ROW, "left_semi").select([F.col(f"`{c}`") for c in docs.columns])


def pack_rest(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    pieces = pack(docs, TOKENIZER)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES = [("toxicity", drop_toxic), ("line dedup", drop_lines), ("near copies", drop_copies), ("packing", pack_rest)]

ORACLE_SQL = None  # a fitted model and tokens have no SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
