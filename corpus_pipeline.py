"""A cleaning pipeline over documents: each stage works on all that the one before kept, and its decisions take effect.

1. toxicity: documents that score 0.7 or more go.
2. near_duplicates: of documents connected by 5-word shingle similarity of 0.8 or more, the smallest identifier stays.
3. decontamination: documents with a passage of a benchmark item go.
4. personal_data: personal data is masked, terms that give it away are generalised or removed.
5. pieces: the ids of each text's SentencePiece encoding.

Every stage but the last returns the columns of documents; rows with nulls and empty texts pass, since no stage finds
anything in them. Documents without an identifier are no near duplicates of others.
"""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from plumbline.functions.lineage import written  # noqa: E402
from plumbline.llm import decontaminate, jaccard, sanitise, sentencepieces, toxicity  # noqa: E402
from plumbline.llm.queries import held_out, table, tokenizer_path  # noqa: E402


def _with_length(documents: DataFrame) -> DataFrame:
    """n_chars follows the text."""
    if "n_chars" not in documents.columns:
        return documents
    return documents.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels"), ~held_out()))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not the smallest of their component go; of rows that repeat an identifier all stay."""
    found = jaccard.link_components(docs)
    gone = found.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_length(sanitise.sanitise(docs))


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = tokenizer_path("piece_bpe_32k.model")
    encoded = sentencepieces.encode(docs, path)
    return encoded.withColumn("n_ids", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", remove_toxic),
    ("near_duplicates", remove_near_duplicates),
    ("decontamination", remove_contaminated),
    ("personal_data", mask_personal_data),
    ("pieces", to_pieces),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
