"""The corpus pipeline: STAGES in order, each a function of (spark, docs, sf_dir).

Every stage takes all that the stage before kept. All but the last return the
columns of documents; the last returns the encoded mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playmill.llm import line_dedup, mixing, quality_classifier, queries, simhash, sp_codec
from playmill.llm.common import read_table, written


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, taught by ``labels``, gives a score of 0.7 or more."""
    model = quality_classifier.train(docs, read_table(spark, sf_dir, "labels"), "quality", F.lit(True))
    return quality_classifier.accepted(docs, model)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later of repeated runs of three lines, or of fewer with 50 words."""
    return line_dedup.dedup(docs, length_col="n_chars", least_words=50)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words a shingle, likeness 0.8 or more."""
    return simhash.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources; a document comes once for each pass that takes words of it."""
    return mixing.mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, ids and the text that they decode to."""
    path = queries.tokenizer_path()
    return sp_codec.encode(docs, path, spans=False, decoded=True, also=("source",)).select("doc_id", "ids", "source", "decoded")


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", without_repeated_lines),
    ("SimHash near-dedup", one_of_each_group),
    ("mixing sources to target weights", mixed),
    ("SentencePiece encoding and decoding", encoded),
]
#: The classifier, the mix and the encoding are beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again as the next one's input."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{k}")
    return docs
