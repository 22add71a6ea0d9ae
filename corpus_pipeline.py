"""The corpus pipeline: documents through the training-data operators, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as
Parquet in the shared folder and rereads it as the next stage's docs. All stages but the
last return the columns of documents.

In every stage: null or empty texts, or texts of white space only, are rejected by the quality
stage, and are rows like others to a stage that is called alone. Null doc_ids are rows like
others, with labels for none. Repeated rows are copies, of which the dedup stages keep one. Ties go
as the operators' docstrings say. Very long texts are taken whole. Empty table: empty result of
the same columns. Extra columns are carried along; ``__rid__`` and ``__times__`` are reserved names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sheen.llm.common import RID, documents, frozen, with_row_id
from sheen.llm.exact_dedup import exact_dedup
from sheen.llm.minhash import near_dedup
from sheen.llm.mixing import mixed_documents
from sheen.llm.pieces import encode
from sheen.llm.quality import good_documents
from sheen.session import table

#: Near copies: shingles of so many words, and the least similarity in percent.
SHINGLE, SIMILAR = 5, 80


def drop_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that it rejects (junk, abuse, no words) go."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of texts equal up to white space, one row stays."""
    docs = with_row_id(docs)
    kept = exact_dedup(docs).where("kept").select(RID)
    return docs.join(kept, RID, "left_semi").drop(RID)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: one document of each group of near copies stays, its first."""
    docs = with_row_id(docs)
    kept = near_dedup(docs, width=SHINGLE, percent=SIMILAR).where("kept").select(RID)
    return docs.join(kept, RID, "left_semi").drop(RID)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights; a document read twice is two rows."""
    return mixed_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece: the tokens of each row, and whether they decode to its text."""
    return encode(docs).select("doc_id", "n_tokens", "ids", "round_trip")


STAGES = [("quality", drop_bad), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies),
          ("mix_sources", mix_sources), ("sentencepiece", encode_pieces)]

#: A fitted scorer, hashed sketches and a tokenizer's merges can't be stated in SQL; the tests
#: hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = frozen(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
