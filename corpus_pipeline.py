"""From raw documents to packed training sequences.

    quality rules         documents that the fertility rules reject go
    exact dedup           of equal texts the one of the largest id stays
    n-gram Jaccard join   of every class of near copies one stays
    suffix-array dedup    repeated passages go, in whatever documents they are
    best-fit packing      token pieces are packed into sequences

Each stage works on all that the one before kept, written and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import chosen_path, exact_dedup, fertility, packing, repeats
from orderloom.llm.common import bounded, table
from orderloom.session import settle

PIECES = "piece_bpe_32k.model"
BYTES = "byte_bpe_50k.json"
#: A repeated passage: so many words, or ``repeats.LENGTH`` bytes. Words of these texts have seven bytes with
#: their space, so fifty hold a window of this length; shorter repeats may be idiom and stay.
PASSAGE_WORDS = 50
PASSAGE = repeats.Shape(length=260, gram=65)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents inside the bands of the fertility rules; a NULL text fails them. Columns as they came."""
    bounded(spark)
    return fertility.keep_good(docs, public_tokenizers.path(PIECES))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z as a-z, NULL as empty) the row of the largest id; of repeated rows one."""
    bounded(spark)
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies; texts without a shingle are near to none and stay."""
    bounded(spark)
    return chosen_path.keep_one(docs)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, less its repeated passages; ``n_chars`` follows the text.

    A passage is a run of bytes of ``PASSAGE.length``-byte strings that start elsewhere too, of
    ``PASSAGE_WORDS`` words or 400 bytes: so every 400-byte string that starts elsewhere goes.
    """
    bounded(spark)
    left = repeats.remove_repeats(docs, shape=PASSAGE, replace_text=True, words=PASSAGE_WORDS)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per token piece with its sequence and place; a NULL or empty text is its end token alone."""
    bounded(spark)
    return packing.pack(packing.token_pieces(docs, public_tokenizers.path(BYTES)))


STAGES = [
    ("quality rules", drop_low_quality),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("suffix-array dedup", remove_repeats),
    ("best-fit packing", pack_sequences),
]

#: Tokens, sketches and byte strings are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage on all that the one before kept."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs
