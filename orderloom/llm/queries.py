"""The registered queries: each applies one operator to its whole table, and SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import (
    chat,
    chosen_path,
    exact_dedup,
    fertility,
    interleave,
    kneser_ney,
    mixture,
    packing,
    pieces,
    prefix_trie,
    repeats,
    spelling,
    toxic_spans,
)
from orderloom.llm.common import WORD, fold_of, table, whole

SHARDS = 8
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
KNESER_NEY_ORDER = 3
#: Weights go round the sources.
MIXTURE_WEIGHTS = (3, 1, 2)
#: Says what the templates mark turns with; it must come back as it was.
PROBE = r"\### Assistant: </turn> ok"


def op1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    outputs = ["n_tokens", "ids_sha256", "decoded_sha256", "n_bytes", "covered_bytes", "spans_crc32"]
    return pieces.encode(docs, PIECES, outputs)


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(table(spark, sf_dir, "documents"), BYTES))


def op4_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.assess(table(spark, sf_dir, "documents"), PIECES, carry=["doc_id"])


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = [(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)]
    turns = turns.unionByName(spark.createDataFrame(probe, turns.schema))
    return chat.read_back(chat.format_conversations(turns))


def op6_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.score(table(spark, sf_dir, "documents"), train=fold_of(F.col("doc_id")) != 1, order=KNESER_NEY_ORDER)


def op7_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    slim = docs.select(
        "doc_id",
        "source",
        interleave.text_size(F.col("text")).alias("size"),
        F.crc32(whole("text")).alias("text_crc32"),
    )
    return interleave.interleave(slim, SHARDS, "source", ["doc_id", "text_crc32", "size"]).select(
        "doc_id",
        "source",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.join(table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = exact_dedup.text_digest(F.col("text")).alias("text_sha256")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", digest)
    marked = exact_dedup.exact_dedup(docs)
    return marked.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxic_spans.score(docs, toxic_spans.fit(docs, labels), carry=["doc_id"])
    held_out = (fold_of(F.col("doc_id")) == 0).alias("held_out")
    return scored.select("doc_id", held_out, "score", "predicted", "largest_marginal", "n_spans", "spans")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.words_of(table(spark, sf_dir, "documents")))


def op12_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = whole("text")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.md5(text).alias("digest")
    )
    mixed = mixture.mix(docs, SHARDS, MIXTURE_WEIGHTS, order_cols=["doc_id", "digest"])
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.turns_of(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.with_shared_heads(turns)).drop("path", "parent")


QUERIES = {
    "op1_pieces": op1_pieces,
    "op2_repeats": op2_repeats,
    "op3_packing": op3_packing,
    "op4_fertility": op4_fertility,
    "op5_chat": op5_chat,
    "op6_kneser_ney": op6_kneser_ney,
    "op7_interleave": op7_interleave,
    "op8_chosen_path": op8_chosen_path,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_toxic_spans": op10_toxic_spans,
    "op11_spelling": op11_spelling,
    "op12_mixture": op12_mixture,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE_SQL = {
    "op9_exact_dedup": """
        WITH d AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
            FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
            doc_id = max(doc_id) OVER g AS kept, text_sha256
        FROM d WINDOW g AS (PARTITION BY text_sha256)
    """,
    "op11_spelling": spelling.ORACLE_SQL,
    "op12_mixture": mixture.ORACLE_SQL,
    "op13_prefix_trie": prefix_trie.ORACLE_SQL,
}
