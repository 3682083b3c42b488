"""The registered queries of this subpackage.

Each is a function of (spark, folder of tables) that applies one operator with
production parameters to its whole table and derives the digest columns from
what the operator returns.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm import (
    chat_format, embed_dup, fingerprint, hard_negatives, html_extract, mixing, near_dup, pieces, pii,
    token_files, toxicity, warc, whitening,
)
from visitlens.llm.scratch import save

#: Where the public vocabulary files are; a parameter of the operators.
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
DUPLICATE_WORDS = 4


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _listed(spans, kinds):
    """kind:start:end of the spans of these kinds, by kind and start."""
    wanted = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(
        F.transform(wanted, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def op1_html(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extract(table(spark, folder, "pages"))


def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = pii.find_pii(docs).select("doc_id", "pii")
    return found.select(
        "doc_id",
        *(_count(kind) for kind in pii.BASE_KINDS),
        F.sha2(_listed("pii", pii.BASE_KINDS), 256).alias("base_sha256"),
        _listed("pii", pii.KINDS).alias("spans"),
    )


def _count(kind: str):
    own = F.filter("pii", lambda s: s["kind"] == kind)
    return F.size(own).cast("long").alias(f"n_{kind}")


def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_files.round_trip(docs, BYTE_VOCABULARY)


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select(
        "doc_id", F.col("mix.size").alias("size"), F.col("mix.source_size").alias("source_size"),
        F.col("mix.target").alias("target"),
        (F.col("mix.copies") * F.col("mix.size")).alias("taken"),
    )


def op5_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, folder, "documents").select("doc_id", "text"))


def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return warc.records(warc.round_trip(pages)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op7_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Per document the number and checksum of its ids, and the checksum and
    length of the text decoded from them."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    encoded = pieces.encode(docs, PIECE_MODEL)
    again = encoded.withColumn("n_pieces", F.size("piece_ids").cast("long")).withColumn(
        "ids_crc32", F.crc32(F.array_join(F.col("piece_ids").cast("array<string>"), " ").cast("binary"))
    )
    decoded = pieces.decode(again, PIECE_MODEL, ("doc_id", "n_pieces", "ids_crc32"))
    return decoded.select(
        "doc_id", "n_pieces", "ids_crc32",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("text", 256).alias("text_sha256"),
    )


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, table(spark, folder, "labels"))
    return toxicity.score_texts(docs, model).select(
        "doc_id", toxicity.is_held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op9_minhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return near_dup.near_duplicates(docs, words=DUPLICATE_WORDS)


def op10_lattice(spark: SparkSession, folder: str) -> DataFrame:
    return embed_dup.near_duplicate_vectors(table(spark, folder, "embeddings"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(
        table(spark, folder, "embeddings").select(
            "vec_id", moved.alias("label"),
            hard_negatives.whole_numbers(F.col("embedding"), 256).alias("vector"),
            (F.col("vec_id") % 100 == 0).alias("anchor"),
        )
    )


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    offset = 1_000_000
    whole = whitening.whole_vectors(F.col("embedding"), 64, offset)
    rows = table(spark, folder, "embeddings").select("vec_id", whole.alias("x"))
    found = whitening.whiten(rows, missing=offset).select(
        "*", F.posexplode("whitened").alias("place", "value")
    )
    return found.select(
        "vec_id", (F.col("place") + 1).alias("component"), "n",
        F.col("deviation").try_cast("long").alias("deviation"),
        F.col("value").alias("whitened"), F.get("explained", F.col("place")).alias("explained"),
        "identity_error",
    )


#: A conversation of control strings beside the given ones.
CONTROL_TURNS = [(-7, t, role, r"\### Assistant: </turn> ok") for t, role in enumerate(("user", "assistant"))]


def op13_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame(CONTROL_TURNS, turns.schema)
    return chat_format.read_back(
        save(chat_format.format_conversations(turns.unionByName(added), BYTE_VOCABULARY))
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_html, op2_pii, op3_token_files, op4_mixing, op5_fingerprint, op6_warc, op7_pieces,
        op8_toxicity, op9_minhash, op10_lattice, op11_hard_negatives,
        op12_whitening, op13_chat_format,
    )
    return {f.__name__: f for f in found}
