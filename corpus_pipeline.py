"""Cleaning a corpus in stages: each takes what its predecessor kept.

A stage is a function of (spark, docs, folder of tables). Its result is written
as Parquet to the shared folder and read again as the next stage's ``docs``. All
stages but the last return the columns of ``documents``; the last returns the
piece ids of the documents in the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm import mixing, near_dup, pieces, pii, toxicity
from visitlens.llm.queries import PIECE_MODEL, table
from visitlens.llm.scratch import save

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the grammar, learned from the labels, doesn't reject."""
    model = toxicity.learn(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return toxicity.drop_toxic(docs.select(*COLUMNS), model)


def one_of_each_group(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id.

    Shingles are of five words, the operator's default; only op9_minhash takes four.
    Rows that share an id are told apart: of two, one goes only if their texts are
    near-duplicates or equal. Rows of one id are ordered by the hash of the text,
    then by the other columns. Rows without an id stay.
    """
    del spark, folder
    # ids may repeat, so rows are compared by a number of their own
    rows = save(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()))
    named = rows.where(F.col("doc_id").isNotNull())
    groups = near_dup.near_duplicates(named, doc_id="row").select(
        F.col("doc_id").alias("row"), "component_id", (F.col("n_shingles") == 0).alias("wordless")
    )
    narrow = named.select(
        "row",
        F.struct(
            "doc_id", F.sha2("text", 256).alias("digest"), "lang", "source", "n_chars", "row"
        ).alias("place"),
    )
    # texts without words are in no component; only equal rows of one id are one
    wordless = F.when(F.col("wordless"), F.struct("place.doc_id", "place.digest"))
    told = narrow.join(groups, "row").select(
        "place", wordless.alias("own"),
        F.when(~F.col("wordless"), F.col("component_id")).alias("component"),
    )
    first = told.groupBy("component", "own").agg(F.min("place").alias("first"))
    kept = first.select(F.col("first.row").alias("row"))
    return rows.join(kept, "row", "left_semi").select(*COLUMNS).union(
        rows.where(F.col("doc_id").isNull()).select(*COLUMNS)
    )


def hide_personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every text with <KIND> in place of personal data; n_chars follows."""
    del spark, folder
    clean = pii.redact(docs.select(*COLUMNS))
    return clean.withColumn(
        "n_chars",
        F.when(F.col("text").isNotNull(), F.char_length("text").cast("long")).otherwise(
            F.col("n_chars")
        ),
    )


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Each document as often as its source's word budget takes it."""
    del spark, folder
    return mixing.mixed_rows(docs.select(*COLUMNS))


def encode_pieces(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Piece ids of each row of the mix."""
    del spark, folder
    encoded = pieces.encode(docs, PIECE_MODEL, ("doc_id", "lang", "source"))
    return encoded.withColumn("n_pieces", F.size("piece_ids").cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash", one_of_each_group),
    ("pii", hide_personal_data),
    ("mixing", mix_sources),
    ("pieces", encode_pieces),
]

#: SQL can express neither the grammar nor the piece model.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = table(spark, folder, "documents")
    for _, stage in STAGES:
        docs = save(stage(spark, docs, folder))
    return docs
