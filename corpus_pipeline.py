"""The corpus pipeline: stages over documents, each written as Parquet and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reelspark.llm import jaccard, line_dedup, mixing, sentencepiece, toxicity
from reelspark.llm.text import count_words
from reelspark.operators.ordering import with_offsets
from reelspark.session import broadcast_if_small, materialise, remove, scratch, shared_folder, short_lived_shuffles

ID_BYTES = 96


def _tagged(docs: DataFrame) -> DataFrame:
    """The rows, stored with a number of their own in ``_tag``."""
    return materialise(docs.withColumn("_tag", F.monotonically_increasing_id()))


def _contents(docs: DataFrame) -> Column:
    return F.xxhash64(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the restored-text score does not call toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.score_toxicity(docs, labels).where("predicted = 0").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated line runs; ``n_chars`` follows the text.

    A document of which no word is left was a copy throughout and goes.
    """
    deduped = line_dedup.dedup_lines(docs)
    emptied = (F.col("n_deleted") > 0) & (count_words(F.col("text")) == 0)
    left = deduped.where(~emptied)
    changed = F.col("n_deleted") > 0
    n_chars = F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", n_chars).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (five-word shingles, similarity 0.8): the one with
    the smallest doc_id, null last, then by digest of its contents.

    Rows are told apart by a number of their own, so copies with one doc_id or none go as well.
    Texts without words all stay.
    """
    tagged = _tagged(docs)
    # Ordered by doc_id, so the smallest of a group is the row that stays.
    place = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", _contents(docs).alias("contents"), "_tag")
    found = jaccard.similar_documents(tagged.select(place.alias("place"), "text"), doc_id="place", size=5, pct=80)
    gone = materialise(found.where("doc_id._tag <> component_id._tag").select("doc_id._tag"))
    gone = broadcast_if_small(gone, gone.count(), ID_BYTES)
    return tagged.join(gone, "_tag", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it; rows that repeat one another are rounded one by one.

    Rows are drawn by their place in the order of their contents, so the same table gives the
    same rows whatever the partitions: which of equal rows is taken cannot be seen.
    """
    tagged = _tagged(docs)
    order = [F.col("doc_id").isNull().alias("_missing"), "doc_id", _contents(docs).alias("_contents"), "_tag"]
    sizes = tagged.select(*order, "source", count_words(F.col("text")).alias("size"))
    placed = materialise(with_offsets(sizes, ["_missing", "doc_id", "_contents", "_tag"]).select("_tag", "pos", "source", "size"))
    taken = mixing.mix_sizes(placed.select(F.col("pos").alias("doc_id"), "source", "size"))
    taken = taken.where("copies > 0").select(F.col("doc_id").alias("pos"), F.col("copies").cast("int").alias("_copies"))
    taken = materialise(placed.select("_tag", "pos").join(taken, "pos").select("_tag", "_copies"))
    taken = broadcast_if_small(taken, taken.count(), ID_BYTES)
    repeated = tagged.join(taken, "_tag").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return repeated.select(*docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether the stored ids decode to the text.

    A null text has null ids, an empty one none; long texts are encoded whole, repeated rows alike.
    """
    encoded = sentencepiece.encode_checked(docs, ["doc_id", "lang", "source"])
    return encoded.select("doc_id", "lang", "source", "n_tokens", "token_ids", "round_trip")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", drop_near_duplicates),
    ("mix_sources", mix_sources),
    ("sentencepiece", encode_pieces),
]

# Restoration, pivotal rounding and Viterbi paths cannot be told in SQL; tests hold the stages
# against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. A stage's own tables go when it is written, its input when the next is, and
    the files of a shuffle with the query they were written for."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root, before = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}", None
    for name, stage in STAGES:
        path = f"{root}/{name}"
        with scratch(spark), short_lived_shuffles(spark):
            made = stage(spark, docs, sf_dir)
            made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        if before is not None:
            remove(spark, before)
        before = path
    return docs
