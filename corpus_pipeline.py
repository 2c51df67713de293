"""Corpus pipeline over the ``documents`` table: quality, near duplicates, secrets, mix, tokens.

Each stage works on all rows its predecessor kept, and its result is written as
Parquet and reread as the next stage's documents.  All stages but the last
return the columns of ``documents``; the last returns the tokens of the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyload.llm.bpe import bpe_digests
from tallyload.llm.common import Scratch, dropped_after, free_name
from tallyload.llm.jaccard import jaccard_components
from tallyload.llm.mixing import cut_words, mix_slots
from tallyload.llm.quality import keep_accepted
from tallyload.llm.queries import vocabulary_path
from tallyload.llm.secrets import redact_secrets


def drop_rejected(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects (score below 0.7) go."""
    return keep_accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _keyed(spark: SparkSession, docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``docs`` written once with a number of its own for every row, and that column's name."""
    key = free_name("_row", docs.columns)
    return Scratch(spark, name).table(docs.withColumn(key, F.monotonically_increasing_id()), "rows"), key


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by 5-word shingles at a similarity of 0.8, one with the smallest id stays.

    Rows are judged one by one, by their own texts: of rows with the same id,
    those with copies of a text count as copies, those with other texts stay.
    As in operator 10, a row with a null id links with nothing and stays.
    """
    rows, key = _keyed(spark, docs, "groups")
    named = rows.where("doc_id IS NOT NULL")
    found = jaccard_components(named.select(key, "text"), words=5, threshold=(80, 100), id_col=key)
    ids = named.select(F.col(key).alias("_key"), F.col("doc_id").alias("_id"))
    found = Scratch(spark, "groups").table(
        found.join(ids, found["doc_id"] == ids["_key"]).select("component_id", "_id", "_key"), "found")
    first = found.groupBy("component_id").agg(F.min(F.struct("_id", "_key")).alias("first")).select("first._key")
    copies = found.join(first, "_key", "left_anti").select(F.col("_key").alias(key))
    return rows.join(copies.hint("merge"), key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Characters of secrets become asterisks; all documents stay, and so does the length of their texts."""
    return redact_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, as rows with their documents' columns: one row for each pass over a document.

    A row's text is the words of the blocks that the pass took, in their order
    and with their spaces; a pass that took all of a document leaves the text
    as it is.  So the words by source are those of ``mix_sources``.  Other
    columns, also counts of the whole text, stay as they are.  Null and
    repeated ids are rows like all others.  A document without words has no
    place in the mix.
    """
    rows, key = _keyed(spark, docs, "mix")
    cut = free_name("_cut", rows.columns)
    taken = mix_slots(rows, key_col=key).groupBy("key", "pass").agg(
        F.sort_array(F.collect_list(F.struct("start", "words"))).alias("ranges"), F.sum("words").alias("words"), F.max("size").alias("size"))
    taken = taken.select(F.col("key").alias(key), F.struct("ranges", (F.col("words") == F.col("size")).alias("whole")).alias(cut))
    text = F.when(F.col(cut)["whole"], F.col("text")).otherwise(cut_words(F.col("text"), F.col(cut)["ranges"]))
    return rows.join(taken.hint("merge"), key).select(*[text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text of every row of the mix."""
    return bpe_digests(docs, vocabulary_path())


STAGES = [
    ("quality classifier", drop_rejected),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("secret scans", mask_secrets),
    ("mixing sources", mix),
    ("BPE encoding", encode),
]

#: No SQL: the classifier, the mix and the encoder have none.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        with dropped_after():  # what the stage kept on the way goes once its rows are written
            docs = scratch.table(stage(spark, docs, sf_dir), f"stage{i}")
        if i:
            scratch.drop(f"stage{i - 1}")
    return docs
