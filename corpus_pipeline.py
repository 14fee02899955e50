"""A training-data pipeline of four stages over ``documents``.

Every stage is a function (spark, docs, sf_dir) that returns a DataFrame; it is written as Parquet and read again as the
next one's ``docs``. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltloom.llm.common import materialise
from voltloom.llm.neardup import near_duplicates
from voltloom.llm.packing import pack
from voltloom.llm.quality import classify, train
from voltloom.llm.queries import tokenizer
from voltloom.llm.repeats import LEAST, PASSAGE, PASSAGE_GRAM, remove_repeats


def _whole_rows(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and the whole row as a struct, so that no column of the input meets one of an operator."""
    return docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. Null and empty texts are scored like any other; rows that are there twice
    get one verdict; an empty table, or one without labels, scores 0.5 and keeps all."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return classify(_whole_rows(docs), model, keep=["row"]).where("predicted = 1").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of equal and near-equal texts: that with the smallest id. Null and empty texts are one class;
    of rows that are there twice one stays; null ids come after all others."""
    found = near_duplicates(docs).where("doc_id <=> class_id and tid = class_tid")
    kept = found.groupBy(F.col("doc_id").alias("_id"), F.col("tid").alias("_tid")).agg(F.count("*").alias("_n"))
    kept = materialise(kept, "kept")
    rows = _whole_rows(docs).withColumns({"doc_id": F.col("doc_id").cast("long"), "tid": F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))})
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tid") == F.col("_tid"))
    once = rows.join(kept.where("_n = 1").hint("merge"), same, "left_semi")
    again = rows.join(kept.where("_n > 1").hint("merge"), same).dropDuplicates(["_id", "_tid"])  # rows that are there twice
    return once.select("row.*").unionByName(again.select("row.*"))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that repeat: runs of repeated strings of ``PASSAGE`` bytes that hold more than 50 words or
    have 400 bytes or more. Null and empty texts stay as they are; so do ids and all other columns, ``n_chars`` apart."""
    out = remove_repeats(_whole_rows(docs), PASSAGE, PASSAGE_GRAM, as_text=True, least=LEAST)
    cut = F.col("n_removed") > 0
    row = F.col("row").withField("text", F.when(cut, F.col("kept")).otherwise(F.col("row.text")))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.when(cut, F.length("kept").cast("long")).otherwise(F.col("row.n_chars")))
    return out.select(row.alias("row")).select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens. Null and empty texts have their end token alone; rows that are
    there twice are packed twice."""
    pieces = pack(docs, tokenizer("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("near-duplicate removal", near_dedup),
    ("repeat removal", repeats),
    ("packing", packing),
]

#: SQL can't express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
