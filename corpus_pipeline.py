"""From raw documents to packed training sequences, stage by stage.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next one's ``docs``. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docenrich.llm import jaccard, langid, mixing, packing, quality
from docenrich.llm.common import Workspace
from docenrich.llm.queries import table, tokenizer_file


def _own_name(docs: DataFrame, name: str) -> str:
    """A name that no column of the documents has, in upper or lower case."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _all(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in which no language can be recognised (no text, no letter).

    Rows that repeat an id or a text are judged each; other columns stay.
    """
    profiles = langid.learn_profiles(docs.where(langid.learned_from(F.col("doc_id"))))
    lang, sure = _own_name(docs, "found"), _own_name(docs, "sure")
    found = langid.identify(docs, profiles, lang_col=lang, score_col=sure)
    return found.where(F.col(lang) != langid.UNDETERMINED).select(*_all(docs))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the quality classifier scores below its threshold.

    Texts without a word (null too) score 0 and go. Rows that repeat an id or a text
    are scored each; other columns stay.
    """
    learned = ~quality.held_out(F.col("doc_id"))
    labels = table(spark, sf_dir, "labels")
    model = quality.learn(docs.where(learned), labels.where(learned))
    score = _own_name(docs, "score")
    return quality.score(docs, model, score_col=score).where(F.col(score) >= quality.GOOD).select(*_all(docs))


def one_of_a_kind(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies, and every one that is in no group.

    That with the smallest id (nulls last), of rows with equal ids that with the smallest
    hash of its text. Rows without words are near copies of none; all stay. Other
    columns stay.
    """
    work = Workspace(spark, "one_of_a_kind")
    # written, so that a row keeps its number
    row = _own_name(docs, "row")
    rows = work.save(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    groups = jaccard.near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"))
    first = F.struct(F.isnull("doc_id"), "doc_id", F.xxhash64("text"), F.col(row).alias("row"))
    # written, so that a large group can be split when it is joined
    groups = work.save(
        groups.select(F.col("doc_id").alias("row"), F.coalesce("component_id", "doc_id").alias("group")), "groups"
    )
    kept = (
        rows.select(F.col(row).alias("row"), first.alias("first"))
        .join(groups, "row")
        .groupBy("group")
        .agg(F.min("first").alias("first"))
        .select(F.col("first.row").alias(row))
    )
    return rows.join(kept, row, "left_semi").select(*_all(docs))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents so that sources come near their target shares, in random order.

    Null texts have no characters; rows that repeat an id are drawn alike; other
    columns stay.
    """
    return mixing.mix(docs).select(*_all(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut documents into pieces and pack these into sequences.

    A null text has its end mark alone; every row is a document; other columns go.
    """
    return packing.pack(docs, tokenizer_file(), with_ids=False)


STAGES = [
    ("language_id", known_language),
    ("quality", good_quality),
    ("near_duplicates", one_of_a_kind),
    ("mixing", mixed_sources),
    ("packing", packed),
]

#: Learned models and greedy packing have no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``."""
    work = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        last, docs = docs, work.save(stage(spark, docs, sf_dir), name)
    return docs
