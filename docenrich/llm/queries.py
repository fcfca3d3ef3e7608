"""One registered query for each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docenrich.llm import (
    divergence,
    htmltext,
    imatch,
    jaccard,
    langid,
    licenses,
    mixing,
    packing,
    quality,
    spelling,
    substrings,
    vectors,
    warc,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file() -> str:
    """The tokenizer that documents are packed with."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file(), with_ids=False)


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = htmltext.extract_main_text(table(spark, sf_dir, "pages"))
    return texts.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", F.col("copy").cast("long").alias("copy"), "shuffle_key")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learned = ~quality.held_out(F.col("doc_id"))
    model = quality.learn(docs.where(learned), table(spark, sf_dir, "labels").where(learned))
    return quality.score(docs, model).select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.GOOD).cast("int").alias("predicted"),
    )


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = langid.learn_profiles(docs.where(langid.learned_from(F.col("doc_id"))))
    return langid.identify(docs.select("doc_id", "text"), profiles).select(
        "doc_id",
        (~langid.learned_from(F.col("doc_id"))).alias("held_out"),
        "lang_pred",
        "score",
    )


def op6_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op7_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = imatch.fingerprint_with_edits(table(spark, sf_dir, "documents"))
    return prints.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        imatch.as_text(F.col("hashes")).alias("fingerprint"),
        imatch.as_text(F.col("edited_hashes")).alias("edited_fingerprint"),
        imatch.likeness(F.col("hashes"), F.col("edited_hashes")).alias("near_edited"),
        imatch.likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"),
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_and_read(table(spark, sf_dir, "pages"), settled=True, with_payload=False)
    return records.select(
        warc.page_of(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_of(F.col("refers_id")).alias("refers_to"),
    )


def op11_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substrings.remove_repeats(table(spark, sf_dir, "documents"), with_text=False)
    return left.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.frequent_words(table(spark, sf_dir, "documents"), slip_one_in=199)
    return spelling.group_variants(words).select("word", "form", "root", "n", "n_near", "form_n")


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_jaccard": op2_jaccard,
    "op3_html_text": op3_html_text,
    "op4_mixing": op4_mixing,
    "op5_quality": op5_quality,
    "op6_vectors": op6_vectors,
    "op7_imatch": op7_imatch,
    "op8_langid": op8_langid,
    "op9_license_scan": op9_license_scan,
    "op10_warc": op10_warc,
    "op11_substrings": op11_substrings,
    "op12_spelling": op12_spelling,
    "op13_divergence": op13_divergence,
}
