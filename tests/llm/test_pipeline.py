from pyspark.sql import functions as F

import corpus_pipeline as cp
from docenrich.llm import jaccard, langid, quality
from docenrich.llm.queries import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    known = cp.known_language(spark, docs, sf_dir)
    assert known.columns == COLUMNS
    letterless = {r["doc_id"] for r in docs.collect() if not any(c.isalpha() for c in r["text"] or "")}
    assert {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in known.collect()} == letterless
    good = cp.good_quality(spark, known, sf_dir)
    assert good.columns == COLUMNS and 0 < good.count() < known.count()
    one = cp.one_of_a_kind(spark, good, sf_dir)
    assert one.columns == COLUMNS
    assert {r["doc_id"] for r in one.collect()} == {r["component_id"] for r in jaccard.near_duplicates(good).collect()}
    mixed = cp.mixed_sources(spark, one, sf_dir)
    assert mixed.columns == COLUMNS and abs(mixed.count() / one.count() - 1) < 0.3
    pieces = cp.packed(spark, mixed, sf_dir).toPandas()
    assert pieces.length.sum() > 0 and pieces.groupby("sequence_id").length.sum().max() <= 2048


def test_clean_documents_stay_and_odd_ones_do_not_crash(spark, sf_dir):
    odd = [(10**6, None, None, None, None), (10**6, "", "", "", 0), (None, "?!", "x", "y", 2)]
    docs = table(spark, sf_dir, "documents").limit(60)
    docs = docs.union(spark.createDataFrame(odd, docs.schema))
    left = cp.known_language(spark, docs, sf_dir)
    assert left.count() == docs.where("doc_id < 1000000").count()
    for _, stage in cp.STAGES:
        assert stage(spark, docs.limit(0), sf_dir).collect() == []


def test_other_columns_come_through_every_stage(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").limit(80)
    names = ["found", "Sure", "SCORE", "row", "Row_", "group", "node", "Copy", "shuffle_key", "a.b", "lang_pred"]
    more = docs.select("*", *[F.concat(F.lit(f"{n} "), "doc_id").alias(n) for n in names if n != "Row_"])
    for name, stage in cp.STAGES[:-1]:
        kept = stage(spark, more, sf_dir)
        assert kept.columns == more.columns, name
        rows = kept.collect()
        assert rows and all(r[n] == f"{n} {r['doc_id']}" for r in rows for n in more.columns[5:]), name
    assert cp.packed(spark, more, sf_dir).count() >= 80


def test_only_what_is_rejected_goes(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    assert langid.UNDETERMINED == "und" and quality.GOOD == 0.3
    labels = table(spark, sf_dir, "labels").where("quality = 1")
    clean = docs.join(labels, "doc_id", "left_semi")
    kept = cp.good_quality(spark, docs, sf_dir).join(labels, "doc_id", "left_semi")
    assert kept.count() >= 0.97 * clean.count()


def test_one_of_a_kind_without_ids_and_with_repeated_ones(spark, sf_dir):
    def text(name):
        return " ".join(f"{name}{k}" for k in range(30))

    rows = [(None, text("a")), (None, text("b")), (None, text("b")), (5, text("b")), (1, text("c")), (1, text("c")), (1, text("d")),
            (2, text("d")), (2, text("e")), (3, ""), (3, None), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted(((r["doc_id"], r["text"]) for r in cp.one_of_a_kind(spark, docs, sf_dir).collect()), key=repr)
    wanted = [(None, text("a")), (5, text("b")), (1, text("c")), (1, text("d")), (2, text("e")), (3, ""), (3, None), (None, None)]
    assert kept == sorted(wanted, key=repr)
