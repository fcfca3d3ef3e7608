import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from docenrich.llm import langid, quality
from docenrich.llm.queries import op5_quality, op8_langid, table

ODD = [(1, "déjà vu"), (2, None), (3, ""), (4, "12 34 --"), (5, "x" * 100_000), (5, "x"), (None, "und so weiter")]


def test_languages_of_held_out_documents(spark, sf_dir):
    found = op8_langid(spark, sf_dir).join(table(spark, sf_dir, "documents"), "doc_id").toPandas()
    assert (found.held_out == found.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    held = found[found.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97 and found.score.between(0, 1).all()


def test_distance_is_the_plain_one(spark):
    rng = random.Random(4)
    profiles = {"a": langid.ranked(langid.ngram_codes("the quick brown fox the end"), 20).tolist(),
                "b": langid.ranked(langid.ngram_codes("der schnelle fuchs der anfang"), 20).tolist()}
    texts = [" ".join(rng.choices(["the", "der", "fox", "fuchs", "x1y", "Ümit"], k=5)) for _ in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for row in langid.identify(df, profiles, top=20).collect():
        mine = langid.ranked(langid.ngram_codes(row["text"]), 20).tolist()
        away = {
            lang: sum(min(20, abs(p.index(c) - i)) if c in p else 20 for i, c in enumerate(mine))
            for lang, p in profiles.items()
        }
        best = min(sorted(away), key=away.get)
        assert row["lang_pred"] == best and abs(row["score"] - (1 - away[best] / (20 * len(mine)))) < 1e-9


def test_odd_texts_have_a_language_or_none(spark):
    df = spark.createDataFrame([(*r, "old", 0.5) for r in ODD], "doc_id long, text string, lang_pred string, score double")
    profiles = langid.learn_profiles(spark.createDataFrame([("ein haus", "de"), ("a house", "en"), (None, "fr"), ("x", None)], "text string, lang string"))
    assert sorted(profiles) == ["de", "en"]
    found = {(r["doc_id"], r["text"]): r for r in langid.identify(df, profiles).collect()}
    assert len(found) == len(ODD)
    for key in [(2, None), (3, ""), (4, "12 34 --")]:
        assert found[key]["lang_pred"] == "und" and found[key]["score"] == 0
    nothing = langid.learn_profiles(spark.createDataFrame([], "text string, lang string"))
    assert {r["lang_pred"] for r in langid.identify(df, nothing).collect()} == {"und"}
    assert langid.identify(df.limit(0), profiles).collect() == []


def test_quality_of_held_out_documents(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    found = op5_quality(spark, sf_dir).join(labels, "doc_id").toPandas()
    held = found[found.held_out]
    assert (held.predicted == held.quality).mean() > 0.85 and found.score.between(0, 1).all()


def test_few_labels_are_all_used(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels").select("doc_id", "quality")
    # twenty times as many documents, of which one in some hundreds has a label
    many = docs.select("text", F.explode(F.sequence(F.lit(0), F.lit(19))).alias("k"), "doc_id")
    many = many.select((F.col("doc_id") * 20 + F.col("k")).alias("doc_id"), "text")
    few = labels.where("doc_id % 7 = 0").withColumn("doc_id", F.col("doc_id") * 20)
    assert 20 < few.count() < 150
    model = quality.learn(many, few, sample_rows=1000)
    assert model.hidden.any()
    found = quality.score(docs, model).join(labels, "doc_id").toPandas()
    assert ((found.score >= quality.GOOD) == found.quality).mean() > 0.85


def test_held_out_labels_do_not_matter(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learned = ~quality.held_out(F.col("doc_id"))
    flipped = labels.withColumn("quality", F.when(learned, F.col("quality")).otherwise(1 - F.col("quality")))
    one = quality.learn(docs.where(learned), labels.where(learned))
    other = quality.learn(docs.where(learned), flipped.where(learned))
    assert np.array_equal(one.hidden, other.hidden) and one.out_bias == other.out_bias


def test_odd_texts_have_a_score(spark):
    df = spark.createDataFrame([(*r, "x") for r in ODD], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (3, 0), (4, None)], "doc_id long, quality int")
    model = quality.learn(df, labels)
    scores = [r["score"] for r in quality.score(df, model).collect()]
    assert len(scores) == len(ODD) and all(0 <= s <= 1 for s in scores)
    none = quality.learn(df.limit(0), labels.limit(0))
    assert {r["score"] for r in quality.score(df, none).collect()} == {0.0, 0.5}
    assert quality.score(df.limit(0), model).collect() == []


def test_prior_from_positives_and_unlabelled():
    rng = np.random.default_rng(1)
    positive, negative = rng.normal(0, 1, (4000, 2)), rng.normal(6, 1, (1200, 2))
    mixed = np.concatenate([rng.normal(0, 1, (2800, 2)), negative])
    assert abs(quality.estimated_prior(positive, mixed) - 0.7) < 0.06
    model = quality.fit(positive, mixed, 0.7)
    assert model.scores(negative).mean() < 0.1 and model.scores(positive).mean() > 0.9
