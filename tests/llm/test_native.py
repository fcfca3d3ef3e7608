import hashlib
import math
import re

import pytest
from pyspark.sql import functions as F

from docenrich.llm import imatch, licenses, mixing
from docenrich.llm.queries import op7_imatch

LONG = "Zeile eins hier\n" * 20_000


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_edited_texts_and_lengths(spark):
    texts = {1: "abcdef", 2: "αβγδε😀", 3: "", 4: None, 10: "xy", 11: LONG, 12: "q"}
    df = spark.createDataFrame([(i, t, 5) for i, t in texts.items()], "doc_id long, text string, bucket int")
    found = {r["doc_id"]: r for r in imatch.fingerprint_with_edits(df).collect()}
    order = sorted(texts, reverse=True)
    for i, own in enumerate(order):
        text, following = texts[own] or "", texts[order[(i + 1) % len(order)]] or ""
        half = len(text) // 2
        edit = text[: len(text) - half] + following[:half]
        assert found[own]["n_chars"] == len(text)
        assert found[own]["edited_sha256"] == hashlib.sha256(edit.encode()).hexdigest()


def test_next_rows_with_repeats_and_no_ids(spark):
    rows = [(5, "a"), (5, "b"), (5, "b"), (None, "n"), (None, None), (9, "z")] + [(i * 1000, f"t{i}") for i in range(20, 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = imatch.with_next(df).collect()
    assert len(found) == len(rows) and all(r["next_text"] is not None for r in found)
    assert {r["next_text"] for r in found if r["doc_id"] == 9} <= {"a", "b"}
    unnamed = [(None, f"n{i % 90}") for i in range(100)]
    for all_rows in (rows + unnamed, unnamed):
        found = imatch.with_next(spark.createDataFrame(all_rows, "doc_id long, text string")).collect()
        assert sorted(r["next_text"] for r in found) == sorted(t or "" for _, t in all_rows)
        assert sorted(r["text"] for r in found) == sorted(t or "" for _, t in all_rows)
    assert imatch.fingerprint_with_edits(df.limit(0)).collect() == []
    assert imatch.with_next(spark.createDataFrame([(1, "only")], "doc_id long, text string")).first()["next_text"] == "only"


def test_next_rows_over_many_buckets_of_copies(spark):
    rows = [(i * 3 - 5000, "copy" if i % 3 else f"text {i}") for i in range(4000)]
    found = imatch.with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    line = sorted(rows, reverse=True)
    wanted = {a: b for (a, _), b in zip(line, line[1:] + line[:1])}
    assert {r["doc_id"]: (r["next_id"], r["next_text"]) for r in found} == wanted
    assert len(found) == len(rows)


def test_fingerprints_by_plain_lexicon(spark):
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words[i % 50 : i % 50 + 9]) + (" Common" if i % 2 else "") for i in range(80)] + ["lonely rareword", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in imatch.fingerprint_with_edits(df).collect()}
    terms = [set(re.findall(r"[^\W_]+", (t or "").lower())) for t in texts]
    df_of = {w: sum(w in t for t in terms) for w in set().union(*terms)}
    limit = max(imatch.MIN_DF, len(texts) * imatch.MAX_DF_SHARE)
    kept = [frozenset(w for w in t if imatch.MIN_DF <= df_of[w] <= limit) or frozenset(t) for t in terms]
    # equal lexicon terms, equal hashes; and the other way round
    by_terms, by_hashes = {}, {}
    for i, t in enumerate(kept):
        by_terms.setdefault(t, set()).add(tuple(found[i]["hashes"]))
        by_hashes.setdefault(tuple(found[i]["hashes"]), set()).add(t)
    assert all(len(x) == 1 for x in by_terms.values()) and all(len(x) == 1 for x in by_hashes.values())


def test_every_term_of_the_band_counts(spark):
    texts = [f"left{i} right{i} own{i}x{k}" for i in range(40) for k in (0, 1)]
    texts += [f"left{i} own{i}x2" for i in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: tuple(r["hashes"]) for r in imatch.fingerprint_with_edits(df).collect()}
    for i in range(40):
        assert found[2 * i] == found[2 * i + 1] != found[80 + i]


def test_near_copies_are_alike_however_many(spark):
    base = [f"base{k}" for k in range(60)]
    near = [" ".join([*base[: i % 60], f"changed{i // 2}", *base[i % 60 + 1 :]]) for i in range(40)]
    copies = [" ".join(f"copied{k}" for k in range(30))] * 20
    other = [" ".join(f"other{i // 2}x{k}" for k in range(60)) for i in range(60)]
    df = spark.createDataFrame(list(enumerate(near + copies + other)), "doc_id long, text string")
    prints = imatch.fingerprint_with_edits(df).select(
        "doc_id",
        imatch.likeness(F.col("hashes"), F.col("edited_hashes")).alias("edited"),
        imatch.likeness(F.col("hashes"), F.col("next_hashes")).alias("next"),
    )
    found = {r["doc_id"]: r for r in prints.collect()}
    # ids descend: the next row of 1 is 0
    assert all(0.4 < found[i]["next"] < 1 for i in range(2, 40, 2))
    # half of an edited text is new, so a few of the subsets at most agree
    assert sum(found[i]["edited"] for i in range(1, 40)) / 39 > 0.1
    assert all(found[i]["next"] == 1 for i in range(41, 60))


def test_equal_texts_have_equal_fingerprints_edited_or_not(spark):
    # the edited text of row 5 is the text of row 2
    rows = [(9, "one two three four"), (5, "one two t--------"), (4, "hree fou and more"), (2, "one two three fou"), (1, "ΟΔΟΣ ΟΔΟΣ'Α"), (0, "zz")]
    rows += [(100 + i, f"one two many{i % 3} words{i}") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    prints = {}
    found = imatch.fingerprint_with_edits(df).collect()
    texts = dict(rows)
    for r in found:
        prints.setdefault(hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest(), set()).add(tuple(r["hashes"]))
        prints.setdefault(r["edited_sha256"], set()).add(tuple(r["edited_hashes"]))
    assert all(len(x) == 1 for x in prints.values())
    edited = {r["doc_id"]: r["edited_sha256"] for r in found}
    assert edited[5] == hashlib.sha256(b"one two three fou").hexdigest()


def test_equal_texts_have_equal_fingerprints_on_all_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = imatch.fingerprint_with_edits(docs).join(docs.select("doc_id", F.sha2("text", 256).alias("sha256")), "doc_id")
    both = found.select("sha256", "hashes").union(found.select("edited_sha256", "edited_hashes"))
    per_text = both.distinct().groupBy("sha256").count()
    assert per_text.where("count > 1").isEmpty() and per_text.count() > docs.count()
    # texts with different terms are told apart by the whole lexicon
    assert both.distinct().count() > 0.95 * per_text.count()


def test_seams_of_an_edit_are_looked_up(spark):
    text, following = "Straße und weiter", "gehend oder nicht"
    df = spark.createDataFrame([(text, following), ("", ""), ("a", "b"), ("x" * 5000, "y" * 5000)], "a string, b string")
    terms = lambda c: imatch.term_hashes(c)
    edited = imatch.edited_text(F.col("a"), F.col("b"))
    rows = df.select(
        F.array_except(terms(edited), F.array_union(terms(F.col("a")), terms(F.col("b")))).alias("new"),
        imatch.seam_terms(F.col("a"), F.col("b")).alias("seams"),
    ).collect()
    assert all(set(r.new) <= set(r.seams) and len(r.seams) <= 2 for r in rows)
    assert len(rows[0].new) >= 1 and rows[1].seams == []


def test_likeness(spark):
    row = spark.sql("select array(1,0,3,0) a, array(1,2,0,0) b, array(0,0,0,0) z")
    got = row.select(imatch.likeness(F.col("a"), F.col("b")), imatch.likeness(F.col("a"), F.col("a")), imatch.likeness(F.col("z"), F.col("z"))).first()
    assert tuple(got) == (1 / 3, 1.0, 0.0)


def test_fingerprint_query_is_native(spark, sf_dir):
    found = op7_imatch(spark, sf_dir)
    assert not re.search("Python|Pandas|Arrow", plan_of(found))
    rows = found.toPandas()
    assert (rows.near_edited.mean() > 5 * rows.near_next.mean()) and rows.near_edited.between(0, 1).all()


def plain_licences(text):
    """(license) to (dice, n_units), by trying every place of every template."""
    words = re.findall("[a-z0-9]+", (text or "").lower())
    matched = []
    for name, notice in licenses.TEMPLATES:
        own = re.findall("[a-z0-9]+", notice.lower())
        pairs = list(zip(own, own[1:]))
        places = {pair: pairs.index(pair) for pair in pairs}
        for start in range(1 - len(own), len(words)):
            aligned = sum(0 <= start + k < len(words) - 1 and (words[start + k], words[start + k + 1]) == pair for pair, k in places.items())
            first, past = max(start, 0), min(start + len(own), len(words))
            window = set(zip(words[first:past], words[first + 1 : past]))
            dice = 2 * len(window & set(pairs)) / (len(window) + len(places))
            if 10 * aligned >= licenses.ALIGNED * len(places) and dice >= licenses.THRESHOLD:
                matched.append((first, past, -dice, name))
    units, end = [], -1
    for first, past, less, name in sorted(matched):
        if first >= end:
            units.append([])
        units[-1].append((less, name))
        end = max(end, past)
    found = {}
    for unit in units:
        less, name = min(unit)
        dice, n = found.get(name, (0, 0))
        found[name] = max(dice, -less), n + 1
    return found


FULL_MIT = next(notice for name, notice in reversed(licenses.TEMPLATES) if name == "MIT")


def test_licences_wherever_they_stand(spark):
    apache = "Licensed under the Apache License, Version 2.0."
    texts = {
        1: "Some prose.\nReleased under the MIT License.\nMore prose.", 2: "released UNDER the MIT licence", 3: None, 4: "", 5: "MIT",
        6: f"{apache}\r\n{apache}", 7: LONG, 8: licenses.TEMPLATES[20][1],
        9: "Permission is hereby granted, free of charge, to any person",
        10: "A long line of prose that ends so. Licensed under the MIT License. And then it goes on, on the same line.",
        11: "Words before it.\n" + FULL_MIT.replace(", ", ",\n * ") + "\nWords behind it. " + apache,
        12: FULL_MIT.replace("Software", "Program").replace("AUTHORS OR COPYRIGHT", "WRITERS OR COPYRIGHT"),
        13: "This work is licensed under the\n// GNU General Public License,\n// version 3.\nThis work is licensed under the GNU General Public License, version 2.",
        14: FULL_MIT[200:], 15: f"{apache} {LONG} {apache}", 16: "Licensed under CC BY 4.0. Licensed under CC BY-SA 4.0.",
    }
    df = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id long, text string, license string")
    expected = {(i, name): v for i, t in texts.items() if i not in (7, 15) for name, v in plain_licences(t).items()}
    expected |= {(15, "Apache-2.0"): (1.0, 2)}
    found = licenses.scan_licenses(df)
    assert not re.search("Python|Pandas|Arrow", plan_of(found))
    got = {(r["doc_id"], r["license"]): (r["dice"], r["n_units"]) for r in found.collect()}
    assert got.keys() == expected.keys()
    assert all(math.isclose(got[k][0], expected[k][0]) and got[k][1] == expected[k][1] for k in got)
    # inside a line, wrapped over several, as a full text with changes, next to another
    assert {(1, "MIT"), (10, "MIT"), (11, "MIT"), (11, "Apache-2.0"), (12, "MIT"), (13, "GPL-3.0"), (13, "GPL-2.0")} <= got.keys()
    assert licenses.scan_licenses(df.limit(0)).collect() == []


def test_a_hot_notice_and_templates_of_ones_own(spark):
    rows = [(i % 7, "An own notice of ours applies.\n" * (i % 3) + "text") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.license, r.dice, r.n_units) for r in licenses.scan_licenses(df, templates=[("Own", "own notice of ours applies")]).collect()}
    wanted = {}
    for i, text in rows:
        wanted[i] = wanted.get(i, 0) + text.count("notice")
    assert found == {i: ("Own", 1.0, n) for i, n in wanted.items() if n}
    with pytest.raises(ValueError):
        licenses.scan_licenses(df, templates=[("Own", "one")])


def test_poisson_inverts_the_distribution(spark):
    for mean in (0.0, 0.3, 5.0, 31.9):
        u = [0.001, 0.2, 0.5, 0.9, 0.9999]
        df = spark.createDataFrame([(x,) for x in u], "u double")
        got = [r[0] for r in df.select(mixing.poisson(F.lit(mean), F.col("u"))).collect()]
        for x, n in zip(u, got):
            below = [sum(math.exp(-mean) * mean**k / math.factorial(k) for k in range(m + 1)) for m in (n - 1, n)]
            assert (n == 0 or below[0] < x) and below[1] >= x - 1e-12


def test_mixture_meets_its_weights(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    many = docs.withColumn("text", F.lit("ten chars."))
    many = many.crossJoin(spark.range(20)).withColumn("doc_id", F.col("doc_id") * 20 + F.col("id")).drop("id")
    many = many.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "a").when(F.col("doc_id") % 3 == 1, "b"))
    mixed = mixing.mix(many, {"a": 3.0, None: 1.0}).groupBy("source").count().collect()
    counts = {r["source"]: r["count"] for r in mixed}
    total = many.count()
    assert set(counts) == {"a", None}
    assert abs(counts["a"] / total - 0.75) < 0.05 and abs(counts[None] / total - 0.25) < 0.03


def test_odd_sources(spark):
    rows = [(1, "abc", "s", 0), (1, "abc", "s", 0), (None, None, None, 1), (2, "", "t", 2), (3, "x" * 50_000, "big", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copy int")
    mixed = mixing.mix(df, {"s": 400.0, "big": 1.0})
    assert mixed.columns == ["doc_id", "text", "source", "copy", "copy_", "shuffle_key"]
    found = mixed.toPandas()
    assert set(found.source) <= {"s", "big"} and (found.source == "s").sum() > 10_000
    again = mixing.mix(df.repartition(3), {"s": 400.0, "big": 1.0}).toPandas()
    assert sorted(found.shuffle_key) == sorted(again.shuffle_key)
    assert mixing.mix(df.limit(0)).collect() == [] and mixing.mix(df, {}).collect() == []
