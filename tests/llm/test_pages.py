import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from docenrich.llm import htmltext, warc

PAGE = """<!doctype html><html><head><title>T</title><script>var a="<p>no</p>";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<article><h1>Title &amp; more</h1><p>First<br>line <b>bold</b> text.<p>Second &eacute;&#8217;s &nbsp; par</p>
<aside>Aside</aside><form><p>Mail</p></form><div id="ad-1">Buy</div><!-- <p>x</p> --><ul><li>one<li>two</ul>
<section class="comments"><p>Nice post</p></section></article><div class="sidebar"><p>Side</p></div><footer>(c)</footer>"""


def test_article_without_the_rest():
    [text] = htmltext.main_texts([htmltext.page_blocks(PAGE)])
    assert text == "Title & more\nFirst line bold text.\nSecond é’s par\none\ntwo"


def test_a_host_s_repeated_runs_go_where_no_article_is_marked():
    menu = "home about contact imprint privacy jobs press shop"
    note = "all rights reserved by the publisher of this fine site since long ago"
    pages = [
        f"<body><div>{menu}</div><div>{' '.join(f'word{i}x{k}' for k in range(30))}</div><p>Own {i} {note}</p>" for i in range(6)
    ]
    texts = htmltext.main_texts([htmltext.page_blocks(p) for p in pages])
    for i, text in enumerate(texts):
        assert text == " ".join(f"word{i}x{k}" for k in range(30)) + f"\nOwn {i}"


def test_copies_of_marked_articles_stay():
    pages = [f"<article><p>{'the very same article text again and again ' * 3}</p></article>"] * 5
    assert len(set(htmltext.main_texts([htmltext.page_blocks(p) for p in pages]))) == 1
    assert htmltext.main_texts([htmltext.page_blocks(pages[0])] * 5)[0].startswith("the very same")


def test_copies_are_one_witness():
    def of(pages):
        return htmltext.main_texts([htmltext.page_blocks(p) for p in pages])

    words = [f"word{k}" for k in range(150)]
    article = " ".join(words)
    others = [f"<p>{' '.join(f'other{i}x{k}' for k in range(60))}</p>" for i in range(2)]
    assert of([f"<article><p>{article}</p></article>"] * 10 + others)[:10] == [article] * 10
    assert of([f"<div>{article}</div>"] * 3 + others)[:3] == [article] * 3
    # near copies: a word of its own in each
    near = [" ".join([*words[: 10 * i + 5], f"own{i}", *words[10 * i + 6 :]]) for i in range(12)]
    assert of([f"<article><p>{t}</p></article>" for t in near] + others)[:12] == near
    assert of([f"<div>{t}</div>" for t in near[:3]] + others)[:3] == near[:3]
    # an article that pages with other parts around it have in common
    whole = [f"<body><article><p>{article}</p></article><p>{i}</p></body>" for i in range(12)]
    assert of(whole) == [article] * 12


def test_evidence_is_the_host_s_however_it_is_dealt(spark):
    note = "all rights reserved by the publisher of this fine site since long ago"
    third = "some pages only say this line that has more than eight words"
    html = [
        f"<body><div>{' '.join(f'word{i}x{k}' for k in range(30))}</div><p>{note if i % 20 else third}</p></body>" for i in range(227)
    ]
    html += [html[5]] * 30
    rows = [(i, f"http://big.example/{i}", h) for i, h in enumerate(html)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    wanted = htmltext.main_texts([htmltext.page_blocks(h) for h in html])
    assert note not in "".join(wanted) and "".join(wanted).count(third) == 12
    for parts in (1, 7):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        found = {r["page_id"]: r["text"] for r in htmltext.extract_main_text(df.repartition(parts)).collect()}
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        assert [found[i] for i in range(len(html))] == wanted


@pytest.mark.parametrize("count, words, parts", [(8, 400, 1), (40, 150, 7), (200, 400, 7), (1200, 400, 1), (1200, 150, 7), (5000, 150, 7)])
def test_near_copies_keep_their_texts_however_many(spark, count, words, parts):
    base = [f"word{k}" for k in range(words)]
    texts = [" ".join([*base[: i % words], f"own{i}", *base[i % words + 1 :]]) for i in range(count)]
    rows = [(i, "http://copies.example/x", f"<body><div>{t}</div></body>") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(parts)
    found = {r["page_id"]: r["text"] for r in htmltext.extract_main_text(df).collect()}
    assert [found[i] for i in range(count)] == texts


def test_repeated_runs_by_plain_search():
    import numpy as np

    rng = np.random.default_rng(1)
    words = rng.integers(0, 3, 400).astype(np.uint64)
    page = np.repeat(np.arange(10), 40)
    shared, _ = htmltext.repeated_runs(words, page, 8)
    for i in range(400):
        if i % 40 > 32:
            assert shared[i] == 1
            continue
        run = words[i : i + 8].tolist()
        where = {p for p in range(10) for k in range(33) if words[p * 40 + k : p * 40 + k + 8].tolist() == run}
        assert shared[i] == len(where)


def test_odd_pages(spark):
    rows = [(1, "http://a.b/x", PAGE), (2, None, None), (None, "no url", ""), (4, "http://a.b/y", "<p>" * 2000 + "x" * 100_000),
            (4, "http://a.b/y", "a < b & c > d <3 <"), (5, "u", "<script>never closed"), (6, "u", "<a title='>'>t</a><!-- open")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    found = {(r["page_id"], r["url"], len(r["text"])): r["text"] for r in htmltext.extract_main_text(df).collect()}
    assert len(found) == len(rows)
    assert found[4, "http://a.b/y", 18] == "a < b & c > d <3 <" and found[6, "u", 1] == "t"
    assert htmltext.extract_main_text(df.limit(0)).collect() == []


BODY = "<p>Grüße 😀 and more text that is long enough to be written only once, as a revisit refers to it.</p>\r\n\r\n"


@pytest.fixture
def pages(spark):
    rows = [(1, "http://x/1", BODY), (3, "http://x/3", BODY), (2, "http://x/2\r\n", BODY), (2, "http://x/2", BODY), (7, None, None),
            (8, "http://x/8", ""), (9, "u", "short"), (10, "u", "short"), (11, "u", "WARC/1.1\r\n\r\n" * 30_000), (None, "u", "none"),
            (12, "u", "0\r\n\r\n")]
    return spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload int")


def test_archives_round_trip(spark, pages, tmp_path):
    warc.write_archives(pages, str(tmp_path / "a"), segment_chars=1000)
    records = warc.read_archives(spark, str(tmp_path / "a")).withColumn("page", warc.page_of(F.col("record_id"))).collect()
    assert len(records) == pages.count()
    html = {r["page_id"]: r["html"] or "" for r in pages.collect()}
    for r in records:
        body = html[r["page"]].encode()
        assert r["payload_bytes"] == len(body) and r["payload_digest"] == hashlib.sha256(body).hexdigest()
        assert r["record_type"] == "revisit" or bytes(r["payload"]) == body
    again = [r for r in records if r["record_type"] == "revisit"]
    assert sorted(r["page"] for r in again) == [2, 2, 3] and {warc_page(r["refers_id"]) for r in again} == {1}
    assert warc.archive_and_read(pages.limit(0)).collect() == []


def test_many_copies_and_empty_pages_over_shuffled_input(spark):
    rows = [(i, "u", BODY if i % 3 == 0 else "" if i % 3 == 1 else f"{BODY}{i}") for i in range(600)] + [(0, "u", BODY)] * 2
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int")
    for parts in (1, 9):
        found = warc.archive_and_read(df.repartition(parts)).withColumn("page", warc.page_of(F.col("record_id"))).collect()
        assert len(found) == len(rows)
        by_id = {r["record_id"]: r for r in found}
        for r in found:
            whole = r["page"] % 3 or r["refers_id"] is None
            assert r["record_type"] == ("response" if whole else "revisit")
            if not whole:
                target = by_id[r["refers_id"]]
                assert target["page"] == 0 and target["record_type"] == "response" and target["payload_digest"] == r["payload_digest"]
        assert sum(r["record_type"] == "response" for r in found if r["page"] % 3 == 0) == 1
    told = warc.archive_and_read(df, with_payload=False).collect()
    assert {r["payload"] for r in told} == {None} and {r["payload_bytes"] for r in told} == {r["payload_bytes"] for r in found}


def warc_page(record_id):
    return int(record_id.split(":")[2])


def test_segments_in_files_and_order(spark, pages, tmp_path):
    warc.write_archives(pages.where("page_id = 11"), str(tmp_path / "a"), segment_chars=500)
    [file] = (tmp_path / "a").glob("*.gz")
    records = list(warc.parse_records(gzip.decompress(file.read_bytes())))
    assert len(records) > 700 and records[1][0]["warc-type"] == "continuation"
    assert sum(len(b) for _, b in records) == int(records[-1][0]["warc-segment-total-length"])


def test_broken_archives_fail():
    record = b"WARC/1.1\r\nWARC-Record-ID: <a>\r\nContent-Length: 10\r\n\r\n0123"
    with pytest.raises(ValueError):
        list(warc.parse_records(record))
    with pytest.raises(ValueError):
        list(warc.parse_records(b"no archive"))
    with pytest.raises(ValueError):
        warc.dechunk(b"5\r\nabc\r\n0\r\n\r\n")
    assert warc.dechunk(b"3;x=y\r\nabc\r\n1\r\nd\r\n0\r\nTrailer: 1\r\n\r\n") == b"abcd"
