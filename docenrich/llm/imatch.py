"""I-Match document fingerprints, in DataFrame functions alone.

A text's terms (runs of letters and digits, lower-cased) are looked up in a
lexicon: those whose document frequency lies in a band, so that neither words
of every text nor words of a single one count. The distinct terms of the text
that the lexicon keeps are sorted, and hashed once for the whole lexicon and once
for each of several randomised subsets of it. Dense subsets tell near copies
apart, sparse ones still agree on texts that share a part.

Copies push their own terms out of the band. So it is enough for a term to be
in few of the distinct texts, and a text that has little of the lexicon, as
all of a large group of near copies, is hashed by the same subsets of all its terms.

Terms are not joined with the lexicon one by one. What the band leaves out is
little: a bounded number of frequent terms, which every task knows, and terms of
a single text, which travel to that text. An edited text consists of words of two
texts, but for the two words at its seams; these are looked up.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docenrich.llm.common import Workspace, clean_text

#: A lexicon term is in at least so many documents ...
MIN_DF = 2
#: ... and in at most this share of them, or of their distinct texts.
MAX_DF_SHARE = 0.1
#: A text with fewer lexicon terms than one of so many is fingerprinted by all its terms.
FEW_ONE_IN = 4
#: Subset j of the lexicon keeps one term of 2 ** LEVELS[j]; these are bits of the
#: term's hash that no other subset looks at.
LEVELS = (1, 1, 2, 2, 3, 3, 4, 4, 4, 4, 5, 5, 6, 6, 7, 7)
#: The levels are used twice, with two hashes of each term; and there is the whole lexicon.
SUBSETS = 2 * len(LEVELS)
_ROWS_PER_BUCKET = 2048
_QUANTILES = 64
#: Buckets that one task lines up at a time.
_LINE = 1024
_LETTERS = r"[\p{L}\p{N}]"
_GAPS = r"[^\p{L}\p{N}]+"


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text, next_id, next_text)``: the next row by descending id; after the last, the first.

    Null texts are empty. Rows that repeat an id follow each other in the order
    of their texts' hashes; rows without an id come last. The rows are dealt to
    buckets of neighbouring ids by the quantiles of the ids, and each bucket
    also gets the head of the one that follows it, so that no task sees more
    than a bucket.
    """
    rows = _rows(docs, id_col, text_col)
    lined = _follow(_dealer(rows)(rows), "text")
    return lined.select("doc_id", "text", F.col("next.doc_id").alias("next_id"), F.col("next.text").alias("next_text"))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), clean_text(text_col).alias("text")).withColumn(
        "key", F.xxhash64("text")
    )


def _dealer(names: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Deals rows to their ``bucket``, and those of the first row of each bucket once more,
    as its ``ghost``, to the bucket before it.

    ``names`` has the ``doc_id`` and ``key`` of all rows.
    """
    names = names.select("doc_id", "key")
    bucket = _bucket(names)
    place = F.struct(F.isnull("doc_id"), F.bitwise_not("doc_id").alias("down"), "key")
    heads = names.groupBy(bucket.alias("bucket")).agg(F.min(place).alias("head"))
    heads = heads.join(_bucket_after(heads.select("bucket")), "bucket").select(
        F.bitwise_not("head.down").alias("head_id"), F.col("head.key").alias("head_key"), "to"
    )
    head = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("key") == F.col("head_key"))
    once = lambda to, ghost: F.struct(to.alias("bucket"), F.lit(ghost).alias("ghost"))
    place = F.when(F.col("to").isNull(), F.array(once(bucket, 0))).otherwise(F.array(once(bucket, 0), once(F.col("to"), 1)))
    return lambda rows: rows.join(heads, head, "left").select(*rows.columns, F.inline(place)).repartition("bucket")


def _follow(dealt: DataFrame, *columns: str) -> DataFrame:
    """Dealt rows with ``next``, the ``doc_id`` and ``columns`` of the row that follows."""
    line = Window.partitionBy("bucket").orderBy("ghost", F.desc_nulls_last("doc_id"), "key")
    return dealt.withColumn("next", F.lead(F.struct("doc_id", *columns)).over(line)).where("ghost = 0")


def _bucket(names: DataFrame) -> Column:
    """Number of the bucket a row goes to: higher ids, higher numbers."""
    steps = [i / _QUANTILES for i in range(1, _QUANTILES)]
    count, low, high, cuts = names.agg(
        F.count("*"), F.min("doc_id"), F.max("doc_id"), F.percentile_approx("doc_id", steps, 10_000)
    ).first()
    # rows without id: 1024 buckets by their order, that of the hashes
    unnamed = -513 - F.shiftright("key", 54)
    if low is None:
        return unnamed
    edges = sorted({low, *(cuts or []), high + 1})
    within = max(1, -(-count // (_QUANTILES * _ROWS_PER_BUCKET)))
    spans = F.array(*[F.struct(F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b"))
                      for a, b in zip(edges, edges[1:])])
    part = F.size(F.filter(spans, lambda s: s["a"] <= F.col("doc_id"))) - 1
    span = F.get(spans, part)
    inside = F.floor((F.col("doc_id") - span["a"]) / (span["b"] - span["a"]) * within)
    named = part.cast("long") * within + F.least(inside, F.lit(within - 1))
    return F.when(F.col("doc_id").isNull(), unnamed).otherwise(named)


def _bucket_after(buckets: DataFrame) -> DataFrame:
    """``(bucket, to)``: the bucket before it in the line, whose last row it follows.

    Buckets are lined up ``_LINE`` numbers at a time; only the greatest of each
    stretch meet in one task.
    """
    stretch = F.floor(F.col("bucket") / _LINE)
    rows = buckets.withColumn("stretch", stretch)
    # descending ids: the bucket before is the next greater one, and the last follows round
    inside = Window.partitionBy("stretch").orderBy(F.desc("bucket"))
    over = Window.orderBy(F.desc("stretch"))
    ends = rows.groupBy("stretch").agg(F.min("bucket").alias("least")).select(
        "stretch", F.coalesce(F.lag("least").over(over), F.min("least").over(Window.partitionBy())).alias("round")
    )
    return rows.join(ends, "stretch").select("bucket", F.coalesce(F.lag("bucket").over(inside), F.col("round")).alias("to"))


def edited_text(text: Column, following: Column) -> Column:
    """The last floor(n / 2) code points replaced by as many (or all) of the next text's first."""
    first, second = _halves(text, following)
    return F.concat(first, second)


def _halves(text: Column, following: Column) -> tuple[Column, Column]:
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(following, F.lit(1), half)


def term_hashes(text: Column) -> Column:
    """Hashes of the distinct terms of a text. Words are lower-cased one by one, so
    that a word is the same term whatever stands beside it."""
    words = F.filter(F.split(text, _GAPS), lambda w: w != "")
    return F.array_distinct(F.transform(words, _term))


def _term(word: Column) -> Column:
    return F.xxhash64(F.lower(word))


def seam_terms(text: Column, following: Column) -> Column:
    """The terms of an edited text that need not be terms of the texts it is made of."""
    first, second = _halves(text, following)
    # from the beginning of a word only, so that long words are not tried from every letter
    last = rf"((?<!{_LETTERS}){_LETTERS}++)$"
    joined = F.concat(F.regexp_extract(first, last, 1), F.regexp_extract(second, rf"^{_LETTERS}++", 0))
    words = F.array(joined, F.regexp_extract(second, last, 1))
    return F.array_distinct(F.transform(F.filter(words, lambda w: w != ""), _term))


def subset_hashes(terms: Column) -> Column:
    """Hashes of sorted terms: of all of them, then of what each subset keeps."""

    def keeps(low: int, level: int):
        return lambda t: F.shiftright(t, low).bitwiseAND(F.lit((1 << level) - 1)) == 0

    again = F.transform(terms, lambda t: F.xxhash64(t))
    hashes = [F.xxhash64(terms, F.lit(0))]
    for j, level in enumerate(LEVELS * 2):
        low = sum(LEVELS[: j % len(LEVELS)])
        kept = F.filter(terms if j < len(LEVELS) else again, keeps(low, level))
        hashes.append(F.xxhash64(kept, F.lit(j + 1)))
    return F.array(*hashes)


def shortened(hashes: Column) -> Column:
    """32-bit hashes from 1 on; 0 for a subset that keeps none of the terms."""
    none = F.array(*[F.xxhash64(F.lit(j)) for j in range(SUBSETS + 1)])
    return F.transform(
        hashes,
        lambda h, j: F.when((j > 0) & (h == F.get(none, j)), F.lit(0).cast("long")).otherwise(
            F.pmod(h, F.lit((1 << 32) - 1)) + 1
        ),
    )


def _fingerprints(rows: DataFrame, terms: Column, left_out: Column, frequent: list[int], name: str) -> DataFrame:
    """``rows`` with the hashes of ``terms``, ``left_out`` and the frequent ones aside."""
    # one constant, not an expression for each term
    known = F.split(F.lit(",".join(map(str, frequent))), ",").cast("array<bigint>") if frequent else None
    outside = F.concat(left_out, known) if known is not None else left_out
    own, band = f"{name}_own", f"{name}_band"
    chosen = F.when(F.size(band) * FEW_ONE_IN < F.size(own), F.col(own)).otherwise(F.col(band))
    rest = [c for c in rows.columns if c != name]
    return (
        rows.withColumn(own, terms)
        .withColumn(band, F.array_except(own, outside))
        .select(*rest, F.sort_array(chosen).alias(own))
        .select(*rest, subset_hashes(F.col(own)).alias(own))
        .select(*rest, shortened(F.col(own)).alias(name))
    )


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the subsets that either text has terms of."""
    pairs = F.zip_with(a, b, lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    seen = F.size(F.filter(pairs, lambda p: (p["x"] != 0) | (p["y"] != 0)))
    same = F.size(F.filter(pairs, lambda p: (p["x"] != 0) & (p["x"] == p["y"])))
    return F.when(seen == 0, F.lit(0.0)).otherwise(same / seen)


def as_text(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.lpad(F.hex(h), 8, "0"))), "")


def frequent_terms(rows: DataFrame, names: DataFrame, vocabulary: DataFrame, work: Workspace) -> list[int]:
    """Terms above the band: in more than the share of all rows, and of the distinct texts.

    No more than ``1 / MAX_DF_SHARE`` times the mean number of terms of a text.
    """
    most = lambda n: max(MIN_DF, n * MAX_DF_SHARE)
    copies = work.save(
        names.groupBy("key").agg(F.count("*").alias("rows"), F.min("doc_id").alias("first_id")).where("rows > 1"), "copies"
    )
    n = names.count()
    surplus = copies.agg(F.sum(F.col("rows") - 1)).first()[0] or 0
    df = {r["term"]: r["df"] for r in vocabulary.where(F.col("df") > most(n)).select("term", "df").collect()}
    if df and surplus:
        # one of each group of copies, and what its copies add
        one = rows.join(copies, "key").where(F.col("doc_id").eqNullSafe(F.col("first_id")))
        known = F.split(F.lit(",".join(map(str, df))), ",").cast("array<bigint>")
        mine = one.select("key", "rows", F.array_intersect(term_hashes(F.col("text")), known).alias("terms"))
        more = (
            mine.dropDuplicates(["key"])
            .select("rows", F.explode("terms").alias("term"))
            .groupBy("term")
            .agg(F.sum(F.col("rows") - 1).alias("more"))
        )
        for r in more.collect():
            df[r["term"]] -= r["more"]
    work.drop(copies)
    return sorted(term for term, fresh in df.items() if fresh > most(n - surplus))


def fingerprint_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and of the next text.

    Returns ``doc_id, n_chars, edited_sha256, hashes, edited_hashes,
    next_hashes``. Null text: empty. A text that has few lexicon terms (empty
    ones too) is fingerprinted by all its terms; each text, edited or not, by itself,
    so equal texts have equal hashes. Repeated rows stay; an empty table gives an
    empty one; other columns are not looked at.
    """
    work = Workspace(docs.sparkSession, "imatch")
    rows = _rows(docs, id_col, text_col)
    vocabulary = work.save(
        rows.select("doc_id", "key", F.explode(term_hashes(F.col("text"))).alias("term"))
        .groupBy("term")
        # of a term in one row: that row
        .agg(F.count("*").alias("df"), F.min("doc_id").alias("doc_id"), F.min("key").alias("key")),
        "vocabulary",
    )
    names = work.save(rows.select("doc_id", "key"), "names")
    frequent = frequent_terms(rows, names, vocabulary, work)
    deal = _dealer(names)
    lined = _follow(deal(rows), "text")
    seams = work.save(
        lined.select("doc_id", "key", F.explode(seam_terms(F.col("text"), F.col("next.text"))).alias("term")), "seams"
    )
    below = seams.join(vocabulary.select("term", "df"), "term", "left").where(F.coalesce("df", F.lit(0)) < MIN_DF)
    left_out = work.save(
        vocabulary.where(F.col("df") < MIN_DF)
        .select("doc_id", "key", "term")
        .union(below.select("doc_id", "key", "term"))
        .groupBy("doc_id", "key")
        .agg(F.collect_set("term").alias("out")),
        "left_out",
    )
    work.drop(vocabulary, seams)
    # what is left out travels to its text's bucket as a row of its own, just before the text
    nothing = lambda kind: F.lit(None).cast(kind)
    both = rows.select("doc_id", "key", F.lit(1).alias("is_text"), "text", nothing("array<bigint>").alias("out")).union(
        left_out.select("doc_id", "key", F.lit(0), nothing("string"), "out")
    )
    its = Window.partitionBy("bucket", "ghost", "doc_id", "key").orderBy("is_text")
    none = F.array().cast("array<bigint>")
    known = (
        deal(both)
        .withColumn("out", F.coalesce(F.first("out").over(its), none))
        .where("is_text = 1")
        .select("doc_id", "key", "text", "out", "bucket", "ghost")
    )
    known = _fingerprints(known, term_hashes(F.col("text")), F.col("out"), frequent, "hashes")
    lined = _follow(known, "text", "out", "hashes").select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        edited_text(F.col("text"), F.col("next.text")).alias("edited"),
        F.concat("out", "next.out").alias("out"),
        "hashes",
        F.col("next.hashes").alias("next_hashes"),
    )
    lined = lined.withColumn("edited_sha256", F.sha2("edited", 256))
    edited = _fingerprints(lined, term_hashes(F.col("edited")), F.col("out"), frequent, "edited_hashes")
    return edited.select("doc_id", "n_chars", "edited_sha256", "hashes", "edited_hashes", "next_hashes")
