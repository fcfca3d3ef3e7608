"""Main text of web pages: markup first, then a host's suffix array.

Pages are dealt out in blocks of a host's pages, of equal size whatever the number
of tasks. The words of a block's pages form one stream, over which a suffix array is built:
runs of words that distinct pages of the host share lie next to each other in
it. What is frequent on a host is so in one of its blocks at least, so the runs
frequent in a block are counted once more over all pages of the host. A run that
enough of them share is boilerplate and is removed; what is unique to the pages
stays. Pages that are equal, or nearly so in a block, are one witness. Pages that
share most of their words are copies of a text, not texts in a common frame:
nothing is removed from a page of which more than half would go. Markup that names
menus, headers, footers, sidebars, notices, adverts, forms and comments is dropped
before; where a page marks its article, only what nearly every page of the host
repeats is removed from it.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docenrich.llm.common import Workspace, clean_text
from docenrich.llm.textbytes import run_hashes, slices, word_bounds, word_hashes

#: Words of the shortest run that counts as repeated (a power of two).
RUN_WORDS = 8
#: Pages of one host that are looked at together, on average at most, and their words (blocks of long pages are cut).
BLOCK_PAGES, BLOCK_WORDS = 256, 400_000
#: Outside of marked articles a run on so many pages, and this share of the host's, is boilerplate ...
LOOSE_PAGES, LOOSE_SHARE = 3, 0.3
#: ... and inside.
MARKED_PAGES, MARKED_SHARE = 10, 0.8
#: Of a page of which more than this share is repeated, nothing is: its host has copies of it.
MOST_REPEATED = 0.5
#: Pages that have this share of their runs in common are copies; looked for by their first runs in order of hash.
COPY_SHARE, COPY_RUNS = 0.8, 8

# Names of the format, and words by which pages name their parts.
_VOID = set("area base br col embed hr img input link meta source track wbr".split())
_RAW = "script style title textarea noscript template iframe svg math canvas object xmp noembed noframes"
_BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
_DROPPED = set("nav footer aside form button select dialog menu head audio video map datalist".split())
_ROLES = set(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar "
    "status tablist".split()
)
_NAMES = set(
    "ad ads adsense advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner "
    "cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login "
    "sidebar sidebars aside nav navbar navigation menu menus breadcrumb breadcrumbs masthead footer comment comments "
    "commentlist disqus respond replies related recommended share sharing social widget widgets toolbar pagination "
    "pager skip".split()
)
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<(?P<raw>%s)(?=[\s/>])[^>]*>.*?(?:</(?P=raw)(?=[\s/>])[^>]*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>[^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+|[^>]*+)>"
    r"|<[!?/][^>]*>" % _RAW.replace(" ", "|"),
    re.S | re.I,
)
_ATTR = re.compile(r"""([^\s"'=/>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")


@dataclass
class Block:
    """A block of a page: its text and where it stands."""

    text: str
    dropped: bool
    marked: int  # 3 in an article, 2 in the main part, 0 elsewhere


def _named(attrs: str) -> tuple[bool, bool, int]:
    """Whether attributes name a part to drop, or a header, and what they mark."""
    drop, header, marked = False, False, 0
    for key, *values in _ATTR.findall(attrs):
        key, value = key.lower(), next((v for v in values if v), "")
        if key in ("class", "id"):
            words = {w.lower() for w in _WORD.findall(value)}
            drop |= bool(words & _NAMES)
            header |= "header" in words
        elif key == "role":
            drop |= value.lower() in _ROLES
            marked = max(marked, {"article": 3, "main": 2}.get(value.lower(), 0))
        elif key == "itemprop":
            marked = max(marked, 3 if value == "articleBody" else 0)
        elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            drop = True
        elif key == "style":
            drop |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
    return drop, header, marked


def page_blocks(html: str) -> list[Block]:
    """The blocks of a page that have text, in order."""
    blocks: list[Block] = []
    buffer: list[str] = []
    # open elements: name, dropped, marked
    stack: list[tuple[str, bool, int]] = []

    def flush() -> None:
        text = " ".join("".join(buffer).split())
        if text:
            _, dropped, marked = stack[-1] if stack else ("", False, 0)
            blocks.append(Block(text, dropped, marked))
        buffer.clear()

    def close(names: set[str], until: set[str]) -> None:
        """Close up to the innermost open element of the names, unless one of ``until`` is in between."""
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in names:
                if any(s[0] in _BLOCKS or s[1] for s in stack[k:]):
                    flush()
                del stack[k:]
                return
            if stack[k][0] in until:
                return

    at = 0
    for token in _TOKEN.finditer(html):
        if token.start() > at:
            buffer.append(entities.unescape(html[at : token.start()]))
        at = token.end()
        tag = token["tag"]
        if not tag:
            continue
        tag = tag.lower()
        block = tag in _BLOCKS
        if token["end"]:
            close({tag}, set())
            continue
        if tag == "br":
            buffer.append(" ")
            continue
        if block:
            if tag in _CLOSES:
                close(_CLOSES[tag], {"ul", "ol", "dl", "table", "menu"})
            elif stack and stack[-1][0] != "p":
                close({"p"}, _BLOCKS - {"p"})
            elif stack:
                close({"p"}, set())
            flush()
        if tag in _VOID:
            continue
        _, dropped, marked = stack[-1] if stack else ("", False, 0)
        named, header, role = _named(token["attrs"]) if token["attrs"].strip() else (False, False, 0)
        marked = max(marked, role, {"article": 3, "main": 2}.get(tag, 0))
        if tag not in ("html", "body", "article", "main") or "comment" in token["attrs"].lower():
            if (named and tag not in ("html", "body")) or tag in _DROPPED or ((tag == "header" or header) and marked < 3):
                if not dropped and not block:
                    flush()
                dropped = True
        stack.append((tag, dropped, marked))
    if at < len(html):
        buffer.append(entities.unescape(html[at:]))
    flush()
    return blocks


def copy_groups(words: np.ndarray, page: np.ndarray, count: int) -> np.ndarray:
    """For each of ``count`` pages the number of the first page that it is a copy of, its own if none.

    ``page`` is the page of each word, in order.
    """
    first = np.searchsorted(page, np.arange(count + 1))
    groups = np.arange(count)
    held: dict[int, np.ndarray] = {}
    by_run: dict[int, list[int]] = {}
    by_words: dict[bytes, int] = {}
    for k in range(count):
        own = words[first[k] : first[k + 1]]
        groups[k] = by_words.setdefault(own.tobytes(), k)
        if groups[k] != k or len(own) < RUN_WORDS:
            continue
        runs = np.unique(run_hashes(own, RUN_WORDS))
        sketch = runs[:COPY_RUNS].tolist()
        for other in dict.fromkeys(j for run in sketch for j in by_run.get(run, ())):
            both = len(np.intersect1d(runs, held[other], assume_unique=True))
            if both >= COPY_SHARE * (len(runs) + len(held[other]) - both):
                groups[k] = by_words[own.tobytes()] = other
                break
        else:
            held[k] = runs
            for run in sketch:
                by_run.setdefault(run, []).append(k)
    return groups


def repeated_runs(
    words: np.ndarray, page: np.ndarray, length: int, group: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """For each place, how many pages share the run of ``length`` words that starts there.

    With ``group``, the group of each word's page, pages of one group count once.

    Suffixes are sorted by doubling up to ``length`` words; equal runs are then
    neighbours in the suffix array. Runs do not cross pages. Also returns the
    places in suffix order.
    """
    n = len(words)
    _, rank = np.unique(words, return_inverse=True)
    rank = rank.astype(np.int64) + 1
    # of the words of a page, how many follow
    last = np.flatnonzero(np.r_[page[1:] != page[:-1], True])
    left = np.repeat(last, np.diff(np.r_[-1, last])) - np.arange(n)
    have = 1
    while have < length:
        following = np.zeros(n, dtype=np.int64)
        inside = left >= have
        following[inside] = rank[np.flatnonzero(inside) + have]
        _, rank = np.unique(rank * (n + 2) + following, return_inverse=True)
        rank = rank.astype(np.int64) + 1
        have *= 2
    witness = page if group is None else group
    order = np.lexsort((witness, rank))
    sorted_rank, sorted_page = rank[order], witness[order]
    fresh = np.r_[True, sorted_rank[1:] != sorted_rank[:-1]]
    new_page = fresh | np.r_[True, sorted_page[1:] != sorted_page[:-1]]
    run = np.cumsum(fresh) - 1
    pages = np.bincount(run, weights=new_page).astype(np.int64)
    shared = np.empty(n, dtype=np.int64)
    shared[order] = pages[run]
    shared[left < length - 1] = 1
    return shared, order


def chosen_blocks(blocks: list[Block]) -> tuple[list[str], bool]:
    """The texts that a page's markup leaves, and whether the page marks them."""
    best = max((b.marked for b in blocks if not b.dropped), default=0)
    return [b.text for b in blocks if not b.dropped and b.marked >= best], best > 0


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts, and the text of each."""
    words, owner = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
    for first, data, offsets in slices(pa.array(texts or [""], pa.string())):
        starts, ends, at = word_bounds(data, offsets)
        words.append(word_hashes(data, starts, ends))
        owner.append(first + np.repeat(np.arange(len(offsets) - 1), np.diff(at)))
    return np.concatenate(words), np.concatenate(owner)


def stream_of(pages: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of pages, and the page of each."""
    page_of = np.repeat(np.arange(len(pages)), [len(texts) for texts in pages])
    words, block_of = words_of([t for texts in pages for t in texts])
    return words, page_of[block_of] if len(words) else block_of


def frequent_runs(pages: list[list[str]]) -> np.ndarray:
    """Hashes of the runs that may be boilerplate by the pages of one block."""
    words, page = stream_of(pages)
    if len(words) < RUN_WORDS:
        return np.zeros(0, dtype=np.uint64)
    shared, _ = repeated_runs(words, page, RUN_WORDS)
    whole = page[RUN_WORDS - 1 :] == page[: len(page) - RUN_WORDS + 1]
    often = shared[: len(whole)] >= min(LOOSE_SHARE, MARKED_SHARE) * len(pages)
    return np.unique(run_hashes(words, RUN_WORDS)[whole & often])


def own_text(texts: list[str], boilerplate: np.ndarray) -> str:
    """A page's text without the runs that are boilerplate, unless these are most of it."""
    words, block_of = words_of(texts)
    run = np.flatnonzero(np.isin(run_hashes(words, RUN_WORDS), boilerplate))
    if len(run):
        edge = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(edge, run, 1)
        np.add.at(edge, run + RUN_WORDS, -1)
        covered = np.cumsum(edge)[: len(words)] > 0
        if covered.mean() <= MOST_REPEATED:
            first_word = np.searchsorted(block_of, np.arange(len(texts) + 1))
            texts = [
                " ".join(w for w, gone in zip(text.split(" "), covered[a:b]) if not gone)
                for text, a, b in zip(texts, first_word, first_word[1:])
            ]
    return "\n".join(t for t in texts if t)


def page_counts(pages: list[list[str]], among: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs (of those ``among``), and the number of pages that have them."""
    found = [np.unique(run_hashes(words_of(texts)[0], RUN_WORDS)) for texts in pages]
    if among is not None:
        found = [runs[np.isin(runs, among)] for runs in found]
    return np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *found]), return_counts=True)


def main_texts(pages: list[list[Block]]) -> list[str]:
    """The main texts of pages, all of one host."""
    chosen = [chosen_blocks(blocks) for blocks in pages]
    groups = copy_groups(*stream_of([texts for texts, _ in chosen]), len(pages))
    witnesses = [chosen[k][0] for k in np.unique(groups).tolist()]
    runs, counts = page_counts(witnesses, frequent_runs(witnesses))
    loose = runs[counts >= max(LOOSE_PAGES, LOOSE_SHARE * len(witnesses))]
    strict = runs[counts >= max(MARKED_PAGES, MARKED_SHARE * len(witnesses))]
    return [own_text(texts, strict if marked else loose) for texts, marked in chosen]


def host_of(url: Column) -> Column:
    """The host of a url, in lower case; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text`` for every page; ``text`` is empty where there is none.

    Null html is an empty page; pages without a host are compared with each
    other. Rows that repeat an id are pages of their own. A block's white space
    becomes single spaces, character references are decoded, blocks are joined
    by line ends. Empty in, empty out; other columns are not looked at.
    """
    work = Workspace(pages.sparkSession, "htmltext")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        clean_text(html_col).alias("html"),
        host_of(F.col(url_col)).alias("host"),
    )
    # a host of many pages has several blocks, which its pages are dealt to by hash
    large = work.save(
        rows.groupBy("host").agg(F.ceil(F.count("*") / BLOCK_PAGES).alias("blocks")).where("blocks > 1"), "large"
    )
    block = F.pmod(F.xxhash64("page_id", "url"), F.coalesce("blocks", F.lit(1)))
    # what markup leaves is less than what it was, so that is moved
    chosen = rows.join(large, "host", "left").select("page_id", "url", "html", "host", block.alias("block")).mapInArrow(
        _chosen, _PAGE_DDL
    )
    dealt = chosen.repartition("host", "block").sortWithinPartitions("host", "block", "page_id", "url")
    parsed = work.save(
        dealt.mapInArrow(_witnesses, f"{_PAGE_DDL}, content long, witness boolean").withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "parsed",
    )
    # equal pages of different blocks are one witness too
    witnesses = parsed.where("witness")
    copies = work.save(
        witnesses.groupBy("host", "content").agg(F.min("row").alias("first"), F.count("*").alias("rows")).where("rows > 1"),
        "copies",
    )
    witnesses = (
        witnesses.select("row", "host", "block", "texts", "content")
        .join(copies.select("host", "content", "first"), ["host", "content"], "left")
        .where("first is null or row = first")
        .select("host", "block", "texts")
    )
    hosts = work.save(witnesses.groupBy("host").agg(F.count("*").alias("pages")).where(F.col("pages") >= LOOSE_PAGES), "hosts")
    of_blocks = witnesses.mapInArrow(_candidates, "host string, run long")
    candidates = work.save(
        of_blocks.join(hosts, "host", "left_semi").distinct().groupBy("host").agg(F.collect_list("run").alias("runs")), "candidates"
    )
    counted = work.save(
        witnesses.join(candidates, "host").mapInArrow(_counts, "host string, run long, pages long")
        .groupBy("host", "run").agg(F.sum("pages").alias("shared")),
        "counted",
    )
    enough = lambda least, share: F.col("shared") >= F.greatest(F.lit(float(least)), F.lit(share) * F.col("pages"))
    boilerplate = work.save(
        counted.join(hosts, "host")
        .where(enough(LOOSE_PAGES, LOOSE_SHARE))
        .groupBy("host")
        .agg(
            F.collect_list("run").alias("loose"),
            F.collect_list(F.when(enough(MARKED_PAGES, MARKED_SHARE), F.col("run"))).alias("strict"),
        ),
        "boilerplate",
    )
    runs = F.when(F.col("marked"), F.col("strict")).otherwise(F.col("loose")).alias("runs")
    return (
        parsed.join(boilerplate, "host", "left")
        .select("page_id", "url", "texts", runs)
        .mapInArrow(_texts, "page_id long, url string, text string")
    )


_PAGE_DDL = "page_id long, url string, host string, block long, texts binary, marked boolean"


def _packed(texts: list[str]) -> bytes:
    """The texts of a page's blocks, none of which has a line end, in few bytes."""
    return zstandard.ZstdCompressor(level=3).compress("\n".join(texts).encode("utf-8", "surrogatepass"))


def _unpacked(packed: bytes) -> list[str]:
    text = zstandard.ZstdDecompressor().decompress(packed).decode("utf-8", "surrogatepass")
    return text.split("\n") if text else []


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What markup leaves of pages."""
    for batch in batches:
        chosen = [chosen_blocks(page_blocks(html.as_py())) for html in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"),
                batch.column("url"),
                batch.column("host"),
                batch.column("block"),
                pa.array([_packed(texts) for texts, _ in chosen], pa.binary()),
                pa.array([marked for _, marked in chosen], pa.bool_()),
            ],
            names=["page_id", "url", "host", "block", "texts", "marked"],
        )


def _witnesses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which of a block's pages, or of a part of it if they are long, are no copies of others."""
    held: list[pa.RecordBatch] = []
    last, size = None, 0

    def settle() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        pages = [_unpacked(p) for p in rows.column("texts").to_pylist()]
        stream, page = stream_of(pages)
        first = np.searchsorted(page, np.arange(len(pages) + 1))
        content = [hashlib.blake2b(stream[a:b].tobytes(), digest_size=8).digest() for a, b in zip(first, first[1:])]
        return pa.RecordBatch.from_arrays(
            [
                *rows.columns,
                pa.array([int.from_bytes(c, "little", signed=True) for c in content], pa.int64()),
                pa.array(copy_groups(stream, page, len(pages)) == np.arange(len(pages))),
            ],
            names=[*rows.schema.names, "content", "witness"],
        )

    for batch in batches:
        places = zip(batch.column("host").to_pylist(), batch.column("block").to_pylist())
        for k, (place, packed) in enumerate(zip(places, batch.column("texts"))):
            if held and (place != last or size >= 6 * BLOCK_WORDS):
                yield settle()
                held, size = [], 0
            held.append(batch.slice(k, 1))
            last, size = place, size + zstandard.frame_content_size(packed.as_py())
    if held:
        yield settle()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[list[str]], np.ndarray | None]]:
    """Neighbouring pages of a host's block, with the runs that come with the first of them."""
    host, last, held, runs, size = None, None, [], None, 0
    for batch in batches:
        given = batch.column("runs") if "runs" in batch.schema.names else None
        hosts, pages = batch.column("host").to_pylist(), map(_unpacked, batch.column("texts").to_pylist())
        for k, (own, block, texts) in enumerate(zip(hosts, batch.column("block").to_pylist(), pages)):
            if held and ((own, block) != last or size >= 6 * BLOCK_WORDS):
                yield host, held, runs
                held, size = [], 0
            if not held and given is not None and (own != host or runs is None):
                runs = _numbers(given, k)
            host, last = own, (own, block)
            held.append(texts)
            size += sum(map(len, texts))
    if held:
        yield host, held, runs


def _numbers(column: pa.Array, k: int) -> np.ndarray:
    return np.asarray(column[k].values.to_numpy(zero_copy_only=False), dtype=np.int64).view(np.uint64)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for host, pages, _ in _blocks(batches):
        runs = frequent_runs(pages).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([host] * len(runs), pa.string()), pa.array(runs)], names=["host", "run"])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for host, pages, among in _blocks(batches):
        runs, counts = page_counts(pages, among)
        yield pa.RecordBatch.from_arrays(
            [pa.array([host] * len(runs), pa.string()), pa.array(runs.view(np.int64)), pa.array(counts.astype(np.int64))],
            names=["host", "run", "pages"],
        )


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    none = np.zeros(0, dtype=np.uint64)
    for batch in batches:
        pages, runs = map(_unpacked, batch.column("texts").to_pylist()), batch.column("runs")
        texts = [
            own_text(p, _numbers(runs, k) if runs[k].is_valid else none) for k, p in enumerate(pages)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
        )
