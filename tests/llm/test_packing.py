import zlib

import numpy as np
import pytest

from docenrich.llm import packing
from docenrich.llm.queries import tokenizer_file
from docenrich.llm.tokens import Encoder

TEXTS = ["Hello, World! don't I'LL 12a", "", None, "ß × ÷ ŉ İ Σ ΑΣ é é", "a\x1cb  c　d", "x<|endoftext|>y aaaaaaa",
         "word " * 5000, "long" * 3000, "same text", "same text"]


@pytest.fixture(scope="module")
def definition():
    with open(tokenizer_file(), encoding="utf-8") as file:
        return file.read()


def test_cached_words_give_the_tokenizer_s_ids(definition):
    texts = [t or "" for t in TEXTS]
    assert Encoder(definition, True).encode(texts) == Encoder(definition, False).encode(texts)


def test_best_fit_decreasing_is_the_plain_one():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 65, 500)
    mine = [sum(int(lengths[i]) for i in w) for w in packing.best_fit_decreasing(lengths, 64)]
    plain = []
    for n in sorted(lengths.tolist(), reverse=True):
        room = [(64 - s, k) for k, s in enumerate(plain) if 64 - s >= n]
        if room:
            plain[min(room)[1]] += n
        else:
            plain.append(n)
    assert sorted(mine) == sorted(plain)


@pytest.mark.parametrize("round_tokens", [300, 4_000_000])
def test_every_id_lies_in_one_piece(spark, definition, round_tokens):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS * 6)] + [(None, "no id", "x"), (0, "an id again", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, length string").coalesce(2)
    pieces = packing.pack(df, tokenizer_file(), round_tokens=round_tokens).toPandas()
    encoder = Encoder(definition, False)
    for i, text, _ in rows[: len(TEXTS) * 6]:
        own = pieces[(pieces.doc_id == i) & (pieces.doc_id != 0)].sort_values("start")
        if i == 0:
            continue
        ids = np.frombuffer(encoder.encode([text or ""])[0], "<u4").tolist() + [1]
        assert [x for p in own.ids for x in p] == ids
        assert own.start.tolist() == np.r_[0, np.cumsum(own.length)[:-1]].tolist()
        assert set(own.doc_tokens) == {len(ids)}
    for p in pieces.itertuples():
        assert p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes()) and p.length == len(p.ids) > 0
    for _, s in pieces.sort_values("offset").groupby("sequence_id"):
        assert s.offset.tolist() == np.r_[0, np.cumsum(s.length)[:-1]].tolist()
        total = int(s.length.sum())
        assert total <= 2048 and (2048 - total <= packing.SLACK or total & (total - 1) == 0)


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), tokenizer_file()).collect() == []
