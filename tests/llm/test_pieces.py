"""Merge-type pieces against the sentencepiece library."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from odd_tables import EDGES, SAMPLE, edges, frame, nothing, workers  # noqa: F401
from pyspark.sql import functions as F

from duebook.llm import pieces
from duebook.llm.common import utf8
from duebook.llm.queries import QUERIES

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def theirs():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def same(theirs, texts):
    import pyarrow as pa

    ids, bounds = pieces.encoder(MODEL).encode(*utf8(pa.array(texts, pa.string())))
    decoded = pieces.encoder(MODEL).decode(ids, bounds)
    for text, a, b, spelled in zip(texts, bounds, bounds[1:], decoded):
        want = theirs.encode(text, add_eos=True)
        assert ids[a:b].tolist() == want, text
        assert spelled.decode() == theirs.decode(want), text


def test_odd_texts(theirs):
    same(theirs, ["", " ", "  ", "     x", "\n\n", "\t", "▁a▁▁b ▁", "日本語テスト", "\x00\x01", "é é", "🙂🙂 x", "<s> </s> <0x0A> <unk>", " " * 99, "x" * 5000, "ab" * 3000])


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyz      ABCéüß.,-_\n\t0123456789▁日本一🙂ка", "aeinst ▁", "▁  a"])
def test_random_texts(theirs, letters):
    draw = random.Random(7)
    same(theirs, ["".join(draw.choice(letters) for _ in range(draw.randrange(70))) for _ in range(4000)])


def test_any_characters(theirs):
    draw = random.Random(8)
    points = [c for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    same(theirs, ["".join(chr(draw.choice(points)) for _ in range(20)) for _ in range(2000)])


def test_compatible_is_what_merging_both_gives():
    """The border test against merging two tokens from scratch."""
    model, draw = pieces.encoder(MODEL), random.Random(9)

    def merged(text):
        symbols = list(text)
        while True:
            best = max(((model.scores[a + b], -i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in model.scores), default=None)
            if best is None:
                return symbols
            symbols[-best[1] : 2 - best[1]] = [symbols[-best[1]] + symbols[1 - best[1]]]

    tokens = [t for t, (*_, whole) in model.alone.items() if whole]
    near = [(a, b) for a, b in ((draw.choice(tokens), draw.choice(tokens)) for _ in range(4000))]
    near += [(t[:i], t[i:]) for t in draw.sample(tokens, 3000) for i in range(1, len(t)) if t[:i] in model.ids and t[i:] in model.ids]
    apart = 0
    for a, b in near:
        if merged(a) == [a] and merged(b) == [b]:
            apart += merged(a + b) == [a, b]
            assert model.compatible(a, b) == (merged(a + b) == [a, b]), (a, b)
    assert 0 < apart < len(near)


def test_decoding_any_ids(theirs):
    import numpy as np

    draw = random.Random(10)
    for _ in range(2000):
        ids = [draw.randrange(32000) if draw.random() < 0.5 else draw.randrange(259) for _ in range(12)]
        assert pieces.encoder(MODEL).decode(np.array(ids), np.array([0, 12]))[0].decode() == theirs.decode(ids), ids


def test_stores_begin_anew(theirs, monkeypatch):
    monkeypatch.setattr(pieces, "STORE_WORDS", 5)
    monkeypatch.setattr(pieces, "STORE_PAIRS", 5)
    pieces.encoder(MODEL).forget()
    same(theirs, ["the quick brown fox jumps over the lazy dog " * 3, "pack my box with five dozen liquor jugs"])
    assert len(pieces.encoder(MODEL).store) <= 5 >= len(pieces.encoder(MODEL).apart)


def test_op12(spark, theirs):
    texts = dict(map(tuple, spark.read.parquet(f"{SAMPLE}/documents.parquet").select("doc_id", "text").collect()))
    rows = QUERIES["op12_sentencepiece"](spark, SAMPLE).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in rows:
        ids = theirs.encode(texts[r.doc_id] or "", add_eos=True)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), digest(" ".join(map(str, ids))), digest(theirs.decode(ids)))


def test_odd_tables(theirs, edges, nothing):
    rows = pieces.encode_texts(edges, MODEL, decode=True).collect()
    assert len(rows) == len(EDGES)
    for r, (id, text) in zip(rows, EDGES):
        assert r.doc_id == id and r.ids == theirs.encode(text or "", add_eos=True) and r.decoded == theirs.decode(r.ids)
    assert pieces.encode_texts(nothing, MODEL, decode=True).count() == 0
    ids = edges.select("doc_id", F.array(F.lit(450), F.lit(2)).alias("ids"), F.lit("x").alias("Decoded"))
    assert {r.decoded for r in pieces.decode_ids(ids, MODEL).collect()} == {theirs.decode([450, 2])}
    assert [r.decoded for r in pieces.decode_ids(ids.select("doc_id", F.lit(None).cast("array<int>").alias("ids")), MODEL).collect()] == [""] * len(EDGES)
