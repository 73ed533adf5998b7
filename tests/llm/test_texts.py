"""Operators on single texts against the libraries they follow or plain code, and on odd tables."""

import hashlib
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from odd_tables import EDGES, SAMPLE, edges, frame, nothing, workers  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from duebook.llm import bpe, language, licenses, quality
from duebook.llm.common import text_blocks
from duebook.llm.queries import QUERIES

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")
ODD = [
    "", " ", "  a  b\n\n c \n", "it's we'll I've he'd 'sun ''s 's's x'LL y'll'", "don't\n'twas  'ok", "12½ Ⅷ ١٢٣", "İSTANBUL ΣΑΣ",
    "é café", "a<|endoftext|>b<|startoftext|><|endoftext|>", "日本語テキスト" * 50, "aaaa" * 40, "!!!!!!!!!!", "\x1c\x1d\x00x y　",
    "👍🏽 ok'", "'", "x'", " 's", "\t'r", "\n're l", "x   ", "   x", "\r\n \r\n",
]


def encoded(file, texts):
    own, ids, texts_back = bpe.encoder(public_tokenizers.path(file)), [], []
    for data, offsets in text_blocks(pa.array(texts)):
        flat, bounds = own.encode(data, offsets)
        ids += [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
        texts_back += own.decode(flat, bounds)
    return ids, [t.decode() for t in texts_back]


@pytest.mark.parametrize("file", FILES)
def test_encoding_is_that_of_the_tokenizer(file):
    theirs = Tokenizer.from_file(public_tokenizers.path(file))
    ids, texts = encoded(file, ODD)
    for text, own, back in zip(ODD, ids, texts):
        want = theirs.encode(text, add_special_tokens=False).ids
        assert own == want, text
        assert back == theirs.decode(want, skip_special_tokens=False), text


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab 'st\nré1.!<|xİΣ中"), max_size=40), min_size=1, max_size=4))
def test_any_text_is_encoded_alike(texts):
    for file in FILES:
        theirs = Tokenizer.from_file(public_tokenizers.path(file))
        assert encoded(file, texts)[0] == [e.ids for e in theirs.encode_batch(texts, add_special_tokens=False)]


def test_encode_table(edges, nothing):
    path = public_tokenizers.path(FILES[1])
    done = bpe.encode_texts(edges, path, decode=True)
    rows = done.collect()
    assert len(rows) == len(EDGES) and done.columns == ["doc_id", "ids", "decoded"]
    assert sorted((r.doc_id or -1, r.decoded) for r in rows) == sorted((i or -1, t or "") for i, t in EDGES)
    assert {tuple(r) for r in bpe.decode_ids(done, path).collect()} == {(r.doc_id, r.decoded) for r in rows}
    assert bpe.encode_texts(nothing, path).count() == 0


def test_op1(spark):
    theirs = Tokenizer.from_file(public_tokenizers.path(FILES[0]))
    texts = dict(map(tuple, spark.read.parquet(f"{SAMPLE}/documents.parquet").select("doc_id", "text").collect()))
    for r in QUERIES["op1_bpe"](spark, SAMPLE).collect():
        ids = theirs.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(theirs.decode(ids, skip_special_tokens=False).encode()).hexdigest()


# ---- licences -----------------------------------------------------------------------------------------------------


def test_expressions():
    assert licenses.postfix("MIT OR Apache-2.0 AND BSD-3-Clause") == ["mit", "apache-2.0", "bsd-3-clause", "and", "or"]
    assert licenses.evaluate("MIT OR GPL-3.0-only").permissive
    assert not licenses.evaluate("MIT AND GPL-3.0-only").permissive
    assert licenses.evaluate("(MIT OR GPL-2.0+) AND Apache-2.0 WITH LLVM-exception").labels == {"mit", "gpl-2", "apache-2"}
    for wrong in ("", "MIT OR", "(MIT", "MIT)", "AND MIT", "MIT Apache-2.0"):
        with pytest.raises(ValueError):
            licenses.postfix(wrong)


def test_expressions_of_any_length():
    flat = " AND ".join(["MIT"] * 40 + ["GPL-3.0-only"] + [f"own-{i}" for i in range(1000)])
    nested = f"( {' OR '.join(f'own-{i}' for i in range(100))} )"
    assert licenses.tag_expression(flat) == flat and licenses.tag_expression(f"{nested} */") == nested
    text = f"SPDX-License-Identifier: {flat}"
    words = " ".join(re.findall("[a-z0-9]+", text.lower()))
    _, _, _, _, labels, _, permissive, _ = licenses.scan(text.encode(), f" {words} ")
    assert len(labels) == 1002 and "gpl-3" in labels and not permissive


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["(", ")", "or", "and", "with", "mit", "mit.", "x,", "and.", "or;", "*/", "b+"]), max_size=12))
def test_the_expression_is_the_longest_well_formed_prefix(tokens):
    want = None
    for n in range(len(tokens), 0, -1):
        text = " ".join(tokens[:n]).rstrip(",;.*/ ")
        try:
            licenses.postfix(text)
        except ValueError:
            continue
        want = text
        break
    assert licenses.tag_expression(" ".join(tokens)) == want


def test_licenses_of_texts(frame, edges, nothing):
    texts = {
        1: "Under the MIT license, under the mit-license; and Apache License, Version 2.0",
        2: "// SPDX-License-Identifier: MIT OR Apache-2.0 */ more",
        3: "underthe mit license",
        4: "SPDX-License-Identifier: (broken",
        5: "licensed under CC BY-NC 4.0",
    }
    rows = {r.doc_id: r for r in licenses.with_licenses(frame(list(texts.items()))).collect()}
    first = rows[1]
    assert (first.n_base, first.first_word, first.last_word, first.base_labels) == (3, 0, 9, ["apache-2", "mit"])
    assert rows[2].labels == ["apache-2", "mit"] and rows[2].n_base == 0 and rows[2].expressions == ["mit or apache-2.0"] and rows[2].permissive
    assert rows[3].labels == [] and rows[4].labels == []
    assert rows[5].base_labels == ["cc-by-nc"] and not rows[5].permissive and all(0 <= r.score <= 1 for r in rows.values())
    assert licenses.with_licenses(edges).count() == len(EDGES) and licenses.with_licenses(nothing).count() == 0


def test_op2(spark):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    texts = dict(map(tuple, spark.read.parquet(f"{SAMPLE}/documents.parquet").select("doc_id", "text").collect()))
    for r in QUERIES["op2_licenses"](spark, SAMPLE).collect():
        words = word.findall(texts[r.doc_id].translate(lower))
        found = [(i, label) for p, label in licenses.BASE_PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        places = [i for i, _ in found]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(words), len(found), min(places, default=None), max(places, default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in found})) and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))


# ---- language -----------------------------------------------------------------------------------------------------


def test_language_is_held_out_and_right(spark):
    rows = QUERIES["op8_language"](spark, "/root/testdata/sf0.01").collect()
    truth = dict(map(tuple, spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()))
    unseen = [r for r in rows if r.held_out]
    assert len(unseen) > 200 and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == truth[r.doc_id] for r in unseen) / len(unseen) > 0.98


def test_language_of_odd_texts(spark, frame, edges, nothing):
    taught = frame([(i, "the cat and the hat " * 5, "en") for i in range(9)] + [(i + 9, "der hund und die katze " * 5, "de") for i in range(9)], "doc_id long, text string, lang string")
    model = language.fit(taught)
    rows = language.with_language(edges.drop("lang"), model).collect()
    assert len(rows) == len(EDGES)
    assert {r.lang_pred for r in rows if not any(c.isalpha() for c in r.text or "")} == {"und"}
    assert {r.lang_pred for r in rows if r.text and any(c.isalpha() for c in r.text)} <= {"en", "de"}
    assert language.with_language(nothing, model).count() == 0
    empty = language.fit(taught.filter("false"))
    assert {r.lang_pred for r in language.with_language(edges, empty).collect()} == {"und"}


# ---- quality ------------------------------------------------------------------------------------------------------


def plain_repeats(words):
    seen, marked = {}, set()
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            marked |= {i + k for i in places for k in range(8)}
    return len(marked)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=40), min_size=1, max_size=5))
def test_repeated_words(texts):
    assert quality.repetitions(texts)[0].tolist() == [plain_repeats(t) for t in texts]


def test_quality_table(edges, nothing):
    rows = quality.with_ledger(edges).withColumn("kept", quality.kept()).collect()
    assert len(rows) == len(EDGES)
    by_text = {r.text: r for r in rows}
    assert by_text[None].failed == by_text[""].failed == 1 and not by_text[None].kept
    assert by_text[EDGES[0][1]].failed == 0 and by_text[EDGES[6][1]].failed & 2
    assert quality.with_ledger(nothing).count() == 0


def test_ablations_are_what_other_policies_keep(spark):
    ledger = quality.with_ledger(spark.read.parquet(f"{SAMPLE}/documents.parquet")).cache()
    for row in quality.ablations(ledger).collect():
        rest = quality.Policy("rest", tuple(r for r in quality.STANDARD.rules if r != row.rule))
        assert row.n_kept_without == ledger.filter(quality.kept(rest)).count()
        bit = next(1 << r.bit for r in quality.RULES if r.name == row.rule)
        assert row.n_failed == ledger.filter(F.col("failed").bitwiseAND(F.lit(bit)) != 0).count()
        assert row.n_only == ledger.filter(F.col("failed") == bit).count()


def test_quality_keeps_good_and_drops_bad(spark):
    folder = "/root/testdata/sf0.01"
    got = QUERIES["op9_quality"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    good, bad = [r for r in got if r.quality == 1 and not r.base_failed], [r for r in got if r.quality == 0]
    assert np.mean([r.kept for r in good]) == 1.0 and np.mean([r.kept for r in bad]) < 0.05


def test_words_behind_a_tag_are_known_identifiers():
    found = lambda line: licenses.scan(line.encode(), " spdx license identifier ")[4:8]
    tag = "SPDX-License-Identifier: "
    for line in ("see the LICENSE file", "NOASSERTION", "NONE", "Proprietary OR Internal"):
        assert found(tag + line) == ([], [], None, 0.0)
    assert found(tag + "MIT AND Proprietary") == (["mit"], ["mit and proprietary"], False, 1.0)
    assert found(tag + "Proprietary OR MIT") == (["mit"], ["proprietary or mit"], True, 1.0)
    assert found(tag + "LicenseRef-Acme-1 WITH Classpath-exception-2.0") == (["licenseref-acme-1"], ["licenseref-acme-1 with classpath-exception-2.0"], False, 1.0)
    assert found(tag + "GPL-2.0-only WITH Classpath-exception-2.0")[0] == ["gpl-2"]


def test_texts_full_of_phrases_take_linear_time():
    import time

    words = " " + "under the mit license cc by nc " * 40_000
    began = time.perf_counter()
    n, first, last, *_ = licenses.scan(words.encode(), words)
    assert (n, first, last) == (80_000, 0, 7 * 39_999 + 4) and time.perf_counter() - began < 5


def test_op5_goes_by_its_stored_map(spark, tmp_path, monkeypatch):
    from duebook.llm import queries, sharding

    monkeypatch.setattr(queries, "shared_folder", lambda spark: str(tmp_path))
    rows = QUERIES["op5_sharding"](spark, SAMPLE).collect()
    (maps,) = tmp_path.glob("shard-maps-*")
    first, second = (sharding.load_map(spark, str(maps), v) for v in (1, 2))
    assert {r.version for r in rows} == {2} and all(second.shard_of[r.virtual_slot] == r.shard for r in rows)
    assert max(second.shard_bytes()) - min(second.shard_bytes()) <= max(first.shard_bytes()) - min(first.shard_bytes())


def test_every_character_is_cut_as_the_tokenizer_does():
    theirs = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    theirs.encode_special_tokens = True
    mine = bpe.encoder(public_tokenizers.path("word_bpe_49k.json"))
    points = [chr(c) for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}b1{c}2 {c}{c}!{c}" for c in points]
    for a in range(0, len(texts), 20_000):
        part = texts[a : a + 20_000]
        raw = [t.encode() for t in part]
        bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        ids, at = mine.encode(np.frombuffer(b"".join(raw), np.uint8), bounds)
        for text, want, x, y in zip(part, theirs.encode_batch(part, add_special_tokens=False), at, at[1:]):
            assert ids[x:y].tolist() == want.ids, hex(ord(text[1]))


def test_a_score_is_sure_from_a_share_of_the_usual_one_on(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("lang is not null")
    model = language.fit(documents.filter(~language.held_out(F.col("doc_id"))))
    clean = documents.filter(language.held_out(F.col("doc_id"))).filter("size(split(text, ' ')) >= 20")
    sure = clean.select(language.sure(language.predicted(clean["text"], model, clean), model).alias("sure"))
    assert sure.filter("not sure").count() == 0 and sure.count() > 100
    draw = np.random.default_rng(1)
    odd = ["".join(draw.choice(list("abcdefghijklmnopqrstuvwxyz     "), 600)) for _ in range(20)] + ["Привет мир и все остальное " * 20, "12 34", ""]
    table = spark.createDataFrame([(t,) for t in odd], "text string")
    assert table.filter(language.sure(language.predicted(table["text"], model, table), model)).count() == 0


def test_more_languages_than_are_learned(spark, monkeypatch):
    monkeypatch.setattr(language, "MOST_LANGUAGES", 3)
    monkeypatch.setattr(language, "MOST_TEXTS", 12)
    monkeypatch.setattr(language, "MOST_LANDMARKS", 6)
    rows = [(i, f"text {chr(97 + i % 7) * 5} number {i}", f"l{min(i % 7, 4)}" if i % 7 else None) for i in range(140)] + [(999, "rare", "l9")]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(model.languages) == 3 and "l4" in model.languages and "l9" not in model.languages
    assert model.landmarks.shape[1] <= 6 and len(model.usual) == 3
