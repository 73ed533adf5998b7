"""Operators over whole tables against brute force, and on odd tables."""

import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from odd_tables import EDGES, SAMPLE, edges, frame, nothing, workers  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from duebook.llm import html, neighbours, packing, sharding, simhash, warc
from duebook.llm.queries import QUERIES

# ---- near duplicates ----------------------------------------------------------------------------------------------


def linked(n, pairs):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return [root(x) for x in range(n)]


def plain_fingerprint(text, k):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_op3(spark):
    texts = spark.read.parquet(f"{SAMPLE}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in QUERIES["op3_simhash"](spark, SAMPLE).collect()}
    ids, fps = [t.doc_id for t in texts], [plain_fingerprint(t.text, 3) for t in texts]
    pairs = [(a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 3]
    roots = linked(len(fps), pairs)
    least = {}
    for i, r in enumerate(roots):
        least[r] = min(least.get(r, ids[i]), ids[i])
    for i, doc in enumerate(ids):
        assert got[doc].fingerprint == f"{fps[i]:016x}" and got[doc].component_id == least[roots[i]]


@pytest.mark.parametrize("bucket", [8, 1])
def test_no_link_is_lost_in_large_buckets(spark, monkeypatch, bucket):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 12, dtype=np.uint64)
    fps = {int(b) for b in base}
    for b in base:
        for _ in range(80):
            x = b
            for bit in rng.choice(64, rng.integers(1, 7), replace=False):
                x ^= np.uint64(1) << np.uint64(bit)
            fps.add(int(x))
    fps = np.array(sorted(fps), np.uint64)
    # So that all three levels are used, the last one for every link there is with 1.
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    roots = {r.node: r.root for r in simhash.components(simhash.close_links(df)).collect()}
    mine = [roots.get(int(x), int(x)) for x in fps.view(np.int64)]
    close = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3
    want = linked(len(fps), [(a, b) for a, b in zip(*np.nonzero(close)) if a < b])
    assert len(set(zip(mine, want))) == len(set(mine)) == len(set(want))


def test_duplicates_of_odd_tables(edges, nothing):
    rows = simhash.near_duplicates(edges).collect()
    assert len(rows) == len(EDGES)
    assert {r.component_id for r in rows if r.fp == 0} == {2}
    kept = simhash.one_of_each(edges).collect()
    assert sorted((r.doc_id or -1, r.text) for r in kept if r.text and len(r.text) < 999) == [(-1, EDGES[5][1]), (1, EDGES[0][1]), (7, "!"), (7, "é ß")]
    assert len(kept) == 6 and kept[0].labels == "x"
    assert simhash.one_of_each(nothing).count() == 0


def test_last_level_buckets_hold_512_at_most():
    last = len(simhash.CHOICES) ** simhash.LEVELS
    assert max(64 - simhash.key_mask(code, simhash.LEVELS).bit_count() for code in range(0, last, 7)) <= 9


def test_saturated_bucket(spark):
    """All settings of the nine bits that a key of the last level leaves free: more than BUCKET of them share each of its keys."""
    code = next(c for c in range(len(simhash.CHOICES) ** 3) if 64 - simhash.key_mask(c, 3).bit_count() == 9)
    free = [b for b in range(64) if not simhash.key_mask(code, 3) >> b & 1]
    fps = [sum((n >> i & 1) << b for i, b in enumerate(free)) for n in range(512)]
    df = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)),) for x in fps], "fp long")
    links = simhash.close_links(df).collect()
    assert len(set(linked(512, [(fps.index(r.a % 2**64), fps.index(r.b % 2**64)) for r in links]))) == 1


# ---- packing ------------------------------------------------------------------------------------------------------


def check_packed(rows, capacity, least):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r.length for r in rows)
    assert len(by) <= least * -(-total // capacity) + 1


def test_op4(spark):
    rows = QUERIES["op4_packing"](spark, SAMPLE).collect()
    check_packed(rows, 2048, 1.05)
    theirs = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = dict(map(tuple, spark.read.parquet(f"{SAMPLE}/documents.parquet").select("doc_id", "text").collect()))
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == set(texts)
    for doc, own in pieces.items():
        ids = np.array([*theirs.encode(texts[doc], add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for n, r in enumerate(sorted(own, key=lambda r: r.piece)):
            assert (r.piece, r.start) == (n, at) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length])
            assert n == 0 or r.length == 2048
            at += r.length
        assert at == len(ids)


def test_packing_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(packing, "NODE_ITEMS", 40)
    items = spark.range(3000, numPartitions=20).select("id", (1 + F.pmod(F.xxhash64("id"), F.lit(100))).alias("length"), F.lit(1).alias("Offset"))
    rows = packing.pack(items, capacity=100).collect()
    assert sorted(r.id for r in rows) == list(range(3000))
    check_packed(rows, 100, 1.05)


def test_packing_of_odd_tables(edges, nothing):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = packing.pack(packing.token_pieces(edges, path, with_ids=True)).collect()
    check_packed(rows, 2048, 1.1)
    assert sum(r.length == 1 for r in rows) == 2 and all(len(r.ids) == r.length for r in rows)
    assert packing.pack(packing.token_pieces(nothing, path)).count() == 0
    with pytest.raises(Exception, match="lengths must be"):
        packing.pack(edges.select(F.lit(0).alias("length"))).collect()


def test_best_fit_is_at_least_as_good_as_first_fit():
    rng = np.random.default_rng(0)
    for _ in range(20):
        sizes = rng.integers(1, 101, 200)
        bins = packing.best_fit(sizes, 100)
        fill = np.bincount(bins, sizes)
        assert fill.max() <= 100 and len(fill) <= 11 / 9 * -(-sizes.sum() // 100) + 30


# ---- shards -------------------------------------------------------------------------------------------------------


def test_op5(spark):
    texts = dict(map(tuple, spark.read.parquet(f"{SAMPLE}/documents.parquet").select("doc_id", "text").collect()))
    rows, shards = QUERIES["op5_sharding"](spark, SAMPLE).collect(), {}
    assert len(rows) == len(texts)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert r.size == len(data) + 16 and r.text_crc32 == zlib.crc32(data) and r.law == "bytes"
        shards.setdefault(r.shard, []).append(r)
    total = [sum(r["size"] for r in own) for own in shards.values()]
    assert set(shards) == set(range(40)) and max(total) <= 1.25 * sum(total) / 40 + max(r["size"] for r in rows)
    for own in shards.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))


def test_shards_of_odd_tables_and_edits(spark, edges, nothing, tmp_path):
    sized = sharding.with_size(edges, slots=64)
    one = sharding.new_map(sharding.slot_loads(sized, 64), 3)
    placed = sharding.placed(sized, one)
    assert placed.count() == len(EDGES) and dict(placed.dtypes)["shard"] == "int"
    assert {r["size"] for r in placed.filter("doc_id in (2, 3)").collect()} == {16}
    two = sharding.rebalanced(one, shards=4)
    moved = [s for s in range(64) if one.shard_of[s] != two.shard_of[s]]
    assert two.version == 2 and all(two.shard_of[s] == 3 or one.loads.bytes[s] for s in moved)
    fewer = sharding.rebalanced(two, shards=2)
    assert set(fewer.shard_of) <= {0, 1} and sum(fewer.shard_bytes()) == sum(one.shard_bytes())
    for version in (one, two):
        sharding.save_map(spark, version, str(tmp_path / "maps"))
    assert sharding.load_map(spark, str(tmp_path / "maps")) == two and sharding.load_map(spark, str(tmp_path / "maps"), 1) == one
    assert sharding.placed(sharding.with_size(nothing), sharding.new_map(sharding.slot_loads(sharding.with_size(nothing)), 3)).count() == 0


# ---- neighbours ---------------------------------------------------------------------------------------------------


def test_op6_recall(spark):
    folder = "/root/testdata/sf0.01"
    data = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, vectors = np.array([r.vec_id for r in data]), np.array([r.embedding for r in data], np.float64)
    found = {}
    for r in QUERIES["op6_neighbours"](spark, folder).collect():
        found.setdefault(r.query_id, []).append(r)
    hits = []
    for q in ids[ids % 20 == 0]:
        scores = (vectors * vectors[ids == q][0]).sum(axis=1)
        scores[ids == q] = -np.inf
        best = ids[np.lexsort((ids, -scores))[:20]]
        own = sorted(found[q], key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, 21))
        assert all(abs(r.score - scores[ids == r.vec_id][0]) < 1e-12 for r in own)
        hits.append(len({*best.tolist()} & {r.vec_id for r in own}) / 20)
    assert np.mean(hits) >= 0.95


def test_neighbours_of_odd_vectors(frame):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [None, 1.0]), (7, []), (8, [0.5, 2.0]),
            (None, [9.0, 9.0]), (20, [0.0, 1.0]), (21, [1.0, 2.0, 3.0]), (2, [1.0, 0.0]), (9, [-3.0, 0.1])]
    got = neighbours.nearest(frame(rows, "vec_id long, embedding array<float>", "rank score label"), lambda i: i % 20 == 0, k=3).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == [(0, 1, 1), (0, 2, 2), (0, 3, 8), (20, 1, 8), (20, 2, 9), (20, 3, 0)]
    none = frame([], "vec_id long, embedding array<float>", "rank")
    assert neighbours.nearest(none, lambda i: i % 20 == 0).count() == 0


def test_repeated_ids_leave_room_for_different_ones(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.9, 0.1]), (0, [0.0, 1.0]), (2, [1.0, 0.1]), (2, [0.99, 0.1]), (2, [0.98, 0.1])]
    rows += [(i, [0.5 + i / 100, 0.5]) for i in (1, 3, 4, 5)]
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), lambda i: i == 0, k=4).collect()
    best = {}
    for q, a in rows:
        for i, b in rows:
            if q == 0 and i != 0:
                best[i] = max(best.get(i, -9), a[0] * b[0] + a[1] * b[1])
    want = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:4]
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [(i, pytest.approx(s)) for i, s in want]


def test_ids_of_many_vectors_and_vectors_of_many_ids(spark):
    draw = np.random.default_rng(4)
    base = draw.standard_normal((60, 6))
    rows = [(int(draw.integers(0, 40)), base[draw.integers(0, 60)].tolist()) for _ in range(500)]
    got = {}
    for r in neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), lambda i: i % 20 == 0, k=12, ratio=1e-9).collect():
        got.setdefault(r.query_id, []).append(r)
    for q in (0, 20):
        best = {}
        for own in (np.array(v) for i, v in rows if i == q):
            for i, v in rows:
                if i != q:
                    best[i] = max(best.get(i, -99.0), float((np.array(v) * own).sum()))
        want = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:12]
        assert [(r.vec_id, r.score) for r in sorted(got[q], key=lambda r: r["rank"])] == [(i, pytest.approx(s, abs=1e-12)) for i, s in want]


def test_the_search_stops_where_vectors_stand_out():
    draw = np.random.default_rng(5)
    centres = draw.standard_normal((300, 64))
    vectors = (centres[:, None, :] + 0.15 * draw.standard_normal((300, 30, 64))).reshape(-1, 64)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    ids, at = np.arange(len(vectors)), np.arange(len(vectors) + 1)
    tree = neighbours.ProjectedTree.build(vectors)
    asking = ids[::30]
    bound = neighbours.chi_square_bound(neighbours.PROJECTED, neighbours.CONFIDENCE) / neighbours.RATIO**2
    found = tree.search(vectors[asking], asking, ids, at, 20, bound)
    assert found.verified.mean() < 0.3 * len(vectors)
    scores = vectors[asking] @ vectors.T
    scores[np.arange(len(asking)), asking] = -np.inf
    want = np.argsort(-scores, axis=1)[:, :20]
    assert np.mean([len({*a} & {*b}) / 20 for a, b in zip(found.ids, want)]) >= 0.95


def test_chi_square_bound():
    rng = np.random.default_rng(0)
    draws = (rng.standard_normal((200_000, 8)) ** 2).sum(axis=1)
    assert abs(np.mean(draws <= neighbours.chi_square_bound(8, 0.9)) - 0.9) < 0.005


# ---- pages --------------------------------------------------------------------------------------------------------

PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><ul><li>a<li>b</ul></nav>
<div class="cookie-notice">We use</div><main><article><header><h1>Head &amp; line</h1></header><p>One <b>bold</b>
 word&nbsp;here<br>and on<p>Two<aside>side</aside><form><p>form</p></form><script>var x="</p>";</script>
<ul><li>x<li>y</ul></article><section id="comments"><p>bad</p></section></main><footer>F</footer></body></html>"""


def test_main_text():
    assert html.main_text(html.parse(PAGE), {}) == "Head & line\nOne bold word here and on\nTwo\nx\ny"
    for odd in ("", "plain", "<", "<p", "<p class='x", "</p></p>", "<!-- open", "<script>never closed", "a<b>c"):
        html.main_text(html.parse(odd), {})
    assert html.main_text(html.parse("a<b>c"), {}) == "ac"


def test_statistics_remove_what_a_host_repeats(spark):
    rows = [
        (i, f"http://H.example/{i}", f"<body><div class=top><p>same words</p></div><div class=text><p>story {i} " + "x" * i + "</p></div></body>")
        for i in range(12)
    ]
    rows += [(99, "http://other.example/", "<body><div class=top><p>same words</p></div></body>"), (100, None, None), (101, "x", ""), (101, "x", "")]
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x")).withColumn("site", F.lit(1)))
    by_id = {r.page_id: r for r in got.collect()}
    assert got.count() == len(rows)
    assert [by_id[i].text for i in range(12)] == [f"story {i} " + "x" * i if i else "story 0" for i in range(12)]
    assert by_id[99].text == "same words" and by_id[100].text == "" and by_id[101].n_chars == 0
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize(
    "page",
    [
        "<div class='layout has-sidebar'><article>Text</article><div class='sidebar'>no</div></div>",
        "<main class='no-sidebar'>Text<div class='comment-list'>no</div></main>",
        "<article class='post comment-open'>Text</article>",
        "<div id='page' class='ad-free'><p>Text</p><div id='site-footer'>no</div></div>",
        "<div class='widget'><article>Text<p class='share'>no</p></article></div><div class='related'>no</div>",
        "<div class='related'><main class='banner'>Text</main></div>",
        "<article>Text</article><div class='comments'><article class='comment'>no</article></div>",
        "<main>Text<div id='comments'><article class='comment-body'>no</article></div></main>",
        "<div class='fixed-layout-header'><p>Text</p></div><div class='cookie-banner'>no</div>",
    ],
)
def test_names_are_noise_as_wholes_and_below_articles(page):
    assert html.main_text(html.parse(f"<html><body>{page}</body></html>"), {}) == "Text"


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<main><h1>Real title</h1><p>Long real text.</p><section class=more><article>Teaser</article></section></main>", "Real title\nLong real text."),
        ("<div id=content><h1>Real title</h1><p>Long real text.</p></div><article>Teaser</article>", "Real title\nLong real text."),
        ("<main><article><p>The whole story.</p></article><p>More</p></main>", "The whole story."),
        ("<form id=aspnetForm><article>Real</article></form>", "Real"),
        ("<form id=aspnetForm><div><p>All of the page's text</p></div><input name=q></form>", "All of the page's text"),
        ("<p>Text of a page</p><form><label>Name</label><button>Go</button></form>", "Text of a page"),
        ('<article><p data-class="nav">a</p><p id="sharing">b</p><p class="alert">c</p><section id="related">d</section><h2 id="comments">e</h2></article>', "a\nb\nc\nd\ne"),
        ("<article>Text<div class='share'>no</div><p class='ad'>no</p><div class='notice'>no</div></article>", "Text"),
        ("<article itemprop=articleBody>Text</article><div aria-hidden=true>no</div>", "Text"),
    ],
)
def test_articles_are_found_whole(page, want):
    assert html.main_text(html.parse(f"<html><body>{page}</body></html>"), {}) == want


def test_deep_pages_take_linear_time():
    import time

    n = 50_000
    pages = ["<div>" * n + "<article>x</article>" + "</div>" * n, "<div class='a b'>" * n + "<p>x</p>", "<b><td>" + "<div>" * n + "</b>" * n + "<option>" * n + "x"]
    for page in pages:
        began = time.perf_counter()
        parsed = html.parse(page)
        html.features(parsed)
        assert html.main_text(parsed, {}) == "x"
        assert time.perf_counter() - began < 20


def extracted(spark, rows):
    return {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_statistics_decide_where_nothing_is_declared(spark):
    """Boxes without telling names: one repeats its text, one its layout only, one differs in both."""
    page = "<html><body><div class=alpha><p>Read our other pages</p></div><div class=beta><p>Story {0} of its own</p></div><div class=gamma><b>Part</b><p>{1}</p></div></body></html>"
    rows = [(i, f"http://plain.org/{i}", page.format(i, "word " * (i + 1))) for i in range(20)]
    got = extracted(spark, rows)
    assert all(got[i] == f"Story {i} of its own\nPart\n" + " ".join(["word"] * (i + 1)) or got[i] == f"Story {i} of its own\n" + " ".join(["word"] * (i + 1)) for i in range(20))
    assert all("Read our" not in t for t in got.values())


def test_statistics_reach_into_articles_but_not_into_copies(spark):
    page = "<html><body><article><h1>{0}</h1><p>{1}</p><div class=q7><p>Follow this paper on every page</p></div></article></body></html>"
    rows = [(i, f"http://paper.org/{i}", page.format(f"Head {i}", f"Body {i} " * 20)) for i in range(12)]
    # A host of near copies of one article: what these share is no template.
    copy = "<html><body><article><h1>Same head</h1><p>Same first part of all copies.</p><p>{0}</p></article></body></html>"
    rows += [(100 + i, f"http://copies.org/{i}", copy.format("last" if i % 9 else f"other {i}")) for i in range(40)]
    bare = "<html><body><p>Same text of all</p><!-- {0} --></body></html>"
    rows += [(200 + i, f"http://bare.org/{i}", bare.format(i)) for i in range(20)]
    got = extracted(spark, rows)
    assert all(got[i] == f"Head {i}\n" + " ".join([f"Body {i}"] * 20) for i in range(12))
    assert all(got[100 + i].startswith("Same head\nSame first part of all copies.\n") for i in range(40))
    assert all(got[200 + i] == "Same text of all" for i in range(20))


def test_importance_of_presentation_and_content(spark):
    page = "<html><body><div class=alpha>{0}</div><div class=beta>same</div><ul>{1}</ul></body></html>"
    rows = [(n, *f) for n in range(12) for f in html.features(html.parse(page.format(f"text {n}", "<li>x</li>" * n)))]
    got = html.importances(spark.createDataFrame(rows, html.SEEN)).collect()
    # html and body, alpha, beta, ul by its number of items, li.
    rounded = lambda x: None if x is None else round(x, 3)
    pairs = sorted(str((rounded(r.presentation), rounded(r.content))) for r in got)
    assert pairs == sorted(map(str, [(0.0, None), (0.0, None), (None, 1.0), (None, 0.0), (1.0, None), (None, 0.0)]))


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<article><p>Text <button>Share</button> goes on</p></article>", "Text\ngoes on"),
        ("<article><p>Text <span class=ad>buy <b>now</b></span>goes on</p></article>", "Text\ngoes on"),
        ("<article><p><b>Bold<p>Next</article>", "Bold\nNext"),
        ("<p>One <a href=x>two</a> <i>three</i></p>", "One two three"),
    ],
)
def test_inline_elements(page, want):
    assert html.main_text(html.parse(f"<html><body>{page}</body></html>"), {}) == want


@pytest.mark.parametrize("tag", ["article", "p"])
def test_depth_does_not_wear_off(spark, tag):
    rows = [(i, f"http://deep.org/{i}", f"<html><body>{'<div>' * 20}<{tag}>Text {i}</{tag}>{'</div>' * 20}<p>Same</p></body></html>") for i in range(10)]
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {i: f"Text {i}" for i in range(10)}


def test_statistics_count_different_pages(spark):
    page = "<html><body><h1>Head {0}</h1><p>Text {0}</p></body></html>"
    rows = [(i, f"http://copies.org/{i}", page.format(i % 4)) for i in range(104)]
    rows += [(200 + i, "http://one.org/", page.format("x")) for i in range(8)]
    cells = "".join(f"<td>{'0' if i < 18 else i}</td>" for i in range(20))
    rows += [(300, "http://table.org/", f"<html><body><table><tr>{cells}</tr></table></body></html>")]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(got) == len(rows)
    assert all(got[i] == f"Head {i % 4}\nText {i % 4}" for i in range(104))
    assert all(got[200 + i] == "Head x\nText x" for i in range(8))
    assert got[300].split("\n") == ["0"] * 18 + ["18", "19"]


def test_op7_is_the_article(spark):
    import re
    from html import unescape

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SAMPLE}/pages.parquet").collect()}
    for r in QUERIES["op7_html"](spark, SAMPLE).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        parts = [" ".join(unescape(re.sub(r"</?b>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)


# ---- archives -----------------------------------------------------------------------------------------------------


def test_canonical_urls(spark):
    same = ["http://www.Example.com:80/a//b/?b=2&a=1&utm_source=x#f", "https://example.com/a/b?a=1&b=2", "https://u:p@EXAMPLE.com:443/a/b/?a=1&b=2&ref=q"]
    other = ["https://example.com:8080/a/b?a=1&b=2", "https://example.com/", None, "no url", ""]
    rows = [r.c for r in spark.createDataFrame([(u,) for u in same + other], "u string").select(warc.canonical_url(F.col("u")).alias("c")).collect()]
    assert rows == ["example.com/a/b?a=1&b=2"] * 3 + ["example.com:8080/a/b?a=1&b=2", "example.com/", None, None, None]


def test_revisits(frame):
    u = "http://a.example/x"
    rows = [
        (1, u, 100, False, {"ETag": '"v1"', "Content-Length": "9", "X": "old"}),
        (2, u, 5000, False, {"ETag": '"v2"', "Last-Modified": "d2"}),
        (3, u + "#f", 5000, True, {"etag": 'W/"v1"', "content-length": "0", "x": "new"}),  # not later than 2, so it is 1
        (4, u, 9_000_000, True, {"ETag": '"v2"'}),
        (5, u, 9_000_001, True, {"ETag": '"v3"'}),
        (6, u, 9_000_002, True, {"Last-Modified": "d2"}),
        (7, u, 9_000_003, True, None),
        (8, u, 50, True, {"ETag": '"v1"'}),
        (9, None, 50, True, {}),
        (10, u, None, True, {}),
        (4, u, 9_000_000, True, {"ETag": '"v2"'}),
        (None, u, 4000, None, {"ETag": '"v9"'}),
        (12, u, 4500, True, {"ETag": '"v9"'}),
    ]
    schema = "record_id long, url string, captured long, is_revisit boolean, headers map<string,string>"
    got = warc.resolve(frame(rows, schema, "canonical_url resolved_id outcome span near far of last")).collect()
    by_id = {r.record_id: r for r in got}
    assert len(got) == 10
    assert {i: (r.resolved_id, r.outcome) for i, r in by_id.items()} == {
        3: (None, "validators differ"), 4: (2, "matched"), 5: (None, "validators differ"), 6: (2, "matched"), 7: (2, "unchecked"),
        8: (None, "no response"), 9: (None, "no url"), 10: (None, "no time"), 12: (None, "matched"),
    }
    assert by_id[4].headers == {"etag": '"v2"', "last-modified": "d2"} and by_id[7].headers["etag"] == '"v2"'
    first = warc.resolve(frame(rows[:1] + [(3, u, 200, True, {"etag": 'W/"v1"', "content-length": "0", "x": "new"})], schema, "")).first()
    assert first.resolved_id == 1 and first.headers == {"etag": 'W/"v1"', "content-length": "9", "x": "new"}
    assert warc.resolve(frame([], schema, "")).count() == 0


# ---- pipeline -----------------------------------------------------------------------------------------------------


def test_stages_on_odd_tables(spark, edges, nothing):
    for docs in (edges, nothing):
        docs = docs.withColumn("lang", F.lit("en"))
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SAMPLE)
            assert out.columns == docs.columns
            out.collect()
        corpus_pipeline.STAGES[-1][1](spark, docs, SAMPLE).collect()


def test_pipeline(spark):
    documents = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    docs = {r.doc_id: r.text for r in documents.collect()}
    verdicts = {r.doc_id: r.kept for r in QUERIES["op9_quality"](spark, SAMPLE).collect()}
    passed = documents.filter(F.col("doc_id").isin([d for d, ok in verdicts.items() if ok]))
    ids = sorted(r.doc_id for r in dict(corpus_pipeline.STAGES)["language ID"](spark, passed, SAMPLE).collect())
    fps = [plain_fingerprint(docs[d], 3) for d in ids]
    groups = linked(len(ids), [(a, b) for a in range(len(ids)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 3])
    want = {ids[r] for r in groups}  # the first of each group
    rows = corpus_pipeline.run(spark, SAMPLE).collect()
    check_packed(rows, 2048, 1.05)
    assert {r.doc_id for r in rows} == want
    theirs = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert sum(r.length for r in rows) == sum(len(theirs.encode(docs[d], add_special_tokens=False).ids) + 1 for d in want)
