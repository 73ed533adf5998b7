"""Main text of web pages by site style trees.

Pages of a host are merged into one tree of element paths. A path has two importances, each an entropy from 0 (the same on
every page) to 1 (different on every page): of presentation, the layouts its elements have below them, and of content, the
texts they hold. They are counted by grouping path and value, so no host's pages ever meet in one task. Each page gets
back what its paths are worth; its branches are weighed from the leaves up and low ones removed, inside a declared article
as outside. A branch is worth as much as the most important element in it, however deep that lies.

Elements that declare what they are have a prior: menus, headers, footers, sidebars, notices, adverts, forms and comments
are worth 0. Of a declared article and a declared main (or a box named content) the one with more text is the article, and
all outside it is worth 0; articles inside a main that has more text of its own are teasers. A form that holds the article,
or most of the page, is no form in this sense. Names count as wholes; inside an article ids are anchors and say nothing,
and a paragraph that is called an alert or a notice is one of the article's.

All passes over a page are linear in its elements, however deep these lie.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A path says nothing before so many different pages of a host have it.
LEAST_PAGES = 8
#: Branches below this are removed.
THRESHOLD = 0.3
#: The largest share of a declared article that statistics may take for template.
LARGEST_SHARE = 1 / 3

#: Elements of the HTML standard by how they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select summary table "
    "tbody td tfoot th thead tr ul".split()
)
ENDS_PARAGRAPH = BLOCKS - frozenset("body caption dd dt head html legend li option tbody td tfoot th thead tr".split())
#: Elements that end an open one of the same group, up to the container.
GROUPS = {
    **dict.fromkeys(("li",), (frozenset(("li",)), frozenset(("ul", "ol", "menu", "dir")))),
    **dict.fromkeys(("dt", "dd"), (frozenset(("dt", "dd")), frozenset(("dl",)))),
    **dict.fromkeys(("td", "th"), (frozenset(("td", "th")), frozenset(("tr", "table")))),
    **dict.fromkeys(("tr",), (frozenset(("tr",)), frozenset(("table",)))),
    **dict.fromkeys(("tbody", "thead", "tfoot"), (frozenset(("tbody", "thead", "tfoot")), frozenset(("table",)))),
    **dict.fromkeys(("option",), (frozenset(("option",)), frozenset(("select",)))),
}
#: Elements and words of class, id and role that declare what is no part of an article.
NOISE_TAGS = RAW | frozenset("head nav footer aside form button select input menu dialog search object svg canvas audio video".split())
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "notices menu nav navbar navigation breadcrumb breadcrumbs sidebar aside widget footer masthead comment comments disqus respond "
    "replies share sharing social related recommended subscribe newsletter popup modal login signup search pagination "
    "contentinfo complementary form alert dialog toolbar skip".split()
)
#: Inside an article a header is a heading of it and stays.
HEADER_WORDS = frozenset(("header",))
#: Inside an article these are names of its own paragraphs.
CALLOUT_WORDS = frozenset("alert notice notices".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr blockquote pre figure figcaption".split())
#: Ids and classes of boxes that hold the article where nothing declares it better.
CONTENT_NAMES = frozenset(
    "content main-content maincontent page-content article-content article-body post-content post-body entry-content story-body".split()
)
#: Words that only say where or what kind of box something is: a name like site-footer or comment-list is noise as its other words are.
BOX_WORDS = frozenset(
    "area bar block body bottom box btn button buttons center col column container content desktop div fixed form global group header "
    "icon icons inner item items left link links list main mobile outer page panel posts primary right row secondary section site "
    "slot sticky text top unit wrap wrapper x zone".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>?|<[!?/][^>]*+>?",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_TOLD = frozenset(("class", "id", "role", "itemprop", "hidden"))
_WORD = re.compile(r"[a-z]+|\d+")


@dataclass
class Node:
    tag: str
    parent: int
    words: tuple[str, ...] = ()
    role: str = ""  # "noise", "article", "main", "content" or nothing
    named_noise: bool = False  # words of class, id and role say noise, the tag does not
    layout: list[str] = field(default_factory=list)  # tags of the children


@dataclass
class Page:
    nodes: list[Node]  # a parent comes before its children
    texts: list[str]  # of blocks, in page order
    owner: list[int]  # node of each text


def _names_noise(token: str, noise: frozenset[str]) -> bool:
    """Whether a token of class, id or role as a whole names noise; has-sidebar and ad-free do not."""
    words = [w for w in _WORD.findall(token) if not w.isdigit()]
    told = [w for w in words if w in noise or w not in BOX_WORDS]
    return bool(told) and noise.issuperset(told)


def _role(tag: str, attributes: str, in_article: bool, in_main: bool) -> tuple[tuple[str, ...], str, bool]:
    """Words of class, id and role, the role that an element declares, and whether these words name noise."""
    words: list[str] = []
    tokens: list[str] = []
    role, declares = "", {"main": "main", "article": "article"}.get(tag, "")
    for name, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        name = name.lower()
        if name not in _TOLD:
            continue
        value = next(filter(None, values), "").lower()
        if name == "hidden":
            role = "noise" if value in ("", "hidden") else role
        elif name == "itemprop":
            declares = declares or ("article" if value == "articlebody" else "")
        else:
            words += _WORD.findall(value)
            if name == "role" and value in ("main", "article"):
                declares = value
            if name != "role" and not declares and CONTENT_NAMES.intersection(value.split()):
                declares = "content"
            if name != "id" or not in_article:
                tokens += value.split()
    inside = in_article or in_main
    noise = NOISE_WORDS if inside else NOISE_WORDS | HEADER_WORDS
    if in_article and tag in PROSE:
        noise = noise - CALLOUT_WORDS
    named = tag not in ("html", "body") and any(_names_noise(t, noise) for t in tokens)
    if tag in NOISE_TAGS or tag == "header" and not inside:
        role = "noise"
    return tuple(w for w in dict.fromkeys(words) if not w.isdigit()), role or declares, named


class Open:
    """The open elements, with the depths at which each tag, each block and each fence of inline ends lies."""

    def __init__(self):
        self.nodes, self.tags = [0], ["#"]
        self.depths: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.fences: list[int] = []
        self.noisy: list[int] = []  # inline elements that are or may be noise, whose text must not run into what follows
        self.roles = {"article": 0, "main": 0}
        self.held: list[str] = [""]

    def owner(self) -> int:
        """The node that text belongs to: the innermost block, or an inline element that is noise within it."""
        return self.nodes[max(self.blocks[-1] if self.blocks else 0, self.noisy[-1] if self.noisy else 0)]

    def push(self, node: int, tag: str, role: str, noisy: bool) -> None:
        depth = len(self.nodes)
        if noisy:
            self.noisy.append(depth)
        self.nodes.append(node)
        self.tags.append(tag)
        self.held.append(role)
        self.depths.setdefault(tag, []).append(depth)
        if tag in BLOCKS:
            self.blocks.append(depth)
        if tag in FENCES:
            self.fences.append(depth)
        if role in self.roles:
            self.roles[role] += 1

    def close(self, depth: int) -> None:
        while len(self.nodes) > depth:
            self.nodes.pop()
            tag, role = self.tags.pop(), self.held.pop()
            self.depths[tag].pop()
            if tag in BLOCKS:
                self.blocks.pop()
            if tag in FENCES:
                self.fences.pop()
            if self.noisy and self.noisy[-1] == len(self.nodes):
                self.noisy.pop()
            if role in self.roles:
                self.roles[role] -= 1

    def deepest(self, tags) -> int:
        """The depth of the nearest open element of these tags, or 0."""
        return max((own[-1] for t in tags if (own := self.depths.get(t))), default=0)


FENCES = frozenset(("td", "th", "table", "article", "main"))


def parse(html: str) -> Page:
    """Elements and block texts of a page, in page order; what is not closed is closed as browsers do."""
    nodes, texts, owner = [Node("#", -1)], [], []
    stack, parts, at = Open(), [], 0

    def flush() -> None:
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            parts.clear()
            if text:
                texts.append(text)
                owner.append(stack.owner())

    while True:
        match = _TOKEN.search(html, at)
        if match is None:
            parts.append(html[at:])
            break
        if match.start() > at:
            parts.append(html[at : match.start()])
        at = match.end()
        tag = match[2]
        if not tag:
            continue
        tag = tag.lower()
        if match[1]:
            depth = stack.deepest((tag,))
            if tag in BLOCKS or stack.noisy and 0 < depth <= stack.noisy[-1]:
                flush()
            if depth and (tag in BLOCKS or not stack.fences or stack.fences[-1] <= depth):
                stack.close(depth)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        block = tag in BLOCKS
        if block:
            flush()
        if tag in ENDS_PARAGRAPH:
            if stack.blocks and stack.tags[stack.blocks[-1]] == "p":
                stack.close(stack.blocks[-1])
        elif tag in GROUPS:
            same, outer = GROUPS[tag]
            depth = stack.deepest(same)
            if depth > stack.deepest(outer):
                stack.close(depth)
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        words, role, named = _role(tag, match[3], stack.roles["article"] > 0, stack.roles["main"] > 0)
        noisy = (role == "noise" or named) and not block
        if noisy:
            flush()
        parent = stack.nodes[-1]
        nodes[parent].layout.append(tag)
        nodes.append(Node(tag, parent, words, role, named))
        stack.push(len(nodes) - 1, tag, role, noisy)
    flush()
    return Page(nodes, texts, owner)


def paths(page: Page, site: int = 0) -> list[int]:
    """A 64-bit name of each node's path on its site: tags and words of class and id from the root down, without places."""
    named = [site] * len(page.nodes)
    for i, node in enumerate(page.nodes):
        if i:
            named[i] = xxhash.xxh64_intdigest(f"{named[node.parent]}/{node.tag}.{'.'.join(sorted(node.words))}") - (1 << 63)
    return named


def below(page: Page, marked: list[bool]) -> list[bool]:
    """Which nodes have a marked one below them."""
    has = [False] * len(marked)
    for i in range(len(marked) - 1, 0, -1):
        if marked[i] or has[i]:
            has[page.nodes[i].parent] = True
    return has


def inherited(page: Page, marked: list[bool]) -> list[bool]:
    """Which nodes are marked or lie in a marked one."""
    own = list(marked)
    for i in range(1, len(own)):
        own[i] = own[i] or own[page.nodes[i].parent]
    return own


def noise_of(page: Page) -> list[bool]:
    """Elements that are noise themselves: by their tag, or by words that no declared article outranks.

    A main outranks the words of its own and of all around it. So does an article where else none would stand; one that
    is itself named noise, as comments are, only where no main stands either.
    """
    nodes, n = page.nodes, len(page.nodes)
    hard = [node.role == "noise" for node in nodes]
    if any(hard[i] and nodes[i].tag == "form" for i in range(n)):
        hard = _without_page_forms(page, hard)
    named, in_hard = [node.named_noise for node in nodes], inherited(page, hard)
    mains = [nodes[i].role == "main" and not in_hard[i] for i in range(n)]
    articles = [nodes[i].role == "article" and not in_hard[i] for i in range(n)]

    def outrank(chosen: list[bool]) -> None:
        for i, holds in enumerate(below(page, chosen)):
            if holds or chosen[i]:
                named[i] = False

    outrank(mains)
    in_named = inherited(page, named)
    if not any(articles[i] and not in_named[i] for i in range(n)):
        proper = [articles[i] and not named[i] for i in range(n)]
        outrank(proper if any(proper) or any(mains) else articles)
    return [h or x for h, x in zip(hard, named)]


def _without_page_forms(page: Page, hard: list[bool]) -> list[bool]:
    """A form around a declared article, or around most of the text that is in no other noise, is part of the page."""
    nodes, n = page.nodes, len(page.nodes)
    other = inherited(page, [h and node.tag != "form" for h, node in zip(hard, nodes)])
    size = [0] * n
    for text, i in zip(page.texts, page.owner):
        size[i] += 0 if other[i] else len(text)
    total = sum(size)
    for i in range(n - 1, 0, -1):
        size[nodes[i].parent] += size[i]
    holds = below(page, [node.role in ("article", "main") and not other[i] for i, node in enumerate(nodes)])
    return [h and not (node.tag == "form" and (holds[i] or 2 * size[i] > total > 0)) for i, (h, node) in enumerate(zip(hard, nodes))]


def article_of(page: Page, noise: list[bool]) -> tuple[list[bool], list[bool]] | None:
    """The elements that are the article, and those in it that are teasers of others; None where nothing declares one."""
    nodes, n = page.nodes, len(page.nodes)
    lost = inherited(page, noise)
    articles = [nodes[i].role == "article" and not lost[i] for i in range(n)]
    boxes = [nodes[i].role in ("main", "content") and not lost[i] for i in range(n)]
    if any(nodes[i].role == "main" for i in range(n) if boxes[i]):
        boxes = [boxes[i] and nodes[i].role == "main" for i in range(n)]
    elif not any(articles):
        return None
    in_article = inherited(page, articles)
    whole, own = [0] * n, [0] * n
    for text, i in zip(page.texts, page.owner):
        if not lost[i]:
            whole[i] += len(text)
            own[i] += 0 if in_article[i] else len(text)
    for i in range(n - 1, 0, -1):
        whole[nodes[i].parent] += whole[i]
        own[nodes[i].parent] += own[i]
    best_article = max((whole[i] for i in range(n) if articles[i]), default=-1)
    best_box = max((own[i] for i in range(n) if boxes[i]), default=-1)
    if best_article >= best_box:
        return articles, [False] * n
    chosen = [boxes[i] and (nodes[i].role == "main" or own[i] == best_box) for i in range(n)]
    return chosen, articles


def declared(page: Page) -> tuple[list[float | None], list[bool] | None]:
    """What declarations fix: 0 for noise, teasers and all outside a declared article, None where statistics decide; and which
    elements lie in the article, if one is declared."""
    noise = noise_of(page)
    found = article_of(page, noise)
    if found is None:
        return [0.0 if x else None for x in inherited(page, noise)], None
    chosen, teasers = found
    inside, around = inherited(page, chosen), below(page, chosen)
    gone = inherited(page, [x or t for x, t in zip(noise, teasers)])
    return [0.0 if gone[i] or not (inside[i] or around[i]) else None for i in range(len(page.nodes))], inside


def main_text(page: Page, importance: dict[int, float], site: int = 0) -> str:
    """The page's blocks without branches of low importance; importance: of paths that statistics speak of.

    In a declared article statistics only remove boxes, and not more than LARGEST_SHARE of the text; where nothing is
    declared they must leave some. Beyond that, what pages have in common are copies of a text and no template.
    """
    nodes, (fixed, article) = page.nodes, declared(page)
    found, inside = article is not None, article or [True] * len(nodes)
    named = paths(page, site) if importance else [0] * len(nodes)
    # Inline elements hold no text of their own and are worth what blocks there are in them.
    worth = [importance.get(named[i], 1.0) if fixed[i] is None and nodes[i].tag in BLOCKS else 0.0 for i in range(len(nodes))]
    for i in range(len(nodes) - 1, 0, -1):
        worth[nodes[i].parent] = max(worth[nodes[i].parent], worth[i])
    low = [n.tag in BLOCKS and fixed[i] is None and worth[i] < THRESHOLD for i, n in enumerate(nodes)]
    if found:
        low = [x and inside[nodes[i].parent] and nodes[i].tag not in PROSE for i, x in enumerate(low)]
    low = inherited(page, low)
    blocks = [(t, o) for t, o in zip(page.texts, page.owner) if fixed[o] is None and inside[o]]
    total, removed = sum(len(t) for t, _ in blocks), sum(len(t) for t, o in blocks if low[o])
    if removed > total * (LARGEST_SHARE if found else 1) or removed == total:
        return "\n".join(t for t, _ in blocks)
    return "\n".join(t for t, o in blocks if not low[o])


LAYOUT, CONTENT = False, True


def features(page: Page, site: int = 0) -> list[tuple[int, bool, int, bool]]:
    """(path, is content, value, is the path's first of its kind) of the blocks that no declaration fixes, each value once.

    A block that holds text shows that, others the layout below them.
    """
    named, fixed = paths(page, site), declared(page)[0]
    texts: dict[int, list[str]] = {}
    for text, node in zip(page.texts, page.owner):
        texts.setdefault(node, []).append(text)
    found: dict[tuple[int, bool, int], bool] = {}
    met: set[tuple[int, bool]] = set()
    for i, node in enumerate(page.nodes):
        if fixed[i] is None and node.tag in BLOCKS:
            kind, value = (CONTENT, "\n".join(texts[i])) if i in texts else (LAYOUT, ">".join(node.layout))
            found.setdefault((named[i], kind, xxhash.xxh64_intdigest(value) - (1 << 63)), (named[i], kind) not in met)
            met.add((named[i], kind))
    return [(*value, first) for value, first in found.items()]


def host_of(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def extract(df: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per page: `page_id`, `url`, `text` and `n_chars` (code points).

    Null and empty pages give an empty text. Pages without a host in their url are one site. Equal rows stay separate
    rows with equal texts. Hosts with fewer than LEAST_PAGES different pages have no statistics, so only declarations
    count. Pages of a host with the same html are one page there, and what a page repeats at a path counts once.
    Columns beyond the three are not returned.
    """
    source = F.coalesce(df[f"`{html}`"], F.lit(""))
    pages = df.select(df[f"`{id}`"].alias("page_id"), df[f"`{url}`"].alias("url"), source.alias("html"))
    pages = pages.withColumn("site", F.xxhash64(host_of(F.col("url")))).withColumn("html_key", F.xxhash64("site", "html"))

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for site, key, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                rows += [(key, *feature) for feature in features(parse(source.as_py()), site)]
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=SEEN.names)

    # Both uses of `different` read one shuffle: neither filters or drops what the other needs, nothing is null, and a count
    # that is used keeps the second grouping from taking the place of the first.
    different = pages.select("site", "html_key", "html").mapInArrow(collect, SEEN).distinct()
    known = different.groupBy("html_key", "path").agg(F.count("*").alias("n")).filter("n > 0").join(low_paths(different).select("path"), "path")
    weights = known.groupBy("html_key").agg(F.collect_list("path").alias("low"))
    joined = pages.join(weights, "html_key", "left").select("page_id", "url", "site", "html", "low")
    out = T.StructType([pages.schema["page_id"], pages.schema["url"], T.StructField("text", T.StringType(), False)])

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(2).to_pylist(), batch.column(3), batch.column(4))
            texts = [main_text(parse(source.as_py()), dict.fromkeys(low.as_py() or (), 0.0), site) for site, source, low in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=out.names)

    return joined.mapInArrow(prune, out).withColumn("n_chars", F.length("text").cast("long"))


#: What a page shows of the paths of its site; paths are named with their site, so no other column tells sites apart.
SEEN = T.StructType(
    [
        T.StructField("html_key", T.LongType(), False),
        T.StructField("path", T.LongType(), False),
        T.StructField("content", T.BooleanType(), False),
        T.StructField("value", T.LongType(), False),
        T.StructField("first", T.BooleanType(), False),
    ]
)


def importances(different: DataFrame) -> DataFrame:
    """(path, presentation, content): of blocks without text and of those with, where LEAST_PAGES different pages have them.

    Either is null where no page has such a block, and 1 where fewer pages have.
    """
    values = different.groupBy("path", "content", "value").agg(F.count("*").alias("n"), F.count_if("first").alias("pages"))
    # Entropy to the base of the number of values: 1 - sum(n ln n) / (N ln N).
    total = F.sum("n")
    entropy = 1 - F.try_divide(F.sum(F.col("n") * F.ln("n")), total * F.ln(total))
    kinds = values.groupBy("path", "content").agg(F.sum("pages").alias("pages"), entropy.alias("worth"))
    worth = F.when(F.col("pages") < LEAST_PAGES, 1.0).otherwise(F.coalesce("worth", F.lit(1.0)))
    return kinds.groupBy("path").agg(
        F.max(F.when(~F.col("content"), worth)).alias("presentation"), F.max(F.when(F.col("content"), worth)).alias("content")
    )


def low_paths(different: DataFrame) -> DataFrame:
    """Paths below THRESHOLD in presentation and in content, as far as they have them."""
    nothing = F.lit(0.0)
    return importances(different).filter(F.greatest(F.coalesce("presentation", nothing), F.coalesce("content", nothing)) < THRESHOLD)
