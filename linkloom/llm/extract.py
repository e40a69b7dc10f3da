"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree. A node is a path of block elements with their
classes; it keeps the sequences of children it was seen with (its layouts) and, for the text blocks
right in it, what they said (their contents). The importance of a node's layouts or contents is their
entropy over the logarithm of the pages they were seen on: high if they differ from page to page, low
if they are the same few everywhere. It is carried up from the leaves: what a text block gives an
element above it is (1 - CARRIED) of that element's layouts and CARRIED of what it gives the one
below; an element's composite importance is the mean over the blocks in it. Hosts with few pages lean
on the tree of all hosts, and nodes seen on few pages on the elements that hold them.

Whether a branch goes is a matter of odds: those of its composite importance, trusted the more the
more pages show it, times prior odds from what elements and classes are for. Neither is a verdict.
What stays of a page is its main text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.common import column
from linkloom.llm.url_rules import host_and_path
from linkloom.operators.materialize import materialize
from linkloom.operators.skew import lookup_join

# Share of an element's importance that comes from within it.
CARRIED = 0.9
# Weight, in pages, of the tree of all hosts beside the host's own.
GLOBAL_SEEN = 20.0
# A node's own importance counts half where it was seen on so many pages, the elements above it the rest.
TRUSTED_SEEN = 40.0
# Importances are taken to lie between this and one minus it.
LEAST = 0.018
# Elements below this depth are one node with the element that holds them.
DEPTH = 32

# Prior log-odds of being main text: of anything, within an article, within elements for something else
# (menus, forms), within those whose class tells so, and what is added to the last beside an article.
PLAIN, WITHIN, NAMED, CLASSED, BESIDE = 0.7, 1.5, -3.0, -1.5, -2.0

# Elements without text for readers.
UNSEEN = frozenset("script style noscript template head title iframe object svg math canvas audio video select textarea button".split())
# Elements that are not the main text, unless they are within one that holds it.
ASIDE = frozenset("nav header footer aside form menu dialog".split())
MAIN = frozenset("article main".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that a new one of the same kind, or of a kind in the list, ends.
ENDS_BEFORE = {
    "p": BLOCKS - {"caption", "tbody", "td", "tfoot", "th", "thead", "tr", "body", "html"},
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "tbody", "thead", "tfoot"}),
    "td": frozenset({"td", "th", "tr", "tbody", "thead", "tfoot"}),
    "th": frozenset({"td", "th", "tr", "tbody", "thead", "tfoot"}),
}
# Words in a class or role that tell what a part of a page is for.
_PURPOSE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|banner|sponsor\w*|promo\w*|cookie\w*|consent|notice|newsletter|subscribe|popup|modal|"
    r"nav\w*|menu|breadcrumb\w*|sidebar|footer|header|masthead|share|social|related|search|login|"
    r"complementary|contentinfo|banner|navigation)(?=$|[\s_-])",
    re.I,
)
_REMARKS = re.compile(r"(?:^|[\s_-])(?:comments?|respond|replies)(?=$|[\s_-])", re.I)
# A quoted value that never ends is none; so every character is read once, whatever is left open.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)|<[!?][^>]*+(?:>|\Z)", re.S
)
_MARK = re.compile(r"\b(class|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_DIGITS = re.compile(r"\d+")
# Elements that such words say nothing about: they tell of a whole page, or are headings.
_UNMARKED = frozenset("html body main article h1 h2 h3 h4 h5 h6".split())
# Elements whose content is not markup.
_RAW = frozenset("script style textarea title noscript iframe".split())


ROOT = 1
LAYOUT, CONTENT, PLACE = 0, 1, 2


@dataclass(slots=True)
class Element:
    """An open element. `nodes` is the way from the root to its node, `layout` what it holds so far."""

    name: str
    nodes: tuple[int, ...]
    hidden: bool
    prior: float
    main: bool
    marked: bool
    layout: int = 0


@dataclass(slots=True)
class Block:
    """A run of text between block boundaries: where it stands and what it says.

    `prior` are the log-odds of being main text by what its elements are for."""

    nodes: tuple[int, ...]
    prior: float
    main: bool
    marked: bool
    parts: list[str] = field(default_factory=list)
    text: str = ""

    @property
    def aside(self) -> bool:
        return self.prior < 0

    @property
    def leaf(self) -> int:
        """The tree node of its contents. Blocks of one element with unlike priors are not the same."""
        return _below(self.nodes[-1], f"#{self.prior}")


def _number(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


@lru_cache(1 << 16)
def _below(node: int, step: str) -> int:
    return _number(f"{node} {step}")


@lru_cache(1 << 12)
def _marks(attributes: str) -> tuple[str, bool, bool, bool]:
    """(classes without numbers, whether the role is main, marked by purpose, marked as remarks)."""
    marks = {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in _MARK.finditer(attributes)}
    classes = ".".join(sorted(_DIGITS.sub("0", marks.get("class", "")).split()))
    main = marks.get("role", "").lower() in ("main", "article")
    return classes, main, any(_PURPOSE.search(v) for v in marks.values()), any(_REMARKS.search(v) for v in marks.values())


def read(page: str | None) -> tuple[list[Block], list[tuple[int, int]]]:
    """The text blocks of a page in order, empty ones left out, and (node, layout) of its elements.

    Open elements need no end tag, stray end tags are ignored, `<br>` is white space. The time is
    linear in the page, also where tags, quotes or elements are never closed.
    """
    page = page or ""
    root = Element("", (ROOT,), False, PLAIN, False, False)
    stack, holders, names = [root], [root], Counter()
    out: list[Block] = []
    layouts: list[tuple[int, int]] = []
    current: Block | None = None
    hidden = 0

    def push(name: str, attributes: str) -> None:
        nonlocal hidden
        above = stack[-1]
        classes, role, purpose, remarks = _marks(attributes) if attributes else ("", False, False, False)
        main = above.main or name in MAIN or role
        prior, marked, nodes = above.prior, above.marked, above.nodes
        if main and not above.main and prior >= 0:
            prior = WITHIN
        if name in BLOCKS:
            unmarked = name in _UNMARKED
            # A header inside an article is a part of it, a footer may be.
            if name in ASIDE and not (main and name == "header"):
                prior = min(prior, CLASSED if main and name == "footer" else NAMED)
            if remarks and not unmarked:
                prior = min(prior, NAMED)
            if purpose and not unmarked:
                prior, marked = min(prior, CLASSED), marked or not main
            if not hidden:
                step = f"{name}.{classes}"
                holder = holders[-1]
                holder.layout = hash((holder.layout, _below(0, step)))
                if len(nodes) < DEPTH:
                    nodes = (*nodes, _below(nodes[-1], step))
        stack.append(Element(name, nodes, name in UNSEEN, prior, main, marked))
        names[name] += 1
        if name in BLOCKS:
            holders.append(stack[-1])
        hidden += name in UNSEEN

    def pop() -> str:
        nonlocal hidden
        last = stack.pop()
        names[last.name] -= 1
        hidden -= last.hidden
        if last.name in BLOCKS:
            holders.pop()
            if not hidden:
                layouts.append((last.nodes[-1], last.layout))
        return last.name

    def say(text: str) -> None:
        nonlocal current
        if hidden:
            return
        if current is None:
            if not text or text.isspace():
                return
            # Inline elements do not make a place of their own.
            holder = holders[-1]
            holder.layout = hash((holder.layout, 1))
            current = Block(holder.nodes, holder.prior, holder.main, holder.marked)
            out.append(current)
        current.parts.append(text)

    at = 0
    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            say(page[at:])
            break
        if m.start() > at:
            say(page[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if name in BLOCKS or name in UNSEEN:
            current = None
        if m[1]:
            if names[name]:
                while pop() != name:
                    pass
            continue
        if name == "br":
            say(" ")
        if name in VOID or m[3].endswith("/"):
            continue
        while name in ENDS_BEFORE.get(holders[-1].name, ()):
            ended = holders[-1].name
            while pop() != ended:
                pass
        push(name, m[3])
        if name in _RAW:
            end = re.compile(rf"</{name}\b", re.I).search(page, at)
            at = end.start() if end else len(page)
    while len(stack) > 1:
        pop()
    layouts.append((ROOT, root.layout))
    for b in out:
        b.text = " ".join(html.unescape("".join(b.parts)).split())
        b.parts = []
    out = [b for b in out if b.text]
    if any(b.main and not b.aside for b in out):
        # Classes tell more beside an article.
        for b in out:
            b.prior += BESIDE * (b.marked and not b.main)
    return out, layouts


def blocks(page: str | None) -> list[Block]:
    return read(page)[0]


def observations(pages: DataFrame) -> DataFrame:
    """(host, html) to (host, kind, id, feature, path, prior, n): on how many pages a node had a
    layout, or a leaf a content; and, of kind PLACE, the nodes from the root to each leaf.

    What a page shows several times counts once. Everything is counted in each task before it is
    shuffled, so that a host with a third of all pages costs no more than its distinct features.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[tuple[str, int]] = set()
        for batch in batches:
            hosts, kinds, ids, features, paths, priors = [], [], [], [], [], []
            for host, page in zip(column(batch, "host"), column(batch, "html")):
                found, layouts = read(page)
                rows = {(LAYOUT, node, layout) for node, layout in layouts}
                places = {}
                for b in found:
                    leaf = b.leaf
                    rows.add((CONTENT, leaf, _number(b.text)))
                    if (host, leaf) not in told:
                        told.add((host, leaf))
                        places[leaf] = b
                hosts += [host] * (len(rows) + len(places))
                for kind, node, feature in rows:
                    kinds.append(kind)
                    ids.append(node)
                    features.append(feature)
                paths += [None] * len(rows)
                priors += [None] * len(rows)
                for leaf, b in places.items():
                    kinds.append(PLACE)
                    ids.append(leaf)
                    features.append(0)
                    paths.append(b.nodes)
                    priors.append(b.prior)
            if len(told) > 1 << 18:
                told.clear()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hosts, pa.string()),
                    pa.array(kinds, pa.int32()),
                    pa.array(ids, pa.int64()),
                    pa.array(features, pa.int64()),
                    pa.array(paths, pa.list_(pa.int64())),
                    pa.array(priors, pa.float64()),
                ],
                ["host", "kind", "id", "feature", "path", "prior"],
            )

    schema = "host string, kind int, id bigint, feature bigint, path array<bigint>, prior double"
    rows = pages.select("host", "html").mapInArrow(run, schema)
    counts = rows.groupBy("host", "kind", "id", "feature", "path", "prior").agg(F.count("*").alias("n"))
    return materialize(counts, "style-tree")


def _evenness(counts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, feature, n) to (keys, seen, even): entropy of the features over log(seen), 1 for one."""
    n = F.col("n").cast("double")
    sums = counts.groupBy(*keys).agg(F.sum(n).alias("seen"), F.sum(n * F.log(n)).alias("nlogn"))
    entropy = F.log("seen") - F.col("nlogn") / F.col("seen")
    return sums.select(*keys, "seen", F.when(F.col("seen") > 1, F.greatest(entropy / F.log("seen"), F.lit(0.0))).otherwise(1.0).alias("even"))


def _own(counts: DataFrame) -> DataFrame:
    """(host, kind, id, own, pages): importance of the layouts and contents of every host's nodes, and
    the pages on all hosts that show the node."""
    features = counts.filter(F.col("kind") != PLACE)
    own = _evenness(features, ["host", "kind", "id"])
    every = _evenness(features.groupBy("kind", "id", "feature").agg(F.sum("n").alias("n")), ["kind", "id"])
    hosts = own.groupBy("kind", "id").agg(F.count("*").alias("n_hosts"))
    every = every.select("kind", "id", F.col("seen").alias("pages"), F.col("even").alias("everywhere")).join(hosts, ["kind", "id"])
    joined = lookup_join(own, materialize(every, "style-tree-all"), ["kind", "id"], "n_hosts", "host", "inner")
    blended = (F.col("seen") * F.col("even") + GLOBAL_SEEN * F.col("everywhere")) / (F.col("seen") + GLOBAL_SEEN)
    return materialize(joined.select("host", "kind", "id", "seen", blended.alias("own"), "pages"), "style-own")


def _odds(importance: str) -> Column:
    p = F.least(F.greatest(importance, F.lit(LEAST)), F.lit(1 - LEAST))
    return F.log(p / (1 - p))


def _trust(pages: str) -> Column:
    return F.col(pages) / (F.col(pages) + TRUSTED_SEEN)


def judged(counts: DataFrame) -> DataFrame:
    """(host, leaf, prior, evidence): the prior log-odds of every leaf of the tree, and those that the
    importances add.

    Every leaf has a row for each element above it, at most DEPTH; sums along that way are windows
    over a leaf's rows. What is known of an element is looked up with frequent elements spread.
    """
    own = _own(counts)
    places = counts.filter(F.col("kind") == PLACE).select("host", F.col("id").alias("leaf"), "path", "prior")
    texts = own.filter(F.col("kind") == CONTENT).select(
        "host", F.col("id").alias("leaf"), "seen", F.col("own").alias("content"), F.col("pages").alias("leaf_pages")
    )
    leaves = places.join(texts, ["host", "leaf"])
    way = leaves.select(
        "host", "leaf", "prior", "seen", "content", "leaf_pages", F.size("path").alias("depth"), F.posexplode("path").alias("at", "node")
    )
    way = materialize(way, "style-ways")
    below = way.groupBy("host", "node").agg(F.count("*").alias("n_below"))
    layouts = own.filter(F.col("kind") == LAYOUT).select("host", F.col("id").alias("node"), F.col("own").alias("layout"), "pages")
    layouts = materialize(layouts.join(below, ["host", "node"]), "style-layouts")
    way = lookup_join(way, layouts, ["host", "node"], "n_below", "leaf", "inner").drop("n_below")
    # From the leaf up: what the block gives each element above it.
    upward = Window.partitionBy("host", "leaf").orderBy(F.desc("at"))
    carried = F.lit(CARRIED)
    inside = F.sum(F.pow(carried, F.col("at")) * F.col("layout")).over(upward.rowsBetween(Window.unboundedPreceding, 0))
    given = (1 - carried) * F.pow(carried, -F.col("at")) * inside + F.pow(carried, F.col("depth") - F.col("at")) * F.col("content")
    way = materialize(way.withColumn("given", given), "style-given")
    composite = way.groupBy("host", "node").agg(
        (F.sum(F.col("given") * F.col("seen")) / F.sum("seen")).alias("composite"), F.count("*").alias("n_below")
    )
    way = lookup_join(way, materialize(composite, "style-composite"), ["host", "node"], "n_below", "leaf", "inner")
    # From the root down: every node's odds, as far as the nodes below it leave trust for them.
    left = F.coalesce(F.sum(F.log(1 - _trust("pages"))).over(upward.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    way = way.withColumn("above", _trust("pages") * _odds("composite") * F.exp(left))
    leaf = way.groupBy("host", "leaf", "prior", "leaf_pages").agg(
        F.sum("above").alias("above"), F.max(F.when(F.col("at") == F.col("depth") - 1, F.col("given"))).alias("given")
    )
    evidence = _trust("leaf_pages") * _odds("given") + (1 - _trust("leaf_pages")) * F.col("above")
    return leaf.select("host", "leaf", "prior", F.round(evidence, 9).alias("evidence"))


def main_text(page: str | None, low: set[int]) -> str:
    """The blocks of a page that no low branch holds."""
    return "\n".join(b.text for b in blocks(page) if b.leaf not in low)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, html) to (page_id, url, text), one row per input row.

    Character references are decoded, white space within a block becomes one blank, blocks are
    joined by line feeds in page order. A null or empty page has an empty text; a null url counts
    as one host without name. Repeated pages are kept, and count in their host's tree.
    """
    host, _ = host_and_path("url")
    hosted = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html", host.alias("host"))
    low = judged(observations(hosted)).filter(F.col("prior") + F.col("evidence") < 0)
    low = low.groupBy("host").agg(F.collect_set("leaf").alias("low"))
    sizes = hosted.groupBy("host").agg(F.count("*").alias("n_pages"))
    low = materialize(low.join(sizes, "host"), "low-branches")
    joined = lookup_join(hosted, low, ["host"], "n_pages", "page_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, set(nodes or ())) for p, nodes in zip(column(batch, "html"), column(batch, "low"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in ("page_id", "url")] + [pa.array(texts, pa.string())],
                ["page_id", "url", "text"],
            )

    return joined.select("page_id", "url", "html", "low").mapInArrow(run, "page_id bigint, url string, text string")


def n_chars(text: Column | str = "text") -> Column:
    return F.length(text).cast("bigint")
