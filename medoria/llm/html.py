"""Main-text extraction from web pages with site style trees.

Every page is parsed once into blocks of text, each with the chain of element
nodes it hangs from. A node of a site's style tree is the path of tags and classes
from the root, so merging the pages of a host is grouping by host and path. Over
the pages that have a node, entropies give its importance:

* content: a block of text that k of the m pages share at a node has entropy
  log k / log m; a node's content importance is 1 minus the mean over the blocks
  below it, so text that all pages repeat counts 0 and text of one page 1;
* presentation: the entropy, as a share of log m, of the sequences of child
  elements that the node shows on different pages;
* both together: (1 - g^l) * presentation + g^l * content, l being the number of
  different child sequences and g = 0.9.

Pages of a host whose text outside of noise is equal count once in the tree, so copies of a page are
no template. What a page says of itself is a prior: importance is averaged with it, the tree
weighing as many observations as it has pages.

* a node without a mark has the prior 0.5 with the weight of one page, and is removed below ``least``;
* a node in a marked article (``article``, ``main``; an element whose class is one of ``MAIN_WORDS``
  and that holds no such element) has the prior 1 with the weight of four, and is removed below
  ``least`` times the host's best article: where all articles are alike none is a template. Headings
  stay, and so does everything if more than half of a page's article would go;
* an article is believed unless what else is left of the page is over twice as long; then all of it counts;
* noise goes: tags such as navigation and footers, and classes, ids and roles that say so with a whole name,
  so ``sidebar`` does and ``has-sidebar`` does not. Names that may also be those of a page's own text (``WEAK_WORDS``)
  give way to a class of ``MAIN_WORDS`` beside them, and to a page that holds nothing else;
* a form goes unless it holds over half of the page's text; an article inside a form is not its part.

A page of which nothing would be left keeps all but its noise.

Nodes are counted once per page before they are shuffled, and only counts per host and path are. Low
nodes are matched with the paths of pages, not with their texts; a page's list of removed paths is at most its own paths.

Defined results: a null or empty page, or one without text, has the empty string; a
null url is a host of its own; equal pages get equal texts and repeated rows are kept;
unclosed, crossed and cut-off elements are read as far as they go; very long pages are parsed whole, in time
that grows with their length and depth, and have to fit in a task; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medoria.operators import lookup
from medoria.work import materialise

LEAST = 0.2
GAMMA = 0.9
PRIOR, WEIGHT = 0.5, 1
MARKED_PRIOR, MARKED_WEIGHT = 1.0, 4
NOISE, MAYBE = 2, 1  # how sure it is that a block is noise

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section"
    " select summary table tbody td tfoot th thead tr ul".split()
)
# an element on the left ends when one on the right begins
ENDED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "option": frozenset(["option", "optgroup"]),
    "head": frozenset(["body"]),
}
NOISE_TAGS = frozenset("nav footer aside button select menu dialog svg object canvas audio video head".split())
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies"
    " disclaimer footer login menu modal nav navbar navigation newsletter notice notices pagination popup promo"
    " promotion related search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
# noise, unless nothing else is there
WEAK_WORDS = frozenset("modal related search share sharing social toolbar widget".split())
MAIN_WORDS = frozenset("article content entry main post story".split())
COMMENT_WORDS = frozenset(["comment", "comments"])
HEADER_WORDS = frozenset(["header", "contentinfo", "complementary"])
# words that only say where or which part: a name of these and noise words is still that of the noise itself
PLACE_WORDS = frozenset(
    "bar bottom box button buttons desktop global head icons inner item items left link links list main mobile page"
    " posts primary right secondary section site text top".split()
)
MAIN_TAGS = frozenset(["article", "main"])


def _named(tokens: list[str], names: frozenset[str]) -> bool:
    """Whether a class, id or role names the node itself: ``sidebar`` and ``left-sidebar``, not ``has-sidebar``."""
    for token in tokens:
        words = set(_WORD.findall(token))
        if words & names and words <= names | NOISE_WORDS | PLACE_WORDS:
            return True
    return False


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)}


class Node:
    """An open element: its place in the style tree, how sure it is noise, the article and the likely ones it is in, its form."""

    __slots__ = ("tag", "path", "noise", "main", "likely", "form", "children")

    def __init__(self, tag: str, path: str, noise: int = 0, main: str = "", likely: tuple = (), form: Node | None = None):
        self.tag, self.path, self.noise, self.main, self.likely = tag, path, noise, main, likely
        self.form = form or (self if tag == "form" else None)
        self.children: list[str] = []


def _open(tag: str, attributes: str, parent: Node) -> Node:
    label, noise, marks, likely = tag, parent.noise, tag in MAIN_TAGS, False
    if tag in NOISE_TAGS or tag == "header" and not parent.main:
        noise = NOISE
    if attributes.strip(" /\n\t"):
        found = _attributes(attributes)
        classes = found.get("class", "").lower()
        if classes:
            label += "." + ".".join(sorted(classes.split()))
        role = found.get("role", "").lower()
        marks = marks or role == "main"
        names = f"{classes} {found.get('id', '').lower()} {role}".split()
        likely = not MAIN_WORDS.isdisjoint(classes.split())
        inside = tag in ("html", "body") or tag in MAIN_TAGS and not _named(names, COMMENT_WORDS)
        style = found.get("style", "").replace(" ", "").lower()
        if "hidden" in found or "display:none" in style:
            noise = NOISE
        elif not inside and (
            _named(names, NOISE_WORDS - WEAK_WORDS) or not parent.main and _named(names, HEADER_WORDS)
        ):
            noise = NOISE
        elif not inside and not likely and _named(names, WEAK_WORDS):
            noise = max(noise, MAYBE)
    path = f"{parent.path}/{label}"
    main = parent.main or (path if marks else "")
    # an article in a form is no part of what is filled in
    node = Node(tag, path, noise, main, parent.likely, None if tag in MAIN_TAGS else parent.form)
    if likely and not main:
        node.likely = (*parent.likely, node)
    return node


def parse(html: str) -> tuple[list[tuple[str, list[str], int, str]], list[tuple[str, str]]]:
    """The blocks (text, chain of paths, noise, path of the article) and nodes outside of noise (path, child sequence) of a page."""
    root = Node("", "")
    stack, nodes = [root], []
    blocks: list[tuple[str, list[str], int, Node]] = []
    buffer: list[tuple[str, Node]] = []
    lower = None

    def flush() -> None:
        # text of one block may mix noise and the rest, as in a hidden span
        for noise in (0, MAYBE, NOISE):
            text = " ".join(unescape("".join(t for t, n in buffer if n.noise == noise)).split())
            if text:
                first = next(n for t, n in buffer if n.noise == noise and not t.isspace())
                blocks.append((text, chains[id(first)], noise, first))
        buffer.clear()

    chains: dict[int, list[str]] = {id(root): []}
    keep = [root]  # nodes must outlive the ids that stand for them

    def close(upto: int) -> None:
        while len(stack) > upto:
            node = stack.pop()
            if node.noise:
                continue
            sequence = [c for k, c in enumerate(node.children) if k == 0 or c != node.children[k - 1]]
            nodes.append((node.path, " ".join(sequence)))

    at, end = 0, len(html)
    while at < end:
        m = _TOKEN.search(html, at)
        if m is None:
            buffer.append((html[at:], stack[-1]))
            break
        if m.start() > at:
            buffer.append((html[at : m.start()], stack[-1]))
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag), 0)
            if tag in BLOCKS:
                flush()
            if k:
                close(k)
            continue
        if tag in BLOCKS:
            flush()
            # a block ends an open paragraph, with all that is open in it
            k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == "p"), 0)
            if k:
                close(k)
        while len(stack) > 1 and tag in ENDED_BY.get(stack[-1].tag, ()):
            close(len(stack) - 1)
        if tag == "br":
            buffer.append((" ", stack[-1]))
        if tag in VOID or m[3].endswith("/") and tag in RAW:
            continue
        node = _open(tag, m[3], stack[-1])
        stack[-1].children.append(node.path.rpartition("/")[2])
        if tag in RAW:
            lower = html.lower() if lower is None else lower
            found = lower.find(f"</{tag}", at) if len(lower) == end else html.find(f"</{tag}", at)
            at = end if found < 0 else found
            # its end tag pops nothing: the element is never opened
            done = html.find(">", at)
            at = end if done < 0 else done + 1
            continue
        chains[id(node)] = [*chains[id(stack[-1])], node.path]
        keep.append(node)
        stack.append(node)
    flush()
    close(1)
    # a form is noise, unless it is wrapped around most of the page's text
    size, held = 0, Counter()
    for text, _, noise, node in blocks:
        if not noise:
            size += len(text)
            held[node.form] += len(text)
    # a likely article that holds a marked one is its frame
    frames = {id(n) for _, _, noise, node in blocks if node.main and not noise for n in node.likely}
    return [
        (
            text,
            chain,
            NOISE if node.form is not None and 2 * held[node.form] <= size else noise,
            node.main or next((n.path for n in node.likely if id(n) not in frames), ""),
        )
        for text, chain, noise, node in blocks
    ], nodes


BLOCK = "struct<text:string,chain:array<string>,noise:tinyint,main:string>"


def parsed(pages: DataFrame) -> DataFrame:
    """(id, url, host, blocks, nodes) of a table of (id, url, html)."""
    kind = pages.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = pa.struct(
            [("text", pa.string()), ("chain", pa.list_(pa.string())), ("noise", pa.int8()), ("main", pa.string())]
        )
        node = pa.struct([("path", pa.string()), ("style", pa.string())])
        for batch in batches:
            # some pages at a time, so that what is built from them stays small
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                all_blocks, all_nodes = [], []
                for html in part.column(2):
                    blocks, nodes = parse(html.as_py())
                    all_blocks.append([dict(zip(("text", "chain", "noise", "main"), b)) for b in blocks])
                    all_nodes.append([{"path": p, "style": s} for p, s in sorted(set(nodes))])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(all_blocks, pa.list_(block)),
                        pa.array(all_nodes, pa.list_(node)),
                    ],
                    names=["id", "url", "blocks", "nodes"],
                )

    out = pages.mapInArrow(
        run, f"id {kind}, url string, blocks array<{BLOCK}>, nodes array<struct<path:string,style:string>>"
    )
    host = F.regexp_extract(F.coalesce("url", F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return out.withColumn("host", F.lower(host))


def _clean(blocks: str = "blocks") -> Column:
    return F.filter(blocks, lambda b: b["noise"] == 0)


def importance(site: DataFrame) -> DataFrame:
    """(host, path, pages, importance, inside, top) of all nodes of the hosts' style trees, from ``parsed`` pages.

    ``inside``: the node is in a marked article; ``top``: it is the article.
    """
    texts = F.array_distinct(
        F.transform(
            _clean(),
            lambda b: F.struct(b["chain"].alias("chain"), b["main"].alias("main"), F.xxhash64(b["text"]).alias("text")),
        )
    )
    look = F.xxhash64(F.transform(_clean(), lambda b: b["text"]))
    pages = site.select("host", look.alias("look"), F.struct(texts.alias("texts"), "nodes").alias("page"))
    site = pages.groupBy("host", "look").agg(F.min("page").alias("page")).select("host", "page.*")

    styles = site.select("host", F.explode("nodes").alias("n")).select("host", "n.*")
    seen = styles.groupBy("host", "path", "style").agg(F.count("*").alias("k"))
    log = F.log
    presentation = seen.groupBy("host", "path").agg(
        F.sum("k").alias("pages"), F.count("*").alias("styles"), F.sum(F.col("k") * log(F.col("k"))).alias("klogk")
    )
    # -sum p log p = log m - sum k log k / m
    share = (log("pages") - F.col("klogk") / F.col("pages")) / log("pages")
    presentation = presentation.select(
        "host", "path", "pages", "styles", F.when(F.col("pages") > 1, share).otherwise(1.0).alias("presentation")
    )
    shared = (
        site.select("host", F.explode("texts").alias("b"))
        .groupBy("host", "b.chain", "b.main", "b.text")
        .agg(F.count("*").alias("k"))
        .withColumn("path", F.element_at("chain", -1))
    )
    m = presentation.select("host", "path", "pages")
    known = shared.join(m, ["host", "path"])
    entropy = F.when(F.col("pages") > 1, F.least(log("k") / log("pages"), F.lit(1.0))).otherwise(0.0)
    leaves = known.groupBy("host", "chain", "main").agg(F.sum("k").alias("n"), F.sum(F.col("k") * entropy).alias("h"))
    content = (
        leaves.select("host", F.explode("chain").alias("path"), "main", "n", "h")
        .groupBy("host", "path")
        .agg(
            (1 - F.sum("h") / F.sum("n")).alias("content"),
            F.bool_or((F.col("main") != "") & F.startswith("path", "main")).alias("inside"),
            F.bool_or(F.col("path") == F.col("main")).alias("top"),
        )
    )
    weight = F.pow(F.lit(GAMMA), F.col("styles"))
    both = (1 - weight) * F.col("presentation") + weight * F.col("content")
    return presentation.join(content, ["host", "path"]).select(
        "host", "path", "pages", both.alias("importance"), "inside", "top"
    )


def low_nodes(ranked: DataFrame, least: float = LEAST) -> DataFrame:
    """(host, path) of the nodes to remove, from those of ``importance``."""

    def with_prior(prior: float, weight: int) -> Column:
        return (F.col("pages") * F.col("importance") + prior * weight) / (F.col("pages") + weight)

    believed = F.when(F.col("inside"), with_prior(MARKED_PRIOR, MARKED_WEIGHT)).otherwise(with_prior(PRIOR, WEIGHT))
    ranked = materialise(ranked.withColumn("believed", believed), "ranked")
    best = ranked.where("top").groupBy("host").agg(F.max("believed").alias("best"))
    heading = F.col("path").rlike(r"/h[1-6](\.[^/]*)?$")
    bound = F.when(F.col("inside"), F.when(~heading, F.coalesce("best", F.lit(1.0)) * least)).otherwise(least)
    return lookup(ranked, best, "host").where(F.col("believed") < bound).select("host", "path")


def _size(blocks: Column) -> Column:
    return F.aggregate(blocks, F.lit(0).cast("long"), lambda n, b: n + F.char_length(b["text"]))


def main_text(
    pages: DataFrame,
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least: float = LEAST,
) -> DataFrame:
    """Per page: the id, ``url`` and ``text``."""
    rows = pages.select(
        F.col(id).alias("id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html")
    )
    site = materialise(parsed(rows).withColumn("row", F.monotonically_increasing_id()), "parsed")
    place = F.struct("host", "path").alias("place")
    low = materialise(low_nodes(importance(site), least).select(place, F.lit(True).alias("low")), "low")
    places = site.select("row", "host", F.explode("nodes.path").alias("path")).select("row", place)
    removed = lookup(places, low, "place", spread_by="row").where("low")
    removed = removed.groupBy("row").agg(F.collect_set("place.path").alias("removed"))

    def stays(b: Column) -> Column:
        return ~F.coalesce(F.arrays_overlap(b["chain"], "removed"), F.lit(False))

    # a column each, so that a page's blocks are filtered once
    steps = lookup(site, materialise(removed, "removed"), "row").select("id", "url", "blocks", _clean().alias("clean"), "removed")
    steps = steps.withColumns(
        {
            "left": F.filter("clean", stays),
            "article": F.filter("clean", lambda b: b["main"] != ""),
            "maybe": F.filter("blocks", lambda b: b["noise"] == MAYBE),
        }
    )
    steps = steps.withColumn("within", F.filter("left", lambda b: b["main"] != ""))
    within = F.when(2 * _size(F.col("within")) >= _size(F.col("article")), F.col("within")).otherwise(F.col("article"))
    others = F.filter("left", lambda b: b["main"] == "")
    believed = (F.size("article") > 0) & (_size(others) <= 2 * _size(within))
    kept = (
        F.when(believed, within)
        .when(F.size("left") > 0, F.col("left"))
        .when(F.size("clean") > 0, F.col("clean"))
        .otherwise(F.col("maybe"))
    )
    text = F.array_join(F.transform(kept, lambda b: b["text"]), "\n").alias("text")
    return steps.select(F.col("id").alias(id), "url", text)
