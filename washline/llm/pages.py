"""Main text of HTML pages by a tree-structured graphical model.

A page's block elements are the nodes of a tree; each is content or not.  Potentials tie a child's
label to its parent's, and a node's own potential comes from its tag, its class, id and role words,
how much text and how many links it holds directly and whether the text ends like a sentence.  Sum-product
messages go up from the leaves and down from the root; both together give each node's
marginal.  The text of nodes that are content more likely than not is the page's text.

The potentials are counted on labelled pages: those whose markup names its main part, by one
`article` or `main` element.  Fixed priors stand for what few pages show.  A region named as
navigation, advert or comments is no content, and so is what it holds, however much text that is: its
potential is stronger than all messages, and it sends none, as an advert says nothing about the
text around it.  A class decides so as a whole: every word of it names such a region or is a plain word for
a part of a page (`comment-list`, not `has-comments`).  The page's root elements, headings, a form around
the page and an element around all its main parts are no such regions, whatever their names.

The parser looks at every character a fixed number of times, however broken the page.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from washline.llm.common import slices, text_or_empty, with_fields
from washline.names import column

#: Labelled pages that are fitted at most, those first in the order of a hash.
MOST_LABELLED = 400

# HTML's element kinds, and words that name a page's regions.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title noscript textarea template iframe svg math object canvas audio video select".split())
BLOCK = set(
    """html head body div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th blockquote pre
    article main section nav aside header footer form fieldset figure figcaption address details summary dialog center hr
    hgroup menu search button""".split()
)
CLOSES_P = BLOCK - set("html head body button td th tr tbody thead tfoot caption li dt dd".split())
CLOSED_BY_LIKE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "tbody": {"table"}, "thead": {"table"}, "tfoot": {"table"}}
LIKE = {"dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tbody", "thead", "tfoot"}, "thead": {"tbody", "thead", "tfoot"}, "tfoot": {"tbody", "thead", "tfoot"}}
NEVER_TAGS = set("head nav aside header footer form fieldset button menu dialog search".split())
NEVER_WORDS = set(
    """nav navbar navigation menu menubar header masthead footer sidebar aside ad ads advert adverts advertisement advertisements
    advertising adsense banner sponsor sponsored sponsors promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay
    form login signup subscribe subscription newsletter comment comments commentlist disqus respond reply replies share sharing social
    related recommended breadcrumb breadcrumbs pagination pager widget toolbar copyright legal skip search hidden""".split()
)
PLAIN_WORDS = set(
    """list area wrapper wrap box container section block bar group item inner outer panel pane row column col content body main site page post article
    entry blog user reader global primary secondary left right top bottom first last mobile desktop slot unit text links link title thread form area""".split()
)
UNSURE_WORDS = set("header sidebar notice copyright legal hidden search form social widget promo skip".split())
UNTELLING = set("html body div section span table tbody tr ul ol dl".split())
MAIN_TAGS = {"article", "main"}
MAIN_WORDS = set("article main content post entry story maincontent articlebody articletext".split())

HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: Elements whose text is short as a rule, so that its length and end say nothing.
TERSE = HEADINGS | set("li dt dd td th caption figcaption address summary legend pre".split())
#: What a form around a page holds, other than a form in it.
PAGE_PARTS = set("h1 main article header footer nav".split())
ROOTS = {"html", "body"}

#: Log-odds of these, and the most that counted features may say.  NAMED is for a region's element and all in it,
#: MAYBE for an element that only its id names, or that a whole class word also names as the main part.
NAMED, MAYBE, MAIN_TAG, MAIN_WORD, ROOT, MOST_COUNTED = -20.0, -3.0, 8.0, 3.0, -5.0, 2.0

#: Parent-child potentials start from so many imagined pairs, and no change of label becomes rarer than FLOOR.
IMAGINED, FLOOR = 20, 0.02

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORDS = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
NO_NAMES: frozenset[str] = frozenset()
SENTENCE = tuple(".!?…。")


@dataclass
class Node:
    parent: int
    tag: str
    names: frozenset[str]
    named: float = 0.0  # log-odds by the element's own tag and names: NAMED, MAYBE or 0
    region: bool = False  # is the element in a named region, or one?
    text: int = 0
    linked: int = 0
    ends: int = 0


@dataclass
class Page:
    nodes: list[Node] = field(default_factory=list)
    blocks: list[tuple[int, str]] = field(default_factory=list)


def _deciding(words: set[str]) -> set[str]:
    """Of a class's words, those that name a region, if the class says nothing else."""
    return words & NEVER_WORDS if words <= NEVER_WORDS | PLAIN_WORDS else set()


def _names(attributes: str) -> tuple[frozenset[str], frozenset[str], frozenset[str], bool]:
    """The words of class, id and role; those that decide; of these, those of class and role; and whether one class is made of words for the main part."""
    if "=" not in attributes:
        return NO_NAMES, NO_NAMES, NO_NAMES, False
    words, deciding, telling, main = set(), set(), set(), False
    for name, *values in NAMES.findall(attributes):
        own = [set(WORDS.findall(CAMEL.sub(" ", x).lower())) for x in html.unescape("".join(values)).split()]
        words.update(*own)
        found = set().union(*map(_deciding, own))
        deciding |= found
        if name.lower() != "id":
            telling |= found
            main = main or any(x and x <= MAIN_WORDS for x in own)
    return frozenset(words), frozenset(deciding), frozenset(telling), main


def _said(deciding: frozenset[str], names: frozenset[str]) -> bool:
    """Do the words name a region that is no content?  Some don't tell so beside a word for the main part."""
    return bool(deciding - UNSURE_WORDS) or bool(deciding) and not MAIN_WORDS & names


def _named(tag: str, names: frozenset[str], deciding: frozenset[str], telling: frozenset[str], main: bool, inside: bool) -> float:
    """Log-odds by the names of an element; `inside` an article, a header belongs to it."""
    if tag in ROOTS or tag in HEADINGS:
        return 0.0
    if inside and tag == "header":
        deciding, telling = deciding - {"header"}, telling - {"header"}
    elif tag in NEVER_TAGS:
        return NAMED
    if not _said(deciding, names):
        return 0.0
    # A section's id is its title's words, an inline element's a place to link to.
    by_id = (tag == "section" or tag not in BLOCK) and not _said(telling, names)
    return MAYBE if by_id or main else NAMED


def _regions(nodes: list[Node]) -> None:
    """Mark what is in named regions; neither a form around the page nor an element around all its main parts is one."""
    mains, parts, around = ([0] * len(nodes) for _ in range(3))
    for i in range(len(nodes) - 1, 0, -1):
        node = nodes[i]
        mains[i] += node.tag in MAIN_TAGS and node.named != NAMED
        mains[node.parent] += mains[i]
        parts[node.parent] += parts[i] + (node.tag in PAGE_PARTS)
    for i, node in enumerate(nodes[1:], 1):
        above = nodes[node.parent]
        around[i] = around[node.parent] + (above.tag in MAIN_TAGS)
        page_form = node.tag == "form" and parts[i] and above.tag in ROOTS | {"root", "div", "main"} and not above.region
        if node.named and (page_form or mains[i] and not around[i] and mains[i] == mains[0]):
            node.named = 0.0
        node.region = above.region or node.named == NAMED


def _tags(source: str) -> Iterator[tuple[int, int, str, str, bool]]:
    """Start, end, name, attributes and whether it closes of each tag; comments and declarations have an empty name.

    Of a quote that is not closed before the last `>`, nothing is made.
    """
    at, last = 0, source.rfind(">")
    closing = {}  # where the next quote of each kind is, as far as looked

    def quote_after(mark: str, place: int) -> int:
        if closing.get(mark, -1) < place:
            found = source.find(mark, place)
            closing[mark] = len(source) if found < 0 else found
        return closing[mark]

    while True:
        start = source.find("<", at)
        if start < 0:
            return
        if source.startswith("<!--", start):
            end = source.find("-->", start + 4)
            at = len(source) if end < 0 else end + 3
            yield start, at, "", "", False
            continue
        if start > last:
            return
        if source.startswith(("<!", "<?"), start):
            at = source.find(">", start) + 1
            yield start, at, "", "", False
            continue
        name = TAG.match(source, start)
        if not name:
            at = start + 1
            continue
        first = end = source.find(">", name.end())
        place = name.end()
        while True:
            marks = [quote_after(m, place) for m in "\"'"]
            opened = min(marks)
            if opened > end:
                break
            closed = quote_after("\"'"[marks.index(opened)], opened + 1)
            if closed >= last:
                end = first  # as if there were no quotes
                break
            place = closed + 1
            if closed > end:
                end = source.find(">", place)
        at = end + 1
        yield start, at, name[2].lower(), source[name.end() : end], bool(name[1])


def parse(source: str) -> Page:
    """Block elements as nodes, parents first, and the text blocks with the node that holds each."""
    page = Page([Node(-1, "root", NO_NAMES)])
    nodes, stack = page.nodes, [0]
    places: dict[str, list[int]] = {}  # of the open elements of each tag in the stack
    inline: list[tuple[str, int]] = []  # open inline elements that name a region: tag and stack height
    held: list[str] = []
    linked, link = 0, 0
    at = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(held)).split()) if held else ""
        held.clear()
        if text:
            node = nodes[stack[-1]]
            node.text += len(text)
            node.linked += min(linked, len(text))
            node.ends += text.endswith(SENTENCE)
            page.blocks.append((stack[-1], text))
        linked = 0

    def innermost(tags: Iterable[str]) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def end_at(height: int) -> None:
        flush()
        for i in stack[height:]:
            places[nodes[i].tag].pop()
        del stack[height:]
        while inline and inline[-1][1] >= height:
            inline.pop()

    def close(tags: Iterable[str], within: Iterable[str] = ()) -> None:
        """End the innermost open element of `tags`, and what it holds, unless one of `within` is nearer."""
        height = innermost(tags)
        if height and height > innermost(within):
            end_at(height)

    def begin(tag: str, names: frozenset[str], named: float) -> None:
        flush()
        nodes.append(Node(stack[-1], tag, names, named))
        places.setdefault(tag, []).append(len(stack))
        stack.append(len(nodes) - 1)

    def named_by(tag: str, found: tuple[frozenset[str], frozenset[str], frozenset[str], bool]) -> float:
        return _named(tag, *found, tag == "header" and innermost(MAIN_TAGS) > 0)

    for start, after, tag, attributes, closes in _tags(source):
        if start < at:  # inside an element of raw text
            continue
        if start > at:
            held.append(source[at:start])
            if link:
                linked += start - at
        at = after
        if not tag:
            continue
        if closes:
            if tag in BLOCK:
                close((tag,))
                link = 0
            elif tag == "a":
                link = 0
            elif inline and inline[-1][0] == tag:
                end_at(inline[-1][1])
            continue
        if tag in RAW:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}[\s>/]", re.I).search(source, at)
                rest = source.find(">", end.start()) if end else -1
                at = rest + 1 if rest >= 0 else len(source)
            held.append(" ")
        elif tag in BLOCK:
            if tag in CLOSES_P:
                close(("p",), ("td", "th", "li", "button") if tag == "p" else ())
            if tag in CLOSED_BY_LIKE:
                close(LIKE.get(tag, (tag,)), CLOSED_BY_LIKE[tag])
            if tag == "hr":
                flush()
            else:
                names = _names(attributes)
                begin(tag, names[0], named_by(tag, names))
        elif tag in VOID:
            held.append(" ")
        elif tag == "a":
            link = 1
        elif "=" in attributes and nodes[stack[-1]].tag not in HEADINGS and (named := named_by(tag, names := _names(attributes))):
            inline.append((tag, len(stack)))
            begin(tag, names[0], named)
    if at < len(source):
        held.append(source[at:])
    flush()
    _regions(nodes)
    return page


def _seen(node: Node) -> list[str]:
    """Features that are counted of an element outside of regions, and of the text it holds directly."""
    if node.region:
        return []
    found = [*node.names] if node.tag in UNTELLING or node.tag in TERSE else [f"tag:{node.tag}", *node.names]
    if node.text:
        found.append("links:none" if not node.linked else "links:few" if 2 * node.linked < node.text else "links:most")
        if node.tag not in TERSE:
            found.append("text:short" if node.text < 25 else "text:medium" if node.text < 80 else "text:long")
            found.append("sentence:ends" if node.ends else "sentence:none")
    return found


@dataclass
class Model:
    counted: dict[str, float] = field(default_factory=dict)
    starts: float = 1 / IMAGINED  # P(child is content | parent is not)
    stops: float = 1 / IMAGINED  # P(child is not | parent is)

    def own(self, node: Node) -> float:
        """Log-odds of content from the node alone."""
        if node.parent < 0:
            return ROOT
        if node.region:
            return NAMED
        odds = sum(self.counted.get(f, 0.0) for f in _seen(node)) + MAIN_WORD * (not MAIN_WORDS.isdisjoint(node.names))
        return odds + node.named + MAIN_TAG * (node.tag in MAIN_TAGS)

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Log-odds of content for each node, from messages up and down the tree."""
        up = [self.own(n) for n in nodes]
        sent = [0.0] * len(nodes)
        # In a region labels change as rarely as they can.
        ties = [(FLOOR, FLOOR) if nodes[n.parent].region else (self.starts, self.stops) for n in nodes[1:]]
        ties = [(starts, stops, 1 - stops, 1 - starts) for starts, stops in ties]
        for i in range(len(nodes) - 1, 0, -1):
            node = nodes[i]
            if node.region and not nodes[node.parent].region:
                continue
            starts, stops, on, off = ties[i - 1]
            e = math.exp(max(-30.0, min(30.0, up[i])))
            sent[i] = math.log((on * e + stops) / (starts * e + off))
            up[node.parent] += sent[i]
        for i in range(1, len(nodes)):
            starts, stops, on, off = ties[i - 1]
            e = math.exp(max(-30.0, min(30.0, up[nodes[i].parent] - sent[i])))
            up[i] += math.log((on * e + starts) / (stops * e + off))
        return up

    def text(self, source: str) -> str:
        page = parse(source)
        odds = self.marginals(page.nodes)
        return "\n\n".join(text for node, text in page.blocks if odds[node] > 0)


def _labels(page: Page) -> list[bool] | None:
    """Content or not, by the page's one outermost `article` or `main` element; None without exactly one."""
    labels, named = [False], 0
    for node in page.nodes[1:]:
        inside = labels[node.parent]
        named += node.tag in MAIN_TAGS and not inside and not node.region
        labels.append((inside or node.tag in MAIN_TAGS) and not node.region)
    return labels if named == 1 else None


def train(sources: list[str]) -> Model:
    """Count the potentials on those pages whose markup labels them; with none, the priors alone."""
    content, other = Counter(), Counter()
    pairs, totals = Counter(), [0, 0]
    for source in sources:
        page = parse(source)
        labels = _labels(page)
        if not labels:
            continue
        for node, label in zip(page.nodes[1:], labels[1:], strict=True):
            (content if label else other).update(_seen(node))
            totals[label] += 1
            if not node.region:
                pairs[labels[node.parent], label] += 1
    counted = {}
    for f in {*content, *other}:
        odds = math.log((content[f] + 1) / (totals[1] + 2)) - math.log((other[f] + 1) / (totals[0] + 2))
        counted[f] = max(-MOST_COUNTED, min(MOST_COUNTED, odds))

    def share(parent: bool) -> float:
        changed, kept = pairs[parent, not parent], pairs[parent, parent]
        return max(FLOOR, (changed + 1) / (changed + kept + IMAGINED))

    return Model(counted, share(False), share(True))


def fit(pages: DataFrame) -> Model:
    """Train on at most MOST_LABELLED pages of the table that have an `article` or `main` element."""
    source = text_or_empty("html")
    labelled = pages.select(source.alias("html")).where(F.regexp_like(source, F.lit("(?i)<(article|main)[ >]")))
    hashed = labelled.select("html", F.xxhash64("html").alias("order"))
    # First the hashes alone, so that no task sends pages that are not chosen; copies count once.
    orders = [r["order"] for r in hashed.select("order").distinct().orderBy("order").limit(MOST_LABELLED).collect()]
    if not orders:
        return train([])
    chosen = hashed.where(F.col("order") <= orders[-1]).groupBy("order").agg(F.min("html").alias("html"))
    return train([r["html"] for r in chosen.orderBy("order").collect()])


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """Add `text` and `n_chars` (code points) to rows with `html`, which is dropped.

    The text's blocks are in page order, joined by two line breaks; white space in a block is one
    blank.  A null or empty page, or one without content, has an empty text.  Columns of the added
    names are replaced; other columns and equal rows stay.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 128):
            *own, sources = part.columns
            texts = [model.text(s) for s in sources.to_pylist()]
            yield pa.RecordBatch.from_arrays([*own, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*places, "text", "n_chars"])

    kept = pages.drop("html", "text", "n_chars")
    # Numbered, as Spark's mapInArrow takes no names with dots.
    places = [f"column{i}" for i in range(len(kept.columns))]
    schema = with_fields(T.StructType([T.StructField(p, f.dataType) for p, f in zip(places, kept.schema, strict=True)]), text=T.StringType(), n_chars=T.LongType())
    rows = pages.select(*(column(c).alias(p) for c, p in zip(kept.columns, places, strict=True)), text_or_empty("html").alias("__html"))
    return rows.mapInArrow(add, schema).toDF(*kept.columns, "text", "n_chars")
