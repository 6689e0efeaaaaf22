"""HTML extraction by tree scoring.

A page is parsed to a tree; scripts, menus, headers, footers, sidebars, notices, adverts, forms
and reader comments are pruned by tag, role and names; inside an article a name needs support, a high
share of links or a class that is the name as a whole, and prunes no heading, quotation, table or
figure.  A form around the article is a wrapper and stays.  Each paragraph left gives points for its
length and commas to its parent, half of them to the next ancestor, a third to the one above and
so on; a container's points are discounted by its share of linked text.  The best container,
taken up to the article or main element around it, is kept with those siblings that score well,
read like its paragraphs or hold the title.  Everything in what is kept is returned.

Character references are decoded; white space inside a block becomes one space; blocks stand in
page order, one per line.  A null or empty page has the empty text; a page without markup is one
block; any size and depth is parsed whole, in time that grows with the page; repeated rows are parsed alike; an empty table gives
an empty result; columns not asked for are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[\s/]++|[^\s/>=][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'>][^\s>]*+)?)?|=)*+)>")
LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>")
ATTRIBUTE = re.compile(r"([^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?")
NAME = re.compile(r"[a-z0-9]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")

# fixed values of HTML: elements without content, with raw text, that are blocks, and that end open ones
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
ENDS = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option"]),
    "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]),
    "tbody": frozenset(["tbody", "thead", "tr", "td", "th"]), "tfoot": frozenset(["tbody", "thead", "tr", "td", "th"]),
}
SCOPE = {"li": frozenset(["ul", "ol", "menu"]), "dt": frozenset(["dl"]), "dd": frozenset(["dl"]), "option": frozenset(["select"])}
SECTIONS = frozenset("article aside blockquote body div footer header main nav section table td th ul ol form fieldset figure details".split())

# elements, roles and names of what is not the article
PRUNED = frozenset("head nav footer aside button select input label dialog menu svg canvas object embed audio video map search".split()) | RAW
FORMS = frozenset(["form", "fieldset"])
QUOTED = frozenset("blockquote pre table thead tbody tr td th dl dt dd figure figcaption details summary".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside widget widgets ad ads adv advert adverts advertisement advertisements "
    "adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe "
    "subscription share sharing social related recommended recommendations login signin signup search pagination pager toolbar skip disclaimer copyright "
    "toc tags outbrain taboola".split()
)
COMMENTS = frozenset("comment comments commentlist disqus discussion respond reply replies".split())
GOOD = frozenset("article content main body post entry story text page hentry blog".split())
BEST = frozenset(["article", "main"])
TITLES = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
PROSE = re.compile(r"[.!?\u3002\uff01\uff1f]")


class Node:
    __slots__ = ("tag", "names", "whole", "role", "hidden", "parent", "children", "points", "size", "linked", "gone", "commas", "titled", "prose")

    def __init__(self, tag: str, attributes: str, parent: Node | None):
        self.tag, self.parent, self.children = tag, parent, []
        self.names, self.whole, self.role, self.hidden = frozenset(), frozenset(), "", False
        self.points, self.size, self.linked, self.gone = 0.0, 0, 0, False
        self.commas, self.titled, self.prose = 0, tag == "h1", False
        if attributes and not attributes.isspace():
            names = ""
            for key, *values in ATTRIBUTE.findall(attributes):
                key, value = key.lower(), "".join(values)
                if key in ("class", "id"):
                    names += " " + CAMEL.sub(" ", value)
                    if key == "class":
                        self.whole |= frozenset(value.lower().split())
                elif key == "role":
                    self.role = value.strip().lower()
                elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and HIDDEN.search(value.lower()):
                    self.hidden = True
            self.names = frozenset(NAME.findall(names.lower()))

    def upward(self) -> Iterator[Node]:
        """The element itself, then its ancestors."""
        node = self
        while node is not None:
            yield node
            node = node.parent


def parse(html: str) -> tuple[Node, list[Node]]:
    """The root and all elements in page order."""
    root = Node("html", "", None)
    node, nodes, at, end = root, [root], 0, len(html)
    open_tags = {"html": 1}

    def close(to: Node) -> None:
        """Close open elements up to and including this one."""
        nonlocal node
        while True:
            last = node
            open_tags[last.tag] -= 1
            node = last.parent or root
            if last is to:
                return

    while at < end:
        mark = html.find("<", at)
        if mark < 0:
            mark = end
        if mark > at:
            node.children.append(html[at:mark])
        if mark == end:
            break
        if html.startswith("<!--", mark):
            stop = html.find("-->", mark + 4)
            at = end if stop < 0 else stop + 3
            continue
        tag = TAG.match(html, mark) or LOOSE_TAG.match(html, mark)
        if tag is None:
            if html[mark + 1 : mark + 2] in ("!", "?", "/"):
                stop = html.find(">", mark)
                at = end if stop < 0 else stop + 1
            else:  # a sign, not a tag
                node.children.append("<")
                at = mark + 1
            continue
        at = tag.end()
        name = tag[2].lower()
        if tag[1]:
            if open_tags.get(name) and name != "html":
                close(next(n for n in node.upward() if n.tag == name))
            continue
        if name in ("html", "body") and open_tags.get(name):
            continue
        if name in BLOCK and open_tags.get("p"):
            found = next((n for n in node.upward() if n.tag == "p" or n.tag in SECTIONS), None)
            if found is not None and found.tag == "p":
                close(found)
        if name in ENDS and any(open_tags.get(t) for t in ENDS[name]):
            found, stop = None, SCOPE.get(name, frozenset(["table"]))
            for n in node.upward():
                if n.tag in stop:
                    break
                if n.tag in ENDS[name]:
                    found = n
                    if name in SCOPE:
                        break
            if found is not None:
                close(found)
        if name == "body" and open_tags.get("head"):
            close(next(n for n in node.upward() if n.tag == "head"))
        new = Node(name, tag[3], node)
        node.children.append(new)
        nodes.append(new)
        if name in RAW:
            stop = re.compile(rf"</{re.escape(name)}\s*+[^>]*+>", re.I).search(html, at)
            new.children.append(html[at : stop.start() if stop else end])
            at = stop.end() if stop else end
        elif name not in VOID:  # HTML ignores a closing slash
            node = new
            open_tags[name] = open_tags.get(name, 0) + 1
    return root, nodes


def length(text: str) -> int:
    return len(" ".join(text.split()))


def measure(nodes: list[Node]) -> None:
    """Text, linked text, commas, sentences and titles below each element, without pruned ones; children come after parents."""
    for node in reversed(nodes):
        node.size = node.linked = node.commas = 0
        node.titled, node.prose = node.tag == "h1", False
        if node.gone:
            continue
        for child in node.children:
            if isinstance(child, str):
                text = unescape(child) if "&" in child else child
                node.size += length(text)
                node.commas += text.count(",") + text.count("，")
                node.prose = node.prose or PROSE.search(text) is not None
            else:
                node.size += child.size
                node.linked += child.linked
                node.commas += child.commas
                node.titled = node.titled or child.titled
                node.prose = node.prose or child.prose
        if node.tag == "a":
            node.linked = node.size


def aside(node: Node) -> bool:
    """Whether a named element inside the article is none of it: mostly links, or a class that is a name as a whole.

    Headers, what holds the title, and sections that only their id names belong to the article, and
    so do quotations, tables and figures that are not mostly links.
    """
    if node.tag == "header" or node.titled or node.tag == "section" and not NAMES.intersection(x for w in node.whole for x in NAME.findall(w)):
        return False
    return node.linked > 0.5 * node.size or bool(node.whole & NAMES) and node.tag not in QUOTED


def prune(root: Node, nodes: list[Node]) -> None:
    """Mark what is not the article."""
    inside = set()  # articles and main elements that are no comment, and what is in them
    holds = set()  # elements around an article or main element that is no comment
    talk, best = set(), set()  # what lies in comments, and in any article or main element
    for node in nodes:
        if node.names & COMMENTS or node.parent in talk:
            talk.add(node)
        if node.tag in BEST or node.parent in best:
            best.add(node)
        if (node.tag in BEST or node.role in BEST) and node not in talk:
            for around in node.upward():
                if around in holds:
                    break
                holds.add(around)
            inside.add(node)
        elif node.parent in inside:
            inside.add(node)
    for node in nodes[1:]:  # by what an element is
        if node.parent.gone or node.hidden or node.tag in PRUNED or node.role in ROLES and not (node.tag in FORMS and node in holds):
            node.gone = True
        elif node.tag == "header":
            node.gone = node not in best
        elif node.names & COMMENTS and node.tag != "body":
            node.gone = node not in holds
    measure(nodes)
    for node in nodes[1:]:  # a form is a wrapper if it holds the article, or where there is none the title or nearly all text
        if node.parent.gone:
            node.gone = True
        elif not node.gone and node.tag in FORMS:
            wraps = node in holds if holds else node.titled or node.size >= 0.8 * root.size and node.prose
            node.gone = not wraps and not (node.parent.tag in FORMS and node.titled)
    measure(nodes)
    whole = max(1, root.size)
    for node in nodes[1:]:  # by what it is called, unless most of the page is in it
        if node.parent.gone:
            node.gone = True
        elif not node.gone and node.names & NAMES and node.tag != "body" and node not in holds:
            if node in inside:  # a part of a name says little there
                node.gone = node.tag not in TITLES and aside(node)
                continue
            most = 0.4 if node.names & GOOD else 0.6
            node.gone = node.size < most * whole or node.linked > 0.5 * node.size


def score(nodes: list[Node]) -> Node | None:
    """Pass the points of paragraphs to their ancestors; the best container."""
    measure(nodes)
    held: dict[int, Node] = {}
    for node in nodes:
        if node.gone or not node.size:
            continue
        own = "".join(c for c in node.children if isinstance(c, str))
        paragraph = node.tag in ("p", "pre", "blockquote", "td", "dd") or node.tag in ("div", "section", "article", "main", "body", "li") and length(own) > 25
        if not paragraph:
            continue
        points = (1 + node.commas + min(node.size / 100, 3)) * (1 - node.linked / node.size)
        takes = (node.parent or node).upward() if node.tag in ("p", "pre", "td", "blockquote", "dd", "li") else node.upward()
        for level, above in enumerate(takes):
            if above.tag == "html" or level > 6:
                break
            if id(above) not in held:
                held[id(above)] = above
                above.points = {"article": 25.0, "main": 20.0, "div": 5.0, "section": 5.0, "ul": -3.0, "ol": -3.0, "table": -3.0}.get(above.tag, 0.0) + 10.0 * bool(above.names & GOOD)
            above.points += points / (1 if level == 0 else level + 1)
    for node in held.values():
        node.points *= 1 - node.linked / max(1, node.size)
    return max(held.values(), key=lambda n: n.points, default=None)


def kept(root: Node, nodes: list[Node]) -> list[Node]:
    """The best container and its siblings that belong to it, in page order."""
    best = score(nodes)
    if best is None:
        return [root]
    around = [n for n in best.upward() if n.tag in BEST or n.role == "main"]
    articles = [n for n in around if n.tag == "article"]
    best = articles[-1] if articles else around[-1] if around else best
    if best.parent is None or best.tag == "body":
        return [best]
    if best.tag == "main" or best.role == "main":
        return [best]
    limit, out = max(10.0, 0.2 * best.points), []
    for other in best.parent.children:
        if other is best:
            out.append(other)
        elif isinstance(other, Node) and not other.gone and other.size:
            density = other.linked / other.size
            same = 0.2 * best.points if best.names and other.names == best.names else 0.0
            title = other.titled and not best.titled
            part = other.tag == best.tag and other.names == best.names and other.prose and not density
            if other.points + same >= limit and density < 0.5 or title or part or other.tag == "p" and (other.size > 80 and density < 0.25 or not density and other.size > 0):
                out.append(other)
    return out


def text_of(roots: list[Node], line: str = "\n") -> str:
    """Text of the blocks below these elements."""
    blocks: list[list[str]] = [[]]
    stack: list[Node | str | None] = list(reversed(roots))
    while stack:
        item = stack.pop()
        if item is None:  # a block begins or ends
            if blocks[-1]:
                blocks.append([])
        elif isinstance(item, str):
            blocks[-1].append(unescape(item) if "&" in item else item)
        elif item.gone:
            continue
        elif item.tag == "br":
            blocks[-1].append(" ")
        else:
            block = item.tag in BLOCK
            if block:
                stack.append(None)
            stack.extend(reversed(item.children))
            if block:
                stack.append(None)
    lines = (" ".join("".join(b).split()) for b in blocks)
    return (line or " ").join(x for x in lines if x)


def extract(html: str) -> str:
    """The main text of a page."""
    root, nodes = parse(html)
    prune(root, nodes)
    return text_of(kept(root, nodes))


def extract_pages(pages: DataFrame, *carry: str) -> DataFrame:
    """``carry``, text and n_chars of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(h.as_py() or "") for h in batch.column("html")]
            columns = [*(batch.column(c) for c in carry), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*carry, "text", "n_chars"])

    schema = StructType([*[pages.schema[c] for c in carry], StructField("text", StringType()), StructField("n_chars", LongType())])
    return pages.select(*carry, "html").mapInArrow(run, schema)
