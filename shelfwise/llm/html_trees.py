"""A small HTML reader: pages to trees of nodes."""

import re
from html import unescape

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rb rp rt s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
_PARAGRAPH_ENDS = frozenset(
    "address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
#: A start tag closes an open element of these, unless one of the bounds stands between.
_CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("table", "tr")),
    "th": (("td", "th"), ("table", "tr")),
    "tbody": (("thead", "tbody", "tr", "td", "th"), ("table",)),
    "tfoot": (("thead", "tbody", "tr", "td", "th"), ("table",)),
    "option": (("option",), ("select",)),
    "body": (("head",), ()),
} | {tag: (("p",), ("article", "aside", "blockquote", "div", "section", "td", "th", "table", "body")) for tag in _PARAGRAPH_ENDS}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_RAW_ENDS = {tag: re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I) for tag in RAW}


class Node:
    """An element: tag, attributes as text, and its parts, which are nodes and strings. ``size`` is
    the characters of text in it, ``linked`` those of them in links, ``links`` the links."""

    __slots__ = ("tag", "attrs", "parts", "size", "linked", "links")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs, self.parts = tag, attrs, []
        self.size = self.linked = self.links = 0

    def attribute(self, name: str) -> str | None:
        for key, *values in _ATTRIBUTE.findall(self.attrs) if self.attrs else ():
            if key.lower() == name:
                return unescape(next((v for v in values if v), ""))
        return None


def parse(html: str) -> Node:
    """The tree below a root that stands for the page. Comments go, character references are
    decoded, missing end tags are supplied where a following start tag implies them."""
    root = Node("#page")
    stack, at, made = [root], 0, []
    end = len(html)
    while at < end:
        found = _TOKEN.search(html, at)
        if found is None:
            stack[-1].parts.append(unescape(html[at:]))
            break
        if found.start() > at:
            stack[-1].parts.append(unescape(html[at : found.start()]))
        at = found.end()
        tag = found["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if found["end"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        closes, bounds = _CLOSES.get(tag, ((), ()))
        if closes:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in closes:
                    del stack[k:]
                    if tag not in ("tr", "tbody", "tfoot"):
                        break
                elif stack[k].tag in bounds:
                    break
        attrs = found["attrs"].strip()
        node = Node(tag, attrs.removesuffix("/"))
        stack[-1].parts.append(node)
        made.append((node, stack[-1]))
        if tag in RAW:
            close = _RAW_ENDS[tag].search(html, at)
            node.parts.append(html[at : close.start() if close else end])
            at = close.end() if close else end
        elif tag not in VOID:
            stack.append(node)
    # Children were made after their parents.
    for node, parent in reversed([(root, None), *made]):
        node.size += sum(len(p.strip()) for p in node.parts if isinstance(p, str))
        if parent is not None:
            parent.size += node.size
            parent.linked += node.size if node.tag == "a" else node.linked
            parent.links += node.links + (node.tag == "a")
    return root


def squeezed(text: str) -> str:
    """White space as single spaces, none at the ends."""
    return " ".join(text.split())
