"""Main text of web pages by wrapper induction over the pages of each host."""

import json
import re
import zlib

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.html_trees import INLINE, Node, parse, squeezed
from shelfwise.llm.url_filter import host_of
from shelfwise.llm.words import pieces
from shelfwise.session import staged

#: Pages of a host that must show a node with the same text before it counts as template.
SUPPORT = 8
#: Partial wrappers of one host meet in this many groups before they meet in one.
SALTS = 32
MENU_LINKS, MENU_SHARE = 3, 0.8
#: More neighbours of one label than this are a list.
LONG_RUN = 8
#: A node with more children than this shows one list for each label, whatever their order.
WIDE = 64
#: Nodes of more children in a wrapper are aligned by their equal labels alone, not pair by pair.
MANY = 4 * WIDE
DEPTH = 100

_SKIPPED = frozenset(
    "head script style noscript template iframe object embed svg canvas audio video nav footer aside form button "
    "select textarea input dialog menu title".split()
)
_ROLES = frozenset("navigation banner complementary contentinfo search form dialog alert menu menubar".split())
_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|sidebar|comments?|commentlist|disqus|replies|"
    r"cookies?|consent|gdpr|notice|notification|popup|modal|overlay|newsletter|subscribe|subscription|share|sharing|"
    r"social|related|recommended|breadcrumbs?|menu|nav|navbar|navigation|pagination|pager|footer|masthead|topbar|"
    r"toolbar|widget|signup|login)(?:$|[\s_-])",
    re.I,
)
#: Words that say nothing by themselves beside one of these names: "share-buttons", but not "share-price".
_NEUTRAL = frozenset(
    "area bar block bottom box button buttons container form inner item items left link links list main outer panel "
    "right row section slot text top unit wrap wrapper".split()
)
_PARTS = re.compile(r"[-_]+")
_HIDDEN = frozenset(("head", "script", "style"))
_SECTIONS = ("ul", "ol", "div", "section", "table", "dl")


def _is_name(token: str) -> bool:
    parts = [part for part in _PARTS.split(token) if part and not part.isdigit()]
    named = [bool(_NAMES.fullmatch(part)) for part in parts]
    return any(named) and all(n or part.lower() in _NEUTRAL for n, part in zip(named, parts))


def is_boilerplate(node: Node, in_article: bool) -> bool:
    """Whether the element's tag, role or name says that it is no part of an article.

    Around an article one word of a name is enough; within it every word has to agree.
    """
    if node.tag in _SKIPPED or (node.tag == "header" and not in_article):
        return True
    if not node.attrs or node.tag in ("html", "body", "article", "main"):
        return False
    if node.attribute("hidden") is not None or node.attribute("aria-hidden") == "true":
        return True
    if (node.attribute("role") or "").lower() in _ROLES:
        return True
    names = f"{node.attribute('class') or ''} {node.attribute('id') or ''}"
    return any(map(_is_name, names.split())) if in_article else bool(_NAMES.search(names))


def content_roots(page: Node) -> list[Node]:
    """The main elements outside of boilerplate; else the outermost articles there; else the page."""
    mains, articles = [], []
    stack = [page]
    while stack:
        node = stack.pop()
        if node.tag in ("main", "article"):
            (mains if node.tag == "main" else articles).append(node)
            if node.tag == "main" or mains:
                continue
        inner = [p for p in node.parts if not isinstance(p, str) and not is_boilerplate(p, node.tag == "article")]
        stack += reversed(inner)
    inside = set()
    stack = [p for a in articles for p in a.parts if not isinstance(p, str)] if len(articles) > 1 and not mains else []
    while stack:
        node = stack.pop()
        inside.add(id(node))
        stack += [p for p in node.parts if not isinstance(p, str)]
    return mains or [a for a in articles if id(a) not in inside] or [page]


def _holds_article(node: Node) -> bool:
    stack = [node]
    while stack:
        for part in stack.pop().parts:
            if not isinstance(part, str):
                if part.tag == "article":
                    return True
                stack.append(part)
    return False


# A wrapper is a tree of lists: label, pages, hash of the own text (None if it varies), children.

LABEL, PAGES, TEXT, CHILDREN = range(4)


_NUMBER = re.compile(r"\d+")


def label(node: Node) -> str:
    """Tag and class; numbers in a class, which often name the page, are all alike."""
    return f"{node.tag}.{_NUMBER.sub('0', squeezed(node.attribute('class') or ''))}" if node.attrs else node.tag


def _own_text(node: Node) -> int:
    """A hash of the text outside of blocks in the node, 0 for none."""
    own, stack = [], [iter(node.parts)]
    while stack:
        part = next(stack[-1], None)
        if part is None:
            stack.pop()
        elif isinstance(part, str):
            own.append(part)
        elif part.tag in INLINE:
            stack.append(iter(part.parts))
    text = squeezed(" ".join(own))
    return xxhash.xxh32_intdigest(text) if text else 0


def _run_text(texts: list):
    """The hash of a list's texts; a single node's own."""
    return texts[0] if len(texts) == 1 else xxhash.xxh32_intdigest(str(texts))


def _children(node: Node) -> list[Node]:
    """The elements below a node that a wrapper shows."""
    return [p for p in node.parts if not isinstance(p, str) and p.tag not in INLINE and p.tag not in _HIDDEN]


def _groups(node: Node) -> list[tuple[str, list[Node]]]:
    """Children by label. Neighbours of one label fold into a list if they hold no further elements,
    or if they are many. Of more than ``WIDE`` children all of one label, else of one tag, are a list."""
    runs: list[tuple[str, list[Node]]] = []
    children = _children(node)
    if len(children) > WIDE:
        for name in (label, lambda child: child.tag, lambda child: "*"):
            lists: dict[str, list[Node]] = {}
            for child in children:
                lists.setdefault(name(child), []).append(child)
            if len(lists) <= WIDE:
                return list(lists.items())
    for child in children:
        name = label(child)
        if runs and runs[-1][0] == name:
            runs[-1][1].append(child)
        else:
            runs.append((name, [child]))
    out = []
    for name, run in runs:
        fold = len(run) > LONG_RUN or not any(map(_children, run))
        out += [(name, run)] if fold else [(name, [child]) for child in run]
    return out


def _similarity(a: list, b: list) -> tuple[int, list]:
    """Simple tree matching: the most node pairs that keep order and depth, and which children meet.

    A pair with the same text counts twice, so that of alike siblings the constant ones meet.
    """
    if a[LABEL] != b[LABEL]:
        return 0, []
    x, y = a[CHILDREN], b[CHILDREN]
    own = 2 if a[TEXT] and a[TEXT] == b[TEXT] else 1
    if [c[LABEL] for c in x] == [c[LABEL] for c in y] and len({c[LABEL] for c in x}) == len(x):
        return own + sum(_similarity(c, d)[0] for c, d in zip(x, y)), [(k, k) for k in range(len(x))]
    if len(x) > MANY or len(y) > MANY:
        score, met = _aligned(x, y)
        return own + score, met
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    pair = [[_similarity(c, d)[0] for d in y] for c in x]
    for i in range(1, len(x) + 1):
        for j in range(1, len(y) + 1):
            best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + pair[i - 1][j - 1])
    met, i, j = [], len(x), len(y)
    while i and j:
        if pair[i - 1][j - 1] and best[i][j] == best[i - 1][j - 1] + pair[i - 1][j - 1]:
            met.append((i - 1, j - 1))
            i, j = i - 1, j - 1
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return best[-1][-1] + own, met[::-1]


def _aligned(x: list, y: list) -> tuple[int, list]:
    """As the table of ``_similarity``, for many children: only pairs of one label are looked at, by row,
    and a tree of maxima has the best chain that ends left of a column."""
    places: dict[str, list[int]] = {}
    for j, d in enumerate(y):
        places.setdefault(d[LABEL], []).append(j)
    nothing = (0, -1)
    tree = [nothing] * (len(y) + 1)
    chains: list[tuple[int, int, int]] = []  # row, column, the chain before
    for i, c in enumerate(x):
        for j in reversed(places.get(c[LABEL], ())):
            before, k = nothing, j
            while k > 0:
                before = max(before, tree[k])
                k &= k - 1
            chain = (before[0] + _similarity(c, y[j])[0], len(chains))
            chains.append((i, j, before[1]))
            k = j + 1
            while k < len(tree):
                tree[k] = max(tree[k], chain)
                k += k & -k
    best, k = nothing, len(y)
    while k > 0:
        best = max(best, tree[k])
        k &= k - 1
    met, at = [], best[1]
    while at >= 0:
        i, j, at = chains[at]
        met.append((i, j))
    return best[0], met[::-1]


def merged(a: list, b: list, wide: list | None = None) -> list:
    """The wrapper of both: aligned nodes become one, the others stay as optional ones, however many they
    are. ``wide`` gets a mark for each node that both share and that has more than ``MANY`` children."""
    _, met = _similarity(a, b)
    children, i, j = [], 0, 0
    for p, q in [*met, (len(a[CHILDREN]), len(b[CHILDREN]))]:
        children += a[CHILDREN][i:p] + b[CHILDREN][j:q]
        if p < len(a[CHILDREN]) and q < len(b[CHILDREN]):
            children.append(merged(a[CHILDREN][p], b[CHILDREN][q], wide))
        i, j = p + 1, q + 1
    if wide is not None and len(children) > MANY:
        wide.append(len(children))
    return [a[LABEL], a[PAGES] + b[PAGES], a[TEXT] if a[TEXT] == b[TEXT] else None, children]


class Merger:
    """One wrapper of those that are added one after the other.

    A wrapper that has become wide is put aside and a new one begun; of those put aside the ones of
    like page counts are merged, so that no page is compared with all the others' optional nodes.
    """

    def __init__(self):
        self._aside: list[list] = []
        self._open: list | None = None

    def add(self, wrapper: list) -> None:
        wide: list[int] = []
        whole = wrapper if self._open is None else merged(self._open, wrapper, wide)
        self._open = whole
        if wide:
            self._put_aside()

    def _put_aside(self) -> None:
        whole, self._open = self._open, None
        while self._aside and self._aside[-1][PAGES] < 2 * whole[PAGES]:
            whole = merged(self._aside.pop(), whole)
        self._aside.append(whole)

    def whole(self) -> list:
        parts = [*self._aside, *([] if self._open is None else [self._open])]
        whole = parts.pop()
        while parts:
            whole = merged(parts.pop(), whole)
        return whole


def wrapper_of(node: Node, depth: int = 0) -> list:
    """A page's tree as a wrapper. What lies deeper than ``DEPTH`` is not told apart."""
    children = []
    for _, run in _groups(node) if depth < DEPTH else ():
        parts = [wrapper_of(child, depth + 1) for child in run]
        whole = parts[0]
        for part in parts[1:]:
            whole = merged(whole, part)
        whole[PAGES], whole[TEXT] = 1, _run_text([part[TEXT] for part in parts])
        children.append(whole)
    return [label(node), 1, _own_text(node), children]


def _packed(wrapper: list) -> bytes:
    return zlib.compress(json.dumps(wrapper, separators=(",", ":")).encode())


def _unpacked(body: bytes) -> list:
    return json.loads(zlib.decompress(body))


def _induce(batches):
    """The wrapper of each host's pages in this task."""
    wrappers: dict[str, Merger] = {}
    for batch in batches:
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            wrappers.setdefault(host, Merger()).add(wrapper_of(parse(html)))
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(wrappers), pa.string()), pa.array([_packed(w.whole()) for w in wrappers.values()], pa.binary())],
        names=["host", "wrapper"],
    )


def _join(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    wrappers = Merger()
    for body in sorted(table.column("wrapper").to_pylist()):
        wrappers.add(_unpacked(body))
    return pa.table({"host": [key[0].as_py()], "wrapper": pa.array([_packed(wrappers.whole())], pa.binary())})


def _template_nodes(node: Node, wrapper: list, found: set) -> None:
    """Collect the page's nodes that align with constant nodes of the wrapper."""
    if not wrapper[CHILDREN]:
        return
    groups = _groups(node)
    texts = [_run_text(list(map(_own_text, run))) for _, run in groups]
    below = [
        [name, 1, text, [[inner, 1, _run_text(list(map(_own_text, part))), []] for inner, part in _groups(run[0])]]
        for (name, run), text in zip(groups, texts)
    ]
    for i, j in _similarity([wrapper[LABEL], 1, 0, below], wrapper)[1]:
        child, run = wrapper[CHILDREN][j], groups[i][1]
        if child[TEXT] and child[PAGES] >= SUPPORT and texts[i] == child[TEXT]:
            found.update(map(id, run))
        for part in run:
            _template_nodes(part, child, found)


def blocks(root: Node, template: set) -> list[str]:
    """Texts of the blocks in page order, without boilerplate, menus and template nodes.

    Lists of links are menus around an article, and references within one. A main element that holds
    no article is one itself.
    """
    out, line = [], []

    def flush():
        text = squeezed("".join(line))
        line.clear()
        if text:
            out.append(text)

    def is_menu(node: Node) -> bool:
        if node.tag not in _SECTIONS:
            return False
        return node.links >= MENU_LINKS and node.linked >= MENU_SHARE * node.size

    stack: list = [iter(root.parts)]
    open_blocks = [False]
    within = [root.tag == "article" or (root.tag == "main" and not _holds_article(root))]
    while stack:
        part = next(stack[-1], None)
        if part is None:
            stack.pop()
            within.pop()
            if open_blocks.pop():
                flush()
        elif isinstance(part, str):
            line.append(part)
        elif part.tag in ("br", "wbr"):
            line.append(" ")
        elif is_boilerplate(part, within[-1]) or id(part) in template or (not within[-1] and is_menu(part)):
            if part.tag not in INLINE:
                flush()
        else:
            block = part.tag not in INLINE
            if block:
                flush()
            stack.append(iter(part.parts))
            within.append(within[-1] or part.tag == "article")
            open_blocks.append(block)
    flush()
    return out


def extract(html: str, wrapper: list | None) -> str:
    """The article's text. Template nodes are left out unless they hold most of the text: then the
    host's pages are copies of each other, and constancy says nothing."""
    page = parse(html)
    roots = content_roots(page)
    everything = [text for root in roots for text in blocks(root, set())]
    if wrapper is None or wrapper[PAGES] < SUPPORT:
        return "\n".join(everything)
    template: set = set()
    _template_nodes(page, wrapper, template)
    varying = [text for root in roots for text in blocks(root, template)] if template else everything
    enough = 2 * sum(map(len, varying)) >= sum(map(len, everything))
    return "\n".join(varying if enough else everything)


def _extract(batches):
    wrappers: dict = {}
    for batch in batches:
        for piece in pieces(batch, "html"):
            texts = []
            for html, body in zip(piece.column("html").to_pylist(), piece.column("wrapper").to_pylist()):
                if body not in wrappers:
                    if len(wrappers) >= 256:
                        wrappers.clear()
                    wrappers[body] = _unpacked(body) if body else None
                texts.append(extract(html or "", wrappers[body]))
            yield pa.RecordBatch.from_arrays([piece.column("rest"), pa.array(texts, pa.string())], names=["rest", "text"])


def induce_wrappers(pages: DataFrame) -> DataFrame:
    """One wrapper per host of the columns host and html. Equal pages of a host become one first, by
    their hash, so that counts are of distinct pages however the rows are dealt out. Tasks merge what
    they have of a host, a few groups merge what the tasks have, and one merges these."""
    filled = pages.where("html <> ''")
    distinct = filled.groupBy("host", F.xxhash64("html").alias("mark")).agg(F.first("html").alias("html"))
    parts = distinct.select("host", "html").mapInArrow(_induce, "host string, wrapper binary")
    salt = F.pmod(F.xxhash64("wrapper"), F.lit(SALTS))
    few = parts.groupBy("host", salt.alias("salt")).applyInArrow(_join, "host string, wrapper binary")
    return few.groupBy("host").applyInArrow(_join, "host string, wrapper binary")


def extract_pages(pages: DataFrame) -> DataFrame:
    """``pages`` without html, with ``text``: the article's blocks, one a line.

    The trees of a host's pages are aligned by simple tree matching and merged into its wrapper.
    Nodes that show one text on at least ``SUPPORT`` pages are template, other text is content. What
    tags, roles and names mark as navigation, header, footer, sidebar, notice, advert, form or
    comments is none of it, nor are lists of links around the article. The main elements bound the content
    if there are any, else the articles. Character references are decoded, white space in a block becomes one space.

    Null or empty html: an empty text. Null URL: the host is empty. Repeated rows are extracted row
    by row and count once in the wrapper. Columns of the input named like an added one are
    replaced. An empty table gives an empty table. Each page is used whole, whatever its length.
    """
    given = [c for c in pages.columns if c != "html"]
    read = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in given]).alias("rest"),
        host_of("url").alias("host"), F.col("html").cast("string").alias("html"),
    )
    # Written, so that the size is known: few wrappers are broadcast, many are joined by host.
    wrappers = staged(induce_wrappers(read.select("host", "html")), "wrappers")
    rest = read.schema["rest"].dataType.simpleString()
    joined = read.join(wrappers, "host", "left").select("rest", "html", "wrapper")
    texts = joined.mapInArrow(_extract, f"rest {rest}, text string")
    return texts.select(*[F.col("rest").getField(c).alias(c) for c in given if c != "text"], "text")
