"""Main text of web pages by site template removal.

Every page is parsed into a tree.  Spark counts, for each host, on how many different pages a subtree recurs; a subtree
found on many pages of its host is template and is deleted first, on every page.  Each subtree has two hashes: of its
tags and its text, and of its shape alone (tags and labels, links and plain text, like neighbours as one, words left
out), since menus, adverts and footers keep their shape where their words differ.  All elements that can show text are
counted, whatever their tag or label says.  A shape is counted only outside the article, and only where the text is
links or short; on a page without an article mark only for lists of links, as short paragraphs share their shape.
Inside articles, pages of a host quote one another, so there only what most of the different articles of a host hold is
template.  What shows no recurrence, as on a small host, goes by tag, role, class or id (navigation, forms, adverts,
notices, reader comments and so on).  A class or id name counts by its last word, plain words for a container aside, and
never for an element that holds most of the text of its page, unless its whole name says advert or comment.

The text is that of the article elements if there are any, else of ``main``, else of the body.  Character references
are decoded, white space inside a block becomes one space, and blocks are joined by one space in page order.  Time and
memory are linear in the length of a page, however deep or broken it is.

Defined results: null and empty html give an empty text; a page cut off inside a tag, an element or a reference is read
as far as it goes; a null url or a url without a host counts under the host ''; copies of a page count once for their
host, and copies of an article once for what is inside it; repeated rows give repeated rows; an empty table gives an
empty result; other columns are never read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonelens.llm.common import column, pick, ship, stage

# A subtree outside the article is template from this many different pages of a host on, and this share of them; the
# share is for small hosts only, as from MANY_PAGES on a subtree is template however large its host is.
MIN_PAGES = 5
MIN_SHARE = 0.2
MANY_PAGES = 30
# Inside the article: from this many different articles of a host on, and this share of them.  A quoted sentence recurs
# as well, but not in most articles.
MIN_ARTICLES = 30
ARTICLE_SHARE = 0.5

# Outside an article, a shape counts for subtrees of at most so many characters, or of which half is links.
SHORT = 400
# On a page without an article mark it counts for subtrees of so many links and more that are links by this share.
LIST_LINKS = 3
LIST_SHARE = 0.8
# Template rows of at most so many bytes (a hash, a kind and the host's name each) are broadcast.
MOST_SENT = 4 << 20
# Kinds of template rows.
OUTER, SHAPE, INNER = 0, 1, 2

# Element names by what they mean for the text of a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td "
    "tfoot th thead title tr ul".split()
)
NO_TEXT = frozenset(
    "nav header footer aside form script style noscript template iframe svg canvas button select option textarea input object embed audio "
    "video map dialog menu head title xmp noembed noframes".split()
)
# Elements without article text that show text all the same; what the others hold is never shown as text.
SHOWN = frozenset("nav header footer aside form dialog menu button".split())
UNSEEN = NO_TEXT - SHOWN
# Elements that end an open paragraph.
ENDS_P = BLOCK - {"br", "button", "option", "optgroup", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "html", "head", "title"}
# An opening tag of the key closes an open element of the value, unless one of the stops lies between.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
LABELS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar menu nav navbar navigation breadcrumb "
    "breadcrumbs footer header masthead cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription "
    "signup social share sharing related recommended teaser comment comments commentlist disqus reply replies respond pagination pager toolbar "
    "widget skip login search".split()
)
# Words for a container, which leave the name before them what it is: ad-box, related-posts, footer-wrapper-left.
CONTAINER = frozenset(
    "area bar block box button buttons card column container content group holder icons inner item items left links list outer panel posts right "
    "row section slot stories unit wrap wrapper zone".split()
)
# A name with one of these says nothing of the element itself.
RELATION = frozenset("no non has with without less after before".split())
# Whole names that mean what they say however much of a page stands below them.
PLAIN_LABELS = frozenset({"ad", "ads", "advert", "advertisement", "comment", "comments", "commentlist", "disqus", "replies"})
# Inline elements that are plain text in a shape.
INLINE = frozenset("abbr b br cite code em font i mark q s small span strong sub sup time u".split())
# What a heading line of the article itself may be called.
OWN_LABELS = frozenset({"header", "banner", "masthead", "alert", "notice"})
NEVER = frozenset({"html", "body", "main"})
# Labels that make an article element something else than the article of the page.
ARTICLE_LABELS = frozenset({"comment", "comments", "reply", "teaser", "related", "ad", "advert", "advertisement", "promo", "sponsored"})

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*(?:>|\Z))",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
NAMED = {"class", "id", "role", "hidden", "style", "aria-hidden"}
LABEL_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
DIGITS = re.compile(r"\d+")
# What a non-block end tag does not reach beyond.
BARRIERS = frozenset({"article", "main", "body", "table"})
P_STOPS = frozenset({"td", "th", "li", "div", "article", "section", "main", "body", "blockquote", "button", "table"})


class Node:
    __slots__ = ("tag", "attributes", "kids", "digest", "shape", "own", "words", "size", "linked", "links", "gone")

    def __init__(self, tag: str, attributes: dict[str, str]) -> None:
        self.tag = tag
        self.attributes = attributes
        self.kids: list = []
        self.digest = self.shape = 0
        self.own = tag in ("article", "main")  # holds an article or main element, or is one
        self.words = False  # shows text
        self.size = self.linked = 0  # characters shown, and those of them in links
        self.links = 0
        self.gone = False  # template


def attributes_of(rest: str) -> dict[str, str]:
    if "=" not in rest and "hidden" not in rest:
        return {}
    found = {}
    for name, value in ATTRIBUTE.findall(rest.rstrip("/>")):
        name = name.lower()
        if name in NAMED:
            found.setdefault(name, html.unescape(value.strip("\"'")))
    return found


def parse(page: str) -> Node:
    """The tree of a page; unclosed elements end with their parent, and stray end tags are passed over."""
    root = Node("html", {})
    stack = [root]
    places: dict[str, list[int]] = {}  # depths of the open elements by name

    def close(depth: int) -> None:
        while len(stack) > depth:
            node = stack.pop()
            places[node.tag].pop()
            seal(node)
            stack[-1].own |= node.own

    def innermost(tags) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def close_open(tags, stops) -> None:
        k = innermost(tags)
        if k > innermost(stops - tags):
            close(k)

    at, size = 0, len(page)
    while at < size:
        found = TOKEN.search(page, at)
        if found is None:
            stack[-1].kids.append(page[at:])
            break
        if found.start() > at:
            stack[-1].kids.append(page[at : found.start()])
        at = found.end()
        name = found["name"]
        if name is None:
            if found[0].startswith("<![CDATA["):
                stack[-1].kids.append(html.escape(found[0][9:].removesuffix("]]>"), quote=False))
            continue
        name = name.lower()
        if found["end"]:
            if name == "p" or name == "br":
                stack[-1].kids.append(Node("br", {}))
            k = innermost((name,))
            if k and (name in BLOCK or k > innermost(BARRIERS)):
                close(k)
            continue
        if name in ("html", "body"):
            if name == "html":
                root.attributes = attributes_of(found["rest"])
                continue
            close(1)
        if name in ENDS_P:
            close_open({"p"}, P_STOPS)
        if name in SIBLINGS:
            close_open(*SIBLINGS[name])
        node = Node(name, attributes_of(found["rest"]))
        stack[-1].kids.append(node)
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            node.kids.append(page[at : end.start() if end else size])
            at = end.end() if end else size
            seal(node)
        elif name in VOID or found["rest"].endswith("/>") and name not in BLOCK:
            seal(node)
        else:
            places.setdefault(name, []).append(len(stack))
            stack.append(node)
    close(1)
    seal(root)
    return root


def seal(node: Node) -> None:
    """Both hashes of a subtree, white space aside, and what text it shows.

    The first takes tag, class, id and all that is inside.  The shape leaves out words, numbers in names, inline elements
    and what kind of link a link is, and takes equal neighbours as one.
    """
    name = f"{node.tag}|{node.attributes.get('class', '')}|{node.attributes.get('id', '')}|"
    state = xxhash.xxh64(name)
    shape, last = xxhash.xxh64(DIGITS.sub("", name), seed=1), None
    for kid in node.kids:
        if isinstance(kid, str):
            plain = " ".join(kid.split())
            state.update(plain.encode("utf-8", "surrogatepass") + b"\x00")
            if not plain:
                continue
            node.words = True
            node.size += len(plain)
            form = b"text"
        else:
            state.update(kid.digest.to_bytes(8, "little"))
            if not kid.words:
                continue
            node.words = True
            node.size += kid.size
            node.linked += kid.linked
            node.links += kid.links
            form = b"link" if kid.tag == "a" else b"text" if kid.tag in INLINE and not kid.links else kid.shape.to_bytes(8, "little")
        if form != last:
            shape.update(form)
            last = form
    if node.tag in UNSEEN:
        node.words, node.size, node.linked, node.links = False, 0, 0, 0
    elif node.tag == "a" and node.words:
        node.linked, node.links = node.size, 1
    node.digest, node.shape = state.intdigest(), shape.intdigest()


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def visible(node: Node) -> bool:
    style = node.attributes.get("style", "").replace(" ", "").lower()
    return not ("hidden" in node.attributes or "display:none" in style or "visibility:hidden" in style)


def labels_of(node: Node, most: int) -> set[str]:
    """What the class and id names call an element; ``most``: the most characters that a compound name can speak for.

    The last word of a name tells, words for a container after it aside: share-buttons is a label, share-price is none.
    """
    words: set[str] = set()
    for name in f"{node.attributes.get('class', '')} {node.attributes.get('id', '')}".split():
        parts = [w.lower() for w in LABEL_PARTS.findall(name)]
        while len(parts) > 1 and parts[-1] in CONTAINER:
            parts.pop()
        if not parts or not RELATION.isdisjoint(parts):
            continue
        if node.size <= most or name.lower() in PLAIN_LABELS:
            words.add(parts[-1])
    return words


def labelled(node: Node, inside: bool, most: int) -> bool:
    """Whether tag, role, class or id say that this is no article text; ``inside``: within an article.

    ``most`` is half of the characters of the page, or of the article within one.
    """
    tag = node.tag
    if tag in NEVER:
        return False
    if tag in NO_TEXT:
        # The heading of an article may stand in a header of its own.
        return not (inside and tag == "header")
    if not node.attributes:
        return False
    if not visible(node):
        return True
    if node.own and tag != "article":
        return False
    if node.attributes.get("role", "").lower() in ROLES:
        return True
    words = labels_of(node, most) & (ARTICLE_LABELS if tag == "article" else LABELS)
    if inside:
        words -= {"header", "masthead"}
        if tag in ("h1", "h2", "h3", "hgroup"):
            words -= OWN_LABELS
    return bool(words)


def outer_nodes(root: Node, roots: list[Node]) -> list[Node]:
    """The nodes that show text and stand outside the article of the page, labelled or not, and hold no part of it."""
    inside = {id(n) for n in roots if n is not root}
    nodes, above = [root], [-1]
    holders = {0}
    for i, node in enumerate(nodes):
        for kid in node.kids:
            if isinstance(kid, str) or not kid.words and not inside:
                continue
            if id(kid) in inside:
                k = i
                while k not in holders:
                    holders.add(k)
                    k = above[k]
            else:
                nodes.append(kid)
                above.append(i)
    return [n for i, n in enumerate(nodes) if n.words and i not in holders and n.tag not in NEVER]


def outer_subtrees(root: Node) -> list[int]:
    """Hashes of the subtrees outside the article."""
    return sorted({signed(n.digest) for n in outer_nodes(root, roots_of(root))})


def shaped(node: Node, marked: bool) -> bool:
    """Whether a subtree outside the article may go by its shape; ``marked``: the page has an article or main element."""
    if marked:
        return node.size <= SHORT or 2 * node.linked >= node.size
    return node.links >= LIST_LINKS and node.linked >= LIST_SHARE * node.size


def inner_subtrees(root: Node) -> list[int]:
    """Hashes of the subtrees that show text below a node, labelled or not."""
    found = set()
    waiting = [root]
    while waiting:
        for kid in waiting.pop().kids:
            if not isinstance(kid, str) and kid.words:
                found.add(signed(kid.digest))
                waiting.append(kid)
    return sorted(found)


def subtrees_of(page: str | None) -> tuple[list[int], list[int], list[list[int]]]:
    """Hashes outside the article; shapes there that may go; for each article its hash and those inside."""
    if not page:
        return [], [], []
    root = parse(page)
    roots = roots_of(root)
    marked = roots[0] is not root
    outside = outer_nodes(root, roots)
    articles = [[signed(r.digest), *inner_subtrees(r)] for r in roots] if marked else []
    shapes = {signed(n.shape) for n in outside if shaped(n, marked)}
    return sorted({signed(n.digest) for n in outside}), sorted(shapes), articles


def topmost(root: Node, wanted) -> list[Node]:
    """The nodes that are wanted and not below another such node or a labelled one, in page order."""
    found: list[Node] = []
    waiting, most = [root], root.size // 2
    while waiting:
        node = waiting.pop()
        if wanted(node):
            found.append(node)
            continue
        waiting += [k for k in reversed(node.kids) if not isinstance(k, str) and not labelled(k, False, most)]
    return found


def roots_of(root: Node) -> list[Node]:
    """The topmost article elements, else the main elements, else the whole page."""
    articles = topmost(root, lambda n: n.tag == "article")
    mains = articles or topmost(root, lambda n: n.tag == "main" or n.attributes.get("role", "").lower() == "main")
    return mains or [root]


def delete(root: Node, roots: list[Node], outer: frozenset[int]) -> None:
    """Mark what stands outside the article and is template by its hash or its shape."""
    marked = roots[0] is not root
    for node in outer_nodes(root, roots):
        node.gone = signed(node.digest) in outer or signed(node.shape) in outer and shaped(node, marked)


def text_of(roots: list[Node], inner: frozenset[int], inside: bool) -> str:
    """The text below the roots without template and labelled subtrees; ``inner``: template hashes inside articles."""
    parts: list[str] = []
    waiting: list = list(reversed(roots))
    most = sum(r.size for r in roots) // 2
    while waiting:
        item = waiting.pop()
        if isinstance(item, str):
            parts.append(item)
            continue
        if item.tag in BLOCK:
            parts.append(" ")
            waiting.append(" ")
        for kid in reversed(item.kids):
            if isinstance(kid, str):
                waiting.append(html.unescape(kid) if "&" in kid else kid)
            elif not kid.gone and not labelled(kid, inside, most) and signed(kid.digest) not in inner:
                waiting.append(kid)
    return " ".join("".join(parts).split())


def main_text(page: str | None, outer: frozenset[int] = frozenset(), inner: frozenset[int] = frozenset()) -> str:
    """The text of a page; ``outer`` and ``inner`` are the template hashes and shapes of this page."""
    if not page:
        return ""
    root = parse(page)
    roots = roots_of(root)
    inside = roots[0] is not root
    if outer:
        delete(root, roots, outer)
    return text_of(roots, inner if inside else frozenset(), inside)


def host_of(url: Column) -> Column:
    """Lower-case host of a url, without user and port; '' if there is none."""
    host = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.coalesce(host, F.lit(""))


SUBTREES = "outer array<long>, shapes array<long>, articles array<array<long>>"


def subtrees(pages: DataFrame) -> DataFrame:
    """host, page (hash of the html) and the subtrees (:func:`subtrees_of`) of every different page; ``pages`` has host and html."""
    ship(pages.sparkSession)

    @F.pandas_udf(SUBTREES)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([subtrees_of(t) for t in texts], columns=["outer", "shapes", "articles"])

    parsed = pages.select("host", F.xxhash64("html").alias("page"), found("html").alias("found"))
    return stage(parsed.groupBy("host", "page").agg(F.first("found").alias("found")).select("host", "page", "found.*"), "html-subtrees")


def tagged(kind: int, hashes: Column) -> Column:
    return F.transform(hashes, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("subtree")))


def recurring(units: DataFrame, sizes: DataFrame, least: int, share: float, many: int | None = None) -> DataFrame:
    """kind, host, subtree: what stands in ``many`` of the units of its host, or in ``least`` and a share of them.

    ``units`` has a row for each subtree of each unit, ``sizes`` the number of units of each host.
    """
    counted = units.groupBy("kind", "host", "subtree").agg(F.count("*").alias("n"))
    often = counted.filter(F.col("n") >= least).join(sizes, "host")
    wanted = F.col("units") * share if many is None else F.least(F.col("units") * share, F.lit(many))
    return often.filter(F.col("n") >= wanted).select("kind", "host", "subtree")


def template_rows(once: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """kind, host, subtree: template hashes and shapes outside of articles, and hashes inside; ``once`` as of :func:`subtrees`.

    Copies of a page are one page here, so a page copied many times is no template, and copies of an article are one.
    """
    sizes = once.groupBy("host").agg(F.count("*").alias("units"))
    outside = once.select("host", F.inline(F.concat(tagged(OUTER, F.col("outer")), tagged(SHAPE, F.col("shapes")))))
    outer = recurring(outside, sizes, min_pages, min_share, MANY_PAGES)
    articles = once.select("host", F.explode("articles").alias("hashes"))
    articles = articles.groupBy("host", F.col("hashes")[0].alias("article")).agg(F.first("hashes").alias("hashes"))
    sizes = articles.groupBy("host").agg(F.count("*").alias("units"))
    inner = articles.select("host", F.inline(tagged(INNER, F.slice("hashes", F.lit(2), F.size("hashes")))))
    return outer.unionByName(recurring(inner, sizes, MIN_ARTICLES, ARTICLE_SHARE))


def templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """host, template: the template hashes outside articles of every host that has any, as one array to look at."""
    rows = template_rows(subtrees(pages), min_pages, min_share)
    return rows.filter(F.col("kind") == OUTER).groupBy("host").agg(F.collect_list("subtree").alias("template"))


def marks(once: DataFrame, rows: DataFrame) -> DataFrame:
    """host, page, outer, inner: the subtrees of a page that are template, for every page that has any.

    No host's whole template set is ever held in one row; a page's arrays are no longer than the page.
    """
    inside = F.flatten(F.transform("articles", lambda a: F.slice(a, F.lit(2), F.size(a))))
    all_three = F.concat(tagged(OUTER, F.col("outer")), tagged(SHAPE, F.col("shapes")), tagged(INNER, F.array_distinct(inside)))
    own = once.select("host", "page", F.inline(all_three))
    hits = own.join(rows, ["kind", "host", "subtree"])

    def gathered(wanted: Column) -> Column:
        return F.collect_list(F.when(wanted, F.col("subtree")))

    return hits.groupBy("host", "page").agg(
        gathered(F.col("kind") != INNER).alias("outer"), gathered(F.col("kind") == INNER).alias("inner")
    )


def by_host(rows: DataFrame) -> dict[str, tuple[list[int], list[int]]]:
    """The template rows of every host, outer and inner; for row sets of a checked size."""
    found: dict[str, tuple[list[int], list[int]]] = {}
    for kind, host, subtree in zip(*(c.to_pylist() for c in rows.toArrow().columns), strict=True):
        found.setdefault(host, ([], []))[kind == INNER].append(subtree)
    return found


def extract(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html", min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE,
    most_sent: int = MOST_SENT,
) -> DataFrame:
    """page_id, url, text for every page.

    Template rows of at most ``most_sent`` bytes are broadcast, so that no html is shuffled; more of them are joined to
    the subtrees of each page, and the pages to what was found.  Both ways give the same texts.
    """
    narrow = pick(pages, page_id=page_id, url=url, html=page)
    narrow = narrow.select("page_id", "url", F.col("html").cast("string").alias("html"), host_of(F.col("url").cast("string")).alias("host"))
    once = subtrees(narrow.select("host", "html"))
    rows = stage(template_rows(once, min_pages, min_share), "html-templates")
    out = [column("page_id").alias(page_id), column("url").alias(url)]
    if (rows.agg(F.sum(F.octet_length("host") + 9)).first()[0] or 0) <= most_sent:
        shared = pages.sparkSession.sparkContext.broadcast(by_host(rows))

        @F.pandas_udf("string")
        def text_here(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            sets = {host: (frozenset(outer), frozenset(inner)) for host, (outer, inner) in shared.value.items()}
            for htmls, hosts in batches:
                yield pd.Series([main_text(h, *sets.get(host, ())) for h, host in zip(htmls, hosts, strict=True)], dtype=object)

        return narrow.select(*out, text_here("html", "host").alias("text"))
    found = stage(marks(once, rows), "html-marks")

    def known(hashes) -> frozenset[int]:
        return frozenset(hashes) if hashes is not None else frozenset()

    @F.pandas_udf("string")
    def text(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for htmls, outer, inner in batches:
            yield pd.Series([main_text(h, known(o), known(i)) for h, o, i in zip(htmls, outer, inner, strict=True)], dtype=object)

    joined = narrow.withColumn("page", F.xxhash64("html")).join(found, ["host", "page"], "left")
    return joined.select(*out, text("html", "outer", "inner").alias("text"))
