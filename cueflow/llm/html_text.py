"""Main text of web pages by consensus paths of their hosts.

Each page's containers are scored by the plain text that stands directly in
them. A page votes, with that score, for the generalised tag-class path of its
main container: the article or main element around the best container, else the
least container that holds all dense ones. Votes are added up for each host in
Spark; the path with most votes wins, raised to one around it that has at least
a tenth of the host's votes; then every page is read again along its host's
winning path. A page that lacks the path, or whose url names no host, uses its
own main container. Elements of any kind count as noise by tag, role, class or
id, or where they are hidden.

Null html and html without text give an empty text. Pages that repeat are
extracted each by itself; an empty table gives an empty result; ties between
paths go to the lesser path. Other columns stay, also such with the result's
names. Tags, attributes and nesting have no limit; work is linear in the page.
"""

from __future__ import annotations

import html as entities
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, small_batches, stash, text_of

#: Winning paths are broadcast up to this many estimated bytes, else joined by host with a shuffle.
BROADCAST_BYTES = 16 << 20

#: A container is dense if it holds at least this share of the text of the best one, and this many characters.
DENSE_SHARE, DENSE_CHARS = 0.04, 40
#: Share of a host's votes that raises its path to one around it.
RAISE_SHARE = 0.1

# Fixed values of HTML: elements by their role.
RAW = frozenset("script style noscript template textarea title iframe svg annotation annotation-xml".split())
VOID = frozenset("br hr img input meta link area base col embed source track wbr param".split())
CONTAINERS = frozenset("html body div main article section center td table form nav header footer aside menu dialog fieldset blockquote figure details".split())
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd pre address figcaption summary thead tbody tfoot tr th caption option legend hr".split())
NOISE_TAGS = frozenset("nav header footer aside menu dialog form fieldset button select option label object canvas audio video head".split())
_RELATED = r"related(?:-(?:posts?|articles?|links?|stories|content|news|items|products|pages|reading|topics))?(?=$| )"
_STRONG = (
    r"ads?|advert\w*|sponsor\w*|promo\w*|sidebar|side-?bar|menu|nav|navbar|navigation|breadcrumbs?|cookies?|consent|gdpr|popup|modal|overlay|"
    r"subscribe|newsletter|signup|login|share|sharing|social|recommend\w*|comments?|disqus|replies|respond|pager|pagination|toolbar|skip|" + _RELATED
)
#: Names of noise in classes and ids of any element, and those that count in containers and lists only.
NOISE_WORDS = re.compile(rf"(?:^|[^a-z])(?:{_STRONG})(?=[^a-z]|$)")
CONTAINER_WORDS = re.compile(rf"(?:^|[^a-z])(?:{_STRONG}|banner|header|footer|masthead|notices?|widget|copyright|legal|disclaimer)(?=[^a-z]|$)")
LISTS = frozenset("ul ol dl".split())
#: Blocks with an end tag of their own; and those that end where the next of their kind begins.
CLOSED = LISTS | frozenset("pre address figcaption summary thead tbody tfoot caption legend".split())
REPEATED = frozenset("li dt dd tr th td option".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())

_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_EDGE = re.compile(r"""=\s*(["'])|>""")
_ANGLE = re.compile(r"[<>]")
_COMMENT_END = re.compile(r"--!?>")
_ATTR = re.compile(r"""\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_DIGITS = re.compile(r"\d+")
_HINT = re.compile(r"class|id|role|style", re.I)

#: A block of text: key of its innermost container in the page's tree, text, characters in links.
Block = tuple[str, str, int]


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): next((g for g in m.groups()[1:] if g is not None), "") for m in _ATTR.finditer(raw)} if raw else {}


def generalised(tag: str, attrs: dict[str, str]) -> str:
    """Tag and classes, digits made alike, so that numbered pages share a path."""
    classes = sorted({_DIGITS.sub("#", c) for c in attrs.get("class", "").lower().split()})
    return ".".join([tag, *classes])


def _noisy(tag: str, attrs: dict[str, str], in_article: bool = False) -> bool:
    """Whether an element is noise. A header inside an article or a section is its heading."""
    heading = tag == "header" and in_article
    if tag in NOISE_TAGS and not heading:
        return True
    if not attrs:
        return False
    named = f"{attrs.get('class', '')} {attrs.get('id', '')}".lower().replace("_", "-").strip()
    words = CONTAINER_WORDS if (tag in CONTAINERS or tag in LISTS) and not heading else NOISE_WORDS
    return (
        "hidden" in attrs
        or attrs.get("aria-hidden", "").lower() == "true"
        or attrs.get("role", "").lower() in ROLES
        or bool(_HIDDEN.search(attrs.get("style", "")))
        or tag not in ("html", "body", "main", "article") and bool(words.search(named))
    )


class Tags:
    """Tags of a page, read in ascending order in linear time; quoted values and attributes have no limit."""

    def __init__(self, page: str):
        self.page = page
        self.dead: set[int] = set()  # places outside of quotes from which no tag ends
        self.unclosed: dict[str, int] = {}  # by quote: none stands at or after this place; "": neither a quoted value nor a '>'

    def _end(self, at: int) -> int | None:
        """Place after the '>' that ends the tag, outside of quoted values; None if nothing ends it."""
        seen = []
        while at not in self.dead:
            seen.append(at)
            m = _EDGE.search(self.page, at) if at < self.unclosed.get("", len(self.page) + 1) else None
            if not m:
                self.unclosed[""] = min(at, self.unclosed.get("", at))
            if m and not m[1]:
                return m.end()
            if not m or m.end() >= self.unclosed.get(m[1], len(self.page) + 1):
                break
            close = self.page.find(m[1], m.end())
            if close < 0:
                self.unclosed[m[1]] = m.end()
                break
            at = close + 1
        self.dead.update(seen)
        return None

    def read(self, lt: int) -> tuple[int, bool, str, str] | None:
        """(end, closing, name, attributes) of what begins with the '<' at lt; no name for comments; None for text."""
        page, n = self.page, len(self.page)
        if page.startswith("<!--", lt):
            m = _COMMENT_END.search(page, lt + 4)
            return m.end() if m else n, False, "", ""
        if page.startswith("<![CDATA[", lt):
            end = page.find("]]>", lt)
            return end + 3 if end >= 0 else n, False, "", ""
        if page.startswith(("<!", "<?"), lt):
            end = page.find(">", lt) if lt < self.unclosed.get(">", n + 1) else -1
            if end < 0:
                self.unclosed[">"] = min(lt, self.unclosed.get(">", lt))
                return None
            return end + 1, False, "", ""
        m = _NAME.match(page, lt + 1)
        if not m:
            return None
        end = self._end(m.end())
        if end is None:  # a value that is never closed: the tag ends at its first '>', unless another begins before
            angle = _ANGLE.search(page, m.end())
            if not angle or angle[0] == "<":
                return None
            end = angle.end()
        return end, bool(m[1]), m[2].lower(), page[m.end() : end - 1]


class Tree:
    """Containers of a page by their paths: one node for each distinct path, parents first. Keys are short whatever the depth."""

    def __init__(self) -> None:
        self.part, self.parent = [""], [-1]
        self.child: dict[tuple[int, str], int] = {}

    def under(self, node: int, part: str) -> int:
        at = self.child.get((node, part))
        if at is None:
            at = self.child[node, part] = len(self.part)
            self.part.append(part)
            self.parent.append(node)
        return at

    def up(self, node: int) -> list[int]:
        """Nodes from the first container down to this one."""
        out = []
        while node > 0:
            out.append(node)
            node = self.parent[node]
        return out[::-1]

    def path(self, node: int) -> str:
        return ">".join(self.part[k] for k in self.up(node))

    def find(self, path: str) -> int | None:
        node: int | None = 0
        for part in path.split(">"):
            node = self.child.get((node, part))
            if node is None:
                return None
        return node

    def inside(self, top: int) -> list[bool]:
        """For each node whether it is top or lies in it."""
        out = [False] * len(self.part)
        for k in range(top, len(out)):
            out[k] = k == top or k > 0 and out[self.parent[k]]
        return out


def parsed(page: str) -> tuple[Tree, list[Block]]:
    """The page's containers, and its text blocks outside of menus, adverts, forms, scripts and the like, in page order."""
    tree = Tree()
    out: list[Block] = []
    stack: list[tuple[str, bool, int]] = []  # containers, and other elements that are or stand in noise: tag, noisy, node
    open_: dict[str, int] = {}  # elements on the stack by tag
    skip = 0  # depth in noisy elements
    articles = 0
    links = 0
    buf: list[str] = []
    linked = 0
    at, n = 0, len(page)
    tags = Tags(page)

    def flush() -> None:
        nonlocal linked
        if skip:  # what is held stands before noise within a line
            return
        if buf:
            raw = "".join(buf)
            text = " ".join((entities.unescape(raw) if "&" in raw else raw).split())
            if text:
                out.append((str(stack[-1][2] if stack else 0), text, min(linked, len(text))))
            buf.clear()
        linked = 0

    def push(tag: str, noisy: bool, node: int) -> None:
        nonlocal skip, articles
        stack.append((tag, noisy, node))
        open_[tag] = open_.get(tag, 0) + 1
        skip += noisy
        articles += tag in ("article", "main", "section")

    def pop_to(k: int) -> None:
        nonlocal skip, articles
        for tag, noisy, _ in stack[k:]:
            open_[tag] -= 1
            skip -= noisy
            articles -= tag in ("article", "main", "section")
        del stack[k:]

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            lt = n
        if lt > at and not skip:
            buf.append(page[at:lt])
            if links:
                linked += lt - at
        if lt == n:
            break
        read = tags.read(lt)
        if not read:
            if not skip:
                buf.append("<")
            at = lt + 1
            continue
        at, closing, tag, raw = read
        if not tag:
            continue
        if tag in RAW:
            if not closing and not raw.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else n
            continue
        if tag == "br":
            if not skip:
                buf.append(" ")
            continue
        if tag == "a":
            links = 0 if closing else 1
        container = tag in CONTAINERS or tag in NOISE_TAGS
        if container or tag in BLOCKS:
            flush()
        if closing:
            if open_.get(tag):
                k = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag)
                pop_to(k)
            if container:
                links = 0
            continue
        if stack and tag in BLOCKS and (stack[-1][0] == "p" or stack[-1][0] == tag and tag in REPEATED):
            pop_to(len(stack) - 1)  # noise whose end tag is left out
        if tag in VOID or raw.endswith("/"):
            continue
        if container:
            attrs = _attributes(raw)
            part = generalised("main" if attrs.get("role", "").lower() == "main" else tag, attrs)
            push(tag, _noisy(tag, attrs, articles > 0), tree.under(stack[-1][2] if stack else 0, part))
        elif raw and _HINT.search(raw) and _noisy(tag, _attributes(raw)):
            push(tag, True, stack[-1][2] if stack else 0)
        elif skip and (tag in CLOSED or open_.get(tag)):
            push(tag, False, stack[-1][2])
    flush()
    return tree, out


def blocks(page: str) -> list[Block]:
    """Text blocks outside of noise, in page order."""
    return parsed(page)[1]


def _main_node(tree: Tree, found: list[Block]) -> tuple[int, int]:
    """The main container: the article or main element around the best container, else what holds all dense ones; and its votes."""
    scores: dict[int, int] = {}
    for key, text, linked in found:
        node = int(key)
        if node:
            scores[node] = scores.get(node, 0) + max(0, len(text) - 2 * linked)
    if not scores:
        return 0, 0
    most = max(scores.values())
    best = min((k for k in scores if scores[k] == most), key=tree.path) if sum(v == most for v in scores.values()) > 1 else max(scores, key=scores.__getitem__)
    way = tree.up(best)
    for node in way:
        if tree.part[node].split(".")[0] in ("article", "main"):
            return node, scores[best]
    shared = len(way)
    for node, score in scores.items():
        if score >= max(DENSE_CHARS, DENSE_SHARE * most):
            other = tree.up(node)
            shared = min(shared, next((i for i, (a, b) in enumerate(zip(way, other, strict=False)) if a != b), min(len(way), len(other))))
    return (way[shared - 1] if shared else 0), scores[best]


def best_path(page: str) -> tuple[str, int]:
    """Path of the page's main container, and its votes."""
    tree, found = parsed(page)
    node, votes = _main_node(tree, found)
    return tree.path(node), votes


def extract(page: str, winner: str | None = None) -> str:
    """Main text along the host's winning path, else of the page's own main container; blocks joined by blank lines."""
    tree, found = parsed(page)
    top = tree.find(winner) if winner else None
    for node in ([top] if top is not None else []) + [None]:
        if node is None:
            node = _main_node(tree, found)[0]
        inside = tree.inside(node)
        kept = [t for k, t, _ in found if inside[int(k)]]
        if kept:
            return "\n\n".join(kept)
    return ""


def host_of(url: str = "url") -> Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(f"`{url}`").cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, path): the path that wins on each host. Votes are added up before and after the shuffle.

    Of a host's paths those with a tenth of its votes are compared, ten at most.
    """

    @F.pandas_udf("path string, score long")
    def voted(pages: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([best_path(p) for p in pages], columns=["path", "score"])

    votes = (
        pages.select(host_of(url_col).alias("host"), voted(text_of(html_col)).alias("v"))
        .groupBy("host", F.col("v.path").alias("path"))
        .agg(F.sum("v.score").alias("votes"))
        .where((F.col("host") != "") & (F.col("path") != "") & (F.col("votes") > 0))
    )
    votes = stash(votes)
    top = votes.groupBy("host").agg(F.min_by("path", F.struct(-F.col("votes"), F.col("path"))).alias("top"), F.sum("votes").alias("all"))
    around = votes.join(top, "host").where((F.col("path") == F.col("top")) | F.startswith("top", F.concat("path", F.lit(">"))) & (F.col("votes") >= RAISE_SHARE * F.col("all")))
    return around.groupBy("host").agg(F.min_by("path", F.length("path")).alias("path"))


def main_text(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> tuple[DataFrame, str]:
    """pages with the main text in a column whose name is returned."""
    host, path, name = fresh(pages, "host"), fresh(pages, "path"), fresh(pages, "main")
    winners = stash(host_paths(pages, url_col, html_col))
    size = winners.agg(F.sum(F.length("host") + F.length("path") + 64)).first()[0] or 0
    winners = winners.select(F.col("host").alias(host), F.col("path").alias(path))
    if size <= BROADCAST_BYTES:
        winners = F.broadcast(winners)

    @F.pandas_udf("string")
    def extracted(pages: pd.Series, paths: pd.Series) -> pd.Series:
        return pd.Series([extract(p, w) for p, w in zip(pages, paths, strict=True)], dtype=object)

    read = pages.withColumn(host, host_of(url_col)).join(winners, host, "left")
    return read.withColumn(name, extracted(text_of(html_col), F.col(path))).drop(host, path), name


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    out, name = main_text(pages)
    return out.select("page_id", "url", F.col(name).alias("text"), F.length(name).cast("long").alias("n_chars"))
