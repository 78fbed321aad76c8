"""Main text of web pages by deducing the template that pages of a host share."""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.shared import checkpointed
from plumbline.llm.text import chunks

SUPPORT = 0.1
VARIED = 0.5
LARGE = 2
BROADCAST_HOSTS = 20_000

# Roles of elements by HTML and by common names of classes and ids.
CONTAINERS = {"article", "main"}
NO_TEXT = {
    "head", "title", "script", "style", "noscript", "template", "nav", "menu", "header", "footer", "aside", "form", "button", "select",
    "option", "textarea", "label", "iframe", "svg", "canvas", "object", "audio", "video", "dialog",
}
RAW = {"script", "style", "noscript", "textarea", "title", "iframe"}
EMPTY = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main", "nav", "ol", "p",
    "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
CLOSES = {
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
}
SCOPES = {"ul", "ol", "dl", "table", "article", "main", "section", "div", "body", "blockquote", "nav", "aside", "footer", "header", "form"}
NOT_CONTENT = {
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie",
    "cookies", "footer", "header", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "popup", "promo",
    "related", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget", "disqus", "respond",
}

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)""",
    re.DOTALL,
)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
WHITE = re.compile(r"\s+")


def number(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


class Element:
    """An open tag: its token stands for its names and those of all tags around it."""

    __slots__ = ("tag", "token", "parent", "hidden")

    def __init__(self, tag: str, names: str, parent: Element | None):
        self.tag = tag
        self.parent = parent.token if parent else 0
        self.token = number(f"{self.parent}>{tag}.{names.lower()}") if tag else 0
        own = set(re.findall(r"[a-z]+", names.lower()))
        self.hidden = bool(parent and parent.hidden) or tag in NO_TEXT or (tag not in ("html", "body") and bool(own & NOT_CONTENT))


def walk(page: str) -> Iterator[tuple[str, object, list[Element]]]:
    """("open", element, stack), ("text", decoded text, stack) and ("break", None, stack) in page order."""
    stack = [Element("", "", None)]
    at, end = 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        stop = m.start() if m else end
        if stop > at:
            yield "text", html.unescape(page[at:stop]), stack
        if not m:
            return
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if tag in BLOCKS:
            yield "break", None, stack
        if m["close"]:
            depth = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag), 0)
            if depth:
                del stack[depth:]
            continue
        if tag in EMPTY:
            continue
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in CLOSES.get(tag, ()):
                del stack[k:]
                break
            if stack[k].tag in SCOPES:
                break
        names = " ".join(a or b or c for a, b, c in NAMES.findall(m["attributes"]))
        element = Element(tag, names, stack[-1])
        if tag in RAW:
            close = re.compile(rf"</{tag}[\s/>]", re.IGNORECASE).search(page, at)
            yield "open", element, stack
            at = page.find(">", close.start()) + 1 or end if close else end
            continue
        stack.append(element)
        yield "open", element, stack


def tokens_of(page: str) -> dict[int, list]:
    """For each token of a page: its parent, tag, whether it is hidden, how often it stands there, and its own text."""
    found: dict[int, list] = {}
    for kind, what, stack in walk(page):
        if kind == "open":
            found.setdefault(what.token, [what.parent, what.tag, what.hidden, 0, []])[3] += 1
        elif kind == "text" and len(stack) > 1 and not stack[-1].hidden and what.strip():
            found[stack[-1].token][4].append(what)
    return found


def main_text(page: str, slots: set[int]) -> str:
    """Text in the slots, white space within blocks as one space, blocks joined by one space.

    A page with none of the host's slots falls back on its own containers, then
    on all that is not hidden.
    """
    events = [(kind, what, stack[-1].hidden, any(e.token in slots for e in stack), any(e.tag in CONTAINERS for e in stack)) for kind, what, stack in walk(page)]
    inside = any(e[3] for e in events)
    own = any(e[4] and not e[2] for e in events)
    blocks, current = [], []
    for kind, what, hidden, in_slot, in_container in events:
        if kind == "break":
            blocks.append("".join(current))
            current = []
        elif kind == "text" and not hidden and (in_slot if inside else in_container if own else True):
            current.append(what)
    blocks.append("".join(current))
    clean = (WHITE.sub(" ", b).strip() for b in blocks)
    return " ".join(b for b in clean if b)


def occurrences(pages: DataFrame) -> DataFrame:
    """One row per page and token, from (host, html)."""

    def run(batches):
        for part in chunks(batches, "html"):
            out = [[] for _ in range(8)]
            for host, page in zip(part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True):
                same = number(page or "")
                for token, (parent, tag, hidden, n, own) in {0: (0, "", False, 1, []), **tokens_of(page or "")}.items():
                    vector = number(f"{same}:{n}")
                    for column, value in zip(out, (host, token, parent, tag, hidden, n, vector, number("".join(own)) if own else None), strict=True):
                        column.append(value)
            types = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["host", "token", "parent", "tag", "hidden", "n", "vector", "own"]
            )

    schema = "host string, token bigint, parent bigint, tag string, hidden boolean, n bigint, vector bigint, own bigint"
    return pages.mapInArrow(run, schema)


def deduce_templates(pages: DataFrame) -> DataFrame:
    """(host, slots): the tokens of each host's template whose text is content.

    Tokens whose counts agree on every page of the host form an equivalence
    class; the vectors of counts are compared by the exclusive or of a hash of
    (page, count), which Spark adds up before the shuffle, so no host is
    gathered. The template is made of the classes of at least LARGE tokens that
    stand on SUPPORT of the host's pages; other tokens are data between them.
    Content slots are the article or main elements that stand once on each of
    their class's pages; without any, the tokens on SUPPORT of the pages whose
    own text differs on more than VARIED of their pages. Where such a slot is
    data below a template token, that place holds content: rarer data below the
    same token whose text differs is a slot too. Hidden roles (menus, forms,
    adverts and so on) are never slots.
    """
    counted = checkpointed(occurrences(pages).groupBy("host", "token").agg(
        F.first("parent").alias("parent"), F.first("tag").alias("tag"), F.first("hidden").alias("hidden"), F.count("*").alias("pages"),
        F.sum("n").alias("total"), F.expr("bit_xor(vector)").alias("vector"), F.approx_count_distinct("own").alias("texts"),
        F.count("own").alias("worded"),
    ))
    all_pages = counted.where("token = 0").select("host", F.col("pages").alias("all"))
    classes = counted.groupBy("host", "pages", "total", "vector").agg(F.count("*").alias("members"))
    frequent = F.col("pages") >= F.col("all") * SUPPORT
    template = frequent & ((F.col("members") >= LARGE) | (F.col("token") == 0))
    varied = (F.col("worded") > 0) & (F.col("texts") > F.col("worded") * VARIED)
    container = frequent & F.col("tag").isin(*CONTAINERS) & (F.col("total") == F.col("pages"))
    tokens = counted.join(classes, ["host", "pages", "total", "vector"]).join(all_pages, "host").select(
        "host", "token", "parent", "hidden", *(c.alias(n) for n, c in (("frequent", frequent), ("template", template), ("varied", varied), ("container", container))),
    )
    shown = tokens.where("token != 0 and not hidden and (varied or container)")
    places = shown.where("varied and frequent and not template").select("host", "parent").distinct().join(
        tokens.where("template").select("host", F.col("token").alias("parent")), ["host", "parent"], "left_semi"
    )
    rare = shown.where("not frequent").join(places, ["host", "parent"], "left_semi")
    marked = shown.where("frequent").select("host", "token", "container").unionByName(rare.select("host", "token", "container"))
    best = marked.withColumn("any", F.max("container").over(Window.partitionBy("host"))).where("container = any")
    return best.groupBy("host").agg(F.sort_array(F.collect_list("token")).alias("slots"))


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every page.

    Templates are deduced per host from all its pages. They are sent to all
    tasks if there are at most BROADCAST_HOSTS, else joined by host. A null or
    empty page has an empty text; pages without a url share the empty host;
    repeated rows get equal texts; other columns are ignored. Broken and cut-off
    markup is read as far as it goes.
    """
    narrow = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    hosted = narrow.withColumn("host", F.lower(F.coalesce(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[^/?#]*//([^/?#]*)", 1), F.lit(""))))
    templates = checkpointed(deduce_templates(hosted.select("host", "html")))
    templates = F.broadcast(templates) if templates.count() <= BROADCAST_HOSTS else templates
    joined = hosted.join(templates, "host", "left").select("page_id", "url", "html", "slots")

    def run(batches):
        for part in chunks(batches, "html"):
            found = [
                main_text(page or "", set(slots or ()))
                for page, slots in zip(part.column("html").to_pylist(), part.column("slots").to_pylist(), strict=True)
            ]
            columns = [part.column("page_id"), part.column("url"), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, f"page_id {narrow.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars bigint")
