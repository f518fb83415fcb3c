"""Main text of web pages by deducing the template that the pages of one host share.

A page is read as tokens: each structural tag with the path of elements around it, and each block of text with the
path of its element.  All pages of a host, however many, give one table of occurrences; tokens with the same vector of
occurrences over the host's distinct pages form an equivalence class (Spark compares the vectors by a 64-bit digest, so
a hot host is spread over all tasks).  A class is part of the template if at least three pages and half of the host's
pages have it and it holds a tag; its texts are constant slots where they are nested in one of its tags.  What remains
are the varying slots: of these, names of elements and classes only tell the article from menus, headers, footers,
sidebars, notices, adverts, forms and reader comments, whose text may vary from page to page as well.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.store import written
from quire.llm.url_rules import url_host

MIN_PAGES = 3  # distinct pages that a class needs
BROADCAST_TOKENS = 500_000  # template tokens of all hosts that are sent to every task; more are joined by host
# fixed values: HTML's element names by their role
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "object", "select"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div",
         "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head",
         "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "search",
         "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
CLOSED_BY_SAME = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
                  "td": {"td", "th"}, "th": {"td", "th"}}
ENDS_PARAGRAPH = BLOCK - {"body", "html", "head"}
ASIDE_TAGS = {"head", "nav", "footer", "aside", "form", "menu", "search", "dialog"}
PROSE = {"p", "h1", "h2", "h3"}
# fixed values: words of class and role attributes that mark what is not the article
ADVERT_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "promo", "sponsor", "sponsored"}
COMMENT_WORDS = {"comment", "comments", "disqus", "replies", "reply"}
ASIDE_WORDS = ADVERT_WORDS | COMMENT_WORDS | {
    "alert", "banner", "breadcrumb", "breadcrumbs", "consent", "contentinfo", "cookie", "cookies", "footer", "gdpr",
    "header", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices",
    "pagination", "popup", "related", "search", "share", "sharing", "sidebar", "signup", "social", "subscribe", "toolbar",
    "topbar", "widget"}
# fixed values: words that may stand beside them in one class name; any other word gives it another meaning
PLACE_WORDS = {"area", "article", "articles", "bar", "block", "body", "bottom", "box", "button", "buttons", "column",
               "container", "content", "email", "entry", "form", "global", "group", "inner", "item", "items", "left", "link",
               "links", "list", "main", "message", "outer", "page", "panel", "post", "posts", "primary", "reader", "right",
               "secondary", "section", "site", "slot", "text", "thread", "title", "top", "unit", "user", "wrap", "wrapper"}
OWN_HEADER = {"article", "content", "entry", "post"}  # whose header is the article's own

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
                  r"""|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""", re.S)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_CLOSE = re.compile(r"</([a-zA-Z][^\s/>]*+)")
_WORD = re.compile(r"[a-z]+")


@dataclass
class Page:
    """Elements in page order, the page itself first, and its blocks of text."""

    paths: list[int]  # hash of the names and classes from the host down to the element
    parents: list[int]
    names: list[str]
    marks: list[int]  # innermost marked element around it, itself included; -1 if none
    blocks: list[tuple[int, str]]  # element, text


def _attributes(attributes: str) -> tuple[str, list[set[str]], bool]:
    """Class and id as a label, the words of each class and role, and whether the element is hidden."""
    if not attributes or attributes.isspace():
        return "", [], False
    label, classes, hidden = "", [], False
    for name, value in _NAMES.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden":
            hidden |= value in ("", "hidden", "true")
        else:
            label += f".{value}"
            if name != "id":  # ids name the place of a heading or section
                classes += [set(_WORD.findall(c)) for c in value.split()]
    return label, classes, hidden


def _marked(name: str, classes: list[set[str]], in_article: bool) -> bool:
    """Whether names say that a block element is not part of the article."""
    if name in ("html", "body", "main"):
        return False
    if name == "article":
        return any(c & COMMENT_WORDS and c <= COMMENT_WORDS | PLACE_WORDS for c in classes)
    if name in ASIDE_TAGS or (name == "header" and not in_article):
        return True
    for words in classes:
        aside = words & ASIDE_WORDS
        if in_article or words & OWN_HEADER:
            aside = aside - {"header"}
        if aside and words <= ASIDE_WORDS | PLACE_WORDS:
            return True
    return False


def read_page(text: str, host: str = "") -> Page:
    """The page's elements and blocks, in time and memory linear in its length at any depth of nesting."""
    page = Page([text_token(0, host)], [-1], [""], [-1], [])
    stack = [0]
    open_names: Counter[str] = Counter()
    run: list[str] = []
    skip, skip_depth, skip_level = "", 0, 0  # a marked inline element, and the element it is in
    last_close: dict[str, int] | None = None

    def close_block() -> None:
        if run:
            words = entities.unescape("".join(run)).split()
            if words:
                page.blocks.append((stack[-1], " ".join(words)))
            run.clear()

    def pop() -> None:
        nonlocal skip
        open_names[page.names[stack.pop()]] -= 1
        if len(stack) < skip_level:
            skip = ""

    at, n = 0, len(text)
    while at < n:
        m = _TAG.search(text, at)
        if not skip and (m is None or m.start() > at):
            run.append(text[at: m.start() if m else n])
        if m is None:
            break
        at = m.end()
        slash, name, rest = m.group(1, 2, 3) if m.group(2) else m.group(4, 5, 6)
        if not name:
            continue
        name = name.lower()
        if not slash and name in RAW and not rest.endswith("/"):
            close = re.compile(rf"</{re.escape(name)}(?:\s[^>]*)?>", re.I).search(text, at)
            at = close.end() if close else n
            continue
        if name == "br" and not skip:
            run.append(" ")
        if name not in BLOCK:
            if name in VOID or rest.endswith("/"):
                continue
            if skip:
                skip_depth += (-1 if slash else 1) if name == skip else 0
                skip = skip if skip_depth else ""
            elif not slash:
                _, classes, hidden = _attributes(rest)
                if name == "button" or hidden or any(c & ADVERT_WORDS and c <= ADVERT_WORDS | PLACE_WORDS for c in classes):
                    if last_close is None:
                        last_close = {c.group(1).lower(): c.start() for c in _CLOSE.finditer(text)}
                    if last_close.get(name, -1) >= at:  # one that never ends marks nothing
                        skip, skip_depth, skip_level = name, 1, len(stack)
            continue
        close_block()
        if slash:
            if open_names[name] > 0:
                while page.names[stack[-1]] != name:
                    pop()
                pop()
            continue
        if name in VOID:
            continue
        if name in ENDS_PARAGRAPH and page.names[stack[-1]] == "p":
            pop()
        if name in CLOSED_BY_SAME:
            while page.names[stack[-1]] in CLOSED_BY_SAME[name]:
                pop()
        label, classes, hidden = _attributes(rest)
        marked = _marked(name, classes, open_names["article"] + open_names["main"] > 0)
        marked |= hidden and name not in ("html", "body", "article", "main")
        element = len(page.paths)
        page.paths.append(xxhash.xxh3_64_intdigest((name + label).encode("utf-8", "surrogatepass"), page.paths[stack[-1]]))
        page.parents.append(stack[-1])
        page.names.append(name)
        page.marks.append(element if marked else page.marks[stack[-1]])
        if not rest.endswith("/"):
            stack.append(element)
            open_names[name] += 1
    close_block()
    return page


def text_token(path: int, text: str) -> int:
    return xxhash.xxh3_64_intdigest(b"\0" + text.encode("utf-8", "surrogatepass"), path)


def page_tokens(page: Page) -> tuple[Counter[int], Counter[int], dict[int, int]]:
    """Occurrences of tags (the page itself once) and of texts, and the code points of each text."""
    tokens = [text_token(page.paths[e], t) for e, t in page.blocks]
    return Counter(page.paths), Counter(tokens), {k: len(t) for k, (_, t) in zip(tokens, page.blocks, strict=True)}


def article_element(page: Page) -> int:
    """The one outermost article of the page, or else its one main element, or else the page itself."""
    within = [False] * len(page.names)
    found: dict[str, list[int]] = {"article": [], "main": []}
    for i, name in enumerate(page.names):
        inside = i > 0 and within[page.parents[i]]
        if name in found and page.marks[i] != i and not (name == "article" and inside):
            found[name].append(i)
        within[i] = inside or name == "article"
    for name in ("article", "main"):
        for some in ([i for i in found[name] if page.marks[i] < 0], found[name]):
            if len(some) == 1:
                return some[0]
            if some:
                break
    return 0


def extract_page(page: Page, constant: dict[int, int], tags: dict[int, int]) -> str:
    """The blocks in the article's varying slots; ``constant`` and ``tags`` give the class of each template token."""
    main = article_element(page)
    inside: list[bool] = []
    classes: list[frozenset[int]] = []  # template classes with a tag around the element
    for i, parent in enumerate(page.parents):
        inside.append(i == main or (i > 0 and inside[parent]))
        around = classes[parent] if i else frozenset()
        mine = tags.get(page.paths[i])
        classes.append(around if mine is None or mine in around else around | {mine})
    slots = []
    for e, text in page.blocks:
        if inside[e]:
            mine = constant.get(text_token(page.paths[e], text)) if constant else None
            own_title = main and page.names[e] == "h1"
            if mine is None or mine not in classes[e] or own_title:
                slots.append((e, page.marks[e] if page.marks[e] > main else -1, text))
    wrappers = _wrapping_forms(page, slots, main)
    out = []
    for _, mark, text in slots:
        while mark in wrappers:
            mark = page.marks[page.parents[mark]]
            mark = mark if mark > main else -1
        if mark < 0:
            out.append(text)
    return "\n\n".join(out)


def _wrapping_forms(page: Page, slots: list[tuple[int, int, str]], main: int) -> set[int]:
    """Forms around a page's text: with a paragraph or heading, and more text than all that is not marked."""
    size: Counter[int] = Counter()
    prose = set()
    for e, mark, text in slots:
        size[mark] += len(text)
        if page.names[e] in PROSE:
            prose.add(mark)
    return {i for i in prose if i > 0 and page.names[i] == "form" and size[i] > size[-1]}


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def _occurrences(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per page and token: what it is, and a hash of (page, times) as its cell of the vector."""
    for b in batches:
        token, hosts, cell, kind, chars = [], [], [], [], []
        for html, host, key in zip(b["html"], b["host"], b["host_key"], strict=True):
            page = read_page(html, host)
            page_id = xxhash.xxh3_64_intdigest(html.encode("utf-8", "surrogatepass"), page.paths[0])
            tags, texts, size = page_tokens(page)
            cells: dict[int, int] = {}
            for counts, is_text in ((tags, 1), (texts, 2)):
                for t, k in counts.items():
                    token.append(t)
                    cell.append(cells.get(k) or cells.setdefault(k, xxhash.xxh3_64_intdigest(k.to_bytes(8, "little"), page_id)))
                    kind.append(0 if t == page.paths[0] else is_text)
                    chars.append(size[t] * k if is_text == 2 else 0)
            chars[len(chars) - len(tags) - len(texts)] = sum(size[t] * k for t, k in texts.items())
            hosts += [key] * (len(tags) + len(texts))
        yield pd.DataFrame({"token": _signed(token), "host_key": np.array(hosts, np.int64), "cell": _signed(cell),
                            "kind": np.array(kind, np.int8), "chars": np.array(chars, np.int64)})


def template_tokens(pages: DataFrame) -> DataFrame:
    """The template of every host of ``pages`` (host, html): its tokens with class and whether they are texts.

    Equal pages count once.  A host more than half of whose text would be constant has copies of pages, not a template.
    """
    pages = pages.withColumn("host_key", F.xxhash64("host"))
    cells = pages.mapInPandas(_occurrences, "token long, host_key long, cell long, kind byte, chars long").distinct()
    tokens = cells.groupBy("host_key", "token", "kind").agg(
        F.bit_xor("cell").alias("vector"), F.count("*").alias("n"), F.sum("chars").alias("chars"))
    tokens = written(tokens.where(f"n >= {MIN_PAGES}"), "page-tokens")
    hosts = tokens.where("kind = 0").select("host_key", F.col("n").alias("pages"), F.col("chars").alias("all_chars"))
    tokens = tokens.join(hosts, "host_key").where("2 * n >= pages")
    shape = tokens.groupBy("host_key", "vector").agg(F.max((F.col("kind") < 2).cast("int")).alias("tagged"),
                                                 F.max((F.col("kind") == 2).cast("int")).alias("texts"))
    parts = tokens.join(shape.where("tagged = 1 and texts = 1"), ["host_key", "vector"])
    sized = parts.where("kind = 2").groupBy("host_key").agg(
        F.sum("chars").alias("constant"), F.first("all_chars").alias("all_chars"))
    kept = sized.where("2 * constant <= all_chars").select("host_key")
    parts = parts.join(kept, "host_key").select("host_key", "token", "vector", (F.col("kind") == 2).alias("is_text"))
    return written(parts, "template")


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    whole = 2 ** 64
    for b in batches:
        texts = []
        for html, host, found in zip(b["html"], b["host"], b["template"], strict=True):
            rows = [] if found is None else found
            constant = {r["token"] % whole: r["vector"] for r in rows if r["is_text"]}
            tags = {r["token"] % whole: r["vector"] for r in rows if not r["is_text"]}
            texts.append(extract_page(read_page(html, host), constant, tags))
        yield pd.DataFrame({"id": b["id"], "url": b["url"], "text": texts, "n_chars": [len(t) for t in texts]})


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row (id, url, text, n_chars) per row of ``pages``.

    Null html counts as empty and gives an empty text; null urls form a host of their own; identical pages stay and
    give equal texts; other columns are ignored; nesting and length have no limit.  A page's text does not depend on
    how pages are dealt to tasks.  Texts of pages are read twice and shuffled only if the templates are too many to send.
    """
    def name(c: str) -> Column:
        return F.col(f"`{c}`")

    keyed = pages.select(name(id_col).alias("id"), name(url_col).alias("url"), F.coalesce(name(html_col), F.lit("")).alias("html"),
                         F.coalesce(url_host(name(url_col)), F.lit("")).alias("host"))
    id_type = dict(keyed.dtypes)["id"]
    tokens = template_tokens(keyed.select("host", "html"))
    by_host = tokens.groupBy("host_key").agg(F.collect_list(F.struct("token", "vector", "is_text")).alias("template"))
    if tokens.limit(BROADCAST_TOKENS + 1).count() <= BROADCAST_TOKENS:
        by_host = F.broadcast(by_host)
    held = keyed.withColumn("host_key", F.xxhash64("host")).join(by_host, "host_key", "left")
    out = held.mapInPandas(_extract, f"id {id_type}, url string, text string, n_chars long")
    return out.withColumnRenamed("id", id_col)

