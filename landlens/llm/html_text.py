"""HTML extraction (operator 6): page structure, then a host's suffix array.

1. Page.  Markup is read as browsers read it (raw-text elements, comments, quoted
   attributes, character references, which no tag parts); text inside menus, headers, footers, sidebars,
   notices, adverts, forms, scripts, styles and reader comments, told by element, role,
   class, id or a hidden attribute, is left out.  A class or id tells it by its whole
   name or by a name with words of layout (``sidebar-left``, ``site-footer``), not by any part
   (``with-sidebar``, ``social-science``); and an element that holds most of the page's text (70 %)
   is not left out for its name, since it is the page's wrapper, unless the name says comments or cookies.  If a page has an
   article or main element, only text inside one counts.
2. Host.  The token streams of a host's pages are concatenated, with separators that
   equal nothing, and their suffixes are sorted.  Neighbouring suffixes that share
   ``LENGTH`` tokens or more are occurrences of a repeated substring; one that
   occurs in at least ``LEAST_PAGES`` distinct pages and in ``SHARE`` of the host's pages is
   boilerplate.  Tokens covered by boilerplate go, unique runs stay.  Pages with
   equal streams count as one page, so copies of an article are no boilerplate.

A host of more than ``PAGES`` pages is dealt to parts of about that many pages, and its
windows of ``LENGTH`` tokens (which is what boilerplate is covered by) are counted over the
whole host: each distinct stream belongs to one of the parts that hold it; a window on
``SHARE`` of the host's distinct pages is on that share of one part's at least, so the
parts name such windows, every part counts all that a part of its host has named, and the
sums decide for all pages of the host.  No task holds a whole host's pages.

Defined results: a null page is empty and has an empty text; a null url, or one
without ``://``, has the empty host; repeated rows get equal results.
"""

from __future__ import annotations

import hashlib
import html as _html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landlens.session import scratch_path, ship_package

from .substring_dedup import window_hashes
from .url_filter import host_and_path
from .words import find_words, hash_words, slices, text_buffer

LENGTH, LEAST_PAGES, SHARE, PAGES = 12, 5, 0.3, 256

#: Elements whose text is no part of an article.
_OUTSIDE = frozenset("aside button canvas datalist dialog footer form head iframe input label menu nav noscript object option select svg template".split())
#: Elements whose content is read raw up to their end tag; none is text of an article.
_RAW = frozenset("iframe noembed noframes plaintext script style textarea title xmp".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that do not break a run of text.
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Words of class names and ids that tell the same.
_NAMES = frozenset("""ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs captcha comment comments cookie cookies disclaimer disqus footer
    form header login masthead menu modal nav navbar navigation newsletter notice notices notification pagination pager popup promo promotion related respond
    share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget widgets""".split())
#: Words that stand beside those of _NAMES in the name of such an element, before or after.
_LAYOUT = frozenset("""area bar block bottom box button buttons cell column consent container content feed fixed global group icon icons inner item items left link links list
    main mobile outer page panel post posts primary right row secondary section site slot sticky top unit wrap wrapper""".split())
#: A name that begins with one of these says what else is on the page.
_SAYS = frozenset("has hide is no not show with without".split())
_ARTICLE = frozenset(("article", "main"))
#: Readers' words and consent texts may be most of a page and are no wrapper of it.
_NO_WRAPPER = frozenset("comment comments cookie cookies disqus respond".split())
#: Share of the page's text from which an element is not left out for its name.
WRAPPER = 0.7

_TOKEN = re.compile(r"""<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"'=]|=\s*"[^"]*"|=\s*'[^']*'|=\s*[^>"'\s]?|["'])*)(>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


def _telling(value: str) -> set[str]:
    """The words of _NAMES by which the names of a class or id attribute tell an element to be left out."""
    out: set[str] = set()
    for token in value.split():
        parts = _NAME.findall(token)
        named = [p for p in parts if p in _NAMES]
        if named and parts[0] not in _SAYS and (parts[-1] in _NAMES or all(p in _NAMES or p in _LAYOUT for p in parts)):
            out.update(named)
    return out


def _left_out(name: str, attributes: str, in_article: bool) -> str:
    """How an element is known to be left out: ``kind`` (element, role, hidden), ``name`` (class or id), or not at all (empty)."""
    if name in _OUTSIDE or name == "header" and not in_article:
        return "kind"
    if not attributes or attributes.isspace():
        return ""
    by_name = False
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), (a or b or c).lower()
        if key == "hidden" or key == "role" and value in _ROLES or key == "style" and _HIDDEN.search(value):
            return "kind"
        if key in ("class", "id"):
            told = _telling(value)
            if not told.isdisjoint(_NO_WRAPPER) and name not in ("body", "html", "main"):
                return "kind"
            if name == "article":
                continue
            if name not in ("body", "html", "main"):
                by_name |= bool(told - {"header"} if in_article else told)  # an article's own header is part of it
    return "name" if by_name else ""


def _read(page: str, wrappers: set[int]) -> tuple[str, dict[int, int], int]:
    """(text, characters of text in each element left out for its name, all characters that are not left out otherwise); ``wrappers``
    are elements, by the place of their tag, whose names do not count."""
    every: list[str] = []  # text outside left-out elements
    inner: list[str] = []  # that of it inside an article
    stack: list[str] = []
    out_at = -1  # height of the stack at which a left-out element opened
    out_by = -1  # its place if it was for its name
    held: dict[int, int] = {}
    size = 0
    article = 0
    seen_article = False
    at, n = 0, len(page)
    tokens = _TOKEN.finditer(page)
    match = next(tokens, None)
    while at < n:
        start = match.start() if match else n
        if start > at and (out_at < 0 or out_by >= 0):
            text = page[at:start]
            visible = len(text) - text.count(" ") - text.count("\n")
            size += visible
            if out_at >= 0:
                held[out_by] += visible
            else:
                text = _html.unescape(text) if "&" in text else text
                every.append(text)
                if article:
                    inner.append(text)
        if not match:
            break
        at = match.end()
        closing, name, attributes, end = match.groups()
        if name and end:
            name = name.lower()
            if name not in _INLINE and out_at < 0:
                every.append(" ")
                if article:
                    inner.append(" ")
            if closing:
                if name in stack:
                    while stack:
                        top = stack.pop()
                        article -= top in _ARTICLE
                        if top == name:
                            break
                    if out_at >= len(stack):
                        out_at = -1
            elif name in _RAW:
                close = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
                at = close.end() if close and name != "plaintext" else n
                tokens = _TOKEN.finditer(page, at)
            elif name not in _VOID:
                if name in _ARTICLE and out_at >= 0 and not _left_out(name, attributes, False) and not set(stack[out_at:]) & {"article", "main"} and stack[out_at] in ("nav", "header", "head"):
                    out_at = -1  # a menu that was never closed does not swallow the article
                how = _left_out(name, attributes, article > 0) if out_at < 0 else ""
                if how == "kind" or how == "name" and match.start() not in wrappers:
                    out_at, out_by = len(stack), match.start() if how == "name" else -1
                    if how == "name":
                        held[out_by] = 0
                stack.append(name)
                if name in _ARTICLE:
                    article += 1
                    seen_article |= out_at < 0
        match = next(tokens, None)
    return " ".join("".join(inner if seen_article else every).split()), held, size


def main_text(page: str) -> str:
    """The article's text: blocks in page order, white space as one space, references decoded."""
    wrappers: set[int] = set()
    while True:
        text, held, size = _read(page, wrappers)
        large = {place for place, n in held.items() if n > WRAPPER * size}
        if not large:
            return text
        wrappers |= large  # what is inside is judged by itself


def sorted_suffixes(tokens: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, rank): suffixes sorted by their first ``length`` tokens or more (doubling); equal ranks share them."""
    _, rank = np.unique(tokens, return_inverse=True)
    order, depth, n = np.argsort(rank, kind="stable"), 1, len(tokens)
    while depth < length and n:
        step = min(depth, length - depth)
        after = np.zeros(n, np.int64)
        after[:n - step] = rank[step:] + 1
        key = rank * (int(rank.max()) + 2) + after
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        depth += step
    return order, rank


def boilerplate(streams: list[np.ndarray], length: int = LENGTH, least: int = LEAST_PAGES, share: float = SHARE) -> list[np.ndarray]:
    """For the token streams of a host's pages: which tokens substrings repeated across distinct pages cover."""
    names: dict[bytes, int] = {}
    page = [names.setdefault(s.tobytes(), len(names)) for s in streams]
    distinct = [s for s, p in zip(streams, page) if len(s)]
    need = max(least, share * len(names))
    covered = {}
    if len(names) >= least and distinct:
        own: dict[int, np.ndarray] = {}
        for s, p in zip(streams, page):
            own.setdefault(p, s)
        sizes = np.array([len(own[p]) + 1 for p in range(len(own))])
        # a separator a page: values that no token has
        ids = np.unique(np.concatenate([own[p] for p in range(len(own))]), return_inverse=True)[1] + len(own)
        ends = np.cumsum(sizes) - 1
        text = np.empty(int(sizes.sum()), np.int64)
        separator = np.zeros(len(text), bool)
        separator[ends] = True
        text[~separator], text[separator] = ids, np.arange(len(own))
        of = np.repeat(np.arange(len(own)), sizes)
        _, rank = sorted_suffixes(text, length)
        whole = np.repeat(ends, sizes) - np.arange(len(text)) >= length  # the substring ends inside its page
        pair = np.unique(rank[whole] * len(own) + of[whole])
        pages = np.bincount(pair // len(own), minlength=int(rank.max()) + 1)
        hit = np.flatnonzero(whole & (pages[rank] >= need))
        cover = np.zeros(len(text) + 1, np.int64)
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + length, -1)
        gone = np.cumsum(cover[:-1]) > 0
        for p, (e, k) in enumerate(zip(ends, sizes)):
            covered[p] = gone[e - k + 1:e]
    return [covered.get(p, np.zeros(len(s), bool)) for s, p in zip(streams, page)]


def _tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, and where each text's begin."""
    data, offsets = text_buffer(pa.array(texts, pa.string()))
    w = find_words(data, offsets, b" ")  # white space is single spaces by now
    return hash_words(w), w.first


def _host_pages(table: pa.Table) -> pa.Table:
    """Removes boilerplate from the texts of one host's pages."""
    h, first = _tokens(table["text"].to_pylist())
    return _without(table, boilerplate([h[a:b] for a, b in zip(first, first[1:])]))


def _without(table: pa.Table, covered: list[np.ndarray]) -> pa.Table:
    texts = []
    for text, gone in zip(table["text"].to_pylist(), covered):
        texts.append(" ".join(t for t, g in zip(text.split(" "), gone) if not g) if gone.any() else text)
    return pa.table({"page_id": table["page_id"], "url": table["url"], "text": pa.array(texts, pa.string())})


def _name(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def _places(table: pa.Table, names: list[int], windows: list[int]) -> pa.Table:
    """host, part, and a name or a window a row."""
    n = len(names) + len(windows)
    return pa.table({"host": pa.array([table["host"][0].as_py()] * n, pa.string()), "part": pa.array([table["part"][0].as_py()] * n, pa.int32()),
                     "key": pa.array(names + windows, pa.int64())})


def _named(table: pa.Table) -> pa.Table:
    """The names of a part's distinct texts; none of a host of one part."""
    return _places(table, sorted({_name(t) for t in table["text"].to_pylist()}) if table["parts"][0].as_py() > 1 else [], [])


def _page_windows(pages: pa.Table, owned: set[int]) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct windows of the part's own texts, on how many of them each is, and the number of own texts."""
    own = sorted(t for t in set(pages["text"].to_pylist()) if _name(t) in owned)
    h, first = _tokens(own)
    starts, windows = window_hashes(h, first, LENGTH)
    page = np.searchsorted(first, starts, side="right") - 1
    order = np.lexsort((windows, page))
    page, windows = page[order], windows[order]
    new = np.ones(len(windows), bool)
    new[1:] = (windows[1:] != windows[:-1]) | (page[1:] != page[:-1])
    return *np.unique(windows[new], return_counts=True), len(own)


def _frequent(pages: pa.Table, owned: pa.Table) -> pa.Table:
    """Windows on ``SHARE`` of the part's own texts."""
    if not pages.num_rows or not owned.num_rows:
        return _places(owned, [], []) if owned.num_rows else _places(pages, [], [])
    windows, n, total = _page_windows(pages, set(owned["key"].to_pylist()))
    return _places(pages, [], windows[n >= (SHARE - 1e-9) * total].view(np.int64).tolist())


def _counted(pages: pa.Table, asked: pa.Table) -> pa.Table:
    """On how many of the part's own texts each window is that a part of the host named."""
    out = {"host": [], "key": [], "n": []}
    if pages.num_rows and asked.num_rows:
        named = [x for x in asked["windows"].to_pylist() if x is not None]
        windows, n, _ = _page_windows(pages, {x for x in asked["key"].to_pylist() if x is not None})
        if named and len(windows):
            found = np.isin(windows.view(np.int64), np.array(named[0], np.int64))
            out = {"host": [pages["host"][0].as_py()] * int(found.sum()), "key": windows.view(np.int64)[found], "n": n[found]}
    return pa.table({"host": pa.array(out["host"], pa.string()), "key": pa.array(out["key"], pa.int64()), "n": pa.array(out["n"], pa.int64())})


def _finished(pages: pa.Table, verdict: pa.Table) -> pa.Table:
    """A part's pages without the host's boilerplate."""
    if not pages.num_rows or pages["parts"][0].as_py() == 1:
        return _host_pages(pages)
    h, first = _tokens(pages["text"].to_pylist())
    gone = np.zeros(len(h), bool)
    if verdict.num_rows:
        starts, windows = window_hashes(h, first, LENGTH)
        hit = starts[np.isin(windows.view(np.int64), np.array(verdict["windows"][0].as_py(), np.int64))]
        cover = np.zeros(len(h) + 1, np.int64)
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + LENGTH, -1)
        gone = np.cumsum(cover[:-1]) > 0
    return _without(pages, [gone[a:b] for a, b in zip(first, first[1:])])


def _page_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "html"):
            texts = pa.array([main_text(p) for p in part.column("html").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([part.column(c) for c in ("page_id", "url", "host")] + [texts], names=["page_id", "url", "host", "text"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    ship_package(pages.sparkSession)
    host, _ = host_and_path(F.col(f"`{url_col}`"))
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), host.alias("host"),
                        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("html"))
    # hosts of several arrays, written so that their real size decides how they are joined
    path = scratch_path(pages.sparkSession, "html-hosts")
    parts = rows.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / PAGES).cast("int").alias("parts")).where("parts > 1")
    parts.write.parquet(path)
    parts = pages.sparkSession.read.parquet(path)
    kind = dict(rows.dtypes)
    texts = rows.mapInArrow(_page_texts, f"page_id {kind['page_id']}, url {kind['url']}, host string, text string")
    parted = F.coalesce("parts", F.lit(1))
    texts = texts.join(parts, "host", "left").select(
        "page_id", "url", "host", "text", parted.alias("parts"), F.pmod(F.xxhash64("page_id", "url"), parted).cast("int").alias("part"))
    schema = f"page_id {kind['page_id']}, url {kind['url']}, text string"
    grouped = texts.groupBy("host", "part")
    if parts.isEmpty():
        out = grouped.applyInArrow(_host_pages, schema)
    else:  # one plan, so that all passes share the exchange of the texts
        place = "host string, part int, key bigint"

        def of_every_part(windows: DataFrame) -> DataFrame:
            lists = windows.groupBy("host").agg(F.collect_set("key").alias("windows"))
            return lists.join(parts, "host").select("host", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "windows")

        owned = grouped.applyInArrow(_named, place).groupBy("host", "key").agg(F.min("part").alias("part")).select("host", "part", "key")
        frequent = grouped.cogroup(owned.groupBy("host", "part")).applyInArrow(_frequent, place)
        asked = owned.withColumn("windows", F.lit(None).cast("array<bigint>")).unionByName(of_every_part(frequent).withColumn("key", F.lit(None).cast("bigint")))
        counts = grouped.cogroup(asked.groupBy("host", "part")).applyInArrow(_counted, "host string, key bigint, n bigint").groupBy("host", "key").agg(F.sum("n").alias("n"))
        need = owned.groupBy("host").agg(F.greatest(F.lit(float(LEAST_PAGES)), F.count(F.lit(1)) * F.lit(SHARE)).alias("need"))
        verdict = of_every_part(counts.join(need, "host").where("n >= need"))
        out = grouped.cogroup(verdict.groupBy("host", "part")).applyInArrow(_finished, schema)
    return out.withColumn("n_chars", F.length("text").cast("bigint"))
