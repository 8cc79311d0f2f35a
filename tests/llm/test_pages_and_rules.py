"""URL filter, HTML extraction, decontamination, quality rules: against brute force and DuckDB on small fixtures."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from landlens.llm import decontaminate, html_text, quality_rules, url_filter
from tests.llm.helpers import LOWER, SPACED, bag, empty_docs, hard_docs, sentence, vocabulary

URLS = [None, "", "no scheme", "http://", "https://Example.ORG/es/x", "https://a.example.org/es/", "http://example.org/en/12?x", "http://notexample.org/es/",
        "http://b.com/fr/", "http://com/de/#t", "x://y.COM/de/a/b", "http://casino-win.net/a", "http://casino-win.net.", "http://win.casino", "http://c.org", "http://c.org/",
        "http://c.org?q=/es/", "a://b://c.com/de/", "http://ads.example.com/en/", "http://ads.example.com/fr/1", "http://ADS.x", "http://-.-/", "http://user@h.com/de/", "http://é.org/"]


def brute_url(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = host.translate(LOWER)
    fits = [r for r in url_filter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    rule = max(fits, key=lambda r: len(r.name), default=None)
    listed = not set(re.split("[.-]", host)).isdisjoint(url_filter.LISTED)
    return host, path, rule and rule.name, rule.verdict if rule else "block" if listed else "allow"


def test_url_rules_and_cascade(spark):
    rows = [(i, u, None, "h", 1) for i, u in enumerate(URLS * 2)] + [(0, URLS[5], None, "h", 1), (None, URLS[6], None, "h", 1)]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string, host string, key int")
    out = url_filter.judge(pages).collect()
    assert bag(tuple(r) for r in out) == bag((r[0], *brute_url(r[1])) for r in rows)
    assert url_filter.judge(pages.limit(0)).count() == 0


@pytest.mark.parametrize("listed,others", [(1, 0), (0, 50), (40, 5000), (700, 700), (3, 3000)])
def test_cascade_is_exact_over_its_universe(spark, listed, others):
    keys = spark.range(listed + others).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") < listed).alias("listed"))
    cascade = url_filter.build_cascade(keys)
    assert keys.where(cascade.contains(F.col("key")) != F.col("listed")).count() == 0
    if listed:
        assert len(cascade.levels) % 2 == 1 or keys.where("listed").count() == listed
        n = listed
        assert cascade.bits <= 1.45 * n * (np.log2(max(others / n, 2)) + 4) + 64 * len(cascade.levels) * 2


ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def terms(text):
    return ALNUM.findall((text or "").translate(LOWER))


def brute_contamination(rows, items, length):
    windows = collections.defaultdict(set)
    for i, t in items:
        w = terms(t)
        for k in range(max(1, len(w) - length + 1) if w else 0):
            windows[tuple(w[k:k + length])].add(i)
    sizes = {len(k) for k in windows}
    out = []
    for i, t in rows:
        w = terms(t)
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k:k + n])]
        found = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize("length,block", [(10, 200_000), (3, 7)])
def test_contamination_equals_brute_force(spark, monkeypatch, length, block):
    monkeypatch.setattr(decontaminate, "VOCABULARY_BLOCK", block)
    rng = random.Random(9)
    docs, rows = hard_docs(spark)
    words = vocabulary(rng)
    some = [t for _, t in rows if t and len(t) > 400]
    items = [(1, " ".join(terms(some[0])[5:30])), (10, " ".join(terms(some[1])[:14]).upper()), (2, some[2][:300]), (3, "one two"), (3, "three"), (4, None), (5, ""), (6, "!!"),
             (None, " ".join(terms(some[0])[40:55])), (7, sentence(rng, words, 40)), (8, "a a a a a a a a a a a a"), (9, "x"), (1, "nowhere to be found in any of the rows at all really")]
    bench = spark.createDataFrame([(i, t, 1, "w") for i, t in items], "item_id int, text string, wid int, item string")
    out = decontaminate.contamination(docs, bench, length=length)
    out = out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256), "contaminated").collect()
    assert bag(tuple(r) for r in out) == bag(brute_contamination(rows, items, length))


def test_contamination_of_and_by_empty_tables(spark):
    docs, rows = hard_docs(spark, base=3)
    none = spark.createDataFrame([], "item_id int, text string")
    assert decontaminate.contamination(docs, none).where("contaminated or n_items > 0").count() == 0
    assert decontaminate.contamination(docs, none).count() == len(rows)
    some = spark.createDataFrame([(1, "one two")], "item_id int, text string")
    assert decontaminate.contamination(empty_docs(spark), some).count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a x b y c"), (2, "a b c"), (3, "c b a"), (4, "a b x x c"), (5, "a a b b c")], "doc_id int, text string")
    items = spark.createDataFrame([(7, "a b c")], "item_id int, text string")
    got = {w: {r.doc_id for r in decontaminate.proximity(docs, items, w).collect()} for w in (0, 1, 2)}
    assert got == {0: {2}, 1: {1, 2, 5}, 2: {1, 2, 4, 5}}


def brute_quality(text):
    text = text or ""
    w = SPACED.findall(text)
    seen = collections.Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
    repeat = {p for k in range(len(w) - 2) if seen[tuple(w[k:k + 3])] > 1 for p in (k, k + 1, k + 2)}
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    n = len(w)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeat), n < 50 or 100 * len(repeat) > 50 * n


def test_quality_measures_equal_brute_force(spark):
    docs, rows = hard_docs(spark)
    docs = docs.union(docs.limit(1).select(F.lit(777).cast("bigint"), F.lit("# a\n#  b\n# a\n \n \n<|>&%$ c"), *docs.columns[2:]))
    rows = rows + [(777, "# a\n#  b\n# a\n \n \n<|>&%$ c")]
    out = quality_rules.measures(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    assert bag(tuple(r) for r in out) == bag((i, *brute_quality(t)) for i, t in rows)


def test_hosts_are_shrunk_and_joined_back(spark):
    good, bad = " ".join(f"w{i}" for i in range(60)), "too short"
    rows = [(f"good{h}", good) for h in range(6) for _ in range(20)] + [("spam", bad)] * 30 + [("spam", good)] * 2 + [("one", bad)] + [(None, good)] * 20
    docs = spark.createDataFrame([(i, t, h, 1.0) for i, (h, t) in enumerate(rows)], "doc_id int, text string, source string, rate double")
    out = quality_rules.judge(docs).collect()
    assert len(out) == len(rows)
    kept = collections.Counter((r.host, r.kept) for r in out)
    assert kept["spam", False] == 32 and kept["one", False] == 1 and kept[None, True] == 20 and all(kept[f"good{h}", True] == 20 for h in range(6))
    rates = {r.host: r.host_rate for r in out}
    assert rates["good0"] > 0 and rates["one"] < 1 and rates["spam"] < 30 / 32 + 0.05
    assert quality_rules.judge(empty_docs(spark)).count() == 0


def page(body):
    return f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body>{body}</body></html>"


@pytest.mark.parametrize("html,text", [
    (page('<nav>m<a>b</a></nav><p>A &lt;b&gt; &amp;amp;<p>c<b>d</b>e<br>f<script>x="<p>"</script>g<!-- no --><div class="side-bar ad">z<div>y</div></div>h < i<form>q</form>'), "A <b> &amp; cde f g h < i"),
    (page('<article><header><h1>T</h1></header><p>one</p><section id="comments"><article class="comment">rd</article></section><p>two</article>out'), "T one two"),
    (page("<main><p>m</p><aside>s</aside></main><footer>f</footer>"), "m"),
    ("<p>x<div hidden>y</div>z<div style='display: none'>n</div><div role=navigation>r</div><aside>q", "x z"),
    ("plain &nbsp; text &copy 1 &#233;&#x41;", "plain text © 1 éA"),
    ("<p title='a>b' data-x=\"<p>\">k</p", "k"),
    ("<div id=cookie-notice>we use</div><p>a\n  b\t c", "a b c"),
    ("a<!-- unclosed", "a"), ("<script>never closed", ""), ("", ""), ("<", "<"), ("1 < 2 > 0", "1 < 2 > 0"),
])
def test_main_text(html, text):
    assert html_text.main_text(html) == text


def brute_boilerplate(streams, length, least, share):
    names = list(dict.fromkeys(tuple(s) for s in streams))
    need = max(least, share * len(names))
    pages = collections.defaultdict(set)
    for p, s in enumerate(names):
        for k in range(len(s) - length + 1):
            pages[s[k:k + length]].add(p)
    out = []
    for s in map(tuple, streams):
        gone = [False] * len(s)
        for k in range(len(s) - length + 1):
            if len(pages[s[k:k + length]]) >= need:
                gone[k:k + length] = [True] * length
        out.append(gone)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_boilerplate_equals_brute_force(seed):
    rng = random.Random(seed)
    shared = [rng.choices(range(50), k=rng.randint(5, 20)) for _ in range(3)]
    streams = []
    for _ in range(rng.randint(0, 25)):
        s = rng.choices(range(50 if seed % 2 else 3), k=rng.randint(0, 40))
        for b in shared:
            if rng.random() < 0.5:
                at = rng.randint(0, len(s))
                s = s[:at] + b + s[at:]
        streams.append(s)
    streams += streams[:3]
    got = html_text.boilerplate([np.array(s, np.uint64) for s in streams], 7, 4, 0.2)
    assert [g.tolist() for g in got] == brute_boilerplate(streams, 7, 4, 0.2)


def test_suffixes_are_sorted_by_their_first_tokens():
    rng = random.Random(3)
    t = [rng.randrange(3) for _ in range(200)]
    order, rank = html_text.sorted_suffixes(np.array(t), 12)
    key = [t[i:i + 12] for i in range(len(t))]
    assert [key[i] for i in order] == sorted(key)
    assert all((rank[a] == rank[b]) == (key[a] == key[b]) for a in range(0, 200, 7) for b in range(200))


def test_extraction_over_a_host(spark):
    notice = " ".join(f"we{i}" for i in range(15))
    rng = random.Random(1)
    words = vocabulary(rng)
    body = [" ".join(rng.choices(words, k=50)) for _ in range(12)]
    rows = [(i, f"http://H.org/{i}", page(f"<div>{notice}</div><p>{b}</p>"), "x", 0) for i, b in enumerate(body)]
    copy = " ".join(rng.choices(words, k=60))
    rows += [(100 + i, f"http://c.org/{i}", page(f"<p>{copy}"), "x", 0) for i in range(20)]  # copies of one article stay
    rows += [(200, None, None, "x", 0), (201, "no url", "", "x", 0), (None, "http://d.org", page("<p>alone"), "x", 0), (0, "http://H.org/0", rows[0][2], "x", 0)]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string, host string, part int")
    out = html_text.extract(pages).collect()
    want = [(r[0], r[1], body[r[0]] if r[0] is not None and r[0] < 12 else copy if r[0] is not None and r[0] < 200 else "alone" if r[0] is None else "") for r in rows]
    assert bag((r.page_id, r.url, r.text, r.n_chars) for r in out) == bag((*w, len(w[2])) for w in want)
    assert html_text.extract(pages.limit(0)).count() == 0


def test_hot_host_is_split(spark, monkeypatch):
    monkeypatch.setattr(html_text, "PAGES", 16)
    notice = " ".join(f"we{i}" for i in range(15))
    rows = [(i, f"http://h.org/{i}", f"<p>{notice}<p>" + " ".join(f"{i}x{k}" for k in range(20))) for i in range(100)]
    out = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    assert out == {i: " ".join(f"{i}x{k}" for k in range(20)) for i, _, _ in rows}


def test_hot_host_has_one_verdict(spark, monkeypatch):
    """Parts of a host decide together: notices at and below the share, on copies too, as in one array of all pages."""
    rng = random.Random(8)
    words = vocabulary(rng, 900)
    often, rare, copied = (" ".join(rng.choices(words, k=20)) for _ in range(3))
    rows = []
    for i in range(64):
        body = [" ".join(rng.choices(words, k=15)) for _ in range(3)]
        rows.append((i, f"http://h.org/{i}", f"<p>{body[0]} {often if i % 3 == 0 else ''} {body[1]} {rare if i % 4 == 0 else ''} {body[2]}</p>"))
    rows += [(100 + i, f"http://h.org/c{i}", f"<p>{copied} end</p>") for i in range(40)]
    rows += [(200 + i, "http://small.org/", f"<p>{often} {' '.join(rng.choices(words, k=15))}</p>") for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string")
    whole = bag(tuple(r) for r in html_text.extract(pages).collect())
    assert not any(often in t for _, _, t, _ in whole) and sum(rare in t for _, _, t, _ in whole) == 16
    monkeypatch.setattr(html_text, "PAGES", 8)
    assert bag(tuple(r) for r in html_text.extract(pages).collect()) == whole


@pytest.mark.parametrize("page, text", [
    ('<div class="content with-sidebar"><p>hello world</p></div>', "hello world"),
    ('<div class="layout no-sidebar"><p>hello</p><div class="sidebar-left">gone</div></div>', "hello"),
    ('<div id="form-and-function">text</div>', "text"),
    ('<p class="social-science">x</p><p>y</p>', "x y"),
    ('<article><div class="post-header"><p>Lead</p></div><p>Body</p></article>', "Lead Body"),
    ("&<b>lt</b>; a &amp; b&nbsp;c", "&lt; a & b c"),
    ('<div class="site-footer">f</div><p>main</p>', "main"),
    ('<ul class="social-links"><li>a</li></ul><p>text of the page</p>', "text of the page"),
    ('<p>short</p><div id="comments">' + "long comment " * 50 + "</div>", "short"),
    ('<div class="sidebar"><p>all there is on this page</p><nav>menu</nav><div class="ad-slot">ad</div></div>', "all there is on this page"),
    ('<p>some text that is more</p><div class="notice">x</div><div class="widget">y</div>', "some text that is more"),
])
def test_names_tell_an_element_not_its_wrapper(page, text):
    assert html_text.main_text(page) == text


def test_null_ids_and_null_texts_are_different_rows(spark):
    words = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(None, words), (words, None)], "doc_id string, text string")
    items = spark.createDataFrame([("i", words)], "item_id string, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.contaminated) for r in decontaminate.contamination(docs, items).collect()}
    assert got == {None: (10, 10, True), words: (0, 0, False)}
