"""Ranked lexical search (operator 12) against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from landlens.llm import lexical
from tests.llm.helpers import LOWER, bag, empty_docs, hard_docs, sentence, vocabulary

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(rows, items, best=10):
    """[(item_id, rank, doc_id, score)] of rows and items (id, text)."""
    docs = [(i, Counter(terms(t))) for i, t in rows]
    sizes = [sum(c.values()) for _, c in docs]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        scores = []
        for (i, c), size in zip(docs, sizes):
            m = 10 + (90 * size * n) // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                scores.append((-score, i is None, i if i is not None else 0, i))
        out += [(item, k + 1, i, -s) for k, (s, _, _, i) in enumerate(sorted(scores, key=lambda x: x[:3])[:best])]
    return out


def hard_items(spark, rows):
    rng = random.Random(9)
    words = vocabulary(rng)
    texts = [sentence(rng, words, rng.randint(1, 60)) for _ in range(12)]
    texts += [rows[3][1], rows[45][1], rows[60][1][:200], "ONE two", "a", "ZZZZ nowhere", None, "", " .,; ", "é ß", "1234", texts[0]]
    items = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[4])]  # a repeated item, one without id
    return spark.createDataFrame([(i, t, "c", 1, 2) for i, t in items], "item_id bigint, text string, doc_id string, key int, score int").repartition(3), items


def test_search_equals_brute_force(spark):
    docs, rows = hard_docs(spark)
    frame, items = hard_items(spark, rows)
    out = lexical.search(docs, frame)
    assert out.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert bag(map(tuple, out.collect())) == bag(brute(rows, items))


def test_items_in_several_passes_agree(spark, monkeypatch):
    docs, rows = hard_docs(spark)
    frame, items = hard_items(spark, rows)
    monkeypatch.setattr(lexical, "GROUP_TERMS", 60)
    got = lexical.search(docs, frame, best=3)
    assert bag(map(tuple, got.collect())) == bag(brute(rows, items, 3))


def test_ids_of_text_and_nothing_to_search(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "X y"), (None, "x y"), ("c", "q"), ("d", None)], "doc_id string, text string")
    items = spark.createDataFrame([("i", "x")], "item_id string, text string")
    assert [(r.rank, r.doc_id) for r in lexical.search(docs, items).orderBy("rank").collect()] == [(1, "a"), (2, "b"), (3, None)]
    none = spark.createDataFrame([], "item_id string, text string")
    assert lexical.search(docs, none).collect() == [] == lexical.search(empty_docs(spark), items).collect()


def test_pieces_part_no_term(monkeypatch):
    monkeypatch.setattr(lexical, "PIECE", 7)
    text = ("Ab cd; é" + "x" * 30 + " end 1234567 89 tail").encode()
    assert sum(lexical.terms(text), []) == [t.encode() for t in terms(text.decode())]


def random_segment(seed, n_docs, n_items, width):
    rng = np.random.default_rng(seed)
    asked = [np.sort(rng.choice(width, int(rng.integers(1, 12)), replace=False)) for _ in range(n_items)]
    asked.append(np.setdiff1d(np.arange(width), np.concatenate(asked)))  # a vocabulary holds asked terms only
    group = lexical.Group([b"%05d" % i for i in range(width)], list(range(n_items + 1)), asked)
    shape = rng.dirichlet(np.full(width, 0.05), 6)  # six kinds of documents
    found = [Counter(rng.choice(width, int(rng.integers(1, 80)), p=shape[rng.integers(6)]).tolist()) for _ in range(n_docs)]
    found[10:40] = [found[10]] * 30  # copies
    group.weigh(n_docs, sum(sum(c.values()) for c in found), Counter(t for c in found for t in c))
    ptr = np.append(0, np.cumsum([len(c) for c in found])).astype(np.int64)
    term = np.array([t for c in found for t in sorted(c)], np.int32)
    tf = np.array([c[t] for c in found for t in sorted(c)], np.int64)
    n = np.array([sum(c.values()) for c in found], np.int64)
    return group, lexical.Segment.unpack(lexical.build_segment(group, n, ptr, term, tf).pack()), n_docs


@pytest.mark.parametrize("seed", range(4))
def test_bounds_hold_and_blocks_are_skipped(seed):
    group, segment, n = random_segment(seed, 900, 25, 120)
    x = lexical.impacts(segment.ptr, segment.term, segment.impact, len(group.vocabulary)).astype(np.int64)
    scores = np.stack([x[:, a] @ group.weight[a] for a in group.asked], axis=1)
    bound = lexical.bounds(group, segment, n)
    assert (bound >= np.where(x[:, :1] * 0 + scores > 0, scores, -1)).all()
    rank = np.random.default_rng(seed).permutation(n)
    found, scored = lexical.search_segment(group, segment, rank, np.zeros(len(group.keys)), 10)
    assert scored < 0.8 * (bound >= 0).sum()  # the rest was skipped
    got = {i: list(zip(s.tolist(), d.tolist())) for i, d, s in found}
    for i in range(len(group.keys)):
        order = sorted((-s, rank[d], d) for d, s in enumerate(scores[:, i].tolist()) if s > 0)[:10]
        assert got.get(i, []) == [(-s, d) for s, _, d in order]


def test_blocks_are_of_bounded_size_and_hold_each_document_once():
    group, segment, n = random_segment(7, 900, 25, 120)
    for k, t in enumerate(segment.lists):
        docs = segment.docs[segment.docs_ptr[k]:segment.docs_ptr[k + 1]]
        ends = segment.ends[segment.ends_ptr[k]:segment.ends_ptr[k + 1]]
        held = np.flatnonzero([t in segment.term[a:b] for a, b in zip(segment.ptr, segment.ptr[1:])])
        assert sorted(docs) == held.tolist() and ends[-1] == len(docs)
        assert np.diff(np.append(0, ends)).max() <= 2 * lexical.BLOCK


def test_large_counts_stay_whole_numbers():
    group = lexical.Group([b"a"], [0], [np.array([0])])
    group.weigh(3 * 10**10, 2 * 10**13, {0: 5})
    n, tf = np.array([10**8, 5], np.int64), np.array([10**6, 1], np.int64)
    want = [10**9 * t // (1000 * t + 8 * (10 + 90 * s * group.n_docs // group.n_terms)) for s, t in zip(n.tolist(), tf.tolist())]
    assert group.impact(tf, n).tolist() == want
