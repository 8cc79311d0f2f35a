"""Language ID, near duplicates, substring dedup, scoring: against brute force on small fixtures."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from landlens.llm import components, elias_fano, lang_id, lm_score, near_dup, substring_dedup, words
from tests.llm.helpers import LOWER, SPACED, bag, empty_docs, hard_docs, sentence, vocabulary


def spaced(text):
    return SPACED.findall(text or "")


def test_word_spans_and_hashes():
    import pyarrow as pa

    texts = ["a b", None, "", "  x\ty \n", "AbC é", "abc É", "w" * 9, "x"]
    data, offsets = words.text_buffer(pa.array(texts))
    w = words.find_words(data, offsets)
    got = [[bytes(w.data[a:b]).decode() for a, b in zip(w.starts[i:j], w.ends[i:j])] for i, j in zip(w.first, w.first[1:])]
    assert got == [spaced(t) for t in texts]
    h = words.hash_words(w, lower=True)
    flat = [x.translate(LOWER) for t in texts for x in spaced(t)]
    assert len(set(h.tolist())) == len(set(flat)) and all((a == b) == (x == y) for a, x in zip(h, flat) for b, y in zip(h, flat))


def test_long_words_hash_alike_in_blocks(monkeypatch):
    import pyarrow as pa

    text = "q" * 1000 + " ab " + "q" * 1000
    data, offsets = words.text_buffer(pa.array([text]))
    whole = words.hash_words(words.find_words(data, offsets))
    monkeypatch.setattr(words, "HASH_BYTES", 64)
    parts = words.hash_words(words.find_words(data, offsets))
    assert whole[0] == whole[2] and parts[0] == parts[2] and (whole == parts).all()


def automaton_phrases(text, sample):
    """Greedy longest phrases, each run of RUN characters by itself."""
    n = 0
    for a in range(0, len(text), lang_id.RUN):
        run, at = text[a:a + lang_id.RUN], 0
        while at < len(run):
            k = 1
            while at + k < len(run) and run[at:at + k + 1] in sample:
                k += 1
            at, n = at + k, n + 1
    return n


def test_cross_parsing_counts_longest_phrases():
    rng = random.Random(1)
    samples = {"x": sentence(rng, vocabulary(rng, 60), 300), "y": sentence(rng, vocabulary(rng, 60), 300)}
    parser = lang_id.Parser(samples)
    texts = [sentence(rng, vocabulary(rng, 60), rng.randint(1, 150)) for _ in range(30)] + ["", "12 34", "ÀÉ zz", "a\nb", "İ x"]
    counts, length = parser.phrases(texts)
    for i, t in enumerate(texts):
        body = lang_id.plain(t)
        body = body if t[:1] and not t[0].isalpha() else body[1:]
        body = body if t[-1:] and not t.lower()[-1].isalpha() else body[:-1]
        assert length[i] == (len(body) if body.strip() else 0)
        if body.strip():
            for k, name in enumerate(parser.names):
                assert counts[k][i] == automaton_phrases(body, lang_id.plain(samples[name])), (t, name)


def test_language_hard_cases(spark):
    docs, rows = hard_docs(spark)
    out = lang_id.identify(docs).collect()
    assert len(out) == len(rows)
    letters = {i: any(c.isalpha() for c in t or "") for i, t in rows if i is not None}
    for r in out:
        if r.doc_id is not None:
            assert (r.lang_pred == "und") == (not letters[r.doc_id])
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.lang_pred in ("aa", "bb", "und")
    assert lang_id.identify(empty_docs(spark)).count() == 0
    assert {r.lang_pred for r in lang_id.identify(docs.withColumn("lang", docs.lang.substr(9, 1)).where("lang is null")).collect()} == {"und"}


def test_language_accuracy_on_held_out_rows(spark, smoke_dir):
    docs = spark.read.parquet(f"{smoke_dir}/documents.parquet")
    rows = lang_id.identify(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.95


def shingles(text, size=4):
    w = spaced((text or "").translate(LOWER))
    return {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def brute_groups(rows, size=4):
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * (both := len(a & sets[j])) >= 80 * (len(a) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return [(i, len(s), least.get(find(k), i) if s else i, (least.get(find(k), i) if s else i) == i) for k, ((i, _), s) in enumerate(zip(rows, sets))]


def test_near_duplicates_equal_brute_force(spark):
    docs, rows = hard_docs(spark)
    out = near_dup.group(docs).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert bag(tuple(r) for r in out) == bag(brute_groups(rows))
    assert near_dup.group(empty_docs(spark)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_dense_star_of_near_copies_is_one_group(spark, seed):
    """Copies that are near the original but not near each other, more than a region holds."""
    rng = random.Random(seed)
    vocab = vocabulary(rng, 3000)
    original = rng.choices(vocab, k=300)
    rows = [(i, " ".join(rng.choices(vocab, k=60))) for i in range(1000, 1040)]
    for i in range(150):
        copy = list(original)
        for _ in range(9):
            copy[rng.randrange(300)] = rng.choice(vocab)
        rows.append((i + 1, " ".join(copy)))
    rows.append((5000, " ".join(original)))
    out = near_dup.group(spark.createDataFrame(rows, "doc_id bigint, text string")).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert bag(tuple(r) for r in out) == bag(brute_groups(rows))


def edited(words, at, rng):
    """The words with those at the places ``at`` replaced by words that no other text has."""
    out = list(words)
    for k in at:
        out[k] = f"z{rng.randrange(10**15)}"
    return out


def dense_family(size, pairs):
    """Rows: texts of one template, similar to 0.75 and so not linked, but for pairs of 0.81 anywhere among them; and a chain of copies of copies."""
    rng = random.Random(size)
    vocab = vocabulary(rng, 3000)
    template, link, places = rng.choices(vocab, k=1000), rng.choices(vocab, k=1000), list(range(4, 996, 5))
    texts = []
    for p in range(size):
        chosen = rng.sample(places, 31)
        start = edited(template, chosen[:5], rng)
        texts.append(edited(start, chosen[5:18], rng))
        if p < pairs:
            texts.append(edited(start, chosen[18:], rng))
    for _ in range(40):
        link = edited(link, rng.sample(places, 12), rng)
        texts.append(link)
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("size, block", [(200, 512), (60, 16)])
def test_linked_pairs_inside_a_dense_family_are_found(spark, monkeypatch, size, block):
    monkeypatch.setattr(near_dup, "BLOCK", block)
    rows = dense_family(size, size // 2)
    out = near_dup.group(spark.createDataFrame(rows, "doc_id bigint, text string")).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert bag(tuple(r) for r in out) == bag(brute_groups(rows))


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)] + [(-5, -7), (9, 9)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    for x in list(parent):
        if find(x) != x or x in got:
            assert got[x] == find(x)
    assert components.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def brute_repeats(rows, length):
    docs = [spaced(t) for _, t in rows]
    seen = collections.Counter(tuple(w[k:k + length]) for w in docs for k in range(len(w) - length + 1))
    out = []
    for (i, _), w in zip(rows, docs):
        gone = [False] * len(w)
        for k in range(len(w) - length + 1):
            if seen[tuple(w[k:k + length])] > 1:
                gone[k:k + length] = [True] * length
        out.append((i, len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("length", [35, 3])
def test_substring_dedup_equals_brute_force(spark, length):
    docs, rows = hard_docs(spark)
    out = substring_dedup.remove_repeats(docs, length=length).collect()
    assert bag((r.id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in out) == bag(brute_repeats(rows, length))
    assert substring_dedup.remove_repeats(empty_docs(spark)).count() == 0


def test_spacing_keeps_the_rest_of_a_text(spark):
    docs, rows = hard_docs(spark)
    plain = bag((r.id, tuple(spaced(r.kept)), r.n_removed) for r in substring_dedup.remove_repeats(docs).collect())
    out = substring_dedup.remove_repeats(docs, spacing=True, rest=True).collect()
    assert bag((r.id, tuple(spaced(r.kept)), r.n_removed) for r in out) == plain
    texts = {i: t for i, t in rows if i is not None}
    assert all(r.kept == (texts[r.id] or "") for r in out if r.id is not None and not r.n_removed)
    assert out[0].rest.block == "b"


def test_cut_removes_words_and_the_space_behind_each(spark):
    shared = " ".join(f"p{i}" for i in range(40))
    rows = [(1, f"  one\n two  {shared}\n\nthree  four "), (2, f"{shared} x"), (3, f"y {shared}")]
    out = {r.id: r.kept for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id int, text string"), spacing=True).collect()}
    assert out == {1: "  one\n two  three  four ", 2: "x", 3: "y "}


def test_elias_fano():
    rng = np.random.default_rng(1)
    for n, top in ((0, 10), (1, 0), (1, 2**63), (1000, 5000), (1000, 2**60), (5000, 100), (3, 2**64 - 1)):
        v = np.sort(rng.integers(0, top, n, dtype=np.uint64, endpoint=True))
        e = elias_fano.EliasFano.from_bytes(elias_fano.EliasFano.build(v).to_bytes())[0]
        q = np.concatenate([v, rng.integers(0, top, 300, dtype=np.uint64, endpoint=True), np.array([0, top], np.uint64)])
        known = set(v.tolist())
        assert [x >= 0 for x in e.find(q)] == [x in known for x in q.tolist()]
        if n:
            assert (e.get(np.arange(n)) == v).all() and (e.successor(q) == np.searchsorted(v, q)).all()


@pytest.mark.parametrize("hot", [1_000, 5])
def test_scores_equal_the_model_computed_at_length(spark, monkeypatch, hot):
    monkeypatch.setattr(lm_score, "HOT", hot)
    docs, rows = hard_docs(spark)
    tokens = [(i, spaced((t or "").translate(LOWER))) for i, t in rows]
    one, two, context = collections.Counter(), collections.Counter(), collections.Counter()
    held = [zlib.crc32(str(i if i is not None else "").encode()) % 10 == 0 for i, _ in rows]
    for (_, w), h in zip(tokens, held):
        if not h:
            one.update([*w, "/"])
            two.update(zip(["^", *w], [*w, "/"]))
            context.update(["^", *w])
    n, v = sum(one.values()), len(one)
    want = []
    for (i, w), h in zip(tokens, held):
        base = full = 0.0
        for c, t in zip(["^", *w], [*w, "/"]):
            p = (one[t] + 0.1) / (n + 0.1 * (v + 1))
            a = two[c, t] / (context[c] + lm_score.PRIOR)
            a = float(lm_score.dequantise(lm_score.quantise(np.array([a])))[0]) if a else 0.0
            base += math.log10(p)
            full += math.log10(a + lm_score.PRIOR / (context[c] + lm_score.PRIOR) * p)
        want.append((i, h, len(w) + 1, sum(one[t] > 0 for t in [*w, "/"]), n, round(base, 6), round(full, 6)))
    out = lm_score.score(docs).collect()
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in out]
    assert bag(got) == bag(want)
    assert lm_score.score(empty_docs(spark)).count() == 0


def test_probabilities_of_a_context_sum_to_one():
    word = np.arange(1, 50, dtype=np.uint64)
    count = np.arange(1, 50)
    trie = lm_score.Trie.build(np.full(49, 7, np.uint64), word, count, {})
    counts, codes = trie.lookup(np.array([7], np.uint64), np.array([49]), word)
    assert counts[0] == count.sum()
    assert abs(lm_score.dequantise(codes).sum() + lm_score.PRIOR / (counts[0] + lm_score.PRIOR) - 1) < 0.02


def test_model_beats_words_alone_on_held_out_text(spark, smoke_dir):
    rows = lm_score.score(spark.read.parquet(f"{smoke_dir}/documents.parquet")).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_words_of_any_length_hash_alike(monkeypatch):
    import pyarrow as pa

    texts = [f"{'q' * n} x" for n in (1, 63, 64, 65, 100, 127, 128, 129, 200, 1000)] * 2
    data, offsets = words.text_buffer(pa.array(texts))
    w = words.find_words(data, offsets)
    whole = words.hash_words(w)
    monkeypatch.setattr(words, "HASH_BYTES", 64)
    assert (words.hash_words(w) == whole).all() and len(set(whole.tolist())) == 11
