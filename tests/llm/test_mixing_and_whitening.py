"""Mixing sources (operator 11) and embedding whitening (operator 13): against brute force on small fixtures."""

import hashlib
import math
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from landlens.llm import feast, mixing, numbering, whitening
from tests.llm.helpers import SPACED, bag, empty_docs, hard_docs


def brute_targets(sizes: dict, weights, cap):
    """Fractions by resharing the excess until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, free = {}, sum(sizes.values()), set(names)
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if Fraction(left * weight[s], total) > cap * sizes[s]}
        if not over:
            return target | {s: Fraction(left * weight[s], total) for s in free}
        for s in over:
            target[s] = Fraction(cap * sizes[s])
            left -= cap * sizes[s]
        free -= over
    return target


def brute_plan(rows, weights=mixing.WEIGHTS, cap=mixing.CAP, seed=mixing.SEED):
    """[(doc_id, source, size, taken)]; rows are (doc_id, text, source)."""
    sized = [(i, s, len(SPACED.findall(t or ""))) for i, t, s in rows]
    sizes = Counter()
    for _, s, n in sized:
        sizes[s] += n
    target, out = brute_targets(sizes, weights, cap), []
    groups = defaultdict(list)
    for r in sized:
        groups[r[1]].append(r)
    for s, members in groups.items():
        shift = Fraction(int(hashlib.md5("|".join([str(seed)] + ([] if s is None else [s])).encode()).hexdigest()[:8], 16), 1 << 32)
        rate, place = (target[s] / sizes[s] if sizes[s] else Fraction(cap)), shift
        for i, _, n in sorted(members, key=lambda r: (r[2], r[0] is None, r[0] or 0)):
            copies = math.floor(place + rate) - math.floor(place)
            place += rate
            out.append((i, s, n, copies * n))
    return out, target


def triples(docs):
    return [(r.doc_id, r.text, r.source) for r in docs.collect()]


@pytest.mark.parametrize("weights, cap", [((1, 2, 3), 3), ((1, 50), 2), ((5,), 1)])
def test_plan_equals_brute_force(spark, weights, cap):
    docs, _ = hard_docs(spark)
    got = mixing.plan(docs, weights=weights, cap=cap).collect()
    want, target = brute_plan(triples(docs), weights, cap)
    assert bag((r.doc_id, r.source, r.size, r.taken) for r in got) == bag(want)
    for r in got:
        assert r.target == pytest.approx(float(target[r.source]), rel=1e-15) and r.taken == r.copies * r.size <= cap * r.size


def test_targets_cap_source_after_source(spark):
    sizes = {"a": 1, "b": 10, "c": 100, "d": 1000, "e": 100_000, "f": 0, None: 7}
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    from landlens.session import scratch_path

    got = {r.source: r.target for r in mixing.targets(rows, scratch_path(spark, "t")).collect()}
    want = brute_targets(sizes, mixing.WEIGHTS, mixing.CAP)
    assert got == {s: pytest.approx(float(v), rel=1e-15) for s, v in want.items()}
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_taken_words_are_near_their_target_and_reruns_agree(spark):
    texts = [(i, "w " * (1 + i * i % 97), "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(3000)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string, source string")
    first, again = (bag(map(tuple, mixing.plan(docs.repartition(n)).collect())) for n in (2, 5))
    assert first == again
    taken, target = Counter(), {}
    for _, s, _, _, t, _, n in first:
        taken[s] += n
        target[s] = t
    assert all(abs(taken[s] - t) <= 97 for s, t in target.items())


def test_mixture_holds_each_row_as_often_as_planned(spark):
    docs, _ = hard_docs(spark)
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    copies = Counter((r.doc_id, r.size) for r in mixing.plan(docs).where("copies > 0").withColumn("k", F.explode(F.sequence(F.lit(1), "copies"))).collect())
    assert Counter((r.doc_id, len(SPACED.findall(r.text or ""))) for r in out.collect()) == copies


def test_no_documents_no_words(spark):
    assert mixing.plan(empty_docs(spark)).collect() == [] and mixing.mix(empty_docs(spark)).collect() == []
    none = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id bigint, text string, source string")
    assert [(r.target, r.taken) for r in mixing.plan(none).collect()] == [(0.0, 0)] * 2


def test_numbering_spreads_a_group_over_partitions(spark):
    from landlens.session import scratch_path

    rows = spark.range(5000).select(F.lit("one").alias("g"), (F.col("id") * 7919 % 5000).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    done = numbering.write_ordered(rows, ["g"], ["v"], scratch_path(spark, "n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    run = numbering.runs(done, ["g"])
    assert run.count() > 1
    out = done.join(run, ["part", "g"]).select("v", (F.col("at") + F.col("shift")).alias("k")).collect()
    assert all(r.k == r.v + 1 for r in out)


# ---- whitening


def spectra(rng, d):
    yield rng.random(d)
    yield np.ones(d)
    yield np.repeat([5.0, 1.0, 0.0], d)[:d] * 1e6
    yield 10.0 ** -rng.integers(0, 12, d).astype(float)  # clusters of equal eigenvalues
    yield np.sort(rng.random(d)) + np.r_[np.zeros(d // 2), np.full(d - d // 2, 1e-9)]


def test_contour_integration_equals_dense_eigenpairs():
    rng = np.random.default_rng(1)
    for d in (1, 2, 3, 8, 31, 32, 33, 64, 71):
        q, _ = np.linalg.qr(rng.standard_normal((d, d)))
        for e in spectra(rng, d):
            a = (q * e) @ q.T
            values, vectors = feast.largest((a + a.T) / 2, 32)
            want = np.sort(e)[::-1][:32]
            top = max(want[0], 1e-300)
            assert len(values) == min(32, d) and np.abs(values - want).max() < 1e-12 * top
            assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
            assert np.linalg.norm(a @ vectors - vectors * values, axis=0).max() < 1e-11 * top


def test_inertia_counts_and_intervals_part_no_cluster():
    rng = np.random.default_rng(2)
    q, _ = np.linalg.qr(rng.standard_normal((40, 40)))
    e = np.r_[np.full(12, 3.0), np.full(9, 2.0), rng.random(19)]
    a = (q * e) @ q.T
    a = (a + a.T) / 2
    inertia = feast.Inertia(a)
    for s in (-1, 0.5, 1.5, 2.5, 3.5):
        assert inertia.above(s) == (e > s).sum()
    parts = feast.intervals(inertia, 15)
    assert sum(n for _, _, n in parts) == 21 and all(n == ((e > a) & (e < b)).sum() for a, b, n in parts)


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>, label int, x string, v int, n int")


def brute_whitening(good, k=whitening.COMPONENTS):
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in good], object)
    n, s = len(x), x.sum(0)
    off = n * x - s
    cov = np.array([[float(Fraction(int(v), n**3)) for v in row] for row in off.T @ off])
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    return (off * off).sum(1), (off.astype(float) / n) @ q / np.sqrt(e), e / np.trace(cov)


def test_whitening_equals_dense_brute_force(spark):
    rng = np.random.default_rng(3)
    good = [[float(c) for c in np.float32(rng.standard_normal(40) * np.linspace(0.5, 6, 40))] for _ in range(500)]
    good += good[:20]  # repeated rows
    bad = [None, [None] + good[0][1:], [math.nan] + good[0][1:], good[1][:-1] + [math.inf], [], good[0][:-1], [1e30] + good[0][1:]]
    rows = [(i, v, 1, "x", 2, 3) for i, v in enumerate(good)] + [(10_000 + i, v, None, None, None, None) for i, v in enumerate(bad)]
    got = whitening.whiten(vectors(spark, rows).repartition(5)).collect()
    far, white, explained = brute_whitening(good)
    assert len(got) == len(good) * 32 and {r.vec_id for r in got} == set(range(len(good)))
    mine = np.zeros_like(white)
    for r in got:
        assert r.n == len(good) and r.deviation == far[r.vec_id] == r.deviation_exact and 0 <= r.identity_error < 1e-10
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-10)
        mine[r.vec_id, r.component - 1] = r.whitened
    sign = np.sign((mine * white).sum(0))
    assert np.abs(mine * sign - white).max() < 1e-7
    assert np.abs(np.cov(mine.T, bias=True) - np.eye(32)).max() < 1e-10


def test_whitening_of_large_entries_is_exact(spark):
    rng = np.random.default_rng(4)
    good = [[float(c) for c in rng.standard_normal(3) * [1e11, 1e3, 1]] for _ in range(60)]
    got = whitening.whiten(vectors(spark, [(i, v, 1, "", 1, 1) for i, v in enumerate(good)], "double")).collect()
    far, _, explained = brute_whitening(good)
    assert {(r.vec_id, int(r.deviation_exact)) for r in got} == set(enumerate(far)) and all(r.deviation is None for r in got)
    assert all(r.explained == pytest.approx(explained[r.component - 1], rel=1e-12) for r in got)


def test_products_of_limbs_are_exact():
    rng = np.random.default_rng(5)
    for bits in (3, 19, 21, 45, 52):
        z = rng.integers(-(1 << bits), 1 << bits, (100, 4))
        assert (whitening.squares(z) == z.astype(object).T @ z.astype(object)).all()


def test_whitening_without_rows_or_variance(spark):
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"]
    for rows in ([], [(1, None, 1, "", 1, 1)], [(1, [], 1, "", 1, 1)], [(i, [1.0, 2.0], 1, "", 1, 1) for i in range(4)]):
        out = whitening.whiten(vectors(spark, rows))
        assert out.columns == columns and out.collect() == []
    flat = [(i, [float(i), 1.0, -float(i)], 1, "", 1, 1) for i in range(10)]  # one direction has all the variance
    got = whitening.whiten(vectors(spark, flat)).collect()
    assert {r.component for r in got} == {1} and len(got) == 10 and got[0].explained == pytest.approx(1.0)
