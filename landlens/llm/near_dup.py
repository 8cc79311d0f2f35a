"""Near-duplicate groups (operator 3): MinHash LSH forest.

1. Sets.  A text's distinct word shingles are hashed to 64 bits; rows with equal
   sets form a class and go on as one (copies are never expanded into pairs).
2. Forest.  Each of ``TREES`` trees orders the classes by its own signature of
   ``DEPTH`` MinHash values.  Classes that agree on a prefix are a region; the depth
   adapts to it: it is ``FIRST`` values, and the whole signature wherever more
   than ``REGION`` classes share those.
3. Candidates.  All pairs of a region of at most ``REGION`` classes.  A region that
   had to grow is sorted by signature in each tree, and every class is a candidate of the
   ``NEIGHBOURS`` that follow it, those with the longest common prefixes; so candidates
   grow with the classes, not with their square.  It is also compared with
   the region's centre: the class whose next value is shared by most, over all trees, as
   that of the original of many copies is.
4. Confirmation.  Candidates whose signatures agree enough are compared on their full
   sets.  A class is compared with the smallest class first; pairs that other links
   have joined meanwhile need no comparison, all others get theirs.
5. Dense regions.  Neighbours and centres join most of a dense region, not all of it.  So all
   pairs of a region that had to grow whose classes are still in different groups are
   compared: its members are dealt to blocks of ``BLOCK``, each pair of blocks is a task's
   tile (the largest group's blocks meet only the others).  A tile drops members that
   agree with none of another group, compares the rest on their full sets, all with
   all, and passes on links that join groups, fewer than it has members.
6. Groups.  Connected components over confirmed links.

For similarity 0.8 a pair shares a prefix of FIRST = 3 values in one of 20 trees with
probability 1 - (1 - 0.8^3)^20 > 0.9999994, and is then compared with it or found in the
same group, whatever the size of the region.  The work in a dense region grows with the
square of the classes that stay outside its largest group.

Defined results: a text without words has the empty set and is linked with nothing;
rows that repeat (or share an id) are rows like any other; a component's id is its
smallest id, null only if all ids are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landlens.session import discard, scratch_path, ship_package

from .components import components
from .numbering import write_ordered
from .words import find_words, hash_words, mix, signed, slices, text_buffer

SHINGLE, PERCENT = 4, 80
TREES, DEPTH, FIRST = 20, 6, 3
REGION = 24
#: Classes that follow a class in the sorted order of a region that had to grow and are compared with it.
NEIGHBOURS = 2
#: Share of equal signature values (of TREES * DEPTH) from which a candidate is compared on full sets: at 0.8, P(Bin(120, 0.8) < 72) = 1.5e-7.
AGREE = 0.6
#: Classes of a dense region on one side of a tile.
BLOCK = 512
#: Shingles that a tile's comparison holds as matrix columns at once.
COLUMNS = 2048
#: Rounds in which each class is compared with one neighbour group at a time, before all that is left is compared.
ROUNDS = 1

_rng = np.random.default_rng(7)
_MUL = _rng.integers(0, 2**63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**63, TREES * DEPTH, dtype=np.uint64)
_PLACE = mix(_rng.integers(1, 2**63, 64, dtype=np.uint64))


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the sorted distinct shingle hashes of text i are hashes[first[i]:first[i + 1]]."""
    data, offsets = text_buffer(texts)
    w = find_words(data, offsets)
    h = hash_words(w, lower=True)
    counts = np.diff(w.first)
    parts, lengths = [], np.zeros(len(counts), np.int64)
    n = len(h)
    runs = np.zeros(n, np.uint64)  # the shingle that starts at each word, where it fits
    for j in range(size):
        runs[: n - j] += h[j:] * _PLACE[j] if j else h * _PLACE[0]
    runs = mix(runs)
    for i, (a, k) in enumerate(zip(w.first[:-1].tolist(), counts.tolist())):
        if k >= size:
            own = np.unique(runs[a:a + k - size + 1])
        elif k:
            own = mix((h[a:a + k] * _PLACE[:k]).sum(dtype=np.uint64, keepdims=True) + np.uint64(k))
        else:
            continue
        parts.append(own)
        lengths[i] = len(own)
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum(lengths)])


def signatures(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """MinHash values (32 bits) of each set, a row a set; sets must not be empty."""
    out = np.empty((len(first) - 1, TREES * DEPTH), np.uint32)
    for k in range(TREES * DEPTH):
        out[:, k] = np.minimum.reduceat(hashes * _MUL[k] + _ADD[k], first[:-1]) >> np.uint64(32)
    return out


def _measure(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                hashes, first = shingle_sets(part.column("text"), size)
                n = np.diff(first)
                has = n > 0
                cls, sign = np.zeros(len(n), np.int64), [None] * len(n)
                if has.any():
                    own = np.concatenate([first[:-1][has], [len(hashes)]])
                    cls[has] = _class_of(hashes, own)
                    for i, row in zip(np.flatnonzero(has), signatures(hashes, own)):
                        sign[i] = row.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(n.astype(np.int64)), pa.array(cls, mask=~has), pa.array(sign, pa.binary())],
                    names=["id", "n", "cls", "sign"])
    return run


def _tree_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each class and tree: key (tree and the first FIRST values), tail (the other values, 21 bits each), cls."""
    for batch in batches:
        if not batch.num_rows:
            continue
        v = np.frombuffer(b"".join(batch.column("sign").to_pylist()), np.uint32).reshape(batch.num_rows, TREES, DEPTH).astype(np.uint64)
        key = mix(np.arange(TREES, dtype=np.uint64) + np.uint64(1))[None, :]
        for d in range(FIRST):
            key = mix(key ^ v[:, :, d] * _PLACE[d + 16])
        tail = np.zeros(key.shape, np.uint64)
        for d in range(FIRST, DEPTH):
            tail |= (v[:, :, d] >> np.uint64(11)) << np.uint64(21 * (d - FIRST))
        cls = np.repeat(batch.column("cls").to_numpy(), TREES)
        yield pa.RecordBatch.from_arrays([pa.array(signed(key.ravel())), pa.array(signed(tail.ravel())), pa.array(cls)], names=["key", "tail", "cls"])


def _pairs(regions: DataFrame) -> DataFrame:
    """a < b of all classes that share a key; regions (key, cls) hold at most about REGION classes each."""
    lists = regions.groupBy("key").agg(F.collect_set("cls").alias("l"))
    pair = F.flatten(F.transform("l", lambda x, i: F.transform(F.slice("l", i + 2, F.size("l")), lambda y: F.struct(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")))))
    return lists.where(F.size("l") > 1).select(F.explode(pair).alias("p")).select("p.a", "p.b")


def _value(d: int) -> Column:
    """The signature's value ``d`` (counted from 0) out of tail."""
    return F.call_function("shiftright", F.col("tail"), F.lit(21 * (d - FIRST))).bitwiseAND(F.lit((1 << 21) - 1))


def _neighbours(ordered: DataFrame) -> DataFrame:
    """a < b of each class and the ``NEIGHBOURS`` that follow it in its region; ``ordered`` by (top, signature) in parts of bounded size."""
    here, one = Window.partitionBy("part").orderBy("at"), F.struct("top", "cls")
    follow = ordered.withColumns({f"n{k}": F.lead(one, k).over(here) for k in range(1, NEIGHBOURS + 1)})
    follow = follow.select("top", "cls", F.explode(F.array(*[f"n{k}" for k in range(1, NEIGHBOURS + 1)])).alias("next"))
    # the last of a part and the first of the next one: a row a part
    seams = ordered.groupBy("part").agg(F.max_by(one, "at").alias("last"), F.min_by(one, "at").alias("first"))
    seams = seams.select("last.top", "last.cls", F.lead("first").over(Window.orderBy("part")).alias("next"))
    pairs = follow.unionAll(seams).where(F.col("top") == F.col("next.top"))
    return pairs.select(F.least("cls", "next.cls").alias("a"), F.greatest("cls", "next.cls").alias("b")).where("a <> b")


def candidates(classes: DataFrame, base: str) -> tuple[DataFrame, DataFrame | None]:
    """Distinct pairs a < b of neighbours in the forest, and top, cls of the regions that had to grow (null if none); ``classes``: cls, sign."""
    spark = classes.sparkSession
    classes.mapInArrow(_tree_rows, "key bigint, tail bigint, cls bigint").write.parquet(f"{base}/regions")
    rows = spark.read.parquet(f"{base}/regions")
    many = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows.join(many, "key").write.parquet(f"{base}/regions-shared")
    now = spark.read.parquet(f"{base}/regions-shared")
    found, grown = [_pairs(now.where(F.col("n") <= REGION))], None
    dense = now.where(F.col("n") > REGION)
    if not dense.isEmpty():
        values = [f"v{d}" for d in range(FIRST, DEPTH)]
        dense = dense.select(F.col("key").alias("top"), *[_value(d).alias(v) for d, v in zip(range(FIRST, DEPTH), values)], F.xxhash64("cls", "key").alias("tie"), "cls")
        grown = write_ordered(dense, ["top"], [*values, "tie"], f"{base}/grown")
        found.append(_neighbours(grown))
        # centre of a region: the class that shares its next value with most classes, over all trees, as the original of many copies does
        full = grown.groupBy("top", values[0]).agg(F.count(F.lit(1)).alias("n"))
        votes = grown.join(full, ["top", values[0]]).groupBy("cls").agg(F.sum("n").alias("votes"))
        centre = grown.join(votes, "cls").groupBy("top").agg(F.max(F.struct("votes", "cls")).alias("x")).select("top", F.col("x.cls").alias("c"))
        centre.write.parquet(f"{base}/centres")  # a row a region: the join below is then free to split a hot region
        centre = spark.read.parquet(f"{base}/centres")
        grown = grown.select("top", "cls")
        found.append(grown.join(centre, "top").where("cls <> c").select(F.least("cls", "c").alias("a"), F.greatest("cls", "c").alias("b")))
    out = found[0]
    for f in found[1:]:
        out = out.unionAll(f)
    return out.distinct(), grown


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("sa", "sb"))
        near = (x == y).mean(1) >= AGREE
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(near))


def _low_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            v = np.frombuffer(b"".join(batch.column("sign").to_pylist()), np.uint8).reshape(batch.num_rows, -1)[:, ::4]
            yield pa.RecordBatch.from_arrays([batch.column("cls"), pa.array([r.tobytes() for r in v], pa.binary())], names=["cls", "sketch"])


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("xa").to_pylist(), batch.column("xb").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    good.append(False)
                    continue
                every = np.sort(np.concatenate([x, y]))
                both = int((every[1:] == every[:-1]).sum())
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["u", "v"]).filter(pa.array(good, pa.bool_()))
    return run


def _class_of(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """64 bits that name each set (sets must not be empty): two sums over its hashes and its size, mixed."""
    at = first[:-1]
    one, two = np.add.reduceat(hashes, at), np.add.reduceat(mix(hashes ^ _PLACE[9]), at)
    return signed(mix(one ^ mix(two + np.diff(first).astype(np.uint64))))


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # repeated rows of one id arrive in one task
        for batch in batches:
            for part in slices(batch, "text"):
                hashes, first = shingle_sets(part.column("text"), size)
                has = np.flatnonzero(np.diff(first))
                if not len(has):
                    continue
                cls = _class_of(hashes, np.concatenate([first[has], [len(hashes)]]))
                new = [(c, i) for c, i in zip(cls.tolist(), has) if not (c in seen or seen.add(c))]
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in new], pa.int64()), pa.array([hashes[first[i]:first[i + 1]].tobytes() for _, i in new], pa.binary())],
                                                 names=["cls", "set"])
    return run


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int, path: str) -> DataFrame:
    one = pairs.join(sets.select(F.col("cls").alias("a"), F.col("set").alias("xa")), "a")
    two = one.join(sets.select(F.col("cls").alias("b"), F.col("set").alias("xb")), "b").select("a", "b", "xa", "xb")
    two.mapInArrow(_linked(percent), "u bigint, v bigint").write.parquet(path)
    return pairs.sparkSession.read.parquet(path)


def _links(pairs: DataFrame, sets: DataFrame, percent: int, base: str) -> tuple[DataFrame | None, DataFrame | None]:
    """node, root over all confirmed links (null if there are none), and the links."""
    spark = pairs.sparkSession
    roots, links, left = None, None, pairs
    for turn in range(ROUNDS + 1):
        if left.isEmpty():
            break
        if turn < ROUNDS:  # each class with its smallest candidate, one for each group it could join
            chosen = left.groupBy("b", "ra").agg(F.min("a").alias("a")).select("a", "b") if roots is not None else left.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
        else:
            chosen = left.select("a", "b")
        chosen.write.parquet(f"{base}/chosen-{turn}")
        chosen = spark.read.parquet(f"{base}/chosen-{turn}")
        new = _confirm(chosen, sets, percent, f"{base}/links-{turn}")
        links = new if links is None else links.unionAll(new)
        if links.isEmpty():
            roots = None
        else:
            roots = components(links)
        if turn == ROUNDS:
            break
        left = left.select("a", "b").join(chosen, ["a", "b"], "left_anti")
        if roots is not None:
            for c in ("a", "b"):
                left = left.join(roots.select(F.col("node").alias(c), F.col("root").alias(f"r{c}")), c, "left").withColumn(f"r{c}", F.coalesce(f"r{c}", c))
            left = left.where("ra <> rb")
        left.write.parquet(f"{base}/left-{turn}")
        left = spark.read.parquet(f"{base}/left-{turn}")
    return roots, links


def _sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a tile's two sides; a block's tile with itself has the same rows on both."""
    side = table["side"].to_numpy()
    one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    return (one, one) if table["own"][0].as_py() else (one, two)


def _live(table: pa.Table) -> pa.Table:
    """Members of a tile whose sketch agrees with one of another group on the other side."""
    table = table.sort_by("cls")
    one, two = _sides(table)
    sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(table.num_rows, -1)
    root = table["root"].to_numpy()
    live = np.zeros(table.num_rows, bool)
    other, least = np.ascontiguousarray(sketch[two].T), AGREE * TREES * DEPTH
    for i in one:
        near = two[((other == sketch[i][:, None]).sum(0, dtype=np.uint8) >= least) & (root[two] != root[i])]
        live[near] = True
        live[i] |= len(near) > 0
    return table.select(["tile", "own", "side", "cls", "root"]).filter(pa.array(live))


def _joining(percent: int):
    def run(table: pa.Table) -> pa.Table:
        """Links of a tile's members, compared on their full sets, that join their groups to one another."""
        table = table.sort_by("cls")
        one, two = _sides(table)
        sets = [np.frombuffer(s, np.uint64) for s in table["set"].to_pylist()]
        size = np.array([len(s) for s in sets])
        of = np.repeat(np.arange(len(sets)), size)
        _, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = often[column] > 1
        of, column = of[shared], np.unique(column[shared], return_inverse=True)[1]
        order = np.argsort(column, kind="stable")
        of, column = of[order], column[order]
        both = np.zeros((len(one), len(two)), np.float32)
        for c in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
            a, b = np.searchsorted(column, [c, c + COLUMNS])
            has = np.zeros((len(sets), COLUMNS), np.float32)
            has[of[a:b], column[a:b] - c] = 1
            both += has[one] @ has[two].T
        both = both.astype(np.int64)
        root, cls = table["root"].to_numpy(), table["cls"].to_numpy()
        link = (100 * both >= percent * (size[one][:, None] + size[two][None, :] - both)) & (root[one][:, None] != root[two][None, :])
        parent = {r: r for r in root.tolist()}

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        out = []
        for i, j in zip(*(x.tolist() for x in np.nonzero(link))):
            u, v = find(int(root[one[i]])), find(int(root[two[j]]))
            if u != v:
                parent[u] = v
                out.append((cls[one[i]], cls[two[j]]))
        return pa.table({"u": pa.array([u for u, _ in out], pa.int64()), "v": pa.array([v for _, v in out], pa.int64())})
    return run


def _dense_links(grown: DataFrame, roots: DataFrame | None, sketch: DataFrame, sets: DataFrame, percent: int, base: str) -> DataFrame:
    """u, v: links that join the groups ``roots`` within regions that had to grow; ``grown``: top, cls."""
    spark = grown.sparkSession
    rows = grown.withColumn("root", F.col("cls"))
    if roots is not None:
        rows = grown.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    # a row a region of several groups: its largest group and how many blocks the others and this one have
    regions = rows.groupBy("top", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("top").agg(F.max(F.struct("n", "root")).alias("x"), F.sum("n").alias("n"))
    blocks = (F.ceil((F.col("n") - F.col("x.n")) / BLOCK).cast("int").alias("few"), F.ceil(F.col("x.n") / BLOCK).cast("int").alias("many"))
    regions.where(F.col("n") > F.col("x.n")).select("top", F.col("x.root").alias("main"), *blocks).write.parquet(f"{base}/dense-regions")
    rows = rows.join(spark.read.parquet(f"{base}/dense-regions"), "top").withColumn("large", F.col("root") == F.col("main"))
    rows = rows.withColumn("at", F.pmod(F.xxhash64("cls"), F.when(F.col("large"), F.col("many")).otherwise(F.col("few"))).cast("int"))

    def tile(kind: int, i, j, side):
        own = (F.lit(kind) == 0) & (i == j)
        return F.struct(F.xxhash64("top", F.lit(kind), i, j).alias("tile"), own.alias("own"), side.alias("side"))

    at, none, one = F.col("at"), F.lit(0), F.lit(1)
    among = F.transform(F.sequence(none, F.col("few") - 1), lambda j: tile(0, F.least(at, j), F.greatest(at, j), F.when(at <= j, none).otherwise(one)))
    across = F.transform(F.sequence(none, F.col("many") - 1), lambda j: tile(1, at, j, none))
    tiles = F.when(F.col("large"), F.transform(F.sequence(none, F.col("few") - 1), lambda i: tile(1, i, at, one))).otherwise(F.concat(among, across))
    rows = rows.select("cls", "root", F.explode(tiles).alias("t")).select("t.tile", "t.own", "t.side", "cls", "root")
    schema = "tile bigint, own boolean, side int, cls bigint, root bigint"
    rows.join(sketch, "cls").groupBy("tile").applyInArrow(_live, schema).write.parquet(f"{base}/live")
    live = spark.read.parquet(f"{base}/live")
    live.join(sets, "cls").groupBy("tile").applyInArrow(_joining(percent), "u bigint, v bigint").write.parquet(f"{base}/dense-links")
    return spark.read.parquet(f"{base}/dense-links")


def group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, cls (class of equal sets; null for the empty one) of every row."""
    spark = docs.sparkSession
    ship_package(spark)
    base = scratch_path(spark, "near-dup")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"))
    kind = dict(rows.dtypes)["id"]
    rows.mapInArrow(_measure(size), f"id {kind}, n bigint, cls bigint, sign binary").write.parquet(f"{base}/rows")
    rows = spark.read.parquet(f"{base}/rows")
    member = rows.select("id", "n", "cls")
    least = member.where("cls is not null").groupBy("cls").agg(F.min("id").alias("least"))
    classes = rows.where("cls is not null").dropDuplicates(["cls"]).select("cls", "sign")
    classes.write.parquet(f"{base}/classes")
    classes = spark.read.parquet(f"{base}/classes")

    sketch = classes.mapInArrow(_low_bytes, "cls bigint, sketch binary")
    pairs, grown = candidates(classes, base)
    pairs = pairs.join(sketch.select(F.col("cls").alias("a"), F.col("sketch").alias("sa")), "a").join(sketch.select(F.col("cls").alias("b"), F.col("sketch").alias("sb")), "b")
    pairs.select("a", "b", "sa", "sb").mapInArrow(_agreeing, "a bigint, b bigint").write.parquet(f"{base}/pairs")
    pairs = spark.read.parquet(f"{base}/pairs")
    if grown is not None:
        sketch.join(grown.select("cls").distinct(), "cls", "left_semi").write.parquet(f"{base}/dense-sketches")
    discard(spark, *(f"{base}/{name}" for name in ("classes", "centres", "regions", "regions-shared")))

    # full sets, computed again for one row of each class that has a candidate or is in a dense region
    needed = pairs.select(F.col("a").alias("cls")).unionAll(pairs.select("b"))
    if grown is not None:
        needed = needed.unionAll(grown.select("cls"))
    needed = needed.distinct().join(least, "cls").select("least").distinct()
    source = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text")).join(needed, F.col("id").eqNullSafe(F.col("least")), "left_semi")
    sets = source.select("text").mapInArrow(_sets(size), "cls bigint, set binary")
    sets.write.parquet(f"{base}/sets")
    sets = spark.read.parquet(f"{base}/sets")
    roots, links = _links(pairs, sets, percent, base)
    if grown is not None:
        more = _dense_links(grown, roots, spark.read.parquet(f"{base}/dense-sketches"), sets, percent, base)
        if not more.isEmpty():
            roots = components(more if links is None else links.unionAll(more))

    if roots is None:
        named = least.select("cls", F.col("least").alias("component"))
    else:
        named = least.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
        smallest = named.groupBy("root").agg(F.min("least").alias("component"))
        named = named.join(smallest, "root").select("cls", "component")
    out = member.join(named, "cls", "left").select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"), "cls")
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", "n_shingles", "component_id", "kept", "cls")
