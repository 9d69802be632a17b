"""Embedding near-duplicates by sorted projection passes (operator 6).

Copies of one vector become one class with a weight. In each pass, classes are ordered by the concatenated signs of random projections,
and each is compared with a bounded window of neighbours in that order by cosine in double precision. What is near in angle shares long
beginnings of the signs, so it stands close in most passes. Pairs of at least the threshold are united within a task; the union over all
passes gives components.

A pair at the threshold agrees in one sign with a known probability. With n classes and windows of W, a window should reach all that
share depth = log2(n / W) + 1 signs, so that number tells how many passes leave a pair apart with a probability of at most MISS; a
quarter more are made. Where vectors are dense, windows reach less far. Each class therefore counts the passes in which its window did
not reach all that share so many signs (the order tells that exactly, borders of tasks included). Classes with too many such passes
are dense: they are compared with each other in blocks, after which no link but those of that probability is lost, whatever the rows,
their distribution, the passes and the window. Blocks that are one component already, or whose centres and radii rule the threshold
out, are passed over. The price of dense regions is work that grows with the square of their classes; memory and disk do not.

Once components are known, every member's links inside its component are counted exactly: members within half the threshold's angle of
the component's mean are linked to one another by the triangle inequality and are counted without being compared; the others are
compared with every member, in blocks ordered along one pass, which are passed over or counted whole where their centres and radii
decide. No partner is left out and nothing is capped.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components have no links and stand for themselves; so
do vectors of different lengths against each other; very long vectors count whole; ties at the threshold are links; rows of one id that
can have links count as one vector for components, each with its own links; null ids have no links, a null component and are kept; extra
columns are dropped, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.shared import BROADCAST_ROWS, Forest, components, links_batch, put_file, shared_dir, stored, tidy, ties_of_repeated

WINDOW = 512
BITS = 62
#: Probability that a pair at the threshold is in no window that should reach it.
MISS = 1e-6
#: Bytes of the vectors of a block, and rows of it that are compared at once.
BLOCK_BYTES = 4 << 20
STRIP = 512
#: Members from which on a component's mean is broadcast, if no more than BROADCAST_ROWS are so large.
LARGE = 4096


def plan(n: int, least: float, window: int) -> tuple[int, int]:
    """(signs that a window should reach, passes needed for MISS) for n classes."""
    depth = max(0, math.ceil(math.log2(max(1, n) / window))) + 1
    apart = 1 - (1 - math.acos(least) / math.pi) ** depth
    return depth, max(1, math.ceil(math.log(MISS) / math.log(apart)))


def raw_rows(column: pa.Array) -> list[bytes | None]:
    """The bytes of each vector's numbers; None where it can have no links."""
    out: list[bytes | None] = []
    for x in column:
        v = x.values.to_numpy(zero_copy_only=False) if x.is_valid and len(x.values) and x.values.null_count == 0 else None
        out.append(v.tobytes() if v is not None and np.isfinite(v).all() and v.any() else None)
    return out


def unit(raw: list[bytes], dim: int) -> np.ndarray:
    """Vectors of length one in double precision, from their numbers' bytes."""
    size = len(raw[0]) // dim if raw else 8
    x = np.frombuffer(b"".join(raw), "<f4" if size == 4 else "<f8").reshape(-1, dim).astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    x /= np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
    return x


_planes: dict[tuple[int, int], np.ndarray] = {}


def planes(dim: int, number: int) -> np.ndarray:
    if (dim, number) not in _planes:
        _planes[dim, number] = np.random.Generator(np.random.PCG64([dim, number, 99])).standard_normal((dim, BITS))
    return _planes[dim, number]


def sort_keys(x: np.ndarray, number: int) -> np.ndarray:
    """A pass's keys: signs of projections, concatenated."""
    return ((x @ planes(x.shape[1], number)) >= 0) @ (2 ** np.arange(BITS - 1, -1, -1, dtype=np.int64))


def units(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(id, dim, key, v) of each row: the numbers of a vector that can have links as bytes, and its key of the first pass; else nulls."""
    kind = vectors.select(embedding).dtypes[0][1]
    to = "array<float>" if kind == "array<float>" else "array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = raw_rows(batch.column(1))
            dims, keys = [None] * len(raw), [None] * len(raw)
            by_dim: dict[int, list[int]] = {}
            for i, v in enumerate(raw):
                if v is not None:
                    dims[i] = len(batch.column(1)[i].values)
                    by_dim.setdefault(dims[i], []).append(i)
            for dim, rows in by_dim.items():
                for i, key in zip(rows, sort_keys(unit([raw[i] for i in rows], dim), 0).tolist(), strict=True):
                    keys[i] = key
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(dims, pa.int32()), pa.array(keys, pa.int64()), pa.array(raw, pa.binary())], ["id", "dim", "key", "v"])

    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.when(F.col(vec_id).isNotNull(), F.col(embedding).cast(to)).alias("v"))
    return rows.mapInArrow(tidy(run), "id long, dim int, key long, v binary")


def _keys(classes: DataFrame, passes: range) -> DataFrame:
    """Each class once a pass, with the pass's sort key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                x = unit(part.column(2).to_pylist(), dim)
                for p in passes:
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), p, np.int32)), part.column(1), pa.array(sort_keys(x, p)), part.column(0), part.column(2)], ["pass", "dim", "key", "id", "v"])

    return classes.select("id", "dim", "v").mapInArrow(tidy(run), "pass int, dim int, key long, id long, v binary")


def _shared_signs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Signs that keys have in common from the first on."""
    out, x = np.full(len(a), BITS), a ^ b
    there = x > 0
    # A double may round a key up to the next power of two; the bits of its halves tell exactly.
    high = x[there] >> 31
    part = np.where(high > 0, high, x[there])
    out[there] = BITS - (np.floor(np.log2(part.astype(np.float64))).astype(np.int64) + 1 + np.where(high > 0, 31, 0))
    return out


def _short(keys: np.ndarray, window: int, depth: int, first: bool, last: bool) -> np.ndarray:
    """Whether windows do not reach all that share depth signs, for sorted keys of one pass; first and last: nothing lies beyond."""
    n = len(keys)
    if not n:
        return np.zeros(0, bool)
    at = np.arange(n)
    # What lies beyond the first key that is out of reach shares no more signs than that key.
    back, ahead = np.maximum(at - window - 1, 0), np.minimum(at + window + 1, n - 1)
    out = (_shared_signs(keys, keys[back]) >= depth) & ~(first & (at <= window))
    return out | (_shared_signs(keys, keys[ahead]) >= depth) & ~(last & (at >= n - 1 - window))


def _unite(ids: np.ndarray, i: np.ndarray, j: np.ndarray, forest: Forest) -> None:
    """Puts the pairs of places (i, j) into the forest; each round joins one pair of a place, until all are within one tree."""
    places, both = np.unique(np.r_[i, j], return_inverse=True)
    i, j = both[: len(i)], both[len(i) :]
    names = ids[places].tolist()
    while len(i):
        roots = np.array([forest.find(x) for x in names], np.int64)
        apart = roots[i] != roots[j]
        i, j = i[apart], j[apart]
        _, one = np.unique(i, return_index=True)
        for a, b in zip(i[one].tolist(), j[one].tolist(), strict=True):
            forest.link(names[a], names[b])


def _windows(keyed: DataFrame, least: float, window: int, depth: int) -> DataFrame:
    """Links (a, b) that windows of sorted neighbours give, a forest of each pass in a task; (a, null) where a's window is short."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, group, tail_ids, tail_x = Forest(), None, None, None
        ids_of, keys_of, groups = [], [], 0

        def close(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal ids_of, keys_of, groups, forest
            if ids_of:
                ids, keys = np.concatenate(ids_of), np.concatenate(keys_of)
                short = ids[_short(keys, window, depth, groups > 0, last)]
                yield pa.RecordBatch.from_arrays([pa.array(short), pa.nulls(len(short), pa.int64())], ["a", "b"])
            if forest.links:
                yield links_batch(forest.links)
            ids_of, keys_of, groups, forest = [], [], groups + 1, Forest()

        for batch in batches:
            p, dims, keys, ids = (batch.column(c).to_numpy() for c in range(4))
            heads = np.r_[0, np.flatnonzero((p[1:] != p[:-1]) | (dims[1:] != dims[:-1])) + 1, len(ids)]
            for lo, hi in zip(heads[:-1].tolist(), heads[1:].tolist(), strict=True):
                if hi == lo:
                    continue
                mine = int(p[lo]), int(dims[lo])
                if group is not None and mine != group:
                    yield from close(True)
                    tail_ids = None
                x, own, new = unit(batch.column(4).slice(lo, hi - lo).to_pylist(), mine[1]), ids[lo:hi], 0
                ids_of.append(own)
                keys_of.append(keys[lo:hi])
                if tail_ids is not None:
                    own, x, new = np.r_[tail_ids, own], np.vstack([tail_x, x]), len(tail_ids)
                for at in range(new, len(own), 256):
                    upto, back = min(at + 256, len(own)), max(0, at - window)
                    i, j = np.nonzero(x[at:upto] @ x[back:upto].T >= least)
                    i, j = i + at, j + back
                    near = (j < i) & (i - j <= window)
                    if near.any():
                        _unite(own, i[near], j[near], forest)
                group, tail_ids, tail_x = mine, own[-window:], x[-window:]
        yield from close(False)

    placed = keyed.repartitionByRange("pass", "dim", "key", "id").sortWithinPartitions("pass", "dim", "key", "id")
    return placed.mapInArrow(tidy(run), "a long, b long")


class Block(NamedTuple):
    """A file of vectors in the order of component and key: its lowest and highest component, the centre, and the greatest angle to it."""

    dim: int
    n: int
    uri: str
    low: int
    high: int
    centre: tuple[float, ...]
    radius: float

    def angle(self, other: Block) -> float:
        return math.acos(max(-1.0, min(1.0, sum(a * b for a, b in zip(self.centre, other.centre, strict=True)))))


def _put_blocks(spark: SparkSession, rows: DataFrame, block_bytes: int) -> list[Block]:
    """rows (dim, component, key, id, at, weight, core, v) as files; their list is a row for each block_bytes of vectors."""
    folder = shared_dir(spark, "blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, dim = [], None

        def put() -> pa.RecordBatch:
            comps, ids, at, weights, core, raw = (list(c) for c in zip(*held, strict=True))
            uri, x = f"{folder}/{uuid.uuid4().hex}", unit(raw, dim)
            centre = x.sum(0)
            size = np.sqrt(centre @ centre)
            centre = centre / size if size > 0 else np.eye(1, dim)[0]
            radius = float(np.arccos(np.clip((x @ centre).min(), -1, 1)))
            head = np.array([comps, ids, at, weights, core], np.int64)
            put_file(uri, head.tobytes() + x.tobytes())
            held.clear()
            return pa.RecordBatch.from_pydict({
                "dim": pa.array([dim], pa.int32()), "n": pa.array([len(ids)], pa.int64()), "uri": [uri], "low": pa.array([min(comps)], pa.int64()),
                "high": pa.array([max(comps)], pa.int64()), "centre": pa.array([centre.tolist()], pa.list_(pa.float64())), "radius": [radius],
            })

        for batch in batches:
            for d, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (d != dim or len(held) * dim * 8 >= block_bytes):
                    yield put()
                dim = d
                held.append(row)
        if held:
            yield put()

    total = rows.agg(F.sum(F.col("dim").cast("long") * 8)).first()[0] or 1
    order = ["dim", "component", "key", "at"]
    placed = rows.select(*order, "id", "weight", F.col("core").cast("int").alias("core"), "v").repartitionByRange(max(1, math.ceil(total / block_bytes)), *order).sortWithinPartitions(*order)
    placed = placed.select("dim", "component", "id", "at", "weight", "core", "v")
    listed = stored(spark, placed.mapInArrow(tidy(run), "dim int, n long, uri string, low long, high long, centre array<double>, radius double"), "block-list")
    return sorted(Block(*r[:5], tuple(r[5]), r[6]) for r in listed.collect())


def _block(b: Block) -> tuple[np.ndarray, np.ndarray]:
    """The numbers (component, id, at, weight, core) and the vectors of a block."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(b.uri)
    with store.open_input_file(path) as f:
        data = f.read()
    return np.frombuffer(data, np.int64, 5 * b.n).reshape(5, b.n), np.frombuffer(data, np.float64, b.n * b.dim, 40 * b.n).reshape(b.n, b.dim)


def _by_dim(blocks: list[Block]) -> tuple[dict[int, list[Block]], list[tuple[int, int]]]:
    own: dict[int, list[Block]] = {}
    for b in blocks:
        own.setdefault(b.dim, []).append(b)
    return own, [(dim, i) for dim, mine in sorted(own.items()) for i in range(len(mine))]


def _each_block(spark: SparkSession, number: int) -> DataFrame:
    return spark.range(0, number, 1, max(1, min(number, 20_000)))


def _missed(spark: SparkSession, blocks: list[Block], least: float) -> DataFrame:
    """Links (a, b) between different components, found by comparing the blocks; a task's links are a forest.

    Each block meets itself and the next half of the blocks in a circle, so each pair of blocks meets and all blocks have the same work.
    """
    known, limit = spark.sparkContext.broadcast(_by_dim(blocks)), math.acos(least) + 1e-6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_dim, first = known.value
        for batch in batches:
            for number in batch.column(0).to_pylist():
                dim, i = first[number]
                own, forest, mine = by_dim[dim], Forest(), None
                roots = lambda c: np.array([forest.find(u) for u in c.tolist()], np.int64)  # noqa: B023, E731
                for step in range(len(own) // 2 + 1):
                    other = own[(i + step) % len(own)]
                    if own[i].low == own[i].high == other.low == other.high or own[i].angle(other) - own[i].radius - other.radius > limit:
                        continue
                    if mine is None:
                        head, x = _block(own[i])
                        mine, single = head[0], x.astype(np.float32)
                    head, y = _block(other) if step else (head, x)
                    comps, others, turned = roots(mine), roots(head[0]), y.astype(np.float32).T
                    for lo in range(0, len(x), STRIP):
                        # Single precision only picks what double precision then decides; one link for two components is enough.
                        p, q = np.nonzero(single[lo : lo + STRIP] @ turned >= least - 1e-4)
                        apart, before = comps[lo + p] != others[q], len(forest.links)
                        p, q = lo + p[apart], q[apart]
                        for at in range(0, len(p), 8192):
                            a, b = p[at : at + 8192], q[at : at + 8192]
                            near = np.einsum("ij,ij->i", x[a], y[b]) >= least
                            for u, v in set(zip(comps[a[near]].tolist(), others[b[near]].tolist(), strict=True)):
                                forest.link(u, v)
                        if len(forest.links) > before:
                            comps, others = roots(mine), roots(head[0])
                if forest.links:
                    yield links_batch(forest.links)

    return _each_block(spark, len(known.value[1])).mapInArrow(tidy(run), "a long, b long")


def _open_counts(spark: SparkSession, blocks: list[Block], least: float) -> DataFrame:
    """(at, n): for each class the weights linked to it within its component, but for those of two core members and its own."""
    known, limit = spark.sparkContext.broadcast(_by_dim(blocks)), math.acos(least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_dim, first = known.value
        for batch in batches:
            for number in batch.column(0).to_pylist():
                dim, i = first[number]
                own = by_dim[dim]
                head, x = _block(own[i])
                comps, at, core = head[0], head[2], head[4].astype(bool)
                count = np.zeros(own[i].n, np.int64)
                for j, other in enumerate(own):
                    if other.high < own[i].low or other.low > own[i].high:
                        continue
                    between, reach = own[i].angle(other), own[i].radius + other.radius
                    if between - reach > limit + 1e-6:
                        continue
                    theirs, y = (head, x) if j == i else _block(other)
                    weights, is_core = theirs[3], theirs[4].astype(bool)
                    if own[i].low == own[i].high == other.low == other.high and between + reach < limit - 1e-6:
                        count += np.where(core, weights[~is_core].sum(), weights.sum())
                    else:
                        for lo in range(0, len(x), STRIP):
                            part = slice(lo, lo + STRIP)
                            near = (x[part] @ y.T >= least) & (comps[part, None] == theirs[0]) & ~(core[part, None] & is_core)
                            if j == i:
                                near[np.arange(near.shape[0]), lo + np.arange(near.shape[0])] = ~core[part]
                            count[part] += near @ weights
                    if j == i:
                        count -= np.where(core, 0, weights)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(count)], ["at", "n"])

    return _each_block(spark, len(known.value[1])).mapInArrow(tidy(run), "at long, n long")


def _with_mean(placed: DataFrame, mean: DataFrame) -> DataFrame:
    """placed with its component's mean; the means of large components are broadcast if they are few, so that no task gets all members."""
    key = ["component", "dim"]
    large = mean.where(F.col("size") >= LARGE)
    if not 0 < large.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return placed.join(mean.hint("merge"), key)
    few = F.broadcast(large.select(*key))
    small = placed.join(few, key, "left_anti").join(mean.where(F.col("size") < LARGE).hint("merge"), key)
    return small.unionByName(placed.join(F.broadcast(large), key))


def _counts(spark: SparkSession, classes: DataFrame, parts: DataFrame, least: float, block_bytes: int) -> DataFrame:
    """(at, n): for each class of a component the weights of the classes in it that are linked to it, without its own."""
    placed = stored(spark, classes.join(parts, "id").select("component", "dim", "key", "id", "at", "weight", "v"), "members")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            comp, dims = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            order = np.lexsort((dims, comp))
            heads = np.r_[0, np.flatnonzero((comp[order][1:] != comp[order][:-1]) | (dims[order][1:] != dims[order][:-1])) + 1]
            rows, out = batch.column(6).to_pylist(), []
            for g in np.split(order, heads[1:]):
                out.append((int(comp[g[0]]), int(dims[g[0]]), unit([rows[i] for i in g], int(dims[g[0]])).sum(0).tolist(), len(g)))
            c, d, v, n = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(d, pa.int32()), pa.array(v, pa.list_(pa.float64())), pa.array(n, pa.int64())], ["component", "dim", "total", "n"])

    partial = stored(spark, placed.mapInArrow(tidy(sums), "component long, dim int, total array<double>, n long"), "sums")
    size = partial.groupBy("component", "dim").agg(F.sum("n").alias("size"))
    mean = partial.select("component", "dim", F.posexplode("total")).groupBy("component", "dim", "pos").agg(F.sum("col").alias("x"))
    mean = mean.groupBy("component", "dim").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias("mean"))
    mean = stored(spark, mean.join(size, ["component", "dim"]), "means")
    half = math.cos(math.acos(least) / 2 - 1e-6)

    def core(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inside = []
            for v, d, m in zip(batch.column(6).to_pylist(), batch.column(1).to_pylist(), batch.column(7), strict=True):
                mean = m.values.to_numpy()
                size = np.sqrt((mean * mean).sum())
                inside.append(bool(size > 0 and unit([v], d)[0] @ mean >= half * size))
            yield pa.RecordBatch.from_arrays([*batch.columns[:7], pa.array(inside)], ["component", "dim", "key", "id", "at", "weight", "v", "core"])

    marked = _with_mean(placed, mean).select("component", "dim", "key", "id", "at", "weight", "v", "mean")
    marked = stored(spark, marked.mapInArrow(tidy(core), "component long, dim int, key long, id long, at long, weight long, v binary, core boolean"), "marked")
    shape = marked.groupBy("component", "dim").agg(F.sum(F.when(F.col("core"), F.col("weight"))).alias("all"), F.count_if(~F.col("core")).alias("others"))
    shape = stored(spark, shape, "shape")
    inner = marked.where("core").join(shape, ["component", "dim"]).select("at", (F.col("all") - F.col("weight")).alias("n"))
    wide = shape.where("others > 0").select("component", "dim")
    if wide.isEmpty():
        return inner
    blocks = _put_blocks(spark, marked.join(wide, ["component", "dim"], "left_semi"), block_bytes)
    return inner.unionAll(_open_counts(spark, blocks, least)).groupBy("at").agg(F.sum("n").alias("n"))


def link(spark: SparkSession, vectors: DataFrame, least: float = 0.95, passes: int | None = None, window: int = WINDOW, vec_id: str = "vec_id", embedding: str = "embedding", passes_at_once: int = 8, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of vectors. passes: a quarter more than plan() needs, if not given."""
    rows = units(vectors, vec_id, embedding)
    rows = stored(spark, rows.withColumns({"k1": F.when(F.col("v").isNotNull(), F.xxhash64("v")), "k2": F.when(F.col("v").isNotNull(), F.xxhash64("v", F.lit(7)))}), "units")
    classes = rows.where("v is not null").groupBy("k1", "k2").agg(F.min(F.struct("id", "dim", "key", "v")).alias("x"), F.count("*").alias("weight"))
    classes = stored(spark, classes.select("k1", "k2", "x.*", "weight", F.monotonically_increasing_id().alias("at")), "classes")
    depth, needed = plan(classes.count(), least, window)
    passes = math.ceil(1.25 * needed) if passes is None else passes
    found = None
    for first in range(0, passes, passes_at_once):
        links = stored(spark, _windows(_keys(classes, range(first, min(first + passes_at_once, passes))), least, window, depth), "links")
        found = links if found is None else found.unionAll(links)
    links = found.where("b is not null").distinct()
    if (more := ties_of_repeated(spark, rows.where("v is not null").select("id", "k1", "k2"), classes)) is not None:
        links = links.unionAll(more)
    parts = stored(spark, components(spark, links), "components")

    spare = passes - needed
    short = found.where("b is null").groupBy(F.col("a").alias("id")).agg(F.count("*").alias("short")).where(F.col("short") > spare).select("id")
    dense = classes if spare < 0 else classes.join(stored(spark, short, "dense"), "id", "left_semi")
    dense = dense.join(parts, "id", "left").withColumn("component", F.coalesce("component", "id")).withColumn("core", F.lit(False))
    blocks = _put_blocks(spark, dense, block_bytes)
    if blocks:
        missed = stored(spark, _missed(spark, blocks, least), "missed")
        if not missed.isEmpty():
            parts = stored(spark, components(spark, links.unionAll(missed).distinct()), "components")

    counts = _counts(spark, classes, parts, least, block_bytes)
    of = classes.join(parts, "id", "left").join(counts, "at", "left")
    of = of.select("k1", "k2", F.coalesce("component", "id").alias("component"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n"))
    out = rows.select("id", "k1", "k2").join(of, ["k1", "k2"], "left")
    out = out.select(F.col("id").alias("vec_id"), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
