"""Near-duplicate documents by SetSketch registers (operator 10).

A document's set is its distinct k-word shingles. Register i of its sketch is an exponentially spaced truncated minimum: the least
of the set's i-th exponential hashes x becomes floor(1 - log_b(a x)), cut to 16 bits. Registers of a union are the maxima of the
parts' registers, and equal registers are as likely as the sets are similar. So:

1. texts of equal word sequences form one class, whose smallest id stands for it from here on;
2. groups of registers ("bands") are bucket keys. Every member of a bucket is paired with the bucket's smallest id, and a pair's
   similarity is estimated by maximum likelihood from how many registers are larger, smaller and equal together with both set sizes.
   Likely pairs, which are not clearly (4.5 standard errors) below the threshold, tie classes together to neighbourhoods;
3. what a bucket's members may still share without its smallest id: members of one bucket in different neighbourhoods are compared by
   their estimates too. In large buckets only members outside the bucket's largest neighbourhood meet all others, in tiles of bounded
   size. So every likely pair of any bucket is within one neighbourhood;
4. the classes of a neighbourhood are verified on their full shingle sets: intersections of all its pairs come from one product of an
   incidence matrix of the shingles that occur twice. Only a spanning forest of the true links leaves a task;
5. a neighbourhood of more than TILE classes or TILE_SHINGLES shingles is cut into blocks, each of which also gets the neighbourhood's
   smallest id, so that copies of one text mostly become one component at once. What components are left are compared by their smallest
   members across blocks, and then every member outside the largest component meets all members of other components, block by block.

Buckets and neighbourhoods have no cap, and no likely pair is left out. A task holds the texts of one block, or of two: TILE texts with
about TILE_SHINGLES words at most, or one longer text.

A pair of the threshold's similarity shares no bucket with a probability of at most 1e-6.

Defined results: null, empty and all-space texts have the empty set and link with nothing; shorter texts have their whole sequence as
one shingle; very long texts count whole; rows of one id count as one document, which has the links of all its texts, whether they are
equal (a tie changes nothing) or not; a null id links with nothing and is kept; extra columns are dropped, whatever their names; an
empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.shared import Forest, components, grouped, links_batch, stored, tidy, ties_of_repeated
from quire.llm.textcore import SPACE_TABLE, binary_rows, distinct, fmix, sequence_keys, shingles, slices, utf8, words

REGISTERS = 192
BASE = 1.001
RATE = 20.0
#: Members of a bucket up to which its pairs are made by a join on the bucket; larger ones are tiled.
SMALL = 64
#: Texts, and about as many shingles, of a block whose texts all meet each other.
TILE, TILE_SHINGLES = 512, 1 << 20
_RNG = np.random.Generator(np.random.PCG64(77))
_MULTIPLY = _RNG.integers(1, 2**64 - 1, size=REGISTERS, dtype=np.uint64) | np.uint64(1)
_ADD = _RNG.integers(1, 2**64 - 1, size=REGISTERS, dtype=np.uint64)


def sketch(hashes: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Registers of each set; heads are where the sets' hashes begin, none of them empty."""
    least = np.empty((len(heads), REGISTERS), np.uint64)
    for j in range(REGISTERS):
        least[:, j] = np.minimum.reduceat((hashes * _MULTIPLY[j] + _ADD[j]) >> np.uint64(32), heads)
    x = -np.log1p(-(least.astype(np.float64) + 0.5) / 2**32)
    return np.clip(np.floor(1 - np.log(RATE * x) / math.log(BASE)), 0, 65_535).astype(np.uint16)


def rows_a_band(threshold: float, miss: float = 1e-6) -> int:
    """The most registers a band may have so that a pair of the threshold misses all bands with a probability of at most miss."""
    return max(r for r in range(1, 17) if r == 1 or (1 - threshold**r) ** (REGISTERS // r) <= miss)


def likelihood(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, step: float = 0.01) -> np.ndarray:
    """Maximum-likelihood similarity of pairs of sketches with known set sizes, on a grid of similarities."""
    more, less = (a > b).sum(1), (a < b).sum(1)
    same = a.shape[1] - more - less
    u = n_a / (n_a + n_b)
    v = 1 - u
    grid = np.arange(0, 1 + step / 2, step)[None, :]
    top = np.minimum(u / v, v / u)[:, None]
    j = np.minimum(grid, top)
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)
    up, down = p(u[:, None] - v[:, None] * j), p(v[:, None] - u[:, None] * j)
    tiny = 1e-12
    value = more[:, None] * np.log(up + tiny) + less[:, None] * np.log(down + tiny) + same[:, None] * np.log(np.maximum(1 - up - down, tiny))
    return j[np.arange(len(j)), value.argmax(1)]


def rises(more: np.ndarray, less: np.ndarray, same: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, at: float) -> np.ndarray:
    """Whether the likelihood still rises at a similarity, which its maximum then is not below: it is concave in it.

    more, less, same: registers that are greater, smaller and equal in a sketch of n_a against one of n_b elements.
    """
    u = n_a / (n_a + n_b)
    v, c = 1 - u, (BASE - 1) / BASE

    def slope(x: np.ndarray) -> np.ndarray:
        """The slope of the logarithm of p at x > 0."""
        return c / ((1 - c * x) * -np.log1p(-c * x))

    up, down = np.maximum(u - v * at, 1e-12), np.maximum(v - u * at, 1e-12)
    p = lambda x: -np.log1p(-c * x) / math.log(BASE)
    gone = v * slope(up) * p(up) + u * slope(down) * p(down)
    return same * gone / np.maximum(1 - p(up) - p(down), 1e-12) >= more * v * slope(up) + less * u * slope(down)


def cut_of(threshold: float) -> float:
    return threshold - 4.5 * math.sqrt(threshold * (1 - threshold) / REGISTERS)


def _shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of a text column: rows lo to hi, words' owners and hashes, and the distinct shingles' owners and hashes."""
    data, bounds = utf8(column)
    for lo, hi in slices(bounds):
        _, owner, hashes = words(data, bounds[lo : hi + 1], SPACE_TABLE)
        h, o = shingles(owner, hashes, k)
        yield lo, hi, owner, hashes, *distinct(o, h)


def sketches(docs: DataFrame, k: int, doc_id: str, text: str) -> DataFrame:
    """(doc_id, k1, k2, n_shingles, registers): keys of the whole word sequence, the set's size, the sketch (null where empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, owner, hashes, so, sh in _shingle_sets(batch.column(1), k):
                k1, k2 = sequence_keys(owner, hashes, hi - lo)
                size = np.bincount(so, minlength=hi - lo).astype(np.int64)
                there = np.flatnonzero(size)
                regs = [None] * (hi - lo)
                if len(there):
                    for i, r in zip(there.tolist(), sketch(sh, np.r_[0, np.cumsum(size[there])][:-1]), strict=True):
                        regs[i] = r.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), pa.array(size), pa.array(regs, pa.binary())],
                    ["doc_id", "k1", "k2", "n_shingles", "registers"],
                )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(tidy(run), "doc_id long, k1 long, k2 long, n_shingles long, registers binary")


def bands(classes: DataFrame, rows: int) -> DataFrame:
    """(bucket, id, n) of each class and band."""
    count = REGISTERS // rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = _MULTIPLY[:rows]
        for batch in batches:
            for lo in range(0, len(batch), 2000):
                part = batch.slice(lo, 2000)
                regs = np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint16).reshape(len(part), REGISTERS)[:, : count * rows]
                keys = fmix((regs.reshape(len(part), count, rows).astype(np.uint64) * weights).sum(2) + _ADD[:count])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64).ravel()), pa.array(np.repeat(part.column(0).to_numpy(), count)), pa.array(np.repeat(part.column(1).to_numpy(), count))],
                    ["bucket", "id", "n"],
                )

    return classes.select("id", "n", "registers").mapInArrow(tidy(run), "bucket long, id long, n long")


def _likely(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Of the pairs (a, b), those whose estimate does not rule the threshold out."""
    side = lambda x: classes.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("registers").alias(f"r_{x}"))
    cut = cut_of(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 2000):
                part = batch.slice(lo, 2000)
                a, b, na, nb, ra, rb = (part.column(i) for i in range(6))
                ra, rb = (np.frombuffer(b"".join(x.to_pylist()), np.uint16).reshape(len(part), REGISTERS) for x in (ra, rb))
                more, less = (ra > rb).sum(1), (ra < rb).sum(1)
                keep = rises(more, less, REGISTERS - more - less, na.to_numpy().astype(float), nb.to_numpy().astype(float), cut)
                yield pa.RecordBatch.from_arrays([a, b], ["a", "b"]).filter(pa.array(keep))

    joined = pairs.join(side("b"), "b").where(F.lit(True)).join(side("a"), "a").where(f"least(n_a, n_b) >= {threshold} * greatest(n_a, n_b)")
    return joined.select("a", "b", "n_a", "n_b", "r_a", "r_b").mapInArrow(tidy(run), "a long, b long")


def _apart(placed: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Likely pairs (a, b) that tie different neighbourhoods of a large bucket: members outside its largest one meet all, in blocks."""
    cut = cut_of(threshold)
    sizes = placed.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    most = sizes.groupBy("bucket").agg(F.max(F.struct("n", "component"))["component"].alias("largest"), F.max("n").alias("most"), F.sum("n").alias("all"))
    rest = F.col("component") != F.col("largest")
    place = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    # A bucket's size is with each of its members, so that large buckets meet what is known of them in parts.
    parts = lambda n: F.ceil(F.col(n) / (4 * TILE)).cast("int")
    most = most.withColumn("salt", F.explode(F.sequence(F.lit(0), parts("all") - 1)))
    dealt = placed.select("bucket", "id", "component", F.pmod(F.xxhash64("id", F.lit(11)), parts("size")).cast("int").alias("salt")).join(most.hint("merge"), ["bucket", "salt"])
    dealt = dealt.withColumns({"rows": F.ceil((F.col("all") - F.col("most")) / TILE).cast("int"), "columns": F.ceil(F.col("all") / TILE).cast("int")})
    left = dealt.where(rest).select("bucket", place("rows").alias("i"), F.explode(F.sequence(F.lit(0), F.col("columns") - 1)).alias("j"), F.lit(True).alias("query"), "id", "component")
    right = dealt.select("bucket", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("i"), place("columns").alias("j"), F.lit(False).alias("query"), "id", "component")
    full = left.unionAll(right).join(classes.select("id", "n", "registers"), "id").select("bucket", "i", "j", "query", "id", "component", "n", "registers")

    def ties(rows: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        t = pa.Table.from_batches(rows)
        query, ids, comp, n = (t.column(c).to_numpy() for c in (3, 4, 5, 6))
        regs = np.frombuffer(b"".join(t.column(7).to_pylist()), np.uint16).reshape(len(t), REGISTERS)
        left, right = np.flatnonzero(query), np.flatnonzero(~query)
        forest, out = Forest(), []
        for x in left:
            y = right[(comp[right] != comp[x]) & (np.minimum(n[right], n[x]) >= threshold * np.maximum(n[right], n[x]))]
            y = y[[forest.find(int(c)) != forest.find(int(comp[x])) for c in comp[y]]] if len(y) else y
            if len(y):
                theirs = regs[y]
                more, less = (regs[x] > theirs).sum(1), (regs[x] < theirs).sum(1)
                for z in y[rises(more, less, REGISTERS - more - less, float(n[x]), n[y].astype(float), cut)]:
                    if forest.link(int(comp[x]), int(comp[z])):
                        out.append((int(ids[x]), int(ids[z])))
        return links_batch(out) if out else None

    return full.repartition(_tasks(placed), "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j").mapInArrow(grouped(3, ties), "a long, b long")


def _tasks(rows: DataFrame) -> int:
    """Partitions of blocks to compare: work, not bytes, tells how many are needed, so they are not coalesced."""
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Owners and hashes of the distinct shingles of a text column."""
    parts = [(so + lo, sh) for lo, _, _, _, so, sh in _shingle_sets(column, k)]
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def true_links(column: pa.Array, k: int, percent: int, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """For each pair of rows and columns (places in the text column) whether 100 * intersection >= percent * union."""
    owner, hashes = _sets(column, k)
    size = np.bincount(owner, minlength=len(column)).astype(np.int64)
    _, number, count = np.unique(hashes, return_inverse=True, return_counts=True)
    twice = count[number] > 1
    owner, number = owner[twice], np.cumsum(count > 1)[number[twice]] - 1
    order = np.argsort(number, kind="stable")
    owner, number = owner[order], number[order]
    both = np.zeros((len(rows), len(columns)), np.float32)
    top = int(number[-1]) + 1 if len(number) else 0
    for lo in range(0, top, 4096):
        a, b = np.searchsorted(number, [lo, lo + 4096])
        m = np.zeros((len(column), min(4096, top - lo)), np.float32)
        m[owner[a:b], number[a:b] - lo] = 1
        both += m[rows] @ m[columns].T
    both = both.astype(np.int64)
    union = size[rows][:, None] + size[columns] - both
    return (100 * both >= percent * union) & (union > 0)


def _within(rows: DataFrame, k: int, percent: int) -> DataFrame:
    """A spanning forest (a, b) of the links of each group. rows: part, i, j, side, id, component, text.

    side is 0 for a group whose rows all meet each other; else rows of side 1 meet those of side 2. Rows of one component need no link.
    """

    def links(batches: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        t = pa.Table.from_batches(batches)
        side, ids, comp = (t.column(c).to_numpy() for c in (3, 4, 5))
        left, right = np.flatnonzero(side <= 1), np.flatnonzero(side != 1)
        if len(left) + len(right) < 2 or not len(left) or not len(right):
            return None
        forest, out = Forest(), []
        x, y = np.nonzero(true_links(t.column(6), k, percent, left, right) & (comp[left][:, None] != comp[right]))
        for a, b in zip(left[x].tolist(), right[y].tolist(), strict=True):
            if forest.link(int(comp[a]), int(comp[b])):
                out.append((int(ids[a]), int(ids[b])))
        return links_batch(out) if out else None

    placed = rows.select(F.col("part"), "i", "j", "side", "id", "component", "text").repartition(_tasks(rows), "part", "i", "j").sortWithinPartitions("part", "i", "j", "id")
    return placed.mapInArrow(grouped(3, links), "a long, b long")


def _relabel(spark: SparkSession, rows: DataFrame, links: DataFrame) -> DataFrame:
    """rows (id, component, ...) with their components after more links between ids."""
    of = lambda x: rows.select(F.col("id").alias(x), F.col("component").alias(f"c_{x}"))
    over = stored(spark, links.join(of("a"), "a").join(of("b"), "b").select(F.col("c_a").alias("a"), F.col("c_b").alias("b")).distinct(), "links")
    joined = components(spark, over).select(F.col("id").alias("component"), F.col("component").alias("_low"))
    return rows.join(joined, "component", "left").withColumn("component", F.coalesce("_low", "component")).drop("_low").select(*rows.columns)


def _blocks(count: Column, shingles_: Column) -> Column:
    """Blocks that so many texts with so many shingles are cut into."""
    return F.greatest(F.ceil(count / TILE), F.ceil(shingles_ / TILE_SHINGLES)).cast("int")


def _large(spark: SparkSession, rows: DataFrame, k: int, percent: int) -> DataFrame:
    """(id, component) of the classes of large neighbourhoods: rows (part, id, n, component, text), component by blocks already."""
    place = lambda n: F.pmod(F.xxhash64("id", F.lit(3)), F.col(n)).cast("int")
    heads = rows.where("id = component")
    count = heads.groupBy("part").agg(_blocks(F.count("*"), F.sum("n")).alias("blocks"))
    tiles = heads.join(count, "part").withColumn("own", place("blocks"))
    tiles = tiles.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    i, j = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(i == j, 0).when(F.col("own") == i, 1).otherwise(2)
    links = _within(tiles.select("part", i.alias("i"), j.alias("j"), side.alias("side"), "id", "component", "text"), k, percent)
    rows = stored(spark, _relabel(spark, rows, links), "large")

    sizes = rows.groupBy("part", "component").agg(F.count("*").alias("n"), F.sum("n").alias("s"))
    most = sizes.groupBy("part").agg(F.max(F.struct("n", (-F.col("component")).alias("c"), "s")).alias("x"), F.sum("n").alias("all"), F.sum("s").alias("sum"))
    most = most.where("all > x.n").select("part", (-F.col("x.c")).alias("largest"), _blocks(F.col("all") - F.col("x.n"), F.col("sum") - F.col("x.s")).alias("rows"), _blocks(F.col("all"), F.col("sum")).alias("columns"))
    open_ = rows.join(most, "part")
    left = open_.where("component <> largest").select("part", place("rows").alias("i"), F.explode(F.sequence(F.lit(0), F.col("columns") - 1)).alias("j"), F.lit(1).alias("side"), "id", "component", "text")
    right = open_.select("part", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("i"), place("columns").alias("j"), F.lit(2).alias("side"), "id", "component", "text")
    return _relabel(spark, rows.select("id", "component"), _within(left.unionAll(right), k, percent))


def _united(spark: SparkSession, there: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
    """found (id, component), with the classes of each id that has several texts in one component."""
    links = ties_of_repeated(spark, there.select(F.col("doc_id").alias("id"), "k1", "k2"), classes)
    if links is None:
        return found
    rows = classes.select("id").distinct().join(found, "id", "left").select("id", F.coalesce("component", "id").alias("component"))
    return stored(spark, _relabel(spark, rows, links), "components")


def link(spark: SparkSession, docs: DataFrame, k: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row: component_id is the smallest id reachable over links."""
    threshold, rows = percent / 100, rows_a_band(percent / 100)
    keyed = stored(spark, sketches(docs, k, doc_id, text), "sketches")
    there = keyed.where("doc_id is not null and n_shingles > 0")
    classes = there.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "n_shingles", "registers")).alias("x"))
    classes = stored(spark, classes.select("k1", "k2", F.col("x.doc_id").alias("id"), F.col("x.n_shingles").alias("n"), F.col("x.registers").alias("registers")), "classes")

    banded = bands(classes, rows)
    buckets = banded.groupBy("bucket").agg(F.min("id").alias("head"), F.count("*").alias("size")).where("size > 1")
    members = stored(spark, banded.join(buckets, "bucket"), "members")
    star = members.where("id <> head").select(F.col("head").alias("a"), F.col("id").alias("b")).distinct()
    near = stored(spark, components(spark, stored(spark, _likely(star, classes, threshold), "likely")), "near")

    placed = members.join(near, "id", "left").select("bucket", "id", "n", "size", F.coalesce("component", "id").alias("component"))
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("bucket")
    placed = stored(spark, placed.join(mixed, "bucket"), "mixed")
    few = placed.where(f"size <= {SMALL}")
    other = few.select("bucket", F.col("id").alias("id2"), F.col("n").alias("n2"), F.col("component").alias("component2"))
    pairs = few.join(other, "bucket").where(f"id < id2 and component <> component2 and least(n, n2) >= {threshold} * greatest(n, n2)")
    pairs = _likely(pairs.select(F.col("id").alias("a"), F.col("id2").alias("b")).distinct(), classes, threshold)
    ties = stored(spark, pairs.unionAll(_apart(placed.where(f"size > {SMALL}"), classes, threshold)).distinct(), "ties")
    near = classes.select("id").distinct().join(near, "id", "left").select("id", F.coalesce("component", "id").alias("component"))
    near = stored(spark, _relabel(spark, near, ties), "near")

    sized = classes.groupBy("id").agg(F.sum("n").alias("n"), F.count("*").alias("classes")).join(near.select("id", F.col("component").alias("part")), "id")
    parts = sized.groupBy("part").agg(F.sum("classes").alias("c"), _blocks(F.sum("classes"), F.sum("n")).alias("blocks")).where("c > 1").drop("c")
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    within = sized.select("id", "n", "part").join(parts, "part").select("id", "n", "part", "blocks")
    # Rows of one id may have different texts: each of them is verified.
    within = stored(spark, texts.join(within, "id").dropDuplicates(["id", "text"]), "within").withColumn("component", F.col("id"))
    last, own = F.col("blocks") - 1, F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    block = F.explode(F.when(F.col("id") == F.col("part"), F.sequence(F.lit(0), last)).otherwise(F.array(own)))
    first = _within(within.select("part", block.alias("i"), F.lit(0).alias("j"), F.lit(0).alias("side"), "id", "component", "text"), k, percent)
    labelled = stored(spark, _relabel(spark, within.select("id", "component").distinct(), first), "labelled")
    small = labelled.join(within.where("blocks = 1").select("id").distinct(), "id")
    large = within.where("blocks > 1").select("part", "id", "n", "text").join(labelled, "id").select("part", "id", "n", "component", "text")
    if (large := stored(spark, large, "large")).isEmpty():
        found = small
    else:
        found = small.unionAll(_large(spark, large, k, percent))
    found = stored(spark, found.distinct(), "components")
    found = _united(spark, there, classes, found)
    final = classes.select("k1", "k2", "id").join(found, "id", "left").select("k1", "k2", F.coalesce("component", "id").alias("component_id"))
    out = keyed.drop("registers").join(final, ["k1", "k2"], "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    out = out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), own).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
