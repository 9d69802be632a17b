"""Benchmark decontamination by greedy string tiling (operator 2).

Words are lower-cased runs of letters and digits. Texts and benchmark items that share a run of five words (a seed) are paired; each
pair is tiled: Running Karp-Rabin hashes of shrinking lengths find the longest common runs of words not yet marked, the longest are
marked first, and no word is marked twice. Tiles may lie in any order, so reordered passages count. An item leaks into a text if the
tiles cover the given share of the item's words.

Seeds that many items have need not pair: as many of an item's commonest seeds as cannot cover the share by themselves are left out, for
a text with no other seed of the item cannot reach it. A pair whose common seeds together cover less than the share is not tiled.
Neither loses a leak.

The benchmark is the query set: it is read in blocks of bounded size, each of which passes over all texts, so nothing that grows
with the texts is broadcast; the results of each block are stored before the next. Defined results: items of fewer than five words
never leak; null and empty texts hold no leak; very long texts are tiled whole; of runs of equal length the one first in the text, then
in the item, is marked first; repeated rows, and items that repeat an id, each give their rows; contaminated() drops extra columns and
clean() keeps them, whatever their names; an empty benchmark or table gives an empty result, or all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.shared import stored, tidy
from quire.llm.textcore import ALNUM_TABLE, powers, shingles, slices, utf8, words

LEAST = 5
COVERAGE = 0.6
#: Benchmark bytes that one pass over the texts may hold.
BLOCK_BYTES = 16 << 20
_FIRST_LENGTH = 20


def _inverse(x: int) -> int:
    return pow(x, -1, 2**64)


def _run_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of n words, from one running sum."""
    p = powers(len(h) + 1, 3)
    back = powers_of(_inverse(int(powers(2, 3)[1])), len(h) + 1)
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * p[: len(h)], out=total[1:])
    return (total[n:] - total[:-n]) * back[: len(h) - n + 1]


_back = np.zeros(0, np.uint64)


def powers_of(base: int, n: int) -> np.ndarray:
    global _back
    if len(_back) < n:
        out = np.full(max(n, 4096), base, dtype=np.uint64)
        out[0] = 1
        _back = np.multiply.accumulate(out)
    return _back[:n]


def tile(text: np.ndarray, item: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Tiles (place in text, place in item, words) of two word-hash sequences, longest first within a length."""
    free_t, free_i, tiles = np.ones(len(text), bool), np.ones(len(item), bool), []
    length = max(least, min(_FIRST_LENGTH, len(item), len(text)))
    while True:
        found, longer = _matches(text, item, free_t, free_i, length)
        if longer > 2 * length:
            length = longer
            continue
        for n, t, i in sorted(found, key=lambda x: (-x[0], x[1], x[2])):
            if free_t[t : t + n].all() and free_i[i : i + n].all():
                free_t[t : t + n] = free_i[i : i + n] = False
                tiles.append((t, i, n))
            else:  # what is left of it may still be long enough
                ok = free_t[t : t + n] & free_i[i : i + n]
                edges = np.flatnonzero(np.diff(np.r_[False, ok, False].astype(np.int8)))
                for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                    if hi - lo >= length:
                        free_t[t + lo : t + hi] = free_i[i + lo : i + hi] = False
                        tiles.append((t + lo, i + lo, hi - lo))
        if length <= least:
            return tiles
        length = max(least, length // 2)


def _all_of(free: np.ndarray, n: int) -> np.ndarray:
    """For each run of n places whether all of them are free."""
    total = np.r_[0, np.cumsum(free)]
    return total[n:] - total[:-n] == n


def _matches(text: np.ndarray, item: np.ndarray, free_t: np.ndarray, free_i: np.ndarray, n: int) -> tuple[list[tuple[int, int, int]], int]:
    """Maximal common runs of at least n free words, and the longest; runs are cut off where that exceeds 2 n."""
    if len(text) < n or len(item) < n:
        return [], 0
    in_item, in_text = np.flatnonzero(_all_of(free_i, n)), np.flatnonzero(_all_of(free_t, n))
    places: dict[int, list[int]] = {}
    hashes = _run_hashes(item, n)
    for i in in_item.tolist():
        places.setdefault(int(hashes[i]), []).append(i)
    mine = _run_hashes(text, n)
    hits = in_text[np.isin(mine[in_text], np.array(list(places), np.uint64))]
    out, most = [], 0
    for t in hits.tolist():
        for i in places[int(mine[t])]:
            if t and i and free_t[t - 1] and free_i[i - 1] and text[t - 1] == item[i - 1]:
                continue  # not the run's beginning
            size = min(len(text) - t, len(item) - i)
            differs = np.flatnonzero((text[t : t + size] != item[i : i + size]) | ~free_t[t : t + size] | ~free_i[i : i + size])
            k = int(differs[0]) if len(differs) else size
            if k >= n:
                out.append((k, t, i))
                most = max(most, k)
    return out, most


class Benchmark:
    """One block of benchmark items with its seeds: sorted seed hashes, and the items of each."""

    def __init__(self, ids: list[int], texts: list[str], coverage: float = COVERAGE, least: int = LEAST):
        self.coverage, self.least, self.ids = coverage, least, ids
        data, bounds = utf8(pc.utf8_lower(pa.array(texts, pa.string())))
        _, owner, hashes = words(data, bounds, ALNUM_TABLE)
        edges = np.searchsorted(owner, np.arange(len(ids) + 1))
        self.items = [hashes[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
        h, o = self._seeds(owner, hashes)
        edges = np.searchsorted(o, np.arange(len(ids) + 1))
        self.own = [h[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
        one = np.unique(np.column_stack([h, o.astype(np.uint64)]), axis=0) if len(h) else np.zeros((0, 2), np.uint64)
        values, count = np.unique(one[:, 0], return_counts=True)
        probe = np.ones(len(h), bool)
        for k in range(len(ids)):
            a, b = int(edges[k]), int(edges[k + 1])
            often = count[np.searchsorted(values, h[a:b])]
            probe[a:b] = self._needed(often, len(self.items[k]))
        h, o = h[probe], o[probe]
        order = np.lexsort((o, h))
        self.seeds, self.owners = h[order], o[order]
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.seeds & np.uint64(0xFFFFF)).astype(np.int64)] = True

    def _seeds(self, owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Seeds and their texts in order; texts of fewer words have none."""
        h, o = shingles(owner, hashes, self.least)
        n = max(0, len(hashes) - self.least + 1)
        whole = int((owner[:n] == owner[self.least - 1 :]).sum()) if n else 0
        return h[:whole], o[:whole]

    def _needed(self, often: np.ndarray, words_: int) -> np.ndarray:
        """Which seeds of an item must be looked for: all but the commonest ones that cannot cover the share by themselves."""
        out = np.ones(len(often), bool)
        covered, reach = np.zeros(words_, bool), 0
        for at in np.argsort(-often, kind="stable").tolist():
            if often[at] < 2:
                break
            reach += int((~covered[at : at + self.least]).sum())
            covered[at : at + self.least] = True
            if reach >= self.coverage * words_:
                break
            out[at] = False
        return out

    def _reach(self, own: np.ndarray, there: np.ndarray, words_: int) -> int:
        """Words of an item that its seeds in a text cover: the tiles cover no more."""
        step = np.zeros(words_ + 1, np.int64)
        at = np.flatnonzero(np.isin(own, there))
        np.add.at(step, at, 1)
        np.add.at(step, at + self.least, -1)
        return int((np.cumsum(step)[:words_] > 0).sum())

    def leaks(self, column: pa.Array) -> Iterator[tuple[int, int, int, int, int]]:
        """(row, item's number, item's words, covered words, tiles) of each leak into a text column."""
        data, bounds = utf8(pc.utf8_lower(column))
        for lo, hi in slices(bounds):
            _, owner, hashes = words(data, bounds[lo : hi + 1], ALNUM_TABLE)
            h, o = self._seeds(owner, hashes)
            near = np.flatnonzero(self.bits[(h & np.uint64(0xFFFFF)).astype(np.int64)])
            first, last = np.searchsorted(self.seeds, h[near], "left"), np.searchsorted(self.seeds, h[near], "right")
            pairs = {(int(o[near[x]]), int(k)) for x in np.flatnonzero(last > first) for k in self.owners[first[x] : last[x]]}
            for row, k in sorted(pairs):
                need = self.coverage * len(self.items[k])
                a, b = np.searchsorted(o, [row, row + 1])
                if self._reach(self.own[k], h[a:b], len(self.items[k])) < need:
                    continue
                a, b = np.searchsorted(owner, [row, row + 1])
                tiles = tile(hashes[a:b], self.items[k], self.least)
                covered = sum(n for _, _, n in tiles)
                if covered >= need:
                    yield lo + row, k, len(self.items[k]), covered, len(tiles)


def blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", coverage: float = COVERAGE) -> Iterator[Benchmark]:
    """The benchmark in blocks of at most about BLOCK_BYTES, by a hash of the item's id."""
    rows = benchmark.where(F.col(text).isNotNull()).select(F.col(item_id).cast("long").alias("id"), F.col(text).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-2 * total // BLOCK_BYTES)) if total > BLOCK_BYTES else 1
    for i in range(count):
        part = (rows.where(F.pmod(F.xxhash64("id"), F.lit(count)) == i) if count > 1 else rows).orderBy("id", "text").collect()
        if part:
            yield Benchmark([r.id for r in part], [r.text for r in part], coverage)


def contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, item_id, item_words, covered_words, n_tiles, coverage) of each leak."""
    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, item_id long, item_words long, covered_words long, n_tiles long, coverage double"
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    out = spark.createDataFrame([], schema)
    for block in blocks(benchmark, coverage=coverage):

        def run(batches: Iterator[pa.RecordBatch], block: Benchmark = block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = list(block.leaks(batch.column(1)))
                if found:
                    row, k, n, covered, tiles = (np.array(x, np.int64) for x in zip(*found, strict=True))
                    ids = pa.array([block.ids[i] for i in k], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(row)), ids, pa.array(n), pa.array(covered), pa.array(tiles), pa.array(covered / n)],
                        ["doc_id", "item_id", "item_words", "covered_words", "n_tiles", "coverage"],
                    )

        out = out.unionAll(stored(spark, rows.mapInArrow(tidy(run), schema), "leaks"))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """The rows of docs that hold no leak, with all their columns."""
    at = docs.columns.index(text)
    for i, block in enumerate(blocks(benchmark, coverage=coverage)):
        docs = stored(docs.sparkSession, docs, "unleaked") if i else docs

        def run(batches: Iterator[pa.RecordBatch], block: Benchmark = block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(len(batch), bool)
                keep[[x[0] for x in block.leaks(batch.column(at))]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(tidy(run), docs.schema)
    return docs
