"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration (operator 3).

The lexicon is a short list of insults and word stems learned from the labelled sample: beginnings of words that hardly any clean
text has. Features of a text are lexicon densities, how often lexicon words stand near a second person, the share of capitals,
punctuation and obfuscation rates. Trees are fitted by histogram boosting of the log loss; the last quarter of the sample calibrates
their values by isotonic regression.

The model is fitted on at most SAMPLE labelled texts (those of the smallest hashes of their ids; a documented bound); every text is
scored whole, however long. Defined results: null, empty and symbol-only texts are scored like any other, with zero densities; without
labels of both classes every score is the share of toxic labels (0 without any); equal texts have equal scores, and a tie at the
threshold counts as toxic; repeated rows each give a row; null labels are not used, and a label of a repeated id counts for each of its
texts; score() drops extra columns and clean() keeps them, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.shared import BROADCAST_ROWS, stored, tidy
from quire.llm.textcore import ALNUM_TABLE, distinct, powers, slices, utf8, words

#: Labelled texts that the model is fitted on, at most.
SAMPLE = 12_000
#: A word beginning is learned if so many, and this share, of the sample's toxic texts have it, if it is exp(LIFT) times as frequent among
#: them as among clean ones, and if the logarithm of that ratio times the square root of its texts is at least CLEAR. All such are.
LEAST_TEXTS, LEAST_SHARE, LIFT, CLEAR = 4, 0.01, 2.5, 6.0
STEMS = (3, 4, 5, 6, 7, 8)

#: Common insults, and second-person words of the languages met most.
INSULTS = "idiot moron stupid loser trash scum clown pathetic worthless disgusting dumb fool jerk imbecile dumm idiota stupide imbécile estúpido".split()
SECOND = "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre tú ti usted ustedes vosotros".split()
#: What letters are written as to evade a list.
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}

_LEET_TABLE = ALNUM_TABLE.copy()
for _a, _b in LEET.items():
    _LEET_TABLE[ord(_a)] = ALNUM_TABLE[ord(_b)]
#: Byte classes: 1 upper, 2 lower or beyond ASCII, 3 digit, 4 mark of stress, 5 other printable, 0 the rest.
_CLASS = np.zeros(256, np.int8)
_CLASS[33:127] = 5
_CLASS[65:91], _CLASS[97:123], _CLASS[128:], _CLASS[48:58] = 1, 2, 2, 3
_CLASS[[ord("!"), ord("?")]] = 4
_JOINS = np.zeros(256, bool)
_JOINS[[ord(x) for x in "-'.,:;/"]] = True


def _word_hashes(table: list[str]) -> np.ndarray:
    data, bounds = utf8(pa.array(table))
    return np.unique(words(data, bounds, ALNUM_TABLE)[2])


_INSULT_HASHES, _SECOND_HASHES = _word_hashes(INSULTS), _word_hashes(SECOND)
_WHOLE = np.uint64(0x9E3779B97F4A7C15)


def stems(data: np.ndarray, starts: np.ndarray, hashes: np.ndarray, table: np.ndarray = ALNUM_TABLE, sizes: tuple[int, ...] = STEMS) -> np.ndarray:
    """For each word a row: hashes of its beginnings of the given byte lengths (0 where it is shorter), then of the whole word."""
    reach = max(sizes)
    at = np.minimum(starts[:, None] + np.arange(reach), max(len(data) - 1, 0))
    t = table[data[at]] if len(data) else np.zeros((len(starts), reach), np.uint64)
    inside = np.logical_and.accumulate((t != 0) & (starts[:, None] + np.arange(reach) < len(data)), axis=1)
    sums = np.cumsum(t * powers(reach, 4), axis=1)
    out = np.zeros((len(starts), len(sizes) + 1), np.uint64)
    for i, n in enumerate(sizes):
        out[:, i] = np.where(inside[:, n - 1], sums[:, n - 1] * np.uint64(2 * n + 1), 0)
    out[:, -1] = hashes ^ _WHOLE
    return out


def _member(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The place of each value in the sorted table, -1 where it is absent."""
    if not len(table):
        return np.full(values.shape, -1)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return np.where(table[at] == values, at, -1)


FEATURES = ("lexicon", "insults", "hits", "near_second", "second", "capitals", "shouted", "stress", "punctuation", "digits", "obfuscated", "hidden_hits", "log_words", "strongest")


class Features:
    """Dense features of text columns, given the learned lexicon: sorted hashes and their weights."""

    def __init__(self, lexicon: np.ndarray, weights: np.ndarray):
        self.lexicon, self.weights = lexicon, weights
        self.bits = np.zeros(1 << 16, bool)
        self.bits[(lexicon & np.uint64(0xFFFF)).astype(np.int64)] = True

    def _hits(self, data: np.ndarray, starts: np.ndarray, hashes: np.ndarray, table: np.ndarray) -> np.ndarray:
        """For each word the greatest weight of what it begins with or is; 0 for none."""
        out = np.zeros(len(starts))
        if not len(self.lexicon) or not len(starts):
            return out
        all_stems = stems(data, starts, hashes, table)
        row, col = np.nonzero(self.bits[(all_stems & np.uint64(0xFFFF)).astype(np.int64)])
        found = _member(all_stems[row, col], self.lexicon)
        np.maximum.at(out, row[found >= 0], self.weights[found[found >= 0]])
        return out

    def of(self, column: pa.Array) -> np.ndarray:
        data, bounds = utf8(column)
        out = np.zeros((len(column), len(FEATURES)))
        for lo, hi in slices(bounds):
            out[lo:hi] = self._slice(data[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo])
        return out

    def _slice(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        n = len(bounds) - 1
        starts, owner, hashes = words(data, bounds, ALNUM_TABLE)
        total = lambda o, w=None: np.bincount(o, weights=w, minlength=n)
        weight = self._hits(data, starts, hashes, ALNUM_TABLE)
        hit, insult, second = weight > 0, _member(hashes, _INSULT_HASHES) >= 0, _member(hashes, _SECOND_HASHES) >= 0
        near = np.zeros(len(owner), bool)
        for d in (1, 2, 3):
            if len(owner) > d:
                same = owner[d:] == owner[:-d]
                near[d:] |= second[:-d] & same
                near[:-d] |= second[d:] & same
        marked = hit | insult
        lstarts, lowner, lhashes = words(data, bounds, _LEET_TABLE)
        hidden = total(lowner, ((self._hits(data, lstarts, lhashes, _LEET_TABLE) > 0) | (_member(lhashes, _INSULT_HASHES) >= 0)).astype(float)) - total(owner, marked.astype(float))
        kind = _CLASS[data]
        sums = np.zeros((6, len(data) + 1))
        for c in range(1, 6):
            np.cumsum(kind == c, out=sums[c, 1:])
        upper, lower, digits, stress, other = (sums[c, bounds[1:]] - sums[c, bounds[:-1]] for c in range(1, 6))
        inner = np.zeros(len(data) + 1)
        if len(data) > 2:
            letter = (kind == 1) | (kind == 2)
            np.cumsum(np.r_[False, letter[:-2] & (kind[1:-1] >= 3) & ~_JOINS[data[1:-1]] & letter[2:], False], out=inner[1:])
        two = np.zeros(len(starts), bool)
        inside = starts + 1 < len(data)
        two[inside] = (kind[starts[inside]] == 1) & (kind[starts[inside] + 1] == 1)
        count = np.maximum(total(owner), 1)
        letters, size = np.maximum(upper + lower, 1), np.maximum(np.diff(bounds), 1)
        best = np.zeros(n)
        np.maximum.at(best, owner, weight)
        return np.column_stack([
            total(owner, weight) / count, total(owner, insult) / count, total(owner, marked), total(owner, marked & near) / count, total(owner, second) / count,
            upper / letters, total(owner, two) / count, stress / size, (other + stress) / size, digits / size,
            (inner[bounds[1:]] - inner[bounds[:-1]]) / count, np.maximum(hidden, 0) / count, np.log1p(total(owner)), best,
        ])


class Trees:
    """Histogram gradient boosting of the log loss; trees of full depth as arrays, so that all rows descend together."""

    def __init__(self, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 48, leaf: float = 3.0):
        self.rounds, self.depth, self.rate, self.bins, self.leaf = rounds, depth, rate, bins, leaf

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        b = np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T, strict=True)])
        share = np.clip(y.mean(), 1e-4, 1 - 1e-4)
        self.base, self.trees = float(np.log(share / (1 - share))), []
        value = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-value))
            g, h = p - y, np.maximum(p * (1 - p), 1e-9)
            feature, cut = np.zeros(2**self.depth - 1, int), np.full(2**self.depth - 1, self.bins)
            node = np.zeros(len(y), int)
            for level in range(self.depth):
                for k in range(2**level):
                    at, rows = 2**level - 1 + k, np.flatnonzero(node == k)
                    best = 1e-6
                    for f in range(x.shape[1]):
                        gs = np.cumsum(np.bincount(b[rows, f], g[rows], self.bins))
                        hs = np.cumsum(np.bincount(b[rows, f], h[rows], self.bins))
                        gl, hl, gr, hr = gs[:-1], hs[:-1], gs[-1] - gs[:-1], hs[-1] - hs[:-1]
                        n_l = np.cumsum(np.bincount(b[rows, f], minlength=self.bins))[:-1]
                        gain = gl**2 / (hl + self.leaf) + gr**2 / (hr + self.leaf) - gs[-1] ** 2 / (hs[-1] + self.leaf)
                        gain[(n_l < 8) | (len(rows) - n_l < 8)] = 0
                        if gain.max(initial=0) > best:
                            best, feature[at], cut[at] = gain.max(), f, int(gain.argmax())
                at = 2**level - 1 + node
                node = 2 * node + (b[np.arange(len(y)), feature[at]] > cut[at])
            out = -self.rate * np.bincount(node, g, 2**self.depth) / (np.bincount(node, h, 2**self.depth) + self.leaf)
            self.trees.append((feature, cut, out))
            value += out[node]
        return self

    def value(self, x: np.ndarray) -> np.ndarray:
        b = np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T, strict=True)])
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, leaves in self.trees:
            node = np.zeros(len(x), int)
            for level in range(self.depth):
                at = 2**level - 1 + node
                node = 2 * node + (b[rows, feature[at]] > cut[at])
            out += leaves[node]
        return out


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: knots of the increasing step function nearest to y over x."""
    order = np.argsort(x, kind="stable")
    ux, inverse = np.unique(x[order], return_inverse=True)
    pools: list[list[float]] = []
    for v, w, at in zip(np.bincount(inverse, y[order]), np.bincount(inverse), ux, strict=True):
        pools.append([v, w, at, at])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            v2, w2, _, hi = pools.pop()
            pools[-1] = [pools[-1][0] + v2, pools[-1][1] + w2, pools[-1][2], hi]
    xs = np.array([e for p in pools for e in (p[2], p[3])])
    ys = np.array([(p[0] + 0.5) / (p[1] + 1) for p in pools for _ in (0, 1)])
    return xs, np.maximum.accumulate(ys)


class Model:
    """Features, trees and calibration; score is in [0, 1] and strictly follows the trees' order within a calibrated step."""

    def __init__(self, features: Features, share: float):
        self.features, self.share, self.trees = features, share, None

    def fit(self, x: np.ndarray, y: np.ndarray) -> Model:
        if len(np.unique(y)) < 2 or len(y) < 8:
            return self
        rest = np.arange(len(y)) % 4 == 3
        if len(np.unique(y[rest])) < 2 or len(np.unique(y[~rest])) < 2:
            rest[:] = True
        self.trees = Trees().fit(x[~rest] if not rest.all() else x, y[~rest] if not rest.all() else y)
        self.knots = isotonic(self.trees.value(x[rest]), y[rest])
        return self

    def score(self, column: pa.Array) -> np.ndarray:
        if self.trees is None:
            return np.full(len(column), self.share)
        value = self.trees.value(self.features.of(column))
        return np.clip(0.98 * np.interp(value, *self.knots) + 0.02 / (1 + np.exp(-value)), 0, 1)


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Model:
    """A model of the labelled rows of labels (doc_id, label); leave out held-out rows before."""
    picked = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_y"))
    picked = stored(spark, picked.orderBy(F.xxhash64("_id"), "_id", "_y").limit(sample), "label-sample")
    joined = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(picked) if sample <= BROADCAST_ROWS else picked, "_id")
    rows = stored(spark, joined.select("_y", "_text", F.xxhash64("_id").alias("_h")), "label-texts").repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 2))

    def toxic_stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = utf8(batch.column(1))
            for lo, hi in slices(bounds, 1 << 20):
                part, edge = data[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo]
                h = _text_stems(part, edge)[1]
                values, counts = np.unique(h, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))], ["stem", "n"])

    counts = rows.where("_y = 1").select("_y", "_text").mapInArrow(tidy(toxic_stems), "stem long, n long").groupBy("stem").agg(F.sum("n").alias("n"))
    toxic = rows.where("_y = 1").count()
    candidates = counts.where(F.col("n") >= max(LEAST_TEXTS, LEAST_SHARE * toxic)).select("stem").toPandas()["stem"].to_numpy()
    candidates = np.sort(candidates.astype(np.int64).view(np.uint64))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, len(candidates) + 1), np.int64)
        for batch in batches:
            data, bounds = utf8(batch.column(1))
            y = batch.column(0).to_numpy()
            np.add.at(n[:, -1], y, 1)
            for lo, hi in slices(bounds, 1 << 20):
                o, h = _text_stems(data[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo])
                at = _member(h, candidates)
                for c in (0, 1):
                    n[c, :-1] += np.bincount(at[(at >= 0) & (y[lo + o] == c)], minlength=len(candidates))
        there = np.flatnonzero(n.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(n[0, there]), pa.array(n[1, there])], ["at", "n0", "n1"])

    table = rows.select("_y", "_text").mapInArrow(tidy(count), "at long, n0 long, n1 long").groupBy("at").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toPandas()
    n0, n1 = np.zeros(len(candidates) + 1), np.zeros(len(candidates) + 1)
    n0[table["at"]], n1[table["at"]] = table["n0"], table["n1"]
    all0, all1 = n0[-1], n1[-1]
    lift = np.log(((n1[:-1] + 0.5) / (all1 + 1)) / ((n0[:-1] + 0.5) / (all0 + 1)))
    good = np.flatnonzero((lift > LIFT) & (n1[:-1] >= LEAST_TEXTS) & (lift * np.sqrt(n1[:-1]) >= CLEAR))
    features = Features(candidates[good], lift[good])

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features.of(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(0), pa.array(list(x), pa.list_(pa.float64()))], ["h", "y", "x"])

    fitted = rows.select("_y", "_text", "_h").mapInArrow(tidy(dense), "h long, y int, x array<double>").toPandas().sort_values("h", kind="stable")
    share = all1 / (all0 + all1) if all0 + all1 else 0.0
    return Model(features, float(share)).fit(np.array(fitted["x"].tolist()).reshape(-1, len(FEATURES)), fitted["y"].to_numpy())


def _text_stems(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (text, stem) pairs."""
    starts, owner, hashes = words(data, bounds, ALNUM_TABLE)
    all_stems = stems(data, starts, hashes)
    there = all_stems != 0
    return distinct(np.repeat(owner, all_stems.shape[1]).reshape(all_stems.shape)[there], all_stems[there])


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(batch.column(1)))], ["doc_id", "score"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(tidy(run), f"doc_id {docs.schema[doc_id].dataType.simpleString()}, score double")


def clean(docs: DataFrame, model: Model, text: str = "text", most: float = 0.5) -> DataFrame:
    """The rows of docs that score below most, with all their columns."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.score(batch.column(at)) < most))

    return docs.mapInArrow(tidy(run), docs.schema)
