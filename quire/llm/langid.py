"""Language identification by hierarchical discrimination (operator 7).

A text's profile is its hashed byte trigrams and short word beginnings, letters only, with square-rooted counts of unit length. Linear
support vector machines first choose the language family (one against the rest); within it, one-versus-one machines separate the
languages, and most votes win, margins breaking ties.

The machines are fitted on at most SAMPLE texts a language and SAMPLE_ROWS in all (those of the smallest hashes of their ids; documented
bounds). Every text is predicted and read whole, however long.
Defined results: a text that is null, empty or has no letter is `und` with score 0; with a single learned language that one is
predicted; with none, as from an empty table, every text is `und`; rows without a language are not learned from; of languages with
equal votes the one with the greater margin wins, then the first by code; repeated rows each give a row; extra columns are dropped,
whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.shared import stored, tidy
from quire.llm.textcore import ALNUM_TABLE, fmix, slices, utf8, words

SIZE = 2048
#: Texts that machines are fitted on, at most: of a language, and in all (each is SIZE numbers on the driver).
SAMPLE, SAMPLE_ROWS = 800, 16_000

#: Families of language codes. Others make a family of their own.
FAMILIES = {
    "germanic": "en de nl af sv da no nb nn is fy lb yi",
    "romance": "fr es it pt ca gl ro oc la",
    "slavic": "ru uk be bg sr hr bs sl mk cs sk pl",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tt",
    "indic": "hi bn mr ne gu pa ur ta te kn ml",
    "semitic": "ar he am mt",
    "sinitic": "zh yue wuu",
    "japonic": "ja",
    "koreanic": "ko",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

#: Letters keep a code, ASCII case folded; anything else is a space.
_LETTER = np.zeros(256, np.uint32)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def family_of(lang: str) -> str:
    return _FAMILY.get(lang.split("-")[0].lower(), "other")


def profiles(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """Slices of a text column with the texts' profiles."""
    data, bounds = utf8(column)
    for lo, hi in slices(bounds, rows=512):
        n, base = hi - lo, int(bounds[lo])
        c = _LETTER[data[base : bounds[hi]]].astype(np.uint64)
        out = np.zeros(n * SIZE)
        if len(c) > 2:
            owner = np.repeat(np.arange(n), np.diff(bounds[lo : hi + 1]))
            gram = (c[:-2] << np.uint64(16)) | (c[1:-1] << np.uint64(8)) | c[2:]
            fine = (owner[:-2] == owner[2:]) & ((c[:-2] > 0).astype(np.int8) + (c[1:-1] > 0) + (c[2:] > 0) >= 2)
            at = (gram[fine] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(53)).astype(np.int64) % SIZE
            out += np.bincount(owner[:-2][fine] * SIZE + at, minlength=n * SIZE)
        starts, wo, wh = words(data[base : bounds[hi]], bounds[lo : hi + 1] - base, ALNUM_TABLE)
        out += np.bincount(wo * SIZE + (fmix(wh) % np.uint64(SIZE)).astype(np.int64), minlength=n * SIZE)
        x = np.sqrt(out.reshape(n, SIZE)).astype(np.float32)
        yield lo, hi, x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def fit_svm(x: np.ndarray, y: np.ndarray, c: float = 20.0, rounds: int = 80) -> np.ndarray:
    """Weights and bias of a linear machine for y in -1, 1: squared hinge loss with an L2 term, by accelerated gradient steps."""
    x = np.column_stack([x, np.ones(len(x), np.float32)])
    y = y.astype(np.float32)
    balance = (np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)) * c * 10).astype(np.float32)
    w = v = np.zeros(x.shape[1], np.float32)
    step, t = np.float32(1 / (1 + 2 * c * 10 * float((x**2).sum(1).max()))), 1.0
    for _ in range(rounds):
        gap = np.maximum(0, 1 - y * (x @ v))
        new = v - step * (v - 2 * x.T @ (balance * y * gap))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + np.float32((t - 1) / t2) * (new - w), new, t2
    return w


def _margin(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


class Hierarchy:
    """The family machines and each family's one-versus-one machines."""

    def __init__(self, x: np.ndarray, langs: np.ndarray):
        self.langs = sorted(set(langs.tolist()))
        self.families = sorted({family_of(k) for k in self.langs})
        fam = np.array([family_of(k) for k in langs])
        self.family = [fit_svm(x, np.where(fam == f, 1.0, -1.0)) for f in self.families] if len(self.families) > 1 else []
        self.inside = {}
        for f in self.families:
            own = [k for k in self.langs if family_of(k) == f]
            pairs = [(a, b) for i, a in enumerate(own) for b in own[i + 1 :]]
            self.inside[f] = own, {}
            for a, b in pairs:
                rows = (langs == a) | (langs == b)
                self.inside[f][1][a, b] = fit_svm(x[rows], np.where(langs[rows] == a, 1.0, -1.0))

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Languages, and scores in [0, 1]: how sure the family and the vote within it are."""
        sure = lambda m: 1 / (1 + np.exp(-3 * m))
        if self.family:
            margins = np.column_stack([_margin(x, w) for w in self.family])
            chosen = margins.argmax(1)
            score = sure(margins.max(1))
        else:
            chosen, score = np.zeros(len(x), int), np.ones(len(x))
        out = np.empty(len(x), object)
        for i, f in enumerate(self.families):
            rows = np.flatnonzero(chosen == i)
            own, machines = self.inside[f]
            votes, total = np.zeros((len(rows), len(own))), np.zeros((len(rows), len(own)))
            for (a, b), w in machines.items():
                m, ia, ib = _margin(x[rows], w), own.index(a), own.index(b)
                votes[:, ia] += m >= 0
                votes[:, ib] += m < 0
                total[:, ia] += m
                total[:, ib] -= m
            best = (votes + 0.4 * np.tanh(total)).argmax(1) if len(own) > 1 else np.zeros(len(rows), int)
            out[rows] = np.array(own, object)[best]
            if len(own) > 1:
                score[rows] *= sure(total[np.arange(len(rows)), best] / (len(own) - 1))
        return out, score


def train(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Hierarchy | None:
    """Machines learned from the rows of docs with a language; leave out held-out rows before. None if there is no such row."""
    known = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"), F.col(lang).alias("_lang")).where("_lang is not null and _text is not null")
    counts = {r["_lang"]: r["count"] for r in known.groupBy("_lang").count().collect()}  # one row a language
    if not counts:
        return None
    sample = max(1, min(sample, SAMPLE_ROWS // len(counts)))
    place = F.pmod(F.xxhash64("_id", F.lit(7)), F.lit(1_000_000))
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1_000_000, int(1_500_000 * sample / n) + 1)))])
    some = known.where(place < share[F.col("_lang")]).select("_lang", "_text", place.alias("_h"))
    first = F.row_number().over(Window.partitionBy("_lang").orderBy("_h", "_text"))  # of about half more than the sample
    rows = stored(spark, some.withColumn("_n", first).where(F.col("_n") <= sample).drop("_n"), "language-texts")

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, x in profiles(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array([r.tobytes() for r in x], pa.binary()), batch.column(2).slice(lo, hi - lo)], ["lang", "x", "h"])

    got = rows.mapInArrow(tidy(dense), "lang string, x binary, h long").toPandas().sort_values(["lang", "h"], kind="stable")
    if got.empty:
        return None
    return Hierarchy(np.frombuffer(b"".join(got["x"]), np.float32).reshape(len(got), SIZE), got["lang"].to_numpy())


def predict(docs: DataFrame, model: Hierarchy | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = np.full(len(batch), "und", object), np.zeros(len(batch))
            data, bounds = utf8(batch.column(1))
            for lo, hi, x in profiles(batch.column(1)) if model is not None else ():
                code = _LETTER[data[bounds[lo] : bounds[hi]]]
                letter = np.r_[0, np.cumsum((code > 0) & (code < 128))]
                edge = bounds[lo : hi + 1] - bounds[lo]
                has = (letter[edge[1:]] - letter[edge[:-1]]) > 0
                for i in np.flatnonzero(~has):
                    has[i] = any(map(str.isalpha, batch.column(1)[int(lo + i)].as_py() or ""))
                found, sure = model.predict(x)
                langs[lo:hi][has], scores[lo:hi][has] = found[has], sure[has]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(tidy(run), f"doc_id {docs.schema[doc_id].dataType.simpleString()}, lang_pred string, score double")
