import random
import re

import numpy as np
import pytest

from quire.llm import embed_sorted, setsketch
from quire.llm.shared import components
from quire.llm.textcore import SPACE_TABLE, shingles, utf8, words


def union_find(n, pairs):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    return [find(i) for i in range(n)]


def test_components(spark):
    rnd = random.Random(5)
    pairs = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(300, 360)] + [(400, x) for x in range(401, 500)] + [(7, 7)]
    expected = union_find(500, pairs)
    got = {r.id: r.component for r in components(spark, spark.createDataFrame(pairs, "a long, b long")).collect()}
    there = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: expected[x] for x in there}
    assert components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def brute_sets(texts, k):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        out.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    return out


def brute_links(sets, percent):
    n = len(sets)
    return [(i, j) for i in range(n) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]


def near_corpus(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 6)))
    out = []
    for _ in range(25):
        base = [word() for _ in range(rnd.randint(3, 120))]
        out.append(" ".join(base))
        for _ in range(rnd.randint(0, 9)):
            copy = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 4])):
                copy[rnd.randrange(len(copy))] = word()
            out.append(rnd.choice([" ", "\n", "  "]).join(copy).upper() if rnd.random() < 0.3 else " ".join(copy))
    return out


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_near_copies_equal_brute_force(spark, texts, k, percent):
    corpus = texts + near_corpus(k)
    sets = brute_sets(corpus, k)
    expected = union_find(len(corpus), brute_links(sets, percent))
    docs = spark.createDataFrame(list(enumerate(corpus)), "doc_id long, text string").repartition(3)
    rows = sorted(setsketch.link(spark, docs, k, percent).collect())
    assert [r.n_shingles for r in rows] == [len(s) for s in sets]
    assert [r.component_id for r in rows] == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_large_buckets_are_tiled(spark, monkeypatch):
    monkeypatch.setattr(setsketch, "SMALL", 4)
    monkeypatch.setattr(setsketch, "TILE", 3)
    rnd = random.Random(9)
    base = [f"w{i}" for i in range(90)]
    corpus = []
    for _ in range(45):
        copy = list(base)
        for _ in range(rnd.choice([1, 2, 3, 5])):
            copy[rnd.randrange(90)] = f"x{rnd.randrange(10_000)}"
        corpus.append(" ".join(copy))
    sets = brute_sets(corpus, 3)
    docs = spark.createDataFrame(list(enumerate(corpus)), "doc_id long, text string")
    rows = sorted(setsketch.link(spark, docs, 3, 85).collect())
    assert [r.component_id for r in rows] == union_find(45, brute_links(sets, 85))


def test_null_and_repeated_ids_and_empty_tables(spark):
    d = spark.createDataFrame([(None, "a b c d"), (3, "a b c d"), (3, "a b c d"), (9, None), (5, "A b C d")], "doc_id long, text string")
    rows = sorted(setsketch.link(spark, d, 3, 85).collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    assert [(r.doc_id, r.component_id, r.kept) for r in rows] == [(3, 3, True), (3, 3, True), (5, 3, False), (9, 9, True), (None, None, True)]
    assert setsketch.link(spark, d.limit(0), 3, 85).count() == 0


def near(rnd, base, n):
    copy = list(base)
    for _ in range(n):
        copy[rnd.randrange(len(copy))] = f"x{rnd.randrange(10_000)}"
    return " ".join(copy)


def test_one_id_with_several_texts_has_the_links_of_all(spark):
    rnd = random.Random(3)
    a, b, c = ([f"{x}{i}" for i in range(120)] for x in "abc")
    rows = [(5, " ".join(a)), (5, " ".join(b)), (6, near(rnd, a, 1)), (7, near(rnd, b, 1)), (20, " ".join(c)), (21, " ".join(c)), (21, near(rnd, a, 1)), (30, "alone"), (30, "alone")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.component_id) for r in setsketch.link(spark, d, 3, 85).collect())
    assert got == [(i, 30 if i == 30 else 5) for i, _ in rows]


@pytest.mark.parametrize("most", ["TILE", "TILE_SHINGLES"])
def test_blocks_are_cut_by_rows_and_by_shingles(spark, monkeypatch, most):
    monkeypatch.setattr(setsketch, most, 4 if most == "TILE" else 300)
    monkeypatch.setattr(setsketch, "SMALL", 4)
    rnd = random.Random(12)
    corpus = []
    for g in range(3):
        base = [f"g{g}w{i}" for i in range(100)]
        corpus += [near(rnd, base, rnd.choice([0, 1, 2, 4, 6])) for _ in range(20)]
        base = near(rnd, base, 9).split()
        corpus += [near(rnd, base, rnd.choice([1, 2])) for _ in range(6)]
    expected = union_find(len(corpus), brute_links(brute_sets(corpus, 3), 85))
    docs = spark.createDataFrame(list(enumerate(corpus)), "doc_id long, text string").repartition(5)
    assert [r.component_id for r in sorted(setsketch.link(spark, docs, 3, 85).collect())] == expected


def test_clashing_columns(spark):
    names = ["id", "component", "part", "n", "k1", "k2", "bucket", "head", "registers", "blocks", "a", "b"]
    d = spark.createDataFrame([(i, "a b c d", *["x"] * len(names)) for i in (4, 2)], ["doc_id", "text", *names])
    assert sorted((r.doc_id, r.component_id) for r in setsketch.link(spark, d, 3, 85).collect()) == [(2, 2), (4, 2)]


def test_likelihood_is_close_to_the_similarity():
    rng = np.random.default_rng(4)
    found, true = [], []
    for j in (0.5, 0.8, 0.9):
        for _ in range(20):
            n = 800
            both = rng.integers(1, 2**63, int(n * 2 * j / (1 + j)), dtype=np.uint64)
            a, b = (np.r_[both, rng.integers(1, 2**63, n - len(both), dtype=np.uint64)] for _ in range(2))
            s = [setsketch.sketch(x, np.array([0])) for x in (a, b)]
            found.append(setsketch.likelihood(*s, np.array([float(n)]), np.array([float(n)]))[0])
            true.append(len(both) / (2 * n - len(both)))
    assert np.abs(np.array(found) - true).mean() < 0.03


def test_the_likelihood_rises_up_to_its_maximum():
    rng = np.random.default_rng(14)
    a = rng.integers(0, 4, (3000, setsketch.REGISTERS)).astype(np.uint16)
    b = np.where(rng.random(a.shape) < rng.random((3000, 1)), a, rng.integers(0, 4, a.shape)).astype(np.uint16)
    n = rng.integers(60, 100, (2, 3000)).astype(float)
    more, less = (a > b).sum(1), (a < b).sum(1)
    best = setsketch.likelihood(a, b, *n, step=0.002)
    for at in (0.3, 0.5, 0.6):
        up = setsketch.rises(more, less, setsketch.REGISTERS - more - less, *n, at)
        clear = np.abs(best - at) > 0.003
        assert (up == (best >= at))[clear].all() and 0.1 < up.mean() < 0.95


def test_registers_of_a_union_are_the_maxima():
    rng = np.random.default_rng(6)
    a, b = (rng.integers(1, 2**63, 50, dtype=np.uint64) for _ in range(2))
    one = [setsketch.sketch(x, np.array([0])) for x in (a, b, np.r_[a, b])]
    assert (np.maximum(one[0], one[1]) == one[2]).all()


def test_words_and_shingles(texts):
    import pyarrow as pa

    data, bounds = utf8(pa.array(texts))
    _, owner, hashes = words(data, bounds, SPACE_TABLE)
    for k in (1, 3, 5):
        h, o = shingles(owner, hashes, k)
        sets = brute_sets(texts, k)
        assert [len(set(h[o == i].tolist())) for i in range(len(texts))] == [len(s) for s in sets]


def vectors():
    rng = np.random.default_rng(8)
    out = [rng.standard_normal(16) for _ in range(150)]
    for i in range(0, 60, 6):
        out += [out[i] + rng.standard_normal(16) * s for s in (0.02, 0.05, 0.1, 0.1, 0.15)]
    out += [out[3]] * 3 + [out[90] + rng.standard_normal(16) * 0.12 for _ in range(70)]
    return [x.tolist() for x in out] + [None, [0.0] * 16, [float("nan")] * 16, [1.0, None], [1.0, 2.0], [2.0, 4.0], [], [float("inf")] * 16, [1e-200] * 16, [3e200] * 16]


def test_embeddings_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embed_sorted, "STRIP", 16)
    rows = vectors()
    good = [x is not None and len(x) and None not in x and np.isfinite(x).all() and any(x) for x in rows]
    unit = [np.array(x) / max(map(abs, x)) if g else None for x, g in zip(rows, good, strict=True)]
    unit = [None if x is None else x / np.linalg.norm(x) for x in unit]
    n = len(rows)
    pairs = [(i, j) for i in range(n) for j in range(i) if good[i] and good[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.95]
    degree = np.bincount([x for p in pairs for x in p], minlength=n)
    v = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    for settings in ({}, {"window": 8, "block_bytes": 1 << 11}):
        out = sorted(embed_sorted.link(spark, v, **settings).collect())
        assert [r.n_links for r in out] == degree.tolist()
        assert [r.component_id for r in out] == union_find(n, pairs)
        assert all(r.kept == (r.vec_id == r.component_id) for r in out)
    assert embed_sorted.link(spark, v.limit(0)).count() == 0


def test_null_repeated_ids_and_clashing_columns_of_embeddings(spark):
    a, b, c = [1.0, 0.0], [0.0, 1.0], [-1.0, 0.01]
    names = ["id", "v", "key", "dim", "row", "at", "component", "core", "weight", "k1", "k2", "n"]
    rows = [(None, a), (5, a), (5, b), (6, [1.0, 0.01]), (7, [0.01, 1.0]), (8, c), (8, c), (9, None), (9, c), (None, None)]
    d = spark.createDataFrame([(i, v, *["x"] * len(names)) for i, v in rows], "vec_id long, embedding array<double>, " + ", ".join(f"{n} string" for n in names))
    out = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embed_sorted.link(spark, d).collect()), key=str)
    assert out == sorted([(None, 0, None, True)] * 2 + [(5, 1, 5, True)] * 2 + [(6, 1, 5, False), (7, 1, 5, False), (8, 2, 8, True), (8, 2, 8, True), (9, 0, 9, True), (9, 2, 8, False)], key=str)


def test_windows_tell_where_they_are_short():
    rng = np.random.default_rng(2)
    keys = np.sort(np.r_[rng.integers(0, 2**62, 300), rng.integers(0, 2**40, 200), [5] * 40, [2**62 - 1] * 3])
    bits = [format(int(k), "062b") for k in keys]
    share = lambda x, y: next((i for i in range(62) if x[i] != y[i]), 62)
    assert [share(bits[i], bits[i + 7]) for i in range(500)] == embed_sorted._shared_signs(keys[:500], keys[7:507]).tolist()
    for depth in (1, 4, 9):
        got = embed_sorted._short(keys, 12, depth, True, True)
        assert got.tolist() == [any(abs(i - j) > 12 and share(bits[i], bits[j]) >= depth for j in range(len(keys))) for i in range(len(keys))]
        # A part of the order alone may only tell of more short windows.
        part = embed_sorted._short(keys[100:400], 12, depth, False, False)
        assert (part | ~got[100:400]).all()


def test_no_link_is_lost_in_dense_regions(spark):
    rng = np.random.default_rng(3)
    topic = rng.standard_normal(16)
    rows = [topic + rng.standard_normal(16) * 0.45 for _ in range(600)]
    rows += [rows[i] + rng.standard_normal(16) * 0.15 for i in range(0, 100, 2)] + [rows[5]] * 40
    unit = np.array(rows) / np.linalg.norm(rows, axis=1)[:, None]
    pairs = [(i, j) for i, j in zip(*np.nonzero(unit @ unit.T >= 0.95)) if j < i]
    v = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rows)], "vec_id long, embedding array<double>").repartition(3)
    for settings in ({"passes": 1, "window": 1, "block_bytes": 1 << 12}, {"window": 4}):
        out = sorted(embed_sorted.link(spark, v, **settings).collect())
        assert [r.n_links for r in out] == np.bincount(np.array(pairs).ravel(), minlength=len(rows)).tolist()
        assert [r.component_id for r in out] == union_find(len(rows), pairs)
