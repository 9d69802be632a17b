"""The pipeline against a plain version of its stages on a small corpus."""

import random

import numpy as np
import pytest

from quire.llm import setsketch, tiling
from tests.llm.test_dedup import brute_links, brute_sets, union_find
from tests.llm.test_secrets import brute
from tests.llm.test_warc_tiling_pii import greedy

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def corpus():
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice(["th", "er", "on", "an", "re", "he", "in", "ed"]) for _ in range(rnd.randint(1, 3)))
    make = lambda n: [word() for _ in range(n)]
    items = [make(30) for _ in range(4)]
    rows, labels = [], []
    for i in range(400):
        text = make(rnd.randint(5, 60))
        kind = i % 10
        if kind == 1 and i > 10:
            text = list(rows[i - 10 - 1 + 0][1].split(" "))
            text[-1:] = make(1) if rnd.random() < 0.5 else text[-1:]
        if kind == 2:
            item = rnd.choice(items)
            text[3:3] = item[15:] + ["x"] + item[:15]
        if kind == 3:
            text.append('token = "' + "k3y" * 6 + '"')
        toxic = int(kind == 4)
        if toxic:
            for _ in range(4):
                text.insert(rnd.randrange(len(text)), rnd.choice(["snarf", "snarfle", "gobble"]))
        rows.append((i, " ".join(text), "en", "s", 0))
        labels.append((i, 1, toxic))
    rows += [(400, None, None, None, None), (401, "", "en", "s", 0), (402, "   ", "en", "s", 3)]
    return rows, labels, items


def test_pipeline(spark, tmp_path):
    rows, labels, items = corpus()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    got = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        assert name == "encoding" or out.columns == docs.columns and out.dtypes == docs.dtypes
        docs = spark.read.parquet(str(tmp_path / name))
        got.append({r.doc_id: r for r in docs.collect()})

    kept = {i: t for i, t, *_ in rows if i >= 400 or labels[i][2] == 0}
    assert len(set(got[0]) ^ set(kept)) <= 2  # a model: toxic documents go, clean ones stay
    kept = {i: t for i, t, *_ in rows if i in got[0]}

    ids = sorted(kept)
    sets = brute_sets([kept[i] for i in ids], 5)
    root = union_find(len(ids), brute_links(sets, 80))
    kept = {i: kept[i] for n, i in enumerate(ids) if root[n] == n}
    assert set(got[1]) == set(kept)

    leaks = {i for i, t in kept.items() for item in items if t and greedy(t.split(), item, tiling.LEAST) >= tiling.COVERAGE * len(item)}
    assert leaks and set(got[2]) == set(kept) - leaks
    kept = {i: t for i, t in kept.items() if i not in leaks}

    hidden = 0
    for i, t in kept.items():
        spans, out, done = brute(t or ""), "", 0
        for s, k, e in spans:
            out, done = out + t[done:s] + f"[REDACTED:{k}]", e
        assert got[3][i].text == (t if t is None else out + t[done:])
        assert t is None or got[3][i].n_chars == len(got[3][i].text)
        hidden += len(spans)
    assert hidden

    tiktoken, public_tokenizers = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    import base64

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert {i: r.ids for i, r in got[4].items()} == {i: library.encode_ordinary(r.text or "") for i, r in got[3].items()}
    assert {(r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == {(i, r.n_tokens) for i, r in got[4].items()}
    assert corpus_pipeline.ORACLE_SQL is None


def test_thresholds():
    assert setsketch.rows_a_band(0.85) == 6 and setsketch.rows_a_band(0.8) == 5
    assert 0.7 < setsketch.cut_of(0.85) < 0.75
    assert np.isclose(tiling.COVERAGE, 0.6)
