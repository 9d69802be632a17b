"""Every query with SQL gives the same rows as DuckDB on the smallest tables."""

import math
import os

import pandas as pd
import pytest

from quire.plans import queries, registry  # noqa: F401

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.sql("set TimeZone='UTC'")
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, float):
        return round(v, 6)
    return str(pd.Timestamp(v)) if hasattr(v, "isoformat") else v if isinstance(v, (int, bool)) else str(v)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_equal_to_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    expected = duck.sql(registry.ORACLE[name])
    columns = sorted(df.columns)
    assert columns == sorted(expected.columns)
    places = [expected.columns.index(c) for c in columns]
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    assert got == sorted((tuple(plain(r[i]) for i in places) for r in expected.fetchall()), key=str)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE)))
def test_others_run(spark, name):
    """These have no SQL: tests of their operators hold them against plain Python; here each runs on the tables."""
    rows = registry.QUERIES[name](spark, SF).collect()
    assert rows or name == "diff_sweeps"  # no conversation here has the same replacement twice


def test_seams_and_columns_equal_plain_python(spark):
    import difflib

    from quire.functions import geometry

    rows = sorted(registry.QUERIES["seam_overlap"](spark, SF).collect())
    texts = {(r.conv_id, r.turn): r.text.replace(". ", ".\n") for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()}
    clean = lambda t: [x.strip() for x in t.splitlines() if x.strip()]
    for r in rows:
        a, b = clean(texts.get((r.conv_id, r.turn - 1), "")), clean(texts[r.conv_id, r.turn])
        best = (None, None)
        for k in range(2, min(len(a), len(b), 8) + 1):
            ratios = [difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a[-k:], b[:k], strict=True)]
            if sum(ratios) / k >= 0.6 and min(ratios) >= 0.5:
                best = (k, round(sum(ratios) / k, 3))
        assert (r.lines, r.similarity) == best
    boxes = queries._corners(spark, SF).toPandas()
    got = {(r.page, r.box_id): (r.column, r.place) for r in registry.QUERIES["column_cluster"](spark, SF).collect()}
    for page, f in boxes.groupby("page"):
        columns = geometry.cluster_columns(((f["x0"] + f["x1"]) / 2).tolist(), (f["x1"] - f["x0"]).tolist())
        for c in set(columns):
            own = sorted((y, x, b) for y, x, b, k in zip(f["y0"], f["x0"], f["box_id"], columns, strict=True) if k == c)
            assert [got[page, b] for *_, b in own] == [(c, i) for i in range(len(own))]
