"""The queries op1 to op10 with all columns that their contracts name, on the driver's smallest tables."""

import hashlib
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from quire.llm import bitplane, bpe_tree, langid, queries, secrets_dfa, setsketch, surrogates, tiling, toxicity, warc
from tests.llm.test_warc_tiling_pii import greedy
from tests.test_queries_against_sql import SF, TABLES, plain

duckdb = pytest.importorskip("duckdb")
public_tokenizers = pytest.importorskip("public_tokenizers")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def texts():
    t = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    return dict(zip(t["doc_id"], t["text"], strict=True))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equal_to_sql(spark, name):
    duck = duckdb.connect()
    for t in TABLES:
        duck.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df, expected = queries.queries()[name](spark, SF), duck.sql(queries.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(expected.columns)
    places = [expected.columns.index(c) for c in columns]
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    assert got == sorted((tuple(plain(r[i]) for i in places) for r in expected.fetchall()), key=str)


def rows_of(df, key="doc_id"):
    rows = df.collect()
    assert len({r[key] for r in rows}) == len(rows)
    return {r[key]: r for r in rows}


def test_op1(spark, texts):
    from tokenizers import Tokenizer

    t, start = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0
    got = rows_of(queries.op1_bitplane_tokens(spark, SF))
    assert got.keys() == texts.keys()
    for i in sorted(texts):
        ids = t.encode(texts[i] or "", add_special_tokens=False).ids + [0]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_op2(spark, texts):
    items = {i: x for i, x in zip(*pq.read_table(f"{SF}/benchmark.parquet").select(["item_id", "text"]).to_pydict().values(), strict=True)}
    cut = lambda x: re.findall(r"[a-z0-9\x80-\U0010ffff]+", (x or "").lower())
    grams = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    item_words = {i: cut(x) for i, x in items.items()}
    item_grams = {i: grams(w) for i, w in item_words.items()}
    expected = {}
    for d, text in texts.items():
        w = cut(text)
        own = grams(w)
        for i, g in item_grams.items():
            if len(own & g) * 5 >= tiling.COVERAGE * len(item_words[i]):
                # What greedy tiling marks stands within the words of common five-word runs.
                near = [k for k in range(len(w) - 4) if tuple(w[k : k + 5]) in g]
                part = sorted({k + j for k in near for j in range(5)})
                gaps = [x for k, x in enumerate(part) if k and x > part[k - 1] + 1]
                piece = [y for x in part for y in ([f"|{x}"] if x in gaps else []) + [w[x]]]
                n = greedy(piece, item_words[i], 5)
                if n >= tiling.COVERAGE * len(item_words[i]):
                    expected[d, i] = n
    got = {(r.doc_id, r.item_id): r.covered_words for r in queries.op2_string_tiling(spark, SF).collect()}
    assert got == expected and got


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


def copied(tmp_path, **tables):
    for name in ("documents", "labels"):
        pq.write_table(tables.get(name, pq.read_table(f"{SF}/{name}.parquet")), tmp_path / f"{name}.parquet")
    return str(tmp_path)


def test_op3_and_that_no_held_out_label_is_learned(spark, texts, tmp_path):
    got = rows_of(queries.op3_toxicity_trees(spark, SF))
    assert got.keys() == texts.keys()
    for i, r in got.items():
        assert r.held_out == (fold(i, 5) == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    labels = pq.read_table(f"{SF}/labels.parquet").to_pandas()
    held = labels["doc_id"].map(lambda i: fold(i, 5) == 0)
    labels.loc[held, "toxic"] = 1 - labels.loc[held, "toxic"]
    docs = pq.read_table(f"{SF}/documents.parquet").to_pandas()
    docs["lang"], docs["source"] = "zz", "other"
    again = rows_of(queries.op3_toxicity_trees(spark, copied(tmp_path, labels=pa.Table.from_pandas(labels), documents=pa.Table.from_pandas(docs))))
    assert {i: r.score for i, r in again.items()} == {i: r.score for i, r in got.items()}


def test_op4_against_regexes(spark, texts):
    base = (("assign", r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=\-]+)"), ("access", "AKIA[A-Z0-9]+"), ("hex", "[0-9a-f]+"))
    got = rows_of(queries.op4_secret_automaton(spark, SF))
    for i, text in texts.items():
        spans = []
        for k, (kind, pattern) in enumerate(base):
            spans += [(m.start(), k, m.end()) for m in re.finditer(pattern, text or "") if len(m[2] if k == 0 else m[0]) >= (12, 18, 16)[k]]
        said = [f"{base[k][0]}:{s}:{e}" for s, k, e in sorted(spans)]
        r = got[i]
        assert r.base_sha256 == hashlib.sha256(",".join(said).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == x for _, k, _ in spans) for x in range(3)]
        assert [x for x in r.spans.split(",") if x.split(":")[0] in ("assign", "access", "hex")] == said


def test_op5(spark, texts):
    import base64

    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken")) as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(str.split, f)}
    t = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = rows_of(queries.op5_bpe_tree(spark, SF))
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        ids = t.encode_ordinary(text or "")
        sha = lambda x: hashlib.sha256(x).hexdigest()
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), sha(" ".join(map(str, ids)).encode()), sha((text or "").encode()))


def test_op7_and_that_no_held_out_language_is_learned(spark, texts, tmp_path):
    docs = pq.read_table(f"{SF}/documents.parquet").to_pandas()
    truth = dict(zip(docs["doc_id"], docs["lang"], strict=True))
    learned = {x for i, x in truth.items() if x is not None and fold(i, 4) != 2}
    got = rows_of(queries.op7_language_hierarchy(spark, SF))
    assert got.keys() == texts.keys()
    for i, r in got.items():
        assert r.held_out == (fold(i, 4) == 2) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, texts[i] or ""))) and r.lang_pred in learned | {"und"}
    held = [i for i in got if got[i].held_out and truth[i] and len(texts[i] or "") > 200]
    assert np.mean([got[i].lang_pred == truth[i] for i in held]) > 0.9
    docs.loc[docs["doc_id"].map(lambda i: fold(i, 4) == 2), "lang"] = "xx"
    docs["source"] = "other"
    again = rows_of(queries.op7_language_hierarchy(spark, copied(tmp_path, documents=pa.Table.from_pandas(docs))))
    assert {i: (r.lang_pred, r.score) for i, r in again.items()} == {i: (r.lang_pred, r.score) for i, r in got.items()}


def check_digit(s):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(s))) % 10 == 0


def kind_of(m):
    bare = re.sub(r"\D", "", m)
    if "@" in m:
        return "email"
    if re.fullmatch(r"\d+(\.\d+){3}", m) and all(int(x) < 256 for x in m.split(".")):
        return "ip"
    if re.match(r"[A-Z]{2}\d{2}", m):
        return "iban"
    if re.fullmatch(r"\d{3}-\d{2}-\d{4}", m):
        return "ssn"
    if m[0].isalpha():
        return "name"
    if m[0] == "+" and len(bare) >= 7 or m[0] == "(" or re.fullmatch(r"\d{3}[.\-]\d{3}[.\-]\d{4}", m):
        return "phone"
    return "card" if m[0] != "+" and check_digit(bare) else None


def test_op9_against_plain_python(spark, texts):
    """The same matches, everything between them as it was, and one surrogate for one entity over the whole table."""
    regex = pytest.importorskip("regex")
    pattern, got = regex.compile(surrogates.PATTERN), rows_of(queries.op9_pii_surrogates(spark, SF))
    assert got.keys() == texts.keys()
    seen, back, total = {}, {}, 0
    for i, text in texts.items():
        if text is None:
            assert got[i].text is None
            continue
        found = [(m.start(), m.end(), kind_of(m[0])) for m in pattern.finditer(text)]
        assert got[i].n_entities == sum(k is not None for *_, k in found)
        assert got[i].kinds == ",".join(sorted({k for *_, k in found if k}))
        at, new = 0, got[i].text
        between = []
        for s, e, k in [x for x in found if x[2]]:
            between.append(re.escape(text[at:s]) + "(.+?)")
            at = e
        m = re.fullmatch("".join(between) + re.escape(text[at:]), new, re.S)
        assert m, i
        total += len(between)
        for (s, e, k), x in zip([x for x in found if x[2]], m.groups(), strict=True):
            key = k, re.sub(r"[ .\-()+]", "", text[s:e]).lower() if k in ("phone", "card", "ssn", "iban") else text[s:e].lower()
            value = k, re.sub(r"[ .\-()+]", "", x).lower() if k in ("phone", "card", "ssn", "iban") else x.lower()
            assert x != text[s:e] and seen.setdefault(key, value) == value and back.setdefault(value, key) == key
    assert total > 20 and not set(back) & set(seen)


NAMES = ["id", "_id", "item_id", "v", "row", "n", "sha", "size", "salt", "head", "block", "origin", "number", "payload", "spans", "ids", "start", "score", "lang_pred", "x", "y", "h", "_y", "_h", "stem", "component", "part", "shard", "file", "uri"]


def test_clashing_columns_empty_tables_and_repeated_rows(spark):
    rows = [(2, "the same words stand here twice now", "en"), (2, "the same words stand here twice now", "en"), (None, None, None), (3, "", "en"), (1, "x" * 70_000, "de")]
    clash = [n for n in NAMES]
    d = spark.createDataFrame([(i, t, la, *["c"] * len(clash)) for i, t, la in rows], "doc_id long, text string, lang string, " + ", ".join(f"{n} string" for n in clash))
    bench = spark.createDataFrame([(7, "same words stand here twice", "c")], "item_id long, text string, doc_id string")
    labels = spark.createDataFrame([(2, 1, "c"), (3, 0, "c")], "doc_id long, toxic int, text string")
    rank, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    pages = d.select("*", d.doc_id.alias("page_id"), d.text.alias("html"), d.lang.alias("url"))
    runs = {
        "op1": lambda d: bitplane.read(spark, bitplane.write(spark, d, public_tokenizers.path("byte_bpe_50k.json"), 0)),
        "op3": lambda d: toxicity.score(d, toxicity.train(spark, d, labels)),
        "op4": secrets_dfa.scan,
        "op5": lambda d: bpe_tree.decode(bpe_tree.encode(d, rank, pattern), rank, pattern),
        "op7": lambda d: langid.predict(d, langid.train(spark, d)),
        "op8": lambda d: warc.resolved(warc.read(spark, warc.write(spark, d))),
        "op9": lambda d: surrogates.surrogates(spark, d, "k"),
        "op10": lambda d: setsketch.link(spark, d),
    }
    for name, run in runs.items():
        given = pages if name == "op8" else d
        out = run(given)
        assert out.count() == 5 and run(given.limit(0)).count() == 0, name
    assert sorted((r.doc_id, r.item_id) for r in tiling.contaminated(spark, d, bench).collect()) == [(2, 7), (2, 7)]
    for kept in (tiling.clean(d, bench), secrets_dfa.redact(d), toxicity.clean(d, toxicity.train(spark, d, labels.limit(0)))):
        assert kept.columns == d.columns
    assert tiling.clean(d, bench).count() == 3


def test_a_seed_that_all_items_have(spark):
    rnd = np.random.default_rng(5)
    common = "in the beginning there was the word".split()
    items = [[*common, *(f"i{i}w{j}" for j in rnd.integers(0, 40, 20))] for i in range(60)]
    texts = [" ".join([*common, *(f"t{i}x{j}" for j in range(30))]) for i in range(40)] + [" ".join(["so", *x[3:], "end"]) for x in items[:5]] + [" ".join([*x[10:], "|", *x[:12]]) for x in items[5:8]]
    b = tiling.Benchmark(list(range(60)), [" ".join(x) for x in items])
    got = {(row, k): covered for row, k, _, covered, _ in b.leaks(pa.array(texts))}
    expected = {(t, i): n for t, x in enumerate(texts) for i, item in enumerate(items) if (n := greedy(x.split(), item, 5)) >= tiling.COVERAGE * len(item)}
    assert got == {k: v for k, v in expected.items()} and len(got) == 8
    assert not set(b.seeds.tolist()) & set.intersection(*[set(o.tolist()) for o in b.own])


def test_capital_letters_beyond_ascii_leak(spark):
    item = "über große Straßen führt école française niño mañana"
    b = tiling.Benchmark([1], [item])
    assert [x[:2] for x in b.leaks(pa.array([item.upper().replace("SS", "ß"), item.title(), "nothing"]))] == [(0, 0), (1, 0)]


def test_the_shared_folder(spark, tmp_path, monkeypatch):
    from quire.llm import shared

    class Unset:
        master = "spark://host:7077"

        def getConf(self):
            return {}

    class Session:
        sparkContext, conf = Unset(), {}

    with pytest.raises(ValueError):
        shared.shared_dir(Session(), "x")
    Unset.getConf = lambda self: {"spark.checkpoint.dir": str(tmp_path)}
    Session._jvm, Session._jsc = spark._jvm, spark._jsc
    assert shared.shared_dir(Session(), "x").startswith(f"file://{tmp_path}/x-")
