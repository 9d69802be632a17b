import base64
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from quire.llm import surrogates, tiling, warc
from quire.llm.textcore import ALNUM_TABLE, utf8, words


def page_rows():
    big = "".join(chr(65 + i % 26) for i in range(200_000))
    html = [None, "", "<p>a</p>", "<p>a</p>", big, "é" * 50_000, big, "x" * 65_536, "<p>b</p>\r\n0\r\n\r\n", "<p>a</p>"]
    return [(i, f"http://h/{i}" if i % 3 else None, h) for i, h in enumerate(html)]


@pytest.mark.parametrize("segment", [1000, 65_536])
def test_archives_round_trip(spark, segment):
    rows = page_rows()
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    read = warc.read(spark, warc.write(spark, pages, segment=segment))
    out = sorted(warc.resolved(read).collect(), key=lambda r: r.page_id)
    raw = [(h or "").encode() for _, _, h in rows]
    head = {p: max(i for i, x in enumerate(raw) if x == p) for p in raw}
    assert len(out) == len(rows)
    for r, p in zip(out, raw, strict=True):
        assert r.payload_bytes == len(p)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(p).digest()).decode()
        assert (r.record_type, r.refers_to) == (("response", None) if head[p] == r.page_id else ("revisit", head[p]))
        assert r.record_type == "revisit" or bytes(r.payload) == p


def test_small_payloads_are_not_revisited(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "long enough"), (4, "u", "long enough"), (4, "u", "long enough"), (None, "u", "long enough")], "page_id long, url string, html string")
    out = [(r.page_id, r.record_type, r.refers_to) for r in warc.read(spark, warc.write(spark, pages, least=5)).collect()]
    assert sorted(out, key=str) == sorted([(1, "response", None), (2, "response", None), (3, "revisit", 4), (4, "response", None), (4, "response", None), (None, "response", None)], key=str)
    assert warc.read(spark, warc.write(spark, pages.limit(0))).count() == 0


def test_broken_archives_are_refused():
    parts = list(warc.page_records(1, "u", b"x" * 5000, None, "0-0", segment=1000))
    assert len(parts) == 6
    with pytest.raises(ValueError):
        list(warc.parse(b"".join(parts)[:-3]))
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc\r\n0\r\n\r\n")
    assert warc.unchunked(warc.chunked(b"a\r\n0\r\n\r\nb", 3)) == b"a\r\n0\r\n\r\nb"


def hashes(text):
    data, bounds = utf8(pa.array([text]))
    return words(data, bounds, ALNUM_TABLE)[2]


def test_tiles_are_disjoint_equal_and_found_in_any_order():
    rnd = random.Random(1)
    for _ in range(60):
        item = [rnd.choice("abcdefghijklmnop") * rnd.randint(1, 3) for _ in range(rnd.randint(5, 60))]
        cut = rnd.randint(0, len(item))
        noise = lambda: [f"n{rnd.randrange(999)}" for _ in range(rnd.randint(0, 20))]
        text = noise() + item[cut:] + noise() + item[:cut] + noise()
        t, i = hashes(" ".join(text)), hashes(" ".join(item))
        tiles = tiling.tile(t, i)
        seen_t, seen_i = set(), set()
        for a, b, n in tiles:
            assert n >= tiling.LEAST and (t[a : a + n] == i[b : b + n]).all()
            assert not seen_t & set(range(a, a + n)) and not seen_i & set(range(b, b + n))
            seen_t |= set(range(a, a + n))
            seen_i |= set(range(b, b + n))
        long_enough = (cut if cut >= 5 else 0) + (len(item) - cut if len(item) - cut >= 5 else 0)
        assert len(seen_i) >= long_enough * 0.8


def greedy(text, item, least):
    """Greedy string tiling by trying all pairs of places, the longest first."""
    free_t, free_i, total = [True] * len(text), [True] * len(item), 0
    while True:
        best = (0, 0, 0)
        for a in range(len(text)):
            for b in range(len(item)):
                n = 0
                while a + n < len(text) and b + n < len(item) and text[a + n] == item[b + n] and free_t[a + n] and free_i[b + n]:
                    n += 1
                if n > best[0]:
                    best = (n, a, b)
        if best[0] < least:
            return total
        n, a, b = best
        free_t[a : a + n] = free_i[b : b + n] = [False] * n
        total += n


def test_contamination_equals_brute_force(spark, docs):
    rnd = random.Random(2)
    vocabulary = [f"w{i}" for i in range(40)]
    items = [[rnd.choice(vocabulary) for _ in range(rnd.randint(3, 40))] for _ in range(12)]
    corpus = []
    for _ in range(60):
        text = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 80))]
        if rnd.random() < 0.5:
            item = list(rnd.choice(items))
            half = len(item) // 2
            item = item[half:] + item[:half] if rnd.random() < 0.5 else item
            text[10:10] = item[: rnd.randint(1, len(item))]
        corpus.append(text)
    bench = spark.createDataFrame([(i, " ".join(x).upper()) for i, x in enumerate(items)] + [(90, None), (91, "")], "item_id long, text string")
    d = spark.createDataFrame([(i, ", ".join(x) + ".") for i, x in enumerate(corpus)], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.covered_words for r in tiling.contaminated(spark, d, bench).collect()}
    expected = {(t, i) for t, text in enumerate(corpus) for i, item in enumerate(items) if len(item) >= 5 and greedy(text, item, 5) >= tiling.COVERAGE * len(item)}
    assert set(got) == expected and expected
    clean = tiling.clean(d, bench)
    assert {r.doc_id for r in clean.collect()} == set(range(60)) - {t for t, _ in expected}
    assert tiling.contaminated(spark, docs, bench).count() == 0
    assert tiling.contaminated(spark, d, bench.limit(0)).count() == 0 and tiling.clean(docs, bench).count() == docs.count()


def test_benchmark_blocks(spark, monkeypatch):
    monkeypatch.setattr(tiling, "BLOCK_BYTES", 200)
    texts = [" ".join(f"i{k}x{j}" for j in range(12)) for k in range(20)]
    bench = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    d = spark.createDataFrame([(k, "so " + t + " end") for k, t in enumerate(texts)], "doc_id long, text string")
    assert len(list(tiling.blocks(bench))) > 1
    assert {(r.doc_id, r.item_id) for r in tiling.contaminated(spark, d, bench).collect()} == {(k, k) for k in range(20)}


PII = [
    "Mr Smith met Mrs. Anna Jones at 10.0.0.255, v1.2.3.4.5 of 2.0",
    "write THE.72@MAIL3.EXAMPLE.COM or the.72@mail3.example.com, call +1 (942) 555-3625",
    "123-45-6789 and GB82 WEST 1234 5698 7654 32 and 4111 1111 1111 1111 and 4111111111111112",
    "Herr Иванов und Señora Núñez 4111-1111-1111-1111 почта@пример.рф",
    "nothing here but 496212436 and 3963522770391943 and 12:30",
]


def luhn(s):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(s))) % 10 == 0


def test_surrogates(spark, docs):
    d = spark.createDataFrame(list(enumerate(PII)) + [(7, None), (8, "")], "doc_id long, text string")
    tries = surrogates.attempts(spark, d, "k")
    out = {r.doc_id: r for r in surrogates.replace(d, "k", tries).collect()}
    for secret in ("Smith", "Anna Jones", "10.0.0.255", "THE.72", "the.72", "942) 555-3625", "123-45-6789", "WEST", "1111 1111 1111 1111", "Иванов", "Núñez", "почта"):
        assert all(secret not in (r.text or "") for r in out.values()), secret
    assert "v1.2.3.4.5 of 2.0" in out[0].text and out[4].text == PII[4] and out[4].n_entities == 0
    assert out[7].text is None and out[8].text == ""
    assert "4111111111111112" in out[2].text
    upper, lower = re.findall(r"\S+@\S+[A-Za-z]", out[1].text)
    assert upper.lower() == lower and upper == upper.upper()
    card = re.search(r"4\d{3} \d{4} \d{4} \d{4}", out[2].text).group()
    assert luhn(card.replace(" ", "")) and card.replace(" ", "-") in out[3].text
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", re.search(r"\+.*", out[1].text).group())
    assert re.search(r"[а-я]{5}@[а-я]{6}\.рф", out[3].text)
    assert out[2].kinds == "card,iban,ssn"
    odd = {r.doc_id: r.text for r in surrogates.replace(docs, "k").collect()}
    assert odd == {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert surrogates.replace(docs.limit(0), "k").count() == 0
    other = surrogates.replace(d, "another").where("doc_id = 1").first().text
    assert other != out[1].text


def made(spark, texts, key="k"):
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in sorted(surrogates.surrogates(spark, d, key).collect())]


def test_names_keep_coreference_gender_script_and_case(spark):
    out = made(spark, ["Mr John Smith met Mr Smith, Dr Smith's aide, Dr John Smith and MRS SMITH", "Mr SMITH or Frau Anna Smith", "Herr Иван Иванов, Господин Иванов", "Κύριος Νίκος Παππάς", "Mr James Smith", "Dr Anna Smith", "Mr O'Neil-Smith."])
    first = re.fullmatch(r"Mr (\w+) (\w+) met Mr (\w+), Dr (\w+)'s aide, Dr (\w+) (\w+) and MRS SMITH", out[0])
    given, surname, *rest = first.groups()
    assert rest == [surname, surname, given, surname] and given in surrogates.GIVEN["latin"]["m"].split()
    upper, female = re.fullmatch(r"Mr (\w+) or Frau (\w+) " + surname, out[1]).groups()
    assert upper == surname.upper() and female in surrogates.GIVEN["latin"]["f"].split() and out[5] == f"Dr {female} {surname}"
    a, b, c = re.fullmatch(r"Herr ([а-яёА-ЯЁ]+) ([а-яА-Я]+), Господин ([а-яА-Я]+)", out[2]).groups()
    assert b == c != "Иванов" and a in surrogates.GIVEN["cyrillic"]["m"].split()
    assert re.fullmatch(r"Κύριος [Α-Ωα-ωάέήίόύώ]+ [Α-Ωα-ω]+", out[3]) and "Παππάς" not in out[3]
    assert re.fullmatch(rf"Mr [\w-]+ {surname}", out[4]) and out[4] != f"Mr {given} {surname}"
    assert out[6].startswith("Mr ") and out[6].endswith(".") and "Neil" not in out[6]


def test_many_given_names_of_one_surname_stay_distinct(spark):
    texts = [f"{t} N{chr(97 + i // 26)}{chr(97 + i % 26)}o Smith" for i in range(30) for t in ("Mr", "Ms")]
    out = made(spark, texts)
    assert len(set(out)) == len(texts) and len({x.split()[-1] for x in out}) == 1
    for title, gender in (("Mr", "m"), ("Ms", "f")):
        used = {p for x in out if x.startswith(title) for p in x.split()[1].split("-")}
        assert used <= set(surrogates.GIVEN["latin"][gender].split())


def test_texts_that_hold_the_mark_and_long_texts(spark):
    texts = [f"a{surrogates._MARK}b 10.0.0.1 c{surrogates._MARK}", "10.0.0.1", "x " * 200_000 + "10.0.0.1", "10.0.0.1 10.0.0.1", surrogates._MARK]
    out = made(spark, texts)
    assert out == [t.replace("10.0.0.1", out[1]) for t in texts] and out[1] != "10.0.0.1"


def test_surrogates_are_a_bijection_that_keeps_the_format(spark):
    """Against plain Python: the same entities in any writing have the same surrogate, different ones different ones."""
    rnd = random.Random(6)
    digits = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))
    card = lambda b: b + str(next(d for d in range(10) if luhn(b + str(d))))
    make = {
        "ip": lambda: [".".join(str(rnd.randrange(256)) for _ in range(4))],
        "ssn": lambda: [f"{digits(3)}-{digits(2)}-{digits(4)}"],
        "card": lambda: (lambda c: [c, f"{c[:4]} {c[4:8]} {c[8:12]} {c[12:]}", f"{c[:4]}-{c[4:8]}-{c[8:12]}-{c[12:]}"])(card("4" + digits(14))),
        "phone": lambda: (lambda a, b, c: [f"{a}-{b}-{c}", f"{a}.{b}.{c}"])(digits(3), digits(3), digits(4)),
        "email": lambda: (lambda x: [x, x.upper()])("".join(rnd.choice("abcxyz") for _ in range(6)) + "@ab-c.org"),
        "iban": lambda: (lambda x: [x, " ".join(x[i : i + 4] for i in range(0, len(x), 4))])("DE" + digits(18)),
    }
    groups = {kind: list({g[0]: g for g in (f() for _ in range(200))}.values()) for kind, f in make.items()}
    out = iter(made(spark, [x for own in groups.values() for g in own for x in g]))
    for kind, own in groups.items():
        plain = lambda x, kind=kind: re.sub({"email": r"[^a-z0-9@.]", "ip": r"[^0-9.]"}.get(kind, r"[^a-z0-9]"), "", x.lower())
        form = lambda x, kind=kind: re.sub(r"\d+" if kind == "ip" else r"\d", "0", re.sub("[A-Z]", "A", re.sub("[a-z]", "a", x)))
        seen, before = {}, {plain(g[0]) for g in own}
        for g in own:
            new = [next(out) for _ in g]
            assert len({plain(x) for x in new}) == 1 and [form(x) for x in new] == [form(x) for x in g]
            assert seen.setdefault(plain(new[0]), g[0]) == g[0] and plain(new[0]) not in before
            assert kind != "card" or luhn(plain(new[0])) and plain(new[0])[0] == "4"


def test_clashing_columns_of_pii(spark):
    names = ["pieces", "made", "found", "tries", "kind", "base", "match", "_none", "_at", "number", "kinds"]
    d = spark.createDataFrame([(1, "call 555-123-4567", *[9] * len(names))], ["doc_id", "text", *names])
    row = surrogates.surrogates(spark, d, "k").first()
    assert row.n_entities == 1 and row.kinds == "phone" and re.fullmatch(r"call \d{3}-\d{3}-\d{4}", row.text)
    assert surrogates.surrogates(spark, d.limit(0), "k").count() == 0


def test_surrogates_are_distinct(spark):
    mails = [f"{a}{b}.{i:02d}@m.example.com" for a in "ab" for b in "cd" for i in range(100)]
    names = [f"Dr N{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    phones = [f"555-000-{i:04d}" for i in range(0, 2000, 5)]
    d = spark.createDataFrame(list(enumerate(mails + names + phones)), "doc_id long, text string")
    rows = surrogates.replace(d, "k", surrogates.attempts(spark, d, "k")).collect()
    assert len({r.text for r in rows}) == len(rows) and all(r.n_entities == 1 for r in rows)


def test_meeting_surrogates_get_another_attempt(spark, monkeypatch):
    monkeypatch.setattr(surrogates, "_SYLLABLES", ["ba", "be"])
    names = [f"Dr N{chr(97 + i)}x" for i in range(12)]
    d = spark.createDataFrame(list(enumerate(names)), "doc_id long, text string")
    tries = surrogates.attempts(spark, d, "k")
    assert tries
    assert len({r.text for r in surrogates.replace(d, "k", tries).collect()}) == 12
    with pytest.raises(ValueError):
        monkeypatch.setattr(surrogates, "MOST_EXCEPTIONS", 0)
        surrogates.attempts(spark, d, "k")


def test_any_number_of_exceptions(spark, monkeypatch):
    monkeypatch.setattr(surrogates, "_SYLLABLES", ["ba", "be"])
    monkeypatch.setattr(surrogates, "MOST_EXCEPTIONS", 3)
    names = [f"Dr N{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(150)]
    mails = [f"{a}@{b}.de" for a in "abcdefghij" for b in "klmnopqrst"] + ["中@文.cn"]
    d = spark.createDataFrame(list(enumerate(names + mails)) + [(998, names[7]), (999, f"{names[8]}, {mails[4]}")], "doc_id long, text string")
    found = surrogates.exceptions(spark, d, "k")
    assert found.count() > 3
    out = {r.doc_id: r.text for r in surrogates.replace(d, "k", found).collect()}
    assert len(out) == 253 and out[998] == out[7] and out[999] == f"{out[8]}, {out[154]}"
    whole = [out[i] for i in range(251)]
    assert len(set(whole)) == 251 and not set(whole) & set(names + mails)


def test_short_and_dense_phones(spark):
    rows = [f"+{i}" for i in range(100, 200)] + [f"+1 555 {i:03d}" for i in range(1000)] + [f"+1 555 00{i:02d}" for i in range(100)]
    d = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    out = [r.text for r in sorted(surrogates.replace(d, "k", surrogates.exceptions(spark, d, "k")).collect())]
    assert out[:100] == rows[:100] and len(set(out)) == len(rows)
    assert not set(out[1100:]) & set(rows)


def test_formats_that_are_full_stay_bijections(spark, monkeypatch):
    monkeypatch.setattr(surrogates, "_PHONE_DIGITS", 3)
    rows = [f"+{i}" for i in range(100, 200)]
    d = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    out = [r.text for r in surrogates.replace(d, "k", surrogates.exceptions(spark, d, "k")).collect()]
    assert sorted(out) == rows


def test_numpy_is_enough():
    assert np.array_equal(tiling._run_hashes(np.arange(9, dtype=np.uint64), 3)[:2], tiling._run_hashes(np.arange(5, dtype=np.uint64), 3)[:2])
