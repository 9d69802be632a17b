import random
import re

import pytest

from quire.llm import secrets_dfa as S

RULES = {
    "assign": re.compile(r"""(?ia)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}
LEAST = {"assign": 12, "access": 18, "hex": 16}
PARTS = ["token", "Token=", "secret", " ", "=", ":", '"', "'", "AKIA", "ABCDEFGHIJKLMNOP0123", "0123456789abcdef", "deadbeef", "api_key", "apikey", "x.token:", "é", "\n", ".", "-", "abcdefghijklmnop", "PASSWORD= ", "ſecret=abcdefghijklmnopq"]


def brute(text):
    found = []
    for i, (kind, rx) in enumerate(RULES.items()):
        for m in rx.finditer(text):
            if len(m.group(2) if kind == "assign" else m.group()) >= LEAST[kind]:
                found.append((m.start(), i, m.end(), kind))
    return [(s, k, e) for s, _, e, k in sorted(found)]


@pytest.fixture(scope="module")
def scanner():
    return S.Scanner()


def test_base_spans_equal_brute_force(scanner):
    rnd = random.Random(3)
    for _ in range(8000):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 14)))
        raw = text.encode()
        place = lambda i, raw=raw: len(raw[:i].decode())
        assert [(place(s), scanner.rules[k].kind, place(e)) for s, k, e in scanner.spans(raw) if k < 3] == brute(text), text


def test_minimised_automaton_is_smaller_and_equal():
    rules = [S.Rule("a", r"ab+c{2,3}"), S.Rule("b", r"(x|y)z?[0-9]")]
    a = S.compile_rules(rules, anchored=True)
    assert len(a.masks) < a.subsets + 1
    for text, masks in (("abbcc", 1), ("abccc", 1), ("abc", 0), ("xz7", 2), ("y1", 2), ("zz", 0)):
        row = a.rows()[0]
        for c in text.encode():
            row = row[c]
        assert row[256] == masks


def test_rules_that_stop_accepting_are_refused():
    with pytest.raises(ValueError):
        S.Scanner((S.Rule("bad", r"ab(cd)?"),))


def test_further_kinds(scanner):
    text = "key ghp_" + "z9" * 20 + " and -----BEGIN RSA PRIVATE KEY----- and AIza" + "y" * 36
    assert [scanner.rules[k].kind for _, k, _ in scanner.spans(text.encode())] == ["github", "pem", "google"]


def test_scan_and_redact(spark, docs):
    extra = spark.createDataFrame([(90, 'é token = "abcdefghijklmnop" tail 0123456789abcdef0', None, None, None, None)], docs.schema)
    rows = {r.doc_id: r for r in S.scan(docs.unionAll(extra)).collect()}
    assert rows[0].spans == [] and rows[1].spans == []
    assert [(s.kind, s.start, s.end) for s in rows[90].spans] == [("assign", 2, 27), ("hex", 34, 51)]
    out = S.redact(docs.unionAll(extra))
    assert out.columns == docs.columns
    assert out.where("doc_id = 90").first().text == 'é [REDACTED:assign]" tail [REDACTED:hex]'
    assert out.where("doc_id = 0").first().text is None
    assert S.scan(docs.limit(0)).count() == 0 and S.redact(docs.limit(0)).count() == 0
