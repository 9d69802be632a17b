"""Secret scans by one combined deterministic automaton (operator 4).

All rules' regexes are parsed to one automaton without a fixed start, made deterministic by subset construction over byte classes,
minimised by partition refinement and laid out as transition arrays. A text's bytes pass it once; where a rule stops accepting, a
match ends, and the rule's reversed automaton finds its leftmost start not before the rule's last match.

A rule must keep accepting from its first acceptance to its match's end; compiling checks that. Matches are leftmost, longest and
non-overlapping for each rule. Defined results: null and empty texts have no spans; very long texts pass whole; spans that begin
together are ordered as the rules are listed; an empty table gives an empty table; repeated rows each give a row; scan() drops extra
columns and redact() keeps them, whatever their names; positions are code points, ends exclusive.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.shared import tidy
from quire.llm.textcore import slices, utf8


@dataclass(frozen=True)
class Rule:
    """least: bytes of a match at least. value_least: bytes of what follows the first : or =, spaces and a quote."""

    kind: str
    pattern: str
    either_case: bool = False
    least: int = 0
    value_least: int = 0


#: The base kinds in their order, then further well-known credential formats.
RULES = (
    Rule("assign", r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=\-]+", either_case=True, value_least=12),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]{8,}", least=16),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9\-]+", least=15),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("google", r"AIza[A-Za-z0-9_\-]+", least=39),
)
BASE = ("assign", "access", "hex")


class _Parser:
    """Regex to a Thompson automaton over bytes: literals, classes, groups, |, ?, *, +, {n}, {n,}, \\xNN."""

    def __init__(self, rule: Rule, reverse: bool = False):
        self.text, self.at, self.fold, self.reverse = rule.pattern, 0, rule.either_case, reverse
        self.edges: list[list[tuple[frozenset[int] | None, int]]] = []
        self.start, self.end = self._either()
        if self.at != len(self.text):
            raise ValueError(f"cannot parse {self.text!r} at {self.at}")

    def _new(self) -> int:
        self.edges.append([])
        return len(self.edges) - 1

    def _link(self, a: int, b: int, on: frozenset[int] | None = None) -> None:
        self.edges[a].append((on, b))

    def _peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def _either(self) -> tuple[int, int]:
        a, b = self._new(), self._new()
        while True:
            s, e = self._row()
            self._link(a, s)
            self._link(e, b)
            if self._peek() != "|":
                return a, b
            self.at += 1

    def _row(self) -> tuple[int, int]:
        parts = []
        while self._peek() not in ("", "|", ")"):
            parts.append(self._repeated())
        if self.reverse:
            parts.reverse()
        if not parts:
            s = self._new()
            return s, s
        for (_, e), (s, _) in zip(parts, parts[1:], strict=False):
            self._link(e, s)
        return parts[0][0], parts[-1][1]

    def _repeated(self) -> tuple[int, int]:
        began = self.at
        s, e = self._atom()
        until = self.at
        low, high = {"?": (0, 1), "*": (0, None), "+": (1, None)}.get(self._peek(), (1, 1))
        if self._peek() in ("?", "*", "+"):
            self.at += 1
        elif self._peek() == "{":
            stop = self.text.index("}", self.at)
            a, comma, b = self.text[self.at + 1 : stop].partition(",")
            low, high = int(a), (int(b) if b else None) if comma else int(a)
            self.at = stop + 1
        else:
            return s, e
        after, copies = self.at, [(s, e)]
        for _ in range(max(low, high or 0, 1) - 1):
            self.at = began
            copies.append(self._atom())
            assert self.at == until
        self.at = after
        first, last = self._new(), self._new()
        self._link(first, copies[0][0])
        for i, (cs, ce) in enumerate(copies):
            if i + 1 < len(copies):
                self._link(ce, copies[i + 1][0])
            if i + 1 >= low:
                self._link(ce, last)
            if i + 1 == len(copies) and high is None:
                self._link(ce, cs)
        if low == 0:
            self._link(first, last)
        return first, last

    def _atom(self) -> tuple[int, int]:
        c = self._peek()
        if c == "(":
            self.at += 1
            out = self._either()
            if self._peek() != ")":
                raise ValueError("unclosed group")
            self.at += 1
            return out
        on = self._class() if c == "[" else frozenset({self._byte()})
        if self.fold:
            on = on | {ord(chr(x).swapcase()) for x in on if chr(x).isascii() and chr(x).isalpha()}
        s, e = self._new(), self._new()
        self._link(s, e, frozenset(on))
        return s, e

    def _byte(self) -> int:
        c = self._peek()
        self.at += 1
        if c != "\\":
            return ord(c)
        c = self._peek()
        self.at += 1
        if c == "x":
            self.at += 2
            return int(self.text[self.at - 2 : self.at], 16)
        return ord(c)

    def _class(self) -> frozenset[int]:
        self.at += 1
        on: set[int] = set()
        while self._peek() != "]":
            a = b = self._byte()
            if self._peek() == "-" and self.text[self.at + 1] != "]":
                self.at += 1
                b = self._byte()
            on.update(range(a, b + 1))
        self.at += 1
        return frozenset(on)


@dataclass
class Automaton:
    """table[state, byte] is the next state; masks[state] has bit k where rule k accepts; state 0 is the start."""

    table: np.ndarray
    masks: list[int]
    subsets: int = 0
    _rows: list = field(default_factory=list, repr=False)

    def rows(self) -> list:
        """The table as lists that hold each other: row[byte] is the next row, row[256] its mask, row[257] if it is dead."""
        if not self._rows:
            rows: list = [[None] * 258 for _ in self.masks]
            for i, row in enumerate(rows):
                row[:256] = [rows[j] for j in self.table[i]]
                row[256], row[257] = self.masks[i], bool((self.table[i] == i).all()) and not self.masks[i]
            self._rows = rows
        return self._rows

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_rows": []}


def compile_rules(rules: list[Rule], anchored: bool = False, reverse: bool = False) -> Automaton:
    """Subset construction over byte classes, then minimisation."""
    edges: list[list[tuple[frozenset[int] | None, int]]] = []
    starts, accepts = [], {}
    for k, rule in enumerate(rules):
        p, base = _Parser(rule, reverse), len(edges)
        edges += [[(on, to + base) for on, to in x] for x in p.edges]
        starts.append(p.start + base)
        accepts[p.end + base] = k
    sets = {on for x in edges for on, _ in x if on is not None}
    signature: dict[tuple[bool, ...], int] = {}
    ordered = sorted(sets, key=sorted)
    class_of = np.array([signature.setdefault(tuple(b in s for s in ordered), len(signature)) for b in range(256)])
    sample = [int(np.flatnonzero(class_of == c)[0]) for c in range(len(signature))]

    def closed(states: set[int]) -> frozenset[int]:
        todo, out = list(states), set(states)
        while todo:
            for on, to in edges[todo.pop()]:
                if on is None and to not in out:
                    out.add(to)
                    todo.append(to)
        return frozenset(x for x in out if x in accepts or any(on is not None for on, _ in edges[x]))

    first = closed(set(starts))
    number, order, table = {first: 0}, [first], []
    for cur in order:
        row = []
        for b in sample:
            moved = {to for x in cur for on, to in edges[x] if on is not None and b in on}
            to = closed(moved) | (frozenset() if anchored else first)
            if to not in number:
                number[to] = len(order)
                order.append(to)
            row.append(number[to])
        table.append(row)
    step, masks = np.array(table), [sum({1 << accepts[x] for x in s if x in accepts}) for s in order]
    block = np.unique(masks, return_inverse=True)[1]
    while True:
        _, new = np.unique(np.column_stack([block, block[step]]), axis=0, return_inverse=True)
        if new.max() == block.max():
            break
        block = new
    head = np.array([int(np.flatnonzero(block == c)[0]) for c in range(block.max() + 1)])
    head = np.r_[0, head[head != head[block[0]]]] if head[block[0]] == 0 else head
    rank = np.empty(block.max() + 1, int)
    rank[block[head]] = np.arange(len(head))
    small = rank[block[step[head]]]
    return Automaton(small[:, class_of].astype(np.uint16), [masks[h] for h in head], len(order))


class Scanner:
    """All rules' combined automaton and the reversed automaton of each."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        for rule in rules:
            a = compile_rules([rule], anchored=True)
            dead = [i for i in range(len(a.masks)) if (a.table[i] == i).all() and not a.masks[i]]
            for i, mask in enumerate(a.masks):
                if mask and any(not a.masks[j] and j not in dead for j in set(a.table[i].tolist())):
                    raise ValueError(f"{rule.kind}: a match may not stop and start accepting")
            if a.masks[0]:
                raise ValueError(f"{rule.kind}: matches nothing")
        self.forward = compile_rules(list(rules))
        self.backward = [compile_rules([r], anchored=True, reverse=True) for r in rules]

    def ends(self, data: bytes) -> list[tuple[int, int]]:
        """(position, mask of the rules whose match ends there), in one pass."""
        out, n, row = [], len(data), self.forward.rows()[0]
        it = iter(data)
        left = it.__length_hint__
        for b in it:
            row = row[b]
            if row[256]:
                mask = row[256]
                for c in it:
                    row = row[c]
                    if row[256] != mask:
                        if gone := mask & ~row[256]:
                            out.append((n - left() - 1, gone))
                        mask = row[256]
                        if not mask:
                            break
                else:
                    out.append((n, mask))
        return out

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end) in bytes, ordered."""
        out, last = [], [0] * len(self.rules)
        for end, mask in self.ends(data):
            for k, rule in enumerate(self.rules):
                if not mask >> k & 1:
                    continue
                row, start, i = self.backward[k].rows()[0], -1, end
                while i > last[k]:
                    i -= 1
                    row = row[data[i]]
                    if row[256]:
                        start = i
                    elif row[257]:
                        break
                if start < 0:
                    continue
                last[k] = end
                if end - start >= rule.least and (not rule.value_least or len(_value(data[start:end])) >= rule.value_least):
                    out.append((start, k, end))
        return sorted(out)


def _value(match: bytes) -> bytes:
    """What is assigned: after the first : or =, spaces and one quote."""
    at = min(i for i in (match.find(b":"), match.find(b"=")) if i >= 0)
    rest = match[at + 1 :].lstrip(b" ")
    return rest[1:] if rest[:1] in (b'"', b"'") else rest


SPANS = "array<struct<start:bigint,kind:string,end:bigint>>"
_SPAN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))


def _column_spans(scanner: Scanner, column: pa.Array) -> list[list[dict]]:
    data, bounds = utf8(column)
    out = []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        raw = data[lo:hi].tobytes()
        found = scanner.spans(raw)
        if found and not raw.isascii():
            place = np.r_[0, np.cumsum((data[lo:hi] & 0xC0) != 0x80)]
            found = [(int(place[s]), k, int(place[e])) for s, k, e in found]
        out.append([{"start": s, "kind": scanner.rules[k].kind, "end": e} for s, k, e in found])
    return out


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, spans) of each row: spans by start, then rule as listed. Only the two columns are read."""
    scanner = Scanner(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(utf8(batch.column(1))[1], 4 << 20):
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(_column_spans(scanner, part.column(1)), type=_SPAN_TYPE)], ["doc_id", "spans"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(tidy(run), f"doc_id {docs.schema[doc_id].dataType.simpleString()}, spans {SPANS}")


def redact(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs with each secret in text replaced by [REDACTED:kind]; overlapping spans are replaced together, under the first's kind."""
    scanner, at, schema = Scanner(rules), docs.columns.index(text), docs.schema

    def clean(value: str | None, spans: list[dict]) -> str | None:
        out, done = [], 0
        for i, s in enumerate(spans):
            if s["end"] <= done:
                continue
            if s["start"] >= done or i == 0:
                out += [value[done : s["start"]], f"[REDACTED:{s['kind']}]"]
            done = s["end"]
        return value if not spans else "".join(out) + value[done:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(utf8(batch.column(at))[1], 4 << 20):
                part = batch.slice(lo, hi - lo)
                column = part.column(at)
                new = pa.array(list(map(clean, column.to_pylist(), _column_spans(scanner, column))), type=column.type)
                yield pa.RecordBatch.from_arrays([new if i == at else part.column(i) for i in range(part.num_columns)], schema=batch.schema)

    return docs.mapInArrow(tidy(run), schema)
