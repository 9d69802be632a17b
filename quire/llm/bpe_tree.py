"""Byte-level BPE by a monoid tree reduction (operator 5).

A piece (one match of the split pattern) is halved down to single bytes, and neighbours are joined: the tokens around the border are
decoded, merged anew as one window, and the window grows until its outer tokens are stable against the tokens that stay. Two
neighbouring tokens are stable when merging their bytes gives the same two tokens; a sequence all of whose neighbours are stable is the
encoding of its bytes, so the joined sequence is the one that merging the whole piece would give. What a window merges to is
remembered, and so are short halves, which many words share; both memories are bounded and emptied when full. Pieces are encoded
separately, so a text's ids are its pieces' ids in a row. Decoding concatenates up the same tree: runs of ids become bytes at once, and
halves are put one after the other. No tokenizer library takes part; letters and numbers are those of Unicode 16, as in the library.

Defined results: null counts as empty; an empty text has no ids and decodes to no bytes; a very long text is encoded in spans that end
where a piece ends, so only its bytes and ids are held whole; repeated rows, and rows of one id, each give a row; equal texts have
equal ids; extra columns are dropped, whatever their names; an empty table gives an empty table. An id that the vocabulary lacks raises
KeyError when decoding.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.chunks import PieceCache
from quire.llm.shared import tidy
from quire.llm.textcore import binary_rows

#: Bytes of a half that is remembered, at most, and halves, pairs and windows remembered at once.
_SHORT_PART, _MEMORY = 10, 100_000
#: Ids that a leaf of the decoding tree turns into bytes at once.
_LEAF_IDS = 1 << 16
_TASK_BYTES = 1 << 20
#: Letters and numbers that Unicode has since version 17. The library's classes are those of Unicode 16; the regex module's follow its release.
_LATER = {
    "L": (
        "558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7 "
        "10ED9-10EEE 11B0A 11DB0-11DDB 11DF1 16EA0-16EB8 16EBB-16ED3 16FF2-16FF3 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 "
        "18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 "
        "1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
    ),
    "N": "11DE0-11DE9 1246F 12475-1247F 12550-12686 16FF4-16FF6",
}


def _splitter(pattern: str):
    """The split pattern, compiled; its \\p{L} and \\p{N} have the letters and numbers of Unicode 16."""
    import regex

    for name, places in _LATER.items():
        later = "".join("-".join(f"\\U{x:0>8}" for x in r.split("-")) for r in places.split())
        pattern = pattern.replace(f"\\p{{{name}}}", f"[\\p{{{name}}}--[{later}]]")
    return regex.compile(pattern, regex.V1)


class TreeBpe:
    """Encoder and decoder of one vocabulary of ranks and one split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.split = ranks, _splitter(pattern)
        self.token = {v: k for k, v in ranks.items()}
        #: By the two tokens (their ids in one number): what their bytes merge to.
        self.pairs: dict[int, list[int]] = {}
        self.parts: dict[bytes, list[int]] = {}
        self.cache = PieceCache(self._pieces, bits=20)
        order = np.array(sorted(self.token), np.int64)
        size = np.zeros(int(order[-1]) + 1 if len(order) else 0, np.int64)
        size[order] = [len(self.token[i]) for i in order.tolist()]
        self.size, self.at = size, np.cumsum(size) - size
        self.flat = np.frombuffer(b"".join(self.token[i] for i in order.tolist()), np.uint8)

    def forget(self) -> None:
        """Gives up what is remembered."""
        self.cache.forget()
        self.pairs.clear()
        self.parts.clear()

    @classmethod
    def load(cls, path: str, pattern: str) -> TreeBpe:
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, pattern)

    def merged(self, piece: bytes) -> list[int]:
        """Ids of a window by merging it as a whole: the lowest-ranked neighbours first, the leftmost of equals."""
        if len(piece) > 48:
            return self._merged_long(piece)
        get, tokens = self.ranks.get, [piece[i : i + 1] for i in range(len(piece))]
        ranks = [get(piece[i : i + 2]) for i in range(len(piece) - 1)]
        while True:
            best, at = None, -1
            for i, r in enumerate(ranks):
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                return [self.ranks[t] for t in tokens]
            tokens[at : at + 2] = [tokens[at] + tokens[at + 1]]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = get(tokens[at] + tokens[at + 1])
            if at:
                ranks[at - 1] = get(tokens[at - 1] + tokens[at])

    def _merged_long(self, piece: bytes) -> list[int]:
        """The same with a heap."""
        get, n = self.ranks.get, len(piece)
        end, prev, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, j, k = heapq.heappop(heap)
            if not (alive[i] and j < n and alive[j] and end[i] == j and end[j] == k):
                continue
            alive[j], end[i] = False, k
            if k < n:
                prev[k] = i
                if (r := get(piece[i : end[k]])) is not None:
                    heapq.heappush(heap, (r, i, k, end[k]))
            if (p := prev[i]) >= 0 and (r := get(piece[p:k])) is not None:
                heapq.heappush(heap, (r, p, i, k))
        return [self.ranks[piece[i : end[i]]] for i in range(n) if alive[i]]

    def pair(self, a: int, b: int) -> list[int]:
        """What the bytes of two tokens merge to: the tokens themselves if they are stable as neighbours."""
        if (known := self.pairs.get(a << 32 | b)) is None:
            if len(self.pairs) >= _MEMORY:
                self.pairs.clear()
            known = self.pairs[a << 32 | b] = self.merged(self.token[a] + self.token[b])
        return known

    def stable(self, a: int, b: int) -> bool:
        # Tokens that merge to two others have another border, so a first token tells.
        found = self.pair(a, b)
        return len(found) == 2 and found[0] == a

    def join(self, a: list[int], b: list[int]) -> list[int]:
        """Ids of two neighbouring parts from the ids of each."""
        if not a or not b:
            return a + b
        window = self.pair(a[-1], b[0])
        if len(window) == 2 and window[0] == a[-1]:
            return a + b
        k = 1
        while True:
            left, right = a[: max(0, len(a) - k)], b[k:]
            if (not left or self.stable(left[-1], window[0])) and (not right or self.stable(window[-1], right[0])):
                return left + window + right
            k *= 2
            window = self.merged(b"".join(map(self.token.__getitem__, a[-k:] + b[:k])))

    def tree(self, part: bytes) -> list[int]:
        if (known := self.parts.get(part)) is not None:
            return known
        if len(part) < 2:
            return [self.ranks[part]] if part else []
        half = len(part) // 2
        found = self.join(self.tree(part[:half]), self.tree(part[half:]))
        if len(part) <= _SHORT_PART:
            if len(self.parts) >= _MEMORY:
                self.parts.clear()
            self.parts[part] = found
        return found

    def _pieces(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        out: list[int] = []
        counts = np.empty(len(chunks), np.int64)
        for i, x in enumerate(chunks):
            before = len(out)
            for match in self.split.findall(x.decode()):
                out += self.tree(match.encode())
            counts[i] = len(out) - before
        return np.array(out, np.uint32), counts

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        out = []
        for _, _, ids, count in self.cache.encode_column(pa.array(texts, pa.string())):
            raw, ends = ids.astype("<u4", copy=False).tobytes(), (4 * np.r_[0, np.cumsum(count)]).tolist()
            out += [raw[a:b] for a, b in zip(ends, ends[1:], strict=False)]
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of ids: halves one after the other, down to runs that become bytes at once."""
        ids = np.asarray(ids, np.int64)
        if len(ids) > _LEAF_IDS:
            half = len(ids) // 2
            return self.decode(ids[:half]) + self.decode(ids[half:])
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.size) or not self.size[ids].all()):
            raise KeyError("an id that the vocabulary lacks")
        size = self.size[ids]
        return self.flat[np.repeat(self.at[ids] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))].tobytes()

    def decode_rows(self, ids: np.ndarray, counts: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of rows of ids, in a row, and each row's number of bytes."""
        raw = self.decode(ids)
        ends = np.r_[0, np.cumsum(self.size[np.asarray(ids, np.int64)])]
        return raw, np.diff(ends[np.r_[0, np.cumsum(counts)]])


_loaded: dict[tuple[str, str], TreeBpe] = {}


def _bpe(path: str, pattern: str) -> TreeBpe:
    """One coder for a worker process, kept between its tasks."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = TreeBpe.load(path, pattern)
    return _loaded[path, pattern]


def encode(docs: DataFrame, vocabulary: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of each row; vocabulary is the path of a rank file that every executor has."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(vocabulary, pattern)
        for batch in batches:
            for lo, hi, ids, count in bpe.cache.encode_column(batch.column(1), _TASK_BYTES):
                values = pa.Array.from_buffers(pa.int32(), len(ids), [None, pa.py_buffer(ids)])
                ends = pa.array(np.r_[0, np.cumsum(count)].astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(ends, values)], ["doc_id", "ids"])
        bpe.forget()

    return rows.mapInArrow(tidy(run), f"doc_id {docs.schema[doc_id].dataType.simpleString()}, ids array<int>")


def decode(coded: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """(doc_id, ids, decoded binary) of the rows of encode(); null ids count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(vocabulary, pattern)
        for batch in batches:
            for lo in range(0, len(batch), 512):
                part = batch.slice(lo, 512)
                ids = part.column(1)
                ends, there = ids.offsets.to_numpy().astype(np.int64), ids.is_valid().to_numpy(zero_copy_only=False)
                values = ids.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
                if not there.all():
                    values = values[np.repeat(there, np.diff(ends))]
                raw, sizes = bpe.decode_rows(values, np.where(there, np.diff(ends), 0))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), binary_rows(np.frombuffer(raw, np.uint8), sizes)], ["doc_id", "ids", "decoded"])

    return coded.select("doc_id", "ids").mapInArrow(tidy(run), f"doc_id {coded.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded binary")
