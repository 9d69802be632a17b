"""Piece-wise encoding: UTF-8 texts are cut where a byte-level BPE's own pre-tokeniser always cuts, and each distinct short piece is
encoded once for as long as it is remembered.

The split pattern has matches of one kind of character only (letters, digits, other marks, white space), each but the last of which
may begin with one space. So a text may be cut wherever the kind changes, before the last character of a run of white space that a
visible character follows, and after it unless it is a space. Kinds are read from bytes: ASCII, the letters of the Latin and Cyrillic
blocks that are letters throughout, and first bytes that no white space has. Nothing is cut next to any other byte, nor between an
apostrophe and a letter, which may be a contraction. The ids of the pieces in a row are the ids of the text.

Pieces of at most 15 bytes are their own keys (two 64-bit numbers, the length among them) in a hash table of arrays; longer ones are
encoded anew in each slice and never remembered. So what is remembered is bounded in bytes, whatever the texts are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from quire.llm.textcore import slices, utf8

_OTHER, _LETTER, _DIGIT, _MARK, _QUOTE, _SPACE, _LINE, _LEAD = range(8)


def _kinds() -> np.ndarray:
    kinds = np.full(256, _OTHER, np.uint8)
    for b in range(0x21, 0x7F):
        kinds[b] = _LETTER if chr(b).isalpha() else _DIGIT if chr(b).isdigit() else _MARK
    kinds[ord("'")] = _QUOTE
    kinds[ord(" ")] = _SPACE
    kinds[[9, 10, 11, 12, 13]] = _LINE
    # White space beyond ASCII begins with C2, E1, E2 or E3.
    kinds[0xC3:0xE0] = kinds[0xE4:0xF5] = _LEAD
    return kinds


def _pairs() -> np.ndarray:
    """Whether a text is cut between two bytes, by eight times the kind of the first and that of the second."""
    cut = np.zeros((8, 8), bool)
    seen = (_LETTER, _DIGIT, _MARK, _QUOTE)
    for a in seen:
        for b in seen:
            cut[a, b] = a != b and (a, b) not in ((_QUOTE, _LETTER), (_QUOTE, _MARK), (_MARK, _QUOTE))
        cut[a, [_SPACE, _LINE]] = cut[_LINE, a] = True
    cut[_LINE, _LEAD] = True
    return cut.ravel()


_KIND, _PAIR = _kinds(), _pairs()
_VISIBLE = np.isin(np.arange(8), (_LETTER, _DIGIT, _MARK, _QUOTE, _LEAD))
#: First bytes of two-byte letters: all of U+00C0 to U+017F but two signs, and of U+0400 to U+047F.
_TWO = np.isin(np.arange(256), (0xC3, 0xC4, 0xC5, 0xD0, 0xD1))
_FOLLOWS = np.array([(1 << 8 * i) - 1 for i in range(8)] + [2**64 - 1], np.uint64)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

#: Bytes of a piece that is remembered, at most.
SHORT = 15


def cuts(data: np.ndarray, heads: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each byte whether a piece begins there. heads and ends: where texts that aren't empty begin and end."""
    kind = _KIND[data]
    two = np.flatnonzero(_TWO[data[:-1]])
    if len(two):
        two = two[(data[two] != 0xC3) | ((data[two + 1] != 0x97) & (data[two + 1] != 0xB7))]
        kind[two] = kind[two + 1] = _LETTER
    cut = np.empty(len(data), bool)
    cut[1:] = _PAIR[kind[:-1] * np.uint8(8) + kind[1:]]
    before = _VISIBLE[kind[1:]]
    before[ends[:-1] - 1] = False
    cut[:-1] |= before & ((kind[:-1] == _SPACE) | (kind[:-1] == _LINE))
    cut[heads] = True
    return cut


def spans(data: np.ndarray, lo: int, hi: int, most: int) -> Iterator[tuple[int, int]]:
    """The text data[lo:hi] in spans of about most bytes that end where a piece ends.

    None ends after white space that a visible character follows: without that character the white space would be one match, not two.
    """
    while hi - lo > 2 * most:
        reach = 1 << 12
        while True:
            at = max(lo, lo + most - reach)
            near = data[at : lo + most + 1]
            kind = _KIND[near]
            blank = (kind == _SPACE) | (kind == _LINE)
            found = np.flatnonzero(cuts(near, np.zeros(0, np.int64), np.array([len(near)]))[1:] & (blank[1:] | ~blank[:-1]))
            if len(found) or at == lo:
                break
            reach *= 8
        if not len(found):
            most *= 2
            continue
        nxt = at + 1 + int(found[-1])
        yield lo, nxt
        lo = nxt
    yield lo, hi


class PieceCache:
    """Encodes texts to ids. encode_all turns distinct pieces into their ids in a row and their numbers of ids.

    bits: the table has up to 2**bits places; when 0.6 of them are taken it is emptied, which costs time only.
    """

    def __init__(self, encode_all: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], bits: int = 21):
        self.encode_all, self.most = encode_all, bits
        self.forget()

    def forget(self) -> None:
        """Empties the memory and gives it up."""
        self.taken, self.used, self.ids = 0, 0, np.zeros(1 << 12, np.uint32)
        self._table(min(12, self.most))

    def _table(self, bits: int) -> None:
        self.bits, self.places = bits, 1 << bits
        # The second key has the length in its highest byte, so 0 is an empty place.
        self.key0, self.key1 = np.zeros(self.places, np.uint64), np.zeros(self.places, np.uint64)
        self.first, self.count, self.owner = np.zeros(self.places, np.int32), np.zeros(self.places, np.int32), np.zeros(self.places, np.int32)

    def _for(self, n: int) -> bool:
        """Makes room for n more pieces; False if that emptied the memory."""
        if self.taken + n <= 0.6 * self.places:
            return True
        bits, known = self.bits, self.taken + n <= 0.6 * (1 << self.most)
        want = self.taken + n if known else n
        while want > 0.6 * (1 << bits) and bits < self.most:
            bits += 1
        if known:
            at = np.flatnonzero(self.key1)
            old = self.key0[at], self.key1[at], self.first[at], self.count[at]
            self._table(bits)
            self.taken = 0
            self._put(*old)
            return True
        while n > 0.6 * (1 << bits):  # one slice has more than the memory may hold: for it alone
            bits += 1
        self.taken, self.used, self.ids = 0, 0, np.zeros(1 << 16, np.uint32)
        self._table(bits)
        return False

    def _room(self, n: int) -> None:
        if self.used + n > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(self.used + 2 * n, np.uint32)])

    def _place(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        h = (a * _A) ^ (b * _B)
        h ^= h >> np.uint64(29)
        return ((h * _A) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The place of each key; -1 where it is not known."""
        place = self._place(a, b)
        there = self.key1[place]
        hit = (there == b) & (self.key0[place] == a)
        out = np.where(hit, place, -1)
        todo = np.flatnonzero(~hit & (there != 0))
        place = place[todo]
        while len(todo):
            place = (place + 1) & (self.places - 1)
            there = self.key1[place]
            hit = (there == b[todo]) & (self.key0[place] == a[todo])
            out[todo[hit]] = place[hit]
            more = ~hit & (there != 0)
            todo, place = todo[more], place[more]
        return out

    def _put(self, a: np.ndarray, b: np.ndarray, first: np.ndarray, count: np.ndarray) -> None:
        """Adds distinct keys that are not known."""
        place, todo = self._place(a, b), np.arange(len(a))
        while len(todo):
            free = self.key1[place] == 0
            mine, at = todo[free], place[free]
            self.owner[at] = mine
            won = self.owner[at] == mine
            mine, at = mine[won], at[won]
            self.key0[at], self.key1[at], self.first[at], self.count[at] = a[mine], b[mine], first[mine], count[mine]
            free[free] = won
            todo, place = todo[~free], (place[~free] + 1) & (self.places - 1)
        self.taken += len(a)

    def _encoded(self, raw: memoryview, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first, count) of pieces."""
        ids, count = self.encode_all([bytes(raw[s:e]) for s, e in zip(starts.tolist(), (starts + sizes).tolist(), strict=True)])
        return ids, np.cumsum(count) - count, count

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts data[bounds[i]:bounds[i + 1]] in a row, and each text's number of ids."""
        lo, n = int(bounds[0]), len(bounds) - 1
        size = int(bounds[-1]) - lo
        if not size:
            return np.zeros(0, np.uint32), np.zeros(n, np.int64)
        padded = np.zeros(size + 24, np.uint8)
        padded[:size] = data[lo : lo + size]
        data, bounds = padded[:size], bounds - lo
        full = bounds[1:] > bounds[:-1]
        starts = np.flatnonzero(cuts(data, bounds[:-1][full], bounds[1:][full]))
        sizes = np.diff(np.r_[starts, size])
        raw = memoryview(padded)
        short = sizes <= SHORT
        own, own_sizes = (starts, sizes) if short.all() else (starts[short], sizes[short])
        words = np.ndarray((size + 17,), "<u8", padded, 0, (1,))
        a = words[own] & _FOLLOWS[np.minimum(own_sizes, 8)]
        b = (words[own + 8] & _FOLLOWS[np.clip(own_sizes - 8, 0, 7)]) | (own_sizes.astype(np.uint64) << np.uint64(56))
        place = self._find(a, b)
        new = np.flatnonzero(place < 0)
        if len(new):
            _, one, of = np.unique((a[new] * _A) ^ (b[new] * _B), return_index=True, return_inverse=True)
            if (a[new][one][of] != a[new]).any() or (b[new][one][of] != b[new]).any():
                _, one = np.unique(np.column_stack([a[new], b[new]]), axis=0, return_index=True)
            bits = self.bits
            if not self._for(len(one)):
                return self.encode(data, bounds)
            if self.bits != bits:  # a larger table has other places
                place = self._find(a, b)
            one = new[one]
            ids, first, count = self._encoded(raw, own[one], own_sizes[one])
            self._room(len(ids))
            self.ids[self.used : self.used + len(ids)] = ids
            self._put(a[one], b[one], (first + self.used).astype(np.int32), count.astype(np.int32))
            self.used += len(ids)
            place[new] = self._find(a[new], b[new])
        first, count = self.first[place], self.count[place]
        if len(own) < len(starts):
            rest = ~short
            pieces: dict[bytes, int] = {}
            number = np.array([pieces.setdefault(bytes(raw[s:e]), len(pieces)) for s, e in zip(starts[rest].tolist(), (starts + sizes)[rest].tolist(), strict=True)])
            ids, counts = self.encode_all(list(pieces))
            # They stand behind what is remembered, for this call only.
            self._room(len(ids))
            self.ids[self.used : self.used + len(ids)] = ids
            all_first, all_count = np.empty(len(starts), np.int64), np.empty(len(starts), np.int64)
            all_first[short], all_count[short] = first, count
            all_first[rest], all_count[rest] = (np.cumsum(counts) - counts + self.used)[number], counts[number]
            first, count = all_first, all_count
        ends = np.cumsum(count, dtype=np.int64)
        at = np.repeat(first - (ends - count), count)
        at += np.arange(len(at))
        upto = np.r_[0, ends][np.searchsorted(starts, bounds)]
        return self.ids[at], np.diff(upto)

    def encode_column(self, column: pa.Array, most: int = 4 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(lo, hi, ids, counts) of slices of a string column's rows; a row of more than most bytes is encoded in spans."""
        data, bounds = utf8(column)
        for lo, hi in slices(bounds, most):
            if hi - lo == 1 and bounds[hi] - bounds[lo] > 2 * most:
                parts = [self.encode(data, np.array(s))[0] for s in spans(data, int(bounds[lo]), int(bounds[hi]), most)]
                ids = np.concatenate(parts)
                yield lo, hi, ids, np.array([len(ids)])
            else:
                yield lo, hi, *self.encode(data, bounds[lo : hi + 1])
