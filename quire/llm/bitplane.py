"""Token-ID output with bit-plane shuffling (operator 1).

A file holds the ids of whole documents, cut into blocks of a fixed number of ids. Each block is transposed into its four byte
planes or 32 bit planes, every plane is compressed with zstandard by itself (a plane of zeros takes no bytes), and the footer has
the chunk index (each chunk's place, ids and plane lengths) and the documents with their lengths. Any block can be read alone.

    file    = "QBP1", chunk..., footer, u32 footer length, "QBP1"
    footer  = zstandard(JSON: planes, block, chunks [[offset, ids, plane lengths]], docs [doc_id], lengths [ids])

Files are written to the shared folder under a temporary name and renamed, and a manifest table lists those that count. Documents
are in ascending id order over all files; the first ids are null ones. Null and empty texts have only the end id. Very long texts are
encoded in spans that end where a piece ends and may fill a file by themselves. Repeated ids each have a row, ordered by text, and equal
texts equal ids. Extra columns are dropped, whatever their names. An empty table gives no files and no rows.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.chunks import PieceCache
from quire.llm.shared import put_file, shared_dir, stored, tidy
from quire.llm.textcore import binary_rows, slices, utf8

MAGIC = b"QBP1"
BLOCK = 65_536
#: Ids of a file at least before the next one begins.
FILE_IDS = 4_000_000


def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The byte or bit planes of 32-bit ids, least significant first."""
    columns = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4).T
    if not bits:
        return [np.ascontiguousarray(c).tobytes() for c in columns]
    return [np.packbits((c >> b) & 1).tobytes() for c in columns for b in range(8)]


def from_planes(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    out = np.zeros((n, 4), np.uint8)
    for i, plane in enumerate(planes):
        if not plane:
            continue
        if bits:
            out[:, i // 8] |= np.unpackbits(np.frombuffer(plane, np.uint8), count=n) << (i % 8)
        else:
            out[:, i] = np.frombuffer(plane, np.uint8)
    return out.reshape(-1).view("<u4")


class FileWriter:
    """Collects documents' ids and makes one file of them."""

    def __init__(self, block: int = BLOCK, bits: bool = False, level: int = 1):
        import zstandard

        self.block, self.bits, self.zip = block, bits, zstandard.ZstdCompressor(level=level)
        self.clear()

    def clear(self) -> None:
        self.body, self.size, self.chunks, self.docs, self.lengths, self.rest, self.held, self.ids = [MAGIC], 4, [], [], [], [], 0, 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append(doc_id)
        self.lengths.append(len(ids) // 4)
        self.rest.append(ids)
        self.held += len(ids) // 4
        self.ids += len(ids) // 4
        if self.held >= self.block:
            all_ids = np.frombuffer(b"".join(self.rest), "<u4")
            full = len(all_ids) // self.block * self.block
            for at in range(0, full, self.block):
                self._chunk(all_ids[at : at + self.block])
            self.rest, self.held = [all_ids[full:].tobytes()], len(all_ids) - full

    def _chunk(self, ids: np.ndarray) -> None:
        planes = [self.zip.compress(p) if p.strip(b"\0") else b"" for p in to_planes(ids, self.bits)]
        self.chunks.append((self.size, len(ids), [len(p) for p in planes]))
        self.body += planes
        self.size += sum(map(len, planes))

    def file(self) -> bytes:
        if self.held:
            self._chunk(np.frombuffer(b"".join(self.rest), "<u4"))
        footer = {"planes": "bit" if self.bits else "byte", "block": self.block, "chunks": self.chunks, "docs": self.docs, "lengths": self.lengths}
        footer = self.zip.compress(json.dumps(footer, separators=(",", ":")).encode())
        out = b"".join([*self.body, footer, struct.pack("<I", len(footer)), MAGIC])
        self.clear()
        return out


def footer_of(data: bytes) -> dict:
    """A file's footer; ValueError if it isn't a whole file."""
    import zstandard

    if len(data) < 12 or data[:4] != MAGIC or data[-4:] != MAGIC:
        raise ValueError("not a whole token file")
    size = struct.unpack("<I", data[-8:-4])[0]
    return json.loads(zstandard.ZstdDecompressor().decompress(data[-8 - size : -8]))


def read_chunk(data: bytes, footer: dict, number: int) -> np.ndarray:
    """The ids of one chunk, by the chunk index."""
    import zstandard

    unzip = zstandard.ZstdDecompressor()
    at, n, lengths = footer["chunks"][number]
    planes = []
    for size in lengths:
        planes.append(unzip.decompress(data[at : at + size]) if size else b"")
        at += size
    return from_planes(planes, n, footer["planes"] == "bit")


def read_file(data: bytes) -> Iterator[tuple[int | None, bytes]]:
    """(doc_id, ids) of each document, chunk by chunk."""
    footer, held, size, nxt = footer_of(data), [], 0, 0
    for doc_id, n in zip(footer["docs"], footer["lengths"], strict=True):
        while size < n:
            held.append(read_chunk(data, footer, nxt))
            size += len(held[-1])
            nxt += 1
        ids = np.concatenate(held) if held else np.zeros(0, "<u4")
        yield doc_id, ids[:n].tobytes()
        held, size = [ids[n:]], size - n


_encoders: dict[str, Encoder] = {}
#: Pieces that the pre-tokeniser keeps apart: an optional space, then bytes that are surely no white space.
_PLAIN = re.compile(rb" ?[!-~\x80-\xc1\xc3-\xe0\xe4-\xff]+")
#: Pieces that are encoded as one text.
_ROW = 400


class Encoder:
    """Encodes columns with the tokenizers library, each distinct short piece once where the tokenizer's split allows it."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        split, model = told.get("pre_tokenizer") or {}, told["model"]
        self.added = [x["content"] for x in told.get("added_tokens") or []]
        plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space") and not told.get("normalizer")
        plain = plain and model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback"))
        self.cache = PieceCache(self._pieces) if plain else None
        self.sizes = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, number in self.tokenizer.get_vocab().items():
            self.sizes[number] = len(token)  # a byte-level token has a character for each byte

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        count = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(count.sum())), count

    def _pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces: plain ones are encoded in rows, between which the pre-tokeniser cuts, and taken apart by their lengths.

        Pieces with a space in front follow each other; a line end keeps the others apart.
        """
        kind = [0 if not _PLAIN.fullmatch(x) else 1 if x[0] == 32 else 2 for x in pieces]
        kind, sizes = np.array(kind), np.fromiter(map(len, pieces), np.int64, len(pieces))
        parts, first, count, used = [], np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64), 0
        for which, between in ((1, b""), (2, b"\n"), (0, None)):
            at = np.flatnonzero(kind == which)
            if not len(at):
                continue
            mine = [pieces[i] for i in at.tolist()]
            if between is None:
                ids, count[at] = self._ids([x.decode() for x in mine])
                first[at] = used + np.cumsum(count[at]) - count[at]
            else:
                ids, _ = self._ids([(between + between.join(mine[i : i + _ROW])).decode() for i in range(0, len(mine), _ROW)])
                upto = np.cumsum(self.sizes[ids])
                ends = np.cumsum(sizes[at] + len(between))
                lo, hi = np.searchsorted(upto, ends - sizes[at], "right"), np.searchsorted(upto, ends, "right")
                if (upto[hi - 1] != ends).any():
                    raise ValueError("the tokenizer joins what its split should keep apart")
                first[at], count[at] = used + lo, hi - lo
            parts.append(ids)
            used += len(ids)
        ids, starts = np.concatenate(parts) if parts else np.zeros(0, np.uint32), np.cumsum(count) - count
        return ids[np.repeat(first - starts, count) + np.arange(int(count.sum()))], count

    def encode(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(lo, hi, ids, counts) of slices of a string column's rows; null counts as empty."""
        whole = np.full(len(column), self.cache is None)
        for x in self.added:
            whole |= pc.fill_null(pc.match_substring(column, x), False).to_numpy(zero_copy_only=False)
        for lo, hi in slices(utf8(column)[1], 4 << 20):
            part = column.slice(lo, hi - lo)
            if whole[lo:hi].any():
                yield lo, hi, *self._ids([x or "" for x in part.to_pylist()])
            else:
                yield from ((lo + a, lo + b, ids, count) for a, b, ids, count in self.cache.encode_column(part))


def _encoder(path: str) -> Encoder:
    """One encoder for a worker process, kept between its tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def write(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int, bits: bool = False, block: int = BLOCK, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes each text, appends end_id and writes the token files. Returns the manifest: shard, file, uri, n_docs, n_ids.

    tokenizer is the path of a tokenizers file that every executor has. Rows are range-partitioned by id, so each task writes the
    files of one id range; a task holds one file at most.
    """
    folder, end = shared_dir(spark, "tokens"), struct.pack("<I", end_id)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, number, out, encoder = TaskContext.get().partitionId(), 0, FileWriter(block, bits), _encoder(tokenizer)

        def close() -> pa.RecordBatch:
            nonlocal number
            uri, n_docs, n_ids = f"{folder}/{shard:06d}-{number:06d}-{uuid.uuid4().hex}.qbp", len(out.docs), out.ids
            put_file(uri, out.file())
            number += 1
            return pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "file": pa.array([number - 1], pa.int32()), "uri": [uri], "n_docs": [n_docs], "n_ids": [n_ids]})

        for batch in batches:
            for lo, hi, ids, count in encoder.encode(batch.column(1)):
                raw, upto = ids.astype("<u4", copy=False).tobytes(), (4 * np.r_[0, np.cumsum(count)]).tolist()
                for i, d in enumerate(batch.column(0).slice(lo, hi - lo).to_pylist()):
                    out.add(d, raw[upto[i] : upto[i + 1]] + end)
                    if out.ids >= FILE_IDS:
                        yield close()
        if out.docs:
            yield close()

    manifest = rows.mapInArrow(tidy(run), "shard int, file int, uri string, n_docs long, n_ids long")
    return stored(spark, manifest, "token-manifest")


def read(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, ids binary) of each document in the manifest's files; start counts the ids of all documents before it.

    Starts are two short running sums: over the shards' totals, one row a shard, and over each shard's files.
    """
    totals = manifest.groupBy("shard").agg(F.sum("n_ids").alias("total"))
    before = totals.select("shard", (F.sum("total").over(Window.orderBy("shard")) - F.col("total")).alias("base"))
    inner = F.sum("n_ids").over(Window.partitionBy("shard").orderBy("file")) - F.col("n_ids")
    placed = manifest.join(before, "shard").select("uri", (F.col("base") + inner).alias("start"))
    placed = placed.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for uri, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                store, path = fs.FileSystem.from_uri(uri)
                with store.open_input_stream(path, compression=None) as f:
                    data = f.read()
                docs, starts, ids, size = [], [], [], 0
                for d, x in read_file(data):
                    docs.append(d)
                    starts.append(start)
                    ids.append(x)
                    start += len(x) // 4
                    size += len(x)
                    if size > 4 << 20:
                        yield _rows(docs, starts, ids)
                        docs, starts, ids, size = [], [], [], 0
                if docs:
                    yield _rows(docs, starts, ids)

    return placed.mapInArrow(tidy(run), "doc_id long, start long, ids binary")


def _rows(docs: list, starts: list, ids: list[bytes]) -> pa.RecordBatch:
    values = binary_rows(np.frombuffer(b"".join(ids), np.uint8), np.array([len(x) for x in ids]))
    return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(starts, pa.int64()), values], ["doc_id", "start", "ids"])
