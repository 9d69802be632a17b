import base64
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import bitplane, bpe_tree
from quire.llm.chunks import PieceCache, spans

public_tokenizers = pytest.importorskip("public_tokenizers")
VOCABULARY, JSON = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "b", "the", "ing", " ", "  ", "\n", "\t", "é", "中文", "1", "23", "...", "!", " ", "aaaa", "'s", "'", "🙂", "<|endoftext|>"]
ODD = ["\u00a0", "\u2003", "\u3000", "\u0085", "\x1c", "\x00", "ü", "×", "÷", "Ж", "ѿ", "ſ", "\r\n", "’", "e\u0301", "²", "_", "'re", "'sx", " '", "“", "ß", "\u200b", "1²", "ªº"]


@pytest.fixture(scope="module")
def bpe():
    return bpe_tree.TreeBpe.load(VOCABULARY, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCABULARY, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS + ODD) | st.text(max_size=8), max_size=40))
def test_tree_equals_library(bpe, reference, parts):
    text = "".join(parts)
    ids = np.frombuffer(bpe.encode([text])[0], "<u4").tolist()
    assert ids == reference.encode_ordinary(text)
    assert bpe.decode(ids) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=1, max_size=120))
def test_tree_of_any_bytes_equals_merging_the_whole(bpe, piece):
    assert bpe.tree(piece) == bpe._merged_long(piece)
    for cut in (1, len(piece) // 3, len(piece) // 2):
        assert bpe.join(bpe.tree(piece[:cut]), bpe.tree(piece[cut:])) == bpe.tree(piece)


def test_long_runs(bpe, reference):
    for text in ("a" * 6000, " " * 5000 + "x", "\n" * 3001 + " y", "ab" * 2000, "中" * 2000, "the" * 3000):
        assert np.frombuffer(bpe.encode([text])[0], "<u4").tolist() == reference.encode_ordinary(text)


def plain_cache(bits=21):
    """Ids of a piece are its bytes and a 999 behind them, so wrong keys and borders show."""
    seen = []

    def encode_all(pieces):
        seen.extend(pieces)
        ids = [[*x, 999] for x in pieces]
        return np.array([y for x in ids for y in x], np.uint32), np.array([len(x) for x in ids], np.int64)

    return PieceCache(encode_all, bits), seen


def rows_of(cache, texts, most=1 << 20):
    import pyarrow as pa

    out = []
    for lo, hi, ids, count in cache.encode_column(pa.array(texts), most):
        assert hi - lo == len(count) and count.sum() == len(ids)
        out += [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])]
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS + ODD) | st.text(max_size=20), max_size=12).map("".join) | st.none(), max_size=12))
def test_pieces_are_remembered_exactly(texts):
    cache, seen = plain_cache(6)
    for _ in range(2):
        rows = rows_of(cache, texts)
        assert [bytes(x for x in r if x != 999) for r in rows] == [(t or "").encode() for t in texts]
        assert rows == rows_of(plain_cache()[0], texts)
    cache.forget()
    assert cache.taken == 0 and rows_of(cache, texts) == rows


def test_what_is_remembered_is_bounded_in_bytes():
    cache, seen = plain_cache()
    rows_of(cache, ["x" * 100_000 + str(i) for i in range(20)] + ["中" * 50_000] * 3)
    assert cache.used < 200 and cache.taken < 40
    cache, _ = plain_cache(8)
    for i in range(40):
        rows_of(cache, [f" w{i}a{j}" for j in range(20)])
        assert cache.taken <= 0.6 * cache.places and cache.places == 256


def test_known_pieces_are_found_again_when_the_table_grows():
    cache, _ = plain_cache()
    texts = [[f" w{j}" for j in range(n)] for n in (100, 3000, 12_000)]
    for t in texts:
        before = cache.bits
        assert rows_of(cache, t) == rows_of(plain_cache()[0], t)
    assert cache.bits > before > 12


def batches_that_grow():
    """Texts in three batches; all words of a batch come again in the next one, among many more."""
    words = ["".join(chr(97 + j // 26**k % 26) for k in range(3)) for j in range(12_000)]
    return [[" ".join(words[i:n:10]) for i in range(10)] for n in (100, 3000, 12_000)]


def test_long_texts_are_cut_where_pieces_end():
    for text in ("ab cd. " * 5000, "x" * 20_000, "x" * 9000 + " y" * 9000, " " * 9000 + "z" * 100):
        data = np.frombuffer(text.encode(), np.uint8)
        got = list(spans(data, 0, len(data), 500))
        assert [a for a, _ in got[1:]] == [b for _, b in got[:-1]] and got[0][0] == 0 and got[-1][1] == len(data)
        assert rows_of(plain_cache()[0], [text], 500) == rows_of(plain_cache()[0], [text])


def test_spans_leave_white_space_as_it_is_matched_in_the_whole_text(bpe, reference):
    import pyarrow as pa

    texts = ["one two.\n\nthree " * 60, "\n" * 50 + "x" * 900, "中 \n\t\n文 é\r\n\r\n" * 60, "a\n\n1\t\t!\n\n\n'x  \n" * 60, " \n" * 300 + "z"]
    for most in (40, 41, 42, 43, 44, 100, 107):
        got = [ids.tolist() for _, _, ids, _ in bpe.cache.encode_column(pa.array(texts), most)]
        assert got == [reference.encode_ordinary(x) for x in texts]


def test_letters_and_numbers_are_those_of_the_library(bpe, reference):
    import tiktoken

    signs = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    single = {bytes([i]): i for i in range(256)}
    for name in (r"\p{L}", r"\p{N}"):
        library = tiktoken.Encoding("own", pat_str=name, mergeable_ranks=single, special_tokens={})
        assert "".join(bpe_tree._splitter(name).findall(signs)) == library.decode(library.encode_ordinary(signs))
    # Letters of Unicode 18 and 17 before one that Unicode 16 has; a merge would go across the border.
    for text in ("\U0003da76\u645b", "\u5ff1\u042a\U000325b6\u60ab"):
        ids = np.frombuffer(bpe.encode([text])[0], "<u4")
        assert ids.tolist() == reference.encode_ordinary(text) and bpe.decode(ids) == text.encode()


def test_decoding_tree(bpe, monkeypatch):
    text = "the thing, 中文 and é " * 300
    ids = np.frombuffer(bpe.encode([text])[0], "<u4")
    monkeypatch.setattr(bpe_tree, "_LEAF_IDS", 7)
    assert bpe.decode(ids) == text.encode() and bpe.decode([]) == b""
    for bad in (len(bpe.size), -1):
        with pytest.raises(KeyError):
            bpe.decode([0, bad])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS + ODD) | st.text(max_size=8), max_size=20).map("".join), min_size=1, max_size=6))
def test_token_encoder_equals_library(texts):
    import pyarrow as pa

    e = bitplane._encoder(JSON)
    rows = [x.tolist() for _, _, ids, count in e.encode(pa.array(texts)) for x in np.split(ids, np.cumsum(count)[:-1])]
    assert rows == [x.ids for x in e.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_encode_and_decode(spark, docs, texts, reference):
    args = VOCABULARY, public_tokenizers.PATTERN
    rows = bpe_tree.decode(bpe_tree.encode(docs, *args), *args).orderBy("doc_id").collect()
    assert [r.ids for r in rows] == [reference.encode_ordinary(t or "") for t in texts]
    assert [bytes(r.decoded) for r in rows] == [(t or "").encode() for t in texts]
    assert bpe_tree.encode(docs.limit(0), *args).count() == 0
    null = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [bytes(r.decoded) for r in bpe_tree.decode(null, *args).orderBy("doc_id").collect()] == [b"", b""]


@pytest.mark.parametrize("bits", [False, True])
def test_planes_and_files(bits):
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 2**32, 5000, dtype=np.uint32)
    assert (bitplane.from_planes(bitplane.to_planes(ids, bits), len(ids), bits) == ids).all()
    writer = bitplane.FileWriter(block=64, bits=bits)
    docs = [(i, rng.integers(0, 60_000, n, dtype=np.uint32).astype("<u4").tobytes()) for i, n in enumerate([1, 0, 63, 64, 65, 1000, 0])]
    for d, x in docs:
        writer.add(d, x)
    data = writer.file()
    assert list(bitplane.read_file(data)) == docs
    footer = bitplane.footer_of(data)
    whole = np.frombuffer(b"".join(x for _, x in docs), "<u4")
    assert (bitplane.read_chunk(data, footer, 3) == whole[192:256]).all()
    with pytest.raises(ValueError):
        bitplane.footer_of(data[:-1])


def test_token_files(spark, docs, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(JSON)
    expected = [x.ids + [0] for x in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]
    for bits in (False, True):
        rows = bitplane.read(spark, bitplane.write(spark, docs, JSON, 0, bits=bits, block=1000)).orderBy("doc_id").collect()
        assert [r.start for r in rows] == np.r_[0, np.cumsum([len(x) for x in expected])][:-1].tolist()
        assert [zlib.crc32(bytes(r.ids)) for r in rows] == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in expected]
    assert bitplane.read(spark, bitplane.write(spark, docs.limit(0), JSON, 0)).count() == 0


def test_null_and_repeated_ids(spark):
    d = spark.createDataFrame([(None, "x"), (2, "b"), (2, "a"), (1, None)], "doc_id long, text string")
    rows = bitplane.read(spark, bitplane.write(spark, d, JSON, 0)).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 2, 2]
    assert [len(bytes(r.ids)) // 4 for r in rows] == [2, 1, 2, 2]


def test_token_encoder_equals_library_over_batches():
    import pyarrow as pa
    from tokenizers import Tokenizer

    encoder, library = bitplane.Encoder(JSON), Tokenizer.from_file(JSON)
    for texts in batches_that_grow():
        got = [x for _, _, ids, count in encoder.encode(pa.array(texts)) for x in np.split(ids, np.cumsum(count)[:-1])]
        assert [x.tolist() for x in got] == [x.ids for x in library.encode_batch_fast(texts, add_special_tokens=False)]


def test_tree_equals_library_over_batches(reference):
    import pyarrow as pa

    fresh = bpe_tree.TreeBpe.load(VOCABULARY, public_tokenizers.PATTERN)
    for texts in batches_that_grow():
        got = [x for _, _, ids, count in fresh.cache.encode_column(pa.array(texts), 1 << 20) for x in np.split(ids, np.cumsum(count)[:-1])]
        assert [x.tolist() for x in got] == [reference.encode_ordinary(x) for x in texts]
        assert [fresh.decode(x) for x in got] == [x.encode() for x in texts]
