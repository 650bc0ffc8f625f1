"""Token ids, codes, counts and packing against the library and brute force."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from messy import DOCS, frame, rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from debtlens.llm import bpe_count, huffman, packing
from debtlens.llm import tokens as T

PARTS = ["a", "B", " ", "  ", "\n", "\t", "'s", "'", "é", "É", "1", ".", "!!", "\xa0", "　", "<|endoftext|>", "日", "\x1d",
         "the", " The", "ß", "×", "é", "İ", "'LL", "​", "<|", "|>"]
TEXT = st.lists(st.sampled_from(PARTS), max_size=25).map("".join) | st.text(max_size=30)


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(public_tokenizers.path(T.WORD_BPE))


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(public_tokenizers.path(bpe_count.BYTE_BPE))


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=6))
def test_ids_are_the_librarys(word_library, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    ids, first = T.words_of().encode(pa.array(texts))
    for k, text in enumerate(texts):
        assert ids[first[k] : first[k + 1]].tolist() == word_library.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=6))
def test_counts_are_the_librarys(byte_library, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    sizes, counts = bpe_count.counter_of().count(pa.array(texts))
    assert sizes.tolist() == [len(t.encode()) for t in texts]
    assert counts.tolist() == [len(byte_library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_caches_that_overflow_change_nothing(word_library):
    ids = T.WordIds(T.WORD_BPE)
    rng = random.Random(0)
    texts = [" ".join(f"w{rng.randrange(500)}x" for _ in range(50)) for _ in range(10)]
    for text in texts:
        if ids.known.count > 100:
            ids.clear()
        assert ids.encode(pa.array([text]))[0].tolist() == word_library.encode(text, add_special_tokens=False).ids


# --- codes ------------------------------------------------------------------------------


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 10**9), min_size=1, max_size=60), st.integers(6, 18))
def test_code_lengths_are_a_prefix_code_within_the_limit(counts, limit):
    lengths = huffman.code_lengths(np.array(counts), limit)
    used = [n for n, c in zip(lengths.tolist(), counts) if c]
    assert all(0 < n <= limit for n in used) and not any(n for n, c in zip(lengths, counts) if not c)
    if len(used) > 1:
        assert sum(2.0**-n for n in used) == 1


def test_unlimited_lengths_are_huffmans():
    import heapq

    rng = random.Random(1)
    counts = [rng.randrange(1, 1000) for _ in range(50)]
    heap, cost = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        two = heapq.heappop(heap) + heapq.heappop(heap)
        cost += two
        heapq.heappush(heap, two)
    assert (huffman.code_lengths(np.array(counts)) * np.array(counts)).sum() == cost


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 300), min_size=1, max_size=700), min_size=1, max_size=4))
def test_blocks_round_trip(blocks):
    blocks = [np.array(b, np.uint16) for b in blocks]
    lengths = huffman.code_lengths(np.bincount(np.concatenate(blocks), minlength=1 << 16))
    first = np.cumsum([0, *map(len, blocks)])
    ids = np.concatenate(blocks)
    offsets, steps, held, payload = huffman.pack(ids, first, huffman.canonical(lengths), lengths)
    assert np.array_equal(np.diff(steps), -(-np.diff(first) // huffman.STEP)) and len(payload) >= held[-1]
    at = offsets + np.repeat(8 * held[:-1], np.diff(steps))
    found = huffman.unpack(np.diff(first), at, payload, huffman.lookup(lengths))
    assert found.tolist() == ids.tolist()
    # A document alone has the same bytes as among others.
    alone = [huffman.pack(b, np.array([0, len(b)]), huffman.canonical(lengths), lengths) for b in blocks]
    assert [a[3][: a[2][-1]] for a in alone] == [payload[x:y] for x, y in zip(held, held[1:])]


def coded(data, library, end):
    docs = []
    for doc_id, text, *_ in data:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, end], "<u4")
        docs.append((doc_id, ids))
    return docs


def test_files_hold_all_ids(spark, word_library):
    data = rows()
    found = huffman.report(frame(spark, data)).collect()
    docs = coded(data, word_library, 1)
    assert Counter((r[0], r[2], r[3]) for r in found) == Counter((i, len(x), zlib.crc32(x.tobytes())) for i, x in docs)
    order = sorted(found, key=lambda r: r["start"])
    assert [r["start"] for r in order] == np.cumsum([0] + [r["n_tokens"] for r in order])[:-1].tolist()
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in order]
    assert ids == sorted(ids)


def test_several_blocks(spark, word_library, monkeypatch):
    monkeypatch.setattr(huffman, "BLOCK", 64)
    data = [(i, f"text number {i} " * (i % 9), None, None, None) for i in range(200)]
    found = huffman.report(frame(spark, data)).orderBy("doc_id").collect()
    start = 0
    for row, (doc_id, ids) in zip(found, coded(data, word_library, 1)):
        assert tuple(row) == (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_many_tiny_documents(spark):
    """Some hundred thousand documents of one id share few blocks, in time that grows with their number."""
    n = 100_000
    df = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("").alias("text"))
    found = huffman.report(df).agg(F.count(F.lit(1)), F.sum("start"), F.sum("n_tokens"), F.min("ids_crc32"), F.max("ids_crc32")).first()
    crc = zlib.crc32(np.array([1], "<u4").tobytes())
    assert tuple(found) == (n, n * (n - 1) // 2, n, crc, crc)


def test_larger_vocabularies_are_refused():
    class Library:
        def __init__(self, size):
            self.size = size

        def get_vocab_size(self):
            return self.size

    assert T.checked(Library(1 << 16), "full").size == 1 << 16
    with pytest.raises(ValueError, match="large.json has 65537 ids"):
        T.checked(Library((1 << 16) + 1), "large.json")


def test_no_documents(spark):
    empty = frame(spark, [], DOCS)
    assert huffman.report(empty).collect() == []
    assert packing.packed(empty).collect() == []
    assert bpe_count.report(empty).collect() == []


# --- counts -----------------------------------------------------------------------------


def test_token_counts(spark, byte_library):
    data = rows()
    found = bpe_count.report(frame(spark, data)).collect()
    expected = Counter()
    for doc_id, text, *_ in data:
        n = len(byte_library.encode(text or "", add_special_tokens=False).ids)
        expected[doc_id, len((text or "").encode()), n, n > 1024] += 1
    assert Counter(map(tuple, found)) == expected


def test_overlapping_pairs_merge_from_the_left(byte_library):
    merges = bpe_count.counter_of().merges
    for n in range(1, 70):
        for letter in "a=- ":
            text = letter * n
            left = merges.surviving(np.frombuffer(text.encode(), np.uint8), np.array([n]))
            assert left[0] == len(byte_library.model.tokenize(text.replace(" ", "Ġ")))


# --- packing ----------------------------------------------------------------------------


def check_packing(placed, capacity):
    bins = defaultdict(list)
    for _, sequence, offset, length in placed:
        bins[sequence].append((offset, length))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_pieces_and_sequences(spark, word_library):
    data = rows()
    found = packing.packed(frame(spark, data)).collect()
    expected = Counter()
    for doc_id, ids in coded(data, word_library, 0):
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            expected[doc_id, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == expected
    used = check_packing([(0, r["sequence_id"], r["offset"], r["length"]) for r in found], 2048)
    least = -(-sum(r["length"] for r in found) // 2048)
    assert used <= least + 1


def test_many_cells_pack_almost_as_one(spark):
    rng = random.Random(2)
    items = [(i, min(2048, int(rng.lognormvariate(5.5, 1.2)) + 1)) for i in range(6000)]
    df = spark.createDataFrame(items, "item long, length long").repartition(3)
    found = packing.pack(df, cell=400).join(df, "item").collect()
    assert {r["item"] for r in found} == {i for i, _ in items} and len(found) == len(items)
    used = check_packing([(0, r["sequence_id"], r["offset"], r["length"]) for r in found], 2048)
    assert used <= 1.01 * -(-sum(n for _, n in items) // 2048) + 1


def test_lengths_that_fit_badly(spark):
    df = spark.createDataFrame([(i, 1100) for i in range(300)], "item long, length long")
    assert packing.pack(df, cell=50).select("sequence_id").distinct().count() == 300


def test_evolution_never_gets_worse():
    rng = random.Random(3)
    lengths = [rng.randrange(200, 900) for _ in range(300)]
    packer = packing.Packer(lengths, 2048, 7)
    population = [packer.start(k == 0) for k in range(4)]
    best = min(len(bins) for bins, _ in population)
    for _ in range(5):
        population = packer.evolve(population, 5)
        for bins, free in population:
            assert sorted(i for b in bins for i in b) == list(range(300))
            assert free == packer.room(bins) and min(free) >= 0
        assert len(population[0][0]) <= best
        best = len(population[0][0])
