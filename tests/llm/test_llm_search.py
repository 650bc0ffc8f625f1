"""Ranked search, license scans and spelling variants against brute force."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from messy import DOCS, frame, lower, rows, sentence

from debtlens.llm import lexical, licenses, variants

# --- ranked search ------------------------------------------------------------------------

ITEMS = "item_id long, text string"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text))


def ranking(docs, items, top=10):
    """(item_id, rank, doc_id, score) by scoring every document."""
    held = [(i, terms(t)) for i, t, *_ in docs]
    held = [(i, Counter(w)) for i, w in held if w]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text, *_ in items:
        scored = []
        for i, c in held:
            m = 10 + (90 * sum(c.values()) * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in set(terms(text)) & c.keys()
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank + 1, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:top])]
    return Counter(out)


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    pick = lambda size: " ".join(words[min(399, int(rng.expovariate(0.02)))] for _ in range(size))
    return [(i, pick(rng.choice([5, 40, 200])), None, None, None) for i in range(n)], [(k, pick(25)) for k in range(12)]


def test_ranking_of_messy_rows(spark):
    data = rows()
    items = [(k, t) for k, t in enumerate([data[25][1], data[30][1], data[40][1], "the river", "no such term zzz", "", None, "É étude"])]
    items += [(None, "house and stone"), (3, "light"), (3, "light"), (9, "word word word x")]
    found = lexical.report(frame(spark, data), frame(spark, items, ITEMS)).collect()
    assert Counter(map(tuple, found)) == ranking(data, items)


def test_equal_scores_by_id_and_repeated_documents(spark):
    data = [(i, "same words here", None, None, None) for i in (9, 3, 7, None, 3, 1)] + [(50 + k, f"other{k} text", None, None, None) for k in range(20)]
    found = lexical.report(frame(spark, data), frame(spark, [(1, "same words")], ITEMS)).orderBy("rank").collect()
    assert [r["doc_id"] for r in found] == [1, 3, 3, 7, 9, None]
    assert len({r["score"] for r in found}) == 1


def test_empty_tables(spark):
    some, item = frame(spark, [(1, "a b", None, None, None)]), frame(spark, [(1, "a")], ITEMS)
    for docs, items in ((some.limit(0), item), (some, item.limit(0)), (frame(spark, [(1, None, None, None, None)]), item)):
        found = lexical.report(docs, items)
        assert found.collect() == [] and found.columns == ["item_id", "rank", "doc_id", "score"]


def test_many_blocks_and_query_sets(spark, monkeypatch):
    monkeypatch.setattr(lexical, "SET_BYTES", 500)
    data, items = corpus(3, 600)
    blocks = lexical.index(frame(spark, data).repartition(7))
    assert blocks.count() == 7
    found = lexical.report(frame(spark, data).repartition(7), frame(spark, items, ITEMS).coalesce(1)).collect()
    assert Counter(map(tuple, found)) == ranking(data, items)


def _lists(data, items, paired):
    """All documents as one block, without Spark."""
    batch = pa.RecordBatch.from_arrays([pa.array([d[0] for d in data]), pa.array([d[1].encode() for d in data])], names=["doc_id", "text"])
    row = next(lexical._indexed(iter([batch])))
    hashes, first = lexical.term_hashes(pa.array([t for _, t in items]))
    distinct, back = np.unique(hashes, return_inverse=True)
    df = np.zeros(len(distinct), np.int64)
    counted = next(lexical._counter(distinct)(iter([row])))
    df[counted.column("term").to_numpy()] = counted.column("df").to_numpy()
    n, total = row.column("n_docs")[0].as_py(), row.column("n_terms")[0].as_py()
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()])
    queries = lexical.Queries(distinct, weights, [np.unique(back[a:b]) for a, b in zip(first, first[1:])], np.sort(np.argsort(-df)[:paired]))
    held = next(lexical._rows(lexical._lister(queries, n, total)(iter([row]))))
    return lexical.Lists(held, weights), queries


def test_pair_bounds_look_at_fewer_documents():
    data, items = corpus(5, 3000)
    looked = {}
    for paired in (0, 64):
        block, queries = _lists(data, items, paired)
        best = [block.best(q, 1, 3) for q in queries.items]
        first = [int(scores[-1]) for _, scores in best]
        block.looked_at = 0
        again = [block.best(q, least, 3) for q, least in zip(queries.items, first)]
        assert all((a[0] == b[0]).all() and (a[1] == b[1]).all() for a, b in zip(best, again))
        looked[paired] = block.looked_at
    assert looked[64] < looked[0] < 3000 * len(items)


def test_pair_lists_hold_joint_maxima():
    data, items = corpus(8, 300)
    block, _ = _lists(data, items, 10)
    for a, i in block.pair.items():
        for b, j in block.pair.items():
            if a < b:
                (da, sa), (db, sb) = (block._list(int(np.searchsorted(block.terms, t))) for t in (a, b))
                both, x, y = np.intersect1d(da, db, return_indices=True)
                assert block.joint[i, j] == (sa[x] + sb[y]).max(initial=0)
                assert np.array_equal(np.flatnonzero(np.unpackbits(block.bitmaps[i, j], count=300)), both)


# --- license scans ------------------------------------------------------------------------


def license_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def scan(doc_id, text):
    """A row of the report, by comparing every window with every template."""
    w = license_words(text)
    places = []
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        places += [(i, label) for i in range(len(w)) if w[i : i + len(p)] == p]
    best: dict = {}
    for t in licenses.templates():
        step, own = t.width // 2, set(t.words)
        for k in range(max(1, -(-len(w) // step) - 1) if w else 0):
            common = len(own & set(w[k * step : k * step + t.width]))
            if common >= t.needed:
                best.setdefault(t.family, set()).add((common / len(own), len(own), t.label))
    own = {label for held in best.values() for c, n, label in held if (c, n) == max(held)[:2]}
    base = {label for _, label in places}
    score = 1.0 if places else max((c for held in best.values() for c, _, _ in held), default=0.0)
    starts = [i for i, _ in places]
    return (
        doc_id, len(w), len(places), min(starts, default=None), max(starts, default=None),
        ",".join(sorted(base)), ",".join(sorted(base | own)), score,
    )


def licensed():
    rng = random.Random(9)
    data = rows()
    texts = [text for _, _, text in licenses.TEMPLATES]
    for k, text in enumerate(texts):
        words = text.split()
        few = [x for x in words if rng.random() > 0.15]  # some words lost: around the threshold
        held = [text, sentence(rng, 40) + "\n" + text + "\n" + sentence(rng, 300), " ".join(few), "\n".join(words[: len(words) // 2])]
        held.append(sentence(rng, rng.randrange(200)) + " " + text.upper().replace(" ", "\n# "))
        data += [(10_000 + 10 * k + i, x, None, None, None) for i, x in enumerate(held)]
    data += [(1, "CC BY", None, None, None), (2, "cc by cc by-sa 4.0 mit license", None, None, None), (3, "mit\x00license Mit License", None, None, None)]
    return data + [(4, "\n".join(texts * 3), None, None, None), (4, "mitt license apache licenses", None, None, None)]


def test_license_scans(spark):
    data = licensed()
    found = licenses.report(frame(spark, data)).collect()
    assert Counter(map(tuple, found)) == Counter(scan(i, t) for i, t, *_ in data)
    assert licenses.report(frame(spark, data).limit(0)).collect() == []


def test_license_labels_of_the_method():
    by = {label: scan(1, text)[6] for family, label, text in licenses.TEMPLATES if family.startswith("cc")}
    assert all(label in labels.split(",") for label, labels in by.items())
    assert "cc-by-sa" not in by["cc-by"] and scan(1, licenses.TEMPLATES[3][2])[5:7] == ("", "isc")
    assert len(licenses.TEMPLATES) == len({(t.family, t.label) for t in licenses.templates()})


def test_join_finds_what_counting_finds():
    """The filters lose nothing, whatever the order of the words."""
    rng = np.random.default_rng(2)
    words = licenses.vocabulary()
    for _ in range(5):
        join = licenses.Join(rng.integers(0, 5, len(words)))
        t = join.templates[rng.integers(len(join.templates))]
        own = [words.index(w) for w in t.words]
        text = np.concatenate([rng.integers(0, len(words), 300), own, rng.integers(0, len(words), 300)])
        found = set(join.found(np.zeros(len(text), int), np.arange(len(text)), text, np.array([len(text)])))
        expected = set()
        for k, one in enumerate(join.templates):
            ids = {words.index(w) for w in one.words}
            step = one.width // 2
            for b in range(max(1, -(-len(text) // step) - 1)):
                common = len(ids & set(text[b * step : b * step + one.width].tolist()))
                if common >= one.needed:
                    expected.add((0, k, b * step, common))
        assert found == expected and expected


# --- spelling variants --------------------------------------------------------------------


def distance_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def spelled(data):
    counts = Counter()
    for doc_id, text, *_ in data:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = defaultdict(list)
    for a in words:
        near[a] = [b for b in words if distance_one(a, b)]
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda b: (-words[b], b), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return Counter(out)


def varied(seed=4):
    rng = random.Random(seed)
    base = ["mountain", "étudiante", "fountain", "riverside", "stones", "a" * 100, "noëlsüd"]
    data = []
    for i in range(250):
        text = []
        for _ in range(60):
            w = list(rng.choice(base))
            while rng.random() < 0.15:
                k = rng.randrange(len(w))
                w[k : k + 1] = rng.choice([[], [rng.choice("aeé")], [w[k], rng.choice("ae")]])
            text.append("".join(w) + rng.choice([" ", ", ", "1", "œ"]))
        data.append((rng.choice([None, i, i, 10**15 + i]), "".join(text), None, None, None))
    return data + rows()


def test_variants(spark):
    data = varied()
    found = variants.report(frame(spark, data)).collect()
    expected = spelled(data)
    assert Counter(map(tuple, found)) == expected
    assert any(w[1] and w[2] != w[1] for w in expected)  # forms of forms
    assert variants.report(frame(spark, data).limit(0)).collect() == []


def test_numbers_of_runs():
    rng = random.Random(6)
    for _ in range(20):
        texts = [" ".join("".join(rng.choice("abcé×XY") for _ in range(rng.choice([3, 7, 20, 90]))) for _ in range(200)) for _ in range(3)]
        ids = [None, rng.randrange(10**6), -(10**17)]
        counts = defaultdict(int)
        variants.count_words(ids, pa.array([t.encode() for t in texts]), counts, 6)
        expected = Counter()
        for i, t in zip(ids, texts):
            for run in map(lower, t.split()):
                h = variants.marked(i, run.encode())
                run = run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]
                if len(run) >= 6:
                    expected[run.encode()] += 1
        assert counts == expected


@pytest.mark.parametrize("size", [6, 7])
def test_every_edit_leaves_a_chunk(spark, size):
    """All words of a few letters: the join finds each pair once."""
    words = ["".join("ab"[k >> i & 1] for i in range(n)) for n in (size, size + 1) for k in range(1 << n)]
    df = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    found = Counter(frozenset((r["a"], r["b"])) for r in variants.near(df).collect())
    assert found == Counter({frozenset((a, b)): 1 for a in words for b in words if distance_one(a, b)})


def test_schema_of_documents_is_enough(spark):
    assert variants.report(spark.createDataFrame([], DOCS)).columns == ["word", "form", "root", "n", "n_near", "form_n"]
