"""Exact, near and line deduplication against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given
from hypothesis import strategies as st
from messy import DOCS, Groups, edited, frame, lower, rows, sentence, words

from debtlens.llm import edits, exact_dedup, line_dedup, near_dedup
from debtlens.llm import words as W
from debtlens.llm.graph import components


@given(st.sets(st.integers(0, 2**40 - 1), max_size=60))
def test_golomb_lists_round_trip(values):
    values = np.array(sorted(values), np.uint64)
    k, unary, rests = exact_dedup.encode(values, 1 << 40)
    assert exact_dedup.decode(len(values), k, unary, rests).tolist() == values.tolist()


def test_golomb_lists_are_short():
    rng = np.random.default_rng(0)
    values = np.unique(rng.integers(0, 1 << 40, 10_000, dtype=np.uint64))
    k, unary, rests = exact_dedup.encode(values, 1 << 40)
    # log2(space / values) + 1.5 bits each are the least possible, a raw hash has 40.
    assert 8 * (len(unary) + len(rests)) / len(values) < np.log2(2**40 / len(values)) + 2


def exact(data):
    groups = defaultdict(list)
    for doc_id, text, *_ in data:
        groups[lower(text)].append(doc_id)
    out = Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = max(known, default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        left = 1  # of rows equal in text and id one stays
        for i in ids:
            stays = i == best and left > 0
            left -= stays
            out[i, best, len(ids), stays, digest] += 1
    return out


@pytest.mark.parametrize("bits", [6, 48])
def test_exact_copies(spark, bits):
    # Six bits let most texts share a fingerprint: they are told apart by their bytes.
    data = rows()
    found = exact_dedup.report(frame(spark, data), bits=bits).collect()
    assert Counter(map(tuple, found)) == exact(data)


def test_exact_copies_of_one_text_by_the_thousand(spark):
    data = [(i, "HOT" if i % 3 else f"text {i}", None, None, None) for i in range(9000)]
    found = exact_dedup.report(frame(spark, data, clashes=False)).collect()
    assert Counter(map(tuple, found)) == exact(data)


def test_without_copies_keeps_columns(spark):
    df = frame(spark, rows())
    kept = exact_dedup.without_copies(df)
    assert kept.columns == df.columns
    assert kept.count() == sum(n for key, n in exact(rows()).items() if key[3])


def near(data):
    sets = []
    for doc_id, text, *_ in data:
        w = words(lower(text))
        sets.append((doc_id, frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()))
    groups = Groups()
    named = [(i, s) for i, s in sets if i is not None and s]
    for i, s in named:
        groups.find(i)
        for j, t in named:
            both = len(s & t)
            if 100 * both >= 85 * (len(s) + len(t) - both):
                groups.join(i, j)
    out = Counter()
    for i, s in sets:
        component = groups.find(i) if i is not None and i in groups.up else i
        out[i, len(s), component, component == i] += 1
    return out


def test_near_copies(spark):
    data = rows()
    found = near_dedup.components(frame(spark, data)).collect()
    assert Counter(map(tuple, found)) == near(data)


def test_near_copies_of_one_text_with_other_edits_each(spark):
    # Copies are linked to the base and to few of each other, so stars alone would not do.
    rng = random.Random(1)
    base = sentence(rng, 150)
    data = [(i, edited(rng, base, i % 5), None, None, None) for i in range(250)]
    data += [(1000 + i, edited(rng, sentence(rng, 40), 1), None, None, None) for i in range(20)]
    rng.shuffle(data)
    found = near_dedup.components(frame(spark, data, clashes=False)).collect()
    assert Counter(map(tuple, found)) == near(data)


def test_chains_are_one_component(spark):
    # Each text is linked to the next, the ends are not linked.
    w = [f"w{i}" for i in range(400)]
    data = [(i, " ".join(w[i * 4 : i * 4 + 120]), None, None, None) for i in range(40)]
    found = near_dedup.components(frame(spark, data, clashes=False)).collect()
    assert Counter(map(tuple, found)) == near(data)
    assert len({r["component_id"] for r in found}) < 40


def test_one_per_group(spark):
    df = frame(spark, rows())
    kept = near_dedup.one_per_group(df)
    assert kept.columns == df.columns
    gone = sum(n for (i, _, c, _), n in near(rows()).items() if i is not None and i != c)
    assert kept.count() == len(rows()) - gone


def test_signatures_agree_as_often_as_sets():
    rng = np.random.default_rng(2)
    for size in (3, 40, 2000):
        agree = []
        for _ in range(60):
            both = rng.integers(0, 2**64, size * 2, dtype=np.uint64)
            a, b = np.sort(both[: int(size * 1.5)]), np.sort(both[int(size * 0.5) :])
            one, other = near_dedup.signatures([a, b])
            agree.append(np.mean(one == other))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs(np.mean(agree) - true) < 0.08


def test_word_hashes_do_not_depend_on_place():
    import pyarrow as pa

    data, offsets = W.buffers(pa.array(["alpha beta", None, " beta alpha", "be ta"]))
    starts, ends, first = W.find(data, offsets)
    h = W.hashes(data, starts, ends)
    assert first.tolist() == [0, 2, 2, 4, 6]
    assert h[0] == h[3] and h[1] == h[2] and len(set(h.tolist())) == 4


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1100)]
    groups = Groups()
    for a, b in edges:
        groups.join(a, b)
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    expected = {x: groups.find(x) for e in edges if e[0] != e[1] for x in e}
    assert dict(map(tuple, found)) == expected and len(found) == len(expected)


# --- lines ------------------------------------------------------------------------------


def normal(line: str) -> str:
    import re

    table = str.maketrans("0123456789", "0" * 10)
    return re.sub(r"[\x20\x09-\x0D!-/:-@\[-`{-~]+", " ", lower(line).translate(table)).strip()


def similar(a: str, b: str) -> bool:
    """Whether an edit similarity is 0.9 or more, in a band of the distance that this allows."""
    most = max(len(a), len(b)) * 10 // 100
    if abs(len(a) - len(b)) > most:
        return False
    far = most + 1
    row = {j: j for j in range(min(len(b), most) + 1)}
    for i, x in enumerate(a, 1):
        last, row = row, {}
        for j in range(max(0, i - most), min(len(b), i + most) + 1):
            best = min(last.get(j, far), row.get(j - 1, far)) + 1
            row[j] = min(best, last.get(j - 1, far) + (x != b[j - 1])) if j else i
        if min(row.values()) > most:
            return False
    return row[len(b)] <= most


def lines_left(data):
    """Rows as the report has them, by the edit similarity of all pairs of lines; and of every line
    that goes its row, place and normal form."""
    first: dict[str, tuple] = {}
    for at, (doc_id, text, *_) in enumerate(data):
        for place, line in enumerate((text or "").split("\n")):
            name = normal(line)
            if name:
                key = (doc_id is not None, doc_id or 0, at, place)
                first[name] = min(first.get(name, key), key)
    groups, names = Groups(), sorted(first)
    for k, a in enumerate(names):
        groups.find(a)
        for b in names[k + 1 :]:
            if similar(a, b):
                groups.join(a, b)
    stays = {}
    for n in names:
        root = groups.find(n)
        stays[root] = min(stays.get(root, first[n]), first[n])
    out, gone = [], set()
    for at, (doc_id, text, *_) in enumerate(data):
        lines = [] if text is None else text.split("\n")
        own = {
            place for place, line in enumerate(lines)
            if normal(line) and stays[groups.find(normal(line))] != (doc_id is not None, doc_id or 0, at, place)
        }
        gone |= {(at, place, normal(lines[place])) for place in own}
        left = None if text is None else "\n".join(x for place, x in enumerate(lines) if place not in own)
        out.append((doc_id, len(lines), len(own), left))
    return out, gone


def lines_of(seed: int):
    rng = random.Random(seed)
    base = [sentence(rng, rng.choice([2, 8, 30, 60])) for _ in range(25)]
    data = []
    for i in range(60):
        lines = [rng.choice(base) for _ in range(rng.randrange(5))]
        lines += [edited(rng, rng.choice(base), 1) for _ in range(2)] + [rng.choice(["", "  ", "--", "Menu: 12", "menu 47"])]
        rng.shuffle(lines)
        # Some ids are null, some rows share one, some are equal.
        data.append((rng.choice([i, i, i, None, 7]), "\n".join(lines), None, None, None))
    data += data[3:6] + [data[10]] * 4
    return data + [(None, None, None, None, None), (500, "", None, None, None), (501, "\n\n", None, None, None), (502, None, None, None, None)]


@pytest.mark.parametrize("seed", [4, 6])
def test_lines(spark, seed):
    """Nothing goes that the edit similarity of all pairs lets stay; 9 in 10 of the others go."""
    data = lines_of(seed)
    expected, gone = lines_left(data)
    plain = spark.createDataFrame(data, DOCS).selectExpr("*", "'clash' AS mid", "'clash' AS block").coalesce(1)
    found = list(map(tuple, line_dedup.report(plain).collect()))
    assert len(found) == len(expected)
    assert Counter((i, n) for i, n, *_ in found) == Counter((i, n) for i, n, *_ in expected)
    if Counter(found) != Counter(expected):  # the sieve may miss a pair, and then a line more stays
        assert sum(r[2] for r in found) >= 0.9 * len(gone)
        kept = Counter((i, x) for i, _, _, text in found for x in (text or "").split("\n"))
        assert not Counter((i, x) for i, _, _, text in expected for x in (text or "").split("\n") if normal(x)) - kept
    assert all(len(left.split("\n")) >= n - k for _, n, k, left in found if left is not None)


def test_recall_of_edited_lines(spark):
    """Pairs of an edit similarity of 0.9 or more, of all lengths, one edited word each."""
    rng = random.Random(11)
    data, pairs = [], 0
    for i in range(300):
        line = sentence(rng, rng.choice([12, 20, 40, 80, 150]))
        other = edited(rng, line, 1)
        if not similar(normal(line), normal(other)):
            continue
        pairs += normal(line) != normal(other)
        data += [(2 * i, line, None, None, None), (2 * i + 1, f"own {i}\n{other.upper()}", None, None, None)]
    found = line_dedup.report(frame(spark, data)).collect()
    assert pairs > 150 and sum(r["n_removed"] for r in found) >= 0.9 * pairs


@pytest.mark.parametrize("neighbours", [1 << 12, 2])
def test_only_lines_near_another_one_leave_their_buckets(monkeypatch, neighbours):
    """The sieve of one block against all pairs; buckets with too many neighbours go on whole."""
    monkeypatch.setattr(line_dedup, "NEIGHBOURS", neighbours)
    rng = np.random.default_rng(3)
    n = 1500
    simhash = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    simhash[500:1000] = simhash[:500] ^ (np.uint64(1) << rng.integers(0, 64, 500, dtype=np.uint64))
    simhash[1000:1040] = simhash[0] ^ (np.uint64(1) << rng.integers(20, 60, 40, dtype=np.uint64))
    words = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    words[500:800] = words[:300]
    words[1000:1040] = words[0]
    size = rng.choice([30, 100, 128, 140, 141, 142, 500], n).astype(np.int32)
    size[600:1000] = size[100:500]
    nodes = pa.record_batch([pa.array(np.arange(n)), pa.array(simhash.view(np.int64)), pa.array(words.view(np.int64)), pa.array(size)], names=["node", "simhash", "words", "size"])
    dealt = pa.Table.from_batches(line_dedup._dealer(3)(iter([nodes.slice(0, 700), nodes.slice(700)])))
    found = set()
    for block in range(8):
        for slot in range(3):
            own = dealt.filter(pc.and_(pc.equal(dealt["block"], block), pc.equal(dealt["slot"], slot)))
            if len(own):
                kept = line_dedup._sieved(own)
                found |= set(zip((kept["bucket"].to_numpy() % 512).tolist(), kept["node"].to_pylist()))
    expected = set()
    for a in range(n):
        differ = simhash ^ simhash[a]
        agree = np.array([line_dedup._block(differ, k) == 0 for k in range(9)])
        near = (np.bitwise_count(differ) <= line_dedup.BITS) & (100 * np.minimum(size, size[a]) >= 90 * np.maximum(size, size[a]))
        near &= (np.minimum(size, size[a]) < line_dedup.LONG) | (np.bitwise_count(words ^ words[a]) <= line_dedup.WORD_BITS)
        for b in np.flatnonzero(near & (agree.sum(axis=0) >= 2)).tolist():
            if a != b:
                i, j = np.flatnonzero(agree[:, b])[:2].tolist()
                expected.add((1 << i | 1 << j, a))
    assert len(expected) > 300
    assert found == expected if neighbours > n else found > expected


def test_unlike_lines_that_share_keys_are_not_written(spark, monkeypatch):
    rng = random.Random(12)
    written, stored = {}, line_dedup.stored

    def counted(df, name):
        rows = stored(df, name)
        written[name] = written.get(name, 0) + rows.count()
        return rows

    monkeypatch.setattr(line_dedup, "stored", counted)
    stems = ["".join(rng.choices("etaoinshrdlu", k=rng.randrange(2, 9))) for _ in range(2000)]
    data = [(i, " ".join(rng.choices(stems, k=40)), None, None, None) for i in range(1500)]
    data += [(2000 + i, edited(rng, data[i][1], 1), None, None, None) for i in range(20)]
    assert sum(r["n_removed"] for r in line_dedup.report(frame(spark, data)).collect()) >= 18
    assert 36 <= written["line_members"] <= 200  # some 7000 rows of keys are shared


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


@pytest.mark.parametrize("letters", ["ab", "abcdefgh ", "aé漢😀b"])
@pytest.mark.parametrize("percent", [10, 30, 100])
def test_edit_distances_of_many_pairs(letters, percent):
    rng = random.Random(5)
    a, b = ["", "", "a"], ["", "a", ""]
    for _ in range(150):
        a.append("".join(rng.choices(letters, k=rng.randrange(100))))
        other = list(a[-1])
        for _ in range(rng.randrange(2 + len(other) * percent // 60)):
            at = rng.randrange(len(other) + 1)
            other[at : at + rng.randrange(2)] = rng.choices(letters, k=rng.randrange(2))
        b.append("".join(rng.choices(letters, k=rng.randrange(100)) if rng.random() < 0.2 else other))
    expected = [100 * distance(x, y) <= percent * max(len(x), len(y)) for x, y in zip(a, b)]
    assert len(set(expected)) == (1 if percent == 100 else 2)
    assert edits.within(pa.array(a), pa.array(b), percent).tolist() == expected


@pytest.mark.parametrize("similar_share", [0, 30, 100])
def test_rounds_test_every_near_pair_but_those_of_one_component(similar_share):
    """Buckets whose near members are similar in all, some or no pairs; few edges a member and round."""
    rng = np.random.default_rng(similar_share)
    n, mask = 240, 1 << 0 | 1 << 8
    base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    base[:] = base[np.arange(n) // 80]  # three buckets of 80, all members of one near each other
    at = np.array([first for first, _ in line_dedup.BLOCKS[1:8]])
    simhash = base.copy()
    for i in range(n):  # a bit in each of the seven blocks that don't make the key
        simhash[i] ^= np.bitwise_or.reduce(np.uint64(1) << (at + rng.integers(0, 7, 7)).astype(np.uint64)) if i % 80 % 8 else np.uint64(0)
    bucket = (np.arange(n) // 80) << 9 | mask
    node = rng.permutation(n)
    size = rng.choice([100, 109, 111, 112, 130], n)
    pairs, expected = {}, set()
    for i in range(n):
        for j in range(i):
            differ = simhash[i] ^ simhash[j]
            agree = sum(int(line_dedup._block(differ, k) == 0) << k for k in range(9))
            two = sorted(k for k in range(9) if agree >> k & 1)[:2]
            near = bucket[i] == bucket[j] and np.bitwise_count(differ) <= line_dedup.BITS and two == [0, 8]
            if near and 100 * min(size[i], size[j]) >= 90 * max(size[i], size[j]):
                pair = (int(min(node[i], node[j])), int(max(node[i], node[j])))
                pairs[pair] = (pair[0] * 7 + pair[1] * 13) % 100 < similar_share
    parent = list(range(n))

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for (i, j), alike in pairs.items():
        if alike:
            parent[root(i)] = root(j)
    expected = [root(x) for x in range(n)]
    parent, tested, rounds = list(range(n)), set(), 0
    table = pa.table({"bucket": bucket, "node": node, "simhash": simhash.view(np.int64), "words": np.zeros(n, np.int64), "size": size.astype(np.int32), "reach": np.zeros(n, np.int64)})
    while len(table):
        edges = line_dedup.EDGES[min(rounds, 2)]
        labelled = table.append_column("component", pa.array([root(x) for x in table["node"].to_pylist()], pa.int64()))
        given = line_dedup._offered(edges)(labelled)
        offered = {(r["node"], r["other"]) for r in given.filter(pc.is_valid(given["other"])).to_pylist()}
        # Both members of a pair at one distance may give it, and each looks both ways at once.
        assert offered <= set(pairs) and len(offered) <= (edges + 1) * len(table)
        for i, j in offered:
            if pairs[i, j]:
                parent[root(i)] = root(j)
        tested |= offered
        table = given.filter(pc.is_null(given["other"])).drop_columns("other")
        rounds += 1
        assert rounds < 20
    assert len(pairs) > 300
    assert [root(x) == root(y) for x in range(n) for y in range(x)] == [expected[x] == expected[y] for x in range(n) for y in range(x)]
    assert all(p in tested or root(p[0]) == root(p[1]) for p in pairs)
    assert similar_share < 100 or len(tested) <= 3 * n  # not the square of a group's size


def test_links_do_not_join_members_of_a_bucket_to_each_other(spark, monkeypatch):
    """No bucket is joined to itself, however many of its lines are near and unlike."""
    written, stored = {}, line_dedup.stored

    def counted(df, name):
        plan = df._jdf.queryExecution().toString()
        assert not re.search(r"Join.*bucket", plan), name
        rows = stored(df, name)
        written.setdefault(name, []).append(rows.count())
        return rows

    monkeypatch.setattr(line_dedup, "stored", counted)
    rng = random.Random(14)
    line = sentence(rng, 60)
    data = [(i, edited(rng, line, 1) if i else line, None, None, None) for i in range(120)]
    assert sum(r["n_removed"] for r in line_dedup.report(frame(spark, data)).collect()) >= 108
    assert written["line_edges"] and written["line_edges"][0] <= 3 * written["line_members"][0]


def test_line_of_no_text_at_all(spark):
    assert line_dedup.report(frame(spark, [])).collect() == []


def test_empty_tables(spark):
    empty = frame(spark, [], DOCS)
    assert exact_dedup.report(empty).collect() == []
    assert near_dedup.components(empty).collect() == []
    assert exact_dedup.without_copies(empty).columns == empty.columns
    assert near_dedup.one_per_group(empty).columns == empty.columns
