"""Classifier, rules, extraction, mixing and the pipeline."""

import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from messy import DOCS, frame, rows, sentence, words

from debtlens.llm import html_text, mixing, quality, rules

# --- classifier -------------------------------------------------------------------------


def corpus(n: int = 400, seed: int = 1):
    """Prose, and junk of three kinds; every word is new, so only shapes and repeats tell."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 9)))
    docs, labels = [], []
    for i in range(n):
        good = rng.random() < 0.6
        own = [word() for _ in range(rng.randrange(20, 120))]
        kind = rng.randrange(3)
        if not good:
            own = [[w.upper() + "!!" for w in own], [w + "&&&" for w in own], [own[0]] * len(own)][kind]
        docs.append((i, " ".join(own), "en", "a", None))
        labels.append((i, int(good), 0))
    return docs, labels


LABELS = "doc_id long, quality int, toxic int"


def test_classifier_on_held_out_rows(spark):
    docs, labels = corpus()
    found = quality.report(frame(spark, docs), spark.createDataFrame(labels, LABELS)).collect()
    truth = {i: q for i, q, _ in labels}
    assert len(found) == len(docs)
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    held = [r for r in found if r["held_out"]]
    assert len(held) > 60
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)


def shape(word):
    """Runs of one kind of byte as one byte."""
    kinds = ["A" if 65 <= c < 91 else "a" if 97 <= c < 123 else "0" if 48 <= c < 58 else "x" if c > 127 else chr(c) for c in word.encode()]
    return "".join(k for k, _ in itertools.groupby(kinds))


def ngrams(text):
    """(n-gram, the least text that has it, its place among that text's n-grams)."""
    before = None
    for word in words(text):
        pair, at = (word, 0) if before is None else (f"{before} {word}", 5)
        yield ("word", word), word, 0
        yield ("shape", shape(word)), word, 1
        yield ("pair", before, word), pair, at + 2
        yield ("shapes", before and shape(before), shape(word)), pair, at + 3
        yield ("again", before == word), pair, at + 4
        before = word


def test_scores_by_a_dictionary_of_ngrams(spark):
    """Training and scores once more, one n-gram after another, weights held in dictionaries."""
    docs, labels = corpus(150, seed=4)
    docs += [(1000, None, None, None, None), (1001, "Zwölf Größen, 12 x 3!", None, None, None)]
    known, rows_of = {}, {}
    for doc_id, text, *_ in docs:
        counted = Counter()
        for gram, least, at in ngrams(text or ""):
            if gram not in known:
                known[gram] = int(quality.features(pa.array([least.encode()]))[0][at])
            counted[known[gram]] += 1
        rows_of[doc_id] = {k: quality.SCALE * n / sum(counted.values()) for k, n in counted.items()}
    places = {
        r["doc_id"]: r["place"]
        for r in spark.createDataFrame([(i,) for i, *_ in labels], "doc_id long").selectExpr("doc_id", "xxhash64(doc_id) AS place").collect()
    }
    shards = defaultdict(list)
    for doc_id, label, _ in labels:
        if zlib.crc32(str(doc_id).encode()) % 4 != 2:
            shards[places[doc_id] % quality.SHARDS].append((places[doc_id], label, doc_id))

    def weight(z, n, k):
        root = math.sqrt(n.get(k, 0.0))
        shrunk = math.copysign(max(abs(z.get(k, 0.0)) - quality.L1, 0), z.get(k, 0.0))
        return -shrunk / ((quality.BETA + root) / quality.ALPHA + quality.L2)

    def chance(z, n, row):
        margin = sum(weight(z, n, k) * x for k, x in row.items()) + weight(z, n, "bias")
        return 1 / (1 + math.exp(-margin))

    z, n = {}, {}
    for _ in range(quality.ROUNDS):
        after = []
        for held in shards.values():
            own_z, own_n = dict(z), dict(n)
            for _, label, doc_id in sorted(held):
                error = chance(own_z, own_n, rows_of[doc_id]) - label
                step = {k: (error * x, weight(own_z, own_n, k)) for k, x in [*rows_of[doc_id].items(), ("bias", 1.0)]}
                for k, (slope, w) in step.items():
                    was = own_n.get(k, 0.0)
                    own_n[k] = was + slope * slope
                    own_z[k] = own_z.get(k, 0.0) + slope - (math.sqrt(own_n[k]) - math.sqrt(was)) / quality.ALPHA * w
            after.append((own_z, own_n))
        z, n = ({k: sum(s[part].get(k, 0.0) for s in after) / len(after) for k in {k for s in after for k in s[part]}} for part in (0, 1))
    found = quality.report(frame(spark, docs), spark.createDataFrame(labels, LABELS)).collect()
    assert len(found) == len(docs)
    for r in found:
        assert abs(r["score"] - chance(z, n, rows_of[r["doc_id"]])) < 1e-4
    assert len({round(r["score"], 3) for r in found}) > 20  # they tell texts apart


def test_held_out_labels_are_not_read(spark):
    docs, labels = corpus(200)
    lies = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q, t) for i, q, t in labels]
    df = frame(spark, docs)
    scores = [
        dict(quality.report(df, spark.createDataFrame(own, LABELS)).select("doc_id", "score").collect()) for own in (labels, lies)
    ]
    assert scores[0] == scores[1]


def test_classifier_on_messy_rows(spark):
    docs, labels = corpus(120)
    extra = [(None, 1, 0), (3, None, 0), (5, 0, 0), (5, 1, 0), (5, 1, 1), (10**9, 1, 0)]
    df = frame(spark, docs + [(10**6 + k, *r[1:]) for k, r in enumerate(rows())] + [(None, None, None, None, None)])
    found = quality.report(df, spark.createDataFrame(labels + extra, LABELS)).collect()
    assert len(found) == df.count()
    blank = {r["score"] for r in found if r["doc_id"] is None}
    assert len(blank) == 1 and all(math.isfinite(r["score"]) for r in found)
    kept = quality.accepted(df, spark.createDataFrame(labels, LABELS))
    assert kept.columns == df.columns and 0 < kept.count() < df.count()


def test_nothing_to_learn_from(spark):
    df, none = frame(spark, rows()), spark.createDataFrame([], LABELS)
    assert {r["score"] for r in quality.report(df, none).collect()} == {0.5}
    assert quality.accepted(df, none).count() == df.count()
    assert quality.report(frame(spark, [], DOCS), none).collect() == []


def test_scores_do_not_depend_on_slices():
    texts = pa.array([t.encode() for t in ("a b c", "", "A!! B!!", "c c c c")])
    index, first = quality.features(texts)
    for k in range(4):
        own, _ = quality.features(texts.slice(k, 1))
        assert own.tolist() == index[first[k] : first[k + 1]].tolist()


# --- rules ------------------------------------------------------------------------------


def figures(text):
    w = words(text)
    windows = defaultdict(list)
    for i in range(len(w) - 4):
        windows[tuple(w[i : i + 5])].append(i)
    repeated = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(repeated), len(lines)


def verdict(text, base):
    import regex

    n, chars, symbols, dup, repeat, lines = base
    if n < 10 or 100 * repeat > 20 * n:
        return True, False
    text = text or ""
    bad = [
        100 * symbols > 20 * n,
        dup >= 3 and 100 * dup > 30 * lines,
        chars < 2 * n or chars > 20 * n,
        100 * len(regex.findall(r"\p{Lu}", text)) > 40 * chars,
        100 * text.count("!") > 50 * n,
        100 * len(regex.findall(r"\p{L}", text)) < 50 * chars,
    ]
    return False, not any(bad)


def test_rules(spark):
    rng = random.Random(8)
    data = rows()
    for i in range(60):
        base = [rng.choice("abcdefgh") for _ in range(rng.randrange(30))]  # few words: many repeated windows
        data.append((5000 + i, " ".join(base), None, None, None))
    data += [(6000, "\n".join(["same old line"] * 9), None, None, None), (6001, "X Y\n" * 3 + "a b c d e f g h i j k l m", None, None, None)]
    data += [(6002, sentence(rng, 50).upper(), None, None, None), (6003, "a! " * 5 + sentence(rng, 3), None, None, None)]
    data += [(6004, "# " * 20 + sentence(rng, 60), None, None, None), (6005, " ".join("123456" for _ in range(7)) + " 1 2 3 4", None, None, None)]
    found = rules.report(frame(spark, data)).collect()
    expected = Counter()
    for doc_id, text, *_ in data:
        base = figures(text)
        expected[(doc_id, *base[:5], *verdict(text, base))] += 1
    assert Counter(map(tuple, found)) == expected


def test_order_of_rules(spark):
    import regex

    rng = random.Random(9)
    junk = "".join(f" *{k}#" for k in range(30))
    data = [(i, sentence(rng, 30) + (junk if i % 2 else ""), None, None, None) for i in range(60)]
    data += [(100 + i, sentence(rng, 12).upper(), None, None, None) for i in range(20)]
    data += [(200 + i, " ".join("12345" for _ in range(11 + i)) + sentence(rng, 3), None, None, None) for i in range(7)]
    data += [(300 + i, " ".join(w + "!" for w in words(sentence(rng, 15))), None, None, None) for i in range(5)]
    names = ["symbols", "duplicate_lines", "word_length", "capitals", "exclamations", "letters"]
    left = []
    for _, text, *_ in data:
        n, chars, symbols, dup, repeat, lines = figures(text)
        if n < 10 or 100 * repeat > 20 * n:
            continue
        found = [len(regex.findall(p, text)) for p in (r"\p{Lu}", "!", r"\p{L}")]
        bad = [100 * symbols > 20 * n, dup >= 3 and 100 * dup > 30 * lines, chars < 2 * n or chars > 20 * n]
        bad += [100 * found[0] > 40 * chars, 100 * found[1] > 50 * n, 100 * found[2] < 50 * chars]
        left.append((bad, [1, 1, 1, *(1 + len(text) + f for f in found)]))
    expected = []
    for _ in names:
        gains = {}
        for k in (k for k in range(6) if names[k] not in expected):
            cost = sum(w[k] for _, w in left)
            gains[k] = (sum(b[k] for b, _ in left) / max(cost, 1), -cost, -k)
        best = max(gains, key=gains.get)
        expected.append(names[best])
        left = [(b, w) for b, w in left if not b[best]]
    df = frame(spark, data, clashes=False)
    assert rules.ordered(df) == rules.ordered(df.repartition(3)) == expected
    assert expected[0] == "symbols" and expected[3:] != names[3:]
    assert rules.report(frame(spark, [], DOCS)).collect() == []


def test_sample_of_rules_is_spread(spark, tmp_path):
    df = spark.range(20_000).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    df.repartition(100).write.parquet(str(tmp_path / "many"))
    docs = spark.read.parquet(str(tmp_path / "many"))
    found = rules.spread(docs, 1000).select("doc_id", "_metadata.file_path").collect()
    files = {r["file_path"] for r in found}
    assert 700 < len(found) < 1300 and 10 < len(files) < 70
    some = rules.spread(docs.select("text", "doc_id").distinct(), 1000).collect()
    assert 700 < len(some) < 1300
    # In one file, rows from its whole length.
    df.coalesce(1).write.parquet(str(tmp_path / "one"))
    ids = sorted(r["doc_id"] for r in rules.spread(spark.read.parquet(str(tmp_path / "one")), 500).collect())
    assert ids[0] < 1000 and ids[-1] > 19_000 and 350 < len(ids) < 650


# --- extraction -------------------------------------------------------------------------

PAGES = {
    "": "",
    "<p>One &amp; two&nbsp;three</p>\n<p> Four,\n five. </p>": "One & two three\nFour, five.",
    "<html><head><title>T</title><style>p{}</style></head><body><nav><a>Home</a></nav><article><h1>A title</h1>"
    "<p>Some <b>prose</b>,<br>in one block.<p>Next &eacute;&#233;&#xe9; block<script>var t='</p>';</script></article>"
    "<footer>&copy; me</footer></body></html>": "A title\nSome prose, in one block.\nNext ééé block",
    "<body><div id=sidebar><p>Read this, too. And that.</p></div><main><p>Text.</p><div class='comments'><p>First!</p></div>"
    "<form><p>Your name, please.</p></form></main><div role=contentinfo>x</div>": "Text.",
    "<ul><li>One item, first.<li>Another item, second.</ul><!-- <p>no</p> --><p>Prose, at last; long enough to count.": None,
    "<p>unclosed <b>tags <i>everywhere<p>and </div>stray ends</p></b>": "unclosed tags everywhere\nand\nstray ends",
    "<article><p>cut off in the mid": "cut off in the mid",
    "<article><p>a < b and c</p><p>x<": "a < b and c\nx<",
    '<article><p title="a > b">attr</p><img src="x>y"><p data-ad="1">kept</p></article>': "attr\nkept",
    "<div class=userComments>Nice one, really.</div><div class='lead-in'>The story, as told here.</div>": "The story, as told here.",
    "<table><tr><td>A cell, with text.<td>Another cell, with text.<tr><td>Third cell, too.</table>": None,
    "<article>" + "<div>" * 300 + "deep" + "</div>" * 300 + "</article>": "deep",
}


@pytest.mark.parametrize("page", PAGES)
def test_main_text(page):
    text = html_text.main_text(page)
    if PAGES[page] is not None:
        assert text == PAGES[page]
    assert not any(line != " ".join(line.split()) for line in text.split("\n"))


def test_prose_beats_links_without_marks():
    links = "".join(f"<td><a href=/{i}>Item {i}</a></td>" for i in range(30))
    page = f"<body><table><tr>{links}</tr></table><div><p>{'A sentence of prose, with marks. ' * 9}</p></div>"
    text = html_text.main_text(page)
    assert text.startswith("A sentence") and "Item" not in text


def prose(n: int, seed: int = 3) -> str:
    rng = random.Random(seed)
    return ". ".join(sentence(rng, 12).replace(",", "") + ", and more" for _ in range(n)) + "."


#: Each page is written with its main text between markers that no page has; other text is not in it.
MARKED = [
    # Nothing is marked: ratios alone.
    "<div><ul>{links}</ul></div><section><h2>[[{title}]]</h2><p>[[{a}]]</p><p>[[{b}]]</p></section><div><ul>{links}</ul></div>",
    "<table><tr><td>{links}</td><td><p>[[{a}]]</p><p>[[{b}]]</p></td></tr></table>",
    "<center><p>[[{a}]]</p>{links}<p>[[{b}]]</p></center>",
    # An article that holds lists of links and single words, which the ratios reject.
    "<article><h1>[[{title}]]</h1><p>[[{a}]]</p><ul>{links}</ul><p>[[{b}]]</p></article><div>{links}</div>",
    "<main><p>[[{a}]]</p><table><tr><td>{links}</table><div><p>[[{b}]]</p></div></main>",
    # Part of the text stands outside the article, heavier than that.
    "<article><p>[[{a}]]</p></article><section><dd>[[{b}]]</dd></section><ul>{links}</ul>",
    # A footer longer than the article is a footer.
    "<article><h1>[[{title}]]</h1><p>[[A short one, this time.]]</p></article><footer>{b}</footer>",
]


def _marked() -> list[tuple[str, str]]:
    links = "".join(f"<li><a href='/{i}'>Item {i}</a></li>" for i in range(12))
    out = []
    for page in MARKED:
        page = page.format(links=links, title="What the page is about, in short", a=prose(5), b=prose(6, 4))
        expected = "\n".join(" ".join(x.split("]]")[0].split()) for x in page.split("[[")[1:])
        out.append((page.replace("[[", "").replace("]]", ""), expected))
    return out


@pytest.mark.parametrize("k", range(len(MARKED)))
def test_text_between_markers(k):
    """Against a reading of the markers, not of the markup."""
    page, expected = _marked()[k]
    assert html_text.main_text(page) == expected


def test_ratios_decide(monkeypatch):
    """With the ratios of other paths, most of these pages lose their text."""
    real = html_text._weights
    monkeypatch.setattr(html_text, "_weights", lambda paths: real(paths)[::-1])
    changed = [html_text.main_text(page) != expected for page, expected in _marked()]
    assert sum(changed) >= 5
    monkeypatch.setattr(html_text, "_weights", lambda paths: np.ones(len(paths)))
    assert sum(html_text.main_text(page) != expected for page, expected in _marked()) >= 4


def test_many_broken_tags_take_linear_time():
    import time

    for page in ("<" * 200_000, "<a '" * 50_000, "<p>" * 50_000, "<!--" * 50_000, "</b" * 50_000, "<title>" * 50_000, "&" * 200_000):
        start = time.perf_counter()
        html_text.main_text(page)
        assert time.perf_counter() - start < 20, page[:10]


def test_pages(spark):
    data = [(i, f"u{i}", page) for i, page in enumerate(PAGES)] + [(None, None, None), (7, "u", "<p>again.</p>"), (7, "u", "<p>again.</p>")]
    found = html_text.extract(spark.createDataFrame(data, "page_id long, url string, html string").selectExpr("*", "1 AS text")).collect()
    expected = Counter((i, u, html_text.main_text(h), len(html_text.main_text(h))) for i, u, h in data)
    assert Counter(map(tuple, found)) == expected
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


# --- mixing -----------------------------------------------------------------------------


def test_exponents():
    shares = {"a": 0.5, "b": 0.3, "c": 0.2}
    a = mixing.exponent_for(shares, most_repeats=1.5)
    assert abs(mixing.repeats(shares, a) - 1.5) < 1e-6
    target = (math.log(3) + mixing.entropy(shares)) / 2
    a = mixing.exponent_for(shares, target_entropy=target)
    assert abs(mixing.entropy(mixing.weights(shares, a)) - target) < 1e-9
    assert mixing.exponent_for(shares, most_repeats=1.0) == pytest.approx(1.0)
    assert mixing.exponent_for({"a": 1.0}, most_repeats=2.0) == 0.0
    assert mixing.exponent_for(shares, most_repeats=100) == 0.0


def tokens(text):
    return len(words(text)) + 1


def check_readings(readings, data, quotas):
    """readings: (index into data, epoch, place_block, place)."""
    by = defaultdict(list)
    for i, epoch, block, place in readings:
        by[data[i][3]].append((epoch, block, place, i))
    for source, quota in quotas.items():
        own = [i for i, r in enumerate(data) if r[3] == source]
        total = sum(tokens(data[i][1]) for i in own)
        held = sorted(by[source])
        epochs = Counter(e for e, *_ in held)
        for epoch in range(quota // total):
            assert sorted(i for e, _, _, i in held if e == epoch) == own
        last = [i for e, _, _, i in held if e == quota // total]
        assert len(set(last)) == len(last) and max(epochs, default=0) <= quota // total
        read = sum(tokens(data[i][1]) for _, _, _, i in held)
        assert read >= quota
        if last:  # without its last document the quota would not be met
            assert read - tokens(data[last[-1]][1]) < quota
        else:
            assert read == quota


@pytest.mark.parametrize("budget", [None, 40, 20_000, 3_000_000])
def test_readings(spark, monkeypatch, budget):
    monkeypatch.setattr(mixing, "BLOCK", 4)
    data = rows()
    tagged = [(*r, i) for i, r in enumerate(data)]
    df = frame(spark, tagged, DOCS + ", at int")
    totals = defaultdict(int)
    for r in data:
        totals[r[3]] += tokens(r[1])
    chosen = mixing.plan(dict(totals), budget=budget)
    found = mixing.mixed(df, budget=budget, carry=["at"]).select("row.at", "epoch", "place_block", "place", "weight", "source").collect()
    check_readings([(r["at"], r["epoch"], r["place_block"], r["place"]) for r in found], data, chosen.quotas)
    assert all(r["weight"] == pytest.approx(chosen.weights[r["source"]]) for r in found)
    if budget is None:
        assert {r["at"] for r in found} == set(range(len(data)))


@pytest.mark.parametrize("budget", [None, 5_000, 900_000])
def test_readings_do_not_depend_on_the_split(spark, monkeypatch, budget):
    monkeypatch.setattr(mixing, "BLOCK", 8)
    data = rows() + [(7, "one text in many equal rows", "en", "c", None)] * 300
    found = []
    for df in (frame(spark, data), frame(spark, data[::-1]).repartition(7), frame(spark, data).coalesce(1)):
        found.append(Counter(map(tuple, mixing.mixed(df, budget=budget).select("row", "epoch", "place_block", "place").collect())))
    assert found[0] == found[1] == found[2] and sum(found[0].values()) > 0
    totals, read = Counter(), Counter()
    for r in data:
        totals[r[3]] += tokens(r[1])
    for (row, *_), n in found[0].items():
        read[row["source"]] += n * tokens(row["text"])
    for source, quota in mixing.plan(dict(totals), budget=budget).quotas.items():
        longest = max(tokens(r[1]) for r in data if r[3] == source)
        assert quota <= read[source] < quota + longest


def test_a_quota_that_ends_among_equal_rows(spark):
    data = [(1, "a b c", "en", "only", None)] * 1000  # four tokens each
    df = frame(spark, data).repartition(5)
    for budget, most in ((2, 1), (401, 101), (4000, 1000), (4001, 1001), (9999, 2500)):
        assert mixing.mixed(df, budget=budget).count() == most


def test_one_source_is_read_once(spark):
    data = [(i, "some words here", None, "only", None) for i in range(30)]
    df = frame(spark, data)
    assert mixing.rebalanced(df).columns == df.columns
    assert mixing.report(df).count() == 30
    assert mixing.report(frame(spark, [], DOCS)).collect() == []
    assert mixing.rebalanced(frame(spark, [], DOCS)).collect() == []


# --- pipeline ---------------------------------------------------------------------------


def test_pipeline(spark, tmp_path):
    docs, labels = corpus(300)
    rng = random.Random(3)
    good = [d for d, (_, q, _) in zip(docs, labels) if q]
    copies = [(10_000 + i, d[1].upper().lower(), "en", "b", None) for i, d in enumerate(good[:20])]
    near = []
    for i, d in enumerate(d for d in good if len(words(d[1])) >= 100):
        w = words(d[1])
        w[rng.randrange(len(w))] = "changed"
        near.append((20_000 + i, " ".join(w), "en", "b", None))
    every = docs + copies + near
    frame(spark, every, clashes=False).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{tmp_path}/labels.parquet")

    found, kept = {}, spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = kept.columns
    for name, stage in corpus_pipeline.STAGES:
        kept = corpus_pipeline.stored(stage(spark, kept, str(tmp_path)), "test_stage")
        found[name] = kept
        assert name == "best_fit_packing" or kept.columns == columns
    ids = {name: Counter(r["doc_id"] for r in df.select("doc_id").collect()) for name, df in found.items()}
    truth = {i: q for i, q, _ in labels}
    accepted = ids["quality_classifier"]
    assert sum(truth[d[0]] == (d[0] in accepted) for d in docs) >= 0.97 * len(docs)
    texts = {d[0]: d[1] for d in every}
    # Of equal texts the largest id stays.
    assert set(ids["exact_dedup"]) == set({texts[i]: i for i in sorted(accepted)}.values())
    from test_llm_dedup import near as linked

    stays = {k[0] for k in linked([(i, texts[i]) for i in ids["exact_dedup"]]) if k[3]}
    assert set(ids["near_dedup"]) == stays and len(stays) < len(ids["exact_dedup"])
    assert set(ids["source_mixing"]) == stays and max(ids["source_mixing"].values()) <= 2
    assert set(ids["best_fit_packing"]) == stays
    whole = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "piece", "start", "length", "ids_crc32")
    assert Counter(map(tuple, whole.collect())) == Counter(
        map(tuple, found["best_fit_packing"].select("doc_id", "piece", "start", "length", "ids_crc32").collect())
    )
