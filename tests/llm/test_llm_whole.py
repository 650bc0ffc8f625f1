"""Whole results, against brute force that knows nothing of how they are found."""

import random
from collections import Counter

import corpus_pipeline
import pyarrow as pa
import pytest
from messy import edited, frame, sentence
from pyspark.sql import functions as F
from test_llm_dedup import near, normal, similar

from debtlens.llm import html_text, line_dedup, mixing, near_dedup


def test_similar_lines_go_whatever_their_simhash(spark):
    rng = random.Random(8)
    stems = ["".join(rng.choices("etaoinshrdlu", k=rng.randrange(2, 9))) for _ in range(2000)]
    data, copies = [], {}
    for i in range(100):
        line = rng.choices(stems, k=15 + i // 3)
        copy = line.copy()
        copy[rng.randrange(len(copy))] = rng.choice(stems)
        data += [(i, " ".join(line), None, None, None), (1000 + i, " ".join(copy), None, None, None)]
        a, b = normal(" ".join(line)), normal(" ".join(copy))
        copies[1000 + i] = similar(a, b)
    left = dict(line_dedup.report(frame(spark, data)).select("doc_id", "text").collect())
    close = [i for i, one in copies.items() if one]
    assert len(close) >= 50
    assert sum(left[i] == "" for i in close) >= 0.9 * len(close)
    assert all(left[i] == text for i, text, *_ in data if i not in close)


def test_the_stage_drops_near_copies_from_a_similarity_of_80_percent(spark):
    w = [f"w{i}" for i in range(204)]
    # 200 shingles each; of n other words at the end 200 - n are shared: 178 of 222 are 80.2 percent.
    data = [(9, w), (10, w[:182] + [f"x{i}" for i in range(22)]), (11, w[:181] + [f"y{i}" for i in range(23)])]
    df = frame(spark, [(i, " ".join(words), None, None, None) for i, words in data])
    kept = corpus_pipeline.drop_near_copies(spark, df, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [9, 11]
    assert near_dedup.components(df).where("kept").count() == 3


STORY = "".join(f"<p>Paragraph {i} of the story, told at some length; it has commas, and ends here.</p>" for i in range(4))
FRAMES = [
    "<div class='content-sidebar-wrap'><main>{}</main><aside><p>Aside, a word.</p></aside></div>",
    "<nav>Home, there</nav><div class='has-sidebar'>{}<div class=sidebar><p>Read this, too.</p></div></div><footer>(c) 2020</footer>",
    "<main class='with-comments'>{}<div class='comments'><p>First, of all!</p></div></main>",
    "<article class='related-story'>{}<article class='comment'><p>First, of all!</p></article></article>",
    "<form action='/'>{}<footer>Imprint, and more.</footer></form>",
    "<div class='sidebar'><article>{}</article></div><div>" + "<p>Other text, of the page; as long as the story, or longer. </p>" * 9 + "</div>",
    "<main>{}</main><aside class='related'><article><p>Another story, in short.</p></article></aside>",
    "<p>Tip.</p><div class='header'>{}</div>",
    "<div class='widget'>{}</div><div class='widget'>{}</div>",
]


@pytest.mark.parametrize("frame", FRAMES)
def test_articles_in_frames_with_names(frame):
    story = STORY.replace("</p><p>", "\n")[3:-4]
    text = html_text.main_text(f"<html><body>{frame.replace('{}', STORY)}</body></html>")
    assert text.replace("Tip.\n", "") == "\n".join([story] * frame.count("{}"))


def test_lengths_of_lines_are_counted_in_characters():
    line = "abcdefghij" * 10
    wide = line[:90] + "漢字文章段落行列語句"  # an edit similarity of 0.9, but 120 bytes
    assert line_dedup.sketch(pa.array([line, wide, None, "É, 1 é!\n\nx"]))[4].tolist() == [100, 100, 5, 1]
    assert line_dedup.sketch(pa.array(["", None]))[4].tolist() == []


def test_documents_with_several_texts_link_through_each(spark):
    rng = random.Random(7)
    a, b, c = (sentence(rng, 80) for _ in range(3))
    data = [(1, a), (1, b), (1, ""), (3, edited(rng, b, 1)), (4, edited(rng, a, 1)), (4, "  "), (4, c), (6, edited(rng, c, 1))]
    data += [(7, c + " more"), (7, a.upper()), (8, "alone"), (8, None), (9, None), (9, "")]
    data = [(i, text, None, None, None) for i, text in data]
    found = near_dedup.components(frame(spark, data)).collect()
    assert Counter(map(tuple, found)) == near(data)
    assert {r["doc_id"] for r in found if r["component_id"] == 1} == {1, 3, 4, 6, 7}


@pytest.mark.parametrize("wanted", [{"most_repeats": 1.5}, {"target_entropy": 0.9}, {"most_repeats": 3.0, "budget": 12_345}])
def test_weights_and_quotas_over_a_table(spark, wanted):
    totals = {"a": 50_000, "b": 3_000, "c": 700, None: 11, "": 11}
    expected = mixing.plan(totals, **wanted)
    found = mixing.planned(spark.createDataFrame(list(totals.items()), "source string, total long"), **wanted).collect()
    assert {r["source"]: r["quota"] for r in found} == expected.quotas
    assert {r["source"]: r["weight"] for r in found} == pytest.approx(expected.weights)


def test_more_sources_than_are_broadcast(spark):
    n = mixing.FEW_SOURCES + 7
    df = spark.range(n).selectExpr("id AS doc_id", "'three words here' AS text", "nullif(cast(id AS string), '5') AS source")
    df = df.unionByName(spark.range(n, n + 5000).selectExpr("id AS doc_id", "'three words here' AS text", "'large' AS source"))
    found = mixing.report(df)
    # All but the largest source owe one and a half times their tokens: their one document is read twice.
    times = found.groupBy("doc_id", "source").count().groupBy(F.expr("source <=> 'large'").alias("large"), "count").count()
    assert Counter(map(tuple, times.collect())) == Counter([(False, 2, n), (True, 1, 5000)])
