"""Quality rules as a short-circuit cascade, in built-in functions alone.

Base figures are computed for every text; texts that fail the base conditions are rejected. The
others meet :func:`rules` one after another until one rejects them, which is one CASE expression:
no later rule is evaluated. The order is chosen on a sample of about ``SAMPLE`` rows from all over
the table. Each rule's cost is its work there, counted and not timed: one comparison, and for a
pattern the characters it reads and the matches it stops at. Its selectivity is what it rejects.
Both are those of the rows that the rules before it left; the next rule is always the one that
rejects most per cost. A text is kept if no rule rejects it, so the order changes the time and
never the result.

Defined results. Null text has no words and no lines. A word is a run of characters other than
space and 0x09-0x0D. Windows of five words are compared by 64-bit hashes. Only doc_id and text
are read; an empty table gives an empty result, with the rules in their written order.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from debtlens.llm.scratch import stored

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 5
#: Rows on which costs and selectivities are estimated; they decide the order of rules only.
SAMPLE = 1000
#: A table of more files is sampled in about this many of them, spread by a hash of their paths.
FILES = 32

#: The patterns whose matches some rules count in the text.
PATTERNS = {"capitals": r"\p{Lu}", "exclamations": "!", "letters": r"\p{L}"}


def _count(pattern: str) -> Column:
    return F.regexp_count("t", F.lit(pattern))


def rules() -> dict[str, Column]:
    """What each rule rejects, on the columns of :func:`figures` and the text ``t``."""
    return {
        "symbols": 100 * F.col("n_symbols") > 20 * F.col("n_words"),
        "duplicate_lines": (F.col("n_dup_lines") >= 3) & (100 * F.col("n_dup_lines") > 30 * F.col("n_lines")),
        "word_length": (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 20 * F.col("n_words")),
        "capitals": 100 * _count(PATTERNS["capitals"]) > 40 * F.col("word_chars"),
        "exclamations": 100 * _count(PATTERNS["exclamations"]) > 50 * F.col("n_words"),
        "letters": 100 * _count(PATTERNS["letters"]) < 50 * F.col("word_chars"),
    }


def figures(docs: DataFrame) -> DataFrame:
    """doc_id, the text ``t``, n_words, the base figures, n_lines and base_failed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("t"))
    df = df.select("*", F.array_remove(F.split("t", SPACE), "").alias("words"))
    # Each step is a projection of its own: what a lambda reads again and again is a column then.
    df = df.select(
        "doc_id",
        "t",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        _count("[#*$%&|<>]").cast("long").alias("n_symbols"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"),
    )
    # Neighbours are zipped, not looked up in a lambda: then a filter that Spark moves below these
    # projections costs a few evaluations of an array and not one per element.
    shifted = F.arrays_zip("h", *(F.slice("h", k + 1, F.greatest(F.size("h"), F.lit(1))) for k in range(1, WINDOW)))
    whole = F.slice(shifted, 1, F.greatest(F.size("h") - WINDOW + 1, F.lit(0)))
    df = df.select(
        "doc_id", "t", "n_words", "word_chars", "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform(whole, lambda w: F.xxhash64(w["h"], *(w[str(k)] for k in range(1, WINDOW)))).alias("g"),
    )
    figures_so_far = ["doc_id", "t", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    # Most texts repeat no window; only the others are sorted.
    repeats = F.size(F.array_distinct("g")) < F.size("g")
    placed = F.sort_array(F.transform("g", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    df = df.select(*figures_so_far, F.when(repeats, placed).alias("s"))
    none = F.array(F.lit(None).cast("struct<x:bigint,i:int>"))
    beside = F.arrays_zip("s", F.slice("s", 2, F.greatest(F.size("s"), F.lit(1))), F.concat(none, "s"))
    same = lambda e: (e["s"]["x"] == e["1"]["x"]) | (e["s"]["x"] == e["2"]["x"])
    places = F.array_compact(F.transform(beside, lambda e: F.when(same(e), e["s"]["i"])))
    df = df.select(*figures_so_far, F.sort_array(places).alias("p"))
    # A repeated window adds its words up to the next repeated window.
    after = F.arrays_zip("p", F.slice("p", 2, F.greatest(F.size("p"), F.lit(1))))
    adds = F.transform(after, lambda e: F.least(F.lit(WINDOW), F.coalesce(e["1"] - e["p"], F.lit(WINDOW))))
    df = df.select(
        *figures_so_far,
        F.coalesce(F.aggregate(adds, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return df.withColumn("base_failed", failed)


def work(name: str) -> Column:
    """What a rule costs on a row: a comparison, the characters its pattern reads and its matches."""
    if name not in PATTERNS:
        return F.lit(1).cast("long")
    return (1 + F.length("t") + _count(PATTERNS[name])).cast("long")


def spread(docs: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` rows from all over ``docs``; of a table of many files, only some are read."""
    files = len(docs.inputFiles())
    if files > FILES:
        path = F.xxhash64(F.col("_metadata.file_path"))
        try:
            docs = docs.where(F.pmod(path, F.lit(math.ceil(files / FILES))) == 0)
        except AnalysisException:  # not the rows of files as they are: all of them are read
            pass
    total = docs.count()
    return docs if total <= rows else docs.sample(fraction=rows / total, seed=1)


def ordered(docs: DataFrame, sample: int = SAMPLE) -> list[str]:
    """The rules, the one that rejects most per cost first; of equals the cheapest, then as written."""
    every = rules()
    rows = stored(figures(spread(docs, sample)), "rules_sample").where("NOT base_failed")
    # At most a row for each combination of verdicts.
    left = (
        rows.groupBy(*(rule.alias(name) for name, rule in every.items()))
        .agg(F.count(F.lit(1)).alias("rows"), *(F.sum(work(name)).alias(f"work_{name}") for name in every))
        .collect()
    )
    order: list[str] = []
    while len(order) < len(every):

        def worth(name: str) -> tuple[float, int]:
            cost = sum(r[f"work_{name}"] for r in left)
            return (sum(r["rows"] for r in left if r[name]) / max(cost, 1), -cost)

        order.append(max((name for name in every if name not in order), key=worth))
        left = [r for r in left if not r[order[-1]]]
    return order


def report(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, n_words, the base figures, base_failed and kept of every row."""
    every = rules()
    verdict = reduce(lambda case, name: case.when(every[name], False), ordered(docs, sample), F.when(F.col("base_failed"), False))
    return figures(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        verdict.otherwise(True).alias("kept"),
    )
