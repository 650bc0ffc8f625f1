"""Small tables with everything that may go wrong in one."""

from __future__ import annotations

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that the operators use inside, here with values of their own.
CLASHES = "row string, block string, kept string, mid string, key string, node string, tokens string, _row string"


def sentence(rng: random.Random, n: int) -> str:
    stems = ["the", "river", "over", "house", "Étude", "schön", "light", "3rd", "and", "of", "stone", "paper", "night"]
    return " ".join(rng.choice(stems) + rng.choice(["", "", "ing", "er", "s", ",", "."]) + str(rng.randrange(99)) for _ in range(n))


def edited(rng: random.Random, text: str, n: int) -> str:
    words = text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


def texts(seed: int = 5) -> list[str | None]:
    rng = random.Random(seed)
    base = [sentence(rng, rng.choice([3, 12, 60, 150])) for _ in range(40)]
    out: list[str | None] = [None, None, "", "", "   ", "\n \t\n", "a", "A", "É", "é", "one two three four", "One two  three four"]
    out += base + base[:6] * 3 + [b.upper() for b in base[:4]]
    out += [edited(rng, base[k], e) for k in range(40) if len(base[k]) > 600 for e in (1, 1, 2, 3)]
    out += ["word " * 3000, sentence(rng, 20_000), "x" * 50_000, "a b  c", "<|endoftext|> <|startoftext|>x", "nul\x00l"]
    out += ["\n".join([base[1], base[2], "Shared line of the site.", base[3]]), "Shared line of the site.\n\nshared line of THE site!\nown"]
    return out


def rows(seed: int = 5) -> list[tuple]:
    """Documents: ids in no order, some null, some repeated with equal and with other texts."""
    rng = random.Random(seed)
    every = texts(seed)
    ids = list(range(0, 7 * len(every), 7))
    rng.shuffle(ids)
    out = [(i, t, "en", rng.choice(["a", "a", "a", "b", "c", None]), None) for i, t in zip(ids, every)]
    out += [out[20], out[20], (out[21][0], "another text under the same id", "en", "b", 5)]
    out += [(None, "no id", "en", "a", 1), (None, every[15], None, "a", 1), (None, None, None, None, None)]
    return out


def frame(spark, data, schema: str = DOCS, clashes: bool = True):
    df = spark.createDataFrame(data, schema)
    if clashes:
        for column in CLASHES.split(", "):
            name, kind = column.split(" ")
            df = df.selectExpr("*", f"'clash' AS {name}")
    return df.repartition(3)


_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lower(text: str | None) -> str:
    return (text or "").translate(_LOW)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


class Groups:
    """Union of sets by their least member."""

    def __init__(self):
        self.up: dict = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
