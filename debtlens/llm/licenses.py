"""License scans: phrases, and an exact set-similarity join of text blocks with license templates.

1. Base labels come from ``PHRASES``: places where a phrase's words stand consecutively.
2. Blocks are windows of 2^k words that start at every half of their width. A template's family has
   the least width of 2.5 times its longest template: any passage up to a quarter longer than the
   template lies whole in a window.
3. A block meets a template if it holds enough of the template's distinct words: ``PERCENT`` of
   them, and all of a template with fewer than ``WHOLE``. All such pairs are found by an
   exact join: the words of all templates are ordered by their occurrences in all documents,
   rarest first. With ``n`` words in a template and ``o`` needed, a block that meets it holds one of
   its first n - o + 1 words (prefix filter), holds ``o`` words of templates at all (length
   filter), and after the first common word both have enough left (positional filter). What is left
   is counted.
4. A text gets the label of the template of largest containment in each family, of equal ones the
   one with most words: the text of a narrower license holds that of the wider one.

Templates are a fixed list of this module, so they go to every task; texts stay where they are
read. Only the few hundred counts of template words are shuffled.

Defined results. Words are runs of digits, letters a-z and characters beyond ASCII once A-Z are lower-case. A
null or empty text has no words, null places, empty labels and the score 0. The score is 1
if a phrase stands in the text, otherwise the largest containment of a template met, else 0. Every
row is scanned by itself, so ids may be null or repeated; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from debtlens.llm import runs
from debtlens.llm import words as W
from debtlens.llm.lexical import term_hashes
from debtlens.llm.scratch import stored
from debtlens.llm.ship import ship

PERCENT, WHOLE = 80, 12

# Phrases with their labels, and the public wording of license notices.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
#: (family, label, text)
TEMPLATES = (
    ("mit grant", "mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("mit notice", "mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit disclaimer", "mit", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY"),
    ("isc", "isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("bsd", "bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd endorsement", "bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("apache notice", "apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache disclaimer", "apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("gnu notice", "gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gnu notice", "lgpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gnu notice", "agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("mpl", "mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("epl", "epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("boost", "boost", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software"),
    ("zlib", "zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely"),
    ("unlicense", "unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("cc0", "cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("ofl", "ofl", "This Font Software is licensed under the SIL Open Font License, Version 1.1."),
    ("cc", "cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc", "cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc", "cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc", "cc-by-nd", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    ("cc", "cc-by-nc-sa", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    ("cc", "cc-by-nc-nd", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
    ("cc short", "cc-by", "Licensed under CC BY 4.0"),
    ("cc short", "cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc short", "cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc short", "cc-by-nd", "Licensed under CC BY-ND 4.0"),
    ("cc short", "cc-by-nc-sa", "Licensed under CC BY-NC-SA 4.0"),
    ("cc short", "cc-by-nc-nd", "Licensed under CC BY-NC-ND 4.0"),
)
# End of the fixed values.


@dataclass(frozen=True)
class Template:
    family: str
    label: str
    words: tuple[str, ...]
    width: int

    @property
    def needed(self) -> int:
        n = len(set(self.words))
        return n if n < WHOLE else -(-PERCENT * n // 100)


def _cut(text: str) -> tuple[str, ...]:
    data = text.encode()
    starts, ends, _ = runs.found(runs.TERM[np.frombuffer(data, np.uint8)], np.array([0, len(data)]))
    low = W.LOWER[np.frombuffer(data, np.uint8)].tobytes()
    return tuple(low[a:b].decode() for a, b in zip(starts, ends))


@lru_cache(maxsize=1)
def templates() -> tuple[Template, ...]:
    """All templates, those of a family with one width."""
    cut = [(family, label, _cut(text)) for family, label, text in TEMPLATES]
    longest = {f: max(len(words) for g, _, words in cut if g == f) for f, _, _ in cut}
    return tuple(Template(f, label, words, 1 << (5 * longest[f] // 2 - 1).bit_length()) for f, label, words in cut)


@lru_cache(maxsize=1)
def vocabulary() -> tuple[str, ...]:
    """The distinct words of templates and phrases."""
    return tuple(sorted({w for t in templates() for w in t.words} | {w for p, _ in PHRASES for w in p.split()}))


def _hashed(words) -> np.ndarray:
    return term_hashes(pa.array(list(words)))[0]


SKETCH = (
    "doc_id long, n_words long, places array<int>, words array<smallint>, base array<struct<label:string,start:long>>"
)
FOUND = (
    "doc_id long, n_words long, base array<struct<label:string,start:long>>,"
    " found array<struct<family:string,label:string,start:long,width:int,containment:double>>"
)


def _base(number: np.ndarray, first: np.ndarray, vocabulary: tuple[str, ...]) -> list[list[dict]]:
    """For each text where phrases stand, with their labels; ``number`` has each word's place in the
    vocabulary, -1 for others."""
    out: list[list[dict]] = [[] for _ in range(len(first) - 1)]
    for phrase, label in PHRASES:
        parts = [vocabulary.index(w) for w in phrase.split()]
        n = len(number) - len(parts) + 1
        if n <= 0:
            continue
        at = np.ones(n, bool)
        for k, part in enumerate(parts):
            at &= number[k : k + n] == part
        at = np.flatnonzero(at)
        text = np.searchsorted(first, at, "right") - 1
        inside = at + len(parts) <= first[text + 1]
        for t, a in zip(text[inside].tolist(), at[inside].tolist()):
            out[t].append({"label": label, "start": int(a - first[t])})
    return out


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = vocabulary()
    hashes = _hashed(words)
    order = np.argsort(hashes)
    for batch in batches:
        texts = batch.column("text")
        for a, b in W.slices(texts):
            held, first = term_hashes(texts.slice(a, b - a))
            at = np.minimum(np.searchsorted(hashes[order], held), len(words) - 1)
            number = np.where(hashes[order][at] == held, order[at], -1)
            known = np.flatnonzero(number >= 0)
            cuts = pa.array(np.searchsorted(known, first).astype(np.int32))
            text = np.searchsorted(first, known, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(a, b - a),
                    pa.array(np.diff(first).astype(np.int64)),
                    pa.ListArray.from_arrays(cuts, pa.array((known - first[text]).astype(np.int32))),
                    pa.ListArray.from_arrays(cuts, pa.array(number[known].astype(np.int16))),
                    pa.array(_base(number, first, words), pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))),
                ],
                names=["doc_id", "n_words", "places", "words", "base"],
            )
    W.trim()


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(len(vocabulary()), np.int64)
    for batch in batches:
        counts += np.bincount(batch.column("words").flatten().to_numpy(), minlength=len(counts))
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(counts), dtype=np.int32)), pa.array(counts)], names=["word", "n"])


class Join:
    """The templates against many blocks at once, by the order of their words."""

    def __init__(self, counts: np.ndarray):
        words = vocabulary()
        self.rank = np.empty(len(words), np.int64)  # rarest first, equal ones by the word
        self.rank[np.argsort(counts, kind="stable")] = np.arange(len(words))
        self.templates = templates()
        place = {w: i for i, w in enumerate(words)}
        self.member = np.zeros((len(self.templates), len(words)), bool)
        self.size = np.empty(len(self.templates), np.int64)
        self.needed = np.array([t.needed for t in self.templates])
        #: By width: (rank, template, place in the template) of all words of prefixes.
        self.prefixes: dict[int, list[tuple[int, int, int]]] = {}
        for k, t in enumerate(self.templates):
            ranks = sorted(int(self.rank[place[w]]) for w in set(t.words))
            self.member[k, ranks] = True
            self.size[k] = len(ranks)
            for i, rank in enumerate(ranks[: len(ranks) - t.needed + 1]):
                self.prefixes.setdefault(t.width, []).append((rank, k, i))

    def found(self, text: np.ndarray, places: np.ndarray, words: np.ndarray, sizes: np.ndarray) -> Iterator[tuple]:
        """(text, template, start, words in common) of every window and template that meet.

        ``text``, ``places`` and ``words`` have a row per occurrence of a vocabulary word, ``sizes``
        the number of words of every text.
        """
        ranks = self.rank[words]
        for width, prefixes in self.prefixes.items():
            step = width // 2
            windows = np.maximum(-(-sizes // step) - 1, 1)
            base = np.concatenate([[0], np.cumsum(windows)])
            last = places // step
            own = np.concatenate([last, last - 1])
            doc = np.concatenate([text, text])
            inside = (own >= 0) & (own < windows[doc])
            block = base[doc[inside]] + own[inside]
            # A block's distinct words in the global order.
            keys = np.unique(block * len(self.rank) + np.concatenate([ranks, ranks])[inside])
            block, rank = keys // len(self.rank), keys % len(self.rank)
            starts = np.flatnonzero(np.diff(block, prepend=-1))
            held = np.diff(starts, append=len(block))
            of = np.repeat(np.arange(len(starts)), held)
            j = np.arange(len(block)) - starts[of]
            by_rank = np.argsort(rank, kind="stable")
            cuts = np.searchsorted(rank[by_rank], np.arange(len(self.rank) + 1))
            pairs = []
            for r, k, i in prefixes:
                at = by_rank[cuts[r] : cuts[r + 1]]
                left = np.minimum(self.size[k] - i, held[of[at]] - j[at])  # of both, this word included
                at = at[(held[of[at]] >= self.needed[k]) & (left >= self.needed[k])]
                pairs.append(of[at] * len(self.templates) + k)
            for pair in np.unique(np.concatenate(pairs)).tolist() if pairs else ():
                b, k = divmod(pair, len(self.templates))
                common = int(self.member[k, rank[starts[b] : starts[b] + held[b]]].sum())
                if common >= self.needed[k]:
                    number = int(block[starts[b]])
                    t = int(np.searchsorted(base, number, "right")) - 1
                    yield t, k, (number - int(base[t])) * step, common


def _joined(counts: np.ndarray):
    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        join = Join(counts)
        kind = pa.list_(pa.struct([("family", pa.string()), ("label", pa.string()), ("start", pa.int64()), ("width", pa.int32()), ("containment", pa.float64())]))
        for batch in batches:
            lists = batch.column("places")
            sizes = batch.column("n_words").to_numpy()
            text = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            met: list[list[tuple]] = [[] for _ in range(len(lists))]
            for t, k, start, common in join.found(text, lists.flatten().to_numpy(), batch.column("words").flatten().to_numpy(), sizes):
                met[t].append((start, k, common))
            rows = []
            for pairs in met:
                rows.append([])
                for start, k, common in sorted(pairs):
                    one = join.templates[k]
                    rows[-1].append(
                        {"family": one.family, "label": one.label, "start": start, "width": one.width, "containment": common / int(join.size[k])}
                    )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_words"), batch.column("base"), pa.array(rows, kind)],
                names=["doc_id", "n_words", "base", "found"],
            )
        W.trim()

    return joined


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, the phrases' places (``base``), and every window and template that meet (``found``)."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    sketches = stored(rows.mapInArrow(_sketched, SKETCH), "license_words")
    counts = np.zeros(len(vocabulary()), np.int64)
    # A row per word of the templates.
    for word, n in sketches.select("words").mapInArrow(_occurrences, "word int, n long").groupBy("word").agg(F.sum("n")).collect():
        counts[word] = n
    return stored(sketches.mapInArrow(_joined(counts), FOUND), "license_scans")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every row."""
    sizes = F.create_map(
        *(F.lit(x) for t in templates() for x in (f"{t.family}/{t.label}", len(set(t.words))))
    )
    # Of each family the greatest (containment, words of the template); what is equal in both counts alike.
    ranked = F.transform(
        "found",
        lambda x: F.struct(x["family"].alias("family"), x["containment"].alias("containment"), sizes[F.concat(x["family"], F.lit("/"), x["label"])].alias("size"), x["label"].alias("label")),
    )
    best = lambda x, every: ~F.exists(every, lambda y: (y["family"] == x["family"]) & ((y["containment"] > x["containment"]) | ((y["containment"] == x["containment"]) & (y["size"] > x["size"]))))
    base = F.array_sort(F.array_distinct(F.transform("base", lambda x: x["label"])))
    starts = F.transform("base", lambda x: x["start"])
    df = scanned(docs).withColumn("ranked", F.array_distinct(ranked))
    own = F.transform(F.filter("ranked", lambda x: best(x, F.col("ranked"))), lambda x: x["label"])
    return df.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, own))), ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(F.transform("found", lambda x: x["containment"])), F.lit(0.0))).alias("score"),
    )
