"""License scans: an exact set-similarity join of text blocks with license templates.

A block is a run of words; a template meets it if at least CONTAINED of the template's
distinct words are in the block. Templates are grouped by length (powers of two); for
templates of up to L words the blocks are the runs of 2 L words that start at multiples
of L, so any notice of up to L words lies wholly in one of them.

Words are ordered by how often they stand in the whole corpus, rarest first (only template
words count, others are in no intersection). With `need` words to be met, block and template
share one of the template's first `size - need + 1` words and one of the block's first
`size - need + 1` (prefix filter), the block has at least `need` template words (length
filter), and behind the first shared word enough words must be left on both sides
(positional filter). Pairs that pass are verified on the whole sets, so every block that
meets the threshold is found and no other.

The texts are read once: a task cuts words, finds the base phrases, counts template words
and keeps the blocks that pass the length filter. The corpus' order, prefixes, the join on a
shared prefix word and the verification are work on those narrow rows. Templates are a
parameter of at most MAX_TEMPLATES entries and MAX_WORDS words, which bounds the joined side.

Defined results: a null or empty text has no words, no places and the score 0; rows that
share a doc_id, or have none, are rows of their own; repeated rows give repeated rows; very
long texts have as many blocks as they need; only doc_id and text are read, so other
columns may have any name. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltrail.llm.common import content, stored, table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Share of a template's distinct words that a block must hold.
CONTAINED = 0.9
MAX_TEMPLATES = 1000
MAX_WORDS = 100_000
#: Characters of a text cut into words at a time.
PART = 1 << 20

# The phrases of the contract and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Customary short statements and notices of public licenses, by label.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions",
    ),
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: Redistributions of source code must retain the above "
        "copyright notice, this list of conditions and the following disclaimer.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
)


class Template(NamedTuple):
    label: str
    words: frozenset[str]
    #: The length class: any notice has at most so many words.
    span: int
    need: int


def lower(text: str) -> str:
    """A-Z lower-cased, nothing else (bytes.lower knows only ASCII)."""
    return text.lower() if text.isascii() else text.encode().lower().decode()


def parts_of(text: str) -> Iterator[list[str]]:
    """The words of a text, by parts that end between words."""
    text, start = lower(text), 0
    while start < len(text):
        end = start + PART
        if end < len(text):
            # To the end of the word that the part's border may have cut.
            rest = WORD.match(text, end)
            end = rest.end() if rest else end
        yield WORD.findall(text, start, end)
        start = end


def templates_of(texts, contained: float = CONTAINED) -> list[Template]:
    """Templates of (label, text) pairs."""
    if len(texts) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    made = []
    for label, text in texts:
        found = [word for part in parts_of(text) for word in part]
        if not found:
            raise ValueError(f"a template of {label} has no words")
        distinct = frozenset(found)
        span = 1 << max(0, len(found) - 1).bit_length()
        made.append(Template(label, distinct, span, max(1, math.ceil(contained * len(distinct) - 1e-9))))
    if sum(len(t.words) for t in made) > MAX_WORDS:
        raise ValueError(f"templates of more than {MAX_WORDS} words")
    return made


class Scanner:
    """What a text's words tell: base phrases, counts of template words, blocks."""

    def __init__(self, templates: list[Template], phrases: dict[str, str]):
        words = vocabulary(templates)
        self.number = {w: i for i, w in enumerate(words)}
        self.phrases = [(p.split(), label) for p, label in phrases.items()]
        self.reach = max((len(p) for p, _ in self.phrases), default=1) - 1
        self.classes = []
        for span in sorted({t.span for t in templates}):
            own = [t for t in templates if t.span == span]
            known = frozenset(self.number[w] for t in own for w in t.words)
            self.classes.append((span, min(t.need for t in own), known))

    def scan(self, text: str) -> tuple:
        n, base, labels, counts = 0, [], set(), Counter()
        stretches: list[dict[int, set]] = [{} for _ in self.classes]
        before: list[str] = []
        for words in parts_of(text):
            tokens = list(map(self.number.get, words))
            counts.update(tokens)
            held = [(i, t) for i, t in enumerate(tokens, n) if t is not None]
            for (span, _, known), sets in zip(self.classes, stretches):
                for i, t in held:
                    if t in known:
                        at = i // span
                        if at in sets:
                            sets[at].add(t)
                        else:
                            sets[at] = {t}
            words, shift = before + words, n - len(before)
            for phrase, label in self.phrases:
                at = -1
                for _ in range(words.count(phrase[-1])):
                    at = words.index(phrase[-1], at + 1)
                    first = at + 1 - len(phrase)
                    if first >= 0 and at >= len(before) and words[first : at + 1] == phrase:
                        base.append(shift + first)
                        labels.add(label)
            n += len(tokens)
            before = words[-self.reach :] if self.reach else []
        counts.pop(None, None)
        blocks = []
        for (span, least, _), sets in zip(self.classes, stretches):
            # A block is two stretches; the first one may hold no template word.
            for at in {b for k in sets for b in (k - 1, k) if b >= 0}:
                found = sets.get(at, _NONE) | sets.get(at + 1, _NONE)
                if len(found) >= least:
                    blocks.append({"span": span, "block": at, "tokens": list(found)})
        seen = [{"token": t, "n": c} for t, c in counts.items()]
        return n, len(base), min(base, default=None), max(base, default=None), sorted(labels), seen, blocks


_NONE: frozenset[int] = frozenset()
_SCANNED = (
    "part int, row long, doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels array<string>, seen array<struct<token: int, n: long>>, "
    "blocks array<struct<span: int, block: long, tokens: array<int>>>"
)


def scanned(docs: DataFrame, templates: list[Template], phrases: dict[str, str]) -> DataFrame:
    """Per row: counts and places of the base phrases, how often template words stand, and
    the blocks that pass the length filter of their class.

    `part` and `row` number the rows; numbers are fixed once the table is stored.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(_SCANNED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, part, row = Scanner(templates, phrases), TaskContext.get().partitionId(), 0
        for batch in batches:
            found = list(zip(*map(scanner.scan, batch.column("text").to_pylist()))) or [()] * 7
            n = batch.num_rows
            columns = [[part] * n, range(row, row + n), batch.column("doc_id"), *found]
            row += n
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, arrow)],
                schema=arrow,
            )

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), content().alias("text"))
    return picked.mapInArrow(run, _SCANNED)


def vocabulary(templates: list[Template]) -> list[str]:
    return sorted(set().union(*(t.words for t in templates)))


def ranks(rows: DataFrame, templates: list[Template]) -> list[int]:
    """By token, its place in the corpus' order, rarest first; ties by word."""
    seen = rows.select(F.inline("seen")).groupBy("token").agg(F.sum("n").alias("n"))
    count = {r["token"]: r["n"] for r in seen.collect()}  # one row per template word
    words = vocabulary(templates)
    order = sorted(range(len(words)), key=lambda i: (count.get(i, 0), words[i]))
    rank = [0] * len(words)
    for place, token in enumerate(order):
        rank[token] = place
    return rank


def matches(rows: DataFrame, templates: list[Template], rank: list[int]) -> DataFrame:
    """part, row, block, template, label, score of every block and template that meet the
    threshold."""
    number = {w: i for i, w in enumerate(vocabulary(templates))}
    sides = rows.sparkSession.createDataFrame(
        [(i, t.label, t.span, t.need, sorted(rank[number[w]] for w in t.words)) for i, t in enumerate(templates)],
        "template int, label string, span int, need int, template_words array<int>",
    )
    size, held = F.size("template_words"), F.size("words")
    prefix = F.posexplode(F.slice("template_words", 1, size - F.col("need") + 1)).alias("i", "word")
    prefixes = sides.select("*", prefix)
    least = sides.groupBy("span").agg(F.min("need").alias("least"))
    rank_of = F.array(*[F.lit(r) for r in rank])
    blocks = rows.select("part", "row", F.inline("blocks")).select(
        "part",
        "row",
        "span",
        "block",
        F.array_sort(F.transform("tokens", lambda t: F.get(rank_of, t))).alias("words"),
    )
    # The block's prefix for the template of its class that needs least.
    heads = F.posexplode(F.slice("words", 1, held - F.col("least") + 1)).alias("j", "word")
    cut = blocks.join(F.broadcast(least), "span").select(*blocks.columns, heads)
    pairs = cut.join(F.broadcast(prefixes), ["span", "word"])
    left = F.least(size - F.col("i"), held - F.col("j"))
    # A pair is met at each shared prefix word; at the first one it is verified.
    earlier = F.size(F.array_intersect(F.slice("words", 1, F.col("j")), "template_words"))
    common = F.size(F.array_intersect("words", "template_words"))
    return (
        pairs.where((held >= F.col("need")) & (left >= F.col("need")) & (earlier == 0))
        .withColumn("common", common)
        .where(F.col("common") >= F.col("need"))
        .select("part", "row", "block", "template", "label", (F.col("common") / size).alias("score"))
    )


def scan(
    docs: DataFrame,
    texts=TEMPLATES,
    contained: float = CONTAINED,
    phrases: dict[str, str] = PHRASES,
) -> DataFrame:
    """doc_id, counts and places of the phrases, labels and score of every row.

    The score is 1 where a phrase stands, else the greatest share of a template's words that
    a block holds, 0 without a match.
    """
    templates = templates_of(texts, contained)
    rows = stored(scanned(docs, templates, phrases), "license-words")
    met = (
        matches(rows, templates, ranks(rows, templates))
        .groupBy("part", "row")
        .agg(F.collect_set("label").alias("met"), F.max("score").alias("met_score"))
    )
    listed = F.array_join(F.array_sort(F.array_distinct(F.concat("base_labels", F.coalesce("met", F.array())))), ",")
    return (
        rows.drop("seen", "blocks")
        .join(met, ["part", "row"], "left")
        .select(
            "doc_id",
            "n_words",
            "n_base",
            "first_word",
            "last_word",
            F.array_join("base_labels", ",").alias("base_labels"),
            listed.alias("labels"),
            F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("met_score", F.lit(0.0))).alias("score"),
        )
    )


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


QUERIES = {"op11_license_scan": op11_license_scan}
SQL: dict[str, str] = {}
