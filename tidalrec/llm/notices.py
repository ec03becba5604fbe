"""Fuzzy search for short licence notices.

A notice of m characters may differ by e edits.  Cut into e + 1 seeds, at least
one seed is free of edits wherever the notice occurs (pigeonhole), so one exact
multi-pattern pass over the text finds every place where it can be; the region
around such a seed is then matched with the regex library's bounded-error
matching, which verifies the edits and gives the span.

Besides, the places of the base phrases are found exactly: their words,
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z, standing one after
the other.

Defined cases: a null text is empty: no words, no places, empty labels, score
0; texts of any length are searched whole; rows that share an id are searched
each by its own text; an empty table gives an empty result; other columns are
never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalrec.llm.common import load

#: Base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Opening words of common notices (public licence texts) and their labels.
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person": "mit",
    "licensed under the apache license version": "apache",
    "licensed under the gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl",
    "licensed under cc by": "cc",
    "creative commons attribution": "cc",
    "spdx license identifier": "spdx",
    "all rights reserved": "proprietary",
}


@dataclass(frozen=True)
class Search:
    errors_per: int = 12     # one edit for so many characters of a notice, at least 1
    most_errors: int = 4
    base: tuple[tuple[str, str], ...] = tuple(BASE.items())
    notices: tuple[tuple[str, str], ...] = tuple(NOTICES.items())


_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_GAP = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def seeds(pattern: str, errors: int) -> list[tuple[str, int]]:
    """(seed, its place in the pattern): errors + 1 pieces of nearly equal length."""
    cuts = [round(i * len(pattern) / (errors + 1)) for i in range(errors + 2)]
    return [(pattern[a:b], a) for a, b in zip(cuts, cuts[1:])]


class Finder:
    """Compiled search; ``find`` returns word count, base places and fuzzy matches of one text.

    Matching runs on the text's words joined by single spaces, so punctuation
    and line breaks inside a notice cost no edits.
    """

    def __init__(self, p: Search):
        self._base = [(f" {phrase} ", label) for phrase, label in p.base]
        self._auto = ahocorasick.Automaton()
        self._notices = []
        table: dict[str, list[tuple[int, int]]] = {}
        for k, (text, label) in enumerate(p.notices):
            errors = max(1, min(p.most_errors, len(text) // p.errors_per))
            rx = regex.compile(rf"(?b)\b(?:{regex.escape(text)}){{e<={errors}}}")
            self._notices.append((len(text), errors, rx, label))
            for seed, at in seeds(text, errors):
                table.setdefault(seed, []).append((k, at))
        for seed, where in table.items():
            self._auto.add_word(seed, (len(seed), where))
        self._auto.make_automaton()

    def find(self, text: str) -> tuple[int, list[tuple[int, str]], list[tuple[str, int, int, int, float]]]:
        joined = " " + _GAP.sub(" ", text.translate(_LOWER)).strip(" ") + " "
        n_words = joined.count(" ") - 1 if joined.strip(" ") else 0
        places = []
        for phrase, label in self._base:
            at = joined.find(phrase)
            while at >= 0:
                places.append((at, label))
                at = joined.find(phrase, at + 1)
        places.sort()
        word, last, base = 0, 0, []
        for at, label in places:  # word index: the separators before the place
            word += joined.count(" ", last, at)
            last = at
            base.append((word, label))
        return n_words, base, self._fuzzy(joined)

    def _fuzzy(self, joined: str) -> list[tuple[str, int, int, int, float]]:
        """(label, start, end, edits, similarity) of verified notices, in the joined words."""
        regions: dict[int, list[list[int]]] = {}
        for end, (size, where) in self._auto.iter(joined):
            start = end - size + 1
            for k, at in where:
                m, e, _, _ = self._notices[k]
                lo, hi = max(0, start - at - e), start - at + m + e
                mine = regions.setdefault(k, [])
                if mine and lo <= mine[-1][1]:
                    mine[-1][0], mine[-1][1] = min(mine[-1][0], lo), max(mine[-1][1], hi)
                else:
                    mine.append([lo, hi])
        found = []
        for k, mine in regions.items():
            m, e, rx, label = self._notices[k]
            parts = [(lo, min(hi, len(joined))) for lo, hi in mine]
            while parts:
                lo, hi = parts.pop()
                x = rx.search(joined, lo, hi) if hi - lo >= m - e else None
                if x:  # the best of its part, which may have others on both sides
                    edits = sum(x.fuzzy_counts)
                    found.append((label, x.start(), x.end(), edits, 1 - edits / m))
                    parts += [(lo, x.start()), (x.end(), hi)]
        return sorted(found, key=lambda f: (f[1], f[2], f[0]))


MATCH = "struct<label:string,start:long,end:long,edits:int,similarity:double>"


def search(docs: DataFrame, p: Search = Search(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, base (word, label) places, matches.

    Spans of matches count characters of the words joined by single spaces.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(p)
        place = pa.struct([("word", pa.int64()), ("label", pa.string())])
        match = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                           ("edits", pa.int32()), ("similarity", pa.float64())])
        for batch in batches:
            n, base, found = [], [], []
            for text in batch.column(1).to_pylist():
                k, b, f = finder.find(text or "")
                n.append(k)
                base.append([{"word": w, "label": x} for w, x in b])
                found.append([dict(zip(("label", "start", "end", "edits", "similarity"), x)) for x in f])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(base, pa.list_(place)),
                 pa.array(found, pa.list_(match))], names=["doc_id", "n_words", "base", "matches"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t")).mapInArrow(
        run, f"doc_id long, n_words long, base array<struct<word:long,label:string>>, matches array<{MATCH}>")


def op6_fuzzy_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices of every document."""
    found = search(load(spark, sf_dir, "documents"))
    both = F.concat("base.label", "matches.label")
    score = F.when(F.size("base") > 0, F.lit(1.0)).otherwise(
        F.coalesce(F.array_max("matches.similarity"), F.lit(0.0)))
    names = lambda labels: F.array_join(F.sort_array(F.array_distinct(labels)), ",")
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min("base.word").alias("first_word"), F.array_max("base.word").alias("last_word"),
        names(F.col("base.label")).alias("base_labels"), names(both).alias("labels"), score.alias("score"),
        F.size("matches").cast("long").alias("n_matches"))
