"""Licence scans: ordered signature rules behind a keyword prefilter, overlaps resolved by priority and containment.

A text is reduced to lower-case words with single spaces between them, so punctuation and line breaks do not matter. The words
of a text that are keywords of some rule select the rules that can match at all; only those are run, over the whole text. A
detection inside the interval of another of equal or higher priority is suppressed (of equal intervals and priorities the earlier rule
stands): "gnu general public license" within a complete version 3 notice gives one label. Base phrases are
looked up besides and are never suppressed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlake.llm.common import packed_row
from airlake.llm.importance import words_of
from airlake.llm.license_rules import HINT, TAG, Rule, rules

#: Fixed phrases and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}


class Scanner:
    """The rules by the words they need."""

    def __init__(self, ordered: Sequence[Rule]):
        self.rules = list(ordered)
        self.keywords = frozenset(w for r in self.rules for g in r.needs for w in g)
        self.by_word: dict[bytes, list[int]] = {}
        for n, r in enumerate(self.rules):
            for w in r.needs[0]:
                self.by_word.setdefault(w, []).append(n)

    def candidates(self, words: list[bytes]) -> list[int]:
        """Rules whose every group of keywords has one in the text."""
        met = self.keywords.intersection(words)
        some = {n for w in met for n in self.by_word.get(w, ())}
        return sorted(n for n in some if all(met & g for g in self.rules[n].needs))

    def detections(self, text: bytes, spaces: np.ndarray, candidates: list[int]) -> list[tuple[int, int, int]]:
        """(first word, word after the last, rule) of every match, ``text`` with a space at each end."""
        spans = [(m.start(), m.end(), n) for n in candidates for m in self.rules[n].pattern.finditer(text)]
        if not spans:
            return []
        ends = np.searchsorted(spaces, [(a, b) for a, b, _ in spans])
        return [(int(a), int(b), n) for (a, b), (_, _, n) in zip(ends, spans, strict=True)]

    def surviving(self, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Without those that lie in a detection of equal or higher priority. One sweep, whatever the number."""
        rank = lambda d: (d[0], -d[1], -self.rules[d[2]].priority, d[2])
        reach = [-1] * (TAG + 1)  # by priority: the farthest end so far
        out = []
        for d in sorted(found, key=rank):
            level = self.rules[d[2]].priority
            if max(reach[level:]) < d[1]:
                out.append(d)
            reach[level] = max(reach[level], d[1])
        return out


@lru_cache(maxsize=1)
def standard() -> Scanner:
    return Scanner(rules())


def places(text: bytes, spaces: np.ndarray, base: dict[str, str]) -> list[tuple[str, int]]:
    """(label, first word) wherever the words of a base phrase stand one after the other."""
    out = []
    for phrase, label in base.items():
        wanted, at = f" {phrase} ".encode(), -1
        while (at := text.find(wanted, at + 1)) >= 0:
            out.append((label, int(np.searchsorted(spaces, at))))
    return out


DETECTION = "struct<label: string, first: bigint, after: bigint, priority: int, confidence: double>"


def scan(docs: DataFrame, base: dict[str, str] = BASE, carry: list[str] | None = None) -> DataFrame:
    """``row`` (the carried columns, all by default), n_words, ``places`` (label, first) and ``detections``.

    Detections hold label, first word, the word after the last, priority and confidence. Null and empty texts have no words and
    nothing found. Each row stands for itself, so ties, repeats and empty tables need no rule; columns cannot clash.
    """
    place_type = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64())]))
    found_type = pa.list_(
        pa.struct([("label", pa.string()), ("first", pa.int64()), ("after", pa.int64()), ("priority", pa.int32()), ("confidence", pa.float64())])
    )
    starts = frozenset(p.split()[0].encode() for p in base)

    def one(words: list[bytes], scanner: Scanner) -> tuple[list, list]:
        candidates = scanner.candidates(words)
        if not candidates and starts.isdisjoint(words):
            return [], []
        text = b" ".join([b"", *words, b""])
        spaces = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
        kept = scanner.surviving(scanner.detections(text, spaces, candidates))
        told = [scanner.rules[n] for _, _, n in kept]
        found = [
            {"label": r.label, "first": a, "after": b, "priority": r.priority, "confidence": r.confidence}
            for (a, b, _), r in zip(kept, told, strict=True)
        ]
        return [{"label": label, "first": at} for label, at in places(text, spaces, base)], found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = standard()
        for batch in batches:
            sizes, where, found = [], [], []
            for t in batch.column("text"):
                words = words_of(t.as_py())
                a, b = one(words, scanner)
                sizes.append(len(words))
                where.append(a)
                found.append(b)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(sizes, pa.int64()), pa.array(where, place_type), pa.array(found, found_type)],
                ["row", "n_words", "places", "detections"],
            )

    packed = docs.select(*packed_row(docs.select(*(carry or docs.columns))), "text")
    kind = packed.schema["row"].dataType.simpleString()
    schema = f"row {kind}, n_words bigint, places array<struct<label: string, first: bigint>>, detections array<{DETECTION}>"
    return packed.mapInArrow(run, schema)


def digest(scanned: DataFrame) -> DataFrame:
    """``row``, n_words, n_base, first_word, last_word, base_labels, labels, score and n_detections of each scanned text.

    ``labels`` are those of base phrases and of detections, mere notices such as reserved rights included; ``score`` is the highest
    confidence of any of them (0: nothing found); ``n_detections`` counts those that name a licence.
    """
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    base = F.col("places.label")
    first = F.array_min("places.first"), F.array_max("places.first")
    best = F.greatest(F.coalesce(F.array_max("detections.confidence"), F.lit(0.0)), F.when(F.size("places") > 0, 0.9).otherwise(0.0))
    return scanned.select(
        "row", "n_words", F.size("places").cast("long").alias("n_base"),
        first[0].alias("first_word"), first[1].alias("last_word"), joined(base).alias("base_labels"),
        joined(F.concat(base, F.col("detections.label"))).alias("labels"), best.alias("score"),
        F.size(F.filter("detections", lambda d: d["priority"] > HINT)).cast("long").alias("n_detections"),
    )
