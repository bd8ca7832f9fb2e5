"""Shingle hashes, band keys and exact similarity of lines against plain sets."""

from __future__ import annotations

import random

import numpy as np

from airlake.llm import line_dedup, line_hashes


def plain(line, width=5):
    return {line[i : i + width] for i in range(max(1, len(line) - width + 1))}


def edited_pairs(n, letters, low, high, edits):
    dice = random.Random(9)
    for _ in range(n):
        line = "".join(dice.choice(letters) for _ in range(dice.randrange(low, high)))
        copy = list(line)
        for _ in range(dice.randrange(edits + 1)):
            if copy:
                copy[dice.randrange(len(copy))] = "z"
        yield line, "".join(copy)


def test_similar_equals_plain_sets():
    """Empty lines, lines shorter than a shingle, repeated shingles, other planes."""
    one, other = zip(*edited_pairs(1000, "abcé🙂 ", 0, 300, 3), strict=True)
    want = [10 * len(plain(a) & plain(b)) >= 8 * len(plain(a) | plain(b)) for a, b in zip(one, other, strict=True)]
    assert line_hashes.similar(list(one), list(other), 5).tolist() == want
    assert 0 < sum(want) < len(want)


def test_similar_lines_share_a_band_at_every_length():
    for low, high, edits in ((30, 40, 1), (60, 90, 2), (150, 200, 4), (600, 700, 12)):
        pairs = list(edited_pairs(2000, "abcdefghijklmnopqrst ", low, high, edits))
        near = [(a, b) for a, b in pairs if 10 * len(plain(a) & plain(b)) >= 8 * len(plain(a) | plain(b))]
        one, other = (line_hashes.band_keys([p[k] for p in near], 5) for k in (0, 1))
        assert np.mean((one == other).any(axis=1)) >= 0.99, (low, len(near))


def test_runs_cover_all_lines_in_order():
    sizes = [5, 1 << 17, 3, 0, 1 << 16, 7]
    bounds = list(line_hashes._runs(sizes, 2))
    assert [i for a, b in bounds for i in range(a, b)] == list(range(len(sizes)))
    assert all(b - a <= 2 for a, b in bounds) and not list(line_hashes._runs([]))


def test_short_equal_lines_merge_when_asked(spark):
    docs = spark.createDataFrame([(1, "short\n\nown"), (2, "Short \nother\n"), (3, None)], "doc_id long, text string")
    for least, second in ((30, "Short \nother\n"), (1, "other\n")):
        out = line_dedup.dedup_lines(docs, line_dedup.Fuzzy(min_equal=least), carry=["doc_id"])
        got = {r["doc_id"]: r["text"] for r in out.select("row.doc_id", "text").collect()}
        assert got == {1: "short\n\nown", 2: second, 3: ""}
