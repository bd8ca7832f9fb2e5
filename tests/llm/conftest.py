from __future__ import annotations

import pytest

BASE = "/root/testdata/sf0.001"

#: Rows every operator over documents must take: nulls anywhere, empty and long texts, ties, repeats, clashing names.
AWKWARD = [
    (1, "the cat sat on the mat " * 30, "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (None, "lonely text without an id", "en", "b"),
    (4, "word " * 20_000, "en", "b"),
    (5, " \t\n\x0b\x0c\r ", "de", "b"),
    (6, "the cat sat on the mat " * 30, "en", "a"),
    (6, "the cat sat on the mat " * 30, "en", "a"),
    (7, "x" * 5_000, "fr", "c"),
    (8, "日本語のテキスト\n日本語のテキスト\n🙂 é", "ja", "c"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    rows = [(*r, "kept", 1, "row") for r in AWKWARD]
    schema = "doc_id long, text string, lang string, source string, words string, n_words int, row string"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{BASE}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] or "" for r in documents.select("doc_id", "text").collect()}
