"""Token files and packed sequences against the tokenizer itself."""

from __future__ import annotations

import glob
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from airlake.llm import packing, token_store, tokens
from airlake.llm.tokens import encoder

PATH = public_tokenizers.path("word_bpe_49k.json")
HARD = [
    "<|endoftext|> it's don't 'S x<|startoftext|>y", "Éé İSTANBUL ΣΊΣΥΦΟΣ ß ﬁ ½ ², ª º µ", "a\x0bb\x0cc\x1cd\x85e\xa0f",
    "é ́x", "日本語 テスト", "x" * 3000, "a×b÷c", "", " ", "٣٤ 12", "​ zero", "don’t", "\x00\x01 a", None,
]


def plain_ids(texts):
    got = encoder(PATH).tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [[*g.ids, 1] for g in got]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_pieces_encode_like_whole_texts(texts):
    every = [*HARD, *texts.values()]
    for text, ids in zip(every, plain_ids(every), strict=True):
        assert encoder(PATH).encode(text) == np.array(ids[:-1], "<u4").tobytes()


def test_texts_are_encoded_together_by_their_distinct_words(texts, monkeypatch):
    every = [*HARD, "×a", "÷", "Ã", "a'", "x" * 100 + ".", *texts.values(), *HARD]
    want = [np.array(ids[:-1], "<u4").tobytes() for ids in plain_ids(every)]
    column = pa.array(["left out", *every, None])[1:-1]
    assert list(encoder(PATH).encode_all(column)) == want
    monkeypatch.setattr(tokens, "AT_ONCE", 100)  # most texts are then cut alone
    fresh = tokens.PieceEncoder(PATH, cached=50)
    assert list(fresh.encode_all(column)) == want and len(fresh.table) <= 50
    fresh = tokens.PieceEncoder(PATH)
    list(fresh.encode_all(pa.array(["The mat. the, (the) MAT!", "Été the.", "it's it's", "y" * 100])))
    assert set(fresh.table) == {"the", "mat", ".", ",", "(", ")", "!", "été", "it's"}
    assert list(fresh.encode_all(pa.array([], pa.string()))) == []


def test_a_worker_keeps_few_words_and_those_met_again():
    fresh, most = tokens.PieceEncoder(PATH, cached=50), 0
    for n in range(20):
        list(fresh.encode_all(pa.array(["often " + " ".join(f"w{'abcdefghij'[n % 10]}{'x' * k}" for k in range(n, n + 9))])))
        most = max(most, len(fresh.table) + len(fresh.older))
        assert "often" in fresh.table or "often" in fresh.older
    assert 25 <= most <= 75 and tokens.CACHED_WORDS <= 400_000


def test_digests_make_no_copy_of_the_ids():
    column = pa.array([[7] * 1000] * 1000, pa.list_(pa.int32()))
    tracemalloc.start()
    try:
        got = tokens.crcs(column.slice(10))
        assert tracemalloc.get_traced_memory()[1] < 1_000_000  # the ids take four
    finally:
        tracemalloc.stop()
    assert got == [crc([7] * 1000)] * 990


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files_read_back(spark, texts, tmp_path, encoding):
    rows = [(k, t, "x") for k, t in texts.items()] + [(-5, None, "x"), (-5, "again", "x"), (None, "no id", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(5)
    path = str(tmp_path / encoding)
    layout = token_store.Layout(encoding=encoding, row_group_bytes=64 << 10, page_bytes=4 << 10)
    token_store.write_tokens(docs, path, PATH, layout=layout)
    got = token_store.read_tokens(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x or 0))
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1].tolist()]
    want = dict(zip(texts, plain_ids(texts.values()), strict=True))
    assert all(r["ids"] == want[r["doc_id"]] for r in got if r["doc_id"] in want)
    some = token_store.read_tokens(spark, path, ("doc_id", "n_tokens"), 10, 20)
    assert {r["doc_id"] for r in some.collect()} == {k for k in texts if 10 <= k <= 20}
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.split("ReadSchema:")[1].splitlines()[0] and "GreaterThanOrEqual(doc_id,10)" in plan
    meta = pq.ParquetFile(max(glob.glob(f"{path}/tokens/*.parquet"), key=lambda f: pq.ParquetFile(f).metadata.num_rows)).metadata
    columns = {meta.row_group(0).column(i).path_in_schema: meta.row_group(0).column(i) for i in range(meta.num_columns)}
    used = next(c for n, c in columns.items() if n.startswith("ids"))
    assert ("RLE_DICTIONARY" if encoding == "dictionary" else "DELTA_BINARY_PACKED") in used.encodings
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    assert used.has_column_index and used.has_offset_index


def test_token_files_of_an_empty_table(spark, documents, tmp_path):
    token_store.write_tokens(documents.limit(0), str(tmp_path / "none"), PATH)
    assert token_store.with_crc(token_store.read_tokens(spark, str(tmp_path / "none"))).count() == 0


def check_packed(pieces, want):
    """want: doc_id -> list of ids, one list for each row of that id."""
    docs, sequences = {}, {}
    for r in pieces:
        docs.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    assert set(docs) == set(want)
    for k, got in docs.items():
        assert sum(len(r["ids"]) for r in got) == sum(map(len, want[k]))
        for ids in want[k]:
            assert any(r["ids"] == ids[r["start"] : r["start"] + len(r["ids"])] and r["doc_tokens"] == len(ids) for r in got)
    filled = []
    for got in sequences.values():
        at = 0
        for r in sorted(got, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += len(r["ids"])
        filled.append(at)
    assert max(filled, default=0) <= packing.LENGTH
    return filled


def test_packing_is_whole_and_tight(spark, documents, texts):
    want = {k: [ids] for k, ids in zip(texts, plain_ids(texts.values()), strict=True)}
    filled = check_packed(packing.pack(documents.repartition(3), PATH, open_windows=8).collect(), want)
    padding = sum(0 if n & (n - 1) == 0 else packing.LENGTH - n for n in filled)
    assert padding < 0.1 * (sum(filled) + padding)


def test_packing_awkward_rows(awkward):
    rows = awkward.select("doc_id", "text").collect()
    want = {}
    for r, ids in zip(rows, plain_ids([r["text"] for r in rows]), strict=True):
        want.setdefault(r["doc_id"], []).append(ids)
    check_packed(packing.pack(awkward, PATH).collect(), want)
    assert packing.pack(awkward.limit(0), PATH).count() == 0


def test_packing_hands_over_few_pieces_at_once(spark):
    class Rows:
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return run

    texts = ["word " * 2000] * 4500
    batch = pa.RecordBatch.from_pydict({"part": [0] * len(texts), "doc_id": range(len(texts)), "text": texts})
    out = list(packing.packed_pieces(Rows(), PATH, 1, packing.LENGTH, packing.OPEN_WINDOWS)(iter([batch])))
    assert sum(len(b.column("ids").flatten()) for b in out) == 4500 * 2001
    assert max(b.column("ids").nbytes for b in out) < 12 << 20


def test_best_fit_and_the_fullest_go():
    windows = packing.OpenWindows(100, 2)
    assert windows.put(50, "a") == [] and windows.put(60, "b") == []
    assert windows.put(38, "c") == [(1, [(0, "b"), (60, "c")])]  # fits b's window best and fills it
    assert windows.put(70, "d") == []
    assert windows.put(60, "e") == [(2, [(0, "d")])]  # fits none: the fullest is emitted


def test_sequences_are_padded_but_at_powers_of_two(spark):
    pieces = spark.createDataFrame(
        [(1, 0, [5] * 4), (1, 4, [6] * 4), (2, 0, [7] * 3)], "sequence_id long, offset long, ids array<int>"
    )
    got = {r["sequence_id"]: r for r in packing.sequences(pieces, length=16).collect()}
    assert got[1]["ids"] == [5] * 4 + [6] * 4 and got[1]["doc_starts"] == [0, 4]
    assert got[2]["ids"] == [7] * 3 + [0] * 13
