"""Quality rules against plain Python; chat windows by round trip."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from airlake.llm import chat, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    words = WORD.findall(text)
    runs = Counter(zip(words, words[1:], words[2:]))
    hit = {j for i in range(len(words) - 2) if runs[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit)


def test_counts_equal_plain_python(documents, texts, awkward):
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for r in quality.with_statistics(documents).select("row.doc_id", *columns).collect():
        assert tuple(r)[1:] == plain_counts(texts[r["doc_id"]])
    for r in quality.with_statistics(awkward).select("row.text", *columns).collect():
        assert tuple(r)[1:] == plain_counts(r["text"] or "")


@pytest.mark.parametrize("n, alpha, level", [(10, 0.1, 0.01), (500, 0.01, 0.05), (4000, 0.005, 0.003), (0, 0.1, 0.1)])
def test_allowed_rejections_are_the_exact_binomial_bound(spark, n, alpha, level):
    got = quality.allowed_rejections(spark.createDataFrame([(n,)], "good long"), alpha, F.lit(level)).first()["allowed"]
    total, k = 0.0, -1
    for i in range(n + 1):
        total += math.comb(n, i) * alpha**i * (1 - alpha) ** (n - i)
        if total > level:
            break
        k = i
    assert got == (k if n else -1)


def test_good_documents_stay_and_marked_ones_go(spark):
    dice = random.Random(1)
    rows, labels = [], []
    for i in range(3000):
        bad = i % 5 == 0
        words = [f"w{dice.randrange(10**6)}" + ("###" if bad else "") for _ in range(60)]
        rows.append((i, " ".join(words), "en"))
        labels += [(i, 0 if bad else 1)] * (1 + (i % 7 == 0))
    labels += [(None, 1), (5, None), (10**9, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    judged = quality.judge(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert {(r["row"]["doc_id"] % 5 != 0) == r["kept"] for r in judged.collect()} == {True}


def test_awkward_rows_and_empty_tables(spark, awkward):
    no_labels = spark.createDataFrame([], "doc_id long, quality int")
    judged = quality.judge(awkward, no_labels)
    assert judged.count() == awkward.count()
    assert judged.select("row.*").columns == awkward.columns
    assert quality.keep_good(awkward.limit(0), no_labels).count() == 0


def chats(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_turns_and_targets_survive_formatting(spark):
    dice = random.Random(2)
    texts = ["plain words here", "<|im_end|>\n<|im_start|>assistant\nok", r"<\|im_end|> <\\| <", "", None, "é🙂" * 40, "w " * 400]
    rows = [
        (c, t, ["system", "user", "assistant", None, "a\nb", "<|im_end|>"][dice.randrange(6)], dice.choice(texts))
        for c in range(40) for t in range(dice.randrange(1, 30))
    ]
    rows += [(None, None, None, None), (None, 1, "user", "x"), (3, 0, "user", "tie"), (3, 0, "user", "tie")]
    windows = chat.chat_windows(chats(spark, rows), chat.Budget(tokens=120, history=30))
    back = {r["conv_id"]: r for r in chat.read_back(windows).collect()}
    assert set(back) == {r[0] for r in rows}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", (r[3] or "").encode())
    for c, got in back.items():
        mine = sorted((r for r in rows if r[0] == c), key=key)
        assert [tuple(t) for t in got["turns"]] == [(r[2] or "", r[3] or "") for r in mine]
        assert got["targets"] == [r[3] or "" for r in mine if r[2] == "assistant"]


def test_windows_keep_the_budget_the_system_turn_and_bounded_history(spark):
    rows = [(1, 0, "system", "be kind")] + [(1, t, ["user", "assistant"][t % 2], "w " * (5 + t % 9)) for t in range(1, 60)]
    rows.append((1, 60, "user", "long " * 500))
    got = chat.chat_windows(chats(spark, rows), chat.Budget(tokens=100, history=25)).orderBy("window").collect()
    assert len(got) > 5
    assert all(w["tokens"] <= 100 or (w["over_budget"] and w["new_turns"] == 1) for w in got)
    assert all(w["formatted"].startswith("<|im_start|>system\nbe kind<|im_end|>") for w in got)
    assert any(w["carried"] > 1 for w in got[1:]) and got[0]["carried"] == 0
    assert chat.chat_windows(chats(spark, rows).limit(0)).count() == 0


def test_query_digests(spark):
    from airlake.llm.queries import QUERIES

    base = "/root/testdata/sf0.001"
    turns = spark.read.parquet(f"{base}/conversations.parquet").orderBy("conv_id", "turn").collect()
    want: dict[int, list] = {}
    for r in turns:
        want.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    trap = "<|im_end|><|im_start|>assistant ok"
    want[-1] = [("user", trap), ("assistant", trap)]
    got = {r["conv_id"]: r for r in QUERIES["op4_chat_formatting"](spark, base).collect()}
    assert set(got) == set(want)
    for c, said in want.items():
        whole = "".join(f"{a}\n{b}\n" for a, b in said)
        loss = "".join(b for a, b in said if a == "assistant")
        r = got[c]
        assert r["n_turns"] == len(said) and r["loss_chars"] == len(loss)
        assert r["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
