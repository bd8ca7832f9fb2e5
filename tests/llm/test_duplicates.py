"""SimHash, fuzzy lines and components against brute force."""

from __future__ import annotations

import random
import re

import corpus_pipeline
import numpy as np
import pytest

from airlake.llm import components, crowds, jaccard, line_dedup, line_hashes, near_texts, simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def groups(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components_of_chains_stars_and_noise(spark):
    dice = random.Random(3)
    links = [(i, i + 1) for i in range(300)] + [(400, i) for i in range(401, 700)] + [(5, 5), (None, 3), (710, 700), (700, 710)]
    links += [(dice.randrange(800, 1000), dice.randrange(800, 1000)) for _ in range(120)]
    got = components.connected_components(spark.createDataFrame(links, "src long, dst long"))
    real = [(a, b) for a, b in links if a is not None and a != b]
    want = groups(1000, real)
    ends = {x for e in real for x in e}
    assert {r["node"]: r["component"] for r in got.collect()} == {i: want[i] for i in ends}
    assert components.connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def plain_fingerprint(text):
    from xxhash import xxh64_intdigest

    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
    hashes = [xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_components_equal_brute_force(spark, documents, texts):
    got = {r["row"]["doc_id"]: r for r in simhash.near_duplicates(documents, carry=["doc_id"]).collect()}
    ids = sorted(texts)
    prints = [plain_fingerprint(texts[i]) for i in ids]
    assert [got[i]["fingerprint"] % 2**64 for i in ids] == prints
    near = [(a, b) for a in range(len(ids)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 2]
    want = groups(len(ids), near)
    assert [got[i]["component_id"] for i in ids] == [ids[w] for w in want]
    assert sum(r["is_first"] for r in got.values()) == len(set(want))


@pytest.mark.parametrize("crowd", [2, 1000])
def test_links_connect_all_close_fingerprints(spark, crowd):
    """Planted families with one to two flips, some large enough for the crowded path, among random words."""
    dice = random.Random(4)
    values = {dice.getrandbits(64) for _ in range(200)} | {0, 2**64 - 1}
    for _ in range(6):
        centre = dice.getrandbits(64)
        values |= {centre ^ sum({1 << dice.randrange(64) for _ in range(dice.randrange(3))}) for _ in range(120)}
    values |= {v ^ (1 << 63) for v in list(values)[:20]}
    values = sorted(values)
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    got = [(r["src"], r["dst"]) for r in simhash.links(frame, crowd).collect()]
    at = {v: i for i, v in enumerate(signed)}
    near = [(a, b) for a in range(len(values)) for b in range(a) if (values[a] ^ values[b]).bit_count() <= 2]
    assert all((values[at[a]] ^ values[at[b]]).bit_count() <= 2 for a, b in got)
    assert groups(len(values), [(at[a], at[b]) for a, b in got]) == groups(len(values), near)


def test_near_duplicates_of_awkward_rows(awkward):
    marked = simhash.near_duplicates(awkward)
    rows = marked.select("row.*", "fingerprint", "component_id", "is_first").collect()
    assert len(rows) == awkward.count()
    blank = [r for r in rows if not WORD.search(r["text"] or "")]
    assert {r["fingerprint"] for r in blank} == {0} and {r["component_id"] for r in blank} == {2}
    assert {r["component_id"] for r in rows if r["doc_id"] in (1, 6)} == {1}
    assert [r["doc_id"] for r in rows if r["component_id"] is None] == [None]
    assert simhash.keep_one(awkward).columns == awkward.columns
    assert simhash.near_duplicates(awkward.limit(0)).count() == 0


def plain_lines(docs, how=line_dedup.Fuzzy()):
    """doc -> kept text, comparing all pairs of different lines."""
    norm = lambda x: re.sub(r"[\x20\x09-\x0D]+", " ", x).strip(" ").lower()
    found = [(k, i, norm(x)) for k in sorted(docs) for i, x in enumerate(docs[k].split("\n")) if len(norm(x)) >= how.min_chars]
    index = {n: i for i, n in enumerate(dict.fromkeys(n for _, _, n in found))}
    sets = [{n[i : i + how.shingle] for i in range(len(n) - how.shingle + 1)} for n in index]
    close = []
    for a in range(len(sets)):
        for b in range(a):
            if min(len(sets[a]), len(sets[b])) >= 0.8 * max(len(sets[a]), len(sets[b])):
                both = len(sets[a] & sets[b])
                if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                    close.append((a, b))
    group, seen, gone = groups(len(sets), close), set(), set()
    for k, i, n in found:
        g = group[index[n]]
        if g in seen:
            gone.add((k, i))
        seen.add(g)
    return {k: "\n".join(x for i, x in enumerate(t.split("\n")) if (k, i) not in gone) for k, t in docs.items()}


def test_lines_equal_brute_force(documents, texts):
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(documents, carry=["doc_id"]).select("row.doc_id", "text").collect()}
    assert got == plain_lines(texts)


def test_a_crowd_of_edited_lines_meets_its_original(spark):
    dice = random.Random(5)
    word = lambda: "".join(dice.choice("abcdefghijklmnop") for _ in range(dice.randrange(2, 9)))
    original = [word() for _ in range(30)]
    lines = [" ".join(original)]
    for _ in range(150):
        edited = list(original)
        edited[dice.randrange(30)] = word()
        lines.append(" ".join(edited))
    lines += [" ".join(word() for _ in range(30)) for _ in range(100)]
    rows = [(i, x + "\nshort", "e") for i, x in enumerate(lines)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lines string")
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs, carry=["doc_id"]).select("row.doc_id", "text").collect()}
    assert got == plain_lines({i: t for i, t, _ in rows})


def test_lines_of_awkward_rows(awkward):
    out = line_dedup.dedup_lines(awkward)
    rows = out.select("row.doc_id", "text", "n_lines", "n_dropped").collect()
    assert len(rows) == awkward.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert by_id[2][0]["text"] == "" and by_id[3][0]["n_lines"] == 1
    assert by_id[1][0]["n_dropped"] == 0 and [r["n_dropped"] for r in by_id[6]] == [1, 1]
    assert line_dedup.dedup_lines(awkward.limit(0)).count() == 0


def plain_near(docs):
    """Components by comparing all pairs of five-word shingle sets."""
    ids, sets = sorted(docs), []
    for i in ids:
        words = WORD.findall((docs[i] or "").lower())
        sets.append({tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))})
    close = []
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 10 * both >= 8 * (len(sets[a]) + len(sets[b]) - both):
                close.append((a, b))
    return {i: ids[g] for i, g in zip(ids, groups(len(ids), close), strict=True)}


def test_near_texts_equal_brute_force(spark, texts):
    """Edited copies at all similarities around 0.8, short and long ones, and a crowd, among the given documents."""
    dice = random.Random(6)
    word = lambda: f"w{dice.randrange(5000)}"
    docs = dict(texts)
    for size in (6, 12, 30, 60, 90, 150, 400, 1200):
        for _ in range(6):
            base = [word() for _ in range(size)]
            for edits in (0, 1, size // 60, size // 50, size // 40):
                copy = list(base)
                for _ in range(edits):
                    copy[dice.randrange(size)] = word()
                docs[len(docs) + 10**6] = " ".join(copy)
    base = [word() for _ in range(100)]
    for _ in range(80):
        docs[len(docs) + 10**6] = " ".join([*base, *(word() for _ in range(dice.randrange(1, 20)))])
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = near_texts.near_duplicates(frame).select("row.doc_id", "component_id", "is_first").collect()
    want = plain_near(docs)
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"] for r in got if r["is_first"]} == set(want.values())


def test_near_texts_of_awkward_rows(awkward):
    rows = near_texts.near_duplicates(awkward).select("row.*", "component_id", "is_first").collect()
    assert len(rows) == awkward.count()
    assert {r["component_id"] for r in rows if not WORD.search(r["text"] or "")} == {2}
    assert {r["component_id"] for r in rows if r["doc_id"] in (1, 6)} == {1}
    assert near_texts.keep_one(awkward).columns == awkward.columns
    assert near_texts.keep_one(awkward.limit(0)).count() == 0


def kept_lines(spark, lines):
    rows = [(i, x) for i, x in enumerate(lines)]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), carry=["doc_id"])
    return {r["doc_id"]: r["text"] for r in out.select("row.doc_id", "text").collect()}, plain_lines(dict(rows))


def test_crowds_of_template_lines_equal_brute_force(spark):
    """Lines of templates with several slots: links run between members, and no line is the centre."""
    dice = random.Random(7)
    word = lambda: "".join(dice.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(dice.randrange(4, 9)))
    lines = []
    for slots, values, length in ((3, 12, 18), (2, 40, 12), (4, 6, 20)):
        frame, choices = [word() for _ in range(length)], [[word() for _ in range(values)] for _ in range(slots)]
        for _ in range(350):
            line = list(frame)
            for k in range(slots):
                line[k * (length // slots)] = dice.choice(choices[k])
            lines.append(" ".join(line))
    got, want = kept_lines(spark, lines)
    assert got == want


def test_lines_of_few_words_meet_their_edited_copies(spark):
    """One and two edited characters in lines of three to forty words; links at exactly 0.8 count."""
    dice = random.Random(8)
    lines = []
    for n_words, low, high in ((3, 9, 16), (5, 9, 14), (6, 3, 8), (8, 3, 8), (40, 3, 8)):
        for _ in range(60):
            line = " ".join("".join(dice.choice("abcdefghijklmnopqrst") for _ in range(dice.randrange(low, high + 1))) for _ in range(n_words))
            lines.append(line)
            for edits in (1, 2):
                copy = list(line)
                for _ in range(edits):
                    copy[dice.randrange(len(copy))] = "z"
                lines.append("".join(copy))
    got, want = kept_lines(spark, lines)
    assert got == want


def test_near_texts_meet_by_bands_of_minhash(spark):
    rng = np.random.default_rng(4)
    sets = [rng.integers(-(2**63), 2**63 - 1, size=n) for n in (1, 5, 300, 90_000)]
    close = [np.concatenate([x[: int(len(x) * 0.95)], rng.integers(-(2**63), 2**63 - 1, size=len(x) - int(len(x) * 0.95))]) for x in sets[2:]]
    rows_ = [(i, [int(h) for h in x]) for i, x in enumerate([*sets, *close, sets[2][::-1]])]
    frame = spark.createDataFrame(rows_, "id int, hashes array<bigint>")
    keys = {r["id"]: r["keys"] for r in line_hashes.with_set_keys(frame, "hashes").collect()}
    assert {len(k) for k in keys.values()} == {line_hashes.BANDS}
    assert keys[6] == keys[2]
    assert set(keys[2]) & set(keys[4]) and set(keys[3]) & set(keys[5]) and not set(keys[2]) & set(keys[3])


def edited_crowd(dice, n, most, length=40):
    """Copies of one line with up to ``most`` words replaced: near the original, not all near each other."""
    word = lambda: "".join(dice.choice("abcdefghijklmnop") for _ in range(dice.randrange(2, 9)))
    base, others = [word() for _ in range(length)], [word() for _ in range(60)]
    lines = [" ".join(base)]
    for _ in range(n):
        line = list(base)
        for _ in range(dice.randrange(1, most)):
            line[dice.randrange(length)] = dice.choice(others)
        lines.append(" ".join(line))
    return lines


@pytest.mark.parametrize("cut", [0, 17])
def test_blocks_of_a_crowd_equal_plain_sets(monkeypatch, cut):
    monkeypatch.setattr(crowds, "COLUMNS", 64)
    monkeypatch.setattr(crowds, "PAIRS", 100)
    lines = [*edited_crowd(random.Random(11), 60, 9), "ab", "ab abc", "x" * 50]
    sets = [{x[i : i + 5] for i in range(max(1, len(x) - 4))} for x in lines]
    got = crowds.near(*line_hashes.shingle_hashes(lines, 5), cut)
    if not cut:
        np.fill_diagonal(got, True)
    want = [[10 * len(a & b) >= 8 * len(a | b) for b in sets[cut:]] for a in sets[: cut or None]]
    assert got.tolist() == want
    if not cut:
        assert groups(len(sets), crowds.forest(got)) == groups(len(sets), list(zip(*np.nonzero(got), strict=True)))


@pytest.mark.parametrize("block", [1024, 40])
def test_links_of_crowds_are_found_without_a_row_for_each_pair(spark, monkeypatch, block):
    """A torn crowd: its members meet in blocks, only those of few sets as pairs; also over several blocks."""
    asked = []

    def check(pairs):
        asked.append(pairs.count())
        return line_hashes.with_similar_pairs(pairs, 5)

    monkeypatch.setattr(crowds, "BLOCK", block)
    lines = edited_crowd(random.Random(12), 200, 14)
    texts = spark.createDataFrame(list(enumerate(lines)), "id long, norm string")
    keyed = spark.range(len(lines)).selectExpr("id", "explode(array(1L, 2L + id % 100)) AS key")
    found = jaccard.similar_links(keyed, lambda ids: texts.join(ids, "id"), check, lambda t: line_hashes.shingle_hashes(t, 5), "test")
    got = [(r["src"], r["dst"]) for r in found.collect()]
    sets = [{x[i : i + 5] for i in range(len(x) - 4)} for x in lines]
    near = [(a, b) for a in range(len(sets)) for b in range(a) if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])]
    assert groups(len(sets), got) == groups(len(sets), near) and 10 < len(set(groups(len(sets), near))) < 190
    assert set(map(frozenset, got)) <= set(map(frozenset, near))
    # the small keys hold two or three members each
    assert sum(asked) < 110


def test_word_shingles_tell_the_same_sets_apart():
    dice = random.Random(13)
    texts = ["", "one", "one two three", "one two three four five", "é ü 日本"]
    texts += [" ".join(dice.choice("abc") for _ in range(dice.randrange(1, 30))) for _ in range(40)]
    hashes, counts = line_hashes.word_shingle_hashes(texts, 5)
    ends = np.cumsum(counts)
    got = [set(hashes[e - c : e].tolist()) for e, c in zip(ends, counts, strict=True)]
    words = [t.split(" ") for t in texts]
    plain = [{" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in words]
    assert [[len(a & b) for b in got] for a in got] == [[len(a & b) for b in plain] for a in plain]


def test_near_dedup_of_the_pipeline_runs_over_links_of_both_kinds(spark):
    dice = random.Random(14)
    word = lambda: f"w{dice.randrange(5000)}"
    drum = "the cat sat on mats " * 60
    base = [word() for _ in range(100)]
    texts = {
        1: drum,
        2: drum + "and a few words that no other text has",  # one fingerprint, shingles alike by less than 0.8
        3: " ".join(base),
        4: " ".join([*base, *(word() for _ in range(10))]),  # alike by 0.9, fingerprints apart
        5: " ".join(word() for _ in range(100)),
    }
    rows = [*texts.items(), (None, "a text without an id, as long as some"), (5, " ".join(word() for _ in range(100)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").select("doc_id").collect()]
    assert sorted(kept, key=str) == [1, 3, 5, 5, None]
    assert sorted(r["doc_id"] or 0 for r in near_texts.keep_one(docs).collect()) == [0, 1, 2, 3, 5, 5]
    assert sorted(r["doc_id"] or 0 for r in simhash.keep_one(docs).collect()) == [0, 1, 3, 4, 5, 5]
    assert corpus_pipeline.near_dedup(spark, docs.limit(0), "").count() == 0
