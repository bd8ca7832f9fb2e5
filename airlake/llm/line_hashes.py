"""MinHash band keys and exact similarity of lines, over Arrow batches: numpy on all shingles of a batch at once.

A shingle's hash is a polynomial over its code points, mixed. Row r of a signature takes the least of the hashes times an
odd number of its own, modulo 2^32; ROWS minima are mixed into the key of a band. Lines are taken in runs of about RUN
characters, which stay in the processor's cache; a longer line is a run of its own.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlake.llm.common import GAPS

BANDS = 24
ROWS = 6
RUN = 1 << 16  # characters
PAIRS = 1 << 10  # of lines compared at once; the number of a line has eleven bits beside 53 of a hash
VALUE = np.uint64(53)

_GAPS = re.compile(GAPS)
_ODD = re.compile(r"[\x09-\x0D]|\x20\x20")
_dice = random.Random(8)
_STEP = np.uint64(_dice.getrandbits(64) | 1)
_TURNS = np.array([_dice.getrandbits(32) | 1 for _ in range(BANDS * ROWS)], np.uint32)
# an odd number close to 2^64 divided by the golden ratio
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers after which every bit depends on all."""
    for shift in (32, 29):
        x = (x ^ (x >> np.uint64(shift))) * _SPREAD
    return x ^ (x >> np.uint64(32))


def shingle_hashes(lines: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the shingles at all places of all lines, and how many each has; a line shorter than a shingle has one."""
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    if (lengths < width).any():
        lines = [line.ljust(width, "\0") for line in lines]
        lengths = np.maximum(lengths, width)
    return _run_hashes(np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), "<u4"), lengths, width)


def word_shingle_hashes(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for runs of words, of texts whose words are joined by single spaces."""
    words = [text.split(" ") for text in texts]
    words = [w + [""] * (width - len(w)) for w in words]
    known = {w: xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) if w else 0 for w in {x for w in words for x in w}}
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    codes = np.fromiter((known[x] for w in words for x in w), np.uint64, int(lengths.sum()))
    return _run_hashes(codes, lengths, width)


def _run_hashes(codes: np.ndarray, lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all runs of ``width`` codes within sequences of these lengths, and how many each has."""
    if not len(codes):
        return np.zeros(0, np.uint64), lengths
    n = len(codes) - width + 1
    h = np.zeros(n, np.uint64)
    for k in range(width):
        h *= _STEP
        h += codes[k : k + n]
    # shingles that begin in the last places of a line would run into the next one
    whole = np.ones(len(codes), bool)
    ends = np.cumsum(lengths)
    for k in range(1, width):
        whole[ends - k] = False
    return _mixed(h[whole[:n]]), lengths - (width - 1)


def band_keys(lines: list[str], width: int) -> np.ndarray:
    """One row of BANDS keys for each line."""
    if not lines:
        return np.zeros((0, BANDS), np.uint64)
    return set_keys(*shingle_hashes(lines, width))


def set_keys(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One row of BANDS keys for each set of hashes; the sets, of ``counts`` members each and none empty, follow one another."""
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum(counts) - counts
    least = np.empty((BANDS * ROWS, len(counts)), np.uint32)
    turned = np.empty_like(low)
    for r, turn in enumerate(_TURNS):
        np.multiply(low, turn, out=turned)
        np.minimum.reduceat(turned, starts, out=least[r])
    keys = np.empty((len(counts), BANDS), np.uint64)
    for b in range(BANDS):
        key = np.full(len(counts), b + 1, np.uint64)
        for r in range(b * ROWS, (b + 1) * ROWS):
            key = _mixed(key ^ least[r])
        keys[:, b] = key
    return keys


def _runs(sizes: list[int], most: int | None = None) -> Iterator[tuple[int, int]]:
    """Bounds of neighbouring lines that have about RUN characters together, and are at most ``most``."""
    first = total = 0
    for i, size in enumerate(sizes):
        if i > first and (total + size > RUN or i - first == most):
            yield first, i
            first, total = i, 0
        total += size
    if first < len(sizes):
        yield first, len(sizes)


def normal(line: str) -> str:
    """The words of a line joined by single spaces, in lower case."""
    return (_GAPS.sub(" ", line) if _ODD.search(line) else line).strip(" ").lower()


def lines_of(docs: DataFrame, min_chars: int, keys_from: int = 0, width: int = 0, texts: bool = False) -> DataFrame:
    """doc_id, text_hash, pos, h1, h2 (a 128-bit hash) of every line that has at least ``min_chars`` characters when normal.

    With ``texts`` also norm, the normal line; with ``width`` also the band keys k0, k1, ... of its shingles, null where it has
    less than ``keys_from`` characters.
    """
    docs = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    bands = [f"k{b}" for b in range(BANDS if width else 0)]
    names = ["doc_id", "text_hash", "pos", "h1", "h2", *["norm"][: int(texts)], *bands]
    kinds = [kind, "bigint", "int", "bigint", "bigint", *["string"][: int(texts)], *["bigint" for _ in bands]]

    def found(batch: pa.RecordBatch, column: list) -> Iterator[pa.RecordBatch]:
        """The lines of a few documents."""
        owners, places, norms = [], [], []
        for i, text in enumerate(column):
            for pos, line in enumerate((text or "").split("\n")):
                line = normal(line)
                if len(line) >= min_chars:
                    owners.append(i)
                    places.append(pos)
                    norms.append(line)
        digests = b"".join(xxhash.xxh3_128_digest(n.encode("utf-8", "surrogatepass")) for n in norms)
        halves = np.frombuffer(digests, "<i8").reshape(-1, 2)
        out = [
            *[batch.column(c).take(pa.array(owners, pa.int64())) for c in ("doc_id", "text_hash")],
            pa.array(places, pa.int32()), *[pa.array(halves[:, k], pa.int64()) for k in (0, 1)],
        ]
        if texts:
            out.append(pa.array(norms, pa.string()))
        if width:
            long = np.array([len(n) >= keys_from for n in norms], bool)
            some = [n for n in norms if len(n) >= keys_from]
            keys = np.zeros((len(norms), BANDS), np.int64)
            if some:
                keys[long] = np.concatenate([band_keys(some[a:b], width) for a, b in _runs(list(map(len, some)))]).view(np.int64)
            out += [pa.array(keys[:, b], pa.int64(), mask=~long) for b in range(BANDS)]
        yield pa.RecordBatch.from_arrays(out, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                few = batch.slice(at, 256)
                yield from found(few, few.column("text").to_pylist())

    return docs.mapInArrow(run, ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True)))


def with_set_keys(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` with the band keys of the hashes in ``column`` (array<bigint>, never empty) in its place."""
    kind = ", ".join("`keys` array<bigint>" if f.name == column else f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = batch.column(column)
            hashes, counts = sets.flatten().to_numpy().view(np.uint64), sets.value_lengths().to_numpy().astype(np.int64)
            ends = np.cumsum(counts)
            keys = [set_keys(hashes[ends[a] - counts[a] : ends[b - 1]], counts[a:b]) for a, b in _runs(counts.tolist())]
            flat = pa.array(np.concatenate(keys).view(np.int64).ravel() if keys else np.zeros(0, np.int64))
            offsets = pa.array(np.arange(len(counts) + 1, dtype=np.int32) * BANDS)
            found = pa.ListArray.from_arrays(offsets, flat)
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays(
                [found if n == column else batch.column(n) for n in names], ["keys" if n == column else n for n in names]
            )

    return rows.mapInArrow(run, kind)


def similar(one: list[str], other: list[str], width: int) -> np.ndarray:
    """Whether the sets of shingles of each pair of lines (at most PAIRS) have a Jaccard similarity of 0.8 or more."""
    index = {line: i for i, line in enumerate(dict.fromkeys([*one, *other]))}
    hashes, counts = shingle_hashes(list(index), width)
    # the set of each line once, in order: its number above, the hash below
    sets = np.sort(np.repeat(np.arange(len(index), dtype=np.uint64), counts) << VALUE | hashes >> np.uint64(11))
    sets = sets[np.concatenate([[True], sets[1:] != sets[:-1]])]
    sizes = np.bincount((sets >> VALUE).astype(np.int64), minlength=len(index))
    starts = np.cumsum(sizes) - sizes
    values = sets & np.uint64((1 << 53) - 1)

    def laid(side: list[str]) -> tuple[np.ndarray, np.ndarray]:
        which = np.fromiter((index[line] for line in side), np.int64, len(side))
        n = sizes[which]
        at = np.repeat(starts[which] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return n, np.repeat(np.arange(len(side), dtype=np.uint64), n) << VALUE | values[at]

    (n_one, first), (n_other, second) = laid(one), laid(other)
    met = second[np.minimum(np.searchsorted(second, first), len(second) - 1)] == first
    shared = np.bincount((first[met] >> VALUE).astype(np.int64), minlength=len(one))
    return 10 * shared >= 8 * (n_one + n_other - shared)


def with_similar_pairs(pairs: DataFrame, width: int) -> DataFrame:
    """src, dst of the rows (src, dst, a, b) whose lines ``a`` and ``b`` are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, other = (batch.column(c).to_pylist() for c in "ab")
            sizes = [len(a) + len(b) for a, b in zip(one, other, strict=True)]
            good = [similar(one[i:j], other[i:j], width) for i, j in _runs(sizes, PAIRS)]
            keep = pa.array(np.concatenate(good) if good else [], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("src", "dst")], ["src", "dst"])

    return pairs.select("src", "dst", "a", "b").mapInArrow(run, "src bigint, dst bigint")
