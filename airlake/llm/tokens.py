"""Encoding whole texts with a given tokenizer, at the speed of its distinct words.

White space never belongs to a token of a tokenizer whose pre-tokenizer drops it, so the ids of a text are those of its
space-separated pieces in order, and of a simple piece those of its words. Texts are cut by numpy, many at once; Arrow finds the
distinct words, and each worker keeps the ids of those it has met in two bounded tables.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain, filterfalse

import numpy as np

CACHED_WORDS = 400_000  # of about 200 bytes, in each of two tables
LONGEST_CACHED = 48  # characters; longer words are encoded each time
AT_ONCE = 4 << 20  # bytes of texts cut at once; a longer text is cut alone
# Pieces of ASCII and Latin-1 letters, without apostrophes and angle brackets: splitting and lowering them is simple.
PLAIN = re.compile(r"[!-&(-;=?-~À-ÖØ-öø-ÿ]+\Z")
SPACE, LETTER, DIGIT, OTHER, ODD = range(5)
LATIN = 0xC3  # the byte before those of À to ÿ, of which two are no letters
NO_LETTERS = (0x97, 0xB7)  # × and ÷


def _kinds() -> np.ndarray:
    kinds = np.full(256, ODD, np.uint8)
    kinds[33:127] = OTHER
    kinds[list(b"'<>")] = ODD
    kinds[[*range(65, 91), *range(97, 123), LATIN]] = LETTER
    kinds[48:58] = DIGIT
    kinds[[*range(9, 14), 32]] = SPACE
    return kinds


KINDS = _kinds()
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def byte_characters() -> dict[int, str]:
    """The printable characters that stand for bytes in byte-level vocabularies: themselves, the rest from 256 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in kept)
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(others)}


class PieceEncoder:
    """Ids as little-endian unsigned 32-bit bytes, so that texts are put together by joining.

    Plain pieces are cut into words by kinds of bytes and the words looked up in the tokenizer's model; all others go
    through the whole tokenizer. ``simple_words`` tells that the tokenizer lowers, splits and maps bytes that way (it is tested
    on a sample of pieces when the encoder is made).
    """

    PROBE = ("The", "it.", "Éléve,", "x1.25", "naïve;", "ÜBER!!", "a-b_c", "(q)", "ñandú", "3,14%", "$$$", "í")

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.cached = cached
        self.table: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # the table before it was last full; what is met again moves back
        self.characters = byte_characters()
        whole = b"".join(self._ids(list(self.PROBE)))
        self.simple_words = True
        self.simple_words = whole == b"".join(map(self.encode, self.PROBE))
        self.table.clear()

    def _ids(self, pieces: list[str]) -> Iterator[bytes]:
        for at in range(0, len(pieces), 4096):
            for e in self.tokenizer.encode_batch_fast(pieces[at : at + 4096], add_special_tokens=False):
                yield np.array(e.ids, "<u4").tobytes()

    def _word_ids(self, words: list[str]) -> Iterable[bytes]:
        """The ids of words of plain pieces, straight from the model."""
        mapped = [w if w.isascii() else "".join(map(self.characters.__getitem__, w.encode())) for w in words]
        tokens = [[t.id for t in self.model.tokenize(w)] for w in mapped]
        raw = np.fromiter(chain.from_iterable(tokens), "<u4").tobytes()
        ends = (4 * np.cumsum(list(map(len, tokens)), dtype=np.int64)).tolist()
        return (raw[a:b] for a, b in zip([0, *ends], ends, strict=False))

    def _learn(self, new: list[str]) -> None:
        """Add the ids of words and pieces that the table lacks."""
        plain = list(filter(PLAIN.match, new)) if self.simple_words else []
        hard = list(filterfalse(PLAIN.match, new)) if self.simple_words else new
        self.table.update(zip(plain, self._word_ids(plain), strict=True))
        self.table.update(zip(hard, self._ids(hard), strict=True))

    def _cut(self, data: np.ndarray, bounds: np.ndarray):
        """An Arrow array of the words of texts that follow one another in ``data``, and how many lie before each bound.

        Plain pieces are cut into runs of letters, single digits and runs of other characters, in lower case; other pieces
        stay as they are.
        """
        import pyarrow as pa

        kind = KINDS[data]
        latin = np.flatnonzero(data[:-1] == LATIN) + 1
        kind[latin] = np.where(np.isin(data[latin], NO_LETTERS), ODD, LETTER)
        if not self.simple_words:
            kind[kind != SPACE] = ODD
        low = LOWER[data]
        low[latin] += np.where((data[latin] <= 0x9E) & (data[latin] != NO_LETTERS[0]), 32, 0).astype(np.uint8)
        solid = kind != SPACE
        begins = bounds[:-1][bounds[:-1] < bounds[1:]]
        first = solid.copy()  # of a piece
        first[1:] &= ~solid[:-1]
        first[begins] = solid[begins]
        new = np.ones(len(data), bool)  # of a word
        np.not_equal(kind[1:], kind[:-1], out=new[1:])
        new |= (kind == DIGIT) | first
        new &= solid
        odd = np.flatnonzero(kind == ODD)
        if len(odd):
            number = np.cumsum(first, dtype=np.int32)
            strange = np.zeros(number[-1] + 1, bool)
            strange[number[odd]] = True
            whole = strange[number] & solid
            new &= ~whole | first
            low = np.where(whole, data, low)
        offsets = np.flatnonzero(new[solid])
        letters = low[solid]
        offsets = np.append(offsets, len(letters)).astype(np.int32)
        words = pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(letters))
        return words, np.searchsorted(np.flatnonzero(new), bounds)

    def _some(self, data: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        words, before = self._cut(data, bounds)
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        table, older = self.table, self.older
        new = [w for w in distinct if w not in table]
        if older:
            table.update((w, older.pop(w)) for w in new if w in older)
            new = [w for w in new if w not in table]
        self._learn(new)
        lists = id_list([table[w] for w in distinct]).take(coded.indices)
        for word in new:
            if len(word) > LONGEST_CACHED:
                del table[word]
        if len(table) > self.cached // 2:
            self.table, self.older = {}, table if len(table) <= self.cached else {}
        ids = lists.flatten().to_numpy().astype("<i4", copy=False).tobytes()
        ends = (4 * lists.offsets.to_numpy().astype(np.int64))[before].tolist()
        return [ids[a:b] for a, b in zip(ends, ends[1:], strict=False)]

    def encode_all(self, texts) -> Iterator[bytes]:
        """The ids of each text of an Arrow string column (null: empty)."""
        import pyarrow as pa

        texts = texts.cast(pa.large_string()).fill_null("")
        if not len(texts):
            return
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        buffer = texts.buffers()[2]
        data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + AT_ONCE, "right")) - 1)
            yield from self._some(data[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at])
            at = to

    def encode(self, text: str | None) -> bytes:
        import pyarrow as pa

        return next(self.encode_all(pa.array([text], pa.string())))


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One encoder for each tokenizer file in a worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def id_list(parts: list[bytes]):
    """An Arrow list<int32> column of the ids held in each of ``parts``."""
    import pyarrow as pa

    ends = np.cumsum([0, *[len(p) // 4 for p in parts]])
    values = np.frombuffer(b"".join(parts), "<u4").view("<i4")
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))


def crcs(column) -> list[int]:
    """Unsigned crc32 of the little-endian 32-bit ids of each list of an Arrow list<int32> column."""
    from zlib import crc32

    ends = column.offsets.to_numpy()
    raw = column.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
    return [crc32(raw[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
