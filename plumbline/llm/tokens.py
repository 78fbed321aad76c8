"""Byte-level byte-pair encoding of whole text columns with a public vocabulary file."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import CharDelimiterSplit

from plumbline.llm.text import flat, hash_spans, mix

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 4

# White space by Unicode, and the endings that the vocabulary's pattern splits off.
WHITE = (9, 10, 11, 12, 13, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")

KNOWN_WORDS = 1 << 19  # with their ids some twenty megabytes
KNOWN_IDS = 1 << 21
SENT_BYTES = 1 << 16  # the tokenizer holds some hundreds of bytes for each id it returns
APART = 10  # no printable character, so it stands for no byte


def byte_letters() -> dict[int, str]:
    """The printable characters that stand for bytes in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class BytePairEncoder:
    """Token ids of texts; distinct words go through the tokenizer's model many at a time, and those it has seen are remembered.

    Words are split as the vocabulary's own pattern does: an ending after an
    apostrophe, else runs of letters, numbers or other signs with one blank
    before them, else white space up to the last one before a word. At most
    KNOWN_WORDS words and KNOWN_IDS ids are kept from one call to the next.
    """

    def __init__(self, path: str):
        self.words = Tokenizer(Tokenizer.from_file(path).model)
        self.words.pre_tokenizer = CharDelimiterSplit(chr(APART))
        self.letters = np.array([ord(c) for _, c in sorted(byte_letters().items())], "<u4")
        self.kind = np.zeros(0x110000, np.uint8)
        self.number = np.arange(1, 0x110001, dtype=np.uint64)
        for block in np.split(self.number, range(1 << 16, 0x110000, 1 << 16)):  # in place, as copies of the whole would stay with the worker
            block[:] = mix(block * np.uint64(0x9E3779B97F4A7C15))
        self.forget()

    def forget(self) -> None:
        """Hashes of known words in order, where the ids of each begin in ``ids``, and how many they are."""
        self.known, self.begin, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)

    def kinds(self, points: np.ndarray) -> np.ndarray:
        new = np.unique(points[self.kind[points] == 0])
        for p in new.tolist():
            c = chr(p)
            self.kind[p] = (
                SPACE if p in WHITE else LETTER if regex.fullmatch(r"\p{L}", c) else NUMBER if regex.fullmatch(r"\p{N}", c) else OTHER
            )
        return self.kind[points]

    def starts(self, points: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Positions where a word of the pattern begins; ``rows`` are the offsets of the texts."""
        n = len(points)
        kind = np.zeros(n + 3, np.uint8)
        kind[:n] = self.kinds(points)
        points = np.concatenate((points, np.zeros(3, points.dtype)))
        edge = np.zeros(n + 3, bool)
        edge[rows] = True
        edge[n:] = True
        run = edge.copy()
        run[1:] |= kind[1:] != kind[:-1]
        start = run.copy()
        # the last white space before a word stands alone or, if it is a blank, belongs to the word
        word = np.flatnonzero(run[1:n] & ~edge[1:n] & (kind[1:n] != SPACE) & (kind[: n - 1] == SPACE)) + 1 if n > 1 else np.zeros(0, np.int64)
        start[word - 1] = True
        start[word[points[word - 1] == 32]] = False
        mark = np.flatnonzero(start[:n] & (points[:n] == 39))
        mark = mark[~edge[mark + 1] & (kind[mark + 1] == LETTER)]
        second = ~edge[mark + 2] & (kind[mark + 2] == LETTER)
        for ending in ENDINGS:
            hit = points[mark + 1] == ord(ending[0])
            if len(ending) == 2:
                hit &= second & (points[mark + 2] == ord(ending[1]))
            start[mark[hit] + 1] = False
            start[mark[hit] + 1 + len(ending)] = True
        return np.flatnonzero(start[:n])

    def tokenize(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words at these bytes, one after the other, and the number of ids of each word."""
        ids, sizes = [], []
        total = np.cumsum(ends - starts)
        i = 0
        while i < len(starts):
            j = max(int(np.searchsorted(total, total[i] - (ends[i] - starts[i]) + SENT_BYTES, "right")), i + 1)
            long = ends[i:j] - starts[i:j] + 1
            last = np.cumsum(long) - 1
            place = np.arange(last[-1] + 1) - np.repeat(last + 1 - long - starts[i:j], long)
            sent = self.letters[data[np.minimum(place, len(data) - 1)]]
            sent[last] = APART
            found = self.words.encode(sent.tobytes().decode("utf-32-le"), add_special_tokens=False)
            ids.append(np.array(found.ids, np.uint32))
            sizes.append(np.bincount(np.array(found.word_ids, np.int64), minlength=j - i))
            i = j
        return np.concatenate(ids), np.concatenate(sizes)

    def learn(self, keys: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        """Adds new words (hashes in order) to the known ones."""
        place = np.searchsorted(self.known, keys)
        self.known, self.size = np.insert(self.known, place, keys), np.insert(self.size, place, size)
        self.begin = np.insert(self.begin, place, len(self.ids) + np.cumsum(size) - size)
        self.ids = np.concatenate((self.ids, ids))

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        data, at = flat(texts)
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        rows = np.searchsorted(lead, at)
        points = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        starts = self.starts(points, rows)
        if not len(starts):
            return [np.zeros(0, np.uint32)] * len(texts)
        ends = np.append(starts[1:], len(points))
        keys, first, which = np.unique(hash_spans(points, starts, ends, self.number), return_index=True, return_inverse=True)
        if len(self.known) > KNOWN_WORDS or len(self.ids) > KNOWN_IDS:
            self.forget()
        new = np.flatnonzero(~np.isin(keys, self.known, assume_unique=True))
        if len(new):
            byte = np.append(lead, len(data))
            self.learn(keys[new], *self.tokenize(data, byte[starts[first[new]]], byte[ends[first[new]]]))
        known = np.searchsorted(self.known, keys)[which]
        many = self.size[known]
        total = np.concatenate(([0], np.cumsum(many)))
        out = self.ids[np.arange(total[-1]) - np.repeat(total[:-1] - self.begin[known], many)]
        bounds = total[np.searchsorted(starts, rows)]
        return [out[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
