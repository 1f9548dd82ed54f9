"""Parts of Latin texts, cut and looked up by array operations.

A slice of texts is one array of bytes. Classes of bytes give where parts start and end, and a
part of up to 32 bytes is four integers, which are compared in full: no hash decides what is equal.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

LETTERS = [*range(97, 123), 0xAA, 0xB5, 0xBA, *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]
NUMBERS = [*range(48, 58), 0xB2, 0xB3, 0xB9, 0xBC, 0xBD, 0xBE]
SPACE, LETTER, NUMBER, OTHER = range(4)
WIDEST = 32

CLASSES = np.full(256, OTHER, np.uint8)
CLASSES[LETTERS] = LETTER
CLASSES[NUMBERS] = NUMBER
CLASSES[[9, 10, 13, 32]] = SPACE
#: Keeps the first n bytes of an integer.
FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def cut(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the parts of lower-cased texts that end in white space.

    Parts are runs of letters, single digits, runs of others, and the contractions 's 't 'm 'd 're 've 'll
    where an apostrophe starts a part; what follows a contraction is a part of its own.
    """
    kind = CLASSES[data]
    starts = np.empty(len(kind), bool)
    starts[:1] = True
    np.not_equal(kind[1:], kind[:-1], out=starts[1:])
    starts |= kind == NUMBER
    marks = np.flatnonzero((data == ord("'")) & starts)
    marks = marks[marks + 1 < len(data)]
    one, two = data[marks + 1], data[np.minimum(marks + 2, len(data) - 1)]
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    starts[marks[short | long] + 1] = False
    starts[marks[short] + 2] = True
    starts[marks[long] + 3] = True
    at = np.flatnonzero(starts)
    ends = np.append(at[1:], len(data))
    word = kind[at] != SPACE
    return at[word], ends[word]


def keys(data: bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each part's bytes as four integers; `data` goes on for `WIDEST` bytes after the last part."""
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    found = np.zeros((4, len(starts)), np.uint64)
    found[0] = eight[starts] & FIRST[np.minimum(lengths, 8)]
    for i in range(1, 4):
        some = np.flatnonzero(lengths > 8 * i)
        found[i, some] = eight[starts[some] + 8 * i] & FIRST[np.minimum(lengths[some] - 8 * i, 8)]
    return found


class LatinWords:
    """Ids of the parts of Latin texts met so far; `encode` gives the ids of new parts and how many each has."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        self.encode = encode
        self.clear()

    def __len__(self) -> int:
        return len(self.order)

    def clear(self) -> None:
        self.mixed = np.empty(0, np.uint64)  # sorted
        self.order = np.empty(0, np.int64)  # the number of the part of each of these
        self.parts = np.empty((4, 0), np.uint64)  # by number, as what follows
        self.ids = np.empty(0, "<i4")
        self.ends = np.zeros(1, np.int64)

    def of(self, texts: list[bytes]) -> list[bytes | None]:
        """The ids of each lower-cased text; none for a text with a part that is too wide."""
        if not texts:
            return []
        data = b"\n".join(texts) + b"\n" * (WIDEST + 8)
        bounds = np.cumsum([len(t) + 1 for t in texts])
        starts, ends = cut(np.frombuffer(data, np.uint8))
        lengths = ends - starts
        wide = np.unique(np.searchsorted(bounds, starts[lengths > WIDEST], side="right"))
        if len(wide):
            left = set(wide.tolist())
            done = iter(self.of([t for i, t in enumerate(texts) if i not in left]))
            return [None if i in left else next(done) for i in range(len(texts))]
        numbers = self.numbers(data, starts, lengths)
        if numbers is None:
            return [None] * len(texts)
        first = self.ends[numbers]
        sizes = self.ends[numbers + 1] - first
        places = np.concatenate([[0], np.cumsum(sizes)])
        raw = self.ids[np.arange(places[-1]) + np.repeat(first - places[:-1], sizes)].tobytes()
        cuts = (4 * places[np.searchsorted(starts, np.concatenate([[0], bounds]))]).tolist()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]

    def numbers(self, data: bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray | None:
        """Each part's number; new parts are encoded. None where two different parts mix to one integer."""
        parts = keys(data, starts, lengths)
        mixed = np.bitwise_xor.reduce(parts * MIX[:, None], axis=0)
        mixed ^= mixed >> np.uint64(29)
        distinct, one, back = np.unique(mixed, return_index=True, return_inverse=True)
        place = np.searchsorted(self.mixed, distinct)
        inside = np.minimum(place, len(self.mixed) - 1)
        met = self.mixed[inside] == distinct if len(self.mixed) else np.zeros(len(distinct), bool)
        number = np.empty(len(distinct), np.int64)
        number[met] = self.order[inside[met]]
        new = np.flatnonzero(~met)
        number[new] = len(self) + np.arange(len(new))
        known = np.concatenate([self.parts, parts[:, one[new]]], axis=1)
        numbers = number[back]
        if not np.array_equal(known[:, numbers], parts):
            return None
        if len(new):
            at = one[new]
            strings = [data[a:b].decode("latin-1") for a, b in zip(starts[at].tolist(), (starts[at] + lengths[at]).tolist())]
            ids, counts = self.encode(strings)
            self.mixed = np.insert(self.mixed, place[new], distinct[new])
            self.order = np.insert(self.order, place[new], number[new])
            self.parts = known
            self.ids = np.concatenate([self.ids, ids])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(counts)])
        return numbers
