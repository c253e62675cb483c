"""Character n-grams and words of whole texts, as hashed features for the text classifiers."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

SPREAD, STEP, FOLD = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(15)
#: Letters of a word that its own feature takes up; longer words have their n-grams besides.
LONG_WORD = 24
#: First and last code points of letters of scripts that put no space between words.
UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))
#: Sizes of the n-grams of runs of letters that are no single words.
RUN_SIZES = (1, 2, 3, 4, 5, 6)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def letters_only(text: str) -> tuple[np.ndarray, bool]:
    """Lower-cased code points with one space for each run of other characters; whether there is a letter."""
    points = code_points(f" {text.lower()} ")
    letter = _letters()[points]
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    kept[0] = True
    return np.where(letter, points, np.uint32(32))[kept], bool(letter.any())


class Presence:
    """Distinct slots of a text's features; holds a scratch table of one entry per slot."""

    def __init__(self, sizes: tuple[int, ...], slot_bits: int):
        self.sizes, self.shift = sizes, np.uint32(32 - slot_bits)
        self.mark = np.zeros(1 << slot_bits, np.int32)

    def _slot(self, hashed: np.ndarray, kind: int) -> np.ndarray:
        return ((hashed ^ (hashed >> FOLD)) * SPREAD + np.uint32(kind * int(STEP) & 0xFFFFFFFF)) >> self.shift

    def _distinct(self, every: np.ndarray) -> np.ndarray:
        order = np.arange(len(every), dtype=np.int32)
        self.mark[every] = order
        return every[self.mark[every] == order].astype(np.int32)

    def slots(self, points: np.ndarray) -> np.ndarray:
        """Of all n-grams of the sizes."""
        base = _mixed(points)
        hashed, found = base, []
        for n in range(1, max(self.sizes) + 1):
            if n > 1:
                hashed = hashed[:-1] * STEP + base[n - 1 :]
            if len(hashed) == 0:
                break
            if n in self.sizes:
                found.append(self._slot(hashed, n))
        return self._distinct(np.concatenate(found).astype(np.intp))

    def word_slots(self, texts: list[np.ndarray]) -> list[np.ndarray]:
        """Per text, of the words and of their beginnings of the sizes, for a batch of texts.

        A run longer than ``LONG_WORD``, or with a letter of a script without spaces, is more than
        a word: the n-grams of ``RUN_SIZES`` at all its places are features too.
        """
        if not texts:
            return []
        points = np.concatenate([*texts, np.array([32], np.uint32)])
        base = _mixed(points)
        spaces = np.flatnonzero(points == 32)
        at, length = spaces[:-1] + 1, np.diff(spaces) - 1
        at, length = at[length > 0], length[length > 0]
        owner = np.searchsorted(np.cumsum([len(t) for t in texts]), at, side="right").astype(np.uint16)
        hashed, found, owners = np.zeros(len(at), np.uint32), [], []
        self._run_slots(points, base, at, length, owner, found, owners)
        for n in range(1, LONG_WORD + 1):
            hashed = hashed * STEP + base[at + (n - 1)]
            ends = (length == n) | (n == LONG_WORD)
            found.append(self._slot(hashed[ends] + length[ends].astype(np.uint32), 0))
            owners.append(owner[ends])
            more = ~ends
            at, length, hashed, owner = at[more], length[more], hashed[more], owner[more]
            if not len(at):
                break
            if n in self.sizes:
                found.append(self._slot(hashed, n))
                owners.append(owner)
        owner = np.concatenate(owners)
        every = np.concatenate(found).astype(np.intp)[np.argsort(owner, kind="stable")]
        ends = np.cumsum(np.bincount(owner, minlength=len(texts)))
        return [self._distinct(every[a:b]) for a, b in zip(ends - np.diff(ends, prepend=0), ends, strict=True)]


    def _run_slots(
        self, points: np.ndarray, base: np.ndarray, at: np.ndarray, length: np.ndarray, owner: np.ndarray,
        found: list[np.ndarray], owners: list[np.ndarray],
    ) -> None:
        """Add the n-grams at every place of the runs that are more than words."""
        runs = length > LONG_WORD
        if len(points) and points.max() >= UNSPACED[0][0]:
            unspaced = np.zeros(len(points), bool)
            for low, high in UNSPACED:
                unspaced |= (points >= low) & (points <= high)
            until = np.concatenate([[0], np.cumsum(unspaced)])
            runs |= until[at + length] > until[at]
        at, length, owner = at[runs], length[runs], owner[runs]
        if not len(at):
            return
        place = np.repeat(at - np.cumsum(length) + length, length) + np.arange(length.sum())
        left, owner = np.repeat(at + length, length) - place, np.repeat(owner, length)
        hashed = np.zeros(len(place), np.uint32)
        for n in RUN_SIZES:
            fits = left >= n
            place, left, owner, hashed = place[fits], left[fits], owner[fits], hashed[fits]
            hashed = hashed * STEP + base[place + (n - 1)]
            found.append(self._slot(hashed, 16 + n))
            owners.append(owner)


def _mixed(points: np.ndarray) -> np.ndarray:
    spread = points * SPREAD
    return spread ^ (spread >> FOLD)


def sums(weights: np.ndarray, slots: list[np.ndarray]) -> np.ndarray:
    """The product of the texts' sparse presence matrix with ``weights``, a row per text.

    ``weights`` is a vector, or a matrix stored by columns.
    """
    columns = weights[:, None] if weights.ndim == 1 else weights
    out = np.zeros((len(slots), columns.shape[1]))
    sizes = np.array([len(s) for s in slots], np.int64)
    full = np.flatnonzero(sizes)
    if len(full):
        flat = np.concatenate([slots[i] for i in full])
        starts = np.cumsum(sizes[full]) - sizes[full]
        for j in range(columns.shape[1]):
            out[full, j] = np.add.reduceat(columns[:, j][flat], starts)
    return out[:, 0] if weights.ndim == 1 else out
