"""Periodic runs of words in texts, by a dictionary of basic factors.

For each power of two L, every stretch of L words has a name: equal stretches of a text have equal
names, and the names of length 2 L come from pairs of names of length L. A run of period q, where
L <= q < 2 L, holds two occurrences of a factor of length L at distance q. Occurrences of one factor
that are L / 2 or less apart lie in a stretch of a smaller period d <= L / 2 and follow each other at
distance d: an arithmetic progression. So it's enough to pair the last occurrence of each
progression with all later ones that are less than 2 L away; these form a bounded number of
progressions, whose members propose the periods. Why that misses none: if the progression that the
run's first factor is in ends more than q before the run does, its last factor recurs q further on;
else there is a last factor of a progression among the places from which both occurrences still lie
within the run. Both proposals lie in the run, and extending any of them, by the names of all
lengths, gives the whole run. A stretch that was proposed by a multiple of its smallest period is
proposed by that one, too, with the same ends, and the smallest one stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import grouped

RUN = "struct<start: bigint, length: bigint, period: bigint>"


def _names(of_text: np.ndarray, words: np.ndarray) -> list[np.ndarray]:
    """By level, a name for the factor of 2 ** level words that begins at each place; negative where it occurs once in its text."""

    def named(key: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        out = -1 - np.arange(n)  # all different
        _, name, count = np.unique(key, return_inverse=True, return_counts=True)
        out[at] = np.where(count[name] > 1, name, out[at])
        return out

    n = len(words)
    levels = [named(of_text * np.int64(words.max(initial=0) + 1) + words, np.arange(n), n)]
    while (step := 1 << len(levels) - 1) * 2 <= n:
        before = levels[-1]
        at = np.flatnonzero((before[:-step] >= 0) & (before[step:] >= 0))
        if not len(at):
            break
        levels.append(named(before[at] * np.int64(n) + before[at + step], at, n))
    return levels


def _proposed(names: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods proposed by the factors of one length."""
    at = np.flatnonzero(names >= 0)
    at = at[np.argsort(names[at], kind="stable")]
    name = names[at]
    gap = np.where(name[1:] == name[:-1], at[1:] - at[:-1], 4 * length)
    last = np.flatnonzero(np.append(2 * gap > length, True))  # of their progressions
    places, periods, ahead = [], [], 1
    while len(last := last[last + ahead < len(at)]):
        near = (name[last + ahead] == name[last]) & (at[last + ahead] - at[last] < 2 * length)
        last = last[near]  # what is too far away stays so
        places.append(at[last])
        periods.append(at[last + ahead] - at[last])
        ahead += 1
    return np.concatenate(places or [at[:0]]), np.concatenate(periods or [at[:0]])


def runs_of(texts: list[list[bytes]], least: int = 12, repeats: int = 2) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, start, length and smallest period of every maximal run of at least `least` words and `repeats` periods, ordered so."""
    sizes = np.array([len(t) for t in texts])
    words = pd.factorize(np.array([w for t in texts for w in t], object))[0].astype(np.int64)
    of_text = np.repeat(np.arange(len(texts)), sizes)
    begins = np.concatenate(([0], np.cumsum(sizes)))
    n, empty = len(words), np.empty(0, np.int64)
    if not n:
        return empty, empty, empty, empty
    # Names with margins on both sides that equal nothing, so that places may be looked up beyond the ends.
    levels = _names(of_text, words)
    wide = [np.concatenate((x, [-n - 2 - k])) for k, x in enumerate(levels)]
    found = [_proposed(x, 1 << k) for k, x in enumerate(levels)]
    place, period = (np.concatenate([f[i] for f in found]) for i in (0, 1))
    order = np.lexsort((place, period))
    place, period = place[order], period[order]
    new = np.append(True, (np.diff(period) != 0) | (np.diff(place) > 1))[: len(place)]  # neighbours of one period are in one run
    place, period = place[new], period[new]
    left, right = place.copy(), place.copy()  # words left .. right - 1 equal those a period later
    while len(place):
        grown = np.zeros(len(place), bool)
        for k in range(len(levels) - 1, -1, -1):
            same = wide[k][np.minimum(right, n)] == wide[k][np.minimum(right + period, n)]
            same &= right + period < n
            right += same << k
            back = left - (1 << k)
            equal = (back >= 0) & (wide[k][np.maximum(back, 0)] == wide[k][np.minimum(np.maximum(back, 0) + period, n)])
            left -= equal << k
            grown |= same | equal
        if not grown.any():
            break
    length = right + period - left
    keep = length >= np.maximum(least, repeats * period)
    left, length, period = left[keep], length[keep], period[keep]
    order = np.lexsort((period, length, left))
    left, length, period = left[order], length[order], period[order]
    smallest = np.append(True, (np.diff(left) != 0) | (np.diff(length) != 0))[: len(left)]
    left, length, period = left[smallest], length[smallest], period[smallest]
    text = of_text[left] if len(left) else empty
    start = left - begins[text]
    order = np.lexsort((period, start, text))
    return text[order], start[order], length[order], period[order]


def _kept(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Of n words, those that are in no run after its first period."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, start + length, -1)
    return np.cumsum(depth[:-1]) == 0


def collapsed(docs: DataFrame, least: int = 12, repeats: int = 2, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of `keep`, runs (start, length, period by start, then period; in words from 0), text (words of runs' first periods and outside of runs, joined by a space).

    Words end at ASCII white space. A run is a stretch of words with smallest period q, of at least `least` words and
    `repeats` periods, that can't be extended. Nothing is shuffled; a task works on a group of texts of about a million
    characters at once, or on one longer text alone, in memory in proportion to it. Null and empty texts, and such
    without words, have no runs and the text "". Repeated rows get a row each, a null doc_id stays null, other columns
    don't matter, an empty table gives no rows.
    """
    columns = list(keep)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            texts = part["text"].tolist()
            for own in grouped(texts):
                words = [(t or "").encode().split() for t in texts[own]]
                of, start, length, period = runs_of(words, least, repeats)
                out = part.iloc[own][columns].copy()
                ends = np.searchsorted(of, np.arange(len(words) + 1))
                found, left = [], []
                for i, (ws, a, b) in enumerate(zip(words, ends, ends[1:])):
                    found.append([{"start": s, "length": n, "period": p} for s, n, p in zip(start[a:b].tolist(), length[a:b].tolist(), period[a:b].tolist())])
                    if b > a:
                        ws = [ws[j] for j in np.flatnonzero(_kept(len(ws), start[a:b], length[a:b], period[a:b]))]
                    left.append(b" ".join(ws).decode())
                out["runs"], out["text"] = found, left
                yield out

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    plain = docs.select(*[F.col(c) for c in columns], F.col("text").cast("string").alias("text"))
    return plain.mapInPandas(run, ", ".join(f"`{c}` {kinds[c]}" for c in columns) + f", runs array<{RUN}>, text string")
