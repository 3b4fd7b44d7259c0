"""Collocations: phrases whose words occur together more often than their parts let expect, by weighted automata.

A task cuts its texts into shards. A shard's n-grams are sorted and give an acyclic automaton built
in that order: its arcs are words, its paths phrases, and the weight of a state is the count of the
phrase that leads there. Automata are split by prefix
range, a hash range of a phrase's first three words, so that each phrase is in one range and a
frequent word or pair of words is spread over many. Automata of one range are united, which sums the
weights, so counts are whole there. The counts of parts come by composition: the automaton of the
parts that are asked for with that of the counts, range by range.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import each_part, mixed, parts_of, salt, stored

DEPTH = 4
BREAK = b"\xff"  # is in no UTF-8 text
#: Marks that end a piece of text become BREAK between blanks.
ENDS = bytes(0xFF if c in b".,;:!?\n\x0b\x0c\r" else c for c in range(256))


def _summed(ids: np.ndarray, weights: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Different rows of ids in order, with the sums of their weights."""
    if not len(ids):
        return ids, weights
    bits = max(1, int(words).bit_length())
    if ids.shape[1] * bits <= 63:
        key = ids[:, 0].copy()
        for d in range(1, ids.shape[1]):
            key = (key << bits) | ids[:, d]
        order = np.argsort(key, kind="stable")  # what comes in sorted stretches is merged
        key = key[order]
        new = np.append(True, key[1:] != key[:-1])
    else:
        order = np.lexsort(ids.T[::-1])
        rows = ids[order]
        new = np.append(True, (rows[1:] != rows[:-1]).any(axis=1))
    first = np.flatnonzero(new)
    return ids[order[first]], np.add.reduceat(weights[order], first)


@dataclass
class Automaton:
    """words: in byte order, of numbers from 1. By depth: how many arcs leave each state of the depth above, their words, the weights of the states they lead to (0: no phrase ends there)."""

    words: list[bytes]
    arcs: list[tuple[np.ndarray, np.ndarray, np.ndarray]]

    @classmethod
    def built(cls, ids: np.ndarray, weights: np.ndarray, words: list[bytes]) -> Automaton:
        """From different phrases in order, as rows of word numbers that zeros fill up. A state is closed when the next phrase leaves it."""
        arcs, states = [], 1
        above = np.zeros(len(ids), np.int64)  # the state that each phrase has come to
        for d in range(depth := ids.shape[1]):
            longer = ids[:, d] > 0
            ids, weights, above = ids[longer], weights[longer], above[longer]
            new = np.append(True, (ids[1:, d] != ids[:-1, d]) | (above[1:] != above[:-1]))[: len(ids)]
            first = np.flatnonzero(new)
            ends = ids[first, d + 1] == 0 if d + 1 < depth else np.ones(len(first), bool)
            arcs.append((np.bincount(above[first], minlength=states), ids[first, d], np.where(ends, weights[first], 0)))
            above, states = np.cumsum(new) - 1, len(first)
        return cls(words, arcs)

    def phrases(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows of word numbers and weights of all phrases, those of one length together."""
        paths, found, weights = np.zeros((1, len(self.arcs)), np.int64), [], []
        for d, (children, word, weight) in enumerate(self.arcs):
            paths = np.repeat(paths, children, axis=0)
            paths[:, d] = word
            found.append(paths[weight > 0])
            weights.append(weight[weight > 0])
        return np.concatenate(found), np.concatenate(weights).astype(np.int64)

    @classmethod
    def united(cls, automata: list[Automaton]) -> Automaton:
        """All phrases of all, with the sums of their weights."""
        if len(automata) == 1:
            return automata[0]
        words, places = _one_vocabulary([a.words for a in automata])
        rows, weights = [], []
        for a, place in zip(automata, places):
            ids, w = a.phrases()
            rows.append(place[ids])
            weights.append(w)
        ids, total = _summed(np.concatenate(rows), np.concatenate(weights), len(words))
        return cls.built(ids, total, words)

    def composed(self, asked: Automaton) -> tuple[np.ndarray, np.ndarray]:
        """The phrases of `asked`, as rows of its word numbers, with this automaton's weights; 0 for those it hasn't."""
        number = {w: i + 1 for i, w in enumerate(self.words)}
        own = np.array([0] + [number.get(w, 0) for w in asked.words])
        base = len(self.words) + 1
        state, here, paths, found, weights = np.zeros(1, np.int64), np.ones(1, bool), np.zeros((1, DEPTH), np.int64), [], []
        for d, ((children, word, weight), (theirs, asked_word, wanted)) in enumerate(zip(self.arcs, asked.arcs)):
            mine = np.repeat(np.arange(len(children)), children) * base + word  # in order, as states and arcs are
            paths, state, here = np.repeat(paths, theirs, axis=0), np.repeat(state, theirs), np.repeat(here, theirs)
            paths[:, d] = asked_word
            key = state * base + own[asked_word]
            at = np.minimum(np.searchsorted(mine, key), max(len(mine) - 1, 0))
            here = here & (own[asked_word] > 0) & (mine[at] == key if len(mine) else False)
            state = np.where(here, at, 0)
            found.append(paths[wanted > 0])
            weights.append(np.where(here, weight[at] if len(weight) else 0, 0)[wanted > 0])
        return np.concatenate(found), np.concatenate(weights)

    def dumped(self) -> bytes:
        """Compact bytes, with the words that are in use only."""
        used = np.unique(np.concatenate([a[1] for a in self.arcs]))
        place = np.zeros(len(self.words) + 1, np.int64)
        place[used] = np.arange(1, len(used) + 1)
        small = lambda x: x.astype(np.min_scalar_type(int(x.max(initial=0))))
        arcs = [(small(n), small(place[w]), small(x)) for n, w, x in self.arcs]
        return zlib.compress(pickle.dumps((b" ".join([self.words[i] for i in (used - 1).tolist()]), arcs), 5), 1)

    @classmethod
    def loaded(cls, dumped: bytes) -> Automaton:
        words, arcs = pickle.loads(zlib.decompress(dumped))
        return cls(words.split(b" "), [tuple(x.astype(np.int64) for x in level) for level in arcs])

    @classmethod
    def of(cls, phrases: list[str], weights: np.ndarray) -> Automaton:
        """From phrases in any order, repeats summed."""
        rows = [p.encode().split(b" ") for p in phrases]
        words, places = _one_vocabulary(rows)
        ids = np.zeros((len(rows), DEPTH), np.int64)
        for i, p in enumerate(places):
            ids[i, : len(p) - 1] = p[1:]
        ids, total = _summed(ids, weights, len(words))
        return cls.built(ids, total, words)

    def spelled(self, ids: np.ndarray) -> list[str]:
        words = [b""] + self.words
        return [b" ".join(words[i] for i in row if i).decode() for row in ids.tolist()]


def _one_vocabulary(lists: list[list[bytes]]) -> tuple[list[bytes], list[np.ndarray]]:
    """All words in order, and for each list the numbers of its words, 0 before them."""
    code, unique = pd.factorize(np.array([w for words in lists for w in words], object))
    order = sorted(range(len(unique)), key=unique.__getitem__)
    number = np.empty(len(unique), np.int64)
    number[order] = np.arange(1, len(unique) + 1)
    ends = np.cumsum([len(words) for words in lists])
    all_numbers = number[code]
    return [unique[i] for i in order], [np.append(0, all_numbers[e - len(words) : e]) for words, e in zip(lists, ends)]


def _range_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """The range of phrases by the hashes of their first three words, 0 for words that aren't there."""
    x = mixed(hashes[:, 0])
    for d in (1, 2):
        x = mixed(x + hashes[:, d]) if d < hashes.shape[1] else mixed(x)
    return (x % np.uint64(ranges)).astype(np.int64)


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.array([0] + [xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)


class Filter:
    """A Bloom filter of pairs of words, of 2 ** bits bits whatever the number of pairs: it may take a pair for one of its own, but never misses one."""

    def __init__(self, words: np.ndarray):
        self.words, self.bits = words, int(len(words) * 64).bit_length() - 1

    @staticmethod
    def places(first: np.ndarray, second: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Two places for each pair of word hashes."""
        x = mixed(mixed(first) + second)
        y = mixed(x)
        return (x >> np.uint64(64 - bits)), (y >> np.uint64(64 - bits))

    def has(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        ok = np.ones(len(first), bool)
        for at in self.places(first, second, self.bits):
            ok &= (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return ok


def _frequent_pairs(counts: DataFrame, bits: int) -> np.ndarray:
    """The words of the filter of all phrases of two words, of whatever language; 2 ** bits / 8 bytes come to the driver at most."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            pairs = [x.encode().split(b" ") for x in p["phrase"]]
            at = np.concatenate(Filter.places(_hashes([a for a, _ in pairs])[1:], _hashes([b for _, b in pairs])[1:], bits))
            yield pd.DataFrame({"word": (at >> np.uint64(6)).astype(np.int64), "value": (np.uint64(1) << (at & np.uint64(63))).astype(np.int64)})

    found = counts.where("words = 2").select("phrase").mapInPandas(run, "word long, value long").groupBy("word").agg(F.bit_or("value").alias("value")).toPandas()
    out = np.zeros(1 << bits - 6, np.uint64)
    out[found["word"].to_numpy(np.int64)] = found["value"].to_numpy(np.int64).astype(np.uint64)
    return out


def _tokens(texts: list[str]) -> tuple[np.ndarray, list[bytes]]:
    """The words of texts as numbers from 1, 0 where a piece ends, and the words in order."""
    joined = b"\n".join([t.encode() for t in texts]).lower().translate(ENDS).replace(BREAK, b" " + BREAK + b" ")
    code, unique = pd.factorize(np.array(joined.split(), object))
    order = sorted((i for i in range(len(unique)) if unique[i] != BREAK), key=unique.__getitem__)
    number = np.zeros(len(unique), np.int64)
    number[order] = np.arange(1, len(order) + 1)
    return number[code], [unique[i] for i in order]


def shard(texts: list[str], ranges: int, pairs: Filter | None = None) -> tuple[int, Iterator[tuple[int, bytes]]]:
    """The number of words, and automata by range: without pairs, of phrases of one and two words; with it, of three and four words whose neighbours are pairs of the filter."""
    c, words = _tokens(texts)
    base, hashes = len(words) + 1, _hashes(words)
    n = int((c > 0).sum())
    if pairs is None:
        both = (c[:-1] > 0) & (c[1:] > 0)
        key, weights = np.unique(np.concatenate((c[c > 0] * base, c[:-1][both] * base + c[1:][both])), return_counts=True)
        phrases = np.stack((key // base, key % base), axis=1)
    else:
        near = np.flatnonzero((c[:-1] > 0) & (c[1:] > 0))
        ok = np.zeros(len(c) + DEPTH, bool)  # whether a frequent pair begins here
        ok[near[pairs.has(hashes[c[near]], hashes[c[near + 1]])]] = True
        three = np.flatnonzero(ok[:-1] & ok[1:])
        four = three[ok[three + 2]]
        phrases = np.zeros((len(three) + len(four), DEPTH), np.int64)
        for d in range(DEPTH):
            phrases[len(three) :, d] = c[four + d]
            if d < 3:
                phrases[: len(three), d] = c[three + d]
        phrases, weights = _summed(phrases, np.ones(len(phrases), np.int64), len(words))

    def parts() -> Iterator[tuple[int, bytes]]:
        at = _range_of(hashes[phrases[:, : DEPTH - 1]], ranges)
        order = np.argsort(at, kind="stable")
        ends = np.searchsorted(at[order], np.arange(ranges + 1))
        for r in np.flatnonzero(np.diff(ends)).tolist():
            own = order[ends[r] : ends[r + 1]]
            yield r, Automaton.built(phrases[own], weights[own], words).dumped()

    return n, parts()


def _shards(docs: DataFrame, ranges: int, size: int, pairs: np.ndarray | None) -> DataFrame:
    """lang, range, n (words of the shard, in one of its rows), automaton."""
    sent = None if pairs is None else docs.sparkSession.sparkContext.broadcast(pairs)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keep = sent and Filter(sent.value)
        held: dict[str, list[str]] = {}
        chars: dict[str, int] = {}

        def put(lang: str) -> Iterator[pd.DataFrame]:
            n, automata = shard(held.pop(lang), ranges, keep)
            chars.pop(lang)
            for r, automaton in automata:
                yield pd.DataFrame({"lang": [lang], "range": [r], "n": [n], "automaton": [automaton]})
                n = 0

        for part in parts:
            for lang, text in zip(part["lang"], part["text"]):
                held.setdefault(lang, []).append(text)
                chars[lang] = chars.get(lang, 0) + len(text)
                if chars[lang] >= size:
                    yield from put(lang)
                elif sum(chars.values()) >= 3 * size:
                    yield from put(max(chars, key=chars.__getitem__))
        for lang in list(held):
            yield from put(lang)

    return docs.mapInPandas(run, "lang string, range long, n long, automaton binary")


def _united(shards: DataFrame, least: int) -> DataFrame:
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        whole = Automaton.united([Automaton.loaded(x) for x in group["automaton"]])
        ids, f = whole.phrases()
        ids, f = ids[f >= least], f[f >= least]
        n = int(group["n"].sum())
        total = ([None], [0], [n]) if n else ([], [], [])
        phrase, words, f = (own + more for own, more in zip((whole.spelled(ids), (ids > 0).sum(axis=1).tolist(), f.tolist()), total))
        return pd.DataFrame({"lang": pd.Series([key[0]] * len(f), dtype=object), "phrase": pd.Series(phrase, dtype=object), "words": words, "f": f})

    return shards.groupBy("lang", "range").applyInPandas(run, "lang string, phrase string, words int, f long")


def frequent(docs: DataFrame, least: int = 30, ranges: int | None = None, size: int = 8_000_000, bits: int = 26) -> DataFrame:
    """lang, phrase, words (1 to 4), f of all phrases that occur `least` times or more; with words = 0, phrase null and f the number of all words, a row per lang.

    First come phrases of one and two words, then those of three and four of whose pairs of neighbours none is known to be rarer:
    a phrase is no more frequent than any pair in it. What's known is a filter of 2 ** bits bits at any size of the input; the
    fuller it is, the more phrases are counted in vain. ranges: prefix ranges of a language, by default one for 16 MB of text and
    no fewer than shuffle partitions; size: characters of a shard.
    """
    t = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text")).where("octet_length(text) > 0")
    if ranges is None:
        total = t.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        ranges = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // (16 << 20))
    short = stored(_united(_shards(t, ranges, size, None), least), "short-phrases")
    long = stored(_united(_shards(t, ranges, size, _frequent_pairs(short, bits)), least).where("words > 0"), "long-phrases")
    return short.unionByName(long)


def _counted_parts(asked: DataFrame, counts: DataFrame, ranges: int) -> DataFrame:
    """asked (lang, phrase, cut, first, part) with the counts f of their parts, by composition within ranges.

    Single words may be part of very many phrases, so what asks for them is spread over parts of a range, and their counts go to each of these.
    """

    def ranged(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            rows = [x.encode().split(b" ") for x in p["part"]]
            words, places = _one_vocabulary(rows)
            ids = np.zeros((len(rows), DEPTH), np.int64)
            for i, x in enumerate(places):
                ids[i, : len(x) - 1] = x[1:]
            p["range"] = _range_of(_hashes(words)[ids[:, : DEPTH - 1]], ranges)
            yield p

    def with_range(t: DataFrame) -> DataFrame:
        return t.mapInPandas(ranged, t.select("*", F.lit(0).cast("long").alias("range")).schema)

    asks = asked.withColumn("salt", F.when(F.contains("part", F.lit(" ")), 0).otherwise(salt("phrase")))
    wanted = asks.groupBy("lang", "part").agg(parts_of(F.col("salt")).alias("parts"))
    has = counts.where("words between 1 and 3").select("lang", F.col("phrase").alias("part"), "f").join(wanted, ["lang", "part"]).withColumn("salt", each_part("parts")).drop("parts")
    asks, has = with_range(asks), with_range(has)

    def run(a: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(c):
            return pd.DataFrame(columns=["lang", "phrase", "cut", "first", "f"])
        wanted = Automaton.of(a["part"].tolist(), np.ones(len(a), np.int64))
        ids, f = Automaton.of(c["part"].tolist(), c["f"].to_numpy()).composed(wanted)
        found = dict(zip(wanted.spelled(ids), f.tolist()))
        return a[["lang", "phrase", "cut", "first"]].assign(f=[found[x] for x in a["part"]])

    by = ["lang", "range", "salt"]
    return asks.groupBy(*by).cogroup(has.groupBy(*by)).applyInPandas(run, "lang string, phrase string, cut int, first boolean, f long")


def _wide(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(28, 0)")


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, covered: int = 80, ranges: int | None = None, size: int = 8_000_000) -> DataFrame:
    """The first `top` collocations of each language: lang, rank, phrase, a, l, r, n, score.

    A candidate is a phrase of 2 to 4 words within a piece of text (pieces end at . , ; : ! ? and line ends, words at blanks and
    tabs; A-Z are lower-cased) that occurs a >= least times. Its score is the least over its cuts into two parts of
    floor(2000000 a / (l + r)), l and r being the parts' counts; ties go to the earliest cut. Candidates within a longer one that
    occurs covered / 100 as often or more are left out. Order: score, a (both falling), phrase in byte order. n: words of the language.

    A null lang is `und`, null and empty texts have no words, repeated rows count each, other columns don't matter, an empty table
    gives no rows. All texts are counted; a task holds four shards at most, or one text, a group one prefix range.
    """
    counts = frequent(docs, least, ranges, size)
    candidates = counts.where("words >= 2").select("lang", "phrase", "words", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut")
    both = candidates.select("lang", "phrase", "w", "words", cut)
    part = lambda at, n: F.array_join(F.slice("w", at, n), " ")
    sides = F.explode(F.array(F.struct(F.lit(True).alias("first"), part(F.lit(1), F.col("cut")).alias("part")), F.struct(F.lit(False).alias("first"), part(F.col("cut") + 1, F.col("words") - F.col("cut")).alias("part"))))
    asked = both.select("lang", "phrase", "cut", sides.alias("s")).select("lang", "phrase", "cut", "s.first", "s.part")
    found = _counted_parts(asked, counts, 16 + counts.count() // 20_000)
    cuts = range(1, DEPTH)
    sums = found.groupBy("lang", "phrase").agg(*[F.max(F.when((F.col("cut") == k) & (F.col("first") == first), F.col("f"))).alias(f"{'l' if first else 'r'}{k}") for k in cuts for first in (True, False)])
    # A phrase within longer ones: the count of the most frequent of these.
    spans = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.col("words") - n + 1), lambda at: F.array_join(F.slice("w", at, n), " ")))))
    inner = candidates.where("words > 2").select("lang", "a", spans.alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    t = candidates.join(inner, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (_wide("longer") * 100 < _wide("a") * covered)).join(sums, ["lang", "phrase"])
    scored = [F.when(F.col(f"l{k}").isNotNull(), F.struct(F.call_function("div", _wide("a") * 2_000_000, _wide(f"l{k}") + _wide(f"r{k}")).alias("score"), F.lit(k).alias("cut"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))) for k in cuts]
    t = t.withColumn("best", F.array_min(F.array_compact(F.array(*scored)))).select("lang", "phrase", "a", "best.l", "best.r", "best.score", salt("phrase").alias("part"))
    order = "order by score desc, a desc, phrase"
    for by in ("lang, part", "lang"):  # the first of each part, then of all
        t = t.withColumn("rank", F.expr(f"row_number() over (partition by {by} {order})")).where(F.col("rank") <= top)
    n = counts.where("words = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    return t.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
