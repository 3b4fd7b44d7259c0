"""Quality of texts by weak labels: heuristic labellers, their accuracies by expectation-maximisation, and a hashed linear scorer.

Every labeller votes good, bad or not at all. What the labellers say of all documents is counted by
vote pattern, of which there is a fixed number; on these counts expectation-maximisation finds each
labeller's accuracy on good and on bad texts and the share of good ones, without any labelled row.
The posteriors label a bounded sample of documents, on which a logistic model over hashed shapes of
words learns what the labellers mean; it scores every document.

Toxicity is a class of its own, which form can't outvote: a labeller by words that are learned from labelled texts, whose
vote is the last one, takes the score and posterior of what it finds to 0. No word decides alone: it takes two of them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import grouped, mixed, powers, words_of

LABELLERS = ("symbols", "plain_words", "separators", "letters", "repeats", "variety", "sentences", "word_length")
GOOD, BAD, NONE = 1, 0, -1
_WORD = re.compile(r"\w+")


LETTER, MARK, END = 1, 2, 4
_tables: list[np.ndarray] = []
_lexicons: dict[frozenset[str], "Lexicon"] = {}


def _character_tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: what a character is, and what stands for it in a word's shape (of 1, 2 and 3, letters and digits, a run is one)."""
    if not _tables:
        points = list(map(chr, range(0x110000)))
        kind = np.array([LETTER * c.isalpha() | MARK * (not c.isalnum() and c not in ".,;:!?'\"()-") | END * (c in ".!?:;") for c in points], np.uint8)
        shape = np.ones(0x110000, np.uint8)
        shape[:128] = np.arange(128)
        for low, high, stands in (("a", "z", 1), ("A", "Z", 2), ("0", "9", 3)):
            shape[ord(low) : ord(high) + 1] = stands
        _tables.extend((kind, shape))
    return _tables[0], _tables[1]


class Lexicon:
    """Words, and stems of longer words, found in texts by one automaton."""

    def __init__(self, terms: frozenset[str]):
        self.words = frozenset(t[:-1] for t in terms if t.endswith("$"))
        self.stems = frozenset(t for t in terms if not t.endswith("$"))
        self.automaton = ahocorasick.Automaton()
        for w in self.words | self.stems:
            self.automaton.add_word(w, w)
        self.automaton.make_automaton()

    def count(self, text: str) -> int:
        """Words of the text that are of the lexicon or begin with one of its stems."""
        if not self.words and not self.stems:
            return 0
        low, starts = text.lower(), set()
        inner = lambda i: 0 <= i < len(low) and (low[i].isalnum() or low[i] == "_")
        for last, w in self.automaton.iter(low):
            first = last - len(w) + 1
            if not inner(first - 1) and w in (self.stems if inner(last + 1) else self.words):
                starts.add(first)
        return len(starts)


def _lexicon(terms: frozenset[str]) -> Lexicon:
    if terms not in _lexicons:
        _lexicons.clear()
        _lexicons[terms] = Lexicon(terms)
    return _lexicons[terms]


def terms_of(word: str) -> list[str]:
    """What a word is known by: itself, marked as whole, and its stems of 5 to 8 letters."""
    return [word + "$"] + [word[:k] for k in range(5, 9) if len(word) > k]


def measured(texts: list[str | None], bits: int, lexicon: Lexicon | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The labellers' votes of each text, the one on insults last (without a lexicon: none); and its hashed features, as text number, index and weight.

    Features are the shares of word shapes, and of words that equal the word before and that have
    no letter, by the square root, so that rare ones count.
    """
    kind_of, shape_of = _character_tables()
    w = words_of(texts)
    votes = np.full((len(texts), len(LABELLERS) + 1), NONE)
    if not len(w.first):
        return votes, w.first, w.first, np.empty(0)
    kind = np.where(w.inside, kind_of[w.codes], 0)
    chars, doc, own, total = w.length, w.doc, w.hash, w.total
    letters = total((kind & LETTER).astype(np.int64))
    marks = total((kind & MARK != 0).astype(np.int64)) > 0
    stops = kind[w.first + chars - 1] & END != 0

    counted = lambda which, weights=None: np.bincount(which, weights, len(texts))
    n = counted(doc)
    size = np.maximum(n, 1)
    n_letters, n_chars, lone = counted(doc, letters), counted(doc, chars), counted(doc[letters == 0])

    again = counted(doc[1:][(own[1:] == own[:-1]) & (doc[1:] == doc[:-1])]) / size
    inner = doc[2:] == doc[:-2]
    triple = mixed(mixed(mixed(own[:-2].astype(np.uint64)) + own[1:-1].astype(np.uint64)) + own[2:].astype(np.uint64))
    # 48 bits of hash below the text's number.
    triple = np.sort(doc[2:][inner].astype(np.uint64) << np.uint64(48) | triple[inner] >> np.uint64(16))
    variety = counted((triple[np.diff(triple, prepend=~triple[:1]) != 0] >> np.uint64(48)).astype(np.int64)) / np.maximum(n - 2, 1)
    stands = shape_of[w.codes]
    runs = stands < 4
    runs[1:] &= (stands[1:] == stands[:-1]) & w.inside[:-1]
    runs[0] = False
    kept = np.flatnonzero(w.inside & ~runs)
    shape_first = np.searchsorted(kept, w.first)
    place = np.arange(len(kept)) - shape_first[w.of_char[kept]]
    parts = (stands[kept].astype(np.uint64) + np.uint64(1)) * powers(int(chars.max()), 0xD6E8FEB86659FD93)[place]
    shape = (mixed(np.add.reduceat(parts, shape_first)) >> np.uint64(64 - bits)).astype(np.int64)

    toxic = np.array([lexicon.count(t or "") if lexicon else 0 for t in texts])
    bad = (
        (counted(doc[marks]) > 0.2 * size, 1),
        (counted(doc[(letters > 0) & ~marks]) < 0.7 * size, 1),
        (lone > 0.15 * size, 5),
        (n_letters < 0.72 * n_chars, 1),
        (again > 0.15, 5),
        (variety < 0.6, 12),
        ((counted(doc[stops]) == 0) | (counted(doc[stops]) > 0.5 * size), 30),
        ((n_letters < 2 * size) | (n_letters > 12 * size), 12),
        # A word alone, or few in a long text, may be a quotation, a name or a harmless use.
        (toxic >= np.maximum(2, 0.005 * size), 1),
    )
    for k, (is_bad, least) in enumerate(bad):
        votes[:, k] = np.where(n < least, NONE, np.where(is_bad, BAD, GOOD))

    feature, count = np.unique(doc << bits | shape, return_counts=True)
    owner, some = feature >> bits, np.flatnonzero(n)
    index = np.concatenate((feature & (1 << bits) - 1, *[np.full(len(some), (1 << bits) + k) for k in (0, 1)]))
    weight = np.concatenate((np.sqrt(count / size[owner]), again[some], (lone / size)[some]))
    return votes, np.concatenate((owner, some, some)), index, weight


def _names(votes: np.ndarray) -> list[str]:
    """Votes as texts, a character for each labeller."""
    return ["".join(row) for row in np.array(list("?-+"))[votes + 1]]


def accuracies(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[float, np.ndarray]:
    """Share of good documents, and says_bad[class, labeller], by expectation-maximisation over vote patterns.

    Starts from labellers that find half of what is bad and blame one good text in fifty, which also
    says which class is good; a small prior keeps rates off 0 and 1. No vote says nothing.
    """
    says_bad = np.tile([[0.5], [0.02]], patterns.shape[1])
    share = 0.8
    for _ in range(rounds):
        good = posterior(patterns, share, says_bad)
        share = float(np.clip((counts @ good + 1) / (counts.sum() + 2), 1e-4, 1 - 1e-4))
        for c, w in ((0, counts * (1 - good)), (1, counts * good)):
            says_bad[c] = (w @ (patterns == BAD) + (0.5, 0.02)[c]) / (w @ (patterns != NONE) + 1)
    return share, says_bad


def posterior(patterns: np.ndarray, share: float, says_bad: np.ndarray) -> np.ndarray:
    """Probability that a text of each vote pattern is good."""
    ll = [np.log(1 - share), np.log(share)]
    for c in (0, 1):
        ll[c] = ll[c] + (patterns == BAD) @ np.log(says_bad[c]) + (patterns == GOOD) @ np.log1p(-says_bad[c])
    return 1 / (1 + np.exp(np.clip(ll[0] - ll[1], -500, 500)))


def fitted(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, size: int, decay: float = 1e-4, rounds: int = 300) -> np.ndarray:
    """Weights (the last one is the constant) of a logistic model on sparse rows, by accelerated full gradients."""
    x = np.concatenate([v for _, v in rows]) if rows else np.empty(0)
    col = np.concatenate([np.asarray(i, np.int64) for i, _ in rows]) if rows else np.empty(0, np.int64)
    row = np.repeat(np.arange(len(rows)), [len(i) for i, _ in rows])
    w, v = np.zeros(size + 1), np.zeros(size + 1)
    # Both classes weigh the same, or else few bad documents leave the model indifferent.
    each = np.where(target > 0.5, 0.5 / max(1, (target > 0.5).sum()), 0.5 / max(1, (target <= 0.5).sum()))
    for k in range(rounds):
        z = np.bincount(row, x * v[col], len(rows)) + v[-1]
        err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) * each
        new = v - 4.0 * (np.append(np.bincount(col, err[row] * x, size), err.sum()) + decay * v)
        v, w = new + k / (k + 3) * (new - w), new
    return w


def toxic_terms(labelled: DataFrame, least: int = 4, ratio: float = 50.0) -> frozenset[str]:
    """Words and stems that are in at least so many of the toxic texts, and in a share of them `ratio` times that of the others.

    labelled: text and toxic (0 or 1); rows without either don't count. Only terms that pass reach the driver.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for part in parts:
            for text, toxic in zip(part["text"], part["toxic"]):
                words = set(_WORD.findall(text.lower()))
                seen.update((t, toxic) for t in set(chain.from_iterable(map(terms_of, words))))
        yield pd.DataFrame([(t, n if x else 0, 0 if x else n) for (t, x), n in seen.items()], columns=["term", "toxic", "other"])

    rows = labelled.select(F.col("text").cast("string").alias("text"), (F.col("toxic") > 0).cast("int").alias("toxic")).where("text is not null and toxic is not null")
    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    by_term = rows.mapInPandas(run, "term string, toxic long, other long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    often = (F.col("toxic") + 0.5) / (n.get(1, 0) + 1) > F.lit(ratio) * (F.col("other") + 0.5) / (n.get(0, 0) + 1)
    return frozenset(r["term"] for r in by_term.where((F.col("toxic") >= least) & often).select("term").collect())


def quality(docs: DataFrame, bits: int = 12, sample: int = 5_000, threshold: float = 0.5, toxic: DataFrame | None = None) -> DataFrame:
    """docs with votes, posterior (by the votes), score (by the linear scorer) and kept (score >= threshold).

    docs: doc_id and text, and any other columns, which are kept unless they clash with the new ones;
    those are replaced. All documents count for the labellers' accuracies. sample: rows that the
    linear scorer is fitted on at most, those of the smallest hashes of doc_id and text. toxic: labelled texts (text,
    toxic), a bounded number of them, from which the labeller of insults learns its words (toxic_terms); without them it finds nothing.

    votes: a character for each of LABELLERS, and one for insults; toxic documents have posterior and score 0.

    A null or empty text, or one of white space alone, has no votes and no features: its score is
    the scorer's for nothing but the constant, 0 here, and it is rejected. Texts of any length are measured whole.
    Repeated rows get equal scores; a null doc_id is no obstacle; an empty table gives no rows.
    """
    size = (1 << bits) + 2
    terms = docs.sparkSession.sparkContext.broadcast(toxic_terms(toxic) if toxic is not None else frozenset())

    def patterns_of(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for part in parts:
            for group in map(part["text"].tolist().__getitem__, grouped(part["text"])):
                seen.update(_names(measured(group, bits, None)[0][:, :-1]))
        yield pd.DataFrame(list(seen.items()), columns=["votes", "n"])

    def features(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for group in map(part["text"].tolist().__getitem__, grouped(part["text"])):
                votes, owner, at, weight = measured(group, bits, None)
                order = np.argsort(owner, kind="stable")
                ends = np.cumsum(np.bincount(owner, minlength=len(group)))[:-1]
                yield pd.DataFrame({"votes": _names(votes[:, :-1]), "at": np.split(at[order], ends), "weight": np.split(weight[order], ends)})

    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_votes, w = model.value
        for part in parts:
            names, posteriors, scores = [], [], []
            texts = part.column("text").to_pylist()
            for group in map(texts.__getitem__, grouped(texts)):
                votes, owner, at, weight = measured(group, bits, _lexicon(terms.value))
                fit = (np.bincount(owner, minlength=len(group)) > 0) & (votes[:, -1] != BAD)
                z = np.bincount(owner, w[at] * weight, len(group)) + w[-1]
                own = _names(votes)
                names += own
                posteriors += [0.0 if v[-1] == "-" else by_votes.get(v[:-1], 0.0) for v in own]
                scores += np.where(fit, 1 / (1 + np.exp(-np.clip(z, -700, 700))), 0.0).tolist()
            new = [pa.array(x, kind) for x, kind in ((names, pa.string()), (posteriors, pa.float64()), (scores, pa.float64()))]
            yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, "votes", "posterior", "score"])

    text = F.col("text").cast("string")
    counts = docs.select(text.alias("text")).mapInPandas(patterns_of, "votes string, n long").groupBy("votes").agg(F.sum("n").alias("n")).toPandas()
    patterns = np.array([["?-+".index(c) - 1 for c in p] for p in counts["votes"]], np.int64).reshape(-1, len(LABELLERS))
    share, says_bad = accuracies(patterns, counts["n"].to_numpy(float)) if len(counts) else (0.5, np.full((2, len(LABELLERS)), 0.5))
    by_votes = dict(zip(counts["votes"], posterior(patterns, share, says_bad).tolist())) if len(counts) else {}
    some = docs.select(F.xxhash64("doc_id", text).alias("key"), text.alias("text")).where(F.length(F.trim("text")) > 0)
    last = some.select("key").distinct().orderBy("key").limit(sample).agg(F.max("key")).first()[0]
    chosen = some.where(F.col("key") <= F.lit(last)).dropDuplicates(["key"]).repartition(16)
    fit_on = chosen.mapInPandas(features, "votes string, at array<int>, weight array<double>").toPandas()
    w = fitted(list(zip(fit_on["at"], fit_on["weight"])), fit_on["votes"].map(by_votes).to_numpy(float), size)
    model = docs.sparkSession.sparkContext.broadcast((by_votes, w))
    plain = docs.drop("votes", "posterior", "score", "kept").withColumn("text", text)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    return plain.mapInArrow(score, f"{schema}, votes string, posterior double, score double").withColumn("kept", F.col("score") >= threshold)
