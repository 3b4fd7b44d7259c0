"""Near-duplicate documents by SetSketch registers.

Every document's set of word shingles is hashed once. Register i keeps the smallest of the set's
exponential variates under hash i, on an exponential scale with base BASE and truncated to
0..STEPS + 1: registers of parts of a set merge by max, and equal registers are the more likely
the more two sets overlap. Bands of registers propose pairs, the registers of a pair give a
likelihood estimate of its similarity, and what isn't far below the threshold is confirmed on
full sets.

Candidates are never all pairs of a bucket. First every document is held against the smallest
member it shares a bucket with, then against the smallest member of each of its buckets, and only
members of a bucket that are still in different components are considered further (see _rest); a
link inside a component that is known already can't change the result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, discard, each_part, mixed, parts_of, salt, stored
from .components import components

BASE, RATE, STEPS = 1.02, 20.0, 1022
_WORDS = WordHashes()
_MULTIPLIERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def shingle_hashes(text: str | None, words_per_shingle: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles; A-Z are lower-cased, words end at ASCII white space."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter((_WORDS[w] for w in words), np.uint64, len(words))
    k = min(words_per_shingle, len(words))
    s = np.full(len(h) - k + 1, k if k < words_per_shingle else 0, np.uint64)
    for i in range(k):
        s = mixed(s + h[i : len(h) - k + 1 + i])
    return np.unique(s)


def registers(hashes: np.ndarray, m: int) -> np.ndarray:
    """The m registers of a set, uint16; zeros for the empty set."""
    if not len(hashes):
        return np.zeros(m, np.uint16)
    if m not in _MULTIPLIERS:
        r = np.random.RandomState(20_011)
        _MULTIPLIERS[m] = (r.randint(0, 1 << 31, m).astype(np.uint32) * np.uint32(2) + np.uint32(1), r.randint(0, 1 << 32, m).astype(np.uint32))
    a, b = _MULTIPLIERS[m]
    low = np.full(m, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(hashes), 512):
        part, half = hashes[at : at + 512], m // 2
        for own, x in ((slice(0, half), part), (slice(half, m), part >> np.uint64(32))):
            low[own] = np.minimum(low[own], (a[own, None] * x.astype(np.uint32) + b[own, None]).min(1))
    x = -np.log1p(-(low.astype(np.float64) + 0.5) * 2.0**-32)
    return np.clip(np.floor(1 - np.log(np.maximum(x / RATE, 1e-300)) / np.log(BASE)), 0, STEPS + 1).astype(np.uint16)


def estimate(above: np.ndarray, below: np.ndarray, equal: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The similarity of most likelihood for pairs of sets of n_a and n_b elements, given how many registers of a are above, below and equal b's."""
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    j = np.linspace(0.0, 1.0, 201)[None, :] * np.minimum(u / v, v / u)[:, None]
    up, down = p(u[:, None] - v[:, None] * j), p(v[:, None] - u[:, None] * j)
    log = lambda x: np.log(np.maximum(x, 1e-12))
    ll = above[:, None] * log(up) + below[:, None] * log(down) + equal[:, None] * log(1 - up - down)
    return j[np.arange(len(j)), ll.argmax(1)]


def _sketched(docs: DataFrame, words: int, m: int, rows: int) -> DataFrame:
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for doc_id, text_key, text in zip(part["doc_id"], part["text_key"], part["text"]):
                s = shingle_hashes(text, words)
                k = registers(s, m)
                bands = k.reshape(-1, rows).astype(np.uint64)
                key = np.arange(len(bands), dtype=np.uint64) + np.uint64(1)
                for i in range(rows):
                    key = mixed(key * np.uint64(0x100000001B3) + bands[:, i])
                h1 = int(s.sum(dtype=np.uint64).view(np.int64))
                h2 = int(mixed(s ^ np.uint64(0xA5A5)).sum(dtype=np.uint64).view(np.int64))
                out.append((doc_id, text_key, len(s), h1, h2, k.tobytes(), key.view(np.int64)))
            yield pd.DataFrame(out, columns=["doc_id", "text_key", "n_shingles", "h1", "h2", "sketch", "bands"])

    text = F.col("text").cast("string")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), text.alias("text"))
    return plain.mapInPandas(run, "doc_id long, text_key long, n_shingles long, h1 long, h2 long, sketch binary, bands array<long>")


def text_key() -> Column:
    """What tells rows of one doc_id apart."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _beside(pairs: DataFrame, side: Callable[[str], DataFrame]) -> DataFrame:
    """Pairs (a, b), a stored table, with the columns of both sides; an id of many pairs is spread by the other id."""
    dealt = pairs.withColumn("salt_a", salt("b")).withColumn("salt_b", salt("a"))
    for c in ("b", "a"):
        dealt = dealt.join(pairs.select(c, salt("a" if c == "b" else "b").alias(f"salt_{c}")).distinct().join(side(c), c), [c, f"salt_{c}"])
    return dealt


def _likely(pairs: DataFrame, sketches: DataFrame, threshold: float, margin: float) -> DataFrame:
    """Pairs (a, b) whose sizes allow the threshold and whose estimate isn't more than the margin below it."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for at in range(0, len(part), 1024):
                p = part.iloc[at : at + 1024]
                x, y = (np.stack([np.frombuffer(s, np.uint16) for s in p[c]]) for c in ("sa", "sb"))
                j = estimate((x > y).sum(1), (x < y).sum(1), (x == y).sum(1), p["na"].to_numpy(float), p["nb"].to_numpy(float))
                yield p.loc[j >= threshold - margin, ["a", "b"]]

    side = lambda c: sketches.select(F.col("doc_id").alias(c), F.col("n_shingles").alias(f"n{c}"), F.col("sketch").alias(f"s{c}"))
    sized = _beside(pairs, side).where(F.least("na", "nb") >= F.lit(threshold - 1e-9) * F.greatest("na", "nb"))
    return sized.mapInPandas(run, "a long, b long")


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs with both texts, rows of one a together."""
    side = lambda c: texts.select(F.col("doc_id").alias(c), F.col("text").alias(f"t{c}"))
    return _beside(pairs, side).select("a", "b", "ta", "tb")


def _confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (u, v) of which 100 * intersection is at least percent * union, on full sets."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, own = None, np.empty(0, np.uint64)
        for p in parts:
            keep = []
            for a, ta, tb in zip(p["a"], p["ta"], p["tb"]):
                if last is None or last != (a, ta):
                    last, own = (a, ta), shingle_hashes(ta, words)
                other = shingle_hashes(tb, words)
                both = len(np.intersect1d(own, other, assume_unique=True))
                keep.append(both > 0 and 100 * both >= percent * (len(own) + len(other) - both))
            yield p.loc[keep, ["a", "b"]].rename(columns={"a": "u", "b": "v"})

    return _with_texts(pairs, texts).mapInPandas(run, "u long, v long")


def _against(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """For pairs (a, b): b as doc_id, a as anchor, n (b's set size), k (size of the intersection) and diff, b's hashes that a lacks."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, anchor = None, np.empty(0, np.uint64)
        for p in parts:
            out = []
            for a, b, ta, tb in zip(p["a"], p["b"], p["ta"], p["tb"]):
                if last is None or last != (a, ta):
                    last, anchor = (a, ta), shingle_hashes(ta, words)
                own = shingle_hashes(tb, words)
                diff = np.setdiff1d(own, anchor, assume_unique=True)
                out.append((b, a, len(own), len(own) - len(diff), diff.view(np.int64)))
            yield pd.DataFrame(out, columns=["doc_id", "anchor", "n", "k", "diff"])

    return _with_texts(pairs, texts).mapInPandas(run, "doc_id long, anchor long, n long, k long, diff array<long>")


def _rest(at: DataFrame, texts: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Pairs (a, b) of documents that share a bucket but no component and may be linked: sure to be confirmed next, and to be estimated first; and the tables that both read.

    In a crowd of variants of one text, those that are too far from it are held against nobody one
    by one. Each document gets an anchor: the smallest of the component that has the most members in
    a bucket of its own. With k the elements it has in common with the anchor, two documents of one anchor
    have min(k, k') elements in common at most, and what both have beyond the anchor. So they
    can be linked only if min(k, k') is large enough by itself, or if they share elements that the
    anchor lacks, which are found by these elements.

    A bucket's members of its main component meet only those outside of it.
    """
    by_part = at.groupBy("bucket", "component").agg(F.count("*").alias("n"), parts_of(F.col("salt")).alias("salts"))
    by_bucket = by_part.groupBy("bucket").agg(F.count("*").alias("parts"), F.max(F.struct("n", F.negative("component").alias("c"))).alias("main"), F.bit_or("salts").alias("salts")).where("parts > 1")
    main = by_bucket.select("bucket", "main", "salts", each_part("salts").alias("salt"))
    left = stored(at.drop("salts").join(main, ["bucket", "salt"]).select("bucket", "salt", "doc_id", "component", "main", "salts"), "split")
    anchors = left.groupBy("doc_id").agg(F.max("main").alias("main"), F.first("component").alias("component")).select(F.negative("main.c").alias("a"), F.col("doc_id").alias("b"), "component")
    anchors = stored(anchors, "anchors")
    held = _against(anchors.select("a", "b"), texts, words).join(anchors.select(F.col("b").alias("doc_id"), "component"), "doc_id")
    held = stored(held, "anchored")

    side = lambda x: [F.col(c).alias(f"{c}_{x}") for c in ("doc_id", "component", "anchor", "n", "k")]
    # 100 * both >= percent * (n + n' - both)
    enough = lambda both: (100 + percent) * both >= percent * (F.col("n_a") + F.col("n_b"))
    sized = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    apart = (F.col("component_a") != F.col("component_b")) & sized
    same = F.col("anchor_a") == F.col("anchor_b")
    in_bucket = left.join(held.drop("diff", "component"), "doc_id")
    outside = in_bucket.where(F.col("component") != F.negative("main.c"))
    one = outside.select("bucket", *side("a"), each_part("salts").alias("salt"))
    two = in_bucket.select("bucket", "salt", *side("b"), (F.col("component") == F.negative("main.c")).alias("is_main"))
    # Two members that are both outside are met once.
    once = F.col("is_main") | (F.col("doc_id_a") < F.col("doc_id_b"))
    by_anchor = same & enough(F.least("k_a", "k_b"))
    met = one.join(two, ["bucket", "salt"]).where(once & apart & (~same | by_anchor))
    met = met.select(F.least("doc_id_a", "doc_id_b").alias("a"), F.greatest("doc_id_a", "doc_id_b").alias("b"), same.alias("same")).distinct()

    beyond = held.select("doc_id", "component", "anchor", "n", "k", F.explode("diff").alias("element"))
    room = F.least(F.col("n_a") - F.col("k_a"), F.col("n_b") - F.col("k_b"))  # the most that both can have beyond the anchor
    found = beyond.select(*side("a"), "element").join(
        beyond.select(*side("b"), F.col("element").alias("element_b")),
        same & (F.col("element") == F.col("element_b")) & (F.col("doc_id_a") < F.col("doc_id_b")) & apart & enough(room + F.least("k_a", "k_b")),
    )
    found = found.groupBy("doc_id_a", "doc_id_b", "n_a", "n_b", "k_a", "k_b").agg(F.count("*").alias("both")).where(enough(F.col("both") + F.least("k_a", "k_b")))
    met = stored(met, "met")
    discard(left, anchors)
    sure = met.where("same").select("a", "b").unionAll(found.select(F.col("doc_id_a").alias("a"), F.col("doc_id_b").alias("b"))).distinct()
    return sure, met.where("not same").select("a", "b"), [met, held]


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, m: int = 294, rows: int = 7, margin: float = 0.15) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept, text_key (xxhash64 of the text).

    docs needs doc_id and text; other columns don't matter. Two documents are linked if
    100 * |A n B| >= percent * |A u B| for their sets of distinct word shingles (the whole sequence
    as one, if shorter). m registers in bands of `rows`: a pair at similarity 0.8 misses all bands
    with a probability of about 5e-5. margin: pairs whose estimate is further than that below the threshold aren't verified; an
    estimate of 0.8 from 294 registers deviates by about 0.023, so that is over six deviations. component_id is the smallest doc_id reachable by links.

    Null and empty texts have empty sets and link with nothing; exact copies and texts of equal
    sets are one class from the start, so copies cost no pairs; rows with a null doc_id are kept,
    with a null component_id; repeated rows each get their row, and rows of one doc_id are one document,
    whose texts' links add up. A text of any length has one sketch of m registers; only texts of documents
    that share a bucket are shuffled, whole. An empty table gives no rows.
    """
    named = stored(_sketched(docs, words, m, rows), "sketches")
    sets = named.where("n_shingles > 0 and doc_id is not null")
    key = ["h1", "h2", "n_shingles"]
    salted = sets.withColumn("salt", salt("doc_id"))
    of_key = salted.select(*key, "doc_id", "salt").groupBy(*key).agg(F.min("doc_id").alias("rep"), parts_of(F.col("salt")).alias("salts"))
    classes = stored(of_key, "classes")
    reps = salted.join(classes.select(*key, "rep", salt("rep").alias("salt")), [*key, "salt"]).where("doc_id = rep").drop("rep").dropDuplicates([*key, "doc_id"])
    bucketed = reps.select("doc_id", "salt", F.explode("bands").alias("bucket"))
    shared = bucketed.groupBy("bucket").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), parts_of(F.col("salt")).alias("salts")).where("first < last")
    buckets = stored(bucketed.join(shared.select("bucket", "first", "salts", each_part("salts").alias("salt")), ["bucket", "salt"]), "buckets")
    sketches = reps.select("doc_id", "n_shingles", "sketch")

    # The texts of documents that share a bucket, so that no later join moves the others.
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = stored(plain.join(buckets.select("doc_id").distinct(), "doc_id", "left_semi"), "texts")

    def confirm(pairs: DataFrame, name: str) -> DataFrame:
        met = stored(pairs, f"{name}-met")
        likely = stored(_likely(met, sketches, percent / 100, margin), f"{name}-likely")
        found = stored(_confirmed(likely, texts, words, percent).distinct(), name)
        discard(met, likely)
        return found

    def labelled(found: DataFrame) -> DataFrame:
        parts = components(found)
        return buckets.join(parts.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))

    links = confirm(buckets.groupBy("doc_id").agg(F.min("first").alias("a")).where("a <> doc_id").select("a", F.col("doc_id").alias("b")), "links")
    at = labelled(links)
    firsts = at.where("first = doc_id").select("bucket", F.col("component").alias("of_first"), each_part("salts").alias("salt"))
    star = at.join(firsts, ["bucket", "salt"]).where("component <> of_first").select(F.col("first").alias("a"), F.col("doc_id").alias("b")).distinct()
    stars = confirm(star, "stars")
    again = stored(labelled(links.unionAll(stars)), "labelled")
    discard(buckets)
    sure, other, read = _rest(again, texts, words, percent)
    left = stored(sure.unionAll(_likely(other, sketches, percent / 100, margin)).distinct(), "left")
    discard(again, *read)
    rest = stored(_confirmed(left, texts, words, percent), "rest")
    discard(left, texts)
    of_rep = components(links.unionAll(stars).unionAll(rest))
    discard(links, stars, rest)
    of_class = classes.join(of_rep, F.col("rep") == F.col("node"), "left").select(*key, F.coalesce("component", "rep").alias("component"), each_part("salts").alias("salt"))
    alone = named.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component"), "text_key")
    out = salted.join(of_class, [*key, "salt"]).select("doc_id", "n_shingles", "component", "text_key").unionAll(alone)
    return out.select("doc_id", "n_shingles", F.col("component").alias("component_id"), F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"), "text_key")
