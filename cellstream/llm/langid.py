"""Language of texts by mixture inference over character trigrams.

Training counts hashed trigrams by language over all labelled texts. A text is seen as a mixture:
every trigram comes from one of the languages. Expectation-maximisation finds the proportions of
most likelihood over all languages; sets of the languages of largest proportion are refitted, and
the set is chosen by likelihood less a penalty for each language beyond the first.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(i).isalpha() for i in range(0x110000)]))
    return _letters[0]


def trigrams(text: str | None, bits: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Hashed trigrams of a lower-cased text and their counts, all that isn't a letter being one space; None if it has no letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _is_letter()[codes]
    if not letter.any():
        return None
    codes = np.where(letter, codes, 32)
    keep = np.ones(len(codes), bool)
    keep[1:] = letter[1:] | letter[:-1]
    codes = np.concatenate(([32], codes[keep], [32])).astype(np.uint32)
    h = codes[:-2] * np.uint32(0x9E3779B1) + codes[1:-1] * np.uint32(0x85EBCA77) + codes[2:] * np.uint32(0xC2B2AE3D)
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(32 - bits)
    if len(h) < 1 << (bits - 3):
        return np.unique(h, return_counts=True)
    n = np.bincount(h, minlength=1 << bits)
    at = np.flatnonzero(n)
    return at, n[at]


def train(labelled: DataFrame, bits: int = 16, smoothing: float = 0.5) -> tuple[list[str], np.ndarray]:
    """Languages, sorted, and float32 probabilities by trigram and language; from columns text and lang, all rows of which count.

    Tasks add up their own rows, so at most 2 ** bits rows a language and task are shuffled. What
    reaches the driver is the model, of 2 ** bits rows a language at most, whatever the input's size.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for part in parts:
            for lang, text in zip(part["lang"], part["text"]):
                if (found := trigrams(text, bits)) is not None:
                    total.setdefault(lang, np.zeros(1 << bits, np.int64))[found[0]] += found[1]
        for lang, n in total.items():
            at = np.flatnonzero(n)
            yield pd.DataFrame({"lang": lang, "gram": at, "n": n[at]})

    counts = labelled.select("lang", "text").mapInPandas(run, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counts["lang"].unique())
    table = np.full((1 << bits, len(langs)), smoothing)
    np.add.at(table, (counts["gram"].to_numpy(np.int64), counts["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(np.int64)), counts["n"].to_numpy(float))
    return langs, (table / table.sum(0)).astype(np.float32) if langs else table.astype(np.float32)


def _fit(p: np.ndarray, n: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    """Proportions by expectation-maximisation, and the log-likelihood; p: trigrams x languages."""
    w = np.full(p.shape[1], 1 / p.shape[1])
    for _ in range(rounds):
        w = w * (p.T @ (n / (p @ w))) / n.sum()
    return w, float(n @ np.log(p @ w))


def infer(found: tuple[np.ndarray, np.ndarray], table: np.ndarray, penalty: float, rounds: int) -> tuple[int, float, np.ndarray]:
    """The first language, its proportion, and all proportions under the chosen set.

    Sets of the first 1, 2, ... languages by proportion are tried, up to where even the likelihood of all languages together
    wouldn't make up for the penalty.
    """
    p, n = table[found[0]].astype(np.float64), found[1].astype(np.float64)
    single = n @ np.log(p)
    best = np.zeros(table.shape[1])
    best[single.argmax()] = 1.0
    top = single.max()
    if len(best) > 1:
        share, of_all = _fit(p, n, rounds)
        order, each = np.argsort(-share, kind="stable"), penalty * math.log(n.sum() + 1)
        for k in range(2, len(best) + 1):
            if of_all - each * (k - 1) <= top:
                break
            w, ll = _fit(p[:, order[:k]], n, rounds)
            if (ll := ll - each * (k - 1)) > top:
                top, best = ll, np.zeros(len(best))
                best[order[:k]] = w
    return int(best.argmax()), float(min(1.0, best.max())), best


def languages(docs: DataFrame, train_rows: Column, bits: int = 16, penalty: float = 4.0, rounds: int = 12) -> DataFrame:
    """One row per row of docs: doc_id, lang_pred, score, proportions (map of languages to parts of 1).

    docs: doc_id, text, lang; train_rows: which rows may be learned from (those of non-null lang
    are). lang_pred is a learned value, or `und` where text is null or has no letter, or nothing was
    learned; score is the predicted language's proportion, 0 for `und`. penalty: log-likelihood that
    a further language has to gain, for each log of the number of trigrams; a text may have any number of languages, and
    is taken whole, however long. Repeated rows get a row
    each; a null doc_id stays null; other columns don't matter; an empty table gives no rows.
    """
    langs, table = train(docs.where(train_rows & F.col("lang").isNotNull()).select("text", "lang"), bits)
    model = docs.sparkSession.sparkContext.broadcast((langs, table))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        langs, table = model.value
        for part in parts:
            out = []
            for doc_id, text in zip(part["doc_id"], part["text"]):
                found = trigrams(text, bits) if langs else None
                if found is None:
                    out.append((doc_id, "und", 0.0, {}))
                else:
                    i, score, w = infer(found, table, penalty, rounds)
                    out.append((doc_id, langs[i], score, {langs[j]: float(w[j]) for j in np.flatnonzero(w)}))
            yield pd.DataFrame(out, columns=["doc_id", "lang_pred", "score", "proportions"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInPandas(run, "doc_id long, lang_pred string, score double, proportions map<string, double>")
