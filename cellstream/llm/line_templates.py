"""Recurring lines by a tree of log templates.

Lines are parsed to a fixed depth: by their number of tokens, then by their leading tokens, tokens
with digits being variable from the start. Within such a leaf a token stays part of the template at
its position if enough different documents have it there; elsewhere the field is variable. A
template is recurring if enough documents that aren't copies of each other have it, and its lines
are dropped. Supports and recurrences are sums by key, and what is joined by leaf, line or template is
spread, so neither a common line nor a crowded leaf meets in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import let_go
from .common import discard, free_name, grouped, mixed, parts_of, powers, salt, spread_join, stored, words_of

#: What stands for a variable field: the hash of no word.
FIELD = np.uint64(0xF1E1D)
#: Hashes that tell documents from copies of each other, and how many of them copies have in common at least.
SKETCH, AGREE = 8, 3
#: Tokens up to which a line needs min_docs documents, and from which two are enough.
SHORT, LONG = 20, 50


def needed(n: np.ndarray, min_docs: int) -> np.ndarray:
    """Different documents that make a line of n tokens recurring: min_docs up to SHORT tokens, 2 from LONG on, in proportion between."""
    share = np.clip((n - SHORT) / (LONG - SHORT), 0.0, 1.0)
    return np.minimum(np.ceil(min_docs - (min_docs - 2) * share), min_docs).astype(np.int64)


class Lines:
    """The lines of a group of texts that have words: by line, its text (doc), number (line_no), count of words (n), first word and leaf; by word, its hash and token."""

    def __init__(self, texts: list[str | None], depth: int):
        w = words_of(texts)
        digit = w.total((w.codes - np.uint32(48) < 10).astype(np.int64)) > 0
        self.hash = mixed(w.hash)
        self.token = np.where(digit, FIELD, self.hash)
        ends = np.cumsum(w.codes == 10)
        line = ends[w.first]
        self.first = np.flatnonzero(np.diff(line, prepend=-1))
        self.n = np.diff(self.first, append=len(line))
        self.doc = w.doc[self.first]
        begins = np.cumsum([0] + [len(t or "") + 1 for t in texts])[:-1]
        before = np.where(begins > 0, ends[np.maximum(begins - 1, 0)], 0)
        self.line_no = line[self.first] - before[self.doc]
        self.leaf = mixed(self.n.astype(np.uint64))
        for k in range(depth):
            some = self.n > k
            self.leaf[some] = mixed(self.leaf[some] + self.token[self.first[some] + k])

    def whole(self, of_word: np.ndarray, start: np.ndarray) -> np.ndarray:
        """A hash of each line's words, in order."""
        if not len(self.n):
            return start
        of_line = np.repeat(np.arange(len(self.n)), self.n)
        at = np.arange(len(of_word)) - self.first[of_line]
        return mixed(start + np.add.reduceat(of_word * powers(int(self.n.max()))[at], self.first))

    def sketches(self, leaves: dict[int, set[int]]) -> dict[int, dict[int, np.ndarray]]:
        """By text of `leaves`, for each of its leaves there: the SKETCH least hashes of the text's word triples outside of lines of that leaf."""
        of_line = np.repeat(np.arange(len(self.n)), self.n)
        inner = of_line[2:] == of_line[:-2]
        triple = mixed(mixed(self.hash[:-2] + np.uint64(1)) + self.hash[1:-1])
        triple = mixed(triple + self.hash[2:])[inner]
        short = self.n < 3
        h = np.concatenate((triple, self.whole(self.hash, np.full(len(self.n), 3, np.uint64))[short]))
        at = np.concatenate((of_line[2:][inner], np.flatnonzero(short)))
        doc = self.doc[at]
        # By text, then by hash, of which 48 bits are enough to sort by.
        order = np.argsort(doc.astype(np.uint64) << np.uint64(48) | h >> np.uint64(16))
        h, leaf = h[order], self.leaf[at][order]
        ends = np.cumsum(np.bincount(doc, minlength=max(leaves, default=-1) + 1))
        out: dict[int, dict[int, np.ndarray]] = {}
        for d, wanted in leaves.items():
            own, of = (x[ends[d - 1] if d else 0 : ends[d]] for x in (h, leaf))
            out[d] = {x: _outside(own, of, x) for x in wanted}
        return out


def _outside(own: np.ndarray, of: np.ndarray, leaf: int) -> np.ndarray:
    """The SKETCH least distinct of ordered values that aren't of the leaf."""
    for size in (64, len(own)):
        found = _least(own[:size][of[:size] != np.uint64(leaf)])
        if len(found) == SKETCH:
            break
    return found


def _least(ordered: np.ndarray) -> np.ndarray:
    """The SKETCH least distinct values."""
    return np.unique(ordered[: _reach(ordered)])


def _reach(ordered: np.ndarray) -> int:
    """How many of ordered values hold the SKETCH least distinct ones."""
    size = 4 * SKETCH
    while size < len(ordered) and np.count_nonzero(np.diff(ordered[:size])) < SKETCH:
        size *= 2
    new = np.flatnonzero(np.diff(ordered[:size]))
    return int(new[SKETCH - 1]) + 1 if len(new) >= SKETCH else min(size, len(ordered))


def _text() -> Column:
    return F.col("text").cast("string")


def _key() -> Column:
    return F.xxhash64("doc_id", F.coalesce(_text(), F.lit("")))


def _parsed(docs: DataFrame, depth: int, min_docs: int, min_tokens: int) -> DataFrame:
    """A row per line of at least min_tokens tokens: key, doc (the same in exact copies), leaf, line_no, needed."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            texts, keys, same = part["text"].tolist(), part["key"].to_numpy(), part["doc"].to_numpy()
            for s in grouped(texts):
                x = Lines(texts[s], depth)
                ok = x.n >= min_tokens
                doc = x.doc[ok]
                yield pd.DataFrame({"key": keys[s][doc], "doc": same[s][doc], "line_no": x.line_no[ok], "leaf": x.leaf[ok].view(np.int64), "needed": needed(x.n[ok], min_docs)})

    texts = docs.select(_key().alias("key"), F.xxhash64(_text()).alias("doc"), _text().alias("text")).where("text is not null")
    return texts.mapInPandas(run, "key long, doc long, line_no long, leaf long, needed int")


def _crowded(docs: DataFrame, picked: DataFrame, depth: int, min_docs: int) -> DataFrame:
    """A row per picked line: key, line_no, leaf, needed, line (hash of its tokens), tokens, lead (leading tokens that aren't variable), sketch (of the document without lines of this leaf), sig."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            texts, keys, wanted = part["text"].tolist(), part["key"].tolist(), part["picked"].tolist()
            for s in grouped(texts):
                x = Lines(texts[s], depth)
                lines = x.whole(x.token, x.leaf)
                row_of = {(d, k): i for i, (d, k) in enumerate(zip(x.doc.tolist(), x.line_no.tolist()))}
                rows = {d: [row_of[d, k] for k in own] for d, own in enumerate(wanted[s])}
                sketches = x.sketches({d: set(x.leaf[own].tolist()) for d, own in rows.items()})
                least = needed(x.n, min_docs)
                out = []
                for d, own in rows.items():
                    for i in own:
                        tokens = x.token[x.first[i] : x.first[i] + x.n[i]]
                        sketch = sketches[d][int(x.leaf[i])].view(np.int64)
                        leaf, line = (int(v[i : i + 1].view(np.int64)[0]) for v in (x.leaf, lines))
                        lead = int((tokens[:depth] != FIELD).sum())
                        out.append((keys[s.start + d], int(x.line_no[i]), leaf, int(least[i]), line, tokens.view(np.int64), lead, sketch, int(sketch[0]) if len(sketch) else leaf))
                yield pd.DataFrame(out, columns=["key", "line_no", "leaf", "needed", "line", "tokens", "lead", "sketch", "sig"])

    met = docs.select(_key().alias("key"), _text().alias("text")).join(picked.hint("shuffle_hash"), "key")
    return met.mapInPandas(run, "key long, line_no long, leaf long, needed int, line long, tokens array<long>, lead int, sketch array<long>, sig long")


def _different(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(template, needed, different): how many documents that aren't copies of each other have a template. And a stored table, to discard when that has been read.

    Documents of a template that agree in AGREE values of their sketches look like copies. Each counts as one by the number
    of sketches that have its value of third most company, so that a group of copies comes to about one, however large,
    and takes nothing from others.
    """
    sketches = own.select("template", "needed", "sketch").distinct().withColumn("own", F.xxhash64("sketch"))
    many = sketches.groupBy("template").agg(F.count("*").alias("n"), F.max("needed").alias("least"), parts_of(salt("own")).alias("parts")).where("n >= least").select("template", "parts")
    value = F.explode(F.when(F.size("sketch") > 0, F.col("sketch")).otherwise(F.array(F.lit(0).cast("long"))))
    values = stored(spread_join(sketches, many, ["template"], "own").select("template", "needed", "own", value.alias("value")), "values")
    company = values.groupBy("template", "value").agg(F.count("*").alias("company"), parts_of(salt("own")).alias("parts"))
    each = spread_join(values, company, ["template", "value"], "own").groupBy("template", "needed", "own").agg(F.sort_array(F.collect_list("company"), asc=False).alias("company"))  # SKETCH at most
    weight = 1 / F.get("company", F.least(F.lit(AGREE), F.size("company")) - 1)
    return each.select("template", "needed", weight.alias("weight")).groupBy("template", "needed").agg(F.sum("weight").alias("different")), values


def _recurring(docs: DataFrame, depth: int, min_docs: int, min_tokens: int, constant: float) -> DataFrame:
    """(key, line_no) of lines of recurring templates."""
    lines = stored(_parsed(docs, depth, min_docs, min_tokens), "lines")
    by_doc = lines.groupBy("leaf", "needed", "doc").agg(parts_of(salt("key")).alias("parts"))
    by_leaf = by_doc.groupBy("leaf", "needed").agg(F.count("*").alias("docs"), F.bit_or("parts").alias("parts")).where(F.col("docs") >= F.col("needed"))
    picked = spread_join(lines.select("key", "line_no", "leaf"), by_leaf.select("leaf", "parts"), ["leaf"], "key").groupBy("key").agg(F.collect_set("line_no").alias("picked"))  # as many as the document has lines
    # Written, as are held, so that what they are made from is gone from the disk when what follows is shuffled.
    picked = stored(picked, "picked")
    discard(lines)
    let_go(docs.sparkSession, every=0)
    crowded = stored(_crowded(docs, picked, depth, min_docs), "crowded")
    discard(picked)

    by_sig = stored(crowded.groupBy("leaf", "line", "sig").agg(F.max("needed").alias("needed"), parts_of(salt("key")).alias("parts")), "sigs")
    let_go(docs.sparkSession, every=0)  # the texts' shuffle, if it was still in use just after crowded was written
    of_line = by_sig.groupBy("leaf", "line").agg(F.count("*").alias("sigs"), F.bit_or("parts").alias("parts"))
    one = crowded.groupBy("leaf", "line").agg(F.max_by(F.struct("tokens", "lead", "needed"), "key").alias("x"))
    distinct = stored(one.join(of_line, ["leaf", "line"]).select("leaf", "line", "x.*", "sigs", "parts"), "distinct")
    # A line that is in enough documents supports its tokens by itself; those of others are counted by document.
    alone = F.col("sigs") >= F.col("needed")
    token = F.posexplode("tokens").alias("at", "token")
    by_itself = distinct.where(alone).select("leaf", "line", "needed", F.col("needed").alias("weight"), token)
    few = distinct.where(~alone).select("leaf", "line", "tokens").join(by_sig.select("leaf", "line", "sig", "needed"), ["leaf", "line"])
    by_token = few.select("leaf", "line", "needed", "sig", token).where(F.col("at") >= depth).groupBy("leaf", "at", "token", "needed", "sig").agg(parts_of(salt("line")).alias("parts"))
    support = by_token.select("leaf", "at", "token", "needed", F.lit(1).alias("weight"), "parts")
    support = support.unionByName(by_itself.where(F.col("at") >= depth).groupBy("leaf", "at", "token", "needed").agg(F.max("weight").alias("weight"), parts_of(salt("line")).alias("parts")))
    support = support.groupBy("leaf", "at", "token", "needed").agg(F.sum("weight").alias("support"), F.bit_or("parts").alias("parts"))
    held = stored(support.where(F.col("support") >= F.col("needed")).select("leaf", "at", "token", "parts"), "held")
    let_go(docs.sparkSession, every=0)
    # Positions that aren't held are variable; the leading tokens are the leaf's.
    placed = distinct.select("leaf", "line", token).where(F.col("at") >= depth)
    kept = spread_join(placed, held, ["leaf", "at", "token"], "line").groupBy("leaf", "line").agg(F.array_sort(F.collect_list(F.struct("at", "token"))).alias("kept"))  # as many as the line has tokens
    fixed = F.col("lead") + F.coalesce(F.size("kept"), F.lit(0))
    templates = distinct.join(kept, ["leaf", "line"], "left").where(fixed >= constant * F.size("tokens")).select("leaf", "line", "parts", F.xxhash64("leaf", "kept").alias("template"))
    own = stored(spread_join(crowded.select("leaf", "line", "key", "sketch", "line_no", "needed"), templates, ["leaf", "line"], "key").drop("leaf", "line"), "templates")
    discard(crowded, by_sig, distinct, held)
    let_go(docs.sparkSession, every=0)
    different, values = _different(own)
    found = different.where(F.col("different") > F.col("needed") - 0.5).select("template")
    spread = own.groupBy("template").agg(parts_of(salt("key")).alias("parts")).join(found, "template")
    # Written before the texts are shuffled for the last time, so that their shuffle files and these don't lie there at once.
    gone = stored(spread_join(own, spread, ["template"], "key").select("key", "line_no"), "gone")
    discard(own, values)
    let_go(docs.sparkSession, every=0)
    return gone


def without_recurring_lines(docs: DataFrame, depth: int = 3, min_docs: int = 8, min_tokens: int = 3, constant: float = 0.6) -> DataFrame:
    """docs with lines of recurring templates taken out of text, and n_lines, n_dropped.

    docs: doc_id and text, and any other columns, which are kept unless they clash with the new ones; those
    are replaced. depth: leading tokens that a leaf goes by; min_docs: documents that make a
    token part of a template, and a template recurring, fewer for long lines (needed); min_tokens: shorter lines are left alone;
    constant: least share of a template's tokens that aren't variable. Documents that look like copies
    of each other count as one: they are for the near-duplicate operator to find, whole.

    A document of which nothing but white space would be left stays as it is (n_dropped 0). Null text stays null, with 0
    lines; repeated rows count once and are treated alike; a null doc_id is no obstacle; an empty
    table gives no rows. Texts of any length are parsed whole, in one task each; they are shuffled to meet the numbers of
    their crowded lines, and of their dropped ones.
    """
    plain = docs.drop("n_lines", "n_dropped")
    key, gone, rest = (free_name(c, plain.columns) for c in ("key", "gone", "rest"))
    dropped = _recurring(plain, depth, min_docs, min_tokens, constant).groupBy(F.col("key").alias(key)).agg(F.collect_set("line_no").alias(gone))  # as many as the document has lines
    # Texts pass by their documents' dropped lines, so they aren't sorted; and at any size by the same plan.
    met = plain.withColumn(key, _key()).join(dropped.hint("shuffle_hash"), key, "left")
    left = F.array_join(F.filter(F.split(_text(), "\n"), lambda x, i: ~F.array_contains(F.col(gone), i.cast("long"))), "\n")
    cleaned = F.get(F.transform(F.array(left), lambda x: F.when(x.rlike(r"\S"), x)), F.lit(0))
    met = met.withColumn(rest, F.when(F.col(gone).isNotNull(), cleaned))
    ends = lambda t: F.octet_length(t) - F.octet_length(F.replace(t, F.lit("\n"), F.lit("")))
    return met.select(
        *[F.coalesce(F.col(rest), _text()).alias("text") if c == "text" else F.col(f"`{c}`") for c in plain.columns],
        F.coalesce(ends(_text()) + 1, F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(ends(_text()) - ends(F.col(rest)), F.lit(0)).cast("long").alias("n_dropped"),
    )
