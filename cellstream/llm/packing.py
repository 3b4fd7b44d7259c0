"""Packing of tokenised documents into sequences, by harmonic classes.

A document is cut into pieces whose lengths are capacity // k for whole k, as long as that leaves
more than `tail` tokens; what is left (at most `tail`) is a piece of its own. A piece of length l
belongs to class capacity // l, and a sequence of class k holds exactly k pieces of it. So every
task can fill sequences alone: it numbers its pieces of each class, and one small table of counts
by class and task turns these numbers into ranks over the whole corpus. What doesn't fill a
sequence at the end, fewer than k pieces a class whatever the input's size, is laid end to end
and cut at the capacity.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from .common import stored

#: ASCII marks that are neither letters nor digits, but for ', which starts pre-tokens such as 's.
MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_encoders: dict[str, "Encoder"] = {}


class _Known(dict):
    """Ids by word; of a word that is met for the first time they are learned, so words are looked up once."""

    def __init__(self, learn: Callable[[bytes], bytes]):
        self.learn = learn

    def __missing__(self, word: bytes) -> bytes:
        found = self[word] = self.learn(word)
        return found


class Encoder:
    """Token ids of texts, by a tokenizer that never looks across ASCII white space.

    That holds for word_bpe_49k.json: no pattern of its pre-tokenizer and no special token holds
    white space, and neither normal form nor lower case depends on it. So ids are kept by word,
    16 bits each where the vocabulary allows. A word of letters in normal form is one pre-token
    that goes to the tokenizer's model as it is; so does what is left without ASCII marks at the
    end, which are a pre-token of their own. All other words take the tokenizer's whole way.
    """

    def __init__(self, path: str, most: int = 600_000):
        self.tokenizer = Tokenizer.from_file(path)
        self.bytes_of = ByteLevel(add_prefix_space=False, use_regex=False)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.known = _Known(self._learn)
        self.most = most

    def _packed(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def _whole(self, word: bytes) -> bytes:
        return self._packed(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids)

    def _stem(self, stem: bytes) -> bytes:
        model = self.tokenizer.model
        if stem.isalpha():
            return self._packed([t.id for t in model.tokenize(stem.lower().decode())])
        text = stem.decode()
        if text.isalpha() and text == text.lower() == unicodedata.normalize("NFC", text):
            return self._packed([t.id for t in model.tokenize(self.bytes_of.pre_tokenize_str(text)[0][0])])
        return self._whole(stem)

    def _learn(self, w: bytes) -> bytes:
        known = self.known
        stem = w.rstrip(MARKS)
        if len(stem) == len(w):
            return self._stem(w)
        marks = w[len(stem) :]
        if stem and not stem.isalpha() and not stem.decode().isalpha():
            return self._whole(w)
        for part in (stem, marks):
            if part and part not in known:
                known[part] = self._stem(part)
        return (known[stem] if stem else b"") + known[marks]

    def ids(self, texts: list[str]) -> Iterator[np.ndarray]:
        for at in range(0, len(texts), 256):
            # A-Z need not be kept apart, but for the strings of special tokens.
            words = [(t.encode() if "<|" in t else t.encode().lower()).split() for t in texts[at : at + 256]]
            if len(self.known) > self.most:
                self.known.clear()
            for ws in words:
                yield np.frombuffer(b"".join(map(self.known.__getitem__, ws)), self.kind)


def cut_lengths(n: int, capacity: int, tail: int) -> list[int]:
    """The lengths of the pieces of a document of n tokens, in order."""
    out = [capacity] * (n // capacity)
    n %= capacity
    while n > tail:
        k = -(-capacity // n)  # the longest share capacity // k that fits into n
        k += capacity // k > n
        out.append(capacity // k)
        n -= capacity // k
    return out + [n] * (n > 0)


def _crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _pieces(docs: DataFrame, path: str, capacity: int, tail: int, end_id: int) -> DataFrame:
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if path not in _encoders:
            _encoders[path] = Encoder(path)
        task, seen = TaskContext.get().partitionId(), Counter()
        for part in parts:
            out = []
            for doc_id, ids in zip(part["doc_id"], _encoders[path].ids(part["text"].tolist())):
                ids = np.append(ids, ids.dtype.type(end_id))
                start, n = 0, len(ids)
                for length in cut_lengths(n, capacity, tail):
                    own = ids[start : start + length]
                    k = capacity // length
                    out.append((doc_id, start, length, _crc32(own), n, k, task, seen[k], own.tobytes()))
                    seen[k] += 1
                    start += length
                if len(out) >= 4096:
                    yield pd.DataFrame(out, columns=columns)
                    out = []
            if out:
                yield pd.DataFrame(out, columns=columns)

    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "class", "task", "nth", "ids"]
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return plain.mapInPandas(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, class int, task int, nth long, ids binary")


def _relaid(rest: DataFrame, capacity: int) -> DataFrame:
    """The pieces that fill no sequence, end to end and cut at the capacity; sequence_id counts from 0."""

    def run(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(["class", "rank"], kind="stable")
        out, at = [], 0
        for doc_id, start, length, n, ids in zip(p["doc_id"], p["start"], p["length"], p["doc_tokens"], p["ids"]):
            done = 0
            while done < length:
                size = min(length - done, capacity - at % capacity)
                own = np.frombuffer(ids, f"<u{len(ids) // length}")[done : done + size]
                out.append((doc_id, start + done, size, _crc32(own), n, at // capacity, at % capacity, own.tobytes()))
                done, at = done + size, at + size
        return pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])

    return rest.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary")


def packed(docs: DataFrame, tokenizer: str | None = None, capacity: int = 2048, tail: int = 64, end_id: int = 1) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids (little-endian, 16 bits each where the vocabulary allows, else 32).

    tokenizer: path of a tokenizers file whose words end at white space; word_bpe_49k.json by default.
    Every token of every document, the end_id after it included, is in exactly one piece; pieces of a
    sequence stand gapless from 0, and only each sequence's end is padding: under 1 / (k + 1) of a
    capacity per sequence of class k, and one sequence's part for all that fills none. Which documents meet in a
    sequence depends on how rows are dealt to tasks.

    Null and empty texts are a document of the end_id alone; repeated rows are packed each; a null
    doc_id stays null; other columns don't matter; an empty table gives no rows. The tokens are
    written once to the shared folder; only counts by class and task are shuffled.
    """
    pieces = stored(_pieces(docs, tokenizer or public_tokenizers.path("word_bpe_49k.json"), capacity, tail, end_id), "pieces")
    by_task = pieces.groupBy("class", "task").agg((F.max("nth") + 1).alias("n"))
    by_class = by_task.groupBy("class").agg(F.sum("n").alias("of_class"))
    before = by_task.select("class", "task", (F.sum("n").over(Window.partitionBy("class").orderBy("task")) - F.col("n")).alias("before"))
    # One row a class, so at most `capacity` rows: sequences of smaller classes come first.
    full = by_class.select("class", "of_class", F.floor(F.col("of_class") / F.col("class")).alias("full"))
    first = full.select("class", "of_class", "full", (F.sum("full").over(Window.orderBy("class")) - F.col("full")).alias("first_id"))
    placed = by_task.select("class", "task", "n").join(before, ["class", "task"]).join(F.broadcast(first), "class")
    in_full = F.col("rank") < F.col("full") * F.col("class")
    ranked = pieces.join(placed.drop("n"), ["class", "task"]).withColumn("rank", F.col("before") + F.col("nth"))
    # At most k - 1 pieces a class are left, so these are few counts, whatever the input's size.
    some_left = placed.where(F.col("before") + F.col("n") > F.col("full") * F.col("class")).drop("n")
    rest = pieces.join(F.broadcast(some_left), ["class", "task"]).withColumn("rank", F.col("before") + F.col("nth")).where(~in_full)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    filled = ranked.where(in_full).withColumn("sequence_id", F.col("first_id") + F.floor(F.col("rank") / F.col("class"))).withColumn("slot", F.col("rank") % F.col("class"))
    # Pieces of a class differ in length only in the tails; there the offset is the sum of what stands before.
    even = filled.where(F.col("length") > tail).withColumn("offset", F.col("slot") * F.col("length"))
    order = Window.partitionBy("sequence_id").orderBy("slot")
    uneven = filled.where(F.col("length") <= tail).withColumn("offset", F.sum("length").over(order) - F.col("length"))
    total = first.agg(F.coalesce(F.sum("full"), F.lit(0)).alias("total"))
    last = _relaid(rest.select("doc_id", "start", "length", "doc_tokens", "class", "rank", "ids"), capacity)
    last = last.crossJoin(F.broadcast(total)).withColumn("sequence_id", F.col("sequence_id") + F.col("total"))
    return even.select(columns).unionByName(uneven.select(columns)).unionByName(last.select(columns))
