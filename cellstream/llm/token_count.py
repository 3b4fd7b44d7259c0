"""Token counts of whole texts, huge ones by overlapping chunks that are spliced where both agree.

Where two neighbouring characters stand side by side in no vocabulary piece, no merge can ever
cross between them: both sides encode as they would alone. A seam between two chunks is put at such
a place inside their overlap, and only where the encodings of both chunks have a token boundary
there. If an overlap has no such place, it is widened until it does or reaches the text's end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
_loaded: dict[str, "Pieces"] = {}


class Pieces:
    """A sentencepiece model with the pairs of characters that its pieces hold side by side."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        normal = (i for i in range(self.model.get_piece_size()) if not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i)))
        self.pairs = {p[i : i + 2] for p in map(self.model.id_to_piece, normal) for i in range(len(p) - 1)}

    def count(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.model.encode(texts, num_threads=1)]

    def free(self, text: str, at: int) -> bool:
        """Whether no piece can cross from text[at - 1] to text[at]."""
        return text[at - 1 : at + 1].replace(" ", SPACE) not in self.pairs

    def boundaries(self, chunk: str, dummy: bool) -> tuple[dict[int, int], int]:
        """Offset -> tokens before it, for every token boundary of a chunk, and the number of tokens.

        The model puts a space before the chunk. At the text's start that belongs to the result; in
        later chunks it alters only what stands before the first free place, which the seam leaves out.
        """
        first = (np.frombuffer(chunk.encode(), np.uint8) & 0xC0) != 0x80
        offset = np.cumsum(first) - 1  # pieces count bytes
        found, n = {}, 0
        for piece in self.model.encode(chunk, return_type="proto").pieces:
            if piece.begin < len(first) and first[piece.begin]:
                found.setdefault(int(offset[piece.begin]), n)  # several byte pieces of a character may begin at one offset
            n += 1
        found[len(chunk)] = n
        if not dummy:
            found.pop(0, None)
        return found, n

    def spliced(self, text: str, chunk: int, overlap: int) -> int:
        """Tokens of text, from chunks of about `chunk` characters that overlap by `overlap` at least."""
        total = start = seam = 0
        end = min(chunk, len(text))
        own, n = self.boundaries(text[:end], True)
        while end < len(text):
            wide, at = overlap, 0
            while not at and end - wide > seam:
                back, stop = end - wide, min(len(text), end + chunk)
                after, m = self.boundaries(text[back:stop], False)
                common = [p for p in range(back + 1, end) if p > seam and p - start in own and p - back in after and self.free(text, p)]
                at = common[len(common) // 2] if common else 0
                wide *= 2
            if at:
                total += own[at - start] - (own[seam - start] if seam else 0)
                start, seam, end, own, n = back, at, stop, after, m
            else:  # no seam in what this chunk holds: let it reach further
                end = min(len(text), end + (end - start))
                own, n = self.boundaries(text[start:end], start == 0)
        return total + n - (own[seam - start] if seam else 0)


def _pieces(path: str) -> Pieces:
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def token_counts(docs: DataFrame, model: str | None = None, limit: int = 4096, chunk: int = 32_768, overlap: int = 256) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    model: path of a sentencepiece model; piece_bpe_32k.model of the public tokenizers by default.
    Texts of more than `chunk` characters are encoded in chunks, so the tokenizer's memory doesn't grow with
    them, but for texts without a place for a seam; a text itself is one value of its row. The counts are those of the whole text. Null and empty texts have 0 bytes and 0
    tokens. Repeated rows get a row each, a null doc_id stays null, other columns don't matter, an
    empty table gives no rows. Nothing is shuffled.
    """
    path = model or public_tokenizers.path("piece_bpe_32k.model")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = _pieces(path)
        for part in parts:
            texts = part["text"].tolist()
            n = [0] * len(texts)
            short = [i for i, t in enumerate(texts) if t and len(t) <= chunk]
            for at in range(0, len(short), 256):
                for i, k in zip(short[at : at + 256], pieces.count([texts[i] for i in short[at : at + 256]])):
                    n[i] = k
            for i, t in enumerate(texts):
                if t and len(t) > chunk:
                    n[i] = pieces.spliced(t, chunk, overlap)
            yield pd.DataFrame({"doc_id": part["doc_id"], "n_bytes": part["n_bytes"], "n_tokens": n})

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long").alias("n_bytes"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    counted = plain.mapInPandas(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
