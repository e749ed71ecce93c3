"""Token counts by a public tokenizer's own library, lengths only.

A byte-level BPE never merges across a single space between two characters that are not white space:
the token before it ends there, and the rest starts with that space whatever went before. So a text
may be cut at every such space, a count of the whole is the sum over its pieces, and a very long text
is never encoded in one go. Pieces recur, so each task encodes a piece once and remembers its count.
Pieces that are new go to the library in batches of about equal bytes.

Defined cases: a null text counts as empty, with no tokens; every row gets its own result row, repeated
ones and null doc_ids too; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesgrain.llm.shared import whole_text

TOKEN_LIMIT = 512
BATCH_BYTES = 1 << 18
REMEMBERED = 400_000
LONGEST_REMEMBERED = 64
SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")


class PieceCounter:
    """Counts tokens of pieces, remembering those of short pieces up to a fixed number."""

    def __init__(self, vocabulary: str, batch_bytes: int = BATCH_BYTES, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.batch_bytes = batch_bytes
        self.remembered = remembered
        self.counts: dict[str, int] = {}

    def batches(self, pieces: list[str]) -> Iterator[list[str]]:
        batch: list[str] = []
        held = 0
        for piece in pieces:
            if batch and held + len(piece) > self.batch_bytes:
                yield batch
                batch, held = [], 0
            batch.append(piece)
            held += len(piece)
        if batch:
            yield batch

    def encode(self, pieces: list[str]) -> dict[str, int]:
        found: dict[str, int] = {}
        for batch in self.batches(pieces):
            encoded = self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)
            found.update(zip(batch, map(len, encoded)))
        return found

    def of(self, text: str) -> int:
        """Tokens of a whole text. A remembered piece stands without the space before it."""
        first, *rest = SAFE_CUT.split(text)
        counts = list(map(self.counts.get, rest))
        total = self.encode([first])[first] if first else 0
        if None in counts:
            missing = list({p for p, n in zip(rest, counts) if n is None})
            spaced = self.encode([" " + p for p in missing])
            new = {p: spaced[" " + p] for p in missing}
            counts = [new[p] if n is None else n for p, n in zip(rest, counts)]
            if len(self.counts) > self.remembered:
                self.counts.clear()
            self.counts.update((p, n) for p, n in new.items() if len(p) <= LONGEST_REMEMBERED)
        return total + sum(counts)


def token_counter(vocabulary: str):
    """A column function: the number of tokens of each text."""

    @F.pandas_udf("long")
    def n_tokens(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        counter = PieceCounter(vocabulary)
        for part in texts:
            yield pd.Series([counter.of(text) for text in part], dtype="int64")

    return n_tokens


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit for each row of docs(doc_id, text)."""
    text: Column = whole_text()
    counted = docs.select(
        "doc_id", F.octet_length(text).cast("long").alias("n_bytes"), token_counter(vocabulary)(text).alias("n_tokens")
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
