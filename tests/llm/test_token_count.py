from __future__ import annotations

import public_tokenizers
import pytest
from corpus_rows import SCHEMA, frame, hard_texts, multiset
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from salesgrain.llm.token_count import PieceCounter, count_tokens

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def test_hard_rows_and_special_strings(spark, library):
    rows = hard_texts() + [
        (30, "a <|endoftext|> b<|endoftext|> c  d \u0085 e\x1c f", "s"), (31, "it 's 'll don't   \n\n  x ", "s"),
        (32, "日本 語 ① Ⅳ 12 345\t6", "s"), (33, " lead", "s"), (34, "word " * 600, "s"),
    ]
    got = count_tokens(frame(spark, rows), VOCABULARY).collect()
    want = []
    for d, t, _ in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((d, len((t or "").encode()), n, n > 512))
    assert multiset(got) == multiset(want)


def test_empty_table(spark):
    assert count_tokens(spark.createDataFrame([], SCHEMA), VOCABULARY).collect() == []


PIECES = st.sampled_from([" ", "  ", "\n", "\t", "\x1c", " ", "　", "a", "Bc", "1", "é", "'s", "!", "<|endoftext|>", "<|", "語", "́"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=25).map("".join))
def test_cuts_never_change_a_count(text):
    counter = _shared.setdefault("counter", PieceCounter(VOCABULARY, remembered=50))
    assert counter.of(text) == len(counter.tokenizer.encode(text, add_special_tokens=False).ids)


_shared: dict[str, PieceCounter] = {}


def test_batches_are_balanced_by_size():
    counter = PieceCounter(VOCABULARY, batch_bytes=100)
    batches = list(counter.batches(["x" * 30] * 10 + ["y" * 500]))
    assert [len(b) for b in batches] == [3, 3, 3, 1, 1]
