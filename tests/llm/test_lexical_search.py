from __future__ import annotations

import math
import random
import re

import numpy as np
import pandas as pd
from corpus_rows import SCHEMA, frame, hard_texts, lower, multiset, prose

from salesgrain.llm import lexical_search
from salesgrain.llm.lexical_search import RangeMaxima, search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(lower(text or ""))


def brute_force(docs, items, top=10):
    listed = [(d, terms(t), n) for n, (d, t, _) in enumerate(docs)]
    n_docs = sum(bool(t) for _, t, _ in listed)
    n_words = sum(len(t) for _, t, _ in listed)
    df: dict[str, int] = {}
    for _, t, _ in listed:
        for term in set(t):
            df[term] = df.get(term, 0) + 1
    out = []
    for item_id, text in items:
        scored = []
        for d, t, n in listed:
            score = 0
            for term in terms(text):
                tf = t.count(term)
                if tf:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    m = 100 - 75 + (75 * len(t) * n_docs) // n_words
                    score += w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, d is None, d or 0, n, d))
        out += [(item_id, r, s[4], -s[0]) for r, s in enumerate(sorted(scored)[:top], 1)]
    return multiset(out)


def found(spark, docs, items, **kw):
    asked = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, score string, rank long")
    return multiset(search(frame(spark, docs), asked, **kw).collect())


def some_docs(n, copies=0):
    docs = [(i, prose(i % 40 + 1000 * (i % 2), 30 + i % 17) + "\n" + prose(i, 25), "s") for i in range(n)]
    return docs + [(n + i, prose(5, 40), "s") for i in range(copies)]


def test_hard_rows(spark):
    docs = hard_texts()
    items = [(1, prose(1, 20)), (2, None), (3, ""), (4, "ÉTÉ été one one"), (5, "nothing of this"), (6, prose(1, 20)),
             (6, prose(1, 20)), (None, "and one licence line"), (7, prose(3, 400)), (8, "x" * 50_000)]
    want = brute_force(docs, items)
    assert len(want) > 30
    assert found(spark, docs, items) == want
    assert found(spark, docs, items, shard_docs=4, slice_items=2) == want


def test_many_shards_copies_and_ties(spark):
    docs = some_docs(300, copies=120)
    rng = random.Random(1)
    items = [(i, " ".join(rng.choice(docs)[1].split()[: rng.randint(1, 30)])) for i in range(25)] + [(99, prose(5, 40))]
    want = brute_force(docs, items)
    assert found(spark, docs, items, shard_docs=50, slice_items=6) == want
    assert found(spark, docs, items) == want
    assert found(spark, docs, items, top=3) == brute_force(docs, items, 3)


def test_blocks_end_by_documents_and_by_words(spark, monkeypatch):
    docs, items = some_docs(60), [(1, prose(3, 30)), (2, prose(1004, 12))]
    want = brute_force(docs, items)
    for name, value in (("BLOCK_DOCS", 7), ("BLOCK_WORDS", 90)):
        with monkeypatch.context() as patched:
            patched.setattr(lexical_search, name, value)
            assert len(blocks_of(docs)) > 5
    assert found(spark, docs, items) == want


def blocks_of(docs):
    batch = pd.DataFrame({"row": range(len(docs)), "doc_id": [d for d, _, _ in docs], "text": [t for _, t, _ in docs]})
    blocks = pd.concat(list(lexical_search.build_index(iter([batch]))))
    assert sum(map(len, blocks["rows"])) == len(docs)
    return blocks


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    asked = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert search(empty, asked).collect() == []
    assert search(frame(spark, hard_texts()), asked.limit(0)).collect() == []


def test_range_maxima():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 9, 200)
    maxima = RangeMaxima(values).cut(150)
    begin = rng.integers(0, 200, 500)
    end = np.minimum(begin + rng.integers(1, 151, 500), 200)
    want = [b + int(values[b:e].argmax()) for b, e in zip(begin, end)]
    assert maxima.of(begin, end).tolist() == want


def test_intervals_that_cannot_matter_are_not_opened(spark):
    """A document that stands out is found without opening the others."""
    docs = [(i, "common " * 3 + f"own{i}", "s") for i in range(400)] + [(400 + i, "rare rare words common", "s") for i in range(12)]
    blocks = blocks_of(docs)
    weight = {int(lexical_search.term_counts(w)[0][0]): n for w, n in (("rare", 900), ("common", 1))}
    asked = np.array(sorted(weight))
    shard = lexical_search.Shard(blocks, asked, np.array([weight[t] for t in sorted(weight)]), len(docs), 4 * len(docs))
    opened = []
    plain = shard.merged
    shard.merged = lambda p, s, new, *rest: (opened.extend(new.tolist()), plain(p, s, new, *rest))[1]
    places, _ = shard.best(np.arange(len(asked)), np.ones(len(asked), dtype=np.int64), 10)
    assert sorted(shard.doc_ids[places].tolist()) == list(range(400, 410))
    assert len(opened) < 200
