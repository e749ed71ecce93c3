"""Every stage and the whole pipeline against plain Python versions, on whole small tables."""

from __future__ import annotations

import os
from collections import defaultdict

import corpus_pipeline
import numpy as np
import pytest
from corpus_rows import SCHEMA, frame, hard_texts, prose, quotas
from test_decontaminate import local_score
from test_jaccard_join import brute_force as near_brute_force
from test_jaccard_join import near
from corpus_rows import words

from salesgrain.llm import decontaminate as dec
from salesgrain.llm import quality_model as qm
from salesgrain.llm import source_mix as sm

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def by_hand(docs, labels, benchmark):
    """(doc_id, text, source) rows after all but the last stage."""
    known = {}
    for r in labels:
        if r["quality"] is not None:
            known[r["doc_id"]] = min(r["quality"], known.get(r["doc_id"], 1))
    import zlib

    x = [qm.statistics(t or "") for _, t, _ in docs]
    fitted = [i for i, (d, _, _) in enumerate(docs) if d in known and zlib.crc32(str(d).encode()) % 5]
    trees = qm.fit(np.array([x[i] for i in fitted]), np.array([float(known[docs[i][0]]) for i in fitted]))
    docs = [row for row, s in zip(docs, trees.score(np.array(x))) if s >= qm.ACCEPTED]
    last = {}
    for row in docs:
        last[row[1] or ""] = max(row, last.get(row[1] or "", row), key=lambda r: r[0])
    docs = list(last.values())
    classes = near_brute_force(docs)
    docs = [row for row in docs if classes[row[1] or ""][1] == row[0]]
    items = [words(t) for _, t in benchmark]

    def leaks(text):
        ws = words(text)
        own = set(ws)
        for item in items:
            # no alignment can have more matches than words in common
            if sum(w in own for w in item) >= dec.MIN_SCORE * len(item):
                if local_score(item, ws) >= dec.MIN_SCORE * dec.MATCH * len(item):
                    return True
        return False

    return [row for row in docs if not leaks(row[1])]


@needs_data
def test_run_against_plain_python(spark):
    read = lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
    rows = [(r["doc_id"], r["text"], r["source"]) for r in read("documents").collect()]
    want = by_hand(rows, read("labels").collect(), [(r["item_id"], r["text"]) for r in read("benchmark").collect()])
    got = corpus_pipeline.run(spark, SF).collect()
    taken = {r["doc_id"]: r["copies"] for r in got}
    assert len(taken) == len(got) and set(taken) <= {d for d, _, _ in want}
    sizes = {d: len((t or "").split()) for d, t, _ in want}
    by_source = defaultdict(list)
    for d, _, s in want:
        by_source[s].append(d)
    names = sorted(by_source)
    totals = [sum(sizes[d] for d in by_source[s]) for s in names]
    for s, total, target in zip(names, totals, quotas(totals, [1.0 + i % 3 for i in range(len(names))], sum(totals))):
        mixed = sum(sizes[d] * taken.get(d, 0) for d in by_source[s])
        assert abs(mixed - target) <= max(sizes[d] for d in by_source[s]) / 2 + 1
    assert all(1 <= c <= sm.MAX_REPEATS for c in taken.values())


def test_stages_return_the_columns_and_survive_hard_rows(spark, tmp_path):
    docs = frame(spark, hard_texts() + [(200 + i, near(prose(5, 80), i, 1), "a") for i in range(5)])
    spark.createDataFrame([(9, 1), (12, 0), (13, 0), (11, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, prose(2, 60)), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    empty = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns[: len(docs.columns)] == docs.columns and out.count() <= docs.count(), name
        assert stage(spark, empty, str(tmp_path)).collect() == []
    assert out.columns == [*docs.columns, "copies"]
