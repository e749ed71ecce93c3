from __future__ import annotations

import random
from collections import defaultdict

from corpus_rows import SCHEMA, frame, hard_texts, prose, words

from salesgrain.llm import jaccard_join as jj
from salesgrain.llm.shared import Scratch


def shingle_set(text: str | None) -> frozenset:
    ws = words(text)
    return frozenset(tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))) if ws else frozenset()


def brute_force(rows, threshold=0.8):
    """(text -> links) and (text -> smallest text of its class) over all pairs of different texts."""
    texts = sorted({t or "" for _, t, _ in rows})
    sets = [shingle_set(t) for t in texts]
    links, root = defaultdict(int), list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and both >= threshold * len(sets[i] | sets[j]) - 1e-9:
                links[texts[i]] += 1
                links[texts[j]] += 1
                root[find(i)] = find(j)
    members = defaultdict(list)
    for d, t, _ in rows:
        members[find(texts.index(t or ""))].append(d)
    first = {r: min((d for d in ds if d is not None), default=None) for r, ds in members.items()}
    return {t: (links[t], first[find(i)]) for i, t in enumerate(texts)}


def near(text: str, seed: int, edits: int) -> str:
    rng, ws = random.Random(seed), text.split(" ")
    for _ in range(edits):
        ws[rng.randrange(len(ws))] = f"edit{rng.randint(0, 9)}"
    return " ".join(ws)


def check(spark, rows, **options):
    docs = frame(spark, rows)
    got = jj.near_classes(docs, **options).collect()
    want = brute_force(rows)
    assert len(got) == len(rows)
    ids = defaultdict(list)
    for d, t, _ in rows:
        ids[d].append(want[t or ""])
    for r in got:
        assert (r["n_links"], r["class_id"]) in ids[r["doc_id"]], r
    return got


def test_hard_rows(spark):
    rows = hard_texts() + [(40, "one two three", "s"), (41, "One, two THREE!", "s"), (42, "one two", "s")]
    check(spark, rows)


def test_groups_of_near_copies(spark):
    rows = []
    for g in range(12):
        base = prose(700 + g, 150)
        rows += [(1000 * g + i, near(base, i, i % 5), "s") for i in range(8)]
    got = check(spark, rows)
    classes = {r["class_id"] for r in got}
    assert classes >= {1000 * g for g in range(12)}


def test_a_group_larger_than_a_leaf_is_compared_in_blocks(spark):
    base = prose(5, 120)
    rows = [(i, near(base, i, 1), "s") for i in range(90)] + [(500 + i, prose(i, 60), "s") for i in range(30)]
    rows += [(900 + i, base, "s") for i in range(50)]
    check(spark, rows, leaf=20)


def test_kept_rows(spark):
    base = prose(6, 100)
    rows = [(3, near(base, 1, 1), "a"), (2, near(base, 2, 1), "a"), (2, near(base, 2, 1), "a"), (9, prose(8, 50), "b"), (9, prose(9, 50), "b")]
    docs = frame(spark, rows)
    out = jj.drop_near_copies(docs)
    assert out.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in out.collect()) == sorted({(d, t) for d, t, _ in rows if d != 3})


def test_empty_table(spark):
    assert jj.near_classes(spark.createDataFrame([], SCHEMA)).collect() == []


def test_runs_meet_the_recall():
    runs = jj.runs_needed(0.99)
    assert 1 - (1 - jj.meeting_chance(jj.MAX_DEPTH)) ** runs >= 0.99 > 1 - (1 - jj.meeting_chance(jj.MAX_DEPTH)) ** (runs - 1)


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 102), (102, 101), (7, 7)]
    edges = spark.createDataFrame([(b, a) for a, b in chain], "node long, root long")
    got = {r["node"]: r["component"] for r in jj.components(edges, Scratch(spark, "test")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}
