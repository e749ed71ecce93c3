from __future__ import annotations

import random

import numpy as np
from corpus_rows import SCHEMA, frame, hard_texts, prose, words

from salesgrain.llm import decontaminate as dec
from salesgrain.llm import words as word_hashes


def local_score(item: list[str], text: list[str]) -> int:
    """Smith-Waterman cell by cell."""
    best, above = 0, [0] * (len(text) + 1)
    for a in item:
        row = [0]
        for j, b in enumerate(text):
            row.append(max(0, above[j] + (dec.MATCH if a == b else dec.MISMATCH), above[j + 1] - dec.GAP, row[j] - dec.GAP))
        best, above = max(best, *row), row
    return best


def edited(text: str, seed: int, share: float) -> str:
    rng = random.Random(seed)
    out = []
    for word in text.split():
        x = rng.random()
        if x < share / 3:
            continue
        out += [f"new{rng.randint(0, 99)}"] if x < 2 * share / 3 else [word, "added"] if x < share else [word]
    return " ".join(out)


def test_alignment_is_smith_waterman():
    rng = random.Random(5)
    for _ in range(60):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(1, 9))] for _ in range(2))
        code = lambda ws: np.array([ord(w) for w in ws], dtype=np.uint64)
        assert dec.align(code(a), code(b))[0] == local_score(a, b)


def test_leaks_against_brute_force(spark):
    items = [(i, prose(900 + i, 35 + i)) for i in range(8)] + [(8, None), (9, "one two"), (None, prose(950, 40)), (3, prose(903, 38))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = hard_texts()[:13] + hard_texts()[14:]
    for i in range(8):
        rows.append((60 + i, prose(i, 80) + " " + items[i][1].translate({c: c - 32 for c in range(97, 123)}) + " " + prose(i + 50, 70), "s"))
        rows.append((70 + i, prose(i + 300, 60) + "\n" + edited(items[i][1], i, 0.18) + "\n" + prose(i + 350, 10), "s"))
        rows.append((80 + i, prose(i + 400, 60) + " " + " ".join(items[i][1].split()[:14]), "s"))
    rows.append((90, items[1][1] + "\n" + prose(2, 50) + "\n" + items[2][1] + " " + edited(items[2][1], 3, 0.1), "s"))
    got = {(r["doc_id"], r["item_id"]): r for r in dec.find_leaks(frame(spark, rows), benchmark).collect()}
    want = {}
    for d, t, _ in rows:
        for item_id, text in items:
            own = words(text)
            if own:
                score = local_score(own, words(t)) / (dec.MATCH * len(own))
                if score >= (dec.MIN_SCORE if len(own) >= dec.RUN_WORDS else 1):
                    want[d, item_id] = score
    assert set(got) == set(want)
    assert all(abs(got[k]["score"] - want[k]) < 1e-9 for k in want)
    text = {d: words(t) for d, t, _ in rows}
    exact = got[60, 0]
    assert text[60][exact["first_word"] : exact["last_word"] + 1] == words(items[0][1])
    stay = dec.drop_leaky(frame(spark, rows), benchmark)
    assert stay.columns == frame(spark, rows).columns
    left = [r["doc_id"] for r in stay.collect()]
    assert sorted(map(str, left)) == sorted(str(d) for d, _, _ in rows if d not in {k[0] for k in want})


def test_copies_with_an_edit_in_every_segment(spark):
    items = [(i, prose(700 + i, n)) for i, n in enumerate((25, 38, 30, 40))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = [(90 + i, prose(i, 30) + " " + items[i][1] + " " + prose(i + 50, 30), "s") for i in (0, 2)]  # exact ones beside
    for i, text in items:
        own = words(text)
        other = [f"new{k}" if k % 6 == 5 else w for k, w in enumerate(own)]
        between = [x for k, w in enumerate(own) for x in ([w, f"new{k}"] if k % 2 else [w])]  # no three words in a row
        dropped = [w for k, w in enumerate(own) if k % 6 != 5]
        rows += [(10 * k + i, prose(i + k, 40) + " " + " ".join(e) + " " + prose(i + 9, 40), "s") for k, e in enumerate((other, dropped), 1)]
        rows.append((30 + i, " ".join(between[: len(own) + len(own) // 4]), "s"))
    want = {}
    for d, t, _ in rows:
        for item_id, text in items:
            score = local_score(words(text), words(t)) / (dec.MATCH * len(words(text)))
            if score >= dec.MIN_SCORE:
                want[d, item_id] = score
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in dec.find_leaks(frame(spark, rows), benchmark).collect()}
    assert {(10 + i, i) for i in range(4)} | {(20 + i, i) for i in range(4)} | {(90, 0), (92, 2)} <= set(want)
    assert got == want


def test_one_block_of_added_words(spark):
    cases = [(40, 16), (40, 19), (40, 31), (40, 32), (40, 33), (24, 12), (59, 30), (59, 47), (59, 48)]
    items = [(i, " ".join(f"own{i}x{k}" for k in range(n))) for i, (n, _) in enumerate(cases)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = []
    for (i, text), (n, added) in zip(items, cases):
        own = text.split()
        copy = [*own[: n // 2], *(f"new{k}" for k in range(added)), *own[n // 2 :]]
        rows.append((i, prose(i, 60) + " " + " ".join(copy) + " " + prose(i + 50, 60), "s"))
    want = {i: (dec.MATCH * n - added) / (dec.MATCH * n) for i, (n, added) in enumerate(cases)}
    got = {r["doc_id"]: r for r in dec.find_leaks(frame(spark, rows), benchmark).collect()}
    assert {i: r["score"] for i, r in got.items()} == {i: score for i, score in want.items() if score >= dec.MIN_SCORE}
    assert all(r["item_id"] == i and r["last_word"] - r["first_word"] + 1 == sum(cases[i]) for i, r in got.items())


def test_items_of_one_and_two_words_are_whole_runs(spark):
    items = [(1, "Zebra!"), (2, "quiet harbour"), (3, "..."), (4, "again again")]
    texts = ["a zebra, a quiet harbour", "quiet, old harbour", "harbour quiet", "zebras again", "zebra again again again ZEBRA", "", None]
    got = dec.find_leaks(frame(spark, [(i, t, "s") for i, t in enumerate(texts)]), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r["doc_id"], r["item_id"], r["score"], r["first_word"], r["last_word"]) for r in got.collect()) == [
        (0, 1, 1.0, 1, 1), (0, 2, 1.0, 3, 4), (4, 1, 1.0, 0, 0), (4, 4, 1.0, 1, 2),
    ]


def test_several_slices_find_the_same(spark, monkeypatch):
    items = [(i, prose(900 + i, 30)) for i in range(12)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = frame(spark, [(i, prose(i, 20) + " " + items[i][1], "s") for i in range(12)])
    once = {tuple(r) for r in dec.find_leaks(docs, benchmark).collect()}
    monkeypatch.setattr(dec, "SLICE_ITEMS", 6)
    assert {tuple(r) for r in dec.find_leaks(docs, benchmark).collect()} == once and len(once) == 12


def test_empty_tables(spark):
    empty, none = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, prose(1, 30))], "item_id long, text string")
    assert dec.find_leaks(empty, some).collect() == [] == dec.find_leaks(frame(spark, hard_texts()[:5]), none).collect()
    assert dec.drop_leaky(frame(spark, hard_texts()[:5]), none).count() == 5


def test_words_of_blocks_are_the_words_of_each_text(monkeypatch):
    texts = [t for _, t, _ in hard_texts()] + ["\x00a\x7fb", "日本 𝒳x", "no break", "\ud800lone", "word", "", None]
    for size in (1, 2, 40, 700, 1 << 16):
        monkeypatch.setattr(word_hashes, "BLOCK_CHARS", size)
        got = [ws[a:b].tolist() for ws, first in word_hashes.words_of_texts(texts) for a, b in zip(first, first[1:])]
        assert got == [word_hashes.words_of(t)[0].tolist() for t in texts]


def test_longest_shared_cell_by_cell():
    rng = random.Random(8)
    for _ in range(60):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(1, 80))] for _ in range(2))
        above = [0] * (len(b) + 1)
        for x in a:
            row = [0]
            for j, y in enumerate(b):
                row.append(above[j] + 1 if x == y else max(above[j + 1], row[j]))
            above = row
        assert dec.longest_shared(a, b) == above[-1]


def test_texts_of_a_block_share_their_steps_and_nothing_else(monkeypatch):
    own = [prose(900 + i, 30) for i in range(6)]
    items = dec.Items([(i, word_hashes.words_of(t)[0]) for i, t in enumerate(own)], {}, dec.MIN_SCORE)
    half = [" ".join(own[0].split()[:15]), " ".join(own[0].split()[15:])]  # a copy across two texts is none
    texts = [*half, None, own[1] + " " + prose(5, 40), "", *half, own[2] + "\n" + own[1], *(prose(i, 9) for i in range(500))]
    looked_up, found = [], dec.KnownCodes.found
    monkeypatch.setattr(dec.KnownCodes, "found", lambda self, words: looked_up.append(len(words)) or found(self, words))
    got = list(items.leaks(texts))
    assert [sorted(leak[0] for leak in leaks) for leaks in got] == [[], [], [], [1], [], [], [], [1, 2]] + [[]] * 500
    assert got[7] == [(1, 1.0, 30, 59), (2, 1.0, 0, 29)]
    assert len(looked_up) == 1 and sum(looked_up) == sum(len(words(t)) for t in texts)
    monkeypatch.setattr(dec, "HITS_AT_ONCE", 7)
    assert list(items.leaks(texts)) == got == [leaks for t in texts for leaks in items.leaks([t])]


def test_words_out_of_order_are_not_aligned(monkeypatch):
    own = [f"own{k}" for k in range(40)]
    items = dec.Items([(1, word_hashes.words_of(" ".join(own))[0])], {}, dec.MIN_SCORE)
    mixed_up = own[::-1]
    aligned, align = [], dec.align
    monkeypatch.setattr(dec, "align", lambda item, window: aligned.append(len(window)) or align(item, window))
    assert list(items.leaks([" ".join(mixed_up)])) == [[]] and not aligned
    assert list(items.leaks([" ".join(own)])) == [[(1, 1.0, 0, 39)]] and aligned
