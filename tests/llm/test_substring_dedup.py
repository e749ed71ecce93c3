from __future__ import annotations

from collections import defaultdict

import numpy as np
from corpus_rows import SCHEMA, frame, hard_texts, multiset, prose, words

from salesgrain.llm import substring_dedup as sub
from salesgrain.llm.words import words_of


def test_words_are_those_of_the_pattern():
    for _, text, _ in hard_texts():
        hashes, starts, ends = words_of(text)
        cut = [(text or "")[a:b] for a, b in zip(starts, ends)]
        assert [w.translate({c: c + 32 for c in range(65, 91)}) for w in cut] == words(text)
        assert len(set(hashes.tolist())) == len(set(words(text)))


def brute_force(rows):
    """Every unit by its words, the earliest kept."""
    met = defaultdict(list)
    for d, t in {(d, t or "") for d, t, _ in rows}:
        ws, (_, starts, ends) = words(t), words_of(t)
        kinds, begin, end, _, _ = sub.units_of(t)
        for kind, a, b in zip(kinds, begin, end):
            first, last = np.searchsorted(starts, a), np.searchsorted(ends, b)
            met[kind, tuple(ws[first : last + 1])].append((d is None, d or 0, int(a), int(b)))
    out = set()
    for (kind, _), places in met.items():
        first = min(places)
        for none, d, a, b in places:
            if (none, d, a) != first[:3]:
                out.add((None if none else d, a, b, "line" if kind == sub.LINE else "passage", None if first[0] else first[1], first[2]))
    return multiset(out)


def test_hard_rows(spark):
    rows = hard_texts()
    assert multiset(sub.repeated_units(frame(spark, rows)).drop("row").collect()) == brute_force(rows)


def test_passages_inside_lines_are_met_and_clean_texts_left_alone(spark):
    passage = prose(77, 52).replace("\n", " ").replace(".", "")
    rows = [(i, prose(i, 45).replace("\n", " ") + " " + passage + " " + prose(i + 500, 45).replace("\n", " "), "s") for i in range(1, 9)]
    rows += [(i, prose(i, 200), "s") for i in range(20, 40)]
    got = sub.repeated_units(frame(spark, rows)).collect()
    assert {r["doc_id"] for r in got} == set(range(2, 9)) and {r["kept_doc_id"] for r in got} == {1}
    text = {d: t for d, t, _ in rows}
    for r in got:
        own = text[r["doc_id"]][r["start"] : r["end"]]
        assert words(own) == words(text[1][r["kept_start"] : r["kept_start"] + len(own)])


def test_whole_repeats_against_all_runs_of_twenty_words(spark):
    rows = []
    for i, n in enumerate((20, 21, 25, 30, 35, 42, 52, 60, 80, 150)):
        repeat = " ".join(f"r{i}x{k}" for k in range(n))
        around = [" ".join(f"w{i}y{j}y{k}" for k in range(15 + i)) for j in range(6)]
        rows += [(10 * i + 200 + j, f"{around[2 * j]} {repeat} {around[2 * j + 1]}", "s") for j in range(3)]
    rows += [(1, "and " * 100, "s"), (2, "x y z " * 60, "s"), (None, rows[9][1] + " end", "s"), (201, rows[1][1], "s")]
    first, want = {}, defaultdict(set)
    for d, t, _ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ws = words(t)
        for k in range(len(ws) - 19):
            kept = first.setdefault(tuple(ws[k : k + 20]), (d, k))
            if kept != (d, k) and not (kept[0] == d and k - kept[1] < 20):
                want[d] |= set(range(k, k + 20))
    got, n_rows = defaultdict(set), defaultdict(int)
    text = {d: t for d, t, _ in rows}
    for r in sub.repeated_spans(frame(spark, rows)).collect():
        if r["kind"] == "passage":
            _, starts, ends = words_of(text[r["doc_id"]])
            got[r["doc_id"]] |= set(range(np.searchsorted(starts, r["start"]), np.searchsorted(ends, r["end"]) + 1))
            n_rows[r["doc_id"]] += 1
            if r["kept_doc_id"] != r["doc_id"]:
                own = text[r["doc_id"]][r["start"] : r["end"]]
                assert own == text[r["kept_doc_id"]][r["kept_start"] : r["kept_start"] + len(own)]
    assert dict(got) == dict(want)
    assert all(n == 1 for d, n in n_rows.items())


def test_spans_of_near_copies_cover_what_units_cover(spark):
    """Groups of near copies, with edits at any word: the words and lines to remove are those of the unit list."""
    import random

    rng = random.Random(7)
    rows = []
    for g in range(6):
        base = prose(300 + g, 140).split(" ")
        for c in range(9):
            ws = list(base)
            for _ in range(rng.randint(0, 4)):
                at = rng.randrange(len(ws))
                ws[at : at + rng.randint(0, 2)] = [f"e{rng.randrange(10**6)}"] * rng.randint(0, 2)
            rows.append((100 * g + c, " ".join(ws), "s"))
    rows += [(900 + i, prose(300, 140)[50 : 50 + 200 * i], "s") for i in range(1, 4)]
    rows += [(950 + i, rows[3][1], "s") for i in range(3)] + [(None, rows[3][1], "s"), (970, "short text", "s"), (971, "short text", "s")]

    def removed(df):
        out = defaultdict(set)
        for r in df.collect():
            out[r["doc_id"]] |= set(range(r["start"], r["end"]))
        return out

    text = {d: t for d, t, _ in rows}
    units, spans = removed(sub.repeated_units(frame(spark, rows))), sub.repeated_spans(frame(spark, rows))
    covered = removed(spans)
    copies = {r["doc_id"]: r["kept_doc_id"] for r in spans.collect() if r["kind"] == "text"}
    first = min(d for d, t, _ in rows if t == rows[3][1] and d is not None)
    assert {c: k for c, k in copies.items() if text[c] == rows[3][1]} == {c: first for c in (*range(950, 953), None, 3) if c != first}
    assert 970 not in copies and 971 not in copies
    for d in text:
        inside = {i for i in units[d] if d not in copies}
        words_at = {i for i, ch in enumerate(text[d]) if ch.isalnum()}
        assert (covered[d] & words_at if d not in copies else set()) == inside & words_at, d
    for r in spans.collect():
        kept = text[r["kept_doc_id"]]
        own = text[r["doc_id"]][r["start"] : r["end"]]
        if r["kept_doc_id"] != r["doc_id"]:
            assert words(own) == words(kept[r["kept_start"] :])[: len(words(own))]


def test_contexts_tile_the_passages_and_pick_as_winnowing_does():
    for seed, n in ((1, 19), (2, 20), (3, 21), (4, 400)):
        ws = words_of(" ".join(prose(seed, n).split()))[0]
        first, n_passages, gram = sub.contexts_of(ws)
        assert n_passages.sum() == max(0, len(ws) - 19)
        assert (first[1:] == first[:-1] + n_passages[:-1]).all()
        assert set(gram.tolist()) == set(sub.picked_grams(ws)[1].tolist())


def test_lines_are_indexed_whole_units():
    text = "one two three four five\nshort\n\n" + "six " * 30
    kinds, starts, ends, _, _ = sub.units_of(text)
    lines = [text[a:b] for k, a, b in zip(kinds, starts, ends) if k == sub.LINE]
    assert lines == ["one two three four five", ("six " * 30).strip()]


def test_winnowing_always_picks_the_least():
    rng = np.random.default_rng(1)
    for n in (0, 1, 23, 24, 25, 300):
        digests = rng.integers(0, 50, n).astype(np.uint64)
        picked = set(sub.winnowed(digests, 24).tolist())
        for i in range(max(0, n - 23)):
            window = digests[i : i + 24]
            assert i + len(window) - 1 - int(window[::-1].argmin()) in picked
        assert bool(picked) == bool(n)


def test_empty_table(spark):
    assert sub.repeated_units(spark.createDataFrame([], SCHEMA)).collect() == []
