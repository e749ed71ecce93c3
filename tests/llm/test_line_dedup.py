from __future__ import annotations

from corpus_rows import SCHEMA, frame, hard_texts, lower, multiset

from salesgrain.llm.line_dedup import LineRuns, dedup_lines
from salesgrain.llm.shared import SPACE_CHARS, Scratch


def brute_force(rows, min_chars=40, min_documents=5):
    holders: dict[str, set] = {}
    for d, t, _ in rows:
        for line in (t or "").split("\n"):
            holders.setdefault(lower(line.strip(SPACE_CHARS)), set()).add(d)
    often = {
        k: max((i for i in ids if i is not None), default=None)
        for k, ids in holders.items() if len(k) >= min_chars and len(ids) >= min_documents
    }
    out = []
    for d, t, _ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if (k := lower(x.strip(SPACE_CHARS))) not in often or often[k] == d]
        out.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return multiset(out)


def test_hard_rows(spark):
    rows = hard_texts()
    assert multiset(dedup_lines(frame(spark, rows)).collect()) == brute_force(rows)


def test_a_line_in_most_documents_over_many_batches(spark):
    line = "É a line that is long enough to be a key of its own"
    rows = [(i, f"{line}\nown {i}\n {line.upper().replace('É', 'é' if i % 5 else 'É')}", "s") for i in range(60)]
    rows += [(None, line, "s"), (59, line, "s")]
    got = dedup_lines(frame(spark, rows), batches=7, fanout=2).collect()
    assert multiset(got) == brute_force(rows)


def test_empty_table(spark):
    assert dedup_lines(spark.createDataFrame([], SCHEMA)).collect() == []


def test_runs_hold_each_hash_once_and_are_compacted(spark):
    store = LineRuns(Scratch(spark, "test"), fanout=2)
    added = []
    for start in (0, 5, 5, 12):
        batch = spark.range(start, start + 10).selectExpr("id as h1", "id * 7 as h2", "1L as n_docs", "id as keep_id")
        added.append(store.add(batch).count())
        store.compact()
    assert added == [10, 5, 0, 7]
    assert sum(len(level) for level in store.levels) <= 2
    held = store.all()
    assert held.count() == held.select("h1", "h2").distinct().count() == 22
