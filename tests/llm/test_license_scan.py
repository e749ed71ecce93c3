from __future__ import annotations

from corpus_rows import SCHEMA, frame, hard_texts, multiset, prose, words

from salesgrain.llm import license_scan as lic


def brute_force(rows):
    out = []
    templates = lic.template_sets()
    for d, t, _ in rows:
        ws = words(t)
        places = [
            (i, label) for label, phrase in lic.PHRASES.items() for i in range(len(ws))
            if ws[i : i + len(phrase.split())] == phrase.split()
        ]
        met: dict[str, float] = {}
        for b in range(0, max(1, len(ws)), lic.STEP):
            block = set(ws[b : b + lic.BLOCK_WORDS])
            shared = [(t, len(block & set(t.words))) for t in templates if set(t.required) <= block]
            shared = [(t, n) for t, n in shared if n / len(t.words) >= lic.THRESHOLD - 1e-12]
            for t, n in shared:
                if n == max(m for other, m in shared if other.family == t.family):
                    met[t.label] = max(met.get(t.label, 0), n / len(t.words))
        base = {label for _, label in places}
        out.append((
            d, len(ws), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None),
            ",".join(sorted(base)), ",".join(sorted(base | set(met))), 1.0 if places else max(met.values(), default=0.0),
        ))
    return multiset(out)


def test_hard_rows_and_licenses(spark):
    sentence = [text for *_, text in lic.TEMPLATES]
    rows = hard_texts() + [(50 + i, prose(i, 30 + 7 * i) + "\n# " + s.replace(" ", "\n# ", 9) + prose(i + 99, 40), "s") for i, s in enumerate(sentence)]
    rows += [
        (80, "UNDER the MIT-license; under the mit license under the mit", "s"), (81, "Apache License, Version 2.0 cc-by-nc CC BY NC", "s"),
        (82, "version general is work this 3 public gnu the under", "s"), (83, "free software of the public domain", "s"),
    ]
    assert multiset(lic.scan_licenses(frame(spark, rows)).collect()) == brute_force(rows)


def test_each_license_is_named_alone(spark):
    cases = [(label, text) for _, label, _, text in lic.TEMPLATES]
    cases += [
        ("", "Released under the GPL License"), ("", "my notes are released under the terms of the old license"),
        ("", "Licensed under the Example License, Version 2.0"), ("", "all of this work is licensed under the General License, version 3"),
        ("gpl-2", "You can use it under the terms of the GNU General Public License as published by the Free Software Foundation; "
                  "version 2 of the License, or any later version, either way"),
        ("lgpl-2", "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; "
                   "either version 2.1 of the License, or (at your option) any later version"),
        ("mit", "Released under the MIT license"), ("cc-by", "published under a Creative Commons Attribution 4.0 International License"),
    ]
    rows = [(i, f"{prose(i, 70)}\n{text}.\n{prose(i + 500, 70)}", "s") for i, (_, text) in enumerate(cases)]
    got = {r["doc_id"]: r["labels"] for r in lic.scan_licenses(frame(spark, rows)).collect()}
    assert got == {i: label for i, (label, _) in enumerate(cases)}
    own = (("x", "mine", "zebra", "the zebra license of this house"),)
    other = lic.scan_licenses(frame(spark, [(1, "see the zebra license of our house", "s"), (2, rows[0][1], "s")]), own)
    assert {r["doc_id"]: r["labels"] for r in other.collect()} == {1: "mine", 2: "mit"}


def test_required_words_are_words_of_their_template():
    assert all(t.required and set(t.required) <= set(t.words) for t in lic.template_sets())


def test_empty_table(spark):
    assert lic.scan_licenses(spark.createDataFrame([], SCHEMA)).collect() == []


def test_no_python(spark):
    plan = lic.scan_licenses(frame(spark, hard_texts()))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
