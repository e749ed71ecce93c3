"""Small document tables with the cases that every operator must survive."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, key long, score string, kept string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def prose(seed: int, n: int, per_line: int = 12) -> str:
    rng = random.Random(seed)
    words = ["".join(rng.choice(["th", "er", "an", "in", "on", "é", "st", "re"]) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    return "\n".join(" ".join(words[i : i + per_line]).capitalize() + "." for i in range(0, n, per_line))


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def lower(text: str) -> str:
    return text.translate({c: c + 32 for c in range(65, 91)})


def hard_texts() -> list[tuple[int | None, str | None, str | None]]:
    """doc_id, text, source."""
    shared = "The licence line that many documents hold in common, word for word"
    rows: list[tuple[int | None, str | None, str | None]] = [
        (1, None, "a"), (2, "", "a"), (3, "\n", None), (4, " \t\n\x0b\f\r ", "b"), (5, "...!?", "b"),
        (6, "one", "c"), (7, "ÉTÉ été K İstanbul ÀÉ", "c"), (8, "one", None),
        (9, prose(1, 90), "a"), (10, prose(1, 90), "b"), (10, prose(1, 90), "b"), (None, prose(2, 60), "a"),
        (None, prose(1, 90), None), (11, prose(3, 30_000, 40), "d"), (12, "x" * 50_000, "d"),
        (13, "and " * 5_000, "e"), (13, prose(4, 50), "e"), (14, "a\r\nb\r\n" + shared, "é"),
    ]
    rows += [(20 + i, prose(100 + i, 40) + "\n  " + (shared.upper() if i % 2 else shared) + "\t\n" + prose(200 + i, 20), "f") for i in range(7)]
    return rows


def frame(spark, rows):
    """Rows of (doc_id, text, source) as a table, with further columns whose names operators might use."""
    full = [(d, t, None, s, None if t is None else len(t), "x", 1, None, "y") for d, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def multiset(rows) -> dict:
    out: dict = {}
    for row in rows:
        out[tuple(row)] = out.get(tuple(row), 0) + 1
    return out


def quotas(sizes: list[int], weights: list[float], total: int, max_repeats: int = 3) -> list[float]:
    """Shares of the total by weight, list by list: what is above its limit stops there, the excess is shared again."""
    out, open_, left = [0.0] * len(sizes), list(range(len(sizes))), float(total)
    while open_:
        weight = sum(weights[i] for i in open_)
        above = {i for i in open_ if left * weights[i] / weight > max_repeats * sizes[i]}
        for i in above or open_:
            out[i] = float(max_repeats * sizes[i]) if above else left * weights[i] / weight
        if not above:
            break
        left -= sum(out[i] for i in above)
        open_ = [i for i in open_ if i not in above]
    return out
