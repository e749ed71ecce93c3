"""Substring dedup by hashing lines and passages.

Units of a document are its lines with MIN_LINE_WORDS words or more, and all passages of PASSAGE_WORDS words,
one from each word on. Both are normalised to their words, so case, punctuation and spacing don't matter.
Digests are grouped over the corpus; the occurrence with the smallest doc_id, then the smallest offset, stays,
and every other one is removed, with its offsets in the original text.

repeated_units() lists every unit occurrence to remove. repeated_spans(), for whole corpora, gives whole
stretches and hashes far fewer passages:

- A text that an earlier document has, byte for byte, is removed as one span of kind text.
- Winnowing tells which passages can repeat: of every REACH consecutive grams of GRAM_WORDS words, which are the
  grams of one passage, the one with the least digest is picked, so equal passages pick the same gram wherever
  they stand. Only passages around a gram that the corpus holds more than once go on.
- The consecutive passages that pick one gram are one context. Contexts are grouped first: all but the first
  occurrence of a context are repeats as a whole, one row each. Only where one gram stands in several
  different contexts, at the ends of what repeats and around edits, the first occurrence of each of these
  contexts is opened and its passages are grouped one by one.
- What repeats one stretch of a document is joined into that whole stretch.

A passage that overlaps its own first occurrence is not removed there: that would cut into what stays. A span
names where it is kept; where a part of that place is itself removed, that part's own span names the earlier one.

Only digests that occur more than once travel back to their occurrences, and a digest is summed within
tasks before it is shuffled, so a unit that a third of all documents share is no hot group.

Defined cases: a null text has no units; a null doc_id ranks last; rows that repeat a doc_id and text
are one document; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesgrain.llm.shared import Scratch, text_key, whole_text
from salesgrain.llm.words import code_points, grams, run_digests, words_in, words_of

MIN_LINE_WORDS = 5
PASSAGE_WORDS = 20
GRAM_WORDS = 8
REACH = PASSAGE_WORDS - GRAM_WORDS + 1
LINE, PASSAGE = 1, 2
PASSAGE_TEXTS = 50
LAST_RANK = (1 << 63) - 1  # of a document without an id
OFFSETS = 1 << 31  # as many as a text has characters at most
RADICES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
UNITS = "doc_id long, row long, kind long, start long, end long, word long, h1 long, h2 long"
PICKED = "doc long, h long"
PASSAGES = "doc_id long, row long, start long, end long, word long, h1 long, h2 long"
CONTEXTS = PASSAGES + ", n long, gram long"
OPENED = PASSAGES + ", of long"
FIRST_PASS = "kind long, doc long, doc_id long, row long, start long, end long, h1 long, h2 long"
FIVE_WORDS = r"(?:[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+){4}[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def least_places(digests: np.ndarray, reach: int) -> np.ndarray:
    """For every `reach` consecutive digests the place of the least one, the last of equal ones."""
    if len(digests) <= reach:
        return np.array([len(digests) - 1 - int(digests[::-1].argmin())]) if len(digests) else np.zeros(0, dtype=int)
    windows = np.lib.stride_tricks.sliding_window_view(digests[::-1], reach)
    step = max(1, 1_000_000 // reach)
    least = [windows[i : i + step].argmin(axis=1) + np.arange(i, min(i + step, len(windows))) for i in range(0, len(windows), step)]
    return (len(digests) - 1 - np.concatenate(least))[::-1]


def winnowed(digests: np.ndarray, reach: int) -> np.ndarray:
    """The places that least_places() names, each once."""
    return np.unique(least_places(digests, reach))


def picked_grams(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and digests of the grams that winnowing picks; a text shorter than a passage has none."""
    if len(words) < PASSAGE_WORDS:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    digests = grams(words, GRAM_WORDS)
    places = winnowed(digests, REACH)
    return places, digests[places].view(np.int64)


def passages_around(words: np.ndarray, repeated: np.ndarray) -> np.ndarray:
    """First words of the passages that hold one of the repeated grams."""
    places, digests = picked_grams(words)
    places = places[np.isin(digests, repeated)]
    begin = (places[:, None] - np.arange(REACH)).ravel()
    return np.unique(begin[(begin >= 0) & (begin <= len(words) - PASSAGE_WORDS)])


def counted_grams(words: np.ndarray) -> np.ndarray:
    """The picked grams of a text: each once, or twice where the text has it more often."""
    grams_, times = np.unique(picked_grams(words)[1], return_counts=True)
    return np.repeat(grams_, np.minimum(times, 2))


def contexts_of(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word and number of passages of each run of passages that pick one gram, and that gram's digest."""
    if len(words) < PASSAGE_WORDS:
        return (np.zeros(0, dtype=np.int64),) * 3
    digests = grams(words, GRAM_WORDS)
    places = least_places(digests, REACH)
    first = np.concatenate([[0], np.flatnonzero(np.diff(places)) + 1])
    return first, np.diff(first, append=len(places)), digests[places[first]].view(np.int64)


def lines_in(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and number of words of each line that is long enough."""
    line = np.searchsorted(np.flatnonzero(codes == 10), starts)
    _, first, count = np.unique(line, return_index=True, return_counts=True)
    long_enough = count >= MIN_LINE_WORDS
    return first[long_enough], count[long_enough]


def digested(kind: int, words, starts, ends, begin: np.ndarray, n: np.ndarray) -> dict[str, np.ndarray]:
    """The units of a kind that begin at some words, by column."""
    begin, n = begin.astype(np.int64), n.astype(np.int64)
    if not len(begin):
        return {name: np.zeros(0, dtype=np.int64) for name in ("kind", "start", "end", "word", "h1", "h2")}
    h1, h2 = (run_digests(words, begin, n, radix).view(np.int64) ^ kind for radix in RADICES)
    return {"kind": np.full(len(begin), kind), "start": starts[begin], "end": ends[begin + n - 1], "word": begin, "h1": h1, "h2": h2}


def line_units(text: str | None) -> dict[str, np.ndarray]:
    codes = code_points(text)
    words, starts, ends = words_in(codes)
    return digested(LINE, words, starts, ends, *lines_in(codes, starts))


def passage_units(text: str | None, repeated: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """All passages, or those that hold one of the repeated grams."""
    words, starts, ends = words_in(code_points(text))
    begin = np.arange(max(0, len(words) - PASSAGE_WORDS + 1)) if repeated is None else passages_around(words, repeated)
    return digested(PASSAGE, words, starts, ends, begin, np.full(len(begin), PASSAGE_WORDS))


def units_of(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Kind, start, end (code points) and two digests of each unit of a text."""
    lines, passages = line_units(text), passage_units(text)
    return tuple(np.concatenate([lines[name], passages[name]]) for name in ("kind", "start", "end", "h1", "h2"))


def unit_rows(batch: pd.DataFrame, found: list[dict[str, np.ndarray]]) -> pd.DataFrame:
    of_row = np.repeat(np.arange(len(batch)), [len(units["kind"]) for units in found])
    columns = {name: np.concatenate([units[name] for units in found]) for name in found[0]}
    return pd.DataFrame({"doc_id": batch["doc_id"].take(of_row).array, "row": batch["row"].to_numpy()[of_row]} | columns)


def hash_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if len(batch):
            yield unit_rows(batch, [line_units(text) for text in batch["text"]])


def hash_passages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        # a few texts at a time, as a text may give a row for each of its words
        for at in range(0, len(batch), PASSAGE_TEXTS):
            part = batch.iloc[at : at + PASSAGE_TEXTS]
            yield unit_rows(part, [passage_units(t, np.asarray(g, dtype=np.int64)) for t, g in zip(part["text"], part["grams"])])


def hash_first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines, and as kind PASSAGE the picked grams (in h1), from one reading of each text."""
    for batch in batches:
        if not len(batch):
            continue
        lines, grams_of = [], []
        for text in batch["text"]:
            codes = code_points(text)
            words, starts, ends = words_in(codes)
            lines.append(digested(LINE, words, starts, ends, *lines_in(codes, starts)))
            grams_of.append(counted_grams(words))
        found = unit_rows(batch, lines).drop(columns="word")
        yield found.assign(doc=batch["doc"].to_numpy().repeat([len(x["kind"]) for x in lines]))
        doc, h = batch["doc"].to_numpy().repeat([len(x) for x in grams_of]), np.concatenate(grams_of)
        yield pd.DataFrame({"kind": PASSAGE, "doc": doc, "doc_id": 0, "row": 0, "start": 0, "end": 0, "h1": h, "h2": 0})


def hash_contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if not len(batch):
            continue
        found = []
        for text, repeated in zip(batch["text"], batch["grams"]):
            words, starts, ends = words_in(code_points(text))
            first, n, gram = contexts_of(words)
            kept = np.isin(gram, np.asarray(repeated, dtype=np.int64))
            first, n, gram = first[kept], n[kept], gram[kept]
            found.append(digested(PASSAGE, words, starts, ends, first, n + PASSAGE_WORDS - 1) | {"n": n, "gram": gram})
        yield unit_rows(batch, found).drop(columns="kind")


def hash_opened(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The passages of some contexts, (first word, number) each."""
    for batch in batches:
        if not len(batch):
            continue
        found = []
        for text, opened in zip(batch["text"], batch["opened"]):
            begin = np.concatenate([np.arange(x["word"], x["word"] + x["n"]) for x in opened])
            of = np.concatenate([np.full(x["n"], x["word"]) for x in opened])
            found.append(digested(PASSAGE, *words_in(code_points(text)), begin, np.full(len(begin), PASSAGE_WORDS)) | {"of": of})
        yield unit_rows(batch, found).drop(columns="kind")


def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if not len(batch):
            continue
        found = [counted_grams(words_of(text)[0]) for text in batch["text"]]
        yield pd.DataFrame({"doc": batch["doc"].to_numpy().repeat([len(x) for x in found]), "h": np.concatenate(found)})


def documents_of(docs: DataFrame) -> DataFrame:
    """doc_id, text, row (which stands for the text) and doc (for both)."""
    rows = docs.select("doc_id", whole_text().alias("text")).withColumn("row", text_key(F.col("text")))
    return rows.withColumn("doc", F.xxhash64("doc_id", "row"))


def repeated_grams(picked: DataFrame, scratch: Scratch) -> DataFrame:
    """Per document the grams that the corpus holds more than once."""
    often = scratch.stage("often", picked.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h"))
    return picked.join(often, "h").groupBy("doc").agg(F.collect_set("h").alias("grams"))


def place_of() -> Column:
    """Document, offset and word as one number, so the first occurrence is a plain minimum within each task."""
    rank = F.coalesce("doc_id", F.lit(LAST_RANK)).cast("decimal(19,0)")
    inside = F.col("start") * OFFSETS + F.col("word")
    return (rank * F.lit(OFFSETS * OFFSETS).cast("decimal(19,0)") + inside.cast("decimal(19,0)")).cast("decimal(38,0)")


def at_first(df: DataFrame) -> DataFrame:
    """kept_doc_id, kept_start and kept_word out of the place `first`."""
    kept = df.withColumn("kept_inside", F.pmod("first", F.lit(OFFSETS * OFFSETS).cast("decimal(19,0)")).cast("long"))
    kept_rank = F.expr(f"CAST((first - kept_inside) div {OFFSETS * OFFSETS} AS BIGINT)")
    return kept.withColumns({
        "kept_doc_id": F.when(kept_rank != LAST_RANK, kept_rank), "kept_start": F.expr(f"kept_inside div {OFFSETS}"),
        "kept_word": F.pmod("kept_inside", F.lit(OFFSETS).cast("long")),
    }).drop("first", "kept_inside")


def not_first(units: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Unit occurrences whose digest occurs earlier too, with the place of the first one."""
    place = place_of()
    several = scratch.stage(
        name, units.groupBy("h1", "h2").agg(F.count("*").alias("times"), F.min(place).alias("first")).filter("times > 1").drop("times")
    )
    return at_first(units.join(several, ["h1", "h2"]).filter(place != F.col("first")).drop("h1", "h2"))


def repeats(docs: DataFrame) -> DataFrame:
    """Each unit occurrence to remove, with its first word and that of the kept occurrence."""
    scratch = Scratch(docs.sparkSession, "substring-dedup")
    rows = documents_of(docs)
    picked = scratch.stage("picked", rows.select("doc", "text").mapInPandas(pick, PICKED))
    around = repeated_grams(picked, scratch)
    passages = rows.join(around, "doc").select("doc_id", "row", "text", "grams").mapInPandas(hash_passages, UNITS)
    units = scratch.stage("units", rows.select("doc_id", "row", "text").mapInPandas(hash_lines, UNITS).unionByName(passages))
    kind = F.when(F.col("kind") == LINE, "line").otherwise("passage").alias("kind")
    return not_first(units, scratch, "several").select(
        "doc_id", "row", "start", "end", kind, "kept_doc_id", "kept_start", "word", "kept_word"
    ).distinct()


def repeated_units(docs: DataFrame) -> DataFrame:
    """doc_id, row, start, end, kind, kept_doc_id and kept_start of each unit occurrence to remove."""
    return repeats(docs).drop("word", "kept_word")


def whole_copies(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Documents whose text an earlier one has: doc_id, row, doc, end and the kept document's id."""
    rank = F.coalesce("doc_id", F.lit(LAST_RANK))
    texts = scratch.stage("texts", rows.filter(F.col("text").rlike(FIVE_WORDS)).select(
        "doc_id", "row", "doc", F.md5(F.col("text").cast("binary")).alias("same"), F.length("text").cast("long").alias("end")
    ))
    firsts = texts.groupBy("same").agg(F.min(rank).alias("first"), F.max(rank).alias("last")).filter("first < last")
    later = texts.join(firsts, "same").filter(rank > F.col("first")).dropDuplicates(["doc_id", "row"])
    kept = F.when(F.col("first") != LAST_RANK, F.col("first")).alias("kept_doc_id")
    return scratch.stage("copies", later.select("doc_id", "row", "doc", "end", kept))


def repeated_passages(rows: DataFrame, picked: DataFrame, scratch: Scratch) -> DataFrame:
    """Runs of passages to remove: first word and number of passages, offsets, and where they are kept."""
    around = scratch.stage("around", repeated_grams(picked, scratch))
    columns = ["doc_id", "row", "text"]
    contexts = rows.join(around, "doc").select(*columns, "grams").mapInPandas(hash_contexts, CONTEXTS)
    contexts = scratch.stage("contexts", contexts)
    place = place_of()
    classes = scratch.stage("classes", contexts.groupBy("h1", "h2").agg(
        F.count("*").alias("times"), F.min(place).alias("first"), F.max("gram").alias("gram"),
    ))
    # a gram in several contexts: the passages that these share are found one by one, in the first of each
    varied = classes.groupBy("gram").agg(F.count("*").alias("contexts")).filter("contexts > 1").select("gram")
    chosen = classes.join(varied, "gram").select("h1", "h2", "first")
    opened = contexts.join(chosen, ["h1", "h2"]).filter(place == F.col("first")).select("doc_id", "row", "word", "n", "h1", "h2")
    opened = scratch.stage("opened", opened)
    doc = F.xxhash64("doc_id", "row").alias("doc")
    per_doc = opened.groupBy(doc).agg(F.collect_list(F.struct("word", "n")).alias("opened"))
    singles = rows.join(per_doc, "doc").select(*columns, "opened").mapInPandas(hash_opened, OPENED)
    units = scratch.stage("passages", singles)
    single = scratch.stage("singles", not_first(units, scratch, "several").withColumn("n", F.lit(1).cast("long")))
    # where all of a first occurrence is itself kept in one earlier place, the later ones are kept there too
    ends = single.groupBy(doc, F.col("of").alias("word")).agg(
        F.size(F.collect_set("word")).alias("found"), F.min("kept_word").alias("low"), F.max("kept_word").alias("high"),
        F.min_by(F.struct("kept_doc_id", "kept_start", "kept_word"), "word").alias("kept"),
        F.min(F.coalesce("kept_doc_id", F.lit(LAST_RANK))).alias("one"), F.max(F.coalesce("kept_doc_id", F.lit(LAST_RANK))).alias("other"),
    )
    passed_on = (
        opened.withColumn("doc", doc).join(ends, ["doc", "word"])
        .filter("found = n AND high - low = n - 1 AND kept.kept_word = low AND one = other").select("h1", "h2", "kept")
    )
    met = contexts.join(classes.filter("times > 1").select("h1", "h2", "first"), ["h1", "h2"]).join(passed_on, ["h1", "h2"], "left")
    at = ("kept_doc_id", "kept_start", "kept_word")
    whole = at_first(met.filter(place != F.col("first"))).withColumns(
        {c: F.when(F.col("kept").isNotNull(), F.col("kept")[c]).otherwise(F.col(c)) for c in at}
    )
    parts = ["doc_id", "row", "start", "end", "word", "n", *at]
    return whole.select(parts).unionByName(single.select(parts))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, row, start, end, kind, kept_doc_id and kept_start of each whole text, line and stretch of words to remove.

    Passages that repeat words of their own document are joined as long as they go on, as in a text that
    repeats a few words over and over; kept_start is then where the first of them is kept.
    """
    scratch = Scratch(docs.sparkSession, "substring-spans")
    rows = documents_of(docs)
    copies = whole_copies(rows, scratch)
    own = F.col("doc_id").eqNullSafe(F.col("kept_doc_id"))
    into_kept = own & (F.col("word") - F.col("kept_word") < PASSAGE_WORDS)
    zero = F.lit(0).cast("long")
    first = scratch.stage("first", rows.select("doc", "doc_id", "row", "text").mapInPandas(hash_first, FIRST_PASS))
    first = first.join(copies.select("doc"), "doc", "left_anti")
    lines = not_first(first.filter(F.col("kind") == LINE).drop("kind", "doc").withColumn("word", zero), scratch, "lines")
    lines = lines.dropDuplicates(["doc_id", "row", "start"])
    picked = first.filter(F.col("kind") == PASSAGE).select("doc", F.col("h1").alias("h"))
    found = repeated_passages(rows, picked, scratch).filter(~into_kept)
    stretch = ["doc_id", "row", "kept_doc_id", "shift"]
    order = Window.partitionBy(*stretch).orderBy("word")
    # runs of one stretch lie end to end, but for those of a row that repeats, which come twice
    goes_on = F.lag(F.col("word") + F.col("n")).over(order) >= F.col("word")
    runs = (
        found.withColumn("shift", F.when(~own, F.col("word") - F.col("kept_word")))
        .withColumn("begins", F.when(goes_on, 0).otherwise(1))
        .withColumn("run", F.sum("begins").over(order))
    )
    spans = runs.groupBy(*stretch, "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("kept_start", "word").alias("kept_start")
    )
    columns = ["doc_id", "row", "start", "end", "kind", "kept_doc_id", "kept_start"]
    parts = (
        (lines, "line"), (spans, "passage"), (copies.withColumn("start", zero).withColumn("kept_start", zero), "text"),
    )
    found_lines, passages, texts = (part.withColumn("kind", F.lit(kind)).select(columns) for part, kind in parts)
    return found_lines.unionByName(passages).unionByName(texts)
