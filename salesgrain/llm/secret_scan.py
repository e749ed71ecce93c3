"""Secret scan: known shapes, and sliding-window Shannon entropy over candidate strings.

Shapes are assignments to secret-like names, access keys and hex strings. Candidates are longer runs of
token characters with a digit. Each is measured in its own character class (hex or base64): a window of
WINDOW characters slides over it, the count of the character that leaves is lowered and that of the one
that comes is raised, and the sum of c * log2(c) follows by differences of a table, in whole millionths
of a bit, so it doesn't drift. A candidate whose best window reaches its class's threshold is a span,
unless the allow-list names it.

All in DataFrame functions, row by row: nothing is shuffled. Positions are code points, ends exclusive.

Defined cases: a null text counts as empty, without spans; every row gets its own result row, repeated
ones and null doc_ids too; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesgrain.llm.shared import prefix_sums, whole_text

# fixed values: the shapes the contract names
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_VALUE = r"^[A-Za-z_]+" + r"""["']?\x20*[:=]\x20*["']?"""
MIN_VALUE = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"

# of this operator
WINDOW = 24
CANDIDATE = r"[A-Za-z0-9+/_-]{24,}"
HEX_SYMBOLS = "0123456789abcdef"
BASE64_SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
CLASSES = {"entropy_hex": (HEX_SYMBOLS, 3.0), "entropy_base64": (BASE64_SYMBOLS, 4.0)}
HEX_ONLY = r"^[0-9A-Fa-f]+$"
ALLOWED = (
    r"^[^0-9]+$",  # words
    r"^[0-9]+$",  # numbers
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",  # UUIDs
    r"([Ee]xample|EXAMPLE|[Pp]laceholder|PLACEHOLDER|[Dd]ummy|DUMMY)",
)
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")
#: c * log2(c) for each possible count, in millionths
LOADS = [round(c * math.log2(c) * 1e6) if c else 0 for c in range(WINDOW + 1)]


def most_load(bits: float) -> int:
    """The largest sum of c * log2(c) over a window whose entropy is still at least so many bits."""
    return math.floor((math.log2(WINDOW) - bits) * WINDOW * 1e6)


def located(text: Column, hits: Column, pattern: str) -> Column:
    """start, end and value of each hit of a pattern, given the hits: what lies between them is split()."""
    between = F.transform(F.slice(F.split(text, pattern), 1, F.size(hits)), lambda p: F.length(p).cast("long"))
    steps = F.zip_with(between, hits, lambda gap, hit: gap + F.length(hit))
    ends = F.zip_with(prefix_sums(steps), steps, lambda before, step: before + step)
    spans = F.zip_with(
        ends, hits, lambda end, hit: F.struct((end - F.length(hit)).alias("start"), end.alias("end"), hit.alias("value"))
    )
    none = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")
    return F.when(F.size(hits) > 0, spans).otherwise(none)


def lightest_window(value: Column, symbols: str) -> Column:
    """The least sum of c * log2(c) over all windows of a candidate.

    Counts are kept as a string with one character per symbol, whose code is the count plus 65.
    """
    loads = F.array([F.lit(n).cast("long") for n in LOADS])
    codes = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(symbols), c).cast("int"))
    count = lambda counts, code: F.ascii(F.substr(counts, code, F.lit(1))) - 65
    put = lambda counts, code, n: F.overlay(counts, F.chr((n + 65).cast("long")), code, 1)

    def slid(codes: Column) -> Column:
        def enter(state: Column, code: Column) -> Column:
            n = count(state["counts"], code)
            return F.struct(
                put(state["counts"], code, n + 1).alias("counts"),
                (state["load"] + F.get(loads, n + 1) - F.get(loads, n)).alias("load"),
            )

        def leave(state: Column, code: Column) -> Column:
            n = count(state["counts"], code)
            return F.struct(
                put(state["counts"], code, n - 1).alias("counts"),
                (state["load"] + F.get(loads, n - 1) - F.get(loads, n)).alias("load"),
            )

        empty = F.struct(F.lit("A" * len(symbols)).alias("counts"), F.lit(0).cast("long").alias("load"))
        first = F.aggregate(F.slice(codes, 1, WINDOW), empty, enter)
        start = F.transform(
            F.array(first),
            lambda s: F.struct(s["counts"].alias("counts"), s["load"].alias("load"), s["load"].alias("least")),
        )[0]
        pairs = F.arrays_zip(
            F.slice(codes, 1, F.size(codes) - WINDOW).alias("out"), F.slice(codes, WINDOW + 1, F.size(codes)).alias("in_")
        )

        def slide(state: Column, pair: Column) -> Column:
            after = F.transform(F.array(leave(state, pair["out"])), lambda s: enter(s, pair["in_"]))[0]
            return F.transform(
                F.array(after),
                lambda s: F.struct(
                    s["counts"].alias("counts"), s["load"].alias("load"), F.least(s["load"], state["least"]).alias("least")
                ),
            )[0]

        return F.aggregate(pairs, start, slide, lambda s: s["least"])

    return F.transform(F.array(codes), slid)[0]


def entropy_spans(candidates: Column, kind: str) -> Column:
    """Candidates of a class whose best window reaches the threshold and that no allow-list entry names."""
    symbols, bits = CLASSES[kind]

    def is_secret(c: Column) -> Column:
        is_hex = c["value"].rlike(HEX_ONLY)
        allowed = F.lit(False)
        for pattern in ALLOWED:
            allowed = allowed | c["value"].rlike(pattern)
        measured = F.lower(c["value"]) if kind == "entropy_hex" else c["value"]
        in_class = is_hex if kind == "entropy_hex" else ~is_hex
        return F.when(in_class & ~allowed, lightest_window(measured, symbols) <= most_load(bits)).otherwise(False)

    return F.filter(candidates, is_secret)


def ranked_spans(kind: str, rank: int) -> Column:
    return F.transform(
        kind,
        lambda x: F.struct(
            x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"), F.lit(kind).alias("kind")
        ),
    )


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and an array of spans (start, rank, end, kind) sorted by start, then kind, for each row."""
    rows = docs.select("doc_id", whole_text().alias("text"))
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "candidate": CANDIDATE}
    hits = rows.select("*", *(F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(f"{k}_hits") for k, p in patterns.items()))
    found = hits.select(
        "doc_id", *(located(F.col("text"), F.col(f"{k}_hits"), p).alias(k) for k, p in patterns.items())
    )
    long_enough = lambda x: F.length(F.regexp_replace(x["value"], ASSIGN_VALUE, "")) >= MIN_VALUE
    spans = found.select(
        "doc_id",
        F.filter("assign", long_enough).alias("assign"), "access", "hex",
        *(entropy_spans(F.col("candidate"), k).alias(k) for k in CLASSES),
    )
    ranked = [ranked_spans(kind, rank) for rank, kind in enumerate(KINDS)]
    return spans.select("doc_id", F.array_sort(F.concat(*ranked)).alias("spans"))


def secret_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans and n_entropy for each row of docs."""
    named = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["rank"] < 3)
    return scan(docs).select(
        "doc_id",
        count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(named(base).cast("binary"), 256).alias("base_sha256"),
        named(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["rank"] >= 3)).cast("long").alias("n_entropy"),
    )
