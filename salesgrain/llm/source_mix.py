"""Mixing overlapping sources to target weights by min-cost flow.

Documents are summed by membership pattern (the set of sources that may use them). Words flow from
patterns to sources: a pattern's words may be taken up to `max_repeats` times, each further time at a
higher cost, and a source takes up to its quota. The flow is solved over patterns and sources only.
Documents are then laid on a line in seeded order, pattern by pattern, and the words a pattern sends
are its first ones, pass after pass; a copy is taken when its middle lies before the end.

Sources that share a pattern, directly or through others, are a component, and the flows of components do
not touch: each one is solved by itself, in a task, over its patterns and sources only. A source whose
documents have no other source is a component of its own. Nothing is collected to the driver but two
sums a round of the quotas, so sources and patterns may be as many as they are; only the patterns of one
component, the size of an overlapping recipe and not of the corpus, meet in one row. Positions come from two
sums: over ranges of the seeded order, and within a range, so no task sees a whole source.

Defined cases: a null text has size 0; a null source is a source of its own, the last; a document without any
source is not taken; a null doc_id has its place in the seeded order; rows that repeat are documents of their own; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesgrain.llm.shared import NOT_SPACE, Scratch, unused_name, whole_text

MAX_REPEATS = 3
SEED = "mix-1"
RANGE_DIGITS = 3  # hex digits of the seeded order that name a range: 4,096 ranges
CYCLE = (1, 2, 3)


def cycling_weight(place: Column) -> Column:
    return F.get(F.array(*map(F.lit, CYCLE)), (place % len(CYCLE)).cast("int")).cast("double")


def in_order(sources: DataFrame, scratch: Scratch) -> DataFrame:
    """Sources with `place`, their number from 0 by code point, null last; counted range by range."""
    numbered = scratch.stage(
        "numbered", sources.orderBy(F.asc_nulls_last("source")).withColumn("id", F.monotonically_increasing_id())
    )
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task of the sort
    rows = numbered.withColumn("range", F.shiftright("id", 33))
    ranges = rows.groupBy("range").agg(F.count("*").alias("n")).select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n"))
    place = F.col("n") + F.col("id") - F.shiftleft("range", 33)
    return rows.join(ranges, "range").withColumn("place", place).drop("id", "range", "n")


def with_targets(sources: DataFrame, total: int, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Sources(source_size, weight, ...) with `target`, their share of the total by weight; a share beyond
    max_repeats times its source stops there, and what is left over goes to the others by weight, until
    none is above. Each round is one pair of sums over the sources."""
    limit = F.col("source_size") * max_repeats
    open_weight = sources.agg(F.sum("weight")).first()[0]
    left, stopped = total, 0
    while open_weight:
        share = F.lit(float(left)) * F.col("weight") / F.lit(float(open_weight))
        above = share > limit
        n, limits, weight = sources.agg(
            F.count_if(above), F.sum(F.when(above, limit)), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if n == stopped:
            return sources.withColumn("target", F.when(above, limit.cast("double")).otherwise(share))
        left, open_weight, stopped = total - limits, weight, n
    return sources.withColumn("target", limit.cast("double"))


def components(members: DataFrame, scratch: Scratch) -> DataFrame:
    """For members(pattern, place): the place of each source and its component, the least place it is linked to."""
    labels, changed, turn = members.select("place", F.col("place").alias("component")).distinct(), not members.isEmpty(), 0
    while changed:
        least = members.join(labels, "place").groupBy("pattern").agg(F.min("component").alias("component"))
        lower = scratch.stage(
            f"lower-{turn}", members.join(least, "pattern").groupBy("place").agg(F.min("component").alias("component"))
        )
        # a component is a place itself: to its own component at once, so chains shorten by half a round
        further = lower.select(F.col("place").alias("component"), F.col("component").alias("further"))
        now = scratch.stage(f"labels-{turn}", lower.join(further, "component").select("place", F.col("further").alias("component")))
        before = labels.withColumnRenamed("component", "before")
        changed = not now.join(before, "place").filter("component <> before").isEmpty()
        labels, turn = now, turn + 1
    return labels


class Flow:
    """Words that patterns send to sources: as many as can be, at the least sum of repetition costs.

    The r-th pass over a pattern costs r a word, so costs are convex. The words of a pass are routed,
    over shortest augmenting paths, before any of the next one. A path may redirect what other patterns
    send but never lowers what a pattern sends in all, so the cheapest words stay in use.
    """

    def __init__(self, capacities: list[int], members: list[list[int]], demands: list[int], max_repeats: int):
        self.members = members
        self.need = list(demands)
        self.sent: list[dict[int, int]] = [{} for _ in capacities]
        self.senders: list[set[int]] = [set() for _ in demands]
        self.closed: set[int] = set()  # sources from which no need can be reached any more
        order = sorted(range(len(capacities)), key=lambda p: (len(members[p]), p))
        for _ in range(max_repeats):
            for p in order:
                spare = capacities[p]
                while spare > 0 and (path := self.path(p)):
                    spare -= self.push(path, spare)

    def path(self, start: int) -> list[tuple[int, int]] | None:
        """(pattern, source) steps to a source with need; each next pattern leaves the source before."""
        came: dict[int, list[tuple[int, int]]] = {}
        seen, queue = {start}, deque([(start, [])])
        while queue:
            p, steps = queue.popleft()
            for s in self.members[p]:
                if s in came or s in self.closed:
                    continue
                came[s] = [*steps, (p, s)]
                if self.need[s] > 0:
                    return came[s]
                for q in sorted(self.senders[s] - seen):
                    seen.add(q)
                    queue.append((q, came[s]))
        self.closed.update(came)
        return None

    def push(self, path: list[tuple[int, int]], spare: int) -> int:
        last = path[-1][1]
        leaving = [(q, s) for (_, s), (q, _) in zip(path, path[1:])]
        amount = min([spare, self.need[last], *(self.sent[q][s] for q, s in leaving)])
        for p, s in path:
            self.sent[p][s] = self.sent[p].get(s, 0) + amount
            self.senders[s].add(p)
        for q, s in leaving:
            self.sent[q][s] -= amount
            if not self.sent[q][s]:
                del self.sent[q][s]
                self.senders[s].discard(q)
        self.need[last] -= amount
        return amount


RECIPE = (
    "array<struct<pattern:string,capacity:bigint,sent:bigint,parts:array<struct<first:bigint,last:bigint,source:string>>>>"
)


def solved(patterns: list, max_repeats: int) -> list[tuple]:
    """The recipe of one component: of each pattern the words sent in all, and the stretch of each source."""
    patterns = sorted(patterns, key=lambda p: p["pattern"])
    sources = {m["place"]: m for p in patterns for m in p["members"]}
    number = {place: i for i, place in enumerate(sorted(sources))}
    listed = [sources[place] for place in number]
    members = [sorted(number[m["place"]] for m in p["members"]) for p in patterns]
    flow = Flow([p["capacity"] for p in patterns], members, [round(m["target"]) for m in listed], max_repeats)
    recipe = []
    for p, sent in zip(patterns, flow.sent):
        ends = list(accumulate(sent[s] for s in sorted(sent)))
        parts = [(end - sent[s], end, listed[s]["source"]) for s, end in zip(sorted(sent), ends)]
        recipe.append((p["pattern"], p["capacity"], sum(sent.values()), parts))
    return recipe


def recipe_of(patterns: DataFrame, weight: Callable[[Column], Column], max_repeats: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """For patterns(pattern, members, capacity): the flow's recipe by pattern, and the sources with their targets."""
    edges = patterns.select("pattern", "capacity", F.explode("members").alias("source"))
    sized = edges.groupBy("source").agg(F.sum("capacity").alias("source_size"))
    total = patterns.agg(F.sum("capacity")).first()[0] or 0  # a document of several sources counts once
    weighed = scratch.stage("weighed", in_order(sized, scratch).withColumn("weight", weight(F.col("place"))))
    sources = scratch.stage("sources", with_targets(weighed, total, max_repeats))
    named = sources.select(F.col("source").alias("name"), "place", "target")
    members = scratch.stage("members", edges.join(named, F.col("source").eqNullSafe(F.col("name"))).drop("name"))
    shared = patterns.filter(F.size("members") > 1).select("pattern")
    linked = components(members.join(shared, "pattern").select("pattern", "place"), scratch)
    own = members.join(linked, "place", "left").withColumn("component", F.coalesce("component", "place"))
    whole = own.groupBy("component", "pattern", "capacity").agg(F.collect_list(F.struct("place", "source", "target")).alias("members"))
    problems = whole.groupBy("component").agg(F.collect_list(F.struct("pattern", "capacity", "members")).alias("patterns"))
    solve = F.udf(lambda listed: solved(listed, max_repeats), RECIPE)
    return scratch.stage("recipe", problems.select(F.inline(solve("patterns")))), sources.select("source", "source_size", "target")


def mix(
    documents: DataFrame,
    weight: Callable[[Column], Column] = cycling_weight,
    max_repeats: int = MAX_REPEATS,
    seed: str = SEED,
) -> tuple[DataFrame, DataFrame]:
    """Mixes documents(doc_id, size, sources, ...), sources an array of names, null among them allowed; weight gives a source's
    weight by its place among the sources in order of code points.

    Returns (copies, sources): copies has the columns of documents and `copies`, an array of the source
    of each copy taken; sources has source, source_size (of all its documents) and target.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "mix")
    members = F.array_sort(F.array_distinct(F.coalesce("sources", F.array())))
    pattern = F.to_json(F.transform(members, lambda s: F.struct(s.alias("s"))))
    docs = scratch.stage("documents", documents.withColumn("pattern", pattern))
    patterns = scratch.stage(
        "patterns",
        docs.groupBy("pattern").agg(F.first("sources").alias("sources"), F.coalesce(F.sum("size"), F.lit(0)).alias("capacity"))
        .select("pattern", members.alias("members"), "capacity"),
    )
    recipe, sources = recipe_of(patterns, weight, max_repeats, scratch)
    turn = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    seeded = docs.withColumn("turn", turn).withColumn("range", F.substring("turn", 1, RANGE_DIGITS))
    before = Window.partitionBy("pattern").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # the recipe meets a row for each pattern and range, never the documents of a large pattern in one task
    ranges = (
        seeded.groupBy("pattern", "range").agg(F.sum("size").alias("range_size"))
        .select("pattern", "range", F.coalesce(F.sum("range_size").over(before), F.lit(0)).alias("before"))
        .join(recipe, "pattern", "left").fillna(0, ["capacity", "sent"])
    )
    within = Window.partitionBy("pattern", "range").orderBy("turn", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        seeded.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
        .join(ranges, ["pattern", "range"])
    )
    # twice the place of each copy's middle on the line of all passes, to stay in whole numbers
    middles = F.transform(
        F.sequence(F.lit(0), F.lit(max_repeats - 1)),
        lambda r: (r * F.col("capacity") + F.col("before") + F.col("inside")) * 2 + F.col("size"),
    )
    taken = F.filter(middles, lambda m: (m < F.col("sent") * 2) & (F.col("size") > 0))
    copies = F.transform(
        taken, lambda m: F.filter("parts", lambda x: (x["first"] * 2 <= m) & (m < x["last"] * 2))[0]["source"]
    )
    return placed.select(*documents.columns, copies.alias("copies")), sources


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(NOT_SPACE)).cast("long")


def mix_documents(docs: DataFrame) -> DataFrame:
    """doc_id, size, source, source_size, target and taken (words, repeats counted) for each row."""
    rows = docs.select("doc_id", words(whole_text()).alias("size"), F.array("source").alias("sources"))
    copies, sources = mix(rows)
    copies = copies.select("doc_id", "size", F.col("sources")[0].alias("from"), F.size("copies").alias("n"))
    return copies.join(sources, F.col("from").eqNullSafe(F.col("source"))).select(
        "doc_id", "size", "source", "source_size", "target", (F.col("n") * F.col("size")).cast("long").alias("taken")
    )


def draw_documents(docs: DataFrame) -> DataFrame:
    """The rows of docs that the mix takes, with all their columns and `copies`, how often each is taken."""
    rows = docs.select(
        F.struct("*").alias("doc"), "doc_id", words(whole_text(docs["text"])).alias("size"), F.array("source").alias("sources")
    )
    copies, _ = mix(rows)
    name = unused_name(docs, "copies")
    return copies.filter(F.size("copies") > 0).select("doc.*", F.size("copies").cast("long").alias(name))
