"""Records of CSV files that many tasks read at once, quoted line breaks included.

A file is read line by line in byte ranges. Whether a line begins inside a quoted cell is not known in its own
range, so each line is a function from "inside" to "inside": it sets it, swaps it or leaves it as it is. The
functions of a range are combined in a window, those of the ranges in one window per file, over a single row
per range; then every line knows the start of its record, and the lines of a record are put together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

# a quoted cell from its opening to the next comma; a quote inside is doubled
QUOTED_CELL = r'(?:^|(?<=,))"[^"]*+(?:""[^"]*+)*+"[^,]*+'
OPEN_CELL = r'(?:^|,)"'

Keep = Callable[[str, DataFrame], DataFrame]


def lazily(name: str, df: DataFrame) -> DataFrame:
    return df


def opens(text: Column) -> Column:
    """1 where a text that begins outside of quotes ends inside of a quoted cell, else 0."""
    return F.regexp_replace(text, QUOTED_CELL, "").rlike(OPEN_CELL).cast("int")


def inside_before(from_out: str, from_in: str, ordered: WindowSpec) -> Callable[[Column], Column]:
    """For rows that take outside to from_out and inside to from_in: what holds before each row, by what holds at first."""
    out, inn = F.col(from_out), F.col(from_in)
    swaps = F.coalesce(F.sum(F.when((out == 1) & (inn == 0), 1).otherwise(0)).over(ordered), F.lit(0))
    # what a row sets, less the swaps up to it, holds until the next one sets it
    return lambda first: (F.coalesce(F.last("_set", ignorenulls=True).over(ordered), first) + swaps) % 2


def with_set(rows: DataFrame, from_out: str, from_in: str, up_to_here: WindowSpec) -> DataFrame:
    out, inn = F.col(from_out), F.col(from_in)
    swaps = F.sum(F.when((out == 1) & (inn == 0), 1).otherwise(0)).over(up_to_here)
    return rows.withColumn("_set", F.when(out == inn, (out + swaps) % 2))


def lines_of(spark: SparkSession, folder: str, names: str) -> DataFrame:
    """Every line of the files, with its range; line_id rises within a range."""
    return (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", names).option("lineSep", "\n").text(folder)
        .select(
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("modified"),
            F.col("_metadata.file_block_start").alias("range"), F.monotonically_increasing_id().alias("line_id"),
            F.col("value").alias("line"),
        )
    )


def csv_records(spark: SparkSession, folder: str, names: str, keep: Keep = lazily) -> DataFrame:
    """path, modified, position, record of every record that isn't empty; positions rise within a file.

    keep may store the lines, so that the ranges of all readings agree whatever executors come and go.
    A quote that is never closed takes the rest of its file into one record, as for any CSV reader. A carriage
    return before a break that ends a record belongs to the break.
    """
    lines = keep("lines", lines_of(spark, folder, names))
    quoted = F.col("line").contains('"')
    known = lines.select(
        "*", F.when(quoted, opens(F.col("line"))).otherwise(0).alias("from_out"),
        F.when(quoted, opens(F.concat(F.lit('"'), "line"))).otherwise(1).alias("from_in"),
    )
    in_range = Window.partitionBy("path", "range").orderBy("line_id")
    so_far, earlier = (in_range.rowsBetween(Window.unboundedPreceding, end) for end in (0, -1))
    before = inside_before("from_out", "from_in", earlier)
    known = with_set(known, "from_out", "from_in", so_far).withColumns({"b0": before(F.lit(0)), "b1": before(F.lit(1))})
    for entry in ("0", "1"):  # both ways the range may begin
        begins = F.when(F.col(f"b{entry}") == 0, F.col("line_id"))
        known = known.withColumn(f"start{entry}", F.last(begins, ignorenulls=True).over(so_far)).withColumn(
            f"end{entry}", F.when(F.col(f"b{entry}") == 1, F.col("from_in")).otherwise(F.col("from_out"))
        )
    ends = ("end0", "end1", "start0", "start1")
    ranges = known.groupBy("path", "range").agg(F.max_by(F.struct(*ends), "line_id").alias("last")).select("path", "range", "last.*")

    in_file = Window.partitionBy("path").orderBy("range")
    up_to, earlier = (in_file.rowsBetween(Window.unboundedPreceding, end) for end in (0, -1))
    entry = inside_before("end0", "end1", earlier)(F.lit(0))
    ranges = with_set(ranges, "end0", "end1", up_to).withColumn("inside", entry)
    own = F.when(F.col("inside") == 1, F.col("start1")).otherwise(F.col("start0"))
    ranges = ranges.withColumn("own", F.when(own.isNotNull(), F.struct("range", own.alias("line_id"))))
    ranges = ranges.select("path", "range", "inside", F.last("own", ignorenulls=True).over(earlier).alias("open"))

    start = F.when(F.col("inside") == 1, F.col("start1")).otherwise(F.col("start0"))
    placed = known.join(ranges, ["path", "range"]).select(
        "path", "modified", "range", "line_id", "line",
        F.when(start.isNotNull(), F.struct("range", start.alias("line_id"))).otherwise(F.col("open")).alias("position"),
    )
    pieces = F.array_sort(F.collect_list(F.struct("range", "line_id", "line")))
    text = F.array_join(F.transform(pieces, lambda piece: piece["line"]), "\n")
    whole = placed.groupBy("path", "modified", "position").agg(text.alias("record"))
    bare = F.regexp_replace(F.regexp_replace("record", r"\r\z", ""), "^\ufeff", "")
    return keep("texts", whole.withColumn("record", bare).where("record <> ''"))
