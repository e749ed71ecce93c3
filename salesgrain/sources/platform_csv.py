"""Delivery-platform CSV exports: found, recognised by header, typed, merged, loaded by slice."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesgrain.functions import fixed_values as fv
from salesgrain.functions import text
from salesgrain.functions.times import wall_clock
from salesgrain.params import Rules
from salesgrain.plans.staging import commit, new_run_id, numbered, read_line, remove, side_by_side
from salesgrain.sources.csv_records import QUOTED_CELL, Keep, csv_records, lazily
from salesgrain.sources.relations import SCHEMAS

CSV_NAMES = "*.[cC][sS][vV]"
MONTH = "_ym"


# ---- S2, S3: find files, recognise them ---------------------------------------------------
def _n_fields(raw: Column) -> Column:
    """Fields of a record's text."""
    unquoted = F.regexp_replace(raw, QUOTED_CELL, "")
    return F.length(F.regexp_replace(unquoted, "[^,]", "")) + 1


def _path(column: str) -> Column:
    """A file's name as listed or as its rows carry it, in one spelling."""
    return F.regexp_replace(F.url_decode(F.regexp_replace(column, r"\+", "%2B")), "^file:/+", "file:/")


def read_rows(spark: SparkSession, folder: str, keep: Keep = lazily) -> DataFrame:
    """Every record of every *.csv below a folder as an array of texts, with where it came from.

    A file is read by as many tasks as it has byte ranges. The widest record of the load is measured
    first, so nothing is cut off. Folders starting with "." or "_" are skipped by the file listing.
    """
    texts = csv_records(spark, folder, CSV_NAMES, keep).withColumn("n_fields", _n_fields(F.col("record")))
    widest = texts.agg(F.max("n_fields")).first()[0] or 1
    cells = [f"c{i}" for i in range(widest + 1)]
    parsed = F.from_csv("record", ", ".join(f"{c} string" for c in cells), {"multiLine": "true", "escape": '"'})
    path = _path("path")
    parts = F.split(path, "/")
    outer = F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda x: F.concat(F.lit("1"), x))
    return texts.withColumn("row", parsed).select(
        F.array(*[F.coalesce(F.col(f"row.{c}"), F.lit("")) for c in cells]).alias("cells"),
        "n_fields",
        path.alias("file"),
        # files of a folder come before its subfolders, names in order
        F.concat(outer, F.array(F.concat(F.lit("0"), F.element_at(parts, -1)))).alias("file_order"),
        "modified",
        "position",
    )


def found_files(spark: SparkSession, folder: str) -> DataFrame:
    """All *.csv files below a folder, as listed; a scan passes over those without a byte."""
    listed = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", CSV_NAMES).text(folder).inputFiles()
    return spark.createDataFrame([(name,) for name in listed], "name string").select(_path("name").alias("file"))


def kind_of(header: Column) -> Column:
    """The first kind, most specific first, whose signature the header contains."""
    found = F.lit(None).cast("string")
    for kind in reversed(fv.DETECTION_ORDER):
        signature = F.array(*[F.lit(name) for name in fv.SIGNATURES[kind]])
        found = F.when(F.size(F.array_except(signature, header)) == 0, kind).otherwise(found)
    return found


def tag_rows(rows: DataFrame) -> DataFrame:
    """Every record with its file's header and kind, whether it is one below the header, and whether it
    counts: a record that is neither header nor too short nor blank.

    The header is a file's first record, one row a file that meets the others of the file in a join.
    """
    first = rows.groupBy("file").agg(F.min("position").alias("first"), F.min_by("cells", "position").alias("names"))
    header = F.transform("names", lambda x: F.trim(F.regexp_replace(x, "\ufeff", "")))
    tagged = (
        rows.join(first.select("file", "first", header.alias("header")), "file")
        .withColumn("is_record", F.col("position") != F.col("first")).drop("first")
        .withColumn("kind", kind_of(F.col("header")))
    )
    counts = F.lit(False)
    for kind in fv.SIGNATURES:
        counts = counts | ((F.col("kind") == kind) & is_usable(kind))
    return tagged.withColumn("counts", F.coalesce(counts, F.lit(False)) & F.col("is_record"))


def file_report(tagged: DataFrame, files: DataFrame) -> DataFrame:
    """Per file its kind (NULL: not recognised), its records, and those too short or blank to count.

    A file without any record is listed with none.
    """
    is_record = F.col("is_record")
    sums = tagged.groupBy("file").agg(
        F.first("kind").alias("kind"), F.count_if(is_record).alias("records"),
        F.count_if(is_record & F.col("kind").isNotNull() & ~F.col("counts")).alias("ignored"),
    )
    return files.join(sums, "file", "left").fillna(0, ["records", "ignored"])


def field(name: str) -> Column:
    """The cell under a header name, the last one when a name repeats, NULL when it is absent."""
    from_end = F.array_position(F.reverse("header"), name)
    return F.when(from_end > 0, F.get("cells", F.size("header") - from_end.cast("int")))


def number(name: str) -> Column:
    return text.lenient_number(field(name))


def integer(name: str) -> Column:
    return text.lenient_int(field(name))


def day_month_year(name: str) -> Column:
    return F.to_date(F.trim(field(name)), "d/M/yyyy")


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


# ---- S5-S14: one parser per kind ---------------------------------------------------------
@dataclass(frozen=True)
class Export:
    """How one kind becomes a table.

    parse gives typed rows; rows of one file with equal keys are then either summed or the last
    one is taken. The slice is what a file replaces as a whole.
    """

    table: str
    parse: Callable[[DataFrame, Rules], DataFrame]
    keys: tuple[str, ...]
    slice_by: tuple[str, ...]
    slice_date: str | None = None
    combine: str = "last"  # last, sum, count
    by_store: Column | None = None


def _transactions(rows: DataFrame, rules: Rules) -> DataFrame:
    def cell(name: str) -> Column:
        return F.get("cells", F.lit(fv.TRANSACTION_FIELDS[name]))

    def amount(name: str) -> Column:
        return text.lenient_number(cell(name))

    created = F.to_timestamp_ntz(F.trim(cell("created")), F.lit("d MMM yyyy h:mm a"))
    category = F.lit("other")
    for label, name in fv.CATEGORY_NAMES.items():
        category = F.when(F.trim(cell("category")) == label, name).otherwise(category)
    transaction, booking = F.trim(cell("transaction")), F.trim(cell("booking"))
    fallback_id = F.concat_ws("|", booking, cell("category"), cell("created"))
    return rows.select(
        "*",
        F.when(transaction != "", transaction).otherwise(fallback_id).alias("row_id"),
        blank_to_null(booking).alias("booking_id"),
        created.cast("date").alias("business_date"), created.alias("created_at"),
        text.export_order_number(cell("short_no")).alias("gf_no"), category.alias("category"),
        F.trim(cell("status")).alias("status"), F.trim(cell("order_type")).alias("order_type"),
        amount("gross").alias("gross_thb"), amount("merchant_discount").alias("merchant_discount_thb"),
        amount("net").alias("net_thb"),
        (amount("commission_1") + amount("commission_2")).alias("commission_thb"),
        amount("marketing").alias("marketing_fee_thb"), amount("payout").alias("payout_thb"),
        blank_to_null(cell("cancel_reason")).alias("cancel_reason"),
        blank_to_null(cell("cancelled_by")).alias("cancelled_by"),
    )


def _turnover(rows: DataFrame, rules: Rules) -> DataFrame:
    return rows.select(
        "*", day_month_year(fv.COL_DATE).alias("business_date"), number(fv.COL_GROSS).alias("gross_thb"),
        number(fv.COL_NET).alias("net_thb"), integer(fv.COL_ORDERS).alias("orders"),
        number(fv.COL_AVG).alias("avg_order_thb"),
        F.nullif(number(fv.COL_AVG_RATING), F.lit(0).cast("decimal(18,4)")).alias("rating"),
    )


def _menu(rows: DataFrame, rules: Rules) -> DataFrame:
    return rows.select(
        "*", day_month_year(fv.COL_DATE).alias("business_date"), F.trim(field(fv.COL_ITEM)).alias("item"),
        number(fv.COL_UNITS).alias("units"), number(fv.COL_ITEM_THB).alias("thb"),
    )


def _offers(rows: DataFrame, rules: Rules) -> DataFrame:
    return rows.select(
        "*", day_month_year(fv.COL_DATE).alias("business_date"),
        F.trim(field(fv.COL_CAMPAIGN)).alias("campaign"), number(fv.COL_GROSS).alias("gross_thb"),
        number(fv.COL_NET).alias("net_thb"), integer(fv.COL_ORDERS).alias("orders"),
        number(fv.COL_SPEND).alias("spend_thb"),
    )


def _peak(rows: DataFrame, rules: Rules) -> DataFrame:
    hours = [f"{h:02d}" for h in range(24)]
    wide = rows.select(
        "*", day_month_year(fv.COL_DATE).alias("business_date"), *[integer(h).alias(f"h{h}") for h in hours]
    )
    stack = ", ".join(f"{int(h)}, h{h}" for h in hours)
    return wide.select("*", F.expr(f"stack(24, {stack}) AS (hour, orders)")).drop(*[f"h{h}" for h in hours])


def _ads_campaign(rows: DataFrame, rules: Rules) -> DataFrame:
    return rows.select(
        "*", F.make_date(integer("Yearly"), integer("Monthly"), integer("Daily")).alias("d"),
        integer("Hourly").alias("hour"), F.trim(field("Campaigns Name")).alias("campaign"),
        number("Local Ad Spend").alias("spend_thb"), integer("Impressions").alias("impressions"),
        integer("Clicks").alias("clicks"), integer("MenuVisit_").alias("menu_visits"),
        integer("AddToCart_").alias("add_to_cart"), integer("Ad Generated Orders").alias("orders"),
        number(fv.COL_AD_REVENUE).alias("revenue_thb"),
    )


def _keywords(rows: DataFrame, rules: Rules) -> DataFrame:
    keyword = F.trim(field("Matched Keywords"))
    brand = F.lit(False)
    for word in rules.brand_words:
        brand = brand | F.lower(keyword).contains(word.lower())
    year, month = integer("Yearly").cast("string"), integer("Monthly").cast("string")
    return rows.where(text.text_or_empty(keyword) != "").select(
        "*", F.concat_ws("-", F.lpad(year, 4, "0"), F.lpad(month, 2, "0")).alias("ym"),
        keyword.alias("keyword"), brand.alias("is_brand"), integer("Impressions").alias("impressions"),
        integer("Clicks").alias("clicks"), number("Local Ad Spend").alias("spend_thb"),
        integer("Ad Generated Orders").alias("orders"), number(fv.COL_AD_REVENUE).alias("revenue_thb"),
    )


def _miwi(rows: DataFrame, rules: Rules) -> DataFrame:
    return rows.select(
        "*", F.to_date(F.trim(field(fv.COL_DATE))).alias("business_date"),
        integer("Wrong Reported").alias("wrong"), integer("Missing Reported").alias("missing"),
        integer("Total Reported").alias("total_reported"),
        integer("Total Completed Orders").alias("completed_orders"),
    )


def _reviews(rows: DataFrame, rules: Rules) -> DataFrame:
    written = F.trim(field(fv.COL_DATE))
    day = F.array_join(F.slice(F.split(written, r"\s+"), 1, 3), " ")
    body = text.text_or_empty(field(fv.COL_REVIEW))
    return rows.select(
        "*", F.md5(F.concat_ws("|", field(fv.COL_STORE), written, body)).alias("review_key"),
        F.to_date(day, "d MMM yyyy").alias("review_date"), integer(fv.COL_RATING).alias("rating"),
        body.alias("review"), (F.trim(text.text_or_empty(field(fv.COL_REPLY))) != "").alias("replied"),
        blank_to_null(field(fv.COL_SERVICE)).alias("service_type"),
    )


def _combos(rows: DataFrame, rules: Rules) -> DataFrame:
    name = F.element_at(F.split("file", "/"), -1)
    stamp = F.get(F.reverse(F.regexp_extract_all(name, F.lit(r"(\d{2})_(\d{2})_(\d{2})"), F.lit(0))), F.lit(0))
    piece = F.split(stamp, "_")
    named = F.make_date(F.get(piece, F.lit(2)).cast("int") + 2000, F.get(piece, F.lit(1)).cast("int"), F.get(piece, F.lit(0)).cast("int"))
    local = wall_clock(rows, "modified")
    combo = F.trim(field(fv.COL_COMBO))
    return local.where(text.text_or_empty(combo) != "").select(
        "*", F.coalesce(named, F.col("modified").cast("date")).alias("as_of"), combo.alias("combo")
    )


def _store(name: str) -> Column:
    return field(name)


def exports() -> dict[str, Export]:
    store = _store(fv.COL_STORE)
    first_store = F.get("cells", F.lit(fv.TRANSACTION_FIELDS["store"]))
    branch_month = ("location_id", MONTH)
    branch_day = ("location_id", "business_date")

    def branch_export(table: str, parse, keys: tuple[str, ...], combine: str = "last", at: Column = store) -> Export:
        return Export(table, parse, keys, branch_month, "business_date", combine, at)

    return {
        "transactions": branch_export("grab_orders", _transactions, ("row_id",), at=first_store),
        "turnover": branch_export("grab_daily", _turnover, branch_day),
        "menu": branch_export("grab_menu_daily", _menu, (*branch_day, "item"), "sum"),
        "offers": branch_export("grab_offers", _offers, (*branch_day, "campaign"), "sum"),
        "peak": branch_export("grab_peak", _peak, (*branch_day, "hour"), "sum"),
        "miwi_store": branch_export("grab_miwi_daily", _miwi, branch_day),
        "reviews": Export("grab_reviews", _reviews, ("review_key",), branch_month, "review_date", "last", store),
        "combo": Export("grab_combos", _combos, ("location_id", "as_of", "combo"), ("location_id", "as_of"),
                        None, "count", store),
        "ads_campaign": Export("grab_ads_hourly", _ads_campaign, ("d", "hour", "campaign"), ("d",), None, "sum"),
        "keywords": Export("grab_keywords", _keywords, ("ym", "keyword"), ("ym",), None, "sum"),
    }


def table_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(SCHEMAS[table])


# ---- S4: stores ---------------------------------------------------------------------------
def with_location(rows: DataFrame, export: Export, rules: Rules) -> DataFrame:
    if export.by_store is None:
        return rows
    return rows.withColumn("store", export.by_store).withColumn(
        "location_id", text.store_location(export.by_store, rules.store_names)
    )


def is_usable(kind: str) -> Column:
    """Too short transaction rows and entirely blank rows of the other kinds do not count."""
    if kind == "transactions":
        return F.col("n_fields") >= fv.TRANSACTION_MIN_FIELDS
    return F.exists("cells", lambda x: F.trim(x) != "")


def unknown_stores(rows: DataFrame, kind: str, rules: Rules) -> DataFrame:
    """Quarantine report: store names no branch is known for, with their rows."""
    export = exports()[kind]
    placed = with_location(rows, export, rules)
    if export.by_store is None:
        return placed.select(F.lit(None).cast("string").alias("store"), F.lit(0).cast("bigint").alias("rows")).limit(0)
    return placed.where(F.col("location_id").isNull()).groupBy("store").agg(F.count("*").alias("rows"))


def to_table(rows: DataFrame, kind: str, rules: Rules) -> DataFrame:
    """Typed, merged rows of one kind, with the slice they belong to.

    Where several files hold the same slice the last file has it alone, as if the files had been
    loaded one after the other.
    """
    export = exports()[kind]
    placed = with_location(rows, export, rules)
    if export.by_store is not None:
        placed = placed.where(F.col("location_id").isNotNull())
    parsed = export.parse(placed, rules)
    schema = table_schema(export.table)
    columns, keys = schema.names, list(export.keys)
    measures = [c for c in columns if c not in keys]
    by_file = parsed.groupBy("file_order", *keys)
    if export.combine == "count":
        merged = by_file.agg(F.count("*").cast("int").alias("n"))
    elif export.combine == "sum":
        flags = {c for c in measures if c == "is_brand"}
        merged = by_file.agg(*[(F.max(c) if c in flags else F.sum(c)).alias(c) for c in measures])
    else:
        merged = by_file.agg(F.max_by(F.struct(*measures), "position").alias("row")).select(
            "file_order", *keys, "row.*"
        )
    if export.slice_date is not None:
        merged = merged.withColumn(MONTH, F.date_format(export.slice_date, "yyyy-MM"))
    slices = list(export.slice_by)
    last = merged.groupBy(*slices).agg(F.max("file_order").alias("file_order"))
    typed = merged.join(last, [*slices, "file_order"], "left_semi")
    return typed.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields],
        *[c for c in slices if c not in columns],
    )


# ---- S15: load ----------------------------------------------------------------------------
KINDS_AT_ONCE = 4
SLICE = "_slice"
KEEP_LOADS = 3


def current_slices(spark: SparkSession, root: str) -> dict[str, dict[str, str]]:
    """Which load holds each slice of each table, as of the newest snapshot."""
    newest = numbered(spark, f"{root}/snapshots")[:1]
    return read_line(spark, newest[0][1])["tables"] if newest else {}


def write_slices(table: DataFrame, export: Export, path: str) -> None:
    """Writes the rows of a load, one folder per slice; the files carry all columns of the table themselves."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in export.slice_by]
    columns = table_schema(export.table).names
    # a large slice is split over several files
    rows = table.select(*columns, F.concat_ws(",", *parts).alias(SLICE)).hint("rebalance", F.col(SLICE))
    rows.write.partitionBy(SLICE).parquet(path)


def written_slices(spark: SparkSession, path: str) -> list[str]:
    """The slice folders of a written table."""
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(name for f in fs.listStatus(there) if (name := f.getPath().getName()).startswith(f"{SLICE}="))


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A loaded table, as of the newest snapshot, in contract column order."""
    slices = current_slices(spark, root)[table]
    paths = [f"{root}/loads/{load}/{table}/{name}" for name, load in sorted(slices.items())]
    if not paths:
        return spark.createDataFrame([], table_schema(table))
    # the slices of several loads side by side; their names are no columns
    return spark.read.schema(SCHEMAS[table]).option("recursiveFileLookup", True).parquet(*paths)


@dataclass(frozen=True)
class LoadReport:
    files: DataFrame  # file, kind (NULL: skipped), records, ignored
    unknown: DataFrame  # kind, store, rows
    categories: DataFrame | None  # S24: category, rows


def load_exports(spark: SparkSession, folder: str, root: str, rules: Rules, load: str | None = None) -> LoadReport:
    """Load every recognised export below a folder into `root`; running it again changes nothing.

    A load writes its own slices only, side by side into its own folder, and a snapshot, committed last, names
    for every slice the load that holds it: all of a load becomes visible together, and one that fails
    leaves the tables as they were. Of loads that run at the same time none loses what another one
    wrote; for a slice that both have, the last to commit counts. Rows are parsed once and laid out by kind; that
    copy goes at the end. The last KEEP_LOADS snapshots stay, with the slices that they name.
    """
    load = load or new_run_id()
    out, work = f"{root}/loads/{load}", f"{root}/work/{load}"
    known = exports()
    try:
        def stored(name: str, df: DataFrame) -> DataFrame:
            df.write.parquet(f"{work}/{name}")
            return spark.read.schema(df.schema).parquet(f"{work}/{name}")

        tagged = tag_rows(read_rows(spark, folder, stored))
        # what doesn't count lies apart: no later plan can meet a header where it expects a date
        tagged.write.partitionBy("kind", "counts").parquet(f"{work}/records")
        rows = spark.read.schema(tagged.schema).parquet(f"{work}/records")
        files = file_report(rows, found_files(spark, folder))
        files.write.parquet(f"{out}/files")
        files = spark.read.schema(files.schema).parquet(f"{out}/files")
        kinds = [r.kind for r in files.where("kind IS NOT NULL").select("kind").distinct().collect()]  # ten at most
        data = rows.where("counts")

        def write(kind: str) -> None:
            export, own = known[kind], data.where(F.col("kind") == kind)
            write_slices(to_table(own, kind, rules), export, f"{out}/{export.table}")
            lost = unknown_stores(own, kind, rules).select("store", "rows")
            lost.write.parquet(f"{out}/unknown/kind={kind}")

        side_by_side(write, kinds, KINDS_AT_ONCE)
    except BaseException:
        remove(spark, out)
        raise
    finally:
        remove(spark, work)
    own = {known[k].table: dict.fromkeys(written_slices(spark, f"{out}/{known[k].table}"), load) for k in kinds}

    def with_own(before: dict) -> dict:
        tables = before.get("tables", {})
        return {"load": load, "tables": tables | {name: tables.get(name, {}) | slices for name, slices in own.items()}}

    commit(spark, f"{root}/snapshots", with_own)
    _forget_old_loads(spark, root)
    schema = "store string, rows bigint, kind string"
    unknown = spark.read.schema(schema).parquet(f"{out}/unknown") if kinds else spark.createDataFrame([], schema)
    categories = category_tally(read_table(spark, root, "grab_orders")) if "transactions" in kinds else None
    return LoadReport(files, unknown.select("kind", "store", "rows"), categories)


def _forget_old_loads(spark: SparkSession, root: str) -> None:
    """Snapshots beyond the last KEEP_LOADS go, with the slices and loads that no kept one names."""
    snapshots = [(path, read_line(spark, path)) for _, path in numbered(spark, f"{root}/snapshots")]

    def named(lines: list) -> tuple[set[str], set[str]]:
        slices = {
            f"{load}/{table}/{name}"
            for _, line in lines for table, slices in line["tables"].items() for name, load in slices.items()
        }
        return slices, {line["load"] for _, line in lines} | {x.split("/")[0] for x in slices}

    slices, loads = named(snapshots)
    kept_slices, kept_loads = named(snapshots[:KEEP_LOADS])
    for path, _ in snapshots[KEEP_LOADS:]:
        remove(spark, path)
    for name in loads - kept_loads:
        remove(spark, f"{root}/loads/{name}")
    for name in slices - kept_slices:
        if name.split("/")[0] in kept_loads:
            remove(spark, f"{root}/loads/{name}")


def category_tally(orders: DataFrame) -> DataFrame:
    """S24."""
    return orders.groupBy("category").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "category")
