"""CSV exports: found, recognised, typed, merged by slice; small inputs merged by key."""

from __future__ import annotations

import csv
import datetime as dt
import io
import os
from decimal import Decimal

import pytest
from conftest import rows

from salesgrain.functions import fixed_values as fv
from salesgrain.params import Rules
from salesgrain.sources import platform_csv, small_inputs

RULES = Rules(brand_words=("mybrand",), store_names={"Park Silom": "silom", "Gaysorn": "gaysorn"})
SILOM, GAYSORN = "Noodles - Park Silom", "Noodles - Gaysorn Tower"


def write(folder, name, records, bom=True):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    out = io.StringIO()
    csv.writer(out).writerows(records)
    with open(path, "wb") as f:
        f.write((b"\xef\xbb\xbf" if bom else b"") + out.getvalue().encode())


def transaction(**cells):
    row = [""] * 64
    for name, value in cells.items():
        row[fv.TRANSACTION_FIELDS[name]] = value
    return row


def header(kind, *more):
    return [*fv.SIGNATURES[kind], *more]


TRANSACTION_HEADER = ["หมวดหมู่", "ยอดขายสุทธิ", "ทั้งหมด", "Transaction ID", *["ชื่อร้าน"] * 60]


def day_row(day, store=SILOM, gross="1,000", orders="4", rating="4.5"):
    return [day, store, gross, orders, rating, "900", "250"]


DAY_HEADER = header("turnover", fv.COL_NET, fv.COL_AVG)


@pytest.fixture()
def loader(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    os.makedirs(folder)

    def load():
        return platform_csv.load_exports(spark, folder, root, RULES)

    def read(table, *keys):
        return rows(platform_csv.read_table(spark, root, table), *keys)

    return folder, load, read


def test_kinds_are_recognised_by_their_header_set(spark, loader):
    folder, load, _ = loader
    for kind in fv.SIGNATURES:
        names = list(fv.SIGNATURES[kind])[::-1] + ["extra"]
        write(folder, f"deep/er/{kind}.CSV", [names, ["x"] * len(names)])
    write(folder, "unknown.csv", [["a", "b"], ["1", "2"]])
    write(folder, "_skipped/turnover.csv", [DAY_HEADER, day_row("01/08/2026")])
    write(folder, "empty.csv", [], bom=False)
    write(folder, "note.txt", [DAY_HEADER])
    tagged = platform_csv.tag_rows(platform_csv.read_rows(spark, folder))
    files = rows(platform_csv.file_report(tagged, platform_csv.found_files(spark, folder)))
    kinds = {os.path.basename(r["file"]): (r["kind"], r["records"]) for r in files}
    assert kinds.pop("unknown.csv") == (None, 1) and kinds.pop("empty.csv") == (None, 0)
    assert kinds == {f"{kind}.CSV": (kind, 1) for kind in fv.SIGNATURES}


@pytest.mark.parametrize("width", [61, 127, 128, 129, 300])
def test_records_of_any_width_load(loader, width):
    folder, load, read = loader
    more = [""] * (width - 64) if width > 64 else []
    row = transaction(store=SILOM, transaction="T1", created="5 Aug 2026 1:07 PM", category="x", gross="5")
    write(folder, "t.csv", [(TRANSACTION_HEADER + more)[:width], (row + more)[:width]])
    # signature columns that lie far to the right
    write(folder, "s.csv", [[f"x{i}" for i in range(width)] + DAY_HEADER, [""] * width + day_row("01/08/2026")])
    report = load()
    assert [r["row_id"] for r in read("grab_orders")] == ["T1"] and len(read("grab_daily")) == 1
    assert all(r["kind"] and r["records"] == 1 and r["ignored"] == 0 for r in rows(report.files))


def test_the_report_names_what_was_not_loaded(loader):
    folder, load, _ = loader
    row = transaction(store=SILOM, transaction="T", created="5 Aug 2026 1:07 PM")
    write(folder, "t.csv", [TRANSACTION_HEADER, row[:40], row])
    write(folder, "blank.csv", [DAY_HEADER, ["", " "], day_row("01/08/2026")])
    write(folder, "empty.csv", [], bom=False)
    write(folder, "odd.csv", [["a"], ["b"]])
    got = {os.path.basename(r["file"]): (r["kind"], r["records"], r["ignored"]) for r in rows(load().files)}
    assert got == {"t.csv": ("transactions", 2, 1), "blank.csv": ("turnover", 2, 1), "empty.csv": (None, 0, 0), "odd.csv": (None, 1, 0)}


def test_a_load_is_visible_as_a_whole_or_not_at_all(spark, loader, monkeypatch):
    folder, load, read = loader
    hours = [f"{h:02d}" for h in range(24)]
    write(folder, "s.csv", [DAY_HEADER, day_row("01/08/2026", gross="1")])
    write(folder, "p.csv", [[fv.COL_DATE, fv.COL_STORE, *hours], ["01/08/2026", SILOM, *["1"] * 24]])
    load()
    write(folder, "s.csv", [DAY_HEADER, day_row("01/08/2026", gross="2")])
    write(folder, "m.csv", [header("menu", fv.COL_ITEM_THB), ["01/08/2026", SILOM, "A", "2", "100"]])
    whole = platform_csv.write_slices

    def failing(table, export, path):
        if export.table == "grab_peak":
            raise RuntimeError("lost")
        whole(table, export, path)

    monkeypatch.setattr(platform_csv, "write_slices", failing)
    with pytest.raises(RuntimeError, match="lost"):
        load()
    assert [r["gross_thb"] for r in read("grab_daily")] == [1] and len(read("grab_peak")) == 24
    with pytest.raises(KeyError):
        read("grab_menu_daily")
    monkeypatch.setattr(platform_csv, "write_slices", whole)
    for _ in range(platform_csv.KEEP_LOADS + 1):
        load()
    assert [r["gross_thb"] for r in read("grab_daily")] == [2] and len(read("grab_menu_daily")) == 1
    root = os.path.join(os.path.dirname(folder), "out")
    assert len(os.listdir(os.path.join(root, "loads"))) == platform_csv.KEEP_LOADS
    assert not os.path.isdir(os.path.join(root, "work")) or not os.listdir(os.path.join(root, "work"))


def test_transactions(loader):
    folder, load, read = loader
    base = dict(store=SILOM, created="5 Aug 2026 1:07 PM", category="ชำระเงิน", status="ok", booking="B1",
                short_no="GF-851T", gross="1,200.50", net="1000", commission_1="-100", commission_2="-7.5", payout="800")
    write(folder, "t.csv", [
        TRANSACTION_HEADER,
        transaction(transaction="T1", **{**base, "gross": "1"}),
        transaction(transaction="T1", **base),  # the same row again: the last one wins
        transaction(**{**base, "category": "โฆษณา"}),  # no transaction id
        transaction(transaction="T3", **{**base, "category": "x", "short_no": "GF-50", "cancel_reason": "sold out"}),
        transaction(transaction="T4", **{**base, "store": "Noodles - Elsewhere"}),
        transaction(transaction="T5", **base)[:40],  # too short
    ])
    report = load()
    got = read("grab_orders", "row_id")
    assert set(got) == {"T1", "B1|โฆษณา|5 Aug 2026 1:07 PM", "T3"}
    one = got["T1"]
    assert one["gross_thb"] == Decimal("1200.5") and one["commission_thb"] == Decimal("-107.5")
    assert one["created_at"] == dt.datetime(2026, 8, 5, 13, 7) and one["business_date"] == dt.date(2026, 8, 5)
    assert one["gf_no"] == "851" and one["category"] == "payment" and one["cancel_reason"] is None
    assert got["T3"]["category"] == "other" and got["T3"]["gf_no"] == "050"
    assert rows(report.unknown) == [{"kind": "transactions", "store": "Noodles - Elsewhere", "rows": 1}]
    assert {r["category"]: r["rows"] for r in rows(report.categories)} == {"payment": 1, "ads": 1, "other": 1}


def test_last_row_wins_and_rating_zero_is_unknown(loader):
    folder, load, read = loader
    write(folder, "s.csv", [DAY_HEADER, day_row("01/08/2026", gross="5"), day_row("01/08/2026", rating="0"), ["", " "]])
    load()
    (got,) = read("grab_daily")
    assert got["gross_thb"] == 1000 and got["net_thb"] == 900 and got["orders"] == 4 and got["rating"] is None


def test_sums_counts_and_unpivot(loader):
    folder, load, read = loader
    write(folder, "m.csv", [header("menu", fv.COL_ITEM_THB), ["01/08/2026", SILOM, "A ", "2", "100"],
                            ["01/08/2026", SILOM, "A", "3", "150"]])
    write(folder, "o.csv", [header("offers", fv.COL_GROSS, fv.COL_NET, fv.COL_ORDERS),
                            ["01/08/2026", SILOM, "C", "10", "100", "90", "2"], ["01/08/2026", SILOM, "C", "5", "50", "40", "1"]])
    hours = [f"{h:02d}" for h in range(24)]
    write(folder, "p.csv", [[fv.COL_DATE, fv.COL_STORE, *hours], ["01/08/2026", SILOM, *["1"] * 24],
                            ["01/08/2026", SILOM, *["2"] * 23, ""]])
    write(folder, "combo 31_08_26 to 30_09_26.csv", [header("combo"), [SILOM, "X"], [SILOM, "X"], [SILOM, ""]])
    load()
    assert [(r["item"], r["units"], r["thb"]) for r in read("grab_menu_daily")] == [("A", 5, 250)]
    assert [(r["orders"], r["spend_thb"], r["net_thb"]) for r in read("grab_offers")] == [(3, 15, 130)]
    peak = read("grab_peak", "hour")
    assert len(peak) == 24 and peak[0]["orders"] == 3 and peak[23]["orders"] == 1
    assert read("grab_combos") == [{"location_id": "silom", "as_of": dt.date(2026, 9, 30), "combo": "X", "n": 2}]


def test_ads_keywords_missing_items_reviews(loader):
    folder, load, read = loader
    measures = ["Local Ad Spend", "Clicks", "MenuVisit_", "AddToCart_", "Ad Generated Orders", fv.COL_AD_REVENUE,
                "Yearly", "Monthly", "Daily"]
    ad = ["C1", "9", "1,200", "13", "10.5", "3", "2", "1", "1", "99", "2026", "8", "7"]
    write(folder, "a.csv", [header("ads_campaign", *measures), ad, ad])
    word = ["Noodle MYBRAND", "9", "100", "2026", "8", "3", "5.5", "1", "10"]
    names = header("keywords", "Yearly", "Monthly", "Clicks", "Local Ad Spend", "Ad Generated Orders", fv.COL_AD_REVENUE)
    write(folder, "k.csv", [names, word, word, ["", *word[1:]], ["plain", *word[1:]]])
    miwi = header("miwi_store", fv.COL_DATE, "Wrong Reported", "Missing Reported", "Total Reported", "Total Completed Orders")
    write(folder, "w.csv", [miwi, [SILOM, "1", "2026-08-01", "1", "2", "3", "50"], [SILOM, "1", "2026-08-01", "0", "1", "1", "60"]])
    review = header("reviews", fv.COL_DATE, fv.COL_REPLY)
    text = "good,\nvery good"
    write(folder, "r.csv", [review, [SILOM, text, "5", "c", "7 Aug 2026 10:00 AM", " "],
                            [SILOM, text, "5", "c", "7 Aug 2026 10:00 AM", "thanks"]])
    load()
    (ads,) = read("grab_ads_hourly")
    assert ads["d"] == dt.date(2026, 8, 7) and ads["hour"] == 13 and ads["impressions"] == 2400 and ads["spend_thb"] == 21
    words = read("grab_keywords", "keyword")
    assert set(words) == {"Noodle MYBRAND", "plain"} and words["Noodle MYBRAND"]["is_brand"]
    assert words["Noodle MYBRAND"]["ym"] == "2026-08" and words["Noodle MYBRAND"]["impressions"] == 200
    (missing,) = read("grab_miwi_daily")
    assert missing["completed_orders"] == 60 and missing["missing"] == 1
    (one,) = read("grab_reviews")
    assert one["review"] == text and one["replied"] and one["review_date"] == dt.date(2026, 8, 7)


def test_a_file_replaces_exactly_its_slices_and_a_rerun_changes_nothing(loader):
    folder, load, read = loader
    write(folder, "1.csv", [DAY_HEADER, day_row("01/08/2026", gross="1"), day_row("01/08/2026", GAYSORN, gross="2"),
                            day_row("01/09/2026", gross="3")])
    load()
    before = read("grab_daily", "location_id", "business_date")
    load()
    assert read("grab_daily", "location_id", "business_date") == before
    # a later file for one branch-month drops that month's other days, and nothing else
    write(folder, "sub/0.csv", [DAY_HEADER, day_row("02/08/2026", gross="9")])
    load()
    got = {k: r["gross_thb"] for k, r in read("grab_daily", "location_id", "business_date").items()}
    assert got == {
        ("silom", dt.date(2026, 8, 2)): 9, ("gaysorn", dt.date(2026, 8, 1)): 2, ("silom", dt.date(2026, 9, 1)): 3,
    }


def stored_files(root):
    found = [os.path.join(d, f) for d, _, names in os.walk(f"{root}/loads") for f in names if f.endswith(".parquet")]
    return {f for f in found if "/grab_" in f}


def test_a_load_writes_its_own_slices_only(spark, tmp_path):
    root = str(tmp_path / "out")
    for month in range(1, 7):
        write(str(tmp_path / f"in{month}"), "s.csv", [DAY_HEADER, *[day_row(f"{d:02d}/{month:02d}/2026", gross=str(month)) for d in (1, 2)]])
    seen = set()
    for month in range(1, 7):
        platform_csv.load_exports(spark, str(tmp_path / f"in{month}"), root, RULES)
        new, seen = stored_files(root) - seen, stored_files(root)
        assert len({os.path.dirname(f) for f in new}) == 1  # one branch-month
    got = rows(platform_csv.read_table(spark, root, "grab_daily"), "business_date")
    assert {d.month: int(r["gross_thb"]) for d, r in got.items()} == {m: m for m in range(1, 7)} and len(got) == 12
    # the slices of dropped snapshots stay while a kept one names them, and go when none does
    for _ in range(platform_csv.KEEP_LOADS):
        platform_csv.load_exports(spark, str(tmp_path / "in1"), root, RULES)
    slices = [os.path.dirname(f) for f in stored_files(root)]
    assert len({os.path.basename(d) for d in slices}) == 6
    assert sum("2026-01" in d for d in set(slices)) == platform_csv.KEEP_LOADS
    assert len(os.listdir(f"{root}/snapshots")) == platform_csv.KEEP_LOADS * 2  # each with its checksum


def test_loads_that_meet_lose_nothing(spark, tmp_path, monkeypatch):
    from salesgrain.plans import staging

    root = str(tmp_path / "out")
    write(str(tmp_path / "a"), "s.csv", [DAY_HEADER, day_row("01/08/2026", gross="1")])
    write(str(tmp_path / "b"), "s.csv", [DAY_HEADER, day_row("01/09/2026", gross="2"), day_row("01/08/2026", GAYSORN, gross="3")])
    write(str(tmp_path / "b"), "m.csv", [header("menu", fv.COL_ITEM_THB), ["01/08/2026", SILOM, "A", "2", "100"]])
    plain, met = staging.write_new, []

    def late(spark, content, path):
        if not met:  # another load is committed between this one's reading and its commit
            met.append(path)
            platform_csv.load_exports(spark, str(tmp_path / "b"), root, RULES)
        return plain(spark, content, path)

    monkeypatch.setattr(staging, "write_new", late)
    platform_csv.load_exports(spark, str(tmp_path / "a"), root, RULES)
    got = rows(platform_csv.read_table(spark, root, "grab_daily"), "location_id", "business_date")
    assert {k: r["gross_thb"] for k, r in got.items()} == {
        ("silom", dt.date(2026, 8, 1)): 1, ("silom", dt.date(2026, 9, 1)): 2, ("gaysorn", dt.date(2026, 8, 1)): 3,
    }
    assert len(rows(platform_csv.read_table(spark, root, "grab_menu_daily"))) == 1
    assert not plain(spark, "{}", f"{root}/snapshots/0000000001")  # taken
    assert not [f for f in os.listdir(f"{root}/snapshots") if f.startswith("_")]


def test_weather_merge(spark):
    schema = "d date, rain_mm double, tmax_c double"
    day = [dt.date(2026, 10, i) for i in range(1, 8)]
    stored = spark.createDataFrame([(day[0], 1.0, 30.0), (day[1], 1.0, 30.0)], schema)
    archive = spark.createDataFrame([(day[1], 2.0, 31.0), (day[2], None, 31.0)], schema)
    forecast = spark.createDataFrame([(day[1], 9.0, 9.0), (day[2], 3.0, 32.0), (day[3], 4.0, 33.0), (day[6], 5.0, 34.0)], schema)
    got = rows(small_inputs.merge_weather(stored, archive, forecast, day[3]), "d")
    assert {d: r["rain_mm"] for d, r in got.items()} == {day[0]: 1, day[1]: 2, day[2]: 3, day[3]: 4}


def test_seats_seed_then_update(spark, shop):
    seed = small_inputs.seat_seed(shop.rel["locations"])
    assert {r["location_id"]: r["open_hour"] for r in rows(seed)} == {"silom": 9, "rama9": 10}
    known = spark.createDataFrame([("silom", 73, 10, 20)], "location_id string, seats int, open_hour int, close_hour int")
    kept = rows(small_inputs.insert_missing(known, seed, ["location_id"]), "location_id")
    assert kept["silom"]["seats"] == 73 and kept["rama9"]["seats"] is None
    updated = rows(small_inputs.upsert(seed, known, ["location_id"]), "location_id")
    assert updated["silom"]["seats"] == 73 and len(updated) == 2


def test_hand_kept_lists_merge_by_key(spark, shop):
    seats = small_inputs.seat_list(spark)
    assert rows(seats, "location_id")["silom"]["seats"] == 73
    seeded = small_inputs.seat_seed(shop.rel["locations"])
    merged = small_inputs.upsert(seeded, seats, ["location_id"])
    assert rows(merged, "location_id")["rama9"]["close_hour"] == 16 and merged.count() == 6
    holidays = small_inputs.holiday_list(spark)
    again = small_inputs.upsert(holidays, small_inputs.holiday_list(spark), ["d"])
    assert again.count() == 21 and rows(again, "d")[dt.date(2026, 12, 5)]["name_th"] == "วันพ่อแห่งชาติ"
