"""A rebuild becomes visible as a whole or not at all; feeds become a payload."""

from __future__ import annotations

import datetime as dt
import json
import os

import domain
import pytest
from conftest import rows
from pyspark.sql import functions as F

from salesgrain.plans import feeds, insights, payload, publish
from salesgrain.plans.catalog import BUILDERS, Tables
from salesgrain.plans.checks import quality_checks
from salesgrain.sources.relations import frame_relations


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("published"))
    publish.rebuild(frame_relations(spark, domain.frames(spark)), domain.PARAMS, root, "run-1")
    return root


def test_manifest_lists_every_table(spark, root):
    run = publish.published(spark, root)
    assert run.manifest["run_id"] == "run-1" and run.manifest["data_through"] == "2026-10-08"
    assert set(run.manifest["tables"]) == set(BUILDERS)
    counts = rows(publish.row_counts(spark, root), "name")
    assert counts["grab_match"]["rows"] == 2 and counts["pair_lift"]["rows"] == 0
    assert run["ticket_hist"].count() == counts["ticket_hist"]["rows"]


def test_only_tables_and_manifests_are_left_and_old_runs_go(spark, tmp_path):
    root = str(tmp_path / "runs")
    rel = frame_relations(spark, domain.frames(spark))
    for name in ("run-1", "run-2", "run-3"):
        publish.rebuild(rel, domain.PARAMS, root, name, keep_runs=2)
    assert sorted(os.listdir(f"{root}/runs")) == ["run-2", "run-3"] == sorted(os.listdir(f"{root}/manifests"))
    assert set(os.listdir(f"{root}/runs/run-3")) == set(BUILDERS)
    assert not os.path.isdir(f"{root}/work") or not os.listdir(f"{root}/work")


def test_a_failed_run_stays_invisible(spark, root):
    data = domain.frames(spark)
    data["table_sessions"] = data["table_sessions"].drop("pax")
    with pytest.raises(Exception, match="pax"):
        publish.rebuild(frame_relations(spark, data), domain.PARAMS, root, "run-2")
    assert publish.published(spark, root).manifest["run_id"] == "run-1"


@pytest.fixture(scope="module")
def staged(spark):
    return Tables(frame_relations(spark, domain.frames(spark)), domain.PARAMS, domain.stage(spark))


def test_invariants_hold(staged):
    assert {r["check"]: r["violations"] for r in rows(quality_checks(staged))} == {
        "net_by_day": 0, "party_net": 0, "no_free_items": 0, "shares_sum": 0, "forced_picks_unpaid": 0,
    }


def test_each_invariant_is_seen_to_break(spark):
    """One tampered table each: the check that looks at it counts, the others stay at zero."""
    def tampered(name, change):
        t = Tables(frame_relations(spark, domain.frames(spark)), domain.PARAMS)
        t.put(name, change(t.build(name)))
        return {r["check"]: r["violations"] for r in rows(quality_checks(t))}

    one_day = (F.col("location_id") == "silom") & (F.col("business_date") == F.lit(domain.D))
    more = lambda c, where: F.when(where, F.col(c) + 1).otherwise(F.col(c)).alias(c)
    changed = lambda df, c, where: df.select(*[more(x, where) if x == c else x for x in df.columns])
    got = tampered("hourly", lambda df: changed(df, "net_thb", one_day & (F.col("channel") == "dine_in")))
    assert got.pop("net_by_day") == 1 and not any(got.values())
    got = tampered("party_size", lambda df: changed(df, "net_thb", F.col("location_id") == "silom"))
    assert got.pop("party_net") >= 1 and not any(got.values())
    free = domain.PARAMS.rules.free_name_part
    got = tampered("item_daily", lambda df: df.withColumn("item_name", F.when(F.col("source") == "menu", F.lit(f"x {free}")).otherwise(F.col("item_name"))))
    assert got.pop("no_free_items") >= 1 and not any(got.values())
    got = tampered("ticket_hist", lambda df: df.withColumn("bills", F.lit(0).cast("bigint")))
    assert got.pop("shares_sum") == 0 and not any(got.values())  # no bills, no shares: nothing to add up
    forced = F.col("modifier_group").rlike(domain.PARAMS.rules.set_mandatory_re)
    got = tampered("option_monthly", lambda df: changed(df, "paid_picks", forced))
    assert got.pop("forced_picks_unpaid") >= 1 and not any(got.values())


def test_shares_that_do_not_add_up_are_counted(spark, monkeypatch):
    from salesgrain.plans import checks

    t = Tables(frame_relations(spark, domain.frames(spark)), domain.PARAMS)
    whole = checks.ticket_mix
    monkeypatch.setattr(checks, "ticket_mix", lambda t: whole(t).where("thb_bucket <> '<150'"))
    assert rows(checks.shares_sum(t))[0]["violations"] >= 1


def test_payload(spark, staged, tmp_path):
    out = str(tmp_path / "payload")
    meta = payload.write_payload(staged, out, dt.datetime(2026, 10, 9, 8, 30))
    assert meta["generated_at"] == "2026-10-09 08:30" and meta["today_partial"] and not meta["over_budget"]
    assert meta["cols"]["tree"][:5] == ["loc", "d", "daypart", "channel", "orders"]
    assert list(meta["cols"]) == list(feeds.FEEDS)
    lines = [json.loads(r["value"]) for r in spark.read.text(f"{out}/feeds/tree").collect()]
    assert len(lines) == meta["sizes"]["tree"]["rows"] and all(len(x) == 33 for x in lines)
    lunch = next(x for x in lines if x[:4] == ["silom", "2026-10-07", "lunch", "dine_in"])
    assert lunch[4] == 5 and lunch[18] == 535 and lunch[24] == 60.01
    assert json.loads(spark.read.text(f"{out}/meta").first()["value"])["tz"] == "Asia/Bangkok"


def test_json_cells(spark):
    df = spark.sql(
        "SELECT 'a\"b' s, CAST(NULL AS STRING) n, 10 i, true b, 12.345678D x, 100.0D whole, 2.505D net, "
        "-0.00001D z, CAST(7.5000 AS DECIMAL(18,4)) d"
    )
    assert df.select(payload.json_row(df)).first()[0] == '["a\\"b",null,10,true,12.3457,100,2.51,0,7.5]'


def test_view_filters(staged):
    D = domain.D
    def orders(**view):
        shown = insights.View(**view).of(staged, staged["tree_daily"])
        return sum(r["orders"] for r in rows(shown))

    assert orders() == 12 and orders(branches=("rama9",)) == 1 and orders(channels=("delivery",)) == 1
    assert orders(date_from=domain.TODAY) == 1 and orders(date_to=D) == 11
    assert orders(day_type="weekend") == 0 and orders(day_type="weekday") == 12 and orders(day_type="holiday") == 0


def test_feeds_read_hours_from_the_seat_list_first(staged):
    got = rows(feeds.branches(staged), "id")
    assert got["silom"] == {"id": "silom", "th": "สีลม", "seats": 10, "open": 10, "close": 22}
    assert set(got) == {"silom", "rama9"}


def test_cancelled_orders_and_fees(staged):
    (lost,) = rows(feeds.platform_cancels(staged))
    assert lost["gf"] == "100" and lost["hr"] == 11 and lost["est_thb"] is None
    (fees,) = rows(feeds.platform_fees(staged))
    assert fees["ads_thb"] == 68 and fees["adjust_thb"] == 0 and fees["unpaid_rows"] == 0
    (cover,) = rows(feeds.match_coverage(staged))
    assert (cover["orders"], cover["matched"]) == (5, 2)
