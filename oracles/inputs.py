"""The driver tables as domain relations. Part names start with x_ so they never meet a column."""

from __future__ import annotations

HISTORY = 2405
AS_OF = "DATE '2001-08-02'"

CODE_NAME = (
    "upper(left(split_part(p_name, ' ', 2), 1)) || length(split_part(p_name, ' ', 2)) || ' ' || "
    "split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1)"
)
CATEGORY = """CASE p_type WHEN 'STANDARD' THEN 'main' WHEN 'SMALL' THEN 'side' WHEN 'MEDIUM' THEN 'beverage'
    WHEN 'LARGE' THEN 'topping' WHEN 'ECONOMY' THEN 'dessert' WHEN 'PROMO' THEN 'set' END"""
EVENT_SUMS = """sum(CAST(value AS DECIMAL(18,4))) spend_thb, count(*) impressions,
    count(*) FILTER (event_type = 'click') clicks, count(*) FILTER (event_type = 'view') menu_visits,
    count(*) FILTER (event_type = 'signup') add_to_cart, count(*) FILTER (event_type = 'purchase') orders,
    coalesce(sum(CAST(value AS DECIMAL(18,4)) * 10) FILTER (event_type = 'purchase'), 0) revenue_thb"""

PARTS = {
    "x_raw": """
        SELECT o.o_orderkey k, n.n_regionkey branchid, 'R' || n.n_regionkey loc,
               CAST(o.o_orderdate AS DATE) d, date_trunc('day', o.o_orderdate) midnight,
               CASE left(o.o_orderpriority, 1) WHEN '1' THEN 'dine_in' WHEN '2' THEN 'dine_in'
                    WHEN '5' THEN 'delivery' ELSE 'take_away' END channel,
               CAST(o.o_totalprice AS DECIMAL(18,4)) total, o.o_custkey, o.o_orderstatus = 'P' voided,
               o.o_totalprice >= 1000 finalized, (o.o_orderkey % 14 + 9) * 60 + (o.o_orderkey // 14) % 60 close_min,
               CASE WHEN o.o_orderkey % 10 = 7 THEN 1 ELSE (o.o_orderkey * 37) % 257 END stay_min
        FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey""",
    "x_orders": """
        SELECT k order_id, loc location_id, d business_date, channel, midnight,
               CASE WHEN k % 17 <> 0 THEN CAST(k % 2 + 1 AS DECIMAL(18,4)) END pax,
               total total_thb,
               CASE WHEN k % 5 = 0 THEN CAST(total * CAST(0.05 AS DECIMAL(3,2)) AS DECIMAL(18,4)) ELSE 0 END discount_thb,
               CASE k % 10 WHEN 3 THEN NULL WHEN 4 THEN 0 ELSE o_custkey END customerid,
               CASE WHEN k % 23 <> 0 THEN midnight + to_minutes(close_min - stay_min) END opened_at,
               CASE WHEN k % 101 <> 0 THEN midnight + to_minutes(close_min) END closed_at,
               finalized, voided
        FROM x_raw""",
    "x_items": f"""
        SELECT p_partkey itemid, 'P' || p_partkey item_code, {CODE_NAME} name_th, {CATEGORY} tree_category,
               CAST(p_retailprice AS DECIMAL(18,4)) price, p_brand vendor FROM part""",
    "x_lines": f"""
        SELECT l_orderkey order_id, l_orderkey * 8 + l_linenumber line_id, l_partkey itemid, 'P' || l_partkey item_code,
               {CODE_NAME} name_th, CASE WHEN p_size <> 50 THEN {CATEGORY} END tree_category,
               CAST(CASE WHEN p_type IN ('STANDARD', 'PROMO') THEN 1 ELSE l_quantity END AS DECIMAL(18,4)) qty,
               CASE WHEN l_linenumber = 3 AND l_discount = 0.05 THEN 0 ELSE CAST(l_extendedprice AS DECIMAL(18,4)) END gross,
               CAST(p_retailprice AS DECIMAL(18,4)) price,
               CASE WHEN l_linenumber = 3 AND l_discount = 0.05 THEN 0
                    ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,4)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,4)) END disc,
               l_tax < 0.08 active, l_quantity = 50 special,
               CASE WHEN l_tax <> 0.02 THEN l_returnflag = 'R' END take_home
        FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_linenumber <= 5""",
    "x_options": f"""
        SELECT l_orderkey order_id, l_orderkey * 8 + l_linenumber - 5 line_id, 'dish ' || (l_suppkey % 10) dish_th,
               p_brand || CASE WHEN p_type = 'LARGE' THEN ' topping' ELSE '' END
                       || CASE WHEN l_linenumber = 7 THEN ' set' ELSE ' add' END modifier_group,
               {CODE_NAME} || CASE WHEN l_returnflag = 'A' THEN ' **' ELSE '' END choice_th,
               CAST(CAST(l_quantity AS INT) % 3 + 1 AS DECIMAL(18,4)) choice_qty,
               CASE WHEN l_discount > 0 THEN CAST(CAST(p_retailprice AS DECIMAL(18,4)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,4))
                    ELSE 0 END paid_price, l_discount > 0 paid
        FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_linenumber >= 6""",
    "x_choice": f"""
        SELECT {CODE_NAME} choice_key, CASE WHEN p_name LIKE 'new %' THEN 2 ELSE 1 END mult, min(p_partkey) itemid
        FROM part WHERE p_name NOT LIKE '% gear' GROUP BY p_name""",
    "x_dupes": """
        SELECT DISTINCT l_orderkey * 8 + l_linenumber line_id FROM lineitem
        WHERE l_tax = 0 AND l_discount = 0 AND l_linenumber IN (4, 5)""",
    "x_sessions": """
        SELECT e.event_id order_id, CAST(e.user_id % 4 + 1 AS DECIMAL(18,4)) pax, CAST(e.value AS DECIMAL(18,4)) dwell,
               date_trunc('day', o.o_orderdate) + (e.ts - date_trunc('day', e.ts)) seated_at,
               date_trunc('day', o.o_orderdate) + (e.ts - date_trunc('day', e.ts))
                   + to_seconds(CAST(round(e.value * 60) AS BIGINT)) left_at,
               coalesce(e.event_type = 'error', false) cancelled
        FROM events e JOIN orders o ON o.o_orderkey = e.event_id""",
    "x_tabs": """
        SELECT k order_id, branchid, loc location_id, (k // 2) % 2 tab, channel,
               CASE WHEN channel = 'dine_in' THEN k % 2 ELSE 0 END parent, channel = 'dine_in' is_split,
               CASE channel WHEN 'dine_in' THEN midnight + to_seconds((k * 7919) % 86400)
                    WHEN 'delivery' THEN midnight + to_minutes((k % 14 + 9) * 60 + k % 50 + k % 31)
                    ELSE midnight + to_minutes((k % 14 + 9) * 60) END starttime,
               CASE WHEN channel = 'delivery' AND k % 4 = 0 THEN 'GF-' || lpad(CAST(k % 900 AS VARCHAR), 3, '0')
                    WHEN channel = 'delivery' AND k % 4 = 1 THEN ' gf ' || CASE WHEN (k // 4) % 2 = 0
                         THEN lpad(CAST(k % 9000 AS VARCHAR), 4, '0') ELSE right(lpad(CAST(k % 9000 AS VARCHAR), 4, '0'), 3) END
               END ref,
               CASE WHEN channel = 'delivery' AND k % 4 = 2 THEN lpad(CAST(k % 900 AS VARCHAR), 3, '0')
                    WHEN channel <> 'dine_in' THEN 'TakeAway1' END takehome
        FROM x_raw""",
    "x_seats": """
        SELECT 'R' || r_regionkey location_id, CASE WHEN r_regionkey <> 3 THEN r_regionkey * 2 + 1 END seats,
               CASE WHEN r_regionkey <> 2 THEN r_regionkey % 3 + 9 END open_hour,
               CASE WHEN r_regionkey <> 1 THEN r_regionkey + 16 END close_hour FROM region""",
    "x_holidays": """
        SELECT DISTINCT CAST(o_orderdate AS DATE) d, name
        FROM orders JOIN (VALUES (1, 1, 'new year'), (5, 1, 'labour day'), (12, 5, 'fathers day')) h(m, dd, name)
          ON month(o_orderdate) = m AND day(o_orderdate) = dd""",
    "x_weather": f"""
        SELECT DATE '1995-01-01' + CAST(n AS INT) d, CAST(greatest(n % 11 - 5, 0) * CAST(0.5 AS DECIMAL(2,1)) AS DECIMAL(18,4)) rain_mm
        FROM range({HISTORY + 1}) t(n) WHERE day(DATE '1995-01-01' + CAST(n AS INT)) <> 13""",
    "x_platform": """
        SELECT k, 'B' || k booking_id, loc location_id, d business_date,
               midnight + to_minutes((k % 14 + 9) * 60 + k % 50) created_at,
               CASE WHEN k % 4 = 1 THEN lpad(CAST(k % 9000 AS VARCHAR), 4, '0')
                    ELSE lpad(CAST(k % 900 AS VARCHAR), 3, '0') END gf_no,
               CASE (k // 16) % 12 WHEN 0 THEN 'ads' WHEN 1 THEN 'adjustment' WHEN 2 THEN 'other' ELSE 'payment' END category,
               CASE WHEN (k // 16) % 12 = 2 THEN 'ยกเลิก' WHEN (k // 32) % 9 = 0 THEN 'เสร็จสมบูรณ์' ELSE 'paid' END status,
               total gross_thb, tenth disc, CAST(total - tenth AS DECIMAL(18,4)) net_thb,
               -fifth comm, -fiftieth mkt,
               CAST(CASE WHEN (k // 16) % 12 < 2 THEN -hundredth ELSE total - third END AS DECIMAL(18,4)) payout_thb,
               CASE WHEN (k // 16) % 12 = 2 THEN 'reason ' || (k % 3) END cancel_reason,
               CASE WHEN (k // 16) % 12 = 2 THEN CASE WHEN k % 2 = 0 THEN 'customer' ELSE 'shop' END END cancelled_by
        FROM (SELECT *, CAST(total * CAST(0.10 AS DECIMAL(3,2)) AS DECIMAL(18,4)) tenth,
                     CAST(total * CAST(0.20 AS DECIMAL(3,2)) AS DECIMAL(18,4)) fifth,
                     CAST(total * CAST(0.02 AS DECIMAL(3,2)) AS DECIMAL(18,4)) fiftieth,
                     CAST(total * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,4)) hundredth,
                     CAST(total * CAST(0.32 AS DECIMAL(3,2)) AS DECIMAL(18,4)) third
              FROM x_raw WHERE channel = 'delivery')""",
    "x_paid": "SELECT * FROM x_platform WHERE category = 'payment'",
    "x_pdaily": """
        SELECT location_id, business_date, sum(gross_thb) gross_thb, sum(net_thb) net_thb, count(*) orders,
               CASE WHEN day(business_date) % 7 <> 0 THEN day(business_date) % 3 + 3 END rating
        FROM x_paid GROUP BY ALL""",
    "x_pmenu": f"""
        SELECT p.location_id, p.business_date, {CODE_NAME} item, sum(CAST(l_quantity AS DECIMAL(18,4))) units,
               sum(CAST(l_extendedprice AS DECIMAL(18,4))) thb
        FROM x_paid p JOIN lineitem ON l_orderkey = p.k JOIN part ON p_partkey = l_partkey
        WHERE l_linenumber <= 5 GROUP BY ALL""",
    "x_poffers": """
        SELECT location_id, business_date, 'offer ' || (k % 5) campaign, sum(gross_thb) gross_thb, sum(net_thb) net_thb,
               count(*) orders, sum(disc) spend_thb
        FROM x_paid WHERE gross_thb >= 250000 GROUP BY ALL""",
    "x_ppeak": """
        SELECT location_id, business_date, hour(created_at) AS hour, count(*) orders FROM x_paid GROUP BY ALL""",
    "x_pads": f"""
        SELECT CAST(ts AS DATE) d, hour(ts) AS hour, 'ads ' || (user_id % 4) campaign, {EVENT_SUMS} FROM events GROUP BY ALL""",
    "x_pwords": f"""
        SELECT strftime(ts, '%Y-%m') ym, 'kw' || (user_id % 20) keyword, {EVENT_SUMS},
               keyword LIKE '%kw1%' OR keyword LIKE '%kw7%' is_brand FROM events GROUP BY 1, 2""",
    "x_pmiwi": """
        SELECT location_id, business_date, count(*) FILTER (k % 37 = 0) wrong, count(*) FILTER (k % 29 = 0) missing,
               wrong + missing total_reported, count(*) completed_orders FROM x_paid GROUP BY ALL""",
    "x_previews": """
        SELECT md5(CAST(event_id AS VARCHAR)) review_key, 'R' || (user_id % 5) location_id, CAST(ts AS DATE) review_date,
               event_id % 5 + 1 rating, props review, user_id % 3 = 0 replied, 'delivery' service_type
        FROM events WHERE event_type = 'view'""",
    "x_pcombos": """
        SELECT location_id, last_day(business_date) as_of, 'combo ' || (k % 6) combo, count(*) n FROM x_paid GROUP BY ALL""",
}
