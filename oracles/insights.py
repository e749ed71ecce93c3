"""The dashboard analytics in SQL, over the derived tables (q_ parts)."""

from __future__ import annotations

from oracles.build import big, dbl, div, rnd

IN_STORE = "channel IN ('dine_in', 'take_away')"
ATTACH = ("side", "bev_paid", "bev_premium", "dessert", "topping")


def pct(top: str, bottom: str, digits: int = 2) -> str:
    return rnd(div(top, bottom) + " * 100", digits)


def quo(top: str, bottom: str, digits: int = 2) -> str:
    return rnd(div(top, bottom), digits)


def ex(value: str, scale: int = 4) -> str:
    """Sums over stored doubles are taken on the exact decimals they show."""
    return f"sum(CAST({value} AS DECIMAL(18,{scale})))"


def share(table: str, group: str, cell: str, value: str, where: str = "true") -> str:
    return f"""
        SELECT {group}, {cell}, {big(f'sum({value})')} {value},
               {pct(f'sum({value})', f'sum(sum({value})) OVER (PARTITION BY {group})', 4)} share_pct
        FROM {table} WHERE {where} GROUP BY {group}, {cell}"""


LAYER_CELLS = "\n        UNION ALL ".join(
    f"SELECT location_id, channel, '{g}_{layer}' cell, meals, {value.format(g=g)} units FROM i_layers"
    for g in ATTACH
    for layer, value in (("all", "{g}"), ("upsell", "{g} - {g}_s"), ("in_set", "{g}_s"))
) + "\n        UNION ALL SELECT location_id, channel, 'bev_water_all' cell, meals, bev_water units FROM i_layers"

PARTS = {
    "i_tree": f"""
        SELECT f.*, gross, coalesce(t.trusted, false) AND f.channel = 'dine_in' believed FROM (
            SELECT location_id, business_date, daypart, channel, count(*) orders, sum(pax) pax, sum(total_thb) net,
                   sum(discount_thb) disc, sum(total_thb + discount_thb) gross, sum(main_units) main_units, sum(set_units) set_units,
                   sum(meals) meals, sum(bev_water_units) bev_water,
                   {', '.join(f'sum({g}_units) {g}, sum({g}_set_units) {g}_s' for g in ATTACH)}
            FROM x_facts GROUP BY 1, 2, 3, 4) f LEFT JOIN q_pax_trust t USING (location_id, business_date)""",
    "i_days": "SELECT location_id, count(DISTINCT business_date) n FROM x_kept GROUP BY 1",
    "i_open": "SELECT location_id, count(DISTINCT business_date) n FROM x_kept WHERE channel = 'dine_in' GROUP BY 1",
    "i_hours": """
        SELECT location_id, CAST(hr AS INT) AS hour, count(*) orders, sum(total_thb) net FROM x_kept GROUP BY 1, 2""",
    "i_seated": f"""
        SELECT o.location_id, o.hour, s.seats, d.n AS days, sum(persons_opened) persons, sum(turns) turns, sum(imputed_bills) imputed,
               {ex('peak_persons')} peak, {ex('seat_minutes', 1)} AS minutes
        FROM q_occupancy_hourly o JOIN i_open d USING (location_id) JOIN x_seats s USING (location_id)
        WHERE s.seats > 0 GROUP BY 1, 2, 3, 4""",
    "i_ticket": f"""
        SELECT location_id, {div('sum(total_thb)', 'sum(meals)')} ticket FROM x_facts WHERE channel = 'dine_in' GROUP BY 1""",
    "i_layers": f"""
        SELECT location_id, channel, sum(meals) meals, sum(bev_water) bev_water,
               {', '.join(f'sum({g}) {g}, sum({g}_s) {g}_s' for g in ATTACH)}
        FROM i_tree GROUP BY 1, 2""",
    "i_cells": LAYER_CELLS,
    "i_mains": """
        SELECT location_id, main_family, sum(bills_main) bills_main FROM (
            SELECT DISTINCT location_id, channel, week_start, main_family, bills_main FROM t_script)
        WHERE location_id <> 'R4' GROUP BY 1, 2 HAVING sum(bills_main) >= 30""",
    "i_both": """
        SELECT location_id, main_family, item, sum(bills_both) bills_both, sum(thb_both) thb_both FROM t_script GROUP BY 1, 2, 3""",
    "i_script": f"""
        SELECT m.location_id, m.main_family, k.item, m.bills_main, coalesce({div('b.bills_both', 'm.bills_main')}, 0.0) rate,
               {div('b.thb_both', 'b.bills_both')} price
        FROM i_mains m JOIN (SELECT DISTINCT main_family, item FROM i_both) k USING (main_family)
        LEFT JOIN i_both b ON b.location_id = m.location_id AND b.main_family = m.main_family AND b.item = k.item""",
    "i_menu": """
        SELECT location_id, item_name, sum(qty) units, sum(thb) thb FROM x_units GROUP BY 1, 2 HAVING sum(qty) > 0""",
    "i_lag": """
        SELECT m.location_id, epoch_us(t.starttime) - epoch_us(p.created_at) us
        FROM t_match m JOIN x_paid p USING (booking_id) JOIN x_tabs t ON t.order_id = m.bill_id""",
}

MEALS = "sum(meals)"
QUERIES = {
    "driver_tree": f"""
        SELECT coalesce(location_id, 'all') location_id, coalesce(daypart, 'all') daypart, coalesce(channel, 'all') channel,
               {big('sum(orders)')} orders, {dbl('sum(c)')} customers, {dbl('sum(net)')} net_thb,
               {quo('sum(net)', 'sum(orders)')} ticket_per_bill, {quo('sum(net)', 'sum(c)')} ticket_per_head,
               {quo(MEALS, 'sum(c)')} bowls_per_customer, {pct('sum(bev_paid + bev_premium)', MEALS)} drink_attach_pct,
               {pct('sum(side)', MEALS)} side_attach_pct, {pct('sum(topping)', MEALS)} topping_attach_pct,
               {pct('sum(dessert)', MEALS)} dessert_attach_pct, {pct('sum(disc)', 'sum(gross)')} discount_pct
        FROM (SELECT *, CASE WHEN believed THEN coalesce(pax, meals) ELSE meals END c FROM i_tree)
        GROUP BY ROLLUP (location_id, daypart, channel)""",
    "trust_strip": f"""
        SELECT location_id, {big('count(*)')} AS days, {big('count(*) FILTER (trusted)')} trusted_days,
               {pct('count(*) FILTER (trusted)', 'count(*)', 1)} trusted_pct, {quo(ex('ratio', 2), 'count(ratio)')} mean_ratio,
               count(*) FILTER (trusted) * 100 < 70 * count(*) keying_alert FROM q_pax_trust GROUP BY 1""",
    "density": f"""
        SELECT h.location_id, hour, {big('d.n')} AS days, {big('orders')} orders, {quo('orders', 'd.n', 3)} orders_per_day,
               {quo('net', 'd.n')} net_per_day, {pct('orders', 'sum(orders) OVER w', 4)} orders_share_pct,
               {pct('net', 'sum(net) OVER w', 4)} net_share_pct
        FROM i_hours h JOIN i_days d USING (location_id) WINDOW w AS (PARTITION BY h.location_id)""",
    "occupancy": f"""
        SELECT location_id, hour, CAST(seats AS INT) seats, {big('days')} AS days, {big('persons')} persons,
               {rnd('r', 2)} raw_pct, least({rnd('r', 2)}, 100.0) occupancy_pct,
               CASE WHEN r >= 80 THEN 'full' WHEN r >= 50 THEN 'medium' ELSE 'quiet' END band,
               {quo('persons', 'days', 3)} served_per_day, {rnd('CAST(seats AS DOUBLE) - ' + div('persons', 'days'), 3)} gap_per_day
        FROM (SELECT *, {div('persons', 'seats * days')} * 100 r FROM i_seated)""",
    "seat_time": f"""
        SELECT location_id, hour, {pct('minutes', 'seats * days * 60')} seat_time_pct, {pct('peak', 'seats * days')} peak_pct,
               {quo('turns', 'seats * days', 4)} turns_per_seat, {big('imputed')} imputed FROM i_seated""",
    "dwell_by_hour": f"""
        SELECT location_id, hour, {big('sum(turns)')} turns, {quo(ex('dwell_min_sum', 1), 'sum(turns)', 1)} dwell_min
        FROM q_occupancy_hourly GROUP BY 1, 2 HAVING sum(turns) > 0""",
    "quiet_band": f"""
        SELECT location_id, hour, {dbl('net')} net_thb, coalesce(hour >= 16 AND hour <= 20, false) in_band,
               {pct('net', 'sum(net) OVER w', 4)} share_pct,
               {pct('sum(net) FILTER (hour >= 16 AND hour <= 20) OVER w', 'sum(net) OVER w', 4)} band_share_pct
        FROM i_hours WINDOW w AS (PARTITION BY location_id)""",
    "ceilings": f"""
        WITH span AS (SELECT max(business_date) - min(business_date) + 1 n FROM x_kept),
        short AS (SELECT location_id, CAST(c AS INT) target_pct, any_value(days) AS days, sum(greatest(c * seats * days - persons * 100, 0)) s
                  FROM i_seated, (VALUES (40), (50), (60)) v(c) GROUP BY 1, 2)
        SELECT location_id, target_pct, {quo('s', 'days * 100')} persons_per_day,
               {rnd(div('s', 'days * 100') + ' * ticket', 2)} thb_per_day,
               {rnd(div('s', '100') + ' * ticket * 30 / n')} thb_per_month
        FROM short JOIN i_ticket USING (location_id), span""",
    "gap_days": """
        SELECT location_id, business_date, channel, net_thb, expected_thb, gap_pct,
               CASE WHEN gap_pct < -15 THEN 'below' ELSE 'above' END flag, is_holiday, rain_mm
        FROM q_calendar_daily WHERE abs(gap_pct) > 15""",
    "attach_layers": f"""
        SELECT location_id, channel, cell, {dbl('meals')} meals, {dbl('units')} units, {rnd('r * 100', 2)} attach_pct,
               {rnd('max(r) OVER (PARTITION BY channel, cell) * 100', 2)} best_pct
        FROM (SELECT *, {div('units', 'meals')} r FROM i_cells)""",
    "menu_scripts": f"""
        WITH span AS (SELECT max(week_start) - min(week_start) + 7 n FROM t_script),
        vs AS (SELECT a.*, (SELECT list({{'r': b.rate, 'l': b.location_id, 'p': b.price}} ORDER BY b.rate DESC, b.location_id)[1]
                            FROM i_script b WHERE b.main_family = a.main_family AND b.item = a.item
                              AND b.location_id <> a.location_id) q FROM i_script a),
        worth AS (SELECT vs.*, {rnd('(q.r - rate) * bills_main * coalesce(q.p, price) * 30 / n')} m FROM vs, span WHERE q.r > rate)
        SELECT location_id, main_family, item, {big('bills_main')} bills_main, {rnd('rate * 100', 2)} rate_pct,
               q.l best_location, {rnd('q.r * 100', 2)} best_pct, m thb_per_month
        FROM worth ORDER BY m DESC NULLS LAST, location_id, main_family, item LIMIT 10""",
    "party_mix": share("q_party_size", "location_id", "pax_bucket", "bills", "channel = 'dine_in'"),
    "ticket_mix": share("q_ticket_hist", "location_id", "thb_bucket", "bills"),
    "choice_share": "SELECT *, share_pct < 2 unpopular FROM ("
    + share("q_option_monthly", "location_id, modifier_group", "choice_th", "picks") + ")",
    "topping_parity": f"""
        SELECT location_id, topping, {dbl('ou')} as_option_units, {dbl('mu')} as_menu_units, {quo('ot', 'ou')} option_price,
               {quo('mt', 'mu')} menu_price, abs({div('mt', 'mu')} - {div('ot', 'ou')}) > 5 mismatch
        FROM (SELECT location_id, topping, {ex('as_option_units')} ou, {ex('as_option_thb')} ot, {ex('as_menu_units')} mu,
                     {ex('as_menu_thb')} mt FROM q_topping_route GROUP BY 1, 2) WHERE ou > 0 AND mu > 0""",
    "dish_options": share("q_option_by_dish", "dish_th, modifier_group", "choice_th", "picks"),
    "member_attach": f"""
        SELECT *, {pct('member_bills', 'bills')} member_attach_pct FROM q_members_monthly""",
    "menu_matrix": f"""
        WITH q AS (SELECT *, {quo('thb', 'units')} price FROM i_menu),
        n AS (SELECT *, CAST(ntile(4) OVER (PARTITION BY location_id ORDER BY units, item_name) AS INT) units_quartile,
                     CAST(ntile(4) OVER (PARTITION BY location_id ORDER BY price, item_name) AS INT) price_quartile FROM q)
        SELECT location_id, item_name, {dbl('units')} units, {dbl('thb')} thb, price, units_quartile, price_quartile,
               CASE WHEN units_quartile > 2 THEN CASE WHEN price_quartile > 2 THEN 'star' ELSE 'plowhorse' END
                    WHEN price_quartile > 2 THEN 'puzzle' ELSE 'dog' END menu_class FROM n""",
    "item_trend": f"""
        SELECT item_name, business_date, channel, {dbl('u')} units, {dbl('b')} thb,
               {pct('u', 'sum(u) OVER (PARTITION BY item_name, business_date)', 4)} channel_share_pct
        FROM (SELECT item_name, business_date, channel, sum(qty) u, sum(thb) b FROM x_units GROUP BY 1, 2, 3)""",
    "item_partners": """
        SELECT *, CAST(row_number() OVER (PARTITION BY location_id, item ORDER BY lift DESC, bills_ab DESC, partner) AS INT) place
        FROM (SELECT location_id, item_a item, item_b partner, bills_ab, lift FROM t_pairs
              UNION ALL SELECT location_id, item_b, item_a, bills_ab, lift FROM t_pairs)""",
    "set_uptake": f"""
        SELECT location_id, strftime(business_date, '%Y-%m') ym, {dbl('sum(set_units)')} set_units, {dbl('sum(main_units)')} main_units,
               {pct('sum(set_units)', MEALS)} set_uptake_pct,
               {pct('sum(' + ' + '.join(ATTACH) + ')', MEALS)} attach_all_pct,
               {pct('sum(' + ' + '.join(f'{g} - {g}_s' for g in ATTACH) + ')', MEALS)} attach_upsell_pct
        FROM i_tree GROUP BY 1, 2""",
    "promo_effect": f"""
        SELECT location_id, promo = 'ไม่มีโปร' without_promo, {big('count(*)')} bills,
               {quo('sum(main_units)', 'count(*)', 4)} mains_per_bill, {quo('sum(total_thb)', 'count(*)')} net_per_bill
        FROM x_facts GROUP BY 1, 2""",
    "combo_uptake": f"""
        SELECT location_id, item_a, item_b, bills_ab, lift, {pct('bills_ab', 'bills_a')} uptake_of_a_pct,
               {pct('bills_ab', 'bills_b')} uptake_of_b_pct FROM t_pairs""",
    "calendar_effects": f"""
        WITH kinds AS (
            SELECT location_id, channel, net, 'weekday' factor, CAST(dow AS VARCHAR) AS level FROM t_calendar
            UNION ALL SELECT location_id, channel, net, 'month band', CASE WHEN day(business_date) <= 7 THEN '1-7'
                WHEN day(business_date) <= 14 THEN '8-14' WHEN day(business_date) <= 21 THEN '15-21' ELSE '22-end' END FROM t_calendar
            UNION ALL SELECT location_id, channel, net, 'holiday', CASE WHEN off THEN 'holiday' ELSE 'normal' END FROM t_calendar
            UNION ALL SELECT location_id, channel, net, 'rain', CASE WHEN rain_mm >= 1 THEN 'rain' ELSE 'dry' END FROM t_calendar
                WHERE rain_mm IS NOT NULL),
        mean AS (SELECT location_id, channel, {div('sum(net)', 'count(*)')} m FROM t_calendar GROUP BY 1, 2)
        SELECT location_id, channel, factor, level, {big('count(*)')} AS days, {quo('sum(net)', 'count(*)')} net_per_day,
               {rnd('(' + div('sum(net)', 'count(*)') + ' / any_value(m) - 1) * 100', 2)} vs_mean_pct
        FROM kinds JOIN mean USING (location_id, channel) GROUP BY 1, 2, 3, 4""",
    "context_attach": f"""
        WITH a AS (SELECT daypart, sum(meals) m, {', '.join(f'sum({g}) {g}' for g in ATTACH)} FROM i_tree
                   WHERE channel = 'dine_in' GROUP BY 1)
        SELECT daypart, pax_bucket, {big('sum(bills)')} parties, {quo('sum(net_thb)', 'sum(bills)')} net_per_party,
               {quo('sum(main_units)', 'sum(bills)', 4)} mains_per_party,
               {', '.join(f"{pct(f'any_value({g})', 'any_value(m)')} {g}_attach_pct" for g in ATTACH)}
        FROM t_party_size JOIN a USING (daypart) WHERE channel = 'dine_in' GROUP BY 1, 2""",
    "digest": """
        (SELECT 'opportunity' kind, location_id, channel, lever what, uplift_thb_month AS value FROM t_notes
         ORDER BY uplift_thb_month DESC NULLS LAST, location_id, channel, lever LIMIT 3)
        UNION ALL
        SELECT lever, location_id, channel, lever, uplift_thb_month FROM t_rollup
        UNION ALL
        (SELECT 'gap', location_id, channel, strftime(business_date, '%Y-%m-%d'), gap FROM t_calendar
         WHERE business_date >= DATE '2001-07-26' AND business_date <= DATE '2001-08-01' AND gap IS NOT NULL
         ORDER BY gap, location_id, channel, business_date LIMIT 3)""",
    "day_types": f"""
        SELECT location_id, {big('count(*)')} orders, {dbl('sum(total_thb)')} net_thb, kind day_type
        FROM x_kept, (VALUES ('all'), ('weekday'), ('weekend'), ('holiday')) v(kind)
        WHERE CASE kind WHEN 'weekday' THEN isodow(business_date) <= 5 WHEN 'weekend' THEN isodow(business_date) > 5
              WHEN 'holiday' THEN business_date IN (SELECT d FROM x_holidays) ELSE true END
        GROUP BY 1, 4""",
    "payout": f"""
        SELECT location_id, {dbl('g')} gross_thb, {dbl('d')} merchant_discount_thb, {dbl('c')} commission_thb,
               {dbl('m')} marketing_fee_thb, {dbl('p')} payout_thb, {big('n')} orders, {dbl('a')} ads_thb, {dbl('j')} adjust_thb,
               {dbl('p + a + j')} kept_thb, {pct('p + a + j', 'g')} kept_pct
        FROM (SELECT location_id, sum(gross_thb) FILTER (category = 'payment') g, sum(disc) FILTER (category = 'payment') d,
                     sum(comm) FILTER (category = 'payment') c, sum(mkt) FILTER (category = 'payment') m,
                     sum(payout_thb) FILTER (category = 'payment') p, count(*) FILTER (category = 'payment') n,
                     coalesce(sum(payout_thb) FILTER (category = 'ads'), 0) a,
                     coalesce(sum(payout_thb) FILTER (category = 'adjustment'), 0) j FROM x_platform GROUP BY 1)""",
    "ads_brand": f"""
        SELECT is_brand, {big('sum(impressions)')} impressions, {big('sum(clicks)')} clicks, {big('sum(orders)')} orders,
               {dbl('sum(spend_thb)')} spend_thb, {dbl('sum(revenue_thb)')} revenue_thb, {quo('sum(spend_thb)', 'sum(orders)')} thb_per_order,
               {quo('sum(orders) * 100', 'sum(spend_thb)', 4)} orders_per_100 FROM x_pwords GROUP BY 1""",
    "ads_funnel": f"""
        SELECT campaign, {big('sum(impressions)')} impressions, {big('sum(menu_visits)')} menu_visits,
               {big('sum(add_to_cart)')} add_to_cart, {big('sum(orders)')} orders,
               {pct('sum(menu_visits)', 'sum(impressions)')} menu_visits_pct, {pct('sum(add_to_cart)', 'sum(menu_visits)')} add_to_cart_pct,
               {pct('sum(orders)', 'sum(add_to_cart)')} orders_pct FROM x_pads GROUP BY 1""",
    "ads_hours": f"""
        SELECT CAST(hour AS INT) AS hour, {dbl('sum(s)')} spend_thb, {big('sum(o)')} orders,
               {pct('sum(s)', 'sum(sum(s)) OVER ()', 4)} spend_share_pct, {pct('sum(o)', 'sum(sum(o)) OVER ()', 4)} orders_share_pct
        FROM (SELECT hour, spend_thb s, 0 o FROM x_pads UNION ALL SELECT hour, 0, orders FROM x_ppeak) GROUP BY 1""",
    "campaigns": f"""
        WITH d AS (SELECT location_id, orders, (location_id, business_date) IN (SELECT (location_id, business_date) FROM x_poffers) run FROM x_pdaily),
        m AS (SELECT location_id, {quo('sum(orders) FILTER (run)', 'count(*) FILTER (run)', 4)} orders_on_campaign_days,
                     {quo('sum(orders) FILTER (NOT run)', 'count(*) FILTER (NOT run)', 4)} orders_on_other_days FROM d GROUP BY 1)
        SELECT location_id, campaign, {big('count(DISTINCT business_date)')} AS days, {big('sum(orders)')} orders,
               {dbl('sum(spend_thb)')} spend_thb, {dbl('sum(net_thb)')} net_thb, {quo('sum(spend_thb)', 'sum(orders)')} thb_per_order,
               {quo('sum(net_thb)', 'sum(spend_thb)', 4)} net_per_thb, any_value(orders_on_campaign_days) orders_on_campaign_days,
               any_value(orders_on_other_days) orders_on_other_days
        FROM x_poffers JOIN m USING (location_id) GROUP BY 1, 2""",
    "lost_orders": f"""
        SELECT location_id loc, cancel_reason reason, CAST(hour(created_at) AS INT) hr, {big('count(*)')} orders,
               {dbl(ex('est', 2))} lost_thb FROM f_cancels GROUP BY 1, 2, 3""",
    "rating_risk": f"""
        WITH a AS (SELECT location_id, strftime(business_date, '%Y-%m') ym, {quo('sum(rating)', 'count(rating)')} rating FROM x_pdaily GROUP BY 1, 2),
        b AS (SELECT location_id, strftime(review_date, '%Y-%m') ym, count(*) n, count(*) FILTER (NOT replied) u FROM x_previews GROUP BY 1, 2),
        c AS (SELECT location_id, strftime(business_date, '%Y-%m') ym, {div('sum(total_reported)', 'sum(completed_orders)')} * 100 r FROM x_pmiwi GROUP BY 1, 2)
        SELECT location_id, ym, rating, {big('coalesce(n, 0)')} reviews, {big('coalesce(u, 0)')} unanswered, {rnd('r', 2)} missing_pct,
               coalesce(r > 1, false) missing_alert
        FROM a FULL JOIN b USING (location_id, ym) FULL JOIN c USING (location_id, ym)""",
    "unanswered_reviews": """
        SELECT review_date, location_id, CAST(rating AS INT) rating, review FROM x_previews WHERE NOT replied""",
    "hour_curves": f"""
        WITH s AS (SELECT location_id, CAST(hr AS INT) AS hour, count(*) n FROM x_kept WHERE {IN_STORE} AND hr IS NOT NULL GROUP BY 1, 2),
        p AS (SELECT location_id, CAST(hour AS INT) AS hour, sum(orders) n FROM x_ppeak GROUP BY 1, 2),
        s2 AS (SELECT location_id, hour, {big('n')} store_orders, {pct('n', 'sum(n) OVER (PARTITION BY location_id)', 4)} store_share_pct FROM s),
        p2 AS (SELECT location_id, hour, {big('n')} platform_orders, {pct('n', 'sum(n) OVER (PARTITION BY location_id)', 4)} platform_share_pct FROM p)
        SELECT * FROM s2 FULL JOIN p2 USING (location_id, hour)""",
    "top_items": f"""
        WITH s AS (SELECT location_id, item_name i, sum(qty) u FROM x_units WHERE {IN_STORE} AND source = 'menu' GROUP BY 1, 2),
        p AS (SELECT location_id, item i, sum(units) u FROM x_pmenu GROUP BY 1, 2),
        s2 AS (SELECT location_id, CAST(row_number() OVER (PARTITION BY location_id ORDER BY u DESC, i) AS INT) place, i store_item,
                      {dbl('u')} store_units FROM s QUALIFY place <= 10),
        p2 AS (SELECT location_id, CAST(row_number() OVER (PARTITION BY location_id ORDER BY u DESC, i) AS INT) place, i platform_item,
                      {dbl('u')} platform_units FROM p QUALIFY place <= 10)
        SELECT * FROM s2 FULL JOIN p2 USING (location_id, place)""",
    "platform_attach": f"""
        WITH b AS (SELECT location_id, sum(mains) + sum(sets) m, sum(sides) side, sum(bev_paid) bev_paid, sum(bev_prem) bev_premium,
                          sum(dessert) dessert, sum(topping) topping FROM f_basket_sums GROUP BY 1),
        s AS (SELECT location_id, sum(meals) m, {', '.join(f'sum({g}) {g}' for g in ATTACH)} FROM i_tree WHERE {IN_STORE} GROUP BY 1)
        SELECT location_id, {', '.join(f"{pct(f'b.{g}', 'b.m')} platform_{g}_pct, {pct(f's.{g}', 's.m')} store_{g}_pct" for g in ATTACH)}
        FROM b FULL JOIN s USING (location_id)""",
    "match_strip": f"""
        SELECT location_id loc, ym, {big('orders')} orders, {big('matched')} matched, {pct('matched', 'orders')} coverage_pct FROM f_cover""",
    "keying_lag": f"""
        SELECT location_id, {big('count(*)')} matches, {rnd('quantile_cont(us, 0.5) / 60000000', 2)} median_min,
               {rnd('quantile_cont(us, 0.9) / 60000000', 2)} p90_min FROM i_lag GROUP BY 1""",
}
QUERIES = {f"insight_{name}": sql for name, sql in QUERIES.items()}
