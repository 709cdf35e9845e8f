"""The same results as plain SQL over the star tables, to check every exact operator.

``VIEWS`` are shared building blocks. The catalog holds one statement per query; it names
the views it needs, and ``statement`` puts them in front of it.
"""

from __future__ import annotations

import re

REF = "DATE '1999-06-30'"
KEYS = "werks, unified_sku_id"


def _material(part: str) -> str:
    return f"'MAT'||lpad({part}::VARCHAR,8,'0')"


def _barcode(part: str) -> str:
    return f"CASE WHEN {part}%25<>0 THEN '87'||lpad({part}::VARCHAR,11,'0') END"


def _sku(part: str) -> str:
    return f"coalesce({_barcode(part)}, 'MATNR-'||{_material(part)})"


def _site(region: str) -> str:
    return f"'NL'||lpad({region}::VARCHAR,2,'0')"


def _cover(stock: str, week: str) -> str:
    """stock / (week / 7) as decimals: the week rate rounded to 6 places, the result to 2."""
    s, q = f"(abs({stock})*1000)::HUGEINT", f"(abs({week})*1000)::HUGEINT"
    rate = f"(({q}*2000+7)//14)"
    fine = f"(({s}*200000000000000000000000::HUGEINT+{rate})//(2*{rate}))"
    cents = f"(({fine}+500000000000000000::HUGEINT)//1000000000000000000::HUGEINT)"
    return (
        f"CASE WHEN {week}<>0 THEN sign({stock})*sign({week})*{cents}::DOUBLE/100 END"
    )


def _positions(mapping: str) -> str:
    return f"""
SELECT WERKS AS werks, unified_sku_id, snapshot_date, stock_qty, uom FROM (
  SELECT WERKS, unified_sku_id, BUDAT AS snapshot_date, MEINS AS uom,
    sum(net) OVER (PARTITION BY WERKS, unified_sku_id ORDER BY BUDAT, MEINS
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stock_qty,
    row_number() OVER (PARTITION BY WERKS, unified_sku_id ORDER BY BUDAT DESC, MEINS DESC) AS rn
  FROM (
    SELECT WERKS, unified_sku_id, BUDAT, MEINS, sum({_signed()}) AS net
    FROM movements_asof LEFT JOIN {mapping} ON MATNR=sap_material_number
    GROUP BY ALL)) WHERE rn=1"""


def _signed() -> str:
    return (
        "CASE WHEN BWART IN ('101','262','602') THEN MENGE "
        "WHEN BWART IN ('261','601','102') THEN -MENGE ELSE 0 END"
    )


def _sale() -> str:
    return "CASE BWART WHEN '601' THEN MENGE WHEN '602' THEN -MENGE ELSE 0 END"


def _velocity(mapping: str) -> str:
    sums = ", ".join(
        f"sum(CASE WHEN BUDAT >= {REF}-{n} THEN {_sale()} ELSE 0 END) AS sales_{n}d"
        for n in (7, 14, 28, 90)
    )
    return f"""
SELECT WERKS AS werks, unified_sku_id, {sums}, MEINS AS uom
FROM movements_asof LEFT JOIN {mapping} ON MATNR=sap_material_number
WHERE BWART IN ('601','602') GROUP BY WERKS, unified_sku_id, MEINS"""


def _per_key(velocity: str) -> str:
    sums = ", ".join(f"sum(sales_{n}d) AS sales_{n}d" for n in (7, 14, 28, 90))
    return f"SELECT werks, unified_sku_id, {sums}, min(uom) AS uom FROM {velocity} GROUP BY werks, unified_sku_id"


def _stock_features(positions: str, velocity: str) -> str:
    return f"""
SELECT p.werks, p.unified_sku_id, stock_qty, {_cover('stock_qty', 'sales_7d')} AS days_of_cover, p.uom
FROM {positions} p LEFT JOIN {velocity} v
  ON p.werks=v.werks AND p.unified_sku_id=v.unified_sku_id"""


def _clip(value: str, low: float, high: float) -> str:
    return f"CASE WHEN {value} < {low} THEN {low} WHEN {value} > {high} THEN {high} ELSE {value} END"


VIEWS: dict[str, str] = {
    # ---- raw feeds
    "current_materials": f"""
SELECT {_material('p_partkey')} AS MATNR, {_barcode('p_partkey')} AS EAN11,
  'NL0'||(p_size%5)::VARCHAR AS WERKS, p_name AS MAKTX,
  CASE p_type WHEN 'PROMO' THEN 'DIEN' WHEN 'ECONOMY' THEN 'HALB' WHEN 'LARGE' THEN 'ROH' ELSE 'FERT' END AS MTART,
  p_brand AS MATKL, 'EA' AS MEINS, (2+p_size%12)::DECIMAL(5,0) AS MHDRZ, 'D' AS IPRKZ,
  (1+p_size%3)::DECIMAL(5,0) AS MHDLP, DATE '1998-01-01'+(p_partkey%300)::INT AS LAEDA,
  DATE '1996-01-01' AS ERSDA FROM part""",
    "raw_materials": """
SELECT * FROM current_materials UNION ALL
SELECT MATNR, NULL, WERKS, 'old '||MAKTX, MTART, MATKL, MEINS, MHDRZ, IPRKZ, 1, DATE '1997-01-01', ERSDA
FROM current_materials""",
    "site_lines": """
SELECT l.*, s_acctbal, n_regionkey FROM lineitem l
JOIN supplier ON l_suppkey=s_suppkey JOIN nation ON s_nationkey=n_nationkey""",
    "raw_movements": f"""
SELECT 'D'||l_orderkey AS MBLNR, lpad(l_linenumber::VARCHAR,4,'0') AS ZEILE,
  {_material('l_partkey')} AS MATNR, {_site('n_regionkey')} AS WERKS, '0001' AS LGORT,
  CASE WHEN l_linenumber=1 THEN '101'
    WHEN l_linenumber=2 AND l_returnflag='R' THEN '102'
    WHEN l_linenumber=3 AND l_returnflag='R' THEN '262'
    WHEN l_linenumber=3 AND l_returnflag='A' THEN '261'
    WHEN l_linenumber=7 AND l_tax=0.08e0 THEN '999'
    WHEN l_returnflag='R' AND l_linestatus='F' THEN '602'
    ELSE '601' END AS BWART,
  CAST(l_quantity*CASE WHEN l_linenumber=1 THEN 8 ELSE 1 END AS DECIMAL(13,3)) AS MENGE,
  CASE WHEN l_partkey%10=3 AND l_linenumber=4 THEN 'KG' ELSE 'EA' END AS MEINS,
  l_shipdate::DATE AS BUDAT, l_shipdate::DATE AS CPUDT,
  l_shipdate + to_seconds(l_partkey%86400) AS CPUTM FROM site_lines""",
    "raw_open_orders": f"""
SELECT 'E'||l_orderkey AS EBELN, lpad(l_linenumber::VARCHAR,5,'0') AS EBELP,
  {_material('l_partkey')} AS MATNR, {_site('n_regionkey')} AS WERKS,
  'V'||lpad(l_suppkey::VARCHAR,6,'0') AS LIFNR,
  CAST(CASE WHEN l_discount=0 THEN 0 ELSE l_quantity END AS DECIMAL(13,3)) AS MENGE, 'EA' AS MEINS,
  l_extendedprice::DECIMAL(11,2) AS NETPR, 'EUR' AS WAERS, l_shipdate::DATE AS EINDT,
  o_orderdate::DATE AS BEDAT, 'NL01' AS EKORG, '001' AS EKGRP
FROM site_lines JOIN orders ON l_orderkey=o_orderkey""",
    # ---- silver
    "materials_clean": """
SELECT * EXCLUDE (rn) REPLACE (MHDRZ::INT AS MHDRZ, MHDLP::INT AS MHDLP) FROM (
  SELECT *, row_number() OVER (PARTITION BY MATNR ORDER BY LAEDA DESC, EAN11 NULLS FIRST, WERKS, MAKTX,
    MTART, MATKL, MEINS, MHDRZ, IPRKZ, MHDLP, ERSDA) AS rn
  FROM raw_materials WHERE MTART IN ('FERT','HALB','ROH')) WHERE rn=1""",
    "inventory_clean": """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY MBLNR, ZEILE ORDER BY CPUDT DESC, CPUTM DESC, MATNR, WERKS,
    LGORT, BWART, MENGE, MEINS, BUDAT) AS rn
  FROM raw_movements WHERE BWART IN ('101','102','261','262','601','602')) WHERE rn=1""",
    "orders_clean": """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY EBELN, EBELP ORDER BY BEDAT DESC, MATNR, WERKS, LIFNR, MENGE,
    MEINS, NETPR, WAERS, EINDT, EKORG, EKGRP) AS rn
  FROM raw_open_orders WHERE MENGE > 0) WHERE rn=1""",
    "movements_asof": f"SELECT * FROM inventory_clean WHERE BUDAT <= {REF}",
    "registry": """
SELECT coalesce(EAN11, 'MATNR-'||MATNR) AS unified_sku_id, MATNR AS sap_material_number,
  EAN11 AS ean_barcode, MAKTX AS material_description, MTART AS material_type, MATKL AS material_group,
  MEINS AS base_uom, MHDRZ AS shelf_life_days, MHDLP AS min_remaining_shelf_life,
  CASE WHEN EAN11 IS NOT NULL THEN 1e0 ELSE 0e0 END AS match_confidence, 'HOME_NL' AS source_banner
FROM (SELECT *, row_number() OVER (PARTITION BY MATNR ORDER BY LAEDA DESC) AS rn FROM raw_materials)
WHERE rn=1""",
    "kinds": "SELECT MATNR AS sap_material_number, MTART AS unified_sku_id FROM materials_clean",
    # ---- gold, features
    "positions": _positions("registry"),
    "velocity": _velocity("registry"),
    "kind_positions": _positions("kinds"),
    "kind_velocity": _velocity("kinds"),
    "key_velocity": _per_key("velocity"),
    "kind_key_velocity": _per_key("kind_velocity"),
    "stock_feat": _stock_features("positions", "key_velocity"),
    "kind_stock": _stock_features("kind_positions", "kind_key_velocity"),
    "last_sales": f"""
SELECT WERKS AS werks, unified_sku_id, max(BUDAT) AS last_sale_date,
  date_diff('day', max(BUDAT), {REF})::INT AS days_since_last_sale
FROM movements_asof LEFT JOIN registry ON MATNR=sap_material_number
WHERE BWART='601' GROUP BY WERKS, unified_sku_id""",
    "collapse": """
SELECT v.werks, v.unified_sku_id,
  -- the ratio is decimal in the operator: no negative zero
  CASE WHEN sales_28d<>0 THEN round(sales_7d::DOUBLE/sales_28d::DOUBLE,6)+0e0 END AS velocity_collapse_ratio,
  days_since_last_sale, shelf_life_days::INT AS shelf_life_days
FROM key_velocity v LEFT JOIN last_sales l ON v.werks=l.werks AND v.unified_sku_id=l.unified_sku_id
LEFT JOIN registry r ON v.unified_sku_id=r.unified_sku_id""",
    "feats": """
SELECT v.werks, v.unified_sku_id, sales_7d, sales_14d, sales_28d, sales_90d, v.uom, stock_qty, days_of_cover,
  velocity_collapse_ratio, days_since_last_sale, shelf_life_days
FROM key_velocity v JOIN stock_feat s ON v.werks=s.werks AND v.unified_sku_id=s.unified_sku_id
JOIN collapse c ON v.werks=c.werks AND v.unified_sku_id=c.unified_sku_id""",
    # ---- phantom stock
    "label_rows": f"""
SELECT p.werks, p.unified_sku_id,
  CASE WHEN stock_qty>0 AND sales_7d=0 AND sales_28d>5 THEN 1 ELSE 0 END AS is_phantom, {REF} AS label_date
FROM positions p JOIN key_velocity v ON p.werks=v.werks AND p.unified_sku_id=v.unified_sku_id""",
    "replayed": f"""
SELECT werks, unified_sku_id,
  CASE WHEN stock_qty>0 AND sales_7d=0 AND sales_28d>5 THEN 1 ELSE 0 END AS is_phantom, label_date,
  stock_qty, sales_7d, sales_14d, sales_28d, sales_90d, last_sale
FROM (
  SELECT werks, unified_sku_id, label_date, sum(net) AS stock_qty,
    sum(CASE WHEN BUDAT>=label_date-7 THEN sold ELSE 0 END) AS sales_7d,
    sum(CASE WHEN BUDAT>=label_date-14 THEN sold ELSE 0 END) AS sales_14d,
    sum(CASE WHEN BUDAT>=label_date-28 THEN sold ELSE 0 END) AS sales_28d,
    sum(CASE WHEN BUDAT>=label_date-90 THEN sold ELSE 0 END) AS sales_90d,
    max(last_sale) AS last_sale, sum(n) AS n
  FROM (
    SELECT WERKS AS werks, unified_sku_id, BUDAT, sum({_signed()}) AS net, sum({_sale()}) AS sold,
      count(*) FILTER (BWART IN ('601','602')) AS n, max(BUDAT) FILTER (BWART='601') AS last_sale
    FROM movements_asof LEFT JOIN registry ON MATNR=sap_material_number GROUP BY ALL)
  JOIN (SELECT ({REF}-i::INT)::DATE AS label_date FROM range(90) t(i)) ON BUDAT<=label_date
  GROUP BY ALL) WHERE n>0""",
    "scored": """
SELECT *, phantom_score>=0.85 AS is_phantom, CASE WHEN phantom_score>=0.95 THEN 'AUTO_CORRECTED'
  WHEN phantom_score>=0.85 THEN 'PENDING_REVIEW' ELSE 'BELOW_THRESHOLD' END AS action
FROM (SELECT werks, unified_sku_id, CASE WHEN stock_qty>0
  THEN stock_qty::DOUBLE/(stock_qty::DOUBLE+abs(sales_28d::DOUBLE)) ELSE 0e0 END AS phantom_score,
  shelf_life_days, stock_qty FROM feats)""",
    "corrections": "SELECT * FROM scored WHERE action='AUTO_CORRECTED'",
    # ---- demand
    "series": f"""
SELECT WERKS AS werks, unified_sku_id, BUDAT AS ds, sum(MENGE) AS y
FROM movements_asof LEFT JOIN kinds ON MATNR=sap_material_number
WHERE BWART='601' AND BUDAT >= {REF}-728 GROUP BY ALL""",
    "parts_of_series": """
SELECT *, y-trend-weekly AS rest FROM (
  SELECT *, avg(y-trend) OVER (PARTITION BY werks, unified_sku_id, isodow(ds)) AS weekly FROM (
    SELECT werks, unified_sku_id, ds, y::DOUBLE AS y, coalesce(
      regr_intercept(y::DOUBLE, x::DOUBLE) OVER k + regr_slope(y::DOUBLE, x::DOUBLE) OVER k * x,
      avg(y::DOUBLE) OVER k) AS trend
    FROM (SELECT *, date_diff('day', min(ds) OVER (PARTITION BY werks, unified_sku_id), ds)::DOUBLE AS x
      FROM series)
    WINDOW k AS (PARTITION BY werks, unified_sku_id)))""",
    "components": """
SELECT werks, unified_sku_id, ds, y, trend, weekly,
  avg(rest) OVER (PARTITION BY werks, unified_sku_id, week(ds)) AS yearly FROM parts_of_series""",
    "easter_days": """
SELECT y, make_date(y,3,1) + (h+l-7*((a+11*h+22*l)//451)+21)::INT AS easter FROM (
  SELECT *, (32+2*(b%4)+2*(c//4)-h-c%4)%7 AS l FROM (
    SELECT *, (19*a+b-b//4-(b-(b+8)//25+1)//3+15)%30 AS h FROM (
      SELECT y, y%19 AS a, y//100 AS b, y%100 AS c FROM (SELECT (1990+i)::INT AS y FROM range(21) t(i)))))""",
    "holidays": """
SELECT DISTINCT holiday_date FROM (
  SELECT make_date(y,1,1) AS holiday_date FROM easter_days
  UNION ALL SELECT easter FROM easter_days UNION ALL SELECT easter+1 FROM easter_days
  UNION ALL SELECT CASE WHEN isodow(make_date(y,4,30))=7 THEN make_date(y,4,29) ELSE make_date(y,4,30) END
    FROM easter_days
  UNION ALL SELECT make_date(y,5,5) FROM easter_days WHERE y%5=0
  UNION ALL SELECT easter+39 FROM easter_days UNION ALL SELECT easter+49 FROM easter_days
  UNION ALL SELECT easter+50 FROM easter_days
  UNION ALL SELECT make_date(y,12,25) FROM easter_days UNION ALL SELECT make_date(y,12,26) FROM easter_days)""",
    "forecasts": """
SELECT werks, unified_sku_id, greatest(m*7/28,0) AS forecast_7d, greatest(m*14/28,0) AS forecast_14d,
  greatest(m*28/28,0) AS forecast_28d FROM (SELECT *, sales_28d::DOUBLE AS m FROM key_velocity)""",
    "recent": f"""
SELECT WERKS AS werks, unified_sku_id, sum(MENGE) AS actual_7d
FROM movements_asof LEFT JOIN registry ON MATNR=sap_material_number
WHERE BWART='601' AND BUDAT >= {REF}-7 GROUP BY ALL""",
    "promo_rows": f"""
SELECT {_site('n_regionkey')} AS werks, {_sku('l_partkey')} AS unified_sku_id,
  sum(l_quantity)/count(*) AS baseline_demand
FROM site_lines WHERE l_discount>=0.05e0 GROUP BY n_regionkey, l_partkey, l_discount""",
    "promo": f"""
SELECT p.werks, p.unified_sku_id, avg({_clip('actual_7d::DOUBLE/greatest(baseline_demand,1)', 0.5, 2.0)}::DOUBLE) AS promo_lift
FROM promo_rows p JOIN recent r ON p.werks=r.werks AND p.unified_sku_id=r.unified_sku_id GROUP BY ALL""",
    "corrected": """
SELECT *, greatest(forecast_7d*promo_lift*weather_lift,0) AS corrected_7d,
  greatest(forecast_14d*promo_lift*weather_lift,0) AS corrected_14d,
  greatest(forecast_28d*promo_lift*weather_lift,0) AS corrected_28d FROM (
  SELECT f.*, coalesce(promo_lift,1e0) AS promo_lift, 1.25e0 AS weather_lift FROM forecasts f
  LEFT JOIN promo p ON f.werks=p.werks AND f.unified_sku_id=p.unified_sku_id)""",
    "residuals": """
SELECT c.werks, c.unified_sku_id, corrected_7d, corrected_14d, corrected_28d, promo_lift, weather_lift,
  actual_7d::DOUBLE-corrected_7d AS residual_7d
FROM corrected c JOIN recent r ON c.werks=r.werks AND c.unified_sku_id=r.unified_sku_id""",
    "residual_q": """
SELECT category, quantile_cont(residual_7d,0.1) AS residual_p10, quantile_cont(residual_7d,0.5) AS residual_p50,
  quantile_cont(residual_7d,0.9) AS residual_p90 FROM (
  SELECT coalesce(category,'*') AS category, residual_7d FROM residuals r LEFT JOIN master m
    ON r.werks=m.werks AND r.unified_sku_id=m.unified_sku_id
  UNION ALL SELECT '*', residual_7d FROM residuals r LEFT JOIN master m
    ON r.werks=m.werks AND r.unified_sku_id=m.unified_sku_id WHERE category IS NOT NULL)
GROUP BY category""",
    "weather": """
SELECT ts::DATE AS forecast_date, max(value::DECIMAL(12,2))::DOUBLE/20 AS temperature_max,
  (sum(value::DECIMAL(12,2)) FILTER (event_type='purchase'))::DOUBLE/1000 AS precipitation
FROM events GROUP BY 1""",
    # ---- ordering
    "site_parts": """
SELECT n_regionkey, l_partkey,
  coalesce(sum(l_quantity) FILTER (l_linenumber<>1 AND l_returnflag<>'R'),0) AS sold,
  coalesce(sum(l_quantity) FILTER (l_linenumber=1),0) AS received,
  min(l_suppkey) FILTER (s_acctbal>=0) AS vendor
FROM site_lines GROUP BY ALL""",
    "site_part_rows": f"""
SELECT s.*, part.*, {_site('n_regionkey')} AS werks, {_sku('l_partkey')} AS unified_sku_id
FROM site_parts s JOIN part ON l_partkey=p_partkey""",
    "master": f"""
SELECT werks, unified_sku_id, CASE WHEN p_type IN ('SMALL','MEDIUM') THEN 'FRESH_PRODUCE'
    WHEN p_type IN ('LARGE','STANDARD') THEN 'BAKERY' ELSE 'DRY' END AS category,
  (2+p_size%12)::INT AS shelf_life_days, (1+l_partkey%6)::INT AS transit_days,
  (1+l_partkey%5)::INT AS min_order_qty, (40+l_partkey%160)::INT AS max_order_qty,
  (15+l_partkey%200)::DOUBLE AS truck_capacity_units, p_retailprice/100 AS unit_cost,
  {_barcode('l_partkey')} AS ean_barcode, 'V'||lpad(vendor::VARCHAR,6,'0') AS vendor_id
FROM site_part_rows""",
    "quantiles": """
SELECT werks, unified_sku_id, 0.9e0*m AS p10, m AS p50, m*w AS p90, m*w-0.9e0*m AS uncertainty_spread
FROM (SELECT *, sold/4 AS m, 1+0.05e0*(l_partkey%8) AS w FROM site_part_rows)""",
    "solver_in": """
SELECT q.werks, q.unified_sku_id, p10, p50, p90, (1+(p_size%4)/4e0) AS promo_lift, 1.25e0 AS weather_lift,
  trunc(received/10)::INT AS stock_qty, unit_cost, transit_days, min_order_qty, max_order_qty, category,
  shelf_life_days, truck_capacity_units
FROM quantiles q JOIN site_part_rows s ON q.werks=s.werks AND q.unified_sku_id=s.unified_sku_id
JOIN master m ON q.werks=m.werks AND q.unified_sku_id=m.unified_sku_id""",
    "sized": """
SELECT * EXCLUDE (lo, hi), CASE WHEN lo<=hi THEN lo ELSE 0 END::INT AS recommended_qty,
  CASE WHEN lo<=hi THEN 'Optimal' ELSE 'Infeasible' END AS solver_status FROM (
  SELECT *, transit_days::DOUBLE/greatest(shelf_life_days,1) AS transit_to_life_ratio,
    greatest(min_order_qty, ceil(greatest(p90-stock_qty,0))) AS lo,
    least(max_order_qty, floor(truck_capacity_units)) AS hi FROM solver_in)""",
    "policed": """
SELECT * EXCLUDE (solver_status, recommended_qty, capped),
  CASE ttl_policy_applied WHEN 'HARD_BLOCK' THEN 0 WHEN 'SOFT_CAP' THEN capped ELSE recommended_qty END::INT
    AS recommended_qty,
  CASE WHEN ttl_policy_applied='HARD_BLOCK' THEN 'BLOCKED_TRANSIT_TO_LIFE' ELSE solver_status END AS solver_status,
  ttl_policy_applied='HARD_BLOCK' AS blocked, ttl_policy_applied='SOFT_CAP' AS day_old_discount
FROM (SELECT *, CASE
    WHEN transit_to_life_ratio <= CASE WHEN category IN ('FRESH_PRODUCE','BAKERY') THEN 0.5e0 ELSE 0.6e0 END
      THEN 'PASS'
    WHEN category<>'BAKERY' OR capped=0 THEN 'HARD_BLOCK' ELSE 'SOFT_CAP' END AS ttl_policy_applied
  FROM (SELECT *, greatest(round_even(recommended_qty*(1-transit_to_life_ratio),0),0)::INT AS capped FROM sized))""",
    "gated": """
SELECT *, CASE WHEN blocked THEN 'BLOCKED' WHEN confidence_ratio>=0.30e0 OR order_value>=500 THEN 'PENDING_REVIEW'
    ELSE 'AUTO_APPROVED' END AS approval_status,
  CASE WHEN NOT blocked AND (confidence_ratio>=0.30e0 OR order_value>=500) THEN concat_ws('; ',
    CASE WHEN confidence_ratio>=0.30e0 THEN printf('HIGH_UNCERTAINTY: ratio=%.3f', confidence_ratio) END,
    CASE WHEN order_value>=500 THEN printf('HIGH_VALUE: €%.2f', order_value) END) END AS approval_reason
FROM (SELECT *, CASE WHEN NOT blocked AND p50>0 THEN (p90-p10)/p50 ELSE 0e0 END AS confidence_ratio,
  CASE WHEN NOT blocked THEN recommended_qty*unit_cost ELSE 0e0 END AS order_value FROM policed)""",
    "recs": """
SELECT g.werks, g.unified_sku_id, recommended_qty, transit_to_life_ratio, approval_status, approval_reason,
  confidence_ratio, order_value, ttl_policy_applied, day_old_discount, solver_status, q.p10, q.p50, q.p90,
  uncertainty_spread, promo_lift, weather_lift
FROM gated g LEFT JOIN quantiles q ON g.werks=q.werks AND g.unified_sku_id=q.unified_sku_id""",
    "cands": "SELECT * FROM recs WHERE approval_status='AUTO_APPROVED' AND recommended_qty>0",
    "order_audit": """
SELECT werks, unified_sku_id, recommended_qty, approval_status,
  CASE WHEN recommended_qty%10=9 OR recommended_qty%50 IN (18,28,38) THEN 'error' ELSE 'ok' END AS bapi_status,
  CASE WHEN recommended_qty%10<>9 AND recommended_qty%50 NOT IN (18,28,38) THEN '45'||right(unified_sku_id,8) END AS po_number,
  CASE recommended_qty%50 WHEN 18 THEN 'no answer' WHEN 28 THEN 'unreadable answer' WHEN 38 THEN 'no confirmation'
    ELSE CASE WHEN recommended_qty%10=9 THEN 'late; refused' END END AS bapi_message FROM cands""",
    # ---- sweep and review
    "pending": "SELECT * FROM recs WHERE approval_status='PENDING_REVIEW'",
    "queue": """
SELECT werks, unified_sku_id, recommended_qty, transit_to_life_ratio, order_value, quantity_deviation_pct,
  CASE WHEN transit_to_life_ratio>0.5 THEN 'BLOCK' WHEN quantity_deviation_pct>0.25 THEN 'ESCALATE'
    ELSE 'AUTO_APPROVE' END AS sweeper_action,
  CASE WHEN transit_to_life_ratio>0.5 THEN 'High Transit-to-Life'
    WHEN quantity_deviation_pct>0.25 THEN 'High Deviation' END AS exception_type,
  confidence_ratio, promo_lift, '1999-06-30T08:05:00Z' AS _loaded_at
FROM (SELECT *, CASE WHEN p50>0 THEN abs(recommended_qty-p50)/p50 ELSE 0e0 END AS quantity_deviation_pct FROM pending)""",
    "reviewed": """
SELECT *, CASE WHEN NOT esc THEN NULL WHEN far AND order_value>900 THEN 'APPROVED' WHEN far THEN 'REJECTED'
    WHEN order_value<400 AND recommended_qty%3=0 THEN 'REJECTED' WHEN order_value<400 THEN 'APPROVED' END AS manager_decision,
  CASE WHEN NOT esc THEN NULL WHEN far AND order_value>900 THEN 'M3' WHEN far THEN 'M2'
    WHEN order_value<400 AND recommended_qty%3=0 THEN 'M0' WHEN order_value<400 THEN 'M1' END AS manager_id,
  CASE WHEN esc AND order_value<400 THEN 'ok' END AS override_reason,
  CASE WHEN NOT esc THEN NULL WHEN far AND order_value>900 THEN recommended_qty
    WHEN order_value<400 THEN recommended_qty//2 END AS override_qty
FROM (SELECT *, sweeper_action='ESCALATE' AS esc, quantity_deviation_pct>0.75 AS far FROM queue)""",
    "finalized": """
SELECT *, approval_status NOT IN ('BLOCKED','MANAGER_REJECTED') AS needs_order FROM (
  SELECT *, CASE sweeper_action WHEN 'AUTO_APPROVE' THEN 'SWEEPER_AUTO_APPROVED' WHEN 'BLOCK' THEN 'BLOCKED'
    ELSE CASE manager_decision WHEN 'APPROVED' THEN 'MANAGER_APPROVED' WHEN 'REJECTED' THEN 'MANAGER_REJECTED'
      ELSE 'FORCE_APPROVED' END END AS approval_status FROM reviewed)""",
    "final_audit": """
SELECT werks, unified_sku_id, recommended_qty, approval_status,
  CASE WHEN NOT needs_order THEN 'skipped' WHEN recommended_qty%10=9 OR recommended_qty%50 IN (18,28,38) THEN 'error'
    ELSE 'ok' END AS bapi_status,
  CASE WHEN needs_order AND recommended_qty%10<>9 AND recommended_qty%50 NOT IN (18,28,38)
    THEN '45'||right(unified_sku_id,8) END AS po_number,
  CASE WHEN needs_order THEN CASE recommended_qty%50 WHEN 18 THEN 'no answer' WHEN 28 THEN 'unreadable answer'
    WHEN 38 THEN 'no confirmation' ELSE CASE WHEN recommended_qty%10=9 THEN 'late; refused' END END END AS bapi_message
  FROM finalized""",
    "consolidated": """
SELECT a.*, ean_barcode, vendor_id, unit_cost, transit_days
FROM (SELECT * FROM order_audit UNION ALL SELECT * FROM final_audit) a
LEFT JOIN master m ON a.werks=m.werks AND a.unified_sku_id=m.unified_sku_id WHERE bapi_status='ok'""",
    "edi_rows": """
SELECT coalesce(vendor_id,'UNKNOWN') AS vendor_id,
  row_number() OVER (PARTITION BY coalesce(vendor_id,'UNKNOWN') ORDER BY unified_sku_id, werks, po_number) AS line_number,
  po_number, coalesce(ean_barcode,'') AS ean_barcode, recommended_qty AS quantity, 'EA' AS unit,
  unit_cost AS unit_price, strftime(DATE '1999-06-30'+transit_days, '%Y%m%d') AS requested_ship_date
FROM consolidated""",
    "edi_heads": """
SELECT vendor_id, count(*) AS n_lines, max(po_number) FILTER (line_number=1) AS first_po,
  'EDI850_'||(max(po_number) FILTER (line_number=1))||'_19990630081000.edi' AS edi_file
FROM edi_rows GROUP BY vendor_id""",
    # ---- documents
    "doc_rows": "SELECT doc_id::VARCHAR AS path, text, sha256(text) AS hash FROM documents",
    "manifest": """
SELECT d.doc_id::VARCHAR AS path, CASE WHEN quality=1 THEN sha256(text) ELSE 'outdated' END AS hash,
  '1999-06-29T00:00:00' AS processed_at FROM documents d JOIN labels l ON d.doc_id=l.doc_id""",
    "changed": """
SELECT d.path, d.hash, CASE WHEN m.hash IS NULL THEN 'new' ELSE 'changed' END AS reason
FROM doc_rows d LEFT JOIN manifest m ON d.path=m.path WHERE d.hash IS DISTINCT FROM m.hash""",
}


def statement(sql: str) -> str:
    """Puts the views a statement needs in front of it, each after the ones it needs itself."""
    ordered: list[str] = []
    open_: set[str] = set()

    def need(text: str) -> None:
        for name, body in VIEWS.items():
            if name in ordered or name in open_ or not re.search(rf"\b{name}\b(?!\()", text):
                continue
            open_.add(name)
            need(body)
            open_.discard(name)
            ordered.append(name)

    need(sql)
    if not ordered:
        return sql.strip()
    parts = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in ordered)
    return f"WITH {parts}\n{sql.strip()}"
