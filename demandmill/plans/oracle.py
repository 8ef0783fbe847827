"""The registered queries in SQL, written apart from the library's expressions.

Rounding is spelled out on decimals: half to even, as the library rounds. Division guards a zero
base with ``nullif``.
"""

from __future__ import annotations


def rnd(x: str, digits: int = 0) -> str:
    """Half-to-even rounding of a SQL expression."""
    v = f"CAST({x} AS DECIMAL(28,10))"
    r = f"round({v}, {digits})"
    unit = "1" if digits == 0 else "0." + "0" * (digits - 1) + "1"
    half = "0." + "0" * digits + "5"
    odd = f"CAST({r} * {10 ** digits} AS HUGEINT) % 2 <> 0"
    return (
        f"CAST(CASE WHEN abs({r} - {v}) = {half} AND {odd} "
        f"THEN {r} - sign({v}) * {unit} ELSE {r} END AS DOUBLE)"
    )


def pct(e: str, s: str) -> str:
    """Accuracy in percent from an error and a base."""
    return rnd(f"(1 - ({e}) / nullif({s}, 0)) * 100", 2)


# ---- forecast accuracy --------------------------------------------------------------------------

SKU_MONTH = """sku_month AS (
  SELECT l_partkey AS key, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
         sum(l_quantity) AS units
  FROM lineitem GROUP BY 1, 2)"""

FORECASTS = (
    SKU_MONTH
    + """,
fc AS (
  SELECT key, CAST(month + to_days(CAST(key % 9 + 7 AS INTEGER)) AS DATE) AS v,
         CAST(month + to_months(k) AS DATE) AS f, units AS mean_fcst,
         units + floor(units / 10) AS p70, units + floor(units / 5) AS p80,
         units + floor(units * 7 / 20) AS p90
  FROM sku_month, (SELECT unnest([1, 2, 3, 4, 5]) AS k)),
lagged AS (
  SELECT *, (year(f) - year(v)) * 12 + month(f) - month(v)
            - CASE WHEN day(v) > day(f) THEN 1 ELSE 0 END + 1 AS lag
  FROM fc
  WHERE day(v) BETWEEN 9 AND 15 AND f BETWEEN DATE '2000-10-01' AND DATE '2001-09-01'),
lt AS (
  SELECT p_partkey AS key, p_size % 4 + 1 AS lead,
         CASE p_type WHEN 'ECONOMY' THEN 'WATERING' WHEN 'LARGE' THEN 'TOTAL SCISSORS'
                     WHEN 'MEDIUM' THEN 'COOKING' WHEN 'PROMO' THEN 'STRIKING TOOLS'
                     WHEN 'SMALL' THEN 'CREATING' END AS cat,
         p_brand AS sub
  FROM part WHERE p_size < 50),
seg AS (
  SELECT p_partkey AS key,
         CASE WHEN p_size <= 10 THEN 'Smooth' WHEN p_size <= 20 THEN 'Erratic'
              WHEN p_size <= 30 THEN 'Intermittent' WHEN p_size <= 40 THEN 'Lumpy'
              WHEN p_size <= 45 THEN 'New' ELSE 'Inactive' END AS demand,
         CASE WHEN p_type IN ('ECONOMY', 'LARGE') THEN 'A'
              WHEN p_type IN ('MEDIUM', 'PROMO') THEN 'B'
              WHEN p_type = 'SMALL' THEN 'C' END AS abc
  FROM part),
base AS (
  SELECT l.f, l.key, 'A' || l.key AS asin, '0' || l.key AS upc,
         CASE WHEN lt.key IS NOT NULL THEN 'S' || lt.key END AS sku,
         'Item ' || l.key AS title, lt.cat, lt.sub, l.mean_fcst, l.p70, l.p80, l.p90, l.lag,
         l.lag = lt.lead AS own, m.units AS shipped, seg.demand, seg.abc,
         abs(l.mean_fcst - m.units) AS err,
         CASE WHEN l.p70 >= m.units THEN 1 WHEN l.p70 < m.units THEN 0 END AS b70,
         CASE WHEN l.p80 >= m.units THEN 1 WHEN l.p80 < m.units THEN 0 END AS b80,
         CASE WHEN l.p90 >= m.units THEN 1 WHEN l.p90 < m.units THEN 0 END AS b90
  FROM lagged l
  LEFT JOIN lt ON lt.key = l.key
  LEFT JOIN sku_month m ON m.key = l.key AND m.month = l.f
  LEFT JOIN seg ON seg.key = lt.key
  WHERE l.lag <> 5),
viewed AS (
  SELECT 'Lag_' || lag AS view, * FROM base WHERE lag IN (1, 2, 3)
  UNION ALL SELECT 'Our_LT', * FROM base WHERE own)"""
)

MONTHLY_VIEW = """by_view AS (
  SELECT view, f, sum(mean_fcst) AS mean_fcst, coalesce(sum(err), 0) AS err,
         coalesce(sum(shipped), 0) AS shipped, count(*) AS n,
         1 - coalesce(sum(err), 0) / nullif(coalesce(sum(shipped), 0), 0) AS acc,
         coalesce(sum(b70), 0) / count(*) AS b70, coalesce(sum(b80), 0) / count(*) AS b80,
         coalesce(sum(b90), 0) / count(*) AS b90
  FROM viewed GROUP BY view, f)"""

POS: dict[str, str] = {
    "pos_accuracy_by_view": f"""WITH {FORECASTS}, {MONTHLY_VIEW}
SELECT view AS "View", CAST(f AS VARCHAR) AS "Fcst_Date", strftime(f, '%B') AS "Month",
       year(f) AS "Year", mean_fcst AS "Mean_Fcst", err AS "Mean_ABS_Error",
       shipped AS "Shipped_Units", n AS "Num_SKUs", acc AS "Mean_Acc", b70 AS "P70_Below",
       b80 AS "P80_Below", b90 AS "P90_Below"
FROM by_view""",
    "pos_base": f"""WITH {FORECASTS}
SELECT DISTINCT CAST(f AS VARCHAR) AS "Fcst_Date", asin AS "ASIN", upc AS "UPC", sku AS "SKU",
       title AS "Product_Title", cat AS "Category", sub AS "Sub_Category", month(f) AS "Month_Num",
       strftime(f, '%B') AS "Month", year(f) AS "Year", mean_fcst AS "Mean_Fcst",
       p70 AS "P70_Fcst", p80 AS "P80_Fcst", p90 AS "P90_Fcst", lag AS "Lag", own AS "Our_LT",
       shipped AS "Shipped_Units", demand AS "DEMAND_CAT_CU", abc AS "ABC_REV_ITM_CU",
       err AS "Mean_ABS_Error", b70 AS "P70_Below", b80 AS "P80_Below", b90 AS "P90_Below"
FROM base""",
    "pos_kpis": f"""WITH {FORECASTS}
SELECT view AS "View", {pct("sum(err)", "sum(shipped)")} AS "Total_Acc",
       {rnd("sum(b70) / count(*) * 100", 2)} AS "P70_Per",
       {rnd("sum(b80) / count(*) * 100", 2)} AS "P80_Per",
       {rnd("sum(b90) / count(*) * 100", 2)} AS "P90_Per"
FROM viewed GROUP BY view""",
    "pos_trend_long": f"""WITH {FORECASTS}, {MONTHLY_VIEW},
cells AS (
  SELECT view, f, 'Mean_Acc' AS t, acc AS x FROM by_view
  UNION ALL SELECT view, f, 'P70_Below', b70 FROM by_view
  UNION ALL SELECT view, f, 'P80_Below', b80 FROM by_view
  UNION ALL SELECT view, f, 'P90_Below', b90 FROM by_view)
SELECT view AS "View", CAST(f AS VARCHAR) AS "Fcst_Date", strftime(f, '%b') AS "Month",
       year(f) AS "Year", t AS "Type", x * 100 AS "Value"
FROM cells""",
    "pos_by_segment": f"""WITH {FORECASTS},
classes AS (
  SELECT view, demand AS c, sum(err) AS e, sum(shipped) AS s FROM viewed
  WHERE demand IS NOT NULL AND demand NOT IN ('New', 'Inactive') GROUP BY 1, 2
  UNION ALL
  SELECT view, abc, sum(err), sum(shipped) FROM viewed WHERE abc IS NOT NULL GROUP BY 1, 2)
SELECT view AS "View", c AS "Seg_Cat",
       CASE c WHEN 'A' THEN 1 WHEN 'B' THEN 2 WHEN 'C' THEN 3 WHEN 'Smooth' THEN 4
              WHEN 'Erratic' THEN 5 WHEN 'Intermittent' THEN 6 WHEN 'Lumpy' THEN 7 END
         AS "Seg_Order",
       {pct("coalesce(e, 0)", "coalesce(s, 0)")} AS "Mean_Acc"
FROM classes""",
}

DIVISION = """CASE WHEN cat = 'WATERING' THEN 'WAT'
         WHEN cat IN ('TOTAL SCISSORS', 'COOKING', 'CREATING', 'ALL OTHER SOC') THEN 'SOC'
         WHEN cat IS NOT NULL THEN 'GOL' END"""

LEVEL_SUMS = f"""own_rows AS (
  SELECT *, {DIVISION} AS div FROM (SELECT DISTINCT * FROM base) WHERE own),
levels AS (
  SELECT 'Div' AS level, div AS member, sum(err) AS e, sum(shipped) AS s FROM own_rows GROUP BY div
  UNION ALL SELECT 'Category', cat, sum(err), sum(shipped) FROM own_rows GROUP BY cat
  UNION ALL SELECT 'Sub_Category', sub, sum(err), sum(shipped) FROM own_rows GROUP BY sub
  UNION ALL SELECT 'SKU', sku, sum(err), sum(shipped) FROM own_rows GROUP BY sku),
accs AS (
  SELECT level, member, coalesce(e, 0) AS e, coalesce(s, 0) AS s,
         {rnd('''CASE WHEN coalesce(s, 0) = 0 AND coalesce(e, 0) > 0 THEN 0
              WHEN coalesce(s, 0) = 0 THEN NULL
              WHEN 1 - e / s < 0 THEN 0 ELSE (1 - e / s) * 100 END''', 2)} AS acc
  FROM levels)"""


def _label(name: str, acc: str) -> str:
    text = f"coalesce(regexp_replace(CAST({acc} AS VARCHAR), '\\.0$', ''), 'NA')"
    return f"coalesce({name}, 'NA') || ' (' || {text} || '% )'"


POS["hierarchy_accuracy"] = f"""WITH {FORECASTS}, {LEVEL_SUMS}
SELECT level AS "Level", member AS "Member", e AS "Mean_ABS_Error", s AS "Shipped_Units",
       acc AS "Acc"
FROM accs"""

POS["hierarchy_tree"] = f"""WITH {FORECASTS}, {LEVEL_SUMS},
one AS (
  SELECT * FROM own_rows WHERE abc IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY sku ORDER BY
    shipped DESC NULLS LAST, f DESC, title DESC NULLS LAST, div DESC NULLS LAST,
    cat DESC NULLS LAST, sub DESC NULLS LAST, demand DESC NULLS LAST, abc DESC,
    mean_fcst DESC NULLS LAST, err DESC NULLS LAST) = 1),
best AS (
  SELECT * FROM one WHERE shipped IS NOT NULL
  QUALIFY rank() OVER (PARTITION BY sub ORDER BY shipped DESC) <= 50)
SELECT {_label("b.div", "d.acc")} AS "Div", {_label("b.cat", "c.acc")} AS "Category",
       {_label("b.sub", "u.acc")} AS "Sub_Category", {_label("b.sku", "k.acc")} AS "SKU",
       b.title AS "Product_Title", b.demand AS "DEMAND_CAT_CU", b.abc AS "ABC_REV_ITM_CU",
       b.mean_fcst AS "Mean_Fcst", b.err AS "Mean_ABS_Error", b.shipped AS "Shipped_Units",
       CASE b.abc WHEN 'A' THEN 'red' WHEN 'B' THEN 'green' ELSE 'yellow' END AS abc_col
FROM best b
LEFT JOIN accs d ON d.level = 'Div' AND d.member IS NOT DISTINCT FROM b.div
LEFT JOIN accs c ON c.level = 'Category' AND c.member IS NOT DISTINCT FROM b.cat
LEFT JOIN accs u ON u.level = 'Sub_Category' AND u.member IS NOT DISTINCT FROM b.sub
LEFT JOIN accs k ON k.level = 'SKU' AND k.member IS NOT DISTINCT FROM b.sku"""

POS["top_n_with_ties"] = """WITH units AS (
  SELECT l_partkey, sum(l_quantity) AS units FROM lineitem GROUP BY 1)
SELECT p_brand, p_partkey, units
FROM part JOIN units ON p_partkey = l_partkey
QUALIFY rank() OVER (PARTITION BY p_brand ORDER BY units DESC) <= 10"""

# ---- cleaning -----------------------------------------------------------------------------------


def money_sql(t: str) -> str:
    for mark in "$,()":
        t = f"replace({t}, '{mark}', '')"
    return f"TRY_CAST({t} AS DOUBLE)"


def percent_sql(t: str) -> str:
    return f"TRY_CAST(replace(replace({t}, '%', ''), ',', '') AS DOUBLE) / 100"


def plain_percent_sql(t: str) -> str:
    return f"TRY_CAST(replace({t}, '%', '') AS DOUBLE) / 100"


def count_sql(t: str) -> str:
    return f"TRY_CAST(replace({t}, ',', '') AS DOUBLE)"


CLEAN: dict[str, str] = {
    "clean_money_percent": f"""WITH raw AS (
  SELECT o_orderkey, o_orderpriority = '4-NOT SPECIFIED' AS dash, o_orderstatus = 'P' AS paren,
         format('{{:,.2f}}', o_totalprice) AS amount,
         format('{{:,.1f}}', floor(o_totalprice) / 2) || '%' AS share
  FROM orders),
t AS (
  SELECT *, CASE WHEN dash THEN '—' WHEN paren THEN '($' || amount || ')'
                 ELSE '$' || amount END AS m
  FROM raw)
SELECT o_orderkey, {money_sql("m")} AS money,
       CASE WHEN m LIKE '(%' THEN -{money_sql("m")} ELSE {money_sql("m")} END AS signed_money,
       {percent_sql("share")} AS percent, {plain_percent_sql("share")} AS plain_percent,
       {count_sql("amount")} AS "count"
FROM t""",
    "file_metadata": """SELECT o_orderkey,
  CASE WHEN o_orderstatus <> 'P'
       THEN CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) END AS "Date",
  CASE WHEN o_orderstatus = 'P' THEN 'Sometime' ELSE strftime(o_orderdate, '%B') END AS "Month",
  CASE WHEN o_orderstatus <> 'P' THEN month(o_orderdate) END AS "Month_Num",
  strftime(o_orderdate, '%Y') AS "Year",
  CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS "Week_Date"
FROM orders""",
    "strict_sum": """WITH v AS (
  SELECT l_partkey, year(l_shipdate) AS ship_year,
         CASE WHEN l_returnflag = 'R' AND l_tax = 0 THEN NULL ELSE l_quantity END AS q
  FROM lineitem)
SELECT l_partkey, ship_year, CASE WHEN count(q) = count(*) THEN sum(q) END AS units
FROM v GROUP BY 1, 2""",
    "append_unique": """SELECT DISTINCT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority
FROM orders""",
}

REPORT_VALUES = """v AS (
  SELECT l_partkey AS key, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
         CAST(sum(l_quantity) AS BIGINT) AS q,
         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS rev, count(*) AS n
  FROM lineitem GROUP BY 1, 2)"""


def report_cell(rule: str, i: int) -> str:
    if rule == "money":
        cents = f"lpad(CAST((rev + {i}) % 100 AS VARCHAR), 2, '0')"
        amount = f"'$' || format('{{:,}}', rev // 100) || '.' || {cents}"
        text = f"CASE WHEN q = {i} THEN '—' WHEN n = 2 THEN '(' || {amount} || ')' ELSE {amount} END"
        return money_sql(f"({text})")
    if rule == "percent":
        return percent_sql(f"(format('{{:,}}', q * 20) || '.{i % 10}%')")
    if rule == "plain":
        return plain_percent_sql(f"(format('{{:,}}', q * 20) || '.{i % 10}%')")
    if rule == "count":
        return count_sql(f"('{i},' || lpad(CAST(q % 1000 AS VARCHAR), 3, '0'))")
    return "CASE WHEN q < 25 THEN 'Basic' ELSE 'Core' END"


def report_sql(names: tuple[str, ...], rules: dict[int, str], rest: str) -> str:
    """Cells by ordinal (from 1) as the file positions are documented."""
    cells = [
        f'{report_cell(rules.get(o, rest), o - 1)} AS "{n}"'
        for o, n in enumerate(names, 1)
        if o > 3
    ]
    return ",\n       ".join(cells)


ITEM_COLUMNS = """'A' || key AS "ASIN", '0' || key AS "UPC", 'Item ' || key AS "Product_Title\""""
MONTH_COLUMNS = """CAST(month AS VARCHAR) AS "Date", strftime(month, '%B') AS "Month",
       month(month) AS "Month_Num", strftime(month, '%Y') AS "Year\""""


def _reports() -> dict[str, str]:
    from demandmill.sources import layouts as lay

    money = dict.fromkeys
    spec = {
        "sales": (lay.SALES, money((4, 8, 12, 14), "money"), "percent"),
        "shipped": (lay.SHIPPED, money((4, 8, 12, 16, 17, 18, 20), "money"), "percent"),
        "traffic": (lay.TRAFFIC, {}, "plain"),
        "inventory_health": (lay.INVENTORY_HEALTH, {6: "percent", 20: "text"}, "money"),
        "reviews": (lay.REVIEWS, {}, "count"),
    }
    out = {
        f"clean_report_{n}": f"""WITH {REPORT_VALUES}
SELECT {MONTH_COLUMNS},
       {ITEM_COLUMNS},
       {report_sql(x.columns, rules, rest)}
FROM v"""
        for n, (x, rules, rest) in spec.items()
    }
    rules = {**money((7, 9, 10, 12, 13, 16), "money"), 17: "text"}
    out["clean_inventory"] = f"""WITH w AS (
  SELECT l_partkey AS key,
         DATE '1995-01-02' + CAST(floor(date_diff('day', DATE '1995-01-02', CAST(l_shipdate AS DATE))
           / 182) * 182 AS INTEGER) AS month,
         CAST(sum(l_quantity) AS BIGINT) AS q
  FROM lineitem GROUP BY 1, 2),
v AS (SELECT *, q * 700 AS rev, 1 AS n FROM w)
SELECT CAST(month AS VARCHAR) AS "Date", strftime(month, '%B') AS "Month",
       month(month) AS "Month_Num", day(month) AS "Day", year(month) AS "Year",
       {ITEM_COLUMNS},
       {report_sql(lay.INVENTORY.columns, rules, "percent")}
FROM v"""
    return out


# ---- weekly to monthly --------------------------------------------------------------------------

WEEKLY = f"""lines AS (
  SELECT l_partkey AS key, date_diff('day', DATE '1995-01-02', CAST(l_shipdate AS DATE)) AS d,
         l_quantity
  FROM lineitem),
cells AS (
  SELECT key, d // 182 AS file, d % 182 // 7 AS week, CAST(sum(l_quantity) AS BIGINT) AS u
  FROM lines GROUP BY 1, 2, 3),
days AS (
  SELECT file, i // 7 AS week, CAST(DATE '1995-01-02' + CAST(file * 182 AS INTEGER) AS DATE) AS v,
         CAST(DATE '1995-01-02' + CAST(file * 182 + i AS INTEGER) AS DATE) AS day
  FROM (SELECT DISTINCT file FROM cells), (SELECT unnest(range(182)) AS i)),
kept AS (
  SELECT file, v, week, CAST(date_trunc('month', day) AS DATE) AS month, count(*) AS n
  FROM days
  WHERE day >= date_trunc('month', v) + INTERVAL 1 MONTH
    AND day < date_trunc('month', v + 181)
  GROUP BY 1, 2, 3, 4),
grid AS (
  SELECT i.key, k.v, k.month, k.n,
         CASE WHEN c.u = 13 THEN NULL ELSE coalesce(c.u, 0) END AS u
  FROM (SELECT DISTINCT key, file FROM cells) i
  JOIN kept k ON k.file = i.file
  LEFT JOIN cells c ON c.key = i.key AND c.file = i.file AND c.week = k.week),
monthly AS (
  SELECT key, v, month, t, {rnd("CASE WHEN count(u) = count(*) THEN sum((u * 1000 + x) * n) / 7.0 END")} AS y
  FROM grid, (VALUES ('Mean_Fcst', 0), ('P70_Fcst', 100), ('P80_Fcst', 200), ('P90_Fcst', 350))
    AS f(t, x)
  GROUP BY 1, 2, 3, 4)"""

WEEK_COLUMNS = """CAST(v AS VARCHAR) AS "POS_Fcst_Version_Date", 'A' || key AS "ASIN",
       '0' || key AS "UPC", 'Item ' || key AS "Product_Title", month(month) AS "Month_Num",
       strftime(month, '%B') AS "Month", year(month) AS "Year\""""

WEEK: dict[str, str] = {
    "weekly_to_monthly": f"""WITH {WEEKLY}
SELECT {WEEK_COLUMNS}, t AS "POS_Forecast_Type", y AS "POS_Forecast" FROM monthly""",
    "forecast_measures_wide": f"""WITH {WEEKLY}
SELECT {WEEK_COLUMNS},
       max(CASE WHEN t = 'Mean_Fcst' THEN y END) AS "Mean_Fcst",
       max(CASE WHEN t = 'P70_Fcst' THEN y END) AS "P70_Fcst",
       max(CASE WHEN t = 'P80_Fcst' THEN y END) AS "P80_Fcst",
       max(CASE WHEN t = 'P90_Fcst' THEN y END) AS "P90_Fcst"
FROM monthly GROUP BY key, v, month""",
}

# ---- month end ----------------------------------------------------------------------------------

ORDER_ROWS = """src AS (
  SELECT r_name AS country, c_mktsegment AS division,
         CASE WHEN n_name = 'NATION_0' THEN NULL WHEN n_name = 'NATION_1' THEN 'ALL OTHER'
              WHEN n_name = 'NATION_2' THEN 'OWN E-COMMERCE' ELSE n_name END AS manager,
         'DIRECTOR ' || r_name AS director,
         CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'ALL OTHER - (G45)'
              ELSE c_mktsegment END AS customer,
         o_orderpriority AS srp5, nullif(o_orderstatus, 'P') AS srp7, n_name,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS fc,
         CASE WHEN r_name = 'EUROPE' THEN 0.75 ELSE 1.0 END AS rate,
         CAST(o_totalprice AS DECIMAL(18,2)) AS price
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey),
grouped AS (
  SELECT country, division, manager, director, customer, srp5, srp7, n_name, fc, rate,
         sum(price) AS v
  FROM src GROUP BY ALL)"""


def month_end_sql(version: str, me: str, keep_null: bool) -> str:
    """CTEs for one version's reworked table, named ``me``."""
    scale = (
        f"CASE WHEN fc > DATE '{version}' THEN 0.9 ELSE 1.0 END"
        if version == "2001-03-31"
        else "1.0"
    )
    drop = "" if keep_null else "WHERE manager IS NOT NULL AND srp7 IS NOT NULL"
    director = "" if keep_null else "director,"
    # Raw rows without a manager still name its director, and deltas find it.
    return f"""{me}_rows AS (
  SELECT country, division, manager, director, customer, srp5, srp7, fc, rate,
         CASE WHEN fc <= DATE '{version}' THEN v * {scale} ELSE 0 END AS ship,
         CASE WHEN fc > DATE '{version}' THEN v * {scale} ELSE 0 END AS fcst,
         v * {scale} AS possible, 0 AS delta
  FROM grouped {drop}
  UNION ALL
  SELECT country, division, coalesce(manager, '0'), director, customer, srp5, coalesce(srp7, '0'),
         fc, rate, 0, 0, 0,
         v * CASE srp5 WHEN '1-URGENT' THEN 0.02 ELSE -0.01 END
  FROM grouped WHERE srp5 IN ('1-URGENT', '2-HIGH')),
{me} AS (
  SELECT country, division, manager, {director} customer, srp5, srp7, fc, rate,
         CAST(sum(ship) AS DOUBLE) AS ship, CAST(sum(fcst) AS DOUBLE) AS fcst,
         CAST(sum(possible) AS DOUBLE) AS possible, CAST(sum(delta) AS DOUBLE) AS delta,
         CAST(sum(possible) AS DOUBLE) + CAST(sum(delta) AS DOUBLE) AS combined
  FROM {me}_rows GROUP BY ALL)"""


def outputs_sql(now: str, before: str | None) -> str:
    """Rows and sums of the five outputs of version ``now``, the one before being published or not."""
    sums = """SELECT '{v}' AS version, count(*) AS n, {s} AS s, {f} AS f, {d} AS d FROM {t}"""
    part = lambda v, t: sums.format(v=v, t=t, s=exact2("ship"), f=exact2("fcst"), d=exact2("delta"))
    earlier = f"{month_end_sql(before, 'prev', False)}," if before else ""
    previous = part(before, "prev") if before else "SELECT NULL AS version, 0 AS n, 0 AS s, 0 AS f, 0 AS d"
    return f"""WITH {ORDER_ROWS}, {month_end_sql(now, "me", False)},
{earlier}
delta_rows AS (
  SELECT CAST(v * CASE srp5 WHEN '1-URGENT' THEN 0.02 ELSE -0.01 END AS DOUBLE) AS delta
  FROM grouped WHERE srp5 IN ('1-URGENT', '2-HIGH')),
sums AS ({part(now, "me")}),
before AS ({previous})
SELECT o AS output, n, version, s AS "Shipments", f AS "Forecast", d AS "Delta"
FROM sums, (VALUES ('monthly'), ('current'), ('last_month')) AS names(o)
UNION ALL SELECT 'previous', n, version, s, f, d FROM before
UNION ALL SELECT 'deltas', count(*), '{now}', 0, 0, {exact2("delta")} FROM delta_rows"""


def month_end_columns(version: str, director: bool, combined: str = "combined") -> str:
    d = "director AS \"Director\"," if director else ""
    return f"""'{version}' AS "ME_Version_Date", country AS "Country", division AS "Division",
       manager AS "Sales_Manager", {d} customer AS "Customer", srp5 AS "SRP5", srp7 AS "SRP7",
       year(fc) AS "Year", strftime(fc, '%B') AS "Month", CAST(fc AS VARCHAR) AS "FC_Date",
       month(fc) AS "Month_No", ship AS "Shipments", fcst AS "Forecast",
       possible AS "Total_Possible", delta AS "Delta", ship AS "Actl_TP",
       possible AS "Actl_TP_Fcst", {combined} AS "Actl_TP_Fcst_Delta",
       CAST(rate AS DOUBLE) AS "Conversion_Rate", strftime(fc, '%B%Y') AS "Month_Year",
       country || strftime(fc, '%B%Y') AS "Key", 'Y' AS "Current_ME_Version",
       CASE WHEN fc = date_trunc('month', DATE '{version}') THEN 'Y' ELSE 'N' END
         AS "Current_Month\""""


THIS, LAST = "2001-04-30", "2001-03-31"
REWORKED = f"""WITH {ORDER_ROWS}, {month_end_sql(THIS, "me", False)}
SELECT {month_end_columns(THIS, True)} FROM me"""
MANAGERS_OUT = "('NATION_7', 'NATION_8', 'OWN E-COMMERCE', 'OPEN GOVERNMENT')"


def manager_sql(me: str) -> str:
    return f"""SELECT manager, {rnd("sum(CAST(combined AS DECIMAL(18,4))) / 1000.0", 1)} AS total
  FROM {me}
  WHERE customer = 'ALL OTHER - (G45)' AND year(fc) = 2001
    AND (manager IS NULL OR manager NOT IN {MANAGERS_OUT})
  GROUP BY manager"""


def exact2(name: str) -> str:
    return rnd(f"sum(CAST({name} AS DECIMAL(28,10)))", 2)


MONTH_END: dict[str, str] = {
    "month_end_rework": REWORKED,
    "write_read_roundtrip": REWORKED,
    "month_end_rework_r": f"""WITH {ORDER_ROWS}, {month_end_sql(THIS, "me", True)}
SELECT {month_end_columns(THIS, False)} FROM me""",
    "month_end_rework_r_pooled": f"""WITH {ORDER_ROWS}, {month_end_sql(THIS, "me", True)}
SELECT {month_end_columns(THIS, False, '''sum(combined) OVER (PARTITION BY country, division,
         manager, customer, srp5, srp7, fc, rate)''')} FROM me""",
    "month_over_month_top10": f"""WITH {ORDER_ROWS}, {month_end_sql(THIS, "me", True)},
{month_end_sql(LAST, "prev", False)},
tm AS ({manager_sql("me")}),
lm AS ({manager_sql("prev")}),
changes AS (
  SELECT coalesce(tm.manager, '0') AS manager, tm.total AS t, coalesce(lm.total, 0) AS l
  FROM tm LEFT JOIN lm ON tm.manager IS NOT DISTINCT FROM lm.manager)
SELECT manager AS "Sales_Manager", t AS "TM_Total", l AS "LM_Total", t - l AS variance,
       abs(t - l) AS abs_variance, CASE WHEN t - l < 0 THEN 'below' ELSE 'above' END AS color
FROM changes WHERE manager <> 'ALL OTHER'
ORDER BY abs(t - l) DESC, manager DESC LIMIT 10""",
    "forecast_snapshot": f"""WITH {ORDER_ROWS}, {month_end_sql(THIS, "me", False)},
future AS (
  SELECT customer, division, country, manager, month(fc) AS m, year(fc) AS y,
         {rnd("sum(CAST(combined AS DECIMAL(18,4)))")} AS x
  FROM me WHERE fc > DATE '{THIS}' GROUP BY 1, 2, 3, 4, 5, 6),
past AS (
  SELECT division AS customer, division, country, n_name AS manager, month(fc) AS m,
         year(fc) AS y, {rnd("sum(v)")} AS x
  FROM grouped WHERE month(fc) <= 4 AND year(fc) = 2001 GROUP BY 1, 2, 3, 4, 5, 6),
both_parts AS (
  SELECT CASE WHEN customer = 'ALL OTHER - (G45)' AND manager <> 'ALL OTHER'
              THEN 'ALL OTHER BY SALES MANAGER' ELSE customer END AS customer,
         division, country, manager, m, y, x
  FROM future
  UNION ALL SELECT * FROM past)
SELECT customer AS "Customer", division AS "Division", country AS "Country",
       manager AS "Sales_Manager", m AS "Month_No", y AS "Year", t AS "Forecast_Type",
       x AS "Forecast_Plus_Delta"
FROM both_parts, (VALUES ('BF'), ('LE')) AS types(t)""",
    "published_outputs": outputs_sql(THIS, LAST),
    "published_after_break": outputs_sql(LAST, None),
    "previous_month_partition": """WITH m AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM orders GROUP BY 1)
SELECT CAST(a.month AS VARCHAR) AS month, a.value, b.value AS last_value,
       strftime(a.month, '%m-Reworked Month End Raw Data - %B %Y.csv') AS name,
       strftime(a.month - INTERVAL 1 MONTH, '%m-Reworked Month End Raw Data - %B %Y.csv')
         AS last_name
FROM m a LEFT JOIN m b ON b.month = a.month - INTERVAL 1 MONTH""",
}

# ---- combined accuracy --------------------------------------------------------------------------

SHEETS = f"""grain AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, l_linestatus AS st,
         l_returnflag AS fl, l_linenumber >= 6 AS promo, l_partkey AS key, sum(l_quantity) AS u,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS c, count(*) AS n
  FROM lineitem GROUP BY 1, 2, 3, 4, 5),
sheet AS (
  SELECT *, CASE WHEN n = 1 AND u < 5 THEN 0 ELSE u END AS o,
         floor(u * CASE WHEN fl = 'R' THEN 3 ELSE 1 END / 2) AS f,
         CASE WHEN st = 'O' THEN 'USA' ELSE 'CANADA' END AS country,
         CASE WHEN fl = 'R' AND st = 'O' THEN ' do it best corp '
              WHEN fl = 'R' THEN 'All Other - (G45)'
              WHEN fl = 'A' AND st = 'O' THEN 'Meijer Inc' WHEN fl = 'A' THEN ' All Other - (G45)'
              WHEN st = 'O' THEN 'orgill west' || chr(9) ELSE 'True Value' END AS cust
  FROM grain WHERE NOT promo),
rounded AS (
  SELECT *, {rnd("c * 0.75")} AS fc_cost, {rnd("CASE WHEN o = 0 THEN 0 ELSE c END")} AS o_cost
  FROM sheet)"""

CARRIED = f"""strftime(month, '%Y') AS "Year", strftime(month, '%B') AS "Month",
       strftime(month, '%B %Y') AS "MonthYear", country AS "Country",
       CAST(key AS VARCHAR) AS "SKU Number", country || cust || 'RECREATION' AS "Sales Rep Key",
       {rnd("c / nullif(o, 0)", 2)} AS "Cost", 'OUR' AS "Division", cust AS "Customer",
       'RECREATION' AS "Category (SRP 5)", fl AS "Sub-Category (SRP 7)",
       key || ' Item ' || key AS "SKU", f AS "LT Forecast - Units",
       c * 0.5 AS "LT Forecast - Cost", CAST(o AS DOUBLE) AS "Orders - Units",
       c AS "Orders - Cost", CASE WHEN n > 1 THEN 'several lines' END AS "Adjustment Request",
       CAST(0 AS DOUBLE) AS "Forecast Adjustments", f AS "Adjusted FC - Units",
       fc_cost AS "Adjusted FC - Cost", CAST(0 AS DOUBLE) AS "Order Adjustments",
       CAST(o AS DOUBLE) AS "Adjusted Orders - Units", o_cost AS "Adjusted Orders - Cost\""""


def metric_sql(o: str, f: str, basis: str) -> str:
    ape = rnd(f"abs({o} - {f}) / nullif({o}, 0)", 2)
    acc = rnd(
        f"CASE WHEN {o} = 0 AND abs({o} - {f}) > 0 THEN 0 WHEN {o} = 0 THEN NULL "
        f"WHEN 1 - {ape} < 0 THEN 0 ELSE 1 - {ape} END",
        2,
    )
    return f"""{o} - {f} AS "Error - {basis}", abs({o} - {f}) AS "ABS Error - {basis}",
       {ape} AS "ABS Percent Error - {basis}", {acc} AS "Accuracy - {basis}",
       {rnd(f"-(({o} - {f}) / nullif({o}, 0))", 2)} AS "Bias - {basis}\""""


HARMONISED: dict[str, str] = {
    "harmonise_accuracy": f"WITH {SHEETS}\nSELECT {CARRIED}\nFROM rounded",
    "error_metrics": f"""WITH {SHEETS}
SELECT {CARRIED},
       {metric_sql("o", "f", "Units")},
       {metric_sql("o_cost", "fc_cost", "Cost")}
FROM rounded""",
    "canonical_customer": f"""WITH {SHEETS},
named AS (
  SELECT *, CASE cust WHEN ' do it best corp ' THEN 'DO IT BEST'
                      WHEN 'All Other - (G45)' THEN 'ALL OTHER' WHEN 'Meijer Inc' THEN 'MEIJER'
                      WHEN ' All Other - (G45)' THEN 'ALL OTHER - (G45)'
                      WHEN 'True Value' THEN 'TRUE VALUE' ELSE 'ORGILL' END AS name
  FROM rounded)
SELECT name AS "Customer", strftime(month, '%Y') AS "Year", count(*) AS n,
       CAST(sum(o) AS DOUBLE) AS units, sum(abs(o - f)) AS abs_error_units
FROM named GROUP BY 1, 2""",
}

# ---- history, backtest, scoring -----------------------------------------------------------------

DENSE = (
    SKU_MONTH
    + """,
cal AS (
  SELECT CAST(DATE '1995-01-01' + to_months(CAST(i AS INTEGER)) AS DATE) AS month, i
  FROM (SELECT unnest(range(83)) AS i)),
dense AS (
  SELECT k.key, c.i, c.month, coalesce(m.units, 0) AS y
  FROM (SELECT DISTINCT key FROM sku_month) k CROSS JOIN cal c
  LEFT JOIN sku_month m ON m.key = k.key AND m.month = c.month)"""
)

# Test months are calendar positions 80, 81 and 82; the last training point is four before. Drift is
# the line through the first and last training point, the level a running one.
BACKTESTS = f"""lags AS (
  SELECT key, i, month, lag(y, 4) OVER w AS naive, lag(y, 12) OVER w AS seasonal,
         (lag(y, 4) OVER w + lag(y, 5) OVER w + lag(y, 6) OVER w) / 3.0 AS average,
         lag(y, 4) OVER w + (lag(y, 4) OVER w - first_value(y) OVER w) * 4 / (i - 4) AS drift
  FROM dense WINDOW w AS (PARTITION BY key ORDER BY i)),
targets AS (SELECT * FROM lags WHERE i >= 80),
runs AS (
  SELECT key, list(y ORDER BY i) AS ys FROM dense GROUP BY key),
levels AS (
  SELECT t.key, t.i, t.month,
         list_reduce(ys[1:t.i - 3], lambda level, y: y * 0.5 + level * 0.5) AS level
  FROM targets t JOIN runs USING (key)),
test_set AS (
  SELECT 'S' || key AS sku, 'naive' AS model, i, month, {rnd("naive")} AS x FROM targets
  UNION ALL SELECT 'S' || key, 'seasonal_naive', i, month, {rnd("seasonal")} FROM targets
  UNION ALL SELECT 'S' || key, 'moving_avg', i, month, {rnd("average")} FROM targets
  UNION ALL SELECT 'S' || key, 'drift', i, month, greatest({rnd("drift")}, 0) FROM targets
  UNION ALL SELECT 'S' || key, 'smoothing', i, month, {rnd("level")} FROM levels)"""


def backtest_sql(where: str) -> str:
    return f"""WITH {DENSE}, {BACKTESTS}
SELECT sku AS "SKU", model AS "Model", i - 3 AS "Origin", CAST(month AS VARCHAR) AS "Target_Month",
       strftime(month, '%b_%Y') AS "Month", x AS "Forecast"
FROM test_set {where}"""


def _partial() -> str:
    """Forecasts of models that fail, and their messages."""
    cell = lambda name, x, bad, message: f"""SELECT 'S' || key AS "SKU", '{name}' AS "Model",
       i - 3 AS "Origin", CAST(month AS VARCHAR) AS "Target_Month",
       strftime(month, '%b_%Y') AS "Month", CASE WHEN NOT {bad} THEN {rnd(x)} END AS "Forecast",
       CASE WHEN {bad} THEN 'ValueError: {message}' END AS "Error" FROM lagged WHERE i >= 80"""
    return f"""WITH {DENSE},
lagged AS (
  SELECT key, i, month, CAST(lag(y, 4) OVER w AS DOUBLE) AS y1, CAST(lag(y, 5) OVER w AS DOUBLE) AS y2,
         CAST(lag(y, 6) OVER w AS DOUBLE) AS y3,
         CAST(sum(y) OVER (w ROWS BETWEEN 15 PRECEDING AND 4 PRECEDING) AS DOUBLE) AS year_sum
  FROM dense WINDOW w AS (PARTITION BY key ORDER BY i))
{cell("ratio", "y1 * y1 / y2", "y2 = 0", "no growth from zero")}
UNION ALL {cell("batch_avg", "(y1 + y2 + y3) / 3.0", "false", "")}
UNION ALL {cell("year_share", "y1 * y1 * 12 / year_sum", "year_sum = 0", "a year without units")}"""


def _running() -> str:
    """Levels and trends month by month; the last 24 targets lie four months after their origin."""
    cell = lambda name, x: f"""SELECT 'S' || s.key AS "SKU", '{name}' AS "Model", s.i + 1 AS "Origin",
       CAST(d.month AS VARCHAR) AS "Target_Month", strftime(d.month, '%b_%Y') AS "Month",
       greatest({rnd(x)}, 0) AS "Forecast"
FROM walk s JOIN dense d ON d.key = s.key AND d.i = s.i + 4 WHERE d.i >= 59"""
    return f"""WITH RECURSIVE {DENSE},
walk AS (
  SELECT key, i, CAST(y AS DOUBLE) AS half, CAST(y AS DOUBLE) AS eighth, CAST(y AS DOUBLE) AS level,
         CAST(0 AS DOUBLE) AS trend
  FROM dense WHERE i = 0
  UNION ALL
  SELECT w.key, d.i, d.y * 0.5::DOUBLE + half * 0.5::DOUBLE, d.y * 0.125::DOUBLE + eighth * 0.875::DOUBLE,
         d.y * 0.5::DOUBLE + (level + trend) * 0.5::DOUBLE,
         (d.y * 0.5::DOUBLE + (level + trend) * 0.5::DOUBLE - level) * 0.25::DOUBLE + trend * 0.75::DOUBLE
  FROM walk w JOIN dense d ON d.key = w.key AND d.i = w.i + 1)
{cell("smoothing", "half")}
UNION ALL {cell("slow_smoothing", "eighth")}
UNION ALL {cell("trend_smoothing", "level + trend * 4")}"""


# Forecasts from the full series: positions 83..88 of the calendar.
FUTURE = """steps AS (SELECT unnest(range(1, 7)) AS h),
future AS (
  SELECT d.key, h, 'naive' AS model, d.y AS x FROM dense d, steps WHERE d.i = 82
  UNION ALL
  SELECT d.key, h, 'seasonal_naive', d.y FROM dense d JOIN steps ON d.i = 82 + h - 12
  UNION ALL
  SELECT d.key, h, 'moving_avg', x
  FROM (SELECT key, sum(y) / 3.0 AS x FROM dense WHERE i >= 80 GROUP BY key) d, steps
  UNION ALL
  SELECT b.key, h, 'drift', b.y + (b.y - a.y) * h / 82
  FROM dense a JOIN dense b ON a.key = b.key AND a.i = 0 AND b.i = 82, steps
  UNION ALL
  SELECT key, h, 'smoothing', x
  FROM (SELECT key, list_reduce(list(y ORDER BY i), lambda level, y: y * 0.5 + level * 0.5) AS x
        FROM dense GROUP BY key) d, steps)"""

ACCURACY = f"""grain AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, l_partkey AS key,
         CASE WHEN l_tax < 0.04 THEN 'GOL' WHEN l_tax < 0.07 THEN 'SOC' ELSE 'WAT' END AS division,
         sum(l_quantity) AS u, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS c
  FROM lineitem WHERE l_linestatus = 'O' AND l_returnflag = 'N' GROUP BY 1, 2, 3),
stat AS (
  SELECT month, key, CASE WHEN sum(u) <= 45 THEN sum(u) * 1.25 END AS su,
         CASE WHEN sum(u) <= 45 THEN CAST(sum(c) AS DOUBLE) * 1.25 END AS sc
  FROM grain GROUP BY 1, 2 HAVING sum(u) >= 3),
acc AS (
  SELECT g.month, 'S' || g.key AS sku, g.division, {rnd("CAST(g.c AS DOUBLE) / g.u", 2)} AS cost,
         floor(g.u * 9 / 10) AS fu, {rnd("CAST(g.c AS DOUBLE) * 0.75")} AS fc, g.u AS ou,
         {rnd("CAST(g.c AS DOUBLE)")} AS oc, coalesce({rnd("su")}, 0) AS su,
         coalesce({rnd("sc")}, 0) AS sc
  FROM grain g JOIN stat s ON s.month = g.month AND s.key = g.key
  WHERE g.division IN ('GOL', 'SOC'))"""

SCORED = f"""joined AS (
  SELECT t.sku, t.model, t.month, t.x, a.cost, a.fu, a.fc, a.ou, a.oc, a.su, a.sc
  FROM test_set t LEFT JOIN acc a ON a.sku = t.sku AND a.month = t.month
  WHERE t.sku IN (SELECT sku FROM acc)),
scored AS (
  SELECT sku, model, month, ou, oc, 'Sales' AS kind, fu AS u, fc AS c FROM joined
  UNION ALL SELECT sku, model, month, ou, oc, 'Stat', su, sc FROM joined
  UNION ALL SELECT sku, model, month, ou, oc, 'Test', x, {rnd("x * cost")} FROM joined),
totals AS (
  SELECT sku, model, kind, coalesce(sum(oc), 0) AS o, coalesce(sum(abs(oc - c)), 0) AS e
  FROM scored GROUP BY 1, 2, 3),
ranked AS (SELECT *, {pct("e", "o")} AS acc FROM totals)"""

SCORING = f"WITH {DENSE}, {BACKTESTS}, {ACCURACY}, {SCORED}"


def _summary() -> str:
    out = []
    for basis, o, f in (("Cost", "oc", "c"), ("Units", "ou", "u")):
        out.append(f"'{basis}' AS \"{basis}\"")
        for label, day in (
            ("Sep_2001", "2001-09-01"), ("Oct_2001", "2001-10-01"), ("Nov_2001", "2001-11-01"),
        ):
            when = f"FILTER (WHERE month = DATE '{day}')"
            e = f"coalesce(sum(abs({o} - {f})) {when}, 0)"
            s = f"coalesce(sum({o}) {when}, 0)"
            out.append(f'{pct(e, s)} AS "{label}_{basis.lower()}"')
        e = rnd(f"coalesce(sum(abs({o} - {f})), 0)")
        out.append(f'{rnd(f"coalesce(sum({o} - {f}), 0)")} AS "Total_Error_{basis}"')
        out.append(f'{e} AS "Total_ABS_Error_{basis}"')
        out.append(f'{pct(e, f"coalesce(sum({o}), 0)")} AS "Total_Acc_{basis}"')
    return ",\n       ".join(out)


BEST_COLUMNS = """"Sales_Acc_Cost", "Stat_Acc_Cost", "moving_avg_Test_Set_Acc_Cost",
         "naive_Test_Set_Acc_Cost", "seasonal_naive_Test_Set_Acc_Cost", "drift_Test_Set_Acc_Cost",
         "smoothing_Test_Set_Acc_Cost\""""

BACKTEST: dict[str, str] = {
    "history_long": f"""WITH {DENSE}
SELECT 'S' || key AS "SKU", CAST(month AS VARCHAR) AS "Date", y AS "History" FROM dense""",
    "history_complete": f"""WITH {DENSE}
SELECT 'S' || key AS "SKU", CAST(month AS VARCHAR) AS "Date", y AS "History" FROM dense
WHERE month BETWEEN (SELECT min(month) FROM sku_month) AND (SELECT max(month) FROM sku_month)""",
    "history_series": f"""WITH {DENSE}
SELECT 'S' || key AS "SKU", i AS pos, CAST(month AS VARCHAR) AS "Date", y AS "History"
FROM dense""",
    "backtest_naive": backtest_sql("WHERE model = 'naive'"),
    "backtest_seasonal_naive": backtest_sql("WHERE model = 'seasonal_naive'"),
    "backtest_moving_avg": backtest_sql("WHERE model = 'moving_avg'"),
    "backtest_drift": backtest_sql("WHERE model = 'drift'"),
    "backtest_smoothing": backtest_sql("WHERE model = 'smoothing'"),
    "backtest_running": _running(),
    "backtest_python": backtest_sql(""),
    "model_forecasts": f"""WITH {DENSE}, {FUTURE}
SELECT 'S' || key AS "SKU", model AS "Model", h AS "Horizon",
       CAST(CAST(DATE '2001-11-01' + to_months(CAST(h AS INTEGER)) AS DATE) AS VARCHAR)
         AS "Target_Month",
       x AS "Forecast"
FROM future""",
    "forecast_export_wide": f"""WITH {DENSE}, {FUTURE}
SELECT 'S' || key AS "Item Number", 'Custom Stat' AS "Series / Time",
       {", ".join(
           f'CAST(max(CASE WHEN h = {h} THEN {rnd("x")} END) AS INTEGER) AS "{head}"'
           for h, head in enumerate(
               ("12/1/2001", "1/1/2002", "2/1/2002", "3/1/2002", "4/1/2002", "5/1/2002"), 1
           )
       )}
FROM future WHERE model = 'moving_avg' GROUP BY key""",
    "accuracy_base": f"""WITH {ACCURACY}
SELECT year(month) AS "Year", upper(strftime(month, '%B')) AS "Month",
       strftime(month, '%b_%Y') AS "Month_Year", 'USA' AS "Country", sku AS "SKU", cost AS "Cost",
       division AS "Division", 'CUST N' AS "Customer", fu AS "Adj_FC_Units", fc AS "Adj_FC_Cost",
       ou AS "Adj_Orders_Units", oc AS "Adj_Orders_Cost", su AS "Stat_FC_Units",
       sc AS "Stat_FC_Cost"
FROM acc""",
    "scoring_rows": f"""{SCORING}
SELECT sku AS "SKU", model AS "Model", strftime(month, '%b_%Y') AS "Month_Year",
       ou AS "Adj_Orders_Units", oc AS "Adj_Orders_Cost", kind AS "Kind", u AS "Fcst_Units",
       c AS "Fcst_Cost", ou - u AS "Error_Units", abs(ou - u) AS "ABS_Error_Units",
       {pct("abs(ou - u)", "ou")} AS "Acc_Units", oc - c AS "Error_Cost",
       abs(oc - c) AS "ABS_Error_Cost", {pct("abs(oc - c)", "oc")} AS "Acc_Cost"
FROM scored""",
    "scoring_sku_totals": f"""{SCORING}
SELECT sku AS "SKU", model AS "Model", kind AS "Kind", o AS "Total_Adj_Orders_Cost",
       e AS "Total_ABS_Error_Cost", acc AS "Total_Acc_Cost"
FROM ranked""",
    "scoring_model_summary": f"""{SCORING},
named AS (
  SELECT CASE kind WHEN 'Sales' THEN 'Sales_Forecast' WHEN 'Stat' THEN 'Stat_Forecast'
                   ELSE model || '_Test_Set' END AS name, *
  FROM scored)
SELECT DISTINCT name AS "Model",
       {_summary()}
FROM named GROUP BY name, model""",
    "best_model_per_sku": f"""{SCORING},
wide AS (
  SELECT sku AS "SKU",
         max(acc) FILTER (WHERE model = 'naive' AND kind = 'Stat') AS "Stat_Acc_Cost",
         max(acc) FILTER (WHERE model = 'naive' AND kind = 'Sales') AS "Sales_Acc_Cost",
         max(acc) FILTER (WHERE model = 'naive' AND kind = 'Test') AS "naive_Test_Set_Acc_Cost",
         max(acc) FILTER (WHERE model = 'seasonal_naive' AND kind = 'Test')
           AS "seasonal_naive_Test_Set_Acc_Cost",
         max(acc) FILTER (WHERE model = 'moving_avg' AND kind = 'Test')
           AS "moving_avg_Test_Set_Acc_Cost",
         max(acc) FILTER (WHERE model = 'drift' AND kind = 'Test') AS "drift_Test_Set_Acc_Cost",
         max(acc) FILTER (WHERE model = 'smoothing' AND kind = 'Test')
           AS "smoothing_Test_Set_Acc_Cost"
  FROM ranked GROUP BY sku),
long AS (SELECT "SKU", n, a FROM wide UNPIVOT INCLUDE NULLS (a FOR n IN ({BEST_COLUMNS}))),
best AS (
  SELECT "SKU", CASE WHEN count(a) = count(*) THEN arg_max(n, (a, -pos)) END AS b
  FROM (SELECT *, row_number() OVER (PARTITION BY "SKU" ORDER BY n) AS pos FROM long)
  GROUP BY "SKU")
SELECT wide.*, b AS "Best_Model" FROM wide JOIN best USING ("SKU")""",
    "excluded_skus": f"""WITH {DENSE}, {ACCURACY}
SELECT DISTINCT 'S' || key AS "SKU" FROM dense WHERE 'S' || key NOT IN (SELECT sku FROM acc)""",
    "sku_detail_nested": f"""{SCORING}
SELECT sku AS "SKU", model AS "Model", strftime(month, '%b_%Y') AS "Month_Year", kind AS "Kind",
       count(*) AS n_rows, coalesce(sum(abs(oc - c)), 0) AS abs_error_cost
FROM scored GROUP BY 1, 2, 3, 4""",
}

BACKTEST["backtest_failing_models"] = _partial()
BACKTEST["scoring_run"] = f"""{SCORING}
SELECT 'detail' AS result, model AS name, count(*) AS n, CAST(NULL AS DOUBLE) AS acc
FROM scored GROUP BY model
UNION ALL SELECT 'summary', "Model", count(*), max("Total_Acc_Cost")
FROM ({BACKTEST["scoring_model_summary"]}) GROUP BY "Model"
UNION ALL SELECT 'best', "Best_Model", count(*), NULL
FROM ({BACKTEST["best_model_per_sku"]}) GROUP BY "Best_Model"
UNION ALL SELECT 'excluded', 'all', count(*), NULL FROM ({BACKTEST["excluded_skus"]})"""
BACKTEST["model_forecasts_native"] = BACKTEST["model_forecasts"]
MONTH_END["snapshot_export"] = MONTH_END["forecast_snapshot"]
MONTH_END["snapshot_rewritten"] = MONTH_END["forecast_snapshot"]
FILES = {
    "ingest_reports_two_runs": _reports()["clean_report_reviews"],
    "ingest_late_and_changed": _reports()["clean_report_reviews"],
    "pos_by_segment_stored": POS["pos_by_segment"],
    "pos_kpis_merged": POS["pos_kpis"],
    "pos_trend_merged": POS["pos_trend_long"],
    "pos_by_segment_merged": POS["pos_by_segment"],
    "canonical_customer_stored": HARMONISED["canonical_customer"],
    "append_new_partitions": CLEAN["append_unique"],
    "ingest_weekly_day_by_day": WEEK["weekly_to_monthly"],
    "ingest_weekly_backlog": WEEK["weekly_to_monthly"],
}

ORACLES: dict[str, str] = {
    **POS, **CLEAN, **_reports(), **WEEK, **MONTH_END, **HARMONISED, **BACKTEST, **FILES,
}
