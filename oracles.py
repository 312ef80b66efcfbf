"""DuckDB forms of the registered queries, used only to check them."""

from __future__ import annotations

import re

from quayside.plans import texts

TRADES = """
lines AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS trade_date, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
         CASE WHEN l_linestatus = 'O' THEN 'exp' ELSE 'imp' END AS flag,
         CAST(l_extendedprice AS DECIMAL(20,2)) AS fob, CAST(l_quantity AS DECIMAL(20,2)) AS kg,
         CAST(o_custkey AS VARCHAR) AS city_id, c_name || ' - ' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS city_uf,
         cn.n_name AS state_name, r_name AS region,
         CAST(s_nationkey AS VARCHAR) AS country_id, sn.n_name AS country_name, p_type AS product_category_name
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey
  LEFT JOIN region ON cn.n_regionkey = r_regionkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey
  LEFT JOIN part ON l_partkey = p_partkey),
idx AS (
  SELECT trade_date AS cpi_date, CAST(100 + 0.25 * (12 * (year(trade_date) - 1995) + month(trade_date) - 1) AS DECIMAL(20,2)) AS cpi
  FROM (SELECT CAST(unnest(generate_series((SELECT date_trunc('month', min(l_shipdate)) FROM lineitem), (SELECT date_trunc('month', max(l_shipdate)) FROM lineitem), INTERVAL 1 MONTH)) AS DATE) AS trade_date) WHERE trade_date NOT IN (DATE '1996-03-01', DATE '1999-08-01')),
latest AS (SELECT cpi AS latest FROM idx ORDER BY cpi_date DESC LIMIT 1),
ratios AS (
  SELECT cpi_date, CAST(CAST((CAST(latest * 10000 AS BIGINT) * 2 + CAST(cpi * 100 AS BIGINT)) // (2 * CAST(cpi * 100 AS BIGINT))
         AS DECIMAL(20,2)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(20,2)) AS ratio FROM idx, latest),
trades AS (
  SELECT lines.*, CAST(fob * ratio AS DECIMAL(38,4)) AS fob_real FROM lines LEFT JOIN ratios ON trade_date = cpi_date)
"""

EXP = "sum(fob) FILTER (WHERE flag = 'exp')"
IMP = "sum(fob) FILTER (WHERE flag = 'imp')"
EXP_KG = "sum(kg) FILTER (WHERE flag = 'exp')"
IMP_KG = "sum(kg) FILTER (WHERE flag = 'imp')"
EXP_REAL = "sum(fob_real) FILTER (WHERE flag = 'exp')"
IMP_REAL = "sum(fob_real) FILTER (WHERE flag = 'imp')"


def plus(a: str, b: str) -> str:
    return f"coalesce(({a}) + ({b}), {a}, {b})"


def minus(a: str, b: str) -> str:
    return f"coalesce(({a}) - ({b}), {a}, -({b}))"


def div(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)"


def r6(a: str) -> str:
    return f"round(CAST({a} AS DOUBLE), 6)"


MEASURES = {
    "exports": EXP,
    "imports": IMP,
    "export_weight": EXP_KG,
    "import_weight": IMP_KG,
    "exports_real": EXP_REAL,
    "imports_real": IMP_REAL,
    "total_value": "sum(fob)",
    "flow": plus(EXP, IMP),
    "balance": minus(EXP, IMP),
    "balance_real": minus(EXP_REAL, IMP_REAL),
    "export_price": r6(div(EXP, EXP_KG)),
    "import_price": r6(div(IMP, IMP_KG)),
    "coverage": r6(div(EXP, IMP)),
}


def trades_query(body: str, ctes: str = "") -> str:
    return f"WITH {TRADES}{', ' + ctes if ctes else ''}\n{body}"


def grouped(by: str, measures: list[str], where: str = "", having: str = "") -> str:
    picked = ", ".join(f"{MEASURES[m]} AS {m}" for m in measures)
    keys = f"{by}, " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    where = f" WHERE {where}" if where else ""
    having = f" HAVING {having}" if having else ""
    return trades_query(f"SELECT {keys}{picked} FROM trades{where}{tail}{having}")


def top_n(by: str, measure: str, n: int, order: str = "DESC", where: str = "") -> str:
    where = f" WHERE {where}" if where else ""
    return trades_query(
        f"SELECT {by}, {measure} FROM (SELECT *, rank() OVER (ORDER BY {measure} {order}) AS rk FROM g WHERE {measure} IS NOT NULL) "
        f"WHERE rk <= {n}",
        f"g AS (SELECT {by}, {MEASURES[measure]} AS {measure} FROM trades{where} GROUP BY {by})",
    )


def shares_others(member: str, measure: str, n: int, squared: bool) -> str:
    value = "share * share" if squared else "share"
    out = "squared_share" if squared else "share"
    return trades_query(
        f"SELECT CASE WHEN rk <= {n} THEN {member} ELSE 'Outros' END AS {member}, {r6(f'sum({value})')} AS {out} FROM "
        f"(SELECT *, rank() OVER (ORDER BY share DESC NULLS LAST) AS rk FROM s) GROUP BY 1",
        f"g AS (SELECT {member}, {MEASURES[measure]} AS v FROM trades GROUP BY {member}), "
        f"s AS (SELECT {member}, {div('v', '(SELECT sum(v) FROM g)')} AS share FROM g)",
    )


YOY_SUMS = "sum(e) AS e, sum(i) AS i, sum(we) AS we, sum(wi) AS wi"


def year_over_year(by: str) -> str:
    """Month totals joined to themselves one year back, then grouped."""
    period = "CAST(year(trade_date) AS INTEGER)" if by == "year" else "trade_date"
    fields = []
    for m, f in (
        ("exports", lambda p: f"{p}e"),
        ("imports", lambda p: f"{p}i"),
        ("flow", lambda p: plus(f"{p}e", f"{p}i")),
        ("balance", lambda p: minus(f"{p}e", f"{p}i")),
        ("export_price", lambda p: r6(div(f"{p}e", f"{p}we"))),
        ("coverage", lambda p: r6(div(f"{p}e", f"{p}i"))),
    ):
        fields += [f"{f('n.')} AS {m}", f"{f('l.')} AS {m}_ly"]
    price = lambda p: div(f"{p}e", f"{p}we")
    cover = lambda p: div(f"{p}e", f"{p}i")
    flow = lambda p: plus(f"{p}e", f"{p}i")
    bal = lambda p: minus(f"{p}e", f"{p}i")
    fields += [
        f"{r6(div(minus('n.e', 'l.e'), 'l.e'))} AS exports_yoy",
        f"{r6(div(minus('n.i', 'l.i'), 'l.i'))} AS imports_yoy",
        f"{r6(div(minus(flow('n.'), flow('l.')), flow('l.')))} AS flow_yoy",
        f"{r6(div(minus(price('n.'), price('l.')), price('l.')))} AS export_price_yoy",
        f"{minus(bal('n.'), bal('l.'))} AS balance_yoy",
        f"{r6(minus(cover('n.'), cover('l.')))} AS coverage_yoy",
    ]
    return trades_query(
        f"SELECT p AS {by}, {', '.join(fields)} FROM n FULL JOIN l USING (p)",
        f"m AS (SELECT trade_date, {EXP} AS e, {IMP} AS i, {EXP_KG} AS we, {IMP_KG} AS wi FROM trades GROUP BY trade_date), "
        f"n AS (SELECT {period} AS p, {YOY_SUMS} FROM m GROUP BY 1), "
        f"l AS (SELECT {period} AS p, {YOY_SUMS} FROM (SELECT CAST(trade_date + INTERVAL 1 YEAR AS DATE) AS trade_date, e, i, we, wi FROM m) "
        f"WHERE year(trade_date) <= (SELECT max(year) FROM trades) GROUP BY 1)",
    )


def cards(member: str, measures: list[str]) -> str:
    parts = [
        f"SELECT '{m}' AS measure, string_agg({member}, '' ORDER BY {member}) AS {member}, max(v) AS value FROM "
        f"(SELECT {member}, CAST({MEASURES[m]} AS DOUBLE) AS v FROM trades GROUP BY {member} QUALIFY rank() OVER (ORDER BY v DESC) = 1)"
        for m in measures
    ]
    return trades_query(" UNION ALL ".join(parts))


def report_sql() -> dict[str, str]:
    sql = {
        "monthly_trade_balance": grouped("trade_date", ["exports", "imports", "flow", "balance"]),
        "monthly_weights_and_prices": grouped(
            "trade_date", ["export_weight", "import_weight", "export_price", "import_price", "coverage"]
        ),
        "monthly_real_balance": grouped("trade_date", ["balance", "exports_real", "imports_real", "balance_real"]),
        "all_measures_total": grouped("", list(MEASURES)),
        "measure_totals_cube": trades_query(
            f"SELECT CAST(grouping(year, region) AS INTEGER) AS level, year, region, {EXP} AS exports, {MEASURES['balance']} AS balance, "
            f"{MEASURES['coverage']} AS coverage FROM trades GROUP BY CUBE (year, region)"
        ),
        "country_share_of_total": trades_query(
            f"SELECT country_name, {r6(div('e', '(SELECT sum(e) FROM g)'))} AS export_share, "
            f"{r6(div('i', '(SELECT sum(i) FROM g)'))} AS import_share FROM g",
            f"g AS (SELECT country_name, {EXP} AS e, {IMP} AS i FROM trades GROUP BY country_name)",
        ),
        "country_share_by_year": trades_query(
            f"SELECT year, country_name, v AS total_value, {r6(div('v', 'sum(v) OVER (PARTITION BY year)'))} AS share FROM g",
            "g AS (SELECT year, country_name, sum(fob) AS v FROM trades GROUP BY year, country_name)",
        ),
        "concentration_by_year": trades_query(
            "SELECT year, round(h, 6) AS hhi, CASE WHEN h <= 0.15 THEN 'low' WHEN h <= 0.25 THEN 'medium' ELSE 'high' END AS band FROM "
            "(SELECT year, sum(s * s) AS h FROM (SELECT year, CAST(v AS DOUBLE) / CAST(sum(v) OVER (PARTITION BY year) AS DOUBLE) AS s FROM g) GROUP BY year)",
            "g AS (SELECT year, country_name, sum(fob) AS v FROM trades GROUP BY year, country_name)",
        ),
        "state_concentration_of_total": trades_query(
            f"SELECT region, {r6('sum(s * s)')} AS hhi FROM (SELECT region, {div('e', '(SELECT sum(e) FROM g)')} AS s FROM g) GROUP BY region",
            f"g AS (SELECT region, state_name, {EXP} AS e FROM trades GROUP BY region, state_name)",
        ),
        "state_import_concentration_of_total": trades_query(
            f"SELECT region, {r6('sum(s * s)')} AS hhi FROM (SELECT region, {div('i', '(SELECT sum(i) FROM g)')} AS s FROM g) GROUP BY region",
            f"g AS (SELECT region, state_name, {IMP} AS i FROM trades GROUP BY region, state_name)",
        ),
        "concentration_gauge": trades_query(
            "SELECT round(h, 6) AS hhi, CASE WHEN h <= 0.15 THEN 'low' WHEN h <= 0.25 THEN 'medium' ELSE 'high' END AS band, "
            "CAST(0.15 AS DOUBLE) AS low_width, CAST(0.1 AS DOUBLE) AS medium_width, CAST(0.75 AS DOUBLE) AS high_width FROM "
            "(SELECT sum(s * s) AS h FROM (SELECT CAST(v AS DOUBLE) / CAST(sum(v) OVER () AS DOUBLE) AS s FROM g))",
            "g AS (SELECT country_name, sum(fob) AS v FROM trades GROUP BY country_name)",
        ),
        "exports_by_month_label": trades_query(
            f"SELECT year * 100 + month AS month_number, left({_case('month', PT_MONTHS)}, 3) || '/' || lpad(CAST(year % 100 AS VARCHAR), 2, '0') AS month_name, {EXP} AS exports FROM trades GROUP BY 1, 2"
        ),
        "year_over_year_by_month": year_over_year("trade_date"),
        "year_over_year_by_year": year_over_year("year"),
        "running_totals_by_year": trades_query(
            "SELECT year, CAST(sum(e) OVER w AS DECIMAL(38,2)) AS exports_acc, CAST(sum(i) OVER w AS DECIMAL(38,2)) AS imports_acc FROM g WINDOW w AS (ORDER BY year)",
            f"g AS (SELECT year, {EXP} AS e, {IMP} AS i FROM trades GROUP BY year)",
        ),
        "running_totals_by_country_month": trades_query(
            "SELECT country_name, trade_date, exports_acc, imports_acc FROM (SELECT country_name, trade_date, "
            "CAST(sum(e) OVER w AS DECIMAL(38,2)) AS exports_acc, CAST(sum(i) OVER w AS DECIMAL(38,2)) AS imports_acc, count(f) OVER w AS seen "
            "FROM (SELECT c.country_name, c.trade_date, e, i, g.trade_date AS f FROM c LEFT JOIN g ON c.country_name = g.country_name AND c.trade_date = g.trade_date) "
            "WINDOW w AS (PARTITION BY country_name ORDER BY trade_date)) WHERE seen > 0",
            f"g AS (SELECT country_name, trade_date, {EXP} AS e, {IMP} AS i FROM trades GROUP BY ALL), "
            "days AS (SELECT CAST(unnest(generate_series(min(trade_date), make_date(max(year), 12, 1), INTERVAL 1 MONTH)) AS DATE) AS trade_date FROM trades), "
            "c AS (SELECT country_name, trade_date FROM (SELECT DISTINCT country_name FROM trades), days)",
        ),
        "top_cities_by_exports": top_n("city_uf", "exports", 10),
        "top_cities_by_imports": top_n("city_uf", "imports", 10),
        "top_states_by_exports": top_n("state_name", "exports", 10),
        "top_countries_and_others": shares_others("country_name", "exports", 10, False),
        "top_states_squared_export_share": shares_others("state_name", "exports", 10, True),
        "top_states_squared_import_share": shares_others("state_name", "imports", 10, True),
        "partner_tornado": trades_query(
            f"SELECT country_name, flow, {r6(div('e', '(SELECT sum(e) FROM g)'))} AS export_share, {r6(div('i', '(SELECT sum(i) FROM g)'))} AS import_share, "
            f"{r6('-' + div('i', '(SELECT sum(i) FROM g)'))} AS import_share_left FROM (SELECT *, rank() OVER (ORDER BY flow DESC) AS rk FROM g) WHERE rk <= 10",
            f"g AS (SELECT country_name, {EXP} AS e, {IMP} AS i, {MEASURES['flow']} AS flow FROM trades GROUP BY country_name)",
        ),
        "ranking_countries_by_exports": trades_query(
            f"SELECT country_name, {EXP} AS exports, CAST(dense_rank() OVER (ORDER BY {EXP} DESC) AS INTEGER) AS ranking FROM trades GROUP BY country_name"
        ),
        "ranking_states_by_exports": trades_query(
            f"SELECT state_name, {EXP} AS exports, CAST(dense_rank() OVER (ORDER BY {EXP} DESC) AS INTEGER) AS ranking FROM trades GROUP BY state_name"
        ),
        "ranking_states_by_imports": trades_query(
            f"SELECT state_name, {IMP} AS imports, CAST(dense_rank() OVER (ORDER BY {IMP} DESC) AS INTEGER) AS ranking FROM trades GROUP BY state_name"
        ),
        "balance_matrix": trades_query(
            "SELECT year, " + ", ".join(f"max(b) FILTER (WHERE month = {m}) AS m{m:02d}" for m in range(1, 13)) + " FROM g WHERE year <> 2001 GROUP BY year",
            f"g AS (SELECT year, month, {MEASURES['balance']} AS b FROM trades GROUP BY year, month)",
        ),
        "category_exports": grouped("product_category_name", ["exports"]),
        "category_exports_by_year": grouped("year, product_category_name", ["exports"]),
        "category_imports_by_year": grouped("year, product_category_name", ["imports"]),
        "category_export_price": grouped("product_category_name", ["export_price"]),
        "category_import_price": grouped("product_category_name", ["import_price"]),
        "yearly_export_price": grouped("year", ["export_price"]),
        "yearly_import_price": grouped("year", ["import_price"]),
        "partners_by_month": trades_query(
            "SELECT trade_date, count(DISTINCT country_id) FILTER (WHERE flag = 'exp') AS exports_members, "
            "count(DISTINCT country_id) FILTER (WHERE flag = 'imp') AS imports_members FROM trades GROUP BY trade_date"
        ),
        "active_cities_by_state": trades_query(
            "SELECT state_name, count(DISTINCT city_id) FILTER (WHERE flag = 'exp') AS exports_members, "
            "count(DISTINCT city_id) FILTER (WHERE flag = 'imp') AS imports_members FROM trades GROUP BY state_name"
        ),
        "state_exports_map": grouped("state_name", ["exports"]),
        "state_imports_map": grouped("state_name", ["imports", "exports"]),
        "category_cards": cards("product_category_name", ["exports", "export_price", "imports", "import_price"]),
        "partner_cards": cards("country_name", ["exports", "imports"]),
        "state_cards": cards("state_name", ["exports", "imports"]),
        "data_span": trades_query("SELECT min(trade_date) AS first_month, max(trade_date) AS last_month FROM trades"),
        "lowest_balance_month": trades_query(
            "SELECT trade_date, balance FROM g WHERE balance = (SELECT min(balance) FROM g)",
            f"g AS (SELECT trade_date, {MEASURES['balance']} AS balance FROM trades GROUP BY trade_date)",
        ),
        "top_category_by_year": trades_query(
            "SELECT year, string_agg(product_category_name, '' ORDER BY product_category_name) AS product_category_name, max(exports) AS exports "
            "FROM (SELECT *, rank() OVER (PARTITION BY year ORDER BY exports DESC) AS rk FROM g) WHERE rk = 1 GROUP BY year",
            f"g AS (SELECT year, product_category_name, {EXP} AS exports FROM trades GROUP BY ALL)",
        ),
        "measure_picker_by_month": trades_query(
            "SELECT trade_date, 'exports' AS measure, e AS value FROM g UNION ALL SELECT trade_date, 'imports', i FROM g",
            f"g AS (SELECT trade_date, {EXP} AS e, {IMP} AS i FROM trades GROUP BY trade_date)",
        ),
        "sliced_category_exports": grouped(
            "product_category_name", ["exports"], where="year IN (1997, 1998) AND region IN ('ASIA', 'EUROPE')"
        ),
        "sliced_country_months": grouped("trade_date", ["exports", "imports"], where="country_id IN ('3', '9')"),
        "sliced_city_years": grouped(
            "year, region", ["exports"], where="city_id IN ('7', '11', '100') AND country_name IN ('NATION_9', 'NATION_3')", having=f"{EXP} IS NOT NULL"
        ),
        "sliced_export_share": trades_query(
            f"SELECT state_name, {EXP} AS exports, {r6(div(EXP, f'(SELECT {EXP} FROM trades)'))} AS share FROM trades "
            "WHERE trade_date BETWEEN DATE '1997-03-01' AND DATE '1999-06-01' GROUP BY state_name"
        ),
        "sliced_top_states": top_n("state_name", "exports", 5, where="product_category_name IN ('SMALL', 'PROMO')"),
        "sliced_flag_concentration": trades_query(
            "SELECT year, round(sum(s * s), 6) AS hhi FROM (SELECT year, CAST(v AS DOUBLE) / CAST(sum(v) OVER (PARTITION BY year) AS DOUBLE) AS s FROM g) GROUP BY year",
            "g AS (SELECT year, country_name, sum(fob) AS v FROM trades WHERE flag = 'imp' GROUP BY year, country_name)",
        ),
        "countries_above_floor": grouped("country_name", ["exports"], having=f"{EXP} > 50000000"),
        "countries_outside_top": trades_query(
            "SELECT country_name FROM (SELECT country_name, rank() OVER (ORDER BY e DESC) AS rk FROM g) WHERE rk > 10",
            f"g AS (SELECT country_name, {EXP} AS e FROM trades GROUP BY country_name)",
        ),
        "state_list_with_others": "SELECT DISTINCT n_name AS state_name FROM customer JOIN nation ON c_nationkey = n_nationkey UNION ALL SELECT 'Outros'",
        "category_lead_streak": trades_query(
            "SELECT product_category_name, CAST(last - coalesce(other, first - 1) AS INTEGER) AS periods_in_lead FROM (SELECT "
            "max_by(product_category_name, year) AS product_category_name, max(year) AS last, min(year) AS first, "
            "(SELECT max(year) FROM t WHERE product_category_name <> (SELECT max_by(product_category_name, year) FROM t)) AS other FROM t)",
            f"g AS (SELECT year, product_category_name, {EXP} AS exports FROM trades GROUP BY ALL), "
            "t AS (SELECT * FROM g QUALIFY rank() OVER (PARTITION BY year ORDER BY exports DESC) = 1)",
        ),
    }
    return sql



def letters(number: str, width: int) -> str:
    return f"translate(lpad(CAST({number} AS VARCHAR), {width}, '0'), '0123456789', 'abcdefghij')"


def normal(text: str) -> str:
    return f"regexp_replace(replace(replace(replace(lower(strip_accents({text})), 'ß', 'ss'), 'æ', 'ae'), 'œ', 'oe'), '[^a-z]', '', 'g')"


FIRST, SECOND, RUN = (f"TIMESTAMP '2024-0{m}-01 00:00:00'" for m in (1, 2, 3))
SPELLED = letters("c_custkey", 9)
CITY_NAME = f"'Cidáde ' || upper({SPELLED}[1]) || substr({SPELLED}, 2)"
COUNTRY_SPELLED = letters("s_nationkey", 2)

BRONZE = f"""
grain AS (
  SELECT o_custkey AS ck, c_nationkey AS cn, trade_date, flag, s_nationkey AS nk, p_type AS hc,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(20,2))) AS DECIMAL(38,2)) AS fob, CAST(sum(CAST(l_quantity AS DECIMAL(20,2))) AS DECIMAL(38,2)) AS kg
  FROM (SELECT *, CAST(date_trunc('month', l_shipdate) AS DATE) AS trade_date, CASE WHEN l_linestatus = 'O' THEN 'exp' ELSE 'imp' END AS flag FROM lineitem)
  JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
  GROUP BY ALL),
bronze AS (
  SELECT flag, CASE WHEN ck % 97 = 0 THEN NULL WHEN ck % 89 = 0 THEN 'Sem Cadastro' ELSE 'CIDADE ' || upper({letters('ck', 9)}) || ' - ' || upper({letters('cn', 2)}) END AS city,
         trade_date, 'NACAO ' || upper({letters('nk', 2)}) AS country, CASE WHEN ck % 83 <> 0 THEN hc END AS hc,
         CASE WHEN copy = 2 AND ck % 70 = 0 THEN '0' WHEN copy = 2 THEN CAST(CAST(fob + 1 AS DECIMAL(38,2)) AS VARCHAR) WHEN ck % 79 <> 0 THEN CAST(fob AS VARCHAR) END AS fob,
         CAST(kg AS VARCHAR) AS kg, CASE WHEN copy = 2 THEN {SECOND} ELSE {FIRST} END AS stamp
  FROM grain, (VALUES (1), (2)) v(copy) WHERE copy = 1 OR ck % 10 = 0),
newest AS (
  SELECT * FROM bronze QUALIFY row_number() OVER (PARTITION BY flag, city, trade_date, country, hc ORDER BY stamp DESC, fob DESC NULLS LAST, kg DESC NULLS LAST) = 1),
city_names AS (SELECT CAST(c_custkey AS VARCHAR) AS id, {normal(CITY_NAME + " || ' - ' || upper(" + letters('c_nationkey', 2) + ") || ' '")} AS n FROM customer),
country_names AS (SELECT DISTINCT CAST(s_nationkey AS VARCHAR) AS id, {normal("'Nação ' || " + COUNTRY_SPELLED)} AS n FROM supplier),
silver AS (
  SELECT trade_date, coalesce(c.id, 'N/A') AS city_id, left(coalesce(p.id, 'N/A'), 4) AS trade_country_id, coalesce(hc, '0000') AS product_category_id,
         CAST(fob AS DECIMAL(20,2)) AS fob_value, CAST(kg AS DECIMAL(20,2)) AS net_weight, flag AS trade_flag, stamp AS ingested_at, stamp AS loaded_at, {RUN} AS processed_at
  FROM newest LEFT JOIN city_names c ON {normal('city')} = c.n LEFT JOIN country_names p ON {normal('country')} = p.n
  WHERE CAST(coalesce(fob, '0') AS DECIMAL(20,2)) > 0 AND CAST(coalesce(kg, '0') AS DECIMAL(20,2)) > 0)
"""
CITIES = f"""
cities AS (
  SELECT CAST(c_custkey AS VARCHAR) AS city_id, {CITY_NAME} AS city_name, n_name AS state_name, upper({letters('c_nationkey', 2)}) AS uf,
         {CITY_NAME} || ' - ' || upper({letters('c_nationkey', 2)}) || ' ' AS city_uf, CASE WHEN r_regionkey < 4 THEN r_name ELSE 'Não se aplica' END AS region,
         {SECOND} AS ingested_at, {SECOND} AS loaded_at, {RUN} AS processed_at
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)
"""
COUNTRIES = f"""
countries AS (
  SELECT DISTINCT CAST(s_nationkey AS VARCHAR) AS country_id, 'Nação ' || upper({COUNTRY_SPELLED}[1]) || substr({COUNTRY_SPELLED}, 2) AS country_name,
         {SECOND} AS ingested_at, {SECOND} AS loaded_at, {RUN} AS processed_at FROM supplier)
"""
PRODUCTS = """
products AS (SELECT DISTINCT p_type AS product_category_id, p_type AS product_category_name, 'Parts of type ' || lower(p_type) AS product_category_description FROM part)
"""
SUMMED = """
summed AS (
  SELECT trade_date, city_id, trade_country_id, product_category_id, CAST(sum(fob_value) AS DECIMAL(20,2)) AS fob_value, CAST(sum(net_weight) AS DECIMAL(20,2)) AS net_weight, trade_flag
  FROM silver GROUP BY ALL)
"""
FACT = f"""
fact AS (
  SELECT trade_date, city_id, trade_country_id, product_category_id, fob_value, CAST(fob_value * ratio AS DECIMAL(38,4)) AS fob_value_real, net_weight, trade_flag, {RUN} AS created_at
  FROM silver LEFT JOIN ratios ON trade_date = cpi_date)
"""


SERIES = "(SELECT CAST(unnest(generate_series((SELECT date_trunc('month', min(l_shipdate)) FROM lineitem), (SELECT date_trunc('month', max(l_shipdate)) FROM lineitem), INTERVAL 1 MONTH)) AS DATE) AS trade_date)"


def indices(source: str = SERIES) -> str:
    """The index CTEs over another relation holding one row per month in trade_date."""
    return TRADES[TRADES.index("idx AS") : TRADES.index("trades AS")].strip().rstrip(",").replace(f"FROM {SERIES}", f"FROM {source}")


def nulls(table: str, label: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS table_name, 'not_null' AS test, '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures FROM {table}"
        for c in columns
    )


def uniques(table: str, label: str, columns: list[str]) -> str:
    keys = ", ".join(columns)
    known = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    return (
        f"SELECT '{label}', 'unique', '{keys}', CAST(count(*) AS BIGINT) FROM "
        f"(SELECT {keys} FROM {table} WHERE {known} GROUP BY {keys} HAVING count(*) > 1)"
    )


def orphans(table: str, label: str, column: str, parent: str, key: str) -> str:
    return (
        f"SELECT '{label}', 'relationships', '{column}', CAST(count(*) AS BIGINT) FROM {table} c "
        f"WHERE c.{column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{column})"
    )


SILVER_COLUMNS = "trade_date city_id trade_country_id product_category_id fob_value net_weight trade_flag ingested_at loaded_at processed_at".split()
CITY_COLUMNS = "city_id city_name state_name uf city_uf region ingested_at loaded_at processed_at".split()
FACT_KEY = "trade_date city_id trade_country_id product_category_id trade_flag".split()


def pipeline_sql() -> dict[str, str]:
    side = lambda f: f"(SELECT * FROM silver WHERE trade_flag = '{f}')"
    silver_cpi = f"idx2 AS (SELECT cpi_date, cpi AS cpi_value, {FIRST} AS ingested_at, {FIRST} AS loaded_at, {RUN} AS processed_at FROM idx)"
    dates = "lines AS (SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS trade_date FROM lineitem)"
    grain = (
        "SELECT trade_date, CAST(ck AS VARCHAR) AS city_id, CAST(nk AS VARCHAR) AS trade_country_id, hc AS product_category_id, flag AS trade_flag, "
        "CAST(fob AS DECIMAL(20,2)) AS fob_value, CAST(kg AS DECIMAL(20,2)) AS net_weight FROM grain"
    )
    files = (
        "files AS (SELECT flow, min(trade_date) AS date_from, max(trade_date) AS date_to, 'trade_' || flow || '_' || strftime(min(trade_date), '%Y%m') || '_' "
        "|| strftime(max(trade_date), '%Y%m') || '.parquet' AS path FROM (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS trade_date, "
        "CASE WHEN l_linestatus = 'O' THEN 'export' ELSE 'import' END AS flow FROM lineitem) GROUP BY flow, year(trade_date))"
    )
    plan = (
        "o AS (SELECT o_orderpriority AS flow, CAST(date_trunc('month', o_orderdate) AS DATE) AS d FROM orders), "
        "last AS (SELECT flow, max(d) AS last_date, max(d) FILTER (WHERE flow = '1-URGENT' OR (flow = '2-HIGH' AND d < DATE '1997-01-01') "
        "OR (flow = '3-MEDIUM' AND d < DATE '1998-04-01')) AS mark FROM o GROUP BY flow), "
        "plan AS (SELECT flow, CASE WHEN mark IS NULL THEN 'first' WHEN last_date > mark THEN 'next' ELSE 'skip' END AS action, "
        "CASE WHEN mark IS NULL THEN DATE '1993-01-01' WHEN last_date > mark THEN CAST(mark + INTERVAL 1 MONTH AS DATE) END AS date_from, "
        "CASE WHEN mark IS NULL OR last_date > mark THEN last_date END AS date_to FROM last)"
    )
    upsert = (
        "SELECT c_custkey, c_name, c_nationkey, CAST(CAST(c_acctbal AS DECIMAL(20,2)) + CASE WHEN c_mktsegment = 'BUILDING' THEN 100 ELSE 0 END AS DECIMAL(20,2)) AS c_acctbal, "
        "c_mktsegment, CASE WHEN c_mktsegment = 'BUILDING' THEN 'raised' END AS note FROM customer UNION ALL "
        "SELECT -c_custkey - 1, c_name, c_nationkey, CAST(CAST(c_acctbal AS DECIMAL(20,2)) + 100 AS DECIMAL(20,2)), c_mktsegment, 'raised' FROM customer WHERE c_mktsegment = 'BUILDING'"
    )
    gold_tests = " UNION ALL ".join(
        [
            nulls("fact", "fact_trades", [c for c in "trade_date city_id trade_country_id product_category_id fob_value net_weight trade_flag created_at".split()]),
            uniques("fact", "fact_trades", FACT_KEY),
            orphans("fact", "fact_trades", "city_id", "(SELECT city_id FROM cities UNION ALL SELECT 'N/A')", "city_id"),
            orphans("fact", "fact_trades", "trade_country_id", "(SELECT country_id FROM countries UNION ALL SELECT 'N/A')", "country_id"),
            orphans("fact", "fact_trades", "product_category_id", "products", "product_category_id"),
            nulls(f"(SELECT city_id, city_name, state_name, uf, city_uf, region, processed_at AS created_at FROM cities UNION ALL SELECT 'N/A', 'N/A', 'N/A', 'N/A', 'N/A', 'N/A', {RUN})", "dim_cities", CITY_COLUMNS[:6] + ["created_at"]),
            uniques("cities", "dim_cities", ["city_id"]),
            nulls(f"(SELECT country_id, country_name, processed_at AS created_at FROM countries UNION ALL SELECT 'N/A', 'N/A', {RUN})", "dim_countries", ["country_id", "country_name", "created_at"]),
            uniques("countries", "dim_countries", ["country_id"]),
            nulls("products", "dim_product_categories", ["product_category_id", "product_category_name", "product_category_description"]),
            uniques("products", "dim_product_categories", ["product_category_id"]),
        ]
    )
    silver_tests = " UNION ALL ".join(
        [
            nulls(side("exp"), "silver_exports", SILVER_COLUMNS),
            uniques(side("exp"), "silver_exports", FACT_KEY),
            nulls(side("imp"), "silver_imports", SILVER_COLUMNS),
            uniques(side("imp"), "silver_imports", FACT_KEY),
            nulls("cities", "silver_cities", CITY_COLUMNS),
            uniques("cities", "silver_cities", ["city_id"]),
            nulls("countries", "silver_countries", ["country_id", "country_name", "ingested_at", "loaded_at", "processed_at"]),
            uniques("countries", "silver_countries", ["country_id"]),
            nulls("idx2", "silver_cpi", ["cpi_date", "cpi_value", "ingested_at", "loaded_at", "processed_at"]),
            uniques("idx2", "silver_cpi", ["cpi_date"]),
        ]
    )
    line_columns = "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate".split()
    order_tests = " UNION ALL ".join(
        [
            nulls("lineitem", "lineitem", line_columns),
            uniques("orders", "orders", ["o_orderkey"]),
            uniques("lineitem", "lineitem", ["l_orderkey", "l_linenumber"]),
            orphans("lineitem", "lineitem", "l_orderkey", "orders", "o_orderkey"),
            orphans("customer", "customer", "c_nationkey", "nation", "n_nationkey"),
            orphans("(SELECT * REPLACE (CASE WHEN o_orderpriority = '5-LOW' THEN -o_custkey ELSE o_custkey END AS o_custkey) FROM orders)", "orders", "o_custkey", "customer", "c_custkey"),
        ]
    )
    early = indices(f"(SELECT * FROM {SERIES} WHERE trade_date <= DATE '2000-12-01')").replace("idx", "idx0").replace("latest AS (", "latest0 AS (").replace("idx0, latest)", "idx0, latest0)").replace("ratios AS", "ratios0 AS")
    since = "DATE '2000-12-01'"
    return {
        "silver_exports": f"WITH {BRONZE} SELECT * FROM silver WHERE trade_flag = 'exp'",
        "silver_imports": f"WITH {BRONZE} SELECT * FROM silver WHERE trade_flag = 'imp'",
        "silver_exports_incremental": f"WITH {BRONZE} SELECT * FROM silver WHERE trade_flag = 'exp' AND trade_date >= {since}",
        "silver_cities": f"WITH {CITIES} SELECT * FROM cities",
        "silver_countries": f"WITH {COUNTRIES} SELECT * FROM countries",
        "silver_index": f"WITH {dates}, {indices('lines')}, {silver_cpi} SELECT * FROM idx2",
        "fact_trades": f"WITH {BRONZE}, {dates}, {indices('lines')}, {FACT} SELECT * FROM fact",
        "fact_trades_incremental": (
            f"WITH {BRONZE}, {indices()}, {early}, g AS ({grain}) "
            f"SELECT trade_date, city_id, trade_country_id, product_category_id, fob_value, CAST(fob_value * r.ratio AS DECIMAL(38,4)) AS fob_value_real, net_weight, trade_flag, {RUN} AS created_at "
            f"FROM g LEFT JOIN ratios r ON trade_date = r.cpi_date WHERE trade_date >= {since} UNION ALL "
            f"SELECT trade_date, city_id, trade_country_id, product_category_id, fob_value, CAST(fob_value * r.ratio AS DECIMAL(38,4)), net_weight, trade_flag, {FIRST} "
            f"FROM g LEFT JOIN ratios0 r ON trade_date = r.cpi_date WHERE trade_date < {since}"
        ),
        "dim_cities_insert_only": "SELECT c_custkey AS city_id, CASE WHEN c_mktsegment = 'MACHINERY' THEN upper(c_name) ELSE c_name END AS city_name, c_mktsegment FROM customer",
        "dim_countries": f"WITH {COUNTRIES} SELECT country_id, country_name, processed_at AS created_at FROM countries",
        "dim_product_categories": f"WITH {PRODUCTS} SELECT * FROM products",
        "quality_silver": f"WITH {BRONZE}, {CITIES}, {COUNTRIES}, {dates}, {indices('lines')}, {silver_cpi} {silver_tests}",
        "quality_gold": f"WITH {BRONZE}, {CITIES}, {COUNTRIES}, {PRODUCTS}, {dates}, {indices('lines')}, {FACT} {gold_tests}",
        "quality_orders": order_tests,
        "normalized_documents": f"SELECT doc_id, {normal('text')} AS normalized FROM documents",
        "ambiguous_customer_names": f"SELECT normalized, count(DISTINCT c_custkey) AS members FROM (SELECT {normal('c_name')} AS normalized, c_custkey FROM customer) GROUP BY 1 HAVING count(DISTINCT c_custkey) > 1",
        "trade_response_records": "SELECT CAST(event_id AS VARCHAR) AS id, event_type AS text, props FROM events",
        "index_response_records": "SELECT CAST(event_id AS VARCHAR) AS year, event_type AS period, CAST(user_id AS VARCHAR) AS value FROM events WHERE event_type <> 'error'",
        "landing_manifest": f"WITH {files} SELECT path, 'trade_' || flow AS \"table\", flow, date_from, date_to, '030' || CAST(k AS VARCHAR) AS heading_code FROM files, range(1, 9) r(k)",
        "pending_files": f"WITH {files} SELECT path, flow, date_from, date_to FROM files WHERE date_to >= DATE '1999-01-01'",
        "flow_marks": "SELECT CASE WHEN l_linestatus = 'O' THEN 'exp' ELSE 'imp' END AS trade_flag, CAST(date_trunc('month', max(l_shipdate)) AS DATE) AS mark FROM lineitem GROUP BY 1",
        "ingestion_plan": f"WITH {plan} SELECT * FROM plan",
        "load_windows": (
            f"WITH {plan}, starts AS (SELECT *, unnest(generate_series(year(date_from), least(1998, year(date_to)), 5)) AS y, true AS long FROM plan WHERE date_from IS NOT NULL "
            "UNION ALL SELECT *, unnest(generate_series(greatest(1999, year(date_from)), year(date_to), 1)), false FROM plan WHERE date_from IS NOT NULL), "
            "ends AS (SELECT *, CASE WHEN long THEN least(y + 4, 1998, year(date_to)) ELSE y END AS e FROM starts) "
            "SELECT flow, action, date_from, date_to, CAST(y AS VARCHAR) || '-01' AS window_from, "
            "CASE WHEN e < year(date_to) THEN CAST(e AS VARCHAR) || '-12' ELSE strftime(date_to, '%Y-%m') END AS window_to FROM ends"
        ),
        "index_windows": (
            "SELECT flow, end_year, CAST(1992 AS INTEGER) AS start_year, CAST(b AS INTEGER) AS block_from, CAST(least(b + 3, end_year) AS INTEGER) AS block_to FROM "
            "(SELECT *, unnest(generate_series(1992, end_year, 4)) AS b FROM (SELECT o_orderpriority AS flow, CAST(max(year(o_orderdate)) AS INTEGER) AS end_year FROM orders GROUP BY 1))"
        ),
        "customer_upsert": upsert,
        "customer_version_upsert": upsert,
        "fact_partition_upsert": f"WITH {BRONZE}, g AS ({grain}) SELECT * REPLACE (CAST(net_weight + CASE WHEN trade_date >= {since} THEN 1 ELSE 0 END AS DECIMAL(20,2)) AS net_weight) FROM g",
        "streamed_load": (
            f"WITH {BRONZE} SELECT record, period, kg AS \"metricKG\", fob AS \"metricFOB\", stamp AS loaded_at FROM "
            "(SELECT coalesce(city, '-') || '|' || country || '|' || coalesce(hc, '-') AS record, strftime(trade_date, '%Y-%m') AS period, * FROM bronze WHERE flag = 'imp') "
            "QUALIFY row_number() OVER (PARTITION BY record, period ORDER BY stamp DESC, fob DESC NULLS LAST, kg DESC NULLS LAST) = 1"
        ),
        "landing_round_trip": (
            f"WITH {BRONZE} SELECT CASE WHEN flag = 'exp' THEN 'export' ELSE 'import' END AS flow, strftime(trade_date, '%Y%m') AS period, "
            "count(*) AS records, sum(CAST(kg AS DECIMAL(20,2))) AS kg FROM bronze GROUP BY 1, 2"
        ),
        "unknown_members": (
            f"WITH {BRONZE} SELECT trade_flag, count(*) AS keys, CAST(sum(n) AS BIGINT) AS records, CAST(sum(fob) AS DECIMAL(38,2)) AS fob_value, CAST(sum(kg) AS DECIMAL(38,2)) AS net_weight FROM "
            "(SELECT trade_flag, count(*) AS n, sum(fob_value) AS fob, sum(net_weight) AS kg FROM silver WHERE trade_flag = 'exp' AND city_id = 'N/A' "
            "GROUP BY trade_date, trade_country_id, product_category_id, trade_flag HAVING count(*) > 1) GROUP BY 1"
        ),
        "cut_values": (
            "SELECT 'seed_product_categories' AS table_name, column_name, value, CAST(length(value) AS INTEGER) AS length, left(value, w) AS kept, count(*) AS rows FROM "
            "(SELECT DISTINCT p_type FROM part), LATERAL (VALUES ('product_category_id', p_type, 4), ('product_category_description', 'Parts of type ' || lower(p_type), 18)) v(column_name, value, w) "
            "WHERE length(value) > w GROUP BY ALL"
        ),
        "chapter_headings": "SELECT DISTINCT '03' || lpad(CAST(p_size AS VARCHAR), 2, '0') AS heading_code FROM part WHERE p_size <> 9",
    }



def _case(column: str, values: list[str], first: int = 1) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values, first)) + " END"


PT_MONTHS = "Janeiro Fevereiro Março Abril Maio Junho Julho Agosto Setembro Outubro Novembro Dezembro".split()
PT_DAYS = "Segunda-Feira Terça-Feira Quarta-Feira Quinta-Feira Sexta-Feira Sábado Domingo".split()
HOLIDAYS = [
    ("01-01", "Confraternização Universal"), ("01-25", "Aniversário da Cidade"), ("04-21", "Tiradentes"), ("05-01", "Dia do Trabalhador"),
    ("07-09", "Revolução Constitucionalista"), ("09-07", "Independência do Brasil"), ("10-12", "N. Srª Aparecida"), ("11-02", "Finados"),
    ("11-15", "Proclamação da República"), ("11-20", "Consciência Negra"), ("12-24", "Véspera de Natal"), ("12-25", "Natal"), ("12-31", "Véspera de Ano Novo"),
]
# Easter by the anonymous Gregorian algorithm, another route than the engine's
EASTER = """
yr AS (SELECT unnest(generate_series(year(s), year(e))) AS y FROM b),
e1 AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM yr),
e2 AS (SELECT y, a, c, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h, b % 4 AS e FROM e1),
e3 AS (SELECT y, a, h, (32 + 2 * e + 2 * (c // 4) - h - c % 4) % 7 AS l FROM e2),
e4 AS (SELECT y, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS k FROM e3),
easter AS (SELECT make_date(y, k // 31, k % 31 + 1) AS d FROM e4)
"""


def calendar_sql(source: str) -> tuple[str, str]:
    """CTEs ending in ``cal`` (one row per day) and the select list of the 114 columns."""
    hol = " UNION ALL ".join(
        [f"SELECT {i} AS o, CAST(CAST(y AS VARCHAR) || '-{md}' AS DATE) AS d, '{n}' AS n FROM yr" for i, (md, n) in enumerate(HOLIDAYS)]
        + [f"SELECT {100 + i}, CAST(d + INTERVAL ({k}) DAY AS DATE), '{n}' FROM easter" for i, (k, n) in enumerate([(-2, "Sexta-Feira Santa"), (0, "Páscoa"), (60, "Corpus Christi")])]
    )
    ctes = f"""
b AS (SELECT CAST(date_trunc('year', min(x)) AS DATE) AS s, CAST(max(x) AS DATE) AS t, make_date(year(max(x)), 12, 31) AS e FROM ({source}) z(x)),
{EASTER.strip()},
hols AS (SELECT d AS hd, string_agg(n, '/' ORDER BY o) AS h FROM ({hol}) GROUP BY 1),
day0 AS (SELECT s, t, CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS d FROM b),
day1 AS (SELECT *, year(d) AS y, month(d) AS m, day(d) AS dm, isodow(d) - 1 AS w, weekofyear(d) AS wk, isoyear(d) AS wy, quarter(d) AS q,
  CAST(date_trunc('week', d) AS DATE) AS ws, CASE WHEN day(d) <= 16 THEN d ELSE CAST(d + INTERVAL 1 MONTH AS DATE) END AS cl,
  CASE WHEN month(d) <= 6 THEN 1 ELSE 2 END AS hf, (month(d) + 1) // 2 AS bm, CASE WHEN day(d) <= 15 THEN 1 ELSE 2 END AS ft,
  CASE WHEN month(d) > 3 THEN year(d) ELSE year(d) - 1 END AS fy, (month(d) + 8) % 12 + 1 AS fm, CASE WHEN month(t) > 3 THEN year(t) + 1 ELSE year(t) END AS fyt, (month(t) + 8) % 12 + 1 AS fmt
  FROM day0),
day2 AS (SELECT *, (fm + 2) // 3 AS fq, {_case('m', PT_MONTHS)} AS mn, {_case('w', PT_DAYS, 0)} AS dn, {_case('month(cl)', PT_MONTHS)} AS cn,
  CASE WHEN m * 100 + dm BETWEEN 321 AND 620 THEN 1 WHEN m * 100 + dm BETWEEN 621 AND 921 THEN 2 WHEN m * 100 + dm BETWEEN 922 AND 1221 THEN 3 ELSE 4 END AS se,
  'FY ' || fy || '-' || (fy + 1) AS fyn, 12 * y + m - 12 * year(t) - month(t) AS mt, 'S' || lpad(CAST(wk AS VARCHAR), 2, '0') || ' ' || wy AS wn,
  CAST(date_trunc('month', d) AS DATE) AS ms, CAST(date_trunc('quarter', d) AS DATE) AS qs FROM day1),
cal AS (SELECT *, 3 * (fq - 1) AS fq0, CAST(ms - INTERVAL ((fm - 1) % 3) MONTH AS DATE) AS fqs,
  date_diff('day', CAST(date_trunc('week', t) AS DATE), ws) // 7 AS wt, 24 * (y - year(t)) + 2 * (m - month(t)) + ft - (CASE WHEN day(t) <= 15 THEN 1 ELSE 2 END) AS ftt,
  2 * (y - year(t)) + hf - (CASE WHEN month(t) <= 6 THEN 1 ELSE 2 END) AS hft, 6 * (y - year(t)) + bm - (month(t) + 1) // 2 AS bmt, 4 * (y - year(t)) + q - quarter(t) AS qt,
  4 * (fy - fyt) + fq - (fmt + 2) // 3 AS fqt FROM day2 LEFT JOIN hols ON d = hd)
"""
    i = lambda x: f"CAST({x} AS INTEGER)"
    dt = lambda x: f"CAST({x} AS DATE)"
    now = lambda test, other: f"CASE WHEN {test} THEN 'Atual' ELSE {other} END"
    my = "left(mn, 3) || '/' || strftime(d, '%y')"
    qyn = "'T' || q || ' ' || strftime(d, '%y')"
    hyn, byn, fmn = "'S' || hf || ' ' || y", "'B' || bm || ' ' || y", "left(mn, 3) || ' ' || ft"
    fyq = "'FQ ' || fq || ' | ' || fyn"
    biz = "CASE WHEN h IS NOT NULL OR w > 4 THEN 0 ELSE 1 END"
    cols = {
        "Date": "d", "DateIndex": i("date_diff('day', s, d) + 1"), "DaysToToday": i("date_diff('day', t, d)"), "CurrentDate": now("d = t", "strftime(d, '%d/%m/%Y')"),
        "Year": i("y"), "YearStart": "make_date(y, 1, 1)", "YearEnd": "make_date(y, 12, 31)", "YearIndex": i("y - year(s) + 1"), "YearDescendingName": i("y"),
        "YearDescendingNumber": i("-y"), "YearsToToday": i("y - year(t)"), "CurrentYear": now("y = year(t)", "CAST(y AS VARCHAR)"),
        "DayOfMonth": i("dm"), "DayOfYear": i("dayofyear(d)"), "DayOfWeekNumber": i("w"), "DayOfWeekName": "dn", "DayOfWeekNameShort": "left(dn, 3)",
        "DayOfWeekNameInitials": "repeat(chr(8203), CAST(7 - w AS BIGINT)) || left(dn, 1)", "MonthNumber": i("m"), "MonthName": "mn", "MonthNameShort": "left(mn, 3)",
        "MonthNameInitials": "repeat(chr(8203), CAST(12 - m AS BIGINT)) || left(mn, 1)", "MonthYearName": my, "MonthYearNumber": i("y * 100 + m"), "MonthDayNumber": i("m * 100 + dm"),
        "MonthDayName": "left(mn, 3) || ' ' || dm", "MonthStart": "ms", "MonthEnd": "last_day(d)", "MonthIndex": i("12 * (y - year(s)) + m"), "MonthsToToday": i("mt"),
        "CurrentMonthName": now("m = month(t)", "mn"), "CurrentMonthNameShort": now("m = month(t)", "left(mn, 3)"), "CurrentMonthYearName": now("mt = 0", my),
        "QuarterNumber": i("q"), "QuarterName": "'T' || q", "QuarterYearName": qyn, "QuarterYearNumber": i("y * 100 + q"), "QuarterStart": "qs",
        "QuarterEnd": dt("qs + INTERVAL 3 MONTH - INTERVAL 1 DAY"), "QuarterIndex": i("4 * (y - year(s)) + q"), "QuartersToToday": i("qt"),
        "CurrentQuarter": now("q = quarter(t)", "'T' || q"), "CurrentQuarterYear": now("qt = 0", qyn), "MonthOfQuarterNumber": i("(m - 1) % 3 + 1"),
        "WeekOfYearNumberISO": i("wk"), "YearISO": i("wy"), "WeekYearNumberISO": i("wy * 100 + wk"), "WeekYearNameISO": "wn", "WeekStartISO": "ws", "WeekEndISO": dt("ws + INTERVAL 6 DAY"),
        "WeekIndexISO": i("date_diff('day', CAST(date_trunc('week', s) AS DATE), ws) // 7 + 1"), "WeeksToTodayISO": i("wt"), "CurrentWeekISO": now("wt = 0", "wn"),
        "WeekPeriodName": "wn || ': ' || strftime(ws, '%d/%m/%Y') || '~' || strftime(ws + INTERVAL 6 DAY, '%d/%m/%Y')",
        "WeekOfMonthNumber": i("date_diff('day', CAST(date_trunc('week', ms) AS DATE), ws) // 7 + 1"),
        "HalfNumber": i("hf"), "HalfYearName": hyn, "HalfYearNumber": i("y * 100 + hf"), "HalfIndex": i("2 * (y - year(s)) + hf"), "HalfsToToday": i("hft"), "CurrentHalf": now("hft = 0", hyn),
        "BimesterNumber": i("bm"), "BimesterYearName": byn, "BimesterYearNumber": i("y * 100 + bm"), "BimesterIndex": i("6 * (y - year(s)) + bm"), "BimestersToToday": i("bmt"),
        "CurrentBimester": now("bmt = 0", byn), "FortnightOfMonthNumber": i("ft"), "FortnightMonthNumber": i("m * 10 + ft"), "FortnightMonthName": fmn,
        "FortnightMonthYearNumber": i("y * 10000 + m * 110 + ft"), "FortnightMonthYearName": "'Q' || ft || ' ' || left(mn, 3) || ' ' || y",
        "FortnightIndex": i("24 * (y - year(s)) + 2 * (m - month(s)) + ft"), "FortnightsToToday": i("ftt"), "CurrentFortnight": now("ftt = 0", fmn),
        "ClosingDateRef": "cl", "ClosingYear": i("year(cl)"), "ClosingMonthName": "cn", "ClosingMonthNameShort": "left(cn, 3)", "ClosingMonthNumber": i("month(cl)"),
        "ClosingMonthYearName": "left(cn, 3) || '/' || strftime(cl, '%y')", "ClosingMonthYearNumber": i("year(cl) * 100 + month(cl)"),
        "SeasonNorthNumber": i("se"), "SeasonNorthName": _case("se", ["Primavera", "Verão", "Outono", "Inverno"]), "SeasonSouthNumber": i("se"),
        "SeasonSouthName": _case("se", ["Outono", "Inverno", "Primavera", "Verão"]), "Holiday": "h", "BusinessDayNumber": i(biz),
        "BusinessDayName": f"CASE WHEN {biz} = 1 THEN 'Dia Útil' ELSE 'Dia Não Útil' END",
        "FiscalYearStartNumber": i("fy"), "FiscalYearEndNumber": i("fy + 1"), "FiscalYear": "fyn", "FiscalYearStart": "make_date(fy, 4, 1)", "FiscalYearEnd": "make_date(fy + 1, 3, 31)",
        "CurrentFiscalYear": now("fy = fyt", "fyn"), "FiscalYearsToToday": i("fy - fyt"), "FiscalMonthNumber": i("fm"), "FiscalMonthName": "mn", "FiscalMonthNameShort": "left(mn, 3)",
        "CurrentFiscalMonth": now("mt = 0", "mn"), "FiscalYearMonthName": "left(mn, 3) || ' ' || fyn", "FiscalYearMonthNumber": i("fy * 100 + fm"),
        "FiscalYearMonthCurrent": now("fy = fyt AND mt = 0", "left(mn, 3) || ' ' || fyn"), "FiscalMonthsToToday": i("12 * (fy - fyt) + fm - fmt"),
        "FiscalQuarterNumber": i("fq"), "FiscalQuarterName": "'FQ ' || fq", "FiscalMonthOfQuarterNumber": i("fm - fq0"), "FiscalYearQuarterName": fyq,
        "FiscalYearQuarterNumber": i("fy * 100 + fq"), "FiscalQuarterStart": "fqs", "FiscalQuarterEnd": dt("fqs + INTERVAL 3 MONTH - INTERVAL 1 DAY"),
        "FiscalQuartersToToday": i("fqt"), "CurrentFiscalQuarter": now("fqt = 0", fyq), "DayOfFiscalQuarter": i("date_diff('day', fqs, d) + 1"),
    }
    return ctes, ", ".join(f"{x} AS {n}" for n, x in cols.items())


def calendar_queries_sql() -> dict[str, str]:
    ctes, columns = calendar_sql("SELECT l_shipdate FROM lineitem")
    order_ctes, _ = calendar_sql("SELECT o_orderdate FROM orders")
    return {
        "shipping_calendar": f"WITH {ctes}, n AS (SELECT CAST(l_shipdate AS DATE) AS nd, count(*) AS lines FROM lineitem GROUP BY 1) "
        f"SELECT {columns}, coalesce(lines, 0) AS lines FROM cal LEFT JOIN n ON d = nd",
        "orders_on_holidays": f"WITH {order_ctes} SELECT h AS holiday, count(*) AS orders FROM orders JOIN hols ON CAST(o_orderdate AS DATE) = hd GROUP BY 1",
        "orders_by_business_day": f"WITH {order_ctes} SELECT CAST(y AS INTEGER) AS \"Year\", CASE WHEN h IS NOT NULL OR w > 4 THEN 'Dia Não Útil' ELSE 'Dia Útil' END AS \"BusinessDayName\", "
        "count(*) AS orders, sum(CAST(o_totalprice AS DECIMAL(20,2))) AS value FROM orders JOIN cal ON CAST(o_orderdate AS DATE) = d GROUP BY 1, 2",
    }



def text(template: str, **parts: str) -> str:
    pieces = [f"coalesce(CAST({parts[x]} AS VARCHAR), '')" if k % 2 else f"'{x}'" for k, x in enumerate(re.split(r"\{(\w+)\}", template)) if k % 2 or x]
    return " || ".join(pieces)


def fx(spec: str, x: str, digits: int) -> str:
    return f"format('{spec}', round(CAST({x} AS DOUBLE), {digits}))"


def mag(v: str, size: str | None = None) -> str:
    size = size or v
    steps = "".join(f"WHEN {size} > {unit} THEN {fx('{:.2f} ' + name, f'CAST({v} AS DOUBLE) / {unit}', 2)} " for unit, name in ((1000000000, "Bi"), (1000000, "Mi"), (1000, "K")))
    return f"CASE {steps}WHEN {v} IS NOT NULL THEN {fx('{:.0f}', v, 0)} END"


def mag_abs(v: str) -> str:
    return mag(v, f"abs({v})")


def pct(x: str, digits: int = 1) -> str:
    return fx("{:." + str(digits) + "f}%", f"({x}) * 100", digits)


def kg(v: str) -> str:
    return f"CASE WHEN abs({v}) >= 1000 THEN {fx('{:,.2f} Ton', f'CAST({v} AS DOUBLE) / 1000', 2)} ELSE {fx('{:.0f} Kg', v, 0)} END"


def label(d: str) -> str:
    return f"left({_case(f'month({d})', PT_MONTHS)}, 3) || '/' || strftime({d}, '%y')"


def best(table: str, member: str, value: str) -> str:
    """CTE body: one row with every member at the highest value, names joined, and the value."""
    return f"(SELECT string_agg({member}, '' ORDER BY {member}) AS n, max({value}) AS v FROM {table} WHERE {value} = (SELECT max({value}) FROM {table}))"


def narrative_sql() -> dict[str, str]:
    g = lambda by: f"SELECT {by}, {EXP} AS e, {IMP} AS i, {EXP_KG} AS we, {IMP_KG} AS wi, {EXP_REAL} AS er, {IMP_REAL} AS ir FROM trades GROUP BY {by}"
    priced = lambda by: f"SELECT *, {div('e', 'we')} AS pe, {div('i', 'wi')} AS pi FROM ({g(by)})"
    span = lambda c, f: f"(SELECT {f}(trade_date) FROM m WHERE {c} > 0)"
    first, last = label(span("e", "min")), label(span("e", "max"))
    ifirst, ilast = label(span("i", "min")), label(span("i", "max"))
    months = f"m AS (SELECT *, {label('trade_date')} AS lab, {minus('e', 'i')} AS bal, {minus('er', 'ir')} AS balr FROM ({g('trade_date')}))"
    total = "(SELECT sum(e) FROM m)"
    short = lambda d: f"lower(left({_case(f'month({d})', PT_MONTHS)}, 3)) || '/' || year({d})"
    t = texts.OVERVIEW
    rank = lambda k: f"(SELECT {k} FROM c WHERE e = (SELECT max(e) FROM c))"
    rank2 = lambda k: f"(SELECT {k} FROM c WHERE e = (SELECT max(e) FROM c WHERE e < (SELECT max(e) FROM c)))"
    overview = trades_query(
        f"SELECT {text(t['data_available'], first=short('(SELECT min(trade_date) FROM m)'), last=short('(SELECT max(trade_date) FROM m)'))} AS data_available, "
        f"{text(t['series'], value=mag('(SELECT max(i) FROM m)'), month='(SELECT n FROM peak)')} AS series_subtitle, "
        + text(t["categories"], name1=rank("name"), id1=rank("name"), share1=pct(f"CAST({rank('e')} AS DOUBLE) / CAST({total} AS DOUBLE)"),
               name2=rank2("name"), id2=rank2("name"), share2=pct(f"CAST({rank2('e')} AS DOUBLE) / CAST({total} AS DOUBLE)"))
        + f" AS categories_subtitle, {text(t['states_title_many'], n='10')} AS states_title, {text(t['states_span'], first=first, last=last)} AS states_subtitle, "
        f"{text(t['countries_title_many'], n='10')} AS countries_title, "
        + text(t["countries"], country="(SELECT n FROM top)", share=pct(f"CAST((SELECT v FROM top) AS DOUBLE) / CAST({total} AS DOUBLE)"), value=mag("(SELECT v FROM top)"), first=first, last=last)
        + " AS countries_subtitle",
        f"{months}, c AS (SELECT product_category_name AS name, {EXP} AS e FROM trades GROUP BY 1), k AS ({g('country_name')}), peak AS {best('m', 'lab', 'i')}, top AS {best('k', 'country_name', 'e')}",
    )
    t = texts.BALANCE
    diff = "abs((SELECT sum(e) - sum(i) FROM m))"
    balance = trades_query(
        f"SELECT {text(t['lowest'], month='(SELECT n FROM low)', value=mag_abs('(SELECT -v FROM low)'))} AS page_title, "
        f"{text(t['real'], value=mag('(SELECT max(gap) FROM gaps)'), month='(SELECT max(lab) FROM gaps WHERE gap = (SELECT max(gap) FROM gaps))')} AS real_subtitle, "
        f"CASE WHEN (SELECT sum(e) > sum(i) FROM m) THEN {text(t['surplus'], first=first, last=last, value=mag(diff))} ELSE {text(t['deficit'], first=first, last=last, value=mag(diff))} END AS running_subtitle, "
        + text(t["heatmap"], worst="(SELECT max(name) FROM means WHERE mean = (SELECT min(mean) FROM means))", best="(SELECT max(name) FROM means WHERE mean = (SELECT max(mean) FROM means))",
               low=mag_abs("(SELECT min(mean) FROM means)"), high=mag_abs("(SELECT max(mean) FROM means)"))
        + " AS heatmap_subtitle",
        f"{months}, neg AS (SELECT lab, -bal AS nb FROM m), low AS {best('neg', 'lab', 'nb')}, gaps AS (SELECT lab, abs(balr - bal) AS gap FROM m WHERE balr <> 0), "
        f"means AS (SELECT {_case('month(trade_date)', PT_MONTHS)} AS name, avg(CAST(bal AS DOUBLE)) AS mean FROM m GROUP BY 1)",
    )
    t = texts.PRODUCTS
    streak = {}
    for c in ("e", "i"):
        table, leader = f"lead_{c}", f"(SELECT max_by(name, year) FROM lead_{c})"
        streak[c] = (
            f"{table} AS (SELECT year, product_category_name AS name FROM py WHERE {c} IS NOT NULL QUALIFY rank() OVER (PARTITION BY year ORDER BY {c} DESC) = 1)",
            leader,
            f"(SELECT max(year) - coalesce(max(year) FILTER (WHERE name <> {leader}), min(year) - 1) FROM {table})",
            f"(SELECT sum({c}) FROM py WHERE product_category_name = {leader})",
        )
    price = lambda x: fx("{:.2f} U$/kg", x, 2)
    products = trades_query(
        f"SELECT {text(t['most_exported_span'], first=first, last=last)} AS most_exported_subtitle, {text(t['most_imported_title'], name='(SELECT n FROM top_i)')} AS most_imported_title, "
        f"{text(t['dearest_title'], name='(SELECT n FROM top_pe)')} AS dearest_title, "
        f"{text(t['dearest'], times=fx('{:.0f}x', '(SELECT v FROM top_pe) / (SELECT pe FROM p WHERE name = (SELECT n FROM top_e))', 0))} AS dearest_subtitle, "
        f"{text(t['export_lead'], name=streak['e'][1], years=streak['e'][2], value=mag_abs(streak['e'][3]), first=first, last=last)} AS exports_lead, "
        f"{text(t['import_lead'], name=streak['i'][1], years=streak['i'][2], value=mag_abs(streak['i'][3]), first=ifirst, last=ilast)} AS imports_lead, "
        f"{text(t['yearly_price'], mean=price('(SELECT CAST(sum(e) AS DOUBLE) / CAST(sum(we) AS DOUBLE) FROM m)'), peak=price('(SELECT v FROM peak_e)'), year='(SELECT n FROM peak_e)')} AS yearly_export_price, "
        f"{text(t['yearly_price'], mean=price('(SELECT CAST(sum(i) AS DOUBLE) / CAST(sum(wi) AS DOUBLE) FROM m)'), peak=price('(SELECT v FROM peak_i)'), year='(SELECT n FROM peak_i)')} AS yearly_import_price, "
        f"{text(t['category_price'], name='(SELECT n FROM top_pe)', price=price('(SELECT v FROM top_pe)'))} AS category_export_price, "
        f"{text(t['category_price'], name='(SELECT n FROM top_pi)', price=price('(SELECT v FROM top_pi)'))} AS category_import_price",
        f"{months}, p AS (SELECT product_category_name AS name, * FROM ({priced('product_category_name')})), y AS (SELECT CAST(year AS VARCHAR) AS yy, * FROM ({priced('year')})), "
        f"py AS ({g('year, product_category_name')}), {streak['e'][0]}, {streak['i'][0]}, top_e AS {best('p', 'name', 'e')}, top_i AS {best('p', 'name', 'i')}, top_pe AS {best('p', 'name', 'pe')}, "
        f"top_pi AS {best('p', 'name', 'pi')}, peak_e AS {best('y', 'yy', 'pe')}, peak_i AS {best('y', 'yy', 'pi')}",
    )
    t = texts.PARTNERS
    pick = lambda c, k: f"(SELECT {k} FROM k ORDER BY {c} DESC, country_name LIMIT 1)"
    se = f"CAST({pick('e', 'e')} AS DOUBLE) / CAST((SELECT sum(e) FROM k) AS DOUBLE)"
    si = f"CAST({pick('i', 'i')} AS DOUBLE) / CAST((SELECT sum(i) FROM k) AS DOUBLE)"
    change = "(SELECT max_by(h, year) - min_by(h, year) FROM hh)"
    year0 = "(SELECT min(year) FROM hh)"
    partners = trades_query(
        f"SELECT {text(t['exports_all'], share=pct(se, 2))} AS exports_title, {text(t['imports_all'], share=pct(se, 2))} AS imports_title, {text(t['imports_all'], share=pct(si, 2))} AS imports_title_fixed, "
        f"{text(t['tornado_title'], n='10')} AS tornado_title, "
        f"{text(t['tornado'], n='10', exporter=pick('e', 'country_name'), export_share=fx('{:02.0f}%', f'({se}) * 100', 0), importer=pick('i', 'country_name'), import_share=fx('{:02.0f}%', f'({si}) * 100', 0))} AS tornado_subtitle, "
        f"CASE WHEN {change} < 0 THEN {text(t['hhi_down'], change=pct('-' + change), year=year0)} ELSE {text(t['hhi_up'], change=pct(change), year=year0)} END AS hhi_subtitle, "
        f"{text(t['hhi_title'], flow=chr(39) + texts.EXPORTS + chr(39))} AS hhi_title",
        f"k AS ({g('country_name')}), hy AS (SELECT year, country_name, sum(fob) AS v FROM trades GROUP BY ALL), "
        "hh AS (SELECT year, sum(s * s) AS h FROM (SELECT year, CAST(v AS DOUBLE) / CAST(sum(v) OVER (PARTITION BY year) AS DOUBLE) AS s FROM hy) GROUP BY year)",
    )
    t = texts.STATES
    city = lambda c, k: f"(SELECT {k} FROM c ORDER BY {c} DESC, city_uf LIMIT 1)"
    top = lambda c: f"(SELECT max({c}) FROM st)"
    states = trades_query(
        f"SELECT {text(t['export_card'], first=first, last=last, value=mag_abs(top('e')), weight=kg(top('we')))} AS export_card, {text(t['import_card'], value=mag_abs(top('i')), weight=kg(top('wi')))} AS import_card, "
        f"{text(t['cities_title'], n='10', first=first, last=last)} AS exporting_cities_title, {text(t['cities_title'], n='10', first=ifirst, last=ilast)} AS importing_cities_title, "
        f"{text(t['exporting_city'], city=city('e', 'city_uf'), value=mag_abs(city('e', 'e')))} AS exporting_city, {text(t['importing_city'], city=city('i', 'city_uf'), value=mag_abs(city('i', 'i')))} AS importing_city, "
        f"{text(t['exporting_cities'], state='(SELECT n FROM ae)', cities='(SELECT v FROM ae)')} AS exporting_cities, {text(t['importing_cities'], state='(SELECT n FROM ai)', cities='(SELECT v FROM ai)')} AS importing_cities, "
        f"{text(t['map'], state='(SELECT n FROM se)', value=mag_abs('(SELECT v FROM se)'))} AS exports_map, {text(t['map'], state='(SELECT n FROM si)', value=mag_abs('(SELECT v FROM si)'))} AS imports_map",
        f"{months}, st AS ({g('state_name')}), c AS ({g('city_uf')}), act AS (SELECT state_name, count(DISTINCT city_id) FILTER (WHERE flag = 'exp') AS e, count(DISTINCT city_id) FILTER (WHERE flag = 'imp') AS i FROM trades GROUP BY 1), "
        f"ae AS {best('act', 'state_name', 'e')}, ai AS {best('act', 'state_name', 'i')}, se AS {best('st', 'state_name', 'e')}, si AS {best('st', 'state_name', 'i')}",
    )
    coverage = trades_query(
        f"SELECT year, round(ch, 6) AS change, CASE WHEN ch > 0 THEN '+' WHEN ch < 0 THEN '-' ELSE '' END || {fx('{:.1f} p.p.', 'abs(ch)', 1)} AS label FROM "
        f"(SELECT year, {minus('r', 'lag(r) OVER (ORDER BY year)')} AS ch FROM y)",
        f"y AS (SELECT year, {div(EXP, IMP)} AS r FROM trades GROUP BY year)",
    )
    return {
        "narrative_overview": overview, "narrative_balance": balance, "narrative_products": products,
        "narrative_partners": partners, "narrative_states": states, "coverage_change_label": coverage,
    }


SEED = "(SELECT DISTINCT p_type AS product_category_id, p_type AS product_category_name, 'Parts of type ' || lower(p_type) AS product_category_description FROM part)"


def summed(sql: str) -> str:
    """The same over silver rows that are one row for each key."""
    return sql.replace("fact AS (", f"{SUMMED.strip()},\nfact AS (", 1).replace("FROM silver LEFT JOIN ratios", "FROM summed LEFT JOIN ratios")


def case_sql() -> dict[str, str]:
    p = pipeline_sql()
    late = p["streamed_load"]
    regions = f"(SELECT upper({letters('n_nationkey', 2)}) AS uf, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey < 4)"
    columns = ["product_category_id", "product_category_name", "product_category_description"]
    english = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]
    spanish = ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre"]
    english_days = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    spanish_days = ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"]

    def days(months: list[str], weekdays: list[str], quarter: str) -> str:
        return (
            "WITH b AS (SELECT date_trunc('year', min(l_shipdate)) AS s, make_date(year(max(l_shipdate)), 12, 31) AS e FROM lineitem), "
            "d AS (SELECT CAST(unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d FROM b) "
            f"SELECT d AS day, {_case('month(d)', months)} AS month, {_case('isodow(d)', weekdays)} AS weekday, '{quarter}' || quarter(d) AS quarter, '{quarter}' AS quarter_label FROM d"
        )

    return {
        "fact_partition_growth": "SELECT o_orderkey, lpad(CAST(o_custkey % 7 AS VARCHAR), 4, '0') AS part, "
        "CAST(CAST(o_totalprice AS DECIMAL(20,2)) + CASE WHEN o_orderkey % 3 = 1 AND o_custkey % 7 < 4 THEN 1 ELSE 0 END AS DECIMAL(20,2)) AS value, "
        "CASE WHEN o_orderkey % 3 = 0 THEN 'x' END AS note FROM orders",
        "streamed_load_late": late,
        "price_share_by_year": trades_query(
            f"SELECT year, round(price, 6) AS export_price, round(price / (SELECT {div(EXP, EXP_KG)} FROM trades), 6) AS share FROM g",
            f"g AS (SELECT year, {div(EXP, EXP_KG)} AS price FROM trades GROUP BY year)",
        ),
        "top_n_with_unmatched": trades_query(
            "SELECT CASE WHEN name IS NOT NULL AND rk <= 6 THEN name ELSE 'Outros' END AS country_name, CAST(sum(e) AS DECIMAL(38,2)) AS exports "
            "FROM (SELECT *, rank() OVER (ORDER BY name IS NULL, e DESC NULLS LAST) AS rk FROM g) GROUP BY 1 HAVING sum(e) IS NOT NULL",
            f"g AS (SELECT CASE WHEN CAST(country_id AS INTEGER) % 5 <> 0 THEN country_name END AS name, {EXP} AS e FROM trades GROUP BY 1)",
        ),
        "top_by_choice": trades_query(
            "SELECT CAST(n AS INTEGER) AS n, CAST(sum(e) AS DECIMAL(38,2)) AS exports FROM (SELECT *, dense_rank() OVER (ORDER BY e DESC) AS rk FROM g WHERE e IS NOT NULL) "
            "JOIN (SELECT unnest(range(1, 21)) AS n) ON rk <= n GROUP BY 1",
            f"g AS (SELECT state_name, {EXP} AS e FROM trades GROUP BY 1)",
        ),
        "sliced_within": grouped("year", ["exports"], where="region = 'EUROPE'"),
        "quality_seeds": " UNION ALL ".join(
            [nulls(SEED, "seed_product_categories", columns), *(uniques(SEED, "seed_product_categories", [c]) for c in columns), nulls(regions, "seed_state_regions", ["uf", "region"]), uniques(regions, "seed_state_regions", ["uf"])]
        ),
        "seed_round_trip": f"SELECT * FROM {SEED}",
        "landing_scan": f"WITH {BRONZE} SELECT CASE WHEN flag = 'exp' THEN 'export' ELSE 'import' END AS flow, count(*) AS records, count(country) AS with_country FROM bronze GROUP BY 1",
        "landing_listing": "SELECT 'trade_' || flow || '_199201_200112.parquet' AS path, flow, DATE '1992-01-01' AS date_from, DATE '2001-12-01' AS date_to "
        "FROM (SELECT DISTINCT CASE WHEN l_linestatus = 'O' THEN 'export' ELSE 'import' END AS flow FROM lineitem)",
        "monthly_run_full": summed(p["fact_trades"]),
        "monthly_run_incremental": f"SELECT * EXCLUDE (fob_value_real) FROM ({summed(p['fact_trades'])})",
        "monthly_run_gate": f"SELECT * FROM ({summed(p['quality_gold']).replace(" UNION ALL SELECT 'N/A')", ')')}) WHERE failures > 0",
        "calendar_english": days(english, english_days, "Q"),
        "calendar_spanish": days(spanish, spanish_days, "T"),
    }


def upkeep_sql() -> dict[str, str]:
    since, slice_ = "DATE '2000-12-01'", "FROM trades WHERE year IN (1996, 1997, 1998) AND region IN ('ASIA', 'EUROPE') GROUP BY year"
    state = "count(*) AS rows, count(DISTINCT trade_date) AS months, CAST(sum(kg{}) AS DECIMAL(38,2)) AS kg FROM grain"
    members = lambda c: {n: f"count(DISTINCT {c}) FILTER (WHERE flag = '{f}')" for f, n in (("exp", "exports"), ("imp", "imports"))}
    cities, countries = members("city_id"), members("country_id")
    years = "SELECT strftime(trade_date, '%Y') AS year, coalesce(city, '-') || '|' || country || '|' || coalesce(hc, '-') AS record, trade_date FROM bronze WHERE flag = 'imp'"
    rolled = (
        "rolled AS (SELECT trade_date, CAST(nk AS VARCHAR) AS trade_country_id, hc AS product_category_id, flag AS trade_flag, CAST(sum(fob) AS DECIMAL(38,2)) AS fob_value, "
        f"CAST(sum(CAST(fob * ratio AS DECIMAL(38,4))) AS DECIMAL(38,4)) AS fob_value_real, CAST(sum(kg + CASE WHEN trade_date >= {since} THEN 1 ELSE 0 END) AS DECIMAL(38,2)) AS net_weight "
        "FROM grain LEFT JOIN ratios ON trade_date = cpi_date GROUP BY ALL)"
    )
    pages = (
        "pages AS (SELECT event_id AS e, CASE event_id % 10 WHEN 1 THEN 'not JSON' WHEN 2 THEN 'no record list' WHEN 3 THEN 'empty' ELSE 'accepted' END AS reason, "
        "CASE WHEN event_id % 10 < 5 AND event_id % 10 > 0 THEN 0 ELSE 1 END AS n FROM events)"
    )
    return {
        "fact_partition_pointer": (
            f"WITH {BRONZE} SELECT 'lost' AS state, {state.format('')} WHERE trade_date <= {since} UNION ALL SELECT 'earlier', {state.format('')} WHERE trade_date <= {since} "
            f"UNION ALL SELECT 'repeated', {state.format(f' + CASE WHEN trade_date >= {since} THEN 1 ELSE 0 END')}"
        ),
        "loads_after_stop": (
            f"WITH {BRONZE}, y AS ({years}) SELECT year, 'import' AS flow, CAST(1 AS BIGINT) AS ledger_rows, count(DISTINCT (record, trade_date)) AS records, "
            "CAST((SELECT count(DISTINCT year) FROM y WHERE year >= '1996') AS INTEGER) AS loaded_late, 0 AS loaded_again FROM y GROUP BY year"
        ),
        "rollup_after_loads": f"WITH {BRONZE}, {indices()}, {rolled} SELECT *, CAST((SELECT count(DISTINCT trade_date) FROM grain WHERE trade_date >= {since}) AS INTEGER) AS months_again FROM rolled",
        "rollup_report": trades_query(f"SELECT year, country_name, {EXP} AS exports, {minus(EXP, IMP)} AS balance, {minus(EXP_REAL, IMP_REAL)} AS balance_real FROM trades GROUP BY year, country_name"),
        "approx_partners_sliced": trades_query(
            f"SELECT year, {countries['exports']} AS exports_members, {countries['imports']} AS imports_members FROM trades WHERE year IN (1997, 1998) AND region = 'ASIA' GROUP BY year"
        ),
        "partners_by_slice": trades_query(
            "SELECT year, " + ", ".join(f"{c} AS {n}_members, {c} AS {n}_estimate, true AS {n}_within" for n, c in countries.items()) + f" {slice_}"
        ),
        "cities_by_slice": trades_query("SELECT year, " + ", ".join(f"{c} AS {n}_members, true AS {n}_within" for n, c in cities.items()) + f" {slice_}"),
        "category_exports_of_top_countries": trades_query(
            f"SELECT product_category_name, {EXP} AS exports FROM trades JOIN best USING (country_name) GROUP BY 1",
            f"best AS (SELECT country_name FROM trades WHERE country_name IS NOT NULL GROUP BY 1 QUALIFY rank() OVER (ORDER BY {EXP} DESC NULLS LAST) <= 10)",
        ),
        "exports_of_best_state_years": trades_query(
            f"SELECT product_category_name, {EXP} AS exports, {IMP} AS imports FROM trades JOIN pairs USING (state_name, year) WHERE year IN (1996, 1997, 1998) GROUP BY 1",
            f"pairs AS (SELECT state_name, year FROM trades GROUP BY ALL HAVING {EXP} > 1000000)",
        ),
        "rejected_pages": f"WITH {pages} SELECT reason, count(*) AS pages, min('page-' || e) AS first_path, CAST(sum(n) AS BIGINT) AS records FROM pages GROUP BY reason",
        "unreadable_values": (
            "SELECT event_type, 'amount' AS column_name, 'decimal(20,2)' AS type, count(*) AS rows, min('x' || event_id) AS first_value FROM events WHERE event_id % 9 = 0 GROUP BY event_type"
        ),
        "empty_manifest": f"SELECT 'before' AS state, CAST(0 AS BIGINT) AS rows, CAST(0 AS BIGINT) AS files UNION ALL SELECT 'after', count(*), count(DISTINCT path) FROM ({pipeline_sql()['landing_manifest']})",
    }


def all_sql() -> dict[str, str]:
    return {**report_sql(), **pipeline_sql(), **calendar_queries_sql(), **narrative_sql(), **case_sql(), **upkeep_sql()}
