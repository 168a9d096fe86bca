"""Oracle SQL (DuckDB dialect) for the registered queries.

Each statement reads the driver's tables (views ``lineitem``, ``part``, ``supplier``,
``nation``, ``region``) and recomputes the query independently of Spark: the adapter
view, the text cleaning, ROW_NUMBER-based dedupe and latest-row picks, and exact decimal
rounding done in integers. Column names and types equal the Spark results.
"""

from __future__ import annotations

from salesmart import demo
from salesmart.plans import catalog as q
from salesmart.schema import (DIMENSION_COLUMNS, DIRECTIONS, LIQUOR_TYPES, MEASURE_COLUMNS,
                              NUMERIC_TYPES, PLACEHOLDERS, REFERENCE_RUN_ROWS,
                              REFERENCE_RUN_SECONDS, SALES_COLUMNS, STORE_FORMAT_DEFAULT,
                              STORE_FORMAT_EXACT, STORE_FORMATS)

NUM_RE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

SQL_TYPES = {
    "invoice_line_no": "VARCHAR", "date": "DATE", "store": "INTEGER", "name": "VARCHAR",
    "address": "VARCHAR", "city": "VARCHAR", "zipcode": "INTEGER", "county": "VARCHAR",
    "category": "INTEGER", "category_name": "VARCHAR", "vendor_no": "INTEGER",
    "vendor_name": "VARCHAR", "itemno": "INTEGER", "im_desc": "VARCHAR",
    "bottle_volume_ml": "INTEGER", "state_bottle_cost": "DECIMAL(10,2)",
    "state_bottle_retail": "DECIMAL(10,2)", "sale_bottles": "INTEGER",
}


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def cols(prefix: str = "") -> str:
    return ", ".join(prefix + c for c in SALES_COLUMNS)


def half_up(n: str, d: str) -> str:
    """round-half-away-from-zero(n / d) for integer expressions; NULL when d is 0."""
    n, d = f"CAST({n} AS HUGEINT)", f"CAST({d} AS HUGEINT)"
    return (f"(CASE WHEN {d} = 0 OR {d} IS NULL OR {n} IS NULL THEN NULL "
            f"ELSE (CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END) * "
            f"((2 * abs({n}) + abs({d})) // (2 * abs({d}))) END)")


def scaled(q_expr: str, scale: int, typ: str) -> str:
    """Integer q as q / 10^scale in decimal type ``typ`` (NULL when it does not fit)."""
    if scale == 0:
        return f"TRY_CAST({q_expr} AS {typ})"
    unit = f"CAST('{10 ** -scale:.{scale}f}' AS DECIMAL({scale + 1},{scale}))"
    return f"TRY_CAST(CAST({q_expr} AS DECIMAL(18,0)) * {unit} AS {typ})"


def div_round(num: str, ns: int, den: str, ds: int, out: int, typ: str) -> str:
    n = f"CAST(({num}) * {10 ** ns} AS HUGEINT)"
    d = f"CAST(({den}) * {10 ** ds} AS HUGEINT)"
    shift = ds + out - ns
    if shift >= 0:
        n = f"({n} * {10 ** shift})"
    else:
        d = f"({d} * {10 ** -shift})"
    return scaled(half_up(n, d), out, typ)


def percent(part: str, whole: str, scale: int = 4) -> str:
    return div_round(f"CAST({part} AS BIGINT) * 100", 0, f"CAST({whole} AS BIGINT)", 0, scale,
                     f"DECIMAL(20,{scale})")


# --- shared CTEs -------------------------------------------------------------------------

_BRANDS = ", ".join(lit(b) for b in demo.BRANDS)

SALES = f"""sales AS (
  SELECT
    'INV-' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS invoice_line_no,
    CAST(l.l_shipdate AS DATE) AS date,
    CAST(l.l_suppkey AS INTEGER) AS store,
    ([{_BRANDS}])[CAST((l.l_suppkey + l.l_linenumber) % 9 AS INTEGER) + 1]
      || CAST(l.l_suppkey AS VARCHAR) || ' / ' || n.n_name AS name,
    CAST(l.l_suppkey AS VARCHAR) || 'TH  sw ' || p.p_name || ' o''brien st.' AS address,
    n.n_name AS city,
    CAST(50000 + n.n_nationkey AS INTEGER) AS zipcode,
    r.r_name AS county,
    CAST(1000000 + (l.l_partkey % 11) * 10000 AS INTEGER) AS category,
    CASE WHEN l.l_partkey % 37 = 0 THEN NULL ELSE p.p_type END AS category_name,
    CAST(l.l_suppkey % 50 AS INTEGER) AS vendor_no,
    p.p_brand AS vendor_name,
    CAST(l.l_partkey AS INTEGER) AS itemno,
    p.p_name AS im_desc,
    CAST(p.p_size * 25 AS INTEGER) AS bottle_volume_ml,
    CAST((300 + l.l_partkey % 1700) * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS state_bottle_cost,
    CAST((450 + l.l_partkey % 1700) * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS state_bottle_retail,
    CAST(CAST(l.l_quantity AS INTEGER) - 5 AS INTEGER) AS sale_bottles
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""


def _raw_col(c: str) -> str:
    if c == "date":
        return "strftime(CAST(date AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S.000') AS date"
    if SQL_TYPES[c] == "VARCHAR":
        return c
    return f"CAST({c} AS VARCHAR) AS {c}"


RAW = "raw_sales AS (SELECT " + ", ".join(_raw_col(c) for c in SALES_COLUMNS) + " FROM sales)"


def _fill_col(c: str) -> str:
    if c in PLACEHOLDERS:
        return f"COALESCE({c}, {lit(str(PLACEHOLDERS[c]))}) AS {c}"
    return c


FILLED = "filled AS (SELECT " + ", ".join(_fill_col(c) for c in SALES_COLUMNS) + " FROM raw_sales)"


def int_via_float(c: str, typ: str = "INTEGER") -> str:
    return (f"CASE WHEN regexp_matches({c}, {lit(NUM_RE)}) "
            f"THEN TRY_CAST(trunc(TRY_CAST(trim({c}) AS DOUBLE)) AS {typ}) END")


def _typed_col(c: str, src: str = "") -> str:
    x = src + c
    kind = NUMERIC_TYPES.get(c)
    if kind == "int":
        return f"{int_via_float(x)} AS {c}"
    if kind == "float":
        return f"CASE WHEN regexp_matches({x}, {lit(NUM_RE)}) THEN TRY_CAST(trim({x}) AS DECIMAL(10,2)) END AS {c}"
    return f"{x} AS {c}"


def parse_date(x: str) -> str:
    return f"CAST(TRY_CAST({x} AS TIMESTAMP) AS DATE)"


TYPED = ("typed AS (SELECT " + ", ".join(
    f"{parse_date('date')} AS date" if c == "date" else _typed_col(c) for c in SALES_COLUMNS)
    + ", TRY_CAST(trim(state_bottle_cost) AS DOUBLE) AS cost_number"
    + ", TRY_CAST(trim(state_bottle_retail) AS DOUBLE) AS retail_number FROM filled)")

# money is tested before it is rounded to cents
CLEAN = (f"clean AS (SELECT {cols()} FROM typed WHERE date IS NOT NULL AND "
         + " AND ".join(f"{c} IS NOT NULL" for c in NUMERIC_TYPES)
         + " AND COALESCE(cost_number > 0 AND retail_number > 0 AND sale_bottles > 0, false))")

PRIORITY = ", ".join(f"{c} ASC NULLS FIRST" for c in ["date"] + [c for c in SALES_COLUMNS if c != "date"])


def first_per_key(src: str) -> str:
    return (f"SELECT {cols()} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY invoice_line_no "
            f"ORDER BY {PRIORITY}) AS rn FROM (SELECT * FROM {src}) s WHERE invoice_line_no IS NOT NULL) WHERE rn = 1")


STORED = f"stored AS ({first_per_key(f'clean WHERE date < DATE {lit(q.STORED_BEFORE)}')})"
BATCH = f"batch AS (SELECT * FROM clean WHERE date >= DATE {lit(q.RELOAD_FROM)})"
WINNERS = f"winners AS ({first_per_key('batch')})"

CTES = {"sales": SALES, "raw_sales": RAW, "filled": FILLED, "typed": TYPED, "clean": CLEAN,
        "stored": STORED, "batch": BATCH, "winners": WINNERS}
ORDER = list(CTES)


def with_(*needed: str, extra: str = "") -> str:
    """WITH clause holding the needed CTEs and everything they depend on."""
    last = max(ORDER.index(n) for n in needed)
    parts = [CTES[n] for n in ORDER[: last + 1]]
    if extra:
        parts.append(extra)
    return "WITH " + ",\n".join(parts) + "\n"


# --- text functions in SQL -----------------------------------------------------------------

def title(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({x}, '(\\p{{L}}+|\\P{{L}}+)', 1), "
            f"lambda r: upper(r[1]) || lower(r[2:])), '')")


def title_except_numbers(x: str) -> str:
    word_title = title("w")
    return (f"array_to_string(list_transform(list_filter(regexp_split_to_array({x}, '\\s+'), "
            f"lambda w: w <> ''), lambda w: CASE WHEN regexp_matches(w, '^\\d') THEN lower(w) "
            f"ELSE {word_title} END), ' ')")


def clean_address(x: str) -> str:
    out = f"regexp_replace({title_except_numbers(x)}, '[,.]', '', 'g') || ' '"
    for old, new in DIRECTIONS:
        out = f"replace({out}, {lit(old)}, {lit(new)})"
    return f"regexp_replace({out}, '\\s+$', '')"


def normalize_name(x: str) -> str:
    out = x
    for old, new in (("HY-VEE", "HY VEE"), ("C-STORE", "C STORE")):
        out = f"regexp_replace({out}, {lit(old)}, {lit(new)}, 'gi')"
    out = f"regexp_split_to_array({out}, '/|-')[1]"
    out = f"regexp_replace({out}, '[0-9#()]+', '', 'g')"
    out = f"regexp_replace({out}, '^\\s+|\\s+$', '', 'g')"
    return f"regexp_replace({out}, '\\s+', ' ', 'g')"


def classify(x: str) -> str:
    whens = [f"WHEN contains(lower({x}), {lit(k.lower())}) THEN {lit(v)}" for k, v in STORE_FORMATS]
    whens.append(f"WHEN {x} = {lit(STORE_FORMAT_EXACT[0])} THEN {lit(STORE_FORMAT_EXACT[1])}")
    values = sorted({v.lower() for _, v in STORE_FORMATS} | {STORE_FORMAT_EXACT[1].lower()})
    whens.append(f"WHEN lower({x}) IN ({', '.join(lit(v) for v in values)}) THEN {x}")
    return "CASE " + " ".join(whens) + f" ELSE {lit(STORE_FORMAT_DEFAULT)} END"


def liquor(x: str) -> str:
    whens = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in LIQUOR_TYPES.items())
    return (f"CASE WHEN {x} IS NULL THEN NULL ELSE (CASE substr(CAST({x} AS VARCHAR), 1, 3) "
            f"{whens} ELSE 'Other' END) END")


# --- model pieces -------------------------------------------------------------------------

def latest(src: str, key: str, order: list[str], payload: list[str]) -> str:
    ranks = order + [p for p in payload if p not in order]
    ob = ", ".join(f"{c} DESC NULLS LAST" for c in ranks)
    return (f"SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY {ob}) AS rn "
            f"FROM {src}) WHERE rn = 1")


def dim_stores(src: str = "clean") -> str:
    inner = latest(src, "store", ["date", "invoice_line_no", "itemno"],
                   ["name", "address", "zipcode", "city", "county"])
    return (f"SELECT store AS store_id, name AS store_name, address, CAST(zipcode AS VARCHAR) AS zipcode, "
            f"city, county FROM ({inner})")


def dim_items(src: str = "clean") -> str:
    inner = latest(src, "itemno", ["date", "invoice_line_no", "itemno"],
                   ["im_desc", "category", "category_name", "vendor_name"])
    return (f"SELECT itemno AS item_id, im_desc AS item_name, category AS category_code, "
            f"category_name AS category, vendor_name AS vendor FROM ({inner})")


FACT = ("SELECT invoice_line_no AS invoice_line_id, date, store AS store_id, itemno AS item_id, "
        "bottle_volume_ml, state_bottle_cost AS bottle_cost, state_bottle_retail AS bottle_price, "
        "sale_bottles FROM clean")


def calendar_span(src: str = "sales") -> str:
    return (f"span AS (SELECT CAST(date_trunc('year', MIN(date)) AS DATE) AS start, "
            f"CAST(date_trunc('year', MAX(date)) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS stop FROM {src}), "
            f"series AS (SELECT CAST(datediff('day', start, d) AS BIGINT) AS date_id, d AS date FROM "
            f"(SELECT start, CAST(unnest(generate_series(start, stop, INTERVAL 1 DAY)) AS DATE) AS d FROM span))")


def fixed_series(start: str, end: str) -> str:
    return (f"series AS (SELECT CAST(datediff('day', DATE {lit(start)}, d) AS BIGINT) AS date_id, d AS date "
            f"FROM (SELECT CAST(unnest(generate_series(DATE {lit(start)}, DATE {lit(end)}, "
            f"INTERVAL 1 DAY)) AS DATE) AS d))")


ATTRS = """CAST(year(date) AS INTEGER) AS year,
  monthname(date) AS month,
  strftime(date, '%m') AS month_of_year,
  CAST(day(date) AS INTEGER) AS day_of_month,
  dayname(date) AS day,
  CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week,
  CASE WHEN dayname(date) IN ('Saturday', 'Sunday') THEN 'Weekend' ELSE 'Weekday' END AS weekend,
  CAST(dayofyear(date) AS INTEGER) AS day_of_year,
  lpad(CAST((dayofyear(date - CAST(dayofweek(date) AS INTEGER)) - 1) // 7 + 1 AS VARCHAR), 2, '0') AS week_of_year,
  CAST(quarter(date) AS INTEGER) AS quarter,
  CAST(date - 1 AS DATE) AS previous_day,
  CAST(date + 1 AS DATE) AS next_day"""

FISCAL = """CAST(CASE WHEN month(date) >= 7 THEN year(date) + 1 ELSE year(date) END AS INTEGER) AS financial_year,
  CAST(CASE WHEN month(date) BETWEEN 7 AND 9 THEN 1 WHEN month(date) BETWEEN 10 AND 12 THEN 2
            WHEN month(date) BETWEEN 1 AND 3 THEN 3 ELSE 4 END AS INTEGER) AS financial_quarter"""

CALENDAR = f"SELECT date_id, date, {ATTRS}, {FISCAL} FROM series"


def fy_expr(x: str = "date") -> str:
    return f"CAST(CASE WHEN month({x}) >= 7 THEN year({x}) + 1 ELSE year({x}) END AS INTEGER)"


def metrics_sql() -> str:
    gal = "3785.411784"
    return f"""fact AS ({FACT}),
m1 AS (SELECT *,
  TRY_CAST(bottle_price - bottle_cost AS DECIMAL(10,2)) AS bottle_profit,
  TRY_CAST(bottle_price * sale_bottles AS DECIMAL(10,2)) AS revenue,
  TRY_CAST((bottle_price - bottle_cost) * sale_bottles AS DECIMAL(10,2)) AS profit,
  TRY_CAST(bottle_cost * sale_bottles AS DECIMAL(10,2)) AS cost,
  {scaled(half_up(f"CAST(bottle_volume_ml AS BIGINT) * sale_bottles * 100000000", "3785411784"), 2, "DECIMAL(10,2)")} AS sale_gallons,
  {scaled(half_up(f"CAST(bottle_volume_ml AS BIGINT) * sale_bottles * 100", "1000"), 2, "DECIMAL(10,2)")} AS sale_liters
  FROM fact),
m2 AS (SELECT *,
  {div_round("profit", 2, "revenue", 2, 4, "DECIMAL(10,4)")} AS margin,
  {div_round("cost", 2, "sale_gallons", 2, 2, "DECIMAL(10,2)")} AS gallon_cost,
  {div_round("revenue", 2, "sale_gallons", 2, 2, "DECIMAL(10,2)")} AS gallon_price,
  {div_round("profit", 2, "sale_gallons", 2, 2, "DECIMAL(10,2)")} AS gallon_profit,
  {div_round("cost", 2, "sale_liters", 2, 2, "DECIMAL(10,2)")} AS liter_cost,
  {div_round("revenue", 2, "sale_liters", 2, 2, "DECIMAL(10,2)")} AS liter_price,
  {div_round("profit", 2, "sale_liters", 2, 2, "DECIMAL(10,2)")} AS liter_profit
  FROM m1)"""


def fmt_duration(secs: str) -> str:
    h = f"CAST(floor({secs} / 3600) AS BIGINT)"
    m = f"CAST(floor(({secs} - {h} * 3600) / 60) AS BIGINT)"
    s = f"CAST({secs} - {h} * 3600 - {m} * 60 AS DOUBLE)"
    return f"printf('%02d:%02d:%06.3f', {h}, {m}, {s})"


def _unpivot_text(src: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT {lit(c)} AS column_name, CAST({c} AS VARCHAR) AS value FROM {src}" for c in columns)


# --- the statements ----------------------------------------------------------------------------

def build() -> dict[str, str]:
    s: dict[str, str] = {}
    month_start, month_end = (f"{q.SLICE_MONTH[0]:04d}-{q.SLICE_MONTH[1]:02d}-01",
                              "1999-01-01")
    s["select_sales"] = with_("sales") + f"SELECT {cols()} FROM sales"
    mix_name = (f"CASE WHEN store % 10 = 0 THEN {lit(demo.OTHER_RETAILER)} || CAST(store AS VARCHAR) || ' / ' || city "
                f"WHEN store % 10 = 5 THEN lower(name) ELSE name END")
    s["filter_retailer"] = with_("sales") + (
        f"SELECT * FROM (SELECT * REPLACE ({mix_name} AS name) FROM sales) "
        f"WHERE lower(name) LIKE '%hy-vee%' OR name LIKE '%WALL TO WALL WINE AND SPIRITS%'")
    s["slice_month"] = with_("sales") + (
        f"SELECT * FROM sales WHERE date >= DATE {lit(month_start)} AND date < DATE {lit(month_end)}")
    s["slice_fiscal_year"] = with_("sales") + (
        f"SELECT * FROM sales WHERE date >= DATE '{q.SLICE_FY - 1}-07-01' AND date < DATE '{q.SLICE_FY}-07-01'")
    ranges = []
    for y, m in q.WINDOWS:
        start = f"{y:04d}-{m:02d}-01"
        end = f"{y + 1:04d}-01-01" if m == 12 else f"{y:04d}-{m + 1:02d}-01"
        ranges.append(f"(date >= DATE '{start}' AND date < DATE '{end}')")
    s["extract_windows"] = with_("sales") + f"SELECT * FROM sales WHERE {' OR '.join(ranges)}"
    s["raw_sales_roundtrip"] = with_("raw_sales") + f"SELECT {cols()} FROM raw_sales"
    s["read_store_names"] = with_("clean") + f"SELECT store_id, store_name FROM ({dim_stores()})"
    csv_cols = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if SQL_TYPES[c].startswith("DECIMAL") else c
                         for c in SALES_COLUMNS)
    s["csv_roundtrip"] = with_("clean") + f"SELECT {csv_cols} FROM clean"

    # load
    s["append_new_rows"] = with_("winners") + (
        "SELECT w.* FROM winners w WHERE NOT EXISTS "
        "(SELECT 1 FROM stored t WHERE t.invoice_line_no = w.invoice_line_no)")
    on = " AND ".join(f"c.{c} IS NOT DISTINCT FROM w.{c}" for c in SALES_COLUMNS)
    kept = ("CASE WHEN invoice_line_no IS NOT NULL AND is_win AND NOT is_stored THEN 1 ELSE 0 END")
    s["skipped_duplicates"] = with_("winners", extra=(
        f"copies AS (SELECT {cols()}, COUNT(*) AS copies FROM batch GROUP BY ALL), "
        f"marked AS (SELECT {cols('c.')}, c.copies, "
        f"EXISTS (SELECT 1 FROM stored t WHERE t.invoice_line_no = c.invoice_line_no) AS is_stored, "
        f"w.invoice_line_no IS NOT NULL AS is_win FROM copies c LEFT JOIN winners w ON {on})")) + (
        f"SELECT {cols()}, CAST(copies - {kept} AS BIGINT) AS copies, "
        f"CASE WHEN invoice_line_no IS NULL THEN 'null key' WHEN is_win AND is_stored THEN 'key already stored' "
        f"ELSE 'duplicate key in batch' END AS reason FROM marked WHERE copies - {kept} > 0")
    s["load_layers"] = with_("clean") + (
        "SELECT layer, CAST(0 AS BIGINT) AS rows_before, "
        "(SELECT COUNT(DISTINCT invoice_line_no) FROM clean) AS rows_after "
        "FROM (VALUES ('staging'), ('integration')) v(layer)")

    # placeholders / numeric types (also the lookup round trip)
    ph = placeholders_sql("raw_sales")
    nt = numeric_types_sql("filled")
    s["derive_placeholders"] = with_("raw_sales") + ph
    s["infer_numeric_types"] = with_("filled") + nt
    pos = "CAST(list_position([" + ", ".join(lit(c) for c in SALES_COLUMNS) + "], column_name) - 1 AS INTEGER)"
    s["lookup_roundtrip"] = with_("filled") + (
        f"SELECT 'placeholders' AS dictionary, {pos} AS pos, column_name AS key, placeholder AS value FROM ({ph}) "
        f"UNION ALL SELECT 'num_col_dtype_map', {pos}, column_name, dtype FROM ({nt})")

    s["dictionary_roundtrip"] = with_("filled") + (
        "SELECT dictionary, CAST(ROW_NUMBER() OVER (PARTITION BY dictionary ORDER BY pos) - 1 AS INTEGER) AS pos, key, value FROM ("
        f"SELECT 'placeholders' AS dictionary, {pos} AS pos, column_name AS key, placeholder AS value FROM ({ph}) "
        f"UNION ALL SELECT 'num_col_dtype_map', {pos}, column_name, dtype FROM ({nt}))")
    gaps = ("gaps AS (SELECT * REPLACE (CASE WHEN CAST(store AS INTEGER) % 7 = 1 THEN NULL ELSE vendor_no END AS vendor_no, "
            "CASE WHEN CAST(itemno AS INTEGER) % 11 = 2 THEN NULL ELSE category END AS category, "
            "CASE WHEN CAST(store AS INTEGER) % 5 = 3 THEN NULL ELSE county END AS county) FROM raw_sales)")
    refilled = ("refilled AS (SELECT " + ", ".join(
        f"COALESCE({c}, (SELECT placeholder FROM ph WHERE column_name = {lit(c)})) AS {c}" if c in DIMENSION_COLUMNS else c
        for c in SALES_COLUMNS) + " FROM gaps)")
    s["clean_with_derived"] = with_("raw_sales", extra=",\n".join((
        gaps, f"ph AS ({placeholders_sql('gaps')})", refilled,
        TYPED.replace("typed AS", "retyped AS").replace("FROM filled)", "FROM refilled)"),
        CLEAN.replace("clean AS", "recleaned AS").replace("FROM typed ", "FROM retyped ")))) + f"SELECT {cols()} FROM recleaned"
    s["reset_model"] = with_("clean") + (
        f"SELECT 'stores' AS table_name, true AS dropped, CAST(NULL AS BIGINT) AS n_rows UNION ALL "
        f"SELECT 'items', false, (SELECT COUNT(*) FROM ({dim_items()})) UNION ALL SELECT 'never_built', false, NULL")
    s["replace_column"] = with_("sales") + (
        "SELECT * REPLACE (upper(city) AS city), CAST(length(upper(city)) AS INTEGER) AS city_length FROM sales")
    row_text = ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '')" for c in SALES_COLUMNS)
    s["sample_n"] = with_("sales") + (
        f"SELECT * FROM sales ORDER BY md5(concat_ws('|', '42', {row_text})), "
        + ", ".join(f"{c} ASC NULLS FIRST" for c in SALES_COLUMNS) + " LIMIT 100")

    # schema and constraints
    conform_cols = []
    for c in SALES_COLUMNS:
        t = SQL_TYPES[c]
        if c == "date":
            conform_cols.append((f"{parse_date('date')}", c))
        elif t == "VARCHAR":
            conform_cols.append((c, c))
        else:
            conform_cols.append((f"TRY_CAST({c} AS {t})", c))
    rejected = " OR ".join(f"({c} IS NOT NULL AND {e} IS NULL)" for e, c in conform_cols)
    s["conform_sales"] = with_("raw_sales") + (
        "SELECT " + ", ".join(f"{e} AS {c}" for e, c in conform_cols)
        + f", COALESCE({rejected}, false) AS _rejected FROM raw_sales")
    type_names = {"VARCHAR": "string", "DATE": "date", "INTEGER": "int", "DECIMAL(10,2)": "decimal(10,2)"}
    schema_rows = ", ".join(f"({i + 1}, {lit(c)}, {lit(type_names[SQL_TYPES[c]])})"
                            for i, c in enumerate(SALES_COLUMNS))
    s["create_like"] = with_("clean") + (
        f"SELECT CAST(v.position AS INTEGER) AS position, v.column_name, v.data_type, l.layer, l.n_rows "
        f"FROM (VALUES {schema_rows}) v(position, column_name, data_type), "
        f"(SELECT 'staging' AS layer, (SELECT COUNT(DISTINCT invoice_line_no) FROM clean) AS n_rows "
        f"UNION ALL SELECT 'integration', CAST(0 AS BIGINT)) l")
    s["check_unique_sales"] = with_("sales") + (
        "SELECT invoice_line_no, COUNT(*) AS n_rows FROM sales GROUP BY invoice_line_no HAVING COUNT(*) > 1")
    fy_lo, fy_hi = f"{q.DIM_FY - 1}-07-01", f"{q.DIM_FY}-07-01"
    earlier = f"(SELECT * FROM clean WHERE date >= DATE '{fy_lo}' AND date < DATE '{fy_hi}')"
    retailer = (f"(SELECT * FROM (SELECT * REPLACE ({mix_name} AS name) FROM clean) "
                f"WHERE lower(name) LIKE '%hy-vee%' OR name LIKE '%WALL TO WALL WINE AND SPIRITS%')")
    s["check_fk_store"] = with_("clean") + (
        f"SELECT store_id, COUNT(*) AS orphan_rows FROM ({FACT}) f WHERE store_id IS NOT NULL AND store_id NOT IN "
        f"(SELECT store_id FROM ({dim_stores(retailer)})) GROUP BY store_id")
    s["check_fk_item"] = with_("clean") + (
        f"SELECT item_id, COUNT(*) AS orphan_rows FROM ({FACT}) f WHERE item_id IS NOT NULL AND item_id NOT IN "
        f"(SELECT item_id FROM ({dim_items(earlier)})) GROUP BY item_id")
    s["check_fk_calendar"] = with_("clean", extra=fixed_series(*q.FK_CALENDAR)) + (
        f"SELECT date, COUNT(*) AS orphan_rows FROM ({FACT}) f WHERE date IS NOT NULL AND date NOT IN "
        f"(SELECT date FROM series) GROUP BY date")
    nn = " UNION ALL ".join(
        f"SELECT {lit(c)} AS column_name, CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_rows FROM cal"
        for c in q.NOT_NULL_CALENDAR)
    s["check_not_null_calendar"] = with_("sales", extra=calendar_span() + f", cal AS ({CALENDAR})") + nn
    items = dim_items()
    s["update_from_category"] = with_("clean") + f"SELECT *, {liquor('category_code')} AS liquor_type FROM ({items})"

    # profiling
    dup = ", ".join(q.DUP_COLUMNS)
    s["duplicate_stats"] = with_("sales") + (
        f"SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) AS n_rows, CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS dup_rows, "
        f"{percent('SUM(n - 1)', 'SUM(n)')} AS pct_dup FROM (SELECT {dup}, COUNT(*) AS n FROM sales GROUP BY ALL)")
    s["drop_full_duplicates"] = with_("sales") + f"SELECT DISTINCT {dup} FROM sales"
    copied = "copied AS (SELECT * FROM sales UNION ALL SELECT * FROM sales WHERE store % 10 = 3)"
    s["duplicate_rows"] = with_("sales", extra=copied) + (
        f"SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) AS n_rows, CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS dup_rows, "
        f"{percent('SUM(n - 1)', 'SUM(n)')} AS pct_dup FROM (SELECT {cols()}, COUNT(*) AS n FROM copied GROUP BY ALL)")
    s["distinct_rows"] = with_("sales", extra=copied) + f"SELECT DISTINCT {cols()} FROM copied"
    s["key_collisions"] = with_("sales") + (
        "SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) AS key_collision_rows FROM "
        "(SELECT COUNT(*) AS n FROM sales GROUP BY invoice_line_no HAVING COUNT(*) > 1)")
    mv = " UNION ALL ".join(
        f"SELECT {lit(c)} AS column_name, CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS missing_values, "
        f"{percent(f'COUNT(*) FILTER (WHERE {c} IS NULL)', 'COUNT(*)')} AS pct_of_total FROM sales"
        for c in SALES_COLUMNS)
    s["missing_values"] = with_("sales") + f"SELECT * FROM ({mv}) WHERE missing_values > 0"
    s["date_castable"] = with_("raw_sales") + (
        "SELECT COALESCE(bool_and(date IS NULL OR TRY_CAST(date AS TIMESTAMP) IS NOT NULL), true) AS date_castable "
        "FROM raw_sales")
    desc = []
    for c in MEASURE_COLUMNS:
        v = f"CAST({c} AS DECIMAL(38,6))"
        desc.append(
            f"SELECT {lit(c)} AS column_name, COUNT({c}) AS count, "
            f"{div_round(f'SUM({v})', 6, f'COUNT({c})', 0, 4, 'DECIMAL(38,4)')} AS mean, "
            f"CAST(stddev_samp(CAST({c} AS DOUBLE)) AS DECIMAL(38,4)) AS std, "
            f"CAST(MIN({c}) AS DECIMAL(38,4)) AS min, "
            f"CAST(quantile_cont(CAST({c} AS DOUBLE), 0.25) AS DECIMAL(38,4)) AS p25, "
            f"CAST(quantile_cont(CAST({c} AS DOUBLE), 0.5) AS DECIMAL(38,4)) AS p50, "
            f"CAST(quantile_cont(CAST({c} AS DOUBLE), 0.75) AS DECIMAL(38,4)) AS p75, "
            f"CAST(MAX({c}) AS DECIMAL(38,4)) AS max FROM sales")
    s["describe_measures"] = with_("sales") + " UNION ALL ".join(desc)
    s["pct_negative"] = with_("sales") + (
        f"SELECT {percent('COUNT(*) FILTER (WHERE sale_bottles < 0)', 'COUNT(*)')} AS pct_negative FROM sales")
    s["filter_non_negative"] = with_("sales") + "SELECT * FROM sales WHERE sale_bottles >= 0"
    num = []
    for c in MEASURE_COLUMNS:
        d = f"CASE WHEN regexp_matches({c}, {lit(NUM_RE)}) THEN TRY_CAST(trim({c}) AS DOUBLE) END"
        num.append(f"CAST(trunc({d}) AS BIGINT) AS {c}" if NUMERIC_TYPES[c] == "int" else f"{d} AS {c}")
    s["to_numeric"] = with_("raw_sales") + f"SELECT invoice_line_no, {', '.join(num)} FROM raw_sales"
    stores_fmt = f"SELECT *, {classify(normalize_name('store_name'))} AS store_format FROM ({dim_stores()})"
    s["distinct_store_format"] = with_("clean") + f"SELECT DISTINCT store_format FROM ({stores_fmt})"
    s["names_with_slash"] = with_("clean") + (
        f"SELECT DISTINCT store_name FROM ({dim_stores()}) WHERE contains(store_name, '/')")
    s["preview_sales"] = with_("sales") + (
        "SELECT * FROM sales ORDER BY " + ", ".join(f"{c} ASC NULLS FIRST" for c in SALES_COLUMNS) + " LIMIT 5")
    s["row_count"] = with_("sales") + f"SELECT COUNT(*) AS n_rows, CAST({len(SALES_COLUMNS)} AS INTEGER) AS n_columns FROM sales"
    s["category_pairs"] = with_("clean") + (
        f"SELECT DISTINCT category_code, category FROM ({items}) ORDER BY category_code, category")

    # cleaning
    s["fill_placeholders"] = with_("filled") + f"SELECT {cols()} FROM filled"
    s["normalize_date"] = with_("raw_sales") + f"SELECT * REPLACE ({parse_date('date')} AS date) FROM raw_sales"
    s["cast_by_map"] = with_("raw_sales") + (
        "SELECT " + ", ".join(_typed_col(c) for c in SALES_COLUMNS) + " FROM raw_sales")
    s["filter_positive"] = with_("sales") + (
        "SELECT * FROM sales WHERE COALESCE(state_bottle_cost > 0 AND state_bottle_retail > 0 AND sale_bottles > 0, false)")
    s["clean_sales"] = with_("clean") + f"SELECT {cols()} FROM clean"

    # incremental windows
    s["high_water_mark"] = with_("stored") + "SELECT MAX(date) AS high_water_mark FROM stored"
    cutoff = f"DATE {lit(q.STORED_BEFORE)}"
    marks_resume = (f"marks AS (SELECT MAX(CASE WHEN date < {cutoff} THEN date END) AS hwm, "
                    f"CAST(MAX(date) + 1 AS DATE) AS run_date FROM clean)")
    marks_initial = "marks AS (SELECT CAST(NULL AS DATE) AS hwm, CAST(MAX(date) + 1 AS DATE) AS run_date FROM clean)"
    win = ("bounds AS (SELECT CASE WHEN hwm IS NULL THEN make_date(CAST(year(run_date) - "
           "CASE WHEN month(run_date) < 7 THEN 4 ELSE 3 END AS BIGINT), 7, 1) "
           "ELSE CAST(date_trunc('month', hwm) + INTERVAL 1 MONTH AS DATE) END AS first_m, "
           "CAST(date_trunc('month', run_date) - INTERVAL 1 MONTH AS DATE) AS last_m FROM marks), "
           "months AS (SELECT CAST(unnest(generate_series(first_m, last_m, INTERVAL 1 MONTH)) AS DATE) AS window_start "
           "FROM bounds WHERE first_m <= last_m)")
    win_select = ("SELECT CAST(year(window_start) AS INTEGER) AS year, CAST(month(window_start) AS INTEGER) AS month, "
                  "window_start, CAST(window_start + INTERVAL 1 MONTH AS DATE) AS window_end FROM months")
    s["windows_resume"] = with_("clean", extra=marks_resume + ", " + win) + win_select
    s["extract_due_months"] = with_("clean", extra=marks_resume + ", " + win) + (
        "SELECT c.* FROM clean c WHERE date_trunc('month', c.date) IN (SELECT window_start FROM months)")
    s["windows_initial"] = with_("clean", extra=marks_initial + ", " + win) + win_select
    s["incremental_load"] = with_("stored", extra=(
        "b AS (SELECT CAST(date_trunc('month', (SELECT MAX(date) FROM stored)) + INTERVAL 1 MONTH AS DATE) AS lo, "
        "CAST(date_trunc('month', (SELECT MAX(date) FROM clean) + 1) AS DATE) AS hi), "
        "inc AS (SELECT c.* FROM clean c, b WHERE c.date >= b.lo AND c.date < b.hi), "
        f"w AS ({first_per_key('inc')})")) + (
        "SELECT * FROM w WHERE NOT EXISTS (SELECT 1 FROM stored t WHERE t.invoice_line_no = w.invoice_line_no)")

    # calendar
    s["number_series"] = with_("sales", extra=(
        "digits AS (SELECT * FROM (VALUES (0),(1),(2),(3),(4),(5),(6),(7),(8),(9)) t(n)), "
        "numbers AS (SELECT th.n * 1000 + h.n * 100 + t.n * 10 + o.n AS number "
        "FROM digits th, digits h, digits t, digits o)")) + (
        "SELECT CAST(number AS BIGINT) AS number FROM numbers "
        "WHERE number <= (SELECT datediff('day', MIN(date), MAX(date)) FROM sales)")
    s["date_series"] = with_("sales", extra=calendar_span()) + "SELECT date_id, date FROM series"
    s["calendar_attributes"] = with_("sales", extra=calendar_span()) + f"SELECT date_id, date, {ATTRS} FROM series"
    s["calendar_fiscal"] = with_("sales", extra=calendar_span()) + f"SELECT date_id, date, {FISCAL} FROM series"
    s["calendar"] = with_("sales", extra=calendar_span()) + CALENDAR

    # model
    s["dim_stores"] = with_("clean") + dim_stores()
    s["dim_items"] = with_("clean") + items
    s["dim_stores_merged"], s["dim_items_merged"] = s["dim_stores"], s["dim_items"]
    s["distinct_items"] = with_("clean") + (
        "SELECT DISTINCT itemno AS item_id, im_desc AS item_name, category AS category_code, "
        "category_name AS category, vendor_name AS vendor FROM clean ORDER BY 1, 2, 3, 4, 5")
    s["fact_transactions"] = with_("clean") + FACT
    s["build_model_counts"] = with_("clean", extra=calendar_span("clean")) + (
        "SELECT 'calendar' AS table_name, COUNT(*) AS n_rows FROM series "
        f"UNION ALL SELECT 'stores', COUNT(*) FROM ({dim_stores()}) "
        f"UNION ALL SELECT 'items', COUNT(*) FROM ({items}) "
        "UNION ALL SELECT 'transactions', COUNT(*) FROM clean "
        "UNION ALL SELECT 'fk_store', CAST(0 AS BIGINT) UNION ALL SELECT 'fk_item', CAST(0 AS BIGINT) "
        "UNION ALL SELECT 'fk_date', CAST(0 AS BIGINT)")

    # features
    s["store_name_normalized"] = with_("sales") + (
        f"SELECT name, {normalize_name('name')} AS normalized FROM (SELECT DISTINCT name FROM sales)")
    s["classify_store_format"] = with_("sales") + (
        f"SELECT normalized, {classify('normalized')} AS store_format FROM "
        f"(SELECT DISTINCT {normalize_name('name')} AS normalized FROM (SELECT DISTINCT name FROM sales))")
    by_order = " ".join(f"WHEN contains(lower(normalized), {lit(k.lower())}) THEN {lit(v)}" for k, v in STORE_FORMATS)
    kept = ", ".join(lit(v.lower()) for v in sorted({v for _, v in STORE_FORMATS}))
    s["classify_by_dictionary"] = with_("sales") + (
        f"SELECT normalized, CASE {by_order} WHEN lower(normalized) IN ({kept}) THEN normalized ELSE {lit(STORE_FORMAT_DEFAULT)} END "
        f"AS store_format FROM (SELECT DISTINCT {normalize_name('name')} AS normalized FROM (SELECT DISTINCT name FROM sales))")
    s["store_format"] = with_("clean") + stores_fmt
    s["liquor_type_lookup"] = with_("sales") + (
        f"SELECT category, {liquor('category')} AS liquor_type FROM (SELECT DISTINCT category FROM sales)")
    s["liquor_type"] = with_("clean") + f"SELECT *, {liquor('category_code')} AS liquor_type FROM ({items})"
    s["title_case"] = with_("sales") + (
        f"SELECT city, county, address, {title('city')} AS city_title, {title('county')} AS county_title, "
        f"{title('address')} AS address_title FROM (SELECT DISTINCT city, county, address FROM sales)")
    s["address_title"] = with_("sales") + (
        f"SELECT address, {title_except_numbers('address')} AS address_words FROM (SELECT DISTINCT address FROM sales)")
    s["address_clean"] = with_("sales") + (
        f"SELECT address, {clean_address('address')} AS address_clean FROM (SELECT DISTINCT address FROM sales)")
    s["full_address"] = with_("clean") + (
        f"SELECT store_id, store_name, a AS address, zipcode, c AS city, {title('county')} AS county, "
        f"a || ', ' || c || ', IA ' || zipcode AS full_address FROM "
        f"(SELECT *, {clean_address('address')} AS a, {title('city')} AS c FROM ({dim_stores()}))")
    s["transaction_metrics"] = with_("clean", extra=metrics_sql()) + (
        "SELECT invoice_line_id, date, store_id, item_id, bottle_volume_ml, bottle_cost, bottle_price, sale_bottles, "
        "bottle_profit, gallon_cost, gallon_price, sale_gallons, gallon_profit, liter_cost, liter_price, "
        "sale_liters, liter_profit, cost, revenue, profit, margin FROM m2")

    # the mart as written
    s["mart_items"] = s["liquor_type"]
    s["mart_transactions"] = s["transaction_metrics"]
    s["mart_stores"] = with_("clean") + (
        f"SELECT store_id, store_name, a AS address, zipcode, c AS city, {title('county')} AS county, store_format, "
        f"a || ', ' || c || ', IA ' || zipcode AS full_address FROM "
        f"(SELECT *, {clean_address('address')} AS a, {title('city')} AS c FROM ({stores_fmt}))")

    s |= landing_sql(mix_name)

    # run log
    fy_counts = f"fy AS (SELECT {fy_expr()} AS financial_year, COUNT(*) AS n_rows FROM clean GROUP BY 1)"
    s["table_stats"] = with_("clean") + (
        "SELECT COUNT(*) AS record_count, MIN(date) AS data_start_date, MAX(date) AS data_end_date FROM clean")
    s["new_records"] = with_("clean", extra=fy_counts) + (
        "SELECT financial_year, record_count, CAST(COALESCE(record_count - LAG(record_count) OVER (ORDER BY financial_year), 0) AS BIGINT) "
        "AS new_records_added FROM (SELECT financial_year, CAST(SUM(n_rows) OVER (ORDER BY financial_year "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS record_count FROM fy)")
    secs = div_round(f"n_rows * CAST({lit(REFERENCE_RUN_SECONDS)} AS DECIMAL(10,3))", 3,
                     str(REFERENCE_RUN_ROWS), 0, 3, "DECIMAL(20,3)")
    s["format_duration"] = with_("clean", extra=fy_counts) + (
        f"SELECT financial_year, n_rows, secs AS reference_seconds, {fmt_duration('secs')} AS total_duration "
        f"FROM (SELECT *, {secs} AS secs FROM fy)")
    start, end = q.RUN_START, q.RUN_END
    dur = (end - start).total_seconds()
    s["run_log_row"] = with_("clean") + (
        f"SELECT DATE '{end.date().isoformat()}' AS execution_date, "
        f"TIMESTAMP '{start.isoformat(sep=' ')}' AS process_start_time, "
        f"TIMESTAMP '{end.isoformat(sep=' ')}' AS process_end_time, "
        f"{fmt_duration(f'CAST({dur!r} AS DECIMAL(20,6))')} AS total_duration, "
        "MIN(date) AS data_start_date, MAX(date) AS data_end_date, COUNT(*) AS record_count, "
        "CAST(0 AS BIGINT) AS new_records_added FROM clean")
    return s


def landing_sql(mix_name: str) -> dict[str, str]:
    """The shipped load run twice over one landing, by the rule of the load: other retailers' records
    are left out, untypable ones rejected, money tested unrounded, the first row of a key inserted."""
    spoil = {
        "date": f"CASE WHEN store % 23 = 1 THEN NULL WHEN store % 23 = 2 THEN 'soon' ELSE {_raw_col('date')[:-8]} END",
        "invoice_line_no": "CASE WHEN itemno % 41 = 3 THEN NULL ELSE invoice_line_no END",
        "state_bottle_cost": "CASE WHEN itemno % 29 = 4 THEN '0.004' WHEN itemno % 29 = 5 THEN 'dear' "
                             "ELSE CAST(state_bottle_cost AS VARCHAR) END",
        "sale_bottles": "CASE WHEN itemno % 31 = 6 THEN CAST(sale_bottles AS VARCHAR) || '.7' "
                        "ELSE CAST(sale_bottles AS VARCHAR) END"}
    spoiled = ", ".join(f"{spoil[c]} AS {c}" if c in spoil else _raw_col(c) for c in SALES_COLUMNS)
    whole = "invoice_line_no IS NOT NULL AND date IS NOT NULL AND " + " AND ".join(f"{c} IS NOT NULL" for c in NUMERIC_TYPES)
    reasons = ["WHEN invoice_line_no IS NULL THEN 'missing invoice_line_no'", "WHEN had_date IS NULL THEN 'missing date'",
               "WHEN date IS NULL THEN 'unparseable date'"]
    reasons += [f"WHEN {c} IS NULL THEN 'bad {c}'" for c in NUMERIC_TYPES]
    first_month = f"CAST(date_trunc('month', DATE {lit(q.STORED_BEFORE)}) AS DATE)"
    again_month = f"CAST(date_trunc('month', DATE {lit(q.RELOAD_FROM)}) AS DATE)"
    base = ["mixed AS (SELECT * REPLACE (" + mix_name + " AS name) FROM sales)",
            f"once AS (SELECT store % 10 = 3 AS twice, {spoiled} FROM mixed)",
            f"raw_sales AS (SELECT {cols()} FROM once UNION ALL SELECT {cols()} FROM once WHERE twice)",
            "ours AS (SELECT * FROM raw_sales WHERE lower(name) LIKE '%hy-vee%' OR name LIKE '%WALL TO WALL WINE AND SPIRITS%')",
            FILLED.replace("FROM raw_sales", "FROM ours"),
            TYPED.replace(" FROM filled)", ", date AS had_date FROM filled)"),
            f"good AS (SELECT {cols()} FROM typed WHERE {whole} AND cost_number > 0 AND retail_number > 0 AND sale_bottles > 0)",
            f"b1 AS (SELECT * FROM good WHERE date < {first_month})",
            f"b2 AS (SELECT * FROM good WHERE date >= {again_month})",
            f"w1 AS ({first_per_key('b1')})", f"w2 AS ({first_per_key('b2')})",
            "s1 AS (SELECT * FROM w1)",
            "s2 AS (SELECT * FROM w2 WHERE invoice_line_no NOT IN (SELECT invoice_line_no FROM s1))",
            "runs AS (SELECT strftime(MIN(date), '%Y-%m') AS lo, strftime(MAX(date), '%Y-%m') AS hi, "
            f"strftime({first_month} - 1, '%Y-%m') AS cut, strftime({again_month}, '%Y-%m') AS again FROM sales)",
            "named AS (SELECT lo || '..' || cut AS r1, again || '..' || hi AS r2 FROM runs)",
            "broken AS (SELECT COUNT(*) + COUNT(*) FILTER (store % 2 = 1) AS n FROM sales WHERE store % 19 = 7 AND itemno % 13 = 5)"]

    def full(select: str) -> str:
        return "WITH " + ",\n".join([SALES, *base]) + "\n" + select

    def skipped(batch: str, winners: str, inserted: str, run: str) -> str:
        on = " AND ".join(f"c.{c} IS NOT DISTINCT FROM w.{c}" for c in SALES_COLUMNS)
        stored = f"w.invoice_line_no IS NOT NULL AND w.invoice_line_no NOT IN (SELECT invoice_line_no FROM {inserted})"
        kept = f"CASE WHEN w.invoice_line_no IS NOT NULL AND NOT ({stored}) THEN 1 ELSE 0 END"
        return (f"SELECT (SELECT {run} FROM named) AS run, {cols('c.')}, CAST(c.copies - {kept} AS BIGINT) AS copies, "
                f"CASE WHEN {stored} THEN 'key already stored' ELSE 'duplicate key in batch' END AS reason "
                f"FROM (SELECT {cols()}, COUNT(*) AS copies FROM {batch} GROUP BY ALL) c LEFT JOIN {winners} w ON {on} "
                f"WHERE c.copies - {kept} > 0")

    # a record without a date belongs to every run and is kept by the first; a dated one to the runs of its month
    reason = f"CASE {' '.join(reasons)} END"
    in_run = {"r1": f"date < {first_month}", "r2": f"date >= {again_month}"}
    rejects = " UNION ALL ".join(
        f"SELECT '{r}' AS r, {reason} AS reject_reason, COUNT(*) AS n FROM typed WHERE NOT ({whole}) AND {scope} GROUP BY ALL"
        for r, scope in (("r1", f"(date IS NULL OR {in_run['r1']})"),
                         ("r2", f"NOT ({in_run['r1']}) AND {in_run['r2']}")))
    overlap = f"date >= {again_month} AND date < {first_month}"
    rejects += " UNION ALL SELECT 'r1', 'malformed record', n FROM broken WHERE n > 0"

    def outcomes(r: str, batch: str, inserted: str, new: str, old: str) -> str:
        loadable = f"(SELECT COUNT(*) FROM {batch})"
        dated = in_run[r]
        foreign = f"(SELECT COUNT(*) FROM foreign_dates WHERE date IS NULL OR {dated})"
        weak = f"(SELECT COUNT(*) FROM typed WHERE {whole} AND {dated}) - {loadable}"
        parts = {"inserted": f"(SELECT COUNT(*) FROM {inserted})", "skipped": f"{loadable} - (SELECT COUNT(*) FROM {inserted})",
                 "rejected": new, "rejected before": old, "other retailer": foreign, "not positive": weak}
        return " UNION ALL ".join(f"SELECT (SELECT {r} FROM named) AS run, '{o}' AS outcome, CAST({n} AS BIGINT) AS n_rows"
                                  for o, n in parts.items())

    kept = f"kept AS ({rejects})"
    total = {r: f"(SELECT COALESCE(SUM(n), 0) FROM kept WHERE r = '{r}')" for r in ("r1", "r2")}
    again = (f"(SELECT COUNT(*) FROM typed WHERE NOT ({whole}) AND (date IS NULL OR {overlap})) + (SELECT n FROM broken)")
    theirs = ("foreign_dates AS (SELECT " + parse_date("date") + " AS date FROM raw_sales WHERE NOT "
              "(COALESCE(lower(name) LIKE '%hy-vee%' OR name LIKE '%WALL TO WALL WINE AND SPIRITS%', false)))")
    base += [kept, theirs]
    return {"load_landing": full(f"SELECT {cols()} FROM s1 UNION ALL SELECT {cols()} FROM s2"),
            "load_rejects": full("SELECT CASE r WHEN 'r1' THEN r1 ELSE r2 END AS run, reject_reason, "
                                 "CAST(SUM(n) AS BIGINT) AS n_rows FROM kept, named GROUP BY ALL"),
            "check_not_null_landed": full(" UNION ALL ".join(
                f"SELECT '{c}' AS column_name, COUNT(*) FILTER ({c} IS NULL) AS null_rows FROM raw_sales" for c in SALES_COLUMNS)),
            "apply_defaults_landed": full("SELECT " + ", ".join(
                f"COALESCE({c}, {lit(q.LANDED_DEFAULTS[c])}) AS {c}" if c in q.LANDED_DEFAULTS else c for c in SALES_COLUMNS)
                + " FROM raw_sales"),
            "load_account": full(outcomes("r1", "b1", "s1", total["r1"], "0") + " UNION ALL "
                                 + outcomes("r2", "b2", "s2", total["r2"], again)),
            "incremental_stream": full(first_per_key("good")),
            "load_skipped": full(skipped("b1", "w1", "s1", "r1") + " UNION ALL " + skipped("b2", "w2", "s2", "r2"))}


def placeholders_sql(src: str) -> str:
    long = _unpivot_text(src, DIMENSION_COLUMNS)
    is_int = f"(regexp_matches(value, '^\\s*[+-]?\\d+\\s*$') AND TRY_CAST(trim(value) AS BIGINT) IS NOT NULL)"
    return (
        f"SELECT column_name, CASE WHEN bad IS NOT NULL OR best IS NULL THEN 'UNKNOWN' ELSE repeat('9', best) END AS placeholder "
        f"FROM (SELECT column_name, SUM(CASE WHEN kind = 2 THEN n END) AS bad, "
        f"arg_min(digits, (CASE WHEN kind = 1 THEN -n END, digits)) FILTER (WHERE kind = 1) AS best FROM "
        f"(SELECT column_name, kind, digits, COUNT(*) AS n FROM "
        f"(SELECT column_name, CASE WHEN value IS NULL THEN 0 WHEN {is_int} THEN 1 ELSE 2 END AS kind, "
        f"CASE WHEN {is_int} THEN length(CAST(TRY_CAST(trim(value) AS BIGINT) AS VARCHAR)) END AS digits "
        f"FROM ({long})) GROUP BY ALL) GROUP BY column_name)")


def numeric_types_sql(src: str) -> str:
    text_cols = [c for c in SALES_COLUMNS if c != "date"]
    long = _unpivot_text(src, text_cols)
    num = f"(value IS NOT NULL AND regexp_matches(value, {lit(NUM_RE)}))"
    whole = f"COALESCE(TRY_CAST(trim(value) AS DOUBLE) % 1 = 0 AND {num}, false)"
    return (f"SELECT column_name, CASE WHEN whole THEN 'int' ELSE 'float' END AS dtype FROM "
            f"(SELECT column_name, bool_and({num}) AS numeric, bool_and({whole}) AS whole FROM ({long}) "
            f"GROUP BY column_name) WHERE numeric")


ORACLE: dict[str, str] = build()
