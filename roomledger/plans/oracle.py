"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL re-derives everything from the driver tables (``orders``, ``customer``, ``nation``) with
plain SQL constructs: the adapter, silver, the star schema with ``ROW_NUMBER`` keys, the views and
the checks. Dialect notes (Spark vs DuckDB) that the SQL spells out:

* NULL ordering is written explicitly (``NULLS LAST``), null-safe equality is
  ``IS NOT DISTINCT FROM``;
* integer sums are cast to BIGINT (DuckDB widens to HUGEINT), keys to the declared widths;
* Spark rounds a double half-up on its shortest decimal text; DuckDB rounds the binary value, so
  rounded doubles go through ``DECIMAL(38,10)`` here to round the same decimal text;
* money is summed as exact decimals; only means are rounded.
"""

from __future__ import annotations

from roomledger.schema import (
    BOOKING_ORDER,
    DECIMAL_COLUMNS,
    EXPECTED_MIN_ROWS,
    FACT_KEYS,
    FACT_MEASURES,
    INTEGER_COLUMNS,
    LEAD_TIME_BANDS,
    MISSING_TOKENS,
    MONTH_NAMES,
    OPEN_LEAD_TIME_BAND,
    RAW_COLUMNS,
    SILVER_COLUMNS,
    TEXT_COLUMNS,
)

# Spelled out here, so that the oracle does not follow the engine's own rules.
NUMERIC_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
BLANK_PATTERN = r"^\s*$"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def r2(expr: str) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,10)), 2) AS DOUBLE)"


def sum_where(pred: str) -> str:
    return f"CAST(SUM(CASE WHEN {pred} THEN 1 ELSE 0 END) AS BIGINT)"


def count_where(pred: str) -> str:
    return f"CAST(COALESCE(SUM(CASE WHEN {pred} THEN 1 ELSE 0 END), 0) AS BIGINT)"


def percent(part: str, whole: str) -> str:
    return r2(f"CAST(100.0 AS DOUBLE) * {part} / NULLIF({whole}, 0)")


def mean2(x: str) -> str:
    return r2(f"SUM(CAST({x} AS DOUBLE)) / NULLIF(COUNT({x}), 0)")


def money_sum(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(28,10))) AS DOUBLE)"


def money_mean2(x: str) -> str:
    # Rounded half away from zero in whole numbers: DuckDB divides decimals as doubles.
    total = f"SUM(CAST(CAST({x} AS DECIMAL(28,10)) * 10000000000 AS HUGEINT))"
    unit = f"(NULLIF(COUNT({x}), 0) * 10000000000::HUGEINT)"
    return f"CAST(sign({total}) * ((abs({total}) * 200 + {unit}) // (2 * {unit})) AS DOUBLE) / 100.0"


def _whole_number(x: str) -> str:
    d = f"TRY_CAST({x} AS DOUBLE)"
    return (
        f"CASE WHEN regexp_matches({x}, {lit(NUMERIC_PATTERN)}) THEN "
        f"(CASE WHEN {d} = floor({d}) THEN CAST({d} AS BIGINT) ELSE error('fractional value') END) END"
    )


def _double(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, {lit(NUMERIC_PATTERN)}) THEN TRY_CAST({x} AS DOUBLE) END"


def _blank(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, {lit(BLANK_PATTERN)}) THEN NULL ELSE {x} END"


_LETTER = "substr('ABCDEFGH', CAST({n} AS INTEGER), 1)"

ADAPTER = f"""
base AS (
  SELECT o.o_orderkey AS k, o.o_custkey AS ck, CAST(o.o_orderdate AS DATE) AS od,
         o.o_orderpriority AS opri, c.c_nationkey AS nk, c.c_mktsegment AS seg, n.n_name AS nname,
         CAST(ROUND(o.o_totalprice * 100) AS BIGINT) % 50000 AS cents,
         CASE WHEN o.o_orderstatus = 'F' OR o.o_orderkey % 1213 = 7 OR o.o_orderkey % 907 = 5 THEN 'Canceled'
              WHEN o.o_orderkey % 11 = 0 THEN 'No-Show' ELSE 'Check-Out' END AS status
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
),
adapted AS (
  SELECT k,
    CASE WHEN k % 1013 = 9 THEN '  ' WHEN k % 3 = 0 THEN 'City Hotel' ELSE 'Resort Hotel' END AS hotel,
    CASE WHEN k % 1511 = 3 THEN '' WHEN k % 1601 = 4 THEN '2' WHEN status = 'Check-Out' THEN '0' ELSE '1' END AS is_canceled,
    CASE WHEN k % 1301 = 6 THEN '' ELSE CAST((k * 37) % 400 AS VARCHAR) END AS lead_time,
    CAST(year(od) AS VARCHAR) AS arrival_date_year,
    CASE WHEN k % 1401 = 8 THEN 'Foo' WHEN k % 1451 = 2 THEN 'February' ELSE monthname(od) END AS arrival_date_month,
    CAST(weekofyear(od) AS VARCHAR) AS arrival_date_week_number,
    CASE WHEN k % 1451 = 2 THEN '31' ELSE CAST(day(od) AS VARCHAR) END AS arrival_date_day_of_month,
    CASE WHEN k % 1709 = 1 THEN '-9' ELSE CAST(k % 3 AS VARCHAR) END AS stays_in_weekend_nights,
    CAST(k % 5 AS VARCHAR) AS stays_in_week_nights,
    CASE WHEN k % 907 = 5 THEN '26' WHEN k % 1811 = 2 THEN '-1' ELSE CAST(k % 3 + 1 AS VARCHAR) END AS adults,
    CASE WHEN k % 1901 = 3 THEN 'abc' WHEN k % 13 = 0 THEN 'NA' ELSE CAST(k % 4 AS VARCHAR) || '.0' END AS children,
    CAST(k % 2 AS VARCHAR) AS babies,
    CASE k % 4 WHEN 0 THEN 'BB' WHEN 1 THEN 'HB' WHEN 2 THEN 'SC' ELSE 'Undefined' END AS meal,
    CASE WHEN k % 17 = 0 THEN 'NULL' ELSE nname END AS country,
    CASE WHEN k % 1201 = 5 THEN '' ELSE seg END AS market_segment,
    opri AS distribution_channel,
    CASE WHEN ck % 10 = 0 THEN '1' ELSE '0' END AS is_repeated_guest,
    CAST(k % 2 AS VARCHAR) AS previous_cancellations,
    CAST(k % 3 AS VARCHAR) AS previous_bookings_not_canceled,
    CASE WHEN k % 1103 = 4 THEN '' ELSE {_LETTER.format(n="k % 8 + 1")} END AS reserved_room_type,
    CASE WHEN k % 6 = 0 THEN {_LETTER.format(n="(k + 1) % 8 + 1")} ELSE {_LETTER.format(n="k % 8 + 1")} END AS assigned_room_type,
    CAST(k % 4 AS VARCHAR) AS booking_changes,
    CASE WHEN k % 9 = 0 THEN 'Non Refund' ELSE 'No Deposit' END AS deposit_type,
    CASE WHEN k % 7 = 0 THEN 'NULL' ELSE CAST(ck % 300 AS VARCHAR) END AS agent,
    CASE WHEN k % 19 <> 0 THEN 'NULL' ELSE CAST(ck % 200 AS VARCHAR) END AS company,
    CAST(k % 21 AS VARCHAR) AS days_in_waiting_list,
    CASE nk % 4 WHEN 0 THEN 'Transient' WHEN 1 THEN 'Contract' WHEN 2 THEN 'Transient-Party' ELSE 'Group' END AS customer_type,
    CASE WHEN k % 1009 = 3 THEN '-6.38' WHEN k % 1213 = 7 THEN '5400.0' WHEN k % 907 = 5 THEN '0.0'
         WHEN k % 1999 = 6 THEN ''
         WHEN k % 97 = 13 THEN CAST(cents // 100 AS VARCHAR) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') || '5'
         ELSE CAST(cents // 100 AS VARCHAR) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') END AS adr,
    CAST(k % 2 AS VARCHAR) AS required_car_parking_spaces,
    CAST(k % 6 AS VARCHAR) AS total_of_special_requests,
    status AS reservation_status,
    strftime(od - INTERVAL 3 DAY, '%Y-%m-%d') AS reservation_status_date
  FROM base
),
adapter AS (
  SELECT * EXCLUDE (k) FROM adapted
  UNION ALL SELECT * EXCLUDE (k) FROM adapted WHERE k % 50 = 0
  UNION ALL SELECT * EXCLUDE (k) REPLACE ('FB' AS meal) FROM adapted WHERE k % 75 = 1
)"""

_TOKENS = ", ".join(lit(t) for t in MISSING_TOKENS)
RAW = "raw AS (SELECT " + ", ".join(
    f"CASE WHEN {c} IN ({_TOKENS}) THEN NULL ELSE {c} END AS {c}" for c in RAW_COLUMNS
) + " FROM adapter)"


def _typed_expr(c: str) -> str:
    if c == "children":
        return _whole_number("COALESCE(children, '0')")
    if c == "country":
        return "COALESCE(country, 'UNKNOWN')"
    if c in INTEGER_COLUMNS:
        return _whole_number(c)
    if c in DECIMAL_COLUMNS:
        return _double(c)
    return c


TYPED = "typed AS (SELECT " + ", ".join(f"{_typed_expr(c)} AS {c}" for c in RAW_COLUMNS) + " FROM raw)"

_MONTH = "CASE arrival_date_month " + " ".join(
    f"WHEN {lit(m)} THEN {i}" for i, m in enumerate(MONTH_NAMES, start=1)
) + " END"

DERIVED = f"""
months AS (SELECT *, CAST({_MONTH} AS INTEGER) AS arrival_month_num FROM typed),
derived AS (
  SELECT {", ".join(RAW_COLUMNS)}, arrival_month_num,
    CASE WHEN arrival_date_year IS NOT NULL AND arrival_month_num IS NOT NULL AND arrival_date_day_of_month IS NOT NULL
         THEN TRY_CAST(CAST(arrival_date_year AS VARCHAR) || '-' || CAST(arrival_month_num AS VARCHAR) || '-'
                       || CAST(arrival_date_day_of_month AS VARCHAR) AS DATE) END AS arrival_date,
    stays_in_weekend_nights + stays_in_week_nights AS total_nights,
    adults + children + babies AS total_guests,
    adr * (stays_in_weekend_nights + stays_in_week_nights) AS estimated_revenue,
    CASE WHEN adults > 20 AND adr = 0 AND reservation_status = 'Canceled' THEN 'INVALID_EXTREME_OCCUPANCY'
         WHEN adr > 5000 AND reservation_status = 'Canceled' THEN 'INVALID_EXTREME_ADR'
         WHEN adr < 0 THEN 'INVALID_ADR'
         ELSE 'VALID' END AS data_quality_status
  FROM months
)"""

_STRUCTURAL = "adults >= 0 AND children >= 0 AND babies >= 0 AND total_nights >= 0 AND total_guests >= 0"


def _load_expr(c: str) -> str:
    if c == "reservation_status_date":
        return f"TRY_CAST({_blank(c)} AS DATE)"
    if c in TEXT_COLUMNS:
        return _blank(c)
    return c


SILVER = f"""
filtered AS (SELECT * FROM derived WHERE {_STRUCTURAL}),
deduped AS (SELECT DISTINCT * FROM filtered),
silver AS (SELECT {", ".join(f"{_load_expr(c)} AS {c}" for c in SILVER_COLUMNS)} FROM deduped),
valid_silver AS (SELECT * FROM silver WHERE data_quality_status = 'VALID')"""


def _keyed_dim(name: str, key: str, cols: tuple[str, ...], casts: dict[str, str], where: str = "") -> str:
    order = ", ".join(f"{c} NULLS LAST" for c in cols)
    sel = ", ".join(f"CAST({c} AS {casts[c]}) AS {c}" if c in casts else c for c in cols)
    return (
        f"{name} AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY {order}) AS INTEGER) AS {key}, {sel} "
        f"FROM (SELECT DISTINCT {', '.join(cols)} FROM valid_silver {where}) m)"
    )


GOLD = ",\n".join(
    [
        """dim_date AS (SELECT DISTINCT CAST(strftime(arrival_date, '%Y%m%d') AS INTEGER) AS date_key,
    arrival_date AS full_date, CAST(arrival_date_year AS INTEGER) AS year, arrival_month_num AS month_number,
    arrival_date_month AS month_name, CAST(arrival_date_week_number AS INTEGER) AS week_number,
    CAST(arrival_date_day_of_month AS INTEGER) AS day_of_month,
    CASE WHEN arrival_month_num BETWEEN 1 AND 3 THEN 1 WHEN arrival_month_num BETWEEN 4 AND 6 THEN 2
         WHEN arrival_month_num BETWEEN 7 AND 9 THEN 3 WHEN arrival_month_num BETWEEN 10 AND 12 THEN 4 END AS quarter
  FROM valid_silver WHERE arrival_date IS NOT NULL)""",
        _keyed_dim("dim_hotel", "hotel_key", ("hotel",), {}, "WHERE hotel IS NOT NULL"),
        _keyed_dim(
            "dim_customer", "customer_key", ("country", "customer_type", "is_repeated_guest"),
            {"is_repeated_guest": "INTEGER"},
        ),
        _keyed_dim("dim_room", "room_key", ("reserved_room_type", "assigned_room_type"), {}),
        _keyed_dim("dim_channel", "channel_key", ("market_segment", "distribution_channel"), {}),
        f"""fact_rows AS (
  SELECT d.date_key, h.hotel_key, c.customer_key, r.room_key, ch.channel_key,
         {", ".join(f"s.{m}" for m in FACT_MEASURES)}, s.arrival_date, s.hotel
  FROM valid_silver s
  JOIN dim_date d ON d.full_date = s.arrival_date
  JOIN dim_hotel h ON h.hotel = s.hotel
  JOIN dim_customer c ON c.country IS NOT DISTINCT FROM s.country
       AND c.customer_type IS NOT DISTINCT FROM s.customer_type
       AND c.is_repeated_guest IS NOT DISTINCT FROM s.is_repeated_guest
  JOIN dim_room r ON r.reserved_room_type IS NOT DISTINCT FROM s.reserved_room_type
       AND r.assigned_room_type IS NOT DISTINCT FROM s.assigned_room_type
  JOIN dim_channel ch ON ch.market_segment IS NOT DISTINCT FROM s.market_segment
       AND ch.distribution_channel IS NOT DISTINCT FROM s.distribution_channel
)""",
    ]
)

_ORDER = list(BOOKING_ORDER) + [c for c in FACT_KEYS + FACT_MEASURES if c not in BOOKING_ORDER]
FACT = (
    "fact_booking AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY "
    + ", ".join(f"{c} NULLS LAST" for c in _ORDER)
    + ") AS BIGINT) AS booking_key, "
    + ", ".join(FACT_KEYS + FACT_MEASURES)
    + " FROM fact_rows)"
)

CTES = ",\n".join([ADAPTER, RAW, TYPED, DERIVED, SILVER, GOLD, FACT])


def with_ctes(select: str, extra: str = "") -> str:
    """The shared CTE chain, optional extra CTEs, then the final SELECT."""
    more = f",\n{extra}" if extra else ""
    return f"WITH {CTES}{more}\n{select}"


# ---------------------------------------------------------------------------------------------
# Final SELECTs
# ---------------------------------------------------------------------------------------------

_CANCELED = "is_canceled = 1"


def _band(x: str) -> str:
    return "CASE " + " ".join(f"WHEN {x} <= {u} THEN {lit(label)}" for u, label in LEAD_TIME_BANDS) + f" ELSE {lit(OPEN_LEAD_TIME_BAND)} END"


def _segment_measures() -> str:
    return ", ".join(
        [
            "COUNT(*) AS total_bookings",
            f"{sum_where(_CANCELED)} AS canceled_bookings",
            f"{percent(sum_where(_CANCELED), 'COUNT(*)')} AS cancellation_rate",
            "CAST(SUM(total_nights) AS BIGINT) AS total_nights",
            "CAST(SUM(total_guests) AS BIGINT) AS total_guests",
            f"{money_mean2('adr')} AS avg_adr",
            f"{money_sum('estimated_revenue')} AS total_estimated_revenue",
        ]
    )


OVERVIEW_MEASURES = ", ".join(
    [
        "COUNT(*) AS total_bookings",
        f"{sum_where(_CANCELED)} AS canceled_bookings",
        f"{sum_where('is_canceled = 0')} AS confirmed_bookings",
        f"{percent(sum_where(_CANCELED), 'COUNT(*)')} AS cancellation_rate",
        "CAST(SUM(total_guests) AS BIGINT) AS total_guests",
        "CAST(SUM(total_nights) AS BIGINT) AS total_nights",
        f"{mean2('total_nights')} AS avg_nights_per_booking",
        f"{mean2('lead_time')} AS avg_lead_time",
        f"{money_mean2('adr')} AS avg_adr",
        f"{money_sum('estimated_revenue')} AS total_estimated_revenue",
        f"{money_mean2('estimated_revenue')} AS avg_revenue_per_booking",
    ]
)

LEAD_TIME_VIEW = f"""SELECT {_band('lead_time')} AS lead_time_range, COUNT(*) AS total_bookings,
  {sum_where(_CANCELED)} AS canceled_bookings, {sum_where('is_canceled = 0')} AS confirmed_bookings,
  {percent(sum_where(_CANCELED), 'COUNT(*)')} AS cancellation_rate, {mean2('lead_time')} AS avg_lead_time,
  {money_mean2('adr')} AS avg_adr, {mean2('total_nights')} AS avg_nights,
  CAST(SUM(total_nights) AS BIGINT) AS total_nights, {money_sum('estimated_revenue')} AS total_estimated_revenue
FROM {{src}} GROUP BY 1"""

# Fixed slicer values of the kpi_cards_sliced query (FIXTURES.md).
SLICER_HOTEL = "City Hotel"
SLICER_CUSTOMER_TYPE = "Transient"
SLICER_CHANNEL = "1-URGENT"
SLICER_PERIOD = ("1996-01-01", "1997-12-31")

SLICED_FACT = f"""(SELECT * FROM fact_rows f
  WHERE f.date_key IN (SELECT date_key FROM dim_date WHERE full_date BETWEEN DATE '{SLICER_PERIOD[0]}' AND DATE '{SLICER_PERIOD[1]}')
    AND f.customer_key IN (SELECT customer_key FROM dim_customer WHERE customer_type = {lit(SLICER_CUSTOMER_TYPE)})
    AND f.hotel_key IN (SELECT hotel_key FROM dim_hotel WHERE hotel = {lit(SLICER_HOTEL)})
    AND f.channel_key IN (SELECT channel_key FROM dim_channel WHERE distribution_channel = {lit(SLICER_CHANNEL)}))"""

_DQ_NULLS = ["hotel", "is_canceled", "arrival_date_year", "arrival_date_month", "adr"]
_NONNEG = ["adults", "children", "babies", "total_nights", "total_guests"]
_DQ_RANGES = [("adr_invalid", "adr < 0"), ("is_canceled_invalid", "is_canceled NOT IN (0, 1)")] + [
    (f"{c}_invalid", f"{c} < 0") for c in _NONNEG
]
_DQ_CONSISTENCY = [
    ("nights_inconsistent", "total_nights != stays_in_weekend_nights + stays_in_week_nights"),
    ("guests_inconsistent", "total_guests != adults + children + babies"),
    ("revenue_inconsistent", "ABS(estimated_revenue - adr * total_nights) > 0.01"),
]
_DUP_KEY = [
    "hotel", "is_canceled", "arrival_date_year", "arrival_date_month", "arrival_date_day_of_month",
    "adults", "children", "babies", "adr",
]
_MD5 = "md5(" + " || ".join(f"COALESCE(CAST({c} AS VARCHAR), '')" for c in _DUP_KEY) + ")"


def _dq_report() -> str:
    checks = [(f"null_{c}", f"{c} IS NULL") for c in _DQ_NULLS] + _DQ_RANGES + _DQ_CONSISTENCY
    fused = ", ".join(["COUNT(*) AS total_rows"] + [f"{count_where(p)} AS {n}" for n, p in checks])
    unions = [
        f"SELECT 'volume_not_empty' AS check_name, total_rows AS observed, 'ERROR' AS severity, "
        f"CASE WHEN total_rows = 0 THEN 'ERROR' ELSE 'OK' END AS outcome FROM fused",
        f"SELECT 'volume_expected_minimum', total_rows, 'WARNING', "
        f"CASE WHEN total_rows > 0 AND total_rows < {EXPECTED_MIN_ROWS} THEN 'WARNING' ELSE 'OK' END FROM fused",
    ]
    for n, _ in checks:
        unions.append(f"SELECT {lit(n)}, {n}, 'ERROR', CASE WHEN {n} > 0 THEN 'ERROR' ELSE 'OK' END FROM fused")
    unions.append(
        f"SELECT 'possible_duplicates', d, 'WARNING', CASE WHEN d > 0 THEN 'WARNING' ELSE 'OK' END "
        f"FROM (SELECT CAST(COUNT(*) - COUNT(DISTINCT {_MD5}) AS BIGINT) AS d FROM silver)"
    )
    return with_ctes(
        "SELECT check_name, CAST(observed AS BIGINT) AS observed, severity, outcome FROM ("
        + "\nUNION ALL ".join(unions)
        + ")",
        extra=f"fused AS (SELECT {fused} FROM silver)",
    )


def _profile() -> str:
    from roomledger.schema import SILVER_SCHEMA

    parts = []
    for f in SILVER_SCHEMA.fields:
        c = f.name
        parts.append(
            f"SELECT {lit(c)} AS column_name, {lit(f.dataType.simpleString())} AS data_type, "
            f"CAST(COUNT({c}) AS BIGINT) AS non_null, CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS nulls, "
            f"CAST(COUNT(DISTINCT {c}) AS BIGINT) AS distinct_values FROM silver"
        )
    return "\nUNION ALL ".join(parts)


def _numeric() -> list[str]:
    return [c for c in SILVER_COLUMNS if c in INTEGER_COLUMNS + DECIMAL_COLUMNS] + [
        "arrival_month_num", "total_nights", "total_guests", "estimated_revenue",
    ]


def _cells(select: str) -> str:
    """The numeric cells of silver as (column_name, value) rows, then ``select``."""
    cells = "\nUNION ALL ".join(
        f"SELECT {lit(c)} AS column_name, CAST({c} AS DOUBLE) AS value FROM silver WHERE {c} IS NOT NULL" for c in _numeric()
    )
    lists = (
        "SELECT column_name, list_sort(list(value)) AS l, min(value) AS low, max(value) AS high, count(*) AS total, "
        "count(DISTINCT value) AS distinct_values, CAST(SUM(CAST(value AS DECIMAL(28,10))) AS DOUBLE) AS total_value "
        "FROM cells GROUP BY column_name"
    )
    return with_ctes(select, extra=f"cells AS ({cells}),\nlists AS ({lists})")


def _at(share: float, l: str = "l") -> str:  # noqa: E741
    place = f"(CAST({share} AS DOUBLE) * (len({l}) - 1))"
    low, high = (f"{l}[CAST({side}({place}) AS BIGINT) + 1]" for side in ("floor", "ceil"))
    return f"({low} + ({high} - {low}) * ({place} - floor({place})))"


def _numeric_profile() -> str:
    names = ", ".join(f"({lit(c)})" for c in _numeric())
    shares = {"p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}
    quantiles = ", ".join(f"{_at(share)} AS {name}" for name, share in shares.items())
    return _cells(
        f"SELECT n.column_name, CAST(coalesce(total, 0) AS BIGINT) AS rows, CAST(coalesce(distinct_values, 0) AS BIGINT) AS distinct_values, "
        f'low AS "min", high AS "max", total_value / total AS mean, {quantiles} '
        f"FROM (VALUES {names}) n(column_name) LEFT JOIN lists USING (column_name)"
    )


def _histograms(buckets: int = 10) -> str:
    return _cells(f"""SELECT column_name, 'width' AS kind, CAST(k AS INTEGER) AS bucket,
  low + k * ((high - low) / {buckets}) AS lower,
  CASE WHEN k = {buckets - 1} OR high = low THEN high ELSE low + (k + 1) * ((high - low) / {buckets}) END AS upper,
  CAST(count(value) AS BIGINT) AS rows, CAST(count(DISTINCT value) AS BIGINT) AS distinct_values
FROM (SELECT *, unnest(range(CASE WHEN high = low THEN 1 ELSE {buckets} END)) AS k FROM lists) b
LEFT JOIN (SELECT column_name AS c, value, CASE WHEN high = low THEN 0
             ELSE least(CAST(floor((value - low) / (high - low) * {buckets}) AS INTEGER), {buckets - 1}) END AS own
           FROM cells JOIN lists USING (column_name)) v ON c = column_name AND own = k
GROUP BY column_name, k, low, high
UNION ALL
SELECT column_name, 'depth', CAST(bucket AS INTEGER), min(value), max(value), CAST(count(*) AS BIGINT), CAST(count(DISTINCT value) AS BIGINT)
FROM (SELECT column_name, value, len(list_filter(ends, lambda e: e < value)) AS bucket FROM cells JOIN (
        SELECT column_name, list(DISTINCT l[(k * total + {buckets - 1}) // {buckets}]) AS ends
        FROM (SELECT *, unnest(range(1, {buckets + 1})) AS k FROM lists) GROUP BY column_name) USING (column_name))
GROUP BY column_name, bucket""")


def _anomalies(select: str) -> str:
    return _cells(f"""SELECT * FROM (WITH middle AS (
  SELECT column_name, total, {_at(0.25)} AS q1, {_at(0.5)} AS median, {_at(0.75)} AS q3 FROM lists
), spread AS (
  SELECT column_name, list_sort(list(abs(value - median))) AS d, CAST(SUM(CAST(abs(value - median) AS DECIMAL(28,10))) AS DOUBLE) AS distance
  FROM cells JOIN middle USING (column_name) GROUP BY column_name
), bounds AS (
  SELECT column_name, CAST(total AS BIGINT) AS rows, q1, median, q3, {_at(0.5, 'd')} AS mad, distance / total AS mean_deviation,
         q1 - CAST(1.5 AS DOUBLE) * (q3 - q1) AS lower_fence, q3 + CAST(1.5 AS DOUBLE) * (q3 - q1) AS upper_fence
  FROM middle JOIN spread USING (column_name)
), scored AS (
  SELECT column_name, value, CASE WHEN mad > 0 THEN (value - median) * CAST(0.6745 AS DOUBLE) / mad
           WHEN mean_deviation > 0 THEN (value - median) / (mean_deviation * CAST(1.253314 AS DOUBLE)) ELSE 0.0 END AS score,
         value < lower_fence OR value > upper_fence AS outside_fences
  FROM cells JOIN bounds USING (column_name)
), found AS (
  SELECT column_name, value, CAST(count(*) AS BIGINT) AS rows, score, outside_fences, abs(score) > 3.5 AS high_score
  FROM scored WHERE outside_fences OR abs(score) > 3.5 GROUP BY ALL
)
{select})""")


_ANOMALY_BOUNDS = """SELECT b.*, CAST(coalesce(f.fences, 0) AS BIGINT) AS rows_outside_fences,
  CAST(coalesce(f.scores, 0) AS BIGINT) AS rows_with_high_score
FROM bounds b LEFT JOIN (SELECT column_name, sum(rows) FILTER (WHERE outside_fences) AS fences, sum(rows) FILTER (WHERE high_score) AS scores
                         FROM found GROUP BY column_name) f USING (column_name)"""


def _distinct_numbers() -> str:
    columns = [c for c in SILVER_COLUMNS if c in INTEGER_COLUMNS] + [
        "reservation_status_date", "arrival_month_num", "arrival_date", "total_nights", "total_guests",
    ]
    return with_ctes(
        "\nUNION ALL ".join(
            f"SELECT {lit(c)} AS column_name, CAST(COUNT(DISTINCT {c}) AS BIGINT) AS distinct_values FROM silver" for c in columns
        )
    )


_DIMS = {
    "dim_date": ("date_key", ["date_key", "full_date", "year", "month_number", "month_name", "day_of_month", "quarter"]),
    "dim_hotel": ("hotel_key", ["hotel_key", "hotel"]),
    "dim_customer": ("customer_key", ["customer_key"]),
    "dim_room": ("room_key", ["room_key"]),
    "dim_channel": ("channel_key", ["channel_key"]),
}


def _gold_checks() -> dict[str, str]:
    uniq = "\nUNION ALL ".join(
        f"SELECT {lit(d)} AS table_name, CAST(COUNT(*) AS BIGINT) AS duplicate_keys FROM "
        f"(SELECT {k} FROM {d} GROUP BY {k} HAVING COUNT(*) > 1)"
        for d, (k, _) in _DIMS.items()
    )
    notnull = "\nUNION ALL ".join(
        f"SELECT {lit(d)} AS table_name, {lit(c)} AS column_name, {count_where(f'{c} IS NULL')} AS null_rows FROM {d}"
        for d, (_, cols) in _DIMS.items()
        for c in cols
    )
    orphans = "\nUNION ALL ".join(
        f"SELECT {lit(k)} AS foreign_key, CAST(COUNT(*) AS BIGINT) AS orphan_rows FROM fact_rows f "
        f"WHERE NOT EXISTS (SELECT 1 FROM {d} x WHERE x.{k} = f.{k})"
        for d, (k, _) in _DIMS.items()
    )
    recon = """SELECT valid_rows, joinable_rows, fact_rows, valid_rows - joinable_rows AS dropped_rows,
  fact_rows - joinable_rows AS fanout_rows
FROM (SELECT (SELECT CAST(COUNT(*) AS BIGINT) FROM valid_silver) AS valid_rows,
             (SELECT CAST(COUNT(*) AS BIGINT) FROM valid_silver WHERE arrival_date IS NOT NULL AND hotel IS NOT NULL)
               AS joinable_rows,
             (SELECT CAST(COUNT(*) AS BIGINT) FROM fact_rows) AS fact_rows)"""
    return {
        "gold_key_uniqueness": with_ctes(uniq),
        "gold_not_null": with_ctes(notnull),
        "gold_orphans": with_ctes(orphans),
        "gold_reconciliation": with_ctes(recon),
    }


def _planted_checks() -> dict[str, str]:
    """The gold checks over tables with the catalog's planted faults."""
    uniq = "\nUNION ALL ".join(
        f"SELECT {lit(d)} AS table_name, CAST(COUNT(*) AS BIGINT) AS duplicate_keys FROM (SELECT {k} FROM "
        f"(SELECT {k} FROM {d} UNION ALL SELECT {k} FROM {d} WHERE {k} % 3 = 0) GROUP BY {k} HAVING COUNT(*) > 1)"
        for d, (k, _) in _DIMS.items()
    )
    notnull = "\nUNION ALL ".join(
        f"SELECT {lit(d)} AS table_name, {lit(c)} AS column_name, {count_where(f'{k} % 4 = 1 OR {c} IS NULL')} AS null_rows FROM {d}"
        for d, (k, cols) in _DIMS.items()
        for c in cols
    )
    orphans = "\nUNION ALL ".join(
        f"SELECT {lit(k)} AS foreign_key, CAST(COUNT(*) AS BIGINT) AS orphan_rows FROM fact_rows f "
        f"WHERE NOT EXISTS (SELECT 1 FROM {d} x WHERE x.{k} = f.{k} AND x.{k} % 5 <> 2)"
        for d, (k, _) in _DIMS.items()
    )
    return {
        "gold_key_uniqueness_planted": with_ctes(uniq),
        "gold_not_null_planted": with_ctes(notnull),
        "gold_orphans_planted": with_ctes(orphans),
        "gold_content_planted": _gold_content("CASE WHEN f.lead_time % 50 = 3 THEN f.adr + 1 ELSE f.adr END"),
        "postconditions_unfiltered": with_ctes(
            "SELECT " + ", ".join(f"{count_where(c + ' < 0')} AS negative_{c}" for c in _NONNEG) + " FROM derived"
        ),
    }


def _gold_content(adr: str = "f.adr") -> str:
    """Both sides' bookings compared value by value, without hashes."""
    own = list(FACT_MEASURES)
    members = {
        "dim_hotel": ("hotel",), "dim_customer": ("country", "customer_type"), "dim_room": ("reserved_room_type", "assigned_room_type"),
        "dim_channel": ("market_segment", "distribution_channel"),
    }
    spelled = ", ".join(f"{d}.{c}" for d, cs in members.items() for c in cs)
    names = ", ".join(c for cs in members.values() for c in cs)
    joins = " ".join(f"LEFT JOIN {d} ON {d}.{_DIMS[d][0]} = f.{_DIMS[d][0]}" for d in members)
    return with_ctes(
        "SELECT date_key, CAST(sum(s) AS BIGINT) AS silver_rows, CAST(sum(f) AS BIGINT) AS fact_rows, bool_and(s = f) AS same_content "
        "FROM booked GROUP BY date_key",
        extra=f"""both_sides AS (
  SELECT CAST(strftime(arrival_date, '%Y%m%d') AS INTEGER) AS date_key, {", ".join(own)}, {names}, 1 AS s, 0 AS f
  FROM valid_silver WHERE arrival_date IS NOT NULL AND hotel IS NOT NULL
  UNION ALL SELECT f.date_key, {", ".join(adr if c == "adr" else "f." + c for c in own)}, {spelled}, 0, 1 FROM fact_rows f {joins}
),
booked AS (SELECT date_key, sum(s) AS s, sum(f) AS f FROM both_sides GROUP BY date_key, {", ".join(own)}, {names})""",
    )


KPI_CUBE = f"""SELECT full_date, customer_type, hotel, distribution_channel,
  CAST(GROUPING(full_date, customer_type, hotel, distribution_channel) AS INTEGER) AS level, COUNT(*) AS total_bookings,
  {sum_where(_CANCELED)} AS canceled_bookings, {money_mean2('adr')} AS avg_adr, {mean2('lead_time')} AS avg_lead_time,
  {money_sum('estimated_revenue')} AS total_estimated_revenue, CAST(SUM(total_nights) AS BIGINT) AS total_nights,
  {percent(sum_where(_CANCELED), 'COUNT(*)')} AS cancellation_rate
FROM (SELECT f.is_canceled, f.adr, f.lead_time, f.estimated_revenue, f.total_nights, d.full_date, c.customer_type, h.hotel, ch.distribution_channel
      FROM fact_rows f JOIN (SELECT DISTINCT date_key, full_date FROM dim_date) d ON d.date_key = f.date_key
      JOIN dim_customer c ON c.customer_key = f.customer_key JOIN dim_hotel h ON h.hotel_key = f.hotel_key
      JOIN dim_channel ch ON ch.channel_key = f.channel_key)
GROUP BY CUBE (full_date, customer_type, hotel, distribution_channel)"""


def _structural_rejects() -> str:
    rules = [(c, f"COALESCE({c} >= 0, FALSE)") for c in _NONNEG]
    parts = [
        f"SELECT {lit(c)} AS rule, {count_where('NOT ' + p)} AS rejected_rows FROM derived" for c, p in rules
    ]
    parts.append(f"SELECT 'any' AS rule, {count_where('NOT COALESCE(' + _STRUCTURAL + ', FALSE)')} AS rejected_rows FROM derived")
    return "\nUNION ALL ".join(parts)


def oracle_sql() -> dict[str, str]:
    q = {
        "raw_bookings": with_ctes("SELECT * FROM raw"),
        "clean_types": with_ctes("SELECT * FROM typed"),
        "arrival_dates": with_ctes(
            "SELECT arrival_date_year, arrival_date_month, arrival_date_day_of_month, arrival_month_num, arrival_date FROM derived"
        ),
        "stay_metrics": with_ctes(
            "SELECT stays_in_weekend_nights, stays_in_week_nights, adults, children, babies, adr, total_nights, "
            "total_guests, estimated_revenue FROM derived"
        ),
        "quality_labels": with_ctes("SELECT adr, adults, reservation_status, data_quality_status FROM derived"),
        "quality_label_counts": with_ctes(
            "SELECT data_quality_status, COUNT(*) AS bookings FROM silver GROUP BY data_quality_status"
        ),
        "structural_filter": with_ctes("SELECT * FROM filtered"),
        "structural_rejects": with_ctes(_structural_rejects()),
        "silver_bookings": with_ctes("SELECT * FROM silver"),
        "csv_round_trip": with_ctes("SELECT * FROM silver"),
        "silver_csv_round_trip": with_ctes("SELECT * FROM deduped"),
        "dim_date": with_ctes("SELECT * FROM dim_date"),
        "dim_hotel": with_ctes("SELECT * FROM dim_hotel"),
        "dim_customer": with_ctes("SELECT * FROM dim_customer"),
        "dim_room": with_ctes("SELECT * FROM dim_room"),
        "dim_channel": with_ctes("SELECT * FROM dim_channel"),
        "fact_booking": with_ctes("SELECT * FROM fact_booking"),
        "vw_booking_overview": with_ctes(f"SELECT {OVERVIEW_MEASURES} FROM fact_rows"),
        "vw_booking_by_lead_time": with_ctes(LEAD_TIME_VIEW.format(src="fact_rows")),
        "vw_booking_seasonality_hotel": with_ctes(
            f"SELECT h.hotel, d.year, d.month_number, d.month_name, {_segment_measures()} FROM fact_rows f "
            "JOIN dim_date d ON f.date_key = d.date_key JOIN dim_hotel h ON f.hotel_key = h.hotel_key "
            "GROUP BY h.hotel, d.year, d.month_number, d.month_name"
        ),
        "vw_booking_by_channel": with_ctes(
            f"SELECT c.market_segment, c.distribution_channel, {_segment_measures()} FROM fact_rows f "
            "JOIN dim_channel c ON f.channel_key = c.channel_key GROUP BY c.market_segment, c.distribution_channel"
        ),
        "vw_room_match": with_ctes(
            "SELECT r.reserved_room_type, r.assigned_room_type, COUNT(*) AS total_bookings, "
            f"{sum_where('r.reserved_room_type = r.assigned_room_type')} AS matched_bookings, "
            f"{sum_where('r.reserved_room_type <> r.assigned_room_type')} AS changed_bookings, "
            f"{percent(sum_where('r.reserved_room_type = r.assigned_room_type'), 'COUNT(*)')} AS match_rate, "
            f"{percent(sum_where('r.reserved_room_type <> r.assigned_room_type'), 'COUNT(*)')} AS change_rate "
            "FROM fact_rows f JOIN dim_room r ON f.room_key = r.room_key "
            "GROUP BY r.reserved_room_type, r.assigned_room_type"
        ),
        "kpi_cards_sliced": with_ctes(
            f"SELECT COUNT(*) AS total_bookings, {money_mean2('adr')} AS avg_adr, {mean2('lead_time')} AS avg_lead_time, "
            f"{money_sum('estimated_revenue')} AS total_estimated_revenue, CAST(SUM(total_nights) AS BIGINT) AS total_nights, "
            f"{percent(sum_where(_CANCELED), 'COUNT(*)')} AS cancellation_rate FROM {SLICED_FACT} s"
        ),
        "kpi_cube": with_ctes(KPI_CUBE),
        "bookings_by_month": with_ctes(
            f"SELECT d.year, d.month_number, d.month_name, {_segment_measures()} FROM fact_rows f "
            "JOIN dim_date d ON f.date_key = d.date_key GROUP BY d.year, d.month_number, d.month_name"
        ),
        "bookings_by_hotel": with_ctes(
            f"SELECT h.hotel, {_segment_measures()} FROM fact_rows f JOIN dim_hotel h ON f.hotel_key = h.hotel_key GROUP BY h.hotel"
        ),
        "bookings_by_segment": with_ctes(
            f"SELECT c.market_segment, {_segment_measures()} FROM fact_rows f "
            "JOIN dim_channel c ON f.channel_key = c.channel_key GROUP BY c.market_segment"
        ),
        "bookings_by_lead_band": with_ctes(
            f"SELECT {_band('lead_time')} AS lead_time_range, COUNT(*) AS total_bookings, "
            f"{sum_where(_CANCELED)} AS canceled_bookings, {percent(sum_where(_CANCELED), 'COUNT(*)')} AS cancellation_rate "
            "FROM fact_rows GROUP BY 1"
        ),
        "dq_volume": with_ctes(
            f"SELECT COUNT(*) AS total_rows, CASE WHEN COUNT(*) = 0 THEN 'ERROR' WHEN COUNT(*) < {EXPECTED_MIN_ROWS} "
            "THEN 'WARNING' ELSE 'OK' END AS volume_status FROM silver"
        ),
        "dq_nulls": with_ctes(
            "SELECT " + ", ".join(f"{count_where(c + ' IS NULL')} AS null_{c}" for c in _DQ_NULLS) + " FROM silver"
        ),
        "dq_duplicates_md5": with_ctes(
            f"SELECT CAST(COUNT(*) - COUNT(DISTINCT {_MD5}) AS BIGINT) AS possible_duplicates FROM silver"
        ),
        "dq_duplicates_exact": with_ctes(
            "SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS possible_duplicates FROM "
            f"(SELECT COUNT(*) AS n FROM silver GROUP BY {', '.join(_DUP_KEY)})"
        ),
        "dq_ranges": with_ctes("SELECT " + ", ".join(f"{count_where(p)} AS {n}" for n, p in _DQ_RANGES) + " FROM silver"),
        "dq_consistency": with_ctes(
            "SELECT " + ", ".join(f"{count_where(p)} AS {n}" for n, p in _DQ_CONSISTENCY) + " FROM silver"
        ),
        "dq_report": _dq_report(),
        "postconditions": with_ctes(
            "SELECT " + ", ".join(f"{count_where(c + ' < 0')} AS negative_{c}" for c in _NONNEG) + " FROM silver"
        ),
        "column_profile": with_ctes(_profile()),
        "distinct_numbers": _distinct_numbers(),
        "numeric_profile": _numeric_profile(),
        "column_histograms": _histograms(),
        "numeric_anomalies": _anomalies("SELECT * FROM found"),
        "numeric_anomaly_bounds": _anomalies(_ANOMALY_BOUNDS),
    }
    q.update(_gold_checks())
    q["gold_content"] = _gold_content()
    q.update(_planted_checks())
    q["kpi_cards_from_cube"] = q["kpi_cards_sliced"]
    for name in ("bookings_by_month", "bookings_by_hotel", "bookings_by_segment", "bookings_by_lead_band"):
        source = "FROM fact_rows" + (" f" if name != "bookings_by_lead_band" else "")
        q[f"{name}_sliced"] = q[name].replace(f"{source} ", f"FROM {SLICED_FACT} f ", 1)
    return q
