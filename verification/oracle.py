"""SQL that states the expected result of each query, for an independent engine."""

STATE = "NATION_7"
KEYS = "PROVNUM, PROVNAME, STATE"
HOURS = ("RN", "LPN", "CNA")
RATINGS = ("OVERALL_RATING", "HEALTH_RATING", "STAFFING_RATING")
NUMBERS = [f"Hrs_{h}{k}" for k in ("", "_emp", "_ctr") for h in HOURS] + ["MDScensus"]
MODEL = ["PROVNUM", "PROVNAME", "STATE", "CERTIFIED_BEDS", "AVG_RESIDENTS", *RATINGS]
# Headers of the provider file.
FILE = {
    "PROVNUM": "CMS Certification Number (CCN)",
    "PROVNAME": "Provider Name",
    "STATE": "State",
    "CERTIFIED_BEDS": "Number of Certified Beds",
    "AVG_RESIDENTS": "Average Number of Residents per Day",
    "OVERALL_RATING": "Overall Rating",
    "HEALTH_RATING": "Health Inspection Rating",
    "STAFFING_RATING": "Staffing Rating",
}
FOOTNOTE = "CASE WHEN OVERALL_RATING IS NULL THEN '18' END"
FOCUS = "CASE WHEN CERTIFIED_BEDS = 0 THEN 'SFF' END"


def rounded(x):
    """Half-up on the decimal text of the double."""
    return f"cast(round(cast(cast({x} AS varchar) AS decimal(38,18)), 2) AS double)"


def ratio(numerator, denominator, scale=""):
    value = f"CASE WHEN {denominator} > 0 THEN {numerator} / {denominator}{scale} ELSE 0.0 END"
    return rounded(f"cast({value} AS double)")


def total(x):
    """Exact sum to six decimals."""
    return f"(cast(sum(cast(round(({x}) * 1000000::double) AS bigint)) AS double) / 1000000::double)"


def mean(column):
    """Exact mean to six decimals."""
    return f"({total(column)} / nullif(count({column}), 0))"


FIRST = ", ".join(f"{k} NULLS FIRST" for k in KEYS.split(", "))


_HOUR_RULES = {
    "RN": "CASE WHEN l_quantity <> 13 THEN l_quantity END",
    "LPN": "CASE WHEN l_returnflag <> 'A' THEN l_quantity * 0.57::double END",
    "CNA": "CASE WHEN l_linenumber <> 7 THEN l_linenumber * 4.01::double END",
}
_DAY = ",\n".join(
    ["cast(l_shipdate AS date) AS WorkDate"]
    + [f"{rule} AS Hrs_{h}" for h, rule in _HOUR_RULES.items()]
    + [
        f"CASE WHEN l_linestatus = '{status}' THEN {rule} END AS Hrs_{h}_{kind}"
        for kind, status in (("emp", "F"), ("ctr", "O"))
        for h, rule in _HOUR_RULES.items()
    ]
    + ["CASE WHEN l_linenumber <> 1 THEN floor(l_extendedprice / 1000.0::double) END AS MDScensus"]
)
_NUMBER = ("CASE WHEN l_orderkey % 89 <> 3 THEN l_suppkey + "
           "CASE WHEN l_partkey % 97 = 5 THEN 5000000 ELSE 0 END END")
_TOTAL = " + ".join(f"coalesce(Hrs_{h}, 0)" for h in HOURS)


def _total(kind):
    return " + ".join(f"coalesce(Hrs_{h}_{kind}, 0)" for h in HOURS)


PBJ = f"""pbj AS (
SELECT cast(number AS varchar) AS PROVNUM, s_name AS PROVNAME, n_name AS STATE, {_DAY}
FROM (SELECT *, {_NUMBER} AS number FROM lineitem)
LEFT JOIN supplier ON number = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey)"""

STAFFING = f"""{PBJ},
monthly AS (
SELECT {KEYS}, cast(year(WorkDate) AS int) AS YEAR, cast(month(WorkDate) AS int) AS MONTH,
  {total(_TOTAL)} AS TOTAL_NURSE_HOURS, {mean('MDScensus')} AS AVG_PATIENT_CENSUS,
  {total('Hrs_RN')} AS RN_HOURS, {total('Hrs_LPN')} AS LPN_HOURS, {total('Hrs_CNA')} AS CNA_HOURS,
  {total(_total('emp'))} AS EMPLOYEE_HOURS, {total(_total('ctr'))} AS CONTRACT_HOURS,
  {total('MDScensus')} AS CENSUS_DAYS
FROM pbj GROUP BY ALL),
staffing AS (
SELECT * EXCLUDE (CENSUS_DAYS), {ratio('TOTAL_NURSE_HOURS', 'AVG_PATIENT_CENSUS')} AS NURSE_TO_PATIENT_RATIO,
  {ratio('EMPLOYEE_HOURS', 'TOTAL_NURSE_HOURS', ' * 100')} AS EMPLOYEE_STAFF_PERCENT,
  {ratio('CONTRACT_HOURS', 'TOTAL_NURSE_HOURS', ' * 100')} AS CONTRACT_STAFF_PERCENT
FROM monthly)"""

MEANS = f"""means AS (
SELECT PROVNUM, {mean('NURSE_TO_PATIENT_RATIO')} AS AVG_STAFFING_RATIO
FROM staffing GROUP BY PROVNUM)"""

VOLUME = f"""volume AS (
SELECT {KEYS}, {total('MDScensus')} AS TOTAL_PATIENT_DAYS FROM pbj GROUP BY ALL),
top_volume AS (
SELECT * FROM volume ORDER BY TOTAL_PATIENT_DAYS DESC NULLS LAST, {FIRST} LIMIT 10)"""

PROVIDER = """keyed AS (
SELECT s_suppkey AS k, 0 AS dup, s_name, s_nationkey FROM supplier
UNION ALL SELECT s_suppkey, 1, s_name, s_nationkey FROM supplier WHERE s_suppkey % 10 = 0
UNION ALL SELECT s_suppkey + 1000000, 0, s_name, s_nationkey FROM supplier
WHERE s_suppkey % 10 = 5),
provider AS (
SELECT cast(k AS varchar) AS PROVNUM, s_name AS PROVNAME, n_name AS STATE,
  cast(CASE WHEN k % 11 = 0 THEN 0 ELSE 40 + (k % 9) * 10 + dup END AS double) AS CERTIFIED_BEDS,
  cast(CASE WHEN k % 17 <> 3 THEN 20 + (k * 7) % 90 END AS double) AS AVG_RESIDENTS,
  cast(CASE WHEN k % 13 <> 0 THEN 1 + k % 5 END AS double) AS OVERALL_RATING,
  cast(CASE WHEN k % 13 <> 0 AND k % 4 <> 1 THEN 1 + (k * 3) % 5 END AS double) AS HEALTH_RATING,
  cast(CASE WHEN k % 13 <> 0 AND k % 6 <> 2 THEN 1 + (k * 2) % 5 END AS double)
    AS STAFFING_RATING
FROM keyed JOIN nation ON s_nationkey = n_nationkey)"""

UNIQUE = f"""{PROVIDER},
ranked AS (
SELECT *, row_number() OVER (PARTITION BY PROVNUM ORDER BY
  {', '.join(c + ' NULLS FIRST' for c in MODEL[1:])}) AS rn FROM provider),
providers AS (SELECT {', '.join(MODEL)} FROM ranked WHERE rn = 1)"""

_PRESENT = " + ".join(f"(CASE WHEN {r} IS NULL THEN 0 ELSE 1 END)" for r in RATINGS)
_SUM = " + ".join(f"coalesce({r}, 0)" for r in RATINGS)
QUALITY = f"""{UNIQUE},
quality AS (
SELECT {KEYS}, {', '.join(RATINGS)},
  {rounded(f'(({_SUM}) / nullif({_PRESENT}, 0))')} AS FACILITY_QUALITY_SCORE
FROM providers)"""

FACILITY = f"""{STAFFING}, {MEANS}, {QUALITY},
facility AS (
SELECT providers.*, {ratio('AVG_RESIDENTS', 'CERTIFIED_BEDS', ' * 100')} AS OCCUPANCY_RATE,
  AVG_STAFFING_RATIO, {ratio('AVG_RESIDENTS', 'AVG_STAFFING_RATIO')} AS STAFFING_PRESSURE_INDEX
FROM providers LEFT JOIN means USING (PROVNUM))"""

COPIES = f"""{PROVIDER},
copies AS (SELECT * FROM provider
UNION ALL SELECT * FROM provider WHERE PROVNUM LIKE '%0')"""


def _with(ctes, body):
    return f"WITH {ctes} {body}"


def _top(source, metric):
    return (f"SELECT * FROM {source} WHERE {metric} IS NOT NULL "
            f"ORDER BY {metric} DESC, {FIRST} LIMIT 10")


def _state_tops(source, metric, k):
    return (f"SELECT *, cast(row_number() OVER (PARTITION BY STATE ORDER BY {metric} DESC, {FIRST}) AS int) AS PLACE "
            f"FROM {source} WHERE {metric} IS NOT NULL AND STATE IS NOT NULL QUALIFY PLACE <= {k}")


def _cards(where=""):
    return f"""SELECT
 (SELECT count(DISTINCT PROVNUM) FROM facility{where}) AS TOTAL_FACILITIES,
 (SELECT coalesce({total('TOTAL_NURSE_HOURS')}, 0) FROM staffing{where}) AS TOTAL_NURSE_HOURS,
 (SELECT {mean('OCCUPANCY_RATE')} FROM facility{where}) AS AVERAGE_OCCUPANCY_RATE,
 (SELECT {mean('FACILITY_QUALITY_SCORE')} FROM quality{where}) AS AVERAGE_QUALITY_SCORE"""


def _as_rows(source, label, value, measures):
    return " UNION ALL ".join(
        f"SELECT '{name}' AS {label}, {agg} AS {value} FROM {source}"
        for name, agg in measures.items())


def _nulls(source, names):
    return " UNION ALL ".join(
        f"SELECT '{shown}' AS column_name, cast(count(*) - count({c}) AS bigint) AS null_count"
        f" FROM {source}"
        for shown, c in names.items())


def _file(rename, kept=True, text=False):
    """Provider rows under file headers, each passed through ``rename``."""
    def cell(c):
        return f"cast({c} AS varchar)" if text else c
    cells = [f'{cell(c)} AS "{rename(h)}"' for c, h in FILE.items()]
    if kept:
        cells += [f'{FOOTNOTE} AS "{rename("Overall Rating Footnote")}"',
                  f'{FOCUS} AS "{rename("Special Focus Status")}"']
    return f"SELECT {', '.join(cells)} FROM provider"


def _same(name):
    return name


def _clean(name):
    return name.replace(" (", "_").replace(")", "").replace(" ", "_")


PBJ_COLUMNS = ["PROVNUM", "PROVNAME", "STATE", "WorkDate", *NUMBERS]
_PBJ_NULLS = _nulls("pbj", {c: c for c in PBJ_COLUMNS})
_MODEL_NULLS = _nulls("provider", {c: c for c in MODEL})
_FILE_CELLS = {h: c for c, h in FILE.items()}
_FILE_CELLS |= {"Overall Rating Footnote": f"({FOOTNOTE})", "Special Focus Status": f"({FOCUS})"}
_LINEITEM = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double",
    "l_tax": "double", "l_returnflag": "string", "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}
_HEAT = {
    "AVG_QUALITY_SCORE": mean("FACILITY_QUALITY_SCORE"),
    "AVG_OVERALL_RATING": "avg(OVERALL_RATING)",
    "AVG_HEALTH_RATING": "avg(HEALTH_RATING)",
    "AVG_STAFFING_RATING": "avg(STAFFING_RATING)",
}
_HOUR_HEAT = {
    c: f"coalesce({total(c)}, 0)" for c in (
        "TOTAL_NURSE_HOURS", "RN_HOURS", "LPN_HOURS", "CNA_HOURS", "EMPLOYEE_HOURS",
        "CONTRACT_HOURS")
}


def _wide(source, measures):
    cells = ", ".join(f"{agg} AS {name}" for name, agg in measures.items())
    return f"SELECT STATE, {cells} FROM {source} WHERE STATE IS NOT NULL GROUP BY STATE"


def _long(source, measures):
    return " UNION ALL ".join(
        f"SELECT STATE, '{name}' AS METRIC, {agg} AS VALUE FROM {source} WHERE STATE IS NOT NULL GROUP BY STATE"
        for name, agg in measures.items())


_PROVIDER_BYTES = " + ".join(f"length(coalesce(cast({c} AS varchar), '')) + 1" for c in _FILE_CELLS.values())


def _changed(census, where="", state="STATE"):
    """The days with another census or state, or some of them."""
    return PBJ.replace("pbj AS", "plain AS") + f""",
pbj AS (SELECT * REPLACE ({census} AS MDScensus, {state} AS STATE) FROM plain{where})"""


_SECOND = "year(WorkDate) = 2000"
_CORRECTED = _changed(
    f"MDScensus + CASE WHEN {_SECOND} THEN 1 ELSE 0 END",
    state=f"CASE WHEN {_SECOND} AND PROVNUM LIKE '%3' THEN 'MOVED' ELSE STATE END")
_KEYED = " WHERE " + " AND ".join(f"{k} IS NOT NULL" for k in KEYS.split(", "))
_IN_STATE = f" WHERE STATE = '{STATE}'"
_staffing = _with(STAFFING, "SELECT * FROM staffing")
_facility = _with(FACILITY, "SELECT * FROM facility")
_quality = _with(QUALITY, "SELECT * FROM quality")
_volume = _with(f"{PBJ}, {VOLUME}", "SELECT * FROM volume")
_top_volume = _with(f"{PBJ}, {VOLUME}", "SELECT * FROM top_volume")
_pbj = _with(PBJ, f"SELECT {', '.join(PBJ_COLUMNS)} FROM pbj")

ORACLE = {
    "staffing_metrics": _staffing,
    "staffing_metrics_flat": _staffing,
    "monthly_rollup": _with(STAFFING, "SELECT * FROM monthly"),
    "facility_avg_ratio": _with(f"{STAFFING}, {MEANS}", "SELECT * FROM means"),
    "facility_metrics": _facility,
    "quality_metrics": _quality,
    "patient_volume": _volume,
    "patient_volume_from_rollup": _volume,
    "top_patient_volume": _top_volume,
    "kpi_cards": _with(FACILITY, _cards()),
    "kpi_cards_state": _with(FACILITY, _cards(_IN_STATE)),
    "state_filter": _staffing + _IN_STATE,
    "state_filter_flat": _staffing + _IN_STATE,
    "kpi_cards_nowhere": _with(FACILITY, _cards(" WHERE STATE = 'NOWHERE'")),
    "state_list": _with(PROVIDER, "SELECT DISTINCT STATE FROM provider ORDER BY STATE"),
    "hours_by_staff_type": _with(STAFFING, _as_rows(
        "staffing", "STAFF_TYPE", "HOURS", {h: f"coalesce({total(h + '_HOURS')}, 0)" for h in HOURS})),
    "employee_vs_contract": _with(STAFFING, _as_rows("staffing", "STAFF_TYPE", "HOURS", {
        "Employee Hours": f"coalesce({total('EMPLOYEE_HOURS')}, 0)",
        "Contract Hours": f"coalesce({total('CONTRACT_HOURS')}, 0)"})),
    "avg_quality_ratings": _with(QUALITY, _as_rows("quality", "RATING_TYPE", "AVERAGE_SCORE", {
        "Overall Rating": "avg(OVERALL_RATING)",
        "Health Rating": "avg(HEALTH_RATING)",
        "Staffing Rating": "avg(STAFFING_RATING)"})),
    "top_occupancy": _with(FACILITY, _top("facility", "OCCUPANCY_RATE")),
    "top_pressure": _with(FACILITY, _top("facility", "STAFFING_PRESSURE_INDEX")),
    "top_quality": _with(QUALITY, _top("quality", "FACILITY_QUALITY_SCORE")),
    "mean_nurse_ratio": _with(
        STAFFING, f"SELECT {KEYS}, {mean('NURSE_TO_PATIENT_RATIO')} AS NURSE_TO_PATIENT_RATIO "
                  f"FROM staffing{_KEYED} GROUP BY ALL"),
    "top_nurse_ratio": _with(
        STAFFING + f", ratios AS (SELECT {KEYS}, {mean('NURSE_TO_PATIENT_RATIO')} "
                   f"AS NURSE_TO_PATIENT_RATIO FROM staffing{_KEYED} GROUP BY ALL)",
        _top("ratios", "NURSE_TO_PATIENT_RATIO")),
    "top_volume": _top_volume,
    "top_volume_in_state": _top_volume + _IN_STATE,
    "state_top_volume": _with(
        f"{PBJ}, {VOLUME}",
        f"SELECT * FROM volume{_IN_STATE} AND TOTAL_PATIENT_DAYS IS NOT NULL "
        f"ORDER BY TOTAL_PATIENT_DAYS DESC, {FIRST} LIMIT 10"),
    "quality_heatmap": _with(QUALITY, _wide("quality", _HEAT)),
    "staffing_heatmap": _with(STAFFING, _wide("staffing", _HOUR_HEAT)),
    "quality_heatmap_long": _with(QUALITY, _long("quality", _HEAT)),
    "staffing_heatmap_long": _with(STAFFING, _long("staffing", _HOUR_HEAT)),
    "null_summary": _with(PBJ, _PBJ_NULLS),
    "null_summary_provider": _with(PROVIDER, _nulls("provider", _FILE_CELLS)),
    "null_counts": _with(PROVIDER, "SELECT " + ", ".join(
        f"cast(count(*) - count({c}) AS bigint) AS {c}" for c in MODEL) + " FROM provider"),
    "null_summary_by_column": _with(
        f"{PBJ}, {PROVIDER}",
        "SELECT column_name, cast(sum(null_count) AS bigint) AS null_count "
        f"FROM ({_PBJ_NULLS} UNION ALL {_MODEL_NULLS}) GROUP BY column_name"),
    "null_summary_row_count": _with(PBJ, f'SELECT count(*) AS "count" FROM ({_PBJ_NULLS})'),
    "duplicate_rows": _with(
        COPIES, "SELECT *, count(*) AS dup_count FROM copies GROUP BY ALL HAVING count(*) > 1"),
    "duplicate_documents":
        "SELECT text, lang, source, n_chars, count(*) AS dup_count FROM documents "
        "GROUP BY ALL HAVING count(*) > 1",
    "drop_exact_duplicates": _with(COPIES, "SELECT DISTINCT * FROM copies"),
    "dedup_by_key": _with(UNIQUE, "SELECT * FROM providers"),
    "coerce_numeric": """SELECT c_custkey, CASE WHEN c_custkey % 11 IN (1, 2, 3, 6, 7, 8) THEN NULL
        WHEN c_custkey % 11 = 4 THEN 12.0 WHEN c_custkey % 11 = 5 THEN 1000.0
        WHEN c_custkey % 3 <> 0 THEN c_acctbal END AS amount FROM customer""",
    "work_date": """SELECT o_orderkey, d AS work_date, cast(year(d) AS int) AS YEAR,
        cast(month(d) AS int) AS MONTH
        FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 2 THEN cast(o_orderdate AS date) END
              AS d FROM orders)""",
    "prepared_days":
        f"SELECT *, cast(year(WorkDate) AS int) AS YEAR, cast(month(WorkDate) AS int) AS MONTH, "
        f"{_TOTAL} AS TOTAL_NURSE_HOURS "
        f"FROM (SELECT cast({_NUMBER} AS varchar) AS PROVNUM, {_DAY} FROM lineitem)",
    "drop_footnotes": _with(PROVIDER, _file(_same, kept=False)),
    "sanitize_names": _with(PROVIDER, _file(_clean)),
    "standardize_names": _with(PROVIDER, _file(lambda n: n.upper().replace(" ", "_"))),
    "select_rename": _with(PROVIDER, "SELECT * FROM provider"),
    "select_rename_sanitized": _with(PROVIDER, "SELECT * FROM provider"),
    "schema_report": " UNION ALL ".join(
        f"SELECT {i} AS ordinal, '{c}' AS column_name, '{t}' AS data_type, "
        f"cast(count(*) - count({c}) AS bigint) AS null_count FROM lineitem"
        for i, (c, t) in enumerate(_LINEITEM.items(), start=1)),
    "schema_listing": " UNION ALL ".join(
        f"SELECT {i} AS ordinal, '{c}' AS column_name, '{t}' AS data_type"
        for i, (c, t) in enumerate(_LINEITEM.items(), start=1)),
    "require_columns_failure": _with(UNIQUE, """SELECT count(*) AS n_rows,
        'missing columns: [''STATE'']; available columns: [''PROVNUM'', ''PROVNAME'']' AS message
        FROM providers"""),
    "csv_quotes_roundtrip": """SELECT cast(p_partkey AS varchar) AS part, 'say "' || p_name ||
        '", ""twice""' || CASE WHEN p_partkey % 5 = 0 THEN chr(10) || 'next line' ELSE '' END AS said
        FROM part""",
    "csv_swapped_header": "SELECT count(*) AS written, 'header' AS told FROM orders",
    "csv_roundtrip": _pbj,
    "partitioned_roundtrip": _facility,
    "partitioned_csv_roundtrip": _quality,
    "table_roundtrip": _facility,
    "facility_projection": _with(FACILITY, "SELECT " + ", ".join(
        f"{c} AS {c.lower()}" for c in (
            "PROVNUM", "PROVNAME", "CERTIFIED_BEDS", "AVG_RESIDENTS", *RATINGS, "OCCUPANCY_RATE",
            "AVG_STAFFING_RATIO", "STAFFING_PRESSURE_INDEX", "STATE")) + " FROM facility"),
    "catalog_setup": _with(f"{FACILITY}, {VOLUME}", " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source}"
        for name, source in (
            ("staffing_metrics", "staffing"), ("facility_metrics", "facility"),
            ("quality_metrics", "quality"), ("top_patient_volume", "top_volume")))),
    "profile_saved_table": _with(
        PROVIDER, _nulls("provider", {_clean(h): c for h, c in _FILE_CELLS.items()})),
    "file_manifest_of_raw": _with(PROVIDER, f"""
        SELECT dataset, cast(row_bytes AS bigint) AS row_bytes, true AS names_agree, true AS bytes_agree FROM (
        SELECT 'NH_SurveyDates_Oct2024' AS dataset, sum(length(cast(o_orderkey AS varchar)) + 12 +
            CASE WHEN o_orderstatus = 'F' THEN length(o_orderpriority) ELSE 0 END + 1) AS row_bytes
        FROM orders UNION ALL
        SELECT 'NH_StateUSAverages_Oct2024', sum(length(cast(c_nationkey AS varchar)) + 1 + length(cast(n AS varchar)) + 1)
        FROM (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY c_nationkey) UNION ALL
        SELECT 'NH_ProviderInfo_Oct2024', sum({_PROVIDER_BYTES}) FROM provider UNION ALL
        SELECT 'PBJ_Daily_Nurse_Staffing_Q2_2024', NULL)"""),
    "file_manifest_bytes": """SELECT cast(sum(length(cast(o_orderkey AS varchar)) + 12 +
        CASE WHEN o_orderstatus = 'F' THEN length(o_orderpriority) ELSE 0 END + 1) AS bigint)
        AS row_bytes FROM orders""",
    "bronze_load": _with(PROVIDER, _file(_same, text=True)),
    "bronze_unfit_rows": """SELECT cast(p_partkey AS varchar) AS number,
        CASE WHEN p_partkey % 4 <> 1 THEN p_name END AS name,
        CASE p_partkey % 4 WHEN 1 THEN cast(p_partkey AS varchar)
             WHEN 2 THEN cast(p_partkey AS varchar) || ',' || p_name || ',more' END AS _unfit_row
        FROM part""",
    "bronze_row_counts": _with(f"{PBJ}, {PROVIDER}", """
        SELECT 'PBJ_Daily_Nurse_Staffing_Q2_2024' AS dataset, count(*) AS row_count FROM pbj
        UNION ALL SELECT 'NH_ProviderInfo_Oct2024', count(*) FROM provider
        UNION ALL SELECT 'NH_StateUSAverages_Oct2024', count(DISTINCT c_nationkey) FROM customer
        UNION ALL SELECT 'NH_SurveyDates_Oct2024', count(*) FROM orders"""),
    "incremental_bronze_load": _with(PROVIDER, _file(_same, text=True)),
    "silver_provider": _with(PROVIDER, _file(_same, kept=False)),
    "silver_pbj": _pbj,
    "silver_state_averages": """SELECT cast(c_nationkey AS varchar) AS "State (number)",
        cast(count(*) AS varchar) AS "Facilities, counted" FROM customer GROUP BY c_nationkey""",
    "silver_survey_dates": """SELECT cast(o_orderkey AS varchar) AS "Survey Number",
        cast(cast(o_orderdate AS date) AS varchar) AS "Survey Date (first)" FROM orders""",
    "staffing_from_raw": _staffing,
    "facility_from_raw": _facility,
    "quality_from_raw": _quality,
    "volume_from_raw": _top_volume,
    "state_cards_from_raw": _with(FACILITY, _cards(_IN_STATE)),
    "gold_views": _with(QUALITY, """SELECT STATE, count(*) AS facilities,
        count(FACILITY_QUALITY_SCORE) AS scored FROM quality GROUP BY STATE"""),
    "gold_of_one_month": _with(STAFFING.replace(PBJ, _changed(
        "MDScensus + CASE WHEN year(WorkDate) = 1995 AND month(WorkDate) = 3 THEN 1 ELSE 0 END")),
        "SELECT * FROM staffing"),
    "lake_staffing": _with(STAFFING.replace(PBJ, _CORRECTED), "SELECT * FROM staffing"),
    "lake_facility": _with(FACILITY.replace(PBJ, _CORRECTED), "SELECT * FROM facility"),
    "lake_volume": _with(f"{_CORRECTED}, {VOLUME}", "SELECT * FROM top_volume"),
    "lake_before_the_change": _with(
        STAFFING.replace(PBJ, _changed("MDScensus", " WHERE year(WorkDate) < 2001")),
        "SELECT *, 'no column ''Staffing Rating''' AS told FROM staffing"),
    # The first file gone, the second with its rows twice, the third new.
    "manifest_changes": """
        WITH f AS (
        SELECT 'NH_SurveyDates_Oct2024' AS dataset, o_orderkey % 3 AS file, 14 AS header,
            sum(length(cast(o_orderkey AS varchar)) + 1) AS n FROM orders GROUP BY ALL UNION ALL
        SELECT 'NH_StateUSAverages_Oct2024', c_custkey % 3, 6, sum(length(cast(c_custkey AS varchar)) + 1)
        FROM customer GROUP BY ALL UNION ALL
        SELECT DISTINCT 'PBJ_Daily_Nurse_Staffing_Q2_2024', day(l_shipdate) % 3, 0, NULL FROM lineitem UNION ALL
        SELECT 'NH_ProviderInfo_Oct2024', 0, 0, NULL)
        SELECT dataset, file || '.csv' AS file_name, ['gone', 'changed', 'new'][file + 1] AS change,
            cast(CASE file WHEN 0 THEN -n - header WHEN 1 THEN n ELSE n + header END AS bigint) AS more_bytes FROM f""",
    "rewritten_file": """SELECT cast(o_orderkey AS varchar) AS number,
        CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE 'anew' END AS said
        FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 <> 0""",
    "columns_by_name": """SELECT cast(o_orderkey AS varchar) AS number, o_orderstatus AS status,
        CASE WHEN o_orderkey % 3 = 2 THEN o_orderpriority END AS priority,
        ['a.csv', 'b.csv', 'c.csv'][o_orderkey % 3 + 1] AS _source_file FROM orders""",
    "layouts": """SELECT * FROM (VALUES (1, 2, 'number', 1), (1, 2, 'status', 2), (1, 2, 'priority', NULL),
        (2, 1, 'number', 3), (2, 1, 'status', 2), (2, 1, 'priority', 1)) AS t(layout, n_files, column_name, position)""",
    "large_totals": """
        WITH v AS (SELECT l_returnflag, l_linestatus, l_orderkey = 1 AND l_linenumber = 1 AS nan,
            cast(round(round(l_extendedprice * 10000000::double) * 1000000::double) AS hugeint) AS units FROM lineitem),
        g AS (SELECT l_returnflag, l_linestatus, bool_or(nan) AS spoiled, cast(sum(units) AS double) / 1000000::double AS total,
            count(*) AS n FROM v GROUP BY ALL)
        SELECT l_returnflag, l_linestatus, spoiled, CASE WHEN NOT spoiled THEN total END AS total,
            CASE WHEN NOT spoiled THEN total / n END AS mean FROM g""",
    "state_tops_of_pressure": _with(FACILITY, _state_tops("facility", "STAFFING_PRESSURE_INDEX", 3)),
    "state_tops_of_volume": _with(f"{PBJ}, {VOLUME}", _state_tops("volume", "TOTAL_PATIENT_DAYS", 2)),
    "facility_sketches": _with(PBJ, f"""
        SELECT 'all' AS scope, count(DISTINCT PROVNUM) AS exact, true AS close FROM pbj
        UNION ALL SELECT '{STATE}', count(DISTINCT PROVNUM), true FROM pbj{_IN_STATE}"""),
    "null_counts_of_files": _with(PBJ, "SELECT " + ", ".join(
        f"cast(count(*) - count({c}) AS bigint) AS {c}" for c in PBJ_COLUMNS) + " FROM pbj"),
    "duplicate_documents_by_digest":
        "SELECT text, lang, source, n_chars, count(*) AS dup_count FROM documents "
        "GROUP BY ALL HAVING count(*) > 1",
    "row_count_of_days": 'SELECT count(*) AS "count" FROM lineitem',
    "preview_staffing": _staffing + f" ORDER BY {FIRST}, YEAR, MONTH LIMIT 10",
    "preview_facility": _facility + " ORDER BY PROVNUM LIMIT 10",
    "preview_quality": _quality + " ORDER BY PROVNUM LIMIT 10",
    "preview_volume": _top_volume + " ORDER BY PROVNUM",
}
