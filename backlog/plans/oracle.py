"""The registered queries in SQL, for a second engine over the same star-schema tables."""

from __future__ import annotations

from collections.abc import Iterable

# The columns of a project table, and the flattened headers of the withdrawn sheet with their columns.
_COLUMN_NAMES = (
    "project_name", "queue_position", "request_receive_date", "queue_date", "study_process", "fuel_type_1",
    "fuel_type_2", "fuel_type_3", "mw_1", "mw_2", "mw_3", "net_mw", "county", "state", "utility",
    "pto_study_region", "proposed_online_date", "current_online_date", "ingestion_date", "fuel_types",
    "latitude", "longitude",
)
_WITHDRAWN_HEADERS = (
    ("Unnamed: 0_level_0 Project Name - Confidential", "project_name"),
    ("Unnamed: 1_level_0 Queue Position", "queue_position"),
    ("Unnamed: 2_level_0 Interconnection Request\nReceive Date", "request_receive_date"),
    ("Unnamed: 3_level_0 Queue Date", "queue_date"),
    ("Unnamed: 6_level_0 Study\nProcess", "study_process"),
    ("Generating Facility Fuel-1", "fuel_type_1"),
    ("Generating Facility Fuel-2", "fuel_type_2"),
    ("Generating Facility Fuel-3", "fuel_type_3"),
    ("MWs MW-1", "mw_1"),
    ("MWs Net MWs to Grid", "net_mw"),
    ("Location County", "county"),
    ("Location State", "state"),
    ("Point of Interconnection PTO Study Region", "pto_study_region"),
    ("Point of Interconnection Proposed\nOn-line Date\n(as filed with IR)", "proposed_online_date"),
    ("Point of Interconnection Current\nOn-line Date", "current_online_date"),
)

_ACTIVE_HEADERS = tuple(
    ({"project_name": "Unnamed: 0_level_0 Project Name", "study_process": "Unnamed: 5_level_0 Study\nProcess"}.get(column, header), column)
    for header, column in _WITHDRAWN_HEADERS
)
_CLUSTER_NAMES = (
    "queue_position", "project_name", "fuel_type_1", "mw_1", "fuel_type_2", "mw_2", "fuel_type_3", "mw_3", "net_mw", "county", "state",
    "pto_study_region", "utility", "proposed_online_date", "queue_date", "request_receive_date", "withdrawal_date", "ingestion_date",
    "fuel_types", "study_process", "application_status", "latitude", "longitude",
)

_WITH = r"""
WITH capacity AS (
  SELECT l_orderkey AS capacity_key,
    SUM(CASE WHEN l_linenumber = 1 THEN l_quantity END) AS mw_1,
    SUM(CASE WHEN l_linenumber = 2 THEN l_quantity END) AS mw_2,
    SUM(CASE WHEN l_linenumber = 3 THEN l_quantity END) AS mw_3,
    SUM(l_quantity) AS net_mw,
    MIN(CASE WHEN l_linenumber = 1 THEN l_shipdate END) AS ship_1,
    MIN(CASE WHEN l_linenumber = 2 THEN l_shipdate END) AS ship_2
  FROM lineitem GROUP BY l_orderkey),
fuels AS (
  SELECT l_orderkey AS fuel_key,
    MIN(CASE WHEN l_linenumber = 1 THEN p_type END) AS fuel_type_1,
    MIN(CASE WHEN l_linenumber = 2 THEN p_type END) AS fuel_type_2,
    MIN(CASE WHEN l_linenumber = 3 THEN p_type END) AS fuel_type_3
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey),
base AS (
  SELECT
    CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Completed' ELSE 'Withdrawn' END AS status,
    c_name AS project_name,
    CASE WHEN o_orderkey % 101 = 0 THEN '  ' WHEN o_orderkey % 103 = 0 THEN NULL
         ELSE CAST(o_custkey AS VARCHAR) END AS queue_position,
    o_orderdate + INTERVAL '1' HOUR * (7 + o_custkey % 2) AS request_receive_date,
    o_orderdate + INTERVAL '1' DAY * (o_orderkey % 40) + INTERVAL '1' HOUR * (7 + o_orderkey % 2) AS queue_date,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderpriority = '1-URGENT' THEN 'C01'
         WHEN o_orderpriority = '2-HIGH' THEN 'C14' WHEN o_orderpriority = '3-MEDIUM' THEN 'TC'
         WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Serial LGIP'
         WHEN o_orderpriority = '5-LOW' THEN 'ISP' ELSE coalesce(o_orderpriority, 'ISP') END AS study_process,
    fuel_type_1, fuel_type_2, fuel_type_3, mw_1, mw_2, mw_3, net_mw,
    CASE o_orderkey % 7 WHEN 0 THEN n_name || '/NATION_0' WHEN 1 THEN ' ' || lower(n_name) || ' County '
         WHEN 2 THEN 'NOWHERE' WHEN 3 THEN NULL ELSE n_name END AS county,
    r_name AS state, c_mktsegment AS utility, n_name AS pto_study_region,
    ship_1 + INTERVAL '1' HOUR * (7 + o_orderkey % 2) AS proposed_online_date,
    ship_2 + INTERVAL '1' HOUR * (7 + o_custkey % 2) AS current_online_date,
    CAST(date_trunc('year', o_orderdate) AS DATE) AS ingestion_date,
    concat_ws('/', nullif(fuel_type_1, ''), nullif(fuel_type_2, ''), nullif(fuel_type_3, '')) AS fuel_types
  FROM orders
  LEFT JOIN capacity ON o_orderkey = capacity_key
  LEFT JOIN fuels ON o_orderkey = fuel_key
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey),
places AS (
  SELECT r_name AS p_state, n_name AS p_county,
    30 + n_nationkey * 0.5::DOUBLE AS lat, -120 + n_nationkey * 0.5::DOUBLE AS lon
  FROM nation JOIN region ON n_regionkey = r_regionkey),
places_by_name AS (
  SELECT p_county AS name_county, arg_max(lat, p_state) AS name_lat, arg_max(lon, p_state) AS name_lon
  FROM places GROUP BY p_county),
parts AS (
  SELECT county, state, trim(replace(trim(part), ' COUNTY', '')) AS part
  FROM (SELECT county, state, unnest(string_split(upper(trim(county)), '/')) AS part
        FROM (SELECT DISTINCT county, state FROM base WHERE county IS NOT NULL AND state IS NOT NULL))),
centroids AS (
  SELECT county, state, avg(coalesce(lat, name_lat)) AS latitude, avg(coalesce(lon, name_lon)) AS longitude
  FROM parts LEFT JOIN places ON part = p_county AND upper(trim(state)) = p_state
  LEFT JOIN places_by_name ON part = name_county GROUP BY county, state),
projects AS (
  SELECT base.*, latitude, longitude FROM base
  LEFT JOIN centroids ON base.county = centroids.county AND base.state = centroids.state),
latest AS (
  SELECT p.* FROM projects p
  JOIN (SELECT status AS st, MAX(ingestion_date) AS d FROM projects GROUP BY status) m
    ON p.status = m.st AND p.ingestion_date = m.d),
filled AS (SELECT * FROM projects WHERE trim(queue_position) <> ''),
cluster AS (
  SELECT queue_position, project_name, fuel_type_1, mw_1, fuel_type_2, mw_2, fuel_type_3, mw_3, net_mw,
    county, state, pto_study_region, utility, proposed_online_date, queue_date, request_receive_date,
    CASE WHEN status = 'Withdrawn' THEN current_online_date END AS withdrawal_date,
    fuel_types, 'C15' AS study_process, status AS application_status,
    CAST(date_trunc('year', request_receive_date) AS DATE) AS ingestion_date, latitude, longitude
  FROM filled WHERE status IN ('Active', 'Withdrawn'))
"""

_FILTER = "study_process IN ('C01', 'C14', 'TC')"
_COLUMNS = ", ".join(_COLUMN_NAMES)
_KEPT = "status, queue_position, project_name, net_mw, ingestion_date"
_AGAIN = "status, queue_position, project_name, net_mw + 1 AS net_mw, ingestion_date"
_DAYS = "CAST(floor((epoch({b}) - epoch({a})) / 86400) AS BIGINT)"
_LEAD = _DAYS.format(a="request_receive_date", b="queue_date")
_DELAY = _DAYS.format(a="proposed_online_date", b="current_online_date")


def _case_mw(x: str) -> str:
    return (
        f"CASE WHEN {x} >= 1000 THEN printf('%.2f GW', {x} / 1000) ELSE printf('%.0f MW', {x}) END"
    )


def _status_counts(source: str, measure: str, total: str) -> str:
    return f"""
SELECT s.status, COUNT(p.status) AS project_count, {total.format(f'SUM({measure})')} AS total_mw
FROM (VALUES ('Active'), ('Completed'), ('Withdrawn')) s(status)
LEFT JOIN {source} p ON p.status = s.status GROUP BY s.status"""


def _rate(source: str, measure: str, empty: str) -> str:
    return f"""
SELECT coalesce(SUM(CASE WHEN status = 'Withdrawn' THEN {measure} END)
  / nullif(coalesce(SUM({measure}), 0), 0), {empty}) AS cancellation_rate FROM {source}"""


def _top(source: str, extra: str) -> str:
    payload = f"fuel_types, {extra} county, state"
    order = ", ".join(f"{c} NULLS FIRST" for c in payload.replace(",", " ").split())
    return f"""
SELECT project_name, queue_position, net_mw, {payload}, 'Active' AS status FROM (
  SELECT *, row_number() OVER (PARTITION BY project_name, queue_position ORDER BY net_mw DESC, {order}) AS rn
  FROM {source} WHERE status = 'Active' AND net_mw IS NOT NULL)
WHERE rn = 1
ORDER BY net_mw DESC, project_name NULLS FIRST, queue_position NULLS FIRST LIMIT 10"""


def _zones(source: str, measure: str) -> str:
    return f"""
SELECT pto_study_region AS iso_zone, SUM({measure}) AS total_mw FROM {source} WHERE status = 'Active'
GROUP BY pto_study_region ORDER BY total_mw DESC NULLS LAST, iso_zone NULLS FIRST LIMIT 5"""


def _interactive(source: str) -> dict[str, str]:
    """The interactive KPIs over all projects or over a filtered part of them."""
    return {
        "dash_capacity_by_fuel": f"""
SELECT fuel_types AS fuel, SUM(net_mw) AS total_mw FROM {source} WHERE status = 'Active' GROUP BY fuel_types""",
        "dash_status_counts": _status_counts(source, "net_mw", "coalesce({}, 0)"),
        "dash_top_zones": _zones(source, "net_mw"),
        "dash_cancellation_rate": _rate(source, "net_mw", "0"),
        "dash_lead_time": f"""
SELECT coalesce(avg({_LEAD}), 0) AS average_lead_time_days FROM {source} WHERE status = 'Active'""",
        "dash_top_projects": _top(source, "study_process,"),
        "dash_delay_by_fuel": f"""
SELECT fuel_types AS fuel,
  avg(epoch(current_online_date) - epoch(proposed_online_date)) / 86400.0::DOUBLE AS avg_delay_days
FROM {source} WHERE status = 'Active' AND current_online_date > proposed_online_date GROUP BY fuel_types""",
        "lead_time_bands": f"""
SELECT band, COUNT(*) AS project_count FROM (
  SELECT CASE WHEN d < 0 THEN 'below 0' WHEN d < 60 THEN '0-60' WHEN d < 120 THEN '60-120' ELSE '120+' END AS band
  FROM (SELECT {_LEAD} AS d FROM {source} WHERE status = 'Active'
        AND request_receive_date IS NOT NULL AND queue_date IS NOT NULL)) GROUP BY band""",
        "overview": f"""
SELECT COUNT(*) FILTER (status = 'Active') AS active_projects,
  coalesce(SUM(net_mw) FILTER (status = 'Active'), 0) AS active_mw,
  COUNT(*) FILTER (status = 'Completed') AS completed_projects,
  coalesce(SUM(net_mw) FILTER (status = 'Completed'), 0) AS completed_mw,
  COUNT(*) AS total_projects, coalesce(SUM(net_mw), 0) AS total_mw,
  coalesce(SUM(net_mw) FILTER (status = 'Withdrawn') / nullif(SUM(net_mw), 0), 0) AS cancellation_rate,
  coalesce(avg({_LEAD}) FILTER (status = 'Active'), 0) AS average_lead_time_days
FROM {source}""",
        "study_summary": f"""
SELECT study_process, COUNT(*) AS project_count, SUM(net_mw) AS total_mw FROM {source}
WHERE study_process IS NOT NULL GROUP BY study_process""",
        "all_projects": f"SELECT {_COLUMNS}, status FROM {source}",
    }


def _column_counts(select: str, columns: Iterable[tuple[str, str]], source: str) -> str:
    rows = [
        select.format(position=i, name=name.replace("'", "''"), expr=expr)
        + f" FROM {source}"
        for i, (name, expr) in enumerate(columns, start=1)
    ]
    return " UNION ALL ".join(rows)


_TYPES = {
    **{c: "double" for c in ("mw_1", "mw_2", "mw_3", "net_mw", "latitude", "longitude")},
    **{
        c: "timestamp_ntz"
        for c in ("request_receive_date", "queue_date", "proposed_online_date", "current_online_date", "withdrawal_date")
    },
    "ingestion_date": "date",
}

_UPSERTED = """
SELECT {kept} FROM filled e WHERE {existing} AND NOT EXISTS (
  SELECT 1 FROM filled i WHERE {incoming} AND i.status = e.status AND i.queue_position = e.queue_position
    AND e.ingestion_date < i.ingestion_date)
UNION ALL SELECT {again} FROM filled e WHERE {appended}"""

_AT_2001 = _UPSERTED.format(
    kept=_KEPT, again=_AGAIN,
    existing="ingestion_date IS DISTINCT FROM DATE '2001-01-01'",
    incoming="i.ingestion_date = DATE '2001-01-01'",
    appended="ingestion_date = DATE '2001-01-01'",
)

_SUPERSEDED = """
SELECT status, ingestion_date, COUNT(*) AS superseded_rows FROM projects e
WHERE ingestion_date < DATE '2001-01-01' AND EXISTS (
  SELECT 1 FROM filled i WHERE i.ingestion_date = DATE '2001-01-01'
    AND i.status = e.status AND i.queue_position = e.queue_position)
GROUP BY status, ingestion_date"""

_QUALITY = """
SELECT table_name, 'missing_table' AS check_name, '' AS column_name, 0::BIGINT AS issue_count,
  CAST(NULL AS DOUBLE) AS pct, false AS failed
FROM (VALUES ('grid_generation_queue'), ('completed_projects'), ('withdrawn_projects')) t(table_name)
UNION ALL
SELECT table_name, 'missing_column', column_name, 0::BIGINT, NULL, false
FROM (VALUES ('grid_generation_queue'), ('completed_projects'), ('withdrawn_projects')) t(table_name),
     (VALUES ('queue_position'), ('ingestion_date'), ('mw_1'), ('project_name')) c(column_name)
UNION ALL
SELECT table_name, 'empty_value', column_name, issues, issues / n_rows * 100, issues > 0 FROM (
  SELECT table_name, column_name, COUNT(*) AS n_rows, CAST(COUNT(*) FILTER (v IS NULL OR v = '') AS BIGINT) AS issues
  FROM (
    SELECT CASE status WHEN 'Active' THEN 'grid_generation_queue' WHEN 'Completed' THEN 'completed_projects'
             ELSE 'withdrawn_projects' END AS table_name, column_name, v
    FROM (SELECT status, 'queue_position' AS column_name, queue_position AS v FROM projects
          UNION ALL SELECT status, 'project_name', project_name FROM projects))
  GROUP BY table_name, column_name)"""

_BROWSED = """
SELECT project_name, queue_position, county, state, fuel_types, net_mw, status FROM projects
WHERE (contains(fuel_types, 'PROMO') OR contains(fuel_types, 'SMALL')) AND state IN ('ASIA', 'EUROPE')
  AND coalesce(net_mw, 0) >= 50 AND regexp_matches(project_name, 'customer#0+[1-9]', 'i')"""

_LOCATIONS = """
SELECT project_name, trim(regexp_replace(county, ' County', '', 'gi')) AS county, state, net_mw AS capacity,
  latitude, longitude, status FROM projects
WHERE county IS NOT NULL AND state IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL"""

_STUDIES = """
SELECT DISTINCT study_process FROM projects WHERE study_process IS NOT NULL
UNION SELECT 'C15' FROM projects
WHERE TRY_CAST(regexp_extract(study_process, '^C0*([0-9]+)$', 1) AS BIGINT) >= 14"""

_PLAIN = {
    "snapshot_scan": f"""
SELECT project_name, queue_position, request_receive_date, queue_date, study_process, fuel_type_1, fuel_type_2,
  fuel_type_3, mw_1, net_mw, county, state, pto_study_region, proposed_online_date, current_online_date,
  ingestion_date, fuel_types, latitude, longitude, status FROM projects""",
    "snapshot_ranges": """
SELECT project_name, queue_position, request_receive_date, queue_date, study_process,
  nullif(fuel_type_1, '') AS fuel_type_1, nullif(fuel_type_2, '') AS fuel_type_2, nullif(fuel_type_3, '') AS fuel_type_3,
  mw_1, net_mw, county, state, pto_study_region, proposed_online_date, current_online_date,
  ingestion_date, fuel_types, latitude, longitude FROM projects WHERE status = 'Active'""",
    "newest_file": """
SELECT queue_position, project_name, ingestion_date, status, 'queue-report-' || strftime(ingestion_date, '%m%d%Y') || '.csv' AS file_name
FROM latest""",
    "found_place_columns": """
SELECT status, queue_position, county AS project_county, state AS project_state, latitude, longitude FROM projects""",
    "snapshot_files": """
SELECT project_name, queue_position, request_receive_date, queue_date, study_process,
  nullif(fuel_type_1, '') AS fuel_type_1, nullif(fuel_type_2, '') AS fuel_type_2, nullif(fuel_type_3, '') AS fuel_type_3,
  mw_1, net_mw, county, state, pto_study_region, proposed_online_date, current_online_date,
  ingestion_date, fuel_types, latitude, longitude, status FROM projects""",
    # In a file an empty cell is no value.
    "cluster_files": """
SELECT * REPLACE (nullif(fuel_type_1, '') AS fuel_type_1, nullif(fuel_type_2, '') AS fuel_type_2,
  nullif(fuel_type_3, '') AS fuel_type_3) FROM cluster""",
    "header_flatten": " UNION ALL ".join(
        _column_counts(
            f"SELECT '{status}' AS status, {{position}} AS position, '{{name}}' AS header, COUNT({{expr}}) AS filled_rows",
            _WITHDRAWN_HEADERS if status == "Withdrawn" else _ACTIVE_HEADERS,
            f"projects WHERE status = '{status}'",
        )
        for status in ("Active", "Completed", "Withdrawn")
    ),
    "column_rename": "SELECT "
    + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for _, c in _WITHDRAWN_HEADERS)
    + ", ingestion_date, status FROM projects",
    "drop_blank_key": "SELECT status, ingestion_date, COUNT(*) AS kept_rows FROM filled GROUP BY ALL",
    "fuel_types": """
SELECT fuel_type_1, fuel_type_2, fuel_type_3, fuel_types, COUNT(*) AS project_count FROM projects GROUP BY ALL""",
    "cluster_union": "SELECT * EXCLUDE (fuel_types, latitude, longitude) FROM cluster",
    "cluster_projects": "SELECT * FROM cluster",
    "cluster_display": """
SELECT queue_position, project_name, fuel_types, net_mw, county, state, application_status, pto_study_region,
  proposed_online_date FROM cluster""",
    "active_projects": f"SELECT {_COLUMNS}, status FROM projects WHERE status = 'Active'",
    "snapshot_date_parse": r"""
SELECT file_name, COUNT(*) AS row_count,
  CAST(try_strptime(regexp_extract(file_name, '-([0-9]{8})\.[^./]*$', 1), '%m%d%Y') AS DATE) AS snapshot_date
FROM (SELECT CASE WHEN study_process IS NULL THEN 'queue-report.csv'
        WHEN status = 'Withdrawn' THEN 'queue-report-99' || strftime(ingestion_date, '%d%Y') || '.csv'
        ELSE 'queue-report-' || strftime(ingestion_date, '%m%d%Y') || '.csv' END AS file_name FROM projects)
GROUP BY file_name""",
    "table_inventory": f"""
SELECT CASE status WHEN 'Active' THEN 'grid_generation_queue' WHEN 'Completed' THEN 'completed_projects'
  ELSE 'withdrawn_projects' END AS table_name, COUNT(*) AS row_count, {len(_COLUMN_NAMES)} AS column_count,
  MAX(ingestion_date) AS latest_snapshot FROM projects GROUP BY status
UNION ALL SELECT 'cluster_15_requests', COUNT(*), 23, MAX(ingestion_date) FROM cluster""",
    "table_columns": " UNION ALL ".join(
        _column_counts(
            f"SELECT '{table}' AS table_name, {{position}} AS position, '{{name}}' AS column_name, {{expr}} AS filled_rows",
            [(c, f"'{_TYPES.get(c, 'string')}' AS data_type, COUNT({c})") for c in names],
            source,
        )
        for table, names, source in (
            ("grid_generation_queue", _COLUMN_NAMES, "projects WHERE status = 'Active'"),
            ("completed_projects", _COLUMN_NAMES, "projects WHERE status = 'Completed'"),
            ("withdrawn_projects", _COLUMN_NAMES, "projects WHERE status = 'Withdrawn'"),
            ("cluster_15_requests", _CLUSTER_NAMES, "cluster"),
        )
    ),
    "safe_numeric": r"""
SELECT c_custkey, coalesce(TRY_CAST(t AS DOUBLE), 0) AS text_float, coalesce(TRY_CAST(t AS DOUBLE), -1) AS text_float_default,
  CASE WHEN regexp_full_match(trim(t), '[+-]?[0-9]+') THEN CAST(trim(t) AS BIGINT) ELSE -1 END AS text_int,
  CAST(trunc(c_acctbal) AS BIGINT) AS number_int
FROM (SELECT c_custkey, c_acctbal, CASE c_custkey % 5 WHEN 0 THEN CAST(c_acctbal AS VARCHAR)
        WHEN 1 THEN ' ' || c_custkey || ' ' WHEN 2 THEN c_name WHEN 3 THEN '' END AS t FROM customer)""",
    "latest_snapshot": f"SELECT {_KEPT} FROM latest",
    "latest_active_rows": f"SELECT {_KEPT} FROM latest WHERE status = 'Active'",
    "latest_rows_ranged": f"SELECT {_KEPT} FROM projects WHERE ingestion_date = (SELECT MAX(ingestion_date) FROM projects)",
    "largest_rows": f"""
SELECT {_KEPT} FROM projects WHERE net_mw IS NOT NULL
ORDER BY net_mw DESC, status, queue_position NULLS FIRST, project_name NULLS FIRST, ingestion_date NULLS FIRST LIMIT 100""",
    "retention": """
SELECT status, ingestion_date, COUNT(*) AS kept_rows, SUM(net_mw) AS kept_mw FROM projects
WHERE ingestion_date IS NULL OR ingestion_date >= DATE '2000-06-30' - 364 GROUP BY ALL""",
    "snapshot_upsert": _AT_2001,
    "snapshot_upsert_late": _UPSERTED.format(
        kept=_KEPT, again=_AGAIN,
        existing="ingestion_date IS DISTINCT FROM DATE '1998-01-01'",
        incoming="i.ingestion_date = DATE '1998-01-01'",
        appended="ingestion_date = DATE '1998-01-01'",
    ),
    "snapshot_upsert_batch": _UPSERTED.format(
        kept=_KEPT, again=_AGAIN,
        existing="coalesce(ingestion_date < DATE '1999-01-01', true)",
        incoming="i.ingestion_date >= DATE '1999-01-01'",
        appended="""ingestion_date >= DATE '1999-01-01' AND NOT EXISTS (
  SELECT 1 FROM filled i WHERE i.ingestion_date > e.ingestion_date AND i.status = e.status
    AND i.queue_position = e.queue_position)""",
    ),
    "superseded_rows": _SUPERSEDED,
    "snapshot_upsert_bucketed": _AT_2001,
    "raw_header_load": f"SELECT queue_position, project_name, net_mw, ingestion_date FROM ({_AT_2001}) WHERE status = 'Withdrawn'",
    "load_counts_observed": f"""
SELECT CASE s WHEN 'Active' THEN 'grid_generation_queue' WHEN 'Completed' THEN 'completed_projects' ELSE 'withdrawn_projects' END AS table_name,
  (SELECT COUNT(*) FROM projects WHERE status = s AND ingestion_date = DATE '2001-01-01') AS rows_read,
  (SELECT COUNT(*) FROM projects WHERE status = s AND ingestion_date = DATE '2001-01-01' AND coalesce(trim(queue_position), '') = '')
    AS rows_dropped,
  (SELECT COUNT(*) FROM filled WHERE status = s AND ingestion_date = DATE '2001-01-01') AS rows_written,
  (SELECT COUNT(*) FROM filled WHERE status = s AND ingestion_date = DATE '2001-01-01') AS rows_replaced,
  (SELECT CAST(coalesce(SUM(superseded_rows), 0) AS BIGINT) FROM ({_SUPERSEDED}) WHERE status = s) AS rows_superseded
FROM (VALUES ('Active'), ('Completed'), ('Withdrawn')) t(s)""",
    "kept_sums_after_load": "SELECT status, ingestion_date, study_process, COUNT(*) AS project_count, coalesce(SUM(net_mw), 0) AS total_mw FROM ("
    + _UPSERTED.format(
        kept="status, ingestion_date, study_process, net_mw", again="status, ingestion_date, study_process, net_mw + 1",
        existing="ingestion_date IS DISTINCT FROM DATE '2001-01-01'",
        incoming="i.ingestion_date = DATE '2001-01-01'",
        appended="ingestion_date = DATE '2001-01-01'",
    )
    + ") GROUP BY ALL",
    "duplicate_keys_per_table": """
SELECT status, queue_position, COUNT(*) AS count, row_number() OVER (PARTITION BY status ORDER BY COUNT(*) DESC, queue_position) AS position
FROM filled GROUP BY status, queue_position HAVING COUNT(*) > 1 QUALIFY position <= 10""",
    "load_counts": f"""
SELECT (SELECT COUNT(*) FROM projects WHERE ingestion_date = DATE '2001-01-01') AS rows_read,
  (SELECT COUNT(*) FROM projects WHERE ingestion_date = DATE '2001-01-01' AND coalesce(trim(queue_position), '') = '')
    AS rows_dropped,
  (SELECT COUNT(*) FROM filled WHERE ingestion_date = DATE '2001-01-01') AS rows_written,
  (SELECT COUNT(*) FROM filled WHERE ingestion_date = DATE '2001-01-01') AS rows_replaced,
  (SELECT CAST(SUM(superseded_rows) AS BIGINT) FROM ({_SUPERSEDED})) AS rows_superseded""",
    "duplicate_keys": """
SELECT status, queue_position, COUNT(*) AS count FROM filled GROUP BY status, queue_position
HAVING COUNT(*) > 1 ORDER BY count DESC, status, queue_position LIMIT 10""",
    "weekly_growth": """
SELECT status, ingestion_date, weekly_mw,
  weekly_mw - lag(weekly_mw) OVER (PARTITION BY status ORDER BY ingestion_date) AS growth_mw
FROM (SELECT status, ingestion_date, SUM(mw_1) AS weekly_mw FROM projects
      WHERE ingestion_date IS NOT NULL GROUP BY ALL)""",
    "capacity_by_fuel": """
SELECT fuel_types AS fuel, SUM(mw_1) AS total_mw FROM latest WHERE status = 'Active' GROUP BY fuel_types""",
    "status_counts": _status_counts("latest", "mw_1", "{}"),
    "top_zones": _zones("latest", "mw_1"),
    "cancellation_rate": _rate("latest", "mw_1", "NULL"),
    "lead_time": f"SELECT avg({_LEAD}) AS average_lead_time_days FROM latest WHERE status = 'Active'",
    "top_projects": _top("latest", ""),
    "delay_detail": f"""
SELECT project_name, queue_position, proposed_online_date, current_online_date, fuel_types, {_DELAY} AS delay_days
FROM latest WHERE status = 'Active' AND proposed_online_date IS NOT NULL AND current_online_date IS NOT NULL""",
    "delay_summary": f"""
SELECT avg(d) AS average_delay_days, median(d) AS median_delay_days, min(d) AS min_delay_days,
  max(d) AS max_delay_days, COUNT(*) FILTER (d > 0) AS positive_delay_count,
  COUNT(*) FILTER (d < 0) AS negative_delay_count, COUNT(*) FILTER (d = 0) AS no_change_count,
  coalesce(COUNT(*) FILTER (d > 0) / nullif(COUNT(*), 0) * 100, 0) AS delay_percentage
FROM (SELECT {_DELAY} AS d FROM latest WHERE status = 'Active') WHERE d IS NOT NULL""",
    "delay_by_fuel": f"""
SELECT fuel_types AS fuel_type, avg(d) AS average_delay_days
FROM (SELECT fuel_types, {_DELAY} AS d FROM latest WHERE status = 'Active') WHERE d IS NOT NULL GROUP BY fuel_types""",
    "study_processes": _STUDIES,
    "cluster_summary": "SELECT COUNT(*) AS total_projects, coalesce(SUM(net_mw), 0) AS total_mw FROM cluster",
    "cluster_capacity_by_fuel": "SELECT fuel_types AS fuel, SUM(net_mw) AS total_mw FROM cluster GROUP BY fuel_types",
    "latest_ingestion": """
SELECT MAX(ingestion_date) AS latest_ingestion_date
FROM (SELECT ingestion_date FROM projects UNION ALL SELECT ingestion_date FROM cluster)""",
    "latest_ingestion_label": """
SELECT coalesce(strftime(MAX(ingestion_date), '%B %d, %Y'), 'Unavailable') AS data_as_of
FROM (SELECT ingestion_date FROM projects UNION ALL SELECT ingestion_date FROM cluster)""",
    "study_labels": f"""
SELECT study_process, CASE
  WHEN regexp_full_match(study_process, 'C[0-9]+') THEN study_process || ' (Cluster ' || substr(study_process, 2) || ')'
  WHEN study_process = 'Serial LGIP' THEN 'Serial LGIP (Standard LGIP)'
  WHEN study_process = 'TC' THEN 'TC (Transition Cluster)'
  WHEN study_process = 'ISP' THEN 'ISP (Independent Study Process)'
  WHEN study_process = 'FT' THEN 'FT (Fast Track)'
  WHEN starts_with(study_process, 'SGIP') THEN study_process || ' (Small Generator)'
  ELSE study_process END AS label FROM ({_STUDIES})""",
    "capacity_labels": f"""
SELECT fuel, total_mw, {_case_mw('total_mw')} AS label
FROM (SELECT fuel_types AS fuel, SUM(net_mw) AS total_mw FROM projects WHERE status = 'Active' GROUP BY fuel_types)""",
    "projects_columns": f"""
SELECT project_name, queue_position, net_mw, ingestion_date, status FROM projects WHERE {_FILTER}""",
    "withdrawn_columns": f"""
SELECT queue_position, study_process, mw_1, status FROM projects WHERE status = 'Withdrawn' AND {_FILTER}""",
    "browse_table": """
SELECT project_name, queue_position, study_process, county, state, fuel_types, net_mw, mw_1, status FROM projects""",
    "fuel_categories_late": """
SELECT DISTINCT trim(fuel) AS fuel FROM (SELECT unnest(string_split(fuel_types, '/')) AS fuel FROM projects
  WHERE status = 'Active' AND current_online_date > proposed_online_date)""",
    "state_options": "SELECT DISTINCT state FROM projects WHERE state IS NOT NULL",
    "fuel_contains_any": """
SELECT fuel_types AS fuel, SUM(net_mw) AS total_mw FROM projects WHERE status = 'Active'
  AND (contains(fuel_types, 'PROMO') OR contains(fuel_types, 'SMALL')) GROUP BY fuel_types""",
    "browse_projects": _BROWSED,
    "browse_metrics": f"""
SELECT COUNT(*) AS total_projects, coalesce(SUM(net_mw), 0) AS total_mw, COUNT(DISTINCT status) AS unique_statuses
FROM ({_BROWSED})""",
    "browse_counties": """
SELECT project_name, queue_position, county, state, fuel_types, net_mw, status FROM projects
WHERE status = 'Active' AND county IN ('NATION_1', 'NATION_7', 'NOWHERE') AND coalesce(net_mw, 0) >= 10""",
    "name_search": """
SELECT status, project_name, queue_position FROM projects WHERE regexp_matches(project_name, 'R#0+[12]', 'i')""",
    "name_search_indexed": """
SELECT status, project_name, queue_position FROM projects WHERE regexp_matches(project_name, 'R#0+[12]', 'i')""",
    "browse_projects_indexed": _BROWSED,
    "csv_export": _BROWSED,
    "ordered_study_processes": f"""
SELECT study_process, row_number() OVER (
  ORDER BY TRY_CAST(nullif(regexp_extract(study_process, '^C0*([0-9]+)$', 1), '') AS BIGINT) NULLS LAST, study_process) AS position
FROM ({_STUDIES})""",
    "ordered_top_projects": f"""
SELECT project_name, queue_position, net_mw,
  row_number() OVER (ORDER BY net_mw DESC, project_name NULLS FIRST, queue_position NULLS FIRST) AS position FROM ({_top('latest', '')})""",
    "ordered_options": """
SELECT field, value, row_number() OVER (PARTITION BY field ORDER BY value) AS position FROM (
  SELECT DISTINCT 'county' AS field, county AS value FROM projects WHERE county IS NOT NULL
  UNION ALL SELECT DISTINCT 'state', state FROM projects WHERE state IS NOT NULL)""",
    "fuel_categories": "SELECT DISTINCT unnest(string_split(fuel_types, '/')) AS fuel FROM projects",
    "county_state_options": """
SELECT DISTINCT 'county' AS field, county AS value FROM projects WHERE county IS NOT NULL
UNION ALL SELECT DISTINCT 'state', state FROM projects WHERE state IS NOT NULL""",
    "project_locations": _LOCATIONS,
    "project_locations_withdrawn": _LOCATIONS + " AND status = 'Withdrawn'",
    "location_rollup": f"""
SELECT *, county || ' County, ' || state || '<br>Projects: ' || project_count || '<br>Total Capacity: '
  || {_case_mw('total_capacity')} AS label
FROM (SELECT county, state, latitude, longitude, COUNT(project_name) AS project_count,
        coalesce(SUM(capacity), 0) AS total_capacity FROM ({_LOCATIONS}) GROUP BY ALL)""",
    "zoom_cells": f"""
SELECT level, substr(key, 1, level) AS cell, COUNT(*) AS places, SUM(project_count) AS project_count, SUM(total_capacity) AS total_capacity
FROM (SELECT *, {' || '.join(f"CAST(((x >> {k}) & 1) + 2 * ((y >> {k}) & 1) AS VARCHAR)" for k in range(7, -1, -1))} AS key
  FROM (SELECT *, least(floor((longitude + 180) / 360 * 256), 255)::BIGINT AS x, least(floor((90 - latitude) / 180 * 256), 255)::BIGINT AS y
    FROM (SELECT county, state, latitude, longitude, COUNT(project_name) AS project_count, coalesce(SUM(capacity), 0) AS total_capacity
      FROM ({_LOCATIONS}) GROUP BY ALL) WHERE project_count > 0)), generate_series(0, 8) levels(level)
GROUP BY ALL""",
    "county_centroid": "SELECT county, state, latitude, longitude FROM centroids",
    "geo_enrich": "SELECT status, queue_position, county, state, latitude, longitude FROM projects",
    "places_off_the_globe": """
SELECT county, state, CASE WHEN abs(lat) <= 90 AND abs(lon) <= 180 THEN lat END AS latitude,
  CASE WHEN abs(lat) <= 90 AND abs(lon) <= 180 THEN lon END AS longitude
FROM (SELECT county, state, avg((coalesce(lat, name_lat) - 30) * 10) AS lat, avg((coalesce(lon, name_lon) + 120) * 16) AS lon
  FROM parts LEFT JOIN places ON part = p_county AND upper(trim(state)) = p_state
  LEFT JOIN places_by_name ON part = name_county GROUP BY county, state)""",
    "county_spelling": """
SELECT county, latitude, longitude, COUNT(*) AS project_count
FROM customer JOIN (VALUES
  (0, 'san bernadino', 34.8414::DOUBLE, -116.1781::DOUBLE), (1, ' San Clara County', 37.3541, -121.9552),
  (2, 'MOJAVE', 35.7047, -113.7578), (3, 'Church County', NULL, NULL), (4, 'Tecate Baja California Mexico', NULL, NULL),
  (5, 'Rosamond/Kern', 35.3425, -118.7299), (6, 'hyder', 42.9391, -114.7131)) s(n, county, latitude, longitude)
  ON c_custkey % 7 = n GROUP BY ALL""",
    "coordinate_coverage": """
SELECT COUNT(*) AS total_rows, COUNT(latitude) AS with_coordinates, COUNT(*) - COUNT(latitude) AS without_coordinates
FROM projects""",
    "data_quality": _QUALITY,
    "data_quality_failing": """
SELECT * FROM (VALUES
  ('grid_generation_queue', 'missing_table', '', 0::BIGINT, NULL::DOUBLE, false),
  ('grid_generation_queue', 'missing_column', 'queue_position', 0, NULL, false),
  ('grid_generation_queue', 'missing_column', 'ingestion_date', 0, NULL, false),
  ('grid_generation_queue', 'missing_column', 'mw_1', 0, NULL, false),
  ('grid_generation_queue', 'missing_column', 'project_name', 1, NULL, true),
  ('completed_projects', 'missing_table', '', 1, NULL, true),
  ('withdrawn_projects', 'missing_table', '', 0, NULL, false),
  ('withdrawn_projects', 'missing_column', 'queue_position', 0, NULL, false),
  ('withdrawn_projects', 'missing_column', 'ingestion_date', 1, NULL, true),
  ('withdrawn_projects', 'missing_column', 'mw_1', 1, NULL, true),
  ('withdrawn_projects', 'missing_column', 'project_name', 0, NULL, false)
) t(table_name, check_name, column_name, issue_count, pct, failed)
UNION ALL
SELECT 'grid_generation_queue', 'empty_value', 'queue_position', issues, issues / n_rows * 100, issues > 0
FROM (SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (coalesce(queue_position, '') = '') AS issues
      FROM projects WHERE status = 'Active') WHERE n_rows > 0
UNION ALL
SELECT 'grid_generation_queue', 'empty_table', '', 0, NULL, false
FROM (SELECT COUNT(*) AS n_rows FROM projects WHERE status = 'Active') WHERE n_rows = 0
UNION ALL
SELECT 'withdrawn_projects', 'empty_table', '', 0, NULL, false
FROM (SELECT COUNT(*) AS n_rows FROM projects WHERE status = 'Withdrawn' AND net_mw < 0) WHERE n_rows = 0""",
    "data_quality_total": f"SELECT COUNT(*) FILTER (failed) AS issues FROM ({_QUALITY})",
}


_KEPT_KPIS = ("capacity_by_fuel", "status_counts", "weekly_growth", "dash_top_zones", "overview", "study_summary_filtered")


def all_sql() -> dict[str, str]:
    everything = dict(_PLAIN)
    everything.update(_interactive("projects"))
    filtered = _interactive(f"(SELECT * FROM projects WHERE {_FILTER})")
    everything.update({f"{name}_filtered": sql for name, sql in filtered.items()})
    nothing = _interactive("(SELECT * FROM projects WHERE study_process = 'C99')")
    for name in ("dash_status_counts", "dash_cancellation_rate", "dash_lead_time", "overview"):
        everything[f"{name}_empty"] = nothing[name]
    for name in _KEPT_KPIS:  # from sums kept per snapshot: the same answers as from all projects
        everything[f"kept_{name}"] = everything[name]
    return {name: _WITH + sql.strip() for name, sql in everything.items()}
