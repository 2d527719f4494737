"""The order star schema read as a project backlog.

An order is a project, its lines are its generating units, the customer is the developer and
sits in a county (nation) of a state (region); the order status says which table it is in and
the order year which snapshot. Counties are written as untidily as in real sheets, some keys
are blank or null and some processes are missing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from backlog import schema as S
from backlog.operators.geo import Places, with_coordinates
from backlog.operators.shape import flatten_columns, shape_cluster_rows
from backlog.sources.tables import ProjectTables

# Order status of a table; whatever else there is counts as withdrawn.
_TABLE_ROWS = {
    S.ACTIVE: "o_orderstatus = 'O'",
    S.COMPLETED: "o_orderstatus = 'F'",
    S.WITHDRAWN: "o_orderstatus IS NULL OR o_orderstatus NOT IN ('O', 'F')",
}

_HOURS_BY_KEY = "INTERVAL '1' HOUR * (7 + o_orderkey % 2)"
_HOURS_BY_CUSTOMER = "INTERVAL '1' HOUR * (7 + o_custkey % 2)"

# Project columns by where their values come from.
_FROM_ORDER = {
    "status": """CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Completed'
        ELSE 'Withdrawn' END""",
    "queue_position": """CASE WHEN o_orderkey % 101 = 0 THEN '  ' WHEN o_orderkey % 103 = 0 THEN NULL
        ELSE CAST(o_custkey AS STRING) END""",
    "request_receive_date": f"o_orderdate + {_HOURS_BY_CUSTOMER}",
    "queue_date": f"o_orderdate + INTERVAL '1' DAY * (o_orderkey % 40) + {_HOURS_BY_KEY}",
    "study_process": """CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderpriority = '1-URGENT' THEN 'C01'
        WHEN o_orderpriority = '2-HIGH' THEN 'C14' WHEN o_orderpriority = '3-MEDIUM' THEN 'TC'
        WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Serial LGIP' WHEN o_orderpriority = '5-LOW' THEN 'ISP'
        ELSE coalesce(o_orderpriority, 'ISP') END""",
    "ingestion_date": "trunc(CAST(o_orderdate AS DATE), 'YEAR')",
}
_FROM_CAPACITY = {
    "mw_1": "mw_1",
    "mw_2": "mw_2",
    "mw_3": "mw_3",
    "net_mw": "net_mw",
    "proposed_online_date": f"ship_1 + {_HOURS_BY_KEY}",
    "current_online_date": f"ship_2 + {_HOURS_BY_CUSTOMER}",
}
_FROM_FUELS = {
    "fuel_type_1": "fuel_type_1",
    "fuel_type_2": "fuel_type_2",
    "fuel_type_3": "fuel_type_3",
    "fuel_types": "concat_ws('/', nullif(fuel_type_1, ''), nullif(fuel_type_2, ''), nullif(fuel_type_3, ''))",
}
_FROM_CUSTOMER = {
    "project_name": "c_name",
    "county": """CASE o_orderkey % 7 WHEN 0 THEN concat(n_name, '/NATION_0')
        WHEN 1 THEN concat(' ', lower(n_name), ' County ') WHEN 2 THEN 'NOWHERE' WHEN 3 THEN NULL
        ELSE n_name END""",
    "state": "r_name",
    "utility": "c_mktsegment",
    "pto_study_region": "n_name",
}
_FROM_NATION = {"county", "state", "pto_study_region"}
_COORDINATES = ("latitude", "longitude")
_EXPRESSIONS = {**_FROM_ORDER, **_FROM_CAPACITY, **_FROM_FUELS, **_FROM_CUSTOMER}

COLUMNS = (
    "project_name", "queue_position", "request_receive_date", "queue_date", "study_process",
    "fuel_type_1", "fuel_type_2", "fuel_type_3", "mw_1", "mw_2", "mw_3", "net_mw",
    "county", "state", "utility", "pto_study_region", "proposed_online_date",
    "current_online_date", "ingestion_date", "fuel_types", "latitude", "longitude",
)

# The columns of the raw sheet: two header levels and the project column behind them.
SHEET_LAYOUT = (
    (("Unnamed: 0_level_0", "Project Name"), "project_name"),
    (("Unnamed: 1_level_0", "Queue Position"), "queue_position"),
    (("Unnamed: 2_level_0", "Interconnection Request\nReceive Date"), "request_receive_date"),
    (("Unnamed: 3_level_0", "Queue Date"), "queue_date"),
    (("Unnamed: 5_level_0", "Study\nProcess"), "study_process"),
    (("Generating Facility", "Fuel-1"), "fuel_type_1"),
    (("Generating Facility", "Fuel-2"), "fuel_type_2"),
    (("Generating Facility", "Fuel-3"), "fuel_type_3"),
    (("MWs", "MW-1"), "mw_1"),
    (("MWs", "Net MWs to Grid"), "net_mw"),
    (("Location", "County"), "county"),
    (("Location", "State"), "state"),
    (("Point of Interconnection", "PTO Study Region"), "pto_study_region"),
    (("Point of Interconnection", "Proposed\nOn-line Date\n(as filed with IR)"), "proposed_online_date"),
    (("Point of Interconnection", "Current\nOn-line Date"), "current_online_date"),
)
# The withdrawn sheet spells two headers differently.
WITHDRAWN_LAYOUT = {
    "project_name": ("Unnamed: 0_level_0", "Project Name - Confidential"),
    "study_process": ("Unnamed: 6_level_0", "Study\nProcess"),
}

CLUSTER_LAYOUT = (
    ("Queue Number", "queue_position"),
    ("Project Name", "project_name"),
    ("Generation/Fuel 1", "fuel_type_1"),
    ("NET MW 1", "mw_1"),
    ("Generation/Fuel 2", "fuel_type_2"),
    ("NET MW 2", "mw_2"),
    ("Generation/Fuel 3", "fuel_type_3"),
    ("NET MW 3", "mw_3"),
    ("NET MW POI", "net_mw"),
    ("PROJECT COUNTY", "county"),
    ("Project State", "state"),
    ("Study Area", "pto_study_region"),
    ("PTO", "utility"),
    ("Requested COD", "proposed_online_date"),
    ("Queue Date ", "queue_date"),
    ("Application Date", "request_receive_date"),
)


#: Column of the cluster cells with the name of a row's sheet.
SHEET = "_sheet"

# What a cluster column is made of, where that is not a column of the same name.
_CLUSTER_INPUTS = {
    "fuel_types": {"fuel_type_1", "fuel_type_2", "fuel_type_3"},
    "latitude": {"county", "state"},
    "longitude": {"county", "state"},
}

_schemas: dict[tuple[str, str], T.StructType] = {}


class StarTables(ProjectTables):
    """Project tables computed from the star schema in `path`, with only the joins a question needs."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__(spark)
        self._path = path
        self._sources: dict[str, DataFrame] = {}
        self._places: Places | None = None

    def source(self, name: str) -> DataFrame:
        """A star table. Its schema is read from a file footer once per process, not per query."""
        if name not in self._sources:
            file, known = f"{self._path}/{name}.parquet", (self._path, name)
            if known not in _schemas:
                _schemas[known] = self.spark.read.parquet(file).schema
            self._sources[name] = self.spark.read.schema(_schemas[known]).parquet(file)
        return self._sources[name]

    def names(self) -> list[str]:
        return [*S.TABLE_OF_STATUS.values(), S.CLUSTER_TABLE]

    def columns(self, name: str) -> list[str]:
        return self.cluster().columns if name == S.CLUSTER_TABLE else list(COLUMNS)

    def scan(self, name: str) -> DataFrame:
        if name == S.CLUSTER_TABLE:
            return self.cluster()
        return self._projects(COLUMNS, S.STATUS_OF_TABLE[name])

    def table(self, status: str, columns: Sequence[str] | None = None) -> DataFrame:
        return self._projects(columns or (*COLUMNS, "status"), status)

    def all_projects(self, columns: Sequence[str] | None = None) -> DataFrame:
        return self._projects(columns or (*COLUMNS, "status"))

    def cluster(self, columns: Sequence[str] | None = None) -> DataFrame:
        dated = F.trunc(F.to_date("Application Date"), "year")
        located = columns is None or {*_COORDINATES} & {*columns}
        df = shape_cluster_rows(self.cluster_cells(columns), SHEET, dated, self.places() if located else None)
        return df if columns is None else df.select(*columns)

    def centroids(self) -> DataFrame:
        """County dimension `(state, county, lat, lon)`: the nations and their regions."""
        nation, region = self.source("nation"), self.source("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
            "r_name AS state",
            "n_name AS county",
            "30 + n_nationkey * 0.5D AS lat",
            "-120 + n_nationkey * 0.5D AS lon",
        )

    def places(self) -> Places:
        if self._places is None:
            self._places = Places.of(self.centroids())
        return self._places

    def raw_sheet(self, status: str) -> tuple[list[tuple[str, str]], DataFrame]:
        """A table as its raw sheet: the header levels, and text cells in columns by position."""
        changed = WITHDRAWN_LAYOUT if status == S.WITHDRAWN else {}
        levels = [changed.get(column, level) for level, column in SHEET_LAYOUT]
        df = self._projects([*(column for _, column in SHEET_LAYOUT), S.SNAPSHOT], status)
        cells = [f"CAST({column} AS STRING) AS _c{i}" for i, (_, column) in enumerate(SHEET_LAYOUT)]
        return levels, df.selectExpr(*cells, S.SNAPSHOT)

    def raw_sheets(self) -> tuple[dict[str, list[tuple[str, str]]], DataFrame]:
        """All tables as their raw sheets, in one pass over the star: the header levels of each, and the text cells
        of `raw_sheet` with the status of each row."""
        levels = {}
        for status in S.STATUSES:
            changed = WITHDRAWN_LAYOUT if status == S.WITHDRAWN else {}
            levels[status] = [changed.get(column, level) for level, column in SHEET_LAYOUT]
        df = self._projects([*(column for _, column in SHEET_LAYOUT), S.SNAPSHOT, "status"])
        cells = [f"CAST({column} AS STRING) AS _c{i}" for i, (_, column) in enumerate(SHEET_LAYOUT)]
        return levels, df.selectExpr(*cells, S.SNAPSHOT, "status")

    def sheet_headers(self, status: str) -> list[str]:
        """The flattened headers of a table's raw sheet."""
        changed = WITHDRAWN_LAYOUT if status == S.WITHDRAWN else {}
        return flatten_columns([changed.get(column, level) for level, column in SHEET_LAYOUT])

    def flat_sheets(self) -> DataFrame:
        """The raw sheets of all tables stacked by flattened header, with the date and the status of each row.

        They come from one pass over the star. A header that only some sheets have is null in the others.
        """
        headers = {status: self.sheet_headers(status) for status in S.STATUSES}
        columns = [column for _, column in SHEET_LAYOUT]
        cells = []
        for i, column in enumerate(columns):
            for header in dict.fromkeys(of[i] for of in headers.values()):
                own = [status for status, of in headers.items() if of[i] == header]
                cell = F.col(column).cast("string")
                cells.append((cell if len(own) == len(headers) else F.when(F.col("status").isin(own), cell)).alias(header))
        return self._projects([*columns, S.SNAPSHOT, "status"]).select(*cells, S.SNAPSHOT, "status")

    def cluster_cells(self, columns: Sequence[str] | None = None) -> DataFrame:
        """The cells of the cluster workbook as text, each row with the name of its sheet.

        Both sheets come from one pass over the star. Given the columns in demand, there are no more cells
        than those are made of. Only rows of the withdrawn sheet have a withdrawal date.
        """
        layout = list(CLUSTER_LAYOUT)
        if columns is not None:
            wanted = {S.KEY, "request_receive_date"}.union(
                *(_CLUSTER_INPUTS.get(column, {column}) for column in columns)
            )
            layout = [(header, column) for header, column in layout if column in wanted]
        cells = [f"CAST({column} AS STRING) AS `{header}`" for header, column in layout]
        inputs = [column for _, column in layout]
        if columns is None or "withdrawal_date" in columns:
            inputs.append("current_online_date")
            cells.append(
                f"CAST(CASE WHEN status = '{S.WITHDRAWN}' THEN current_online_date END AS STRING) AS `Withdrawal Date`"
            )
        sheet = f"CASE status WHEN '{S.ACTIVE}' THEN 'Cluster 15 ' ELSE 'Withdrawn' END AS {SHEET}"
        df = self._projects([*inputs, "status"], among=(S.ACTIVE, S.WITHDRAWN))
        return df.selectExpr(*cells, sheet)

    def _capacity(self) -> DataFrame:
        """Per order: MW of its lines and the first ship dates of lines 1 and 2."""
        return self.source("lineitem").groupBy(F.col("l_orderkey").alias("capacity_key")).agg(
            F.expr("sum(CASE WHEN l_linenumber = 1 THEN l_quantity END) AS mw_1"),
            F.expr("sum(CASE WHEN l_linenumber = 2 THEN l_quantity END) AS mw_2"),
            F.expr("sum(CASE WHEN l_linenumber = 3 THEN l_quantity END) AS mw_3"),
            F.expr("sum(l_quantity) AS net_mw"),
            F.expr("min(CASE WHEN l_linenumber = 1 THEN l_shipdate END) AS ship_1"),
            F.expr("min(CASE WHEN l_linenumber = 2 THEN l_shipdate END) AS ship_2"),
        )

    def _fuels(self) -> DataFrame:
        """Per order: the part types of lines 1 to 3. Only those lines meet the parts."""
        typed = (
            self.source("lineitem")
            .where("l_linenumber BETWEEN 1 AND 3")
            .join(self.source("part"), F.col("l_partkey") == F.col("p_partkey"), "left")
        )
        return typed.groupBy(F.col("l_orderkey").alias("fuel_key")).agg(
            F.expr("min(CASE WHEN l_linenumber = 1 THEN p_type END) AS fuel_type_1"),
            F.expr("min(CASE WHEN l_linenumber = 2 THEN p_type END) AS fuel_type_2"),
            F.expr("min(CASE WHEN l_linenumber = 3 THEN p_type END) AS fuel_type_3"),
        )

    def _developers(self, located: bool) -> DataFrame:
        if not located:
            return self.source("customer")
        return (
            self.source("customer")
            .join(self.source("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .join(self.source("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        )

    def _projects(
        self, columns: Sequence[str], status: str | None = None, among: Sequence[str] = S.STATUSES
    ) -> DataFrame:
        """The projects, one per order; of one status or of those `among`.

        Every join is a left join to one row per key, so leaving it out when nothing of it is
        read changes no row. The two per-order aggregates share the partitioning of the orders.
        """
        located = [c for c in columns if c in _COORDINATES]
        plain = [c for c in columns if c not in _COORDINATES]
        if located:
            plain += [c for c in ("county", "state") if c not in plain]
        needed = set(plain)

        df = self.source("orders")
        if status is not None:
            df = df.where(_TABLE_ROWS[status])
        elif set(among) != set(S.STATUSES):
            df = df.where(" OR ".join(_TABLE_ROWS[s] for s in among))
        if needed & set(_FROM_CAPACITY):
            df = df.join(self._capacity(), F.col("o_orderkey") == F.col("capacity_key"), "left")
        if needed & set(_FROM_FUELS):
            df = df.join(self._fuels(), F.col("o_orderkey") == F.col("fuel_key"), "left")
        if needed & set(_FROM_CUSTOMER):
            developers = self._developers(bool(needed & _FROM_NATION))
            df = df.join(developers, F.col("o_custkey") == F.col("c_custkey"), "left")

        expressions = dict(_EXPRESSIONS)
        if status is not None:
            expressions["status"] = f"'{status}'"
        df = df.selectExpr(*[f"{expressions[c]} AS {c}" for c in plain])
        if located:
            df = with_coordinates(df, self.places())
        return df.select(*columns)
