"""The one project schema every operator sees, and the headers that map into it."""

from __future__ import annotations

from pyspark.sql import types as T

ACTIVE, COMPLETED, WITHDRAWN = "Active", "Completed", "Withdrawn"
STATUSES = (ACTIVE, COMPLETED, WITHDRAWN)

# Stored table names.
TABLE_OF_STATUS = {
    ACTIVE: "grid_generation_queue",
    COMPLETED: "completed_projects",
    WITHDRAWN: "withdrawn_projects",
}
STATUS_OF_TABLE = {table: status for status, table in TABLE_OF_STATUS.items()}
CLUSTER_TABLE = "cluster_15_requests"
CLUSTER_PROCESS = "C15"

KEY = "queue_position"
SNAPSHOT = "ingestion_date"

# Flattened snapshot headers and their column names.
# The last study-process header is how the withdrawn sheet spells it.
HEADERS = {
    "Unnamed: 0_level_0 Project Name": "project_name",
    "Unnamed: 0_level_0 Project Name - Confidential": "project_name",
    "Unnamed: 1_level_0 Queue Position": "queue_position",
    "Unnamed: 2_level_0 Interconnection Request\nReceive Date": "request_receive_date",
    "Unnamed: 3_level_0 Queue Date": "queue_date",
    "Unnamed: 4_level_0 Application Status": "application_status",
    "Unnamed: 5_level_0 Study\nProcess": "study_process",
    "Generating Facility Type-1": "facility_type_1",
    "Generating Facility Type-2": "facility_type_2",
    "Generating Facility Type-3": "facility_type_3",
    "Generating Facility Fuel-1": "fuel_type_1",
    "Generating Facility Fuel-2": "fuel_type_2",
    "Generating Facility Fuel-3": "fuel_type_3",
    "MWs MW-1": "mw_1",
    "MWs MW-2": "mw_2",
    "MWs MW-3": "mw_3",
    "MWs Net MWs to Grid": "net_mw",
    "Deliverability\nStatus Full Capacity, Partial or Energy Only (FC/P/EO)": "capacity_status",
    "Deliverability\nStatus TPD Allocation Percentage": "tpd_allocation_pct",
    "Deliverability\nStatus Off-Peak Deliverability and Economic Only": "off_peak_deliverability",
    "Deliverability\nStatus TPD Allocation Group": "tpd_allocation_group",
    "Location County": "county",
    "Location State": "state",
    "Point of Interconnection Utility": "utility",
    "Point of Interconnection PTO Study Region": "pto_study_region",
    "Point of Interconnection Station or Transmission Line": "interconnection_point",
    "Point of Interconnection Proposed\nOn-line Date\n(as filed with IR)": "proposed_online_date",
    "Point of Interconnection Current\nOn-line Date": "current_online_date",
    "Point of Interconnection Suspension Status": "suspension_status",
    "Study Availability Feasibility Study or Supplemental Review": "feasibility_study",
    "Study Availability System Impact Study or \nPhase I Cluster Study": "system_impact_study_or_ph1",
    "Study Availability Facilities Study (FAS) or \nPhase II Cluster Study": "facility_study_or_ph2",
    "Study Availability Optional Study\n(OS)": "optional_study",
    "Study Availability Interconnection Agreement \nStatus": "interconnection_study",
    "ingestion_date": "ingestion_date",
    "fuel_types": "fuel_types",
    "Unnamed: 6_level_0 Study\nProcess": "study_process",
}

# Cluster workbook headers, some with a trailing space.
CLUSTER_HEADERS = {
    "Queue Number": "queue_position",
    "Project Number": "project_number",
    "Project Name": "project_name",
    "Generation/Fuel 1": "fuel_type_1",
    "NET MW 1": "mw_1",
    "Generation/Fuel 2": "fuel_type_2",
    "NET MW 2": "mw_2",
    "Generation/Fuel 3": "fuel_type_3",
    "NET MW 3": "mw_3",
    "NET MW POI": "net_mw",
    "PROJECT COUNTY": "county",
    "Project State": "state",
    "Study Area": "pto_study_region",
    "PTO": "utility",
    "POI": "interconnection_point",
    "Voltage kV": "voltage_kv",
    "Requested COD": "proposed_online_date",
    "Queue Date ": "queue_date",
    "Queue Date": "queue_date",
    "Application Date": "request_receive_date",
    "Application Date ": "request_receive_date",
    "Withdrawal Date": "withdrawal_date",
    "Service Type": "service_type",
    "ingestion_date": "ingestion_date",
    "fuel_types": "fuel_types",
    "study_process": "study_process",
}

# Cluster workbook sheets and the status each one means.
CLUSTER_SHEETS = {"Cluster 15 ": "Active", "Cluster 15": "Active", "Withdrawn": "Withdrawn"}

NUMBERS = ("mw_1", "mw_2", "mw_3", "net_mw", "latitude", "longitude")
TIMES = (
    "request_receive_date",
    "queue_date",
    "proposed_online_date",
    "current_online_date",
    "withdrawal_date",
)


def column_type(name: str) -> T.DataType:
    """Canonical type of a project column; columns we do not know stay text."""
    if name in NUMBERS:
        return T.DoubleType()
    if name in TIMES:
        return T.TimestampNTZType()
    if name == SNAPSHOT:
        return T.DateType()
    return T.StringType()


def _struct(names) -> T.StructType:
    return T.StructType([T.StructField(n, column_type(n)) for n in names])


PROJECT_COLUMNS = tuple(dict.fromkeys(HEADERS.values())) + ("latitude", "longitude")
CLUSTER_COLUMNS = tuple(dict.fromkeys(CLUSTER_HEADERS.values())) + (
    "application_status",
    "latitude",
    "longitude",
)
PROJECT_SCHEMA = _struct(PROJECT_COLUMNS)
CLUSTER_SCHEMA = _struct(CLUSTER_COLUMNS)
