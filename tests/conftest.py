from __future__ import annotations

import pytest
from helpers import DAY

from backlog import schema as S
from backlog.session import local_session
from backlog.sources.tables import ProjectTables


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, partitions=4, app="tests")
    session.sparkContext.setLogLevel("ERROR")
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """Project rows from dicts; columns nobody names are left out."""

    def build(rows: list[dict], *columns: str):
        names = list(columns) or list(dict.fromkeys(k for row in rows for k in row))
        fields = S.T.StructType([S.T.StructField(n, S.column_type(n)) for n in names])
        return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], fields)

    return build


@pytest.fixture(scope="session")
def make_tables(spark, make):
    """Project tables from rows per status; a status that is not given has no table."""

    def build(cluster=None, **by_status):
        frames = {
            S.TABLE_OF_STATUS[status]: make(
                [{"ingestion_date": DAY, **row} for row in rows], *S.PROJECT_COLUMNS
            )
            for status, rows in by_status.items()
        }
        if cluster is not None:
            frames[S.CLUSTER_TABLE] = make(cluster, *S.CLUSTER_COLUMNS)
        return ProjectTables(spark, frames)

    return build
