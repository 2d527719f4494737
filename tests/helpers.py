"""What tests share besides fixtures. It is no conftest, of which there is one a folder, all of the same name."""

from __future__ import annotations

from datetime import date, datetime

TESTDATA = "/root/testdata"
DAY = date(2025, 1, 1)


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def rows(df) -> list[tuple]:
    return [tuple(r) for r in df.collect()]


def plan(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
