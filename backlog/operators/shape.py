"""From raw sheet columns to the project schema."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from backlog import schema as S
from backlog.functions.dates import time_or_null
from backlog.functions.numbers import number_or_null
from backlog.functions.text import clean_text, is_filled, join_filled, whole_number_text
from backlog.operators.geo import FIXED_PLACES, Places, with_coordinates


def name_header_levels(levels: list[list[str | None]]) -> list[tuple[str, ...]]:
    """Name the blank cells of a multi-row header.

    A merged group cell is filled on to the right; blanks before the first group, and blanks
    in the last row, get a positional name.
    """
    named = []
    for depth, row in enumerate(levels):
        cells, group = [], ""
        for position, cell in enumerate(row):
            text = (cell or "").strip()
            if depth < len(levels) - 1:
                group = text or group
                text = group
            cells.append(text or f"Unnamed: {position}_level_{depth}")
        named.append(cells)
    return list(zip(*named))


def flatten_columns(levels: list[tuple[str, ...]]) -> list[str]:
    """Header levels joined with one space, blank levels left out."""
    return [" ".join(str(part) for part in parts if part).strip() for parts in levels]


def rename_columns(df: DataFrame, headers: dict[str, str] = S.HEADERS) -> DataFrame:
    """Known headers get their column name, all others are kept as they are.

    Where sheets that spell a header differently are stacked, the column is filled from whichever has a value.
    """
    sources: dict[str, list[str]] = {}
    for c in df.columns:
        sources.setdefault(headers.get(c, c), []).append(c)
    if all(len(of) == 1 for of in sources.values()):
        return df.withColumnsRenamed({of[0]: name for name, of in sources.items() if of[0] != name})
    return df.select(*[F.coalesce(*[F.col(f"`{c}`") for c in of]).alias(name) for name, of in sources.items()])


def columns_containing(df: DataFrame, word: str) -> list[str]:
    """Columns whose name contains the word, in any case."""
    return [c for c in df.columns if word.lower() in c.lower()]


def with_fuel_types(df: DataFrame, fuel_columns: list[str]) -> DataFrame:
    """`fuel_types` out of the given columns; `''` when there are none."""
    return df.withColumn("fuel_types", join_filled(F.col(f"`{c}`") for c in fuel_columns))


def cast_known_columns(df: DataFrame) -> DataFrame:
    """Canonical types; what does not parse becomes null, never an error."""
    typed: dict[str, Column] = {}
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        want = S.column_type(field.name)
        if field.name == S.KEY:
            typed[field.name] = whole_number_text(c)
        elif field.name == "study_process":
            typed[field.name] = clean_text(c)
        elif field.name not in S.PROJECT_COLUMNS + S.CLUSTER_COLUMNS or field.dataType == want:
            continue
        elif isinstance(want, T.DoubleType):
            typed[field.name] = number_or_null(c)
        elif isinstance(want, T.TimestampNTZType) and isinstance(field.dataType, T.StringType):
            typed[field.name] = time_or_null(c)
        else:
            typed[field.name] = c.try_cast(want)
    return df.withColumns(typed) if typed else df


def drop_blank_keys(df: DataFrame) -> DataFrame:
    """rows without a queue position cannot be stored."""
    return df.where(is_filled(F.col(S.KEY))) if S.KEY in df.columns else df


def shape_snapshot(
    df: DataFrame, snapshot_date: date | Column, places: Places = FIXED_PLACES
) -> DataFrame:
    """A raw snapshot sheet with flattened headers -> typed project rows, located and dated.

    `snapshot_date` is a value or a column (the date in the file name, for a bulk load); it is
    never today's date, so a rerun gives the same rows.
    """
    fuels = [c for c in columns_containing(df, "fuel") if c != "fuel_types"]
    dated = with_fuel_types(df, fuels).withColumn(S.SNAPSHOT, _day(snapshot_date))
    return locate(cast_known_columns(rename_columns(dated)), places)


def _shape_cluster_sheet(df: DataFrame, status: Column, snapshot_date: date | Column) -> DataFrame:
    dated = df.withColumn(S.SNAPSHOT, _day(snapshot_date))
    named = rename_columns(dated, S.CLUSTER_HEADERS)
    fuels = sorted(c for c in named.columns if c.startswith("fuel_type_"))  # however a sheet orders them
    tagged = with_fuel_types(named, fuels).withColumns({
        "study_process": F.lit(S.CLUSTER_PROCESS),
        "application_status": status,
    })
    return drop_blank_keys(cast_known_columns(tagged))


def shape_cluster(
    sheets: dict[str, DataFrame],
    snapshot_date: date | Column,
    places: Places | None = FIXED_PLACES,
) -> DataFrame:
    """The cluster sheets as typed rows tagged with process, status and date.

    Sheets are stacked by column name; sheets of an unknown name are skipped. Without places
    the rows get no coordinates.
    """
    frames = [
        _shape_cluster_sheet(df, F.lit(S.CLUSTER_SHEETS[name]), snapshot_date)
        for name, df in sheets.items()
        if name in S.CLUSTER_SHEETS
    ]
    if not frames:
        raise ValueError("no known cluster sheet among " + ", ".join(map(repr, sheets)))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked if places is None else locate(stacked, places)


def shape_cluster_rows(
    df: DataFrame,
    sheet: str,
    snapshot_date: date | Column,
    places: Places | None = FIXED_PLACES,
) -> DataFrame:
    """S2, P4, P5 where all sheets lie in one table, so that it is read once.

    The column `sheet` names the sheet that a row is of; rows of unknown sheets are skipped.
    """
    status_of = F.create_map(*[F.lit(x) for pair in S.CLUSTER_SHEETS.items() for x in pair])
    status = F.try_element_at(status_of, F.col(sheet))
    rows = _shape_cluster_sheet(df.where(status.isNotNull()), status, snapshot_date).drop(sheet)
    return rows if places is None else locate(rows, places)


def _day(snapshot_date: date | Column) -> Column:
    day = snapshot_date if isinstance(snapshot_date, Column) else F.lit(snapshot_date)
    return day.cast("date")


def _named(df: DataFrame, name: str) -> str | None:
    """The column of that name, or else the first whose name contains it."""
    return name if name in df.columns else next(iter(columns_containing(df, name)), None)


def locate(df: DataFrame, places: Places) -> DataFrame:
    """Coordinates by the county and state columns; null where the table has none."""
    found = {name: _named(df, name) for name in ("county", "state")}
    if None in found.values():
        nowhere = F.lit(None).cast("double")
        return df.withColumns({"latitude": nowhere, "longitude": nowhere})
    added = {name: F.col(f"`{c}`").cast("string") for name, c in found.items() if c != name}
    return with_coordinates(df.withColumns(added) if added else df, places).drop(*added)
