"""Decoded rows to typed columns, with built-in expressions only: S6, P1–P13, X1, X3."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtrail import fixed_values as fixed
from logtrail.functions import cleaning, geometry
from logtrail.functions.types import CHECKED_TYPES, quoted, spark_type, unused, widest

CAST_ERRORS = "_cast_errors"


@dataclass
class TableColumns:
    """Columns of one source table over the logs of a batch.

    ``declared`` keeps every declared type met per column, in column order.
    ``layouts`` are the (column, declared type) lists that rows of some file
    have, by name. Columns whose names differ in case alone are one.
    """

    table: str
    declared: dict[str, list[str]] = field(default_factory=dict)
    layouts: dict[str, list[tuple[str, str]]] = field(default_factory=dict)

    def add_layout(self, layout: str, columns: list[tuple[str, str]]) -> None:
        """Take in the columns of some files."""
        spelled = {name.lower(): name for name in self.declared}
        self.layouts[layout] = [(spelled.get(c.lower(), c), d) for c, d in columns]
        for column, declared in self.layouts[layout]:
            kinds = self.declared.setdefault(column, [])
            if declared not in kinds:
                kinds.append(declared)

    def spelled(self, names: list[str]) -> TableColumns:
        """The same columns, named as in ``names`` where only case differs."""
        as_stored = {name.lower(): name for name in names}
        new = TableColumns(self.table, {as_stored.get(c.lower(), c): d for c, d in self.declared.items()})
        new.layouts = {k: [(as_stored.get(c.lower(), c), d) for c, d in cs] for k, cs in self.layouts.items()}
        return new

    def text_columns(self) -> list[str]:
        """Columns that are read from cells: the log's identity is not."""
        return [c for c in self.declared if c != "log_hash"]

    def is_blob(self, column: str) -> bool:
        """Whether the cells of a column are bytes and not text."""
        return self.source_type(column) == "binary"

    def types_of(self, column: str) -> dict[str, tuple[str, list[str]]]:
        """Spark types that a column is declared as: a declaration, and the layouts that have it."""
        found: dict[str, tuple[str, list[str]]] = {}
        for layout, columns in self.layouts.items():
            for name, declared in columns:
                if name == column:
                    found.setdefault(spark_type(declared, column, self.table), (declared, []))[1].append(layout)
        return found

    def source_type(self, column: str) -> str:
        """Spark type wide enough for every declaration of the column."""
        return widest([spark_type(d, column, self.table) for d in self.declared[column]])

    def target(self) -> dict[str, str]:
        """Columns of the typed rows, in order, without the log identity."""
        columns: dict[str, str] = {}
        for name in self.declared:
            if name in ("log_hash", fixed.LEGACY_COLUMN):
                continue
            if self._adds_direction() and name == "direction":
                continue
            columns[name] = self.source_type(name)
            if name == fixed.GEOMETRY_COLUMN and columns[name] == "binary":
                if not {"lat", "lon"} & set(self.declared):
                    columns.update({"lat": "double", "lon": "double"})
        if self._adds_direction():
            columns["direction"] = "int"
        return columns

    def _adds_direction(self) -> bool:
        return self.table == fixed.SIGNALLING_TABLE


def parse_cells(rows: DataFrame, columns: TableColumns, cells: str = "cells", layout: str = "layout") -> DataFrame:
    """Source columns as text, blobs as bytes, next to all other columns of ``rows``.

    A cell is found by its place in the row's layout. The log identity comes
    from the log and not from the cells.
    """
    names = columns.text_columns()
    others = [c for c in rows.columns if c not in (cells, layout)]
    places = {key: {name: i for i, (name, _) in enumerate(listed)} for key, listed in columns.layouts.items()}
    if len(places) == 1:
        (only,) = places.values()
        at = [F.lit(only.get(name, -1)) for name in names]
    else:
        # One row per layout, whatever the number of files.
        listed = [(key, [of.get(name, -1) for name in names]) for key, of in places.items()]
        table = rows.sparkSession.createDataFrame(listed, f"{layout} string, _at array<int>")
        rows = rows.join(table, layout)
        at = [F.get("_at", F.lit(i)) for i in range(len(names))]
    found = [F.get(F.col(cells), place) for place in at]
    read = [cell if columns.is_blob(name) else cell.cast("string") for name, cell in zip(names, found, strict=True)]
    return rows.select(*others, *[c.alias(n) for n, c in zip(names, read, strict=True)])


def type_columns(
    rows: DataFrame, columns: TableColumns, target: dict[str, str], keep: list[str], strip_band: bool = False, errors: str | None = CAST_ERRORS
) -> DataFrame:
    """Typed columns of ``target`` from text columns, and the count of lost cells under the name ``errors``.

    ``keep`` names columns of ``rows`` that pass through unchanged.
    """
    if columns.table == fixed.SIGNALLING_TABLE and "symbol" not in rows.columns:
        raise ValueError("signalling rows need a symbol column")
    placed = fixed.GEOMETRY_COLUMN in rows.columns and not {"lat", "lon"} & set(columns.declared)
    blob, lon, lat = (unused(rows.columns, n) for n in ("_geom", "_lon", "_lat"))
    if placed:
        rows = rows.withColumn(blob, _bytes(rows, fixed.GEOMETRY_COLUMN))
        rows = geometry.with_coordinates(rows, blob, lon, lat)
    have = dict(rows.dtypes)
    cells: dict[str, Column] = {}
    sources: dict[str, Column] = {}
    for name, kind in target.items():
        text = F.col(quoted(name)) if name in have else None
        if name == "direction" and columns.table == fixed.SIGNALLING_TABLE:
            cells[name] = cleaning.direction(F.col("symbol"))
        elif name in ("lat", "lon") and placed:
            cells[name] = F.col(lat if name == "lat" else lon)
        elif text is None:
            cells[name] = F.lit(None).cast(kind)
        elif kind == "binary":
            clean = cleaning.blob_or_null(_bytes(rows, name))
            cells[name] = geometry.to_ewkb(clean) if name == fixed.GEOMETRY_COLUMN else clean
        elif have[name] != "string":
            cells[name] = text.cast(kind)
        else:
            cells[name], clean = _cell(columns.table, name, columns.declared.get(name, [""]), kind, text, strip_band)
            if kind in CHECKED_TYPES:
                sources[name] = clean
    if errors is None:
        return rows.select(*keep, *[c.alias(n) for n, c in cells.items()])
    # Two steps, so that a cell is cast once for its value and its check; by number, as names may be anything.
    number = {n: i for i, n in enumerate(cells)}
    typed = rows.select(
        *keep,
        *[c.alias(f"value_{number[n]}") for n, c in cells.items()],
        *[c.isNotNull().alias(f"had_{number[n]}") for n, c in sources.items()],
    )
    lost = [(F.col(f"had_{number[n]}") & F.col(f"value_{number[n]}").isNull()).cast("int") for n in sources]
    return typed.select(*keep, *[F.col(f"value_{i}").alias(n) for n, i in number.items()], _sum(lost).alias(errors))


def lost_cells(rows: DataFrame, columns: TableColumns, layout: Column, strip_band: bool = False) -> Column:
    """How many cells of a row do not parse as the number type that its own file declares."""
    have = dict(rows.dtypes)
    lost = []
    for name in columns.text_columns():
        kinds = columns.types_of(name)
        for kind, (declared, layouts) in kinds.items():
            if kind not in CHECKED_TYPES or have.get(name) not in ("string", "binary"):
                continue
            text = F.col(quoted(name)).cast("string")
            cell, clean = _cell(columns.table, name, [declared], kind, text, strip_band)
            bad = clean.isNotNull() & cell.isNull()
            lost.append((bad if len(kinds) == 1 else layout.isin(layouts) & bad).cast("int"))
    return _sum(lost)


def _sum(terms: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms) if terms else F.lit(0)


def _bytes(rows: DataFrame, name: str) -> Column:
    """A blob column as bytes; text, which a hook may have made, by its UTF-8 bytes."""
    return F.col(quoted(name)).cast("binary")


def _cell(table: str, name: str, declared: list[str], kind: str, text: Column, strip_band: bool) -> tuple[Column, Column]:
    """Typed cell and the cleaned value it was cast from."""
    rules = [cleaning.rule_for(table, name, d, strip_band) for d in declared]
    rule = next((r for r in rules if r), None)
    clean = rule.build(text) if rule else text
    if rule is None or rule.name in ("bsic", "band_prefix"):
        clean = cleaning.empty_to_null(clean)
    if kind == "timestamp_ntz":
        if rule is not None and rule.name == "modem_time":
            return clean, clean
        return cleaning.to_time(cleaning.not_a_time_to_null(clean)), clean
    return clean.try_cast(kind), clean
