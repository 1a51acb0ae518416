"""Projections: names, blanks, lineage, and typing to a declared set of fields."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.functions import naming, scalar

LINEAGE = ("ingested_at", "origin", "source_file", "survey_year", "run_id")


@dataclass(frozen=True)
class Field:
    """One output column: the raw variable it comes from and how to read it.

    ``kind`` is ``text``, ``int``, ``number`` (comma decimal), ``money``
    (comma decimal, 0.00 when missing), ``flag`` (yes/no code) or ``code``
    (looked up in ``entries``). A field that is not ``required`` becomes a
    typed NULL in files that lack its variable.
    """

    name: str
    raw: str
    kind: str = "text"
    entries: Mapping[str, str] | None = None
    required: bool = False

    def column(self, df: DataFrame) -> Column:
        found = naming.find_column(df, self.raw)
        value = F.col(f"`{found}`") if found else scalar.null_of("string")
        return _READERS[self.kind](value, self).alias(self.name)


_READERS = {
    "text": lambda c, f: c.cast("string"),
    "int": lambda c, f: scalar.lenient_int(c),
    "number": lambda c, f: scalar.comma_double(c),
    "money": lambda c, f: scalar.money_or_zero(scalar.comma_money(c)),
    "flag": lambda c, f: scalar.yes_no(c),
    "code": lambda c, f: scalar.decode(c, f.entries),
}


def conform(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """The declared fields, typed, in order: one projection over the raw frame."""
    missing = [f.raw for f in fields if f.required and not naming.find_column(df, f.raw)]
    if missing:
        raise ValueError(f"required columns are missing: {', '.join(missing)}")
    return df.select(*[f.column(df) for f in fields])


def unreadable(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """One row: per money field, how many texts are there that are no amount.

    They count as 0.00, as missing ones do, so only the raw table can tell.
    """
    found = {f.name: naming.find_column(df, f.raw) for f in fields if f.kind == "money"}
    return df.agg(*[
        F.count_if(F.col(f"`{c}`").isNotNull() & scalar.comma_money(F.col(f"`{c}`")).isNull()).alias(name)
        for name, c in found.items() if c
    ])


def backfill(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``; absent ones are typed NULLs, others are cast."""
    columns = []
    for field in schema.fields:
        found = naming.find_column(df, field.name)
        value = F.col(f"`{found}`") if found else F.lit(None)
        columns.append(value.try_cast(field.dataType).alias(field.name))
    return df.select(*columns)


def blank_to_null(df: DataFrame) -> DataFrame:
    """NULL in place of text that is empty or all spaces; other text as it is."""
    return df.select(*[
        F.when(F.trim(F.col(f"`{f.name}`")) != "", F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, T.StringType)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def stringify(df: DataFrame) -> DataFrame:
    """Every column as text."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def normalize_names(df: DataFrame) -> DataFrame:
    """Plain column names; no data is touched."""
    return df.toDF(*naming.plain_names(df.columns))


def rename_present(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist, whatever their case; ignore the others."""
    return df.withColumnsRenamed(naming.present(df, names))


def with_lineage(
    df: DataFrame,
    origin: str,
    year: int,
    run_id: str,
    source_file: str | None = None,
) -> DataFrame:
    """Add when, where from, which file, which year and which run.

    Without ``source_file`` the name is taken from the scan, so that a folder
    of part files keeps the name of each.
    """
    file_name = F.lit(source_file) if source_file else F.col("_metadata.file_name")
    values = (
        F.current_timestamp(),
        F.lit(origin),
        file_name,
        F.lit(year).cast("int"),
        F.lit(run_id),
    )
    return df.withColumns(dict(zip(LINEAGE, values)))
