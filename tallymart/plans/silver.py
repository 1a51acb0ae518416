"""Clean tables: geography, dwelling, household member, education, person."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions import scalar
from tallymart.functions.naming import find_column
from tallymart.operators.dedupe import keep_first, keep_least
from tallymart.operators.joins import consolidate, lookup_left, lookup_left_hot
from tallymart.operators.project import Field, conform, rename_present
from tallymart.plans import codebook as codes
from tallymart.plans import spec


def geography(
    departments: DataFrame,
    sheet_towns: DataFrame,
    database_towns: DataFrame | None = None,
) -> DataFrame:
    """One row per town with its department; the sheet wins over the database."""
    dept = keep_first(
        rename_present(departments, spec.DEPARTMENT_NAMES)
        .select(scalar.lenient_int("dept_code").alias("dept_code"), "dept_name")
        .filter("dept_code IS NOT NULL"),
        ["dept_code"],
    )

    def towns(df: DataFrame, names: dict[str, str], source: str) -> DataFrame:
        return rename_present(df, names).select(
            scalar.lenient_int("dept_code").alias("dept_code"),
            "town_name",
            scalar.lenient_int("town_code").alias("town_code"),
            F.lit(source).alias("source"),
        )

    merged = towns(sheet_towns, spec.SHEET_TOWN_NAMES, "excel")
    if database_towns is not None:
        merged = consolidate(
            merged, towns(database_towns, spec.DATABASE_TOWN_NAMES, "mysql"), "town_code"
        )
    merged = keep_first(merged.filter("town_code IS NOT NULL"), ["town_code"])
    return lookup_left(merged, dept, ["dept_code"]).select(
        "dept_code", "dept_name", "town_code", "town_name", "source"
    )


def first_of_raw(
    raw: DataFrame, fields: Sequence[Field], keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """One raw row per key, before anything but the key is decoded.

    Keys and ``order`` name fields, which are read as declared, so that
    differently spelt numbers are one key. Further ties go by the raw text of
    all variables that the fields use, NULLs first.
    """
    by_name = {f.name: f for f in fields}
    used = dict.fromkeys(c for f in fields if (c := find_column(raw, f.raw)))
    typed = {name: f"_typed_{name}" for name in [*keys, *order]}
    rows = raw.select(
        *[by_name[name].column(raw).alias(alias) for name, alias in typed.items()], *[F.col(f"`{c}`") for c in used]
    )
    kept = keep_least(rows, [typed[k] for k in keys], [typed[o] for o in order])
    return kept.drop(*typed.values())


def dwelling(raw: DataFrame) -> DataFrame:
    """Dwelling survey: one row per dwelling, household and year, that of its
    first person."""
    first = first_of_raw(raw, spec.DWELLING, spec.HOUSEHOLD_KEY, ["sequence_no", "person_no"])
    typed = conform(first, spec.DWELLING).withColumns({
        "lacks_services": scalar.any_false(["power", "water", "sewer"]),
        "at_risk": scalar.any_true(
            ["flood_risk", "avalanche_risk", "subsidence_risk", "storm_risk"]
        ),
    })
    return typed.select(*spec.DWELLING_COLUMNS)


def one_per_dwelling(dwellings: DataFrame, keep_lacking: bool = True) -> DataFrame:
    """One row per dwelling and year: that of its first household.

    Joining persons to the household rows would repeat every person once per
    household of the dwelling. ``dwellings`` holds one row per household.
    """
    return keep_first(dwellings, spec.DWELLING_KEY, ["household_no"], True, keep_lacking)


def member(
    raw: DataFrame, geo: DataFrame, null_band: str | None = None
) -> DataFrame:
    """Household members with age band, migration flags and birthplace names.

    Persons born where they live have no town code, and they are the majority,
    so the lookup spreads rows without one.
    """
    abroad = scalar.is_code("birthplace_code", codes.BORN_ABROAD)
    elsewhere = scalar.is_code("birthplace_code", codes.BORN_ELSEWHERE)
    typed = conform(first_of_raw(raw, spec.MEMBER, spec.PERSON_KEY), spec.MEMBER).withColumns({
        "age_band": scalar.band("age", codes.AGE_BANDS, codes.OLDEST_BAND, null_band),
        "born_abroad": abroad,
        "born_elsewhere": elsewhere,
        "migrant": scalar.any_true([abroad, elsewhere]),
    }).drop("birthplace_code")
    town = geo.select(
        F.col("town_code").alias("birth_town_code"),
        F.col("town_name").alias("birth_town"),
        F.col("dept_name").alias("birth_dept"),
    )
    return lookup_left(
        typed, town, ["birth_town_code"], null_buckets=64, spread_by=spec.PERSON_KEY
    ).select(*spec.MEMBER_COLUMNS)


def education(raw: DataFrame) -> DataFrame:
    """Education records with three kinds of support, one per person and year."""
    first = first_of_raw(raw, spec.EDUCATION, spec.PERSON_KEY)
    typed = conform(first, spec.EDUCATION).withColumn(
        "any_support", scalar.any_true(["scholarship", "subsidy", "credit"])
    )
    return typed.select(*spec.EDUCATION_COLUMNS)


def person(
    members: DataFrame,
    educations: DataFrame,
    dwellings: DataFrame,
    hot_dwellings: int = 0,
) -> DataFrame:
    """Members with their education record, and the region, risk and services
    of their dwelling, which no later table has to look up again.

    Members and education records that are stored in buckets by person meet
    without a shuffle. ``hot_dwellings`` serves that many of the most crowded
    dwellings by broadcast instead of leaving them to the run-time split.
    """
    place = one_per_dwelling(dwellings, keep_lacking=False).select(*spec.DWELLING_KEY, *spec.PLACE_COLUMNS)
    support = educations.select(*spec.PERSON_KEY, *spec.SUPPORT_COLUMNS)
    joined = lookup_left(members, support, spec.PERSON_KEY)
    return _at_dwelling(joined, place, hot_dwellings, members).select(*spec.PERSON_COLUMNS)


def _at_dwelling(df: DataFrame, place: DataFrame, hot_dwellings: int, members: DataFrame) -> DataFrame:
    if hot_dwellings:
        return lookup_left_hot(
            df, place, spec.DWELLING_KEY, hot_dwellings, spread_by=spec.PERSON_KEY, counted=members
        )
    return lookup_left(df, place, spec.DWELLING_KEY)
