"""Reports over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions import scalar
from tallymart.operators.aggregate import count_true, frequency, sums_by, top_k, with_shares
from tallymart.plans import spec


def top_origins(dim_person: DataFrame, k: int = 10) -> DataFrame:
    """Departments that most migrants were born in."""
    migrants = dim_person.filter("migrant AND birth_dept IS NOT NULL")
    return top_k(frequency(migrants, "birth_dept"), k, "n", ["birth_dept"])


def migrant_share_by_year(dim_person: DataFrame) -> DataFrame:
    """Migrants and foreign-born per year."""
    counts = dim_person.groupBy(spec.YEAR).agg(
        F.count("*").alias("total"),
        count_true("migrant").alias("migrants"),
        count_true("born_abroad").alias("foreigners"),
    )
    return with_shares(counts, {"migrant_pct": ("migrants", "total")}).orderBy(spec.YEAR)


def risk_share_by_region(dim_dwelling: DataFrame) -> DataFrame:
    """Dwellings at risk per region, highest share first."""
    counts = dim_dwelling.filter("region IS NOT NULL").groupBy("region").agg(
        F.count("*").alias("dwellings"),
        count_true("at_risk").alias("at_risk"),
    )
    return with_shares(counts, {"at_risk_pct": ("at_risk", "dwellings")}).orderBy(
        F.desc("at_risk_pct"), "region"
    )


def scholarship_share_by_year(dim_education: DataFrame) -> DataFrame:
    """Scholars among students per year."""
    counts = dim_education.groupBy(spec.YEAR).agg(
        count_true("studying").alias("students"),
        count_true("scholarship").alias("scholars"),
    )
    return with_shares(counts, {"scholarship_pct": ("scholars", "students")}).orderBy(spec.YEAR)


def coverage_by_level(fact: DataFrame, dim_education: DataFrame, k: int | None = None) -> DataFrame:
    """Scholarship coverage of students per education level."""
    joined = fact.select("education_sk", spec.YEAR, "students", "scholars").join(
        dim_education.filter("studying").select("education_sk", spec.YEAR, "level"), ["education_sk", spec.YEAR]
    )
    sums = joined.groupBy("level").agg(
        F.count("*").alias("total"),
        F.sum("students").alias("students"),
        F.sum("scholars").alias("scholars"),
    )
    shares = with_shares(sums, {"coverage_pct": ("scholars", "students")})
    if k is not None:
        return top_k(shares, k, "coverage_pct", ["level"])
    return shares.orderBy(F.desc("coverage_pct"), "level")


def migrants_by_region(fact: DataFrame, dim_person: DataFrame, locations: DataFrame) -> DataFrame:
    """Migrants living in each region, from fact, person and location.

    Fact and person meet once; the counts per location key meet the names.
    """
    counts = (
        fact.filter("location_sk IS NOT NULL").select("person_sk", spec.YEAR, "location_sk")
        .join(dim_person.select("person_sk", spec.YEAR, "migrant", "born_abroad"), ["person_sk", spec.YEAR])
        .groupBy("location_sk")
        .agg(
            F.count("*").alias("persons"),
            count_true("migrant").alias("migrants"),
            count_true("born_abroad").alias("foreigners"),
        )
    )
    named = counts.join(locations, "location_sk").drop("location_sk", "region_id")
    return with_shares(named, {"migrant_pct": ("migrants", "persons")}).orderBy(
        F.desc("migrant_pct"), "region"
    )


def support_in_millions(kpi: DataFrame) -> DataFrame:
    """Amounts of the three kinds of support per year, in millions."""
    return kpi.select(
        spec.YEAR,
        scalar.millions("scholarship_total").alias("scholarship_millions"),
        scalar.millions("subsidy_total").alias("subsidy_millions"),
        scalar.millions("credit_total").alias("credit_millions"),
    )


def scholarship_report(kpi: DataFrame) -> DataFrame:
    """Coverage and growth per year."""
    return kpi.select(
        spec.YEAR, "students", "scholars", "scholarship_pct", "scholar_growth_pct"
    ).orderBy(spec.YEAR)


def support_report(kpi: DataFrame) -> DataFrame:
    """All support per year."""
    return kpi.select(
        spec.YEAR, "scholars", "subsidised", "credited", "supported", "support_pct"
    ).orderBy(spec.YEAR)


def living_conditions_report(kpi: DataFrame) -> DataFrame:
    """Regions per year, highest risk first."""
    return kpi.select(
        spec.YEAR, "region", "persons", "persons_at_risk", "at_risk_pct",
        "persons_unserved", "unserved_pct",
    ).orderBy(spec.YEAR, F.desc("at_risk_pct"), "region")


def top_risk_regions(kpi: DataFrame, year: int, k: int = 5) -> DataFrame:
    """The regions with the highest share of persons at risk in one year."""
    chosen = kpi.filter(F.col(spec.YEAR) == year).select(
        "region", "persons", "persons_at_risk", "at_risk_pct"
    )
    return top_k(chosen, k, "at_risk_pct", ["region"])


def persons_by_year(fact: DataFrame) -> DataFrame:
    """Persons, students and scholars per year."""
    return sums_by(fact, [spec.YEAR], {
        "persons": "persons", "students": "students", "scholars": "scholars",
    }).orderBy(spec.YEAR)


def validation_totals(fact: DataFrame) -> DataFrame:
    """One row to compare with the published copy."""
    return fact.agg(
        F.count("*").alias("total_rows"),
        F.count_distinct(spec.YEAR).alias("total_years"),
        F.sum("persons").alias("persons"),
        F.sum("scholars").alias("scholars"),
        F.sum("persons_at_risk").alias("persons_at_risk"),
    )


def weighted_estimate(fact: DataFrame, measure: str) -> DataFrame:
    """Population estimate of a 0/1 measure per year (not in the survey reports).

    The weights are added as decimals, so the sum does not depend on the order
    in which tasks finish.
    """
    weight = F.col("weight").cast("decimal(20,6)")
    return fact.groupBy(spec.YEAR).agg(
        F.sum(weight).alias("population"),
        F.sum(F.when(F.col(measure) == 1, weight)).alias("estimate"),
    )
