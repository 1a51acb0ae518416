"""Star schema: five dimensions, the fact, two indicator tables.

Inputs are the clean tables of ``silver``, which hold one row per natural key.
Rows are never removed by surrogate key: with enough rows two natural keys can
share one, and ``quality.key_audit`` reports it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions import scalar
from tallymart.operators.aggregate import distinct_values, sums_by, with_growth, with_shares
from tallymart.operators.joins import lookup_left
from tallymart.plans import codebook as codes
from tallymart.plans import spec
from tallymart.plans.silver import one_per_dwelling


def dim_time(persons: DataFrame, as_of_year: int) -> DataFrame:
    """One row per survey year; ``as_of_year`` marks the current one."""
    return distinct_values(persons, spec.YEAR).select(
        F.col(spec.YEAR).cast("int").alias("time_sk"),
        F.col(spec.YEAR).alias("year"),
        scalar.decade(spec.YEAR).alias("decade"),
        (F.col(spec.YEAR) == as_of_year).alias("is_current_year"),
    )


def dim_location(dwellings: DataFrame) -> DataFrame:
    """One row per region that occurs, with its official number."""
    return distinct_values(dwellings, "region").select(
        scalar.surrogate_key(["region"]).alias("location_sk"),
        scalar.label_to_id("region", codes.REGION).alias("region_id"),
        "region",
    )


def dim_person(persons: DataFrame) -> DataFrame:
    """Demographics, birthplace, migration flags, scores and weight."""
    return persons.select(
        scalar.surrogate_key(spec.PERSON_KEY).alias("person_sk"),
        *spec.PERSON_KEY,
        "sex", "age", "age_band", "civil_status", "ethnicity",
        "birthplace", "birth_dept_code", "birth_dept", "birth_town_code", "birth_town",
        "born_abroad", "born_elsewhere", "migrant",
        "life_score", "income_score", "health_score", "safety_score", "work_score",
        "weight",
    )


def dim_dwelling(dwellings: DataFrame) -> DataFrame:
    """Building, services, risks and faults, one row per dwelling and year."""
    own = {*spec.DWELLING_KEY, "household_no", "sequence_no", "person_no",
           "complete_households", "weight"}
    return one_per_dwelling(dwellings).select(
        scalar.surrogate_key(spec.DWELLING_KEY).alias("dwelling_sk"),
        *spec.DWELLING_KEY,
        *[c for c in spec.DWELLING_COLUMNS if c not in own],
    )


def dim_education(educations: DataFrame) -> DataFrame:
    """Schooling and support, one row per education record."""
    return educations.select(
        scalar.surrogate_key(spec.PERSON_KEY).alias("education_sk"),
        *spec.PERSON_KEY,
        *spec.SUPPORT_COLUMNS,
    )


def fact_survey(persons: DataFrame, locations: DataFrame) -> DataFrame:
    """One row per person and year: five keys, eight counts, three amounts.

    The education key is NULL for persons without an education record. Such a
    record always has its support flag set, so the flag on the person tells,
    and the key follows from the person's own key without another join. The
    location key is NULL for an unknown region. The state of the dwelling is
    the person's already.
    """
    base = persons.select(
        *spec.PERSON_KEY, "studying", "scholarship", "subsidy", "credit", "any_support",
        "scholarship_amount", "subsidy_amount", "credit_amount", "region", "at_risk", "lacks_services", "weight",
    )
    located = lookup_left(base, locations.select("region", "location_sk"), ["region"])
    own_key = scalar.surrogate_key(spec.PERSON_KEY)
    return located.select(
        *spec.PERSON_KEY,
        own_key.alias("person_sk"),
        scalar.surrogate_key(spec.DWELLING_KEY).alias("dwelling_sk"),
        F.when(F.col("any_support").isNotNull(), own_key).alias("education_sk"),
        "location_sk",
        F.col(spec.YEAR).cast("int").alias("time_sk"),
        F.lit(1).alias("persons"),
        scalar.flag_measure("studying").alias("students"),
        scalar.flag_measure("scholarship").alias("scholars"),
        scalar.flag_measure("subsidy").alias("subsidised"),
        scalar.flag_measure("credit").alias("credited"),
        scalar.flag_measure("any_support").alias("supported"),
        scalar.flag_measure("at_risk").alias("persons_at_risk"),
        scalar.flag_measure("lacks_services").alias("persons_unserved"),
        scalar.money_or_zero("scholarship_amount").alias("scholarship_amount"),
        scalar.money_or_zero("subsidy_amount").alias("subsidy_amount"),
        scalar.money_or_zero("credit_amount").alias("credit_amount"),
        "weight",
    )


#: what indicators add up; all of it adds up again
MEASURES = (
    "persons", "students", "scholars", "subsidised", "credited", "supported", "persons_at_risk", "persons_unserved",
    "scholarship_amount", "subsidy_amount", "credit_amount",
)


def indicator_sums(fact: DataFrame) -> DataFrame:
    """The fact's measures per year and location, also of unknown ones.

    Stored by year: a reload of one year reads and replaces its sums only, and
    the indicators are made of the sums of all years, a few rows each.
    """
    return sums_by(fact, [spec.YEAR, "location_sk"], {m: m for m in MEASURES})


def kpi_scholarships_yearly(fact: DataFrame) -> DataFrame:
    """Support per year: counts, amounts, coverage and growth.

    ``fact``: the fact, or its ``indicator_sums``.
    """
    sums = sums_by(fact, [spec.YEAR], {
        "persons": "persons",
        "students": "students",
        "scholars": "scholars",
        "subsidised": "subsidised",
        "credited": "credited",
        "supported": "supported",
        "scholarship_total": "scholarship_amount",
        "subsidy_total": "subsidy_amount",
        "credit_total": "credit_amount",
    })
    # sums of sums have the type of sums
    sums = sums.withColumns({
        f"{kind}_total": F.col(f"{kind}_total").cast("decimal(24,2)") for kind in ("scholarship", "subsidy", "credit")
    })
    shares = with_shares(sums, {
        "scholarship_pct": ("scholars", "students"),
        "subsidy_pct": ("subsidised", "students"),
        "support_pct": ("supported", "students"),
    })
    return with_growth(shares, "scholars", spec.YEAR, "scholar_growth_pct")


def kpi_living_conditions(fact: DataFrame, locations: DataFrame) -> DataFrame:
    """Persons at risk and without basic services per year and region.

    ``fact``, or its ``indicator_sums``, is summed by location key first; the
    names join the sums.
    """
    sums = sums_by(
        fact.filter("location_sk IS NOT NULL"),
        [spec.YEAR, "location_sk"],
        {
            "persons": "persons",
            "persons_at_risk": "persons_at_risk",
            "persons_unserved": "persons_unserved",
        },
    )
    named = sums.join(locations, "location_sk").select(
        spec.YEAR, "region_id", "region", "persons", "persons_at_risk", "persons_unserved"
    )
    return with_shares(named, {
        "at_risk_pct": ("persons_at_risk", "persons"),
        "unserved_pct": ("persons_unserved", "persons"),
    })
