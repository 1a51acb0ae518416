"""The whole dataflow, one stored table after the other."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.operators import quality
from tallymart.operators.aggregate import frequency, frequency_profile
from tallymart.operators.project import Field, rename_present, unreadable
from tallymart.plans import bronze, gold, silver, spec
from tallymart.session import storing_steps, together
from tallymart.sources.audit import Audit
from tallymart.sources.relational import Published, publish
from tallymart.sources.tables import Layers

DIMENSION_KEYS = {
    "dim_person": "person_sk",
    "dim_dwelling": "dwelling_sk",
    "dim_education": "education_sk",
    "dim_location": "location_sk",
    "dim_time": "time_sk",
}
NULLABLE_KEYS = ("education_sk", "location_sk")
#: what each table is made of, and the raw rows of those made of raw rows
MADE_OF: dict[str, tuple[str, ...]] = {
    "geography": (),
    "dwelling": (),
    "member": ("geography",),
    "education": (),
    "person": ("member", "education", "dwelling"),
    "dim_time": ("person",),
    "dim_location": ("dwelling",),
    "dim_person": ("person",),
    "dim_dwelling": ("dwelling",),
    "dim_education": ("education",),
    "fact_survey": ("person", "dim_location"),
    "indicator_sums": ("fact_survey",),
    "kpi_scholarships_yearly": ("indicator_sums",),
    "kpi_living_conditions": ("indicator_sums", "dim_location"),
}
RAW_OF = {"geography": "towns", "dwelling": "dwelling", "member": "member", "education": "education"}


def needed(tables: Iterable[str]) -> set[str]:
    """The tables and all they are made of."""
    found: set[str] = set()
    for table in tables:
        found |= {table} | needed(MADE_OF[table])
    return found


class Builder:
    """Builds tables from stored tables and logs each.

    With ``years`` only those years are read, and only their partitions are
    replaced; dimensions across years are made anew, indicators from the stored
    sums of all years. ``buckets`` is the number in which persons are stored by
    key, so that their tables join without a shuffle; a table keeps its number
    while single years are replaced. With ``tables`` no others are built.
    """

    def __init__(
        self,
        layers: Layers,
        audit: Audit,
        years: Sequence[int] | None = None,
        rebalance: bool = True,
        on_error: str = "raise",
        buckets: int | None = None,
        tables: Iterable[str] | None = None,
    ):
        self.tables = None if tables is None else set(tables)
        self.buckets = buckets or int(layers.spark.conf.get("spark.sql.shuffle.partitions"))
        self.layers = layers
        self.audit = audit
        self.years = list(years) if years else None
        self.rebalance = rebalance
        self.on_error = on_error

    def read(self, layer: str, table: str) -> DataFrame:
        df = self.layers.read(layer, table)
        if self.years and spec.YEAR in df.columns:
            return df.filter(F.col(spec.YEAR).isin(self.years))
        return df

    def build(
        self,
        layer: str,
        table: str,
        make: Callable[[], DataFrame],
        source: Callable[[], DataFrame] | None = None,
        yearly: bool = True,
        keys: Sequence[str] = (),
        fields: Sequence[Field] = (),
        bucket_by: Sequence[str] = (),
    ) -> None:
        """Store ``make()``. Rows without a full key stay and are remarked on,
        so are amounts of ``source()`` that became 0.00 as none could be read."""
        if self.tables is not None and table not in self.tables:
            return

        def work() -> tuple[int, int, str]:
            options = {}
            if yearly:
                options = {
                    "partition_by": [spec.YEAR],
                    "only_partitions": self.years is not None,
                    "rebalance": self.rebalance,
                    "replaces": self.years or (),
                    "buckets": (self.buckets, tuple(bucket_by)) if bucket_by else None,
                }
            stored = self.layers.write(make(), layer, table, **options)
            if yearly and self.years:
                stored = stored.filter(F.col(spec.YEAR).isin(self.years))
            rows_out = stored.count()
            lost = quality.without_key(stored, keys).count() if keys else 0
            remarks = [f"{lost} rows without a full key"] if lost else []
            if source and any(f.kind == "money" for f in fields):
                amounts = unreadable(source(), fields).head().asDict()
                remarks += [f"{n} unreadable in {c}" for c, n in amounts.items() if n]
            rows_in = source().count() if source else rows_out
            return rows_in, rows_out, "; ".join(remarks)

        self.audit.step(layer, layer, table, work, self.on_error)


def build_silver(b: Builder) -> None:
    """Geography and the four clean survey tables."""

    def raw(module: str) -> DataFrame:
        return bronze.read_module(b.layers, module, b.years)

    def geography_and_member() -> None:
        b.build(
            "ref", "geography",
            lambda: silver.geography(
                b.layers.read("bronze", "departments"),
                b.layers.read("bronze", "sheet_towns"),
                b.layers.read_optional("bronze", "database_towns"),
            ),
            yearly=False,
        )
        b.build(
            "silver", "member",
            lambda: silver.member(raw("member"), b.layers.read("ref", "geography")),
            lambda: raw("member"),
            keys=spec.PERSON_KEY, bucket_by=spec.PERSON_BUCKETS,
        )

    together(b.layers.spark, [
        geography_and_member,
        lambda: b.build(
            "silver", "dwelling", lambda: silver.dwelling(raw("dwelling")),
            lambda: raw("dwelling"), keys=spec.HOUSEHOLD_KEY,
        ),
        lambda: b.build(
            "silver", "education", lambda: silver.education(raw("education")),
            lambda: raw("education"), keys=spec.PERSON_KEY, fields=spec.EDUCATION,
            bucket_by=spec.PERSON_BUCKETS,
        ),
    ])
    b.build(
        "silver", "person",
        lambda: silver.person(
            b.read("silver", "member"), b.read("silver", "education"), b.read("silver", "dwelling")
        ),
    )


def build_gold(b: Builder, as_of_year: int) -> None:
    """Dimensions, fact and indicators."""
    layers = b.layers
    together(layers.spark, [
        lambda: b.build(
            "gold", "dim_time",
            lambda: gold.dim_time(layers.partition_values("silver", "person"), as_of_year), yearly=False,
        ),
        lambda: b.build(
            "gold", "dim_location",
            lambda: gold.dim_location(layers.read("silver", "dwelling")), yearly=False,
        ),
        lambda: b.build("gold", "dim_person", lambda: gold.dim_person(b.read("silver", "person"))),
        lambda: b.build(
            "gold", "dim_dwelling", lambda: gold.dim_dwelling(b.read("silver", "dwelling"))
        ),
        lambda: b.build(
            "gold", "dim_education", lambda: gold.dim_education(b.read("silver", "education"))
        ),
    ])
    b.build(
        "gold", "fact_survey",
        lambda: gold.fact_survey(b.read("silver", "person"), layers.read("gold", "dim_location")),
    )
    b.build("gold", "indicator_sums", lambda: gold.indicator_sums(b.read("gold", "fact_survey")))
    together(layers.spark, [
        lambda: b.build(
            "gold", "kpi_scholarships_yearly",
            lambda: gold.kpi_scholarships_yearly(layers.read("gold", "indicator_sums")), yearly=False,
        ),
        lambda: b.build(
            "gold", "kpi_living_conditions",
            lambda: gold.kpi_living_conditions(
                layers.read("gold", "indicator_sums"), layers.read("gold", "dim_location")
            ),
            yearly=False,
        ),
    ])


def build_all(
    layers: Layers,
    audit: Audit,
    as_of_year: int,
    years: Sequence[int] | None = None,
    rebalance: bool = True,
    buckets: int | None = None,
    tables: Iterable[str] | None = None,
) -> None:
    """Everything after the raw tables, or ``tables`` alone; see ``needed`` for
    those that have to be there.

    Without ``rebalance`` each task of the last shuffle writes a file per year.
    ``buckets``: see ``Builder``; by default the number of shuffle partitions.
    """
    b = Builder(layers, audit, years, rebalance, buckets=buckets, tables=tables)
    with audit.recording(), storing_steps(layers.spark):
        build_silver(b)
        build_gold(b, as_of_year)


def dimension_audit(layers: Layers) -> DataFrame:
    """Is each dimension key unique and never NULL."""
    return quality.key_audit({
        table: (layers.read("gold", table), key) for table, key in DIMENSION_KEYS.items()
    })


#: keys of tables that grow by the year
YEARLY_KEYS = {t: DIMENSION_KEYS[t] for t in ("dim_person", "dim_dwelling", "dim_education")}


def sketch_keys(layers: Layers, years: Sequence[int] | None = None, keys: Mapping[str, str] = YEARLY_KEYS) -> None:
    """Store the key counts and sketches of some years, or of all. Only those
    years are read, and only their rows are replaced."""

    def sketched(table: str, key: str) -> DataFrame:
        df = layers.read("gold", table)
        chosen = df.filter(F.col(spec.YEAR).isin(list(years))) if years else df
        return quality.key_sketches(chosen, key, spec.YEAR).withColumn("table_name", F.lit(table))

    layers.write(
        quality.stack([sketched(t, k) for t, k in keys.items()]), "audit", "key_sketches",
        partition_by=[spec.YEAR], only_partitions=bool(years), replaces=years or (),
    )


def sketched_dimension_audit(layers: Layers, keys: Mapping[str, str] = YEARLY_KEYS) -> DataFrame:
    """``dimension_audit`` of the tables that grow, from their stored sketches."""
    tables = {table: (layers.read("gold", table), key) for table, key in keys.items()}
    return quality.sketched_key_audit(layers.read("audit", "key_sketches"), tables)


def fact_audit(layers: Layers) -> DataFrame:
    """Does each key of the fact find its dimension row."""
    return quality.referential_audit(
        layers.read("gold", "fact_survey"),
        [
            quality.Reference(key, layers.read("gold", table), key, key in NULLABLE_KEYS)
            for table, key in DIMENSION_KEYS.items()
        ],
    )


#: clean tables and the columns whose values are worth a look after a run
PROFILED = {
    ("ref", "geography"): ["source", "dept_name"],
    ("silver", "dwelling"): ["dwelling_type", "region", "at_risk"],
    ("silver", "member"): ["birthplace", "migrant", "birth_dept"],
    ("silver", "education"): ["level", "scholarship", "subsidy", "credit"],
}
SURVEY_DIMENSIONS = ("dim_person", "dim_dwelling", "dim_education")


def silver_profile(layers: Layers) -> DataFrame:
    """table_name, column, value, n: frequencies, one scan for each table."""
    return quality.stack([
        frequency_profile(layers.read(layer, table), columns)
        .select(F.lit(table).alias("table_name"), "column", "value", "n")
        for (layer, table), columns in PROFILED.items()
    ])


def dimension_rows_per_year(layers: Layers) -> DataFrame:
    """table_name, survey_year, n of the dimensions that grow with the survey."""
    return quality.stack([
        frequency(layers.read("gold", table), spec.YEAR)
        .select(F.lit(table).alias("table_name"), spec.YEAR, "n")
        for table in SURVEY_DIMENSIONS
    ])


def served_tables(
    layers: Layers,
    published_names: bool = True,
    table_names: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """The gold tables to publish, under the names that reports use.

    ``table_names`` overrides the name of single tables, as in
    ``{"fact_survey": "fac_2024"}``.
    """
    tables = {}
    for table, (published, own) in spec.PUBLISHED_TABLES.items():
        df = layers.read("gold", table)
        if published_names:
            df = rename_present(df, {**spec.PUBLISHED_NAMES, **own})
        name = published if published_names else table
        tables[(table_names or {}).get(table, name)] = df
    return tables


def serve(
    layers: Layers,
    audit: Audit,
    write: Callable[[DataFrame, str], None],
    published_names: bool = True,
    table_names: Mapping[str, str] | None = None,
    at_once: int = 4,
) -> Published:
    """Publish all gold tables, a few at once; each outcome is logged, failures
    do not stop it."""

    def report(name: str, rows: int, started_at: datetime, error: Exception | None) -> None:
        status, message = ("ERROR", str(error)) if error else ("OK", "")
        audit.log("serving", "serving", name, started_at, rows, rows, status, message)

    with audit.recording():
        return publish(served_tables(layers, published_names, table_names), write, report, at_once)


def serving_audit(
    layers: Layers,
    remote: Callable[[str], DataFrame],
    published_names: bool = True,
    table_names: Mapping[str, str] | None = None,
) -> DataFrame:
    """Row counts here and there; ``remote`` gives a published table or its scan."""
    local = served_tables(layers, published_names, table_names)
    return quality.reconcile(
        quality.row_counts(local), quality.row_counts({name: remote(name) for name in local})
    )
