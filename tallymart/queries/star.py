"""The survey dataflow over the given tables: clean tables, star, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.operators import quality
from tallymart.operators.project import rename_present
from tallymart.plans import analytics, bronze, gold, run, silver, spec
from tallymart.queries import star_sql as sql
from tallymart.queries.fixture import AS_OF_YEAR, TOWNS, TWICE_YEAR, geography, raw, star
from tallymart.queries.registry import Tables, query
from tallymart.session import scratch_path
from tallymart.sources.audit import Audit
from tallymart.sources.tables import Layers


# --- clean tables, from the stored raw tables --------------------------------


@query(sql.over(sql.GEOGRAPHY, sql="SELECT * FROM geography"))
def silver_geography(t: Tables) -> DataFrame:
    return geography(t)


@query(sql.over(sql.DWELLING, sql="SELECT * FROM dwelling"))
def silver_dwelling(t: Tables) -> DataFrame:
    return silver.dwelling(bronze.read_module(raw(t, "dwelling"), "dwelling"))


@query(sql.over(sql.GEOGRAPHY, sql.MEMBER, sql="SELECT * FROM member"))
def silver_member(t: Tables) -> DataFrame:
    s = raw(t, "member", TOWNS)
    towns = silver.geography(*[s.read("bronze", table) for table in ("departments", "sheet_towns", "database_towns")])
    return silver.member(bronze.read_module(s, "member"), towns)


@query(sql.over(sql.EDUCATION, sql="SELECT * FROM education"))
def silver_education(t: Tables) -> DataFrame:
    return silver.education(bronze.read_module(raw(t, "education"), "education"))


# --- star, from the stored clean tables -------------------------------------


@query(sql.over(sql="SELECT * FROM person"))
def composite_left_join(t: Tables) -> DataFrame:
    s = star(t, "member", "education", "dwelling")
    return silver.person(
        s.read("silver", "member"), s.read("silver", "education"), s.read("silver", "dwelling")
    )


@query(sql.over(sql="SELECT * FROM dim_time"))
def dim_time(t: Tables) -> DataFrame:
    return gold.dim_time(star(t, "person").read("silver", "person"), AS_OF_YEAR)


@query(sql.over(sql="SELECT * FROM dim_location"))
def dim_location(t: Tables) -> DataFrame:
    return gold.dim_location(star(t, "dwelling").read("silver", "dwelling"))


@query(sql.over(sql="SELECT * FROM dim_person"))
def dim_person(t: Tables) -> DataFrame:
    return gold.dim_person(star(t, "person").read("silver", "person"))


@query(sql.over(sql="SELECT * FROM dim_dwelling"))
def dim_dwelling(t: Tables) -> DataFrame:
    return gold.dim_dwelling(star(t, "dwelling").read("silver", "dwelling"))


@query(sql.over(sql="SELECT * FROM dim_education"))
def dim_education(t: Tables) -> DataFrame:
    return gold.dim_education(star(t, "education").read("silver", "education"))


@query(sql.over(sql="SELECT * FROM fact"))
def fact_build(t: Tables) -> DataFrame:
    s = star(t, "person", "dim_location")
    return gold.fact_survey(s.read("silver", "person"), s.read("gold", "dim_location"))


@query(sql.over(sql="SELECT * FROM fact"))
def fact_build_hot_keys(t: Tables) -> DataFrame:
    s = star(t, "member", "education", "dwelling", "dim_location")
    persons = silver.person(
        s.read("silver", "member"), s.read("silver", "education"), s.read("silver", "dwelling"),
        hot_dwellings=100,
    )
    return gold.fact_survey(persons, s.read("gold", "dim_location"))


# --- indicators and reports, from the stored star ---------------------------


@query(sql.over(sql="SELECT * FROM kpi_scholarships_yearly"))
def kpi_yearly(t: Tables) -> DataFrame:
    return gold.kpi_scholarships_yearly(star(t, "fact_survey").read("gold", "fact_survey"))


@query(sql.over(sql="SELECT * FROM kpi_living_conditions"))
def kpi_region_year(t: Tables) -> DataFrame:
    s = star(t, "fact_survey", "dim_location")
    return gold.kpi_living_conditions(
        s.read("gold", "fact_survey"), s.read("gold", "dim_location")
    )


@query(sql.over(sql="SELECT * FROM kpi_scholarships_yearly"))
def kpi_incremental(t: Tables) -> DataFrame:
    """Indicators kept up: sums of a fact with one year missing and one wrong,
    then both years loaded, each by replacing its own sums."""
    fact = star(t, "fact_survey").read("gold", "fact_survey")
    layers = Layers(t.spark, scratch_path(t.spark, "kept-up"))
    known = fact.filter("survey_year <> 1994")
    doubled = known.unionAll(known.filter("survey_year = 1996"))
    layers.write(gold.indicator_sums(doubled), "gold", "indicator_sums", partition_by=["survey_year"])
    for year in (1994, 1996):
        one = gold.indicator_sums(fact.filter(F.col("survey_year") == year))
        layers.write(
            one, "gold", "indicator_sums", partition_by=["survey_year"], only_partitions=True, replaces=[year]
        )
    return gold.kpi_scholarships_yearly(layers.read("gold", "indicator_sums"))


@query(sql.over(sql="""
SELECT birth_dept, count(*) AS n FROM dim_person
WHERE migrant AND birth_dept IS NOT NULL
GROUP BY birth_dept ORDER BY n DESC, birth_dept LIMIT 10"""))
def top_origins(t: Tables) -> DataFrame:
    return analytics.top_origins(star(t, "dim_person").read("gold", "dim_person"))


@query(sql.over(sql=f"""
SELECT survey_year, total, migrants, foreigners, {sql.pct('migrants', 'total')} AS migrant_pct
FROM (SELECT survey_year, count(*) AS total, CAST(sum(migrant::INT) AS BIGINT) AS migrants,
             CAST(sum(born_abroad::INT) AS BIGINT) AS foreigners
      FROM dim_person GROUP BY survey_year)"""))
def migrant_share_by_year(t: Tables) -> DataFrame:
    return analytics.migrant_share_by_year(star(t, "dim_person").read("gold", "dim_person"))


@query(sql.over(sql=f"""
SELECT region, dwellings, at_risk, {sql.pct('at_risk', 'dwellings')} AS at_risk_pct
FROM (SELECT region, count(*) AS dwellings, CAST(sum(at_risk::INT) AS BIGINT) AS at_risk
      FROM dim_dwelling WHERE region IS NOT NULL GROUP BY region)"""))
def risk_share_by_region(t: Tables) -> DataFrame:
    return analytics.risk_share_by_region(star(t, "dim_dwelling").read("gold", "dim_dwelling"))


@query(sql.over(sql=f"""
SELECT survey_year, students, scholars, {sql.pct('scholars', 'students')} AS scholarship_pct
FROM (SELECT survey_year, CAST(sum(studying::INT) AS BIGINT) AS students,
             CAST(sum(scholarship::INT) AS BIGINT) AS scholars
      FROM dim_education GROUP BY survey_year)"""))
def scholarship_share_by_year(t: Tables) -> DataFrame:
    return analytics.scholarship_share_by_year(star(t, "dim_education").read("gold", "dim_education"))


_LEVELS = f"""
SELECT level, total, students, scholars, {sql.pct('scholars', 'students')} AS coverage_pct
FROM (SELECT level, count(*) AS total, CAST(sum(students) AS BIGINT) AS students,
             CAST(sum(scholars) AS BIGINT) AS scholars
      FROM fact JOIN dim_education d USING (education_sk) WHERE d.studying GROUP BY level)
"""


@query(sql.over(sql=_LEVELS))
def coverage_by_level(t: Tables) -> DataFrame:
    s = star(t, "fact_survey", "dim_education")
    return analytics.coverage_by_level(
        s.read("gold", "fact_survey"), s.read("gold", "dim_education")
    )


@query(sql.over(sql=_LEVELS + "ORDER BY coverage_pct DESC NULLS LAST, level LIMIT 10"))
def topk_coverage_by_level(t: Tables) -> DataFrame:
    s = star(t, "fact_survey", "dim_education")
    return analytics.coverage_by_level(
        s.read("gold", "fact_survey"), s.read("gold", "dim_education"), k=10
    )


@query(sql.over(sql=f"""
SELECT region, persons, migrants, foreigners, {sql.pct('migrants', 'persons')} AS migrant_pct
FROM (SELECT region, count(*) AS persons, CAST(sum(migrant::INT) AS BIGINT) AS migrants,
             CAST(sum(born_abroad::INT) AS BIGINT) AS foreigners
      FROM fact JOIN dim_person USING (person_sk) JOIN dim_location USING (location_sk)
      GROUP BY region)"""))
def migrants_by_region(t: Tables) -> DataFrame:
    s = star(t, "fact_survey", "dim_person", "dim_location")
    return analytics.migrants_by_region(
        s.read("gold", "fact_survey"), s.read("gold", "dim_person"),
        s.read("gold", "dim_location"),
    )


@query(sql.over(sql="""
SELECT survey_year,
  CAST(round(CAST(scholarship_total AS DOUBLE) / 1000000, 2) AS DECIMAL(25,2))
    AS scholarship_millions,
  CAST(round(CAST(subsidy_total AS DOUBLE) / 1000000, 2) AS DECIMAL(25,2)) AS subsidy_millions,
  CAST(round(CAST(credit_total AS DOUBLE) / 1000000, 2) AS DECIMAL(25,2)) AS credit_millions
FROM kpi_scholarships_yearly"""))
def support_in_millions(t: Tables) -> DataFrame:
    return analytics.support_in_millions(star(t, "kpi_scholarships_yearly").read("gold", "kpi_scholarships_yearly"))


@query(sql.over(sql="""
SELECT survey_year, students, scholars, scholarship_pct, scholar_growth_pct
FROM kpi_scholarships_yearly"""))
def scholarship_report(t: Tables) -> DataFrame:
    return analytics.scholarship_report(star(t, "kpi_scholarships_yearly").read("gold", "kpi_scholarships_yearly"))


@query(sql.over(sql="""
SELECT survey_year, scholars, subsidised, credited, supported, support_pct
FROM kpi_scholarships_yearly"""))
def support_report(t: Tables) -> DataFrame:
    return analytics.support_report(star(t, "kpi_scholarships_yearly").read("gold", "kpi_scholarships_yearly"))


@query(sql.over(sql="""
SELECT survey_year, region, persons, persons_at_risk, at_risk_pct,
       persons_unserved, unserved_pct
FROM kpi_living_conditions"""))
def living_conditions_report(t: Tables) -> DataFrame:
    return analytics.living_conditions_report(star(t, "kpi_living_conditions").read("gold", "kpi_living_conditions"))


@query(sql.over(sql="""
SELECT region, persons, persons_at_risk, at_risk_pct FROM kpi_living_conditions
WHERE survey_year = 1998 ORDER BY at_risk_pct DESC, region LIMIT 5"""))
def topk_region_risk(t: Tables) -> DataFrame:
    return analytics.top_risk_regions(star(t, "kpi_living_conditions").read("gold", "kpi_living_conditions"), 1998)


@query(sql.over(sql="""
SELECT survey_year, CAST(sum(persons) AS BIGINT) AS persons,
       CAST(sum(students) AS BIGINT) AS students, CAST(sum(scholars) AS BIGINT) AS scholars
FROM fact GROUP BY survey_year"""))
def persons_by_year(t: Tables) -> DataFrame:
    return analytics.persons_by_year(star(t, "fact_survey").read("gold", "fact_survey"))


@query(sql.over(sql="""
SELECT count(*) AS total_rows, count(DISTINCT survey_year) AS total_years,
       CAST(sum(persons) AS BIGINT) AS persons, CAST(sum(scholars) AS BIGINT) AS scholars,
       CAST(sum(persons_at_risk) AS BIGINT) AS persons_at_risk
FROM fact"""))
def validation_totals(t: Tables) -> DataFrame:
    return analytics.validation_totals(star(t, "fact_survey").read("gold", "fact_survey"))


@query(sql.over(sql="""
SELECT survey_year, CAST(sum(CAST(weight AS DECIMAL(20,6))) AS DECIMAL(30,6)) AS population,
       CAST(sum(CASE WHEN scholars = 1 THEN CAST(weight AS DECIMAL(20,6)) END)
            AS DECIMAL(30,6)) AS estimate
FROM fact GROUP BY survey_year"""))
def weighted_estimate(t: Tables) -> DataFrame:
    return analytics.weighted_estimate(star(t, "fact_survey").read("gold", "fact_survey"), "scholars")


# --- published names --------------------------------------------------------


@query(sql.over(sql="""
SELECT survey_year AS anio_encuesta, region_id, region, persons AS total_personas,
       persons_at_risk AS personas_en_vivienda_riesgo,
       persons_unserved AS personas_sin_servicios_basicos,
       at_risk_pct AS pct_en_riesgo, unserved_pct AS pct_sin_servicios
FROM kpi_living_conditions"""))
def published_names(t: Tables) -> DataFrame:
    _, own = spec.PUBLISHED_TABLES["kpi_living_conditions"]
    kpi = star(t, "kpi_living_conditions").read("gold", "kpi_living_conditions")
    return rename_present(kpi, {**spec.PUBLISHED_NAMES, **own})


# --- quality reports --------------------------------------------------------


def _keys(name: str, table: str, key: str) -> str:
    return f"""
SELECT '{name}' AS table_name, count(*) AS total, count(DISTINCT {key}) AS distinct_keys,
       count(*) FILTER ({key} IS NULL) AS null_keys,
       CASE WHEN count(*) = count(DISTINCT {key}) AND count(*) = count({key})
            THEN 'OK' ELSE 'ALERT' END AS status
FROM {table}"""


_DIMENSIONS = {
    "dim_person": "person_sk",
    "dim_dwelling": "dwelling_sk",
    "dim_education": "education_sk",
    "dim_location": "location_sk",
    "dim_time": "time_sk",
}


@query(sql.over(sql=" UNION ALL ".join(
    [_keys(d, d, k) for d, k in _DIMENSIONS.items()]
    + [_keys("fact_survey", "fact", "location_sk")]
)))
def key_uniqueness_audit(t: Tables) -> DataFrame:
    s = star(t, *_DIMENSIONS, "fact_survey")
    tables = {d: (s.read("gold", d), k) for d, k in _DIMENSIONS.items()}
    # not a key of the fact: shows what an alert looks like
    tables["fact_survey"] = (s.read("gold", "fact_survey"), "location_sk")
    return quality.key_audit(tables)


_YEARLY = ["dim_person", "dim_dwelling", "dim_education"]


@query(sql.over(sql=" UNION ALL ".join(
    f"SELECT *, 'sketch' AS settled_by FROM ({_keys(d, d, _DIMENSIONS[d])})" for d in _YEARLY
) + f" UNION ALL SELECT *, 'count' AS settled_by FROM ({_keys('fact_survey', 'fact', 'location_sk')})"))
def key_audit_sketch(t: Tables) -> DataFrame:
    """Sketches of a star whose last year is sketched after the others; a key
    that the years share is counted."""
    keys = run.YEARLY_KEYS | {"fact_survey": "location_sk"}
    s = star(t, *keys)
    years = sorted(r.survey_year for r in s.partition_values("gold", "fact_survey").collect())
    run.sketch_keys(s, years[:-1], keys)
    run.sketch_keys(s, years[-1:], keys)
    return run.sketched_dimension_audit(s, keys)


def _refs(fk: str, dim: str, nullable: bool) -> str:
    return f"""
SELECT '{fk}' AS fk, count(*) AS total,
       count(*) FILTER (f.{fk} IS NOT NULL AND d.{fk} IS NULL) AS orphans,
       count(*) FILTER (f.{fk} IS NULL) AS null_rows,
       {sql.pct(f'count(*) FILTER (f.{fk} IS NULL)', 'count(*)')} AS null_pct,
       CASE WHEN count(*) FILTER (f.{fk} IS NOT NULL AND d.{fk} IS NULL) = 0
            THEN 'OK' ELSE 'ALERT' END AS match_status,
       CASE WHEN {nullable} OR count(*) FILTER (f.{fk} IS NULL) = 0
            THEN 'OK' ELSE 'ALERT' END AS null_status
FROM fact f LEFT JOIN {dim} d ON d.{fk} = f.{fk}"""


_REFERENCES = [
    ("person_sk", "dim_person", False),
    ("dwelling_sk", "dim_dwelling", False),
    ("education_sk", "dim_education", True),
    ("time_sk", "dim_time", False),
    ("location_sk", "dim_location", True),
]


@query(sql.over(sql=" UNION ALL ".join(_refs(*r) for r in _REFERENCES)))
def ref_integrity(t: Tables) -> DataFrame:
    s = star(t, *_DIMENSIONS, "fact_survey")
    return quality.referential_audit(
        s.read("gold", "fact_survey"),
        [quality.Reference(fk, s.read("gold", dim), fk, null) for fk, dim, null in _REFERENCES],
    )


@query("""
WITH pairs AS (
  SELECT 'orders' AS table_name, (SELECT count(*) FROM orders) AS source_rows,
         (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS target_rows
  UNION ALL
  SELECT 'documents', (SELECT count(*) FROM documents), (SELECT count(*) FROM labels)
  UNION ALL
  SELECT 'customer', (SELECT count(*) FROM customer), (SELECT count(*) FROM customer)
  UNION ALL
  SELECT 'events', (SELECT count(*) FROM events), NULL)
SELECT *, CASE WHEN source_rows = target_rows THEN 'OK' ELSE 'ALERT' END AS status FROM pairs
""")
def reconcile_counts(t: Tables) -> DataFrame:
    source = quality.row_counts({
        "orders": t.orders, "documents": t.documents, "customer": t.customer, "events": t.events,
    })
    target = quality.row_counts({
        "orders": t.lineitem.select("l_orderkey").distinct(),
        "documents": t.labels,
        "customer": t.customer,
    })
    return quality.reconcile(source, target)


@query("""
SELECT CAST(user_id AS VARCHAR) AS run_id, count(*) AS total,
       count(*) FILTER (event_type = 'click') AS ok,
       count(*) FILTER (event_type = 'error') AS errors,
       count(*) FILTER (event_type = 'view') AS skipped
FROM events GROUP BY user_id
""")
def run_summary(t: Tables) -> DataFrame:
    status = (
        F.when(F.col("event_type") == "click", "OK")
        .when(F.col("event_type") == "error", "ERROR")
        .when(F.col("event_type") == "view", "SKIPPED")
    )
    runs = t.events.select(F.col("user_id").cast("string").alias("run_id"), status.alias("status"))
    return quality.run_summary(runs)


# --- the run itself, from text files to the stored star ----------------------


@query(sql.over(sql="SELECT * FROM fact"))
def pipeline_fact(t: Tables) -> DataFrame:
    return star(t, "fact_survey").read("gold", "fact_survey")


@query(sql.over(sql="SELECT * FROM kpi_scholarships_yearly"))
def pipeline_kpi_yearly(t: Tables) -> DataFrame:
    return star(t, "kpi_scholarships_yearly").read("gold", "kpi_scholarships_yearly")


@query("""
SELECT 'departments' AS table_name, CAST(r_regionkey AS VARCHAR) AS code, r_name AS name,
       'excel' AS origin, 'geography.xlsx#Departamentos' AS source_file, CAST(0 AS INTEGER) AS survey_year
FROM region
UNION ALL
SELECT 'sheet_towns', CASE WHEN n_nationkey = 24 THEN 'x' ELSE CAST(n_nationkey AS VARCHAR) END, n_name, 'excel',
       'geography.xlsx#Municipios (3)', 0 FROM nation
UNION ALL
SELECT 'database_towns', CAST(s_suppkey AS VARCHAR), s_name, 'mysql', 'municipios', 0 FROM supplier
""")
def reference_ingest(t: Tables) -> DataFrame:
    """The raw geography as the run loads it: two sheets and a table."""
    s = raw(t, TOWNS)
    parts = {
        "departments": ("codigo_deapartamento", "nombre_departamento"),
        "sheet_towns": ("municipio_id", "nombre_municipio"),
        "database_towns": ("municipio_id", "nombremunicipio"),
    }
    return quality.stack([
        s.read("bronze", table).select(
            F.lit(table).alias("table_name"), F.col(code).alias("code"), F.col(name).alias("name"),
            "origin", "source_file", "survey_year",
        ) for table, (code, name) in parts.items()
    ])


@query("""
SELECT table_name, survey_year, count(*) AS row_count FROM (
  SELECT 'dwelling' AS table_name, CAST(year(o_orderdate) AS INTEGER) AS survey_year
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
  UNION ALL
  SELECT 'member', CAST(year(o_orderdate) AS INTEGER) FROM orders
  UNION ALL
  SELECT 'education', CAST(year(o_orderdate) AS INTEGER)
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
GROUP BY table_name, survey_year
""")
def pipeline_run_log(t: Tables) -> DataFrame:
    return Audit(raw(t, *bronze.MODULES)).yearly_loads().select("table_name", "survey_year", "row_count")


# --- profiles of the clean tables and dimensions -----------------------------


def _profile(layer: str, table: str, column: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS \"column\", "
        f"CAST({column} AS VARCHAR) AS value, count(*) AS n FROM {table} GROUP BY {column}"
    )


@query(sql.over(sql=" UNION ALL ".join(
    _profile(layer, table, c) for (layer, table), columns in run.PROFILED.items() for c in columns
)))
def silver_profile(t: Tables) -> DataFrame:
    return run.silver_profile(star(t, *[table for _, table in run.PROFILED]))


@query(sql.over(sql=" UNION ALL ".join(
    f"SELECT '{d}' AS table_name, survey_year, count(*) AS n FROM {d} GROUP BY survey_year"
    for d in run.SURVEY_DIMENSIONS
)))
def dimension_rows_per_year(t: Tables) -> DataFrame:
    return run.dimension_rows_per_year(star(t, *run.SURVEY_DIMENSIONS))


@query(sql.over(sql=" UNION ALL ".join(
    f"SELECT '{published}' AS table_name, count(*) AS source_rows, count(*) AS target_rows, "
    f"'OK' AS status FROM {'fact' if table == 'fact_survey' else table}"
    for table, (published, _) in spec.PUBLISHED_TABLES.items()
)))
def serving_counts(t: Tables) -> DataFrame:
    s = star(t)
    out = scratch_path(t.spark, "published")
    run.serve(s, Audit(s), lambda df, name: df.write.parquet(f"{out}/{name}"))
    return run.serving_audit(s, lambda name: t.spark.read.parquet(f"{out}/{name}"))


# --- the run's log, its tables in the catalog, a layer that starts anew -------

_RAW = {
    "dwelling": "orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey",
    "member": "orders",
    "education": "lineitem JOIN orders ON o_orderkey = l_orderkey",
}
_REFERENCE = {"departments": "region", "sheet_towns": "nation", "database_towns": "supplier"}
_GOLD = {
    t: "fact" if t == "fact_survey" else t
    for t in (*run.DIMENSION_KEYS, "fact_survey", "kpi_scholarships_yearly", "kpi_living_conditions")
}


def _history() -> str:
    """Loads, rows read and rows stored of every step."""
    twice = f"count(*) FILTER (year(o_orderdate) = {TWICE_YEAR})"
    raw = [
        f"SELECT 'bronze' AS layer, '{m}' AS table_name, count(DISTINCT year(o_orderdate)) + 1 AS loads, "
        f"count(*) + {twice} AS rows_in, count(*) + {twice} AS rows_out FROM {rows}" for m, rows in _RAW.items()
    ] + [f"SELECT 'bronze', '{t}', 1, count(*), count(*) FROM {rows}" for t, rows in _REFERENCE.items()]
    clean = [f"SELECT 'silver', '{m}', 1, (SELECT count(*) FROM {rows}), count(*) FROM {m}" for m, rows in _RAW.items()]
    whole = [("silver", "person", "person"), *[("gold", t, rows) for t, rows in _GOLD.items()]]
    return " UNION ALL ".join([
        *raw, *clean, *[f"SELECT '{layer}', '{t}', 1, count(*), count(*) FROM {rows}" for layer, t, rows in whole]
    ])


@query(sql.over(sql=f"""
SELECT layer, table_name, loads, CAST(rows_in AS BIGINT) AS rows_in, CAST(rows_out AS BIGINT) AS rows_out,
       loads AS ended_well, true AS timed
FROM ({_history()})
"""))
def run_history(t: Tables) -> DataFrame:
    """What the log of the star's own run says of each table of the survey."""
    runs = Audit(star(t)).runs()
    own = runs.orderBy("started_at").head().run_id
    timed = (F.col("ended_at") >= F.col("started_at")) & (F.col("seconds") >= 0)
    chosen = runs.filter((F.col("run_id") == own) & F.col("layer").isin("bronze", "silver", "gold"))
    return chosen.filter("table_name <> 'indicator_sums'").groupBy("layer", "table_name").agg(
        F.count("*").alias("loads"), F.sum("rows_in").alias("rows_in"), F.sum("rows_out").alias("rows_out"),
        F.count_if(F.col("status") == "OK").alias("ended_well"), F.every(timed).alias("timed"),
    )


@query(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {rows}" for t, rows in (_RAW | _REFERENCE).items()
) + " UNION ALL SELECT 'not_loaded', NULL")
def raw_row_check(t: Tables) -> DataFrame:
    """Rows of each raw table, NULL for one that was never loaded."""
    found = bronze.row_check(raw(t, *bronze.MODULES, TOWNS), [*_RAW, *_REFERENCE, "not_loaded"])
    return t.spark.createDataFrame(list(found.items()), "table_name string, row_count bigint")


@query(sql.over(sql=" UNION ALL ".join(
    f"SELECT 'gold' AS layer, '{t}' AS table_name, count(*) AS row_count FROM {rows}" for t, rows in _GOLD.items()
) + " UNION ALL " + " UNION ALL ".join(
    f"SELECT 'silver', '{t}', count(*) FROM {t}" for t in ("dwelling", "member", "education", "person")
)))
def catalog_counts(t: Tables) -> DataFrame:
    """The registered tables, as the catalog lists them, and their rows by SQL."""
    prefix = "listed_" + "".join(c if c.isalnum() else "_" for c in t.folder.rsplit("/", 1)[-1])
    listing = star(t).register(prefix).filter("table_name <> 'indicator_sums'").collect()
    layers = {f"{prefix}_{layer}": layer for layer in ("silver", "gold")}
    return quality.stack([
        t.spark.sql(f"SELECT '{layers[r.schema_name]}' AS layer, '{r.table_name}' AS table_name, count(*) AS row_count "
                    f"FROM {r.schema_name}.{r.table_name}")
        for r in listing if r.schema_name in layers
    ])


@query("""
SELECT 'gold' AS layer, o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS survey_year FROM orders WHERE year(o_orderdate) >= 1998
UNION ALL
SELECT 'silver', o_orderkey, CAST(year(o_orderdate) AS INTEGER) FROM orders WHERE year(o_orderdate) < 1998
""")
def reset_layer(t: Tables) -> DataFrame:
    """Two layers with the early years; one is reset and loaded with the late
    years alone, the other keeps its rows."""
    layers = Layers(t.spark, scratch_path(t.spark, "reset"))
    orders = t.orders.select("o_orderkey", F.year("o_orderdate").alias("survey_year"))
    early = orders.filter("survey_year < 1998")
    for layer in ("silver", "gold"):
        layers.write(early, layer, "orders", partition_by=["survey_year"])
    layers.reset("gold")
    if layers.read_optional("gold", "orders") is not None:
        raise RuntimeError("a layer that was reset still has its table")
    layers.write(orders.filter("survey_year >= 1998"), "gold", "orders", mode="append", partition_by=["survey_year"])
    return quality.stack([
        layers.read(layer, "orders").select(F.lit(layer).alias("layer"), "o_orderkey", "survey_year")
        for layer in ("silver", "gold")
    ])
