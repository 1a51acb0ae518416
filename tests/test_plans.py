"""What the plans look like: little read, few shuffles, nothing in Python."""

import re

import pytest

from tallymart.plans import analytics, bronze, gold, run, silver
from tallymart.plans import codebook as codes
from tallymart.plans import spec
from tallymart.queries import fixture, queries
from tallymart.queries.registry import Tables
from tallymart.session import small_scans
from tallymart.sources.delimited import read_delimited
from tallymart.sources.tables import Layers

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def star(spark):
    return fixture.star(Tables(spark, FOLDER))


def schemas(text):
    return re.findall(r"ReadSchema: struct<(.*?)>", text)


def exchanges(text):
    return len(re.findall(r"Exchange (hash|range|Single|Round)", text))


def test_every_query_stays_in_the_jvm_without_cross_joins(spark, plan):
    for name, build in queries().items():
        text = plan(build(spark, FOLDER))
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
            assert word not in text, name


def test_yearly_indicator_reads_what_it_sums(star, plan):
    text = plan(gold.kpi_scholarships_yearly(star.read("gold", "fact_survey")))
    (read,) = schemas(text)
    assert read.startswith("persons:int,students:int") and "person_sk" not in read
    assert text.index("partial_sum") > text.index("Exchange hashpartitioning")


def test_year_filter_prunes_partitions(star, plan):
    fact = star.read("gold", "fact_survey").filter("survey_year = 1998")
    text = plan(analytics.persons_by_year(fact))
    assert re.search(r"PartitionFilters: \[[^\]]*survey_year[^\]]* = 1998", text)


def test_report_filter_reaches_the_scan(star, plan):
    text = plan(analytics.top_origins(star.read("gold", "dim_person")))
    assert "PushedFilters: [EqualTo(migrant,true), IsNotNull(birth_dept)" in text or (
        "IsNotNull(birth_dept)" in text and "EqualTo(migrant,true)" in text
    )
    assert schemas(text) == ["birth_dept:string,migrant:boolean"]


def test_raw_table_is_read_by_the_spec(star, plan):
    from tallymart.plans import bronze

    text = plan(silver.education(bronze.read_module(star, "education")))
    assert "run_id" not in schemas(text)[0] and "P8610S1" in schemas(text)[0]


def test_fact_looks_up_its_location_only(star, plan):
    """The education key follows from the person, the dwelling's state is there."""
    text = plan(gold.fact_survey(star.read("silver", "person"), star.read("gold", "dim_location")))
    assert len(re.findall(r"Join ", text)) == 1 and "BroadcastHashJoin" in text
    assert exchanges(text) == 0 and "Window" not in text


def test_persons_meet_their_education_without_a_shuffle(spark, star, plan):
    """Both sides come from their buckets; dwellings are joined once."""
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        members, educations = star.read("silver", "member"), star.read("silver", "education")
        text = plan(silver.lookup_left(
            members, educations.select(*spec.PERSON_KEY, *spec.SUPPORT_COLUMNS), spec.PERSON_KEY))
        assert "SortMergeJoin" in text and "Exchange" not in text and text.count("Bucketed: true") == 2
        whole = plan(silver.person(members, educations, star.read("silver", "dwelling")))
        assert whole.count("SortMergeJoin") == 2
        # the persons once, to their dwelling, and the dwellings, which are reduced where they meet
        assert exchanges(whole) == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


def test_dedupe_sends_one_row_per_key_and_task(star, plan):
    text = plan(silver.one_per_dwelling(star.read("silver", "dwelling")))
    assert exchanges(text) == 1
    assert re.search(r"Exchange[\s\S]*WindowGroupLimit .*Partial", text)


def test_raw_rows_are_reduced_before_they_are_decoded(star, plan):
    """No window, one scan; below the aggregate whole numbers of the key are
    read, once, and neither code lists nor amounts."""
    geography = star.read("ref", "geography")
    for df, numbers, label in (
        (silver.dwelling(star.read("bronze", "dwelling")), 4, codes.REGION["1"]),
        (silver.member(star.read("bronze", "member"), geography), 4, codes.SEX["1"]),
        (silver.education(star.read("bronze", "education")), 4, codes.SCHOOL_TYPE["1"]),
    ):
        text = plan(df)
        assert "Window" not in text and label in text
        below = text[text.index("functions=[partial_min("):].split("FileScan")[0]
        assert below.count("RLIKE") == numbers
        assert label not in below and "decimal" not in below
        assert re.search(r"min\(struct[\s\S]*Exchange[\s\S]*partial_min\(struct", text)


def test_place_of_a_person_reads_six_columns_of_the_dwelling(star, plan):
    persons = silver.person(
        star.read("silver", "member"), star.read("silver", "education"),
        star.read("silver", "dwelling"),
    )
    reads = [r for r in schemas(plan(persons)) if "urban_class" in r]
    assert reads == [
        "dwelling_id:string,household_no:int,urban_class:string,region:string,lacks_services:boolean,at_risk:boolean"
    ]


def test_regional_indicator_joins_sums_not_rows(star, plan):
    text = plan(gold.kpi_living_conditions(
        star.read("gold", "fact_survey"), star.read("gold", "dim_location")
    ))
    assert text.index("Join") < text.index("HashAggregate")


def test_one_module_is_loaded_alone(spark, monkeypatch):
    """A query of one module does not build the star; the star then goes on."""
    monkeypatch.setattr(fixture, "_stars", {})
    t = Tables(spark, FOLDER)
    layers = fixture.raw(t, "dwelling")
    assert layers.exists("bronze", "dwelling")
    assert not any(layers.exists("bronze", m) for m in ("member", "education", "departments"))
    assert not layers.exists("silver", "dwelling")
    before = fixture._begun(t).audit.yearly_loads().count()
    fixture.raw(t, "dwelling")
    assert fixture._begun(t).audit.yearly_loads().count() == before == 7


def test_raw_rows_are_scanned_in_small_pieces(spark, star):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    bronze.read_module(star, "education")
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "16m"


def test_a_query_builds_only_what_it_reads(spark, monkeypatch):
    """The dwellings' dimension needs no persons; what is built later is built once."""
    monkeypatch.setattr(fixture, "_stars", {})
    t = Tables(spark, FOLDER)
    risk = queries()["risk_share_by_region"](spark, FOLDER)
    layers = fixture._begun(t).layers
    assert risk.count() > 0
    there = {n for layer in ("silver", "gold") for n in layers._stored(layer)}
    assert there == {"dwelling", "dim_dwelling"}
    assert not any(layers.exists("bronze", m) for m in ("member", "education", "departments"))
    fixture.star(t, "kpi_living_conditions")
    assert not layers.exists("gold", "dim_person")
    fixture.star(t)
    log = fixture._begun(t).audit.runs().filter("layer IN ('ref', 'silver', 'gold')").collect()
    assert sorted(r.table_name for r in log) == sorted(run.MADE_OF)


def test_each_table_is_made_of_those_named(star, monkeypatch):
    """Builds read no table that ``run.MADE_OF`` leaves out."""
    read, current = {}, []
    plain = Layers.read

    def noted(self, layer, table, *rest):
        read.setdefault(current[-1], set()).add((layer, table))
        return plain(self, layer, table, *rest)

    def step(self, layer, table, make, *rest, **options):
        current.append(table)
        make()

    monkeypatch.setattr(run, "together", lambda spark, steps: [s() for s in steps])
    monkeypatch.setattr(run.Builder, "build", step)
    monkeypatch.setattr(Layers, "read", noted)
    b = run.Builder(star, None)
    run.build_silver(b)
    run.build_gold(b, fixture.AS_OF_YEAR)
    made = {t: {n for layer, n in found if layer != "bronze"} for t, found in read.items()}
    assert {t: made.get(t, set()) for t in run.MADE_OF} == {
        t: set(of) if t != "dim_time" else set() for t, of in run.MADE_OF.items()  # reads only the names of folders
    }


def test_survey_text_is_written_once(spark, monkeypatch, tmp_path):
    """One write for each module; only the peculiar years are written again."""
    written, plain = [], fixture._write_text
    monkeypatch.setattr(fixture, "_write_text", lambda rows, path, *by: (written.append(path), plain(rows, path, *by)))
    years = fixture.write_survey(Tables(spark, FOLDER), str(tmp_path))
    assert len(written) == 3 * (1 + 2) < 3 * len(years)
    dwelling = {y: read_delimited(spark, f"{tmp_path}/{y}/{bronze.FILE_STEMS['dwelling']}{y}.csv").columns for y in years}
    usual = dwelling[fixture.TWICE_YEAR]
    assert usual[0] == "DIRECTORIO" and "REGION" in usual
    assert "REGION" not in dwelling[fixture.NO_REGION_YEAR]
    assert dwelling[fixture.OTHER_ORDER_YEAR] == usual[::-1]


def test_shuffled_bytes_of_a_task_are_bounded_where_the_session_names_none(spark):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    other = spark.newSession()
    small_scans(other)
    assert other.conf.get(name) == "16m"
    other.conf.set(name, "8m")
    small_scans(other)
    assert other.conf.get(name) == "8m"


def test_stored_buckets_join_without_a_shuffle_in_any_session(spark):
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    held = spark.conf.get(key)
    try:
        spark.conf.set(key, "true")
        small_scans(spark)
        assert spark.conf.get(key) == "false"
    finally:
        spark.conf.set(key, held)
