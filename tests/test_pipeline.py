import shutil
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallymart.operators import quality
from tallymart.plans import analytics, bronze, gold, run, silver, spec
from tallymart.sources.audit import Audit
from tallymart.sources.tables import Layers
from tests import survey
from tests.workbooks import write_workbook

COUNTS = ["students", "scholars", "subsidised", "credited", "supported",
          "persons_at_risk", "persons_unserved"]
AMOUNTS = ["scholarship_amount", "subsidy_amount", "credit_amount"]


def towns(spark):
    return spark.createDataFrame(
        [(5, "Medellín B", 5001), (5, "Abejorral", 5002), (8, "Soledad", 8758), (None, "x", None)],
        "`CódigoDepartamento` int, NombreMunicipio string, Municipio_ID int",
    )


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("survey")
    data = survey.generate(root / "raw")
    write_workbook(root / "geo.xlsx", {
        "Departamentos": [
            ["Código Deapartamento", "Nombre Departamento", "CodigoPais"],
            [5, "ANTIOQUIA", 57], [8, "ATLÁNTICO", 57], [None, "sin", 57],
        ],
        "Municipios (3)": [
            ["Código Departamento", "Nombre Departamento", "Código Municipio", "Nombre Municipio",
             "Municipio_ID"],
            [5, "A", 1, "Medellín", 5001], [8, "B", 1, "Barranquilla", 8001],
            [5, "A", 9, "   ", None], [99, "C", 1, "Lejos", 99001],
        ],
    })
    layers = Layers(spark, str(root / "lake"))
    audit = Audit(layers, "run-1")
    load(spark, layers, audit, root)
    run.build_all(layers, audit, as_of_year=2020)
    return root, data, layers, audit


def load(spark, layers, audit, root, years=(2017, 2018, 2019, 2020, 2021)):
    bronze.ingest_survey(layers, audit, str(root / "raw"), years)
    bronze.ingest_workbook(layers, audit, str(root / "geo.xlsx"))
    bronze.ingest_towns(layers, audit, lambda: towns(spark))


def test_raw_rows_and_control_table(built):
    _, data, layers, audit = built
    loads = {(r.table_name, r.survey_year): r.row_count for r in audit.yearly_loads().collect()}
    assert loads == {(m, y): len(rows) for m, years in data.items() for y, rows in years.items()}
    check = bronze.row_check(layers, ["dwelling", "member", "nothing"])
    assert check == {
        "dwelling": sum(map(len, data["dwelling"].values())),
        "member": sum(map(len, data["member"].values())),
        "nothing": None,
    }
    raw = layers.read("bronze", "dwelling")
    assert raw.filter("REGION IS NOT NULL AND survey_year = 2018").count() == 0
    assert raw.filter("P1070 = ''").count() == 0
    assert {r.source_file for r in raw.select("source_file").distinct().collect()} == {
        f"Datos_de_la_vivienda_Actualizada{y}.csv" for y in survey.YEARS
    }


def test_run_log(built, rows):
    _, data, _, audit = built
    no_amount = sum(
        row["P8610S1"] in ("n/a", "999999999999999,00")
        for years in data["education"].values() for row in years
    )
    summary = quality.run_summary(audit.runs(), "run-1").head()
    assert summary.skipped == 6  # 2021 and 2017 have no files
    assert [r.message for r in audit.runs().filter("status = 'ERROR'").collect()] == []
    assert summary.total == summary.ok + summary.skipped == 3 * 4 + 6 + 5 + 9
    assert {
        (r.table_name, r.message) for r in audit.runs().filter("status = 'OK' AND message <> ''").collect()
    } == {
        ("member", "1 rows without a full key"),
        ("education", f"{no_amount} unreadable in scholarship_amount"),
    }
    details = quality.run_details(audit.runs(), "run-1")
    assert details.filter("status = 'OK'").filter("seconds >= 0 AND rows_out > 0").count() == summary.ok


def test_geography(built, rows):
    layers = built[2]
    assert rows(layers.read("ref", "geography")) == [
        (5, "ANTIOQUIA", 5001, "Medellín", "excel"),
        (5, "ANTIOQUIA", 5002, "Abejorral", "mysql"),
        (8, "ATLÁNTICO", 8001, "Barranquilla", "excel"),
        (8, "ATLÁNTICO", 8758, "Soledad", "mysql"),
        (99, None, 99001, "Lejos", "excel"),
    ]


def test_table_shapes(built):
    layers = built[2]
    columns = {
        ("silver", "dwelling"): 28, ("silver", "member"): 25, ("silver", "education"): 23,
        ("silver", "person"): 45, ("gold", "dim_time"): 4, ("gold", "dim_location"): 3,
        ("gold", "dim_person"): 25, ("gold", "dim_dwelling"): 24, ("gold", "dim_education"): 22,
        ("gold", "fact_survey"): 22, ("gold", "kpi_scholarships_yearly"): 14,
        ("gold", "kpi_living_conditions"): 8,
    }
    assert {k: len(layers.read(*k).columns) for k in columns} == columns


def test_fact_equals_plain_python(built):
    _, data, layers, _ = built
    want = survey.expected_fact(data)
    names = {r.location_sk: r.region for r in layers.read("gold", "dim_location").collect()}
    fact = layers.read("gold", "fact_survey").collect()
    assert len(fact) == len(want)
    for r in fact:
        w = want[tuple(r[c] for c in spec.PERSON_KEY)]
        assert names.get(r.location_sk) == w["region"]
        assert (r.education_sk is not None) == w["has_record"]
        assert r.persons == 1 and r.time_sk == r.survey_year
        for c in COUNTS + AMOUNTS:
            assert r[c] == w[c], c


def test_indicators_equal_plain_python(built):
    _, data, layers, _ = built
    want = survey.expected_fact(data)
    by_year, by_place = defaultdict(Counter), defaultdict(Counter)
    for key, w in want.items():
        for target in (by_year[key[-1]], by_place[key[-1], w["region"]]):
            target["persons"] += 1
            for c in COUNTS:
                target[c] += w[c]
    kpi = {r.survey_year: r for r in layers.read("gold", "kpi_scholarships_yearly").collect()}
    before = None
    for year, w in sorted(by_year.items()):
        r = kpi[year]
        for c in ("persons", "students", "scholars", "subsidised", "credited", "supported"):
            assert r[c] == w[c]
        assert r.scholarship_pct == pytest.approx(w["scholars"] * 100 / w["students"], abs=0.0051)
        if before is None:
            assert r.scholar_growth_pct is None
        else:
            assert r.scholar_growth_pct == pytest.approx(
                (w["scholars"] - before) * 100 / before, abs=0.0051
            )
        before = w["scholars"]
    living = {
        (r.survey_year, r.region): r
        for r in layers.read("gold", "kpi_living_conditions").collect()
    }
    assert set(living) == {k for k in by_place if k[1] is not None}
    for k, r in living.items():
        assert r.persons == by_place[k]["persons"]
        assert r.persons_at_risk == by_place[k]["persons_at_risk"]
        assert r.persons_unserved == by_place[k]["persons_unserved"]


def test_ages_and_birthplaces(built):
    layers = built[2]
    person = layers.read("gold", "dim_person")
    assert person.filter("age IS NULL AND age_band IS NOT NULL").count() == 0
    assert person.filter("age = 18 AND age_band <> '18-29'").count() == 0
    assert person.filter("birth_town_code = 8001 AND birth_town = 'Barranquilla'").count() > 0
    assert person.filter("birth_town_code = 1 AND birth_town IS NOT NULL").count() == 0
    assert person.filter("birthplace IS NULL AND born_abroad").count() == 0
    assert person.filter("migrant").count() == person.filter("born_abroad OR born_elsewhere").count()
    restored = silver.member(
        bronze.read_module(layers, "member"), layers.read("ref", "geography"), null_band="60+"
    )
    assert restored.filter("age IS NULL AND age_band <> '60+'").count() == 0


def test_audits_are_clean(built):
    layers = built[2]
    assert {r.status for r in run.dimension_audit(layers).collect()} == {"OK"}
    report = {r.fk: r for r in run.fact_audit(layers).collect()}
    assert {(r.match_status, r.null_status) for r in report.values()} == {("OK", "OK")}
    assert report["education_sk"].null_rows > 0 and report["location_sk"].null_rows > 0
    assert report["person_sk"].null_rows == 0


def test_audits_find_damage(spark, rows):
    dim = spark.createDataFrame([(1,), (2,), (2,), (None,)], "sk int")
    fact = spark.createDataFrame([(1,), (3,), (3,), (None,)], "sk int")
    assert rows(quality.key_audit({"d": (dim, "sk")})) == [("d", 4, 2, 1, "ALERT")]
    assert rows(quality.referential_audit(fact, [quality.Reference("sk", dim, "sk", False)])) == [
        ("sk", 4, 2, 1, 25.0, "ALERT", "ALERT"),
    ]
    empty = fact.limit(0)
    assert rows(quality.referential_audit(empty, [quality.Reference("sk", dim, "sk", True)])) == [
        ("sk", 0, 0, 0, None, "OK", "OK"),
    ]


def test_loading_again_changes_nothing(built, spark):
    root, _, layers, _ = built

    def digest():
        return {
            t: layers.read("gold", t).select(
                F.sum(F.xxhash64(*layers.read("gold", t).columns).cast("decimal(38,0)"))
            ).head()[0]
            for t in [*run.DIMENSION_KEYS, "fact_survey", "kpi_scholarships_yearly"]
        }

    before = digest()
    audit = Audit(layers, "run-2")
    load(spark, layers, audit, root, years=[2019])
    run.build_all(layers, audit, 2020, years=[2019])
    assert digest() == before
    assert audit.yearly_loads().filter("run_id = 'run-2'").count() == 3


def test_one_year_is_kept_up_from_its_own_rows(built, spark):
    """The fact of the other years is not read again: its files are gone."""
    root, _, layers, _ = built
    gone = Layers(spark, str(root / "kept"))
    shutil.copytree(root / "lake", root / "kept")
    before = {t: sorted(map(tuple, layers.read("gold", t).collect()), key=repr) for t in ("kpi_scholarships_yearly", "kpi_living_conditions")}
    for path in (root / "kept" / "gold" / "fact_survey").glob("survey_year=*/*/*.parquet"):
        if "survey_year=2019" not in str(path):
            path.unlink()
    run.build_all(gone, Audit(gone, "run-4"), 2020, years=[2019])
    for table, rows in before.items():
        assert sorted(map(tuple, gone.read("gold", table).collect()), key=repr) == rows
    # a year that is loaded with fewer rows takes its old share away
    fact = gone.read("gold", "fact_survey").filter("survey_year = 2019").limit(5)
    sums = gold.indicator_sums(fact)
    gone.write(sums, "gold", "indicator_sums", partition_by=["survey_year"], only_partitions=True, replaces=[2019])
    kpi = {r.survey_year: r for r in gold.kpi_scholarships_yearly(gone.read("gold", "indicator_sums")).collect()}
    assert kpi[2019].persons == 5 and kpi[2018].persons > 5


def test_reports_run_over_the_star(built):
    layers = built[2]
    fact, person = layers.read("gold", "fact_survey"), layers.read("gold", "dim_person")
    assert analytics.validation_totals(fact).head().total_rows == fact.count()
    assert sum(r.persons for r in analytics.persons_by_year(fact).collect()) == fact.count()
    assert sum(r.total for r in analytics.migrant_share_by_year(person).collect()) == fact.count()


def test_serving_uses_published_names_and_counts(built, spark, tmp_path):
    layers = built[2]
    audit = Audit(layers, "run-3")
    target = Layers(spark, str(tmp_path))

    def write(df, name):
        if name == "dim_vivienda":
            raise RuntimeError("no room")
        target.write(df, "gold", name)

    names = {"fact_survey": "fac_survey"}
    done = run.serve(layers, audit, write, table_names=names)
    assert set(done.errors) == {"dim_vivienda"} and len(done.rows) == 7
    fact = target.read("gold", "fac_survey")
    assert fact.columns[:5] == [
        "directorio", "secuencia_encuesta", "secuencia_p", "orden", "sk_persona",
    ]
    assert {"monto_beca", "total_becados", "factor_expansion", "anio_encuesta"} <= set(fact.columns)
    assert "margen_cobertura_becas_pct" in target.read("gold", "kpi_becas_anuales").columns
    target.write(spark.range(1), "gold", "dim_vivienda")
    report = {
        r.table_name: r.status
        for r in run.serving_audit(
            layers, lambda n: target.read("gold", n), table_names=names
        ).collect()
    }
    assert report.pop("dim_vivienda") == "ALERT" and set(report.values()) == {"OK"}
    logged = audit.runs().filter("run_id = 'run-3'")
    assert {r.table_name for r in logged.filter("status = 'ERROR'").collect()} == {"dim_vivienda"}


def test_bad_file_is_logged_and_the_rest_goes_on(spark, tmp_path):
    survey.text(tmp_path / "raw" / "2018" / "Educación2018.csv", ["A"], [["1"]])
    layers = Layers(spark, str(tmp_path / "lake"))
    audit = Audit(layers)
    bronze.ingest_survey(layers, audit, str(tmp_path / "raw"), [2018])
    found = {r.table_name: (r.status, r.message) for r in audit.runs().collect()}
    assert found["education"][0] == "ERROR" and "DIRECTORIO" in found["education"][1]
    assert found["member"][0] == found["dwelling"][0] == "SKIPPED"
    with pytest.raises(ValueError):
        bronze.ingest_survey(layers, audit, str(tmp_path / "raw"), [2018], on_error="raise")


def test_dwelling_with_many_households_does_not_multiply(spark, rows):
    members = spark.createDataFrame(
        [("d", 1, 1, p, 2018) for p in range(3)], "dwelling_id string, household_no int, "
        "sequence_no int, person_no int, survey_year int",
    )
    homes = spark.createDataFrame(
        [("d", h, 2018, f"r{h}") for h in (3, 1, 2)],
        "dwelling_id string, household_no int, survey_year int, region string",
    )
    kept = silver.one_per_dwelling(homes)
    assert rows(kept) == [("d", 1, 2018, "r1")]
    assert members.join(kept, spec.DWELLING_KEY, "left").count() == 3


def test_malformed_rows_are_counted_and_shown(spark, tmp_path):
    folder = tmp_path / "raw" / "2018"
    folder.mkdir(parents=True)
    names = list(dict.fromkeys(f.raw for f in bronze.MODULES["member"] if f.raw != "survey_year"))
    whole = ";".join("1" for _ in names)
    lines = [";".join(names), whole, whole + ";more", whole[:-2]]
    name = bronze.manifest([2018])["member"][2018]
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
    layers = Layers(spark, str(tmp_path / "lake"))
    audit = Audit(layers)
    bronze.ingest_survey(layers, audit, str(tmp_path / "raw"), [2018])
    loaded = audit.runs().filter("status = 'OK'").select("rows_out", "message").collect()
    assert [tuple(r) for r in loaded] == [(3, "2 malformed rows")]
    shown = layers.read("bronze", "member").filter("malformed_line IS NOT NULL")
    assert {r[0] for r in shown.select("malformed_line").collect()} == set(lines[2:])


def test_references_of_an_empty_fact(spark):
    fact = spark.createDataFrame([], "a bigint, b int")
    dim = spark.createDataFrame([(1,)], "k bigint")
    found = quality.referential_audit(
        fact, [quality.Reference("a", dim, "k", False), quality.Reference("b", dim, "k", True)]
    )
    assert sorted((r.fk, r.total, r.orphans, r.null_rows, r.match_status) for r in found.collect()) == [
        ("a", 0, 0, 0, "OK"), ("b", 0, 0, 0, "OK"),
    ]
