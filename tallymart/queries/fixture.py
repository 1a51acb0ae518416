"""The given tables in the shape of survey files, and the star built from them.

A customer is a dwelling, an order a person in it, the order priority the
household, the first line of an order the education record, nations and
suppliers are towns, regions are departments, the order year is the survey
year. Values are turned into codes, so that each code list also meets unknown
codes, blanks and garbage.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import partial
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.plans import bronze, run, silver, spec
from tallymart.queries.registry import Tables
from tallymart.session import scratch_path, small_scans, storing_steps, together
from tallymart.sources.audit import Audit
from tallymart.sources.delimited import read_delimited
from tallymart.sources.tables import Layers, delete_folder, move_folder, write_file

AS_OF_YEAR = 2000
#: stands for the three raw tables of the geography
TOWNS = run.RAW_OF["geography"]
# The names of the parts of a workbook.
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_LINKS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def _text(expression: str, name: str):
    return F.expr(f"CAST({expression} AS STRING)").alias(name)


def _comma(expression: str, name: str):
    return F.expr(
        f"replace(CAST(CAST({expression} AS DECIMAL(14,2)) AS STRING), '.', ',')"
    ).alias(name)


def _person_key(t: Tables) -> DataFrame:
    """Orders with the five parts of the person key."""
    return t.orders.select(
        "*",
        _text("o_custkey", "DIRECTORIO"),
        _text("left(o_orderpriority, 1)", "SECUENCIA_ENCUESTA"),
        _text("o_orderkey div 1000000 + 1", "SECUENCIA_P"),
        _text("o_orderkey % 1000000 + 1", "ORDEN"),
        F.year("o_orderdate").alias("survey_year"),
    )


_KEY = ["DIRECTORIO", "SECUENCIA_ENCUESTA", "SECUENCIA_P", "ORDEN", "survey_year"]


def raw_dwelling(t: Tables) -> DataFrame:
    placed = (
        _person_key(t)
        .join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
        .join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
    )
    household = "CAST(left(o_orderpriority, 1) AS INT)"
    raw = placed.select(
        *_KEY,
        _text("5", "CANT_HOG_COMPLETOS"),
        _text("o_custkey % 6", "P1070"),
        _text("o_custkey % 10", "P4005"),
        _text("o_custkey % 8", "P4015"),
        _text(f"(o_custkey + {household}) % 8", "P4567"),
        _text("c_nationkey % 3", "CLASE"),
        _text(
            "CASE WHEN year(o_orderdate) = 1995 THEN '  ' "
            "WHEN o_custkey % 17 = 0 THEN '99' ELSE CAST(n_regionkey + 1 AS STRING) END",
            "REGION",
        ),
        _text("IF(c_acctbal >= 0, '1', '2')", "P8520S1"),
        _text("o_custkey % 3", "P8520S5"),
        _text(f"IF(o_custkey % 7 = 0, ' ', CAST(1 + {household} % 2 AS STRING))", "P8520S3"),
        _text("1", "P8520S4"),
        _text(f"IF((o_custkey + {household}) % 5 = 0, '1', '2')", "P4065S1"),
        _text("IF(o_custkey % 11 = 0, '1', '2')", "P4065S2"),
        _text("''", "P4065S3"),
        _text("IF(c_mktsegment = 'BUILDING' AND o_custkey % 4 = 0, '1', '2')", "P4065S4"),
        _text("o_orderkey % 3", "P1891S1"),
        _text("o_orderkey % 4", "P1891S2"),
        _text("IF(o_orderstatus = 'F', '1', '2')", "P1891S3"),
        _text("' 1'", "P1891S4"),
        _comma("o_totalprice", "FEX_C"),
    )
    return raw


def raw_member(t: Tables) -> DataFrame:
    raw = _person_key(t).select(
        *_KEY,
        _text("CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '2' ELSE '9' END", "P6020"),
        _text(
            "CASE WHEN o_orderstatus = 'P' THEN '   ' "
            "ELSE concat(' ', CAST(CAST(o_totalprice / 5000 AS INT) AS STRING), '.7') END",
            "P6040",
        ),
        _text("o_orderkey % 7", "P5502"),
        _text("o_custkey % 7", "P6080"),
        _text("o_orderkey % 11", "P1895"),
        _text("o_custkey % 11", "P1896"),
        _text("IF(o_orderkey % 13 = 0, 'abc', CAST(o_orderkey % 10 AS STRING))", "P1897"),
        _text("o_orderkey % 9", "P1898"),
        _text("IF(o_orderkey % 4 = 0, '', CAST(o_orderkey % 4 AS STRING))", "P756"),
        _text("IF(o_orderkey % 4 = 2, CAST(o_custkey % 5 AS STRING), '  ')", "P756S1"),
        _text("IF(o_orderkey % 4 = 2, CAST(o_custkey % 130 AS STRING), '  ')", "P756S2"),
        _text("concat(o_custkey, '-', left(o_orderpriority, 1))", "LLAVEHOG"),
        _comma("o_totalprice", "FEX_C"),
    )
    return raw


def raw_education(t: Tables) -> DataFrame:
    lines = t.lineitem.join(_person_key(t), F.col("o_orderkey") == F.col("l_orderkey"))
    discounted = "CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(l_discount AS DECIMAL(4,2))"
    raw = lines.select(
        *_KEY,
        _text("CASE l_returnflag WHEN 'R' THEN '1' WHEN 'A' THEN '2' ELSE ' ' END", "P6160"),
        _text("IF(l_linestatus = 'F', '1', '2')", "P8586"),
        _text("CAST(l_quantity AS INT) % 14", "P8587"),
        _text("concat(l_linenumber, '.0')", "P8587S1"),
        _text("IF(l_suppkey % 7 = 0, 'n/d', CAST(l_suppkey % 7 AS STRING))", "P6211"),
        _text("CAST(l_quantity AS INT) % 17", "P6218"),
        _text("l_linenumber % 3", "P5673"),
        _text("l_linenumber % 6", "P1101"),
        _text(
            "CASE WHEN l_returnflag = 'R' THEN '1' "
            "WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN '' ELSE '2' END",
            "P8610",
        ),
        F.expr(
            "IF(l_returnflag = 'R', "
            "replace(CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS STRING), '.', ','), ' ')"
        ).alias("P8610S1"),
        _text("IF(l_returnflag = 'R', CAST(l_suppkey % 9 AS STRING), ' ')", "P6229"),
        _text("IF(CAST(l_discount AS DECIMAL(4,2)) >= 0.05, '1', '2')", "P8612"),
        F.expr(f"replace(CAST({discounted} AS STRING), '.', ',')").alias("P8612S1"),
        _text("IF(CAST(l_tax AS DECIMAL(4,2)) >= 0.04, '1', '2')", "P8614"),
        F.expr(
            "CASE WHEN CAST(l_tax AS DECIMAL(4,2)) < 0.04 THEN NULL "
            "WHEN l_suppkey % 10 = 0 THEN '1,234,5' "
            "ELSE concat(CAST(CAST(l_quantity AS INT) AS STRING), ',5') END"
        ).alias("P8614S1"),
        _comma("l_quantity", "FEX_C"),
    )
    return raw


def raw_geography(t: Tables) -> dict[str, DataFrame]:
    departments = t.region.select(
        _text("r_regionkey", "codigo_deapartamento"),
        F.col("r_name").alias("nombre_departamento"),
        F.lit("57").alias("codigopais"),
    )
    sheet_towns = t.nation.select(
        _text("n_regionkey", "codigo_departamento"),
        F.lit("-").alias("nombre_departamento"),
        _text("n_nationkey", "codigo_municipio"),
        F.col("n_name").alias("nombre_municipio"),
        _text("IF(n_nationkey = 24, 'x', CAST(n_nationkey AS STRING))", "municipio_id"),
    )
    database_towns = t.supplier.select(
        _text("s_nationkey % 6", "codigodepartamento"),
        F.col("s_name").alias("nombremunicipio"),
        _text("s_suppkey", "municipio_id"),
    )
    return {
        "departments": departments, "sheet_towns": sheet_towns, "database_towns": database_towns,
    }


def geography(t: Tables) -> DataFrame:
    return silver.geography(**raw_geography(t))


#: headers as a person spells them; the load makes the plain names of them
_SPELLED = {
    "codigo_deapartamento": "Código Deapartamento", "nombre_departamento": "Nombre Departamento",
    "codigopais": "CodigoPais", "codigo_departamento": "Código Departamento",
    "codigo_municipio": "Código Municipio", "nombre_municipio": "Nombre Municipio", "municipio_id": "Municipio_ID",
}


def write_workbook(t: Tables, path: str) -> None:
    """The regions and nations, two fixed lists of a few rows, as sheets of a workbook."""
    raw, content = raw_geography(t), io.BytesIO()
    sheets = {bronze.DEPARTMENT_SHEET: raw["departments"], bronze.TOWN_SHEET: raw["sheet_towns"]}
    with zipfile.ZipFile(content, "w") as book:
        names, links = "", ""
        for k, (name, df) in enumerate(sheets.items(), 1):
            rows = [[_SPELLED[c] for c in df.columns], *df.collect()]
            cells = "".join(
                "<row>" + "".join(f'<c t="inlineStr"><is><t>{escape(v)}</t></is></c>' for v in row) + "</row>" for row in rows
            )
            book.writestr(f"xl/worksheets/sheet{k}.xml", f'<worksheet xmlns="{_MAIN}"><sheetData>{cells}</sheetData></worksheet>')
            names += f'<sheet name="{name}" sheetId="{k}" r:id="s{k}"/>'
            links += f'<Relationship Id="s{k}" Target="worksheets/sheet{k}.xml"/>'
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN}" xmlns:r="{_LINKS}"><sheets>{names}</sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{links}</Relationships>")
    write_file(t.spark, path, content.getvalue())


@dataclass
class _Star:
    """The star of one session and folder, as far as it is built."""

    layers: Layers
    audit: Audit
    loaded: set[str] = field(default_factory=set)
    built: set[str] = field(default_factory=set)


_stars: dict[tuple[str, str], _Star] = {}


def _begun(t: Tables) -> _Star:
    key = (t.spark.sparkContext.applicationId, t.folder)
    small_scans(t.spark)
    if key not in _stars:
        layers = Layers(t.spark, scratch_path(t.spark, "star"))
        _stars[key] = _Star(layers, Audit(layers))
    return _stars[key]


def _load(t: Tables, s: _Star, names: Sequence[str]) -> None:
    """Raw tables that are not loaded yet: survey modules, and ``TOWNS``."""
    modules = [m for m in bronze.MODULES if m in names and m not in s.loaded]
    if modules:
        load_survey(t, s.layers, s.audit, modules)
    if TOWNS in names and TOWNS not in s.loaded:
        load_towns(t, s.layers, s.audit)
    s.loaded.update(names)


def raw(t: Tables, *names: str) -> Layers:
    """The star's layers with the named raw tables loaded, whether or not the
    rest of the star is built: a query of one module does not wait for it."""
    s = _begun(t)
    _load(t, s, names)
    return s.layers


def star(t: Tables, *tables: str) -> Layers:
    """Some tables of the star and those they are made of, by default all,
    built once per session and folder, then stored.

    Reports read these tables, as they do after a pipeline run; no table is
    built for each of them again, nor are raw tables loaded again.
    """
    s = _begun(t)
    wanted = run.needed(tables or run.MADE_OF)
    if not wanted <= s.built:
        sources = {run.RAW_OF[table] for table in wanted if table in run.RAW_OF}
        _load(t, s, [n for n in (*bronze.MODULES, TOWNS) if n in sources])
        # raw rows come by year, so evening out their files moves them for nothing
        run.build_all(s.layers, s.audit, AS_OF_YEAR, rebalance=False, tables=sorted(wanted - s.built))
        s.built |= wanted
    return s.layers


#: peculiar years: one without regions, one with columns in another order, one loaded twice
NO_REGION_YEAR, OTHER_ORDER_YEAR, TWICE_YEAR = 1995, 1996, 1997


def write_survey(t: Tables, root: str, wanted: Sequence[str] = tuple(bronze.MODULES)) -> list[int]:
    """The survey as delimited text, a folder per year; returns the years.

    All years are written at once, by year; only those of the peculiar years
    are read and written once more, each with its own columns.
    """
    makers = {"dwelling": raw_dwelling, "member": raw_member, "education": raw_education}
    modules = {m: make(t) for m, make in makers.items() if m in wanted}
    years = [r[0] for r in t.orders.select(F.year("o_orderdate")).distinct().collect()]
    names = bronze.manifest(years)
    staged = {module: f"{root}/{module}" for module in modules}

    def stage(module: str) -> None:
        _write_text(modules[module], staged[module], spec.YEAR)

    def place(module: str, year: int) -> None:
        written, final = f"{staged[module]}/{spec.YEAR}={year}", f"{root}/{year}/{names[module][year]}"
        if year not in (NO_REGION_YEAR, OTHER_ORDER_YEAR):
            move_folder(t.spark, written, final)
            return
        rows = read_delimited(t.spark, written)
        if year == NO_REGION_YEAR:
            rows = rows.drop("REGION")
        if year == OTHER_ORDER_YEAR:
            rows = rows.select(*reversed(rows.columns))
        _write_text(rows, final)

    together(t.spark, [partial(stage, m) for m in modules])
    together(t.spark, [partial(place, m, y) for m in modules for y in years])
    return sorted(years)


def _write_text(rows: DataFrame, path: str, *partition_by: str) -> None:
    """Delimited text with headers; each task's file is packed and read whole."""
    rows.write.partitionBy(*partition_by).csv(
        path, sep=";", header=True, compression="gzip", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def load_survey(t: Tables, layers: Layers, audit: Audit, modules: Sequence[str]) -> None:
    """Text files of some modules, and the load that users start; what is loaded
    needs its text no more."""
    root = scratch_path(t.spark, "survey")
    with storing_steps(t.spark):
        years = write_survey(t, root, modules)
        files = {m: names for m, names in bronze.manifest(years).items() if m in modules}
        bronze.ingest_survey(layers, audit, root, years, files, on_error="raise")
        bronze.ingest_survey(layers, audit, root, [TWICE_YEAR], files, on_error="raise")
    delete_folder(t.spark, root)


def load_towns(t: Tables, layers: Layers, audit: Audit) -> None:
    """The raw geography: a workbook and the table of a database."""
    book = f"{scratch_path(t.spark, 'books')}/geography.xlsx"
    write_workbook(t, book)
    bronze.ingest_workbook(layers, audit, book, on_error="raise")
    bronze.ingest_towns(layers, audit, lambda: raw_geography(t)["database_towns"], on_error="raise")
