"""Raw tables: survey files, geography sheets, the town database."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.functions.naming import find_column
from tallymart.operators.project import (
    Field, blank_to_null, normalize_names, stringify, with_lineage,
)
from tallymart.plans import spec
from tallymart.session import small_scans, together
from tallymart.sources.audit import Audit
from tallymart.sources.delimited import MALFORMED, SurveyFile, raw_module, resolve
from tallymart.sources.tables import Layers
from tallymart.sources.workbook import read_sheets

MODULES: dict[str, Sequence[Field]] = {
    "member": spec.MEMBER,
    "dwelling": spec.DWELLING,
    "education": spec.EDUCATION,
}

# The names under which the survey's files are published.
FILE_STEMS = {
    "member": "Caracteristicas_y_composicion_del_hogar",
    "dwelling": "Datos_de_la_vivienda_Actualizada",
    "education": "Educación",
}
DEPARTMENT_SHEET = "Departamentos"
TOWN_SHEET = "Municipios (3)"
TOWN_TABLE = "municipios"


def manifest(years: Sequence[int]) -> dict[str, dict[int, str]]:
    """File name per module and year; names follow from stem and year."""
    return {m: {y: f"{stem}{y}.csv" for y in years} for m, stem in FILE_STEMS.items()}


def raw_schema(fields: Sequence[Field]) -> T.StructType:
    """The variables a module is read for, all text, and the year.

    Reading the raw table with it gives NULL for variables a year lacks, and
    neither opens every file for its schema nor reads variables no one uses.
    """
    names = {f.raw: None for f in fields if f.raw != spec.YEAR}
    return T.StructType([
        *[T.StructField(n, T.StringType()) for n in names],
        T.StructField(spec.YEAR, T.IntegerType()),
    ])


def read_module(layers: Layers, module: str, years: Sequence[int] | None = None) -> DataFrame:
    """The stored raw table of a module, some years or all."""
    small_scans(layers.spark)
    df = layers.read("bronze", module, raw_schema(MODULES[module]))
    return df.filter(F.col(spec.YEAR).isin(list(years))) if years else df


def _require(df: DataFrame, fields: Sequence[Field]) -> None:
    lacking = [f.raw for f in fields if f.required and not find_column(df, f.raw)]
    if lacking:
        raise ValueError(f"required columns are missing: {', '.join(lacking)}")


def ingest_survey(
    layers: Layers,
    audit: Audit,
    root: str,
    years: Sequence[int],
    files: Mapping[str, Mapping[int, str]] | None = None,
    on_error: str = "skip",
) -> None:
    """Load every module and year into its raw table: the modules at once, each
    a year at a time.

    A year that is loaded again replaces itself. A missing file is logged as
    skipped; a file that fails is logged and, by default, the next one goes on.
    Rows with more or fewer cells than the header stay, with their whole line
    in ``malformed_line``, and the log tells how many there are.
    """
    found = resolve(layers.spark, root, files or manifest(years), list(years))

    def load(file: SurveyFile) -> tuple[int, int, str]:
        raw = raw_module(layers.spark, file, audit.run_id)
        _require(raw, MODULES[file.module])
        stored = layers.write(
            raw, "bronze", file.module, partition_by=[spec.YEAR], only_partitions=True,
            replaces=[file.year],
        ).filter(F.col(spec.YEAR) == file.year)
        rows, malformed = stored.agg(F.count("*"), F.count(MALFORMED)).head()
        audit.loaded(file.module, file.year, rows)
        return rows, rows, f"{malformed} malformed rows" if malformed else ""

    def load_module(module: str) -> None:
        for file in found:
            if file.module != module:
                continue
            if file.present:
                audit.step("bronze", "bronze", module, partial(load, file), on_error)
            else:
                audit.skipped("bronze", "bronze", module, f"no file {file.path}")

    modules = dict.fromkeys(f.module for f in found)
    with audit.recording():
        together(layers.spark, [partial(load_module, m) for m in modules])


def _store_reference(
    layers: Layers, audit: Audit, table: str, df: DataFrame, origin: str, source: str
) -> tuple[int, int]:
    traced = with_lineage(df, origin, 0, audit.run_id, source)
    rows = layers.write(traced, "bronze", table).count()
    return rows, rows


def ingest_workbook(
    layers: Layers, audit: Audit, path: str, on_error: str = "skip"
) -> None:
    """Load the department and the town sheet, parsing each workbook once."""
    sheets = {"departments": DEPARTMENT_SHEET, "sheet_towns": TOWN_SHEET}
    found: dict[str, DataFrame] = {}

    def load(table: str, sheet: str) -> tuple[int, int]:
        if not found:
            found.update(read_sheets(layers.spark, path, list(sheets.values())))
        df = blank_to_null(normalize_names(found[sheet]))
        source = f"{path.rsplit('/', 1)[-1]}#{sheet}"
        return _store_reference(layers, audit, table, df, "excel", source)

    with audit.recording():
        for table, sheet in sheets.items():
            audit.step("bronze", "bronze", table, partial(load, table, sheet), on_error)


def ingest_towns(
    layers: Layers, audit: Audit, towns, on_error: str = "skip", source: str = TOWN_TABLE
) -> None:
    """Load the town table of a database; ``towns`` is called for its frame."""

    def load() -> tuple[int, int]:
        df = stringify(normalize_names(towns()))
        return _store_reference(layers, audit, "database_towns", df, "mysql", source)

    audit.step("bronze", "bronze", "database_towns", load, on_error)


def row_check(layers: Layers, tables: Sequence[str]) -> dict[str, int | None]:
    """Rows per raw table; None for one that is not there."""
    found = {t: layers.read_optional("bronze", t) for t in tables}
    return {t: None if df is None else df.count() for t, df in found.items()}
