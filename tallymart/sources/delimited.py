"""Survey files: delimited text, one file or folder per module and year."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallymart.operators.project import blank_to_null, with_lineage


#: whole line of a row with more or fewer cells than the header
MALFORMED = "malformed_line"


def read_delimited(
    spark: SparkSession, path: str, delimiter: str = ";", malformed: bool = False
) -> DataFrame:
    """A delimited file with a header, all columns as text, nothing inferred.

    A record never spans lines, so Spark splits large files between tasks. All
    files under ``path`` must share one header; one that differs raises, so does
    one with empty or repeated names. A row with too few cells has NULLs, one with too many loses the rest; with
    ``malformed`` such rows have their whole line in ``malformed_line``.
    """
    reader = spark.read.options(
        sep=delimiter,
        header=True,
        encoding="UTF-8",
        inferSchema=False,
        enforceSchema=False,
        mode="PERMISSIVE",
        multiLine=False,
    )
    plain = reader.csv(path)
    if not malformed:
        return plain
    schema = T.StructType([*plain.schema.fields, T.StructField(MALFORMED, T.StringType())])
    return reader.option("columnNameOfCorruptRecord", MALFORMED).schema(schema).csv(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path (or glob) is there; nothing below it is listed.

    Only a missing path gives FALSE; no access or an unknown file system raise.
    """
    wanted = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = wanted.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(system.globStatus(wanted))


@dataclass(frozen=True)
class SurveyFile:
    """One module in one year, and whether its file is there."""

    module: str
    year: int
    path: str
    present: bool


def listing(spark: SparkSession, root: str) -> DataFrame:
    """(year, name) of what lies in the year folders of ``root``, from one listing."""
    wanted = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/*/*")
    system = wanted.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath() for s in system.globStatus(wanted) or []]
    rows = [(p.getParent().getName(), p.getName()) for p in found]
    return spark.createDataFrame([(y, n) for y, n in rows if not n.startswith((".", "_"))], "year string, name string")


def manifest_rows(spark: SparkSession, manifest: Mapping[str, Mapping[int, str]], years: Sequence[int]) -> DataFrame:
    """(module, year, name) of the wanted years; one the manifest lacks is left out."""
    rows = [(m, y, files[y]) for m, files in manifest.items() for y in years if y in files]
    return spark.createDataFrame(rows, "module string, year int, name string")


def missing_files(wanted: DataFrame, there: DataFrame) -> DataFrame:
    """The rows of the manifest whose file the listing lacks."""
    on = (wanted["year"].cast("string") == there["year"]) & (wanted["name"] == there["name"])
    return wanted.join(there, on, "left_anti")


def resolve(
    spark: SparkSession,
    root: str,
    manifest: Mapping[str, Mapping[int, str]],
    years: list[int],
) -> list[SurveyFile]:
    """The files of the wanted years, and whether they are there, from one
    listing of the folder; a year the manifest lacks is left out."""
    wanted = manifest_rows(spark, manifest, years)
    missing = {(r.module, r.year) for r in missing_files(wanted, listing(spark, root)).collect()}
    return [
        SurveyFile(module, year, f"{root.rstrip('/')}/{year}/{files[year]}", (module, year) not in missing)
        for module, files in manifest.items() for year in years if year in files
    ]


def raw_module(spark: SparkSession, file: SurveyFile, run_id: str) -> DataFrame:
    """One file as a raw table: text, blanks as NULL, lineage columns."""
    return with_lineage(
        blank_to_null(read_delimited(spark, file.path, malformed=True)),
        origin="blob_csv",
        year=file.year,
        run_id=run_id,
        source_file=file.path.rsplit("/", 1)[-1],
    )


def union_years(frames: list[DataFrame]) -> DataFrame:
    """Stack years by column name; a column some year lacks is NULL there.

    Each file is read on its own first: reading several paths at once would
    match their columns by position.
    """
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
