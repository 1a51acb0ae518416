"""What ran, when, how it ended; which year of which table is loaded."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.operators.dedupe import keep_first
from tallymart.sources import versions
from tallymart.sources.tables import Layers

RUNS_SCHEMA = (
    "run_id string, step string, layer string, table_name string, "
    "rows_in bigint, rows_out bigint, status string, message string, "
    "started_at timestamp, ended_at timestamp, seconds double"
)
LOADS_SCHEMA = (
    "survey_year int, table_name string, row_count bigint, loaded_at timestamp, run_id string"
)


def _now() -> datetime:
    return datetime.now(timezone.utc)


def new_run_id() -> str:
    return str(uuid.uuid4())


SCHEMAS = {"pipeline_runs": RUNS_SCHEMA, "yearly_load_log": LOADS_SCHEMA}
#: appended files of a log above which they are merged into one
MERGED_FROM = 16


class Audit:
    """Append-only logs of one run.

    Within ``recording`` rows are held on the driver, one for each step, and
    written together at its end, however it ends: one file for each log.
    Outside of it a row is written at once. Many files become one behind a new
    version of the log.

    Row counts are taken from the stored tables, not from metrics of the write:
    a task that runs again after a lost executor would be counted twice.
    """

    def __init__(self, layers: Layers, run_id: str | None = None):
        self.layers = layers
        self.spark: SparkSession = layers.spark
        self.run_id = run_id or new_run_id()
        self._turn = threading.RLock()
        self._held: dict[str, list[tuple]] = {table: [] for table in SCHEMAS}
        self._open = 0

    @contextmanager
    def recording(self) -> Iterator[Audit]:
        """Hold the rows of the steps inside; write them when the outermost one ends."""
        with self._turn:
            self._open += 1
        try:
            yield self
        finally:
            with self._turn:
                self._open -= 1
                if not self._open:
                    self.flush()

    def flush(self) -> None:
        """Write the rows that are held."""
        with self._turn:
            for table, rows in self._held.items():
                if rows:
                    frame = self.spark.createDataFrame(rows, SCHEMAS[table]).coalesce(1)
                    self.layers.write(frame, "audit", table, mode="append")
                    rows.clear()
                    self._merge(table)

    def _merge(self, table: str) -> None:
        now = versions.current(self.spark, self.layers.path("audit", table))
        if len(now.folders) > MERGED_FROM:
            self.layers.write(self.layers.read("audit", table).coalesce(1), "audit", table)

    def log(
        self,
        step: str,
        layer: str,
        table: str,
        started_at: datetime,
        rows_in: int,
        rows_out: int,
        status: str,
        message: str = "",
    ) -> None:
        """Append one row to the run log."""
        ended_at = _now()
        row = (
            self.run_id, step, layer, table, rows_in, rows_out, status, message,
            started_at, ended_at, (ended_at - started_at).total_seconds(),
        )
        self._hold(row, "pipeline_runs")

    def loaded(self, table: str, year: int, row_count: int) -> None:
        """Note that a year is loaded; the latest note per table and year counts."""
        row = (year, table, row_count, _now(), self.run_id)
        self._hold(row, "yearly_load_log")

    def _hold(self, row: tuple, table: str) -> None:
        with self._turn:
            self._held[table].append(row)
            if not self._open:
                self.flush()

    def _read(self, table: str) -> DataFrame:
        self.flush()
        if not self.layers.exists("audit", table):
            return self.spark.createDataFrame([], SCHEMAS[table])
        return self.layers.read("audit", table)

    def create_tables(self, prefix: str) -> None:
        """Make both logs known to SQL, empty ones too, with their types."""
        for table, schema in SCHEMAS.items():
            if not self.layers.exists("audit", table):
                self.layers.write(self.spark.createDataFrame([], schema), "audit", table)
        self.layers.register(prefix)

    def runs(self) -> DataFrame:
        """The run log."""
        return self._read("pipeline_runs")

    def yearly_loads(self) -> DataFrame:
        """One row per table and year, as last loaded."""
        log = self._read("yearly_load_log")
        return keep_first(
            log, ["table_name", "survey_year"], [F.desc("loaded_at")]
        ).orderBy("table_name", "survey_year")

    def step(
        self,
        step: str,
        layer: str,
        table: str,
        work: Callable[[], tuple],
        on_error: str = "raise",
    ) -> bool:
        """Run ``work`` and log the outcome.

        ``work`` returns rows in, rows out and, if there is one, a remark.
        ``on_error`` is ``raise``, or ``skip`` to go on with the next table.
        """
        started_at = _now()
        try:
            rows_in, rows_out, *remark = work()
        except Exception as error:
            self.log(step, layer, table, started_at, 0, 0, "ERROR", str(error))
            if on_error == "raise":
                raise
            return False
        self.log(step, layer, table, started_at, rows_in, rows_out, "OK", *remark)
        return True

    def skipped(self, step: str, layer: str, table: str, message: str) -> None:
        self.log(step, layer, table, _now(), 0, 0, "SKIPPED", message)
