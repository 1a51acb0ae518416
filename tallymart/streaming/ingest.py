"""Load of survey files as they arrive, into the same tables as the batch load.

The batch load names the years to read. This one keeps its own record of the
files it has read, in ``checkpoint``, so each file is read once however often
it runs. Each batch becomes a version of the table, and the version notes its
number: a batch that is sent again, as after a failure between the write and
the record, finds itself noted and adds nothing.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallymart.operators.project import blank_to_null, with_lineage
from tallymart.sources import versions
from tallymart.sources.delimited import read_delimited


def ingest_new_files(
    spark: SparkSession,
    folder: str,
    year: int,
    target: str,
    checkpoint: str,
    run_id: str,
    delimiter: str = ";",
    stream: str | None = None,
) -> StreamingQuery:
    """Append the files of one module and year that were not loaded before to
    the versioned table at ``target``, whoever began it.

    All files must share one header; a file with another one stops the load.
    Reads what is there and ends. ``stream`` names the load in the table's
    ledger, by default the checkpoint's folder. A load that starts with another
    record of files than the table knows under that name stops, as its batches
    hold other files: give it a new name, and it loads every file there is. A
    batch load that replaces the year also replaces what was streamed into it.
    """
    header = read_delimited(spark, folder, delimiter).schema
    lines = spark.readStream.schema(header).csv(
        folder, sep=delimiter, header=True, encoding="UTF-8", enforceSchema=False
    )
    raw = with_lineage(blank_to_null(lines.select("*", "_metadata")), "blob_csv", year, run_id)
    name = stream or checkpoint.rstrip("/")

    def append(batch: DataFrame, number: int) -> None:
        # the record's own id, which a new one does not share
        own = json.loads(versions.file_text(spark, f"{checkpoint}/metadata"))["id"]
        now = versions.current(spark, target)
        if now and any(b.startswith(f"{name}#") and b != f"{name}#{own}" for b in now.batches):
            raise ValueError(f"stream {name} has lost its record {checkpoint}")
        versions.write(batch, target, "append", "survey_year", batch=(f"{name}#{own}", number))

    return (
        raw.drop("_metadata").writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
