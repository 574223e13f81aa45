"""JSON records to parquet, as a stream or in one go.

The source is passed in as a frame with a ``value`` column, so a Kafka topic and
a folder of JSON lines share the same code.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tallyframe.functions.numbers import numeric_columns, ref
from tallyframe.operators.quantiles import column_sketches
from tallyframe.sources.kafka import read_topic, stream_topic
from tallyframe.sources.records import parse_records
from tallyframe.sources.tables import survey_schema
from tallyframe.spec import SurveySpec


def stream_lines(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Lines of the files arriving in ``path`` as a streaming ``value`` column."""
    return spark.readStream.options(**options).text(path)


def topic_rows(spark: SparkSession, servers: str, topic: str, spec: SurveySpec, **options: str) -> DataFrame:
    """Survey rows of a topic as a streaming frame; ``maxOffsetsPerTrigger`` bounds a batch."""
    return parse_records(stream_topic(spark, servers, topic, **options), survey_schema(spec.columns))


@dataclass(frozen=True)
class Once:
    """What makes a record the same when it is delivered again: the values of ``key``, within ``delay`` of ``event_time``.

    A publisher that tries again sends a record twice.  The state holds the keys of records whose time is at most ``delay`` behind the latest one
    seen, and is dropped after that; so ``delay`` has to be longer than publishers try, and than records are late: one that comes
    later still is left out.
    """

    key: Sequence[str]
    event_time: str
    delay: str = "1 hour"

    def first_deliveries(self, rows: DataFrame) -> DataFrame:
        return rows.withWatermark(self.event_time, self.delay).dropDuplicatesWithinWatermark(list(self.key))


def _parsed(records: DataFrame, schema: T.StructType | str, corrupt: str | None, once: Once | None) -> DataFrame:
    rows = parse_records(records, schema, corrupt=corrupt)
    return rows if once is None else once.first_deliveries(rows)


def start_ingest(
    records: DataFrame,
    schema: T.StructType | str,
    output_path: str,
    checkpoint_path: str,
    *,
    available_now: bool = False,
    corrupt: str | None = None,
    once: Once | None = None,
) -> StreamingQuery:
    """Append parsed records to a parquet table.

    With ``once`` a record that is delivered again is stored once, also after a restart.

    ``corrupt`` names a string column of ``schema`` that keeps the text of malformed
    records, so they can be counted and read again.  The checkpoint makes a restarted query continue where the last one stopped.
    With ``available_now`` the query ends once everything present at its start
    is stored.
    """
    writer = (
        _parsed(records, schema, corrupt, once)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", output_path)
        .option("checkpointLocation", checkpoint_path)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


@contextmanager
def bounded(query: StreamingQuery, timeout_seconds: float | None = None) -> Iterator[bool]:
    """Run until ``query`` ends, or for ``timeout_seconds``; tells whether it ended. The query never outlives the block."""
    try:
        yield True if timeout_seconds is None and query.awaitTermination() is None else bool(query.awaitTermination(timeout_seconds))
    finally:
        query.stop()


def ingest(
    records: DataFrame,
    schema: T.StructType | str,
    output_path: str,
    checkpoint_path: str,
    *,
    available_now: bool = False,
    timeout_seconds: float | None = None,
    corrupt: str | None = None,
    once: Once | None = None,
) -> None:
    """Start an ingest and wait for it; ``TimeoutError`` if it takes longer than ``timeout_seconds``."""
    _wait(start_ingest(records, schema, output_path, checkpoint_path, available_now=available_now, corrupt=corrupt, once=once), timeout_seconds)


def _wait(query: StreamingQuery, timeout_seconds: float | None) -> None:
    with bounded(query, timeout_seconds) as ended:
        if not ended:
            raise TimeoutError(f"records were still arriving after {timeout_seconds} s; ingest stopped")


BATCH = "__batch"
COUNTS_SCHEMA = f"rows bigint, malformed bigint, gaps map<string,bigint>, {BATCH} bigint"


def observed(rows: DataFrame, corrupt: str | None = None) -> tuple[DataFrame, Observation]:
    """``rows`` and what their next action counts on its way: rows, malformed records, and gaps of each column.

    Cells of malformed records are not gaps.  Nothing is scanned for the counts.
    """
    counts = Observation()
    names = [c for c in rows.columns if c not in (corrupt, BATCH)]
    good = F.lit(True) if corrupt is None else ref(corrupt).isNull()
    malformed = F.count(F.lit(None)) if corrupt is None else F.count(ref(corrupt))
    gaps = [F.count_if(good & ref(c).isNull()).alias(f"gaps of {c}") for c in names]
    return rows.observe(counts, F.count(F.lit(1)).alias("rows"), malformed.alias("malformed"), *gaps), counts


def _replace_batch(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(path)


def batch_writer(
    output_path: str, counts_path: str | None = None, corrupt: str | None = None, sketches_path: str | None = None
) -> Callable[[DataFrame, int], None]:
    """Function that stores one micro-batch under its number; a batch that is run again replaces itself.

    ``counts_path`` receives what was counted while the batch was written, in the same way, and ``sketches_path`` the sketches
    of its numeric columns, from which quantiles of all batches start.
    """

    def write(rows: DataFrame, number: int) -> None:
        numbered, counts = observed(rows.withColumn(BATCH, F.lit(number).cast("long")), corrupt)
        _replace_batch(numbered, output_path)
        if sketches_path is not None:
            stored = rows.sparkSession.read.parquet(f"{output_path}/{BATCH}={number}")  # the columns are read, not parsed again
            sketches = column_sketches(stored, numeric_columns(rows))
            _replace_batch(sketches.withColumn(BATCH, F.lit(number).cast("long")), sketches_path)
        if counts_path is not None:
            seen = dict(counts.get)
            gaps = {name.removeprefix("gaps of "): n for name, n in seen.items() if name.startswith("gaps of ")}
            row = (seen["rows"], seen["malformed"], gaps, number)
            _replace_batch(rows.sparkSession.createDataFrame([row], COUNTS_SCHEMA).coalesce(1), counts_path)

    return write


def ingest_batches(
    records: DataFrame,
    schema: T.StructType | str,
    output_path: str,
    checkpoint_path: str,
    *,
    counts_path: str | None = None,
    sketches_path: str | None = None,
    available_now: bool = False,
    timeout_seconds: float | None = None,
    corrupt: str | None = None,
    once: Once | None = None,
) -> None:
    """Store parsed records batch by batch, each exactly once however often it is run; ``read_batches`` reads them."""
    writer = _parsed(records, schema, corrupt, once).writeStream.option("checkpointLocation", checkpoint_path)
    writer = writer.foreachBatch(batch_writer(output_path, counts_path, corrupt, sketches_path))
    _wait((writer.trigger(availableNow=True) if available_now else writer).start(), timeout_seconds)


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all stored batches."""
    return spark.read.parquet(path).drop(BATCH)


def batch_counts(spark: SparkSession, path: str) -> DataFrame:
    """(rows, malformed, gaps, batch): what each stored batch counted; empty before the first one."""
    try:
        return spark.read.schema(COUNTS_SCHEMA).parquet(path).withColumnRenamed(BATCH, "batch")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COUNTS_SCHEMA).withColumnRenamed(BATCH, "batch")


def ingest_topic_snapshot(
    spark: SparkSession, servers: str, topic: str, spec: SurveySpec, output_path: str, *, corrupt: str | None = None
) -> None:
    """Replace the parquet table by everything in the topic now, without a checkpoint; ``corrupt`` as for a stream."""
    schema = survey_schema(spec.columns)
    if corrupt:
        schema = T.StructType(schema.fields + [T.StructField(corrupt, T.StringType())])
    parse_records(read_topic(spark, servers, topic), schema, corrupt=corrupt).write.mode("overwrite").parquet(output_path)
