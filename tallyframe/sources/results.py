"""Model metrics and run log as JSON tables."""

from __future__ import annotations

import time
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from tallyframe.operators.metrics import METRIC_NAMES, METRICS_SCHEMA, best_model
from tallyframe.sources.versions import current_folder, replace

# The field names are an outside format that readers of the log rely on.
# Undefined values leave the library as null, which JSON omits, never as NaN.
RUN_LOG_SCHEMA = (
    "status string, started_at_utc string, finished_at_utc string, duration_seconds double, "
    "parameters map<string,string>, model_count int, models array<string>, "
    "best_model struct<model:string," + ",".join(f"{n}:double" for n in METRIC_NAMES) + ">, "
    "step_durations_seconds map<string,double>, error_message string, counts map<string,bigint>"
)


def save_metrics(metrics: DataFrame, path: str) -> None:
    """Replace the metrics at ``path`` by those of all models and the best one of them, both at once."""
    spark = metrics.sparkSession

    def write(folder: str) -> None:
        metrics.write.json(f"{folder}/all")
        best_model(spark.read.schema(METRICS_SCHEMA).json(f"{folder}/all")).write.json(f"{folder}/best")

    replace(spark, path, write)


def best_path(path: str) -> str:
    """Address of the best model's metrics beside those of all models."""
    return f"{path.rstrip('/')}#best"


def load_metrics(spark: SparkSession, path: str) -> DataFrame:
    place, _, part = path.partition("#")
    folder = current_folder(spark, place)
    if folder is None:
        raise FileNotFoundError(f"no metrics at {place}")
    return spark.read.schema(METRICS_SCHEMA).json(f"{folder}/{part or 'all'}")


@dataclass
class RunRecord:
    """What one run did; filled while it runs, appended to the log when it ends."""

    parameters: Mapping[str, str | None] = field(default_factory=dict)
    status: str = "failed"
    models: list[str] = field(default_factory=list)
    best_model: dict | None = None
    steps: dict[str, float] = field(default_factory=dict)
    error_message: str | None = None
    counts: dict[str, int] = field(default_factory=dict)

    @contextmanager
    def step(self, name: str) -> Iterator[None]:
        start = time.perf_counter()
        try:
            yield
        finally:
            self.steps[name] = round(time.perf_counter() - start, 4)

    def skip(self, name: str) -> None:
        self.steps[name] = 0.0

    def counted(self, prefix: str, counts: Mapping[str, int]) -> None:
        """Keep counts that a step made on its way, such as those of an ``Observation``."""
        self.counts |= {f"{prefix}.{name}": int(n) for name, n in counts.items()}

    def models_compared(self, metrics: DataFrame) -> None:
        """Take names and best model from a ranked metrics table, one row per model."""
        rows = [r.asDict() for r in metrics.collect()]
        self.models = [r["model"] for r in rows]
        self.best_model = rows[0] if rows else None


@contextmanager
def recorded_run(spark: SparkSession, path: str, parameters: Mapping[str, object]) -> Iterator[RunRecord]:
    """Append one record to the run log at ``path``, whether the block succeeds, raises or is interrupted.

    Absent parameters are null.  If the block raises and the log cannot be written either, the first error is the one raised.
    """
    record = RunRecord({k: None if v is None else str(v) for k, v in parameters.items()})
    started, clock = datetime.now(timezone.utc), time.perf_counter()

    def append() -> None:
        row = (
            record.status,
            started.isoformat(),
            datetime.now(timezone.utc).isoformat(),
            round(time.perf_counter() - clock, 4),
            dict(record.parameters),
            len(record.models),
            record.models,
            record.best_model,
            record.steps,
            record.error_message,
            record.counts,
        )
        spark.createDataFrame([row], RUN_LOG_SCHEMA).write.mode("append").json(path)

    try:
        yield record
    except BaseException as error:
        record.error_message = str(error) or type(error).__name__
        try:
            append()
        except Exception as second:
            error.add_note(f"the run log could not be written: {second}")
        raise
    record.status = "success"
    append()


def load_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG_SCHEMA).json(path)
