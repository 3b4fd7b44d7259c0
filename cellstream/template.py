"""All jobs of one table from its spec: capture, raw and serving landing, retention, audit."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .operators import audit, landing, months
from .spec import TableSpec
from .streaming import jobs

POSITION = ["__kafka_partition", "__kafka_offset"]


@dataclass(frozen=True)
class TableJobs:
    """A table's datasets under one folder, and its jobs.

    fields: columns of the raw dataset from topic rows; business_time: the column that serving months go by, broker time
    where it's null or there is none; raw_days and serving_days: how long rows are kept.
    """

    spec: TableSpec
    base: str
    fields: dict[str, Column]
    business_time: str | None = None
    raw_days: int = 5
    serving_days: int = 365

    def path(self, what: str) -> str:
        return f"{self.base}/{what}"

    def capture(self, entries: DataFrame) -> StreamingQuery:
        """A stream of change-log entries to row events."""
        return jobs.change_events(entries, self.spec, self.path("events"), self.path("_offsets/events"))

    def land_raw(self, topic_rows: DataFrame, now: Column) -> StreamingQuery:
        """A stream of topic rows to the raw dataset."""
        return jobs.raw(topic_rows, lambda t: landing.to_raw(t, self.fields, now), self.path("raw"), self.path("_offsets/raw"), POSITION)

    def land_serving(self, spark: SparkSession, version: Column) -> StreamingQuery:
        """New batches of the raw dataset merged into the serving dataset, one row for each position."""
        return jobs.serving(months.stream(spark, self.path("raw")), lambda t: landing.to_serving(t, self.business_time, version), self.path("serving"), self.path("_offsets/serving"), POSITION, "ver")

    def retire(self, spark: SparkSession, as_of: datetime.datetime) -> None:
        """Retention of both datasets; readers may go on meanwhile, other writers not."""
        times = [self.business_time] if self.business_time else []
        months.retire(spark, self.path("raw"), self.raw_days, as_of, ["__ingest_ts"], POSITION)
        months.retire(spark, self.path("serving"), self.serving_days, as_of, [*times, "__kafka_ts"], POSITION)

    def audit(self, spark: SparkSession) -> DataFrame:
        """Offsets of the raw dataset, by partition."""
        return audit.offset_audit(months.read(spark, self.path("raw")))
