"""What became of rows the watermark turned away.

Rejected rows are split off before the watermark, so a late row is in neither output table. It can
still be found: a clean row whose key never reached the clean table was late, since every other
clean row either is there or is a copy of one that is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from pavelake.config import EVENT_KEY

LATE_EVENT = "LATE_EVENT"
LATE_ROWS = "query_name string, query_id string, batch_id long, reported_at string, late_rows long"


def late_rows(passed: DataFrame, silver: DataFrame, keys: Sequence[str] = EVENT_KEY) -> DataFrame:
    """Rows of ``passed`` (all that passed validation) that the watermark kept out of ``silver``."""
    return passed.join(silver.select(*keys), list(keys), "left_anti").select(*passed.columns)


def as_rejected(late: DataFrame) -> DataFrame:
    """Late rows in the shape of the rejected table."""
    return late.withColumns({"invalid_reason": F.lit(LATE_EVENT), "dq_flag": F.lit("REJECTED")})


class LateRows(StreamingQueryListener):
    """Counts the rows that watermarks turn away, of all queries of a session, from every progress report.

    Attach it with ``spark.streams.addListener`` before the queries start. With a path, each report that has late
    rows is also appended to a table there, which outlives the application.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, fmt: str = "parquet"):
        self._spark, self._path, self._format = spark, path, fmt
        self.counts: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        late = sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)
        self.counts[str(progress.id)] = self.counts.get(str(progress.id), 0) + late
        if late and self._path:
            row = [(progress.name, str(progress.id), progress.batchId, progress.timestamp, late)]
            frame = self._spark.createDataFrame(row, LATE_ROWS)
            frame.coalesce(1).write.format(self._format).mode("append").save(self._path)

    def onQueryTerminated(self, event) -> None:
        pass

    def of(self, query: StreamingQuery) -> int:
        return self.counts.get(str(query.id), 0)


def read_late_rows(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Late rows per query. A batch that was repeated after a failure counts once."""
    told = spark.read.format(fmt).load(path).groupBy("query_name", "query_id", "batch_id").agg(F.max("late_rows").alias("n"))
    return told.groupBy("query_name", "query_id").agg(F.sum("n").alias("late_rows"))
