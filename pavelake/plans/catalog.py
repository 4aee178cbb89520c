"""Names in the session's catalog for the tables of a lake, so that they can be asked in SQL.

Tables that a stream appends to are external tables over their folders; Spark reads those through the sink's commit log.
Tables made of numbered batches or of dates have their partitions in the catalog, only committed ones, so a query lists
no folders and sees no half-written batch. Tables replaced as a whole are views of their newest version. Nothing is
copied, and dropping a name deletes no data. One database belongs to one lake.

With a metastore (``--hive``) other sessions see the names too; a session that has read a table asks
``REFRESH TABLE`` to see later commits.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import DataType, DateType, LongType, StringType, StructType

from pavelake.config import LakeConfig
from pavelake.plans.publish import SCHEMAS as HOURLY_SCHEMAS
from pavelake.plans.publish import WINDOW_DATE, hourly_table
from pavelake.schemas import BRONZE, FACT, PREDICTIONS, SILVER, VALIDATED
from pavelake.sources.tables import BATCH, VERSION, ensure_folder, has_files, list_versions, subfolders
from pavelake.streaming.dimensions import BATCH_COLUMN
from pavelake.streaming.dimensions import SCHEMAS as DIMENSION_SCHEMAS

LOGGED, PARTITIONS, VERSIONS, PLAIN = "logged", "partitions", "versions", "plain"


@dataclass(frozen=True)
class Named:
    """What is asked by ``name``: the folder it lies in, its columns, and the query whose batches change it."""

    name: str
    folder: str
    columns: StructType | None
    kind: str
    query: str = ""
    partition: tuple[tuple[str, DataType], ...] = ()

    @property
    def table(self) -> str:
        """Name of the external table; what has more columns than are asked lies behind a view."""
        return f"{self.name}_files" if self.kind == PARTITIONS else self.name


def names(cfg: LakeConfig) -> list[Named]:
    by_date = (("event_date", DateType()),)
    found = [
        Named("bronze", "bronze", BRONZE, LOGGED, "bronze"),
        Named("silver", "silver", SILVER, LOGGED, "silver"),
        Named("fact", "fact", FACT, LOGGED, "fact", by_date),
        Named("predictions", "predictions", PREDICTIONS, LOGGED, "predictions", by_date),
        Named("model_runs", "model_runs", None, PLAIN),
        Named("late_rows", "late_rows", None, PLAIN),
    ]
    verdict = ("dq_flag", StringType())
    if cfg.route_late:
        found.append(Named("silver_validated", "silver_routed", VALIDATED, PARTITIONS, "silver_routed",
                           ((BATCH_COLUMN, LongType()), verdict)))
    else:
        found.append(Named("silver_validated", "silver_validated", VALIDATED, LOGGED, "silver_validated", (verdict,)))
    for name, columns in DIMENSION_SCHEMAS.items():
        found.append(Named(name, name, columns, PARTITIONS, "dimensions", ((BATCH_COLUMN, LongType()),)))
    for name, columns in HOURLY_SCHEMAS.items():
        folder = hourly_table(cfg, name)
        kind = {"dates": PARTITIONS, "complete": VERSIONS, "append": LOGGED}[cfg.hourly_mode]
        dates = ((WINDOW_DATE, DateType()),) if kind == PARTITIONS else ()
        found.append(Named(name, folder, columns, kind, folder, dates))
    return found


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _listed(columns: StructType) -> str:
    return ", ".join(f"`{c}`" for c in columns.fieldNames())


def _create(spark: SparkSession, cfg: LakeConfig, database: str, named: Named) -> None:
    """The external table. Delta tables know their own columns and partitions."""
    path = cfg.table(named.folder)
    shape = ""
    if named.columns is not None and cfg.table_format != "delta":
        ensure_folder(spark, path)
        partition = dict(named.partition)
        columns = [f"`{c.name}` {c.dataType.simpleString()}" for c in named.columns if c.name not in partition]
        columns += [f"`{name}` {kind.simpleString()}" for name, kind in partition.items()]
        shape = f"({', '.join(columns)})"
    by = f"PARTITIONED BY ({', '.join(name for name, _ in named.partition)})" if shape and named.partition else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{named.table} {shape} USING {cfg.table_format} {by} "
              f"LOCATION {_literal(path)}")


def _add_partitions(spark: SparkSession, cfg: LakeConfig, database: str, named: Named) -> None:
    """Partitions that are committed and not in the catalog so far."""
    table, path = f"{database}.{named.table}", cfg.table(named.folder)
    first = named.partition[0][0]
    if first == BATCH_COLUMN:
        committed = [f"{BATCH}{n}" for n in list_versions(spark, path, BATCH)]
    else:
        committed = subfolders(spark, path, f"{first}=")
    known = {row.partition for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    if len(named.partition) > 1:
        settled = {spec.split("/")[0] for spec in known}
        second = named.partition[1][0]
        committed = [f"{batch}/{inner}" for batch in committed if batch not in settled
                     for inner in subfolders(spark, f"{path}/{batch}", f"{second}=")]
    kinds = dict(named.partition)
    new = []
    for spec in committed:
        if spec not in known:
            pairs = (part.split("=", 1) for part in spec.split("/"))
            new.append(", ".join(f"{k} = {v if isinstance(kinds[k], LongType) else _literal(v)}" for k, v in pairs))
    if new:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(f'PARTITION ({spec})' for spec in new)}")


def _register(spark: SparkSession, cfg: LakeConfig, database: str, named: Named) -> None:
    path, delta = cfg.table(named.folder), cfg.table_format == "delta"
    if (named.kind == PLAIN or delta) and not has_files(spark, path):
        return  # no columns are known before the first row
    if named.kind == VERSIONS and not delta:
        versions = list_versions(spark, path)
        if versions:
            newest = f"{path}/{VERSION}{versions[-1]}".replace("`", "``")
            spark.sql(f"CREATE OR REPLACE VIEW {database}.{named.name} AS "
                      f"SELECT {_listed(named.columns)} FROM {cfg.table_format}.`{newest}`")
        return
    if not spark.catalog.tableExists(f"{database}.{named.table}"):
        _create(spark, cfg, database, named)
    if named.kind == PARTITIONS and not delta:
        _add_partitions(spark, cfg, database, named)
    spark.catalog.refreshTable(f"{database}.{named.table}")
    if named.table != named.name:
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{named.name} AS "
                  f"SELECT {_listed(named.columns)} FROM {database}.{named.table}")


def register(spark: SparkSession, cfg: LakeConfig, database: str, query: str | None = None) -> list[str]:
    """Name all tables of the lake, or those that one query writes, and show what was committed since; gives the names
    that can be asked. Repeating it changes nothing."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    wanted = [named for named in names(cfg) if query is None or named.query == query]
    for named in wanted:
        _register(spark, cfg, database, named)
    if any(named.name == "silver_validated" for named in wanted):
        if spark.catalog.tableExists(f"{database}.silver_validated"):
            spark.sql(f"CREATE OR REPLACE VIEW {database}.silver_rejected AS "
                      f"SELECT * FROM {database}.silver_validated WHERE dq_flag = 'REJECTED'")
    return sorted(table.name for table in spark.catalog.listTables(database))


class Names(StreamingQueryListener):
    """Keeps the names up to date while a job runs: after a micro-batch, those of the tables its query writes."""

    def __init__(self, spark: SparkSession, cfg: LakeConfig, database: str):
        self._spark, self._cfg, self._database = spark, cfg, database

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if event.progress.numInputRows:
            register(self._spark, self._cfg, self._database, event.progress.name)

    def onQueryTerminated(self, event) -> None:
        pass
