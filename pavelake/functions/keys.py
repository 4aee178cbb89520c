"""Event keys as text, and hash buckets that do not depend on how rows are partitioned."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def record_key(vehicle: str = "vehicle_id", ts: str = "event_ts") -> Column:
    """Readable key. Joins compare the two typed columns instead."""
    return F.concat_ws("|", F.col(vehicle), F.date_format(F.col(ts), "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def with_record_key(df: DataFrame) -> DataFrame:
    return df.withColumn("record_key", record_key())


def hash_bucket(key: Column, buckets: int = 10) -> Column:
    """First 32 bits of the md5 of ``key``, modulo ``buckets``."""
    head = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(buckets)).cast("int")


def event_bucket(buckets: int = 10, vehicle: str = "vehicle_id", ts: str = "event_ts") -> Column:
    return hash_bucket(F.concat_ws("|", F.col(vehicle), F.unix_micros(F.col(ts)).cast("string")), buckets)
