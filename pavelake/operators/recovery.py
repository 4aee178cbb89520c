"""What the raw table's schema loses: values of another type than declared, and keys it does not name.

The payload text is kept, so both can be had back. It is read as VARIANT, which keeps every value with its own type.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pavelake.config import QualityLimits
from pavelake.functions.casting import lenient_int
from pavelake.functions.lookup import lookup
from pavelake.operators.quality import OK, validate
from pavelake.schemas import BRONZE, PAYLOAD

WHOLE_FIELDS = tuple(f.name for f in PAYLOAD if f.dataType.simpleString() == "int")
# Kinds of values by the first word of their VARIANT types.
KINDS = {"OBJECT": "object", "ARRAY": "list", "STRING": "text", "BOOLEAN": "boolean", "VOID": "null", "BIGINT": "whole",
         "DECIMAL": "fraction", "DOUBLE": "fraction"}


def recovered_values(rows: DataFrame) -> DataFrame:
    """Rows of the raw table's columns with NULL integers filled from the payload text, and ``recovered``, the names of
    the fields that were.

    A number in quotes or with a fraction is read by the rule for speeds: its whole part counts. Values that are there
    stay; text that is no JSON, and values that hold no number, recover nothing.
    """
    payload = F.try_parse_json("raw_json")
    told = rows.select("*", F.inline(F.array(F.struct(
        *(lenient_int(F.try_variant_get(payload, f"$.{name}", "string")).alias(f"_{name}") for name in WHOLE_FIELDS)))))
    filled = {name: F.coalesce(name, f"_{name}") for name in WHOLE_FIELDS}
    gained = F.array_compact(F.array(*(
        F.when(F.col(name).isNull() & F.col(f"_{name}").isNotNull(), F.lit(name)) for name in WHOLE_FIELDS)))
    return told.withColumn("recovered", gained).withColumns(filled).drop(*(f"_{name}" for name in WHOLE_FIELDS))


def rejudged(rejected: DataFrame, limits: QualityLimits = QualityLimits(), now: Column | datetime | None = None) -> DataFrame:
    """Rejected rows of which some value could be recovered, judged again.

    ``former_reason`` is why a row was rejected, ``recovered`` what was found, ``passes`` whether it is clean now; all
    other columns are those of the new judgement.
    """
    raw = rejected.select(*BRONZE.fieldNames(), F.col("invalid_reason").alias("former_reason"))
    again = validate(recovered_values(raw).where(F.size("recovered") > 0), limits, now)
    return again.withColumn("passes", F.col("dq_flag") == OK)


def kind_of(value: Column) -> Column:
    """Kind of a VARIANT value."""
    return F.coalesce(lookup(F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0), KINDS, None), F.lit("other"))


def drift(bronze: DataFrame) -> DataFrame:
    """(key, kind, expected, row_count, first_arrival, last_arrival) of payload keys that the schema does not name, and of
    named ones whose values are of another kind than declared.

    ``expected`` is the declared kind, NULL for a key without one. A number is welcome where text is declared, as it is
    kept as its text; null stands for a missing value. Counts combine before the only shuffle, and the result has a row
    for each key and kind.
    """
    spark = bronze.sparkSession
    payload = bronze.select(F.try_parse_json("raw_json").alias("payload"), "kafka_timestamp")
    each = payload.lateralJoin(spark.tvf.variant_explode(F.col("payload").outer())).select("key", "value", "kafka_timestamp")
    # kinds leave through a generator, below which no test on them is pushed
    kinds = each.where("key IS NOT NULL").select("kafka_timestamp", F.inline(F.array(F.struct("key", kind_of(F.col("value")).alias("kind")))))
    counted = kinds.groupBy("key", "kind").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("kafka_timestamp").alias("first_arrival"), F.max("kafka_timestamp").alias("last_arrival"))
    declared = {f.name: "whole" if f.name in WHOLE_FIELDS else "text" for f in PAYLOAD}
    told = counted.withColumn("expected", lookup(F.col("key"), declared, None))
    as_text = (F.col("expected") == "text") & F.col("kind").isin("whole", "fraction")
    fits = F.col("expected").isNotNull() & ((F.col("kind") == "null") | (F.col("kind") == F.col("expected")) | as_text)
    return told.where(~fits).select("key", "kind", "expected", "row_count", "first_arrival", "last_arrival")
