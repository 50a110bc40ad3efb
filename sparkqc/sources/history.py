"""The accumulated table of deliveries as a set of rows that grows.

``rows/`` holds every distinct row once, with the SHA-256 of its values, in folders named by the first hex digits of that hash (buckets).
A delivery is hashed and compared with the hash column of the buckets it touches, and with nothing else of the history; rows that are there
already, from an earlier delivery or from a replay of this one, are not written again. So the table needs no DISTINCT over its history, and
a stream's replayed micro-batch changes nothing.

``schemas/`` is the schema log: one JSON document per change. Later columns are appended to the schema, and older rows read them as typed
NULLs; reads take the schema from the log and merge no file footers. A row's hash leaves NULLs out, so it stays the same when columns
are added.

Defined results: rows are equal if all values are, NULL equal to NULL, NaN to NaN, and -0.0 to 0.0; a column a delivery lacks is NULL;
bookkeeping columns take no part and are not stored; column names are matched exactly, their order is that of the log; a column that
returns with another type, and nested columns, are a ValueError before anything is written; an empty delivery only logs its schema.
One writer at a time.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, FloatType, MapType, StringType, StructField, StructType, TimestampType, VariantType

#: Columns that say where a row came from; they are no part of it.
BOOKKEEPING = ("file_name", "_epoch")
#: Hex digits that name a bucket: 256 buckets.
DIGITS = 2

_LOG = "version long, digits int, schema string"


def schema_log(spark: SparkSession, path: str) -> list[tuple[int, int, StructType]]:
    """``(version, digits, schema)`` of every schema so far, oldest first; one row per change."""
    try:
        rows = spark.read.schema(_LOG).parquet(f"{path}/schemas").orderBy("version").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return [(r["version"], r["digits"], StructType.fromJson(json.loads(r["schema"]))) for r in rows]


def merged_schema(old: StructType, new: StructType) -> StructType:
    """``old`` with the columns only ``new`` has at its end."""
    known = {f.name: f.dataType for f in old.fields}
    for f in new.fields:
        if isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType)):
            raise ValueError(f"column {f.name} is nested: {f.dataType.simpleString()}")
        if f.name in known and known[f.name] != f.dataType:
            raise ValueError(f"column {f.name} was {known[f.name].simpleString()}, now {f.dataType.simpleString()}")
    return StructType([*old.fields, *[StructField(f.name, f.dataType, True) for f in new.fields if f.name not in known]])


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def row_hash(schema: StructType) -> Column:
    """SHA-256 of a row's values that are not NULL, by name."""
    cells = []
    for f in schema.fields:
        c = _quoted(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)):
            c = c + F.lit(0.0)  # folds -0.0
        elif isinstance(f.dataType, TimestampType):
            c = F.unix_micros(c)  # the text would depend on the session's time zone
        elif isinstance(f.dataType, BinaryType):
            c = F.hex(c)
        cells.append(c.cast("string").alias(f.name))
    return F.sha2(F.to_json(F.struct(*cells), {"ignoreNullFields": "true"}), 256)


def append_new(spark: SparkSession, delivery: DataFrame, path: str, bookkeeping: tuple[str, ...] = BOOKKEEPING, digits: int = DIGITS) -> None:
    """Add the rows of a delivery that the table does not hold yet. ``digits`` counts only when the table is made."""
    delivery = delivery.drop(*[c for c in bookkeeping if c in delivery.columns])
    log = schema_log(spark, path)
    old = log[-1][2] if log else StructType([])
    digits = log[-1][1] if log else digits
    schema = merged_schema(old, delivery.schema)
    if not log or schema != old:
        doc = [(len(log), digits, schema.json())]
        spark.createDataFrame(doc, _LOG).coalesce(1).write.mode("append").parquet(f"{path}/schemas")
    have = set(delivery.columns)
    rows = delivery.select(*[_quoted(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    hashed = rows.withColumn("_row", row_hash(schema)).withColumn("_bucket", F.substring("_row", 1, digits))
    touched = [r[0] for r in hashed.select("_bucket").distinct().collect()]  # at most 16 ** digits
    if not touched:
        return
    known = _stored(spark, path, schema)
    if known is not None:
        seen = known.where(F.col("_bucket").isin(touched)).select("_bucket", "_row")
        hashed = hashed.join(seen, ["_bucket", "_row"], "left_anti")
    fresh = hashed.dropDuplicates(["_row"])  # rows of one hash are equal in every column
    fresh.repartitionByRange("_row").sortWithinPartitions("_bucket", "_row").write.mode("append").partitionBy("_bucket").parquet(f"{path}/rows")


def _stored(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    full = StructType([*schema.fields, StructField("_row", StringType()), StructField("_bucket", StringType())])
    try:
        return spark.read.schema(full).parquet(f"{path}/rows")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Every distinct row delivered so far, in the newest schema."""
    log = schema_log(spark, path)
    if not log:
        raise ValueError(f"no table at {path}")
    schema = log[-1][2]
    stored = _stored(spark, path, schema)
    return spark.createDataFrame([], schema) if stored is None else stored.select(*[_quoted(f.name) for f in schema.fields])
