"""A table whose columns follow its input.

The schema is kept with the table, one numbered file a version, each written once. A batch that brings new fields, or
wider types, first commits a new version: integers widen to long, long to double, anything else to text. Rows lie under the
version they were written with and are never rewritten; a read gives every version the newest columns, with NULL for those that
came later. A replayed batch id replaces its own rows only.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (BooleanType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType, StructField,
                               StructType, TimestampNTZType, TimestampType)

from heliolake.sinks.table import BATCH_COL

_WHOLE = (ByteType, ShortType, IntegerType, LongType)
_NUMBER = (*_WHOLE, FloatType, DoubleType)


def wider(a: DataType, b: DataType) -> DataType:
    """The type that holds both."""
    if a == b:
        return a
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return max(a, b, key=lambda t: _WHOLE.index(type(t)))
    if isinstance(a, _NUMBER) and isinstance(b, _NUMBER):
        return DoubleType()
    if isinstance(a, DecimalType) and isinstance(b, DecimalType):
        scale = max(a.scale, b.scale)
        whole = max(a.precision - a.scale, b.precision - b.scale)
        return DecimalType(whole + scale, scale) if whole + scale <= 38 else DoubleType()
    if {type(a), type(b)} == {TimestampType, DateType}:
        return TimestampType()
    if {type(a), type(b)} == {TimestampNTZType, DateType}:
        return TimestampNTZType()
    return StringType()


def widened(old: StructType, new: StructType) -> StructType:
    """The columns of ``old`` in their order, then the new ones; a name stands for itself in any case, as in Spark."""
    found = {f.name.lower(): f for f in new.fields}
    kept = [StructField(f.name, wider(f.dataType, found.pop(f.name.lower()).dataType) if f.name.lower() in found else f.dataType, True, f.metadata) for f in old.fields]
    return StructType(kept + [StructField(f.name, f.dataType, True, f.metadata) for f in found.values()])


def key_of(f: StructField) -> str:
    """The JSON key of a column: its name, unless that differs from an earlier column's by case alone."""
    return (f.metadata or {}).get("key", f.name)


def with_keys(old: StructType, keys: StructType) -> StructType:
    """``old`` with the JSON fields of ``keys``, whose names differ by case, too: a later one of those gets a numbered column."""
    known = {key_of(f): f for f in old.fields}
    names = {f.name.lower() for f in old.fields}
    out = []
    for f in keys.fields:
        if f.name in known:
            out.append(StructField(known[f.name].name, f.dataType, True, known[f.name].metadata))
            continue
        name, n = f.name, 1
        while name.lower() in names:
            name, n = f"{f.name}_{n}", n + 1
        names.add(name.lower())
        out.append(StructField(name, f.dataType, True, {"key": f.name} if name != f.name else None))
    return widened(old, StructType(out))


#: fixed values: the types of JSON numbers, booleans and texts as a variant's schema names them
_JSON_TYPES = {"BIGINT": LongType(), "BOOLEAN": BooleanType(), "STRING": StringType(), "DOUBLE": DoubleType()}


def observed_schema(df: DataFrame, value_col: str = "value") -> StructType:
    """The fields that JSON objects in ``value_col`` have, with their types; nested ones and lists are kept as JSON text.

    Counted by Spark in one aggregation; the driver gets one row a field. A row that is no object has no fields.
    """
    objects = df.select(F.try_parse_json(F.col(value_col).cast("string")).alias("v"), F.spark_partition_id().alias("p")).where(F.schema_of_variant("v").startswith("OBJECT") & (F.col("p") >= 0))
    kinds = F.map_entries(F.from_json(F.to_json("v"), "map<string,variant>"))
    fields = objects.select(F.explode(kinds).alias("f")).select(F.col("f.key").alias("name"), F.schema_of_variant("f.value").alias("kind"))
    seen: dict[str, DataType] = {}
    for name, kind in fields.distinct().orderBy("name", "kind").collect():
        if kind == "VOID":
            continue
        t = DoubleType() if kind.startswith("DECIMAL") else _JSON_TYPES.get(kind, StringType())
        seen[name] = wider(seen[name], t) if name in seen else t
    return StructType([StructField(n, t) for n, t in seen.items()])


def flattened(df: DataFrame, schema: StructType, value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """The fields of JSON objects as columns; a value that its column's type does not hold is NULL, an object or list its JSON."""
    rows = df.select(*(keep or []), F.try_parse_json(F.col(value_col).cast("string")).alias("_v"), F.spark_partition_id().alias("_p"))
    v = F.when(F.col("_p") >= 0, F.col("_v"))

    def column(f: StructField):
        path = "$['" + key_of(f).replace("\\", "\\\\").replace("'", "\\'") + "']"
        part = F.try_variant_get(v, path, "variant")
        if isinstance(f.dataType, StringType):
            nested = F.schema_of_variant(part).startswith("OBJECT") | F.schema_of_variant(part).startswith("ARRAY")
            return F.when(nested, F.to_json(part)).otherwise(F.try_variant_get(v, path, "string")).alias(f.name, metadata=f.metadata or {})
        return F.try_variant_get(v, path, f.dataType.simpleString()).alias(f.name, metadata=f.metadata or {})
    return rows.select(*(keep or []), *[column(f) for f in schema.fields])


class WideningTable:
    """An append table under ``path`` whose schema only ever grows."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def versions(self) -> dict[int, StructType]:
        folder = self._path(f"{self.path}/_schema")
        if not self._fs.exists(folder):
            return {}
        out = {}
        for f in self._fs.listStatus(folder):
            name = f.getPath().getName()
            if name.endswith(".json"):
                stream = self._fs.open(f.getPath())
                try:
                    out[int(name[:-5])] = StructType.fromJson(json.loads(bytes(stream.readAllBytes()).decode()))
                finally:
                    stream.close()
        return dict(sorted(out.items()))

    def schema(self) -> StructType:
        return next(reversed(self.versions().values()), StructType([]))

    def _commit(self, number: int, schema: StructType) -> None:
        """Created, never replaced: of two writers that widen at once one fails, and its batch is replayed on the other's columns."""
        out = self._fs.create(self._path(f"{self.path}/_schema/{number:06d}.json"), False)
        try:
            out.write(bytearray(schema.json().encode()))
        finally:
            out.close()

    def append(self, batch: DataFrame, batch_id: int) -> int:
        """Write one micro-batch; returns the version of the schema that it was written with."""
        versions = self.versions()
        number = max(versions, default=0)
        old = versions.get(number, StructType([]))
        new = widened(old, batch.schema)
        if not versions or new != old:
            number += 1
            self._commit(number, new)
        there = {c.lower() for c in batch.columns}
        rows = batch.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if f.name.lower() in there else F.lit(None).cast(f.dataType).alias(f.name) for f in new.fields])
        for other in versions:       # a replay may find wider columns than the first try
            if other != number:
                self._fs.delete(self._path(f"{self.path}/v={other}/{BATCH_COL}={int(batch_id)}"), True)
        rows.write.mode("overwrite").parquet(f"{self.path}/v={number}/{BATCH_COL}={int(batch_id)}")
        return number

    def append_json(self, batch: DataFrame, batch_id: int, value_col: str = "value", keep: list[str] | None = None) -> int:
        """Append JSON payloads: their fields become columns, new ones as they come."""
        batch.persist()
        try:
            found = observed_schema(batch, value_col)
            newest = with_keys(self.schema(), found)
            used = StructType([f for f in newest.fields if f.name not in (keep or [])])
            return self.append(flattened(batch, used, value_col, keep), batch_id)
        finally:
            batch.unpersist()

    def read(self) -> DataFrame:
        """All rows under the newest columns."""
        versions = self.versions()
        newest = self.schema()
        out = self.spark.createDataFrame([], newest)
        for number, schema in versions.items():
            folder = f"{self.path}/v={number}"
            if not self._fs.exists(self._path(folder)):
                continue
            rows = self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(folder)
            out = out.unionByName(rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if f.name in schema.names else F.lit(None).cast(f.dataType).alias(f.name)
                                                for f in newest.fields]))
        return out
