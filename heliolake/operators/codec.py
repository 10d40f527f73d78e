"""Encode rows to keyed JSON messages and decode them back with exact missing/null rules.

Decoding parses each message once into a struct of the wanted fields as text: other keys are skipped
by the parser, a JSON ``null`` is NULL, and a value that is not a string keeps its JSON text. Only a field with a
default for *absent* keys also looks at the object's key list.

* ``get``      — NULL when absent or null                                  (P7)
* ``default``  — the default only when the key is absent; null stays NULL   (P6)
* ``falsy``    — the default when absent, null, 0 or ''                      (P8)

Typed fields use ``try_cast``; a non-null input that does not convert marks the row rejected
(``_reject`` holds the reason) instead of failing the job or being silently dropped.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType, MapType, StringType, StructField, StructType

REJECT = "_reject"
PAYLOAD = "_payload"
_BARRIER = "_parse_task"
_KEYS = "_payload_keys"
_IS_OBJECT = "_is_object"
_OBJECT_END = r"\}\s*$"


class _NoDefault:
    def __repr__(self):
        return "NO_DEFAULT"


NO_DEFAULT = _NoDefault()


@dataclass(frozen=True)
class Field:
    """One decoded field.

    dtype: ``string | double | long | int | int_round | boolean`` — ``int`` truncates a
    fractional number toward zero; ``int_round`` rounds half away from zero (what an INTEGER
    column does on assignment).
    """

    name: str
    dtype: str = "string"
    lookup: str = "get"            # get | default | falsy
    default: object = NO_DEFAULT
    key: str | None = None         # JSON key when it differs from the output name
    required: bool = False         # NULL after decoding -> reject

    @property
    def json_key(self) -> str:
        return self.key or self.name


def _whole(raw: Column, kind: str) -> Column:
    """``try_cast`` to an integer type; a text with a point or exponent is none, and a cast that fails costs an exception a row."""
    return F.when(~raw.rlike("[.eE]"), raw.try_cast(kind))


def _typed(raw: Column, dtype: str) -> Column:
    if dtype == "string":
        return raw
    if dtype == "double":
        return raw.try_cast("double")
    if dtype == "long":
        as_double = raw.try_cast("double")
        return F.coalesce(_whole(raw, "bigint"), F.when(as_double == F.floor(as_double), as_double.try_cast("bigint")))
    if dtype == "int":
        return F.coalesce(_whole(raw, "int"), raw.try_cast("double").try_cast("int"))
    if dtype == "int_round":
        return F.coalesce(_whole(raw, "int"), F.round(raw.try_cast("double")).try_cast("int"))
    if dtype == "boolean":
        return raw.try_cast("boolean")
    raise ValueError(f"unsupported dtype {dtype!r}")


def _falsy(v: Column, dtype: str) -> Column:
    if dtype == "string":
        return v.isNull() | (v == "")
    if dtype == "boolean":
        return v.isNull() | ~v
    return v.isNull() | (v == 0)


def payload_map(value: Column, value_type=None) -> Column:
    """Parse a message value into map<string,string> (NULL when it is not a JSON object).

    E2: the value may be JSON text (string/binary) or an already-structured struct/map.
    """
    if isinstance(value_type, MapType):
        return F.transform_values(value, lambda k, v: v.cast("string"))
    return F.from_json(_as_text(value, value_type), MapType(StringType(), StringType()))


def _as_text(value: Column, value_type) -> Column:
    if isinstance(value_type, StructType):
        return F.to_json(value, {"ignoreNullFields": "false"})
    return value.cast("string") if isinstance(value_type, BinaryType) else value


_BROKEN = "_broken_text"


def _parsed(value: Column, value_type, keys: Sequence[str]) -> Column:
    """Struct of the keys as text, and the text that could not be parsed, if any."""
    if isinstance(value_type, MapType):
        texts = F.transform_values(value, lambda k, v: v.cast("string"))
        return F.struct(*[F.try_element_at(texts, F.lit(k)).alias(k) for k in keys])
    schema = StructType([StructField(k, StringType()) for k in keys] + [StructField(_BROKEN, StringType())])
    return F.from_json(_as_text(value, value_type), schema, {"columnNameOfCorruptRecord": _BROKEN})


def _is_object(payload: Column, value: Column, value_type) -> Column:
    if isinstance(value_type, MapType):
        return value.isNotNull()
    good = payload.isNotNull() & payload[_BROKEN].isNull()
    return good if isinstance(value_type, StructType) else good & value.cast("string").rlike(r"^\s*\{")


def decode(df: DataFrame, fields: Sequence[Field], value_col: str = "value",
           keep: Iterable[str] = (), strict_end: bool = True) -> DataFrame:
    """Decode ``value_col`` into typed columns + ``_reject`` (NULL when the row is good).

    ``keep`` lists input columns (e.g. envelope metadata) carried through unchanged.
    ``strict_end``: Spark's JSON parser stops after the first complete value, so
    ``{"a":1} junk`` would parse; with this check a text value must end in ``}`` (apart from
    whitespace) or the row is rejected as ``trailing_content``. Two objects back to back
    still pass — a documented limit.
    """
    vtype = df.schema[value_col].dataType
    # A filter on the decoded columns (e.g. ``_reject IS NULL``) would otherwise be pushed below these projections, with the
    # parse, the key list and the object test inlined once per reference. A (cheap, non-deterministic) partition id stops the
    # push-down, here and in the reason, so each message is parsed, tested and typed exactly once.
    keys = list(dict.fromkeys(f.json_key for f in fields))
    staged = df.withColumn(PAYLOAD, _parsed(F.col(value_col), vtype, keys))
    tests = {_IS_OBJECT: F.coalesce(_is_object(F.col(PAYLOAD), F.col(value_col), vtype), F.lit(False)), _BARRIER: F.spark_partition_id()}
    if any(f.lookup == "default" for f in fields):
        tests[_KEYS] = F.map_keys(F.col(value_col)) if isinstance(vtype, MapType) else F.json_object_keys(_as_text(F.col(value_col), vtype))
    staged = staged.withColumns(tests)
    is_object = F.col(_IS_OBJECT)
    out_cols = [F.col(c) for c in keep]
    problems = [F.when(F.col(value_col).isNull(), F.lit("null_value")),
                F.when(~is_object, F.lit("not_a_json_object"))]
    if strict_end and not isinstance(vtype, (MapType, StructType)):
        problems.append(F.when(~F.col(value_col).cast("string").rlike(_OBJECT_END), F.lit("trailing_content")))
    for f in fields:
        raw = F.col(PAYLOAD)[f.json_key]
        typed = _typed(raw, f.dtype)
        bad = raw.isNotNull() & typed.isNull()
        if f.lookup == "get":
            val = typed
        elif f.lookup == "default":
            if f.default is NO_DEFAULT:
                raise ValueError(f"field {f.name}: lookup='default' needs a default")
            # a value is there, or a null under its key; else the key is absent
            val = F.when(raw.isNotNull() | F.array_contains(F.col(_KEYS), F.lit(f.json_key)), typed).otherwise(F.lit(f.default))
        elif f.lookup == "falsy":
            val = F.when(_falsy(typed, f.dtype), F.lit(f.default)).otherwise(typed)
        else:
            raise ValueError(f"unknown lookup {f.lookup!r}")
        # no object payload -> no fields (the row is rejected as a whole)
        out_cols.append(F.when(is_object, val).cast(_spark_type(f.dtype)).alias(f.name))
        problems.append(F.when(is_object & bad, F.lit(f"bad_{f.name}")))
        if f.required:
            problems.append(F.when(is_object & ~bad & val.isNull(), F.lit(f"missing_{f.name}")))
    problems.append(F.when((F.col(_BARRIER) < 0) | (F.spark_partition_id() < 0), F.lit("unreachable")))   # keeps both barriers alive
    reason = F.coalesce(*problems)
    return staged.select(*out_cols, reason.alias(REJECT))


def _spark_type(dtype: str) -> str:
    return {"string": "string", "double": "double", "long": "bigint", "int": "int",
            "int_round": "int", "boolean": "boolean"}[dtype]


def good_rows(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col(REJECT).isNull()).drop(REJECT)


def rejected_rows(decoded: DataFrame) -> DataFrame:
    """T7 side output: rows that failed decoding, with the reason."""
    return decoded.filter(F.col(REJECT).isNotNull())


def encode(df: DataFrame, key, value_cols: Sequence[str] | None = None,
           keep_nulls: bool = False) -> DataFrame:
    """Rows -> ``(key string, value string-JSON)``.

    ``keep_nulls=False`` drops null fields from the JSON (they decode as *absent*);
    ``True`` writes explicit ``null`` (they decode as *null*).
    """
    cols = list(value_cols) if value_cols is not None else df.columns
    k = F.col(key) if isinstance(key, str) else key
    opts = {"ignoreNullFields": "false" if keep_nulls else "true"}
    return df.select(k.cast("string").alias("key"), F.to_json(F.struct(*cols), opts).alias("value"))


def merge_field(value_col, name: str, v: Column) -> Column:
    """``{**data, name: v}`` on JSON object text; the new key wins, other values keep
    their JSON types (parsed as ``map<string,variant>``). NULL when the text is not an object."""
    m = F.from_json(F.col(value_col) if isinstance(value_col, str) else value_col, "map<string,variant>")
    return F.to_json(F.map_concat(F.map_filter(m, lambda k, _: k != F.lit(name)),
                                  F.create_map(F.lit(name), v.cast("variant"))))
