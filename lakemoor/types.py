"""Arrow data in Spark's types.

Unsigned integers become the next wider signed type (64 bits: decimal(20,0)), half floats floats,
nanoseconds microseconds, views, dictionaries and fixed-size types their plain form.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Arrow types without a counterpart.
_UNSUPPORTED = (pa.types.is_union, pa.types.is_run_end_encoded, pa.types.is_decimal256, lambda t: str(t) == "month_day_nano_interval")


def storable(t: pa.DataType) -> pa.DataType:
    """The Arrow type that Spark takes for values of type ``t``."""
    if any(f(t) for f in _UNSUPPORTED):
        raise NotImplementedError(f"the type {t} is not supported")
    if isinstance(t, pa.ExtensionType):
        return storable(t.storage_type)
    if pa.types.is_dictionary(t):
        return storable(t.value_type)
    wider = {pa.uint8(): pa.int16(), pa.uint16(): pa.int32(), pa.uint32(): pa.int64(), pa.uint64(): pa.decimal128(20, 0), pa.float16(): pa.float32(), pa.date64(): pa.date32()}
    if t in wider:
        return wider[t]
    if pa.types.is_time(t):
        return pa.time64("us")
    if pa.types.is_timestamp(t):
        return pa.timestamp("us", tz="UTC" if t.tz else None)
    if pa.types.is_duration(t):
        return pa.duration("us")
    if pa.types.is_fixed_size_binary(t) or pa.types.is_large_binary(t) or str(t) == "binary_view":
        return pa.binary()
    if pa.types.is_large_string(t) or str(t) == "string_view":
        return pa.string()
    if pa.types.is_list(t) or pa.types.is_large_list(t) or pa.types.is_fixed_size_list(t):
        return pa.list_(storable(t.value_type))
    if pa.types.is_struct(t):
        return pa.struct([pa.field(f.name, storable(f.type), f.nullable) for f in t])
    if pa.types.is_map(t):
        return pa.map_(storable(t.key_type), storable(t.item_type))
    return t


def _convert(a: pa.Array, to: pa.DataType) -> pa.Array:
    if isinstance(a.type, pa.ExtensionType):
        a = a.storage
    if a.type == to:
        return a
    if pa.types.is_struct(to):
        fields = [_convert(a.field(i), f.type) for i, f in enumerate(to)] if not a.offset else [_convert(x, f.type) for x, f in zip(a.flatten(), to, strict=True)]
        return pa.StructArray.from_arrays(fields, fields=list(to), mask=a.is_null())
    if pa.types.is_list(to):
        if pa.types.is_fixed_size_list(a.type):
            return pa.array(a.to_pylist(), pa.list_(a.type.value_type)) if a.type.value_type == to.value_type else _convert(pa.array(a.to_pylist(), pa.list_(a.type.value_type)), to)
        a = a.cast(pa.list_(a.type.value_type))
        return pa.ListArray.from_arrays(a.offsets, _convert(a.values, to.value_type), mask=a.is_null()) if not a.offset else pa.array(a.to_pylist(), to)
    if pa.types.is_timestamp(to) or pa.types.is_time(to) or pa.types.is_duration(to):
        return a.cast(to, safe=False)  # below a microsecond is cut off
    return a.cast(to)


def from_arrow(spark: SparkSession, table: pa.Table) -> DataFrame:
    """An Arrow table as a DataFrame."""
    columns = []
    for field, column in zip(table.schema, table.columns, strict=True):
        to = storable(field.type)
        columns.append(pa.chunked_array([_convert(c, to) for c in column.chunks], type=to))
    plain = pa.table(columns, schema=pa.schema([pa.field(f.name, c.type) for f, c in zip(table.schema, columns, strict=True)]))
    return spark.createDataFrame(plain)


def column(name: str) -> Column:
    """The column of exactly this name, whatever its characters."""
    return F.col("`" + name.replace("`", "``") + "`")


def check_names(schema: T.StructType) -> None:
    """Column names are told apart exactly, are not empty, and hold no dot."""
    for name in schema.names:
        if not name or "." in name:
            raise ValueError(f"column name {name!r}: a name must not be empty or contain '.'")
    if len(set(schema.names)) < len(schema.names):
        raise ValueError("column names must differ")
