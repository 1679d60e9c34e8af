"""Change records: one JSON object each, its envelope flattened with dots.

Fixed values: field names ``before.*``, ``after.*``, ``source.*``, ``op`` and ``ts_ms``; the
operations r (snapshot), c, u and d; decimals as text and times as milliseconds.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlane.functions.times import from_epoch_millis, to_epoch_millis
from cartlane.schemas import Table

DELETE = "d"
OPERATIONS = ("r", "c", "u", DELETE)

UNREADABLE, INCOMPLETE, UNFIT = "unreadable", "incomplete", "unfit"

# What any text holds that is a whole number, or a decimal of digits in any script. A cast that fails throws
# inside, at many times the price of a value that fits.
_WHOLE, _DIGIT = "^[^0-9A-Za-z]*[0-9]+[^0-9A-Za-z]*$", r"\p{Nd}"

# Milliseconds of the first and the last moment of the years 1 to 9999.
_MILLIS = (-62_135_596_800_000, 253_402_300_799_999)


def _kept(table: Table, columns: list[str] | None) -> list:
    return [c for c in table.columns if columns is None or c.name in ("id", *columns)]


def wire_type(column) -> T.DataType:
    if column.decimal:
        return T.StringType()
    return T.LongType() if column.is_timestamp else column.spark_type()


def envelope_schema(table: Table, columns: list[str] | None = None) -> T.StructType:
    """The record of a table as it is on the wire, with all or some columns of the row."""
    fields = [T.StructField("before.id", T.LongType())]
    fields += [T.StructField(f"after.{c.name}", wire_type(c)) for c in _kept(table, columns)]
    fields += [
        T.StructField("op", T.StringType()),
        T.StructField("source.table", T.StringType()),
        T.StructField("source.lsn", T.LongType()),
        T.StructField("source.ts_ms", T.LongType()),
        T.StructField("ts_ms", T.LongType()),
    ]
    return T.StructType(fields)


def flatten(df: DataFrame, separator: str = ".") -> DataFrame:
    """Every nested field as a column of its own, its path joined by ``separator``."""

    def leaves(schema: T.StructType, path: tuple[str, ...] = ()):
        for f in schema.fields:
            here = (*path, f.name)
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType, here)
            else:
                yield here

    return df.select(
        *[F.col(".".join(f"`{p}`" for p in path)).alias(separator.join(path)) for path in leaves(df.schema)]
    )


def _text_schema(table: Table, columns: list[str] | None) -> T.StructType:
    """The same fields, all as text: what is there can then be told from what can be taken."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in envelope_schema(table, columns).fields])


def _wire(name: str) -> Column:
    return F.col(f"record.`{name}`")


def _fitting(text: Column, to: T.DataType) -> Column:
    """The same as ``try_cast``; what cannot be a number is null before it comes to a cast."""
    there = _WHOLE if isinstance(to, T.IntegralType) else _DIGIT if isinstance(to, T.DecimalType) else None
    return F.when(text.rlike(there), text.try_cast(to)) if there else text.try_cast(to)


def _number(name: str) -> Column:
    return _fitting(_wire(name), T.LongType())


def _time(name: str) -> Column:
    """A time in milliseconds, null beyond the years that a timestamp has."""
    millis = _number(name)
    return from_epoch_millis(F.when(millis.between(*_MILLIS), millis))


def _from_wire(column) -> Column:
    """The value of a column, null where it cannot be one of its type."""
    name = f"after.{column.name}"
    return _time(name) if column.is_timestamp else _fitting(_wire(name), column.spark_type())


def _key() -> Column:
    return F.coalesce(_number("after.id"), _number("before.id"))


def _records(raw: DataFrame, table: Table, columns: list[str] | None) -> DataFrame:
    """``record`` and what is wrong with it: nothing, or one of the three reasons.

    A record without a table cannot be read. One of this table has to have a key, a known
    operation and a log position, and values that fit their columns. Those of other tables are not
    looked at.
    """
    # An object that is nowhere closed cannot be read; the reader would throw over it.
    text = F.when(F.col("value").contains("}"), F.col("value"))
    # A generator, since a filter on fields of the record would pass a projection and read the text once per field.
    record = F.explode(F.array(F.from_json(text, _text_schema(table, columns))))
    read = raw.select("value", record.alias("record"))
    source = _wire("source.table")
    whole = _key().isNotNull() & _number("source.lsn").isNotNull()
    whole = whole & F.coalesce(_wire("op").isin(*OPERATIONS), F.lit(False))
    there = [(_wire(f"after.{c.name}"), _from_wire(c)) for c in _kept(table, columns) if c.name != "id"]
    there.append((_wire("source.ts_ms"), _time("source.ts_ms")))
    unfit = reduce(or_, [on_wire.isNotNull() & value.isNull() for on_wire, value in there])
    mine = source == table.name
    reason = F.when(source.isNull(), UNREADABLE).when(mine & ~whole, INCOMPLETE).when(mine & unfit, UNFIT)
    return read.select("value", "record", reason.alias("reason"))


def decode(raw: DataFrame, table: Table, columns: list[str] | None = None) -> DataFrame:
    """Typed changes of one table: ``id, op, lsn, deleted, changed_at`` and the row's columns.

    Works on a batch and on a stream. A delete brings its key only. The reader skips what
    ``columns`` does not name. ``rejects`` has the records that are left out.
    """
    records = _records(raw, table, columns)
    mine = records.filter(F.col("reason").isNull() & (_wire("source.table") == table.name))
    return mine.select(
        _key().alias("id"),
        _wire("op").alias("op"),
        _number("source.lsn").alias("lsn"),
        (_wire("op") == DELETE).alias("deleted"),
        _time("source.ts_ms").alias("changed_at"),
        *[_from_wire(c).alias(c.name) for c in _kept(table, columns) if c.name != "id"],
    )


def rejects(raw: DataFrame, table: Table, columns: list[str] | None = None) -> DataFrame:
    """``value, reason`` of the records that ``decode`` cannot take. Works on a stream as well."""
    return _records(raw, table, columns).filter(F.col("reason").isNotNull()).select("value", "reason")


def reject_counts(raw: DataFrame, table: Table, columns: list[str] | None = None) -> DataFrame:
    """``reason, records``: how many records were left out, and why."""
    return rejects(raw, table, columns).groupBy("reason").agg(F.count(F.lit(1)).alias("records"))


def table_of(raw: DataFrame) -> DataFrame:
    """Adds ``source_table`` to undecoded records, null where a record cannot be read."""
    source = F.from_json("value", T.StructType([T.StructField("source.table", T.StringType())]))
    return raw.withColumn("__record", source).select("value", F.col("__record.`source.table`").alias("source_table"))


def encode(rows: DataFrame, table: Table, op: Column, lsn: Column, at: Column) -> DataFrame:
    """Change records for rows of a table: the inverse of ``decode``, for tests and replays."""

    def to_wire(c) -> Column:
        value = F.col(c.name)
        value = to_epoch_millis(value.cast("timestamp_ntz")) if c.is_timestamp else value.cast(c.spark_type())
        return F.when(op != DELETE, value.cast(wire_type(c))).alias(f"after.{c.name}")

    fields = [F.when(op == DELETE, F.col("id")).alias("before.id")]
    fields += [to_wire(c) for c in table.columns if c.name in rows.columns]
    fields += [
        op.alias("op"),
        F.lit(table.name).alias("source.table"),
        lsn.alias("source.lsn"),
        to_epoch_millis(at).alias("source.ts_ms"),
        to_epoch_millis(at).alias("ts_ms"),
    ]
    return rows.select(F.to_json(F.struct(*fields)).alias("value"))
