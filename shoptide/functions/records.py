"""JSON text to typed records and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptide import schemas

_BROKEN = "_broken"


def _as_text(schema: T.StructType) -> T.StructType:
    """The schema with every field read as text, so ``1`` and ``"1"`` are taken alike."""
    names = [field.name for field in schema.fields] + [_BROKEN]
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def _parsed(schema: T.StructType, value: str) -> Column:
    return F.from_json(F.col(value), _as_text(schema), {"columnNameOfCorruptRecord": _BROKEN})


def parse_records(raw: DataFrame, schema: T.StructType, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed records of JSON objects; unknown keys are dropped, absent ones are null, broken text is left out.

    ``keep`` names columns of ``raw`` (an offset, an arrival time) to carry along.
    """
    typed = [
        F.col(field.name) if isinstance(field.dataType, T.StringType) else F.col(field.name).try_cast(field.dataType)
        for field in schema.fields
    ]
    # As a generator the text is parsed once per row; as a plain column, the filter would parse it again.
    parsed = raw.where(F.col(value).isNotNull()).select(*keep, F.inline(F.array(_parsed(schema, value))))
    return parsed.where(F.col(_BROKEN).isNull()).select(
        *keep, *[column.alias(field.name) for column, field in zip(typed, schema.fields)]
    )


def checked_records(raw: DataFrame, schema: T.StructType, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """All rows, parsed once: ``value``, ``reason`` ("broken" for what :func:`parse_records` leaves out, else null), the fields."""
    rows = raw.select(*keep, F.col(value).alias("value"), F.explode(F.array(_parsed(schema, value))).alias("record"))
    broken = F.col("record").isNull() | F.col(f"record.{_BROKEN}").isNotNull()
    typed = [
        F.col(f"record.{field.name}")
        if isinstance(field.dataType, T.StringType)
        else F.col(f"record.{field.name}").try_cast(field.dataType)
        for field in schema.fields
    ]
    fields = [column.alias(field.name) for column, field in zip(typed, schema.fields)]
    return rows.select(*keep, "value", F.when(broken, F.lit("broken")).alias("reason"), *fields)


def rejected_records(raw: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """The rows :func:`parse_records` leaves out, to be kept aside."""
    record = _parsed(schema, value)
    return raw.where(record.isNull() | record.getField(_BROKEN).isNotNull())


def broken_records(raw: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """``value`` and ``reason`` of what cannot be parsed."""
    return rejected_records(raw, schema, value).select(F.col(value).alias("value"), F.lit("broken").alias("reason"))


def parse_startup(raw: DataFrame, **options) -> DataFrame:
    return parse_records(raw, schemas.STARTUP_LOG, **options)


def parse_event(raw: DataFrame, **options) -> DataFrame:
    return parse_records(raw, schemas.EVENT_LOG, **options)


def parse_order(raw: DataFrame, **options) -> DataFrame:
    return parse_records(raw, schemas.ORDER_INFO, **options)


def parse_detail(raw: DataFrame, **options) -> DataFrame:
    return parse_records(raw, schemas.ORDER_DETAIL, **options)


def parse_user(raw: DataFrame, **options) -> DataFrame:
    return parse_records(raw, schemas.USER_INFO, **options)


def json_value(df: DataFrame, *columns: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One JSON object per row, of the named columns or of all."""
    return df.select(*keep, F.to_json(F.struct(*(columns or ("*",)))).alias("value"))


def _last_of_each(pairs: Column, name: str) -> Column:
    """Pairs whose name does not come again later in the array."""
    names = pairs.getField(name)
    later = F.filter(
        pairs, lambda p, i: ~F.array_contains(F.slice(names, i + F.lit(2), F.size(names)), p.getField(name))
    )
    return F.when(F.size(F.array_distinct(names)) == F.size(names), pairs).otherwise(later)


def object_of_pairs(pairs: Column) -> Column:
    """JSON object of an array of (name, value) structs; the last pair of a name counts."""
    return F.to_json(F.map_from_entries(_last_of_each(pairs, "name")))


def put_key(df: DataFrame, column: str, key: str, new: Column) -> DataFrame:
    """Set one key of the JSON objects in a column, other keys and their JSON types kept; drop what is no object."""
    # A generator, so that the text is parsed once per row however often its members are looked at.
    parsed = F.explode(F.array(F.map_entries(F.from_json(column, "map<string,variant>"))))
    members = df.withColumn("members", parsed).where(F.col("members").isNotNull())
    others = F.filter(_last_of_each(F.col("members"), "key"), lambda p: p.getField("key") != F.lit(key))
    added = F.array(F.struct(F.lit(key).alias("key"), new.cast("variant").alias("value")))
    return members.withColumn(column, F.to_json(F.map_from_entries(F.concat(others, added)))).drop("members")
