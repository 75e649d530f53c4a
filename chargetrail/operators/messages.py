"""Filtering, unpacking and flattening of messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chargetrail.functions import parse_timestamp, rounded_double
from chargetrail.schemas import ENVELOPE, IMPORT_POWER, METER_POWER, MessageClass

CORRUPT = "_corrupt_body"


def of_class(df: DataFrame, action: str, message_type: int) -> DataFrame:
    """Messages of one action and type; both tests reach a Parquet scan."""
    return df.where((F.col("action") == action) & (F.col("message_type") == message_type))


def _body_type(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def unpack_json(
    df: DataFrame,
    body_schema: str,
    body: str = "body",
    into: str = "new_body",
    other_names: dict[str, str] | None = None,
    keep_corrupt: bool = False,
    fields: tuple[str, ...] | None = None,
) -> DataFrame:
    """Parse the JSON text in `body` into the struct column `into`.

    A document that does not parse gives a struct of NULLs, a value of the wrong type NULL in its
    field. `other_names` maps a field to a second spelling that is read when the first is absent.
    `keep_corrupt` adds the struct field `_corrupt_body` with the text that did not parse. `fields` are the ones to
    read, if not all: Spark does not leave out by itself what is not used of a struct, and building values is most of
    the cost.
    """
    schema = _body_type(body_schema)
    if fields is not None:
        schema = StructType([schema[name] for name in fields])
        other_names = {name: other for name, other in (other_names or {}).items() if name in fields}
    wanted = StructType(list(schema.fields))
    options = {}
    for name, other in (other_names or {}).items():
        wanted = wanted.add(other, schema[name].dataType)
    if keep_corrupt:
        wanted = wanted.add(CORRUPT, "string")
        options["columnNameOfCorruptRecord"] = CORRUPT
    parsed = df.withColumn(into, F.from_json(body, wanted, options))
    if not other_names:
        return parsed

    def field(name: str) -> Column:
        value = F.col(f"{into}.{name}")
        if name in other_names:
            value = F.coalesce(value, F.col(f"{into}.{other_names[name]}"))
        return value.alias(name)

    names = schema.names + ([CORRUPT] if keep_corrupt else [])
    return parsed.withColumn(into, F.struct(*[field(name) for name in names]))


def flatten_struct(df: DataFrame, struct: str = "new_body", drop: tuple[str, ...] = ("body",)) -> DataFrame:
    """Lift the fields of `struct` to columns; fields of an inner struct get its name as prefix."""
    kept = [F.col(f"`{name}`") for name in df.columns if name not in (struct, *drop)]
    lifted = []
    for outer in df.schema[struct].dataType.fields:
        if isinstance(outer.dataType, StructType):
            lifted += [
                F.col(f"{struct}.{outer.name}.{inner}").alias(f"{outer.name}_{inner}")
                for inner in outer.dataType.names
            ]
        else:
            lifted.append(F.col(f"{struct}.{outer.name}").alias(outer.name))
    return df.select(*kept, *lifted)


def meter_samples(df: DataFrame, keep: list[str] | None = None, only_power: bool = False) -> DataFrame:
    """Unpacked MeterValues messages to one row per sampled value.

    `keep` lists the envelope columns of the result; without them the five sample columns remain.
    Empty or missing arrays give no row. `only_power` keeps total import power (no phase) alone.
    """
    # The first explode is an outer one because Spark tests the array of an inner one first, which
    # parses the JSON a second time; the inner explode after it drops the same rows.
    samples = df.withColumn("_reading", F.explode_outer("new_body.meter_value")).withColumn(
        "_sample", F.explode("_reading.sampled_value")
    )
    if only_power:
        samples = samples.where(_is_import_power("_sample."))
    return samples.select(
        *(keep or []),
        F.col("new_body.transaction_id").alias("transaction_id"),
        *([F.col("new_body.connector_id").alias("connector_id")] if keep else []),
        parse_timestamp("_reading.timestamp").alias("timestamp"),
        F.col("_sample.measurand").alias("measurand"),
        F.col("_sample.phase").alias("phase"),
        rounded_double("_sample.value").alias("value"),
    )


def _is_import_power(prefix: str = "") -> Column:
    return (F.col(f"{prefix}measurand") == IMPORT_POWER) & F.col(f"{prefix}phase").isNull()


def import_power(df: DataFrame) -> DataFrame:
    """Total import power among flattened samples: that measurand, and no phase."""
    return df.where(_is_import_power())


def power_samples(log: DataFrame, message: MessageClass = METER_POWER) -> DataFrame:
    """Total import power in the MeterValues messages of a log: transaction, time and value. Nothing else is parsed."""
    return (
        log.transform(of_class, message.action, message.message_type)
        .transform(unpack_json, message.body)
        .transform(meter_samples, only_power=True)
        .select("transaction_id", "timestamp", "value")
    )


def silver(log: DataFrame, message: MessageClass, fields: tuple[str, ...] | None = None) -> DataFrame:
    """The flattened action table of one message class, from the event log; of its body only `fields`, if given (not
    for meter samples)."""
    unpacked = log.transform(of_class, message.action, message.message_type).transform(
        unpack_json, message.body, other_names=message.other_names, fields=fields
    )
    if "meter_value" in _body_type(message.body).names:
        return meter_samples(unpacked, keep=ENVELOPE)
    flat = flatten_struct(unpacked)
    return flat.withColumns({name: parse_timestamp(name) for name in message.timestamps if fields is None or name in fields})
