"""Telemetry payloads to typed rows, with an account of everything left out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulwright.functions.geo import NUMBER
from haulwright.functions.timing import iso_to_utc

_ORIGIN = ["shard", "sequence_number", "sub_sequence_number"]


# The payload and its parsed kind are bound once each, however often the rule names them.
_REASON = r"""get(transform(array(cast(data as string)), d ->
    get(transform(array(schema_of_variant(try_parse_json(d))), kind ->
        CASE WHEN d = '' THEN 'empty'
            WHEN NOT is_valid_utf8(d) OR kind IS NULL THEN 'broken_json'
            WHEN kind = 'VOID' THEN 'null'
            WHEN kind = 'OBJECT<>' THEN 'empty_object'
            WHEN d RLIKE r'^\s*\[\s*\]\s*$' THEN 'empty_array'
            WHEN kind NOT LIKE 'OBJECT%' AND kind NOT LIKE 'ARRAY%' THEN 'scalar' END), 0)), 0)"""
_ELEMENTS = """get(transform(array(try_parse_json(cast(data as string))), v ->
    coalesce(try_variant_get(v, '$', 'array<variant>'), array(v))), 0)"""

_IS_RECORD = """get(transform(array(schema_of_variant(item)), kind ->
    coalesce(kind LIKE 'OBJECT%' AND kind <> 'OBJECT<>', false)), 0)"""
_LOST = (
    "NOT complete OR timestamp IS NULL OR work_state_id IS NULL"
    " OR longitude IS NULL OR latitude IS NULL"
)


def _classified(raw: DataFrame) -> DataFrame:
    """Add `reason`: why a payload gives no record, or null."""
    return raw.withColumn("reason", F.expr(_REASON))


def _items(raw: DataFrame) -> DataFrame:
    """One row per object, or per array element with its position."""
    return (
        _classified(raw)
        .where("reason IS NULL")
        .selectExpr(*_ORIGIN, f"posexplode({_ELEMENTS}) AS (item_no, item)")
        .withColumn("is_record", F.expr(_IS_RECORD))
    )


def decode(raw: DataFrame) -> DataFrame:
    """The records of the payloads: one per object, one per object in an array."""
    return _items(raw).where("is_record").select(*_ORIGIN, "item_no", "item")


def payload_rejects(raw: DataFrame) -> DataFrame:
    """Payloads and array items that give no typed record, counted by reason.

    `skipped` are the harmless ones, `error` those that could not be read; X7 counts records
    that fail on a field.
    """
    errors = ["broken_json", "scalar", "X7"]
    # Payloads are read once: whole ones that fail stay a row without an item.
    items = _classified(raw).selectExpr("reason", f"posexplode_outer(if(reason IS NULL, {_ELEMENTS}, null)) AS (item_no, item)")
    rows = items.selectExpr("reason", "item_no", f"{_IS_RECORD} AS is_record", "item").selectExpr(
        "reason", "item_no", "is_record", "if(is_record, item, null) AS item"
    )
    why = f"""CASE WHEN reason IS NOT NULL OR item_no IS NULL THEN reason
        WHEN NOT is_record THEN 'not_an_object' WHEN {_LOST} THEN 'X7' END AS reason"""
    return (
        rows.select("reason", "item_no", "is_record", *_fields())
        .selectExpr(why)
        .where("reason IS NOT NULL")
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("outcome", F.when(F.col("reason").isin(errors), "error").otherwise("skipped"))
    )


def _field(name: str, kind: str) -> str:
    return f"try_variant_get(item, '$.{name}', '{kind}')"


def _is_text(name: str) -> str:
    return f"schema_of_variant(variant_get(item, '$.{name}')) = 'STRING'"


def _whole_number(name: str) -> str:
    """A JSON number is cut to its whole part; text must be a plain integer."""
    text = f"trim({_field(name, 'string')})"
    return (
        f"CASE WHEN {_is_text(name)} THEN if({text} RLIKE r'^[+-]?\\d+$', try_cast({text} AS int), null)"
        f" ELSE try_cast({_field(name, 'double')} AS int) END"
    )


def _decimal(name: str) -> str:
    text = f"trim({_field(name, 'string')})"
    return (
        f"CASE WHEN {_is_text(name)} THEN if({text} RLIKE r'{NUMBER}', try_cast({text} AS double), null)"
        f" ELSE {_field(name, 'double')} END"
    )


def _fields() -> list[Column]:
    """The columns of a record, and whether its keys are `complete`."""
    return [
        F.expr(_field("asset_guid", "string")).alias("asset_guid"),
        F.expr(f"nullif({_field('site_guid', 'string')}, '')").alias("site_guid"),
        iso_to_utc(F.expr(_field("timestamp", "string"))).alias("timestamp"),
        F.expr(_whole_number("work_state_id")).alias("work_state_id"),
        F.expr(_decimal("longitude")).alias("longitude"),
        F.expr(_decimal("latitude")).alias("latitude"),
        F.expr(
            "variant_get(item, '$.asset_guid') IS NOT NULL"
            " AND variant_get(item, '$.site_guid') IS NOT NULL"
        ).alias("complete"),
    ]


def typed(raw: DataFrame) -> DataFrame:
    """Decoded records with their columns; `reject` is X7 for those that fail.

    Only the failing item of an array is rejected, the others stay.
    """
    rows = decode(raw).select(*_ORIGIN, "item_no", *_fields())
    return rows.withColumn("reject", F.expr(f"if({_LOST}, 'X7', null)")).drop("complete")


def _sequence() -> Column:
    """Text that sorts like (sequence, sub-sequence, item): sequence numbers have no bound, so nothing is packed into a number."""
    return F.concat_ws(
        ".", _padded("sequence_number", 64), _padded("sub_sequence_number", 20), _padded("item_no", 10)
    ).alias("seq")


def telemetry(raw: DataFrame) -> DataFrame:
    """Typed telemetry, ordered by `seq` where times are equal; the rest is in `rejected`."""
    return typed(raw).where("reject IS NULL").select(
        _sequence(),
        "asset_guid",
        "site_guid",
        "timestamp",
        "work_state_id",
        "longitude",
        "latitude",
    )


def rejected(raw: DataFrame) -> DataFrame:
    """Records that fail on a field (X7), with what is known of them, as `plans.cycles.rejects` lists them."""
    return typed(raw).where("reject IS NOT NULL").select(
        _sequence(), "asset_guid", "site_guid", "timestamp", "reject"
    )


def _padded(number: str, width: int) -> Column:
    """Digits of a number (text or numeric, not negative) that sort as text; longer ones sort last."""
    digits = F.regexp_replace(F.col(number).cast("string"), "^0+(?=[0-9])", "")
    return F.when(F.length(digits) <= width, F.lpad(digits, width, "0")).otherwise(
        F.concat(F.lit("9" * width), F.lpad(F.length(digits).cast("string"), 6, "0"), digits)
    )


def shard_high_water(raw: DataFrame) -> DataFrame:
    """Highest (sequence, sub-sequence) of each shard among the payloads read."""
    both = F.struct("sequence_number", "sub_sequence_number")
    best = F.max_by(both, F.struct(_padded("sequence_number", 64), _padded("sub_sequence_number", 20)))
    # Skipped and failed payloads do not move the mark.
    return (
        _classified(raw)
        .where("reason IS NULL")
        .groupBy("shard")
        .agg(best.alias("best"))
        .select("shard", "best.sequence_number", "best.sub_sequence_number")
    )
