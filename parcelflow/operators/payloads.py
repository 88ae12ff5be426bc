"""JSON payloads as typed columns, with what is wrong with them in a column of its own."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What a payload is instead of one JSON object whose wanted fields have their types.
MISSING, MALFORMED, NO_OBJECT, DUPLICATE, MISTYPED, ABSENT = "missing", "malformed", "no object", "duplicate key", "wrong type", "absent field"


def with_payload(df: DataFrame, payload: str, fields: Mapping[str, str], extra: str = "further_keys", fault: str = "payload_fault") -> DataFrame:
    """`df` with a column for each of `fields` (name to SQL type), the sorted keys of the payload that are not among them, and its first fault or NULL.

    Faults, in order: a NULL or blank text; an object with a top-level key twice, whose value would depend on the reader; a text that is no
    JSON (a repeated key further down counts as such); JSON that is no object; a field whose value does not cast to its type; a field that is
    absent or null. Fields without fault are filled in any case, others are NULL, so the good values of a drifting payload are kept. Names are case-sensitive.
    """
    text, held, keys = F.col(payload), F.col("_variant"), F.col("_keys")
    parsed = df.withColumns({"_variant": F.try_parse_json(text), "_keys": F.json_object_keys(text)})
    value = {name: F.try_variant_get(held, f"$['{name}']", sql_type) for name, sql_type in fields.items()}
    there = {name: F.try_variant_get(held, f"$['{name}']", "variant") for name in fields}
    nothing = {name: there[name].isNull() | F.is_variant_null(there[name]) for name in fields}
    found = (
        F.when(text.isNull() | (F.trim(text) == ""), MISSING)
        .when(held.isNull() & (F.size(keys) > F.size(F.array_distinct(keys))), DUPLICATE)
        .when(held.isNull(), MALFORMED)
        .when(~F.schema_of_variant(held).startswith("OBJECT"), NO_OBJECT)
        .when(reduce(lambda a, b: a | b, [~nothing[name] & value[name].isNull() for name in fields]), MISTYPED)
        .when(reduce(lambda a, b: a | b, nothing.values()), ABSENT)
    )
    others = F.array_sort(F.array_except(keys, F.array(*(F.lit(name) for name in fields))))
    return parsed.withColumns({**value, extra: others, fault: found}).drop("_variant", "_keys")


def fault_counts(df: DataFrame, fault: str = "payload_fault") -> DataFrame:
    """`fault, rows` of payloads with and without fault."""
    return df.groupBy(F.coalesce(fault, F.lit("none")).alias("fault")).agg(F.count(F.lit(1)).alias("rows"))
