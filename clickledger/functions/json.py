"""JSON functions as columns, over variants: types are kept, and what is not there or not JSON is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def raw(text: Column, field: str) -> Column:
    """A field as JSON text, strings with their quotes."""
    return F.to_json(F.try_variant_get(F.try_parse_json(text), f"$.{field}", "variant"))


def unsigned(text: Column, field: str) -> Column:
    """A field that is a whole number of at least 0, as bigint."""
    v = F.try_variant_get(F.try_parse_json(text), f"$.{field}", "variant")
    n = F.when(F.schema_of_variant(v) == "BIGINT", F.try_variant_get(v, "$", "bigint"))
    return F.when(n >= 0, n)


def items(text: Column, field: str) -> Column:
    """The elements of an array field, each as JSON text."""
    return F.transform(F.try_variant_get(F.try_parse_json(text), f"$.{field}", "array<variant>"), lambda x: F.to_json(x))


def element(text: Column, at: int) -> Column:
    """An element of an array text, a string without quotes: the parts of a key, to sort by."""
    return F.try_variant_get(F.try_parse_json(text), f"$[{at}]", "string")


def without_fields(text: Column, *names: str) -> Column:
    """A JSON object without some of its fields. Text without any of the names is handed on as it is."""
    named = F.lit(False)
    for n in names:
        named = named | F.contains(text, F.lit(f'"{n}"'))
    fields = F.map_filter(F.try_variant_get(F.try_parse_json(text), "$", "map<string,variant>"), lambda k, _: ~k.isin(*names))
    return F.when(named, F.to_json(fields)).otherwise(text)


def at_least_zero(x: Column) -> Column:
    return F.greatest(F.lit(0), x)


def now_ms() -> Column:
    return F.unix_millis(F.current_timestamp())
