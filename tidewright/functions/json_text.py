"""Reading loosely shaped JSON text with built-in expressions.

Objects are parsed into structs of texts: one pass per level, nested values
kept as JSON text.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from tidewright.functions.binding import let

# JSON texts that count as false or empty.
FALSY_TEXT = ["", "false", "0", "0.0", "{}", "[]"]
EMPTY_TEXT = ["", "{}", "[]"]


def text_struct(keys: Iterable[str]) -> str:
    return "struct<" + ",".join(f"`{key}`:string" for key in keys) + ">"


def as_fields(text: Column, keys: Iterable[str]) -> Column:
    """Named fields of a JSON object text; all NULL when it is no object."""
    return F.from_json(text, text_struct(keys))


def strict(text: Column, item_type: str) -> Column:
    """One JSON object text as the given type, NULL for anything else.

    The parser stops after the first value, so `{} x` would pass; as the only
    element of an array it does not.
    """
    wrapped = F.from_json(F.concat(F.lit("["), text, F.lit("]")), f"array<{item_type}>")
    return let(wrapped, lambda parsed: F.when(F.size(parsed) == 1, F.get(parsed, F.lit(0))))


def strict_fields(text: Column, keys: Iterable[str]) -> Column:
    return strict(text, text_struct(keys))


class JsonObject:
    """Parsed fields of an object next to its text."""

    def __init__(self, fields: Column, text: Column):
        self.fields = fields
        self.text = text

    def get(self, key: str) -> Column:
        """Field text, NULL when missing or null."""
        return self.fields.getField(key)

    def has(self, key: str) -> Column:
        """True also for a key whose value is null."""
        return F.coalesce(F.array_contains(F.json_object_keys(self.text), key), F.lit(False))

    def get_or(self, key: str, default: Column) -> Column:
        """Default only when the key is absent; an explicit null stays null.

        The keys are looked up only for rows without a value.
        """
        value = self.get(key)
        return F.when(value.isNotNull(), value).when(~self.has(key), default)


def present(text: Column) -> Column:
    """Neither null nor empty text, object or array."""
    return text.isNotNull() & ~text.isin(EMPTY_TEXT)


def truthy(text: Column) -> Column:
    return text.isNotNull() & ~text.isin(FALSY_TEXT)


def array_size(text: Column) -> Column:
    """Length of a JSON array text, 0 for anything else."""
    return F.coalesce(F.json_array_length(text), F.lit(0))


def iso_timestamp(text: Column) -> Column:
    """ISO-8601 text with a full date; anything else is NULL."""
    looks_iso = text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}")
    return F.when(looks_iso, text.try_cast("timestamp"))
