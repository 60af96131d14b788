"""Strict JSON access on top of Spark's VARIANT type.

``try_parse_json`` takes text that merely starts with a JSON value. Putting the
frame and its own hash into one array closes that gap with a single parse: the
hash is the second element only if the frame was exactly one value.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F


def enclose(frame: Column) -> Column:
    """Parse ``[frame, hash]``; NULL when that is not JSON."""
    return F.try_parse_json(F.concat(F.lit("["), frame, F.lit(","), F.xxhash64(frame).cast("string"), F.lit("]")))


def is_one_value(document: Column, frame: Column) -> Column:
    """Whether the enclosed frame was exactly one JSON value."""
    return F.coalesce(F.try_variant_get(document, "$[1]", "bigint") == F.xxhash64(frame), F.lit(False))


class Document:
    """Typed reads of fields of an enclosed frame. Paths are relative to the frame, as in ``data[0].ts``."""

    def __init__(self, column: Column):
        self._column = column

    @cache  # noqa: B019
    def value(self, path: str) -> Column:
        """The field as a variant; NULL only if the key is absent. A JSON null is a value."""
        return F.variant_get(self._column, f"$[0].{path}", "variant")

    @cache  # noqa: B019
    def has(self, path: str) -> Column:
        return self.value(path).isNotNull()

    @cache  # noqa: B019
    def string(self, path: str) -> Column:
        """The field if it is a JSON string; no other type is turned into text."""
        value = self.value(path)
        return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(self._column, f"$[0].{path}", "string"))

    @cache  # noqa: B019
    def integer(self, path: str) -> Column:
        """The field if it is a whole number within BIGINT; strings and fractions are NULL."""
        value = self.value(path)
        return F.when(F.schema_of_variant(value) == "BIGINT", F.try_variant_get(self._column, f"$[0].{path}", "bigint"))

    def unsigned_text(self, path: str) -> Column:
        """Text of a whole number from 0 to 2^64 - 1; NULL for anything else."""
        kind = F.schema_of_variant(self.value(path))
        text = self.json(path)
        small = (kind == "BIGINT") & ~text.startswith("-")
        # DECIMAL(n,0) is also how a fraction such as 5.0 arrives, so ask for the range above BIGINT.
        big = text.try_cast("decimal(38,0)").between(F.lit("9223372036854775808").cast("decimal(38,0)"),
                                                     F.lit("18446744073709551615").cast("decimal(38,0)"))
        return F.when(small | (kind.rlike(r"^DECIMAL\(\d+,0\)$") & big), text)

    @cache  # noqa: B019
    def json(self, path: str) -> Column:
        """The field as JSON text: numbers bare, strings in quotes, ``null`` for a JSON null."""
        return F.to_json(self.value(path))

    def first_present(self, *paths: str) -> Column:
        """The first field whose key exists, even if its value is null, as a variant."""
        return F.coalesce(*[self.value(path) for path in paths])


def variant_string(value: Column) -> Column:
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def variant_integer(value: Column) -> Column:
    return F.when(F.schema_of_variant(value) == "BIGINT", F.try_variant_get(value, "$", "bigint"))
