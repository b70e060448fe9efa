"""Truthiness and casts of untyped message fields held as VARIANT.

A field can be absent (SQL NULL), an explicit null (kind VOID), or a value of
any JSON kind. Nothing here raises: a value that has no reading of the wanted
type gives NULL, and the caller decides which rows to reject.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

# Text a number may be written as, after trimming (fixed patterns).
INTEGER_TEXT = r"^[+-]?[0-9]+(_[0-9]+)*$"
FLOAT_TEXT = (
    r"^[+-]?(([0-9]+(_[0-9]+)*(\.([0-9]+(_[0-9]+)*)?)?|\.[0-9]+(_[0-9]+)*)([eE][+-]?[0-9]+)?"
    r"|(?i:inf|infinity|nan))$"
)
WHOLE_FLOAT_TEXT = r"^[+-]?[0-9]+(_[0-9]+)*(\.0+)?$"


def field_kinds(fields: Column, names: list[str]) -> Column:
    """The kind of every field, to be computed once and passed to ``Loose``."""
    return F.struct(*[F.schema_of_variant(fields[n]).alias(n) for n in names])


@dataclass(frozen=True)
class Loose:
    """One untyped field and its kind."""

    field: Column
    kind: Column

    @classmethod
    def of(cls, name: str, fields: str = "fields", kinds: str = "kinds") -> Loose:
        return cls(F.col(fields)[name], F.col(kinds)[name])

    def _as(self, data_type: str) -> Column:
        return F.try_variant_get(self.field, "$", data_type)

    def _is(self, pattern: str) -> Column:
        return F.coalesce(self.kind.rlike(pattern), F.lit(False))

    def is_absent(self) -> Column:
        return self.kind.isNull()

    def is_null(self) -> Column:
        """Absent or an explicit null."""
        return F.coalesce(self.kind == "VOID", F.lit(True))

    def is_text(self) -> Column:
        return F.coalesce(self.kind == "STRING", F.lit(False))

    def is_falsy(self) -> Column:
        """Null, zero, false, empty text, empty list or empty object."""
        return (
            F.when(self.is_null(), True)
            .when(self.kind == "STRING", self._as("string") == "")
            .when(self.kind == "BOOLEAN", ~self._as("boolean"))
            .when(self._is("^(OBJECT|ARRAY)"), F.to_json(self.field).isin("{}", "[]"))
            .otherwise(F.coalesce(self._as("double") == 0, F.lit(False)))
        )

    def text(self) -> Column:
        """Strings as they are, other scalars in JSON spelling, else NULL."""
        return F.when(~self.is_null() & ~self._is("^(OBJECT|ARRAY)"), self._as("string"))

    def only_text(self) -> Column:
        """The text of a text field; NULL for any other kind."""
        return F.when(self.is_text(), self._as("string"))

    def _number_text(self, pattern: str) -> Column:
        raw = F.trim(self._as("string"))
        return F.when(raw.rlike(pattern), F.replace(raw, F.lit("_"), F.lit("")))

    def to_long(self) -> Column:
        """Whole part of a number, or the integer a text spells."""
        spelled = self._number_text(INTEGER_TEXT).try_cast("bigint")
        return F.when(self.is_text(), spelled).otherwise(self._as("bigint"))

    def to_double(self) -> Column:
        spelled = self._number_text(FLOAT_TEXT).try_cast("double")
        return F.when(self.is_text(), spelled).otherwise(self._as("double"))

    def to_exact_long(self) -> Column:
        """Like ``to_long`` but NULL for a number with a fractional part."""
        spelled = F.regexp_replace(self._number_text(WHOLE_FLOAT_TEXT), r"\.0+$", "")
        number = self._as("double")
        whole = (self.kind == "BOOLEAN") | (number == F.floor(number))
        return F.when(self.is_text(), spelled.try_cast("bigint")).when(whole, self._as("bigint"))
