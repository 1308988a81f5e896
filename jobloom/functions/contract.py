"""The posting contract over JSON payloads.

A record either satisfies every field rule and becomes a typed JSON object, or
its typed value is null and the failed fields are named.  The rules tell an
absent field, an explicit null and a value of the wrong kind apart, so each one
looks at the kind of the JSON value before it reads its text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .json import is_object, read_object, with_settled
from .text import strip_blanks

# Texts accepted as booleans, in any case.
TRUE_TEXTS = ("1", "on", "t", "true", "y", "yes")
FALSE_TEXTS = ("0", "off", "f", "false", "n", "no")

# Fixed value: integer texts; single underscores between digits and a zero fraction are fine.
INTEGER_TEXT = r"^[+-]?\d+(_\d+)*(\.0*)?$"

NOT_AN_OBJECT = "payload"


@dataclass(frozen=True)
class _Member:
    """One member of a payload: its JSON value and the kind of that value."""

    value: Column
    kind: Column

    def get(self, spark_type: str) -> Column:
        return F.try_variant_get(self.value, "$", spark_type)

    @property
    def text(self) -> Column:
        return self.get("string")

    @property
    def absent(self) -> Column:
        return self.kind.isNull()

    @property
    def explicit_null(self) -> Column:
        return self.kind == "VOID"

    @property
    def is_text(self) -> Column:
        return self.kind == "STRING"

    @property
    def fractional(self) -> Column:
        return self.kind.isin("DOUBLE", "FLOAT") | self.kind.startswith("DECIMAL")


def _text(m: _Member) -> Column:
    return F.when(m.is_text, strip_blanks(m.text))


def _text_or_empty(m: _Member) -> Column:
    return F.when(m.absent, F.lit("")).otherwise(_text(m))


def _flag(m: _Member) -> Column:
    word, number = F.lower(m.text), m.get("double")
    return (
        F.when(m.absent, F.lit(False))
        .when(m.kind == "BOOLEAN", m.get("boolean"))
        .when(m.is_text & word.isin(*TRUE_TEXTS), F.lit(True))
        .when(m.is_text & word.isin(*FALSE_TEXTS), F.lit(False))
        .when((m.fractional | (m.kind == "BIGINT")) & number.isin(0.0, 1.0), number == 1.0)
    )


def _integer(m: _Member) -> Column:
    word, number = strip_blanks(m.text), m.get("double")
    digits = F.regexp_replace(F.regexp_replace(word, r"\..*$", ""), "_", "")
    return (
        F.when(m.kind == "BIGINT", m.get("bigint"))
        .when(m.fractional & (number == F.floor(number)), number.try_cast("bigint"))
        .when(m.kind == "BOOLEAN", m.get("bigint"))
        .when(m.is_text & word.rlike(INTEGER_TEXT), digits.try_cast("bigint"))
    )


def _text_list(m: _Member) -> Column:
    """A list of texts; null items are dropped, a lone value becomes a list."""
    items = F.filter(m.get("array<string>"), lambda x: x.isNotNull())
    return (
        F.when(m.absent | m.explicit_null, F.array().cast("array<string>"))
        .when(m.kind.startswith("ARRAY"), F.transform(items, strip_blanks))
        .otherwise(F.array(strip_blanks(m.text)))
    )


# Field order of the typed record, with the rule of each field.
FIELD_RULES = {
    "slug": _text,
    "company_name": _text,
    "title": _text,
    "description": _text_or_empty,
    "remote": _flag,
    "url": _text,
    "tags": _text_list,
    "job_types": _text_list,
    "location": _text_or_empty,
    "created_at": _integer,
}


def validate_contract(df: DataFrame, payload: str = "raw") -> DataFrame:
    """Adds ``typed`` (JSON text, null when invalid) and ``contract_error``.

    ``payload`` is JSON text.  No row is dropped.  The error lists the failed
    fields, or says ``payload`` when the text is no object.  The steps are separate
    projections, so that the text and each member are read once.
    """
    read = df.withColumn("_read", read_object(F.col(payload), dict.fromkeys(FIELD_RULES, "variant")))
    kinds = {f"_kind_{n}": F.schema_of_variant(F.col(f"_read.{n}")) for n in FIELD_RULES}
    fields = {
        f"_field_{n}": rule(_Member(F.col(f"_read.{n}"), F.col(f"_kind_{n}"))) for n, rule in FIELD_RULES.items()
    }
    failed = F.concat_ws(",", *[F.when(F.col(f"_field_{n}").isNull(), F.lit(n)) for n in FIELD_RULES])
    record = F.to_json(F.struct(*[F.col(f"_field_{n}").alias(n) for n in FIELD_RULES]))
    checked = (
        read.withColumns(kinds)
        .withColumns(fields)
        .withColumn("_failed", F.when(is_object("_read"), failed).otherwise(F.lit(NOT_AN_OBJECT)))
        .withColumn("_record", F.when(F.col("_failed") == "", record))
        .select(*df.columns, "_record", F.nullif("_failed", F.lit("")).alias("_error"))
    )
    settled = {"typed": F.col("_record"), "contract_error": F.col("_error")}
    return with_settled(checked, settled).drop("_record", "_error")
