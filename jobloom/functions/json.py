"""JSON texts read as objects, in one pass and judged as a whole."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# As in the standard: no single quotes, no NaN.
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def read_object(text: Column, members: Mapping[str, str]) -> Column:
    """The named members of a JSON object as one struct; null when the whole text is not a single object.

    Readers stop after the first value.  As the only item of a list, anything
    behind it breaks the list or lengthens it, so one pass reads and judges.  A
    STRING member gets the text of any JSON value, a VARIANT member tells an
    explicit null from an absent one.
    """
    struct = ", ".join(f"`{name}`: {kind}" for name, kind in members.items())
    items = F.from_json(F.concat(F.lit("["), text, F.lit("]")), f"array<struct<{struct}>>", _STRICT)
    # The size is taken of a settled list; as a plain condition it would read the text a second time.
    return F.element_at(F.transform(F.array(items), lambda i: F.when(F.size(i) == 1, F.get(i, F.lit(0)))), 1)


def is_object(read: str) -> Column:
    """True when the column made by ``read_object`` came from a JSON object."""
    return F.col(read).isNotNull()


def opens_object(text: Column) -> Column:
    """True for the text of a JSON object taken out of a larger, valid text."""
    return F.coalesce(text.startswith("{"), F.lit(False))


def quotes_a_brace(text: Column) -> Column:
    """True when some string in a JSON text may begin with a brace, written plainly or as an escape."""
    return F.coalesce(text.contains('"{') | text.contains('\\u007'), F.lit(False))


def names_object(value: Column) -> Column:
    """True for a VARIANT that is a JSON object."""
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))


def with_settled(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Adds costly columns that filters above must not compute again.

    Spark moves a filter below the projection it refers to and repeats the
    projection's expressions there; it does not move one below a one-row unnest.
    """
    computed = df.withColumns({f"_new_{name}": column for name, column in columns.items()})
    row = F.struct(*[F.col(f"_new_{name}").alias(name) for name in columns])
    return computed.select(*df.columns, F.inline(F.array(row)))
