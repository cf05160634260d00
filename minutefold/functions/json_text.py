"""Fields of JSON objects held as text."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_field(col: Column, field: str) -> Column:
    """One top-level field as text; null when absent or when the text is not JSON."""
    return F.get_json_object(col, f"$['{field}']")


#: Only what the standard calls JSON.
STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def sealed_json(
    col: Column, kind: str, seal: Callable[[Column], Column], sealed: Callable[[Column], Column], mode: str, bad: Column
) -> Column:
    """A text parsed as one JSON value of a type and nothing else, in one pass; else ``bad``.

    The parser stops after the first value, so the text is read as the first of two elements,
    the second being a value of the same type that holds the text's own hash: junk behind the
    value, or a bracket that closes early, leaves another number of elements or another last
    one. ``kind`` is the type, ``seal`` makes a JSON text of it from a hash, and ``sealed``
    gets the hash back. Text that is not of the type raises under FAILFAST. Null gives null.
    """
    own = F.xxhash64(col).cast("string")
    whole = F.concat(F.lit("["), col, F.lit(","), seal(own), F.lit("]"))
    pair = F.from_json(whole, f"array<{kind}>", STRICT | {"mode": mode})

    # Bound once by the lambda, as the pair is looked at several times.
    def opened(p: Column) -> Column:
        first, last = F.get(p, F.lit(0)), F.get(p, F.lit(1))
        return F.when((F.size(p) == 2) & sealed(last).eqNullSafe(own) & first.isNotNull(), first).otherwise(bad)

    return F.when(col.isNotNull(), F.get(F.transform(F.array(pair), opened), F.lit(0)))


def not_json(col: Column, kind: str) -> Column:
    """Raises where it is reached."""
    return F.raise_error(F.concat(F.lit("not JSON: "), col)).cast(kind)


def json_fields(col: Column, fields: list[str]) -> Column:
    """Several top-level fields as a struct of texts, parsed once.

    Text that is not JSON raises, as a cast to a JSON type would. JSON that is not
    an object has no fields.
    """
    kind = "struct<" + ", ".join(f"`{f}`: string" for f in fields) + ">"
    first = json.dumps(fields[0])
    an_object = sealed_json(
        col,
        kind,
        lambda own: F.concat(F.lit(f'{{{first}:"'), own, F.lit('"}')),
        lambda last: last.getField(fields[0]),
        "FAILFAST",
        not_json(col, kind),
    )
    blank = F.struct(*[F.lit(None).cast("string").alias(f) for f in fields])
    any_value = sealed_json(
        col, "string", lambda own: F.concat(F.lit('"'), own, F.lit('"')), lambda last: last, "FAILFAST", not_json(col, "string")
    )
    space = F.lit(" \t\r\n")
    no_object = F.when(F.trim(col, space) == "null", blank).when(any_value.isNotNull(), blank)
    opens = F.ltrim(col, space).startswith("{")
    return F.when(opens, an_object).when(col.isNotNull(), no_object)
