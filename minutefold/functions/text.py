"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts pandas' CSV reader takes for null by default.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def normalise_text(col: Column) -> Column:
    """Lower-case letters and digits only.

    Unicode classes, since Java's regex reads a POSIX class such as ``[:alnum:]``
    as a plain set of letters.
    """
    return F.lower(F.regexp_replace(col, r"[^\p{L}\p{N}]", ""))


def blank_to_null(col: Column, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    """Null where the text is one of the null tokens."""
    return F.when(~col.isin(*tokens), col)
