"""Fill-in-the-middle: texts cut at two unit boundaries and put together in another order."""

from __future__ import annotations

import hashlib

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minutefold.llm.work import unused

#: A unit of text: a line with its break, or a last one without.
LINE = r"[^\n]*+\n|[^\n]++"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


def unit_ends(text: str, unit: str = LINE) -> list[int]:
    """Where each unit ends, in code points: all repetitions of one group in one full match."""
    found = regex.fullmatch(f"({unit})*+", text)
    if found is None:
        raise ValueError("the units do not make up the text")
    return found.ends(1)


def draws(key: object, seed: int) -> tuple[int, int, int, int]:
    """Four numbers below 2 ** 32 from the seed and a row's key; a null key counts as empty text."""
    text = "" if key is None else str(key)
    digits = hashlib.sha256(f"{seed}:{text}".encode()).hexdigest()
    return tuple(int(digits[i : i + 8], 16) for i in range(0, 32, 8))


def transformed(text: str, key: object, seed: int, rate: int, spm: int, unit: str = LINE) -> tuple:
    """Number of units, form, code points of prefix and middle (none if plain), and the output."""
    ends = unit_ends(text, unit)
    n = len(ends)
    h1, h2, h3, h4 = draws(key, seed)
    if not text or h3 % 100 >= rate or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    first, second = ([0, *ends][i] for i in sorted((h1 % (n + 1), h2 % (n + 1))))
    before, middle, after = text[:first], text[first:second], text[second:]
    if h4 % 100 < spm:
        return n, "spm", first, second - first, SUFFIX + after + PREFIX + before + MIDDLE + middle
    return n, "psm", first, second - first, PREFIX + before + SUFFIX + after + MIDDLE + middle


def transform(
    df: DataFrame,
    key: str,
    text: str = "text",
    seed: int = 7,
    rate: int = 100,
    spm: int = 50,
    unit: str = LINE,
) -> DataFrame:
    """The table with ``n_units``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    Each text, null as empty, is cut into units; prefix, middle and suffix end at unit
    boundaries that a hash of seed and key draws, so reruns and retries agree and rows equal
    in key and text are cut alike. ``rate`` percent of the texts are rearranged, ``spm``
    percent of those as suffix, prefix, middle and the others as prefix, suffix, middle;
    the rest, empty texts and texts that hold a sentinel stay plain. A part may be empty. A
    null key draws like an empty one. An empty table gives no rows. Columns of the added names
    are replaced; all others stay.
    """
    added = ("n_units", "form", "prefix_chars", "middle_chars", "output")

    @F.pandas_udf("n_units long, form string, prefix_chars long, middle_chars long, output string")
    def made(keys: pd.Series, texts: pd.Series) -> pd.DataFrame:
        found = [transformed(t, k, seed, rate, spm, unit) for k, t in zip(keys, texts, strict=True)]
        out = pd.DataFrame(found, columns=list(added))
        return out.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})

    # The key as text: its decimal digits, whatever its type in pandas.
    cut = made(F.col(f"`{key}`").cast("string"), F.coalesce(F.col(f"`{text}`"), F.lit("")))
    name = unused(df, "fim")
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in added]
    return df.select("*", cut.alias(name)).select(*kept, f"{name}.*")


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. A sentinel cannot overlap what stands beside it."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    psm = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))
    spm = F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
