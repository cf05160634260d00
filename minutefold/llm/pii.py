"""Personal data: patterns propose spans, checksums confirm them, words nearby move the score.

Built from SQL expressions alone. A text is cut at a pattern's matches by ``split`` and the
matches are taken by ``regexp_extract_all``; the lengths of both, added up, are the positions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Matches whose lengths are added up in one go; a text with more is done in such chunks.
CHUNK = 256
#: Code points looked at before and after a span.
BEFORE, AFTER = 48, 24
#: Code points of the blocks that surroundings are taken from; no fewer than BEFORE.
BLOCK = 128


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a digit string passes the Luhn check: every second digit from the right doubled."""
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)),
        F.lit(0),
        lambda a, i: a + _luhn_digit(F.substring(digits, -i, F.lit(1)).cast("int"), i),
    )
    return total % 10 == 0


def _luhn_digit(d: Column, i: Column) -> Column:
    twice = d * (F.lit(2) - i % 2)  # the first from the right stays
    return F.when(twice > 9, twice - 9).otherwise(twice)


def mod97(code: Column) -> Column:
    """Whether an account code passes the ISO 7064 check: its first four signs go last."""
    turned = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4))

    def step(rest: Column, sign: Column) -> Column:
        letter = sign.between("A", "Z")
        value = F.when(letter, F.ascii(sign) - 55).otherwise(F.ascii(sign) - 48)
        return (rest * F.when(letter, 100).otherwise(10) + value) % 97

    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def _length(x: Column, low: int, high: int) -> Column:
    return F.length(x).between(low, high)


def _octets(x: Column) -> Column:
    """Every part of a dotted number is at most 255; leading zeros do not count."""

    def fits(part: Column) -> Column:
        short = F.ltrim(part, F.lit("0"))
        return F.length(short).between(0, 3) & (F.coalesce(F.try_to_number(short, F.lit("999")), F.lit(0)) <= 255)

    return F.forall(F.split(x, r"\."), fits)


#: Signs of an account code by country: the register of ISO 13616, and countries that use codes
#: without standing in it.
IBAN_SIGNS = {
    15: "NO",
    16: "BE",
    18: "DK FI FK FO GL NL SD",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST",
    26: "DZ IR IS TR",
    27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG",
    29: "BR EG PS QA UA",
    30: "JO KW MU YE",
    31: "MT SC",
    32: "LC",
    33: "RU",
}


def _iban() -> str:
    """Codes of their country's length, in groups of four; of other countries, whole runs."""

    def exact(signs: int, countries: str) -> str:
        fours, rest = divmod(signs - 4, 4)
        end = rf"\x20?+[A-Z0-9]{{{rest}}}" if rest else ""
        return rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:\x20?+[A-Z0-9]{{4}}){{{fours}}}{end}(?![A-Za-z0-9])"

    known = "|".join(IBAN_SIGNS.values()).replace(" ", "|")
    other = rf"(?!{known})[A-Z]{{2}}[0-9]{{2}}(?:\x20?+[A-Z0-9]{{4}}){{2,7}}+(?:\x20?+[A-Z0-9]{{1,3}})?+(?![A-Za-z0-9])"
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join([exact(*x) for x in IBAN_SIGNS.items()])}|{other})"


@dataclass(frozen=True)
class Kind:
    """``pattern`` proposes, ``valid`` confirms; ``hint`` is a cheap sign that a text may hold any.

    Patterns take runs possessively and begin only where a run begins, or where the match
    before ended: the same matches as the plain pattern, in time linear in the text.
    """

    name: str
    pattern: str
    hint: str
    score: float
    words: str
    valid: object = None
    #: Kinds that the method adds are kept from this score on; base kinds always are.
    least: float = 0.0


#: The patterns, in the order in which kinds are listed.
BASE = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        0.8,
        "e-?mail|mail|contact|write|courriel|correo|kontakt",
    ),
    Kind(
        "ip",
        r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
        ".",
        0.6,
        "ip|address|host|server|adresse|servidor",
        _octets,
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?+[0-9])++",
        "",
        0.7,
        "card|credit|visa|mastercard|carte|tarjeta|karte",
        lambda x: _length(_digits(x), 12, 19) & luhn(_digits(x)),
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        "+",
        0.6,
        "phone|tel|call|fax|mobile|telefon|téléphone|teléfono",
        lambda x: _length(_digits(x), 9, 15),
    ),
)
ADDED = (
    Kind(
        "iban",
        _iban(),
        "",
        0.7,
        "iban|account|bank|konto|compte|cuenta",
        lambda x: _length(F.replace(x, F.lit(" ")), 15, 34) & mod97(F.replace(x, F.lit(" "))),
        0.5,
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        "-",
        0.3,
        "ssn|social|security",
        None,
        0.5,
    ),
)

_SPAN = "array<struct<s:int,e:int,m:string>>"


def _spans(matches: Column, pieces: Column) -> Column:
    """Start, end (exclusive) and match of each match, in code points."""

    def one(i: Column) -> Column:
        # pieces has one entry more than matches
        before, match = F.get(pieces, i), F.get(matches, i)
        return F.struct(F.length(before).alias("gap"), F.length(match).alias("len"), match.alias("m"))

    def chunk(c: Column) -> Column:
        numbers = F.sequence(c * CHUNK, F.least((c + 1) * CHUNK, F.size(matches)) - 1)
        return F.aggregate(
            F.transform(numbers, one),
            F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out")),
            lambda acc, x: F.struct(
                (acc["at"] + x["gap"] + x["len"]).alias("at"),
                F.array_append(
                    acc["out"],
                    F.struct(
                        (acc["at"] + x["gap"]).alias("s"),
                        (acc["at"] + x["gap"] + x["len"]).alias("e"),
                        x["m"].alias("m"),
                    ),
                ).alias("out"),
            ),
        )

    def moved(acc: Column, part: Column) -> Column:
        shifted = F.transform(
            part["out"],
            lambda x: F.struct(
                (x["s"] + acc["at"]).alias("s"), (x["e"] + acc["at"]).alias("e"), x["m"].alias("m")
            ),
        )
        return F.struct((acc["at"] + part["at"]).alias("at"), F.concat(acc["out"], shifted).alias("out"))

    chunks = F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / CHUNK).cast("int"))
    return F.aggregate(
        F.transform(chunks, chunk),
        F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out")),
        moved,
        lambda acc: acc["out"],
    )


def _near(s: Column, e: Column) -> Column:
    """Surroundings of a span, from the blocks they lie in: a text is not walked for each span."""

    def part(low: Column, length: Column) -> Column:
        block = F.floor(low / BLOCK).cast("int")
        two = F.concat(F.coalesce(F.get("blocks", block), F.lit("")), F.coalesce(F.get("blocks", block + 1), F.lit("")))
        return F.substring(two, low - block * BLOCK + 1, length)

    low = F.greatest(s - BEFORE, F.lit(0))
    return F.concat(part(low, s - low), F.lit(" "), part(e, F.lit(AFTER)))


def _judged(kind: Kind, number: int) -> Column:
    """The spans of one kind that pass its check and reach its least score."""
    spans = F.when(
        F.size(f"m{number}") > 0, _spans(F.col(f"m{number}"), F.col(f"p{number}"))
    ).otherwise(F.array().cast(_SPAN))
    if kind.valid is not None:
        spans = F.filter(spans, lambda x: kind.valid(x["m"]))

    def scored(x: Column) -> Column:
        backed = F.regexp_like(_near(x["s"], x["e"]), F.lit(rf"(?i)\b(?:{kind.words})\b"))
        return F.struct(
            F.lit(kind.name).alias("kind"),
            F.lit(number).alias("place"),
            x["s"].alias("s"),
            x["e"].alias("e"),
            (F.lit(kind.score) + F.when(backed, F.lit(0.2)).otherwise(F.lit(0.0))).alias("score"),
            F.lit(kind in BASE).alias("base"),
        )

    return F.filter(F.transform(spans, scored), lambda x: x["score"] >= kind.least)


def find_pii(
    df: DataFrame, key: list[str], text: str = "text", kinds: tuple[Kind, ...] = BASE + ADDED
) -> DataFrame:
    """``key`` and ``spans``: per row all spans as (kind, place of the kind, s, e, score, base).

    Spans are ordered by start, then by kind. Matches of one kind do not overlap: a match that
    fails its check is dropped and not tried again from a later start; kinds may overlap.
    The score is the kind's own, plus 0.2 if one of its words stands within 48 code points
    before or 24 after; the method's own kinds need a score of 0.5, base kinds stay.
    A null text counts as empty and has no spans. Repeated rows give repeated results. Only
    the named columns are read, so others may have any name.
    """
    rows = df.select(
        *[F.col(f"`{c}`").alias(f"key{i}") for i, c in enumerate(key)],
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    none = F.array().cast("array<string>")
    for number, kind in enumerate(kinds):
        may = F.contains("text", F.lit(kind.hint)) if kind.hint else F.lit(True)
        rows = rows.withColumn(f"m{number}", F.when(may, F.regexp_extract_all("text", F.lit(kind.pattern), F.lit(0))).otherwise(none))
    for number, kind in enumerate(kinds):
        some = F.size(f"m{number}") > 0
        rows = rows.withColumn(f"p{number}", F.when(some, F.split("text", kind.pattern, -1)).otherwise(none))
    any_match = reduce(Column.__or__, [F.size(f"m{number}") > 0 for number in range(len(kinds))], F.lit(False))
    cut = F.regexp_extract_all("text", F.lit(rf"(?s).{{1,{BLOCK}}}"), F.lit(0))
    rows = rows.withColumn("blocks", F.when(any_match, cut).otherwise(none))
    found = [_judged(kind, number) for number, kind in enumerate(kinds)]
    every = F.array_sort(
        F.concat(*found),
        lambda a, b: F.when(a["s"] != b["s"], a["s"] - b["s"]).otherwise(a["place"] - b["place"]),
    )
    return rows.select(*[F.col(f"key{i}").alias(c) for i, c in enumerate(key)], every.alias("spans"))


def joined(spans: Column, base_only: bool = False, with_score: bool = False) -> Column:
    """Spans as ``kind:start:end``, comma-joined; with the score as a fourth part if asked."""
    chosen = F.filter(spans, lambda x: x["base"]) if base_only else spans

    def text(x: Column) -> Column:
        parts = [x["kind"], x["s"].cast("string"), x["e"].cast("string")]
        if with_score:
            parts.append(F.format_number(x["score"], 1))
        return F.concat_ws(":", *parts)

    return F.array_join(F.transform(chosen, text), ",")
