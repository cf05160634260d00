"""URL filters by a bit-parallel wildcard automaton over many rules at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from minutefold.llm.work import ascii_lower

#: URLs simulated side by side.
BLOCK = 4096


@dataclass(frozen=True)
class Rule:
    """A host and the start of a path; fits the host and all its subdomains."""

    name: str
    verdict: str

    @property
    def globs(self) -> tuple[str, ...]:
        return f"{self.name}**", f"*.{self.name}**"


#: The rules by host and path, and what the method itself blocks.
RULES = (
    Rule("net/", "block"),
    Rule("example.net/en/", "allow"),
    Rule("example.com/de/", "block"),
    Rule("org/fr/", "allow"),
)
BLOCKED_GLOBS = ("**/wp-admin/**", "**/cgi-bin/**", "**.exe", "**.zip", "*.onion/**")


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.when(F.contains(url, F.lit("://")), ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))).otherwise("")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.when(F.contains(url, F.lit("://")), F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)).otherwise("")


class GlobAutomaton:
    """Shift-And over the bits of all patterns, packed into words of 64.

    ``*`` is any run without ``/``, ``**`` any run, ``?`` one byte that is not ``/``; patterns
    cover the whole text. A pattern of m signs takes m + 1 bits; bit i says that its first i
    signs match up to here. A step moves every bit whose next sign fits the byte one place on
    and keeps those that stand at a wildcard which may take the byte.
    """

    def __init__(self, globs: list[str]):
        bits, states = 0, []
        for glob in globs:
            signs, loops, at = [], {}, 0
            raw = glob.encode()
            while at < len(raw):
                if raw[at : at + 2] == b"**":
                    loops[len(signs)], at = "any", at + 2
                elif raw[at : at + 1] == b"*":
                    loops.setdefault(len(signs), "host")
                    at += 1
                else:
                    signs.append(raw[at])
                    at += 1
            states.append((bits, signs, loops))
            bits += len(signs) + 1
        self.words = bits // 64 + 1
        self.start = np.zeros(self.words, np.uint64)
        self.move = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        self.accept = []
        for first, signs, loops in states:
            self._set(self.start, first)
            for i, sign in enumerate(signs):
                for byte in range(256):
                    if sign == byte or (sign == ord("?") and byte != ord("/")):
                        self._set(self.move[byte], first + i)
            for i, kind in loops.items():
                for byte in range(256):
                    if kind == "any" or byte != ord("/"):
                        self._set(self.stay[byte], first + i)
            self.accept.append(first + len(signs))

    @staticmethod
    def _set(row: np.ndarray, bit: int) -> None:
        row[bit // 64] |= np.uint64(1) << np.uint64(bit % 64)

    def matches(self, texts: list[bytes]) -> np.ndarray:
        """A row per text and a column per pattern: whether it matches."""
        found = np.zeros((len(texts), len(self.accept)), bool)
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        for at in range(0, len(order), BLOCK):
            block = order[at : at + BLOCK]
            found[block] = self._run([texts[i] for i in block])
        return found

    def _run(self, texts: list[bytes]) -> np.ndarray:
        """Texts by falling length; each keeps its bits from where it ends."""
        lengths = np.array([len(t) for t in texts])
        joined = np.frombuffer(b"".join(texts), np.uint8)
        begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        now = np.tile(self.start, (len(texts), 1))
        one, top = np.uint64(1), np.uint64(63)
        live = len(texts)
        for t in range(int(lengths[0])):
            while lengths[live - 1] <= t:
                live -= 1
            byte = joined[begins[:live] + t]
            moving = now[:live] & self.move[byte]
            shifted = moving << one
            shifted[:, 1:] |= moving[:, :-1] >> top
            now[:live] = shifted | (now[:live] & self.stay[byte])
        words, bits = np.array(self.accept) // 64, np.array(self.accept) % 64
        return (now[:, words] >> bits.astype(np.uint64)) & one > 0


def judge(
    df: DataFrame,
    key: list[str],
    url: str = "url",
    rules: tuple[Rule, ...] = RULES,
    blocked: tuple[str, ...] = BLOCKED_GLOBS,
) -> DataFrame:
    """``key``, ``host``, ``path``, ``rule`` and ``verdict`` of every row.

    Of the rules that fit the longest wins, and of equally long ones the first; without one,
    ``verdict`` is block if the method's own globs match the canonical address (host and path)
    or the address has no host, else allow. A null url and one without ``://`` have an empty
    host and path. Repeated rows give repeated results, an empty table none. Only the named
    columns are read, so others may have any name.
    """
    globs = [g for r in rules for g in r.globs] + list(blocked)
    automaton = GlobAutomaton(globs)
    per_rule = len(rules[0].globs) if rules else 1

    @F.pandas_udf(T.StructType([T.StructField("rule", T.StringType()), T.StructField("own", T.BooleanType())]))
    def simulate(address: pd.Series) -> pd.DataFrame:
        found = automaton.matches([a.encode() for a in address])
        split = per_rule * len(rules)
        fits = found[:, :split].reshape(len(address), len(rules), per_rule).any(axis=2)
        lengths = np.array([len(r.name) for r in rules])
        best = np.where(fits, lengths, 0).argmax(axis=1) if rules else np.zeros(len(address), int)
        names = [rules[b].name if f[b] else None for b, f in zip(best, fits, strict=True)] if rules else [None] * len(address)
        return pd.DataFrame({"rule": pd.Series(names, dtype=object), "own": found[:, split:].any(axis=1)})

    keys = [F.col(f"`{c}`").alias(f"key{i}") for i, c in enumerate(key)]
    parted = df.select(*keys, host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path")).withColumn("found", simulate(F.concat("host", "path")))
    verdict = F.when(F.col("found.own") | (F.col("host") == ""), "block").otherwise("allow")
    for rule in rules:
        verdict = F.when(F.col("found.rule") == rule.name, rule.verdict).otherwise(verdict)
    return parted.select(*[F.col(f"key{i}").alias(c) for i, c in enumerate(key)], "host", "path", F.col("found.rule").alias("rule"), verdict.alias("verdict"))
