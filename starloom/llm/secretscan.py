"""Operator 12: secrets in texts.

One Aho-Corasick pass over the lower-cased bytes of a text finds the rules'
keywords; a rule's regular expression is tried only where one of its keywords
begins, anchored there, and what it matches must pass the rule's own test.
The added kinds carry a checksum inside, which is worked out again: a token of
the right shape with a wrong checksum is no secret.

A run of hex digits has no keyword. It is looked for by the class itself, with
the least length in the expression, so that shorter runs cost no Python.

Every match uses up its text, whether it passes or not (leftmost,
non-overlapping, by kind). Positions are code points, the end exclusive.

Rows: a null text is empty; a text without secrets gives an empty list; repeated
rows are answered each; an empty table gives no rows. Texts of any length are
read whole. Other columns than doc_id and text are left out.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Callable
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import LOWER, arrow_map, table, utf8

# The alphabets of the checksums' encodings.
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BECH32 = b"qpzry9x8gf2tvdw0s3jn54khce6mua7l"
# The generator of the Bech32 checksum.
BECH32_GEN = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)


def crc_base62(found: re.Match) -> bool:
    """30 base-62 characters, then their CRC-32 in six base-62 digits."""
    body, check = found[1][:-6], found[1][-6:]
    if len(found[1]) != 36 or b"_" in found[1]:
        return False
    value = 0
    for c in check:
        value = value * 62 + BASE62.index(c)
    return value == zlib.crc32(body)


def bech32(found: re.Match) -> bool:
    """58 characters of Bech32 data whose checksum, with the prefix, is 1."""
    prefix, data = found[0][:-len(found[1]) - 1].lower(), found[1].lower()
    if len(data) != 58 or not set(data) <= set(BECH32):
        return False
    check = 1
    for v in [*(c >> 5 for c in prefix), 0, *(c & 31 for c in prefix), *(BECH32.index(c) for c in data)]:
        top = check >> 25
        check = (check & 0x1FFFFFF) << 5 ^ v
        for i, g in enumerate(BECH32_GEN):
            if top >> i & 1:
                check ^= g
    return check == 1


@dataclass(frozen=True)
class Rule:
    """kind: its name in the results. keywords: lower-case, one of them begins
    every match; none for a rule whose pattern is searched for. pattern: over
    bytes, so that the case is ASCII's. accept: the test of a match."""

    kind: str
    keywords: tuple[bytes, ...]
    pattern: re.Pattern
    accept: Callable[[re.Match], bool] = lambda found: True
    base: bool = False


def _at_least(n: int, group: int = 0) -> Callable[[re.Match], bool]:
    return lambda found: len(found[group]) >= n


# Keywords and patterns.
RULES = (
    Rule("assign", (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key"),
         re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I),
         _at_least(6, 2), True),
    Rule("access", (b"akia",), re.compile(rb"AKIA[A-Z0-9]+"), _at_least(20), True),
    Rule("hex", (), re.compile(rb"[0-9a-f]{24,}"), base=True),
    Rule("github", (b"ghp_", b"gho_", b"ghu_", b"ghs_", b"ghr_"), re.compile(rb"gh[pousr]_([0-9A-Za-z_]+)"), crc_base62),
    Rule("npm", (b"npm_",), re.compile(rb"npm_([0-9A-Za-z_]+)"), crc_base62),
    Rule("age", (b"age-secret-key-1",), re.compile(rb"AGE-SECRET-KEY-1([0-9A-Z]+)"), bech32),
    Rule("nostr", (b"nsec1",), re.compile(rb"nsec1([0-9a-z]+)"), bech32),
)


class Scanner:
    """The rules' automaton; ``scan`` gives the (start, end, rule number) of a text's bytes, in order."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.searched = [i for i, r in enumerate(rules) if not r.keywords]
        owners: dict[bytes, list[int]] = {}
        for i, r in enumerate(rules):
            for k in r.keywords:
                if k != k.translate(LOWER):
                    raise ValueError(f"keyword {k!r} has upper-case letters")
                owners.setdefault(k, []).append(i)
        self.automaton = ahocorasick.Automaton()
        for k, who in owners.items():  # bytes as Latin-1, so that positions are those of the bytes
            self.automaton.add_word(k.decode("latin-1"), (len(k), tuple(who)))
        self.automaton.make_automaton()

    def bytes_spans(self, raw: bytes) -> list[tuple[int, int, int]]:
        out = [(m.start(), m.end(), i) for i in self.searched for m in self.rules[i].pattern.finditer(raw) if self.rules[i].accept(m)]
        if len(self.automaton):
            hits = sorted((end + 1 - size, i) for end, (size, who) in self.automaton.iter(raw.translate(LOWER).decode("latin-1")) for i in who)
            done = [0] * len(self.rules)
            for at, i in hits:
                if at < done[i]:
                    continue
                if found := self.rules[i].pattern.match(raw, at):
                    done[i] = max(found.end(), at + 1)
                    if self.rules[i].accept(found):
                        out.append((at, found.end(), i))
        return sorted(out, key=lambda x: (x[0], x[2]))

    def scan(self, raw: bytes) -> list[tuple[int, int, int]]:
        out = self.bytes_spans(raw)
        if not out or raw.isascii():
            return out
        first = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)  # code points begun up to each byte
        point = lambda at: int(first[at - 1]) if at else 0
        return [(point(a), point(b), i) for a, b, i in out]


@functools.lru_cache(maxsize=1)
def scanner() -> Scanner:
    return Scanner()


def find(docs: DataFrame) -> DataFrame:
    """doc_id and ``secrets``: an array of (kind, start, end, base) by start, then by the rules' order."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        s = scanner()
        spans = [s.scan(x) if x else [] for x in utf8(b.column(1))]
        flat = [x for row in spans for x in row]
        ends = np.cumsum([0, *map(len, spans)]).astype(np.int32)
        structs = pa.StructArray.from_arrays(
            [pa.array([s.rules[i].kind for _, _, i in flat], pa.string()), pa.array([a for a, _, _ in flat], pa.int64()),
             pa.array([e for _, e, _ in flat], pa.int64()), pa.array([s.rules[i].base for _, _, i in flat], pa.bool_())],
            ["kind", "start", "end", "base"])
        return pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(ends), structs)], ["doc_id", "secrets"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", F.col("text").cast("string").alias("text")), run,
                     f"doc_id {kind}, secrets array<struct<kind: string, start: bigint, end: bigint, base: boolean>>")


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets: counts of the base kinds, the base spans' digest, and all spans."""
    found = find(table(spark, sf_dir, "documents"))
    base = F.filter("secrets", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(r.kind) for r in RULES if r.base], F.sha2(_joined(base), 256).alias("base_sha256"),
                        _joined(F.col("secrets")).alias("spans"),
                        F.size(F.filter("secrets", lambda s: ~s["base"])).cast("long").alias("n_added"))
