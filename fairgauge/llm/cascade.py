"""URL filters by a Bloom filter cascade (operator 7, DataFrame functions only).

Level 0 encodes the listed keys. Level 1 encodes the keys of the corpus that level 0
takes for listed although they are not, level 2 the listed keys that level 1 takes
for unlisted, and so on until no key of the corpus is judged wrongly. A key is then
judged by the first level that does not hold it: exact for every key of the corpus,
without a join. A level is an array of 64-bit words inside the plan; its size is
checked against ``max_words``.

A rule is (host, path). Its key is host + path. The candidate keys of a URL are its
host's suffixes of as many labels as some rule has, each with the leading characters
of its path, as many as some rule has; so the number of candidates per URL is bounded
by the rules. The longest listed candidate (then the longest host) wins.

Defined cases: a null URL or one without ``://`` has an empty host and path, fits no
rule and is allowed; repeated rows are judged alike; an empty table gives an empty
result; an empty path does not start with a rule's ``/``; without rules all is allowed.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairgauge.llm.common import ascii_lower, materialise

#: 64-bit words of one level at most (8 MB), and hash functions of a level.
MAX_WORDS = 1 << 20
HASHES = 7
#: Bits per key: HASHES / ln 2, which fills half of the bits.
BITS_PER_KEY = HASHES / math.log(2)


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def key(self) -> str:
        return self.host + self.path


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    start = F.locate("://", url)
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    tail = F.substring(rest, F.length(host) + 1, F.length(rest))
    path = F.regexp_extract(tail, r"^([^?#]*)", 1)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def candidates(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Every key of a URL that has a rule's number of host labels and path length."""
    labels = sorted({r.host.count(".") + 1 for r in rules})
    lengths = sorted({len(r.path) for r in rules})
    dots = F.size(F.split(host, r"\."))
    found = [
        F.when(
            (dots >= n) & (F.length(path) >= m),
            F.struct(
                (F.length(F.substring_index(host, ".", -n)) + m).alias("length"),
                F.length(F.substring_index(host, ".", -n)).alias("host_length"),
                F.concat(F.substring_index(host, ".", -n), F.substring(path, 1, m)).alias("key"),
            ),
        )
        for n in labels
        for m in lengths
    ]
    if not found:
        return F.expr("cast(array() as array<struct<length:int,host_length:int,key:string>>)")
    return F.array_compact(F.array(*found))


class Level:
    """One Bloom filter; ``words`` are its bits."""

    def __init__(self, n_words: int, words: dict[int, int]):
        self.n_words = n_words
        self.words = [words.get(i, 0) for i in range(n_words)]

    @staticmethod
    def places(key: Column, n_words: int, level: int) -> list[tuple[Column, Column]]:
        """(word, bit) of each hash function; a level has its own."""
        out = []
        for k in range(HASHES):
            h = F.xxhash64(key, F.lit(level * HASHES + k))
            bit = F.pmod(h, F.lit(n_words * 64))
            out.append((F.shiftright(bit, 6).cast("int"), (bit % 64).cast("int")))
        return out

    @classmethod
    def build(cls, keys: DataFrame, n_keys: int, level: int, max_words: int) -> Level:
        n_words = max(1, math.ceil(n_keys * BITS_PER_KEY / 64))
        if n_words > max_words:
            raise ValueError(f"level {level} needs {n_words} words; the limit is {max_words}")
        places = F.array(*[F.struct(w.alias("w"), b.alias("b")) for w, b in cls.places(F.col("key"), n_words, level)])
        rows = (
            keys.select(F.inline(places))
            .groupBy("w")
            .agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("bits"))
            .collect()  # n_words rows at most
        )
        return cls(n_words, {r.w: r.bits for r in rows})

    def holds(self, key: Column, level: int) -> Column:
        # One folded literal; F.lit(list) would be an expression per word.
        words = F.from_json(F.lit(json.dumps(self.words)), "array<bigint>")
        hit = F.lit(True)
        for w, b in self.places(key, self.n_words, level):
            hit = hit & (F.expr("1L").bitwiseAND(_shift(F.get(words, w), b)) == 1)
        return hit


def _shift(word: Column, bit: Column) -> Column:
    return F.call_function("shiftrightunsigned", word, bit)


class Cascade:
    """Exact membership of the corpus's keys in the list."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    @classmethod
    def build(cls, listed: DataFrame, universe: DataFrame, max_words: int = MAX_WORDS) -> Cascade:
        """``listed`` and ``universe``: distinct ``key`` columns. Keys of the list that
        the corpus lacks are encoded too, so they are judged rightly as well."""
        unlisted = universe.join(listed, "key", "left_anti")
        levels: list[Level] = []
        inside, outside = listed, unlisted  # what this level encodes, what it must not hold
        while (n := inside.count()) or not levels:
            level = Level.build(inside, n, len(levels), max_words)
            levels.append(level)
            wrong = materialise(outside.where(level.holds(F.col("key"), len(levels) - 1)), "cascade-wrong")
            inside, outside = wrong, inside
        return cls(levels)

    def lists(self, key: Column) -> Column:
        out = F.lit(len(self.levels) % 2 == 1)
        for i in range(len(self.levels) - 1, -1, -1):
            out = F.when(self.levels[i].holds(key, i), out).otherwise(F.lit(i % 2 == 1))
        return out


def filter_urls(
    pages: DataFrame, rules: Sequence[Rule], default: str = "allow", id_col: str = "page_id", max_words: int = MAX_WORDS
) -> DataFrame:
    """``id_col``, host, path, rule (its key, or null) and verdict of each URL."""
    spark = pages.sparkSession
    host, path = split_url(F.col("url"))
    urls = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    universe = materialise(
        urls.select(F.explode(candidates(F.col("host"), F.col("path"), rules).getField("key")).alias("key")).distinct(),
        "cascade-universe",
    )
    keys = F.array(*[F.lit(k) for k in sorted({r.key for r in rules})]).cast("array<string>")
    listed = spark.range(1).select(F.explode(keys).alias("key"))
    cascade = Cascade.build(listed, universe, max_words)
    verdicts = F.create_map(*[F.lit(x) for r in rules for x in (r.key, r.verdict)]) if rules else None
    best = F.array_max(F.filter("found", lambda c: cascade.lists(c["key"])))
    out = urls.withColumn("found", candidates(F.col("host"), F.col("path"), rules)).withColumn(
        "rule", best.getField("key")
    )
    verdict = F.coalesce(verdicts[F.col("rule")], F.lit(default)) if rules else F.lit(default)
    return out.select(id_col, "host", "path", "rule", verdict.alias("verdict"))
