"""URL rules, and a block list held as a cascade of Bloom filters.

The first level of a cascade holds the listed keys, the second those other keys of the
corpus that pass the first by mistake, the third the listed keys that pass the second,
and so on until no mistake is left. Over all keys of the corpus (the universe) the answer
is exact: a key is listed if the first level that does not hold it is an even one.

Keys are dealt into shards by hash so that each shard's universe is small; a shard's
cascade is built in one task and is one row.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass
from typing import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import Batches, map_rows, stored, unused
from riskflow.schemas import quoted

SHARD_KEYS = 1 << 16  # keys of the universe in a shard, on average
BITS_PER_KEY = 8
HASHES = 3
BROADCAST_BYTES = 32 << 20  # cascades up to this size go to every task, else they are joined
GROUP_ROWS = 500_000  # of a shard that one task judges at once
ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """A host and the start of a path; fits the host and all its subdomains."""

    verdict: str
    host: str
    path: str

    def __str__(self) -> str:
        return self.host + self.path


# The rules of the query.
RULES = (
    Rule(ALLOW, "org", "/"),
    Rule(BLOCK, "example.org", "/es/"),
    Rule(BLOCK, "example.org", "/en/1"),
    Rule(ALLOW, "com", "/fr/"),
    Rule(BLOCK, "com", "/de/"),
)
# Names whose hosts the query lists.
LISTED_NAMES = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without "://" or for NULL."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def rule_fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)


def longest_rule(rules: Sequence[Rule], host: Column, path: Column, value) -> Column:
    """`value` of the longest rule that fits, or NULL; the rules are a short list."""
    chosen = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(str(r))):
        chosen = F.when(rule_fits(rule, host, path), F.lit(value(rule))).otherwise(chosen)
    return chosen


def _positions(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    """HASHES bit positions of each key in a level: double hashing, mixed per level."""
    x = hashes * np.uint64(2 * level + 3) ^ (hashes >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    a, b = x >> np.uint64(32), (x & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    return (a[:, None] + b[:, None] * np.arange(HASHES, dtype=np.uint64)) % np.uint64(size)


def _holds(bits: np.ndarray, hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    at = _positions(hashes, level, size)
    return ((bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


def _hash(keys: Sequence[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, len(keys))


class Cascade:
    """Levels of (size in bits, bits); `exact` lists listed keys that hashing cannot tell
    from others (equal 64-bit hashes), which practically never are any."""

    def __init__(self, levels: list[tuple[int, np.ndarray]], exact: Sequence[str] = (), but: Sequence[str] = ()):
        self.levels, self.exact, self.but = levels, frozenset(exact), frozenset(but)

    @classmethod
    def build(cls, listed: Sequence[str], others: Sequence[str]) -> "Cascade":
        """Exact for all keys given; the two lists have no key in common."""
        mine, theirs = _hash(listed), _hash(others)
        twice = np.intersect1d(mine, theirs)
        exact = [k for k, h in zip(listed, mine) if h in twice] if len(twice) else []
        but = [k for k, h in zip(others, theirs) if h in twice] if len(twice) else []
        held, passing = np.setdiff1d(mine, twice), np.setdiff1d(theirs, twice)
        levels: list[tuple[int, np.ndarray]] = []
        while len(held):
            size = max(64, BITS_PER_KEY * len(held))
            bits = np.zeros(size // 8 + 1, np.uint8)
            at = _positions(held, len(levels), size).ravel()
            np.bitwise_or.at(bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
            wrong = passing[_holds(bits, passing, len(levels), size)]
            levels.append((size, bits))
            held, passing = wrong, held
        return cls(levels, exact, but)

    def __contains__(self, key: str) -> bool:
        return bool(self.listed([key])[0])

    def listed(self, keys: Sequence[str]) -> np.ndarray:
        hashes = _hash(keys)
        inside = np.ones(len(keys), bool)  # held by all levels so far
        found = np.zeros(len(keys), bool)
        for level, (size, bits) in enumerate(self.levels):
            held = inside & _holds(bits, hashes, level, size)
            found[inside & ~held] = level % 2 == 1
            inside = held
        found[inside] = len(self.levels) % 2 == 1
        if self.exact or self.but:
            found = np.array([(f or k in self.exact) and k not in self.but for f, k in zip(found, keys)], bool)
        return found

    def packed(self) -> bytes:
        out = [struct.pack("<I", len(self.levels))]
        for size, bits in self.levels:
            out += [struct.pack("<Q", size), bits.tobytes()]
        for names in (self.exact, self.but):
            out.append(struct.pack("<I", len(names)))
            for name in sorted(names):
                raw = name.encode()
                out += [struct.pack("<I", len(raw)), raw]
        return b"".join(out)

    @classmethod
    def unpacked(cls, raw: bytes) -> "Cascade":
        at = 0

        def number(form: str) -> int:
            nonlocal at
            at += struct.calcsize(form)
            return struct.unpack_from(form, raw, at - struct.calcsize(form))[0]

        levels = []
        for _ in range(number("<I")):
            size = number("<Q")
            levels.append((size, np.frombuffer(raw, np.uint8, size // 8 + 1, at)))
            at += size // 8 + 1
        lists = []
        for _ in range(2):
            names = []
            for _ in range(number("<I")):
                n = number("<I")
                names.append(raw[at : at + n].decode())
                at += n
            lists.append(names)
        return cls(levels, *lists)


class UrlList:
    """Cascades of all shards (columns shard, cascade) in the shared folder."""

    def __init__(self, cascades: DataFrame, shards: int):
        self.cascades, self.shards = cascades, shards
        self.bytes = cascades.agg(F.sum(F.octet_length("cascade")).alias("n")).first()["n"] or 0

    def shard(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.shards)).cast("int")

    @classmethod
    def build(cls, universe: DataFrame, listed: DataFrame, key: str = "key", shard_keys: int = SHARD_KEYS) -> "UrlList":
        """From all keys of a corpus and the listed ones; repeats and NULLs do no harm.

        Listed keys outside the universe are part of it from then on. Each key reaches
        its shard once, so a shard has about `shard_keys` rows however often keys repeat.
        """
        both = universe.select(F.col(key).alias("key"), F.lit(False).alias("listed")).union(
            listed.select(F.col(key).alias("key"), F.lit(True).alias("listed"))
        )
        keys = stored(both.where("key IS NOT NULL").groupBy("key").agg(F.max("listed").alias("listed")), "url_keys")
        shards = 1 + keys.count() // shard_keys

        def build(part: pd.DataFrame) -> pd.DataFrame:
            cascade = Cascade.build(list(part["key"][part["listed"]]), list(part["key"][~part["listed"]]))
            return pd.DataFrame({"shard": [part["shard"].iloc[0]], "cascade": [cascade.packed()]})

        shard = F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int")
        built = keys.withColumn("shard", shard).groupBy("shard").applyInPandas(build, "shard int, cascade binary")
        return cls(stored(built, "url_cascades"), shards)

    def mark(self, df: DataFrame, key: str, out: str = "listed", broadcast_bytes: int = BROADCAST_BYTES, group_rows: int = GROUP_ROWS) -> DataFrame:
        """All rows and columns of `df` and whether the key is listed (NULL: not).

        Small cascades (measured) are sent to the tasks and rows are not moved; larger ones
        meet the rows of their shard. A shard's rows are counted first and dealt, by a hash
        of the row, to as many groups of about GROUP_ROWS as that takes; so a key with very
        many rows has many tasks, and a task that is run again has the same rows.
        """
        names = [c for c in df.columns if c != out]
        of_shard, salt = unused(df, "_shard"), unused(df, "_salt")
        if self.bytes <= broadcast_bytes:
            packed = {r["shard"]: bytes(r["cascade"]) for r in self.cascades.collect()}
            sharded = df.select(*names, self.shard(F.col(key)).alias(of_shard))
            place, schema = names.index(key), df.select(*names).withColumn(out, F.lit(False)).schema

            def rows(batches: Batches) -> Iterator[pa.RecordBatch]:
                known = {s: Cascade.unpacked(raw) for s, raw in packed.items()}
                for batch in batches:
                    keys = batch.column(place).to_pylist()
                    shard = batch.column(len(names)).to_numpy()
                    found = np.zeros(len(keys), bool)
                    for s in np.unique(shard):
                        at = np.array([i for i in np.flatnonzero(shard == s) if keys[i] is not None], np.int64)
                        if s in known and len(at):
                            found[at] = known[s].listed([keys[i] for i in at])
                    yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found)], [*names, out])

            return map_rows(sharded, rows, schema)

        sharded = df.select(*names, self.shard(F.col(key)).alias(of_shard))
        counts = sharded.groupBy(of_shard).agg(F.ceil(F.count(F.lit(1)) / group_rows).alias("groups"))
        sizes = stored(counts.select(F.col(of_shard).alias("shard"), F.col("groups").cast("int").alias("groups")), "url_shard_sizes")
        groups = unused(df, "groups")
        of_row = F.xxhash64(*[x for c in names for x in (F.col(quoted(c)), F.col(quoted(c)).isNull())])
        dealt = sharded.withColumn(salt, of_row).join(sizes.select(F.col("shard").alias(of_shard), F.col("groups").alias(groups)), of_shard)
        salted = dealt.select(*[quoted(c) for c in names], of_shard, F.pmod(F.col(salt), F.col(groups)).cast("int").alias(salt))
        copies = self.cascades.join(sizes, "shard").select(
            F.col("shard").alias(of_shard), "cascade", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias(salt)
        )

        def judge(rows: pd.DataFrame, cascade: pd.DataFrame) -> pd.DataFrame:
            listed = np.zeros(len(rows), bool)
            at = rows[key].notna().to_numpy()
            if len(cascade) and at.any():
                listed[at] = Cascade.unpacked(bytes(cascade["cascade"].iloc[0])).listed(list(rows[key][at]))
            return rows[names].assign(**{out: listed})

        schema = df.select(*names).withColumn(out, F.lit(False)).schema
        return salted.groupBy(of_shard, salt).cogroup(copies.groupBy(of_shard, salt)).applyInPandas(judge, schema)


def judge(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule] = RULES, key: str = "page_id", url: str = "url") -> DataFrame:
    """Columns page_id, host, path, rule, verdict, listed, a row per row of `pages`.

    `listed` has the blocked keys (column key: host and path). The longest rule that fits
    decides; where none does, a listed key is blocked. A NULL or empty url, and one without
    `://`, has an empty host and path. A url of any length is read whole. Rows that repeat
    one another are judged each; an empty table gives an empty one, an empty list lists
    nothing. Other columns are ignored, whatever their names.
    """
    parted = parts(pages, key, url)
    keyed = parted.withColumn("key", F.concat("host", "path"))
    marked = UrlList.build(keyed, listed).mark(keyed, "key")
    host, path = F.col("host"), F.col("path")
    verdict = F.coalesce(longest_rule(rules, host, path, lambda r: r.verdict), F.when(F.col("listed"), BLOCK).otherwise(ALLOW))
    return marked.select("page_id", "host", "path", longest_rule(rules, host, path, str).alias("rule"), verdict.alias("verdict"), "listed")


def parts(pages: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    plain = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"))
    host, path = url_parts(F.col("url"))
    return plain.select("page_id", host.alias("host"), path.alias("path"))


def keys_of_names(pages: DataFrame, names: Sequence[str] = LISTED_NAMES, url: str = "url") -> DataFrame:
    """A block list to test with: the keys of all pages on hosts that bear a name."""
    hosts = parts(pages.withColumn("page_id", F.lit(0)), url=url)
    named = F.exists(F.split("host", r"\."), lambda label: label.isin(*names))
    return hosts.where(named).select(F.concat("host", "path").alias("key"))
