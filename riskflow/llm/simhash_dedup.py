"""Near duplicates by SimHash, found through the anchors of a covering code.

Two fingerprints of 64 bits that differ in at most 3 bits differ in at most one bit of
one half. The first 31 bits of a half are compared through the Hamming code of that
length: every word lies within 1 bit of exactly one code word, so a fingerprint sent to
all code words (anchors) within covering radius plus threshold, 1 + 1 bits, meets every
fingerprint within 1 bit at that one's nearest anchor. That is at most 16 anchors a half,
out of 2^26: the rows compared at an anchor stay few up to billions of fingerprints.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import Batches, map_rows, stored, unused, words_of
from riskflow.llm.components import components
from riskflow.schemas import quoted

SHINGLE, SEED, DISTANCE = 3, 42, 3
HALVES = (0, 32)  # first bit of each half
SLIDE = 64  # groups up to this size are compared row by shifted row
DENSE = 1 << 13  # anchors with more fingerprints are cut by a second, shorter code
BLOCK = 1 << 16  # hashes whose bits are counted at once


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a text's word shingles, repeats counted; 0 without words."""
    words = words_of(text)
    if not words:
        return 0
    rows = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in rows), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        part = hashes[at : at + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns key, row (a hash of the whole row) and fp (the fingerprint as a signed long)."""

    def rows(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.view(np.int64))], ["key", "row", "fp"])

    kind = docs.schema[key].dataType.simpleString()
    given = docs.select(F.col(quoted(key)).alias("key"), row_hash(docs).alias("row"), F.col(quoted(text)).alias("text"))
    return map_rows(given, rows, f"key {kind}, row long, fp long")


def row_hash(docs: DataFrame) -> Column:
    """64 bits over all columns, NULLs included."""
    return F.xxhash64(*[x for c in docs.columns for x in (F.col(quoted(c)), F.col(quoted(c)).isNull())])


def covering(values: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and code words of all code words within 2 bits of each value.

    The values have 2^order - 1 bits, the code is the Hamming code of that length:
    bit p (from 1) counts p in the syndrome, so flipping bits i and i ^ syndrome (0:
    none) leads to a code word, and every code word within 2 bits is reached this way.
    """
    size = 1 << order
    bit = np.concatenate([[0], 1 << np.arange(size - 1)]).astype(np.uint64)
    place = np.arange(size)
    syndrome = np.zeros(len(values), np.int64)
    for k in range(order):
        mask = bit[(place >> k) & 1 == 1].sum(dtype=np.uint64)
        syndrome |= (np.bitwise_count(values & mask) & 1).astype(np.int64) << k
    other = place[None, :] ^ syndrome[:, None]
    fits = (place[None, :] < other) | ((syndrome == 0)[:, None] & (place == 0)[None, :])
    row, i = np.nonzero(fits)
    return row, values[row] ^ bit[i] ^ bit[other[row, i]]


def _bits(fp: np.ndarray, first: int, order: int) -> np.ndarray:
    return (fp >> np.uint64(first)) & np.uint64((1 << ((1 << order) - 1)) - 1)


def _visits(batches: Batches) -> Iterator[pa.RecordBatch]:
    """Each fingerprint once per anchor: anchor (half and code word) and fp."""
    for batch in batches:
        fp = batch.column(0).to_numpy().view(np.uint64)
        for half, first in enumerate(HALVES):
            row, word = covering(_bits(fp, first, 5), 5)
            anchor = (word | np.uint64(half << 31)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(fp[row].view(np.int64))], ["anchor", "fp"])


def _finer_visits(batches: Batches) -> Iterator[pa.RecordBatch]:
    """The same within an anchor: part (quarter of the other half, and code word of it).

    Links of the anchor's half differ in up to 3 bits of the other one, so in at most one
    bit of one of its quarters, and meet at that quarter's code words.
    """
    for batch in batches:
        anchor = batch.column(0).to_numpy()
        fp = batch.column(1).to_numpy().view(np.uint64)
        for half, other in ((0, HALVES[1]), (1, HALVES[0])):
            of_half = np.flatnonzero(anchor >> 31 == half)
            for quarter in (0, 16):
                row, word = covering(_bits(fp[of_half], other + quarter, 4), 4)
                part = 1 + (word.view(np.int64) | quarter << 15)
                here = of_half[row]
                yield pa.RecordBatch.from_arrays([pa.array(anchor[here]), pa.array(part), pa.array(fp[here].view(np.int64))], ["anchor", "part", "fp"])


def _forest(fp: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect the group as all its links would, at most one per member."""
    found, rest = [], fp
    while len(rest):
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            node = front.pop()
            near = np.bitwise_count(rest ^ node) <= distance
            if near.any():
                linked = rest[near]
                found.append((np.full(len(linked), node), linked))
                front.extend(linked)
                rest = rest[~near]
    return found


def group_links(group: np.ndarray, fp: np.ndarray, distance: int = DISTANCE) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links inside the groups of rows with equal group number; the rows are sorted by it."""
    edges = np.flatnonzero(np.diff(group)) + 1
    start = np.concatenate([[0], edges])
    size = np.diff(np.concatenate([start, [len(group)]]))
    found = []
    small = np.repeat(size <= SLIDE, size)
    near_group, near_fp = group[small], fp[small]
    for d in range(1, min(SLIDE, int(size[size <= SLIDE].max(initial=0)))):
        same = np.flatnonzero(near_group[d:] == near_group[:-d])
        a, b = near_fp[same], near_fp[same + d]
        near = np.bitwise_count(a ^ b) <= distance
        found.append((a[near], b[near]))
    for at, n in zip(start[size > SLIDE], size[size > SLIDE]):
        found += _forest(fp[at : at + n], distance)
    return found


def _links(distance: int):
    """Rows sorted by anchor and part, to links; a group that goes on in the next batch is held back."""

    def batch_of(groups: list[np.ndarray], prints: list[np.ndarray]) -> pa.RecordBatch:
        found = group_links(np.concatenate(groups), np.concatenate(prints), distance)
        a = np.concatenate([f[0] for f in found] or [np.empty(0, np.uint64)])
        b = np.concatenate([f[1] for f in found] or [np.empty(0, np.uint64)])
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    def rows(batches: Batches) -> Iterator[pa.RecordBatch]:
        groups: list[np.ndarray] = []
        prints: list[np.ndarray] = []
        last, number = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            anchor, part = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            new = np.concatenate([[(anchor[0], part[0]) != last], (np.diff(anchor) != 0) | (np.diff(part) != 0)])
            group = number + np.cumsum(new)
            fp = batch.column(2).to_numpy().view(np.uint64)
            last, number = (anchor[-1], part[-1]), int(group[-1])
            held = int(np.searchsorted(group, number))
            groups.append(group[:held])
            prints.append(fp[:held])
            if held or new[0] and len(groups) > 1:
                yield batch_of(groups, prints)
                groups, prints = [], []
            groups.append(group[held:])
            prints.append(fp[held:])
        if groups:
            yield batch_of(groups, prints)

    return rows


def grouped_visits(distinct: DataFrame, dense: int = DENSE) -> DataFrame:
    """Columns anchor, part and fp: fingerprints (column fp) by the groups they are compared in.

    Anchors with more than `dense` fingerprints are found by a count first, and their rows
    dealt by a second code, so Spark spreads a hot anchor over tasks.
    """
    visits = map_rows(distinct.select("fp"), _visits, "anchor long, fp long")
    sizes = visits.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    hot = stored(sizes.where(F.col("n") > dense).select("anchor"), "hot_anchors")
    whole = visits.withColumn("part", F.lit(0).cast("long"))
    if hot.isEmpty():
        return whole.select("anchor", "part", "fp")
    finer = map_rows(visits.join(hot, "anchor", "left_semi"), _finer_visits, "anchor long, part long, fp long")
    return whole.join(hot, "anchor", "left_anti").select("anchor", "part", "fp").unionByName(finer)


def near_links(distinct: DataFrame, distance: int = DISTANCE, dense: int = DENSE) -> DataFrame:
    """Links a, b between distinct fingerprints (column fp) within `distance` bits.

    Between rows that a group already connects no further link is made, so a large group
    of near copies gives about as many links as it has members.
    """
    if distance > DISTANCE:
        raise ValueError(f"the anchors cover at most {DISTANCE} bits")
    groups = grouped_visits(distinct, dense).repartition("anchor", "part").sortWithinPartitions("anchor", "part")
    return map_rows(groups, _links(distance), "a long, b long")


def rooted(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """The rows of stored distinct fingerprints, with the root of their component."""
    linked = components(near_links(distinct, distance))
    named = linked.select(F.col("a").alias("fp"), F.col("b").alias("root"))
    return distinct.join(named, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Columns doc_id, fingerprint (16 hexadecimal digits) and component_id (smallest
    doc_id reachable over links of at most `distance` bits), a row per row of `docs`.

    Equal fingerprints are one row until the very end, so copies cost nothing in the
    search; there the component is joined to one row per fingerprint, which a skewed
    join can split. A NULL text has fingerprint zero, like one without words. A NULL key
    never becomes a component_id; rows linked to none but such rows have NULL there.
    Rows that repeat a key each have their row. Other columns are ignored.
    """
    marked = stored(fingerprints(docs, shingle, key, text), "fingerprints")
    distinct = stored(marked.groupBy("fp").agg(F.min("key").alias("least")), "distinct_fingerprints")
    roots = rooted(distinct, distance)
    named = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    members = roots.join(named, "root").select("fp", "component_id")
    found = marked.join(members, "fp")
    return found.select(F.col("key").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(
    docs: DataFrame,
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The rows of `docs` without near duplicates: of each group the row with the smallest
    key stays and, of rows with one key, that with the smallest hash of the row.

    Groups as in `near_duplicates`. Rows with one key and other texts are rows like any
    others, each in the group of its text; a row that is there several times stays once.
    Rows without a key stay. Fingerprints and hashes alone are searched; the texts are
    moved once, after equal rows were combined.
    """
    marked = stored(fingerprints(docs, shingle, key, text), "fingerprints")
    rank = F.struct("key", "row")
    named = marked.where("key IS NOT NULL")
    distinct = stored(named.groupBy("fp").agg(F.min(rank).alias("first")), "distinct_fingerprints")
    first = rooted(distinct, distance).groupBy("root").agg(F.min("first").alias("first"))
    name, row = unused(docs, "name"), unused(docs, "row")
    stays = first.select(F.xxhash64("first.key").alias(name), F.col("first.row").alias(row))
    whole = docs.withColumns({name: F.xxhash64(F.col(quoted(key))), row: row_hash(docs)})
    keyed = whole.where(F.col(quoted(key)).isNotNull()).dropDuplicates([name, row])
    kept = keyed.join(stays, [name, row], "left_semi").select(*[quoted(c) for c in docs.columns])
    return kept.unionByName(docs.where(F.col(quoted(key)).isNull()))
