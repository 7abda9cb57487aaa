"""Sampled SentencePiece segmentations (forward filtering, backward sampling).

The forward pass sums the weights of all ways to reach each position of a chunk (a word
with the spaces before it); the backward pass draws the last piece in proportion to what
reaches its start times its weight, then the piece before it, and so on. That is an exact
draw of a segmentation in proportion to its weight. The numbers drawn depend on the seed,
the row's key and the position in the row alone, so a row is cut the same way every time.
"""

from __future__ import annotations

from itertools import islice
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import Batches, map_rows
from riskflow.llm.pieces import CHUNK, Lattice, Vocabulary, load, spelt_out

SEED, TEMPERATURE = 17, 1.0
GROUP = 1 << 18  # characters sampled together
HELD = 1 << 20  # edges of known chunks that a task keeps, 16 bytes each, and half as much again while more are added; beyond, the half seen most often
GOLDEN, MIX1, MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def uniform(seed: np.ndarray, step: int) -> np.ndarray:
    """Numbers in [0, 1) for (seed, step), by splitmix64."""
    x = seed + GOLDEN * np.array([step + 1], np.uint64)
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) * 2.0**-53


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size."""
    stop = np.cumsum(size)
    return np.repeat(start - (stop - size), size) + np.arange(int(stop[-1]) if len(stop) else 0)


class Numbers(dict):
    """Chunks numbered in the order in which they are first looked up."""

    def __missing__(self, chunk: str) -> int:
        self[chunk] = number = len(self)
        return number


class Sampler:
    """Draws segmentations; the lattices of chunks seen before are kept up to a bound."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.number = Numbers()
        self.used = np.empty(0, np.int64)  # how often each chunk was seen, halved whenever some are forgotten
        self.last, self.first = np.empty(0, np.int64), np.empty(0, np.int64)
        self.head = np.zeros(1, np.int64)  # first edge of each node
        self.below = np.empty(0)  # share of the edges before and with this one
        self.source, self.piece = np.empty(0, np.int32), np.empty(0, np.int32)

    def _forget(self) -> None:
        """Keep the chunks seen most often, as far as their edges are half of HELD."""
        edges = self.head[self.last + 1] - self.head[self.first]
        order = np.argsort(-self.used, kind="stable")
        kept = np.sort(order[np.cumsum(edges[order]) <= HELD // 2])
        names = list(self.number)
        self.number = Numbers(zip(map(names.__getitem__, kept.tolist()), range(len(kept))))
        edges, first, nodes = edges[kept], self.first[kept], self.last[kept] - self.first[kept] + 1
        at = ranges(first, nodes)
        many = self.head[at + 1] - self.head[at]
        place = ranges(self.head[first], edges)
        self.used = self.used[kept] // 2
        self.last = np.cumsum(nodes) - 1
        self.first = self.last - nodes + 1
        self.head = np.concatenate([[0], np.cumsum(many)])
        self.below, self.piece = self.below[place], self.piece[place]
        self.source = self.source[place] + np.repeat((self.first - first).astype(np.int32), edges)

    def _learn(self, chunks: list[str]) -> None:
        lattice = Lattice(self.vocabulary, chunks)
        below = lattice.share(lattice.forward())
        stop = lattice.head[1:]
        edge = lattice.head[:-1] + 1
        while True:  # node by node, so that a chunk's shares do not depend on the others
            more = np.flatnonzero(edge < stop)
            if not len(more):
                break
            edge, stop = edge[more], stop[more]
            below[edge] += below[edge - 1]
            edge += 1
        below[lattice.head[1:][np.diff(lattice.head) > 0] - 1] = 1.0
        nodes, edges = len(self.head) - 1, len(self.piece)
        self.last = np.concatenate([self.last, lattice.last + nodes])
        self.first = np.concatenate([self.first, lattice.first + nodes])
        self.head = np.concatenate([self.head[:-1], lattice.head + edges])
        self.below = np.concatenate([self.below, below])
        self.source = np.concatenate([self.source, (lattice.source + nodes).astype(np.int32)])
        self.piece = np.concatenate([self.piece, lattice.piece.astype(np.int32)])

    def sample(self, chunks: list[str], row: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks' pieces in order, and how many each chunk has. `row` and
        `place` are each chunk's row seed and number in its row."""
        if len(self.piece) > HELD:
            self._forget()
        known = len(self.number)
        which = np.fromiter(map(self.number.__getitem__, chunks), np.int64, len(chunks))
        if len(self.number) > known:
            self._learn(list(islice(self.number, known, None)))
        seen = np.bincount(which, minlength=len(self.number))
        seen[: len(self.used)] += self.used
        self.used = seen
        seed = row + GOLDEN * (place.astype(np.uint64) << np.uint64(20))
        node, start = self.last[which], self.first[which]
        active, drawn, steps = np.arange(len(chunks)), [], np.zeros(len(chunks), np.int64)
        step = 0
        while len(active):
            u = uniform(seed[active], step)
            edge = self.head[node]
            late = np.flatnonzero(self.below[edge] <= u)
            while len(late):
                edge[late] += 1
                late = late[self.below[edge[late]] <= u[late]]
            drawn.append((active, self.piece[edge]))
            node = self.source[edge]
            on = node != start
            steps[active[~on]] = step + 1
            active, node, start, step = active[on], node[on], start[on], step + 1
        after = np.cumsum(steps)
        out = np.empty(int(after[-1]) if len(after) else 0, np.int64)
        for s, (who, piece) in enumerate(drawn):  # the last piece was drawn first
            out[after[who] - 1 - s] = piece
        ids, size = spelt_out(out, self.vocabulary)
        if len(ids) != len(out):
            chunk_of = np.repeat(np.arange(len(chunks)), steps)
            steps = np.bincount(chunk_of, size, len(chunks)).astype(np.int64)
        return ids, steps


def encode_batch(sampler: Sampler, texts: list[str | None], seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, and how many each has."""
    parts, sizes = [], np.zeros(len(texts), np.int64)
    chunks: list[str] = []
    spans: list[tuple[int, int, int]] = []  # text, number of the first chunk, chunks
    chars = 0

    def draw() -> None:
        nonlocal chars
        if chunks:
            of = np.array([s[0] for s in spans])
            n = np.array([s[2] for s in spans])
            owner = np.repeat(of, n)
            place = np.concatenate([np.arange(first, first + count) for _, first, count in spans])
            ids, steps = sampler.sample(chunks, seeds[owner], place)
            parts.append(ids)
            np.add.at(sizes, owner, steps)
        chunks.clear()
        spans.clear()
        chars = 0

    for i, text in enumerate(texts):
        found = CHUNK.findall(text) if text else []
        for first in range(0, len(found), GROUP // 8):  # a very long text goes in parts
            part = found[first : first + GROUP // 8]
            chunks.extend(part)
            spans.append((i, first, len(part)))
            chars += sum(map(len, part)) if len(found) > GROUP // 8 else len(text)
            if chars > GROUP:
                draw()
    draw()
    return np.concatenate(parts or [np.empty(0, np.int64)]), sizes


def decode(ids, vocabulary: Vocabulary) -> str:
    """The text that was encoded. Ids that are no encoding of one may raise an error."""
    return b"".join(map(vocabulary.raw.__getitem__, ids)).decode()


def tempered(vocabulary: Vocabulary, temperature: float) -> Vocabulary:
    """Weights to the power 1 / temperature: under 1 draws the likely more often."""
    return vocabulary.weighted(vocabulary.logs / temperature)


def encode(
    docs: DataFrame,
    vocabulary: Vocabulary | None = None,
    seed: int = SEED,
    temperature: float = TEMPERATURE,
    key: str = "doc_id",
    text: str = "text",
    check: bool = False,
) -> DataFrame:
    """Columns `key` and piece_ids (array of int), a row per row of `docs`; with `check`
    also `lossless`, whether the ids, decoded in the same pass, give the text back.

    NULL texts have NULL, empty texts no ids. Rows of equal key and text are cut alike,
    so are rows whose key is NULL. A very long text is cut whole, in parts. An empty table
    gives an empty one. Other columns are ignored, whatever their names.
    """
    weights = tempered(vocabulary or load(), temperature)
    names = ["key", "piece_ids", *(["lossless"] if check else [])]

    def rows(batches: Batches) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(weights)
        for batch in batches:
            seeds = batch.column(2).to_numpy().view(np.uint64)
            size, at = pc.utf8_length(batch.column(1)).fill_null(0).to_pylist(), 0
            while at < batch.num_rows:  # a batch goes on as soon as a group is done
                upto, chars = at, 0
                while upto < batch.num_rows and (upto == at or chars + size[upto] <= GROUP):
                    chars += size[upto]
                    upto += 1
                texts = batch.column(1).slice(at, upto - at)
                ids, sizes = encode_batch(sampler, texts.to_pylist(), seeds[at:upto])
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32(), mask=np.append(texts.is_null().to_numpy(False), False))
                lists = pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))
                columns = [batch.column(0).slice(at, upto - at), lists]
                if check:
                    columns.append(pa.array(given_back(ids, sizes, texts.to_pylist(), weights), pa.bool_()))
                yield pa.RecordBatch.from_arrays(columns, names)
                at = upto

    kind = docs.schema[key].dataType.simpleString()
    seeded = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(F.lit(seed), key).alias("seed"))
    schema = f"key {kind}, piece_ids array<int>" + (", lossless boolean" if check else "")
    return map_rows(seeded, rows, schema).withColumnRenamed("key", key)


def given_back(ids: np.ndarray, sizes: np.ndarray, texts: list[str | None], vocabulary: Vocabulary) -> list[bool | None]:
    """For each text whether its ids decode to it; None for None."""
    pieces = pa.array(vocabulary.raw, pa.large_binary()).take(pa.array(ids))
    _, offsets, data = pieces.buffers()
    ends = np.frombuffer(offsets, np.int64)[: len(ids) + 1][np.concatenate([[0], np.cumsum(sizes)])]
    found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(ends), data])
    return pc.equal(found, pa.array(texts, pa.large_string()).cast(pa.large_binary())).to_pylist()


def decoded(encoded: DataFrame, vocabulary: Vocabulary | None = None, key: str = "doc_id", ids: str = "piece_ids") -> DataFrame:
    """Columns `key` and text from the ids; NULL for NULL."""
    known = vocabulary or load()

    def rows(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if x.as_py() is None else decode(x.as_py(), known) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["key", "text"])

    kind = encoded.schema[key].dataType.simpleString()
    return map_rows(encoded.select(F.col(key).alias("key"), ids), rows, f"key {kind}, text string").withColumnRenamed("key", key)
