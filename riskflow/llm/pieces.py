"""A SentencePiece vocabulary as weights on the segmentations of a text.

Pieces are matched against the text itself: the word-start sign of the vocabulary stands
for a space, so nothing in a text needs to be replaced and decoding gives it back as it
was. A character that is no piece is written as the pieces of its UTF-8 bytes.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, replace
from typing import Sequence

import numpy as np
import sentencepiece

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
WORD_START = "▁"
UNUSED = -1e8  # scores below mark pieces that are never chosen
ZIPF_SHIFT = 2.7
CHUNK = re.compile(r" *[^ \n]+| +|\n")


@dataclass(frozen=True)
class Vocabulary:
    """Pieces by id and their log-probabilities (natural; -inf: never chosen).

    kind, row, owner and piece describe a trie from state 0: from state s a character of
    kind k leads to the state row[s] + k if that one's owner is s; piece[state] is the id
    that ends there. kind is by code point, the last one stands for all that follow;
    0: in no piece.
    """

    raw: tuple[bytes, ...]
    logs: np.ndarray
    bytes_: np.ndarray
    kind: np.ndarray
    row: np.ndarray
    owner: np.ndarray
    piece: np.ndarray
    longest: int

    def weighted(self, logs: np.ndarray) -> "Vocabulary":
        return replace(self, logs=logs)


def load(path: str = MODEL, ranked: bool = True) -> Vocabulary:
    """Read a vocabulary on the driver; tasks get it with the function they run.

    With `ranked` the scores are merge ranks, as BPE vocabularies have them, and become
    log-probabilities by Zipf's law (a piece of rank r weighs 1 / (r + 2.7)); otherwise
    they are log-probabilities already. Pieces of single bytes rank last.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    raw, scores, bytes_ = [], np.full(size, -np.inf), np.full(256, -1, np.int64)
    usable = {}
    for i in range(size):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            bytes_[int(piece[1:-1], 16)] = i
            raw.append(bytes([int(piece[1:-1], 16)]))
            continue
        control = model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
        text = "" if control else piece.replace(WORD_START, " ")
        raw.append(text.encode())
        if text and model.get_score(i) > UNUSED:
            if " " in text.lstrip(" ") or "\n" in text:
                raise ValueError("texts are cut at spaces and line ends; a piece crosses one")
            usable[text] = i
            scores[i] = model.get_score(i)
    if (bytes_ < 0).any():
        raise ValueError("the vocabulary has no piece for some byte")
    if ranked:
        best = scores[np.isfinite(scores)].max()
        scores = -np.log(best - scores + ZIPF_SHIFT)
        scores[bytes_] = -np.log(len(usable) + ZIPF_SHIFT)
        scores -= np.log(np.exp(scores).sum())
    elif not np.isfinite(scores[bytes_]).all():
        scores[bytes_] = np.where(np.isfinite(scores[bytes_]), scores[bytes_], scores[np.isfinite(scores)].min())
    return Vocabulary(tuple(raw), scores, bytes_, *_trie(usable), max(map(len, usable)))


def _trie(pieces: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """kind, row, owner and piece of a Vocabulary: rows of next states, laid into each other's gaps."""
    letters = Counter(c for text in pieces for c in text)
    letter = ["", *(c for c, _ in letters.most_common())]
    kinds = {c: k for k, c in enumerate(letter) if k}
    kind = np.zeros(max(map(ord, kinds)) + 2, np.int64)
    for c, k in kinds.items():
        kind[ord(c)] = k
    after: dict[str, list[int]] = {}  # kinds that follow a prefix
    for prefix in {text[:n] for text in pieces for n in range(1, len(text) + 1)}:
        after.setdefault(prefix[:-1], []).append(kinds[prefix[-1]])
    rows, taken, end, tried = {}, bytearray([1]), 1, Counter()
    for prefix in sorted(after, key=lambda x: (x != "", -len(after[x]), x)):  # the root's row begins at 0
        next_ = sorted(after[prefix])
        if len(taken) < end + 2 * len(letter):
            taken.extend(bytes(end + 2 * len(letter)))
        at = taken.index(0, max(tried[len(next_)], next_[0]))
        while any(taken[at - next_[0] + k] for k in next_):
            at = taken.index(0, at + 1)
        rows[prefix], tried[len(next_)] = at - next_[0], at
        for k in next_:
            taken[rows[prefix] + k] = 1
        end = max(end, rows[prefix] + next_[-1] + 1)
    size = max(rows.values()) + len(kinds) + 1
    row, owner, piece = np.zeros(size, np.int64), np.full(size, -1), np.full(size, -1)
    state = {"": 0}
    for prefix in sorted(after, key=len):
        row[state[prefix]] = rows[prefix]
        for k in after[prefix]:
            owner[rows[prefix] + k] = state[prefix]
            state[prefix + letter[k]] = rows[prefix] + k
    for text, i in pieces.items():
        piece[state[text]] = i
    return kind, row, owner, piece


class Lattice:
    """All segmentations of many chunks at once.

    Chunk k of n characters has n + 1 nodes, from first[k] to last[k]. An edge is a
    piece from node `source` to node `target`; `piece` is its id, or -1 - c for the
    character c written as bytes. Edges are in the order of their targets, longest
    first; those of node t are head[t] to head[t + 1]. Taken in the order `turn`,
    bound[t] to bound[t + 1] end t characters after the chunk's start.
    """

    def __init__(self, vocabulary: Vocabulary, chunks: Sequence[str]):
        v = vocabulary
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        points = np.frombuffer("\n".join([*chunks, ""]).encode("utf-32-le"), "<u4").astype(np.int64)
        self.last = np.cumsum(sizes + 1) - 1
        self.first = self.last - sizes
        self.nodes = len(points)
        kind = v.kind[np.minimum(points, len(v.kind) - 1)]
        kind[self.last] = 0  # no piece goes beyond its chunk
        inner, single = np.ones(self.nodes, bool), np.zeros(self.nodes, bool)
        inner[self.last] = False
        at, state = np.arange(self.nodes), np.zeros(self.nodes, np.int64)
        found = []
        for n in range(1, v.longest + 1):
            after = v.row[state] + kind[at + (n - 1)]
            hit = np.flatnonzero(v.owner[after] == state)
            if not len(hit):
                break
            at, state = at[hit], after[hit]
            piece = v.piece[state]
            ends = np.flatnonzero(piece >= 0)
            found.append((at[ends], n, piece[ends]))
            if n == 1:
                single[at[ends]] = True
        other = np.flatnonzero(inner & ~single)
        found.append((other, 1, -1 - points[other]))
        many = np.zeros(self.nodes, np.int64)
        for at, n, _ in found:
            many[at + n] += 1
        self.head = np.concatenate([[0], np.cumsum(many)])
        self.target = np.repeat(np.arange(self.nodes), many)
        self.source, self.piece = np.empty_like(self.target), np.empty_like(self.target)
        free = self.head[:-1].copy()
        for at, n, piece in reversed(found):
            place = free[at + n]
            self.source[place], self.piece[place] = at, piece
            free[at + n] = place + 1
        depth = np.arange(self.nodes) - np.repeat(self.first, sizes + 1)
        deepest = int(sizes.max(initial=0))
        by_depth = np.argsort(depth.astype(np.uint16) if deepest < 1 << 16 else depth, kind="stable")
        self.level = np.concatenate([[0], np.cumsum(np.bincount(depth))])  # bounds of equal depth in by_depth
        self.by_depth, self.size = by_depth, many[by_depth]
        stop = np.cumsum(self.size)
        self.turn = np.repeat(self.head[by_depth] - (stop - self.size), self.size) + np.arange(len(self.piece))
        self.bound = np.concatenate([[0], stop])[self.level]
        self.weight = v.logs[np.maximum(self.piece, 0)]
        low = np.flatnonzero(self.piece < 0)
        spelt, place = np.unique(self.piece[low], return_inverse=True)
        self.weight[low] = np.array([v.logs[v.bytes_[list(chr(-1 - c).encode())]].sum() for c in spelt.tolist()])[place]

    def forward(self) -> np.ndarray:
        """Log of the total weight of all paths from a chunk's start to each node."""
        total = np.full(self.nodes, -np.inf)
        total[self.first] = 0.0
        source, weight = self.source[self.turn], self.weight[self.turn]
        for t in range(1, len(self.bound) - 1):
            start, stop = self.bound[t], self.bound[t + 1]
            nodes, size = self.by_depth[self.level[t] : self.level[t + 1]], self.size[self.level[t] : self.level[t + 1]]
            value = total[source[start:stop]] + weight[start:stop]
            head = np.cumsum(size) - size
            most = np.maximum.reduceat(value, head)
            total[nodes] = most + np.log(np.add.reduceat(np.exp(value - np.repeat(most, size)), head))
        return total

    def share(self, total: np.ndarray) -> np.ndarray:
        """Probability of each edge among those that end at its target."""
        return np.exp(total[self.source] + self.weight - total[self.target])

    def expected(self, total: np.ndarray, copies: np.ndarray) -> np.ndarray:
        """How often each edge is taken over `copies` of each chunk, on average."""
        share, visits = self.share(total), np.zeros(self.nodes)
        visits[self.last] = copies
        taken = np.zeros(len(self.piece))
        for t in range(len(self.bound) - 2, 0, -1):
            edges = self.turn[self.bound[t] : self.bound[t + 1]]
            taken[edges] = visits[self.target[edges]] * share[edges]
            np.add.at(visits, self.source[edges], taken[edges])
        return taken


def spelt_out(pieces: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Replace -1 - c by the byte pieces of c; also the number of ids each entry became."""
    low = np.flatnonzero(pieces < 0)
    if not len(low):
        return pieces, np.ones(len(pieces), np.int64)
    spelt, place = np.unique(pieces[low], return_inverse=True)
    table = [vocabulary.bytes_[list(chr(-1 - c).encode())] for c in spelt.tolist()]
    size = np.ones(len(pieces), np.int64)
    size[low] = np.array([len(x) for x in table])[place]
    out = np.repeat(pieces, size)
    at = (np.cumsum(size) - size)[low]
    for i, ids in enumerate(table):
        where = at[place == i]
        for j, x in enumerate(ids):
            out[where + j] = x
    return out, size
