from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskflow.llm import common, pieces
from riskflow.llm import lattice_lm as op
from riskflow.storage import scratch_dir
from tests.llm.conftest import DOCUMENT, rows


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load()


def table_of(v: pieces.Vocabulary) -> dict[str, int]:
    bytes_ = set(v.bytes_.tolist())
    return {v.raw[i].decode(): i for i in range(len(v.raw)) if np.isfinite(v.logs[i]) and i not in bytes_}


def segmentations(chunk: str, known: dict[str, int], v: pieces.Vocabulary):
    """All of them, one by one."""
    if not chunk:
        yield ()
        return
    for n in range(1, len(chunk) + 1):
        if chunk[:n] in known:
            for rest in segmentations(chunk[n:], known, v):
                yield (known[chunk[:n]], *rest)
    if chunk[0] not in known:
        for rest in segmentations(chunk[1:], known, v):
            yield (*v.bytes_[list(chunk[0].encode())].tolist(), *rest)


CHUNKS = [" the", " retition", "ñü▁x", "\n", "   ", " \U0001f600a", " a"]


def test_vocabulary(vocabulary):
    assert abs(np.exp(vocabulary.logs[np.isfinite(vocabulary.logs)]).sum() - 1) < 1e-9
    assert (vocabulary.bytes_ >= 0).all()


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("abcé\U0001f600", min_size=1, max_size=6), min_size=1, max_size=60))
def test_trie_holds_the_pieces_and_no_others(texts):
    found = {text: i for i, text in enumerate(sorted(texts))}
    kind, row, owner, piece = pieces._trie(found)
    inside = {text[:n] for text in texts for n in range(1, len(text) + 1)}
    for prefix in ["", *inside]:
        for c in "abcdé\U0001f600\U0010ffff":
            state = 0
            for x in prefix:
                state = row[state] + kind[ord(x)]
            after = row[state] + kind[min(ord(c), len(kind) - 1)]
            assert (owner[after] == state) == (prefix + c in inside)
            if owner[after] == state:
                assert piece[after] == found.get(prefix + c, -1)


def test_lattice_sums_all_segmentations(vocabulary):
    known = table_of(vocabulary)
    lattice = pieces.Lattice(vocabulary, CHUNKS)
    total = lattice.forward()[lattice.last]
    copies = np.arange(1.0, len(CHUNKS) + 1)
    taken = lattice.expected(lattice.forward(), copies)
    ids, size = pieces.spelt_out(lattice.piece, vocabulary)
    found = np.bincount(ids, np.repeat(taken, size), len(vocabulary.raw))
    expected = np.zeros(len(vocabulary.raw))
    for chunk, log, n in zip(CHUNKS, total, copies):
        every = list(segmentations(chunk, known, vocabulary))
        weights = np.array([math.exp(sum(vocabulary.logs[list(s)])) for s in every])
        assert math.isclose(log, math.log(weights.sum()), rel_tol=1e-9)
        for s, w in zip(every, weights / weights.sum()):
            for i in s:
                expected[i] += n * w
    assert np.allclose(found, expected)


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCUMENT)


@pytest.mark.parametrize("common_words", [0, 3, op.COMMON])
def test_scores_against_brute_force(spark, vocabulary, common_words):
    texts = ["the Fox the\tfox", "a new wörd", "the the", None, "", "lazy dog " * 30, "unseen tokens here", "ſſ \x1c x"] * 3
    texts = [t if t is None else f"{t} w{i % 5}" if i % 4 else t for i, t in enumerate(texts)]
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    words = [(t or "").encode().lower().split() for t in texts]
    training = [w for w, h in zip(words, held) if not h]
    counts = Counter(w for ws in training for w in ws)
    n, v, ends = sum(counts.values()) + len(training), len(counts) + 1, len(training)
    known = table_of(vocabulary)

    def chunk_log(word: bytes, logs, taken=None, copies=0):
        every = list(segmentations(" " + word.decode(), known, vocabulary))
        weights = np.array([math.exp(sum(logs[list(s)])) for s in every])
        if taken is not None:
            for s, w in zip(every, weights / weights.sum()):
                for i in s:
                    taken[i] += copies * w
        return math.log(weights.sum())

    taken = np.exp(vocabulary.logs) * op.PRIOR
    for word, c in counts.items():
        chunk_log(word, vocabulary.logs, taken, c)
    whole = taken.sum() + ends + op.PRIOR / 10
    logs = np.log(np.maximum(taken, 1e-300) / whole)
    found = {r.doc_id: r for r in op.scores(docs_of(spark, texts), vocabulary=vocabulary, common_words=common_words).collect()}
    for i, ws in enumerate(words):
        r = found[i]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[i], len(ws) + 1, n)
        assert r.n_known == sum(w in counts for w in ws) + 1
        base = sum(math.log10((c + 1) / (n + v + 1)) for c in [counts[w] for w in ws] + [ends])
        score = (sum(chunk_log(w, logs) for w in ws) + math.log((ends + op.PRIOR / 10) / whole)) / math.log(10)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, score, rel_tol=1e-9)


def test_fitting_helps_held_out_texts(spark, vocabulary):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = op.scores(docs, vocabulary=vocabulary).where("held_out").toPandas()
    plain = op.scores(docs.limit(0).union(docs), vocabulary=vocabulary, prior=1e15).where("held_out").toPandas()
    assert found.score.sum() > 1.0 / 1.1 * plain.score.sum() and (found.score < 0).all()


def test_odd_rows(spark, odd, none):
    found = op.scores(odd)
    assert found.count() == odd.count()
    assert rows(found.where("doc_id IN (3, 4, 5)"), "n_tokens") == [(1,)] * 3
    assert rows(found.where("doc_id IS NULL"), "held_out") == [(False,)] * 2
    assert op.scores(none).count() == 0
    unseen = op.scores(docs_of(spark, ["a b"]), learns=__import__("pyspark").sql.functions.lit(False))
    assert rows(unseen, "n_tokens", "n_known", "train_tokens", "base_score") == [(3, 0, 0, 0.0)]


def test_lattices_of_long_words_are_built_apart(vocabulary, monkeypatch):
    words = [f"{'abcdefgh' * 250}{i}" for i in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(words), pa.array([1] * len(words), pa.int64())], ["word", "c"])
    sizes = []

    class Watched(pieces.Lattice):
        def __init__(self, vocabulary, chunks):
            sizes.append(sum(map(len, chunks)))
            super().__init__(vocabulary, chunks)

    monkeypatch.setattr(op, "Lattice", Watched)
    taken = pa.Table.from_batches(op._expected(vocabulary)([batch])).to_pydict()
    logs = pa.Table.from_batches(op._weighed(vocabulary)([batch])).to_pydict()
    assert max(sizes) <= (1 << 18) + len(words)
    assert logs["word"] == words
    alone = pieces.Lattice(vocabulary, [f" {words[7]}"])
    assert math.isclose(logs["log"][7], alone.forward()[-1] / math.log(10), rel_tol=1e-9)
    chars = sum(n * len(vocabulary.raw[i]) for i, n in zip(taken["piece"], taken["n"]))
    assert math.isclose(chars, sum(len(w) + 1 for w in words), rel_tol=1e-9)


def test_only_the_counts_are_written(spark):
    written = []
    path = lambda label: written.append(label) or scratch_dir(spark, label)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(common, "scratch_dir", lambda _, label: path(label))
        assert op.scores(docs_of(spark, ["a b a", "rare words here"]), common_words=0).count() == 2
    assert written == ["word_counts"]


@pytest.mark.parametrize("common_words", [0, op.COMMON])
def test_rows_of_equal_key_or_text(spark, monkeypatch, common_words):
    monkeypatch.setattr(op, "COPIES", 2)
    given = [(None, "a b")] * 5 + [(None, "a c c"), (None, None), (None, ""), (7, "a b"), (7, "a b"), (7, "c"), (7, None), (7, ""), (8, "a b")]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in given], DOCUMENT)
    found = op.scores(docs, common_words=common_words).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in found) == Counter((i, len((t or "").split()) + 1) for i, t in given)
    by_text = {}
    for r in found:
        by_text.setdefault((r.n_tokens, r.n_known), []).append((r.base_score, r.score))
    assert all(np.allclose(x, x[0], rtol=1e-12) for x in by_text.values())
    counts = Counter(w for i, t in given if i is None or zlib.crc32(str(i).encode()) % 7 != 2 for w in (t or "").split())
    assert {(r.n_known == r.n_tokens) for r in found} == {True} and counts["a"] >= 6
