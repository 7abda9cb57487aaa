from __future__ import annotations

import hashlib
import random
import re
import string

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from riskflow.llm import secret_scan as op
from tests.llm.conftest import DOCUMENT, rows

ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
UNTRAINED = op.RandomStrings(None)
HEX = "04dbebab91ab85687d33eeaaf9ac699e1188f962"


def plain_base(text: str) -> str:
    """The patterns as they are given: match first, then drop matches that are too short."""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(found))


pieces = st.sampled_from(["password", "ToKeN", "api_key", "apikey", "secret", "ſecret", "=", ":", " ", "  ", "'", '"', "abc", "abcdef", "é", "\n", "AKIA", "AKIA" + "Z9" * 8, "0" * 24, HEX, "f", "."])


@settings(max_examples=300, deadline=None)
@given(st.lists(pieces, max_size=25).map("".join))
def test_patterns(text):
    base, added = op.find(text, UNTRAINED)
    assert op.listed(base) == plain_base(text) and added == []


def trained(seed: int = 1) -> op.RandomStrings:
    """A model from the words of a table, plain and in capitals, and from random strings."""
    import pyarrow.parquet as pq

    rng = random.Random(seed)
    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"])["text"].to_pylist()
    ordinary = ["identifier_name", "getUserName", "2024-01-02", "src/main/java"] * 50 + [w for t in texts for w in (t + " " + t.upper()).split()]
    strings = ["".join(rng.choices(string.ascii_letters + string.digits, k=40)) for _ in range(300)]
    counts = np.zeros((2, (op.N + 1) * op.N))
    for label, tokens in ((0, ordinary), (1, strings)):
        counts[label] += np.bincount(op._Tokens.of(" ".join(tokens).encode()).codes, minlength=counts.shape[1])
    return op.RandomStrings.from_counts(counts)


def test_model_separates_random_strings():
    model, rng = trained(), random.Random(2)
    for _ in range(50):
        secret = "".join(rng.choices(string.ascii_letters + string.digits, k=32))
        base, added = op.find(f"käse {secret} end", model)
        assert [(s.kind, s.start, s.end) for s in added] == [("random", 5, 37)]
    for word in ("thenentionthereonthe", "identifier_nameidentifier", "src/main/java/there", "1234567890123456"):
        assert op.find(word, model)[1] == []
    assert op.find("".join(rng.choices(string.ascii_letters, k=op.LEAST_TOKEN - 1)), model)[1] == []


def names_of_code(n: int, seed: int = 4) -> list[str]:
    """Made-up identifiers from the words of a table."""
    import pyarrow.parquet as pq

    rng = random.Random(seed)
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist()
    words = sorted({w.strip(".,!?").lower() for t in texts[:300] for w in (t or "").split() if w.strip(".,!?").isascii() and w.strip(".,!?").isalpha()})
    forms = ("_".join, "/".join, lambda w: "".join(x.capitalize() for x in w), lambda w: "_".join(w).upper(), lambda w: "-".join(w) + "-42")
    return [x for i in range(n) if len(x := forms[i % len(forms)](rng.choices(words, k=4))) >= op.LEAST_TOKEN]


def test_recall_by_alphabet(spark):
    """Trained on the given table alone: of random strings 0.9 and more, of identifiers none."""
    model, rng = op.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")), random.Random(9)
    letters, digits = string.ascii_letters, string.digits
    alphabets = {
        "base62": letters + digits,
        "base64": letters + digits + "+/",
        "small": string.ascii_lowercase + digits,
        "base32": string.ascii_uppercase + "234567",
        "capitals": string.ascii_uppercase + digits,
    }
    for name, alphabet in alphabets.items():
        for size in (16, 32, 64):
            strings = ["".join(rng.choices(alphabet, k=size)) for _ in range(300)]
            found = sum(bool(op.find(f"a {s} b", model)[1] or op.find(f"a {s} b", model)[0]) for s in strings)
            assert found / 300 >= 0.9, (name, size, found / 300)
    names = names_of_code(1500)
    assert len(names) > 1200 and [x for x in names if op.find(x, model)[1]] == []


def test_likelihood_ratio_by_hand():
    counts = np.zeros((2, op.N + 1, op.N))
    counts[0, op.START, 0], counts[1, op.START, 1] = 3, 5
    model = op.RandomStrings.from_counts(counts.reshape(2, -1))
    row = op.START * op.N
    expected = np.log((0.5 / (5 + op.N / 2)) / (3.5 / (3 + op.N / 2)))
    assert abs(model.ratio[row] - expected) < 1e-12


def test_added_spans_leave_base_spans():
    model = trained()
    text = f"token = {HEX} and x{HEX}"
    base, added = op.find(text, model)
    assert op.listed(base) == plain_base(text) and not any(a.start < b.end and b.start < a.end for a in added for b in base)


def test_redaction():
    model = trained()
    text = f'é token = "{HEX}" then {"AKIA" + "Q7" * 8} end'
    assert op.redacted(text, model) == 'é token = "[secret]" then [secret] end'
    assert op.redacted("nothing here", model) == "nothing here" and op.redacted(None, model) is None


def test_query_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = op.train(docs)
    assert model.ratio is not None
    found = {r.doc_id: r for r in op.scan(docs, model).collect()}
    for r in docs.collect():
        base, got = plain_base(r.text), found[r.doc_id]
        kinds = [s.split(":")[0] for s in base.split(",")]
        assert (got.n_assign, got.n_access, got.n_hex) == tuple(kinds.count(k) for k in op.KINDS[:3])
        assert got.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(base.split(",")) <= set(got.spans.split(","))


def test_training_counts(spark):
    docs = spark.createDataFrame([(1, f"secret={HEX} plainwords aBcD", None, None, None)] * 2, DOCUMENT)
    model = op.train(docs)
    counts = np.zeros((2, (op.N + 1) * op.N))
    for label, token in ((0, "plainwords"), (1, HEX)):  # the value once, though two patterns find it
        counts[label] += 2 * np.bincount(op._Tokens.of(token.encode()).codes, minlength=counts.shape[1])
    assert np.allclose(model.ratio, op.RandomStrings.from_counts(counts).ratio)


def test_odd_rows(spark, odd, none):
    model = op.train(odd)
    found = op.scan(odd, model)
    assert found.count() == odd.count()
    empty = hashlib.sha256(b"").hexdigest()
    assert rows(found.where("doc_id IN (3, 4, 5)"), "base_sha256", "spans") == [(empty, "")] * 3
    clean = op.redact(odd, model)
    assert clean.schema == odd.schema and rows(clean, "doc_id", "source", "text") == rows(odd, "doc_id", "source", "text")
    assert op.train(none).ratio is None and op.scan(none, op.train(none)).count() == 0
