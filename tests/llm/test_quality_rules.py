from __future__ import annotations

from collections import Counter

from riskflow.llm import quality_rules as op
from tests.llm.conftest import rows


def test_figures_by_hand():
    d = op.Document("a b c\na b c\n\n a b c\nx é# ")
    assert (d.n_words, d.word_chars, d.n_symbols) == (11, 12, 1)
    assert (len(d.lines), d.n_dup_lines) == (4, 1)
    assert d.n_repeat_words == 9 and (d.n_letter_words, d.n_capitals, d.n_small) == (11, 0, 10)
    assert op.Document("a b").n_repeat_words == op.Document(None).n_words == 0
    assert op.Document("a b a b a b").n_repeat_words == 6


def test_every_rule_rejects_its_kind():
    clean = " ".join(f"plain{chr(97 + i % 26)}{chr(97 + i // 26)} words" for i in range(40))
    bad = {
        "word_length": " ".join("abcdefghijklmnopqr"[: 16 + i % 2] + chr(97 + i % 26) + chr(97 + i // 26) for i in range(60)),
        "symbols": clean.replace(" ", "### "),
        "repeated_lines": "\n".join(["the same line"] * 4 + clean.split()),
        "words_without_letter": clean.replace(" ", " 12 "),
        "capitals": clean.upper(),
        "repeated_words": clean + " " + " ".join(["one two three four five six"] * 6),
    }
    for rule in op.RULES:
        assert not rule.rejects(op.Document(clean)) and rule.rejects(op.Document(bad[rule.name])), rule.name


def test_greedy_order():
    a, b, c = (op.Rule(n, lambda d: False) for n in "abc")
    # b rejects most per cost; what a rejects, b rejects too, so c comes before a
    assert [r.name for r in op.ordered([a, b, c], {0b011: 50, 0b010: 30, 0b100: 5, 0: 100}, [10, 10, 10])] == ["b", "c", "a"]
    assert [r.name for r in op.ordered([a, b], {0b01: 10, 0b10: 20}, [1, 100])] == ["a", "b"]


def test_short_circuit():
    ran = Counter()

    def rule(name, verdict):
        return op.Rule(name, lambda d: ran.update([name]) or verdict)

    assert not op.passes(op.Document("x"), [rule("a", False), rule("b", True), rule("c", True)])
    assert ran == {"a": 1, "b": 1}


def test_order_does_not_change_verdicts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    planned = op.plan(docs, fraction=0.5)
    assert sorted(r.name for r in planned) == sorted(r.name for r in op.RULES)
    assert rows(op.judge(docs, planned)) == rows(op.judge(docs, op.RULES[::-1]))


def test_labelled_documents(spark):
    """Good documents stay and bad ones go, as far as the labels tell."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = op.judge(docs, op.RULES).where("NOT base_failed").join(labels, "doc_id").groupBy("quality", "kept").count().collect()
    n = {(r["quality"], r["kept"]): r["count"] for r in found}
    assert n.get((1, False), 0) <= 0.02 * n[1, True] and n.get((0, True), 0) <= 0.5 * n.get((0, False), 1)


def test_odd_rows(spark, odd, none):
    found = op.judge(odd, op.plan(odd, fraction=1.0))
    assert found.count() == odd.count()
    assert rows(found.where("doc_id = 3"))[0][1:] == (0, 0, 0, 0, 0, True, False)
    assert not found.where("kept AND base_failed").count()
    assert op.judge(none, op.plan(none)).count() == 0 and op.plan(none) == list(op.RULES)


def test_cost_is_what_a_rule_adds():
    """Figures that every document needs are worked out before, and no rule pays for another."""
    import pyarrow as pa

    text = " ".join(f"word{i} of{i % 50} many\n" for i in range(6000))
    batch = pa.RecordBatch.from_arrays([pa.array([text, "too short", None])], ["text"])
    (found,) = list(op._measured(op.RULES)([batch]))
    assert found.column(1).to_pylist() == [1]  # what fails the base never gets to the rules
    spent = dict(zip((r.name for r in op.RULES), found.column(2)[0].as_py()))
    assert spent["words_without_letter"] > 20 * max(spent["repeated_words"], spent["word_length"], spent["symbols"])
