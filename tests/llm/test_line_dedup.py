from __future__ import annotations

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskflow.llm import line_dedup as op
from tests.llm.conftest import DOCUMENT, rows

PASSAGE = (
    "It was a long passage of several sentences that many documents share. Some of its sentences are short. "
    "No. Others go on, with commas; and with words enough to be cut where a hash says so, again and again and again, "
    "until they end at last in a full stop.\nA line more of the same passage ends it for good."
)


def table(spark, texts):
    return spark.createDataFrame([(i, t, None, None, None) for i, t in texts], DOCUMENT)


def own(n: int, words: int = 30) -> str:
    rng = random.Random(n)
    return " ".join("".join(rng.choices("bcdfgklmnprst", k=5)) for _ in range(words)) + "."


def test_normal_form():
    assert op.normal("  The QUICK,\tbrown -- fox!! É ") == "the quick brown fox É".encode()
    assert op.size_of(b"") == 0 and op.size_of(b"one two") == 2
    assert op.size_of(("文" * 95).encode()) == 9


def test_units_of_a_text():
    text = "One two three four five six. Short one. And then more words than that. Last"
    assert [text[a:b] for a, b in op.sentences(text)] == ["One two three four five six. ", "Short one. And then more words than that. ", "Last"]
    text = "a\n\nb\n"
    assert [text[a:b] for a, b in op.sentences(text)] == ["a\n", "\n", "b\n"]
    text = "这是一句话。这是另一句！完"
    assert [text[a:b] for a, b in op.sentences(text)] == ["这是一句话。", "这是另一句！", "完"]
    assert op.sentences("") == [] and op.lines("a\nb") == [(0, 2), (2, 3)] and op.paragraphs("a\nb\n\nc") == [(0, 5), (5, 6)]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab .!?\n\t\r。é", max_size=300), st.text(alphabet="ab .\n", max_size=40))
def test_cuts_depend_on_their_surroundings(text, before):
    """Units are the whole text, and what stands some lines before changes none of them."""
    found = op.sentences(text)
    assert "".join(text[a:b] for a, b in found) == text and all(a < b for a, b in found)
    assert all(len(text[a:b].encode().split()) <= max(op.UNCUT, op.LONGEST) for a, b in found)
    shifted = op.sentences(before + "\n" + text)
    n = len(before) + 1
    assert [(a - n, b - n) for a, b in shifted if a >= n] == found


ENDS = re.compile("(?<=[.!?])[ \t]+|\n|[。！？]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")


def chosen(word):
    letters = word.strip(op.PUNCTUATION.decode()).encode().lower().decode()
    return letters != "" and (131 * ord(letters[0]) + 31 * ord(letters[-1]) + 7 * (len(letters) - 1)) % op.ONE_IN == 0


def units_by_hand(text):
    """The cuts, sentence by sentence and word by word."""
    parts, start, before = [], 0, 0
    for match in ENDS.finditer(text):
        end = match.end()
        if len(text[before:end].encode().split()) >= op.SENTENCE or match.group()[0] not in " \t":
            parts.append((start, end))
            start = end
        before = end
    if start < len(text):
        parts.append((start, len(text)))
    found = []
    for a, b in parts:
        if len(text[a:b].encode().split()) <= op.UNCUT:
            found.append((a, b))
            continue
        n, at = 0, a
        for match in WORD.finditer(text, a, b):
            n += 1
            if n == op.LONGEST or chosen(match.group().rstrip(" \t\n\r\x0b\x0c")):
                found.append((at, match.end()))
                n, at = 0, match.end()
        if at < b:
            found.append((at, b))
    return found


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "and", "Word", "é,", "--", "!", ".", " ", "  ", "\t", "\n", "\r", "。", "文", "x y z ", "one two three four five six seven "]), max_size=60).map("".join))
def test_arrays_cut_as_by_hand(text):
    assert op.sentences(text) == units_by_hand(text)


def by_hand(texts, least=op.LEAST_WORDS, cut=op.sentences):
    """The same by plain Python: documents in order, units seen so far."""
    seen, out = set(), {}
    for key, text in sorted(texts, key=lambda x: x[0]):
        units = cut(text)
        again = []
        for a, b in units:
            form = op.normal(text[a:b])
            again.append(None if not form else hashlib.sha256(form).digest() in seen)
            seen.add(hashlib.sha256(form).digest())
        gone, run, n = set(), [], 0
        for i, flag in enumerate([*again, False]):
            if flag:
                run.append(i)
                n += op.size_of(op.normal(text[units[i][0] : units[i][1]]))
            elif flag is False:
                if n >= least:
                    gone |= set(range(run[0], run[-1] + 1))
                run, n = [], 0
        out[key] = ("".join(text[a:b] for i, (a, b) in enumerate(units) if i not in gone), len(units), len(gone))
    return out


def test_passages_go_and_short_lines_stay(spark):
    line = "All rights reserved by its owners.\n"
    texts = [(i, f"{own(i)}\n{line}{own(100 + i)} {PASSAGE if i % 2 else ''} {own(200 + i)}") for i in range(9)]
    texts.append((20, f"{own(20)} {PASSAGE.upper()} {own(21)}"))
    texts.append((21, PASSAGE.replace("several", "many") + "\n" + own(22)))
    found = {r.doc_id: (r.text, r.n_units, r.n_removed) for r in op.dedup(table(spark, texts)).collect()}
    assert found == by_hand(texts)
    assert "hash says so" in found[1][0] and all("hash says" not in found[i][0] for i in (3, 5, 7, 21)) and "HASH" not in found[20][0]
    assert all(line in found[i][0] for i in range(9)) and all(own(i) in found[i][0] for i in range(9))


def test_offsets(spark):
    """What is removed stands at the spans given, in code points of the original."""
    texts = [(1, f"é {PASSAGE}\n{own(1)}"), (2, f"\U0001f600 ü{own(2)}\n{PASSAGE}\n{own(3)}\n{PASSAGE}")]
    (row,) = op.dedup(table(spark, texts)).where("doc_id = 2").collect()
    text = texts[1][1]
    spans = [tuple(map(int, s.split("-"))) for s in row.removed_spans.split(",")]
    assert len(spans) == 2 and all(text[a:b].strip().endswith("for good.") for a, b in spans)
    left = "".join(text[a:b] for a, b in zip([0] + [b for _, b in spans], [a for a, _ in spans] + [len(text)]))
    assert row.text == left and row.n_removed >= 4


@pytest.mark.parametrize("unit, cut", [("line", op.lines), ("paragraph", op.paragraphs)])
def test_other_units(spark, unit, cut):
    paragraph = "A paragraph of\nseveral words on two lines.\n\n"
    texts = [(i, f"start {i}\n\n{paragraph}end\n") for i in range(3)]
    found = {r.doc_id: (r.text, r.n_units, r.n_removed) for r in op.dedup(table(spark, texts), unit=unit, least_words=1).collect()}
    assert found == by_hand(texts, 1, cut)
    assert found[2][0] == "start 2\n\n"


def test_same_id_other_text(spark):
    """Rows with one id are ranked by a hash of their text: exactly one keeps the passage."""
    docs = table(spark, [(1, f"{own(i)}\n{PASSAGE}") for i in range(4)])
    assert sorted(n > 0 for (n,) in rows(op.dedup(docs), "n_removed")) == [False, True, True, True]


def test_text_without_blanks(spark):
    chinese = "所有文件都重复这一段没有空格的文字" * 20
    found = rows(op.dedup(table(spark, [(i, f"{chinese}\n{own(i)}") for i in range(3)])), "doc_id", "text")
    assert found == [(0, f"{chinese}\n{own(0)}"), (1, own(1)), (2, own(2))]


def test_copies(spark):
    """Rows that repeat one another: the first stays, the others lose all, if that is enough."""
    docs = table(spark, [(1, PASSAGE)] * 3 + [(2, "short text")] * 2 + [(None, PASSAGE)] * 2)
    found = rows(op.dedup(docs), "doc_id", "text")
    assert found == [(None, ""), (None, ""), (1, ""), (1, ""), (1, PASSAGE), (2, "short text"), (2, "short text")]


def test_odd_rows(spark, odd, none):
    found = op.dedup(odd)
    assert found.count() == odd.count()
    assert rows(found.where("doc_id IN (1, 2)"), "doc_id", "n_removed") == [(1, 0), (1, 0), (2, 0)]
    assert rows(op.dedup(odd, least_words=5).where("doc_id IN (1, 2)"), "doc_id", "n_removed") == [(1, 0), (1, 1), (2, 1)]
    assert rows(found.where("doc_id = 3"), "text", "n_units", "removed_spans") == [(None, 0, "")]
    assert rows(found.where("doc_id = 4"), "text", "n_units", "removed_spans") == [("", 0, "")]
    assert op.dedup(none).count() == 0
