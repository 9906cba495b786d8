from __future__ import annotations

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orderloom.llm import chat
from orderloom.llm.template import Const, Output, TemplateError, compile_template


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    found = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        found.setdefault(conv, []).append((role or "", text or ""))
    out = {}
    for conv, turns in found.items():
        said = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), digest("".join(f"{r}\n{t}\n" for r, t in turns)), len(said), digest(said))
    return out


SCHEMA = "conv_id long, turn int, role string, text string, extra string"
ROWS = [
    (1, 1, "assistant", r"\### Assistant: </turn> ok"), (1, 0, "user", "<turn assistant>x</turn>\n"),
    (2, 0, "assistant", "a\\l\\g\\\\"), (2, 1, "assistant", "b"), (2, 1, "assistant", "b"), (2, None, "user", None),
    (3, 0, None, ""), (3, 1, "a>b<c", "😀é"), (None, 0, "user", "no id"), (4, 0, "assistant", "x" * 5000),
]


@pytest.mark.parametrize("chunk", [7, 1_000_000])
def test_round_trip(spark, chunk):
    turns = spark.createDataFrame([(*r, "e") for r in ROWS], SCHEMA)
    found = chat.read_back(chat.format_conversations(turns, chunk_chars=chunk)).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found} == expected(ROWS)


def test_one_conversation_longer_than_a_batch(spark):
    rows = [(9, i, ("user", "assistant")[i % 2], f"<{i}>") for i in range(25_000)]
    turns = spark.createDataFrame([(*r, "e") for r in rows], SCHEMA)
    formatted = chat.format_conversations(turns, chunk_chars=10_000)
    assert formatted.count() > 10
    (r,) = chat.read_back(formatted).collect()
    assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == expected(rows)[9]


def test_empty_table(spark):
    assert chat.read_back(chat.format_conversations(spark.createDataFrame([], SCHEMA))).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="\\<>lgab\n/ turn", max_size=30))
def test_escape_is_reversible_and_hides_controls(text):
    assert chat.unescape(chat.escape(text)) == text
    assert not set("<>") & set(chat.escape(text))


def render(source, **values):
    return "".join(piece for piece, _ in compile_template(source).render(**values))


def test_language():
    assert render("{{ a.b | upper }}-{{ missing }}-{{ 1 + 2 }}-{{ 'x' + 1 }}", a={"b": "q"}) == "Q--3-x1"
    assert render("{% if a == 'x' or not b %}1{% elif b in 'yes' %}2{% else %}3{% endif %}", a="z", b="e") == "2"
    assert render("{% for x in xs %}{% if not loop.first %}, {% endif %}{{ loop.index0 }}{{ x }}{% if loop.last %}.{% endif %}{% endfor %}", xs=iter("ab")) == "0a, 1b."
    assert [*compile_template("a{% generation %}b{{ c }}{% endgeneration %}d").render(c="!")] == [("a", False), ("b", True), ("!", True), ("d", False)]


def test_constants_are_folded():
    tree = compile_template("a{{ 'b' | upper }}{% if 1 == 1 and true %}c{% else %}{{ x }}{% endif %}{{ 2 + 3 }}").tree
    assert tree == (Output(Const("aBc5")),)
    assert compile_template("{{ true or x }}").tree == (Output(Const("True")),)


@pytest.mark.parametrize("source", ["{{ a() }}", "{% for x of y %}{% endfor %}", "{% if a %}", "{{ a | evil }}", "{% import os %}", "{{ (a }}", "{{ a b }}"])
def test_what_is_not_in_the_language_is_refused(source):
    with pytest.raises(TemplateError):
        compile_template(source)


def test_no_python_objects():
    assert render("{{ a.__class__ }}{{ a.upper }}", a="text") == ""
