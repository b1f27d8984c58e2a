"""The template language by itself, and formatted conversations against their rows."""

import hashlib
import random

import pytest

from stocktide.llm import chat
from stocktide.llm.templates import Const, Controls, For, Template, TemplateError, Text, fold, parse

NONE = Controls("<x", "[x")


def render(source, **variables):
    return Template(source, NONE).render([], **variables)[0]


@pytest.mark.parametrize("source, wanted", [
    ("a{# gone #}b", "ab"),
    ("{{ 1 + 2 - 4 }}|{{ 'a' ~ 1 ~ none ~ true }}", "-1|a1true"),
    ("{{ x.k }}{{ x['k'] }}{{ x.missing }}{{ y[1] }}{{ y[9] }}", "vvb"),
    ("{% if n > 2 and not z %}big{% elif n == 2 %}two{% else %}small{% endif %}", "big"),
    ("{% for i in y %}{{ loop.index }}{{ i }}{% if not loop.last %},{% endif %}{% endfor %}", "1a,2b"),
    ("{% set q = y | length %}{{ q }}{{ 'k' in x }}{{ 'q' not in x }}", "2truetrue"),
    ("  {{- 'l' -}}  r", "lr"), ("{% if none %}no{% endif %}", ""),
    ("{{ missing | default('d') | upper }}{{ ' t ' | trim | capitalize }}{{ y | join('-') }}", "DTa-b"),
    ("{{ 'yes' if n == 3 else 'no' }}{{ \"q\\n'\" }}", "yesq\n'"), ("{{ x.k or 'other' }}{{ none or 'other' }}", "vother"),
    ("{% for i in missing %}x{% endfor %}.", "."), ("{{ '<x[x\\\\' | escape }}", "<\\x[\\x\\\\"),
])
def test_language(source, wanted):
    assert render(source, x={"k": "v"}, y=["a", "b"], n=3, z=False) == wanted


@pytest.mark.parametrize("source", [
    "{{ x.__class__ }}", "{{ _x }}", "{{ x | eval }}", "{% for i in x %}", "{% import os %}", "{{ 1 + }}", "{{ x y }}", "{% if x %}", "{{ x() }}",
    "{{ $ }}", "{% generation %}{% generation %}{% endgeneration %}{% endgeneration %}", "{% set loop = 1 %}", "{% endfor %}",
])
def test_what_the_sandbox_refuses(source):
    with pytest.raises(TemplateError):
        Template(source, NONE)


def test_objects_show_none_of_their_attributes():
    class Secret:
        token = "s"

    assert render("{{ x.token }}{{ y.append }}", x=Secret(), y=["a"]) == ""


def test_constants_are_folded():
    filters = Template("", NONE).filters
    assert fold(parse("a{{ 1 + 2 }}{% if 1 == 1 %}b{{ 'c' | upper }}{% else %}{{ d }}{% endif %}e"), filters) == (Text("a3bCe"),)
    assert fold(parse("{{ x if 2 > 1 else y }}"), filters)[0].value.name == "x"
    (loop,) = fold(parse("{% for m in q %}{{ 'a' ~ 'b' }}c{% endfor %}"), filters)
    assert isinstance(loop, For) and loop.body == (Text("abc"),)
    assert fold(parse("{{ false and x }}"), filters) == (Text("false"),) and fold(Const(1), filters) == Const(1)


def test_messages_are_taken_one_by_one():
    template, taken = Template("{% for m in messages %}{{ m.text }}{% endfor %}", NONE), []

    def messages():
        for i in range(5):
            taken.append(i)
            yield {"text": str(i)}

    pieces = template.pieces(messages())
    assert template.streams and next(pieces) == "0" and len(taken) == 2
    assert not Template("{{ messages | length }}{% for m in messages %}{% endfor %}", NONE).streams


def test_escape_is_reversible_and_keeps_control_strings_out():
    controls, rng = Controls(*chat.CONTROLS), random.Random(4)
    for _ in range(3000):
        text = "".join(rng.choices(["#", "##", "### ", ": ", ":", " ", "<", "/", "</turn>", "\\", "\\\\", "n", "turn>", "\n"], k=rng.randint(0, 12)))
        escaped = controls.escape(text)
        assert controls.unescape(escaped) == text
        assert not any(c in escaped for c in chat.CONTROLS)
    for bad in ("x", "a\\b", "aba"):
        with pytest.raises(TemplateError):
            Controls(bad)


def brute(rows):
    of = {}
    for conv_id, turn, role, text in sorted(rows, key=lambda r: tuple((x is not None, x) for x in r)):
        of.setdefault(conv_id, []).append((role or "", text or ""))
    out = []
    for conv_id, turns in of.items():
        learned = "".join(t for r, t in turns if r == "assistant")
        out.append((conv_id, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                    len(learned), hashlib.sha256(learned.encode()).hexdigest()))
    return sorted(out, key=repr)


ROWS = [
    (-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok"),
    (1, 2, "assistant", "third"), (1, 0, "system", None), (1, 1, None, "no role"), (1, 1, "user", "tie"), (1, 1, "user", "tie"), (1, None, "user", "first"),
    (2, 0, "assistant", ""), (2, 1, "assistant", "\U0001f600 ###\n### ### </turn>\n### user: x</turn>\n"), (3, 0, "a: b\n### ", "<</turn>"),
    (None, 0, "user", "no id"), (None, 1, "assistant", "none\\"), (4, 0, "assistant", "x" * 5000), (4, 1, "assistant", "\\" * 999),
]


@pytest.mark.parametrize("piece_chars", [1, 50, chat.PIECE])
def test_conversations_are_read_back(spark, piece_chars):
    many = [(9, k, ("user", "assistant")[k % 2], f"turn {k} \\### </turn>") for k in range(400)]
    rows = ROWS + many
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, piece int, formatted string")
    written = chat.format_conversations(table, piece_chars=piece_chars)
    got = chat.read_back(written).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == brute(rows)
    sizes = {r.conv_id: r.n for r in written.groupBy("conv_id").agg({"formatted": "count"}).withColumnRenamed("count(formatted)", "n").collect()}
    assert sizes[9] > 1 if piece_chars < 1000 else sizes[9] == 1


def test_loss_spans_of_the_formatted_text(spark):
    rows = chat.format_conversations(spark.createDataFrame(ROWS[:2], "conv_id long, turn long, role string, text string")).collect()
    assert [r.formatted for r in rows] == ["### user: \\\\#\\## Assistant:\\ <\\/turn> ok</turn>\n### assistant: \\\\#\\## Assistant:\\ <\\/turn> ok</turn>\n"]
    (span,) = rows[0].loss
    assert Controls.unescape(rows[0].formatted[span.begin : span.end]) == ROWS[1][3]


def test_other_templates(spark):
    source = "{{ messages | length }}{% for m in messages %}[{{ m.role }}|{% generation %}{{ m.text | trim }}{% endgeneration %}]{% endfor %}"
    rows = spark.createDataFrame([(1, 0, "user", " a "), (1, 1, "assistant", "b")], "conv_id long, turn long, role string, text string")
    (row,) = chat.format_conversations(rows, source, ("[a", "|]")).collect()
    assert row.formatted == "2[user|a][assistant|b]" and [row.formatted[s.begin : s.end] for s in row.loss] == ["a", "b"]


def test_given_conversations(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r)[:5] for r in chat.read_back(chat.format_conversations(table)).collect()), key=repr) == brute(rows)


def test_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_conversations(none)).count() == 0


def test_damaged_text_is_refused():
    with pytest.raises(ValueError):
        list(chat.turns_of(iter(["### user: open"])))
    with pytest.raises(ValueError):
        list(chat.turns_of(iter(["user: x</turn>\n"])))
