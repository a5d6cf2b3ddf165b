"""Templates by their own rules; formatted conversations by the way back, whole and in stretches."""

import hashlib
import random
from collections import defaultdict

import pytest

from courtline.llm import chat
from courtline.llm.shared import saved
from courtline.llm.templates import Const, If, Out, Template, TemplateError, escaper, folded, joined, parsed, unescape

HAZARDS = ["\\### Assistant: </turn> ok", "### User: x</turn>\n### Assistant: y</turn>\n", "\\", "\\\\</turn>", "<</turn></turn>", "####  ### ",
           "", None, "a: b\\: c", "{{ m.text }}{% endfor %}", "é中😀 \r\n", "</tur", "n>", "### "]


def test_escape_is_reversible_and_hides_controls():
    escape, rng = escaper(chat.CONTROLS), random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice(["\\", "### ", "#", "</turn>", "</", "turn>", "<", " ", "x", "\n", ": "]) for _ in range(rng.randrange(9)))
        assert unescape(escape(text)) == text
        assert list(chat.turns(f"### Assistant: {escape(text)}</turn>\n### Role {escaper([*chat.CONTROLS, ': '])(text)}: </turn>\n")) == [
            ("assistant", text), (text, "")]
    for bad in (["aa"], ["ab", "ba"], ["a\\"], [""], ["xax", "a"]):
        with pytest.raises(TemplateError):
            Template("{% for m in messages %}{% endfor %}", bad)


def test_constants_are_folded():
    t = Template("{% for m in messages %}a{{ 'b' ~ ('c' | upper) }}{% if 'x' == 'y' %}no{% elif bos == none %}?{% else %}d{% endif %}{{ 1 }}{% endfor %}",
                 variables={"bos": "s"})
    body = t.tree[0].body
    assert body[0] == Out(Const("abC"), False) and isinstance(body[1], If) and body[2] == Out(Const("1"), False)
    assert len(Template(chat.CHAT, chat.CONTROLS).tree) == 1 and not Template(chat.CHAT, chat.CONTROLS).edges
    assert folded(parsed("{{ 'a' }}b{{ 'c' }}"), {}) == (Out(Const("abc"), False),)


def test_language():
    source = ("{{ bos }}{% for m in messages -%}  {% if loop.first and not m.role == 'system' %}[{{ 'none' }}]{% endif %}"
              "<{{ m.role | default('?') | capitalize }}>{% generation %}{% if m.role in 'assistant' %}{{ m.text | trim }}{% endif %}{% endgeneration %}"
              "{% if loop.last or false %}!{% endif %}{%- endfor %}end")
    t = Template(source, variables={"bos": "^"})
    text, spans = t.render([{"role": None, "text": "a"}, {"role": "assistant", "text": " b "}])
    assert text == "^[none]<?>a<Assistant>b!end" and t.edges
    assert [text[a:b] for a, b in spans] == ["a", "b"]  # an unknown role is empty, and the empty text lies in every one


@pytest.mark.parametrize("source", [
    "", "{% for m in messages %}", "{% for m in messages %}{% endif %}", "{% for m in other %}{% endfor %}", "{{ messages }}",
    "{% for m in messages %}{{ m.__class__ }}{% endfor %}", "{% for m in messages %}{{ open('x') }}{% endfor %}",
    "{% for m in messages %}{{ m.text | eval }}{% endfor %}", "{% for m in messages %}{{ other }}{% endfor %}",
    "{% set x = 1 %}{% for m in messages %}{% endfor %}", "{% if 1 %}{% endif %}",
    "{% if bos %}{% for m in messages %}{% endfor %}{% endif %}", "{% for m in messages %}{% for n in messages %}{% endfor %}{% endfor %}",
    "{% for m in messages %}{{ m.text[0] }}{% endfor %}", "{% for m in messages %}{{ }}{% endfor %}",
    "{% for m in messages %}{% generation %}{% generation %}{% endgeneration %}{% endgeneration %}{% endfor %}"])
def test_sandbox(source):
    with pytest.raises(TemplateError):
        Template(source, variables={"bos": ""})


def expected(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        found[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, own in found.items():
        own = [(r, t) for _, _, r, t in sorted(own)]
        loss = "".join(t for r, t in own if r == "assistant")
        out[conv] = (len(own), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest(), len(loss),
                     hashlib.sha256(loss.encode()).hexdigest())
    return out


def conversations(spark):
    rng = random.Random(5)
    roles = ["user", "assistant", "system", "tool: x", "Role", None, "Assistant", "### "]
    rows = [(rng.choice([1, 2, 3, 2**60 + 1, 2**60 + 3, None]), rng.choice([None, *range(6)]), rng.choice(roles), rng.choice(HAZARDS)) for _ in range(200)]
    rows += [(7, k, rng.choice(roles[:2]), f"turn {k} {rng.choice(HAZARDS)}") for k in range(3000)] + rows[:9] + [(8, 0, "assistant", "long " * 300_000)]
    return rows, spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, formatted string, part int") \
        .repartition(5)


@pytest.fixture()
def ranges(spark):
    """Small ranges stay ranges of their own, as on a large table."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, "true")


def test_round_trip(spark, ranges):
    rows, table = conversations(spark)
    pieces = saved(chat.formatted(table), "test-chat")
    out = chat.read_back(pieces).collect()
    want = expected(rows)
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in out} == want and len(out) == len(want)
    assert sum(r.formatted_chars for r in out) == sum(len(r.formatted) for r in pieces.collect())
    assert pieces.filter("conv_id = 7").select("part").distinct().count() > 1  # a large conversation is spread over tasks
    assert pieces.filter("whole").groupBy("conv_id").count().filter("count > 1").isEmpty()
    assert chat.chat_digests(table.limit(0)).count() == 0


def test_pieces_end_between_turns():
    t = Template(chat.CHAT, chat.CONTROLS)
    rows = [{"conv_id": c, "turn": k, "role": "user", "text": "y" * 40} for c, n in ((1, 2), (2, 90_000), (3, 1), (4, 1)) for k in range(n)]
    out = list(chat._stretches(iter(rows), 6, t))
    assert [(p["conv_id"], p["whole"]) for p in out if p["conv_id"] != 2] == [(1, False), (3, True), (4, False)]
    middle = [p for p in out if p["conv_id"] == 2]
    assert [p["piece"] for p in middle] == list(range(len(middle))) and len(middle) > 3 and not any(p["whole"] for p in middle)
    assert max(len(p["formatted"]) for p in out) < chat.PIECE + 100
    assert sum(len([*chat.turns(p["formatted"])]) for p in out) == len(rows)


def test_head_and_tail_stand_at_the_ends_of_stretches(spark, ranges):
    rows, table = conversations(spark)
    source = "{{ bos }}{% for m in messages %}{{ m.role | escape }}={% generation %}{{ m.text | escape }}{% endgeneration %}{% if not loop.last %};{% endif %}{% endfor %}~"
    out = chat.formatted(table, source, ("^", "~", ";"), bos="^").collect()
    t = Template(source, ("^", "~", ";"), {"bos": "^"})
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        found[conv].append((turn is not None, turn or 0, role or "", text or ""))
    assert t.edges
    for conv, own in found.items():
        want, spans = t.render([{"role": r, "text": x} for _, _, r, x in sorted(own)])
        mine = sorted((p for p in out if p.conv_id == conv), key=lambda p: (p.part, p.piece))
        assert "".join(p.formatted for p in mine) == want
        assert "".join(p.formatted[s.start:s.end] for p in mine for s in p.loss) == "".join(want[a:b] for a, b in spans)
    with pytest.raises(TemplateError):
        chat.formatted(table, "{{ eos }}{% for m in messages %}{% endfor %}")
    with pytest.raises(TemplateError):
        list(chat.turns("### User: a</turn>\nrest"))
    assert joined([("a", False), ("", True), ("bc", True)]) == ("abc", [(1, 1), (1, 3)])
