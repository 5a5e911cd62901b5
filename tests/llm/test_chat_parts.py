"""Long conversations are rendered once, whole, and from several tasks."""

import hashlib

import pytest
from pyspark.sql import functions as F

from leaguescore.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
OUTSIDE = (
    "{% set sign = '*' %}BOS {% for m in messages %}{% if loop.first %}<first>{% endif %}{{ sign }}{{ loop.index }}:"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}{% else %}{{ m.text }}{% endif %}"
    "{% if loop.last %}<last>{% endif %} {% endfor %}EOS"
)


def texts_of(parts):
    """Text and learnt texts of each conversation, from its parts in order."""
    out = {}
    for r in sorted(parts.collect(), key=lambda r: (str(r["conv_id"]), r["part"])):
        text, learnt = out.get(r["conv_id"], ("", []))
        spans = [r["formatted"][s["start"] : s["end"]] for s in r["spans"]]
        out[r["conv_id"]] = (text + r["formatted"], learnt + spans)
    return out


def conversation(conv, n):
    return [(conv, t, "assistant" if t % 2 else "user", f"said {conv} {t}") for t in range(n)]


@pytest.fixture(scope="module")
def rows():
    out = [r for conv in range(20) for r in conversation(conv, 3)]
    out += conversation(100, 600) + conversation(None, 40)
    out += [(100, 5, "user", "twice")] * 2 + [(100, None, "user", "no turn"), (7, None, None, None)]
    return out


def whole(rows, template):
    render, out = chat.compile_template(template), {}
    for conv in {r[0] for r in rows}:
        own = sorted((t if t is not None else -1, r or "", x or "") for c, t, r, x in rows if c == conv)
        text, spans = render({"messages": [{"role": r, "text": x} for _, r, x in own]})
        out[conv] = (text, [text[s:e] for s, e in spans])
    return out


@pytest.mark.parametrize("template", [chat.TURNS, OUTSIDE])
@pytest.mark.parametrize("segment_turns, part_turns", [(chat.SEGMENT_TURNS, 256), (30, 7), (1, 1)])
def test_parts_together_are_the_whole(spark, monkeypatch, rows, template, segment_turns, part_turns):
    table = spark.createDataFrame(rows, SCHEMA).withColumn("segment", F.lit("clash")).repartition(5)
    parts = chat.format_conversations(table, template, segment_turns)
    got = texts_of(parts)
    assert got == whole(rows, template)
    if template == OUTSIDE:
        text = got[100][0]
        assert text.count("BOS") == text.count("EOS") == text.count("<first>") == text.count("<last>") == 1
        assert text.startswith("BOS <first>*1:no turn") and "*603:said 100 599<last> EOS" in text


def test_a_hot_conversation_is_dealt_to_several_tasks(spark):
    """A third of all rows is one conversation."""
    rows = conversation(5, 3000) + [r for conv in range(100, 2100) for r in conversation(conv, 3)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(8)
    parts = chat.format_conversations(table, segment_turns=200)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as they are small here
    tasks = parts.where("conv_id = 5").select(F.spark_partition_id().alias("p"), F.length("formatted").alias("n"))
    try:
        sizes = [r["n"] for r in tasks.groupBy("p").agg(F.sum("n").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 3 and max(sizes) < 0.6 * sum(sizes)
    got = {r["conv_id"]: r for r in chat.read_back(parts).collect()}
    assert len(got) == 2001
    said = "".join(f"{r}\n{x}\n" for c, _, r, x in rows if c == 5)
    loss = "".join(x for c, _, r, x in rows if c == 5 and r == "assistant")
    assert got[5]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert got[5]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert (got[5]["n_turns"], got[5]["loss_chars"]) == (3000, len(loss))
    assert got[5]["formatted_chars"] == len(whole(rows[:3000], chat.TURNS)[5][0])


def test_templates_that_need_all_messages_are_rendered_whole(spark, rows):
    for template in (
        "{{ messages | length }}{% for m in messages %}{{ m.text }}{% endfor %}",
        "{% for m in messages %}{{ loop.index }}/{{ messages | length }} {% endfor %}",
        "{% for m in messages %}{{ m.role }}{% endfor %}{% for m in messages %}{{ m.text }}{% endfor %}",
        "{% if true %}{% set x = messages %}{% endif %}{% for m in x %}{{ m.text }}{% endfor %}",
        "no messages at all",
    ):
        assert not chat.Layout(template).in_parts
        parts = chat.format_conversations(spark.createDataFrame(rows, SCHEMA), template, 30)
        assert parts.count() == 22 and texts_of(parts) == whole(rows, template)
    assert chat.Layout(chat.TURNS).in_parts and chat.Layout(OUTSIDE).in_parts


def test_filters_of_missing_fields_are_empty():
    source = "".join(f"[{{{{ m.x | {name} }}}}]" for name in ("escape", "escape_role", "trim", "upper", "lower"))
    assert chat.compile_template(source)({"m": {}})[0] == "[]" * 5
    assert chat.compile_template("{{ m.x | length }}{{ none | upper }}{{ 7 | escape }}")({"m": {}})[0] == "07"
