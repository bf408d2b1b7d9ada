"""Conversations from event logs: folding, escaping, segments, and what is read back."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hostgrain.llm.chat_format import (
    PROBE,
    ROLE_ESCAPES,
    SEGMENT,
    escaped,
    fold,
    format_conversations,
    op12,
    parsed,
    read_back,
    turn_log,
    unescaped,
)

_MARKS = st.lists(st.sampled_from(["\\", "e", "h", "c", "#", "##", "### ", "</turn", "</turn>", ">", "\n", ": ", "é", "😀", "x"])).map("".join)


@settings(max_examples=300, deadline=None)
@given(_MARKS, _MARKS)
def test_escapes_hide_all_marks_and_go_back(role, text):
    body, head = escaped(text), escaped(role, ROLE_ESCAPES)
    assert unescaped(body) == text and unescaped(head) == role
    assert "</turn>" not in body and "### " not in body and ":" not in head
    assert parsed(f"### {head}: {body}</turn>\n" * 2) == [(role, text)] * 2


def test_parsing_refuses_what_was_not_rendered():
    for broken in ("### user: hello", "user: hello</turn>\n", "### user hello</turn>\n"):
        with pytest.raises(ValueError):
            parsed(broken)


def test_fold():
    start, delta = ("start", "assistant", None), lambda t: ("delta", None, t)
    assert fold([start, delta("a"), delta(None), delta("b")]) == ("assistant", "ab")
    assert fold([start, delta("draft"), ("regenerate", None, None), delta("final")]) == ("assistant", "final")
    assert fold([start, delta("x"), ("edit", None, "y"), delta("z")]) == ("assistant", "yz")
    assert fold([start, delta("x"), ("regenerate", "user", None)]) == ("user", "")
    assert fold([start, delta("x"), ("retract", None, None)]) is None
    assert fold([delta("early")]) == ("", "early")
    with pytest.raises(ValueError):
        fold([start, (None, None, "x")])


def _expected(turns):
    """conv -> what read_back() has to say, by plain Python."""
    groups = {}
    for conv, turn, role, text in turns:
        groups.setdefault(conv, []).append((turn, role or "", text or ""))
    found = {}
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, f"{r[1]}\x01{hashlib.md5(r[2].encode()).hexdigest()}"))
        loss = "".join(t for _, r, t in rows if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for _, r, t in rows)
        chars = sum(len(f"### {escaped(r, ROLE_ESCAPES)}: {escaped(t)}</turn>\n") for _, r, t in rows)
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        found[conv] = (len(rows), digest(said), len(loss), digest(loss), chars)
    return found


def test_messy_turns(spark):
    """Nulls in any column, repeated rows, ties, empty and very long texts, control strings, clashing columns, a long conversation."""
    rows = [
        (1, 0, "user", "hello"),
        (1, 0, "user", "hello"),
        (1, 0, "assistant", "tie"),
        (1, None, None, None),
        (1, 1, "assistant", PROBE),
        (1, 2, "a: b\n", "### a: b</turn>\n"),
        (2, 3, "assistant", ""),
        (None, 0, "assistant", "nobody's"),
        (None, 1, None, "x"),
        (3, 6, "user", "y" * 300_000),
        (3, 7, "assistant", "é😀\\" * 50_000),
        *[(4, t, "assistant" if t % 2 else "user", f"turn {t} " * 500) for t in range(80)],
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for clash in ("message", "seq", "kind", "event", "segment", "formatted", "loss", "n_turns"):
        frame = frame.withColumn(clash, F.lit("clash"))
    segments = format_conversations(turn_log(frame)).cache()
    found = {r.conv_id: tuple(r)[1:] for r in read_back(segments).collect()}
    assert found == _expected(rows)
    sizes = [r.n for r in segments.where("conv_id = 4").select(F.length("formatted").alias("n")).collect()]
    assert len(sizes) > 3 and max(sizes) < SEGMENT + 5_000


def test_a_log_with_late_edits_and_retractions(spark):
    log = [
        (9, 1, "m1", 0, "start", "user", None),
        (9, 1, "m1", 5, "edit", None, "second version"),
        (9, 2, "m2", 1, "start", "assistant", None),
        (9, 2, "m2", 3, "delta", None, "there"),
        (9, 2, "m2", 2, "delta", None, "hi "),
        (9, 3, "m3", 4, "start", "user", None),
        (9, 3, "m3", 6, "retract", None, None),
        (9, 1, "m1", 1, "delta", None, "first version"),
        (10, 1, "m", 1, "retract", None, None),
    ]
    frame = spark.createDataFrame(log, "conv_id long, turn long, message string, seq long, kind string, role string, text string")
    rows = format_conversations(frame).collect()
    assert [(r.conv_id, parsed(r.formatted)) for r in rows] == [(9, [("user", "second version"), ("assistant", "hi there")])]
    (span,) = rows[0].loss
    assert rows[0].formatted[span.start : span.end] == "hi there"


def test_nothing(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert read_back(format_conversations(turn_log(empty))).collect() == []


def test_query_equals_sql(spark, duck):
    from comparing import SMALL, rows_of

    from hostgrain.llm.chat_format import ORACLES

    assert rows_of(op12(spark, SMALL).toPandas()) == rows_of(duck.sql(ORACLES["op12_chat_format"]).df())
