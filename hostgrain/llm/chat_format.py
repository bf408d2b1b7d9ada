"""Chat formatting: conversations rebuilt from their event logs, then rendered with a loss mask.

A log holds events of messages: `start` (a role, no text yet), `delta` (text that
is appended), `edit` (text that replaces what is there), `regenerate` (what was
streamed so far is void) and `retract` (the message is gone). Logs are dealt out by
range of (conversation, turn, message) and sorted by sequence, so one pass folds
each message and renders it as it ends; a conversation that fills several tasks is
cut into segments, which stay in order. Segments hold whole turns, up to about
SEGMENT characters, so neither a row nor a task's memory grows with a conversation.

A turn is rendered as `### role: text</turn>` and a line feed. Within texts and
roles, backslash and the control strings stand as two-character escapes that begin
with a backslash, so that neither mark can occur in them, and back again gives the
same text. The loss mask lists the places of the assistant's texts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hostgrain.llm.storage import table, written

OPEN, CLOSE, COLON = "### ", "</turn>", ":"
#: What stands for backslash and the control strings. The colon ends a role and is escaped in roles only.
ESCAPES = {"\\": "\\\\", CLOSE: "\\e", OPEN: "\\h"}
ROLE_ESCAPES = ESCAPES | {COLON: "\\c"}
TRAINED = "assistant"
#: Code points after which a segment of a conversation ends, with the turn that goes beyond.
SEGMENT = 65_536
#: Code points of a streamed delta.
DELTA = 256

_SEGMENTS = "conv_id long, segment long, formatted string, loss array<struct<start: int, end: int>>"
_READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_UNESCAPED = {v: k for k, v in ROLE_ESCAPES.items()}


def escaped(text: str, escapes: dict[str, str] = ESCAPES) -> str:
    """text without control strings; unescaped() gives it back."""
    return re.sub("|".join(map(re.escape, escapes)), lambda m: escapes[m[0]], text)


def unescaped(text: str) -> str:
    return re.sub(r"\\.", lambda m: _UNESCAPED[m[0]], text, flags=re.DOTALL)


def fold(events: Iterator[tuple[str, str | None, str | None]]) -> tuple[str, str] | None:
    """(role, text) after all events (kind, role, text) of a message in order; None where it was retracted."""
    role, pieces, gone = "", [], False
    for kind, own_role, text in events:
        if kind in ("start", "regenerate", "edit"):
            pieces, gone = [], False
            role = role if own_role is None else own_role
        if kind == "retract":
            gone = True
        elif kind in ("delta", "edit"):
            pieces.append(text or "")
        elif kind not in ("start", "regenerate"):
            raise ValueError(f"unknown kind of event: {kind!r}")
    return None if gone else (role, "".join(pieces))


def _by_key(batches, keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """The rows of Arrow batches, sorted by their first columns, in groups of equal ones."""
    from itertools import chain, groupby

    rows = chain.from_iterable(zip(*(c.to_pylist() for c in b.columns), strict=True) for b in batches)
    return groupby(rows, key=lambda r: r[:keys])


def _rendered(batches):
    import pyarrow as pa
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 33
    ready, size = [], 0
    conv, pieces, spans, length = None, [], [], 0

    def batch(rows):
        columns = list(zip(*rows, strict=True))
        loss = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        types = (pa.int64(), pa.int64(), pa.string(), loss)
        names = ("conv_id", "segment", "formatted", "loss")
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    for (own, _, _), events in _by_key(batches, 3):
        message = fold(e[4:] for e in events)
        if pieces and (own != conv or length >= SEGMENT):
            ready.append((conv, number, "".join(pieces), spans))
            number, size = number + 1, size + length
            pieces, spans, length = [], [], 0
            if size >= 64 * SEGMENT or len(ready) >= 4096:
                yield batch(ready)
                ready, size = [], 0
        conv = own
        if message is None:
            continue
        role, text = message
        head, body = f"{OPEN}{escaped(role, ROLE_ESCAPES)}{COLON} ", escaped(text)
        if role == TRAINED:
            spans.append({"start": length + len(head), "end": length + len(head) + len(body)})
        pieces += [head, body, CLOSE, "\n"]
        length += len(head) + len(body) + len(CLOSE) + 1
    if pieces:
        ready.append((conv, number, "".join(pieces), spans))
    if ready:
        yield batch(ready)


def format_conversations(log: DataFrame) -> DataFrame:
    """(conv_id, segment, formatted, loss) from a log (conv_id, turn, message, seq, kind, role, text).

    A conversation's text is that of its segments by ascending segment; loss has the
    start and end of each assistant's text within the segment, in code points.
    Messages follow by turn (null first), those of one turn by message, a string that
    tells them apart; events of a message by seq. A conversation of which all messages
    were retracted has no segment. Null texts are empty, as is a role that no event
    names; rows without conversation form one of their own. An unknown kind raises.
    Further columns are ignored; an empty log gives no rows.
    """
    by = ["conv_id", "turn", "message"]
    events = log.select(*by, "seq", "kind", "role", "text")
    dealt = events.repartitionByRange(*by).sortWithinPartitions(*by, "seq")
    return dealt.mapInArrow(_rendered, _SEGMENTS)


def parsed(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted text."""
    turns = formatted.split(f"{CLOSE}\n")
    if turns.pop():
        raise ValueError("the last turn has no end")
    found = []
    for turn in turns:
        role, colon, text = turn.removeprefix(OPEN).partition(f"{COLON} ")
        if not turn.startswith(OPEN) or not colon:
            raise ValueError("a turn has no head")
        found.append((unescaped(role), unescaped(text)))
    return found


def _summaries(batches):
    import pyarrow as pa

    rows = []
    for (conv,), segments in _by_key(batches, 1):
        turns, loss = hashlib.sha256(), hashlib.sha256()
        n_turns = loss_chars = chars = 0
        for _, _, formatted, spans in segments:
            chars += len(formatted)
            for role, text in parsed(formatted):
                turns.update(f"{role}\n{text}\n".encode())
                n_turns += 1
            for span in spans:
                text = unescaped(formatted[span["start"] : span["end"]])
                loss.update(text.encode())
                loss_chars += len(text)
        rows.append((conv, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
    if rows:
        types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in _READ.split(", ")])


def read_back(segments: DataFrame) -> DataFrame:
    """Per conversation what its segments say: turns and their digest, the text under the mask and its digest, the length.

    Digests are fed segment by segment in order, so a long conversation costs no memory.
    """
    rows = segments.select("conv_id", "segment", "formatted", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    return rows.mapInArrow(_summaries, _READ)


def message_order(role: Column, text: Column) -> Column:
    """Tells messages of one turn apart, in the order of role and digest of the text."""
    return F.concat(F.coalesce(role, F.lit("")), F.lit("\x01"), F.md5(F.coalesce(text, F.lit(""))))


def turn_log(turns: DataFrame) -> DataFrame:
    """The log of a client that streams the turns (conv_id, turn, role, text).

    Texts arrive in deltas of DELTA code points. The assistant begins every turn
    with an attempt that is then regenerated, and every third of the others' turns
    has its first version edited. Rows that repeat each other are messages of their own.
    """
    text, none = F.coalesce("text", F.lit("")), F.lit(None).cast("string")
    event = lambda kind, role=none, text=none: F.struct(F.lit(kind).alias("kind"), role.alias("role"), text.alias("text"))
    deltas = lambda t: F.transform(F.regexp_extract_all(t, F.lit(f"(?s).{{1,{DELTA}}}"), 0), lambda piece: event("delta", text=piece))
    attempt = F.concat(F.lit("Let me see: "), F.substring(text, 1, 24))
    start = F.array(event("start", F.coalesce("role", F.lit(""))))
    events = (
        F.when(F.col("role") == TRAINED, F.concat(start, deltas(attempt), F.array(event("regenerate")), deltas(text)))
        .when(F.col("turn") % 3 == 0, F.concat(start, deltas(F.substring(text, 2, 40)), F.array(event("edit", text=text))))
        .otherwise(F.concat(start, deltas(text)))
    )
    copy = F.format_string("%020d", F.monotonically_increasing_id())
    message = F.concat(message_order(F.col("role"), F.col("text")), F.lit("\x01"), copy)
    told_apart = turns.select("conv_id", "turn", "role", "text", message.alias("message"))  # before there is a row for each event
    return told_apart.select("conv_id", "turn", "message", F.posexplode(events).alias("seq", "event")).select(
        "conv_id", "turn", "message", "seq", "event.*"
    )


#: A conversation whose texts look like the template itself.
PROBE = r"\### Assistant: </turn> ok"


def with_probe(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, TRAINED, PROBE)], "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)


def op12(spark, sf_dir):
    log = turn_log(with_probe(spark, table(spark, sf_dir, "conversations")))
    return read_back(written(format_conversations(log), "formatted"))


def _sql_escaped(text: str, escapes: dict[str, str]) -> str:
    for plain, code in escapes.items():
        text = f"replace({text}, '{plain}', '{code}')"
    return text


QUERIES = {"op12_chat_format": op12}
ORACLES = {
    "op12_chat_format": f"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '{PROBE}'), (-7, 1, 'assistant', '{PROBE}')) p(conv_id, turn, role, text)
        ), o AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role || chr(1) || md5(text)) AS place,
                   {len(OPEN + COLON + CLOSE) + 2} + length({_sql_escaped("role", ROLE_ESCAPES)}) + length({_sql_escaped("text", ESCAPES)}) AS chars FROM c
        )
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(chars)::BIGINT AS formatted_chars
        FROM o GROUP BY conv_id
    """
}
