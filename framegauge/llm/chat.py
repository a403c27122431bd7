"""Chat formatting by prefix-target expansion.

Every assistant turn is an example: all turns before it are its context and only its reply is trainable. Written out,
the examples of one conversation grow with the square of its length, so ``format_turns`` keeps them as references: a
row per turn with its piece of the conversation's formatted text, and for assistant turns the example's number, the
length of its context and the span of its reply in that text. ``full_examples`` writes examples out; ``digests`` reads each
of them as well, all turns before the reply included, by a digest that is carried along the conversation.

A turn is ``### role: text </turn>\\n``. In roles and texts a backslash goes before every backslash, before each ``#``
of ``###`` and after the ``<`` of ``</turn>``; in roles before every colon too. Taking each backslash away and keeping
the character after it gives the text back."""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_CONTROL = re.compile(r"\\|###|</turn>")
_ROLE_CONTROL = re.compile(r"\\|###|</turn>|:")
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): (.*) </turn>\n", re.S)
_COLUMNS = "conv_id long, turn_no long, start long, piece string, example long, context_chars long, loss_start long, loss_end long"


def _guarded(m: re.Match) -> str:
    return "<\\/turn>" if m[0] == "</turn>" else "".join("\\" + c for c in m[0])


def escape(text: str) -> str:
    return _CONTROL.sub(_guarded, text)


def escape_role(role: str) -> str:
    return _ROLE_CONTROL.sub(_guarded, role)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def read_turn(piece: str) -> tuple[str, str]:
    """(role, text) of one formatted turn."""
    m = _TURN.fullmatch(piece)
    if not m:
        raise ValueError("not a formatted turn")
    return unescape(m[1]), unescape(m[2])


def format_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", trainable: str = "assistant") -> DataFrame:
    """``(conv_id, turn_no, start, piece, example, context_chars, loss_start, loss_end)``, a row per turn.

    The pieces of a conversation by turn_no are its formatted text; start, context_chars and loss spans are code
    points in it. A conversation's turns are ordered by turn, then role, then text, nulls first. Null texts and roles
    count as empty; a null conv_id is a conversation of its own; repeated rows are turns of their own; an empty table
    gives no rows; other columns are ignored. Rows stream through the task that holds their conversation, sorted; only
    one batch is in memory, whatever a conversation's length. The rows stay in order in their partitions."""
    src = conversations.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    src = src.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")

    def run(batches):
        conv, begun, turn, at, example = None, False, 0, 0, 0
        for batch in batches:
            rows = []
            for c, role, text in zip(*(col.to_pylist() for col in batch.columns), strict=True):
                if not begun or c != conv:
                    conv, begun, turn, at, example = c, True, 0, 0, 0
                head = f"### {escape_role(role or '')}: "
                body = escape(text or "")
                piece = f"{head}{body} </turn>\n"
                if (role or "") == trainable:
                    rows.append((c, turn, at, piece, example, at, at + len(head), at + len(head) + len(body)))
                    example += 1
                else:
                    rows.append((c, turn, at, piece, None, None, None, None))
                turn, at = turn + 1, at + len(piece)
            if rows:
                cols = list(zip(*rows, strict=True))
                names = [x.split()[0] for x in _COLUMNS.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.string() if k == "piece" else pa.int64()) for k, v in zip(names, cols, strict=True)], names)

    return src.mapInArrow(run, _COLUMNS)


def full_examples(turns: DataFrame) -> DataFrame:
    """``(conv_id, example, text, loss_start, loss_end)`` with each example's context and reply written out.

    ``turns`` comes straight from ``format_turns``. The output has the square of a conversation's length, and one
    conversation's text is in memory; filter the conversations first where some have no bound."""

    def run(batches):
        conv, text, rows = None, [], []
        for batch in batches:
            for r in batch.to_pylist():
                if r["turn_no"] == 0:
                    conv, text = r["conv_id"], []
                text.append(r["piece"])
                if r["example"] is not None:
                    rows.append((conv, r["example"], "".join(text), r["loss_start"], r["loss_end"]))
                if sum(len(x[2]) for x in rows[-64:]) > 1 << 22 or len(rows) >= 1000:
                    yield _rows(rows)
                    rows = []
        if rows:
            yield _rows(rows)

    def _rows(rows):
        cols = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(v, pa.string() if k == 2 else pa.int64()) for k, v in enumerate(cols)], ["conv_id", "example", "text", "loss_start", "loss_end"])

    return turns.mapInArrow(run, "conv_id long, example long, text string, loss_start long, loss_end long")


def digests(turns: DataFrame) -> DataFrame:
    """What each conversation says, read back from its formatted text: ``(conv_id, n_turns, n_examples, turns_sha256,
    loss_chars, loss_sha256, examples_sha256, formatted_chars)``. ``turns`` comes straight from ``format_turns``; the digests
    grow as the pieces stream by. examples_sha256 is the digest of the digests of all examples' texts, context and reply,
    as hex digits joined by commas."""

    def run(batches):
        conv, n, k, size, said, chars, loss, whole, examples = None, 0, 0, 0, None, 0, None, None, None
        done = []
        for batch in batches:
            for r in batch.to_pylist():
                if r["turn_no"] == 0:
                    if said is not None:
                        done.append((conv, n, k, said.hexdigest(), chars, loss.hexdigest(), examples.hexdigest(), size))
                    conv, n, k, size, chars = r["conv_id"], 0, 0, 0, 0
                    said, loss, whole, examples = (hashlib.sha256() for _ in range(4))
                role, text = read_turn(r["piece"])
                said.update(f"{role}\n{text}\n".encode())
                whole.update(r["piece"].encode())
                n, size = n + 1, size + len(r["piece"])
                if r["example"] is not None:
                    reply = unescape(r["piece"][r["loss_start"] - r["start"] : r["loss_end"] - r["start"]])
                    loss.update(reply.encode())
                    examples.update(("," * (k > 0) + whole.hexdigest()).encode())
                    k, chars = k + 1, chars + len(reply)
            if len(done) >= 1000:
                yield _rows(done)
                done = []
        if said is not None:
            done.append((conv, n, k, said.hexdigest(), chars, loss.hexdigest(), examples.hexdigest(), size))
        if done:
            yield _rows(done)

    names = ["conv_id", "n_turns", "n_examples", "turns_sha256", "loss_chars", "loss_sha256", "examples_sha256", "formatted_chars"]

    def _rows(rows):
        cols = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(v, pa.string() if k in (3, 5, 6) else pa.int64()) for k, v in enumerate(cols)], names)

    return turns.mapInArrow(run, ", ".join(f"{k} {'string' if 'sha' in k else 'long'}" for k in names))
