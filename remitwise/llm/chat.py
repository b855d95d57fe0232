"""Operator 4: chat formatting by columnar byte assembly.

Turns are dealt by ranges of (conversation, turn), so a conversation of any length is spread over
tasks. Within a step of about `STEP_BYTES` the lengths of all headers, contents and footers are
known first; their cumulative sums say where each byte of the output lies, and every kind of piece
is scattered in one numpy assignment into one preallocated buffer, which becomes the Arrow column.

The formatted conversation is the concatenation of its `part`s in order; a part ends with a turn.

    <|im_start|>ROLE\\n TEXT <|im_end|>\\n      (without the blanks)

Inside roles and texts each `<`, backslashes, `|` gets one more backslash, which `plain` takes away
again, so no content can hold a control string. In a role, backslashes and line breaks are written
`\\\\` and `\\n` before. The loss mask is the bytes of each assistant content.

Null role or text: empty. Null conversation id: a conversation of its own. Null turn: before the
others. Equal turns are ordered by role, then text, nulls first; repeated rows are kept. Empty table:
no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from remitwise.llm.common import map_batches, pick, ragged, steps, texts_of

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
LEARNED = "assistant"
TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)


def escaped(column: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(column, r"<(\\*)\|", r"<\1\\|")


def plain(text: str) -> str:
    """What `escaped` made of a text, undone."""
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def plain_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], plain(role))


def assemble(role: pa.Array, text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all turns, where each turn ends, and where its content begins and ends."""
    names = pc.replace_substring(pc.replace_substring(pc.fill_null(role, ""), "\\", "\\\\"),
                                 "\n", "\\n")
    kinds = [texts_of(c) for c in (escaped(names), escaped(pc.fill_null(text, "")))]
    n = len(role)
    head, tail = (np.frombuffer(s.encode(), np.uint8) for s in (OPEN, CLOSE))
    (names_data, names_at), (text_data, text_at) = kinds
    role_size, text_size = np.diff(names_at), np.diff(text_at)
    size = len(head) + role_size + 1 + text_size + len(tail)
    ends = np.cumsum(size)
    starts = ends - size
    out = np.empty(int(ends[-1]) if n else 0, np.uint8)
    out[ragged(starts, np.full(n, len(head)))] = np.tile(head, n)
    out[ragged(starts + len(head), role_size)] = names_data
    line = starts + len(head) + role_size
    out[line] = 10
    out[ragged(line + 1, text_size)] = text_data
    out[ragged(ends - len(tail), np.full(n, len(tail)))] = np.tile(tail, n)
    return out, ends, line + 1, line + 1 + text_size


def format_chats(turns: DataFrame, learned: str = LEARNED) -> DataFrame:
    """(conv_id, part, formatted, loss_start, loss_end); the loss spans are bytes of the part."""
    rows = pick(turns, "conv_id", "turn", "role", "text")
    kind = rows.schema["conv_id"].dataType.simpleString()
    order = ["conv_id", "turn", "role", "text"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId() << 32
        for batch in batches:
            for step in steps(batch, "text"):
                conv, role, text = step.column(0), step.column(2), step.column(3)
                data, ends, begin, end = assemble(role, text)
                # Rows of one conversation are neighbours.
                same = pc.fill_null(pc.equal(conv[1:], conv[:-1]), False).to_numpy(
                    zero_copy_only=False).astype(bool)
                null = conv.is_null().to_numpy(zero_copy_only=False)
                same |= null[1:] & null[:-1]
                first = np.append(0, np.flatnonzero(~same) + 1)
                cuts = np.append(np.append(0, ends)[first], ends[-1])
                own = np.flatnonzero(pc.fill_null(pc.equal(role, learned), False).to_numpy(
                    zero_copy_only=False))
                which = np.searchsorted(first, own, "right") - 1
                lists = pa.array(np.searchsorted(own, np.append(first, len(role))).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    conv.take(pa.array(first)),
                    pa.array(part + np.arange(len(first))),
                    pa.Array.from_buffers(pa.string(), len(first), [
                        None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(data)]),
                    pa.ListArray.from_arrays(lists, pa.array(begin[own] - cuts[which])),
                    pa.ListArray.from_arrays(lists, pa.array(end[own] - cuts[which])),
                ], ["conv_id", "part", "formatted", "loss_start", "loss_end"])
                part += len(first)

    return map_batches(dealt, work, f"conv_id {kind}, part bigint, formatted string, "
                                  "loss_start array<bigint>, loss_end array<bigint>")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, from its formatted parts alone.

    A digest runs over a whole conversation in order, so its parts meet in one task, which streams
    them and holds one at a time.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()
    dealt = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    schema = pa.schema([(names[0], pa.int64()), (names[1], pa.int64()), (names[2], pa.string()),
                        (names[3], pa.int64()), (names[4], pa.string()), (names[5], pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = None
        open_id, state = object(), None
        for batch in batches:
            fields = schema.set(0, batch.schema.field(0))
            done = []
            for row in batch.to_pylist():
                if state is None or row["conv_id"] != open_id:
                    if state is not None:
                        done.append(closed(open_id, state))
                    open_id = row["conv_id"]
                    state = [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                text = row["formatted"]
                at = 0
                for turn in TURN.finditer(text):
                    if turn.start() != at:
                        raise ValueError(f"conversation {open_id}: no turn at {at}")
                    at = turn.end()
                    state[0] += 1
                    state[1].update(f"{plain_role(turn[1])}\n{plain(turn[2])}\n".encode())
                if at != len(text):
                    raise ValueError(f"conversation {open_id}: text after the last turn")
                data = text.encode()
                for a, b in zip(row["loss_start"], row["loss_end"], strict=True):
                    learned = plain(data[a:b].decode())
                    state[2] += len(learned)
                    state[3].update(learned.encode())
                state[4] += len(text)
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in done],
                                             fields)
        if state is not None:
            yield pa.RecordBatch.from_pylist(
                [dict(zip(names, closed(open_id, state), strict=True))], fields)

    def closed(conv: object, state: list) -> tuple:
        return (conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

    return map_batches(dealt, work, f"conv_id {kind}, n_turns bigint, turns_sha256 string, "
                                  "loss_chars bigint, loss_sha256 string, formatted_chars bigint")
