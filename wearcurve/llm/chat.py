"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole: ``<|im_start|>`` role ``<|im_sep|>`` text ``<|im_end|>`` for each turn. The three
control strings are added tokens, so no token reaches over the end of a text. Inside roles and texts every ``<`` that
would begin a control string (``<``, any number of backslashes, ``|``) gets one more backslash, which unescaping takes
away again, so no text can hold a control string and the original comes back exactly.

The rendered conversation is encoded once, with offsets. Turn spans and token spans are both sorted, so the tokens of
a span are found by binary search, and the tokens of the texts of the trained roles are under the loss mask.

Turns are dealt by conversation and sorted there, and a task holds one conversation at a time: its tokens are made in
one piece, so a conversation must fit into a task. Turns are ordered by turn (null first), then role and text, so ties
and repeated rows have one order. Null texts and roles are empty. Rows with a null conversation id form one
conversation. An empty table gives an empty table. Only the four columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearcurve.llm.memo import held
from wearcurve.llm.token_counts import Vocabulary

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"

_SCHEMA = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("formatted", pa.string()),
        ("ids", pa.list_(pa.int32())),
        ("token_start", pa.list_(pa.int32())),
        ("token_end", pa.list_(pa.int32())),
        ("loss", pa.list_(pa.bool_())),
    ]
)
SCHEMA = "conv_id long, formatted string, ids array<int>, token_start array<int>, token_end array<int>, loss array<boolean>"


def escaped(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescaped(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def render(turns: Sequence[tuple[str | None, str | None]]) -> tuple[str, list[tuple[str, int, int]]]:
    """The formatted conversation, and (role, start, end) of each text in it."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = START + escaped(role or "") + SEP, escaped(text or "")
        spans.append((role or "", at + len(head), at + len(head) + len(body)))
        out += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    turns = []
    for turn in formatted.split(START)[1:]:
        role, text = turn[: -len(END)].split(SEP, 1)
        turns.append((unescaped(role), unescaped(text)))
    return turns


def loss_mask(spans: Sequence[tuple[int, int]], starts, ends):
    """Which tokens are in the spans; spans and tokens are sorted, empty spans hold none."""
    import numpy as np

    mask = np.zeros(len(starts), dtype=bool)
    for a, b in spans:
        if a < b:
            mask[np.searchsorted(ends, a, "right") : np.searchsorted(starts, b, "left")] = True
    return mask


def masked_text(formatted: str, starts: Sequence[int], ends: Sequence[int], loss: Sequence[bool]) -> str:
    """The text under the mask, unescaped; each run of masked tokens is one stretch of text."""
    import numpy as np

    under = np.concatenate([[0], np.asarray(loss, dtype=np.int8), [0]])
    steps = np.diff(under)
    return "".join(unescaped(formatted[starts[a] : ends[b - 1]]) for a, b in zip(np.flatnonzero(steps == 1), np.flatnonzero(steps == -1), strict=True))


def _tokenizer(spec: str):
    from tokenizers import AddedToken, Tokenizer

    tokenizer = Tokenizer.from_str(spec)
    tokenizer.add_special_tokens([AddedToken(c, special=True, normalized=False) for c in (START, SEP, END)])
    return tokenizer


def format_conversations(
    turns: DataFrame, vocabulary: Vocabulary, roles: Sequence[str] = ("assistant",), conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """A row for each conversation: formatted text, ids, token spans in characters, and the loss mask."""
    key, spec, trained = vocabulary.key, vocabulary.spec, frozenset(roles)
    rows = turns.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        tokenizer = held("chat" + key, lambda: _tokenizer(spec))

        def finished(conv_id, found) -> pa.RecordBatch:
            whole, spans = render(found)
            encoding = tokenizer.encode(whole, add_special_tokens=False)
            offsets = np.array(encoding.offsets, dtype=np.int32).reshape(-1, 2)
            starts, ends = offsets[:, 0], offsets[:, 1]
            mask = loss_mask([(a, b) for r, a, b in spans if r in trained], starts, ends)
            values = [[conv_id], [whole], [encoding.ids], [starts], [ends], [mask]]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, _SCHEMA, strict=True)], schema=_SCHEMA)

        now, found, any_row = None, [], False
        for batch in batches:
            for conv_id, r, t in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if any_row and conv_id != now:
                    yield finished(now, found)
                    found = []
                now, any_row = conv_id, True
                found.append((r, t))
        if any_row:
            yield finished(now, found)

    return dealt.mapInArrow(formatted, SCHEMA)


def parsed(formatted: Column) -> Column:
    """Turns read back from formatted text, as an array of (role, text)."""

    @F.arrow_udf("array<struct<role string, text string>>")
    def turns(rows: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        return pa.array([[{"role": r, "text": t} for r, t in parse(x)] for x in rows.to_pylist()], kind)

    return turns(formatted)


def text_under_mask(formatted: Column, starts: Column, ends: Column, loss: Column) -> Column:
    """The unescaped text of all tokens under the mask."""

    @F.arrow_udf("string")
    def under(f: pa.Array, s: pa.Array, e: pa.Array, m: pa.Array) -> pa.Array:
        return pa.array([masked_text(*x) for x in zip(f.to_pylist(), s.to_pylist(), e.to_pylist(), m.to_pylist(), strict=True)], pa.string())

    return under(formatted, starts, ends, loss)
