"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole, encoded once with offsets, and the sorted spans of the
assistant texts are intersected with the sorted token spans by binary search: the tokens of
a span are one index range.  The control strings are added to the tokenizer as special
tokens and stand on both sides of every text, so no token crosses the edge of a text.

Template of a turn: ``<|im_start|>ROLE<|im_sep|>TEXT<|im_end|>`` and a line feed.  Inside
roles and texts every ``<``, n backslashes, ``|`` gets one more backslash, which is undone
by taking one away; so no text can hold a control string.

Turns are ordered by (turn, role, text), nulls first; null roles and texts are empty.  Rows
with a null conversation id form one conversation.  Repeated rows stay.  An empty
assistant text has no tokens.  A conversation is the unit of rendering: its turns are
gathered in one row, so one that is much longer needs that much memory.  An empty table gives no rows.
"""

from __future__ import annotations

import functools
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>(.*?)<\|im_sep\|>(.*?)<\|im_end\|>\n", re.S)


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the (start, end) spans of assistant texts, in order."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role)}{SEP}", escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(formatted)]


def loss_texts(formatted: str, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> list[str]:
    """The texts under the mask: one for each run of masked tokens, unescaped."""
    on = np.flatnonzero(mask)
    if not len(on):
        return []
    cut = np.flatnonzero(np.diff(on) > 1) + 1
    return [unescape(formatted[starts[r[0]]:ends[r[-1]]]) for r in np.split(on, cut)]


@functools.cache
def _tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")      # Spark runs one task a core
    from tokenizers import AddedToken, Tokenizer, processors

    t = Tokenizer.from_file(path)
    t.add_special_tokens([AddedToken(s, normalized=False) for s in (START, SEP, END)])
    t.post_processor = processors.ByteLevel(trim_offsets=False)   # offsets cover white space too
    return t


def mask_tokens(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """True for tokens that overlap a span; all three lists are sorted."""
    mask = np.zeros(len(starts), bool)
    if spans:
        lo = np.searchsorted(ends, [a for a, _ in spans], "right")
        hi = np.searchsorted(starts, [b for _, b in spans], "left")
        for i, j in zip(lo, hi):
            mask[i:j] = True
    return mask


def format_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """(conv, formatted, input_ids, starts, ends, loss_mask): one row a conversation.

    ``tokenizer`` is the path of a tokenizers JSON file that every executor can read."""
    gathered = rows.groupBy(F.col(conv).alias("id")).agg(F.sort_array(F.collect_list(F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")))).alias("turns")).select(
        "id", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"))
    kind = gathered.schema["id"].dataType.simpleString()

    def formatted(batches):
        encode = _tokenizer(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                made = [render(list(zip(r, t))) for r, t in zip(part.column("roles").to_pylist(), part.column("texts").to_pylist())]
                ids, starts, ends, masks = [], [], [], []
                for (_, spans), code in zip(made, encode.encode_batch([m[0] for m in made], add_special_tokens=False)):
                    offsets = np.array(code.offsets, np.int32).reshape(-1, 2)
                    ids.append(np.array(code.ids, np.int32))
                    starts.append(offsets[:, 0])
                    ends.append(offsets[:, 1])
                    masks.append(mask_tokens(offsets[:, 0], offsets[:, 1], spans))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array([m[0] for m in made], pa.string()),
                     *[pa.array(x, pa.list_(pa.int32())) for x in (ids, starts, ends)], pa.array(masks, pa.list_(pa.bool_()))],
                    ["id", "formatted", "input_ids", "starts", "ends", "loss_mask"])

    schema = (f"id {kind}, formatted string, input_ids array<int>, starts array<int>, ends array<int>, "
              "loss_mask array<boolean>")
    return gathered.mapInArrow(formatted, schema).withColumnRenamed("id", conv)


def read_back(made: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Digests of turns and loss texts, from the formatted rows alone."""
    import hashlib

    rows = made.select(F.col(conv).alias("id"), "formatted", "starts", "ends", "loss_mask")
    kind = rows.schema["id"].dataType.simpleString()

    def digests(batches):
        for batch in batches:
            out = [[] for _ in range(5)]
            for i, text in enumerate(batch.column("formatted").to_pylist()):
                turns = parse(text)
                starts, ends, mask = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("starts", "ends", "loss_mask"))
                loss = "".join(loss_texts(text, starts, ends, mask))
                out[0].append(len(turns))
                out[1].append(hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest())
                out[2].append(len(loss))
                out[3].append(hashlib.sha256(loss.encode()).hexdigest())
                out[4].append(len(text))
            yield pa.RecordBatch.from_arrays([batch.column("id"), *[pa.array(x) for x in out]],
                                             ["id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return rows.mapInArrow(digests, f"id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                                    "loss_sha256 string, formatted_chars bigint").withColumnRenamed("id", conv)
