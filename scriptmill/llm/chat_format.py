"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole by a turn template, encoded once with
character offsets, and the loss mask is found by intersecting the sorted spans
of the assistant texts with the sorted token spans by binary search.

Template.  Each turn is ``<turn>`` role ``<text>`` text ``</turn>``.  The three
marks are single tokens of their own (added to the tokenizer), so no token
straddles the border of a text.  Control strings inside roles and texts (the
marks, and every special token of the tokenizer) are escaped reversibly: a
backslash is doubled, and a control string gets a backslash after its first
character; unescaping drops one backslash and keeps what follows it.

Distribution.  A conversation's turns are cut into segments of
``segment_turns`` turns; segments are rendered and encoded in parallel, and,
because the marks split the tokenizer's input, the segments' tokens are the
tokens of the whole.  So one huge conversation is many rows, never one group.

Defined results: null text and null role count as empty; a null conv_id is a
conversation of its own; turns are ordered by turn (null first), ties by role
and text; repeated rows are turns of their own; an empty text has no tokens
under the mask; a system or user turn is never under the mask; other columns
of the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptmill.llm.common import running_total, shuffle_parts

TURN, TEXT, END = "<turn>", "<text>", "</turn>"
LOSS_ROLE = "assistant"
SEGMENT_TURNS = 256


class ChatFormatter:
    """Renders, encodes and reads back turns with one tokenizer file."""

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import AddedToken, Tokenizer, processors

        self.tokenizer = Tokenizer.from_file(tokenizer)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.tokenizer.add_special_tokens([AddedToken(m, normalized=False) for m in (TURN, TEXT, END)])
        # offsets must cover every character: no trimming of leading spaces
        self.tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)
        self.control = re.compile("|".join(re.escape(c) for c in sorted([*special, TURN, TEXT, END], key=len, reverse=True)))

    def escape(self, text: str) -> str:
        return self.control.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.S)

    def render(self, turns: list[tuple[str, str]]) -> tuple[str, np.ndarray]:
        """The formatted text and the sorted (start, end) spans of the texts under loss."""
        out, spans, at = [], [], 0
        for role, text in turns:
            head, body = f"{TURN}{self.escape(role)}{TEXT}", self.escape(text)
            at += len(head)
            if role == LOSS_ROLE:
                spans.append((at, at + len(body)))
            at += len(body) + len(END)
            out += [head, body, END]
        return "".join(out), np.array(spans, dtype=np.int64).reshape(-1, 2)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Token ids and their (start, end) offsets in code points."""
        e = self.tokenizer.encode(text, add_special_tokens=False)
        return np.array(e.ids, dtype=np.int64), np.array(e.offsets, dtype=np.int64).reshape(-1, 2)


def loss_mask(spans: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """True for the tokens that intersect a span: both are sorted, so the tokens
    of a span are a run whose ends are found by binary search."""
    mask = np.zeros(len(offsets) + 1, dtype=np.int64)
    first = np.searchsorted(offsets[:, 1], spans[:, 0], side="right")
    last = np.searchsorted(offsets[:, 0], spans[:, 1], side="left")
    some = first < last
    np.add.at(mask, first[some], 1)
    np.add.at(mask, last[some], -1)
    return np.cumsum(mask)[:-1] > 0


def masked_runs(offsets: np.ndarray, mask: np.ndarray) -> list[tuple[int, int]]:
    """Merged character ranges of the masked tokens (tokens of one character's
    bytes share its offsets)."""
    runs: list[list[int]] = []
    for a, b in offsets[mask].tolist():
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b])
    return [(a, b) for a, b in runs]


_FORMATTERS: dict[str, ChatFormatter] = {}  # per Python worker


def formatter(tokenizer: str) -> ChatFormatter:
    if tokenizer not in _FORMATTERS:
        _FORMATTERS[tokenizer] = ChatFormatter(tokenizer)
    return _FORMATTERS[tokenizer]


SEGMENT = ("conv_id long, segment long, formatted string, input_ids array<int>, starts array<int>, ends array<int>, "
           "loss array<boolean>")


def format_conversations(conversations: DataFrame, tokenizer: str, segment_turns: int = SEGMENT_TURNS) -> DataFrame:
    """One row per conversation segment: ``conv_id, segment, formatted,
    input_ids, starts, ends, loss`` (token offsets count code points of
    ``formatted``; most conversations are one segment, number 0)."""
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("row"), F.lit(1).alias("one"))
    # a turn's place: its place among all turns less that of its conversation's first
    placed = running_total(turns, ["conv_id", "turn", "role", "text", "row"], "one", "place", "turns")
    first = placed.groupBy("conv_id").agg(F.min("place").alias("first")).withColumnRenamed("conv_id", "first_of")
    segments = (placed.join(first, placed["conv_id"].eqNullSafe(first["first_of"]))
                .withColumn("segment", F.floor((F.col("place") - F.col("first")) / segment_turns))
                .groupBy("conv_id", "segment")
                .agg(F.sort_array(F.collect_list(F.struct("place", "role", "text"))).alias("turns")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chat = formatter(tokenizer)
        for pdf in batches:
            out = []
            for conv, segment, turns in zip(pdf["conv_id"], pdf["segment"], pdf["turns"], strict=True):
                text, spans = chat.render([(t["role"], t["text"]) for t in turns])
                ids, offsets = chat.encode(text)
                out.append((conv, segment, text, ids, offsets[:, 0], offsets[:, 1], loss_mask(spans, offsets)))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in SEGMENT.split(", ")]).astype({"conv_id": "Int64"})

    return segments.mapInPandas(run, SEGMENT)


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation, from the formatted output alone: ``conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.

    Segments of a conversation are read in order as a stream, so memory is
    bounded by a segment; a digest is sequential by nature."""
    kinds = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    turn = re.compile(f"{re.escape(TURN)}(.*?){re.escape(TEXT)}(.*?){re.escape(END)}", re.S)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held, done = (), None, []

        def close() -> None:
            n, turns, chars, loss, size = held
            done.append((now[0], n, turns.hexdigest(), chars, loss.hexdigest(), size))

        for pdf in batches:
            for conv, text, starts, ends, loss in zip(
                    pdf["conv_id"], pdf["formatted"], pdf["starts"], pdf["ends"], pdf["loss"], strict=True):
                conv = None if pd.isna(conv) else int(conv)
                if now != (conv,):
                    if held:
                        close()
                    now, held = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in turn.findall(text):
                    held[0] += 1
                    held[1].update(f"{ChatFormatter.unescape(role)}\n{ChatFormatter.unescape(said)}\n".encode())
                offsets = np.stack([np.asarray(starts, dtype=np.int64), np.asarray(ends, dtype=np.int64)], axis=1)
                for a, b in masked_runs(offsets, np.asarray(loss, dtype=bool)):
                    plain = ChatFormatter.unescape(text[a:b])
                    held[2] += len(plain)
                    held[3].update(plain.encode())
                held[4] += len(text)
            if done:
                yield pd.DataFrame(done, columns=[c.split()[0] for c in kinds.split(", ")]).astype({"conv_id": "Int64"})
                done.clear()
        if held:
            close()
            yield pd.DataFrame(done, columns=[c.split()[0] for c in kinds.split(", ")]).astype({"conv_id": "Int64"})

    return (formatted.select("conv_id", "segment", "formatted", "starts", "ends", "loss")
            .repartition(shuffle_parts(formatted.sparkSession), "conv_id").sortWithinPartitions("conv_id", "segment")
            .mapInPandas(run, kinds))
