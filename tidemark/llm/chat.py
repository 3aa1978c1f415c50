"""Chat formatting: conversations as token ids with a loss mask, assembled from separately encoded segments.

A turn is ``<|turn|>`` role ``<|text|>`` text ``</s>``. The three marks are reserved ids spliced between the ids
of the role and of the text; encoding a segment can never give them. The loss mask is the prefix sum of +1
where a text to learn begins and -1 where it ends.

Control strings inside a role or text are broken by a backslash after their first character, and one more where
backslashes stand there already, so escaping is undone exactly. The sign that the tokenizer uses for a space is
written as ``[|_|]``, because decoding could not tell it from one.

A turn is formatted where it lies. Reading back sorts the turns of a conversation within a partition and
streams over them with two running digests, so a conversation of any length needs no more memory than a batch.

Rows: a NULL text is an empty one and so is a NULL role. Turns go by ``turn``, NULL first, equal ones by role
and text. Rows without a conv_id are one conversation whose id is NULL. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "</s>"
# Ids of the marks: the model's own end id, and two past its vocabulary of 32,000.
RESERVED = {END: 2, TURN: 32_000, TEXT: 32_001}
CONTROL = (
    "<s>", "</s>", "<unk>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|turn|>", "<|text|>", "<|endoftext|>",
    "<|startoftext|>", "<|im_start|>", "<|im_end|>", "[|_|]",
)
SIGN, SIGN_WRITTEN = "\u2581", "[|_|]"
LEARNED_ROLES = ("assistant",)

_TAILS = {first: "|".join(re.escape(c[1:]) for c in CONTROL if c[0] == first) for first in "<["}
_PLAIN = re.compile("|".join(rf"{re.escape(f)}(?=\\*(?:{t}))" for f, t in _TAILS.items()))
_ESCAPED = re.compile("|".join(rf"(?<={re.escape(f)})\\(?=\\*(?:{t}))" for f, t in _TAILS.items()) + r"|\[\|_\|\]")


def escape(text: str) -> str:
    return _PLAIN.sub(lambda m: m[0] + "\\", text).replace(SIGN, SIGN_WRITTEN)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "" if m[0] == "\\" else SIGN, text)


def format_turns(
    rows: DataFrame,
    model_path: str,
    learned_roles: tuple[str, ...] = LEARNED_ROLES,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """(conv_id, turn, formatted, ids, mask) per row: the text of the turn, its ids, and the ids to learn."""
    read = rows.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"),
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=model_path)
        for batch in batches:
            roles, texts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            formatted, ids, masks = [], [], []
            for role, text in zip(roles, texts):
                inner = [escape(role), escape(text)]
                head, body = processor.encode(inner)
                segments = [[RESERVED[TURN]], head, [RESERVED[TEXT]], body, [RESERVED[END]]]
                edges = np.cumsum([0, *map(len, segments)])
                steps = np.zeros(edges[-1] + 1, np.int8)
                if role in learned_roles:
                    np.add.at(steps, edges[3:5], (1, -1))
                formatted.append(f"{TURN}{inner[0]}{TEXT}{inner[1]}{END}")
                ids.append(np.array(sum(segments, []), np.int32))
                masks.append(np.cumsum(steps[:-1], dtype=np.int8))
            arrays = [batch.column(0), batch.column(1), pa.array(formatted, pa.string()),
                      pa.array(ids, pa.list_(pa.int32())), pa.array(masks, pa.list_(pa.int8()))]
            yield pa.RecordBatch.from_arrays(arrays, ["conv_id", "turn", "formatted", "ids", "mask"])

    return read.mapInArrow(work, "conv_id long, turn long, formatted string, ids array<int>, mask array<byte>")


def read_turn(ids: np.ndarray, mask: np.ndarray, decode) -> tuple[str, str, str]:
    """Role, text and learned text of a turn, from its ids and mask alone."""
    middle = int(np.flatnonzero(ids == RESERVED[TEXT])[0])
    role, text = decode(ids[1:middle].tolist()), decode(ids[middle + 1 : -1].tolist())
    return unescape(role), unescape(text), unescape(decode(ids[mask.astype(bool)].tolist()))


def digests(turns: DataFrame, model_path: str) -> DataFrame:
    """One row per conversation, read back from the ids and masks of its formatted turns."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        decode = sentencepiece.SentencePieceProcessor(model_file=model_path).decode
        current, state, done = object(), None, []

        def close():
            if state is not None:
                done.append((current, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        def flush():
            columns = list(zip(*done)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], NAMES)
            done.clear()
            return out

        for batch in batches:
            conversations, formatted = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at, conv in enumerate(conversations):
                if state is None or conv != current:
                    close()
                    current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                ids = batch.column(2)[at].values.to_numpy(zero_copy_only=False)
                mask = batch.column(3)[at].values.to_numpy(zero_copy_only=False)
                role, text, learned = read_turn(ids, mask, decode)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(learned)
                state[3].update(learned.encode())
                state[4] += len(formatted[at])
            yield flush()
        close()
        yield flush()

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    return ordered.select("conv_id", "formatted", "ids", "mask").mapInArrow(work, DIGEST_SCHEMA)


NAMES = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
DIGEST_SCHEMA = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)
