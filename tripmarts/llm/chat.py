"""Chat formatting on token ids.

Every text is encoded on its own, so no merge crosses a border, and reserved ids above the
vocabulary are put around it. Loss masks come from prefix sums of the segment lengths. Strings
that look like control strings are escaped in the text before encoding, reversibly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Template: control strings in the order of their reserved ids.
CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|role|>", "<|says|>"]
# Opening and closing control string of a role; other roles are spelled out.
MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
LOSS_ROLE = "assistant"

_FIRST = "".join(sorted({re.escape(c[0]) for c in CONTROLS}))
_REST = "|".join(re.escape(c[1:]) for c in CONTROLS)
_BARE = re.compile(rf"([{_FIRST}])(\\*)({_REST})")
_ESCAPED = re.compile(rf"([{_FIRST}])\\(\\*)({_REST})")


def escape(text: str) -> str:
    """Put one backslash more behind the first character of whatever reads as a control string."""
    return _BARE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


@lru_cache(maxsize=2)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.encode_special_tokens = True
    made.no_truncation()
    made.no_padding()
    return made


def loss_mask(lengths: list[int], in_loss: list[bool]) -> np.ndarray:
    """1 for the tokens of the segments in the loss: running sum of +1 at their starts, -1 at their ends."""
    lengths = np.asarray(lengths, np.int64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    steps = np.zeros(int(lengths.sum()) + 1, np.int8)
    chosen = np.asarray(in_loss, bool) & (lengths > 0)
    np.add.at(steps, starts[chosen], 1)
    np.add.at(steps, ends[chosen], -1)
    return np.cumsum(steps, dtype=np.int8)[:-1]


TURN = pa.schema([
    ("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()),
    ("ids", pa.list_(pa.int32())), ("mask", pa.list_(pa.int8())), ("n_tokens", pa.int64()), ("digest", pa.string()),
])
TURN_DDL = "conv_id long, turn long, role string, ids array<int>, mask array<tinyint>, n_tokens long, digest string"


def format_conversations(conversations: DataFrame, tokenizer_path: str) -> DataFrame:
    """Rows ``conv_id, turn, role`` and ``text`` as token ids with loss masks.

    One row per turn, so that a conversation of any length fits: ``seq`` numbers the turns of a
    conversation from 0, ``ids`` and ``mask`` belong to the turn and ``first_token`` is its place
    in the conversation. Turns with equal numbers are ordered by role, then by a digest of the
    text; a NULL turn comes first, a NULL role or text is empty, a NULL conversation id is a
    conversation of its own. Repeated rows are repeated turns.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(tokenizer_path)
        control = {text: coder.get_vocab_size() + n for n, text in enumerate(CONTROLS)}
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                roles, texts = part.column("role").to_pylist(), part.column("text").to_pylist()
                coded = [x.ids for x in coder.encode_batch([escape(x) for x in texts], add_special_tokens=False)]
                spelled = {r: coder.encode(escape(r), add_special_tokens=False).ids for r in {*roles} - MARKS.keys()}
                ids, masks = [], []
                for role, body in zip(roles, coded, strict=True):
                    if role in MARKS:
                        before, after = MARKS[role]
                        head = [control[before]]
                    else:
                        head, after = [control["<|role|>"], *spelled[role], control["<|says|>"]], "</s>"
                    ids.append(np.array([*head, *body, control[after]], np.int32))
                    masks.append(loss_mask([len(head), len(body), 1], [False, role == LOSS_ROLE, False]))
                yield pa.RecordBatch.from_arrays([
                    part.column("conv_id"), part.column("turn"), part.column("role"),
                    pa.array(ids, pa.list_(pa.int32())), pa.array(masks, pa.list_(pa.int8())),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in texts], pa.string()),
                ], schema=TURN)

    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "digest")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    turns = rows.mapInArrow(encode, TURN_DDL)
    return turns.select(
        "conv_id",
        (F.row_number().over(order) - 1).cast("long").alias("seq"),
        "turn",
        "role",
        F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("first_token"),
        "ids",
        "mask",
    )


PART = pa.schema([
    ("conv_id", pa.int64()), ("seq", pa.int64()), ("role", pa.string()), ("text", pa.string()),
    ("loss", pa.string()), ("formatted_chars", pa.int64()),
])


def read_turns(formatted: DataFrame, tokenizer_path: str) -> DataFrame:
    """Role, text, text under the loss mask and formatted length of every turn, from ids and mask alone."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(tokenizer_path)
        size = coder.get_vocab_size()
        roles = {before: role for role, (before, _) in MARKS.items()}
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                flat_ids, ends = _flat(part.column("ids"))
                flat_mask, _ = _flat(part.column("mask"))
                pieces, places = [], []
                for a, b in zip([0, *ends[:-1]], ends, strict=True):
                    ids, mask = flat_ids[a:b], flat_mask[a:b]
                    # A segment ends where control and text, or loss and none, change.
                    marks = np.flatnonzero(ids >= size)
                    place = {"open": CONTROLS[ids[0] - size], "marks": [CONTROLS[i - size] for i in ids[marks]]}
                    body = marks[1] + 1 if place["open"] == "<|role|>" else 1
                    place |= {"role": len(pieces)} if body > 1 else {}
                    if body > 1:
                        pieces.append(ids[1 : marks[1]].tolist())
                    place["text"] = len(pieces)
                    pieces.append(ids[body:-1].tolist())
                    place["loss"] = len(pieces)
                    pieces.append(ids[mask == 1].tolist())
                    places.append(place)
                decoded = coder.decode_batch(pieces, skip_special_tokens=False)
                rows = {"role": [], "text": [], "loss": [], "formatted_chars": []}
                for place in places:
                    spelled = decoded[place["role"]] if "role" in place else ""
                    rows["role"].append(unescape(spelled) if "role" in place else roles[place["open"]])
                    rows["text"].append(unescape(decoded[place["text"]]))
                    rows["loss"].append(unescape(decoded[place["loss"]]))
                    rows["formatted_chars"].append(
                        sum(map(len, place["marks"])) + len(spelled) + len(decoded[place["text"]])
                    )
                columns = [part.column("conv_id"), part.column("seq"), *rows.values()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) if isinstance(c, list) else c for c, f in zip(columns, PART, strict=True)],
                    schema=PART,
                )

    return formatted.mapInArrow(
        decode, "conv_id long, seq long, role string, text string, loss string, formatted_chars long"
    )


def _flat(column: pa.ListArray) -> tuple[np.ndarray, list[int]]:
    lengths = column.value_lengths().to_numpy()
    return column.flatten().to_numpy(zero_copy_only=False), np.cumsum(lengths).tolist()


DIGEST = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
])


def conversation_digests(turns: DataFrame) -> DataFrame:
    """Per conversation: turns, digests of turns and loss text, and lengths.

    The turns pass in order and only running digests are kept, whatever a conversation's length.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, done = None, []

        def finished():
            return (state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5])

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("conv_id", "role", "text", "loss", "formatted_chars")]
            for conv_id, role, text, loss, chars in zip(*columns, strict=True):
                if state is None or state[0] != conv_id:
                    if state is not None:
                        done.append(finished())
                    state = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                state[3] += len(loss)
                state[4].update(loss.encode())
                state[5] += chars
            if len(done) > 5000:
                yield _rows(done)
                done = []
        if state is not None:
            done.append(finished())
        if done:
            yield _rows(done)

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    return ordered.mapInArrow(
        digest,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


def _rows(done: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), DIGEST, strict=True)], schema=DIGEST
    )
