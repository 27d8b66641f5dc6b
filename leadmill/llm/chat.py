"""Chat formatting by columnar byte assembly.

Each turn becomes one segment: a header that marks its role, its text, and a footer.
Per batch of turns the lengths of all parts give cumulative offsets, and headers,
texts and footers are copied into one preallocated buffer that becomes an Arrow
column. A conversation is its segments in order; loss spans cover the texts of the
assistant.

Control strings inside a text or a role are escaped reversibly: a backslash is
doubled, and one is put behind the first character of a control string, so that no
control string is left inside a segment's text.

Turns are ordered by turn (null first), then role and text, so ties and repeated
rows have a defined place. Null text is empty, a null role is the empty role, a null
conv_id is a conversation of its own. Roles other than system, user and assistant
are carried by name. An empty table gives an empty table; other columns are left out.

Rows of a conversation go to one task, because its text is one sequence; they pass
through it in batches, so memory is bounded by a batch, not by the conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from leadmill.llm.common import partitions

# Fixed values of the template.
CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<ROLE>>", "<</ROLE>>"]
TURNS = {
    "system": ("<<SYS>>\n", "\n<</SYS>>\n\n"),
    "user": ("<s>[INST] ", " [/INST]"),
    "assistant": (" ", " </s>\n"),
}
OTHER = ("<<ROLE>>", " </s>\n")

CONTROL_PATTERN = r"([<\[])(/?s>|/?INST\]|</?SYS>>|</?ROLE>>)"
SEGMENT_PATTERN = (
    r"(?s)^(?:<<ROLE>>(?P<named>.*?)<</ROLE>>(?P<other>.*) </s>\n|(?P<system><<SYS>>)\n(?P<rules>.*)\n<</SYS>>\n\n"
    r"|(?P<user><s>\[INST\]) (?P<asked>.*) \[/INST\]| (?P<said>.*) </s>\n)$"
)
SEGMENTS = "conv_id bigint, turn bigint, at bigint, segment string, loss boolean, loss_start bigint, loss_end bigint"


def escape(texts: pa.Array) -> pa.Array:
    doubled = pc.replace_substring(texts, "\\", "\\\\")
    return pc.replace_substring_regex(doubled, CONTROL_PATTERN, r"\1\\\2")


def unescape(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, r"(?s)\\(.)", r"\1")


def joined(parts: list[pa.Array]) -> pa.Array:
    """Row-wise concatenation of string columns through one preallocated buffer."""
    rows = len(parts[0])
    if not rows:
        return pa.array([], pa.large_string())
    raw, starts, lengths = [], [], []
    for part in parts:
        part = pa.concat_arrays([part.cast(pa.large_binary())])
        offsets = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + rows + 1]
        raw.append(np.frombuffer(part.buffers()[2] or b"", np.uint8))
        starts.append(offsets[:-1])
        lengths.append(np.diff(offsets))
    ends = np.cumsum(np.column_stack(lengths).ravel())
    places = np.concatenate([[0], ends[:-1]]).reshape(rows, len(parts))
    out = np.empty(int(ends[-1]), np.uint8)
    for k, (source, start, length) in enumerate(zip(raw, starts, lengths, strict=True)):
        total = int(length.sum())
        inside = np.arange(total) - np.repeat(np.cumsum(length) - length, length)
        out[np.repeat(places[:, k], length) + inside] = source[np.repeat(start, length) + inside]
    offsets = np.concatenate([[0], ends.reshape(rows, len(parts))[:, -1]])
    return pa.Array.from_buffers(pa.large_string(), rows, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)])


def in_order(turns: DataFrame) -> DataFrame:
    """Whole conversations in each partition, turns in their order."""
    kept = turns.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    dealt = kept.repartition(partitions(turns.sparkSession), "conv_id")
    return dealt.sortWithinPartitions("conv_id", "turn", "role", "text")


def format_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, at, segment, loss, loss_start, loss_end), whole conversations in order in each partition.

    ``at`` counts a conversation's turns from 0. Loss bounds are code points within the segment; they are empty where ``loss`` is false.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, place = (), -1
        for batch in batches:
            conv, turn, role, text = batch.columns
            at = []
            for one in conv.to_pylist():
                last, place = (one,), place + 1 if last == (one,) else 0
                at.append(place)
            known = pc.is_in(role, pa.array(list(TURNS)))
            heads, feet = OTHER[0], OTHER[1]
            head = pc.if_else(known, "", pc.binary_join_element_wise(heads, escape(role), "<</ROLE>>", ""))
            foot = pc.if_else(known, "", feet)
            for name, (opens, closes) in TURNS.items():
                here = pc.equal(role, name)
                head, foot = pc.if_else(here, opens, head), pc.if_else(here, closes, foot)
            body = escape(text)
            loss = pc.equal(role, "assistant")
            start = pc.if_else(loss, pc.utf8_length(head), 0)
            end = pc.if_else(loss, pc.add(start, pc.utf8_length(body)), 0)
            segment = joined([head, body, foot]).cast(pa.string())
            yield pa.record_batch(
                [conv, turn, pa.array(at, pa.int64()), segment, loss, start.cast(pa.int64()), end.cast(pa.int64())],
                names=["conv_id", "turn", "at", "segment", "loss", "loss_start", "loss_end"],
            )

    return in_order(turns).mapInArrow(run, SEGMENTS)


def parse(segment: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Roles and texts read back from formatted segments."""
    found = pc.extract_regex(segment, SEGMENT_PATTERN)
    part = {name: pc.struct_field(found, name) for name in ("named", "other", "system", "rules", "user", "asked", "said")}
    is_system, is_user = pc.not_equal(part["system"], ""), pc.not_equal(part["user"], "")
    is_other = pc.starts_with(segment, "<<ROLE>>")
    role = pc.if_else(is_other, unescape(part["named"]), pc.if_else(is_system, "system", pc.if_else(is_user, "user", "assistant")))
    body = pc.if_else(is_other, part["other"], pc.if_else(is_system, part["rules"], pc.if_else(is_user, part["asked"], part["said"])))
    return role, unescape(body)


class Digest:
    """Running digests of one conversation."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def row(self, conv):
        return conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


DIGESTS = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def digests(segments: DataFrame) -> DataFrame:
    """One row per conversation, read back from the output of format_turns.

    Needs whole conversations in order in each partition, as format_turns leaves them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in DIGESTS.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

        def out(rows):
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        last, state = None, None
        for batch in batches:
            rows = []
            segment = batch.column("segment")
            role, text = parse(segment)
            lines = joined([role, pa.array(["\n"] * len(role)), text, pa.array(["\n"] * len(role))]).cast(pa.binary())
            loss = batch.column("loss").to_pylist()
            under = [
                s[a:b] if flag else ""
                for s, a, b, flag in zip(segment.to_pylist(), batch.column("loss_start").to_pylist(), batch.column("loss_end").to_pylist(), loss, strict=True)
            ]
            under = unescape(pa.array(under, pa.string())).to_pylist()
            for conv, line, said, size in zip(
                batch.column("conv_id").to_pylist(), lines.to_pylist(), under, pc.utf8_length(segment).to_pylist(), strict=True
            ):
                if state is None or conv != last:
                    if state is not None:
                        rows.append(state.row(last))
                    last, state = conv, Digest()
                state.n_turns += 1
                state.chars += size
                state.turns.update(line)
                state.loss_chars += len(said)
                state.loss.update(said.encode())
            yield out(rows)
        if state is not None:
            yield out([state.row(last)])

    return segments.select("conv_id", "segment", "loss", "loss_start", "loss_end").mapInArrow(run, DIGESTS)


def conversations_text(segments: DataFrame) -> DataFrame:
    """(conv_id, text): each conversation as one text."""
    parts = F.array_sort(F.collect_list(F.struct("at", "segment")))
    return segments.groupBy("conv_id").agg(F.concat_ws("", F.transform(parts, lambda p: p["segment"])).alias("text"))
