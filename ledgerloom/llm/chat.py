"""Chat formatting as a prefix tree: conversations that share initial turns share their tokens.

A node is a turn together with all turns before it, so its id is a hash along the conversation. The
paths of all distinct conversations, in order, are the tree in depth-first order: a path adds the
nodes that it doesn't share with the path before it. Every node's tokens are emitted once, with
their place in the stream, the position of the first (what precedes it in its conversation) and the
intervals of the stream that hold its ancestors, to which alone it may attend.

Template: <|turn|>role<|body|>text<|end|>. Control strings inside roles and texts, the template's
and the usual ones of other templates, get a backslash after their first character, and one more
where they already have some; reading takes one away.
"""
from __future__ import annotations

import hashlib
import pickle
import re
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import bpe
from ledgerloom.llm.common import ship_package, staged
from ledgerloom.session import durable

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
LEARNED_ROLE = "assistant"
# What follows "<" or "[" in a control string.
AFTER = r"(?:(?<=<)(\\*)(?=\||s>|/s>|<SYS>>|</SYS>>)|(?<=\[)(\\*)(?=INST\]|/INST\]))"
CONTROL = re.compile(AFTER)
SHAPE = re.compile(re.escape(TURN) + "(.*?)" + re.escape(BODY) + "(.*?)" + re.escape(END), re.S)

TURNS = ("conv_id long, seq int, node binary, role string, token_ids binary, loss_start int, "
         "loss_end int")
LAYOUT = ("node binary, parent binary, depth int, start long, end long, position long, "
          "ancestors array<struct<start: long, end: long>>")


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: m.group() + "\\", text)


def unescape(text: str) -> str:
    return CONTROL.sub(lambda m: m.group()[1:], text)


def template(role: str, text: str) -> tuple[str, str, str]:
    """What precedes the text, the text as written, what follows."""
    return TURN + escape(role) + BODY, escape(text), END


# ---- turns to nodes

def _turn_batches(batches: Iterator[pa.RecordBatch], ranks: str, pattern: str):
    """Rows come in order within a conversation; only its running hash is kept."""
    coder, conversation, parent, seq = bpe.load(ranks, pattern), object(), b"", 0
    names = [field.split()[0] for field in TURNS.split(", ")]
    for batch in batches:
        out: list[list[Any]] = [[] for _ in names]
        for conv, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if conv != conversation:
                conversation, parent, seq = conv, b"", 0
            role, text = role or "", text or ""
            head, body, tail = (coder.packed(part) for part in template(role, text))
            mark = hashlib.blake2b(parent, digest_size=16)
            for part in (role.encode(), text.encode()):
                mark.update(len(part).to_bytes(8, "little") + part)
            parent = mark.digest()
            learned = role == LEARNED_ROLE
            start = len(head) // 4
            for column, value in zip(out, (conv, seq, parent, role, head + body + tail, start,
                                           start + learned * len(body) // 4)):
                column.append(value)
            seq += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.binary(), pa.string(),
                                                  pa.binary(), pa.int32(), pa.int32()))], names)


def turns_of(conversations: DataFrame, ranks: str, pattern: str) -> DataFrame:
    rows = (conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn",
                                 F.col("role").cast("string").alias("role"),
                                 F.col("text").cast("string").alias("text"))
            .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "role", "text"))
    return rows.mapInArrow(lambda batches: _turn_batches(batches, ranks, pattern), TURNS)


# ---- depth-first order

def shared_length(one: list[bytes], two: list[bytes]) -> int:
    n = 0
    while n < min(len(one), len(two)) and one[n] == two[n]:
        n += 1
    return n


def _walk(batches: Iterator[pa.RecordBatch], stack: list[tuple[bytes, int, int]], at: int):
    """(depth, stack) after each new node; the stack holds (node, start, end) along the path."""
    for batch in batches:
        for nodes, lengths in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
            del stack[shared_length([s[0] for s in stack], nodes):]
            for depth in range(len(stack), len(nodes)):
                stack.append((nodes[depth], at, at + lengths[depth]))
                at += lengths[depth]
                yield depth, stack


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per part: its first path, its last path, and how many tokens it adds by itself."""
    first: list[tuple[bytes, int, int]] = []
    stack: list[tuple[bytes, int, int]] = []
    total = 0
    for batch in batches:
        for nodes, lengths in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
            del stack[shared_length([s[0] for s in stack], nodes):]
            for node, length in list(zip(nodes, lengths))[len(stack):]:
                stack.append((node, total, total + length))
                total += length
            first = first or list(stack)
    if first:
        yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()],
                                          "tokens": [total], "paths": [pickle.dumps((first, stack))]})


def _starts(paths: DataFrame) -> dict[int, tuple[list, int]]:
    """For each part: the stack that the part before leaves, and where its tokens start. The driver
    sees two paths per part."""
    found = paths.mapInArrow(_summaries, "part long, tokens long, paths binary")
    out, stack, at = {}, [], 0
    for row in sorted(found.collect(), key=lambda r: r["part"]):
        first, last = pickle.loads(row["paths"])
        out[row["part"]] = (list(stack), at)
        shared = shared_length([s[0] for s in stack], [s[0] for s in first])
        less = first[shared - 1][2] if shared else 0        # tokens that are there already
        stack = [stack[d] if start < less else (node, at + start - less, at + end - less)
                 for d, (node, start, end) in enumerate(last)]
        at += row["tokens"] - less
    return out


def joined(stack: list[tuple[bytes, int, int]]) -> list[dict[str, int]]:
    """The stream intervals of a path, with those that touch made one."""
    out: list[dict[str, int]] = []
    for _, start, end in stack:
        if out and out[-1]["end"] == start:
            out[-1]["end"] = end
        else:
            out.append({"start": start, "end": end})
    return out


def layout(paths: DataFrame) -> DataFrame:
    """paths: distinct (nodes, lengths). Their order is made once and checkpointed, as two passes
    have to see the same parts."""
    ordered = durable(paths.select("nodes", "lengths").orderBy("nodes"))
    shared = paths.sparkSession.sparkContext.broadcast(_starts(ordered))
    interval = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    types = (pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), interval)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        if part not in shared.value:
            return
        stack, at = shared.value[part]
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = list(zip(*rows))
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                              [f.split()[0] for f in LAYOUT.split(", ")[:7]])
        for depth, path in _walk(batches, list(stack), at):
            node, start, end = path[depth]
            rows.append((node, path[depth - 1][0] if depth else None, depth, start, end,
                         sum(e - s for _, s, e in path[:depth]), joined(path[:depth])))
            if len(rows) == 1000:
                yield batch()
        if rows:
            yield batch()
    return ordered.mapInArrow(emit, LAYOUT)


def prefix_tree(conversations: DataFrame, ranks: str, pattern: str) -> tuple[DataFrame, DataFrame]:
    """(tree, index). tree: one row per node with node, parent, depth, role, token_ids (packed),
    start and end in the stream, position, ancestors, and loss_start, loss_end: the tokens of the
    node, from 0, that are learned (an assistant's text, without marks). index: conv_id and the
    nodes of its path, in order.

    Turns go by turn number; those that share one by role and text. Null roles and texts are empty,
    null conversations are one conversation. Conversations that are equal, or the start of another,
    add no node. Empty input: no rows. Further columns are ignored.
    """
    ship_package(conversations.sparkSession)
    turns = staged(turns_of(conversations, ranks, pattern))
    first = ("role", "token_ids", "loss_start", "loss_end")
    nodes = turns.groupBy("node").agg(*[F.first(c).alias(c) for c in first])
    steps = F.array_sort(F.collect_list(F.struct(
        "seq", "node", (F.octet_length("token_ids") / 4).cast("long").alias("length"))))
    paths = staged(turns.groupBy("conv_id").agg(steps.alias("steps"))
                   .select("conv_id", F.col("steps.node").alias("nodes"),
                           F.col("steps.length").alias("lengths")))
    distinct = (paths.groupBy(F.element_at("nodes", -1).alias("leaf"))
                .agg(F.first("nodes").alias("nodes"), F.first("lengths").alias("lengths")))
    tree = layout(distinct).join(nodes, "node")
    return tree, paths.select("conv_id", "nodes")


# ---- reading

def _read_batches(batches: Iterator[pa.RecordBatch], ranks: str, pattern: str):
    """Digests of each conversation from its nodes' tokens, which come in order."""
    coder = bpe.load(ranks, pattern)
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    state: list[Any] | None = None

    def row(s: list[Any]) -> tuple:
        return s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5]
    for batch in batches:
        done = []
        for conv, ids, start, end in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if state is None or state[0] != conv:
                if state is not None:
                    done.append(row(state))
                state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            written = coder.decode(ids).decode()
            role, text = map(unescape, SHAPE.fullmatch(written).groups())
            learned = unescape(coder.decode(ids[4 * start:4 * end]).decode())
            state[1] += 1
            state[2].update(f"{role}\n{text}\n".encode())
            state[3] += len(learned)
            state[4].update(learned.encode())
            state[5] += len(written)
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t)
                                          for i, t in enumerate(types)], names)
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row(state), types)], names)


def read_back(tree: DataFrame, index: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Per conversation, from tree and index alone: n_turns, turns_sha256 (role, line feed, text,
    line feed of every turn), loss_chars and loss_sha256 (the learned texts, unescaped) and
    formatted_chars."""
    steps = index.select("conv_id", F.posexplode("nodes").alias("seq", "node"))
    written = (steps.join(tree.select("node", "token_ids", "loss_start", "loss_end"), "node")
               .repartition("conv_id").sortWithinPartitions("conv_id", "seq")
               .select("conv_id", "token_ids", "loss_start", "loss_end"))
    return written.mapInArrow(
        lambda batches: _read_batches(batches, ranks, pattern),
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long")
