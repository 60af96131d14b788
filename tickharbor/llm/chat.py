"""Conversations made legal at least cost, and rendered for training.

A legal conversation has at most one system turn, first, then user and assistant turns in alternation from
user to assistant. Every turn keeps its text; dynamic programming over the automaton of legal turns chooses,
at least total cost, whether a turn is kept, gets another role, joins the turn before it, or needs empty
turns inserted before it. What a role can do from each state is a 4 x 4 matrix of costs; a run of turns is
the product of its matrices in (min, +). So a conversation of any length is cut into slices: slices give
their matrices, matrices give the states between slices, and every slice then finds its own choices.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickharbor.llm.tables import tasks_of
from tickharbor.session import stored

# Turns of a slice.
SLICE = 4096
ROLES = ("system", "user", "assistant")
# States: nothing yet, or the role of the last turn.
START, SYSTEM, USER, ASSISTANT = range(4)
MERGE, INSERT = 1, 2
# Cost of another role; a turn of a role that is not known must get one.
RELABEL = {"system": {"user": 3, "assistant": 4}, "user": {"system": 4, "assistant": 3},
           "assistant": {"system": 4, "user": 3}, None: {"system": 3, "user": 2, "assistant": 3}}
NEVER = 1 << 40

OPEN, CLOSE, JOIN = "<|im_start|>{}\n", "<|im_end|>\n", "\n\n"


class Choice(NamedTuple):
    state: int
    cost: int
    inserted: tuple[str, ...]
    role: str
    merged: bool


def known_role(role: str | None) -> str | None:
    role = (role or "").strip().lower()
    return role if role in ROLES else None


def _before(state: int, role: str) -> tuple[str, ...] | None:
    """Empty turns that must come before a turn of a role; None if it cannot come."""
    if role == "system":
        return () if state == START else None
    if role == "user":
        return ("assistant",) if state == USER else ()
    return () if state == USER else ("user",)


def choices(state: int, role: str | None) -> list[Choice]:
    """What can become of a turn, best first where costs are equal."""
    out = []
    for label in ROLES:
        change = 0 if label == role else RELABEL[role][label]
        own = ROLES.index(label) + 1
        inserted = _before(state, label)
        if inserted is not None:
            out.append(Choice(own, change + INSERT * len(inserted), inserted, label, False))
        if state == own:
            out.append(Choice(own, change + MERGE, (), label, True))
    return sorted(out, key=lambda c: (c.cost, len(c.inserted), c.role != role))


# Empty turns that end a conversation, by its last state.
ENDS = {START: (), SYSTEM: ("user", "assistant"), USER: ("assistant",), ASSISTANT: ()}
CHOICES = {role: [choices(state, role) for state in range(4)] for role in (None, *ROLES)}


def matrix(role: str | None) -> np.ndarray:
    out = np.full((4, 4), NEVER, dtype=np.int64)
    for state in range(4):
        for choice in CHOICES[role][state]:
            out[state, choice.state] = min(out[state, choice.state], choice.cost)
    return out


MATRICES = {role: matrix(role) for role in CHOICES}


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), NEVER)


def path(steps: list[np.ndarray], entry: int, leave: int | None = None) -> list[int]:
    """States along the cheapest way through some matrices; the last state is given or costs its ending."""
    costs = [np.where(np.arange(4) == entry, 0, NEVER)]
    for step in steps:
        costs.append(np.minimum((costs[-1][:, None] + step).min(axis=0), NEVER))
    last = costs[-1] + (np.array([INSERT * len(ENDS[s]) for s in range(4)]) if leave is None else
                        np.where(np.arange(4) == leave, 0, NEVER))
    states = [int(last.argmin())]
    for cost, step in zip(reversed(costs[:-1]), reversed(steps)):
        states.append(int((cost + step[:, states[-1]]).argmin()))
    return states[::-1]


def repair(roles: list[str | None], entry: int = START, leave: int | None = None) -> list[Choice]:
    """The cheapest choice for each turn."""
    known = [known_role(r) for r in roles]
    states = path([MATRICES[r] for r in known], entry, leave)
    return [next(c for c in CHOICES[r][a] if c.state == b) for r, a, b in zip(known, states, states[1:])]


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, list[dict]]]:
    """Rows of equal key that follow each other, across batches."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for value, run in groupby(rows, key=lambda row: row[key]):
        yield value, list(run)


def _numbered(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        number, place, current = -1, 0, object()
        for batch in batches:
            slices, places = [], []
            for conversation in batch.column("conv_id").to_pylist():
                if conversation != current or place == size:
                    number, place, current = number + 1, 0, conversation
                slices.append((part << 32) | number)
                places.append(place)
                place += 1
            yield batch.append_column("slice", pa.array(slices, pa.int64())).append_column("place", pa.array(places, pa.int32()))

    return rows


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for number, rows in _runs(batches, "slice"):
        whole = MATRICES[known_role(rows[0]["role"])]
        for row in rows[1:]:
            whole = product(whole, MATRICES[known_role(row["role"])])
        yield pa.RecordBatch.from_pylist([{"conv_id": rows[0]["conv_id"], "slice": number, "costs": whole.ravel().tolist()}],
                                         schema=pa.schema([("conv_id", pa.int64()), ("slice", pa.int64()), ("costs", pa.list_(pa.int64()))]))


def _between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First and last state of every slice of a conversation; a null last state ends the conversation."""
    shape = pa.schema([("slice", pa.int64()), ("entry", pa.int32()), ("leave", pa.int32()), ("ends", pa.bool_())])
    for _, rows in _runs(batches, "conv_id"):
        states = path([np.array(r["costs"]).reshape(4, 4) for r in rows], START)
        yield pa.RecordBatch.from_pylist([
            {"slice": r["slice"], "entry": a, "leave": b, "ends": r is rows[-1]} for r, a, b in zip(rows, states, states[1:])],
            schema=shape)


def clean(text: str | None) -> str:
    """Text that cannot be taken for a mark of the template."""
    return (text or "").replace("<|", "< |")


def fragments(rows: list[dict]) -> Iterator[tuple[int | None, str, str, str]]:
    """(turn, role, action, fragment) for the turns of a slice; joined fragments are the rendered conversation."""
    begun = rows[0]["entry"] != START

    def opening(role: str) -> str:
        nonlocal begun
        mark = (CLOSE if begun else "") + OPEN.format(role)
        begun = True
        return mark

    for row, choice in zip(rows, repair([r["role"] for r in rows], rows[0]["entry"], rows[0]["leave"])):
        for role in choice.inserted:
            yield None, role, "insert", opening(role)
        if choice.merged:
            yield row["turn"], choice.role, "merge", JOIN + clean(row["text"])
        else:
            action = "keep" if choice.role == known_role(row["role"]) else "relabel"
            yield row["turn"], choice.role, action, opening(choice.role) + clean(row["text"])
    if rows[0]["ends"]:
        for role in ENDS[rows[0]["leave"]]:
            yield None, role, "insert", opening(role)
        yield None, ROLES[ASSISTANT - 1], "end", CLOSE


def _rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shape = pa.schema([("conv_id", pa.int64()), ("slice", pa.int64()), ("place", pa.int32()), ("turn", pa.int64()), ("role", pa.string()),
                       ("action", pa.string()), ("fragment", pa.string())])
    for number, rows in _runs(batches, "slice"):
        yield pa.RecordBatch.from_pylist([
            {"conv_id": rows[0]["conv_id"], "slice": number, "place": k, "turn": turn, "role": role, "action": action, "fragment": text}
            for k, (turn, role, action, text) in enumerate(fragments(rows))], schema=shape)


def chat_fragments(conversations: DataFrame, slice_turns: int = SLICE) -> DataFrame:
    """``conv_id, slice, place, turn, role, action, fragment``: the repaired and rendered conversations.

    Fragments in order of ``slice, place`` make up the text of a conversation: one for each turn, one without
    ``turn`` for each empty turn inserted, and one that closes it. ``action`` is keep, relabel, merge, insert
    or end. Turns are in order of ``turn``, those without first, equal ones by role and text. Roles are read
    without case and outer white space; others, and null, are unknown. A null text is empty. Rows without
    ``conv_id`` are one conversation. Other columns are ignored; an empty table gives no rows. Turns are range
    partitioned, so a conversation of any size is dealt out; no task holds more than a slice of ``slice_turns`` of it.
    """
    known = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role",
                                 F.coalesce("text", F.lit("")).alias("text"))
    order = ["conv_id", "turn", "role", "text"]
    # Little is shuffled but every row costs time: the number of tasks must not shrink with the bytes.
    tasks = tasks_of(conversations.sparkSession)
    dealt = known.repartitionByRange(tasks, *order[:3], F.xxhash64("text"))
    turns = stored(dealt.sortWithinPartitions(*order).mapInArrow(
        _numbered(slice_turns), "conv_id long, turn long, role string, text string, slice long, place int"), "chat-turns")
    costs = (turns.select("conv_id", "slice", "place", "role").repartition(tasks, "slice").sortWithinPartitions("slice", "place")
             .mapInArrow(_products, "conv_id long, slice long, costs array<long>"))
    states = stored(costs.repartition(tasks, "conv_id").sortWithinPartitions("conv_id", "slice").mapInArrow(
        _between, "slice long, entry int, leave int, ends boolean"), "chat-states")
    return (turns.join(states, "slice").repartition("slice").sortWithinPartitions("slice", "place")
            .select("conv_id", "slice", "turn", "role", "text", "entry", "leave", "ends")
            .mapInArrow(_rendered, "conv_id long, slice long, place int, turn long, role string, action string, fragment string"))
