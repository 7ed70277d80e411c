"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant turns in
alternation, user first and assistant last.  Every source turn may be kept,
given another role, or merged into the turn before it, and empty turns may be
inserted; dynamic programming over the automaton's states (start, system, user,
assistant) finds the cheapest repair, the one of fewest turns among equals.

A turn is a 4 x 4 matrix of costs from state to state, and a run of turns is
their min-plus product.  So the rows are range-partitioned by (conversation,
turn), and a conversation that spans partitions, however long, is cut there: each
run gives its matrix, the matrices of such conversations (two to a partition at
most) give the states at the cuts, and every run is then repaired from its own
entry to its own exit.  Rendering is by source turn (what the turn closes, what
is inserted, its header and text), so no conversation becomes one cell; the
fragments in order are the rendered conversation.

Defined results.  Turns are ordered by turn (null last), role and a hash of the
text; rows that repeat all three are turns of their own.  A null conv_id is a
conversation like any other.  Null text is empty.  Roles are read without case
and outer blanks, with usual aliases; any other role, or null, fits every role
at ``unknown``.  Markers inside a text are broken up with a blank.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triad.llm.common import columns, cut

START, SYSTEM, USER, ASSISTANT = range(4)
NAMES = ("", "system", "user", "assistant")
# Other names of the roles.
ALIASES = {"system": SYSTEM, "developer": SYSTEM, "user": USER, "human": USER, "prompter": USER, "customer": USER,
           "assistant": ASSISTANT, "bot": ASSISTANT, "gpt": ASSISTANT, "model": ASSISTANT, "ai": ASSISTANT, "chatgpt": ASSISTANT}
#: Legal next roles, and the empty turns that make another role legal.
INSERTS = {(START, SYSTEM): (), (START, USER): (), (START, ASSISTANT): (USER,), (SYSTEM, USER): (), (SYSTEM, ASSISTANT): (USER,),
           (USER, ASSISTANT): (), (USER, USER): (ASSISTANT,), (ASSISTANT, USER): (), (ASSISTANT, ASSISTANT): (USER,)}
ENDING = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}
TURN = 1 << 32                   # a cost of 1; the low part counts turns
NEVER = 1 << 60
KEEP, MERGE = 0, 1


@dataclass(frozen=True)
class Costs:
    merge: int = 1
    insert: int = 2
    relabel: int = 3
    unknown: int = 1


def role_code(role: str | None) -> int:
    return ALIASES.get((role or "").strip().lower(), START)


def options(p: Costs) -> list[list[list[tuple[int, int, int]]]]:
    """By source role and state: (packed cost, next state, KEEP or MERGE), best first for each next state."""
    out = []
    for role in range(4):
        rows = []
        for s in range(4):
            found: dict[int, tuple] = {}
            for q in (SYSTEM, USER, ASSISTANT):
                change = 0 if q == role else p.unknown if role == START else p.relabel
                if q == s:
                    found[q] = (change + p.merge) * TURN, q, MERGE
                if (s, q) in INSERTS:
                    n = len(INSERTS[s, q])
                    keep = (change + n * p.insert) * TURN + n + 1, q, KEEP
                    found[q] = min(found.get(q, keep), keep)
            rows.append([found[q] for q in sorted(found)])
        out.append(rows)
    return out


def matrices(p: Costs) -> np.ndarray:
    m = np.full((4, 4, 4), NEVER, dtype=np.int64)
    for role, rows in enumerate(options(p)):
        for s, found in enumerate(rows):
            for cost, q, _ in found:
                m[role, s, q] = cost
    return m


def ending(p: Costs) -> np.ndarray:
    return np.array([len(ENDING[s]) * (p.insert * TURN + 1) for s in range(4)], dtype=np.int64)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None]).min(axis=1), NEVER)


IDENTITY = np.where(np.eye(4, dtype=bool), 0, NEVER)


def run_costs(rows: DataFrame, p: Costs) -> DataFrame:
    """conv_id, part, m (16 packed costs) of the runs at either edge of each partition."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        each, edge, conv, part, m, first = matrices(p), [], None, None, None, True
        for f in frames:
            for c, k, role in zip(f["conv_id"], f["part"], f["role"], strict=True):
                c = None if pd.isna(c) else int(c)
                if m is None or c != conv:
                    if m is not None and first:
                        edge.append((conv, part, m.ravel().tolist()))
                        first = False
                    conv, m = c, IDENTITY
                part = int(k)
                m = product(m, each[role_code(role)])
        if m is not None:
            edge.append((conv, part, m.ravel().tolist()))
        yield pd.DataFrame({"conv_id": pd.array([e[0] for e in edge], "Int64"), "part": [e[1] for e in edge], "m": [e[2] for e in edge]})

    return rows.select("conv_id", "part", "role").mapInPandas(run, "conv_id long, part int, m array<long>")


def cuts(edges: DataFrame, p: Costs) -> DataFrame:
    """conv_id, part, entry, leave, turns_before, last for the runs of conversations that span partitions."""

    def solve(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("part")
        ms = [np.array(m, dtype=np.int64).reshape(4, 4) for m in f["m"]]
        v = [IDENTITY[START]]
        for m in ms:
            v.append(np.minimum((v[-1][:, None] + m).min(axis=0), NEVER))
        state, states = int((v[-1] + ending(p)).argmin()), []
        for k in range(len(ms) - 1, -1, -1):
            entry = int((v[k] + ms[k][:, state]).argmin())
            states.append((entry, state, int(v[k][entry]) % TURN, k == len(ms) - 1))
            state = entry
        out = f[["conv_id", "part"]].reset_index(drop=True)
        out[["entry", "leave", "turns_before", "last"]] = pd.DataFrame(states[::-1])
        return out

    spanning = edges.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("conv_id").alias("_c"))
    few = edges.join(spanning, edges["conv_id"].eqNullSafe(spanning["_c"]), "left_semi")
    return few.groupBy("conv_id").applyInPandas(
        solve, "conv_id long, part int, entry int, leave int, turns_before long, last boolean")


def best_path(roles: list[int], entry: int, leave: int | None, p: Costs) -> list[tuple[int, int, int]]:
    """(state before, role, KEEP or MERGE) of each turn on the cheapest path."""
    choices = options(p)
    v, back = {entry: 0}, []
    for r in roles:
        nxt: dict[int, tuple] = {}
        for s, cost in v.items():
            for c, q, how in choices[r][s]:
                if q not in nxt or (cost + c, s) < nxt[q][:2]:
                    nxt[q] = (cost + c, s, how)
        back.append(nxt)
        v = {q: x[0] for q, x in nxt.items()}
    end = ending(p)
    state = min(v, key=lambda s: (v[s] + int(end[s]), s)) if leave is None else leave
    out = []
    for nxt in reversed(back):
        _, s, how = nxt[state]
        out.append((s, state, how))
        state = s
    return out[::-1]


def head(role: int) -> str:
    return f"<|im_start|>{NAMES[role]}\n"


FOOT = "<|im_end|>\n"
OUT = ("conv_id long, turn long, role string, out_turn long, out_role string, action string, inserted string, rendered string")


def repair_run(rows: list[tuple], entry: int, leave: int | None, before: int, last: bool, p: Costs) -> list[tuple]:
    """The output rows of one run of (conv_id, turn, role, text)."""
    codes = [role_code(r[2]) for r in rows]
    out, n = [], before - 1
    for i, ((conv, turn, role, text), code, (s, q, how)) in enumerate(zip(rows, codes, best_path(codes, entry, leave, p), strict=True)):
        text = (text or "").replace("<|im_", "<| im_")
        empty = INSERTS[s, q] if how == KEEP else ()
        n += 0 if how == MERGE else len(empty) + 1
        if how == MERGE:
            drawn = "\n\n" + text
        else:
            drawn = (FOOT if s != START else "") + "".join(head(x) + FOOT for x in empty) + head(q) + text
        act = ("merge" if how == MERGE else "keep") if q == code else ("merge and relabel" if how == MERGE else "relabel")
        names = [NAMES[x] for x in empty]
        if last and i == len(rows) - 1:
            drawn += FOOT + "".join(head(x) + FOOT for x in ENDING[q])
            names += [f"end:{NAMES[x]}" for x in ENDING[q]]
        out.append((conv, turn, role, n, NAMES[q], act, ",".join(names), drawn))
    return out


def repair(conversations: DataFrame, p: Costs = Costs()) -> DataFrame:
    """One row for each source turn, see OUT: its repaired role and turn number, what
    was done, the empty turns inserted before it (after it with ``end:``), and its
    part of the rendered conversation."""
    order = ["conv_id", F.col("turn").isNull(), "turn", "role", F.xxhash64("text")]
    rows = columns(conversations, conv_id="long", turn="long", role="string", text="string")
    rows = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()))
    known = cuts(run_costs(rows, p), p).select(F.col("conv_id").alias("_c"), F.col("part").alias("_p"), "entry", "leave", "turns_before", "last")
    # at most two rows to a partition, so small at any size of input
    rows = rows.join(F.broadcast(known), (F.col("part") == F.col("_p")) & F.col("conv_id").eqNullSafe(F.col("_c")), "left").drop("_c", "_p", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string())
        names = [x.split()[0] for x in OUT.split(", ")]

        def turns():
            for b in batches:
                yield from zip(*(c.to_pylist() for c in b.columns), strict=True)

        def batch(out):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

        out, held = [], 0
        for _, group in groupby(turns(), key=lambda r: r[0]):
            group = list(group)
            entry, leave, before, last = group[0][4:]
            done = repair_run([r[:4] for r in group], START if entry is None else entry, leave, before or 0, last is not False, p)
            out += done
            held += sum(len(r[7]) for r in done)
            if held > 1 << 22:
                yield batch(out)
                out, held = [], 0
        if out:
            yield batch(out)

    return rows.mapInArrow(run, OUT)


def op8_role_repair(spark, sf_dir: str) -> DataFrame:
    """The repaired and rendered turns of every conversation."""
    return repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
