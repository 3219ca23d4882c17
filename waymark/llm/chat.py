"""Chat formatting by minimum-cost role repair.

A conversation is legal when it follows the automaton of ``NEXT``: an optional
system message, then user and assistant by turns, ending with the assistant.
Every turn is kept, given another role, or merged into the message before it, and
empty messages may be inserted; dynamic programming over the automaton finds
the repair of least total cost (``COST``), and the repaired sequence is rendered.
Nothing is dropped.  Ties are broken by a hash of the edited turns, so the repair
doesn't depend on how the work was split.

The cost of a run of turns is a matrix over (role before, role after), and runs
combine by the (min, +) product.  So a conversation of any length, a third of
the table too, is range-partitioned by (conversation, turn): tasks reduce the parts
to matrices, the few matrices of each conversation are chained, and the tasks then
trace their part between the roles that the chain fixed.

Result: a row per turn, in the order of ``place``.  ``rendered`` holds the text that
this turn adds, with the markup and empty messages that stand before it and, on the
last turn, after it: the pieces of a conversation joined in order are its rendering.

Turns are ordered by turn number, equal ones by their hash; null turns come last,
null texts are empty, null and unknown roles cost a relabelling, rows with a null
conversation form one conversation, and repeated rows are turns of their own.  An
empty table gives an empty result.  Extra columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import stored

ROLES = ("start", "system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
#: Roles that may follow a message of each role, and roles that may end.
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
END = (ASSISTANT,)
COST = {"merge": 1, "insert": 2, "relabel": 3}
#: Other names of the roles, free of cost.
ALIAS = {"human": "user", "prompter": "user", "bot": "assistant", "gpt": "assistant", "model": "assistant", "ai": "assistant"}
OPEN, CLOSE, JOIN = "<|im_start|>{}\n", "<|im_end|>\n", "\n\n"
NEVER = 1 << 120
UNIT = 1 << 64                                   # one unit of cost; below it the tie-break


def _inserted(a: int, accept: Sequence[int]) -> list[int] | None:
    """Fewest empty messages after role ``a`` until a role of ``accept`` may follow
    (or, for the end, has been reached)."""
    seen, todo = {a}, [(a, [])]
    for q, path in todo:
        if q in accept:
            return path
        for r in NEXT[q]:
            if r not in seen:
                seen.add(r)
                todo.append((r, [*path, r]))
    return None


#: Empty messages between a message of role a and one of role b, and after the last one.
BETWEEN = {(a, b): _inserted(a, [q for q in NEXT if b in NEXT[q]]) for a in range(4) for b in range(1, 4)}
AFTER = {a: _inserted(a, END) for a in range(4)}


def known_role(role: Column) -> Column:
    """Index of the role in ROLES; 0 for a null or unknown one."""
    r = F.lower(F.trim(role))
    out = F.lit(0)
    for name, of in [*((r, r) for r in ROLES[1:]), *ALIAS.items()]:
        out = F.when(r == name, F.lit(ROLES.index(of))).otherwise(out)
    return out


def _steps(role: int, salt: int) -> list[tuple[int, int, int, str]]:
    """(before, after, cost, action) of everything that may be done with one turn."""
    out = []
    for a in range(4):
        if a != START:
            wrong = role != a
            c = COST["merge"] + COST["relabel"] * wrong
            out.append((a, a, c * UNIT + (salt >> 8 * wrong) % (1 << 24) + 1, "merge"))
        for b in range(1, 4):
            between = BETWEEN[a, b]
            if between is None:
                continue
            wrong = role != b
            c = COST["insert"] * len(between) + COST["relabel"] * wrong
            tie = (salt >> (16 + 4 * b + 2 * wrong + len(between))) % (1 << 24) + 1 if c else 0
            out.append((a, b, c * UNIT + tie, "relabel" if wrong else "keep"))
    return out


def after_cost(q: int) -> int:
    return COST["insert"] * len(AFTER[q]) * UNIT if AFTER[q] is not None else NEVER


def reduce_run(turns: Sequence[tuple[int, int]]) -> list[int]:
    """The 4 x 4 cost matrix (row-major) of a run of (role, salt)."""
    m = [0 if a == b else NEVER for a in range(4) for b in range(4)]
    for role, s in turns:
        new = [NEVER] * 16
        for a, b, c, _ in _steps(role, s):
            for e in range(0, 16, 4):
                if m[e + a] + c < new[e + b]:
                    new[e + b] = m[e + a] + c
        m = new
    return m


def chain(runs: Sequence[Sequence[int]]) -> tuple[list[int], int]:
    """Roles at the borders of a conversation's runs on its cheapest repair, and the cost."""
    best = [[0, NEVER, NEVER, NEVER]]
    for m in runs:
        best.append([min(best[-1][a] + m[4 * a + b] for a in range(4)) for b in range(4)])
    q = min(range(4), key=lambda a: (best[-1][a] + after_cost(a), a))
    total, border = best[-1][q] + after_cost(q), [q]
    for k in range(len(runs) - 1, -1, -1):
        q = min(range(4), key=lambda a: (best[k][a] + runs[k][4 * a + q], a))
        border.append(q)
    return border[::-1], total // UNIT


def trace(turns: Sequence[tuple[int, int]], enter: int, leave: int) -> list[tuple[int, int, str]]:
    """(before, after, action) of each turn on the cheapest way between two roles."""
    best, back = [0 if a == enter else NEVER for a in range(4)], []
    for role, s in turns:
        new, how = [NEVER] * 4, [None] * 4
        for a, b, c, action in _steps(role, s):
            if best[a] + c < new[b]:
                new[b], how[b] = best[a] + c, (a, b, action)
        best = new
        back.append(how)
    out, q = [], leave
    for how in reversed(back):
        out.append(how[q])
        q = how[q][0]
    return out[::-1]


def _empty(roles: Sequence[int]) -> str:
    return "".join(OPEN.format(ROLES[r]) + CLOSE for r in roles)


def piece(text: str | None, before: int, after: int, action: str, last: bool) -> str:
    t = (text or "").replace("<|", "< |")         # a text can't forge markup
    if action == "merge":
        out = JOIN + t
    else:
        out = (CLOSE if before != START else "") + _empty(BETWEEN[before, after]) + OPEN.format(ROLES[after]) + t
    return out + CLOSE + _empty(AFTER[after]) if last else out


def _runs(batches: Iterator[pd.DataFrame], by: list[str]) -> Iterator[pd.DataFrame]:
    """Whole runs of equal ``by`` (never null) from sorted batches."""
    carry = None
    for b in batches:
        if carry is not None:
            b = pd.concat([carry, b], ignore_index=True)
        if not len(b):
            continue
        edges = np.flatnonzero((b[by] != b[by].shift()).any(axis=1).to_numpy()).tolist()
        for s, e in zip(edges, edges[1:]):
            yield b.iloc[s:e]
        carry = b.iloc[edges[-1]:]
    if carry is not None and len(carry):
        yield carry


def _turns(run: pd.DataFrame) -> list[tuple[int, int]]:
    return [(int(r), int(s)) for r, s in zip(run["known"], run["salt"])]


def _matrices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows = [(run["conv"].iloc[0], run["part"].iloc[0], [str(x) for x in reduce_run(_turns(run))])
            for run in _runs(batches, ["conv", "part"])]
    yield pd.DataFrame(rows, columns=["conv", "part", "m"])


def _borders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows = []
    for conv in _runs(batches, ["conv"]):
        border, cost = chain([[int(x) for x in m] for m in conv["m"]])
        rows += [(c, p, border[k], border[k + 1], k == len(conv) - 1, cost)
                 for k, (c, p) in enumerate(zip(conv["conv"], conv["part"]))]
    yield pd.DataFrame(rows, columns=["conv", "part", "enter", "leave", "ends", "cost"])


def _repaired(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each run is led by its border row, at place -1."""
    for run in _runs(batches, ["conv", "part"]):
        border, run = run.iloc[0], run.iloc[1:]
        way = trace(_turns(run), int(border["enter"]), int(border["leave"]))
        last = [bool(border["ends"]) and i == len(way) - 1 for i in range(len(way))]
        yield pd.DataFrame({
            "conv": run["conv"], "turn": run["turn"], "place": run["place"], "role": run["role"],
            "new_role": [ROLES[b] for _, b, _ in way], "action": [x for _, _, x in way],
            "n_inserted": [(0 if x == "merge" else len(BETWEEN[a, b])) + (len(AFTER[b]) if z else 0)
                           for (a, b, x), z in zip(way, last)],
            "conv_cost": int(border["cost"]),
            "rendered": [piece(t, a, b, x, z) for t, (a, b, x), z in zip(run["text"], way, last)]})


def format_chat(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text") -> DataFrame:
    """Per row of ``turns``: conv_id, turn, place (rises with the order of the turns),
    role, new_role, action (keep, relabel, merge), n_inserted (empty messages rendered
    here), conv_cost and rendered."""
    # Ids travel as strings through Python, where integers with nulls would become floats.
    c, n = F.col(f"`{conv}`").cast("long"), F.col(f"`{turn}`").cast("long")
    r, x = F.col(f"`{role}`").cast("string"), F.col(f"`{text}`").cast("string")
    rows = turns.select(F.coalesce(c.cast("string"), F.lit("")).alias("conv"), n.alias("at"), n.cast("string").alias("turn"),
                        r.alias("role"), x.alias("text"), known_role(r).alias("known"),
                        F.shiftrightunsigned(F.xxhash64(c, n, r, x), 1).alias("salt"))
    order = [F.col("conv"), F.col("at").asc_nulls_last(), F.col("salt")]
    # The salt ends the key of the ranges, so equal turns of one conversation spread too.
    t = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("at")
               .withColumn("part", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id()), "turns")
    by = ["conv", "part"]
    m = t.select(*by, "place", "known", "salt").repartition(*by).sortWithinPartitions(*by, "place") \
        .mapInPandas(_matrices, "conv string, part int, m array<string>")
    borders = m.repartition("conv").sortWithinPartitions(*by).mapInPandas(
        _borders, "conv string, part int, enter int, leave int, ends boolean, cost long")
    led = t.unionByName(borders.withColumns({"place": F.lit(-1).cast("long"), "known": F.lit(0), "salt": F.lit(0).cast("long")}),
                        allowMissingColumns=True)
    out = led.repartition(*by).sortWithinPartitions(*by, "place").mapInPandas(
        _repaired, "conv string, turn string, place long, role string, new_role string, action string, n_inserted int, "
                   "conv_cost long, rendered string")
    return out.select(F.when(F.col("conv") != "", F.col("conv")).cast("long").alias("conv_id"),
                      F.col("turn").cast("long").alias("turn"), "place", "role", "new_role", "action", "n_inserted",
                      "conv_cost", "rendered")
