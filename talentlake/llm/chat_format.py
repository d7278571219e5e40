"""Chat formatting with a minimum-cost repair of roles.

Legal sequences of turns are the words of an automaton: an optional system turn, then
user and assistant in turn, from a user turn to an assistant turn. Each turn of a
conversation may keep its role, take another (relabel), or go into the turn before
(merge); turns without text may be put in before it (insert). A dynamic program over
the automaton's states takes the cheapest way, and the repaired sequence is rendered.

The program's step for a turn is a small matrix of costs from state to state, and steps
compose: the cost from state to state over many turns is the (min, +) product of their
matrices. A conversation is cut into chunks of turns; each chunk gives its matrix, the
matrices of a conversation give the states at the chunks' ends, and each chunk then
takes its own way between them. No task needs a whole conversation's turns or texts, and
the result has a row for each turn, not one text for a conversation.

Order of equal costs: keep, merge, relabel, insert, and the lower state first.

Defined results: a null or blank text is an empty turn, which may be merged at no cost; a
role is trimmed and lower-cased, known other names (``human``, ``bot``, ...) are taken as
their role, and a null or unknown role takes any role at the cost of relabelling; turns
are ordered by turn (null last), then role, then text; rows that repeat conversation,
turn, role and text are one turn, counted in ``n_rows``; rows with a null conversation
form one conversation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from talentlake.llm.common import prepare, written

# States: what the last turn was.
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
FINAL = ASSISTANT
NAMES = {"human": "user", "prompter": "user", "customer": "user", "bot": "assistant", "gpt": "assistant", "model": "assistant", "ai": "assistant", "developer": "system"}
# Costs: fixed values of the repair.
KEEP, MERGE, MERGE_OTHER, RELABEL, INSERT, NEVER = 0.0, 1.0, 4.0, 3.0, 5.0, 1e18
OPEN, CLOSE, JOIN = "<|im_start|>", "<|im_end|>\n", "\n"


def ways() -> tuple[np.ndarray, dict[tuple[int, int], tuple[int, ...]]]:
    """Least number of turns put in between two states, and which."""
    cost, path = np.full((4, 4), NEVER), {}
    for a in range(4):
        cost[a, a], path[a, a] = 0, ()
        edge = [(a, ())]
        while edge:
            edge2 = []
            for s, p in edge:
                for t in NEXT[s]:
                    if cost[a, t] == NEVER:
                        cost[a, t], path[a, t] = len(p) + 1, (*p, t)
                        edge2.append((t, (*p, t)))
            edge = edge2
    return cost, path


WAY, PATH = ways()


def moves(role: int, empty: bool) -> list[tuple[float, int, int, int, str]]:
    """(cost, from, to, state before the turn's own, action): what may be done with a turn."""
    out = []
    for a in range(4):
        if a != START:
            if empty:
                out.append((KEEP, a, a, a, "merge"))
            else:
                out.append((MERGE if role in (a, 0) else MERGE_OTHER, a, a, a, "merge"))
        for s in range(4):
            for t in NEXT[s]:
                if WAY[a, s] < NEVER:
                    own = KEEP if role == t else RELABEL
                    out.append((own + INSERT * WAY[a, s], a, t, s, "keep" if role == t else "relabel"))
    rank = {"keep": 0, "merge": 1, "relabel": 2}
    return sorted(out, key=lambda m: (m[0], WAY[m[1], m[3]], rank[m[4]], m[2], m[3]))


MOVES = {(r, e): moves(r, e) for r in range(4) for e in (False, True)}


def matrix(role: int, empty: bool) -> np.ndarray:
    m = np.full((4, 4), NEVER)
    for cost, a, t, _, _ in MOVES[role, empty]:
        m[a, t] = min(m[a, t], cost)
    return m


MATRICES = np.array([[matrix(r, e) for e in (False, True)] for r in range(4)])


def product(roles: list[int], empty: list[bool]) -> np.ndarray:
    """(min, +) product of the turns' matrices."""
    total = np.where(np.eye(4, dtype=bool), 0.0, NEVER)
    for r, e in zip(roles, empty):
        total = (total[:, :, None] + MATRICES[r, int(e)][None]).min(axis=1)
    return total


def ends(matrices: list[np.ndarray]) -> list[int]:
    """The state at each chunk's begin, and the last one's end, of the cheapest way."""
    cost = [np.where(np.arange(4) == START, 0.0, NEVER)]
    for m in matrices:
        cost.append((cost[-1][:, None] + m).min(axis=0))
    close = cost[-1] + INSERT * WAY[:, FINAL]
    state = int(close.argmin())
    out = [state]
    for c, m in zip(cost[-2::-1], matrices[::-1]):
        state = int((c + m[:, state]).argmin())
        out.append(state)
    return out[::-1]


def repaired(roles: list[int], empty: list[bool], begin: int, end: int) -> list[tuple[str, int, tuple[int, ...]]]:
    """(action, role, states put in before) of each turn, from state to state."""
    cost = np.where(np.arange(4) == begin, 0.0, NEVER)
    back: list[list] = []
    for r, e in zip(roles, empty):
        after, best = [NEVER] * 4, [None] * 4
        for m in MOVES[r, e]:
            if cost[m[1]] + m[0] < after[m[2]]:
                after[m[2]], best[m[2]] = cost[m[1]] + m[0], m
        cost = after
        back.append(best)
    out, state = [], end
    for best in back[::-1]:
        _, a, t, s, action = best[state]
        out.append((action, t, PATH[a, s] if action != "merge" else ()))
        state = a
    return out[::-1]


def turns(conversations: DataFrame, chunk: int) -> DataFrame:
    """(conv, part, ord, role, r, empty, body, n_rows): distinct turns, dealt to chunks by
    turn number; those of one number stay together, in order."""
    role = F.lower(F.trim(F.coalesce(F.col("role").cast("string"), F.lit(""))))
    known = F.create_map(*[F.lit(x) for kv in NAMES.items() for x in kv])
    role = F.coalesce(F.element_at(known, role), role)
    code = sum((F.when(role == F.lit(n), F.lit(k)).otherwise(F.lit(0)) for k, n in enumerate(ROLES) if n), F.lit(0))
    body = F.trim(F.coalesce(F.col("text"), F.lit("")), F.lit(" \t\r\n"))
    x = conversations.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), code.cast("int").alias("r"), body.alias("body"))
    x = x.groupBy("conv", "turn", "role", "r", "body").agg(F.count(F.lit(1)).alias("n_rows"))
    return x.withColumn("part", F.coalesce(F.floor(F.col("turn") / F.lit(chunk)), F.lit((1 << 62)))).withColumn("empty", F.col("body") == "")


def format_chats(conversations: DataFrame, chunk: int = 256) -> DataFrame:
    """A row for each distinct turn, in order ``seq`` within its conversation: conv_id, turn,
    n_rows, role, action (keep, merge, relabel), role_out, n_inserted, cost, and rendered:
    the turn's piece of the rendered conversation, with the turns put in before it and,
    after the last turn, those that close it. The pieces in order are the conversation."""
    prepare(conversations.sparkSession)
    parts = turns(conversations, chunk)
    order = F.struct(F.col("turn").isNull().alias("last"), "turn", "role", "body")
    place = F.row_number().over(W.partitionBy("conv", "part").orderBy(order)) - 1
    # turns without a number, or very many of one number, are a part of any size: cut by their place
    parts = parts.withColumn("ord", place.cast("long"))
    parts = written(parts.withColumn("sub", F.floor(F.col("ord") / F.lit(4 * chunk))).withColumn("ord", (F.col("ord") % F.lit(4 * chunk)).cast("int")))
    turn_struct = F.struct("ord", "r", "empty")
    lists = parts.groupBy("conv", "part", "sub").agg(F.sort_array(F.collect_list(turn_struct)).alias("turns"))
    lists = lists.select("conv", "part", "sub", F.col("turns.r").alias("roles"), F.col("turns.empty").alias("empty"))

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            roles, empty = b.column("roles").to_pylist(), b.column("empty").to_pylist()
            flat = [product(r, e).ravel().tolist() for r, e in zip(roles, empty)]
            n = pa.array([len(r) for r in roles], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("conv"), b.column("part"), b.column("sub"), n, pa.array(flat, pa.list_(pa.float64()))], ["conv", "part", "sub", "n", "costs"])

    costs = lists.mapInArrow(matrices, "conv long, part long, sub long, n long, costs array<double>")
    chunks = costs.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("part", "sub", "n", "costs"))).alias("chunks"))

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for conv, each in zip(b.column("conv").to_pylist(), b.column("chunks").to_pylist()):
                states = ends([np.array(c["costs"]).reshape(4, 4) for c in each])
                first = 0
                for k, c in enumerate(each):
                    out.append((conv, c["part"], c["sub"], states[k], states[k + 1], first, k + 1 == len(each)))
                    first += c["n"]
            kinds = [("conv", pa.int64()), ("part", pa.int64()), ("sub", pa.int64()), ("begin", pa.int32()), ("end", pa.int32()), ("first", pa.int64()), ("final", pa.bool_())]
            cols = list(zip(*out)) or [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, (_, k) in zip(cols, kinds)], [n for n, _ in kinds])

    states = chunks.mapInArrow(chain, "conv long, part long, sub long, begin int, end int, first long, final boolean")
    both = lists.join(states, lists["conv"].eqNullSafe(states["conv"]) & (lists["part"] == states["part"]) & (lists["sub"] == states["sub"])).select(lists["conv"], lists["part"], lists["sub"], "roles", "empty", "begin", "end", "first", "final")

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for x in b.to_pylist():
                each = repaired(x["roles"], x["empty"], x["begin"], x["end"])
                for k, (action, t, before) in enumerate(each):
                    closing = PATH[x["end"], FINAL] if x["final"] and k + 1 == len(each) else ()
                    own = {"keep": KEEP, "relabel": RELABEL, "merge": KEEP if x["empty"][k] else MERGE if x["roles"][k] in (t, 0) else MERGE_OTHER}[action]
                    cost = own + INSERT * (len(before) + len(closing))
                    last = k + 1 == len(each) or each[k + 1][0] != "merge"
                    out.append((x["conv"], x["part"], x["sub"], k, x["first"] + k, action, ROLES[t], len(before) + len(closing), cost, "".join(f"{OPEN}{ROLES[s]}\n{CLOSE}" for s in before), "".join(f"{OPEN}{ROLES[s]}\n{CLOSE}" for s in closing), last, x["final"] and k + 1 == len(each)))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.float64(), pa.string(), pa.string(), pa.bool_(), pa.bool_()]
            cols = list(zip(*out)) or [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], ["dconv", "dpart", "dsub", "dord", "seq", "action", "role_out", "n_inserted", "cost", "before", "after", "last_here", "final"])

    done = both.mapInArrow(decide, "dconv long, dpart long, dsub long, dord int, seq long, action string, role_out string, n_inserted long, cost double, before string, after string, last_here boolean, final boolean")
    x = parts.join(done, parts["conv"].eqNullSafe(done["dconv"]) & (parts["part"] == done["dpart"]) & (parts["sub"] == done["dsub"]) & (parts["ord"] == done["dord"]))
    # the turn's piece opens its message unless it is merged; the next turn's piece closes it unless merged too
    opened = F.when(F.col("action") == "merge", F.lit("")).otherwise(F.concat(F.lit(OPEN), "role_out", F.lit("\n")))
    shut = F.when((F.col("action") == "merge"), F.lit("")).when(F.col("seq") > 0, F.lit(CLOSE)).otherwise(F.lit(""))
    joined = F.when((F.col("action") == "merge") & ~F.col("empty"), F.lit(JOIN)).otherwise(F.lit(""))
    rendered = F.concat(shut, "before", opened, joined, "body", F.when(F.col("final"), F.lit(CLOSE)).otherwise(F.lit("")), "after")
    return x.select(F.col("conv").alias("conv_id"), "turn", "seq", "n_rows", "role", "action", "role_out", "n_inserted", "cost", rendered.alias("rendered"))
