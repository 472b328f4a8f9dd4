"""Repair of role order in conversations by the cheapest edits.

Turns of a conversation must give role initials ``(s?(ua)+)?``. Keep, Rerole, Delete and Insert have costs; of all
cheapest edit sequences the one whose initials come first in ASCII order is taken. States are what the repaired turns
end in: nothing yet, a system turn, a user turn, an assistant turn. The cost to finish from each state is computed
backward, vectors are stored at every square-root-of-n-th row only, and the blocks between them are computed again
while the edits are read off walking forward.

Rows are sorted by (conversation, turn) over range partitions, so a conversation of any length is spread over tasks. A
task that holds a part of one reports the least costs between the states at both ends; the driver combines these 4 x 4
tables, two a partition, and each part is then walked by itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.sources.staging import stage

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: State after a kept or inserted turn of that role, None where the order forbids it.
AFTER = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None)}
#: State after the only turn that may be rewritten or inserted.
NEXT = (USER, USER, ASSISTANT, USER)
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
FAR = 1 << 60
END = (0, FAR, FAR, 0)
NAMES = {USER: "user", ASSISTANT: "assistant"}
SALTS = 256

#: Names of the codes' first part, the role's initial, and of their second part.
INITIALS = "sua"
OK, CUT, DROP = range(3)
LEGAL = {(0, 1), (1, 2), (2, 1)}

Vector = tuple[int, int, int, int]
ORDER = ["conv_id", "turn", "role", "text_key"]


def damage(rows: DataFrame) -> DataFrame:
    """The conversations with known faults: crc32 of ``conv_id:turn`` modulo 20 picks the fault of a row.

    0 drops it, 1 empties the text, 2 removes its full stops, exclamation and question marks, 3 repeats it, 4 makes its
    role user. A NULL in a text, in a role or in the hashed string counts as one space; conv_id and turn stay NULL.
    """
    known = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    fault = F.crc32(F.concat(known["conv_id"], F.lit(":"), known["turn"]).cast("binary")) % 20
    faulty = rows.select("conv_id", "turn", known["role"].alias("role"), known["text"].alias("text"), fault.alias("fault")).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    twice = F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1)))
    return faulty.select("conv_id", "turn", role.alias("role"), text.alias("text"), twice.alias("_")).drop("_")


def edits(rows: DataFrame) -> DataFrame:
    """One row per different (conv_id, turn, role, text) with the edits that repair its conversation.

    Columns conv_id, turn, role, text_key (md5), copies, fault (blank, duplicate, truncated or NULL), edits (initials of
    the insertions before the row and of its own edit), roles (of the turns these edits leave, NULL for a deletion),
    after (insertions after the conversation's last row), cost, illegal (adjacent roles, this row's and its copies' with
    the one before, that the order forbids), starts (whether a turn number begins here). Copies but the first are deleted.

    A conversation's order is turn, NULL first, then role, then the text's hash. NULL roles and texts count as one space,
    rows of NULL conv_id are one conversation. Equal rows are adjacent; the first keeps its fault, the others are
    duplicates. A role counts by its first character; an empty role cannot be kept. Texts are only hashed here, so their
    length does not matter; an empty table gives no row; other columns are ignored.
    """
    spread = _faults(rows).repartitionByRange(*ORDER)
    sorted_rows = stage(spread.sortWithinPartitions(*ORDER))
    ends = sorted_rows.mapInArrow(_ends, "part int, place int, conv_id long, initial int, turn long, costs array<array<long>>").collect()
    plan = _chains(ends)
    if plan:
        found = sorted_rows.mapInArrow(partial(_exits, {k: p["finish"] for k, p in plan.items()}), "part int, place int, exits array<int>")
        exits = {(r["part"], r["place"]): r["exits"] for r in found.collect()}
        for key, own in plan.items():
            if own["before"] is not None:
                own["enter"] = exits[own["before"]][plan[own["before"]]["enter"]]
    schema = (
        "conv_id long, turn long, role string, text_key binary, copies long, fault string, edits string, "
        "roles array<string>, after string, cost long, illegal long, starts boolean"
    )
    return sorted_rows.mapInArrow(partial(_edits, plan), schema)


def repaired(rows: DataFrame) -> DataFrame:
    """The result of ``edits`` with the text of every row."""
    texts = _keyed(rows).groupBy(*ORDER).agg(F.first("text").alias("text"))
    found = edits(rows)
    same = [found[c].eqNullSafe(texts[c]) for c in ORDER]
    on = same[0] & same[1] & same[2] & same[3]
    return found.join(texts, on, "left").select(*(found[c] for c in found.columns), texts["text"])


def turns(repairs: DataFrame) -> DataFrame:
    """The repaired conversations themselves, from ``repaired``: conv_id, turn, role, text, edit and text_key, step.

    Turns follow each other by (conv_id, turn, NULL first, the row's own role ``source_role``, text_key, step); an
    inserted turn has an empty text and the turn number of the row it stands at.
    """
    whole = repairs.select("conv_id", "turn", F.col("role").alias("source_role"), "text_key", "text", F.concat("edits", "after").alias("edits"), "roles")
    step = F.posexplode("roles").alias("step", "role")
    each = whole.select("*", step).where(F.col("role").isNotNull())
    edit = F.expr("substr(edits, step + 1, 1)")
    text = F.when(edit == "I", "").otherwise(F.col("text"))
    return each.select("conv_id", "turn", "role", text.alias("text"), edit.alias("edit"), "source_role", "text_key", "step")


def digests(rows: DataFrame, original: DataFrame) -> DataFrame:
    """One row per conv_id of ``original``: counts, cost, the edits' initials and the sha256 of the repaired turns.

    The hash runs over a whole conversation in order, so the rows of one are streamed through one task, a batch at a
    time; all else is spread.
    """
    sums = ["blank", "duplicate", "truncated", "illegal", "cost"]
    schema = "conv_id long, gaps long, " + ", ".join(f"{c} long" for c in sums) + ", audit string, repaired_sha256 string"
    found = repaired(rows).repartition("conv_id").sortWithinPartitions(*ORDER).mapInArrow(_digests, schema)
    ids = original.groupBy("conv_id").agg(F.lit(0).alias("_"))
    zero = {c: F.coalesce(found[c], F.lit(0)).alias(c) for c in ("gaps", *sums)}
    return ids.join(found, ids["conv_id"].eqNullSafe(found["conv_id"]), "left").select(
        ids["conv_id"], *zero.values(), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


def _keyed(rows: DataFrame) -> DataFrame:
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text")).withColumn("text_key", F.unhex(F.md5("text")))


def _faults(rows: DataFrame) -> DataFrame:
    """Different rows with their number of copies and their fault; no text is shuffled.

    A text that a role repeats all over a conversation is ranked by salts first, then among the salts' firsts.
    """
    end = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    kind = F.when(end == "", "blank").when(~F.right(end, F.lit(1)).isin(".", "!", "?"), "truncated")
    different = _keyed(rows).select(*ORDER, kind.alias("kind")).groupBy(*ORDER).agg(F.count("*").alias("copies"), F.first("kind").alias("kind"))
    same = ["conv_id", "role", "text_key"]
    salt = F.pmod(F.xxhash64("turn"), F.lit(SALTS))
    by_turn = F.col("turn").asc_nulls_first()
    ranked = different.withColumn("_salt", salt).withColumn("_rank", F.row_number().over(Window.partitionBy(*same, "_salt").orderBy(by_turn)))
    group = F.when(F.col("_rank") == 1, -1).otherwise(F.col("_salt"))
    ranked = ranked.withColumn("_group", group).withColumn("_first", F.row_number().over(Window.partitionBy(*same, "_group").orderBy(by_turn)))
    first = (F.col("_group") == -1) & (F.col("_first") == 1)
    fault = F.when(F.col("kind") == "blank", "blank").when(~first, "duplicate").otherwise(F.col("kind"))
    initial = F.instr(F.lit(INITIALS), F.substring("role", 1, 1)) - 1
    initial = F.when((F.col("role") == "") | (initial < 0), len(INITIALS)).otherwise(initial)
    treatment = F.when(F.col("fault") == "truncated", CUT).when(F.col("fault").isNotNull(), DROP).otherwise(OK)
    return ranked.withColumn("fault", fault).select(*ORDER, "copies", "fault", (initial * 3 + treatment).cast("tinyint").alias("code"))


def _chains(ends: list) -> dict[tuple[int, int], dict]:
    """The parts of conversations that several partitions share: costs from their end on, and what stands before them."""
    ends = sorted(ends, key=lambda r: (r["part"], r["place"]))
    plan: dict[tuple[int, int], dict] = {}
    chain: list = []

    def close() -> None:
        finish, last = FINISH, len(chain) - 1
        for k in range(last, -1, -1):
            row, before = chain[k], chain[k - 1] if k else None
            plan[row["part"], row["place"]] = {
                "finish": finish, "last": k == last, "enter": NOTHING,
                "before": (before["part"], before["place"]) if before else None,
                "initial": before["initial"] if before else None, "turn": before["turn"] if before else None,
            }
            finish = _relative(tuple(min(c + f for c, f in zip(costs, finish)) for costs in row["costs"]))

    for i, row in enumerate(ends):
        joins = chain and chain[-1]["part"] != row["part"] and chain[-1]["conv_id"] == row["conv_id"]
        if not joins:
            if len(chain) > 1:
                close()
            chain = []
        chain.append(row)
    if len(chain) > 1:
        close()
    return dict(sorted(plan.items()))


def _relative(costs: Vector) -> Vector:
    least = min(costs)
    return tuple(c - least if c < FAR else FAR for c in costs)


def _with_insertions(costs: list[int]) -> Vector:
    user = min(costs[USER], INSERT + costs[ASSISTANT])
    return (
        min(costs[NOTHING], INSERT + user), min(costs[SYSTEM], INSERT + user), user,
        min(costs[ASSISTANT], INSERT + costs[USER]),
    )


FINISH = _with_insertions(list(END))


class Steps:
    """Both directions of the table of costs for one row, remembered by the row's code and the costs behind it."""

    def __init__(self):
        self.back: dict[tuple[int, Vector], tuple[int, Vector]] = {}
        self.ahead: dict[tuple[int, Vector, int], tuple[str, tuple, int, int]] = {}

    def before(self, code: int, behind: Vector) -> tuple[int, Vector]:
        """Costs before a row from those behind it, as the least and the differences from it."""
        found = self.back.get((code, behind))
        if found is None:
            costs = [self._least(code, behind, q)[0] for q in range(4)]
            whole = _with_insertions(costs)
            found = self.back[code, behind] = (min(whole), _relative(whole))
        return found

    def edit(self, code: int, behind: Vector, state: int) -> tuple[str, tuple, int, int]:
        """The ASCII-least tight edits from a state over one row: initials, roles left, next state, their cost."""
        key = code, behind, state
        if key not in self.ahead:
            least, costs = self.before(code, behind)
            names, roles, paid = "", [], 0
            while True:
                total = least + costs[state]
                own = self._least(code, behind, state)
                if own[0] == total and own[1] == "D":
                    names, roles, paid = names + "D", [*roles, None], paid + DELETE
                    break
                if INSERT + least + costs[NEXT[state]] == total:
                    state = NEXT[state]
                    names, roles, paid = names + "I", [*roles, NAMES[state]], paid + INSERT
                    continue
                names, paid = names + own[1], paid + own[2]
                roles.append("" if own[1] == "K" else NAMES[own[3]])
                state = own[3]
                break
            self.ahead[key] = (names, tuple(roles), state, paid)
        return self.ahead[key]

    @staticmethod
    def _least(code: int, behind: Vector, state: int) -> tuple[int, str, int, int]:
        """Cost in all, initial, own cost and next state of the best edit of the row itself; D before K before R."""
        initial, treatment = divmod(code, 3)
        options = [(DELETE + behind[state], "D", DELETE, state)]
        if treatment != DROP:
            extra = TRUNCATED if treatment == CUT else 0
            kept = AFTER[INITIALS[initial]][state] if initial < len(INITIALS) else None
            if kept is not None:
                options.append((extra + behind[kept], "K", extra, kept))
            options.append((REROLE + extra + behind[NEXT[state]], "R", REROLE + extra, NEXT[state]))
        return min(options)


def _checkpoints(steps: Steps, codes: bytes, finish: Vector) -> tuple[int, list[Vector]]:
    """Vectors before every ``size``-th row and behind the last one; size is about the root of the number of rows."""
    size = isqrt(len(codes)) + 1
    kept, costs = [finish], finish
    for i in range(len(codes) - 1, -1, -1):
        costs = steps.before(codes[i], costs)[1]
        if i % size == 0:
            kept.append(costs)
    return size, kept[::-1]


def _walk(steps: Steps, codes: bytes, finish: Vector, state: int) -> Iterator[tuple[str, tuple, int, int]]:
    size, kept = _checkpoints(steps, codes, finish)
    for block, end in enumerate(kept[1:]):
        part = codes[block * size : (block + 1) * size]
        behind = [end]
        for code in reversed(part[1:]):
            behind.append(steps.before(code, behind[-1])[1])
        for code in part:
            found = steps.edit(code, behind.pop(), state)
            state = found[2]
            yield found


def _segments(batches) -> tuple[pa.Table | None, list[tuple[int, int]]]:
    """The rows of a partition and where each conversation's part begins and ends."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return None, []
    table = pa.Table.from_batches(held).combine_chunks()
    runs = pc.run_end_encode(table.column("conv_id").chunk(0)).run_ends.to_pylist()
    return table, list(zip([0, *runs], runs))


def _codes(table: pa.Table) -> bytes:
    return table.column("code").to_numpy().astype("i1").tobytes()


def _edges(segments: list) -> list[tuple[int, tuple[int, int]]]:
    return [(0, segments[0])] + [(1, segments[-1])] * (len(segments) > 1) if segments else []


def _ends(batches) -> Iterator[pa.RecordBatch]:
    table, segments = _segments(batches)
    steps, rows = Steps(), []
    for place, (a, b) in _edges(segments):
        codes = _codes(table)[a:b]
        columns = [_through(steps, codes, tuple(0 if q == j else FAR for q in range(4))) for j in range(4)]
        last = table.slice(b - 1, 1)
        rows.append((
            TaskContext.get().partitionId(), place, last.column("conv_id")[0].as_py(), codes[-1] // 3,
            last.column("turn")[0].as_py(), [list(c) for c in zip(*columns)],
        ))
    if rows:
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.list_(pa.int64()))]
        names = ["part", "place", "conv_id", "initial", "turn", "costs"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _through(steps: Steps, codes: bytes, behind: Vector) -> Vector:
    total = 0
    for code in reversed(codes):
        least, behind = steps.before(code, behind)
        total += least
    return tuple(min(FAR, total + c) for c in behind)


def _exits(finishes: dict[tuple[int, int], Vector], batches) -> Iterator[pa.RecordBatch]:
    table, segments = _segments(batches)
    part, steps = TaskContext.get().partitionId(), Steps()
    for place, (a, b) in _edges(segments):
        if (part, place) in finishes:
            found = []
            for state in range(4):
                for _, _, state, _ in _walk(steps, _codes(table)[a:b], finishes[part, place], state):
                    pass
                found.append(state)
            columns = [pa.array([part], pa.int32()), pa.array([place], pa.int32()), pa.array([found], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "place", "exits"])


def _edits(plan: dict[tuple[int, int], dict], batches) -> Iterator[pa.RecordBatch]:
    table, segments = _segments(batches)
    if table is None:
        return
    part, steps, codes = TaskContext.get().partitionId(), Steps(), _codes(table)
    shared = {at: plan.get((part, place)) for place, at in _edges(segments)}
    names, roles, after, costs = [], [], [""] * len(codes), []
    initials = np.frombuffer(codes, np.int8) // 3
    copies = table.column("copies").to_numpy()
    turn = table.column("turn").chunk(0)
    numbers, known = turn.fill_null(0).to_numpy(), turn.is_valid().to_numpy(zero_copy_only=False)
    legal = np.zeros(len(codes), bool)
    legal[1:] = np.isin(initials[:-1] * 4 + initials[1:], [a * 4 + b for a, b in LEGAL])
    starts = known.copy()
    starts[1:] &= (numbers[1:] != numbers[:-1]) | ~known[:-1]
    illegal = copies - legal
    for a, b in segments:
        own = shared.get((a, b)) or {"finish": FINISH, "enter": NOTHING, "last": True, "before": None}
        state = own["enter"]
        for edit, left, state, cost in _walk(steps, codes[a:b], own["finish"], state):
            names.append(edit)
            roles.append(left)
            costs.append(cost)
        if own["last"]:
            for _ in range({NOTHING: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}[state]):
                state = NEXT[state]
                after[b - 1] += "I"
                roles[-1] += (NAMES[state],)
                costs[-1] += INSERT
        if own["before"] is None:
            illegal[a], starts[a] = copies[a] - 1, known[a]
        else:
            illegal[a] = copies[a] - ((own["initial"], initials[a]) in LEGAL)
            starts[a] = known[a] and own["turn"] != numbers[a]
    kept = pa.array(["" if n is None else n for n in table.column("role").to_pylist()])
    roles = [tuple(k if r == "" else r for r in left) for left, k in zip(roles, kept.to_pylist())]
    made = {
        "edits": pa.array(names), "roles": pa.array(roles, pa.list_(pa.string())), "after": pa.array(after),
        "cost": pa.array(np.array(costs, np.int64) + DELETE * (copies - 1)), "illegal": pa.array(illegal.astype(np.int64)),
        "starts": pa.array(starts),
    }
    columns = [*ORDER, "copies", "fault"]
    out = pa.table({c: table.column(c) for c in columns} | made)
    yield from out.to_batches(max_chunksize=10_000)


def _digests(batches) -> Iterator[pa.RecordBatch]:
    """Streams conversations: only the counts, the hash and the initials of the current one are held."""
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    kinds = [pa.int64()] * 7 + [pa.string()] * 2
    current: _Digest | None = None
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if current is None or current.conv_id != row["conv_id"]:
                if current:
                    done.append(current.row())
                current = _Digest(row["conv_id"])
            current.add(row)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)
    if current:
        yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(current.row(), kinds)], names=names)


class _Digest:
    def __init__(self, conv_id: int | None):
        self.conv_id, self.faults, self.illegal, self.cost = conv_id, dict.fromkeys(("blank", "duplicate", "truncated"), 0), 0, 0
        self.low = self.high = None
        self.numbers, self.audit, self.hash, self.empty = 0, [], hashlib.sha256(), True

    def add(self, row: dict) -> None:
        if row["turn"] is not None:
            self.low, self.high = row["turn"] if self.low is None else self.low, row["turn"]
        self.numbers += row["starts"]
        fault, again = row["fault"], row["copies"] - 1
        if fault:
            self.faults[fault] += 1
        self.faults["blank" if fault == "blank" else "duplicate"] += again
        self.illegal += row["illegal"]
        self.cost += row["cost"]
        edits = row["edits"] + row["after"]
        self.audit.append(row["edits"] + "D" * again + row["after"])
        for edit, role in zip(edits, row["roles"]):
            if role is not None:
                line = f"{role}:{'' if edit == 'I' else row['text']}"
                self.hash.update((line if self.empty else "\n" + line).encode())
                self.empty = False

    def row(self) -> tuple:
        gaps = self.high - self.low + 1 - self.numbers if self.low is not None else 0
        return (self.conv_id, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())
