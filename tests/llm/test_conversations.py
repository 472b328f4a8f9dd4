import hashlib
import random
import re
import zlib

import pytest

from barloom.llm import conversations, entries

SCHEMA = "conv_id long, turn long, role string, text string, copies int, fault string, _first int"


def damaged(rows):
    out = []
    for conv_id, turn, role, text in rows:
        named = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        fault = zlib.crc32(named.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        row = (conv_id, turn, "user" if fault == 4 else role, text)
        out += [] if fault == 0 else [row, row] if fault == 3 else [row]
    return out


def repaired(rows):
    """Forward search over all edit sequences of one conversation, cheapest first, then ASCII-least."""
    seen, faults = set(), []
    for _, _, role, text in rows:
        words = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else None)
        seen.add((role, text))
    can = lambda made, r: (r == "s" and made == "") or (r == "u" and made[-1:] in ("", "s", "a")) or (r == "a" and made[-1:] == "u")
    best = {"": (0, "", ())}

    def offer(pool, made, option):
        key = made[-1:] if made else ""
        if key not in pool or option < pool[key]:
            pool[key] = option

    def insertions(pool):
        for _ in range(3):
            for made, (cost, audit, out) in list(pool.items()):
                role = "assistant" if made == "u" else "user"
                offer(pool, role[0], (cost + 5, audit + "I", (*out, f"{role}:")))

    for (_, _, role, text), fault in zip(rows, faults):
        insertions(best)
        after = {}
        for made, (cost, audit, out) in best.items():
            offer(after, made, (cost + 2, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault else 0
            if role[:1] and can(made, role[0]):
                offer(after, role[0], (cost + more, audit + "K", (*out, f"{role}:{text}")))
            other = "assistant" if made == "u" else "user"
            offer(after, other[0], (cost + more + 1, audit + "R", (*out, f"{other}:{text}")))
        best = after
    insertions(best)
    cost, audit, out = min(best[k] for k in ("", "a") if k in best)
    numbers = [t for _, t, _, _ in rows if t is not None]
    initials = [r[:1] for _, _, r, _ in rows]
    return (
        max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest(),
    )


def expected(rows, change=damaged):
    order = lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).digest())
    left = change(rows)
    return {c: repaired(sorted((r for r in left if r[0] == c), key=order)) for c in {r[0] for r in rows}}


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "x", 1) for r in rows], SCHEMA)


def found(spark, rows, change=conversations.damage):
    df = frame(spark, rows)
    got = conversations.digests(change(df), df).collect()
    assert len({r.conv_id for r in got}) == len(got)
    return {r.conv_id: tuple(r)[1:] for r in got}


def random_rows(seed, conversations_, most, texts=6):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "u", "Assistant"]
    out = []
    for c in range(conversations_):
        for t in range(rng.randint(1, most)):
            role = roles[t % 2] if rng.random() < 0.6 else rng.choice(roles)
            text = rng.choice(["Yes.", "no", " ", None, "é!\n", "\t"]) if rng.random() < 0.3 else f"text {rng.randrange(texts)}{rng.choice('.!?x')}"
            out.append((None if c == 3 else c, None if rng.random() < 0.05 else rng.randrange(most) if rng.random() < 0.2 else t, role, text))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_random_conversations(spark, seed):
    rows = random_rows(seed, 150, 14)
    assert found(spark, rows) == expected(rows)


@pytest.mark.parametrize("partitions", [3, 13])
def test_long_conversations_are_spread_over_partitions(spark, partitions):
    rows = random_rows(5, 3, 700, texts=400)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        assert found(spark, rows) == expected(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_row_repeated_many_times_and_a_long_text(spark):
    rows = [(1, 1, "user", "again?")] * 900 + [(1, 1, "assistant", "ok " * 400_000 + ".")] + [(2, t, "user", "same.") for t in range(300)]
    assert found(spark, rows) == expected(rows)


def test_without_damage_the_cheapest_edits_in_ascii_order(spark):
    rows = [(1, 0, "user", "a."), (1, 1, "user", "b."), (1, 2, "assistant", "c."), (2, 0, "assistant", "a."), (3, 0, "system", "a."), (4, None, None, None)]
    same = lambda df: df
    got = found(spark, rows, same)
    filled = lambda rs: [(c, t, r or " ", x or " ") for c, t, r, x in rs]
    assert got == expected(rows, filled)
    assert [got[c][6] for c in (1, 2, 3, 4)] == ["DKK", "D", "D", "D"]


def test_turns_are_the_repaired_conversation(spark):
    rows = [(9, 0, "assistant", "x."), (9, 1, "user", "q?"), (9, 2, "tool", "y."), (9, 3, "user", " ")]
    repairs = conversations.repaired(frame(spark, rows))
    turns = conversations.turns(repairs).orderBy("turn", "source_role", "text_key", "step").collect()
    assert [(t.role, t.text, t.edit) for t in turns] == [("user", "q?", "K"), ("assistant", "y.", "R")]


def test_empty_table_and_whole_table(spark):
    assert found(spark, []) == {}
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in entries.op13_turn_repair(spark, folder).collect()}
    assert got == expected(rows)


def test_blocks_recompute_what_whole_vectors_hold():
    rng = random.Random(3)
    for n in (1, 2, 3, 10, 101):
        codes = bytes(rng.randrange(12) for _ in range(n))
        steps = conversations.Steps()
        costs = [conversations.FINISH]
        for code in reversed(codes):
            costs.append(steps.before(code, costs[-1])[1])
        size, kept = conversations._checkpoints(steps, codes, conversations.FINISH)
        assert kept == [*(costs[n - i] for i in range(0, n, size)), conversations.FINISH]
        assert len(kept) <= n**0.5 + 2
