"""Conversation repair against a plain search over all edits, short and cut into chunks."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from haulwright.llm.turns import FINAL, LONGEST, STATES, Repaired, backward, damaged, forward, op13_conversation_repair, relative

SPACE = " \t\n\v\f\r"
STEPS = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def plain_damage(rows):
    """Rows (conv_id, turn, role, text) after damage, and every conv_id."""
    one = lambda v: " " if v is None else str(v)
    out = []
    for conv, turn, role, text in rows:
        role, text = one(role), one(text)
        code = zlib.crc32(f"{one(conv)}:{one(turn)}".encode()) % 20
        if code == 1:
            text = ""
        if code == 2:
            text = "".join(c for c in text if c not in ".!?")
        if code == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return out, {r[0] for r in rows}


def plain_order(row):
    _, turn, role, text = row
    return (turn is not None, turn or 0, role.encode(), hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest())


def plain_repair(rows):
    rows = sorted(rows, key=plain_order)
    seen, faults = set(), []
    for _, _, role, text in rows:
        bare = text.rstrip(SPACE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)

    def insert(best):
        for _ in range(3):
            for state, (cost, audit, out) in list(best.items()):
                for letter, role in (("u", "user"), ("a", "assistant")):
                    after = STEPS.get((state, letter))
                    found = (cost + 5, audit + "I", [*out, f"{role}:"])
                    if after and (after not in best or found[:2] < best[after][:2]):
                        best[after] = found
        return best

    best = insert({"": (0, "", [])})
    for (_, _, role, text), fault in zip(rows, faults, strict=True):
        after = {}

        def offer(state, cost, audit, out, after=after):
            if state and (state not in after or (cost, audit) < after[state][:2]):
                after[state] = (cost, audit, out)
            if state == "" and ("" not in after or (cost, audit) < after[""][:2]):
                after[""] = (cost, audit, out)

        for state, (cost, audit, out) in best.items():
            offer(state, cost + 2, audit + "D", out)
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault == "truncated" else 0
            if (state, role[:1]) in STEPS:
                offer(STEPS[state, role[:1]], cost + more, audit + "K", [*out, f"{role}:{text}"])
            for letter, name in (("u", "user"), ("a", "assistant")):
                if (state, letter) in STEPS:
                    offer(STEPS[state, letter], cost + 1 + more, audit + "R", [*out, f"{name}:{text}"])
        best = insert(after)
    cost, audit, out = min(best[s] for s in ("", "a") if s in best)
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    firsts = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:], strict=False))
    count = lambda f: faults.count(f)
    sha = hashlib.sha256("\n".join(out).encode()).hexdigest()
    return (gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, sha)


def plain(rows, damage=True):
    held = [(c, t, " " if role is None else role, " " if text is None else text) for c, t, role, text in rows]
    after, every = plain_damage(rows) if damage else (held, {r[0] for r in rows})
    return {conv: plain_repair([r for r in after if r[0] == conv]) for conv in every}


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def shown(found):
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in found.collect()}


def odd_rows(seed, conversations=60, longest=14):
    r = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "s", "User"]
    texts = ["Yes.", "No!", "cut off", "", " \t\x0b", "Well.\n ", None, "Ja?", "é", "a.b", "One more thing.", "x" * 3000]
    rows = []
    for conv in range(conversations):
        for turn in range(r.randint(1, longest)):
            at = None if r.random() < 0.1 else turn * r.choice([1, 1, 1, 3])
            rows.append((conv if conv else None, at, r.choice(roles), r.choice(texts) if r.random() < 0.5 else f"Text {turn}{r.choice('.!?,')}"))
    return rows + rows[5:9]


SCHEMA = "conv_id long, turn long, role string, text string"


def test_whole_table_agrees_with_the_plain_search(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = op13_conversation_repair(spark, folder)
    assert found.count() == len({r[0] for r in rows})
    assert shown(found) == plain(rows)


@pytest.mark.parametrize("longest", [1, 3, LONGEST])
def test_odd_conversations(spark, longest):
    rows = odd_rows(longest)
    table = spark.createDataFrame(rows, SCHEMA).withColumns({"n": F.lit(1), "cost": F.lit("x"), "_key": F.lit(0), "blank": F.lit(2)}).repartition(3)
    found = Repaired(damaged(table), present=F.col("present"), longest=longest).conversations()
    assert shown(found) == plain(rows)


def test_one_conversation_holds_most_rows(spark):
    r = random.Random(5)
    rows = odd_rows(9, 20, 6)
    for turn in range(1500):
        again = r.random() < 0.4
        rows.append((7, turn, r.choice(["user", "assistant", "system"]), "Same again." if again else f"Turn {turn}{r.choice('....,')}"))
    found = Repaired(spark.createDataFrame(rows, SCHEMA), longest=40)
    want = plain(rows, damage=False)
    assert shown(found.conversations()) == want
    turns = found.turns().where("conv_id = 7").orderBy("place").collect()
    assert hashlib.sha256("\n".join(f"{t.role}:{t.text}" for t in turns).encode()).hexdigest() == want[7][-1]
    assert {t.edit for t in turns} <= set("KRI") and sum(t.edit == "I" for t in turns) == want[7][6].count("I")


def test_costs_behind_a_chunk_matter_up_to_a_constant():
    r = random.Random(3)
    for _ in range(300):
        n = r.randint(0, 8)
        initials, broken = bytes(r.randint(0, 3) for _ in range(n)), bytes(r.randint(0, 1) for _ in range(n))
        out = [r.randint(0, 12) for _ in range(STATES)]
        low, high = backward(initials, broken, out), backward(initials, broken, [c + 9 for c in out])
        assert [h - v for h, v in zip(high, low, strict=True)] == [9] * len(low)
        assert relative(low[:STATES]) == relative(high[:STATES])
        whole = backward(initials, broken, list(FINAL))
        cut = r.randint(0, n)
        right = backward(initials[cut:], broken[cut:], list(FINAL))
        left = backward(initials[:cut], broken[:cut], relative(right[:STATES]))
        assert relative(left[:STATES]) == relative(whole[:STATES])
        steps, state = forward(initials[:cut], broken[:cut], relative(right[:STATES]), left, 0)
        more, _ = forward(initials[cut:], broken[cut:], list(FINAL), right, state)
        every, _ = forward(initials, broken, list(FINAL), whole, 0)
        assert "".join(t for t, _ in steps + more) == "".join(t for t, _ in every)


def test_empty_table_and_conversations_that_lose_all_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert Repaired(none).conversations().count() == 0 and Repaired(none).turns().count() == 0
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "Hello.")]
    found = Repaired(damaged(spark.createDataFrame(rows, SCHEMA)), present=F.col("present")).conversations()
    assert shown(found) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
