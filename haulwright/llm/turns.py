"""Repair of conversations by rank-convergence parallel Viterbi.

The turns of a conversation, in order, are kept (cost 0), given the role user or assistant (1)
or deleted (2, a must for blank and repeated ones), and empty turns are inserted (5), so that
roles read `(s?(ua)+)?`. A turn that stays although its text breaks off costs 5 more. The
cheapest edits are found backward over four grammar states; among equally cheap ones the
least audit (initials of the edits, ASCII order) is traced forward.

A conversation of up to `longest` turns is one chunk. A longer one is cut into chunks by
Spark's range partitioning: each chunk runs backward from a guessed vector of costs, and
again from what the chunk behind it has found, until no vector changes other than by a
constant. Forward, each chunk tells where it leads from each state, these steps are put
together, and the chunks are traced from their true states.

Turns are ordered by turn (nulls first), role, then the hash of their text. Null roles and
texts are one space; a text with nothing but ASCII white space is blank. Rows with a null key are one conversation.
Repeated rows are repeated turns. Roles beginning with s, u and a may be kept as such. An
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulwright.llm.common import Filter, mapped, partitions, stored, table

KEEP, REROLE, DELETE, INSERT = 0, 1, 2, 5
BROKEN_OFF = 5
FAR = 1 << 60
# Grammar states: 0 nothing yet, 1 after system, 2 after user, 3 after assistant; 0 and 3 may end.
STATES = 4
FINAL = (0, FAR, FAR, 0)
#: What an inserted or re-roled turn of the only fitting role leads to, and that role.
NEXT = (2, 2, 3, 2)
ROLES = ("user", "user", "assistant", "user")
_SYSTEM, _USER, _ASSISTANT = 0, 1, 2
#: Where a kept turn leads, by its role's initial and the state; -1: it can't be kept.
KEPT = ((1, -1, -1, -1), (2, 2, -1, 2), (-1, -1, 3, -1), (-1, -1, -1, -1))
#: Turns and bytes of a conversation that one task takes at once.
LONGEST, MOST_BYTES = 2_048, 32 << 20


def with_inserts(costs: list[int]) -> list[int]:
    """Costs to go where turns may be inserted first; three in a row never pay."""
    for _ in range(2):
        costs = [min(c, INSERT + costs[NEXT[q]]) for q, c in enumerate(costs)]
    return costs


def before_turn(after: list[int], initial: int, broken: int) -> list[int]:
    """Costs to go in front of a turn that may stay, inserting aside."""
    more, own = BROKEN_OFF * broken, []
    for q in range(STATES):
        best = min(DELETE + after[q], REROLE + more + after[NEXT[q]])
        kept = KEPT[initial][q]
        own.append(best if kept < 0 else min(best, more + after[kept]))
    return own


def backward(initials: bytes, broken: bytes, out: list[int]) -> array:
    """Costs to go in front of each turn and behind the last, four in a row; `out` holds those behind the chunk."""
    costs = array("q", bytes(8 * STATES * (len(initials) + 1)))
    now = with_inserts(list(out))
    costs[-STATES:] = array("q", now)
    for i in range(len(initials) - 1, -1, -1):
        now = with_inserts(before_turn(now, initials[i], broken[i]))
        costs[STATES * i : STATES * i + STATES] = array("q", now)
    return costs


def forward(initials: bytes, broken: bytes, out: list[int], costs: array, state: int) -> tuple[list[tuple[str, int]], int]:
    """The least audit from a state: for each turn and the end of the chunk its initials (inserts first) with the
    state in front of the last one, and the state behind the chunk. Only the last chunk inserts at its end; `out`
    of any other chunk is what the one behind has found, which inserts itself."""
    steps: list[tuple[str, int]] = []
    for i in range(len(initials)):
        after, more, text = costs[STATES * i + STATES : STATES * i + 2 * STATES], BROKEN_OFF * broken[i], ""
        while True:
            togo = costs[STATES * i + state]
            kept = KEPT[initials[i]][state]
            if togo == DELETE + after[state]:
                steps.append((text + "D", state))
            elif togo == INSERT + costs[STATES * i + NEXT[state]]:
                text, state = text + "I", NEXT[state]
                continue
            elif kept >= 0 and togo == more + after[kept]:
                steps.append((text + "K", state))
                state = kept
            else:
                steps.append((text + "R", state))
                state = NEXT[state]
            break
    text, end = "", len(initials) * STATES
    while costs[end + state] != out[state]:
        text, state = text + "I", NEXT[state]
    steps.append((text, state))
    return steps, state


def relative(costs: Iterable[int]) -> list[int]:
    """Costs less their smallest, far ones alike: what stays when vectors differ by a constant only."""
    costs = list(costs)
    least = min(costs)
    return [min(c - least, FAR) for c in costs]


def edited(steps: list[tuple[str, int]]) -> Iterator[tuple[int, str, str | None]]:
    """Repaired turns: the number of the turn that stays (-1: an inserted one), its edit, its role if that is new."""
    for i, (text, last) in enumerate(steps):
        inserts = text.count("I")
        for k in range(inserts):  # they alternate and end in the state in front of the last edit
            yield -1, "I", "user" if (last == 2) == ((inserts - k) % 2 == 1) else "assistant"
        if text and text[-1] in "KR":
            yield i, text[-1], None if text[-1] == "K" else ROLES[last]


def initial_of(role: Column) -> Column:
    """Number of the role's initial, 3 for any but s, u and a."""
    first = F.substring(role, 1, 1)
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)


_BLANKS = " \t\n\x0b\x0c\r"


def prepared(rows: DataFrame, key: str, turn: str, role: str, text: str, present: Column | None) -> DataFrame:
    """_key, _turn, _role, _text, kind (hash of role and text), initial, blank, broken and present of each row."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    there = F.lit(True) if present is None else present
    out = rows.select(F.col(key).alias("_key"), F.col(turn).alias("_turn"), one(role).alias("_role"), one(text).alias("_text"), there.alias("present"))
    last = F.substring(F.rtrim(F.col("_text"), F.lit(_BLANKS)), -1, 1)  # empty if all is white space
    kind = F.md5(F.concat(F.length(F.col("_role")).cast("string"), F.lit(":"), F.col("_role"), F.col("_text")).cast("binary"))
    return out.withColumns(
        {"kind": kind, "initial": initial_of(F.col("_role")), "blank": last == "", "broken": ~last.isin("", ".", "!", "?")}
    )


_FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_FIGURE_TYPES = ", ".join(f"{f} long" for f in _FIGURES)
_LEGAL = {(_SYSTEM, _USER), (_USER, _ASSISTANT), (_ASSISTANT, _USER)}


def _illegal(initials: bytes) -> int:
    return sum(pair not in _LEGAL for pair in zip(initials, initials[1:], strict=False))


def _short(rows: DataFrame, kind: str) -> DataFrame:
    """Conversations of bounded length, each as one chunk: key, figures, audit, turns (repaired, in order)."""
    spark = rows.sparkSession

    def result(key, turns: list[tuple]) -> tuple:
        turns = [t for t in turns if t[-1]]
        seen, live, counts = set(), [], dict.fromkeys(_FIGURES, 0)
        for i, (_, _, _, own, _, blank, broken, _) in enumerate(turns):
            if blank:
                counts["blank"] += 1
            elif own in seen:
                counts["duplicate"] += 1
            else:
                counts["truncated"] += broken
                live.append(i)
            seen.add(own)
        initials = bytes(turns[i][4] for i in live)
        broken = bytes(turns[i][6] for i in live)
        costs = backward(initials, broken, list(FINAL))
        steps, _ = forward(initials, broken, list(FINAL), costs, 0)
        counts["illegal"] = _illegal(bytes(t[4] for t in turns))
        counts["cost"] = costs[0] + DELETE * (len(turns) - len(live))
        numbers = {t[0] for t in turns if t[0] is not None}
        counts["gaps"] = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        place, audit = 0, []
        for i, (text, _) in zip([*live, len(turns)], steps, strict=True):
            audit.append("D" * (i - place) + text)  # turns that must go, in front of this one
            place = i + 1
        made = [
            {"edit": e, "role": turns[live[i]][1] if r is None else r, "text": "" if i < 0 else turns[live[i]][2]}
            for i, e, r in edited(steps)
        ]
        return key, counts, "".join(audit), made

    fields = ["_turn", "_role", "_text", "kind", "initial", "blank", "broken", "present"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current, done, key_type = [], None, [], None

        def out() -> pa.RecordBatch:
            figures = [pa.array([d[1][f] for d in done], pa.int64()) for f in _FIGURES]
            turns = pa.array([d[3] for d in done], pa.list_(pa.struct([(c, pa.string()) for c in ("edit", "role", "text")])))
            return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], key_type), *figures, pa.array([d[2] for d in done], pa.string()), turns], ["_key", *_FIGURES, "audit", "turns"])

        for batch in batches:
            key_type = batch.schema.field("_key").type
            for key, *turn in zip(*(batch.column(c).to_pylist() for c in ["_key", *fields]), strict=True):
                if held and key != current:
                    done.append(result(current, held))
                    held = []
                    if len(done) >= 500:
                        yield out()
                        done = []
                current = key
                held.append(turn)
        if held:
            done.append(result(current, held))
            yield out()

    sorted_rows = rows.select("_key", *fields).repartition(partitions(spark), "_key")
    sorted_rows = sorted_rows.sortWithinPartitions("_key", F.asc_nulls_first("_turn"), "_role", "kind")
    return sorted_rows.transform(mapped, run, f"_key {kind}, {_FIGURE_TYPES}, audit string, turns array<struct<edit string, role string, text string>>")


_CHUNK = "part int, place int, initials binary, broken binary, kinds array<string>, roles array<string>, dead array<long>, first int, last int, illegal long"


def _chunks(rows: DataFrame, kind: str, longest: int) -> DataFrame:
    """Chunks of long conversations: turns that may stay, and how many must go in front of each and behind the last."""
    slim = rows.drop("_text", "present")
    same = slim.groupBy("_key", "_turn", "_role", "kind", "initial", "blank", "broken").agg(F.count("*").alias("n"))
    place = F.struct(F.col("_turn").isNotNull().alias("known"), F.col("_turn").alias("at"))
    first = slim.where("not blank").groupBy(F.col("_key").alias("_key2"), F.col("kind").alias("kind2")).agg(F.min(place).alias("seen"))
    marked = same.join(first, F.col("_key").eqNullSafe(F.col("_key2")) & (F.col("kind") == F.col("kind2")), "left")
    marked = marked.withColumn("live", ~F.col("blank") & F.col("seen.at").eqNullSafe(F.col("_turn")))
    keys = ["_key", "_turn", "_role", "kind"]
    parts = marked.select(*keys, "initial", "broken", "live", "n").repartitionByRange(partitions(rows.sparkSession), *keys)
    ordered = parts.sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        current, held, number, key_type = None, None, 0, None

        def fresh() -> dict:
            return {"initials": [], "broken": [], "kinds": [], "roles": [], "dead": [0], "first": None, "last": None, "illegal": 0}

        def close(part: int) -> None:
            nonlocal number
            done.append((current, part, number, bytes(held["initials"]), bytes(held["broken"]), *(held[c] for c in ("kinds", "roles", "dead", "first", "last", "illegal"))))
            number += 1

        def out() -> pa.RecordBatch:
            kinds = [key_type, pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.int64()), pa.int32(), pa.int32(), pa.int64()]
            columns = [pa.array([d[k] for d in done], t) for k, t in enumerate(kinds)]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, ["_key", *(c.split()[0] for c in _CHUNK.split(", "))])

        part = 0
        for batch in batches:
            key_type = batch.schema.field("_key").type
            for key, role, own, initial, broken, live, n, part in zip(*(batch.column(c).to_pylist() for c in ["_key", "_role", "kind", "initial", "broken", "live", "n", "part"]), strict=True):
                if held is not None and (key != current or len(held["initials"]) >= longest):
                    close(part)
                    held = None
                    if len(done) >= 50:
                        yield out()
                if held is None:
                    current, held = key, fresh()
                    held["first"] = initial
                else:
                    held["illegal"] += (held["last"], initial) not in _LEGAL
                held["illegal"] += n - 1  # equal turns side by side
                held["last"] = initial
                if live:
                    held["initials"].append(initial)
                    held["broken"].append(int(broken))
                    held["kinds"].append(own)
                    held["roles"].append(role)
                    held["dead"].append(n - 1)
                else:
                    held["dead"][-1] += n
        if held is not None:
            close(part)
            yield out()

    return ordered.transform(mapped, run, f"_key {kind}, {_CHUNK}")


def _settled(chain: DataFrame, kind: str) -> DataFrame:
    """The chunks of `chain` (with no and last_one) with the costs behind them (out), up to a constant, and in front (front).

    Each round reruns chunks whose costs behind have changed by more than a constant; the last
    chunk of a conversation is right at once, and each round sets right one more at least.
    """

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fronts = [
                backward(i, b, o)[:STATES].tolist()
                for i, b, o in zip(*(batch.column(c).to_pylist() for c in ("initials", "broken", "out")), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("_key", "no", "last_one", "out")), pa.array(fronts, pa.list_(pa.int64()))],
                ["_key", "no", "last_one", "out", "front"],
            )

    schema = f"_key {kind}, no int, last_one boolean, out array<long>, front array<long>"
    columns = ["_key", "no", "last_one", "initials", "broken", "out"]
    longs = lambda values: F.array(*(F.lit(v).cast("long") for v in values))
    guess = F.when(F.col("last_one"), longs(FINAL)).otherwise(longs([0] * STATES))
    found = stored(chain.withColumn("out", guess).select(*columns).transform(mapped, back, schema), "fronts")
    while True:
        behind = found.select(
            F.col("_key").alias("_key2"), (F.col("no") - 1).alias("no2"), F.expr(f"transform(front, c -> least(c - array_min(front), {FAR}L))").alias("wanted")
        )
        met = F.col("_key").eqNullSafe(F.col("_key2")) & (F.col("no") == F.col("no2"))
        stale = stored(found.join(behind, met).where("not last_one and out <> wanted").select("_key2", "no2", "wanted"), "stale")
        if stale.isEmpty():
            return found
        again = chain.join(stale, met).withColumn("out", F.col("wanted")).select(*columns).transform(mapped, back, schema)
        found = stored(found.join(stale, met, "left_anti").unionByName(again), "fronts")


def _long(rows: DataFrame, kind: str, longest: int) -> tuple[DataFrame, DataFrame]:
    """Figures and audit of long conversations, and their repaired turns (_key, part, place, i, edit, role, text)."""
    chunks = stored(_chunks(rows, kind, longest), "chunks")
    by_place = Window.partitionBy("_key").orderBy("part", "place")
    live = chunks.where(F.length("initials") > 0)
    order = live.select("_key", "part", "place").withColumns(
        {"no": F.row_number().over(by_place), "last_one": F.lead("part").over(by_place).isNull()}
    )
    same = lambda a, b: F.expr(" and ".join(f"{a}.{c} <=> {b}.{c}" for c in ("_key", "part", "place")))
    chain = stored(live.alias("a").join(order.alias("b"), same("a", "b")).select("a.*", "no", "last_one"), "chain")
    found = _settled(chain, kind)

    def exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for i, b, o in zip(*(batch.column(c).to_pylist() for c in ("initials", "broken", "out")), strict=True):
                costs = backward(i, b, o)
                made.append([forward(i, b, o, costs, q)[1] for q in range(STATES)])
            yield pa.RecordBatch.from_arrays([batch.column("_key"), batch.column("no"), pa.array(made, pa.list_(pa.int32()))], ["_key", "no", "exits"])

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, begun = None, 0, False
        for batch in batches:
            made = []
            for key, leads in zip(batch.column("_key").to_pylist(), batch.column("exits").to_pylist(), strict=True):
                if not begun or key != current:
                    current, state, begun = key, 0, True
                made.append(state)
                state = leads[state]
            yield pa.RecordBatch.from_arrays([batch.column("_key"), batch.column("no"), pa.array(made, pa.int32())], ["_key", "no", "entry"])

    numbered = lambda a, b: F.expr(f"{a}._key <=> {b}._key and {a}.no = {b}.no")
    ready = chain.alias("a").join(found.alias("b"), numbered("a", "b")).select("a.*", "b.out")
    leads = ready.select("_key", "no", "initials", "broken", "out").transform(mapped, exits, f"_key {kind}, no int, exits array<int>")
    leads = leads.repartition(partitions(rows.sparkSession), "_key").sortWithinPartitions("_key", "no")
    starts = leads.transform(mapped, entries, f"_key {kind}, no int, entry int")

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            audits, tails, made = [], [], []
            names = ("initials", "broken", "out", "entry", "dead", "kinds", "roles")
            for i, b, o, q, dead, kinds, roles in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                steps, _ = forward(i, b, o, backward(i, b, o), q)
                audits.append("".join("D" * d + text for d, (text, _) in zip(dead, steps[:-1], strict=False)) + "D" * dead[-1])
                tails.append(steps[-1][0])
                made.append(
                    [{"edit": e, "role": r or roles[k], "kind": kinds[k] if k >= 0 else None} for k, e, r in edited(steps)]
                )
            turns = pa.array(made, pa.list_(pa.struct([(c, pa.string()) for c in ("edit", "role", "kind")])))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("_key", "part", "place")), pa.array(audits, pa.string()), pa.array(tails, pa.string()), turns],
                ["_key", "part", "place", "audit", "tail", "turns"],
            )

    traced = ready.alias("a").join(starts.alias("b"), numbered("a", "b")).select("a.*", "b.entry").drop("first", "last", "illegal", "no", "last_one")
    schema = f"_key {kind}, part int, place int, audit string, tail string, turns array<struct<edit string, role string, kind string>>"
    traced = stored(traced.transform(mapped, trace, schema), "traced")

    gone = chunks.where(F.length("initials") == 0).select("_key", "part", "place", F.expr("repeat('D', cast(dead[0] as int))").alias("audit"), F.lit("").alias("tail"))
    pieces = traced.drop("turns").unionByName(gone)
    audit = pieces.groupBy("_key").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "place", "audit"))), lambda p: p["audit"]), "").alias("audit"),
        F.max("tail").alias("tail"),  # only the last chunk has one
    )
    audit = audit.select("_key", F.concat("audit", "tail").alias("audit"))
    total = found.groupBy("_key").agg(F.sum(F.when(F.col("no") == 1, F.col("front")[0]).otherwise(F.array_min("front"))).alias("viterbi"))
    pair = F.expr("(before = 0 and first = 1) or (before = 1 and first = 2) or (before = 2 and first = 1)")
    joints = chunks.withColumn("before", F.lag("last").over(by_place)).withColumn("joint", F.when(F.col("before").isNull() | pair, 0).otherwise(1))
    figures = joints.groupBy("_key").agg(
        F.sum(F.col("illegal") + F.col("joint")).alias("illegal"), F.sum(F.aggregate("dead", F.lit(0).cast("long"), lambda a, d: a + d)).alias("dead"), F.sum(F.length("initials")).alias("live"), F.sum(F.expr("length(replace(hex(broken), '00', '')) div 2")).alias("truncated"),
    )
    counts = rows.groupBy("_key").agg(
        F.sum(F.col("blank").cast("long")).alias("blank"), F.count("*").alias("n"),
        F.coalesce(F.max("_turn") - F.min("_turn") + 1 - F.count_distinct("_turn"), F.lit(0)).cast("long").alias("gaps"),
    )
    out = counts
    for other in (figures, total, audit):
        renamed = other.withColumnRenamed("_key", "_key2")
        out = out.join(renamed, F.col("_key").eqNullSafe(F.col("_key2")), "left").drop("_key2")
    cost = F.coalesce("viterbi", F.lit(0)) + DELETE * F.col("dead")
    out = out.select("_key", "gaps", "blank", (F.col("n") - F.col("blank") - F.col("live")).alias("duplicate"), "truncated", "illegal", cost.alias("cost"), "audit")

    texts = rows.where("not blank").groupBy(F.col("_key").alias("_key2"), F.col("kind").alias("kind2")).agg(F.min("_text").alias("text"))
    turns = traced.select("_key", "part", "place", F.posexplode("turns").alias("i", "t")).select("_key", "part", "place", "i", "t.*")
    turns = turns.join(texts, F.col("_key").eqNullSafe(F.col("_key2")) & (F.col("kind") == F.col("kind2")), "left")
    return out, turns.select("_key", "part", "place", "i", "edit", "role", F.coalesce("text", F.lit("")).alias("text"))


def _digests(turns: DataFrame, kind: str) -> DataFrame:
    """SHA-256 of the repaired turns of each long conversation, which a task reads in order and one at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest, key_type = None, None, None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([current], key_type), pa.array([digest.hexdigest()])], ["_key", "sha"])

        for batch in batches:
            key_type = batch.schema.field("_key").type
            for key, role, text in zip(*(batch.column(c).to_pylist() for c in ("_key", "role", "text")), strict=True):
                if digest is not None and key == current:
                    digest.update(b"\n")
                else:
                    if digest is not None:
                        yield out()
                    current, digest = key, hashlib.sha256()
                digest.update(f"{role}:{text}".encode())
        if digest is not None:
            yield out()

    order = ["_key", "part", "place", "i"]
    rows = turns.repartition(partitions(turns.sparkSession), "_key").sortWithinPartitions(*order).select("_key", "role", "text")
    return rows.transform(mapped, run, f"_key {kind}, sha string")


class Repaired:
    """Repairs of all conversations of a table, short and long ones."""

    def __init__(self, rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: Column | None = None, longest: int = LONGEST):
        """`present` is false for rows that only say that there is such a conversation."""
        self.key, self.kind = key, rows.schema[key].dataType.simpleString()
        made = prepared(rows, key, turn, role, text, present)
        size = made.groupBy("_key").agg(F.count("*").alias("n"), F.sum(F.length("_text")).alias("size"))
        large = stored(size.where(f"n > {longest} or size > {MOST_BYTES}").select("_key", F.xxhash64("_key").alias("key")), "long")
        self.long = None
        if not large.isEmpty():
            some, rest = Filter(large.select("key")).split(made, F.xxhash64("_key"))
            found = large.select(F.col("_key").alias("_key2"))
            same = F.col("_key").eqNullSafe(F.col("_key2"))
            made = rest.unionByName(some.join(found, same, "left_anti"))
            long = stored(some.join(found, same, "left_semi").where("present"), "turns")
            self.long = _long(long, self.kind, longest)
        self.short = _short(made, self.kind)

    def conversations(self) -> DataFrame:
        """key, figures, audit and repaired_sha256 (of `role:text`, joined by line ends) of each conversation."""
        lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
        out = self.short.withColumn("repaired_sha256", F.sha2(lines, 256)).drop("turns")
        if self.long is not None:
            digests = _digests(self.long[1], self.kind).withColumnRenamed("_key", "_key2")
            met = self.long[0].join(digests, F.col("_key").eqNullSafe(F.col("_key2")), "left")
            out = out.unionByName(met.withColumn("repaired_sha256", F.coalesce("sha", F.sha2(F.lit(""), 256))).drop("_key2", "sha"))
        return out.withColumnRenamed("_key", self.key)

    def turns(self) -> DataFrame:
        """The repaired turns: key, place (ascending in a conversation), edit (K, R or I), role and text."""
        out = self.short.select("_key", F.posexplode("turns").alias("i", "t")).select("_key", F.array(F.col("i").cast("long")).alias("place"), "t.edit", "t.role", "t.text")
        if self.long is not None:
            place = F.array(*(F.col(c).cast("long") for c in ("part", "place", "i"))).alias("place")
            out = out.unionByName(self.long[1].select("_key", place, "edit", "role", "text"))
        return out.withColumnRenamed("_key", self.key)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with turns dropped (present is false), emptied, cut short, repeated and given to the user, by a hash of their place."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(one("conv_id"), F.lit(":"), one("turn")).cast("binary")) % 20
    out = rows.select("conv_id", "turn", one("role").alias("role"), one("text").alias("text"), code.alias("code"))
    out = out.select(
        "conv_id", "turn",
        F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("code") <= 1, "").when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("code") != 0).alias("present"), F.explode(F.expr("if(code = 3, array(1, 2), array(1))")).alias("copy"),
    )
    return out.drop("copy")


def op13_conversation_repair(spark, folder: str) -> DataFrame:
    rows = damaged(table(spark, folder, "conversations"))
    return Repaired(rows, present=F.col("present")).conversations()
