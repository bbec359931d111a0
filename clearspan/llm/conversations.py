"""Conversation repair by Knuth's lightest derivations.

Turns are edited until their role initials read ``(s?(ua)+)?``: Keep, Rerole, Delete, Insert. An item ``[i, state]`` says
that the first ``i`` turns are edited into a beginning that ends in ``state``; each edit deduces an item from an item.
Weights are pairs (cost, audit), an edit adds to the cost and appends its initial, so weights never fall along a
deduction and equal costs are told apart by the audit. An agenda pops the lightest item, which is then final, until
the goal is final.

A conversation is cut into pieces of a bounded number of turns. The agenda of a piece gives the lightest edits from every
state to every state, a fact of the hypergraph in its own right; the agenda of the conversation combines
items with such facts. So a conversation with a third of all turns is spread over as many tasks as it has pieces.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearspan.llm.common import SPACE

#: States by the role initial read last: none, system, user, assistant.
STATES = 4
START, SYSTEM, USER, ASSISTANT = range(STATES)
#: From a state, the state after each role initial.
NEXT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
#: The one role that Rerole and Insert may give in a state.
GIVEN = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
GOAL = (START, ASSISTANT)
RIGHT_PAIRS = ("su", "ua", "au")

REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Turns of a piece, and by how many turn numbers a group of turns is wide.
PIECE, TURNS = 256, 256
#: Groups with more turns are dealt by turn number and digest too.
CROWDED = 4_096

Weight = tuple[int, str]


def edits(state: int, initial: str, must_go: bool, cut_short: bool) -> Iterator[tuple[int, str, int]]:
    """What may be done with a turn in a state: cost, initial of the edit, state after it."""
    yield DELETE, "D", state
    if not must_go:
        more = TRUNCATED if cut_short else 0
        if initial in NEXT[state]:
            yield more, "K", NEXT[state][initial]
        yield REROLE + more, "R", NEXT[state][GIVEN[state][0]]


def lightest(turns: list[tuple[str, bool, bool]], start: int) -> list[Weight | None]:
    """The lightest edits of some turns ``(initial, must go, cut short)`` from a state to each state; None if there are none."""
    found: list[Weight | None] = [None] * STATES
    final = set()
    agenda: list[tuple[int, str, int, int]] = [(0, "", 0, start)]
    while agenda:
        cost, audit, i, state = heapq.heappop(agenda)
        if (i, state) in final:
            continue
        final.add((i, state))
        if i == len(turns):
            found[state] = (cost, audit)
        else:
            for more, edit, after in edits(state, *turns[i]):
                if (i + 1, after) not in final:
                    heapq.heappush(agenda, (cost + more, audit + edit, i + 1, after))
        after = NEXT[state][GIVEN[state][0]]
        if (i, after) not in final:
            heapq.heappush(agenda, (cost + INSERT, audit + "I", i, after))
    return found


def combined(pieces: list[list[list[Weight | None]]]) -> Weight:
    """The lightest edits of a conversation from the facts ``pieces[p][state][state after]``.

    Weights of items are kept as costs and links back; audits are compared from where two derivations part, so nothing
    of the length of the conversation is copied per item. Items of one cost are popped by piece, hence all
    derivations of an item with its cost are known before it is final.
    """
    best: dict[tuple[int, int], tuple[int, int | None]] = {(0, START): (0, None)}

    def before(p: int, state: int, one: int, other: int) -> bool:
        """Whether the derivation of [p, state] from [p - 1, one] has a smaller audit than that from [p - 1, other]."""
        x, y, x_to, y_to = [], [], state, state
        while one != other:
            p -= 1
            x.append(pieces[p][one][x_to][1])
            y.append(pieces[p][other][y_to][1])
            x_to, y_to = one, other
            one, other = best[p, one][1], best[p, other][1]
        x.append(pieces[p - 1][one][x_to][1])
        y.append(pieces[p - 1][one][y_to][1])
        return "".join(reversed(x)) < "".join(reversed(y))

    final = set()
    agenda = [(0, 0, START)]
    goal = None
    while agenda:
        cost, p, state = heapq.heappop(agenda)
        if (p, state) in final or best[p, state][0] != cost:
            continue
        final.add((p, state))
        if p == len(pieces):
            # Both goal states of one cost are told apart by their audits, which no later item can undercut.
            if state in GOAL and goal is None:
                goal = (cost, [state])
            elif state in GOAL and cost == goal[0]:
                goal[1].append(state)
            elif goal and cost > goal[0]:
                break
            continue
        for after, fact in enumerate(pieces[p][state]):
            if fact is None:
                continue
            known = best.get((p + 1, after))
            total = cost + fact[0]
            if known is None or total < known[0] or (total == known[0] and before(p + 1, after, state, known[1])):
                best[p + 1, after] = (total, state)
                heapq.heappush(agenda, (total, p + 1, after))

    def audit(state: int) -> str:
        parts = []
        for p in range(len(pieces), 0, -1):
            came = best[p, state][1]
            parts.append(pieces[p - 1][came][state][1])
            state = came
        return "".join(reversed(parts))

    return goal[0], min(audit(s) for s in goal[1])


def _facts() -> T.StructType:
    return T._parse_datatype_string(
        "turns long, blank long, duplicate long, truncated long, illegal long, first_initial string, last_initial string, "
        "least long, most long, distinct long, first_turn long, last_turn long, costs array<int>, audits array<string>"
    )


def _piece(rows: list[dict]) -> dict:
    """Counts and lightest edits of the turns of one piece; a row stands for ``times`` equal turns."""
    turns: list[tuple[str, bool, bool]] = []
    numbers = [r["turn"] for r in rows if r["turn"] is not None]
    count = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
    for r in rows:
        again = r["times"] - 1 + r["seen"]
        if r["blank"]:
            count["blank"] += r["times"]
        else:
            count["duplicate"] += again
            count["truncated"] += int(r["cut_short"] and not r["seen"])
        turns.append((r["initial"], r["blank"] or r["seen"], r["cut_short"]))
        turns += [(r["initial"], True, False)] * (r["times"] - 1)
    count["illegal"] = sum(a[0] + b[0] not in RIGHT_PAIRS for a, b in zip(turns, turns[1:]))
    facts = [lightest(turns, s) for s in range(STATES)]
    flat = [w for row in facts for w in row]
    return {
        "turns": len(turns), **count, "first_initial": turns[0][0], "last_initial": turns[-1][0],
        "least": min(numbers, default=None), "most": max(numbers, default=None), "distinct": len(set(numbers)),
        "first_turn": rows[0]["turn"], "last_turn": rows[-1]["turn"],
        "costs": [w and w[0] for w in flat], "audits": [w and w[1] for w in flat],
    }


def _dictionaries(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _batched(rows: Iterator[dict], schema: pa.Schema, size: int = 1_000) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _split(rows: Iterator[dict]) -> Iterator[tuple[dict, list[dict]]]:
    """Consecutive rows of one group, as lists that stand for at most PIECE turns each."""
    held: list[dict] = []
    size = 0
    for row in rows:
        times = row["times"]
        same = held and all(held[0][k] == row[k] for k in ("conv_id", "known", "group", "turn_group", "digest_group"))
        if same and not times:
            continue
        if held and (not same or size >= PIECE):
            yield held[0], held
            held, size = [], 0
        held.append(row)
        size += times
        while size > PIECE and row["times"] > 1:
            # Many equal turns: the first piece takes as many as fit, all further ones are seen before.
            left = min(size - PIECE, row["times"] - 1)
            held[-1] = {**row, "times": row["times"] - left}
            yield held[0], held
            row = {**row, "times": left, "seen": True}
            held, size = [row], left
    if held:
        yield held[0], held


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def marked(turns: DataFrame) -> DataFrame:
    """Turns ``conv_id, turn, role, text, times`` without texts: equal ones as one row, with their digest and what ails them."""
    letter = f"[^{SPACE}]"
    narrow = turns.select(
        "conv_id", "turn", "role", "times", F.md5(F.encode("text", "UTF-8")).alias("digest"),
        (~F.col("text").rlike(letter)).alias("blank"), (~F.col("text").rlike(f"[.!?][{SPACE}]*\\z")).alias("cut_short"),
    )
    rows = narrow.groupBy("conv_id", "turn", "role", "digest").agg(
        F.sum("times").alias("times"), F.first("blank").alias("blank"), F.first("cut_short").alias("cut_short")
    )
    rows = rows.withColumn("at", F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("number")))
    first = rows.where("times > 0").groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(F.min("at").alias("first"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    return rows.join(first, same, "left").select(
        "conv_id", "turn", "role", "digest", "times", "blank", "cut_short",
        F.substring("role", 1, 1).alias("initial"), F.coalesce(F.col("at") > F.col("first"), F.lit(False)).alias("seen"),
    )


def pieces(turns: DataFrame) -> DataFrame:
    """The pieces of each conversation in order: ``conv_id, place`` and the facts of the piece.

    Turns are grouped by ranges of turn numbers; a range with many turns is dealt further by number and digest.
    """
    rows = marked(turns).withColumns({"known": F.col("turn").isNotNull(), "group": F.expr(f"coalesce(turn, 0) div {TURNS}")})
    crowds = rows.groupBy(F.col("conv_id").alias("c"), F.col("known").alias("k"), F.col("group").alias("g")).agg(F.count("*").alias("rows")).where(F.col("rows") > CROWDED)
    crowd = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("known") == F.col("k")) & (F.col("group") == F.col("g"))
    dealt = rows.join(crowds, crowd, "left")
    dealt = dealt.withColumn("turn_group", F.when(F.col("rows").isNotNull(), F.coalesce("turn", F.lit(0))).otherwise(F.lit(-1)))
    dealt = dealt.withColumn("digest_group", F.when(F.col("rows").isNotNull(), F.substring("digest", 1, 2)).otherwise(F.lit("")))
    keys = ["conv_id", "known", "group", "turn_group", "digest_group"]
    names = [*keys, "turn", "initial", "times", "blank", "cut_short", "seen"]
    # Also conversations without turns have a row here, with a piece of none.
    ordered = dealt.repartition(*keys).sortWithinPartitions(*keys, F.asc_nulls_first("turn"), "digest", "role").select(*names)
    place = T.StructType([ordered.schema[k] for k in keys] + [T.StructField("place", T.LongType())])
    schema = T.StructType([*place.fields, *_facts().fields])
    shape = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[dict]:
            last, number = None, 0
            for head, rows in _split(_dictionaries(batches)):
                key = {k: head[k] for k in keys}
                number = number + 1 if key == last else 0
                last = key
                rows = [r for r in rows if r["times"] > 0]
                empty = {"turns": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "distinct": 0}
                yield {**key, "place": number, **(_piece(rows) if rows else empty)}

        return _batched(found(), shape)

    return ordered.mapInArrow(run, schema)


def _table(row: dict) -> list[list[Weight | None]]:
    flat = [None if c is None else (c, a) for c, a in zip(row["costs"], row["audits"])]
    return [flat[s * STATES : (s + 1) * STATES] for s in range(STATES)]


def derivations(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``.

    Gathers the facts of a conversation's pieces in one task: some bytes a turn and no texts, in the order of the
    audit itself, which is one value.
    """
    order = ["conv_id", "known", "group", "turn_group", "digest_group", "place"]
    ordered = pieces(turns).repartition("conv_id").sortWithinPartitions(*order)
    counts = ["blank", "duplicate", "truncated", "illegal"]
    schema = T.StructType([ordered.schema["conv_id"], *T._parse_datatype_string("gaps long, " + ", ".join(f"{c} long" for c in counts) + ", cost long, audit string").fields])
    shape = _arrow(schema)

    def whole(rows: list[dict]) -> dict:
        out = {"conv_id": rows[0]["conv_id"], "gaps": 0, **dict.fromkeys(counts, 0), "cost": 0, "audit": ""}
        rows = [r for r in rows if r["turns"]]
        if not rows:
            return out
        for c in counts:
            out[c] = sum(r[c] for r in rows)
        distinct = sum(r["distinct"] for r in rows)
        for a, b in zip(rows, rows[1:]):
            out["illegal"] += a["last_initial"] + b["first_initial"] not in RIGHT_PAIRS
            distinct -= a["last_turn"] is not None and a["last_turn"] == b["first_turn"]
        if distinct:
            least, most = (f(r[c] for r in rows if r[c] is not None) for f, c in ((min, "least"), (max, "most")))
            out["gaps"] = most - least + 1 - distinct
        out["cost"], out["audit"] = combined([_table(r) for r in rows])
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[dict]:
            held: list[dict] = []
            for row in _dictionaries(batches):
                if held and held[0]["conv_id"] != row["conv_id"]:
                    yield whole(held)
                    held = []
                held.append(row)
            if held:
                yield whole(held)

        return _batched(found(), shape)

    return ordered.mapInArrow(run, schema)


def _applied(rows: Iterator[dict]) -> Iterator[tuple[dict | None, str, str, str]]:
    """The repaired turns of sorted rows: the derivation of a new conversation or None, then edit, role and text.

    The derivation of a conversation comes before its turns and is also given alone, with an empty edit.
    """
    audit, at, state = "", 0, START

    def inserts() -> Iterator[tuple[None, str, str, str]]:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            role = GIVEN[state]
            state, at = NEXT[state][role[0]], at + 1
            yield None, "I", role, ""

    for row in rows:
        if row["audit"] is not None:
            yield from inserts()
            audit, at, state = row["audit"], 0, START
            yield row, "", "", ""
            continue
        for _ in range(row["times"]):
            yield from inserts()
            edit, at = audit[at], at + 1
            if edit != "D":
                role = row["role"] if edit == "K" else GIVEN[state]
                state = NEXT[state][role[0]]
                yield None, edit, role, row["text"]
    yield from inserts()


def _beside_turns(turns: DataFrame, derived: DataFrame) -> DataFrame:
    """Each conversation's derivation and then its turns, in order, in one task that reads them as a stream."""
    facts = [c for c in derived.columns if c not in ("conv_id", "audit")]
    nothing = turns.select(
        "conv_id", "turn", "role", "text", "times", F.md5(F.encode("text", "UTF-8")).alias("digest"), F.lit(None).cast("string").alias("audit"),
        *[F.lit(None).cast("bigint").alias(c) for c in facts],
    ).where("times > 0")
    heads = derived.select(
        "conv_id", F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), F.lit(0).cast("bigint").alias("times"),
        F.lit("").alias("digest"), "audit", *facts,
    )
    both = heads.unionByName(nothing)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), F.asc_nulls_first("turn"), "digest", "role").drop("digest", "turn")


def prepared(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, times``; nulls of role and text read as one space, ``times`` is 1 where it is not given."""
    times = F.col("times").cast("bigint") if "times" in turns.columns else F.lit(1).cast("bigint")
    blank = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    return turns.select("conv_id", F.col("turn").cast("bigint").alias("turn"), *blank, times.alias("times"))


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The turns of the repaired conversations: ``conv_id, place, edit, role, text``, places from 0."""
    rows = prepared(turns)
    schema = T.StructType([rows.schema["conv_id"], *T._parse_datatype_string("place long, edit string, role string, text string").fields])
    shape = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[dict]:
            conv_id, place = None, 0
            for head, edit, role, text in _applied(_dictionaries(batches)):
                if head:
                    conv_id, place = head["conv_id"], 0
                else:
                    yield {"conv_id": conv_id, "place": place, "edit": edit, "role": role, "text": text}
                    place += 1

        return _batched(found(), shape)

    return _beside_turns(rows, derivations(rows)).mapInArrow(run, schema)


def repair(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    ``turns`` has ``conv_id, turn, role, text`` and optionally ``times``, how often the turn stands there; a conversation
    whose turns all have 0 is reported with zeros, an empty audit and the digest of nothing. Turns are taken by number,
    nulls first, turns of one number by the MD5 of their text and then by role. Null roles and texts read as
    one space; rows of a null ``conv_id`` are one conversation. Empty tables give no rows. Other columns are neither read
    nor returned. Texts and conversations may be of any length: texts are streamed into the digest, which by its nature
    takes the turns of a conversation one after another.
    """
    rows = prepared(turns)
    derived = derivations(rows)
    schema = T.StructType([*derived.schema.fields, T.StructField("repaired_sha256", T.StringType())])
    shape, names = _arrow(schema), derived.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[dict]:
            current, digest, started = None, None, False
            for head, _, role, text in _applied(_dictionaries(batches)):
                if head:
                    if current:
                        yield {**current, "repaired_sha256": digest.hexdigest()}
                    current, digest, started = {c: head[c] for c in names}, hashlib.sha256(), False
                else:
                    digest.update((("\n" if started else "") + f"{role}:{text}").encode())
                    started = True
            if current:
                yield {**current, "repaired_sha256": digest.hexdigest()}

        return _batched(found(), shape)

    return _beside_turns(rows, derived).mapInArrow(run, schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns with the damage that the CRC-32 of ``conv_id:turn`` modulo 20 calls for, and ``times`` (0: the turn is gone)."""

    def spaced(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(spaced("text"), "[.!?]", "")).otherwise(spaced("text"))
    return conversations.select(
        "conv_id", "turn",
        F.when(kind == 4, F.lit("user")).otherwise(spaced("role")).alias("role"), text.alias("text"),
        F.when(kind == 0, F.lit(0)).when(kind == 3, F.lit(2)).otherwise(F.lit(1)).cast("bigint").alias("times"),
    )
