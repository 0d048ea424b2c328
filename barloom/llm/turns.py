"""Repair conversations to `system? (user assistant)+` at least cost.

Rows are dealt out by conversation and sorted by turn. A first stream runs over each conversation from its last turn to its
first and carries the dynamic program's state, the cost of finishing from each place of the pattern, from batch to
batch; it adds to every row one byte of backpointers: the cheapest, ASCII-least edit for each place. Spark sorts the rows
the other way round, spilling what doesn't fit, and a second stream follows the bytes from the first turn on. A task holds
a batch and one byte a row, however long a conversation is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Costs of edits and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Letters of the edits, in ASCII order: their numbers are the backpointers.
EDITS = "DIKR"
_D, _I, _K, _R = range(4)
#: Places of the pattern: before all, after system, after user, after assistant; and where user or assistant leads from each.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
ENTERS = {USER: "user", ASSISTANT: "assistant"}
#: Cost of finishing from each place where no row is left.
DONE = (0, 2 * INSERT, INSERT, 0)

#: Bits of a row's code: role initial (s u a other), must go, truncated, not a row, has a turn number.
_MUST, _CUT, _ABSENT, _NUMBERED = 4, 8, 16, 32
_SPACES = "' \\t\\n\\u000B\\u000C\\r'"


def damage(rows: DataFrame) -> DataFrame:
    """The rows of conversations with faults put in by crc32 of `conv_id:turn` modulo 20.

    0 drops the row (it stays, marked absent), 1 empties its text, 2 takes its end marks, 3 repeats it, 4 makes it a user's.
    Null roles and texts are one space, as is a null in the crc's text.
    """
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(part("text"), "[.!?]", "")).otherwise(part("text"))
    role = F.when(kind == 4, "user").otherwise(part("role"))
    times = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), (kind == 0).alias("absent"), F.explode(times).alias("copy")).drop("copy")


def faults(rows: DataFrame) -> DataFrame:
    """Rows (key, turn, role, text, nth, code) from (conv_id, turn, role, text[, absent]); nulls are one space, null turns come first.

    nth numbers equal rows of a conversation. They meet by a digest of role and text, so a giant conversation's rows are
    spread here.
    """
    absent = F.col("absent") if "absent" in rows.columns else F.lit(False)
    rows = rows.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("key"),
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
        absent.alias("absent"),
    )
    same = Window.partitionBy("key", "role", F.md5("text"), "absent").orderBy(F.asc_nulls_first("turn"))
    rows = rows.withColumn("nth", F.row_number().over(same)).withColumn("body", F.expr(f"trim(TRAILING {_SPACES} FROM text)"))
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    code = code + F.when((F.col("body") == "") | (F.col("nth") > 1), _MUST).otherwise(0)
    code = code + F.when(F.col("body").rlike("[.!?]\\z"), 0).otherwise(_CUT) + F.when(F.col("absent"), _ABSENT).otherwise(0) + F.when(F.col("turn").isNotNull(), _NUMBERED).otherwise(0)
    return rows.select("key", F.coalesce("turn", F.lit(0)).alias("turn"), "role", "text", "nth", code.cast("int").alias("code"))


def step(cost: tuple[int, int, int, int], code: int) -> tuple[tuple[int, int, int, int], int]:
    """Costs of finishing before a row from those after it, and the row's best edit for each place, two bits each."""
    role, stays = code & 3, 0 if code & _CUT == 0 else TRUNCATED
    taken = []
    for place in range(4):
        options = [(DELETE + cost[place], _D)]
        if not code & _MUST:
            if role == 0 and place == START:
                options.append((stays + cost[SYSTEM], _K))
            elif (role == 1 and NEXT[place] == USER) or (role == 2 and NEXT[place] == ASSISTANT):
                options.append((stays + cost[NEXT[place]], _K))
            options.append((REROLE + stays + cost[NEXT[place]], _R))
        taken.append(min(options))
    # an insertion leads to a place before the same row: two in a row never pay after user or assistant
    best = list(taken)
    for place in (USER, ASSISTANT):
        best[place] = min(taken[place], (INSERT + taken[NEXT[place]][0], _I))
    for place in (START, SYSTEM):
        best[place] = min(taken[place], (INSERT + best[USER][0], _I))
    return tuple(b[0] for b in best), sum(b[1] << 2 * place for place, b in enumerate(best))


class _Steps(dict):
    """step() remembered by cost differences, which are few: (differences, code) to (differences, backpointers)."""

    def __missing__(self, key):
        cost, byte = step(*key)
        self[key] = found = (tuple(c - min(cost) for c in cost), byte)
        return found


def _backwards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    steps, current, cost = _Steps(), None, DONE
    for batch in batches:
        pointers = bytearray(len(batch))
        for k, (key, code) in enumerate(zip(batch["key"], batch["code"].tolist(), strict=True)):
            if key != current:
                current, cost = key, DONE
            if not code & _ABSENT:
                cost, pointers[k] = steps[cost, code & 15]
        yield batch.assign(pointers=list(pointers))


class _Walk:
    """One conversation from its first turn on; sink takes (turn, role, text, edit) of every row that is kept or put in."""

    def __init__(self, key: str, sink: Callable | None = None):
        self.key, self.sink = key, sink
        self.place, self.cost, self.edits = START, 0, []
        self.hash, self.some = hashlib.sha256(), False
        self.count = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.last_role, self.first_turn, self.last_turn, self.turns = None, None, None, 0

    def give(self, turn: int | None, role: str, text: str, edit: int) -> None:
        self.hash.update(f"{chr(10) if self.some else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.some = True
        if self.sink is not None:
            self.sink((self.key, turn, role, text, EDITS[edit]))

    def insert(self) -> None:
        self.place = NEXT[self.place]
        self.edits.append("I")
        self.cost += INSERT
        self.give(None, ENTERS[self.place], "", _I)

    def row(self, turn: int, role: str, text: str, nth: int, code: int, pointers: int) -> None:
        if code & _NUMBERED and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn, self.turns = turn, self.turns + 1
        if code & _MUST:
            self.count["duplicate" if nth > 1 and text.strip(" \t\n\v\f\r") else "blank"] += 1
        elif code & _CUT:
            self.count["truncated"] += 1
        initial = code & 3
        if self.last_role is not None:
            self.count["illegal"] += (self.last_role, initial) not in ((0, 1), (2, 1), (1, 2))
        self.last_role = initial
        while (edit := pointers >> 2 * self.place & 3) == _I:
            self.insert()
        self.edits.append(EDITS[edit])
        if edit == _D:
            self.cost += DELETE
            return
        self.cost += (REROLE if edit == _R else 0) + (TRUNCATED if code & _CUT else 0)
        self.place = SYSTEM if edit == _K and initial == 0 else NEXT[self.place]
        self.give(turn if code & _NUMBERED else None, role if edit == _K else ENTERS[self.place], text, edit)

    def end(self) -> tuple:
        while self.place in (SYSTEM, USER):
            self.insert()
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        return (self.key, gaps, *self.count.values(), self.cost, "".join(self.edits), self.hash.hexdigest())


def _walks(batches: Iterator[pd.DataFrame], sink: list | None = None) -> Iterator[tuple | None]:
    """Ends of conversations as they come, and None after each batch."""
    walk = None
    for batch in batches:
        for key, turn, role, text, nth, code, pointers in zip(*[batch[c].tolist() for c in ("key", "turn", "role", "text", "nth", "code", "pointers")], strict=True):
            if walk is None or key != walk.key:
                if walk is not None:
                    yield walk.end()
                walk = _Walk(key, None if sink is None else sink.append)
            if not code & _ABSENT:
                walk.row(turn, role, text, nth, code, pointers)
        yield None
    if walk is not None:
        yield walk.end()


_SUMMARY = ["key", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
_TURN = ["key", "turn", "role", "text", "edit"]


def _summaries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    found = []
    for end in _walks(batches):
        if end is not None:
            found.append(end)
        elif found:
            yield pd.DataFrame(found, columns=_SUMMARY)
            found = []
    yield pd.DataFrame(found, columns=_SUMMARY)


def _turns(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    found: list = []
    counted: dict = {}  # only of the conversation that is open
    for end in _walks(batches, found):
        if end is None and found:
            places = []
            for row in found:
                if row[0] not in counted:
                    counted = {row[0]: 0}
                counted[row[0]] += 1
                places.append(counted[row[0]])
            yield pd.DataFrame(found, columns=_TURN).astype({"turn": "Int64"}).assign(place=places)
            found.clear()
    if found:
        start = counted.get(found[0][0], 0)
        yield pd.DataFrame(found, columns=_TURN).astype({"turn": "Int64"}).assign(place=range(start + 1, start + 1 + len(found)))


def _pointed(rows: DataFrame) -> DataFrame:
    """Rows with backpointers, dealt out by conversation once, each conversation from its first turn on."""
    order = ["turn", "role", "text", "nth"]
    numbered = F.col("code").bitwiseAND(F.lit(_NUMBERED))
    dealt = faults(rows).repartition("key").sortWithinPartitions("key", numbered.desc(), *[F.desc(c) for c in order])
    pointed = dealt.mapInPandas(_backwards, "key string, turn long, role string, text string, nth int, code int, pointers int")
    return pointed.sortWithinPartitions("key", numbered, *order)


def _conv_id(rows: DataFrame) -> Column:
    kind = rows.schema["conv_id"].dataType.simpleString()
    return F.when(F.col("key") != "", F.substring("key", 2, 1 << 30).cast(kind)).alias("conv_id")


def audit(rows: DataFrame) -> DataFrame:
    """Per conv_id of rows (conv_id, turn, role, text): gaps, faults, cost, audit and repaired_sha256 of its cheapest repair.

    Each conversation is taken by turn, null turns first, then by role and text. Nulls in role and text are one space. Where rows has
    a column absent, rows with it true only name their conversation. A null conv_id is a conversation of its own; extra columns are
    ignored; an empty table gives no rows; a conversation without rows has zeros, an empty audit and the empty text's hash.
    """
    found = _pointed(rows).mapInPandas(_summaries, "key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
    return found.select(_conv_id(rows), *_SUMMARY[1:])


def repair(rows: DataFrame) -> DataFrame:
    """The repaired conversations: (conv_id, place, turn, role, text, edit), a row for each turn that stays or is put in.

    place counts from 1; turn is null where it was or where the row is put in. The cases are those of audit().
    """
    found = _pointed(rows).mapInPandas(_turns, "key string, turn long, role string, text string, edit string, place long")
    return found.select(_conv_id(rows), "place", "turn", "role", "text", "edit")
