"""Conversation structure repair: the cheapest edits that make the roles of a conversation alternate.

Rows are repartitioned by conversation and sorted by turn; ``mapInPandas`` streams
them and carries the state of a dynamic program over four role states across
Arrow batches: of each state the cost so far and the rank of its edit string among
the others, which is all that later choices depend on, so a step is looked up in a
table of steps met before.  Backpointers take four bytes a row.  Every ``block``
rows of a conversation they leave the task as a row of a table in the shared
folder; a second stream reads a giant conversation's blocks from its end and
turns them into edits, a third merges the edits with the rows.  So no task holds
more than a block of a conversation, and a lost executor costs a task, not the job.

Edits: Keep 0, Rerole to user or assistant 1, Delete 2 (the only one for blank and
duplicate rows), Insert an empty user or assistant turn 5; a truncated row that is
not deleted adds 5.  The kept roles' initials must give ``(s?(ua)+)?``; among the
cheapest edits the ASCII-least string wins.

Defined cases: null roles and texts are one space; turns are ordered null first,
then by role and digest of the text; of equal rows all but the first are
duplicates; rows without conv_id are one conversation; a conversation without rows
has no edits; an empty table gives no rows.  Columns beside the four are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections import deque

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalrec.llm.common import Scratch, load

BLOCK = 65_536
SPACE = " \t\n\x0b\x0c\r"

# ---- role states: nothing yet, after system, after user, after assistant ----
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = (_USER, _USER, _ASSISTANT, _USER)  # by an inserted or reroled turn
_KEEP = {("s", _START): _SYSTEM, ("u", _START): _USER, ("u", _SYSTEM): _USER, ("u", _ASSISTANT): _USER,
         ("a", _USER): _ASSISTANT}
_LETTERS = "DKR"
_BEGIN = ((0, 0), None, None, None)  # (cost above the least, rank) of each state that can be reached
_NONE = 255


@functools.lru_cache(maxsize=65_536)
def step(live: tuple, initial: str, delete: bool, truncated: bool) -> tuple[tuple, int, bytes]:
    """The states after a row, by how much the least cost rises, and a backpointer byte per state.

    Strings of two states after a row both end with an edit of that row, so neither begins the other:
    their order never changes by what follows, and a rank stands for a string.
    """
    best: list = [None] * 4
    for p, at in enumerate(live):
        if at is None:
            continue
        cost, rank, q = *at, p
        for k in range(3):
            options = [("D", q, 2)]
            if not delete:
                options.append(("R", _NEXT[q], 1 + 5 * truncated))
                if (initial, q) in _KEEP:
                    options.append(("K", _KEEP[initial, q], 5 * truncated))
            for letter, to, price in options:
                found = (cost + 5 * k + price, (rank, "I" * k + letter), p | k << 2 | _LETTERS.index(letter) << 4)
                if best[to] is None or found < best[to]:
                    best[to] = found
            q = _NEXT[q]
    least = min(b[0] for b in best if b)
    ranks = {s: i for i, s in enumerate(sorted(b[1] for b in best if b))}
    return (tuple(b and (b[0] - least, ranks[b[1]]) for b in best), least, bytes(b[2] if b else _NONE for b in best))


def finish(live: tuple) -> tuple[int, int, int]:
    """Cost above the least, state and number of inserts at the end of the best string."""
    found = []
    for p, at in enumerate(live):
        if at is None:
            continue
        q = p
        for k in range(3):
            if q in (_START, _ASSISTANT):
                found.append((at[0] + 5 * k, at[1], p, k))
            q = _NEXT[q]
    cost, _, state, inserts = min(found)
    return cost, state, inserts


def trace(back: bytes, state: int) -> tuple[str, int]:
    """The edits of a block that ends in ``state``, and the state it begins with."""
    out = []
    for i in range(len(back) - 4, -1, -4):
        b = back[i + state]
        out.append("I" * (b >> 2 & 3) + _LETTERS[b >> 4])
        state = b & 3
    return "".join(reversed(out)), state


# ---- rows ------------------------------------------------------------------------

_KEY = ["gap", "conv_id"]  # a conversation: without id, id
_ORDER = ["timed", "turn", "role", "digest"]  # a row's place in it


def prepare(rows: DataFrame, there: Column | None = None) -> DataFrame:
    """_KEY, _ORDER, there, text of conversation rows; a row that is not ``there`` only tells of its conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    zero = F.lit(0).cast("long")
    return rows.select(
        F.col("conv_id").isNull().alias("gap"), F.coalesce(F.col("conv_id").cast("long"), zero).alias("conv_id"),
        F.col("turn").isNotNull().alias("timed"), F.coalesce(F.col("turn").cast("long"), zero).alias("turn"),
        role.alias("role"), F.md5(text.cast("binary")).alias("digest"),
        (F.lit(True) if there is None else there).alias("there"), text.alias("text"))


def _with_faults(rows: DataFrame) -> DataFrame:
    """_KEY, _ORDER, there, blank, later, truncated; ``later``: role and text stand at an earlier turn."""
    end = F.rtrim(F.col("text"), F.lit(SPACE))
    small = rows.select(*_KEY, *_ORDER, "there", (end == "").alias("blank"),
                        (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("truncated"))
    same = [*_KEY, "role", "digest"]
    twice = small.where("there").groupBy(*same).agg(
        F.count(F.lit(1)).alias("times"), F.bool_or(~F.col("timed")).alias("untimed"),
        F.min(F.when(F.col("timed"), F.col("turn"))).alias("least")).where("times > 1").drop("times")
    return small.join(twice, same, "left").select(
        *_KEY, *_ORDER, "there", "blank", "truncated",
        F.coalesce(F.col("timed") & (F.col("untimed") | (F.col("turn") > F.col("least"))), F.lit(False)).alias("later"))


_PLAN = ("gap boolean, conv_id long, block long, timed boolean, turn long, role string, digest string, back binary, "
         "letters string, done boolean, state int, inserts int, gaps long, blank long, duplicate long, truncated long, "
         "illegal long, cost long")
_PLAN_NAMES = [x.split()[0] for x in _PLAN.split(", ")]


class _Progress:
    """A conversation as far as it has been read."""

    def __init__(self, key: tuple, block: int):
        self.key, self.size = key, block
        self.live, self.cost = _BEGIN, 0
        self.back, self.blocks, self.first = bytearray(), 0, None
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.initial = self.place = self.turn = self.lowest = None

    def add(self, place: tuple, blank: bool, truncated: bool, later: bool) -> dict | None:
        """Reads a row; a full block, if one was ready before it."""
        out = self._spilled() if len(self.back) >= 4 * self.size else None
        duplicate = not blank and (later or place == self.place)
        truncated = truncated and not blank and not duplicate
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        timed, turn, role, _ = place
        initial = role[:1]
        if self.place is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        if timed and turn != self.turn:
            self.turns += 1
            self.turn = turn
            self.lowest = turn if self.lowest is None else self.lowest
        if not self.back:
            self.first = place
        self.initial, self.place = initial, place
        self.live, rise, back = step(self.live, initial if initial in ("s", "u", "a") else "", blank or duplicate, truncated)
        self.cost += rise
        self.back += back
        return out

    def _spilled(self) -> dict:
        out = self._row(back=bytes(self.back), done=False)
        self.back, self.blocks = bytearray(), self.blocks + 1
        return out

    def _row(self, **more) -> dict:
        place = dict(zip(_ORDER, self.first)) if self.first is not None else {}
        return {"gap": self.key[0], "conv_id": self.key[1], "block": self.blocks, **place, **more}

    def end(self) -> dict:
        """The last block with what the conversation comes to; traced already if it is the only one."""
        more, state, inserts = finish(self.live)
        letters = trace(bytes(self.back), state)[0] + "I" * inserts if not self.blocks else None
        gaps = self.turn - self.lowest + 1 - self.turns if self.turns else 0
        return self._row(back=None if letters is not None else bytes(self.back), letters=letters, done=True, state=state,
                         inserts=inserts, gaps=gaps, blank=self.blank, duplicate=self.duplicate,
                         truncated=self.truncated, illegal=self.illegal, cost=self.cost + more)


def _plan(block: int):
    def run(batches):
        now = None
        for df in batches:
            out = []
            columns = (df[c].tolist() for c in (*_KEY, *_ORDER, "there", "blank", "truncated", "later"))
            for gap, conv, timed, turn, role, digest, there, blank, truncated, later in zip(*columns):
                if now is None or now.key != (gap, conv):
                    if now is not None:
                        out.append(now.end())
                    now = _Progress((gap, conv), block)
                if there and (full := now.add((timed, turn, role, digest), blank, truncated, later)):
                    out.append(full)
            yield _frame(out)
        if now is not None:
            yield _frame([now.end()])
    return run


_KINDS = {"boolean": "boolean", "long": "Int64", "int": "Int32", "string": object, "binary": object}


def _frame(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame({name: pd.Series([r.get(name) for r in rows], dtype=_KINDS[kind])
                         for name, kind in (x.split() for x in _PLAN.split(", "))})


def _trace_blocks(batches):
    """Blocks of giant conversations, each from its last to its first, with letters in place of backpointers."""
    state = 0
    for df in batches:
        letters = []
        for back, done, end, inserts in zip(df["back"], df["done"], df["state"], df["inserts"]):
            if done:
                state = int(end)
            told, state = trace(back, state)
            letters.append(told + "I" * (int(inserts) if done else 0))
        yield df.assign(letters=pd.Series(letters, index=df.index, dtype=object))[[*_KEY, "block", *_ORDER, "letters"]]


def plan_edits(rows: DataFrame, block: int = BLOCK, scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame]:
    """What each conversation of prepared rows comes to, and its edits in blocks.

    First: _KEY, gaps, blank, duplicate, truncated, illegal, cost.  Second: _KEY, block, the _ORDER of the
    block's first row, letters.
    """
    scratch = scratch or Scratch(rows.sparkSession, "turn-repair")
    plan = scratch.put(_with_faults(rows).repartition(*_KEY).sortWithinPartitions(*_KEY, *_ORDER).mapInPandas(
        _plan(block), _PLAN))
    edits = [*_KEY, "block", *_ORDER, "letters"]
    giant = plan.where("letters is null").repartition(*_KEY).sortWithinPartitions(
        *_KEY, F.col("block").desc()).mapInPandas(
        _trace_blocks, "gap boolean, conv_id long, block long, timed boolean, turn long, role string, digest string, letters string")
    return (plan.where("done").select(*_KEY, "gaps", "blank", "duplicate", "truncated", "illegal", "cost"),
            plan.where("letters is not null").select(edits).unionByName(giant))


_REPAIRED = "gap boolean, conv_id long, pos long, edit string, role string, text string"


def _apply(batches):
    """Merges sorted rows with the edits that stand before them, and gives the turns that remain."""
    key, letters, state, pos = None, deque(), _START, 0
    name = {_USER: "user", _ASSISTANT: "assistant"}
    schema = pa.schema([("gap", pa.bool_()), ("conv_id", pa.int64()), ("pos", pa.int64()), ("edit", pa.string()),
                        ("role", pa.string()), ("text", pa.string())])

    def put(edit, role, text):
        nonlocal pos
        out.append((*key, pos, edit, role, text))
        pos += 1

    def insert():
        nonlocal state
        while letters and letters[0] == "I":
            letters.popleft()
            state = _NEXT[state]
            put("I", name[state], "")

    for b in batches:
        out = []
        columns = (b.column(c).to_pylist() for c in (*_KEY, "role", "text", "letters"))
        for gap, conv, role, text, told in zip(*columns):
            if key != (gap, conv):
                if key is not None:
                    insert()
                key, state, pos = (gap, conv), _START, 0
                letters.clear()
            if told is not None:
                letters.extend(told)
                continue
            insert()
            edit = letters.popleft()
            if edit == "R":
                state = _NEXT[state]
                put("R", name[state], text)
            elif edit == "K":
                state = _KEEP[role[:1], state]
                put("K", role, text)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
    out = []
    if key is not None:
        insert()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def repaired_turns(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """gap, conv_id, pos, edit, role, text: the turns of prepared rows after their edits, in order in each partition."""
    merged = rows.where("there").select(*_KEY, *_ORDER, F.lit(True).alias("is_row"), F.lit(0).cast("long").alias("block"),
                                        "text", F.lit(None).cast("string").alias("letters")).unionByName(
        edits.where("letters != ''").select(
            *_KEY, *(F.coalesce(c, F.lit(v)).alias(c) for c, v in zip(_ORDER, (False, 0, "", ""))),
            F.lit(False).alias("is_row"), "block", F.lit(None).cast("string").alias("text"), "letters"))
    return merged.repartition(*_KEY).sortWithinPartitions(*_KEY, *_ORDER, "is_row", "block").mapInArrow(_apply, _REPAIRED)


def _digests(batches):
    """gap, conv_id, repaired_sha256 of ordered turns; of a conversation only the digest is held."""
    def rows(told):
        return pa.RecordBatch.from_pylist([dict(zip((*_KEY, "repaired_sha256"), r)) for r in told], pa.schema(
            [("gap", pa.bool_()), ("conv_id", pa.int64()), ("repaired_sha256", pa.string())]))

    key, state = None, None
    for b in batches:
        out = []
        for gap, conv, role, text in zip(*(b.column(c).to_pylist() for c in (*_KEY, "role", "text"))):
            if key != (gap, conv):
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = (gap, conv), hashlib.sha256(f"{role}:{text}".encode())
            else:
                state.update(f"\n{role}:{text}".encode())
        yield rows(out)
    if key is not None:
        yield rows([(*key, state.hexdigest())])


def repair(rows: DataFrame, block: int = BLOCK, scratch: Scratch | None = None) -> DataFrame:
    """A row per conversation of prepared rows: what was found, the edits, their cost and the digest of the result.

    ``audit`` is one string with a letter per edit, whatever the conversation's length; ``plan_edits`` has it in blocks.
    """
    summary, edits = plan_edits(rows, block, scratch)
    audit = edits.groupBy(*_KEY).agg(F.sort_array(F.collect_list(F.struct("block", "letters"))).alias("b")).select(
        *_KEY, F.array_join("b.letters", "").alias("audit"))
    digests = repaired_turns(rows, edits).mapInArrow(_digests, "gap boolean, conv_id long, repaired_sha256 string")
    return summary.join(audit, _KEY, "left").join(digests, _KEY, "left").select(
        F.when(~F.col("gap"), F.col("conv_id")).alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal",
        "cost", F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Prepared rows of conversations with faults put in by the crc32 of ``conv_id:turn`` modulo 20."""
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", known("role").alias("role"), known("text").alias("text"),
                                fault.alias("fault"))
    rows = rows.withColumn("text", F.when(F.col("fault") == 1, "").when(
        F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))).withColumn(
        "role", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")))
    twice = rows.withColumn("copy", F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0)))))
    return prepare(twice, F.col("fault") != 0)


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What repairing each damaged conversation finds, costs and gives."""
    return repair(damaged(load(spark, sf_dir, "conversations")))
