"""Repair of the turn structure of logged conversations, at least cost, by Hirschberg's method.

A conversation is fine if the initials of its roles read ``(s?(ua)+)?``. Rows may be kept, given
another role, deleted, or put in empty; the cheapest edits win, and of equally cheap ones those
whose initials (the audit) come first in ASCII order.

The grammar has four states. Per row, or run of rows, a 4 x 4 table holds the least cost of
getting from one state to another, and the order of the least audits from each state. A forward
vector (cost and order of audits, from the start) meets a backward vector (cost to the end) in
the middle; of the cheapest crossings the one of least audit is taken, and both halves follow.
An audit's next edit fixes the next state, so audits up to one row are never beginnings of each
other, and the order of whole audits is the order of their first differing halves.

Rows are cut into blocks of ``ROWS`` rows or ``BYTES`` bytes. The method runs over the tables of a
conversation's blocks first, then inside each block, so no task holds a conversation: blocks of
one conversation lie in many tasks, only their tables and finished pieces meet in one.

Cases: a null role or text counts as one space; conversations without id are one conversation.
Rows of one turn are ordered by role, then by SHA-256 of the text; rows without a turn come first.
A role's initial is its first character. Repeated rows are counted before they are moved and are
duplicates of the first. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlake.session import stage

ROWS, BYTES = 4096, 4 << 20
#: Costs of the contract: another role, a deletion, an insertion, a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
INF = float("inf")
#: Nothing yet; after system, user, assistant.
EMPTY, SYSTEM, USER, ASSISTANT = STATES = range(4)
NEXT = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Insertions after the last row.
END = (0, 2 * INSERT, INSERT, 0)
INITIALS = "sua"
LEGAL = ("su", "ua", "au")
SPACES = " \t\n\x0b\f\r"

Vector = tuple[tuple, tuple]  # cost by state, order of the least audits by state


def kind(initial: str, gone: bool, truncated: bool) -> int:
    """A row's code: 0 must be deleted; else its role (other ones: 3) and whether it is truncated."""
    place = INITIALS.find(initial) if initial else -1
    return 0 if gone else 1 + 2 * (place if place >= 0 else 3) + truncated


@functools.cache
def moves(code: int) -> dict[int, dict[int, tuple[int, str]]]:
    """By state before and after the row: least cost, and the least edits of that cost."""
    table: dict[int, dict[int, tuple[int, str]]] = {p: {} for p in STATES}
    role, truncated = divmod(code - 1, 2)
    for p in STATES:
        at = p
        for inserts in range(4):
            paid, said = INSERT * inserts, "I" * inserts
            found = [(at, DELETE, "D")]
            if code:
                late = TRUNCATED * truncated
                found.append((NEXT[at], REROLE + late, "R"))
                if role < 3 and (SYSTEM + role == NEXT[at] or (role == 0 and at == EMPTY)):
                    found.append((SYSTEM + role, late, "K"))
            for q, cost, letter in found:
                table[p][q] = min(table[p].get(q, (INF, "")), (paid + cost, said + letter))
            at = NEXT[at]
    return table


@functools.cache
def row_table(code: int) -> tuple[tuple, tuple]:
    found = moves(code)
    cost = tuple(tuple(found[p].get(q, (INF, ""))[0] for q in STATES) for p in STATES)
    order = tuple(tuple(sorted(found[p], key=lambda s: found[p][s][1]).index(q) if q in found[p] else 9 for q in STATES) for p in STATES)
    return cost, order


def point(state: int) -> Vector:
    return tuple(0 if q == state else INF for q in STATES), (0, 0, 0, 0)


def forth(vector: Vector, table: tuple) -> Vector:
    """The vector after a row, or a run of rows."""
    (cost, rank), (paid, order) = vector, table
    came = []
    for q in STATES:
        p = min(STATES, key=lambda s: (cost[s] + paid[s][q], rank[s]))
        came.append((cost[p] + paid[p][q], rank[p], order[p][q]))
    places = sorted(c[1:] for c in came if c[0] < INF)
    return tuple(c[0] for c in came), tuple(places.index(c[1:]) if c[0] < INF else 9 for c in came)


def back(cost: tuple, table: tuple) -> tuple:
    paid = table[0]
    return tuple(min(paid[p][q] + cost[q] for q in STATES) for p in STATES)


@functools.lru_cache(100_000)
def row_forth(vector: Vector, code: int) -> tuple[int, Vector]:
    cost, rank = forth(vector, row_table(code))
    least = min(cost)
    return least, (tuple(c - least for c in cost), rank)


@functools.lru_cache(100_000)
def row_back(cost: tuple, code: int) -> tuple:
    cost = back(cost, row_table(code))
    least = min(cost)
    return tuple(c - least for c in cost)


def crossings(items, start: int, end: tuple, ahead: Callable, behind: Callable) -> list[int]:
    """The state after each item on the least path from ``start``; ``end``: cost to finish, by state."""
    states = [start] * len(items)
    todo = [(0, len(items), start, end)] if len(items) else []
    while todo:
        lo, hi, first, last = todo.pop()
        middle = max(lo + 1, (lo + hi) // 2)
        vector = point(first)
        for i in range(lo, middle):
            vector = ahead(vector, items[i])
        for i in range(hi - 1, middle - 1, -1):
            last = behind(last, items[i])
        cost, rank = vector
        q = states[middle - 1] = min(STATES, key=lambda s: (cost[s] + last[s], rank[s]))
        if middle - lo > 1:
            todo.append((lo, middle, first, point(q)[0]))
        if hi > middle:
            # ``last`` has moved to the middle; the right half starts from the end again.
            todo.append((middle, hi, q, end if hi == len(items) else point(states[hi - 1])[0]))
    return states


def inside(codes: bytes, start: int, end: tuple) -> list[int]:
    return crossings(codes, start, end, lambda v, c: row_forth(v, c)[1], row_back)


def run_table(codes: bytes) -> tuple[tuple, tuple]:
    """Costs and orders over a run of rows, from each state; of no rows, all stay where they are."""
    cost, order = [], []
    for p in STATES:
        vector, total = point(p), 0
        for code in codes:
            least, vector = row_forth(vector, code)
            total += least
        cost.append(tuple(c + total for c in vector[0]))
        order.append(vector[1])
    return tuple(cost), tuple(order)


# --- damage and faults ------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """The rows after the contract's damage, with ``n`` copies each (0: dropped)."""
    text_of = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    mark = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    text, role = text_of("text"), text_of("role")
    return rows.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("key"),
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(mark == 4, "user").otherwise(role).alias("role"),
        F.when(mark == 1, "").when(mark == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(mark == 0, 0).when(mark == 3, 2).otherwise(1).alias("n"),
    ).withColumn("digest", F.unhex(F.sha2("text", 256)))


def lines(rows: DataFrame) -> DataFrame:
    """One row per (conversation, turn, role, text) without the text, and whether an earlier turn said it."""
    shown = F.rtrim(F.col("text"), F.lit(SPACES))
    counted = stage(
        rows.withColumn("bytes", F.octet_length("text")).groupBy("key", "turn", "role", "digest").agg(
            F.max("conv_id").alias("conv_id"),
            F.sum("n").alias("n"),
            F.max("bytes").alias("bytes"),
            F.max(shown == "").alias("blank"),
            F.max(~F.right(shown, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
        ),
        "repair-lines",
    )
    place = F.struct(F.col("turn").isNotNull(), "turn")
    seen = counted.filter("n > 0").groupBy("key", "role", "digest").agg(F.min(place).alias("first"), F.count("*").alias("turns"))
    found = counted.join(seen.filter("turns > 1").drop("turns"), ["key", "role", "digest"], "left")
    return found.withColumn("again", F.col("first").isNotNull() & (F.col("first") != place)).drop("first")


# --- blocks -----------------------------------------------------------------

LINE = "at int, turn long, role string, digest binary"
TABLE = "cost array<double>, order array<int>"
SUMS = "blank long, duplicate long, truncated long, illegal long, turns long"
ENDS = "first_role string, last_role string, first_turn long, last_turn long"


class Block:
    def __init__(self):
        self.codes, self.kept, self.bytes = bytearray(), [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_role = self.last_role = self.first_turn = self.last_turn = None

    def add(self, row: dict, copy: bool) -> None:
        """Takes a row; ``copy``: another one of the row just taken."""
        initial = row["role"][:1]
        blank = row["blank"]
        duplicate = not blank and (copy or row["again"])
        truncated = not blank and not duplicate and row["truncated"]
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        if self.last_role is None:
            self.first_role = initial
        else:
            self.illegal += self.last_role + initial not in LEGAL
        self.last_role = initial
        if row["turn"] is not None:
            if self.first_turn is None:
                self.first_turn = row["turn"]
            self.turns += self.last_turn != row["turn"]
            self.last_turn = row["turn"]
        if not (blank or duplicate):
            self.kept.append({"at": len(self.codes), "turn": row["turn"], "role": row["role"], "digest": row["digest"]})
            self.bytes += row["bytes"]
        self.codes.append(kind(initial, blank or duplicate, truncated))

    def row(self) -> dict:
        cost, order = run_table(bytes(self.codes))
        names = [n.split()[0] for n in f"{SUMS}, {ENDS}".split(", ")]
        return {
            "codes": bytes(self.codes), "kept": self.kept, "cost": [c for r in cost for c in r],
            "order": [c for r in order for c in r], **{n: getattr(self, n) for n in names},
        }


def to_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def in_batches(rows: Iterable[dict], schema: pa.Schema, weight: Callable[[dict], int], limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weight(row)
        if size >= limit:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def mapped(df: DataFrame, run: Callable[[Iterator[dict]], Iterator[dict]], schema, weight: Callable[[dict], int]) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return df.mapInArrow(lambda batches: in_batches(run(to_rows(batches)), arrow, weight), schema)


def schema_of(df: DataFrame, fields: str):
    """``fields`` with conv_id as ``df`` has it."""
    return df.select("conv_id").limit(0).sparkSession.createDataFrame([], f"conv_id {df.schema['conv_id'].dataType.simpleString()}, {fields}").schema


def cut(lined: DataFrame, rows: int = ROWS, size: int = BYTES) -> DataFrame:
    """The blocks of all conversations; ``part`` and ``block`` give their order."""

    def run(found: Iterator[dict]) -> Iterator[dict]:
        part = TaskContext.get().partitionId()
        for (key, conv), mine in groupby(found, key=lambda r: (r["key"], r["conv_id"])):
            block, number = Block(), 0
            for row in mine:
                for copy in range(row["n"]):
                    if len(block.codes) >= rows or block.bytes >= size:
                        yield {"key": key, "conv_id": conv, "part": part, "block": number, **block.row()}
                        block, number = Block(), number + 1
                    block.add(row, copy > 0)
            yield {"key": key, "conv_id": conv, "part": part, "block": number, **block.row()}

    order = ["key", "turn", "role", "digest"]
    dealt = lined.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = schema_of(lined, f"key string, part int, block int, codes binary, kept array<struct<{LINE.replace(' ', ':').replace(',:', ',')}>>, {TABLE}, {SUMS}, {ENDS}")
    return mapped(dealt, run, schema, lambda r: 600 + 80 * len(r["kept"]) + len(r["codes"]))


def by_conversation(df: DataFrame) -> DataFrame:
    return df.repartition("key").sortWithinPartitions("key", "part", "block")


def between_blocks(blocks: DataFrame) -> DataFrame:
    """Per block the states before and after it, and how many rows are inserted after it; the
    conversation's cost and its counts across blocks stand at its first block."""

    def run(found: Iterator[dict]) -> Iterator[dict]:
        for key, mine in groupby(found, key=lambda r: r["key"]):
            mine = list(mine)
            tables = []
            illegal = turns = 0
            role = first = last = None
            for b in mine:
                cost, order = b["cost"], b["order"]
                tables.append((tuple(tuple(cost[i : i + 4]) for i in range(0, 16, 4)), tuple(tuple(order[i : i + 4]) for i in range(0, 16, 4))))
                if b["first_role"] is not None:
                    illegal += role is not None and role + b["first_role"] not in LEGAL
                    role = b["last_role"]
                if b["first_turn"] is not None:
                    turns -= last == b["first_turn"]
                    first, last = b["first_turn"] if first is None else first, b["last_turn"]
                illegal += b["illegal"]
                turns += b["turns"]
            states = crossings(tables, EMPTY, END, forth, back)
            cost = END[states[-1]] + sum(t[0][p][q] for t, p, q in zip(tables, [EMPTY, *states], states))
            for i, b in enumerate(mine):
                yield {
                    "key": key, "part": b["part"], "block": b["block"], "before": states[i - 1] if i else EMPTY, "after": states[i],
                    "tail": END[states[i]] // INSERT if i == len(mine) - 1 else 0, "all_cost": 0 if i else int(cost),
                    "all_illegal": 0 if i else illegal, "gaps": 0 if i or first is None else last - first + 1 - turns,
                }

    light = by_conversation(blocks.drop("codes", "kept"))
    schema = "key string, part int, block int, before int, after int, tail int, all_cost long, all_illegal long, gaps long"
    return mapped(light, run, blocks.sparkSession.createDataFrame([], schema).schema, lambda r: 100)


def edits(blocks: DataFrame, crossed: DataFrame) -> DataFrame:
    """Per block its audit, and its lines after the repair: the old row (none: inserted) and the new role."""

    def run(found: Iterator[dict]) -> Iterator[dict]:
        for b in found:
            state, said, lines = b["before"], [], []
            kept = {k["at"]: k for k in b["kept"]}
            for i, q in enumerate(inside(b["codes"], state, point(b["after"])[0])):
                letters = moves(b["codes"][i])[state][q][1]
                said.append(letters)
                for letter in letters:
                    if letter == "D":
                        continue
                    state = q if letter == "K" else NEXT[state]
                    old = kept[i] if letter != "I" else {"turn": None, "role": None, "digest": None}
                    role = old["role"] if letter == "K" else NAMES[state]
                    lines.append({"at": len(lines), "turn": old["turn"], "role": old["role"], "digest": old["digest"], "new_role": role})
                state = q
            for _ in range(b["tail"]):
                state = NEXT[state]
                lines.append({"at": len(lines), "turn": None, "role": None, "digest": None, "new_role": NAMES[state]})
            said.append("I" * b["tail"])
            kept_columns = {n: b[n] for n in ("key", "conv_id", "part", "block", "blank", "duplicate", "truncated", "all_cost", "all_illegal", "gaps")}
            yield {**kept_columns, "audit": "".join(said), "lines": lines}

    met = blocks.drop("cost", "order", "illegal", "turns", *[n.split()[0] for n in ENDS.split(", ")]).join(crossed, ["key", "part", "block"])
    line = LINE.replace(" ", ":").replace(",:", ",")
    sums = "blank long, duplicate long, truncated long, all_cost long, all_illegal long, gaps long"
    schema = schema_of(blocks, f"key string, part int, block int, {sums}, audit string, lines array<struct<{line},new_role:string>>")
    return mapped(met, run, schema, lambda r: 200 + len(r["audit"]) + 90 * len(r["lines"]))


# --- texts ------------------------------------------------------------------


def pieces(edited: DataFrame, rows: DataFrame) -> DataFrame:
    """``edited`` with the repaired text of each block (null: none of its lines is left)."""
    place = F.coalesce(F.col("turn").cast("string"), F.lit("")).alias("place")
    texts = rows.filter("n > 0").select("key", place, "role", "digest", "text").groupBy("key", "place", "role", "digest").agg(F.first("text").alias("text"))
    line = edited.select("key", "part", "block", F.explode("lines").alias("line")).select("key", "part", "block", "line.*").withColumn("place", place)
    old = line.filter("digest is not null").join(texts, ["key", "place", "role", "digest"])
    new = line.filter("digest is null").withColumn("text", F.lit(""))
    names = ["key", "part", "block", "at", "new_role", "text"]
    said = F.struct("at", F.concat("new_role", F.lit(":"), "text").alias("line"))
    # A block bounds what is collected: ROWS rows and as many insertions, BYTES bytes or one text more.
    whole = old.select(*names).unionByName(new.select(*names)).groupBy("key", "part", "block").agg(F.array_sort(F.collect_list(said)).alias("said"))
    whole = whole.select("key", "part", "block", F.array_join("said.line", "\n").alias("piece"))
    return edited.drop("lines").join(whole, ["key", "part", "block"], "left")


def repaired(conversations: DataFrame, rows: int = ROWS, size: int = BYTES) -> DataFrame:
    """Per conversation: its faults, the cost and audit of the repair, and the repaired text's SHA-256."""
    broken = damaged(conversations)
    blocks = stage(cut(lines(broken), rows, size), "repair-blocks")
    edited = stage(edits(blocks, between_blocks(blocks)), "repair-edits")

    def run(found: Iterator[dict]) -> Iterator[dict]:
        for _, mine in groupby(found, key=lambda r: r["key"]):
            text, any_line, audit = hashlib.sha256(), False, []
            sums = dict.fromkeys(("blank", "duplicate", "truncated", "all_cost", "all_illegal", "gaps"), 0)
            for b in mine:
                audit.append(b["audit"])
                for name in sums:
                    sums[name] += b[name]
                if b["piece"] is not None:
                    text.update(b"\n" * any_line + b["piece"].encode())
                    any_line = True
                conv = b["conv_id"]
            yield {
                "conv_id": conv, **{n: sums[n] for n in ("gaps", "blank", "duplicate", "truncated")}, "illegal": sums["all_illegal"],
                "cost": sums["all_cost"], "audit": "".join(audit), "repaired_sha256": text.hexdigest(),
            }

    schema = schema_of(conversations, "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
    return mapped(by_conversation(pieces(edited, broken)), run, schema, lambda r: 200 + len(r["audit"]))
