"""Conversation structure repair by survivor-coalescence Viterbi.

The cheapest edits give a conversation the role initials ``(s?(ua)+)?``.  A Viterbi search
walks its rows in order with one survivor per state (nothing yet, after s, after u, after
a).  Survivors are leaves of a backpointer tree whose nodes count the survivors below them;
a branch without survivors is freed, and as soon as all survivors share an ancestor, the
edits up to it are final: they are emitted and freed.  A state dies when another undercuts it
by more than any continuation could win back.  What stays in memory is the stretch on which
survivors still differ, not the conversation.  Equal costs are told apart by the
whole unresolved edit suffixes, back to the common ancestor, so the least edit string wins.

Spark sorts the rows of a conversation (range of its own, spilling to disk); a task streams
them once.  Duplicates are found before that by aggregation and a join, so no task keeps a
conversation's texts.  The order inside a conversation makes it one stream: its digest is a
sequential hash, which no split of the rows could share out.

Defined cases: null roles and texts count as one space; a null conversation id is a
conversation of its own; null turns come first; rows of one turn are ordered by (role,
text), so equal rows are neighbours and the result does not depend on the input's order.
Rows of unknown or empty
roles cannot be kept: they are deleted or get a role.  Gaps beyond a long read as the largest
long.  Other columns stay out; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare

#: Costs of the edits, and the extra one of a kept truncated row.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLANK, DUPLICATE, CUT_OFF = "blank", "duplicate", "truncated"
# States: nothing yet, after s, after u, after a; the role that may follow each, and where it leads.
NOTHING, AFTER_S, AFTER_U, AFTER_A = range(4)
NEXT_ROLE = ("user", "user", "assistant", "user")
NEXT_STATE = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
# FOLLOWS[i][j]: most it costs from state i to end as any continuation of state j does
# (insert what is missing; delete an s that only j may still keep).
_PAIR = 2 * INSERT
FOLLOWS = ((0, 0, INSERT, 0), (_PAIR, 0, INSERT, _PAIR), (INSERT + DELETE, INSERT, 0, INSERT),
           (DELETE, 0, INSERT, 0))
SPACE = " \t\n\x0b\x0c\r"

EDITS = ("{key} {kind}, step bigint, edit string, turn bigint, old_role string, role string, text string, "
         "fault string, cost bigint")


class _Node:
    """A survivor's last step: its edit initials, the row they used, and the steps below."""
    __slots__ = ("kids", "ops", "parent", "row", "state")

    def __init__(self, parent: _Node | None, ops: str, row, state: int):
        self.parent, self.ops, self.row, self.state, self.kids = parent, ops, row, state, []


def _ahead(a: _Node, a_ops: str, b: _Node, b_ops: str) -> bool:
    """Whether edits a + a_ops come before b + b_ops.  Both stand at the same row, and each
    step but a last one ends in a letter that uses up a row, so the oldest difference decides."""
    first = (a_ops, b_ops)
    while a is not b:
        if a.ops != b.ops:
            first = (a.ops, b.ops)
        a, b = a.parent, b.parent
    return first[0] < first[1]


class Survivors:
    """The search over one conversation: ``feed`` its rows in order, then ``finish``.

    Both yield final edits (initial, row or None, new role or None) in order."""

    def __init__(self) -> None:
        self.base = _Node(None, "", None, NOTHING)
        self.alive: dict[int, tuple[int, _Node]] = {NOTHING: (0, self.base)}
        self.held = 0
        self.most_held = 0

    def _offer(self, best: dict, end: int, cost: int, node: _Node, ops: str) -> None:
        old = best.get(end)
        if old is None or cost < old[0] or (cost == old[0] and _ahead(node, ops, old[1], old[2])):
            best[end] = (cost, node, ops)

    def feed(self, row: tuple) -> Iterator[tuple[str, tuple | None, str | None]]:
        """``row``: (turn, role, text, fault)."""
        initial, fault = row[1][:1], row[3]
        extra = TRUNCATED if fault == CUT_OFF else 0
        best: dict[int, tuple[int, _Node, str]] = {}
        for state, (cost, node) in self.alive.items():
            # An insertion before a deleted row is never least: after it, it reads "DI".
            self._offer(best, state, cost + DELETE, node, "D")
            if fault in (BLANK, DUPLICATE):
                continue
            at, ops, price = state, "", cost + extra
            for _ in range(3):  # more insertions come back to the same states
                if initial == "s":
                    end = AFTER_S if at == NOTHING else None
                else:
                    end = NEXT_STATE[at] if initial == NEXT_ROLE[at][0] else None
                if end is not None:
                    self._offer(best, end, price, node, ops + "K")
                self._offer(best, NEXT_STATE[at], price + REROLE, node, ops + "R")
                at, ops, price = NEXT_STATE[at], ops + "I", price + INSERT
        return self._advance(best, row)

    def finish(self) -> Iterator[tuple[str, tuple | None, str | None]]:
        best: dict[int, tuple[int, _Node, str]] = {}
        for state, (cost, node) in self.alive.items():
            at, ops, price = state, "", cost
            for _ in range(3):
                if at in (NOTHING, AFTER_A):
                    self._offer(best, 0, price, node, ops)
                at, ops, price = NEXT_STATE[at], ops + "I", price + INSERT
        # Only the accepted ending survives, so all of it is final.
        return self._advance(best, None)

    def _advance(self, best: dict, row: tuple | None) -> Iterator[tuple]:
        if len(best) > 1:  # a state that another one undercuts whatever follows is no survivor
            best = {j: b for j, b in best.items()
                    if not any(c + FOLLOWS[i][j] < b[0] for i, (c, _, _) in best.items())}
        before = [node for _, node in self.alive.values()]
        self.alive = {}
        for end, (cost, node, ops) in best.items():
            leaf = _Node(node, ops, row, end)
            node.kids.append(leaf)
            self.alive[end] = (cost, leaf)
        self.held += len(best)
        for node in before:  # counts that fall to nothing free their branch
            while not node.kids and node is not self.base:
                parent = node.parent
                parent.kids.remove(node)
                self.held -= 1
                node = parent
        self.most_held = max(self.most_held, self.held)
        while len(self.base.kids) == 1:
            child = self.base.kids[0]
            yield from self._edits(self.base.state, child)
            child.parent, self.base = None, child
            self.held -= 1

    @staticmethod
    def _edits(at: int, node: _Node) -> Iterator[tuple]:
        for op in node.ops:
            if op == "I":
                yield op, None, NEXT_ROLE[at]
                at = NEXT_STATE[at]
            elif op == "R":
                yield op, node.row, NEXT_ROLE[at]
            else:
                yield op, node.row, node.row[1] if op == "K" else None


def _edit_cost(op: str, row: tuple | None) -> int:
    if op == "D":
        return DELETE
    return {"I": INSERT, "R": REROLE, "K": 0}[op] + (TRUNCATED if row and row[3] == CUT_OFF else 0)


def _last(text: Column) -> Column:
    """Last character that is no white space ('' without one)."""
    return F.right(F.rtrim(text, F.lit(SPACE)), F.lit(1))


def with_faults(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text, fault, earlier): each row's first fault but duplicates inside
    one turn, which only the sorted rows show; ``earlier``: seen in an earlier turn."""
    r = rows.select(rows[conv_col].alias("conv"), rows[turn_col].cast("bigint").alias("turn"),
                    F.coalesce(rows[role_col].cast("string"), F.lit(" ")).alias("role"),
                    F.coalesce(rows[text_col].cast("string"), F.lit(" ")).alias("text"))
    conv = F.coalesce(F.concat(F.lit("c"), F.col("conv").cast("string")), F.lit("n"))
    r = r.withColumn("key", F.unhex(F.sha2(F.concat_ws(
        "\x00", F.length(conv).cast("string"), conv, F.length("role").cast("string"), "role", "text"), 256)))
    # A null turn is before every other.
    seen = (r.groupBy("key").agg(F.min("turn").alias("first"), F.count("turn").alias("n_turns"),
                                 F.count(F.lit(1)).alias("n"))
            .where("n > 1").select(F.col("key").alias("s_key"), "first", (F.col("n") > F.col("n_turns")).alias("null_turn")))
    # Sort-merge, so that a text that fills a conversation is cut up as a skewed partition.
    r = r.join(seen.hint("merge"), r.key == seen.s_key, "left")
    earlier = F.coalesce(F.col("turn").isNotNull() & (F.col("null_turn") | (F.col("turn") > F.col("first"))), F.lit(False))
    last = _last(F.col("text"))
    fault = (F.when(last == "", F.lit(BLANK)).when(earlier, F.lit(DUPLICATE))
             .when(~last.isin(".", "!", "?"), F.lit(CUT_OFF)))
    return r.select("conv", "turn", "role", "text", fault.alias("fault"))


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """The cheapest edits of every conversation, one row an edit.

    (conv, step, edit K/R/D/I, turn, old_role, role, text, fault, cost): ``role`` and ``text``
    of the repaired row (null where it is deleted), turn and old_role null where one is
    inserted; step counts a conversation's edits from 0.  The rows of a conversation are
    neighbours inside one partition, in order."""
    prepare(rows.sparkSession)
    faults = with_faults(rows, conv_col, turn_col, role_col, text_col)
    kind = faults.schema["conv"].dataType.simpleString()
    ordered = (faults.repartition("conv")
               .sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text"))
    return ordered.mapInArrow(_edits_of_batches, EDITS.format(key="conv", kind=kind))


def _edits_of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, search, previous, step, out, kind = None, None, None, 0, [], None
    names = ["conv", "step", "edit", "turn", "old_role", "role", "text", "fault", "cost"]

    def note(edits):
        nonlocal step
        for op, row, role in edits:
            turn, old, text, fault = row if row else (None, None, "", None)
            out.append((conv, step, op, turn, old, role, text if role is not None else None, fault, _edit_cost(op, row)))
            step += 1

    def batch():
        columns = list(zip(*out, strict=True)) if out else [[] for _ in names]
        types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64()]
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    for b in batches:
        kind = b.schema.field("conv").type
        for c, *row in zip(*(b.column(k).to_pylist() for k in ("conv", "turn", "role", "text", "fault")), strict=True):
            if search is None or c != conv:
                if search is not None:
                    note(search.finish())
                conv, search, previous, step = c, Survivors(), None, 0
            turn, role, text, fault = row
            if fault != BLANK and previous == (turn, role, text):
                fault = DUPLICATE
            previous = (turn, role, text)
            note(search.feed((turn, role, "" if fault in (BLANK, DUPLICATE) else text, fault)))
        if out:
            yield batch()
    if search is not None:
        note(search.finish())
        if out:
            yield batch()


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of the contract's damage, by crc32 of ``conv_id:turn``."""
    c = conversations
    one = F.lit(" ")
    key = F.concat(F.coalesce(c["conv_id"].cast("string"), one), F.lit(":"), F.coalesce(c["turn"].cast("string"), one))
    act = F.col("act")
    rows = c.select(c["conv_id"].alias("conv_id"), c["turn"].cast("bigint").alias("turn"),
                    F.coalesce(c["role"].cast("string"), one).alias("role"),
                    F.coalesce(c["text"].cast("string"), one).alias("text"),
                    (F.crc32(key.cast("binary")) % 20).alias("act")).where("act <> 0")
    text = F.when(act == 1, F.lit("")).when(act == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(act == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", F.when(act == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                       text.alias("text"), copies.alias("copy")).drop("copy")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a conversation from its edits, in order, without holding its texts."""
    conv, now, out, kind = None, None, [], None
    names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    legal = {"su", "ua", "au"}

    def close():
        gaps = min(now["high"] - now["low"] + 1 - now["turns"], (1 << 63) - 1) if now["turns"] else 0
        out.append((conv, gaps, now[BLANK], now[DUPLICATE], now[CUT_OFF], now["illegal"], now["cost"],
                    "".join(now["audit"]), now["sha"].hexdigest()))

    def batch():
        columns = list(zip(*out, strict=True))
        types = [kind] + [pa.int64()] * 6 + [pa.string()] * 2
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    for b in batches:
        kind = b.schema.field("conv").type
        for c, edit, turn, old, role, text, fault, cost in zip(*(b.column(k).to_pylist() for k in (
                "conv", "edit", "turn", "old_role", "role", "text", "fault", "cost")), strict=True):
            if now is None or c != conv:
                if now is not None:
                    close()
                conv = c
                now = {"low": None, "high": None, "turns": 0, BLANK: 0, DUPLICATE: 0, CUT_OFF: 0, "illegal": 0,
                       "cost": 0, "audit": [], "sha": hashlib.sha256(), "initial": None, "lines": 0}
            if edit != "I":
                if turn is not None and turn != now["high"]:  # turns rise
                    now["low"] = turn if now["low"] is None else now["low"]
                    now["high"], now["turns"] = turn, now["turns"] + 1
                if fault:
                    now[fault] += 1
                if now["initial"] is not None and now["initial"] + old[:1] not in legal:
                    now["illegal"] += 1
                now["initial"] = old[:1]
            now["cost"] += cost
            now["audit"].append(edit)
            if role is not None:
                line = f"{role}:{text}".encode()
                now["sha"].update(b"\n" + line if now["lines"] else line)
                now["lines"] += 1
        if out:
            yield batch()
    if now is not None:
        close()
        yield batch()


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation damaged by rule and repaired: faults, cost, edits and digest."""
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    edits = repair(damaged(conversations))
    kind = edits.schema["conv"].dataType.simpleString()
    counts = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"
    # The partitions of the edits hold whole conversations, in order: no further exchange.
    found = edits.mapInArrow(_digests, f"conv {kind}, {counts}, audit string, repaired_sha256 string")
    every = conversations.select("conv_id").distinct()
    joined = every.join(found, every.conv_id.eqNullSafe(found.conv), "left")
    empty = hashlib.sha256(b"").hexdigest()
    return joined.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
                     for c in ("gaps", BLANK, DUPLICATE, CUT_OFF, "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
