"""Cheapest repair of damaged conversations by depth-first branch and bound.

A conversation is sound if the first letters of its roles read
``(s?(ua)+)?``: an optional system row, then user and assistant in turn. Every
row is kept (0), given the other speaker's role (1) or deleted (2); blank and
repeated rows must go, a truncated row that stays adds 5; a user or assistant
row with empty text may be inserted anywhere (5). The audit lists the edits of
the cheapest repair by their initials (D, I, K, R); ties go to the least audit
in ASCII order.

The search keeps an explicit stack. A prefix of edits is dropped if its cost
and a lower bound for the rest exceed the incumbent (cost, audit), or if the
table of its node (rows done, state) already has one at most as dear. Children
are taken in ASCII order, so prefixes reach a node in the order of their
audits and only a cheaper one opens it again. The bound relaxes the problem: a
system row may stand anywhere, and the conversation may end on any role.

Long conversations: rows are range-partitioned and cut into segments of at
most ``SEGMENT`` rows. A segment is solved for every state that it may begin
and end in; segments are then joined ``FAN`` at a time, over as many rounds as
that takes. So no task holds more than one segment's rows, or the audits of
one conversation (16 bytes a row at most).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import cut_lineage

#: fixed values: costs of the edits, and of keeping a truncated row
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: rows of a segment, and segments joined at a time
SEGMENT, FAN = 1024, 32
#: states between rows: nothing kept, system kept, after a user, after an assistant
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: kept role initials: state before -> state after
MOVES = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
SPEAKER = ("u", "u", "a", "u")  # who may follow a state
ROLE = {"u": "user", "a": "assistant"}
#: a row for the search: (kind, role initial, copies); kinds: sound, truncated, to be deleted
SOUND, CUT, GONE = "K", "T", "D"
_FAR = 1 << 60


def _relaxed(items: list[tuple]) -> list[tuple[int, int]]:
    """Cost of the rows from each place on if an assistant, or another role, is
    due, with system rows allowed anywhere and any end."""
    due_u, due_a = 0, 0
    out = [(0, 0)]
    for kind, initial, copies in reversed(items):
        if kind == GONE:
            due_u, due_a = due_u + DELETE * copies, due_a + DELETE * copies
        else:
            more = TRUNCATED if kind == CUT else 0
            stay = {"u": due_a, "a": _FAR, "s": due_u}.get(initial, _FAR)
            u = more + min(stay + KEEP, due_a + REROLE)
            a = more + min(due_u + (KEEP if initial == "a" else REROLE), _FAR)
            due_u, due_a = min(u, due_u + DELETE), min(a, due_a + DELETE)
        due_u, due_a = min(due_u, due_a + INSERT), min(due_a, due_u + INSERT)
        out.append((due_u, due_a))
    return out[::-1]


def _dive(items: list[tuple], entry: int, goals: tuple) -> tuple[int, str] | None:
    """A first incumbent: keep what fits, else rerole, delete what is at fault, fill up the end."""
    state, cost, audit = entry, 0, []
    for kind, initial, copies in items:
        if kind != SOUND:
            cost, step = cost + DELETE * copies, "D" * copies
        elif initial in MOVES[state]:
            state, step = MOVES[state][initial], "K"
        else:
            cost, state, step = cost + REROLE, MOVES[state][SPEAKER[state]], "R"
        audit.append(step)
    for _ in range(2):
        if state not in goals:
            cost, state = cost + INSERT, MOVES[state][SPEAKER[state]]
            audit.append("I")
    return (cost, "".join(audit)) if state in goals else None


def search(items: list[tuple], entry: int, goals: tuple) -> tuple[int, str] | None:
    """The cheapest (cost, audit) from state ``entry`` to one of ``goals``, ties
    to the least audit; None if no edits lead there."""
    n = len(items)
    if goals in ((EMPTY,), (SYSTEM,)):  # everything goes, but for one system row
        left = [0]
        for _, _, copies in reversed(items):
            left.append(left[-1] + copies)
        left.reverse()
        only = goals[0]
        bound = lambda i, q: DELETE * left[i] if q == only else DELETE * (left[i] - 1) if q == EMPTY else _FAR
        best = None
    else:
        rest = _relaxed(items)
        bound = lambda i, q: rest[i][q == USER]
        best = _dive(items, entry, goals)
    table: dict[tuple[int, int], int] = {}  # the least cost that a prefix reached a node with
    stack = [(0, entry, 0, "")]
    while stack:
        i, q, cost, audit = stack.pop()
        if table.get((i, q), _FAR) <= cost:
            continue
        low = cost + bound(i, q)
        if low >= _FAR or best is not None and (low, audit) > best:
            continue
        table[i, q] = cost
        if i == n and q in goals and (best is None or (cost, audit) < best):
            best = (cost, audit)
        children = []
        if i < n:
            kind, initial, copies = items[i]
            children.append((i + 1, q, cost + DELETE * copies, audit + "D" * copies))
        speaker = SPEAKER[q]
        turned = MOVES[q][speaker]
        children.append((i, turned, cost + INSERT, audit + "I"))
        if i < n and kind != GONE:
            more = TRUNCATED if kind == CUT else 0
            if initial in MOVES[q]:
                children.append((i + 1, MOVES[q][initial], cost + KEEP + more, audit + "K"))
            if initial != speaker:
                children.append((i + 1, turned, cost + REROLE + more, audit + "R"))
        stack.extend(reversed(children))  # the least letter is taken first
    return best


WHOLE = (EMPTY, ASSISTANT)
_TABLE = "conv long, seg long, whole boolean, opening string, closing string, illegal long, tables array<struct<entry:int,leave:int,cost:long,audit:string>>"
_ENTRY = pa.list_(pa.struct([("entry", pa.int32()), ("leave", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))


def _legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


def _solve_runs(batches: Iterator[pa.RecordBatch], segment: int) -> Iterator[pa.RecordBatch]:
    """One row for each run of a conversation's rows within a segment. A run
    known to be the whole conversation is solved for that; any other for all
    states that it may begin and end in."""
    out: list[tuple] = []
    run: list[tuple] = []
    key = first_is_known = None

    def close(last_is_known: bool) -> None:
        items, illegal, before = [], 0, None
        for kind, initial, copies in run:
            items.append((kind, initial, 1))
            if copies > 1:
                items.append((GONE, initial, copies - 1))
                illegal += (copies - 1) * (not _legal(initial, initial))
            if before is not None:
                illegal += not _legal(before, initial)
            before = initial
        whole = first_is_known and last_is_known
        pairs = [(EMPTY, WHOLE)] if whole else [(e, (x,)) for e in (STATES if not first_is_known else (EMPTY,)) for x in STATES]
        found = [(e, g[-1], search(items, e, g)) for e, g in pairs]
        out.append((key[0], key[1], whole, run[0][1], run[-1][1], illegal, [(e, x, *b) for e, x, b in found if b is not None]))

    def flush() -> pa.RecordBatch:
        cols = list(zip(*out))
        names = ["entry", "leave", "cost", "audit"]
        arrays = [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.bool_()), pa.array(cols[3], pa.string()),
                  pa.array(cols[4], pa.string()), pa.array(cols[5], pa.int64()), pa.array([[dict(zip(names, t)) for t in x] for x in cols[6]], _ENTRY)]
        out.clear()
        return pa.RecordBatch.from_arrays(arrays, ["conv", "seg", "whole", "opening", "closing", "illegal", "tables"])

    for batch in batches:
        cols = [batch.column(i).to_pylist() for i in range(5)]
        for conv, place, kind, initial, copies in zip(*cols):
            at = (conv, place // segment)
            if at != key:
                if run:
                    close(last_is_known=conv != key[0])
                    if len(out) >= 4096:
                        yield flush()
                # a partition's first run may go on from the one before, and its last one into the next
                first_is_known = key is not None and conv != key[0]
                key, run = at, []
            run.append((kind, initial, copies))
    if run:
        close(last_is_known=False)
    if out:
        yield flush()


def _join_segments(pdf: pd.DataFrame, fan: int) -> pd.DataFrame:
    """One table of up to ``fan`` neighbouring ones, in their order: the dominance
    table at each border keeps the cheapest, then least, audit of every state."""
    pdf = pdf.sort_values("idx")
    entries = {t["entry"] for t in pdf["tables"].iloc[0]}
    best = {(e, e): (0, "") for e in entries}
    illegal, before = 0, None
    for tables, opening, closing, n in zip(pdf["tables"], pdf["opening"], pdf["closing"], pdf["illegal"]):
        steps: dict[int, list] = {}
        for t in tables:
            steps.setdefault(t["entry"], []).append((t["leave"], t["cost"], t["audit"]))
        after: dict[tuple[int, int], tuple[int, str]] = {}
        for (e, q), (cost, audit) in best.items():
            for leave, c, a in steps.get(q, ()):
                new = (cost + c, audit + a)
                if (e, leave) not in after or new < after[e, leave]:
                    after[e, leave] = new
        best = after
        illegal += int(n) + (before is not None and not _legal(before, opening))
        before = closing
    return pd.DataFrame({"conv": [pdf["conv"].iloc[0]], "idx": [int(pdf["idx"].iloc[0]) // fan], "opening": [pdf["opening"].iloc[0]], "closing": [before],
                         "illegal": [illegal], "tables": [[{"entry": e, "leave": x, "cost": c, "audit": a} for (e, x), (c, a) in best.items()]]})


def _rows_in_order(turns: DataFrame) -> DataFrame:
    """Distinct rows with copies, fault and place, stored in the order of their
    conversations; ``place`` rises along that order over all partitions."""
    t = turns.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
                     F.coalesce(F.col("role"), F.lit(" ")).alias("role"), F.coalesce(F.col("text"), F.lit(" ")).alias("text"))
    t = t.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    bare = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    t = t.withColumn("digest", F.sha2("text", 256)).withColumn("blank", bare == "").withColumn("cut", ~F.substring(bare, -1, 1).isin(".", "!", "?"))
    at = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    # texts that a role says in several turns of a conversation: few, and the rows that hold them are spread over salts
    again = t.where("NOT blank").groupBy("conv", "role", "digest").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    again = again.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(8)])))
    t = t.withColumn("salt", F.pmod(F.xxhash64("turn"), F.lit(8)).cast("int"))
    a = again.select(*[F.col(c).alias(f"_{c}") for c in again.columns])
    same = (F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest")) & (F.col("salt") == F.col("_salt")))
    t = t.join(a, same, "left").withColumn("repeated", F.coalesce(F.col("_first") != at, F.lit(False)))
    kind = F.when(F.col("blank") | F.col("repeated"), GONE).when(F.col("cut"), CUT).otherwise(SOUND)
    t = t.select("conv", "turn", "role", "text", "copies", "blank", "repeated", kind.alias("kind"), F.substring("role", 1, 1).alias("initial"))
    n = max(t.sparkSession.sparkContext.defaultParallelism, int(t.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = ["conv", "turn", "role", "text"]
    t = t.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return cut_lineage(t.withColumn("place", F.monotonically_increasing_id()))


def _cheapest(placed: DataFrame) -> DataFrame:
    """``(conv, illegal, cost, audit)`` of every conversation."""
    segment, fan = SEGMENT, FAN
    # the stored rows keep their order, so a task meets its runs one after another
    runs = cut_lineage(placed.select("conv", "place", "kind", "initial", "copies").mapInArrow(lambda batches: _solve_runs(batches, segment), _TABLE))
    done = runs.where("whole").select("conv", "illegal", "tables")
    # one row for each SEGMENT rows of a long conversation, and for the edges of partitions
    part = runs.where("NOT whole").withColumn("idx", F.row_number().over(Window.partitionBy("conv").orderBy("seg")) - 1)
    part = cut_lineage(part.select("conv", F.col("idx").cast("long").alias("idx"), "opening", "closing", "illegal", "tables"))
    schema = T.StructType(part.schema.fields)
    while (part.agg(F.max("idx")).first()[0] or 0) > 0:
        block = part.withColumn("block", F.floor(F.col("idx") / fan))
        part = cut_lineage(block.groupBy("conv", "block").applyInPandas(lambda pdf: _join_segments(pdf, fan), schema))
    at = F.filter("tables", lambda t: (t["entry"] == EMPTY) & t["leave"].isin(EMPTY, ASSISTANT))
    best = F.array_min(F.transform(at, lambda t: F.struct(t["cost"].alias("cost"), t["audit"].alias("audit"))))
    return done.unionByName(part.select("conv", "illegal", "tables")).select("conv", "illegal", best.alias("b")).select("conv", "illegal", "b.cost", "b.audit")


def _replay(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list]]:
    """(conversation, repaired rows so far) piece by piece; a piece's last item is None at a conversation's end."""
    conv, audit, at, started = None, "", 0, False
    state, piece = EMPTY, []

    def inserts() -> None:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            who = SPEAKER[state]
            piece.append((at, "I", ROLE[who], ""))
            state, at = MOVES[state][who], at + 1

    for batch in batches:
        for c, place, role, text, copies, letters in zip(*[batch.column(i).to_pylist() for i in range(6)]):
            if place < 0:  # the head of a conversation: its audit
                if started:
                    inserts()
                    yield conv, [*piece, None]
                conv, audit, at, started, state, piece = c, letters, 0, True, EMPTY, []
                continue
            inserts()
            edit = audit[at]
            if edit == "K":
                piece.append((at, "K", role, text))
                state = MOVES[state][role[:1]]
            elif edit == "R":
                piece.append((at, "R", ROLE[SPEAKER[state]], text))
                state = MOVES[state][SPEAKER[state]]
            at += 1
            for _ in range(copies - 1):  # further copies are deleted, and what is inserted stands behind them
                at += 1
        if piece:
            yield conv, piece
            piece = []
    if started:
        inserts()
        yield conv, [*piece, None]


def _with_audits(placed: DataFrame, audits: DataFrame) -> DataFrame:
    """Every conversation's audit, then its rows in order, within one task."""
    rows = placed.select("conv", "place", "role", "text", "copies", F.lit(None).cast("string").alias("audit"))
    heads = audits.select("conv", F.lit(-1).cast("long").alias("place"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
                          F.lit(1).cast("long").alias("copies"), "audit")
    return heads.unionByName(rows).repartition("conv").sortWithinPartitions("conv", "place")


class Repair:
    """Results of ``repair_conversations``: ``summary`` (one row for each
    conversation with rows) and ``repaired_turns()`` (the rows after repair)."""

    def __init__(self, placed: DataFrame, cheapest: DataFrame):
        self._placed, self._audits = placed, cheapest
        span = F.try_add(F.try_subtract(F.max("turn"), F.min("turn")), 1 - F.count_distinct("turn"))
        span = F.when(F.max("turn").isNull(), 0).otherwise(F.coalesce(span, F.lit((1 << 63) - 1)))  # wider than a long: its largest
        stats = placed.groupBy("conv").agg(
            span.cast("long").alias("gaps"),
            F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
            F.sum(F.when(F.col("blank"), 0).when(F.col("repeated"), F.col("copies")).otherwise(F.col("copies") - 1)).alias("duplicate"),
            F.sum(F.when(F.col("kind") == CUT, 1).otherwise(0)).cast("long").alias("truncated"))
        c = cheapest.select(F.col("conv").alias("_conv"), "illegal", "cost", "audit")
        self.summary = stats.join(c, F.col("conv").eqNullSafe(F.col("_conv"))).select(
            F.col("conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    def repaired_turns(self) -> DataFrame:
        """``(conv_id, place, edit, role, text)``: kept, reroled and inserted rows; ``place`` counts the letters of the audit from 0."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for conv, piece in _replay(batches):
                rows = [r for r in piece if r is not None]
                if rows:
                    at, edit, role, text = zip(*rows)
                    yield pa.RecordBatch.from_arrays([pa.array([conv] * len(rows), pa.int64()), pa.array(at, pa.int64()), pa.array(edit), pa.array(role), pa.array(text)],
                                                     ["conv_id", "place", "edit", "role", "text"])

        return _with_audits(self._placed, self._audits).mapInArrow(run, "conv_id long, place long, edit string, role string, text string")

    def digests(self) -> DataFrame:
        """``(conv_id, repaired_sha256)``: SHA-256 of the repaired ``role:text``
        rows, joined by newlines. The digest of a conversation is one sequence,
        so its rows stream through one task, batch by batch."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            h, n, out = hashlib.sha256(), 0, []
            for conv, piece in _replay(batches):
                for row in piece:
                    if row is None:
                        out.append((conv, h.hexdigest()))
                        h, n = hashlib.sha256(), 0
                    else:
                        h.update(("\n" * (n > 0) + row[2] + ":" + row[3]).encode("utf-8", "surrogatepass"))
                        n += 1
                if len(out) >= 4096:
                    yield _digest_batch(out)
                    out = []
            if out:
                yield _digest_batch(out)

        return _with_audits(self._placed, self._audits).mapInArrow(run, "conv_id long, repaired_sha256 string")


def _digest_batch(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], pa.int64()), pa.array([d for _, d in out])], ["conv_id", "repaired_sha256"])


def repair_conversations(turns: DataFrame) -> Repair:
    """Cheapest repair of every conversation of ``turns`` (conv_id, turn, role, text).

    Rows are taken by turn, nulls first, equal turns by role and text. Each
    row's first fault counts: blank (nothing but white space), duplicate (the
    same role and text earlier in the conversation), truncated (its last other
    character is none of ``.!?``). A null role or text counts as one space, a
    null conv_id is a conversation of its own, and fully repeated rows are
    duplicates of the first. Roles other than s..., u... and a... cannot be
    kept. No rows, no conversations. Other columns are ignored.
    """
    placed = _rows_in_order(turns)
    return Repair(placed, cut_lineage(_cheapest(placed)))


def damage(turns: DataFrame) -> DataFrame:
    """Rows damaged by ``crc32("conv_id:turn") % 20`` (a null is one space):
    0 drops the row, 1 empties its text, 2 takes its ``.!?`` out, 3 repeats it,
    4 makes it the user's."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    how = F.pmod(F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")), F.lit(20))
    t = turns.select("conv_id", "turn", F.coalesce(F.col("role"), F.lit(" ")).alias("role"), F.coalesce(F.col("text"), F.lit(" ")).alias("text"), how.alias("how"))
    t = t.where("how <> 0").withColumn("_copy", F.explode(F.when(F.col("how") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    text = F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return t.select("conv_id", "turn", F.when(F.col("how") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"))


def repair_report(turns: DataFrame) -> DataFrame:
    """Damage, then repair: one row for every conversation of ``turns``, also
    those that lost all of their rows (zeros, empty audit, digest of nothing)."""
    repair = repair_conversations(damage(turns))
    every = turns.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    summary, digests = (d.withColumnRenamed("conv_id", f"_{i}") for i, d in enumerate((repair.summary, repair.digests())))
    r = every.join(summary, F.col("conv_id").eqNullSafe(F.col("_0")), "left").join(digests, F.col("conv_id").eqNullSafe(F.col("_1")), "left")
    counts = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return r.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
