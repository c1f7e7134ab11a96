"""Conversation structure repair by a square-root checkpointed DP.

The cheapest edits turn the roles of a conversation into ``(s?(ua)+)?`` (an
optional system turn, then user and assistant in turn). Costs: Keep 0, Rerole
to user or assistant 2, Delete 3 (required for blank and repeated rows), Insert
an empty user or assistant turn 2; a truncated row that stays adds 1. Among the
cheapest edits those whose initials are least in ASCII are taken.

A conversation's rows are cut into blocks of about the square root of their
number. Four numbers per block border, the least cost to the end from each
state of the role grammar, are the checkpoints: a block's own 4 x 4 transfer
costs give them from the last block backwards. Walking forward, a block's inner
cost vectors are recomputed from the checkpoint at its end, and every state it
may be entered in gets its tight edits; folding the blocks' exits tells which.
So no task holds more than a block or a conversation's borders, both of about
the square root of its rows, however long the conversation is; equal rows are
one row with a count before anything is dealt. Only the last pass, which hashes
the repaired text in order, reads a conversation in one task, as a stream.
"""

from __future__ import annotations

import hashlib
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from celltally.llm.common import land, ship

#: Rows of a block, at least.
LEAST_BLOCK = 16
#: Conversations of a batch of results.
OUT_ROWS = 500
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
INF = np.int64(1) << 60
#: States: nothing yet, after a system, a user, an assistant turn. Symbols: s, u, a, any other initial.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = np.array([[SYSTEM, USER, -1, -1], [-1, USER, -1, -1], [-1, -1, ASSISTANT, -1], [-1, USER, -1, -1]])
#: Where a user or assistant turn leads; in each state one of the two is allowed.
FORCED = np.array([USER, USER, ASSISTANT, USER])
#: Least cost of turns inserted after the last row.
CLOSING = np.array([0, 2 * INSERT_COST, INSERT_COST, 0], np.int64)
N_CLOSING = CLOSING // INSERT_COST
ROLE = {USER: "user", ASSISTANT: "assistant"}
FINE, TRUNCATED, DUPLICATE, BLANK = range(4)
DELETE, KEEP, REROLE = range(3)
LETTERS = "DKR"
GAP = r"\x20\x09-\x0D"


def spaced(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damage(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text, n): the rows damaged by crc32(``conv_id:turn``) % 20.

    0 drops a row, 1 empties its text, 2 removes its ``[.!?]``, 3 doubles it,
    4 sets its role to user. A null key, role or text is one space; ``conv`` is
    conv_id as text; equal rows are one row with their number ``n``.
    """
    code = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    text = F.when(code == 1, "").when(code == 2, F.regexp_replace(spaced("text"), "[.!?]", "")).otherwise(spaced("text"))
    return gathered(rows.where(code != 0).select(
        spaced("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), F.when(code == 4, "user").otherwise(spaced("role")).alias("role"),
        text.alias("text"), F.when(code == 3, 2).otherwise(1).alias("n")))


def gathered(rows: DataFrame) -> DataFrame:
    return rows.groupBy("conv", "turn", "role", "text").agg(F.sum("n").cast("long").alias("n"))


def placed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``pos``, a row's place in its conversation by turn (nulls
    first), role and text, and ``n_rows``, how many distinct rows that has.

    Rows are dealt by range of conversation and turn, so a long conversation
    is many tasks' work; places come from the ranges' row counts.
    """
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    dealt = rows.repartitionByRange(F.col("conv"), F.col("turn").asc_nulls_first(), F.substring("role", 1, 64), F.substring("text", 1, 64))
    dealt = dealt.sortWithinPartitions(*order).select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("i"))
    dealt = land(dealt.withColumn("digest", F.sha2("text", 256)), "repair-rows")
    runs = dealt.groupBy("conv", "part").agg(F.min("i").alias("first"), F.count("*").alias("rows"))
    upto = Window.partitionBy("conv").orderBy("part")  # a row per range of rows that a conversation touches
    runs = runs.select("conv", "part", "first", (F.sum("rows").over(upto) - F.col("rows")).alias("before"),
                       F.sum("rows").over(Window.partitionBy("conv")).alias("n_rows"))
    return dealt.join(runs, ["conv", "part"]).withColumn("pos", F.col("before") + F.col("i") - F.col("first")).drop("part", "i", "first", "before")


def faulted(rows: DataFrame) -> DataFrame:
    """``rows`` with their first fault: blank, duplicate (role and text seen
    earlier in the conversation) or truncated; and the symbol of their role."""
    at = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    firsts = rows.groupBy("conv", "role", "digest").agg(F.min(at).alias("seen"))
    blank, ended = ~F.col("text").rlike(f"[^{GAP}]"), F.col("text").rlike(rf"[.!?][{GAP}]*\z")
    fault = F.when(blank, BLANK).when(~at.eqNullSafe(F.col("seen")), DUPLICATE).when(~ended, TRUNCATED).otherwise(FINE)
    symbol = F.when(F.startswith("role", F.lit("s")), 0).when(F.startswith("role", F.lit("u")), 1).when(F.startswith("role", F.lit("a")), 2).otherwise(3)
    return rows.join(firsts, ["conv", "role", "digest"]).withColumn("fault", fault).withColumn("symbol", symbol).drop("seen", "digest")


# ------------------------------------------------------------------- blocks

def before(after: np.ndarray, symbol: np.ndarray, fault: np.ndarray, extra: np.ndarray) -> np.ndarray:
    """Least costs before a row (blocks x states x columns) from those after it."""
    after = after + DELETE_COST * extra[:, None, None]
    stay = np.where(fault >= DUPLICATE, INF, TRUNCATED_COST * (fault == TRUNCATED))[:, None, None]
    to = NEXT[:, symbol].T
    kept = np.where((to >= 0)[:, :, None], np.take_along_axis(after, np.maximum(to, 0)[:, :, None], 1), INF) + stay
    best = np.minimum(np.minimum(after + DELETE_COST, kept), after[:, FORCED] + REROLE_COST + stay)
    inserted = np.minimum(best[:, FORCED] + INSERT_COST, best[:, FORCED[FORCED]] + 2 * INSERT_COST)
    return np.minimum(np.minimum(best, inserted), INF)


class Blocks:
    """The blocks of an Arrow batch side by side, shorter ones padded."""

    def __init__(self, batch: pa.RecordBatch):
        items = batch.column("items")
        offs = items.offsets.to_numpy()
        flat = items.values[offs[0]:offs[-1]] if len(items) else items.values[:0]
        offs = offs - offs[0]
        self.length = np.diff(offs)
        self.n, self.width = len(self.length), int(self.length.max(initial=0))
        at = np.arange(self.width)
        inside = at < self.length[:, None]
        index = np.where(inside, offs[:-1, None] + at, 0)
        self.symbol, self.fault, self.extra = (flat.field(c).to_numpy()[index].reshape(self.n, self.width) for c in ("symbol", "fault", "n"))
        self.extra = self.extra - 1

    def backward(self, after: np.ndarray):
        """Cost vectors before each row from the last to the first."""
        for j in reversed(range(self.width)):
            real = self.length > j
            after = np.where(real[:, None, None], before(after, self.symbol[:, j], self.fault[:, j], self.extra[:, j]), after)
            yield j, after

    def transfer(self) -> np.ndarray:
        """Least cost from each state before the block to each after it."""
        out = np.broadcast_to(np.where(np.eye(4, dtype=bool), 0, INF), (self.n, 4, 4))
        for _, out in self.backward(out):
            pass
        return out

    def walk(self, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The state after the block and the tight edits of its rows, least in
        ASCII, for each state before it. A row's edits are one byte: the state
        it is met in, how many turns are inserted before it, and its own edit."""
        cost = np.empty((self.width + 1, self.n, 4), np.int64)
        cost[self.width] = ends
        for j, c in self.backward(ends[:, :, None]):
            cost[j] = c[:, :, 0]
        state = np.broadcast_to(np.arange(4), (self.n, 4)).copy()
        codes = np.zeros((self.n, 4, self.width), np.uint8)
        for j in range(self.width):
            real = (self.length > j)[:, None]
            # a padded row's successor holds the block's end, as the row itself does
            after = cost[j + 1] + DELETE_COST * self.extra[:, j, None]
            stay = (TRUNCATED_COST * (self.fault[:, j] == TRUNCATED))[:, None]
            met, inserted = state, np.zeros_like(state)
            for _ in range(2):
                here = np.take_along_axis(cost[j], state, 1)
                delete = here == DELETE_COST + np.take_along_axis(after, state, 1)
                insert = real & ~delete & (here == INSERT_COST + np.take_along_axis(cost[j], FORCED[state], 1))
                inserted = inserted + insert
                state = np.where(insert, FORCED[state], state)
            here = np.take_along_axis(cost[j], state, 1)
            delete = here == DELETE_COST + np.take_along_axis(after, state, 1)
            to = NEXT[state, self.symbol[:, j, None]]
            keep = ~delete & (to >= 0) & (here == stay + np.take_along_axis(after, np.maximum(to, 0), 1)) & (self.fault[:, j, None] < DUPLICATE)
            codes[:, :, j] = met * 16 + inserted * 4 + np.where(delete, DELETE, np.where(keep, KEEP, REROLE))
            state = np.where(real, np.where(delete, state, np.where(keep, to, FORCED[state])), state)
        return state, codes


def transfers(batches):
    for batch in batches:
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("block"), binaries(Blocks(batch).transfer())], names=["conv", "block", "transfer"])


def walks(batches):
    for batch in batches:
        if batch.num_rows:
            blocks = Blocks(batch)
            ends = np.frombuffer(b"".join(batch.column("ends").to_pylist()), np.int64).reshape(-1, 4)
            exits, codes = blocks.walk(ends)
            codes = [codes[b, :, :n].tobytes() for b, n in enumerate(blocks.length)]
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("block"), binaries(exits.astype(np.uint8)), pa.array(codes, pa.binary())],
                                             names=["conv", "block", "exits", "codes"])


def binaries(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def checkpoints(batches):
    """Least costs to the end at every block's end, from the last block backwards."""
    for batch in batches:
        convs, blocks, ends, costs = [], [], [], []
        for conv, found in zip(batch.column("conv").to_pylist(), batch.column("found").to_pylist(), strict=True):
            vector = CLOSING
            for b in reversed(found):
                ends.append(vector.tobytes())
                vector = np.minimum((np.frombuffer(b["transfer"], np.int64).reshape(4, 4) + vector).min(1), INF)
            convs += [conv] * len(found)
            blocks += [b["block"] for b in reversed(found)]
            costs += [int(vector[START])] * len(found)
        yield pa.RecordBatch.from_arrays([pa.array(convs, pa.string()), pa.array(blocks, pa.int64()), pa.array(ends, pa.binary()), pa.array(costs, pa.int64())],
                                         names=["conv", "block", "ends", "cost"])


def entries(batches):
    """The state every block is entered in, from the first block on."""
    for batch in batches:
        convs, blocks, out = [], [], []
        for conv, found in zip(batch.column("conv").to_pylist(), batch.column("found").to_pylist(), strict=True):
            state = START
            for b in found:
                out.append(state)
                state = b["exits"][state]
            convs += [conv] * len(found)
            blocks += [b["block"] for b in found]
        yield pa.RecordBatch.from_arrays([pa.array(convs, pa.string()), pa.array(blocks, pa.int64()), pa.array(out, pa.int32())], names=["conv", "block", "entry"])


def chosen(batches):
    """One row per row of a block: its edits in the state that the block is entered in."""
    for batch in batches:
        if not batch.num_rows:
            continue
        convs, first, entry, codes = (batch.column(c).to_pylist() for c in ("conv", "first", "entry", "codes"))
        n = np.array([len(c) // 4 for c in codes])
        ours = np.frombuffer(b"".join(c[e * k:(e + 1) * k] for c, e, k in zip(codes, entry, n, strict=True)), np.uint8).astype(np.int32)
        place = np.arange(len(ours)) + np.repeat(np.array(first) - (np.cumsum(n) - n), n)
        conv = pa.array(convs, pa.string()).take(pa.array(np.repeat(np.arange(len(n)), n)))
        yield pa.RecordBatch.from_arrays([conv, pa.array(place), pa.array(ours // 16), pa.array(ours // 4 % 4), pa.array(ours % 4)],
                                         names=["conv", "pos", "state", "inserted", "edit"])


def planned(rows: DataFrame, least_block: int = LEAST_BLOCK) -> DataFrame:
    """``rows`` (conv, turn, role, text, n as ``gathered`` makes them) with their
    place, fault and edits: ``state`` of the role grammar they are met in,
    turns ``inserted`` before them, their own ``edit``, and the conversation's ``cost``."""
    ship(rows.sparkSession)
    known = land(faulted(placed(rows)), "repair-faults")
    size = F.greatest(F.lit(least_block), F.ceil(F.sqrt("n_rows")))
    item = F.struct("pos", "symbol", "fault", "n")
    blocks = known.withColumn("block", F.floor(F.col("pos") / size)).groupBy("conv", "block").agg(F.array_sort(F.collect_list(item)).alias("items"))
    blocks = land(blocks, "repair-blocks")
    by_conv = lambda df, what: df.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("block", what))).alias("found"))
    ends = by_conv(blocks.mapInArrow(transfers, "conv string, block long, transfer binary"), "transfer")
    ends = land(ends.mapInArrow(checkpoints, "conv string, block long, ends binary, cost long"), "repair-checkpoints")
    walked = blocks.join(ends, ["conv", "block"]).select("conv", "block", "items", "ends").mapInArrow(walks, "conv string, block long, exits binary, codes binary")
    walked = land(walked, "repair-walks")
    entered = by_conv(walked.select("conv", "block", "exits"), "exits").mapInArrow(entries, "conv string, block long, entry int")
    first = blocks.select("conv", "block", F.col("items")[0]["pos"].alias("first"))
    edits = walked.join(entered, ["conv", "block"]).join(first, ["conv", "block"]).select("conv", "first", "entry", "codes")
    edits = edits.mapInArrow(chosen, "conv string, pos long, state int, inserted int, edit int")
    costs = ends.where("block = 0").select("conv", "cost")
    return known.join(edits, ["conv", "pos"]).join(costs, "conv")


def turns_of(row: dict) -> list[tuple[str, str | None, str | None]]:
    """The edits of a planned row: (letter, role, text), role and text null for a deleted row."""
    state, out = row["state"], []
    for _ in range(row["inserted"]):
        state = int(FORCED[state])
        out.append(("I", ROLE[state], ""))
    if row["edit"] == DELETE:
        out.append(("D", None, None))
    else:
        out.append((LETTERS[row["edit"]], row["role"], row["text"]) if row["edit"] == KEEP else ("R", ROLE[int(FORCED[state])], row["text"]))
        state = int(NEXT[state, row["symbol"]] if row["edit"] == KEEP else FORCED[state])
    out += [("D", None, None)] * (row["n"] - 1)
    if row["pos"] == row["n_rows"] - 1:
        for _ in range(N_CLOSING[state]):
            state = int(FORCED[state])
            out.append(("I", ROLE[state], ""))
    return out


COLUMNS = ["conv", "pos", "n_rows", "turn", "role", "text", "n", "symbol", "fault", "state", "inserted", "edit", "cost"]


def streamed(plan: DataFrame) -> DataFrame:
    """Planned rows, a conversation's one after another in order."""
    return plan.select(*COLUMNS).repartition("conv").sortWithinPartitions("conv", "pos")


def rows_in_order(batches):
    for batch in batches:
        yield from batch.to_pylist()


def repaired(plan: DataFrame) -> DataFrame:
    """(conv, place, edit, role, text): the edits in order; the rows with a
    role are the repaired conversations."""
    def run(batches):
        for conv, rows in groupby(rows_in_order(batches), key=lambda r: r["conv"]):
            place = 0
            for row in rows:
                edits = turns_of(row)
                letters, roles, texts = zip(*edits, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array([conv] * len(edits), pa.string()), pa.array(range(place, place + len(edits)), pa.int64()),
                                                  pa.array(letters), pa.array(roles, pa.string()), pa.array(texts, pa.string())],
                                                 names=["conv", "place", "edit", "role", "text"])
                place += len(edits)

    return streamed(plan).mapInArrow(run, "conv string, place long, edit string, role string, text string")


DIGEST = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def digest_of(conv: str, rows) -> list:
    counts, illegal, n_turns, low, high, last, initial = [0] * 4, 0, 0, None, None, None, None
    audit, digest, begun, cost = [], hashlib.sha256(), False, 0
    for row in rows:
        cost = row["cost"]
        counts[row["fault"]] += row["n"] if row["fault"] == BLANK else 1
        counts[DUPLICATE] += 0 if row["fault"] == BLANK else row["n"] - 1
        now = row["role"][:1]
        illegal += row["n"] - 1 + (initial is not None and initial + now not in ("su", "ua", "au"))
        initial = now
        if row["turn"] is not None:
            low, high, n_turns = row["turn"] if low is None else low, row["turn"], n_turns + (row["turn"] != last)
            last = row["turn"]
        for letter, role, text in turns_of(row):
            audit.append(letter)
            if role is not None:
                digest.update((("\n" if begun else "") + f"{role}:{text}").encode())
                begun = True
    gaps = 0 if low is None else high - low + 1 - n_turns
    return [conv, gaps, counts[BLANK], counts[DUPLICATE], counts[TRUNCATED], illegal, cost, "".join(audit), digest.hexdigest()]


def digests(batches):
    names = [f.split()[0] for f in DIGEST.split(", ")]
    types = [pa.string()] + [pa.int64()] * 6 + [pa.string()] * 2
    found = (digest_of(conv, rows) for conv, rows in groupby(rows_in_order(batches), key=lambda r: r["conv"]))
    while some := list(islice(found, OUT_ROWS)):
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*some, strict=True), types, strict=True)], names=names)


def report(rows: DataFrame, least_block: int = LEAST_BLOCK) -> DataFrame:
    """The registered query: damages ``rows`` and returns one row per original conv_id.

    Rows of one turn go by role, then text; a null conv_id is one conversation;
    a null turn comes first; null roles and texts are one space; repeated rows
    are duplicates; a conversation without rows after damage has zeros, an
    empty audit and the hash of nothing; other columns are not read; an empty
    table gives an empty result.
    """
    found = streamed(planned(damage(rows), least_block)).mapInArrow(digests, DIGEST)
    every = rows.select(F.col("conv_id").cast("long").alias("conv_id"), spaced("conv_id").alias("conv")).distinct()
    nothing = hashlib.sha256().hexdigest()
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(found, "conv", "left").select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                                                    F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
