"""Repair of the structure of conversations, whatever their length.

Turns are sorted by range, so that a long conversation is spread over many partitions, and cut
into blocks of bounded size. A block is reduced to a 4 x 4 table of costs (``crossings``); blocks
of one conversation are joined to nodes, level by level, until few are left. From the top down,
forward and backward cost vectors meet in the middle of a node's parts and choose the state at
which they cross, until each block knows the states at its ends and is solved alone.

No step holds a whole conversation: what is gathered per conversation are its costs, and at last
the audit, a letter per edit. The digest of a repaired text is sequential by its nature; its lines
are streamed through it in order, block by block.

Rows are (conv_id, turn, role, text); other columns are not read. Null roles and texts count as
one space, a null conv_id is a conversation like others, rows without a turn come first. Rows of
one turn go by role, then text, in byte order, so equal rows are neighbours. An empty table gives
an empty result; texts may have any length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle, tidy
from .crossings import (MUST_DELETE, START, TAIL, TRUNCATED, Table, Vector, at, closing,
                        crossings, edits, fill_in, forward, illegal_pairs, joined)

BLOCK_TURNS = 2048
BLOCK_CHARS = 1 << 16
FAN = 1024         # parts joined to one node
TOP_NODES = 10_000  # a conversation of so many nodes is looked at in one task
NODE_BITS = 40
ROWS_OUT = 256
BLANKS = " \t\n\x0b\x0c\r"
DELETED = MUST_DELETE << 2

NODE = ("costs array<bigint>, ranks array<int>, first int, last int, illegal bigint")
STATE = "node bigint, start int, end int, closes boolean, cost bigint, illegal bigint"
NODE_TYPES = [("costs", pa.list_(pa.int64())), ("ranks", pa.list_(pa.int32())),
              ("first", pa.int32()), ("last", pa.int32()), ("illegal", pa.int64())]
PART = pa.struct([("node", pa.int64()), *NODE_TYPES])
LINE = pa.struct([("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])


def damage(rows: DataFrame) -> DataFrame:
    """Rows with planted faults, told by crc32 of ``conv_id:turn`` modulo 20.

    0 drops a row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes it the
    user's. Nulls count as one space.
    """
    blank = F.lit(" ")
    key = F.concat(*[F.coalesce(F.col(c).cast("string"), blank) if c else F.lit(":")
                     for c in ("conv_id", "", "turn")])
    text, role = F.coalesce("text", blank), F.coalesce("role", blank)
    kind = F.col("_kind")
    return (
        rows.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                    (F.crc32(key.cast("binary")) % 20).alias("_kind"))
        .filter(kind != 0)
        .select("conv_id", "turn",
                F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
                F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", ""))
                .otherwise(F.col("text")).alias("text"),
                F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("_copy"))
        .drop("_copy"))


def marked_turns(rows: DataFrame) -> DataFrame:
    """Distinct turns with ``n``, how often each occurs, and the first fault of the first one.

    ``fault`` is blank, duplicate (role and text occur earlier), truncated or null; further ones
    of a turn are blank or duplicates. ``code`` says initial and fault (see ``crossings``).
    """
    given = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                        F.coalesce("text", F.lit(" ")).alias("text"))
    columns = given.columns
    turns = given.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    earliest = F.min(F.struct(F.col("turn").isNotNull(), F.col("turn")))  # null comes first
    firsts = turns.groupBy("conv_id", "role", "text").agg(earliest.alias("at")).select(
        *[F.col(c).alias(f"_{c}") for c in ("conv_id", "role", "text")],
        F.col("at.turn").alias("_turn"))
    same = F.lit(True)
    for c in columns:  # together a unique key on both sides, so none is hot
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    end = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    fault = (F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "blank")
             .when(F.col("_role").isNull(), "duplicate")
             .when(~end.isin(".", "!", "?"), "truncated"))
    kind = (F.when(F.col("fault") == "truncated", TRUNCATED)
            .when(F.col("fault").isNotNull(), MUST_DELETE).otherwise(0))
    initial = F.left("role", F.lit(1))
    number = (F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2)
              .otherwise(3))
    return (turns.join(firsts, same, "left").withColumn("fault", fault)
            .select(*columns, "n", "fault", (number + 4 * kind).cast("int").alias("code")))


def _lists(table: Table) -> tuple[list[int], list[int]]:
    return [c for v in table for c in v.costs], [r for v in table for r in v.ranks]


def _table(costs: list[int], ranks: list[int]) -> Table:
    return tuple(Vector(tuple(costs[i:i + 4]), tuple(ranks[i:i + 4])) for i in (0, 4, 8, 12))


def _batches(rows: Iterable[tuple], types: list[tuple[str, pa.DataType]]
             ) -> Iterator[pa.RecordBatch]:
    """Rows as batches, few at a time."""
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in held], kind) for i, (_, kind) in enumerate(types)],
            names=[name for name, _ in types])

    for row in rows:
        held.append(row)
        if len(held) == ROWS_OUT:
            yield batch()
            held.clear()
    if held:
        yield batch()


def _rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names))


def blocks_of(turns: DataFrame, block_turns: int = BLOCK_TURNS,
              block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Marked turns, in order, as blocks.

    ``node`` numbers blocks in the order of (conv_id, turn). ``whole`` says that a block holds a
    whole conversation; one that may go on in a neighbouring partition is not whole, and carries
    its table. Roles and texts are those of the turns that need not be deleted.
    """
    keys = ["conv_id", "turn", "role"]
    placed = (turns.repartitionByRange(*keys, F.left("text", F.lit(64)))
              .sortWithinPartitions(*keys, "text"))
    id_type = dict(turns.dtypes)["conv_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        types: list[tuple[str, pa.DataType]] = []

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
            number, conv, codes, roles, texts, chars = 0, None, bytearray(), [], [], 0
            began = False  # the block is its conversation's first, and that began here
            later = False  # the conversation is not the partition's first

            def block(whole: bool) -> tuple:
                steps = bytes(codes)
                costs, ranks = (None, None) if whole else _lists(joined(steps))
                return (part << NODE_BITS | number, conv, whole, steps, list(roles), list(texts),
                        costs, ranks, steps[0], steps[-1], illegal_pairs(steps))

            for row in _rows(batches, "conv_id", "role", "text", "n", "code"):
                same = number + len(codes) > 0 and row[0] == conv
                full = len(codes) >= block_turns or chars >= block_chars
                if codes and (full or not same):
                    yield block(whole=began and not same)
                    number += 1
                    began = False
                    codes.clear(), roles.clear(), texts.clear()
                    chars = 0
                if not same:
                    began, later, conv = later, True, row[0]
                _, role, text, n, code = row
                if code >> 2 == MUST_DELETE:
                    more = n
                else:
                    codes.append(code)
                    roles.append(role)
                    texts.append(text)
                    chars += len(text) + len(role)
                    more = n - 1
                again = code & 3 | DELETED
                while more:
                    if len(codes) >= block_turns:
                        yield block(whole=False)
                        number += 1
                        began = False
                        codes.clear(), roles.clear(), texts.clear()
                        chars = 0
                    some = min(more, block_turns - len(codes))
                    codes.extend(bytes([again]) * some)
                    more -= some
            if codes:
                yield block(whole=False)

        for batch in batches:
            ids = batch.column("conv_id").type
            types += [("node", pa.int64()), ("conv_id", ids), ("whole", pa.bool_()),
                      ("codes", pa.binary()), ("roles", pa.list_(pa.string())),
                      ("texts", pa.list_(pa.string())), *NODE_TYPES]
            yield from _batches(cut(_put_back(batch, batches)), types)

    return placed.select("conv_id", "role", "text", "n", "code").mapInArrow(
        tidy(run), f"node bigint, conv_id {id_type}, whole boolean, codes binary, "
        f"roles array<string>, texts array<string>, {NODE}")


def _put_back(batch: pa.RecordBatch, batches: Iterator[pa.RecordBatch]
              ) -> Iterator[pa.RecordBatch]:
    yield batch
    yield from batches


def _merged(parts: list[dict]) -> tuple:
    """Neighbouring nodes of a conversation as one: costs, ranks, first, last, illegal."""
    table = joined([_table(p["costs"], p["ranks"]) for p in parts])
    between = sum(illegal_pairs(bytes([a["last"], b["first"]]))
                  for a, b in zip(parts, parts[1:]))
    return (*_lists(table), parts[0]["first"], parts[-1]["last"],
            sum(p["illegal"] for p in parts) + between)


def join_nodes(nodes: DataFrame, fan: int, n_partitions: int) -> DataFrame:
    """Up to ``fan`` neighbouring nodes of a conversation as one, with the parts it is made of.

    It has the number of its first part, so the order of numbers stays that of the turns.
    """
    placed = nodes.repartitionByRange(n_partitions, "node").sortWithinPartitions("node")
    id_type = dict(nodes.dtypes)["conv_id"]
    names = [name for name, _ in NODE_TYPES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def join(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
            conv, parts = None, []
            for own, *rest in _rows(batches, "conv_id", "node", *names):
                if parts and (own != conv or len(parts) == fan):
                    yield (parts[0]["node"], conv, *_merged(parts), list(parts))
                    parts.clear()
                conv = own
                parts.append(dict(zip(["node", *names], rest)))
            if parts:
                yield (parts[0]["node"], conv, *_merged(parts), list(parts))

        for batch in batches:
            types = [("node", pa.int64()), ("conv_id", batch.column("conv_id").type),
                     *NODE_TYPES, ("parts", pa.list_(PART))]
            yield from _batches(join(_put_back(batch, batches)), types)

    part = f"struct<node:bigint,{NODE.replace(', ', ',').replace(' ', ':')}>"
    return placed.select("conv_id", "node", *names).mapInArrow(
        tidy(run), f"node bigint, conv_id {id_type}, {NODE}, parts array<{part}>")


def _spread(parts: list[dict], start: int, end: int, closes: bool, cost: int | None,
            illegal: int | None) -> Iterator[tuple]:
    """States of a node's parts; what holds for the conversation goes with its first node."""
    states = crossings([_table(p["costs"], p["ranks"]) for p in parts], start, end)
    for i, p in enumerate(parts):
        yield (p["node"], states[i], states[i + 1], closes and i == len(parts) - 1,
               None if i else cost, None if i else illegal)


STATE_TYPES = [("node", pa.int64()), ("start", pa.int32()), ("end", pa.int32()),
               ("closes", pa.bool_()), ("cost", pa.int64()), ("illegal", pa.int64())]


def states_of(nodes: DataFrame, fan: int = FAN, top_nodes: int = TOP_NODES) -> DataFrame:
    """The states at both ends of each node of conversations that are not whole blocks.

    ``nodes`` is stored. Levels are added until no conversation has more than ``top_nodes``.
    """
    levels: list[DataFrame] = []
    while True:
        counts = nodes.groupBy("conv_id").count().agg(F.max("count"), F.sum("count")).first()
        if (counts[0] or 0) <= top_nodes:
            break
        nodes = settle(join_nodes(nodes, fan, max(1, counts[1] // fan)))
        levels.append(nodes)

    def top(table: pa.Table) -> pa.Table:
        parts = sorted(table.to_pylist(), key=lambda p: p["node"])
        way = forward(at(START), [_table(p["costs"], p["ranks"]) for p in parts], 0, len(parts))
        end, cost = closing(way)
        rows = _spread(parts, START, end, True, cost, _merged(parts)[-1])
        return pa.Table.from_batches(list(_batches(rows, STATE_TYPES)))

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [name for name, _ in STATE_TYPES[1:]]
        yield from _batches(
            (row for parts, *state in _rows(batches, "parts", *names)
             for row in _spread(parts, *state)), STATE_TYPES)

    names = [name for name, _ in NODE_TYPES]
    states = nodes.select("conv_id", "node", *names).groupBy("conv_id").applyInArrow(top, STATE)
    for level in reversed(levels):
        states = level.select("node", "parts").join(states, "node").mapInArrow(tidy(down), STATE)
    return states


def _solved(codes: bytes, roles: list[str], texts: list[str], start: int, end: int,
            closes: bool) -> tuple[str, list[tuple[str, str, str]]]:
    """Audit and repaired turns (role, text, edit) of a block."""
    kept = iter(zip(roles, texts))
    letters, lines, place, own = [], [], -1, None
    for i, letter, role in edits(codes, start, end):
        letters.append(letter)
        if letter == "I":
            lines.append((role, "", letter))
            continue
        if i != place:
            place, own = i, None if codes[i] >> 2 == MUST_DELETE else next(kept)
        if letter != "D":
            lines.append((role or own[0], own[1], letter))
    state = end
    for letter in TAIL[end] if closes else "":
        role, state = fill_in(state)
        letters.append(letter)
        lines.append((role, "", letter))
    return "".join(letters), lines


BLOCK = ("node", "conv_id", "whole", "codes", "roles", "texts", "illegal")


def _pieces(blocks: DataFrame, fan: int, top_nodes: int) -> tuple[DataFrame, DataFrame]:
    """Stored blocks of whole conversations, and the others with their states."""
    names = [name for name, _ in NODE_TYPES]
    split = blocks.filter("not whole")
    states = states_of(split.select("node", "conv_id", *names), fan, top_nodes)
    unknown = [F.lit(None).cast(kind).alias(name) for name, kind in (
        ("start", "int"), ("end", "int"), ("closes", "boolean"), ("cost", "bigint"))]
    whole = blocks.filter("whole").select(*BLOCK, *unknown)
    parts = split.drop("illegal").join(states, "node")
    return whole, parts.select(*BLOCK, "start", "end", "closes", "cost")


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Per block: node, conv_id, whole, cost, illegal, audit, repaired turns."""
    for node, conv, whole, codes, roles, texts, illegal, *states in _rows(
            batches, *BLOCK, "start", "end", "closes", "cost"):
        start, end, closes, cost = states
        if whole:
            start, closes = START, True
            end, cost = closing(forward(at(START), codes, 0, len(codes)))
        audit, lines = _solved(codes, roles, texts, start, end, closes)
        yield node, conv, whole, cost, illegal, audit, lines


def _text(lines: list[tuple[str, str, str]]) -> bytes:
    return "\n".join(f"{role}:{text}" for role, text, _ in lines).encode()


def outcomes(blocks: DataFrame, fan: int = FAN, top_nodes: int = TOP_NODES) -> DataFrame:
    """Per conversation: illegal, cost, audit, repaired_sha256."""
    whole, parts = _pieces(blocks, fan, top_nodes)
    id_type = dict(blocks.dtypes)["conv_id"]
    result = (f"conv_id {id_type}, illegal bigint, cost bigint, audit string, "
              "repaired_sha256 string")

    def types(ids: pa.DataType) -> list[tuple[str, pa.DataType]]:
        return [("conv_id", ids), ("illegal", pa.int64()), ("cost", pa.int64()),
                ("audit", pa.string()), ("repaired_sha256", pa.string())]

    def one_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _batches(
                ((conv, illegal, cost, audit, hashlib.sha256(_text(lines)).hexdigest())
                 for _, conv, _, cost, illegal, audit, lines in _solve(iter([batch]))),
                types(batch.column("conv_id").type))

    def fragment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _batches(
                ((conv, node, illegal, cost, audit, len(lines), _text(lines))
                 for node, conv, _, cost, illegal, audit, lines in _solve(iter([batch]))),
                [("conv_id", batch.column("conv_id").type), ("node", pa.int64()),
                 ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()),
                 ("n_lines", pa.int64()), ("lines", pa.binary())])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def digests(rows: Iterator[tuple]) -> Iterator[tuple]:
            conv = digest = None
            for own, new_illegal, new_cost, audit, n_lines, lines in rows:
                if digest is None or own != conv:
                    if digest is not None:
                        yield conv, illegal, cost, "".join(audits), digest.hexdigest()
                    conv, digest, audits, any_line = own, hashlib.sha256(), [], False
                    illegal = cost = None
                if n_lines:
                    digest.update(b"\n" + lines if any_line else lines)
                    any_line = True
                audits.append(audit)
                illegal = new_illegal if illegal is None else illegal
                cost = new_cost if cost is None else cost
            if digest is not None:
                yield conv, illegal, cost, "".join(audits), digest.hexdigest()

        for batch in batches:
            yield from _batches(
                digests(_rows(_put_back(batch, batches), "conv_id", "illegal", "cost", "audit",
                              "n_lines", "lines")),
                types(batch.column("conv_id").type))

    fragments = parts.mapInArrow(
        tidy(fragment), f"conv_id {id_type}, node bigint, illegal bigint, cost bigint, "
        "audit string, n_lines bigint, lines binary")
    ordered = fragments.repartition("conv_id").sortWithinPartitions("conv_id", "node")
    return whole.mapInArrow(tidy(one_block), result).unionByName(
        ordered.mapInArrow(tidy(stream), result))


def repaired_turns(rows: DataFrame, fan: int = FAN, top_nodes: int = TOP_NODES,
                   block_turns: int = BLOCK_TURNS) -> DataFrame:
    """The turns after repair: conv_id, node and place (their order), role, text, edit.

    ``edit`` is K (kept), R (other role) or I (inserted, empty). See the module for edge cases.
    """
    blocks = settle(blocks_of(marked_turns(rows), block_turns))
    whole, parts = _pieces(blocks, fan, top_nodes)
    id_type = dict(blocks.dtypes)["conv_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _batches(
                ((conv, node, [dict(zip(("role", "text", "edit"), line)) for line in lines])
                 for node, conv, *_, lines in _solve(iter([batch]))),
                [("conv_id", batch.column("conv_id").type), ("node", pa.int64()),
                 ("lines", pa.list_(LINE))])

    solved = whole.unionByName(parts).mapInArrow(
        tidy(run), f"conv_id {id_type}, node bigint, "
        "lines array<struct<role:string,text:string,edit:string>>")
    return solved.select("conv_id", "node", F.posexplode("lines").alias("place", "line")).select(
        "conv_id", "node", "place", "line.*")


def repair_report(rows: DataFrame, ids: DataFrame | None = None, fan: int = FAN,
                  top_nodes: int = TOP_NODES, block_turns: int = BLOCK_TURNS,
                  block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per conversation: faults, the cheapest repair and the digest of its result.

    Columns: conv_id; gaps, the turns missing between the least and the greatest; blank,
    duplicate, truncated, the rows by first fault; illegal, the neighbours whose role initials
    are not su, ua or au; cost and audit of the cheapest edits (the audit least in ASCII of
    those); repaired_sha256 of the repaired ``role:text`` lines.

    ``ids`` (conv_id) adds conversations without rows: zeros, an empty audit, the digest of
    nothing. See the module for edge cases.
    """
    turns = settle(marked_turns(rows))
    blocks = settle(blocks_of(turns, block_turns, block_chars))
    again = F.col("n") - 1  # further ones of a turn: blank if the first is, else duplicates
    counts = turns.groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"),
        F.sum(F.when(F.col("fault") == "blank", F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("fault") == "blank", 0).when(F.col("fault") == "duplicate", F.col("n"))
              .otherwise(again)).alias("duplicate"),
        F.sum(F.when(F.col("fault") == "truncated", 1).otherwise(0)).alias("truncated"))
    known = turns.select("conv_id") if ids is None else ids.select("conv_id")

    def beside(df: DataFrame, more: DataFrame) -> DataFrame:
        named = more.withColumnRenamed("conv_id", "_conv_id")
        return df.join(named, F.col("conv_id").eqNullSafe(F.col("_conv_id")), "left").drop(
            "_conv_id")

    found = beside(beside(known.distinct(), counts), outcomes(blocks, fan, top_nodes))
    numbers = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in (
        "gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(
        "conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))
