"""Joins whose next step depends on the step before: shared layout.

The alternating and the three-way delta join keep a small state: which stream is dominant, and how the heads of the streams
stand to each other. They are walked in order, but never over more than one slice at a time:

1. every slice of a large key is reduced to a table "state on entry -> state on exit";
2. the tables of neighbouring slices are put together, block by block, in rounds: each round leaves one table for a block,
   until a key is one block; then the state on entry is handed down the same rounds, from block to block;
3. all slices are walked at the same time, each from its own entry state.

A block is two tables, or more if all of them together have at most ``RULES_PER_BLOCK`` rows. So no task holds more than that,
however many slices a key has. Slices are cut anywhere in the order ``(t, side, seq)``, also through rows of equal time. Small
keys are walked directly, many to a task. The walks report ranks; values are joined back by Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.operators.queue_joins import merge, merged_bounds
from weftline.operators.slices import SLICE, Sliced, lookup, settled, slice_rows
from weftline.series import Series

_ORDER = ("_t", "_side", "_seq")
_GROUP = "_group"
#: Where a row comes from: 0 its own slice, -1 the row before it, 1, 2, .. the rows after it.
PART = "_part"
#: On the row before a slice: the rank of the first row of its stream with the same time.
OPENS = "_opens"
END = -1
RULES_PER_BLOCK = 200_000


@dataclass
class Stretch:
    """The rows of one key in one slice, with a few rows borrowed from both neighbours."""

    row: int  # position of some row of it in the table
    times: list[list]  # per stream, in order
    base: list[int]  # per stream, rank of the first time listed
    low: list[int]  # per stream, rank of the first own row
    high: list[int]  # per stream, rank after the last own row


def numbers(rows: pa.Table, name: str) -> np.ndarray:
    return rows.column(name).combine_chunks().to_numpy(zero_copy_only=False)


def codes(rows: pa.Table, keys: list[str]) -> np.ndarray:
    """A number per combination of keys, from 0 on; null is a key like others."""
    code = np.zeros(len(rows), np.int64)
    for k in keys:
        found = pc.dictionary_encode(rows.column(k).combine_chunks(), null_encoding="encode").indices.to_numpy()
        code = np.unique(code * (len(rows) + 1) + found, return_inverse=True)[1].astype(np.int64)
    return code


def whole_groups(
    df: DataFrame, group: str, function: Callable[[pa.Table], pa.Table], schema: T.StructType
) -> DataFrame:
    """``function`` over tables of whole groups, many small ones or one large one at a time; ``group`` is a number per group.

    One call for many groups costs far less than one for each.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for batch in batches:
            if not len(batch):
                continue
            number = batch.column(group).to_numpy()
            if held and number[0] != last:
                yield from function(pa.Table.from_batches(held)).to_batches()
                held = []
            last = number[-1]
            opens = int(np.searchsorted(number, last))
            if opens:
                yield from function(pa.Table.from_batches([*held, batch.slice(0, opens)])).to_batches()
                held = []
            held.append(batch.slice(opens))
        if held:
            yield from function(pa.Table.from_batches(held)).to_batches()

    return df.repartition(group).sortWithinPartitions(group).mapInArrow(run, schema)


def own_ranks(rank: np.ndarray, part: np.ndarray) -> tuple[int, int]:
    """First rank of a stream's own rows and the rank after the last, from its listed rows in order."""
    own = rank[part == 0]
    if len(own):
        return int(own[0]), int(own[-1]) + 1
    # without own rows the borrowed ones still tell where the stream stands
    low = 0 if not len(rank) else int(rank[0]) + (1 if part[0] < 0 else 0)
    return low, low


def stretches(rows: pa.Table, by: list[str], sides: int) -> Iterator[Stretch]:
    """The (key, slice) stretches of a table."""
    if not len(rows):
        return
    code, side, rank = codes(rows, [*by, SLICE]), numbers(rows, "_side"), numbers(rows, "_rank")
    order = np.lexsort((rank, side, code))
    code, side, rank = code[order], side[order], rank[order]
    time, part = numbers(rows, "_t")[order], numbers(rows, PART)[order]
    starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    for begin, end in zip(starts, np.r_[starts[1:], len(code)]):
        marks = begin + np.searchsorted(side[begin:end], np.arange(sides + 1))
        spans = [own_ranks(rank[a:b], part[a:b]) for a, b in zip(marks[:-1], marks[1:])]
        yield Stretch(
            int(order[begin]),
            [time[a:b].tolist() for a, b in zip(marks[:-1], marks[1:])],
            [int(rank[a]) if b > a else 0 for a, b in zip(marks[:-1], marks[1:])],
            [low for low, _ in spans],
            [high for _, high in spans],
        )


@dataclass(frozen=True)
class Layout:
    sl: Sliced
    ranked: DataFrame  # by, _slice, order, _row<i>, _rank (0-based, per key and stream)
    narrow: DataFrame  # by, _slice, _t, _side, _rank, _part, _opens, _group

    @property
    def by(self) -> list[str]:
        return list(self.sl.by)

    def by_schema(self) -> list[T.StructField]:
        return [self.ranked.schema[c] for c in self.by]


def lay_out(series: list[Series], ahead: int, rows_per_slice: int | None = None) -> Layout:
    """Rank the rows of all streams; let each slice borrow one row before and ``ahead`` after it.

    If keys are cut, the ranked rows are read several times, so they are written to the checkpoint folder once.
    """
    merged = merge(*series)
    sl = slice_rows(merged, series[0].by, _ORDER, rows_per_slice, bounds=merged_bounds(*series))
    position = F.row_number().over(Window.partitionBy(*sl.keys, "_side").orderBy("_t", "_seq"))
    ranked = sl.df.withColumn("_rank", position.cast("long") - 1)
    columns = [*sl.by, SLICE, "_t", "_side", "_rank"]
    nothing = F.lit(None).cast("long").alias(OPENS)
    if sl.split:
        spans = _spans(sl, len(series))
        ranked = lookup(ranked, spans.select(*sl.keys, "_side", "_from"), [*sl.keys, "_side"])
        start = F.coalesce("_from", F.lit(0))
        ranked = settled(ranked.withColumn("_rank", F.col("_rank") + start).drop("_from"))
        own = ranked.select(*columns, F.lit(0).alias(PART), nothing)
        spans = lookup(spans, _opens(sl, ranked, len(series)), [*sl.keys, "_side"])
        places = [F.struct((F.col("_from") - 1).alias("_rank"), F.lit(-1).alias(PART), F.col(OPENS).alias(OPENS))]
        for k in range(ahead):
            places.append(F.struct((F.col("_from") + F.col("_n") + k).alias("_rank"), F.lit(k + 1).alias(PART), nothing))
        wanted = spans.select(*sl.keys, "_side", F.inline(F.array(*places)))
        rows = ranked.select(*sl.by, "_t", "_side", "_rank")
        borrowed = lookup(rows, wanted, [*sl.by, "_side", "_rank"], how="inner")
        narrow = own.unionByName(borrowed.select(*columns, PART, OPENS))
    else:
        narrow = ranked.select(*columns, F.lit(0).alias(PART), nothing)
    key = [*sl.by, SLICE]
    group = F.when(F.col(SLICE) > 0, F.xxhash64(*key)).otherwise(
        F.pmod(F.xxhash64(*key), F.lit(sl.pieces))
    )
    return Layout(sl, ranked, narrow.withColumn(_GROUP, group))


def _every_side(sl: Sliced, held: DataFrame, name: str, sides: int) -> DataFrame:
    """A row for each slice and stream, also for streams without rows in the slice."""
    packed = held.groupBy(*sl.keys).agg(F.map_from_entries(F.collect_list(F.struct("_side", name))).alias("_held"))
    every = packed.select(*sl.keys, "_held", F.explode(F.array(*map(F.lit, range(sides)))).alias("_side"))
    return every.select(*sl.keys, "_side", F.element_at("_held", F.col("_side")).alias(name))


def _spans(sl: Sliced, sides: int) -> DataFrame:
    """Per slice of a large key and stream: rank of the first own row, and how many there are."""
    large = sl.df.where(F.col(SLICE) > 0)
    counts = large.groupBy(*sl.keys, "_side").agg(F.count(F.lit(1)).alias("_n"))
    spans = _every_side(sl, counts, "_n", sides).fillna(0, ["_n"])
    earlier = F.coalesce(F.sum("_n").over(sl.before("_side")), F.lit(0).cast("long"))
    return spans.select(*sl.keys, "_side", earlier.alias("_from"), "_n")


def _opens(sl: Sliced, ranked: DataFrame, sides: int) -> DataFrame:
    """Per slice and stream with rows in an earlier slice: rank of the first row with the time of the last such row."""
    large = ranked.where(F.col(SLICE) > 0)
    newest = large.groupBy(*sl.keys, "_side").agg(
        F.max("_t").alias("_newest"), F.min_by("_rank", F.struct(-F.col("_t"), F.col("_rank"))).alias("_first")
    )
    # the same time may go through several slices
    newest = newest.withColumn("_first", F.min("_first").over(Window.partitionBy(*sl.by, "_side", "_newest")))
    whole = _every_side(sl, newest, "_first", sides)
    last = F.last("_first", ignorenulls=True).over(sl.before("_side"))
    return whole.select(*sl.keys, "_side", last.alias(OPENS))


# --- tables of slices --------------------------------------------------------------

#: A rule: who is in state ``_on`` with a lead below ``_lead`` leaves in state ``_to`` with the lead ``_rest``. The rule with the
#: least ``_lead`` above one's own counts; without any the state stays.
RULE = ["_on", "_lead", "_to", "_rest"]


class Table:
    """The rules of one slice, or of several slices in a row."""

    def __init__(self, on: np.ndarray, lead: np.ndarray, to: np.ndarray, rest: np.ndarray):
        order = np.lexsort((lead, on))
        self.on, self.lead, self.to, self.rest = (c[order] for c in (on, lead, to, rest))
        states = np.unique(self.on)
        self.spans = {int(s): (int(np.searchsorted(self.on, s)), int(np.searchsorted(self.on, s, "right"))) for s in states}

    def leave(self, on: np.ndarray, lead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states in which these states leave."""
        to, rest = on.copy(), lead.copy()
        for state, (a, b) in self.spans.items():
            here = np.flatnonzero(on == state)
            at = a + np.searchsorted(self.lead[a:b], lead[here], side="right")
            here, at = here[at < b], at[at < b]
            to[here], rest[here] = self.to[at], self.rest[at]
        return to, rest

    def then(self, after: Table) -> Table:
        """Both one after the other, as one table."""
        to, rest = after.leave(self.to, self.rest)
        last = {s: self.lead[b - 1] for s, (_, b) in self.spans.items()}
        beyond = np.array([last.get(int(s), np.iinfo(np.int64).min) for s in after.on], np.int64)
        kept = after.lead > beyond  # leads that pass through the first table unchanged
        return Table(
            np.r_[self.on, after.on[kept]], np.r_[self.lead, after.lead[kept]],
            np.r_[to, after.to[kept]], np.r_[rest, after.rest[kept]],
        ).shorter()

    def shorter(self) -> Table:
        """Without rules that say the same as the next one."""
        same = np.zeros(len(self.on), bool)
        same[:-1] = (self.on[:-1] == self.on[1:]) & (self.to[:-1] == self.to[1:]) & (self.rest[:-1] == self.rest[1:])
        return Table(*(c[~same] for c in (self.on, self.lead, self.to, self.rest)))

    def columns(self) -> list[np.ndarray]:
        return [self.on, self.lead, self.to, self.rest]


def _rule_arrays(columns: list[np.ndarray], bare: int) -> list[pa.Array]:
    """The rules, and so many empty ones: a slice without rules has one empty row, so that it is not forgotten."""
    return [pa.array(np.r_[c, np.zeros(bare, np.int64)], mask=np.arange(len(c) + bare) >= len(c)) for c in columns]


def _tables(rows: pa.Table, chosen: np.ndarray) -> Iterator[tuple[int, Table]]:
    """Number and table of each node in order."""
    node = numbers(rows, "_node")[chosen].astype(np.int64)
    order = np.argsort(node, kind="stable")
    node, chosen = node[order], chosen[order]
    held = rows.column("_on").is_valid().to_numpy()[chosen]
    columns = [numbers(rows.select([n]).set_column(0, n, pc.fill_null(rows.column(n), 0)), n)[chosen] for n in RULE]
    starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]]) if len(node) else []
    for a, b in zip(starts, np.r_[starts[1:], len(node)].astype(int)):
        yield int(node[a]), Table(*(c[a:b][held[a:b]] for c in columns))


def _entries(rules: DataFrame, by: list[str], start: tuple[int, int]) -> DataFrame:
    """The state on entry of every node: ``by``, ``_node``, ``_on``, ``_lead``; the rules have ``by``, ``_node`` and RULE."""
    keys = [rules.schema[c] for c in by]
    long = T.LongType()
    rule_schema = T.StructType([*keys, *[T.StructField(n, long) for n in ("_node", *RULE)]])
    state_schema = T.StructType([*keys, *[T.StructField(n, long) for n in ("_node", "_on", "_lead")]])

    def in_blocks(rows: pa.Table) -> Iterator[np.ndarray]:
        """The places of the rows of each block."""
        code = codes(rows, [*by, "_block"])
        order = np.argsort(code, kind="stable")
        return iter(np.split(order, np.flatnonzero(np.diff(code[order])) + 1))

    def put_together(rows: pa.Table) -> pa.Table:
        out = []
        for chosen in in_blocks(rows):
            whole = None
            for _, table in _tables(rows, chosen):
                whole = table if whole is None else whole.then(table)
            columns = whole.columns()
            bare = int(not len(whole.on))
            key = rows.select([*by, "_block"]).take(np.full(len(whole.on) + bare, chosen[0])).rename_columns([*by, "_node"])
            out.append(pa.table([*key.columns, *_rule_arrays(columns, bare)], names=[*by, "_node", *RULE]))
        return pa.concat_tables(out)

    def hand_down(rows: pa.Table) -> pa.Table:
        out = []
        is_state = rows.column("_node").is_null().to_numpy()
        for chosen in in_blocks(rows):
            state = start
            for at in chosen[is_state[chosen]]:
                state = rows.column("_on")[int(at)].as_py(), rows.column("_lead")[int(at)].as_py()
            found = []
            for number, table in _tables(rows, chosen[~is_state[chosen]]):
                found.append((number, *state))
                to, rest = table.leave(np.array([state[0]]), np.array([state[1]]))
                state = int(to[0]), int(rest[0])
            key = rows.select(by).take(np.full(len(found), chosen[0]))
            columns = [pa.array(c, pa.int64()) for c in zip(*found)] or [pa.array([], pa.int64())] * 3
            out.append(pa.table([*key.columns, *columns], names=[*by, "_node", "_on", "_lead"]))
        return pa.concat_tables(out)

    levels = []
    while True:
        sizes = rules.groupBy(*by, "_node").agg(F.count(F.lit(1)).alias("_rules"))
        most = sizes.agg(F.max("_rules").alias("rules"), F.max("_node").alias("node")).first()
        width = max(2, RULES_PER_BLOCK // (most.rules or 1))
        blocks = rules.withColumn("_block", F.expr(f"_node div {width}")).withColumn(_GROUP, F.xxhash64(*by, "_block"))
        levels.append(blocks)
        if (most.node or 0) < width:
            break
        rules = settled(whole_groups(blocks, _GROUP, put_together, rule_schema))
    entries = None
    for blocks in reversed(levels):
        if entries is not None:
            entered = entries.select(*by, F.col("_node").alias("_block"), "_on", "_lead", F.xxhash64(*by, "_node").alias(_GROUP))
            blocks = blocks.unionByName(entered, allowMissingColumns=True)
        entries = whole_groups(blocks, _GROUP, hand_down, state_schema)
    return entries


def walk_all(
    layout: Layout,
    start: tuple[int, int],
    reduce_slices: Callable[[pa.Table], list[np.ndarray]],
    walk: Callable[[pa.Table, np.ndarray, np.ndarray], list[np.ndarray]],
    columns: list[str],
) -> DataFrame:
    """Run a join: ``by...`` and the long ``columns`` that ``walk`` finds.

    ``reduce_slices`` gives the rules of the slices of a table, as the arrays (row of the table, *RULE). ``walk`` gets a table with
    the state on entry of every row's slice and gives the arrays (row of the table, *columns).
    """
    by, long = layout.by, T.LongType()
    rows = layout.narrow
    if layout.sl.split:
        rule_schema = T.StructType([*layout.by_schema(), *[T.StructField(n, long) for n in ("_node", *RULE)]])

        def tabulate(part: pa.Table) -> pa.Table:
            found = [c.astype(np.int64) for c in reduce_slices(part)]
            code = codes(part, [*by, SLICE])
            first = np.unique(code, return_index=True)[1]
            bare = first[~np.isin(code[first], code[found[0]])]
            at = np.r_[found[0], bare]
            node = pa.array(numbers(part, SLICE)[at].astype(np.int64) - 1)
            return pa.table(
                [*part.select(by).take(at).columns, node, *_rule_arrays(found[1:], len(bare))], names=[*by, "_node", *RULE]
            )

        rules = whole_groups(rows.where(F.col(SLICE) > 0), _GROUP, tabulate, rule_schema)
        entries = _entries(settled(rules), by, start)
        entries = entries.withColumn(SLICE, (F.col("_node") + 1).cast("int")).drop("_node")
        rows = lookup(rows, entries, [*by, SLICE])
        first = {n: F.when(F.col(SLICE) == 0, F.lit(v)).otherwise(F.col(n)).cast("long") for n, v in zip(("_on", "_lead"), start)}
        rows = rows.withColumns(first).where(F.col("_on") >= 0)
    else:
        rows = rows.withColumns({n: F.lit(v).cast("long") for n, v in zip(("_on", "_lead"), start)})
    schema = T.StructType([*layout.by_schema(), *[T.StructField(n, long) for n in columns]])

    def run(part: pa.Table) -> pa.Table:
        at, *found = (c.astype(np.int64) for c in walk(part, numbers(part, "_on"), numbers(part, "_lead")))
        return pa.table([*part.select(by).take(at).columns, *map(pa.array, found)], names=[*by, *columns])

    return whole_groups(rows, _GROUP, run, schema)


def side_rows(layout: Layout, side: int) -> DataFrame:
    """``by..., _rank, _row<side>`` of one stream, to join values to ranks."""
    return layout.ranked.where(F.col("_side") == side).select(*layout.by, "_rank", f"_row{side}")


def join_ranks(found: DataFrame, layout: Layout, ranks: dict[str, int]) -> DataFrame:
    """Join the row of each stream to the rank columns ``name -> side``."""
    for name, side in ranks.items():
        rows = side_rows(layout, side)
        renamed = rows.select(*[F.col(c).alias(f"_k_{c}") for c in layout.by], F.col("_rank").alias("_k_rank"), f"_row{side}")
        match = found[name] == renamed["_k_rank"]
        for c in layout.by:
            match = match & found[c].eqNullSafe(renamed[f"_k_{c}"])
        found = found.join(renamed, match).drop(*[f"_k_{c}" for c in layout.by], "_k_rank")
    return found
