"""Sequences of events per customer, from a table of steps.

A pattern is a small automaton: its state says, for each number of steps, when the latest run that has done them
began. An event moves that state on. What a whole piece of a customer's events does to the state is such a move too:
every entry of the state after the piece either began in it, or is an entry of the state before it. So each piece is
worked off by itself, from a state of which only the names of the entries are known; the moves of the pieces are
put together, a row for each piece; and what a piece left open is filled in. A customer with any share of
the events is as many tasks as it has pieces. ``streaming.patterns`` drives keyed state by the same steps.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from etalage.functions.columns import micros
from etalage.operators.ordered import at_edges, crossings, joined, placed

SECOND = 1_000_000


@dataclass(frozen=True)
class Step:
    """A condition on an event (SQL), and columns whose values differ from those of the key's event before."""

    where: str = "true"
    changed: tuple[str, ...] = ()


@dataclass(frozen=True)
class Pattern:
    """``steps`` in their order, from the first to the last in ``within`` seconds.

    ``strict``: they are events next to each other; else others may lie between. ``unless`` (SQL): an event that ends all
    runs and is no step. ``absent``: two steps, of which the second does not come within the time after the first.
    Of several runs that an event ends, the one that began last counts.
    """

    name: str
    steps: tuple[Step, ...]
    within: int
    strict: bool = False
    unless: str | None = None
    absent: bool = False

    def __post_init__(self):
        if len(self.steps) < 2 or (self.strict and self.unless) or (self.absent and (len(self.steps) > 2 or self.strict or self.unless)):
            raise ValueError(f"{self.name}: such a pattern has no meaning")

    @property
    def compared(self) -> tuple[str, ...]:
        """Columns that are compared with the event before."""
        return tuple(sorted({c for s in self.steps for c in s.changed}))


def _differs(column: str) -> Column:
    return F.coalesce(F.col(column) != F.col(f"_prev_{column}"), F.lit(False))


def _hit(step: Step) -> Column:
    found = F.coalesce(F.expr(step.where), F.lit(False))
    for c in step.changed:
        found = found & _differs(c)
    return found


def _begun() -> Column:
    return F.struct(F.col("_at").alias("at"), F.col("_id").alias("id"), F.lit(0).alias("entry"))


def _entry(i: int) -> Column:
    """The i-th entry of the state before the piece, whatever it is."""
    return F.struct(F.lit(0).cast("bigint").alias("at"), F.lit(0).cast("bigint").alias("id"), F.lit(i).alias("entry"))


def _advanced(rows: DataFrame, key: str, steps: int, strict: bool) -> DataFrame:
    """``_b1`` .. : the state before each event of a piece; ``_u``: the last event before it that ended all runs.
    ``_e1`` .. and ``_v``: the same after it."""
    here = Window.partitionBy(key, "_piece").orderBy("_at", "_id")
    before = here.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_first", F.row_number().over(here) == 1)
    rows = rows.withColumn("_u", F.last(F.when(F.col("_unless"), _begun()), ignorenulls=True).over(before))
    for i in range(1, steps):
        does = F.when(F.col(f"_c{i}"), _begun() if i == 1 else F.col(f"_b{i - 1}"))
        if strict:
            rows = rows.withColumn(f"_e{i}", does)
            state = F.when(F.col("_first"), _entry(i)).otherwise(F.lag(f"_e{i}").over(here))
        else:
            rows = rows.withColumn("_does", does)
            state = F.coalesce(F.last("_does", ignorenulls=True).over(before), _entry(i))
        rows = rows.withColumn(f"_b{i}", state)
        if not strict:
            rows = rows.withColumn(f"_e{i}", F.coalesce("_does", f"_b{i}"))
    return rows.withColumn("_v", F.when(F.col("_unless"), _begun()).otherwise(F.col("_u"))).drop("_first", "_does")


def _alive(run: Column, ended: Column) -> Column:
    """A run that began after all runs were ended last; one from before the piece, if they were not."""
    return F.when(ended.isNull() | ((run["entry"] == 0) & (F.struct(run["at"], run["id"]) > F.struct(ended["at"], ended["id"]))), run)


def _filled(run: Column, i: int, state: Column, strict: bool) -> Column:
    """A run that is an entry of the state before: that entry, or, where others may lie between, the first one known
    from it up to the i-th (a run that has done more steps has done these as well)."""
    out = F.when(run["entry"] == 0, run)
    for j in range(1, i + 1):
        known = state[j - 1] if strict else F.coalesce(*[state[k - 1] for k in range(j, i + 1)])
        out = out.when(run["entry"] == j, known)
    return out


def _carried(summaries: DataFrame, key: str, steps: int, strict: bool) -> DataFrame:
    """The state that each piece begins with, from the moves of the pieces of a key before it: a row a piece."""
    entry = "struct<at:bigint,id:bigint,entry:int>"
    nothing = F.array(*[F.lit(None).cast(entry) for _ in range(1, steps)])
    start = F.struct(nothing.alias("state"), F.array().cast(f"array<struct<_next:int,_state:array<{entry}>>>").alias("out"))

    def move(acc: Column, piece: Column) -> Column:
        state = F.array(*[_filled(piece["moves"][i - 1], i, acc["state"], strict) for i in range(1, steps)])
        return F.struct(state.alias("state"), F.concat(acc["out"], F.array(F.struct(piece["_next"].alias("_next"), state.alias("_state")))).alias("out"))

    lists = summaries.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_piece", "_next", "moves"))).alias("pieces"))
    return lists.select(key, F.inline(F.aggregate("pieces", start, move)["out"]))


def matches(df: DataFrame, key: str, ts: str, order: str, pattern: Pattern, upto: Column | None = None, pieces: int | None = None) -> DataFrame:
    """key, ``order``, started and ended of each event that ends a run of the pattern.

    For an absent second step: each first step that none follows in time, if the time had run out by ``upto``
    (default: all). Events are ordered by ``ts``, then ``order`` (a whole number); those without a time are left out.
    """
    sign = -1 if pattern.absent else 1  # what does not follow is what does not come before, in time reversed
    if pattern.absent and pattern.compared:
        # Reversed, the event before would be the one after.
        raise ValueError(f"{pattern.name}: an absent step cannot be compared with the event before")
    steps = pattern.steps[::sign]
    n = len(steps)
    hits = {} if pattern.compared else {f"_c{i}": _hit(s) for i, s in enumerate(steps, 1)}
    unless = F.coalesce(F.expr(pattern.unless), F.lit(False)) if pattern.unless else F.lit(False)
    rows = df.where(F.col(ts).isNotNull()).withColumns(
        {"_at": sign * micros(ts), "_id": sign * F.col(order).cast("bigint"), "_unless": unless, **hits}
    )
    plain = {f"_w{i}": F.coalesce(F.expr(s.where), F.lit(False)) for i, s in enumerate(steps, 1)} if pattern.compared else {}
    rows = rows.withColumns(plain).select(key, "_at", "_id", "_unless", *hits, *plain, *pattern.compared)
    rows = placed(rows, key, F.col("_at"), pieces)
    cross = crossings(rows, key)
    edges = at_edges(rows, key, cross)
    if pattern.compared:
        last = F.max_by(F.struct(*[F.col(c).alias(f"_prev_{c}") for c in pattern.compared]), F.struct("_at", "_id"))
        ends = edges.groupBy(key, "_piece", "_next").agg(last.alias("_last")).select(key, "_next", "_last")
        line = Window.partitionBy(key, "_piece").orderBy("_at", "_id")

        def compared(part: DataFrame) -> DataFrame:
            here = F.lag(F.struct(*[F.col(c).alias(f"_prev_{c}") for c in pattern.compared])).over(line)
            found = joined(part.withColumn("_here", here), key, ends).withColumn("_here", F.coalesce("_here", "_last"))
            found = found.select("*", "_here.*").drop("_here", "_last")
            for i, s in enumerate(steps, 1):
                hit = F.col(f"_w{i}")
                for c in s.changed:
                    hit = hit & _differs(c)
                found = found.withColumn(f"_c{i}", hit & ~F.col("_unless"))
            return found

        rows, edges = compared(rows), compared(edges)
    elif pattern.unless:
        calm = {f"_c{i}": F.col(f"_c{i}") & ~F.col("_unless") for i in range(1, n + 1)}
        rows, edges = rows.withColumns(calm), edges.withColumns(calm)

    after = F.struct(*[_alive(F.col(f"_e{i}"), F.col("_v")).alias(f"m{i}") for i in range(1, n)])
    summaries = (
        _advanced(edges, key, n, pattern.strict)
        .groupBy(key, "_piece", "_next")
        .agg(F.max_by(after, F.struct("_at", "_id")).alias("m"))
        .select(key, "_piece", "_next", F.array(*[F.col(f"m.m{i}") for i in range(1, n)]).alias("moves"))
    )
    carried = _carried(summaries, key, n, pattern.strict)
    found = joined(_advanced(rows, key, n, pattern.strict).where(f"_c{n}"), key, carried)
    run = _filled(_alive(F.col(f"_b{n - 1}"), F.col("_u")), n - 1, F.col("_state"), pattern.strict)
    found = found.withColumn("_run", run)
    in_time = F.coalesce(F.col("_at") - F.col("_run.at") <= pattern.within * SECOND, F.lit(False))
    if pattern.absent:
        began = -F.col("_at")
        done = F.lit(True) if upto is None else began + pattern.within * SECOND <= upto
        return found.where(~in_time & done).select(
            key, (-F.col("_id")).alias(order), F.timestamp_micros(began).alias("started"), F.timestamp_micros(began + pattern.within * SECOND).alias("ended")
        )
    return found.where(in_time).select(
        key, F.col("_id").alias(order), F.timestamp_micros("_run.at").alias("started"), F.timestamp_micros("_at").alias("ended")
    )
