"""Window layout that stays balanced when one entity holds much of the panel.

An ordinary panel runs on ``partitionBy(entity).orderBy(time)``: one exchange, one
sort. An entity whose history is too long for one task is cut into pieces of about
equal row counts instead, at times that a sketch of its history proposes. Windows then
run per (entity, piece), and every piece receives copies of the rows just before and
after it, as many as the deepest window looks back or ahead, so results equal those of
the uncut window whatever the sketch says. The copies are removed again. Only the rows
of over-long entities take that way; all others keep the plain window.

``measure`` decides which entities are cut. It keeps at most ``MAX_HOT`` names and as
many cut times on the driver. A NULL entity is an entity like others.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

from barloom.schema import KEYS, Keys
from barloom.sources.shared import write_shared

ROWS_PER_TASK = 4_000_000
MAX_HOT = 100_000
SAMPLE_A_PIECE = 64

PIECE = "_piece"
COPY = "_copy"
_RANK = "_rank"


@dataclass(frozen=True)
class Layout:
    """Row total and, for each over-long entity, the times (microseconds) at which its history is cut.

    ``bursts`` holds second cuts: for an entity and one of its times (None: no time) that more bars share than a task
    takes, the values of the tie columns at which these bars are cut. ``longest`` is the row number of the longest entity.
    """

    rows: int
    rows_per_task: int = ROWS_PER_TASK
    cuts: tuple[tuple[str | None, tuple[int, ...]], ...] = ()
    bursts: tuple[tuple[str | None, int | None, tuple[tuple, ...]], ...] = ()
    longest: int | None = field(default=None, compare=False)

    @property
    def fits_one_task(self) -> bool:
        return self.rows <= self.rows_per_task


def clock(df: DataFrame, time: str) -> Column:
    """Microseconds that order like the time column, without any time-zone conversion of wall clocks."""
    kind = df.schema[time].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(time)
    day = F.unix_date(F.to_date(time)).cast("long") * 86_400_000_000
    if isinstance(kind, T.DateType):
        return day
    seconds = F.hour(time) * 3600 + F.minute(time) * 60
    micros = (F.extract(F.lit("SECOND"), F.col(time)) * 1_000_000).cast("long")
    return day + seconds.cast("long") * 1_000_000 + micros


def measure(
    df: DataFrame,
    keys: Keys = KEYS,
    rows_per_task: int = ROWS_PER_TASK,
) -> Layout:
    """Count rows per entity and choose cut times for entities above ``rows_per_task``.

    One job when nothing is over-long. The limit is raised so that at most ``MAX_HOT``
    entities can exceed it: fewer than total / limit entities can hold more than limit rows.
    Where ``keys`` names tie columns, bars of one time are cut as well; bars equal in all of them stay together.
    """
    tied = F.struct(*[F.col(c) for c in keys.ties]).alias("tied") if keys.ties else F.lit(None).alias("tied")
    base = df.select(F.col(keys.entity).cast("string").alias("entity"), clock(df, keys.time).alias("at"), tied)
    per_entity = base.groupBy("entity").agg(F.count(F.lit(1)).alias("n"))
    total, longest = per_entity.agg(F.sum("n"), F.max("n")).first()
    total = total or 0
    if not total or longest <= rows_per_task:
        return Layout(total, rows_per_task, longest=longest)
    limit = max(rows_per_task, total // MAX_HOT)
    hot = {r.entity: -(-r.n // limit) for r in per_entity.filter(F.col("n") > limit).collect()}
    cuts = dict(_cut_times(base, hot))
    bursts = _burst_cuts(base, list(hot), limit) if keys.ties else ()
    for entity, at, _ in bursts:
        if at is not None:
            cuts[entity] = tuple(sorted({*cuts[entity], at - 1, at}))
    return Layout(total, rows_per_task, tuple(sorted(cuts.items(), key=_by_name)), bursts, longest)


def _by_name(row: tuple) -> tuple[bool, str]:
    return row[0] is not None, row[0] or ""


def _burst_cuts(base: DataFrame, hot: list[str | None], limit: int) -> tuple[tuple[str | None, int | None, tuple[tuple, ...]], ...]:
    """Tie values that cut the bars of one time into pieces of about ``limit``.

    They come from a sample by hash, a fixed number of bars a piece, and set the balance only. Fewer than total / limit
    times can hold more bars than the limit, and each brings as many cuts as it has pieces.
    """
    names = F.broadcast(base.sparkSession.createDataFrame([(e,) for e in hot], "hot string"))
    rows = base.join(names, F.col("entity").eqNullSafe(F.col("hot"))).drop("hot")
    crowded = rows.groupBy("entity", "at").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)
    crowded = F.broadcast(crowded.select(F.col("entity").alias("_e"), F.col("at").alias("_t"), F.ceil(F.col("n") / limit).alias("pieces")))
    same = F.col("entity").eqNullSafe(F.col("_e")) & F.col("at").eqNullSafe(F.col("_t"))
    held = rows.join(crowded, same).select("entity", "at", "tied", "pieces").distinct()
    by_hash = Window.partitionBy("entity", "at").orderBy(F.xxhash64("tied"), "tied")
    sample = held.withColumn("rank", F.row_number().over(by_hash)).where(F.col("rank") <= SAMPLE_A_PIECE * F.col("pieces"))
    ordered = sample.groupBy("entity", "at").agg(F.array_sort(F.collect_list("tied")).alias("s"), F.first("pieces").alias("pieces"))
    place = F.transform(F.sequence(F.lit(1), F.col("pieces") - 1), lambda k: F.col("s")[(k * F.size("s") / F.col("pieces")).cast("int")])
    found = ordered.select("entity", "at", F.array_distinct(place).alias("cuts")).collect()
    return tuple(sorted(((r.entity, r["at"], tuple(map(tuple, r.cuts))) for r in found), key=lambda b: (*_by_name(b), b[1] is not None, b[1] or 0)))


def _cut_times(base: DataFrame, pieces: dict[str | None, int]) -> tuple[tuple[str | None, tuple[int, ...]], ...]:
    """Times between pieces of about equal counts, one sketch job for entities of similar piece numbers."""
    spark = base.sparkSession
    classes: dict[int, list[str | None]] = {}
    for entity, n in pieces.items():
        classes.setdefault(1 << (n - 1).bit_length(), []).append(entity)
    out = []
    for n, entities in sorted(classes.items()):
        names = F.broadcast(spark.createDataFrame([(e,) for e in entities], "hot string"))
        shares = [k / n for k in range(1, n)]
        sketch = F.percentile_approx("at", shares, max(10_000, 20 * n))
        rows = base.join(names, F.col("entity").eqNullSafe(F.col("hot"))).groupBy("entity").agg(sketch.alias("cuts"))
        out += [(r.entity, tuple(sorted({*(r.cuts or [])}))) for r in rows.collect()]
    return tuple(sorted(out, key=_by_name))


def _hot_rows(df: DataFrame, layout: Layout, keys: Keys, hot: bool) -> DataFrame:
    """Rows of the over-long entities with their piece, or all other rows."""
    table = F.broadcast(df.sparkSession.createDataFrame(list(layout.cuts), "_hot string, _cuts array<long>"))
    same = F.col(keys.entity).cast("string").eqNullSafe(F.col("_hot"))
    if not hot:
        return df.join(table, same, "left_anti")
    at = clock(df, keys.time)
    whole = F.when(at.isNull(), 0).otherwise(F.size(F.filter("_cuts", lambda c: c < at)) + 1).cast("long")
    rows = df.join(table, same).withColumn(PIECE, whole * F.lit(1 << 32)).drop("_cuts")
    if not layout.bursts:
        return rows.drop("_hot")
    ties = T.StructType([df.schema[c] for c in keys.ties])
    schema = T.StructType([
        T.StructField("_burst", T.StringType()), T.StructField("_at", T.LongType()), T.StructField("_ties", T.ArrayType(ties)),
    ])
    second = F.broadcast(df.sparkSession.createDataFrame([(e, t, list(c)) for e, t, c in layout.bursts], schema))
    tied = F.struct(*[F.col(c) for c in keys.ties])
    part = F.coalesce(F.size(F.filter("_ties", lambda c: c < tied)), F.lit(0))
    crowded = F.col("_hot").eqNullSafe(F.col("_burst")) & at.eqNullSafe(F.col("_at"))
    return rows.join(second, crowded, "left").withColumn(PIECE, F.col(PIECE) + part).drop("_hot", "_burst", "_at", "_ties")


def _pieces(hot: DataFrame, group: list[str]) -> DataFrame:
    """One row per piece with the number of its entity's rows before and through it."""
    w = Window.partitionBy(*group).orderBy(PIECE)
    return (
        hot.groupBy(*group, PIECE)
        .agg(F.count(F.lit(1)).alias("_in"))
        .withColumn("_through", F.sum("_in").over(w))
        .withColumn("_before", F.col("_through") - F.col("_in"))
    )


def _copies(df: DataFrame, hot: DataFrame, group: list[str], keys: Keys, depth: int, ahead: bool) -> DataFrame:
    """Rows near a piece border, copied to each later (or earlier) piece whose windows reach them.

    Row counts decide who needs a copy, so short and empty pieces are handled exactly.
    At most ``depth`` rows leave a piece, each for at most ``depth`` others.
    """
    w = Window.partitionBy(*group).orderBy(PIECE)
    order = [F.col(c) if ahead else F.col(c).desc() for c in keys.order]
    edge = hot.withColumn(
        _RANK, F.row_number().over(Window.partitionBy(*group, PIECE).orderBy(*order))
    ).filter(F.col(_RANK) <= depth)
    if ahead:
        near = F.collect_list(F.struct(PIECE, F.col("_through").alias("edge"))).over(w.rowsBetween(-depth, -1))
    else:
        near = F.collect_list(F.struct(PIECE, F.col("_before").alias("edge"))).over(w.rowsBetween(1, depth))
    own = F.col("_before") if ahead else F.col("_through")
    targets = _pieces(hot, group).select(*group, PIECE, own.alias("_own"), near.alias("_near"))
    reach = F.filter(
        "_near", lambda t: F.abs(t["edge"] - F.col("_own")) + F.col(_RANK) - 1 < depth
    )
    return (
        edge.join(targets, _same(edge, targets, [*group, PIECE]))
        .withColumn("_to", F.explode(reach))
        .select(*[edge[c] for c in df.columns], F.col("_to")[PIECE].alias(PIECE), F.lit(True).alias(COPY))
    )


def _same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


def over_history(
    df: DataFrame,
    compute: Callable[[DataFrame, WindowSpec], DataFrame],
    back: int,
    ahead: int = 0,
    layout: Layout | None = None,
    keys: Keys = KEYS,
    also: tuple[str, ...] = (),
) -> DataFrame:
    """Apply ``compute(df, window)`` where the window is one entity's history in time order.

    ``compute`` may add columns but must not drop rows. ``back`` and ``ahead`` are the
    furthest rows any chain of its expressions reads. ``also`` names further grouping columns.
    """
    group = [keys.entity, *also]
    if layout is None or not layout.cuts:
        return compute(df, Window.partitionBy(*group).orderBy(*keys.order))
    plain = compute(_hot_rows(df, layout, keys, False), Window.partitionBy(*group).orderBy(*keys.order))
    hot, _ = write_shared(_hot_rows(df, layout, keys, True), "long-histories")
    parts = hot.select(*df.columns, PIECE, F.lit(False).alias(COPY))
    if back:
        parts = parts.unionByName(_copies(df, hot, group, keys, back, ahead=False))
    if ahead:
        parts = parts.unionByName(_copies(df, hot, group, keys, ahead, ahead=True))
    done = compute(parts, Window.partitionBy(*group, PIECE).orderBy(*keys.order))
    return plain.unionByName(done.filter(~F.col(COPY)).drop(PIECE, COPY))


def with_position(
    df: DataFrame,
    layout: Layout | None = None,
    keys: Keys = KEYS,
    position: str = "_pos",
    size: str = "_size",
) -> DataFrame:
    """Add each row's 1-based position in its entity's history and the history's length."""
    w = Window.partitionBy(keys.entity)
    whole = {position: F.row_number().over(w.orderBy(*keys.order)), size: F.count(F.lit(1)).over(w)}
    if layout is None or not layout.cuts:
        return df.withColumns(whole)
    plain = _hot_rows(df, layout, keys, False).withColumns(whole)
    hot, _ = write_shared(_hot_rows(df, layout, keys, True), "long-histories")
    pieces = _pieces(hot, [keys.entity]).select(
        keys.entity, PIECE, "_before", F.sum("_in").over(w).alias("_total")
    )
    local = Window.partitionBy(keys.entity, PIECE).orderBy(*keys.order)
    ranked = hot.withColumn(_RANK, F.row_number().over(local))
    placed = ranked.join(pieces, _same(ranked, pieces, [keys.entity, PIECE])).select(
        *[ranked[c] for c in df.columns],
        (F.col("_before") + F.col(_RANK)).alias(position),
        F.col("_total").alias(size),
    )
    return plain.unionByName(placed)
