"""Trailing-window activity on every event: global counts, distinct users, per-user bursts."""

from __future__ import annotations

from functools import reduce
from math import gcd

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.timefn import MINUTE, SECOND, cell, micros
from .skew import attach

# Horizon name and seconds.
HORIZONS = {"5min": 300, "1hour": 3600}


def _so_far(value: str, w, last: int) -> Column:
    """Sum of value over all positions up to here + last."""
    return F.coalesce(F.sum(F.expr(value)).over(w.rangeBetween(W.unboundedPreceding, last)), F.expr("0L"))


def _span_sum(value: str, w, first: int, last: int) -> Column:
    """Sum over positions [here + first, here + last] as a difference of two running sums.

    A frame with two moving ends is summed anew for every row; running sums are not.
    """
    return _so_far(value, w, last) - _so_far(value, w, first - 1)


def _cells(points: DataFrame, changes: list[DataFrame], horizons: dict[str, int], size: int,
           counts: bool) -> DataFrame:
    """What lies before each cell: `_whole_<h>` events in the h seconds before it, `_there_<h>`
    users present. The window has one row per cell (half a million a year for minutes), so it
    needs no partitioning; the rows it stands for have been summed up before."""
    n = points.groupBy(cell("_us", size).alias("_cell")).agg(F.count("*").alias("_w"))
    names = [c for d in changes for c in d.columns if c != "_cell"]
    line = reduce(lambda a, d: a.unionByName(d, allowMissingColumns=True), [n, *changes])
    if names:
        line = line.groupBy("_cell").agg(
            *[F.expr(f"coalesce(sum({c}), 0L) AS {c}") for c in ["_w", *names]])
    w = W.partitionBy().orderBy("_cell")
    out = [_so_far(c, w, -1).alias(c) for c in names]
    if counts:
        out += [_span_sum("_w", w, -s * SECOND, -size).alias(f"_whole_{h}")
                for h, s in horizons.items()]
    return line.select("_cell", *out)


def _presence(points: DataFrame, horizons: dict[str, int]) -> dict[str, DataFrame]:
    """Per horizon: (pos, starts, ends) of users being present.

    A user is present from an event until h after it; presences that touch are one. Events in the
    same cell of length h always touch, so the first and last event per (user, cell) describe the
    cell, and only a gap longer than h to the next cell ends a presence. Cells of a longer horizon
    are built from those of a shorter one that divides it.
    """
    out, cells, done = {}, None, 0
    base = points.where("_user IS NOT NULL").selectExpr("_user", "_us AS _first", "_us AS _last")
    for h, s in sorted(horizons.items(), key=lambda x: x[1]):
        size = s * SECOND
        finer = cells if done and size % done == 0 else base
        cells = finer.groupBy("_user", cell("_first", size).alias("_cell")).agg(
            F.min("_first").alias("_first"), F.max("_last").alias("_last"))
        done = size
        over = "OVER (PARTITION BY _user ORDER BY _first)"
        out[h] = cells.selectExpr(
            f"CASE WHEN _first - lag(_last) {over} <= {size} THEN null ELSE _first END AS _opens",
            f"CASE WHEN lead(_first) {over} - _last <= {size} THEN null "
            f"ELSE _last + {size} END AS _closes",
        ).selectExpr(
            "inline(array(struct(_opens AS _us, 1 AS _in, 0 AS _out), "
            "struct(_closes AS _us, 0 AS _in, 1 AS _out)))"
        ).where("_us IS NOT NULL").groupBy("_us").agg(
            F.sum("_in").alias(f"_start_{h}"), F.sum("_out").alias(f"_end_{h}"))
    return out


def trailing_activity(events: DataFrame, horizons: dict[str, int] = HORIZONS, counts: bool = True,
                      users: bool = True, ts: str = "timestamp", user: str = "user_id",
                      event_id: str = "id", base: DataFrame | None = None) -> DataFrame:
    """Adds events_<h> and unique_users_<h>: activity in [t - h, t] over all users, t inclusive.

    Both depend on t alone, so they are computed once per distinct t and attached to the events.
    The time line is cut into cells (a minute, or less if a horizon asks for it). Inside a cell,
    what enters (<= t) and what leaves (< t) the window is counted in order; everything before the
    cell comes from totals per cell. Events leave h after they entered, users h after the last
    event of an unbroken presence. The work is linear in the number of events for any horizon, no
    window is larger than the distinct times of one cell, and no sets of users are built.
    `base` may give the same rows before other columns were added: the counts are taken there.
    """
    size = gcd(60, *horizons.values()) * SECOND
    us = micros(ts)
    points = (events if base is None else base).where(us.isNotNull()).select(us.alias("_us"), F.col(user).alias("_user"))
    stamps = points.groupBy("_us").agg(F.count("*").alias("_n"))
    moves, changes, inside, total = [stamps], [], {}, {}
    w = W.partitionBy("_cell").orderBy("_us")
    if counts:
        leaves = [(s * SECOND, [f"{'_n' if g == h else '0L'} AS _out_{g}" for g in horizons])
                  for h, s in horizons.items()]
        moves = [stamps.selectExpr("inline(array({}))".format(", ".join(
            [f"struct(_us, _n, {', '.join(f'0L AS _out_{g}' for g in horizons)})"]
            + [f"struct(_us + {s} AS _us, 0L AS _n, {', '.join(out)})" for s, out in leaves])))]
        for h in horizons:
            inside[f"events_{h}"] = _so_far("_n", w, 0) - _so_far(f"_out_{h}", w, -1)
            total[f"events_{h}"] = f"_whole_{h}"
    if users:
        for h, edges in _presence(points, horizons).items():
            moves.append(edges)
            changes.append(edges.groupBy(cell("_us", size).alias("_cell")).agg(
                F.expr(f"sum(_start_{h}) - sum(_end_{h}) AS _there_{h}")))
            inside[f"unique_users_{h}"] = _so_far(f"_start_{h}", w, 0) - _so_far(f"_end_{h}", w, -1)
            total[f"unique_users_{h}"] = f"_there_{h}"
    at = (
        reduce(lambda a, d: a.unionByName(d, allowMissingColumns=True), moves)
        .withColumn("_cell", cell("_us", size))
        .withColumns(inside).where("_n > 0")
        .join(_cells(points, changes, horizons, size, counts), "_cell", "left")
        .selectExpr("_us", "_n", *[f"{c} + {before} AS {c}" for c, before in total.items()])
    )
    return attach(events.withColumn("_us", us), at, ["_us"], "_n", [event_id],
                  sizes=stamps).drop("_us", "_n")


def bursts(events: DataFrame, span_seconds: int = 60, factor: int = 3, history: int = 10,
           ts: str = "timestamp", user: str = "user_id", event_id: str = "id",
           base: DataFrame | None = None) -> DataFrame:
    """Flags events whose user is suddenly much busier than over the previous `history` events.

    current_events: the user's events in [t - span, t]; avg_events: mean of that number over the
    user's previous `history` events, null for the first; is_anomaly: current > factor * avg.

    Rows are partitioned by (user, cell of time), so one very busy user is spread over as many
    tasks as there are cells. Every row is also sent, without its payload, to the cell one span
    later, where it leaves the window; whole cells in between come from per-cell counts. The last
    `history` rows before a cell travel as one short array per cell. `base` may give the same rows
    before other columns were added: counts and leaving rows come from there.
    """
    span = span_seconds * SECOND
    size = MINUTE if span % MINUTE == 0 else span
    keys = [user, "_cell"]

    def in_cells(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_us", micros(ts)).withColumn("_cell", cell("_us", size))

    own = in_cells(events)
    slim = own if base is None else in_cells(base.select(user, ts))
    counts = slim.groupBy(*keys).agg(F.count("*").alias("_n"))
    whole = counts.select(*keys, _span_sum(
        "_n", W.partitionBy(user).orderBy("_cell"), -span, -size).alias("_whole"))
    leaving = slim.select(user, (F.col("_us") + span).alias("_us"),
                         (F.col("_cell") + span).alias("_cell"), F.lit(1).alias("_out"))
    order = W.partitionBy(*keys).orderBy("_us")
    rows = W.partitionBy(*keys).orderBy("_us", event_id)
    counted = (
        own.withColumn("_out", F.lit(0))
        .unionByName(leaving, allowMissingColumns=True)
        # One sort serves both windows below.
        .repartition(*keys).sortWithinPartitions(*keys, "_us", event_id)
        .withColumn("_inside", _so_far("1 - _out", order, 0) - _so_far("_out", order, -1))
        .where("_out = 0")
        .join(whole, keys, "left")
        .withColumn("current_events", F.col("_inside") + F.col("_whole"))
        .drop("_out", "_inside", "_whole")
        .withColumns({
            "_sum": F.coalesce(F.sum("current_events").over(rows.rowsBetween(-history, -1)),
                               F.expr("0L")),
            "_prev": F.count("current_events").over(rows.rowsBetween(-history, -1)),
            "_late": F.lead(F.lit(1), history).over(rows).isNull(),
        })
    )
    tails = (
        counted.where("_late").groupBy(*keys)
        .agg(F.sort_array(F.collect_list(F.struct("_us", event_id, "current_events")))
             .alias("_tail"))
        .withColumn("_before", F.flatten(F.collect_list("_tail").over(
            W.partitionBy(user).orderBy("_cell").rowsBetween(-history, -1))))
        .selectExpr(user, "_cell", f"slice(reverse(_before.current_events), 1, {history}) AS _halo")
    )
    return (
        counted.drop("_late").join(tails, keys, "left")
        .withColumn("_take", F.expr(f"slice(_halo, 1, cast({history} - _prev AS int))"))
        .withColumns({
            "_sum": F.expr("_sum + aggregate(_take, 0L, (a, x) -> a + x)"),
            "_prev": F.expr("_prev + size(_take)"),
        })
        .withColumns({
            "avg_events": F.expr("cast(_sum AS double) / nullif(_prev, 0L)"),
            "is_anomaly": F.expr(
                f"coalesce(_prev > 0 AND current_events * _prev > {factor} * _sum, false)"),
        })
        .drop("_us", "_cell", "_sum", "_prev", "_halo", "_take")
    )
