"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillflow.llm.common import stored, words_of

CELLS, LAST_CELL = 1024, 64 * 1024


def source_targets(sizes: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """(source_key, source_size) with `target`, shares of the total by weight, none above `cap`
    times its source; the excess goes to the others. One row per source, the only rows that meet
    in one task.

    A share t * w is capped for the sources with the smallest cap / w; with the sources in that
    order, the first k capped, the level is (total - their caps) / (weights of the rest), and the
    right k is the smallest whose level fits under the next source's cap.
    """
    rank = F.row_number().over(Window.orderBy("source_key"))
    pick = F.array(*map(F.lit, weights))
    w = sizes.withColumn("weight", F.element_at(pick, ((rank - 1) % len(weights) + 1).cast("int")).cast("long"))
    w = w.withColumn("most", F.col("source_size") * cap)
    order = Window.orderBy(F.col("most") / F.col("weight"), "source_key")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0)))
             / F.sum("weight").over(after))
    w = w.withColumn("level", level).withColumn("fits", F.col("level") <= F.col("most") / F.col("weight"))
    # the first that fits, in the same order; its level holds for all sources after it
    first = F.first(F.when(F.col("fits"), F.col("level")), ignorenulls=True).over(every)
    return w.withColumn("target", F.least(F.col("most").cast("double"), first * F.col("weight"))).select(
        "source_key", "source_size", "weight", "target")


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, seed: str = "mix") -> DataFrame:
    """Adds size, source_size, target, copies and taken (= copies * size) to every row of `docs`.

    Size is the number of words. Within its source a document's place is the hash of its id; with
    `before` the words up to and with it, its copy p (0 .. cap - 1) has the virtual finish time
    (p * source_size + before) / target. Over all sources the copies are sorted by finish time
    and taken while their words stay within the total of all sizes.

    The running sums are made of sums by (source, first hash digits) plus a window inside such a
    cell, so a source with any share of the rows is spread over 4096 tasks. The cut is found from
    sums by finish-time cell plus the order inside one cell; one row reaches the driver.
    Null text: size 0. Null source: a source of its own, after all others. Empty documents and
    tables take nothing. Rows with the same id and size may swap places, which changes no result;
    input columns with the added names are replaced.
    """
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    base = docs.withColumns({
        "size": F.size(words_of(F.col("text"))).cast("long"),
        "source_key": F.coalesce(F.concat(F.lit("0"), F.col("source")), F.lit("1")),
        "__key": key, "__bucket": F.substring(key, 1, 3)})
    narrow = stored(base.select("doc_id", "size", "source_key", "__key", "__bucket"), "mix")
    sums = narrow.groupBy("source_key", "__bucket").agg(F.sum("size").alias("s"))
    targets = source_targets(sums.groupBy("source_key").agg(F.sum("s").alias("source_size")), weights, cap)
    earlier = Window.partitionBy("source_key").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    cells = sums.withColumn("__off", F.coalesce(F.sum("s").over(earlier), F.lit(0))).drop("s").join(targets, "source_key")
    inside = (Window.partitionBy("source_key", "__bucket").orderBy("__key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    replaced = ["source_size", "weight", "target", "copies", "taken"]

    def placed(df):
        return df.drop(*replaced).join(cells, ["source_key", "__bucket"]).withColumn(
            "__before", F.col("__off") + F.sum("size").over(inside))

    def finish(p):
        return (F.col("source_size") * p + F.col("__before")) / F.col("target")

    live = (F.col("size") > 0) & (F.col("target") > 0)
    items = (placed(narrow).where(live).select("source_key", "size", "source_size", "target", "__before",
                                     F.explode(F.sequence(F.lit(0), F.lit(cap - 1))).alias("p"))
             .withColumn("f", finish(F.col("p")))
             .withColumn("cell", F.least(F.floor(F.col("f") * CELLS), F.lit(LAST_CELL)))
             .select("cell", "f", "source_key", "p", "__before", "size"))
    cut = _cut(items, targets)
    if cut is None:
        taken = F.lit(0)
    else:
        at = (F.col("source_key"), F.lit(0), F.col("__before"))
        taken = F.lit(0)
        for p in range(cap):
            f = finish(F.lit(p))
            tied = ((at[0] < cut.source_key) | ((at[0] == cut.source_key) & (
                (F.lit(p) < cut.p) | ((F.lit(p) == cut.p) & (at[2] <= cut["__before"])))))
            taken = taken + F.when(live & ((f < cut.f) | ((f == cut.f) & tied)), 1).otherwise(0)
    out = placed(base).withColumn("copies", taken.cast("int"))
    return out.withColumn("taken", F.col("copies") * F.col("size")).drop(
        "source_key", "weight", "__key", "__bucket", "__off", "__before")


def _cut(items: DataFrame, targets: DataFrame):
    """The last copy whose words still fit the budget, in the order of finish time; None if none."""
    run = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = (items.groupBy("cell").agg(F.sum("size").alias("s"))
             .withColumn("start", F.coalesce(F.sum("s").over(run), F.lit(0))))
    budget = targets.agg(F.sum("source_size").alias("budget"))
    place = cells.join(F.broadcast(budget), F.col("start") <= F.col("budget")).orderBy(F.desc("cell")).first()
    if place is None:
        return None
    order = ["f", "source_key", "p", "__before"]
    up_to = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = (items.where(F.col("cell") == place.cell)
            .withColumn("end", F.lit(place.start) + F.sum("size").over(up_to))
            .where(F.col("end") <= place.budget))
    last = here.orderBy(*map(F.desc, order)).first()
    if last is not None:
        return last
    return items.where(F.col("cell") < place.cell).orderBy(*map(F.desc, order)).first()
