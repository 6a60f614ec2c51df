"""Leaderboard change feed: a streaming query with state per nation.

Sale lines are cut into batches by arrival day, which are fed one by one to a
streaming query, started anew for each on one checkpoint.  Its state is one
revenue dictionary per nation and range of items (a nation's items are dealt
over groups, so that no group grows with the data), stored as packed numbers.
After each arrival day a max-heap with lazy deletion gives a group's ten best:
stale entries are skipped while popping ten valid ones, which are pushed back.
Groups tell what changed in their ten, and boards of whole nations are made of
these candidates by ranks of which each task sends on ten at most.

Lines are enriched before they are fed, by joins that adaptive execution splits
where a vendor or an item is hot; in the stream each task sums its own lines by
nation, item and day before they are shuffled, so a hot item costs a row a task.

Defined cases: a null in the hashed numbers is empty; an amount or price that is
not finite is read as null; a batch number below 1 counts as 1; if a vendor or
item stands twice, its least nation or price counts; repeated lines add again;
no lines give an empty feed.  Other columns are not read.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftworks.llm.common import materialise, ship_package, work_dir

FIRST_DAY, DAYS, BATCHES, LATENESS, PLACES = 19723, 180, 10, 3, 10
LINE = "batch int, day int, shipped int, nation int, item long, cents double"
PART = "nation int, range long, items binary, days binary, cents binary"
CANDIDATE = "nation int, item long, day int, cents long, ranked boolean"
STATE = "revenue binary, best binary"


def batch_of(day: Column, batches: int = BATCHES) -> Column:
    return F.greatest(F.lit(1), F.least(F.lit(batches), 1 + F.floor((day - FIRST_DAY) * batches / DAYS))).cast("int")


def finite(x: Column) -> Column:
    """A double, null where it is not a number or without bound."""
    d = x.cast("double")
    return F.when((F.abs(d) < float("inf")) & ~F.isnan(d), d)


def line_facts(lines: DataFrame) -> DataFrame:
    """vendor_id, item_id, shipped and arrival day, cents (null where the price
    decides), and the signed quantity."""
    text = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("sale_id", "item_id", "vendor_id", "line_no")])
    h = F.crc32(text.cast("binary"))
    shipped = F.coalesce(F.unix_date(F.col("shipped_at").cast("date")).cast("long"), FIRST_DAY + h % 150)
    day = shipped + h % 7 + F.when(h % 5 == 0, 20).otherwise(0)
    sign = F.when(F.col("flag") == "swapped", -1.0).otherwise(1.0)
    cents = F.floor(100 * finite(F.col("amount")) + 0.5).cast("double")
    return lines.select("vendor_id", "item_id", shipped.cast("int").alias("shipped"), day.cast("int").alias("day"), (sign * cents).alias("cents"), (sign * F.col("quantity")).alias("quantity"))


def enriched(lines: DataFrame, vendors: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of LINE; nation or item is null for lines that are ignored.

    Both joins shuffle, whatever the size of the small side: no table that grows
    is broadcast.  They are outer on the side of the lines, which adaptive
    execution may split.
    """
    nations = vendors.groupBy("vendor_id").agg(F.min("nation_id").alias("nation"))
    prices = items.where("item_id IS NOT NULL").groupBy("item_id").agg(F.min(finite(F.col("price"))).alias("price")).withColumn("item", F.col("item_id"))
    placed = line_facts(lines).join(nations.hint("merge"), "vendor_id", "left").drop("vendor_id")
    priced = placed.join(prices.hint("merge"), "item_id", "left")
    by_price = F.col("quantity") * F.floor(100 * F.col("price") + 0.5).cast("double")
    return priced.select(batch_of(F.col("day")).alias("batch"), "day", "shipped", F.col("nation").cast("int").alias("nation"), "item", F.coalesce("cents", by_price, F.lit(0.0)).alias("cents"))


def packed(numbers) -> bytes:
    import zlib

    return zlib.compress(numbers.astype("<i8").tobytes(), 1)


def unpacked(raw: bytes):
    import zlib

    import numpy as np

    return np.frombuffer(zlib.decompress(raw), "<i8")


def summed(batches, ranges: int, rows: int = 1 << 19):
    """Rows of PART: a task's lines summed by nation, item and day, one row for
    a nation and range of items out of every ``rows`` lines."""
    import numpy as np
    import pyarrow as pa

    def parts(held):
        nation, item, day, cents = (np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in held]) for c in ("nation", "item", "day", "cents"))
        spot = item % ranges
        order = np.lexsort((day, item, spot, nation))
        nation, spot, item, day, cents = nation[order], spot[order], item[order], day[order], cents[order]
        new = np.ones(len(order), bool)
        new[1:] = (nation[1:] != nation[:-1]) | (item[1:] != item[:-1]) | (day[1:] != day[:-1])
        at = np.flatnonzero(new)
        total = np.add.reduceat(cents, at).astype(np.int64)
        nation, spot, item, day = nation[at], spot[at], item[at], day[at]
        group = np.ones(len(at), bool)
        group[1:] = (nation[1:] != nation[:-1]) | (spot[1:] != spot[:-1])
        begins = np.flatnonzero(group)
        ends = np.append(begins[1:], len(at))
        lists = [[packed(x[b:e]) for b, e in zip(begins, ends)] for x in (item, day, total)]
        return pa.RecordBatch.from_arrays([pa.array(nation[begins], pa.int32()), pa.array(spot[begins], pa.int64()), *(pa.array(x, pa.binary()) for x in lists)], ["nation", "range", "items", "days", "cents"])

    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield parts(held)
            held, n = [], 0
    if n:
        yield parts(held)


class Board:
    """Revenues of a group's items, and its best by a heap with lazy deletion."""

    def __init__(self, revenue: dict[int, int], places: int = PLACES):
        import heapq

        self.revenue, self.places = revenue, places
        self.heap = [(-cents, item) for item, cents in revenue.items() if cents > 0]
        heapq.heapify(self.heap)

    def add(self, item: int, cents: int) -> None:
        import heapq

        now = self.revenue[item] = self.revenue.get(item, 0) + cents
        if now > 0 and cents:
            heapq.heappush(self.heap, (-now, item))

    def best(self) -> dict[int, int]:
        """The best items and their revenues; ties to the smaller item.  An entry
        is stale if the item has another revenue now, or was popped already."""
        import heapq

        found: dict[int, int] = {}
        while self.heap and len(found) < self.places:
            cents, item = heapq.heappop(self.heap)
            if self.revenue[item] == -cents and item not in found:
                found[item] = -cents
        for item, cents in found.items():
            heapq.heappush(self.heap, (-cents, item))
        return found


def group_changes(key, frames, state):
    """The candidates of a nation and range that changed: (day, item, cents, ranked),
    unranked where an item has left the group's best."""
    import numpy as np
    import pandas as pd

    revenue, best = {}, {}
    if state.exists:
        items, cents = (unpacked(x) for x in state.get)
        half = len(items) // 2
        revenue = dict(zip(items[:half].tolist(), items[half:].tolist()))
        half = len(cents) // 2
        best = dict(zip(cents[:half].tolist(), cents[half:].tolist()))
    by_day: dict[int, dict[int, int]] = {}
    for frame in frames:
        for items, days, cents in zip(frame["items"], frame["days"], frame["cents"]):
            for item, day, c in zip(unpacked(items).tolist(), unpacked(days).tolist(), unpacked(cents).tolist()):
                of_day = by_day.setdefault(day, {})
                of_day[item] = of_day.get(item, 0) + c
    board, rows = Board(revenue), []
    for day in sorted(by_day):
        for item, c in by_day[day].items():
            board.add(item, c)
        now = board.best()
        rows += [(day, item, c, True) for item, c in now.items() if best.get(item) != c]
        rows += [(day, item, revenue[item], False) for item in best if item not in now]
        best = now
    flat = lambda d: packed(np.array(list(d.keys()) + list(d.values()), np.int64))
    state.update((flat(dict(sorted(revenue.items()))), flat(best)))
    if rows:
        out = pd.DataFrame(rows, columns=["day", "item", "cents", "ranked"])
        out["nation"] = key[0]
        yield out[["nation", "item", "day", "cents", "ranked"]]


def candidates(lines: DataFrame, *, batches: int = BATCHES, items_per_group: int = 16384, n_items: int) -> DataFrame:
    """Rows of CANDIDATE from LINE rows by the streaming query.

    Everything lies in a new folder under ``spark.checkpoint.dir``.  The driver
    reads one row a batch: its latest shipping day.
    """
    spark = lines.sparkSession
    ship_package(spark)
    top = work_dir(spark, "board")
    path = lambda *parts: spark._jvm.org.apache.hadoop.fs.Path("/".join([top, *parts]))
    files = path().getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in ("cut", "feed", "changes"):
        files.mkdirs(path(folder))
    lines.write.mode("append").partitionBy("batch").parquet(f"{top}/cut")
    schema = "day int, shipped int, nation int, item long, cents double"
    latest = {r["batch"]: r["latest"] for r in spark.read.schema(f"{schema}, batch int").parquet(f"{top}/cut").groupBy("batch").agg(F.max("shipped").alias("latest")).collect()}
    ranges = max(1, -(-n_items // items_per_group))
    limit = None
    for k in range(1, batches + 1):
        if k in latest:
            files.rename(path("cut", f"batch={k}"), path("feed", f"part-{k:04d}"))
        feed = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{top}/feed")
        on_time = feed if limit is None else feed.where(F.col("shipped") + LATENESS >= F.lit(limit))
        parts = on_time.where("nation IS NOT NULL AND item IS NOT NULL").select("nation", "item", "day", "cents").mapInArrow(partial(summed, ranges=ranges), PART)
        changes = parts.groupBy("nation", "range").applyInPandasWithState(group_changes, CANDIDATE, STATE, "append", "NoTimeout")
        changes.writeStream.format("parquet").option("path", f"{top}/changes").option("checkpointLocation", f"{top}/checkpoint").trigger(availableNow=True).start().awaitTermination()
        if k in latest:
            limit = latest[k] if limit is None else max(limit, latest[k])
    return spark.read.schema(CANDIDATE).parquet(f"{top}/changes")


def boards(changes: DataFrame, places: int = PLACES) -> DataFrame:
    """nation, day, item, rank, cents: the boards after every day.

    A candidate holds from its day to the one before its item's next; days on
    which nothing arrives repeat the board before and so change nothing.
    """
    last = changes.agg(F.max("day").alias("last_day"))  # one row
    until = F.lead("day").over(Window.partitionBy("nation", "item").orderBy("day"))
    held = changes.withColumn("until", until).where("ranked").crossJoin(F.broadcast(last))
    daily = held.select("nation", "item", "cents", F.explode(F.sequence("day", F.coalesce(F.col("until") - 1, F.col("last_day")))).alias("day"))
    order = Window.partitionBy("nation", "day").orderBy(F.desc("cents"), "item")
    return daily.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= places)


def change_feed(lines: DataFrame, vendors: DataFrame, items: DataFrame, *, batches: int = BATCHES, items_per_group: int = 16384) -> DataFrame:
    """nation_id, arrival_day, item_id, batch, change, old_rank, new_rank and
    revenue (cents) of every item whose rank differs from the previous board."""
    n_items = items.count()
    changes = candidates(enriched(lines, vendors, items), batches=batches, items_per_group=items_per_group, n_items=n_items)
    board = materialise(boards(changes), "boards")
    now = board.select("nation", "day", "item", F.col("rank").alias("new_rank"), F.col("cents").alias("now"))
    # the board of the last day needs no successor
    last = board.agg(F.max("day").alias("last_day"))
    before = board.select("nation", (F.col("day") + 1).alias("day"), "item", F.col("rank").alias("old_rank")).crossJoin(F.broadcast(last)).where("day <= last_day").drop("last_day")
    moved = before.join(now, ["nation", "day", "item"], "full").where("NOT (old_rank <=> new_rank)")
    # an item that leaves the board has its revenue among the changes of that day or before
    known = changes.select("nation", "item", F.col("day").alias("from"), F.col("cents").alias("then"))
    gone = moved.where("new_rank IS NULL").join(known, ["nation", "item"]).where("from <= day").groupBy("nation", "day", "item", "old_rank").agg(F.max_by("then", "from").alias("revenue"))
    there = moved.where("new_rank IS NOT NULL").select("nation", "day", "item", "old_rank", "new_rank", F.col("now").alias("revenue"))
    rows = there.unionByName(gone.withColumn("new_rank", F.lit(None).cast("int")))
    change = F.when(F.col("old_rank").isNull(), "enter").when(F.col("new_rank").isNull(), "exit").otherwise("move")
    return rows.select(F.col("nation").alias("nation_id"), F.col("day").cast("long").alias("arrival_day"), F.col("item").alias("item_id"), batch_of(F.col("day"), batches).alias("batch"), change.alias("change"), "old_rank", "new_rank", "revenue")
