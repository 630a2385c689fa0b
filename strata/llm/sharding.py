"""Sharding by balanced label propagation.

Documents that belong together (equal ``group`` values) are linked.  They
start dealt evenly over the shards.  Each round, Spark joins tell every linked
document where its neighbours are, and it proposes to move to the shard most of them
are in (ties by a hash that differs each round).  From the proposals' totals, a number for each pair of shards,
follows how many each pair may exchange so that no shard exceeds its quota: full shards
swap rows.  So many are accepted, in seeded order.  Each accepted row adds to a group's
largest part, so the rounds end; they go on until nothing moves twice.  Then groups that are
still cut and whose rest fits into one of their shards gather there, until none is left
that fits.  Documents that move alike (same group, same shard) are one counted row, so a
group that holds a third of all rows is eight rows, and its neighbours are never
listed pair by pair.

What then is still cut - groups larger than a shard, or than any shard's rest - is packed:
whole groups, largest first, into the tightest shard that holds them.  If that still cuts
more than group sizes ask for, all linked groups are packed anew, and the better plan
counts.  Only a group larger than a shard, or one that fits no shard's rest, is split,
over as few shards as hold it.  The plan is made from counts by group size (a row a
distinct size: their number grows with the square root of the rows at most); groups of
one size are numbered by Spark.

Law ``rows``: unlinked documents fill the shards up, so that counts differ by at
most one.  They are ranked in two steps (hash bucket, then within it): no task
ranks a shard or the table.  Slots number each shard's rows from 0, gapless,
the same way.

Null texts group with null texts, empty ones with empty ones.  Very long texts are
hashed whole and never shuffled.  Repeated rows are documents of their own.  Null doc_ids are placed like others.  An empty
table gives an empty result; with fewer documents than shards, shards beyond
them stay empty.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import release, stored


def running(counts: DataFrame, keys: list[str], order: str, value: str) -> Column:
    """Sum of ``value`` over earlier rows of ``counts`` within ``keys``."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(w), F.lit(0)).cast("long")


def numbered(rows: DataFrame, keys: list[str], order: list[str], name: str, bucket: str = "bucket") -> DataFrame:
    """``rows`` with ``name``: 0, 1, 2 ... within ``keys``, by ``bucket`` and then
    ``order``.  Only the rows of one bucket are sorted together; the buckets'
    offsets come from their counts."""
    counts = rows.groupBy(*keys, bucket).agg(F.count("*").alias("_n"))
    offsets = counts.select(*keys, bucket, running(counts, keys, bucket, "_n").alias("_before"))
    rank = F.row_number().over(Window.partitionBy(*keys, bucket).orderBy(*order)) - 1
    return (rows.withColumn("_nth", rank).join(offsets, [*keys, bucket])
            .withColumn(name, (F.col("_before") + F.col("_nth")).cast("long")).drop("_before", "_nth"))


def quotas(total: int, shards: int) -> list[int]:
    return [total // shards + (s < total % shards) for s in range(shards)]


def _small(spark: SparkSession, values: list[int], name: str) -> DataFrame:
    return spark.createDataFrame(list(enumerate(values)), f"shard int, {name} long")


def dealt(sizes: DataFrame, shards: int, spread: int) -> DataFrame:
    """(gkey, shard, n, all) of groups (gkey, all): documents in a row of groups, dealt in turn."""
    rows = sizes.withColumn("bucket", F.pmod(F.xxhash64("gkey", F.lit(-1)), F.lit(spread)).cast("int"))
    by_bucket = rows.groupBy("bucket").agg(F.sum("all").alias("m")).withColumn("one", F.lit(0))
    by_bucket = by_bucket.select("bucket", running(by_bucket, ["one"], "bucket", "m").alias("base"))
    own = Window.partitionBy("bucket").orderBy("gkey").rowsBetween(Window.unboundedPreceding, -1)
    at = rows.withColumn("own", F.coalesce(F.sum("all").over(own), F.lit(0))).join(by_bucket, "bucket")
    first = F.col("base") + F.col("own")
    each = at.select("gkey", "all", first.alias("first"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    # How many numbers from ``first`` to before ``first + all`` leave the rest ``shard``.
    upto = lambda x: F.floor((x - F.col("shard") + shards - 1) / shards)
    n = (upto(F.col("first") + F.col("all")) - upto(F.col("first"))).cast("long")
    return each.select("gkey", "shard", n.alias("n"), "all").where("n > 0")


def _cycle(edges) -> list[tuple[int, int]]:
    """The edges of some cycle, or none."""
    ahead: dict[int, list[int]] = {}
    for s, t in sorted(edges):
        ahead.setdefault(s, []).append(t)
    for start in sorted(ahead):
        paths, seen = [[start]], {start}
        for path in paths:  # breadth first: short cycles first
            for t in ahead.get(path[-1], []):
                if t == start:
                    return list(zip(path, [*path[1:], start]))
                if t not in seen:
                    seen.add(t)
                    paths.append([*path, t])
    return []


def exchange(asks: dict[tuple[int, int], int], free: list[int]) -> dict[tuple[int, int], int]:
    """How many of the rows that ask to go from one shard to another may, so that every
    shard gains at most its ``free`` room: first rows that change places along cycles of
    shards, then rows into free room, where those that leave make room for others."""
    flow, left, free = dict.fromkeys(asks, 0), {k: n for k, n in asks.items() if n > 0}, list(free)

    def move(k: tuple[int, int], n: int) -> None:
        flow[k] += n
        left[k] -= n
        if not left[k]:
            del left[k]

    while cycle := _cycle(left):
        n = min(left[k] for k in cycle)
        for k in cycle:
            move(k, n)
    moved = True
    while moved:
        moved = False
        for s, t in sorted(left):
            n = min(left[s, t], free[t])
            if n > 0:
                move((s, t), n)
                free[t] -= n
                free[s] += n
                moved = True
    return flow


def _state(groups: DataFrame, room: list[int]) -> list[int]:
    load = {r.shard: r.load for r in groups.groupBy("shard").agg(F.sum("n").alias("load")).collect()}  # one row a shard
    return [r - load.get(s, 0) for s, r in enumerate(room)]


def _ranked(rows: DataFrame, keys: list[str], value: str, spread: int, seed: int) -> DataFrame:
    """``rows`` with ``before``: the sum of ``value`` over earlier rows of ``keys``, in hash
    order of the groups; no task orders more than one bucket."""
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("gkey", F.lit(seed)), F.lit(spread)).cast("int"))
    by_bucket = rows.groupBy(*keys, "bucket").agg(F.sum(value).alias("m"))
    by_bucket = by_bucket.select(*keys, "bucket", running(by_bucket, keys, "bucket", "m").alias("base"))
    own = Window.partitionBy(*keys, "bucket").orderBy("gkey").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("own", F.coalesce(F.sum(value).over(own), F.lit(0))).join(by_bucket, [*keys, "bucket"])
            .withColumn("before", F.col("base") + F.col("own")).drop("bucket", "base", "own"))


def propagate(groups: DataFrame, room: list[int], spread: int = 256) -> DataFrame:
    """Final (gkey, shard, n, all) from starting (gkey, shard, n, all), ``room`` by
    shard; ``all`` is the group's size.  See the module's text."""
    spark, i, still = groups.sparkSession, 0, 0
    while still < 2:  # ties are drawn anew each round: one without moves may be chance
        free = _state(groups, room)
        best = groups.groupBy("gkey").agg(F.max_by("shard", F.struct("n", F.xxhash64("gkey", "shard", F.lit(i)))).alias("target"))
        asks = stored(groups.join(best, "gkey"), f"shard-asks{i}")
        moving = asks.where("shard <> target")
        wanted = {(r.shard, r.target): r.n for r in moving.groupBy("shard", "target").agg(F.sum("n").alias("n")).collect()}
        flow = exchange(wanted, free)
        still = 0 if any(flow.values()) else still + 1
        if still:
            i += 1
            continue
        quota = spark.createDataFrame([(*k, n) for k, n in flow.items()], "shard int, target int, quota long")
        ranked = _ranked(moving, ["shard", "target"], "n", spread, i).join(F.broadcast(quota), ["shard", "target"])
        took = F.greatest(F.lit(0), F.least(F.col("n"), F.col("quota") - F.col("before")))
        ranked = stored(ranked.select("gkey", "shard", "target", "n", "all", took.alias("took")), f"shard-moves{i}")
        groups = _merged(asks.where("shard = target").select("gkey", "shard", "n", "all")
                         .unionByName(ranked.select("gkey", F.col("target").alias("shard"), F.col("took").alias("n"), "all"))
                         .unionByName(ranked.select("gkey", "shard", (F.col("n") - F.col("took")).alias("n"), "all")), f"shard-state{i}")
        release(spark)
        i += 1
    while True:  # cut groups whose rest fits into one of their shards gather there
        free = _state(groups, room)
        cut = groups.where(F.col("n") < F.col("all"))
        rest = F.col("all") - F.col("n")
        fits = (cut.join(F.broadcast(_small(spark, free, "free")), "shard").where(F.col("free") >= rest)
                .groupBy("gkey").agg(F.max_by(F.struct("shard", rest.alias("rest"), "free"), F.struct("n", F.xxhash64("gkey", "shard"))).alias("b"))
                .select("gkey", F.col("b.shard").alias("target"), F.col("b.rest").alias("rest"), F.col("b.free").alias("free")))
        gather = stored(_ranked(fits, ["target"], "rest", spread, i).where(F.col("before") + F.col("rest") <= F.col("free"))
                        .select("gkey", "target"), f"shard-gather{i}")
        if gather.isEmpty():
            return groups
        groups = _merged(groups.join(gather, "gkey", "left").select("gkey", F.coalesce("target", "shard").alias("shard"), "n", "all"),
                         f"shard-gathered{i}")
        i += 1


def _merged(rows: DataFrame, label: str) -> DataFrame:
    return stored(rows.where("n > 0").groupBy("gkey", "shard", "all").agg(F.sum("n").alias("n")), label)


def shard(docs: DataFrame, shards: int = 8, rows_per_bucket: int = 100_000) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) per row of
    ``docs`` (doc_id, text); equal texts are linked."""
    spark = docs.sparkSession
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")
    gkey = F.concat(F.sha2(F.coalesce("text", F.lit("")), 256).substr(1, 32), F.col("text").isNull().cast("string"))
    rows = stored(docs.select("doc_id", size.alias("size"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
                              gkey.alias("gkey"), F.xxhash64("doc_id", "text").alias("order")), "shard-rows")
    total = rows.count()
    want = quotas(total, shards)
    spread = max(256, total // rows_per_bucket)
    rows = rows.withColumn("bucket", F.pmod("order", F.lit(spread)).cast("int"))
    linked = stored(rows.groupBy("gkey").agg(F.count("*").alias("all")).where("all > 1"), "shard-linked")
    start = stored(dealt(linked, shards, spread), "shard-start")
    settled = stored(_gathered(propagate(start, want, spread), want, spread), "shard-settled")
    # A group's documents are numbered and take the shards of its counted rows in turn.
    turn = stored(settled.select("gkey", "shard", "n", running(settled, ["gkey"], "shard", "n").alias("from")),
                  "shard-turns")
    keys = turn.where("`from` = 0").select("gkey")
    in_group = numbered(rows.join(keys, "gkey"), ["gkey"], ["order", "doc_id"], "turn")
    placed = (in_group.join(turn, "gkey").where("turn >= `from` and turn < `from` + n")
              .select("doc_id", "size", "text_crc32", "order", "bucket", "shard"))
    # The others are numbered too and fill what room is left, shard by shard.
    load = {r.shard: r.load for r in settled.groupBy("shard").agg(F.sum("n").alias("load")).collect()}  # one row a shard
    left = [want[s] - load.get(s, 0) for s in range(shards)]
    ends = [sum(left[:s + 1]) for s in range(shards)]
    others = numbered(rows.join(keys, "gkey", "left_anti").withColumn("all", F.lit(0)), ["all"],
                      ["order", "doc_id"], "turn")
    into = F.lit(shards - 1)
    for s in reversed(range(shards - 1)):
        into = F.when(F.col("turn") < ends[s], F.lit(s)).otherwise(into)
    both = placed.unionByName(others.select("doc_id", "size", "text_crc32", "order", "bucket", into.alias("shard")))
    both = stored(both, "shard-placed")
    return numbered(both, ["shard"], ["order", "doc_id"], "slot").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        "slot", F.lit(None).cast("int").alias("grown_shard"))


def packed(sizes: list[tuple[int, int]], room: list[int], most: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Where groups go, from their (size, how many), into ``room`` by shard;
    ``most`` rows fit an empty shard.

    Pieces (size, first, last, shard, n): of the groups of ``size``, those numbered
    from ``first`` to before ``last`` put ``n`` rows each into ``shard``.  Also, how many
    pieces there are beyond those that the groups' sizes ask for.
    """
    room, extra = list(room), 0
    pieces, late = [], []

    def split(size: int, nth: int) -> int:
        rest, parts = size, 0
        while rest:
            fits = [s for s in range(len(room)) if room[s] >= rest]
            s = min(fits, key=lambda s: (room[s], s)) if fits else max(range(len(room)), key=lambda s: (room[s], -s))
            n = min(rest, room[s])
            pieces.append((size, nth, nth + 1, s, n))
            room[s] -= n
            rest, parts = rest - n, parts + 1
        return parts

    for size, count in sorted(sizes, reverse=True):
        at = 0
        if size > most:
            for at in range(count):
                extra += split(size, at) - -(-size // most)
            continue
        for s in sorted(range(len(room)), key=lambda s: (room[s], s)):
            fit = min(count - at, room[s] // size)
            if fit > 0:
                pieces.append((size, at, at + fit, s, size))
                room[s] -= fit * size
                at += fit
        # Fewer than there are shards: that many would not leave room for all rows.
        late += [(size, nth) for nth in range(at, count)]
    for size, nth in late:
        extra += split(size, nth) - 1
    return pieces, extra


def _gathered(groups: DataFrame, room: list[int], spread: int) -> DataFrame:
    """(gkey, shard, n) of ``groups`` with cut groups put together as far as the
    shards' ``room`` lets them, and no shard above it."""
    spark = groups.sparkSession
    per = stored(groups.groupBy("gkey", F.col("all").alias("size")).agg(F.count("*").alias("parts"), F.min("shard").alias("shard")),
                 "shard-groups")
    load = {r.shard: r.load for r in per.where("parts = 1").groupBy("shard").agg(F.sum("size").alias("load")).collect()}  # one row a shard
    free = [r - load.get(s, 0) for s, r in enumerate(room)]

    def sizes(some: DataFrame) -> list[tuple[int, int]]:
        return [tuple(r) for r in some.groupBy("size").count().collect()]  # one row a distinct size

    cut = per.where("parts > 1")
    plan, pool = None, cut
    if min(free) >= 0:
        these = sizes(cut)
        if not these:
            return groups.select("gkey", "shard", "n")
        plan = packed(these, free, max(room))
    if plan is None or plan[1] > 0:
        anew = packed(sizes(per), room, max(room))
        if plan is None or anew[1] < plan[1]:
            plan, pool = anew, per
    pieces = spark.createDataFrame(plan[0], "size long, first long, last long, shard int, n long")
    by_size = pool.select("gkey", "size", F.pmod(F.xxhash64("gkey"), F.lit(spread)).cast("int").alias("bucket"))
    moved = (numbered(by_size, ["size"], ["gkey"], "nth").join(F.broadcast(pieces), "size")
             .where("nth >= first and nth < last").select("gkey", "shard", "n"))
    if pool is per:
        return moved
    return per.where("parts = 1").select("gkey", "shard", F.col("size").alias("n")).unionByName(moved)
