"""Balanced label propagation into shards, in DataFrame operations only.

Links join documents of equal text. Members of a group are alike, so the state
is the number of members each group has in each shard: at most one row a group
and shard, however large the group. In every round a group's members ask to
move to the shard where most of them can gather, those already there and the
places left (ties by count, then hash). What two shards ask
of each other changes places; beyond that a shard admits requests up to its
quota, in an order given by hash, partly if need be. A group larger than a
quota stays spread.

Documents without links have no preference; they fill the shards to sizes that
differ by at most one row. That is the law ``rows``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickcast.llm.common import arrow_settings, drop_stage, partitions, ranked, stage

ROUNDS = 6


def running(df: DataFrame, key: str, order: list, amount: str, buckets: int) -> DataFrame:
    """Adds ``before``: the sum of ``amount`` of the rows of ``key`` that come
    earlier, bucket by bucket, so no key's rows meet in one task."""
    within = W.partitionBy(key, "_b").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    sums = df.groupBy(key, "_b").agg(F.sum(amount).alias("_sum"))
    sums = sums.withColumn("_base", F.coalesce(F.sum("_sum").over(W.partitionBy(key).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("_sum")
    own = df.withColumn("_own", F.coalesce(F.sum(amount).over(within), F.lit(0)))
    return own.join(sums, [key, "_b"]).withColumn("before", F.col("_base") + F.col("_own")).drop("_base", "_own")


def propagate(state: DataFrame, shards: int, quota: int, buckets: int, rounds: int = ROUNDS) -> DataFrame:
    """Rounds of moves over ``state`` (g, shard, c)."""
    for _ in range(rounds):
        load = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.sum("c").alias("n")).collect()}
        # where most members can gather: those there and the free places, if need be
        free = {s: max(0, quota - load.get(s, 0)) for s in range(shards)}
        places = F.create_map(*[F.lit(x) for kv in free.items() for x in kv])
        whole = state.groupBy("g").agg(F.sum("c").alias("all"))
        gather = F.least("all", F.col("c") + places[F.col("shard")])
        votes = state.join(whole, "g").groupBy("g").agg(F.max_by("shard", F.struct(gather, "c", F.xxhash64("g", "shard"))).alias("target"))
        asks = state.join(votes, "g").filter("shard != target").withColumn("_b", F.pmod(F.xxhash64("g"), F.lit(buckets)).cast("int"))
        asks = asks.withColumn("way", F.col("shard") * shards + F.col("target"))
        want = {r["way"]: r["n"] for r in asks.groupBy("way").agg(F.sum("c").alias("n")).collect()}  # shards squared at most
        # what two shards ask of each other changes places; free places take more
        grants = {}
        for way, n in sorted(want.items()):
            a, b = divmod(way, shards)
            swap = min(n, want.get(b * shards + a, 0))
            more = min(n - swap, free[b])
            free[b] -= more
            grants[way] = swap + more
        if not grants:
            break
        limit = F.create_map(*[F.lit(x) for kv in grants.items() for x in kv])
        asks = running(asks, "way", ["c", "g"], "c", buckets)
        grant = F.least(F.col("c"), F.greatest(F.lit(0), limit[F.col("way")] - F.col("before")))
        asks = stage(asks.select("g", "shard", "target", grant.cast("long").alias("moved")).filter("moved > 0"), "moves")
        if not asks.limit(1).count():
            drop_stage(asks)
            break
        gone = asks.select("g", "shard", (-F.col("moved")).alias("c"))
        come = asks.select("g", F.col("target").alias("shard"), F.col("moved").alias("c"))
        new = stage(state.unionByName(gone).unionByName(come).groupBy("g", "shard").agg(F.sum("c").alias("c")).filter("c > 0"), "state")
        drop_stage(asks)
        drop_stage(state)
        state = new
    return state


def shard_rows(docs: DataFrame, shards: int = 8) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row of ``docs`` (doc_id, text).

    Row counts of the shards differ by at most one; slots are gapless from 0
    in each shard. A null text has size 1 and no links; repeated rows (and null
    ids) are placed each; other columns are not read.
    """
    buckets = partitions(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.md5(F.col("text").cast("binary")).alias("g"),
    )
    rows = stage(rows, "rows")
    n = rows.count()
    quota = n // shards
    linked = rows.filter("g is not null").groupBy("g").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("g")
    first = F.pmod(F.xxhash64("doc_id", "g"), F.lit(shards)).cast("int")
    members = stage(rows.join(linked, "g"), "members")
    single = rows.join(linked, "g", "left_anti")

    # the first labels, admitted up to the quota like any move
    state = members.groupBy("g", first.alias("shard")).agg(F.count(F.lit(1)).alias("c")).withColumn("_b", F.pmod(F.xxhash64("g"), F.lit(buckets)).cast("int"))
    state = stage(running(state, "shard", ["g"], "c", buckets), "first")
    fits = F.least(F.col("c"), F.greatest(F.lit(0), F.lit(quota) - F.col("before")))
    load = {r["shard"]: r["c"] for r in state.groupBy("shard").agg(F.sum(fits).alias("c")).collect()}
    extra = state.select("g", (F.col("c") - fits).alias("c")).filter("c > 0").groupBy("g").agg(F.sum("c").alias("c"))
    placed = state.select("g", "shard", fits.cast("long").alias("c")).filter("c > 0")
    if state.filter(F.col("before") + F.col("c") > quota).limit(1).count():
        # what exceeds a shard's quota fills the others' free places in turn
        extra = extra.withColumn("_b", F.pmod(F.xxhash64("g"), F.lit(buckets)).cast("int")).withColumn("_one", F.lit(0))
        extra = running(extra, "_one", ["g"], "c", buckets)
        at, places = 0, []
        for s in range(shards):
            # quota is floor(n / shards): the last few rows go one to a shard
            room = quota + (1 if s < n % shards else 0) - load.get(s, 0)
            places.append((s, at, at + room))
            at += room
        spread = F.array(*[F.struct(F.lit(s).alias("shard"), F.greatest(F.lit(0), F.least(F.col("before") + F.col("c"), F.lit(b)) - F.greatest(F.col("before"), F.lit(a))).cast("long").alias("c")) for s, a, b in places])
        spread = extra.select("g", F.explode(spread).alias("x")).select("g", "x.shard", "x.c").filter("c > 0")
        placed = placed.unionByName(spread).groupBy("g", "shard").agg(F.sum("c").alias("c"))
    state = propagate(stage(placed, "state"), shards, quota, buckets)

    # members take their group's places by rank; the others fill the shards
    ends = state.withColumn("end", F.sum("c").over(W.partitionBy("g").orderBy("shard")))
    ends = ends.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("end", "shard"))).alias("ends"))
    in_group = ranked(members, "g", ["doc_id", "size"], buckets).join(ends, "g")
    in_group = in_group.withColumn("shard", F.filter("ends", lambda x: F.col("rank") < x["end"])[0]["shard"])
    load = {r["shard"]: r["c"] for r in state.groupBy("shard").agg(F.sum("c").alias("c")).collect()}
    at, edge = 0, F.lit(None).cast("int")
    rank = F.col("rank")
    for s in range(shards):
        room = quota + (1 if s < n % shards else 0) - load.get(s, 0)
        edge = F.when((rank >= at) & (rank < at + room), F.lit(s)).otherwise(edge)
        at += room
    alone = ranked(single.withColumn("_one", F.lit(0)), "_one", ["doc_id", "size", "text_crc32"], buckets).withColumn("shard", edge)
    names = ["doc_id", "size", "text_crc32", "shard"]
    both = stage(in_group.select(*names).unionByName(alone.select(*names)), "sharded")
    out = stage(ranked(both, "shard", ["doc_id", "size", "text_crc32"], buckets).withColumnRenamed("rank", "slot"), "slots")
    for x in (rows, members, both):
        drop_stage(x)
    return out


def op4_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    with arrow_settings(spark):
        rows = shard_rows(docs)
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
