"""Balanced label propagation: linked documents move towards their neighbours' shards under quotas.

Documents of equal text are linked.  Every document begins with the shard that
its id decides as its label.  In each round documents see the labels that their
neighbours have now and propose to take the one that most of them have.  What
may flow from shard to shard is decided from the sums of all proposals: as much
as flows back, and what room is left.  Accepted documents have a new label in
the next round.  Rounds go on while the number of cut links falls by a
twentieth or more.

Members of a group with one label are interchangeable, so labels are kept as
counts by (group, label): a group has no more rows than shards, however large
it is.  A group above a shard's capacity is several, dealt out row by row.

Then groups settle: each proposes, of the shards with room for all of it, the
one where most of it is; shards accept while their quota lasts, larger groups
first, until no group left fits any shard.  Sums over a bounded number of
priority buckets decide that, so no task ever sorts all proposals.  At the end
unlinked documents fill the shards, and exactly the rows above a shard's share
move to shards below theirs.

The law held is ``rows``: counts of any two shards differ by one at most.

Everything is DataFrame operations; the driver sees one number for each pair of
shards a round.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import joined, table, written

#: Shards, priority buckets of a size class, rows that a ranking bucket has about; share of the cut links by which a round must lower them.
SHARDS, BUCKETS, RANKED, FALL = 40, 256, 4000, 0.05


def _array(values: list[int]):
    return F.array(*[F.lit(int(v)).cast("long") for v in values])


def _propose(state: DataFrame, room: list[int], turn: int) -> DataFrame:
    """Each unsettled group's (gid, chunk, n, target): of the shards with room for it the one with most of its members, else one that a hash picks; none if it fits nowhere."""
    fits = F.element_at(_array(room), F.col("shard") + 1) >= F.col("total")
    near = F.max(F.when(fits, F.struct("n", F.xxhash64("gid", "chunk", "shard", F.lit(turn)).alias("order"), "shard")))
    shards = sorted(range(len(room)), key=lambda s: -room[s])
    able = F.size(F.filter(_array(room), lambda x: x >= F.col("n")))
    picked = F.when(able > 0, F.element_at(_array(shards), (F.pmod(F.xxhash64("gid", "chunk", F.lit(turn)), F.greatest(able, F.lit(1))) + 1).cast("int"))).cast("int")
    return state.groupBy("gid", "chunk").agg(F.max("total").alias("n"), near.alias("near")).select("gid", "chunk", "n", F.coalesce(F.col("near.shard"), picked).alias("target")).where("target is not null")


def _accepted(proposals: DataFrame, room: list[int], turn: int) -> DataFrame:
    """The proposals that fit, with all before them, into the target's quota: whole priority buckets, and the first of the next one by rank.

    Each target accepts one proposal at least, since none exceeds its room.
    """
    bucket = (F.lit(64) - F.ceil(F.log2(F.col("n")))) * BUCKETS + F.pmod(F.xxhash64("gid", "chunk", F.lit(turn + 1000)), F.lit(BUCKETS))
    marked = proposals.withColumn("bucket", bucket.cast("int"))
    inflow = marked.groupBy("target", "bucket").agg(F.sum("n").alias("inflow"))
    before = Window.partitionBy("target").orderBy("bucket")
    left = F.element_at(_array(room), F.col("target") + 1) - F.col("until") + F.col("inflow")
    begun = inflow.withColumn("until", F.sum("inflow").over(before)).withColumn("left", left).where("left > 0").select("target", "bucket", "left", (F.col("inflow") <= F.col("left")).alias("fits"))
    found = marked.join(F.broadcast(begun), ["target", "bucket"])  # at most shards x 64 x BUCKETS rows
    inner = Window.partitionBy("target", "bucket").orderBy("n", "gid", "chunk").rowsBetween(Window.unboundedPreceding, 0)
    part = found.where("not fits").withColumn("sum", F.sum("n").over(inner)).where("sum <= left")
    return found.where("fits").select("gid", "chunk", "n", "target").unionByName(part.select("gid", "chunk", "n", "target"))


def _flows(wanted: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """Rows that may move from shard to shard: what flows both ways, and the target's room dealt out by demand."""
    own = {k: min(n, wanted.get(k[::-1], 0)) for k, n in wanted.items()}
    for b, free in enumerate(room):
        rest = {k: n - own[k] for k, n in wanted.items() if k[1] == b and n > own[k]}
        total = sum(rest.values())
        for k, n in rest.items():
            own[k] += n if total <= free else n * free // total
    return own


def relabel(members: DataFrame, capacity: int, shards: int, fall: float = FALL) -> tuple[DataFrame, list[int]]:
    """``members`` (gid, chunk, shard, n) with the labels that propagation ends with, and the cut links before it and after each round."""
    state = written(members, "labels")

    def cut(state: DataFrame) -> int:
        squares = state.groupBy("gid", "chunk").agg(F.sum("n").alias("all"), F.sum(F.col("n") * F.col("n")).alias("joined"))
        return int(squares.agg(F.coalesce(F.sum((F.col("all") * F.col("all") - F.col("joined")).cast("decimal(38,0)")), F.lit(0))).first()[0]) // 2

    cuts = [cut(state)]
    while cuts[-1]:
        turn = F.lit(len(cuts))
        load = [0] * shards
        for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect():
            load[r.shard] = r.n
        most = F.max(F.struct("n", F.xxhash64("gid", "chunk", "shard", turn).alias("order"), "shard"))
        seen = state.join(state.groupBy("gid", "chunk").agg(most.alias("most")), ["gid", "chunk"])  # each label beside its neighbours' most frequent one
        hashed = F.pmod(F.xxhash64("gid", "chunk", "shard", turn), F.lit(BUCKETS)).cast("int")
        seen = written(seen.select("gid", "chunk", "shard", "n", F.col("most.shard").alias("target"), hashed.alias("bucket")), "proposals")
        sums = seen.where("shard <> target").groupBy("shard", "target", "bucket").agg(F.sum("n").alias("n"))
        wanted: dict[tuple[int, int], int] = {}
        for r in sums.groupBy("shard", "target").agg(F.sum("n").alias("n")).collect():  # shards x shards at most
            wanted[r.shard, r.target] = r.n
        flows = _flows(wanted, [max(0, capacity - x) for x in load])
        quota = F.element_at(_array([flows.get((a, b), 0) for a in range(shards) for b in range(shards)]), F.col("shard") * shards + F.col("target") + 1)
        until = F.sum("n").over(Window.partitionBy("shard", "target").orderBy("bucket"))
        accepted = sums.withColumn("until", until).where(F.col("until") <= quota).select("shard", "target", "bucket", F.lit(True).alias("moves"))
        moved = seen.join(F.broadcast(accepted), ["shard", "target", "bucket"], "left")  # shards x shards x BUCKETS rows at most
        after = moved.groupBy("gid", "chunk", F.when(F.col("moves"), F.col("target")).otherwise(F.col("shard")).alias("shard")).agg(F.sum("n").alias("n"))
        after = written(after, "labels")
        cuts.append(cut(after))
        if cuts[-1] < cuts[-2]:
            state = after
        if cuts[-2] - cuts[-1] < fall * cuts[-2]:
            break
    return state, cuts


def settle(members: DataFrame, capacity: int, shards: int) -> DataFrame | None:
    """(gid, chunk, n, target) of the groups that are together in one shard; None without groups.

    ``members``: (gid, chunk, shard, n), the rows of a group with each label.
    Rounds go on until no group is left that fits any shard.
    """
    nodes = Window.partitionBy("gid", "chunk")
    state = written(members.withColumn("total", F.sum("n").over(nodes)), "members")
    load, settled = [0] * shards, None
    for turn in count():
        room = [max(0, capacity - x) for x in load]
        if not any(room):
            break
        won = written(_accepted(_propose(state, room, turn), room, turn), "moves")
        moved = won.groupBy("target").agg(F.sum("n").alias("n")).collect()
        if not moved:
            break
        for r in moved:
            load[r.target] += r.n
        settled = won if settled is None else settled.unionByName(won)
        state = written(state.join(won.select("gid", "chunk"), ["gid", "chunk"], "left_anti"), "members")
        if state.isEmpty():
            break
    return None if settled is None else settled.select("gid", "chunk", "n", "target")


def balanced_shards(docs: DataFrame, shards: int = SHARDS, ranked: int = RANKED) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document; one row per input row.

    Texts are equal if their MD5 digests are (128 bits).
    A null text has size 16 and crc32 0 and is linked to other null texts, not
    to empty ones.  A null doc_id stays null and is placed as any other;
    repeated rows are linked and have a slot each; rows that tie in all columns
    are interchangeable.  An empty table gives no rows, fewer rows than shards
    leave shards empty.  Other columns are ignored.
    """
    home = F.pmod(F.xxhash64("doc_id", F.lit(shards)), F.lit(shards)).cast("int")
    gid = F.coalesce(F.unhex(F.md5(F.col("text").cast("binary"))), F.lit("null").cast("binary"))
    rows = written(
        docs.select(F.col("doc_id").cast("long"), (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"), F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"), gid.alias("gid"))
        .withColumn("home", home).withColumn("row", F.monotonically_increasing_id()),  # stored: numbers rows that are equal in all else
        "rows",
    )
    total = rows.count()
    capacity = -(-total // shards)
    groups = rows.groupBy("gid").agg(F.count("*").alias("members")).where("members > 1")
    parts = F.when(F.col("members") > capacity, F.ceil(2 * F.col("members") / F.lit(max(1, capacity)))).otherwise(1).cast("long")
    groups = written(groups.withColumn("parts", parts), "groups")
    tagged = joined(rows, groups, ["gid"], "members", total).withColumn("chunk", F.pmod(F.xxhash64("row", "gid"), "parts").cast("long"))
    tagged = written(tagged.drop("parts", "members"), "tagged")
    linked = tagged.where("chunk is not null")
    members = linked.groupBy("gid", "chunk", F.col("home").alias("shard")).agg(F.count("*").alias("n"))
    placed = settle(relabel(members, capacity, shards)[0], capacity, shards)
    if placed is not None:
        tagged = joined(tagged, placed, ["gid", "chunk"], "n", total).withColumn("home", F.coalesce("target", "home"))
    else:
        tagged = tagged.withColumn("target", F.lit(None).cast("int"))
    loose = F.when(F.col("target").isNotNull(), 0).when(F.col("chunk").isNotNull(), 1).otherwise(2)
    tagged = tagged.select("row", "doc_id", "size", "text_crc32", "home", loose.alias("loose"))

    # Ranks within a shard, rows of settled nodes first and unlinked ones last: counts of hashed buckets, their running sums, then ranks inside a bucket.
    pieces = max(4, -(-capacity // ranked))
    bucketed = tagged.withColumn("bucket", F.pmod(F.xxhash64("row", F.lit(5)), F.lit(pieces)).cast("int"))
    bucketed = written(bucketed, "bucketed")
    key = ["home", "loose", "bucket"]
    sizes = bucketed.groupBy(*key).agg(F.count("*").alias("n"))
    offsets = sizes.withColumn("before", F.sum("n").over(Window.partitionBy("home").orderBy("loose", "bucket")) - F.col("n")).drop("n")
    inner = F.row_number().over(Window.partitionBy(*key).orderBy("row"))
    rank = bucketed.withColumn("inner", inner).join(offsets, key).withColumn("rank", F.col("before") + F.col("inner") - 1)

    have = [0] * shards
    for r in bucketed.groupBy("home").count().collect():
        have[r["home"]] = r["count"]
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    over, under = [max(0, h - q) for h, q in zip(have, quota, strict=True)], [max(0, q - h) for h, q in zip(have, quota, strict=True)]
    running = lambda v: [sum(v[:i]) for i in range(len(v))]
    at = lambda values, i: F.element_at(_array(values), (i + 1).cast("int"))
    stays = F.col("rank") < at(quota, F.col("home"))
    spare = at(running(over), F.col("home")) + F.col("rank") - at(quota, F.col("home"))
    fills = F.size(F.filter(_array([a + b for a, b in zip(running(under), under, strict=True)]), lambda x: x <= F.col("spare")))
    return (
        rank.withColumn("spare", F.when(~stays, spare)).withColumn("fills", F.when(~stays, fills))
        .select(
            "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.when(stays, F.col("home")).otherwise(F.col("fills")).cast("int").alias("shard"),
            F.when(stays, F.col("rank")).otherwise(F.col("spare") - at(running(under), F.col("fills")) + at(have, F.col("fills"))).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced_shards(table(spark, sf_dir, "documents"))
