r"""SimHash near-duplicate detection by multi-index hashing.

A fingerprint is 64 bits: bit b is 1 if more than half of the text's shingle
hashes (XXH64, seed 42) have it.  Two fingerprints link at two differing bits
or fewer.  Multi-index hashing cuts a fingerprint into two halves of 32 bits.
If two fingerprints differ in at most two bits, either their high halves differ
in at most one bit or their low halves are equal.  So each is stored in a table
under both halves, and each probes the table with the Hamming ball of radius
one around its high half (33 keys) and with its low half (1 key); fetched pairs
are verified over all 64 bits.

Only distinct fingerprints are indexed, so exact copies cost nothing.  A table
key that more than ``hot`` fingerprints share fetches no pairs.  All that probe
such a key are linked in another exact way: two fingerprints differ in at most
two bits exactly if their 65-key Hamming balls of radius one meet, and all who
meet in one key (65 at most) are linked with the least of them.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import near_copies
from .common import batch_of, column, few, joined, lower_words, per_text, scratch, table, written
from .components import components

#: Words of a shingle, hash seed, differing bits that link, fingerprints under one key above which no pairs are fetched.
WIDTH, SEED, BITS, HOT = 3, 42, 2, 64


def fingerprint(words: list[bytes], width: int = WIDTH) -> int:
    """SimHash of a word sequence; zero without words."""
    if not words:
        return 0
    if len(words) <= width:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    n = max(1, len(words) - width + 1)
    h = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, n)
    return near_copies.majority(h)


OUT = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed 64-bit integer."""

    def make():
        def step(batch):
            found = np.fromiter((fingerprint(lower_words(x), width) for x in column(batch, "text")), np.uint64, batch.num_rows)
            yield batch_of(OUT, batch.column(0), pa.array(found.view(np.int64)))

        return step

    return per_text(docs.select(F.col("doc_id").cast("long"), "text"), make, "doc_id long, fp long")


def _halves(fp) -> tuple:
    return F.shiftrightunsigned(fp, 32).cast("long"), fp.bitwiseAND(F.lit(0xFFFFFFFF))


def hamming_links(found: DataFrame, hot: int = HOT) -> DataFrame:
    """Links (u, v), u < v, that join all distinct fingerprints ``fp`` within BITS bits of each other.

    Pairs under ordinary keys are all there; those under hot keys are there as stars with the same components.
    """
    high, low = _halves(F.col("fp"))
    entry = lambda seg, key: F.struct(F.lit(seg).cast("byte").alias("seg"), key.alias("key"))
    stored = found.select("fp", F.explode(F.array(entry(0, high), entry(1, low))).alias("e")).select("e.seg", "e.key", "fp")
    ball = F.expr("transform(sequence(-1, 31), i -> named_struct('seg', cast(0 as byte), 'key', shiftrightunsigned(fp, 32) ^ if(i < 0, 0L, shiftleft(1L, i))))")
    probes = found.select("fp", F.explode(F.concat(ball, F.array(entry(1, low)))).alias("e")).select("e.seg", "e.key", F.col("fp").alias("u"))
    crowded = stored.groupBy("seg", "key").count().where(F.col("count") > hot).select("seg", "key", F.lit(True).alias("hot"))
    marked = stored.join(crowded, ["seg", "key"], "left")
    slots = marked.where("hot is null").select("seg", "key", F.col("fp").alias("v")).unionByName(crowded.select("seg", "key", F.lit(None).cast("long").alias("v")))
    # Spark counts an exploded array as one row, so by its estimate the probes, 34 a fingerprint, would be broadcast; they are dealt out.
    fetched = written(probes.hint("merge").join(slots, ["seg", "key"]).where(F.expr("v is null or (u < v and bit_count(u ^ v) <= 2)")).select("u", "v").distinct(), "links")
    rest = fetched.where("v is null").select(F.col("u").alias("fp"))
    keys = rest.select("fp", F.explode(F.expr("transform(sequence(-1, 63), i -> fp ^ if(i < 0, 0L, shiftleft(1L, i)))")).alias("key"))
    stars = keys.select(F.min("fp").over(Window.partitionBy("key")).alias("u"), F.col("fp").alias("v")).where("u < v").distinct()
    return fetched.where("v is not null").unionByName(stars)


def near_duplicates(docs: DataFrame, width: int = WIDTH, hot: int = HOT) -> DataFrame:
    """doc_id, fingerprint and component of every document; one row per input row.

    A null text or one without words has fingerprint zero and links as any
    other.  Fewer words than ``width`` make one shingle.  A null doc_id keeps
    its row, never names a component, and its component is the smallest id
    reachable (null if there is none).  Repeated rows each have their row; an
    empty table gives none; other columns are ignored.
    """
    rows = written(fingerprints(docs, width), "fingerprints")
    least = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")), "distinct")
    stars = components(hamming_links(least.select("fp"), hot))
    rooted = least.join(stars.select(F.col("node").alias("fp"), "root"), "fp", "left").select("fp", "least", "copies", F.coalesce("root", "fp").alias("root"))
    roots = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = written(rooted.join(roots, "root").select("fp", "copies", "component_id"), "classes")
    return joined(rows, classes, ["fp"], "copies", rows.count()).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def set_pairs(rows: DataFrame, hot: int = HOT) -> DataFrame:
    """Pairs (u, v) of sets by SimHash: the least sets of linked fingerprints, and each set with the least of its own; ``rows`` as of ``near_copies.shingled``."""
    sets = written(rows.where("fp is not null").select("sid", "fp").dropDuplicates(["sid"]), "prints")
    least = written(sets.groupBy("fp").agg(F.min("sid").alias("least")), "distinct")
    same = sets.join(least, "fp").where("sid <> least").select(F.col("least").alias("u"), F.col("sid").alias("v"))
    of = lambda k: least.select(F.col("fp").alias(k), F.col("least").alias(f"sid_{k}"))
    links = hamming_links(least.select("fp"), hot).join(of("u"), "u").join(of("v"), "v")
    return same.unionByName(links.select(F.col("sid_u").alias("u"), F.col("sid_v").alias("v")))


def one_of_each(docs: DataFrame, width: int = near_copies.WIDTH) -> DataFrame:
    """One row of each group of near copies, with all its columns.

    Near copies are those of ``near_copies``: pairs that fingerprints at BITS bits
    link are verified first, and edited copies, which mostly lie farther apart,
    are searched among what is not linked then.  The row of the smallest doc_id
    stays (null ids last, then by a hash of all columns), whatever the order of
    the input.  Ids do not identify rows: rows of one doc_id with texts that are
    no copies of each other all stay.  Rows equal in all columns leave one.
    Null texts and those without words are one group; an empty table gives no
    rows.
    """
    every = [F.col(f"`{c}`") for c in docs.columns]
    nulls = [c.isNull() for c in every]  # a hash skips nulls
    key = F.array(F.xxhash64(*every, *nulls), F.xxhash64(F.lit(1), *reversed(every), *nulls))  # 128 bits
    keyed = docs.select(*every, F.col("doc_id").cast("long").alias("__id"), key.alias("__row"))
    with scratch(docs.sparkSession):
        rows, roots = near_copies.leaders(keyed.select(F.concat(F.array(F.col("__id").isNull().cast("long"), F.col("__id")), "__row").alias("row"), "text"), set_pairs, width)
        # Rows are ordered as arrays: (id is null, id, hashes).  Both aggregates combine on the map side, so a hot set costs a row a task.
        least = rows.groupBy("sid").agg(F.min("row").alias("row")).join(few(roots.select(F.col("node").alias("sid"), "root")), "sid", "left")
        best = least.groupBy(F.coalesce("root", "sid").alias("root")).agg(F.min("row").alias("row")).select("row", F.slice("row", 3, 2).alias("__row"))
        # What goes is less than what stays, and so is the side that is sent: rows that go, and kept rows that occur again.
        held = rows.select(F.slice("row", 3, 2).alias("__row")).groupBy("__row").count()
        marks = held.join(best.select("__row", F.lit(True).alias("stays")), "__row", "left").where("stays is null or count > 1")
        marks = written(marks.select("__row", F.col("stays").isNotNull().alias("stays")), "marks", keep=True)
    again = marks.where("stays").select("__row")
    kept = keyed.join(few(marks.where("not stays").select("__row")), "__row", "left_anti")
    if not again.isEmpty():
        some = few(again)
        kept = kept.join(some, "__row", "left_anti").unionByName(kept.join(some, "__row", "left_semi").dropDuplicates(["__row"]))  # rows of one key are equal
    return kept.select(*every)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
