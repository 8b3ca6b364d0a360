"""Near copies: documents whose sets of word shingles have a Jaccard similarity of SIMILAR or more.

SimHash links the closest of them first.  Fingerprints of 64 bits cannot find
all: at a similarity of 0.8 they lie up to 11 bits apart, out of reach of small
Hamming balls.  So the other candidates share one
of BANDS keys, each a hash of ROWS minimum hashes of the set; a pair of
similarity s shares none with odds (1 - s^ROWS)^BANDS, 3e-6 at 0.8.  One bit of
each minimum hash makes a signature; pairs whose signatures differ in more than
FAR bits are no candidates (odds for a pair at 0.8: 1e-6).  Every link is
verified by the exact similarity of the two sets.

Only distinct sets are compared, and never all that share a key.  Under each
key the most central set leads, that with most other sets under its keys: of
the edited copies of a text most are near to it, though not to each other.

1. Each set is compared with the nearest two, by signature, of its keys' leaders.
2. Sets under keys that hold several components after that are dealt again, by
   their rarest shingles: two similar sets share one of the fifth that is
   rarest among these sets, while texts that share no more than a common line
   do not meet.  The first shingle that two sets share, in order of rarity,
   bounds how many more they can; a pair that cannot reach the similarity by
   it, or is of one component already, is not made.

So every pair that shares a key and is similar ends in one component.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import column, few, lower_words, per_text, written
from .components import components

#: Words of a shingle, hash seed, least similarity of copies; keys of a set, minimum hashes in each, differing bits of signatures beyond which no pair is compared.
WIDTH, SEED, SIMILAR, BANDS, ROWS, FAR = 5, 42, 0.8, 24, 4, 25
#: Leaders that a set is compared with.
NEAREST = 2
#: Distinct sets that a task remembers, so as to send the shingles of each once.
SEEN = 1 << 16
_RNG = np.random.default_rng(SEED)
_FLIP, _TIMES = (_RNG.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Distinct hashes of a text's shingles in order; fewer words than ``width`` make one, no words none."""
    words = lower_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    n = max(1, len(words) - width + 1)
    grams = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False)) if len(words) > width else [b" ".join(words)]
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, n))


def least_hashes(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, BANDS * ROWS) minimum hashes of sets, none of them empty."""
    flat, starts = np.concatenate(sets), np.cumsum([0, *map(len, sets[:-1])])
    return np.stack([np.minimum.reduceat((flat ^ f) * t, starts) for f, t in zip(_FLIP, _TIMES, strict=True)], 1)


def band_keys(least: np.ndarray) -> np.ndarray:
    """BANDS keys of each set."""
    keys = [xxhash.xxh64_intdigest(part.tobytes(), band) for row in least.reshape(len(least), BANDS, ROWS) for band, part in enumerate(row)]
    return np.array(keys, np.uint64).reshape(len(least), BANDS).view(np.int64)


def signatures(least: np.ndarray) -> np.ndarray:
    """(sets, 2) signed 64-bit words: one bit of each minimum hash."""
    bits = np.packbits((least & np.uint64(1)).astype(bool), axis=1, bitorder="little")
    return np.pad(bits, ((0, 0), (0, 16 - bits.shape[1]))).view("<i8")


_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def majority(h: np.ndarray) -> int:
    """SimHash of 64-bit hashes: the bits that more than half of them have."""
    octets = h.astype("<u8").view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(octets[:, k], minlength=256) @ _BYTE_BITS for k in range(8)])
    return int.from_bytes(np.packbits(2 * ones > len(h), bitorder="little").tobytes(), "little")


SETS = pa.schema([("row", pa.list_(pa.int64())), ("sid", pa.binary()), ("n", pa.int64()), ("keys", pa.list_(pa.int64())), ("sign", pa.list_(pa.int64())), ("shingles", pa.binary()), ("fp", pa.int64())])
SETS_DDL = "row array<long>, sid binary, n long, keys array<long>, sign array<long>, shingles binary, fp long"


def shingled(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(row, sid, n, keys, sign, shingles, fp) of every row, fp by SimHash: equal sets have one sid, a 128-bit hash.

    ``row`` is passed through.  Keys, signature, shingles and fp are null where the
    task has sent them before; a text without words has n = 0 and none.
    """

    def make():
        seen: set[bytes] = set()

        def step(batch):
            sets = [shingles(x, width) for x in column(batch, "text")]
            data = [x.tobytes() for x in sets]
            sids = [xxhash.xxh3_128_digest(x) for x in data]
            first = []
            for i, sid in enumerate(sids):
                if len(sets[i]) and sid not in seen:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(sid)
                    first.append(i)
            keys, sign, sent, fps = ([None] * len(sets) for _ in range(4))
            if first:
                least = least_hashes([sets[i] for i in first])
                for i, k, s in zip(first, band_keys(least).tolist(), signatures(least).tolist(), strict=True):
                    keys[i], sign[i], sent[i] = k, s, data[i]
                    fps[i] = int(np.uint64(majority(sets[i])).astype(np.int64))
            columns = (sids, [len(x) for x in sets], keys, sign, sent, fps)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, f.type) for c, f in zip(columns, list(SETS)[1:], strict=True))], schema=SETS)

        return step

    return per_text(docs.select("row", "text"), make, SETS_DDL)


def _verified(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The (u, v) of ``pairs`` whose sets are similar."""

    def similar(batches):
        for batch in batches:
            keep = []
            for a, b in zip(*(batch.column(batch.schema.get_field_index(x)) for x in "ab"), strict=True):
                a, b = np.frombuffer(a.as_buffer(), "<u8"), np.frombuffer(b.as_buffer(), "<u8")
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(both >= SIMILAR * (len(a) + len(b) - both) - 1e-9)
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    pairs = written(pairs, "pairs")
    if pairs.isEmpty():
        return pairs.select("u", "v")
    ids = written(pairs.select(F.explode(F.array("u", "v")).alias("sid")).distinct(), "fetch")
    fetched = written(rows.where("shingles is not null").select("sid", "shingles").join(few(ids), "sid", "left_semi").dropDuplicates(["sid"]), "fetched")
    both = pairs.join(fetched.select(F.col("sid").alias("v"), F.col("shingles").alias("b")), "v").join(fetched.select(F.col("sid").alias("u"), F.col("shingles").alias("a")), "u")
    return written(both.select("u", "v", "a", "b").mapInArrow(similar, "u binary, v binary"), "links")


def _far(a, b):
    """Bits in which two signatures differ."""
    return sum((F.bit_count(a[k].bitwiseXOR(b[k])) for k in range(2)), F.lit(0))


def _alike(a: str, b: str):
    """Whether sets of so many shingles and such signatures can be similar."""
    size = (F.col(f"{a}.n") >= SIMILAR * F.col(f"{b}.n")) & (F.col(f"{b}.n") >= SIMILAR * F.col(f"{a}.n"))
    return size & (_far(F.col(f"{a}.sign"), F.col(f"{b}.sign")) <= FAR)


def _rooted(frame: DataFrame, stars: DataFrame, sid: str) -> DataFrame:
    """``frame`` with the component ``c_<sid>`` of its column ``sid``; ``stars``: (node, root) of all in links."""
    own = few(stars.select(F.col("node").alias(sid), F.col("root").alias(f"c_{sid}")))
    return frame.join(own, sid, "left").withColumn(f"c_{sid}", F.coalesce(f"c_{sid}", sid))


def _joined_up(stars: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, root) by the links behind ``stars`` and by more ``links``."""
    edges = links.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    if stars is not None:
        if links.isEmpty():
            return stars
        edges = stars.where("node <> root").select(F.col("root").alias("u"), F.col("node").alias("v")).unionByName(edges)
    return written(components(edges), "stars")


def _rare_pairs(left: DataFrame, rows: DataFrame) -> DataFrame:
    """(u, v) of sets that share one of their rarest shingles, can be similar and are in different components; ``left`` has (x, c)."""

    def spread(batches):
        for batch in batches:
            for sid, data in zip(column(batch, "sid"), column(batch, "shingles"), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array([sid] * (len(data) // 8), pa.binary()), pa.array(np.frombuffer(data, "<i8"))], ["sid", "key"])

    ids = left.select(F.col("x.sid").alias("sid"))
    own = rows.where("shingles is not null").select("sid", "shingles").join(few(ids), "sid", "left_semi").dropDuplicates(["sid"])
    all_ = written(own.mapInArrow(spread, "sid binary, key long"), "spread")
    held = all_.join(all_.groupBy("key").agg(F.count("*").alias("held")), "key")
    ranked = held.withColumn("rank", F.row_number().over(Window.partitionBy("sid").orderBy("held", "key"))).where("held > 1")
    tagged = ranked.join(left.withColumn("sid", F.col("x.sid")), "sid").where(F.col("rank") <= F.col("x.n") - F.ceil(SIMILAR * F.col("x.n") - 1e-6) + 1).select("key", "x", "c", "rank")
    tagged = written(tagged, "rare")
    other = tagged.select("key", F.col("x").alias("y"), F.col("c").alias("d"), F.col("rank").alias("at"))
    # At the first shingle shared, all others that both have come after it in both orders.
    enough = 1 + F.least(F.col("x.n") - F.col("rank"), F.col("y.n") - F.col("at")) >= SIMILAR / (1 + SIMILAR) * (F.col("x.n") + F.col("y.n")) - 1e-6
    met = tagged.join(other, (tagged.key == other.key) & (F.col("c") != F.col("d")) & (F.col("x.sid") < F.col("y.sid")) & enough & _alike("x", "y"))
    return met.select(F.col("x.sid").alias("u"), F.col("y.sid").alias("v")).distinct()


def copy_roots(rows: DataFrame, linked: DataFrame | None = None) -> DataFrame:
    """(node, root) of every set of shingles that has a similar one, by verified links; ``rows`` as of ``shingled``, ``linked``: (node, root) by links known before."""
    sets = written(rows.where("keys is not null").select("sid", "n", "keys", "sign").dropDuplicates(["sid"]), "sets")
    every = sets.select("sid", F.explode("keys").alias("key"))
    sizes = written(every.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "sizes")
    met = written(every.join(few(sizes), "key"), "met")
    central = met.join(met.groupBy("sid").agg(F.sum("size").alias("centre")), "sid")
    leads = central.groupBy("key").agg(F.max(F.struct("centre", F.xxhash64("sid", "key").alias("order"), "sid")).alias("lead"))
    met = written(met.join(leads.select("key", F.col("lead.sid").alias("lead")), "key"), "led_by")

    x = sets.select("sid", F.struct("sid", "n", "sign").alias("x"))
    y = sets.select(F.col("sid").alias("lead"), F.struct("sid", "n", "sign").alias("y"))
    led = met.where("sid <> lead").select("sid", "lead").distinct().join(x, "sid").join(y, "lead").where(_alike("x", "y"))
    led = written(led.select("sid", "lead", _far(F.col("x.sign"), F.col("y.sign")).alias("far")), "led")
    near = led.groupBy("sid").agg(F.slice(F.sort_array(F.collect_list(F.struct("far", "lead"))), 1, NEAREST).alias("near"))  # BANDS leaders at most
    pairs = near.select(F.explode("near.lead").alias("u"), F.col("sid").alias("v"))
    if linked is not None:
        pairs = _rooted(_rooted(pairs, linked, "u"), linked, "v").where("c_u <> c_v").select("u", "v")
    stars = _joined_up(linked, _verified(pairs, rows))

    marked = written(_rooted(met.where("size > 2").select("key", "sid"), stars, "sid"), "marked")
    mixed = marked.groupBy("key").agg(F.min("c_sid").alias("a"), F.max("c_sid").alias("b")).where("a <> b").select("key")
    left = written(marked.join(mixed, "key", "left_semi").select("sid", F.col("c_sid").alias("c")).distinct().join(x, "sid").select("x", "c"), "left")
    if left.isEmpty():
        return stars
    return _joined_up(stars, _verified(_rare_pairs(left, rows), rows))


def leaders(docs: DataFrame, first: Callable[[DataFrame], DataFrame], width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """(rows, roots): the sets of every row, and (node, root) of every set that has near copies.

    Texts without words, null ones too, have one empty set and so are copies of
    each other.  ``docs`` has ``row``, an array of longs, and ``text``; ``first``
    gives the pairs (u, v) of sets that are verified before all others.
    """
    rows = written(shingled(docs, width), "shingles")
    return rows, copy_roots(rows, _joined_up(None, _verified(first(rows), rows)))
