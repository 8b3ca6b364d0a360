r"""Language-model scores from a log-frequency Bloom filter.

Training counts unigrams and bigrams of 64-bit word hashes over all training
texts.  Tasks send them as packed arrays, one per hash block, so a block's
counts meet in one bounded group, which makes the block's part of the filter:
an n-gram of count c is stored under each of the levels 1 to 1 + floor(log2 c),
and the part has ENTRY_BITS bits for each.  Every n-gram is stored, at every
size of the corpus.  A lookup probes level after level until one is missing.

A filter of up to MOST_BITS bits is broadcast to the workers.  A larger one
stays in its parts, and the documents' distinct n-grams are sent to them, one of
WAVES shares of the documents after another, so that disk holds the n-grams of
one share only; the probes, and so the scores, are the same.

``score`` discounts and interpolates: p(w | u) = max(c(u w) - d, 0) / c(u) +
m p(w) with the filter's counts, where d comes from the bigrams seen once and
twice and m is the share of mass that it takes.  ``base_score`` uses exact
counts c(w): a bounded table of the frequent words is broadcast, and the rest
are looked up in the counts of their hash block, which the documents' rare
words are sent to.

Words are ``[^\x20\x09-\x0D]+`` with A-Z lower-cased, then one end a text.  Two
words of one 64-bit hash would share their count (odds of 3e-8 for a million
distinct words, 3e-2 for a billion).
"""

from __future__ import annotations

from functools import partial, reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ensure_shipped
from .common import column, crc_mod, runs, scratch, slices, table, written

#: Hash seed; bytes of text a hash block stands for, and least blocks; n-grams a task holds before it sends them.
SEED, BLOCK_BYTES, LEAST_BLOCKS, HELD = 17, 64 << 20, 256, 1 << 22
#: Bits of a filter that is broadcast at most, bits an entry gets, probes an entry has, least bits of a block.
MOST_BITS, ENTRY_BITS, PROBES, LEAST_BITS = 1 << 30, 10, 4, 64
#: Shares of the documents whose n-grams are sent one after another.
WAVES = 8
#: Words of the broadcast table of exact counts at most; additive smoothing.
TABLE_WORDS, ALPHA = 1 << 20, 0.1
#: Levels of counts that are told apart.
LEVELS = 48
#: Hashes of the end of a text and of its beginning (no word has a blank).
END, BEGIN = (np.uint64(xxhash.xxh64_intdigest(x, SEED)) for x in (b" end", b" begin"))
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xFF51AFD7ED558CCD)
_S = np.uint64(32)
#: What is added to a hash for each level.
_LEVEL = np.arange(LEVELS, dtype=np.uint64) * _M1


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S)) * _M3
    x ^= x >> np.uint64(29)
    x *= _M2
    return x ^ (x >> _S)


def hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, each ended by END, and the number of each."""
    out, sizes = [], np.ones(len(texts), np.int64)
    for k, text in enumerate(texts):
        for run in runs(text.encode().lower() if text else b""):
            own = run.split()
            out.append(np.fromiter(map(xxhash.xxh64_intdigest, own, repeat(SEED)), np.uint64, len(own)))
            sizes[k] += len(own)
        out.append(np.array([END]))
    return np.concatenate(out), sizes


def bigrams(h: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(previous word's hash, bigram's hash) at every word."""
    before = np.empty_like(h)
    before[1:] = h[:-1]
    before[np.cumsum(sizes) - sizes] = BEGIN
    return before, mixed(before * _M1 + h)


def level(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log2 c)."""
    return np.minimum(np.frexp(counts.astype(np.float64))[1], LEVELS - 1)


#: The count that a level stands for: the mean of those it holds.
LEVEL_COUNT = np.concatenate([[0.0], (3 * 2.0 ** np.arange(LEVELS - 1) - 1) / 2])


class LogBloom:
    """Bits in blocks of their own sizes; an n-gram's block is the top bits of its hash."""

    def __init__(self, bits: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        """``bits``: bytes; ``starts`` and ``sizes``: first bit and bits of every block."""
        self.bits, self.starts, self.sizes = bits, starts, sizes
        self.shift = np.uint64(64 - (len(sizes).bit_length() - 1))

    @staticmethod
    def probes(h: np.ndarray, q: int, size) -> list[np.ndarray]:
        """Positions of level ``q`` of n-grams in blocks of ``size`` bits."""
        x = mixed(h + _LEVEL[q])
        step = (x >> _S) | np.uint64(1)
        return [(x + np.uint64(i) * step) % size for i in range(PROBES)]

    @staticmethod
    def block_bits(parts: list[tuple[np.ndarray, np.ndarray]]) -> bytes:
        """The bits of one block, from (hashes, levels) of its n-grams."""
        size = max(LEAST_BITS, -(-ENTRY_BITS * sum(int(q.sum()) for _, q in parts) // 8) * 8)
        flags = np.zeros(size, bool)
        for h, levels in parts:
            for q in range(1, int(levels.max(initial=0)) + 1):
                for p in LogBloom.probes(h[levels >= q], q, np.uint64(size)):
                    flags[p] = True
        return np.packbits(flags, bitorder="little").tobytes()

    @classmethod
    def joined(cls, parts: dict[int, bytes], blocks: int) -> LogBloom:
        """A filter of some blocks; others hold nothing."""
        empty = bytes(LEAST_BITS // 8)
        own = [parts.get(k, empty) for k in range(blocks)]
        sizes = np.array([8 * len(x) for x in own], np.uint64)
        return cls(np.frombuffer(b"".join(own), np.uint8), np.cumsum(sizes) - sizes, sizes)

    @classmethod
    def gathered(cls, counts: DataFrame, blocks: int) -> LogBloom:
        """The filter of ``counts``; its parts come one partition at a time into the one array that is held."""
        sizes = np.full(blocks, LEAST_BITS, np.uint64)
        for block, n in counts.select("block", F.octet_length("bits")).collect():
            sizes[block] = 8 * n
        starts = np.cumsum(sizes) - sizes
        bits = np.zeros(int(sizes.sum()) // 8, np.uint8)
        for block, own in counts.select("block", "bits").toLocalIterator():
            at = int(starts[block]) // 8
            bits[at : at + len(own)] = np.frombuffer(own, np.uint8)
        return cls(bits, starts, sizes)

    def levels(self, h: np.ndarray) -> np.ndarray:
        """The level of every n-gram: probes go on while all of a level's bits are set."""
        out = np.zeros(len(h), np.int64)
        live = np.arange(len(h))
        block = (h >> self.shift).astype(np.int64) if len(self.sizes) > 1 else np.zeros(len(h), np.int64)
        start, size = self.starts[block], self.sizes[block]
        for q in range(1, LEVELS):
            for i in range(PROBES):
                if not len(live):
                    return out
                x = mixed(h[live] + _LEVEL[q])
                at = start[live] + (x + np.uint64(i) * ((x >> _S) | np.uint64(1))) % size[live]
                live = live[(self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0]
            out[live] = q
        return out


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and their summed counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def _blocks(docs: DataFrame) -> int:
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return max(LEAST_BLOCKS, 1 << max(0, int(size) // BLOCK_BYTES - 1).bit_length())


COUNTS = pa.schema([("block", pa.int32()), *((x, pa.binary()) for x in ("uni", "uni_n", "bits")), ("tokens", pa.int64()), ("words", pa.int64()), ("uni_levels", pa.list_(pa.int64())), *((x, pa.int64()) for x in ("pairs", "once", "twice"))])
COUNTS_DDL = "block int, uni binary, uni_n binary, bits binary, tokens long, words long, uni_levels array<long>, pairs long, once long, twice long"


def of_block(h: np.ndarray, blocks: int) -> np.ndarray:
    return (h >> np.uint64(64 - (blocks.bit_length() - 1))).astype(np.int32) if blocks > 1 else np.zeros(len(h), np.int32)


def _by_block(h: np.ndarray, blocks: int) -> list[tuple[int, int, int]]:
    """(block, first, end) of sorted hashes."""
    of = of_block(h, blocks)
    first = np.flatnonzero(np.diff(of, prepend=-1)).tolist()
    return [(int(of[a]), a, b) for a, b in zip(first, [*first[1:], len(h)], strict=True)]


def ngram_counts(docs: DataFrame, blocks: int) -> DataFrame:
    """One row per hash block: exact counts of its unigrams, its bits of the filter and counts of counts; written to the shared folder."""

    def packed(batches):
        held: list[list] = [[], []]

        def sent():
            rows = []
            for kind, parts in enumerate(held, 1):
                keys, n = _summed(np.concatenate([k for k, _ in parts]), np.concatenate([n for _, n in parts]))
                times = -(-n // 255)  # counts go as bytes; a larger one takes several
                last = np.cumsum(times) - 1
                keys, counts = np.repeat(keys, times), np.full(int(times.sum()), 255, np.uint8)
                counts[last] = n - 255 * (times - 1)
                rows += [(kind, block, keys[a:b].tobytes(), counts[a:b].tobytes()) for block, a, b in _by_block(keys, blocks)]
                parts.clear()
            return pa.RecordBatch.from_pydict({k: pa.array([r[i] for r in rows], t) for i, (k, t) in enumerate((("kind", pa.int32()), ("block", pa.int32()), ("k", pa.binary()), ("n", pa.binary())))})

        for part in slices(batches):
            h, sizes = hashes(column(part, "text"))
            for parts, keys in zip(held, (h, bigrams(h, sizes)[1]), strict=True):
                parts.append(np.unique(keys, return_counts=True))
            if sum(len(k) for parts in held for k, _ in parts) >= HELD:
                yield sent()
        if held[0]:
            yield sent()

    def merged(group: pa.Table) -> pa.Table:
        kinds = group.column("kind").to_pylist()
        keys, counts = (group.column(c).to_pylist() for c in ("k", "n"))
        row: dict = {"block": group.column("block")[0].as_py()}
        stored = []
        for kind in (1, 2):
            own = [i for i, k in enumerate(kinds) if k == kind]
            k = np.concatenate([np.frombuffer(keys[i], "<u8") for i in own] or [np.zeros(0, np.uint64)])
            n = np.concatenate([np.frombuffer(counts[i], np.uint8) for i in own] or [np.zeros(0, np.uint8)]).astype(np.int64)
            k, n = _summed(k, n)
            stored.append((k, level(n)))
            if kind == 1:
                row |= {"tokens": int(n.sum()), "words": len(k), "uni": k.tobytes(), "uni_n": n.astype("<i8").tobytes(), "uni_levels": np.bincount(level(n), minlength=LEVELS)[:LEVELS].tolist()}
            else:
                row |= {"pairs": len(k), "once": int((n == 1).sum()), "twice": int((n == 2).sum())}
        return pa.Table.from_pylist([row | {"bits": LogBloom.block_bits(stored)}], schema=COUNTS)

    train = docs.select("text").mapInArrow(packed, "kind int, block int, k binary, n binary")
    return written(train.groupBy("block").applyInArrow(merged, COUNTS_DDL), "ngrams")


class Model:
    """What scoring needs on every worker; all parts are of bounded size.  ``bloom`` is None where it is too large for that."""

    def __init__(self, bloom: LogBloom | None, stats: dict, keys: np.ndarray, counts: np.ndarray, whole: bool, blocks: int):
        self.bloom, self.keys, self.counts, self.whole, self.blocks = bloom, keys, counts, whole, blocks
        self.tokens, self.words = stats["tokens"], stats["words"]
        self.discount = stats["once"] / max(1, stats["once"] + 2 * stats["twice"])
        self.mass = self.discount * stats["pairs"] / max(1, stats["tokens"])

    def smoothed(self, counts: np.ndarray) -> np.ndarray:
        """(c + ALPHA) / (N + ALPHA (V + 1))."""
        return (counts + ALPHA) / (self.tokens + ALPHA * (self.words + 1))

    def score(self, own: np.ndarray, pair: np.ndarray, end: int, sizes: np.ndarray) -> np.ndarray:
        """The model's log10 probability of each text, from the levels of its words, of its bigrams and of the end."""
        starts = np.cumsum(sizes) - sizes
        own = LEVEL_COUNT[own]
        context = np.empty_like(own)
        context[1:] = own[:-1]
        context[starts] = LEVEL_COUNT[end]  # as many beginnings as ends
        both = np.minimum(LEVEL_COUNT[pair], np.minimum(context, own))
        known = np.maximum(both - self.discount, 0) / np.maximum(context, 1) + self.mass * self.smoothed(own)
        return np.add.reduceat(np.log10(np.where(context > 0, np.minimum(known, 1), self.smoothed(own))), starts)


def learn(docs: DataFrame, most_bits: int = MOST_BITS, table_words: int = TABLE_WORDS) -> tuple[Model, DataFrame]:
    """The model of ``docs``, and their counts by hash block."""
    blocks = _blocks(docs)
    counts = ngram_counts(docs, blocks)
    sums = ("tokens", "words", "pairs", "once", "twice")
    row = counts.agg(*(F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in sums), F.coalesce(F.sum(F.octet_length("bits")), F.lit(0)).alias("bytes")).first()
    by_level = dict(counts.select(F.posexplode("uni_levels").alias("q", "n")).groupBy("q").agg(F.sum("n")).collect())
    floor = next((q for q in range(1, LEVELS) if sum(by_level.get(x, 0) for x in range(q, LEVELS)) <= table_words), LEVELS)

    def frequent(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                u, n = (np.frombuffer(batch.column(batch.schema.get_field_index(k))[i].as_py(), t) for k, t in (("uni", "<u8"), ("uni_n", "<i8")))
                keep = level(n) >= floor
                if keep.any():
                    yield pa.RecordBatch.from_pydict({"block": batch.column(0).slice(i, 1), "k": pa.array([u[keep].tobytes()], pa.binary()), "n": pa.array([n[keep].tobytes()], pa.binary())})

    made = sorted(counts.select("block", "uni", "uni_n").mapInArrow(frequent, "block int, k binary, n binary").collect())  # 16 x table_words bytes at most
    keys, exact = (np.frombuffer(b"".join(r[i] for r in made), t) for i, t in ((1, "<u8"), (2, "<i8")))
    bloom = None
    if 8 * row.bytes <= most_bits:
        bloom = LogBloom.gathered(counts, blocks)  # most_bits / 8 bytes at most
    return Model(bloom, row.asDict(), keys, exact, floor == 1, blocks), counts


def partitioned_scores(rows: DataFrame, model: Model, counts: DataFrame, waves: int = WAVES) -> DataFrame:
    """(row, score) by a filter that stays in its blocks: distinct n-grams of each slice go to their blocks, and their levels come back to the slice.

    A slice is some MB of text, or one longer text; nothing else is held at
    once.  Each of ``waves`` scans sends every so-many-th slice, and what it
    sent is deleted when its scores are written.
    """
    blocks, light = model.blocks, Model(None, {k: 0 for k in ("tokens", "words", "once", "twice", "pairs")}, model.keys[:0], model.counts[:0], True, model.blocks)
    light.tokens, light.words, light.discount, light.mass = model.tokens, model.words, model.discount, model.mass

    def asked(batches, wave):
        """Slices (their rows and where each word and bigram is among their distinct n-grams), and what they ask of each block."""
        number = TaskContext.get().partitionId() << 32
        at = TaskContext.get().partitionId() << 40
        first = TaskContext.get().partitionId()
        for k, part in enumerate(slices(batches)):
            if (first + k) % waves != wave:
                at += part.num_rows
                continue
            h, sizes = hashes(column(part, "text"))
            distinct, which = np.unique(np.concatenate([h, bigrams(h, sizes)[1], [END]]), return_inverse=True)
            out = [(number, None, np.arange(at, at + len(sizes)).tobytes(), sizes.tobytes(), which.astype("<u4").tobytes())]
            out += [(number, block, np.arange(a, b).astype("<u4").tobytes(), distinct[a:b].tobytes(), None) for block, a, b in _by_block(distinct, blocks)]
            yield pa.RecordBatch.from_pydict({k: pa.array([r[i] for r in out], t) for i, (k, t) in enumerate((("slice", pa.int64()), ("block", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("which", pa.binary())))})
            number, at = number + 1, at + len(sizes)

    def answered(left: pa.Table, right: pa.Table) -> pa.Table:
        shift = len(left)
        bits = right.column("bits")[0].as_py() if right.num_rows else bytes(LEAST_BITS // 8)
        bloom = LogBloom(np.frombuffer(bits, np.uint8), np.zeros(1, np.uint64), np.array([8 * len(bits)], np.uint64))
        out = [bloom.levels(np.frombuffer(x, "<u8")).astype(np.uint8).tobytes() for x in left.column("b").to_pylist()] if shift else []
        return pa.table({"slice": left.column("slice"), "a": left.column("a"), "levels": pa.array(out, pa.binary())})

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        row, sizes = (np.frombuffer(left.column(k)[0].as_py(), "<i8") for k in ("a", "b"))
        which = np.frombuffer(left.column("which")[0].as_py(), "<u4")
        of = np.zeros(int(which.max()) + 1, np.int64)
        for a, q in zip(right.column("a").to_pylist(), right.column("levels").to_pylist(), strict=True):
            of[np.frombuffer(a, "<u4")] = np.frombuffer(q, np.uint8)
        found, n = of[which], int(sizes.sum())
        return pa.table({"row": row, "score": light.score(found[:n], found[n : 2 * n], int(found[-1]), sizes)})

    ddl = "slice long, block int, a binary, b binary, which binary"
    bits = counts.select("block", "bits").groupBy("block")
    out = []
    for wave in range(waves):
        with scratch(rows.sparkSession):
            sent = written(rows.mapInArrow(partial(asked, wave=wave), ddl), "asked")
            levels = sent.where("block is not null").select("slice", "block", "a", "b").groupBy("block").cogroup(bits).applyInArrow(answered, "slice long, a binary, levels binary")
            levels = written(levels, "levels")
            own = sent.where("block is null").select("slice", "a", "b", "which").groupBy("slice")
            out.append(written(own.cogroup(levels.groupBy("slice")).applyInArrow(scored, "row long, score double"), "scores", keep=True))
    return reduce(DataFrame.unionByName, out)


SCORED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()), ("block", pa.int32()), ("rows", pa.binary()), ("rare", pa.binary())])
SCORED_DDL = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, block int, rows binary, rare binary"


def lm_scores(docs: DataFrame, most_bits: int = MOST_BITS, table_words: int = TABLE_WORDS) -> DataFrame:
    """Token counts, base score and model score of every document; one row per input row.

    A null or empty text is its end alone.  Rows with a null doc_id are neither
    held out nor learned from; repeated rows count and are scored each; if
    nothing is learned, every token has probability one.  An empty table gives
    no rows.  Other columns are ignored.  ``most_bits`` and ``table_words`` say
    what is broadcast and never change a result.
    """
    held = F.coalesce(crc_mod(F.col("doc_id"), 10) == 0, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long"), "text", held.alias("held_out"))
    ensure_shipped(docs.sparkSession)
    model, counts = learn(rows.where("doc_id is not null and not held_out"), most_bits, table_words)
    sent, blocks, spread = docs.sparkSession.sparkContext.broadcast(model), model.blocks, model.bloom is None
    model.bloom = None  # the driver needs it no more

    def scores(own, h, sizes, distinct, which):
        if own.bloom is None:
            return np.zeros(len(sizes))
        return own.score(own.bloom.levels(distinct)[which], own.bloom.levels(bigrams(h, sizes)[1]), int(own.bloom.levels(np.array([END]))[0]), sizes)

    def scored(batches):
        own, at = sent.value, TaskContext.get().partitionId() << 40
        for part in slices(batches):
            n = part.num_rows
            h, sizes = hashes(column(part, "text"))
            starts = np.cumsum(sizes) - sizes
            distinct, which = np.unique(h, return_inverse=True)
            found = np.minimum(np.searchsorted(own.keys, distinct), max(0, len(own.keys) - 1))
            known = own.keys[found] == distinct if len(own.keys) else np.zeros(len(distinct), bool)
            c = np.where(known, own.counts[found] if len(own.keys) else 0, 0)[which]
            here = np.ones(len(h), bool) if own.whole else known[which]
            base = np.add.reduceat(np.where(here, np.log10(own.smoothed(c)), 0.0), starts)
            docs_ = (np.arange(at, at + n), part.column(0), part.column(2), sizes, np.add.reduceat((c > 0).astype(np.int64), starts), base, scores(own, h, sizes, distinct, which))
            none = [None] * n
            yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip((*docs_, none, none, none), SCORED, strict=True)], schema=SCORED)
            if not here.all():
                rare = np.flatnonzero(~here)
                rare = rare[np.argsort(h[rare], kind="stable")]
                row = np.repeat(np.arange(at, at + n), sizes)[rare]
                sent_rows = [(block, row[a:b].tobytes(), h[rare[a:b]].tobytes()) for block, a, b in _by_block(h[rare], blocks)]
                none = [None] * len(sent_rows)
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((*[none] * 7, *zip(*sent_rows, strict=True)), SCORED, strict=True)], schema=SCORED)
            at += n

    out = written(rows.mapInArrow(scored, SCORED_DDL), "scored")
    result = out.where("row is not null")
    if not model.whole:
        tokens, words = model.tokens, model.words

        def looked_up(left: pa.Table, right: pa.Table) -> pa.Table:
            keys, n = (np.frombuffer(right.column(k)[0].as_py(), t) if right.num_rows else np.zeros(0, t) for k, t in (("uni", "<u8"), ("uni_n", "<i8")))
            row = np.frombuffer(b"".join(left.column("rows").to_pylist()), "<i8")
            rare = np.frombuffer(b"".join(left.column("rare").to_pylist()), "<u8")
            found = np.minimum(np.searchsorted(keys, rare), max(0, len(keys) - 1))
            c = np.where(keys[found] == rare, n[found], 0) if len(keys) else np.zeros(len(rare), np.int64)
            log = np.log10((c + ALPHA) / (tokens + ALPHA * (words + 1)))
            doc, of = np.unique(row, return_inverse=True)
            return pa.table({"row": doc, "more": np.bincount(of, log, len(doc)).astype(float), "known": np.bincount(of, c > 0, len(doc)).astype(np.int64)})

        rare = out.where("row is null").select("block", "rows", "rare").groupBy("block")
        more = rare.cogroup(counts.select("block", "uni", "uni_n").groupBy("block")).applyInArrow(looked_up, "row long, more double, known long").groupBy("row").agg(F.sum("more").alias("more"), F.sum("known").alias("known"))
        result = result.join(more, "row", "left").withColumn("base", F.col("base") + F.coalesce("more", F.lit(0.0))).withColumn("n_known", F.col("n_known") + F.coalesce("known", F.lit(0)))
    if spread:
        result = result.drop("score").join(partitioned_scores(rows, model, counts), "row")
    return result.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score")


def op10_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))
