"""Token counts by a two-tier lookup on the map side.

Tier one is a compact table of frequent pre-tokens and their token counts,
broadcast once; tier two is each worker's cache over the encoder.  No
pre-token is ever shuffled: a document's count is made where it is read.

Which pre-tokens are frequent is found over all documents.  Each task keeps a
Misra-Gries summary of fixed size; summaries merge into one of the same size, a
few at a time.  Every pre-token with more than one in ``entries`` of all
occurrences is sure to be in it.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from .common import batch_of, column, per_text, rows_below, slices, table, written

#: Entries of a summary and of the broadcast table, its bytes at most, summaries merged at once.
TABLE_ENTRIES, TABLE_BYTES, FAN_IN = 32_768, 4 << 20, 16


class FrequentTable:
    """Pre-tokens in one UTF-8 blob with end offsets and counts: about 12 bytes an entry."""

    def __init__(self, pieces: list[str], lengths: list[int]):
        kept, size = [], 0
        for piece, n in zip(pieces, lengths, strict=True):
            size += len(piece.encode()) + 8
            if size > TABLE_BYTES:
                break
            kept.append((piece, n))
        raw = [p.encode() for p, _ in kept]
        self.blob, self.ends = b"".join(raw), np.cumsum([len(x) for x in raw], dtype=np.uint32)
        self.lengths = np.asarray([n for _, n in kept], np.uint32)

    def as_dict(self) -> dict[str, int]:
        starts = np.concatenate([[0], self.ends[:-1]]).astype(int) if len(self.ends) else []
        return {self.blob[a:b].decode(): int(n) for a, b, n in zip(starts, self.ends, self.lengths, strict=True)}


def summary(counts: dict[str, int], entries: int) -> dict[str, int]:
    """``counts`` cut to ``entries`` by Misra-Gries: all lose the count of the first that has no room."""
    if len(counts) <= entries:
        return counts
    cut = sorted(counts.values(), reverse=True)[entries]
    return {k: n - cut for k, n in counts.items() if n > cut}


SUMMARY = pa.schema([("part", pa.int64()), ("piece", pa.list_(pa.string())), ("n", pa.list_(pa.int64()))])
SUMMARY_DDL = "part long, piece array<string>, n array<long>"


def _merged(pieces: list[list[str]], counts: list[list[int]], entries: int) -> dict[str, int]:
    seen: Counter = Counter()
    for piece, n in zip(pieces, counts, strict=True):
        seen.update(dict(zip(piece, n, strict=True)))
    return summary(seen, entries)


def frequent_table(docs: DataFrame, path: str, entries: int = TABLE_ENTRIES, fan_in: int = FAN_IN) -> FrequentTable:
    """The frequent tier, from all documents.

    It only decides what is looked up in which tier; counts never depend on it.
    Pre-tokens too long for the cache are left to the second tier.
    """

    def row(part: int, counts: dict[str, int]) -> pa.Table:
        return pa.Table.from_pylist([{"part": part, "piece": list(counts), "n": list(counts.values())}], schema=SUMMARY)

    def counted(batches):
        seen: Counter = Counter()
        for batch in slices(batches):
            own: Counter = Counter()
            for text in column(batch, "text"):
                for part, special in bpe.parts(text or "", path):
                    if special is None:
                        for run in bpe.pretokens(part):
                            own.update(run)
            seen.update({k: n for k, n in own.items() if len(k) <= bpe.CACHE_CHARS})
            if len(seen) > 4 * entries:
                seen = Counter(summary(seen, entries))
        if seen:
            yield from row(TaskContext.get().partitionId(), summary(seen, entries)).to_batches()

    def joined(group: pa.Table) -> pa.Table:
        return row(group.column("part")[0].as_py() // fan_in, _merged(group.column("piece").to_pylist(), group.column("n").to_pylist(), entries))

    found = written(docs.select("text").mapInArrow(counted, SUMMARY_DDL), "frequent")
    while not rows_below(found, fan_in):
        found = written(found.groupBy(F.expr(f"part div {fan_in}")).applyInArrow(joined, SUMMARY_DDL), "frequent")
    last = found.collect()  # fan_in summaries at most
    best = sorted(_merged([r.piece for r in last], [r.n for r in last], entries).items(), key=lambda x: (-x[1], x[0]))
    counter = bpe.Pieces(path, lengths=True)
    return FrequentTable([k for k, _ in best], [counter[k] for k, _ in best])


OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])


def token_counts(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", limit: int = 1024, **tier) -> DataFrame:
    """Tokens of every whole text.

    One row per input row.  A null or empty text has 0 bytes and 0 tokens; a
    null doc_id stays null; repeated rows are counted each; an empty table
    gives an empty result.  Other columns are ignored.  A special string inside
    a text is its one added token, the library's default.  Texts of any length
    are counted whole, in runs of bounded size.
    """
    path = bpe.vocabulary_path(vocabulary)
    sent = docs.sparkSession.sparkContext.broadcast(frequent_table(docs, path, **tier))

    def make():
        here = bpe.vocabulary_path(vocabulary)
        pieces = bpe.Pieces(here, sent.value.as_dict(), lengths=True)

        def step(batch):
            texts = column(batch, "text")
            counts = [bpe.count_tokens(x, pieces) for x in texts]
            yield batch_of(OUT, batch.column(0), [len(x.encode()) if x else 0 for x in texts], counts, [n > limit for n in counts])

        return step

    return per_text(docs.select(F.col("doc_id").cast("long"), "text"), make, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
