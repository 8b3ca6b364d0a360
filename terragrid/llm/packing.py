"""Vector bin packing of token sequences under several limits at once.

Examples carry a vector of demands: tokens, segments and loss-bearing tokens.
Open bins carry what is left of each.  The dot-product heuristic places an
example into the bin, among those it fits, whose remaining capacity has the
greatest dot product with the example's demand (both as shares of the limits),
so that no one limit runs out while others stand empty.  Plain documents bear
loss on all tokens, so that limit binds for conversations, whose loss lies on
the assistant's turns.  Every task packs the rows it reads: nothing is
shuffled, and a lost task gives the same bins again when its rows are reread.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from ..shipping import ensure_shipped
from .common import batch_of, column, slices, table

#: Limits of a sequence: tokens, segments, loss-bearing tokens (of documents, of conversations).
TOKENS, SEGMENTS, LOSS, TURN_LOSS = 2048, 64, 2048, 1024
#: Open bins a task keeps; when there are more, the fullest is closed (the next cut fills it first).
OPEN_BINS = 32


class VectorPacker:
    """Bins under simultaneous limits, filled by the dot-product rule.

    ``cut`` allows an example to be divided; then no bin is left part-filled
    while examples remain.  ``place`` gives (bin, offset, start, length) of
    each piece of an example.
    """

    def __init__(self, tokens: int = TOKENS, segments: int = SEGMENTS, loss: int = LOSS, open_bins: int = OPEN_BINS, cut: bool = True):
        if min(tokens, segments, loss) < 1:
            raise ValueError("limits must be positive")
        self.limit = np.array([tokens, segments, loss], float)
        self.left = np.zeros((0, 3))
        self.ids = np.zeros(0, np.int64)
        self.open_bins, self.cut, self.bins = open_bins, cut, 0
        self.closed: list[int] = []  # bins that take no more; the caller empties the list

    def _open(self) -> int:
        self.left = np.vstack([self.left, self.limit])
        self.ids = np.append(self.ids, self.bins)
        self.bins += 1
        return len(self.ids) - 1

    def _take(self, k: int, demand: np.ndarray) -> tuple[int, int]:
        offset = int(self.limit[0] - self.left[k, 0])
        self.left[k] -= demand
        where = int(self.ids[k])
        if self.left[k, 0] < 1 or self.left[k, 1] < 1:
            self._close(k)
        return where, offset

    def _close(self, k: int) -> None:
        self.closed.append(int(self.ids[k]))
        self.left = np.delete(self.left, k, 0)
        self.ids = np.delete(self.ids, k)

    def best(self, demand: np.ndarray) -> int | None:
        """The open bin that the demand fits with the greatest dot product; of equals, the oldest."""
        if not len(self.ids):
            return None
        share = self.left / self.limit
        score = share @ (demand / self.limit)
        score[(self.left < demand).any(1)] = -1
        k = int(score.argmax())
        return k if score[k] >= 0 else None

    def place(self, length: int, loss: np.ndarray | None = None) -> list[tuple[int, int, int, int]]:
        """Pieces of an example of ``length`` tokens; ``loss`` marks its loss-bearing tokens (None: all)."""
        bearing = np.arange(length + 1) if loss is None else np.concatenate([[0], np.cumsum(np.asarray(loss, bool))])
        out, at = [], 0
        while at < length:
            whole = np.array([length - at, 1, bearing[-1] - bearing[at]], float)
            k, n = self.best(whole), length - at
            fits = bool((whole <= self.limit).all())
            if k is None and not (fits or self.cut):
                raise ValueError("an example exceeds a limit and may not be cut")
            if k is None and len(self.ids) >= self.open_bins:
                useful = np.flatnonzero((self.left[:, 2] >= 1) | (whole[2] == 0)) if self.cut else []
                if len(useful):  # top up the bin with least room
                    k = int(useful[self.left[useful, 0].argmin()])
                else:
                    self._close(int(self.left[:, 0].argmin()))
            if k is None:
                k = self._open()
            if (whole > self.left[k]).any():
                n = int(min(n, self.left[k, 0]))
                n = min(n, int(np.searchsorted(bearing, bearing[at] + self.left[k, 2], "right")) - 1 - at)
                if n < 1:  # a loss-bearing token is next, and no room for one
                    self._close(k)
                    continue
            used = np.array([n, 1, bearing[at + n] - bearing[at]], float)
            where, offset = self._take(k, used)
            out.append((where, offset, at, n))
            at += n
        return out


PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
OUT = pa.schema([(x.split()[0], pa.int64()) for x in PIECE.split(", ")])


def powers(n: int) -> list[int]:
    """``n`` as falling powers of two."""
    return [1 << i for i in reversed(range(n.bit_length())) if n >> i & 1]


def taken(pieces: list[tuple], n: int) -> tuple[list[tuple], list[tuple]]:
    """The first ``n`` tokens of a list of pieces (doc, start, length, ids, total), and the rest."""
    head, rest = [], list(pieces)
    while n and rest:
        doc, start, length, raw, total = rest.pop(0)
        k = min(n, length)
        head.append((doc, start, k, raw[: 4 * k], total))
        if k < length:
            rest.insert(0, (doc, start + k, length - k, raw[4 * k :], total))
        n -= k
    return head, rest


def halved(pieces: list[tuple], size: int) -> list[list[tuple]]:
    """Pieces of ``size`` tokens divided into runs of power-of-two lengths, which need no padding."""
    out = []
    for n in powers(size):
        head, pieces = taken(pieces, n)
        out.append(head)
    return out


def _packing(make, tokens: int, segments: int, loss: int):
    """The ``mapInArrow`` function that packs what ``make()``'s function gives of a batch: (id, token ids as bytes, loss marks or None)."""

    def run(batches):
        examples, packer = make(), VectorPacker(tokens, segments, loss)
        base, number = TaskContext.get().partitionId() << 33, 0
        bins: dict[int, list[tuple]] = {}
        marks: dict[int, list] = {}

        def rows(pieces: list[tuple]) -> list[tuple]:
            """One bin's sequences: itself if full, else parts of power-of-two lengths."""
            nonlocal number
            out, size = [], sum(x[2] for x in pieces)
            for kept in [pieces] if size == tokens else halved(pieces, size):
                offset = 0
                for doc, start, length, raw, total in kept:
                    out.append((doc, start, length, zlib.crc32(raw), total, base + number, offset))
                    offset += length
                number += 1
            return out

        def put(own: VectorPacker, doc, start: int, raw: bytes, total: int, loss_of) -> list[tuple]:
            """The rows of the bins that are closed when a piece from ``start`` on is placed."""
            for where, _, at, length in own.place(len(raw) // 4, loss_of):
                bins.setdefault(where, []).append((doc, start + at, length, raw[4 * at : 4 * (at + length)], total))
                marks.setdefault(where, []).append(None if loss_of is None else loss_of[at : at + length])
            out = []
            while own.closed:
                k = own.closed.pop()
                marks.pop(k)
                out += rows(bins.pop(k))
            return out

        for part in slices(batches):
            out = []
            for doc, raw, loss_of in examples(part):
                out += put(packer, doc, 0, raw, len(raw) // 4, loss_of)
            if out:
                yield batch_of(OUT, *zip(*out, strict=True))
        # What stands in bins that are not full is packed again, longest first, one bin open at a time.
        rest = sorted(((p, m) for k in list(bins) for p, m in zip(bins.pop(k), marks.pop(k), strict=True)), key=lambda x: -x[0][2])
        last, out = VectorPacker(tokens, segments, loss, open_bins=1), []
        for (doc, start, _, raw, total), loss_of in rest:
            out += put(last, doc, start, raw, total, loss_of)
        for k in list(bins):
            out += rows(bins.pop(k))
        if out:
            yield batch_of(OUT, *zip(*out, strict=True))

    return run


def pack_documents(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", tokens: int = TOKENS, segments: int = SEGMENTS, loss: int = LOSS, end: int = 1) -> DataFrame:
    """All documents packed into sequences of at most ``tokens`` tokens; one row per piece.

    A document's ids are those of its whole text and then ``end``; all bear
    loss.  It is cut where a sequence is full.  What a task has left over at its
    end is packed once more, and sequences that are not full then are cut to
    lengths that are powers of two, which need no padding.  A null or empty text
    is the one id ``end``; a null doc_id stays null; repeated rows are packed
    each; an empty table gives no rows; other columns are ignored.  Sequence ids
    are unique, not gapless: the task's number in the high bits.
    """
    ensure_shipped(docs.sparkSession)

    def make():
        pieces, stop = bpe.Pieces(bpe.vocabulary_path(vocabulary)), np.asarray([end], "<u4").tobytes()
        return lambda part: ((doc, bpe.encode_ids(text, pieces) + stop, None) for doc, text in zip(column(part, "doc_id"), column(part, "text"), strict=True))

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_packing(make, tokens, segments, loss), PIECE)


def pack_conversations(turns: DataFrame, vocabulary: str = "byte_bpe_50k.json", tokens: int = TOKENS, segments: int = SEGMENTS, loss: int = TURN_LOSS, end: int = 1, speaker: str = "assistant") -> DataFrame:
    """Conversations (conv_id, turn, role, text) packed as documents are, with loss on ``speaker``'s turns alone.

    A conversation is one example: its turns by number, then role and text, each
    ended by ``end``, which bears loss as its turn does.  doc_id is conv_id.
    Null texts are empty, null roles bear no loss, rows without a conv_id are
    one conversation; an empty table gives no rows.
    """
    ensure_shipped(turns.sparkSession)
    every = F.array_sort(F.collect_list(F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))))
    whole = turns.groupBy(F.col("conv_id").cast("long").alias("doc_id")).agg(every.alias("turns"))
    whole = whole.select("doc_id", F.array_join("turns.text", "").alias("text"), F.transform("turns.text", F.char_length).alias("sizes"), F.transform("turns.role", lambda r: r == speaker).alias("loss"))

    def make():
        pieces, stop = bpe.Pieces(bpe.vocabulary_path(vocabulary)), np.asarray([end], "<u4").tobytes()

        def examples(part):
            for doc, text, sizes, bears in zip(*(column(part, k) for k in ("doc_id", "text", "sizes", "loss")), strict=True):
                raw, marks, at = [], [], 0
                for size, yes in zip(sizes, bears, strict=True):
                    own = bpe.encode_ids(text[at : at + size], pieces) + stop
                    raw.append(own)
                    marks.append(np.full(len(own) // 4, yes))
                    at += size
                yield doc, b"".join(raw), np.concatenate(marks)

        return examples

    return whole.mapInArrow(_packing(make, tokens, segments, loss), PIECE)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
