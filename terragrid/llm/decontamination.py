r"""Benchmark decontamination by a distributed positional inverted index.

The index is partitioned by document: each segment holds some documents and,
for every word in them, the sorted list of its positions in the segment's word
stream (documents stand GAP apart, so no phrase crosses two).  Segments are
stored once in the shared folder, whatever is to be looked for, and are
searched where they lie: of each phrase the rarest word's list is taken,
shifted by the word's offset, and intersected with the shifted lists of the
other words, rarest first.  What is left are exact phrase matches.  Proximity
matches keep candidates whose words all occur within a given distance.

Test items are searched in blocks of bounded size, all against that one index,
and what the blocks find in a document is joined before it is counted.

Words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ensure_shipped
from .common import batch_of, column, few, runs, slices, table, written

#: Words of a window; a document with hits is contaminated if RATIO * n_hit >= n_words.
WINDOW, RATIO = 13, 20
#: Empty positions between documents of a segment.
GAP = 1024
#: Text bytes of a segment (a longer text is one), bytes of segments that a writer holds at once.
SEGMENT_BYTES, WRITER_BYTES = 1 << 20, 16 << 20
#: UTF-8 bytes of test texts searched at once; more are searched in blocks of this size, and words of an item above which it is several rows.
BLOCK_BYTES, PART_WORDS = 8 << 20, 1 << 17
_KEPT = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    """The words of a text, as UTF-8."""
    return text.encode().translate(_KEPT).split() if text else []


def windows(tokens: list, width: int = WINDOW) -> list[tuple]:
    """All runs of ``width`` words; a shorter, not empty, sequence is one."""
    return [tuple(tokens[i : i + width]) for i in range(max(1, len(tokens) - width + 1))] if tokens else []


class Phrases:
    """A block of test items: their vocabulary, distinct windows and which items have them."""

    def __init__(self, items: list[tuple[str, str | None]], width: int = WINDOW):
        self.items = [str(i) for i, _ in items]
        self.vocab: dict[bytes, int] = {}
        seen: dict[tuple, int] = {}
        pairs = []
        for k, (_, text) in enumerate(items):
            for w in windows(words(text), width):
                ids = tuple(self.vocab.setdefault(x, len(self.vocab)) for x in w)
                pairs.append((seen.setdefault(ids, len(seen)), k))
        self.windows = np.full((len(seen), width), -1, np.int32)
        self.length = np.zeros(len(seen), np.int32)
        for ids, k in seen.items():
            self.windows[k, : len(ids)], self.length[k] = ids, len(ids)
        of = np.array(sorted(set(pairs)), np.int64).reshape(-1, 2)
        self.item_at = np.searchsorted(of[:, 0], np.arange(len(seen) + 1))
        self.item_of = of[:, 1]


_LISTS = (("doc_id", pa.int64()), ("key", pa.int64()), ("start", pa.int64()), ("n_words", pa.int64()), ("term", pa.binary()), ("term_start", pa.int64()), ("position", pa.int32()))
INDEX = pa.schema([("segment", pa.int64()), *((k, pa.list_(t)) for k, t in _LISTS)])
INDEX_DDL = "segment long, doc_id array<long>, key array<long>, start array<long>, n_words array<long>, term array<binary>, term_start array<long>, position array<int>"


def postings(texts: list[str | None]) -> tuple:
    """One segment: (starts, word counts, terms, list starts, positions)."""
    starts, lengths, found, at, vocab = [], [], [], 0, {}
    for text in texts:
        starts.append(at)
        for run in runs(text.encode().translate(_KEPT) if text else b""):
            own = run.split()
            found.append(np.fromiter((vocab.setdefault(w, len(vocab)) for w in own), np.int32, len(own)))
            at += len(own)
        lengths.append(at - starts[-1])
        found.append(np.full(GAP, -1, np.int32))
        at += GAP
    stream = np.concatenate(found)
    known = np.flatnonzero(stream >= 0).astype(np.int32)
    order = known[np.argsort(stream[known], kind="stable")]
    sizes = np.bincount(stream[known], minlength=len(vocab))
    return np.array(starts, np.int64), np.array(lengths, np.int64), list(vocab), np.concatenate([[0], np.cumsum(sizes)]), order


def build_index(docs: DataFrame) -> DataFrame:
    """The stored index of ``docs``: one row per segment, written to the shared folder.

    A segment is what a task reads at once (a MB of text); a longer text
    forms its own.  A column ``key`` (long) is kept beside doc_id, if there.
    """
    key = F.col("key") if "key" in docs.columns else F.lit(None)

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for part in slices(batches, most=SEGMENT_BYTES):
            yield batch_of(INDEX, [number], *([x] for x in (column(part, "doc_id"), column(part, "key"), *postings(column(part, "text")))))
            number += 1

    return written(docs.select(F.col("doc_id").cast("long"), key.cast("long").alias("key"), "text").mapInArrow(run, INDEX_DDL), "postings", WRITER_BYTES)


class Segment:
    """One segment's posting lists, and searches over them."""

    def __init__(self, start: np.ndarray, n_words: np.ndarray, term: list[bytes], term_start: np.ndarray, position: np.ndarray):
        self.start, self.n_words, self.term, self.term_start, self.position = start, n_words, term, term_start, position
        self.at = {t: i for i, t in enumerate(term)}
        self.size = int(start[-1] + n_words[-1] + GAP) if len(start) else 0

    @classmethod
    def stored(cls, batch: pa.RecordBatch, i: int) -> Segment:
        of = lambda name: batch.column(batch.schema.get_field_index(name))[i].values
        own = {k: of(k).to_numpy(zero_copy_only=False) for k in ("start", "n_words", "term_start", "position")}
        return cls(own["start"], own["n_words"], of("term").to_pylist(), own["term_start"], own["position"])

    def local(self, phrases: Phrases) -> np.ndarray:
        """Where the terms of ``phrases`` are in this segment, -1 for what it does not have; the last: no term."""
        return np.array([*(self.at.get(t, -1) for t in phrases.vocab), -1], np.int32)

    def search(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
        """(window, position) of every exact occurrence."""
        width = phrases.windows.shape[1]
        if not len(phrases.windows) or not len(self.position):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        own = self.local(phrases)[phrases.windows]
        sizes = np.append(np.diff(self.term_start), 0)  # the last: no term
        first = self.term_start
        inside = np.arange(width) < phrases.length[:, None]
        weight = np.where(inside, sizes[own], np.iinfo(np.int64).max)
        alive = np.flatnonzero(weight.min(1) > 0)  # every term occurs
        rarest = np.argsort(weight[alive], axis=1, kind="stable")
        lists = np.full(self.size + width, -1, np.int32)  # which term's list a position is on
        lists[self.position] = np.repeat(np.arange(len(self.term), dtype=np.int32), np.diff(self.term_start))
        out_w, out_p = [], []
        step = 1 << 20
        begin = 0
        sizes = weight[alive, rarest[:, 0]]
        ends = np.cumsum(sizes)
        while begin < len(alive):  # candidates of bounded number at once
            base = ends[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(ends, base + step, "right")))
            rows, n = alive[begin:stop], sizes[begin:stop]
            offset = rarest[begin:stop, 0]
            lead = own[rows, offset]
            at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[lead], n)
            window, order = np.repeat(rows, n), np.repeat(np.arange(begin, stop), n)
            pos = self.position[at].astype(np.int64) - np.repeat(offset, n)
            ok = pos >= 0
            window, order, pos = window[ok], order[ok], pos[ok]
            for j in range(1, width):
                if not len(pos):
                    break
                shift = rarest[order, j]
                ok = (lists[pos + shift] == own[window, shift]) | (shift >= phrases.length[window])
                window, order, pos = window[ok], order[ok], pos[ok]
            out_w.append(window)
            out_p.append(pos)
            begin = stop
        return np.concatenate(out_w or [np.zeros(0, np.int64)]), np.concatenate(out_p or [np.zeros(0, np.int64)])

    def postings_of(self, term: bytes) -> np.ndarray:
        """One word's positions."""
        k = self.at.get(term)
        return np.zeros(0, np.int32) if k is None else self.position[self.term_start[k] : self.term_start[k + 1]]

    def near(self, terms: list[bytes], distance: int) -> list[int]:
        """Positions of the rarest term (of equals, the lowest) around which all ``terms`` lie within ``distance`` words."""
        lists = sorted(map(self.postings_of, sorted(set(terms))), key=len)
        if not lists:
            return []
        pos = lists[0].astype(np.int64)
        for other in lists[1:]:
            pos = pos[np.searchsorted(other, pos + distance, "right") > np.searchsorted(other, pos - distance, "left")]
        return pos.tolist()

    def near_windows(self, phrases: Phrases, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, position) of every proximity match of a window's terms."""
        if not len(phrases.windows) or not len(self.position):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        vocab, inside = list(phrases.vocab), np.arange(phrases.windows.shape[1]) < phrases.length[:, None]
        alive = np.flatnonzero(((self.local(phrases)[phrases.windows] >= 0) | ~inside).all(1))
        found = [self.near([vocab[t] for t in phrases.windows[w, : phrases.length[w]]], distance) for w in alive]
        return np.repeat(alive, [len(x) for x in found]), np.array([p for x in found for p in x], np.int64)

    def doc_at(self, pos: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.start, pos, "right") - 1


SPAN = pa.struct([("a", pa.int64()), ("b", pa.int64())])
HIT = pa.schema([("segment", pa.int64()), ("row", pa.int32()), ("spans", pa.list_(SPAN)), ("items", pa.list_(pa.string()))])


def _judged(segment: Segment, phrases: Phrases) -> list[tuple[int, list[dict], list[str]]]:
    """(row, spans of words covered, items) of every document with hits."""
    window, pos = segment.search(phrases)
    if not len(pos):
        return []
    edges = np.zeros(segment.size + 2, np.int64)
    np.add.at(edges, pos + 1, 1)
    np.add.at(edges, pos + 1 + phrases.length[window], -1)
    inside = np.diff((np.cumsum(edges) > 0).astype(np.int8))
    begin, end = np.flatnonzero(inside > 0), np.flatnonzero(inside < 0)
    of_span = segment.doc_at(begin)
    rows, first = np.unique(of_span, return_index=True)
    doc = segment.doc_at(pos)
    items: dict[int, set] = {}
    for d, w in set(zip(doc.tolist(), window.tolist(), strict=True)):
        items.setdefault(d, set()).update(phrases.item_of[phrases.item_at[w] : phrases.item_at[w + 1]].tolist())
    out = []
    for row, a, b in zip(rows.tolist(), first, [*first[1:], len(begin)], strict=True):
        spans = [{"a": int(x), "b": int(y)} for x, y in zip(begin[a:b], end[a:b], strict=True)]
        out.append((row, spans, sorted({phrases.items[k] for k in items[row]})))
    return out


def searched(index: DataFrame, benchmark: DataFrame, width: int, block_bytes: int) -> DataFrame:
    """(doc_id, key, n_words, n_hit, n_items, items) of every document of a stored index; items: their ids, sorted and comma-joined."""
    found = None
    for part in blocks(benchmark, width, block_bytes):
        sent = index.sparkSession.sparkContext.broadcast(Phrases(items_of(part), width))

        def run(batches, sent=sent):
            for batch in batches:
                for i in range(batch.num_rows):  # a row is a whole segment
                    if out := _judged(Segment.stored(batch, i), sent.value):
                        yield batch_of(HIT, [batch.column(0)[i].as_py()] * len(out), *zip(*out, strict=True))

        one = index.mapInArrow(run, "segment long, row int, spans array<struct<a: long, b: long>>, items array<string>")
        found = one if found is None else found.unionByName(one)
    every = written(found, "hits").groupBy("segment", "row").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    covered = F.expr("aggregate(spans, named_struct('n', 0L, 'last', -1L), (s, x) -> named_struct('n', s.n + greatest(0L, x.b - greatest(x.a, s.last)), 'last', greatest(s.last, x.b))).n")
    hits = written(every.select("segment", "row", covered.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.array_join("items", ",").alias("items")), "hits")
    rows = index.select("segment", F.posexplode(F.arrays_zip("doc_id", "key", "n_words")).alias("row", "of")).select("segment", "row", "of.*")
    zero = F.lit(0).cast("long")
    return rows.join(hits, ["segment", "row"], "left").select("doc_id", "key", "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"), F.coalesce("items", F.lit("")).alias("items"))


MATCH = pa.schema([("doc_id", pa.int64()), ("item_id", pa.string()), ("at", pa.int64()), ("length", pa.int64()), ("exact", pa.bool_())])


def occurrences(index: DataFrame, phrases: Phrases, distance: int | None = None) -> DataFrame:
    """(doc_id, item_id, at, length, exact) of every match in a stored index; ``at`` counts words from the document's start.

    Exact matches are phrases.  With a ``distance`` there are proximity matches
    as well (not exact, of length 1): places of a window's rarest word in the
    segment with all its other words within ``distance`` words, in any order.
    """
    if distance is not None and not 0 <= distance < GAP:
        raise ValueError(f"distance must be from 0 to {GAP - 1}")
    sent = index.sparkSession.sparkContext.broadcast(phrases)

    def rows(ids: list, segment: Segment, own: Phrases, window: np.ndarray, pos: np.ndarray, exact: bool) -> list[tuple]:
        doc, out = segment.doc_at(pos), set()
        for d, p, w in zip(doc.tolist(), pos.tolist(), window.tolist(), strict=True):
            for k in own.item_of[own.item_at[w] : own.item_at[w + 1]].tolist():
                out.add((d, p - int(segment.start[d]), int(own.length[w]) if exact else 1, own.items[k]))
        return [(ids[d], item, at, n, exact) for d, at, n, item in sorted(out)]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):  # a row is a whole segment
                segment, ids = Segment.stored(batch, i), batch.column(batch.schema.get_field_index("doc_id"))[i].as_py()
                out = rows(ids, segment, sent.value, *segment.search(sent.value), True)
                if distance is not None:
                    out += rows(ids, segment, sent.value, *segment.near_windows(sent.value, distance), False)
                if out:
                    yield batch_of(MATCH, *zip(*out, strict=True))

    return index.mapInArrow(run, "doc_id long, item_id string, at long, length long, exact boolean")


def matches(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, distance: int | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All exact phrase matches, and with a ``distance`` all proximity matches, of test items in documents.

    Texts without words and items without an id match nothing; a null doc_id
    stays null; repeated rows match each; empty tables give no rows.
    """
    ensure_shipped(docs.sparkSession)
    found, index = None, build_index(docs)
    for part in blocks(benchmark, width, block_bytes):
        one = occurrences(index, Phrases(items_of(part), width), distance)
        found = one if found is None else found.unionByName(one)
    return found.distinct() if found is not None else None


PARTS = pa.schema([("item_id", pa.string()), ("part", pa.int64()), ("text", pa.string())])


def blocks(benchmark: DataFrame, width: int, most: int) -> list[DataFrame]:
    """The test items in blocks of about ``most`` bytes at most.

    An item of more than PART_WORDS words is several rows, each with the last
    ``width`` - 1 words of the one before, so that together they have its
    windows; many rows of one item_id are dealt out as well.
    """

    def cut(batches):
        step = max(1, PART_WORDS - width + 1)
        for batch in slices(batches):
            out = []
            for item, text in zip(column(batch, "item_id"), column(batch, "text"), strict=True):
                own = words(text)
                for at in range(0, max(1, len(own) - width + 1), step) if own else ():
                    out.append((item, at, b" ".join(own[at : at + max(PART_WORDS, width)]).decode()))
            if out:
                yield batch_of(PARTS, *zip(*out, strict=True))

    named = benchmark.select(F.col("item_id").cast("string"), "text").where("item_id is not null")
    parts = written(named.mapInArrow(cut, "item_id string, part long, text string"), "items")
    size = parts.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    n = 1 if size <= most else 2 * -(-size // most)
    return [parts.where(F.pmod(F.xxhash64("item_id", "part", "text"), F.lit(n)) == k) for k in range(n)]


def items_of(block: DataFrame) -> list[tuple[str, str | None]]:
    """The items of a block, whose size blocks() has bounded; of repeated ids all texts count."""
    return [(r.item_id, r.text) for r in block.select("item_id", "text").distinct().collect()]


def _verdict(ratio: int):
    return (F.col("n_hit") > 0) & (ratio * F.col("n_hit") >= F.col("n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, ratio: int = RATIO, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Words, words hit by test windows, items found and the verdict of every document.

    One row per input row.  A null or empty text has no words and is clean.  A
    null doc_id stays null; repeated rows are judged each; of test rows with
    one item_id all texts count as that item; a row with a null item_id or
    without words is never found; an empty table gives no rows, or no hits.
    Other columns are ignored.  ``block_bytes`` bounds what is searched for at
    once and never changes a result.
    """
    ensure_shipped(docs.sparkSession)
    hits = searched(build_index(docs.select("doc_id", "text")), benchmark, width, block_bytes)
    return hits.select("doc_id", "n_words", "n_hit", "n_items", F.sha2("items", 256).alias("items_sha256"), _verdict(ratio).alias("contaminated"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, ratio: int = RATIO, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows whose documents are not contaminated, with all their columns.

    The verdict is one on a text, and rows go by their texts (a 128-bit hash),
    not by their ids: null and repeated ids change nothing.  Null and empty
    texts stay; repeated rows stay or go together; an empty table gives no
    rows; with an empty benchmark all rows stay.
    """
    ensure_shipped(docs.sparkSession)
    text = F.col("text")
    hashes = (F.xxhash64(text), F.xxhash64(F.lit(1), text))
    index = build_index(docs.select(hashes[0].alias("doc_id"), hashes[1].alias("key"), text))
    bad = searched(index, benchmark, width, block_bytes).where(_verdict(ratio)).select(F.col("doc_id").alias("__a"), F.col("key").alias("__b")).distinct()
    bad = few(written(bad, "contaminated"))
    return docs.join(bad, (hashes[0] == F.col("__a")) & (hashes[1] == F.col("__b")), "left_anti")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_SPLIT = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, {_SPLIT} AS w FROM documents),
b AS (SELECT item_id, {_SPLIT} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, w[i : i + {WINDOW - 1}] AS win FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - {WINDOW - 1}))) AS i FROM b WHERE len(w) > 0)),
size AS (SELECT DISTINCT len(win) AS n FROM win),
own AS (SELECT doc_id, i, n, w[i : i + n - 1] AS win FROM (SELECT doc_id, n, w, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, size)),
hit AS (SELECT doc_id, i, n, item_id FROM own JOIN win USING (win)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND {RATIO} * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN words ON words.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id"""
