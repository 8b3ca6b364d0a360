"""Document quality by histogram gradient-boosted trees over text statistics.

Trees are grown level by level from histograms of binned statistics, then
flattened into arrays so that scoring a batch is a few numpy gathers per level.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch_of, column, crc_mod, per_text, slices, table

#: Labelled documents the trees are fitted on at most: those whose ids have the smallest hashes.
FIT_ROWS = 20_000
#: Trees, depth, learning rate, bins, least rows of a leaf, ridge of leaf values.
TREES, DEPTH, RATE, BINS, LEAF, RIDGE = 60, 4, 0.15, 64, 8, 1.0
#: Score from which a document is taken to be good.
THRESHOLD = 0.3
_RUNS = re.compile(rb"[!?#*$%&|<>=_~^]{2,}")

FEATURES = (
    "log_bytes", "log_words", "log_lines", "word_bytes", "upper", "digit", "space", "punct", "symbol", "non_ascii", "bang", "bar", "period", "comma", "mark_runs",
    "distinct_words", "top_word", "repeat_next", "long_words", "one_byte_words", "line_words", "dup_lines", "lines_ended", "entropy", "deflated", "top_pair", "quotes", "brackets", "at_url", "capital_words",
)


def statistics(text: str | None) -> list[float]:
    """FEATURES of a whole text; all zero for one without words."""
    raw = (text or "").encode()
    words = raw.split()
    n, size = len(words), len(raw)
    if not n:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256).astype(float)
    share = counts / size
    among = lambda chars: float(share[list(chars)].sum())
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    lines = [x for x in raw.split(b"\n") if x.strip()]
    p = share[share > 0]
    pairs = list(zip(words, words[1:], strict=False))
    lengths = np.fromiter(map(len, words), np.int64, n)
    ended = sum(x.rstrip()[-1:] in (b".", b"!", b"?", b'"', b":") for x in lines)
    return [
        float(np.log1p(size)), float(np.log1p(n)), float(np.log1p(len(lines))), float(lengths.mean()), among(range(65, 91)), among(range(48, 58)), among(b" \t\r\n"), among(b".,;:!?'\"-"), among(b"#*$%&|<>=_~^"), among(range(128, 256)),
        share[33] * 1.0, share[124] * 1.0, share[46] * 1.0, share[44] * 1.0, len(_RUNS.findall(raw)) / n,
        len(seen) / n, max(seen.values()) / n, sum(a == b for a, b in pairs) / n, float((lengths > 15).mean()), float((lengths == 1).mean()), n / max(1, len(lines)), 1 - len(set(lines)) / max(1, len(lines)), ended / max(1, len(lines)),
        float(-(p * np.log2(p)).sum()), len(zlib.compress(raw, 1)) / size, 1 - len(set(pairs)) / max(1, len(pairs)), among(b"'\"`"), among(b"()[]{}"), (raw.count(b"http") + raw.count(b"@")) / n, sum(65 <= w[0] <= 90 for w in words) / n,
    ]


class Forest:
    """Gradient-boosted trees in flat arrays.

    ``feature``, ``threshold``: (trees, 2**depth - 1) in heap order; a row goes
    right where its value is greater.  ``leaf``: (trees, 2**depth).
    """

    def __init__(self, base: float, feature: np.ndarray, threshold: np.ndarray, leaf: np.ndarray):
        self.base, self.feature, self.threshold, self.leaf = base, feature, threshold, leaf

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row."""
        x = np.asarray(x, np.float64)
        rows = np.arange(len(x))[:, None]
        trees = np.arange(len(self.leaf))[None, :]
        node = np.zeros((len(x), len(self.leaf)), np.int64)
        for _ in range(int(np.log2(self.leaf.shape[1])) if len(self.leaf) else 0):
            right = x[rows, self.feature[trees, node]] > self.threshold[trees, node]
            node = 2 * node + 1 + right
        total = np.full(len(x), self.base) + (self.leaf[trees, node - (self.leaf.shape[1] - 1)].sum(1) if len(self.leaf) else 0)
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS, leaf: int = LEAF, ridge: float = RIDGE) -> Forest:
    """A forest for labels ``y`` (0 or 1) by logistic loss.  Without rows, or of one label, it scores the prior."""
    x, y = np.asarray(x, np.float64), np.asarray(y, np.float64)
    prior = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(prior / (1 - prior)))
    inner, leaves = 2**depth - 1, 2**depth
    if len(y) < 2 * leaf or y.min() == y.max():
        return Forest(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    code = np.stack([np.searchsorted(edges[j], x[:, j], "left") for j in range(m)], 1)  # bin b: values <= edges[b]
    flat = code + np.arange(m) * bins
    out_f, out_t, out_l = [], [], []
    margin = np.full(n, base)
    for _ in range(trees):
        prob = 1 / (1 + np.exp(-margin))
        grad, hess = prob - y, prob * (1 - prob)
        node = np.zeros(n, np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            at = ((node - first)[:, None] * (m * bins) + flat).ravel()
            size = width * m * bins
            g, h, c = (np.bincount(at, np.repeat(v, m), size).reshape(width, m, bins).cumsum(2) for v in (grad, hess, np.ones(n)))
            tg, th, tc = g[:, :, -1:], h[:, :, -1:], c[:, :, -1:]
            gain = g**2 / (h + ridge) + (tg - g) ** 2 / (th - h + ridge) - tg**2 / (th + ridge)
            gain[(c < leaf) | (tc - c < leaf)] = -np.inf
            gain[:, :, -1] = -np.inf
            best = gain.reshape(width, -1).argmax(1)
            f, b = best // bins, best % bins
            good = gain.reshape(width, -1)[np.arange(width), best] > 1e-9
            for k in np.flatnonzero(good):
                feature[first + k], threshold[first + k] = f[k], edges[f[k]][b[k]]
            own = node - first
            right = good[own] & (code[np.arange(n), f[own]] > b[own])
            node = 2 * node + 1 + right
        own = node - inner
        values = -rate * np.bincount(own, grad, leaves) / (np.bincount(own, hess, leaves) + ridge)
        margin += values[own]
        out_f.append(feature)
        out_t.append(threshold)
        out_l.append(values)
    return Forest(base, np.array(out_f), np.array(out_t), np.array(out_l))


def learn(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Forest:
    """Trees fitted on at most ``rows`` labelled documents that are not held out.

    Of several labels of one document the smallest counts; rows with a null id
    or label are left out, and so are labels without a document.
    """
    usable = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where("doc_id is not null and quality in (0, 1)").where(crc_mod(F.col("doc_id"), 5) != 0)
    chosen = usable.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # bounded by rows

    def make():
        def step(batch):
            found = [np.asarray(statistics(x), "<f8").tobytes() for x in column(batch, "text")]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "quality": pa.array(column(batch, "quality"), pa.int32()), "x": pa.array(found, pa.binary())})

        return step

    got = per_text(texts.select(F.col("doc_id").cast("long"), "text", "quality"), make, "doc_id long, quality int, x binary").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min("x").alias("x")).collect()
    got.sort(key=lambda r: r.doc_id)
    x = np.array([np.frombuffer(r.x, "<f8") for r in got]).reshape(len(got), len(FEATURES))
    return fit(x, np.array([r.quality for r in got]))


OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])


def scores(texts: list[str | None], forest: Forest) -> np.ndarray:
    return forest.score(np.array([statistics(x) for x in texts]).reshape(len(texts), len(FEATURES)))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, rows: int = FIT_ROWS) -> DataFrame:
    """held_out, score and prediction of every document; one row per input row.

    A null or empty text is scored from all-zero statistics.  A null doc_id
    stays null and is not held out; repeated rows are scored each; with no
    usable label every score is the prior; an empty table gives no rows.
    Other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, rows))

    def make():
        forest = sent.value

        def step(batch):
            found = scores(column(batch, "text"), forest)
            yield batch_of(OUT, batch.column(0), batch.column(2), found, (found >= threshold).astype(np.int32))

        return step

    return per_text(docs.select(F.col("doc_id").cast("long"), "text", F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out")), make, "doc_id long, held_out boolean, score double, predicted int")


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that the classifier does not reject, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(learn(docs, labels))

    def run(batches):
        for part in slices(batches):
            yield part.filter(pa.array(scores(column(part, "text"), sent.value) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
