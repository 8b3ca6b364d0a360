"""Language identification by a bidirectional gated recurrent network over bytes.

A text is cut into windows of STEPS bytes.  Both directions run over every
window; each position gets a label distribution from the two states there, and
a document's probabilities are the mean over all its labelled positions.  The
network is trained in numpy by backpropagation through time.

Arrays are (direction, sequence, ...): the backward direction reads the windows
reversed, so both take the same steps at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch_of, column, crc_mod, per_text, table

#: Labelled documents used for training at most, and bytes of their texts: by the hash of their ids, whole texts that fit into what is left.
FIT_DOCS, FIT_BYTES = 3000, 2 << 20
#: Bytes of a window, state size, least training steps, windows in a step, learning rate.
STEPS, STATE, ROUNDS, BATCH, RATE = 48, 8, 200, 160, 0.03
#: Windows scored at once.
RUN = 1536
#: Code of the padding after a text's last byte.
PAD = 256
_LETTER = regex.compile(r"\p{L}")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.tanh(x * 0.5, out=x)
    x *= 0.5
    x += 0.5
    return x


class BiGru:
    """Weights: input table E (2, 257, 3H) with biases, recurrent U (2, H, 3H), output W (2H, L), b (L)."""

    def __init__(self, labels: list[str], state: int = STATE, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.labels, self.h = labels, state
        n = len(labels)
        self.p = {
            "E": rng.normal(0, 0.3, (2, 257, 3 * state)), "U": rng.normal(0, 0.3, (2, state, 3 * state)),
            "W": rng.normal(0, 0.3, (2 * state, n)), "b": np.zeros(n),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def states(self, codes: np.ndarray, keep: list | None = None) -> np.ndarray:
        """(2, T, B, H) states for codes (B, T); the second direction is in reversed order of time."""
        size, steps = codes.shape
        h_n, E, U = self.h, self.p["E"], self.p["U"]
        both = np.stack([codes, codes[:, ::-1]])
        h = np.zeros((2, size, h_n), np.float32)
        out = np.empty((2, steps, size, h_n), np.float32)
        which = np.arange(2)[:, None]
        for t in range(steps):
            x = E[which, both[:, :, t]]
            hu = h @ U
            gates = _sigmoid(x[:, :, : 2 * h_n] + hu[:, :, : 2 * h_n])
            r, z = gates[:, :, :h_n], gates[:, :, h_n:]
            new = np.tanh(x[:, :, 2 * h_n :] + r * hu[:, :, 2 * h_n :])
            if keep is not None:
                keep.append((both[:, :, t], h, gates, new, hu[:, :, 2 * h_n :].copy()))
            h = new + z * (h - new)
            out[:, t] = h
        return out

    def label_positions(self, codes: np.ndarray) -> np.ndarray:
        """(T, B, L) label probabilities of every position."""
        s = self.states(codes)
        a = s[0] @ self.p["W"][: self.h] + s[1, ::-1] @ self.p["W"][self.h :] + self.p["b"]
        a -= a.max(2, keepdims=True)
        np.exp(a, out=a)
        a /= a.sum(2, keepdims=True)
        return a

    def train_step(self, codes: np.ndarray, target: np.ndarray) -> tuple[float, dict]:
        """Mean cross-entropy over unpadded positions, and its gradients."""
        keep: list = []
        s = self.states(codes, keep)
        h_n, W, U = self.h, self.p["W"], self.p["U"]
        back = s[1, ::-1]
        a = s[0] @ W[:h_n] + back @ W[h_n:] + self.p["b"]
        a -= a.max(2, keepdims=True)
        q = np.exp(a)
        q /= q.sum(2, keepdims=True)
        real = (codes.T != PAD).astype(np.float32)[:, :, None]
        total = max(1.0, float(real.sum()))
        size = len(codes)
        loss = float(-(np.log(np.maximum(q[:, np.arange(size), target], 1e-12)) * real[:, :, 0]).sum() / total)
        d = q.copy()
        d[:, np.arange(size), target] -= 1
        d *= real / total
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        flat = d.reshape(-1, d.shape[2])
        g["b"] = flat.sum(0)
        g["W"][:h_n] = s[0].reshape(-1, h_n).T @ flat
        g["W"][h_n:] = np.ascontiguousarray(back).reshape(-1, h_n).T @ flat
        ds = np.stack([d @ W[:h_n].T, (d @ W[h_n:].T)[::-1]])
        dh = np.zeros((2, size, h_n), np.float32)
        for t in reversed(range(len(keep))):
            code, h, gates, new, hn = keep[t]
            r, z = gates[:, :, :h_n], gates[:, :, h_n:]
            dh = dh + ds[:, t]
            dn = dh * (1 - z) * (1 - new * new)
            dz = dh * (h - new) * z * (1 - z)
            dr = dn * hn * r * (1 - r)
            dx = np.concatenate([dr, dz, dn], 2)
            du = np.concatenate([dr, dz, dn * r], 2)
            g["U"] += h.transpose(0, 2, 1) @ du
            for k in range(2):
                np.add.at(g["E"][k], code[k], dx[k])
            dh = dh * z + du @ U.transpose(0, 2, 1)
        return loss, g

    def train(self, codes: np.ndarray, target: np.ndarray, rounds: int = ROUNDS, batch: int = BATCH, rate: float = RATE, seed: int = 11) -> float:
        """Adam over batches in random order, every window once before any is seen again; gives the last steps' mean loss."""
        rng = np.random.default_rng(seed)
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        rounds = max(rounds, -(-len(codes) // batch)) if len(codes) else 0
        order = np.zeros(0, np.int64)
        losses = [0.0]
        for i in range(1, rounds + 1):
            while len(order) < batch:
                order = np.concatenate([order, rng.permutation(len(codes))])
            at, order = order[:batch], order[batch:]
            loss, g = self.train_step(codes[at], target[at])
            norm = float(np.sqrt(sum((x * x).sum() for x in g.values())))
            lr = rate * min(1, i / 20) * (0.5 * (1 + np.cos(np.pi * i / (rounds + 1))))
            for k in self.p:
                x = g[k] * min(1.0, 1 / max(norm, 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * x
                v[k] = 0.99 * v[k] + 0.01 * x * x
                self.p[k] -= (lr * (m[k] / (1 - 0.9**i)) / (np.sqrt(v[k] / (1 - 0.99**i)) + 1e-8)).astype(np.float32)
            losses = [*losses[-19:], loss]
        return float(np.mean(losses))

    def documents(self, texts: list[str | None]) -> np.ndarray:
        """(n, L) pooled probabilities: the mean over all positions of each text; zero for an empty one."""
        raw = [(x or "").encode() for x in texts]
        codes, owner, lengths = windows_of(raw)
        out = np.zeros((len(raw), len(self.labels)))
        for i in range(0, len(owner), RUN):
            q = self.label_positions(codes[i : i + RUN])
            q *= (np.arange(STEPS)[:, None] < lengths[i : i + RUN])[:, :, None]
            np.add.at(out, owner[i : i + RUN], q.sum(0, dtype=np.float64))
        return out / np.maximum(1, [[len(x)] for x in raw])


def windows_of(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of whole texts: codes (windows, STEPS), the text each is of, and the bytes in it."""
    windows = np.array([-(-len(x) // STEPS) for x in raw], np.int64)
    owner = np.repeat(np.arange(len(raw)), windows)
    codes = np.full((int(windows.sum()), STEPS), PAD, np.int16)
    lengths = np.full(len(owner), STEPS, np.int64)
    at = 0
    for x, n in zip(raw, windows, strict=True):
        if n:
            codes[at : at + n].reshape(-1)[: len(x)] = np.frombuffer(x, np.uint8)
            lengths[at + n - 1] = len(x) - (n - 1) * STEPS
            at += n
    return codes, owner, lengths


def fitting(sizes: list[int], most: int) -> list[int]:
    """Which of ``sizes``, in order, are taken: those that fit into what is left of ``most``."""
    out = []
    for i, n in enumerate(sizes):
        if n <= most:
            out.append(i)
            most -= n
    return out


def learn(docs: DataFrame, docs_bound: int = FIT_DOCS, rounds: int = ROUNDS, most: int = FIT_BYTES) -> BiGru:
    """A network trained on whole texts of labelled documents that are not held out: ``docs_bound`` and ``most`` bytes at most.

    Rows of one id with equal texts and labels count once; what reaches the
    driver is bounded by the two limits, however often an id occurs.
    """
    usable = docs.where("doc_id is not null and lang is not null and text is not null").where(crc_mod(F.col("doc_id"), 4) != 2)
    usable = usable.select(F.col("doc_id").cast("long"), "lang", "text", F.xxhash64("text").alias("hash"), F.octet_length("text").alias("size"))
    first = usable.select("doc_id", "lang", "hash", "size").distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "lang", "hash", "size").limit(docs_bound).collect()
    chosen = [first[i] for i in fitting([r["size"] for r in first], most)]
    keys = F.broadcast(docs.sparkSession.createDataFrame([(r.doc_id, r.lang, r.hash) for r in chosen], "doc_id long, lang string, hash long"))  # bounded by docs_bound
    got = sorted((r.doc_id, r.lang, r.text) for r in usable.select("doc_id", "lang", "hash", "text").join(keys, ["doc_id", "lang", "hash"], "left_semi").dropDuplicates(["doc_id", "lang", "hash"]).collect())
    labels = sorted({lang for _, lang, _ in got})
    net = BiGru(labels)
    codes, owner, _ = windows_of([text.encode() for *_, text in got])
    net.train(codes, np.array([labels.index(lang) for _, lang, _ in got], np.int64)[owner], rounds)
    return net


OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])


def predicted(texts: list[str | None], net: BiGru) -> tuple[list[str], list[float]]:
    """Language and pooled probability of each text; ``und`` and 0 without a letter, or if nothing was learned."""
    q = net.documents(texts)
    known = [bool(net.labels) and bool(x) and _LETTER.search(x) is not None for x in texts]
    best = q.argmax(1) if net.labels else np.zeros(len(texts), int)
    return [net.labels[b] if k else "und" for b, k in zip(best, known, strict=True)], [min(1.0, float(q[i, b])) if k else 0.0 for i, (b, k) in enumerate(zip(best, known, strict=True))]


def language_id(docs: DataFrame, docs_bound: int = FIT_DOCS, rounds: int = ROUNDS) -> DataFrame:
    """The language of every whole text; one row per input row.

    Null texts and those without a letter are ``und`` with score 0, and so is
    all if no row has a usable label.  A null doc_id stays null and is not held
    out; repeated rows are labelled each; of equal probabilities the label
    first in order wins; an empty table gives no rows.  Columns other than
    doc_id, text and lang are ignored, and lang is read for training only.
    """
    sent = docs.sparkSession.sparkContext.broadcast(learn(docs, docs_bound, rounds))

    def make():
        net = sent.value

        def step(batch):
            lang, score = predicted(column(batch, "text"), net)
            yield batch_of(OUT, batch.column(0), batch.column(2), lang, score)

        return step

    return per_text(docs.select(F.col("doc_id").cast("long"), "text", F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out")), make, "doc_id long, held_out boolean, lang_pred string, score double")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))
