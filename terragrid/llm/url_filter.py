"""URL filters: rules first, then naive Bayes over segmented host and path tokens.

Hosts run words together ("freebets").  A unigram Viterbi search splits each
run of letters into its most probable words; the words of host and path are
then scored by multinomial naive Bayes, with the prior of its classes.  There
are no labels by hand: a page that a rule decides has the rule's class, and of
the rest one with a listed spam word among its words is blocked, the others
allowed.  What is learned goes beyond that list: words that keep company with
blocked pages weigh against a page that has no listed word.

The word model comes from separated words: those of all paths, and the parts of
host labels between dots and hyphens, once a host.  A part that occurs in hosts
alone and that known words make up is a joined name, not a word.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ensure_shipped
from .common import batch_of, column, per_text, table

#: (verdict, host, path) of the rules.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Words that mark spam for training, and everyday words that give the word model a base.
SPAM = ("casino", "pills", "pill", "bets", "bet", "spam", "porn", "poker", "viagra", "loans", "ads", "track", "tracker", "cheap", "free", "xxx", "adult", "lottery", "farm", "clicks")
PLAIN = ("the", "and", "of", "in", "on", "to", "for", "news", "blog", "shop", "www", "mail", "page", "home", "web", "site", "my", "best", "online", "world", "data", "info", "forum", "wiki", "photo", "music", "book", "game", "travel", "food", "health", "school", "city", "art", "tech")
#: Most frequent words in the dictionary (a size bound of the broadcast model; rarer ones are cut as unknown), its longest word, shortest word that a joined name is made of, buckets of hashed word features.
DICTIONARY, LONGEST, PART, FEATURES = 200_000, 32, 3, 1 << 16
#: Prior counts of listed words, and the smoothing of naive Bayes.
LISTED, SMOOTH = 50, 1.0
#: Labels that are part of the public suffix before a country's.
GENERAL = frozenset(("ac", "co", "com", "edu", "gob", "gov", "gouv", "go", "mil", "ne", "net", "nom", "or", "org"))
_RUN = re.compile(r"[^\W\d_]+")


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host (after the first ``://`` up to ``/ ? #``, A-Z lower-cased) and path (then up to ``? #``)."""
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host = rest[:end].encode().lower().decode()
    return host, re.split(r"[?#]", rest[end:], maxsplit=1)[0]


def rule_of(host: str, path: str) -> tuple[str | None, str | None]:
    """(rule, verdict) of the longest rule that fits; (None, None) without one.  Of equal lengths a block comes first."""
    best = None
    for verdict, own, start in RULES:
        if (host == own or host.endswith("." + own)) and path.startswith(start):
            key = (len(own + start), verdict == "block", own + start, verdict)
            best = max(best, key) if best else key
    return (best[2], best[3]) if best else (None, None)


class WordModel:
    """Unigram word probabilities, and Viterbi segmentation by them."""

    def __init__(self, counts: dict[str, int]):
        total = sum(counts.values()) + 1
        self.cost = {w: math.log(total / c) for w, c in counts.items()}
        self.unknown = math.log(total) + 3
        self._kept = functools.lru_cache(50_000)(self._split)

    def split(self, run: str) -> tuple[str, ...]:
        """The words of a run of letters; those of runs of ordinary length are remembered."""
        return self._kept(run) if len(run) <= 64 else self._split(run)

    def __reduce__(self):
        return _rebuilt, (self.cost, self.unknown)

    def _split(self, run: str) -> tuple[str, ...]:
        """The least-cost words of a run of letters; what no word covers is split off by unknown parts."""
        n = len(run)
        best, back = [0.0] + [math.inf] * n, [0] * (n + 1)
        for i in range(1, n + 1):
            for j in range(max(0, i - LONGEST), i):
                piece = run[j:i]
                c = best[j] + self.cost.get(piece, self.unknown + 2.5 * (i - j))
                if c < best[i]:
                    best[i], back[i] = c, j
        out, i = [], n
        while i:
            out.append(run[back[i] : i])
            i = back[i]
        return tuple(reversed(out))


def _rebuilt(cost: dict, unknown: float) -> WordModel:
    model = WordModel({})
    model.cost, model.unknown = cost, unknown
    return model


def runs(text: str) -> list[str]:
    """Runs of letters, lower-cased."""
    return _RUN.findall(text.lower())


def names(host: str) -> str:
    """The labels of a host but its public suffix: the last label, with a general one before a country's (co.uk)."""
    labels = host.split(".")
    suffix = 2 if len(labels) > 2 and len(labels[-1]) == 2 and labels[-2] in GENERAL else 1
    return ".".join(labels[:-suffix]) or host


def tokens(host: str, path: str, words: WordModel) -> list[str]:
    """Segmented words of all host labels but the public suffix, and of the path."""
    return ["h:" + w for r in runs(names(host)) for w in words.split(r)] + ["p:" + w for r in runs(path) for w in words.split(r)]


def buckets(features: list[str]) -> list[int]:
    return [xxhash.xxh32_intdigest(x) % FEATURES for x in features]


class Bayes:
    """Multinomial naive Bayes over hashed words: a table of fixed size, whatever the vocabulary."""

    def __init__(self, counts: np.ndarray, docs: np.ndarray):
        self.prior = math.log((docs[1] + 1) / (docs[0] + 1))
        p = (counts + SMOOTH) / (counts.sum(1, keepdims=True) + SMOOTH * FEATURES)
        self.weight = np.log(p[1] / p[0]).astype(np.float32)

    def margin(self, features: list[str]) -> float:
        """Log odds of block against allow."""
        return self.prior + float(self.weight[buckets(features)].sum()) if features else self.prior


def distant_label(host: str, path: str, features: list[str]) -> int:
    """1 to block, 0 to allow: a rule's verdict, else whether a listed word is there."""
    verdict = rule_of(host, path)[1]
    return int(any(x[2:] in SPAM for x in features)) if verdict is None else int(verdict == "block")


def word_counts(pages: DataFrame) -> DataFrame:
    """(word, n, own) of the letter runs of all paths, and of all distinct hosts; own: whether a path has the word."""

    def hosts():
        def step(batch):
            yield pa.RecordBatch.from_pydict({"host": pa.array(sorted({host_and_path(x)[0] for x in column(batch, "url")}), pa.string())})

        return step

    def counted(of, own):
        def make():
            def step(batch):
                seen = Counter(r for x in column(batch, batch.schema.names[0]) for r in runs(of(x)) if 2 <= len(r) <= LONGEST)
                yield pa.RecordBatch.from_pydict({"word": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64()), "own": pa.array([own] * len(seen), pa.int32())})

            return step

        return make

    schema = "word string, n long, own int"
    distinct = per_text(pages.select("url"), hosts, "host string", "url").distinct()
    found = per_text(distinct, counted(names, 0), schema, "host").unionByName(per_text(pages.select("url"), counted(lambda x: host_and_path(x)[1], 1), schema, "url"))
    return found.groupBy("word").agg(F.sum("n").alias("n"), F.max("own").alias("own"))


def word_model(pages: DataFrame, dictionary: int = DICTIONARY) -> WordModel:
    """Word probabilities from the ``dictionary`` most frequent words of all pages."""
    found = word_counts(pages).orderBy(F.desc("n"), "word").limit(dictionary).collect()
    listed = (*SPAM, *PLAIN)
    counts = {r.word: r.n for r in found if r.own}
    for w in listed:
        counts[w] = counts.get(w, 0) + LISTED
    known = WordModel(counts)
    for r in found:
        parts = () if r.own or r.word in listed else known.split(r.word)
        if not r.own and not (len(parts) > 1 and all(len(x) >= PART and x in known.cost for x in parts)):
            counts[r.word] = counts.get(r.word, 0) + r.n
    return WordModel(counts)


def learn(pages: DataFrame, dictionary: int = DICTIONARY) -> tuple[WordModel, Bayes]:
    """Both models, from all pages.  The dictionary has a bounded number of words, the feature table a fixed number of buckets."""
    context = pages.sparkSession.sparkContext
    words = word_model(pages, dictionary)
    sent = context.broadcast(words)

    def make():
        def step(batch):
            seen: dict[tuple[int, int], int] = {}
            docs = [0, 0]
            for url in column(batch, "url"):
                host, path = host_and_path(url)
                features = tokens(host, path, sent.value)
                y = distant_label(host, path, features)
                docs[y] += 1
                for b in buckets(features):
                    seen[y, b] = seen.get((y, b), 0) + 1
            rows = [(y, b, n) for (y, b), n in seen.items()] + [(y, -1, n) for y, n in enumerate(docs)]
            yield pa.RecordBatch.from_pydict({k: pa.array([r[i] for r in rows], t) for i, (k, t) in enumerate((("y", pa.int32()), ("b", pa.int32()), ("n", pa.int64())))})

        return step

    table_, docs = np.zeros((2, FEATURES)), np.zeros(2)
    for r in per_text(pages.select("url"), make, "y int, b int, n long", "url").groupBy("y", "b").agg(F.sum("n").alias("n")).collect():  # 2 x FEATURES rows at most
        if r.b < 0:
            docs[r.y] = r.n
        else:
            table_[r.y, r.b] = r.n
    return words, Bayes(table_, docs)


OUT = pa.schema([("page_id", pa.int64()), *((x, pa.string()) for x in ("host", "path", "rule", "verdict")), ("margin", pa.float64())])


def url_verdicts(pages: DataFrame, dictionary: int = DICTIONARY) -> DataFrame:
    """Host, path, rule and verdict of every page; one row per input row.

    A null url or one without ``://`` has an empty host and path, fits no rule
    and is judged by the prior alone.  A null page_id stays null; repeated rows
    are judged each; margins of exactly zero allow; an empty table gives no
    rows.  Other columns are ignored.  Very long urls are split whole.
    """
    ensure_shipped(pages.sparkSession)
    sent = pages.sparkSession.sparkContext.broadcast(learn(pages, dictionary))

    def make():
        words, bayes = sent.value

        def judged(url):
            host, path = host_and_path(url)
            margin = bayes.margin(tokens(host, path, words))
            rule, verdict = rule_of(host, path)
            return host, path, rule, verdict or ("block" if margin > 0 else "allow"), margin

        def step(batch):
            yield batch_of(OUT, batch.column(0), *zip(*map(judged, column(batch, "url")), strict=True))

        return step

    return per_text(pages.select(F.col("page_id").cast("long"), "url"), make, "page_id long, host string, path string, rule string, verdict string, margin double", "url")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages"))
