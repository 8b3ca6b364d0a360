r"""Line-first cleaning: rules judge each line, and a document that loses too much of its text goes.

Words are ``[^\x20\x09-\x0D]+``.  A line is a part between newlines that has a
word; these rules fail it:

- navigation: a quarter or more of its words are bare separators;
- punctuation: half or more of its words carry a run of two or more marks;
- boilerplate: it has a known phrase of web pages and licences;
- repetition: three words or fewer make up eight tenths or more of ten words or more.

A document is rejected if the base rules fail it, or if the lines that stay
hold less than half of its words.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch_of, column, per_text, slices, table

#: Least words of a document; percentage of repeated words above which it fails; least percentage of words in kept lines.
MIN_WORDS, MAX_REPEAT, MIN_KEPT = 10, 20, 50
#: Bare separators between links or cells.
SEPARATORS = ("|", "||", "»", "«", ">", ">>", "<", "<<", "•", "·", "/", "//", "::", "-", "*")
#: Phrases of web pages and licences that no prose line has (lower case).
BOILERPLATE = (
    "all rights reserved", "cookie policy", "privacy policy", "terms of use", "terms of service", "enable javascript", "click here",
    "sign up for our newsletter", "skip to content", "log in to", "powered by", "lorem ipsum", "licensed under the", "permission is hereby granted",
)
_SEPARATORS = frozenset(x.encode() for x in SEPARATORS)
_PHRASE = re.compile("|".join(map(re.escape, BOILERPLATE)).encode())
_MARKS = re.compile(rb"[!?#*$%&|<>=_~^]{2,}")
_SYMBOLS = b"#*$%&|<>"


def line_fails(words: list[bytes], line: bytes) -> bool:
    """Whether a rule fails a line (lower-cased UTF-8, with its words)."""
    n = len(words)
    if 4 * sum(map(_SEPARATORS.__contains__, words)) >= n:
        return True
    if 2 * len(_MARKS.findall(line)) >= n and 2 * sum(1 for w in words if _MARKS.search(w)) >= n:
        return True
    if n >= 10 and len(set(words)) * 4 <= 3 * n and 10 * sum(c for _, c in Counter(words).most_common(3)) >= 8 * n:
        return True
    return bool(_PHRASE.search(line))


def repeated_words(words: list[bytes], width: int = 5) -> int:
    """Words that lie in windows of ``width`` words found twice or more in the text, first ones included."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(width):
        key = (key ^ h[i : i + n]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(i + 1)
        key ^= key >> np.uint64(29)
    order = np.sort(key)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(key, twice))  # few: compared word by word
    seen = Counter(tuple(words[i : i + width]) for i in at)
    hit = np.zeros(len(words) + 1, np.int64)
    for i in at:
        if seen[tuple(words[i : i + width])] > 1:
            hit[i] += 1
            hit[min(i + width, len(words))] -= 1
    return int((np.cumsum(hit[:-1]) > 0).sum())


def measure(text: str | None) -> tuple[int, int, int, int, int, bool, bool, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, kept_words) of a whole text."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    chars = len(text or "") - sum(raw.count(bytes([c])) for c in b" \t\n\x0b\x0c\r")
    symbols = sum(raw.count(bytes([c])) for c in _SYMBOLS)
    seen, dup, lost = set(), 0, 0
    for line in raw.split(b"\n"):
        own = line.split()
        if not own:
            continue
        if line in seen:
            dup += 1
        seen.add(line)
        low = line.lower()
        if line_fails(low.split(), low):
            lost += len(own)
    repeat = repeated_words(words)
    failed = n < MIN_WORDS or 100 * repeat > MAX_REPEAT * n
    kept = not failed and 100 * (n - lost) >= MIN_KEPT * n
    return n, chars, symbols, dup, repeat, failed, kept, n - lost


def clean(text: str | None) -> str:
    """A text without the lines that a rule fails; blank lines stay."""
    lines = ((x, x.encode().lower()) for x in (text or "").split("\n"))
    return "\n".join(x for x, low in lines if not low.split() or not line_fails(low.split(), low))


OUT = pa.schema([("doc_id", pa.int64()), *((x, pa.int64()) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("kept_words", pa.int64())])


def quality_rules(docs: DataFrame) -> DataFrame:
    """The counts and the verdict of every document, one row per input row.

    A null or empty text has no words and fails (fewer than MIN_WORDS).  A null
    doc_id stays null; repeated rows are judged each; an empty table gives no
    rows; other columns are ignored.
    """

    def make():
        def step(batch):
            found = [measure(x) for x in column(batch, "text")]
            yield batch_of(OUT, batch.column(0), *zip(*found, strict=True))

        return step

    return per_text(docs.select(F.col("doc_id").cast("long"), "text"), make, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, kept_words long")


def kept_documents(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """The rows whose documents are kept, without their failed lines, with all their columns.

    A text that loses lines has its new length in the column ``length``, where
    there is one; every other value stays as it is.  Nulls, empty texts and
    repeated rows are judged as in quality_rules().
    """
    fields = docs.columns

    def run(batches):
        for batch in slices(batches, text):
            texts = column(batch, text)
            judged = [measure(x) for x in texts]
            kept = [i for i, m in enumerate(judged) if m[6]]
            cut = {i: clean(texts[i]) for i in kept if judged[i][7] < judged[i][0]}
            part = batch.take(pa.array(kept, pa.int64()))
            if cut:
                columns = dict(zip(fields, part.columns, strict=True))
                columns[text] = pa.array([cut.get(i, texts[i]) for i in kept], part.column(fields.index(text)).type)
                if length in fields:
                    own = part.column(fields.index(length))
                    columns[length] = pa.array([len(cut[i]) if i in cut else x for i, x in zip(kept, own.to_pylist(), strict=True)], own.type)
                part = pa.RecordBatch.from_arrays(list(columns.values()), schema=part.schema)
            yield part

    return docs.mapInArrow(run, docs.schema)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


_LIST = ", ".join(f"'{x}'" for x in SEPARATORS)
_W = r"list_filter(regexp_split_to_array(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_MARK = r"[!?#*$%&|<>=_~^]{2,}"
ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM d),
win AS (SELECT doc_id, i, w[i : i + 4] AS win FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS i FROM w)),
twice AS (SELECT doc_id, unnest(list(i)) AS i FROM win GROUP BY doc_id, win HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(generate_series(0, 4)) AS k) GROUP BY doc_id),
lines AS (SELECT doc_id, line, {_W.format('line')} AS lw FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)),
lined AS (SELECT doc_id, line, lw, len(lw) AS n,
    (SELECT coalesce(sum(c), 0) FROM (SELECT count(*) AS c FROM (SELECT unnest(lw) AS x) GROUP BY x ORDER BY c DESC LIMIT 3)) AS top
  FROM lines WHERE len(lw) > 0),
ruled AS (SELECT doc_id, line, n,
    4 * len(list_filter(lw, lambda x: x IN ({_LIST}))) >= n
    OR (2 * len(list_filter(lw, lambda x: regexp_matches(x, '{_MARK}'))) >= n AND 2 * len(regexp_extract_all(line, '{_MARK}')) >= n)
    OR (n >= 10 AND len(list_distinct(lw)) * 4 <= 3 * n AND 10 * top >= 8 * n)
    OR regexp_matches(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{'|'.join(BOILERPLATE)}') AS fails
  FROM lined),
l AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup, sum(CASE WHEN fails THEN n ELSE 0 END) AS lost FROM ruled GROUP BY doc_id),
b AS (SELECT w.doc_id, len(w) AS n_words, length(list_aggregate(w, 'string_agg', '')) AS word_chars,
    length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
    len(w) - coalesce(lost, 0) AS kept_words
  FROM w LEFT JOIN l ON l.doc_id = w.doc_id LEFT JOIN rep ON rep.doc_id = w.doc_id)
SELECT doc_id, n_words::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT} * n_words) AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT} * n_words) AND 100 * kept_words >= {MIN_KEPT} * n_words AS kept,
  kept_words::BIGINT AS kept_words
FROM b"""
