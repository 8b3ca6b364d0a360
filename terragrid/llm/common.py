"""Shared helpers of the text operators: table access, shared storage, word and batch iteration."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ensure_shipped

#: Text bytes a Python worker handles at once; a longer text forms a slice of its own.
SLICE_BYTES = 4 << 20
#: Rows in one slice at most.
SLICE_ROWS = 4096
#: A group with more than one in so many of all rows is joined by broadcast: there are at most so many.
SPREAD = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read by Spark so that any file system works."""
    return ensure_shipped(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    ``spark.checkpoint.dir`` names it on a cluster.  Only where it is unset
    (tests, local mode) is a folder chosen here, one for each application.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at and not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return at.rstrip("/") if at else f"/tmp/checkpoints/{spark.sparkContext.applicationId}"


#: Folders written in the innermost open ``scratch``.
_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)
#: Spark's setting by which a query's shuffle files go when it ends.
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes what is written inside, but for steps marked ``keep``, when the block ends; results read later must not need the rest."""
    token = _SCRATCH.set(paths := [])
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        for x in paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(x)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, tag: str, block: int | None = None, keep: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read back; ``block``: bytes of rows a writer holds at once; ``keep``: outlives a ``scratch``.

    The lineage ends here: a lost executor costs a reread, not a recomputation.
    So the shuffle files of the step go when it is written.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    if not keep and (paths := _SCRATCH.get()) is not None:
        paths.append(path)
    out = df.write
    if block:  # rows are large: by default a writer looks at its size after 100 rows only
        out = out.options(**{"parquet.block.size": block, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1})
    before = spark.conf.get(CLEANUP_KEY, None)
    spark.conf.set(CLEANUP_KEY, "true")
    try:
        out.parquet(path)
    finally:
        spark.conf.unset(CLEANUP_KEY) if before is None else spark.conf.set(CLEANUP_KEY, before)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the decimal text of ``doc_id``, modulo ``n`` (null for a null id)."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n)).cast("int")


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Record batches cut so that each holds about ``most`` bytes of text at most."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        size = pc.binary_length(batch.column(batch.schema.get_field_index(text)))
        size = pc.fill_null(size, 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i in range(n):
            if i > start and (total + size[i] > most or i - start >= SLICE_ROWS):
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(size[i])
        yield batch.slice(start, n - start)


def column(batch: pa.RecordBatch, name: str) -> list:
    """A column of a record batch as Python values."""
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def per_text(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]], schema: str, text: str = "text") -> DataFrame:
    """``mapInArrow`` over bounded slices: ``make()`` runs once per task and returns the slice function."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for part in slices(batches, text):
            yield from step(part)

    return df.mapInArrow(run, schema)


_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def runs(raw: bytes, size: int = SLICE_BYTES) -> Iterator[bytes]:
    """Parts of about ``size`` bytes of a text, cut at blanks: the words of a very long text are never all held at once."""
    at = 0
    while at < len(raw):
        found = _BLANK.search(raw, at + size) if len(raw) - at > size else None
        end = found.start() if found else len(raw)
        yield raw[at:end]
        at = end


def lower_words(text: str | None) -> list[bytes]:
    r"""Words ``[^\x20\x09-\x0D]+`` of a text with A-Z lower-cased, as UTF-8."""
    return text.encode().lower().split() if text else []


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """A record batch of the given columns."""
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def few(df: DataFrame, most: int = 1 << 18) -> DataFrame:
    """``df``, marked for broadcast if it has ``most`` rows at most; counted first, so give it rows of bounded width that are read cheaply."""
    return F.broadcast(df) if rows_below(df, most) else df


def joined(rows: DataFrame, side: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """``rows`` left-joined with ``side``, whose rows each match ``size`` of ``rows``.

    Those that match more than one row in SPREAD are at most SPREAD and are
    broadcast, so no task gets the rows of a large group; the others are joined
    by a shuffle.
    """
    large = F.broadcast(side.where(F.col(size) * SPREAD > total))
    hot = rows.join(large, keys)
    cold = rows.join(large.select(*keys), keys, "left_anti").join(side.where(F.col(size) * SPREAD <= total), keys, "left")
    return hot.unionByName(cold)


def rows_below(df: DataFrame, most: int) -> bool:
    """Whether ``df`` has at most ``most`` rows; reads no more than that and one."""
    return df.limit(most + 1).count() <= most
