"""Helpers shared by the operators: tables, stored steps, batches of texts, words."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

_shipped: set[str] = set()

#: Entries of a per-task word cache, and as many older ones.
CACHE_WORDS = 250_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once a session, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="lapsewise-")) / f"lapsewise-code-{uuid.uuid4().hex}.zip"
    with zipfile.ZipFile(archive, "w") as file:
        for source in sorted(package.rglob("*.py")):
            file.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a folder of our own only where none is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lapsewise-llm-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written as Parquet to the shared folder and read again: no lineage behind it, and a
    lost executor costs no recomputation. Jobs may empty ``<shared folder>/llm`` when done."""
    path = f"{shared_folder(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_tasks(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def id_and_text(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, and when a task is done what Arrow holds free goes back to the system: the Python worker
    outlives the task, and what it keeps is missing to the tasks of other steps beside it."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return task


def map_texts(docs: DataFrame, make: Callable[[], Callable[[list[str]], dict[str, object]]], schema: str) -> DataFrame:
    """One result row for each (doc_id, text): ``make`` runs once per task and returns the function
    that turns a list of texts (null: empty) into columns. Narrow; a batch is at most 64 MB."""
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = make()
        for batch in batches:
            for ids, texts in blocks(batch):
                columns = score(texts)
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(columns[f.name], f.type) for f in list(out)[1:])], schema=out)

    return id_and_text(docs).mapInArrow(released(run), schema)


def with_found(docs: DataFrame, make: Callable[[], Callable[[list[str]], dict[str, object]]], schema: str) -> DataFrame:
    """(doc, found): every row of ``docs`` as a struct beside the struct of what was found in its text."""
    rows = docs.select(all_columns(docs).alias("doc"), F.col("text").cast("string").alias("text"))
    result = T.StructType([rows.schema["doc"], T.StructField("found", T.StructType.fromDDL(schema))])
    fields = list(arrow_schema(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = make()
        for batch in batches:
            for doc, texts in blocks(batch):
                columns = score(texts)
                found = pa.StructArray.from_arrays([pa.array(columns[f.name], f.type) for f in fields], fields=fields)
                yield pa.RecordBatch.from_arrays([doc, found], names=["doc", "found"])

    return rows.mapInArrow(released(run), result)


def all_columns(docs: DataFrame):
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def unpacked(docs: DataFrame):
    """The columns of ``docs`` out of the struct ``doc``."""
    return [F.col("doc").getField(c).alias(c) for c in docs.columns]


def blocks(batch: pa.RecordBatch, rows: int = 1000) -> Iterator[tuple[pa.Array, list[str]]]:
    """Slices of a batch of (doc_id, text) as ids and Python strings."""
    for start in range(0, batch.num_rows, rows):
        part = batch.slice(start, rows)
        yield part.column(0), [t or "" for t in part.column(1).to_pylist()]


def arrow_schema(schema: str | T.StructType) -> pa.Schema:
    return to_arrow_schema(T.StructType.fromDDL(schema) if isinstance(schema, str) else schema)


def words(text: str, lower: bool = False) -> list[bytes]:
    r"""The words ``[^\x20\x09-\x0D]+`` of a text as UTF-8; ``lower`` turns A-Z to a-z only."""
    raw = text.encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


class Cache(dict):
    """A bounded memory of ``compute(key)``. When it is full it becomes the older one, from which
    what is still in use comes back, so that common keys stay and a long task stays small."""

    def __init__(self, compute: Callable, limit: int = CACHE_WORDS):
        super().__init__()
        self.compute, self.limit, self.older = compute, limit, {}

    def __missing__(self, key):
        value = self.older.pop(key, None)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def bucket_of(column: str, buckets: int):
    """crc32 of the decimal text of an id, modulo ``buckets``: the folds of the contracts."""
    return F.crc32(F.col(column).cast("string")) % buckets


def plane_pack(values: np.ndarray, width: int) -> bytes:
    """Unsigned integers as byte planes (all first bytes, all second bytes, ...), which compress
    well when the values are sorted."""
    raw = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width]
    return np.ascontiguousarray(raw.T[::-1]).tobytes()


def plane_unpack(raw: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(width, -1)[::-1]
    full = np.zeros((planes.shape[1], 8), np.uint8)
    full[:, :width] = planes.T
    return full.reshape(-1).view("<u8").astype(np.uint64)
