"""What the training-data operators share: scratch tables, word rules, small fits."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of the contracts, as a Java pattern; ``bytes.split()`` cuts at the same six characters.
WORD = r"[^\x20\x09-\x0D]+"
#: The six characters between words.
SPACES = " \t\n\x0b\x0c\r"

MASK = (1 << 64) - 1


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only in a session of one machine that has none (tests) is a temporary one set.
    """
    place = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not place:
        place = spark.sparkContext.getCheckpointDir()
    if not place:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        place = "file://" + tempfile.mkdtemp(prefix="storyloom-")
        spark.sparkContext.setCheckpointDir(place)
    return place.rstrip("/")


#: How tables of very large rows are written.
HEAVY = {"parquet.block.size": str(16 << 20)} | {f"parquet.{kind}.size.row.check.{end}": "1" for kind in ("block", "page") for end in ("min", "max")}


class Scratch:
    """Tables written to the shared folder, to cut lineage and to survive lost executors.

    What a result no longer reads is dropped as soon as it is made, the rest when the session's JVM ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        path, store = self._store("")
        store.mkdirs(path)
        store.deleteOnExit(path)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str, heavy: bool = False) -> DataFrame:
        """``df``, written as Parquet and read again.

        ``heavy`` rows have megabytes each: sizes are looked at row by row (Parquet's writer does so after a hundred
        rows), so that a writer holds, and a reader gets at once, row groups of some 16 MB and not those of a whole task.
        """
        df.write.mode("overwrite").option("compression", "zstd").options(**HEAVY if heavy else {}).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            path, store = self._store(name)
            store.delete(path, True)

    def _store(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(name) if name else self.root)
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())


def unused(name: str, taken: list[str]) -> str:
    """``name``, made longer until no column has it; names differ by more than case."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def id_crc(doc_id: Column) -> Column:
    """crc32 of the id as text, unsigned."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def labelled_sample(labels: DataFrame, label: str, max_rows: int, where: Column | None = None) -> DataFrame:
    """At most ``max_rows`` labelled ids, the same ones at each run: the least by hash.

    Rows without id or label are passed over; an id with several labels gets the largest.
    """
    rows = labels.select("doc_id", F.col(label).cast("int").alias("label")).where("doc_id is not null and label is not null")
    if where is not None:
        rows = rows.where(where)
    rows = rows.groupBy("doc_id").agg(F.max("label").alias("label"))
    return rows.orderBy(F.xxhash64("doc_id", F.lit(17)), "doc_id").limit(max_rows)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of unsigned 64-bit integers, element by element."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def logistic(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35.0, 35.0)))


def newton_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 60) -> np.ndarray:
    """Weights of a small logistic regression; the first column of ``x`` is the constant.

    Columns are scaled, labels smoothed as for calibration (a label that n rows
    have is n + 1 in n + 2 sure) and each step is halved until the loss falls, so
    rows that can be told apart without error have a finite answer, too.
    """
    scale = np.where(x.std(axis=0) > 0, x.std(axis=0), 1.0)
    x = x / scale
    good, bad = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    damp = np.full(x.shape[1], ridge)
    damp[0] = 1e-6

    def loss(w):
        z = x @ w
        return float(np.logaddexp(0, z).sum() - target @ z + 0.5 * (damp * w * w).sum())

    w = np.zeros(x.shape[1])
    now = loss(w)
    for _ in range(steps):
        p = logistic(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(damp + 1e-9), x.T @ (target - p) - damp * w)
        share = 1.0
        while share > 1e-6 and loss(w + share * step) > now:
            share /= 2
        if share <= 1e-6:
            break
        w = w + share * step
        before, now = now, loss(w)
        if before - now < 1e-10 * (1 + abs(now)):
            break
    return w / scale


#: What a worker process keeps from task to task: of one kind at a time, so that its memory is that of one operator.
_kept: dict = {}


def kept(kind: tuple, make: Callable):
    """``make()``, or what it made in an earlier task of this worker if no other kind came between."""
    if kind not in _kept:
        _kept.clear()
        _kept[kind] = make()
    return _kept[kind]


def give_back() -> None:
    """Returns to the system what Arrow and the C library hold in reserve."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 500, keeps: bool = False) -> Iterator[pa.RecordBatch]:
    """The batches in slices of few rows; at the end of the task its memory goes back to the system.

    Unless the task ``keeps`` what its worker has from earlier tasks, that goes first.
    """
    if not keeps:
        _kept.clear()
    try:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield batch.slice(at, rows)
    finally:
        give_back()


class Memo(dict):
    """A bounded cache of ``make(key)`` for short keys; when full, the older half of what is in use goes."""

    #: Longer keys aren't kept: their number would bound nothing.
    LONGEST = 100

    def __init__(self, make: Callable, size: int = 300_000):
        super().__init__()
        self.make, self.half, self.old = make, size // 2, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) > self.LONGEST:
            return value
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value
