"""Files that executors write in parts, and batches whose steps are done once, in folders that all share."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.tables import shared


def exists(spark: SparkSession, path: str) -> bool:
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(there)


def join_files(spark: SparkSession, path: str, pieces: list[tuple[str, str | None, int]], tail: str = "") -> None:
    """One file at ``path``: of each piece a head and the parts of a folder, the first without so many bytes.

    Bytes go from stream to stream, whatever their number, and the file is there when it is whole.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path
    target, new = place(path), place(f"{path}.new")
    there = target.getFileSystem(conf)
    there.setWriteChecksum(False)
    out = there.create(new, True)
    for head, folder, skip in pieces:
        out.write(bytearray(head.encode()))
        if folder is None:
            continue
        files = place(folder).getFileSystem(conf)
        for name in sorted(s.getPath().toString() for s in files.listStatus(place(folder)) if s.getPath().getName().startswith("part-") and s.getLen()):
            part = files.open(place(name))
            part.seek(skip)
            skip = 0
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 1 << 16, False)
            part.close()
    out.write(bytearray(tail.encode()))
    out.close()
    there.setWriteChecksum(True)
    there.delete(target, False)
    there.rename(new, target)


def text_parts(lines: DataFrame, folder: str | None = None) -> str:
    """A folder of the one column's lines, in their order, written by the executors."""
    folder = folder or f"{shared(lines).getCheckpointDir().rstrip('/')}/{uuid.uuid4().hex}.txt"
    lines.write.mode("overwrite").text(folder)
    return folder


def json_lines(rows: DataFrame) -> DataFrame:
    """Rows as lines of a JSON list, each with a comma before it."""
    return rows.select(F.concat(F.lit(",\n    "), F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).alias("value"))


@dataclass(frozen=True)
class Ledger:
    """What has been done, a file of JSON lines for each step; a step that has its file isn't done again.

    A file comes to its name whole, so a step whose task dies is either done or not.  ``folder`` is one that driver and
    executors share, on any file system that Arrow opens.
    """

    folder: str

    def once(self, name: str, make: Callable[[], list[dict]]) -> list[dict]:
        """The lines of a step: those that are there, else what ``make`` gives, which then stays."""
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", self.folder if ":" in self.folder else f"file://{self.folder}"))
        path = f"{root.rstrip('/')}/{name}.json"
        if files.get_file_info(path).type == fs.FileType.NotFound:
            rows = make()
            parent, _, last = path.rpartition("/")
            files.create_dir(parent, recursive=True)
            new = f"{parent}/.{last}.{uuid.uuid4().hex}"  # Spark doesn't read such names
            with files.open_output_stream(new) as out:
                out.write("".join(json.dumps(r) + "\n" for r in rows).encode())
            files.move(new, path)
        with files.open_input_stream(path) as body:
            return [json.loads(line) for line in body.read().decode().splitlines()]

    def rows(self, spark: SparkSession, name: str, schema: str) -> DataFrame:
        """All lines of a folder of steps."""
        path = f"{self.folder}/{name}"
        return spark.read.schema(schema).json(path) if exists(spark, path) else spark.createDataFrame([], schema)

    def table(self, spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A Parquet table that is made once; one that a dead driver left unfinished is made anew."""
        path = f"{self.folder}/{name}"
        if not exists(spark, f"{path}/_SUCCESS"):
            make().write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)
