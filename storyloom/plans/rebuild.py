"""All indexes of a corpus, step by step in one session."""

from __future__ import annotations

import time
import traceback
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.functions import text as T
from storyloom.operators import maps, profile
from storyloom.plans import report
from storyloom.plans.parts import exists
from storyloom.sources import html, metadata, stories, tables
from storyloom.tables import written


@dataclass
class Step:
    name: str
    run: Callable[[], object]
    ok: bool | None = None
    seconds: float = 0.0
    error: str = ""


def run(steps: list[Step]) -> int:
    """All steps in order, the next even if one fails; 1 if any did."""
    for s in steps:
        began = time.time()
        try:
            s.run()
            s.ok = True
        except Exception:
            s.ok, s.error = False, traceback.format_exc(limit=3)
        s.seconds = time.time() - began
    return int(not all(s.ok for s in steps))


def from_pages(spark: SparkSession, root: str, pattern: str = "*.html") -> DataFrame:
    """Flat stories of table exports."""
    rows = html.fields_exact(html.issue_rows(html.scan(spark, root, pattern)))
    names = {"story_id": "issue_key", "type": "issue_type"}
    columns = ["story_id", "sprint", "sprint_no", "summary", "status", "priority", "assignee", "components", "epic", "labels", "type", "story_points", "description", "acceptance_criteria", "solution"]
    return rows.where(F.coalesce("issue_key", F.lit("")) != "").select(*(F.coalesce(names.get(c, c), F.lit("")).alias(c) if c != "sprint_no" else F.col(c) for c in columns), *PLACE)


#: Where a row was read, which says what of several rows of one story is the last.
PLACE = ["file_path", "row_no"]


def from_markdown(spark: SparkSession, root: str) -> DataFrame:
    return stories.flat(stories.parse(stories.scan(spark, root)))


def last_standing(flat: DataFrame) -> DataFrame:
    """One row for each story of a sprint, the last of those that were read."""
    fields = [c for c in flat.columns if c not in ("sprint", "story_id", *PLACE)]
    order = F.struct(*(c for c in PLACE if c in flat.columns), *fields)
    return flat.groupBy("sprint", "story_id").agg(F.max_by(F.struct(*fields), order).alias("r")).select("story_id", "r.*", "sprint")


def write_stories(flat: DataFrame, path: str, force: bool = False) -> None:
    """Stories by sprint, the last of one id standing; sprints that are there already are left, unless ``force``.

    The last is that of the greatest file and row, or, where they aren't known, the greatest by its columns, so the
    same rows give the same stories however they are dealt out.
    """
    session = flat.sparkSession
    rows = last_standing(flat)
    hadoop = session.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not force and hadoop.getFileSystem(session.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        there = session.read.parquet(path).select("sprint").distinct()
        rows = rows.join(there, "sprint", "left_anti")
        rows.write.mode("append").partitionBy("sprint").parquet(path)
        return
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("sprint").parquet(path)


def export_markdown(flat: DataFrame, folder: str, fields: dict[str, str], sections: dict[str, str]) -> None:
    """A file for each story, ``<sprint>/stories/<id>.md``, written by the executors.

    ``folder`` must be one that they all share, such as a mounted file system.
    """
    rows = flat.select("sprint", "story_id", stories.to_markdown(flat, fields, sections).alias("text"))

    def save(part):
        import os

        for r in part:
            here = os.path.join(folder, r["sprint"], "stories")
            os.makedirs(here, exist_ok=True)
            whole = os.path.join(here, f"{r['story_id']}.md")
            with open(f"{whole}.new", "w", encoding="utf-8") as f:
                f.write(r["text"])
            os.replace(f"{whole}.new", whole)  # a task that runs twice leaves one whole file

    rows.foreachPartition(save)


def story_index(flat: DataFrame) -> DataFrame:
    """The master index: every story, its summary, status and components on one line, and what sections it has."""
    has = lambda c: F.when(F.trim(F.coalesce(c, F.lit(""))) != "", "Yes").otherwise("No")
    short = lambda c, n: T.truncated(F.coalesce(c, F.lit("")), n).alias(c)
    return flat.select("story_id", "sprint", short("summary", 60), short("status", 20), short("components", 40), has("acceptance_criteria").alias("has_criteria"), has("solution").alias("has_solution"))


def steps(spark: SparkSession, flat: DataFrame, out: str, traceability: str | None = None, metadata_root: str | None = None) -> list[Step]:
    """The usual steps over flat stories: stories, master index, criteria, solutions, components, epics, references,
    traceability, sprints, and the catalog of a metadata tree.
    """
    parts = maps.exploded(flat, "components", r"[,;\n/|]", "component")

    named = maps.epics(flat)

    def table(name: str, title: str, df: DataFrame, order: list) -> Callable[[], None]:
        def go():
            df.write.mode("overwrite").parquet(f"{out}/{name}")
            report.write_table(f"{out}/{name}.md", title, spark.read.parquet(f"{out}/{name}").orderBy(*order))

        return go

    def sections(name: str, title: str, column: str) -> Callable[[], None]:
        def go():
            maps.with_text(flat, column).write.mode("overwrite").parquet(f"{out}/{name}")
            report.write_sections(f"{out}/{name}.md", title, spark.read.parquet(f"{out}/{name}"), column)

        return go

    def trace() -> None:
        if traceability:
            rows = tables.header_union(tables.table_rows(tables.scan(spark, traceability)), numbered=True)
            rows.drop("row_no").write.mode("overwrite").parquet(f"{out}/traceability")
            report.write_table(f"{out}/traceability.md", "Traceability", rows.orderBy("Source", "row_no").drop("row_no"))  # the files' own order

    def edges() -> None:
        found = maps.reference_edges(flat, known_only=True)
        table("references", "References", found, ["from", "to", "sprint"])()
        report.write(f"{out}/references.mmd", maps.mermaid(found))

    def catalog() -> None:
        if metadata_root:
            files = metadata.by_folder(metadata.scan(spark, metadata_root))
            files.write.mode("overwrite").parquet(f"{out}/catalog")
            files = spark.read.parquet(f"{out}/catalog")
            report.write_table(f"{out}/catalog.md", "Metadata by folder", metadata.folder_counts(files).select("folder", "label", "files").orderBy(F.desc("files"), "folder"))
            report.write_table(f"{out}/catalog-files.md", "Metadata files", files.orderBy("folder", "file_path"))

    return [
        Step("master index", table("story_index", "Stories", story_index(flat), ["sprint", "story_id"])),
        Step("metadata catalog", catalog),
        Step("stories", lambda: write_stories(flat, f"{out}/stories", True)),
        Step("acceptance criteria", sections("criteria", "Acceptance criteria", "acceptance_criteria")),
        Step("solutions", sections("solutions", "Solutions", "solution")),
        Step("components", table("components", "Components", maps.hot(parts, "component", 1), [F.desc("stories"), "component"])),
        Step("stories of components", table("component_stories", "Stories of components", maps.members(parts, "component", more={"status": None, "summary": 70}), ["component", "sprint", "story_id"])),
        Step("epics", table("epics", "Epics", maps.frequency(named, "epic_name"), [F.desc("n"), "epic_name"])),
        Step("stories of epics", table("epic_stories", "Stories of epics", maps.members(named, "epic_name", more={"status": None, "components": 60}), ["epic_name", "sprint", "story_id"])),
        Step("references", edges),
        Step("traceability", trace),
        Step("sprints", table("sprints", "Sprints", profile.status_summary(flat), ["sprint"])),
    ]


@dataclass
class Update:
    """What a run changes: the sprints, and their stories as they were and as they are."""

    sprints: DataFrame
    before: DataFrame
    after: DataFrame


def update_stories(flat: DataFrame, path: str) -> Update:
    """Brings the stories at ``path`` up to date, writing the partitions of changed sprints only.

    A manifest (sprint, story_id, digest of all fields) tells new, changed and gone stories by anti-joins; it is
    replaced last, so a run that dies is done again from the same state.  Equal to writing all stories anew.
    """
    spark = flat.sparkSession
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path
    files = place(path).getFileSystem(context._jsc.hadoopConfiguration())
    rows = written(last_standing(flat))
    fields = [c for c in rows.columns if c not in ("sprint", "story_id")]
    now = written(rows.select("sprint", "story_id", F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256).alias("digest")))
    manifest = f"{path}/_manifest"
    old = spark.read.parquet(manifest) if files.exists(place(manifest)) else spark.createDataFrame([], now.schema)
    same = lambda a, b: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in now.columns]
    fresh = now.alias("n").join(old.alias("o"), same("n", "o"), "left_anti").select("sprint")
    gone = old.alias("o").join(now.alias("n"), same("o", "n"), "left_anti").select("sprint")
    sprints = written(fresh.union(gone).distinct())
    of = lambda df: df.join(sprints.withColumnRenamed("sprint", "__s"), F.col("sprint").eqNullSafe(F.col("__s")), "left_semi")
    there = spark.read.schema(rows.schema).parquet(path) if files.exists(place(manifest)) else spark.createDataFrame([], rows.schema)
    before, after = written(of(there)), of(rows)
    after.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("sprint").parquet(path)
    for r in sprints.join(after.select(F.col("sprint").alias("__s")).distinct(), F.col("sprint").eqNullSafe(F.col("__s")), "left_anti").toLocalIterator():  # sprints without stories, a few
        name = context._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString("sprint", r["sprint"])
        files.delete(place(f"{path}/{name}"), True)
    now.write.mode("overwrite").parquet(f"{manifest}.new")
    files.delete(place(manifest), True)
    files.rename(place(f"{manifest}.new"), place(manifest))
    return Update(sprints, before, after)


def update_counts(path: str, update: Update, counts: Callable[[DataFrame], DataFrame]) -> None:
    """Brings a table of counts (keys and ``n``) up to date by what an update took away and brought.

    ``counts`` makes such a table of stories, as ``maps.frequency`` does; sums of signed rows replace counting all.
    Call it once for each update: it isn't done twice by the same one.
    """
    spark = update.after.sparkSession
    plus, minus = counts(update.after), counts(update.before).withColumn("n", -F.col("n"))
    delta = plus.unionByName(minus)
    both = spark.read.parquet(path).unionByName(delta) if exists(spark, path) else delta
    keys = [c for c in both.columns if c != "n"]
    written(both.groupBy(*keys).agg(F.sum("n").alias("n")).where("n <> 0")).write.mode("overwrite").parquet(path)


def update_by_sprint(path: str, update: Update, rows: Callable[[DataFrame], DataFrame]) -> None:
    """Brings a table that has its rows by sprint (edges, maps) up to date: those of changed sprints are written anew."""
    spark = update.after.sparkSession
    fresh = rows(update.after)
    if exists(spark, path):
        kept = spark.read.parquet(path).join(update.sprints.withColumnRenamed("sprint", "__s"), F.col("sprint").eqNullSafe(F.col("__s")), "left_anti")
        fresh = kept.unionByName(fresh)
    written(fresh).write.mode("overwrite").parquet(path)
