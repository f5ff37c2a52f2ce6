"""Documents and JSON from small results; what is collected here is a report's rows, not a corpus."""

from __future__ import annotations

import json
import os
import re
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.functions import fixed
from storyloom.plans.parts import join_files, json_lines, text_parts


def records(df: DataFrame, most: int | None = None) -> list[dict[str, Any]]:
    """The rows in their order, the first ``most`` only if asked."""
    return [r.asDict(recursive=True) for r in (df if most is None else df.limit(most)).toLocalIterator()]


def cell(value: Any) -> str:
    if value is None:
        return ""
    text = ", ".join(map(str, value)) if isinstance(value, list) else f"{value:,}" if isinstance(value, int) and not isinstance(value, bool) else str(value)
    return text.replace("\n", " ").replace("|", "\\|")


def table_head(names: list[str]) -> str:
    return "| " + " | ".join(names) + " |\n|" + "---|" * len(names)


def table_line(row: dict[str, Any], names: list[str]) -> str:
    return "| " + " | ".join(cell(row[n]) for n in names) + " |"


def markdown_table(rows: list[dict[str, Any]]) -> str:
    if not rows:
        return "_None._"
    names = list(rows[0])
    return "\n".join([table_head(names), *(table_line(r, names) for r in rows)])


def document(title: str, sections: dict[str, list[dict[str, Any]]], advice: list[str] | None = None) -> str:
    parts = [f"# {title}"]
    for name, rows in sections.items():
        parts += [f"## {name}", markdown_table(rows)]
    if advice:
        parts += ["## Recommendations", "\n".join(f"- {x}" for x in advice)]
    return "\n\n".join(parts) + "\n"


def write(path: str, content: str | dict) -> None:
    """A report as text, or as JSON; JSON always lies beside the text."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        if isinstance(content, str):
            f.write(content)
        else:
            json.dump(content, f, indent=2, ensure_ascii=False, default=str)


def write_table(path: str, title: str, rows: DataFrame) -> int:
    """A document of all rows in their order, its lines written by the executors; how many there were."""
    import pyarrow as pa

    names = rows.columns

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([table_line(r, names) for r in batch.to_pylist()], pa.string())], names=["value"])

    parts = text_parts(rows.mapInArrow(run, "value string"))
    n = rows.sparkSession.read.text(parts).count()
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    join_files(rows.sparkSession, path, [(f"# {title}\n\n## {title}\n\n" + (table_head(names) + "\n" if n else "_None._\n"), parts, 0)])
    return n


def write_sections(path: str, title: str, rows: DataFrame, column: str) -> int:
    """A document with each row's whole section in a fence under its sprint and key; how many there were.

    Rows come in order of sprint, key and text, headings as rows before those of their sprint; executors write them.
    """
    import pyarrow as pa

    def section(r: dict[str, Any]) -> str:
        if r["heading"]:
            return f"\n## {r['sprint'] or 'Unknown'}"
        fence = "`" * max(3, 1 + max(map(len, re.findall("`+", r[column])), default=0))  # longer than any in the text
        return f"\n### {r['story_id']} — {r['summary'] or ''}".rstrip() + f"\n\n_Status: {r['status'] or 'Unknown'} · Components: {r['components'] or 'None'}_\n\n{fence}\n{r[column]}\n{fence}"

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([section(r) for r in batch.to_pylist()], pa.string())], names=["value"])

    each = rows.select("sprint", "story_id", "summary", "status", "components", column, F.lit(False).alias("heading"))
    both = each.unionByName(rows.select("sprint").distinct().withColumn("heading", F.lit(True)), allowMissingColumns=True)
    parts = text_parts(both.orderBy("sprint", F.desc("heading"), "story_id", "summary", column).mapInArrow(run, "value string"))
    n = rows.count()
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    join_files(rows.sparkSession, path, [(f"# {title}\n" + ("" if n else "\n_None._\n"), parts, 0)])
    return n


def spliced(text: str, heading: str, table: str) -> str:
    """``text`` with the section under ``heading`` replaced by the table, or with both at its end."""
    lines = text.splitlines()
    marks = [i for i, x in enumerate(lines) if x.strip() == heading.strip()]
    if not marks:
        return text.rstrip("\n") + f"\n\n{heading}\n\n{table}\n"
    at = marks[0]
    level = len(heading) - len(heading.lstrip("#"))
    end = next((i for i in range(at + 1, len(lines)) if lines[i].startswith("#") and len(lines[i]) - len(lines[i].lstrip("#")) <= level), len(lines))
    return "\n".join([*lines[: at + 1], "", table, "", *lines[end:]]).rstrip("\n") + "\n"


def advice(kind: str, measures: dict[str, Any]) -> list[str]:
    """What is advised for the measures that pass their limits; one that isn't known passes none."""
    passed = lambda name, sense, limit: measures.get(name) is not None and (measures[name] < limit if sense == "<" else measures[name] > limit)
    return [text.format(**measures) for name, sense, limit, text in fixed.ADVICE[kind] if passed(name, sense, limit)] or [fixed.NO_ADVICE[kind]]


def corpus_advice(sprints: list[dict[str, Any]], sections: dict[str, float], mean_quality: float, missing: int = 0, sparse: int = 0) -> list[str]:
    """About missing sections (``sections``: percent of stories by section) with the three worst sprints, quality, missing documents and thin files."""
    measures: dict[str, Any] = {"mean_quality": mean_quality, "missing": missing, "sparse": sparse}
    for name, short in (("Acceptance Criteria", "ac"), ("Solution", "solution")):
        share, key = sections.get(name, 0.0), f"{short}_pct"
        worst = sorted(sprints, key=lambda s, key=key: (s[key], s["sprint"]))[:3]
        measures |= {key: share, f"{short}_missing": round(100 - share), f"{short}_worst": ", ".join(f"{s['sprint']} ({s[key]} %)" for s in worst)}
    return advice("corpus", measures)


def usage_advice(overview: dict[str, Any], cache: dict[str, Any], outliers: int) -> list[str]:
    """About the cache, requests of three times the mean cost and the daily cost."""
    daily = (overview.get("cost") or 0) / max(overview.get("days") or 1, 1)
    return advice("usage", {"overall_rate": cache["overall_rate"], "outliers": outliers, "cost_per_request": overview["cost_per_request"], "daily": daily})


def query_advice(distribution: list[dict[str, Any]], total: int, with_ids_pct: float, recurring: list[str]) -> list[str]:
    """About questions of no known intent, questions that name a story and recurring phrases."""
    general = sum(d["queries"] for d in distribution if d["intent"] == "general")
    return advice("queries", {"general_pct": round(general / total * 100, 1) if total else 0.0, "with_ids_pct": with_ids_pct, "recurring": len(recurring), "phrases": ", ".join(recurring[:3])})


def retrieval_advice(evaluation: dict[str, Any], gaps: int, gap_terms: list[str], cost_per_request: float | None = None) -> list[str]:
    """About the mean best match, gaps and their terms, questions without any match and cost."""
    n = evaluation["queries"]
    share = round(gaps / n * 100, 1) if n else 0.0
    return advice("retrieval", {"mean_best": evaluation["mean_best"], "no_match": evaluation["no_match"], "gaps_pct": share, "gap_terms": len(gap_terms), "terms": ", ".join(gap_terms[:3]), "cost": cost_per_request})


def write_object_index(folder: str, objects: DataFrame, stories: DataFrame) -> dict[str, Any]:
    """The object-story index as two tables and a document of all objects by number of stories; the document's counts."""
    objects.write.mode("overwrite").parquet(f"{folder}/objects")
    stories.write.mode("overwrite").parquet(f"{folder}/object_stories")
    rows = objects.sparkSession.read.parquet(f"{folder}/objects")
    one = rows.agg(F.count("*").alias("objects"), F.count_if(F.col("stories") > 0).alias("with_stories"), F.count_if(F.col("stories") == 0).alias("without_stories"), F.coalesce(F.sum("stories"), F.lit(0)).alias("links")).head()
    write_table(f"{folder}/objects.md", "Objects and stories", rows.orderBy(F.desc("stories"), "label"))
    return one.asDict()


def keyword_taxonomy(acronyms: DataFrame, personas: DataFrame, processes: DataFrame, integrations: DataFrame, bigrams: DataFrame, objects: DataFrame) -> dict[str, DataFrame]:
    """The taxonomy that retrieval reads: at most 100 objects, 50 processes and 50 bigrams, all of the rest."""
    top = lambda df, by, k=None: (lambda o: o if k is None else o.limit(k))(df.orderBy(F.desc(by), df.columns[0]))
    return {"acronyms": top(acronyms, "n"), "personas": top(personas, "n"), "processes": top(processes, "n", 50), "integrations": top(integrations, "n"), "bigrams": top(bigrams, "docs", 50), "objects": top(objects, "stories", 100)}


def write_taxonomy(path: str, taxonomy: dict[str, DataFrame]) -> None:
    """The taxonomy as one JSON file, a list for each kind, whose rows the executors write."""
    pieces = [(("{" if not k else "],") + f'\n  "{name}": [', text_parts(json_lines(rows)), 1) for k, (name, rows) in enumerate(taxonomy.items())]
    join_files(next(iter(taxonomy.values())).sparkSession, path, pieces, "]\n}\n")
