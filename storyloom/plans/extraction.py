"""Batched extraction: requests from stories, responses validated and merged into six indexes."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from storyloom.functions import text as T
from storyloom.operators.dedup import keep_first, keep_last
from storyloom.plans.parts import Ledger, exists, join_files, json_lines, text_parts
from storyloom.schemas import INDEXES, index_schema
from storyloom.sources.responses import salvaged, unfenced
from storyloom.tables import running, shared

# What the indexes' schemas require, their enumerations and least sizes.
REQUIRED = {
    "glossary": ["term", "expansion", "definition", "category"],
    "story_summaries": ["id", "summary", "action_type", "entities", "business_domain"],
    "business_rules": ["story_id", "rule_id", "trigger", "action", "action_type"],
    "semantic_similarity": ["canonical", "variants", "category"],
    "cross_story_links": ["from_story", "to_story", "relationship", "confidence", "reason"],
    "intent_mapping": ["intent_id", "canonical_question", "query_variations", "business_process"],
}
#: Stories of a batch for each index.
BATCH = {"glossary": 40, "story_summaries": 15, "business_rules": 10, "semantic_similarity": 100, "cross_story_links": 80, "intent_mapping": 100}


@dataclass(frozen=True)
class ExtractionConfig:
    """Settings of one index; retries are the extractor's, and it heeds them."""

    batch_size: int = 30
    model: str = "model"
    max_tokens: int = 4096
    temperature: float = 0.0
    max_retries: int = 3
    retry_on: tuple[str, ...] = ("timeout", "rate_limit")
    enums: dict[str, list[str]] = field(default_factory=dict)


def formatted(stories: DataFrame) -> Column:
    """A story for a prompt, within the budget of its kind: defects more description, stories more criteria."""
    defect = T.is_defect(F.col("type"), F.col("acceptance_criteria"))
    cut = lambda c, a, b: F.when(defect, F.left(c, F.lit(a))).otherwise(F.left(c, F.lit(b)))
    line = lambda label, c: F.when(F.trim(F.coalesce(c, F.lit(""))) != "", F.concat(F.lit(label), c))
    return F.concat_ws(
        "\n", F.concat(F.lit("### "), F.col("story_id"), F.lit(": "), F.col("summary")), line("Type: ", F.col("type")), line("Epic: ", F.col("epic")), line("Components: ", F.col("components")),
        line("Labels: ", F.col("labels")), line("Description: ", cut(F.col("description"), 1500, 1000)), line("Acceptance Criteria: ", cut(F.col("acceptance_criteria"), 800, 1500)), line("Solution: ", F.left("solution", F.lit(1000))),
    )


def chunked(rows: DataFrame, order: list[str], size: int) -> DataFrame:
    """Adds ordinal (from 1) and chunk (from 0), in ``order``.

    Places are counted in ranges, so that no task sees all rows.
    """
    return running(rows, order, F.lit(1), "ordinal").withColumn("chunk", F.floor((F.col("ordinal") - 1) / size).cast("long"))


def requests(stories: DataFrame, index: str, template: str, order: list[str], config: ExtractionConfig | None = None, context: str = "") -> DataFrame:
    """custom_id, prompt, model, max_tokens, temperature, n_stories: one request for each chunk."""
    config = config or ExtractionConfig(batch_size=BATCH.get(index, 30))
    rows = chunked(stories.withColumn("__text", formatted(stories)), order, config.batch_size)
    texts = F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "__text"))), lambda s: s["__text"])  # batch_size at most
    each = rows.groupBy("chunk").agg(F.array_join(texts, "\n\n").alias("stories"), F.count("*").alias("n_stories"))
    prompt = T.render(F.lit(template), stories=F.col("stories"), context=F.lit(context))
    return each.select(F.concat(F.lit(f"{index}-"), F.lpad(F.col("chunk").cast("string"), 3, "0")).alias("custom_id"), prompt.alias("prompt"), F.lit(config.model).alias("model"), F.lit(config.max_tokens).alias("max_tokens"), F.lit(config.temperature).alias("temperature"), "n_stories")


class Extractor(Protocol):
    """Where prompts go and answers come from."""

    name: str

    def submit(self, requests: DataFrame) -> str: ...

    def resume(self, batch: str) -> str: ...

    def poll(self, batch: str) -> str: ...

    def collect(self, batch: str) -> DataFrame: ...


class StubExtractor:
    """Answers every request the same way, for tests and dry runs."""

    name = "stub"

    def __init__(self, answer: str):
        self.answer, self.batches = answer, {}

    def submit(self, requests: DataFrame) -> str:
        batch = batch_id(requests)
        self.batches[batch] = requests
        return batch

    def resume(self, batch: str) -> str:
        return batch

    def poll(self, batch: str) -> str:
        return "completed" if batch in self.batches else "failed"

    def collect(self, batch: str) -> DataFrame:
        return self.batches[batch].select("custom_id", F.lit("success").alias("status"), F.lit(self.answer).alias("output"))


class FileExtractor:
    """Prompts to files, answers from files that someone puts beside them."""

    name = "files"

    def __init__(self, spark: SparkSession, prompts: str, answers: str, index: str):
        self.spark, self.prompts, self.answers, self.index = spark, prompts, answers, index

    def submit(self, requests: DataFrame) -> str:
        from storyloom.sources.responses import write_prompts

        write_prompts(requests, self.prompts)
        return batch_id(requests)

    def resume(self, batch: str) -> str:
        return batch

    def poll(self, batch: str) -> str:
        import os

        with open(os.path.join(self.prompts, "manifest.txt"), encoding="utf-8") as f:
            wanted = len(f.read().split())
        return "completed" if len([x for x in os.listdir(self.answers) if x.endswith(".json")]) >= wanted else "in_progress"

    def collect(self, batch: str) -> DataFrame:
        from storyloom.sources.responses import read

        return read(self.spark, self.answers, self.index)


class CallExtractor:
    """Sends each request through ``call`` (prompt, settings -> text) from the executors, with retries.

    Every answer is a file in ``folder``, so neither a task that runs again nor another process that goes on with the
    batch asks again; without a folder answers stay in the session's.  Requests that an earlier run has answered in
    ``done`` aren't sent either.  ``call`` must be picklable.
    """

    name = "call"

    def __init__(self, call, done: DataFrame | None = None, config: ExtractionConfig | None = None, pause: float = 2.0, folder: str | None = None):
        self.call, self.done, self.config, self.pause, self.folder = call, done, config or ExtractionConfig(), pause, folder

    def submit(self, requests: DataFrame) -> str:
        batch = batch_id(requests)
        todo = pending(requests, self.done) if self.done is not None else requests
        ledger_of(self, requests).table(requests.sparkSession, f"{batch}/requests", lambda: todo)
        return self.resume(batch)

    def resume(self, batch: str) -> str:
        """Sends what hasn't been answered; the batch may be of another process."""
        spark, ledger = SparkSession.active(), ledger_of(self)
        call, retries, retry_on, pause = self.call, self.config.max_retries, self.config.retry_on, self.pause

        def answer(r) -> list[dict]:
            import time

            for k in range(retries):
                try:
                    return [{"custom_id": r.custom_id, "status": "success", "output": call(r.prompt, r.model, r.max_tokens, r.temperature), "error": None}]
                except Exception as e:
                    if k + 1 == retries or not any(w in str(e) for w in retry_on):
                        return [{"custom_id": r.custom_id, "status": "error", "output": None, "error": str(e)}]
                    time.sleep(pause * 2**k)
            return []

        def run(frames):
            for frame in frames:
                for r in frame.itertuples():
                    ledger.once(f"{batch}/answers/{r.custom_id}", lambda r=r: answer(r))
                yield frame[["custom_id"]]

        spark.read.parquet(f"{ledger.folder}/{batch}/requests").mapInPandas(run, "custom_id string").write.format("noop").mode("overwrite").save()
        return batch

    def poll(self, batch: str) -> str:
        spark, ledger = SparkSession.active(), ledger_of(self)
        if not exists(spark, f"{ledger.folder}/{batch}/requests/_SUCCESS"):
            return "failed"
        asked, answered = spark.read.parquet(f"{ledger.folder}/{batch}/requests"), ledger.rows(spark, f"{batch}/answers", ANSWERS)
        return "completed" if asked.join(answered, "custom_id", "left_anti").isEmpty() else "in_progress"

    def collect(self, batch: str) -> DataFrame:
        new = ledger_of(self).rows(SparkSession.active(), f"{batch}/answers", ANSWERS)
        return new if self.done is None else self.done.select(*new.columns).unionByName(new)


#: What comes back for a request.
ANSWERS = "custom_id string, status string, output string, error string"


def ledger_of(extractor, rows: DataFrame | None = None) -> Ledger:
    """The extractor's ledger; without a folder of its own one in the session's, which no other process finds."""
    if extractor.folder is None:
        extractor.folder = shared(rows).getCheckpointDir().rstrip("/") + "/extraction" if rows is not None else ""
    return Ledger(extractor.folder)


class Client(Protocol):
    """A provider of batches; picklable, for the executors talk to it."""

    def send(self, requests: list[dict], key: str) -> str:
        """Takes a sub-batch and names it; for a key that it knows it only tells the name again."""

    def state(self, name: str) -> str:
        """completed, failed, or anything else while it goes on."""

    def answers(self, name: str) -> list[dict]:
        """custom_id, status, output, error of each request."""


class ProviderExtractor:
    """Sends requests to a provider in sub-batches of ``size``, each from one task, and asks for all of them.

    Requests, the names of sub-batches that are sent, and answers lie in ``folder``, so a process that dies between any
    two steps is followed by another that goes on with the batch's id.  A sub-batch whose name is written isn't sent
    again; one that died before that is sent with the same key, by which the provider tells it.
    """

    name = "provider"

    def __init__(self, client: Client, size: int = 10, folder: str | None = None):
        self.client, self.size, self.folder = client, size, folder

    def submit(self, requests: DataFrame) -> str:
        batch = batch_id(requests)
        ledger_of(self, requests).table(requests.sparkSession, f"{batch}/requests", lambda: sub_batches(requests, self.size))
        return self.resume(batch)

    def resume(self, batch: str) -> str:
        """Sends the sub-batches that haven't been."""
        spark, ledger, client = SparkSession.active(), ledger_of(self), self.client
        rows = spark.read.parquet(f"{ledger.folder}/{batch}/requests")
        columns = [c for c in rows.columns if c != "sub_batch"]

        def send(frame):
            n = int(frame["sub_batch"].iloc[0])
            ledger.once(f"{batch}/sent/{n:08d}", lambda: [{"sub_batch": n, "name": client.send(frame.sort_values("custom_id")[columns].to_dict("records"), f"{batch}-{n}")}])
            return frame[["sub_batch"]].head(1)

        rows.groupBy("sub_batch").applyInPandas(send, "sub_batch long").write.format("noop").mode("overwrite").save()
        return batch

    def sent(self, batch: str) -> DataFrame:
        """sub_batch, name of what the provider has."""
        return ledger_of(self).rows(SparkSession.active(), f"{batch}/sent", "sub_batch long, name string")

    def poll(self, batch: str) -> str:
        spark, client = SparkSession.active(), self.client
        if not exists(spark, f"{ledger_of(self).folder}/{batch}/requests/_SUCCESS"):
            return "failed"

        def ask(frames):
            for frame in frames:
                yield frame[["name"]].assign(name=frame["name"].map(client.state))

        asked = spark.read.parquet(f"{ledger_of(self).folder}/{batch}/requests").select("sub_batch").distinct()
        if not asked.join(self.sent(batch), "sub_batch", "left_anti").isEmpty():
            return "in_progress"
        states = {r["name"] for r in self.sent(batch).select("name").mapInPandas(ask, "name string").distinct().collect()}  # the few states there are
        return "failed" if "failed" in states else "completed" if states <= {"completed"} else "in_progress"

    def collect(self, batch: str) -> DataFrame:
        client = self.client

        def fetch(frames):
            import pandas as pd

            for frame in frames:
                for name in frame["name"]:
                    yield pd.DataFrame(client.answers(name), columns=["custom_id", "status", "output", "error"])

        return ledger_of(self).table(SparkSession.active(), f"{batch}/answers", lambda: self.sent(batch).select("name").mapInPandas(fetch, ANSWERS))


def wait(extractor: Extractor, batch: str, every: float = 10.0, most: float = 86_400.0) -> str:
    """Polls until the batch is completed or failed, or ``most`` seconds have gone."""
    import time

    end = time.time() + most
    while (state := extractor.poll(batch)) not in ("completed", "failed") and time.time() < end:
        time.sleep(every)
    return state


def sub_batches(requests: DataFrame, size: int = 10) -> DataFrame:
    """Adds sub_batch: requests in groups of ``size`` by id, as providers take them."""
    return chunked(requests, ["custom_id"], size).withColumnRenamed("chunk", "sub_batch").drop("ordinal")


def batch_id(requests: DataFrame) -> str:
    """The same for the same requests, so that a second run finds what the first has done."""
    row = requests.agg(F.sum(F.xxhash64("custom_id", "prompt").cast("decimal(38,0)")).alias("h"), F.count("*").alias("n")).head()
    return f"batch-{row['n']}-{abs(int(row['h'] or 0)) % 10**12:012d}"


def pending(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Requests without a successful response yet."""
    return requests.join(responses.where("status = 'success'").select("custom_id"), "custom_id", "left_anti")


def items(responses: DataFrame, index: str) -> DataFrame:
    """Rows of the index in the order of responses; ``__o`` is that order."""
    array = INDEXES[index][0]
    good = responses.where("status = 'success'").select("custom_id", F.posexplode(f"parsed.{array}").alias("__p", "i"))
    return good.select(F.struct("custom_id", "__p").alias("__o"), "i.*")


def merged_arrays(rows: DataFrame, key: str, arrays: list[str]) -> DataFrame:
    """First row of each key, with the sorted distinct union of the given arrays."""
    first = keep_first(rows, [key], ["__o"])
    for a in arrays:
        values = rows.select(key, F.explode(a).alias("__v")).distinct().groupBy(key).agg(F.array_sort(F.collect_list("__v")).alias("__a"))
        first = first.join(values, key, "left").withColumn(a, F.coalesce("__a", F.array().cast("array<string>"))).drop("__a")
    return first


def assemble(rows: DataFrame, index: str) -> DataFrame:
    """The rows of an index without duplicates, in the index's order."""
    if index == "glossary":
        out = merged_arrays(rows.withColumn("__k", F.upper(F.trim("term"))), "__k", ["found_in", "synonyms"])
        return out.drop("__k", "__o").orderBy("term")
    if index == "story_summaries":
        return keep_last(rows, ["id"], ["__o"]).drop("__o").orderBy("id")
    if index == "business_rules":
        return keep_first(rows, ["rule_id"], ["__o"]).drop("__o").orderBy(F.concat("story_id", "rule_id"))
    if index == "cross_story_links":
        return keep_first(rows, ["from_story", "to_story", "relationship"], ["__o"]).drop("__o").orderBy("from_story", "to_story", "relationship")
    if index == "intent_mapping":
        return merged_arrays(rows, "intent_id", ["query_variations", "relevant_stories"]).drop("__o").orderBy("intent_id")
    if index == "semantic_similarity":
        keyed = rows.withColumn("__k", F.lower(F.trim("canonical")))
        first = keep_first(keyed, ["__k"], ["__o"]).drop("variants")
        each = keyed.select("__k", "__o", F.posexplode("variants").alias("__i", "v")).select("__k", F.col("v.phrase").alias("phrase"), F.struct("__o", "__i").alias("o"), "v")
        phrases = keep_first(each, ["__k", "phrase"], ["o"])
        variants = phrases.groupBy("__k").agg(F.transform(F.array_sort(F.collect_list(F.struct("o", "v"))), lambda s: s["v"]).alias("variants"))
        return first.join(variants, "__k", "left").drop("__k", "__o").orderBy("canonical")
    raise ValueError(f"no index {index}")


def problems(rows: DataFrame, index: str, enums: dict[str, list[str]] | None = None) -> DataFrame:
    """Adds ``problems``: what the schema finds wrong in each row, five at most."""
    found = [F.when(F.col(c).isNull(), F.lit(f"{c} is missing")) for c in REQUIRED[index]]
    for c, allowed in (enums or {}).items():
        found.append(F.when(F.col(c).isNotNull() & ~F.col(c).isin(*allowed), F.concat(F.lit(f"{c} can't be "), F.col(c).cast("string"))))
    if index == "story_summaries":
        found.append(F.when(F.length("summary") < 10, F.lit("summary is too short")))
    if index == "intent_mapping":
        found += [F.when(~F.rlike("intent_id", F.lit("^[a-z0-9-]+$")), F.lit("intent_id has other characters")), F.when(F.size("query_variations") < 2, F.lit("query_variations has fewer than 2"))]
    return rows.withColumn("problems", F.slice(F.array_compact(F.array(*found)), 1, 5))


def validation_summary(checked: DataFrame, most: int = 20) -> tuple[DataFrame, list[str]]:
    """Counts of valid and other rows, and the first problems in order."""
    counts = checked.agg(F.count("*").alias("rows"), F.count_if(F.size("problems") == 0).alias("valid"))
    first = checked.where(F.size("problems") > 0).select("__o", F.explode("problems").alias("p")).orderBy("__o").limit(most)
    return counts, [r["p"] for r in first.collect()]


def check(value: Column, kind: DataType, path: str, required: list[str] = []) -> Column:
    """What is wrong with a JSON value (a variant) of the given kind; nothing if it isn't there."""
    found, given = F.schema_of_variant(value), value.isNotNull() & ~F.is_variant_null(value)
    none = F.array().cast("array<string>")
    wrong = lambda name: F.array(F.lit(f"{path} should be {name}"))
    if isinstance(kind, StringType):
        return F.when(given & (found != "STRING"), wrong("text")).otherwise(none)
    if isinstance(kind, ArrayType):
        inner = F.flatten(F.transform(F.try_variant_get(value, "$", "array<variant>"), lambda x: check(x, kind.elementType, f"{path}[]", required)))
        return F.when(given & ~F.startswith(found, F.lit("ARRAY")), wrong("a list")).when(given, inner).otherwise(none)
    if isinstance(kind, StructType):
        each = []
        for f in kind:
            child = F.try_variant_get(value, f"$.{f.name}", "variant")
            if f.name in required:
                each.append(F.when(child.isNull() | F.is_variant_null(child), F.array(F.lit(f"{path}.{f.name} is missing"))).otherwise(none))
            each.append(check(child, f.dataType, f"{path}.{f.name}"))
        return F.when(given & ~F.startswith(found, F.lit("OBJECT")), wrong("an object")).when(given, F.concat(*each)).otherwise(none)
    return none


def response_problems(raw: Column, index: str, most: int = 5) -> Column:
    """What the index's schema finds wrong in a response's JSON: kinds of values at every depth, and what must be there."""
    array = INDEXES[index][0]
    value = F.try_parse_json(unfenced(raw))
    rows = F.try_variant_get(value, f"$.{array}", "variant")
    kind = StructType.fromDDL(index_schema(index).removeprefix("struct<").removesuffix(">"))[array].dataType
    return (
        F.when(value.isNull(), F.array(F.lit("not JSON")))
        .when(rows.isNull() | F.is_variant_null(rows), F.array(F.lit(f"{array} is missing")))
        .otherwise(F.slice(check(rows, kind, array, REQUIRED[index]), 1, most))
    )


def validate_responses(responses: DataFrame, index: str, raw: str = "output", most: int = 20) -> tuple[DataFrame, list[tuple[str, str]]]:
    """total, valid and invalid responses, and the first problems by custom_id; one without success is invalid."""
    good = F.col("status") == "success"
    checked = responses.select("custom_id", good.alias("good"), F.when(good, response_problems(F.col(raw), index)).otherwise(F.array().cast("array<string>")).alias("problems"))
    valid = F.count_if(F.col("good") & (F.size("problems") == 0))
    counts = checked.agg(F.count("*").alias("total"), valid.alias("valid"), (F.count("*") - valid).alias("invalid"))
    first = checked.select("custom_id", F.posexplode("problems").alias("at", "problem")).orderBy("custom_id", "at").limit(most)
    return counts, [(r["custom_id"], r["problem"]) for r in first.collect()]


def write_index(rows: DataFrame, index: str, path: str) -> int:
    """The rows as JSON lines in the folder ``<path>.d``, and all of them in one file with kind and total; how many there are.

    Executors write both in parts, and the parts of the file are joined from stream to stream, at any size.
    """
    array, spark = INDEXES[index][0], rows.sparkSession
    parts = f"{path}.d"
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(parts)
    n = spark.read.text(parts).count()
    lines = text_parts(json_lines(rows))
    join_files(spark, path, [('{\n  "index_type": %s,\n  "%s": [' % (json.dumps(index), array), lines, 1)], '  ],\n  "total_%s": %d\n}\n' % (array, n))
    return n


def build(
    stories: DataFrame, index: str, template: str, extractor: Extractor, order: list[str], dry_run: bool = False, context: str = "", every: float = 10.0, most: float = 86_400.0, batch: str | None = None
) -> tuple[DataFrame, DataFrame] | int:
    """Requests, answers, checks and the merged index, with a table of what is wrong in its rows; of a dry run the number of requests.

    With the id of a ``batch`` that was begun before, nothing that it has sent is sent again.  Polls ``every`` so many
    seconds until the batch is completed, for ``most`` at most; one that isn't by then can be collected later.
    """
    asked = requests(stories, index, template, order, context=context)
    if dry_run:
        return asked.count()
    batch = extractor.submit(asked) if batch is None else extractor.resume(batch)
    state = wait(extractor, batch, every, most)
    if state != "completed":
        raise RuntimeError(f"{batch} is {state}")
    return collected(extractor, batch, index)


def build_all(
    stories: DataFrame, templates: dict[str, str], extractor: Callable[[str], Extractor], order: list[str], folder: str, dry_run: bool = False, context: str = "", every: float = 10.0, most: float = 86_400.0, batches: dict[str, str] | None = None
) -> dict[str, int]:
    """All indexes that have a template, each by an extractor of its own, written to ``<folder>/<index>.json`` with its
    faults in ``<index>.faults``; how many rows each has, or of a dry run how many requests.

    Every index is submitted before any is waited for.  ``batches`` are the ids of those that an earlier run began.
    """
    unknown = set(templates) - set(INDEXES)
    if unknown:
        raise ValueError(f"no index {', '.join(sorted(unknown))}")
    names = [n for n in INDEXES if n in templates]
    asked = {n: requests(stories, n, templates[n], order, context=context) for n in names}
    if dry_run:
        return {n: asked[n].count() for n in names}
    extractors = {n: extractor(n) for n in names}
    begun = {n: extractors[n].resume(batches[n]) if batches and n in batches else extractors[n].submit(asked[n]) for n in names}
    out = {}
    for n in names:
        if (state := wait(extractors[n], begun[n], every, most)) != "completed":
            raise RuntimeError(f"{begun[n]} of {n} is {state}")
        rows, faults = collected(extractors[n], begun[n], n)
        faults.write.mode("overwrite").json(f"{folder}/{n}.faults")
        out[n] = write_index(rows, n, f"{folder}/{n}.json")
    return out


def collected(extractor: Extractor, batch: str, index: str) -> tuple[DataFrame, DataFrame]:
    """The merged index of all rows that a batch gave, and custom_id, place, problems, row of those with any.

    Rows with problems stay in the index; answers that hold no rows are in the second table, without a place.
    """
    answers = extractor.collect(batch)
    if "parsed" not in answers.columns:
        answers = answers.withColumn("parsed", salvaged(F.col("output"), index)).withColumn("status", F.when(F.col("parsed").isNull() & (F.col("status") == "success"), "error").otherwise(F.col("status")))
    if answers.where("status = 'success'").isEmpty():
        raise RuntimeError("no answer was usable")
    rows = problems(items(answers, index), index)
    wrong = rows.where(F.size("problems") > 0)
    fields = [c for c in wrong.columns if c not in ("__o", "problems")]
    faults = wrong.select(F.col("__o.custom_id").alias("custom_id"), F.col("__o.__p").alias("place"), "problems", F.to_json(F.struct(*fields)).alias("row"))
    said = F.coalesce(F.col("error"), F.lit("no rows in the answer")) if "error" in answers.columns else F.lit("no rows in the answer")
    unread = answers.where("status <> 'success'").select("custom_id", F.lit(None).cast("int").alias("place"), F.array(said).alias("problems"), F.lit(None).cast("string").alias("row"))
    return assemble(rows.drop("problems"), index), faults.unionByName(unread)
