"""Numbers: exclusive quantiles, top rows of a group, shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storyloom.tables import running, written


def top_per_group(df: DataFrame, group: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group; ``order`` must leave no ties for stable results."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(rank) <= k)


def ranked_quantiles(df: DataFrame, column: str, n: int, group: list[str]) -> DataFrame:
    """Cut points of each group, by counts of distinct values that are summed up in ranges of (group, value), so no task
    sees all values, nor all of a group.
    """
    group = group or []
    counts = df.where(F.col(column).isNotNull()).groupBy(*group, F.col(column).cast("double").alias("x")).agg(F.count("*").alias("c"))
    ranked = running(counts, [*group, "x"], F.col("c"), "high").withColumn("low", F.col("high") - F.col("c") + 1)
    total = ranked.groupBy(*group).agg((F.min("low") - 1).alias("before"), (F.max("high") - F.min("low") + 1).alias("n_rows"))
    if group:
        on = [F.col(f"r.{g}").eqNullSafe(F.col(f"t.{g}")) for g in group]
        placed = ranked.alias("r").join(total.alias("t"), on).select("r.*", "before", "n_rows")
    else:
        one = total.head()  # one row
        placed = ranked.withColumns({c: F.lit((one and one[c]) or 0).cast("long") for c in ("before", "n_rows")})

    def cut(q: Column) -> Column:
        j = F.least(F.greatest(F.floor(q * (F.col("n_rows") + 1) / n), F.lit(1)), F.col("n_rows") - 1)
        return F.struct(q.alias("q"), j.alias("j"), (q * (F.col("n_rows") + 1) - j * n).alias("delta"))

    placed = placed.where("n_rows >= 2").withColumns({c: F.col(c) - F.col("before") for c in ("low", "high")})
    near = F.filter(F.transform(F.sequence(F.lit(1), F.lit(n - 1)), cut), lambda c: (F.col("low") <= c["j"] + 1) & (F.col("high") >= c["j"]))
    rows = placed.select(*group, "x", "low", "high", F.explode(near).alias("c")).select(*group, "x", "low", "high", "c.*")
    at = lambda place: F.max(F.when((F.col("low") <= place) & (F.col("high") >= place), F.col("x")))
    both = rows.groupBy(*group, "q", "delta").agg(at(F.col("j")).alias("a"), at(F.col("j") + 1).alias("b"))
    return both.select(*group, F.col("q").cast("int").alias("q"), ((F.col("a") * (n - F.col("delta")) + F.col("b") * F.col("delta")) / n).alias("value"))


#: Buckets that each interval is divided into in a round of refinement.
FINE = 4096


def selected(rows: DataFrame, ranks: list[int]) -> dict[int, float]:
    """The values of ``x`` (doubles, finite) at these ranks, from 1, by refining histograms.

    Each round counts the values of the intervals that hold a rank in equal buckets, and goes on with the buckets that
    do; one whose least and greatest are the same is an answer.  So a round sends a row for each bucket and task, however
    many values there are, and nothing is sorted.  A bucket's values are all those from its least to its greatest, as
    the number of a bucket never falls with the value.
    """
    ends = rows.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).head()
    found: dict[int, float] = {}
    todo = {(ends["lo"], ends["hi"], 0): set(ranks)}  # interval, values before it -> ranks in it
    while todo:
        for (lo, hi, _), wanted in todo.items():
            if lo == hi:
                found |= dict.fromkeys(wanted, lo)
        todo = {k: v for k, v in todo.items() if k[0] < k[1]}
        if not todo:
            break
        parts = sorted(todo)
        which, place = F.lit(None).cast("int"), F.lit(None).cast("int")
        for i, (lo, hi, _) in enumerate(parts):
            inside = F.col("x").between(F.lit(lo), F.lit(hi))
            which = F.when(inside, i).otherwise(which)
            # halves first, so that the width of the widest interval is finite; the narrowest has none
            width = hi / 2 - lo / 2
            own = F.floor((F.col("x") / 2 - F.lit(lo / 2)) / F.lit(width) * FINE).cast("int") if width else (F.col("x") > lo).cast("int")
            place = F.when(inside, own).otherwise(place)
        counts = rows.select(which.alias("part"), place.alias("place"), "x").where("part is not null").groupBy("part", "place").agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        after: dict = {}
        before = {i: p[2] for i, p in enumerate(parts)}
        for r in sorted(counts.collect(), key=lambda r: (r["part"], r["place"])):  # FINE + 1 for each interval, at most
            low = before[r["part"]]
            before[r["part"]] = low + r["n"]
            mine = {k for k in todo[parts[r["part"]]] if low < k <= low + r["n"]}
            if mine:
                after[(r["lo"], r["hi"], low)] = mine
        todo = after
    return found


def exclusive_quantiles(df: DataFrame, column: str, n: int = 10, group: list[str] | None = None) -> DataFrame:
    """Cut points 1..n-1 by the exclusive method: one row for each (q, value), per group.

    Of all rows they are selected by refining histograms, of groups by ranks of distinct values; fewer than two values
    have no cut points.  Values that aren't finite are ranked, too.
    """
    if group:
        return ranked_quantiles(df, column, n, group)
    rows = df.select(F.col(column).cast("double").alias("x")).where("x is not null")
    odd = F.isnan("x") | F.col("x").isin(float("inf"), float("-inf"))
    rows = written(rows)  # read again in each round
    size = rows.agg(F.count("*").alias("n"), F.count_if(odd).alias("odd")).head()
    if size["odd"]:
        return ranked_quantiles(df, column, n, [])
    total, spark = size["n"], df.sparkSession
    kind = "q int, value double"
    if total < 2:
        return spark.createDataFrame([], kind)
    cuts = {q: min(max(q * (total + 1) // n, 1), total - 1) for q in range(1, n)}
    at = selected(rows, sorted({r for j in cuts.values() for r in (j, j + 1)}))
    out = []
    for q, j in cuts.items():
        delta = q * (total + 1) - j * n
        out.append((q, (at[j] * (n - delta) + at[j + 1] * delta) / n))
    return spark.createDataFrame(out, kind)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.when(whole > 0, F.round(part / whole * 100, digits)).otherwise(0.0)
