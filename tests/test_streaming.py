"""Streams over files, run until what is there is read."""

import json

from storyloom.streaming import usage


def test_windows_without_duplicates(spark, tmp_path):
    (tmp_path / "in").mkdir()
    e = lambda ts, user, tokens: {"ts": ts, "user": user, "model": "m", "total_tokens": tokens, "cost": 0.5}
    first = [e("2025-01-01T01:00:00Z", "u", 1), e("2025-01-01T01:00:00Z", "u", 1), e("2025-01-01T05:00:00Z", "v", 2)]
    (tmp_path / "in" / "a.json").write_text("\n".join(map(json.dumps, first)))
    events = usage.deduplicated(usage.read(spark, str(tmp_path / "in")), "1 hour")
    run = lambda: usage.write(usage.windowed(events, "1 hour"), str(tmp_path / "out"), str(tmp_path / "cp"), once=True).awaitTermination()
    run()
    (tmp_path / "in" / "b.json").write_text(json.dumps(e("2025-01-03T00:00:00Z", "u", 3)))
    run()
    rows = sorted((str(r["start"]), r["requests"], r["tokens"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert rows[:2] == [("2025-01-01 01:00:00", 1, 1), ("2025-01-01 05:00:00", 1, 2)]


def test_sessions(spark, tmp_path):
    (tmp_path / "a.json").write_text("\n".join(json.dumps({"ts": f"2025-01-01T0{h}:00:00Z", "user": "u", "model": "m", "total_tokens": h, "cost": 1.0}) for h in (1, 2, 5)))
    batch = spark.read.schema(usage.STREAM).json(str(tmp_path / "a.json"))
    assert sorted(r["requests"] for r in usage.sessions(batch, "90 minutes").collect()) == [1, 2]


def test_running_ratios_after_late_rows_and_a_restart(spark, tmp_path):
    import random

    from pyspark.sql import functions as F

    from storyloom.operators import usage as batch

    rng = random.Random(2)
    numbers = lambda k: {c: rng.randrange(50) for c in ("input_with_cache", "input_without_cache", "cache_read", "output_tokens")} | {"cost": rng.randrange(100) / 8}
    rows = [{"ts": f"2025-0{rng.randrange(1, 6)}-0{rng.randrange(1, 9)}T0{rng.randrange(9)}:00:00Z", "user": rng.choice("abc"), "model": rng.choice("mn"), "total_tokens": k} | numbers(k) for k in range(300)]
    rng.shuffle(rows)  # events of January come after those of May
    (tmp_path / "in").mkdir()
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    for k in range(3):
        part = rows[k * 100 : (k + 1) * 100] + (rows[:20] if k else [])  # seen before, long behind any watermark
        for j in range(2):
            (tmp_path / "in" / f"{k}{j}.json").write_text("\n".join(map(json.dumps, part[j::2])))
        events = usage.first_only(usage.read(spark, str(tmp_path / "in"), files_per_trigger=1))
        usage.keep_cells(events, out, checkpoint, once=True).awaitTermination()  # a new query each time, from the checkpoint
        whole = spark.read.schema(usage.STREAM).json(str(tmp_path / "in")).dropDuplicates(["ts", "user", "model", "total_tokens"]).withColumn("day", F.to_date("ts"))
        for group in ("user", "model", "day"):
            want = batch.per(whole, group)
            got = usage.running(spark, out, group).select(*want.columns)
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
