import json
from datetime import date

import pytest
from lexipress.sources import files
from lexipress.sources.pacing import Pacer, with_retries
from lexipress.sources.paged import PagedSource, pages, register
from pyspark.sql import functions as F

ITEMS = [{"id": str(i), "url": f"http://x/{i}", "content": "c", "title": None, "created_at": str(i), "source": "s", "summary": "m"} for i in range(450)]


def fetch(start, limit):
    return json.dumps(json.dumps(ITEMS[start : start + limit]))


def test_pages():
    assert [len(p) for p in pages(fetch)] == [200, 200, 50]
    assert [len(p) for p in pages(lambda s, n: ITEMS[s : s + n] if s < 400 else [])] == [200, 200]
    calls = []

    def flaky(start, limit):
        calls.append(start)
        if len(calls) % 2:
            raise OSError
        return ITEMS[start : start + limit]

    assert sum(len(p) for p in pages(flaky, wait=0)) == 450
    with pytest.raises(OSError):
        list(pages(lambda *_: (_ for _ in ()).throw(OSError()), retries=2, wait=0))


def test_paged_source(spark):
    spark.dataSource.register(PagedSource)
    df = spark.read.format("paged").option("fetch", "tests.test_sources:fetch").option("wait", "0").load()
    assert df.count() == 450 and df.where("title is null").count() == 450


def test_captured_pages(spark, tmp_path):
    (tmp_path / "p1.json").write_text(json.dumps(ITEMS[:2]))
    (tmp_path / "p2.json").write_text(json.dumps(json.dumps(ITEMS[2:5])))
    df = files.read_captured_pages(spark, str(tmp_path), "id: string, url: string")
    assert sorted(r["id"] for r in df.collect()) == ["0", "1", "2", "3", "4"] and set(df.columns) == {"page", "position", "id", "url"}


def test_jsonl(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\nb", [1, 2]), (2, None, None)], "id long, text string, tags array<int>")
    files.write_jsonl(df, str(tmp_path / "x"))
    assert sorted(map(str, files.read_jsonl(spark, str(tmp_path / "x"), df.schema).collect())) == sorted(map(str, df.collect()))
    (tmp_path / "y.jsonl").write_text('{"id": 1}\n\n  \n{"id": 2}\n')
    assert files.read_jsonl(spark, str(tmp_path / "y.jsonl"), "id long").count() == 2


def test_delimited(spark, tmp_path):
    (tmp_path / "goal_3.csv").write_text('﻿title;raw_text\n"a;b";"x\ny ""q"""\nc;\n', encoding="utf-8")
    rows = files.read_delimited(spark, str(tmp_path / "goal_3.csv"), ["title", "raw_text"])
    assert sorted(map(tuple, rows.collect())) == [("a;b", 'x\ny "q"'), ("c", "")]
    assert files.with_file_goal(rows).select("id_goal").distinct().head()[0] == 3
    files.write_delimited(rows, str(tmp_path / "out"))
    assert sorted(map(tuple, files.read_delimited(spark, str(tmp_path / "out"), ["title", "raw_text"]).collect())) == sorted(map(tuple, rows.collect()))


def test_sinks(spark, tmp_path):
    df = spark.range(10).withColumn("day", F.col("id") % 2)
    files.write_bulk(df, str(tmp_path / "t"), ["day"])
    files.write_bulk(df.where("day = 1").limit(2), str(tmp_path / "t"), ["day"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 7
    files.write_report(df, str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).count() == 10


def test_pacing():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    p = Pacer(2, 60, lambda: now[0], sleep)
    for _ in range(5):
        p.take()
    assert now[0] == 120.0
    tries = []
    assert with_retries(lambda: tries.append(1) or (1 / 0 if len(tries) < 3 else 7), 5, lambda e, k: 0.5, sleep)() == 7
    with pytest.raises(ZeroDivisionError):
        with_retries(lambda: 1 / 0, 5, lambda e, k: None, sleep)()


def noted(path, what):
    with open(path, "a") as f:
        f.write(f"{what}\n")


def lines(path):
    return path.read_text().split() if path.exists() else []


def fetch_day(start, limit, day, source):
    """Five items a day; every fetch is noted."""
    noted(source, f"{day}:{start}")
    return [{"id": f"{day}-{k}"} for k in range(5)][start : start + limit]


def fetch_counted(start, limit, source):
    noted(f"{source}/seen", start)
    return ITEMS[start : start + limit]


def head(source):
    with open(f"{source}/head") as f:
        return int(f.read())


def test_a_task_a_day_and_days_left_out(spark, tmp_path):
    register(spark)
    seen = tmp_path / "seen"
    df = spark.read.format("paged").options(fetch="tests.test_sources:fetch_day", schema="id string", first="2024-03-01", last="2024-03-10", limit=3, source=str(seen)).load()
    assert df.rdd.getNumPartitions() == 10 and df.count() == 50
    seen.unlink()
    some = df.where("day >= DATE '2024-03-04' AND day < DATE '2024-03-06' AND id LIKE '%-4'")
    assert sorted(r["id"] for r in some.collect()) == ["2024-03-04-4", "2024-03-05-4"]
    assert sorted(lines(seen)) == ["2024-03-04:0", "2024-03-04:3", "2024-03-05:0", "2024-03-05:3"]
    assert df.where("day IN (DATE '2024-03-09', DATE '2025-01-01')").count() == 5


def test_ranges_of_the_cursor(spark, tmp_path):
    spark.dataSource.register(PagedSource)
    (tmp_path / "head").write_text("450")
    df = spark.read.format("paged").options(fetch="tests.test_sources:fetch_counted", head="tests.test_sources:head", limit=50, pages_a_task=2, source=str(tmp_path)).load()
    assert df.rdd.getNumPartitions() == 5 and sorted(int(r["id"]) for r in df.collect()) == list(range(450))
    assert sorted(map(int, lines(tmp_path / "seen"))) == list(range(0, 450, 50))


def test_a_stream_goes_on_where_it_was(spark, tmp_path):
    spark.dataSource.register(PagedSource)
    (tmp_path / "head").write_text("120")

    def run():
        stream = spark.readStream.format("paged").options(fetch="tests.test_sources:fetch_counted", head="tests.test_sources:head", limit=50, source=str(tmp_path)).load()
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination(120)

    run()
    run()  # nothing new: no page is fetched
    assert sorted(map(int, lines(tmp_path / "seen"))) == [0, 50, 100]
    (tmp_path / "head").write_text("300")
    run()
    assert sorted(map(int, lines(tmp_path / "seen"))) == [0, 50, 100, 120, 170, 220, 270]
    assert sorted(int(r["id"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(300))


def test_a_page_costs_no_more_in_a_larger_day(spark, tmp_path, monkeypatch):
    """Pages over a captured day come from the files that hold them, each read once a task, and a day is several tasks."""
    from lexipress.sources import captured

    rows = spark.range(1000).select(F.col("id").alias("k"), F.when(F.col("id") < 990, F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 7919 % 86400 + F.when(F.col("id") % 10 == 0, 86400).otherwise(0))).alias("ts"))
    held = captured.capture(rows.repartition(5), "ts", "k", str(tmp_path / "held"), 100)
    read, real = [], captured.pq.ParquetFile
    monkeypatch.setattr(captured.pq, "ParquetFile", lambda f: (read.append(1), real(f))[1])
    day, want = date(2024, 1, 1), [k for k in range(990) if k % 10]
    got = [page for page in pages(lambda a, n: captured.fetch(a, n, day, held), 7)]
    assert [x["k"] for page in got for x in page] == want and all(len(p) == 7 for p in got[:-1])
    assert len(read) <= 20 < len(got)
    assert captured.head(held, day) == len(want) and captured.head(held, date(2024, 3, 1)) == 0 and captured.fetch(0, 7, date(2024, 3, 1), held) == []
    register(spark)
    df = spark.read.format("paged").options(fetch="lexipress.sources.captured:fetch", head="lexipress.sources.captured:head", schema="k string", first="2024-01-01", last="2024-01-03", limit=7, pages_a_task=20, source=held).load()
    assert sorted((int(r["k"]), str(r["day"])) for r in df.collect()) == [(k, "2024-01-01" if k % 10 else "2024-01-02") for k in range(990)]
    assert df.where("day = DATE '2024-01-01'").rdd.getNumPartitions() == 7
