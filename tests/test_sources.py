"""The paged source's requests, its ledger across restarts, and ordered files that survive killed attempts."""

import datetime
import json
import lzma
import os
import re
import subprocess

import pytest
from pyspark.sql import functions as F

from textmill.sources import files, ledger, paged, sink

COLUMNS = "id long, title string, `format` string, `date.created` timestamp, `source.name` string, views long"


def record(i):
    t = datetime.datetime(2020, 1, 1, tzinfo=datetime.UTC) + datetime.timedelta(hours=7 * i)
    fields = {"title": f"t{i}", "body": "long " * 50, "date": {"created": t.isoformat(), "changed": (t + datetime.timedelta(days=1)).isoformat()}, "source": [{"id": i % 3, "name": f"s{i % 3}"}], "views": i * 10}
    if i % 5:
        fields["format"] = ("Map", "News", "Other")[i % 3]
    return {"id": i, "fields": fields}


@pytest.fixture
def server(tmp_path):
    (tmp_path / "records.jsonl").write_text("".join(json.dumps(record(i)) + "\n" for i in range(60)))
    (tmp_path / "requests.jsonl").write_text("")
    return tmp_path


def requests(server):
    return [json.loads(x) for x in (server / "requests.jsonl").read_text().splitlines()]


def load(spark, server, schema=COLUMNS, **options):
    paged.register(spark)
    return spark.read.format("paged").schema(schema).options(folder=str(server), limit="7", **options).load()


def filters_left(df):
    return re.findall(r"(?<![a-zA-Z])Filter .*", df._jdf.queryExecution().executedPlan().toString())


def test_filters_become_conditions(spark, server):
    df = load(spark, server).filter(~F.col("format").isin("Map", "Other") & (F.col("`date.created`") >= F.lit("2020-01-05T00:00:00Z").cast("timestamp")) & (F.col("views") <= 400))
    want = {i for i in range(60) if i % 5 and i % 3 == 1 and 7 * i >= 96 and i <= 40}
    assert {r.id for r in df.collect()} == want
    assert filters_left(df) == []  # nothing is left for Spark
    (asked,) = {json.dumps(r["filter"], sort_keys=True) for r in requests(server)}
    conditions = json.loads(asked)["conditions"]
    assert {"field": "format", "value": ["Map", "Other"], "negate": True} in conditions
    assert {"field": "date.created", "value": {"from": "2020-01-05T00:00:00+00:00"}} in conditions and {"field": "views", "value": {"to": 400}} in conditions
    assert sum(r["limit"] == 7 for r in requests(server)) == -(-len(want) // 7)  # pages of what is wanted only


def test_columns_become_fields(spark, server):
    df = load(spark, server, "id long, title string, `source.name` string")
    assert sorted(tuple(r) for r in df.collect())[:2] == [(0, "t0", "s0"), (1, "t1", "s1")]
    assert all(r["fields"] == {"include": ["title", "source.name"]} for r in requests(server))


def test_given_parameters_stay(spark, server):
    parameters = {"profile": "full", "fields": {"exclude": ["body"]}, "filter": {"field": "format", "negate": True, "value": ["Map"]}}
    df = load(spark, server, paged.SCHEMA, parameters=json.dumps(parameters)).filter(F.col("id").isin(0, 3, 4))
    got = {r.id: json.loads(r.fields) for r in df.collect()}
    assert set(got) == {0, 4} and all("body" not in f and "title" in f for f in got.values())  # 0 has no format, so it is no map
    assert all(r["profile"] == "full" and r["filter"]["conditions"][0] == parameters["filter"] for r in requests(server))


def test_what_a_condition_cannot_say_stays_with_spark(spark, server):
    df = load(spark, server).filter((F.col("views") > 100) & (F.col("title") >= "t5") & ~(F.col("format") == "News"))
    want = {i for i in range(60) if i > 10 and f"t{i}" >= "t5" and i % 5 and i % 3 != 1}
    assert {r.id for r in df.collect()} == want
    assert filters_left(df) and {"field": "views", "value": {"from": 100}} in requests(server)[0]["filter"]["conditions"]
    assert not any(c["field"] == "title" and "value" in c for c in requests(server)[0]["filter"]["conditions"])


def test_times_of_other_zones(spark, server):
    df = load(spark, server, **{"from": "2020-01-16T02:00:00+05:00"})
    first = datetime.datetime(2020, 1, 15, 21, tzinfo=datetime.UTC)
    assert {r.id for r in df.collect()} == {i for i in range(60) if datetime.datetime.fromisoformat(record(i)["fields"]["date"]["changed"]) >= first}


def stream(spark, server, out, **options):
    paged.register(spark)
    df = spark.readStream.format("paged").options(folder=str(server), limit="7", ledger=str(out / "ledger"), **options).load()
    return df.writeStream.format("parquet").option("path", str(out / "rows")).option("checkpointLocation", str(out / "state")).trigger(processingTime="0 seconds")


def until(query, condition):
    import time

    for _ in range(300):
        if condition() or query.exception():
            break
        time.sleep(0.1)
    query.stop()


def test_a_stream_keeps_to_its_quota(spark, server, tmp_path):
    out = tmp_path / "out"
    q = stream(spark, server, out, quota="4").start()
    until(q, lambda: len(requests(server)) >= 4 and q.lastProgress and q.lastProgress["numInputRows"] == 0)
    assert len(requests(server)) == 4 == ledger.read_log(spark, str(out / "ledger")).count()
    rows = spark.read.parquet(str(out / "rows"))
    assert sorted(r.id for r in rows.select("id").collect()) == list(range(25))  # a page begins with the record that the last one ended with
    assert ledger.read_log(spark, str(out / "ledger")).agg(F.sum("count")).first()[0] == 28
    # a restart with more quota goes on where it was
    q = stream(spark, server, out, quota="40").start()
    until(q, lambda: spark.read.parquet(str(out / "rows")).count() >= 60)
    assert sorted(r.id for r in spark.read.parquet(str(out / "rows")).select("id").collect()) == list(range(60))


def test_a_restart_repeats_no_call(server, tmp_path):
    options = {"folder": str(server), "limit": "7", "ledger": str(tmp_path / "l")}
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(paged.SCHEMA)
    s = paged._Stream(options, schema)
    rows, end = s.read(s.initialOffset())
    assert [r[0] for r in rows] == list(range(7)) and len(requests(server)) == 1
    s = paged._Stream(options, schema)  # lost before the commit
    again, end2 = s.read(s.initialOffset())
    assert end2 == end and [r[0] for r in again] == list(range(7))
    assert [r[0] for r in s.readBetweenOffsets(s.initialOffset(), end)] == list(range(7))
    assert len(requests(server)) == 1  # all from the ledger
    _, third = s.read(end)
    s.commit(end)
    assert s.ledger.held(s.initialOffset()) is None and s.ledger.held(end)
    s.commit(third)
    assert s.ledger.held(end) is None and s.ledger.calls_today() == 2


def test_quota_of_a_day(tmp_path):
    day = [datetime.datetime(2024, 1, 1, 23, 59, tzinfo=datetime.UTC)]
    book = ledger.Ledger(str(tmp_path), 1, lambda: day[0])
    assert book.may_call()
    book.enter({"offset": 0}, {"count": 0, "totalCount": 0}, {"changed": "", "id": -1}, [], {"changed": "", "id": -1})
    assert not book.may_call()
    day[0] += datetime.timedelta(minutes=2)
    assert book.may_call()


def shelf(folder):
    return sorted(str(p.relative_to(folder)) for p in folder.rglob("*") if p.is_file() and p.suffix != ".crc")


def lines_of(path):
    return (lzma.decompress(path.read_bytes()) if path.suffix == ".xz" else path.read_bytes()).decode().splitlines()


@pytest.mark.parametrize("suffix", [".txt", ".txt.xz"])
def test_named_files(spark, tmp_path, suffix, monkeypatch):
    monkeypatch.setattr(sink, "BLOCK", 1000)
    df = spark.range(3000).select("id", (F.col("id") % 3).alias("batch"), F.when(F.col("id") != 7, F.concat(F.lit("line é "), "id")).alias("body"), F.lit(0).alias("file_id")).repartition(8)
    want = {f"en.{b}{suffix}": [f"line é {i}" if i != 7 else "" for i in range(b, 3000, 3)] for b in range(3)}
    assert files.write_named_batches(df, str(tmp_path), "en", suffix=suffix, threads=3) == sorted(want)
    assert shelf(tmp_path) == sorted(want) and all(lines_of(tmp_path / n) == ls for n, ls in want.items())
    with pytest.raises(Exception, match="en.0"):  # nothing is overwritten unasked
        files.write_named_batches(df, str(tmp_path), "en", suffix=suffix)
    assert shelf(tmp_path) == sorted(want)
    files.write_named_batches(df.filter("id < 3"), str(tmp_path), "en", suffix=suffix, existing="append")
    assert lines_of(tmp_path / f"en.1{suffix}") == [*want[f"en.1{suffix}"], "line é 1"]
    files.write_named_batches(df.filter("id < 3"), str(tmp_path), "en", suffix=suffix, existing="replace")
    assert lines_of(tmp_path / f"en.1{suffix}") == ["line é 1"]
    if suffix.endswith(".xz"):
        assert subprocess.run(["xz", "-dc", tmp_path / f"en.1{suffix}"], capture_output=True).stdout.decode() in ("line é 1", "")  # where there is an xz
    assert files.write_named_batches(df.limit(0), str(tmp_path), "none", suffix=suffix) == [] and not [n for n in shelf(tmp_path) if n.startswith("none")]


def test_killed_attempts_leave_nothing(spark, tmp_path):
    """A task that dies in the middle of a file: the write fails, or its next attempt succeeds, and no part of it stays."""
    df = spark.range(200).select("id", F.lit("a.txt").alias("file"), F.col("id").cast("string").alias("value"))

    def fail(batches):
        for b in batches:
            yield b.slice(0, 100)
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        sink.write_files(df.repartition(1).mapInArrow(fail, df.schema), str(tmp_path), "file", "value", ["id"])
    assert shelf(tmp_path) == [] and os.listdir(tmp_path) == []
    writer = sink.FilesWriter({"path": str(tmp_path)})
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"file": ["a.txt"] * 3, "value": ["x", "y", "z"]})
    writer.write(iter([batch]))  # an attempt that Spark has given up
    writer.commit([writer.write(iter([batch])), None])
    assert shelf(tmp_path) == ["a.txt"] and os.listdir(tmp_path) == ["a.txt"]
    again = sink.FilesWriter({"path": str(tmp_path), "existing": "replace"})
    with pytest.raises(ValueError, match="several tasks"):
        again.commit([again.write(iter([batch])), again.write(iter([batch]))])
    assert lines_of(tmp_path / "a.txt") == ["x", "y", "z"] and os.listdir(tmp_path) == ["a.txt"]
    with pytest.raises(ValueError, match="without a file name"):
        again.write(iter([pa.RecordBatch.from_pydict({"file": pa.array([None], pa.string()), "value": ["x"]})]))
