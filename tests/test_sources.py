import pytest
from pyspark.sql import functions as F

from leafmill.sources import files
from leafmill.streaming import logs


def test_manifest_with_half_written_tail(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('{"source_path":"a.pdf","page_index":1,"window":[0,1]}\n{"source_path":"b.pdf"}\n{"source_path":"c.p')
    rows, broken = files.read_manifest(spark, str(tmp_path / "m.jsonl"))
    assert sorted(r.source_path for r in rows.collect()) == ["a.pdf", "b.pdf"] and broken.count() == 1


def test_delimited_and_listing(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("a\tb\n1\tx\n2\ty\n")
    assert [tuple(r) for r in files.read_table(spark, str(tmp_path / "t.tsv"), "a int, b string").collect()] == [(1, "x"), (2, "y")]
    folder = tmp_path / "f" / "sub"
    folder.mkdir(parents=True)
    (folder / "1.bin").write_bytes(b"abc")
    (folder / "2.bin").write_bytes(b"abc")
    first = files.listing(spark, str(tmp_path / "f"))
    assert {r.key for r in first.collect()} == {"ba7816bf8f01"} and first.count() == 2
    (folder / "3.bin").write_bytes(b"x")
    again = files.listing(spark, str(tmp_path / "f"), first)
    assert [r.path.rsplit("/", 1)[1] for r in again.collect()] == ["3.bin"]


def test_ragged_round_trip(spark):
    rows = [(2, 0, [1, 2]), (1, 1, []), (1, 0, [2, 2, 1])]
    df = spark.createDataFrame(rows, "doc int, page int, cls array<int>").withColumn("shard", F.lit(0))
    shards = files.rows_to_ragged(df, ["shard"])
    assert sorted((r.doc, r.page, r.cls) for r in files.ragged_to_rows(shards).collect()) == sorted(rows)
    assert sorted((r.doc, r.page, r.hits, r.n) for r in files.class_counts(shards, 2).collect()) == [(1, 0, 2, 3), (1, 1, 0, 0), (2, 0, 1, 2)]


def test_versions_swap_and_keep_one_backup(spark, tmp_path):
    v = files.Versions(spark, str(tmp_path / "v"))
    assert v.read() is None
    for n in (1, 2, 3):
        v.write(spark.range(n))
    assert v.read().count() == 3 and len(list((tmp_path / "v").glob("v*"))) == 2


def test_plan_guard(spark, tmp_path):
    path = str(tmp_path / "run")
    files.guard_plan(spark, path, {"n": 5, "seed": 1})
    files.guard_plan(spark, path, {"seed": 1, "n": 5})
    with pytest.raises(ValueError):
        files.guard_plan(spark, path, {"n": 6, "seed": 1})


def test_payload_errors_are_data(spark):
    def payload(row):
        return bytes([10 // row["x"]])

    got = {r.id: (r.value, r.error) for r in files.apply_payload(spark.createDataFrame([(1, 5), (2, 0)], "id int, x int"), ["x"], payload, "id").collect()}
    assert bytes(got[1][0]) == b"\x02" and got[2][1].startswith("ZeroDivisionError")


def test_stream_resumes_and_latest_wins(spark, tmp_path):
    log, versions = tmp_path / "log", files.Versions(spark, str(tmp_path / "v"))
    log.mkdir()
    run = lambda: logs.keep_latest(logs.append_log(spark, str(log), "k int, v string, t int"), versions, ["k"], "t", str(tmp_path / "c")).awaitTermination()
    (log / "1.json").write_text('{"k":1,"v":"a","t":1}\n{"k":2,"v":"b","t":1}\n')
    run()
    (log / "2.json").write_text('{"k":1,"v":"c","t":2}\n{"k":2,"v":"old","t":0}\n')
    run()
    run()
    assert sorted((r.k, r.v) for r in versions.read().collect()) == [(1, "c"), (2, "b")]
    assert logs.event_windows(spark.createDataFrame([(1.0, "2024-01-01 00:00:01")], "value double, ts string"), "ts", "1 hour", "10 minutes", []).count() == 1
