import json

import pytest
from pyspark.sql import functions as F

from threadloom.sources import files
from threadloom.sources.rest_issues import IssueReader, IssueSource, fetch, fetch_pages
from threadloom.streaming.incremental import ClaimState, finished, new_artifacts, partial_state


class Reply:
    def __init__(self, body):
        self.body = json.dumps(body).encode()

    def read(self):
        return self.body

    def __enter__(self):
        return self

    def __exit__(self, *x):
        pass


def test_fetch_waits_out_a_limit():
    import urllib.error

    calls, slept = [], []

    def opener(request, timeout):
        calls.append(request.full_url)
        if len(calls) == 1:
            raise urllib.error.HTTPError("u", 429, "slow", {"X-RateLimit-Reset": "0"}, None)
        return Reply([1])

    assert fetch("http://x", {"a": 1}, opener=opener, sleep=slept.append) == [1]
    assert slept == [1.0] and calls[0] == "http://x?a=1"

    def broken(request, timeout):
        raise urllib.error.HTTPError("u", 500, "no", {}, None)

    with pytest.raises(urllib.error.HTTPError):
        fetch("http://x", {}, opener=broken)


def test_pages_and_partitions():
    pages = {1: [1, 2], 2: [3]}
    assert fetch_pages("u", lambda u, p: pages[p["page"]], size=2) == [1, 2, 3]
    assert [p.value for p in IssueReader({"repo": "o/r", "limit": "250"}).partitions()] == [(1, 100), (2, 100), (3, 50)]
    assert IssueSource.name() == "rest_issues"


def test_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": "x", "type": "t"}, {"id": "y"}]')
    assert files.read_json_array(spark, str(tmp_path / "a.json"), "id string, type string").count() == 2
    assert files.read_optional(spark, str(tmp_path / "none.json"), "id string").count() == 0
    p = spark.createDataFrame([("t", "c", 0.5), ("u", "c", 0.5)], "term string, chunk_id string, weight double")
    files.write_postings(p, str(tmp_path / "p"), 4)
    assert files.read_postings(spark, str(tmp_path / "p")).count() == 2
    rows = spark.createDataFrame([(k, None if k else "x") for k in range(50, -1, -1)], "id int, a string").repartition(3)
    files.write_json_array(rows, str(tmp_path / "out.json"), "id", sort_keys=True)
    got = json.loads((tmp_path / "out.json").read_text())
    assert [r["id"] for r in got] == list(range(51)) and list(got[1]) == ["a", "id"] and got[1]["a"] is None
    files.write_json_array(rows.where("false"), str(tmp_path / "out.json"))
    assert json.loads((tmp_path / "out.json").read_text()) == []
    files.write_html("<p>", spark, str(tmp_path / "x.html"))
    assert (tmp_path / "x.html").read_text() == "<p>"


def test_stream_equals_batch(spark, tmp_path):
    rows = [("A", "uses", "B", 0.5 + k / 20, f"2024-01-{k + 1:02}") for k in range(6)] + [("b", "fixes", "c", 1.0, None)]
    schema = "subject string, relation string, object string, confidence double, timestamp string"
    for k in range(0, 7, 3):
        spark.createDataFrame(rows[k : k + 3], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    state = ClaimState(spark, str(tmp_path / "state"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = stream.writeStream.foreachBatch(state.merge).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    got = {tuple(r) for r in finished(state.read()).collect()}
    assert got == {tuple(r) for r in finished(partial_state(spark.createDataFrame(rows, schema))).collect()}
    state.merge(spark.createDataFrame(rows[6:], schema), 2)  # the last batch once more
    assert {tuple(r) for r in finished(state.read()).collect()} == got
    state.merge(spark.createDataFrame(rows[:1], schema), 3)
    state.merge(spark.createDataFrame(rows[:1], schema), 4)
    assert sorted(r.n for r in state.read().collect()) == [1, 8]
    assert sorted(len(c) for c in state._copies().values()) == [1, 2]  # the other bucket was not written again


def test_artifacts_once(spark, tmp_path):
    rows = [("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 01:00:00"), ("b", "2024-01-01 02:00:00")]
    spark.createDataFrame(rows, "artifact_id string, t string").select("artifact_id", F.col("t").cast("timestamp").alias("updated_at")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("artifact_id string, updated_at timestamp").parquet(str(tmp_path / "in"))
    query = new_artifacts(stream).writeStream.format("memory").queryName("once").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "ck")).start()
    query.awaitTermination(120)
    assert sorted(r.artifact_id for r in spark.sql("select * from once").collect()) == ["a", "b"]
