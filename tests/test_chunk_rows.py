import pyarrow as pa

from threadloom.functions import chunking


def test_rows_are_cut_a_slice_at_a_time(monkeypatch):
    monkeypatch.setattr(chunking, "SLICE", 100)
    texts = ["One. " * 30, None, "", "Two two. " * 3, "x" * 95, "Three. " * 40, "é."]
    batch = pa.RecordBatch.from_pydict({"id": list(range(7)), "text": pa.array(texts, pa.string()), "labels": [["a", None]] * 7})
    out = list(chunking.chunker(50, 10)(iter([batch, batch.slice(0, 0)])))
    want = [(k, ["a", None], nth, p["text"], p["start"], p["source_end"]) for k, t in enumerate(texts) for nth, p in enumerate(chunking.cut(t or "", 50, 10))]
    got = [(r["id"], r["labels"], r["nth"], r["text"], r["start"], r["source_end"]) for b in out for r in b.to_pylist()]
    assert got == want
    source = [sum(len((texts[k] or "").encode()) for k in set(b.column("id").to_pylist())) for b in out]
    assert len(out) > 3 and all(s <= 100 or len(set(b.column("id").to_pylist())) == 1 for s, b in zip(source, out))


def test_stats_take_no_whole_table_to_python(spark):
    """The counts come from the same streamed rows: each person's chunks, one for a bot's text, none for blank ones."""
    from threadloom import schemas
    from threadloom.operators import flatten

    said = ["One. " * 900, "  ", "bot text. " * 900, "short"]
    names = spark.createDataFrame([], schemas.ARTIFACTS).columns
    rows = [{c: None for c in names} | {"artifact_id": f"a{k}", "issue_number": k, "text": t, "is_bot": t.startswith("bot")} for k, t in enumerate(said)]
    a = spark.createDataFrame(rows, schemas.ARTIFACTS)
    pieces = flatten.chunks(a)
    plan = pieces._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan
    n = sum(len(chunking.cut(t.strip(), 2000, 200)) for t in (said[0], said[3]))
    assert flatten.chunk_stats(a, pieces).first().asDict() == {"total": n + 1, "bots": 1, "skipped": 1}
