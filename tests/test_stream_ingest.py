"""Stream ingest: decoding, bad records, restart from checkpoint; file ingest."""

from __future__ import annotations

import os

from gatewise.sources import tables as tb
from gatewise.streaming import ingest as si


def _write(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_stream_bad_records_and_restart(spark, tmp_path):
    src = str(tmp_path / "src")
    tables = si.StreamTables(table=str(tmp_path / "table"), checkpoint=str(tmp_path / "ckpt"))
    _write(src, "a.json", ['{"date_time": "2024-01-02 10:00:00", "ID": 1}',
                           '{"date_time": "not a time", "ID": 2}',
                           'this is not json'])
    q = si.start_ingest(si.file_source(spark, src), tables)
    q.awaitTermination()
    got = {r.ID: (str(r.date_time), r.time_was_defaulted) for r in si.read_table(spark, tables.table).collect()}
    assert got[1] == ("2024-01-02 10:00:00", False)
    assert got[2][1] is True                     # unparsable time -> load time, flagged
    assert [r.value for r in si.read_rejects(spark, tables.table).collect()] == ["this is not json"]
    # restart from the checkpoint: only the new file is read
    _write(src, "b.json", ['{"date_time": "2024-01-02 11:00:00", "ID": 3}'])
    q = si.start_ingest(si.file_source(spark, src), tables)
    q.awaitTermination()
    table = si.read_table(spark, tables.table)
    assert sorted(r.ID for r in table.collect()) == [1, 2, 3]
    assert si.row_count(table).first().row_count == 3
    assert [r.ID for r in si.latest_n(table, 2).collect()] == [3, 2]


def test_string_ingest_and_audit(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", None), (2, None, 3.5)], "k int, s string, x double")
    path = str(tmp_path / "sheet")
    tb.export_csv(df, path)
    stored = tb.string_ingest(spark, path)
    assert all(t == "string" for _, t in stored.dtypes)
    assert sorted(tuple(r) for r in stored.collect()) == [("1", "a", ""), ("2", "", "3.5")]
    audit = tb.ingest_audit(df, stored).first()
    assert (audit.source_rows, audit.stored_rows, audit.complete) == (2, 2, True)


def test_write_slices_replaces_only_present_slices(spark, tmp_path):
    path = str(tmp_path / "t")
    a = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "d string, v int")
    tb.write_slices(a, path, "d", add_batch_time=False)
    b = spark.createDataFrame([("2024-01-02", 20)], "d string, v int")
    tb.write_slices(b, path, "d", add_batch_time=False)
    tb.write_slices(b, path, "d", add_batch_time=False)   # rerun leaves it unchanged
    got = sorted((str(r.d), r.v) for r in spark.read.parquet(path).collect())
    assert got == [("2024-01-01", 1), ("2024-01-02", 20)]


def test_replayed_batch_replaces_itself(spark, tmp_path):
    """A batch re-run after a failure (no commit marker) overwrites its own partition."""
    src = str(tmp_path / "src")
    tables = si.StreamTables(table=str(tmp_path / "table"), checkpoint=str(tmp_path / "ckpt"))
    _write(src, "a.json", [f'{{"date_time": "2024-01-02 10:00:0{i}", "ID": {i}}}' for i in range(5)])
    si.start_ingest(si.file_source(spark, src), tables).awaitTermination()
    commits = os.path.join(tables.checkpoint, "commits")
    last = sorted((n for n in os.listdir(commits) if not n.startswith(".")), key=lambda n: (len(n), n))[-1]
    os.remove(os.path.join(commits, last))            # as if the process died after writing
    crc = os.path.join(commits, f".{last}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    si.start_ingest(si.file_source(spark, src), tables).awaitTermination()
    assert os.path.exists(os.path.join(commits, last))   # the batch really ran again
    assert si.row_count(si.read_table(spark, tables.table)).first().row_count == 5


def test_records_round_trip_through_decoder(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 10, 0, 5), 42)], "date_time timestamp_ntz, ID long")
    recs = si.to_records(df, key="ID")
    row = recs.first()
    assert row.key == "42" and row.value == '{"date_time":"2024-01-02 10:00:05","ID":42}'
    back = si.decode(recs.select("value")).first()
    assert (back.date_time, back.ID, back.time_was_defaulted, back._bad) == (dt.datetime(2024, 1, 2, 10, 0, 5), 42,
                                                                              False, False)


def test_listener_totals_match_progress(spark, tmp_path):
    src = str(tmp_path / "src")
    for i in range(3):
        _write(src, f"f{i}.json", [f'{{"date_time": "2024-01-02 10:00:0{j}", "ID": {10 * i + j}}}' for j in range(4)])
    tables = si.StreamTables(table=str(tmp_path / "table"), checkpoint=str(tmp_path / "ckpt"))
    totals = si.ProgressTotals()
    spark.streams.addListener(totals)
    try:
        q = si.start_ingest(si.file_source(spark, src, max_files_per_trigger=1), tables)
        q.awaitTermination()
        batches = totals.of(q)
    finally:
        spark.streams.removeListener(totals)
    stats = si.stream_stats(batches, si.read_counts(spark, tables.table), si.read_table(spark, tables.table)).first()
    assert tuple(stats) == (3, 12, 12, 12)
    assert si.rate_report(batches).startswith("12 rows in 3 batches")


def test_written_and_stored_rows_can_differ(spark, tmp_path):
    src = str(tmp_path / "src")
    _write(src, "a.json", ['{"date_time": "2024-01-02 10:00:00", "ID": 1}', "not json"])
    tables = si.StreamTables(table=str(tmp_path / "table"), checkpoint=str(tmp_path / "ckpt"))
    si.start_ingest(si.file_source(spark, src), tables).awaitTermination()
    stats = si.stream_stats({0: (2, 0.1)}, si.read_counts(spark, tables.table), si.read_table(spark, tables.table)).first()
    assert (stats.consumed_rows, stats.written_rows, stats.stored_rows) == (2, 2, 1)


def test_latest_rows_with_equal_ids(spark):
    import datetime as dt
    rows = [(dt.datetime(2024, 1, 2, h), 7, False) for h in (3, 1, 2)]
    table = spark.createDataFrame(rows, "date_time timestamp_ntz, ID long, time_was_defaulted boolean")
    assert [r.date_time.hour for r in si.latest_n(table, 2).collect()] == [3, 2]


def test_csv_gives_every_text_back(spark, tmp_path):
    texts = ["  a b  ", "x\ny", 'say "hi"', "back\\slash", "a,b", "r\r\nn", "\ttab", "plain", "'"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, s string")
    path = str(tmp_path / "sheet")
    tb.export_csv(df, path)
    stored = tb.string_ingest(spark, path)
    assert sorted((int(r.k), r.s) for r in stored.collect()) == list(enumerate(texts))
    assert tb.ingest_audit(df, stored).first().complete
    assert [r.k for r in tb.ingest_preview(stored, 2).collect()] == ["0", "1"]


def test_replaced_slices_without_rows_are_removed(spark, tmp_path):
    path = str(tmp_path / "t")
    full = spark.createDataFrame([("a:1", 1), ("b", 2), ("c", 3)], "d string, v int")
    tb.replace_slices(full, path, "d", add_batch_time=False)
    some = spark.createDataFrame([("b", 20)], "d string, v int")
    tb.replace_slices(some, path, "d", ["a:1", "b", "never"], add_batch_time=False)
    read = lambda: sorted((r.d, r.v) for r in spark.read.schema("v int, d string").parquet(path).collect())
    assert read() == [("b", 20), ("c", 3)]
    tb.replace_slices(some.where("false"), path, "d", ["c"], add_batch_time=False)
    assert read() == [("b", 20)]
    tb.replace_slices(full.where("v = 3"), path, "d", add_batch_time=False)   # no names: the whole table
    assert read() == [("c", 3)]


def test_stamp_follows_the_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    one = tb.input_stamp(spark, path)
    assert one == tb.input_stamp(spark, path)
    spark.range(6).write.mode("overwrite").parquet(path)
    assert tb.input_stamp(spark, path) != one


def test_a_cluster_needs_a_shared_folder(spark):
    import pytest
    from gatewise.session import checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

    class Session:
        conf, sparkContext = {}, Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_topic_records_of_a_key_are_in_order(spark):
    import datetime as dt
    import json
    import random
    rows = [(k, dt.datetime(2024, 1, 2, 10, 0, s), f"{k}-{s}-{i}") for k in (1, 2, 3) for s in range(20) for i in range(2)]
    rows += [(None, dt.datetime(2024, 1, 2, 9), "z"), (None, None, "y")]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "ID long, date_time timestamp_ntz, note string").repartition(7)
    recs = si.to_records(df, key="ID", order=["date_time"])
    tasks = recs.rdd.glom().collect()                      # what each task sends, in its order
    seen = {}
    for task in tasks:
        for r in task:
            seen.setdefault(r.key, []).append(json.loads(r.value))
    assert sum(len(x) for x in seen.values()) == len(rows)
    for key, values in seen.items():
        assert [v["seq"] for v in values] == list(range(len(values)))
        assert [(v.get("date_time") or "", v["note"]) for v in values] == sorted(
            (v.get("date_time") or "", v["note"]) for v in values)
        assert sum(any(r.key == key for r in task) for task in tasks) == 1   # one task has all of a key
    import pytest
    with pytest.raises(ValueError, match="key"):
        si.to_records(df, order=["date_time"])


def test_reports_while_a_stream_runs(spark, tmp_path):
    src = str(tmp_path / "src")
    for i in range(4):
        _write(src, f"f{i}.json", [f'{{"date_time": "2024-01-02 10:00:0{j}", "ID": {10 * i + j}}}' for j in range(3)])
    tables = si.StreamTables(table=str(tmp_path / "table"), checkpoint=str(tmp_path / "ckpt"))
    told = []
    totals = si.ProgressTotals(every=0.0, tell=lambda run, report: told.append((run, report)))
    spark.streams.addListener(totals)
    try:
        q = si.start_ingest(si.file_source(spark, src, max_files_per_trigger=1), tables)
        q.awaitTermination()
        reports = totals.reports(q)
    finally:
        spark.streams.removeListener(totals)
    assert len(reports) >= 4 and [r for run, r in told if run == str(q.runId)] == reports
    rows = [r.consumed_rows for r in reports]
    assert rows == sorted(rows) and rows[0] < rows[-1] == 12
    assert reports[-1].batches == len(totals.of(q)) == 4
    assert reports[-1].rows_per_second == 12 / reports[-1].elapsed_seconds


def test_reports_wait_until_they_are_due():
    from types import SimpleNamespace as Event
    now = [0.0]
    totals = si.ProgressTotals(every=10.0, clock=lambda: now[0])
    totals.onQueryStarted(Event(runId="r"))
    for batch in range(25):                       # a batch a second
        now[0] += 1
        totals.onQueryProgress(Event(progress=Event(runId="r", batchId=batch, numInputRows=2, processedRowsPerSecond=2.0)))
    now[0] += 8
    totals.onQueryIdle(Event(runId="r"))
    totals.onQueryTerminated(Event(runId="r"))
    assert [(r.elapsed_seconds, r.consumed_rows) for r in totals.told["r"]] == [(10, 20), (20, 40), (33, 50), (33, 50)]


def test_a_listener_that_came_late_says_so(spark, monkeypatch):
    import pytest
    from types import SimpleNamespace
    totals = si.ProgressTotals()
    ended = SimpleNamespace(runId="other", isActive=False)
    with pytest.raises(RuntimeError, match="listener"):
        totals._await(ended, seconds=0.2)


def _batch(spark, n):
    import datetime as dt
    rows = [(dt.datetime(2024, 1, 2, 10, 0, n % 60), 10 * n + i, False, None, "good") for i in range(2)]
    return spark.createDataFrame([*rows, (dt.datetime(2024, 1, 2), None, True, f"bad {n}", "bad")],
                                 "date_time timestamp_ntz, ID long, time_was_defaulted boolean, raw string, kind string")


def _held(spark, path):
    return sorted((r.batch_id, r.ID, r.raw) for r in si.sink_table(spark, path).read()
                  .selectExpr("batch_id", "coalesce(ID, -1) as ID", "raw").collect())


def test_small_batches_are_merged(spark, tmp_path):
    path = str(tmp_path / "table")
    blocks = []
    for n in range(19):
        si.append_batch(_batch(spark, n), n, path, fanout=3, levels=2)
        blocks.append(si.sink_table(spark, path).live().count())
    want = sorted([(n, 10 * n + i, None) for n in range(19) for i in range(2)] + [(n, -1, f"bad {n}") for n in range(19)])
    assert _held(spark, path) == want
    assert max(blocks) <= 3 * 2 + 2 and blocks[-1] == 3            # 0-8, 9-17 and the newest
    assert sorted(r.slice for r in si.sink_table(spark, path).live().collect()) == [0, 9, 18]
    versions = [x for x in os.listdir(os.path.join(path, "data")) if x.startswith("version=")]
    claims = [x for f in ("data", "commits") for x in os.listdir(os.path.join(path, f)) if x.startswith(".claim-")]
    # 19 batches and 6 merges made 25 versions; those that no kept commit names are gone, and old claims with them
    assert len(versions) <= 14 and len(claims) <= 4
    si.append_batch(_batch(spark, 18), 18, path, fanout=3, levels=2)   # the newest comes again
    assert _held(spark, path) == want
    assert si.read_counts(spark, path).where("rows = 3").count() == 19
    assert si.read_rejects(spark, path).count() == 19 and si.read_table(spark, path).count() == 38


def test_a_merge_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    import pytest
    path = str(tmp_path / "table")
    for n in range(3):
        si.append_batch(_batch(spark, n), n, path, fanout=3)
    real, calls = si.SliceTable._publish, []

    def dies(self, *args, **kw):
        calls.append(1)
        if len(calls) == 2:                # batch 3 is committed, its merge is not
            raise RuntimeError("lost")
        return real(self, *args, **kw)

    monkeypatch.setattr(si.SliceTable, "_publish", dies)
    with pytest.raises(RuntimeError, match="lost"):
        si.append_batch(_batch(spark, 3), 3, path, fanout=3)
    monkeypatch.undo()
    before = _held(spark, path)
    assert sorted({b for b, _, _ in before}) == [0, 1, 2, 3] and len(before) == 12
    si.append_batch(_batch(spark, 3), 3, path, fanout=3)           # the stream sends it again
    assert _held(spark, path) == before
    assert sorted(r.slice for r in si.sink_table(spark, path).live().collect()) == [0, 3]


def test_an_empty_batch(spark, tmp_path):
    path = str(tmp_path / "table")
    si.append_batch(_batch(spark, 0).where("false"), 0, path)
    si.append_batch(_batch(spark, 1), 1, path)
    assert _held(spark, path) == [(1, -1, "bad 1"), (1, 10, None), (1, 11, None)]
