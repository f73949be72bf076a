"""Streams over recorded files agree with their batch twins."""

from __future__ import annotations

import json

from attesta.streaming import discovery


def write(folder, n, rows):
    (folder / f"{n}.json").write_text("\n".join(json.dumps(dict(zip(("run_id", "record_id", "page", "payload", "observed_at"), r, strict=True))) for r in rows))


PAGES = [
    [("r", "a", 1, "p1", "2026-01-01T00:00:00Z"), ("r", "b", 1, "p2", "2026-01-01T00:00:10Z")],
    [("r", "a", 2, "p1", "2026-01-01T00:01:00Z"), ("r", "c", 2, "p3", "2026-01-01T00:01:10Z")],
    [("r", "b", 3, "new", "2026-01-01T00:02:00Z")],
]


def test_discovery(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    for i, rows in enumerate(PAGES):
        write(src, i, rows)
    stream = discovery.observations(spark, str(src), 1)
    q = discovery.commit(discovery.discover(stream), str(out), str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    rows = spark.read.parquet(str(out)).collect()
    final = {}
    for r in sorted(rows, key=lambda r: r.batch):
        if final.get(r.record_id) != "changed":
            final[r.record_id] = r.verdict
    batch = spark.read.schema(discovery.OBSERVATION).json(str(src))
    assert final == {r.record_id: r.verdict for r in discovery.verdicts(batch).collect()} == {"a": "duplicate", "b": "changed", "c": "new"}


def test_first_seen_and_replay(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    write(src, 0, PAGES[0])
    go = lambda: discovery.commit(discovery.first_seen(discovery.observations(spark, str(src))), str(out), str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination(120)
    go()
    write(src, 1, PAGES[1])
    go()
    assert sorted(r.record_id for r in spark.read.parquet(str(out)).collect()) == ["a", "b", "c"]


def test_leases_in_batch(spark):
    rows = [("j", "beat", f"2026-01-01T00:0{m}:00Z") for m in (0, 2, 4)] + [("j", "beat", "2026-01-01T01:00:00Z")]
    df = spark.createDataFrame(rows, "job_id string, event string, t string").selectExpr("job_id", "event", "to_timestamp(t) as at")
    assert sorted(r.beats for r in discovery.leases(df).collect()) == [1, 3]
