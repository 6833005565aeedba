"""Months of several tables under one commit, against the overlay that is written as a whole."""

import re

import pytest

from panelforge.operators import cdc
from panelforge.schemas import TableSpec
from panelforge.sinks.log import Conflict, SnapshotLog
from panelforge.streaming import snapshots
from panelforge.streaming.monthly import empty_overlay
from panelforge.streaming.snapshots import SnapshotMonths

A, B = TableSpec("a", ["k"], ["x", "y"]), TableSpec("b", ["k", "l"], ["z"], {"z": 0})
SPEC = {"a": A, "b": B}


def dumps(spark, a, b):
    return {"a": spark.createDataFrame([(k, *v) for k, v in a.items()], "k int, x int, y string"), "b": spark.createDataFrame([(*k, v) for k, v in b.items()], "k int, l string, z int")}


MONTHS = [
    ({k: (k, "a") for k in range(40)}, {(k, "q"): k for k in range(9)}),
    ({k: (k if k % 5 else None, "a") for k in range(3, 44)}, {(k, "q"): k for k in range(8)}),
    ({k: (k, "b" if k == 7 else "a") for k in range(40)}, {(k, "q"): k for k in range(9)}),
    ({k: (k, "a") for k in range(1, 40)}, {(k, "q"): k for k in range(2, 9)}),
    ({k: (k, "a") for k in range(1, 40)}, {(k, "q"): k + (k == 4) for k in range(2, 9)}),
]


def sorted_rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def whole(spark, months):
    """(overlay, events) of each table by the operators alone."""
    out = {}
    for table, spec in SPEC.items():
        base = months[0][table]
        latest, events = empty_overlay(spark, base.schema, spec), []
        for n, dump in enumerate(months[1:]):
            found = cdc.detect(dump[table], latest, base, spec, f"2023-0{n + 6}")
            events += sorted_rows(found)
            latest = spark.createDataFrame(cdc.apply_events(latest, found, spec).collect(), latest.schema)
        out[table] = (sorted_rows(latest), sorted(events))
    return out


def seen(job):
    return {t: (sorted_rows(job.overlay(t)), sorted_rows(job.ledger(t))) for t in SPEC}


def files(path):
    return {str(x.relative_to(path)): x.stat().st_mtime_ns for x in path.rglob("*.parquet")}


@pytest.mark.parametrize("depth", [2, 99])
def test_months_equal_the_whole_overlay(spark, tmp_path, depth):
    months = [dumps(spark, *m) for m in MONTHS]
    job = SnapshotMonths(spark, f"{tmp_path}/r", SPEC, months[0], buckets=5, depth=depth)
    for n, dump in enumerate(months[1:]):
        assert job.run(dump, f"2023-0{n + 6}") and not job.run(dump, f"2023-0{n + 6}")
    assert seen(job) == whole(spark, months)
    live = job.state("a").where("NOT is_deleted").select("k", "x", "y")
    assert sorted_rows(live) == sorted_rows(months[-1]["a"])
    assert job.counts()["2023-07"] == {"a": (3, 8, 4), "b": (1, 0, 0)} and job.counts()["2023-08"] == {"a": (0, 1, 1), "b": (0, 0, 2)}
    again = SnapshotMonths(spark, f"{tmp_path}/r", SPEC, {}, buckets=77)  # opened anew, the baseline is not needed
    assert again.buckets == 5 and seen(again) == seen(job)
    with pytest.raises(ValueError, match="older"):
        job.run(months[1], "2023-05")
    with pytest.raises(ValueError, match="no rows"):
        job.run({"a": months[1]["a"], "b": months[1]["b"].where("false")}, "2023-12")


def test_bytes_follow_the_events_and_the_state_is_not_shuffled(spark, tmp_path):
    months = [dumps(spark, *m) for m in MONTHS]
    job = SnapshotMonths(spark, f"{tmp_path}/r", SPEC, months[0], buckets=7)
    job.run(months[1], "2023-06")
    before = files(tmp_path / "r" / "a" / "state")
    one = {k: v if k != 11 else (-1, "new") for k, v in MONTHS[1][0].items()}
    job.run(dumps(spark, one, MONTHS[1][1]), "2023-07")
    after = files(tmp_path / "r" / "a" / "state")
    added = [x for x in after if x not in before]
    assert before.items() <= after.items() and len(added) == 1 and spark.read.parquet(f"{tmp_path}/r/a/state/{added[0]}").count() == 1
    now, broadcast = job.snapshot(), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = cdc.changes(months[2]["a"], job._rows("a", now), A, "2023-08")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert len(re.findall(r"\bExchange\b", plan)) == 1 and "Bucketed: true" in plan  # the dump's own


@pytest.mark.parametrize("broken", ["detect", "second table", "delta", "extras", "commit"])
def test_a_reader_sees_all_tables_of_a_month_or_none(spark, tmp_path, monkeypatch, broken):
    months = [dumps(spark, *m) for m in MONTHS]

    def extras(found, month):
        if broken == "extras" and month == "2023-07" and not mended:
            raise RuntimeError("lost")
        return {"large": found["a"].where("x > 20").select("k")}

    mended = []
    job = SnapshotMonths(spark, f"{tmp_path}/r", SPEC, months[0], extras=extras, buckets=3, depth=2)
    job.run(months[1], "2023-06")
    before = seen(job), sorted_rows(job.extra("large"))
    calls = []

    def crash(*args, **kwargs):
        calls.append(1)
        if broken == "second table" and len(calls) == 1:
            return real(*args, **kwargs)
        raise RuntimeError("lost")

    real = snapshots.changes
    with monkeypatch.context() as m:
        if broken in ("detect", "second table"):
            m.setattr(snapshots, "changes", crash)
        elif broken != "extras":
            m.setattr(*{"delta": (SnapshotMonths, "_write"), "commit": (SnapshotLog, "commit")}[broken], crash)
        with pytest.raises(RuntimeError, match="lost"):
            job.run(months[2], "2023-07")
    assert (seen(job), sorted_rows(job.extra("large"))) == before and list(job.counts()) == ["2023-06"]
    mended.append(1)
    assert job.run(months[2], "2023-07")
    assert seen(job) == whole(spark, months[:3])
    old, now = job.log.numbers()[-2], seen(job)
    june = sorted_rows(job.state("a", 2))
    assert old >= 2 and job.vacuum(keep=1) and job.vacuum(keep=1) == []
    assert seen(job) == now and june != sorted_rows(job.state("a"))
    with pytest.raises(LookupError, match="snapshot 2"):
        job.state("a", 2)
    assert job.extra("large").groupBy("reference_month").count().count() == 2


def test_the_later_of_two_writers_gets_a_conflict(spark, tmp_path):
    months = [dumps(spark, *m) for m in MONTHS]
    one = SnapshotMonths(spark, f"{tmp_path}/r", SPEC, months[0], buckets=3)
    two = SnapshotMonths(spark, f"{tmp_path}/r", SPEC, {}, buckets=3, extras=lambda *_: one.run(months[1], "2023-06") and {} or {})
    with pytest.raises(Conflict):  # the other one commits while it is under way
        two.run(months[2], "2023-06")
    assert seen(one) == whole(spark, months[:2])
    two.extras = None
    assert not two.run(months[2], "2023-06") and two.run(months[2], "2023-07")
    assert seen(one) == whole(spark, months[:3])


def test_log_numbers_and_whole_commits(spark, tmp_path):
    log = SnapshotLog(spark, f"{tmp_path}/log")
    assert log.read() == (0, {}) and log.commit(0, {"v": "é"}) == 1 and log.commit(1, {"v": 2}) == 2
    with pytest.raises(Conflict):
        log.commit(1, {"v": 3})
    assert log.read() == (2, {"v": 2}) and log.read(1) == (1, {"v": "é"})
    (tmp_path / "log" / "pending").mkdir(exist_ok=True)
    (tmp_path / "log" / "pending" / "x").write_text("{")
    assert log.forget(1) == [1] and log.numbers() == [2] and not (tmp_path / "log" / "pending").exists()
