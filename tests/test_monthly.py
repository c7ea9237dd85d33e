"""The monthly run end to end, its audit, reruns, backfills and reports."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rategauge.plans import (
    BaseMoved,
    MonthlyRun,
    Store,
    csv_reports,
    export_csv,
    manifest,
    monthly,
    run_month,
    run_months,
    run_reports,
)
from rategauge.plans.scratch import SETTING, shared_folder
from rategauge.roles import Roles
from tests.helpers import ordered, plan, rows

HEADER = "id,neighbourhood_cleansed,price,last_scraped,host\n"


def source(folder, month, lines):
    path = folder / f"listings_{month}.csv"
    path.write_text(HEADER + "".join(f"{line},h\n" for line in lines))
    return str(path)


def january(folder):
    return source(folder, "2025-01", [
        "1,Soho,$100.00,2025-01-03", "2,Soho,$300.00,2025-01-03", "3,Camden,$50.00,2025-01-04",
        "4,Camden,N/A,2025-01-04", "5,,$50.00,2025-01-04", "6,Soho,-$5.00,2025-01-04",
        "7,Soho,$70.00,2025-02-01",
    ])


def run(path, root, month="2025-01", **options):
    return MonthlyRun(month, path, str(root), "batch_1", "adhoc", **options)


def test_tables_of_a_run(spark, tmp_path):
    store = run_month(spark, run(january(tmp_path), tmp_path / "out", top_k=1))
    averages = store.averages()
    assert rows(averages, "year_month", "neighbourhood_cleansed", "listing_count", F.col("avg_price").cast("string")) == [
        ("2025-01", "Camden", 1, "50.00"), ("2025-01", "Soho", 2, "200.00"), ("2025-02", "Soho", 1, "70.00")]
    errors = store.classified("rejected")
    assert rows(errors, "id", "reject_reason", "source_file", "run_type") == [
        ("4", "bad_price", "listings_2025-01.csv", "adhoc"),
        ("5", "missing_group", "listings_2025-01.csv", "adhoc"),
        ("6", "negative_price", "listings_2025-01.csv", "adhoc")]
    assert rows(store.ranked("over"), "id") == [("2",), ("3",), ("7",)]
    assert rows(store.ranked("under"), "id") == [("1",), ("3",), ("7",)]
    stamps = {
        r[0]
        for df in (averages, errors, store.ranked("over"))
        for r in df.select("processing_timestamp").collect()
    }
    assert len(stamps) == 1
    audit = store.audit()
    assert rows(audit, "year_month", "status", "rows_read", "rows_accepted", "rows_rejected", "bad_price") == [
        ("2025-01", "SUCCESS", 6, 3, 3, 1), ("2025-02", "SUCCESS", 1, 1, 0, 0)]


def snapshot(store):
    drop = "processing_timestamp"
    return [
        rows(store.averages().drop(drop)),
        rows(store.classified().drop(drop)),
        *(rows(store.ranked(s).drop(drop)) for s in ("over", "under")),
    ]


def test_rerun_changes_nothing_but_the_audit(spark, tmp_path):
    one = run(january(tmp_path), tmp_path / "out")
    before = snapshot(run_month(spark, one))
    store = run_month(spark, one)
    assert snapshot(store) == before
    assert store.audit().count() == 4


def test_rerun_with_other_data_leaves_no_old_rows(spark, tmp_path):
    store = run_month(spark, run(january(tmp_path), tmp_path / "out"))
    worse = source(tmp_path, "2025-01", ["9,Soho,N/A,2025-01-03"])
    store = run_month(spark, run(worse, tmp_path / "out"))
    averages, classified, over, under = snapshot(store)
    assert averages == over == under == []
    assert [(r[0], r[6]) for r in classified] == [("9", "bad_price")]


def test_backfill_keeps_other_months(spark, tmp_path):
    january(tmp_path)
    source(tmp_path, "2025-02", ["21,Soho,$10.00,2025-02-03"])
    root = str(tmp_path / "out")
    store = run_months(spark, ["2025-01", "2025-02"], str(tmp_path), root, "batch_2")
    got = ("year_month", "neighbourhood_cleansed", "listing_count", F.col("avg_price").cast("string"))
    want = [("2025-01", "Camden", 1, "50.00"), ("2025-01", "Soho", 2, "200.00"), ("2025-02", "Soho", 2, "40.00")]
    assert rows(store.averages(), *got) == want
    store = run_months(spark, ["2025-02"], str(tmp_path), root, "batch_3")
    assert rows(store.averages(), *got) == want
    reports = run_reports(spark, root, "2025-02", "soho")
    assert rows(reports.over, "id", "rank") == [("21", 2), ("7", 1)]
    for report in (reports.average, reports.over):
        text = plan(report)
        assert "PartitionFilters: [isnotnull(year_month" in text or "year_month#" in text.split("PartitionFilters: [")[1].split("]")[0]
    source(tmp_path, "2025-01", ["1,Soho,$100.00,2025-01-03"])  # its February record is gone
    store = run_months(spark, ["2025-01"], str(tmp_path), root, "batch_4")
    assert rows(store.averages(), *got) == [("2025-01", "Soho", 1, "100.00"), ("2025-02", "Soho", 1, "10.00")]


@pytest.mark.parametrize("problem, kind", [("missing", FileNotFoundError), ("empty", ValueError)])
def test_failure_is_audited_and_raised(spark, tmp_path, problem, kind):
    root = tmp_path / "out"
    store = run_month(spark, run(january(tmp_path), root))
    before = snapshot(store)
    path = source(tmp_path, "2025-09", []) if problem == "empty" else str(tmp_path / "none.csv")
    with pytest.raises(kind):
        run_month(spark, run(path, root, "2025-09"))
    store = Store.open(spark, root)
    failed = store.audit().filter("status = 'FAILED'").collect()
    assert len(failed) == 1 and failed[0].message.startswith(kind.__name__) and failed[0].rows_read is None
    assert snapshot(store) == before


def test_failing_audit_does_not_hide_the_failure(spark, tmp_path):
    blocker = tmp_path / "file"
    blocker.write_text("not a directory")
    with pytest.raises(RuntimeError, match="failed to write") as caught:
        run_month(spark, run(january(tmp_path), f"{blocker}/out"))
    assert any("audit" in note for note in caught.value.__notes__)


def test_reports(spark, tmp_path, capsys):
    root = run_month(spark, run(january(tmp_path), tmp_path / "out")).root
    reports = run_reports(spark, root, "2025-01", "soho", 1)
    assert rows(reports.average, "neighbourhood_cleansed") == [("Soho",)]
    assert rows(reports.over, "id", "rank") == [("2", 1)]
    assert rows(reports.under, "id", "rank") == [("1", 1)]
    everything = run_reports(spark, root)
    assert everything.average.count() == 3 and everything.over.count() == 4
    everything.show()
    assert "Camden" in capsys.readouterr().out


class FakeSession:
    """Settings and context of a session, without one."""

    def __init__(self, setting=None, context_folder=None, master="local[4]"):
        self.setting, self.folder, self.master = setting, context_folder, master
        self.conf = self.sparkContext = self

    def get(self, key, default):
        assert key == SETTING
        return self.setting or default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shared_folder_is_the_one_the_cluster_names(spark):
    cluster = FakeSession("hdfs://shared/ckpt/", "hdfs://other", "yarn")
    assert shared_folder(cluster) == "hdfs://shared/ckpt"
    assert shared_folder(FakeSession(None, "hdfs://other", "yarn")) == "hdfs://other"
    with pytest.raises(RuntimeError):
        shared_folder(FakeSession(None, None, "yarn"))
    local = FakeSession()
    assert shared_folder(local) == shared_folder(local) == local.folder
    assert shared_folder(spark)


# -- publication ------------------------------------------------------------------


def second(folder):
    """A file of February with a record of January too."""
    return source(folder, "2025-02", ["21,Soho,$10.00,2025-02-03", "22,Soho,$900.00,2025-01-30"])


def prices(store):
    return rows(store.averages(), "year_month", "neighbourhood_cleansed", "listing_count", F.col("avg_price").cast("string"))


@pytest.mark.parametrize("step", ["merged_averages", "merged_top_lists", "publish", "_store_audit", "_store_classified"])
def test_a_run_that_fails_leaves_all_as_it_was(spark, tmp_path, monkeypatch, step):
    root = tmp_path / "out"
    store = run_month(spark, run(january(tmp_path), root))
    before = snapshot(store)

    def broken(*args, **kwargs):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(monthly, step, broken)
        with pytest.raises(OSError, match="lost"):
            run_month(spark, run(second(tmp_path), root, "2025-02"))
    store = Store.open(spark, root)
    assert snapshot(store) == before
    assert set(r[0] for r in rows(run_reports(spark, str(root)).average, "year_month")) == {"2025-01", "2025-02"}
    store = run_month(spark, run(second(tmp_path), root, "2025-02"))
    assert prices(store) == [("2025-01", "Camden", 1, "50.00"), ("2025-01", "Soho", 3, "433.33"), ("2025-02", "Soho", 2, "40.00")]


def test_writes_side_by_side_all_end_before_a_failure_is_raised(spark):
    ended = []

    def fails():
        ended.append(spark.range(3).count())
        raise ValueError("first")

    with pytest.raises(ValueError, match="first"):
        monthly.side_by_side(spark, fails, lambda: ended.append(spark.range(40).count()), lambda: ended.append(spark.range(500).count()))
    assert sorted(ended) == [3, 40, 500]


def test_two_runs_on_one_base_both_count(spark, tmp_path, monkeypatch):
    """Another run is published between a run's merge and its publication."""
    root, other, publish = tmp_path / "out", [], monthly.publish

    def late(spark, at, new):
        if not other:
            other.append(True)
            run_month(spark, run(second(tmp_path), root, "2025-02"))
            with pytest.raises(BaseMoved):
                publish(spark, at, new)
            raise BaseMoved
        publish(spark, at, new)

    monkeypatch.setattr(monthly, "publish", late)
    store = run_month(spark, run(january(tmp_path), root))
    assert store.manifest.version == 2
    assert prices(store) == [("2025-01", "Camden", 1, "50.00"), ("2025-01", "Soho", 3, "433.33"), ("2025-02", "Soho", 2, "40.00")]
    assert rows(store.ranked("over", "2025-01"), "id") == [("1",), ("2",), ("22",), ("3",)]
    assert store.audit().count() == 4


@pytest.mark.parametrize("killed_before", ["_store_audit", "publish", None])
def test_a_repeated_token_counts_once(spark, tmp_path, monkeypatch, killed_before):
    """Killed between its tables and its audit, or before publication, or not at all; then repeated."""
    root, one = tmp_path / "out", run(january(tmp_path), tmp_path / "out", token="job-7")
    with monkeypatch.context() as patch:
        if killed_before:
            patch.setattr(monthly, killed_before, lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
            with pytest.raises(KeyboardInterrupt):
                run_month(spark, one)
            assert Store.open(spark, root).manifest.version == 0
        else:
            run_month(spark, one)
    store = run_month(spark, one)
    assert store.manifest.version == 1
    assert rows(store.audit(), "rows_read") == [(1,), (6,)]
    assert run_month(spark, one).manifest == store.manifest


def test_publishing_is_all_or_nothing(spark, tmp_path):
    root = str(tmp_path)
    assert manifest.current(spark, root).version == 0
    first = manifest.Manifest(version=1, roles=Roles(("a", "b"), "g", "p", "d"), parts={"2025-01": manifest.Part("r", ("2025-01",))})
    manifest.publish(spark, root, first)
    assert manifest.current(spark, root) == first
    with pytest.raises(BaseMoved):
        manifest.publish(spark, root, first)
    (tmp_path / "manifest" / ".draft").write_text("{")
    assert manifest.current(spark, root) == first


def test_a_run_reads_no_records_of_others(spark, tmp_path, monkeypatch):
    root = tmp_path / "out"
    run_month(spark, run(january(tmp_path), root))
    monkeypatch.setattr(Store, "classified", lambda *a, **k: pytest.fail("records were read"))
    store = run_month(spark, run(second(tmp_path), root, "2025-02"))
    assert [r[2] for r in prices(store)] == [1, 3, 2]
    averages = monthly.merged_averages(store, {"2025-01"})
    assert all("/out/states/run=" in path for path in averages.inputFiles())
    text = plan(averages)
    assert "run#" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert "EqualTo(year_m" in text.split("PushedFilters: [")[1]


def test_jobs_do_not_grow_with_the_months(spark, tmp_path):
    months = [f"2025-{m:02d}" for m in range(1, 9)]
    for m in months:
        source(tmp_path, m, [f"{m}{k},Soho,${k + 1}.00,{m}-03" for k in range(4)])
    jobs = {}
    for n in (2, 8):
        spark.sparkContext.setJobGroup(f"backfill {n}", "")
        store = run_months(spark, months[:n], str(tmp_path), str(tmp_path / f"out{n}"), "fill", top_k=2)
        jobs[n] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"backfill {n}"))
        assert rows(store.averages(), "year_month", "listing_count") == [(m, 4) for m in months[:n]]
        assert rows(store.audit(), "month", "rows_read", "source_file") == [(m, 4, f"listings_{m}.csv") for m in months[:n]]
    spark.sparkContext.setJobGroup("", "")
    assert jobs[8] <= jobs[2]


@pytest.mark.parametrize("problem, kind", [("missing", FileNotFoundError), ("empty", ValueError)])
def test_backfill_is_published_whole_or_not(spark, tmp_path, problem, kind):
    january(tmp_path)
    if problem == "empty":
        source(tmp_path, "2025-02", [])
    root = str(tmp_path / "out")
    with pytest.raises(kind):
        run_months(spark, ["2025-01", "2025-02"], str(tmp_path), root, "fill")
    store = Store.open(spark, root)
    assert store.manifest.parts == {} and store.averages().count() == 0
    assert rows(store.audit(), "month", "status") == [("2025-01", "FAILED"), ("2025-02", "FAILED")]


def test_roles_are_kept_with_the_tables(spark, tmp_path):
    roles = Roles(("order", "line"), "shop", "cost", "day")
    path = tmp_path / "lines.csv"
    path.write_text("day,cost,line,order,shop,note\n2025-01-02,$1.50,1,7,A,x\n2025-01-02,2.50,2,7,A,x\n2025-01-02,,3,7,A,x\n")
    root = tmp_path / "out"
    store = run_month(spark, run(str(path), root, roles=roles, top_k=1))
    assert rows(store.averages(), "year_month", "shop", F.col("avg_price").cast("string")) == [("2025-01", "A", "2.00")]
    assert rows(Store.open(spark, root).ranked("over"), "order", "line") == [("7", "2")]
    assert rows(run_reports(spark, str(root), n=1).under, "line", "rank") == [("1", 1)]
    with pytest.raises(ValueError, match="made with"):
        run_month(spark, run(january(tmp_path), root))
    assert run_month(spark, run(str(path), root, roles=roles)).averages().count() == 1


# -- reports beyond the stored lists -------------------------------------------------


@pytest.mark.parametrize("month, group", [(None, "ALL"), ("2025-01", "ALL"), (None, "soho"), ("2025-02", "camden")])
@pytest.mark.parametrize("n", [1, 2, 3, 5, 50])
def test_reports_of_any_length(spark, tmp_path_factory, month, group, n, _built={}):
    """As if the lists had held everything."""
    if not _built:
        folder = tmp_path_factory.mktemp("reports")
        lines = [f"{k},{g},${(k * 37) % 11 + 1}.00,2025-0{1 + k % 2}-03" for k in range(40) for g in ("Soho", "SOHO", "Camden")[: 1 + k % 3]]
        path = source(folder, "2025-01", lines)
        for name, k in (("short", 2), ("whole", 1000)):
            run_month(spark, run(path, folder / name, top_k=k))
            _built[name] = str(folder / name)
    short, whole = (run_reports(spark, _built[name], month, group, n) for name in ("short", "whole"))
    for side in ("over", "under"):
        names = ["year_month", "neighbourhood_cleansed", "id", "price_num", "pct_diff", "rank"]
        got, want = ordered(getattr(short, side), *names), ordered(getattr(whole, side), *names)
        assert got == want and got


def test_deep_reports_read_the_records_of_their_month_only(spark, tmp_path, monkeypatch):
    root = tmp_path / "out"
    run_month(spark, run(january(tmp_path), root, top_k=1))
    run_month(spark, run(source(tmp_path, "2025-03", ["31,Soho,$1.00,2025-03-03", "32,Soho,$2.00,2025-03-03"]), root, "2025-03", top_k=1))
    seen, classified = [], Store.classified

    def spy(self, *args, **kwargs):
        seen.append(kwargs["months"])
        rows = classified(self, *args, **kwargs)
        assert len(rows.inputFiles()) == 1
        return rows

    monkeypatch.setattr(Store, "classified", spy)
    reports = run_reports(spark, str(root), "2025-03", n=3)
    assert rows(reports.over, "id", "rank") == [("31", 2), ("32", 1)]
    assert seen == [{"2025-03"}, {"2025-03"}]
    seen.clear()
    run_reports(spark, str(root), "2025-03", n=1).over.collect()
    assert not seen


def test_csv_exchange(spark, tmp_path):
    root = run_month(spark, run(january(tmp_path), tmp_path / "out")).root
    path = export_csv(spark, root, str(tmp_path / "csv"))
    for group in ("ALL", "soho"):
        stored, read = run_reports(spark, root, group=group), csv_reports(spark, path, group=group)
        for side in ("average", "over", "under"):
            names = [c for c in getattr(read, side).columns if c != "processing_timestamp"]
            assert ordered(getattr(read, side), *names) == ordered(getattr(stored, side), *names)
    errors = spark.read.option("header", "true").csv(f"{path}/errors")
    assert rows(errors, "id", "reject_reason") == [("4", "bad_price"), ("5", "missing_group"), ("6", "negative_price")]
