"""Slices published at once, and marks updated without rewriting their rows."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendgrid.job import LedgerJob, ledger_store, read_ledger
from lendgrid.operators.ledger import flag_first_loan, union_segments
from lendgrid.rundate import RunDate
from lendgrid.sources import Mark, PublishedSlices
from lendgrid.sources.published import ROWS, UPDATES

RUN = RunDate.parse("20240131")
COLUMNS = "loan_num string, cust_id string, drawdown_dt date, is_first_report_loan_tag string"
# Own marks as the segments give them: CL_1 its own Y, XL_6 1 and 2, NL_3 none.
LOANS = {
    "CL_1": [("C1", "A", dt.date(2021, 1, 1), "Y"), ("C2", "B", dt.date(2019, 1, 1), "N"), ("C3", None, dt.date(2018, 1, 1), None)],
    "NL_3": [("N1", "A", dt.date(2020, 1, 1), None), ("N2", "D", dt.date(2020, 5, 1), None), ("N3", None, dt.date(2017, 1, 1), None)],
    "XL_6": [("X1", "B", dt.date(2020, 1, 1), "1"), ("X2", "A", dt.date(2023, 1, 1), "2"), ("X3", "D", dt.date(2020, 5, 1), "1"), ("C1", "E", None, "2")],
}


@pytest.fixture(scope="module")
def segments(spark):
    return {tag: (lambda cat, run, rows=rows: spark.createDataFrame(rows, COLUMNS)) for tag, rows in LOANS.items()}


def fresh():
    return os.path.join(tempfile.mkdtemp(prefix="lendgrid-published-"), "ledger")


def marks(df):
    return sorted((r.date_sourcesd, r.loan_num, r.is_first_report_loan_tag) for r in df.select("date_sourcesd", "loan_num", "is_first_report_loan_tag").collect())


def load(spark, root, segments, *tags):
    return LedgerJob(spark, None, RUN, root, {tag: segments[tag] for tag in tags}).execute()


@pytest.fixture(scope="module")
def full(spark, segments):
    frames = {tag: fn(None, RUN) for tag, fn in segments.items()}
    return marks(flag_first_loan(union_segments(frames, RUN.d8)))


def test_full_load_equals_the_flag_operator(spark, segments, full):
    root = fresh()
    assert load(spark, root, segments, *LOANS) == {"CL_1": 3, "NL_3": 3, "XL_6": 4}
    assert marks(read_ledger(spark, root, data_date=RUN.d8)) == full
    assert ("CL_1", "C1", "Y") in full and ("XL_6", "X1", "1") in full  # own marks, beside N1 and C2 as first loans


@pytest.mark.parametrize("order", [(("CL_1",), ("NL_3",), ("XL_6",)), (("XL_6",), ("NL_3",), ("CL_1",)), (("NL_3",), ("CL_1", "XL_6"), ("NL_3",))])
def test_partial_loads_in_any_order_equal_the_full_load(spark, segments, full, order):
    root = fresh()
    for tags in order:
        load(spark, root, segments, *tags)
    assert marks(read_ledger(spark, root, data_date=RUN.d8)) == full


def test_a_partial_load_writes_only_its_rows_and_the_changed_marks(spark, segments, full):
    root = fresh()
    load(spark, root, segments, "CL_1", "XL_6")
    store = ledger_store(spark, root)
    before = marks(store.read(data_date=RUN.d8))
    load(spark, root, segments, "NL_3")
    last = store.manifest().agg(F.max("seq")).first()[0]
    written = store.manifest().where(F.col("seq") == last).collect()
    assert {(r.kind, r.date_sourcesd): r.n_rows for r in written if r.kind == ROWS} == {(ROWS, "NL_3"): 3}
    version = next(r.version for r in written if r.kind == ROWS)
    assert {r.date_sourcesd for r in spark.read.parquet(f"{root}/rows/version={version}").select("date_sourcesd").distinct().collect()} == {"NL_3"}
    after = [m for m in marks(store.read(data_date=RUN.d8)) if m[0] != "NL_3"]
    # C1 (own Y stays, derived goes), C3 (the customer that is NULL) and X3 change, no other row is written.
    assert {r.date_sourcesd: r.n_rows for r in written if r.kind == UPDATES} == {"CL_1": 2, "XL_6": 1}
    assert len([1 for a, b in zip(before, after) if a != b]) == 2 and len(before) == len(after)
    assert store.compact(data_date=RUN.d8) == 2
    assert marks(store.read(data_date=RUN.d8)) == full
    assert not [e for e in store._entries({}) if e["kind"] == UPDATES]
    load(spark, root, segments, "XL_6")
    assert marks(store.read(data_date=RUN.d8)) == full


def test_a_run_that_dies_between_any_two_writes_changes_nothing(spark, segments, monkeypatch):
    root, runlog = fresh(), fresh()
    early = {"XL_6": lambda cat, run: spark.createDataFrame([("X9", "A", dt.date(2001, 1, 1), "1")], COLUMNS), "CL_1": segments["CL_1"],
             "NL_3": lambda cat, run: spark.createDataFrame([], COLUMNS)}
    load(spark, root, segments, *LOANS)
    detail_root = fresh()
    detail = lambda cat, run: spark.createDataFrame([("P1", RUN.d)], "loan_num string, rpt_dt date")
    old = marks(read_ledger(spark, root, data_date=RUN.d8))
    real, calls = DataFrameWriter.parquet, [0]

    def job():
        from lendgrid.segments.catalog import Catalog

        return LedgerJob(spark, Catalog.frames({}), RUN, root, {t: early[t] for t in ("XL_6", "NL_3")}, run_log=runlog, detail=detail, detail_target=detail_root)

    survived = False
    for dies_at in range(1, 60):
        calls[0] = 0

        def write(self, path, *args, **kwargs):
            if not path.startswith(runlog):
                calls[0] += 1
                if calls[0] == dies_at:
                    raise RuntimeError("executor and driver lost")
            return real(self, path, *args, **kwargs)

        monkeypatch.setattr(type(spark.range(1).write), "parquet", write)
        try:
            job().execute()
            survived = True
        except RuntimeError:
            assert marks(read_ledger(spark, root, data_date=RUN.d8)) == old, dies_at
        finally:
            monkeypatch.undo()
        if survived:
            break
    assert survived and dies_at == 6  # detail rows and manifest, ledger rows, marks and manifest
    new = marks(read_ledger(spark, root, data_date=RUN.d8))
    assert [m for m in new if m[0] != "CL_1"] == [("XL_6", "X9", "Y")] and len(new) == 4


def test_staged_rows_empty_slices_and_other_dates(spark):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType()), T.StructField("day", T.DateType()), T.StructField("src", T.StringType())])
    store = PublishedSlices(spark, fresh(), schema, ["day", "src"], Mark("v", "M", ("k",)))
    a, b = dt.date(2024, 1, 31), dt.date(2024, 2, 29)

    def rows(*values):
        return spark.createDataFrame([(k, v, d, s, m) for k, v, d, s, m in values], "k long, v string, day date, src string, derived_v boolean")

    def shown(**equals):
        return sorted((r.k, r.v, r.src) for r in store.read(**equals).collect())

    assert store.manifest() is None and shown() == []
    v1 = store.stage(rows((1, "x", a, "s", False), (2, None, a, "t", True), (3, "y", b, "s", None)))
    assert shown() == []
    store.publish(store.staged_counts(v1), v1)
    assert shown() == [(1, "x", "s"), (2, "M", "t"), (3, "y", "s")] and shown(day="2024-02-29") == [(3, "y", "s")]
    store.stage(rows((9, "z", a, "s", False)))  # never published
    v2 = store.stage(rows((4, "q", a, "s", False)))
    u2 = store.stage(rows((2, None, a, "t", False), (3, None, b, "s", True)).select("k", "derived_v", "day", "src"), UPDATES)
    store.publish({("2024-01-31", "s"): 1}, v2, store.staged_counts(u2, UPDATES), u2)
    assert store.read().orderBy("k").collect() == [(2, None, a, "t"), (3, "M", b, "s"), (4, "q", a, "s")]
    # updates of rows that are replaced afterwards no longer count; a slice without rows is empty
    v3 = store.stage(rows((3, "n", b, "s", False)))
    store.publish({("2024-02-29", "s"): 1, ("2024-01-31", "s"): 0}, v3)
    assert store.read().orderBy("k").collect() == [(2, None, a, "t"), (3, "n", b, "s")]
    assert store.compact() == 1 and store.compact() == 0
    assert store.read().orderBy("k").collect() == [(2, None, a, "t"), (3, "n", b, "s")]
    plan = store.read(day="2024-02-29")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
