import datetime as dt
import os
import tempfile

import pandas as pd
from pyspark.sql import functions as F

from lendgrid.operators.ledger import LEDGER, conform
from lendgrid.rundate import RunDate
from lendgrid.sources import as_of, history_from_events, read_slice, replace_slice

D = dt.date(2024, 1, 31)
RUN = RunDate(D)


def test_f1_snapshot_boundaries(spark):
    rows = [(1, dt.date(2024, 1, 31), dt.date(2024, 2, 5), "202401"),   # begndt = D -> keep
            (2, dt.date(2024, 1, 1), dt.date(2024, 1, 31), "202401"),   # overdt = D -> drop
            (3, dt.date(2024, 1, 1), dt.date(2024, 2, 1), "202401"),    # overdt = D+1 -> keep
            (4, dt.date(2024, 2, 1), dt.date(2024, 3, 1), "202401"),    # begndt = D+1 -> drop
            (5, dt.date(2024, 1, 1), dt.date(2024, 2, 1), "202312")]    # other partid -> drop
    df = spark.createDataFrame(rows, "k int, begndt date, overdt date, partid string")
    assert sorted(r.k for r in as_of(df, RUN).collect()) == [1, 3]


def test_history_from_events_matches_lead(spark):
    ts = pd.to_datetime(["2024-01-01 10:00", "2024-01-01 12:00", "2024-01-03 09:00", "2024-01-02 08:00",
                         "2024-01-05 00:00", "2024-01-05 00:00"])
    pdf = pd.DataFrame({"k": [1, 1, 1, 2, 2, 2], "ts": ts, "eid": [1, 2, 3, 4, 5, 6], "v": list("abcdef")})
    df = spark.createDataFrame(pdf)
    got = {r.eid: (r.begndt, r.overdt) for r in history_from_events(df, "k", "ts", "eid", ["v"]).collect()}
    # brute force: overdt = date of the next change of the same key
    pdf = pdf.sort_values(["k", "ts", "eid"])
    nxt = pdf.groupby("k")["ts"].shift(-1)
    expect = {}
    for eid, t0, t1 in zip(pdf["eid"], pdf["ts"], nxt):
        expect[eid] = (t0.date(), dt.date(9999, 12, 31) if pd.isna(t1) else t1.date())
    assert got == expect
    # at most one active row per key on every day
    hist = history_from_events(df, "k", "ts", "eid", ["v"])
    for day in range(1, 7):
        snap = as_of(hist, RunDate(dt.date(2024, 1, day)))
        assert snap.groupBy("k").count().where("count > 1").count() == 0


def test_f12_replace_slice_idempotent(spark):
    root = os.path.join(tempfile.mkdtemp(prefix="lendgrid-slice-"), "ledger")
    mk = lambda d8, n: conform(spark.createDataFrame(
        [(str(i), d8, "CL_1") for i in range(n)], "loan_num string, data_date string, date_sourcesd string"))
    replace_slice(mk("20240131", 3), root, ["data_date"])
    replace_slice(mk("20240229", 5), root, ["data_date"])
    replace_slice(mk("20240229", 4), root, ["data_date"])  # rerun of one date
    assert read_slice(spark, root, LEDGER, data_date="20240131").count() == 3
    assert read_slice(spark, root, LEDGER, data_date="20240229").count() == 4
    assert read_slice(spark, root, LEDGER).schema["data_date"].dataType.simpleString() == "string"
