"""Registered queries on a few rows whose results are worked out by hand, so that a slip shared by
a query and its SQL shows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as d
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from lendgrid.plans import ORACLE, QUERIES
from lendgrid.plans.compare import run_oracle

SMALL = "/root/testdata/sf0.001"
DAY = dt.datetime(1998, 1, 1)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("by-hand")
    for table in Path(SMALL).glob("*.parquet"):
        if table.stem not in ("orders", "lineitem"):
            (path / table.name).symlink_to(table)

    def write(name, rows):
        schema = pq.read_schema(f"{SMALL}/{name}.parquet")

        def cell(row, f):
            return row.get(f.name, "x" if pa.types.is_string(f.type) or pa.types.is_large_string(f.type) else DAY if pa.types.is_timestamp(f.type) else 1)

        pq.write_table(pa.Table.from_pylist([{f.name: cell(r, f) for f in schema} for r in rows], schema), path / f"{name}.parquet")

    def loan(key, priority="3-MEDIUM", status="O", amount=100.0):
        return dict(o_orderkey=key, o_custkey=key, o_orderdate=DAY, o_totalprice=amount, o_orderstatus=status, o_orderpriority=priority)

    def line(key, number, price=10.0, flag="N", status="O", discount=0.02, tax=0.04, quantity=10.0, due=DAY):
        return dict(l_orderkey=key, l_linenumber=number, l_extendedprice=price, l_returnflag=flag, l_linestatus=status, l_discount=discount, l_tax=tax, l_quantity=quantity, l_shipdate=due)

    write("orders", [loan(1, "1-URGENT"), loan(2, "2-HIGH"), loan(3, amount=500000.0), *(loan(k) for k in (4, 5, 6, 7, 8, 9, 10, 13)), loan(11, status="F"), loan(12, status="F")])
    write("lineitem", [
        line(1, 1), line(2, 1), line(3, 1),
        line(4, 1, 10.0), line(4, 2, 20.0),                        # principal grows
        line(5, 1, 20.0), line(5, 2, 10.0, quantity=7.0),          # and falls
        line(6, 1, discount=0.0), line(6, 2, discount=0.05),       # one line without principal
        line(7, 1), line(7, 2, flag="A"), line(8, 1), line(8, 2, flag="R"),
        line(9, 1, status="O"), line(9, 2, status="F"),            # one flag, two states
        line(10, 1), line(10, 2, due=dt.datetime(1998, 6, 30)), line(10, 3, due=dt.datetime(1998, 7, 1)),
        line(11, 1, discount=0.0), line(12, 1), line(13, 1, discount=0.0), line(13, 2, discount=0.0)])
    return str(path)


def both(spark, folder, name, key):
    """The rows of a query by key, after a check that its SQL says the same."""
    ours = {tuple(r[k] for k in key): r.asDict() for r in QUERIES[name](spark, folder).collect()}
    columns, rows = run_oracle(ORACLE[name], folder)
    theirs = {tuple(dict(zip(columns, r))[k] for k in key): dict(zip(columns, r)) for r in rows}
    assert ours.keys() == theirs.keys()
    return ours, theirs


def test_repayment_styles(spark, folder):
    ours, theirs = both(spark, folder, "repay_style", ["loan_num"])
    want = {1: "flexible", 2: "combined", 3: "balloon", 4: "step-up", 5: "step-down", 6: "interest-only", 7: "annuity", 8: "fixed-installment", 9: "freq-mismatch",
            10: "equal-principal", 11: "interest-then-principal", 12: "bullet", 13: None}
    assert {k[0]: r["repayment_typ"] for k, r in ours.items()} == want == {k[0]: r["repayment_typ"] for k, r in theirs.items()}


def test_effective_rates(spark, folder):
    ours, theirs = both(spark, folder, "effective_rate", ["loan_num", "perd_no"])
    # (base 4 + spread 0.2) * (1 + 10 / 100); an unknown spread or adjustment makes the rate unknown
    for rates in (ours, theirs):
        assert d(rates[1, 1]["real_int_rat"]) == d("4.62")
        assert rates[6, 2]["real_int_rat"] is None and rates[5, 2]["real_int_rat"] is None
        assert d(rates[6, 1]["real_int_rat"]) == d("4.4")


def test_cumulative_arrears(spark, folder):
    ours, theirs = both(spark, folder, "cumulative_periods", ["loan_num"])
    want = {1: 1, 4: 2, 7: 1, 8: 1, 10: 2}  # unpaid lines due by the run date; that of 1 July is not
    for rows in (ours, theirs):
        assert {k: rows[k,]["cum_perds"] for k in want} == want
        assert all(r["od_perds"] >= r["cum_perds"] for r in rows.values())
