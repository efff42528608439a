"""What a deployment sets: names of organisations and literal readings; and duplicate keys in the run log."""

from __future__ import annotations

import json
import os
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import test_micro_segment as micro  # noqa: E402
import test_personal_segment as personal  # noqa: E402

from lendgrid.job import LedgerJob, main, read_ledger  # noqa: E402
from lendgrid.segments import Catalog, Choices, micro_loans, personal_loans  # noqa: E402
from lendgrid.segments.micro import ORG_PARAM, WRITE_OFF  # noqa: E402

RUN = micro.RUN


@pytest.fixture(scope="module")
def micro_frames(spark):
    return micro.build_frames(spark)


@pytest.fixture(scope="module")
def personal_frames(spark):
    return personal.build_frames(spark)


def rows(df):
    return {r.loan_num: r.asDict() for r in df.collect()}


def changed(before, after):
    return {(k, c) for k in before for c in before[k] if before[k][c] != after[k][c]}


def test_organisation_names_are_inputs(spark, micro_frames, personal_frames):
    catalog = Catalog.frames(micro_frames)
    orgs = catalog.read(ORG_PARAM).collect()
    before = rows(micro_loans(catalog, RUN))
    after = rows(micro_loans(catalog.with_choices(Choices(org_names={r.jigouhao: f"renamed {r.jigouzwm}" for r in orgs})), RUN))
    cells = changed(before, after)
    assert cells and all(after[k][c] == f"renamed {before[k][c]}" for k, c in cells)
    assert {c for _, c in cells} <= {"loan_acct_bank", "pay_acct_bank"}
    catalog = Catalog.frames(personal_frames)
    before = rows(personal_loans(catalog, RUN))
    names = {r["loan_acct_bank"] for r in before.values()} - {None}
    after = rows(personal_loans(catalog.with_choices(Choices(org_rewrites={n: f"legal {n}" for n in names})), RUN))
    cells = changed(before, after)
    assert {c for _, c in cells} <= {"loan_acct_bank", "pay_acct_bank"} and all(after[k][c] == f"legal {before[k][c]}" for k, c in cells) and cells


def test_literal_readings(spark, micro_frames, personal_frames):
    catalog = Catalog.frames(micro_frames)
    before, after = (rows(micro_loans(c, RUN)) for c in (catalog, catalog.with_choices(Choices(literal=frozenset({"Q3"})))))
    cells = changed(before, after)
    assert cells and {c for _, c in cells} == {"mon_int_incom"} and all(after[k][c] is None for k, c in cells)
    catalog = Catalog.frames(personal_frames).with_choices(Choices(literal=frozenset({"Q4"})))
    literal = personal_loans(catalog, RUN)
    assert "year_int_incom" not in literal.columns and {r.mon_int_incom for r in literal.collect()} == {"0"}
    with pytest.raises(ValueError, match="literal"):
        Choices(literal=frozenset({"Q9"}))


def test_duplicate_keys_of_a_look_up_are_logged(spark, micro_frames):
    own = dict(micro_frames)
    own[WRITE_OFF] = own[WRITE_OFF].union(own[WRITE_OFF])  # every voucher's write-off is there twice
    root = tempfile.mkdtemp(prefix="lendgrid-keys-")
    job = LedgerJob(spark, Catalog.frames(own), RUN, os.path.join(root, "ledger"), {"XL_6": micro_loans}, run_log=os.path.join(root, "log"))
    job.execute()
    logged = {r.step_desc: r.row_count for r in spark.read.parquet(os.path.join(root, "log")).collect()}
    assert logged["key with several rows: av_vchno"] >= 1 and len([k for k in logged if k.startswith("key with")]) == 1
    clean = LedgerJob(spark, Catalog.frames(micro_frames), RUN, os.path.join(root, "two"), {"XL_6": micro_loans}, run_log=os.path.join(root, "log2"))
    clean.execute()
    assert not spark.read.parquet(os.path.join(root, "log2")).where(F.col("step_desc").startswith("key with several rows")).count()


def test_choices_from_the_command_line(spark, micro_frames, capsys):
    root = tempfile.mkdtemp(prefix="lendgrid-choices-")
    for name, df in micro_frames.items():
        df.write.parquet(os.path.join(root, "src", name.lower()))
    with open(os.path.join(root, "choices.json"), "w") as f:
        json.dump({"literal": ["Q3"]}, f)
    argv = ["--date", "20240131", "--target", os.path.join(root, "ledger"), "--detail-target", os.path.join(root, "detail"), "--parquet-root", os.path.join(root, "src"),
            "--segments", "XL_6", "--choices", os.path.join(root, "choices.json")]
    assert main(argv) == 0 and json.loads(capsys.readouterr().out.strip().splitlines()[-1])["rows"]["XL_6"] > 0
    assert read_ledger(spark, os.path.join(root, "ledger")).where("mon_int_incom is not null").count() == 0
