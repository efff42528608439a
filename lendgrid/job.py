"""The ledger load of one business date.

``LedgerJob`` builds the chosen segments lazily, derives each customer's first loan
over the whole date, that is with the date's other segments as they are
published, and publishes its slices all at once: readers see the date as it was
until the last write, and a run that dies changes nothing. Of the other segments
only the rows whose first-loan mark changed are written, as an update. Every
row keeps the mark its segment gave it beside the derived one, so loads of some
segments in any order give what one full load gives. Other dates are untouched, and a
segment that has no rows now has its slice emptied. Step rows go to the run log
as the steps happen; row counts come from an ``Observation`` of the write.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as T

from lendgrid.operators.ledger import LEDGER, first_loans, union_segments
from lendgrid.rundate import RunDate
from lendgrid.segments.catalog import Catalog, Choices
from lendgrid.session import ensure_checkpoint_dir
from lendgrid.sources import Mark, PublishedSlices, RunLog
from lendgrid.sources.published import UPDATES

SegmentFn = Callable[[Catalog, RunDate], DataFrame]

PROCEDURE = "lendgrid.LedgerJob"  # the run log's procedure column
DETAIL_TABLE = "URDM.PL_LBI_R_LOAN_DETAIL_HS"
# One slice for each date and source system: what one load deletes and inserts.
SLICE_COLUMNS = ["data_date", "date_sourcesd"]
FLAG = "is_first_report_loan_tag"
ROW_KEY = ("loan_num", "date_sourcesd")


def ledger_store(spark: SparkSession, target: str, schema: T.StructType = LEDGER) -> PublishedSlices:
    """The published ledger at ``target``."""
    return PublishedSlices(spark, target, schema, SLICE_COLUMNS, Mark(FLAG, "Y", ROW_KEY))


def read_ledger(spark: SparkSession, target: str, **equals: str) -> DataFrame:
    """The ledger as it is published, e.g. ``read_ledger(spark, target, data_date="20240131")``."""
    return ledger_store(spark, target).read(**equals)


class LedgerJob:
    def __init__(self, spark: SparkSession, catalog: Catalog, run: RunDate | str, target: str,
                 segments: Mapping[str, SegmentFn], run_log: str | None = None,
                 detail: SegmentFn | None = None, detail_target: str | None = None):
        self.spark = spark
        self.catalog = catalog
        self.run = run if isinstance(run, RunDate) else RunDate.parse(run)
        self.target = target
        self.segments = dict(segments)
        self.run_log_path = run_log
        self.detail = detail
        self.detail_target = detail_target
        self.log = RunLog(self.run.d8, PROCEDURE)

    def _write_detail(self) -> int:
        """Publish the loan-detail slice (``rpt_dt = D``) and point the catalog
        at it: later segments read it back from storage, which also cuts the
        lineage between the two loads."""
        obs = Observation("detail_rows")
        df = self.detail(self.catalog, self.run)
        store = PublishedSlices(self.spark, self.detail_target, df.schema, ["rpt_dt"])
        version = store.stage(df.observe(obs, F.count(F.lit(1)).alias("rows")))
        rows = int(obs.get["rows"])
        day = self.run.d.isoformat()
        store.publish({(day,): rows}, version)  # without rows the date's old slice goes all the same
        self.catalog = self.catalog.with_tables({DETAIL_TABLE: store.read(rpt_dt=day)})
        return rows

    def build(self) -> tuple[DataFrame, DataFrame]:
        """(rows, changes): the rows of this run's segments with their own and their
        derived mark, and the keys of other segments' rows whose derived mark changes.

        The segments are read twice (a narrow pass that ranks each customer's loans,
        and the rows themselves). They are wide join trees that Catalyst cannot prune
        away, so their union is first materialised with a reliable ``checkpoint()``
        into the cluster's checkpoint folder: computed once, lineage cut, and a lost
        executor re-reads files instead of computing the joins again. Of the other
        segments five columns are read."""
        ensure_checkpoint_dir(self.spark)
        if self.catalog is not None:
            self.catalog.key_checks.clear()
        frames = {tag: fn(self.catalog, self.run) for tag, fn in self.segments.items()}
        own = union_segments(frames, self.run.d8).withColumn(FLAG, F.coalesce(FLAG, F.lit("N"))).checkpoint(eager=True)
        store = ledger_store(self.spark, self.target)
        derived = store.mark.derived
        others = (store.read_marked(data_date=self.run.d8).where(~F.col("date_sourcesd").isin(*self.segments))
                  .select("cust_id", "drawdown_dt", *ROW_KEY, derived))
        narrow = own.select("cust_id", "drawdown_dt", *ROW_KEY).union(others.drop(derived))
        firsts = first_loans(narrow).checkpoint(eager=True)  # met by both sides below
        marks = firsts.select(*[F.col(k).alias(f"m_{k}") for k in ROW_KEY], F.lit(True).alias("hit"))
        same = (F.col("m_loan_num") == F.col("loan_num")) & (F.col("m_date_sourcesd") == F.col("date_sourcesd"))
        hit = F.coalesce("hit", F.lit(False))
        rows = own.join(marks, same, "left").withColumn(derived, hit).select(*own.columns, derived)
        now = others.join(marks, same, "left").where(F.col("loan_num").isNotNull() & (hit != F.col(derived)))
        changes = now.select(F.lit(self.run.d8).alias("data_date"), *ROW_KEY, hit.alias(derived)).distinct()
        return rows, changes

    def execute(self) -> dict[str, int]:
        """Build and publish the slices; returns rows written per segment. Each
        execution appends its own step rows to the run log."""
        self.log = RunLog(self.run.d8, PROCEDURE, self.spark, self.run_log_path)
        self.log.log(0, "start", 0)
        try:
            if self.detail is not None:
                self.log.log(len(self.segments) + 2, "load detail", 0)
                self.log.log(len(self.segments) + 2, "load detail", 1, self._write_detail())
            for step, tag in enumerate(self.segments, start=1):
                self.log.log(step, f"load {tag}", 0)
            rows, changes = self.build()
            obs = Observation("ledger_rows")
            counted = rows.observe(obs, *[
                F.count(F.when(F.col("date_sourcesd") == tag, F.lit(1))).alias(tag) for tag in self.segments])
            store = ledger_store(self.spark, self.target)
            version = store.stage(counted)
            counts = {tag: int(obs.get[tag]) for tag in self.segments}
            changed = store.stage(changes, UPDATES)
            checks = self.catalog.key_checks if self.catalog is not None else []
            for key, n in sorted(item for check in checks for item in check.duplicates().items()):
                self.log.log(len(self.segments) + 3, f"key with several rows: {key}", 0, n)
            store.publish({(self.run.d8, tag): n for tag, n in counts.items()}, version, store.staged_counts(changed, UPDATES), changed)
            for step, tag in enumerate(self.segments, start=1):
                self.log.log(step, f"load {tag}", 1, counts[tag])
            self.log.log(len(self.segments) + 1, "done", 1, sum(counts.values()))
            return counts
        except Exception as exc:
            self.log.log(-1, f"{type(exc).__name__}: {exc}", -1, 0)
            raise


def main(argv: list[str] | None = None) -> int:
    """``python -m lendgrid.job --date 2024-01-31 --target <ledger path> ...``

    Runs one business date end to end on the session's cluster. Source
    tables come from the session catalogue (``--tables``, the default) or
    from Parquet datasets under ``--parquet-root`` (one folder per table,
    named in lower case)."""
    import argparse
    import json

    from lendgrid.segments import SEGMENTS, loan_detail

    ap = argparse.ArgumentParser(prog="lendgrid.job", description="Load one business date of the loan ledger.")
    ap.add_argument("--date", required=True, help="business date, yyyy-MM-dd or yyyyMMdd")
    ap.add_argument("--target", required=True, help="ledger location (partitioned by data_date, date_sourcesd)")
    ap.add_argument("--detail-target", required=True, help="loan-detail location (partitioned by rpt_dt)")
    ap.add_argument("--run-log", help="run-log location (appended)")
    ap.add_argument("--parquet-root", help="read source tables from Parquet folders under this root")
    ap.add_argument("--choices", help="JSON file: org_rewrites, org_names, literal (see Choices)")
    ap.add_argument("--segments", default=",".join(SEGMENTS), help="comma-separated segment tags to load")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"lendgrid-ledger-{args.date}").getOrCreate()
    catalog = Catalog.parquet(spark, args.parquet_root) if args.parquet_root else Catalog.tables(spark)
    if args.choices:
        with open(args.choices, encoding="utf-8") as f:
            given = json.load(f)
        catalog = catalog.with_choices(Choices(given.get("org_rewrites", {}), given.get("org_names", {}), frozenset(given.get("literal", ()))))
    chosen = {tag: SEGMENTS[tag] for tag in args.segments.split(",") if tag}
    job = LedgerJob(spark, catalog, args.date, args.target, chosen, run_log=args.run_log,
                    detail=loan_detail if "PL_2" in chosen else None, detail_target=args.detail_target)
    print(json.dumps({"data_date": job.run.d8, "rows": job.execute()}))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
