"""What a job returns, and how its result becomes the next state."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from duskwork.operators.audit import AUDIT_COLUMNS, run_log_row
from duskwork.operators.keys import assign_keys, with_row_ids
from duskwork.operators.mutate import rows_for
from duskwork.operators.sequences import SEQUENCES, last_key, reserved
from duskwork.sources import files
from duskwork.sources.bucketed import BUCKET, Layout, in_buckets, put_in_place, put_new, stage, stage_new
from duskwork.sources.tables import read_tables, write_tables

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class JobResult:
    """New table states, names to log, audit rows without ids, other output.

    ``appended`` holds the new rows of tables that only grew, so that a writer
    need not write such a table again; ``tables`` has their full state too. ``touched``
    holds the keys of all rows that a rewritten table has lost, gained or changed, so
    that of a table laid out by key only their buckets are written.
    """

    tables: dict[str, DataFrame]
    log_names: tuple[str, ...]
    audit: DataFrame | None = None
    out: dict[str, DataFrame] = field(default_factory=dict)
    appended: dict[str, DataFrame] = field(default_factory=dict)
    touched: dict[str, DataFrame] = field(default_factory=dict)

    @classmethod
    def of(
        cls, old: Tables, log_names: tuple[str, ...], changed: Tables, appended: Tables,
        audit: DataFrame | None = None, out: dict[str, DataFrame] | None = None, touched: Tables | None = None,
    ) -> JobResult:
        """Result from changed tables and from rows to append to the old ones."""
        rows = {n: rows_for(old[n], df) for n, df in appended.items()}
        grown = {n: old[n].unionByName(df) for n, df in rows.items()}
        return cls({**changed, **grown}, log_names, audit, out or {}, rows, dict(touched or {}))

    def over(self, tables: Tables) -> dict[str, DataFrame]:
        """The given tables with this result's new states in place."""
        return {**tables, **self.tables}


Job = Callable[[Tables, datetime], JobResult]


def union_audit(*parts: DataFrame | None) -> DataFrame | None:
    present = [p for p in parts if p is not None]
    return reduce(DataFrame.unionByName, present) if present else None


def combine(*results: JobResult) -> JobResult:
    """One result for jobs that ran one after the other, each on the last state."""
    tables: dict[str, DataFrame] = {}
    appended: dict[str, DataFrame] = {}
    for result in results:
        for name, df in result.tables.items():
            rows = result.appended.get(name)
            if rows is None:
                appended.pop(name, None)
            elif name in appended:
                appended[name] = appended[name].unionByName(rows)
            elif name not in tables:
                appended[name] = rows
            tables[name] = df
    names = tuple(n for r in results for n in r.log_names)
    out = {k: v for r in results for k, v in r.out.items()}
    return JobResult(tables, names, union_audit(*[r.audit for r in results]), out, appended, touched_by(results))


def touched_by(results: Sequence[JobResult]) -> dict[str, DataFrame]:
    """Keys touched by any of the results, for tables of which each change tells its keys."""
    found: dict[str, DataFrame] = {}
    unknown = {n for r in results for n in r.tables if n not in r.touched and n not in r.appended}
    for result in results:
        for name in result.tables:
            keys = result.touched.get(name)
            if name in unknown:
                continue
            if keys is None:
                keys = result.appended[name]
            if name in found:
                shared = [c for c in found[name].columns if c in keys.columns]
                found[name] = found[name].select(*shared).unionByName(keys.select(*shared))
            else:
                found[name] = keys
    return {n: keys for n, keys in found.items() if any(n in r.touched for r in results)}


def chain(tables: Tables, as_of: datetime, *jobs: Job) -> JobResult:
    """Run jobs one after the other, each on the state the one before left."""
    state, results = dict(tables), []
    for step in jobs:
        results.append(step(state, as_of))
        state = results[-1].over(state)
    return combine(*results)


def recorded(spark: SparkSession, tables: Tables, result: JobResult, as_of: datetime) -> JobResult:
    """The result with its audit and success rows as appended rows."""
    records, changed, state = {}, {}, result.over(tables)
    if result.audit is not None:
        last = last_key(state, "audit_trail", "audit_id")
        if SEQUENCES in state:
            records["audit_trail"] = assign_keys(result.audit, AUDIT_COLUMNS, "audit_id", last)
            changed = reserved(state, {("audit_trail", "audit_id"): result.audit})
        else:
            records["audit_trail"] = with_row_ids(result.audit, "audit_id", last)
    if result.log_names:
        records["eod_log"] = reduce(
            DataFrame.unionByName, [run_log_row(spark, name, as_of) for name in result.log_names]
        )
    return combine(result, JobResult.of(state, (), changed, records))


def next_state(spark: SparkSession, tables: Tables, result: JobResult, as_of: datetime) -> dict[str, DataFrame]:
    """All tables after a successful job, audit trail and run log included."""
    return recorded(spark, tables, result, as_of).over(tables)


def run_job(
    spark: SparkSession, job: Job, name: str, tables: Tables, as_of: datetime, folder: str,
    layouts: Mapping[str, Layout] | None = None, run: str | None = None,
) -> dict[str, DataFrame]:
    """Run a job and write what it changed to a folder of this run under ``folder``.

    Changed tables are written whole; of tables that only grew, the new rows
    alone, under ``appended``. Tables with a layout (read by ``read_laid_out``) stay
    where they are: only buckets of touched keys are replaced, only new rows added.
    Returns the tables to go on with. If anything fails, nothing changed is taken
    over: only a failure row joins the run log, under ``failed``. Files of other runs are
    never written over, so tables read from earlier runs stay whole; of tables with a
    layout the frames returned here are to be used from then on.

    A run begun under the same name (``run``) is taken up where it stopped: what it
    committed isn't computed again. Everything is written before the first bucket is replaced.
    """
    run, layouts = run or f"{name}-{uuid4().hex}", layouts or {}
    folder = f"{folder}/{run}"
    if not files.finished(spark, f"{folder}/written"):
        for layout in layouts.values():
            # Buckets that an earlier try staged may come from other inputs; none of them is in place.
            files.delete(spark, layout.staged(run))
        try:
            result = recorded(spark, tables, job(tables, as_of), as_of)
            write_result(spark, result, tables, folder, layouts, run)
        except Exception as error:  # noqa: BLE001 - every failure is logged under the job's name
            row = rows_for(tables["eod_log"], run_log_row(spark, name, as_of, str(error)))
            write_tables({"eod_log": row}, f"{folder}/failed/{uuid4().hex}")
            return with_failures(spark, tables, folder)
    return taken_over(spark, tables, folder, layouts, run)


# How a run holds a table: written whole, new rows only, staged buckets, staged new rows.
WHOLE, ROWS, BUCKETS, BUCKET_ROWS = "whole", "rows", "buckets", "bucket rows"


def changed_keys(name: str, result: JobResult, tables: Tables, layout: Layout) -> DataFrame:
    """Keys of a table's changed rows; all old and new ones if the job doesn't tell."""
    keys = result.touched.get(name)
    if keys is not None and set(layout.key) <= set(keys.columns):
        return keys
    return tables[name].select(*layout.key).unionByName(result.tables[name].select(*layout.key))


def write_result(
    spark: SparkSession, result: JobResult, tables: Tables, folder: str, layouts: Mapping[str, Layout], run: str
) -> None:
    """Write a job's tables to the folder of its run, and in the end the list of them, which commits the run."""
    kinds = {}
    for name, df in result.tables.items():
        layout = layouts.get(name)
        if name in result.appended:
            kinds[name] = ROWS if layout is None else BUCKET_ROWS
        else:
            kinds[name] = WHOLE if layout is None else BUCKETS
    write_tables({n: result.tables[n] for n, kind in kinds.items() if kind == WHOLE}, folder)
    write_tables({n: result.appended[n] for n, kind in kinds.items() if kind == ROWS}, f"{folder}/appended")
    for name, kind in kinds.items():
        if kind == BUCKETS:
            state = result.tables[name]
            keys = changed_keys(name, result, tables, layouts[name])
            stage(spark, layouts[name], keys, lambda buckets, state=state: in_buckets(state, buckets).drop(BUCKET), run)
        elif kind == BUCKET_ROWS:
            stage_new(spark, layouts[name], result.appended[name].drop(BUCKET), run)
    listed = spark.createDataFrame(sorted(kinds.items()), "name string, kind string")
    listed.coalesce(1).write.mode("overwrite").parquet(f"{folder}/written")


def taken_over(
    spark: SparkSession, tables: Tables, folder: str, layouts: Mapping[str, Layout], run: str
) -> dict[str, DataFrame]:
    """The tables after a written run; staged buckets are put in place if they aren't yet."""
    kinds = dict(map(tuple, spark.read.schema("name string, kind string").parquet(f"{folder}/written").collect()))
    new = {}
    for name, kind in kinds.items():
        if kind == BUCKETS:
            new[name] = put_in_place(spark, layouts[name], run).table
        elif kind == BUCKET_ROWS:
            new[name] = put_new(spark, layouts[name], run).table
    new.update(read_tables(spark, folder, [n for n, kind in kinds.items() if kind == WHOLE]))
    rows = read_tables(spark, f"{folder}/appended", [n for n, kind in kinds.items() if kind == ROWS])
    new.update({n: tables[n].unionByName(df) for n, df in rows.items()})
    return with_failures(spark, {**tables, **new}, folder)


def with_failures(spark: SparkSession, tables: Tables, folder: str) -> dict[str, DataFrame]:
    """The tables with the failure rows of all tries of a run in the run log."""
    log = tables.get("eod_log")
    for attempt in files.folders(spark, f"{folder}/failed"):
        log = log.unionByName(read_tables(spark, f"{folder}/failed/{attempt}", ["eod_log"])["eod_log"])
    return {**tables, "eod_log": log} if log is not None else dict(tables)
