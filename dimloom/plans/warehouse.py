"""The warehouse: versioned parquet tables, load modes, the run log and the
whole run (S5, S9, S10, A7, D1-D3, E1-E3).

Publishing without transactions: rows are first written as a batch, a folder of its
own under ``<root>/<table>/_data``. A version, ``<root>/<table>/v00001`` ..., holds a
small manifest that names its batches, how many rows and bytes of text each has (counted
while it was written) and on which columns the table's rows are unique. Readers take the
newest version, so a batch is no part of the table until a version names it, a failed or
half-written one is never read, and a path being read is never overwritten.

``begin()`` holds back new versions: this warehouse then reads its own pending
ones, others read what was published. ``commit()`` publishes them, dimensions before
the fact; ``rollback()`` forgets them. A run audits what is pending before it commits.

Batches of the fact are split into parts by the hash of the event id and have a Bloom
filter, so that a load opens only the parts that may hold one of its ids
(``operators.membership``).
"""

from __future__ import annotations

import datetime as dt
import json
import traceback
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimloom.functions.dates import calendar
from dimloom.operators import audit as A
from dimloom.operators.clean import CleanConfig, clean, write_profiled
from dimloom.operators.dims import DimSpec, insert_new, keyed_dimension
from dimloom.operators.fact import fact_view, fits_broadcast, load_fact
from dimloom.operators.keys import Keyed, size_aggregates, size_stats
from dimloom.operators.membership import Members, held_parts
from dimloom.operators.observed import observed
from dimloom.session import remove_path
from dimloom.sources.contracts import (
    FACT_RENAMES, FOREIGN_KEYS, PRIMARY_KEYS, SCHEMAS, WIDTHS, cast_losses, conform, cut_widths, not_null_columns)

FACT = "Fact_Terror_Events"
LOG = "ETLLog"


MANIFEST = "_manifest.json"
# A version of more batches than this has the smaller half of them merged by the next append.
MOST_BATCHES = 32
# Tables whose batches are split by the hash of a column and have a filter over it.
FILTERED = {FACT: "EventID"}


@dataclass(frozen=True)
class Batch:
    """A written folder of a table's rows. ``rows`` and ``text_bytes`` are None for a plain folder."""

    path: str
    rows: int | None = None
    text_bytes: int | None = None
    members: dict | None = None  # its filter, as ``membership.Members`` keeps it


@dataclass(frozen=True)
class Version:
    batches: tuple[Batch, ...] = ()
    # Columns in which no two rows of the version agree (empty: not known).
    unique_on: tuple[str, ...] = ()


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._text = jvm.org.apache.commons.io.IOUtils
        self._fs = self._Path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._pending: dict[str, Version] | None = None

    # -- versions ---------------------------------------------------------
    def _numbers(self, name: str) -> list[int]:
        base = self._Path(f"{self.root}/{name}")
        if not self._fs.exists(base):
            return []
        names = [st.getPath().getName() for st in self._fs.listStatus(base) if st.isDirectory()]
        return sorted(int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit())

    def current_path(self, name: str) -> str | None:
        """The newest published version: one with a manifest, or a plain folder of rows."""
        for n in reversed(self._numbers(name)):
            path = f"{self.root}/{name}/v{n:05d}"
            if any(self._fs.exists(self._Path(path, mark)) for mark in (MANIFEST, "_SUCCESS")):
                return path
        return None

    def version(self, name: str) -> Version | None:
        """What this warehouse reads: a pending version, or the newest published one."""
        if self._pending is not None and name in self._pending:
            return self._pending[name]
        path = self.current_path(name)
        if path is None:
            return None
        manifest = self._Path(path, MANIFEST)
        if not self._fs.exists(manifest):
            return Version((Batch(path),))
        stream = self._fs.open(manifest)
        try:
            got = json.loads(self._text.toString(stream, "UTF-8"))
        finally:
            stream.close()
        batches = [Batch(f"{self.root}/{name}/{b['path']}", b["rows"], b["text_bytes"], b["members"]) for b in got["batches"]]
        return Version(tuple(batches), tuple(got["unique_on"]))

    def _publish(self, name: str, version: Version) -> str:
        base = f"{self.root}/{name}/"
        batches = [{**asdict(b), "path": b.path.removeprefix(base)} for b in version.batches]
        text = json.dumps({"batches": batches, "unique_on": version.unique_on}, indent=1)
        path = f"{base}v{max(self._numbers(name), default=0) + 1:05d}"
        draft = self._Path(path, f"{MANIFEST}.{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if self._fs.exists(self._Path(path, MANIFEST)) or not self._fs.rename(draft, self._Path(path, MANIFEST)):
            raise RuntimeError(f"{path} was published by another run")
        return path

    def _set(self, name: str, version: Version) -> None:
        if self._pending is None:
            self._publish(name, version)
        else:
            self._pending[name] = version

    # -- staged runs --------------------------------------------------------
    def begin(self) -> None:
        self._pending = {}

    def commit(self) -> None:
        """Publish the pending versions: the fact last, so that its keys are there."""
        pending, self._pending = self._pending or {}, None
        for name in sorted(pending, key=lambda n: n == FACT):
            self._publish(name, pending[name])

    def rollback(self) -> None:
        self._pending = None

    def unpublished(self, name: str) -> tuple[Batch, ...]:
        """Batches of the pending version that no published one holds."""
        if self._pending is None or name not in self._pending:
            return ()
        pending = self._pending[name]
        own = Warehouse(self.spark, self.root).version(name) or Version()
        held = {b.path for b in own.batches}
        return tuple(b for b in pending.batches if b.path not in held)

    # -- reads ------------------------------------------------------------
    def exists(self, name: str) -> bool:
        return self.version(name) is not None

    def read(self, name: str, batches) -> DataFrame:
        """The rows of some batches, or an empty frame of the contract schema."""
        paths = [b.path for b in batches]
        if not paths:
            return self.spark.createDataFrame([], SCHEMAS[name])
        return _folders(self.spark, SCHEMAS[name], paths)

    def table(self, name: str) -> DataFrame:
        """Current version, or an empty frame of the contract schema."""
        return self.read(name, (self.version(name) or Version()).batches)

    def is_empty(self, name: str) -> bool:
        """No rows (reads at most one row, or none where the version knows)."""
        version = self.version(name) or Version()
        if all(b.rows is not None for b in version.batches):
            return not sum(b.rows for b in version.batches)
        return self.table(name).isEmpty()

    def keyed(self, name: str) -> Keyed:
        """The table with its row count, text bytes and the columns it is unique on, as published
        with its version (counted only for a folder without a manifest)."""
        version, df = self.version(name) or Version(), self.table(name)
        if all(b.rows is not None for b in version.batches):
            rows, text_bytes = (sum(getattr(b, c) for b in version.batches) for c in ("rows", "text_bytes"))
        else:
            rows, text_bytes = size_stats(df)
        return Keyed(df, rows, SCHEMAS[name].fields[0].name, text_bytes, version.unique_on)

    # -- writes -----------------------------------------------------------
    def write_batch(self, name: str, df: DataFrame, at_most: int | None = None) -> Batch:
        """Write rows that are no part of the table yet, counted as they are written.
        ``at_most``: a bound on their number, which spares a filtered table's count of them."""
        shaped = conform(df, SCHEMAS[name], cut_widths(name))
        path = f"{self.root}/{name}/_data/{uuid.uuid4().hex}"
        seen = Observation()
        shaped, writer = shaped.observe(seen, *size_aggregates(shaped)), None
        if name in FILTERED:
            rows = shaped.count() if at_most is None else at_most
            members = Members.sized(FILTERED[name], rows, f"{self.root}/{name}/_filters/{uuid.uuid4().hex}")
            writer = members.split(shaped).write.partitionBy(members.PART)
        (writer or shaped.write).parquet(path)
        got = observed(seen)
        n, size = (int(got["n"]), int(got["b"])) if got else size_stats(self.read(name, [Batch(path)]))
        batch = Batch(path, n, size)
        if name in FILTERED and batch.rows:
            members.write(self.read(name, [batch]))
            batch = replace(batch, members=asdict(members))
        return batch

    def publish(self, name: str, df: DataFrame, unique_on: tuple[str, ...] = ()) -> None:
        """Replace the table's rows; the version before stays readable until done."""
        batch = self.write_batch(name, df)
        self._set(name, Version((batch,) if batch.rows else (), unique_on))

    def append(self, name: str, df: DataFrame, unique_on: tuple[str, ...] = (), at_most: int | None = None) -> Batch:
        """A new version with these rows as well. ``unique_on``: columns on which they are unique and
        differ from the rows that are there; the table keeps the claim if it held before."""
        before = self.version(name) or Version()
        batch = self.write_batch(name, df, at_most)
        if batch.rows:
            held = not before.batches or before.unique_on == unique_on
            self._set(name, Version((*self._merged(name, before.batches), batch), unique_on if held else ()))
        elif self.version(name) is None:
            self._set(name, Version((), unique_on))
        return batch

    def _merged(self, name: str, batches: tuple[Batch, ...]) -> tuple[Batch, ...]:
        """Few batches: beyond MOST_BATCHES the smaller half becomes one, so each row is rewritten few times."""
        if len(batches) <= MOST_BATCHES or any(b.rows is None for b in batches):
            return batches
        few = sorted(batches, key=lambda b: b.rows)[: len(batches) // 2]
        one = self.write_batch(name, self.read(name, few), sum(b.rows for b in few))
        return (*(b for b in batches if b not in few), one)

    def append_line(self, name: str, df: DataFrame) -> None:
        """Append to a table that keeps no versions, such as the log: files are added to one folder."""
        path = self.current_path(name) or f"{self.root}/{name}/v00001"
        conform(df, SCHEMAS[name], cut_widths(name)).write.mode("append").parquet(path)

    def reset(self, names) -> None:
        """Empty the given tables (fact first, then dimensions)."""
        for name in names:
            self._set(name, Version())


def _folders(spark: SparkSession, schema: T.StructType, paths) -> DataFrame:
    """All rows under some folders; names of folders below them are no columns."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*paths)


@dataclass
class StepResult:
    step: str
    status: int  # 1 done, 0 nothing to do, -1 failed
    rows: int
    message: str


class EtlLog:
    """Append-only run log; a failure to log never fails the load."""

    def __init__(self, wh: Warehouse):
        self.wh = wh
        self._next_id: int | None = None  # read once, then counted locally

    def append(self, action: str, message: str, now: dt.datetime | None = None, rows: int | None = None) -> bool:
        try:
            if self._next_id is None:
                self._next_id = (self.wh.table(LOG).agg(F.max("ETLLogID")).first()[0] or 0) + 1
            next_id = self._next_id
            ts = F.lit(now) if now is not None else F.current_timestamp()
            row = self.wh.spark.range(1).select(
                F.lit(next_id).cast("long").alias("ETLLogID"), ts.cast("timestamp").alias("ETLDateAndTime"),
                F.lit(action[:100]).alias("ETLAction"),
                F.lit((message if rows is None else f"{message} ({rows} rows)")[:2000]).alias("ETLLogMessage"))
            self.wh.append_line(LOG, row)
            self._next_id += 1
            return True
        except Exception:  # noqa: BLE001 -- logging is best effort by design
            return False


def log_view(log: DataFrame) -> DataFrame:
    """The log with a long date ('Thursday, July 24, 2025') and 'HH:mm' time."""
    return log.select(
        "ETLLogID",
        F.date_format("ETLDateAndTime", "EEEE, MMMM d, yyyy").alias("ETLDate"),
        F.date_format("ETLDateAndTime", "HH:mm").alias("ETLTime"),
        "ETLAction", "ETLLogMessage")


def load_dimension(wh: Warehouse, staging: DataFrame, spec: DimSpec, mode: str | None = None) -> StepResult:
    """D1-D3 for one dimension.

    insert_new: members whose natural key is new, keys continuing after the
    largest existing key; if_empty: load only into an empty table, else do
    nothing (status 0); refresh: replace the table, keys from 1.
    """
    mode = mode or spec.load_mode
    if mode == "refresh":
        keyed = keyed_dimension(staging, spec)
        wh.publish(spec.name, keyed.df, spec.unique_on)
        return StepResult(spec.name, 1, keyed.rows, "refreshed")
    if mode not in ("insert_new", "if_empty"):
        raise ValueError(f"unknown load mode {mode}")
    empty = wh.is_empty(spec.name)
    if mode == "if_empty" and not empty:
        return StepResult(spec.name, 0, 0, "not empty; nothing loaded")
    # All members are new to an empty table.
    fresh = keyed_dimension(staging, spec) if empty else insert_new(staging, spec, wh.table(spec.name))
    if fresh.rows:
        wh.append(spec.name, fresh.df, spec.unique_on)
    return StepResult(spec.name, 1, fresh.rows, "new members inserted" if fresh.rows else "no new members")


def load_date_dimension(wh: Warehouse) -> StepResult:
    """D-Date: the full calendar, loaded when the table is empty."""
    if not wh.is_empty("DimDate"):
        return StepResult("DimDate", 0, 0, "not empty; nothing loaded")
    wh.publish("DimDate", calendar(wh.spark), ("DateKey",))
    return StepResult("DimDate", 1, wh.keyed("DimDate").rows, "calendar filled")


def load_fact_table(wh: Warehouse, staging: DataFrame, specs, lookups, columns, order_by, written: bool = False) -> StepResult:
    """F1 + F2: resolve events against the dimensions and append the events not yet in
    the fact. Rows that can't be loaded (``reject_reason``) are written to a rejects
    folder with their reason and counted in the message.

    The resolved batch is written first, and counted as it is: its exact size then
    decides how the existing fact is consulted. Of that, only the parts that
    the filters of its batches don't rule out are opened. ``written``: see ``operators.fact.dedupe``."""
    dims = {spec.name: wh.keyed(spec.name) for spec in specs}
    # No lookup drops events: what an inner one would lose is rejected with a reason.
    lookups = [replace(lk, how="left") for lk in lookups]
    view = fact_view(staging, dims, lookups, columns, order_by, written=written).withColumnsRenamed(FACT_RENAMES)
    shaped = conform(view.withColumn("__lost", cast_losses(view, SCHEMAS[FACT])), _BATCH)
    reason, seen = reject_reason(), Observation()
    counts = [F.count(F.lit(1)).alias("n"), F.count(reason).alias("rejected"), F.coalesce(F.sum("__lost"), F.lit(0)).alias("lost")]
    counted = shaped.observe(seen, *counts)
    path = f"{wh.root}/_batches/{uuid.uuid4().hex}"
    counted.write.mode("errorifexists").parquet(path)
    candidates = wh.spark.read.schema(_BATCH).parquet(path)
    totals = observed(seen) or candidates.agg(*counts).first().asDict()
    rejected = int(totals["rejected"])
    # Rows that break the contract go to a rejects folder and are counted,
    # instead of failing the whole load.
    if rejected:
        rejects = candidates.withColumn("reason", reason).where(F.col("reason").isNotNull())
        rejects.drop("__lost").write.mode("errorifexists").parquet(f"{wh.root}/_rejects/{FACT}/{uuid.uuid4().hex}")
    ok = candidates.where(reason.isNull()).drop("__lost")
    n = int(totals["n"]) - rejected
    before = wh.version(FACT) or Version()
    existing, opened, parts = existing_ids(wh, ok, n, before)
    # Ids of the batch are known to none of the fact's rows where no part may hold one: nothing to join then.
    fresh = load_fact(ok, existing, SCHEMAS[FACT], {}, view_rows=n) if opened else conform(ok, SCHEMAS[FACT])
    batch = wh.append(FACT, fresh, ("EventID",), at_most=n)
    remove_path(wh.spark, path)
    return StepResult(FACT, 1, batch.rows, f"parts of the fact opened: {opened} of {parts}; values lost in casts {totals['lost']}; rejected {rejected}")


def existing_ids(wh: Warehouse, incoming: DataFrame, rows: int, version: Version) -> tuple[DataFrame, int, int]:
    """The ids of those parts of the fact that may hold an id of ``incoming``, how many parts
    that is, and of how many. Batches without a filter are read whole."""
    known = [b for b in version.batches if b.members]
    plain = [b for b in version.batches if not b.members]
    parts = sum(b.members["parts"] for b in known)
    paths = held_parts(wh.spark, incoming, rows, [(b.path, Members(**b.members)) for b in known])
    schema = T.StructType([SCHEMAS[FACT]["EventID"]])
    ids = _folders(wh.spark, schema, paths) if paths else wh.spark.createDataFrame([], schema)
    if plain:
        ids = ids.unionByName(wh.read(FACT, plain).select("EventID"))
    return ids, len(paths) + len(plain), parts + len(plain)


# The fact's columns, all nullable, as a batch holds them before rejects are taken out.
_BATCH = T.StructType([T.StructField(f.name, f.dataType, True) for f in SCHEMAS[FACT].fields]
                      + [T.StructField("__lost", T.IntegerType(), True)])


def reject_reason() -> Column:
    """Why a resolved event can't be a fact row, or NULL (the first reason that holds)."""
    return (F.when(F.col("EventID").isNull(), F.lit("no event id"))
            .when(F.length("EventID") > WIDTHS[FACT]["EventID"], F.lit("event id over width"))
            .when(F.col("DateKey").isNull(), F.lit("date outside the calendar"))
            .when(F.col("LocationKey").isNull(), F.lit("no location")))


def audit_keys(wh: Warehouse, specs, batches: tuple[Batch, ...] | None = None) -> list[StepResult]:
    """Q5-Q7: foreign keys, primary key and NOT NULL columns of the fact, or of some batches of it,
    whose ids must then be new to the rest as well. A step's rows are its violations; any
    violation fails the step."""
    fact = wh.table(FACT) if batches is None else wh.read(FACT, batches)
    refs = []
    for column, dim, key in FOREIGN_KEYS:
        if dim == "DimDate" or any(s.name == dim for s in specs):
            refs.append((column, dim, wh.table(dim), key, None))

    def step(name: str, bad: int, what: str) -> StepResult:
        return StepResult(name, -1 if bad else 1, bad, f"{what}: {bad}")

    orphans = A.reference_violations(fact, refs).agg(F.sum("orphan_rows")).first()[0] or 0
    repeated = A.unique_violations(fact, PRIMARY_KEYS[FACT]).count()
    if batches:
        paths = {b.path for b in batches}
        rest = Version(tuple(b for b in wh.version(FACT).batches if b.path not in paths))
        rows = sum(b.rows or 0 for b in batches)
        old = existing_ids(wh, fact, rows, rest)[0]
        known = fits_broadcast(wh.spark, rows, T.StructType([SCHEMAS[FACT]["EventID"]]))
        ids = fact.select("EventID")
        repeated += old.join(F.broadcast(ids) if known else ids, "EventID", "left_semi").count()
    nulls = A.null_violations({FACT: fact}, {FACT: not_null_columns(FACT)}).agg(F.sum("null_rows")).first()[0] or 0
    return [step("audit_references", int(orphans), "orphan keys"), step("audit_unique", repeated, "repeated event ids"),
            step("audit_not_null", int(nulls), "missing required values")]


def run_warehouse(spark: SparkSession, raw: DataFrame, root: str, specs, lookups, columns, order_by,
                  refresh: bool = True, protect=()) -> DataFrame:
    """The whole load as a list of steps with status 1 / 0 / -1.

    Unlike a script that carries on after a failure, a failed step skips the
    steps that depend on it (dimensions need staging; the fact needs them all).
    Nothing is published before the fact's new rows have passed the key audits: if a step
    fails or an audit finds violations, all tables stay as they were.
    Returns (step, status, rows, message) as a small DataFrame.
    """
    wh = Warehouse(spark, root)
    log = EtlLog(Warehouse(spark, root))  # the log is written whatever becomes of the run
    results: list[StepResult] = []

    def attempt(name, fn) -> StepResult:
        try:
            return fn()
        except Exception as e:  # noqa: BLE001 -- recorded as a failed step
            traceback.print_exc()
            return StepResult(name, -1, 0, f"{type(e).__name__}: {e}")

    def record(res: StepResult) -> bool:
        results.append(res)
        log.append(res.step, res.message, rows=res.rows)
        return res.status >= 0

    def run(name, fn):
        return record(attempt(name, fn))

    staging_path = f"{wh.root}/_staging/{uuid.uuid4().hex}"

    dropped: list[str] = []

    def do_stage():
        # Written once up to the drop list, with its NULLs counted; the sparse columns are
        # dropped on read.
        cfg = CleanConfig(protect=tuple(protect))
        profile = write_profiled(clean(raw, "rename", cfg), staging_path)
        dropped.extend(profile.sparse(cfg.sparse_threshold, cfg.protect)[0])
        return StepResult("staging", 1, profile.rows, f"cleaned and staged; sparse columns dropped: {dropped}")

    if not run("staging", do_stage):
        return _as_frame(spark, results)
    staging = spark.read.parquet(staging_path).drop(*dropped)
    if callable(order_by):  # an order over whatever columns the staging table has
        order_by = order_by(staging.columns)
    wh.begin()
    if refresh:
        names = [FACT] + [s.name for s in specs] + ["DimDate"]
        run("reset", lambda: (wh.reset(names), StepResult("reset", 1, 0, "tables emptied"))[1])
    dims_ok = run("DimDate", lambda: load_date_dimension(wh))
    # Dimension loads are independent small jobs: run them concurrently, then
    # record results (and log lines) in spec order.
    with ThreadPoolExecutor(max_workers=min(8, max(1, len(specs)))) as pool:
        done = list(pool.map(lambda spec: attempt(spec.name, lambda: load_dimension(wh, staging, spec)), specs))
    for res in done:
        dims_ok = record(res) and dims_ok
    clean_run = False
    if dims_ok:
        loaded = attempt(FACT, lambda: load_fact_table(wh, staging, specs, lookups, columns, order_by, written=True))
        audits: list[StepResult] = []
        if loaded.status >= 0:
            try:
                audits = audit_keys(wh, specs, wh.unpublished(FACT))
            except Exception as e:  # noqa: BLE001 -- recorded as a failed step
                traceback.print_exc()
                audits = [StepResult("audit_references", -1, 0, f"{type(e).__name__}: {e}")]
            clean_run = all(a.status >= 0 for a in audits)
            if not clean_run:
                kept = ", ".join(b.path for b in wh.unpublished(FACT))
                loaded = StepResult(FACT, -1, 0, f"not published, the audits failed; rows kept in {kept}")
        if clean_run:
            published = attempt(FACT, lambda: (wh.commit(), loaded)[1])
            loaded, clean_run = published, published.status >= 0
        for res in (loaded, *audits):
            record(res)
    if not clean_run:
        wh.rollback()
    remove_path(spark, staging_path)
    return _as_frame(spark, results)


def _as_frame(spark: SparkSession, results: list[StepResult]) -> DataFrame:
    return spark.createDataFrame([(i + 1, r.step, r.status, r.rows, r.message) for i, r in enumerate(results)],
                                 "seq int, step string, status int, rows long, message string")
