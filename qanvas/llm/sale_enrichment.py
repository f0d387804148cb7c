"""Sales enriched with the version of their client that was valid when they were made, as a stateful stream.

Rows go to buckets by a hash of the client. A bucket is the key of `applyInPandasWithState`; one tick a bucket and
batch wakes it even if nothing else arrives, and carries the watermarks. A bucket's state is columns of numbers, sorted
by client, time and id, for all its clients: their unpruned versions, and the sales that wait. A sale is resolved by one
`searchsorted` over composite ranks (client, time) for the whole bucket; no row is visited in Python.

Hot clients. A client with more than a share of 2 / `cells` of all rows is split into slices of time, cut at quantiles of
its own rows, so that a slice holds about 1 / `cells` of the rows; slices that follow each other lie in different buckets.
The list of hot clients and cuts has at most 2 * `cells` numbers, whatever the input, and is broadcast. A slice resolves
its sales against its own versions, and passes on one summary row a batch (how many versions it holds, which is its last,
whether that one is older than all that may still be pruned). Adding up the summaries of a client and batch gives the
number of versions held and what the slices before hold; sales that found nothing in their own slice take that.

Plan: rows of all batches are written once under spark.checkpoint.dir, a folder a batch; their largest times give the
watermarks (a few numbers a batch). Each batch's folder is moved into the folder that the stream reads, and the query is
started anew on its one checkpoint until it has read it. The stream's sink is Parquet files with Spark's commit log, so a
repeated micro-batch adds nothing. `buckets` should be a few times the cores of the cluster; it bounds the state in a task.

Defined cases: distinct rows of changes count once, each as a version, also if they share a change_id (then the larger
cents, then the larger operation comes last); changes without valid_at are ignored; repeated sales are sales; sales
without a client hold no version; sales without sold_at are emitted at once without a version; rows whose time of arrival
is null are in the last batch, those from before the first day in the first; changes without a client are late or held
by nobody; null or non-finite balances give null cents; extra columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .common import cut, fresh_path

NULL, NEVER = -(2**63), -(2**63) + 1
TICK, VERSION, SALE = 0, 1, 2
ROWS = "bucket int, kind int, batch int, client long, slice int, t long, id long, cents long, op string, mark long, held long, before long"
OUT = "rec string, id long, batch long, client long, slice int, n_held long, change_id long, cents long, op string, found int, base boolean"
STATE = "versions binary, operations string, waiting binary"
#: Slices of a hot client are cut at some of so many quantiles.
QUANTILES = 1024
_CONF = {
    # Each store that RocksDB opens leaves native memory behind (RocksDB.close there closes no statistics), and each
    # start opens one a partition. The store of files keeps nothing outside the heap, and there only what its task reads.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider",
    # A query runs once a start, so what it has loaded is of no use to the next.
    "spark.sql.streaming.maxBatchesToRetainInMemory": "0",
    # The store's own checksums are enough; a second file beside each of many small ones is not.
    "spark.sql.streaming.checkpoint.fileChecksum.enabled": "false",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "100000",
}


def ranks(*columns: np.ndarray) -> np.ndarray:
    """Dense ranks of rows by their columns, the first one first."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), dtype=np.int64)
    for c in columns:
        s = c[order]
        new[1:] |= s[1:] != s[:-1]
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(new)
    return out


#: Columns of a bucket's versions and waiting sales.
CLIENT, SLICE, TIME, ID, CENTS, OP = range(6)


class Bucket:
    """The versions (columns CLIENT to OP, sorted by all of them) and the waiting sales (CLIENT to ID) of one bucket."""

    def __init__(self, versions: np.ndarray | None = None, operations: list[str] | None = None, waiting: np.ndarray | None = None) -> None:
        self.versions = np.empty((6, 0), dtype=np.int64) if versions is None else versions
        #: The operations by code: sorted, so that codes sort as they do. Code -1 is null.
        self.operations = operations or []
        self.waiting = np.empty((4, 0), dtype=np.int64) if waiting is None else waiting

    def dump(self) -> tuple[bytes, str, bytes]:
        return self.versions.tobytes(), "\n".join(self.operations), self.waiting.tobytes()

    @classmethod
    def load(cls, versions: bytes, operations: str, waiting: bytes) -> Bucket:
        return cls(np.frombuffer(versions, dtype=np.int64).reshape(6, -1), operations.split("\n") if operations else [], np.frombuffer(waiting, dtype=np.int64).reshape(4, -1))

    def add(self, new: np.ndarray, operations: np.ndarray) -> None:
        """New versions (CLIENT to CENTS) and their operations (None for null)."""
        known = sorted({o for o in operations if o is not None}.union(self.operations))
        code = {o: i for i, o in enumerate(known)} | {None: -1}
        moved = np.array([code[o] for o in self.operations] + [-1], dtype=np.int64)
        old = np.vstack([self.versions[:OP], moved[self.versions[OP]]])
        both = np.hstack([old, np.vstack([new, np.array([code[o] for o in operations], dtype=np.int64)])])
        self.versions, self.operations = both[:, np.lexsort(both[::-1])], known

    def step(self, batch: int, mark: int, held: int, before: int, last: bool, new: np.ndarray, operations: np.ndarray, sales: np.ndarray) -> Iterator[pd.DataFrame]:
        """One batch. mark: the changes' watermark; held: up to where versions are pruned (and sales emitted); before:
        the same of the batch before; last: all that waits is emitted."""
        late = new[TIME] < mark
        if late.any():
            yield _frame("late", new[ID][late], batch)
        taken = ~late & (new[CLIENT] != NULL)
        # All but the last version up to `before` were pruned, so each client and slice has one old version at most.
        old = self.versions[:, self.versions[TIME] <= before]
        self.add(new[:, taken], operations[taken])
        waiting = np.hstack([self.waiting, sales])
        go = np.ones(waiting.shape[1], dtype=bool) if last else (waiting[TIME] == NULL) | (waiting[TIME] < held)
        self.waiting = waiting[:, ~go]
        yield from self._emit(batch, old, waiting[:, go])
        self._prune(held)

    def _emit(self, batch: int, old: np.ndarray, sales: np.ndarray) -> Iterator[pd.DataFrame]:
        v, n, m = self.versions, self.versions.shape[1], sales.shape[1]
        client, part = (np.concatenate([v[i], sales[i], old[i]]) for i in (CLIENT, SLICE))
        cell = ranks(client, part)
        of_v, of_s, of_old = cell[:n], cell[n : n + m], cell[n + m :]
        count, base = (np.bincount(x, minlength=cell.max(initial=-1) + 1) for x in (of_v, of_old))
        if sales.shape[1]:
            times = np.unique(v[TIME])
            width = len(times) + 1
            have = of_v * width + np.searchsorted(times, v[TIME]) + 1
            want = of_s * width + np.searchsorted(times, sales[TIME], side="right")
            at = np.searchsorted(have, want, side="right") - 1
            found = at >= 0
            found[found] = of_v[at[found]] == of_s[found]
            yield _frame("sale", sales[ID], batch, sales[CLIENT], sales[SLICE], count[of_s], *self._named(np.where(found, at, -1)), np.where(found, 1, np.where(sales[TIME] == NULL, -1, 0)))
        if (part >= 0).any():
            cells, where = np.unique(cell[part >= 0], return_index=True)
            last = np.where(count[cells] > 0, np.searchsorted(of_v, cells, side="right") - 1, -1)
            yield _frame("cell", np.full(len(cells), NULL), batch, client[part >= 0][where], part[part >= 0][where], count[cells] - base[cells], *self._named(last), (count[cells] > 0).astype(int), base[cells] > 0)

    def _named(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Id, cents and operation of versions by position; null where it is -1."""
        if not self.versions.shape[1]:
            return np.full(len(at), NULL), np.full(len(at), NULL), np.full(len(at), None)
        names = np.array([*self.operations, None], dtype=object)
        return np.where(at < 0, NULL, self.versions[ID][at]), np.where(at < 0, NULL, self.versions[CENTS][at]), np.where(at < 0, None, names[self.versions[OP][at]])

    def _prune(self, held: int) -> None:
        """Of the versions of a client (and slice) up to `held`, all but the last go."""
        v = self.versions
        if v.shape[1]:
            same = (v[CLIENT][1:] == v[CLIENT][:-1]) & (v[SLICE][1:] == v[SLICE][:-1]) & (v[TIME][1:] <= held)
            self.versions = v[:, ~np.append(same, False)]


def _frame(rec: str, ids, batch: int, client=NULL, part=-1, n_held=NULL, change=NULL, cents=NULL, op=None, found=0, base=False) -> pd.DataFrame:
    columns = {"rec": rec, "id": ids, "batch": batch, "client": client, "slice": np.int32(part) if np.isscalar(part) else part.astype(np.int32), "n_held": n_held, "change_id": change, "cents": cents, "op": op, "found": np.int32(found) if np.isscalar(found) else found.astype(np.int32), "base": base}
    return pd.DataFrame(columns, index=range(len(ids)))


def enriched(last: int) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """A tick's batch over one bucket."""

    def of_bucket(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        came = pd.concat(list(rows), ignore_index=True)
        kind = came["kind"].to_numpy()
        tick = came[kind == TICK].iloc[0]
        column = lambda name: came[name].to_numpy(dtype=np.int64)
        numbers = np.vstack([column(c) for c in ("client", "slice", "t", "id", "cents")])
        op = came["op"].to_numpy(dtype=object)[kind == VERSION]
        bucket = Bucket.load(*state.get) if state.exists else Bucket()
        yield from bucket.step(
            int(tick["batch"]), int(tick["mark"]), int(tick["held"]), int(tick["before"]), int(tick["batch"]) == last,
            numbers[:, kind == VERSION], np.where(pd.isna(op), None, op), numbers[:4, kind == SALE],
        )
        state.update(bucket.dump())

    return of_bucket


def micros(c: Column) -> Column:
    """Microseconds since 1970 of a timestamp without a zone."""
    parts = F.unix_date(c.cast("date")).cast("long") * 86_400 + F.hour(c) * 3_600 + F.minute(c) * 60
    return parts * 1_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")


def batch_of(day: Column, batches: int, first_day: int, days: int) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(batches - 1), F.floor((day - first_day) * batches / days))).cast("int")


def _arrivals(sales: DataFrame, changes: DataFrame, batches: int, first_day: int, days: int) -> tuple[DataFrame, DataFrame]:
    """Sales and distinct changes as rows (kind, batch, client, t, id, cents, op)."""
    day = lambda c: F.unix_date(c.cast("date"))
    sold, arrived, valid = (F.col(c).cast("timestamp_ntz") for c in ("sold_at", "arrived_at", "valid_at"))
    client = F.col("client_id").cast("long").alias("client")
    s = sales.select(
        F.lit(SALE).alias("kind"), batch_of(day(arrived), batches, first_day, days).alias("batch"), client, F.coalesce(micros(sold), F.lit(NULL)).alias("t"),
        F.col("sale_id").cast("long").alias("id"), F.lit(NULL).alias("cents"), F.lit(None).cast("string").alias("op"),
    )
    balance = F.col("balance").cast("double")
    finite = balance.isNotNull() & ~F.isnan(balance) & (F.abs(balance) < 9e16)
    v = changes.distinct().where("valid_at IS NOT NULL").select(
        F.lit(VERSION).alias("kind"), batch_of(day(valid) + F.crc32(F.col("change_id").cast("string")) % 4, batches, first_day, days).alias("batch"), client, micros(valid).alias("t"),
        F.col("change_id").cast("long").alias("id"), F.when(finite, F.floor(100 * balance + 0.5).cast("long")).otherwise(F.lit(NULL)).alias("cents"), F.col("op").cast("string").alias("op"),
    )
    return s, v


def hot_clients(rows: DataFrame, cells: int) -> DataFrame:
    """client, bounds (the times at which slices after the first begin) of the clients with 2 slices or more."""
    known = rows.where("client IS NOT NULL")
    counts = cut(known.groupBy("client").count())
    total = counts.agg(F.sum("count")).first()[0] or 1
    # cells / 2 clients at most.
    hot = {r["client"]: r["n"] for r in counts.select("client", F.least(F.lit(QUANTILES), F.floor(F.col("count") * cells / total)).cast("int").alias("n")).where("n >= 2").collect()}
    shares = [i / QUANTILES for i in range(1, QUANTILES)]
    quantiles = known.where((F.col("t") != NULL) & F.col("client").isin(list(hot))).groupBy("client").agg(F.percentile_approx("t", shares, 4 * QUANTILES).alias("q"))
    quantiles = quantiles.withColumn("n", F.create_map(*[F.lit(x) for pair in hot.items() for x in pair])[F.col("client")] if hot else F.lit(1))
    at = F.transform(F.sequence(F.lit(1), F.col("n") - 1), lambda i: F.element_at("q", (i * QUANTILES / F.col("n")).cast("int")))
    return quantiles.select("client", F.array_distinct(at).alias("bounds"))


def placed(rows: DataFrame, hot: DataFrame, buckets: int) -> DataFrame:
    """rows with their slice (-1 for clients that aren't split) and bucket."""
    own = F.xxhash64("id")
    timed = F.when(F.col("t") == NULL, F.pmod(own, F.size("bounds") + 1)).otherwise(F.size(F.filter("bounds", lambda b: b <= F.col("t")))).cast("int")
    sliced = rows.join(F.broadcast(hot), "client", "left").withColumn("slice", F.when(F.col("bounds").isNull(), -1).otherwise(timed)).drop("bounds")
    of_client = F.when(F.col("client").isNull(), own).otherwise(F.xxhash64("client") + F.greatest("slice", F.lit(0)))
    return sliced.withColumn("bucket", F.pmod(of_client, F.lit(buckets)).cast("int"))


@contextmanager
def _settings(spark: SparkSession) -> Iterator[None]:
    """The stream's settings, and this module pickled by value: Spark also loads the processor in a process of the driver
    that needn't have this package on its path."""
    was = {k: spark.conf.get(k, None) for k in _CONF}
    for k, v in _CONF.items():
        spark.conf.set(k, v)
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    try:
        yield
    finally:
        cloudpickle.unregister_pickle_by_value(sys.modules[__name__])
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _move(spark: SparkSession, source: str, target: str) -> None:
    context = spark.sparkContext
    a, b = (context._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    files = a.getFileSystem(context._jsc.hadoopConfiguration())
    files.mkdirs(b.getParent())
    if not files.rename(a, b):
        raise OSError(f"{source} could not be moved to {target}")


def emissions(sales: DataFrame, changes: DataFrame, folder: str, batches: int, first_day: int, days: int, delay_hours: int, buckets: int, cells: int) -> DataFrame:
    """Run the stream over all batches and return what it has written (columns of OUT, NULL for null)."""
    spark = sales.sparkSession
    s, v = _arrivals(sales, changes, batches, first_day, days)
    v = cut(v)
    rows = s.unionByName(v)
    hot = cut(hot_clients(rows, cells))
    blank = [F.lit(NULL).alias(c) for c in ("mark", "held", "before")]
    staged = placed(rows, hot, buckets).withColumn("client", F.coalesce("client", F.lit(NULL))).withColumn("id", F.coalesce("id", F.lit(NULL)))
    staged.select(*_names(ROWS)[:9], *blank, F.col("batch").alias("part")).write.partitionBy("part").parquet(f"{folder}/staged")
    written = spark.read.schema(f"{ROWS}, part int").parquet(f"{folder}/staged")
    largest = {(r["kind"], r["part"]): r["t"] for r in written.where(F.col("t") != NULL).groupBy("kind", "part").agg(F.max("t").alias("t")).collect()}
    marks: dict[int, list[int]] = {}
    for kind in (VERSION, SALE):
        times = [NEVER]
        for b in range(batches):
            times.append(max(times[-1], largest.get((kind, b), NULL) - delay_hours * 3_600_000_000 if (kind, b) in largest else NEVER))
        marks[kind] = times
    held = [min(x) for x in zip(marks[VERSION], marks[SALE], strict=True)][:batches]
    # After the last batch nothing is pruned or late any more.
    by_batch = {"mark": [*marks[VERSION][:batches], NEVER], "held": [*held, NEVER], "before": [NEVER, *held]}
    ticks = spark.range(buckets * (batches + 1)).select((F.col("id") % buckets).cast("int").alias("bucket"), F.floor(F.col("id") / buckets).cast("int").alias("batch"))
    looked = [F.element_at(F.array(*map(F.lit, x)), F.col("batch") + 1).alias(k) for k, x in by_batch.items()]
    ticks = ticks.select(
        "bucket", F.lit(TICK).alias("kind"), "batch", F.lit(NULL).alias("client"), F.lit(-1).alias("slice"), *[F.lit(NULL).alias(c) for c in ("t", "id", "cents")], F.lit(None).cast("string").alias("op"), *looked
    )
    ticks.withColumn("part", F.col("batch")).coalesce(1).write.partitionBy("part").mode("append").parquet(f"{folder}/staged")
    with _settings(spark):
        for b in range(batches + 1):
            _move(spark, f"{folder}/staged/part={b}", f"{folder}/in/{b}")
            arrived = spark.readStream.schema(ROWS).parquet(f"{folder}/in/*")
            out = arrived.groupBy("bucket").applyInPandasWithState(enriched(batches), OUT, STATE, "append", GroupStateTimeout.NoTimeout)
            run = out.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").outputMode("append").trigger(availableNow=True).start()
            run.awaitTermination()
    return spark.read.schema(OUT).parquet(f"{folder}/out")


def joined_slices(out: DataFrame) -> DataFrame:
    """Emitted sales of split clients with what the client's other slices hold."""
    cells = out.where("rec = 'cell'")
    of = Window.partitionBy("client", "batch")
    before = of.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    last = F.when(F.col("found") > 0, F.struct("change_id", "cents", "op"))
    seen = cells.select(
        "client", "batch", "slice", F.last(last, ignorenulls=True).over(before).alias("prior"), F.max(F.when(F.col("base"), F.col("slice"))).over(of).alias("base_slice"),
        (F.sum("n_held").over(of) + F.max(F.col("base").cast("long")).over(of)).alias("held"),
    )
    sales = out.where("rec = 'sale' AND slice >= 0").join(seen, ["client", "batch", "slice"])
    older = F.coalesce(F.col("base_slice") > F.col("slice"), F.lit(False))
    own = (F.col("found") > 0) & ~older
    passed = (F.col("found") == 0) & F.coalesce(F.col("base_slice") < F.col("slice"), F.lit(True))
    pick = lambda c: F.when(own, F.col(c)).when(passed, F.col(f"prior.{c}"))
    return sales.select("rec", "id", "batch", F.col("held").alias("n_held"), *[pick(c).alias(c) for c in ("change_id", "cents", "op")])


def enrich(
    sales: DataFrame, changes: DataFrame, batches: int = 12, first_day: int = 19723, days: int = 152, delay_hours: int = 0, buckets: int = 128, cells: int = 2048
) -> DataFrame:
    """rec, id, batch, n_held, change_id, balance_cents, op: a row per sale and per late change."""
    folder = fresh_path(sales.sparkSession, "enrichment")
    out = emissions(sales, changes, folder, batches, first_day, days, delay_hours, buckets, cells)
    plain = out.where("rec = 'late' OR rec = 'sale' AND slice < 0").select("rec", "id", "batch", "n_held", "change_id", "cents", "op")
    both = plain.unionByName(joined_slices(out))
    known = lambda c: F.nullif(F.col(c), F.lit(NULL))
    return both.select("rec", known("id").alias("id"), "batch", known("n_held").alias("n_held"), known("change_id").alias("change_id"), known("cents").alias("balance_cents"), "op")
