"""Sale enrichment: a plain simulation of the rules against the buckets and against the stream."""

import math
import random
import zlib
from collections import Counter
from datetime import datetime, timedelta

import numpy as np
import pytest

from qanvas.llm import sale_enrichment as E
from qanvas.llm.sale_enrichment import NEVER, NULL

START = datetime(2024, 1, 1)


def number(day, batches=12, first=19723, days=152):
    return max(0, min(batches - 1, math.floor((day - first) * batches / days)))


def day_of(t):
    return (t - datetime(1970, 1, 1)).days


def simulate(sales, changes, batches=12):
    """(rec, id, batch, n_held, change_id, balance_cents, op) by the rules, one batch after another, a client at a time."""
    by_s, by_v = {}, {}
    for s in sales:
        by_s.setdefault(batches - 1 if s["arrived_at"] is None else number(day_of(s["arrived_at"]), batches), []).append(s)
    for v in {tuple(c.items()) for c in changes}:
        v = dict(v)
        if v["valid_at"] is not None:
            late = None if v["change_id"] is None else zlib.crc32(str(v["change_id"]).encode()) % 4
            by_v.setdefault(batches - 1 if late is None else number(day_of(v["valid_at"]) + late, batches), []).append(v)
    low = datetime.min
    marks = lambda by, key, b: max((r[key] for k in range(b) for r in by.get(k, []) if r[key] is not None), default=low)
    held, waiting, out = {}, [], []
    order = lambda v: (v["valid_at"], -1 if v["change_id"] is None else v["change_id"])

    def emit(s, b):
        own = held.get(s["client_id"], []) if s["client_id"] is not None else []
        fit = [v for v in own if s["sold_at"] is not None and v["valid_at"] <= s["sold_at"]]
        v = max(fit, key=order) if fit else {"change_id": None, "balance": None, "op": None}
        cents = None if v["balance"] is None or not math.isfinite(v["balance"]) else math.floor(100 * v["balance"] + 0.5)
        out.append(("sale", s["sale_id"], b, len(own), v["change_id"], cents, v["op"]))

    for b in range(batches):
        mark = marks(by_v, "valid_at", b)
        h = min(mark, marks(by_s, "sold_at", b))
        for v in by_v.get(b, []):
            if v["valid_at"] < mark:
                out.append(("late", v["change_id"], b, None, None, None, None))
            elif v["client_id"] is not None:
                held.setdefault(v["client_id"], []).append(v)
        waiting += by_s.get(b, [])
        for s in [s for s in waiting if s["sold_at"] is None or s["sold_at"] < h]:
            emit(s, b)
        waiting = [s for s in waiting if s["sold_at"] is not None and s["sold_at"] >= h]
        for c, own in held.items():
            old = sorted((v for v in own if v["valid_at"] <= h), key=order)
            held[c] = old[-1:] + [v for v in own if v["valid_at"] > h]
    for s in waiting:
        emit(s, batches)
    return Counter(out)


def shop(seed, n_sales, n_changes, clients, days=110, hot=0.4):
    """Rows with ties, late arrivals, nulls and one hot client."""
    rng = random.Random(seed)
    moment = lambda: START + timedelta(hours=rng.randrange(24 * days))
    who = lambda: None if rng.random() < 0.04 else 1 if rng.random() < hot else rng.randrange(clients)
    sales = []
    for i in range(n_sales):
        sold = moment()
        arrived = sold + timedelta(hours=rng.choice([0, 1, 5, 200, 700]))
        sales.append({"sale_id": i, "client_id": who(), "sold_at": None if rng.random() < 0.05 else sold, "arrived_at": None if rng.random() < 0.01 else arrived})
    changes = [{"change_id": i, "client_id": who(), "valid_at": None if rng.random() < 0.05 else moment(), "op": rng.choice([None, "I", "U", "D"]), "balance": rng.choice([None, 1.005, -3.5, 12.34, float("nan"), float("inf")])} for i in range(n_changes)]
    return [*sales, *sales[:5]], [*changes, *changes[:5]]


SALES, CHANGES = "sale_id long, client_id long, sold_at timestamp_ntz, arrived_at timestamp_ntz", "change_id long, client_id long, valid_at timestamp_ntz, op string, balance double"


def run(spark, sales, changes, **kw):
    s = spark.createDataFrame([tuple(r.values()) for r in sales], SALES)
    v = spark.createDataFrame([tuple(r.values()) for r in changes], CHANGES)
    rows = E.enrich(s, v, **kw).collect()
    return Counter(tuple(r[c] for c in ("rec", "id", "batch", "n_held", "change_id", "balance_cents", "op")) for r in rows)


@pytest.fixture(scope="module")
def few(spark):
    """Few state partitions, so that a start of the stream is cheap."""
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", was)


def test_hot_clients_are_split_and_nothing_changes(few):
    """Slices of the hot client lie in many buckets; clients with a slice or two as well; rows with nulls and ties."""
    sales, changes = shop(1, 500, 400, 20)
    assert run(few, sales, changes, batches=4, buckets=8, cells=64) == simulate(sales, changes, 4)


def test_empty_tables_and_clashing_columns(few):
    from pyspark.sql import functions as F

    sales, changes = shop(2, 30, 20, 3)
    s = few.createDataFrame([tuple(r.values()) for r in sales], SALES).select("*", *[F.lit(1).alias(c) for c in ("batch", "slice", "t", "kind", "bucket", "part", "id", "rec")])
    v = few.createDataFrame([tuple(r.values()) for r in changes], CHANGES)
    got = E.enrich(s, v.limit(0), batches=2, buckets=2).collect()
    assert Counter((r["id"], r["batch"]) for r in got) == Counter((x[1], x[2]) for x in simulate(sales, [], 2).elements())
    assert {(r["n_held"], r["change_id"]) for r in got} == {(0, None)}
    assert E.enrich(s.limit(0), v.limit(0), batches=2, buckets=2).count() == 0


def columns(rows, keys):
    micro = lambda t: NULL if t is None else int((t - datetime(1970, 1, 1)) / timedelta(microseconds=1))
    return np.array([[NULL if r[k] is None else micro(r[k]) if isinstance(r[k], datetime) else r[k] for k in keys] for r in rows], dtype=np.int64).reshape(-1, len(keys)).T


def test_a_bucket_resolves_by_the_rules():
    """One bucket with all clients, many random shops, no Spark: state goes through its bytes between batches."""
    for seed in range(25):
        sales, changes = shop(seed, 60, 60, 4, hot=0)
        changes = [{**c, "cents": NULL if c["balance"] is None or not math.isfinite(c["balance"]) else math.floor(100 * c["balance"] + 0.5), "slice": -1} for c in {tuple(c.items()): c for c in changes}.values() if c["valid_at"] is not None]
        micro = lambda t: int((t - datetime(1970, 1, 1)) / timedelta(microseconds=1))
        v_batch = [number(day_of(c["valid_at"]) + zlib.crc32(str(c["change_id"]).encode()) % 4) for c in changes]
        s_batch = [11 if s["arrived_at"] is None else number(day_of(s["arrived_at"])) for s in sales]
        state, before, got = E.Bucket().dump(), NEVER, []
        for b in range(13):
            mark = max((micro(c["valid_at"]) for c, k in zip(changes, v_batch, strict=True) if k < b), default=NEVER)
            held = min(mark, max((micro(s["sold_at"]) for s, k in zip(sales, s_batch, strict=True) if k < b and s["sold_at"]), default=NEVER))
            if b == 12:
                mark = held = NEVER
            new = [c for c, k in zip(changes, v_batch, strict=True) if k == b]
            bucket = E.Bucket.load(*state)
            frames = bucket.step(b, mark, held, before, b == 12, columns(new, ("client_id", "slice", "valid_at", "change_id", "cents")), np.array([c["op"] for c in new], dtype=object), columns([{**s, "slice": -1} for s, k in zip(sales, s_batch, strict=True) if k == b], ("client_id", "slice", "sold_at", "sale_id")))
            for f in frames:
                for r in f.itertuples(index=False):
                    known = lambda x: None if x == NULL else int(x)
                    got.append((r.rec, known(r.id), r.batch, known(r.n_held), known(r.change_id), known(r.cents), r.op))
            state, before = bucket.dump(), held
        assert Counter(got) == simulate(sales, [{k: c[k] for k in ("change_id", "client_id", "valid_at", "op", "balance")} for c in changes]), seed


def test_micros_need_no_zone(spark):
    was = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        t = datetime(2024, 3, 31, 2, 30, 15, 123456)
        df = spark.createDataFrame([(t,)], "t timestamp_ntz")
        assert df.select(E.micros(df["t"]).alias("m")).first()["m"] == int((t - datetime(1970, 1, 1)) / timedelta(microseconds=1))
    finally:
        spark.conf.set("spark.sql.session.timeZone", was)


def test_no_start_opens_a_store_that_leaves_native_memory_behind(few, tmp_path):
    """RocksDB's statistics stay in native memory with each store that is opened, one a partition and start."""
    sales, changes = shop(3, 40, 30, 3)
    s, v = few.createDataFrame([tuple(r.values()) for r in sales], SALES), few.createDataFrame([tuple(r.values()) for r in changes], CHANGES)
    E.emissions(s, v, str(tmp_path / "run"), 2, 19723, 152, 0, 2, 16)
    kept = [p.name for p in (tmp_path / "run" / "state" / "state").rglob("*") if p.is_file() and not p.name.startswith(".")]
    assert any(n.endswith(".delta") for n in kept) and not any(n.endswith((".zip", ".changelog", ".sst")) for n in kept)
