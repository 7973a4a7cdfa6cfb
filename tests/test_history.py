"""SCD2 history, merge, as-of join and keyed upsert."""

from __future__ import annotations

import datetime as dt
import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from haven.operators import history, upsert

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def _base(spark, ids):
    return spark.createDataFrame([(i, "Female", "Asian", "Non-Hispanic", 0, 1980) for i in ids],
                                 "ClientID_hash string, Gender string, Race string, Ethnicity string, "
                                 "VeteranStatus int, YearOfBirth int")


def _updates(spark, rows):
    return spark.createDataFrame(
        [(f"CU-{i}", op, c, f, v, T0 + dt.timedelta(minutes=m)) for i, (op, c, f, v, m) in enumerate(rows)],
        "event_id string, op string, client_id_hash string, field_changed string, new_value string, "
        "event_time timestamp")


def test_scd2_rules(spark):
    """Tie on time -> last event id wins; no-op collapses; unknown client left out;
    delete op ignored; half-open intervals chained."""
    ups = _updates(spark, [
        ("u", "a", "HousingStatus", "stable", 10),
        ("u", "a", "HousingStatus", "stable", 20),        # no-op
        ("u", "a", "ContactStatus", "engaged", 30),
        ("u", "a", "ContactStatus", "lost_contact", 30),  # same instant, later id wins
        ("d", "a", "HousingStatus", "x", 40),             # not an op we apply
        ("u", "zz", "HousingStatus", "stable", 10),       # unknown client
    ])
    h = history.scd2_history(_base(spark, ["a", "b"]), ups).orderBy("client_id_hash", "valid_from").collect()
    a = [r for r in h if r.client_id_hash == "a"]
    assert [r.version for r in a] == [1, 2, 3]
    assert a[1].HousingStatus == "stable" and a[1].ContactStatus is None
    assert a[2].HousingStatus == "stable" and a[2].ContactStatus == "lost_contact"
    assert a[0].valid_to == a[1].valid_from and a[1].valid_to == a[2].valid_from
    assert a[2].is_current and a[2].valid_to is None
    assert [r.version for r in h if r.client_id_hash == "b"] == [1]
    assert not [r for r in h if r.client_id_hash == "zz"]
    keys = lambda: [r.client_version_key for r in history.with_version_key(
        history.scd2_history(_base(spark, ["a", "b"]), ups)).orderBy("client_id_hash", "valid_from").collect()]
    assert len(set(keys())) == 4 and keys() == keys()


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.sampled_from(["HousingStatus", "ContactStatus"]),
                          st.sampled_from(["x", "y"]), st.integers(0, 30)), min_size=1, max_size=20),
       st.integers(1, 19))
def test_merge_in_two_loads_equals_one_shot(spark, rows, cut):
    """Backdated events in the second load re-derive the touched clients."""
    full = _updates(spark, [("u", c, f, v, m) for c, f, v, m in rows])
    first = full.filter(F.substring("event_id", 4, 9).cast("int") < cut)
    second = full.filter(F.substring("event_id", 4, 9).cast("int") >= cut)
    base = _base(spark, ["a", "b"])
    one = history.scd2_history(base, full)
    h1 = history.scd2_history(base, first)
    merged, _ = history.merge_history(h1, history.collapse(first), base, second)
    cols = one.columns
    assert sorted(one.collect()) == sorted(merged.select(*cols).collect())
    # intervals per client are disjoint and gap-free
    for c in ("a", "b"):
        rs = sorted([r for r in one.collect() if r.client_id_hash == c], key=lambda r: r.valid_from)
        for x, y in zip(rs, rs[1:]):
            assert x.valid_to == y.valid_from


def test_as_of_join_picks_the_version_in_force(spark):
    ups = _updates(spark, [("u", "a", "HousingStatus", "stable", 10), ("u", "a", "HousingStatus", "lost", 20)])
    h = history.scd2_history(_base(spark, ["a"]), ups)
    ev = spark.createDataFrame(
        [("e1", "a", T0 + dt.timedelta(minutes=5)), ("e2", "a", T0 + dt.timedelta(minutes=10)),
         ("e3", "a", T0 + dt.timedelta(minutes=25)), ("e4", "q", T0)],
        "event_id string, client_id_hash string, event_time timestamp")
    got = {r.event_id: (r.version, r.HousingStatus)
           for r in history.as_of_join(ev, h, carry=["version", "HousingStatus"]).collect()}
    assert got == {"e1": (1, None), "e2": (2, "stable"), "e3": (3, "lost")}


def test_upsert_moves_partition_and_is_idempotent(spark, scratch):
    """I1/M18: a row whose date changes leaves its old partition; replay is a no-op."""
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    tbl = spark.createDataFrame([("s1", d1, 1), ("s2", d1, 2)], "service_id string, service_date date, qty int")
    upsert.write_partitioned(tbl, scratch, "service_date")
    batch = spark.createDataFrame([("s1", d2, 5), ("s3", d2, 7)], "service_id string, service_date date, qty int")
    for _ in range(2):
        upsert.upsert(spark, scratch, batch, "service_id", "service_date")
        got = sorted((r.service_id, r.service_date, r.qty) for r in spark.read.parquet(scratch).collect())
        assert got == [("s1", d2, 5), ("s2", d1, 2), ("s3", d2, 7)]
    # moving the last row out empties the partition, which is then removed
    upsert.upsert(spark, scratch, spark.createDataFrame([("s2", d2, 2)], "service_id string, service_date date, "
                                                                         "qty int"), "service_id", "service_date")
    got = spark.read.parquet(scratch)
    assert got.filter(F.col("service_date") == d1).count() == 0 and got.count() == 3


def test_keys_stable_across_runs(spark, sf_dir):
    """Surrogate keys are content-derived: identical across runs and partitionings."""
    from haven.plans.context import Ctx
    from haven.operators import star
    a = star.dim_client(Ctx(spark, sf_dir).silver_clients)
    b = star.dim_client(Ctx(spark, sf_dir).silver_clients.repartition(7))
    ka = {r.client_id_hash: r.client_key for r in a.collect()}
    kb = {r.client_id_hash: r.client_key for r in b.collect()}
    assert ka == kb and len(set(ka.values())) == len(ka)


def _store_rows(store):
    return sorted(tuple(r) for r in store.history().select("client_id_hash", "version", "valid_from", "valid_to", "HousingStatus",
                                                           "ContactStatus", "client_version_key").collect())


def test_store_rewrites_only_touched_buckets(spark, scratch):
    """Untouched buckets keep their files; merges equal one shot; old versions stay readable."""
    from haven.operators.history_store import HistoryStore
    ids = [f"c{i}" for i in range(40)]
    base = _base(spark, ids)
    rows = [("u", f"c{i % 40}", "HousingStatus" if i % 3 else "ContactStatus", f"v{i % 4}", i % 50) for i in range(200)]
    full = _updates(spark, rows)
    number = F.substring("event_id", 4, 9).cast("int")
    store = HistoryStore(spark, scratch, buckets=8)
    store.create(base, full.filter(number < 150))
    before, first = store.manifest(), _store_rows(store)
    one = full.filter((number >= 150) & (F.col("client_id_hash") == "c3"))  # backdated for one client
    files = set(store.history().inputFiles())
    touched = store.merge(base, one)
    after = store.manifest()
    assert len(touched) == 1 and {k for k in after if after[k] != before.get(k)} == {(k, b) for k in ("history", "log") for b in touched}
    assert len(set(store.history().inputFiles()) & files) >= len(files) - len([f for f in files if f"_bucket={min(touched)}/" in f])
    store.merge(base, full.filter((number >= 150) & (F.col("client_id_hash") != "c3")))
    whole = HistoryStore(spark, f"{scratch}-one", buckets=8)
    whole.create(base, full)
    assert _store_rows(store) == _store_rows(whole)
    assert sorted(tuple(r) for r in store.log().collect()) == sorted(tuple(r) for r in whole.log().collect())
    assert store.merge(base, full.limit(0)) == set() and store.version() == 2
    assert len(store.history(version=0).collect()) == len(first)


def test_store_ignores_a_merge_that_died(spark, scratch):
    from haven.operators.history_store import HistoryStore
    base = _base(spark, ["a", "b"])
    store = HistoryStore(spark, scratch, buckets=2)
    store.create(base, _updates(spark, [("u", "a", "HousingStatus", "x", 1)]))
    before = _store_rows(store)
    # data written, manifest begun but not finished
    spark.createDataFrame([("history", 0, "nowhere")], "kind string, bucket int, folder string").write.parquet(f"{scratch}/manifests/000001")
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{scratch}/manifests/000001/_SUCCESS")
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, False)
    assert store.version() == 0 and _store_rows(store) == before


def test_upsert_reads_only_candidate_partitions(spark, scratch):
    """The key index names the old partitions; null keys do not double; a foreign write rebuilds the index."""
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(30)]
    schema = "k string, d date, v int"
    rows = {f"k{i}": (days[i % 30], i) for i in range(300)}
    path = f"{scratch}/t"
    upsert.create(spark.createDataFrame([(k, d, v) for k, (d, v) in rows.items()], schema), path, "k", "d", buckets=8)

    def read():
        return sorted((r.k or "", r.d, r.v) for r in spark.read.parquet(path).collect())

    def names():
        return {f for f in spark.read.parquet(path).inputFiles()}
    before = names()
    batch = spark.createDataFrame([("k5", days[6], -1), ("new", days[7], -2), (None, days[8], -3)], schema)
    for _ in range(3):
        assert upsert.index_buckets(spark, path, spark.read.parquet(path)) == 8
        upsert.upsert(spark, path, batch, "k", "d")
        rows.update({"k5": (days[6], -1), "new": (days[7], -2), "": (days[8], -3)})
        assert read() == sorted((k, d, v) for k, (d, v) in rows.items())
    gone = {f.split("d=")[1][:10] for f in before - names()}
    assert gone == {str(days[i]) for i in (5, 6, 7, 8)}  # nothing else was rewritten
    # only the buckets of the batch's keys are opened
    few = upsert._own_buckets(spark, path, spark.createDataFrame([("k5",)], "_key string"), 8)
    assert {r.bucket for r in few.select("bucket").distinct().collect()} == {
        spark.createDataFrame([("k5",)], "k string").select(upsert._bucket(F.col("k"), 8)).first()[0]}
    # somebody else appends: the index no longer tells of the table's files
    spark.createDataFrame([("k777", days[1], 9)], schema).write.mode("append").partitionBy("d").parquet(path)
    assert upsert.index_buckets(spark, path, spark.read.parquet(path)) is None
    upsert.upsert(spark, path, spark.createDataFrame([("k777", days[2], 10)], schema), "k", "d")
    rows["k777"] = (days[2], 10)
    assert read() == sorted((k, d, v) for k, (d, v) in rows.items())


def test_partition_values_are_escaped(spark, scratch):
    path = f"{scratch}/t"
    schema = "k string, p string, v int"
    upsert.create(spark.createDataFrame([("a", "x=1/y", 1), ("b", "plain", 2)], schema), path, "k", "p")
    upsert.upsert(spark, path, spark.createDataFrame([("a", "plain", 3)], schema), "k", "p")
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("k", "p", "v").collect()) == [("a", "plain", 3), ("b", "plain", 2)]


def test_upsert_deals_hashes_as_bytes_and_indexes_without_a_shuffle_by_key(spark, scratch):
    import glob

    import pyarrow.parquet as pq
    day, path, schema = lambda n: dt.date(2024, 1, n), f"{scratch}/t", "k string, d date, h string"
    h = lambda i: hashlib.sha256(str(i).encode()).hexdigest()
    rows = [(None, day(1), h(0)), (None, day(1), h(1)), (None, None, None), ("a", day(1), h(2)), ("b", day(2), None), ("c", None, h(3))]
    df = spark.createDataFrame(rows, schema)
    upsert.create(df, path, "k", "d", buckets=4, hashes=["h"])
    read = lambda: sorted((tuple(r) for r in spark.read.parquet(path).select("k", "d", "h").collect()), key=str)
    assert read() == sorted(rows, key=str)
    index = lambda: sorted(((r.key, r.part) for r in spark.read.parquet(f"{path}__keys/rows").collect()), key=str)
    assert index() == sorted({r[:2] for r in rows}, key=str)  # a null key: one row a partition
    batch = [("a", day(2), h(9)), (None, day(3), h(8)), ("new", None, None)]
    upsert.upsert(spark, path, spark.createDataFrame(batch, schema), "k", "d", hashes=["h"])
    rows = [r for r in rows if r[0] not in ("a", None)] + batch
    assert read() == sorted(rows, key=str) and index() == sorted({r[:2] for r in rows}, key=str)
    for at in (path, f"{path}__keys/rows"):
        files = glob.glob(f"{at}/*/*.parquet")
        assert files and {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}
    keyed = upsert._index_rows(df.filter("k is not null"), "k", "d", 4)._jdf.queryExecution().executedPlan().toString()
    assert keyed.count("Exchange") <= 1  # that of the null keys' rows alone


def test_batch_keys_are_looked_up_by_hash(spark):
    """Rows that meet a batch's keys, nulls and repeats among them, are neither sorted nor paired."""
    schema = "k string, v int"
    held = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("a", 4)], schema)
    keys = upsert._keys(spark.createDataFrame([("a", 0), ("a", 1), (None, 2), (None, 3), ("x", 4)], schema), "k")
    for how, want in (("left_semi", [1, 3, 4]), ("left_anti", [2])):
        got = held.join(keys, F.col("k").eqNullSafe(F.col("_key")), how)
        assert sorted(r.v for r in got.collect()) == want
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "Sort" not in plan


def test_folders_of_a_table_are_listed_by_few_tasks(spark, scratch):
    name, most = upsert.LISTING
    n, own, sc = most + 6, spark.conf.get(name, None), spark.sparkContext
    upsert.write_partitioned(spark.range(n).selectExpr("id AS p", "id AS v").coalesce(1), scratch, "p", mode="errorifexists")
    try:
        for given in ("1000", "7", None):
            spark.conf.unset(name) if given is None else spark.conf.set(name, given)
            sc.setJobGroup(group := f"listing-{given}", "")
            assert upsert.read_table(spark, scratch).count() == n
            assert spark.conf.get(name, None) == given  # the session's own setting is back
            track = sc.statusTracker()
            tasks = [track.getStageInfo(s).numTasks for j in track.getJobIdsForGroup(group) for s in track.getJobInfo(j).stageIds
                     if track.getStageInfo(s)]
            assert tasks and max(tasks) <= most
    finally:
        sc._jsc.clearJobGroup()
        spark.conf.unset(name) if own is None else spark.conf.set(name, own)
