"""Operator tests on tiny literal frames — one per defect/decision row."""

from __future__ import annotations

import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from haven import contracts as C
from haven.functions.events import first_present
from haven.functions import privacy
from haven.functions.privacy import hash_id
from haven.operators import care, conform, governance, keys, quality, star
from haven.operators.envelope import split_dead_letters


def _clients(spark, rows):
    return spark.createDataFrame(rows, C.CLIENTS)


def test_hash_null_stays_null_and_matches_sha256(spark):
    import hashlib
    df = spark.createDataFrame([("C1",), (None,)], "v string").select(hash_id("v").alias("h"))
    got = sorted([r.h for r in df.collect()], key=str)
    assert got[0] is None or got[1] is None
    assert hashlib.sha256(b"C1").hexdigest() in got


def test_name_hash_uses_first_and_last(spark):
    """M3: both name parts feed the hash; null only when both are null."""
    import hashlib
    rows = [("C1", "Ann", "Lee", "1", dt.date(1980, 1, 1), "Female", "Asian", "Non-Hispanic", 0, "a@x.org"),
            ("C2", None, None, "2", None, "Male", "White", "Non-Hispanic", 1, None)]
    out = {r.ClientID_hash: r for r in conform.conform_clients(_clients(spark, rows)).collect()}
    c1 = out[hashlib.sha256(b"C1").hexdigest()]
    assert c1.Name_hash == hashlib.sha256(b"Ann\x1fLee").hexdigest()
    assert c1.YearOfBirth == 1980
    c2 = out[hashlib.sha256(b"C2").hexdigest()]
    assert c2.Name_hash is None and c2.YearOfBirth is None


def test_silver_drops_pii_and_raw_id(spark):
    """M20: no raw PII and no raw ClientID in silver."""
    rows = [("C1", "Ann", "Lee", "1", dt.date(1980, 1, 1), "Female", "Asian", "Non-Hispanic", 0, "a@x.org")]
    cols = set(conform.conform_clients(_clients(spark, rows)).columns)
    assert not cols & set(C.FORBIDDEN_DOWNSTREAM)


def test_bad_date_text_becomes_null_not_failure(spark):
    """F2 under ANSI mode: unparseable text gives NULL."""
    df = spark.createDataFrame([("E1", "C1", "P1", "2020-02-30", None, None, "x", "Self", 0),
                                ("E2", "C1", "P1", "2020-01-05", "bad", None, "x", "Self", 0)],
                               "EnrollmentID string, PersonalID string, ProjectID string, EntryDate string, "
                               "ExitDate string, Destination string, LivingSituation string, "
                               "RelationshipToHoH string, DisablingCondition int")
    got = {r.EnrollmentID: r for r in conform.conform_enrollments(df).collect()}
    assert got["E1"].EntryDate is None
    assert got["E2"].EntryDate == dt.date(2020, 1, 5) and got["E2"].ExitDate is None


def test_dedupe_is_deterministic_and_total(spark):
    """E1: survivor chosen by tie columns then the whole row — same on every run."""
    rows = [("S1", "E1", "C1", dt.date(2020, 1, 2), "Meal", 1, Decimal("1.00"), 5, 1),
            ("S1", "E1", "C1", dt.date(2020, 1, 1), "Meal", 2, Decimal("2.00"), 3, 9),
            ("S2", "E1", "C1", dt.date(2020, 1, 1), "Meal", 3, Decimal("3.00"), 1, 1)]
    schema = C.SERVICES.fields
    df = spark.createDataFrame(rows, "ServiceID string, EnrollmentID string, PersonalID string, "
                                     "DateProvided date, ServiceType string, QuantityOfServices int, "
                                     "FAAmount decimal(12,2), _tie1 bigint, _tie2 bigint")
    assert schema  # contract exists
    for parts in (1, 3):
        got = {r.ServiceID: r.QuantityOfServices
               for r in conform.conform_services(df.repartition(parts)).collect()}
        assert got == {"S1": 2, "S2": 3}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 5), st.integers(0, 5)),
                min_size=1, max_size=25))
def test_first_by_key_idempotent_and_one_per_key(spark, rows):
    df = spark.createDataFrame(rows, "k string, o int, v int")
    once = keys.first_by_key(df, ["k"], ["o"])
    twice = keys.first_by_key(once, ["k"], ["o"])
    a = sorted(once.collect())
    assert a == sorted(twice.collect())
    assert len(a) == len({r[0] for r in rows})
    for r in a:
        assert r.o == min(o for k, o, _ in rows if k == r.k)


def test_orphan_project_keeps_id_with_null_type(spark):
    """M7: the enrollment's project id survives; FK check sees it."""
    s = spark.createDataFrame([("S1", "E1", dt.date(2020, 1, 1), "Meal", 1, Decimal("1.00"), "h")],
                              "ServiceID string, EnrollmentID string, DateProvided date, ServiceType string, "
                              "QuantityOfServices int, FAAmount decimal(12,2), PersonalID_hash string")
    e = spark.createDataFrame([("E1", "P9999")], "EnrollmentID string, ProjectID string")
    p = spark.createDataFrame([("P0001", 1)], "ProjectID string, ProjectType int")
    f = star.fact_service_event(s, e, p).collect()[0]
    assert f.project_id == "P9999" and f.project_type is None
    v = quality.fk_violations(star.fact_service_event(s, e, p), "project_id", p, "ProjectID", "fk").collect()
    assert [(r.key_value, r.n_rows) for r in v] == [("P9999", 1)]


def test_dim_date_drops_null_dates(spark):
    """M8: a null service date is not a calendar row."""
    f = spark.createDataFrame([(dt.date(2020, 3, 1),), (None,)], "service_date date")
    got = star.dim_date(f).collect()
    assert len(got) == 1 and got[0].date_key == 20200301 and got[0].quarter == 1


def test_ingest_twice_fact_unchanged(spark, sf_dir):
    """M1: projects appended twice to bronze must not double fact rows."""
    from haven.plans.context import Ctx
    ctx = Ctx(spark, sf_dir)
    once = star.fact_service_event(ctx.silver_services, ctx.silver_enrollments,
                                   conform.conform_projects(ctx.raw.projects)).count()
    twice_bronze = ctx.raw.projects.unionByName(ctx.raw.projects)
    twice = star.fact_service_event(ctx.silver_services, ctx.silver_enrollments,
                                    conform.conform_projects(twice_bronze)).count()
    assert once == twice


def test_reconcile_uses_distinct_keys(spark):
    """M2: a rerun that doubles bronze raw rows does not fail the gate."""
    bronze = spark.createDataFrame([("a",), ("a",), ("b",), ("b",)], "k string")
    silver = spark.createDataFrame([("a",), ("b",)], "k string")
    r = quality.reconcile_counts("t", bronze, "k", silver).collect()[0]
    assert r.status == "OK" and r.raw_duplicates == 2 and r.drift == 0.0


def test_suite_one_pass_counts(spark):
    df = spark.createDataFrame([("s1", 1), ("s1", 101), (None, 5)], "service_id string, qty int")
    rules = [quality.not_null("service_id"), quality.unique("service_id"), quality.between("qty", 1, 100)]
    got = {(r.rule, r.column_name): r.n_bad for r in quality.run_suite(df, "t", rules).collect()}
    assert got == {("not_null", "service_id"): 1, ("unique", "service_id"): 1, ("between", "qty"): 1}


@pytest.mark.parametrize("role,expect", [
    (C.ROLE_CASEWORKER, "abcdef0123456789"), (C.ROLE_ANALYST, "abcdef01..."),
    (C.ROLE_HUD, "AGG"), ("R_SOMEONE", None)])
def test_mask_by_role(spark, role, expect):
    df = spark.createDataFrame([("abcdef0123456789", "P1")], "client_id_hash string, project_id string")
    assert governance.mask(df, role).collect()[0].client_id_hash == expect


def test_row_access_without_grants_is_empty_and_hud_sees_agg(spark):
    df = spark.createDataFrame([("h1", "P1"), ("h2", "P2")], "client_id_hash string, project_id string")
    grants = spark.createDataFrame([("u1", "P1")], "user_name string, project_id string")
    assert governance.secure_view(df, grants, "nobody", C.ROLE_ANALYST).count() == 0
    mine = governance.secure_view(df, grants, "u1", C.ROLE_ANALYST).collect()
    assert [(r.project_id, r.client_id_hash) for r in mine] == [("P1", "h1...")]
    hud = governance.secure_view(df, grants, "nobody", C.ROLE_HUD).collect()
    assert len(hud) == 2 and {r.client_id_hash for r in hud} == {"AGG"}


def test_dead_letter_split_keeps_every_bad_message(spark):
    """I6/M16: malformed, scalar, array and non-UTF-8 go to the DLQ with a reason."""
    raw = spark.createDataFrame([("7B2261223A317D",), ("7B2261223A",), ("3432",), ("5B315D",), ("7B2280227D",)],
                                "h string").select(F.unhex("h").cast("string").alias("raw"))
    good, dead = split_dead_letters(raw, "raw")
    assert good.count() == 1
    assert sorted(r.reason for r in dead.collect()) == sorted(
        ["malformed_json", "not_an_object", "not_an_object", "invalid_utf8"])


def test_event_type_falls_back_on_empty_string(spark):
    """B11: '' counts as missing, like a falsy value."""
    df = spark.createDataFrame([("", "NEW_CONTACT"), ("CHECKIN", "x"), (None, None)], "a string, b string")
    got = [r.t for r in df.select(first_present("a", "b").alias("t")).collect()]
    assert got == ["NEW_CONTACT", "CHECKIN", None]


def test_dense_key_is_dense_at_any_size(spark):
    """Exactly 0..n-1 in key order, twice over, well past any sampling size."""
    n = 400_000
    df = spark.range(0, n, 1, 8).select(F.format_string("%08d", F.col("id") * 7919 % n).alias("k"))
    for _ in range(2):
        out = keys.dense_key(df, ["k"], "key")
        got = out.agg(F.count(F.lit(1)), F.countDistinct("key"), F.min("key"), F.max("key"),
                      F.sum((F.col("k").cast("long") != F.col("key")).cast("int"))).first()
        assert tuple(got) == (n, n, 0, n - 1, 0)


def test_published_code_lists_are_whole():
    assert (len(C.DESTINATIONS), len(C.LIVING_SITUATIONS), len(C.ENCOUNTER_TYPES)) == (10, 14, 4)
    assert set(C.PERMANENT_DESTINATIONS) < set(C.DESTINATIONS) and len(C.PERMANENT_DESTINATIONS) == 4


def test_name_hash_keeps_the_names_apart(spark):
    rows = [("Ann", "Alee"), ("Anna", "lee"), ("Ann Lee", "Smith"), ("Ann", "Lee Smith"), ("Lee", None), (None, "Lee"), (None, None)]
    df = spark.createDataFrame(rows, "a string, b string")
    got = [r.h for r in df.select(privacy.name_hash("a", "b").alias("h")).collect()]
    assert len(set(got)) == len(rows) and got[-1] is None


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="0123456789abcdef", min_size=64, max_size=64), min_size=1, max_size=8),
       st.sampled_from([C.ROLE_ANALYST, C.ROLE_HUD, "R_PUBLIC"]))
def test_masked_output_never_holds_a_full_hash(spark, hashes, role):
    df = spark.createDataFrame([(h, "P1") for h in hashes], "client_id_hash string, project_id string")
    for r in governance.mask(df, role).collect():
        assert r.client_id_hash is None or len(r.client_id_hash) <= 11
        assert r.client_id_hash not in hashes


def test_hashes_are_packed_and_unpacked_in_order(spark):
    rows = spark.range(50).select(privacy.hash_id(F.col("id").cast("string")).alias("h")).union(
        spark.createDataFrame([(None,)], "h string"))
    got = rows.select("h", privacy.packed("h").alias("p"), privacy.unpacked(privacy.packed("h")).alias("u")).collect()
    assert all(r.h == r.u for r in got) and {len(r.p) for r in got if r.p is not None} == {32}
    assert [r.h for r in sorted((r for r in got if r.h), key=lambda r: bytes(r.p))] == sorted(r.h for r in got if r.h)


@pytest.mark.parametrize("few", [0, 1000])
def test_first_of_repeated_picks_as_first_by_key(spark, monkeypatch, few):
    monkeypatch.setattr(keys, "FEW_REPEATED", few)
    rows = [(None, 2, "x"), (None, 1, "y"), ("a", 5, "p"), ("a", 5, "o"), ("b", None, "z"), ("c", 1, None), ("c", 1, None), ("d", 1, "q")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    want = sorted(map(str, keys.first_by_key(df, ["k"], ["o"]).collect()))
    got = keys.first_of_repeated(df, ["k"], ["o"])
    assert sorted(map(str, got.collect())) == want and len(want) == 5
    once = df.filter("k in ('b', 'd')")
    assert sorted(map(str, keys.first_of_repeated(once, ["k"]).collect())) == sorted(map(str, once.collect()))


@pytest.fixture()
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_first_by_key_dealt_picks_as_first_by_key(spark, small_batches):
    some = lambda i, n, v: None if i * 7 % n == 0 else v
    rows = [(None if i % 9 == 0 else "hot" if i % 3 else f"k{i % 11}", some(i, 5, i % 4), some(i, 6, dt.date(2024, 1, 1 + i % 3)),
             some(i, 4, "é" if i % 2 else "Z"), some(i, 3, bytes([200 + i % 5, 1])), some(i, 8, Decimal(i % 3) / 2)) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, o long, d date, s string, h binary, m decimal(12,2)").repartition(3)
    for order in (["o", "d"], ["s", "m"], None):
        want = sorted(map(str, keys.first_by_key(df, ["k"], order).collect()))
        assert sorted(map(str, keys.first_by_key_dealt(df, "k", order).collect())) == want
    assert keys.first_by_key_dealt(df.limit(0), "k").count() == 0
    other = df.withColumn("x", F.col("o").cast("double"))  # a type that is not ordered alike: the plain aggregate
    assert sorted(map(str, keys.first_by_key_dealt(other, "k").collect())) == sorted(map(str, keys.first_by_key(other, ["k"]).collect()))


def test_duplicate_keys_counts_across_batches(spark, small_batches):
    rows = [(None if i % 10 == 0 else "hot" if i % 2 else f"k{i % 60}",) for i in range(500)] + [("once",)]
    df = spark.createDataFrame(rows, "id string").repartition(3)
    want = sorted(str(("t", r.id, r["count"])) for r in df.groupBy("id").count().filter("count > 1").collect())
    got = quality.duplicate_keys(df, "id", "t")
    assert got.columns == ["table_name", "key_value", "n_copies"] and dict(got.dtypes)["n_copies"] == "bigint"
    assert sorted(str(tuple(r)) for r in got.collect()) == want
    assert quality.duplicate_keys(df.limit(0), "id", "t").count() == 0


def test_no_task_holds_the_keys_of_a_whole_split(spark):
    """Before rows are dealt by key they are neither sorted nor put into a hash table."""
    services = spark.range(20).select(*[F.col("id").cast("string").alias(c) for c in (
        "ServiceID", "EnrollmentID", "PersonalID", "ServiceType", "QuantityOfServices", "FAAmount")], F.current_date().alias("DateProvided"))
    for df in (quality.duplicate_keys(services, "ServiceID", "t"), conform.conform_services(services)):
        above, _, below = _dealt(df).rpartition("Exchange")
        assert "Aggregate" in above and "MapInArrow" in below and "Aggregate" not in below and "Sort" not in below


def _dealt(df) -> str:
    """The exchanges of a plan, with what lies below them."""
    return df._jdf.queryExecution().executedPlan().toString()


def test_personal_hashes_are_dealt_as_bytes(spark):
    """A hash of 64 letters does not go through a shuffle as text."""
    s = spark.createDataFrame([("S1", "E1", "2020-01-01", "Meal", 1, 1, "C1")],
                              "ServiceID string, EnrollmentID string, DateProvided string, ServiceType string, "
                              "QuantityOfServices int, FAAmount int, PersonalID string")
    plan = _dealt(conform.conform_services(s))
    assert plan.index("lower(hex(") < plan.index("Exchange") < plan.index("unhex(sha2(")
    assert conform.conform_services(s).first().PersonalID_hash == hashlib.sha256(b"C1").hexdigest()


def test_first_seen_is_dealt_as_bytes(spark):
    h = hashlib.sha256(b"C1").hexdigest()
    enc = spark.createDataFrame([("e1", h, "2020-01-02"), ("e2", "00" * 32, "2020-01-02")],
                                "event_id string, client_id_hash string, day string").withColumn(
        "event_time", F.col("day").cast("timestamp"))
    fact = spark.createDataFrame([(h, "2020-01-01"), (h, "2020-01-03"), (None, "2020-01-01")], "client_id_hash string, day string") \
        .select("client_id_hash", F.col("day").cast("date").alias("service_date"))
    out = care.client_seen_before(enc, fact)
    plan = _dealt(out)
    assert plan.index("lower(hex(") < plan.index("unhex(")
    assert sorted((r.event_id, r.client_id_hash, r.seen_before) for r in out.collect()) == [("e1", h, True), ("e2", "00" * 32, False)]


def test_foreign_keys_are_counted_before_the_join(spark):
    child = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("b",), ("b",), (None,)], "p string")
    out = quality.fk_violations(child, "k", parent, "p", "fk")
    plan = _dealt(out)
    assert plan.index("LeftAnti") < plan.index("HashAggregate")
    assert [tuple(r) for r in out.collect()] == [("fk", "a", 2)]
