"""Per-call context: the HMIS inputs and the silver/gold layers built on them.

Silver and gold are written once as tables (see ``sources.layers``) and read
by every query, as in a medallion lakehouse; ``materialize=False`` builds
them as plain lazy plans instead.
"""

from __future__ import annotations

from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haven.functions.privacy import hash_and_drop_client
from haven.operators import conform, history, quality, star
from haven.operators.keys import first_by_key, first_of_repeated
from haven.sources.clustered import manifest, read_within
from haven.sources.fixtures import Hmis
from haven.sources.layers import layer_path


def _has_jvm(spark: SparkSession) -> bool:
    try:
        return spark.sparkContext._jsc is not None
    except Exception:
        return False


class Ctx:
    def __init__(self, spark: SparkSession, sf_dir: str, materialized: bool | None = None):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.raw = Hmis(spark, sf_dir)
        if materialized is None:
            # a session can ask for whole lazy plans (e.g. to explain a query end to end);
            # without JVM access (a remote session) layers cannot be published, so plans stay lazy
            materialized = (spark.conf.get("haven.layers.materialize", "true").lower() != "false"
                            and _has_jvm(spark))
        self.materialized = materialized

    def _path(self, name: str, build, tables: list[str], cluster_by: list[str] | None = None, gate=None,
              hashes: list[str] | None = None) -> str:
        inputs = [f"{self.sf_dir}/{t}.parquet" for t in tables]
        return layer_path(self.spark, name, build, inputs, cluster_by, gate, hashes)

    def _layer(self, name: str, build, tables: list[str], **options) -> DataFrame:
        if not self.materialized:
            return build()
        return self.spark.read.parquet(self._path(name, build, tables, **options))

    def _silver(self, table: str, key: str, conformed, inputs: list[str]) -> DataFrame:
        """A conformed input; published only when it reconciles and leaks nothing."""
        bronze = getattr(self.raw, table)
        if not self.materialized:
            return conformed(bronze)
        counted, seen = quality.observed_input(bronze, key)
        return self._layer(f"silver_{table}", lambda: conformed(counted), inputs,
                           gate=lambda silver: quality.observed_gate(table, seen, silver))

    @cached_property
    def silver_clients(self) -> DataFrame:
        return self._silver("clients", "ClientID", conform.conform_clients, ["customer"])

    @cached_property
    def silver_enrollments(self) -> DataFrame:
        first = first_of_repeated if self.materialized else first_by_key
        return self._silver("enrollments", "EnrollmentID", partial(conform.conform_enrollments, first=first), ["orders"])

    @cached_property
    def silver_services(self) -> DataFrame:
        return self._silver("services", "ServiceID", conform.conform_services, ["lineitem", "orders"])

    @cached_property
    def silver_projects(self) -> DataFrame:
        return self._silver("projects", "ProjectID", conform.conform_projects, ["nation"])

    def prebuild(self, *names: str) -> None:
        """Build independent layers concurrently: each is its own Spark job, and
        the scheduler fills cores one build leaves idle (e.g. while another
        scans a single split)."""
        if not self.materialized or len(names) < 2:
            for n in names:
                getattr(self, n)
            return
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=len(names)) as pool:
            for f in [pool.submit(getattr, self, n) for n in names]:
                f.result()

    def _build_fact(self) -> DataFrame:
        self.prebuild("silver_services", "silver_enrollments", "silver_projects")
        return star.fact_service_event(self.silver_services, self.silver_enrollments, self.silver_projects)

    @cached_property
    def _fact_path(self) -> str:
        return self._path("fact_service_event", self._build_fact, ["lineitem", "orders", "nation"],
                          cluster_by=["service_date", "project_id"], hashes=["client_id_hash"],
                          gate=lambda fact: quality.gold_gate(fact, self.silver_services))

    @cached_property
    def fact(self) -> DataFrame:
        return self.spark.read.parquet(self._fact_path) if self.materialized else self._build_fact()

    def fact_within(self, **ranges) -> DataFrame:
        """Fact rows within ``column=(least, greatest)`` of the clustering columns, from the files that may hold them."""
        if self.materialized:
            return read_within(self.spark, self._fact_path, **ranges)
        fact = self.fact
        for c, (lo, hi) in ranges.items():
            fact = fact if lo is None else fact.filter(F.col(c) >= F.lit(lo))
            fact = fact if hi is None else fact.filter(F.col(c) <= F.lit(hi))
        return fact

    def last_service_date(self):
        """From the manifest: no file of the fact is opened."""
        if self.materialized:
            return manifest(self.spark, self._fact_path).agg(F.max("hi_service_date")).first()[0]
        return self.fact.agg(F.max("service_date")).first()[0]

    @cached_property
    def client_history(self) -> DataFrame:
        """SCD2 client dimension from the case-update change stream (gold)."""
        return self._layer("client_history",
                           lambda: history.scd2_history(self.silver_clients,
                                                        hash_and_drop_client(self.raw.case_updates)),
                           ["customer", "events"], cluster_by=["client_id_hash", "valid_from"])
