"""The current posts as a hash-bucketed table with copy-on-write upserts (SNK-03, SNK-04, JON-01).

Rows lie in ``buckets`` files by the hash that Spark's own bucketed tables and shuffles use, one file a bucket. An upsert
merges its batch into one row per key, sends only that to the buckets, and joins it with the files of the buckets it touches:
the target is neither shuffled nor are other buckets read or written. Each task of the join holds one bucket and writes its
new file; then the files of the touched buckets change places with the old ones. A journal names both sides before
anything moves, so an upsert that was cut short is finished by the next open, and an upsert that is run again gives the same table.

Two policies: ``update`` (existing keys take the batch's mutable columns, the others keep their first-written values) and
``first`` (first write wins on all columns). One writer at a time. Pick ``buckets`` so that a bucket is some 256 MB; ``rebucketed`` deals a
grown table anew.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentiflow.operators.merge import dedup_first, version_struct
from sentiflow.schema import MUTABLE_COLUMNS
from sentiflow.streaming.files import children, delete_path, filesystem, make_folder, path_exists, read_json
from sentiflow.streaming.metrics import write_text

POLICIES = ("update", "first")
_BUCKET = re.compile(r"_(\d{5})(?:\.|$)")


class BucketedTable:
    """A bucketed table under ``root``, known to the session's catalog while this object is used."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.meta = read_json(spark, f"{self.root}/table.json")
        if self.meta is None:
            raise ValueError(f"no bucketed table at {root}")
        self.key, self.buckets = self.meta["key"], self.meta["buckets"]
        self.name = "sentiflow_" + hashlib.sha256(self.root.encode()).hexdigest()[:16]
        self._finish_journal()
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({self.meta['schema']}) USING parquet "
            f"CLUSTERED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{self.root}/rows'"
        )
        spark.catalog.refreshTable(self.name)

    @classmethod
    def create(cls, spark: SparkSession, root: str, schema: str, key: str = "tweet_id", buckets: int = 64) -> BucketedTable:
        """Make an empty table (or open the one that is there)."""
        root = root.rstrip("/")
        if not path_exists(spark, f"{root}/table.json"):
            make_folder(spark, f"{root}/rows")
            write_text(spark, f"{root}/table.json", json.dumps({"key": key, "buckets": buckets, "schema": schema}))
        return cls(spark, root)

    def current(self) -> DataFrame:
        return self.spark.table(self.name)

    def bucket_of(self):
        return F.pmod(F.hash(self.key), F.lit(self.buckets)).cast("int")

    def files(self) -> dict[int, list[str]]:
        """File names by bucket."""
        found: dict[int, list[str]] = {}
        for name in children(self.spark, f"{self.root}/rows"):
            at = _BUCKET.search(name)
            if at and not name.startswith(("_", ".")):
                found.setdefault(int(at[1]), []).append(name)
        return found

    def upsert(self, batch: DataFrame, policy: str = "update", mutable: Sequence[str] = MUTABLE_COLUMNS, order: str = "processed_at") -> list[int]:
        """Merge ``batch`` into the table; returns the buckets that were written. Rows without a key are quarantine's and are refused."""
        if policy not in POLICIES:
            raise ValueError(f"policy must be one of {POLICIES}")
        keyed = self._per_key(batch.select(*self.current().columns), policy, mutable, order).persist()
        try:
            touched = sorted(r[0] for r in keyed.select(self.bucket_of().alias("b")).distinct().collect())  # at most one row a bucket
            if keyed.filter(F.col(self.key).isNull()).limit(1).count():
                raise ValueError(f"rows without {self.key}")
            if touched:
                self._replace(self.merged(keyed, touched, policy, mutable), touched)
        finally:
            keyed.unpersist()
        return touched

    def _per_key(self, batch: DataFrame, policy: str, mutable: Sequence[str], order: str) -> DataFrame:
        """One row a key, dealt to the buckets: the first copy's columns, and (``update``) the last copy's mutable ones."""
        if policy == "first":
            return dedup_first(batch, self.key, order).repartition(self.buckets, self.key)
        rest = [c for c in batch.columns if c != self.key]
        first = [c for c in rest if c not in mutable]
        version = version_struct([order], rest)
        rows = batch.groupBy(self.key).agg(F.min_by(F.struct(*first), version).alias("f"), F.max_by(F.struct(*mutable), version).alias("m"))
        return rows.select(self.key, "f.*", "m.*").select(*batch.columns).repartition(self.buckets, self.key)

    def merged(self, keyed: DataFrame, touched: Sequence[int], policy: str, mutable: Sequence[str] = MUTABLE_COLUMNS) -> DataFrame:
        """The touched buckets after the merge of one row per key; a join that leaves the target where it is."""
        target = self.current().withColumn("_in", F.lit(True))
        # only the files of the touched buckets are opened
        bucket = F.regexp_extract(F.col("_metadata.file_name"), r"_(\d{5})(?:\.|$)", 1)
        target = target.filter(bucket.isin([f"{b:05d}" for b in touched])) if len(touched) < self.buckets else target
        columns = self.current().columns
        new = keyed.select(self.key, F.lit(True).alias("_new"), *[F.col(c).alias(f"_n_{c}") for c in columns if c != self.key])
        both = target.join(new, self.key, "full_outer")

        def value(c):
            if c == self.key:
                return F.col(c)
            newer = F.col("_new") if policy == "update" and c in mutable else F.col("_in").isNull()
            return F.when(newer, F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c)

        return both.select(*[value(c) for c in columns])

    def _replace(self, rows: DataFrame, touched: Sequence[int]) -> None:
        staging, name = f"{self.root}/staging-{uuid.uuid4().hex}", f"{self.name}_{uuid.uuid4().hex[:8]}"
        rows.write.format("parquet").bucketBy(self.buckets, self.key).option("path", staging).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # the files stay
        old = self.files()
        added = [n for n in children(self.spark, staging) if _BUCKET.search(n) and not n.startswith(("_", "."))]
        journal = {"staging": staging, "add": added, "drop": [n for b in touched for n in old.get(b, [])]}
        write_text(self.spark, f"{self.root}/journal.json", json.dumps(journal))
        self._finish_journal()
        self.spark.catalog.refreshTable(self.name)

    def _finish_journal(self) -> None:
        """Make the moves that the journal names; those that were made already are passed over."""
        journal = read_json(self.spark, f"{self.root}/journal.json")
        if journal is None:
            return
        fs, _ = filesystem(self.spark, self.root)
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        for name in journal["add"]:
            if fs.exists(path(f"{journal['staging']}/{name}")):
                fs.rename(path(f"{journal['staging']}/{name}"), path(f"{self.root}/rows/{name}"))
        for name in journal["drop"]:
            delete_path(self.spark, f"{self.root}/rows/{name}")
        delete_path(self.spark, journal["staging"])
        delete_path(self.spark, f"{self.root}/journal.json")

    def rebucketed(self, root: str, buckets: int) -> BucketedTable:
        """The same rows in a new table of another number of buckets."""
        other = BucketedTable.create(self.spark, root, self.meta["schema"], self.key, buckets)
        other._replace(self.current().repartition(buckets, self.key), range(buckets))
        return other


class BucketedSink:
    """``foreachBatch`` function: quarantine a micro-batch and upsert it into a bucketed table by one of the two policies.

    A replayed batch merges the same rows again, which changes nothing.
    """

    def __init__(self, root: str, policy: str = "update", buckets: int = 64, transform=None):
        if policy not in POLICIES:
            raise ValueError(f"policy must be one of {POLICIES}")
        self.root, self.policy, self.buckets, self.transform = root, policy, buckets, transform

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        from sentiflow.operators.quality import quarantine
        from sentiflow.schema import CANONICAL_COLUMNS, POSTS_TYPES
        from sentiflow.streaming.files import write_partition

        posts = (self.transform(batch_df) if self.transform else batch_df).select(*CANONICAL_COLUMNS)
        valid, rejected = quarantine(posts, check_unique=False)
        schema = ", ".join(f"{c} {POSTS_TYPES[c]}" for c in CANONICAL_COLUMNS)
        BucketedTable.create(posts.sparkSession, self.root, schema, buckets=self.buckets).upsert(valid, self.policy)
        write_partition(rejected.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint")), f"{self.root}/rejects")
