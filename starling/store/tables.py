"""State layout: append-only logs partitioned by ``batch_id`` plus a commit table.

Plain Parquet has no MERGE or DELETE, so every state table is a log:

* a batch writes only its own ``batch_id=N`` folders, each removed first, so a
  retried batch replaces its own output (also with nothing) and nothing else;
* ``commits`` gets one row per batch, written last, with the tables that the
  batch wrote; readers open the folders of committed batches by name, which
  makes a batch visible in all tables at once (all-or-nothing, D6) and lists no
  other folder;
* a row also names the stream and epoch it came from, so a replayed epoch is
  known whatever its batch number;
* current orders/dimensions = latest row per key over the log; current items =
  the item rows of each order's latest version (an order re-sent without items
  has a version with no item rows, so its items are gone, D8);
* ``compact`` rewrites the current state as a base snapshot so reads stop
  growing with the number of batches.

One writer per state; any number of readers. Only an instance that has committed
keeps the commit rows in memory, so readers always see the latest commit.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling import schemas as S
from starling.operators.latest import latest_per_key
from starling.sources.json_files import PACKED, WHOLE_DOCUMENTS

BATCH = "batch_id"

KEYS = {"stg_orders": "order_id", "dim_customer": "customer_id", "dim_product": "product_id",
        "fact_orders": "order_id"}
CHILDREN = {"stg_order_items": "stg_orders", "fact_order_items": "fact_orders"}
STATE_TABLES = ["stg_orders", "stg_order_items", "dim_customer", "dim_product", "fact_orders",
                "fact_order_items", "rejects"]


def _in_range(df: DataFrame, key_range: tuple | None, key: str = "order_id") -> DataFrame:
    if key_range is None or key_range[0] is None:
        return df
    return df.where(F.col(key).between(F.lit(key_range[0]).cast(S.NUMBER), F.lit(key_range[1]).cast(S.NUMBER)))


def _with_batch(schema: T.StructType, data_col: bool = False) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(BATCH, T.LongType(), not data_col)])


class Store:
    def __init__(self, spark: SparkSession, root: str, money: str = "number", landing_root: str | None = None):
        """``landing_root``: the state whose landing tables (and ingest checkpoint) this one shares; kept with the state."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.money = money
        mark = f"{self.root}/_landing_root"
        if landing_root is not None and not self.exists(mark):
            spark.createDataFrame([(landing_root,)], "root string").coalesce(1).write.parquet(mark)
        elif landing_root is None and self.exists(mark):
            landing_root = spark.read.schema("root string").parquet(mark).first()[0]
        self.landing_root = (landing_root or self.root).rstrip("/")
        self.schemas = {
            "stg_orders": S.stg_orders(money), "stg_order_items": S.stg_order_items(money),
            "dim_customer": S.DIM_CUSTOMER, "dim_product": S.DIM_PRODUCT,
            "fact_orders": S.fact_orders(money), "fact_order_items": S.fact_order_items(money),
            "rejects": S.REJECTS, "landing_loads": S.LANDING, "pipeline_audit": S.PIPELINE_AUDIT,
            "commits": S.COMMITS,
        }
        for t in self.schemas:
            self._mkdirs(self.path(t))
        self._commits: list | None = None      # the commit rows, once this instance is the writer

    # ------------------------------------------------------------ paths / fs
    def path(self, table: str) -> str:
        return f"{self.landing_root if table == 'landing_loads' else self.root}/{table}"

    @property
    def landing_path(self) -> str:
        """Landing table written by the streaming file sink (A5)."""
        return f"{self.landing_root}/landing"

    def checkpoint(self, name: str) -> str:
        """The ingest checkpoint belongs to the landing table, the others to this state."""
        return f"{self.landing_root if name == 'ingest' else self.root}/_checkpoints/{name}"

    def _fs(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _mkdirs(self, path: str) -> None:
        fs, p = self._fs(path)
        if not fs.exists(p):
            fs.mkdirs(p)

    def _delete(self, path: str) -> None:
        fs, p = self._fs(path)
        if fs.exists(p):
            fs.delete(p, True)

    def exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return bool(fs.exists(p))

    # ------------------------------------------------------------ reads
    def _read(self, table: str, batches: list[int]) -> DataFrame:
        """The given batches' folders, by name."""
        schema = _with_batch(self.schemas[table])
        if not batches:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path(table)}/{BATCH}={b}" for b in batches]
        return self.spark.read.schema(schema).option("basePath", self.path(table)).parquet(*paths)

    def _batches(self, table: str, after: int | None, upto: int) -> list[int]:
        """Committed batches in ``(after, upto]`` that wrote ``table``."""
        return sorted(r["batch_id"] for r in self.commit_rows()
                      if r["batch_id"] <= upto and (after is None or r["batch_id"] > after) and table in r["tables"].split(","))

    def log(self, table: str, upto: int | None = None, after: int | None = None) -> DataFrame:
        """Rows of ``table`` for committed batches in ``(after, upto]``; without ``upto`` up to the last commit."""
        upto = self.last_commit() if upto is None else upto
        base_v = self.base_version(upto) if table in KEYS or table in CHILDREN else None
        if base_v is None or (after is not None and after >= base_v):
            return self._read(table, self._batches(table, after, upto))
        base = self._base(table, base_v)
        if after is not None:
            base = base.where(F.col(BATCH) > after)
        return base.unionByName(self._read(table, self._batches(table, base_v, upto)))

    def batch(self, table: str, batch_id: int) -> DataFrame:
        """One batch's rows, committed or not (the batch's own change rows)."""
        there = self.exists(f"{self.path(table)}/{BATCH}={batch_id}")
        return self._read(table, [batch_id] if there else [])

    def uncommitted(self, table: str) -> DataFrame:
        """Rows of batches after the last commit: landed or staged, not yet visible."""
        schema = _with_batch(self.schemas[table])
        return self.spark.read.schema(schema).parquet(self.path(table)).where(F.col(BATCH) > self.last_commit())

    def current(self, table: str, upto: int | None = None) -> DataFrame:
        """Current rows of a keyed table (latest version per key) or of a child table.

        After a compaction the base already holds one current row per key, so only keys touched
        by later batches (the tail) are replaced: ``base ANTI JOIN tail keys UNION latest(tail)``,
        with the tail keys broadcast when their counted size is under the bound. The base is
        scanned, never shuffled.
        """
        upto = self.last_commit() if upto is None else upto
        base_v = self.base_version(upto)
        if base_v is not None:
            return self._current_from_base(table, base_v, upto)
        if table in CHILDREN:
            return self.current_children(table, upto=upto)
        key = KEYS[table]
        return latest_per_key(self.log(table, upto), [key], [F.col(BATCH).desc()])

    def _base(self, table: str, base_v: int) -> DataFrame:
        return self.spark.read.schema(_with_batch(self.schemas[table], True)).parquet(
            f"{self.root}/_base/v={base_v}/{table}")

    def _tail(self, table: str, base_v: int, upto: int) -> DataFrame:
        return self._read(table, self._batches(table, base_v, upto))

    def _current_from_base(self, table: str, base_v: int, upto: int) -> DataFrame:
        from starling.operators.joins import bounded_broadcast

        parent = CHILDREN.get(table, table)
        key = KEYS[parent]
        ptail = self._tail(parent, base_v, upto)
        n_tail = ptail.count() if upto > base_v else 0
        if n_tail == 0:
            return self._base(table, base_v)
        if table in KEYS:
            tail_keys = bounded_broadcast(ptail.select(key).distinct(), n_tail)
            return (self._base(table, base_v).join(tail_keys, key, "left_anti")
                    .unionByName(latest_per_key(ptail, [key], [F.col(BATCH).desc()])))
        tail_versions = bounded_broadcast(
            ptail.select("order_id", BATCH).groupBy("order_id").agg(F.max(BATCH).alias(BATCH)), n_tail)
        untouched = self._base(table, base_v).join(tail_versions.select("order_id"), "order_id", "left_anti")
        touched = self._tail(table, base_v, upto).join(tail_versions, ["order_id", BATCH], "left_semi")
        return untouched.unionByName(touched)

    def versions(self, parent: str, upto: int | None = None, keys: DataFrame | None = None,
                 key_range: tuple | None = None) -> DataFrame:
        """Latest batch per parent key ``(order_id, batch_id)``; optionally only for ``keys``.

        ``key_range = (lo, hi)`` (the keys' min and max) is pushed to the Parquet scan, so files
        and row groups whose ``order_id`` statistics lie outside it are skipped.
        """
        log = _in_range(self.log(parent, upto).select("order_id", BATCH), key_range)
        if keys is not None:
            log = log.join(keys.select("order_id"), "order_id", "left_semi")
        return log.groupBy("order_id").agg(F.max(BATCH).alias(BATCH))

    def prior_orders(self, keys: DataFrame, key_range: tuple | None, known_rows: int | None = None) -> DataFrame:
        """``order_id, batch_id, item_count`` of the committed version of each of ``keys`` that exists."""
        from starling.operators.joins import bounded_broadcast

        log = _in_range(self.log("stg_orders").select("order_id", BATCH, "item_count"), key_range)
        log = log.join(bounded_broadcast(keys.select("order_id"), known_rows), "order_id", "left_semi")
        latest = log.groupBy("order_id").agg(F.max(F.struct(BATCH, "item_count")).alias("v"))
        return latest.select("order_id", f"v.{BATCH}", "v.item_count")

    def current_children(self, table: str, upto: int | None = None, keys: DataFrame | None = None) -> DataFrame:
        """Item rows of each order's latest version (optionally only for ``keys``)."""
        parent = CHILDREN[table]
        return self.children_of(table, self.versions(parent, upto, keys), upto)

    def children_of(self, table: str, versions: DataFrame, upto: int | None = None,
                    versions_rows: int | None = None, key_range: tuple | None = None) -> DataFrame:
        """Item rows matching ``(order_id, batch_id)`` versions (a semi join; AQE splits hot orders)."""
        from starling.operators.joins import bounded_broadcast

        v = bounded_broadcast(versions.select("order_id", BATCH), versions_rows)
        return _in_range(self.log(table, upto), key_range).join(v, ["order_id", BATCH], "left_semi")

    def changes(self, table: str, after: int, upto: int | None = None,
                cols: list[str] | None = None) -> DataFrame:
        """Change rows of ``table`` between the committed states at ``after`` and ``upto``.

        Keyed tables give DELETE/INSERT images with ``_is_update``; item tables give the
        multiset difference. Only keys touched by batches in ``(after, upto]`` are compared,
        so the cost follows the change volume, not the table size.
        """
        from starling.operators.changes import multiset_changes, net_changes

        upto = self.last_commit() if upto is None else upto
        touched_parent = CHILDREN.get(table, table)
        key = KEYS.get(touched_parent, "order_id")
        touched = self.log(touched_parent, upto, after=after).select(key).distinct()
        if table in CHILDREN:
            before = self.children_of(table, self.versions(touched_parent, after, touched), after)
            now = self.children_of(table, self.versions(touched_parent, upto, touched), upto)
            cols = cols or [c for c in self.schemas[table].fieldNames() if c not in ("updated_at", "updated_at_ltz")]
            return multiset_changes(before, now, cols)
        # restrict to touched keys before the latest-version window: the shuffle sees only changed keys
        def latest_of(upto_v: int) -> DataFrame:
            rows = self.log(table, upto_v).join(touched, key, "left_semi")
            return latest_per_key(rows, [key], [F.col(BATCH).desc()])

        before, now = latest_of(after), latest_of(upto)
        cols = cols or [c for c in self.schemas[table].fieldNames() if c not in (key, "updated_at", "updated_at_ltz")]
        return net_changes(before, now, [key], cols)

    def audit(self) -> DataFrame:
        return self.spark.read.schema(_with_batch(S.PIPELINE_AUDIT)).parquet(self.path("pipeline_audit"))

    def landing(self) -> DataFrame:
        """Every landed row: batch loads plus the streaming sink's table."""
        loads = self.spark.read.schema(_with_batch(S.LANDING)).parquet(self.path("landing_loads")).drop(BATCH)
        if self.has_streamed():
            loads = loads.unionByName(self.spark.read.schema(S.LANDING).parquet(self.landing_path))
        return loads

    def has_streamed(self) -> bool:
        """Whether the streamed landing table exists."""
        return self.exists(f"{self.landing_path}/_spark_metadata")

    def landed_batches(self) -> list[int]:
        """Ids of the batch loads that have landed, committed or not."""
        fs, p = self._fs(self.path("landing_loads"))
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{BATCH}="))

    def next_load(self) -> int:
        """The id of the next batch load: behind all commits and, where landing tables are shared, all loads there."""
        last = self.last_commit()
        return 1 + (last if self.landing_root == self.root else max([last, *self.landed_batches()]))

    # ------------------------------------------------------------ commits
    def commits(self) -> DataFrame:
        return self.spark.read.schema(S.COMMITS).parquet(self.path("commits"))

    def commit_rows(self) -> list:
        """The commit rows, one small row per batch."""
        return self._commits if self._commits is not None else self.commits().collect()

    def last_commit(self) -> int:
        """Greatest committed batch id (-1 when empty)."""
        return max((r["batch_id"] for r in self.commit_rows()), default=-1)

    def has_epoch(self, source: str, epoch: int) -> bool:
        return any(r["source"] == source and r["epoch"] == epoch for r in self.commit_rows())

    def base_version(self, upto: int) -> int | None:
        marks = f"{self.root}/_base_marks"
        if not self.exists(marks):
            return None
        df = self.spark.read.schema("v long").parquet(marks).where(F.col("v") <= upto)
        v = df.agg(F.max("v")).first()[0]
        return None if v is None else int(v)

    # ------------------------------------------------------------ writes
    def begin(self, batch_id: int) -> None:
        """Remove partial output of an earlier failed attempt of this batch."""
        for t in STATE_TABLES:
            self._delete(f"{self.path(t)}/{BATCH}={batch_id}")

    def write(self, table: str, df: DataFrame, batch_id: int) -> None:
        """Write the batch's rows of ``table``; without any, no folder stays."""
        cols = [f.name for f in self.schemas[table].fields]
        out = df.select(*[F.col(c).cast(self.schemas[table][c].dataType) for c in cols])
        key = KEYS.get(table) or ("order_id" if table in CHILDREN else None)
        if key is not None:
            # key-sorted files: tight row-group min/max, so key-range filters skip row groups; as long, which is sorted without
            # comparing decimals (keys of more digits come first, in any order)
            out = out.sortWithinPartitions(F.col(key).try_cast("long"))
        folder = f"{self.path(table)}/{BATCH}={batch_id}"
        self._delete(folder)
        obs = Observation(f"written_{uuid.uuid4().hex[:12]}")
        out.observe(obs, F.count(F.lit(1)).alias("n")).write.options(**WHOLE_DOCUMENTS, **PACKED).parquet(folder)
        if not obs.get.get("n"):
            self._delete(folder)

    def scratch(self, df: DataFrame) -> tuple[DataFrame, str]:
        """``df`` written beside the tables and read back, for a batch that needs it several times; and its folder, to be deleted.

        Unlike cached rows it is packed, and whole if executors are lost; what making it shuffled can go at once."""
        folder = f"{self.root}/_scratch/{uuid.uuid4().hex[:12]}"
        df.write.options(**WHOLE_DOCUMENTS, **PACKED).parquet(folder)
        return self.spark.read.schema(df.schema).parquet(folder), folder

    def append_audit(self, rows: list[tuple], batch_id: int) -> None:
        df = self.spark.createDataFrame(rows, S.PIPELINE_AUDIT).withColumn(BATCH, F.lit(batch_id).cast("long"))
        df.coalesce(1).write.mode("append").partitionBy(BATCH).parquet(self.path("pipeline_audit"))

    def commit(self, batch_id: int, query_id: str, file_count: int, landing_rows: int = 0, attempt: str | None = None,
               source: str | None = None, epoch: int | None = None) -> None:
        import datetime as dt

        known = self.commit_rows()
        tables = ",".join(t for t in STATE_TABLES if self.exists(f"{self.path(t)}/{BATCH}={batch_id}"))
        row = (batch_id, dt.datetime.now(), query_id, file_count, landing_rows, attempt, source, epoch, tables)
        df = self.spark.createDataFrame([row], S.COMMITS)
        df.coalesce(1).write.mode("append").parquet(self.path("commits"))
        self._commits = [*known, *df.collect()]

    # ------------------------------------------------------------ maintenance
    def compact(self) -> int:
        """Write the committed state as a base snapshot; later reads start from it."""
        upto = self.last_commit()
        if upto < 0 or self.base_version(upto) == upto:
            return upto
        base = f"{self.root}/_base/v={upto}"
        for t in list(KEYS) + list(CHILDREN):
            key = KEYS.get(t, "order_id")
            cur = self.current(t, upto)
            # range partitioning: each base file covers its own key range, so key filters skip files
            (cur.repartitionByRange(key).sortWithinPartitions(key)
             .write.mode("overwrite").options(**PACKED).parquet(f"{base}/{t}"))
        # the mark is written last: readers switch to the base only once it is complete
        self.spark.createDataFrame([(upto,)], "v long").write.mode("append").parquet(f"{self.root}/_base_marks")
        return upto

    def reset(self, keep_landing: bool = False) -> "Store":
        """A fresh, empty state next to this one (never truncate in place); ``keep_landing``: with its landing tables."""
        parent = self.root.rsplit("/", 1)[0]
        return Store(self.spark, f"{parent}/state-{uuid.uuid4().hex[:12]}", self.money, self.landing_root if keep_landing else None)
