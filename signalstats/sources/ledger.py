"""Result tables that keep the latest row per key, and sets of keys seen before.

A table takes rows in numbered batches, such as the triggers of a stream. Each batch is a
folder of its own, replaced as a whole if the batch comes again after a failure. From time
to time the batches are merged into the base, shard by shard; a ledger says which version
of each shard counts. Nothing that readers use is ever changed in place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalstats.sources.scratch import remove

_SHARD, _BATCH = "_shard", "_batch"
_LEDGER = "shard STRING, version BIGINT, upto BIGINT"


class LedgerTable:
    """Rows of ``schema`` below ``path``, one per combination of ``keys``.

    ``shard`` maps a row to a part of the table, as text; it must be a function of the keys.
    A merge rewrites the shards that new batches have touched and no others, so with days
    of windows as shards the cost of a merge follows the open days, not the table. Batches
    are merged after every ``merge_every``; one writer at a time.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        shard: Column | None = None,
        merge_every: int = 20,
    ):
        self._spark, self._path, self._keys = spark, path.rstrip("/"), list(keys)
        self._shard = F.pmod(F.xxhash64(*keys), F.lit(16)) if shard is None else shard
        # Read back from files, so every column may be null there.
        fields = [T.StructField(f.name, f.dataType) for f in schema.fields]
        self._schema = T.StructType(fields)
        self._stored = T.StructType([*fields, T.StructField(_BATCH, T.LongType())])
        self._merge_every = merge_every

    def write(self, rows: DataFrame, batch: int) -> None:
        """Add a batch, or replace it if it was the last one written: that one is never merged."""
        keyed = rows.select(*self._schema.names).withColumn(_BATCH, F.lit(batch).cast("bigint"))
        keyed = keyed.withColumn(_SHARD, F.coalesce(self._shard.cast("string"), F.lit("none")))
        keyed.write.mode("overwrite").partitionBy(_SHARD).parquet(f"{self._path}/batches/number={batch}")
        if batch and batch % self._merge_every == 0:
            self.merge(batch - 1)

    def latest(self, shards: Sequence[str] | None = None) -> DataFrame:
        """The latest row of every key, of all shards or the given ones."""
        return self._last(self._rows(shards)).select(*self._schema.names)

    def rows_before(self, batch: int, shards: Sequence[str] | None = None) -> DataFrame:
        """Rows of batches before the given one; of merged batches the latest per key."""
        return self._rows(shards).where(F.col(_BATCH) < batch).select(*self._schema.names)

    def merge(self, upto: int) -> None:
        """Merge the batches up to a number into the base. A merge that fails half-way leaves
        files that no ledger names; the next one replaces them."""
        merged, versions = self._ledger()
        if upto <= merged:
            return
        new = self._batches(merged, upto)
        touched = [r[0] for r in new.select(_SHARD).distinct().collect()] if new is not None else []
        if touched:
            old = self._base({s: v for s, v in versions.items() if s in touched})
            both = new if old is None else old.unionByName(new)
            latest = self._last(both, [_SHARD])
            latest.write.mode("overwrite").partitionBy(_SHARD).parquet(f"{self._path}/base/version={upto}")
        versions |= dict.fromkeys(touched, upto)
        rows = [(s, v, upto) for s, v in sorted(versions.items())] or [(None, None, upto)]
        self._spark.createDataFrame(rows, _LEDGER).coalesce(1).write.mode("overwrite").parquet(
            f"{self._path}/ledger/number={upto}"
        )

    def vacuum(self) -> None:
        """Delete batches that are merged and versions that no shard uses. Readers that began
        before the last merge may still need them, so this is left to the caller."""
        merged, versions = self._ledger()
        for kind, number in self._folders():
            if (kind == "batches" and number <= merged) or (kind == "ledger" and number < merged):
                remove(self._spark, f"{self._path}/{kind}/number={number}")
            elif kind == "base" and number not in versions.values():
                remove(self._spark, f"{self._path}/base/version={number}")

    # -- files ----------------------------------------------------------------

    def _folders(self) -> list[tuple[str, int]]:
        found = []
        for kind in ("batches", "ledger", "base"):
            parent = self._spark._jvm.org.apache.hadoop.fs.Path(f"{self._path}/{kind}")
            files = parent.getFileSystem(self._spark._jsc.hadoopConfiguration())
            if files.exists(parent):
                names = [s.getPath().getName() for s in files.listStatus(parent)]
                found += [(kind, int(n.split("=")[1])) for n in names if "=" in n]
        return found

    def _ledger(self) -> tuple[int, dict[str, int]]:
        """The number up to which batches are merged (-1: none), and the version of each shard."""
        numbers = [n for kind, n in self._folders() if kind == "ledger"]
        for number in sorted(numbers, reverse=True):
            try:
                rows = self._spark.read.schema(_LEDGER).parquet(f"{self._path}/ledger/number={number}").collect()
            except AnalysisException:
                rows = []
            if rows:  # a ledger whose writing failed has no row
                return rows[0].upto, {r.shard: r.version for r in rows if r.shard is not None}
        return -1, {}

    def _batches(self, after: int, upto: int | None = None) -> DataFrame | None:
        numbers = [n for kind, n in self._folders() if kind == "batches" and n > after and (upto is None or n <= upto)]
        if not numbers:
            return None
        schema = T.StructType([*self._stored, T.StructField("number", T.LongType()), T.StructField(_SHARD, T.StringType())])
        rows = self._spark.read.schema(schema).parquet(f"{self._path}/batches")
        return rows.where(F.col("number").isin(numbers)).drop("number")

    def _base(self, versions: dict[str, int]) -> DataFrame | None:
        if not versions:
            return None
        schema = T.StructType([*self._stored, T.StructField("version", T.LongType()), T.StructField(_SHARD, T.StringType())])
        rows = self._spark.read.schema(schema).parquet(f"{self._path}/base")
        by_version: dict[int, list[str]] = {}
        for shard, version in versions.items():
            by_version.setdefault(version, []).append(shard)
        wanted = F.lit(False)
        for version, shards in by_version.items():
            wanted |= (F.col("version") == version) & F.col(_SHARD).isin(shards)
        return rows.where(wanted).drop("version")

    def _rows(self, shards: Sequence[str] | None) -> DataFrame:
        merged, versions = self._ledger()
        if shards is not None:
            versions = {s: v for s, v in versions.items() if s in set(shards)}
        parts = [self._base(versions), self._batches(merged)]
        parts = [p if shards is None else p.where(F.col(_SHARD).isin(list(shards))) for p in parts if p is not None]
        if not parts:
            return self._spark.createDataFrame([], T.StructType([*self._stored, T.StructField(_SHARD, T.StringType())]))
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def _last(self, rows: DataFrame, more: Sequence[str] = ()) -> DataFrame:
        """The row of the highest batch per key; one shuffle of at most a row per key and task."""
        whole = F.struct(*self._stored.names)
        keys = [F.col(k).alias(f"_key{i}") for i, k in enumerate([*self._keys, *more])]
        last = rows.groupBy(*keys).agg(F.max_by(whole, _BATCH).alias("_row"))
        shards = [F.col(f"_key{len(self._keys) + i}").alias(m) for i, m in enumerate(more)]
        return last.select("_row.*", *shards)
