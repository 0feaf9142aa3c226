"""A ledger that stays small to read: a snapshot in hash buckets, and numbered deltas that compaction folds into it.

    ledger = LedgerStore(spark, folder, ["isbn"])
    ledger.append(rows)       # a delta; cheap, as often as wanted
    ledger.read()             # the last row of each key
    ledger.compact()          # folds the deltas in, rewriting the buckets that they touch and no other

Of a key the row with the greatest order columns (updated, then seq) counts, whenever it was appended, so appending or
folding rows twice changes nothing. A compaction writes new files for its buckets beside the old ones and then a manifest,
in one step, that says which version of each bucket holds; readers go by the newest manifest. A compaction that dies leaves
the ledger as it was; of two at once one fails. Overwriting buckets in place would do with fewer files, but a run that dies
between deleting a bucket and renaming its successor would lose rows.

Rows of one key, however many, are folded by an aggregate that combines before the shuffle. Reading a ledger without new
deltas shuffles nothing; with them, only rows of keys that the deltas name are compared.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.operators.ledger import latest
from quillmill.sources import shared

BUCKETS = 256


class LedgerStore:
    def __init__(self, spark: SparkSession, folder: str, keys: list[str], order: tuple[str, ...] = ("updated", "seq"), buckets: int = BUCKETS):
        """buckets counts for a new ledger; one that is there keeps its own number."""
        self.spark, self.folder, self.keys, self.order = spark, folder.rstrip("/"), keys, order
        self.buckets = self._manifest().get("buckets", buckets)

    def _manifest(self) -> dict:
        found = [n for n in shared.names(self.spark, f"{self.folder}/manifests") if n.endswith(".json")]
        return json.loads(shared.get(self.spark, f"{self.folder}/manifests/{found[-1]}")) if found else {"version": 0, "folded": -1, "where": {}}

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*(F.col(k) for k in self.keys)), F.lit(self.buckets)).cast("int")

    def _deltas(self, after: int) -> list[int]:
        """Numbers of the complete deltas after one."""
        numbers = [int(n.removeprefix("delta=")) for n in shared.names(self.spark, f"{self.folder}/deltas") if n.startswith("delta=")]
        return [n for n in numbers if n > after and "_SUCCESS" in shared.names(self.spark, f"{self.folder}/deltas/delta={n:08d}")]

    def append(self, rows: DataFrame) -> int:
        """A new delta; of two appends at once one fails instead of mixing with the other. Returns its number."""
        have = [int(n.removeprefix("delta=")) for n in shared.names(self.spark, f"{self.folder}/deltas") if n.startswith("delta=")]
        number = max([*have, self._manifest()["folded"]], default=-1) + 1
        rows.write.mode("error").parquet(f"{self.folder}/deltas/delta={number:08d}")
        return number

    def _log(self, numbers: list[int]) -> DataFrame:
        return self.spark.read.parquet(*(f"{self.folder}/deltas/delta={n:08d}" for n in numbers))

    def _snapshot(self, where: dict[str, int], buckets: list[int] | None = None) -> DataFrame | None:
        """Rows of the snapshot, or of some of its buckets; only their files are listed and read."""
        wanted = where if buckets is None else {b: where[b] for b in map(str, buckets) if b in where}
        paths = [f"{self.folder}/snapshot/version={v:08d}/bucket={b}" for b, v in wanted.items()]
        return self.spark.read.parquet(*paths) if paths else None

    def read(self) -> DataFrame:
        """The last row of each key, over the snapshot and the deltas since."""
        manifest = self._manifest()
        old, numbers = self._snapshot(manifest["where"]), self._deltas(manifest["folded"])
        if not numbers:
            if old is None:
                raise FileNotFoundError(f"nothing was appended to {self.folder}")
            return old
        new = latest(self._log(numbers), self.keys, self.order)
        if old is None:
            return new
        again = old.join(new.select(*self.keys), self.keys, "left_semi").select(*new.columns)
        rest = old.join(new.select(*self.keys), self.keys, "left_anti").select(*new.columns)
        return rest.unionByName(latest(again.unionByName(new), self.keys, self.order))

    def compact(self) -> list[int]:
        """Fold the deltas into the buckets that they touch; returns these buckets."""
        manifest = self._manifest()
        numbers = self._deltas(manifest["folded"])
        if not numbers:
            return []
        log = self._log(numbers)
        touched = sorted(r.b for r in log.select(self._bucket().alias("b")).distinct().collect())  # at most the number of buckets
        old = self._snapshot(manifest["where"], touched)
        rows = log if old is None else log.unionByName(old.select(*log.columns))
        version = manifest["version"] + 1
        rows = latest(rows, self.keys, self.order).select(*log.columns).withColumn("bucket", self._bucket())
        # overwrite: what a compaction that died has left of this version, which no manifest names
        rows.repartition(min(len(touched), int(self.spark.conf.get("spark.sql.shuffle.partitions"))), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/snapshot/version={version:08d}")
        where = manifest["where"] | {str(b): version for b in touched}
        done = {"version": version, "folded": numbers[-1], "buckets": self.buckets, "where": where}
        shared.put_once(self.spark, f"{self.folder}/manifests/{version:08d}.json", json.dumps(done))
        return touched

    def vacuum(self) -> None:
        """Delete folded deltas and buckets that the newest manifest does not name; no reader of an older one may be left."""
        manifest = self._manifest()
        for n in shared.names(self.spark, f"{self.folder}/deltas"):
            if n.startswith("delta=") and int(n.removeprefix("delta=")) <= manifest["folded"]:
                shared.delete(self.spark, f"{self.folder}/deltas/{n}")
        for v in shared.names(self.spark, f"{self.folder}/snapshot"):
            held = {f"bucket={b}" for b, at in manifest["where"].items() if v == f"version={at:08d}"}
            if not held:
                shared.delete(self.spark, f"{self.folder}/snapshot/{v}")
            for b in shared.names(self.spark, f"{self.folder}/snapshot/{v}"):
                if b.startswith("bucket=") and b not in held:
                    shared.delete(self.spark, f"{self.folder}/snapshot/{v}/{b}")
