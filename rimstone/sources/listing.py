"""What a store holds, kept from one look to the next: only folders that have changed are listed again."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rimstone.operators.skew import spread_join
from rimstone.session import filesystem

SCHEMA = "folder string, stamp long, s3_key string"
# A folder changed this shortly before it was listed may change again under the same stamp.
UNSURE_MS = 2000


class StoreListing:
    """The keys below `root`, kept at `path`: one row per folder with its stamp, and one per dataset or raw file.

    A dataset is a file or a folder named like a Parquet file, and is not looked into. A folder's modification time
    tells whether something was added to it or taken out; where a store has none (0), the folder is always listed.
    """

    def __init__(self, spark: SparkSession, root: str, path: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.path = path.rstrip("/")

    def _numbers(self) -> list[int]:
        store, pattern = filesystem(self.spark, f"{self.path}/listing-*/_SUCCESS")
        found = store.globStatus(pattern) or []
        return sorted(int(f.getPath().getParent().getName().rpartition("-")[2]) for f in found)

    def _kept(self) -> DataFrame:
        numbers = self._numbers()
        if not numbers:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(f"{self.path}/listing-{numbers[-1]:06d}")

    def refresh(self) -> int:
        """Bring the listing up to date; returns how many folders had to be listed.

        The driver asks for the stamp of each folder (seasons and dataset kinds, so there are few) and holds the entries
        of changed ones only. The new listing is written beside the former one, which goes afterwards.
        """
        kept = self._kept()
        stamps = {r["folder"]: r["stamp"] for r in kept.where("s3_key is null").collect()}
        store, top = filesystem(self.spark, self.root)
        changed: dict[str, list[tuple]] = {}
        seen, ahead = set(), [""] if store.exists(top) else []
        while ahead:
            folder = ahead.pop()
            seen.add(folder)
            _, place = filesystem(self.spark, f"{self.root}/{folder}")
            stamp = store.getFileStatus(place).getModificationTime()
            if stamp and stamps.get(folder) == stamp:
                ahead += [f for f in stamps if f and f.rpartition("/")[0] == folder]
                continue
            sure = stamp and stamp < time.time() * 1000 - UNSURE_MS
            rows = [(folder, stamp if sure else 0, None)]
            for entry in store.listStatus(place):
                name = entry.getPath().getName()
                inside = f"{folder}/{name}".lstrip("/")
                if name.startswith(("_", ".")):
                    continue
                if entry.isDirectory() and not name.endswith(".parquet"):
                    ahead.append(inside)
                else:
                    rows.append((folder, None, inside))
            changed[folder] = rows
        gone = set(stamps) - seen
        if changed or gone:
            stays = sorted(seen - set(changed))
            fresh = self.spark.createDataFrame([r for rows in changed.values() for r in rows], SCHEMA)
            number = max(self._numbers(), default=0) + 1
            kept.where(F.col("folder").isin(stays)).unionByName(fresh).coalesce(1).write.parquet(
                f"{self.path}/listing-{number:06d}"
            )
            _, former = filesystem(self.spark, f"{self.path}/listing-{number - 1:06d}")
            store.delete(former, True)
        return len(changed)

    def keys(self) -> DataFrame:
        """All keys: `(s3_key)`."""
        return self._kept().where("s3_key is not null").select("s3_key")

    def stored_among(self, keys: DataFrame) -> DataFrame:
        """Those of `keys(s3_key)` that are stored now."""
        self.refresh()
        return spread_join(keys.select("s3_key").distinct(), self.keys(), ["s3_key"], "left_semi")
