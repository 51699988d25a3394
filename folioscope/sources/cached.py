"""A provider's map kept between runs: versions in a folder, and a pointer that is switched in one step."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from folioscope.streaming.incremental import State


class CachedMap:
    """A map of a provider as Parquet versions below a folder.

    ``current.json`` names the version that counts, when it was made, by which source and with how many rows. A version is written in full before the
    pointer is switched, so a run that dies leaves the one before in force; readers of that version keep it, as versions are not deleted.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._pointer = State(f"{self.path}/current.json", spark)

    def info(self) -> dict:
        """version, updated_at, source and count of the version in force; empty without one."""
        d = self._pointer._load()
        return d if isinstance(d, dict) and d.get("version") else {}

    def save(self, rows: DataFrame, source: str, now: datetime) -> bool:
        """Writes a version and switches to it, unless it has no rows."""
        version = uuid.uuid4().hex
        rows.write.parquet(f"{self.path}/{version}")
        count = self.spark.read.parquet(f"{self.path}/{version}").count()
        if count:
            self._pointer._save(json.dumps({"version": version, "updated_at": now.isoformat(sep=" ", timespec="seconds"), "source": source, "count": count}))
        return count > 0

    def load(self, now: datetime | None = None, most: timedelta | None = None) -> DataFrame | None:
        """The version in force; None without one, if it is older than ``most`` or can't be read."""
        info = self.info()
        if not info or (most is not None and now - datetime.fromisoformat(info["updated_at"]) > most):
            return None
        try:
            return self.spark.read.parquet(f"{self.path}/{info['version']}")
        except Exception:  # a version that is gone is as good as none
            return None

    def refreshed(self, fetch: Callable[[], DataFrame], source: str, now: datetime) -> DataFrame | None:
        """The provider's present map, which becomes the version in force; if the provider fails or has nothing, the version of before."""
        try:
            self.save(fetch(), source, now)
        except Exception:  # the provider's failure must not stop the run
            pass
        return self.load()
