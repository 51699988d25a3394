"""Incremental windows with a stored watermark, and their Structured Streaming form."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions import times
from folioscope.sources.readers import after_until, json_or

CRAWL, GENERATED, SENT = "last_crawl_end_iso", "last_generated_iso", "last_sent_iso"


class State:
    """A small JSON file with times by key. Writing keeps all other keys and replaces the file in one step."""

    def __init__(self, path: str, spark: SparkSession | None = None):
        """spark: the file is in any store that Spark reaches; without, on this machine's disk."""
        self.path, self.spark = path, spark

    def _load(self):
        if self.spark is None:
            return json_or(self.path, {})
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        at = hadoop.Path(self.path)
        if not at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at):
            return {}
        try:
            return json.loads(self.spark.read.text(self.path, wholetext=True).first()[0])
        except (TypeError, ValueError):
            return {}

    def _save(self, text: str) -> None:
        tmp = f"{self.path}.{uuid.uuid4().hex}"
        if self.spark is None:
            with open(tmp, "w", encoding="utf-8") as f:
                f.write(text)
            os.replace(tmp, self.path)
            return
        hadoop, conf = self.spark._jvm.org.apache.hadoop.fs, self.spark._jsc.hadoopConfiguration()
        new, at = hadoop.Path(tmp), hadoop.Path(self.path)
        fs = at.getFileSystem(conf)
        out = fs.create(new, True)
        out.write(bytearray(text, "utf-8"))
        out.close()
        kind = getattr(hadoop, "Options$Rename")
        over = self.spark.sparkContext._gateway.new_array(kind, 1)
        over[0] = kind.valueOf("OVERWRITE")
        hadoop.FileContext.getFileContext(fs.getUri(), conf).rename(fs.makeQualified(new), fs.makeQualified(at), over)

    def get(self, *names: str) -> datetime | None:
        """The first of the keys that holds a time."""
        d = self._load()
        for n in names:
            try:
                v = d.get(n)
                if isinstance(v, (int, float)):
                    return datetime.fromtimestamp(v / 1000 if v > 1e12 else v)
                if v:
                    return datetime.fromisoformat(v)
            except (AttributeError, TypeError, ValueError):
                continue
        return None

    def put(self, name: str, t: datetime) -> None:
        d = self._load()
        d = (d if isinstance(d, dict) else {}) | {name: t.replace(microsecond=0).isoformat()}
        self._save(json.dumps(d, ensure_ascii=False))


def crawl_window(state: State, now: datetime, days: int) -> tuple[datetime, datetime]:
    """From the last end (two minutes earlier, for safety) but no more than so many days back; to a day ahead."""
    back, last = now - timedelta(days=days), state.get(CRAWL)
    return max(back, last - timedelta(minutes=2)) if last else back, now + timedelta(days=1)


def digest_window(state: State, now: datetime) -> tuple[datetime, datetime]:
    """(last generated, else last sent, else today's start; now]."""
    return state.get(GENERATED, SENT) or now.replace(hour=0, minute=0, second=0, microsecond=0), now


def run_digest(rows: DataFrame, state: State, now: datetime, created: str, keep: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame], None]) -> int:
    """One incremental run: the watermark moves only after the sink has written rows that passed all filters."""
    start, end = digest_window(state, now)
    out = keep(rows.where(after_until(F.col(created), start, end)))
    n = out.count()
    if n:
        write(out)
        state.put(GENERATED, now)
    return n


def slices(rows: DataFrame, created: str, unit: str) -> DataFrame:
    """Adds the period of each row; rows without a time are left out."""
    return rows.where(F.col(created).isNotNull()).withColumn("period", times.period(F.col(created), unit))


def slice_sizes(rows: DataFrame, created: str, unit: str) -> DataFrame:
    """period, n; the newest first."""
    return slices(rows, created, unit).groupBy("period").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("period"))


def stream(spark: SparkSession, path: str, schema, **options) -> DataFrame:
    return spark.readStream.schema(schema).options(**options).parquet(path)


def windowed_counts(events: DataFrame, time: str, by: list[Column], width: str = "1 day", late: str = "1 day") -> DataFrame:
    """Tumbling windows with a watermark: rows that come later than ``late`` are not counted."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), *by).agg(F.count(F.lit(1)).alias("n"))


def once_each(events: DataFrame, keys: list[str], time: str, late: str = "1 day") -> DataFrame:
    """Repeated deliveries of a key within the watermark count once."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def run_available(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Processes what is there and stops; the sink gets each batch with its number, and may see a batch again after a failure."""
    q = df.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
