"""Incremental and streaming paths (J1-J4 and event-time windows).

The reference ingests in daily batches with a high-water mark; here the same
work is a Structured Streaming query over landed files:

* J1 ``ingest_available``: file source + checkpoint + ``Trigger.AvailableNow``
  -- each run picks up exactly the files not seen before (the checkpoint is
  the high-water mark) and survives restarts.
* J2 ``upsert_stream``: ``foreachBatch`` appends each micro-batch, deduped to
  the newest row per key, as its own ``gen=G/batch_id=N`` folder (re-running
  an epoch overwrites the same folder, so replays are idempotent);
  ``merged_view`` applies newest-per-key over the batches of the newest
  generation (merge on read); ``compact`` folds them into a new generation.
* J3 ``late_actual_candidates``: stream-stream interval join of predictions
  and actuals within +-tolerance under watermarks; the nearest candidate per
  prediction is picked on read (``nearest_candidates``).
* J4 / windows: tumbling, sliding and session aggregations with a watermark,
  emitted through the same merge-on-read sink (update mode; session windows
  support append only: a session appears once the watermark has passed its
  end, and until then stays in the state, open to later events).
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import from_marks_on, high_water_marks
from ..operators.dedup import latest_per_key, upsert


def stream_files(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def run_available(df: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None] | None = None,
                  path: str | None = None, output_mode: str = "append", fmt: str = "parquet") -> list[dict]:
    """Run a streaming frame over everything available now and stop; the
    progress of its recent micro-batches (see ``state_progress``)."""
    w = df.writeStream.option("checkpointLocation", checkpoint).outputMode(output_mode).trigger(availableNow=True)
    if sink is not None:
        q = w.foreachBatch(sink).start()
    else:
        q = w.format(fmt).start(path)
    q.awaitTermination()
    return [json.loads(p.json) if hasattr(p, "json") else p for p in q.recentProgress]


def state_progress(progress: Sequence[dict]) -> list[tuple[int, int, int, int, int]]:
    """(batch, rows read, state rows kept, state rows expired, rows that came
    after the watermark) of each micro-batch; late rows are dropped before the
    state and counted after partial aggregation."""
    out = []
    for p in progress:
        state = p.get("stateOperators") or []
        total = lambda k: sum(int(s.get(k) or 0) for s in state)
        out.append((int(p["batchId"]), int(p.get("numInputRows") or 0), total("numRowsTotal"), total("numRowsRemoved"),
                    total("numRowsDroppedByWatermark")))
    return out


def ingest_available(spark: SparkSession, src: str, schema: T.StructType, target: str, checkpoint: str,
                     transform: Callable[[DataFrame], DataFrame] | None = None,
                     max_files_per_trigger: int | None = None) -> None:
    """Append newly landed files (optionally transformed) to ``target``."""
    s = stream_files(spark, src, schema, max_files_per_trigger=max_files_per_trigger)
    run_available(transform(s) if transform else s, checkpoint, path=target)


def batch_upsert_sink(target: str, keys: Sequence[str], order: Sequence[str | Column], generation: int = 0):
    """J2 sink: newest row per key of the micro-batch, written (overwrite) to
    ``target/gen=<generation>/batch_id=<epoch>``."""
    def sink(batch: DataFrame, epoch_id: int) -> None:
        latest_per_key(batch, keys, order).withColumn("_batch_id", F.lit(int(epoch_id))) \
            .write.mode("overwrite").parquet(os.path.join(target, f"gen={int(generation)}", f"batch_id={int(epoch_id)}"))
    return sink


def generations(spark: SparkSession, target: str, marker: str | None = None) -> list[int]:
    """The ``gen=N`` folders of a table, those that hold ``marker`` where one
    is named. Lists names only; any other error of the file system raises."""
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    found = sorted(int(n.removeprefix("gen=")) for n in names if n.startswith("gen="))
    if marker is None:
        return found
    return [n for n in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{target}/gen={n}/{marker}"))]


def current_generation(spark: SparkSession, target: str) -> int:
    """Newest ``gen=N`` folder of a merge-on-read table (0 when there is none)."""
    return max(generations(spark, target), default=0)


#: Written last: a generation without it belongs to a batch that did not end.
MARKS_DONE = "marks/_SUCCESS"


def read_marked(spark: SparkSession, table: str) -> tuple[DataFrame, DataFrame] | None:
    """(rows, marks) of the newest complete batch of a marked table."""
    done = generations(spark, table, MARKS_DONE)
    if not done:
        return None
    at = f"{table}/gen={done[-1]}"
    return spark.read.parquet(f"{at}/rows"), spark.read.parquet(f"{at}/marks")


def ingest_marked(rows: DataFrame, table: str, keys: Sequence[str], order: Sequence[str | Column], series: Sequence[str],
                  ts: str, mode: str = "incremental") -> int:
    """One batch into a table that keeps a mark for every series.

    ``incremental`` takes the rows at or after their series' mark (the newest
    stored time; a series without a mark is taken whole); ``backfill`` ignores
    the marks. Rows replace stored rows of their key when newer by ``order``.
    The batch writes rows and marks of a new generation, the marks last, so a
    batch that did not end leaves the former generation and its marks in force
    and is simply run again. Marks never move back. Returns the generation;
    older ones are left for a retention job.
    """
    if mode not in ("incremental", "backfill"):
        raise ValueError(f"unknown ingest mode: {mode}")
    spark = rows.sparkSession
    held = read_marked(spark, table)
    new = latest_per_key(rows, keys, order)
    if held is not None:
        stored, marks = held
        if mode == "incremental":
            new = from_marks_on(new, series, ts, marks)
        new = upsert(stored, new, keys, order)
    gen = max(generations(spark, table), default=-1) + 1
    at = f"{table}/gen={gen}"
    new.write.mode("overwrite").parquet(f"{at}/rows")
    high_water_marks(spark.read.parquet(f"{at}/rows"), series, ts).write.mode("overwrite").parquet(f"{at}/marks")
    return gen


def upsert_stream(stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str],
                  order: Sequence[str | Column], output_mode: str = "append") -> list[dict]:
    """Idempotent streaming upsert (merge on read) into the current
    generation of ``target``; the micro-batches' progress."""
    gen = current_generation(stream.sparkSession, target)
    return run_available(stream, checkpoint, sink=batch_upsert_sink(target, keys, order, gen), output_mode=output_mode)


def merged_view(spark: SparkSession, target: str, keys: Sequence[str],
                order: Sequence[str | Column] = ()) -> DataFrame:
    """J2 read side: newest row per key over the batches of the newest
    generation, under ``order``; the later batch breaks ties. Being
    order-based (not arrival-based) the view is the same whatever order files
    or batches were processed in. Only the newest generation is scanned
    (partition pruning on ``gen``)."""
    gen = current_generation(spark, target)
    df = spark.read.parquet(target).where(F.col("gen") == gen)
    out = latest_per_key(df, keys, [*order, "_batch_id"])
    return out.drop("_batch_id", "batch_id", "gen")


def compact(spark: SparkSession, target: str, keys: Sequence[str], order: Sequence[str | Column] = ()) -> int:
    """Rewrite the merged view as the base batch of a new generation, so reads
    no longer scan every past micro-batch. Later batches go to the new
    generation; older generations are left for a retention job to remove.
    Returns the new generation."""
    gen = current_generation(spark, target)
    merged = merged_view(spark, target, keys, order)
    nxt = gen + 1
    merged.withColumn("_batch_id", F.lit(-1)).write.mode("overwrite") \
        .parquet(os.path.join(target, f"gen={nxt}", "batch_id=-1"))
    return nxt


def windowed_counts(events: DataFrame, ts: str, keys: Sequence[str], value: str, kind: str = "tumbling",
                    duration: str = "1 hour", slide: str | None = None, gap: str = "30 minutes",
                    watermark: str = "1 day") -> DataFrame:
    """J4 + event-time windows: count / sum / avg / max of ``value`` per key
    and window (tumbling, sliding or session) with a watermark for late data."""
    e = events.withWatermark(ts, watermark)
    if kind == "tumbling":
        win = F.window(ts, duration)
    elif kind == "sliding":
        win = F.window(ts, duration, slide or duration)
    elif kind == "session":
        win = F.session_window(ts, gap)
    else:
        raise ValueError(kind)
    g = e.groupBy(win.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"),
                                             F.avg(value).alias("mean"), F.max(value).alias("max_value"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys,
                    "n", "total", "mean", "max_value")


def late_actual_candidates(preds: DataFrame, actuals: DataFrame, by: str, pred_ts: str, act_ts: str,
                           tolerance: str = "30 minutes", watermark: str = "1 day") -> DataFrame:
    """All (prediction, actual) pairs of the same station within
    +-tolerance, as a stream-stream interval join under watermarks (state is
    dropped once the watermark passes the interval)."""
    p = preds.withWatermark(pred_ts, watermark).alias("p")
    a = actuals.withWatermark(act_ts, watermark).alias("a")
    cond = ((F.col(f"p.{by}") == F.col(f"a._{by}"))
            & (F.col(f"a.{act_ts}") >= F.col(f"p.{pred_ts}") - F.expr(f"INTERVAL {tolerance}"))
            & (F.col(f"a.{act_ts}") <= F.col(f"p.{pred_ts}") + F.expr(f"INTERVAL {tolerance}")))
    return p.join(a, cond, "inner")


def nearest_candidates(pairs: DataFrame, preds: DataFrame, pred_key: Sequence[str], pred_ts: str, act_ts: str,
                       value: str) -> DataFrame:
    """J3 read side: every prediction with its nearest actual (earlier on
    ties), null where none has come yet."""
    d = F.abs(F.unix_micros(F.col(act_ts).cast("timestamp")) - F.unix_micros(F.col(pred_ts).cast("timestamp")))
    order = F.struct(d.alias("d"), F.unix_micros(F.col(act_ts).cast("timestamp")).alias("t"))
    found = pairs.groupBy(*pred_key).agg(F.min_by(F.struct(F.col(act_ts).alias("matched_ts"), F.col(value).alias("actual_value")),
                                                  order).alias("_m"))
    return preds.select(*pred_key).join(found, list(pred_key), "left").select(*pred_key, "_m.*")
