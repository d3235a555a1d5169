"""Streams of events: windows with late data, sessions, first deliveries, running states.

Each has the batch form it must agree with; tests and queries compare the two.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_events(spark: SparkSession, path: str, schema, per_trigger: int = 1) -> DataFrame:
    """A file stream of parquet events."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def tumbling(events: DataFrame, ts: str, key: str, width: str, late: str | None = None) -> DataFrame:
    """Counts and sums by window and key; with ``late`` set, rows later than that are dropped."""
    rows = events.withWatermark(ts, late) if late and events.isStreaming else events
    return rows.groupBy(F.window(ts, width).alias("w"), key).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), key, "n", "total")


def sliding(events: DataFrame, ts: str, key: str, width: str, step: str, late: str | None = None) -> DataFrame:
    rows = events.withWatermark(ts, late) if late and events.isStreaming else events
    return rows.groupBy(F.window(ts, width, step).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), key, "n")


def sessions(events: DataFrame, ts: str, key: str, gap: str, late: str | None = None) -> DataFrame:
    """Sessions of a key that a pause of ``gap`` ends."""
    rows = events.withWatermark(ts, late) if late and events.isStreaming else events
    return rows.groupBy(F.session_window(ts, gap).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def first_deliveries(events: DataFrame, keys: list[str], ts: str, late: str) -> DataFrame:
    """Each event once, within the watermark's bounds on a stream."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys) if events.isStreaming else events.dropDuplicates(keys)


def latest(events: DataFrame, key: str, order: list[str], cols: list[str]) -> DataFrame:
    """The last state of each key; on a stream in update mode the state holds one row a key."""
    return events.groupBy(key).agg(F.max(F.struct(*order, *[c for c in cols if c not in order])).alias("m")).select(key, *[F.col(f"m.{c}").alias(c) for c in cols])


def run_to_table(stream: DataFrame, path: str, mode: str = "complete") -> DataFrame:
    """Everything available, through the stream, as a table under ``path``; the state's checkpoint lies beside it.

    Each batch replaces the table, so the result is never gathered on the driver.
    """
    spark, schema = stream.sparkSession, stream.schema

    def put(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/table")

    q = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).foreachBatch(put).start()
    q.awaitTermination()
    return spark.read.schema(schema).parquet(f"{path}/table")


def _fold(key: str, kinds: dict[str, str]):
    """The latest state and the quarantine of each key, as a processor that keeps one row of state a key."""
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor

    class Fold(StatefulProcessor):
        def init(self, handle) -> None:
            self.state = handle.getValueState("state", "last_at long, last_kind string, open boolean, since long, released boolean, recurred boolean, escapes long, entries long")

        def handleInputRows(self, group, rows, timer):  # noqa: N802
            held = self.state.get() if self.state.exists() else (None, None, False, None, False, False, 0, 0)
            last_at, last_kind, is_open, since, released, recurred, escapes, entries = held
            batch = pd.concat(list(rows), ignore_index=True).sort_values(["at", "seq"], kind="stable")
            for at, kind in zip(batch["at"].tolist(), batch["kind"].tolist()):
                move = kinds.get(kind)
                if last_at is None or at >= last_at:
                    last_at, last_kind = int(at), kind
                if move is None:
                    continue
                entries += 1
                if move == "escape":
                    escapes += 1
                elif move == "release":
                    is_open, released, since = False, True, None
                else:
                    recurred = recurred or move == "recur" or (released and not is_open)
                    is_open, since = True, int(at)
            self.state.update((last_at, last_kind, is_open, since, released, recurred, escapes, entries))
            yield pd.DataFrame([(group[0], last_at, last_kind, is_open, since, released, recurred, escapes, entries)], columns=[key, "last_at", "last_kind", "open", "since", "released", "recurred", "escapes", "entries"])

        def close(self) -> None:
            pass

    return Fold()


def quarantine_states(events: DataFrame, key: str, kinds: dict[str, str], time_mode: str = "None") -> DataFrame:
    """The quarantine fold as a stateful operator: for each key its last event, whether it is open and since when, releases, recurrences, escapes.

    ``events``: key, at (long), seq, kind; ``kinds`` maps kinds to enter, release, recur or escape. The state is one row a
    key, whatever its history; each batch gives the new states of the keys it touched. Rows of a batch count in the order of ``at, seq``;
    rows that come in a later batch count after those before. The batch form is ``ledger.quarantine_fold``.
    """
    kind = dict(events.dtypes)[key]
    schema = f"`{key}` {kind}, last_at long, last_kind string, open boolean, since long, released boolean, recurred boolean, escapes long, entries long"
    return events.groupBy(key).transformWithStateInPandas(_fold(key, kinds), schema, "Update", time_mode)
