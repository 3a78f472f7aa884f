"""A stream of puts in which failed records wait in a table until they are due.

Every micro-batch is a round: its new requests and those that have become due are put once, and what comes of it is
written in one step, by the time at which a record is due again. A round reads the folders that have become due
since the one before, and nothing else; no task waits for a retry, and a waiting record outlives the job. What a
finished round wrote is not put again when its batch is repeated.
"""

from __future__ import annotations

import re
import time
from dataclasses import dataclass, field

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructType

from shardstream.functions.retry import delay_after_ms
from shardstream.model import PUT_RESULT
from shardstream.operators.quota import PutSettings
from shardstream.sources.folders import children, publish
from shardstream.streaming.producer import RAISE, PutFunction, identify_requests, put_through, spread_unlimited

#: Where final results stand; a waiting record stands under the millisecond it is due, which comes after this.
FINAL = 0
#: A record gets one attempt a round.
AT_ONCE_ONLY = -1

_ROUND = re.compile(r"round=(\d+)-(\d+)-(\d+)")
_DUE = re.compile(r"due_ms=(\d+)")


class SystemClock:
    """The time of day in milliseconds. Tests put another in its place."""

    def now_ms(self) -> int:
        return int(time.time() * 1000)

    def wait_until(self, due_ms: int) -> None:
        time.sleep(max(0, due_ms - self.now_ms()) / 1000)


@dataclass(frozen=True, order=True)
class Round:
    """A finished round: the batch it belongs to, its step after that batch, and its time."""

    batch_id: int
    step: int
    now_ms: int

    def __str__(self) -> str:
        return f"round={self.batch_id}-{self.step}-{self.now_ms}"


@dataclass(frozen=True)
class PutQueue:
    """The rounds of a job, in ``<job>/rounds``."""

    spark: SparkSession
    job: str
    put: PutFunction
    settings: PutSettings
    on_exhausted: str = RAISE
    limit_writers: bool = True
    clock: SystemClock = field(default_factory=SystemClock)

    @property
    def folder(self) -> str:
        return f"{self.job.rstrip('/')}/rounds"

    def rounds(self) -> list[Round]:
        """Finished rounds in order."""
        found = (_ROUND.fullmatch(name) for name in children(self.spark, self.folder))
        return sorted(Round(*map(int, m.groups())) for m in found if m)

    def waiting(self, after_ms: int) -> dict[int, list[str]]:
        """Folders of records that are due after a time, by when they are."""
        due: dict[int, list[str]] = {}
        for made in self.rounds():
            for name in children(self.spark, f"{self.folder}/{made}"):
                if (m := _DUE.fullmatch(name)) and int(m[1]) > max(after_ms, FINAL):
                    due.setdefault(int(m[1]), []).append(f"{self.folder}/{made}/{name}")
        return due

    def run_round(self, batch_id: int, step: int, requests: DataFrame | None) -> bool:
        """Put new requests and those that are due, each once; False if there were none, or the round is finished.

        ``requests`` have ids, or get one of the batch and their place in it; any columns but those of results
        are kept while a record waits.
        """
        done = self.rounds()
        if any((r.batch_id, r.step) == (batch_id, step) for r in done):
            return False
        last_ms = done[-1].now_ms if done else 0
        now_ms = max(last_ms, self.clock.now_ms())
        due = [path for at, paths in self.waiting(last_ms).items() if at <= now_ms for path in paths]
        asked = None
        if requests is not None and not requests.isEmpty():
            asked = identify_requests(requests, batch_id).withColumn("first_ms", F.lit(now_ms).cast("long"))
        if due:
            again = self._read(due).drop("shard_id", "sequence_number", "successful", "last_ms", "due_ms")
            asked = again if asked is None else asked.unionByName(again, allowMissingColumns=True)
        if asked is None:
            return False
        self._write(asked, Round(batch_id, step, now_ms))
        return True

    def _write(self, asked: DataFrame, made: Round) -> None:
        policy = self.settings.retry
        if not self.limit_writers:  # what is read may be a file or two, and a round waits for its last task
            asked = spread_unlimited(asked)
        results = put_through(
            asked, self.put, self.settings, self.on_exhausted, AT_ONCE_ONLY, self.limit_writers, with_requests=True
        )
        tries = F.size("attempts")
        again = ~F.col("successful") & (tries <= policy.max_retries)
        # What fails waits a millisecond at least: its round does not look for it again.
        due = F.lit(made.now_ms) + F.greatest(delay_after_ms(tries, policy), F.lit(1))
        results = results.withColumns(
            {"last_ms": F.lit(made.now_ms).cast("long"), "due_ms": F.when(again, due).otherwise(F.lit(FINAL)).cast("long")}
        )
        if "data" in results.columns:  # the payload of a record that is done with is not kept
            results = results.withColumn("data", F.when(again, F.col("data")))
        staged = f"{self.job.rstrip('/')}/_staging/{made}"
        results.write.mode("overwrite").partitionBy("due_ms").parquet(staged)
        publish(self.spark, staged, f"{self.folder}/{made}")

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.option("basePath", self.folder).parquet(*paths).drop("round")

    def drain(self) -> int:
        """Put waiting records, each when it is due, until none waits; the number of rounds that took.

        The driver waits between rounds, with nothing running.
        """
        made = 0
        while (done := self.rounds()) and (waiting := self.waiting(done[-1].now_ms)):
            self.clock.wait_until(min(waiting))
            made += self.run_round(done[-1].batch_id, done[-1].step + 1, None)
        return made

    def results(self) -> DataFrame:
        """One row per request that is done with: its result, when it was first put and when last."""
        final = f"due_ms={FINAL}"
        made = [f"{self.folder}/{r}" for r in self.rounds()]
        paths = [f"{r}/{final}" for r in made if final in children(self.spark, r)]
        columns = StructType.fromDDL(PUT_RESULT).add("first_ms", LongType()).add("last_ms", LongType())
        if not paths:
            return self.spark.createDataFrame([], columns)
        return self.spark.read.schema(columns).parquet(*paths)

    def unfinished(self) -> DataFrame | None:
        """The requests that wait, with their attempts so far and when they are due; None if none does."""
        done = self.rounds()
        paths = [p for ps in self.waiting(done[-1].now_ms).values() for p in ps] if done else []
        return self._read(paths) if paths else None

    def start(self, requests: DataFrame, once: bool = False, **trigger: str) -> StreamingQuery:
        """Put a stream of requests. Rounds go on while nothing arrives, as long as the query runs.

        ``once`` stops after the requests that are there; ``drain`` puts what waits then. A query that starts again, from
        the same job folder, goes on with what waits and what has arrived.
        """
        if once:
            trigger, tick = {"availableNow": True}, None
        else:
            seconds = self.spark.readStream.format("rate").option("rowsPerSecond", 1).load()
            tick = seconds.select(F.lit(True).alias("_tick"))
        asked = requests.withColumn("_tick", F.lit(False))
        if tick is not None:
            asked = asked.unionByName(tick, allowMissingColumns=True)

        def run(batch: DataFrame, batch_id: int) -> None:
            try:
                self.run_round(batch_id, 0, batch.where(~F.col("_tick")).drop("_tick"))
            except Exception as failure:
                failures.append(failure)
                raise

        failures: list[Exception] = []
        writer = asked.writeStream.foreachBatch(run).option("checkpointLocation", f"{self.job.rstrip('/')}/checkpoint")
        query = (writer.trigger(**trigger) if trigger else writer).start()
        query.put_failures = failures
        return query

    def put_all(self, requests: DataFrame) -> None:
        """Put all requests that a stream holds now, and end when nothing waits any more.

        Where the requests themselves cannot be read to their end, those that could be are put to their end first. A
        put that fails the stream ends at once.
        """
        query = self.start(requests, once=True)
        try:
            query.awaitTermination()
        except StreamingQueryException:
            if not query.put_failures:
                self.drain()
            raise
        self.drain()

