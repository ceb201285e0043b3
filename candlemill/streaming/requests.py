"""Load requests: in order of service, with another try for those that fail.

Requests arrive as a stream of files with one JSON request per line. Every batch leaves its
requests and what became of them below `log_path`, one folder per batch, so that a batch that
runs again overwrites what it left:

- `accepted`: requests with a loader, with their place in the order of service;
- `unsupported` and `rejected` ones, which no run can serve;
- `attempts`: one row per symbol and try, with the round it was served in.

Symbols are served in rounds, by the position of their first request. A round loads a few hundred symbols
in one job per timeframe, from the files of just these symbols. If a job fails, the round is
split in halves until the symbols that fail stand alone: they get another try at a later time, all
others are loaded.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta
from itertools import islice

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from candlemill.operators.ranking import with_service_position
from candlemill.plans.load import load_incremental
from candlemill.schema import TIMEFRAMES
from candlemill.session import written
from candlemill.sources.catalogue import dead_letters, parse_requests, route_requests
from candlemill.sources.store import BarStore, holds_data

PER_ROUND = 500  # symbols served by one job; their names are known to the driver
MOST_TRIES = 5
WAIT = timedelta(minutes=5)  # before the second try; doubles with each further one

Source = Callable[[Sequence[str], str, datetime], DataFrame]  # symbols, timeframe, time of the try -> bars

ATTEMPTS = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("position", T.LongType()),
        T.StructField("round", T.IntegerType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("status", T.StringType()),  # loaded, waiting or failed for good
        T.StructField("tried_at", T.TimestampType()),
        T.StructField("next_try", T.TimestampType()),
        T.StructField("error", T.StringType()),
    ]
)


class RequestService:
    """Serves requests from `source` into `store`, all `timeframes` of each symbol."""

    def __init__(
        self,
        store: BarStore,
        source: Source,
        log_path: str,
        timeframes: Sequence[str] = TIMEFRAMES,
        per_round: int = PER_ROUND,
        most_tries: int = MOST_TRIES,
        wait: timedelta = WAIT,
    ):
        self.store, self.source, self.log_path = store, source, log_path.rstrip("/")
        self.timeframes, self.per_round, self.most_tries, self.wait = list(timeframes), per_round, most_tries, wait

    @property
    def spark(self) -> SparkSession:
        return self.store.spark

    def attempts(self) -> DataFrame:
        """All tries so far; empty before the first."""
        path = f"{self.log_path}/attempts"
        schema = T.StructType([*ATTEMPTS.fields, T.StructField("batch", T.StringType()), T.StructField("part", T.IntegerType())])
        if not holds_data(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def waiting(self, label: str | None = None) -> DataFrame:
        """The last try of every symbol that failed and gets another one; tries of batch `label` do not count."""
        tries = self.attempts() if label is None else self.attempts().where(F.col("batch") != label)
        newest = F.max_by(F.struct(*ATTEMPTS.fieldNames()), F.struct("tried_at", "attempt")).alias("last")
        return tries.groupBy("symbol").agg(newest).select("last.*").where(F.col("status") == "waiting")

    def serve(self, requests: DataFrame, label: str, now: datetime) -> DataFrame:
        """Serves a batch of requests (columns value, arrival); returns the tries, as they are logged.

        A symbol that waits for another try and is requested anew is tried now, its tries count on.
        """
        routed = written(route_requests(parse_requests(requests)), "requests")
        accepted = with_service_position(routed.where(F.col("route") == "load"), ["arrival", "value"])
        accepted = self._log(accepted.drop("route", "valid"), "accepted", label)
        self._log(routed.where(F.col("route") == "unsupported").drop("route", "valid"), "unsupported", label)
        self._log(dead_letters(routed).drop("route", "valid"), "rejected", label)
        first = accepted.groupBy("symbol").agg(F.min("position").cast("long").alias("position"))
        before = self.waiting(label).select("symbol", "attempt")
        due = first.join(before, "symbol", "left").select("symbol", "position", F.coalesce("attempt", F.lit(0)).alias("attempt"))
        return self._serve(due, label, now)

    def retry(self, label: str, now: datetime) -> DataFrame:
        """Serves the symbols whose next try is due, in the order of their requests."""
        due = self.waiting(label).where(F.col("next_try") <= F.lit(now)).select("symbol", "position", "attempt")
        return self._serve(due, label, now)

    def _log(self, rows: DataFrame, name: str, label: str) -> DataFrame:
        path = f"{self.log_path}/{name}/batch={label}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _serve(self, due: DataFrame, label: str, now: datetime) -> DataFrame:
        rows = written(due, "due").orderBy("position", "symbol").toLocalIterator()
        # A round at a time reaches the driver: names and places of a few hundred symbols.
        for number, names in enumerate(iter(lambda: list(islice(rows, self.per_round)), []), 1):
            tried = self.spark.createDataFrame(self._round(names, number, now), ATTEMPTS)
            tried.coalesce(1).write.mode("overwrite").parquet(f"{self.log_path}/attempts/batch={label}/part={number}")
        return self.attempts().where(F.col("batch") == label).drop("batch", "part")

    def _round(self, rows: list, number: int, now: datetime) -> list[tuple]:
        errors = self._load([r["symbol"] for r in rows], now)
        out = []
        for r in rows:
            attempt, error = r["attempt"] + 1, errors.get(r["symbol"])
            status, later = "loaded", None
            if error is not None:
                status = "waiting" if attempt < self.most_tries else "failed"
                later = now + self.wait * 2 ** (attempt - 1) if status == "waiting" else None
            out.append((r["symbol"], r["position"], number, attempt, status, now, later, error))
        return out

    def _load(self, symbols: list[str], now: datetime) -> dict[str, str]:
        """Loads the symbols; those that fail, with the error. Loading a symbol twice adds nothing."""
        try:
            for timeframe in self.timeframes:
                some = self.spark.createDataFrame([(s,) for s in symbols], "index string")
                load_incremental(self.store, self.source(symbols, timeframe, now), timeframe, some)
        except (PySparkException, Py4JJavaError, OSError, ValueError) as error:
            if len(symbols) == 1:
                return {symbols[0]: str(error).split("\n")[0][:500]}
            half = len(symbols) // 2
            return self._load(symbols[:half], now) | self._load(symbols[half:], now)
        return {}


def stream_requests(
    service: RequestService, request_dir: str, checkpoint: str, clock: Callable[[], datetime] = datetime.now, **trigger
) -> StreamingQuery:
    """Serves requests batch by batch, those that arrived with it before those that wait for another try.

    A batch whose run ends early is served again from the checkpoint; what it had loaded is not loaded twice.
    """
    requests = service.spark.readStream.text(request_dir).select(
        "value", F.col("_metadata.file_modification_time").alias("arrival")
    )

    def serve(batch: DataFrame, batch_id: int) -> None:
        service.serve(batch, str(batch_id), clock())
        service.retry(f"{batch_id}-retry", clock())

    return (
        requests.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(serve)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
