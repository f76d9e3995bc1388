"""The silver fact, kept up to date incrementally with Structured Streaming.

New bronze athlete-event files are read as a stream. Each micro-batch is a turn: it joins its events, and
those that the turn before had to park, to the medal tally as it stands then; matched rows are the turn's
part of the fact, the others are parked again. An update ends with a turn for parked events alone, so an
event whose tally row comes later enters the fact with the first update after that, and the fact equals
the batch one after any order of arrival.

A turn writes its fact rows first and its parked events last; the latter's ``_SUCCESS`` commits it. A turn
that runs again after a failure overwrites what it left, and ``read_fact`` reads committed turns only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from strata.config import DATASETS
from strata.operators.quality import unmatched
from strata.plans import silver
from strata.sinks.files import save_parquet
from strata.sources.files import list_entries, load_parquet, string_schema
from strata.streaming.landing import MAX_FILES_PER_TRIGGER

EVENTS = "Olympic_Athlete_Event_Results"
TALLY_KEYS = ["country_noc", "edition_id"]


def _name(batch: int, retry: int = 0) -> str:
    """Folder of a turn; names sort in the order of the turns."""
    return f"turn={batch:09d}-{retry:04d}"


def _parked_path(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-parked"


def _committed(spark: SparkSession, parked: str) -> list[str]:
    try:
        names = sorted(n for n in list_entries(spark, parked) if n.startswith("turn="))
    except FileNotFoundError:
        return []
    return [n for n in names if "_SUCCESS" in list_entries(spark, f"{parked}/{n}")]


def _turn(events: DataFrame | None, spark: SparkSession, tally: DataFrame, fact: str, parked: str, name: str) -> None:
    schema = string_schema(DATASETS[EVENTS])
    earlier = [n for n in _committed(spark, parked) if n < name]
    every = events if events is not None else spark.createDataFrame([], schema)
    if earlier:
        every = every.unionByName(spark.read.schema(schema).parquet(f"{parked}/{earlier[-1]}"))
    save_parquet(silver.fact_table(every, tally), f"{fact}/{name}")
    save_parquet(unmatched(every, tally, TALLY_KEYS, TALLY_KEYS), f"{parked}/{name}")


def start_fact_stream(
    spark: SparkSession,
    bronze_events: str,
    tally: Callable[[], DataFrame],
    fact_path: str,
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Stream ``bronze_events`` (all-string Parquet) into the silver fact at ``fact_path``.

    ``tally`` gives the tally as it stands (e.g. opens its Parquet); it is asked once a micro-batch.
    """
    parked = _parked_path(checkpoint)
    events = (
        spark.readStream.schema(string_schema(DATASETS[EVENTS]))
        .option("maxFilesPerTrigger", MAX_FILES_PER_TRIGGER)
        .parquet(bronze_events)
    )

    def batch(df: DataFrame, number: int) -> None:
        _turn(df, df.sparkSession, tally(), fact_path, parked, _name(number))

    writer = events.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def update_fact(
    spark: SparkSession, bronze_events: str, tally: Callable[[], DataFrame], fact_path: str, checkpoint: str
) -> str:
    """Add the fact rows of every new bronze file and of parked events whose tally came; blocks until done."""
    parked = _parked_path(checkpoint)
    query = start_fact_stream(spark, bronze_events, tally, fact_path, checkpoint, available_now=True)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"fact stream failed: {query.exception()}")
    done = _committed(spark, parked)
    if done and not load_parquet(spark, f"{parked}/{done[-1]}").isEmpty():
        batch, retry = done[-1].removeprefix("turn=").split("-")
        _turn(None, spark, tally(), fact_path, parked, _name(int(batch), int(retry) + 1))
    return fact_path


def read_fact(spark: SparkSession, fact_path: str, checkpoint: str) -> DataFrame:
    """The fact over all committed turns."""
    turns = _committed(spark, _parked_path(checkpoint))
    if not turns:
        raise FileNotFoundError(f"no fact yet: {fact_path}")
    return spark.read.parquet(*[f"{fact_path}/{n}" for n in turns])
