"""The stored history of prices and indicators, and runs that change it step by step.

A daily run replaces what rebased codes have, appends new prices, brings
indicators and their blocks up to date and marks the codes that are done.  These
steps touch several tables, so a run that dies between two of them would leave them
apart.  Every run therefore has a record: a step first writes what it is going to store
below the run's folder, stores it in a way that may be repeated (an overwrite of buckets,
or an insert of what is absent) and then leaves its mark.  The same run started
again skips the steps that have one.  A step that died half-way is
repeated from what was written; nothing is fetched a second time.

    plan ──> void ──> append ──> derive ──> indicators ──> blocks ──> status
"""

from __future__ import annotations

import datetime
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlemill.operators.keyed import drop_listed
from candlemill.plans.daily import FetchFrames, daily_update
from candlemill.plans.indicators import (
    CODE,
    DAY,
    SPANS,
    indicator_blocks,
    indicator_columns,
    indicators,
    indicators_daily,
    no_blocks,
    still_valid,
)
from candlemill.plans.ingest import new_prices
from candlemill.sinks.tables import BUCKETS, append_bucketed, read_bucketed, replace_buckets

STEPS = ("plan", "void", "append", "derive", "indicators", "blocks", "status")


@dataclass(frozen=True)
class RunRecord:
    """Which steps of a run are done, and what they are about to store, below one folder."""

    spark: SparkSession
    path: str

    def done(self) -> set[str]:
        try:
            marks = self.spark.read.schema("step string").json(f"{self.path}/done/*")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
                raise
            return set()
        return {row["step"] for row in marks.collect()}  # one row per step

    def mark(self, step: str) -> None:
        mark = self.spark.createDataFrame([(step,)], "step string").coalesce(1)
        mark.write.mode("overwrite").json(f"{self.path}/done/{step}")

    def keep(self, name: str, df: DataFrame) -> None:
        """Write a frame for this and later steps; repeating it overwrites it."""
        df.write.mode("overwrite").parquet(f"{self.path}/kept/{name}")

    def kept(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/kept/{name}")

    def run(self, steps: dict[str, Callable[[], None]], stop_after: str | None = None) -> None:
        """Do the steps that have no mark, in order; ``stop_after`` ends there."""
        done = self.done()
        for name, work in steps.items():
            if name not in done:
                work()
                self.mark(name)
            if name == stop_after:
                return


@dataclass(frozen=True)
class PriceStore:
    """Prices, indicators, blocks and the listing of each finished run, below one folder."""

    spark: SparkSession
    path: str
    prices_schema: str
    spans: tuple[int, ...] = SPANS
    buckets: int = BUCKETS

    def _shape(self, name: str) -> T.StructType:
        prices = self.spark.createDataFrame([], self.prices_schema)
        if name == "prices":
            return prices.schema
        if name == "blocks":
            return no_blocks(prices, self.spans).schema
        means = [T.StructField(column, T.DoubleType()) for column in indicator_columns(self.spans)]
        return T.StructType([prices.schema[DAY], prices.schema[CODE], *means])

    def read(self, name: str) -> DataFrame:
        """``prices``, ``indicators`` or ``blocks``."""
        return read_bucketed(self.spark, f"{self.path}/{name}", self._shape(name))

    def load(self, prices: DataFrame) -> None:
        """A first load, with indicators and blocks; ``prices`` is a stored table."""
        made = {"prices": prices, "indicators": indicators(prices, self.spans), "blocks": indicator_blocks(prices, self.spans)}
        for name, df in made.items():
            append_bucketed(df.select(self._shape(name).fieldNames()), f"{self.path}/{name}", [CODE], self.buckets)

    def _replace(self, name: str, touched: DataFrame, change: Callable[[DataFrame], DataFrame]) -> None:
        replace_buckets(self.spark, f"{self.path}/{name}", self._shape(name), [CODE], touched, change, self.buckets)

    def listing(self, run: str) -> DataFrame:
        """The listing as a run left it."""
        return self.spark.read.parquet(f"{self.path}/listing/{run}")

    def daily(
        self, run: str, listing: DataFrame, fetch: FetchFrames, as_of: datetime.date, stop_after: str | None = None
    ) -> RunRecord:
        """The daily run of that name, from its first step without a mark on.

        Repeating a finished run does nothing.  ``listing`` and ``fetch`` matter only
        until the plan is written.
        """
        record = RunRecord(self.spark, f"{self.path}/runs/{run}")

        def plan() -> None:
            update = daily_update(listing, self.read("prices"), fetch, as_of)
            for name in ("rebased", "added", "errors", "listing"):
                record.keep(name, getattr(update, name))

        def void() -> None:
            rebased = record.kept("rebased")
            self._replace("prices", rebased, lambda rows: drop_listed(rows, CODE, rebased))

        def append() -> None:
            # The history of a rebased code is void by now, so all of its new rows are absent.
            fresh = new_prices(self.read("prices"), record.kept("added"))
            append_bucketed(fresh.select(self._shape("prices").fieldNames()), f"{self.path}/prices", [CODE], self.buckets)

        def derive() -> None:
            update = indicators_daily(
                self.read("prices"), record.kept("added"), self.read("blocks"), record.kept("rebased"), self.spans
            )
            record.keep("redone", update.redone)
            record.keep("indicators", update.added.select(self._shape("indicators").fieldNames()))
            record.keep("blocks", update.blocks.select(self._shape("blocks").fieldNames()))

        def put_indicators() -> None:
            redone, fresh = record.kept("redone"), record.kept("indicators")
            touched = fresh.select(CODE).unionByName(redone.select(CODE)).distinct()

            def changed(rows: DataFrame) -> DataFrame:
                # Rows of an attempt that died are there already; keys of rows are too many to broadcast.
                again = fresh.select(CODE, DAY).hint("merge")
                return still_valid(rows, redone).join(again, [CODE, DAY], "left_anti").unionByName(fresh)

            self._replace("indicators", touched, changed)

        def put_blocks() -> None:
            blocks = record.kept("blocks")
            touched = blocks.select(CODE).unionByName(record.kept("redone").select(CODE)).distinct()
            self._replace("blocks", touched, lambda rows: drop_listed(rows, CODE, touched).unionByName(blocks))

        def status() -> None:
            record.kept("listing").write.mode("overwrite").parquet(f"{self.path}/listing/{run}")

        record.run(dict(zip(STEPS, (plan, void, append, derive, put_indicators, put_blocks, status))), stop_after)
        return record
