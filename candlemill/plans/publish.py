"""Publishing a mart again: only the documents that changed, and the ones that are gone.

What was published is kept as one digest per document, a small table of
its own.  The next run compares digests (one shuffle of the mart and of that
table by id), sends changed and new documents with the operation ``index`` and
removed ones with ``delete``, and stores the new digests when the sink has taken
them: a run that dies in between sends the same again, which changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.sinks.index import IndexSink
from candlemill.workspace import written

OPERATION = "operation"
DIGESTS = "id string, digest string"


def digest_of(mart: DataFrame, without: Sequence[str] = ("@timestamp",)) -> Column:
    """A digest of a document; the load time is no part of it."""
    names = [name for name in mart.columns if name not in ("id", *without)]
    whole = F.to_json(F.struct(*[F.col(f"`{name}`") for name in names]), {"ignoreNullFields": "false"})
    return F.md5(whole.cast("binary"))


def changes(mart: DataFrame, published: DataFrame) -> DataFrame:
    """The columns of ``mart`` with ``operation`` and ``digest``: what differs from the ``published`` digests.

    Removed documents have their id alone.
    """
    now = mart.select("*", digest_of(mart).alias("digest"), F.lit(True).alias("_now"))
    before = published.select("id", F.col("digest").alias("_digest"))
    both = now.join(before, "id", "full")
    operation = F.when(F.col("_now").isNull(), "delete").when(~F.col("digest").eqNullSafe(F.col("_digest")), "index")
    return both.withColumn(OPERATION, operation).where(F.col(OPERATION).isNotNull()).select(*mart.columns, OPERATION, "digest")


@dataclass(frozen=True)
class Published:
    """The digests of what an index holds, below ``path``: one folder per publication, numbered."""

    spark: SparkSession
    path: str

    def last(self) -> int:
        """The number of the last publication, 0 before the first."""
        try:
            runs = self.spark.read.json(f"{self.path}/done", schema="number int")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
                raise
            return 0
        return runs.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]

    def digests(self) -> DataFrame:
        number = self.last()
        return self.spark.read.schema(DIGESTS).parquet(f"{self.path}/run={number}") if number else self.spark.createDataFrame([], DIGESTS)

    def publish(self, mart: DataFrame, sink: IndexSink, resource: str) -> DataFrame:
        """Send what changed since the last publication; gives back what was sent."""
        number, before = self.last() + 1, self.digests()
        sent = written(changes(mart, before), "changes")
        sink.write(sent.drop("digest"), resource)
        kept = before.join(sent.select("id"), "id", "left_anti")
        now = kept.unionByName(sent.where(f"{OPERATION} = 'index'").select("id", "digest"))
        now.write.mode("overwrite").parquet(f"{self.path}/run={number}")
        self.spark.createDataFrame([(number,)], "number int").coalesce(1).write.mode("append").json(f"{self.path}/done")
        return sent.drop("digest")
