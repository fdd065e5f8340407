"""Activity events: flatten and clean, count per repository, user and day, publish."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlemill.functions import clean_event_time, last_segment
from candlemill.operators.heavy import top_keys
from candlemill.sinks.index import IndexSink

# ---- Fixed values: schemas of the nested parts, the bot login, the event types.
ACTOR = "struct<login: string, url: string>"
PAYLOAD = "struct<repository_id: bigint, size: bigint, distinct_size: bigint, comment: struct<body: string>>"
PAYLOAD_MESSAGE = "struct<repository_id: bigint, size: bigint, distinct_size: bigint, message: string>"
PAYLOAD_FIELDS = ("repository_id", "size", "distinct_size", "comment", "message")
REPO = "struct<name: string, url: string>"
BOT = "github-actions[bot]"
TOP = 50
KINDS = {
    "push": "PushEvent",
    "pr": "PullRequestEvent",
    "fork": "ForkEvent",
    "issue": "IssuesEvent",
    "issue_comment": "IssueCommentEvent",
    "watch": "WatchEvent",
    "release": "ReleaseEvent",
}
# ---- End of fixed values.

NESTED = (
    f"id string, type string, public boolean, created_at string, actor {ACTOR}, repo {REPO}, org string, "
    f"payload {PAYLOAD}"
)
# The same records with every nested part kept as its JSON text.
FLAT = (
    "id string, type string, public boolean, created_at string, actor string, repo string, org string, payload string"
)


def parsed(flat: DataFrame, payload: str = PAYLOAD) -> DataFrame:
    """Records whose nested parts are JSON text, with those parts as structs."""
    return flat.withColumns(
        {
            "actor": F.from_json("actor", ACTOR),
            "payload": F.from_json("payload", payload),
            "repo": F.from_json("repo", REPO),
        }
    )


def refined(nested: DataFrame, bots: Sequence[str] = (BOT,)) -> DataFrame:
    """Flat, cleaned events; events of bots and events without a login are dropped."""
    login = F.col("actor.login")
    carried = [name for name in PAYLOAD_FIELDS if name in nested.schema["payload"].dataType.fieldNames()]
    return nested.where(login.isNotNull() & ~login.isin(*bots)).select(
        login.alias("user_name"),
        F.col("actor.url").alias("url"),
        clean_event_time(F.col("created_at")).alias("created_at"),
        "id",
        *[F.col(f"payload.{name}") for name in carried],
        "type",
        F.col("repo.url").alias("repo_url"),
        last_segment(F.col("repo.name")).alias("repo_name"),
    )


def _of(kinds: Mapping[str, str], kind: str) -> Column:
    return F.col("type") == kinds[kind]


def _commits(kinds: Mapping[str, str]) -> Column:
    pushed = F.when(_of(kinds, "push"), F.coalesce("distinct_size", F.lit(0))).otherwise(0)
    return F.sum(pushed).cast("long").alias("commit_count")


def _counts(kinds: Mapping[str, str], wanted: Sequence[str]) -> list[Column]:
    return [F.count_if(_of(kinds, kind)).alias(f"{kind}_count") for kind in wanted]


def repo_stats(events: DataFrame, kinds: Mapping[str, str] = KINDS) -> DataFrame:
    """Activity per repository."""
    return events.groupBy("repo_url", "repo_name").agg(
        _commits(kinds), *_counts(kinds, ["push", "pr", "fork", "issue", "watch"])
    )


def user_stats(events: DataFrame, kinds: Mapping[str, str] = KINDS) -> DataFrame:
    """Activity per user."""
    return events.groupBy("user_name").agg(_commits(kinds), *_counts(kinds, ["push", "pr", "issue", "issue_comment"]))


def daily_stats(events: DataFrame, kinds: Mapping[str, str] = KINDS) -> DataFrame:
    """Activity per day, with the users and repositories seen that day.

    The distinct counts run over (day, user) and (day, repository) pairs that are
    made distinct before a day is brought together.
    """
    day = F.to_date("created_at").alias("day")
    return events.groupBy(day).agg(
        F.count_distinct("user_name").alias("distinct_user_cnt"),
        F.count_distinct("repo_url").alias("distinct_repo_cnt"),
        _commits(kinds),
        *_counts(kinds, ["push", "pr", "issue", "issue_comment", "release"]),
    )


# Of a sketch: 2 ** SKETCH_BITS registers, and how many standard errors a bound allows for.
SKETCH_BITS = 14
DEVIATIONS = 4
SKETCHED = {"users": "user_name", "repos": "repo_url"}


def daily_sketches(events: DataFrame, bits: int = SKETCH_BITS) -> DataFrame:
    """Per day a mergeable sketch of its users and one of its repositories.

    A sketch has a bounded size however many events a day has, and is made on the map side.
    """
    day = F.to_date("created_at").alias("day")
    return events.groupBy(day).agg(*[F.hll_sketch_agg(column, F.lit(bits)).alias(name) for name, column in SKETCHED.items()])


def distinct_over(sketches: DataFrame, period: Column, bits: int = SKETCH_BITS) -> DataFrame:
    """Distinct users and repositories of longer periods from stored daily sketches, without any event.

    ``error`` bounds how far a guess is off, as a share of the count: ``DEVIATIONS`` times
    the standard error of merged sketches.
    """
    merged = [F.hll_sketch_estimate(F.hll_union_agg(name)).alias(name) for name in SKETCHED]
    error = DEVIATIONS * 1.04 / 2 ** (bits / 2)
    return sketches.groupBy(period.alias("period")).agg(*merged).withColumn("error", F.lit(error))


def top(stats: DataFrame, measure: str, ties: Sequence[str], n: int = TOP) -> DataFrame:
    """The ``n`` rows with the largest ``measure``; ``ties`` decide equal ones."""
    return stats.orderBy(F.col(measure).desc(), *ties).limit(n)


def top_repositories(events: DataFrame, kinds: Mapping[str, str], kind: str, n: int = TOP) -> DataFrame:
    """``top`` of ``repo_stats`` by events of one kind, without counting all repositories.

    A bounded summary per task finds the repositories that can be among the first; only their events are counted.
    """
    of_kind = events.where(_of(kinds, kind)).select("repo_url", "repo_name")
    return top_keys(of_kind, ["repo_url", "repo_name"], n, name=f"{kind}_count")


def mart(stats: DataFrame, keys: Sequence[str], loaded_at: Column) -> DataFrame:
    """A mart as it is published: ``id`` (a digest of the key) and ``@timestamp`` in front.

    The digest of a row stays the same from run to run, so publishing again replaces documents.
    """
    text = F.concat_ws("\u001f", *[F.coalesce(F.col(name).cast("string"), F.lit("")) for name in keys])
    return stats.select(F.md5(text.cast("binary")).alias("id"), loaded_at.alias("@timestamp"), *stats.columns)


def publish_mart(stats: DataFrame, keys: Sequence[str], sink: IndexSink, resource: str, loaded_at: Column) -> None:
    sink.write(mart(stats, keys, loaded_at), resource)


def stamped(df: DataFrame, loaded_at: Column) -> DataFrame:
    """Add the load time; the caller says what it is."""
    return df.withColumn("@timestamp", loaded_at)


def publish(df: DataFrame, sink: IndexSink, resource: str, loaded_at: Column) -> None:
    sink.write(stamped(df, loaded_at), resource)
