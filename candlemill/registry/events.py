"""Event refinement and activity marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.functions import clean_event_time
from candlemill.plans.events import (
    FLAT,
    NESTED,
    SKETCHED,
    daily_sketches,
    daily_stats,
    distinct_over,
    parsed,
    refined,
    repo_stats,
    top,
    top_repositories,
    user_stats,
)
from candlemill.registry.base import KINDS, RAW_EVENTS, REFINED_EVENTS, query, raw_events
from candlemill.sources.files import archive_hours, errors_per_file, read_archive_day, read_json
from candlemill.workspace import new_folder, written


def _flat_comment(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"body": F.col("comment.body"), "created_at": F.col("created_at").cast("timestamp_ntz")}
    ).drop("comment")


def _counts(*kinds: str) -> str:
    return ", ".join(f"count(*) filter (type = '{KINDS[kind]}') as {kind}_count" for kind in kinds)


COMMITS = f"cast(sum(case when type = '{KINDS['push']}' then distinct_size else 0 end) as bigint) as commit_count"

REPO_STATS = f"""
    select repo_url, repo_name, {COMMITS}, {_counts("push", "pr", "fork", "issue", "watch")}
    from ({REFINED_EVENTS}) group by 1, 2
"""
USER_STATS = f"""
    select user_name, {COMMITS}, {_counts("push", "pr", "issue", "issue_comment")}
    from ({REFINED_EVENTS}) group by 1
"""


DAILY_STATS = f"""
    select cast(created_at as date) as day, count(distinct user_name) as distinct_user_cnt,
           count(distinct repo_url) as distinct_repo_cnt, {COMMITS},
           {_counts("push", "pr", "issue", "issue_comment", "release")}
    from ({REFINED_EVENTS}) group by 1
"""


@query("events_refine", REFINED_EVENTS)
def _events_refine(spark, d):
    return _flat_comment(refined(raw_events(spark, d)))


def _landed(spark, d) -> str:
    folder = new_folder(spark, "events")
    raw_events(spark, d).write.mode("overwrite").option("compression", "gzip").json(folder)
    return folder


@query("src_json_roundtrip", REFINED_EVENTS)
def _src_json_roundtrip(spark, d):
    return _flat_comment(refined(read_json(spark, _landed(spark, d), NESTED)[0]))


@query(
    "src_json_schema",
    f"""select id, type, created_at, login, repository_id, body,
               '{{"name":"' || repo_path || '","url":"https://repos.example/' || repo_path || '"}}' as repo
        from ({RAW_EVENTS})""",
)
def _src_json_schema(spark, d):
    flat, _ = read_json(spark, _landed(spark, d), FLAT)
    nested = parsed(flat.withColumn("repo_text", F.col("repo")))
    return nested.select(
        "id",
        "type",
        clean_event_time(F.col("created_at")).cast("timestamp_ntz").alias("created_at"),
        F.col("actor.login").alias("login"),
        "payload.repository_id",
        F.col("payload.comment.body").alias("body"),
        F.col("repo_text").alias("repo"),
    )


@query("src_json_inferred", f"select id, type, login, repository_id from ({RAW_EVENTS})")
def _src_json_inferred(spark, d):
    rows, _ = read_json(spark, _landed(spark, d))
    return rows.select("id", "type", F.col("actor.login").alias("login"), "payload.repository_id")


# Of a hundred events one is cut off half-way, one is a list, one no JSON at all, and one has a text for a number.
LOST = "cast(id as bigint) % 100 < 3"
BROKEN = "cast(id as bigint) % 100 < 4"
FILES = 4


def _malformed(spark, d):
    """(rows, errors) of landed files with broken and blank lines among the whole ones."""
    root = new_folder(spark, "broken")
    events = raw_events(spark, d)
    line, number = F.to_json(F.struct(*events.columns)), F.col("id").cast("long")
    landed = (
        F.when(number % 100 == 0, F.substr(line, F.lit(1), F.floor(F.length(line) / 2).cast("int")))
        .when(number % 100 == 1, F.concat(F.lit("["), line, F.lit("]")))
        .when(number % 100 == 2, F.concat(F.lit("id "), F.col("id")))
        .when(number % 100 == 3, F.regexp_replace(line, r'"size":\d+', '"size":"many"'))
        .when(number % 100 == 4, F.concat(line, F.lit("\n  ")))
        .otherwise(line)
    )
    lines = events.select(landed.alias("value"), (number % FILES).alias("file"))
    # A large file comes in parts: a task sorts no more lines than adaptive execution gives it.
    lines.hint("rebalance", F.col("file")).write.partitionBy("file").option("compression", "gzip").text(root)
    return read_json(spark, f"{root}/file=*", NESTED)


@query(
    "events_malformed",
    f"""select * replace (case when cast(id as bigint) % 100 <> 3 then size end as size) from ({REFINED_EVENTS})
        where not ({LOST})""",
)
def _events_malformed(spark, d):
    return _flat_comment(refined(_malformed(spark, d)[0]))


@query(
    "events_malformed_lines",
    f"select id, cast(id as bigint) % {FILES} as file, not ({LOST}) as kept from ({RAW_EVENTS}) where {BROKEN}",
)
def _events_malformed_lines(spark, d):
    """The lines with errors and their files; each still tells its event."""
    _, errors = _malformed(spark, d)
    return errors.select(
        F.regexp_extract("line", r'(?:"id":"|id )(\d+)', 1).alias("id"),
        F.regexp_extract("path", r"file=(\d+)/", 1).cast("long").alias("file"),
        "kept",
    )


@query(
    "events_malformed_files",
    f"""select cast(id as bigint) % {FILES} as file, count(*) as lines, count(*) filter ({LOST}) as lost
        from ({RAW_EVENTS}) where {BROKEN} group by 1""",
)
def _events_malformed_files(spark, d):
    """Lines with errors per file, all of its parts together, in place of a path that is new each time."""
    counted = errors_per_file(_malformed(spark, d)[1])
    file = F.regexp_extract("path", r"file=(\d+)/", 1).cast("long").alias("file")
    return counted.groupBy(file).agg(F.sum("lines").alias("lines"), F.sum("lost").alias("lost"))


ARCHIVE_DAY = "2024-01-15"


@query("archive_day", f"select * from ({REFINED_EVENTS}) where cast(created_at as date) = date '{ARCHIVE_DAY}'")
def _archive_day(spark, d):
    """Hourly files of a day and the next one; one day is read back."""
    root = new_folder(spark, "archive")
    events = raw_events(spark, d)
    for day in (ARCHIVE_DAY, "2024-01-16"):
        of_day = events.where(F.substring("created_at", 1, 10) == day)
        for hour, path in enumerate(archive_hours(root, day, "json")):
            if hour % 12 == 0:  # a file for each half of the day will do
                of_day.where(F.floor(F.substring("created_at", 12, 2).cast("int") / 12) == hour // 12).write.option(
                    "compression", "gzip"
                ).json(path)
    return _flat_comment(refined(read_archive_day(spark, root, ARCHIVE_DAY, NESTED, partitions=4)[0]))


@query("repo_stats", REPO_STATS)
def _repo_stats(spark, d):
    return repo_stats(refined(raw_events(spark, d)), KINDS)


@query("user_stats", USER_STATS)
def _user_stats(spark, d):
    return user_stats(refined(raw_events(spark, d)), KINDS)


@query("daily_stats", DAILY_STATS)
def _daily_stats(spark, d):
    return daily_stats(refined(raw_events(spark, d)), KINDS)


def _top_query(measure: str):
    @query(
        f"top_repos_by_{measure}",
        f"""select repo_url, repo_name, {measure}_count from ({REPO_STATS})
            order by {measure}_count desc, repo_url limit 50""",
    )
    def top_repos(spark, d):
        stats = repo_stats(refined(raw_events(spark, d)), KINDS)
        return top(stats, f"{measure}_count", ["repo_url"]).select("repo_url", "repo_name", f"{measure}_count")


_top_query("push")
_top_query("commit")


@query(
    "top_users_by_push",
    f"select user_name, push_count from ({USER_STATS}) order by push_count desc, user_name limit 10",
)
def _top_users(spark, d):
    return top(user_stats(refined(raw_events(spark, d)), KINDS), "push_count", ["user_name"], 10).select(
        "user_name", "push_count"
    )


@query(
    "top_repos_two_rounds",
    f"select repo_url, repo_name, push_count from ({REPO_STATS}) where push_count > 0 order by push_count desc, repo_url limit 50",
)
def _top_repos_two_rounds(spark, d):
    return top_repositories(written(refined(raw_events(spark, d)), "events"), KINDS, "push")


def _weeks(spark, d):
    """Guesses from stored daily sketches beside the exact counts, per week."""
    events = refined(raw_events(spark, d))
    week = F.date_trunc("week", F.col("day")).cast("date")
    guessed = distinct_over(written(daily_sketches(events), "sketches"), week).withColumnsRenamed({n: f"{n}_guess" for n in SKETCHED})
    exact = events.groupBy(F.date_trunc("week", "created_at").cast("date").alias("period")).agg(
        *[F.count_distinct(column).alias(name) for name, column in SKETCHED.items()]
    )
    return guessed.join(exact, "period")


def _off(name: str):
    return F.abs(F.col(f"{name}_guess") - F.col(name)) <= F.col("error") * F.col(name)


@query("distinct_weeks")
def _distinct_weeks(spark, d):
    """Guess, exact count and error bound of each week; ``distinct_weeks_held`` has what SQL can state."""
    return _weeks(spark, d)


@query(
    "distinct_weeks_held",
    f"""select cast(date_trunc('week', created_at) as date) as period, count(distinct user_name) as users,
               count(distinct repo_url) as repos, true as users_held, true as repos_held
        from ({REFINED_EVENTS}) group by 1""",
)
def _distinct_weeks_held(spark, d):
    return _weeks(spark, d).select("period", *SKETCHED, *[_off(name).alias(f"{name}_held") for name in SKETCHED])
