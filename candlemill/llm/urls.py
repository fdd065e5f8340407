"""URL filtering by rules first, and by host reputation where no rule fits.

Reputation is empirical Bayes.  Labelled pages are counted by host, registered
domain and suffix (bad ones and all).  Every level gets a beta prior whose mean
is the posterior mean of the level above and whose strength is estimated from
how much the rates of that level differ beyond chance (method of moments).  So a
host with many labelled pages speaks for itself, one with few leans on its
domain, and an unknown one on its suffix or the whole.  A page is blocked where
the lower bound of its host's posterior rate of bad pages is above the limit.

Counts are combined on the map side; the join back to the pages is split where
one host has a large share of them.  The driver sees four numbers per level.

Defined results: a NULL url, or one without ``://``, has an empty host and path
and counts as a host of its own.  Outcomes with a NULL label are left out.
Without any outcome the rate is that of ``NO_EVIDENCE``.  Rows are judged one by
one, so repeated rows count as often as they come; an empty table gives no rows.
Very long urls are read whole: their hosts may be as long as they are.
Further columns are kept, clashing names give way.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlemill.llm.common import with_columns
from candlemill.operators.keyed import match_keyed
from candlemill.workspace import checkpointed

#: (verdict, rule) where a rule is host and path, such as ``example.org/es/``.
Rules = Sequence[tuple[str, str]]

#: Rate of bad pages above which a host is blocked, and how many standard
#: deviations below the posterior mean must still be above it.
LIMIT = 0.25
DEVIATIONS = 1.645
NO_EVIDENCE = 0.1
#: Strengths of a prior, in pages, are held between these.
WEAKEST, STRONGEST = 1.0, 1000.0

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str) -> tuple[Column, Column]:
    text = F.coalesce(F.col(f"`{url}`").cast("string"), F.lit(""))
    rest = F.regexp_extract(text, r"^(?s).*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def domain_and_suffix(host: Column, suffixes: Sequence[str] = ()) -> tuple[Column, Column]:
    """The registered domain and the suffix of a host, without a port.

    The suffix is the longest one listed in ``suffixes`` (such as ``co.uk``), else the last
    label; the domain has one label more.
    """
    labels = F.split(F.regexp_replace(host, r":\d*$", ""), r"\.")

    def tail(count: Column | int) -> Column:
        most = F.least(F.lit(count) if isinstance(count, int) else count, F.size(labels))
        return F.array_join(F.slice(labels, -most, most), ".")

    if not suffixes:
        return tail(2), tail(1)
    listed = F.split(F.lit(" ".join(sorted(suffixes))), " ")
    longest = max(suffix.count(".") + 1 for suffix in suffixes)
    fitting = F.filter(F.sequence(F.lit(1), F.lit(longest)), lambda n: (n <= F.size(labels)) & F.array_contains(listed, tail(n)))
    count = F.coalesce(F.array_max(fitting), F.lit(1))
    return tail(count + 1), tail(count)


def fitting_rule(host: Column, path: Column, rules: Rules) -> tuple[Column, Column]:
    """Verdict and text of the longest rule that fits, NULL where none does.

    One condition per rule: meant for lists of some hundred rules.
    """
    verdict, name = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        rule_host, slash, rest = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)
        verdict, name = F.when(fits, said).otherwise(verdict), F.when(fits, rule).otherwise(name)
    return verdict, name


def _strength(level: DataFrame, mean: float) -> float:
    """Strength of a level's prior by the method of moments, from sums over its groups."""
    row = level.agg(
        F.count("*").alias("groups"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("n")).cast("double").alias("squares"),
        F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("rates"),
        F.sum("bad").alias("bad"),
    ).first()
    chance = mean * (1.0 - mean)
    if not row["n"] or row["groups"] < 2 or chance == 0.0:
        return STRONGEST
    spread = row["rates"] - row["bad"] * row["bad"] / row["n"]
    room = chance * (row["n"] - row["squares"] / row["n"] - (row["groups"] - 1))
    beyond = (spread - chance * (row["groups"] - 1)) / room if room > 0 else 0.0
    return STRONGEST if beyond <= 0 else min(STRONGEST, max(WEAKEST, 1.0 / beyond - 1.0))


def reputation(hosts: DataFrame, outcomes: DataFrame, suffixes: Sequence[str] = ()) -> DataFrame:
    """``bad_mean`` and ``bad_bound`` (lower) for every row of ``hosts`` (``host``, each once).

    ``outcomes`` has ``host`` and ``bad`` (0 or 1) for each labelled page.  The hosts with
    outcomes are counted once and kept, as every level is made of them.
    """
    domain, suffix = domain_and_suffix(F.col("host"), suffixes)
    counted = checkpointed(
        outcomes.where(F.col("bad").isNotNull())
        .groupBy("host")
        .agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad"))
        .select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "bad")
    )
    domains = counted.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    whole = suffixes.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    rate = whole["bad"] / whole["n"] if whole["n"] else NO_EVIDENCE
    strengths = [_strength(level, rate) for level in (suffixes, domains, counted)]
    found = hosts.select("host", domain.alias("domain"), suffix.alias("suffix"))
    named = [
        (suffixes.select("suffix", F.col("n").alias("_n0"), F.col("bad").alias("_b0")), ["suffix"]),
        (domains.select("domain", F.col("n").alias("_n1"), F.col("bad").alias("_b1")), ["domain"]),
        (counted.select("host", F.col("n").alias("_n2"), F.col("bad").alias("_b2")), ["host"]),
    ]
    found = reduce(lambda left, right: match_keyed(left, right[0], right[1], "left"), named, found)
    mean = F.lit(float(rate))
    for level, strength in enumerate(strengths):
        n, bad = (F.coalesce(F.col(f"_{x}{level}"), F.lit(0)) for x in "nb")
        mean = (mean * strength + bad) / (n + F.lit(strength))
    weight = F.lit(strengths[-1]) + F.coalesce(F.col("_n2"), F.lit(0))
    found = found.withColumn("bad_mean", mean).withColumn("_weight", weight)
    deviation = F.sqrt(F.col("bad_mean") * (1 - F.col("bad_mean")) / (F.col("_weight") + 1))
    return found.select("host", "bad_mean", (F.col("bad_mean") - DEVIATIONS * deviation).alias("bad_bound"))


def judged(
    pages: DataFrame, rules: Rules, outcomes: DataFrame, url: str = "url", limit: float = LIMIT, suffixes: Sequence[str] = ()
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict``, ``bad_mean`` and ``bad_bound``.

    ``suffixes`` lists the suffixes of more than one label below which domains are registered.
    """
    host, path = host_and_path(url)
    rows = with_columns(pages, {"host": host, "path": path})
    verdict, name = fitting_rule(F.col("host"), F.col("path"), rules)
    known = reputation(rows.select("host").distinct(), outcomes, suffixes)
    found = match_keyed(rows.drop("bad_mean", "bad_bound"), known, ["host"], "left")
    own = F.when(F.col("bad_bound") > limit, "block").otherwise("allow")
    return with_columns(
        found,
        {"rule": name, "verdict": F.coalesce(verdict, own), "bad_mean": F.col("bad_mean"), "bad_bound": F.col("bad_bound")},
    )
