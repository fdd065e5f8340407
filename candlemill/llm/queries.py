"""One query per operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.llm import (
    bpe,
    exact,
    infilling,
    language,
    lines,
    mixing,
    neighbours,
    periodic,
    sharding,
    simhash,
    substrings,
    token_counts,
    urls,
)
from candlemill.llm.common import WORD
from candlemill.registry.base import Query, table
from candlemill.workspace import new_folder, new_table, scratch, written, written_to

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

WINDOW = 35
MODEL = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = " ".join(sql.split())
        return function

    return register


def new_index(spark: SparkSession) -> exact.DigestIndex:
    """An empty digest index of its own, so that a query never meets texts of another run."""
    return exact.DigestIndex(spark, new_table("digests"), new_folder(spark, "digests"))


# Every stretch of 35 words of a text by its place; those that start twice anywhere are repeats.
SUBSTRINGS = r"""
    with w as (select row_number() over () as r, doc_id,
                      regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
    starts as (select r, unnest(range(1, len(words) - 33)) as s, words from w where len(words) >= 35),
    stretches as (select r, s, md5(array_to_string(words[s:s + 34], ' ')) as h from starts),
    repeated as (select r, s from (select *, count(*) over (partition by h) as n from stretches) where n > 1),
    gone as (select distinct r, unnest(range(s, s + 35)) as p from repeated),
    counts as (select r, count(*) as n, list(p) as ps from gone group by r)
    select doc_id, cast(len(words) as bigint) as n_words, cast(coalesce(n, 0) as bigint) as n_removed,
           sha256(array_to_string(case when n is null then words else
               list_filter(words, lambda x, i: not list_contains(ps, i)) end, ' ')) as kept_sha256
    from w left join counts using (r)
"""


@query("op1_substring_dedup", SUBSTRINGS)
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    results = substrings.distinct_texts(documents, WINDOW).select(
        *substrings.KEY, "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )
    return substrings.attached(documents, results).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op2_token_counts")
def token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(documents, MODEL).select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query("op3_nearest_neighbours")
def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


# The integral of each schedule, inverted by hand: 0.5 + t, 1, and 1.5 - t up to the middle and from it.
SCHEDULE_SQL = """case k % 3 when 0 then 2 * {y} / (0.5 + sqrt(0.25 + 2 * {y})) when 1 then {y}
    else case when {y} <= 0.625 then 2 * {y} / (1.5 + sqrt(2.25 - 2 * {y}))
         else 0.5 + 2 * ({y} - 0.625) / (1 + sqrt(1 - 2 * ({y} - 0.625))) end end"""

MIX = rf"""
    with rows as (select doc_id, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
                         coalesce('s' || source, '~') as src,
                         md5(coalesce(cast(doc_id as varchar), 'NULL') || ':' || coalesce(text, '')) as h
                  from documents),
    sources as (select src, cast(sum(size) as bigint) as source_size from rows group by src),
    ranked as (select src, source_size, row_number() over (order by encode(src)) - 1 as k,
                      1.5::double * sum(source_size) over () as budget from sources),
    weighed as (select *, case k % 3 when 0 then 3.0::double when 1 then 1.0 else 2.0 end as w,
                       source_size * 2.0::double as most from ranked),
    levels as (select *, (budget - coalesce(sum(most) over (order by most / w, encode(src)
                                    rows between unbounded preceding and 1 preceding), 0.0))
                         / (sum(w) over () - coalesce(sum(w) over (order by most / w, encode(src)
                                    rows between unbounded preceding and 1 preceding), 0.0)) as lev from weighed),
    level as (select first(lev order by most / w, encode(src)) as lev from levels where lev * w <= most),
    targets as (select src, k, source_size, least(most, coalesce((select lev from level) * w, most)) as target from levels),
    running as (select r.*, coalesce(sum(size) over (partition by src order by h
                                    rows between unbounded preceding and 1 preceding), 0) as before from rows r),
    placed as (select *, cast(floor(target + 0.5) as bigint) as total from running join targets using (src)),
    shared as (select *, cast(case when size = 0 then 0 else (total // source_size) * size
                      + least(size, greatest(0, total - (total // source_size) * source_size - before)) end as bigint) as taken
               from placed),
    readings as (select *, cast(case when taken = 0 then 0 else (taken + size - 1) // size end as bigint) as readings from shared),
    demand as (select *, before / total::double as y1, ((readings - 1) * source_size + before) / total::double as y2 from readings),
    times as (select *, {SCHEDULE_SQL.format(y="y1")} as t1, {SCHEDULE_SQL.format(y="y2")} as t2 from demand)
    select doc_id, size, source_size, target, taken, readings, case when readings > 0 then round(t1, 9) end as first_position,
           case when readings > 0 then round(t2, 9) end as last_position
    from times
"""


@query("op4_source_mix", MIX)
def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken, and when the first and the last reading begin (``cap`` 2: there are no others), in training order."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    # Documents that are never read stand behind all others, dealt by hash; the texts stay behind.
    placed = mixing.assigned(documents.withColumn("_llm_hash", F.xxhash64("doc_id", "text")))
    mix = placed.select(
        "doc_id", "size", "source_size", "target", "taken",
        F.size("positions").cast("long").alias("readings"),
        F.round(F.get("positions", F.lit(0)), 9).alias("first_position"),
        F.round(F.get("positions", F.size("positions") - 1), 9).alias("last_position"),
        "_llm_hash",
    )
    mix = written(mix, "mix")  # the ranges are sampled first, which would work the mix out twice
    begin = F.coalesce("first_position", F.lit(2.0))
    return mix.repartitionByRange(begin, "_llm_hash").sortWithinPartitions(begin, "_llm_hash").drop("_llm_hash")


@query("op5_feistel_shards")
def feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.sharded(documents, 16).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "number"
    )


def learned_languages(rows: DataFrame) -> dict[str, bytes]:
    """Dictionaries from the three quarters of the rows that are not held out."""
    return language.fit(rows.where(~language.held_out("doc_id")))


@query("op6_language")
def language_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = language.identify(documents.select("doc_id", "text"), learned_languages(documents))
    return found.select("doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred", "score", "rejected")


@query(
    "op7_exact_dedup",
    """select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
              row_number() over (w order by doc_id desc nulls last) = 1 as kept, sha256(coalesce(text, '')) as text_sha256
       from documents window w as (partition by coalesce(text, ''))""",
)
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The larger half of the ids goes into an index, the rest meets it there; the index goes when the fates are written."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = new_folder(spark, "fates")
    with scratch(spark):
        fates = exact.largest_stays(documents, new_index(spark), keep_text=False)
        return written_to(fates.select("doc_id", "keep_id", "group_size", "kept", "text_sha256"), path)


@query("op8_byte_bpe")
def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(documents, RANKS, public_tokenizers.PATTERN).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"
    )


@query("op9_simhash")
def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(documents, shingle=3, radius=2, carry=["doc_id"]).select(
        "doc_id", "fingerprint", "component_id"
    )


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, bad) of the pages whose document has a label; the url ends in the document's number."""
    host, path = urls.host_and_path("url")
    number = F.regexp_extract(path, r"/(\d{1,18})(?:\.html)?/?$", 1)
    numbered = pages.select(host.alias("host"), F.when(number != "", number).cast("long").alias("doc_id"))
    bad = F.greatest(1 - F.col("quality"), F.col("toxic"))
    return numbered.where(F.col("doc_id").isNotNull()).join(labels.select("doc_id", bad.alias("bad")), "doc_id").select("host", "bad")


def _rule_sql(field: int) -> str:
    """The longest fitting rule, or its verdict, as a CASE from long to short."""
    whens = []
    for verdict, rule in sorted(RULES, key=lambda r: (len(r[1]), r[1]), reverse=True):
        host, slash, path = rule.partition("/")
        fits = f"(host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '{slash + path}')"
        whens.append(f"when {fits} then '{(verdict, rule)[field]}'")
    return f"case {' '.join(whens)} end"


def _strength_sql(level: str) -> str:
    """The moment estimate of a prior's strength over the groups of a level."""
    chance = "(r.rate * (1 - r.rate))"
    beyond = (
        f"(sum(bad * bad / n) - sum(bad) * sum(bad) / sum(n) - {chance} * (count(*) - 1))"
        f" / ({chance} * (sum(n) - sum(n * n) / sum(n) - (count(*) - 1)))"
    )
    room = f"{chance} * (sum(n) - sum(n * n) / sum(n) - (count(*) - 1)) > 0"
    return f"""
        select case when count(*) < 2 or {chance} = 0 then {urls.STRONGEST}
                    when {room} and {beyond} > 0 then least({urls.STRONGEST}, greatest({urls.WEAKEST}, 1 / ({beyond}) - 1))
                    else {urls.STRONGEST} end as s
        from {level} cross join rate r group by r.rate
    """


REPUTATION = rf"""
    with urls as (select page_id, coalesce(regexp_extract(coalesce(url, ''), '(?s)^.*?://(.*)$', 1), '') as rest from pages),
    parts as (select page_id,
                     translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                     regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from urls),
    labelled as (select host, try_cast(regexp_extract(path, '/(\d{{1,18}})(?:\.html)?/?$', 1) as bigint) as doc_id from parts),
    counted as (select host, cast(count(*) as double) as n, cast(sum(greatest(1 - quality, toxic)) as double) as bad
                from labelled join labels using (doc_id) where quality is not null or toxic is not null group by host),
    named as (select *, string_split(regexp_replace(host, ':\d*$', ''), '.') as labels from counted),
    hosts as (select host, n, bad, array_to_string(labels[-2:], '.') as domain, labels[-1] as suffix from named),
    domains as (select domain, suffix, sum(n) as n, sum(bad) as bad from hosts group by 1, 2),
    suffixes as (select suffix, sum(n) as n, sum(bad) as bad from domains group by 1),
    rate as (select coalesce(sum(bad) / sum(n), {urls.NO_EVIDENCE}) as rate from suffixes),
    s0 as ({_strength_sql("suffixes")}), s1 as ({_strength_sql("domains")}), s2 as ({_strength_sql("hosts")}),
    levels as (select p.*, (r.rate * coalesce(s0.s, 1) + coalesce(x.bad, 0)) / (coalesce(x.n, 0) + coalesce(s0.s, 1)) as m0,
                      coalesce(d.n, 0) as n1, coalesce(d.bad, 0) as b1, coalesce(h.n, 0) as n2, coalesce(h.bad, 0) as b2,
                      coalesce(s1.s, 1) as s1, coalesce(s2.s, 1) as s2
               from (select *, string_split(regexp_replace(host, ':\d*$', ''), '.') as labels from parts) p
               cross join rate r left join s0 on true left join s1 on true left join s2 on true
               left join suffixes x on x.suffix = p.labels[-1]
               left join domains d on d.domain = array_to_string(p.labels[-2:], '.')
               left join hosts h on h.host = p.host),
    means as (select *, ((m0 * s1 + b1) / (n1 + s1) * s2 + b2) / (n2 + s2) as mean from levels)
    select page_id, host, path, {_rule_sql(1)} as rule,
           coalesce({_rule_sql(0)}, case when mean - {urls.DEVIATIONS} * sqrt(mean * (1 - mean) / (s2 + n2 + 1)) > {urls.LIMIT}
                                    then 'block' else 'allow' end) as verdict
    from means
"""


@query("op10_url_filter", REPUTATION)
def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    outcomes = page_outcomes(pages, table(spark, sf_dir, "labels"))
    return urls.judged(pages, RULES, outcomes).select("page_id", "host", "path", "rule", "verdict")


INFILLING = r"""
    with cut as (select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as lines,
                        sha256('7:' || coalesce(cast(doc_id as varchar), '')) as digits from documents),
    drawn as (select *, len(lines) as n, cast('0x' || digits[1:8] as bigint) % (len(lines) + 1) as one,
                     cast('0x' || digits[9:16] as bigint) % (len(lines) + 1) as two,
                     cast('0x' || digits[17:24] as bigint) % 100 as chance, cast('0x' || digits[25:32] as bigint) % 100 as turn from cut),
    parts as (select *, array_to_string(lines[1:least(one, two)], '') as prefix,
                     array_to_string(lines[least(one, two) + 1:greatest(one, two)], '') as middle,
                     array_to_string(lines[greatest(one, two) + 1:], '') as suffix,
                     case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or chance >= 100
                          then 'plain' when turn < 50 then 'spm' else 'psm' end as form from drawn)
    select doc_id, cast(n as bigint) as n, form,
           case when form <> 'plain' then cast(length(prefix) as bigint) end as prefix_chars,
           case when form <> 'plain' then cast(length(middle) as bigint) end as middle_chars,
           sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                  else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
           sha256(text) as restored_sha256
    from parts
"""


def text_digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


@query("op11_infilling", INFILLING)
def infilling_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = infilling.fill_in_middle(documents, seed=7, rate=100, spm=50)
    back = infilling.restored(F.col("output"), F.col("form"))
    return done.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        text_digest(F.col("output")).alias("output_sha256"), text_digest(back).alias("restored_sha256"),
    )


SHARED_LINES = r"""
    with split as (select row_number() over () as r, doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
    keyed as (select r, doc_id, unnest(range(1, len(lines) + 1)) as place, unnest(lines) as line from split),
    keys as (select r, doc_id, place, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from keyed where length(line) >= 40),
    shared as (select key, max(doc_id) as keeper from keys where length(key) >= 40 group by key
               having count(distinct doc_id) + max(case when doc_id is null then 1 else 0 end) >= 5),
    gone as (select r, list(place) as places from keys join shared using (key) where doc_id is distinct from keeper group by r)
    select doc_id, cast(len(lines) as bigint) as n_lines, cast(coalesce(len(places), 0) as bigint) as n_dropped,
           sha256(array_to_string(case when places is null then lines else list_filter(lines, lambda x, i: not list_contains(places, i)) end,
                                  chr(10))) as kept_sha256
    from split left join gone using (r)
"""


@query("op12_line_dedup", SHARED_LINES)
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = lines.without_shared_lines(documents, least_chars=40, least_documents=5)
    return done.select("doc_id", "n_lines", "n_dropped", text_digest(lines.kept_text()).alias("kept_sha256"))


def with_loops(documents: DataFrame) -> DataFrame:
    """Documents of which a tenth, by id, repeat a stretch of their words up to the end."""
    drawn = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words, rest = F.col("_llm_words"), F.floor(drawn / 10)
    begin = F.pmod(rest, F.size(words))
    period = F.floor((F.size(words) - begin) / (3 + F.pmod(rest, F.lit(8)))) + 1
    looped = F.transform(words, lambda word, i: F.get(words, F.when(i < begin, i).otherwise(begin + F.pmod(i - begin, period)).cast("int")))
    # Only a tenth of the texts have words here, so only they are split.
    split = F.when(drawn % 10 == 0, F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0)))
    return documents.withColumn("_llm_words", split).select(
        "doc_id", F.when(F.size(words) > 0, F.array_join(looped, " ")).otherwise(F.col("text")).alias("text")
    )


@query("op13_periodic_runs")
def periodic_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = with_loops(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic.periodic_runs(documents, least=6, exponent=4)
    # The longest run: of ties the one that starts first, then the one of the smallest period.
    longest = F.array_min(F.transform("runs", lambda run: F.struct((-run["length"]).alias("l"), run["start"].alias("s"), run["period"].alias("p"))))
    lines_of_runs = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    return found.withColumn("_llm_longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("_llm_longest.s").alias("start"),
        (-F.col("_llm_longest.l")).alias("length"),
        F.col("_llm_longest.p").alias("period"),
        F.floor(-1000 * F.col("_llm_longest.l") / F.col("_llm_longest.p")).alias("exponent_milli"),
        text_digest(F.array_join(lines_of_runs, "")).alias("runs_sha256"),
        text_digest(F.col("collapsed")).alias("collapsed_sha256"),
    )
