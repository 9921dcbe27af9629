"""Order-dependent operators over events, conversations and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from attestor.operators import carry
from attestor.plans.catalogue import query

TS = ["ts", "event_id"]


def _seconds(column="ts"):
    """Whole seconds of a timestamp without zone; no cast depends on a session's zone."""
    return F.expr(f"timestampdiff(SECOND, timestamp_ntz'2000-01-01 00:00:00', {column})")


@query("""
select event_id, user_id, last_value(case when event_type <> 'view' then event_type end ignore nulls) over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) as carried from events
""")
def locf_status(t):
    e = t.events.withColumn("known", F.when(F.col("event_type") != "view", F.col("event_type")))
    return carry.locf(e, ["user_id"], TS, "known", "carried").select("event_id", "user_id", "carried")


@query("""
with l as (select *, sum(case when role = 'system' then 1 else 0 end) over (partition by conv_id order by turn rows between unbounded preceding and current row) as level from conversations)
select conv_id, turn, last_value(case when role = 'user' then turn end ignore nulls) over (partition by conv_id, level order by turn rows between unbounded preceding and current row) as last_user from l
""")
def locf_hierarchical(t):
    c = t.conversations.withColumn("u", F.when(F.col("role") == "user", F.col("turn")))
    return carry.locf_within(c, ["conv_id"], ["turn"], F.col("role") == "system", "u", "last_user").select("conv_id", "turn", "last_user")


@query("""
select doc_id, cast(coalesce(sum(n_chars) over (partition by source, lang order by doc_id rows between unbounded preceding and 1 preceding), 0) as bigint) as at from documents
""")
def running_offset(t):
    return carry.spread_offset(t.documents.select("doc_id", "source", "lang", "n_chars"), ["source", "lang"], ["doc_id"], F.col("n_chars"), "at").select("doc_id", F.col("at").cast("long").alias("at"))


@query("""
with c as (select *, case when lag(event_type) over w = event_type then 0 else 1 end as c from events window w as (partition by user_id order by ts, event_id)),
i as (select *, sum(c) over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) as island from c)
select user_id, cast(island as bigint) as island, event_type, count(*) as n, min(event_id) as first_event from i group by 1, 2, 3
""")
def islands_same_type(t):
    e = carry.islands(t.events, ["user_id"], TS, "event_type")
    return e.groupBy("user_id", F.col("island").cast("long").alias("island"), "event_type").agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"))


@query("""
with e as (select user_id, event_id, ts, date_diff('second', timestamp '2000-01-01 00:00:00', date_trunc('second', ts)) as s from events),
c as (select *, case when max(s + event_id % 600) over w is null or s - max(s + event_id % 600) over w > 1800 then 1 else 0 end as c
      from e window w as (partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding)),
i as (select *, sum(c) over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) as session from c)
select user_id, cast(session as bigint) as session, count(*) as n, min(s) as first_s, max(s) as last_s from i group by 1, 2
""")
def gap_sessions(t):
    e = t.events.select("user_id", "event_id", "ts", _seconds().alias("s"))
    e = carry.gap_sessions(e, ["user_id"], TS, F.col("s"), F.col("s") + F.col("event_id") % 600, 1800)
    return e.groupBy("user_id", F.col("session").cast("long").alias("session")).agg(F.count("*").alias("n"), F.min("s").alias("first_s"), F.max("s").alias("last_s"))


@query("""
select conv_id, count(turn) as steps, min(turn) as first, max(turn) as last, max(turn) - min(turn) + 1 = count(turn) and count(distinct turn) = count(turn) as dense from conversations group by conv_id
""")
def dense_turn_check(t):
    return carry.dense(t.conversations, ["conv_id"], "turn")


@query("""
with c as (select *, case when lag(event_type) over w = event_type then 0 else 1 end as c from events window w as (partition by user_id order by ts, event_id)),
i as (select *, sum(c) over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) as island from c),
r as (select user_id, island, min(event_type) as v from i group by 1, 2),
n as (select *, lead(v) over (partition by user_id order by island) as next_type from r)
select event_id, event_type, next_type from i join n using (user_id, island)
""")
def next_different(t):
    return carry.next_different(t.events.select("event_id", "user_id", "ts", "event_type"), ["user_id"], TS, "event_type", "next_type").select("event_id", "event_type", "next_type")


@query("select event_id, row_number() over (partition by user_id, event_type order by ts, event_id) - 1 as n from events")
def ordinal_per_token(t):
    return carry.ordinal(t.events, ["user_id", "event_type"], TS, "n").select("event_id", F.col("n").cast("long").alias("n"))


@query("""
select p_partkey, p_type || repeat('_', cast(row_number() over (partition by p_brand, p_type order by p_partkey) - 1 as int)) as name from part
""")
def suffix_repeats(t):
    return carry.suffix_repeats(t.part, ["p_brand"], "p_type", ["p_partkey"], "name").select("p_partkey", "name")


@query("""
with g as (select c_nationkey, c_mktsegment, count(*) as n from customer group by 1, 2)
select c_nationkey, c_mktsegment, n, round(n / sum(n) over (partition by c_nationkey), 9) as share from g
""")
def ratio_to_total(t):
    g = t.customer.groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"))
    return carry.share(g, ["c_nationkey"], "n", "share").withColumn("share", F.round("share", 9))


@query("""
select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by ts, event_id) as n from events) where n = 1
""")
def first_per_group(t):
    from attestor.operators.resolve import first_match

    return first_match(t.events, ["user_id"], TS).select("user_id", "event_id", "event_type")


@query("""
select c_name, c_custkey from customer
order by try_cast(regexp_extract(c_name, '([0-9]+)$', 1) as bigint) is null, try_cast(regexp_extract(c_name, '([0-9]+)$', 1) as bigint) nulls last, c_name nulls last limit 40
""")
def natural_sort_topk(t):
    from attestor.functions.canon import natural_key
    from attestor.operators.report import top

    c = t.customer.withColumn("k", F.regexp_extract("c_name", "([0-9]+)$", 1))
    return top(c, [*natural_key("k"), F.col("c_name").asc_nulls_last()], 40).select("c_name", "c_custkey")
