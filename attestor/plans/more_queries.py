"""Lookups with fallbacks, guards, bit folds, ranks and continuations over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from attestor.operators import carry, report
from attestor.operators import resolve as rs
from attestor.plans.catalogue import query


@query("""
with t as (select s_nationkey as k, min(s_name) as v from supplier where s_acctbal > 5000 group by 1)
select c_custkey, coalesce(a.v, b.v) as supplier, case when a.v is not null then 'key' when b.v is not null then 'fallback' end as method
from customer join nation on n_nationkey = c_nationkey left join t a on a.k = c_nationkey left join t b on b.k = n_regionkey
""")
def fallback_lookup(t):
    c = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
    s = t.supplier.where("s_acctbal > 5000").groupBy("s_nationkey").agg(F.min("s_name").alias("s_name"))
    return rs.lookup_with_fallback(c, "c_nationkey", "n_regionkey", s, "s_nationkey", "s_name", "supplier").select("c_custkey", "supplier", "method")


@query("""
with a as (select l_orderkey as k, list_sort(list(distinct l_linenumber)) as xs from lineitem where l_returnflag = 'A' group by 1),
     b as (select l_orderkey as k, list_sort(list(distinct l_linenumber)) as ys from lineitem where l_returnflag = 'R' group by 1),
     u as (select a.k, xs, ys, list_sort(list_distinct(list_concat(xs, coalesce(ys, [])))) as us from a left join b on a.k = b.k)
select k as l_orderkey, array_to_string(case when len(us) > 4 then xs else us end, ',') as items,
  case when ys is null then 'alone' when len(us) > 4 then 'too many' when len(us) = len(xs) then 'same' else 'completed' end as note from u
""")
def guarded_completion(t):
    side = lambda f: t.lineitem.where(f"l_returnflag = '{f}'").groupBy("l_orderkey").agg(F.array_sort(F.collect_set("l_linenumber")).alias("items"))
    out = rs.complete(side("A"), side("R"), ["l_orderkey"], "items", 4)
    return out.select("l_orderkey", F.array_join(F.transform("items", lambda x: x.cast("string")), ",").alias("items"), "note")


@query("""
select l_orderkey, case when count(l_linenumber) = count(distinct l_linenumber) and min(l_linenumber) > 0 then array_to_string(list_sort(list(distinct l_linenumber)), ';') end as "values",
  count(l_linenumber) as observed from lineitem group by 1
""")
def uniqueness_guard(t):
    return report.unique_or_none(t.lineitem, ["l_orderkey"], "l_linenumber")


@query("select l_orderkey, xor(bit_or(l_suppkey), bit_and(l_suppkey)) as differ from lineitem group by 1")
def differing_bits(t):
    return report.differing_bits(t.lineitem, ["l_orderkey"], "l_suppkey")


@query("""select user_id, event_type, string_agg(distinct cast(hour(ts) as varchar), ';' order by cast(hour(ts) as varchar)) as "values" from events group by 1, 2""")
def matrix_of_sets(t):
    return report.matrix(t.events.withColumn("hour", F.hour("ts")), "user_id", "event_type", "hour")


@query("""
select o_orderkey, cast(case o_orderpriority when '1-URGENT' then 1 when '2-HIGH' then 2 when '3-MEDIUM' then 3 else 4 end as int) as rank from orders
""")
def rank_mapped(t):
    return report.ranked(t.orders, "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"]).select("o_orderkey", "rank")


@query("""
with c as (select *, case when turn - lag(turn) over w = 1 and lag(length(role)) over w = length(role) then 0 else 1 end as new from conversations window w as (partition by conv_id order by turn))
select conv_id, turn, cast(sum(new) over (partition by conv_id order by turn rows between unbounded preceding and current row) as bigint) as "table" from c
""")
def continued_tables(t):
    c = t.conversations.select("conv_id", "turn", F.length("role").alias("width"))
    return carry.continued(c, ["conv_id"], "turn", "width").select("conv_id", "turn", F.col("table").cast("long").alias("table"))


@query("""
select o_orderkey, o_custkey || ',' || coalesce(nullif(o_orderstatus, 'O'), cast(o_custkey as varchar)) || ',' || coalesce(nullif(o_orderstatus, 'O'), cast(o_custkey as varchar)) as cells from orders
""")
def locf_across(t):
    cells = F.array(F.col("o_custkey").cast("string"), F.nullif(F.col("o_orderstatus"), F.lit("O")), F.lit(None).cast("string"))
    return t.orders.select("o_orderkey", F.array_join(carry.locf_array(cells), ",").alias("cells"))
