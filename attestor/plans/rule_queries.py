"""Integrity rules over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from attestor.operators import rules
from attestor.plans.catalogue import query

_FK = {
    "nation.region": ("nation", "n_regionkey", "region", "r_regionkey"),
    "customer.nation": ("customer", "c_nationkey", "nation", "n_nationkey"),
    "supplier.nation": ("supplier", "s_nationkey", "nation", "n_nationkey"),
    "orders.customer": ("orders", "o_custkey", "customer", "c_custkey"),
    "lineitem.orders": ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    "lineitem.part": ("lineitem", "l_partkey", "part", "p_partkey"),
    "lineitem.supplier": ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    "labels.documents": ("labels", "doc_id", "documents", "doc_id"),
    "events.customer": ("events", "user_id", "customer", "c_custkey"),
}


#: Rows that no parent has, added to three of the children.
_ORPHANS = {"orders.customer": [-1, -2, -2], "lineitem.part": [-7], "labels.documents": [-3, -4]}


def _fk_sql(n, a, c, b, d):
    more = "".join(f" union all select {v}" for v in _ORPHANS.get(n, []))
    return f"select '{n}' as rule, count(*) as violations from (select distinct v from (select {c} as v from {a}{more}) where v is not null) where v not in (select {d} from {b})"


@query(" union all ".join(_fk_sql(n, *x) for n, x in _FK.items()))
def fk_violations(t):
    def child(n, a, c):
        rows = getattr(t, a).select(c)
        return rows.unionByName(t.spark.createDataFrame([(v,) for v in _ORPHANS[n]], f"{c} long")) if n in _ORPHANS else rows

    return rules.counts(list(_FK), [rules.foreign_key(n, child(n, a, c), c, getattr(t, b), d) for n, (a, c, b, d) in _FK.items()])


@query("select 'lineitem.key' as rule, l_orderkey || '|' || l_linenumber as key, cast(count(*) as varchar) as detail from lineitem group by l_orderkey, l_linenumber having count(*) > 1")
def unique_key_violations(t):
    return rules.unique("lineitem.key", t.lineitem, ["l_orderkey", "l_linenumber"])


@query("""
select 'customer.name' as rule, cast(c_custkey as varchar) as key, c_name as detail from customer where not regexp_matches(c_name, '^Customer#[0-9]*[02468]$')
union select 'part.brand', cast(p_partkey as varchar), p_brand from part where not regexp_matches(p_brand, '^Brand#[1-3][0-9]*$')
union select 'pages.url', cast(page_id as varchar), url from pages where not regexp_matches(url, '^https://')
""")
def shape_violations(t):
    return rules.violations([
        rules.shape("customer.name", t.customer, "c_custkey", "c_name", "^Customer#[0-9]*[02468]$"),
        rules.shape("part.brand", t.part, "p_partkey", "p_brand", "^Brand#[1-3][0-9]*$"),
        rules.shape("pages.url", t.pages, "page_id", "url", "^https://"),
    ])


@query("""
select 'F means all lines F' as rule, cast(o_orderkey as varchar) as key, s as detail
from orders join (select l_orderkey, string_agg(distinct l_linestatus, ';' order by l_linestatus) as s from lineitem group by 1) on l_orderkey = o_orderkey
where o_orderstatus = 'F' and s <> 'F'
""")
def implication_violations(t):
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_join(F.array_sort(F.collect_set("l_linestatus")), ";").alias("s"))
    return rules.implies("F means all lines F", t.orders.join(lines, "o_orderkey"), "o_orderkey", F.col("o_orderstatus") == "F", F.col("s") == "F", F.col("s"))


_INTERVALS = """
with e as (select event_id, user_id, date_diff('second', timestamp '2000-01-01 00:00:00', date_trunc('second', ts)) as s from events),
i as (select *, s + 3600 as e, max(s + 3600) over (partition by user_id order by s, s + 3600, event_id rows between unbounded preceding and 1 preceding) as m from e)
select 'busy' as rule, cast(event_id as varchar) as key, cast(m as varchar) as detail from i where s < m
"""


@query(_INTERVALS)
def interval_overlap(t):
    s = F.expr("timestampdiff(SECOND, timestamp_ntz'2000-01-01 00:00:00', ts)")
    e = t.events.select("event_id", "user_id", s.alias("s")).withColumn("e", F.col("s") + 3600)
    return rules.intervals_overlap("busy", e, ["user_id"], "s", "e", "event_id")


@query("""
select 'bit' as rule, l_orderkey || '|' || l_linenumber % 5 as key, cast(count(*) as varchar) as detail from lineitem group by l_orderkey, l_linenumber % 5 having count(*) > 1
""")
def bits_overlap(t):
    return rules.bits_overlap("bit", t.lineitem.select("l_orderkey", F.array((F.col("l_linenumber") % 5)).alias("bits")), ["l_orderkey"], "bits")


@query("""
with s as (select l_orderkey, cast(sum(cast(round(l_extendedprice * 100) as bigint)) as bigint) as cents from lineitem group by 1)
select 'total' as rule, cast(o_orderkey as varchar) as key, cast(cast(round(o_totalprice * 100) as bigint) as varchar) || ' <> ' || cents as detail
from orders join s on l_orderkey = o_orderkey where cast(round(o_totalprice * 100) as bigint) <> cents
""")
def cross_table_equality(t):
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("cents"))
    return rules.equal_across("total", t.orders.withColumn("stated", F.round(F.col("o_totalprice") * 100).cast("long")), lines, ["o_orderkey"], "stated", "cents")


@query("""
select 'pair' as rule, cast(l_orderkey as varchar) as key, 'a without b' as detail from (
  select l_orderkey, max(case when l_returnflag = 'A' then 1 end) as a, max(case when l_returnflag = 'R' then 1 end) as b from lineitem group by 1) where (a is null) <> (b is null)
union all
select 'either', cast(l_orderkey as varchar), 'a and b' from (
  select l_orderkey, max(case when l_returnflag = 'A' then 1 end) as a, max(case when l_returnflag = 'R' then 1 end) as b from lineitem group by 1) where a is not null and b is not null
""")
def paired_and_exclusive(t):
    flag = lambda f: F.max(F.when(F.col("l_returnflag") == f, 1))
    g = t.lineitem.groupBy("l_orderkey").agg(flag("A").alias("a"), flag("R").alias("b"))
    return rules.violations([rules.both_or_neither("pair", g, "l_orderkey", "a", "b"), rules.mutually_exclusive("either", g, "l_orderkey", "a", "b")])


@query("""
select 'supply' as rule, concat_ws('|', l_partkey, l_suppkey) as key, 'no such parent' as detail
from (select distinct l_partkey, l_suppkey from lineitem where l_returnflag = 'R') r
where not exists (select 1 from lineitem x where x.l_returnflag = 'N' and x.l_partkey = r.l_partkey and x.l_suppkey = r.l_suppkey)
""")
def composite_reference(t):
    li = t.lineitem
    return rules.composite_key("supply", li.where("l_returnflag = 'R'"), li.where("l_returnflag = 'N'"), ["l_partkey", "l_suppkey"])


@query("""select 'discount' as rule, cast(l_orderkey * 10 + l_linenumber as varchar) as key, cast(cast(round(l_discount * 100) as bigint) as varchar) as detail from lineitem where not (round(l_discount * 100) < (1 << 3))""")
def value_range_by_width(t):
    li = t.lineitem.withColumn("k", F.col("l_orderkey") * 10 + F.col("l_linenumber")).withColumn("d", F.round(F.col("l_discount") * 100).cast("long"))
    return rules.holds("discount", li, "k", F.col("d") < F.expr("shiftleft(1L, 3)"), F.col("d"))
