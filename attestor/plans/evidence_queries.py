"""Evidence, roll-ups, reconciliation and resolution over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from attestor.operators import evidence as ev
from attestor.operators import reconcile as rc
from attestor.operators import resolve as rs
from attestor.plans.catalogue import query

ORDERED_SEGMENTS = {s: ord(s[0]) for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")}

_ORDER_EVIDENCE = """
with ev as (
  select o_orderkey k, 1 ord, 'orders' src, o_orderstatus v from orders
  union all select l_orderkey, 2, 'lineitem', case when min(l_linestatus) = max(l_linestatus) then min(l_linestatus) else 'P' end from lineitem group by l_orderkey),
j as (
  select k, min_by(v, ord) as value, count(distinct lower(v)) as d, count(*) as n, string_agg(src, '+' order by ord) as basis from ev group by k),
judged as (
  select k as o_orderkey, value, case when d > 1 then 'conflict' when n >= 2 then 'confirmed' else 'reference' end as confidence, basis from j)
"""


def _order_status(t):
    stated = ev.readings(t.orders, ["o_orderkey"], 1, "orders", F.col("o_orderstatus"))
    derived = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_linestatus").alias("a"), F.max("l_linestatus").alias("b"))
    derived = ev.readings(derived, ["o_orderkey"], 2, "lineitem", F.when(F.col("a") == F.col("b"), F.col("a")).otherwise("P"))
    return ev.judge(stated.unionByName(derived), ["o_orderkey"])


@query(_ORDER_EVIDENCE + "select * from judged")
def judge_order_status(t):
    return _order_status(t)


@query(_ORDER_EVIDENCE + "select confidence, count(*) as n from judged group by confidence")
def judge_confidence_tally(t):
    return ev.tally(_order_status(t))


@query("""
select doc_id, cast(n_chars as varchar) as value,
       case when length(text) <> n_chars or len(regexp_extract_all(text, '[^ ]+')) < 20 then 'conflict' else 'confirmed' end as confidence,
       'n_chars+' || case when length(text) = n_chars then 'length' else '!length' end || '+' || case when len(regexp_extract_all(text, '[^ ]+')) >= 20 then 'twenty_words' else '!twenty_words' end as basis
from documents
""")
def judge_doc_length(t):
    d = t.documents
    rows = ev.readings(d, ["doc_id"], 1, "n_chars", F.col("n_chars"))
    rows = rows.unionByName(ev.checks(d, ["doc_id"], 2, "length", F.length("text") == F.col("n_chars")))
    words = F.size(F.regexp_extract_all("text", F.lit("[^ ]+"), 0))
    return ev.judge(rows.unionByName(ev.checks(d, ["doc_id"], 3, "twenty_words", words >= 20)), ["doc_id"])


@query("""
with b as (select l_partkey as p, min(l_extendedprice / l_quantity) as lo, max(l_extendedprice / l_quantity) as hi from lineitem group by 1)
select p_partkey, cast(p_size as varchar) as value,
       case when b.p is not null and p_retailprice between lo and hi then 'confirmed' else 'reference' end as confidence,
       'part' || case when b.p is null then '' when p_retailprice between lo and hi then '+price_band' else '+?price_band' end as basis
from part left join b on b.p = p_partkey
""")
def judge_soft_check(t):
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    band = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.min(unit).alias("lo"), F.max(unit).alias("hi"))
    rows = ev.readings(t.part, ["p_partkey"], 1, "part", F.col("p_size"))
    seen = t.part.join(band, "p_partkey")
    return ev.judge(rows.unionByName(ev.checks(seen, ["p_partkey"], 2, "price_band", F.col("p_retailprice").between(F.col("lo"), F.col("hi")), soft=True)), ["p_partkey"])


@query("""
select event_id, user_id, event_type from (
  select *, row_number() over (partition by user_id, lower(event_type) order by ts, event_id) as n from events) where n = 1
""")
def evidence_dedup(t):
    e = t.events
    rows = ev.readings(e.withColumn("o", F.row_number().over(_by_user())), ["user_id", "event_id", "o"], 1, "events", F.col("event_type")).withColumn("ord", F.col("o"))
    return ev.dedup_evidence(rows, ["user_id"]).select("event_id", "user_id", F.col("value").alias("event_type"))


def _by_user():
    from pyspark.sql import Window

    return Window.partitionBy("user_id").orderBy("ts", "event_id")


@query("""
with m as (select p_brand, p_type, case when count(distinct p_size) = 1 then cast(min(p_size) as varchar) end as v, count(*) as n from part group by 1, 2)
select p_brand, case when count(distinct v) = 1 then min(v) end as value,
       case when count(distinct v) = 0 then 'missing' when count(distinct v) > 1 then 'varies' when bool_and(case when v is not null then n >= 2 end) then 'confirmed' else 'partial' end as confidence,
       count(v) as members_stated, count(*) as members
from m group by p_brand
""")
def rollup_varies(t):
    m = t.part.groupBy("p_brand", "p_type").agg(F.countDistinct("p_size").alias("d"), F.min("p_size").alias("s"), F.count("*").alias("n"))
    m = m.withColumn("v", F.when(F.col("d") == 1, F.col("s").cast("string"))).withColumn("c", F.when(F.col("n") >= 2, "confirmed").otherwise("reference"))
    return ev.rollup(m, ["p_brand"], "v", "c")


@query("""
select r_name, count(distinct n_nationkey) as nations, count(distinct c_custkey) as customers, count(o_orderkey) as orders,
       cast(coalesce(sum(cast(round(o_totalprice * 100) as bigint)), 0) as bigint) as cents,
       string_agg(distinct n_name, ';' order by n_name) as nation_list
from region join nation on n_regionkey = r_regionkey left join customer on c_nationkey = n_nationkey left join orders on o_custkey = c_custkey
group by r_name
""")
def rollup_hierarchy(t):
    o = t.orders.groupBy("o_custkey").agg(F.count("*").alias("orders"), F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"))
    c = t.customer.select("c_custkey", "c_nationkey").join(o, F.col("c_custkey") == F.col("o_custkey"), "left")
    n = c.groupBy("c_nationkey").agg(F.count("*").alias("customers"), F.sum("orders").alias("orders"), F.sum("cents").alias("cents"))
    n = t.nation.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
    return n.groupBy("r_name").agg(F.count("*").alias("nations"), zero("customers"), zero("orders"), zero("cents"), F.array_join(F.array_sort(F.collect_set("n_name")), ";").alias("nation_list"))


@query("""
with e as (
  select distinct c_nationkey as nation, c_mktsegment as src, ascii(c_mktsegment) as ord, case when c_acctbal >= 0 then 'credit' else 'debit' end as v
  from customer where abs(c_acctbal) > 900 and c_acctbal % 3 < 0.5)
select nation, min_by(v, ord * 10 + case v when 'credit' then 0 else 1 end) as value, case when count(distinct v) > 1 then 'conflict' when count(*) >= 2 then 'confirmed' else 'reference' end as confidence,
  string_agg(src, '+' order by ord, v) as basis
from e group by nation
""")
def judge_pooled(t):
    c = t.customer.where("abs(c_acctbal) > 900 and c_acctbal % 3 < 0.5").withColumnRenamed("c_nationkey", "nation").withColumn("v", F.when(F.col("c_acctbal") >= 0, "credit").otherwise("debit"))
    said = None
    for segment in sorted(ORDERED_SEGMENTS):
        rows = ev.readings(c.where(F.col("c_mktsegment") == segment), ["c_custkey"], ORDERED_SEGMENTS[segment], segment, F.col("v"))
        said = rows if said is None else said.unionByName(rows)
    return ev.pooled(c, said, "c_custkey", ["nation"])


@query("""
with a as (select doc_id, quality from labels), b as (select doc_id, case when n_chars >= 1000 then 1 else 0 end as quality from documents)
select coalesce(a.doc_id, b.doc_id) as doc_id, coalesce(a.quality, b.quality) as value,
       case when a.doc_id is null or b.doc_id is null then 'reference' when a.quality = b.quality then 'confirmed' else 'conflict' end as confidence,
       case when b.doc_id is null then 'a' when a.doc_id is null then 'b' else 'a+b' end as basis
from a full join b on a.doc_id = b.doc_id
""")
def edition_merge(t):
    rule = t.documents.select("doc_id", F.when(F.col("n_chars") >= 1000, 1).otherwise(0).alias("quality"))
    return rc.edition_merge(t.labels.select("doc_id", F.col("quality").cast("int").alias("quality")), rule, ["doc_id"], "quality")


@query("""
with a as (select distinct c_nationkey as nation, c_mktsegment as item from customer where c_acctbal > 5000),
     b as (select distinct c_nationkey as nation, c_mktsegment as item from customer where c_acctbal < 0)
select coalesce(a.nation, b.nation) as nation, coalesce(a.item, b.item) as item, a.item is not null as in_a, b.item is not null as in_b,
       case when a.item is not null and b.item is not null then 'confirmed' else 'reference' end as confidence
from a full join b on a.nation = b.nation and a.item = b.item
""")
def set_merge(t):
    c = t.customer.select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("item"), "c_acctbal")
    return rc.set_merge(c.where("c_acctbal > 5000"), c.where("c_acctbal < 0"), ["nation", "item"])


@query("""
with a as (select distinct c_nationkey as g, c_mktsegment as item from customer where c_acctbal > 9000), b as (select distinct c_nationkey as g, c_mktsegment as item from customer where c_acctbal < 0),
x as (select g, count(*) as n, min(item) as item_a from (select * from a except select * from b) group by g),
y as (select g, count(*) as n, min(item) as item_b from (select * from b except select * from a) group by g)
select x.g as c_nationkey, item_a, item_b from x join y on x.g = y.g where x.n = 1 and y.n = 1
""")
def residual_pairing(t):
    c = t.customer
    return rc.residual_pairs(c.where("c_acctbal > 9000"), c.where("c_acctbal < 0"), ["c_nationkey"], "c_mktsegment")


@query("""
select p_brand, case when count(distinct p_type) = 1 then min(p_type) end as value, count(distinct p_type) as spellings from part where p_size <= 3 group by 1
""")
def consensus_guard(t):
    return rc.consensus(t.part.where("p_size <= 3"), ["p_brand"], "p_type")


@query("""
with g as (
  select n_regionkey, c_mktsegment, c_acctbal >= 0 as positive, string_agg(distinct n_name, ';' order by n_name) as names
  from customer join nation on n_nationkey = c_nationkey group by 1, 2, 3)
select n_regionkey, c_mktsegment, positive, names, count(*) over (partition by n_regionkey, c_mktsegment) > 1 as disagrees from g
""")
def union_merge_disagree(t):
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("n_regionkey", "c_mktsegment", (F.col("c_acctbal") >= 0).alias("positive"), F.array("n_name").alias("names"))
    out = rc.union_merge(c, ["n_regionkey", "c_mktsegment"], ["positive"], "names")
    return out.withColumn("names", F.array_join("names", ";"))


_GREEDY = """
with a as (select l_partkey, l_orderkey * 10 + l_linenumber as id, row_number() over (partition by l_partkey order by l_orderkey, l_linenumber, l_suppkey, l_extendedprice) as n from lineitem where l_returnflag = 'R'),
     b as (select l_partkey, l_orderkey * 10 + l_linenumber as id, row_number() over (partition by l_partkey order by l_orderkey, l_linenumber, l_suppkey, l_extendedprice) as n from lineitem where l_returnflag = 'A')
select coalesce(a.l_partkey, b.l_partkey) as l_partkey, a.id as left_id, b.id as right_id from a full join b on a.l_partkey = b.l_partkey and a.n = b.n
"""


@query(_GREEDY)
def rank_match(t):
    rows = t.lineitem.withColumn("id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    order = ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"]
    return rc.rank_match(rows.where("l_returnflag = 'R'"), rows.where("l_returnflag = 'A'"), ["l_partkey"], order, order, "id", "id")


@query()
def greedy_match(t):
    rows = t.lineitem.withColumn("mode", F.when(F.col("l_tax") > 0.02, F.col("l_linestatus"))).withColumn("size", F.col("l_linenumber") % 3)
    order = ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"]
    return rc.greedy_match(rows.where("l_returnflag = 'R'"), rows.where("l_returnflag = 'A'"), ["l_partkey"], order, ["size"], ["mode"])


@query()
def align_turns(t):
    c = t.conversations.where("role in ('user', 'assistant')").select("conv_id", F.when(F.col("role") == "user", 0).otherwise(1).alias("side"), "turn", F.posexplode(F.split("text", r"\s+")).alias("at", "word"))
    return rc.align(c, ["conv_id"], "side", ["turn", "at"], "word")


@query("""
with exact as (select c_custkey as k, n_name as v from customer join nation on n_nationkey = c_nationkey where c_acctbal > 9000),
     segment as (select c.c_custkey as k, min(n_name) as v from customer c join supplier s on s.s_nationkey = c.c_nationkey and s.s_acctbal > 9000 join nation on n_nationkey = s.s_nationkey group by 1 having count(distinct n_name) = 1),
     rest as (select c_custkey as k, r_name as v from customer join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey)
select k, v, tier, method from (
  select *, row_number() over (partition by k order by tier) as n from (
    select k, v, 0 as tier, 'rich' as method from exact union all select k, v, 1, 'supplied' from segment union all select k, v, 2, 'region' from rest)) where n = 1
""")
def tiered_resolution(t):
    n = t.nation
    c = t.customer.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    rich = c.where("c_acctbal > 9000").select(F.col("c_custkey").alias("k"), F.col("n_name").alias("v"))
    supplied = t.supplier.where("s_acctbal > 9000").select("s_nationkey").distinct()
    two = c.join(supplied, F.col("s_nationkey") == F.col("c_nationkey"), "left_semi").select(F.col("c_custkey").alias("k"), F.col("n_name").alias("v"))
    rest = c.join(t.region, F.col("r_regionkey") == F.col("n_regionkey")).select(F.col("c_custkey").alias("k"), F.col("r_name").alias("v"))
    return rs.tiered([("rich", rich, True), ("supplied", two, True), ("region", rest, False)], "k", "v")


@query("""
with p as (select distinct substr(c_name, 1, length(c_name) - 1) as prefix from customer)
select prefix, count(c_name) as hits, case when count(c_name) = 1 then min(c_name) end as name
from p left join (select distinct c_name from customer) on starts_with(c_name, prefix) and substr(c_name, 1, 14) = substr(prefix, 1, 14) group by prefix
""")
def unique_prefix_join(t):
    c = t.customer
    return rs.unique_prefix(c, "c_name", c.select(F.expr("substring(c_name, 1, length(c_name) - 1)").alias("prefix")), "prefix", 14)


@query("""
with p as (select distinct regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[a-z]+://', '') as path from pages),
     q as (select distinct unnest([path, regexp_replace(path, '/[^/]*$', ''), regexp_replace(path, '/.*$', '')]) as path from p)
select a.path, max_by(b.path, length(b.path)) as parent from q a left join q b on starts_with(a.path, b.path || '/') group by a.path
""")
def longest_prefix_parent(t):
    path = F.regexp_replace(F.regexp_replace("url", "[?#].*$", ""), "^[a-z]+://", "")
    p = t.pages.select(path.alias("path"))
    p = p.select(F.explode(F.array("path", F.regexp_replace("path", "/[^/]*$", ""), F.regexp_replace("path", "/.*$", ""))).alias("path"))
    return rs.longest_prefix_parent(p, "path", "/")


@query("""
select o_orderkey from orders where exists (select 1 from lineitem where l_orderkey = o_orderkey and l_returnflag = 'R')
  and exists (select 1 from customer where c_custkey = o_custkey and c_acctbal > 0)
  and not exists (select 1 from lineitem where l_orderkey = o_orderkey and l_discount > 0.09)
""")
def admit_and_refute(t):
    li = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    o = rs.admit(t.orders, (li.where("l_returnflag = 'R'"), ["o_orderkey"]), (t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey")), ["o_custkey"]))
    return rs.refuted(o, li.where("l_discount > 0.09"), ["o_orderkey"]).select("o_orderkey")


@query("""
with recursive e as (select p_partkey as node, p_partkey // 3 as up from part where p_partkey >= 3),
r as (select node, up as ancestor, 1 as depth from e union all select r.node, e.up, r.depth + 1 from r join e on e.node = r.ancestor)
select node, cast(ancestor as bigint) as ancestor, depth from r
""")
def recursive_chain(t):
    e = t.part.where("p_partkey >= 3").select(F.col("p_partkey").alias("node"), F.expr("p_partkey div 3").alias("up"))
    return rs.ancestors(e, "node", "up")
