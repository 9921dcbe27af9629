"""Selector resolution, value unions, ownership, scopes and the other joins and lists over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from attestor.operators import reconcile as rc
from attestor.operators import resolve as rs
from attestor.operators import selectors as sel
from attestor.plans.catalogue import query

FIELDS = {
    "S0": ["TIM1", "TIM2", "USART1", "ADC1_ETRGINJ", "ADC1_ETRGREG", "SPI3", "ISINK1_ADJ"],
    "S1": ["TIM3", "USART2", "UHSIF_CLK", "UHSIF_PORT", "SPI3"],
    "S2": ["TIM1", "ADC1_ETRGINJ", "ISINK1_ADJ", "USART3"],
}
_FIELDS_SQL = "fields as (select * from (values " + ", ".join(f"('{s}', '{k}')" for s, keys in FIELDS.items() for k in keys) + ") v(series, key))"
_KEYS = "['TIM1', 'ADC1_ETRGINJ', 'ISINK1_ADJ', 'TIM3', 'USART2']"
_INSTANCE = "'^([A-Z][A-Z0-9]*?)([0-9]*)$'"
_SIGNAL = """case o_orderkey % 7 when 0 then 'TIM' || o_custkey % 5 || '_CH1' when 1 then 'TX' || o_custkey % 4 when 2 then 'ADC_ETR' when 3 then 'ISINK1'
  when 4 then 'I2S3_WS' when 5 then 'T' || o_custkey % 4 || 'C2' else 'UHSIF_PORT33' end"""


def _fields(t):
    return t.spark.createDataFrame([(s, k) for s, keys in FIELDS.items() for k in keys], "series string, key string")


@query(f"""
with {_FIELDS_SQL},
f as (select o_orderkey as id, 'S' || o_custkey % 3 as series, cast(o_custkey % 4 as int) as value, 'PA' || o_orderkey % 6 as pad,
  case o_orderkey % 7 when 0 then 'TIM' || o_custkey % 5 when 1 then 'USART' || o_custkey % 4 when 2 then 'ADC1' when 4 then 'I2S3' when 5 then 'TIM' || o_custkey % 4 when 6 then 'UHSIF' end as named,
  case o_orderkey % 7 when 0 then 'TIM' || o_custkey % 5 || '_CH1' when 1 then 'USART' || o_custkey % 4 || '_TX' when 2 then 'ADC1_ETR' when 3 then 'ISINK1' when 4 then 'I2S3_WS' when 5 then 'TIM' || o_custkey % 4 || '_CH2' else 'UHSIF_PORT33' end as signal from orders),
h as (select *, coalesce(named, signal) as head from f),
stated as (select distinct 'S' || c_custkey % 3 as series, 'TIM' || c_custkey % 5 || '_CH1' as signal, cast(c_custkey % 4 as int) as value, 'PA' || c_custkey % 6 as pad, 'TIM' || c_nationkey % 5 as key from customer where c_custkey % 7 = 0),
grid as (select distinct 'S' || p_partkey % 3 as series, 'PA' || p_partkey % 6 as pad, p_size % 4 as value, {_KEYS}[p_partkey % 5 + 1] as key from part where p_partkey % 11 = 0),
anyw as (select distinct 'S' || s_suppkey % 3 as series, 'PA' || s_suppkey % 6 as pad, s_nationkey % 4 as value, {_KEYS}[s_suppkey % 5 + 1] as key from supplier),
c as (
  select id, named, s.key, 0 as step, 'signal' as method from h join stated s using (series, signal, value, pad) join fields k on k.series = h.series and k.key = s.key
  where named is null or s.key = head or split_part(s.key, '_', 1) = head or not (
    exists (select 1 from fields o where o.series = h.series and (o.key = head or split_part(o.key, '_', 1) = head))
    or (regexp_matches(s.key, {_INSTANCE}) and regexp_matches(head, {_INSTANCE}) and regexp_extract(s.key, {_INSTANCE}, 1) = regexp_extract(head, {_INSTANCE}, 1) and regexp_extract(s.key, {_INSTANCE}, 2) <> regexp_extract(head, {_INSTANCE}, 2)))
  union all select id, named, k.key, 1, 'peripheral' from h join fields k on k.series = h.series and k.key = named
  union all select id, min(named), min(key), 2, 'pad+value(grid)' from (select id, named, k.key from h join grid g using (series, pad, value) join fields k on k.series = h.series and k.key = g.key where named is null or k.key = head or split_part(k.key, '_', 1) = head) group by id having count(distinct key) = 1
  union all select id, min(named), min(key), 3, 'pad+value' from (select id, named, k.key from h join anyw g using (series, pad, value) join fields k on k.series = h.series and k.key = g.key where named is null or k.key = head or split_part(k.key, '_', 1) = head) group by id having count(distinct key) = 1
  union all select id, min(named), min(key), 4, 'prefix' from (select id, named, k.key from h join fields k on k.series = h.series and split_part(k.key, '_', 1) = head) group by id having count(distinct key) = 1
  union all select id, min(named), min(key), 4, 'prefix' from (select id, named, k.key from h join fields k on k.series = h.series and split_part(k.key, '_', 1) = head and regexp_full_match(signal, k.key || '[0-9]*')) group by id having count(distinct key) = 1),
r as (select *, case when named is null and step = 4 then 1.5 else step end as o from c)
select id, key, method from (select *, row_number() over (partition by id order by o, key) as n from r) where n = 1
""")
def selector_resolution(t):
    functions = t.orders.select(F.col("o_orderkey").alias("id"), F.concat(F.lit("S"), F.col("o_custkey") % 3).alias("series"), F.expr(_SIGNAL).alias("signal"), (F.col("o_custkey") % 4).cast("int").alias("value"), F.concat(F.lit("PA"), F.col("o_orderkey") % 6).alias("pad"))
    c = t.customer.where("c_custkey % 7 = 0")
    stated = c.selectExpr("'S' || c_custkey % 3 as series", "'TIM' || c_custkey % 5 || '_CH1' as signal", "cast(c_custkey % 4 as int) as value", "'PA' || c_custkey % 6 as pad", "'TIM' || c_nationkey % 5 as key")
    key = "element_at(array('TIM1', 'ADC1_ETRGINJ', 'ISINK1_ADJ', 'TIM3', 'USART2'), cast({} % 5 + 1 as int)) as key"
    grid = t.part.where("p_partkey % 11 = 0").selectExpr("'S' || p_partkey % 3 as series", "'PA' || p_partkey % 6 as pad", "p_size % 4 as value", key.format("p_partkey"))
    anywhere = t.supplier.selectExpr("'S' || s_suppkey % 3 as series", "'PA' || s_suppkey % 6 as pad", "s_nationkey % 4 as value", key.format("s_suppkey"))
    return sel.resolve(functions, _fields(t), stated, [("pad+value(grid)", grid), ("pad+value", anywhere)])


@query(f"""
with f as (select distinct l_returnflag as series, l_suppkey % 7 as selector, 'TIM' || l_suppkey % 7 as key from lineitem where l_suppkey % 7 <> 4),
r as (select l_returnflag as series, l_partkey % 7 as selector, l_orderkey as route, case l_linenumber % 3 when 0 then 'TIM' || l_partkey % 5 when 1 then 'I2S3' else 'TIM' || l_partkey % 7 end as peripheral from lineitem)
select route, key, peripheral from r join f using (series, selector)
where key <> peripheral and (exists (select 1 from f o where o.series = r.series and o.key = peripheral) or (starts_with(peripheral, 'TIM') and key <> peripheral))
""")
def misplaced_routes(t):
    li = t.lineitem
    fields = li.where("l_suppkey % 7 <> 4").selectExpr("l_returnflag as series", "l_suppkey % 7 as selector", "'TIM' || l_suppkey % 7 as key").distinct()
    routes = li.selectExpr("l_returnflag as series", "l_partkey % 7 as selector", "l_orderkey as route", "case l_linenumber % 3 when 0 then 'TIM' || l_partkey % 5 when 1 then 'I2S3' else 'TIM' || l_partkey % 7 end as peripheral")
    return sel.misplaced(routes, fields).select("route", "key", "peripheral")


@query("""
with p as (select p_partkey, p_size % 3 + 1 as width, [p_size % 5, p_size % 3] as g, case when p_size % 4 > 0 then [cast(p_partkey % 7 as int)] else [] end as a,
  case when p_size % 2 = 0 then [0, 1] else [] end as h, case when p_size % 3 = 0 then [cast(p_partkey % 9 as int)] else [] end as d from part),
u as (select *, list_distinct(list_concat(g, a, h, d)) as every from p)
select p_partkey, array_to_string(list_sort(list_distinct(list_concat([0], list_filter(every, lambda v: v < 1 << width)))), ',') as "values",
  'grid' || case when len(a) > 0 then '+pins' else '' end || case when len(h) > 0 then '+header' else '' end || case when len(d) > 0 then '+decoder' else '' end as source,
  array_to_string(list_sort(list_filter(every, lambda v: v >= 1 << width)), ',') as over,
  array_to_string(list_sort(list_filter(d, lambda v: not list_contains(list_concat(g, a, h), v))), ',') as only_last,
  array_to_string(list_sort(list_filter(a, lambda v: not list_contains(g, v))), ',') as beyond_first from u
""")
def value_union(t):
    none = "cast(array() as array<int>)"
    p = t.part.selectExpr(
        "p_partkey", "p_size % 3 + 1 as width", "array(p_size % 5, p_size % 3) as g", f"if(p_size % 4 > 0, array(cast(p_partkey % 7 as int)), {none}) as a",
        "if(p_size % 2 = 0, array(0, 1), null) as h", f"if(p_size % 3 = 0, array(cast(p_partkey % 9 as int)), {none}) as d",
    )
    out = sel.value_union(p, [("g", "grid"), ("a", "pins"), ("h", "header"), ("d", "decoder")])
    text = lambda c: F.array_join(F.col(c).cast("array<string>"), ",").alias(c)
    return out.select("p_partkey", text("values"), "source", text("over"), text("only_last"), text("beyond_first"))


@query("""
with o as (select o_custkey, o_orderkey, o_custkey % 2 + o_orderkey % 5 // 4 as v from orders where o_orderkey % 6 <> 0),
c as (select *, lag(v) over (partition by o_custkey order by o_orderkey) as p from o)
select o_custkey, max_by(v, o_orderkey) as v, string_agg(case when p <> v then p || ' -> ' || v end, '; ' order by o_orderkey) as note from c group by 1
""")
def last_edition_value(t):
    o = t.orders.select("o_custkey", "o_orderkey", F.expr("if(o_orderkey % 6 <> 0, o_custkey % 2 + o_orderkey % 5 div 4, null)").alias("v"))
    return sel.last_edition(o, ["o_custkey"], "o_orderkey", "v")


@query("""
with h as (select p_partkey as key, 'R' || p_size % 2 as own, list_sort([p_size % 4, p_size % 4 + 1]) as own_bits from part),
m as (select p_partkey as key, 'R' || (p_size + x) % 3 as register, list_sort([p_size % 4 + x - 1, p_size % 4 + x]) as bits from part, (values (0), (1), (2)) v(x) where (p_partkey + x) % 3 <> 0),
n as (select h.*, register, bits, case when register is null then 'alone' when register = own then case when bits = own_bits then 'same' else 'differs' end
  when len(own_bits) + len(bits) > 8 then 'too wide' when bits = own_bits then 'other name' else 'completed' end as note from h left join m using (key))
select key, array_to_string(list_concat(list_transform(any_value(own_bits), lambda b: any_value(own) || ':' || b), coalesce(flatten(list(list_transform(bits, lambda b: register || ':' || b) order by register) filter (where note = 'completed')), [])), ',') as bits,
  string_agg(distinct note, ',' order by note) as notes from n group by key
""".replace("list_transform(any_value(own_bits), lambda b: any_value(own) || ':' || b)", "any_value(list_transform(own_bits, lambda b: own || ':' || b))"))
def complete_bits(t):
    h = t.part.selectExpr("p_partkey as key", "'R' || p_size % 2 as register", "array(p_size % 4, p_size % 4 + 1) as bits")
    m = t.part.selectExpr("p_partkey", "p_size", "explode(array(0, 1, 2)) as x").where("(p_partkey + x) % 3 <> 0")
    m = m.selectExpr("p_partkey as key", "'R' || (p_size + x) % 3 as register", "array(p_size % 4 + x - 1, p_size % 4 + x) as bits")
    return sel.complete_bits(h, m, 8).select("key", F.array_join("bits", ",").alias("bits"), F.array_join("notes", ",").alias("notes"))


_TITLES = {
    0: "Table 1 (except ABCV203C8) ABCV203xx pins",
    1: "ABCV303/305/307 pins",
    2: "ABCX103x8x6 pins",
    3: "Pin definitions",
    4: "TSSOP20(F8)/QSOP28(G8)",
}
_SCOPE = "case p_size % 6 when 0 then 'ABCV203C8' when 1 then 'ABCV305RB' when 2 then 'ABCX103K8T6' when 3 then 'ABCV103F8' when 4 then 'ABCV203F6' else 'ABCV307G8' end"


@query(f"""
with p as (select p_partkey, {_SCOPE} as name, p_partkey % 5 as k from part)
select p_partkey, name, k, case k
  when 0 then case when name = 'ABCV203C8' then false else starts_with(name, 'ABCV203') end
  when 1 then starts_with(name, 'ABCV303') or starts_with(name, 'ABCV305') or starts_with(name, 'ABCV307')
  when 2 then name = 'ABCX103K8T6' when 4 then substr(name, 8, 2) in ('F8', 'G8') end as allowed from p
""")
def caption_scope(t):
    p = t.part.select("p_partkey", F.expr(_SCOPE).alias("name"), (F.col("p_partkey") % 5).alias("k"))
    title = F.element_at(F.array(*[F.lit(x) for x in _TITLES.values()]), (F.col("k") + 1).cast("int"))
    return p.select("p_partkey", "name", "k", sel.scope_allows("name", F.array(F.lit(None).cast("string"), title), F.substring("name", 8, 2), "ABC").alias("allowed"))


@query("""
with c as (select l_orderkey as id, l_partkey as candidate, case l_suppkey % 3 when 0 then true when 1 then false end as ok from lineitem where l_linenumber <= 3),
g as (select id, count(*) as n, min(candidate) as one, count(*) filter (where ok) as yes, min(candidate) filter (where ok) as a, count(*) filter (where ok is null) as open, min(candidate) filter (where ok is null) as u from c group by 1)
select o_orderkey as id, case when n = 1 then one when yes = 1 then a when open = 1 then u end as candidate, case when n = 1 then 'only' when yes = 1 then 'allowed' when open = 1 then 'undecided' end as method
from orders left join g on g.id = o_orderkey
""")
def arbitrated_columns(t):
    c = t.lineitem.where("l_linenumber <= 3").selectExpr("l_orderkey as id", "l_partkey as candidate", "case l_suppkey % 3 when 0 then true when 1 then false end as ok")
    return sel.arbitrated(t.orders.select(F.col("o_orderkey").alias("id")), c, "id", "candidate", "ok")


@query("""
select c_custkey, o_orderkey, l_linenumber, l_partkey from customer join orders on o_custkey = c_custkey join lineitem on l_orderkey = o_orderkey where c_acctbal > 8000
""")
def fan_out_join(t):
    c = t.customer.where("c_acctbal > 8000").select("c_custkey", F.col("c_custkey").alias("o_custkey"))
    rows = t.orders.select("o_custkey", "o_orderkey")
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_orderkey").alias("pad"), "l_linenumber", "l_partkey")
    out = sel.fan_out(c, ["o_custkey"], rows.withColumn("pad", F.col("o_orderkey")), lines, "o_orderkey", "pad")
    return out.select("c_custkey", "o_orderkey", "l_linenumber", "l_partkey")


@query("""
with a as (select distinct c_nationkey as nation, c_mktsegment as pin, c_custkey % 3 as pad from customer where c_acctbal > 7000), b as (select distinct c_nationkey as nation, c_mktsegment as pin, c_custkey % 3 as pad from customer where c_acctbal < 0),
x as (select a.nation, a.pin, string_agg(distinct b.pad, ',' order by b.pad) as other from a join b using (nation, pin) group by 1, 2 having not bool_or(a.pad = b.pad))
select nation, pin, pad, case when x.other is not null then 'conflict' when ina and inb then 'confirmed' else 'reference' end as confidence,
  case when x.other is not null then 'a+!b(' || x.other || ')' when ina and inb then 'a+b' when ina then 'a' else 'b' end as basis
from (select coalesce(a.nation, b.nation) as nation, coalesce(a.pin, b.pin) as pin, coalesce(a.pad, b.pad) as pad, a.pad is not null as ina, b.pad is not null as inb from a full join b on a.nation = b.nation and a.pin = b.pin and a.pad = b.pad)
left join x using (nation, pin) where x.other is null or ina
""")
def pad_merge(t):
    c = t.customer.select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("pin"), (F.col("c_custkey") % 3).alias("pad"), "c_acctbal")
    return rc.pad_merge(c.where("c_acctbal > 7000"), c.where("c_acctbal < 0"), ["nation"], "pin", "pad")


@query("""
with p as (select distinct substr(c_name, 10, 6) as stem, c_custkey % 5 = 0 as wild from customer where c_custkey % 3 = 0),
q as (select stem, case when wild then stem || 'x' || substr(stem, 1, 0) else stem end as pattern, wild from p),
n as (select distinct substr(c_name, 10) as name from customer)
select pattern, name from q join n on case when wild then regexp_full_match(name, replace(pattern, 'x', '[A-Z0-9]') || '[A-Z0-9]{0,2}') else starts_with(name, pattern) and length(name) > length(pattern) end and length(name) <= length(pattern) + 2
""")
def abbreviation_expansion(t):
    short = t.customer.where("c_custkey % 3 = 0").selectExpr("if(c_custkey % 5 = 0, substring(c_name, 10, 6) || 'x', substring(c_name, 10, 6)) as pattern")
    return rs.abbreviations(t.customer.selectExpr("substring(c_name, 10) as name"), "name", short, "pattern", 2, 6)


@query("""
select p_partkey from part where lower(p_type) in (select lower(upper(p_type)) from part where p_size < 10 and p_partkey % 5 = 0)
""")
def lower_case_existence(t):
    return rs.exists_folded(t.part, "p_type", t.part.where("p_size < 10 and p_partkey % 5 = 0").select(F.upper("p_type").alias("p_type")), "p_type").select("p_partkey")


@query("""
select a.p_partkey, b.p_partkey as included, b.p_name as content from part a join part b on b.p_partkey = a.p_partkey // 2 and a.p_partkey % 2 = 0 where b.p_size > 10
union all select p_partkey, p_partkey, p_name from part
""")
def include_expansion(t):
    own = t.part.select("p_partkey", "p_name", F.expr("if(p_partkey % 2 = 0, array(p_partkey div 2), null)").alias("includes"))
    return rs.included(own, "p_partkey", "p_name", "includes", t.part.where("p_size > 10"), "p_partkey", "p_name")


@query("""
with c as (select c_custkey, c_nationkey as k, c_acctbal as x from customer), s as (select s_suppkey, s_nationkey as k, s_acctbal as x from supplier),
d as (select c_custkey, s_suppkey, round(abs(c.x - s.x), 2) as distance from c join s using (k) where abs(c.x - s.x) <= 90)
select c_custkey, s_suppkey, distance from (select *, row_number() over (partition by c_custkey order by distance, s_suppkey) as n from d) where n = 1
""")
def nearest_within(t):
    c = t.customer.select("c_custkey", F.col("c_nationkey").alias("k"), F.col("c_acctbal").alias("x"))
    s = t.supplier.select("s_suppkey", F.col("s_nationkey").alias("k"), F.col("s_acctbal").alias("x"))
    return rs.nearest(c, s, ["k"], "x", "c_custkey", "s_suppkey", 90.0, 2)


@query("select c_custkey, n_name from customer join nation on n_nationkey = c_nationkey")
def required_lookup(t):
    return rs.required(t.customer, "c_nationkey", t.nation, "n_nationkey", "n_name").select("c_custkey", "n_name")
