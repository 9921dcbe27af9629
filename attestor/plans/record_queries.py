"""Record rules, screens, attachments, lists, orders and sources over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from attestor.functions import canon
from attestor.operators import parse, records, report
from attestor.operators.resolve import addresses, shared_path
from attestor.plans.catalogue import query
from attestor.sources import tables as src


@query("""
with r as (select o_orderkey, o_custkey % 4 + 1 as pin_count, o_orderkey % 3 <> 0 as whole, list(l_linenumber order by l_linenumber) as pins, list(l_linestatus order by l_linenumber) as kinds,
    o_custkey % 5 as gpio, o_orderkey % 7 = 0 as misnamed from orders join lineitem on l_orderkey = o_orderkey group by o_orderkey, o_custkey)
select 'id is the file''s name' as rule, cast(o_orderkey as varchar) as key, 'o' || o_orderkey || ' <> x' || o_orderkey as detail from r where misnamed
union all select 'part number is the id', cast(o_orderkey as varchar), 'O' || o_orderkey || ' <> x' || o_orderkey from r where misnamed
union all select 'pin numbers are unique', cast(o_orderkey as varchar), 'repeated' from r where len(list_distinct(pins)) < len(pins)
union all select 'complete pins', cast(o_orderkey as varchar), len(pins) || ' entries' from r where whole and len(pins) <> pin_count
union all select 'complete pins', cast(o_orderkey as varchar), 'numbers not 1 to pin_count' from r where whole and len(pins) = pin_count and list_sort(list_distinct(pins)) <> range(1, pin_count + 1)
union all select 'complete pins', cast(o_orderkey as varchar), 'gpio count' from r where whole and len(pins) = pin_count and len(list_filter(kinds, lambda k: k = 'O')) <> gpio
union all select 'complete functions need complete pins', cast(o_orderkey as varchar), 'pins not complete' from r where not whole and o_orderkey % 2 = 0
""")
def record_violations(t):
    o = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_orderkey", "o_custkey").agg(
        F.collect_list(F.struct(F.col("l_linenumber").cast("string").alias("number"), F.when(F.col("l_linestatus") == "O", "gpio").otherwise("power").alias("kind"))).alias("pins")
    )
    r = o.select(
        "o_orderkey", "pins", F.concat(F.lit("o"), "o_orderkey").alias("id"), F.struct(F.concat(F.lit("O"), "o_orderkey").alias("part_number")).alias("identity"),
        F.concat(F.when(F.col("o_orderkey") % 7 == 0, "x").otherwise("o"), "o_orderkey", F.lit(".json")).alias("file"),
        F.struct((F.col("o_custkey") % 4 + 1).cast("int").alias("pin_count"), F.lit(0).alias("exposed_pad_count"), (F.col("o_custkey") % 5).cast("int").alias("gpio_count")).alias("package"),
        F.struct(F.when(F.col("o_orderkey") % 3 != 0, "complete").alias("package_pins"), F.when(F.col("o_orderkey") % 2 == 0, "complete").alias("pin_functions")).alias("coverage"),
    )
    unique = F.expr(f"case when {records.repeats('pins.number')} then array('repeated') else {records.NONE} end")
    return records.violations(r, "o_orderkey", records.identity("file") | records.completeness() | {"pin numbers are unique": unique})


@query("""
with s as (select p_brand, row_number() over (partition by p_brand order by p_partkey) as n, p_partkey as id, p_size % 29 + 5 as bit, p_size % 3 + 1 as width, p_partkey % 5 as reset, p_partkey % 4 as most from part where p_partkey <= 400),
b as (select *, list_transform(range(0, width), lambda i: bit + i) as bits from s),
g as (select * from b where bit + width - 1 <= 31)
select 'selector bits are valid' as rule, p_brand as key, cast(id as varchar) as detail from b where bit + width - 1 > 31
union all select 'selector values are valid', p_brand, cast(id as varchar) from g where most >= 1 << width
union all select 'reset value is valid', p_brand, cast(id as varchar) from g where most < 1 << width and reset > most
union all select distinct 'selectors don''t overlap', y.p_brand, cast(y.id as varchar) from g x join g y on x.p_brand = y.p_brand and x.n < y.n and list_has_any(x.bits, y.bits)
""")
def selector_rule_violations(t):
    bits = F.expr("transform(sequence(0, p_size % 3), i -> named_struct('register', 'R', 'bit', cast(p_size % 29 + 5 + i as int)))")
    x = F.struct(F.col("p_partkey").cast("string").alias("id"), F.lit("c").alias("controller"), F.lit("R").alias("register"), F.col("p_partkey").cast("string").alias("field"), bits.alias("bits"), F.expr("sequence(0, cast(p_partkey % 4 as int))").alias("valid_values"), F.expr("cast(p_partkey % 5 as int)").alias("reset_value"))
    r = t.part.where("p_partkey <= 400").groupBy("p_brand").agg(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", x.alias("x")))), lambda s: s["x"]).alias("route_selectors"))
    return records.violations(r, "p_brand", records.selector_rules())


@query("""
select 'no CJK in data' as rule, cast(p_partkey as varchar) as key, 'p_name' as detail from part where p_partkey % 17 = 0
""")
def cjk_leaks(t):
    name = F.concat("p_name", F.when(F.col("p_partkey") % 17 == 0, "通信").otherwise("é"))
    p = t.part.select("p_partkey", name.alias("p_name"), F.lit("标签").alias("label_zh"), F.lit("x").alias("#"), F.lit("中").alias("basis"))
    return records.leaks(p, "p_partkey", p.columns, ["label_zh"])



@query("""
with r as (select l_partkey, l_linenumber, case when l_partkey % 4 = 0 and l_linenumber > 5 then 'unit of another row' when l_discount > 0.09 then 'value' end as reason from lineitem)
select reason, count(*) as n from (select distinct l_partkey, l_linenumber, reason from r where reason is not null) group by 1
union all select 'kept', count(*) from r where reason is null
""")
def dead_letters(t):
    li = t.lineitem.select("l_partkey", "l_linenumber", "l_discount", F.when(F.col("l_partkey") % 4 == 0, "VDD").otherwise("I").alias("symbol"), F.when(F.col("l_linenumber") > 5, "mA").when(F.col("l_linenumber") > 2, "V").alias("unit"))
    fits = records.agreeing("symbol", "unit", [("^VDD$", "^m?V$"), ("^I$", "^m?[AV]$")])
    kept, bad = records.screened(li, [("unit of another row", ~fits), ("value", F.col("l_discount") > 0.09)])
    return bad.select("l_partkey", "l_linenumber", "reason").distinct().groupBy("reason").agg(F.count("*").alias("n")).unionByName(kept.agg(F.count("*").alias("n")).select(F.lit("kept").alias("reason"), "n"))


@query("""
select o_custkey, o_orderkey, o_orderstatus from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as n from orders) where n = 1
""")
def last_wins(t):
    return records.last_wins(t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("select p_partkey, regexp_matches(p_type, '[a-z]{3,}') as prose, len(string_split(p_name, ' ')) > 1 as wide, length(p_type) > 8 as too_long, p_brand = p_type as trivial from part")
def row_predicates(t):
    return t.part.select("p_partkey", F.col("p_type").rlike(canon.PROSE).alias("prose"), records.long_enough(F.split("p_name", " "), 1).alias("wide"), (F.length("p_type") > 8).alias("too_long"), (F.col("p_brand") == F.col("p_type")).alias("trivial"))


@query("""
with e as (select event_id, user_id, ts, event_type = 'signup' as head, case when value > 20 then cast(event_id as varchar) end as name from events),
m as (select *, max(case when head then strftime(ts, '%Y%m%d%H%M%S%f') || lpad(cast(event_id as varchar), 12, '0') end) over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) as h from e)
select m.event_id, e.name as section from m left join e on e.user_id = m.user_id and e.event_id = cast(right(m.h, 12) as bigint)
""")
def heading_attachment(t):
    e = t.events.withColumn("head", F.col("event_type") == "signup")
    return records.headings_attached(e, ["user_id"], ["ts", "event_id"], "head", F.when(F.col("value") > 20, F.col("event_id").cast("string")), "section").select("event_id", "section")


@query("""
with e as (select *, row_number() over (partition by user_id order by ts, event_id) as p from events),
m as (select *, max(case when event_type = 'purchase' then p end) over w as i, max(case when event_type = 'view' then p end) over w as c from e window w as (partition by user_id order by p rows between unbounded preceding and 1 preceding))
select event_id, cast(sum(case when event_type = 'purchase' and (i is null or c > i) then 1 else 0 end) over (partition by user_id order by p rows between unbounded preceding and current row) as bigint) as grp from m
""")
def closed_groups(t):
    e = t.events.withColumn("item", F.col("event_type") == "purchase").withColumn("closing", F.col("event_type") == "view")
    return records.closed_groups(e, ["user_id"], ["ts", "event_id"], "item", "closing", "grp").select("event_id", "grp")


@query("""
with f as (select o_custkey, o_orderpriority, min(o_orderkey) as place from orders group by 1, 2)
select o_custkey, string_agg(o_orderpriority, ';' order by place) as seen from f group by 1
""")
def ordered_distinct(t):
    return report.distinct_in_order(t.orders, ["o_custkey"], "o_orderpriority", ["o_orderkey"], "seen")


@query("""
with c as (select replace(p_name, ' ', case when p_size % 2 = 0 then '/' else chr(10) end) || '/' || p_type || '_' || p_size || '(1)' as cell from part),
s as (select trim(unnest(string_split(cell, '/'))) as raw from c), w as (select raw, regexp_replace(raw, ' *\\([0-9]+\\)', '', 'g') as name from s where not contains(raw, chr(10)))
select 'stem' as kind, regexp_extract(raw, '^([A-Za-z#]+)', 1) as word, count(*) as n from w where regexp_extract(raw, '^([A-Za-z#]+)', 1) <> '' group by 2
union all select 'name', name, count(*) from w where name <> '' and not contains(name, ' ') group by 2
""")
def vocabulary(t):
    cell = F.concat(F.replace("p_name", F.lit(" "), F.when(F.col("p_size") % 2 == 0, "/").otherwise("\n")), F.lit("/"), "p_type", F.lit("_"), F.col("p_size").cast("string"), F.lit("(1)"))
    return parse.vocabulary(t.part.select(cell.alias("cell")), "cell", "^([A-Za-z#]+)")


@query("""
select l_orderkey, case when sum(greatest(l_quantity - 25, 0)) > sum(greatest(25 - l_quantity, 0)) then 'above' else 'below' end as side from lineitem group by 1
""")
def distance_vote(t):
    return report.vote(t.lineitem, ["l_orderkey"], F.col("l_quantity") - 25, "above", "below", "side")


@query("select p_partkey, row_number() over (order by cast(p_size as varchar), cast(p_partkey as varchar)) as place from part where p_partkey < 500")
def lexical_order(t):
    p = t.part.where("p_partkey < 500")
    return p.select("p_partkey", F.row_number().over(Window.orderBy(*report.as_text("p_size", "p_partkey"))).cast("long").alias("place"))


@query("select event_type, count(*) as n, cast(row_number() over (order by count(*) desc, event_type) as int) as place from events group by 1")
def by_frequency(t):
    return report.by_frequency(t.events, "event_type")


@query("select conv_id, turn, role from conversations where turn < 2 and conv_id in (select conv_id from conversations where turn = 0 and length(text) > 40)")
def first_pages(t):
    c = t.conversations.where("turn < 2")  # pages beyond are pruned by the filter, not read and dropped
    return c.join(c.where("turn = 0 and length(text) > 40").select("conv_id").distinct(), "conv_id", "left_semi").select("conv_id", "turn", "role")


@query("select p_brand, p_partkey from (select *, row_number() over (partition by p_brand order by p_partkey) as n from part) where n <= 3")
def first_of_group(t):
    return report.first_rows(t.part, ["p_brand"], ["p_partkey"], 3).select("p_brand", "p_partkey")


@query("""
with a as (select o_custkey, list_sort(list(distinct o_orderpriority) filter (where o_orderstatus = 'F')) as f, list_sort(list(distinct o_orderpriority) filter (where o_orderstatus = 'O')) as o from orders group by 1),
b as (select o_custkey, coalesce(f, []) as f, coalesce(o, []) as o from a)
select o_custkey, array_to_string(list_sort(list_filter(f, lambda x: list_contains(o, x))), ';') as both_have, len(list_filter(f, lambda x: not list_contains(o, x))) = 0 as within,
  array_to_string(list_sort(list_concat(list_filter(f, lambda x: not list_contains(o, x)), list_filter(o, lambda x: not list_contains(f, x)))), ';') as one_has from b
""")
def set_relations(t):
    own = lambda s: F.collect_set(F.when(F.col("o_orderstatus") == s, F.col("o_orderpriority")))
    g = t.orders.groupBy("o_custkey").agg(own("F").alias("f"), own("O").alias("o"))
    join = lambda x: F.array_join(F.array_sort(x), ";")
    return g.select("o_custkey", join(F.array_intersect("f", "o")).alias("both_have"), canon.subset("f", "o").alias("within"), join(canon.symmetric_difference("f", "o")).alias("one_has"))


@query("""
select p_partkey, 'PART ' || p_size as name, p_size >= 10 as numeric, 'P' || p_size || ';P' || p_size // 10 || 'x' as expanded, regexp_full_match('P' || p_size, 'P[A-Z0-9]5') as wild, cast(case when p_size % 2 = 0 then 3 else 1 end as int) as width, 'F-' || p_size as text from part
""")
def spelling_functions(t):
    z = F.col("p_size").cast("string")
    number = F.concat(F.when(F.col("p_size") >= 10, z).otherwise("n/a"))
    wide = F.concat(F.lit("P"), z)
    tail = F.concat(F.floor(F.col("p_size") / 10).cast("string"), F.lit("x"))
    codes = F.when(F.col("p_size") % 2 == 0, F.array(F.lit("01x"), F.lit("101"))).otherwise(F.array(F.lit("1xx"), F.lit("0x")))
    return t.part.select(
        "p_partkey", canon.fold_width(F.concat(F.lit("ＰＡＲＴ　"), z)).alias("name"), canon.number_like(number).alias("numeric"), F.concat_ws(";", wide, F.concat(F.lit("P"), tail)).alias("expanded"),
        canon.wildcard_match(wide, F.lit("Px5")).alias("wild"), canon.code_width(codes).alias("width"), canon.ordered_replace(F.concat(F.lit("AB"), z), [("AB", "C"), ("C", "F-")]).alias("text"),
    )


@query("""
select p_partkey, 'V' || (300 + p_size) || ',V' || (400 + p_size % 9) as slashed, case when p_size % 3 = 0 then 'P' || p_size else 'LQFP' || p_size end as heading, 'a=' || p_size || ';b=' || p_partkey as settings,
  case p_size % 4 when 0 then 'af-' || p_size when 1 then 'remap-' || p_size % 10 when 2 then null else 'main' end as kind, cast(p_size * 1000000 + 500000 as bigint) as hz,
  case when p_size % 2 = 0 then 'PA' || p_size else null end as pads, case when p_size % 5 = 0 then 'size ' || 'of it' when p_size % 5 = 1 then 'whole' else 'other' end as said, p_size || '*2.5' as dims, '/p/' || p_size || '.html' as url,
  case when bit_count(p_size) <> 2 then '[3:2]' end as differs
from part
""")
def text_functions(t):
    z = F.col("p_size").cast("string")
    k = F.col("p_size")
    table = F.create_map(F.lit("尺寸"), F.lit("size"), F.lit("其"), F.lit("of it"), F.lit("尺寸全"), F.lit("whole"))
    heading = F.when(k % 3 == 0, F.concat(F.lit("P"), z)).otherwise(F.reverse(F.concat(F.lit("LQFP"), z)))
    kind = F.when(k % 4 == 0, canon.route(F.concat(F.lit("TIM1_CH1(AF"), z, F.lit(")")), "default")["kind"]).when(k % 4 == 1, canon.route(F.concat(F.lit("TIM1_CH1_"), (k % 10).cast("string")), "remap")["kind"]).when(k % 4 == 2, canon.route(F.lit("SWDIO"), "remap")["kind"]).otherwise(canon.route(F.lit("PA1"), "main")["kind"])
    return t.part.select(
        "p_partkey", F.array_join(canon.slash_expand(F.concat(F.lit("V"), (k + 300).cast("string"), F.lit("/"), (k % 9 + 400).cast("string"))), ",").alias("slashed"),
        canon.upright(heading, "^(LQFP|P)[0-9]+$").alias("heading"), canon.render_map(canon.parse_map(F.concat(F.lit("b="), F.col("p_partkey").cast("string"), F.lit(";a="), z))).alias("settings"), kind.alias("kind"),
        canon.megahertz(F.concat(z, F.lit("_5"))).alias("hz"), F.nullif(F.array_join(canon.pads_in(F.concat(F.lit("与P"), F.when(k % 2 == 0, "A").otherwise("Z"), z, F.lit("相连"))), ","), F.lit("")).alias("pads"),
        canon.translated(F.when(k % 5 == 0, "尺寸 其").when(k % 5 == 1, "尺寸 全").otherwise("other"), table).alias("said"), canon.dimension(F.concat(z, F.lit(".0x2.50mm"))).alias("dims"),
        canon.templated("/p/{n}.html", n=z).alias("url"), canon.width_differs(F.lit("mask [3:2]"), k).alias("differs"),
    )


@query("""
select p_partkey, cast(2 as int) as line, 'A' as name, cast(p_size as varchar) as value, 'defined(X)' as condition from part
union all select p_partkey, 4, 'A', '0', '!(defined(X))' from part union all select p_partkey, 6, 'B_' || p_size, '(1 << 2)', '' from part
""")
def scanned_defines(t):
    z = F.col("p_size").cast("string")
    text = F.concat(F.lit("#ifdef X\n#define A "), z, F.lit(" /* a */\n#else\n#define A 0\n#endif\n#define B_"), z, F.lit(" (1 << 2) // b\n"))
    return parse.scan_defines(t.part.select("p_partkey", text.alias("text")), "p_partkey", "text")


@query("""
select n_nationkey, cast(1 as int) as line, cast(1 as int) as depth, n_name as path, false as leaf from nation
union all select n_nationkey, 2, 2, n_name || '/a', false from nation union all select n_nationkey, 3, 3, n_name || '/a/' || n_regionkey, true from nation union all select n_nationkey, 4, 2, n_name || '/b', true from nation
""")
def scanned_trees(t):
    text = F.concat("n_name", F.lit("\n├── a\n│   └── "), F.col("n_regionkey").cast("string"), F.lit("\n└── b\n"))
    return parse.scan_tree(t.nation.select("n_nationkey", text.alias("text")), "n_nationkey", "text")


@query("""
select s_suppkey, cast(1 as int) as line, 'RCC->CFGR0' as register, '=' as op, '&RCC->CFGR0' as value from supplier union all select s_suppkey, 2, 'RCC->CFGR0', '|=', cast(s_nationkey as varchar) from supplier
""")
def scanned_writes(t):
    text = F.concat(F.lit("volatile uint32_t *p = &RCC->CFGR0;\np |= "), F.col("s_nationkey").cast("string"), F.lit(";\n"))
    return parse.scan_writes(t.supplier.select("s_suppkey", text.alias("text")), "s_suppkey", "text")


@query("select n_name, cast(n_nationkey as varchar) as n_nationkey, case when n_regionkey > 0 then cast(n_regionkey as varchar) end as n_regionkey from nation")
def csv_round_trip(t):
    path = shared_path(t.spark, "csv")
    n = t.nation.select("n_nationkey", "n_name", F.when(F.col("n_regionkey") > 0, F.col("n_regionkey")).alias("n_regionkey"), F.lit("confirmed").alias("n_name_confidence"))
    src.write_csv(n, path, ["n_name"], ["n_name"])
    return src.csv(t.spark, path, src.split_metadata(n.columns, ["n_name"])).drop("n_name_confidence")


@query("select r_regionkey, r_name, n_nations from (select r_regionkey, r_name, cast(count(*) as bigint) as n_nations from region join nation on n_regionkey = r_regionkey group by 1, 2) where r_regionkey < 3")
def json_partitions(t):
    path = shared_path(t.spark, "json")
    r = t.region.join(t.nation, F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_regionkey", "r_name").agg(F.count("*").alias("n_nations"))
    src.json_by_key(r, path, "r_regionkey")
    return src.pruned(t.spark.read.schema("r_name string, n_nations long, r_regionkey int").json(path), "r_regionkey", [0, 1, 2])


@query("""
with l as (select c_custkey // 100 as part, list_sort(list(c_name || ' = ' || c_mktsegment)) as lines from customer where c_custkey < 1000 group by 1)
select part, split_part(x, ' = ', 1) as key, split_part(x, ' = ', 2) as value from (select part, unnest(lines) as x from l)
""")
def text_key_values(t):
    path = shared_path(t.spark, "text")
    c = t.customer.where("c_custkey < 1000").select(F.expr("c_custkey div 100").alias("part"), F.concat_ws(" = ", "c_name", "c_mktsegment").alias("value"))
    c.withColumn("value", F.regexp_replace("value", "#", "_")).unionByName(c.select("part", F.lit("# a comment").alias("value")).distinct()).write.partitionBy("part").text(path)
    lines = src.text_lines(t.spark, f"{path}/part=*").withColumn("part", F.regexp_extract("path", "part=([0-9]+)", 1).cast("long"))
    return src.key_values(lines).select("part", F.regexp_replace("key", "_", "#").alias("key"), "value")


@query("select n_nationkey, case when n_nationkey % 5 = 0 then upper(n_name) || '!' else n_name end as n_name, cast(0 as bigint) as missing_rows from nation")
def overrides_and_defaults(t):
    curated = t.nation.where("n_nationkey % 5 = 0").select("n_nationkey", F.concat(F.upper("n_name"), F.lit("!")).alias("n_name"))
    absent = src.or_empty(t.spark, lambda: t.spark.read.schema("x int").json(shared_path(t.spark, "absent")), src.T.StructType.fromDDL("x int"))
    out = src.with_overrides(t.nation.select("n_nationkey", "n_name"), curated, ["n_nationkey"], ["n_name"])
    return out.crossJoin(absent.agg(F.count("*").alias("missing_rows")))  # one row


@query("select distinct s_nationkey as y, s_suppkey as doc, string_agg(word, ' ' order by x) as line from (select s_suppkey, s_nationkey, 10 as x, 'to' as word from supplier union all select s_suppkey, s_nationkey, 2, 's' || s_nationkey from supplier) group by s_nationkey, s_suppkey")
def placed_lines(t):
    w = t.supplier.select(F.col("s_suppkey").alias("doc"), F.explode(F.array(F.struct(F.lit(10.0).alias("x"), (F.col("s_nationkey") + 0.4).alias("y"), F.lit("to").alias("word")), F.struct(F.lit(2.0).alias("x"), F.col("s_nationkey").cast("double").alias("y"), F.concat(F.lit("s"), F.col("s_nationkey").cast("string")).alias("word")))).alias("w"))
    return parse.lines_of_words(w.select("doc", "w.*"), ["doc"], "x", "y", "word", 1.0).select("doc", F.floor("y").cast("int").alias("y"), "line")


@query("select s_suppkey, x as key, cast(s_nationkey + i as varchar) as value from supplier, (values ('a', 0), ('b.c', 1)) v(x, i)")
def yaml_documents(t):
    text = F.concat(F.lit("a: "), F.col("s_nationkey").cast("string"), F.lit("\nb:\n  c: "), (F.col("s_nationkey") + 1).cast("string"), F.lit("\n"))
    return parse.scan_yaml(t.supplier.select("s_suppkey", text.alias("text")), "s_suppkey", "text")


@query("""
select p_brand, count(*) as parts, min(p_mfgr) as maker, case when count(*) > 3 then array_to_string(list_sort(list(p_partkey))[1:3], ', ') || ', …' else array_to_string(list_sort(list(p_partkey)), ', ') end as shown
from (select p_brand, p_partkey, substr(p_brand, 1, 7) as p_mfgr from part) group by 1
""")
def find_your_part(t):
    return report.index_of(t.part.withColumn("maker", F.substring("p_brand", 1, 7)), "p_brand", "p_partkey", "maker", 3)


@query("select c_mktsegment, c_custkey from customer where c_nationkey in (1, 3, 5) and c_mktsegment in ('BUILDING', 'MACHINERY') and contains(lower(c_custkey || ' ' || c_name || ' ' || c_mktsegment), 'er#00000')")
def viewer_search(t):
    return report.searched(t.customer, {"c_nationkey": [1, 3, 5], "c_mktsegment": ["BUILDING", "MACHINERY"]}, ["c_custkey", "c_name", "c_mktsegment"], "ER#00000").select("c_mktsegment", "c_custkey")


@query("""
with recursive h as (select distinct user_id, date_diff('second', timestamp '2000-01-01', date_trunc('second', ts)) as s from events where event_type = 'view'),
r as (select user_id, min(s) as s from h group by 1 union all select r.user_id, min(h.s) from r join h on h.user_id = r.user_id and h.s >= r.s + 86460 group by r.user_id, r.s)
select user_id, s from r
""")
def hit_windows(t):
    s = F.unix_timestamp(F.col("ts").cast("timestamp")) - F.unix_timestamp(F.lit("2000-01-01 00:00:00").cast("timestamp"))
    v = t.events.where("event_type = 'view'").select("user_id", s.alias("s")).distinct().withColumn("e", F.col("s") + 60)
    return report.context_windows(v, ["user_id"], "s", "e", 86400).select("user_id", "s")


@query("select event_id, 'k' as key, cast(json_extract_string(props, '$.k') as varchar) as value from events union all select event_id, 'deep.0.x', cast(user_id as varchar) from events")
def json_leaves(t):
    text = F.concat(F.expr("substring(props, 1, length(props) - 1)"), F.lit(', "deep": [{"x": '), F.col("user_id").cast("string"), F.lit("}]}"))
    return parse.scan_json(t.events.select("event_id", text.alias("text")), "event_id", "text")


@query("""
select case when p_brand like 'Brand#1%' then 'first' when regexp_matches(p_brand, '#[0-9]') then 'TIM' || regexp_extract(p_brand, '#([0-9])', 1) else 'other' end as kind, count(*) as n from part group by 1
""")
def classify_by_value(t):
    kind = canon.classify("p_brand", [("^Brand#1", "first"), ("#([0-9])", "TIM$1")], "other")
    return t.part.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


@query("""
select n_nationkey, case when n_regionkey = 0 then 'b;0;c' when n_regionkey = 1 then 'b;1;c;a' else 'b;' || n_regionkey || ';c;a' end as items from nation
""")
def ordered_union(t):
    r = F.col("n_regionkey").cast("string")
    more = F.when(F.col("n_regionkey") == 0, F.array(F.lit("b"), F.lit("c"))).otherwise(F.array(F.lit("c"), F.lit("b"), F.lit("a")))
    return t.nation.select("n_nationkey", F.array_join(canon.ordered_union(F.array(F.lit("b"), r), more), ";").alias("items"))


@query("""
select s_name as block, p_name as member, cast(n_nationkey * 1000 + p_partkey as bigint) as address
from supplier join nation on n_nationkey = s_nationkey and n_regionkey < 3 join part on p_size = s_suppkey % 60 and p_partkey < 300
""")
def address_join(t):
    pointers = t.supplier.select(F.col("s_name").alias("block"), F.expr("cast(s_suppkey % 60 as int)").alias("type"), F.col("s_nationkey").alias("base"))
    bases = t.nation.where("n_regionkey < 3").select(F.col("n_nationkey").alias("base"), (F.col("n_nationkey") * 1000).alias("at"))
    members = t.part.where("p_partkey < 300").select(F.col("p_size").alias("type"), F.col("p_name").alias("member"), F.col("p_partkey").alias("offset"))
    return addresses(pointers, bases, members).withColumn("address", F.col("address").cast("long"))
