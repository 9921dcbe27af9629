"""The integrity rules of the normalised tables: violations are collected, none stops another.

Tables are DataFrames of texts by name, blanks NULL or ''.  Rules on one row are SQL conditions, evaluated in one pass a
table; rules between tables are joins.  Later rules of a row that rely on earlier ones are guarded by them, as written.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attestor.functions import canon, signals
from attestor.operators import records, rules, selectors

#: Fixed values of the tables: shapes of cells and lists of words.
ADDRESS = "^0x[0-9a-f]{8}$"
BIT = "[A-Z][A-Z0-9]*:(?:[0-9]|[12][0-9]|3[01])"
PAD = "P[A-H][0-9]{1,2}"
SYMBOL_ROLES = ("value", "mask", "poll")
INIT_ACTIONS = ("set", "clear", "write", "poll", "trim")
CLOCK_DOMAINS = (("hpre", "HPRE"), ("ppre1", "PPRE1"), ("ppre2", "PPRE2"))

#: Foreign keys: child, column, parent, parent's column, separator.
FOREIGN_KEYS = [
    ("pins", "part_number", "products", "part_number", None), ("pin_functions", "part_number", "products", "part_number", None), ("product_attributes", "part_number", "products", "part_number", None),
    ("remap_fields", "series", "series", "series", None), ("clock_prescalers", "family", "families", "family", None), ("clock_sources", "family", "families", "family", None), ("clock_configs", "family", "families", "family", None),
    ("clock_symbols", "family", "families", "family", None), ("clock_init", "family", "families", "family", None), ("systick", "family", "families", "family", None), ("pin_alternate", "family", "families", "family", None),
    ("memory_configs", "part_number", "products", "part_number", None), ("evt_variants", "family", "families", "family", None), ("evt_variants", "part_number", "products", "part_number", None), ("series", "family", "families", "family", None),
]


def _list(column: str) -> str:
    return f"filter(split(coalesce({column}, ''), ';'), x -> x <> '')"


def _number(column: str) -> str:
    return f"coalesce({column}, '') rlike '^[0-9]+$'"


_BITS, _VALUES = _list("bits"), _list("valid_values")
_GOOD_BITS = f"size({_BITS}) > 0 and forall({_BITS}, x -> x rlike '^{BIT}$')"
_TIGHT = "cast(conv(substring(address, 3), 16, 10) as bigint) % 4 <> 0"
_SYSTICK = "offset rlike '^(0x)?[0-9a-fA-F]+$' and width_bits rlike '^[0-9]+$' and write_bits rlike '^[1-9][0-9]*$'"

#: Rules on one row: table, rule, condition of a violation.
ROW_RULES = [
    ("remap_fields", "bits are there", f"size({_BITS}) = 0"),
    ("remap_fields", "bits are register:bit", f"size({_BITS}) > 0 and not ({_GOOD_BITS})"),
    ("remap_fields", "bits don't repeat", f"{_GOOD_BITS} and size(array_distinct({_BITS})) < size({_BITS})"),
    ("remap_fields", "register is the bits' registers", f"{_GOOD_BITS} and not (register <=> array_join(array_distinct(transform({_BITS}, x -> substring_index(x, ':', 1))), '|'))"),
    ("remap_fields", "values are there", f"{_GOOD_BITS} and size({_VALUES}) = 0"),
    ("remap_fields", "values fit the width", f"{_GOOD_BITS} and exists({_VALUES}, x -> cast(x as bigint) >= shiftleft(1L, size({_BITS})))"),
    ("remap_fields", "reset value is a value", f"{_GOOD_BITS} and size({_VALUES}) > 0 and coalesce(reset_value, '') <> '' and not exists({_VALUES}, x -> cast(x as bigint) = cast(reset_value as bigint))"),
    ("remap_routes", "peripheral and role go together", "(coalesce(peripheral, '') <> '') <> (coalesce(role, '') <> '')"),
    ("clock_prescalers", "divider is one", f"not ({_number('divider')}) or cast(divider as bigint) < 1"),
    ("clock_sources", "value and shift are numbers", f"not ({_number('value')}) or not ({_number('shift')})"),
    ("clock_configs", "domains are name=hertz", f"exists({_list('domains')}, x -> not x rlike '^[^=]+=[0-9]+$')"),
    ("clock_configs", "latency is a number", f"coalesce(flash_latency, '') <> '' and not ({_number('flash_latency')})"),
    ("clock_configs", "flash divider is a power of two", f"coalesce(flash_sck_div, '') <> '' and (not ({_number('flash_sck_div')}) or bit_count(cast(flash_sck_div as bigint)) <> 1)"),
    ("clock_configs", "latency or divider, not both", "coalesce(flash_sck_div, '') <> '' and coalesce(flash_latency, '') <> ''"),
    ("clock_symbols", "role is known", "not coalesce(role, '') in ('" + "', '".join(SYMBOL_ROLES) + "')"),
    ("clock_symbols", "value is a number", f"not ({_number('value')})"),
    ("clock_symbols", "address has its shape", f"coalesce(address, '') <> '' and not address rlike '{ADDRESS}'"),
    ("clock_symbols", "register is block->register", "not contains(coalesce(register, ''), '->')"),
    ("clock_init", "action is known", "not coalesce(action, '') in ('" + "', '".join(INIT_ACTIONS) + "')"),
    ("clock_init", "value and step are numbers", f"not ({_number('value')}) or not ({_number('step')})"),
    ("clock_init", "register is block->register", f"{_number('value')} and {_number('step')} and coalesce(register, '') <> '' and not contains(register, '->')"),
    ("clock_init", "address has its shape", f"{_number('value')} and {_number('step')} and coalesce(address, '') <> '' and not address rlike '{ADDRESS}'"),
    ("clock_init", "only a trim has a source", f"{_number('value')} and {_number('step')} and coalesce(source, '') <> '' and action <> 'trim'"),
    ("systick", "offset and widths are numbers", f"not coalesce({_SYSTICK}, false)"),
    ("systick", "write width divides the width", f"{_SYSTICK} and cast(width_bits as int) % cast(write_bits as int) <> 0"),
    ("systick", "address has its shape", f"{_SYSTICK} and coalesce(address, '') <> '' and not address rlike '{ADDRESS}'"),
    ("systick", "address is aligned", f"{_SYSTICK} and address rlike '{ADDRESS}' and {_TIGHT}"),
    ("pin_alternate", "pad has its shape", f"not coalesce(pad, '') rlike '^{PAD}$'"),
    ("pin_alternate", "bits are as many as the width", f"not (size({_BITS}) <=> cast(width_bits as int))"),
    ("pin_alternate", "bits are of the register", f"exists({_BITS}, x -> substring_index(x, ':', 1) <> register or not x rlike '^[^:]*:(?:[0-9]|[12][0-9]|3[01])$')"),
    ("pin_alternate", "address is aligned and has its shape", f"not coalesce(address, '') rlike '{ADDRESS}' or {_TIGHT}"),
    ("memory_configs", "code is of 0, 1 and x", "not coalesce(value, '') rlike '^[01x]+$'"),
    ("memory_configs", "sizes are above 0", f"not ({_number('code_bytes')}) or cast(code_bytes as bigint) <= 0 or not ({_number('sram_bytes')}) or cast(sram_bytes as bigint) <= 0"),
]

KEYS = {
    "remap_fields": ["series", "selector"], "remap_routes": ["series", "selector", "value"], "clock_prescalers": ["family", "field"], "clock_sources": ["family", "consumer"], "clock_configs": ["family", "config"],
    "clock_symbols": ["family", "symbol"], "clock_init": ["family", "function", "step"], "systick": ["family", "block", "register"], "pin_alternate": ["family", "pad"], "memory_configs": ["part_number", "value"],
}


def _out(df: DataFrame, table: str, rule: str, key: Sequence[str], detail) -> DataFrame:
    return df.select(F.lit(f"{table}: {rule}").alias("rule"), F.concat_ws(" ", *key).alias("key"), detail.cast("string").alias("detail"))


def row_violations(t: dict[str, DataFrame]) -> list[DataFrame]:
    out = []
    for table in dict.fromkeys(name for name, *_ in ROW_RULES):
        own = {f"{table}: {rule}": records.said(condition, F.lit("")) for name, rule, condition in ROW_RULES if name == table}
        df = t[table].withColumn("_key", F.concat_ws(" ", *KEYS[table]))
        out.append(records.violations(df, "_key", own))
    return out


def remap_violations(t: dict[str, DataFrame]) -> list[DataFrame]:
    fields = t["remap_fields"].withColumn("key", signals.field("field"))
    known = fields.select("series", "selector", F.expr(_VALUES).alias("_values"))
    routes = t["remap_routes"].join(known, ["series", "selector"], "left")
    wrong = selectors.misplaced(t["remap_routes"].select("series", "selector", "value", "signal", "pad", "peripheral"), fields.select("series", "selector", "key"))
    return [
        _out(routes.where("_values is null"), "remap_routes", "selector is there", KEYS["remap_routes"], F.lit("")),
        _out(routes.where("not array_contains(transform(_values, x -> cast(x as bigint)), cast(value as bigint))"), "remap_routes", "value is a value", KEYS["remap_routes"], F.lit("")),
        _out(wrong, "remap_routes", "selector is the peripheral's", KEYS["remap_routes"], F.concat_ws(" ", "signal", "pad", "peripheral", "key")),
    ]


def clock_violations(t: dict[str, DataFrame], symbol: str, macro: str) -> list[DataFrame]:
    """`symbol` and `macro` are the patterns of names that conditions refer to."""
    prescalers, symbols = t["clock_prescalers"], t["clock_symbols"]
    configs = t["clock_configs"]
    dividers = configs.select("family", "config", F.explode(F.array(*[F.struct(F.lit(field).alias("field"), F.col(column).alias("divider")) for column, field in CLOCK_DOMAINS])).alias("d")).select("family", "config", "d.*").where("divider <> ''")
    twice = symbols.withColumn("field", F.upper(F.regexp_extract("symbol", "^RCC_([A-Za-z0-9]+?)_[Dd]iv([0-9]+)$", 1))).withColumn("divider", F.regexp_extract("symbol", "^RCC_([A-Za-z0-9]+?)_[Dd]iv([0-9]+)$", 2))
    differ = twice.where("field <> ''").join(prescalers.select("family", "field", "divider", F.col("value").alias("_other")), ["family", "field", "divider"]).where("value <> _other")
    called = configs.select("family", "config", F.explode(F.expr(f"flatten(array({_list('pll')}, {_list('outside_rcc')}))")).alias("_e")).withColumn("symbol", F.substring_index("_e", " ", -1))
    steps = t["clock_init"].where(f"{_number('value')} and {_number('step')}").withColumn("_n", F.col("step").cast("int"))
    asked = steps.select("family", "function", F.explode(F.regexp_extract_all("condition", F.lit(symbol), 0)).alias("symbol"))
    dense = steps.groupBy("family", "function").agg(F.count("*").alias("_c"), F.countDistinct("_n").alias("_d"), (F.max("_n") - F.min("_n") + 1).alias("_w")).where("_d <> _c or _w <> _c")
    named = reduce(DataFrame.unionByName, [t[name].select(F.lit(name).alias("table"), "family", F.explode(F.regexp_extract_all("condition", F.lit(macro), 0)).alias("macro")) for name in ("clock_configs", "clock_sources")])
    none = F.lit("")
    return [
        _out(dividers.join(prescalers, ["family", "field", "divider"], "left_anti"), "clock_configs", "divider is known", ["family", "config"], F.concat_ws("=", "field", "divider")),
        _out(differ, "clock_symbols", "value is the prescaler's", KEYS["clock_symbols"], F.concat_ws(" <> ", "value", "_other")),
        _out(called.join(symbols, ["family", "symbol"], "left_anti"), "clock_configs", "symbol is there", ["family", "config"], F.col("symbol")),
        _out(asked.join(symbols, ["family", "symbol"], "left_anti"), "clock_init", "symbol of a condition is there", ["family", "function"], F.col("symbol")),
        _out(dense, "clock_init", "steps are dense", ["family", "function"], none),
        _out(named.join(t["evt_variants"], ["family", "macro"], "left_anti"), "conditions", "macro is known", ["table", "family"], F.col("macro")),
    ]


def layout_violations(t: dict[str, DataFrame]) -> list[DataFrame]:
    """Byte ranges and bits that more than one row of a block claims, and where pins' alternate functions are written."""
    s = t["systick"].where(_SYSTICK).withColumn("_at", F.conv(F.regexp_replace("offset", "^0x", ""), 16, 10).cast("int")).withColumn("_end", F.col("_at") + F.expr("cast(width_bits as int) div 8"))
    before = Window.partitionBy("family", "block").orderBy("_at", "_end", "register").rowsBetween(Window.unboundedPreceding, -1)
    over = s.withColumn("_e", F.max("_end").over(before)).where("_at < _e")
    bits = t["pin_alternate"].select("family", "register", "pad", F.explode(F.expr(_BITS)).alias("bit")).distinct()
    shared = bits.groupBy("family", "register", "bit").agg(F.array_join(F.array_sort(F.collect_set("pad")), ",").alias("_pads"), F.countDistinct("pad").alias("_n")).where("_n > 1")
    functions = t["pin_functions"].where("route like 'af-%'").withColumn("pad", F.regexp_extract("pad", f"^({PAD})", 1)).where("pad <> ''").join(t["products"].select("part_number", "family"), "part_number")
    nowhere = functions.join(t["pin_alternate"].select("family", "pad"), ["family", "pad"], "left_anti")
    loose = t["pin_functions"].join(t["pins"].select("part_number", "pad"), ["part_number", "pad"], "left_anti")
    return [
        _out(over, "systick", "registers don't overlap", KEYS["systick"], F.col("offset")),
        _out(shared, "pin_alternate", "bits don't overlap", ["family", "register"], F.concat_ws(" ", "bit", "_pads")),
        _out(nowhere, "pin_functions", "alternate function is written somewhere", ["part_number", "pad"], F.col("route")),
        _out(loose.distinct(), "pin_functions", "pad is a pin", ["part_number", "pad"], F.lit("")),
    ]


def memory_violations(t: dict[str, DataFrame]) -> list[DataFrame]:
    m = t["memory_configs"]
    quoted = m.where("coalesce(datasheet_value, '') <> ''")
    counts = m.groupBy("part_number").agg(F.count_if(F.coalesce("datasheet_value", F.lit("")) != "").alias("_q"), F.array_sort(F.collect_list("value")).alias("_v"))
    one = quoted.join(counts.where("_q = 1").select("part_number"), "part_number").join(t["products"].select("part_number", F.col("sram_bytes").alias("_s"), F.col("flash_bytes").alias("_f")), "part_number", "left")
    pairs = counts.select("part_number", F.posexplode("_v").alias("_i", "one"), "_v").select("part_number", "one", F.explode(F.expr("slice(_v, _i + 2, size(_v))")).alias("other"))
    widths = m.groupBy("part_number").agg(canon.code_width(F.collect_list("value")).alias("_need"))
    stated = m.select("part_number", F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("cell")) for c in ("option_byte_bits", "obr_bits")])).alias("c")).select("part_number", "c.*").where("cell <> ''").distinct()
    cells = stated.join(widths, "part_number")
    wide = F.regexp_extract("cell", r"^\[([0-9]+):([0-9]+)\]$", 1).try_cast("int") - F.regexp_extract("cell", r"^\[([0-9]+):([0-9]+)\]$", 2).try_cast("int") + 1
    return [
        _out(counts.where("_q <> 1"), "memory_configs", "one row is quoted", ["part_number"], F.col("_q")),
        _out(one.where("not (sram_bytes <=> _s)"), "memory_configs", "quoted RAM is the product's", ["part_number"], F.concat_ws(" <> ", "sram_bytes", "_s")),
        _out(one.where("sram_bytes <=> _s and not (code_bytes <=> _f)"), "memory_configs", "quoted flash is the product's", ["part_number"], F.concat_ws(" <> ", "code_bytes", "_f")),
        _out(pairs.where(canon.overlapping_patterns("one", "other")), "memory_configs", "codes are disjoint", ["part_number"], F.concat_ws(" ", "one", "other")),
        _out(cells.where(~F.col("cell").rlike(r"^\[[0-9]+:[0-9]+\]$")), "memory_configs", "span is [hi:lo]", ["part_number"], F.concat_ws(" ", "column", "cell")),
        _out(cells.where(wide < F.col("_need")), "memory_configs", "span is wide enough", ["part_number"], F.concat_ws(" ", "column", "cell")),
    ]


def check(t: dict[str, DataFrame], symbol: str, macro: str, excepted: Sequence[str] = ("label_zh",)) -> DataFrame:
    """(rule, key, detail) of all violations of all rules."""
    keys = [rules.foreign_key(f"{a}.{c}", t[a], c, t[b], d, s) for a, c, b, d, s in FOREIGN_KEYS]
    leaks: list[DataFrame] = [records.leaks(df.withColumn("_k", F.concat_ws(" ", *[F.col(f"`{c}`") for c in df.columns[:2]])), "_k", df.columns, excepted).withColumn("rule", F.lit(f"{name}: no CJK in data")) for name, df in t.items()]
    frames: Sequence[DataFrame] = [*keys, *row_violations(t), *remap_violations(t), *clock_violations(t, symbol, macro), *layout_violations(t), *memory_violations(t), *leaks]
    return rules.violations(frames)
