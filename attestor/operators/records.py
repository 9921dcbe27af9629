"""Rules over nested records, one row a record, and screens over rows; a rule is a Column that names what is wrong.

A rule gives an array of texts, empty where the record keeps it, so that all rules of a record are evaluated in one pass
without a shuffle: nested collections are a record's own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestor.functions import canon

NONE = "cast(array() as array<string>)"


def said(condition: Column | str, text: Column | str) -> Column:
    """[text] where the condition holds, else []; unknown is no violation."""
    c = F.expr(condition) if isinstance(condition, str) else condition
    t = F.lit(text) if isinstance(text, str) else text
    return F.when(F.coalesce(c, F.lit(False)), F.array(t)).otherwise(F.expr(NONE))


def each(items: str, condition: str, text: str) -> Column:
    """A text for every x of an array for which the condition holds; both are SQL over x."""
    return F.expr(f"transform(filter(coalesce({items}, array()), x -> coalesce({condition}, false)), x -> {text})")


def repeats(items: str) -> str:
    """SQL: whether an array of values repeats one."""
    return f"size(array_distinct({items})) < size({items})"


def first_of(*rules: Column) -> Column:
    """The violations of the first rule that has any: later rules rely on earlier ones."""
    out = rules[-1]
    for r in reversed(rules[:-1]):
        out = F.when(F.size(r) > 0, r).otherwise(out)
    return out


BITS = "transform(x.bits, b -> concat(b.register, ':', cast(b.bit as string)))"
BAD_BITS = "coalesce(size(x.bits), 0) <= 0 or exists(x.bits, b -> coalesce(b.register, '') = '' or b.bit is null or b.bit not between 0 and 31)"
BAD_VALUES = "coalesce(size(x.valid_values), 0) <= 0 or exists(x.valid_values, v -> v is null or v < 0 or v >= shiftleft(1L, size(x.bits))) or size(array_distinct(x.valid_values)) < size(x.valid_values)"
#: A selection with its selector: filled by selections().
VALUES = "x.values"


def identity(file: str) -> dict[str, Column]:
    stem = F.regexp_replace(F.col(file), r"\.json$", "")
    return {
        "id is the file's name": said(~F.col("id").eqNullSafe(stem), F.concat_ws(" <> ", "id", stem)),
        "part number is the id": said(F.lower("identity.part_number") != stem, F.concat_ws(" <> ", F.col("identity.part_number"), stem)),
    }


def sources(evidence: str) -> dict[str, Column]:
    """Rules on sources; `evidence` is the column with all source ids that the record's evidence names."""
    return {
        "source ids are unique": said(repeats("sources.id"), "repeated"),
        "evidence has a known source": F.expr(f"array_except({evidence}, sources.id)"),
    }


def completeness() -> dict[str, Column]:
    """What a record that says its pins are complete must have; without that, nothing."""
    numbers = "transform(pins, p -> try_cast(p.number as int))"
    whole = F.col("coverage.package_pins") == "complete"
    entries = said("pins is null or package is null", "no pins or package")
    count = said(whole & F.expr("size(pins) <> package.pin_count + coalesce(package.exposed_pad_count, 0)"), F.expr("concat(size(pins), ' entries')"))
    rest = F.concat(
        said(F.expr(f"size(array_except(sequence(1, package.pin_count), {numbers})) > 0 or size(array_except(filter({numbers}, n -> n is not null), sequence(1, package.pin_count))) > 0"), "numbers not 1 to pin_count"),
        said("size(array_distinct(filter(pins.number, n -> n like 'EP%'))) <> coalesce(package.exposed_pad_count, 0)", "exposed pads"),
        said("not (size(filter(pins, p -> p.kind = 'gpio')) <=> package.gpio_count)", "gpio count"),
    )
    return {
        "complete pins": F.when(whole, first_of(entries, count, rest)).otherwise(F.expr(NONE)),
        "complete functions need complete pins": said(F.expr("coverage.pin_functions = 'complete' and not (coverage.package_pins <=> 'complete')"), "pins not complete"),
    }


def selector_rules() -> dict[str, Column]:
    keys = "transform(route_selectors, x -> concat_ws('|', x.controller, x.register, x.field))"
    good = f"filter(route_selectors, x -> not ({BAD_BITS}) and not ({repeats(BITS)}))"
    return {
        "selectors is an array": said("route_selectors is null", "missing"),
        "selector ids are unique": said(f"exists(route_selectors, x -> x.id is null) or {repeats('route_selectors.id')}", "missing or repeated"),
        "selector fields are unique": F.expr(f"transform(filter(transform({keys}, (k, i) -> named_struct('k', k, 'i', i)), s -> array_position({keys}, s.k) <= s.i), s -> s.k)"),
        "selector bits are valid": each("route_selectors", BAD_BITS, "x.id"),
        "selector bits don't repeat": each(f"filter(route_selectors, x -> not ({BAD_BITS}))", repeats(BITS), "x.id"),
        "register is the bits' registers": each(good, "not (x.register <=> array_join(array_distinct(x.bits.register), '|'))", "x.id"),
        "selector values are valid": each(good, BAD_VALUES, "x.id"),
        "reset value is valid": each(good, f"not ({BAD_VALUES}) and not coalesce(array_contains(x.valid_values, x.reset_value), false)", "x.id"),
        "selectors don't overlap": F.expr(f"transform(filter(transform({good}, (x, i) -> named_struct('x', x, 'i', i)), s -> exists(slice({good}, 1, s.i), y -> y.controller <=> s.x.controller and arrays_overlap(transform(y.bits, b -> concat(b.register, ':', cast(b.bit as string))), transform(s.x.bits, b -> concat(b.register, ':', cast(b.bit as string)))))), s -> s.x.id)"),
    }


def pin_rules() -> dict[str, Column]:
    """Rules on pins, their functions and what functions select; a selection is compared with the last selector of its id."""
    chosen = "flatten(transform(pins, p -> transform(filter(p.functions, f -> f.selection is not null), f -> named_struct('pin', p.number, 'values', f.selection.values, 'selector', f.selection.selector, 's', try_element_at(filter(route_selectors, s -> s.id <=> f.selection.selector), -1)))))"
    met = f"filter({chosen}, x -> x.s is not null)"
    key = "transform(x.functions, f -> concat_ws('|', coalesce(f.signal, '-'), coalesce(f.peripheral, '-'), coalesce(f.route, '-'), coalesce(f.conditions, '-')))"
    label = "concat(x.pin, ':', x.selector)"
    return {
        "pin numbers are unique": said(repeats("pins.number"), "repeated"),
        "functions of a pin are unique": each("pins", repeats(key), "x.number"),
        "selection has a known selector": each(chosen, "x.s is null", label),
        "selected values are stated": each(met, f"coalesce(size({VALUES}), 0) <= 0 or exists({VALUES}, v -> v is null)", label),
        "selected values are unique": each(met, repeats(VALUES), label),
        "selected values fit the width": each(met, f"exists({VALUES}, v -> v < 0 or v >= shiftleft(1L, size(x.s.bits)))", label),
        "selected values are not reserved": each(met, f"size(array_except({VALUES}, x.s.valid_values)) > 0", label),
    }


def part_rules() -> dict[str, Column]:
    """Rules on memory regions, special I/O and components."""
    return {
        "memory regions are unique": said(repeats("memory.regions.id"), "repeated"),
        "parent region is known": F.expr("array_except(filter(memory.regions.subset_of, p -> p is not null), memory.regions.id)"),
        "special I/O kinds are unique": said(repeats("package.special_io_counts.kind"), "repeated"),
        "components are unique": said(repeats("integrated_components.id"), "repeated"),
    }


def violations(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """(rule, key, detail) of all rules over records, in one pass."""
    pairs = F.array(*[F.struct(F.lit(name).alias("rule"), F.coalesce(found, F.expr(NONE)).alias("details")) for name, found in rules.items()])
    rows = df.select(F.col(key).cast("string").alias("key"), F.explode(pairs).alias("r")).where(F.size("r.details") > 0)
    return rows.select("r.rule", "key", F.explode("r.details").alias("detail")).distinct()


def screened(df: DataFrame, reasons: Sequence[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """Rows that no condition speaks against, and the others with the first reason, each reason of a row once."""
    why = F.lit(None).cast("string")
    for reason, condition in reversed(reasons):
        why = F.when(F.coalesce(condition, F.lit(False)), reason).otherwise(why)
    marked = df.withColumn("reason", why)
    return marked.where("reason is null").drop("reason"), marked.where("reason is not null").distinct()


def agreeing(symbol: Column | str, unit: Column | str, units: Sequence[tuple[str, str]]) -> Column:
    """Whether a unit, if there is one, is what symbols of its kind have; units are (pattern of the symbol, pattern of the unit)."""
    s, u = (F.col(x) if isinstance(x, str) else x for x in (symbol, unit))
    out = F.lit(True)
    for name, want in units:
        out = out & (~s.rlike(name) | (F.coalesce(u, F.lit("")) == "") | u.rlike(want))
    return out


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key, by one grouping."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def long_enough(cells: Column | str, least: int) -> Column:
    """Whether a row has the columns that reading it takes."""
    return F.size(F.col(cells) if isinstance(cells, str) else cells) > least


def headings_attached(df: DataFrame, group: Sequence[str], order: Sequence[str], heading: str, name: Column, out: str) -> DataFrame:
    """Each row with the name in the last heading above it; a heading without a name resets it."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    above = F.last(F.when(F.col(heading), F.struct(name.alias("name"))), ignorenulls=True).over(w)
    return df.withColumn(out, above["name"])


def closed_groups(df: DataFrame, group: Sequence[str], order: Sequence[str], item: str, closing: str, out: str) -> DataFrame:
    """Numbers groups of items: one ends where a closing row has been seen and the next item comes.

    Rows between the items of a group belong to it; those before its first are 0.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    place = F.row_number().over(w)
    marked = df.withColumn("_p", place)
    marked = marked.withColumn("_i", F.max(F.when(F.col(item), F.col("_p"))).over(before)).withColumn("_c", F.max(F.when(F.col(closing) & ~F.col(item), F.col("_p"))).over(before))
    opens = F.when(F.col(item) & (F.col("_i").isNull() | (F.col("_c") > F.col("_i"))), 1).otherwise(0)
    return marked.withColumn("_o", opens).withColumn(out, F.sum("_o").over(upto)).drop("_p", "_i", "_c", "_o")


def leaks(df: DataFrame, key: str, columns: Sequence[str], but: Sequence[str] = (), stop: str = "#") -> DataFrame:
    """Rows with Chinese or Japanese characters in a data column: those before the separator, without the excepted ones."""
    data = []
    for c in columns:
        if c == stop:
            break
        if c not in but:
            data.append(c)
    return df.where(canon.leaks_cjk(data)).select(F.lit("no CJK in data").alias("rule"), F.col(key).cast("string").alias("key"), F.array_join(F.array(*[F.when(F.col(c).cast("string").rlike(canon.CJK), c) for c in data]), ",").alias("detail"))
