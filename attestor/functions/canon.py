"""Canonical values: column functions that make spellings of one fact comparable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spellings of "no value".
BLANKS = ("", "-", "—")


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def blank_to_null(x: Column | str) -> Column:
    """NULL for blank markers, else the trimmed text."""
    t = F.trim(_c(x))
    return F.when(~t.isin(*BLANKS), t)


def ordered_replace(x: Column | str, pairs: Sequence[tuple[str, str]]) -> Column:
    """Literal replacements one after the other; later ones see what earlier ones made."""
    out = _c(x)
    for old, new in pairs:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def fold_width(x: Column | str) -> Column:
    """Full-width ASCII forms to their half-width characters."""
    return F.translate(_c(x), "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　", "".join(chr(c) for c in range(0x21, 0x7F)) + " ")


def strip_notes(x: Column | str) -> Column:
    """Text without footnote marks such as (1), full-width ones too, wherever they stand."""
    return F.regexp_replace(_c(x), r"\s*[\(（][0-9]+[\)）]", "")


def canonical(x: Column | str) -> Column:
    """Case, width and spacing folded; NULL for blanks."""
    return blank_to_null(F.lower(F.regexp_replace(fold_width(x), r"\s+", " ")))


_SIZE = r"^([0-9]+)\s*([KMG]?)B?$"


def parse_size(x: Column | str) -> Column:
    """'64K', '2 MB', '512' or '20K(1)' in bytes; NULL if it isn't a size."""
    t = F.upper(F.regexp_replace(F.trim(_c(x)), r"\s*[\(（][0-9]+[\)）]\s*$", ""))
    n, unit = F.regexp_extract(t, _SIZE, 1), F.regexp_extract(t, _SIZE, 2)
    factor = F.when(unit == "K", 1 << 10).when(unit == "M", 1 << 20).when(unit == "G", 1 << 30).otherwise(1)
    return F.when(n != "", n.try_cast("long") * factor.cast("long"))


def size_text(x: Column | str) -> Column:
    """A size in bytes as text; what is no size stays as it is, trimmed."""
    return F.coalesce(parse_size(x).cast("string"), F.trim(_c(x)))


def human_size(x: Column | str) -> Column:
    """Bytes as text: whole kilobytes with a K, other numbers as they are, '-' for nothing."""
    v = _c(x).try_cast("long") if isinstance(x, Column) else F.col(x).try_cast("long")
    other = F.coalesce(F.nullif(_c(x).cast("string"), F.lit("")), F.lit("-"))
    return F.when(v.isNull(), other).when(v % 1024 == 0, F.concat((F.floor(v / 1024)).cast("long").cast("string"), F.lit("K"))).otherwise(v.cast("string"))


def dimension(x: Column | str) -> Column:
    """'3.0*3.0mm' and '3x3' alike: units and spellings of 'times' folded, numbers without idle zeros."""
    parts = F.split(F.regexp_replace(F.regexp_replace(F.upper(_c(x)), "MM", ""), "X", "*"), r"\*")
    plain = F.transform(parts, lambda p: F.when(p.try_cast("double").isNotNull(), F.regexp_replace(F.regexp_replace(F.trim(p), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")).otherwise(F.trim(p)))
    return canonical(F.array_join(plain, "*"))


def parse_range(x: Column | str) -> Column:
    """struct(lo, hi) of 'lo~hi' or 'lo-hi' (a single number is both); NULL otherwise."""
    pattern = r"^\s*(-?[0-9.]+)\s*(?:(?:~|-|to|\.\.)\s*(-?[0-9.]+))?\s*$"
    lo, hi = F.regexp_extract(_c(x), pattern, 1), F.regexp_extract(_c(x), pattern, 2)
    return F.when(lo != "", F.struct(lo.try_cast("double").alias("lo"), F.coalesce(hi.try_cast("double"), lo.try_cast("double")).alias("hi")))


def number_like(x: Column | str) -> Column:
    return F.trim(_c(x)).rlike(r"^[±+-]?[0-9]+(\.[0-9]+)?$")


def same_number(a: Column | str, b: Column | str) -> Column:
    """Equal as numbers where both are, else as canonical text."""
    x, y = _c(a).try_cast("double"), _c(b).try_cast("double")
    return F.when(x.isNotNull() & y.isNotNull(), x == y).otherwise(canonical(a).eqNullSafe(canonical(b)))


# Bits.


def bits_to_mask(positions: Column | str) -> Column:
    """OR of 1 << position over an array of positions."""
    return F.aggregate(_c(positions), F.lit(0).cast("long"), lambda acc, p: acc.bitwiseOR(F.expr("1L") * F.pow(F.lit(2), p).cast("long")))


def mask_to_bits(mask: Column | str, width: int = 32) -> Column:
    """Ascending positions of the set bits."""
    m = _c(mask).cast("long")
    return F.filter(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.getbit(m, i) == 1)


def contiguous(mask: Column | str) -> Column:
    """Whether the set bits of a mask are one run; an empty mask isn't."""
    m = _c(mask).cast("long")
    return (m != 0) & (((m.bitwiseAND(-m)) + m).bitwiseAND(m) == 0)


def width_differs(comment: Column | str, value: Column | str) -> Column:
    """The '[hi:lo]' of a comment if it isn't as wide as the value has bits set; NULL if it is, or there is none."""
    c, v = _c(comment), _c(value).cast("long")
    hi, lo = F.regexp_extract(c, r"\[([0-9]+):([0-9]+)\]", 1), F.regexp_extract(c, r"\[([0-9]+):([0-9]+)\]", 2)
    return F.when((hi != "") & (v != 0) & (hi.try_cast("int") - lo.try_cast("int") + 1 != F.bit_count(v)), F.regexp_extract(c, r"\[[0-9]+:[0-9]+\]", 0))


def expand_dont_care(pattern: Column | str) -> Column:
    """All values of a binary pattern in which x is either bit, ascending."""
    return F.aggregate(
        F.split(_c(pattern), ""),
        F.array(F.lit(0).cast("long")),
        lambda acc, ch: F.flatten(F.transform(acc, lambda v: F.when(ch == "x", F.array(v * 2, v * 2 + 1)).otherwise(F.array(v * 2 + ch.cast("long"))))),
    )


def overlapping_patterns(a: Column | str, b: Column | str) -> Column:
    """Whether two don't-care patterns have a common code, over the shorter one's length."""
    n = F.least(F.length(_c(a)), F.length(_c(b)))
    x, y = F.split(F.substring(_c(a), F.lit(1), n), ""), F.split(F.substring(_c(b), F.lit(1), n), "")
    return F.forall(F.zip_with(x, y, lambda p, q: (p == q) | (p == "x") | (q == "x")), lambda v: v)


def code_width(codes: Column | str) -> Column:
    """Bits that an array of patterns needs, trailing x left out."""
    return F.array_max(F.transform(_c(codes), lambda c: F.length(F.regexp_replace(c, "x+$", ""))))


# Lists and expansion.


def list_contains(cell: Column | str, item: str) -> Column:
    """Whether a ';' list has the exact element."""
    return F.coalesce(F.array_contains(F.split(F.nullif(_c(cell), F.lit("")), ";"), item), F.lit(False))


def slash_expand(x: Column | str) -> Column:
    """'V303/305/307' to [V303, V305, V307]: later parts replace the end of the first."""
    parts = F.split(_c(x), "/")
    first = F.element_at(parts, 1)
    return F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.substring(first, F.lit(1), F.greatest(F.length(first) - F.length(p), F.lit(0))), p)))


def wildcard_match(name: Column | str, pattern: Column | str) -> Column:
    """Whether a name fits a pattern in which x is one capital or digit."""
    return F.rlike(_c(name), F.concat(F.lit("^"), F.replace(_c(pattern), F.lit("x"), F.lit("[A-Z0-9]")), F.lit("$")))


def natural_key(x: Column | str) -> list[Column]:
    """Sort columns: numbers first by value, then text."""
    n = _c(x).try_cast("long")
    return [n.isNull().asc(), n.asc_nulls_last(), _c(x).asc_nulls_last()]


def capped(items: Column | str, most: int, mark: str = "…") -> Column:
    """The first elements of an array joined by ', ', with a mark if there are more."""
    a = _c(items)
    return F.concat(F.array_join(F.slice(a, 1, most), ", "), F.when(F.size(a) > most, F.lit(f", {mark}")).otherwise(F.lit("")))


def classify(x: Column | str, rules: Sequence[tuple[str, str]], default: str | None = None) -> Column:
    """The label of the first pattern that is found; rules are (pattern, label) in order.

    A label with $1 names a class for each value of the pattern's group, so that classes need not be listed.
    """
    c = _c(x)
    out = None
    for pattern, label in rules:
        named = F.regexp_replace(F.regexp_substr(c, F.lit(pattern)), pattern, label) if "$" in label else F.lit(label)
        out = F.when(c.rlike(pattern), named) if out is None else out.when(c.rlike(pattern), named)
    return out.otherwise(default)


def ordered_union(*lists: Column | str) -> Column:
    """Arrays united, each value where it comes first."""
    return F.array_distinct(F.concat(*[_c(x) for x in lists]))


# Text.

#: A pad beside anything but ASCII letters, digits and underscores; Chinese text has no word boundary there.
PAD_IN_PROSE = r"(?<![0-9A-Za-z_])P[A-H][0-9]{1,2}(?![0-9A-Za-z_])"


def pads_in(x: Column | str) -> Column:
    """All pads that a text names, in order, once each."""
    return F.array_distinct(F.regexp_extract_all(_c(x), F.lit(PAD_IN_PROSE), 0))


def upright(x: Column | str, accepted: str) -> Column:
    """A heading that may be printed backwards: the reversed text if that is accepted, else the text if it is, else NULL."""
    t = F.trim(strip_notes(F.regexp_replace(_c(x), "\n", "")))
    back = F.trim(F.reverse(t))
    return F.when(back.rlike(accepted), back).when(t.rlike(accepted), t)


def templated(template: str, **values: Column | str) -> Column:
    """A text with {name} places filled in; NULL if any value is."""
    out, parts = [], template.split("{")
    out.append(F.lit(parts[0]))
    for p in parts[1:]:
        name, _, rest = p.partition("}")
        out += [_c(values[name]).cast("string"), F.lit(rest)]
    return F.concat(*out)


def translated(x: Column | str, table: Column) -> Column:
    """The map's entry for the text without spaces, else its words translated one by one, else the text."""
    c = _c(x)
    flat = F.regexp_replace(c, "[ 　]", "")
    words = F.filter(F.split(c, r"\s+"), lambda w: w != "")
    each = F.transform(words, lambda w: F.coalesce(F.try_element_at(table, w), w))
    by_words = F.when((F.size(words) > 1) & (each != words), F.array_join(each, " "))
    return F.coalesce(F.try_element_at(table, flat), by_words, c)


def parse_map(x: Column | str) -> Column:
    """Map of 'k=v;k=v'; NULL for a blank."""
    return F.str_to_map(F.nullif(_c(x), F.lit("")), F.lit(";"), F.lit("="))


def render_map(x: Column | str) -> Column:
    """'k=v;k=v' of a map, by key."""
    entries = F.array_sort(F.map_entries(_c(x)))
    return F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"])), ";")


ALTERNATE = r"^(.+?)[\(（](?:AF|af)([0-9]+)[\)）]$"
ROUTED = r"^(.+?)_([0-9]+)$"


def route(x: Column | str, column: str) -> Column:
    """struct(signal, kind, value) of a name in a table's 'main', 'default' or 'remap' column.

    Kinds: main, default, af-n, remap-n; NULL where a name of the remap column says no route.
    """
    c = _c(x)

    def named(signal, kind, value):
        return F.struct(signal.alias("signal"), kind.alias("kind"), value.cast("int").alias("value"))

    none = F.lit(None).cast("string")
    alternate = named(F.regexp_extract(c, ALTERNATE, 1), F.concat(F.lit("af-"), F.regexp_extract(c, ALTERNATE, 2)), F.regexp_extract(c, ALTERNATE, 2))
    routed = named(F.regexp_extract(c, ROUTED, 1), F.concat(F.lit("remap-"), F.regexp_extract(c, ROUTED, 2)), F.regexp_extract(c, ROUTED, 2))
    if column == "main":
        return named(c, F.lit("main"), none)
    if column == "default":
        return F.when(c.rlike(ALTERNATE), alternate).otherwise(named(c, F.lit("default"), none))
    return F.when(c.rlike(ALTERNATE), alternate).when(c.rlike(ROUTED), routed).otherwise(named(c, none, none))


def megahertz(x: Column | str) -> Column:
    """'312_5' megahertz in hertz: the underscore is the decimal point."""
    return F.round(F.replace(_c(x), F.lit("_"), F.lit(".")).try_cast("double") * 1_000_000).cast("long")


def symmetric_difference(a: Column | str, b: Column | str) -> Column:
    """What only one of two arrays has, sorted."""
    return F.array_sort(F.array_union(F.array_except(_c(a), _c(b)), F.array_except(_c(b), _c(a))))


def subset(a: Column | str, b: Column | str) -> Column:
    """Whether all of one array is in another."""
    return F.size(F.array_except(_c(a), _c(b))) == 0


#: Hiragana to the unified ideographs: fixed bounds of the scripts.
CJK = "[\u3040-\u30ff\u4e00-\u9fff]"
PROSE = "[a-z]{3,}"


def leaks_cjk(columns: Sequence[str]) -> Column:
    """Whether any of the columns has Japanese or Chinese characters."""
    return F.exists(F.array(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns]), lambda v: v.rlike(CJK))
