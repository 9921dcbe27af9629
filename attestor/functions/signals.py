"""Names of signals, peripherals and selector fields, spelled so that two documents compare equal."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from attestor.functions.canon import _c

#: Fixed values of the grammar: peripherals whose first instance may go unnumbered, other spellings of a peripheral,
#: serial roles, timer roles and their short forms, and roles that name their peripheral by convention.
IMPLIED_FIRST = ("USART", "UART", "SPI", "I2C", "TIM", "CAN", "ADC")
SAME_PERIPHERAL = {"UART": "USART", "LPT": "LPTIM"}
SERIAL = r"^U?(TX|RX|CK|CTS|RTS)([0-9]?)$"
TIMER_CHANNEL = r"^T([0-9])CH?([0-9])(N?)$"
TIMER_COMBINED = r"^T([0-9])CH?([0-9])ETR$"
TIMER_OTHER = r"^T([0-9])(BK(?:IN)?|ETR?)$"
TIMER_ROLES = {"BK": "BKIN", "ET": "ETR"}
CONVENTIONAL = {"SCL": ("I2C", "SCL"), "SDA": ("I2C", "SDA"), "MISO": ("SPI", "MISO"), "MOSI": ("SPI", "MOSI"), "SCK": ("SPI", "SCK"), "NSS": ("SPI", "NSS"), "CS": ("SPI", "NSS")}
FIELD_SUFFIX = r"_(?:RM|REMAP)(?:_H|[0-9])?$"
INSTANCE = r"^([A-Z][A-Z0-9]*?)([0-9]*)$"


def _looked_up(x: Column, table: dict[str, str]) -> Column:
    out = F.when(x == F.lit(None), None)
    for k, v in table.items():
        out = out.when(x == k, v)
    return out.otherwise(x)


def peripheral(x: Column | str) -> Column:
    """A peripheral's name with its instance number where one is implied; what is no such name stays."""
    c = _c(x)
    name, digits = _looked_up(F.regexp_extract(c, INSTANCE, 1), SAME_PERIPHERAL), F.regexp_extract(c, INSTANCE, 2)
    numbered = F.when(digits != "", F.concat(name, digits)).when(name.isin(*IMPLIED_FIRST), F.concat(name, F.lit("1"))).otherwise(name)
    return F.when(c.rlike(INSTANCE), numbered).otherwise(c)


def field(x: Column | str) -> Column:
    """A selector field's name without the suffix that says it is one; its peripheral spelled out."""
    base = F.regexp_replace(_c(x), FIELD_SUFFIX, "")
    head = F.substring_index(base, "_", 1)
    return F.concat(peripheral(head), F.substring(base, F.length(head) + 1, F.length(base)))


def parse(x: Column | str) -> Column:
    """struct(peripheral, role) of a signal name by the first rule that fits; NULL if none does."""
    c = _c(x)

    def g(pattern, k):
        return F.regexp_extract(c, pattern, k)

    def pair(p, role):
        return F.struct(p.alias("peripheral"), role.alias("role"))

    head = F.substring_index(c, "_", 1)
    tail = F.substring(c, F.length(head) + 2, F.length(c))
    out = (
        F.when(tail != "", pair(peripheral(head), tail))
        .when(c.rlike(SERIAL), pair(F.concat(F.lit("USART"), F.when(g(SERIAL, 2) == "", "1").otherwise(g(SERIAL, 2))), g(SERIAL, 1)))
        .when(c.rlike(TIMER_CHANNEL), pair(F.concat(F.lit("TIM"), g(TIMER_CHANNEL, 1)), F.concat(F.lit("CH"), g(TIMER_CHANNEL, 2), g(TIMER_CHANNEL, 3))))
        .when(c.rlike(TIMER_COMBINED), pair(F.concat(F.lit("TIM"), g(TIMER_COMBINED, 1)), F.concat(F.lit("CH"), g(TIMER_COMBINED, 2), F.lit("_ETR"))))
        .when(c.rlike(TIMER_OTHER), pair(F.concat(F.lit("TIM"), g(TIMER_OTHER, 1)), _looked_up(g(TIMER_OTHER, 2), TIMER_ROLES)))
    )
    for name, (p, role) in CONVENTIONAL.items():
        out = out.when(c == name, pair(peripheral(F.lit(p)), F.lit(role)))
    return out.otherwise(F.lit(None).cast("struct<peripheral: string, role: string>"))


def comparable(x: Column | str) -> Column:
    """PERIPHERAL_ROLE where a rule covers the name, else the name itself."""
    p = parse(x)
    return F.coalesce(F.concat(p["peripheral"], F.lit("_"), p["role"]), _c(x))


def other_instance(a: Column | str, b: Column | str) -> Column:
    """Whether two names differ in their instance number only."""
    x, y = _c(a), _c(b)
    both = x.rlike(INSTANCE) & y.rlike(INSTANCE)
    return both & (F.regexp_extract(x, INSTANCE, 1) == F.regexp_extract(y, INSTANCE, 1)) & (F.regexp_extract(x, INSTANCE, 2) != F.regexp_extract(y, INSTANCE, 2))


def owns(key: Column | str, name: Column | str) -> Column:
    """Whether a selector field is named for a peripheral, as a whole or in its first part."""
    k, n = _c(key), _c(name)
    return (k == n) | (F.substring_index(k, "_", 1) == n)
