"""Column functions on literal values."""

import pytest
from pyspark.sql import functions as F

from attestor.functions import canon, signals


def pair(name):
    p = signals.parse(F.lit(name))
    return F.concat_ws("/", p["peripheral"], p["role"])


CASES = [
    (lambda: canon.canonical(F.lit("  Ａ  B ")), "a b"),
    (lambda: canon.canonical(F.lit("—")), None),
    (lambda: canon.strip_notes(F.lit("VDD（1）")), "VDD"),
    (lambda: canon.parse_size(F.lit("64K")), 65536),
    (lambda: canon.parse_size(F.lit("2 MB")), 2097152),
    (lambda: canon.parse_size(F.lit("many")), None),
    (lambda: canon.human_size(F.lit(65536)), "64K"),
    (lambda: canon.human_size(F.lit(1000)), "1000"),
    (lambda: canon.parse_range(F.lit("2.0~3.6"))["hi"], 3.6),
    (lambda: canon.parse_range(F.lit("5"))["lo"], 5.0),
    (lambda: canon.parse_range(F.lit("a")), None),
    (lambda: canon.number_like(F.lit("±0.5")), True),
    (lambda: canon.same_number(F.lit("3.0"), F.lit("3")), True),
    (lambda: canon.bits_to_mask(F.array(F.lit(0), F.lit(3))), 9),
    (lambda: F.array_join(canon.mask_to_bits(F.lit(9)).cast("array<string>"), ","), "0,3"),
    (lambda: canon.contiguous(F.lit(12)), True),
    (lambda: canon.contiguous(F.lit(5)), False),
    (lambda: canon.contiguous(F.lit(0)), False),
    (lambda: F.array_join(canon.expand_dont_care(F.lit("1x")).cast("array<string>"), ","), "2,3"),
    (lambda: canon.overlapping_patterns(F.lit("1x0"), F.lit("110")), True),
    (lambda: canon.overlapping_patterns(F.lit("00x"), F.lit("01x")), False),
    (lambda: canon.overlapping_patterns(F.lit("1"), F.lit("10")), True),
    (lambda: canon.list_contains(F.lit("ab;c"), "c"), True),
    (lambda: canon.list_contains(F.lit("ab;c"), "a"), False),
    (lambda: canon.list_contains(F.lit(""), ""), False),
    (lambda: F.array_join(canon.slash_expand(F.lit("V303/305/7")), ","), "V303,V305,V307"),
    (lambda: canon.wildcard_match(F.lit("F4P6"), F.lit("F4Px")), True),
    (lambda: canon.code_width(F.array(F.lit("01x"), F.lit("1"))), 2),
    (lambda: pair("TX2"), "USART2/TX"),
    (lambda: pair("UTX"), "USART1/TX"),
    (lambda: pair("T1C1N"), "TIM1/CH1N"),
    (lambda: pair("T2CH3"), "TIM2/CH3"),
    (lambda: pair("T1C2ETR"), "TIM1/CH2_ETR"),
    (lambda: pair("T1BK"), "TIM1/BKIN"),
    (lambda: pair("T3ET"), "TIM3/ETR"),
    (lambda: pair("UART5_TX"), "USART5/TX"),
    (lambda: pair("UART_TX"), "USART1/TX"),
    (lambda: pair("PIOC_IO0"), "PIOC/IO0"),
    (lambda: pair("LPT_OUT"), "LPTIM/OUT"),
    (lambda: pair("CS"), "SPI1/NSS"),
    (lambda: pair("SDA"), "I2C1/SDA"),
    (lambda: pair("I2S3_WS"), "I2S3/WS"),
    (lambda: signals.parse(F.lit("AETR2")), None),
    (lambda: signals.parse(F.lit("A_")), None),
    (lambda: signals.field(F.lit("USART1_RM_H")), "USART1"),
    (lambda: signals.field(F.lit("USART1_REMAP")), "USART1"),
    (lambda: signals.field(F.lit("USART_RM1")), "USART1"),
    (lambda: signals.field(F.lit("ADC_ETRGINJ_RM")), "ADC1_ETRGINJ"),
    (lambda: signals.field(F.lit("ETH_RM")), "ETH"),
    (lambda: signals.comparable(F.lit("AETR2")), "AETR2"),
    (lambda: signals.other_instance(F.lit("TIM3"), F.lit("TIM4")), True),
    (lambda: signals.other_instance(F.lit("SPI3"), F.lit("I2S3")), False),
    (lambda: signals.owns(F.lit("ADC1_ETRGINJ"), F.lit("ADC1")), True),
    (lambda: canon.human_size(F.lit(1048576)), "1024K"),
    (lambda: canon.human_size(F.lit("")), "-"),
    (lambda: canon.strip_notes(F.lit("SDIO_D0（7）/PD0(4)")), "SDIO_D0/PD0"),
    (lambda: canon.parse_size(F.lit("20K(1)")), 20480),
    (lambda: canon.size_text(F.lit(" many ")), "many"),
    (lambda: canon.dimension(F.lit("3.0*3.0mm")), "3*3"),
    (lambda: canon.dimension(F.lit("10x1.50")), "10*1.5"),
    (lambda: canon.width_differs(F.lit("x[3:2] y"), F.lit(12)), None),
    (lambda: canon.width_differs(F.lit("x[3:1] y"), F.lit(12)), "[3:1]"),
    (lambda: F.array_join(canon.pads_in(F.lit("与PD1相连 PA12, PA1_X PA123 PD1")), ","), "PD1,PA12"),
    (lambda: canon.upright(F.lit("84PFQL"), "^LQFP"), "LQFP48"),
    (lambda: canon.upright(F.lit("LQFP48"), "^LQFP"), "LQFP48"),
    (lambda: canon.upright(F.lit("other"), "^LQFP"), None),
    (lambda: canon.templated("a/{x}_{y}.html", x=F.lit("s"), y=F.lit(3)), "a/s_3.html"),
    (lambda: canon.translated(F.lit("通信 接口 CAN"), F.create_map(F.lit("通信接口"), F.lit("port"), F.lit("接口"), F.lit("if"))), "通信 if CAN"),
    (lambda: canon.translated(F.lit("通信 接口"), F.create_map(F.lit("通信接口"), F.lit("port"))), "port"),
    (lambda: canon.render_map(canon.parse_map(F.lit("b=2;a=1"))), "a=1;b=2"),
    (lambda: canon.route(F.lit("TIM8_CH1(AF0)"), "default")["kind"], "af-0"),
    (lambda: canon.route(F.lit("TIM1_CH1_2"), "remap")["signal"], "TIM1_CH1"),
    (lambda: canon.route(F.lit("SWDIO"), "remap")["kind"], None),
    (lambda: canon.megahertz(F.lit("312_5")), 312500000),
    (lambda: F.array_join(canon.symmetric_difference(F.split(F.lit("a,b"), ","), F.split(F.lit("b,c"), ",")), ","), "a,c"),
    (lambda: canon.subset(F.split(F.lit("a"), ","), F.split(F.lit("b,a"), ",")), True),
    (lambda: canon.capped(F.array(*map(F.lit, "abcd")), 3), "a, b, c, …"),
    (lambda: canon.ordered_replace(F.lit("aab"), [("ab", "c"), ("ac", "d")]), "d"),
]


@pytest.mark.parametrize("n", range(len(CASES)))
def test_value(spark, n):
    make, expected = CASES[n]
    assert spark.range(1).select(make().alias("v")).first()["v"] == expected
