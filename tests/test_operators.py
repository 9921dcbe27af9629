"""Operators on small literal tables: the cases that the driver's tables don't have."""

import json
import zipfile

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attestor.operators import carry, diff, evidence, parse, reconcile, resolve, rules
from attestor.sources import tables
from attestor.streaming import snapshots

FACTS = "k string, ord int, kind string, source string, value string, agreed boolean, soft boolean"


def judged(spark, rows):
    out = evidence.judge(spark.createDataFrame(rows, FACTS), ["k"]).collect()
    return {r["k"]: (r["value"], r["confidence"], r["basis"]) for r in out}


def test_judge(spark):
    r = lambda k, o, s, v: (k, o, "reading", s, v, None, False)
    c = lambda k, o, s, a, soft=False: (k, o, "check", s, None, a, soft)
    got = judged(
        spark,
        [
            r("one", 1, "a", "X"),
            r("two", 1, "a", "X "), r("two", 2, "b", "x"),
            r("differ", 1, "a", "x"), r("differ", 2, "b", "y"),
            c("none", 1, "rule", True),
            r("hard", 1, "a", "x"), r("hard", 2, "b", "x"), c("hard", 3, "rule", False),
            r("soft", 1, "a", "x"), c("soft", 2, "rule", False, True),
            r("agrees", 1, "a", "x"), c("agrees", 2, "rule", True, True),
            r("again", 1, "a", "x"), r("again", 2, "a", "x"),
        ],
    )
    assert got["one"] == ("X", "reference", "a")
    assert got["two"] == ("X ", "confirmed", "a+b")
    assert got["differ"] == ("x", "conflict", "a+b")
    assert got["none"] == (None, "missing", "rule")
    assert got["hard"] == ("x", "conflict", "a+b+!rule")
    assert got["soft"] == ("x", "reference", "a+?rule")
    assert got["agrees"] == ("x", "confirmed", "a+rule")
    assert got["again"][1] == "confirmed"


def test_dedup_evidence_makes_a_repeat_no_confirmation(spark):
    df = spark.createDataFrame([("k", 1, "reading", "a", "x", None, False), ("k", 2, "reading", "a", "X", None, False)], FACTS)
    assert evidence.judge(evidence.dedup_evidence(df, ["k"]), ["k"]).first()["confidence"] == "reference"


def test_rollup(spark):
    df = spark.createDataFrame([("a", "1", "confirmed"), ("a", "1", "confirmed"), ("b", "1", "confirmed"), ("b", "1", "reference"), ("c", "1", "confirmed"), ("c", "2", "confirmed"), ("d", "", "missing")], "g string, v string, c string")
    got = {r["g"]: (r["value"], r["confidence"]) for r in evidence.rollup(df, ["g"], "v", "c").collect()}
    assert got == {"a": ("1", "confirmed"), "b": ("1", "partial"), "c": (None, "varies"), "d": (None, "missing")}


def test_align(spark):
    rows = [("equal", 0, 0, "x"), ("equal", 1, 0, "x"), ("gap", 0, 0, "x"), ("gap", 1, 0, "y"), ("two", 0, 0, "x"), ("two", 0, 1, "y"), ("two", 1, 0, "z")]
    got = reconcile.align(spark.createDataFrame(rows, "g string, side int, pos int, v string"), ["g"], "side", "pos", "v").collect()
    by = {}
    for r in got:
        by.setdefault(r["g"], []).append((r["left"], r["right"], r["confidence"]))
    assert by["equal"] == [("x", "x", "confirmed")]
    assert by["gap"] == [("x", "y", "conflict")]
    assert by["two"] == [("x", None, "reference"), ("y", None, "reference"), (None, "z", "reference")]


def test_tiers(spark):
    pair = lambda *rows: spark.createDataFrame(rows, "k string, v string")
    got = resolve.tiered([("exact", pair(("a", "1")), True), ("prefix", pair(("a", "2"), ("b", "1"), ("b", "2"), ("c", "3")), True), ("any", pair(("b", "9")), False)], "k", "v").collect()
    assert {r["k"]: (r["v"], r["method"]) for r in got} == {"a": ("1", "exact"), "b": ("9", "any"), "c": ("3", "prefix")}


def test_carry(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, "a"), (1, 3, None), (1, 4, "b"), (1, 6, "b")], "g int, o int, v string")
    got = [r["c"] for r in carry.locf(df, ["g"], ["o"], "v", "c").orderBy("o").collect()]
    assert got == [None, "a", "a", "b", "b"]
    assert carry.dense(df, ["g"], "o").first()["dense"] is False
    runs = [r["island"] for r in carry.islands(df.na.fill("-"), ["g"], ["o"], "v").orderBy("o").collect()]
    assert runs == [1, 2, 3, 4, 4]
    spans = carry.gap_sessions(df, ["g"], ["o"], F.col("o"), F.col("o") + 1, 0)
    assert [r["session"] for r in spans.orderBy("o").collect()] == [1, 1, 1, 1, 2]


def test_rules(spark):
    df = spark.createDataFrame([("a", 0, 2), ("b", 2, 4), ("c", 3, 5)], "k string, s int, e int").withColumn("g", F.lit(1))
    assert [r["key"] for r in rules.intervals_overlap("r", df, ["g"], "s", "e", "k").collect()] == ["c"]
    lists = spark.createDataFrame([("a;b",), ("",), (None,)], "l string")
    parents = spark.createDataFrame([("a",)], "p string")
    assert [r["key"] for r in rules.foreign_key("r", lists, "l", parents, "p", ";").collect()] == ["b"]
    assert rules.counts(["r", "q"], [rules.unique("r", lists, ["l"])]).where("rule = 'q'").first()["violations"] == 0


def test_diff(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, None), (4, "d")], "k int, v string")
    assert {r["k"]: r["status"] for r in diff.snapshot_diff(old, new, ["k"], ["v"]).collect()} == {1: "gone", 2: "changed", 3: "same", 4: "added"}
    assert diff.collapse_guard(old, new.limit(1)).first()["collapsed"] is True


def test_parsers(spark):
    text = "#ifndef X_H\n#if A\n#define P 1\n#elif B\n#define Q (2) // two\n#else\n#define R 3\n#endif\n#define S 4\n#endif\n"
    got = [tuple(r)[1:] for r in parse.scan_defines(spark.createDataFrame([(1, text)], "k int, t string"), "k", "t").collect()]
    assert got == [(3, "P", "1", "A"), (5, "Q", "(2)", "!(A) && B"), (7, "R", "3", "!(A) && !(B)"), (9, "S", "4", "")]
    tree = "top\n├─a\n│  └─b\n└─c\n"
    got = [(r["path"], r["leaf"]) for r in parse.scan_tree(spark.createDataFrame([(1, tree)], "k int, t string"), "k", "t").collect()]
    assert got == [("top", False), ("top/a", False), ("top/a/b", True), ("top/c", True)]
    page = "<table><tr><th>A</th><td>b &amp; <b>c</b><tr><td>d</table>"
    got = [tuple(r)[1:] for r in parse.scan_cells(spark.createDataFrame([(1, page), (2, None)], "k int, t string"), "k", "t").collect()]
    assert got == [(0, 0, 0, "A"), (0, 0, 1, "b & c"), (0, 1, 0, "d")]
    code = "p = RCC->CFGR;\np |= 4;\nx = p + 1;\n"
    got = [(r["register"], r["op"]) for r in parse.scan_writes(spark.createDataFrame([(1, code)], "k int, t string"), "k", "t").collect()]
    assert got == [("RCC->CFGR", "="), ("RCC->CFGR", "|="), ("x", "=")]
    assert parse.resplit(spark.createDataFrame([(1, "TX1RXzz")], "k int, t string"), "k", "t", ["TX1", "TX", "RX"]).first()["pieces"] == "TX1 RX zz"


def test_sources(spark, tmp_path):
    df = spark.createDataFrame([("b", None, "confirmed"), ("a", 'say "hi",\nyes', "reference")], "k string, v string, v_confidence string")
    tables.write_csv(df, f"file://{tmp_path}/t", first=["k"], keys=["k"])
    columns = ["k", "v", "#", "v_confidence"]
    got = tables.csv(spark, f"file://{tmp_path}/t", columns).orderBy("k").collect()
    assert [tuple(r) for r in got] == [("a", 'say "hi",\nyes', "reference"), ("b", None, "confirmed")]
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x.json").write_text(json.dumps({"a": 1}, indent=2))
    schema = T.StructType([T.StructField("a", T.LongType())])
    assert tuple(tables.json_documents(spark, f"file://{tmp_path}/d", schema).first()) == (1, "x.json")
    (tmp_path / "c.txt").write_bytes("k = 1 # one\n中".encode("gb18030"))
    lines = tables.decoded_lines(spark, f"file://{tmp_path}/c.txt").orderBy("n").collect()
    assert [r["line"] for r in lines] == ["k = 1 # one", "中"]
    assert [(r["key"], r["value"]) for r in tables.key_values(spark.createDataFrame(lines)).collect()] == [("k", "1")]
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("lib/a.bin", b"123")
        z.writestr("doc/b.txt", b"4")
    assert [r["member"] for r in tables.zip_members(spark, f"file://{tmp_path}/z.zip", "lib/").collect()] == ["lib/a.bin"]
    assert tables.binary_prints(spark, f"file://{tmp_path}/z.zip").first()["first_byte"] == 0x50
    assert tables.or_empty(spark, lambda: spark.read.schema(schema).json(f"file://{tmp_path}/none"), schema).count() == 0
    over = tables.with_overrides(df, spark.createDataFrame([("b", "v2")], "k string, v string"), ["k"], ["v"])
    assert over.where("k = 'b'").first()["v"] == "v2"


def test_stream(spark, tmp_path):
    rows = [("2024-01-01 00:00:00", "a"), ("2024-01-01 00:10:00", "a"), ("2024-01-01 02:00:00", "a"), ("2024-01-01 12:00:00", "b")]
    spark.createDataFrame(rows, "t string, u string").select(F.to_timestamp("t").alias("t"), "u").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("t timestamp, u string").parquet(f"{tmp_path}/in")
    found = []
    q = snapshots.each_batch(snapshots.session_counts(stream, "t", "u"), lambda df, n: found.extend(df.collect()), f"{tmp_path}/ck")
    q.awaitTermination(120)
    assert sorted(r["events"] for r in found if r["u"] == "a") == [1, 2]
    q = snapshots.each_batch(snapshots.unseen(stream, spark.createDataFrame([("a",)], "u string"), "u"), lambda df, n: found.extend(df.collect()), f"{tmp_path}/ck2")
    q.awaitTermination(120)
    assert found[-1]["u"] == "b"


def test_recursive_chain_has_all_levels(spark, tmp_path):
    import pytest
    from attestor.operators import resolve
    from attestor.plans.catalogue import QUERIES

    n = 7000
    spark.range(1, n).withColumnRenamed("id", "p_partkey").write.parquet(f"{tmp_path}/part.parquet")
    expected = set()
    for node in range(3, n):
        up, depth = node // 3, 1
        while up:
            expected.add((node, up, depth))
            up, depth = up // 3, depth + 1
    got = [tuple(r) for r in QUERIES["recursive_chain"](spark, f"file://{tmp_path}").select("node", "ancestor", "depth").collect()]
    assert len(got) == len(set(got)) and set(got) == expected and max(d for *_, d in got) == 8
    cycle = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 1)], "a long, b long")
    with pytest.raises(ValueError):
        resolve.ancestors(cycle, "a", "b")


def test_dont_care_overlap_has_all_pairs_of_a_brand(spark, tmp_path):
    from attestor.plans.catalogue import QUERIES

    rows = [(1, "A", 0), (500, "A", 3), (9000, "A", 2), (9001, "B", 2)]
    spark.createDataFrame(rows, "p_partkey long, p_brand string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    got = {tuple(r) for r in QUERIES["dont_care_overlap"](spark, f"file://{tmp_path}").collect()}
    assert got == {("A", 1, 500, "1000", "101x", False), ("A", 1, 9000, "1000", "1010", False), ("A", 500, 9000, "101x", "1010", True)}


def test_dont_care_overlap_keeps_odd_rows_and_shuffles_no_pair(spark, tmp_path):
    import duckdb

    from attestor.plans.catalogue import ORACLE_SQL, QUERIES

    rows = [(1, "A", 3), (2, "A", None), (2, "A", 5), (3, "A", -3), (3, "A", 3), (None, "A", 3), (4, None, 3), (5, None, 3), (9, "B", 1)] + [(100 + i, "C", i) for i in range(200)]
    spark.createDataFrame(rows, "p_partkey long, p_brand string, p_size int").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    got = QUERIES["dont_care_overlap"](spark, f"file://{tmp_path}")
    theirs = duckdb.sql(ORACLE_SQL["dont_care_overlap"].replace("from part)", f"from '{tmp_path}/part.parquet/*.parquet')"))
    assert sorted(map(tuple, got.select(*theirs.columns).collect()), key=str) == sorted(theirs.fetchall(), key=str)
    tasks = got.select(F.spark_partition_id().alias("task")).groupBy("task").count().collect()
    assert len(tasks) == 4 and max(r["count"] for r in tasks) < 2 * min(r["count"] for r in tasks)  # one task for small tables before


def test_dont_care_overlap_writes_little(spark, tmp_path):
    from attestor.plans.catalogue import QUERIES

    n = 3000
    spark.range(n).selectExpr("id * 7 as p_partkey", "'A' as p_brand", "cast(id % 50 as int) as p_size").write.parquet(f"{tmp_path}/part.parquet")
    # a dictionary too small for the keys of a task, as Parquet's own is at 1.2 million parts
    QUERIES["dont_care_overlap"](spark, f"file://{tmp_path}").write.option("parquet.dictionary.page.size", 2048).parquet(f"{tmp_path}/out")
    got = spark.read.parquet(f"{tmp_path}/out")
    assert got.count() == got.select("one", "other").distinct().count() == n * (n - 1) // 2
    assert sum(p.stat().st_size for p in (tmp_path / "out").glob("*.parquet")) < n * (n - 1) // 2  # 1.98 bytes a pair before


def test_spread_offset_equals_the_running_sum(spark):
    rows = [(g, o, (g or 7) * o % 11) for g in (1, 2, None) for o in range(60)]
    df = spark.createDataFrame(rows, "g int, o int, n int").repartition(5)
    got = {(r["g"], r["o"]): r["at"] for r in carry.spread_offset(df, ["g"], ["o"], F.col("n"), "at").collect()}
    assert got == {(g, o): sum(n for a, b, n in rows if a == g and b < o) for g, o, _ in rows}


def test_next_different(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "a"), (1, 3, None), (1, 4, "b"), (1, 5, "b"), (2, 1, "c")], "g int, o int, v string")
    got = [tuple(r) for r in carry.next_different(df, ["g"], ["o"], "v", "n").select("g", "o", "n").orderBy("g", "o").collect()]
    assert got == [(1, 1, None), (1, 2, None), (1, 3, "b"), (1, 4, None), (1, 5, None), (2, 1, None)]


def test_align_compares_canonical_values_and_keeps_both_spellings(spark):
    rows = [("g", 0, 0, "A"), ("g", 0, 1, "Ｂ  c"), ("g", 0, 2, "-"), ("g", 0, 3, "x"), ("g", 1, 0, "a"), ("g", 1, 1, "b c"), ("g", 1, 2, "y"), ("one", 0, 5, "p")]
    got = reconcile.align(spark.createDataFrame(rows, "g string, side int, pos int, v string"), ["g"], "side", "pos", "v").orderBy("g", "n").collect()
    assert [(r["left"], r["right"], r["confidence"]) for r in got] == [("A", "a", "confirmed"), ("Ｂ  c", "b c", "confirmed"), ("x", "y", "conflict"), ("p", None, "reference")]


def brute_greedy(left, right):
    """left and right: (key, order, min, max, unit, typ) in order."""
    out, free = [], list(right)
    for row in left:
        own = [r for r in free if r[0] == row[0]]
        agrees = lambda r, row=row: r[2:4] == row[2:4] and all(a is None or b is None or a == b for a, b in zip(r[4:], row[4:], strict=True))
        met = next((r for r in own if agrees(r)), None)
        if met:
            free.remove(met)
            out.append((row[0], row[1], *[a if a is not None else b for a, b in zip(row[2:], met[2:], strict=True)], "confirmed", ""))
        elif own:
            free.remove(own[0])
            out.append((*row, "conflict", ",".join(f"{c}={'' if x is None else x}" for c, x, y in zip(("lo", "hi", "unit", "typ"), own[0][2:], row[2:], strict=True) if x != y)))
        else:
            out.append((*row, "reference", ""))
    return out


def test_greedy_match_by_brute_force(spark):
    import random

    rnd = random.Random(8)
    side = lambda n: [(f"k{rnd.randrange(6)}", i, rnd.randrange(3), rnd.randrange(2), rnd.choice([None, "V", "mA"]), rnd.choice([None, "1", "2"])) for i in range(n)]
    left, right = side(90), side(70)
    schema = "k string, o int, lo int, hi int, unit string, typ string"
    got = reconcile.greedy_match(spark.createDataFrame(left, schema).repartition(3), spark.createDataFrame(right, schema).repartition(3), ["k"], ["o"], ["lo", "hi"], ["unit", "typ"]).drop("taken")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute_greedy(left, right), key=str)
    kinds = {r["confidence"] for r in got.collect()}
    assert kinds == {"confirmed", "conflict", "reference"}


def test_greedy_match_of_hot_and_odd_keys(spark):
    import random
    import time

    rnd = random.Random(9)
    side = lambda n: [(rnd.choice([None, 1.5, float("nan")]), rnd.choice([None, *range(40)]), rnd.choice([None, 1, 2]), rnd.choice([None, 5, 6]), rnd.choice([None, 7, 8])) for _ in range(n)]
    order = lambda r: (repr(r[0]), r[1] is None, r[1] or 0)
    unique = lambda rows: sorted({order(r): r for r in rows}.values(), key=order)
    left, right = unique(side(150)), unique(side(130))
    schema = "k double, o int, e int, x int, y int"
    match = lambda a, b: reconcile.greedy_match(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), ["k"], ["o"], ["e"], ["x", "y"]).drop("taken")
    expected, free = [], [(repr(r[0]), *r[1:]) for r in right]
    for row in ((repr(r[0]), *r[1:]) for r in left):
        own = [r for r in free if r[0] == row[0]]
        met = next((r for r in own if r[2] == row[2] and all(None in p or p[0] == p[1] for p in zip(r[3:], row[3:], strict=True))), None)
        taken = met or next(iter(own), None)
        if taken:
            free.remove(taken)
        differ = "" if met or not taken else ",".join(f"{c}={'' if a is None else a}" for c, a, b in zip("exy", taken[2:], row[2:], strict=True) if a != b)
        filled = [a if b is None else b for a, b in zip(met[3:], row[3:], strict=True)] if met else row[3:]
        expected.append((*row[:3], *filled, "confirmed" if met else "conflict" if taken else "reference", differ))
    assert sorted(((repr(r[0]), *r[1:]) for r in match(left, right).collect()), key=str) == sorted(expected, key=str)
    n, began = 40_000, time.perf_counter()  # of one key, where looking through all free rows takes minutes
    rows = lambda x, y: spark.range(n).selectExpr("1d as k", "int(id) as o", "0 as e", f"{x} as x", f"{y} as y")
    got = reconcile.greedy_match(rows("int(id)", "int(id)"), rows(f"int({n} - 1 - id)", "int(null)"), ["k"], ["o"], ["e"], ["x", "y"])
    assert got.where(f"confidence = 'confirmed' and taken = {n} - 1 - o and x = o and y = o").count() == n and time.perf_counter() - began < 60


def test_selector_resolution_on_literal_rows(spark):
    from attestor.operators import selectors

    fields = spark.createDataFrame([("a", k) for k in ("TIM1", "TIM4", "ADC1_ETRGINJ", "ADC1_ETRGREG", "ISINK1_ADJ", "SPI3", "UHSIF_CLK", "UHSIF_PORT", "USART1")], "series string, key string")
    rows = [
        (1, "T1C1", 3, "PA0"), (2, "TIM4_CH1", 1, "PD12"), (3, "USART4_TX", 1, "PB0"), (4, "I2S3_WS", 1, "PA4"), (5, "ADC_ETR", 1, "PA2"),
        (6, "ISINK1", 1, "PA6"), (7, "UHSIF_PORT33", 1, "PC1"), (8, "DVP_D5", 1, "PB6"), (9, "MCO", 1, "PA8"), (10, "I2S3_CK", 0, "PC7"),
    ]
    f = spark.createDataFrame([(i, "a", s, v, p) for i, s, v, p in rows], "id int, series string, signal string, value int, pad string")
    stated = spark.createDataFrame([("a", "TIM4_CH1", 1, "PD12", "TIM1"), ("a", "USART4_TX", 1, "PB0", "USART1"), ("a", "I2S3_WS", 1, "PA4", "SPI3"), ("a", "DVP_D5", 1, "PB6", "ETH")], "series string, signal string, value int, pad string, key string")
    grid = spark.createDataFrame([("a", "PA2", 1, "TIM1"), ("a", "PA2", 1, "ADC1_ETRGREG"), ("a", "PA6", 1, "TIM1"), ("a", "PA8", 1, "TIM1"), ("a", "PC7", 0, "TIM4")], "series string, pad string, value int, key string")
    got = {r["id"]: (r["key"], r["method"]) for r in selectors.resolve(f, fields, stated, [("grid", grid)]).collect()}
    # the name refutes what is stated of TIM4 and USART4; I2S3 shares a field; ADC goes by the pad; ISINK1 by its name; MCO by an unchecked pad
    assert got == {1: ("TIM1", "peripheral"), 2: ("TIM4", "peripheral"), 4: ("SPI3", "signal"), 5: ("ADC1_ETRGREG", "grid"), 6: ("ISINK1_ADJ", "prefix"), 7: ("UHSIF_PORT", "prefix"), 9: ("TIM1", "grid")}


BAD_RECORD = {
    "id": "x1", "file": "x2.json", "identity": {"part_number": "X9"}, "sources": [{"id": "s"}, {"id": "s"}], "named": ["s", "t"],
    "coverage": {"package_pins": "complete", "pin_functions": "complete"}, "package": {"pin_count": 2, "exposed_pad_count": 1, "gpio_count": 2, "special_io_counts": [{"kind": "a"}, {"kind": "a"}]},
    "memory": {"regions": [{"id": "m", "subset_of": None}, {"id": "m", "subset_of": "q"}]}, "integrated_components": [{"id": "c"}, {"id": "c"}],
    "route_selectors": [
        {"id": "a", "controller": "k", "register": "R", "field": "A", "bits": [{"register": "R", "bit": 0}, {"register": "R", "bit": 1}], "valid_values": [0, 1], "reset_value": 2},
        {"id": "a", "controller": "k", "register": "R", "field": "A", "bits": [{"register": "R", "bit": 1}], "valid_values": [0, 2], "reset_value": 0},
        {"id": "b", "controller": "k", "register": "R", "field": "B", "bits": [{"register": "R", "bit": 32}], "valid_values": [0], "reset_value": 0},
        {"id": "c", "controller": "k", "register": "Q", "field": "C", "bits": [{"register": "R", "bit": 5}, {"register": "R", "bit": 5}], "valid_values": [0], "reset_value": 0},
        {"id": "d", "controller": "k", "register": "Q", "field": "D", "bits": [{"register": "R", "bit": 6}], "valid_values": [0], "reset_value": 0},
    ],
    "pins": [
        {"number": "1", "kind": "gpio", "functions": [{"signal": "s", "peripheral": None, "route": None, "conditions": None, "selection": {"selector": "d", "values": [1, 1]}}, {"signal": "s", "peripheral": None, "route": None, "conditions": None, "selection": None}]},
        {"number": "1", "kind": "power", "functions": [{"signal": "t", "peripheral": None, "route": None, "conditions": None, "selection": {"selector": "z", "values": [0]}}, {"signal": "u", "peripheral": None, "route": None, "conditions": None, "selection": {"selector": "d", "values": []}}, {"signal": "w", "peripheral": None, "route": None, "conditions": None, "selection": {"selector": "d", "values": [2]}}]},
        {"number": "EP1", "kind": "power", "functions": []},
    ],
}
RECORD = """id string, file string, identity struct<part_number: string>, sources array<struct<id: string>>, named array<string>, coverage struct<package_pins: string, pin_functions: string>,
package struct<pin_count: int, exposed_pad_count: int, gpio_count: int, special_io_counts: array<struct<kind: string>>>, memory struct<regions: array<struct<id: string, subset_of: string>>>, integrated_components array<struct<id: string>>,
route_selectors array<struct<id: string, controller: string, register: string, field: string, bits: array<struct<register: string, bit: int>>, valid_values: array<int>, reset_value: int>>,
pins array<struct<number: string, kind: string, functions: array<struct<signal: string, peripheral: string, route: string, conditions: string, selection: struct<selector: string, values: array<int>>>>>>"""


def test_record_rules_on_bad_and_good_records(spark):
    from attestor.operators import records

    rules_ = records.identity("file") | records.sources("named") | records.completeness() | records.selector_rules() | records.pin_rules() | records.part_rules()
    good = {
        "id": "x2", "file": "x2.json", "identity": {"part_number": "X2"}, "sources": [{"id": "s"}], "named": ["s"], "coverage": {"package_pins": "complete", "pin_functions": None},
        "package": {"pin_count": 1, "exposed_pad_count": 1, "gpio_count": 1, "special_io_counts": []}, "memory": {"regions": [{"id": "m", "subset_of": None}, {"id": "n", "subset_of": "m"}]}, "integrated_components": [],
        "route_selectors": [BAD_RECORD["route_selectors"][0] | {"reset_value": 1}], "pins": [{"number": "1", "kind": "gpio", "functions": [{"signal": "s", "peripheral": None, "route": None, "conditions": None, "selection": {"selector": "a", "values": [1]}}]}, {"number": "EP1", "kind": "power", "functions": []}],
    }
    partial = {"id": "x3", "file": "x3.json"}
    df = spark.createDataFrame([json.dumps(r) for r in (BAD_RECORD, good, partial)], "string").select(F.from_json("value", RECORD).alias("r")).select("r.*")
    got = {}
    for r in records.violations(df, "id", rules_).collect():
        got.setdefault(r["key"], {}).setdefault(r["rule"], set()).add(r["detail"])
    assert "x2" not in got and got["x3"] == {"selectors is an array": {"missing"}}
    assert got["x1"] == {
        "id is the file's name": {"x1 <> x2"}, "part number is the id": {"X9 <> x2"}, "source ids are unique": {"repeated"}, "evidence has a known source": {"t"},
        "complete pins": {"numbers not 1 to pin_count", "gpio count"}, "selector ids are unique": {"missing or repeated"}, "selector fields are unique": {"k|R|A"}, "selector bits are valid": {"b"},
        "selector bits don't repeat": {"c"}, "register is the bits' registers": {"d"}, "selector values are valid": {"a"}, "reset value is valid": {"a"}, "selectors don't overlap": {"a"},
        "pin numbers are unique": {"repeated"}, "functions of a pin are unique": {"1"}, "selection has a known selector": {"1:z"}, "selected values are stated": {"1:d"}, "selected values are unique": {"1:d"},
        "selected values fit the width": {"1:d"}, "selected values are not reserved": {"1:d"}, "memory regions are unique": {"repeated"}, "parent region is known": {"q"}, "special I/O kinds are unique": {"repeated"}, "components are unique": {"repeated"},
    }


def test_contained_passages(spark):
    df = spark.createDataFrame([(1, "xone two three four five six seven eight nine ten eleven-y"), (2, "one two three"), (3, "a b"), (4, None), (5, ""), (6, "zz a b")], "k int, t string")
    known = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven"), (2, "one two three"), (3, "a b"), (4, ""), (5, None), (6, "two three four five six seven eight nine ten twelve")], "i int, p string")
    got = {tuple(r) for r in diff.contained_passages(df, "k", "t", known, "i", "p").collect()}
    assert got == {(1, 1), (1, 2), (2, 2), (3, 3), (6, 3)}
    assert diff.contained_passages(df, "k", "t", known.limit(0), "i", "p").count() == 0


def test_contained_passages_by_brute_force(spark, monkeypatch):
    import random

    rnd = random.Random(4)
    text = lambda n: "".join(rnd.choice("ab ñ") for _ in range(n))
    docs = [(i, text(rnd.choice([0, 3, 17, 400]))) for i in range(120)] + [(500, " " * 300), (501, "x" + "ab" * 9000 + "y"), (502, None)]
    known = [(i, text(rnd.choice([1, 2, 5, 8, 9, 15, 16, 17, 40]))) for i in range(90)] + [(900 + i, t[a : a + n]) for i, (a, n) in enumerate([(0, 17), (3, 64), (11, 300)] * 12) for t in [docs[i][1]] if t[a : a + n]]
    known += [(990 + n, " " * n) for n in range(14, 20)] + [(999, "b" * 3), (999, "b" * 3), (1000, "x" + "ab" * 9000 + "y"), (1001, "ab" * 9001)]
    monkeypatch.setattr(diff, "PORTION", 4096)
    monkeypatch.setattr(diff, "AT_ONCE", 50)
    df, passages = spark.createDataFrame(docs, "k int, t string").repartition(3), spark.createDataFrame(known, "i int, p string")
    got = sorted(tuple(r) for r in diff.contained_passages(df, "k", "t", passages, "i", "p").collect())
    assert got == sorted((k, i) for k, t in docs for i, p in known if t and p in t)
    monkeypatch.setattr(diff, "BLOCK", 7)
    many = diff.Passages(sorted({p.encode() for _, p in known}))
    rows = [t.encode() for _, t in docs[:60] if t is not None]
    buf, offs = np.frombuffer(b"".join(rows), np.uint8), np.cumsum([0, *map(len, rows)])
    assert many.within(buf, offs) == [(r, n) for r, t in enumerate(rows) for n, p in enumerate(many.passages) if p in t]


def test_novelty_scan_counts_as_its_sql_on_odd_rows(spark, tmp_path):
    import duckdb

    from attestor.plans.catalogue import ORACLE_SQL, QUERIES

    docs = [(1, "some words of a known passage here"), (1, "a known passage"), (2, ""), (3, None), (None, "a known passage"), (4, "nothing")]
    spark.createDataFrame(docs, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(10, "a known passage"), (10, "a known passage"), (9, ""), (None, "nothing"), (8, None), (7, "words")], "item_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    got = QUERIES["novelty_scan"](spark, f"file://{tmp_path}").select("doc_id", "known", "items").collect()
    assert sorted(map(tuple, got), key=str) == sorted(con.sql(ORACLE_SQL["novelty_scan"]).fetchall(), key=str)


def test_guards(spark, tmp_path):
    import pytest

    df = spark.createDataFrame([(1, "a"), (9, "b")], "k int, v string")
    with pytest.raises(ValueError):
        tables.required_columns(df, ["k", "data"])
    with pytest.raises(Exception, match="missing"):
        resolve.required(df, "k", spark.createDataFrame([(1, "x")], "t int, n string"), "t", "n").collect()
    df.write.parquet(f"{tmp_path}/one.parquet")
    tables.register_views(spark, f"file://{tmp_path}", ["one"])
    assert spark.sql("select sum(k) as s from one").first()["s"] == 10
    assert carry.continued(spark.createDataFrame([(1, 1, 3, False), (1, 2, 3, True), (1, 3, 3, False)], "g int, p int, w int, h boolean"), ["g"], "p", "w", F.col("h")).agg(F.max("table")).first()[0] == 2


SCHEMAS = {
    "families": "family", "series": "series family", "products": "part_number family sram_bytes flash_bytes", "pins": "part_number pad", "pin_functions": "part_number pad signal route", "product_attributes": "part_number attribute label_zh",
    "remap_fields": "series selector register field bits valid_values reset_value", "remap_routes": "series selector value signal pad peripheral role", "clock_prescalers": "family field divider value", "clock_sources": "family consumer value shift condition",
    "clock_configs": "family config hpre ppre1 ppre2 domains flash_latency flash_sck_div pll outside_rcc condition", "clock_symbols": "family symbol role value address register", "clock_init": "family function step action value register address source condition",
    "systick": "family block register offset width_bits write_bits address", "pin_alternate": "family pad register bits width_bits address", "memory_configs": "part_number value code_bytes sram_bytes datasheet_value option_byte_bits obr_bits", "evt_variants": "family macro part_number",
}
GOOD = {
    "families": [("F",)], "series": [("S", "F")], "products": [("P", "F", "100", "200")], "pins": [("P", "PA1"), ("P", "PA2")], "pin_functions": [("P", "PA1", "X", "af-1"), ("P", "PA2", "Y", "main")], "product_attributes": [("P", "a", "标签")],
    "remap_fields": [("S", "tim1", "R", "TIM1_RM", "R:0;R:1", "0;1;3", "0"), ("S", "tim3", "R|Q", "TIM3_RM", "R:5;Q:1", "0;2", ""), ("S", "spi3", "R", "SPI3_RM", "R:9", "0;1", "0")],
    "remap_routes": [("S", "tim1", "1", "T1C1", "PA1", "TIM1", "CH1"), ("S", "spi3", "1", "I2S3_WS", "PA2", "I2S3", "WS"), ("S", "tim3", "0", "odd", "PA2", "", "")],
    "clock_prescalers": [("F", "HPRE", "2", "8")], "clock_sources": [("F", "c", "1", "0", "")], "clock_configs": [("F", "k", "2", "", "", "HCLK=48000000;PCLK=1", "1", "", "PLL RCC_PLL", "", "MAC_A"), ("F", "l", "", "", "", "", "", "4", "", "", "")],
    "clock_symbols": [("F", "RCC_PLL", "mask", "3", "0x40021004", "RCC->CFGR0"), ("F", "RCC_HPRE_Div2", "value", "8", "", "RCC->CFGR0")],
    "clock_init": [("F", "init", "3", "set", "1", "RCC->CTLR", "0x40021000", "", "RCC_PLL set"), ("F", "init", "4", "trim", "1", "", "", "x", "")],
    "systick": [("F", "b", "CTLR", "0x0", "32", "32", "0xe000f000"), ("F", "b", "CNT", "0x8", "64", "32", "")], "pin_alternate": [("F", "PA1", "AFLR", "AFLR:0;AFLR:1", "2", "0x40010000")],
    "memory_configs": [("P", "00x", "200", "100", "yes", "[7:6]", ""), ("P", "01x", "300", "50", "", "", "")], "evt_variants": [("F", "MAC_A", "P")],
}
BAD = {
    "series": [("S2", "none")], "pin_functions": [("P", "PA9", "X", "af-1"), ("Q", "PA1", "X", "main")], "product_attributes": [("P", "通信", "")],
    "remap_fields": [("S", "b1", "R", "A_RM", "", "0", ""), ("S", "b2", "R", "B_RM", "R:40", "0", ""), ("S", "b3", "R", "C_RM", "R:3;R:3", "0;9", "1"), ("S", "b4", "Z", "D_RM", "R:4", "", ""), ("S", "tim4", "R", "TIM4_RM", "R:7", "0;1", "")],
    "remap_routes": [("S", "nope", "1", "x", "PA1", "", ""), ("S", "tim1", "2", "x", "PA1", "TIM1", ""), ("S", "tim3", "0", "TIM4_CH1", "PA1", "TIM4", "CH1"), ("S", "tim3", "2", "TIM9_CH1", "PA1", "TIM9", "CH1")],
    "clock_prescalers": [("F", "ADC", "0", "1")], "clock_sources": [("F", "d", "x", "0", "MAC_B")], "clock_configs": [("F", "m", "7", "", "", "HCLK", "w", "6", "PLL RCC_NO", "", "")], "clock_symbols": [("F", "RCC_hpre_div2", "odd", "9", "0x4", "CFGR0")],
    "clock_init": [("F", "two", "1", "set", "1", "CTLR", "0x1", "y", "RCC_HSIRDY"), ("F", "two", "3", "jump", "1", "", "", "", ""), ("F", "three", "x", "set", "1", "", "", "", "")],
    "systick": [("F", "b", "CMP", "0x4", "48", "32", "0xe000f002"), ("F", "c", "Z", "q", "1", "1", ""), ("F", "b", "OVER", "0x6", "32", "32", "0xE")], "pin_alternate": [("F", "PA2-X", "AFLR", "AFLR:1;OTHER:2", "3", "0x40010001")],
    "memory_configs": [("P2", "1x0", "0", "5", "", "[7:7]", "7"), ("P2", "110", "1", "1", "", "", ""), ("P3", "2", "1", "7", "yes", "", "")], "products": [("P2", "F", "1", "1"), ("P3", "F", "8", "1")], "evt_variants": [("F", "MAC_Z", "none")],
}


def _tables(spark, *parts):
    out = {}
    for name, columns in SCHEMAS.items():
        out[name] = spark.createDataFrame([r for p in parts for r in p.get(name, [])], ", ".join(f"`{c}` string" for c in columns.split()))
    return out


def test_checker_on_good_and_bad_tables(spark):
    from attestor.operators import checker

    args = (r"\b(?:RCC|FLASH)_[A-Za-z0-9_]+", r"\bMAC_[A-Z]\b")
    assert checker.check(_tables(spark, GOOD), *args).collect() == []
    got = {}
    for r in checker.check(_tables(spark, GOOD, BAD), *args).collect():
        got.setdefault(r["rule"], set()).add(r["key"])
    expected = {
        "series.family": {"none"}, "pin_functions.part_number": {"Q"}, "evt_variants.part_number": {"none"}, "product_attributes: no CJK in data": {"P 通信"},
        "remap_fields: bits are there": {"S b1"}, "remap_fields: bits are register:bit": {"S b2"}, "remap_fields: bits don't repeat": {"S b3"}, "remap_fields: register is the bits' registers": {"S b4"}, "remap_fields: values are there": {"S b4"},
        "remap_fields: values fit the width": {"S b3"}, "remap_fields: reset value is a value": {"S b3"}, "remap_routes: peripheral and role go together": {"S tim1 2"}, "remap_routes: selector is there": {"S nope 1"}, "remap_routes: value is a value": {"S tim1 2"},
        "remap_routes: selector is the peripheral's": {"S tim3 0", "S tim3 2"}, "clock_prescalers: divider is one": {"F ADC"}, "clock_sources: value and shift are numbers": {"F d"}, "clock_configs: domains are name=hertz": {"F m"},
        "clock_configs: latency is a number": {"F m"}, "clock_configs: flash divider is a power of two": {"F m"}, "clock_configs: latency or divider, not both": {"F m"}, "clock_configs: divider is known": {"F m"}, "clock_configs: symbol is there": {"F m"},
        "clock_symbols: role is known": {"F RCC_hpre_div2"}, "clock_symbols: address has its shape": {"F RCC_hpre_div2"}, "clock_symbols: register is block->register": {"F RCC_hpre_div2"}, "clock_symbols: value is the prescaler's": {"F RCC_hpre_div2"},
        "clock_init: action is known": {"F two 3"}, "clock_init: value and step are numbers": {"F three x"}, "clock_init: register is block->register": {"F two 1"}, "clock_init: address has its shape": {"F two 1"}, "clock_init: only a trim has a source": {"F two 1"},
        "clock_init: symbol of a condition is there": {"F two"}, "clock_init: steps are dense": {"F two"}, "conditions: macro is known": {"clock_sources F"}, "systick: offset and widths are numbers": {"F c Z"}, "systick: write width divides the width": {"F b CMP"},
        "systick: address is aligned": {"F b CMP"}, "systick: address has its shape": {"F b OVER"}, "systick: registers don't overlap": {"F b OVER", "F b CNT"}, "pin_alternate: pad has its shape": {"F PA2-X"}, "pin_alternate: bits are as many as the width": {"F PA2-X"},
        "pin_alternate: bits are of the register": {"F PA2-X"}, "pin_alternate: address is aligned and has its shape": {"F PA2-X"}, "pin_alternate: bits don't overlap": {"F AFLR"}, "pin_functions: alternate function is written somewhere": {"P PA9"}, "pin_functions: pad is a pin": {"P PA9", "Q PA1"},
        "memory_configs: code is of 0, 1 and x": {"P3 2"}, "memory_configs: sizes are above 0": {"P2 1x0"}, "memory_configs: one row is quoted": {"P2"}, "memory_configs: quoted RAM is the product's": {"P3"}, "memory_configs: codes are disjoint": {"P2"},
        "memory_configs: span is [hi:lo]": {"P2"}, "memory_configs: span is wide enough": {"P2"},
    }
    assert got == expected


def test_context_windows(spark):
    from attestor.operators import report

    df = spark.createDataFrame([("d", s, s + 2) for s in (0, 5, 9, 12, 30, 33)] + [("e", 7, 8)], "d string, s int, e int")
    got = sorted(tuple(r) for r in report.context_windows(df, ["d"], "s", "e", 10).collect())
    assert got == [("d", 0, 2), ("d", 12, 14), ("d", 30, 32), ("e", 7, 8)]


def test_streams_of_windows_and_firsts(spark, tmp_path):
    rows = [("2024-01-01 00:00:00", "a"), ("2024-01-01 00:10:00", "a"), ("2024-01-01 02:00:00", "a"), ("2024-01-01 00:20:00", "b"), ("2024-01-02 00:00:00", "z")]
    spark.createDataFrame(rows, "t string, u string").select(F.to_timestamp("t").alias("t"), "u").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("t timestamp, u string").parquet(f"{tmp_path}/in")
    counted, first = [], []
    snapshots.each_batch(snapshots.windowed_counts(stream, "t", "u"), lambda df, n: counted.extend(df.collect()), f"{tmp_path}/c1").awaitTermination(120)
    assert sorted((r["u"], r["events"]) for r in counted if r["u"] != "z") == [("a", 1), ("a", 2), ("b", 1)]
    snapshots.each_batch(snapshots.first_of_each(stream, "t", ["u"]), lambda df, n: first.extend(df.collect()), f"{tmp_path}/c2").awaitTermination(120)
    assert sorted(r["u"] for r in first) == ["a", "b", "z"]
