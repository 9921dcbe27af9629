"""The pipeline's stages against brute force, each on what its predecessor kept."""

import re

from pyspark.sql import functions as F

from attestor.llm import substring_dedup
from attestor.llm.pipeline import kept

from .test_operators import SCHEMA, brute_repeats, docs, rows, shingle_set  # noqa: F401


def as_rows(df):
    return [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in df.collect()]


def test_stages(spark, docs):  # noqa: F811
    import corpus_pipeline

    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "exact_dedup", "ngram_jaccard_join", "substring_dedup", "best_fit_packing"]
    known = kept(stages["language_id"](spark, docs, ""), "t1")
    assert known.columns == docs.columns
    before = as_rows(known)
    assert all(any(c.isalpha() for c in t or "") for _, t, *_ in before)
    assert {d for d, t, *_ in as_rows(docs) if t and len(t.split()) > 50} <= {d for d, *_ in before}

    distinct = kept(stages["exact_dedup"](spark, known, ""), "t2")
    groups = {}
    for r in before:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r[1]), []).append((-len(r[1]), r[0] is None, r[0], r))
    assert sorted(as_rows(distinct), key=str) == sorted((min(g, key=lambda x: x[:3])[3] for g in groups.values()), key=str)

    single = kept(stages["ngram_jaccard_join"](spark, distinct, ""), "t3")
    left, gone = as_rows(distinct), set()
    for r in left:
        for s in left:
            a, b = shingle_set(r[1]), shingle_set(s[1])
            if r[0] is not None and s[0] is not None and s[0] < r[0] and a and 100 * len(a & b) >= 80 * len(a | b):
                gone.add(r[0])
    assert sorted(as_rows(single), key=str) == sorted((r for r in left if r[0] not in gone), key=str)

    clean = kept(stages["substring_dedup"](spark, single, ""), "t4")
    expected = [(d, t) for (d, t), r in zip(brute_repeats(as_rows(single), substring_dedup.MIN_WORDS), as_rows(single), strict=True) if t.strip() or t == r[1]]
    got = as_rows(clean)
    assert clean.columns == docs.columns
    assert sorted(((d, t) for d, t, *_ in got), key=str) == sorted(expected, key=str)

    packed = stages["best_fit_packing"](spark, clean, "")
    assert {r["doc_id"] for r in packed.collect()} == {d for d, *_ in got}


def test_run_of_nothing(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, f"file://{tmp_path}").count() == 0
    one = spark.createDataFrame([(7, "just one text that nobody else has", "en", "s", 34)], SCHEMA)
    one.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, f"file://{tmp_path}").select("doc_id", F.col("offset"))
    assert [tuple(r) for r in out.collect()] == [(7, 0)]


def test_one_row_of_each_group_whatever_its_id(spark):
    from attestor.llm.pipeline import one_of_each_group

    base = [[f"w{i}x{k}" for k in range(200)] for i in range(4)]
    near = lambda i, k: " ".join("changed" if n == k else w for n, w in enumerate(base[i]))
    rows = [(1, near(0, 5)), (None, near(0, 9)), (None, near(1, 5)), (None, near(1, 9)), (2, near(2, 5)), (2, near(2, 9)), (1, near(3, 5)), (3, near(0, 70)), (4, None), (None, None), (3, "another text of the same id that is like none")]
    df = kept(spark.createDataFrame(rows, "doc_id long, text string"), "t5")
    got = [tuple(r) for r in one_of_each_group(spark, df, "").collect()]
    stay = {(1, near(0, 5)), (1, near(3, 5)), (4, None), (None, None), rows[-1]}
    assert stay <= set(got) and len(got) == 7 and len(set(got) & set(rows[2:4])) == 1 and len(set(got) & set(rows[4:6])) == 1
