"""The pipeline's stages on a small fixture against plain versions."""

import collections
import random

from tests.llm import test_ops as plain

import corpus_pipeline


def test_pipeline(spark, tmp_path):
    rng = random.Random(12)
    item = plain.sentence(rng, 40)
    rows = plain.corpus(3) + [(700 + i, plain.sentence(rng, 70) + " " + item + " " + plain.sentence(rng, 70), "en", "a", 1) for i in range(5)]
    spark.createDataFrame(rows, plain.DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "MinHash near-dedup", "benchmark decontamination", "mixing sources to target weights", "sharding"]
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append([tuple(r) for r in docs.collect()])
    judged = {i: r for i, r in enumerate(rows)}
    kept = []
    for r in judged.values():
        m = plain.repetition.measure([r[1] or ""])
        words = int(m["n_words"][0])
        bad = words < 50 or 100 * int(m["n_repeat_words"][0]) > 50 * words or any(100 * int(m[f"dup_chars_{n}"][0]) > most * int(m["word_chars"][0]) for n, most in plain.repetition.GRAM_LIMITS.items())
        if not bad:
            kept.append(r)
    assert collections.Counter(seen[0]) == collections.Counter(kept)
    assert collections.Counter(r[0] for r in seen[1]) == plain.classes(kept, heads=True)
    clean = [r for r in seen[1] if not ((c := plain.contained(r[1], item)) and 10 * c[1] >= 8 * c[0])]
    assert collections.Counter(seen[2]) == collections.Counter(clean) and len(clean) < len(seen[1])
    want = collections.Counter()
    for (d, size, _, taken), n in plain.fair_queue(seen[2]).items():
        want[d] += n * (taken // size if size else 0)
    assert collections.Counter(r[0] for r in seen[3]) == +want
    assert sorted(str(r[0]) for r in seen[4]) == sorted(str(r[0]) for r in seen[3])
    run = corpus_pipeline.run(spark, str(tmp_path))
    assert collections.Counter(map(tuple, run.collect())) == collections.Counter(seen[4])


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], plain.DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
