"""The corpus pipeline against a brute-force version on a small table, and the registered queries on their SQL."""

import collections
import re

import corpus_pipeline
from metrolens.llm import toxicity
from metrolens.llm.queries import QUERIES
from metrolens.session import scratch_path
from tests.llm.test_operators import brute_links, syllables


def test_pipeline_equals_brute_force(spark):
    import random

    rng = random.Random(8)
    rows, labels = [], []
    for i in range(90):
        words = syllables(rng, 40).split()
        if i % 6 == 0:
            words[3] = "grobian"
        rows.append([i, " ".join(words), "en", f"s{i % 4}", 0])
        if i % 6 == 0 or i % 2:
            labels.append((i, 1, int(i % 6 == 0)))
    for i in range(90, 120):  # exact copies, near copies, junk
        near = rows[i - 60][1].split()
        if i % 2:
            near[-1] = "other"
        rows.append([i, "  ".join(near), "en", f"s{i % 4}", 0])
    rows += [[120, None, None, None, None], [121, "", "en", "s1", 0]]
    folder = scratch_path(spark, "pipeline-in")
    spark.createDataFrame([tuple(r) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(2).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    left = {r[0]: r for r in rows if toxicity.score_text(r[1] or "", model) < toxicity.THRESHOLD}
    stage = docs
    for (name, fn), _ in zip(corpus_pipeline.STAGES[:3], range(3)):
        path = scratch_path(spark, f"pipeline-test-{name}")
        fn(spark, stage, folder).write.parquet(path)
        stage = spark.read.parquet(path)
        assert stage.columns == docs.columns
        if name == "exact_dedup":
            groups = collections.defaultdict(list)
            for r in left.values():
                groups[re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")].append(r)
            left = {k[0]: k for k in (min(g, key=lambda r: (-len(r[1] or ""), r[0])) for g in groups.values())}
        elif name == "near_dedup":
            group, _ = brute_links({d: r[1] for d, r in left.items()})
            left = {d: r for d, r in left.items() if group[d] == d}
        assert sorted(r.doc_id for r in stage.collect()) == sorted(left), name
    assert not any(d % 6 == 0 for d in left if d < 90)
    words = sum(len((r[1] or "").split()) for r in left.values())
    got = corpus_pipeline.run(spark, folder).toPandas()
    assert set(got.doc_id) <= set(left)
    for _, seq in got.groupby("sequence_id"):
        assert seq.length.sum() == seq.context.iloc[0]
    mixed = corpus_pipeline.mixed(spark, stage, folder)
    assert abs(sum(len((r.text or "").split()) for r in mixed.collect()) - words) <= 4


def test_queries_are_registered():
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES] == sorted(range(1, 11)) or len(QUERIES) == 10
