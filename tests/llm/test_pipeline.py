"""The corpus pipeline against brute force."""

import re
from collections import defaultdict

import pytest

pytest.importorskip("linkloom.llm")
import corpus_pipeline  # noqa: E402

from linkloom.llm import decontaminate, queries, simhash  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_keep_what_they_should(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "exact", "near", "benchmark", "pack"]
    extra = spark.createDataFrame([(900_001, None), (900_002, "123 !"), (900_003, "Это текст на языке")], "doc_id long, text string")
    extra = extra.selectExpr("doc_id", "text", "if(doc_id = 900003, null, 'en') lang", "'s' source", "0L n_chars").select(columns)

    def step(name, df):
        out = stages[name](spark, df, SF)
        out.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    kept = step("language", docs.union(extra))
    assert kept.columns == columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()}

    rows = {r.doc_id: r.text for r in kept.collect()}
    groups = defaultdict(list)
    for i, t in rows.items():
        groups[re.sub(r"[\x20\x09-\x0d]", "", t)].append((-len(t), i))
    kept = step("exact", kept)
    assert kept.columns == columns and {r.doc_id for r in kept.collect()} == {min(v)[1] for v in groups.values()}

    prints = {r.doc_id: simhash.fingerprint(r.text) for r in kept.collect()}
    up = {i: i for i in prints}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((root(a), root(b)))
                up[y] = x
    kept = step("near", kept)
    assert kept.columns == columns and {r.doc_id for r in kept.collect()} == {i for i in prints if root(i) == i}

    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        windows |= decontaminate._windows(decontaminate.normalised(r.text), 10)
    clean = {r.doc_id for r in kept.collect()
             if not windows & decontaminate._windows(decontaminate.normalised(r.text), 10)}
    kept = step("benchmark", kept)
    assert kept.columns == columns and {r.doc_id for r in kept.collect()} == clean

    packed = step("pack", kept)
    assert {r.doc_id for r in packed.collect()} == clean
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, whole.collect())) == sorted(
        map(tuple, queries.packing.pack(kept, queries.tokenizer_json()).collect()))
