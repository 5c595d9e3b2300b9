"""The corpus pipeline, stage by stage, against plain versions on its own inputs."""

from collections import defaultdict

import corpus_pipeline
from tessera.llm.common import store
from tests.llm.test_op8 import plain
from tests.llm.test_op10 import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = store(stage(spark, docs, SF), "test-stage")
        seen[name] = (before, docs.collect())
        if name != "packing":
            assert docs.columns == columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language", "near_duplicates", "secrets", "packing"]

    before, after = seen["toxicity"]
    assert all(tuple(before[r["doc_id"]]) == tuple(r) for r in after) and len(after) >= 0.6 * len(before)
    before, after = seen["language"]
    assert {r["doc_id"] for r in after} >= {i for i, r in before.items() if sum(map(str.isalpha, r["text"] or "")) > 20}
    before, after = seen["near_duplicates"]
    groups = brute([(i, r["text"]) for i, r in before.items()])
    assert {r["doc_id"] for r in after} == {c for _, c in groups}
    before, after = seen["secrets"]
    assert {r["doc_id"] for r in after} == set(before) and not any(plain(r["text"]) for r in after)
    assert all(r["text"] == before[r["doc_id"]]["text"] or plain(before[r["doc_id"]]["text"]) for r in after)
    before, after = seen["packing"]
    room = defaultdict(int)
    for r in after:
        room[r["sequence_id"]] += r["length"]
    assert {r["doc_id"] for r in after} == set(before) and max(room.values()) <= 1024

    assert corpus_pipeline.run(spark, SF).count() == len(after)
