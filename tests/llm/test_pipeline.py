"""The pipeline against what a plain program says about its stages' rows."""

import re

import corpus_pipeline
from marlstone.llm.queries import QUERIES
from test_near_dedup import brute as near_groups
from test_near_dedup import changed
from test_classifiers import insulted


def test_stages(spark, documents, prose, tmp_path):
    rows = [(i, prose(i, 80)) for i in range(0, 120)]
    rows += [(200 + i, insulted(prose(500 + i, 60), i)) for i in range(60)]
    rows += [(300 + i, re.sub(" ", "\n", prose(1, 80), count=i)) for i in range(5)]
    rows += [(400 + i, changed(prose(2, 80), i, 1)) for i in range(5)]
    rows += [(500, None), (501, ""), (502, "too short"), (503, "again and again it says " * 20), (504, prose(9, 6000))]
    path = str(tmp_path)
    docs = documents(rows, ["score", "kept"])
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(k, 1, int(200 <= k < 300)) for k, _ in rows if k < 300],
                          "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    left = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = spark.read.parquet(f"{path}/{k - 1}" if k else f"{path}/documents.parquet")
        after = stage(spark, before, path)
        after.write.parquet(f"{path}/{k}")
        if name != "packing":
            assert after.columns == docs.columns
        left[name] = [r.doc_id for r in spark.read.parquet(f"{path}/{k}").collect()]
    texts = dict(rows)
    toxic = set(range(200, 260))
    assert len(toxic & set(left["toxicity"])) <= 2 and set(texts) - toxic <= set(left["toxicity"])
    gone = set(left["toxicity"]) - set(left["quality_rules"])
    assert gone == {500, 501, 502, 503}
    norm = {k: " ".join(texts[k].split()) for k in left["quality_rules"]}
    firsts = {n: min(k for k in norm if norm[k] == n) for n in norm.values()}
    assert sorted(left["exact_dedup"]) == sorted(firsts.values())
    groups = near_groups([(k, texts[k]) for k in left["exact_dedup"]], 5, 80)
    assert sorted(left["near_dedup"]) == sorted(k for k, (_, low) in groups.items() if low == k)
    assert set(left["packing"]) == set(left["near_dedup"])
    whole = corpus_pipeline.run(spark, path)
    assert sorted(r.doc_id for r in whole.collect()) == sorted(left["packing"])


def test_every_dealt_operator_is_registered():
    assert sorted({re.match(r"op(\d+)_|pipeline", n)[0] for n in QUERIES}) == sorted(
        ["pipeline", *(f"op{n}_" for n in range(1, 14))])
