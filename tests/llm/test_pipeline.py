"""The pipeline on the whole small table, each stage against a brute-force version on its own input."""

import re
from collections import Counter

import corpus_pipeline as P
from conftest import DATA
from rowloom.llm import components, simhash
from test_decontaminate import brute as hits
from test_secrets import brute as secrets
from test_simhash import expected as groups


def redacted(text):
    out, at = "", 0
    merged = []
    for start, _, end, _ in secrets(text):
        if merged and merged[-1][1] >= start:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    for start, end in merged:
        out, at = out + text[at:start] + "[SECRET]", end
    return out + text[at:]


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    assert [n for n, _ in P.STAGES] == [
        "language ID", "SimHash near-dedup", "benchmark decontamination", "secret scans", "mixing sources"
    ]
    for number, (_, stage) in enumerate(P.STAGES):
        docs = P.staged(stage(spark, docs, DATA), "test")
        rows = docs.collect()
        after = {r.doc_id: r for r in rows}
        if number < 4:
            assert docs.columns == columns and len(after) == len(rows)
        if number == 0:
            assert all(re.search(r"[^\W\d_]", before[i].text) for i in after) and len(after) >= 0.98 * len(before)
        if number == 1:
            assert set(after) == {c for _, c in groups([(i, r.text) for i, r in before.items()]).values()}
        if number == 2:
            assert set(after) == {i for i, r in before.items() if not hits(r.text, items)[3]}
        if number == 3:
            assert {i: r.text for i, r in after.items()} == {i: redacted(r.text) for i, r in before.items()}
            assert all(r.n_chars == len(r.text) for r in rows)
        if number == 4:
            assert docs.columns == [*columns, "epoch", "place"] and set(after) <= set(before)
            assert max(Counter(r.doc_id for r in rows).values()) <= 4
        before = after


def test_run_equals_stages_and_empty(spark, tmp_path):
    P.run(spark, DATA).createOrReplaceTempView("mixed")
    assert spark.sql("SELECT min(place) >= 0 AND max(place) < 1 AS ok FROM mixed").first().ok
    spark.read.parquet(f"{DATA}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{DATA}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []


def _exploded_in_broadcast(plan):
    """Whether a broadcast of the plan (as a tree of lines) takes exploded rows."""
    inside = None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-*()0123456789"))
        if inside is not None and depth <= inside:
            inside = None
        if "BroadcastExchange" in line and inside is None:
            inside = depth
        if "Generate explode" in line and inside is not None:
            return True
    return False


def test_near_dedup_stage_broadcasts_no_exploded_rows(spark, monkeypatch, tmp_path):
    """A small table too: what counts is how the plan would grow, not what Spark takes for its size."""
    plans = []

    def recorded(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return staged(df, label)

    staged = simhash.staged
    for module in (simhash, components):
        monkeypatch.setattr(module, "staged", recorded)
    rows = [(i, f"alpha beta gamma {i % 40} delta epsilon", "en", "web", 30) for i in range(80)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(f"{tmp_path}/docs")
    kept = P.remove_near_duplicates(spark, spark.read.parquet(f"{tmp_path}/docs"), DATA)
    plans.append(kept._jdf.queryExecution().executedPlan().toString())
    assert {r.doc_id for r in kept.collect()} == {c for _, c in groups([(i, t) for i, t, *_ in rows]).values()}
    assert any("Generate explode" in p for p in plans)
    assert not any(_exploded_in_broadcast(p) for p in plans)
