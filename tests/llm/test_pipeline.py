"""The pipeline's stages against what brute force says of each stage's own input."""

from test_sets import components, judge, simhash_of
from test_windows import by_bytes

import corpus_pipeline


def test_stages(spark, edge_docs, edge_rows, tmp_path):
    columns = edge_docs.columns
    bench = [(1, next(r[1] for r in edge_rows if r[0] == 45)), (2, "no such words here at all")]
    spark.createDataFrame(bench, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, seen = edge_docs, {}
    for number, (name, work) in enumerate(corpus_pipeline.STAGES):
        work(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{number}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{number}")
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        seen[name] = ([tuple(r)[:5] for r in before.select(*columns).collect()], [tuple(r)[:5] for r in docs.select(*columns).collect()])

    before, after = seen["language"]
    assert sorted(map(repr, after)) == sorted(repr(r) for r in before if any(c.isalpha() for c in r[1] or ""))
    before, after = seen["near_duplicates"]
    assert len(after) == len(set(components([simhash_of(r[1]) for r in before])))
    before, after = seen["repeated_passages"]
    assert sorted(len((r[1] or "").encode()) for r in after) == sorted(n - gone for _, n, gone, *_ in by_bytes(before))
    before, after = seen["benchmark"]
    assert len(after) == sum(not j[-1] for j in judge(before, bench)) < len(before)
    assert 0 < len(seen["mix"][1]) <= len(seen["mix"][0])
    assert docs.where("taken < 1 OR taken > 2 * size").count() == 0


def test_run(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
