"""The pipeline stage by stage, and the registered SQL."""

from collections import Counter

import pytest

import corpus_pipeline
from occflow.llm import queries, simhash
from occflow.llm.common import table, workspace
from verification.compare import connect


def test_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    names = docs.columns
    stage, before = workspace(spark), docs
    for name, step in corpus_pipeline.STAGES:
        after = stage.table(step(spark, before, sf_dir), name)
        if name != "bpe":
            assert after.columns == names
        if name == "language_id":
            assert after.count() >= 0.97 * before.count()
        if name == "line_windows":
            assert after.count() == before.count()
        if name == "simhash":
            groups = simhash.near_duplicates(before, workspace(spark)).select("component_id").distinct()
            assert Counter(r["doc_id"] for r in after.collect()) == Counter(r["component_id"] for r in groups.collect())
        before = after
    assert Counter(map(tuple, before.collect())) == Counter(map(tuple, corpus_pipeline.run(spark, sf_dir).collect()))


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, name):
    sf_dir = "/root/testdata/sf0.01"
    df = queries.QUERIES[name](spark, sf_dir)
    names = sorted(df.columns)
    cursor = connect(sf_dir).execute(queries.ORACLE[name])
    columns = [d[0] for d in cursor.description]
    theirs = Counter(tuple(r[columns.index(n)] for n in names) for r in cursor.fetchall())
    assert Counter(tuple(r) for r in df.select(*names).collect()) == theirs
