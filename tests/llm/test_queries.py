import pytest

import __spark_entry__ as entry
import corpus_pipeline
from duskwork.llm import decontamination, mixing, ngram_join, queries, token_store, toxicity
from duskwork.llm.frames import release, table
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    problem, count = compare(queries.QUERIES[name](spark, FOLDER), connect(FOLDER), queries.ORACLE[name])
    assert not problem and count


def test_all_operators_are_registered():
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


def test_pipeline_against_its_stages_done_plainly(spark):
    docs = table(spark, FOLDER, "documents")
    model = toxicity.train(docs, table(spark, FOLDER, "labels"))
    kept = [r for r in docs.collect() if model.score(r.text or "") < toxicity.THRESHOLD]
    sets = {r.doc_id: set(ngram_join.shingles(r.text or "").tolist()) for r in kept}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    items = decontamination.Items([(r.item_id, r.text) for r in table(spark, FOLDER, "benchmark").collect()])
    ids = [r.doc_id for r in kept if find(r.doc_id) == r.doc_id and not items.find(r.text or "")]
    left = docs.where(docs.doc_id.isin(ids))
    expected = token_store.read_documents(token_store.write_shards(mixing.mixed(left).select(*docs.columns)))
    got = corpus_pipeline.run(spark, FOLDER)
    assert 0 < len(ids) < len(kept) < docs.count()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    release(spark)
