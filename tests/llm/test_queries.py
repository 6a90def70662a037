"""The registered queries against their SQL, and the pipeline against the operators' rules."""

from collections import Counter

import pytest

from meshlark.llm.queries import QUERIES, SQL
from tests.compare import compare
from tests.conftest import DATA


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, name):
    said, _, _ = compare(spark, name, QUERIES[name], SQL[name], DATA)
    assert said.startswith("ok") and "TYPES" not in said, said


def test_one_query_per_operator():
    numbers = Counter(name.split("_")[0] for name in QUERIES if name.startswith("op"))
    assert numbers == Counter({f"op{n}": 1 for n in range(1, 14)})


def test_pages(spark):
    rows = QUERIES["language_of_pages"](spark, DATA).collect()
    marked = [r for r in rows if any(f"/{x}/" in r.url for x in ("de", "en", "es", "fr"))]
    assert marked and sum(f"/{r.language}/" in r.url for r in marked) >= 0.98 * len(marked)


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    now = docs
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        now = stage(spark, now, DATA)
        if number < 4:
            assert now.columns == docs.columns
        if number == 1:
            kept = {r.doc_id for r in now.collect()}
            links = {r.doc_id: r.class_id for r in QUERIES["op1_jaccard_join"](spark, DATA).collect()}
            assert kept == set(links.values())
        if number == 2:
            assert {r.doc_id for r in now.collect()} == kept
            assert not any("@" in r.text and "@mail" in r.text for r in now.collect())
    pieces = now.collect()
    assert {p.doc_id for p in pieces} <= kept <= set(before)
    room = Counter()
    for p in pieces:
        room[p.sequence_id] += p.length
    assert all(n == 2048 or n & (n - 1) == 0 for n in room.values())
