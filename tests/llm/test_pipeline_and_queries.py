import re

import pytest

import corpus_pipeline
from igarape.llm.queries import QUERIES, SQL
from igarape.llm.secret_scan import RULES
from tests.llm.test_packing import check_packed, reference  # noqa: F401
from tests.llm.test_rules_and_lines import kept_lines
from tests.llm.test_secret_scan import brute
from tests.llm.test_simhash import brute_print, brute_roots
from tests.oracle import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, name):
    actual = QUERIES[name](spark, FOLDER).toPandas()
    assert differences(actual, connect(FOLDER).sql(SQL[name]).df()) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_one_row_or_more_for_each_row(spark, name):
    table, key = ("pages", "page_id") if name.startswith("op7") else ("documents", "doc_id")
    rows = spark.read.parquet(f"{FOLDER}/{table}.parquet").select(key)
    found = QUERIES[name](spark, FOLDER).select(key)
    assert not rows.exceptAll(found.distinct()).count() and not found.distinct().exceptAll(rows).count()


def test_every_operator_has_a_query():
    assert sorted({int(n[2:].split("_")[0]) for n in QUERIES}) == list(range(1, 14))


def test_pipeline_equals_brute_force(spark, reference):  # noqa: F811
    from igarape.llm.quality_rules import judge

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = [(r["doc_id"], r["text"]) for r in judge(docs).filter("quality.kept").collect()]
    lines = [(i, text) for i, text, *_ in kept_lines(kept)]
    roots = brute_roots([brute_print(t) for _, t in lines]).tolist()
    first = {}
    for (i, _), root in zip(lines, roots):
        first[root] = min(i, first.get(root, i))
    clean = {}
    for i, text in lines:
        if i in first.values():
            out, done = "", 0
            for a, rule, b in brute(text):
                if a >= done:
                    out += text[done:a] + f"[{RULES[rule].kind}]"
                done = max(done, b)
            clean[i] = [out + text[done:]]
    check_packed(corpus_pipeline.run(spark, FOLDER).collect(), clean, reference)


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "line dedup", "SimHash near-dedup", "secret scans", "packing"]
    clashing = docs.selectExpr("*", "1 AS quality", "2 AS kept", "'a' AS secrets", "3 AS fp", "4 AS id", "5 AS batch")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0)], docs.schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, clashing, FOLDER)
        assert found.columns == clashing.columns and 0 < found.count() <= docs.count()
        assert dict(found.dtypes) == dict(clashing.dtypes)
        assert found.filter("n_chars <> length(text)").count() == 0
        assert stage(spark, odd, FOLDER).count() <= 2
        assert stage(spark, docs.limit(0), FOLDER).count() == 0


def test_no_operator_ends_lineage_locally():
    import glob

    for path in glob.glob("igarape/llm/*.py") + ["corpus_pipeline.py"]:
        text = open(path, encoding="utf-8").read()
        assert not re.search("localCheckpoint|crossJoin|mkdtemp", text), path
