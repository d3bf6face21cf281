import importlib
import sys

import duckdb
import pytest

from loomline.plans.catalogue import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def rows(got):
    return sorted(repr(tuple(float(f"{x:.9g}") if isinstance(x, float) or type(x).__name__ == "Decimal" else x for x in r)) for r in got)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("events", "documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.select(*names).collect()) == rows(result.fetchall())


@pytest.mark.parametrize("name", ["clean_corpus", "gate_issues", "gate_pairs", "gate_reasons", "gate_report"])
def test_gate_queries_scan_and_hash_texts_once(spark, name):
    df = QUERIES[name](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert (plan.count("FileScan"), plan.count("sha2("), plan.count("regexp_replace(")) == (1, 1, 1)


def test_entry_without_the_training_data_subpackage(spark, monkeypatch):
    for name in [n for n in sys.modules if n.startswith("loomline.llm") or n in ("corpus_pipeline", "__spark_entry__")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "loomline.llm", None)
    entry = importlib.import_module("__spark_entry__")
    assert set(entry.queries()) == set(QUERIES) and set(entry.oracle_sql()) == set(SQL)
    assert entry.entry(spark).count() > 0
    monkeypatch.delitem(sys.modules, "__spark_entry__")


def test_segment_clean_applies_nfkc(spark, tmp_path):
    import unicodedata

    from loomline.plans import catalogue

    texts = ["the e\ufb03cient \ufb01le", "\uff21\uff22\uff23 wide", "no\u00a0break", "plain words", "caf\u00e9 stays"]
    save = lambda name, values: spark.createDataFrame([(k, v, "en", "web", len(v)) for k, v in enumerate(values)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/{name}/documents.parquet")
    save("raw", texts)
    save("normal", [unicodedata.normalize("NFKC", v) for v in texts])
    raw, normal = ({r.doc_id: r.cleaned for r in catalogue.segment_clean(spark, f"{tmp_path}/{d}").collect()} for d in ("raw", "normal"))
    assert raw == normal and raw[0].startswith("the efficient file") and raw[1].startswith("ABC wide")
