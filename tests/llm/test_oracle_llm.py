"""Every text query with reference SQL gives the same rows as DuckDB, also on odd rows."""

import pytest
from helpers import canon
from helpers_llm import ODD_TEXTS, documents

import __spark_entry__ as entry
from netpulse.llm.oracle import ORACLE_SQL
from netpulse.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
@pytest.mark.parametrize("table", ["/root/testdata/sf0.001", "odd"])
def test_query_matches_reference_sql(spark, duck, tmp_path, name, table):
    if table == "odd":
        table = str(tmp_path)
        texts = ODD_TEXTS + ["a b a b a b a b c d", "The End of the line %%%\nThe End of the line %%%\n\n \nx"] * 2
        documents(spark, texts, ["en", None] * (len(texts) // 2)).coalesce(1).write.parquet(f"{table}/documents.parquet")
        items = [(0, "The quick brown FOX"), (1, None), (2, "a b c"), (3, "word é 中文")]
        spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(f"{table}/benchmark.parquet")
    got = QUERIES[name](spark, table).toPandas()
    glob = "/*.parquet" if table == str(tmp_path) else ""
    for view in ("documents", "benchmark"):
        duck.execute(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM read_parquet('{table}/{view}.parquet{glob}')")
    want = duck.execute(ORACLE_SQL[name]).df()
    assert canon(got) == canon(want)


def test_one_query_per_operator_and_the_pipeline():
    names = entry.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14)) and "pipeline" in names
