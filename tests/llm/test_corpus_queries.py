import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from compare import difference, duck
from courtside.llm.queries import ORACLES, QUERIES

KEYS = {"documents": "doc_id", "labels": "doc_id", "pages": "page_id", "embeddings": "vec_id"}
SF_DIR = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are absent")


def test_all_are_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline"} == set(range(1, 14))
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_its_sql(llm, name):
    assert not difference(llm, duck(SF_DIR), SF_DIR, QUERIES[name], ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"pipeline", "op13_nearest_neighbours"}))
def test_query_gives_a_row_for_every_input_row(llm, name):
    kind = "embeddings" if name.startswith("op6") else "documents"
    found, given = QUERIES[name](llm, SF_DIR), llm.read.parquet(f"{SF_DIR}/{kind}.parquet")
    key = given.columns[0]
    assert sorted(r[0] for r in found.select(key).collect()) == sorted(r[0] for r in given.select(key).collect())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_no_rows(llm, tmp_path, name):
    for kind in ("documents", "labels", "pages", "embeddings"):
        llm.read.parquet(f"{SF_DIR}/{kind}.parquet").limit(0).write.parquet(f"{tmp_path}/{kind}.parquet")
    assert QUERIES[name](llm, str(tmp_path)).collect() == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"pipeline"}))
def test_clashing_and_dotted_columns_change_nothing(llm, tmp_path, name):
    extra = "file row place start slot block source_key seq part rep rank n doc h key component a ids mark tree leaf size".split()
    for kind in ("documents", "labels", "pages", "embeddings"):
        df = llm.read.parquet(f"{SF_DIR}/{kind}.parquet").orderBy(F.col(KEYS[kind])).limit(60)
        df.write.parquet(f"{tmp_path}/plain/{kind}.parquet")
        df.selectExpr("*", *(f"'x' as {c}" for c in extra if c not in df.columns), "1 as `a.b`").write.parquet(f"{tmp_path}/more/{kind}.parquet")
    found = [sorted(map(str, QUERIES[name](llm, f"{tmp_path}/{k}").collect())) for k in ("plain", "more")]
    assert found[0] == found[1]
