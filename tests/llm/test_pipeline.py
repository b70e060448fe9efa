from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from cardwarden.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"


def test_stages_take_effect_one_after_the_other(spark, tmp_path, prose):
    item = prose(30, 900)
    docs = [(k, prose(80, k)) for k in range(1, 41)]
    docs += [(50, prose(80, 1).upper()), (51, prose(79, 2)), (52, prose(20, 901) + " " + item), (53, "such scum and idiots " + prose(10, 3)), (54, None), (55, ""), (None, prose(80, 4))]
    docs += [(100 + k, f"scum and idiots are here {k} " + prose(10, k)) for k in range(40)]
    spark.createDataFrame([(i, t, "en", "s", 0, "extra") for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long, row string").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, int(i >= 100 or i == 53)) for i, _ in docs if i is not None]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    # 50 stays for 1 and 4 for the row without id; 2 for 51, which lacks a word; 55 for 54
    assert got == sorted({*range(2, 41), 50, 55})


def test_empty_documents(spark, tmp_path):
    for name, schema in (("documents", "doc_id long, text string, lang string, source string, n_chars long"), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_operator_is_registered():
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES} == set(range(1, 14))
    assert "pipeline" in entry.queries() and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    from checks.compare import differences, duckdb_views

    assert differences(QUERIES[name](spark, SMALL), duckdb_views(SMALL), ORACLE[name]) == ""
