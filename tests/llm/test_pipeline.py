import os
import re
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wearline.catalogue.compare import difference, duck
from wearline.llm.queries import PLAIN, ready

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="sample tables are absent")


def test_stages_filter_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        sizes.append(docs.count())
        if name != "bpe_tokens":
            assert docs.columns == columns
    assert sizes[-1] == sizes[-2] == sizes[-3] and sizes == sorted(sizes, reverse=True)
    assert corpus_pipeline.run(spark, SF).count() == sizes[-1]


def test_stages_take_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (2, "one two", "en", None, None),
                                 (2, "one two", "en", None, None)], schema)
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, SF).count() <= 4


@pytest.mark.parametrize("name", [n for n, (_, sql) in PLAIN.items() if sql])
def test_query_matches_sql(spark, name):
    assert difference(PLAIN[name][0](ready(spark), SF), duck(SF), PLAIN[name][1]) is None


def test_rest_imports_without_this_package(tmp_path):
    for name in ("wearline", "__spark_entry__.py"):
        subprocess.run(["cp", "-r", f"{ROOT}/{name}", str(tmp_path)], check=True)
    os.rename(f"{tmp_path}/wearline/llm", f"{tmp_path}/taken_out")
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), [q for q in e.queries() if "
                           "q.startswith('op') or q == 'pipeline'])"], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert re.fullmatch(r"\d\d \[\]\n", said.stdout)
