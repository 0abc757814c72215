"""Every registered corpus query over the given tables, against its SQL where it has one."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tests.llm.helpers import component_ids, docs_of, odd_rows, shingle_set
from tests.test_oracles import TABLES, rows_of
from tidemark.llm import queries
from tidemark.llm.common import table
from tidemark.llm.decontaminate import find_passages
from tidemark.llm.quality import score_quality, train_quality

PYTHON = "BatchEvalPython|ArrowEvalPython|MapInArrow|MapInPandas|FlatMapGroups"


@pytest.fixture(scope="module")
def duck(sf_dir):
    with duckdb.connect() as connection:
        for name in TABLES.split():
            connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
        yield connection


def test_all_are_registered():
    assert [sum(n.startswith(f"op{k}_") for n in contract.queries()) for k in range(1, 14)] == [1] * 13
    assert contract.queries()["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, sf_dir, duck, name):
    result = queries.QUERIES[name](spark, sf_dir)
    got = rows_of(result.columns, [tuple(r) for r in result.collect()])
    cursor = duck.execute(queries.ORACLES[name])
    assert got == rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert got[1]


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_gives_a_row_for_each_row(spark, sf_dir, name):
    read = "pages" if name in ("op1_url_filter", "op7_html_text") else "documents"
    assert queries.QUERIES[name](spark, sf_dir).count() == table(spark, sf_dir, read).count()


def test_components_of_given_documents(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    sets = {i: shingle_set(t) for i, t in docs}
    roots = component_ids(sets)
    got = queries.QUERIES["op2_jaccard_join"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(s), roots[i]) for i, s in sets.items()}


def stages(spark, docs, sf_dir):
    """The pipeline's decisions one by one, the similarity stage by comparing all sets."""
    rows = {r.doc_id: r for r in docs.collect() if r.doc_id is not None}
    model = train_quality(docs, table(spark, sf_dir, "labels"))
    good = {r.doc_id for r in score_quality(docs, model).collect() if r.predicted}
    first = {}
    for i in sorted(good & set(rows)):
        first.setdefault(" ".join((rows[i].text or "").replace("\n", " ").split(" ")), i)
    left = set(first.values())
    roots = component_ids({i: shingle_set(rows[i].text) for i in left})
    left = {i for i in left if roots[i] == i}
    bad = {r.doc_id for r in find_passages(docs, table(spark, sf_dir, "benchmark")).collect()}
    return good, left - bad


def test_pipeline_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    good, left = stages(spark, docs, sf_dir)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == columns, name
        if name == "quality_classifier":
            assert {r.doc_id for r in docs.collect()} == good
    assert sorted(r.doc_id for r in docs.collect()) == sorted(left)


def test_pipeline_mixes_what_is_left(spark, sf_dir):
    _, left = stages(spark, table(spark, sf_dir, "documents"), sf_dir)
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in rows} <= left
    assert len({r.doc_id for r in rows}) > 0.8 * len(left)


def test_stages_take_odd_and_empty_tables(spark, sf_dir):
    for rows in (odd_rows(), []):
        docs = docs_of(spark, rows)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf_dir)
        assert {"doc_id", "source"} <= set(docs.columns)
        assert bool(rows) == bool(docs.count())


def test_the_package_is_optional(tmp_path):
    """Without the corpus folders and the pipeline the other queries are still there."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{root}/tidemark", tmp_path / "tidemark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op1') for n in e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": ""}, capture_output=True, text=True, check=True)
    assert out.stdout.split()[1] == "False" and int(out.stdout.split()[0]) >= 74
