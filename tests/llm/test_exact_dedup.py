import hashlib
import re

from pyspark.sql import functions as F

from tests.llm.helpers import docs_of, odd_rows
from tidemark.llm.exact_dedup import DigestIndex, drop_copies, exact_dedup, fresh_index
from tidemark.session import new_folder


def digest(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()


def expected(rows):
    groups = {}
    for i, text, _ in rows:
        groups.setdefault(digest(text), []).append(i)
    out = []
    for i, text, _ in rows:
        ids = [x for x in groups[digest(text)] if x is not None]
        keep = min(ids) if ids else None
        out.append((i, keep, len(groups[digest(text)]), i == keep, digest(text)))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


def test_odd_rows(spark):
    assert got(exact_dedup(docs_of(spark, odd_rows()), fresh_index(spark, 4))) == expected(odd_rows())


def test_empty_table(spark):
    assert exact_dedup(docs_of(spark, []), fresh_index(spark, 4)).count() == 0


def test_index_outlives_a_batch_and_a_session_object(spark):
    path = new_folder(spark, "index")
    exact_dedup(docs_of(spark, [(5, "a b", "s"), (6, "c", "s")]), DigestIndex(spark, path, 4)).count()
    spark.sql(f"DROP TABLE {DigestIndex(spark, path, 4).name}")  # the folder stays
    again = DigestIndex(spark, path, 4)
    rows = {r.doc_id: r for r in exact_dedup(docs_of(spark, [(1, "a  b", "s"), (2, "d", "s")]), again).collect()}
    assert (rows[1].keep_id, rows[1].kept) == (5, False)
    assert (rows[2].keep_id, rows[2].kept) == (2, True)
    assert again.read().count() == 3


def test_index_side_is_neither_shuffled_nor_sorted_in(spark):
    index = fresh_index(spark, 4)
    exact_dedup(docs_of(spark, [(1, "a", "s")]), index).count()
    plan = spark.range(9).select(F.sha2(F.col("id").cast("string"), 256).alias("digest")).hint("merge")
    plan = plan.join(index.read().select("digest"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan


def test_drop_copies_keeps_columns_and_one_row_of_repeats(spark):
    rows = odd_rows()
    docs = docs_of(spark, rows)
    left = drop_copies(docs, fresh_index(spark, 4))
    assert left.columns == docs.columns
    kept = sorted({(r[0], r[4]) for r in expected(rows) if r[3]}, key=repr)
    assert sorted(((r.doc_id, digest(r.text)) for r in left.collect()), key=repr) == kept
