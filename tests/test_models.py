"""A model is fitted once for the same rows and settings, and loaded afterwards."""

import os
import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators import indexing, models, recommend


@pytest.fixture
def fits(monkeypatch):
    """How often a model has been fitted."""
    calls, real = [], recommend.fit_als

    def counted(*args, **kwargs):
        calls.append(args[5] if len(args) > 5 else kwargs.get("blocks"))
        return real(*args, **kwargs)

    monkeypatch.setattr(recommend, "fit_als", counted)
    return calls


@pytest.fixture(scope="module")
def train(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("train") / "rows")
    spark.range(3_000).selectExpr(
        "cast(id * 7919 % 60 as int) user_index", "cast(id * 104729 % 90 as int) item_index",
        "cast(0.5 + id * 31 % 10 / 2.0 as float) rating", "id",
    ).dropDuplicates(["user_index", "item_index"]).write.parquet(path)
    return spark.read.parquet(path)


def scores(model, rows):
    return {(r.user_index, r.item_index): r.prediction for r in model.transform(rows).collect()}


def test_second_use_loads(spark, tmp_path, train, fits):
    path = str(tmp_path / "models")
    first = scores(models.stored_als(train, path, iters=3), train)
    again = scores(models.stored_als(train.repartition(5, "id"), path, iters=3), train)
    assert len(fits) == 1 and first == again and len(first) == train.count()
    assert [d.startswith("als-") for d in os.listdir(path) if not d.startswith(".")] == [True]


def test_other_rows_or_settings_are_another_model(spark, tmp_path, train, fits):
    path = str(tmp_path / "models")
    models.stored_als(train, path, iters=1)
    models.stored_als(train.filter("id > 0"), path, iters=1)
    models.stored_als(train.withColumn("rating", F.when(F.col("id") == 5, 5.5).otherwise(F.col("rating")).cast("float")), path, iters=1)
    models.stored_als(train, path, iters=1, seed=7)
    models.stored_als(train, path, iters=1, blocks=2)
    assert fits == [10, 10, 10, 10, 2]
    models.stored_als(train.unionByName(train.limit(1).withColumn("rating", F.lit(None).cast("float"))), path, iters=1)
    assert len(fits) == 5  # rows without a rating are not trained on


def test_a_model_that_was_not_finished_is_not_loaded(spark, tmp_path, train, fits, monkeypatch):
    path = str(tmp_path / "models")
    monkeypatch.setattr(models, "_put_in_place", lambda *args: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        models.stored_als(train, path, iters=1)
    monkeypatch.undo()
    assert models.stored_als(train, path, iters=1).rank == 10


def test_blocks_follow_the_rows():
    assert [recommend.blocks_for(n) for n in (0, 1, 20_000_000, 20_000_001, 10**12)] == [10, 10, 10, 11, 500_000]


def test_scores_of_a_table_are_those_of_the_model(spark, tmp_path, train):
    model = models.stored_als(train, str(tmp_path / "models"), iters=2)
    rows = train.select(F.col("user_index").cast("string").alias("user_id"), F.col("item_index").cast("string").alias("item_id"), "rating")
    users, items = indexing.id_index(rows, "user_id"), indexing.id_index(rows, "item_id")
    named = rows.join(users.select("user_id", F.col("idx").alias("user_index")), "user_id").join(items.select("item_id", F.col("idx").alias("item_index")), "item_id")
    got = models.score(model, rows.unionByName(spark.createDataFrame([("nobody", "1", 1.0)], "user_id string, item_id string, rating float")), users, items)
    expected = {(r.user_id, r.item_id): r.prediction for r in model.transform(named).collect()}
    assert {(r.user_id, r.item_id) for r in got.collect()} == set(expected)
    assert all(abs(r.prediction - expected[r.user_id, r.item_id]) < 1e-4 for r in got.collect())


def test_two_queries_share_a_fit(spark, sf_dir, fits):
    from tidemark.plans.registry import QUERIES

    one = QUERIES["als_rmse"](spark, sf_dir).first()
    before = len(fits)
    two = QUERIES["als_category_profile"](spark, sf_dir).agg(F.sum("als_prediction_count")).first()[0]
    assert before <= 1 and len(fits) == before and one.num_predictions > 0 and two > one.num_predictions


def test_the_queries_number_bare_ratings_in_ten_blocks(spark, sf_dir):
    """Titles and categories join the predictions alone; more blocks than ten only beyond 200 million lines."""
    from tidemark.plans import registry

    predictions = registry._predicted(spark, sf_dir)
    assert not {"title", "categories"} & set(predictions.columns)
    described = registry._described(spark, sf_dir, predictions)
    assert {"title", "categories"} <= set(described.columns) and described.count() == predictions.count() > 0
    assert [recommend.blocks_for(n, registry.BLOCK_LINES) for n in (28_800_000, 172_800_000, 200_000_001)] == [10, 10, 11]


def test_numbering_moves_stored_events_once(spark):
    """Events in buckets of items are counted and numbered there, then in buckets of users; no table is moved again."""
    from tidemark.operators.dedup import dedup_ratings
    from tidemark.session import written_by

    rows = [(u, i, 0.5 + (u * i) % 10 / 2, u + i) for u in range(1, 13) for i in range(1, 30) if u * i % 3]
    rows += [(None, 5, 1.0, 1), (2, None, 2.0, 1), (2, 4, None, 99), (2, 4, 1.0, 3)]
    events = spark.createDataFrame(rows, "user_id long, item_id long, rating double, event_time long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = written_by(events, "events", "item_id")
        latest = dedup_ratings(stored)
        assert "Exchange" not in latest._jdf.queryExecution().executedPlan().toString()
        matrix, users, items = recommend.numbered(latest)
        assert matrix._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(user_id") == 1  # the users
        text = dedup_ratings(events).withColumns({c: F.col(c).cast("string") for c in ("user_id", "item_id")})
        expected = recommend.rating_matrix(text).select(*matrix.columns)
        assert sorted(matrix.collect(), key=str) == sorted(expected.collect(), key=str) and matrix.count() == len(rows) - 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert users.count() == 8 and {r.idx for r in items.collect()} == set(range(items.count()))


def test_known_lines_are_stored_bare_and_once_per_pair(spark, sf_dir):
    """Deduplicated before they are stored: no step that reads them ranks or moves them, or reads times and keys."""
    from tidemark.plans import registry

    lines = registry._known_lines(spark, sf_dir)
    assert set(lines.columns) == {"user_id", "item_id", "rating", "held_out"}
    plan = lines.groupBy("item_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan
    assert lines.count() == lines.dropDuplicates(["user_id", "item_id"]).count() == registry.QUERIES["dedup_ratings"](spark, sf_dir).count()


def test_lines_are_moved_to_their_parts_once(spark, sf_dir):
    from tidemark.plans import registry

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for dedup_pairs in (True, False):
            plan = registry._known(spark, sf_dir, dedup_pairs)._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning(item_id") == 2, plan  # the lines and the parts
            assert plan.count("Exchange") == 4  # and before that lines and orders to their orders
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_profiles_of_sums_are_those_of_predictions(spark):
    """A row per item is all that the profiles need; items that share a title or a category are weighed by their predictions."""
    rows = [(i, str(i), f"t{i % 3}", ["a", f"c{i % 2}"], float(i * j % 7)) for i in range(6) for j in range(i + 1)]
    rows += [(6, "6", "t6", ["b"], None), (5, "5", "t2", ["a", "c1"], None)]
    names = "item_index int, item_id string, title string, categories array<string>, prediction float"
    predictions = spark.createDataFrame(rows, names)
    items = predictions.select("item_index", "item_id", "title", "categories").dropDuplicates(["item_index"])
    sums = recommend.item_sums(predictions).join(items, "item_index")
    assert sums.count() == 7
    for profile in (recommend.als_item_profile, recommend.als_title_profile, recommend.als_category_profile):
        of_sums, plain = profile(sums), profile(predictions)
        assert of_sums.schema == plain.schema and sorted(of_sums.collect(), key=str) == sorted(plain.collect(), key=str)


def test_packed_lines_lose_nothing(spark, tmp_path):
    """Lines without a number, order, part or quantity, and numbers of any size, are those of ``line_ids``."""
    from tidemark.sources.tables import line_ids, packed_lines, unpacked

    number = [1, 7, 0, -1, -(2**31), 2**31 - 1, None]
    quantity = [1.0, 10.0, 11.0, 50.0, 0.0, -3.0, None]
    lines = [(o, n, p, q) for o in (1, 2, None) for n in number for p in (5, None) for q in quantity]
    schema = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_quantity double"
    shipped = F.to_timestamp_ntz(F.lit("1995-03-01 10:00:00.000001"))
    spark.createDataFrame(lines, schema).withColumn("l_shipdate", shipped).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 3), (2, None)], "o_orderkey bigint, o_custkey bigint").write.parquet(f"{tmp_path}/orders.parquet")
    plain, packed = line_ids(spark, str(tmp_path)), packed_lines(spark, str(tmp_path))
    again = unpacked(packed)
    assert len(packed.columns) < len(plain.columns) and again.dtypes == plain.dtypes
    assert sorted(map(str, again.collect())) == sorted(map(str, plain.collect())) and plain.count() == 2 * 7 * 2 * 7


def shuffles(spark):
    """Numbers of the shuffles that have files on disk."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f.split("_")[1] for folder in folders for _, _, files in os.walk(folder) for f in files if f.startswith("shuffle_") and f.endswith(".data")}


def test_an_iteration_leaves_no_shuffle(spark, train):
    """Eight iterations have sixteen exchanges of factors; those before the last one are gone when the fit has ended."""
    before = shuffles(spark)
    model = recommend.fit_als(train, iters=8)
    until = time.time() + 30
    while len(shuffles(spark) - before) > 8 and time.time() < until:
        time.sleep(0.5)
    assert 0 < len(shuffles(spark) - before) <= 8  # three of the ratings, two of the last iteration, those of the rows
    assert model.userFactors.count() == 60


def test_a_written_table_leaves_no_shuffle(spark):
    from tidemark.session import RELEASE, written, written_by

    rows, setting = spark.range(5_000).withColumn("k", F.col("id") % 7), spark.conf.get(RELEASE, None)
    counts = rows.groupBy("k").count()
    assert counts.count() == 7
    before = shuffles(spark)
    tables = [written(counts, "counts"), written_by(rows, "rows", "k")]
    until = time.time() + 30
    while shuffles(spark) - before and time.time() < until:
        time.sleep(0.5)
    assert not shuffles(spark) - before
    assert [t.count() for t in tables] == [7, 5_000] and counts.count() == 7 and spark.conf.get(RELEASE, None) == setting


def odd_lines(spark, path):
    """Lines of unknown and missing parts, orders and customers, of a part that is there twice, and rated again later."""
    numbers = spark.range(3_000)
    numbers.select(
        F.when(F.col("id") % 17 > 0, F.col("id") % 211).alias("l_orderkey"),
        F.when(F.col("id") % 13 > 0, (F.col("id") % 7).cast("int")).alias("l_linenumber"),
        F.when(F.col("id") % 11 > 0, F.col("id") * 31 % 45).alias("l_partkey"),
        F.when(F.col("id") % 19 > 0, (F.col("id") % 50 + 1).cast("double")).alias("l_quantity"),
        F.when(F.col("id") % 23 > 0, F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id % 90 as int))")).alias("l_shipdate"),
    ).write.parquet(f"{path}/lineitem.parquet")
    orders = spark.range(205).select(F.col("id").alias("o_orderkey"), F.when(F.col("id") % 9 > 0, F.col("id") % 40).alias("o_custkey"))
    orders.write.parquet(f"{path}/orders.parquet")
    parts = spark.range(40).unionByName(spark.range(5, 7)).unionByName(spark.range(1).select(F.lit(None).cast("long").alias("id")))
    name = F.when(F.col("id") % 10 > 0, F.concat(F.lit("blue c"), F.col("id") % 4, F.lit(" blue")))
    parts.select(F.col("id").alias("p_partkey"), name.alias("p_name")).write.parquet(f"{path}/part.parquet")
    return str(path)


def as_rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture
def joined(monkeypatch):
    """How often lines have been joined with their orders."""
    from tidemark.sources import tables

    calls, real = [], tables._with_customers
    monkeypatch.setattr(tables, "_with_customers", lambda *args: calls.append(1) or real(*args))
    return calls


def test_windows_of_stored_lines_are_those_of_the_tables(spark, tmp_path):
    from tidemark.plans import registry
    from tidemark.session import written_by

    path = odd_lines(spark, tmp_path)
    expected = as_rows(registry._line_trends(spark, path))
    packed = written_by(registry._packed(spark, path), "packed", "item_id", dealt_before=True)
    bare = registry._known_lines(spark, path, dedup_pairs=False, keep=("event_time",))
    for lines in (registry.unpacked(packed), bare):
        assert as_rows(registry._bucket_trends(spark, path, lines)) == expected and expected
    assert as_rows(registry._latest_lines(packed)) == as_rows(registry._known(spark, path))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = registry._bucket_trends(spark, path, bare)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning(item_id") == 1, plan  # the parts


@pytest.mark.parametrize("name", ["als_category_comparison", "als_latest_comparison"])
def test_lines_are_joined_with_their_orders_once(spark, sf_dir, joined, name):
    from tidemark.plans.registry import QUERIES

    assert QUERIES[name](spark, sf_dir).count() > 0 and len(joined) == 1


def test_coverage_counts_the_lines_of_one_join(spark, tmp_path, joined):
    """All lines count, those without a known part too; the ones that are not trained on are joined for no second time."""
    from tidemark.operators.dedup import dedup_ratings
    from tidemark.plans import registry
    from tidemark.sources.tables import line_ratings_raw

    path = odd_lines(spark, tmp_path)
    pairs = dedup_ratings(line_ratings_raw(spark, path), order_by=registry.LINE_ORDER)
    parts = spark.read.parquet(f"{path}/part.parquet").select(F.col("p_partkey").cast("string").alias("item_id")).distinct()
    known = as_rows(registry._known(spark, path))
    joined.clear()
    marked, without = registry._marked_pairs(spark, path)
    assert as_rows(marked.filter("known").drop("known")) == known
    assert marked.filter("not known").count() == pairs.filter("item_id is not null").join(parts, "item_id", "left_anti").count() > 0
    assert without.count() == pairs.filter("item_id is null").count() > 0
    plan = without._jdf.queryExecution().optimizedPlan().toString()
    assert "isnull(l_partkey" in plan and len(joined) == 2, plan  # the second is of lines without a part alone
    row, part = registry.QUERIES["als_coverage"](spark, path).first(), registry._held_out()
    assert (row.trained, row.held_out) == (pairs.filter(~part).count(), pairs.filter(part).count())
    assert 0 < row.predicted < row.held_out and row.dropped == row.held_out - row.predicted


def test_scored_events_are_moved_to_users_and_items_alone(spark, tmp_path, train):
    from tidemark.session import written

    model = models.stored_als(train, str(tmp_path / "models"), iters=1)
    rows = train.select(F.col("user_index").cast("string").alias("user_id"), F.col("item_index").cast("string").alias("item_id"), "rating", "id")
    users, items = (written(indexing.id_index(rows, f"{of}_id"), of) for of in ("user", "item"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scored = models.score(model, rows, users, items)
        plan = scored._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 2 * 2 + 2 * 2, plan  # rows to their ids, and numbers to their factors
    assert scored.columns == ["item_index", "user_index", "item_id", "user_id", "rating", "id", "prediction"]


def test_stream_scores_are_of_every_known_held_out_line(spark, tmp_path):
    """Ids move as numbers; each line that the model knows is scored once, as a batch scores it."""
    from tidemark.plans import registry

    path = odd_lines(spark, tmp_path)
    lines = registry._known(spark, path)
    test, known = lines.filter("held_out"), lines.filter("not held_out")
    expected = test.join(known.select("user_id").distinct(), "user_id").join(known.select("item_id").distinct(), "item_id")
    got = registry.QUERIES["als_stream_scores"](spark, path)
    assert got.dtypes[:2] == [("user_id", "string"), ("item_id", "string")] and got.filter("not same").count() == 0
    ids = ["user_id", "item_id", F.col("rating")]
    assert as_rows(got.select(*ids)) == as_rows(registry.named(expected).select(*ids)) and got.count() > 0
