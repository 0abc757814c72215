import json
from unittest.mock import MagicMock

import pytest

from tests.helpers import as_set, at, events
from tidemark.operators.joins import enrich
from tidemark.operators.stats import category_stats, item_stats
from tidemark.schema import EVENT_SCHEMA, TREND_SCHEMA
from tidemark.sources import events as wire
from tidemark.sources import files, kafka
from tidemark.sources.tables import event_stream
from tidemark.streaming import run

ITEMS = """movieId,title,genres
1,Plain,Drama|War
2,"Comma, The",Comedy
3,None listed,(no genres listed)
4,Blank,
5,Plain,Horror
6,Old name,Drama
6,"Quote ""in"" name",Western
"""
RATINGS = """userId,movieId,rating,timestamp
7,1,0.5,964982703
7,2,5.0,964982704
8,3,4.5,964982705
8,99,3.0,964982706
9,6,2.5,964982707
"""


@pytest.fixture
def csv(tmp_path):
    (tmp_path / "items.csv").write_text(ITEMS, encoding="utf-8")
    (tmp_path / "ratings.csv").write_text(RATINGS, encoding="utf-8")
    return tmp_path


def test_items(spark, csv):
    rows = {r.item_id: (r.title, r.categories) for r in files.read_items(spark, str(csv / "items.csv")).collect()}
    assert rows["1"] == ("Plain", ["Drama", "War"])
    assert rows["2"] == ("Comma, The", ["Comedy"])
    assert rows["3"] == ("None listed", [])
    assert rows["4"][1] == [""]
    assert rows["6"] == ('Quote "in" name', ["Western"])
    assert len(rows) == 6


def test_last_item_row_wins_over_many(spark, tmp_path):
    lines = "".join(f"1,version {i},g{i}\n" for i in range(5000))
    (tmp_path / "items.csv").write_text("movieId,title,genres\n" + lines)
    assert as_set(files.read_items(spark, str(tmp_path / "items.csv")), "title") == {("version 4999",)}


def test_ratings_and_enrichment(spark, csv):
    ratings = files.read_ratings(spark, str(csv / "ratings.csv"))
    assert all(t == "string" for _, t in ratings.dtypes)
    joined = enrich(ratings, files.read_items(spark, str(csv / "items.csv")))
    assert as_set(joined, "user_id", "item_id", "rating", "source_time") == {
        ("7", "1", "0.5", "964982703"),
        ("7", "2", "5.0", "964982704"),
        ("8", "3", "4.5", "964982705"),
        ("9", "6", "2.5", "964982707"),
    }
    assert as_set(enrich(ratings, files.read_items(spark, str(csv / "items.csv")), salts=3), "item_id") == {
        ("1",), ("2",), ("3",), ("6",),
    }


def test_missing_input(spark, tmp_path):
    with pytest.raises(files.MissingInput):
        files.read_raw(spark, str(tmp_path / "absent"))
    (tmp_path / "hollow" / "_spark_metadata").mkdir(parents=True)
    hollow = files.read_trends(spark, str(tmp_path / "hollow"))
    assert hollow.count() == 0 and hollow.schema == TREND_SCHEMA
    assert files.empty(spark, EVENT_SCHEMA).count() == 0


WIRE = [
    '{"userId":"1","movie":{"movieId":"10","title":"T","genres":["a","b"]},"rating":"4.5","timestamp":"964982703"}',
    "not json",
    '{"userId":"2","rating":"3.0","timestamp":"964982703"}',
    '{"userId":"3","movie":{"movieId":"10","title":"T","genres":["a"]},"rating":"abc","timestamp":"x"}',
    '{"userId":"4","movie":{"movieId":"10","title":"T","genres":[]},"rating":"2.0","timestamp":"964982703"}',
    '{"userId":"5","movie":{"movieId":"10","title":"T"},"rating":"1.0","timestamp":"964982703"}',
    None,
]


@pytest.fixture
def raw(spark):
    return spark.createDataFrame([(None if v is None else bytearray(v.encode()),) for v in WIRE], "value binary")


def test_parse(raw):
    rows = wire.parse_events(raw, "source", columns=wire.EVENT_COLUMNS + ("source_time",)).collect()
    assert rows[0].asDict() == {
        "user_id": "1", "item_id": "10", "title": "T", "categories": ["a", "b"], "rating": 4.5,
        "event_time": at("00:00:00").replace(2000, 7, 30, 18, 45, 3), "source_time": 964982703,
    }
    assert set(rows[1].asDict().values()) == {None}
    assert (rows[2].user_id, rows[2].item_id, rows[2].rating) == ("2", None, 3.0)
    assert (rows[3].rating, rows[3].event_time) == (None, None)
    assert rows[4].categories == [] and rows[5].categories is None
    assert set(rows[6].asDict().values()) == {None}


def test_malformed_rows_in_results(raw):
    stats = as_set(item_stats(wire.parse_events(raw)), "item_id", "num_ratings", "avg_rating")
    # the NULL group holds the broken texts and the rating without an item
    assert stats == {("10", 3, 2.5), (None, 1, 3.0)}
    assert as_set(category_stats(wire.parse_events(raw)), "category", "num_ratings") == {("a", 1), ("b", 1)}
    assert wire.dead_letters(raw).count() == 2
    assert wire.parse_events(raw, drop_malformed=True).count() == 5


def test_arrival_time_is_one_value(raw):
    assert wire.parse_events(raw).select("event_time").distinct().count() == 1


def test_only_needed_fields_are_decoded():
    assert wire.wire_schema(("categories", "rating")).simpleString() == (
        "struct<movie:struct<genres:array<string>>,rating:string>"
    )


def test_round_trip(spark):
    rows = events(spark, [("1", "10", "T", ["a"], 4.5, at("10:00:00")), ("2", None, None, None, None, None)])
    text = [json.loads(r.value) for r in wire.encode_events(rows).collect()]
    assert text[0] == {
        "userId": "1", "movie": {"movieId": "10", "title": "T", "genres": ["a"]}, "rating": "4.5",
        "timestamp": "1704103200",
    }
    assert text[1]["movie"] == {"movieId": None, "title": None, "genres": None}
    back = wire.parse_events(wire.encode_events(rows), "source")
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.select(*back.columns).collect()))


def test_sample_takes_the_lowest_offsets(spark):
    rows = [(0, i, bytearray(WIRE[0].replace('"1"', f'"{i}"', 1).encode())) for i in reversed(range(50))]
    topic = spark.createDataFrame(rows, "partition int, offset bigint, value binary")
    assert wire.sample_topic(topic).count() == 20
    sample = wire.sample_topic(topic, order_by=["partition", "offset"])
    assert as_set(sample, "user_id") == {(str(i),) for i in range(20)}


def test_kafka_options():
    session = MagicMock()
    reader = session.readStream.format.return_value
    kafka.kafka_source(session, "host:1", "ratings", max_offsets=5)
    session.readStream.format.assert_called_with("kafka")
    reader.options.assert_called_with(
        **{
            "kafka.bootstrap.servers": "host:1",
            "subscribe": "ratings",
            "startingOffsets": "latest",
            "failOnDataLoss": "false",
        }
    )
    kafka.kafka_source(session, "host:1", "ratings", starting="earliest", fail_on_data_loss=True)
    assert reader.options.call_args.kwargs["failOnDataLoss"] == "true"


def test_publish_to_a_topic_asks_for_the_connector(spark):
    rows = events(spark, [("1", "10", "T", ["a"], 4.5, at("10:00:00"))])
    with pytest.raises(Exception, match="kafka"):
        kafka.publish(rows, "host:1", "ratings")


def test_a_published_stream_needs_a_checkpoint(spark, tmp_path):
    rows = files.stream_folder(spark, str(tmp_path))
    with pytest.raises(ValueError, match="checkpoint"):
        kafka.publish(rows, "host:1", "ratings")


def test_stored_names_are_mapped(spark, tmp_path):
    path = str(tmp_path / "old")
    spark.sql(
        "select '1' userId, '10' movieId, 'T' title, array('a') genres, 4.5D rating, timestamp'2024-01-01' event_time"
    ).write.parquet(path)
    assert files.read_raw(spark, path).columns == [
        "user_id", "item_id", "title", "categories", "rating", "event_time",
    ]
    trends = str(tmp_path / "trends")
    spark.sql(
        "select named_struct('start', timestamp'2024-01-01', 'end', timestamp'2024-01-02') window,"
        " 'a' genre, 4.5D avg_rating, 1L rating_count"
    ).write.parquet(trends)
    assert files.read_trends(spark, trends).columns == [
        "window_start", "window_end", "category", "avg_rating", "rating_count",
    ]


def test_commit_log_and_file_reads(spark, tmp_path):
    source, path, moved = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "moved")
    events(spark, [("1", "10", "T", ["a"], 4.5, at("10:00:00"))]).write.parquet(source)
    query = run.to_parquet(files.stream_folder(spark, source), path, str(tmp_path / "ckpt"), "available_now")
    query.awaitTermination()
    spark.read.parquet(source).write.mode("append").parquet(path)
    assert files.read_raw(spark, path).count() == 1
    assert files.read_raw(spark, path, committed_only=False).count() == 2
    assert files.read_sinks(spark, [path, source]).count() == 2
    import shutil

    shutil.copytree(path, moved)
    assert files.read_raw(spark, moved, committed_only=False).count() == 2


def test_text_is_kept_as_it_stands(spark, tmp_path):
    (tmp_path / "r.csv").write_text('userId,movieId,rating,timestamp\n1,,"",3\n')
    assert files.read_ratings(spark, str(tmp_path / "r.csv")).first().asDict() == {
        "user_id": "1", "item_id": "", "rating": "", "source_time": "3",
    }
    (tmp_path / "i.csv").write_text('movieId,title,genres\n1,"two\nlines",a|b\n')
    assert files.read_items(spark, str(tmp_path / "i.csv"), multi_line=True).first().title == "two\nlines"


def test_a_table_of_part_files_is_streamed_whole(spark, sf_dir, tmp_path):
    source = spark.read.parquet(f"{sf_dir}/events.parquet")
    source.repartition(5).write.parquet(str(tmp_path / "events.parquet"))
    rows = event_stream(spark, str(tmp_path))
    rows.writeStream.format("memory").queryName("folder_events").trigger(availableNow=True).start().awaitTermination()
    assert spark.table("folder_events").count() == source.count()


def test_session_settings_of_the_caller_stay(spark):
    from tidemark.session import shared_dir, use_utc

    before = dict(spark.conf.getAll)
    use_utc(spark)
    after = dict(spark.conf.getAll)
    assert {k for k in after if before.get(k) != after[k]} <= {"spark.sql.session.timeZone"}
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
