"""Readers, and option building where no service is at hand."""

from __future__ import annotations

import csv
import random
from unittest import mock

import pytest
from pyspark.errors import AnalysisException

from tests.conftest import values
from txnloom import sinks, sources
from txnloom.schema import FIELD_NAMES, HEADER_LINE
from txnloom.session import build_session, scratch_path, size_shuffle
from txnloom.sources import lines
from txnloom.sources.jdbc import hash_parts


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())
    return str(path.parent)


NAMES = ("a", "b", "c")


def test_csv_fields_are_text_with_quotes_resolved(spark, tmp_path):
    folder = write(tmp_path / "in" / "f.csv", 'a,b,c\n1,"x, ""y"" é",\n\n 2 ,"",z\n')
    got = values(sources.csv_rows(spark, folder, NAMES))
    assert got == [(" 2 ", "", "z"), ("1", 'x, "y" é', "")]


def test_csv_header_must_name_the_fields(spark, tmp_path):
    folder = write(tmp_path / "in" / "f.csv", "a,c,b\n1,2,3\n")
    with pytest.raises(Exception, match="(?i)header"):
        sources.csv_rows(spark, folder, NAMES).collect()


def test_csv_line_breaks_inside_quotes(spark, tmp_path):
    folder = write(tmp_path / "in" / "f.csv", 'a,b,c\n1,"x\ny",3\n')
    assert values(sources.csv_rows(spark, folder, NAMES, multiline=True)) == [("1", "x\ny", "3")]


def test_text_lines_without_header_and_blanks(spark, tmp_path):
    write(tmp_path / "in" / "a.csv", f"{HEADER_LINE}\n 1,x \n\n2,y\r\n")
    folder = write(tmp_path / "in" / "b.csv", f"{HEADER_LINE}\n3,z")
    assert values(sources.text_lines(spark, folder)) == [("1,x",), ("2,y",), ("3,z",)]
    assert sources.text_lines(spark, folder, header=False, keep_blank=True).count() == 6
    assert sources.text_lines(spark, folder, header=False).count() == 5
    assert sources.text_lines(spark, folder, keep_blank=True).count() == 4


def test_each_file_loses_its_own_first_line(spark, conf, tmp_path):
    conf("spark.sql.files.maxPartitionBytes", "64")
    lines = "".join(f'{i},"val"ue\\,\t\n' for i in range(500))
    write(tmp_path / "in" / "a.csv", f'"id", other \n{lines}"id", other \nH1;H2\n')
    folder = write(tmp_path / "in" / "b.csv", "H1;H2\n7,seven\n\n")
    got = values(sources.text_lines(spark, folder))
    want = [f'{i},"val"ue\\,' for i in range(500)] + ['"id", other', "H1;H2", "7,seven"]
    assert got == sorted((line,) for line in want)


def test_header_is_dropped_from_every_split(spark, conf, tmp_path):
    conf("spark.sql.files.maxPartitionBytes", "256")
    conf("spark.sql.files.openCostInBytes", "1")
    folder = write(tmp_path / "in" / "a.csv", f"{HEADER_LINE}\n" + "1,x\n" * 1000)
    lines = sources.text_lines(spark, folder)
    assert lines.rdd.getNumPartitions() > 3
    assert lines.count() == 1000


def test_parquet_stream_from_one_file_and_from_a_folder(spark, sf_dir):
    path = f"{sf_dir}/events.parquet"
    folder = scratch_path(spark, "events")
    spark.read.parquet(path).repartition(3).write.parquet(folder)
    for place in (path, folder):
        stream = sources.parquet_rows(spark, place, streaming=True)
        out = scratch_path(spark, "out")
        query = (
            stream.writeStream.format("parquet")
            .option("checkpointLocation", scratch_path(spark, "check"))
            .trigger(availableNow=True)
            .start(out)
        )
        query.awaitTermination()
        assert spark.read.parquet(out).count() == spark.read.parquet(path).count()


def test_rates_from_a_mapping_csv_and_parquet(spark, tmp_path):
    want = [("EUR", 0.875), ("USD", 1.0)]
    mapped = sources.rates_from_mapping(spark, {"EUR": 0.875, "USD": 1})
    assert values(mapped) == want and mapped.dtypes == [("currency", "string"), ("rate", "double")]
    folder = write(tmp_path / "in" / "r.csv", "currency,rate\nEUR,0.875\nUSD,1\n")
    assert values(sources.rates_from_csv(spark, folder)) == want
    place = scratch_path(spark, "rates")
    mapped.write.parquet(place)
    assert values(sources.rates_from_parquet(spark, place)) == want


def test_bad_rate_fails_the_read(spark, tmp_path):
    folder = write(tmp_path / "in" / "r.csv", "currency,rate\nEUR,many\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        sources.rates_from_csv(spark, folder).collect()


def test_blank_first_lines_are_first_lines(spark, conf, tmp_path):
    conf("spark.sql.files.maxPartitionBytes", "8")
    conf("spark.sql.files.openCostInBytes", "1")
    write(tmp_path / "in" / "a.csv", "\n\nh1,h2\na,b")
    folder = write(tmp_path / "in" / "b.csv", "h1,h2\nc\n\nh1,h2\n")
    want = ["a,b", "c", "h1,h2", "h1,h2"]
    assert values(sources.text_lines(spark, folder)) == [(line,) for line in want]
    stream = sources.text_lines(spark, folder, streaming=True)
    out = scratch_path(spark, "lines")
    query = stream.writeStream.option("checkpointLocation", scratch_path(spark, "check"))
    query.trigger(availableNow=True).start(out).awaitTermination()
    assert values(spark.read.parquet(out)) == [(line,) for line in want]


@pytest.mark.parametrize("rows", [0, 101, 299, 900])
def test_first_lines_in_order_of_place(spark, conf, tmp_path, rows):
    conf("spark.sql.files.maxPartitionBytes", "200")
    conf("spark.sql.files.openCostInBytes", "1")
    for part in range(3):
        lines = "".join(f"{part * 100 + i}\n\n" for i in range(100))
        folder = write(tmp_path / "in" / f"{part}.csv", f"id\n{lines}")
    got = [int(row["value"]) for row in sources.text_lines(spark, folder, first=rows).collect()]
    assert sorted(got) == list(range(min(rows, 300)))
    blank = sources.text_lines(spark, folder, first=rows, keep_blank=True, header=False)
    assert blank.count() == min(rows, 603)
    got = [int(row["id"]) for row in sources.csv_rows(spark, folder, ("id",), first=rows).collect()]
    assert sorted(got) == list(range(min(rows, 300)))


def test_a_first_row_reads_few_files(spark, tmp_path):
    for part in range(9):
        folder = write(tmp_path / "in" / f"{part}.csv", "id\n1\n2\n")
    asked = []

    def read(paths):
        asked.append(len(paths))
        return sources.numbered_lines(spark, paths)

    assert lines.first_rows(spark, folder, 5, read).count() == 5
    assert max(asked) == 4
    with pytest.raises(ValueError, match="batch"):
        sources.text_lines(spark, folder, streaming=True, first=1)


def python_rows(path, names):
    """What the csv module reads from a file, line breaks read as line feeds."""
    with open(path, encoding="utf-8") as file:
        return [tuple(row[n] or "" for n in names) for row in csv.DictReader(file)]


@pytest.mark.parametrize("size, most", [(1 << 20, 99), (301, 99), (97, 99), (97, 0)])
def test_quoted_records_equal_the_csv_module(spark, conf, monkeypatch, tmp_path, size, most):
    conf("spark.sql.files.maxPartitionBytes", str(size))
    conf("spark.sql.files.openCostInBytes", "1")
    monkeypatch.setattr(lines.quoted_records, "__defaults__", (most,))
    rng = random.Random(size)
    want = []
    for part in range(3):
        path = tmp_path / "in" / f"{part}.csv"
        path.parent.mkdir(exist_ok=True)
        with open(path, "w", encoding="utf-8", newline="") as file:
            out = csv.writer(file, lineterminator=rng.choice(["\n", "\r\n"]))
            out.writerow(NAMES)
            for i in range(40):
                text = "".join(rng.choice('ab,"\n é') for _ in range(rng.choice([0, 3, 40, 200])))
                out.writerow([f"{part}-{i}", text, rng.choice(["", "x", "y\n\nz", '"'])])
                if rng.random() < 0.1:
                    file.write("\n")
        want += python_rows(path, NAMES)
    records = sources.csv_rows(spark, str(tmp_path / "in"), NAMES, multiline=True)
    assert values(records) == sorted(want, key=lambda row: tuple((v is None, v) for v in row))
    first = sources.csv_rows(spark, str(tmp_path / "in"), NAMES, first=70).collect()
    assert [tuple(row) for row in first] == want[:70]


def test_an_open_quote_ends_with_its_file(spark, conf, tmp_path):
    conf("spark.sql.files.maxPartitionBytes", "16")
    conf("spark.sql.files.openCostInBytes", "1")
    write(tmp_path / "in" / "a.csv", 'a,b,c\n1,2,3\n4,"five\n' + "six\n" * 20)
    folder = write(tmp_path / "in" / "b.csv", "a,b,c\n7,8,9\n")
    got = values(sources.quoted_records(spark, folder).where("in_file > 0").select("value"))
    assert got == [("1,2,3",), ('4,"five' + "\nsix" * 20,), ("7,8,9",)]


def test_one_file_of_records_is_read_by_many_tasks(spark, conf, tmp_path):
    conf("spark.sql.files.maxPartitionBytes", "512")
    conf("spark.sql.files.openCostInBytes", "1")
    folder = write(tmp_path / "in" / "a.csv", "a,b,c\n" + '1,"x\ny",z\n' * 1000)
    rows = sources.csv_rows(spark, folder, NAMES, multiline=True)
    assert rows.rdd.getNumPartitions() > 8
    assert rows.distinct().count() == 1 and rows.count() == 1000


def test_splits_that_were_not_counted_fail(spark, conf, tmp_path):
    folder = write(tmp_path / "in" / "a.csv", "a,b,c\n" + "1,2,3\n" * 100)
    rows = sources.numbered_lines(spark, folder)
    conf("spark.sql.files.maxPartitionBytes", "64")
    conf("spark.sql.files.openCostInBytes", "1")
    with pytest.raises(Exception, match="changed after they were counted"):
        rows.collect()


def test_kafka_options():
    assert sources.kafka_read_options("k:9093", "in") == {
        "kafka.bootstrap.servers": "k:9093",
        "subscribe": "in",
        "startingOffsets": "latest",
    }
    more = sources.kafka_read_options(
        "k:9093", "in", starting="earliest", min_partitions=64, max_offsets_per_trigger=1000
    )
    assert more["startingOffsets"] == "earliest"
    assert more["minPartitions"] == "64" and more["maxOffsetsPerTrigger"] == "1000"


def test_further_options_reach_broker_and_database():
    secured = {"kafka.security.protocol": "SSL"}
    assert sources.kafka_read_options("k", "in", options=secured)["kafka.security.protocol"] == "SSL"
    assert sinks.kafka_write_options("k", "out", secured)["topic"] == "out"
    with pytest.raises(ValueError, match="twice"):
        sources.kafka_read_options("k", "in", options={"Subscribe": "x"})
    target = sources.JdbcTarget("jdbc:x", user="u", password="p", options={"sslmode": "require"})
    assert target.properties["sslmode"] == "require" and "require" not in repr(target)
    parts = hash_parts("id", 3)
    assert len(set(parts)) == 3 and all("hashtext(id)" in part for part in parts)


def test_kafka_needs_its_connector(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        sources.kafka_stream(spark, "k:9093", "in")


def test_jdbc_target_hides_its_password():
    env = {"DB_HOST": "db", "DB_PORT": "5432", "DB_NAME": "n", "DB_USER": "u", "DB_PASS": "secret"}
    target = sources.JdbcTarget.from_env(env=env)
    assert target.url == "jdbc:postgresql://db:5432/n" and target.table == "transaction_data"
    assert "secret" not in repr(target)
    assert target.properties == {
        "user": "u",
        "password": "secret",
        "driver": "org.postgresql.Driver",
    }


def test_jdbc_query_is_pushed_down_as_a_subquery():
    """Against a stand-in reader: no database runs here."""
    spark = mock.Mock()
    target = sources.JdbcTarget("jdbc:x", user="u")
    sources.jdbc_query(spark, target, "SELECT 1 AS one")
    spark.read.jdbc.assert_called_once_with(
        "jdbc:x", "(SELECT 1 AS one) AS q", properties={"fetchsize": "10000", "user": "u", **target.properties}
    )
    sources.jdbc_query(spark, target, "SELECT id FROM t", ["id < 5", "id >= 5"])
    assert spark.read.jdbc.call_args.kwargs["predicates"] == ["id < 5", "id >= 5"]
    sources.check_connection(spark, target)
    assert spark.read.jdbc.call_args.args[1] == "(SELECT version() AS db_version) AS q"
    spark.read.jdbc.return_value.show.assert_called_once()


def test_shuffle_size_follows_the_input(spark, conf, sf_dir):
    conf("spark.sql.shuffle.partitions", "4")
    path = f"{sf_dir}/lineitem.parquet"
    assert size_shuffle(spark, path) == 4
    count = size_shuffle(spark, path, path, partition_bytes=10_000, growth=1.0)
    assert count == int(spark.conf.get("spark.sql.shuffle.partitions")) > 20
    conf("spark.sql.shuffle.partitions", "4")
    assert size_shuffle(spark, path, partition_bytes=1, most=30) == 30


def test_session_defaults_give_way(spark):
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    key = "spark.sql.adaptive.skewJoin.enabled"
    try:
        same = build_session(conf={key: "false"})
        assert same.conf.get(key) == "false"
    finally:
        spark.conf.set(key, "true")


def test_scratch_folder_must_be_shared_on_a_cluster(spark, conf):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))
    cluster = mock.Mock()
    cluster.conf.get.return_value = None
    cluster.sparkContext.master = "spark://host:7077"
    with pytest.raises(ValueError, match="shared folder"):
        scratch_path(cluster, "x")


def test_field_order_is_the_header():
    assert HEADER_LINE.split(",") == list(FIELD_NAMES) and len(FIELD_NAMES) == 24
