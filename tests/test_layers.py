import pytest
from pyspark.sql import functions as F
from rows import edits, event, raw

from tidemark import schemas as S
from tidemark import session
from tidemark.operators import features, reports
from tidemark.plans import layers
from tidemark.session import build_session, configure, scratch_path, shared_folder
from tidemark.sinks.files import write_batch, write_layer
from tidemark.sources.files import read_batches, read_csv, read_layer


@pytest.fixture
def source(spark, tmp_path):
    path = str(tmp_path / "csv")
    rows = raw(
        spark,
        event(),
        event(),
        event(AppointmentID=2, Age=-1),
        event(AppointmentID=3, AppointmentDay="2024-02-01T00:00:00Z"),
        event(AppointmentID=4, Neighbourhood="PRAÇA, DO CANTO"),
    )
    rows.write.option("header", True).csv(path)
    return path


@pytest.mark.parametrize("infer", [False, True])
def test_etl_counts_and_layers(spark, source, tmp_path, infer):
    out = str(tmp_path / "out")
    counts = {r["layer"]: r["rows"] for r in layers.run_etl(spark, source, out, infer=infer).collect()}
    assert counts == {"bronze": 5, "silver": 3, "gold": 2}
    gold = read_layer(spark, f"{out}/gold")
    assert gold.columns == S.GOLD
    names = {r["Neighbourhood"] for r in gold.collect()}
    assert names == {"CENTRO", "PRAÇA, DO CANTO"}


def test_explicit_and_inferred_schema_agree(spark, source):
    explicit, inferred = read_csv(spark, source), read_csv(spark, source, infer=True)
    assert explicit.schema == S.raw_schema()
    assert [(f.name, f.dataType) for f in inferred.schema] == [
        (f.name, f.dataType) for f in explicit.schema
    ]
    assert explicit.exceptAll(inferred).isEmpty()


def test_a_malformed_csv_fails(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text(",".join(n for n, _ in S.RAW_FIELDS) + "\n1.0,x,F,,,1,A,0,0,0,0,0,0,No\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read_csv(spark, str(path)).collect()


def test_layers_are_replaced(spark, tmp_path):
    path = str(tmp_path / "layer")
    write_layer(edits(spark, {}, {}), path)
    write_layer(edits(spark, {}), path)
    assert read_layer(spark, path).count() == 1


def test_batches_read_as_one_table_without_extra_columns(spark, tmp_path):
    out = str(tmp_path / "batches")
    for i in (0, 1, 10):
        write_batch(edits(spark, {"Age": i}), out, i)
    df = read_batches(spark, out)
    assert df.columns == edits(spark, {}).columns
    assert sorted(r["Age"] for r in df.collect()) == [0, 1, 10]


def test_counts_need_no_column(spark, tmp_path):
    path = write_layer(edits(spark, {}, {}), str(tmp_path / "layer"))
    counts = reports.layer_counts(spark, {"one": path, "two": path})
    assert sorted(map(tuple, counts.collect())) == [("one", 2), ("two", 2)]
    assert "ReadSchema: struct<>" in counts._jdf.queryExecution().toString()


def test_shares_sum_to_a_hundred(spark):
    df = spark.range(1000).select((F.col("id") % 3 == 0).cast("int").alias("c"))
    rows = {r["c"]: r for r in reports.shares_by(df, "c").collect()}
    assert rows[1]["count"] == 334 and rows[1]["percentage"] == 33.4
    assert sum(r["percentage"] for r in rows.values()) == pytest.approx(100)


def test_preview_is_the_same_for_any_layout(spark):
    df = spark.range(500).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    first = reports.preview(df, 10, ["k"]).collect()
    assert first == reports.preview(df.repartition(17), 10, ["k"]).collect()
    plan = reports.preview(df, 10, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_schema_report(spark):
    gold = features.gold(features.silver(edits(spark, {})))
    rows = reports.schema_report(gold).collect()
    assert [r["name"] for r in rows] == S.GOLD
    assert tuple(rows[0])[:3] == (0, "PatientId", "double")


def test_scratch_paths_are_fresh_and_in_the_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one != two and one.startswith(folder) and two.startswith(folder)


def test_sessions_pin_the_zone(spark):
    assert configure(spark).conf.get("spark.sql.session.timeZone") == "UTC"
    assert build_session("again") is not None


def test_shuffles_are_sized_once_by_the_input(spark):
    assert session.shuffle_partitions(0) == 200
    assert session.shuffle_partitions(100 * 10**12) == -(-100 * 10**12 // session.SHUFFLE_BYTES)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    queries = __import__("__spark_entry__").queries()
    queries["gold"](spark, "/root/testdata/sf0.001").count()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


@pytest.mark.parametrize("seed", range(4))
def test_csv_columns_go_by_name(spark, tmp_path, seed):
    import random

    order = list(S.raw_schema().names)
    random.Random(seed).shuffle(order)
    values = {n: str(i) for i, n in enumerate(S.raw_schema().names)}
    values |= {"ScheduledDay": "2024-01-01T00:00:00Z", "AppointmentDay": "2024-01-02T00:00:00Z"}
    path = tmp_path / "in.csv"
    path.write_text(",".join(order) + "\n" + ",".join(values[n] for n in order) + "\n")
    row = read_csv(spark, str(path)).first()
    assert list(row.asDict()) == S.raw_schema().names
    assert (row["Hipertension"], row["Alcoholism"], row["Age"]) == (8, 10, 5)


def test_csv_with_a_missing_or_unknown_column_is_refused(spark, tmp_path):
    names = S.raw_schema().names
    (tmp_path / "missing.csv").write_text(",".join(names[1:]) + "\n")
    (tmp_path / "unknown.csv").write_text(",".join([*names, "Extra"]) + "\n")
    for name in ("missing", "unknown"):
        with pytest.raises(ValueError, match=name):
            read_csv(spark, str(tmp_path / f"{name}.csv"))


def test_bad_csv_rows_can_be_put_aside(spark, tmp_path):

    names = S.raw_schema().names
    good = {n: "1" for n in names} | {
        "ScheduledDay": "2024-01-01T00:00:00Z", "AppointmentDay": "2024-01-02T00:00:00Z"
    }
    lines = [",".join(names), ",".join(good.values()), ",".join((good | {"Age": "old"}).values())]
    (tmp_path / "in.csv").write_text("\n".join(lines) + "\n")
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    layers.run_etl(spark, str(tmp_path / "in.csv"), out, quarantine=bad).collect()
    assert read_layer(spark, f"{out}/bronze").count() == 1
    assert "old" in read_layer(spark, bad).first()[S.CORRUPT]


def test_a_cluster_without_a_shared_folder_is_refused(monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session())
