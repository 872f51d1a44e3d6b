import json
import os

from pyspark.sql import Row

from labelkit.sources import files as IO
from labelkit.sources import messages as MS
from labelkit.spec import BANK

HEADER = ";".join(n for n, _ in BANK.columns)


def _write(tmp_dir, name, lines):
    p = os.path.join(tmp_dir, name)
    with open(p, "w") as f:
        f.write("\n".join(lines) + "\n")
    return p


def test_csv_edge_rows(spark, tmp_dir):
    good = '44;"admin.";"married";"secondary";"no";100;"yes";"no";"cellular";5;"may";10;2;-1;0;"unknown";"no"'
    bad_int = 'abc;"admin.";"married";"secondary";"no";100;"yes";"no";"cellular";5;"may";10;2;-1;0;"unknown";"yes"'
    short = '7;"short"'
    quoted = '"44";"x";"m";"e";"no";"5";"no";"no";"c";1;"jan";1;1;1;1;"u";"no"'
    p = _write(tmp_dir, "bank.csv", [HEADER, good, bad_int, short, quoted])
    rows = IO.read_delimited(spark, p, BANK).collect()
    assert len(rows) == 4  # all rows kept
    assert rows[0].age == 44 and rows[0].job == "admin." and rows[0].pdays == -1
    assert rows[1].age is None and rows[1].y == "yes"  # N1
    assert rows[2].age == 7 and rows[2].job == "short" and rows[2].y is None  # short row
    assert rows[3].age == 44 and rows[3].balance == 5  # quoted number


def test_csv_binds_by_position(spark, tmp_dir):
    swapped = HEADER.replace("age", "TMP").replace("job", "age").replace("TMP", "job")
    line = '30;"tech";"single";"primary";"no";1;"no";"no";"c";1;"jan";1;1;1;1;"u";"no"'
    p = _write(tmp_dir, "swapped.csv", [swapped, line])
    r = IO.read_delimited(spark, p, BANK).first()
    assert r.age == 30 and r.job == "tech"  # N2: header names not checked


def test_json_decode_rules(spark):
    msgs = spark.createDataFrame(
        [
            Row(value=json.dumps({"age": "12", "job": "x", "balance": 5})),
            Row(value=json.dumps({"age": 3.5, "balance": 99999999999, "job": "y"})),
            Row(value="not json"),
            Row(value=None),
            Row(value=json.dumps({"job": "z", "y": "yes", "extra": 1})),
        ]
    )
    rows = MS.decode_messages(msgs, BANK).collect()
    assert len(rows) == 5  # every row kept (N3)
    assert rows[0].age is None and rows[0].job == "x" and rows[0].balance == 5
    assert rows[1].age is None and rows[1].balance is None and rows[1].job == "y"
    assert all(v is None for v in rows[2]) and all(v is None for v in rows[3])
    assert rows[4].job == "z" and rows[4].age is None


def test_to_messages_writes_nulls_and_parses_ints(spark):
    df = spark.createDataFrame(
        [Row(age="41", job="a", balance="1_0", pdays=None)], "age string, job string, balance string, pdays string"
    )
    value = json.loads(MS.to_messages(df, BANK).first().value)
    assert value == {"age": 41, "job": "a", "balance": None, "pdays": None}


def test_messages_round_trip(spark):
    df = spark.createDataFrame([Row(age=30, job="a", y="no"), Row(age=None, job=None, y="yes")])
    back = MS.decode_messages(MS.to_messages(df, BANK), BANK).select("age", "job", "y").collect()
    assert [tuple(r) for r in back] == [(30, "a", "no"), (None, None, "yes")]


def test_repeat_rows(spark):
    df = spark.range(5)
    out = MS.repeat_rows(df, 3)
    assert out.count() == 15
    assert sorted(r.copy for r in out.filter("id = 0").collect()) == [1, 2, 3]
    assert MS.repeat_rows(df, 2, copy_col=None).columns == ["id"]


def test_metadata_round_trip_and_precedence(spark, tmp_dir):
    from labelkit.session import scratch_path

    path = scratch_path(spark, "meta-test")
    MS.write_metadata(spark, path, {"chosen_model": "GBT", "keep_duration": True,
                                    "pdays_features": "drop_pdays_clean",
                                    "metrics": {"f1": 0.5}, "numeric_cols": ["age", "day"]})
    meta = MS.read_metadata(spark, path)
    assert meta["chosen_model"] == "GBT" and meta["metrics"]["f1"] == 0.5
    assert meta["numeric_cols"] == ["age", "day"] and "generated_at" in meta
    # metadata wins over the flag; flag only when metadata is missing
    assert MS.stream_settings(meta, keep_duration_flag=False) == (True, "drop_pdays_clean")
    assert MS.read_metadata(spark, path + "-missing") is None
    assert MS.stream_settings(None, keep_duration_flag=True) == (True, "both")
    assert MS.stream_settings(None) == (False, "both")


def test_write_table_csv(spark, tmp_dir):
    df = spark.createDataFrame([Row(a=1, b="x")])
    p = os.path.join(tmp_dir, "t")
    IO.write_table(df, p, single_file=True)
    files = [f for f in os.listdir(p) if f.endswith(".csv")]
    assert len(files) == 1
    assert open(os.path.join(p, files[0])).read().splitlines()[0] == "a,b"
