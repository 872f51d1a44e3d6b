from pyspark.sql import Row

from labelkit.operators import clean as C
from labelkit.spec import BANK, CONTACTS
from labelkit.streaming.scoring import clean_stream


def bank_row(**kw):
    base = {n: None for n, _ in BANK.columns}
    base.update(kw)
    return base


def test_clean_column_order_and_count(spark):
    df = spark.createDataFrame([bank_row(age=30, pdays=-1, duration=10, y="yes")], BANK.schema())
    out = C.clean(df, BANK)
    raw = [n for n, _ in BANK.columns if n not in ("pdays", "duration")]
    assert out.columns == raw + ["prev_contacted", "pdays_clean", "label"]
    assert len(out.columns) == 18  # published: 45211 x 18
    kept = C.clean(df, BANK, keep_leakage=True)
    assert "duration" in kept.columns and len(kept.columns) == 19


def test_caps_sentinels_labels_null_rules(spark):
    rows = [
        bank_row(age=1, campaign=None, previous=None, pdays=-1, y="yes"),
        bank_row(age=2, campaign=50, previous=3, pdays=5, y="no"),
        bank_row(age=3, campaign=34, previous=35, pdays=None, y=None),
        bank_row(age=4, campaign=1, previous=0, pdays=0, y="YES"),
    ]
    out = {r.age: r for r in C.clean(spark.createDataFrame(rows, BANK.schema()), BANK).collect()}
    # least() skips nulls -> null becomes the cap
    assert out[1].campaign == 34 and out[1].previous == 34
    assert out[2].campaign == 34 and out[2].previous == 3
    assert out[3].previous == 34
    # Sentinel flag / replacement; null pdays -> flag 1, clean null
    assert (out[1].prev_contacted, out[1].pdays_clean) == (0, 0)
    assert (out[2].prev_contacted, out[2].pdays_clean) == (1, 5)
    assert (out[3].prev_contacted, out[3].pdays_clean) == (1, None)
    assert (out[4].prev_contacted, out[4].pdays_clean) == (1, 0)
    # Only exact "yes"
    assert [out[i].label for i in (1, 2, 3, 4)] == [1, 0, 0, 0]


def test_cap_keep_null_policy(spark):
    df = spark.createDataFrame([Row(campaign=None), Row(campaign=40)], "campaign int")
    vals = sorted(
        (r.campaign for r in C.cap_values(df, {"campaign": 34}, null_policy="keep").collect()),
        key=lambda v: -1 if v is None else v,
    )
    assert vals == [None, 34]


def test_string_input_is_cast_leniently(spark):
    df = spark.createDataFrame([bank_row(age="abc", balance="12", pdays="-1", y="yes")], BANK.string_schema())
    r = C.clean(df, BANK).first()
    assert r.age is None and r.balance == 12 and r.prev_contacted == 0


def test_feature_sets(spark):
    cats, nums = BANK.features(False, "both")
    assert "pdays_clean" in nums and "prev_contacted" in nums and "duration" not in nums
    assert "pdays_clean" not in BANK.features(False, "drop_pdays_clean")[1]
    assert "prev_contacted" not in BANK.features(False, "drop_prev_contacted")[1]
    assert BANK.features(True, "both")[1][-1] == "duration"
    assert cats == list(BANK.categorical)


def test_stream_cleaning_has_no_label_and_drops_unused(spark):
    df = spark.createDataFrame([bank_row(age=30, pdays=3, y="yes")], BANK.schema())
    out = clean_stream(df, BANK, pdays_features="drop_pdays_clean")
    assert "label" not in out.columns and "pdays_clean" not in out.columns
    assert "y" in out.columns and "prev_contacted" in out.columns


def test_project_available_keeps_order(spark):
    df = spark.createDataFrame([Row(b=1, a=2, c=3)])
    assert C.project_available(df, ["c", "x", "a"]).columns == ["c", "a"]


def test_select_features_contacts(spark):
    df = spark.createDataFrame(
        [Row(contact_id=1, age=1, job="a", education="b", balance=1, day=1, month_no=1, duration=1,
             campaign=1, previous=0, pdays=-1, poutcome="u", y="no")]
    )
    out = C.select_features(C.clean(df, CONTACTS), CONTACTS, pdays_features="drop_pdays_clean")
    assert out.columns[0] == "contact_id" and out.columns[-1] == "label"
    assert "pdays_clean" not in out.columns


def _py_int(v):
    if v is None:
        return None
    try:
        s = str(v).strip()
        return int(s) if s.lstrip("-").isdigit() else None
    except ValueError:
        return None


def _py_clean(row):
    """The cleaning rules written out in plain Python (bank spec, no duration)."""
    out = {}
    for name, _ in BANK.columns:
        if name in ("pdays", "duration"):
            continue
        v = row[name]
        if name in BANK.numeric:
            v = _py_int(v)
        if name in BANK.caps:
            v = BANK.caps[name] if v is None else min(v, BANK.caps[name])
        out[name] = v
    p = _py_int(row["pdays"])
    out["prev_contacted"] = 0 if p == -1 else 1
    out["pdays_clean"] = 0 if p == -1 else p
    out["label"] = 1 if row["y"] == "yes" else 0
    return out


def test_clean_matches_plain_python_rules(spark):
    import random

    rnd = random.Random(13)
    pick = lambda *xs: rnd.choice(xs)
    rows = []
    for _ in range(300):
        r = {}
        for name, _ in BANK.columns:
            if name in BANK.numeric:
                r[name] = pick(None, "abc", "", "-1", str(rnd.randint(-5, 60)), " 7", "3.5")
            else:
                r[name] = pick(None, "yes", "no", "YES", "x")
        rows.append(r)
    df = spark.createDataFrame([tuple(r[n] for n, _ in BANK.columns) for r in rows], BANK.string_schema())
    got = [r.asDict() for r in C.clean(df, BANK).collect()]
    assert got == [_py_clean(r) for r in rows]
