from bazaar.operators.reshape import share_of_total, unpivot
from bazaar.operators.search import apply_selection, current_selection, search_filter


def test_unpivot_drops_null_measures(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("b", None, 2)], "k string, x double, y bigint")
    long = unpivot(df, ["k"], {"x": "X label", "y": "Y label"})
    assert sorted(map(tuple, long.collect())) == [("a", "X label", 1.0), ("b", "Y label", 2.0)]
    assert unpivot(df, ["k"], {"x": "X", "y": "Y"}, keep_nulls=True).count() == 4


def test_share_of_total(spark):
    df = spark.createDataFrame([("m1", "a", 1.0), ("m1", "b", 3.0), ("m2", "a", 0.0), ("m2", "b", 0.0)],
                               "metric string, cat string, value double")
    a = sorted(map(tuple, share_of_total(df, "value", ["metric"]).collect()))
    assert a[0][3] == 0.25 and a[2][3] is None  # zero total -> NULL, not an error


def test_search_terms_word_start_case_insensitive(spark):
    df = spark.createDataFrame([("AK-47 | Redline", "Rifle"), ("M4A4 | Howl", "Rifle"), ("Sticker", "Red team")],
                               "name string, kind string")
    assert {r.name for r in search_filter(df, "red").collect()} == {"AK-47 | Redline", "Sticker"}
    assert {r.name for r in search_filter(df, "red rifle").collect()} == {"AK-47 | Redline"}
    assert search_filter(df, "edline").count() == 0      # not at a word start
    assert search_filter(df, "47").count() == 0          # after a hyphen is not a word start
    assert search_filter(df, "(").count() == 0           # regex characters are literal
    assert search_filter(df, "   ").count() == 3


def test_selection_last_change_wins(spark):
    changes = spark.createDataFrame([("a", 1, "add"), ("a", 2, "remove"), ("b", 1, "add"), ("c", 1, "remove"),
                                     ("c", 3, "add")], "item_name string, seq int, action string")
    sel = {r.item_name for r in current_selection(changes).collect()}
    assert sel == {"b", "c"}
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("c", 4)], "item_name string, v int")
    assert sorted(r.v for r in apply_selection(df, current_selection(changes)).collect()) == [2, 3, 4]


def test_search_reads_every_column(spark):
    df = spark.createDataFrame([("x", 12.5, None, True), ("y", 0.0001, 7, False)], "a string, b double, c bigint, d boolean")
    assert [r.a for r in search_filter(df, "12.5").collect()] == ["x"]
    assert [r.a for r in search_filter(df, "0.0001 false").collect()] == ["y"]
    assert [r.a for r in search_filter(df, "7").collect()] == ["y"]
