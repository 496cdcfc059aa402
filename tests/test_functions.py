import hashlib
from datetime import date

from pyspark.sql import functions as F

from omnishelf import functions as fn


def one(spark, column, **values):
    fields = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], fields).select(column.alias("x")).first().x


def test_trim_strips_all_unicode_space(spark):
    assert one(spark, fn.uni_trim("a"), a="\t  Dune 　\n") == "Dune"
    assert one(spark, fn.norm_key("a"), a=" É ") == "é"
    assert one(spark, fn.blank_to_null("a"), a=" \t") is None
    assert one(spark, fn.uni_trim("a"), a="two  words") == "two  words"


def test_packed_ids(spark):
    digests = ["00" * 16, "0f" * 16, "a1" * 16, "ff" * 16]
    others = ["", "A1" * 16, "a1" * 15, "a1" * 16 + "\n", "b7", "x\u00e9"]
    df = spark.createDataFrame([(t,) for t in [*others, *digests, None]], "id string")
    packed = df.select("id", fn.packed_id("id").alias("p"))
    back = packed.orderBy("p").select(fn.unpacked_id("p").alias("id"), F.octet_length("p").alias("n"))
    assert [r.id for r in back.collect()] == [None, *digests, *sorted(others)]
    assert {r.n for r in back.filter("length(id) = 32 AND id = lower(id)").collect()} == {17}


def test_surrogate_key_counts_nulls_and_order(spark):
    text = "Dune-_dbt_utils_surrogate_key_null_-1965"
    want = hashlib.md5(text.encode()).hexdigest()
    key = fn.surrogate_key("a", "b", F.lit(1965))
    assert one(spark, key, a="Dune", b=None) == want


def test_numbers(spark):
    cases = {"": None, "4": 4, "4.0": 4, "3.5": None, "x": None, " 1999 ": 1999, "19x": None}
    for text, want in cases.items():
        assert one(spark, fn.whole_number("a"), a=text) == want, text
    assert one(spark, fn.safe_long("a"), a="4.0") is None
    assert one(spark, fn.safe_double("a"), a="4.5") == 4.5


def test_dates(spark):
    cases = {"2024-02-29": date(2024, 2, 29), "2024-02-30": None, "2024": None, "": None}
    for text, want in cases.items():
        assert one(spark, fn.safe_date("a"), a=text) == want, text


def test_wrappers(spark):
    assert one(spark, fn.strip_sheet_quotes("a"), a='="0143"') == "0143"
    assert one(spark, fn.strip_sheet_quotes("a"), a='=""') == ""
    assert one(spark, fn.strip_number_suffix("a"), a="Ayo (2)") == "Ayo"
    assert one(spark, fn.strip_number_suffix("a"), a="Ayo (live)") == "Ayo (live)"


def test_lists(spark):
    assert one(spark, fn.split_json("a"), a='["x", 1]') == ["x", "1"]
    for text in ("bad", "null", '"x"', '{"k": 1}', None):
        assert one(spark, fn.split_json("a"), a=text) is None
    assert one(spark, fn.first_token("a"), a="A, B") == "A"
    assert one(spark, fn.first_token("a"), a=None) is None
    assert one(spark, fn.json_first("a"), a="[]") is None


def test_first_nonblank_and_labels(spark):
    assert one(spark, fn.first_nonblank("a", "b", "c"), a="", b=None, c="z") == "z"
    flags = {"trakt": F.lit(True), "letterboxd": F.lit(False), "moviebuddy": F.lit(True)}
    assert one(spark, fn.label_from_flags(flags), a="") == "trakt_and_moviebuddy"
