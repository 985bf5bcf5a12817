from pyspark.sql import functions as F

from conftest import values
from syncloom.functions import keys as k
from syncloom.functions.hashing import row_hash
from syncloom.operators.changes import fingerprint
from syncloom.schemas import from_source


def one(spark, text, expression, kind="string"):
    frame = spark.createDataFrame([(text,)], f"x {kind}")
    return frame.select(expression(F.col("x"))).first()[0]


def test_padding_keeps_the_rightmost_characters(spark):
    assert [one(spark, n, k.upc, "int") for n in (9, 99, 999)] == ["009", "099", "999"]
    assert one(spark, "12345", k.product_id) == "2345"
    assert one(spark, " 7 ", k.product_id) == "0007"
    assert one(spark, None, k.upc) is None


def test_label_is_null_when_a_part_is(spark):
    frame = spark.createDataFrame([(9, 7), (9, None)], "a int, b int")
    assert values(frame.select(k.sku_label(F.col("a"), F.col("b")))) == [("009-0007",), (None,)]


def test_number_key_reads_padded_text(spark):
    assert one(spark, "009", lambda c: k.number_key(c, 3)) == 9
    assert one(spark, "x09", lambda c: k.number_key(c, 3)) is None


def test_branch_code_follows_the_prefix(spark):
    assert one(spark, "PC0999", k.branch_code) == "0999"


def test_tag_numbers(spark):
    ids = ["AH34_0999_3", "A_1_x", "A_1_", "nounderscore", None, "A_1_12"]
    tagged = [one(spark, i, k.has_tag_number) for i in ids]
    assert tagged == [True, True, True, False, None, True]
    assert [one(spark, i, k.tag_number) for i in ids] == [3, 0, 0, 0, 0, 12]


def test_increase(spark):
    frame = spark.createDataFrame([(5, 3), (3, 5), (3, 3), (3, None), (None, 1)], "a int, b int")
    assert [r[0] for r in frame.select(k.increase(F.col("a"), F.col("b"))).collect()] == [2, 0, 0, 0, 0]


def test_stamp_has_milliseconds(spark):
    frame = spark.sql("select timestamp_ntz'2024-01-02 03:04:05.678901' t")
    assert frame.select(k.stamp(F.col("t"))).first()[0] == "2024-01-02 03:04:05.678"


def test_hash_tells_nulls_blanks_and_borders_apart(spark):
    rows = [("a", None), (None, "a"), ("a", ""), ("", "a"), ("a ", None), ("1:a", "-"), ("-", "1:a")]
    frame = spark.createDataFrame(rows, "x string, y string")
    assert frame.select(row_hash(frame)).distinct().count() == len(rows)


def test_hash_does_not_depend_on_column_order(spark):
    frame = spark.createDataFrame([("a", 1, 2.5, [1, None])], "x string, y int, z double, w array<int>")
    again = frame.select("w", "z", "y", "x")
    assert frame.select(row_hash(frame)).first() == again.select(row_hash(again)).first()


def test_fingerprint_leaves_out_columns(spark):
    frame = spark.createDataFrame([(1, "a", 5), (1, "a", 6)], "id int, x string, t int")
    prints = fingerprint(frame, ["id"], exclude_columns=["t"])
    assert prints.columns == ["id", "hash"]
    assert prints.distinct().count() == 1
    assert fingerprint(frame, ["id"]).distinct().count() == 2


def test_source_columns_are_renamed_typed_and_trimmed(spark):
    frame = spark.createDataFrame(
        [("01", "A1  ", "7", "note ")], "`EMCMP` string, `EMEQP#` string, `EMCATG` string, `EXTRA` string"
    )
    assert values(from_source(frame, "assets")) == [("01", "A1", 7, "note")]
    assert from_source(frame, "assets").columns == ["company", "asset_id", "category", "EXTRA"]
