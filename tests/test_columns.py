import hashlib

import pytest

from quarrylake.functions.columns import generate_salt_key
from quarrylake.operators.privacy import filter_rows_for_role, mask_columns, rotate_salt


def expected_key(salt, *values):
    return hashlib.sha256("|".join([salt, *[v or "" for v in values]]).encode()).hexdigest()


def test_salt_key(spark):
    df = spark.createDataFrame([("a@x", "1"), ("a@x", "1"), ("b@x", None), (None, None)], "email string, phone string")
    keyed = generate_salt_key(df, ["email"], salt="s1")
    assert keyed.select("salt_key").distinct().count() == 3
    both = generate_salt_key(keyed, ["email", "phone"], "pair", salt="s2").collect()
    for row in both:
        assert row.salt_key == expected_key("s1", row.email)
        assert row.pair == expected_key("s2", row.email, row.phone)


def test_salt_is_required(spark):
    with pytest.raises(TypeError):
        generate_salt_key(spark.range(1), ["id"])


def test_rotation_gives_both_keys(spark):
    row = rotate_salt(spark.createDataFrame([("a@x",)], "email string"), ["email"], "old", "new").first()
    assert (row.email_salt_key, row.email_salt_key_new) == (expected_key("old", "a@x"), expected_key("new", "a@x"))


def test_mask_and_row_filter(spark, rows):
    df = spark.createDataFrame([("a@x", "US"), (None, "DE"), ("c@x", "FR")], "email string, country string")
    assert rows(mask_columns(df, {"email": "***"}, False), "email") == [("***",), ("***",), (None,)]
    assert rows(mask_columns(df, {"email": "***"}, True)) == rows(df)
    grants = spark.createDataFrame([("eu", "DE"), ("eu", "FR"), ("eu", "FR"), ("us", "US")], "role string, country string")
    assert rows(filter_rows_for_role(df, grants, "eu", "country"), "country") == [("DE",), ("FR",)]
