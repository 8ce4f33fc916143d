"""Categories are counted before they are collected."""

import pytest

from terrier.operators import preprocessing


def test_many_categories_raise(spark):
    df = spark.range(5000).selectExpr("cast(id as string) many", "if(id % 3 = 0, null, cast(id % 3 as string)) few", "id % 2 = 0 flag")
    assert preprocessing.fit_categories(df, ["few", "flag"]) == {"few": ["1", "2"], "flag": [False, True]}
    assert preprocessing.fit_categories(df.limit(0), ["few"]) == {"few": []}
    with pytest.raises(ValueError, match="many"):
        preprocessing.fit_categories(df, ["few", "many"])
