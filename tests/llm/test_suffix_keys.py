"""Keys of rows: alike rows share one, others never do, even where a hash says so."""

from pyspark.sql import functions as F

from cdcspark.llm import suffix_dedup


def test_keys_that_clash_are_named_anew(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (1, "b"), (None, "a"), (3, "")], "doc_id long, text string")
    assert suffix_dedup.keyed(df).select("key").distinct().count() == 5
    real, calls = F.xxhash64, []

    def weak(*cols):
        """The first key tells nothing but the salt."""
        calls.append(cols)
        return real(cols[0]) if len(calls) == 1 else real(*cols)

    monkeypatch.setattr(suffix_dedup.F, "xxhash64", weak)
    assert suffix_dedup.keyed(df).select("key").distinct().count() == 5
    assert len(calls) == 4
