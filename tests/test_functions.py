from pyspark.sql import functions as F

from glossaria.functions import figures
from glossaria.functions import text as fn


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(f(F.col("c")).alias("r")).first()["r"]


def test_keys(spark):
    d = F.lit("onelect")
    assert one(spark, "GramX", lambda c: fn.prefix_id(d, c)) == "onelect_GramX"
    assert one(spark, None, lambda c: fn.prefix_id(d, c)) == "onelect_"
    assert one(spark, "Key2019b;Other2020", lambda c: fn.prefix_keys(d, c)) == "onelect_Key2019b;onelect_Other2020"
    assert one(spark, " a ;\x1f;", lambda c: fn.prefix_keys(d, c)) == "onelect_a"
    assert one(spark, " ; ", lambda c: fn.prefix_keys(d, c)) is None
    assert one(spark, "a.b", lambda c: fn.prefix_keys(d, c, ".")) == "onelect_a.onelect_b"


def test_booleans_and_numbers(spark):
    assert [one(spark, v, fn.decode_boolean) for v in ("true", "false", "True", "", None)] == [True, False, None, None, None]
    got = [one(spark, v, fn.number) for v in ("28.0", " 1e2 ", ".5", "1.0d", "nan", "abc", "", None, "-inf", "1_0", "0x1")]
    assert got == [28.0, 100.0, 0.5, None, None, None, None, None, float("-inf"), None, None]


def test_combine_and_fragment(spark):
    assert one(spark, "x", lambda c: fn.combine(F.lit(None), c)) == "x"
    assert one(spark, None, lambda c: fn.combine(c, c)) is None
    assert one(spark, "http://a/b#c#Wordlist", fn.url_fragment) == "Wordlist" and one(spark, "plain", fn.url_fragment) == "plain"
    assert one(spark, None, lambda c: fn.contains_pattern(c, "x")) is False


def test_percentages_round_half_to_even(spark):
    pct = lambda a, b, d: one(spark, a, lambda c: figures.percentage(c, F.lit(b), d), "long")
    assert pct(1, 800, 2) == 0.12 and pct(3, 800, 2) == 0.38 and pct(1, 0, 1) == 0.0


def test_sizes_and_versions(spark):
    shown = [one(spark, v, figures.human_size, "long") for v in (0, 1023, 1024, 1536, 2560, 552599552, 3 * 2**40, None)]
    assert shown == ["0 B", "1023 B", "1 KB", "2 KB", "2 KB", "527 MB", "3.0 TB", None]
    assert one(spark, 2915515, figures.thousands, "long") == "2,915,515"
    assert one(spark, "A.20251008", figures.version_parts) == ("A", "20251008") and one(spark, "A", figures.version_parts) is None and one(spark, "A.1.2", figures.version_parts) is None
    assert one(spark, "forms.csv", figures.file_key) == "forms_csv"
    assert one(spark, "A.20251008", lambda c: figures.directory_name("corpus", c, F.lit("core"))) == "corpus-A-core-20251008"
