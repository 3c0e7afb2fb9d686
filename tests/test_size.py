"""Steps that must not grow with the size of a file or the number of datasets."""

from pyspark.sql import functions as F

from glossaria.functions.text import _SPACE, prefix_keys
from glossaria.operators.normalize import align
from glossaria.plans import corpus, file_queries
from glossaria.schemas import FORMS_WRITTEN
from glossaria.sources import files, sinks, staging

from . import cldf
from .conftest import SMALL


def test_published_file_is_read_by_many_tasks(spark, tmp_path):
    odd = ["a\nb", '"', '""\n"', "\n", "", None, "x\r\ny", ',"\n,', " \t", "\r", 'a"b', "\n\n\n" * 50, '"\n' * 33]
    rows = [(f"r{k}", odd[k % len(odd)], None if k % 3 == 0 else k % 3 == 1, "ä" * (k % 7)) for k in range(9000)]
    df = spark.createDataFrame(rows, "ID string, Value string, Loan boolean, Comment string")
    sinks.export_csv(align(df, FORMS_WRITTEN), f"{tmp_path}/forms.csv")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        back = files.read_published(spark, f"{tmp_path}/forms.csv", FORMS_WRITTEN)
        assert len(back.inputFiles()) == 1
        assert "Scan text" in back._jdf.queryExecution().executedPlan().toString() and "Scan csv" not in back._jdf.queryExecution().executedPlan().toString()
        told = sorted(tuple(r) for r in back.select("ID", F.coalesce("Value", F.lit("-")), F.coalesce(F.col("Loan").cast("string"), F.lit("-")), F.coalesce("Comment", F.lit("-"))).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert told == sorted((i, v or "-", "-" if b is None else str(b).lower(), c or "-") for i, v, b, c in rows)


def test_dataset_is_told_without_a_pattern(spark):
    paths = ["file:/r/a%20b+c/cldf/forms.csv", "file:/r/ds/cldf/forms.csv/part-0.csv", "viewfs://s/cldf/cldf/x.csv", "file:/r/cldf/ds/cldf/forms.csv/p", "file:/r/ds/other/forms.csv"]
    by_pattern = F.url_decode(F.regexp_replace(F.regexp_extract("p", files._PLACE, 2), r"\+", "%2B"))
    df = spark.createDataFrame([(p,) for p in paths], "p string").select(by_pattern.alias("a"), files.dataset_of(F.col("p")).alias("b"))
    assert [r["b"] for r in df.collect()] == [r["a"] for r in df.collect()] == ["a b+c", "ds", "s", "ds", ""]
    assert "regexp" not in df.select("b")._jdf.queryExecution().optimizedPlan().toString()


def test_keys_are_prefixed_without_a_list(spark):
    cells = ["K1", "K1;K2", " K1 ; K2 ; ;", ";;", " ", "", None, ";a b;c\n", "\x1c;x\x1f", "a ; b;c d ", " k"]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    bare = lambda c: F.regexp_replace(F.regexp_replace(c, rf"(?U)^{_SPACE}+", ""), rf"(?U){_SPACE}+$", "")
    keys = F.filter(F.transform(F.split("c", ";"), bare), lambda k: k != "")
    by_list = F.nullif(F.array_join(F.transform(keys, lambda k: F.concat(F.lit("d;s_"), k)), ";"), F.lit(""))
    out = df.select(by_list.alias("a"), prefix_keys(F.lit("d;s"), F.col("c")).alias("b"))
    assert [r["b"] for r in out.collect()] == [r["a"] for r in out.collect()]
    assert "transform" not in out.select("b")._jdf.queryExecution().optimizedPlan().toString()


def test_datasets_are_written_from_their_own_rows(spark):
    before = set(staging.staged(spark))
    root = file_queries._write_datasets(spark, SMALL)
    made = [p for p in staging.staged(spark) if p not in before and "/demo-" in p]
    folders = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p).getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(spark._jvm.org.apache.hadoop.fs.Path(p))
    assert sum(any(s.getPath().getName() == "ds=asia" for s in folders(p)) for p in made) == 2  # forms and languages; judgments are not held
    found = files.survey(spark, root)
    assert set(found.of("languages.csv")) == {*file_queries.FORMS, *file_queries.FAULTY}
    assert set(found.of("cognates.csv")) == {*file_queries.FORMS, *file_queries.FAULTY} - {file_queries.WITHOUT_JUDGMENTS}


def test_a_large_file_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """One file of one dataset, whose rows are all alike, and small datasets beside it: no task gets much more than its share, whatever the file's size, and small datasets aren't split."""
    root, n = tmp_path / "data", 24_000
    cldf.dataset(root, "large", languages=cldf.LANGUAGES, parameters=cldf.PARAMETERS, forms="ID,Language_ID,Parameter_ID,Value\n" + "1,L1,P1,value\n" * n)
    for k in range(9):
        cldf.dataset(root, f"small{k}", languages=cldf.LANGUAGES, parameters=cldf.PARAMETERS, forms="ID,Language_ID,Parameter_ID\n" + "".join(f"{i},L1,P1\n" for i in range(40)))
    monkeypatch.setattr(sinks, "TASK_BYTES", 14 * n // 8, raising=False)
    full, bad = corpus.write_full(spark, str(root), lambda table: f"{tmp_path}/out/{table}")
    assert bad == [] and full.forms.count() == n + 360
    held = {r["Dataset"]: r for r in full.forms.groupBy("Dataset", F.input_file_name().alias("file")).count().groupBy("Dataset").agg(F.count("file").alias("files"), F.max("count").alias("most"), F.sum("count").alias("all")).collect()}
    assert held["large"]["files"] >= 8 and held["large"]["most"] <= 1.2 * n / 8 and held["large"]["all"] == n
    assert all(held[f"small{k}"]["files"] == 1 and held[f"small{k}"]["all"] == 40 for k in range(9))
    assert not {sinks.DEAL} & set(spark.read.parquet(f"{tmp_path}/out/forms").columns)


def test_places_of_large_and_small(monkeypatch):
    monkeypatch.setattr(sinks, "TASK_BYTES", 10)
    assert sinks.places({}) == (1, [])
    assert sinks.places({"a": 0}) == (1, [("a", 0, 1)])
    assert sinks.places({"a": 25, "b": 4, "c": 6, "d": 10, "e": 0}) == (5, [("e", 0, 1), ("b", 0, 1), ("c", 0, 1), ("d", 1, 1), ("a", 2, 3)])
    assert sinks.places({"a": 11, "b": 21}) == (5, [("a", 0, 2), ("b", 2, 3)])
