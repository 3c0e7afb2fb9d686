"""Datasets that must not stop each other, plans that read each file once, and a release of what was written."""

import hashlib
import io
import os
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from glossaria.operators import bibliography, normalize, release
from glossaria.plans import corpus
from glossaria.schemas import RELEASE_FILES
from glossaria.sources import files, sinks, staging
from glossaria.sources.staging import stage
from glossaria.streaming import ingest

from . import cldf


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    folder = tmp_path_factory.mktemp("survey") / "data"
    folder.mkdir()
    both = {"languages": cldf.LANGUAGES, "parameters": cldf.PARAMETERS}
    cldf.dataset(folder, "good", forms="ID,Language_ID,Parameter_ID,Value\n1,L1,P1,v\n", cognates="Form_ID,Cognateset_ID\n1,c1\n", sources="@misc{K,\n}\n", **both)
    cldf.dataset(folder, "twice", forms="ID,Language_ID,Parameter_ID,Value,Value,Value.1\n1,L1,P1,first,second,third\n", **both)
    cldf.dataset(folder, "cased", forms="id,ID,Language_ID,Parameter_ID,value,_POS,dataset\nlow,1,L1,P1,other,7,own\n", **both)
    cldf.dataset(folder, "nameless", forms="ID,,Language_ID,Parameter_ID,Value,\n1,x,L1,P1,v,y\n", **both)
    cldf.dataset(folder, "blank", forms="", **both)
    cldf.dataset(folder, "headless", forms="\n", **both)
    cldf.dataset(folder, "wide", forms="ID,Language_ID,Parameter_ID\n1,L1,P1,more\n", **both)
    for name, text in (("badjson", '{"dc:title": '), ("listed", "[1, 2]"), ("nothing", "")):
        cldf.dataset(folder, name, forms="ID,Language_ID,Parameter_ID\n1,L1,P1\n", **both)
        (folder / name / "cldf/cldf-metadata.json").write_text(text)
    (folder / "undescribed" / "cldf").mkdir(parents=True)
    (folder / "undescribed" / "cldf" / "forms.csv").write_text("ID\n1\n")
    return str(folder)


@pytest.fixture(scope="module")
def full(spark, root):
    made = corpus.process(spark, root)
    return corpus.Corpus(**{name: stage(getattr(made, name), name) for name in corpus.Corpus.__dataclass_fields__})


def test_each_fault_is_a_row(spark, root):
    found = {(r["Dataset"], r["file_name"], r["reason"]) for r in files.rejects(spark, root).collect()}
    broken = {(d, "cldf-metadata.json", "broken descriptor") for d in ("badjson", "listed")}
    assert found == broken | {("wide", "forms.csv", "too many cells"), ("blank", "forms.csv", "missing file")} | {("headless", "forms.csv", f"missing column {c}") for c in ("ID", "Language_ID", "Parameter_ID")}


def test_all_others_are_built(full):
    rows = {r["Dataset"]: r for r in full.forms.collect()}
    assert set(rows) == {"good", "twice", "cased", "nameless"} == {r[0] for r in full.metadata.select("Dataset").collect()}
    assert (rows["twice"]["Value"], rows["twice"]["ID"]) == ("first", "twice_1")
    assert (rows["cased"]["Value"], rows["cased"]["ID"]) == (None, "cased_1")
    assert rows["nameless"]["Value"] == "v" and rows["good"]["Cognacy"] == "good_c1"
    told = {r["Dataset"]: r["columns"] for r in full.headers.collect()}
    assert told["twice"] == ["ID", "Language_ID", "Parameter_ID", "Value", "Value", "Value.1"]


def test_names_differ_whatever_their_case():
    assert files.column_names(["Value", "Value", "Value.1", "value", "", "_pos", "x", "X"]) == ["Value", "Value.1", "Value.1.1", "value.other", "unnamed.4", "_pos.1", "x", "X.1"]


def test_presence_flags_go_by_the_spelling(spark, root):
    raw = files.read_table(spark, root, "forms.csv", ["cased", "good"])
    assert {tuple(r) for r in normalize.column_flags(raw, ["Value"]).select("Dataset", "has_Value").collect()} == {("cased", False), ("good", True)}


def test_one_scan_for_each_table_and_header(spark, root):
    """Leaves of the optimised plan: no file is read twice, and nothing of how the datasets were chosen is left in it."""
    good = files.accepted(spark, root)
    groups = {n: {tuple(good.headers[d, n]) for d in good.of(n)} for n in ("forms.csv", "languages.csv", "parameters.csv", "cognates.csv")}
    shown = io.StringIO()
    with redirect_stdout(shown):
        corpus.process(spark, root).forms.explain(True)
    plan = shown.getvalue().split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert plan.count("Relation [") == sum(map(len, groups.values())) and "csv" in plan


def test_no_good_dataset_at_all(spark, root, tmp_path):
    os.symlink(f"{root}/badjson", tmp_path / "badjson")
    made = corpus.process(spark, str(tmp_path))
    assert made.forms.count() == 0 and made.metadata.count() == 0 and made.bibliography.count() == 0 and made.languages.count() == 0


def test_release_of_what_was_exported(spark, full, tmp_path):
    corpus.export(full, f"{tmp_path}/full")
    found = stage(files.release_files(spark, f"{tmp_path}/full").withColumn("collection", F.lit("full")), "found")
    rows = {r["file_name"]: r for r in found.collect()}
    assert set(rows) == set(RELEASE_FILES)
    for name, r in rows.items():
        whole = (tmp_path / "full" / name).read_bytes()
        assert (r["length"], r["n_parts"], r["sha256"]) == (len(whole), 1, hashlib.sha256(whole).hexdigest())
    needed = spark.createDataFrame([("full", n) for n in RELEASE_FILES] + [("core", "forms.csv")], "collection string, file_name string")
    assert [tuple(r) for r in release.gate(needed, found, ["collection", "file_name"]).collect()] == [("core", "forms.csv")]
    listed = stage(release.manifest(found, "A.20251008", expected=RELEASE_FILES), "listed")
    assert {r["archive_name"] for r in listed.collect()} == {"corpus.A.full.20251008.zip"} and listed.where("sha256 is null").count() == 0
    ledger = stage(release.ledger_upsert(listed.limit(0), listed), "ledger")
    assert ledger.count() == len(RELEASE_FILES) and release.already_released(ledger, "A.20251008").count() == len(RELEASE_FILES)
    with pytest.raises(ValueError):
        release.ledger_upsert(ledger, listed)
    assert release.ledger_upsert(ledger, listed, force=True).count() == len(RELEASE_FILES)


def test_single_files_have_their_own_hash(spark, tmp_path):
    (tmp_path / "forms.csv").write_text("ID\n1\n")
    (tmp_path / "notes.txt").write_text("x")
    (tmp_path / "languages.csv").mkdir()
    for k, text in ((10, "b"), (9, "a"), (100, "c")):
        (tmp_path / f"languages.csv/part-{k}.csv").write_text(text)
    (tmp_path / "languages.csv/_SUCCESS").write_text("")
    of_parts = hashlib.sha256("".join(hashlib.sha256(x).hexdigest() for x in (b"a", b"b", b"c")).encode()).hexdigest()
    assert [(r["file_name"], r["length"], r["n_parts"], r["sha256"]) for r in files.release_files(spark, str(tmp_path)).collect()] == [("forms.csv", 5, 1, hashlib.sha256(b"ID\n1\n").hexdigest()), ("languages.csv", 3, 3, of_parts)]
    assert files.release_files(spark, f"{tmp_path}/none").count() == 0


def test_statistics_of_a_stored_report(spark, full, tmp_path):
    sinks.write_report(full.report(), f"{tmp_path}/report")
    report = files.read_report(spark, f"{tmp_path}/report")
    cited = bibliography.entry_counts(spark.createDataFrame([("good", "@misc{K,\n note={a@b}}")], "Dataset string, value string"))
    r = release.report_statistics(report, cited).first()
    assert (r["datasets_count"], r["forms_count"], r["languages_count"], r["cognates_datasets"], r["sources_entries"]) == (4, 4, 8, 1, 2)
    assert (r["glottolog_versions"], r["clts_versions"], r["orphan_languages"]) == ("v4.7", "v2.2", 0) and r["cognate_coverage"] == 25.0
    assert report.first()["completeness"]["twice"]["columns_present"][4] == "Value"
    lacking = spark.createDataFrame([(None,)], "x string").select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in report.schema))
    assert tuple(release.report_statistics(lacking).first())[:2] == (0, 0)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_report(spark, f"{tmp_path}/none")


def test_places_follow_the_order(spark):
    rows = [(d, k) for d in ("b", "a", None) for k in (3, None, 1, 2)] * 30
    df = spark.createDataFrame(rows, "Dataset string, k int").repartition(5)
    got = [(r["Dataset"], r["k"]) for r in corpus.numbered(df, ["k"]).orderBy("place").collect()]
    assert got == sorted(rows, key=lambda r: (r[0] is None, r[0] or "", r[1] is None, r[1] or 0))
    assert corpus.numbered(df, ["k"]).agg(F.countDistinct("place"), F.max("place")).first() == (360, 360)
    assert corpus.numbered(df.limit(0), ["k"]).count() == 0


def test_staged_folders_are_listed_and_deleted(spark):
    before = staging.staged(spark)
    df = stage(spark.range(3), "mine")
    made = [p for p in staging.staged(spark) if p not in before]
    assert len(made) == 1 and df.count() == 3
    staging.delete(spark, [*made, f"{made[0]}-never-made"])
    assert staging.staged(spark) == before and not os.path.exists(made[0])


def test_late_rows_stay_out_of_a_stream(spark, tmp_path):
    schema = "ts timestamp, kind string, value int"
    for k, rows in enumerate(([("2024-01-10 00:00:00", "a", 1)], [("2024-01-01 00:00:00", "a", 1), ("2024-01-09 12:00:00", "a", None)], [("2024-01-20 00:00:00", "a", 1)])):
        spark.createDataFrame(rows, "ts string, kind string, value int").withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = ingest.read_stream(spark, f"{tmp_path}/in", spark.read.schema(schema).parquet(f"{tmp_path}/in").schema)
        counted = ingest.windowed_stats(stream, "ts", "1 day", "2 days", ["kind"], ["value"])
        query = counted.writeStream.outputMode("append").format("parquet").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start(f"{tmp_path}/out")
        query.awaitTermination()
        assert k < 3
    out = {r["window"]["start"].day: (r["n_rows"], r["n_value"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert out == {9: (1, 0), 10: (1, 1)}  # 1 January was too late, 20 January is still open
