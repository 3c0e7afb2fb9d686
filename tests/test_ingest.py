"""Ingest of datasets that come, change and go; versions and the stored ledger; how much a build reads."""

import os
import shutil
import time

import pytest
from pyspark.sql import functions as F

from glossaria.operators import quality, release
from glossaria.plans import corpus
from glossaria.sources import files, sinks, versions
from glossaria.streaming import ingest

from . import cldf


@pytest.fixture
def places(tmp_path):
    everything = tmp_path / "all"
    everything.mkdir()
    cldf.write_all(everything)
    root = tmp_path / "data"
    root.mkdir()
    return everything, root, str(tmp_path / "out")


def rows(df):
    return sorted(map(str, df.collect()))


def assert_like_batch(spark, root, target):
    got, want = ingest.read(spark, target), corpus.process(spark, str(root))
    for name in corpus.Corpus.__dataclass_fields__:
        assert getattr(got, name).columns == getattr(want, name).columns
        assert rows(getattr(got, name)) == rows(getattr(want, name)), name


def test_ingest_equals_batch_after_each_step(spark, places):
    everything, root, target = places
    bring = lambda *names: [shutil.copytree(everything / n, root / n) for n in names]
    assert ingest.read(spark, target).forms.count() == 0
    bring("alpha", "beta", "kappa")
    assert ingest.ingest(spark, str(root), target) == 1
    assert_like_batch(spark, root, target)
    assert {r["Dataset"]: r["reason"] for r in ingest.manifest(spark, target)[1].collect()} == {"alpha": None, "beta": None, "kappa": "forms.csv: too many cells"}
    assert ingest.ingest(spark, str(root), target) == 1  # nothing has changed

    bring("delta")
    shutil.rmtree(root / "beta")  # one is gone, one comes, one is mended, one changes under the same path
    (root / "kappa/cldf/forms.csv").write_text("ID,Language_ID,Parameter_ID\n1,L1,P1\n")
    (root / "alpha/cldf/forms.csv").write_text("ID,Language_ID,Parameter_ID\n1,L1,P1\n2,L1,P2\n7,L1,P2\n")
    assert ingest.ingest(spark, str(root), target) == 2
    assert_like_batch(spark, root, target)
    assert ingest.read(spark, target).forms.where("Dataset = 'alpha'").count() == 3

    shutil.rmtree(root / "alpha")
    assert ingest.ingest(spark, str(root), target) == 3
    assert_like_batch(spark, root, target)
    assert ingest.clean(spark, target) == 1 and ingest.clean(spark, target) == 0  # of the first batch nothing is left, of the second some is
    assert {p for p in os.listdir(f"{target}/forms") if p.startswith("batch=")} == {f"batch={r[0]}" for r in ingest.manifest(spark, target)[1].select("batch").distinct().collect() if r[0]}
    assert_like_batch(spark, root, target)
    stats = ingest.read(spark, target).stats()
    assert quality.rollup(stats).first()["total_forms"] == corpus.process(spark, str(root)).forms.count()


def test_same_length_and_time_is_told_by_content(spark, places):
    everything, root, target = places
    shutil.copytree(everything / "theta", root / "theta")
    path = root / "theta/cldf/forms.csv"
    ingest.ingest(spark, str(root), target, by_content=True)
    at = path.stat()
    path.write_text(path.read_text().replace("P1\n", "P2\n"))
    os.utime(path, ns=(at.st_atime_ns, at.st_mtime_ns))
    ingest.ingest(spark, str(root), target, by_content=True)
    assert [r[0] for r in ingest.read(spark, target).forms.select("Parameter_ID").collect()] == ["theta_P2"]


def test_a_batch_commits_as_one(spark, places, monkeypatch):
    """A failure after the third table leaves all tables as they were; the next call makes up for it."""
    everything, root, target = places
    shutil.copytree(everything / "alpha", root / "alpha")
    ingest.ingest(spark, str(root), target)
    before = {name: rows(getattr(ingest.read(spark, target), name)) for name in corpus.Corpus.__dataclass_fields__}
    shutil.copytree(everything / "gamma", root / "gamma")
    (root / "alpha/cldf/languages.csv").write_text("ID,Name\nL1,another\n")
    plain, written = sinks.write_table, []

    def failing(df, path, *more):
        if len(written) == 3:
            raise OSError("no space left")
        written.append(path)
        plain(df, path, *more)

    monkeypatch.setattr(sinks, "write_table", failing)
    with pytest.raises(OSError):
        ingest.ingest(spark, str(root), target)
    monkeypatch.setattr(sinks, "write_table", plain)
    assert len(written) == 3
    assert {name: rows(getattr(ingest.read(spark, target), name)) for name in before} == before
    ingest.ingest(spark, str(root), target)
    assert_like_batch(spark, root, target)


def test_watch(spark, places, tmp_path):
    everything, root, target = places
    shutil.copytree(everything / "zeta", root / "zeta")
    stream = ingest.watch(spark, str(root), target, str(tmp_path / "state"), "1 second")
    try:
        for name in ("theta", None):
            end = time.time() + 90
            while versions.current(spark, target)[0] < (1 if name else 2) and time.time() < end:
                time.sleep(0.5)
            if name:
                shutil.copytree(everything / name, root / ".new" / name)
                os.rename(root / ".new" / name, root / name)
    finally:
        stream.stop()
    assert {r["Dataset"] for r in ingest.manifest(spark, target)[1].collect()} == {"zeta", "theta"}


def test_stored_ledger(spark, tmp_path):
    folder = str(tmp_path / "ledger")
    made = lambda version, sha: release.manifest(spark.createDataFrame([("full", "forms.csv", 512, sha)], "collection string, file_name string, length long, sha256 string"), version)
    assert release.load_ledger(spark, folder)[1].count() == 0
    assert release.record_release(made("A.20250101", "a"), folder) == 1
    assert release.record_release(made("A.20250202", "b"), folder) == 2
    with pytest.raises(ValueError):
        release.record_release(made("A.20250101", "c"), folder)
    assert release.record_release(made("A.20250101", "d"), folder, force=True) == 3
    read, ledger = release.load_ledger(spark, folder)
    assert read == 3 and sorted((r["version"], r["sha256"]) for r in ledger.collect()) == [("A.20250101", "d"), ("A.20250202", "b")]
    other = release.save_ledger(ledger, folder, read)  # another writer is first
    with pytest.raises(versions.LostRace):
        release.save_ledger(release.ledger_upsert(ledger, made("A.20250303", "e")), folder, read)
    assert versions.current(spark, folder)[0] == other == 4 and release.load_ledger(spark, folder)[1].count() == 2


def _bytes_read(spark):
    return sum(s.getBytesRead() for s in spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())


def test_a_build_reads_each_table_once(spark, tmp_path):
    root = tmp_path / "data"
    for name in ("one", "two"):
        cldf.dataset(
            root, name, languages=cldf.LANGUAGES, parameters=cldf.PARAMETERS,
            forms="ID,Language_ID,Parameter_ID,Value\n" + "".join(f"{i},L1,P1,{'value ' * 20}\n" for i in range(60_000)),
            cognates="ID,Form_ID,Cognateset_ID,Comment\n" + "".join(f"{i},{i},c{i % 9},{'comment ' * 20}\n" for i in range(60_000)),
        )
    cldf.dataset(root, "bad", languages=cldf.LANGUAGES, parameters=cldf.PARAMETERS, forms="ID,Language_ID,Parameter_ID\n1,L1,P1\n", cognates="Form_ID,Cognateset_ID\n1,c,too many\n")
    size = sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names)
    before = _bytes_read(spark)
    full, bad = corpus.write_full(spark, str(root), lambda table: f"{tmp_path}/out/{table}")
    read = _bytes_read(spark) - before
    assert bad == [("bad", "cognates.csv", files.TOO_MANY)] and size > 20e6
    assert size <= read <= 1.1 * size, read / size
    assert full.forms.count() == 120_000 and full.forms.agg(F.count("Cognacy")).first()[0] == 120_000
    assert {r["Dataset"] for r in full.metadata.collect()} == {"one", "two"} and full.languages.count() == 4


def test_counters_take_back(spark, tmp_path):
    """A dataset that comes again, or changed, takes the place of what was counted before; so in one stream, in its batches, and in a batch that is run twice."""
    schema, source, state = "ds string, revision int, value string", f"{tmp_path}/in", f"{tmp_path}/state"
    batches = [[("a", 1, "x"), ("a", 1, None), ("b", 1, "x"), (None, None, "x")], [("a", 2, "x"), ("a", 1, "late"), ("c", 1, "x")], [("a", 2, "y"), ("b", 1, "more"), ("b", 0, "late")], [("b", 3, None), (None, 1, "y")]]
    so_far = []
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        so_far += rows
        stream = ingest.read_stream(spark, source, spark.read.parquet(source).schema)
        ingest.run_revised(stream, f"{tmp_path}/out", state, "ds", "revision", ["value"])
        got = {tuple(r) for r in ingest.read_revised(spark, f"{tmp_path}/out").select("ds", "revision", "n_rows", "n_value").collect()}
        assert got == {tuple(r) for r in ingest.revised_stats(spark.createDataFrame(so_far, schema), "ds", "revision", ["value"]).select("ds", "revision", "n_rows", "n_value").collect()}, k
    assert got == {("a", 2, 2, 2), ("b", 3, 1, 0), ("c", 1, 1, 1), (None, 1, 1, 1)}
    shutil.rmtree(state)  # the stream begins anew, its first batches have the numbers that the state has seen
    ingest.run_revised(ingest.read_stream(spark, source, spark.read.parquet(source).schema), f"{tmp_path}/out", state, "ds", "revision", ["value"])
    assert got == {tuple(r) for r in ingest.read_revised(spark, f"{tmp_path}/out").select("ds", "revision", "n_rows", "n_value").collect()}
