"""The build of collections from files, trap by trap."""

import hashlib
import json
import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from glossaria.operators import bibliography, enrich, judgments, membership, normalize, quality, release
from glossaria.plans import corpus
from glossaria.schemas import FORMS_WORKING, FORMS_WRITTEN, LANGUAGES, RELEASE_FILES, REPORT
from glossaria.sources import files, sinks
from glossaria.sources.staging import stage

from . import cldf


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    folder = tmp_path_factory.mktemp("cldf") / "data"
    folder.mkdir()
    return str(folder), cldf.write_all(folder)


@pytest.fixture(scope="module")
def full(spark, root):
    made = corpus.process(spark, root[0])
    return corpus.Corpus(**{name: stage(getattr(made, name), name) for name in corpus.Corpus.__dataclass_fields__})


@pytest.fixture(scope="module")
def forms(full):
    return {r["ID"]: r for r in full.forms.collect() if r["Dataset"] != "epsilon"}


def test_discovery_and_rejects(spark, root):
    assert {r[0] for r in files.discover(spark, root[0]).collect()} == {"alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa"}
    found = {(r["Dataset"], r["file_name"], r["reason"]) for r in files.rejects(spark, root[0]).collect()}
    assert found == {("eta", "parameters.csv", "missing file"), ("iota", "forms.csv", "missing column Parameter_ID"), ("kappa", "forms.csv", "too many cells")}
    assert files.skipped(files.rejects(spark, root[0])).first() == (3, "eta;iota;kappa")


def test_no_files_at_all(spark, tmp_path):
    assert files.discover(spark, str(tmp_path)).count() == 0
    assert files.read_table(spark, str(tmp_path), "cognates.csv").count() == 0
    assert files.read_text(spark, str(tmp_path), "sources.bib").count() == 0
    assert files.read_registry(spark, str(tmp_path / "none.csv")).count() == 0


def test_files_are_read_by_their_own_header(spark, root):
    rows = {r["ID"]: r for r in files.read_table(spark, root[0], "forms.csv", ["beta"]).collect()}
    assert rows["1"]["Form"] == 'a, "q"' and rows["2"]["Value"] == "two\nlines" and rows["1"]["Value"] == "NA"
    assert rows["1"]["_header"] == ["Form", "Loan", "ID", "Extra", "Parameter_ID", "Language_ID", "Value"]


def _folder(root, ds, name, parts):
    """A table as a folder of parts."""
    os.makedirs(f"{root}/{ds}/cldf/{name}")
    for part, text in parts.items():
        open(f"{root}/{ds}/cldf/{name}/{part}", "w").write(text)


@pytest.mark.parametrize("most", ["128m", "4k"])
def test_judgments_of_many_parts_are_in_the_order_of_parts(spark, tmp_path, most):
    """Parts of any sizes, in blocks of any size; Spark reads the largest first."""
    cldf.dataset(tmp_path, "ds", forms="ID,Language_ID,Parameter_ID\nf1,L1,P1\nf2,L1,P1\n", languages=cldf.LANGUAGES, parameters=cldf.PARAMETERS)
    filler = "".join(f"x{i},c{i},\n" for i in range(2000))
    parts = {"part-00000.csv": "f1,first,\nf2,a,\n", "part-00001.csv": "f1,second,\n" + filler + "f2,b,b2\nf2,c,\n", "part-00002.csv": "f1,third,x\nf2,d,d4\n", "part-100000.csv": "f1,last,y\n", "part-99999.csv": "f1,last but one,\n"}
    _folder(tmp_path, "ds", "cognates.csv", {k: "Form_ID,Cognateset_ID,Alignment\n" + v for k, v in parts.items()})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", most)
    try:
        rows = {r["ID"]: (r["Cognacy"], r["Alignment"]) for r in corpus.process(spark, str(tmp_path)).forms.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert rows == {"ds_f1": ("ds_first;ds_second;ds_third;ds_last but one;ds_last", "x"), "ds_f2": ("ds_a;ds_b;ds_c;ds_d", "b2")}


def test_parts_are_read_by_their_own_header(spark, tmp_path):
    """Columns in another order, and a column that only one part has: it is the file's, empty in the others."""
    cldf.dataset(tmp_path, "ds", languages="ID,Glottocode\nL1,aaaa1111\n", parameters=cldf.PARAMETERS)
    _folder(tmp_path, "ds", "forms.csv", {"part-0.csv": "ID,Language_ID,Parameter_ID,Value,Form\n1,L1,P1,VAL,FORM\n", "part-1.csv": "ID,Language_ID,Parameter_ID,Form,Value,Glottocode\n2,L1,P1,FORM,VAL,own0001\n", "part-2.csv": ""})
    assert files.rejects(spark, str(tmp_path)).count() == 0
    raw = files.read_table(spark, str(tmp_path), "forms.csv")
    assert {tuple(r["_header"]) for r in raw.collect()} == {("ID", "Language_ID", "Parameter_ID", "Value", "Form", "Glottocode")}
    rows = {r["ID"]: r for r in corpus.process(spark, str(tmp_path)).forms.collect()}
    assert [(rows[k]["Value"], rows[k]["Form"], rows[k]["Glottocode"]) for k in ("ds_1", "ds_2")] == [("VAL", "FORM", None), ("VAL", "FORM", "own0001")]
    flags = normalize.column_flags(raw, ["Glottocode", "Alignment"]).select("has_Glottocode", "has_Alignment").distinct().collect()
    assert [tuple(r) for r in flags] == [(True, False)]
    _folder(tmp_path, "lacks", "forms.csv", {"part-0.csv": "ID,Language_ID,Parameter_ID\n1,L1,P1\n", "part-1.csv": "ID,Language_ID\n2,L1\n"})
    for name in ("cldf-metadata.json", "languages.csv", "parameters.csv"):
        os.symlink(f"{tmp_path}/ds/cldf/{name}", f"{tmp_path}/lacks/cldf/{name}")
    assert {tuple(r) for r in files.rejects(spark, str(tmp_path)).collect()} == {("lacks", "forms.csv", "missing column Parameter_ID")}


def test_headers_take_the_first_bytes_only(spark, tmp_path):
    cldf.dataset(tmp_path, "ds", forms="\ufeff\n\"ID\",\"a\nb\",Language_ID,Parameter_ID,a,a\n" + "1,x,L1,P1,2,3\n" * 20_000, languages=cldf.LANGUAGES, parameters=cldf.PARAMETERS)
    assert files.survey(spark, str(tmp_path)).headers["ds", "forms.csv"] == ["ID", "a\nb", "Language_ID", "Parameter_ID", "a", "a"]


def test_forms_have_the_working_columns(full, forms):
    assert tuple(full.forms.columns) == FORMS_WORKING and tuple(full.written_forms().columns) == FORMS_WRITTEN
    assert len(forms) == 15


def test_keys_lists_flags_and_nulls(forms):
    one = forms["alpha_1"]
    assert (one["Language_ID"], one["Parameter_ID"], one["Local_ID"]) == ("alpha_L1", "alpha_P1", "x1")
    assert one["Source"] == "alpha_K1;alpha_K2" and forms["alpha_2"]["Source"] is None
    assert [forms[f"beta_{k}"]["Loan"] for k in (1, 2, 3, 4)] == [True, False, None, None]
    assert forms["alpha_5"]["Value"] == "NA" and forms["beta_4"]["Value"] is None


def test_judgments_in_file_order_and_first_filled(forms):
    one = forms["alpha_1"]
    assert one["Cognacy"] == "alpha_42;alpha_hand-1;alpha_hand-66"
    assert one["Alignment"] == "n u m a" and one["Doubt"] is True and one["Cognate_Source"] == "alpha_K1"
    assert forms["alpha_3"]["Cognacy"] == "alpha_a;b;alpha_"  # the cell is prefixed once; an empty key still counts
    assert forms["alpha_5"]["Cognacy"] is None and forms["beta_1"]["Cognacy"] is None


def test_own_column_wins_in_the_whole_file(forms):
    assert [forms[f"gamma_{k}"]["Alignment"] for k in (1, 2)] == ["own a", None]
    assert [forms[f"gamma_{k}"]["Glottocode"] for k in (1, 2)] == [None, "own0001"]
    assert forms["gamma_1"]["Glottolog_Name"] == "Alang" and forms["alpha_1"]["Glottocode"] == "aaaa1111"
    assert forms["alpha_1"]["Concepticon_Gloss"] == "HAND" and forms["alpha_3"]["Concepticon_ID"] is None


def test_result_does_not_depend_on_partitions(spark, root, full):
    as_rows = lambda df: sorted(map(str, df.collect()))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert as_rows(corpus.process(spark, root[0]).forms) == as_rows(full.forms)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_languages_numbers(full):
    rows = {r["ID"]: r for r in full.languages.where("Dataset = 'theta'").collect()}
    assert tuple(full.languages.columns) == LANGUAGES
    assert [(rows[f"theta_L{k}"]["Latitude"], rows[f"theta_L{k}"]["Longitude"]) for k in (1, 2, 3)] == [(28.0, None), (None, None), (None, -10.0)]


def test_metadata_and_references(full):
    meta = {r["Dataset"]: r for r in full.metadata.collect()}
    assert meta["alpha"]["CLDF_Module"] == "Wordlist" and meta["alpha"]["Form_Count"] == 6 and meta["alpha"]["Has_Cognates"] and meta["alpha"]["Python_Version"] == "3.11"
    assert meta["zeta"]["Has_Cognates"] and not meta["beta"]["Has_Cognates"]
    assert meta["theta"]["Form_Count"] == 9 and meta["theta"]["Repository_Version"] is None and meta["theta"]["Python_Version"] is None
    refs = {r["Dataset"]: r for r in full.references.collect()}
    assert refs["alpha"]["Glottolog_Version"] == "v4.7" and refs["theta"]["CLTS_Version"] is None


def test_bibliography(spark, full):
    rows = [(r["Dataset"], r["key"], r["text"].split("{")[0]) for r in full.bibliography.orderBy("Dataset", "pos").collect()]
    assert rows == [("alpha", "alpha_K1", "@article"), ("alpha", "alpha_K2", "@book"), ("alpha", None, "@comment"), ("epsilon", "epsilon_K1", "@misc")]
    text = spark.createDataFrame([("d", "@article{Key2019b,\n}\n@comment{a, b}"), ("d", " "), ("d", ""), ("d", None)], "Dataset string, value string")
    assert bibliography.rekey(text).first()["value"] == "@article{d_Key2019b,\n}\n@comment{a, b}"
    assert bibliography.entry_counts(text).first() == (2, 1)
    assert {tuple(r) for r in bibliography.unresolved(full.forms, full.bibliography).collect()} == {("epsilon", "epsilon_K9")}


def test_entries_are_kept_whole(spark):
    """Lines that begin with an at sign, entries on one line, strings and preambles, quotations and parentheses."""
    parts = [
        "% a note, me@x.y {\n", "@misc{A, note={mail to\n@home now}, journal=jrn}", "\n", '@string{jrn = "The } Journal @ {@misc{no, }}"}', "@misc{B, x={y}}", " ", "@misc{C, title={a {b} c}\n, n=\"{\"}\"}", "\n@preamble\n",
        "@Preamble{ \"x\" }", "@misc(D, t={ ) }, u=\") (\")", "@comment{@misc{E, }}", "@misc{F}", "@misc {\n G ,a=1}", "@misc{, x=1}", "@misc{H$1\\\\, x={never closed\n@misc{I, y=1}\n",
    ]
    df = spark.createDataFrame([("d$", "".join(parts))], "Dataset string, value string")
    assert df.select(bibliography.pieces(F.col("value")).alias("p")).first()["p"] == parts
    keys = [r["key"] for r in bibliography.rekeyed_entries(df).orderBy("pos").collect() if r["key"]]
    assert keys == ["d$_A", "d$_B", "d$_C", "d$_D", "d$_F", "d$_G", "d$_H$1\\\\"]
    whole = bibliography.rekey(df).first()["value"]
    assert whole == "".join(parts).replace("@misc{A", "@misc{d$_A").replace("@misc{B", "@misc{d$_B").replace("@misc{C", "@misc{d$_C").replace("(D", "(d$_D").replace("{F", "{d$_F").replace(" G ,", " d$_G ,").replace("{H", "{d$_H")


def test_random_entries_come_back(spark):
    rng = random.Random(11)

    def value(depth):
        inner = "".join(rng.choice(["a", " ", "\n@home ", "@x", '"', "(", ")", ",", "é", "\n@misc{z, ", "{"]) if rng.random() < 0.8 or depth > 2 else value(depth + 1) for _ in range(rng.randint(0, 5)))
        return "{" + inner + "}" * (1 + inner.count("{") - inner.count("}"))

    def quoted():
        return '"' + "".join(rng.choice(["a", "@", "}", " ", "\n@home", value(0)]) for _ in range(rng.randint(0, 4))) + '"'

    texts, made = [], []
    for t in range(150):
        found, text = [], ""
        for k in range(rng.randint(0, 6)):
            fields = ",".join(f"\n f{j} = {rng.choice([value(0), quoted(), '12', 'jrn'])}" for j in range(rng.randint(0, 4)))
            kind, key = rng.choice(["misc", "Article", "string", "comment"]), f"K{t}.{k}"
            found.append((None if kind in ("string", "comment") else key, f"@{kind}{{{key},{fields}}}"))
            text += found[-1][1] + rng.choice(["", " ", "\n\n", "\n% loose\n"])
        texts.append((str(t), text))
        made += [(str(t), *f) for f in found]
    df = spark.createDataFrame(texts, "Dataset string, value string")
    rows = [tuple(r) for r in bibliography.entries(df).where("text like '@%'").orderBy(F.col("Dataset").cast("int"), "pos").select("Dataset", "key", "text").collect()]
    assert rows == made
    assert {(r["Dataset"], r["whole"]) for r in df.select("Dataset", F.array_join(bibliography.pieces(F.col("value")), "").alias("whole")).collect()} == set(texts)


def test_report(full):
    r = full.report().first()
    assert r["summary"]["total_datasets"] == 7 and r["summary"]["total_forms"] == 18
    assert r["summary"]["datasets_with_cognates"] == 4 and r["summary"]["datasets_with_partial_cognacy"] == 2
    assert r["partial_cognacy"]["datasets_with_segment_slice"] == ["delta"] and r["partial_cognacy"]["forms_with_segment_slice"] == 1
    assert r["completeness"]["zeta"]["Segments_null_pct"] == 0.0 and r["completeness"]["alpha"]["Segments_null_pct"] == 50.0
    assert r["completeness"]["beta"]["columns_present"][0] == "Form"
    assert r["referential_integrity"]["orphan_language_ids"] == 2 and r["referential_integrity"]["orphan_parameter_ids"] == 1  # L9 and the empty key
    assert r["version_distribution"]["glottolog"] == {"v4.7": 6}


def test_whole_report(spark, full):
    r = full.report().first()
    alpha, beta, delta = (r["completeness"][d] for d in ("alpha", "beta", "delta"))
    assert alpha["empty_vs_missing"]["Cognacy"] == (2, 4, 0) and beta["empty_vs_missing"]["Cognacy"] == (0, 0, 4)
    assert alpha["empty_vs_missing"]["Source"] == (3, 3, 0) and beta["empty_vs_missing"]["Value"] == (3, 1, 0)
    assert "Alignment" in alpha["columns_absent"] and "Segments" not in alpha["columns_absent"] and set(beta["columns_absent"]) & {"ID", "Form", "Value"} == set()
    assert delta["empty_vs_missing"]["Alignment"] == (0, 0, 2) and r["completeness"]["zeta"]["empty_vs_missing"] is None
    assert r["summary"]["forms_with_multiple_cognatesets"] == 3  # of alpha 1, of delta 2
    assert tuple(r["row_multiplication"]) == (1, 1) and r["referential_integrity"]["invalid_bibtex_references"] == 1
    written = spark.createDataFrame([full.report().toJSON().first()], "string").select(F.from_json("value", REPORT).alias("r")).first()["r"]
    assert written == full.report().select(*written.asDict()).first()


def test_tallies_of_parts_equal_the_whole(full):
    """Per-dataset counts add up the same however datasets are split."""
    counts = ["multiple_cognatesets", "multiple_alignments", "duplicate_ids"]
    whole = tuple(full.tallies.agg(*(F.sum(c) for c in counts)).first())
    halves = full.tallies.groupBy((F.crc32("Dataset") % 3).alias("part")).agg(*(F.sum(c).alias(c) for c in counts))
    assert tuple(halves.agg(*(F.sum(c) for c in counts)).first()) == whole == (3, 1, 1)


def test_rollup_of_parts_equals_whole(spark, full):
    stats = full.stats()
    parts = stats.withColumn("half", F.crc32("Dataset") % 2)
    a = quality.rollup(parts, ["half"]).agg(F.sum("total_forms"), F.sum("datasets_with_cognates")).first()
    b = quality.rollup(stats).first()
    assert tuple(a) == (b["total_forms"], b["datasets_with_cognates"])
    declared = quality.declared_against_actual(full.metadata, stats, ["Dataset"], {"Form_Count": "forms"})
    assert {r["Dataset"] for r in declared.where("Form_Count_agrees").collect()} == {"alpha", "beta", "zeta"}


def test_declared_completeness(full):
    rows = {r["Dataset"]: r for r in quality.declared_completeness(quality.completeness(full.stats(), full.headers), full.metadata).collect()}
    assert rows["theta"]["forms"] == 9 and rows["alpha"]["forms"] == 6 and rows["alpha"]["Segments_null_pct"] == 50.0


def test_duplicate_keys(full):
    assert [tuple(r) for r in enrich.duplicate_keys(full.forms, ["Dataset", "ID"]).collect()] == [("epsilon", "epsilon_1", 2)]


def test_registry_and_collections(spark, root, tmp_path):
    registry = files.read_registry(spark, root[1])
    assert membership.registry_counts(registry).first() == (5, 4, 3)
    assert {r["name"] for r in files.registry_datasets(registry, core_only=True, corecog_only=True).collect()} == {"alpha", "absent"}
    out = corpus.build_corpus(spark, root[0], root[1], str(tmp_path / "out"))
    assert files.registry_datasets(registry).where("name = 'nourl'").count() == 0
    names = lambda c: {r[0] for r in c.forms.select("Dataset").distinct().collect()}
    assert names(out["core"]) == {"alpha", "gamma"} and names(out["corecog"]) == {"alpha", "delta"} and names(out["full"]) > names(out["core"])
    written = spark.read.json(str(tmp_path / "out/core/report")).first()
    assert written["summary"]["total_forms"] == 8
    lazy = corpus.build_corpus(spark, root[0], root[1])
    sinks.dry_run(lazy["core"].forms)
    assert sorted(map(str, lazy["core"].forms.collect())) == sorted(map(str, out["core"].forms.collect()))


def test_exports(spark, full, tmp_path):
    corpus.export(full, str(tmp_path))
    back = spark.read.csv(f"{tmp_path}/forms.csv", header=True, escape='"', multiLine=True)
    rows = {r["ID"]: r for r in back.collect()}
    assert tuple(back.columns) == FORMS_WRITTEN and rows["beta_1"]["Loan"] == "True" and rows["beta_1"]["Form"] == 'a, "q"' and rows["beta_3"]["Loan"] is None
    typed = files.read_published(spark, f"{tmp_path}/forms.csv", FORMS_WRITTEN)
    assert sorted(map(str, typed.collect())) == sorted(map(str, full.written_forms().collect()))
    text = open(f"{tmp_path}/sources.bib").read()
    assert text.index("alpha_K1") < text.index("alpha_K2") < text.index("@comment{x, y}") < text.index("epsilon_K1") and "}\n\n@book{alpha_K2,\n title={Two}" in text
    assert json.loads(open(f"{tmp_path}/validation_report.json").read())["summary"]["total_datasets"] == 7
    assert {f for f in os.listdir(tmp_path) if not f.endswith(".crc")} == set(RELEASE_FILES)


def test_exported_files_are_what_other_tools_read(spark, full, tmp_path):
    """One file with one header, in order, from several parts; its hash is that of its bytes."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        length, sha = sinks.export_csv(corpus.in_order(full.forms), f"{tmp_path}/forms.csv", FORMS_WRITTEN)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    data = (tmp_path / "forms.csv").read_bytes()
    assert (length, sha) == (len(data), hashlib.sha256(data).hexdigest())
    frame = pd.read_csv(tmp_path / "forms.csv", keep_default_na=False)
    assert tuple(frame.columns) == FORMS_WRITTEN and len(frame) == 18
    assert frame["Dataset"].tolist() == sorted(frame["Dataset"]) and frame.set_index("ID").loc["beta_2", "Value"] == "two\nlines"
    again = sinks.export_csv(full.languages.limit(0), f"{tmp_path}/forms.csv")  # takes the place of the file before
    assert (tmp_path / "forms.csv").read_text() == ",".join(LANGUAGES) + "\n" and again[0] == len(",".join(LANGUAGES)) + 1


def test_row_multiplication(spark):
    forms = spark.createDataFrame([("f1",), ("f2",), ("f3",)], "ID string")
    judged = spark.createDataFrame([("f1", 1, "hand-1", "n u m a"), ("f1", 2, "hand-66", "n u - -"), ("f2", 1, "c", "x"), ("f2", 2, "d", "x")], "ID string, pos int, set string, Alignment string")
    rows = judgments.multiply(forms, judged, ["ID"], ["pos"], ["Alignment"], "set", "Cognacy", {"Alignment": "Alignment"}).collect()
    assert sorted((r["ID"], r["Cognacy"], r["Alignment"]) for r in rows if r["ID"] != "f3") == [("f1", "hand-1;hand-66", "n u - -"), ("f1", "hand-1;hand-66", "n u m a"), ("f2", "c;d", "x")]
    assert [r["Cognacy"] for r in rows if r["ID"] == "f3"] == [None]


def test_release(spark):
    dist = spark.createDataFrame([("glottolog", "v4.7", 2), ("glottolog", "v5.0", 1), ("clts", "v2", 1)], "system string, version string, datasets long")
    assert {tuple(r) for r in release.version_range(dist).collect()} == {("glottolog", "v4.7-v5.0"), ("clts", "v2")}
    assert [r[0] for r in spark.createDataFrame([([],), (None,), (["v1"],), (["v2", "v10"],)], "v array<string>").select(release.range_of(F.col("v"))).collect()] == ["unknown", "unknown", "v1", "v10-v2"]
    listed = spark.createDataFrame([("full", "forms.csv", 512, "ab")], "collection string, file_name string, length long, sha256 string")
    rows = release.manifest(listed, "A.20251008", expected=("forms.csv", "sources.bib"))
    assert {(r["file_key"], r["size_shown"]) for r in rows.collect()} == {("forms_csv", "512 B"), ("sources_bib", "N/A")}
    with pytest.raises(Exception, match="LETTER.DATE"):
        release.manifest(listed, "A").collect()
    ledger = release.ledger_upsert(rows.limit(0), rows)
    with pytest.raises(ValueError):
        release.ledger_upsert(ledger, rows)
    assert release.ledger_upsert(ledger, rows, force=True).count() == 2
    assert release.already_released(ledger, "A.20251008").count() == 2
    assert release.gate(rows.select("file_name"), listed, ["file_name"]).first()[0] == "sources.bib"


def test_release_statistics(full):
    systems = {"Glottolog_Version": "glottolog", "CLTS_Version": "clts"}
    r = release.statistics(quality.rollup(full.stats()), quality.version_distribution(full.references, systems), integrity=enrich.integrity(full.forms, full.languages, full.parameters)).first()
    assert (r["forms_count"], r["orphan_languages"], r["glottolog_versions"], r["concepticon_versions"]) == (18, 2, "v4.7", "unknown")


def test_column_flags_and_split(spark, root):
    raw = files.read_table(spark, root[0], "forms.csv", ["alpha", "beta"])
    flags = normalize.column_flags(raw, ["Cognacy"]).select("Dataset", "has_Cognacy").distinct().collect()
    assert {tuple(r) for r in flags} == {("alpha", True), ("beta", False)}
    assert {(r["Dataset"], r["filled"], r["empty"], r["absent"]) for r in quality.missing_split(raw, ["Dataset"], ["Cognacy"], "_header").collect()} == {("alpha", 2, 4, 0), ("beta", 0, 0, 4)}
    assert raw.where("Dataset = 'beta'").select(normalize.absent_columns(["ID", "Cognacy"]).alias("a")).first()["a"] == ["Cognacy"]


def test_cells_of_any_spelling_come_back(spark, tmp_path):
    cells = ["  lead", "trail  ", " ", "\t", "a\n", "\n", "c\r\nd", "a\\b", "a\\", '"q"', 'a"', 'x,"\ny', '\\"x', "NA", "null", "\\n", "#c", "'", "\u2028x", "", None]
    rows = spark.createDataFrame([(str(k), c) for k, c in enumerate(cells)], "ID string, Value string")
    sinks.export_csv(normalize.align(rows, FORMS_WRITTEN), f"{tmp_path}/forms.csv")
    want = {str(k): c or None for k, c in enumerate(cells)}
    assert dict(files.read_published(spark, f"{tmp_path}/forms.csv", FORMS_WRITTEN).select("ID", "Value").collect()) == want
    told = pd.read_csv(f"{tmp_path}/forms.csv", keep_default_na=False, dtype=str)  # as any other tool reads it
    assert {k: v or None for k, v in zip(told["ID"], told["Value"], strict=True)} == want
