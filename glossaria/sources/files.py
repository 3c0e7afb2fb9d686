"""Readers of ``<root>/<dataset>/cldf/<file>`` and of the registry; a file may be a folder of part files, as Spark writes one.

All paths go through Spark's readers and Hadoop's file systems, so a root may lie in any store that Spark reads. Every
reader covers all datasets at once and adds ``Dataset``, the name of the directory. Parts of a file are in the order of the
first number in their names and then of the names; each is read by its own header.
"""

from __future__ import annotations

import csv
import hashlib
import io
import re
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossaria.functions.text import count_character
from glossaria.schemas import FORMS_WORKING, JUDGMENT_COLUMNS, LANGUAGES, OPTIONAL_FILES, PARAMETERS, RELEASE_FILES, REPORT, REQUIRED_COLUMNS, REQUIRED_FILES, schema_of

EXTRA, POSITION, HEADER = "_extra", "_pos", "_header"
#: Where a row stands in a file: the number of its part, the part's name where numbers don't tell the parts of a file apart, the start of the block read, and an ascending number in it.
POSITION_TYPE = "struct<number:bigint,part:string,block:bigint,row:bigint>"
#: Bytes at the start of a table that its header line must fit into, and tables whose headers are read at once.
HEADER_BYTES, HEADERS_TOGETHER = 1 << 16, 16
#: The buffer that bytes of a file run through.
COPY_BYTES = 1 << 20
#: A file of a dataset, its dataset and its name, in the path of the file or of a part of it.
_PLACE = r"^(.*?([^/]+)/cldf/([^/]+))(?:/[^/]+)?$"
#: Columns that have a meaning somewhere, by their name in lower case.
_KNOWN = {c.lower(): c for c in (*FORMS_WORKING, *LANGUAGES, *PARAMETERS, *JUDGMENT_COLUMNS, *(c for cols in REQUIRED_COLUMNS.values() for c in cols))}


def dataset_of(path: Column) -> Column:
    """The dataset of :data:`_PLACE`, by plain cuts: readers tell it anew for each row, and the pattern tries every place in a path."""
    last = F.substring_index(path, "/", -4)
    first, second, third = (F.substring_index(F.substring_index(last, "/", k), "/", -1) for k in (1, 2, 3))
    name = F.when((second == "cldf") & (first != ""), first).when(third == "cldf", second).otherwise("")
    return F.when(name.contains("%"), F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))).otherwise(name)


def _file_of(path: Column) -> Column:
    """The path of a dataset's file without the name of a part."""
    return F.regexp_extract(path, _PLACE, 1)


def _found(load, empty: str, spark: SparkSession) -> DataFrame:
    """What ``load()`` reads, or an empty table if nothing matches its pattern."""
    try:
        return load()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], empty)


def file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """``Dataset``, ``file_name``, ``path``, ``length`` of every file of every dataset; contents are not read."""
    listed = _found(lambda: spark.read.format("binaryFile").load(f"{root}/*/cldf/*").select("path", "length"), "path string, length bigint", spark)
    held = listed.groupBy(_file_of(F.col("path")).alias("path")).agg(F.sum("length").alias("length"))
    return held.select(dataset_of(F.col("path")).alias("Dataset"), F.regexp_extract("path", _PLACE, 3).alias("file_name"), "path", "length")


def fingerprints(spark: SparkSession, root: str, by_content: bool = False) -> DataFrame:
    """``Dataset`` and ``fingerprint``, which changes with the names, lengths and times of the dataset's files, or, ``by_content``, with their bytes.

    Without ``by_content`` no file is read.
    """
    told = [F.sha2("content", 256) if by_content else F.col("modificationTime").cast("string")]
    load = lambda: spark.read.format("binaryFile").load(f"{root}/*/cldf/*").select("path", "length", told[0].alias("state"))
    listed = _found(load, "path string, length bigint, state string", spark).select(dataset_of(F.col("path")).alias("Dataset"), F.regexp_extract("path", _PLACE, 3).alias("file_name"), "path", "length", "state")
    held = listed.where(F.col("file_name").isin(*REQUIRED_FILES, *OPTIONAL_FILES)).groupBy("Dataset").agg(F.array_sort(F.collect_list(F.struct("path", "length", "state"))).alias("files"), F.count_if(F.col("file_name") == REQUIRED_FILES[0]).alias("described"))
    return held.where("described > 0").select("Dataset", F.sha2(F.to_json("files"), 256).alias("fingerprint"))


def discover(spark: SparkSession, root: str) -> DataFrame:
    """The datasets: directories that hold a descriptor, whether or not a registry names them."""
    return file_inventory(spark, root).where(F.col("file_name") == REQUIRED_FILES[0]).select("Dataset").distinct()


@dataclass
class Survey:
    """What lies under a root, as found by one listing and the first bytes of each table: a few lines for each part of a file, on the driver."""

    root: str
    #: Path of each file by its dataset and name; datasets without a descriptor are not in it.
    paths: dict[str, dict[str, str]]
    #: Columns of each CSV file by its dataset and name, as its header spells them: those of all parts, in the order of parts.
    headers: dict[tuple[str, str], list[str]]
    #: The header of each part of a CSV file, by the file's dataset and name and the part's path. Parts of no bytes are not in it.
    parts: dict[tuple[str, str], dict[str, list[str]]] = field(default_factory=dict)
    #: Bytes of each file by its dataset and name.
    lengths: dict[tuple[str, str], int] = field(default_factory=dict)

    def of(self, file_name: str) -> dict[str, str]:
        """Path of this file by dataset."""
        return {d: held[file_name] for d, held in sorted(self.paths.items()) if file_name in held}

    def sizes(self, *file_names: str) -> dict[str, int]:
        """Bytes of these files together by dataset."""
        return {d: sum(self.lengths.get((d, n), 0) for n in file_names) for d in self.paths}

    def without(self, datasets: set[str]) -> Survey:
        return Survey(self.root, {d: p for d, p in self.paths.items() if d not in datasets}, self.headers, self.parts, self.lengths)


def part_order(path: str) -> tuple[int, str]:
    """The place of a part among the parts of its file."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    number = int(found[0]) if (found := re.search("[0-9]+", name)) else -1
    return number if number < 1 << 63 else -1, name


def _part_order(name: Column) -> list[Column]:
    """The same of a column of names."""
    return [F.coalesce(F.regexp_extract(name, "[0-9]+", 0).try_cast("long"), F.lit(-1).cast("long")).alias("number"), name.alias("part")]


def survey(spark: SparkSession, root: str, datasets: Sequence[str] | None = None) -> Survey:
    """The files of all datasets (or those named) and the header of each table. Of the tables only their first bytes are read."""
    listed = _found(lambda: spark.read.format("binaryFile").load(f"{root}/*/cldf/*").select("path", "length"), "path string, length bigint", spark)
    told = listed.select("path", "length", _file_of(F.col("path")).alias("file"), dataset_of(F.col("path")).alias("Dataset"), F.regexp_extract("path", _PLACE, 3).alias("file_name"))
    told = told.where(F.col("file_name").isin(*REQUIRED_FILES, *OPTIONAL_FILES))
    if datasets is not None:
        told = told.where(F.col("Dataset").isin(list(datasets)))
    paths: dict[str, dict[str, str]] = defaultdict(dict)
    held: dict[tuple[str, str], list[str]] = defaultdict(list)
    lengths: dict[tuple[str, str], int] = defaultdict(int)
    for r in told.collect():  # names of files
        paths[r["Dataset"]][r["file_name"]] = r["file"]
        held[r["Dataset"], r["file_name"]].append(r["path"])
        lengths[r["Dataset"], r["file_name"]] += r["length"]
    paths = {d: files for d, files in paths.items() if REQUIRED_FILES[0] in files}
    tables = {k: sorted(held[k], key=part_order) for k in sorted(held) if k[0] in paths and k[1] in REQUIRED_COLUMNS}
    flat = [p for parts in tables.values() for p in parts]
    with ThreadPool(HEADERS_TOGETHER) as pool:
        found = dict(zip(flat, pool.map(lambda p: header_columns(_first_bytes(spark, p)), flat), strict=True))
    parts = {k: {p: found[p] for p in own if found[p]} for k, own in tables.items()}
    headers = {k: list(dict.fromkeys(c for columns in _numbered(own.values()) for c in columns)) for k, own in parts.items()}
    return Survey(root, paths, {k: [c for c, _ in columns] for k, columns in headers.items()}, parts, dict(lengths))


def _numbered(headers) -> list[list[tuple[str, int]]]:
    """Columns of headers, each with how often the header had it before, so that repeated names of one header stay."""
    return [[(c, header[:k].count(c)) for k, c in enumerate(header)] for header in headers]


def _first_bytes(spark: SparkSession, path: str) -> str:
    """The start of a file as text, with its header line."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(at)
    try:
        return bytes(stream.readNBytes(HEADER_BYTES)).decode("utf-8-sig", "replace")
    finally:
        stream.close()


def read_text(spark: SparkSession, root: str, file_name: str, found: Survey | None = None) -> DataFrame:
    """``Dataset`` and ``value``, the whole text of the file, for the datasets that have it (or those of ``found``)."""
    where = f"{root}/*/cldf/{file_name}" if found is None else list(found.of(file_name).values())
    if not where:
        return spark.createDataFrame([], "Dataset string, value string")
    load = lambda: spark.read.text(where, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
    return _found(load, "value string, path string", spark).select(dataset_of(F.col("path")).alias("Dataset"), "value")


def read_descriptors(spark: SparkSession, root: str, found: Survey | None = None) -> DataFrame:
    return read_text(spark, root, REQUIRED_FILES[0], found)


def header_columns(text: str) -> list[str]:
    """The columns of the first line that is not empty."""
    return next((row for row in csv.reader(io.StringIO(text, newline="")) if row), [])


def column_names(header: list[str]) -> list[str]:
    """Names to read a header's columns by, different from each other whatever their case.

    Of a name that comes twice the first stays and the next ones get a number. A name that differs from a known one in
    case only is another column and gets a mark; so does one that the readers add, and an empty one a number.
    """
    names, taken = [], {c.lower() for c in ("Dataset", EXTRA, POSITION, HEADER, "__dataset")}
    for at, c in enumerate(header):
        plain = c or f"unnamed.{at}"
        name, k = plain if _KNOWN.get(plain.lower(), plain) == plain else f"{plain}.other", 0
        base = name
        while name.lower() in taken:
            k += 1
            name = f"{base}.{k}"
        taken.add(name.lower())
        names.append(name)
    return names


def read_table(spark: SparkSession, root: str, file_name: str, datasets: list[str] | None = None, found: Survey | None = None) -> DataFrame:
    """A CSV table of all datasets (or those of ``found``), each part of each file read by its own header.

    Parts are grouped by header line and each group gets a reader of its own, for Spark's reader binds the columns of
    several files by position. Only header lines and paths reach the driver. All cells are strings, ``NA`` is text, an
    empty cell is null; columns are named by :func:`column_names`. Adds ``Dataset`` (a column of that name is left out of
    account), ``_pos`` (orders the rows of a file as in the file, part after part), ``_header`` (the columns of the file: a
    column that only some parts have counts as one of the file's, and as empty in the others; null-ness of a cell doesn't
    tell if its column is there) and ``_extra`` (what stands beyond the last column). No such file at all gives an empty
    table of these four.
    """
    found = survey(spark, root, datasets) if found is None else found
    groups: dict[tuple[tuple[str, ...], tuple[str, ...]], list[str]] = defaultdict(list)
    for dataset in found.of(file_name):
        for path, header in found.parts[dataset, file_name].items():
            groups[tuple(header), tuple(found.headers[dataset, file_name])].append(path)
    numbers = [[part_order(path)[0] for path in found.parts[dataset, file_name]] for dataset in found.of(file_name)]
    named = any(len(set(own)) < len(own) for own in numbers)  # rows carry names of parts only where these tell their order
    parts = [_read_alike(spark, list(header), list(whole), sorted(paths), named) for (header, whole), paths in sorted(groups.items())]
    if not parts:
        return spark.createDataFrame([], f"Dataset string, {POSITION} {POSITION_TYPE}, {HEADER} array<string>, {EXTRA} string")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _read_alike(spark: SparkSession, header: list[str], whole: list[str], paths: list[str], named: bool) -> DataFrame:
    names = column_names(header)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, EXTRA]])
    reader = spark.read.schema(schema).options(header=True, multiLine=True, escape='"', quote='"', encoding="UTF-8", mode="PERMISSIVE", enforceSchema=True)
    rows, place = reader.csv(paths), F.col("_metadata.file_path")
    number, part = _part_order(F.col("_metadata.file_name"))
    position = F.struct(number, part if named else F.lit(None).cast("string").alias("part"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return rows.select("*", dataset_of(place).alias("Dataset"), position.cast(POSITION_TYPE).alias(POSITION), F.array(*map(F.lit, whole)).cast("array<string>").alias(HEADER))


TOO_MANY = "too many cells"
_REJECTS = "Dataset string, file_name string, reason string"


def faults(spark: SparkSession, root: str, found: Survey) -> list[tuple[str, str, str]]:
    """``Dataset``, ``file_name``, ``reason`` for what keeps datasets out and shows without reading a table: some rows for each of them."""
    bad = [(d, n, "missing file") for d, held in found.paths.items() for n in REQUIRED_FILES if n not in held]
    for (d, n), parts in found.parts.items():
        if d in found.paths:
            bad += [(d, n, f"missing column {c}") for c in REQUIRED_COLUMNS[n] if not parts or any(c not in header for header in parts.values())]
    told = read_descriptors(spark, root, found)
    broken = told.where(F.try_parse_json("value").isNull() | ~F.col("value").rlike(r"^\s*\{")).select("Dataset").collect()  # names of directories
    return sorted(bad + [(r["Dataset"], REQUIRED_FILES[0], "broken descriptor") for r in broken])


def rejects(spark: SparkSession, root: str, found: Survey | None = None) -> DataFrame:
    """``Dataset``, ``file_name``, ``reason`` for whatever keeps a dataset out: a missing file, a key column that a part of a file lacks, a descriptor that is no JSON object, a row with too many cells.

    Rows are only read of datasets that have no other fault. A file of no bytes counts as missing, for Spark doesn't list
    it; a directory whose descriptor is missing is no dataset.
    """
    found = survey(spark, root) if found is None else found
    bad = faults(spark, root, found)
    rest = found.without({b[0] for b in bad})
    out = [spark.createDataFrame(bad, _REJECTS)]
    for name in REQUIRED_COLUMNS:
        rows = read_table(spark, root, name, found=rest)
        out.append(rows.where(F.col(EXTRA).isNotNull()).select("Dataset", F.lit(name).alias("file_name"), F.lit(TOO_MANY).alias("reason")).distinct())
    return reduce(DataFrame.union, out)


def accepted(spark: SparkSession, root: str, datasets: Sequence[str] | None = None) -> Survey:
    """The survey of the datasets that nothing keeps out (of all or of those named). Finding faults reads each table once."""
    found = survey(spark, root, datasets)
    return found.without({r["Dataset"] for r in rejects(spark, root, found).select("Dataset").distinct().collect()})  # names of directories


def skipped(rejected: DataFrame) -> DataFrame:
    """One row: how many datasets were left out, and their names."""
    return rejected.agg(F.countDistinct("Dataset").alias("n_skipped"), F.array_join(F.array_sort(F.collect_set("Dataset")), ";").alias("skipped"))


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """``name``, ``url``, ``is_corecog``, ``is_core``; a flag is set by ``TRUE`` alone. A missing file gives no rows."""
    cell = lambda c: F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), "\r", ""))
    load = lambda: spark.read.csv(path, header=True, escape='"', schema="NAME string, URL string, CoreCog string, CORE string")
    rows = _found(load, "NAME string, URL string, CoreCog string, CORE string", spark)
    return rows.select(cell(F.col("NAME")).alias("name"), cell(F.col("URL")).alias("url"), (cell(F.col("CoreCog")) == "TRUE").alias("is_corecog"), (cell(F.col("CORE")) == "TRUE").alias("is_core"))


def registry_datasets(registry: DataFrame, core_only: bool = False, corecog_only: bool = False) -> DataFrame:
    """Registry rows with a name and a URL, of the asked-for collections; both flags ask for both."""
    out = registry.where((F.col("name") != "") & (F.col("url") != ""))
    out = out.where("is_core") if core_only else out
    return out.where("is_corecog") if corecog_only else out


#: Lines of a file that are numbered together, as a power of two.
LINES_TOGETHER = 12


def read_published(spark: SparkSession, path: str, columns: tuple[str, ...]) -> DataFrame:
    """A published CSV table with its declared types; booleans are ``True`` and ``False``, empty cells null.

    Spark's reader gives a file whose cells may hold line feeds to one task, whatever its size. Here tasks read lines of
    their blocks: where a record begins is told by the number of quotes before it, which is summed up over runs of some
    thousand lines, and the lines of each record are put together again.
    """
    load = spark.read.text(path, lineSep="\n").select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    lines = load.withColumns({"run": F.shiftright("row", LINES_TOGETHER), "odd": count_character(F.col("value"), '"') % 2})
    at = Window.partitionBy("file", "block", "run").orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = lines.withColumn("open", (F.sum("odd").over(at) - F.col("odd")) % 2)  # as if no quotation were open where the run begins
    inside = inside.withColumns({"if_closed": F.count_if(F.col("open") == 0).over(at), "if_open": F.count_if(F.col("open") == 1).over(at)})  # records begun so far, by what is so
    runs = inside.groupBy("file", "block", "run").agg(F.sum("odd").alias("quotes"), F.max("if_closed").alias("closed"), F.max("if_open").alias("opened"))  # a row for each run
    before = Window.partitionBy("file").orderBy("block", "run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("within", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
    runs = runs.withColumn("first", F.coalesce(F.sum(F.when(F.col("within"), F.col("opened")).otherwise(F.col("closed"))).over(before), F.lit(0)))
    record = F.col("first") + F.when(F.col("within"), F.col("if_open")).otherwise(F.col("if_closed"))
    placed = inside.join(runs.select("file", "block", "run", "within", "first"), ["file", "block", "run"]).select("file", record.alias("record"), "block", "row", "value")
    whole = placed.where("record > 1").groupBy("file", "record").agg(F.array_join(F.array_sort(F.collect_list(F.struct("block", "row", "value")))["value"], "\n").alias("text"))  # the first record is the header
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema_of(columns))
    cells = F.from_csv("text", kinds, {"multiLine": "true", "lineSep": "\n", "escape": '"', "quote": '"'})
    return whole.where("text <> ''").select(cells.alias("r")).select(*(F.col(f"r.`{c}`") for c in columns))


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """A report that was written as JSON; a missing file is an error. Sections by dataset or system are maps."""
    return spark.read.schema(REPORT).json(path)


def release_files(spark: SparkSession, folder: str, names: tuple[str, ...] = RELEASE_FILES) -> DataFrame:
    """``file_name``, ``path``, ``length``, ``n_parts``, ``sha256`` of a collection's files that are there, of any length.

    A file may be a folder of part files, as Spark writes one; its length is that of all parts and its hash the SHA-256 of
    their SHA-256 in the order of parts. A file alone has its own. Bytes run through buffers of the driver's JVM, several
    files side by side.
    """
    made = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = made.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    listed = [s for s in fs.listStatus(made) if s.getPath().getName() in names] if fs.exists(made) else []

    def told(status) -> tuple[str, str, int, int, str]:
        path = status.getPath()
        parts = [status]
        if status.isDirectory():
            parts = sorted((s for s in fs.listStatus(path) if s.isFile() and not s.getPath().getName().startswith(("_", "."))), key=lambda s: part_order(s.getPath().getName()))
        hashes = [_sha256(spark, s.getPath()) for s in parts]
        whole = hashes[0] if len(hashes) == 1 else hashlib.sha256("".join(hashes).encode()).hexdigest()
        return path.getName(), path.toString(), sum(s.getLen() for s in parts), len(parts), whole

    with ThreadPool(HEADERS_TOGETHER) as pool:
        return spark.createDataFrame(sorted(pool.map(told, listed)), "file_name string, path string, length bigint, n_parts bigint, sha256 string")


def _sha256(spark: SparkSession, path) -> str:
    jvm = spark.sparkContext._jvm
    digest = jvm.java.security.MessageDigest.getInstance("SHA-256")
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(path)
    try:
        jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, jvm.java.security.DigestOutputStream(jvm.java.io.OutputStream.nullOutputStream(), digest), COPY_BYTES, False)
    finally:
        stream.close()
    return bytes(digest.digest()).hex()
