"""Readers: exports in JSON and CSV, JSON lines that may be malformed, id lists, folders and directory walks."""

from __future__ import annotations

import json
import os

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from stratawork.functions.columns import extension, file_name, fold_case, map_headers, message_id_filter, strip
from stratawork.session import own_folder, ship


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_jdbc(spark: SparkSession, url: str, table: str, column: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 8) -> DataFrame:
    """A SQL table, in parallel ranges of a numeric column where given."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if column and bounds:
        r = r.option("partitionColumn", column).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", parts)
    return r.load()


def read_sheet(spark: SparkSession, path: str, mapped: bool = True) -> DataFrame:
    """A CSV with a header row, all text; short rows are filled with null, rows of nulls alone dropped, headers mapped to column names."""
    df = spark.read.option("header", False).option("mode", "PERMISSIVE").option("multiLine", True).csv(path)
    head = df.first()
    names = map_headers(list(head)) if mapped else [h or f"col_{i}" for i, h in enumerate(head)]
    body = spark.read.option("header", True).option("mode", "PERMISSIVE").option("multiLine", True).schema(T.StructType([T.StructField(n, T.StringType()) for n in names])).csv(path)
    return body.na.drop("all")


def column_map(headers: list[str], table: str, spark: SparkSession) -> DataFrame:
    """(source_table, original_name, snake_case_name, position)."""
    rows = [(table, h, n, i) for i, (h, n) in enumerate(zip(headers, map_headers(headers), strict=True))]
    return spark.createDataFrame(rows, "source_table string, original_name string, snake_case_name string, position int")


def read_export(spark: SparkSession, path: str, label: str, root: str = "emails") -> DataFrame:
    """The list under ``root`` of a JSON document, a row an element, stamped with the label; without that list, ValueError."""
    df = spark.read.option("multiLine", True).json(path)
    if root not in df.columns or not isinstance(df.schema[root].dataType, T.ArrayType):
        raise ValueError(f"{path} has no list '{root}'")
    return df.select(F.explode(root).alias("e")).select("e.*").withColumn("_input_source", F.lit(label))


def lenient_records(document, roots=("emails", "messages", "records", "data")) -> list:
    """The records of a parsed JSON document: a list as it is; of an object the value of the first known root that is there, else its first list, else itself; of anything else none."""
    if isinstance(document, list):
        return document
    if not isinstance(document, dict):
        return []
    named = [document[r] for r in roots if r in document]
    lists = [v for v in document.values() if isinstance(v, list)]
    found = (named or lists or [[document]])[0]
    return found if isinstance(found, list) else [found]


def read_lenient(spark: SparkSession, path: str, roots=("emails", "messages", "records", "data")) -> DataFrame:
    """Rows of JSON documents of any usual shape (``lenient_records``), each document in one task; the rows' schema is inferred over all."""
    ship(spark)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            rows = [json.dumps(r, ensure_ascii=False) for text in b.column(0).to_pylist() for r in lenient_records(json.loads(text), roots) if isinstance(r, dict)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], names=["value"])

    lines = spark.read.text(path, wholetext=True).select("value").mapInArrow(run, "value string")
    target = own_folder(spark, "lenient")
    lines.write.text(target)
    return spark.read.json(target)


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(line, value, malformed): every line survives, parsed or not."""
    t = spark.read.text(path).filter(F.trim("value") != "").select(F.col("value").alias("line"))
    v = t.withColumn("value", F.from_json("line", schema, {"mode": "PERMISSIVE"}))
    return v.withColumn("malformed", F.expr("try_parse_json(line)").isNull())


def rewrite_json_lines(df: DataFrame, line: str, field: str, old: list[str], new: str) -> DataFrame:
    """Lines whose top-level ``field`` is one of ``old``, case aside, get ``new``; objects are written out again, malformed and other lines stay as they are."""
    known = [x.lower() for x in old]

    @F.pandas_udf(T.StringType())
    def run(s):
        def one(x):
            try:
                v = json.loads(x)
            except (TypeError, ValueError):
                return x
            if not isinstance(v, dict):
                return x
            if isinstance(v.get(field), str) and v[field].lower() in known:
                v[field] = new
            return json.dumps(v, ensure_ascii=False)

        return s.map(one)

    return df.withColumn(line, run(F.col(line)))


def read_message_ids(spark: SparkSession, path: str) -> DataFrame:
    """(position, message_id): distinct normalised ids of a list in the order of their first places; comments, blanks and a first row that names messages are passed over."""
    t = spark.read.text(path).select(F.monotonically_increasing_id().alias("position"), strip(F.split("value", ",")[0]).alias("v")).filter("v <> '' and not v rlike '^[#;]'")
    head = t.agg(F.min(F.struct("position", "v")).alias("h")).select(F.when(F.lower("h.v").contains("message") & ~F.contains("h.v", F.lit("@")), F.col("h.position")).alias("skipped"))
    ids = t.crossJoin(F.broadcast(head)).filter("skipped is null or position <> skipped")  # one row
    return ids.groupBy(message_id_filter(F.col("v")).alias("message_id")).agg(F.min("position").alias("position")).select("position", "message_id")


def read_folder(spark: SparkSession, path: str, content: bool = False) -> DataFrame:
    """(path, name, modified, length, content) of all files below a folder."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    cols = ["path", file_name(F.col("path")).alias("name"), F.col("modificationTime").alias("modified"), "length"]
    return df.select(*cols, *(["content"] if content else []))


def by_name(files: DataFrame, insensitive: bool = True) -> DataFrame:
    """(name, paths) of a folder: the sorted paths of each base name, case aside where names are told apart without it."""
    return files.groupBy(fold_case(F.col("name"), insensitive).alias("name")).agg(F.array_sort(F.collect_list("path")).alias("paths"))


def read_sample(spark: SparkSession, path: str, chars: int = 500) -> DataFrame:
    """(path, sample, extracted) of text files: their first characters; a file that cannot be read as UTF-8 text is empty and not extracted."""
    raw = read_folder(spark, path, content=True)
    whole = F.try_validate_utf8("content")
    ok = whole.isNotNull()
    return raw.select("path", F.when(ok, F.left(whole, F.lit(chars))).otherwise("").alias("sample"), ok.alias("extracted"))


def macro_names(source: Column) -> Column:
    """The distinct names of procedures and properties in a module's source, in the order of their first places."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(source, F.lit("")), F.lit(r"(?im)^\s*(?:Public |Private |Friend )?(?:Static )?(?:Sub|Function|Property (?:Get|Let|Set))\s+(\w+)"), 1))


def seen_values(lines: DataFrame, file: str, line: str, field: str) -> DataFrame:
    """The distinct values of a top-level field in the first file, by name, that has any."""
    v = lines.select(F.col(file).alias("f"), F.get_json_object(line, f"$.{field}").alias(field)).filter(F.col(field).isNotNull())
    first = v.agg(F.min("f").alias("f"))
    return v.join(F.broadcast(first), "f", "left_semi").select(field).distinct()


class _Unit(InputPartition):
    def __init__(self, root: str, shallow: bool):
        self.root, self.shallow = root, shallow


class WalkSource(DataSource):
    """``walk``: what is below ``path``, a partition for each of its sub-directories and one for what lies beside them.

    A directory is a row with its own numbers of files and sub-directories
    (kind dir, or error where it cannot be read), a file a row of kind file.
    Option depth bounds how deep directories are opened (none: all). Links are
    passed over, or, with option links, followed to directories that the same
    partition has not visited, so cycles end; files met twice by that are told
    apart by ``real``.
    """

    @classmethod
    def name(cls) -> str:
        return "walk"

    def schema(self) -> str:
        return "kind string, path string, real string, directory string, name string, size_bytes bigint, modified double, depth int, files int, subdirs int, error string"

    def reader(self, schema):
        o = self.options
        return _WalkReader(o["path"], int(o.get("depth", "1000000")), o.get("links", "false").lower() == "true")


class _WalkReader(DataSourceReader):
    def __init__(self, root: str, depth: int, links: bool):
        self.root, self.depth, self.links = root.rstrip("/"), depth, links

    def partitions(self):
        subs = sorted(e.path for e in os.scandir(self.root) if e.is_dir(follow_symlinks=self.links)) if self.depth > 0 else []
        return [_Unit(self.root, True), *(_Unit(s, False) for s in subs)]

    def read(self, unit):
        stack, seen = [unit.root], set()
        if not unit.shallow and self.links and os.path.islink(unit.root) and os.path.realpath(unit.root).startswith(os.path.realpath(self.root) + os.sep):
            return  # a link to what another partition reads
        while stack:
            d = stack.pop()
            real, deep = os.path.realpath(d), d[len(self.root) :].count("/")
            if real in seen:
                continue
            seen.add(real)
            try:
                entries = sorted(os.scandir(d), key=lambda e: e.name)
            except OSError as e:
                yield ("error", d, real, os.path.dirname(d), os.path.basename(d), None, None, deep, None, None, type(e).__name__)
                continue
            plain = [e for e in entries if self.links or not e.is_symlink()]
            dirs = [e for e in plain if e.is_dir(follow_symlinks=self.links)]
            files = [e for e in plain if e.is_file(follow_symlinks=self.links)]
            yield ("dir", d, real, os.path.dirname(d), os.path.basename(d), None, None, deep, len(files), len(dirs), None)
            for e in files:
                s = e.stat(follow_symlinks=self.links)
                yield ("file", e.path, os.path.realpath(e.path), d, e.name, s.st_size, s.st_mtime, deep, None, None, None)
            if not unit.shallow and deep < self.depth:
                stack += [e.path for e in dirs]


def _entries(d: str, links: bool, deep: int, bound: int):
    """The rows of a directory as ``walk`` has them, and rows of kind open for what is to be walked below it."""
    real, files, subdirs = os.path.realpath(d), 0, 0
    head = (d, real, os.path.dirname(d), os.path.basename(d), None, None, deep)
    try:
        with os.scandir(d) as found:
            for e in found:
                if e.is_symlink() and not links:
                    continue
                if e.is_dir(follow_symlinks=links):
                    subdirs += 1
                    if deep < bound:
                        yield ("open", e.path, os.path.realpath(e.path), d, e.name, None, None, deep + 1, None, None, None)
                elif e.is_file(follow_symlinks=links):
                    files += 1
                    s = e.stat(follow_symlinks=links)
                    yield ("file", e.path, os.path.realpath(e.path), d, e.name, s.st_size, s.st_mtime, deep, None, None, None)
    except OSError as e:
        yield ("error", *head, None, None, type(e).__name__)
        return
    yield ("dir", *head, files, subdirs, None)


def walk_levels(spark: SparkSession, roots: list[str], depth: int = 1_000_000, links: bool = False, tasks: int | None = None) -> DataFrame:
    """The rows of ``walk`` below several roots, level by level: the directories of a level are dealt to all tasks anew, so a deep or lopsided root is read by many.

    A level's directories that were walked before, by any root or link, are
    taken out by a join with those of the levels above, so roots within one
    another are walked once and cycles of links end; of several paths to a new
    directory the smallest is walked. The driver sees levels alone. Roots that
    are missing are rows of kind error; no roots give no rows.
    """
    import pyarrow as pa

    kinds = [pa.string()] * 5 + [pa.int64(), pa.float64()] + [pa.int32()] * 3 + [pa.string()]
    columns = WalkSource(options={}).schema()
    names = [c.split()[0] for c in columns.split(", ")]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    def opened(batches):
        for b in batches:
            held = []
            for d, deep in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for row in _entries(d, links, deep, depth):
                    held.append(row)
                    if len(held) == 10_000:
                        yield batch(held)
                        held = []
            if held:
                yield batch(held)

    ship(spark)
    target, level = own_folder(spark, "walk"), 0
    n = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))

    @F.pandas_udf("string")
    def real_path(paths: pd.Series) -> pd.Series:
        return paths.map(os.path.realpath)

    start = spark.createDataFrame([(os.path.normpath(r),) for r in roots], "path string")
    frontier = start.groupBy(real_path("path").alias("real")).agg(F.min("path").alias("path")).select("path", F.lit(0).alias("depth"))
    while True:
        frontier.repartition(n, "path").mapInArrow(opened, columns).write.parquet(f"{target}/level={level:06d}")
        rows = spark.read.schema(columns).parquet(target)
        new = spark.read.schema(columns).parquet(f"{target}/level={level:06d}").filter("kind = 'open'").groupBy("real").agg(F.min_by(F.struct("path", "depth"), "path").alias("x"))
        seen = rows.filter("kind in ('dir', 'error')").select("real").distinct()
        frontier = new.join(seen, "real", "left_anti").select("x.path", "x.depth")
        level += 1
        if frontier.isEmpty():
            return rows.filter("kind <> 'open'")


def shallow_stats(walk: DataFrame, left_out: list[str] = ()) -> DataFrame:
    """(path, subdirs, files, size) of each directory of a walk, files with an extension of ``left_out`` not counted."""
    own = walk.filter("kind = 'file'").filter(~extension(F.col("name")).isin(list(left_out)))
    sums = own.groupBy(F.col("directory").alias("path")).agg(F.count("*").alias("files"), F.sum("size_bytes").alias("size"))
    dirs = walk.filter("kind = 'dir'").select("path", "subdirs")
    return dirs.join(sums, "path", "left").select("path", "subdirs", F.coalesce("files", F.lit(0)).alias("files"), F.coalesce("size", F.lit(0)).alias("size"))


def whole_files(walk: DataFrame, extensions: list[str], folders: list[str]) -> DataFrame:
    """The files of a walk but those of system extensions or below a system folder, each real file once."""
    from stratawork.operators.rules import in_system_folder

    f = walk.filter("kind = 'file'").filter(~extension(F.col("name")).isin(extensions) & ~in_system_folder(F.col("directory"), folders))
    return f.groupBy("real").agg(F.min_by(F.struct("path", "directory", "name", "size_bytes", "modified", "depth"), "path").alias("x")).select("x.*")
