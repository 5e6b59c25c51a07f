"""Readers and writers of document collections: JSON papers, JSON lines, sharded indexes, trees, reports.

Paths are Hadoop paths; what lists, renames or deletes goes through the session's file systems.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.functions.text import held_on, norm_space, year_of_path

QUESTION = """qid string, n int, concept string, tags array<string>, question string, solution string, options string,
 correct string, type string, marks_pos double, marks_neg double, confidence string, images array<struct<url:string>>,
 solution_images array<struct<url:string>>"""
PAPER = f"""test_id string, title string, section string, subsection string, subject string, duration_min double,
 max_marks double, question_count int, languages array<string>, scraped_at string, shift int, set_index int,
 questions array<struct<{", ".join(x.strip().replace(" ", ":", 1) for x in QUESTION.replace(chr(10), " ").split(", "))}>>"""
#: Folders that hold no papers.
NOT_PAPERS = ("state", "database", "node_modules", "__pycache__", "venv")


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def listed(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, sorted."""
    fs, p = _fs(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


def scan_papers(spark: SparkSession, root: str, schema: str | StructType = PAPER, skip: Sequence[str] = NOT_PAPERS) -> DataFrame:
    """A row for each JSON document below root that has questions, with path (below root), year, year_source and the date
    it was held; files that do not parse have no questions and are left out, as are denied and dotted folders."""
    raw = spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(root)
    raw = raw.select("*", F.col("_metadata.file_path").alias("__file"))
    base = root.split(":", 1)[-1].rstrip("/").lstrip("/")
    path = F.regexp_replace(F.url_decode("__file"), f"^.*?{base}/", "")
    folders = F.split(path, "/")
    denied = F.exists(F.slice(folders, F.lit(1), F.greatest(F.size(folders) - 1, F.lit(1))), lambda p: (p.isin(*skip) | p.startswith(".")) & (p != F.element_at(folders, -1)))
    found = year_of_path(F.array_join(F.slice(folders, F.lit(1), F.greatest(F.size(folders) - 1, F.lit(0))), "/"), F.col("title"))
    out = raw.withColumn("path", path).filter(~denied & F.col("questions").isNotNull())
    return out.withColumns({"year": found.year, "year_source": found.source, "held_on": held_on(F.col("title")).raw, "held_on_iso": held_on(F.col("title")).iso}).drop("__file")


def in_scope(papers: DataFrame, first: int, last: int) -> tuple[DataFrame, DataFrame]:
    """Papers within the years, and the others with a reason."""
    flag = F.coalesce(F.col("year").between(first, last), F.lit(False))
    reason = F.when(F.col("year").isNull(), "no year").otherwise("year out of range")
    return papers.filter(flag), papers.filter(~flag).withColumn("reason", reason)


def ordered(papers: DataFrame) -> DataFrame:
    """The total order of sinks."""
    return papers.orderBy("exam", "year", F.coalesce("shift", F.lit(0)), "path")


def questions_of(papers: DataFrame) -> DataFrame:
    """A row for each question, with its ordinal from 1."""
    q = papers.select(*[c for c in papers.columns if c != "questions"], F.posexplode("questions").alias("__pos", "q"))
    return q.withColumn("ordinal", F.col("__pos") + 1).drop("__pos")


def read_lines(spark: SparkSession, path: str, schema: str | StructType, strict: bool = True) -> DataFrame:
    """JSON lines (gzip by name too): blank lines are skipped; a bad one raises, or is dropped if not strict. A missing
    path is an empty table. seq: the order of lines within their file, for what depends on it."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema).withColumn("seq", F.lit(0).cast("long"))
    mode = "FAILFAST" if strict else "DROPMALFORMED"
    return spark.read.schema(schema).option("mode", mode).json(path).withColumn("seq", F.monotonically_increasing_id())


def read_document(spark: SparkSession, path: str, default=None):
    """One small JSON document, on the driver."""
    if not exists(spark, path):
        return default
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def write_document(spark: SparkSession, path: str, text: str) -> None:
    """A small text, under a temporary name that then takes the place of the old one in one step: a reader sees the old
    text or the new one, whole."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    tmp = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    how = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    how[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(tmp, fs.makeQualified(p), how)


def write_json(spark: SparkSession, path: str, value) -> None:
    write_document(spark, path, json.dumps(value, indent=2, ensure_ascii=False) + "\n")


def _sorted_columns(df: DataFrame) -> DataFrame:
    return df.select(*(F.col(f"`{c}`") for c in sorted(df.columns)))


def write_lines(df: DataFrame, path: str, append: bool = False, gzip: bool = False) -> None:
    """JSON lines with sorted keys; nulls are kept."""
    w = _sorted_columns(df).write.mode("append" if append else "overwrite").option("ignoreNullFields", False)
    (w.option("compression", "gzip") if gzip else w).json(path)


def write_index(df: DataFrame, path: str, by: str, item: str, most_rows: int = 100_000) -> DataFrame:
    """Writes an index of Parquet files by a column, and returns its manifest: by, records, digest (order-free), files,
    bytes. Only partitions of df are replaced; no file exceeds most_rows."""
    spark = df.sparkSession
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", most_rows).partitionBy(by).parquet(path)
    back = spark.read.parquet(path).select(by, item, F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("b"))
    files = back.groupBy(by, "f", "b").agg(F.count("*").alias("n"), F.sum(F.xxhash64(item).cast("decimal(38,0)")).alias("h"))
    return files.groupBy(by).agg(F.sum("n").alias("records"), F.sum("h").cast("string").alias("digest"), F.count("*").alias("files"), F.sum("b").alias("bytes"))


def read_index(spark: SparkSession, schema: str, *paths: str) -> DataFrame:
    """The first of the paths that exists (an index, JSON lines, gzip lines); an empty table if none does."""
    for p in paths:
        if exists(spark, p):
            return spark.read.parquet(p) if not p.rstrip("/").endswith((".jsonl", ".gz", ".json")) else spark.read.schema(schema).json(p)
    return spark.createDataFrame([], schema)


def file_digests(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """path, bytes, sha256 of every file."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return raw.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


#: The folder of a tree's versions, and the file that says which version has each folder of the first level.
VERSIONS, CURRENT = "_versions", "current.json"


def tree_folders(spark: SparkSession, root: str) -> dict[str, str]:
    """Folders of the first level and the paths that hold them now."""
    held = read_document(spark, f"{root}/{CURRENT}", {})
    return {name: f"{root}/{VERSIONS}/{version}/{name}" for name, version in held.items()}


def _swap(spark: SparkSession, version: str, root: str, whole: bool) -> None:
    """Makes the folders of a written version (of the first level's values, as written: null and escaped ones too) the
    tree's; the others of root stay where they are, or go if whole.

    Nothing is moved: one pointer file is replaced in one step, so a reader sees the tree of before or the new one, and a
    writer that stops anywhere leaves one of both. After that, versions that neither this pointer nor the one before names
    are deleted; the one before stays for those who still read it.
    """
    old = read_document(spark, f"{root}/{CURRENT}", {})
    new = {n: version for n in listed(spark, f"{root}/{VERSIONS}/{version}") if "=" in n}
    write_json(spark, f"{root}/{CURRENT}", new if whole else old | new)
    kept = {version, *old.values(), *new.values()}
    for v in listed(spark, f"{root}/{VERSIONS}"):
        if v not in kept:
            delete(spark, f"{root}/{VERSIONS}/{v}")


def write_tree(df: DataFrame, root: str, levels: Sequence[str], exclude: DataFrame | None = None, on: Sequence[str] = ("qid",), whole: bool = False) -> DataFrame:
    """Rows as JSON lines in a folder for each path of levels, rows that another view owns left out. A value of the first
    level that has rows is replaced with all below it; the others stay, or go if whole. Returns counts by path. The tree
    is read through tree_folders() or leaf_rows()."""
    kept = df.join(exclude.select(*on).distinct(), list(on), "left_anti") if exclude is not None else df
    version = uuid.uuid4().hex
    kept.write.partitionBy(*levels).option("ignoreNullFields", False).json(f"{root}/{VERSIONS}/{version}")
    _swap(df.sparkSession, version, root, whole)
    return kept.groupBy(*levels).agg(F.count("*").alias("rows"))


def leaf_rows(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """All rows below a folder, or of the tree's folders as they are now, with place: the folder of their file below root."""
    folders = sorted(tree_folders(spark, root).values()) if exists(spark, f"{root}/{CURRENT}") else [root]
    if not folders:
        return spark.createDataFrame([], schema).withColumn("place", F.lit(""))
    raw = spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json*").json(folders).select("*", F.col("_metadata.file_path").alias("__f"))
    base = root.split(":", 1)[-1].strip("/")
    below = F.regexp_replace(F.url_decode("__f"), f"^.*?{base}/?({VERSIONS}/[^/]+/)?", "")
    return raw.withColumn("place", F.regexp_replace(below, "/?[^/]+$", "")).drop("__f")


def places(rows: DataFrame, reserved: Sequence[str] = ()) -> DataFrame:
    """place, rows, for every folder that holds rows and is not reserved."""
    kept = rows.filter(~F.col("place").rlike(f"(^|/)({'|'.join(reserved)})(/|$)")) if reserved else rows
    return kept.groupBy("place").agg(F.count("*").alias("rows"))


def number_of(place: Column, pattern: str = r"(?:^|/)0*(\d+)-[^/]*$") -> Column:
    """The number that a folder's name begins with."""
    return F.nullif(F.regexp_extract(place, pattern, 1), F.lit("")).cast("int")


def prune(spark: SparkSession, root: str, keep: Sequence[str], marker: str) -> list[str]:
    """Deletes folders below root that carry the marker file and are not to be kept; their names."""
    gone = [n for n in listed(spark, root) if n not in set(keep) and exists(spark, f"{root}/{n}/{marker}")]
    for n in gone:
        delete(spark, f"{root}/{n}")
    return gone


def write_packs(packs: DataFrame, root: str) -> DataFrame:
    """Packs as JSON lines by kind and their catalogue (kind, packs, questions); kinds of before are replaced."""
    version = uuid.uuid4().hex
    packs.write.partitionBy("kind").json(f"{root}/{VERSIONS}/{version}")
    _swap(packs.sparkSession, version, root, False)
    return packs.groupBy("kind").agg(F.count("*").alias("packs"), F.sum("count").cast("long").alias("questions"))


def searched(df: DataFrame, needle: str, columns: Sequence[str], order: Sequence[str], limit: int) -> DataFrame:
    """Rows with the needle, case ignored, in one of the columns."""
    return df.filter(F.lower(F.concat_ws(" ", *columns)).contains(needle.lower())).orderBy(*order).limit(limit)


def selected(df: DataFrame, search: str = "", id_column: str = "id", **equal: str) -> DataFrame:
    """The filters that are given: equality, case ignored; the search within the id."""
    for c, v in equal.items():
        df = df.filter(F.lower(c) == v.lower()) if v else df
    return df.filter(F.col(id_column).contains(search)) if search else df


def page(rows: DataFrame, group: str, item: str, order: Sequence[str], most: int = 200) -> DataFrame:
    """For each group the first items, joined, and how many more there are. Rows are ranked and cut before they gather."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*order, item))
    first = rows.select(group, *dict.fromkeys([*order, item])).withColumn("__r", rank).filter(F.col("__r") <= most)
    items = F.transform(F.array_sort(F.collect_list(F.struct("__r", F.col(item).alias("__i")))), lambda x: x["__i"])
    first = first.groupBy(F.col(group).alias("__g")).agg(items.alias("items"))
    counts = rows.groupBy(group).agg(F.count("*").alias("__n"))
    return counts.join(first, F.col(group).eqNullSafe(F.col("__g"))).select(group, "items", F.greatest(F.col("__n") - most, F.lit(0)).alias("more"))


def scored(rows: DataFrame, scorer, schema: str, key: str, cache: DataFrame | None = None) -> DataFrame:
    """Answers of an outside scorer (a mapInPandas function) for the keys that the cache lacks, with those it has."""
    if cache is None:
        return rows.mapInPandas(scorer, schema)
    fresh = rows.join(cache.select(key), key, "left_anti").mapInPandas(scorer, schema)
    return cache.unionByName(fresh)


def normal_labels(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: norm_space(F.col(c)) for c in columns})


def pointer(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The named fields, null where df lacks one."""
    return df.select(*(F.col(f) if f in df.columns else F.lit(None).cast("string").alias(f) for f in fields))


def paper_fields(papers: DataFrame, with_questions: bool = False) -> DataFrame:
    return papers if with_questions else papers.drop("questions")


def write_reports(reports: DataFrame, coverage: DataFrame, root: str) -> DataFrame:
    """Papers and flagged papers as JSON lines, and the coverage and the schema as small documents; the flagged papers."""
    spark = reports.sparkSession
    flagged = reports.filter(~F.coalesce(F.col("ok"), F.lit(False)))
    write_lines(reports, f"{root}/papers")
    write_lines(flagged, f"{root}/flagged")
    write_json(spark, f"{root}/coverage.json", {k: v for k, v in coverage.first().asDict().items()})
    write_json(spark, f"{root}/schema.json", json.loads(reports.schema.json()))
    return flagged


def write_rule_leaves(rows: DataFrame, rules: DataFrame, root: str, rule: str = "rule") -> DataFrame:
    """Rows by rule, and a marker row for every rule, those without rows too: rule, count. Folders of before go."""
    spark = rows.sparkSession
    rows.write.mode("overwrite").partitionBy(rule).option("ignoreNullFields", False).json(f"{root}/rows")
    n = rules.select(rule).distinct().join(rows.groupBy(rule).agg(F.count("*").alias("count")), rule, "left").na.fill(0, ["count"])
    write_lines(n, f"{root}/markers")
    return spark.read.schema(f"{rule} int, count long").json(f"{root}/markers")
