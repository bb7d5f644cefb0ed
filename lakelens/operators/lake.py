"""Lake listings by path template (S-1 .. S-8, A-14, A-15).

Input is a file listing DataFrame ``(path, length, modificationTime)`` — from
``spark.read.format('binaryFile')`` (content pruned) or any landed listing. A
template such as ``s3://b/wh/{dept}/{table}/{partition_key[0]}={partition[0]}/*.parquet``
is compiled once on the driver into regular expressions; every file is then
classified with JVM-side expressions, and tables are formed with one
``groupBy(table_path)``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelens.functions.globs import glob_to_regex
from lakelens.functions.scalars import INT_TEXT_RE, NUM_TEXT_RE, col_of

LABEL_RE = re.compile(r"{\s*(\w+)\s*}")
PARTITION_RE = re.compile(r"({\s*partition_key\[(\d+)\]\s*}=)?({\s*partition\[(\d+)\]\s*})")
DEFAULT_FILE_TYPES = ("avro", "csv", "tsv", "parquet", "json")


def listing(spark: SparkSession, root: str) -> DataFrame:
    """S-1: recursive file listing; ``content`` is never read (pruned)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
            .select("path", "length", "modificationTime"))


@dataclass
class PathTemplate:
    uri: str
    file_types: tuple = DEFAULT_FILE_TYPES
    excludes: list = field(default_factory=list)

    # ---- template pieces (driver side) ---------------------------------
    @property
    def labels(self) -> list[str]:
        return LABEL_RE.findall(self.uri)

    @property
    def partitions(self) -> list[tuple[bool, int]]:
        return [(bool(m.group(1)), int(m.group(4))) for m in PARTITION_RE.finditer(self.uri)]

    @property
    def object_path(self) -> str:
        return re.sub(r"^[a-z0-9]+://[^/]+/", "", self.uri)

    def key_regex(self) -> str:
        """S-2: labels and partitions become '*', then glob (``*`` crosses '/')."""
        pattern = self.object_path
        for m in PARTITION_RE.finditer(self.object_path):
            pattern = pattern.replace(m.group(0), "*", 1)
        pattern = LABEL_RE.sub("*", pattern)
        return glob_to_regex(pattern)

    def parse_regex(self) -> str:
        """Whole-uri regex with named groups: labels -> (?<name>.+?), partition
        keys/values -> (?<pkN>.+?)/(?<pvN>.+?), '*' -> .+? (lazy, like a format parser)."""
        out, i = [], 0
        text = self.uri
        token = re.compile(r"{\s*partition_key\[(\d+)\]\s*}|{\s*partition\[(\d+)\]\s*}|{\s*(\w+)\s*}|\*")
        for m in token.finditer(text):
            out.append(re.escape(text[i:m.start()]))
            if m.group(1) is not None:
                out.append(f"(?<pk{m.group(1)}>.+?)")
            elif m.group(2) is not None:
                out.append(f"(?<pv{m.group(2)}>.+?)")
            elif m.group(3) is not None:
                out.append(f"(?<{m.group(3)}>.+?)")
            else:
                out.append(".+?")
            i = m.end()
        out.append(re.escape(text[i:]))
        return "^" + "".join(out) + "$"

    def group_index(self) -> dict[str, int]:
        """Positions of the named groups in ``parse_regex`` (1-based)."""
        names = re.findall(r"\(\?<(\w+)>", self.parse_regex())
        return {n: i + 1 for i, n in enumerate(names)}


def allow_key(t: PathTemplate, key) -> Column:
    """S-2: object key matches the template and its extension is a known file type."""
    k = col_of(key)
    ext = F.lower(F.element_at(F.split(k, r"\."), -1))
    return k.rlike(t.key_regex()) & ext.isin(*t.file_types)


def object_key(path) -> Column:
    """'s3://bucket/a/b.csv' -> 'a/b.csv'."""
    return F.regexp_replace(col_of(path), r"^[A-Za-z0-9]+:/+[^/]+/", "")


def table_name_and_path(t: PathTemplate, path) -> Column:
    """S-6: struct(table_name, table_path). Without a match or a {table}
    label: (basename, path)."""
    p = col_of(path)
    rx = t.parse_regex()
    gi = t.group_index()
    if "table" not in gi:
        return F.struct(F.element_at(F.split(p, "/"), -1).alias("table_name"), p.alias("table_path"))
    depth = t.uri[: t.uri.find("{table}")].count("/")
    uri_parts = t.uri.split("/")
    label_pos = {lb: i for i, part in enumerate(uri_parts) for lb in [LABEL_RE.fullmatch(part.strip())] if lb}
    if all(lb in {m.group(1) for m in label_pos} for lb in t.labels):
        # Every label fills a whole path segment: read it by position (plain
        # string functions) instead of running the template regex per label.
        pos = {m.group(1): i for m, i in label_pos.items()}
        matched = (F.length(p) - F.length(F.replace(p, F.lit("/"), F.lit("")))) >= len(uri_parts) - 1
        table = path_segment(p, pos["table"])
        name = F.concat_ws("/", *[path_segment(p, pos[lb]) for lb in t.labels])
        prefix = F.substring_index(p, "/", depth)
    else:
        matched = p.rlike(rx)
        table = F.regexp_extract(p, rx, gi["table"])
        prefix = F.array_join(F.slice(F.split(p, "/"), 1, depth), "/")
        name = F.concat_ws("/", *[F.regexp_extract(p, rx, gi[lb]) for lb in t.labels if lb in gi])
    return F.when(matched, F.struct(name.alias("table_name"), F.concat(prefix, F.lit("/"), table).alias("table_path"))) \
        .otherwise(F.struct(F.element_at(F.split(p, "/"), -1).alias("table_name"), p.alias("table_path")))


def inferred_type(raw) -> Column:
    """Partition value type: int64, double, datetime or string (first that parses);
    integers beyond 64 bits are doubles."""
    v = col_of(raw)
    whole = v.rlike(INT_TEXT_RE)
    return (F.when(whole & ((F.length(v) <= 18) | v.try_cast("long").isNotNull()), F.lit("int64"))
            .when(whole | v.rlike(NUM_TEXT_RE), F.lit("double"))
            .when(v.rlike(r"^\d{4}[-/]\d{1,2}[-/]\d{1,2}") & F.coalesce(
                F.try_to_timestamp(v, F.lit("yyyy-MM-dd")), F.try_to_timestamp(v, F.lit("yyyy-MM-dd HH:mm:ss")),
                F.try_to_timestamp(v, F.lit("yyyy/MM/dd"))).isNotNull(), F.lit("datetime"))
            .otherwise(F.lit("string")))


def path_segment(path: Column, i: int) -> Column:
    """The i-th '/'-separated segment (0-based), '' when the path is shorter."""
    return F.when(F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit(""))) >= i,
                  F.substring_index(F.substring_index(path, "/", i + 1), "/", -1))


def partitions(t: PathTemplate, path) -> Column:
    """S-7: array<struct<name, raw_value, index, inferred_type>> by position in
    the template; unnamed partitions are called 'Unnamed column N'."""
    p = col_of(path)
    uri_parts = t.uri.split("/")
    items = []
    for named, idx in t.partitions:
        label = ("{partition_key[%d]}={partition[%d]}" % (idx, idx)) if named else ("{partition[%d]}" % idx)
        pos = next(i for i, part in enumerate(uri_parts) if part.replace(" ", "") == label)
        seg = path_segment(p, pos)
        if named:
            # key=value split at the last '=' (plain string functions, no regex)
            val = F.substring_index(seg, "=", -1)
            key = F.substring(seg, F.lit(1), F.length(seg) - F.length(val) - 1)
            ok = seg.contains("=")
            items.append(F.when(ok, F.struct(key.alias("name"), val.alias("raw_value"), F.lit(idx).alias("index"),
                                             inferred_type(val).alias("inferred_type"))))
        else:
            items.append(F.struct(F.lit(f"Unnamed column {idx}").alias("name"), seg.alias("raw_value"),
                                  F.lit(idx).alias("index"), inferred_type(seg).alias("inferred_type")))
    if not items:
        return F.array().cast("array<struct<name:string,raw_value:string,index:int,inferred_type:string>>")
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def classify(files: DataFrame, t: PathTemplate) -> DataFrame:
    """Files accepted by the template with their table and partitions.

    Built as a chain of small projections (segments, then raw values, then
    types, then the struct) so that each intermediate value is computed once;
    one large nested expression would be duplicated by the optimizer and can
    exceed the code-generation size limit."""
    ok = files.filter(allow_key(t, object_key("path")))
    tp = table_name_and_path(t, F.col("path"))
    x = ok.select("*", tp["table_name"].alias("table_name"), tp["table_path"].alias("table_path"))
    uri_parts = t.uri.split("/")
    parts = []
    for named, idx in t.partitions:
        label = ("{partition_key[%d]}={partition[%d]}" % (idx, idx)) if named else ("{partition[%d]}" % idx)
        pos = next(i for i, part in enumerate(uri_parts) if part.replace(" ", "") == label)
        seg = f"__seg{idx}"
        x = x.withColumn(seg, path_segment(F.col("path"), pos))
        if named:
            x = x.withColumn(f"__val{idx}", F.substring_index(F.col(seg), "=", -1))
            x = x.withColumn(f"__key{idx}", F.when(F.col(seg).contains("="), F.substring(
                F.col(seg), F.lit(1), F.length(seg) - F.length(f"__val{idx}") - 1)))
        else:
            x = x.withColumn(f"__val{idx}", F.col(seg)).withColumn(f"__key{idx}", F.lit(f"Unnamed column {idx}"))
        x = x.withColumn(f"__type{idx}", inferred_type(F.col(f"__val{idx}")))
        parts.append(F.when(F.col(f"__key{idx}").isNotNull(), F.struct(
            F.col(f"__key{idx}").alias("name"), F.col(f"__val{idx}").alias("raw_value"), F.lit(idx).alias("index"),
            F.col(f"__type{idx}").alias("inferred_type"))))
    # Entry i is partition i (null when its segment is malformed). No lambda
    # filter here: higher-order functions run interpreted, and the optimizer
    # copies an array expression into the filters it infers for explode.
    arr = F.array(*parts) if parts else \
        F.array().cast("array<struct<name:string,raw_value:string,index:int,inferred_type:string>>")
    helper = [c for c in x.columns if c.startswith("__")]
    return x.withColumn("partitions", arr).drop(*helper)


def merge_tables(classified: DataFrame, partitioned: bool) -> DataFrame:
    """A-14: one row per table path. The newest non-empty file wins (ties ->
    smallest path); if no file is non-empty the first by path stays. With
    partitions sizes and file counts add up, without them the winner's own
    size and a count of one are kept."""
    f = F.struct(F.col("path").alias("full_path"), F.col("modificationTime").alias("ts"), F.col("length").alias("size"))
    newest_key = F.struct((-F.unix_micros(F.col("modificationTime").cast("timestamp"))).alias("a"), F.col("path").alias("b"))
    agg = classified.groupBy("table_path").agg(
        F.first("table_name").alias("table_name"),
        F.min_by(F.when(F.col("length") > 0, f), F.when(F.col("length") > 0, newest_key)).alias("__newest"),
        F.min_by(f, F.col("path")).alias("__first"),
        F.sum("length").alias("__sum"),
        F.count(F.lit(1)).alias("__n"),
    )
    w = F.coalesce(F.col("__newest"), F.col("__first"))
    out = agg.select(
        "table_path", "table_name", w["full_path"].alias("full_path"), w["ts"].alias("timestamp"),
        (F.col("__sum") if partitioned else w["size"]).alias("size_in_bytes"),
        (F.col("__n") if partitioned else F.lit(1).cast("long")).alias("number_of_files"),
    )
    return out


def partition_types(classified: DataFrame) -> DataFrame:
    """A-15: per (table, partition name) the unified type: equal -> that type;
    string wins, then double; int64 vs datetime is a conflict (type null)."""
    # explode_outer: a plain explode makes the optimizer add (and push down) a
    # size(partitions) > 0 filter, evaluating the partition expression twice.
    x = classified.select("table_path", F.explode_outer("partitions").alias("p")).filter(F.col("p").isNotNull()) \
        .select("table_path", F.col("p.name").alias("name"), F.col("p.inferred_type").alias("t"))
    g = x.groupBy("table_path", "name").agg(F.collect_set("t").alias("types"))
    n = F.size("types")
    resolved = (F.when(n == 1, F.col("types")[0])
                .when(F.array_contains("types", "string"), F.lit("string"))
                .when(F.array_contains("types", "double") & ~(F.array_contains("types", "int64") & F.array_contains("types", "datetime")),
                      F.lit("double")))
    return g.select("table_path", "name", resolved.alias("type"), resolved.isNull().alias("conflict"))


def integer_order(v: Column) -> Column:
    """Orders integer texts of any length by value, equal values by text."""
    digits = F.regexp_replace(v, "^[+-]?0*", "")
    below = v.startswith("-") & (digits != "")
    size = F.length(digits)
    return F.struct(F.when(below, -size).otherwise(size),
                    F.when(below, F.translate(digits, "0123456789", "9876543210")).otherwise(digits), v)


def newest_partition(classified: DataFrame, levels: int) -> DataFrame:
    """S-4 / W-4: per table, descend level by level into the greatest
    partition value: numerically (integers of any length) when every candidate
    value at that level is an integer, as strings otherwise.

    The descent runs on the distinct partition directories (one row per leaf
    directory, not per file), checkpointed once because every level reads it;
    each level is one aggregation plus a join with a one-row-per-table result.
    ``levels`` is the number of partition labels of the template."""
    from lakelens.session import cut_lineage

    dirs = cut_lineage(classified.select("table_path", "partitions").distinct())
    cur = dirs
    chosen = None
    for i in range(levels):
        v = F.get(F.col("partitions"), i)["raw_value"]
        step = cur.filter(F.size("partitions") > i).groupBy("table_path").agg(
            F.bool_and(v.rlike(r"^[+-]?\d+$")).alias("__int"),
            F.max_by(v, integer_order(v)).alias("__num_max"),
            F.max(v).alias("__str_max"),
            F.first(F.get(F.col("partitions"), i)["name"]).alias("__name"),
        ).select("table_path", F.when(F.col("__int"), F.col("__num_max")).otherwise(F.col("__str_max")).alias(f"__v{i}"),
                 F.col("__name").alias(f"__n{i}"))
        cur = cur.join(step, "table_path").filter(F.get(F.col("partitions"), i)["raw_value"] == F.col(f"__v{i}")) \
            .select("table_path", "partitions")
        chosen = step if chosen is None else chosen.join(step, "table_path")
    if chosen is None:
        return dirs.select("table_path").distinct().withColumn("newest_partition", F.lit(""))
    parts = [F.when(F.col(f"__n{i}").startswith("Unnamed column "), F.col(f"__v{i}"))
             .otherwise(F.concat(F.col(f"__n{i}"), F.lit("="), F.col(f"__v{i}"))) for i in range(levels)]
    return chosen.select("table_path", F.concat_ws("/", *parts).alias("newest_partition"))


def allow_dir(t: PathTemplate, path) -> Column:
    """S-3: a directory path is accepted at its depth by the template prefix
    (labels -> '*'), and not covered by an exclude (an exclude covers its
    descendants, not its ancestors; a trailing '/' or '/*' is ignored)."""
    p = F.regexp_replace(col_of(path), r"/$", "")
    slashes = F.size(F.split(p, "/")) - 1
    uri_parts = t.uri.split("/")
    cond_by_depth = []
    for depth in range(len(uri_parts)):
        prefix = "/".join(uri_parts[:depth + 1])
        prefix = LABEL_RE.sub("*", prefix)
        cond_by_depth.append((slashes == depth) & p.rlike(glob_to_regex(prefix)))
    ok = F.lit(False)
    for c in cond_by_depth:
        ok = ok | c
    parts = F.split(F.regexp_replace(p, r"^[A-Za-z0-9]+://", ""), "/")
    for ex in t.excludes:
        e = re.sub(r"/\*?$", "", ex)
        eparts = re.sub(r"^[A-Za-z0-9]+://", "", e).split("/")
        covered = F.size(parts) >= len(eparts)
        for i, ep in enumerate(eparts):
            covered = covered & F.coalesce(F.get(parts, i).rlike(glob_to_regex(ep)), F.lit(False))
        ok = ok & ~covered
    return ok


def folder_prefixes(files: DataFrame, depth: int, path: str = "path") -> DataFrame:
    """S-5: distinct folder prefixes (first ``depth`` path parts) of a listing."""
    return files.select(F.array_join(F.slice(F.split(F.col(path), "/"), 1, depth), "/").alias("folder")).distinct()


# Pyarrow type names -> SQL type names.
_ARROW_TO_SQL = {
    "int64": "BIGINT", "int32": "INTEGER", "int16": "SMALLINT", "int8": "TINYINT", "string": "VARCHAR",
    "large_string": "VARCHAR", "double": "DOUBLE", "float": "FLOAT", "bool": "BOOLEAN", "date32[day]": "DATE",
    "binary": "BLOB",
}


def _sql_type(t) -> str:
    import pyarrow as pa
    if pa.types.is_timestamp(t):
        return "TIMESTAMP"
    if pa.types.is_list(t) or pa.types.is_large_list(t):
        return _sql_type(t.value_type) + "[]"
    if pa.types.is_decimal(t):
        return f"DECIMAL({t.precision},{t.scale})"
    return _ARROW_TO_SQL.get(str(t), str(t).upper())


FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("column_name", T.StringType()),
    T.StructField("ordinal_position", T.IntegerType()), T.StructField("data_type", T.StringType()),
])


def file_schemas(files: DataFrame, path: str = "path") -> DataFrame:
    """S-8: per file, its columns and types, read from the file footer /
    header inside the tasks (parquet footers, csv/tsv header line, first json
    record); partition of the work = partition of the listing."""
    def read(batches):
        import pandas as pd
        for pdf in batches:
            rows = []
            for p in pdf[path]:
                try:
                    rows.extend(_schema_rows(p))
                except (OSError, ValueError):  # unreadable file: no rows, the job goes on
                    continue
            yield pd.DataFrame(rows, columns=[f.name for f in FILE_SCHEMA.fields])
    return files.select(path).mapInPandas(read, FILE_SCHEMA)


def _open_fs(uri: str):
    """(filesystem, path) for local, s3 / s3a, hdfs and gcs URIs (pyarrow)."""
    import pyarrow.fs as pafs
    u = re.sub(r"^s3a://", "s3://", uri)
    if u.startswith("file:"):
        return pafs.LocalFileSystem(), re.sub(r"^file:(//)?", "", u)
    if "://" not in u:
        return pafs.LocalFileSystem(), u
    return pafs.FileSystem.from_uri(u)


def _schema_rows(p: str) -> list[tuple]:
    fs, local = _open_fs(p)
    ext = local.rsplit(".", 1)[-1].lower()
    if ext == "parquet":
        import pyarrow.parquet as pq
        s = pq.read_schema(local, filesystem=fs)
        return [(p, f.name, i + 1, _sql_type(f.type)) for i, f in enumerate(s)]
    if ext in ("csv", "tsv", "json"):
        import csv
        import io
        with fs.open_input_stream(local) as fh:
            first = io.TextIOWrapper(fh, encoding="utf-8").readline()
        if ext == "json":
            import json
            rec = json.loads(first or "{}")
            return [(p, k, i + 1, type(v).__name__.upper()) for i, (k, v) in enumerate(rec.items())]
        header = next(csv.reader([first], delimiter="\t" if ext == "tsv" else ","), [])
        return [(p, h, i + 1, "VARCHAR") for i, h in enumerate(header)]
    return []
