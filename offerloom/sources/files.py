"""File sources."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerloom.functions.text import blank_to_null

SOURCE_FILE = "source_file"


def _reader(spark: SparkSession, glob: str, schema: T.StructType | str | None = None):
    r = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).option("ignoreCorruptFiles", True)
    return r.schema(schema) if schema is not None else r


def unwrap(df: DataFrame, wrapper: str | None = None) -> DataFrame:
    """The rows inside a wrapper object: of ``wrapper``, or of the first column that is a list of objects; else ``df`` itself."""
    lists = [f.name for f in df.schema if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType)]
    name = wrapper or next(iter(lists), None)
    if name is None or name not in df.columns:
        return df
    keep = [c for c in df.columns if c == SOURCE_FILE]
    inside = df.where(F.size(name) > 0).select(*keep, F.inline(name))
    plain = [c for c in df.columns if c not in lists and c not in keep]
    if not wrapper and plain:  # folders that mix wrapped and plain files: rows without the list are records themselves
        inside = inside.unionByName(df.where(F.col(name).isNull()).select(*keep, *plain), allowMissingColumns=True)
    return inside


def read_listings_json(spark: SparkSession, path: str, wrapper: str | None = None, schema=None) -> DataFrame:
    """All ``*.json`` below ``path``: a list, a wrapper object or one object per file, with the source file.

    Files that can't be read or parsed are skipped; :func:`broken_files` lists them.
    """
    df = _reader(spark, "*.json", schema).option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    if "_corrupt_record" in df.columns:
        others = [c for c in df.columns if c != "_corrupt_record"]
        df = df.where(F.col("_corrupt_record").isNull()).select(*others, F.col("_metadata.file_path").alias(SOURCE_FILE))
    else:
        df = df.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))
    return unwrap(df, wrapper)


def broken_files(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """source_file of the files below ``path`` that are no JSON, which the readers skip."""
    text = _reader(spark, glob).option("wholetext", True).text(path)
    return text.where(F.try_parse_json("value").isNull()).select(F.col("_metadata.file_path").alias(SOURCE_FILE))


def read_listings_jsonl(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """One object per line; blank and broken lines are skipped, and a file that is one array, in one line or many, gives its items.

    Only the names of files with an array come to the driver.
    """
    glob, file = "*.{jsonl,json,ndjson}", F.col("_metadata.file_path")
    lines = _reader(spark, glob).text(path)
    arrays = [r.f for r in lines.where(F.startswith(F.ltrim("value"), F.lit("["))).select(file.alias("f")).distinct().collect()]

    def rows(df: DataFrame) -> DataFrame:
        if "_corrupt_record" in df.columns:
            df = df.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
        return df.dropna("all")

    plain = _reader(spark, glob, schema).json(path)
    if not arrays:
        return rows(plain)
    whole = rows(_reader(spark, glob, schema).option("multiLine", True).json([unquote(f) for f in arrays]))
    return rows(plain.where(~file.isin(arrays))).unionByName(whole, allowMissingColumns=True)


def read_listings_csv(spark: SparkSession, path: str, encoding_fallback: str = "ISO-8859-1", sep: str = ",") -> DataFrame:
    """S3: all ``*.csv`` below ``path`` as text columns. Files that aren't valid UTF-8 are read with ``encoding_fallback``.

    Files with the same header and encoding are read together; of each file its name and header come to the driver. No file at all is
    an error. Columns that a file lacks are null.
    """
    lines = _reader(spark, "*.csv").text(path).select("value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("n"))
    first = F.min_by("value", F.when((F.col("at") == 0) & (F.trim("value") != ""), F.col("n")))
    kinds = lines.groupBy("f").agg(first.alias("header"), F.bool_and(F.is_valid_utf8("value")).alias("utf8")).groupBy("header", "utf8").agg(F.collect_list("f").alias("files")).collect()
    if not kinds:
        raise FileNotFoundError(f"no CSV files in {path}")

    def read(files: list[str], encoding: str) -> DataFrame:
        df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("sep", sep).option("encoding", encoding).option("enforceSchema", False).csv(files)
        return df.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))

    out = None
    for k in sorted(kinds, key=lambda k: (k.header or "", k.utf8)):
        part = read([unquote(f) for f in k.files], "UTF-8" if k.utf8 else encoding_fallback)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def read_folder(spark: SparkSession, path: str, source: str = "auto", table: str | None = None) -> DataFrame:
    """Every CSV and Parquet file of a folder as one frame; ``source`` is 'db', 'folder' or 'auto' (the table if it exists)."""
    if source not in ("db", "folder", "auto"):
        raise ValueError(f"unknown source {source}")
    if source == "db" or source == "auto" and table and spark.catalog.tableExists(table):
        return spark.table(table)
    parts = []
    for glob, read in (("*.parquet", lambda r: r.option("mergeSchema", True).parquet(path)), ("*.csv", lambda r: r.option("header", True).option("inferSchema", True).csv(path))):
        try:
            df = read(_reader(spark, glob))
            if df.columns:
                parts.append(df)
        except Exception as e:  # no file of this kind below the folder
            if "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
    if not parts:
        raise FileNotFoundError(f"no CSV or Parquet files in {path}")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)


def read_table(spark: SparkSession, name: str, fallback: str | None = None) -> DataFrame:
    """A stored table, or ``fallback`` if it is missing or empty."""
    if spark.catalog.tableExists(name):
        df = spark.table(name)
        if fallback is None or not df.isEmpty():
            return df
    if fallback is None:
        raise ValueError(f"no table {name}")
    return spark.table(fallback)


def with_source_tag(df: DataFrame, base: str, tail: int = 3, path: Column | None = None, name: str = SOURCE_FILE) -> DataFrame:
    """Provenance: the last ``tail`` parts of ``base`` and the path below it, always with ``/``."""
    p = F.replace(F.col("_metadata.file_path") if path is None else path, F.lit("\\"), F.lit("/"))
    p = F.regexp_replace(F.try_url_decode(F.replace(p, F.lit("+"), F.lit("%2B"))), "^file:/*", "/")
    root = "/" + base.replace("\\", "/").removeprefix("file:").strip("/") + "/"
    ending = "/".join(root.strip("/").split("/")[-tail:])
    below = F.when(F.startswith(p, F.lit(root)), F.concat(F.lit(ending + "/"), F.substr(p, F.lit(len(root) + 1)))).otherwise(F.element_at(F.split(p, "/"), -1))
    return df.withColumn(name, below)


#: Folder names of shops and their canonical names (fixed values).
FOLDERS = {"magazineluiza": "magalu", "magalu": "magalu", "mercadolivre": "mercadolivre", "mercado_livre": "mercadolivre", "ml": "mercadolivre", "pneustore": "pneustore", "pneu_store": "pneustore"}


def meta_from_path(path: Column) -> Column:
    """Struct (marketplace, query, captured_at) of a file path.

    The marketplace is the path part after ``raw`` if it names a shop, else any part that does; captured_at comes from
    ``_YYYYMMDD_HHMMSS``.
    """
    p = F.replace(path, F.lit("\\"), F.lit("/"))
    names = F.create_map(*[F.lit(x) for kv in FOLDERS.items() for x in kv])
    after_raw = F.try_element_at(names, F.lower(F.regexp_extract(p, "/raw/([^/]+)/", 1)))
    anywhere = F.get(F.filter(F.transform(F.split(F.lower(p), "/"), lambda x: F.try_element_at(names, x)), lambda x: x.isNotNull()), 0)
    file = F.element_at(F.split(p, "/"), -1)
    stamp = blank_to_null(F.regexp_replace(F.regexp_extract(file, "_([0-9]{8}_[0-9]{6})", 1), "_", " "))
    return F.struct(F.coalesce(after_raw, anywhere).alias("marketplace"), file.alias("query"), F.try_to_timestamp(stamp, F.lit("yyyyMMdd HHmmss")).cast("timestamp_ntz").alias("captured_at"))


def file_fingerprints(df: DataFrame) -> DataFrame:
    """Path, size and time of change of the files behind ``df`` (a file source), as source_id."""
    m = F.col("_metadata")
    return df.select(F.concat_ws(":", m["file_path"], m["file_size"].cast("string"), F.unix_micros(m["file_modification_time"]).cast("string")).alias("source_id")).distinct()


def new_files_only(df: DataFrame, state: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """The rows of files that ``state`` (table_name, source_id, ts) doesn't list yet, and the state rows to append.

    Append these after the rows are written: a failure in between reads the files again instead of losing them.
    """
    m = F.col("_metadata")
    tagged = df.select("*", F.concat_ws(":", m["file_path"], m["file_size"].cast("string"), F.unix_micros(m["file_modification_time"]).cast("string")).alias("source_id"))
    seen = state.where(F.col("table_name") == table).select("source_id")
    fresh = tagged.join(seen, "source_id", "left_anti")
    marks = fresh.select(F.lit(table).alias("table_name"), "source_id").distinct().withColumn("ts", F.current_timestamp())
    return fresh.drop("source_id"), marks


def read_snapshots(spark: SparkSession, path: str, top10_only: bool = True, schema=None) -> DataFrame:
    """Daily snapshot files ``slug[_top10]_YYYYMMDD.json`` with slug and date d read off their names."""
    df = _reader(spark, "*_top10_[0-9]*.json" if top10_only else "*_[0-9]*.json", schema).option("multiLine", True).json(path)
    name = F.col("_metadata.file_name")
    d = df.select("*", F.regexp_extract(name, "^(.+?)(?:_top10)?_([0-9]{8})\\.json$", 1).alias("slug"), F.try_to_date(F.regexp_extract(name, "_([0-9]{8})\\.json$", 1), "yyyyMMdd").alias("d"))
    return d.where("d IS NOT NULL")


def read_run_reports(spark: SparkSession, path: str, glob: str = "*_relatorio.json", schema=None) -> tuple[DataFrame, DataFrame]:
    """Search-run reports: one row per run with its figures, and one per product with the run's term."""
    df = _reader(spark, glob, schema).option("multiLine", True).json(path).select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))
    return df.drop("produtos"), df.select("termo", SOURCE_FILE, F.inline("produtos"))
