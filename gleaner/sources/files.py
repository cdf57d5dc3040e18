"""Files, folders and tables as documents; stage tables and exports."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions import text as T
from gleaner.session import hadoop_path

TYPES = (".md", ".markdown", ".txt")


def _name(path):
    return F.element_at(F.split(path, "/"), -1)


def scan(spark: SparkSession, path: str, types: tuple[str, ...] = TYPES, paths: list[str] | None = None) -> DataFrame:
    """Candidate files below path (or exactly ``paths``): allowed suffix, not hidden, not empty; their bytes."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = reader.load(paths if paths else path)
    name = _name(F.col("path"))
    suffix = F.lower(F.regexp_extract(name, r"(\.[^.]+)$", 1))
    return files.filter(suffix.isin(*types) & ~name.startswith(".") & (F.col("length") > 0)).select("path", name.alias("file_name"), suffix.alias("file_type"), "content")


def read_documents(spark: SparkSession, path: str, types: tuple[str, ...] = TYPES, paths: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, errors): files that aren't UTF-8 become error rows and don't end the scan."""
    rows = scan(spark, path, types, paths).withColumn("text", F.expr("try_validate_utf8(cast(content as string))"))
    local = F.regexp_replace("path", "^file:(//)?", "")
    good = rows.filter("text is not null").select(T.stable_id("doc", local).alias("doc_id"), local.alias("file_path"), "file_name", "file_type", F.regexp_replace("text", "\r\n?", "\n").alias("text"))
    bad = rows.filter("text is null").select(F.lit("read_documents").alias("stage"), local.alias("source_id"), F.lit("UnicodeDecodeError").alias("error_type"), F.lit("the file is not UTF-8").alias("message"))
    return good, bad


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSONL file; blank lines are skipped."""
    return spark.read.schema(schema).json(path)


def _as_json(df: DataFrame) -> DataFrame:
    """One column, value: each row as an object with its columns in order, nulls included."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}).alias("value"))


def _one_file(lines: DataFrame, path: str) -> None:
    """A column of lines as one text file of any file system: for reports, not for corpora."""
    spark, parts = lines.sparkSession, f"{path}.parts"
    lines.coalesce(1).write.mode("overwrite").text(parts)
    fs, folder = hadoop_path(spark, parts)
    target = hadoop_path(spark, path)[1]
    fs.delete(target, True)
    found = [f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-")]
    if found:
        fs.rename(found[0], target)
    else:
        fs.create(target).close()
    fs.delete(folder, True)


def write_jsonl(df: DataFrame, path: str, single: bool = True) -> None:
    """One object for each line in the order of the columns, nulls included; a folder of parts unless single."""
    rows = _as_json(df)
    if single:
        _one_file(rows, path)
    else:
        rows.write.mode("overwrite").text(path)


def write_json(df: DataFrame, path: str) -> None:
    """All rows as one indented JSON array with sorted keys: for results that fit one file."""

    def run(batches):
        import json

        import pyarrow as pa

        some = False
        for b in batches:
            lines = []
            for v in b.column(0).to_pylist():
                body = json.dumps(json.loads(v), ensure_ascii=False, indent=2, sort_keys=True)
                lines.append(("," if some else "[") + "\n  " + body.replace("\n", "\n  "))
                some = True
            if lines:
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["]" if some else "[]"])], ["value"])

    _one_file(_as_json(df).coalesce(1).mapInArrow(run, "value string"), path)


def write_stage(df: DataFrame, folder: str, name: str) -> DataFrame:
    """The stage as a table, read back: later stages start from files, not from the whole lineage."""
    path = str(PurePosixPath(folder) / name) if "://" not in folder else f"{folder.rstrip('/')}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_errors(errors: DataFrame, folder: str) -> bool:
    """errors as JSONL, only if there are any."""
    some = bool(errors.take(1))
    if some:
        write_jsonl(errors, f"{folder}/errors.jsonl")
    return some


def write_artifacts(tables: dict[str, DataFrame], folder: str) -> None:
    """Each table under its name: .json as an array, .jsonl as lines."""
    for name, df in tables.items():
        (write_json if name.endswith(".json") else write_jsonl)(df, f"{folder.rstrip('/')}/{name}")


def clear(spark: SparkSession, folder: str) -> None:
    """Delete the files of a folder, not its subfolders."""
    fs, path = hadoop_path(spark, folder)
    for f in fs.listStatus(path) if fs.exists(path) else ():
        if f.isFile():
            fs.delete(f.getPath(), False)
