"""Dumps in COPY text form: codec, listing, table rewrites, and the sinks of a run.

Inputs are never changed. A rewrite goes to a staging folder that is renamed when
complete, so a run that was broken off is simply run again.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from palimpsest.functions.columns import quoted

#: Escapes of the COPY text form.
ESCAPES = {"b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "v": "\v"}
_ESCAPE = re.compile(r"\\(x[0-9A-Fa-f]{1,2}|[0-7]{1,3}|.)", re.DOTALL)
_ENTRY = re.compile(r"(\d+); \d+ \d+ (.+)")
#: Most notes that are written row by row; above it only the summary is.
ROW_NOTES = 10_000


def _escape_run(run: str) -> str:
    """Consecutive numeric escapes are bytes of one UTF-8 text."""
    return bytes(int(x[1:], 16) if x[0] == "x" else int(x, 8) & 255 for x in re.findall(r"\\(x[0-9A-Fa-f]{1,2}|[0-7]{1,3})", run)).decode("utf-8", "replace")


def unescape(x: str) -> str | None:
    r"""A field's value, in one pass from the left; ``\N`` is null."""
    if x == r"\N":
        return None
    if "\\" not in x:
        return x
    parts = re.split(r"(\\\\)", x)  # a doubled backslash starts no other escape
    for i in range(0, len(parts), 2):
        numeric = re.sub(r"(?:\\(?:x[0-9A-Fa-f]{1,2}|[0-7]{1,3}))+", lambda m: _escape_run(m[0]), parts[i])
        parts[i] = _ESCAPE.sub(lambda m: ESCAPES.get(m[1], m[1]), numeric)
    return "".join("\\" if i % 2 else p for i, p in enumerate(parts))


def escape(c: Column) -> Column:
    r"""A field's COPY text; null is ``\N``."""
    out = F.replace(c.cast("string"), F.lit("\\"), F.lit("\\\\"))
    for letter, ch in ESCAPES.items():
        out = F.replace(out, F.lit(ch), F.lit("\\" + letter))
    return F.coalesce(out, F.lit("\\N"))


def read_copy(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    r"""Rows of COPY files (gzip by name). Lines end at \n alone; the terminator ``\.`` is no row; a wrong number of fields raises."""

    @F.pandas_udf("array<string>")
    def fields(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([[unescape(x) for x in line.split("\t")] for line in part])

    lines = spark.read.option("lineSep", "\n").text(path).where(F.col("value") != "\\.")
    n = len(schema)
    whole = F.when(F.size("f") == n, F.col("f")).otherwise(F.raise_error(F.lit(f"a line without {n} fields")).cast("array<string>"))
    return lines.select(fields("value").alias("f")).select(whole.alias("f")).select(*[F.col("f")[i].cast(x.dataType).alias(x.name) for i, x in enumerate(schema)])


def write_copy(df: DataFrame, path: str) -> None:
    lines = F.concat_ws("\t", *[escape(F.col(quoted(n))) for n in df.columns])
    df.select(lines.alias("value")).write.option("compression", "gzip").option("lineSep", "\n").text(path)


def listing(text: str) -> dict[int, str]:
    """Dump id to "schema.table" of each table-data entry. Comments and empty lines are passed over; any other line that isn't an entry raises."""
    out = {}
    for line in text.splitlines():
        if not line.strip() or line.startswith(";"):
            continue
        m = _ENTRY.fullmatch(line.strip())
        if m is None:
            raise ValueError(f"not an entry of a listing: {line!r}")
        if m[2].startswith("TABLE DATA "):
            words = re.findall(r'"(?:[^"]|"")*"|\S+', m[2][len("TABLE DATA ") :])
            if len(words) < 2:
                raise ValueError(f"an entry without a table: {line!r}")
            out[int(m[1])] = ".".join(w[1:-1].replace('""', '"') if w[0] == '"' else w for w in words[:2])
    return out


def locate(path: str) -> str:
    """The folder itself if it holds a table of contents, else its numerically largest subfolder that does."""
    has = lambda p: os.path.exists(os.path.join(p, "toc.dat"))
    if has(path):
        return path
    inner = [x for x in os.listdir(path) if x.isdigit() and has(os.path.join(path, x))]
    if not inner:
        raise FileNotFoundError(f"no dump in {path}")
    return os.path.join(path, max(inner, key=int))


def commit(df: DataFrame, path: str, fmt: str = "parquet") -> bool:
    """Writes to a staging folder and renames it. False, with nothing done, where a complete ``path`` is there; an incomplete one is made again."""
    spark = df.sparkSession
    jvm = spark._jvm
    to = jvm.org.apache.hadoop.fs.Path(path)
    fs = to.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")):
        return False
    staging = f"{path.rstrip('/')}._staging"
    if fmt == "copy":
        fs.delete(jvm.org.apache.hadoop.fs.Path(staging), True)
        write_copy(df, staging)
    else:
        df.write.mode("overwrite").format(fmt).save(staging)
    fs.delete(to, True)
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(staging), to):
        raise OSError(f"can't rename {staging}")
    return True


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of a folder's visible subfolders, on any file system that Spark reads."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at)
    return sorted(x.getPath().getName() for x in found if x.isDirectory() and not x.getPath().getName().startswith(("_", ".")))


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def publish(tables: dict[str, DataFrame], to: str) -> None:
    """All tables or none: written beside the target and renamed in one step. A target that exists is refused."""
    spark = next(iter(tables.values())).sparkSession
    if exists(spark, to):
        raise FileExistsError(f"{to} exists")
    jvm, staging = spark._jvm, f"{to.rstrip('/')}._staging"
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{staging}/{name}")
    at = jvm.org.apache.hadoop.fs.Path(to)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).rename(jvm.org.apache.hadoop.fs.Path(staging), at):
        raise OSError(f"can't rename {staging}")


def restore(tables: dict[str, DataFrame], to: str, notes: DataFrame | None = None) -> None:
    """Puts a copy where it is used, table by table, in place of what stands there; its notes go to ``_notes``."""
    for name, df in [*tables.items(), *([("_notes", notes)] if notes is not None else [])]:
        spark, staging = df.sparkSession, f"{to.rstrip('/')}/_staging_{name}"
        df.write.mode("overwrite").parquet(staging)
        jvm = spark._jvm
        old, new = jvm.org.apache.hadoop.fs.Path(f"{to}/{name}"), jvm.org.apache.hadoop.fs.Path(staging)
        fs = old.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.delete(old, True)
        if not fs.rename(new, old):
            raise OSError(f"can't rename {staging}")


def read_dump(spark: SparkSession, folder: str, entries: dict[int, str], schemas: dict[str, StructType]) -> dict[str, DataFrame]:
    """The tables of a dump folder, whose data stand in ``<id>.dat.gz`` (a file, or a folder of parts). A table of ``schemas`` that the listing lacks raises."""
    at = {name: number for number, name in entries.items()}
    if missing := sorted(set(schemas) - set(at)):
        raise ValueError(f"the listing lacks {', '.join(missing)}")
    return {name: read_copy(spark, f"{folder}/{at[name]}.dat.gz", schema) for name, schema in schemas.items()}


def rewrite(tables: dict[str, DataFrame], entries: dict[int, str], to: str) -> list[str]:
    """Writes tables as the data members of a dump, ``<id>.dat.gz`` folders of gzip parts, whose parts joined are one member.
    Members that are complete already are passed over, so a rewrite that was broken off goes on. Returns the names written."""
    at = {name: number for number, name in entries.items()}
    if missing := sorted(set(tables) - set(at)):
        raise ValueError(f"the listing lacks {', '.join(missing)}")
    return [name for name, df in sorted(tables.items()) if commit(df, f"{to}/{at[name]}.dat.gz", "copy")]


def write_notes(notes: DataFrame, folder: str, limit: int = ROW_NOTES) -> None:
    """notes: tbl, key, note. The summary by table and note always; the rows only if there are at most ``limit`` in all."""
    summary = notes.groupBy("tbl", "note").agg(F.count(F.lit(1)).alias("n"))
    summary.write.mode("overwrite").parquet(f"{folder}/summary")
    total = notes.sparkSession.read.parquet(f"{folder}/summary").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    (notes if total <= limit else notes.limit(0)).write.mode("overwrite").parquet(f"{folder}/rows")
