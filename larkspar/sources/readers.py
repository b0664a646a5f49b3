"""Sources with explicit schemas that fail on drift, and artifacts by content hash."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import blank_to_null


def artifacts(spark: SparkSession, path: str) -> DataFrame:
    """path, sha256, byte_count, kind (by magic bytes) and content of every file."""
    head = F.hex(F.substring("content", 1, 4))
    first = F.regexp_extract(F.decode(F.substring("content", 1, 64), "ISO-8859-1"), r"^(?:\xEF\xBB\xBF)?\s*(.)", 1)
    kind = F.when(head.startswith("504B"), "zip").when(first == "<", "xml").when(first == "[", "json").otherwise("unknown")
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("byte_count"), kind.alias("kind"), "content")


def admitted(found: DataFrame, held: DataFrame) -> DataFrame:
    """Artifacts whose hash is not held yet, one row a hash."""
    return found.dropDuplicates(["sha256"]).join(held.select("sha256"), "sha256", "left_anti")


def sheets(data: bytes) -> dict[str, list[list[str | None]]]:
    """Cells of every sheet of a workbook, by the standard library."""
    import xml.etree.ElementTree as ET

    def local(e):
        return e.tag.rpartition("}")[2]

    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = set(z.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter() if local(t) == "t") for si in ET.fromstring(z.read("xl/sharedStrings.xml")) if local(si) == "si"]
        rels = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        out = {}
        for s in ET.fromstring(z.read("xl/workbook.xml")).iter():
            if local(s) != "sheet":
                continue
            target = next(rels[v] for k, v in s.attrib.items() if k.endswith("}id"))
            rows = []
            for row in ET.fromstring(z.read(target.lstrip("/") if target.startswith("/") else f"xl/{target}")).iter():
                if local(row) != "row":
                    continue
                cells: dict[int, str | None] = {}
                for c in row:
                    letters = re.match(r"[A-Z]+", c.get("r", "")) if c.get("r") else None
                    at = len(cells) if not letters else sum((ord(ch) - 64) * 26**i for i, ch in enumerate(reversed(letters[0]))) - 1
                    value = "".join(t.text or "" for t in c.iter() if local(t) in ("v", "t"))
                    cells[at] = shared[int(value)] if c.get("t") == "s" and value else value
                rows.append([cells.get(i) for i in range(max(cells, default=-1) + 1)])
            out[s.get("name")] = rows
        return out


def workbook_rows(data: bytes, columns: list[str], look: int = 25) -> list[dict]:
    """Rows under the one header that holds all columns, in whichever sheet; none or two such sheets fail."""
    found = []
    for name, rows in sheets(data).items():
        for i, row in enumerate(rows[:look]):
            header = [(c or "").strip() for c in row]
            if all(c in header for c in columns):
                found.append((name, i, header, rows))
                break
    if len(found) != 1:
        raise ValueError(f"{len(found)} sheets hold the header")
    _, i, header, rows = found[0]
    at = [header.index(c) for c in columns]
    out = [{c: ((row[k] or "").strip() or None) if k < len(row) else None for c, k in zip(columns, at)} for row in rows[i + 1 :]]
    return [r for r in out if any(r.values())]


def workbook(found: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of the workbooks among artifacts, with the artifact's hash."""
    schema = T.StructType([T.StructField("sha256", T.StringType()), *[T.StructField(c, T.StringType()) for c in columns]])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for sha, content in zip(batch["sha256"], batch["content"]):
                rows = workbook_rows(bytes(content), columns)
                yield pd.DataFrame([{"sha256": sha} | r for r in rows], columns=["sha256", *columns])

    return found.where("kind = 'zip'").select("sha256", "content").mapInPandas(run, schema)


def xml_rows(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    """Elements of a registry, split by row tag so that one big file is read by many tasks."""
    return spark.read.format("xml").option("rowTag", tag).option("mode", "FAILFAST").schema(schema).load(path)


def strict_json(spark: SparkSession, path: str, schema: T.StructType, most: int = 20_000) -> DataFrame:
    """A JSON array whose objects have exactly the schema's keys; unknown keys, or too many records, fail."""
    raw = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", T.ArrayType(T.VariantType()), {"mode": "FAILFAST"})).alias("v"))
    text = raw.select(F.to_json("v").alias("j"))
    keys = F.array(*[F.lit(f.name) for f in schema.fields])
    bad = text.where(F.size(F.array_except(F.json_object_keys("j"), keys)) > 0)
    if bad.limit(1).count():
        raise ValueError("a record has an unknown field")
    if text.limit(most + 1).count() > most:
        raise ValueError(f"over {most} records")
    return text.select(F.from_json("j", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def cleaned(df: DataFrame) -> DataFrame:
    """Every string trimmed, blanks to null."""
    return df.select(*[blank_to_null(F.col(f"`{c}`")).alias(c) if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes])


def write_manifest(df: DataFrame, path: str, group: str) -> DataFrame:
    """Canonical JSON lines in key order, and the counts that go with them."""
    columns = sorted(df.columns)
    lines = df.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value")).orderBy("value")
    lines.write.mode("errorifexists").text(path)
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n")).orderBy(group)
