"""Corpus files: JSON lines in, JSON lines, CSV logs and trees out."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions.text import file_name, strip


def with_order(rows: DataFrame) -> DataFrame:
    """Adds ord: path, start of the split, and place in it. No count of earlier rows is needed."""
    place = F.struct(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("place")
    )
    return rows.select("*", place.alias("ord"))


def read_lines(spark: SparkSession, path, spread: int | None = None) -> DataFrame:
    """value, ord. gzip by suffix; a gzip file is read by one task, and ``spread`` deals its lines to so many for what follows."""
    lines = with_order(spark.read.option("lineSep", "\n").text(path))
    return lines.repartition(spread) if spread else lines


def read_jsonl(spark: SparkSession, path, columns: str = schema.RECORD, strict: bool = False, spread: int | None = None) -> DataFrame:
    """Records with ord. Blank lines go; broken ones go too, or fail the read if ``strict``. ``spread`` as in ``read_lines``."""
    lines = read_lines(spark, path, spread).where(F.length(strip(F.col("value"))) > 0)
    mode = {"mode": "FAILFAST"} if strict else {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    parsed = lines.withColumn("_r", F.from_json("value", columns if strict else f"{columns}, _bad string", mode))
    if not strict:
        parsed = parsed.where(F.col("_r._bad").isNull())
    return parsed.select("_r.*", "ord").drop("_bad")


def read_broken(spark: SparkSession, path, columns: str = schema.RECORD) -> DataFrame:
    """The lines that ``read_jsonl`` drops as broken."""
    lines = read_lines(spark, path).where(F.length(strip(F.col("value"))) > 0)
    parsed = lines.withColumn("_r", F.from_json("value", f"{columns}, _bad string", {"columnNameOfCorruptRecord": "_bad"}))
    return parsed.where(F.col("_r._bad").isNotNull()).select("value", "ord")


def write_jsonl(records: DataFrame, path: str, mode: str = "overwrite", compress: bool = True) -> None:
    """A folder of JSON line files; null fields are left out."""
    records.drop("ord", "src", "score", "first_ord", "first_src").write.mode(mode).option("compression", "gzip" if compress else "none").json(path)


def write_log(rows: DataFrame, path: str, children: bool = False) -> None:
    """Audit log as CSV with a header."""
    columns = ["Timestamp", "PageTitle", "URL", "ParentTitle", "Reason", *(["ChildCount"] if children else [])]
    rows.select(*columns).write.mode("overwrite").option("header", True).csv(path)


def processed_ids(spark: SparkSession, path: str) -> DataFrame:
    """page_id of what an earlier run has written (resume)."""
    return spark.read.schema("page_id bigint").json(path).where("page_id is not null").distinct()


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def newest(spark: SparkSession, pattern: str) -> str | None:
    """The file or folder that matches the pattern and was changed last."""
    fs, p = _hadoop(spark, pattern)
    found = list(fs.globStatus(p) or [])
    return max(found, key=lambda s: s.getModificationTime()).getPath().toString() if found else None


def require(spark: SparkSession, paths: list[str]) -> None:
    """Fail with all patterns that match nothing."""
    missing = []
    for path in paths:
        fs, p = _hadoop(spark, path)
        if not list(fs.globStatus(p) or []):
            missing.append(path)
    if missing:
        raise FileNotFoundError("missing inputs: " + ", ".join(missing))


def free_bytes(spark: SparkSession, path: str) -> int:
    fs, p = _hadoop(spark, path)
    return fs.getStatus(p).getRemaining()


# -- exploration trees -----------------------------------------------------------------------------------


_TREE = "node string, type string, reason string, timestamp string, parent string"


def _unwound(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for text in batch["value"]:
            rows, stack = [], [(json.loads(text), None)]
            while stack:
                x, parent = stack.pop()
                rows.append((x.get("name"), x.get("type"), x.get("reason"), x.get("timestamp"), parent))
                below = x.get("children") or []
                stack += [(c, x.get("name")) for c in reversed(below if isinstance(below, list) else list(below.values()))]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _TREE.split(", ")], dtype=object)


def read_tree(spark: SparkSession, path: str) -> DataFrame:
    """Tree files as node, type, reason, timestamp, parent rows, in one pass; a file is one author's tree."""
    return spark.read.option("wholetext", True).text(path).select("value").mapInPandas(_unwound, _TREE)


def tree_text(nodes: list[dict], root: str) -> str:
    """A tree drawn as text, from rows node, parent, type, reason, timestamp of one author (read on the driver)."""
    below: dict = {}
    for n in nodes:
        below.setdefault(n["parent"], []).append(n)
    lines: list[str] = []
    stack = [(n, "", i == 0) for i, n in enumerate(reversed(below.get(root, [])))]
    while stack:
        n, lead, last = stack.pop()
        lines.append(f"{lead}{'└── ' if last else '├── '}{n.get('timestamp') or ''} - {n['node']} [{n.get('type') or ''} ({n.get('reason') or ''})]")
        deeper = lead + ("    " if last else "│   ")
        stack += [(c, deeper, i == 0) for i, c in enumerate(reversed(below.get(n["node"], [])))]
    head = [f"--- {root} ---", f"Direct sub-pages explored: {len(below.get(root, []))}", f"Total descendants found: {len(lines)}", ""]
    return "\n".join([*head, *lines]) + "\n"


def tree_json(nodes: list[dict], root: str) -> str:
    """The same tree nested: children as lists, with the counts of the root."""
    top = {"name": root, "children": []}
    of: dict = {root: top}
    for n in nodes:
        of.setdefault(n["node"], {k: v for k, v in (("name", n["node"]), ("type", n.get("type")), ("reason", n.get("reason")), ("timestamp", n.get("timestamp"))) if v is not None})
    for n in nodes:
        of[n["parent"]].setdefault("children", []).append(of[n["node"]])
    return json.dumps(top | {"direct_children": len(top["children"]), "total_descendants": len(nodes)}, ensure_ascii=False)


def tree_files(nodes: DataFrame) -> DataFrame:
    """name, text, json: one row for each author. nodes: author, node, parent, type, reason, timestamp.

    A tree's root is its author; an author's tree is drawn in one task, as its file is one file.
    """

    def drawn(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        found = rows.astype(object).where(rows.notna(), None).sort_values(["timestamp", "node"]).to_dict("records")
        return pd.DataFrame([(key[0], tree_text(found, key[0]), tree_json(found, key[0]))], columns=["author", "text", "json"])

    made = nodes.groupBy("author").applyInPandas(drawn, "author string, text string, json string")
    return made.select(tree_file_name(F.col("author")).alias("name"), "text", "json")


def write_trees(nodes: DataFrame, path: str) -> None:
    """Folders ``txt`` and ``json`` with a part for each author."""
    files = tree_files(nodes)
    for kind, column in (("txt", "text"), ("json", "json")):
        files.select("name", F.regexp_replace(column, "\n$", "").alias("value")).write.mode("overwrite").partitionBy("name").text(f"{path}/{kind}")


def tree_file_name(category) -> object:
    return file_name(F.element_at(F.split(category, ":"), -1))
