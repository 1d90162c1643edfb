"""Writing: nothing until every check has passed, tables as single files where a contract asks for one."""

from __future__ import annotations

import csv
import io
import json
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REPORT_LIMIT = 200


class Conflict(Exception):
    """Checks that found rows."""

    def __init__(self, problems: list[str]):
        self.problems = problems
        super().__init__(f"{len(problems)} problem(s): " + "; ".join(problems[:5]))


@dataclass
class Plan:
    """Outputs that are written together at the end, and the checks that must be empty before."""

    spark: SparkSession
    apply: bool = False
    outputs: list[tuple[str, Callable[[str], None]]] = field(default_factory=list)
    checks: list[tuple[str, DataFrame]] = field(default_factory=list)

    def check(self, name: str, problems: DataFrame) -> None:
        self.checks.append((name, problems))

    def table(self, path: str, df: DataFrame, single: bool = True) -> None:
        self.outputs.append((path, lambda p: write_csv(df, p) if single else df.write.mode("overwrite").csv(p, header=True)))

    def spreadsheet(self, path: str, df: DataFrame, excel: bool) -> None:
        self.outputs.append((path, lambda p: write_csv(df, p, excel)))

    def json(self, path: str, df: DataFrame, header: dict | None = None, name: str = "rows") -> None:
        self.outputs.append((path, lambda p: write_json(df, p, header, name)))

    def parquet(self, path: str, df: DataFrame) -> None:
        self.outputs.append((path, lambda p: df.write.mode("overwrite").parquet(p)))

    def text(self, path: str, content: str) -> None:
        self.outputs.append((path, lambda p: write_text(self.spark, p, content)))

    def finish(self) -> list[str]:
        """The planned paths. Conflict if a check has rows; written only with apply."""
        problems = [f"{name}: {r.asDict()}" for name, df in self.checks for r in df.limit(REPORT_LIMIT).collect()]
        if problems:
            raise Conflict(problems)
        if self.apply:
            # an output may be an input too: all are written beside before the first takes its name
            for path, write in self.outputs:
                write(path + ".new")
            for path, _ in self.outputs:
                _rename(self.spark, path + ".new", path)
        return [path for path, _ in self.outputs]


def _place(spark: SparkSession, path: str):
    """A path and its file system."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _rename(spark: SparkSession, path: str, target: str) -> None:
    (where, fs), (to, _) = _place(spark, path), _place(spark, target)
    fs.delete(to, True)
    if not fs.rename(where, to):
        raise OSError(f"can't write {target}")


def write_parts(spark: SparkSession, path: str, parts: Iterable[str]) -> None:
    """A file in one step: its parts are streamed to one beside it, which then takes its name.

    It gets no checksum file beside it: people edit it by other means than this file system.
    """
    beside, fs = _place(spark, path + ".tmp")
    fs.setWriteChecksum(False)
    try:
        out = fs.create(beside, True)
        try:
            for part in parts:
                out.write(bytearray(part.encode()))
        finally:
            out.close()
    finally:
        fs.setWriteChecksum(True)
    _rename(spark, path + ".tmp", path)


def write_text(spark: SparkSession, path: str, content: str) -> None:
    write_parts(spark, path, [content])


#: Rows that are turned to text at a time.
ROWS = 5000


def csv_parts(fields: list[str], rows: Iterable, separator: str = ",") -> Iterator[str]:
    """The text of a CSV file, some rows at a time."""
    buffer = io.StringIO()
    writer = csv.writer(buffer, delimiter=separator, lineterminator="\n")
    writer.writerow(fields)
    for k, r in enumerate(rows, 1):
        writer.writerow(["" if v is None else v for v in r])
        if k % ROWS == 0:
            yield buffer.getvalue()
            buffer.seek(0)
            buffer.truncate()
    yield buffer.getvalue()


def csv_text(fields: list[str], rows: Iterable, separator: str = ",") -> str:
    return "".join(csv_parts(fields, rows, separator))


def write_csv(df: DataFrame, path: str, spreadsheet: bool = False) -> None:
    """A single CSV file in the order of df: the driver holds a partition and some rows of text; for spreadsheets semicolons and a byte order mark."""
    parts = csv_parts(df.columns, df.toLocalIterator(), ";" if spreadsheet else ",")
    write_parts(df.sparkSession, path, chain(["\ufeff"] if spreadsheet else [], parts))


def json_parts(header: dict, rows: Iterable[str], name: str = "rows") -> Iterator[str]:
    """The text of a compact JSON object: the header's fields, then the rows, which are JSON themselves."""
    head = json.dumps(header, ensure_ascii=False, separators=(",", ":"))[:-1]
    yield f"{head}{',' if header else ''}{json.dumps(name)}:["
    for k, r in enumerate(rows):
        yield "," * bool(k) + r
    yield "]}"


def write_json(df: DataFrame, path: str, header: dict | None = None, name: str = "rows") -> None:
    """One compact JSON file: header and a list of rows, in the order of df, streamed through the driver."""
    rows = (r[0] for r in df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).toLocalIterator())
    write_parts(df.sparkSession, path, json_parts(header or {}, rows, name))


def link_table(links: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Links as their CSV has them: in the order of the left volume, score with four digits, snapshots of both texts.

    left, right: uuid, order, document, section_title, tagged_text.
    """
    side = lambda df, s: df.select(F.col("uuid").alias(f"{s}_uuid"), F.col("document").alias(f"{s}_file"), F.col("section_title").alias(f"{s}_section"), F.col("tagged_text").alias(f"{s}_tagged_text"), F.col("order").alias(f"__{s}"))
    met = links.join(side(left, "left"), "left_uuid").join(side(right, "right"), "right_uuid")
    return met.orderBy("__left").select("left_file", "left_uuid", "right_uuid", "right_file", F.when(F.col("score").isNull(), "").otherwise(F.format_string("%.4f", "score")).alias("score"), "source", "left_section", "right_section", "left_tagged_text", "right_tagged_text")


def markdown_table(fields: list[str], rows) -> str:
    cell = lambda v: "" if v is None else f"{v:.3f}" if isinstance(v, float) else str(v).replace("|", "\\|")
    lines = ["| " + " | ".join(fields) + " |", "|" + "---|" * len(fields)]
    return "\n".join([*lines, *["| " + " | ".join(cell(v) for v in r) + " |" for r in rows]])


def tree_report(titles: DataFrame) -> str:
    """The title tree of a document as text: titles(uuid, parent_uuid, pos, heading, direct, subtree)."""
    rows = titles.orderBy("pos").collect()
    children: dict[str, list] = {}
    for r in rows:
        children.setdefault(r["parent_uuid"], []).append(r)
    known = {r["uuid"] for r in rows}

    def walk(parent: str, depth: int):
        for r in children.get(parent, ()):
            yield "  " * depth + f"{r['heading'][:70]} ({r['direct']}, {r['subtree']})"
            yield from walk(r["uuid"], depth + 1)

    return "\n".join(line for p in children if p not in known for line in walk(p, 0))
