"""Pages of OCR markup to blocks and lines: one Arrow function over the markup, standard-library parser."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Blocks whose text describes a picture; elements without an end tag.
PICTURES = ("Image", "Figure")
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
EMPHASIS = {"em": "*", "i": "*", "strong": "**", "b": "**"}

BLOCKS = "array<struct<index:int,bbox:array<double>,label:string,error:string,lines:array<struct<line_index:int,markdown:string,words:array<struct<word:string,score:double>>,bbox:array<int>>>>>"


class _Reader(HTMLParser):
    """Blocks are the outermost div elements; lines their outermost spans."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[dict] = []
        self.open: list[tuple[str, dict]] = []
        self.block: dict | None = None
        self.line: dict | None = None

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if self.block is None:
            if tag == "div" and not self.open:
                self.block = {"attrs": a, "lines": [], "outside": []}
        elif tag == "span" and self.line is None:
            heading = next((int(t[1]) for t, _ in reversed(self.open) if re.fullmatch("h[1-6]", t)), 0)
            self.line = {"attrs": a, "depth": len(self.open), "level": heading, "text": [], "markdown": []}
        elif self.line is not None:
            self.line["markdown"].append(EMPHASIS.get(tag, ("<br>" if tag == "br" else "")) if tag != "a" else "[")
            if tag == "br":
                self.line["markdown"][-1] = " "
        if tag not in VOID:
            self.open.append((tag, a))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        depth = next((i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] == tag), None)
        if depth is None:
            return
        closed = self.open[depth:]
        del self.open[depth:]
        if self.line is not None:
            if depth <= self.line["depth"]:
                self.block["lines"].append(self.line)
                self.line = None
            else:
                for name, a in reversed(closed):
                    self.line["markdown"].append(f"]({a.get('href') or ''})" if name == "a" else EMPHASIS.get(name, ""))
        if self.block is not None and depth == 0:
            self.blocks.append(self.block)
            self.block = None

    def handle_data(self, data):
        if self.line is not None:
            self.line["text"].append(data)
            self.line["markdown"].append(re.sub(r"([*_])", r"\\\1", data))
        elif self.block is not None:
            self.block["outside"].append(data)

    def finish(self) -> list[dict]:
        self.close()
        for name, _ in reversed(self.open[:]):
            self.handle_endtag(name)
        return self.blocks


def read_blocks(markup: str) -> list[dict]:
    reader = _Reader()
    reader.feed(markup)
    out = []
    for index, b in enumerate(reader.finish(), 1):
        label = b["attrs"].get("data-label") or ""
        box = (b["attrs"].get("data-bbox") or "").split()
        outside = " ".join(" ".join(b["outside"]).split())
        error = None
        if len(box) != 4:
            error = "no box of four numbers"
        elif outside:
            error = "text outside any span: " + (outside if len(outside) <= 40 else outside[:40] + "…")
        lines = []
        for line in b["lines"] if label not in PICTURES else ():
            text = " ".join("".join(line["markdown"]).split())
            if not text:
                continue
            words, scores = "".join(line["text"]).split(), (line["attrs"].get("data-word-confidence") or "").split()
            estimate = line["attrs"].get("data-line-bbox-estimate")
            lines.append({
                "line_index": len(lines) + 1,
                "markdown": "#" * line["level"] + " " + text if line["level"] else text,
                "words": [{"word": w, "score": float(s)} for w, s in zip(words, scores)] if scores and len(words) == len(scores) else None,
                "bbox": [int(n) for n in estimate.split()] if estimate else None,
            })
        out.append({"index": index, "bbox": [float(n) for n in box] if len(box) == 4 else None, "label": label, "error": error, "lines": lines})
    return out


def blocks(markup: Column) -> Column:
    """array of blocks of a page's markup, with errors as values."""
    word = pa.struct([("word", pa.string()), ("score", pa.float64())])
    line = pa.struct([("line_index", pa.int32()), ("markdown", pa.string()), ("words", pa.list_(word)), ("bbox", pa.list_(pa.int32()))])
    kind = pa.list_(pa.struct([("index", pa.int32()), ("bbox", pa.list_(pa.float64())), ("label", pa.string()), ("error", pa.string()), ("lines", pa.list_(line))]))

    def run(column: pa.Array) -> pa.Array:
        return pa.array([read_blocks(m or "") for m in column.to_pylist()], type=kind)

    return F.arrow_udf(run, BLOCKS)(markup)


def page_lines(pages: DataFrame, document: str = "document", page: str = "page_index", markup: str = "raw") -> DataFrame:
    """document, page_index, block_index, block_label, block_bbox, error, line_index, uid, markdown, words, line_bbox, pos: a row per line, and one per block with an error."""
    b = pages.select(F.col(document).alias("document"), F.col(page).alias("page_index"), F.explode(blocks(F.col(markup))).alias("b"))
    rows = b.select("document", "page_index", F.col("b.index").alias("block_index"), F.col("b.label").alias("block_label"), F.col("b.bbox").alias("block_bbox"), F.col("b.error").alias("error"), F.explode_outer("b.lines").alias("l"))
    rows = rows.where(F.col("l").isNotNull() | F.col("error").isNotNull())
    pos = F.shiftleft(F.col("page_index").cast("long"), 42) + F.shiftleft(F.col("block_index").cast("long"), 21) + F.coalesce("l.line_index", F.lit(0))
    return rows.select("document", "page_index", "block_index", "block_label", "block_bbox", "error", F.col("l.line_index").alias("line_index"), F.concat_ws(".", "page_index", "block_index", "l.line_index").alias("uid"), F.col("l.markdown").alias("markdown"), F.col("l.words").alias("words"), F.col("l.bbox").alias("line_bbox"), pos.alias("pos"))
