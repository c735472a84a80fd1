"""Layout block trees (recursive JSON) to pages; the tree is walked inside an Arrow batch, as no Spark type is recursive."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import CLOSING, ENTITIES

# Block types by their part in a page.
SKIPPED, TABLES, EQUATIONS = {"PageHeader", "PageFooter"}, {"Table", "TableGroup"}, {"Equation", "TextInlineMath"}
_PAGE = pa.struct([("page_no", pa.int32()), ("text", pa.string()), ("markdown", pa.string()), ("equations", pa.list_(pa.string())), ("_extraction_method", pa.string())])
SCHEMA = "doc_id string, language string, has_equations boolean, has_tables boolean, extraction_backend string, pages array<struct<page_no int, text string, markdown string, equations array<string>, _extraction_method string>>, error string"


def _nodes(roots: list[dict]) -> Iterator[dict]:
    """All nodes in reading order, without recursion, so depth is no limit."""
    stack = list(reversed(roots))
    while stack:
        node = stack.pop()
        yield node
        stack += reversed(node.get("children") or [])


def _plain(html: str, bullets: bool) -> str:
    if bullets and "<li" in html:
        html = re.sub(r"<li[^>]*>", "- ", html)
    text = re.sub(r"<[^>]+>", "", re.sub(r"<br\s*/?>", "\n", re.sub(CLOSING, "\n", html)))
    for a, b in ENTITIES:
        text = text.replace(a, b)
    return text.strip()


def page_text(children: list[dict], bullets: bool = False) -> str:
    """Text of a page's blocks: a block with markup speaks for its children; headers and footers are left out."""
    out, stack = [], list(reversed(children))
    while stack:
        node = stack.pop()
        if node.get("block_type") in SKIPPED:
            continue
        if node.get("html"):
            if text := _plain(node["html"], bullets):
                out.append(text)
        else:
            stack += reversed(node.get("children") or [])
    return "\n".join(out)


def page_equations(page: dict) -> list[str]:
    found = (re.sub(r"<[^>]+>", "", n.get("html") or "").strip() for n in _nodes([page]) if n.get("block_type") in EQUATIONS)
    return list(dict.fromkeys(x for x in found if x))


def rendered_pages(tree: dict, bullets: bool = False) -> tuple[list[dict], bool, bool]:
    """(pages, any equations, any tables) of a rendered document."""
    stats = (tree.get("metadata") or {}).get("page_stats") or []
    methods = {int(s["page_id"]): s.get("text_extraction_method", "unknown") for s in stats if "page_id" in s}
    pages, tables = [], False
    for block in tree.get("children") or []:
        m = re.search(r"/page/(\d+)/", block.get("id") or "")
        at = int(m[1]) if m else len(pages)
        children = block.get("children") or []
        tables = tables or any(n.get("block_type") in TABLES for n in _nodes(children))
        pages.append({"page_no": at + 1, "text": page_text(children, bullets), "markdown": None, "equations": page_equations(block), "_extraction_method": methods.get(at, "unknown") if methods else None})
    return pages, any(p["equations"] for p in pages), tables


def layout_to_extractions(trees: DataFrame, backend: str = "marker", bullets: bool = False) -> DataFrame:
    """One extraction per row of (doc_id, tree): a tree that cannot be read gives null pages and an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(7)]
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    tree = json.loads(raw)
                    pages, eq, tab = rendered_pages(tree, bullets)
                    row = (doc, (tree.get("metadata") or {}).get("language"), eq, tab, backend, pages, None)
                except Exception as e:
                    row = (doc, None, None, None, backend, None, str(e))
                for c, v in zip(cols, row, strict=True):
                    c.append(v)
            types = [pa.string(), pa.string(), pa.bool_(), pa.bool_(), pa.string(), pa.list_(_PAGE), pa.string()]
            names = ["doc_id", "language", "has_equations", "has_tables", "extraction_backend", "pages", "error"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    return trees.select(F.col("doc_id").cast("string"), F.col("tree").cast("string")).mapInArrow(run, SCHEMA)
