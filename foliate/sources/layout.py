"""Layout responses of a document service, as JSON, to tables of lines, cells and figures.

The JSON is parsed with a declared schema; malformed documents give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliate.functions.markers import bounding_box

SCHEMA = (
    "content string, pages array<struct<pageNumber int, width double, height double, lines array<struct<content string, polygon array<double>>>>>, "
    "tables array<struct<rowCount int, columnCount int, cells array<struct<content string>>>>, "
    "paragraphs array<struct<content string, role string>>, figures array<struct<id string, boundingRegions array<string>>>"
)


def parsed(responses: DataFrame, column: str = "response") -> DataFrame:
    """(doc_id, layout) of JSON strings."""
    return responses.select("doc_id", F.from_json(column, SCHEMA).alias("layout"))


def layout_lines(layouts: DataFrame) -> DataFrame:
    """One row a line: page, place on the page, place in the document, text and box."""
    pages = layouts.select("doc_id", F.posexplode("layout.pages").alias("page_index", "page"))
    lines = pages.select("doc_id", "page_index", F.col("page.pageNumber").alias("page_number"), F.posexplode("page.lines").alias("line_index", "line"))
    return lines.select("doc_id", "page_index", "page_number", "line_index", F.col("line.content").alias("text_raw"), bounding_box(F.col("line.polygon")).alias("bbox"))


def layout_summary(layouts: DataFrame) -> DataFrame:
    """Pages, lines, tables, paragraphs and figures of each response."""
    n = lambda c: F.coalesce(F.size(c), F.lit(0))
    lines = F.aggregate(F.coalesce("layout.pages", F.array().cast("array<struct<pageNumber:int,width:double,height:double,lines:array<struct<content:string,polygon:array<double>>>>>")), F.lit(0), lambda a, p: a + F.greatest(F.size(p["lines"]), F.lit(0)))
    return layouts.select("doc_id", F.greatest(n("layout.pages"), F.lit(0)).alias("pages"), lines.alias("lines"), F.greatest(n("layout.tables"), F.lit(0)).alias("tables"), F.greatest(n("layout.paragraphs"), F.lit(0)).alias("paragraphs"), F.greatest(n("layout.figures"), F.lit(0)).alias("figures"))
