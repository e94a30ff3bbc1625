"""HTML extraction by layout-aware rendering (see ``html_render``).

Nulls: a null or empty page has an empty text. Any input is rendered, however
broken. Equal rows are rendered each; an empty table gives no rows. Input
columns ``text`` and ``n_chars`` are replaced, all others are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaweave.llm.common import query, table
from taxaweave.llm.html_render import parse, render


def rendered(pages: DataFrame, html: str = "html") -> DataFrame:
    """Adds ``text``, the page's visible text as laid out, and ``n_chars``."""
    pages = pages.drop("text", "n_chars")
    names = pages.columns
    at = names.index(html)
    schema = T.StructType([*pages.schema.fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                b = whole.slice(lo, 256)
                out = [render(parse(p)) if p else "" for p in b.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())], names=[*names, "text", "n_chars"])

    return pages.mapInArrow(draw, schema)


@query("op9_html_extraction")
def op9_html_extraction(spark, sf_dir):
    pages = rendered(table(spark, sf_dir, "pages"))
    return pages.select("page_id", "url", "text", "n_chars", F.crc32(F.col("text").cast("binary")).alias("text_crc32"))
