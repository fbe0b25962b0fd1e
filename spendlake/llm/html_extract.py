"""Main text of web pages: boosted trees score the nodes of the DOM, and the best consistent choice is kept."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.llm import boosting, dom
from spendlake.llm.layouts import Layout

# Bound of the training sample: pages composed by ``layouts``, about 30 nodes each.
TRAIN_PAGES = 700
SEED = 11
# Characters of html a task scores at once.
CHARS_AT_ONCE = 2_000_000


def labelled_nodes(seeds: range) -> tuple[np.ndarray, np.ndarray]:
    """Features of the nodes with text of composed pages, and whether main text is at or below each."""
    pages = [dom.parse(Layout(seed).page()) for seed in seeds]
    labels = []
    for page in pages:
        main = [mark == 1 and chars > 0 for mark, chars in zip(page.mark, page.chars)]
        for i in range(len(main) - 1, 0, -1):
            main[page.parent[i]] |= main[i]
        labels += main
    rows, told = dom.features(pages)
    return rows[told], np.array(labels, dtype=float)[told]


def trained(pages: int = TRAIN_PAGES, seed: int = SEED) -> boosting.Forest:
    return boosting.fit(*labelled_nodes(range(seed * 1_000_000, seed * 1_000_000 + pages)))


def extracted(pages: list[dom.Page], forest: boosting.Forest) -> list[str]:
    rows, told = dom.features(pages)
    # A node without text decides nothing.
    score = np.where(told, forest.probability(rows), 0.5)
    out, first = [], 0
    for page in pages:
        own = score[first : first + len(page.tag)]
        first += len(page.tag)
        out.append(dom.text_of(page, dom.decode(page, own)))
    return out


def main_text(pages: DataFrame, html_col: str = "html", forest: boosting.Forest | None = None) -> DataFrame:
    """(row, text): every row as a struct of all its columns, and the main text of its html.

    Null and empty html give an empty text, and so does a page without main
    text; any bytes are read as some tree, however broken. Repeated rows are
    extracted each; a page's text depends on its html alone. Further columns
    travel inside ``row``, so their names cannot clash. No pages give no rows.
    """
    held = pages.sparkSession.sparkContext.broadcast(forest or trained())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = held.value
        for batch in batches:
            texts, some, size = [], [], 0
            for value in batch.column(1):
                source = value.as_py() or ""
                some.append(dom.parse(source))
                size += len(source)
                if size > CHARS_AT_ONCE:
                    texts += extracted(some, forest)
                    some, size = [], 0
            texts += extracted(some, forest)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "text"])

    html = F.col(html_col)
    without = pages.drop(html_col)
    rows = pages.select(F.struct(*[F.col(f"`{name}`") for name in without.columns]).alias("row"), html.alias("html"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, text string"
    return rows.mapInArrow(read, schema)
