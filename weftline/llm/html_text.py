"""Main text of web pages: every block judged by a recurrent labeller, the blocks that pass joined by line ends.

See `html_blocks` for what a block is, `html_labels` for the labeller, `html_layouts` for the pages that it learns from. The labeller is
trained on the driver on those made pages (its size and work do not depend on the table) and is broadcast: about 0.6 MB. Pages are then
read one by one in tasks; nothing is shuffled.

Rules. Null and empty html, and pages without a block, give an empty text. All blocks with a probability of at least `least` stay, whole and in
page order. Unclosed markup at the end of a page is left out. Rows that repeat are judged each; an empty table gives no rows.
A task holds the blocks of about STEP_BYTES of pages, or of one longer page: for that some 300 bytes a block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.common import arrow_map, steps, table
from weftline.llm.html_blocks import Block, blocks
from weftline.llm.html_labels import Model, probabilities, trained

LEAST = 0.5


def main_texts(model: Model, of_pages: list[list[Block]], least: float = LEAST) -> list[str]:
    """The main text of each page."""
    likely = probabilities(model, of_pages) >= least
    ends = np.cumsum([len(p) for p in of_pages]).tolist()
    return [
        "\n".join(b.text for b, stays in zip(page, likely[end - len(page) : end].tolist()) if stays)
        for page, end in zip(of_pages, ends)
    ]


def extract(pages: DataFrame, *, keep: list[str] | None = None, least: float = LEAST) -> DataFrame:
    """text of every row of pages (with `html`), before it the columns in `keep`, after it n_blocks (of the whole page) and n_chars.

    `keep` names columns of pages to hand on; they must not be called like the results.
    """
    kept = list(keep or [])
    names = ["text", "n_blocks"]
    if clash := set(kept) & {*names, "n_chars"}:
        raise ValueError(f"columns called like results: {sorted(clash)}")
    shared = pages.sparkSession.sparkContext.broadcast(trained())

    def run(batches):
        for batch in batches:
            for part in steps(batch, "_html"):
                of_pages = [blocks(h) for h in part.column("_html").to_pylist()]
                found = [pa.array(main_texts(shared.value, of_pages, least), pa.string()), pa.array(map(len, of_pages), pa.int64())]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], *found], [*kept, *names])

    given = pages.select(*kept, F.col("html").alias("_html"))
    schema = ", ".join([f"`{c}` {given.schema[c].dataType.simpleString()}" for c in kept] + ["text string, n_blocks long"])
    return arrow_map(given, run, schema).withColumn("n_chars", F.char_length("text").cast("long"))


def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages."""
    return extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"])
