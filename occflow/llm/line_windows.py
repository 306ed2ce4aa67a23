"""Line dedup: remove later occurrences of repeated windows of consecutive lines.

A text is cut at line feeds. Every run of three consecutive lines is hashed; of a
run that occurs more than once in the whole table, all occurrences but the first (in
order of id and place) are removed, overlapping ones as one merged stretch.

Defined results: a null text stays null, with no lines. An empty text has one empty
line. A text of fewer lines than a window is never touched. A text whose lines are
all removed becomes empty. Rows equal in id and text are one document: they get
equal results and don't repeat each other. A null id sorts first; rows of one id
with different texts are different documents, in order of a hash of the text. All
other columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import Stage
from . import repeats
from .common import unboxed, workspace

WINDOW = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def dedup_lines(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", window: int = WINDOW, stage: Stage | None = None
) -> DataFrame:
    """``docs`` with the cleaned ``text``, n_lines and n_removed (columns of these names are replaced)."""
    stage = stage or workspace(docs.sparkSession)
    hashes = docs.where(F.col(text).isNotNull()).select(
        F.col(doc).alias("doc"), F.xxhash64(text).alias("version"), *repeats.unit_hashes(_lines(F.col(text)))
    )
    joined = repeats.with_starts(docs, doc, text, repeats.later_places(repeats.windows(hashes, window), stage), stage)
    kept = F.when(F.col("starts").isNotNull(), repeats.kept_units(_lines(F.col("text")), F.col("starts")))
    lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(_lines(F.col("text")))).cast("long")
    marked = joined.select("row", "text", kept.alias("kept"), lines.alias("n_lines"))
    removed = F.when(F.col("kept").isNull(), F.lit(0)).otherwise(F.col("n_lines") - F.size("kept")).cast("long")
    cleaned = F.when(F.col("kept").isNull(), F.col("text")).otherwise(F.array_join("kept", "\n"))
    return unboxed(marked.withColumn("n_removed", removed), docs.columns, ("n_lines", "n_removed"), {text: cleaned})
