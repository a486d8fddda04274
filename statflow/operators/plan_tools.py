"""Plan helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def barrier(df: DataFrame) -> DataFrame:
    """Re-emit every row through a one-element ``inline``.

    The optimizer neither merges projections across a Generate nor pushes a
    filter on generated columns below it, so expensive expressions computed
    in ``df`` (text tokenizing, folds over arrays) are evaluated once per row
    instead of being inlined into every consumer and into pushed-down
    filters. Narrow and codegen'd: no shuffle, no materialisation.
    """
    cols = df.columns
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in cols]))))
