"""Row-level operators on Structured Streaming frames.

Checkbox unfolding and recoding are stateless per row, so the batch
operators run unchanged on ``readStream`` frames.  Two things differ:

* de-duplication needs state; with an event-time column it is bounded by
  a watermark (``dropDuplicatesWithinWatermark``), otherwise it keeps
  every key seen;
* the whole-column recode guard needs the whole column, which a stream
  never has; unknown codes become null, and :func:`unknown_code_counts`
  reports them per micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from formweave.operators.checkbox import checkbox_table
from formweave.operators.recode import recode_columns
from formweave.operators.validate import recode_report
from formweave.plans.compiled import CompiledDictionary


def unfold_stream(stream: DataFrame, keys: list[str], base: str, labels: dict[str, str],
                  other_col: str | None = None, event_time: str | None = None,
                  delay: str = "1 hour") -> DataFrame:
    """N2 on a stream; de-duplicated on ``keys + [base]``."""
    cols = list(keys)
    if event_time is not None:
        stream = stream.withWatermark(event_time, delay)
        cols.append(event_time)
    out = checkbox_table(stream, cols, base, labels, other_col=other_col, dedupe=False)
    subset = list(keys) + [base]
    if event_time is not None:
        return out.dropDuplicatesWithinWatermark(subset)
    return out.dropDuplicates(subset)


def recode_stream(stream: DataFrame, cols: list[str], compiled: CompiledDictionary) -> DataFrame:
    """J1 on a stream, without the whole-column guard."""
    return recode_columns(stream, cols, compiled, guard=False)


def unknown_code_counts(batch: DataFrame, compiled: CompiledDictionary) -> DataFrame:
    """V5 for one micro-batch (use inside ``foreachBatch``)."""
    return recode_report(batch, compiled)
