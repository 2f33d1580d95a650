"""Drift of every series over an unbounded stream, with three numbers of state per series and recent batch."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewatch.operators.drift import DriftRule, Moments, judged
from tidewatch.schema import RUN_KEY

OUTPUT = (
    "store_id string, product_id string, batch_number int, n1 bigint, m1 double, v1 double,"
    " n0 bigint, m0 double, v0 double, rows_skipped bigint"
)

#: Count, mean and squared deviation of a set of rows.
Parts = tuple[int, float, float]


def _merge(a: Parts, b: Parts) -> Parts:
    """Count, mean and squared deviation of two sets of rows taken together."""
    n = a[0] + b[0]
    if n == 0:
        return a
    step = b[1] - a[1]
    return n, a[1] + step * b[0] / n, a[2] + b[2] + step * step * a[0] * b[0] / n


def _sample(a: Parts) -> tuple[int, float | None, float | None]:
    return a[0], a[1] if a[0] else None, a[2] / (a[0] - 1) if a[0] > 1 else None


class BatchMoments(StatefulProcessor):
    """Holds the moments of the newest batches of a series and gives those of each batch that new rows change.

    A batch may come in any number of parts: each part revises it, and the later batches it is a reference of. Rows
    of a batch that is more than `late` batches older than the newest one come too late: they are counted, and every row
    that is given carries the count of its series so far. `late` and `reference` bound the state.
    """

    def __init__(self, reference: int, late: int) -> None:
        self.reference, self.late = reference, late

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "batch_number int", "n bigint, mean double, m2 double")
        self.skipped = handle.getValueState("skipped", "n bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        held = {int(k[0]): tuple(v) for k, v in self.seen.iterator()}
        newest = max(held, default=None)
        touched, skipped = set(), int(self.skipped.get()[0]) if self.skipped.exists() else 0
        before_skips = skipped
        for pdf in rows:
            for number, y in pdf.groupby("batch_number")["y"]:
                number, y = int(number), y.dropna()
                if newest is not None and number < newest - self.late:
                    skipped += len(y)
                    continue
                mean = float(y.mean()) if len(y) else 0.0
                held[number] = _merge(held.get(number, (0, 0.0, 0.0)), (len(y), mean, float(((y - mean) ** 2).sum())))
                touched.add(number)
        if skipped != before_skips:
            self.skipped.update((skipped,))
            # The newest batch is given again, so the count is seen even if nothing else changed.
            touched.add(max(held))
        oldest = max(held, default=0) - self.late - self.reference
        out = []
        for number in sorted(held):
            if any(number - self.reference <= t <= number for t in touched):
                before: Parts = (0, 0.0, 0.0)
                for b in range(max(number - self.reference, min(held)), number):
                    before = _merge(before, held.get(b, (0, 0.0, 0.0)))
                out.append((*key, number, *_sample(held[number]), *_sample(before), skipped))
            if number < oldest:
                if self.seen.containsKey((number,)):
                    self.seen.removeKey((number,))
            elif number in touched:
                self.seen.updateValue((number,), held[number])
        yield pd.DataFrame(out, columns=[field.split()[0] for field in OUTPUT.split(", ")])

    def close(self) -> None:
        pass


def drift_stream(panel: DataFrame, rule: DriftRule = DriftRule(), late_batches: int = 6) -> DataFrame:
    """A stream of panel rows (with batch_number) to drift rows per series and batch, in update mode.

    The newest row of a batch counts; it equals that of `drift_flags` once the batch is whole. A daily panel has one
    row per series and day, so no key is hot however skewed the sales are. `rows_skipped` counts the rows of the series
    that came more than `late_batches` late, up to that version; the largest of a series is its total.
    """
    moments = panel.groupBy("store_id", "product_id").transformWithStateInPandas(
        statefulProcessor=BatchMoments(rule.reference_batches, late_batches),
        outputStructType=OUTPUT,
        outputMode="update",
        timeMode="none",
    )
    sides = Moments(*map(F.col, ("n1", "m1", "v1"))), Moments(*map(F.col, ("n0", "m0", "v0")))
    score, flag = judged(*sides, rule)
    return moments.select(*RUN_KEY, score.alias("drift_score"), flag.alias("has_concept_drift"), "rows_skipped")
