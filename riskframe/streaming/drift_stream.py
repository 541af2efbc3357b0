"""Drift per run over a stream: bin counts as state between micro-batches, runs closed by event time.

A run is a fixed span of event time (a day). Every micro-batch adds its bin counts to the open runs of a
feature; when the watermark passes the end of a run, a timer closes it: its PSI against the
reference is final, and its verdict counts as lasting if the closed runs before it say so too. State per
feature is the counts of its open runs and the PSI of the last few closed ones, so it is bounded by the
watermark's delay, whatever the number of rows. Before the shuffle, rows are counted per run, feature and
bin inside each Arrow batch: a hot feature's task receives counts, not rows.

Results equal those of the batch operators on all runs that the watermark has passed. Rows behind the
watermark are dropped, as the verdict of their run may have been given. A restart continues from the checkpoint.
"""

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from riskframe import config as C
from riskframe.operators.drift import reference_bins
from riskframe.session import by_value

by_value(__name__)

DAY = "1 day"
_COUNTS = "feature string, run long, seen timestamp, counts array<long>"
RESULT = "feature string, run long, rows long, psi double, verdict string, persistent_verdict string"


def _verdict(psi: float | None, warn: float, act: float) -> str:
    return "unknown" if psi is None else "act" if psi >= act else "watch" if psi >= warn else "stable"


def _psi(counts: Sequence[int], reference: Sequence[int], floor: float) -> float | None:
    now, was = np.asarray(counts, dtype=float), np.asarray(reference, dtype=float)
    if not now.sum() or not was.sum():
        return None
    a, r = np.maximum(now / now.sum(), floor), np.maximum(was / was.sum(), floor)
    return float(((a - r) * np.log(a / r)).sum())


def run_counts(stream: DataFrame, bins: dict, ts: str = "ts", seconds: int = 86_400) -> DataFrame:
    """Per Arrow batch: counts per feature and run (its number since 1970), with the latest time seen."""
    names = list(bins)
    numbered = stream.where(F.col(ts).isNotNull()).select(
        F.floor(F.col(ts).cast("double") / seconds).cast("long").alias("run"), F.col(ts).alias("seen"),
        *[bins[c].number.cast("int").alias(f"b{i}") for i, c in enumerate(names)],
    )
    sizes = [len(bins[c].reference) for c in names]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for run, part in batch.groupby("run"):
                seen = part["seen"].max()
                for i, name in enumerate(names):
                    found = part[f"b{i}"].dropna().astype(int)
                    rows.append((name, int(run), seen, np.bincount(found, minlength=sizes[i]).tolist()))
            yield pd.DataFrame(rows, columns=["feature", "run", "seen", "counts"])

    return numbered.mapInPandas(count, _COUNTS)


def drift_runs(
    stream: DataFrame,
    ref: DataFrame,
    cols: Sequence[str],
    ts: str = "ts",
    seconds: int = 86_400,
    delay: str = "1 hour",
    length: int = C.PERSISTENCE_RUNS,
) -> DataFrame:
    """Streaming rows (feature, run, rows, psi, verdict, persistent_verdict), one when a run closes."""
    bins = reference_bins(ref, cols)
    reference = {c: b.reference for c, b in bins.items()}
    warn, act, floor = C.PSI_WARN, C.PSI_ALARM, C.SHARE_FLOOR

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        feature = key[0]
        # open runs by number; PSI of the last closed runs, oldest first; the last closed run
        runs, last, closed = {}, [], None
        if state.exists:
            stored = json.loads(state.get[0])
            runs, last, closed = {int(k): v for k, v in stored["runs"].items()}, stored["last"], stored["closed"]
        for batch in batches:
            for run, counts in zip(batch["run"], batch["counts"], strict=True):
                if closed is None or run > closed:
                    runs[int(run)] = [a + int(b) for a, b in zip(runs.get(int(run), [0] * len(counts)), counts, strict=True)]
        over = state.getCurrentWatermarkMs() // 1000 // seconds  # runs before this one are complete
        out = []
        for run in sorted(r for r in runs if r < over):
            counts = runs.pop(run)
            psi = _psi(counts, reference[feature], floor)
            last, closed = [*last, psi][-length:], run
            held = min(last) if len(last) == length and None not in last else None
            out.append((
                feature, run, sum(counts), psi, _verdict(psi, warn, act),
                "stable" if held is None else _verdict(held, warn, act),
            ))
        state.update((json.dumps({"runs": runs, "last": last, "closed": closed}),))
        if runs:
            state.setTimeoutTimestamp(max((min(runs) + 1) * seconds * 1000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=["feature", "run", "rows", "psi", "verdict", "persistent_verdict"])

    return (
        run_counts(stream, bins, ts, seconds)
        .withWatermark("seen", delay)
        .groupBy("feature")
        .applyInPandasWithState(
            update, RESULT, "stored string", "append", GroupStateTimeout.EventTimeTimeout
        )
    )


def store_runs(runs: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append closed runs to a Parquet table, taking all data available now."""
    return (
        runs.writeStream.outputMode("append").format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
