"""STA-1 on a stream: one date of state per device, kept in the state store.

The processor sees a device's rows of one micro-batch as pandas frames. Rows
are ordered by (ts, seq) within the batch; batches follow arrival order, as
the reference processes records. The state is written at most once, so the
rule reduces to: S = the stored date, else the first candidate of the batch;
a "1" becomes "0" exactly when S differs from the row's date. The dates are
computed by the same column expressions as in the batch form.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from rillflow.functions.dates import ts_to_date
from rillflow.operators.logs import visitor_candidate

INPUT_COLS = ("seq", "mid", "is_new", "ts", "value")
OUTPUT_SCHEMA = "seq long, mid string, is_new string, ts long, value string, fixed_is_new string"


class NewVisitorProcessor(StatefulProcessor):
    """Per-device first-visit date (ValueState ``first_login_dt``)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first_dt = handle.getValueState("first_login_dt", "dt string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True)
        pdf = pdf.sort_values(["ts", "seq"], kind="stable", ignore_index=True)
        day = pdf["day"]
        stored = self.first_dt.get() if self.first_dt.exists() else None
        state = stored[0] if stored else None
        if state is None:
            cand = pdf["cand"].dropna()
            if len(cand):
                state = cand.iloc[0]
                self.first_dt.update((state,))
        fixed = pdf["is_new"].where(~((pdf["is_new"] == "1") & (day != state)), "0")
        yield pdf.assign(fixed_is_new=fixed)[list(INPUT_COLS) + ["fixed_is_new"]]

    def close(self) -> None:
        pass


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def repair_stream(clean: DataFrame, zone: str = "UTC") -> DataFrame:
    """Clean log stream (with its text in ``value``) -> the same rows plus
    ``fixed_is_new``. Late rows are never dropped: no event-time mode. The
    state API needs the RocksDB state store, set here unless already chosen."""
    spark = clean.sparkSession
    key = "spark.sql.streaming.stateStore.providerClass"
    if "RocksDB" not in (spark.conf.get(key, "") or ""):
        spark.conf.set(key, ROCKSDB)
    return (clean.select(*INPUT_COLS, ts_to_date("ts", zone).alias("day"),
                         visitor_candidate(zone).alias("cand")).groupBy("mid")
            .transformWithStateInPandas(NewVisitorProcessor(), OUTPUT_SCHEMA,
                                        "Append", "None"))
