"""Transaction assembly over a stream: rows wait in state until their transaction ends."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.operators.transactions import BEGIN, DATA, END

OUTPUT = "source_partition int, txn_id string, db string, tbl string, payload string, transaction_end boolean"
STATE = "txn_id string, rows array<struct<db:string,tbl:string,payload:string>>"


def assemble_stream(events: DataFrame) -> DataFrame:
    """Rows of closed transactions from ``source_partition, seq, txn_id, type, db, tbl, payload``.

    State is kept for each source partition: BEGIN empties it, DATA adds to it, END emits it with ``transaction_end``
    on the last row. Rows of a partition arrive in order of ``seq`` within a micro-batch.
    """

    def step(key: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        open_id, held = (state.get[0], [tuple(r) for r in state.get[1]]) if state.exists else (None, [])
        out: list[tuple] = []
        for r in pd.concat(list(frames)).sort_values("seq").itertuples(index=False):
            if r.type == BEGIN:
                open_id, held = r.txn_id, []
            elif r.type == DATA and open_id is not None:
                held.append((r.db, r.tbl, r.payload))
            elif r.type == END and open_id is not None:
                out += [(key[0], open_id, *row, k == len(held) - 1) for k, row in enumerate(held)]
                open_id, held = None, []
        if open_id is None:
            if state.exists:
                state.remove()
        else:
            state.update((open_id, held))
        yield pd.DataFrame(out, columns=["source_partition", "txn_id", "db", "tbl", "payload", "transaction_end"])

    return events.groupBy("source_partition").applyInPandasWithState(step, OUTPUT, STATE, "append", GroupStateTimeout.NoTimeout)
