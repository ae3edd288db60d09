"""Review sessions as state: what a reviewer has set is kept until the session saves it.

A session's events come in order: 'set' gives an item a status, 'jump' and 'close' save all that was set before, anything else
only moves on. A status that was set and never saved is lost, as in the review file.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

#: Actions that save.
SAVES = ("jump", "close")
STATUS = StructType([StructField("status", IntegerType()), StructField("seq", LongType())])
#: The state needs a store that holds maps.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Sessions(StatefulProcessor):
    """By session: a map of what is set and not saved; rows of what a save brings to the review file."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.pending = handle.getMapState("pending", StructType([StructField("relkey", StringType())]), STATUS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        events = pd.concat(list(rows)).sort_values("seq", kind="stable")
        pending: dict[str, tuple[int, int]] = {k[0]: tuple(v) for k, v in self.pending.iterator()}
        held, saved = set(pending), []
        for seq, action, relkey, status in zip(*(events[c].tolist() for c in ("seq", "action", "relkey", "status")), strict=True):
            if action == "set" and relkey is not None:
                pending[relkey] = (int(status), int(seq))
            elif action in SAVES:
                saved += [(key[0], k, s, n, int(seq)) for k, (s, n) in pending.items()]
                pending = {}
        for k in held - set(pending):
            self.pending.removeKey((k,))
        for k, v in pending.items():
            self.pending.updateValue((k,), v)
        if saved:
            yield pd.DataFrame(saved, columns=["session", "relkey", "status", "seq", "saved_at"])

    def close(self) -> None:
        pass


def saved_reviews(events: DataFrame, session: str = "session") -> DataFrame:
    """(session, relkey, status, seq, saved_at): a row for each item that a save brings to the review file, in append mode.

    events: a stream of (session, seq, action, relkey, status), whose sessions arrive in order of seq, each batch in any order.
    seq is the event that set the status, saved_at the one that saved it. The last row of a key by seq is what the file holds
    (``upsert_reviews`` keeps it). State is what a session has set and not saved. The session's configuration must name
    ``PROVIDER`` as spark.sql.streaming.stateStore.providerClass.
    """
    kind = events.schema[session].dataType.simpleString()
    rows = events.selectExpr(f"`{session}` as session", "cast(seq as long) as seq", "action", "cast(relkey as string) as relkey", "cast(status as int) as status")
    return rows.groupBy("session").transformWithStateInPandas(Sessions(), f"session {kind}, relkey string, status int, seq long, saved_at long", "append", "none")
