"""New awards as they arrive: each micro-batch goes through the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tallyloom.config import MatchConfig
from tallyloom.operators.matching import match_awards, match_log


def match_stream(awards: DataFrame, references: DataFrame, aliases: DataFrame, path: str, checkpoint: str, config: MatchConfig = MatchConfig()) -> StreamingQuery:
    """Appends the matches of a stream of awards to a Parquet table, batch by batch in folders of their own, so that a batch that runs again replaces itself."""

    def one(batch: DataFrame, number: int) -> None:
        match_log(match_awards(batch, references, aliases, config), config.output_prefix).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return awards.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
