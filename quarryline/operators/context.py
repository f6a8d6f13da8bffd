"""Compaction of a conversation's context: what turns are taken into summaries while it grows."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Turns between summaries, turns that a summary reads again, tokens that force one, and turns left as they are then.
INTERVAL, OVERLAP, THRESHOLD, RETAIN = 5, 2, 14336, 5


def compactions(turns: DataFrame, interval: int = INTERVAL, overlap: int = OVERLAP, threshold: int = THRESHOLD, retain: int = RETAIN) -> DataFrame:
    """(conv_id, no, at_turn, first_turn, last_turn, cause, live): each summary that a conversation's context is compacted into.

    turns: conv_id, turn, tokens. Where the turns that no summary holds have more than threshold tokens, all of them but the last
    retain are summarised (cause threshold); else, where there are interval of them, all are (cause interval). A later
    summary begins overlap turns before those turns. live is the tokens of the turns that it leaves. One pass in order with the
    last turns as state, carried over batches, so that a conversation of any length passes through its task without being held.
    Turns without conv_id are left out, nulls in tokens count as 0, equal turns stand in order of their tokens.
    """
    kind = {c: turns.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}
    names = ["conv_id", "no", "at_turn", "first_turn", "last_turn", "cause", "live"]

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, fresh, earlier, live, no = None, deque(), deque(maxlen=overlap), 0, 0
        for batch in batches:
            out = []
            for conv, turn, tokens in zip(batch.conv_id, batch.turn, batch.tokens, strict=True):
                if conv != own:
                    own, fresh, earlier, live, no = conv, deque(), deque(maxlen=overlap), 0, 0
                fresh.append((turn, tokens))
                live += tokens
                cause = "threshold" if live > threshold and len(fresh) > retain else "interval" if len(fresh) >= interval else None
                if not cause:
                    continue
                no, first = no + 1, (earlier[0] if earlier else fresh[0][0])
                for _ in range(len(fresh) - retain if cause == "threshold" else len(fresh)):
                    last, size = fresh.popleft()
                    live -= size
                    earlier.append(last)
                out.append((conv, no, turn, first, last, cause, live))
            yield pd.DataFrame(out, columns=names)

    rows = turns.where("conv_id is not null").select("conv_id", "turn", F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"))
    order = ["conv_id", "turn", "tokens"]
    schema = f"conv_id {kind['conv_id']}, no long, at_turn {kind['turn']}, first_turn {kind['turn']}, last_turn {kind['turn']}, cause string, live long"
    return rows.repartition("conv_id").sortWithinPartitions(*order).mapInPandas(fold, schema)
