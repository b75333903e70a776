"""The answer cache as keyed state of a stream of questions.

The key is the rounded head of the question's vector and top_k, so one question with two depths is two entries. An entry
that is there is refreshed, its answer kept; an entry not asked for within ``idle_ms`` of processing time goes, which bounds
the state (and keeps batches coming, so the stream is run until stopped, not by availableNow). Questions of one batch and key are taken in order of their id. Questions without a key are dropped before.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUT = "key string, qid bigint, answer string, hit boolean"
STATE = "answer string, hits bigint"


def cached_answers(questions: DataFrame, idle_ms: int | None = 3_600_000) -> DataFrame:
    """Of a stream ``questions(key, qid, answer)``, where answer is what a fresh run gives: the answer served and hit.

    With ``idle_ms`` None nothing is forgotten and the stream may end (availableNow).
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(batches)).sort_values("qid")
        answer, hits = state.get if state.exists else (None, 0)
        out = []
        for qid, fresh in zip(rows["qid"], rows["answer"]):
            hit = answer is not None
            answer, hits = (answer, hits + 1) if hit else (fresh, hits)
            out.append((key[0], qid, answer, hit))
        if answer is not None:
            state.update((answer, hits))
            if idle_ms is not None:
                state.setTimeoutDuration(idle_ms)
        yield pd.DataFrame(out, columns=["key", "qid", "answer", "hit"])

    timeout = GroupStateTimeout.NoTimeout if idle_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    return questions.where("key is not null").groupBy("key").applyInPandasWithState(step, OUT, STATE, "append", timeout)
