"""Scorers of one's own as table functions, for lateral joins in SQL and DataFrames."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import UserDefinedTableFunction

Scorer = Callable[[str], float | None]


def score_table(scorers: dict[str, Scorer]) -> UserDefinedTableFunction:
    """A table function of a text with a row (scorer, score) for each scorer, in the order given; a null text counts as empty.

    A scorer that raises gives a null score and the error's name, so that one bad text does not end a job.
    """

    class Scores:
        def eval(self, text: str):  # noqa: ANN202
            for name, scorer in scorers.items():
                try:
                    score = scorer(text or "")
                    yield name, None if score is None else float(score), None
                except Exception as error:  # noqa: BLE001
                    yield name, None, type(error).__name__

    return udtf(Scores, returnType="scorer string, score double, error string")


def register_scorers(spark: SparkSession, name: str, scorers: dict[str, Scorer]) -> None:
    """Make the scorers callable from SQL: ``FROM t, LATERAL name(t.text)``."""
    spark.udtf.register(name, score_table(scorers))


def call_syntax(text: str) -> float | None:
    """The share of a text's tagged tool calls that are JSON objects; null without calls."""
    calls = re.findall(r"<tool_call>(.*?)</tool_call>", text, re.DOTALL)
    good = 0
    for call in calls:
        try:
            good += isinstance(json.loads(call), dict)
        except ValueError:
            pass
    return good / len(calls) if calls else None


def brevity(most: int) -> Scorer:
    """A scorer that is 1 up to so many characters and then falls as their share."""
    return lambda text: min(1.0, most / max(1, len(text)))
