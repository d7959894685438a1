"""A user's scorer or token provider as an operator: loaded once per task, called on distinct values.

A text that fills a third of the table is scored once. What the model refuses (null) or
cannot take (an error) gets the rule instead, and a status column says which of the two
answered, so a failing provider never loses rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

Load = Callable[[], Any]
Apply = Callable[[Any, pd.Series], pd.Series]


def answers(load: Load, apply: Apply, returns: str):
    """An iterator UDF: text to ``struct<value, error>``.

    ``load`` runs once per task, ``apply`` once per Arrow batch. When a batch raises, its
    values are tried one by one and only those that raise again carry the error.
    """

    def single(model, text) -> tuple:
        try:
            return apply(model, pd.Series([text], dtype=object)).iloc[0], None
        except Exception as exc:  # the provider's own errors, reported with the row
            return None, f"{type(exc).__name__}: {exc}"

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = load()
        for texts in batches:
            try:
                found = list(apply(model, texts))
                if len(found) != len(texts):
                    raise ValueError(f"{len(found)} answers for {len(texts)} texts")
                pairs = [(v, None) for v in found]
            except Exception:
                pairs = [single(model, t) for t in texts]
            yield pd.DataFrame(pairs, columns=["value", "error"], dtype=object)

    # Annotations are read at run time, so they are given as types here.
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, f"value {returns}, error string")


def with_model(df: DataFrame, text: str, load: Load, apply: Apply, returns: str, rule: Column, out: str) -> DataFrame:
    """Add ``out``, ``<out>_status`` (MODEL, RULE_REFUSED, RULE_FAILED, RULE_EMPTY) and ``<out>_error``.

    Null texts never reach the model. ``rule`` is an expression over ``df``'s columns. Rows,
    also repeated ones, keep their number; an existing column named as one of the three is an error.
    """
    ship_package(df.sparkSession)
    taken = {out, f"{out}_status", f"{out}_error"} & set(df.columns)
    if taken:
        raise ValueError(f"columns exist: {sorted(taken)}")
    key, got = "__text", "__answer"
    once = df.select(F.col(text).alias(key)).where(F.col(key).isNotNull()).distinct()
    scored = once.select(key, answers(load, apply, returns)(F.col(key)).alias(got))
    rows = df.join(scored, F.col(text) == F.col(key), "left")
    value, error = F.col(f"{got}.value"), F.col(f"{got}.error")
    status = F.when(F.col(text).isNull(), "RULE_EMPTY").when(error.isNotNull(), "RULE_FAILED").when(value.isNull(), "RULE_REFUSED").otherwise("MODEL")
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce(value, rule).alias(out), status.alias(f"{out}_status"), error.alias(f"{out}_error"))
