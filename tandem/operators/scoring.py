"""Batches of rows through a caller's model, tokenizer or segment metric."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

BatchFunction = Callable[[pd.DataFrame], dict[str, Any]]

PIECE_BYTES = 1 << 20


def pieces(batch: pa.RecordBatch, inputs: list[str], batch_size: int, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces whose ``inputs`` hold at most ``limit`` bytes, cut between calls where that is possible.

    A row that holds more is a piece of its own.
    """
    rows = len(batch)
    if rows < 2 or batch.select(inputs).nbytes <= limit:
        yield batch
        return
    half = rows // 2
    half = half // batch_size * batch_size or half
    yield from pieces(batch.slice(0, half), inputs, batch_size, limit)
    yield from pieces(batch.slice(half), inputs, batch_size, limit)


def score_batches(
    df: DataFrame,
    make_scorer: Callable[[], BatchFunction],
    inputs: list[str],
    outputs: str,
    batch_size: int = 2,
    partitions: int | None = None,
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Add the ``outputs`` (a DDL string) that a model computes from the ``inputs`` columns.

    ``make_scorer`` runs once per task, where it may load a model; the function it returns gets a pandas
    frame of at most ``batch_size`` rows and returns one list per output column. All other columns stay
    in their Arrow batch, so rows keep their keys, and order is a matter of keys, never of position.
    A call that returns more or fewer values than it got rows fails the job. Results leave the task in pieces of
    ``PIECE_BYTES`` of inputs, so a task's memory does not grow with its rows. ``partitions`` with ``spread_by`` deals the rows out by key before scoring. Write the result before
    using it twice: scoring is the expensive step.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    added = T.StructType.fromDDL(outputs)
    schema = T.StructType([*df.schema.fields, *added.fields])
    added_types = to_arrow_schema(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = make_scorer()
        for batch in (piece for whole in batches for piece in pieces(whole, inputs, batch_size)):
            frame = batch.select(inputs).to_pandas()
            results: dict[str, list] = {name: [] for name in added_types.names}
            for start in range(0, len(frame), batch_size):
                rows = frame.iloc[start : start + batch_size].reset_index(drop=True)
                found = scorer(rows)
                for name, values in results.items():
                    if len(found[name]) != len(rows):
                        raise ValueError(f"{name}: {len(found[name])} values for {len(rows)} rows")
                    values.extend(found[name])
            columns = [pa.array(results[field.name], type=field.type) for field in added_types]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *columns], names=[*batch.schema.names, *added_types.names]
            )

    if partitions:
        df = df.repartition(partitions, *(spread_by or []))
    return df.mapInArrow(run, schema)


def together(*makers: Callable[[], BatchFunction]) -> Callable[[], BatchFunction]:
    """Several scorers as one, so that their rows pass Python once."""
    def make() -> BatchFunction:
        scorers = [maker() for maker in makers]
        return lambda batch: {name: values for scorer in scorers for name, values in scorer(batch).items()}

    return make


def tokenize_columns(
    df: DataFrame, make_tokenizer: Callable[[], Callable[[list[str]], list[list[int]]]],
    into: dict[str, str], batch_size: int = 1000,
) -> DataFrame:
    """Add token ids of several text columns, named by ``into``, from a caller's tokenizer; rows pass Python once."""
    def make() -> BatchFunction:
        tokenizer = make_tokenizer()
        return lambda batch: {ids: tokenizer(batch[text].tolist()) for text, ids in into.items()}

    return score_batches(df, make, list(into), ", ".join(f"{ids} array<int>" for ids in into.values()), batch_size)


def tokenize_batches(
    df: DataFrame, make_tokenizer: Callable[[], Callable[[list[str]], list[list[int]]]],
    text: str = "text", into: str = "ids", batch_size: int = 1000,
) -> DataFrame:
    """Add token ids from a caller's tokenizer, which maps a list of texts to a list of id lists."""
    return tokenize_columns(df, make_tokenizer, {text: into}, batch_size)


def score_segments(
    triples: DataFrame, make_scorer: Callable[[], BatchFunction], outputs: str, batch_size: int = 10
) -> DataFrame:
    """Segment scores of a learned metric that sees source, hypothesis and reference."""
    return score_batches(triples, make_scorer, ["src", "mt", "ref"], outputs, batch_size)
