"""Keyed rules on a table whose rows have an order of arrival (K1-K3 with late rows).

The table forms of the rules take a key's rows in order of time. A stream meets them batch by
batch and judges late rows by the state at their arrival. Here a table with the number of the
batch that each row came with is labelled just as the stream labelled it: rows are sorted by
key, batch and order, and one pass over Arrow batches carries the state of the key at hand.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from sigweave.streaming.steps import Step


def by_arrival(
    df: DataFrame,
    keys: Sequence[str],
    batch: str,
    order: Sequence[str],
    steps: Sequence[Step],
) -> DataFrame:
    """Adds the labels of ``steps`` as a stream would that got the rows in order of ``batch``.

    Rows of one batch are taken by ``order``, nulls first. A name the row already has keeps the
    row's value. A late row changes what later rows find, so a key's rows are worked on one
    after another; a task holds one Arrow batch and the state of one key, however many rows the
    key has.
    """
    labels: list[tuple[str, T.DataType]] = []
    shown: list[list[bool]] = []
    taken = set(df.columns)
    for step in steps:
        shown.append([name not in taken for name, _ in step.labels])
        for name, kind in step.labels:
            if name not in taken:
                taken.add(name)
                labels.append((name, T.DataType.fromDDL(kind)))
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, k) for n, k in labels]])
    kinds = [to_arrow_type(k) for _, k in labels]
    fields = [f for step in steps for f, _ in step.state]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, {}
        for part in batches:
            rows = part.to_pylist()
            found: list[list] = [[] for _ in labels]
            for row in rows:
                key = tuple(row[k] for k in keys)
                if key != current:
                    current, state = key, dict.fromkeys(fields)
                put = iter(found)
                for step, flags in zip(steps, shown, strict=True):
                    values = step.apply(row, state)
                    for (name, _), value, show in zip(step.labels, values, flags, strict=True):
                        if show:
                            row[name] = value
                            next(put).append(value)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, *(pa.array(v, k) for v, k in zip(found, kinds, strict=True))],
                [*part.schema.names, *(n for n, _ in labels)],
            )

    return (
        df.repartition(*keys).sortWithinPartitions(*keys, batch, *order).mapInArrow(run, schema)
    )
