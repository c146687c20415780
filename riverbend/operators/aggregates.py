"""U4: a user's aggregate, in two phases.

Tasks first add up what they read, one accumulator a key, so that a hot key ships states and not
rows; states are then brought together by key and merged in passing. Neither phase holds more than
a bounded number of keys or one state.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

MAX_KEYS = 100_000  # accumulators that a task holds before it hands them on
MERGED = 10_000  # results in a batch


class Aggregate:
    """What a user writes. Accumulators are tuples of the fields of ``state``."""

    state: str
    result_type: str

    def create(self) -> tuple:
        raise NotImplementedError

    def add(self, acc: tuple, *columns: pa.Array) -> tuple:
        """The accumulator after more rows of its key, given as one array for each input column."""
        raise NotImplementedError

    def merge(self, a: tuple, b: tuple) -> tuple:
        raise NotImplementedError

    def result(self, acc: tuple) -> Any:
        raise NotImplementedError


class Count(Aggregate):
    """Rows of a key."""

    state, result_type = "n bigint", "bigint"

    def create(self):
        return (0,)

    def add(self, acc, *columns):
        return (acc[0] + len(columns[0]),)

    def merge(self, a, b):
        return (a[0] + b[0],)

    def result(self, acc):
        return acc[0]


class Mean(Aggregate):
    """Mean of whole numbers of a unit (``unit`` to one); nulls are skipped, none left: null."""

    state, result_type = "n bigint, total decimal(38,0)", "double"

    def __init__(self, unit: int = 1):
        self.unit = unit

    def create(self):
        return 0, 0

    def add(self, acc, *columns):
        values = columns[0].drop_null().to_pylist()
        return acc[0] + len(values), acc[1] + sum(values)

    def merge(self, a, b):
        return a[0] + b[0], a[1] + b[1]

    def result(self, acc):
        return int(acc[1]) / self.unit / acc[0] if acc[0] else None


def user_aggregate(df: DataFrame, keys: list[str], inputs: list[str], aggregate: Aggregate, name: str,
                   max_keys: int = MAX_KEYS) -> DataFrame:
    """``keys`` and ``name``, the result of ``aggregate`` over the ``inputs`` of each key's rows.

    Null keys are keys. ``merge`` is called in no particular order, so it must not depend on one.
    """
    width = len(keys)
    state = StructType.fromDDL(aggregate.state)
    rows = df.select(*keys, *inputs)
    key_types = [to_arrow_type(rows.schema[k].dataType) for k in keys]
    state_types = [to_arrow_type(f.dataType) for f in state.fields]
    result_type = to_arrow_type(StructType.fromDDL(f"r {aggregate.result_type}")["r"].dataType)
    state_names = [f"_s{i}" for i in range(len(state.fields))]

    def batch(found: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}
        out = lambda: batch([(*k, *a) for k, a in held.items()], key_types + state_types, keys + state_names)
        for b in batches:
            places: dict[tuple, list[int]] = {}
            for i, k in enumerate(zip(*(c.to_pylist() for c in b.columns[:width]))):
                places.setdefault(k, []).append(i)
            for k, at in places.items():
                some = pa.array(at)
                held[k] = aggregate.add(held.get(k) or aggregate.create(), *(c.take(some) for c in b.columns[width:]))
            if len(held) >= max_keys:
                yield out()
                held = {}
        if held:
            yield out()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        key, acc = None, None
        out = lambda: batch(done, [*key_types, result_type], [*keys, name])
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if acc is not None and row[:width] == key:
                    acc = aggregate.merge(acc, row[width:])
                    continue
                if acc is not None:
                    done.append((*key, aggregate.result(acc)))
                key, acc = row[:width], row[width:]
                if len(done) >= MERGED:
                    yield out()
                    done = []
        if acc is not None:
            done.append((*key, aggregate.result(acc)))
        if done:
            yield out()

    ddl = lambda fields, names: ", ".join(f"`{n}` {f.dataType.simpleString()}" for n, f in zip(names, fields))
    kinds = ddl([rows.schema[k] for k in keys], keys)
    states = rows.mapInArrow(collect, f"{kinds}, {ddl(state.fields, state_names)}")
    # One row a key and task: partitions hold whole keys, sorted, and are merged as they are read.
    return states.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys).mapInArrow(
        merge, f"{kinds}, `{name}` {aggregate.result_type}")
