"""User extension point: a converter per route, DataFrame in and DataFrame out."""

from collections.abc import Callable, Iterator, Mapping
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Converter = Callable[[DataFrame], DataFrame]
Codec = Callable[[bytes], bytes]


def chain(*converters: Converter) -> Converter:
    """One converter that applies the given ones in order."""
    return lambda df: reduce(lambda current, convert: current.transform(convert), converters, df)


def convert_by_route(df: DataFrame, converters: Mapping[str, Converter], route: str = "route") -> DataFrame:
    """Each route's rows through its converter; rows of other routes pass unchanged.

    The branches read `df` once each: hand in a stored table (best partitioned by route) when its
    plan is expensive. All converters must return the same columns, or a ValueError names those
    that some leave out; rows that no converter takes have NULL in columns that converters add.
    """
    handled = F.coalesce(F.col(route).isin(*converters), F.lit(False))
    parts = [df.where(F.col(route) == name).transform(convert) for name, convert in converters.items()]
    columns = [set(part.columns) for part in parts]
    if columns and (odd := set.union(*columns) - set.intersection(*columns)):
        raise ValueError(f"converters differ in columns: {', '.join(sorted(odd))}")
    rest = df.where(~handled)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [*parts, rest])


def convert_bytes(
    df: DataFrame, codecs: Mapping[str, Codec], route: str = "route", data: str = "data", slice_bytes: int = 8 << 20
) -> DataFrame:
    """`df` with `result` and `error`: each row's bytes through the codec of its route, in one pass over the input.

    For codecs that are no column expressions: a codec is a function of one item's bytes. A codec that fails gives a row
    with its message in `error` and no result, and never ends the job; so does a route without a codec. NULL data stays
    NULL without an error. Rows are neither lost nor made. Columns called result or error are replaced. A task holds about
    `slice_bytes` of converted items at a time, one item at least.
    """
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in ("result", "error")])
    at_route, at_data = kept.columns.index(route), kept.columns.index(data)

    def one(name: str | None, raw: bytes | None) -> tuple[bytes | None, str | None]:
        if raw is None:
            return None, None
        if name not in codecs:
            return None, f"no codec for route {name}"
        try:
            return codecs[name](raw), None
        except Exception as failed:  # noqa: BLE001 - whatever a codec raises is its row's error
            return None, f"{type(failed).__name__}: {failed}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            results, errors, low, size = [], [], 0, 0
            for i in range(batch.num_rows):
                result, error = one(batch.column(at_route)[i].as_py(), batch.column(at_data)[i].as_py())
                results.append(result)
                errors.append(error)
                size += len(result or b"")
                if size >= slice_bytes or i + 1 == batch.num_rows:
                    part = batch.slice(low, i + 1 - low)
                    more = [pa.array(results, pa.binary()), pa.array(errors, pa.string())]
                    yield pa.RecordBatch.from_arrays([*part.columns, *more], [*part.schema.names, "result", "error"])
                    results, errors, low, size = [], [], i + 1, 0

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(run, f"{types}, result binary, error string")
