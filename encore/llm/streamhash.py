"""SHA-256 of ordered texts of any number, without holding a group in memory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.session import shuffle_partitions

CHUNK = 1 << 16  # characters of a packed run of texts


def _fields(df: DataFrame, keys: Sequence[str]) -> str:
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return ", ".join(f"{k} {kinds[k]}" for k in keys)


def sha256_of_runs(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], text: str, between: str, name: str, pack: bool = True
) -> DataFrame:
    """``keys`` and the SHA-256 (lowercase hex) of the group's texts in ``order``, joined by ``between``, as ``name``.

    One hash is one stream of bytes, so the texts of a group meet in one task at last; with ``pack`` they are first
    joined to runs of 64 K characters by a range partitioning, so that this task reads few rows, and it holds one run
    at a time. Rows of a group need different values of ``order``, none of them null; keys may be null.
    """
    parts = shuffle_partitions(rows.sparkSession)
    wide = rows.select(*keys, *order, F.col(text).alias("_run"))
    if pack:
        wide = wide.repartitionByRange(parts, *keys, *order).sortWithinPartitions(*keys, *order)
        wide = wide.mapInArrow(_packer(len(keys), len(order), between), wide.schema)
    dealt = wide.repartition(parts, *keys).sortWithinPartitions(*keys, *order)
    return dealt.mapInArrow(_hasher(len(keys), between, name), f"{_fields(rows, keys)}, {name} string")


def _packer(n_keys: int, n_order: int, between: str):
    """Runs of a group's neighbouring texts, under the order of the first of them."""

    def run(batches):
        import pyarrow as pa

        held, texts, size, out, weight, schema = None, [], 0, [], 0, None
        for batch in batches:
            schema = batch.schema
            columns = [c.to_pylist() for c in batch.columns]
            for row in zip(*columns):
                text = row[-1]
                if held is None or row[:n_keys] != held[:n_keys] or size > CHUNK:
                    if held is not None:
                        out.append((*held, between.join(texts)))
                        weight += size + 64
                    held, texts, size = row[:-1], [], 0
                texts.append(text)
                size += len(text) + len(between)
            if weight > CHUNK * 16:
                yield _batch(out, schema, pa)
                out, weight = [], 0
        if held is not None:
            out.append((*held, between.join(texts)))
            yield _batch(out, schema, pa)

    return run


def _batch(rows, schema, pa):
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _hasher(n_keys: int, between: str, name: str):
    def run(batches):
        import hashlib

        import pyarrow as pa

        schema, key, state, out = None, None, None, []
        for batch in batches:
            if schema is None:
                schema = pa.schema([*list(batch.schema)[:n_keys], pa.field(name, pa.string())])
            columns = [c.to_pylist() for c in batch.columns[:n_keys]]
            for *now, text in zip(*columns, batch.column(batch.num_columns - 1)):
                if state is None or now != key:
                    if state is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = now, hashlib.sha256()
                elif between:
                    state.update(between.encode())
                state.update(text.as_py().encode())
            if len(out) > 10_000:
                yield _batch(out, schema, pa)
                out = []
        if state is not None:
            out.append((*key, state.hexdigest()))
            yield _batch(out, schema, pa)

    return run
