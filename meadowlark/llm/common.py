"""What the corpus operators share: the shared folder, staged tables, word hashes."""

from __future__ import annotations

import re
import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meadowlark.sources.derived import table  # noqa: F401
from meadowlark.sources.scratch import fresh_path, release, shared_dir  # noqa: F401


def file_system(path: str):
    """The file system and the path within it, for any URI that Arrow or Hadoop knows."""
    from pyarrow import fs

    local = re.sub(r"^file:/+", "/", path)
    return (fs.LocalFileSystem(), local) if local.startswith("/") else fs.FileSystem.from_uri(path)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` as Parquet to the shared folder and reads it back: a cut in the lineage
    that any executor can reread."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Lets the executors import this package: adds it to the application's Python files, once."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        root = Path(__file__).resolve().parents[2]
        sc.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/meadowlark", "zip", root, "meadowlark"))
        _SHIPPED.add(sc.applicationId)


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def without(df: DataFrame, new: list[str]) -> list[str]:
    """Columns of ``df`` that an operator adding ``new`` keeps: on a clash the new one wins."""
    taken = {n.lower() for n in new}
    return [c for c in df.columns if c.lower() not in taken]


def col(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def place_of(df: DataFrame, name: str) -> int:
    """A column's position by its exact name, else by the name in any case."""
    for same in (lambda c: c == name, lambda c: c.lower() == name.lower()):
        if found := [i for i, c in enumerate(df.columns) if same(c)]:
            return found[0]
    raise ValueError(f"no column {name!r} among {df.columns}")


def add_by_rows(df: DataFrame, reads: list[str], new: list[T.StructField], rows, piece: int = 4 << 20) -> DataFrame:
    """``df`` with columns that ``rows(list per column in reads) -> list per new column`` makes from
    a few rows at a time, in tasks, by Arrow. A slice has about ``piece`` bytes of input or one row.
    Columns go by position inside, so that their names can be any."""
    taken = {f.name.lower() for f in new}
    keep = [i for i, c in enumerate(df.columns) if c.lower() not in taken]
    places = [place_of(df, c) for c in reads]
    schema = T.StructType([df.schema.fields[i] for i in keep] + new)
    kinds = [pa_type(f.dataType) for f in new]
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, piece):
                made = rows(*[part.column(i).to_pylist() for i in places])
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in keep], *[pa.array(v, k) for v, k in zip(made, kinds, strict=True)]], names)

    return map_arrow(df.toDF(*[f"c{i}" for i in range(len(df.columns))]), run, schema)


def slices(batch: pa.RecordBatch, piece: int) -> Iterator[pa.RecordBatch]:
    step = max(1, int(batch.num_rows * piece / max(batch.nbytes, 1)))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def pa_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


# ---- words as 64-bit hashes -------------------------------------------------------------------

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.full(512, _STEP, np.uint64), dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finish that spreads every input bit (in place)."""
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


#: Bytes of text that are hashed at once: the arrays take some 40 times as much.
_AT_ONCE = 2 << 20


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words (as ``str.split()`` finds them) of all texts in a row, and the
    offsets of each text's words: text i has hashes[offsets[i]:offsets[i + 1]]."""
    raw = b"\n".join(" ".join(t.split()).encode("utf-8", "surrogatepass") if t else b"" for t in texts)
    found, counts, at = [], [], 0
    while at <= len(raw):
        stop = len(raw) if len(raw) - at <= _AT_ONCE else max(raw.rfind(b" ", at, at + _AT_ONCE), raw.rfind(b"\n", at, at + _AT_ONCE))
        if stop < at:  # a word longer than that
            ends = [x for x in (raw.find(b" ", at), raw.find(b"\n", at)) if x >= 0]
            stop = min(ends, default=len(raw))
        data = np.frombuffer(raw, np.uint8, stop - at, at)
        hashes, starts = _hashes(data)
        found.append(hashes)
        breaks = np.flatnonzero(data == 10)
        # of each text that ends in this piece, and of the one that goes on
        here = np.diff(np.searchsorted(starts, breaks), prepend=0, append=len(hashes))
        here[-1] = len(hashes) - here[:-1].sum()
        if counts:
            counts[-1] += int(here[0])
            counts += here[1:].tolist()
        else:
            counts = here.tolist()
        if stop < len(raw) and raw[stop] == 10:
            counts.append(0)
        at = stop + 1
    return np.concatenate(found), np.concatenate([[0], np.cumsum(counts[: len(texts)] if texts else [], dtype=np.int64)]).astype(np.int64)


def _hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in bytes, and where they start."""
    inside = np.flatnonzero((data != 32) & (data != 10))
    if not len(inside):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.empty(len(inside), bool)
    first[0] = True
    np.not_equal(np.diff(inside), 1, out=first[1:])
    starts = np.flatnonzero(first)
    lengths = np.diff(np.append(starts, len(inside)))
    place = np.arange(len(inside)) - np.repeat(starts, lengths)
    value = _BYTE[data[inside]]
    value *= _POWERS[place & 511] + (place >> 9).astype(np.uint64) * _STEP if int(lengths.max()) > 512 else _POWERS[place]
    return mix(np.add.reduceat(value, starts) + lengths.astype(np.uint64) * _STEP), inside[starts]


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-word grams that start at each word but the last n - 1."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = words[:count] * _POWERS[0]
    for i in range(1, n):
        total += words[i : i + count] * _POWERS[7 * i]
    return mix(total)


def sorted_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch | pa.Table]:
    """Whole groups of rows with equal ``keys`` from batches that are sorted by them; several
    groups may come at once, and none is split."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cut = last_change(batch, keys)
        if cut is None and held and same_key(held[-1], batch, keys):
            held.append(batch)
            continue
        if held:
            if same_key(held[-1], batch, keys):
                first = first_change(batch, keys)
                held.append(batch.slice(0, first))
                batch = batch.slice(first)
                cut = last_change(batch, keys)
            yield pa.Table.from_batches(held).combine_chunks()
        if cut:
            yield pa.Table.from_batches([batch.slice(0, cut)])
        held = [batch.slice(cut or 0)]
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _differs(batch, keys: list[str]) -> np.ndarray:
    """For each row but the first: whether its key is not the row's before."""
    out = np.zeros(max(batch.num_rows - 1, 0), bool)
    for k in keys:
        v = batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False)
        out |= v[1:] != v[:-1]
    return out


def last_change(batch: pa.RecordBatch, keys: list[str]) -> int | None:
    at = np.flatnonzero(_differs(batch, keys))
    return int(at[-1]) + 1 if len(at) else None


def first_change(batch: pa.RecordBatch, keys: list[str]) -> int:
    at = np.flatnonzero(_differs(batch, keys))
    return int(at[0]) + 1 if len(at) else batch.num_rows


def same_key(a: pa.RecordBatch, b: pa.RecordBatch, keys: list[str]) -> bool:
    return all(a.column(a.schema.get_field_index(k))[a.num_rows - 1].as_py() == b.column(b.schema.get_field_index(k))[0].as_py() for k in keys)


def group_starts(part: pa.Table, keys: list[str]) -> np.ndarray:
    """Where each group begins in a table sorted by its keys, and the end."""
    return np.concatenate([[0], np.flatnonzero(_differs(part, keys)) + 1, [part.num_rows]]).astype(np.int64)
