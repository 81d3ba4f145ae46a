"""Benchmark decontamination: pigeonhole edit matching.

A test item of n characters may occur in a document with up to ``RATE`` x n edits (insertions,
deletions, substitutions). Cut into one piece more than that budget, at least one piece of such an
occurrence is intact. An Aho-Corasick automaton finds all pieces of all items in one pass over a text;
hits of an item on neighbouring diagonals make a window, and Myers' bit-parallel algorithm computes
the least edit distance of the whole item within it. Both sides are lower-cased, and runs of white
space count as one space.

The items are staged in the shared folder in blocks of about ``BLOCK`` characters, whatever their number,
and never pass the driver. A task reads a block at a time and searches about ``HELD`` bytes of documents
for its items before it takes the next block; so documents are scanned once and never joined. A Python worker keeps
the automata it has built for its next texts and tasks, as many as hold ``KEPT`` characters of items, and one at least;
with more items than that, every ``HELD`` bytes of documents cost one building of each block beyond.

Nulls: a null or empty text or item matches nothing, a row with a null item id neither. Items that
share an id are all searched, and the least distance counts. Repeated rows are marked alike. An empty
table gives an empty one. A column of the input called ``leaks`` gives way. A very long text is searched
whole, in memory in proportion to its length.
"""

from __future__ import annotations

from collections import OrderedDict, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meadowlark.llm.common import col, file_system, fresh_path, map_arrow, pa_type, place_of

RATE = 0.08
BLOCK, HELD, KEPT = 1_000_000, 32 << 20, 8_000_000
LEAKS = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("distance", T.IntegerType())]))


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def distance_within(item: str, window: str, most: int) -> int | None:
    """The least edit distance of ``item`` to any substring of ``window``, if at most ``most`` (Myers 1999,
    as a search: the first row of the matrix is 0)."""
    m = len(item)
    at: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        at[c] |= 1 << i
    full, last = (1 << m) - 1, 1 << m - 1
    plus, minus, score, best = full, 0, m, m
    for c in window:
        eq = at.get(c, 0)
        x = eq | minus
        flat = (((eq & plus) + plus) ^ plus) | eq
        up, down = minus | (full & ~(flat | plus)), plus & flat
        if up & last:
            score += 1
        elif down & last:
            score -= 1
            if score < best:
                best = score
        up <<= 1
        plus, minus = ((down << 1) | (full & ~(x | up))) & full, up & x & full
    return best if best <= most else None


class Finder:
    """The pieces' automaton of some items."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        import ahocorasick

        self.items, self.budget = items, [int(len(x) * rate) for _, x in items]
        pieces: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for i, (_, x) in enumerate(items):
            parts = self.budget[i] + 1
            cuts = [len(x) * p // parts for p in range(parts + 1)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                pieces[x[a:b]].append((i, a))
        self.found = ahocorasick.Automaton()
        for piece, where in pieces.items():
            self.found.add_word(piece, (len(piece), where))
        self.found.make_automaton()
        self.size = sum(len(x) for _, x in items) + 1

    def leaks(self, text: str) -> list[tuple[int, int]]:
        """(item id, distance) of each item that occurs."""
        if not self.items:  # a block that no item fell into
            return []
        diagonals: dict[int, set[int]] = defaultdict(set)
        for end, (n, where) in self.found.iter(text):
            for i, a in where:
                diagonals[i].add(end + 1 - n - a)
        out: dict[int, int] = {}
        for i, found in diagonals.items():
            (item_id, item), most = self.items[i], self.budget[i]
            order = sorted(found)
            at = 0
            while at < len(order):
                upto = at
                while upto + 1 < len(order) and order[upto + 1] - order[upto] <= most:
                    upto += 1
                window = text[max(0, order[at] - most) : order[upto] + len(item) + most]
                d = 0 if item in window else distance_within(item, window, most)
                if d is not None and d < out.get(item_id, most + 1):
                    out[item_id] = d
                at = upto + 1
        return sorted(out.items())


def staged_items(items: DataFrame, text: str, item_id: str, size: int) -> tuple[str, int]:
    """The folder of the items in blocks (``block=0``, ...), and how many there are."""
    rows = items.select(col(item_id).cast("long").alias("item_id"), col(text).alias("text")).where("item_id is not null and trim(text) <> ''").distinct()
    n = -(-(rows.agg(F.sum(F.length("text"))).first()[0] or 0) // size)
    path = fresh_path(items.sparkSession, "items")
    blocks = rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(n, 1))).cast("int"))
    blocks.repartition("block").write.partitionBy("block").parquet(path)
    return path, n


def read_block(path: str, block: int) -> list[tuple[int, str]]:
    import pyarrow.parquet as pq
    from pyarrow import fs

    place, base = file_system(path)
    found = place.get_file_info(fs.FileSelector(f"{base}/block={block}", allow_not_found=True))
    rows = [r for f in found if f.path.endswith(".parquet") for r in pq.read_table(f.path, filesystem=place, partitioning=None).to_pylist()]
    return sorted({(r["item_id"], x) for r in rows if (x := normal(r["text"]))})


#: The automata of this worker, in the order of their making.
_BUILT: OrderedDict[tuple[str, int, float], Finder] = OrderedDict()


def finder(path: str, block: int, rate: float, kept: int) -> Finder:
    """A block's automaton, built or kept from before. Blocks come round in order, so of more than fit the first ones
    stay and the last place goes to each of the others in turn."""
    key = (path, block, rate)
    if key not in _BUILT:
        for other in [k for k in _BUILT if k[0] != path]:  # of another run
            del _BUILT[other]
        made = Finder(read_block(path, block), rate)
        while _BUILT and sum(f.size for f in _BUILT.values()) + made.size > kept:
            _BUILT.popitem()  # the one built last: those before it serve every round of blocks
        _BUILT[key] = made
    return _BUILT[key]


def mark(docs: DataFrame, items: DataFrame, rate: float = RATE, *, text: str = "text", item_text: str = "text", item_id: str = "item_id", block: int = BLOCK) -> DataFrame:
    """Adds ``leaks``: an array of (item_id, distance), by item, of the items that occur in the text."""
    path, n = staged_items(items, item_text, item_id, block)
    at = place_of(docs, text)
    keep = [i for i, c in enumerate(docs.columns) if c.lower() != "leaks"]
    schema = T.StructType([*[docs.schema.fields[i] for i in keep], T.StructField("leaks", LEAKS)])
    names, kind, kept = [f.name for f in schema.fields], pa_type(LEAKS), KEPT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def searched(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            texts = [normal(t) for batch in held for t in batch.column(at).to_pylist()]
            least: list[dict[int, int]] = [{} for _ in texts]
            for b in range(n):
                found = finder(path, b, rate, kept)
                for t, best in zip(texts, least, strict=True):
                    for item, distance in found.leaks(t) if t else ():
                        best[item] = min(distance, best.get(item, distance))
            leaks = iter(sorted(x.items()) for x in least)
            for batch in held:
                mine = [[{"item_id": i, "distance": d} for i, d in next(leaks)] for _ in range(batch.num_rows)]
                yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in keep], pa.array(mine, kind)], names)

        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if n < 2 or sum(x.nbytes for x in held) >= HELD:
                yield from searched(held)
                held = []
        if held:
            yield from searched(held)

    return map_arrow(docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]), run, schema)


def decontaminate(docs: DataFrame, items: DataFrame, rate: float = RATE, *, text: str = "text") -> DataFrame:
    """The documents in which no item occurs."""
    return mark(docs, items, rate, text=text).where(F.size("leaks") == 0).drop("leaks")


def leaks_digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The query's columns: a row for each document and item that occurs in it."""
    return mark(docs.select("doc_id", "text"), items).select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.item_id", "leak.distance")
