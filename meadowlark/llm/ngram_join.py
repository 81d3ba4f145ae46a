"""N-gram Jaccard join with Bayesian candidate pruning.

Texts are sets of five-word shingles (a text of fewer words: one shingle of them all); two texts are
linked if the sets' Jaccard similarity is 0.8 or more.

1. One scan gives each document a digest of its words and 125 MinHash values. Equal texts are one node
   from here on, known by the digest, so a group of exact copies costs one row.
2. Bands of five values propose candidates: texts that share a bucket. A bucket of more than ``TILE``
   members or ``WORDS`` shingles is cut into blocks, and each pair of blocks is a tile of its own, so that
   no task holds a whole bucket and no pair is ever a row.
3. In a tile a pair that shares an earlier band (by a 64-bit hash) is left to that one. The MinHash values
   of the others are compared 20 at a time; a pair is dropped when the posterior probability that its similarity reaches the
   threshold falls below ``TOLERANCE``. Of the tile stay the texts that have a pair left.
4. Their texts are fetched, once a node, and go to their tiles; there the pairs are found once more and
   their shingle sets are compared exactly. A tile reports, for each text, its number of links and the
   least node it is connected with; pairs stay within the task.
5. Those stars are merged to connected classes by rounds of minimum labels in the shared folder.

Nulls and empty texts: without words a text links to nothing and is its own class. A null id is no
id: its row is compared like others, and its class is the smallest id there, null if there is none. Rows
that share an id but not the text are texts of their own; rows that share both are copies. An empty table
gives an empty one. Only the id and the text are read, so other columns can have any name. Texts are hashed
whole, a very long one in pieces; a tile holds the words of ``WORDS`` shingles a block on average, or one text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meadowlark.llm.common import col, gram_hashes, group_starts, map_arrow, mix, slices, sorted_runs, staged, word_hashes

N, THRESHOLD = 5, Fraction(4, 5)
ROWS, BANDS = 5, 25
VALUES = ROWS * BANDS
STEP, TOLERANCE = 20, 1e-5
TILE, WORDS = 1024, 2_000_000
_RNG = np.random.default_rng(7)
_A = _RNG.integers(0, 2**63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 2**63, VALUES, dtype=np.uint64)
KEY = ["key", "low", "high"]
TILES = "key long, low int, high int, block int, band int, node binary"
TILE_COLUMNS = [*KEY, "block", "band", "node"]


def shingles(words: np.ndarray, ends: np.ndarray, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of texts given by word hashes and offsets, and each text's offset among them."""
    sizes = np.diff(ends)
    counts = np.where(sizes >= n, sizes - n + 1, np.minimum(sizes, 1))
    starts = np.concatenate([[0], np.cumsum(counts)])
    whole = gram_hashes(words, n)
    at = np.repeat(ends[:-1] - starts[:-1], counts) + np.arange(starts[-1])
    out = whole[np.minimum(at, max(len(whole) - 1, 0))] if len(whole) else np.zeros(len(at), np.uint64)
    for i in np.flatnonzero((sizes > 0) & (sizes < n)):
        out[starts[i]] = mix(gram_hashes(words[ends[i] : ends[i + 1]], int(sizes[i])) + np.uint64(sizes[i]))[0]
    return out, starts


def minhashes(grams: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """125 MinHash values of each text that has shingles (32 bits each)."""
    some = starts[:-1][np.diff(starts) > 0]
    out = np.empty((len(some), VALUES), np.uint32)
    for i in range(VALUES if len(some) else 0):
        h = grams ^ _B[i]
        h *= _A[i]
        h >>= np.uint64(32)
        out[:, i] = np.minimum.reduceat(h, some)
    return out


def signatures(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, text_hash, digest of the words, number of shingles, MinHash values) of all rows; the digest
    and the values are null without words. ``text_hash`` is ``xxhash64`` of the text as it stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 256 << 10):
                texts = part.column(2).to_pylist()
                grams, starts = shingles(*word_hashes(texts))
                values = iter(minhashes(grams, starts))
                digests: list[bytes | None] = [None] * len(texts)
                signs: list[bytes | None] = [None] * len(texts)
                for i in np.flatnonzero(np.diff(starts)):
                    digests[i] = hashlib.md5(" ".join(texts[i].split()).encode("utf-8", "surrogatepass")).digest()
                    signs[i] = next(values).tobytes()
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(digests, pa.binary()), pa.array(np.diff(starts), pa.int64()), pa.array(signs, pa.binary())], ["doc_id", "text_hash", "digest", "size", "sign"])

    return map_arrow(with_hash(docs, text, doc_id), run, "doc_id long, text_hash long, digest binary, size long, sign binary")


def with_hash(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    return docs.select(col(doc_id).cast("long").alias("doc_id"), F.xxhash64(col(text)).alias("text_hash"), col(text).alias("text"))


@cache
def needed(n: int) -> int:
    """The least number of equal values among n for which a pair may still reach the threshold: with
    an even prior the posterior probability of that is P(Binomial(n + 1, threshold) <= equal)."""
    t, total = float(THRESHOLD), 0.0
    for m in range(n + 1):
        total += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        if total >= TOLERANCE:
            return m
    return n


def band_codes(signs: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each band's values, a row a text."""
    values = signs.reshape(-1, BANDS, ROWS).astype(np.uint64)
    out = np.zeros(values.shape[:2], np.uint64)
    for i in range(ROWS):
        out = mix(out ^ values[:, :, i])
    return out


def likely(others: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that survive pruning. ``others`` are the MinHash values without those of the band that
    proposed the pairs: these are equal by selection."""
    equal = np.zeros(len(left), np.int32)
    for at in range(0, others.shape[1], STEP):
        part = others[:, at : at + STEP]
        equal += (part[left] == part[right]).sum(1, dtype=np.int32)
        keep = equal >= needed(at + part.shape[1])
        left, right, equal = left[keep], right[keep], equal[keep]
        if not len(left):
            break
    return left, right


def pairs_of(block: np.ndarray, low: int, high: int, earlier: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of a tile that have no code of ``earlier`` bands in common, some ten thousand at a time.
    Bands are compared a row against a block, so that near copies, which share most bands, cost little."""
    right = np.arange(len(block)) if low == high else np.flatnonzero(block == high)
    left = right if low == high else np.flatnonzero(block == low)
    codes = np.ascontiguousarray(earlier[right].T)
    step = max(1, (1 << 14) // max(len(right), 1))
    for at in range(0, len(left), step):
        some = left[at : at + step]
        fresh = some[:, None] < right if low == high else np.ones((len(some), len(right)), bool)
        for own, code in zip(earlier[some].T, codes, strict=True):
            fresh &= own[:, None] != code
            if not fresh.any():
                break
        i, j = np.nonzero(fresh)
        if len(i):
            yield some[i], right[j]


def tiles_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray, Iterator[tuple[np.ndarray, np.ndarray]]]]:
    """Each tile's rows, one a node, their MinHash values, and the pairs that survive pruning, some at a time."""
    for part in sorted_runs(batches, KEY):
        ends = group_starts(part, KEY)
        for s, e in zip(ends[:-1], ends[1:], strict=True):
            if e - s < 2:
                continue
            nodes = part.column("node").slice(s, e - s).to_pylist()
            once = [i for i, x in enumerate(nodes) if not i or x != nodes[i - 1]]  # a lost task's rows can come twice
            tile = part.slice(s, e - s).take(once)
            signs = np.frombuffer(b"".join(tile.column("sign").to_pylist()), np.uint32).reshape(-1, VALUES)
            low, high, block = (tile.column(c).to_numpy() for c in ("low", "high", "block"))
            band = tile.column("band")[0].as_py()
            others = np.delete(signs, slice(band * ROWS, (band + 1) * ROWS), axis=1)
            yield tile, signs, (likely(others, *some) for some in pairs_of(block, low[0], high[0], band_codes(signs)[:, :band]))


def surviving(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each tile that have pairs left, without their MinHash values."""
    for tile, signs, pairs in tiles_of(batches):
        paired = np.zeros(len(signs), bool)
        for left, right in pairs:
            paired[left] = paired[right] = True
        if paired.any():
            yield from tile.select(TILE_COLUMNS).filter(pa.array(paired)).combine_chunks().to_batches()


def overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of sorted sets."""
    if len(left) < 4 * len(sets):
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(left, right, strict=True)], np.int64)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    row, values = row[order], values[order]
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    counts = np.diff(np.append(starts, len(values)))
    row, counts = row[np.repeat(counts > 1, counts)], counts[counts > 1]  # a shingle of one text is in no intersection
    at = np.repeat(np.arange(len(counts)), counts)
    both = np.zeros((len(sets), len(sets)), np.int32)
    for low in range(0, len(counts), 4096):  # of all shingles, so many at a time
        a, b = np.searchsorted(at, (low, low + 4096))
        some = np.zeros((len(sets), 4096), np.float32)
        some[row[a:b], at[a:b] - low] = 1
        both += (some @ some.T).astype(np.int32)
    return both[left, right].astype(np.int64)


def roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest index each of n nodes is connected with."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, root, links) of each tile's texts that have exact links there."""
    for tile, signs, pairs in tiles_of(batches):
        found = [x for x in pairs if len(x[0])]
        if not found:
            continue
        left, right = (np.concatenate(x) for x in zip(*found, strict=True))
        sets = [np.unique(shingles(*word_hashes([t]))[0]) for t in tile.column("text").to_pylist()]
        size = np.array([len(x) for x in sets])
        both = overlaps(sets, left, right)
        good = (both > 0) & (both * THRESHOLD.denominator >= (size[left] + size[right] - both) * THRESHOLD.numerator)
        left, right = left[good], right[good]
        links = np.bincount(left, minlength=len(sets)) + np.bincount(right, minlength=len(sets))
        some = np.flatnonzero(links)
        if len(some):
            nodes = tile.column("node").combine_chunks()
            yield pa.RecordBatch.from_arrays([nodes.take(pa.array(some)), nodes.take(pa.array(roots(len(sets), left, right)[some])), pa.array(links[some])], ["node", "root", "links"])


def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of neighbours with the same node the first."""
    before = None
    for batch in batches:
        if batch.num_rows:
            nodes = batch.column("node").to_pylist()
            keep = [x != (nodes[i - 1] if i else before) for i, x in enumerate(nodes)]
            before = nodes[-1]
            yield batch.filter(pa.array(keep))


def connected(stars: DataFrame) -> DataFrame:
    """(node, label): the least node of each node's class, from rows (node, root) that tie nodes to
    hubs. Each round takes the least label to the hubs and back, then follows labels one step, so that
    the rounds grow with the logarithm of a class's width. Rounds end when no label changes."""
    edges = staged(stars.select("node", "root").union(stars.select("root", "root")).distinct(), "edges")
    labels = staged(edges.groupBy("node").agg(F.min("root").alias("label")), "labels")
    total = lambda df: df.agg(F.sum(F.xxhash64("node", "label").cast("decimal(38,0)"))).first()[0]
    before = total(labels)
    while before is not None:
        hubs = edges.join(labels, "node").groupBy("root").agg(F.min("label").alias("label"))
        near = edges.join(hubs, "root").groupBy("node").agg(F.min("label").alias("label"))
        ahead = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels = staged(near.join(ahead, "label", "left").select("node", F.least("label", F.coalesce("next", "label")).alias("label")), "labels")
        now = total(labels)
        if now == before:
            break
        before = now
    return labels


def first_row() -> Column:
    """Of rows (doc_id, text_hash) the first; those without an id come last."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash"))


def classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, ``first`` (the row that stands for its class: nameless,
    doc_id, text_hash; null if it has no words), ``copy`` (the same of its text) and n_links."""
    signed = staged(signatures(docs, text, doc_id), "signatures")
    nodes = staged(signed.where("digest is not null").groupBy(F.col("digest").alias("node")).agg(first_row().alias("copy"), F.first("size").alias("size"), F.first("sign").alias("sign")), "nodes")

    width = ROWS * 4
    keys = F.array(*[F.xxhash64(F.lit(b), F.substring("sign", b * width + 1, width)) for b in range(BANDS)])
    buckets = nodes.select("node", "size", F.posexplode(keys).alias("band", "key"))
    shared = buckets.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("size")).where("n > 1")
    blocks = F.greatest(F.ceil(F.col("n") / TILE), F.ceil(F.col("size") / WORDS)).cast("int")
    found = buckets.drop("size").join(shared.select("key", F.least(blocks, F.col("n")).cast("int").alias("blocks")), "key")
    placed = found.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    tiles = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = tiles.select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "band", "node")
    tiles = tiles.join(nodes.select("node", "sign"), "node").select(*TILE_COLUMNS, "sign")
    left = staged(map_arrow(tiles.repartition(*KEY).sortWithinPartitions(*KEY, "node"), surviving, TILES), "tiles")

    # the texts to compare grow with the documents: at every size merges of two shuffled sides
    wanted = left.select("node").distinct().join(nodes, "node").select("node", "sign", F.col("copy.doc_id").alias("doc_id"), F.col("copy.text_hash").alias("text_hash"))
    whole = with_hash(docs, text, doc_id).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.text_hash") == F.col("w.text_hash"))
    texts = map_arrow(wanted.alias("w").hint("merge").join(whole, same).select("w.node", "w.sign", "d.text"), once, "node binary, sign binary, text string")
    fetched = left.hint("merge").join(texts, "node").select(*TILE_COLUMNS, "sign", "text")
    stars = staged(map_arrow(fetched.repartition(*KEY).sortWithinPartitions(*KEY, "node"), verified, "node binary, root binary, links long"), "stars")

    labels = connected(stars).join(nodes.select("node", "copy"), "node")
    heads = labels.groupBy("label").agg(F.min("copy").alias("first"))
    linked = labels.join(heads, "label").join(stars.groupBy("node").agg(F.sum("links").alias("links")), "node").select("node", "first", "links")
    # staged, so that a text with a third of the rows makes a join of two plain shuffles, which Spark can split
    by_text = staged(nodes.select("node", "copy").join(linked, "node", "left").withColumnRenamed("node", "digest"), "by-text")
    members = signed.select("doc_id", "text_hash", "digest").join(by_text, "digest", "left")
    return members.select("doc_id", "text_hash", F.coalesce("first", "copy").alias("first"), "copy", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"))


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``copy_of`` (the smallest id with the same words),
    ``class_id`` (the smallest id of its class of linked texts) and ``n_links`` (other texts it is
    linked with; copies of one text count as one)."""
    own = lambda c: F.when(F.col("copy").isNull(), F.col("doc_id")).otherwise(F.col(c)["doc_id"])
    return classes(docs, text, doc_id).select("doc_id", own("copy").alias("copy_of"), own("first").alias("class_id"), "n_links")


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each class: the one with the smallest id (ids before nulls), of texts that
    share that id the one with the smallest ``xxhash64``, of rows that share both the one whose other columns
    sort first. Rows without words all stay."""
    found = staged(classes(docs, text, doc_id), "classes").where("copy is not null")
    stays = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash").eqNullSafe(F.col("first"))
    marked = found.withColumn("stays", stays).groupBy(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash"), "stays").agg(F.count("*").alias("n"))
    here = col(doc_id).cast("long").eqNullSafe(F.col("of_id")) & (F.xxhash64(col(text)) == F.col("of_hash"))
    single = docs.join(marked.where("not stays or n > 1"), here, "left_anti")
    repeated = docs.join(marked.where("stays and n > 1"), here)
    least = repeated.groupBy("of_id", "of_hash").agg(F.min(F.struct(*map(col, docs.columns))).alias("row"))
    return single.unionByName(least.select(*[F.col("row").getField(c).alias(c) for c in docs.columns]))
