"""Hard-negative mining over an inverted multi-index.

For each anchor the best rows of its own label are its positives; for each positive, the best rows of other
labels whose score lies in a window below the positive's are its hard negatives. Scores are inner products
of vectors of whole numbers, so all comparisons are exact.

1. Two codebooks, one for each half of the components, are fitted by k-means on at most ``SAMPLE`` rows (those of
   the least hashed ids; a documented bound). Every row is indexed, whatever the sample holds.
2. Rows are dealt out by a hash of their id, so equal or similar vectors spread over all tasks, and pass in
   groups of about ``GROUP``. A group's rows lie in cells, one for each pair of codewords; each codeword knows the
   largest distance (radius) of the group's rows from it in its half.
3. For an anchor, a codeword's bound in its half is the anchor's product with it, plus the anchor's norm times
   the radius; no row of a cell scores above the sum of its two bounds. With both lists of bounds in falling
   order, a heap visits the cells in falling order of the sums (multi-sequence), some rows at a time.
4. The visit ends when every window is certified: the next bound lies under the window's lower end, or under its
   last row when it has all its rows. Cells that lie above all windows are passed over by their lower bounds.
   What an anchor has found bounds its visits to the next groups, too.

Anchors go to tasks in blocks of ``BLOCK``: a task holds a block and one group at a time, however many rows
there are. Each block of anchors meets all rows once for the positives and once for the windows, dealt over as
many tasks as the cluster has places for; a task sends on no more than what each anchor asks for.

Nulls: rows with a null label, a null vector, or a component that is null or not finite take no part; neither do
null ids. Of rows that share an id the one with the least label, then the least vector (of whole numbers), takes
part. Vectors of different lengths count as ended by zeros; an empty vector scores 0 with every other. Equal
scores go by the smaller id. A label that no other row has gives no positives, and an empty table an empty
result. Inner products beyond 2 ** 53, where doubles lose exactness, raise an error. Other columns aren't read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meadowlark.llm.common import col, map_arrow, ship, staged

#: Rows that the codebooks are fitted on, codewords a half, rounds of k-means.
SAMPLE, WORDS, ROUNDS = 16384, 16, 8
#: Rows of a group, anchors of a block, rows that are scored together.
GROUP, BLOCK, TOGETHER = 16384, 4096, 1024
SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 10, 30, 90
FOUND = "anchor_id long, want long, vec_id long, score long"
_LEAST = -(1 << 62)


def prepared(rows: DataFrame, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding", scale: int = SCALE, relabel=None) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part: whole numbers, one row an id. ``relabel`` maps the
    columns of label and id to another label."""
    x = F.transform(col(vector).cast("array<double>"), lambda v: v)
    sound = F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))
    there = rows.where(col(vec_id).isNotNull() & col(label).isNotNull() & col(vector).isNotNull() & sound)
    ident, name = col(vec_id).cast("long"), col(label).cast("long")
    whole = there.select(ident.alias("vec_id"), (relabel(name, ident) if relabel else name).cast("long").alias("label"), F.transform(x, lambda v: F.floor(v * scale)).alias("vector"))
    return whole.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("r")).select("vec_id", "r.label", "r.vector")


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of doubles, short vectors ended by zeros."""
    sizes = pa.compute.list_value_length(vectors).to_numpy()
    flat = pa.compute.list_flatten(vectors).to_numpy().astype(np.float64)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def codebook(x: np.ndarray, words: int, rounds: int = ROUNDS) -> np.ndarray:
    """k-means from evenly spaced rows on (in the order of the sample, which is a hash's)."""
    book = x[np.linspace(0, len(x) - 1, min(words, len(x))).astype(int)] if len(x) else np.zeros((1, x.shape[1]))
    for _ in range(rounds if len(x) else 0):
        own = nearest(x, book)
        count = np.bincount(own, minlength=len(book))
        sums = np.zeros_like(book)
        np.add.at(sums, own, x)
        book = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], book)
    return book


def nearest(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.argmin((book**2).sum(1) - 2 * (x @ book.T), axis=1)


def fit(rows: DataFrame, width: int, sample: int = SAMPLE, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The codebooks of the first and the second half of the components."""
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vector").toArrow()
    x = matrix(picked.column(0).combine_chunks(), width) if picked.num_rows else np.zeros((0, width))
    half = width // 2
    return codebook(x[:, :half], words), codebook(x[:, half:], words)


class Group:
    """Rows in cells of two codebooks, and the radii of their codewords."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, books: tuple[np.ndarray, np.ndarray]):
        self.books, self.half = books, books[0].shape[1]
        sides = x[:, : self.half], x[:, self.half :]
        own = [nearest(s, b) for s, b in zip(sides, books, strict=True)]
        self.radii = [np.zeros(len(b)) for b in books]
        for s, b, o, r in zip(sides, books, own, self.radii, strict=True):
            np.maximum.at(r, o, np.sqrt(((s - b[o]) ** 2).sum(1)))
        cell = own[0] * len(books[1]) + own[1]
        order = np.argsort(cell, kind="stable")
        self.ids, self.labels, self.x = ids[order], labels[order], x[order]
        self.ends = np.searchsorted(cell[order], np.arange(len(books[0]) * len(books[1]) + 1)).tolist()

    def visits(self, a: np.ndarray, norms: tuple[float, float]) -> Iterator[tuple[float, float, int, int]]:
        """Cells with rows in falling order of their upper bounds: upper and lower bound, first and last row."""
        mids = [b @ s for b, s in zip(self.books, (a[: self.half], a[self.half :]), strict=True)]
        reach = [n * r for n, r in zip(norms, self.radii, strict=True)]
        slack = 1e-6 * (1 + max(float(np.abs(m).max()) + float(r.max()) for m, r in zip(mids, reach, strict=True)))  # of rounding
        up, down = [m + r + slack for m, r in zip(mids, reach, strict=True)], [m - r - slack for m, r in zip(mids, reach, strict=True)]
        first, second = (np.argsort(-u, kind="stable").tolist() for u in up)
        (up1, up2), (down1, down2) = ([x.tolist() for x in side] for side in (up, down))
        wide, ends = len(second), self.ends
        heap = [(-(up1[first[0]] + up2[second[0]]), 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            p, q = first[i], second[j]
            if j + 1 < wide:  # a cell is pushed by its left neighbour; those of the first column by the one above
                heapq.heappush(heap, (-(up1[p] + up2[second[j + 1]]), i, j + 1))
            if j == 0 and i + 1 < len(first):
                heapq.heappush(heap, (-(up1[first[i + 1]] + up2[q]), i + 1, 0))
            cell = p * wide + q
            if ends[cell] < ends[cell + 1]:
                yield -bound, down1[p] + down2[q], ends[cell], ends[cell + 1]


class Search:
    """The best rows of one anchor so far: ``most`` for each window of scores (lower end, upper end)."""

    def __init__(self, ident: int, label: int, x: np.ndarray, half: int, windows: list[tuple[int, int]], most: int, same: bool):
        self.ident, self.label, self.x, self.same, self.windows, self.most = ident, label, x, same, windows, most
        self.norms = float(np.linalg.norm(x[:half])), float(np.linalg.norm(x[half:]))
        self.best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in windows]
        self.needs = [low for low, _ in windows]  # under it no row can enter a window any more

    def look(self, group: Group) -> None:
        highest = max((high for _, high in self.windows), default=_LEAST)
        spans: list[tuple[int, int]] = []
        held = 0
        for upper, lower, start, stop in group.visits(self.x, self.norms):
            if upper < min(self.needs, default=0) or not self.windows:
                break  # certified
            if lower > highest:
                continue
            spans.append((start, stop))
            held += stop - start
            if held >= TOGETHER:
                self.score(group, spans)
                spans, held = [], 0
        if spans:
            self.score(group, spans)

    def score(self, group: Group, spans: list[tuple[int, int]]) -> None:
        for at in range(0, len(spans)):
            if spans[at][1] - spans[at][0] > TOGETHER:  # a hot cell goes by itself, as a view
                self.enter(group, slice(*spans[at]))
        rest = [np.arange(a, b) for a, b in spans if b - a <= TOGETHER]
        if rest:
            self.enter(group, np.concatenate(rest))

    def enter(self, group: Group, rows) -> None:
        score = (group.x[rows] @ self.x).astype(np.int64)
        labels, ids = group.labels[rows], group.ids[rows]
        fit = (labels == self.label) & (ids != self.ident) if self.same else labels != self.label
        for w, (low, high) in enumerate(self.windows):
            here = np.flatnonzero(fit & (score >= max(low, self.needs[w])) & (score <= high))
            if not len(here):
                continue
            s, i = np.concatenate([self.best[w][0], score[here]]), np.concatenate([self.best[w][1], ids[here]])
            if len(s) > 4 * self.most:  # all above the last place, and all at it, for the ids decide
                keep = s >= np.partition(s, len(s) - self.most)[len(s) - self.most]
                s, i = s[keep], i[keep]
            order = np.lexsort((i, -s))[: self.most]
            self.best[w] = s[order], i[order]
            if len(order) == self.most:
                self.needs[w] = max(low, int(s[order[-1]]))


def search(rows: DataFrame, anchors: DataFrame, books: tuple[np.ndarray, np.ndarray], width: int, n_rows: int, n_anchors: int, most: int, windows=None, group: int = GROUP, block: int = BLOCK) -> DataFrame:
    """For each anchor (vec_id, label, vector, ``wants``) and each of its ``wants``, the best rows of other labels
    with ``windows(want)`` (lower, upper) around their score; without ``windows``, the best of its own label.
    Columns: anchor_id, want (null without windows), vec_id, score."""
    spark = rows.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(books)
    blocks = max(1, -(-n_anchors // block))
    groups = max(1, -(-n_rows // group))
    lanes = max(1, min(-(-n_rows // 1024), -(-2 * spark.sparkContext.defaultParallelism // blocks)))
    each = -(-max(groups, lanes) // lanes)  # groups of a lane
    hashed = lambda c, seed, n: F.pmod(F.xxhash64(c, F.lit(seed)), F.lit(n)).cast("int")

    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = anchors.select(hashed("vec_id", 1, blocks).alias("block"), numbers(lanes).alias("lane"), F.lit(-1).alias("grp"), "vec_id", "label", "vector", "wants")
    given = rows.select(numbers(blocks).alias("block"), hashed("vec_id", 2, lanes).alias("lane"), hashed("vec_id", 3, each).alias("grp"), "vec_id", "label", "vector", F.lit(None).cast("array<bigint>").alias("wants"))
    both = asked.unionByName(given).withColumn("task", F.col("block") * lanes + F.col("lane"))
    dealt = both.repartitionById(blocks * lanes, "task").sortWithinPartitions("task", "grp").drop("block", "lane")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        half = books[0].shape[1]
        searches: list[Search] = []
        held: list[pa.RecordBatch] = []
        key: tuple[int, int] | None = None

        def closed() -> None:
            """The rows of a key are all there: anchors begin searches, a group is looked through."""
            if not held:
                return
            part = pa.Table.from_batches(held).combine_chunks()
            ids, labels = part.column("vec_id").to_numpy(), part.column("label").to_numpy()
            x = matrix(part.column("vector").combine_chunks(), width)
            if key[1] < 0:
                for i, wants in enumerate(part.column("wants").to_pylist()):
                    ends = [windows(w) for w in wants] if windows else [(_LEAST, 1 << 62)]
                    searches.append(Search(int(ids[i]), int(labels[i]), x[i], half, ends, most, not windows))
                    searches[-1].wants = wants if windows else [None]
            elif searches:
                one = Group(ids, labels, x, books)
                for s in searches:
                    s.look(one)

        def told() -> pa.RecordBatch:
            out = [(s.ident, want, i, v) for s in searches for want, (scores, idents) in zip(s.wants, s.best, strict=True) for v, i in zip(scores.tolist(), idents.tolist(), strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [[]] * 4)], ["anchor_id", "want", "vec_id", "score"])

        for batch in batches:
            while batch.num_rows:
                task, grp = batch.column("task").to_numpy(), batch.column("grp").to_numpy()
                now = (int(task[0]), int(grp[0]))
                if key is not None and now != key:
                    closed()
                    held = []
                    if now[0] != key[0]:
                        yield told()
                        searches = []
                key = now
                change = np.flatnonzero((task != task[0]) | (grp != grp[0]))
                upto = int(change[0]) if len(change) else batch.num_rows
                held.append(batch.slice(0, upto))
                batch = batch.slice(upto)
        closed()
        yield told()

    found = map_arrow(dealt.select("task", "grp", "vec_id", "label", "vector", "wants"), run, FOUND)
    best = F.row_number().over(Window.partitionBy("anchor_id", "want").orderBy(F.desc("score"), F.asc("vec_id")))
    return found.withColumn("rank", best).where(F.col("rank") <= most)


def window_of(score: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """The whole scores between ``low`` and ``high`` percent of a positive's: for a negative one there are none."""
    return -(-low * score // 100), high * score // 100


def mine(rows: DataFrame, anchor: Column, *, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, sample: int = SAMPLE, words: int = WORDS, group: int = GROUP, block: int = BLOCK) -> DataFrame:
    """From ``prepared`` rows: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    ``anchor`` says of ``vec_id`` which rows are anchors."""
    rows = staged(rows, "vectors")
    size = F.coalesce(F.max(F.size("vector")), F.lit(0))
    largest = F.coalesce(F.max(F.aggregate("vector", F.lit(0.0), lambda s, v: s + v.cast("double") * v)), F.lit(0.0))
    told = rows.agg(F.count("*").alias("n"), F.count_if(anchor).alias("a"), size.alias("width"), largest.alias("square")).first()
    if told["square"] >= 2**53:
        raise ValueError("inner products beyond 2 ** 53 aren't exact: scale the vectors down")
    width = max(2, int(told["width"]))
    sizes = dict(width=width, n_rows=told["n"], n_anchors=told["a"], group=group, block=block)
    books = fit(rows, width, sample, words)
    anchors = rows.where(anchor)

    first = staged(search(rows, anchors.withColumn("wants", F.lit(None).cast("array<bigint>")), books, most=positives, **sizes).select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    wants = first.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.sort_array(F.collect_set("positive_score")).alias("wants"))  # at most ``positives``
    ends = lambda score: window_of(score, low, high)
    second = search(rows, anchors.join(wants, "vec_id"), books, most=negatives, windows=ends, **sizes)
    hits = second.select(F.col("anchor_id"), F.col("want").alias("positive_score"), F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return first.join(hits, ["anchor_id", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def negatives_digest(embeddings: DataFrame) -> DataFrame:
    """The query's rows: ids divisible by 7 get the next of ten labels, ids divisible by 100 are anchors."""
    rows = prepared(embeddings, relabel=lambda label, ident: F.when(ident % 7 == 0, (label + 1) % 10).otherwise(label))
    return mine(rows, F.col("vec_id") % 100 == 0)


ORACLE = f"""
WITH v AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS x
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES})
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE label <> own AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= {NEGATIVES}
"""
