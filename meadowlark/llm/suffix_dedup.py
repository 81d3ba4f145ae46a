"""Suffix-array dedup with sparse suffix arrays.

Finds the passages of at least 50 words that occur in two or more different documents.

1. Of every 50-word window the anchor is the place, among its first 30, whose eight-word gram has the
   least hash. Equal windows have equal anchors, so only suffixes at anchors are retained, about one
   in 15. An anchor answers for the windows that picked it, a run of offsets.
2. A window reaches at least 21 words right of its anchor. Suffixes whose first 21 words occur in no
   other text can't matter; the rest get their context (50 words right, 29 left, as 32-bit hashes).
3. Suffixes are sorted by content. Neighbours are compared: the common words to the right and to the
   left give the windows they share.
4. In runs of three or more, a window may equal one further off, which sorting by the right side alone
   doesn't bring near. For runs with windows left open, the windows' hashes are matched within the
   run; runs of more than ``RUN`` suffixes are dealt out in parts, and windows still open after that
   are matched between the parts by a grouped minimum and maximum of the ids.

Texts are told apart by digest, whatever their ids: equal ones are one text throughout. A text that two ids have
is repeated as a whole. A text that one id has belongs to that document (its *owner*, as a 64-bit hash, is what
is compared), and what it shares with other texts of the same owner isn't repeated.

Nulls and short texts: a null text or one of fewer than 50 words has no passages; a row with a null id
has none. Rows are a document's by id: a row that is repeated counts once, and a document may have several
texts, each with places of its own; equal stretches of two texts of one id are one row of the result. Repeats
within one document don't count. An empty table gives an empty one. Only the id and the text are read. A very long
text is hashed in pieces; its word hashes and anchors are held at once (some 40 bytes a word).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meadowlark.llm.common import col, gram_hashes, group_starts, map_arrow, mix, slices, sorted_runs, staged, word_hashes

LEAST, GRAM, REACH = 50, 8, 30
SURE = LEAST - REACH + 1
RUN = 256
#: Bits of a place when grams are ranked; those of equal rank go by place. A text has fewer words than that.
PLACE = np.uint64(32)
KEY = ["key", "part"]
FOUND = "no long, owner long, start int, stop int, window long, matched boolean"


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of x[i:i + width] for each i (the last ones are of what there is)."""
    out, have = x, 1
    while have < width:
        by = min(have, width - have)
        out = np.concatenate([np.minimum(out[:-by], out[by:]), out[len(out) - by :]]) if len(out) > by else out
        have += by
    return out


def anchors(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For texts given by word hashes and offsets: text, place, and first and last start of the windows
    that each anchor answers for (places in ``words``)."""
    sizes = np.diff(ends)
    windows = np.maximum(sizes - LEAST + 1, 0)
    text = np.repeat(np.arange(len(sizes)), windows)
    if not len(text):
        return (np.zeros(0, np.int64),) * 4
    first = np.concatenate([[0], np.cumsum(windows)])
    start = np.repeat(ends[:-1] - first[:-1], windows) + np.arange(len(text))
    grams = gram_hashes(words, GRAM)
    ranked = grams >> PLACE << PLACE | np.arange(len(grams), dtype=np.uint64)
    place = (sliding_min(ranked, REACH)[start] & ((np.uint64(1) << PLACE) - np.uint64(1))).astype(np.int64)
    new = np.concatenate([[True], (place[1:] != place[:-1]) | (text[1:] != text[:-1])])
    at = np.flatnonzero(new)
    last = np.concatenate([at[1:], [len(text)]]) - 1
    return text[at], place[at], start[at], start[last]


def digest_of(text: str) -> bytes:
    return hashlib.md5(" ".join(text.split()).encode("utf-8", "surrogatepass")).digest()


def scanned(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, n_words, keys): keys are the hashes of the 21 words at each anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 256 << 10):
                texts = part.column(1).to_pylist()
                words, ends = word_hashes(texts)
                text, place, _, _ = anchors(words, ends)
                keys = gram_hashes(words, SURE)[place].view(np.int64) if len(place) else np.zeros(0, np.int64)
                cut = np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32)
                digests = [digest_of(t) if t else None for t in texts]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(digests, pa.binary()), pa.array(np.diff(ends), pa.int64()), pa.ListArray.from_arrays(pa.array(cut), pa.array(keys))], ["doc_id", "digest", "n_words", "keys"])

    return map_arrow(docs, run, "doc_id long, digest binary, n_words long, keys array<long>")


def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (no, owner, digest, text, kept): the suffixes whose key is kept, with their context. Texts that the id
    brought along, but that have another digest, are passed over."""
    for batch in batches:
        for part in slices(batch, 128 << 10):
            right_one = [t is not None and digest_of(t) == d for t, d in zip(part.column(3).to_pylist(), part.column(2).to_pylist(), strict=True)]
            part = part.filter(pa.array(right_one))
            nos, owners, kept = part.column(0).to_numpy(), part.column(1).to_numpy(), part.column(4).to_pylist()
            words, ends = word_hashes(part.column(3).to_pylist())
            text, place, low, high = anchors(words, ends)
            if not len(text):
                continue
            keys = gram_hashes(words, SURE)[place].view(np.int64)
            sizes = [dict(zip((x["key"] for x in k), (x["size"] for x in k), strict=True)) for k in kept]
            size = np.array([sizes[t].get(k, 0) for t, k in zip(text.tolist(), keys.tolist(), strict=True)], np.int64)
            here = size > 0
            if not here.any():
                continue
            text, place, low, high, keys, size = (x[here] for x in (text, place, low, high, keys, size))
            short = (words >> np.uint64(32)).astype(np.uint32)
            right, left = place[:, None] + np.arange(LEAST), place[:, None] - 1 - np.arange(REACH - 1)
            rights = np.where(right < ends[text + 1][:, None], short[np.minimum(right, len(short) - 1)], 0).astype(">u4")
            lefts = np.where(left >= ends[text][:, None], short[np.maximum(left, 0)], 0).astype(">u4")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys),
                    pa.array(size),
                    pa.array(nos[text]),
                    pa.array(owners[text]),
                    pa.array((place - ends[text]).astype(np.int32)),
                    pa.array((place - high).astype(np.int32)),
                    pa.array((place - low).astype(np.int32)),
                    pa.array([x.tobytes() for x in rights], pa.binary()),
                    pa.array([x.tobytes() for x in lefts], pa.binary()),
                ],
                ["key", "size", "no", "owner", "place", "near", "far", "right", "left"],
            )


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading equal words of each pair of rows."""
    differ = a != b
    return np.where(differ.any(1), differ.argmax(1), a.shape[1])


def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Covered stretches of words (text, owner, start, stop), and the windows that parts of large runs have to
    compare with each other (those, window, whether matched already)."""
    for part in sorted_runs(batches, KEY):
        no, owner, place, near, far, parts = (part.column(c).to_numpy() for c in ("no", "owner", "place", "near", "far", "parts"))
        right = np.frombuffer(b"".join(part.column("right").to_pylist()), ">u4").reshape(-1, LEAST)
        left = np.frombuffer(b"".join(part.column("left").to_pylist()), ">u4").reshape(-1, REACH - 1)
        ends = group_starts(part, KEY)
        n = part.num_rows
        group = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
        # sorted neighbours of different documents: common words to the right and to the left
        i = np.flatnonzero((group[1:] == group[:-1]) & (owner[1:] != owner[:-1]))
        r, s = common(right[i], right[i + 1]), common(left[i], left[i + 1])
        out: list[tuple[np.ndarray, ...]] = []
        open_ = np.ones((n, REACH), bool) & (np.arange(REACH) >= near[:, None]) & (np.arange(REACH) <= far[:, None])
        for row in (i, i + 1):
            # windows at offsets a..b before the anchor are equal
            a, b = np.maximum(LEAST - r, near[row]), np.minimum(s, far[row])
            good = a <= b
            some, a, b = row[good], a[good], b[good]
            out.append((no[some], owner[some], place[some] - b, place[some] - a + LEAST))
            open_[some] &= ~((np.arange(REACH) >= a[:, None]) & (np.arange(REACH) <= b[:, None]))
        rest: list[tuple] = []
        unsettled = np.unique(group[open_.any(1)])
        for g in unsettled[(np.diff(ends)[unsettled] > 2) | (parts[ends[unsettled]] > 1)]:
            rows = slice(ends[g], ends[g + 1])
            covered, more = run_windows(no[rows], owner[rows], place[rows], near[rows], far[rows], right[rows], left[rows], open_[rows], int(parts[ends[g]]))
            out.append(covered)
            rest += more
        for g in np.unique(group[(parts > 1) & ~np.isin(group, unsettled)]):
            rows = slice(ends[g], ends[g + 1])
            rest += run_windows(no[rows], owner[rows], place[rows], near[rows], far[rows], right[rows], left[rows], open_[rows], 2)[1]
        nos, owners, starts, stops = (np.concatenate(x) for x in zip(*out, strict=True))
        if len(nos):
            yield found(nos, owners, starts, stops, [None] * len(nos), [True] * len(nos))
        if rest:
            yield found(*zip(*rest, strict=True))


def found(*columns) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["no", "owner", "start", "stop", "window", "matched"])


_WEIGHT = np.random.default_rng(11).integers(1, 2**63, (2, LEAST), dtype=np.uint64) | np.uint64(1)


def run_windows(no, owner, place, near, far, right, left, open_, parts):
    """All windows of one run, matched by hash: the open ones that another document shares, as covered
    stretches; and, if the run has other parts, a row for each open window and two for each matched kind."""
    zero = np.zeros((len(no), 1), np.uint64)
    to_right = np.concatenate([zero, np.cumsum(right.astype(np.uint64) * _WEIGHT[0], axis=1, dtype=np.uint64)], axis=1)
    to_left = np.concatenate([zero, np.cumsum(left.astype(np.uint64) * _WEIGHT[1][: REACH - 1], axis=1, dtype=np.uint64)], axis=1)
    row, offset = np.nonzero((np.arange(REACH) >= near[:, None]) & (np.arange(REACH) <= far[:, None]))
    window = mix(to_right[row, LEAST - offset] * np.uint64(3) + mix(to_left[row, offset] + offset.astype(np.uint64)))
    kinds, at = np.unique(window, return_inverse=True)
    low, high = np.full(len(kinds), np.iinfo(np.int64).max), np.full(len(kinds), np.iinfo(np.int64).min)
    np.minimum.at(low, at, owner[row])
    np.maximum.at(high, at, owner[row])
    shared = (low < high)[at]
    was_open = open_[row, offset]
    new = shared & was_open
    start = place[row] - offset
    covered = no[row[new]], owner[row[new]], start[new], start[new] + LEAST
    rest: list[tuple] = []
    if parts > 1:
        hashed, first = window.view(np.int64), start.astype(int)
        rest = [(int(no[row[t]]), int(owner[row[t]]), int(first[t]), int(first[t]) + LEAST, int(hashed[t]), False) for t in np.flatnonzero(~shared)]
        for k in np.flatnonzero(low < high):  # matched here: its two outer owners stand for it
            rest += [(-1, int(x), 0, 0, int(kinds[k].view(np.int64)), True) for x in (low[k], high[k])]
    return covered, rest


def repeated_passages(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row for each maximal stretch of repeated passages: ``doc_id``, ``start`` and ``stop`` (words,
    exclusive) and ``n_words``."""
    rows = docs.select(col(doc_id).cast("long").alias("doc_id"), col(text).alias("text"))
    seen = staged(scanned(rows).where("doc_id is not null and n_words >= 50"), "scanned")
    texts = seen.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"), F.first("n_words").alias("n_words"), F.first("keys").alias("keys"))
    single = F.col("first_id") == F.col("last_id")
    owner = F.when(single, F.xxhash64("first_id", F.lit(0))).otherwise(F.xxhash64("digest", F.lit(1)))
    texts = staged(texts.select(F.monotonically_increasing_id().alias("no"), "first_id", owner.alias("owner"), single.alias("single"), "digest", "keys"), "texts")

    # a run's size is its suffixes, several of one text too; it matters if it has two owners
    suffix = texts.select("owner", F.explode("keys").alias("key"))
    shared = suffix.groupBy("key").agg(F.count("*").alias("size"), F.min("owner").alias("low"), F.max("owner").alias("high")).where("low < high").select("key", "size")
    keys = texts.select("no", F.explode(F.array_distinct("keys")).alias("key"))
    kept = keys.join(shared, "key").groupBy("no").agg(F.collect_list(F.struct("key", "size")).alias("kept"))
    wanted = kept.join(texts.select("no", "first_id", "owner", "digest"), "no").withColumnRenamed("first_id", "doc_id")
    # an id may bring several rows: of those that are the same one counts, and contexts() keeps the text of the digest
    fetched = wanted.join(rows, "doc_id").groupBy("doc_id", "no", F.md5("text").alias("raw")).agg(*[F.first(c).alias(c) for c in ("owner", "digest", "text", "kept")])
    suffixes = map_arrow(fetched.select("no", "owner", "digest", "text", "kept"), contexts, "key long, size long, no long, owner long, place int, near int, far int, right binary, left binary")
    parts = F.ceil(F.col("size") / RUN).cast("int")
    dealt = suffixes.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("no", "place"), F.col("parts")).cast("int")).drop("size")
    ordered = dealt.repartition(*KEY).sortWithinPartitions(*KEY, "right", "owner")
    told = staged(map_arrow(ordered, compared, FOUND), "stretches")

    open_ = told.where("window is not null")
    across = open_.groupBy("window").agg(F.min("owner").alias("low"), F.max("owner").alias("high")).where("low < high").select("window")
    late = open_.where("not matched").join(across, "window", "left_semi")
    stretches = told.where("window is null").select("no", "start", "stop").unionByName(late.select("no", "start", "stop")).distinct()
    order = Window.partitionBy("no").orderBy("start", "stop")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = stretches.withColumn("new", F.when(reach >= F.col("start"), 0).otherwise(1)).withColumn("island", F.sum("new").over(order))
    merged = islands.groupBy("no", "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("island")

    own = texts.where("single").select("no", F.col("first_id").alias("doc_id")).join(merged, "no").select("doc_id", F.col("start").cast("long"), F.col("stop").cast("long"))
    copies = seen.join(texts.where("not single").select("digest"), "digest", "left_semi").select("doc_id", F.lit(0).cast("long").alias("start"), F.col("n_words").alias("stop"))
    return own.unionByName(copies).distinct().withColumn("n_words", F.col("stop") - F.col("start"))


def cut_passages(docs: DataFrame, passages: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents without the words of their repeated passages; runs of white space become one space
    in the texts that change."""
    spans = passages.groupBy(F.col("doc_id").alias("cut_id")).agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("cut_spans"))
    joined = docs.join(spans, col(doc_id) == F.col("cut_id"), "left")
    words = F.filter(F.split(col(text), r"\s+"), lambda w: w != "")
    left = F.filter(F.transform(words, lambda w, i: F.struct(i.alias("i"), w.alias("w"))), lambda x: ~F.exists("cut_spans", lambda s: (x["i"] >= s["start"]) & (x["i"] < s["stop"])))
    out = F.when(F.col("cut_spans").isNull(), col(text)).otherwise(F.array_join(F.transform(left, lambda x: x["w"]), " "))
    return joined.withColumn(text, out).drop("cut_id", "cut_spans")
