"""Target-distribution importance resampling.

A document's weight tells how much more likely its words are in the target's texts than in the corpus: the
mean gain of its features, by hashed bucket. Adding Gumbel noise and taking the highest scores draws
documents without replacement in proportion to the exponential of their weights.

1. Texts become features: runs of ``n`` consecutive words, joined by a space. A slice of texts is folded and split
   at once; its distinct features are grouped by their length in bytes, each group an array of rows of bytes
   (uint8), and the CRCs of a whole group are updated column by column with one table lookup a column, then
   scattered back to the features in the order of the text. A feature of more than ``PIECE`` bytes is a few rows,
   whose CRCs are combined by the linear map that ``PIECE`` zero bytes make.
2. Each task adds up its buckets; tasks' sums (a row per task and block of buckets) meet by block. What comes to
   the driver is one count a bucket and side, whatever the input. Documents' buckets are written as bytes, two
   each, so that the text is read and hashed once.
3. Weights are whole-number means of gains, floored; noise is a hash of the document's id.
4. The cut is found from counts by score (scores are whole numbers of a bounded range, so few), and only
   documents at the cut or above it are put in order, in ranges, each numbered from the count before it.

Nulls: a null or empty text has no features, no words, the weight 0 and is never drawn; a null id counts as an
empty one in the noise and comes after other ids among equals. Rows are documents, each of them: repeated
ones count, and are drawn or not, each by itself (equal scores; equal ids in an order that isn't defined, so that
the ranks, as a set, are). An empty target gives gains all the same (its counts are 0), an empty corpus an empty
result. Texts of any length go whole; a slice holds some MB of texts or one text. Only the id and the text are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meadowlark.llm.common import col, map_arrow, ship, slices, staged
from meadowlark.operators.rank import numbered

BUCKETS, LONGEST, LEAST_WORDS, PERCENT, SEED = 10000, 1, 20, 10, 2024
#: Bytes of a feature that are a row of their own, if it is longer.
PIECE = 512
#: Letters and digits stay, A-Z become a-z, all other ASCII separates; bytes of other characters stay.
_FOLD = bytes(i + 32 if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i >= 128 else 32 for i in range(256))


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(0xEDB88320), table >> 1)
    return table


_TABLE = _crc_table()


def crc_matrix(rows: np.ndarray) -> np.ndarray:
    """CRC-32 of each row of a matrix of bytes, column by column."""
    crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
    for column in np.ascontiguousarray(rows.T):
        crc = _TABLE[(crc ^ column) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
    return ~crc


def _zeros_map(n: int) -> np.ndarray:
    """What n zero bytes after it make of each bit of a CRC."""
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for _ in range(n):
        bits = _TABLE[bits & np.uint32(0xFF)] ^ (bits >> np.uint32(8))
    return bits


_AFTER = _zeros_map(PIECE)


def crc_of_long(raw: bytes) -> int:
    """The CRC-32 of many bytes: of rows of ``PIECE`` bytes (the first may be shorter), then combined."""
    first = len(raw) % PIECE
    crc = int(crc_matrix(np.frombuffer(raw, np.uint8, first).reshape(1, -1))[0])
    for piece in crc_matrix(np.frombuffer(raw, np.uint8, offset=first).reshape(-1, PIECE)).tolist():
        moved = 0
        for bit in range(32):
            if crc >> bit & 1:
                moved ^= int(_AFTER[bit])
        crc = moved ^ piece
    return crc


def crcs(features: list[bytes]) -> np.ndarray:
    """CRC-32 (unsigned, int64) of each of many byte strings."""
    sizes = np.fromiter(map(len, features), np.int64, len(features))
    out = np.zeros(len(features), np.int64)
    order = np.argsort(sizes, kind="stable")
    cuts = np.flatnonzero(np.diff(sizes[order])) + 1
    for group in np.split(order, cuts) if len(order) else ():
        size = int(sizes[group[0]])
        if size > PIECE:
            out[group] = [crc_of_long(features[i]) for i in group]
        else:
            out[group] = crc_matrix(np.frombuffer(b"".join([features[i] for i in group]), np.uint8).reshape(len(group), size))
    return out


def pieces(raw: bytes, size: int) -> Iterator[bytes]:
    """Folded bytes in pieces of about ``size``, cut at spaces."""
    at = 0
    while len(raw) - at > size:
        stop = raw.find(b" ", at + size)
        if stop < 0:
            break
        yield raw[at:stop]
        at = stop
    yield raw[at:]


def features_of(texts: list[str | None], longest: int = LONGEST, buckets: int = BUCKETS, at_once: int = 1 << 20) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The buckets of all features of all texts, text by text, and how many words and features each text has.
    Features are hashed when ``at_once`` bytes of text, or more, have been split."""
    n_words = np.zeros(len(texts), np.int64)
    known: dict[bytes, int] = {}
    at: list[int] = []
    done: list[np.ndarray] = []
    held = 0

    def flush() -> None:
        nonlocal held
        if at:
            done.append((crcs(list(known)) % buckets)[at])
        known.clear(), at.clear()
        held = 0

    for i, t in enumerate(texts):
        before: list[bytes] = []  # the words of the piece before that a run can begin with
        for piece in pieces((t or "").encode("utf-8", "surrogatepass").translate(_FOLD), at_once):
            new = piece.split()
            words = before + new
            n_words[i] += len(new)
            for n in range(1, longest + 1):
                grams = new if n == 1 else [b" ".join(words[j : j + n]) for j in range(max(len(before) - n + 1, 0), len(words) - n + 1)]
                at += [known.setdefault(g, len(known)) for g in grams]
            before = words[max(len(words) - longest + 1, 0) :] if longest > 1 else []
            held += len(piece)
            if held >= at_once:
                flush()
    flush()
    n_features = sum(np.maximum(n_words - n + 1, 0) for n in range(1, longest + 1))
    return np.concatenate(done) if done else np.zeros(0, np.int64), n_words, n_features


def hashed(docs: DataFrame, longest: int, buckets: int) -> DataFrame:
    """(doc_id, n_words, n_features, buckets): the buckets of a text's features as bytes, four or two each."""
    width = bucket_type(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2 << 20):
                found, words, features = features_of(part.column(1).to_pylist(), longest, buckets)
                ends = np.concatenate([[0], np.cumsum(features)]) * np.dtype(width).itemsize
                raw = found.astype(width).tobytes()
                rows = [raw[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(words, pa.int64()), pa.array(features, pa.int64()), pa.array(rows, pa.binary())], ["doc_id", "n_words", "n_features", "buckets"])

    return map_arrow(docs, run, "doc_id long, n_words long, n_features long, buckets binary")


def bucket_type(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def bucket_counts(rows: DataFrame, buckets: int) -> np.ndarray:
    """How many features all rows have in each bucket: summed in each task, then by block of buckets."""
    width, block = bucket_type(buckets), 500

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                sums += np.bincount(np.frombuffer(raw, width), minlength=buckets)
        cut = [sums[i : i + block] for i in range(0, buckets, block)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cut), dtype=np.int32)), pa.array(cut, pa.list_(pa.int64()))], ["block", "n"])

    blocks = map_arrow(rows.select("buckets"), count, "block int, n array<long>")
    spread = blocks.select("block", F.posexplode("n").alias("at", "n")).where("n > 0")
    sums = spread.groupBy("block", "at").agg(F.sum("n").alias("n")).collect()  # a row a bucket at most
    out = np.zeros(buckets, np.int64)
    for r in sums:
        out[r["block"] * block + r["at"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket, in thousandths: floor of 1000 times the log of how its smoothed share grows."""
    buckets, all_s, all_t = len(corpus), int(corpus.sum()), int(target.sum())
    value = lambda s, t: math.floor(1000 * math.log((t + 1) * (all_s + buckets) / ((s + 1) * (all_t + buckets))))
    return np.array([value(s, t) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Gumbel noise in thousandths, floored, of the first 32 bits of a hash of the id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighed(rows: DataFrame, gain: np.ndarray, seed: int) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of ``hashed`` rows."""
    ship(rows.sparkSession)
    sent, width = rows.sparkSession.sparkContext.broadcast(gain), bucket_type(len(gain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = sent.value
        for batch in batches:
            ids = batch.column(0).to_pylist()
            weights = [int(gain[x].sum()) // len(x) if len(x := np.frombuffer(raw, width)) else 0 for raw in batch.column(3).to_pylist()]
            scores = [w + noise(i, seed) for i, w in zip(ids, weights, strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(3)], pa.array(weights, pa.int64()), pa.array(scores, pa.int64())], ["doc_id", "n_words", "n_features", "weight", "score"])

    return map_arrow(rows, run, "doc_id long, n_words long, n_features long, weight long, score long")


def cut_of(scores: DataFrame, percent: int) -> tuple[int, int | None]:
    """How many documents are drawn, and the score of the last of them (None if none is)."""
    counts = scores.groupBy("score").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0))
    drawn = F.floor(F.sum("n").over(Window.partitionBy()) * percent / 100)  # a row a score: the range of gains and noise bounds them
    row = counts.select("score", upto.alias("upto"), drawn.alias("drawn")).where("drawn > 0 and upto >= drawn").orderBy("upto").first()
    return (int(row["drawn"]), int(row["score"])) if row else (0, None)


def resample(docs: DataFrame, target: DataFrame, *, text: str = "text", doc_id: str = "doc_id", target_text: str = "text", percent: int = PERCENT, least_words: int = LEAST_WORDS, longest: int = LONGEST, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """Every document's ``doc_id``, ``n_features``, ``weight``, ``score`` and, if it is drawn, its ``rank``. Of the
    documents with at least ``least_words`` words, ``percent`` in a hundred are drawn."""
    rows = staged(hashed(docs.select(col(doc_id).cast("long").alias("doc_id"), col(text).alias("text")), longest, buckets), "features")
    aim = hashed(target.select(F.lit(0).cast("long").alias("doc_id"), col(target_text).alias("text")), longest, buckets)
    scored = staged(weighed(rows, gains(bucket_counts(rows, buckets), bucket_counts(aim, buckets)), seed), "scores")

    enough = F.col("n_words") >= least_words
    drawn, cut = cut_of(scored.where(enough), percent)
    columns = ["doc_id", "n_features", "weight", "score"]
    if cut is None:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    high = enough & (F.col("score") >= cut)
    ordered = numbered(scored.where(high).select(*columns), [F.desc("score"), F.asc_nulls_last("doc_id")], "rank")
    ranked = ordered.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")).cast("long"))
    return ranked.select(*columns, "rank").unionByName(scored.where(~high).select(*columns, F.lit(None).cast("long").alias("rank")))


def drawn_documents(docs: DataFrame, drawn: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The documents that were drawn, with their rank; of ids that repeat, the first rank."""
    ranks = drawn.where("rank is not null").groupBy(F.col("doc_id").alias("drawn_id")).agg(F.min("rank").alias("rank"))
    return docs.select(*[col(c) for c in docs.columns if c.lower() != "rank"]).join(ranks, col(doc_id) == F.col("drawn_id")).drop("drawn_id")


def importance_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The query's columns, with its fixed parameters."""
    return resample(docs, benchmark)


_BYTES = "list_transform(range(CAST(length(hex(f)) / 2 AS BIGINT)), lambda i: (strpos('0123456789ABCDEF', substr(hex(f), 2 * i + 1, 1)) - 1) * 16 + strpos('0123456789ABCDEF', substr(hex(f), 2 * i + 2, 1)) - 1)"
_STEP = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE = f"""
WITH tbl AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_concat([i], range(8)), lambda c, b: {_STEP}) AS v FROM range(256) r(i))),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT unnest({_WORDS}) AS f FROM benchmark),
f AS (SELECT doc_id, unnest(w) AS f FROM d),
words AS (SELECT DISTINCT f FROM (SELECT f FROM f UNION ALL SELECT f FROM b)),
h AS (SELECT f, xor(list_reduce(list_concat([4294967295::BIGINT], {_BYTES}::BIGINT[]), lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) % {BUCKETS} AS k FROM words, tbl),
s AS (SELECT k, count(*) AS s FROM f JOIN h USING (f) GROUP BY 1), t AS (SELECT k, count(*) AS t FROM b JOIN h USING (f) GROUP BY 1),
g AS (
  SELECT k, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT sum(s) FROM s) + {BUCKETS}) / ((coalesce(s, 0) + 1) * (coalesce((SELECT sum(t) FROM t), 0) + {BUCKETS})))) AS BIGINT) AS gain
  FROM (SELECT DISTINCT k FROM h) LEFT JOIN s USING (k) LEFT JOIN t USING (k)),
w AS (SELECT doc_id, CAST(floor(sum(gain) / count(*)::DOUBLE) AS BIGINT) AS weight FROM f JOIN h USING (f) JOIN g USING (k) GROUP BY 1),
x AS (
  SELECT d.doc_id, len(w) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || left(sha256('{SEED}:' || d.doc_id), 8) AS UBIGINT)::DOUBLE + 0.5e0) / 4294967296e0))) AS BIGINT) AS score
  FROM d LEFT JOIN w USING (doc_id)),
r AS (SELECT *, CASE WHEN n_features >= {LEAST_WORDS} THEN row_number() OVER (PARTITION BY n_features >= {LEAST_WORDS} ORDER BY score DESC, doc_id) END AS n FROM x)
SELECT doc_id, n_features, weight, score, CASE WHEN n <= {PERCENT} * (SELECT count(*) FROM x WHERE n_features >= {LEAST_WORDS}) // 100 THEN n END AS rank FROM r
"""
