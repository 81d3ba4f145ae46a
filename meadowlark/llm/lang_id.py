"""Language identification: multilingual mixture inference.

A language model is a table of letter-trigram probabilities over hashed buckets, counted on labelled
texts. A document is taken as a mixture of languages: expectation-maximisation estimates its
proportions from its trigrams' likelihoods, first over all learned languages. The languages whose
removal costs the least likelihood are then removed and the rest fitted again, down to one; the set is
the one on this way (or the best single language) whose likelihood, less half the log of the sample
size for each further language, is highest. Nothing else bounds the number of languages of a text. A fit goes on
until its distance from the maximum, which its slopes bound, can't change what is removed, or until it rises no more in
single precision; there is no other limit on its rounds.

Texts are lower-cased, ASCII signs that aren't letters become a single space (other characters keep their
UTF-8 bytes, signs among them), and trigrams of bytes are counted over the whole text; of a very long one
only the counts are held. Neighbouring trigrams overlap in two bytes, so a text's evidence is counted as a
third of its trigrams. ``fit`` says how many bits a trigram the mixture explains a text better than even
chances of all buckets; at 0 or less, no learned language explains it.

Nulls: rows with a null text or label don't train; a null text, or one without a letter, is predicted
``und`` with the score 0. With nothing to train on every prediction is ``und``. Equal shares go to the
language that is first by name. Repeated rows train as often as they come; columns of the input that
have the name of a result column give way. At most ``MAX_LANGS`` labels are learned (an error beyond):
the model, 4 bytes a bucket and language, is what bounds the broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meadowlark.llm.common import add_by_rows, col, map_arrow, ship, slices

BUCKETS = 1 << 13
MAX_LANGS = 400
SMOOTH = 0.05
ROUNDS = 12
#: A fit goes on, ROUNDS at a time, until it is so near its maximum, tells enough before, or no longer rises.
CLOSE = 0.2
PER_DOC = 96  # rows of counts held at once: 96 x 8192 x 4 bytes
AT_ONCE = 4 << 20  # likelihoods (trigrams of some texts x languages) held at once, or those of one text

_FOLD = bytes(i if i >= 128 or 97 <= i <= 122 else 32 for i in range(256))


def trigram_counts(texts: list[str | None]) -> np.ndarray:
    """Counts by (text, bucket), float32."""
    parts = [b" ".join((t or "").lower().encode("utf-8", "replace").translate(_FOLD).split()) for t in texts]
    raw = np.frombuffer(b"\0" + b"\0".join(b" " + p + b" " if p else b"" for p in parts) + b"\0", np.uint8).astype(np.uint32)
    code = raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]
    row = np.cumsum(raw[:-2] == 0, dtype=np.int64) - 1
    good = (raw[:-2] != 0) & (raw[1:-1] != 0) & (raw[2:] != 0)
    code, row = code[good], row[good]
    bucket = (code * np.uint32(2654435761)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
    return np.bincount(row * BUCKETS + bucket, minlength=len(texts) * BUCKETS).reshape(len(texts), BUCKETS).astype(np.float32)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """The languages by name and their trigram probabilities (languages x buckets), counted over all
    rows of ``labelled``: each task sums its rows, and the sums are added by language and block of buckets."""
    width = 64

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, 1 << 20):
                names, texts = part.column(1).to_pylist(), part.column(0).to_pylist()
                for at in range(0, len(texts), PER_DOC):
                    counts = trigram_counts(texts[at : at + PER_DOC])
                    for name in set(names[at : at + PER_DOC]):
                        mine = np.array([x == name for x in names[at : at + PER_DOC]])
                        sums[name] = sums.get(name, 0) + counts[mine].sum(0, dtype=np.float64)
        for name, s in sums.items():
            cut = s.reshape(-1, width)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(cut)), pa.array(np.arange(len(cut), dtype=np.int32)), pa.array(list(cut), pa.list_(pa.float64()))], ["lang", "block", "n"])

    rows = labelled.where(col(text).isNotNull() & col(lang).isNotNull()).select(col(text).alias("text"), col(lang).alias("lang"))
    if rows.select("lang").distinct().limit(MAX_LANGS + 1).count() > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    blocks = map_arrow(rows, count, "lang string, block int, n array<double>")
    spread = blocks.select("lang", "block", F.posexplode("n").alias("at", "n"))
    sums = spread.groupBy("lang", "block", "at").agg(F.sum("n").alias("n")).where("n > 0")
    table = sums.select("lang", (F.col("block") * width + F.col("at")).alias("bucket"), "n").toPandas()
    langs = sorted(table["lang"].unique())
    counts = np.zeros((len(langs), BUCKETS))
    counts[table["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(np.int64), table["bucket"].to_numpy(np.int64)] = table["n"]
    counts += SMOOTH
    return langs, (counts / counts.sum(1, keepdims=True)).astype(np.float32)


def mixture(n: np.ndarray, given: np.ndarray, ends: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Proportions (texts x languages) by expectation-maximisation from ``share`` on, where 0 stays 0,
    the likelihood of each trigram, the log-likelihood of each text and how far it can be under its
    maximum (which is concave, so that its slopes bound it). ``n`` and ``given`` have the
    count and the likelihoods of each trigram of each text, text by text; ``ends`` says where each
    text's begin."""
    sizes = np.diff(ends)
    total = np.maximum(np.add.reduceat(n, ends[:-1]), 1)[:, None]
    for _ in range(ROUNDS):
        fit = np.einsum("ij,ij->i", np.repeat(share, sizes, axis=0), given)
        share = share * np.add.reduceat(given * (n / np.maximum(fit, 1e-30))[:, None], ends[:-1], axis=0) / total
    fit = np.maximum(np.einsum("ij,ij->i", np.repeat(share, sizes, axis=0), given), 1e-30)
    slope = np.add.reduceat(given * (n / fit)[:, None], ends[:-1], axis=0, dtype=np.float64) - total
    return share, fit, np.add.reduceat(n * np.log(fit), ends[:-1], dtype=np.float64), np.where(share > 0, slope, 0).max(1)


def losses(n: np.ndarray, part: np.ndarray, ends: np.ndarray, share: np.ndarray) -> np.ndarray:
    """The log-likelihood (texts x columns) lost by taking away each column's part of every trigram's
    likelihood, and its share, before the rest is fitted again."""
    gone = np.add.reduceat(n[:, None] * np.log(np.maximum(1 - part, 1e-30)), ends[:-1], axis=0, dtype=np.float64)
    total = np.add.reduceat(n, ends[:-1], dtype=np.float64)[:, None]
    return total * np.log(np.maximum(1 - share, 1e-30)) - gone


def choose(counts: np.ndarray, model: np.ndarray) -> np.ndarray:
    """Proportions of the chosen languages of each text (its counts by bucket); 0 for the rest."""
    counts[counts.sum(1) == 0, 0] = 1  # a text without trigrams; its answer isn't used
    size = (counts > 0).sum(1) * len(model)
    if len(counts) > 1 and size.sum() > AT_ONCE:
        half = len(counts) // 2
        return np.concatenate([choose(counts[:half], model), choose(counts[half:], model)])
    alone = counts @ np.log(model).T
    texts, best = np.arange(len(counts)), np.argmax(alone, axis=1)
    chosen = np.zeros(alone.shape, np.float32)
    chosen[texts, best] = 1
    value = alone[texts, best].astype(np.float64) / 3
    penalty = np.log(np.maximum(counts.sum(1) / 3, 2)) / 2
    row, bucket = np.nonzero(counts)
    n, given = counts[row, bucket], model.T[bucket]
    left, before = np.ones(alone.shape, bool), np.full(len(counts), -np.inf)
    share = np.full(alone.shape, 1 / len(model), np.float32)
    while True:
        going = left.sum(1) > 1  # of one language there is nothing to remove
        if not going.all():
            some = going[np.searchsorted(texts, row)]
            texts, left, share, row, n, given = texts[going], left[going], share[going], row[some], n[some], given[some]
        if not len(texts):
            return chosen
        ends = np.append(np.searchsorted(row, texts), len(row))
        share, fit, likely, under = mixture(n, given, ends, share)
        now = likely / 3 - (left.sum(1) - 1) * penalty[texts]
        better = now > value[texts]
        chosen[texts[better]], value[texts[better]] = share[better], now[better]
        # by what each one's removal costs (of equals the last by name first), then what the first, first two, ... cost together
        part = given * np.repeat(share, np.diff(ends), axis=0) / fit[:, None]
        cost = np.where(left, losses(n, part, ends, share), np.inf)
        order = left.shape[1] - 1 - np.argsort(cost[:, ::-1], axis=1, kind="stable")
        part = np.cumsum(np.take_along_axis(part, np.repeat(order, np.diff(ends), axis=0), 1), axis=1)
        together = losses(n, part, ends, np.cumsum(np.take_along_axis(share, order, 1), axis=1))
        # as many as cost less than one penalty, which only raises the value; one at least, all but one at most
        cheap = np.logical_and.accumulate((together + under[:, None]) / 3 < penalty[texts, None], axis=1).sum(1)
        wait = (cheap == 0) & (under / 3 > CLOSE) & (likely > before[texts])  # the fit isn't close enough yet to tell
        before[texts] = np.where(wait, likely, -np.inf)
        gone = (np.arange(left.shape[1]) < np.clip(cheap, 1, left.sum(1) - 1)[:, None]) & ~wait[:, None]
        np.put_along_axis(left, order, np.take_along_axis(left, order, 1) & ~gone, 1)
        share = np.where(left, np.maximum(share, 1e-6), 0)
        share = (share / share.sum(1, keepdims=True)).astype(np.float32)


def explained(counts: np.ndarray, model: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Bits a trigram by which each text's mixture beats even chances of all buckets."""
    row, bucket = np.nonzero(counts)
    given = np.einsum("ij,ij->i", shares[row], model.T[bucket])
    bits = counts[row, bucket] * np.log2(np.maximum(given * len(model[0]), 1e-30))
    return np.bincount(row, bits, minlength=len(counts)) / np.maximum(counts.sum(1), 1)


def identify(docs: DataFrame, langs: list[str], model: np.ndarray, text: str = "text") -> DataFrame:
    """Adds ``lang_pred`` (the language of the largest share), ``score`` (its share), ``langs`` (all chosen
    languages with their shares, largest first) and ``fit`` (null where nothing is predicted)."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def rows(texts: list[str | None]):
        pred, score, mixed, fits = [], [], [], []
        for at in range(0, len(texts), PER_DOC):
            some = texts[at : at + PER_DOC]
            counts = trigram_counts(some)
            shares = choose(counts, sent.value) if langs else np.zeros((len(some), 1))
            better = explained(counts, sent.value, shares) if langs else np.zeros(len(some))
            for t, s, bits in zip(some, shares, better, strict=True):
                if not langs or not has_letter(t):
                    pred.append("und"), score.append(0.0), mixed.append(""), fits.append(None)
                    continue
                order = [i for i in np.argsort(-s, kind="stable") if s[i] > 0]
                fits.append(round(float(bits), 4))
                pred.append(langs[order[0]])
                score.append(round(min(1.0, float(s[order[0]])), 4))
                mixed.append(",".join(f"{langs[i]}:{s[i]:.2f}" for i in order))
        return pred, score, mixed, fits

    new = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("langs", T.StringType()), T.StructField("fit", T.DoubleType())]
    return add_by_rows(docs, [text], new, rows, 1 << 20)


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def language_digest(docs: DataFrame) -> DataFrame:
    """The query's columns; the fifth of the documents that crc32 picks is held out of training."""
    held = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False))
    langs, model = train(docs.where(~held))
    return identify(docs.select("doc_id", held.alias("held_out"), "text"), langs, model).drop("text")
