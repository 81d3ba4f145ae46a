"""The corpus pipeline: five stages, each over all rows that the one before it kept.

Every stage takes the columns of documents (others go) and returns them, the last one with those that mixing
adds. Empty tables go through all stages; what each does with nulls, very long texts, ties and repeated
rows is what its operator's docstring says, and what is stated here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meadowlark.llm import decontaminate, lang_id, mixing, ngram_join, pii
from meadowlark.llm.common import staged, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document whose largest language has a smaller share is rejected as a jumble.
LEAST_SHARE = 0.4
#: A label gives way to another language of such a share in a text of so many characters.
SURE_SHARE, SURE_CHARS = 0.9, 200


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents in no learned language: null texts and those without a letter, those that even chances
    explain better than any mixture of languages, and jumbles. A missing ``lang`` becomes the prediction, and
    so does one that a long enough text clearly contradicts. Trained on the labelled documents; repeated
    rows train and are judged each. Without any label nothing can be told, and every document goes."""
    langs, model = lang_id.train(docs)
    known = lang_id.identify(docs.select(*COLUMNS), langs, model)
    kept = known.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE) & (F.col("fit") > 0))
    sure = (F.col("score") >= SURE_SHARE) & (F.length("text") >= SURE_CHARS)
    return kept.withColumn("lang", F.when(sure, F.col("lang_pred")).otherwise(F.coalesce("lang", "lang_pred"))).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of linked texts: the one with the smallest id, ids before nulls. Rows
    that share the id are told apart by their texts; of repeated rows one stays. Texts without words all stay."""
    return ngram_join.one_of_each(docs.select(*COLUMNS)).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that an item of the table ``benchmark`` occurs in; null and empty texts stay, and so
    do all documents if there are no items. Repeated rows are dropped or stay together."""
    return decontaminate.decontaminate(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind and counts ``n_chars`` anew (null for a null text); keeps every row."""
    out = pii.masked(pii.find_pii(docs.select(*COLUMNS)))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples documents so that sources, languages and topics (learned from these documents) come near their target
    weights. A null source or language is a value of its own; texts without words are sampled at their
    cell's rate; rows with the same id, repeated or not, meet the same fate if their cells have the same rate."""
    mixed = mixing.mix(docs.select(*COLUMNS))
    return mixed.where("sampled").select(*COLUMNS, "topic", "n_tokens", "prob")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("ngram_join", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("pii", mask_personal_data),
    ("mix_sources", mix_to_targets),
]
#: SQL can't express the language model, MinHash or Myers' algorithm; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
