"""Token counts from flat token files: separator scan.

Documents lie one after the other in binary files of token ids, each closed by the end-of-document
id, the first that the vocabulary doesn't use; ids have 16 bits, or 32 if that one needs them. There is no index. A file is read in blocks of fixed size that different tasks
take, and numpy finds a block's separators in one vectorised search. A prefix scan over the blocks'
summaries (separators so far, place of the last one) stitches documents that cross block boundaries:
it gives each separator its number in the file and each document its length.

``write_tokens`` makes such files from documents, one or more per task, in the shared folder, and a
manifest (file, number in the file, document id). Files of tasks that failed or ran twice aren't in the
manifest and are never read.

Nulls: a null or empty text is a document of no tokens; a null id stays null. Repeated rows are
documents of their own. Tokens after a file's last separator are a document with ``complete`` false.
An empty table or file gives no rows. Only the id and the text are read. A very long text is encoded whole
(its tokens are held at once, some 30 bytes each) and scanned by blocks like any other.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meadowlark.llm.common import col, file_system, fresh_path, map_arrow, ship, slices, staged
from meadowlark.llm.tokens import MULTI, encoder, first_free, ranks_file

BLOCK = 4 << 20
FILE_BYTES = 256 << 20


def write_tokens(docs: DataFrame, folder: str, vocabulary: bytes, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Writes the documents' tokens to flat files in ``folder``; returns the manifest."""
    spark = docs.sparkSession
    separator = first_free(vocabulary)
    width = width_of(separator)
    ship(spark)
    sent = spark.sparkContext.broadcast(vocabulary)
    place, base = file_system(folder)
    place.create_dir(base)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(sent.value).encode_ordinary
        place, base = file_system(folder)
        out, name, number, size = None, "", 0, 0
        try:
            for batch in batches:
                for part in slices(batch, 1 << 20):
                    names, numbers = [], []
                    for t in part.column(1).to_pylist():
                        if out is None or size >= FILE_BYTES:
                            if out is not None:
                                out.close()
                            name, number, size = f"{uuid.uuid4().hex}.bin", 0, 0
                            out = place.open_output_stream(f"{base}/{name}")
                        ids = encode(t) if t else []
                        raw = np.array([*ids, separator], f"<u{width}").tobytes()
                        out.write(raw)
                        names.append(name), numbers.append(number)
                        number, size = number + 1, size + len(raw)
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names), pa.array(numbers, pa.int64())], ["doc_id", "file", "number"])
        finally:
            if out is not None:
                out.close()

    rows = docs.select(col(doc_id).cast("long").alias("doc_id"), col(text).alias("text"))
    return staged(map_arrow(rows, run, "doc_id long, file string, number long"), "manifest")


def listed(spark: SparkSession, folder: str) -> DataFrame:
    """(path, file, length) of the files in a folder."""
    found = spark.read.format("binaryFile").load(folder)
    return found.select("path", F.element_at(F.split("path", "/"), -1).alias("file"), "length")


def width_of(separator: int) -> int:
    """Bytes of an id."""
    return 2 if separator < 1 << 16 else 4


def scan(files: DataFrame, separator: int, block: int = BLOCK) -> DataFrame:
    """(file, number, n_tokens, complete) of each document in ``files`` (path, file, length). ``block`` is in
    bytes, a multiple of an id's."""
    width = width_of(separator)
    parts = files.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("length") / block) - 1, F.lit(0)).cast("long"))))
    parts = parts.where("length > 0").select("path", "file", "length", "block").repartition("file", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                place, path = file_system(row["path"])
                at = row["block"] * block
                with place.open_input_file(path) as f:
                    f.seek(at)
                    raw = f.read(min(block, row["length"] - at))
                ids = np.frombuffer(raw, f"<u{width}", len(raw) // width)
                ends = np.flatnonzero(ids == separator) + at // width
                last = [int(ends[-1])] if len(ends) else [None]
                yield pa.RecordBatch.from_arrays([pa.array([row["file"]]), pa.array([row["block"]], pa.int64()), pa.array([row["length"] // width], pa.int64()), pa.array([len(ends)], pa.int64()), pa.array(last, pa.int64()), pa.array([ends], pa.list_(pa.int64()))], ["file", "block", "size", "n", "last", "ends"])

    found = staged(map_arrow(parts, run, "file string, block long, size long, n long, last long, ends array<long>"), "blocks")
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    prefix = found.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"), F.coalesce(F.max("last").over(before), F.lit(-1)).alias("carry"))
    whole = found.where("n > 0").join(prefix, ["file", "block"]).select("file", "skip", "carry", "ends", F.posexplode("ends").alias("i", "end"))
    previous = F.when(F.col("i") == 0, F.col("carry")).otherwise(F.expr("element_at(ends, greatest(i, 1))"))
    whole = whole.select("file", (F.col("skip") + F.col("i")).alias("number"), (F.col("end") - previous - 1).alias("n_tokens"), F.lit(True).alias("complete"))
    rest = found.groupBy("file").agg(F.sum("n").alias("number"), (F.max("size") - F.coalesce(F.max("last"), F.lit(-1)) - 1).alias("n_tokens")).where("n_tokens > 0")
    return whole.unionByName(rest.withColumn("complete", F.lit(False)))


def token_counts(docs: DataFrame, vocabulary: bytes | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_tokens) of all documents, counted in the flat files written from them."""
    spark = docs.sparkSession
    folder = fresh_path(spark, "tokens")
    vocabulary = vocabulary or ranks_file(name=MULTI)
    manifest = write_tokens(docs, folder, vocabulary, text, doc_id)
    kept = listed(spark, folder).join(manifest.select("file").distinct(), "file", "left_semi")
    return manifest.join(scan(kept, first_free(vocabulary)), ["file", "number"]).select("doc_id", "n_tokens")
