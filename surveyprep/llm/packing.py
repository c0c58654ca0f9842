"""Harmonic packing of tokenised documents into fixed-length sequences.

Reciprocal classes: a piece of length L belongs to the class k = capacity // L,
whose sequences hold exactly k pieces. A class's sequences fill by arithmetic
alone: each task numbers its own pieces per class, a small table of counts per
(class, task) gives the offsets, and piece number i goes to sequence i // k.

Documents may be cut, so a tail whose class would leave more than ``slack``
tokens unused is cut at the next reciprocal, capacity // (k + 1), and the rest
is classed anew. What a class has beyond whole sequences is fewer than k
pieces, so at most about capacity * ln(capacity) pieces remain over all
classes at any input size; these are packed first-fit decreasing.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from surveyprep.llm.common import Scratch, sized

#: Tails of at most this many tokens are never cut: k of them waste less than one of them.
SMALL = 64


def cut_plan(length: int, capacity: int = 2048, slack: int = 16) -> list[tuple[int, int, int]]:
    """(start, length, pieces per sequence) of the pieces of one document."""
    out = [(i, capacity, 1) for i in range(0, length - capacity + 1, capacity)]
    at = len(out) * capacity
    while at < length:
        rest = length - at
        k = capacity // rest
        if capacity - k * rest > slack and rest > SMALL:
            rest = capacity // (k + 1)
            k = capacity // rest
        out.append((at, rest, k))
        at += rest
    return out


class Encoder:
    """Ids of the byte-level BPE vocabulary, as the ``tokenizers`` file gives them.

    The same vocabulary's rank file is encoded by ``tiktoken``, five times as
    fast with equal ids (a test holds the two against each other). A text it
    can't take (its pattern engine has a depth limit) goes to ``tokenizers``.
    """

    def __init__(self, json_path: str, rank_path: str | None, pattern: str | None, specials: dict[str, int]):
        from tokenizers import Tokenizer

        self.slow, self.fast = Tokenizer.from_file(json_path), None
        if rank_path:
            import tiktoken

            with open(rank_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=specials)

    def __call__(self, text: str) -> list[int]:
        if self.fast is not None:
            try:
                return self.fast.encode(text, allowed_special="all")
            except BaseException as e:  # the engine's panic is no Exception
                if not isinstance(e, ValueError) and "Panic" not in type(e).__name__:
                    raise
        return self.slow.encode(text, add_special_tokens=False).ids


def tokenize_and_cut(docs: DataFrame, encoder: dict, id_col: str, text_col: str, end_id: int,
                     capacity: int, slack: int, with_ids: bool) -> DataFrame:
    """One row per piece, numbered per class within its task; null text is empty."""
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()), T.StructField("per_seq", T.IntegerType()),
        T.StructField("worker", T.IntegerType()), T.StructField("nth", T.LongType()),
        *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, worker, seen = Encoder(**encoder), TaskContext.get().partitionId(), {}
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows, of, ids_out = [], [], []
                for i, text in enumerate(part.column(1).to_pylist()):
                    ids = np.asarray([*encode(text or ""), end_id], "<u4")
                    for start, length, k in cut_plan(len(ids), capacity, slack):
                        own = ids[start:start + length]
                        nth = seen[k] = seen.get(k, -1) + 1
                        rows.append((start, length, zlib.crc32(own.tobytes()), len(ids), k, worker, nth))
                        of.append(i)
                        if with_ids:
                            ids_out.append(own.astype("<i4"))
                if rows:
                    cols = np.array(rows, np.int64).T
                    arrays = [part.column(0).take(pa.array(of, pa.int32())), *(pa.array(c) for c in cols[:4]),
                              pa.array(cols[4].astype(np.int32)), pa.array(cols[5].astype(np.int32)), pa.array(cols[6])]
                    if with_ids:
                        arrays.append(pa.ListArray.from_arrays(
                            pa.array(np.concatenate([[0], np.cumsum([len(x) for x in ids_out])]).astype(np.int32)),
                            pa.array(np.concatenate(ids_out))))
                    yield pa.RecordBatch.from_arrays(arrays, names=schema.fieldNames())

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def first_fit_decreasing(capacity: int):
    """Packs the pieces that are left over, a set bounded by the capacity."""
    def run(pdf):
        pdf = pdf.sort_values(["length", "per_seq", "idx"], ascending=[False, True, True], kind="stable")
        room: list[int] = []
        seq, offset = [], []
        for n in pdf["length"]:
            at = next((i for i, r in enumerate(room) if r >= n), len(room))
            if at == len(room):
                room.append(capacity)
            seq.append(at)
            offset.append(capacity - room[at])
            room[at] -= n
        return pdf.assign(extra=np.array(seq, np.int64), offset=np.array(offset, np.int64))[["per_seq", "idx", "extra", "offset"]]
    return run


def harmonic_pack(docs: DataFrame, encoder: dict, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1,
                  capacity: int = 2048, slack: int = 16, with_ids: bool = False) -> DataFrame:
    """Pieces with their place: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, per_seq[, ids].

    Null and empty texts hold the end id alone. Repeated rows are packed as
    often as they occur. An empty table gives no piece. Other columns of
    ``docs``, whatever their names, are not read. Texts of any length are
    cut, never truncated. Pieces of a sequence follow each other without gap.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "pack")
    pieces = scratch.cut(tokenize_and_cut(docs, encoder, id_col, text_col, end_id, capacity, slack, with_ids), "pieces")

    # counts: a row per class and task; classes: a row per class, at most 2 * sqrt(capacity) of them
    counts = pieces.groupBy("per_seq", "worker").agg(F.count("*").alias("n"))
    counts = counts.withColumn("first", F.sum("n").over(W.partitionBy("per_seq").orderBy("worker")) - F.col("n"))
    counts = scratch.cut(counts, "counts")
    classes = counts.groupBy("per_seq").agg(F.sum("n").alias("total")).withColumn("whole", F.floor(F.col("total") / F.col("per_seq")))
    # one short window over the classes, not over data
    classes = classes.withColumn("base", F.sum("whole").over(W.orderBy("per_seq")) - F.col("whole")) \
        .withColumn("n_whole", F.sum("whole").over(W.partitionBy()))
    places = counts.join(classes.withColumnRenamed("per_seq", "c"), F.col("per_seq") == F.col("c")).select(
        "per_seq", "worker", "first", "whole", "base", "n_whole").withColumnsRenamed({"per_seq": "c", "worker": "w"})

    # places are worked out on narrow rows; the ids stay where they were written
    placed = pieces.select("per_seq", "worker", "nth", "length").join(places, (F.col("per_seq") == F.col("c")) & (F.col("worker") == F.col("w")))
    placed = placed.withColumn("idx", F.col("first") + F.col("nth")).drop("c", "w", "first")
    bin_ = F.floor(F.col("idx") / F.col("per_seq"))
    full = placed.where(bin_ < F.col("whole")).withColumn("sequence_id", F.col("base") + bin_)
    full = full.withColumn("offset", F.sum("length").over(W.partitionBy("sequence_id").orderBy("idx")) - F.col("length"))

    rest = placed.where(bin_ >= F.col("whole"))
    fitted = rest.select("per_seq", "idx", "length", F.lit(0).alias("one")).groupBy("one").applyInPandas(
        first_fit_decreasing(capacity), "per_seq int, idx long, extra long, offset long")
    fitted = fitted.withColumnsRenamed({"per_seq": "c", "idx": "i"})
    rest = rest.join(fitted, (F.col("per_seq") == F.col("c")) & (F.col("idx") == F.col("i"))).withColumn("sequence_id", F.col("n_whole") + F.col("extra"))
    place = [F.col("per_seq").alias("c"), F.col("worker").alias("w"), F.col("nth").alias("t"),
             F.col("sequence_id").cast("long").alias("sequence_id"), F.col("offset").cast("long").alias("offset")]
    place = scratch.cut(full.select(*place).unionByName(rest.select(*place)), "place")
    out = pieces.join(sized(place, 40), (F.col("per_seq") == F.col("c")) & (F.col("worker") == F.col("w")) & (F.col("nth") == F.col("t")))
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "per_seq", *(["ids"] if with_ids else []))
