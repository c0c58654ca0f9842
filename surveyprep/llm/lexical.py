"""Ranked lexical search by norm buckets of impact vectors, exact.

A document is a sparse vector: the weight of each term times its impact
there. An item's vector holds how often it names each term, so the score is
their inner product. Vectors are ordered by length and read in buckets,
longest first. An item has done with a bucket if the product of its length
and the bucket's greatest length can't reach its k-th score so far
(Cauchy-Schwarz). Inside a bucket, its rarer terms are added up first, until
the coordinates that are left, each at its greatest value in the bucket, can't
reach the k-th score by themselves; documents that hold none of the terms
added are out, and so are those whose sum stays below it with what is left
(by coordinates or by Cauchy-Schwarz, whichever is less). The survivors are
scored anew over all terms in whole numbers.

Items are taken in blocks of bounded size; a block's terms are all that tasks
need to know. Vectors are sorted inside the tasks that made them: nothing of
the documents is shuffled but the best hits.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from surveyprep.llm.common import Scratch

#: Letters, digits and everything beyond ASCII, in UTF-8 and after lower-casing A to Z.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")


def terms_of(text: bytes | None) -> list[bytes]:
    return TERM.findall((text or b"").lower())  # bytes.lower() changes A to Z alone


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, item_id, terms, counts) of the rows with a term; ``item`` numbers them."""
    rows = items.select(F.monotonically_increasing_id().alias("item"), F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                if found := Counter(terms_of(batch.column(2)[i].as_py())):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), pa.array([list(found)], pa.list_(pa.binary())), pa.array([list(found.values())], pa.list_(pa.int64()))],
                        names=["item", "item_id", "terms", "counts"])

    return rows.mapInArrow(run, "item long, item_id long, terms array<binary>, counts array<bigint>")


def term_counts(docs: DataFrame, number: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, terms, tfs) of the documents with a term; terms are numbers of those in ``number``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, n, terms, tfs = [], [], [], []
            for i in range(batch.num_rows):
                found = terms_of(batch.column(1)[i].as_py())
                if found:
                    known = Counter(map(number.get, found))
                    known.pop(None, None)
                    row.append(i)
                    n.append(len(found))
                    terms.append(list(known))
                    tfs.append(list(known.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int32())), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))],
                names=["doc_id", "n", "terms", "tfs"])

    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<bigint>")


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """Where each row's list ends among the values, and the values."""
    offsets = column.offsets.to_numpy()
    return offsets - offsets[0], column.values.slice(offsets[0], offsets[-1] - offsets[0]).to_numpy()


def impact_vectors(counts: DataFrame, weight: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """(doc_id, norm, terms, impacts) of the documents that hold one of the block's terms, longest first in each task.

    The norm is that of weight times impact, over the block's terms.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, terms = flat(batch.column(2))
            tf = flat(batch.column(3))[1]
            m = 100 - 25 + (25 * batch.column(1).to_numpy() * n_docs) // n_terms
            impact = (1000000000 * tf) // (1000 * tf + 12 * np.repeat(m, np.diff(ends)))
            square = np.square((weight[terms] * impact).astype(float))
            norm = np.sqrt(np.add.reduceat(square, ends[:-1])) if len(square) else np.zeros(0)  # no row's list is empty
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(norm), batch.column(2), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(impact, pa.int64()))],
                                             names=["doc_id", "norm", "terms", "impacts"])

    return counts.where(F.size("terms") > 0).mapInArrow(run, "doc_id long, norm double, terms array<int>, impacts array<bigint>").sortWithinPartitions(F.col("norm").desc())


class Bucket:
    """Documents of similar length, by row and by term."""

    def __init__(self, batch: pa.RecordBatch, weight: np.ndarray):
        ends, terms = flat(batch.column(2))
        impact = flat(batch.column(3))[1]
        self.size = batch.num_rows
        self.known = np.asarray(batch.column(0).is_valid())
        self.ids = np.asarray(batch.column(0).fill_null(0))
        self.norm = batch.column(1).to_numpy()
        by_term = np.argsort(terms, kind="stable")
        self.doc = np.repeat(np.arange(self.size), np.diff(ends))[by_term]
        self.value = (weight[terms] * impact)[by_term]  # whole numbers
        self.terms, first = np.unique(terms[by_term], return_index=True)
        self.edge = np.append(first, len(terms))
        self.most = np.maximum.reduceat(self.value, first) if len(first) else self.value

    def column(self, at: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.edge[at], self.edge[at + 1])
        return self.doc[part], self.value[part]


def bucket_scores(bucket: Bucket, terms: np.ndarray, counts: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the bucket that can reach ``least``, and the exact scores of these."""
    at = np.searchsorted(bucket.terms, terms)
    here = at < len(bucket.terms)
    here[here] = bucket.terms[at[here]] == terms[here]
    at, counts = at[here], counts[here]
    most = counts * bucket.most[at]  # the greatest share of the score that a coordinate can have here
    order = np.argsort(-most, kind="stable")
    at, counts, most = at[order], counts[order], most[order]
    left = np.append(np.cumsum(most[::-1])[::-1], 0)  # what the coordinates from here on can add at most
    first = int(np.count_nonzero(left >= max(least, 1)))  # those added first: without one of them no document gets there
    if not first:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    score, square, met = np.zeros(bucket.size, np.int64), np.zeros(bucket.size), np.zeros(bucket.size, bool)
    for c, a in zip(counts[:first], at[:first]):
        doc, value = bucket.column(a)
        score[doc] += c * value
        square[doc] += np.square(value.astype(float))
        met[doc] = True
    rows = np.flatnonzero(met)
    rest = np.sqrt(np.maximum(np.square(bucket.norm[rows]) - square[rows], 0) + 1e-9 * np.square(bucket.norm[rows])) * np.sqrt(np.square(counts[first:].astype(float)).sum())
    rows = rows[score[rows] + np.minimum(left[first], rest * (1 + 1e-9) + 1) >= least]
    if len(rows):
        exact = np.zeros(bucket.size, np.int64)
        for c, a in zip(counts, at):
            doc, value = bucket.column(a)
            exact[doc] += c * value
        rows = rows[(exact[rows] >= least) & (exact[rows] > 0)]
        return rows, exact[rows]
    return rows, score[rows]


def bucket_search(items: list, weight: np.ndarray, floor: dict[int, int], k: int):
    """The k best documents of a task's buckets for each item; items are (item, item_id, terms, counts)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = [float(np.sqrt(np.square(np.asarray(counts, float)).sum())) for *_, counts in items]
        least = [floor.get(item, 0) for item, *_ in items]
        best: list[tuple | None] = [None] * len(items)
        for batch in batches:
            if not batch.num_rows:
                continue
            bucket = Bucket(batch, weight)
            top = float(bucket.norm.max()) * (1 + 1e-9) + 1
            for j, (_, _, terms, counts) in enumerate(items):
                if size[j] * top < least[j]:
                    continue
                rows, score = bucket_scores(bucket, terms, counts, least[j])
                if not len(rows):
                    continue
                ids, known = bucket.ids[rows], bucket.known[rows]
                if best[j]:
                    score, ids, known = (np.concatenate(x) for x in zip(best[j], (score, ids, known)))
                order = np.lexsort((ids, ~known, -score))[:k]
                best[j] = score[order], ids[order], known[order]
                if len(order) == k:
                    least[j] = max(least[j], int(best[j][0][-1]))
        for (item, item_id, *_), found in zip(items, best):
            if found:
                score, ids, known = found
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(ids), pa.int64()), pa.array([item_id] * len(ids), pa.int64()), pa.array(ids, pa.int64(), mask=~known), pa.array(score, pa.int64())],
                    names=["item", "item_id", "doc_id", "score"])
    return run


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20, doc_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", block_terms: int = 1 << 18, head: float = 0.03) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents of highest score above 0 for each item.

    Terms are runs of ASCII letters and digits and of all characters beyond
    ASCII; only A to Z are lower-cased. With N documents that hold a term, L
    terms in all, n in a document, df documents with a term and tf of it in
    one, the term's weight is floor(1000 ln((2N + 2) / (2 df + 1))), the
    document's m is 75 + (25 n N) div L, and the score sums weight *
    ((10^9 tf) div (1000 tf + 12 m)) over the item's terms, repeats included.
    Ties go by ascending doc id, documents without an id last.

    A null or empty text has no terms. Every row is a document or an item of
    its own, repeats included; an item without an id has a null one. Items
    without a hit have no row. Other columns aren't read. Texts are read
    whole. Items are taken in blocks of about ``block_terms`` different terms
    each, the documents being read once a block; the share ``head`` of the
    longest vectors is searched first, for scores to prune with.
    """
    scratch = Scratch(docs.sparkSession, "lexical")
    asked = scratch.cut(item_terms(items, item_col, item_text_col), "items")
    blocks = max(1, -(-int(asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // block_terms))
    hits = None
    for b in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).collect()  # about block_terms terms
        number = {t: i for i, t in enumerate(sorted({bytes(t) for r in rows for t in r.terms}))}
        counts = scratch.cut(term_counts(docs, number, doc_col, text_col), "counts")
        n_docs, n_terms = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        weight = np.zeros(len(number), np.int64)
        if n_docs:
            for r in counts.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # a row for each of the block's terms
                weight[r["t"]] = int(np.floor(1000 * np.log((2 * n_docs + 2) / (2 * r["count"] + 1))))
        vectors = scratch.cut(impact_vectors(counts, weight, n_docs, max(n_terms, 1)), "vectors")
        block = [(r["item"], r["item_id"], np.array([number[bytes(t)] for t in r.terms]), np.array(r.counts, np.int64)) for r in rows]
        kind, rank = "item long, item_id long, doc_id long, score long", F.row_number().over(W.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
        best = lambda found: found.withColumn("rank", rank).where(F.col("rank") <= k)
        cut = vectors.agg(F.percentile_approx("norm", 1 - head)).first()[0] or 0.0
        first = scratch.cut(best(vectors.where(F.col("norm") >= cut).mapInArrow(bucket_search(block, weight, {}, k), kind)), "first")
        floor = {r["item"]: r["least"] for r in first.groupBy("item").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= k).collect()}
        size = {item: float(np.sqrt(np.square(c.astype(float)).sum())) for item, _, _, c in block}
        short = min((floor.get(item, 0) / size[item] for item in size), default=0.0) * (1 - 1e-9) - 1  # shorter vectors reach no item's k-th score
        others = vectors.where((F.col("norm") < cut) & (F.col("norm") >= short)).mapInArrow(bucket_search(block, weight, floor, k), kind)
        found = scratch.cut(best(first.drop("rank").union(others)), f"found-{b}")
        hits = found if hits is None else hits.union(found)
        scratch.drop("counts", "vectors", "first")
    scratch.drop("items")
    return hits.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP11_SQL = f"""
WITH words AS (SELECT row_number() OVER () AS no, doc_id, {_TERMS} AS t FROM documents WHERE text IS NOT NULL),
docs AS (SELECT no, doc_id, len(t) AS n FROM words WHERE len(t) > 0),
whole AS (SELECT count(*) AS total, sum(n)::BIGINT AS terms FROM docs),
tf AS (SELECT no, term, count(*) AS tf FROM (SELECT no, unnest(t) AS term FROM words) x GROUP BY no, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
asked AS (SELECT item, item_id, unnest(t) AS term FROM (SELECT row_number() OVER () AS item, item_id, {_TERMS} AS t FROM benchmark WHERE text IS NOT NULL) x),
scored AS (
  SELECT item, item_id, tf.no, doc_id,
         sum(floor(1000 * ln((2 * total + 2)::DOUBLE / (2 * df + 1)))::BIGINT * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * total) // terms))))::BIGINT AS score
  FROM asked JOIN tf ON asked.term = tf.term JOIN df ON asked.term = df.term JOIN docs ON docs.no = tf.no CROSS JOIN whole
  GROUP BY item, item_id, tf.no, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""
