"""Near-duplicate documents by DartMinHash signatures and banded joining.

A document is the multiset of its five-word shingles, weighted by how often
each occurs. Every shingle has one Poisson process of darts for each unit of
weight: arrival times are the darts' ranks, and a hash sends each dart to
one of the signature's coordinates. A document owns the darts that fall in
its shingles' regions, weight x rank limit, and the earliest dart of each
coordinate is the signature: two documents agree on a coordinate with the
probability of their weighted Jaccard similarity. A document throws only
about k ln k + 2k darts, however many shingles it has; if a coordinate got
none the rank limit doubles.

Equal texts (word sequences) are folded first. Documents that share a band
are candidates; links are verified on the shingles themselves. A crowded
bucket is a grid of cells of bounded size, which tasks compare independently,
and only links leave a cell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyprep.llm.common import Scratch, mix64, shingle_hashes, sized, word_hashes
from surveyprep.llm.graph import components

_TAG = np.uint64(0x9E3779B97F4A7C15)
#: Texts to a side of a cell, the part of a bucket that one step compares.
CELL = 512


def throw_darts(seed: np.ndarray, limit: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, rank, dart) of all arrivals below each element's rank limit.

    ``seed`` names an element's unit of weight; its n-th gap is the
    exponential of a hash of (seed, n), so the darts depend on nothing else.
    """
    who, ranks, darts = [], [], []
    at, idx, n = np.zeros(len(seed)), np.arange(len(seed)), 0
    while len(idx):
        h = mix64(seed[idx] + np.uint64(int(_TAG) * (n + 1) % (1 << 64)))
        at = at - np.log(((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53)
        on = at < limit[idx]
        at, idx, h = at[on], idx[on], h[on]
        who.append(owner[idx])
        ranks.append(at)
        darts.append(mix64(h ^ _TAG))
        n += 1
    cat = lambda x, t: np.concatenate(x) if x else np.empty(0, t)
    return cat(who, np.int64), cat(ranks, float), cat(darts, np.uint64)


def unit_seeds(shingles: np.ndarray) -> np.ndarray:
    """One seed per occurrence: the j-th occurrence of a shingle is its j-th unit of weight."""
    s = np.sort(shingles)
    if not len(s):
        return s
    new = np.concatenate([[True], s[1:] != s[:-1]])
    first = np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))
    return mix64(s + (np.arange(len(s)) - first).astype(np.uint64) * np.uint64(0xD1342543DE82EF95))


def signatures(units: list[np.ndarray], k: int) -> np.ndarray:
    """(documents, k) earliest darts; documents without a unit get zeros."""
    n = len(units)
    sig, open_ = np.zeros((n, k), np.uint64), np.flatnonzero([len(u) > 0 for u in units])
    size = np.array([max(1, len(u)) for u in units], float)
    limit = (k * np.log(k) + 2 * k) / size
    while len(open_):
        lens = [len(units[i]) for i in open_]
        who, rank, dart = throw_darts(np.concatenate([units[i] for i in open_]), np.repeat(limit[open_], lens), np.repeat(np.arange(len(open_)), lens))
        cell = who * k + (dart % np.uint64(k)).astype(np.int64)
        late = np.argsort(rank, kind="stable")[::-1]  # of repeated cells the last write, the earliest dart, stays
        found = np.zeros(len(open_) * k, np.uint64)
        have = np.zeros(len(open_) * k, bool)
        found[cell[late]] = dart[late]
        have[cell] = True
        sig[open_] = found.reshape(-1, k)
        short = open_[~have.reshape(-1, k).all(axis=1)]
        limit[short] *= 2
        open_ = short
    return sig


def sketch(docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int, width: int) -> DataFrame:
    """doc_id, word-sequence hash (w1, w2), band hashes, eight bits of each coordinate, unit hashes (4 bytes each) of every row."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("w1", T.LongType()),
                           T.StructField("w2", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("bits", T.ArrayType(T.LongType())), T.StructField("units", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                words = [word_hashes(np.frombuffer((t or "").encode("utf-8", "surrogatepass"), np.uint8)) for t in part.column(1).to_pylist()]
                units = [unit_seeds(shingle_hashes(w, width)) for w in words]
                sig = signatures(units, bands * rows)
                low = np.zeros((len(units), -(-bands * rows // 7), 8), np.uint8)
                spread = np.zeros((len(units), low.shape[1] * 7), np.uint8)
                spread[:, :bands * rows] = sig >> np.uint64(56)
                low[:, :, :7] = spread.reshape(len(units), -1, 7)
                low, sig = low.reshape(len(units), -1).view("<i8"), sig.reshape(len(units), bands, rows)
                band = np.zeros((len(units), bands), np.uint64)
                for r in range(rows):
                    band = mix64(band * np.uint64(3) + sig[:, :, r] + np.uint64(1))
                band = band.view(np.int64)
                whole = np.array([[int((mix64(w + np.uint64(s)) * mix64(np.arange(1, len(w) + 1, dtype=np.uint64) * np.uint64(2 * s + 1))).sum(dtype=np.uint64)) if len(w) else 0
                                   for s in (1, 2)] for w in words], np.uint64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(whole[:, 0].view(np.int64).copy()), pa.array(whole[:, 1].view(np.int64).copy()),
                    pa.array([list(b) if len(u) else [] for b, u in zip(band, units)], pa.list_(pa.int64())),
                    pa.array(list(low), pa.list_(pa.int64())),
                    pa.array([(u >> np.uint64(32)).astype(np.uint32).view(np.int32) for u in units], pa.list_(pa.int32()))], names=schema.fieldNames())

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def jaccard(one: str, two: str) -> Column:
    """Weighted Jaccard similarity of two unit arrays; a shingle's repeats are units of their own."""
    both = F.size(F.array_intersect(one, two))
    return both / (F.size(one) + F.size(two) - both)


def cells(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The runs of rows with equal ``keys``, across batches of rows that are sorted by them."""
    rest = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = t if rest is None else pa.concat_tables([rest, t])
        key = np.stack([t.column(c).to_numpy() for c in keys])
        edge = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1)]
        for start, end in zip(edge, edge[1:]):
            yield t.slice(start, end - start)
        rest = t.slice(edge[-1])
    if rest is not None and rest.num_rows:
        yield rest


def cell_links(t: pa.Table, least_equal: int, threshold: float) -> Iterator[tuple[int, np.ndarray]]:
    """(row of the right side, rows of the left side that it links to) of one cell.

    Compared are texts of different groups, in the first band that they
    share; of two texts that both failed, only one order.
    """
    col = {c: t.column(c).to_numpy() for c in ("rep", "root", "right", "miss")}
    wide = lambda c: t.column(c).combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)
    bits, bands, band = np.ascontiguousarray(wide("bits")).view(np.uint8), wide("bands"), t.column("band")[0].as_py()
    lists = t.column("units").combine_chunks()
    at, values = lists.offsets.to_numpy(), lists.values.to_numpy()
    size = np.diff(at)
    left = np.flatnonzero(~col["right"])
    for r in np.flatnonzero(col["right"]):
        c = left[(col["root"][left] != col["root"][r]) & (~col["miss"][left] | (col["rep"][left] < col["rep"][r]))]
        c = c[np.minimum(size[c], size[r]) >= threshold * np.maximum(size[c], size[r])]
        c = c[(bits[c] == bits[r]).sum(axis=1) >= least_equal]
        c = c[(bands[c] == bands[r]).argmax(axis=1) == band]
        own = np.unique(values[at[r]:at[r + 1]])
        for part in (c[i:i + 64] for i in range(0, len(c), 64)):
            other = np.concatenate([values[at[x]:at[x + 1]] for x in part])
            found = own[np.minimum(np.searchsorted(own, other), len(own) - 1)] == other
            both = np.add.reduceat(found, np.cumsum(size[part]) - size[part], dtype=np.int64)
            linked = part[both / (size[part] + size[r] - both) >= threshold]
            if len(linked):
                yield r, linked


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8,
                    width: int = 5, bands: int = 25, rows: int = 5) -> DataFrame:
    """doc_id, class_id (smallest doc_id of its group), is_kept, n_links (verified links of its text to other texts).

    Two documents are linked if the weighted Jaccard similarity of their
    shingles is at least ``threshold``; groups are the connected documents.
    With 25 bands of 5 a pair at 0.8 shares a band with probability 0.99995.

    In each band's bucket every text is compared with the smallest one. A
    text that isn't similar to that one is compared with the bucket's texts
    that are in another group by then, so no group is missed, and no group's
    copies are expanded into pairs. n_links counts the links so found.

    Null texts and texts without a word are groups of their own and link to
    nothing. Texts of under five words are one shingle. Equal texts, equal
    rows included, form one group. Null ids are groups of their own. An
    empty table gives an empty result. Other columns are not read.
    """
    scratch, k = Scratch(docs.sparkSession, "dart"), bands * rows
    s = scratch.cut(sketch(docs, id_col, text_col, bands, rows, width), "sketch")

    # fold equal texts: counts and minima are formed before the shuffle
    folded = s.where("doc_id is not null and size(bands) > 0").groupBy("w1", "w2").agg(F.min("doc_id").alias("rep"))
    folded = scratch.cut(folded, "folded")
    reps = s.where("size(bands) > 0").select("doc_id", "bands").join(folded.select("rep").distinct(), F.col("doc_id") == F.col("rep")) \
        .groupBy("rep").agg(F.min("bands").alias("bands"))
    rows_ = reps.select("rep", F.posexplode("bands").alias("band", "key"))
    heads = rows_.groupBy("band", "key").agg(F.min("rep").alias("head"), F.count("*").alias("n")).where("n > 1").drop("n")
    member = scratch.cut(rows_.join(heads.withColumnsRenamed({"band": "hb", "key": "hk"}), (F.col("band") == F.col("hb")) & (F.col("key") == F.col("hk")))
                         .select("band", "key", "head", "rep"), "member")
    near = scratch.cut(member.select(F.col("rep").alias("m")).distinct(), "near")
    units = s.select(F.col("doc_id").alias("rep"), "bands", "bits", "units").where("size(units) > 0").join(
        sized(near, 16), F.col("rep") == F.col("m"), "left_semi").dropDuplicates(["rep"])
    units = scratch.cut(units, "units")

    stars = member.where("rep <> head").select(F.col("head").alias("a"), F.col("rep").alias("b")).distinct()
    one = units.select(F.col("rep").alias("ra"), F.col("units").alias("ua"))
    two = units.select(F.col("rep").alias("rb"), F.col("units").alias("ub"))
    first = stars.join(one, F.col("a") == F.col("ra")).join(two, F.col("b") == F.col("rb"))
    first = scratch.cut(first.select("a", "b", (jaccard("ua", "ub") >= threshold).alias("ok")), "first")
    groups = components(first.where("ok").select("a", "b"), scratch, "cc1")

    # texts that failed against a bucket's head meet the bucket's other texts, unless one group holds both
    missed = first.where("not ok").select(F.col("a").alias("fa"), F.col("b").alias("fb"))
    rooted = member.where("rep <> head").join(groups, F.col("rep") == F.col("v"), "left").join(missed, (F.col("head") == F.col("fa")) & (F.col("rep") == F.col("fb")), "left")
    rooted = scratch.cut(rooted.select("band", "key", "rep", F.coalesce("root", "rep").alias("root"), F.col("fb").isNotNull().alias("miss")), "rooted")
    # a bucket is a grid of cells of about CELL x CELL texts: its texts on the left, those that failed on the right
    grid = rooted.groupBy("band", "key").agg(F.count("*").alias("m"), F.count_if("miss").alias("f")).where("f > 0 and m > 1") \
        .select(F.col("band").alias("ob"), F.col("key").alias("ok"), F.ceil(F.col("m") / CELL).alias("across"), F.ceil(F.col("f") / CELL).alias("down"))
    placed = rooted.join(scratch.cut(grid, "grid"), (F.col("band") == F.col("ob")) & (F.col("key") == F.col("ok")))
    placed = placed.withColumn("i", F.expr("pmod(xxhash64(rep), across)")).withColumn("j", F.expr("pmod(xxhash64(rep, 1), down)"))
    own = ["band", "key", "rep", "root", "miss"]
    left = placed.select(*own, F.lit(False).alias("right"), "i", F.explode(F.expr("sequence(0L, down - 1)")).alias("j"))
    right = placed.where("miss").select(*own, F.lit(True).alias("right"), F.explode(F.expr("sequence(0L, across - 1)")).alias("i"), "j")
    dealt = left.unionByName(right).join(units, "rep").repartition("band", "key", "i", "j").sortWithinPartitions("band", "key", "i", "j")
    # a link agrees in so many coordinates but for one pair in 50,000; the signatures' filling bytes are always equal
    least_agree = int(k * threshold - 4.1 * (k * threshold * (1 - threshold)) ** 0.5)
    filling = -(-k // 7) * 8 - k
    pair = T.StructType([T.StructField("a", docs.schema[id_col].dataType), T.StructField("b", docs.schema[id_col].dataType)])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in cells(batches, ["band", "key", "i", "j"]):
            rep = t.column("rep").combine_chunks()
            for r, linked in cell_links(t, least_agree + filling, threshold):
                yield pa.RecordBatch.from_arrays([rep.take(pa.array(linked)), rep.take(pa.array(np.full(len(linked), r)))], names=["a", "b"])

    second = dealt.mapInArrow(meet, pair).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    second = scratch.cut(second, "second")
    links = first.where("ok").select("a", "b").union(second)
    links = scratch.cut(links.distinct(), "links")
    groups = scratch.cut(components(links, scratch, "cc2"), "groups")
    degree = links.select(F.explode(F.array("a", "b")).alias("d")).groupBy("d").agg(F.count("*").alias("n_links"))

    text_class = folded.join(groups, F.col("rep") == F.col("v"), "left").join(degree, F.col("rep") == F.col("d"), "left") \
        .select(F.col("w1").alias("c1"), F.col("w2").alias("c2"), F.coalesce("root", "rep").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    text_class = scratch.cut(text_class, "classes")
    scratch.drop("member", "near", "units", "rooted", "grid", "first", "second", "folded")
    out = s.select("doc_id", "w1", "w2", (F.size("bands") > 0).alias("worded"))
    joined = out.join(text_class, F.col("worded") & (F.col("w1") == F.col("c1")) & (F.col("w2") == F.col("c2")), "left")
    return joined.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")) \
        .withColumn("is_kept", F.col("doc_id").isNull() | (F.col("doc_id") == F.col("class_id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are their group's smallest document; of rows with the same id and text, one stays (that of least hash)."""
    scratch = Scratch(docs.sparkSession, "dart-keep")
    found = near_duplicates(docs, id_col, text_col, **options)
    # a row per document; is_kept is the same in all rows of an id
    ids = scratch.cut(found.where("doc_id is not null").groupBy("doc_id").agg(F.min("is_kept").alias("kept"), F.count("*").alias("n"))
                      .where("not kept or n > 1").withColumnRenamed("doc_id", "known_id"), "ids")
    marked = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("own_id")).join(sized(ids, 32), F.col("own_id") == F.col("known_id"), "left")
    single = marked.where("known_id is null").select("row.*")
    again = marked.where("kept and n > 1").withColumn("text_hash", F.xxhash64(F.col(f"row.{text_col}"))).withColumn("text_size", F.length(F.col(f"row.{text_col}")))
    again = again.groupBy("own_id", "text_hash", "text_size").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row.*")
    return single.unionByName(again)
