"""Exact substring deduplication by matches in suffix order, cut at a fixed depth.

A string of ``depth`` bytes is removed if it starts at any other position.
In a suffix array that is: the longest common prefix with the previous or the
next smaller position in suffix order (the earlier or the later match)
reaches ``depth``. Positions whose suffixes agree on ``depth`` bytes form one
interval of that order, so it is enough to know the intervals of more than
one position. They are found without sorting every suffix:

1. Every window of ``depth`` bytes is keyed by the smallest hash of its short
   byte strings. Consecutive windows of equal key are one run, about one per
   90 bytes. Equal windows have equal keys, wherever they stand, so only runs
   whose key occurs in another run can hold a match with another run. Matches
   inside a document are found where it is read.
2. Runs of equal bytes are folded by key and content hash: all their windows
   match.
3. Runs that share a key with other contents are opened, one representative
   per content: their bytes, not their windows, are dealt out by key, and a
   task orders the windows of a bounded number of contents and finds the
   intervals. A key of more contents than a task may hold has its windows
   dealt out by hash and counted by partial aggregation instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyprep.llm.common import POWERS, Scratch, mix64, prefix_hash, sized

#: Contents that one task orders at most; a key of more goes by window hashes.
TASK_CONTENTS = 20_000


def string_hashes(data: np.ndarray, width: int, powers: Powers = POWERS) -> np.ndarray:
    """Hash of the ``width`` bytes at each position."""
    p = prefix_hash(data, powers)
    n = len(data) - width + 1
    return mix64((p[width:] - p[:n]) * powers.down[:n]) if n > 0 else np.empty(0, np.uint64)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values: block-wise running minima from both sides."""
    n = len(x)
    pad = np.full(-(-n // w) * w, np.iinfo(x.dtype).max, x.dtype)
    pad[:n] = x
    blocks = pad.reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - w + 1], left[w - 1: n])


def stretches(on: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], on.astype(np.int8), [0]])))
    return edge[::2], edge[1::2]


def runs_of(data: np.ndarray, depth: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, tuple]:
    """(start, windows, key, content) of the runs of a text, and the stretches of windows that recur in it."""
    n = len(data) - depth + 1
    key = sliding_min(string_hashes(data, gram), depth - gram + 1)
    start = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
    count = np.diff(np.concatenate([start, [n]]))
    p = prefix_hash(data)
    end = start + count + depth - 1
    content = mix64(mix64((p[end] - p[start]) * POWERS.down[start]) + count.astype(np.uint64))
    whole = mix64((p[depth:] - p[:n]) * POWERS.down[:n])
    order = np.sort(whole)
    twice = order[1:][order[1:] == order[:-1]]
    return start, count, key[start], content, stretches(np.isin(whole, twice)) if len(twice) else (np.empty(0, int),) * 2


def scan(docs: DataFrame, depth: int, gram: int) -> DataFrame:
    """(doc_id, th, start, n, key, content) per run; a null key marks windows that recur in their own document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "th", "start", "n", "key", "content"]
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                got: list[list[np.ndarray]] = [[] for _ in range(6)]
                for i, text in enumerate(part.column(2).to_pylist()):
                    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
                    if len(data) >= depth:
                        start, count, key, content, (a, b) = runs_of(data, depth, gram)
                        none = np.zeros(len(a), np.int64)
                        for col, x in zip(got, (np.full(len(start) + len(a), i), np.concatenate([start, a]), np.concatenate([count, b - a]),
                                                np.concatenate([key.view(np.int64), none]), np.concatenate([content.view(np.int64), none]),
                                                np.arange(len(start) + len(a)) >= len(start))):
                            col.append(x)
                if got[0]:
                    of, start, count, key, content, local = map(np.concatenate, got)
                    yield pa.RecordBatch.from_arrays([
                        part.column(0).take(pa.array(of)), part.column(1).take(pa.array(of)), pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32)),
                        pa.array(key, mask=local), pa.array(content, mask=local)], names=names)

    return docs.mapInArrow(run, f"doc_id {kind}, th long, start int, n int, key long, content long")


def strings(found: DataFrame, depth: int) -> DataFrame:
    """(key, content, bytes) of the wanted runs of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, wanted in zip(batch.column(0), batch.column(1)):
                data = text.as_py().encode("utf-8", "surrogatepass")
                w = wanted.values
                cut = [data[a:a + n + depth - 1] for a, n in zip(w.field("start").to_pylist(), w.field("n").to_pylist())]
                yield pa.RecordBatch.from_arrays([w.field("key"), w.field("content"), pa.array(cut, pa.binary())], names=["key", "content", "bytes"])

    return found.mapInArrow(run, "key long, content long, bytes binary")


def window_hashes(key: np.ndarray, contents: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, content's number, offset) of all windows of the contents; the hash holds the key too."""
    size = np.array([len(c) for c in contents])
    n = size - depth + 1
    p = prefix_hash(np.frombuffer(b"".join(contents), np.uint8))
    of = np.repeat(np.arange(len(contents)), n)
    i = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = (np.cumsum(size) - size)[of] + i
    return mix64(mix64((p[at + depth] - p[at]) * POWERS.down[at]) ^ key.view(np.uint64)[of]), of, i


def order_windows(depth: int):
    """(key, content, a, m): stretches of windows that recur, of the contents of one bucket of keys."""
    def run(t: pa.Table) -> pa.Table:
        key, content = t.column("key").to_numpy(), t.column("content").to_numpy()
        h, of, i = window_hashes(key, t.column("bytes").to_pylist(), depth)
        order = np.argsort(h, kind="stable")
        tie = h[order][1:] == h[order][:-1]
        on = np.zeros(len(h), bool)
        # in an interval, the position before is the earlier match, the one after the later match
        on[order[1:][tie]] = on[order[:-1][tie]] = True
        new = np.concatenate([[True], of[1:] != of[:-1]])
        first = np.flatnonzero(on & (new | ~np.concatenate([[False], on[:-1]])))
        last = np.flatnonzero(on & (np.concatenate([new[1:], [True]]) | ~np.concatenate([on[1:], [False]])))
        return pa.table({"hk": key[of[first]], "hc": content[of[first]], "a": i[first].astype(np.int32), "m": (last - first + 1).astype(np.int32)})
    return run


def explode_windows(some: DataFrame, depth: int) -> DataFrame:
    """(key, content, h, i) for every window of the contents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                key = part.column(0).to_numpy()
                h, of, i = window_hashes(key, part.column(2).to_pylist(), depth)
                yield pa.RecordBatch.from_arrays([pa.array(key[of]), part.column(1).take(pa.array(of)), pa.array(h.view(np.int64)), pa.array(i.astype(np.int32))],
                                                 names=["key", "content", "h", "i"])

    return some.mapInArrow(run, "key long, content long, h long, i int")


def crowded(some: DataFrame, scratch: Scratch, depth: int) -> DataFrame:
    """As order_windows, for keys of very many contents, by joins and partial aggregates."""
    w = scratch.cut(explode_windows(some, depth), "windows")
    # a window recurs if another content holds it
    twice = scratch.cut(w.groupBy("h").agg(F.min("content").alias("x"), F.max("content").alias("y")).where("x <> y").select(F.col("h").alias("g")), "twice")
    hits = w.join(sized(twice, 16), F.col("h") == F.col("g")).groupBy("key", "content").agg(F.array_sort(F.collect_set("i")).alias("at"))
    hits = hits.withColumn("a", F.expr("filter(transform(at, (x, j) -> if(j = 0 or at[j - 1] < x - 1, x, null)), x -> x is not null)")) \
        .withColumn("b", F.expr("filter(transform(at, (x, j) -> if(j = size(at) - 1 or get(at, j + 1) > x + 1, x, null)), x -> x is not null)"))
    hits = hits.select(F.col("key").alias("hk"), F.col("content").alias("hc"), F.explode(F.arrays_zip("a", "b")).alias("z"))
    return hits.select("hk", "hc", F.col("z.a").alias("a"), (F.col("z.b") - F.col("z.a") + 1).alias("m"))


def merged(spots: DataFrame, depth: int) -> DataFrame:
    """(doc_id, th, cut): each row's removed byte runs, as little-endian pairs of 32-bit start and end."""
    lists = spots.groupBy("doc_id", "th").agg(F.collect_list(F.struct("start", "n")).alias("s"))
    kind = spots.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = []
            for s in batch.column(2):
                a, n = (s.values.field(f).to_numpy().astype(np.int64) for f in ("start", "n"))
                order = np.argsort(a, kind="stable")
                a, b = a[order], np.maximum.accumulate((a + n + depth - 1)[order])
                first = np.concatenate([[True], a[1:] > b[:-1]])
                last = np.concatenate([first[1:], [True]])
                cuts.append(np.stack([a[first], b[last]], axis=1).astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cuts, pa.binary())], names=["doc_id", "th", "cut"])

    return lists.mapInArrow(run, f"doc_id {kind}, th long, cut binary")


def cut_out(rows: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes from (doc_id, text, cut)."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, cut in zip(batch.column(1), batch.column(2)):
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                spans = np.frombuffer(cut.as_py() or b"", "<i4").reshape(-1, 2)
                at, kept, gone = 0, hashlib.sha256(), 0
                for a, b in spans:
                    kept.update(data[at:a])
                    at, gone = b, gone + int(b - a)
                kept.update(data[at:])
                out.append((len(data), gone, len(spans), kept.hexdigest()))
            cols = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def repeated_spans(docs: DataFrame, scratch: Scratch, depth: int, gram: int, task_contents: int) -> DataFrame:
    """(doc_id, th, cut) of the rows that lose bytes, from (doc_id, th, text)."""
    runs = scratch.cut(scan(docs.select("doc_id", "th", "text"), depth, gram), "runs")
    shared = runs.where("key is not null").groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select(F.col("key").alias("k"))
    shared = scratch.cut(shared, "shared")
    some = scratch.cut(runs.where("key is not null").join(sized(shared, 16), F.col("key") == F.col("k")).drop("k"), "some")
    # one row per content: how often it occurs, and where first
    content = some.groupBy("key", "content").agg(F.count("*").alias("c"), F.min(F.struct("doc_id", "th", "start", "n")).alias("at"))
    content = scratch.cut(content, "content")
    mixed = content.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select(F.col("key").alias("k"), F.col("c").alias("contents"))
    mixed = scratch.cut(mixed, "mixed")
    open_ = content.join(sized(mixed, 24), F.col("key") == F.col("k")).select("key", "content", "at.*")
    per_doc = scratch.cut(open_.groupBy("doc_id", "th").agg(F.collect_list(F.struct("start", "n", "key", "content")).alias("wanted"))
                          .withColumnsRenamed({"doc_id": "d", "th": "t"}), "wanted")
    total = mixed.agg(F.sum("contents")).first()[0] or 0
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t"))
    with_text = docs.join(F.broadcast(per_doc) if total * 32 <= 32 << 20 else per_doc, same)
    # repeated rows of a document bring the same contents again
    opened = scratch.cut(strings(with_text.select("text", "wanted"), depth).join(sized(mixed, 24), F.col("key") == F.col("k")), "strings")
    buckets = max(1, -(-total // TASK_CONTENTS))
    calm = opened.where(F.col("contents") <= task_contents).dropDuplicates(["key", "content"]).select(
        "key", "content", "bytes", F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"))
    hits = calm.groupBy("bucket").applyInArrow(order_windows(depth), "hk long, hc long, a int, m int")
    hits = hits.union(crowded(opened.where(F.col("contents") > task_contents), scratch, depth))
    hits = hits.join(content.where("c > 1").select(F.col("key").alias("fk"), F.col("content").alias("fc")), (F.col("hk") == F.col("fk")) & (F.col("hc") == F.col("fc")), "left_anti")
    full = content.where("c > 1").select(F.col("key").alias("hk"), F.col("content").alias("hc"), F.lit(0).alias("a"), F.lit(-1).alias("m"))
    verdict = scratch.cut(full.union(hits), "verdict")
    spots = some.join(sized(verdict, 40), (F.col("key") == F.col("hk")) & (F.col("content") == F.col("hc"))).select(
        "doc_id", "th", (F.col("start") + F.col("a")).alias("start"), F.when(F.col("m") < 0, F.col("n")).otherwise(F.col("m")).alias("n"))
    local = runs.where("key is null").select("doc_id", "th", "start", "n")
    cuts = scratch.cut(merged(spots.union(local), depth), "cuts")
    scratch.drop("runs", "shared", "some", "content", "mixed", "wanted", "strings", "windows", "twice", "verdict")
    return cuts


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = 200, gram: int = 64,
                   task_contents: int = TASK_CONTENTS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row: bytes covered by a repeated string of ``depth`` bytes go.

    Texts are UTF-8 bytes, null is empty, and no match crosses documents.
    Strings are judged on the input; overlapping ones count, also inside one
    document. Equal rows repeat each other. Texts shorter than ``depth`` lose
    nothing. Null ids are allowed. Other columns are not read. An empty table
    gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "lpf")
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn("th", F.xxhash64("text"))
    cuts = repeated_spans(d, scratch, depth, gram, task_contents).withColumnsRenamed({"doc_id": "d", "th": "t"})
    size = cuts.agg(F.sum(F.length("cut") + 32)).first()[0] or 0
    cuts = F.broadcast(cuts) if size <= 32 << 20 else cuts
    rows = d.join(cuts, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("th").eqNullSafe(F.col("t")), "left")
    return cut_out(rows.select("doc_id", "text", "cut"))
