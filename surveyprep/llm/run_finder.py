"""Periodic runs of words: suffix automaton with link-cut access.

A run is a longest stretch of words with smallest period q that holds at least
two periods. Words are appended one after the other; the suffixes of what has
been read are the ancestors of the newest prefix in the automaton's link tree.
Each node knows where its strings ended last. Appending word i recolours the
path from its prefix to the root with i, and the path falls into segments
with one former end r each. Where the distance p = i - r is at most the length
of a segment's deepest node, the words up to i repeat what lies p words before
them over p words or more: a square, whose period is the smallest. It is
extended to its run once. Recolouring is the access operation of link-cut
trees; as a stretch's automaton is complete before the first access, the
preferred paths lie on the heavy paths of the final tree, as stacks of colours,
in place of splay trees: each access changes O(log n) colours on average.

Only stretches that can hold a run reach the automaton: a run of period q,
and of ``min_words`` words at least, is covered by windows of l words
(min_words / 2, doubled while l <= q / 2) that recur less than 2 l words away.
Equal windows have equal hashes, so no run is lost by that test; the automaton
compares words themselves.

A document is one record and is searched in one task, in memory linear in its
length; documents are independent, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyprep.llm.common import WORD, mix64

#: Bytes of text after which a task passes its results on.
FLUSH_BYTES = 4 << 20


def stretches(hashes: np.ndarray, min_words: int) -> list[tuple[int, int]]:
    """[from, to) of the words that can lie in a run, by word hashes."""
    n, half = len(hashes), min_words // 2
    if n < min_words:
        return []
    g, width = hashes, 1
    while width < half:  # hashes of windows of `half` words
        step = min(width, half - width)
        g = mix64(g[:-step] * np.uint64(3) + g[step:])
        width += step
    g, at = g.copy(), np.arange(len(g))
    edge = np.zeros(n + 1, np.int64)
    while True:
        order = at[np.argsort(g[at], kind="stable")]
        equal = np.flatnonzero(g[order[1:]] == g[order[:-1]])
        first, then = order[equal], order[equal + 1]
        near = then - first < 2 * width
        for x in (first[near], then[near]):
            np.add.at(edge, x, 1)
            np.add.at(edge, x + width, -1)
        recurs = np.zeros(len(g), bool)
        recurs[first] = recurs[then] = True
        at = np.flatnonzero(recurs[:-width] & recurs[width:]) if len(g) > width else at[:0]
        if 4 * width > n or not len(at):  # no period of 2 * width or more fits twice, or none is left
            break
        g[at] = mix64(g[at] * np.uint64(3) + g[at + width])
        g = g[:len(g) - width]
        width *= 2
    ends = np.flatnonzero(np.diff(np.concatenate([[False], np.cumsum(edge[:-1]) > 0, [False]])))
    return [(int(a), int(b)) for a, b in zip(ends[::2], ends[1::2]) if b - a >= min_words]


def link_tree(words: list) -> tuple[list[int], list[int], list[int]]:
    """Suffix links and string lengths of the automaton's states, and the state of each prefix."""
    step, link, length, prefix, last = [{}], [-1], [0], [], 0
    for word in words:
        new, p = len(step), last
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        while p >= 0 and word not in step[p]:
            step[p][word] = new
            p = link[p]
        if p >= 0:
            q = step[p][word]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                part = len(step)
                step.append(step[q].copy())
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = link[new] = part
                while p >= 0 and step[p].get(word) == q:
                    step[p][word] = part
                    p = link[p]
        last = new
        prefix.append(new)
    return link, length, prefix


def heavy_heads(link: list[int], length: list[int]) -> list[int]:
    """The topmost state of each state's heavy path."""
    down = np.argsort(np.array(length), kind="stable").tolist()  # links point to shorter strings
    size, heavy, head = [1] * len(link), [0] * len(link), [0] * len(link)
    for v in reversed(down[1:]):
        size[link[v]] += size[v]
    for v in down[1:]:
        up = link[v]
        if not heavy[up] or size[v] > size[heavy[up]]:
            heavy[up] = v
    for v in down[1:]:
        head[v] = head[link[v]] if heavy[link[v]] == v else v
    return head


def extent(code: np.ndarray, at: int, period: int) -> int:
    """The first word from ``at`` that differs from the one a period before it."""
    step = 64
    while at < len(code):
        differs = np.flatnonzero(code[at:at + step] != code[at - period:at - period + len(code[at:at + step])])
        if len(differs):
            return at + int(differs[0])
        at, step = at + step, 2 * step
    return len(code)


def runs_of(words: list, min_words: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of a stretch's runs of ``min_words`` words or more."""
    known: dict = {}
    code = np.array([known.setdefault(w, len(known)) for w in words])
    link, length, prefix = link_tree(code.tolist())
    head = heavy_heads(link, length)
    colours: dict[int, list[tuple[int, int]]] = {}  # by heavy path: (length of the deepest state, last end), the shallowest at the end
    ended: dict[int, int] = {}  # by period: where its latest run ends
    out = []
    for i, v in enumerate(prefix):
        while v > 0:
            top, deep = head[v], length[v]
            path, above = colours.setdefault(top, []), 0
            while path and above < deep:  # the colours of the states down to v
                reach, r = path[-1]
                p = i - r
                if p <= min(reach, deep) and i >= ended.get(p, 0):
                    start = i - 2 * p + 1
                    while start and code[start - 1] == code[start - 1 + p]:
                        start -= 1
                    end = ended[p] = extent(code, i + 1, p)
                    if end - start >= min_words:
                        out.append((start, end - start, p))
                if reach <= deep:
                    path.pop()
                above = reach
            path.append((deep, i))
            v = link[top]
    return out


def document_runs(words: list[bytes], min_words: int = 12) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a document, by start and period."""
    if len(words) < min_words:
        return []
    hashes = mix64(np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64))
    return sorted((a + s, n, p) for a, b in stretches(hashes, min_words) for s, n, p in runs_of(words[a:b], min_words))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that lie in a run after its first period."""
    if not runs:
        return words
    keep = bytearray(b"\1") * len(words)
    for start, n, p in runs:
        keep[start + p:start + n] = bytes(n - p)
    return [w for w, k in zip(words, keep) if k]


RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 12) -> DataFrame:
    """doc id, n_words, runs, collapsed: one row per row of ``docs``.

    Words are the runs of characters other than ASCII blanks. ``runs`` holds
    (start, length, period), in words from 0, of every run of at least
    ``min_words`` words, by start, then period. ``collapsed`` is the text's
    words without those in a run after its first period, joined by one blank.
    A null or blank text has no words, no runs and an empty ``collapsed``; a
    null id stays null; repeated rows have a row each; other columns aren't
    read. Texts of any length are searched whole. An empty table gives an
    empty result. ``min_words`` is 4 or more.
    """
    if min_words < 4:
        raise ValueError("min_words is 4 or more")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    id_kind = rows.schema["id"].dataType.simpleString()
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, held, n_words, runs, texts = 0, 0, [], [], []
            for i in range(batch.num_rows):
                words = (batch.column(1)[i].as_py() or b"").split()
                found = document_runs(words, min_words)
                n_words.append(len(words))
                runs.append([{"start": s, "length": n, "period": p} for s, n, p in found])
                texts.append(b" ".join(collapse(words, found)))
                held += len(texts[-1]) + 24 * len(found)
                if held > FLUSH_BYTES or i + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(at, i + 1 - at), pa.array(n_words, pa.int64()), pa.array(runs, kind),
                         pa.array(texts, pa.binary())], names=["id", "n_words", "runs", "text"])
                    at, held, n_words, runs, texts = i + 1, 0, [], [], []

    found = rows.mapInArrow(run, f"id {id_kind}, n_words long, runs {RUNS}, text binary")
    return found.select(F.col("id").alias(id_col), "n_words", "runs", F.col("text").cast("string").alias("collapsed"))


# --- the query's input and digests ---

def periodic_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc id, text): the texts, a tenth of which get a periodic tail by their id's crc32.

    With h the unsigned crc32 of the decimal id, g = h div 10 and n words, the
    documents with h mod 10 = 0 and a word have word i >= a replaced by word
    a + (i - a) mod p, where a = g mod n and p = 1 + (n - a) div (3 + g mod 8).
    A document without an id keeps its text.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    words = F.regexp_extract_all(F.col(text_col), F.lit(WORD), F.lit(0))
    cut = docs.select(F.col(id_col), F.col(text_col).alias("text"), h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    cut = cut.withColumn("g", F.expr("h div 10")).withColumn("n", F.size("words"))
    cut = cut.withColumn("a", F.expr("g % n")).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    tail = F.expr("array_join(transform(words, (w, i) -> if(i < a, w, words[cast(a + (i - a) % p as int)])), ' ')")
    return cut.select(id_col, F.when(F.col("n") > 0, tail).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, the longest run and digests of ``find_runs``' rows."""
    longest = F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as before, -r.period as below)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("top", longest).select(
        id_col, F.size("runs").cast("long").alias("n_runs"), (-F.col("top.before")).alias("start"), F.col("top.length").alias("length"),
        (-F.col("top.below")).alias("period"), F.expr("(1000 * top.length) div -top.below").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
