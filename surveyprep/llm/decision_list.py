"""Quality rules: a learned decision list over countable text features.

Sequential covering: a rule, a conjunction of thresholds, is grown on two
thirds of the labelled rows by information gain until it covers no kept
document, pruned on the other third, and accepted only if it is precise
there; covered rows go and the next rule is grown. The list is emitted as
one ordered Spark CASE expression, so judging the corpus is a projection.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyprep.llm.common import Scratch, sized

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words", "n_digits", "n_ends"]

#: Features that rules may use, as SQL over COUNTS.
FEATURES = {
    "n_words": "cast(n_words as double)",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "distinct_share": "n_distinct_words / greatest(n_words, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "words_per_end": "n_words / greatest(n_ends, 1)",
}


def text_counts(text: str | None) -> tuple[int, ...]:
    """COUNTS of one text. Words are runs without ASCII blanks; null counts nothing."""
    if not text:
        return (0,) * len(COUNTS)
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    chars = len(text) - sum(map(text.count, BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in data.split(b"\n") if x.strip()]
    repeat = 0
    if n >= 3:
        windows = list(zip(words, words[1:], words[2:]))
        if len(found := Counter(windows)) < len(windows):
            mark = np.zeros(n, bool)
            at = np.flatnonzero(np.fromiter((found[x] > 1 for x in windows), bool, len(windows)))
            for j in range(3):
                mark[at + j] = True
            repeat = int(mark.sum())
    digits = sum(map(data.count, (b"0", b"1", b"2", b"3", b"4", b"5", b"6", b"7", b"8", b"9")))
    ends = data.count(b".") + data.count(b"!") + data.count(b"?")
    return n, chars, symbols, len(lines) - len(set(lines)), repeat, len(lines), len(set(words)), digits, ends


def count_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, COUNTS and base_failed for each row; ``carry`` columns come along as carry_<name>."""
    keep = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *[F.col(c).alias(f"carry_{c}") for c in carry])
    schema = T.StructType([keep.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in COUNTS), *(keep.schema[f"carry_{c}"] for c in carry)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = list(zip(*map(text_counts, batch.column(1).to_pylist()))) or [[]] * len(COUNTS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in cols), *batch.columns[2:]], names=schema.fieldNames())

    out = keep.mapInArrow(run, schema)
    return out.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


# --- learning (numpy, on a bounded sample of labelled rows) ---

Rule = list[tuple[str, str, float]]


def covers(rule: Rule, x: np.ndarray, names: list[str]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for name, op, at in rule:
        v = x[:, names.index(name)]
        out &= v >= at if op == ">=" else v <= at
    return out


def grow(x: np.ndarray, bad: np.ndarray, names: list[str], bins: int) -> Rule:
    """Adds the threshold of most information gain until no good row is covered."""
    rule: Rule = []
    on = np.ones(len(x), bool)
    while len(rule) < 6 and (on & ~bad).any():
        p0, n0 = (on & bad).sum(), (on & ~bad).sum()
        before, best = np.log2(p0 / (p0 + n0)), (0.0, None)
        for j, name in enumerate(names):
            for at in np.unique(np.quantile(x[on, j], np.linspace(0, 1, bins + 1), method="nearest")):
                for op in (">=", "<="):
                    hit = on & ((x[:, j] >= at) if op == ">=" else (x[:, j] <= at))
                    p, n = (hit & bad).sum(), (hit & ~bad).sum()
                    if p and (gain := p * (np.log2(p / (p + n)) - before)) > best[0] + 1e-12:
                        best = (gain, (name, op, float(at)))
        if best[1] is None:
            break
        rule.append(best[1])
        on &= covers([best[1]], x, names)
    return rule


def prune(rule: Rule, x: np.ndarray, bad: np.ndarray, names: list[str]) -> Rule:
    """The head of the rule with the best (bad - good) / covered on held-out rows; the shortest of equals."""
    def worth(r: Rule) -> float:
        c = covers(r, x, names)
        return ((c & bad).sum() - (c & ~bad).sum()) / max(1, c.sum())
    return max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (worth(r), -len(r))) if rule else rule


def learn(x: np.ndarray, bad: np.ndarray, part: np.ndarray, names: list[str], min_precision: float = 0.95,
          min_cover: int = 5, bins: int = 64, max_rules: int = 32) -> list[Rule]:
    """Ordered reject rules; rows with ``part`` 2 of 0..2 prune and accept, the rest grow."""
    rules: list[Rule] = []
    left = np.ones(len(x), bool)
    for _ in range(max_rules):
        g, h = left & (part != 2), left & (part == 2)
        if not (g & bad).any() or not (h & bad).any():
            break
        rule = prune(grow(x[g], bad[g], names, bins), x[h], bad[h], names)
        if not rule:
            break
        c = covers(rule, x, names)
        hits = c & left
        # Laplace-smoothed precision on all rows left, and on those held out
        if (hits & bad).sum() < min_cover or ((hits & bad).sum() + 1) / (hits.sum() + 2) < min_precision - 0.05 \
                or (c & h & bad).sum() < min_precision * (c & h).sum():
            break
        rules.append(rule)
        left &= ~c
    return rules


def rule_expression(rules: list[Rule]) -> Column:
    """The list as one ordered CASE: number of the first rule that fires (from 1), else 0 for the default, keep."""
    cond = [reduce(lambda a, b: a & b, [(F.expr(FEATURES[n]) >= at) if op == ">=" else (F.expr(FEATURES[n]) <= at) for n, op, at in r]) for r in rules]
    out = F
    for i, c in enumerate(cond, 1):
        out = out.when(c, F.lit(i))
    return out.otherwise(F.lit(0)) if cond else F.lit(0)


def fit(counts: DataFrame, labels: DataFrame, sample: int = 20_000, id_col: str = "doc_id", label_col: str = "quality", **options) -> list[Rule]:
    """A decision list from labels (1 keep, 0 reject) and features of the labelled rows.

    At most ``sample`` labelled rows are used, those with the smallest hash
    of the id, so that the driver holds a bounded number of feature rows.
    Rows with a null label or that fail the base rules don't take part.
    """
    lab = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("lab_id")).agg(F.min(label_col).alias("lab"))
    lab = lab.orderBy(F.xxhash64("lab_id"), "lab_id").limit(sample)
    rows = counts.where(~F.col("base_failed")).join(lab, F.col("doc_id") == F.col("lab_id")) \
        .select(*[F.expr(e).cast("double").alias(n) for n, e in FEATURES.items()], (F.col("lab") == 0).alias("bad"), F.pmod(F.xxhash64("doc_id", F.lit("split")), F.lit(3)).alias("part")) \
        .limit(2 * sample).toPandas()
    if not len(rows):
        return []
    names = list(FEATURES)
    return learn(rows[names].to_numpy(float), rows["bad"].to_numpy(bool), rows["part"].to_numpy(int), names, **options)


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), **options) -> DataFrame:
    """COUNTS, base_failed, fired (rule number or 0) and kept for each row of ``docs``.

    Null and empty texts count no words and fail the base rules. Without
    usable labels the list is empty and every row that passes the base rules
    is kept. Repeated rows are judged alike; an empty table gives an empty
    result. Columns not named are not read, so their names can't clash.
    """
    scratch = Scratch(docs.sparkSession, "rules")
    counts = scratch.cut(count_features(docs, id_col, text_col, carry), "counts")
    rules = fit(counts, labels, **options)
    return counts.withColumn("fired", rule_expression(rules)).withColumn("kept", ~F.col("base_failed") & (F.col("fired") == 0))


def kept_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are kept; judged are narrow rows, so texts are only read."""
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("th"))
    judged = judge(narrow, labels, "id", carry=("th",), **options)
    gone = judged.where("not kept").select(F.col("doc_id").alias("gone_id"), F.col("carry_th").alias("gone_text")).distinct()
    gone = Scratch(docs.sparkSession, "rules-gone").cut(gone, "gone")
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("own_id"), F.xxhash64(text_col).alias("own_text"))
    return rows.join(sized(gone, 32), F.col("own_id").eqNullSafe(F.col("gone_id")) & (F.col("own_text") == F.col("gone_text")), "left_anti").select("row.*")
