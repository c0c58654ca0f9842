"""MAP1-7: code-to-label mapping.

Semantics kept apart:
* a listed code maps to its label;
* an *unlisted* code maps to null;
* a *null* code maps to the field's null label ("Missing",
  "Not Applicable") when the field has one, else stays null.

Each field becomes one literal-map lookup inside the projection, so a
table of 58 coded fields is still one ``Project`` in one codegen stage
and needs no join. ``codebook_frame`` gives the same content as a small
DataFrame (field, code, label, ordinal) for profiles and for the
broadcast-join form used when a map is too large for a literal.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path
from typing import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATA_DIR = Path(__file__).resolve().parent.parent / "data"

# A literal map larger than this is applied as a broadcast join instead.
LITERAL_MAP_LIMIT = 4096


@dataclass(frozen=True)
class FieldMap:
    """Ordered code -> label map of one field."""
    codes: tuple  # ((code, label), ...) in category order
    null_label: str | None = None
    has_null_label: bool = False

    @property
    def labels(self) -> list[str]:
        out = [lab for _, lab in self.codes]
        return out

    @property
    def key_type(self) -> str:
        return "string" if any(isinstance(c, str) for c, _ in self.codes) else "int"

    def categories(self) -> list[str]:
        """Category order: listed labels (dedup, first kept) then the null label."""
        seen, out = set(), []
        for lab in self.labels + ([self.null_label] if self.null_label else []):
            if lab is not None and lab not in seen:
                seen.add(lab)
                out.append(lab)
        return out


def _label(v) -> str | None:
    return None if v is None else str(v)


def field_map(entries: Iterable, null_label: str | None = None, has_null_label: bool | None = None) -> FieldMap:
    """Build a FieldMap from ``[(code, label), ...]`` and ``{"count_range": [lo, hi]}`` rules.

    A count range ``[lo, hi]`` expands to codes lo..hi-1 labelled by their
    own number (MAP3); labels are stringified (MAP4).
    """
    codes = []
    for e in entries:
        if isinstance(e, Mapping) and "count_range" in e:
            lo, hi = e["count_range"]
            codes.extend((k, str(k)) for k in range(lo, hi))
        else:
            k, v = e
            codes.append((k, _label(v)))
    hn = (null_label is not None) if has_null_label is None else has_null_label
    return FieldMap(tuple(codes), null_label, hn)


@dataclass
class Codebook:
    fields: dict = field(default_factory=dict)  # name -> FieldMap

    def __getitem__(self, k) -> FieldMap:
        return self.fields[k]

    def __contains__(self, k) -> bool:
        return k in self.fields

    def __iter__(self):
        return iter(self.fields)

    @property
    def n_codes(self) -> int:
        return sum(len(f.codes) for f in self.fields.values())

    @classmethod
    def from_spec(cls, spec: Mapping) -> "Codebook":
        out = {}
        for name, m in spec.items():
            out[name] = field_map(m["codes"], m.get("null_label"), "null_label" in m)
        return cls(out)

    def subset(self, names: Iterable[str]) -> "Codebook":
        return Codebook({n: self.fields[n] for n in names})


def load_spec(dataset: str) -> dict:
    with open(DATA_DIR / f"{dataset}.json", encoding="utf-8") as fh:
        return json.load(fh)


def load_codebook(dataset: str) -> Codebook:
    return Codebook.from_spec(load_spec(dataset)["codebook"])


def sql_literal(v) -> str:
    """SQL text of a literal (strings escaped for the Spark SQL parser)."""
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(v)


def map_sql(name: str, fmap: FieldMap) -> str:
    """MAP1/MAP2 as SQL text: one literal map (constant-folded) and a lookup."""
    kt = fmap.key_type.upper()
    col = f"`{name}`"
    if fmap.codes:
        pairs = ", ".join(f"CAST({sql_literal(k)} AS {kt}), {sql_literal(v)}" for k, v in fmap.codes)
        # a value that isn't a code in its own type (1.7, 3000000000) is unlisted
        key = col if kt == "STRING" else f"CASE WHEN TRY_CAST({col} AS {kt}) = {col} THEN TRY_CAST({col} AS {kt}) END"
        looked = f"try_element_at(map({pairs}), CAST({key} AS {kt}))"
    else:
        looked = "CAST(NULL AS STRING)"
    if fmap.has_null_label:
        return f"CASE WHEN {col} IS NULL THEN {sql_literal(fmap.null_label)} ELSE {looked} END"
    return looked


def map_expr(c, fmap: FieldMap) -> Column:
    """MAP1/MAP2 as a column expression (literal map lookup).

    A column *name* is compiled from SQL text in a single call; a Column
    is composed with the DataFrame API.
    """
    if isinstance(c, str):
        return F.expr(map_sql(c, fmap))
    col = c
    whole = col.try_cast(fmap.key_type)
    key = col.cast("string") if fmap.key_type == "string" else F.when(whole == col, whole)
    flat = []
    for code, lab in fmap.codes:
        flat += [F.lit(code).cast(fmap.key_type), F.lit(lab).cast("string")]
    looked = F.try_element_at(F.create_map(*flat), key) if flat else F.lit(None).cast("string")
    if fmap.has_null_label:
        return F.when(col.isNull(), F.lit(fmap.null_label).cast("string")).otherwise(looked)
    return looked


def apply_codebook(df: DataFrame, codebook: Codebook, fields: Iterable[str] | None = None) -> DataFrame:
    """Map every coded field present in ``df`` in one projection."""
    names = [f for f in (fields or codebook) if f in df.columns]
    small = {f: map_expr(f, codebook[f]) for f in names if len(codebook[f].codes) <= LITERAL_MAP_LIMIT}
    out = df.withColumns(small) if small else df
    for f in names:
        if f not in small:
            out = map_codes_join(out, f, codebook[f])
    return out


def codebook_frame(spark: SparkSession, codebook: Codebook) -> DataFrame:
    """(field, code, label, ordinal) rows; code as text so int and text keys share a column."""
    rows = []
    for name, fmap in codebook.fields.items():
        for i, (code, lab) in enumerate(fmap.codes):
            rows.append((name, str(code), lab, i))
    schema = T.StructType([T.StructField("field", T.StringType(), False),
                           T.StructField("code", T.StringType(), False),
                           T.StructField("label", T.StringType(), True),
                           T.StructField("ordinal", T.IntegerType(), False)])
    return spark.createDataFrame(rows, schema)


def map_codes_join(df: DataFrame, c: str, fmap: FieldMap) -> DataFrame:
    """MAP1 broadcast-join form for a very large map.

    The map side is driver data of a known number of rows (its size is
    proven before it is broadcast), so the fact side never shuffles.
    """
    spark = df.sparkSession
    kt = fmap.key_type
    m = spark.createDataFrame([(k, lab) for k, lab in fmap.codes],
                              T.StructType([T.StructField("__code", T.StringType() if kt == "string" else T.IntegerType()),
                                            T.StructField("__label", T.StringType())]))
    key = F.col(c).cast("string") if kt == "string" else F.when(F.col(c).try_cast(kt) == F.col(c), F.col(c).try_cast(kt))
    joined = df.join(F.broadcast(m), key == F.col("__code"), "left")
    lab = F.col("__label")
    if fmap.has_null_label:
        lab = F.when(F.col(c).isNull(), F.lit(fmap.null_label)).otherwise(lab)
    return joined.withColumn(c, lab).drop("__code", "__label")


def topcode_map(lo: int, top: int, top_label: str | None = None, null_label: str | None = None,
                extra: Iterable = ()) -> FieldMap:
    """MAP3 rule: codes lo..top-1 labelled by number, ``top`` labelled ``"top+"``."""
    entries = [{"count_range": [lo, top]}, (top, top_label or f"{top}+"), *extra]
    return field_map(entries, null_label)
