"""VARIANT helpers for schema-less feed JSON (Python-like truthiness).

Feed messages are parsed once with ``try_parse_json`` (malformed -> NULL)
and navigated with ``try_variant_get``.  Alias chains such as
``a or b or c`` need the JSON *kind* of each value: number ``0``, ``""``,
``false``, ``null``, ``[]`` and ``{}`` are falsy, the string ``"0"`` is not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketfold.functions.exprs import coerce_float as coerce_float_text
from marketfold.functions.exprs import strip_ws

_NUMERIC = ("TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE")


def field(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def vtype(v: Column) -> Column:
    return F.schema_of_variant(v)


def is_object(v: Column) -> Column:
    return F.coalesce(vtype(v).startswith("OBJECT"), F.lit(False))


def is_array(v: Column) -> Column:
    return F.coalesce(vtype(v).startswith("ARRAY"), F.lit(False))


def is_string(v: Column) -> Column:
    return F.coalesce(vtype(v) == "STRING", F.lit(False))


def as_array(v: Column) -> Column:
    """ARRAY<VARIANT> when ``v`` is a JSON list, else NULL.  Tried outright: the
    kind of a list (``vtype``) would walk everything in it."""
    return F.try_variant_get(v, "$", "array<variant>")


def truthy(v: Column) -> Column:
    t = vtype(v)
    return (F.when(v.isNull() | (t == "VOID"), F.lit(False))
             .when(t == "STRING", F.try_variant_get(v, "$", "string") != "")
             .when(t == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
             .when(t.startswith("ARRAY"), F.size(F.try_variant_get(v, "$", "array<variant>")) > 0)
             .when(t.startswith("OBJECT"), t != "OBJECT<>")
             .otherwise(F.coalesce(F.try_variant_get(v, "$", "double") != 0, F.lit(False))))


def first_truthy(v: Column, *paths: str) -> Column:
    """``obj.get(a) or obj.get(b) or obj.get(c)``: the first truthy value,
    else the last alternative as it is (Python ``or`` semantics)."""
    out = field(v, paths[-1])
    for p in reversed(paths[:-1]):
        f = field(v, p)
        out = F.when(truthy(f), f).otherwise(out)
    return out


def to_float(v: Column) -> Column:
    """``float(x)``: numbers as is, text parsed (Python rules), bools 1/0."""
    t = vtype(v)
    return (F.when(t == "STRING", coerce_float_text(F.try_variant_get(v, "$", "string")))
             .when(t == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("double"))
             .when(t.isin(*_NUMERIC) | t.startswith("DECIMAL"), F.try_variant_get(v, "$", "double")))


def to_text(v: Column) -> Column:
    """``str(x or "")``: scalar text, empty when missing/falsy."""
    return F.when(truthy(v), F.try_variant_get(v, "$", "string")).otherwise(F.lit(""))


# --- column-materialising API (hot paths) ------------------------------------
# ``extract`` adds one VARIANT column and one kind column per JSON path, so
# every path is navigated and typed once per row; the pair helpers below
# then only compare plain columns (no repeated JSON work, codegen-friendly).

def extract(df, src: str, paths: dict[str, str]):
    """Add per path: ``n`` (VARIANT), ``n__t`` (kind) and ``n__ok``
    (Python truthiness), each computed once per row."""
    df = df.select("*", *[F.try_variant_get(F.col(src), p, "variant").alias(n) for n, p in paths.items()])
    df = df.select("*", *[vtype(F.col(n)).alias(f"{n}__t") for n in paths])
    return df.select("*", *[_truthy_ft(F.col(n), F.col(f"{n}__t")).alias(f"{n}__ok") for n in paths])


def _truthy_ft(f: Column, t: Column) -> Column:
    return (F.when(f.isNull() | t.isNull() | (t == "VOID"), F.lit(False))
             .when(t == "STRING", F.try_variant_get(f, "$", "string") != "")
             .when(t == "BOOLEAN", F.try_variant_get(f, "$", "boolean"))
             .when(t.startswith("ARRAY"), F.size(F.try_variant_get(f, "$", "array<variant>")) > 0)
             .when(t.startswith("OBJECT"), t != "OBJECT<>")
             .otherwise(F.coalesce(F.try_variant_get(f, "$", "double") != 0, F.lit(False))))


def pair(name: str) -> tuple[Column, Column, Column]:
    return F.col(name), F.col(f"{name}__t"), F.col(f"{name}__ok")


def p_first(*pairs) -> tuple[Column, Column, Column]:
    """Python ``a or b or c`` over extracted pairs -> (value, kind, truthy).
    Conditions are the precomputed truthiness columns, so the CASE chains
    stay small however often the result is referenced."""
    f, t = pairs[-1][0], pairs[-1][1]
    for pf, pt, pok in reversed(pairs[:-1]):
        f, t = F.when(pok, pf).otherwise(f), F.when(pok, pt).otherwise(t)
    ok = pairs[0][2]
    for p in pairs[1:]:
        ok = ok | p[2]
    return f, t, ok


def p_float(p) -> Column:
    f, t = p[0], p[1]
    return (F.when(t == "STRING", coerce_float_text(F.try_variant_get(f, "$", "string")))
             .when(t == "BOOLEAN", F.try_variant_get(f, "$", "boolean").cast("double"))
             .when(t.isin(*_NUMERIC) | t.startswith("DECIMAL"), F.try_variant_get(f, "$", "double")))


def p_text(p) -> Column:
    return F.when(p[2], F.try_variant_get(p[0], "$", "string")).otherwise(F.lit(""))


def p_norm(p, upper: bool = False) -> Column:
    s = strip_ws(p_text(p))
    return F.upper(s) if upper else F.lower(s)


def p_array(p) -> Column:
    return as_array(p[0])


# --- plan fences ---------------------------------------------------------------
# Catalyst pushes filters (including join-inferred IS NOT NULL filters)
# below projections by substituting the projected expressions; for JSON
# extraction chains that would re-evaluate the parse inside the filter and
# blow up plan and generated-code size.  A filter that also references a
# non-deterministic marker column computed right below it cannot be pushed
# through that projection, so the expensive columns are computed once.

def fenced_filter(df, cond: Column):
    return (df.withColumn("_fence", F.spark_partition_id())
              .filter(cond & (F.col("_fence") >= 0)).drop("_fence"))
