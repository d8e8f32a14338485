"""Text functions: the word splitting of the word-count analysis.

The reference lower-cases a line and splits it on runs of non-word characters
with the JDK's ``String.split``.  That split has three rules Spark's ``split``
does not share (Spark keeps trailing empty pieces):

* an empty line gives one empty word ``[""]``;
* a leading empty piece is kept (``" a"`` -> ``["", "a"]``);
* trailing empty pieces are dropped (``"a!"`` -> ``["a"]``, ``"!!!"`` -> ``[]``).

``\\W`` is ASCII-only in Java's regex (Spark uses it), so ``"chào"`` splits
into ``ch`` and ``o`` -- the reference does the same.

Everything here is built from JVM-side expressions, so it stays inside
whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the separator pattern of the reference's word split.
WORD_SEPARATOR = r"\W+"
# Option: letters and digits of every script are word characters.
UNICODE_WORD_SEPARATOR = r"(?U)\W+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(line, separator: str = WORD_SEPARATOR, lower: bool = True) -> Column:
    """Words of ``line`` with the JDK split semantics above, as ``array<string>``.

    One regex pass: Spark's split keeps at most one trailing empty piece here
    (runs of separators are one match), so dropping it -- and turning a lone
    leftover ``""`` of an all-separator line into ``[]`` -- gives the JDK result.
    A null line gives null (no words).
    """
    s = F.lower(_col(line)) if lower else _col(line)
    parts = F.split(s, separator, -1)
    n = F.size(parts)
    trimmed = F.when(F.element_at(parts, -1) == F.lit(""), F.slice(parts, 1, n - 1)).otherwise(parts)
    return (
        F.when(s == F.lit(""), F.array(F.lit("")))
        .when((F.size(trimmed) == 1) & (F.element_at(trimmed, 1) == F.lit("")), F.array().cast("array<string>"))
        .otherwise(trimmed)
    )


def _fix_pieces(s: Column, parts: Column) -> Column:
    n = F.size(parts)
    trimmed = F.when(F.element_at(parts, -1) == F.lit(""), F.slice(parts, 1, n - 1)).otherwise(parts)
    return (
        F.when(s == F.lit(""), F.array(F.lit("")))
        .when((F.size(trimmed) == 1) & (F.element_at(trimmed, 1) == F.lit("")), F.array().cast("array<string>"))
        .otherwise(trimmed)
    )


def with_tokens(df: DataFrame, line: str, out: str = "tokens", keep=(), separator: str = WORD_SEPARATOR,
                lower: bool = True) -> DataFrame:
    """``df`` projected to ``keep`` columns plus ``out`` = :func:`tokens` of ``line``.

    Same result as ``tokens()``, planned in two projections so the regex split
    runs once per line: in one expression Spark re-evaluates the split inside
    each CASE branch that uses it.
    """
    s = F.lower(F.col(line)) if lower else F.col(line)
    staged = df.select(*keep, s.alias("_s"), F.split(s, separator, -1).alias("_parts"))
    return staged.select(*keep, _fix_pieces(F.col("_s"), F.col("_parts")).alias(out))
