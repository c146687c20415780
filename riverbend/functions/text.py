"""String functions with the reference's (Java) semantics, as Spark expressions.

All of these are plain Catalyst expressions: they stay inside whole-stage
codegen and never leave the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The regular expressions the reference tokenizes with.
# Java's \s is [ \t\n\x0B\f\r]; spelt out so that every regex engine
# (Java for Spark, RE2 for the DuckDB oracle) reads the same class.
NON_WORD = r"\W+"
WHITESPACE_RUN = r"[ \t\n\x0B\f\r]+"
WHITESPACE_ONE = r"[ \t\n\x0B\f\r]"
COMMA = ","
WHITESPACE_CHARS = " \t\n\x0b\f\r"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _strip_trailing(c: Column, pattern: str) -> Column:
    """Remove the run of delimiters at the very end of ``c`` (generic case;
    ``\\z``, not ``$``, which also matches before a final line break)."""
    return F.regexp_replace(c, f"(?:{pattern})+\\z", "")


def _is_run(pattern: str) -> bool:
    return pattern.endswith("+") and not pattern.endswith("\\+")


def java_split(col: str | Column, pattern: str) -> Column:
    """``String.split(pattern)`` as Java does it (limit 0).

    Spark's ``split`` keeps trailing empty strings; Java drops them, keeps
    leading and inner ones, maps ``""`` to ``[""]`` and a string made only of
    delimiters to ``[]``. Exact fast forms, all plain expressions:

    * whitespace: the trailing run is removed with ``rtrim`` (a character-set
      trim, no regex), then the regex split;
    * a run pattern (``\\W+``): consecutive delimiters are one match, so a
      trailing run leaves exactly one trailing ``""`` (two, ``["", ""]``,
      when the string is only delimiters); it is dropped after the split
      instead of a second regex pass over the text;
    * anything else: strip the trailing delimiter run, then split.
    """
    c = _c(col)
    if pattern in (WHITESPACE_RUN, WHITESPACE_ONE):
        trimmed = F.rtrim(c, F.lit(WHITESPACE_CHARS))
        return (F.when(c == "", F.array(F.lit("")))
                .when(trimmed == "", F.array().cast("array<string>"))
                .otherwise(F.split(trimmed, pattern, -1)))
    if _is_run(pattern):
        parts = F.split(c, pattern, -1)
        n = F.size(parts)
        last_empty = F.element_at(parts, -1) == ""
        return (F.when(c == "", F.array(F.lit("")))
                .when(last_empty & (n == 2) & (F.element_at(parts, 1) == ""),
                      F.array().cast("array<string>"))
                .when(last_empty, F.slice(parts, 1, n - 1))
                .otherwise(parts))
    stripped = _strip_trailing(c, pattern)
    return (
        F.when(c == "", F.array(F.lit("")))
        .when(stripped == "", F.array().cast("array<string>"))
        .otherwise(F.split(stripped, pattern, -1))
    )


def text_lines(df: DataFrame, text_col: str, *, line_col: str = "line",
               pos_col: str = "line_no") -> DataFrame:
    """One row per line, as a line-delimited text source would read it.

    Lines end at ``\\n`` with an optional ``\\r`` before it; a final line
    terminator does not open an empty last line; an empty text has no lines.
    Only literal (non-regex) string operations are used: ``\\r\\n`` is
    folded to ``\\n`` and the split on a single literal character takes
    Java's non-regex fast path.
    """
    c = F.replace(F.col(text_col), F.lit("\r\n"), F.lit("\n"))
    body = F.when(F.endswith(c, F.lit("\n")), c.substr(F.lit(1), F.length(c) - 1)).otherwise(c)
    parts = F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(body, "\n", -1))
    return df.select(
        *[x for x in df.columns if x != text_col],
        F.posexplode(parts).alias(pos_col, line_col),
    )


def tokenize(df: DataFrame, text_col: str, pattern: str, *, lower: bool = False,
             drop_empty: bool = False, token_col: str = "word",
             keep: list[str] | None = None) -> DataFrame:
    """FlatMap a text column into one row per token (Java split semantics).

    ``lower`` and ``drop_empty`` give the batch word-count tokenizer;
    without them empty tokens are kept exactly as Java emits them.
    """
    c = F.lower(F.col(text_col)) if lower else F.col(text_col)
    keep = keep if keep is not None else []
    if drop_empty:
        # Empties are filtered anyway, so Spark's own split is enough.
        out = df.select(*keep, F.explode(F.split(c, pattern, -1)).alias(token_col))
        return out.where(F.length(token_col) > 0)
    return df.select(*keep, F.explode(java_split(c, pattern)).alias(token_col))


def parse_tuple_text(col: str | Column, fields: list[tuple[str, str]]) -> Column:
    """Parse ``(a,b,c,...)`` text: strip the first and last character, split
    on ``,`` and cast each field; ANSI casts raise on malformed input."""
    c = _c(col)
    inner = c.substr(F.lit(2), F.length(c) - F.lit(2))
    parts = F.split(inner, COMMA, -1)
    return F.struct(*[
        parts.getItem(i).cast(t).alias(n) for i, (n, t) in enumerate(fields)
    ])


def try_parse_tuple_text(col: str | Column, fields: list[tuple[str, str]]) -> Column:
    """``parse_tuple_text`` that gives null for a line with too few fields or a field that is not
    of its type."""
    c = _c(col)
    parts = F.split(c.substr(F.lit(2), F.length(c) - F.lit(2)), COMMA, -1)
    found = [F.get(parts, F.lit(i)).try_cast(t).alias(n) for i, (n, t) in enumerate(fields)]
    sound = F.lit(True)
    for f in found:
        sound = sound & f.isNotNull()
    return F.when(sound, F.struct(*found))


def format_tuple(*cols: str | Column) -> Column:
    """Render columns the way a Java tuple prints: ``(a,b,c)``, a null as ``null``."""
    fields = [F.coalesce(_c(x).cast("string"), F.lit("null")) for x in cols]
    return F.concat(F.lit("("), F.concat_ws(",", *fields), F.lit(")"))


def parse_key_millis(col: str | Column) -> Column:
    """``key,millis`` line into ``struct<key string, ts_ms bigint>``."""
    parts = F.split(_c(col), COMMA, -1)
    return F.struct(parts.getItem(0).alias("key"),
                    parts.getItem(1).cast("bigint").alias("ts_ms"))

