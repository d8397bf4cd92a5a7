"""The column functions that have a name in SQL, as temporary functions of a session."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ledgerloom.functions.codes import GROWTH_BOARD_FIRST, GROWTH_BOARD_LAST
from ledgerloom.functions.text import BLANKS, OPINION_PATTERNS


def _literal(text: str) -> str:
    """A SQL string literal; a raw one keeps the backslashes of a pattern."""
    if "'" in text:
        raise ValueError(f"no quotes in patterns: {text}")
    return f"r'{text}'"


def statements(patterns: dict[str, str] | None = None) -> dict[str, str]:
    """``CREATE`` statement of each function by name, in the order they need each other.

    All are expressions of built-in functions, which the optimizer sees through.
    """
    patterns = patterns or OPINION_PATTERNS
    kind = ", ".join(f"{name}: INT" for name in patterns)
    bodies = {
        "fold_text(text STRING) RETURNS STRING":
            f"lower(regexp_replace(text, {_literal(f'[{BLANKS}]+')}, ' '))",
        f"flag_opinion(text STRING) RETURNS STRUCT<{kind}>":
            # The folded text is worked out once for all patterns.
            f"transform(array(fold_text(text)), t -> named_struct({_named(patterns)}))[0]",
        "report_date(name STRING) RETURNS STRING":
            "regexp_replace(regexp_extract(name, '([0-9]{8})', 1), '^(....)(..)(..)$', '$1-$2-$3')",
        "market_class(code BIGINT) RETURNS STRING":
            f"CASE WHEN code BETWEEN {GROWTH_BOARD_FIRST} AND {GROWTH_BOARD_LAST} THEN 'GEM' ELSE 'SEHK' END",
        "is_unclear(qualified INT, adverse INT, disclaimer INT) RETURNS INT":
            "CAST(coalesce(qualified, 0) + coalesce(adverse, 0) + coalesce(disclaimer, 0) <> 1 AS INT)",
    }
    return {
        head.partition("(")[0]: f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}"
        for head, body in bodies.items()
    }


def _named(patterns: dict[str, str]) -> str:
    return ", ".join(
        f"'{name}', CAST(t RLIKE {_literal(pattern)} AS INT)" for name, pattern in patterns.items()
    )


def register_functions(spark: SparkSession, patterns: dict[str, str] | None = None) -> list[str]:
    """Make the functions known to the session's SQL; returns their names."""
    made = statements(patterns)
    for statement in made.values():
        spark.sql(statement)
    return list(made)
