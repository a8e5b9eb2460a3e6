"""Text rules: blank handling, code hierarchies and code-pattern descriptors."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The regular expression suggested for each class of code pattern.
MULTI_SEMICOLON = r"[\d\-\/\s]+(?:;[\d\-\/\s]+)+"
MULTI_COMMA = r"[\d\-\/\s]+(?:,[\d\-\/\s]+)+"
HYPHEN_AND_SLASH = r"\d+[\-\/]\d+[\-\/]\d+"
HYPHEN = r"\d+\-\d+\-\d+"
SLASH = r"\d+\/\d+\/\d+"
SPACE = r"\d+\s+\d+\s+\d+"
DIGITS = r"\d+"


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def text_to_double(text: Column) -> Column:
    """Padded number text to DOUBLE; blank or unreadable text to NULL."""
    return blank_to_null(text).try_cast("double")


def level_before_dash(code: Column) -> Column:
    """Part of a code before its first dash, the whole code if it has none."""
    return F.split_part(code, F.lit("-"), F.lit(1))


def first_letter(code: Column) -> Column:
    return F.substring(code, 1, 1)


def split_parts(text: Column, delimiter: Column) -> Column:
    """Trimmed parts of a delimited value."""
    return F.transform(F.split(text, delimiter), lambda p: F.regexp_replace(p, r"^\s+|\s+$", ""))


def list_delimiter(text: Column) -> Column:
    """``;`` or ``,`` for a multi-value text, NULL for a single value."""
    return F.when(text.contains(";"), F.lit(";")).when(text.contains(","), F.lit(","))


def split_longlist(text: Column) -> Column:
    return F.coalesce(split_parts(text, list_delimiter(text)), F.array(text))


def digit_mask(text: Column) -> Column:
    return F.regexp_replace(text, r"\p{Nd}", "D")


def _quoted(char: Column) -> Column:
    return (
        F.when(char == "'", F.lit("\"'\""))
        .when(char == "\\", F.lit("'\\\\'"))
        .otherwise(F.concat(F.lit("'"), char, F.lit("'")))
    )


def code_pattern(text: Column) -> Column:
    """One-line descriptor: digit mask, special-character counts, lengths of listed parts."""
    value = F.coalesce(text.cast("string"), F.lit("NA"))
    specials = F.regexp_extract_all(value, F.lit(r"(?U)([^a-zA-Z0-9\s])"), F.lit(1))
    counts = F.array_join(
        F.transform(
            F.array_distinct(specials),
            lambda ch: F.concat(
                _quoted(ch), F.lit(": "), F.size(F.filter(specials, lambda c: c == ch)).cast("string")
            ),
        ),
        ", ",
    )
    delimiter = list_delimiter(value)
    lengths = F.array_join(
        F.transform(split_parts(value, delimiter), lambda p: F.length(p).cast("string")), ", "
    )
    return F.concat(
        F.lit("Pattern: "),
        digit_mask(value),
        F.when(F.size(specials) > 0, F.concat(F.lit(" | Special chars: {"), counts, F.lit("}"))).otherwise(""),
        F.when(
            delimiter.isNotNull(),
            F.concat(F.lit(" | Multiple values with lengths: ["), lengths, F.lit("]")),
        ).otherwise(""),
    )


def suggested_regex(pattern: Column, compat: bool = False) -> Column:
    """Regular expression class for a descriptor from :func:`code_pattern`.

    The descriptor's own label holds a space, so testing it whole can never reach the
    digits-only class. By default the test looks at the digit mask; ``compat=True``
    keeps the literal rule.
    """
    several = pattern.contains("Multiple values")
    body = pattern if compat else F.split_part(F.substring(pattern, 10, 2**31 - 1), F.lit(" | "), F.lit(1))
    return (
        F.when(several & body.contains(";"), F.lit(MULTI_SEMICOLON))
        .when(several & body.contains(","), F.lit(MULTI_COMMA))
        .when(several, F.lit(""))
        .when(body.contains("-") & body.contains("/"), F.lit(HYPHEN_AND_SLASH))
        .when(body.contains("-"), F.lit(HYPHEN))
        .when(body.contains("/"), F.lit(SLASH))
        .when(body.contains(" "), F.lit(SPACE))
        .otherwise(F.lit(DIGITS))
    )
