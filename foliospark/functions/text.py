"""Text functions as columns. Blanks and word characters are those of Unicode; offsets are code points."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The markers of emphasis that texts lose, and the typography of a heading.
EMPHASIS = r"(?U)\*{1,3}|(?<!\w)_{1,3}|_{1,3}(?!\w)"
HEADING = r"(?U)^\s*#+\s*"


def _normal_form(form: str):
    def convert(column: pa.Array) -> pa.Array:
        return pa.array([None if t is None else unicodedata.normalize(form, t) for t in column.to_pylist()], type=pa.string())

    return F.arrow_udf(convert, "string")


def normal_form(c: Column, form: str = "NFC") -> Column:
    """Unicode normal form. Only texts with characters beyond ASCII go to Python."""
    other = F.when(c.rlike(r"[^\x00-\x7F]"), c)
    return F.coalesce(_normal_form(form)(other), c)


def casefold(c: Column) -> Column:
    """Caseless form, in which a long s is an s, and a sharp one two. Only texts with characters beyond ASCII go to Python."""
    fold = F.arrow_udf(lambda column: pa.array([None if t is None else t.casefold() for t in column.to_pylist()], type=pa.string()), "string")
    return F.coalesce(fold(F.when(c.rlike(r"[^\x00-\x7F]"), c)), F.lower(c))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    """Runs of blanks as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def unaccented(c: Column) -> Column:
    """Letters without combining marks."""
    return F.regexp_replace(normal_form(c, "NFD"), r"\p{Mn}", "")


def without_emphasis(c: Column) -> Column:
    return strip(F.regexp_replace(c, EMPHASIS, ""))


def title_level(c: Column) -> Column:
    """Number of # in front of a title, null without."""
    level = F.length(F.regexp_extract(c, r"(?U)^\s*(#+)", 1))
    return F.when(level > 0, level)


def title_text(c: Column) -> Column:
    """A title without # or emphasis."""
    return squeeze(without_emphasis(F.regexp_replace(F.regexp_replace(c, r"(?U)^\s+", ""), r"^#+", "")))


def title_key(c: Column) -> Column:
    """What titles of two editions are compared by: no accents, signs or case."""
    return F.lower(squeeze(F.regexp_replace(unaccented(title_text(c)), r"(?U)[\W_]+", " ")))


def alphabet_key(c: Column, words: int = 2, length: int = 5) -> Column:
    """The place in an alphabetical list: the first words before a comma, plain capitals, cut short."""
    plain = F.upper(F.regexp_replace(normal_form(F.substring_index(c, ",", 1), "NFKD"), r"[^\x00-\x7F]", ""))
    return F.substring(F.array_join(F.slice(F.regexp_extract_all(plain, F.lit("([A-Z0-9]+)"), 1), 1, words), ""), 1, length)


def heading_class(line: Column, previous: Column) -> Column:
    """A guess of a line's class from its typography: a start for annotation, never a truth."""
    told = lambda x: (
        F.when(strip(line).startswith("#"), "B-TITLE")
        .when((x["plain"] == "") | x["plain"].rlike("^[-—_]{3,}$"), "OUT OF SCOPE")
        .when(x["plain"].rlike(r"^[\p{Ll}\-—]"), "I-ENTRY")
        .when(x["before"].rlike("[-—]$"), "I-ENTRY")
        .otherwise("B-ENTRY")
    )
    # through an array of one, so that each plain text is made once
    return F.transform(F.array(F.struct(F.trim(plain_line(line)).alias("plain"), plain_line(previous).alias("before"))), told)[0]


def plain_line(line: Column) -> Column:
    """A line without heading signs, emphasis and blanks at its end."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(F.coalesce(line, F.lit("")), HEADING, ""), EMPHASIS, ""), r"(?U)\s+$", "")


def excerpt(c: Column, length: int = 40) -> Column:
    clean = squeeze(c)
    return F.when(F.length(clean) > length, F.concat(F.substring(clean, 1, length - 1), F.lit("…"))).otherwise(clean)


def decimal_comma(c: Column, digits: int = 2) -> Column:
    """A number as it stands in tables: decimal comma, empty for null."""
    return F.coalesce(F.translate(F.format_number(c, digits), ",.", " ,"), F.lit(""))


def comma_number(c: Column) -> Column:
    return F.translate(c, ",", ".").cast("double")
