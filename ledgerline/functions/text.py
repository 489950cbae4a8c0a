"""Cleaning of free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space code points. Spark's own trim removes only the plain space.
WHITESPACE = "".join(
    map(
        chr,
        (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000),
    )
)

# Characters that end a word for title casing.
WORD_BREAKS = r"[\s\[\](){}/|\\<>!?@\"^#$&~_,.:;*%+\-]"

# A noncharacter, illegal in XML 1.0, so it cannot occur in a filing.
_MARK = "\uffff "


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(value: Column | str) -> Column:
    """Remove white space of any kind from both ends.

    Padding is mostly plain spaces, which the first trim removes much faster.
    """
    return F.btrim(F.trim(_column(value)), F.lit(WHITESPACE))


def strip_upper(value: Column | str) -> Column:
    return F.upper(strip(value))


def title_case(value: Column | str) -> Column:
    """Capitalise the first letter after white space *or punctuation*.

    ``initcap`` sees only spaces as word breaks. A marked space behind every
    break lets it do the work in generated code, without arrays or lambdas.
    """
    spaced = F.regexp_replace(_column(value), WORD_BREAKS, f"$0{_MARK}")
    return F.replace(F.initcap(spaced), F.lit(_MARK), F.lit(""))


def problem_of(xml: Column | str) -> Column:
    """Why a document gives no transaction: unreadable or blank; NULL if it may give some."""
    xml = _column(xml)
    return F.when(xml.isNull(), F.lit("unreadable")).when(F.ltrim(F.ltrim(xml), F.lit(WHITESPACE)) == "", F.lit("blank"))


def decode_utf8(content: Column | str) -> Column:
    """Bytes to text; invalid sequences become U+FFFD instead of failing the job."""
    return F.make_valid_utf8(_column(content).cast("string"))


def null_if_empty(value: Column) -> Column:
    return F.nullif(value, F.lit(""))
