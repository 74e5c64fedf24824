"""Text cleansing."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed import WORD_BREAKS

# A private-use character that cannot occur in business text.
_MARK = "\ue000 "


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c: Column | str) -> Column:
    return F.trim(_col(c))


def upper_clean(c: Column | str) -> Column:
    return F.upper(F.trim(_col(c)))


def lower_clean(c: Column | str) -> Column:
    return F.lower(F.trim(_col(c)))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(F.trim(_col(c)), F.lit(""))


def join_name(c: Column | str) -> Column:
    """The form in which names are compared across feeds."""
    return upper_clean(c)


def initcap_wide(c: Column | str) -> Column:
    """Capitalise after blanks *and* punctuation.

    Spark's ``initcap`` starts a word after a blank only, so a marker with a
    blank goes in behind each other break and comes out again afterwards. All
    three steps stay inside generated code, unlike a split and ``transform``.
    """
    spaced = F.regexp_replace(_col(c), f"({WORD_BREAKS})", f"$1{_MARK}")
    return F.replace(F.initcap(spaced), F.lit(_MARK), F.lit(""))
