"""Text cleaning as Column expressions (all JVM-side, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kpiloom.functions.vocabulary import TEST_EMAIL_SUFFIX, TEST_FIRST_NAME


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tolerant_int(c: Column | str) -> Column:
    """64-bit integer from text that may read '123', '123.0' or ' 12 '.

    Nullable integer columns pass through a float stage on their way into the
    raw layer, so both spellings occur in one column. Fractions round half
    away from zero ('1.5' -> 2), null stays null, anything unparseable raises
    (ANSI), exactly like a plain integer cast in the reference engine.
    """
    return F.round(F.trim(_c(c)).cast("decimal(38,6)"), 0).cast("bigint")


def _money_text(c: Column | str) -> Column:
    # '$1,234.50' -> '1234.50'; '$-179.00' -> '-179.00'
    return F.translate(F.trim(_c(c)), "$,", "")


def to_cents(c: Column | str) -> Column:
    """Money text to integer cents: trim, drop '$' and ',', decimal(14,2), x100.

    More than two decimals round half away from zero at the decimal cast.
    Text that is not a number ('' or '(12.00)') raises rather than vanishing.
    """
    return F.round(_money_text(c).cast("decimal(14,2)") * 100, 0).cast("bigint")


def try_to_cents(c: Column | str) -> Column:
    """Like :func:`to_cents` but null for unparseable text (for reports)."""
    return F.round(_money_text(c).try_cast("decimal(14,2)") * 100, 0).cast("bigint")


def normalize_email(c: Column | str) -> Column:
    """lower(trim(email)), empty string becomes null."""
    return F.nullif(F.lower(F.trim(_c(c))), F.lit(""))


def is_test_account(email: Column | str, first_name: Column | str,
                    suffix: str = TEST_EMAIL_SUFFIX, first: str = TEST_FIRST_NAME) -> Column:
    """Never-null test flag: e-mail in the test domain OR first name 'test'.

    The e-mail is trimmed and lowered, the first name only lowered. Each side
    is coalesced to false so that a missing e-mail cannot turn the flag null.
    """
    by_mail = F.coalesce(F.lower(F.trim(_c(email))).endswith(suffix), F.lit(False))
    by_name = F.coalesce(F.lower(_c(first_name)) == F.lit(first), F.lit(False))
    return by_mail | by_name


def vocab_key(c: Column | str, drop_chars: str = "- ") -> Column:
    """Matching key for a free-text category: trim, delete ``drop_chars``, lower."""
    out = F.trim(_c(c))
    if drop_chars:
        out = F.translate(out, drop_chars, "")
    return F.lower(out)


def map_vocab(key: Column | str, mapping: dict[str, list[str]]) -> Column:
    """Controlled vocabulary lookup as a CASE chain; unknown keys give null."""
    key = _c(key)
    out = None
    for value, spellings in mapping.items():
        cond = key.isin(spellings)
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    return out


def proper_case(c: Column | str) -> Column:
    """Lower-case, then upper-case the first letter of each space-separated word."""
    return F.initcap(_c(c))
