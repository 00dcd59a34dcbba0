"""Column-level building blocks: every function returns a ``Column``."""

from kpiloom.functions.cleaning import (  # noqa: F401
    is_test_account,
    map_vocab,
    normalize_email,
    proper_case,
    to_cents,
    tolerant_int,
    try_to_cents,
    vocab_key,
)
from kpiloom.functions.numeric import cents_to_amount, ratio, round_half_away  # noqa: F401
from kpiloom.functions.dates import month_of, month_range  # noqa: F401
