from pawnshop.functions.scalar import (  # noqa: F401
    binary_label, outcome_flag, safe_cast, hash_unit, text_quality,
    clean_round,
)
