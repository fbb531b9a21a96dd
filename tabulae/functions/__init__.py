from tabulae.functions.scalars import (  # noqa: F401
    band_label, canonical_code, code_order, compound_duration, correlation_strength,
    is_finite, label_of, level_word, log10_positive, pow10, profile_name, residual,
    safe_div, skew_verdict, thousands, to_double, to_int, validate_code,
)
