"""Column helpers (built-in Spark functions only)."""

from vartab.functions.columns import (  # noqa: F401
    attr_value, field, has_tag, int_field, key_parts, null_tokens, nullif_empty,
    paren_score, row_max, small_variant_type, strip_chr, strip_version, text_bool,
    variant_key,
)
from vartab.functions.consequences import CONSEQUENCE_TERMS, onehot_columns  # noqa: F401
