"""Native-column helpers: thresholds, percentages, type-aware predicates."""

from qualia.functions.predicates import (  # noqa: F401
    RuleError,
    as_assertion,
    check_rules,
    compare,
    eq,
    format_check,
    ge,
    gt,
    le,
    lt,
    matches,
    parse_slo,
    pct_half_up,
    ratio,
    slo_parts,
)
