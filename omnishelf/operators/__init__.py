from omnishelf.operators.checks import (
    accepted_values,
    between,
    case_insensitive_unique,
    not_null,
    relationship,
    row_checks,
    unique,
    unique_combination,
)
from omnishelf.operators.dedupe import (
    first_per_key,
    keep_latest,
    latest_with_bounds,
    reduce_for_join,
)
from omnishelf.operators.lookup import attach, attach_creator_country, unique_lookup
from omnishelf.operators.matching import (
    attach_repeats,
    fold_histories,
    match_passes,
    numbered,
    outer_unify,
)
from omnishelf.operators.rollup import rollup_sources
from omnishelf.operators.tokens import label_texts, map_tokens

__all__ = [
    "accepted_values",
    "attach",
    "attach_creator_country",
    "attach_repeats",
    "between",
    "case_insensitive_unique",
    "first_per_key",
    "fold_histories",
    "keep_latest",
    "label_texts",
    "latest_with_bounds",
    "map_tokens",
    "match_passes",
    "not_null",
    "numbered",
    "outer_unify",
    "reduce_for_join",
    "relationship",
    "rollup_sources",
    "row_checks",
    "unique",
    "unique_combination",
    "unique_lookup",
]
