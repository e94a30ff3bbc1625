"""Column-level functions (Column -> Column), all built-in Spark expressions."""

from taxaweave.functions.names import (  # noqa: F401
    array_equals,
    classify_by_tokens,
    compose_name_by_rank,
    concat_skip_null,
    extract_rank,
    guarded_prefix,
    is_blank,
    map_vocabulary,
    normalize_names,
    not_blank,
    null_string,
    replace_first_marker,
    sortable_desc_text,
    split_around_marker,
    split_part,
    unguarded_prefix,
)
