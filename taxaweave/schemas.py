"""Fixed schemas, vocabularies and the hierarchical fill order.

The values under "FIXED VALUES" must equal the ones the source project uses for
its results to match: rank names, status vocabularies, abbreviations, the
conformed column list and the per-rank fallback order of the gap fill.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must stay equal to the source project's)
# ---------------------------------------------------------------------------

# Conformed (per-source) layer: 25 string columns, in this order.
CONFORMED_COLUMNS = [
    "id", "parent_id", "accepted_id", "original_id", "name", "generic_name",
    "specific_name", "infra_name", "kingdom", "phylum", "class", "order",
    "family", "subfamily", "tribe", "subtribe", "genus", "subgenus", "rank",
    "taxonomic_status", "nomenclatural_status", "ipni_id", "tpl_id",
    "data_source", "section",
]

# Attributes merged with MAX when records of one (name, rank) are combined.
MERGED_ATTRIBUTES = [
    "generic_name", "specific_name", "infra_name", "section", "subgenus",
    "genus", "subtribe", "tribe", "subfamily", "family", "order", "class",
    "phylum", "kingdom",
]

# Taxa layer: id, the two keys, the merged attributes and two arrays.
TAXA_COLUMNS = ["id", "name", "rank"] + MERGED_ATTRIBUTES + ["external_ids", "data_sources"]

# Sort keys of the dense taxa id (ascending, NULLS LAST); name and rank are
# appended as tie-breakers because (name, rank) is unique after the merge.
TAXA_ID_ORDER = [
    "kingdom", "phylum", "class", "order", "family", "subfamily", "tribe",
    "subtribe", "genus", "subgenus", "section", "generic_name",
    "specific_name", "infra_name", "name", "rank",
]

RANKS_ALL = [
    "kingdom", "phylum", "class", "order", "family", "subfamily", "tribe",
    "subtribe", "genus", "subgenus", "section", "species", "subspecies",
    "variety", "form",
]
RANKS_SPECIFIC = ["species", "subspecies", "variety", "form"]
RANKS_INFRASPECIFIC = ["subspecies", "variety", "form"]

TAXONOMIC_STATUS = ["accepted", "synonym", "doubtful", "unchecked"]
NOMENCLATURAL_STATUS = ["valid", "conserved", "superfluous", "invalid", "illegitimate", "rejected"]
INFRASPECIFIC_ABBREVIATIONS = ["ssp.", "f.", "var."]

# Status maps applied to WFO values (upper-cased input -> output); anything
# else is lower-cased.
WFO_TAXONOMIC_STATUS_MAP = {
    "ACCEPTED": "accepted", "SYNONYM": "synonym", "INVALID": "invalid",
    "UNRESOLVED": "unresolved", "MISAPPLIED": "misapplied",
}
WFO_NOMENCLATURAL_STATUS_MAP = {
    "LEGITIMATE": "legitimate", "ILLEGITIMATE": "illegitimate",
    "SUPERFLUOUS": "superfluous", "REJECTED": "rejected", "INVALID": "invalid",
}

# Order of preference among ranks inside a near-duplicate group.
DEDUPE_RANK_PREFERENCE = ["subspecies", "variety", "form"]

# Hierarchical gap fill: column -> lookup ranks tried after the row's own
# value, in order. Each lookup rank L supplies "most frequent non-NULL value of
# the column among rows with the same L". A single pass: lookups use the
# row's original values.
FILL_ORDER = {
    "subtribe": ["genus", "subfamily", "tribe"],
    "tribe": ["genus", "subtribe", "subfamily"],
    "subfamily": ["genus", "subtribe", "tribe", "family"],
    "family": ["genus", "subtribe", "tribe", "subfamily", "order"],
    "order": ["genus", "subtribe", "tribe", "subfamily", "family", "class"],
    "class": ["genus", "subtribe", "tribe", "subfamily", "family", "order", "phylum"],
    "phylum": ["genus", "subtribe", "tribe", "subfamily", "family", "order", "class", "kingdom"],
    "kingdom": ["genus", "subtribe", "tribe", "subfamily", "family", "order", "class", "phylum"],
}

# OrchidWiz constants for the upper ranks.
WIZ_CONSTANTS = {
    "kingdom": "Plantae", "phylum": "Tracheophyta", "class": "Liliopsida",
    "order": "Asparagales", "family": "Orchidaceae",
}

# ---------------------------------------------------------------------------
# Derived structures
# ---------------------------------------------------------------------------

CONFORMED_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in CONFORMED_COLUMNS])

TAXA_SCHEMA = T.StructType(
    [T.StructField("id", T.LongType(), True)]
    + [T.StructField(c, T.StringType(), True) for c in ["name", "rank"] + MERGED_ATTRIBUTES]
    + [
        T.StructField("external_ids", T.ArrayType(T.StringType(), True), True),
        T.StructField("data_sources", T.ArrayType(T.StringType(), True), True),
    ]
)


def string_schema(columns: list[str]) -> T.StructType:
    """All-text schema used for raw tables."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def fill_lookups(order: dict[str, list[str]] = FILL_ORDER) -> dict[str, list[str]]:
    """Invert the fill order: lookup rank -> target columns it must supply."""
    out: dict[str, list[str]] = {}
    for target, lookups in order.items():
        for rank in lookups:
            out.setdefault(rank, [])
            if target not in out[rank]:
                out[rank].append(target)
    return out
