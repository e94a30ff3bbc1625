"""Column expressions for names, identifiers and vocabularies.

Every function takes and returns ``Column`` objects (or column names), so the
work stays inside whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with further columns, each computed once a row.

    The optimiser puts the expression of a projected column into every later
    expression, filter and sort key that names it, so a name read by ten rules
    is built ten times, in a generated method too long for the JVM to compile.
    Columns of a generator (one element a row, so the rows stay as they are)
    are left where they stand.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[v.alias(k) for k, v in columns.items()]))))


def null_string() -> Column:
    """A typed NULL text column (B2); an untyped NULL would be ``void``."""
    return F.lit(None).cast("string")


def concat_skip_null(*cols: ColumnOrName) -> Column:
    """Concatenation that treats NULL as empty text (H1).

    SQL ``concat`` returns NULL when one argument is NULL in Spark; the
    semantics wanted here skip NULL arguments, which ``concat_ws`` with an
    empty separator does. All arguments NULL gives ``''``.
    """
    return F.concat_ws("", *[_c(c) for c in cols])


def split_part(col: ColumnOrName, delimiter: str, part: int) -> Column:
    """``split_part`` with a literal delimiter; negative parts count from the
    end, a missing part is ``''`` (H2, H3)."""
    return F.split_part(_c(col), F.lit(delimiter), F.lit(part))


def is_blank(col: ColumnOrName) -> Column:
    """NULL, or only spaces (B6 negated)."""
    c = _c(col)
    return c.isNull() | (F.trim(c) == "")


def not_blank(col: ColumnOrName) -> Column:
    """Non-NULL and not only spaces."""
    c = _c(col)
    return c.isNotNull() & (F.trim(c) != "")


def guarded_prefix(col: ColumnOrName, prefix: str) -> Column:
    """``prefix || col`` when col is not NULL, else NULL."""
    c = _c(col)
    return F.when(c.isNotNull(), F.concat(F.lit(prefix), c.cast("string")))


def unguarded_prefix(col: ColumnOrName, prefix: str) -> Column:
    """``prefix || col`` skipping NULL: a NULL id becomes just the prefix (B13, trap 19)."""
    return concat_skip_null(F.lit(prefix), _c(col).cast("string"))


def map_vocabulary(col: ColumnOrName, mapping: Mapping[str, str], fold_input=F.upper, fallback=F.lower) -> Column:
    """Map ``fold_input(col)`` through ``mapping``; unmatched values get
    ``fallback(col)`` (B11). The mapping is a literal map, evaluated JVM-side."""
    c = _c(col)
    if not mapping:
        return fallback(c)
    lookup = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.element_at(lookup, fold_input(c)), fallback(c))


def classify_by_tokens(col: ColumnOrName, rules: Sequence[tuple[Iterable[str], str]], default: str | None) -> Column:
    """First matching rule wins; a rule matches when the text contains any of
    its tokens (B10). Tokens are plain substrings (LIKE ``%token%`` without
    wildcards inside)."""
    c = _c(col)
    expr = None
    for tokens, label in rules:
        cond = None
        for tok in tokens:
            t = c.contains(tok)
            cond = t if cond is None else (cond | t)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    dflt = F.lit(default) if default is not None else null_string()
    return dflt if expr is None else expr.otherwise(dflt)


def split_around_marker(col: ColumnOrName, markers: Sequence[str]) -> tuple[Column, Column]:
    """Split a name at the first marker (in rule order) that it contains.

    Returns (before, after): ``before`` is the text up to the marker (the whole
    text when no marker matches), ``after`` the text following it (NULL when
    none matches).
    """
    c = _c(col)
    before = None
    after = None
    for m in markers:
        cond = c.contains(m)
        b = split_part(c, m, 1)
        a = split_part(c, m, 2)
        before = F.when(cond, b) if before is None else before.when(cond, b)
        after = F.when(cond, a) if after is None else after.when(cond, a)
    if before is None:
        return c, null_string()
    return before.otherwise(c), after.otherwise(null_string())


def replace_first_marker(col: ColumnOrName, rules: Sequence[tuple[str, str]]) -> Column:
    """Apply only the first rule whose token occurs: ``replace(col, tok, rep)``
    (H4). Text without any token is returned unchanged."""
    c = _c(col)
    expr = None
    for tok, rep in rules:
        cond = c.contains(tok)
        r = F.replace(c, F.lit(tok), F.lit(rep))
        expr = F.when(cond, r) if expr is None else expr.when(cond, r)
    return c if expr is None else expr.otherwise(c)


# ---------------------------------------------------------------------------
# FIXED VALUES: name normalisation rules (must equal the source project's)
#   ' subsp. ' -> ' ssp. '
#   ' fo. '    -> ' f. '
#   ' sect. <Capitalised word>' -> removed
#   ' subg. <Capitalised word>' -> removed
# Capture pattern for a rank marker: ' <abbr>. ([A-Z][a-z]*)'
# ---------------------------------------------------------------------------
NORMALIZE_RULES = [
    (r" subsp\. ", " ssp. "),
    (r" fo\. ", " f. "),
    (r" sect\. [A-Z][a-z]*", ""),
    (r" subg\. [A-Z][a-z]*", ""),
]

_REGEX_META = set("\\^$.|?*+()[]{}")


def _literal_of(pattern: str) -> str | None:
    """The plain text a pattern matches when it is a literal (escaped dots
    allowed), else None."""
    text = pattern.replace("\\.", "\x00")
    if any(ch in _REGEX_META for ch in text):
        return None
    return text.replace("\x00", ".")


def _regex_prefix(pattern: str) -> str:
    """Longest literal prefix of a pattern (used as a cheap pre-check)."""
    out = []
    i = 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\" and i + 1 < len(pattern) and pattern[i + 1] == ".":
            out.append(".")
            i += 2
            continue
        if ch in _REGEX_META:
            break
        out.append(ch)
        i += 1
    return "".join(out)


def normalize_names(col: ColumnOrName, rules: Sequence[tuple[str, str]] = NORMALIZE_RULES) -> Column:
    """Rewrite abbreviation variants and drop section/subgenus parts.

    Rules apply in order, each to every occurrence. Literal rules use plain
    ``replace``; a regex rule runs only on values containing its literal
    prefix, so most names never reach the regex engine.
    """
    c = _c(col)
    for pattern, rep in rules:
        lit = _literal_of(pattern)
        if lit is not None:
            c = F.replace(c, F.lit(lit), F.lit(rep))
        else:
            prefix = _regex_prefix(pattern)
            rx = F.regexp_replace(c, pattern, rep)
            c = F.when(c.contains(prefix), rx).otherwise(c) if prefix else rx
    return c


def extract_rank(col: ColumnOrName, abbreviation: str) -> Column:
    """The capitalised word after `` <abbr>. `` or NULL.

    The captured group needs at least one letter, so an empty extraction
    means "no match" and becomes NULL. Values without `` <abbr>. `` skip the
    regex.
    """
    c = _c(col)
    marker = " " + abbreviation + ". "
    pattern = " " + abbreviation.replace(".", r"\.") + r"\. ([A-Z][a-z]*)"
    return F.when(c.contains(marker), F.nullif(F.regexp_extract(c, pattern, 1), F.lit("")))


def compose_name_by_rank(
    rank: ColumnOrName,
    generic: ColumnOrName,
    specific: ColumnOrName,
    infra: ColumnOrName,
    fallback: ColumnOrName,
    markers: Mapping[str, str],
) -> Column:
    """``generic specific <marker> infra`` for the ranks in ``markers`` when the
    infra epithet is present, else ``fallback`` (H12). NULL parts are skipped
    (so a NULL generic name leaves a leading space), like ``concat`` in the
    source dialect."""
    r, g, s, i = _c(rank), _c(generic), _c(specific), _c(infra)
    expr = None
    for rank_value, marker in markers.items():
        cond = (r == rank_value) & i.isNotNull()
        val = concat_skip_null(g, F.lit(" "), s, F.lit(f" {marker} "), i)
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return _c(fallback) if expr is None else expr.otherwise(_c(fallback))


def array_equals(col: ColumnOrName, values: Sequence[str]) -> Column:
    """``col = ARRAY[values]`` (B14): same length, same elements, same order."""
    return _c(col) == F.array(*[F.lit(v) for v in values])


def sortable_desc_text(col: ColumnOrName) -> Column:
    """Text whose ascending binary order is the descending order of ``col``.

    Hex of the UTF-8 bytes keeps byte order; complementing every hex digit
    reverses it; the trailing ``~`` (above every hex digit) makes a prefix
    sort after its extensions. Lets mixed-direction orderings be packed into
    one ascending struct for ``min``-style aggregation.
    """
    return F.concat(F.translate(F.hex(_c(col).cast("string")), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("~"))
