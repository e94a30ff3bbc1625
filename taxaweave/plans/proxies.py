"""Every operator run on the driver's tables, with its DuckDB oracle SQL.

Each entry maps a SURVEY section-2 id to ``(spark_fn(spark, sf_dir) ->
DataFrame, sql | None)``. The Spark side calls the library operators; the SQL
is an independent statement of the same semantics. Induced NULLs use
``CASE WHEN key % m = 0 THEN NULL`` on both sides (a data transform, never a
row filter): every query reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaweave import functions as N
from taxaweave.operators import crosswalk as X
from taxaweave.operators import dedupe as D
from taxaweave.operators import fill as FL
from taxaweave.operators import joins as J
from taxaweave.operators import merge as M
from taxaweave.operators import numbering as R
from taxaweave.operators import quality as QC
from taxaweave.operators import rowchecks as RC
from taxaweave.plans import conform, derived, pipeline
from taxaweave.plans import oracle_taxonomy as OT
from taxaweave.schemas import INFRASPECIFIC_ABBREVIATIONS, RANKS_INFRASPECIFIC, TAXA_COLUMNS
from taxaweave.session import delete_scratch, scratch_mark, scratch_table

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def query(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = (fn, sql)
        return fn

    return deco


def T(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return derived.load(spark, sf, name)


c = F.col


def nulled(col: str, key: str, m: int) -> F.Column:
    """``CASE WHEN key % m = 0 THEN NULL ELSE col END``."""
    return F.when(c(key) % m == 0, F.lit(None)).otherwise(c(col))


def render_arrays(df: DataFrame) -> DataFrame:
    """Array columns as comma-joined text, for comparison with the oracle."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "array":
            out.append(F.array_join(c(f"`{f.name}`"), ",").alias(f.name))
        else:
            out.append(c(f"`{f.name}`"))
    return df.select(*out)


# ---------------------------------------------------------------------------
# Projections, filters, predicates (B)
# ---------------------------------------------------------------------------


@query("project_rename", "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer")
def q_project_rename(spark, sf):
    return T(spark, sf, "customer").select(c("c_custkey").alias("id"), c("c_name").alias("name"), c("c_mktsegment").alias("segment"))


@query("constant_and_null_columns", "SELECT p_partkey, 'Plantae' AS kingdom, CAST(NULL AS VARCHAR) AS subfamily FROM part")
def q_constant_and_null(spark, sf):
    return T(spark, sf, "part").select("p_partkey", F.lit("Plantae").alias("kingdom"), N.null_string().alias("subfamily"))


@query(
    "cast_text_int",
    "SELECT c_custkey, CAST(CAST(c_nationkey AS VARCHAR) AS INTEGER) AS nation_int, CAST(c_custkey AS VARCHAR) AS id_text, "
    "TRY_CAST(c_name AS INTEGER) AS name_int FROM customer",
)
def q_cast_text_int(spark, sf):
    return T(spark, sf, "customer").select(
        "c_custkey",
        c("c_nationkey").cast("string").cast("int").alias("nation_int"),
        c("c_custkey").cast("string").alias("id_text"),
        c("c_name").try_cast("int").alias("name_int"),
    )


@query("filter_equality", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'")
def q_filter_equality(spark, sf):
    return T(spark, sf, "lineitem").where(c("l_returnflag") == "R").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("filter_case_folded", "SELECT o_orderkey, o_orderstatus FROM orders WHERE lower(o_orderstatus) = 'f'")
def q_filter_case_folded(spark, sf):
    return T(spark, sf, "orders").where(F.lower("o_orderstatus") == "f").select("o_orderkey", "o_orderstatus")


_BLANKED_NAME = "CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN '   ' ELSE c_name END"


def _blanked_customer(spark, sf):
    return T(spark, sf, "customer").withColumn(
        "name_v", F.when(c("c_custkey") % 7 == 0, F.lit(None)).when(c("c_custkey") % 11 == 0, F.lit("   ")).otherwise(c("c_name"))
    )


@query(
    "filter_not_blank",
    f"SELECT c_custkey, name_v FROM (SELECT c_custkey, {_BLANKED_NAME} AS name_v FROM customer) x "
    "WHERE name_v IS NOT NULL AND trim(name_v) <> ''",
)
def q_filter_not_blank(spark, sf):
    return _blanked_customer(spark, sf).where(N.not_blank("name_v")).select("c_custkey", "name_v")


@query("filter_in_list", "SELECT p_partkey, p_name, p_type FROM part WHERE p_type IN ('SMALL', 'LARGE')")
def q_filter_in_list(spark, sf):
    return T(spark, sf, "part").where(c("p_type").isin("SMALL", "LARGE")).select("p_partkey", "p_name", "p_type")


@query(
    "filter_not_equal_3vl",
    "SELECT p_partkey, t FROM (SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_type END AS t FROM part) x WHERE t <> 'SMALL'",
)
def q_filter_not_equal(spark, sf):
    return T(spark, sf, "part").select("p_partkey", nulled("p_type", "p_partkey", 7).alias("t")).where(c("t") != "SMALL")


@query("like_prefix", "SELECT page_id, url FROM pages WHERE url LIKE 'https://%'")
def q_like_prefix(spark, sf):
    return T(spark, sf, "pages").where(c("url").startswith("https://")).select("page_id", "url")


_CLASSIFY_RULES = [([" red ", " hot "], "warm"), ([" blue ", " cold "], "cool"), ([" small ", " large "], "sized")]


@query(
    "like_contains_classifier",
    "SELECT p_partkey, CASE WHEN padded LIKE '% red %' OR padded LIKE '% hot %' THEN 'warm' "
    "WHEN padded LIKE '% blue %' OR padded LIKE '% cold %' THEN 'cool' "
    "WHEN padded LIKE '% small %' OR padded LIKE '% large %' THEN 'sized' ELSE 'other' END AS label "
    "FROM (SELECT p_partkey, ' ' || p_name || ' ' AS padded FROM part) x",
)
def q_like_contains(spark, sf):
    p = T(spark, sf, "part").withColumn("padded", F.concat(F.lit(" "), c("p_name"), F.lit(" ")))
    return p.select("p_partkey", N.classify_by_tokens("padded", _CLASSIFY_RULES, "other").alias("label"))


@query(
    "case_vocabulary_map",
    "SELECT o_orderkey, CASE WHEN upper(split_part(o_orderpriority, '-', 2)) = 'URGENT' THEN 'urgent-1' "
    "WHEN upper(split_part(o_orderpriority, '-', 2)) = 'HIGH' THEN 'high-2' ELSE lower(split_part(o_orderpriority, '-', 2)) END AS priority "
    "FROM orders",
)
def q_case_vocabulary(spark, sf):
    o = T(spark, sf, "orders")
    return o.select("o_orderkey", N.map_vocabulary(N.split_part("o_orderpriority", "-", 2), {"URGENT": "urgent-1", "HIGH": "high-2"}).alias("priority"))


@query(
    "coalesce_fallback",
    "SELECT p_partkey, coalesce(CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_brand END, "
    "CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_type END, p_name) AS label FROM part",
)
def q_coalesce(spark, sf):
    return T(spark, sf, "part").select("p_partkey", F.coalesce(nulled("p_brand", "p_partkey", 7), nulled("p_type", "p_partkey", 5), c("p_name")).alias("label"))


@query(
    "guarded_prefix_id",
    "SELECT c_custkey, CASE WHEN nk IS NOT NULL THEN 'nation-' || CAST(nk AS VARCHAR) END AS guarded, "
    "concat('nation-', CAST(nk AS VARCHAR)) AS unguarded "
    "FROM (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_nationkey END AS nk FROM customer) x",
)
def q_guarded_prefix(spark, sf):
    cu = T(spark, sf, "customer").select("c_custkey", nulled("c_nationkey", "c_custkey", 7).alias("nk"))
    return cu.select("c_custkey", N.guarded_prefix("nk", "nation-").alias("guarded"), N.unguarded_prefix("nk", "nation-").alias("unguarded"))


@query(
    "array_equals_flag",
    "SELECT p_partkey, (string_split(p_name, ' ') = ['small', 'ring']) AS is_small_ring FROM part",
)
def q_array_equals(spark, sf):
    return T(spark, sf, "part").select("p_partkey", N.array_equals(F.split("p_name", " "), ["small", "ring"]).alias("is_small_ring"))


# Group configuration for the tagging proxy: part types in groups; a type may
# sit in two groups (one-to-many join).
_TYPE_GROUPS_YAML = """
sized:
  description: by size
  families: [SMALL, MEDIUM, LARGE]
sales:
  families: [PROMO, ECONOMY]
budget:
  families: [ECONOMY]
"""


@query(
    "tag_family_group",
    "SELECT p.p_partkey, g.grp FROM part p LEFT JOIN (VALUES ('sized', 'SMALL'), ('sized', 'MEDIUM'), ('sized', 'LARGE'), "
    "('sales', 'PROMO'), ('sales', 'ECONOMY'), ('budget', 'ECONOMY')) g(grp, member) ON p.p_type = g.member",
)
def q_tag_groups(spark, sf):
    from taxaweave.sources.groups import load_family_groups, tag_family_group

    groups = load_family_groups(spark, _TYPE_GROUPS_YAML)
    return tag_family_group(T(spark, sf, "part"), groups, "p_type").select("p_partkey", c("group").alias("grp"))


# ---------------------------------------------------------------------------
# Joins (C)
# ---------------------------------------------------------------------------


@query("left_join_lookup", "SELECT c.c_custkey, n.n_name FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey")
def q_left_join_lookup(spark, sf):
    return J.lookup_join(T(spark, sf, "customer"), T(spark, sf, "nation"), "c_nationkey", "n_nationkey").select("c_custkey", "n_name")


@query(
    "left_join_cast_key",
    "SELECT c.c_custkey, n.n_name FROM (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_nationkey END AS nk FROM customer) c "
    "LEFT JOIN nation n ON CAST(c.nk AS VARCHAR) = CAST(n.n_nationkey AS VARCHAR)",
)
def q_left_join_cast(spark, sf):
    cu = T(spark, sf, "customer").select("c_custkey", nulled("c_nationkey", "c_custkey", 7).alias("nk"))
    return J.lookup_join(cu, T(spark, sf, "nation"), "nk", "n_nationkey", cast_keys_to="string").select("c_custkey", "n_name")


@query(
    "scalar_subquery_first_match",
    "SELECT p.p_partkey, (SELECT min(s.p_partkey) FROM part s WHERE s.p_type = 'SMALL' AND s.p_name = p.p_name "
    "AND s.p_brand = p.p_brand) AS parent_key FROM part p WHERE p.p_type <> 'SMALL'",
)
def q_first_match(spark, sf):
    p = T(spark, sf, "part")
    species = p.where(c("p_type") == "SMALL")
    infra = p.where(c("p_type") != "SMALL").select("p_partkey", "p_name", "p_brand")
    return J.first_match(infra, species, ["p_name", "p_brand"], "p_partkey", "parent_key").select("p_partkey", "parent_key")


_PART_NB = "(SELECT p_partkey, p_name, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_brand END AS brand, p_type, p_size FROM part)"


def _part_nb(spark, sf):
    return T(spark, sf, "part").select("p_partkey", "p_name", nulled("p_brand", "p_partkey", 7).alias("brand"), "p_type", "p_size")


@query(
    "inner_join_composite",
    f"WITH pn AS {_PART_NB}, dg AS (SELECT p_name, brand, count(*) AS group_size FROM pn GROUP BY p_name, brand HAVING count(*) > 1) "
    "SELECT pn.p_partkey, pn.p_name, pn.brand, dg.group_size FROM pn JOIN dg ON pn.p_name = dg.p_name AND pn.brand = dg.brand",
)
def q_inner_join_composite(spark, sf):
    pn = _part_nb(spark, sf)
    dg = M.duplicated_keys(pn, ["p_name", "brand"]).withColumnRenamed("p_name", "g_name").withColumnRenamed("brand", "g_brand")
    return pn.join(dg, (pn["p_name"] == dg["g_name"]) & (pn["brand"] == dg["g_brand"])).select("p_partkey", "p_name", "brand", "group_size")


@query(
    "anti_join_left_null",
    f"WITH pn AS {_PART_NB}, dg AS (SELECT p_name, brand FROM pn GROUP BY p_name, brand HAVING count(*) > 1) "
    "SELECT pn.p_partkey, pn.p_name, pn.brand FROM pn LEFT JOIN dg ON pn.p_name = dg.p_name AND pn.brand = dg.brand WHERE dg.p_name IS NULL",
)
def q_anti_join(spark, sf):
    pn = _part_nb(spark, sf)
    dg = M.duplicated_keys(pn, ["p_name", "brand"]).select(c("p_name").alias("g_name"), c("brand").alias("g_brand"))
    return pn.join(dg, (pn["p_name"] == dg["g_name"]) & (pn["brand"] == dg["g_brand"]), "left_anti").select("p_partkey", "p_name", "brand")


_PART_IDS = (
    "(SELECT p_partkey, p_name, brand, p_type, p_size, ['p-' || CAST(p_partkey AS VARCHAR), 's-' || CAST(p_size AS VARCHAR)] AS ids "
    f"FROM {_PART_NB} q)"
)


def _part_ids(spark, sf):
    return _part_nb(spark, sf).withColumn(
        "ids", F.array(F.concat(F.lit("p-"), c("p_partkey").cast("string")), F.concat(F.lit("s-"), c("p_size").cast("string")))
    )


@query(
    "correlated_array_collect",
    f"WITH pi AS {_PART_IDS} SELECT p_name, brand, unnest(list_distinct(flatten(list(ids)))) AS id "
    "FROM pi WHERE p_name IS NOT NULL AND brand IS NOT NULL GROUP BY p_name, brand HAVING count(*) > 1",
)
def q_array_collect(spark, sf):
    members = D.duplicate_members(_part_ids(spark, sf), ["p_name", "brand"], [D.asc("p_partkey")], ["p_partkey"])
    return members.select("p_name", "brand", F.explode("ids").alias("id")).distinct()


def _with_taken_ids(rows, links, ids, key):
    """``rows`` with one line per id: a winner's are the distinct ids of all
    members it stands for, any other row's its own."""
    taken = links.join(ids, links["member"] == ids[key]).select(c("winner").alias("__row"), "id").distinct()
    own = ids.join(links, ids[key] == links["member"], "left_anti").select(c(key).alias("__row"), "id")
    return rows.join(taken.unionByName(own), rows[key] == c("__row")).drop("__row")


_PART_FILL_ORDER = {"brand": ["p_name", "p_type"], "ptype": ["p_name", "brand"]}


def _part_fill_input(spark, sf):
    return T(spark, sf, "part").select(
        "p_partkey", "p_name", nulled("p_brand", "p_partkey", 7).alias("brand"), nulled("p_type", "p_partkey", 5).alias("ptype"),
        c("p_type"),
    )


def _mode_sql(src: str, key: str, target: str, alias: str) -> str:
    return (
        f"(SELECT k, v AS {alias} FROM (SELECT k, v, row_number() OVER (PARTITION BY k ORDER BY n DESC, v) AS rn FROM "
        f"(SELECT {key} AS k, {target} AS v, count(*) AS n FROM {src} WHERE {key} IS NOT NULL AND {target} IS NOT NULL "
        f"GROUP BY {key}, {target}) a) b WHERE rn = 1)"
    )


_PF = "(SELECT p_partkey, p_name, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_brand END AS brand, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_type END AS ptype FROM part)"


@query(
    "multi_lookup_left_join",
    f"WITH pf AS {_PF} SELECT pf.p_partkey, coalesce(pf.brand, a.best, b.best) AS brand, coalesce(pf.ptype, cc.best, d.best) AS ptype "
    f"FROM pf LEFT JOIN {_mode_sql('pf', 'p_name', 'brand', 'best')} a ON pf.p_name = a.k "
    f"LEFT JOIN {_mode_sql('pf', 'ptype', 'brand', 'best')} b ON pf.ptype = b.k "
    f"LEFT JOIN {_mode_sql('pf', 'p_name', 'ptype', 'best')} cc ON pf.p_name = cc.k "
    f"LEFT JOIN {_mode_sql('pf', 'brand', 'ptype', 'best')} d ON pf.brand = d.k",
)
def q_multi_lookup(spark, sf):
    pf = _part_fill_input(spark, sf).drop("p_type")
    order = {"brand": ["p_name", "ptype"], "ptype": ["p_name", "brand"]}
    return FL.hierarchical_fill(pf, order).select("p_partkey", "brand", "ptype")


@query(
    "crosswalk_inner_join",
    "WITH t AS (SELECT CAST(row_number() OVER (ORDER BY p_type, p_name) AS BIGINT) AS id, p_type, p_name FROM part GROUP BY p_type, p_name) "
    "SELECT t.id AS id, 'p-' || CAST(p.p_partkey AS VARCHAR) AS external_id FROM t JOIN part p ON t.p_type = p.p_type AND t.p_name = p.p_name "
    "WHERE p.p_brand = 'Brand#1'",
)
def q_crosswalk_join(spark, sf):
    p = T(spark, sf, "part")
    taxa = R.dense_id(p.select("p_type", "p_name").distinct(), ["p_type", "p_name"], out="id")
    rec = p.withColumn("rid", F.concat(F.lit("p-"), c("p_partkey").cast("string")))
    return X.crosswalk_join(taxa, rec, ["p_type", "p_name"], record_id="rid", where=c("p_brand") == "Brand#1")


@query("missing_records_anti_join", "SELECT o.o_orderkey FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey WHERE l.l_orderkey IS NULL")
def q_missing_records(spark, sf):
    return J.missing_from(T(spark, sf, "orders"), T(spark, sf, "lineitem"), "o_orderkey", "l_orderkey").select("o_orderkey")


@query("lateral_unnest", "SELECT page_id, unnest(string_split(url, '/')) AS token FROM pages")
def q_lateral_unnest(spark, sf):
    pg = T(spark, sf, "pages").select("page_id", F.split("url", "/").alias("parts"))
    return J.unnest(pg, "parts", "token").select("page_id", "token")


_SEG = "(SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS segment FROM customer)"


def _seg(spark, sf):
    return T(spark, sf, "customer").select("c_custkey", "c_nationkey", nulled("c_mktsegment", "c_custkey", 3).alias("segment"))


@query(
    "self_join_fill",
    f"WITH s AS {_SEG} SELECT s.c_custkey, s.c_nationkey, s.segment, coalesce(s.segment, m.best) AS filled_segment "
    f"FROM s LEFT JOIN {_mode_sql('s', 'c_nationkey', 'segment', 'best')} m ON s.c_nationkey = m.k",
)
def q_self_join_fill(spark, sf):
    return FL.fill_from_mode(_seg(spark, sf), "c_nationkey", ["segment"]).select("c_custkey", "c_nationkey", "segment", "filled_segment")


# ---------------------------------------------------------------------------
# Aggregations (D)
# ---------------------------------------------------------------------------


@query(
    "group_max_merge",
    "SELECT p_name, p_type, max(p_brand) AS family, max(p_size) AS max_size FROM part GROUP BY p_name, p_type",
)
def q_group_max(spark, sf):
    p = T(spark, sf, "part").withColumnRenamed("p_brand", "family").withColumnRenamed("p_size", "max_size")
    return M.group_max(p, ["p_name", "p_type"], ["family", "max_size"])


@query(
    "collect_ids",
    "SELECT p_name, p_type, max(p_brand) AS family, "
    "array_to_string(list(id ORDER BY id, src), ',') AS external_ids, array_to_string(list(src ORDER BY id, src), ',') AS data_sources "
    "FROM (SELECT p_name, p_type, p_brand, 'p-' || CAST(p_partkey AS VARCHAR) AS id, "
    "CASE p_partkey % 3 WHEN 0 THEN 'WFO' WHEN 1 THEN 'GBIF' ELSE 'OrchidWiz' END AS src FROM part) x GROUP BY p_name, p_type",
)
def q_collect_ids(spark, sf):
    p = T(spark, sf, "part").select(
        "p_name", "p_type", c("p_brand").alias("family"),
        F.concat(F.lit("p-"), c("p_partkey").cast("string")).alias("id"),
        F.when(c("p_partkey") % 3 == 0, "WFO").when(c("p_partkey") % 3 == 1, "GBIF").otherwise("OrchidWiz").alias("data_source"),
    )
    return render_arrays(M.merge_records(p, ["p_name", "p_type"], ["family"]))


@query(
    "group_having_count",
    "SELECT l_orderkey, l_linenumber, count(*) AS group_size FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
)
def q_group_having(spark, sf):
    return M.duplicated_keys(T(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "mode_per_group",
    f"WITH s AS {_SEG} SELECT k.c_nationkey, m.best AS best_segment FROM (SELECT DISTINCT c_nationkey FROM s WHERE c_nationkey IS NOT NULL) k "
    f"LEFT JOIN {_mode_sql('s', 'c_nationkey', 'segment', 'best')} m ON k.c_nationkey = m.k",
)
def q_mode_per_group(spark, sf):
    s = _seg(spark, sf).withColumn("c_nationkey", c("c_nationkey"))
    out = FL.mode_by_key(s, "c_nationkey", ["segment"])
    return out.select(c("c_nationkey").cast("int").alias("c_nationkey"), "best_segment")


@query(
    "mode_wide_by_genus",
    "WITH p AS (SELECT p_name, p_brand, p_type, CAST(p_size AS VARCHAR) AS size_text FROM part) "
    "SELECT k.p_name, a.best AS best_p_brand, b.best AS best_p_type, d.best AS best_size_text "
    "FROM (SELECT DISTINCT p_name FROM p) k "
    f"LEFT JOIN {_mode_sql('p', 'p_name', 'p_brand', 'best')} a ON k.p_name = a.k "
    f"LEFT JOIN {_mode_sql('p', 'p_name', 'p_type', 'best')} b ON k.p_name = b.k "
    f"LEFT JOIN {_mode_sql('p', 'p_name', 'size_text', 'best')} d ON k.p_name = d.k",
)
def q_mode_wide(spark, sf):
    p = T(spark, sf, "part").select("p_name", "p_brand", "p_type", c("p_size").cast("string").alias("size_text"))
    return FL.mode_by_key(p, "p_name", ["p_brand", "p_type", "size_text"])


@query(
    "collect_ids_in_segments",
    "SELECT o_custkey, CAST((n - 1) // 4 AS BIGINT) AS segment, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY n) AS orderkeys, "
    "string_agg(o_orderstatus, ',' ORDER BY n) AS statuses FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders) x "
    "GROUP BY o_custkey, (n - 1) // 4",
)
def q_collect_segments(spark, sf):
    """Ids of one key in arrays of at most four, in order over the segments."""
    out = M.collect_segments(T(spark, sf, "orders"), ["o_custkey"], {"orderkeys": "o_orderkey", "statuses": "o_orderstatus"}, ["o_orderdate", "o_orderkey"], size=4)
    return render_arrays(out)


@query("select_distinct", "SELECT DISTINCT p_name, p_type FROM part")
def q_select_distinct(spark, sf):
    return T(spark, sf, "part").select("p_name", "p_type").distinct()


@query("distinct_unnest_union", "SELECT DISTINCT p_brand, unnest(string_split(p_name, ' ')) AS word FROM part")
def q_distinct_unnest(spark, sf):
    return T(spark, sf, "part").select("p_brand", F.explode(F.split("p_name", " ")).alias("word")).distinct()


@query(
    "global_count",
    "SELECT (SELECT count(*) FROM lineitem) AS n_lineitem, (SELECT count(*) FROM orders) AS n_orders, (SELECT count(*) FROM part) AS n_part",
)
def q_global_count(spark, sf):
    names = ("lineitem", "orders", "part")
    zero = F.lit(0).cast("long")
    parts = [
        T(spark, sf, t).agg(F.count(F.lit(1)).alias(f"n_{t}")).select(*[(c(f"n_{u}") if u == t else zero.alias(f"n_{u}")) for u in names])
        for t in names
    ]
    stacked = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return stacked.agg(*[F.sum(f"n_{u}").alias(f"n_{u}") for u in names])


@query(
    "accepted_only_group_max",
    "SELECT o_custkey, max(o_orderpriority) AS max_priority, max(o_orderkey) AS max_orderkey FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey",
)
def q_accepted_group_max(spark, sf):
    o = T(spark, sf, "orders").withColumnRenamed("o_orderpriority", "max_priority").withColumn("max_orderkey", c("o_orderkey"))
    return M.group_max(o, ["o_custkey"], ["max_priority", "max_orderkey"], where=c("o_orderstatus") == "F")


# ---------------------------------------------------------------------------
# Windows, sorts (E, F)
# ---------------------------------------------------------------------------

_LI_NULLDATE = (
    "(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, "
    "CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_shipdate END AS shipdate FROM lineitem)"
)


@query(
    "dedupe_preferred_row",
    f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, strftime(shipdate, '%Y-%m-%d') AS shipdate FROM "
    f"(SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY CASE WHEN l_returnflag = 'R' THEN 1 ELSE 2 END, "
    f"shipdate DESC NULLS FIRST, l_partkey, l_suppkey) AS rn FROM {_LI_NULLDATE} x) y WHERE rn = 1",
)
def q_dedupe_preferred(spark, sf):
    li = T(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", nulled("l_shipdate", "l_partkey", 7).alias("shipdate")
    )
    best = D.top1_per_key(
        li,
        ["l_orderkey", "l_linenumber"],
        [D.asc(F.when(c("l_returnflag") == "R", 1).otherwise(2)), D.desc("shipdate", nulls_first=True), D.asc("l_partkey"), D.asc("l_suppkey")],
    )
    return best.withColumn("shipdate", F.date_format("shipdate", "yyyy-MM-dd"))


@query(
    "sequence_in_group",
    "SELECT o_orderkey, o_custkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS seq FROM orders",
)
def q_sequence_in_group(spark, sf):
    o = T(spark, sf, "orders")
    return R.sequence_in_group(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], out="seq", key=["o_orderkey"]).select("o_orderkey", "o_custkey", "seq")


@query(
    "rank_duplicates",
    f"WITH pi AS {_PART_IDS}, cand AS (SELECT *, count(*) OVER (PARTITION BY p_name, brand) AS n, "
    "row_number() OVER (PARTITION BY p_name, brand ORDER BY p_size DESC, CASE p_type WHEN 'SMALL' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'LARGE' THEN 3 ELSE 4 END, p_partkey) AS rn "
    "FROM pi WHERE p_name IS NOT NULL AND brand IS NOT NULL), "
    "merged AS (SELECT p_name, brand, list_sort(list_distinct(flatten(list(ids)))) AS m FROM cand GROUP BY p_name, brand) "
    "SELECT c.p_partkey, c.p_name, c.brand, c.p_type, c.p_size, unnest(CASE WHEN c.n > 1 THEN m.m ELSE c.ids END) AS id "
    "FROM cand c JOIN merged m ON c.p_name = m.p_name AND c.brand = m.brand WHERE c.rn = 1 "
    "UNION ALL SELECT p_partkey, p_name, brand, p_type, p_size, unnest(ids) AS id FROM pi WHERE p_name IS NULL OR brand IS NULL",
)
def q_rank_duplicates(spark, sf):
    pi = _part_ids(spark, sf)
    order = [D.desc("p_size"), D.asc(D.rank_preference("p_type", ["SMALL", "MEDIUM", "LARGE"])), D.asc("p_partkey")]
    rows, links = D.resolve_duplicates(pi, ["p_name", "brand"], order, "p_partkey")
    ids = pi.select("p_partkey", F.explode("ids").alias("id"))
    return _with_taken_ids(rows.select("p_partkey", "p_name", "brand", "p_type", "p_size"), links, ids, "p_partkey")


@query(
    "dense_global_id",
    "SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS id FROM orders",
)
def q_dense_id(spark, sf):
    return R.dense_id(T(spark, sf, "orders"), ["o_orderdate", "o_orderkey"], key=["o_orderkey"]).select("o_orderkey", "id")


@query(
    "sort_multi_key_nulls_last",
    "SELECT o_orderkey, CAST(row_number() OVER (ORDER BY pr NULLS LAST, o_orderdate NULLS LAST, o_orderkey NULLS LAST) AS BIGINT) AS id "
    "FROM (SELECT o_orderkey, o_orderdate, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS pr FROM orders) x",
)
def q_sort_multi_key(spark, sf):
    o = T(spark, sf, "orders").withColumn("pr", nulled("o_orderpriority", "o_orderkey", 7))
    return R.dense_id(o, ["pr", "o_orderdate", "o_orderkey"], key=["o_orderkey"]).select("o_orderkey", "id")


@query("sort_output", "SELECT p_partkey, p_name, row_number() OVER (ORDER BY p_name, p_partkey) AS nth FROM part")
def q_sort_output(spark, sf):
    """Sorted over all partitions; each row also carries its place, so that the
    order itself is checked."""
    p = T(spark, sf, "part").select("p_partkey", "p_name")
    return R.dense_id(p, ["p_name", "p_partkey"], out="nth").orderBy("nth")


@query("sort_array_elements", "SELECT p_partkey, array_to_string(list_sort(string_split(p_name, ' ')), ',') AS words FROM part")
def q_sort_array(spark, sf):
    return T(spark, sf, "part").select("p_partkey", F.array_join(F.array_sort(F.split("p_name", " ")), ",").alias("words"))


@query(
    "top1_per_key",
    "SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM (SELECT *, row_number() OVER "
    "(PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) x WHERE rn = 1",
)
def q_top1(spark, sf):
    o = T(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    best = D.top1_per_key(o, ["o_custkey"], [D.desc("o_orderdate"), D.desc("o_orderkey")])
    return best.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


# ---------------------------------------------------------------------------
# Set operations (G)
# ---------------------------------------------------------------------------


@query(
    "union_all_conform",
    "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation, c_mktsegment AS segment, 'customer' AS src FROM customer "
    "UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, CAST(s_nationkey AS VARCHAR), NULL, 'supplier' FROM supplier",
)
def q_union_conform(spark, sf):
    cu = T(spark, sf, "customer").select(c("c_custkey").alias("id"), c("c_name").alias("name"), c("c_nationkey").alias("nation"), c("c_mktsegment").alias("segment"), F.lit("customer").alias("src"))
    su = T(spark, sf, "supplier").select(c("s_suppkey").alias("id"), c("s_name").alias("name"), c("s_nationkey").alias("nation"), F.lit("supplier").alias("src"))
    return M.union_conform([cu, su], ["id", "name", "nation", "segment", "src"])


@query(
    "union_all_same_source",
    "SELECT o_orderkey, 'final' AS part FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, 'open' FROM orders WHERE o_orderstatus <> 'F'",
)
def q_union_same(spark, sf):
    o = T(spark, sf, "orders")
    a = o.where(c("o_orderstatus") == "F").select("o_orderkey", F.lit("final").alias("part"))
    b = o.where(c("o_orderstatus") != "F").select("o_orderkey", F.lit("open").alias("part"))
    return M.union_conform([a, b], ["o_orderkey", "part"], cast=None)


@query(
    "union_all_keep_and_rest",
    "WITH o AS (SELECT o_orderkey, o_custkey, o_orderpriority, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS st, "
    "['o-' || CAST(o_orderkey AS VARCHAR)] AS ids FROM orders), "
    "cand AS (SELECT *, count(*) OVER (PARTITION BY o_custkey, st) AS n, row_number() OVER (PARTITION BY o_custkey, st ORDER BY o_orderpriority, o_orderkey) AS rn "
    "FROM o WHERE st IS NOT NULL), m AS (SELECT o_custkey, st, list_sort(list_distinct(flatten(list(ids)))) AS mi FROM cand GROUP BY o_custkey, st) "
    "SELECT c.o_orderkey, c.o_custkey, c.st, unnest(CASE WHEN c.n > 1 THEN m.mi ELSE c.ids END) AS id "
    "FROM cand c JOIN m ON c.o_custkey = m.o_custkey AND c.st = m.st WHERE c.rn = 1 "
    "UNION ALL SELECT o_orderkey, o_custkey, st, unnest(ids) FROM o WHERE st IS NULL",
)
def q_keep_and_rest(spark, sf):
    o = T(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", nulled("o_orderstatus", "o_orderkey", 5).alias("st"),
        F.array(F.concat(F.lit("o-"), c("o_orderkey").cast("string"))).alias("ids"),
    )
    rows, links = D.resolve_duplicates(o, ["o_custkey", "st"], [D.asc("o_orderpriority"), D.asc("o_orderkey")], "o_orderkey")
    ids = o.select("o_orderkey", F.explode("ids").alias("id"))
    return _with_taken_ids(rows.select("o_orderkey", "o_custkey", "st"), links, ids, "o_orderkey")


# ---------------------------------------------------------------------------
# Scalar functions (H)
# ---------------------------------------------------------------------------


@query(
    "concat_skip_null",
    f"SELECT c_custkey, concat(name_v, '/', seg) AS label FROM (SELECT c_custkey, {_BLANKED_NAME} AS name_v, "
    "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS seg FROM customer) x",
)
def q_concat_skip(spark, sf):
    cu = _blanked_customer(spark, sf).withColumn("seg", nulled("c_mktsegment", "c_custkey", 5))
    return cu.select("c_custkey", N.concat_skip_null("name_v", F.lit("/"), "seg").alias("label"))


@query(
    "split_part_positive",
    "SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS p1, split_part(o_orderpriority, '-', 2) AS p2, split_part(o_orderpriority, '-', 3) AS p3 FROM orders",
)
def q_split_pos(spark, sf):
    o = T(spark, sf, "orders")
    return o.select("o_orderkey", *[N.split_part("o_orderpriority", "-", i).alias(f"p{i}") for i in (1, 2, 3)])


@query("split_part_negative", "SELECT page_id, split_part(url, '/', -1) AS last_part, split_part(url, '.', -2) AS tld_prev FROM pages")
def q_split_neg(spark, sf):
    return T(spark, sf, "pages").select("page_id", N.split_part("url", "/", -1).alias("last_part"), N.split_part("url", ".", -2).alias("tld_prev"))


_REWRITES = [(" ring", " rg."), ("red ", "rd. "), (" widget", " wdg."), ("Brand#1", "B1")]


@query(
    "replace_token",
    "SELECT p_partkey, CASE WHEN s LIKE '% ring%' THEN replace(s, ' ring', ' rg.') WHEN s LIKE '%red %' THEN replace(s, 'red ', 'rd. ') "
    "WHEN s LIKE '% widget%' THEN replace(s, ' widget', ' wdg.') WHEN s LIKE '%Brand#1%' THEN replace(s, 'Brand#1', 'B1') ELSE s END AS rewritten "
    "FROM (SELECT p_partkey, p_name || ' ' || p_brand AS s FROM part) x",
)
def q_replace_token(spark, sf):
    p = T(spark, sf, "part").select("p_partkey", F.concat_ws(" ", "p_name", "p_brand").alias("s"))
    return p.select("p_partkey", N.replace_first_marker("s", _REWRITES).alias("rewritten"))


_BOTANICAL = (
    "(SELECT p_partkey, p_size, upper(substr(split_part(p_name, ' ', 2), 1, 1)) || substr(split_part(p_name, ' ', 2), 2) || ' ' || "
    "split_part(p_name, ' ', 1) || CASE p_size % 6 WHEN 0 THEN ' subsp. alba' WHEN 1 THEN ' fo. rubra' WHEN 2 THEN ' sect. Alba x' "
    "WHEN 3 THEN ' subg. Rubra var. y' WHEN 4 THEN ' var. nana' ELSE '' END AS bname FROM part)"
)


def _botanical(spark, sf):
    w2 = N.split_part("p_name", " ", 2)
    tail = (
        F.when(c("p_size") % 6 == 0, " subsp. alba").when(c("p_size") % 6 == 1, " fo. rubra").when(c("p_size") % 6 == 2, " sect. Alba x")
        .when(c("p_size") % 6 == 3, " subg. Rubra var. y").when(c("p_size") % 6 == 4, " var. nana").otherwise("")
    )
    name = F.concat(F.upper(F.substring(w2, 1, 1)), F.substring(w2, 2, 1 << 30), F.lit(" "), N.split_part("p_name", " ", 1), tail)
    return T(spark, sf, "part").select("p_partkey", "p_size", name.alias("bname"))


@query(
    "normalize_abbreviations",
    f"SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(regexp_replace(bname, ' subsp\\. ', ' ssp. ', 'g'), "
    f"' fo\\. ', ' f. ', 'g'), ' sect\\. [A-Z][a-z]*', '', 'g'), ' subg\\. [A-Z][a-z]*', '', 'g') AS name FROM {_BOTANICAL} b",
)
def q_normalize(spark, sf):
    return _botanical(spark, sf).select("p_partkey", N.normalize_names("bname").alias("name"))


@query(
    "regex_extract_or_null",
    f"SELECT p_partkey, nullif(regexp_extract(bname, ' sect\\. ([A-Z][a-z]*)', 1), '') AS section, "
    f"nullif(regexp_extract(bname, ' subg\\. ([A-Z][a-z]*)', 1), '') AS subgenus FROM {_BOTANICAL} b",
)
def q_extract_rank(spark, sf):
    return _botanical(spark, sf).select("p_partkey", N.extract_rank("bname", "sect").alias("section"), N.extract_rank("bname", "subg").alias("subgenus"))


@query(
    "lower_upper_trim",
    "SELECT c_custkey, lower(c_mktsegment) AS seg_lower, upper(c_name) AS name_upper, trim('  ' || c_mktsegment || '  ') AS seg_trim FROM customer",
)
def q_lower_upper_trim(spark, sf):
    cu = T(spark, sf, "customer")
    return cu.select("c_custkey", F.lower("c_mktsegment").alias("seg_lower"), F.upper("c_name").alias("name_upper"), F.trim(F.concat(F.lit("  "), c("c_mktsegment"), F.lit("  "))).alias("seg_trim"))


@query("array_length", "SELECT page_id, CAST(len(string_split(url, '/')) AS BIGINT) AS n_parts FROM pages")
def q_array_length(spark, sf):
    return T(spark, sf, "pages").select("page_id", F.size(F.split("url", "/")).cast("long").alias("n_parts"))


@query("unnest_array", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def q_unnest_array(spark, sf):
    return J.unnest(T(spark, sf, "part").select("p_partkey", F.split("p_name", " ").alias("w")), "w", "word").select("p_partkey", "word")


@query("json_extract", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def q_json_extract(spark, sf):
    return T(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


_RANK_OF_TYPE = "CASE p_type WHEN 'SMALL' THEN 'species' WHEN 'MEDIUM' THEN 'subspecies' WHEN 'LARGE' THEN 'variety' WHEN 'PROMO' THEN 'form' WHEN 'ECONOMY' THEN 'genus' ELSE 'unranked' END"


def _rank_of_type():
    return (
        F.when(c("p_type") == "SMALL", "species").when(c("p_type") == "MEDIUM", "subspecies").when(c("p_type") == "LARGE", "variety")
        .when(c("p_type") == "PROMO", "form").when(c("p_type") == "ECONOMY", "genus").otherwise("unranked")
    )


@query(
    "name_builder_by_rank",
    f"SELECT p_partkey, CASE WHEN r = 'subspecies' AND i IS NOT NULL THEN concat(g, ' ', s, ' subsp. ', i) "
    "WHEN r = 'variety' AND i IS NOT NULL THEN concat(g, ' ', s, ' var. ', i) WHEN r = 'form' AND i IS NOT NULL THEN concat(g, ' ', s, ' f. ', i) "
    "ELSE p_name END AS name FROM (SELECT p_partkey, p_name, "
    f"{_RANK_OF_TYPE} AS r, CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE split_part(p_name, ' ', 2) END AS g, split_part(p_name, ' ', 1) AS s, "
    "CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE lower(p_brand) END AS i FROM part) x",
)
def q_name_builder(spark, sf):
    p = T(spark, sf, "part").select(
        "p_partkey", "p_name", _rank_of_type().alias("r"),
        F.when(c("p_partkey") % 11 == 0, F.lit(None)).otherwise(N.split_part("p_name", " ", 2)).alias("g"),
        N.split_part("p_name", " ", 1).alias("s"),
        F.when(c("p_partkey") % 7 == 0, F.lit(None)).otherwise(F.lower("p_brand")).alias("i"),
    )
    markers = {"subspecies": "subsp.", "variety": "var.", "form": "f."}
    return p.select("p_partkey", N.compose_name_by_rank("r", "g", "s", "i", "p_name", markers).alias("name"))


_SPLIT_MARKERS = [" var. ", " subsp. ", " fo. "]


@query(
    "infraspecific_split",
    f"SELECT p_partkey, CASE WHEN bname LIKE '% var. %' THEN split_part(bname, ' var. ', 1) WHEN bname LIKE '% subsp. %' THEN split_part(bname, ' subsp. ', 1) "
    "WHEN bname LIKE '% fo. %' THEN split_part(bname, ' fo. ', 1) ELSE bname END AS species_part, "
    "CASE WHEN bname LIKE '% var. %' THEN split_part(bname, ' var. ', 2) WHEN bname LIKE '% subsp. %' THEN split_part(bname, ' subsp. ', 2) "
    f"WHEN bname LIKE '% fo. %' THEN split_part(bname, ' fo. ', 2) ELSE NULL END AS infra_part FROM {_BOTANICAL} b",
)
def q_infra_split(spark, sf):
    before, after = N.split_around_marker("bname", _SPLIT_MARKERS)
    return _botanical(spark, sf).select("p_partkey", before.alias("species_part"), after.alias("infra_part"))


# ---------------------------------------------------------------------------
# Data-quality checks (L)
# ---------------------------------------------------------------------------


@query("dq_unique", "SELECT l_orderkey, count(*) AS n_records FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey HAVING count(*) > 1")
def q_dq_unique(spark, sf):
    return QC.unique(T(spark, sf, "lineitem"), "l_orderkey")


@query("dq_not_null", f"SELECT c_custkey FROM (SELECT c_custkey, {_BLANKED_NAME} AS name_v FROM customer) x WHERE name_v IS NULL")
def q_dq_not_null(spark, sf):
    return QC.not_null(_blanked_customer(spark, sf), "name_v").select("c_custkey")


@query(
    "dq_unique_combination",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
)
def q_dq_unique_combination(spark, sf):
    return QC.unique_combination(T(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_accepted_values", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O')")
def q_dq_accepted(spark, sf):
    return QC.accepted_values(T(spark, sf, "orders"), "o_orderstatus", ["F", "O"]).select("o_orderkey", "o_orderstatus")


@query(
    "dq_relationships",
    "SELECT o_orderkey, custkey FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN -1 - o_custkey ELSE o_custkey END AS custkey FROM orders) x "
    "WHERE custkey IS NOT NULL AND custkey NOT IN (SELECT c_custkey FROM customer)",
)
def q_dq_relationships(spark, sf):
    # the key of every tenth order is changed, so that they are orphans
    o = T(spark, sf, "orders").select("o_orderkey", F.when(c("o_orderkey") % 10 == 0, -1 - c("o_custkey")).otherwise(c("o_custkey")).alias("custkey"))
    return QC.relationships(o, "custkey", T(spark, sf, "customer"), "c_custkey").select("o_orderkey", "custkey")


@query("dq_not_empty_string", f"SELECT c_custkey, name_v FROM (SELECT c_custkey, {_BLANKED_NAME} AS name_v FROM customer) x WHERE name_v IS NULL OR trim(name_v) = ''")
def q_dq_not_empty(spark, sf):
    return QC.not_empty_string(_blanked_customer(spark, sf), "name_v").select("c_custkey", "name_v")


@query("dq_expression_is_true", "SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE NOT coalesce(l_discount <= 0.05, false)")
def q_dq_expression(spark, sf):
    return QC.expression_is_true(T(spark, sf, "lineitem"), "l_discount <= 0.05").select("l_orderkey", "l_linenumber", "l_discount")


@query(
    "dq_equal_rowcount",
    "SELECT * FROM (SELECT (SELECT count(*) FROM orders) AS n_left, (SELECT count(*) FROM lineitem) AS n_right) x WHERE n_left <> n_right",
)
def q_dq_equal_rowcount(spark, sf):
    return QC.equal_rowcount(T(spark, sf, "orders"), T(spark, sf, "lineitem"))


@query(
    "dq_fewer_rows_than",
    "SELECT * FROM (SELECT (SELECT count(*) FROM lineitem) AS n_left, (SELECT count(*) FROM orders) AS n_right) x WHERE n_left >= n_right",
)
def q_dq_fewer_rows(spark, sf):
    return QC.fewer_rows_than(T(spark, sf, "lineitem"), T(spark, sf, "orders"))


@query("dq_accepted_range", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity IS NOT NULL AND NOT (l_quantity >= 1 AND l_quantity <= 40)")
def q_dq_range(spark, sf):
    return QC.accepted_range(T(spark, sf, "lineitem"), "l_quantity", 1, 40).select("l_orderkey", "l_linenumber", "l_quantity")


@query("dq_not_accepted_values", "SELECT event_id, event_type FROM events WHERE event_type IN ('error')")
def q_dq_not_accepted(spark, sf):
    return QC.not_accepted_values(T(spark, sf, "events"), "event_type", ["error"]).select("event_id", "event_type")


@query(
    "dq_not_null_proportion",
    f"SELECT * FROM (SELECT CAST(count(name_v) AS DOUBLE) / greatest(count(*), 1) AS not_null_proportion FROM "
    f"(SELECT {_BLANKED_NAME} AS name_v FROM customer) x) y WHERE not_null_proportion < 0.95 OR not_null_proportion > 1.0",
)
def q_dq_not_null_prop(spark, sf):
    return QC.not_null_proportion(_blanked_customer(spark, sf), "name_v", 0.95)


@query(
    "dq_recency",
    "SELECT strftime(latest, '%Y-%m-%d %H:%M:%S') AS latest FROM (SELECT max(ts) AS latest FROM events) x "
    "WHERE latest IS NULL OR latest < TIMESTAMP '2030-01-01 00:00:00' - INTERVAL 30 DAY",
)
def q_dq_recency(spark, sf):
    out = QC.recency(T(spark, sf, "events"), "ts", F.lit("2030-01-01 00:00:00").cast("timestamp_ntz"), "30 DAYS")
    return out.select(F.date_format("latest", "yyyy-MM-dd HH:mm:ss").alias("latest"))


@query(
    "dq_sequential_values",
    "SELECT conv_id, place, previous_value FROM (SELECT conv_id, place, lag(place) OVER (PARTITION BY conv_id ORDER BY place) AS previous_value "
    "FROM (SELECT conv_id, turn + CASE WHEN turn > conv_id % 5 THEN 1 ELSE 0 END AS place FROM conversations) c) x "
    "WHERE previous_value IS NOT NULL AND place <> previous_value + 1",
)
def q_dq_sequential(spark, sf):
    # turns behind some place are moved on by one, so that there are gaps
    moved = T(spark, sf, "conversations").select("conv_id", (c("turn") + F.when(c("turn") > c("conv_id") % 5, 1).otherwise(0)).alias("place"))
    return QC.sequential_values(moved, "place", ["conv_id"]).select("conv_id", "place", "previous_value")


_CHECKED = (
    "(SELECT p_partkey, CASE WHEN p_partkey % 13 = 0 THEN NULL WHEN p_partkey % 17 = 0 THEN '  ' ELSE p_name END AS name, p_brand, p_type, p_size, "
    "CASE WHEN p_partkey % 5 = 0 THEN 'unranked' WHEN p_partkey % 3 = 0 THEN 'species' ELSE 'variety' END AS rank, "
    "split_part(p_name, ' ', 1) || CASE WHEN p_size % 4 = 0 THEN ' var.' ELSE '' END AS epithet FROM part)"
)
#: The ten checks as SQL, by name.
_TEN = {
    "not_null": "name IS NULL",
    "accepted_values": "p_type IS NOT NULL AND p_type NOT IN ('SMALL', 'MEDIUM', 'ECONOMY')",
    "not_empty": "name IS NULL OR trim(name) = ''",
    "expression": "NOT coalesce(p_size > length(name), false)",
    "range": "p_size < 5 OR p_size > 40",
    "not_accepted_values": "p_brand IN ('Brand#1', 'Brand#2')",
    "single_word": "coalesce(epithet LIKE '% %', false)",
    "period": "coalesce(epithet LIKE '%.%', false) AND (rank IS NULL OR rank NOT IN ('subspecies', 'variety', 'form'))",
    "no_digits": "coalesce(regexp_matches(p_brand, '[0-9]'), false)",
    "no_unranked": "rank = 'unranked'",
}


def _checked(spark, sf):
    name = F.when(c("p_partkey") % 13 == 0, F.lit(None)).when(c("p_partkey") % 17 == 0, F.lit("  ")).otherwise(c("p_name"))
    rank = F.when(c("p_partkey") % 5 == 0, "unranked").when(c("p_partkey") % 3 == 0, "species").otherwise("variety")
    epithet = F.concat(F.split_part("p_name", F.lit(" "), F.lit(1)), F.when(c("p_size") % 4 == 0, " var.").otherwise(""))
    return T(spark, sf, "part").select("p_partkey", name.alias("name"), "p_brand", "p_type", "p_size", rank.alias("rank"), epithet.alias("epithet"))


def ten_checks():
    return {
        "not_null": RC.is_null("name"),
        "accepted_values": RC.outside_values("p_type", ["SMALL", "MEDIUM", "ECONOMY"]),
        "not_empty": RC.is_blank("name"),
        "expression": RC.not_true("p_size > length(name)"),
        "range": RC.outside_range("p_size", 5, 40),
        "not_accepted_values": RC.among_values("p_brand", ["Brand#1", "Brand#2"]),
        "single_word": RC.several_words(["epithet"]),
        "period": RC.period_above("epithet", "rank", RANKS_INFRASPECIFIC),
        "no_digits": RC.has_digit(["p_brand"]),
        "no_unranked": RC.among_values("rank", ["unranked"]),
    }


@query("dq_fused_counts", " UNION ALL ".join(f"SELECT '{n}' AS \"check\", count(*) FILTER (WHERE {sql}) AS n_failures FROM {_CHECKED} x" for n, sql in _TEN.items()))
def q_dq_fused_counts(spark, sf):
    """Ten checks in one scan: failures by check."""
    return RC.run_checks(_checked(spark, sf), ten_checks(), keep=["p_partkey"]).counts


@query("dq_fused_rows", " UNION ALL ".join(f"SELECT '{n}' AS \"check\", p_partkey FROM {_CHECKED} x WHERE {sql}" for n, sql in _TEN.items()))
def q_dq_fused_rows(spark, sf):
    """Ten checks in one scan: the failing rows of each."""
    return RC.run_checks(_checked(spark, sf), ten_checks(), keep=["p_partkey"]).labelled().select("check", "p_partkey")


@query(
    "dq_cardinality_equality",
    "SELECT coalesce(a.value, b.value) AS value, coalesce(a.n_left, 0) AS n_left, coalesce(b.n_right, 0) AS n_right FROM "
    "(SELECT doc_id AS value, count(*) AS n_left FROM documents GROUP BY doc_id) a FULL OUTER JOIN "
    "(SELECT doc_id AS value, count(*) AS n_right FROM labels GROUP BY doc_id) b ON a.value IS NOT DISTINCT FROM b.value "
    "WHERE coalesce(a.n_left, 0) <> coalesce(b.n_right, 0)",
)
def q_dq_cardinality(spark, sf):
    return QC.cardinality_equality(T(spark, sf, "documents"), "doc_id", T(spark, sf, "labels"), "doc_id")


@query(
    "dq_mutually_exclusive_ranges",
    "SELECT event_id, user_id, next_lower FROM (SELECT event_id, user_id, lo, hi, lead(lo) OVER (PARTITION BY user_id ORDER BY lo, hi) AS next_lower "
    "FROM (SELECT event_id, user_id, event_id * 10 AS lo, event_id * 10 + CAST(floor(value) AS BIGINT) AS hi FROM events) a) b "
    "WHERE next_lower IS NOT NULL AND next_lower < hi",
)
def q_dq_ranges(spark, sf):
    e = T(spark, sf, "events").select("event_id", "user_id", (c("event_id") * 10).alias("lo"), (c("event_id") * 10 + F.floor("value").cast("long")).alias("hi"))
    return QC.mutually_exclusive_ranges(e, "lo", "hi", ["user_id"]).select("event_id", "user_id", "next_lower")


@query(
    "dq_equality",
    "(SELECT p_partkey, p_name, 'left_only' AS which FROM part EXCEPT ALL SELECT p_partkey, p_name, 'left_only' FROM part WHERE p_size > 1) "
    "UNION ALL (SELECT p_partkey, p_name, 'right_only' FROM part WHERE p_size > 1 EXCEPT ALL SELECT p_partkey, p_name, 'right_only' FROM part)",
)
def q_dq_equality(spark, sf):
    p = T(spark, sf, "part")
    return QC.equality(p, p.where(c("p_size") > 1), ["p_partkey", "p_name"])


@query(
    "dq_single_word_names",
    f"SELECT p_partkey, bname FROM {_BOTANICAL} b WHERE regexp_replace(bname, '^[^ ]+ ', '') LIKE '% %'",
)
def q_dq_single_word(spark, sf):
    """Name parts: the first word, and the rest, which should be one word too."""
    parts = _botanical(spark, sf).withColumn("first", N.split_part("bname", " ", 1)).withColumn("rest", F.regexp_replace("bname", "^[^ ]+ ", ""))
    return QC.single_word(parts, ["first", "rest"]).select("p_partkey", "bname")


@query(
    "dq_supported_abbreviations",
    f"SELECT bname, token FROM (SELECT bname, unnest(regexp_extract_all(bname, '([A-Za-z]+\\.)', 1)) AS token FROM {_BOTANICAL} b) x "
    "WHERE token NOT IN ('ssp.', 'f.', 'var.')",
)
def q_dq_abbrev(spark, sf):
    return QC.unknown_abbreviations(_botanical(spark, sf), "bname", INFRASPECIFIC_ABBREVIATIONS, pattern=r"([A-Za-z]+\.)")


@query(
    "dq_period_only_below_species",
    f"SELECT p_partkey, bname, r FROM (SELECT p_partkey, bname, CASE WHEN p_partkey % 3 = 0 THEN 'species' ELSE 'variety' END AS r FROM {_BOTANICAL} b) x "
    "WHERE bname LIKE '%.%' AND (r IS NULL OR r NOT IN ('subspecies', 'variety', 'form'))",
)
def q_dq_period(spark, sf):
    b = _botanical(spark, sf).withColumn("r", F.when(c("p_partkey") % 3 == 0, "species").otherwise("variety"))
    return QC.period_only_below_species(b, "bname", "r", RANKS_INFRASPECIFIC).select("p_partkey", "bname", "r")


@query("dq_no_digits", "SELECT doc_id FROM documents WHERE coalesce(regexp_matches(text, '[0-9]'), false) OR coalesce(regexp_matches(lang, '[0-9]'), false)")
def q_dq_no_digits(spark, sf):
    return QC.no_digits(T(spark, sf, "documents"), ["text", "lang"]).select("doc_id")


@query("dq_no_unranked", f"SELECT p_partkey, r FROM (SELECT p_partkey, {_RANK_OF_TYPE} AS r FROM part) x WHERE r = 'unranked'")
def q_dq_no_unranked(spark, sf):
    return QC.no_value(T(spark, sf, "part").select("p_partkey", _rank_of_type().alias("r")), "r").select("p_partkey", "r")


# ---------------------------------------------------------------------------
# Composite pipelines (K) on the derived sources
# ---------------------------------------------------------------------------


def _conformed(spark, sf):
    raw = derived.raw_sources(spark, sf)
    wfo = conform.conform_wfo(raw["wfo"])
    gbif = conform.conform_gbif(raw["gbif"])
    wiz = conform.conform_wiz(raw["wiz_species_names"], raw["wiz_infras"], raw["wiz_genera"], raw["wiz_classifications"])
    return wfo, gbif, wiz


def _stage(spark, sf, upto, conformed=None):
    wfo, gbif, wiz = conformed or _conformed(spark, sf)
    merged = pipeline.merge_sources(wfo, gbif, wiz)
    if upto == "merged":
        return merged
    merged = pipeline.merged_once(merged)
    taxa = pipeline.build_taxa(merged)
    if upto == "taxa":
        return taxa, merged
    dedup = pipeline.deduplicate_taxa(taxa)
    if upto == "dedup":
        return dedup
    return pipeline.fill_taxa(dedup)


_SQL = OT.sql_map()


@query("pipe_conform_wfo", _SQL["pipe_conform_wfo"])
def q_pipe_wfo(spark, sf):
    return _conformed(spark, sf)[0]


@query("pipe_conform_gbif", _SQL["pipe_conform_gbif"])
def q_pipe_gbif(spark, sf):
    return _conformed(spark, sf)[1]


@query("pipe_conform_wiz", _SQL["pipe_conform_wiz"])
def q_pipe_wiz(spark, sf):
    return _conformed(spark, sf)[2]


@query("pipe_merge", _SQL["pipe_merge"])
def q_pipe_merge(spark, sf):
    return _stage(spark, sf, "merged")


@query("pipe_taxa", _SQL["pipe_taxa"])
def q_pipe_taxa(spark, sf):
    return render_arrays(_stage(spark, sf, "taxa")[0].arrays())


@query("rank_slice_genera", _SQL["rank_slice_genera"])
def q_genera(spark, sf):
    return render_arrays(_stage(spark, sf, "taxa")[0].of_ranks(["genus"]).arrays())


@query("rank_slice_species", _SQL["rank_slice_species"])
def q_species(spark, sf):
    return render_arrays(_stage(spark, sf, "taxa")[0].of_ranks(["species", "subspecies", "variety", "form"]).arrays())


@query(
    "rank_slice_grouped",
    OT.with_stages("merged") + "SELECT name, rank, count(*) AS source_count FROM merged WHERE rank IN ('genus', 'form') GROUP BY name, rank",
)
def q_rank_slice_grouped(spark, sf):
    """Genera and forms of the grouped merge (the published taxa hold no genera)."""
    every = pipeline.build_taxa(_stage(spark, sf, "merged"), ranks=[*pipeline.RANKS_SPECIFIC, "genus"])
    return pipeline.rank_slice(every.attrs, ["genus", "form"]).select("name", "rank", "source_count")


@query("load_stamp", OT.with_stages("conf") + "SELECT id, name, true AS stamped FROM gbif_conf")
def q_load_stamp(spark, sf):
    raw = derived.raw_sources(spark, sf)["gbif"]
    stamped = conform.conform_gbif(raw, loaded_at=True)
    recent = c("dbt_loaded_at") > F.current_timestamp() - F.expr("INTERVAL 1 DAY")
    return stamped.select("id", "name", F.coalesce(recent, F.lit(False)).alias("stamped"))


@query("pipe_dedupe", _SQL["pipe_dedupe"])
def q_pipe_dedupe(spark, sf):
    return render_arrays(_stage(spark, sf, "dedup").arrays().select(*TAXA_COLUMNS))


@query("pipe_fill", _SQL["pipe_fill"])
def q_pipe_fill(spark, sf):
    mark = scratch_mark()
    filled = pipeline.filled_once(_stage(spark, sf, "filled"))
    delete_scratch(spark, mark, keep=("merged", "dedupe-members", "filled"))  # that the links and the taxa read
    return render_arrays(filled.arrays().select(*TAXA_COLUMNS))


@query("pipe_crosswalk", _SQL["pipe_crosswalk"])
def q_pipe_crosswalk(spark, sf):
    taxa, merged = _stage(spark, sf, "taxa")
    return pipeline.crosswalk_literal(taxa.attrs, merged, "WFO")


@query("pipe_crosswalk_gbif", _SQL["pipe_crosswalk_gbif"])
def q_pipe_crosswalk_gbif(spark, sf):
    taxa, merged = _stage(spark, sf, "taxa")
    return pipeline.crosswalk_literal(taxa.attrs, merged, "GBIF")


@query("crosswalk_from_ids", _SQL["crosswalk_from_ids"])
def q_crosswalk_ids(spark, sf):
    return pipeline.crosswalk_ids(_stage(spark, sf, "filled"), "wfo-")


@query("pipe_coverage_check", _SQL["pipe_coverage_check"])
def q_pipe_coverage(spark, sf):
    wfo, gbif, wiz = _conformed(spark, sf)
    wfo = scratch_table(wfo.select(*pipeline.MERGED_READ), "wfo")  # its best rows are chosen once
    return pipeline.coverage(wfo, _stage(spark, sf, "filled", (wfo, gbif, wiz)), "wfo-", "WFO")


@query(
    "dq_all_sources_present",
    OT.with_stages("filled")
    + """SELECT s.source_id, s.source_name, s.src || ' source record missing from final dataset' AS error_message
  FROM (SELECT DISTINCT id AS source_id, name AS source_name, 'GBIF' AS src FROM gbif_conf WHERE id IS NOT NULL AND id LIKE 'gbif-%'
        UNION ALL SELECT DISTINCT id, name, 'OrchidWiz' FROM wiz_conf WHERE id IS NOT NULL AND id LIKE 'wiz-%') s
  WHERE s.source_id NOT IN (SELECT e FROM (SELECT unnest(external_ids) AS e FROM filled) z WHERE e IS NOT NULL)""",
)
def q_all_sources_present(spark, sf):
    wfo, gbif, wiz = _conformed(spark, sf)
    filled = _stage(spark, sf, "filled", (wfo, gbif, wiz))
    return pipeline.coverage_all({"gbif": (gbif, "gbif-", "GBIF"), "wiz": (wiz, "wiz-", "OrchidWiz")}, filled)


_GAP_RANKS = ["family", "order", "class", "phylum", "kingdom", "subfamily", "tribe", "subtribe"]


def _gap_sql() -> str:
    joins = []
    sels = []
    for i, r in enumerate(_GAP_RANKS):
        joins.append(
            f"LEFT JOIN (SELECT k, v FROM (SELECT k, v, row_number() OVER (PARTITION BY k ORDER BY n DESC, v) AS rn FROM "
            f'(SELECT genus AS k, "{r}" AS v, count(*) AS n FROM merged WHERE genus IS NOT NULL AND "{r}" IS NOT NULL '
            f'GROUP BY genus, "{r}") a) b WHERE rn = 1) m{i} ON t.genus = m{i}.k'
        )
        sels.append(f'coalesce(t."{r}", m{i}.v) AS filled_{r}')
    return OT.with_stages("merged") + f"SELECT t.id, t.genus, {', '.join(sels)} FROM merged t " + " ".join(joins)


@query("fill_taxonomy_gaps", _gap_sql())
def q_fill_gaps(spark, sf):
    merged = _stage(spark, sf, "merged").select("id", "genus", *_GAP_RANKS)
    merged = scratch_table(merged, "merged-ranks")  # read for the modes and for the rows
    out = FL.fill_from_mode(merged, "genus", _GAP_RANKS, prefix="filled_")
    return out.select("id", "genus", *[f"filled_{r}" for r in _GAP_RANKS])


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """The whole chain: derived sources -> conform -> merge -> taxa -> dedupe ->
    fill, rendered in the source project's array format."""
    return _stage(spark, sf, "filled").arrays()
