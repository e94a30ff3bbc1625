"""DuckDB SQL for the derived sources and the K1-K9 stages.

Written independently of the Spark code as plain SQL over the driver's
tables: the derived raw sources (mirroring ``plans/derived.py``), then each
stage expressed with windows, GROUP BY and joins. Used as the correctness
oracle; array columns are rendered with ``array_to_string(.., ',')``.
"""

from __future__ import annotations

# FIXED VALUES, stated here again on purpose: a wrong value in the library must
# not pass by being wrong on both sides.
MERGED_ATTRIBUTES = ["generic_name", "specific_name", "infra_name", "section", "subgenus", "genus", "subtribe", "tribe", "subfamily",
 "family", "order", "class", "phylum", "kingdom"]
TAXA_ID_ORDER = ["kingdom", "phylum", "class", "order", "family", "subfamily", "tribe", "subtribe", "genus", "subgenus", "section",
 "generic_name", "specific_name", "infra_name", "name", "rank"]
FILL_ORDER = {"subtribe": ["genus", "subfamily", "tribe"],
 "tribe": ["genus", "subtribe", "subfamily"],
 "subfamily": ["genus", "subtribe", "tribe", "family"],
 "family": ["genus", "subtribe", "tribe", "subfamily", "order"],
 "order": ["genus", "subtribe", "tribe", "subfamily", "family", "class"],
 "class": ["genus", "subtribe", "tribe", "subfamily", "family", "order", "phylum"],
 "phylum": ["genus", "subtribe", "tribe", "subfamily", "family", "order", "class", "kingdom"],
 "kingdom": ["genus", "subtribe", "tribe", "subfamily", "family", "order", "class", "phylum"]}
WIZ_MAIN_RANK_RULES = [([" var. ", " v. ", " nv. ", " Br. fol. "], "variety"), ([" ssp. ", " subsp. "], "subspecies"),
 ([" f. ", " forma ", " nm. ", " monstr. "], "form"), ([" h.v. "], "variety"), ([" h.f. "], "form"),
 ([" sp. "], "species")]
WIZ_MAIN_SPLIT_MARKERS = [" var. ", " ssp. ", " subsp. ", " f. ", " h.v. ", " h.f. "]
WIZ_INFRA_RANK_RULES = [([" var. "], "variety"), ([" ssp. ", " subsp. "], "subspecies"), ([" f. ", " forma "], "form"),
 ([" nothovar. "], "variety")]
WIZ_INFRA_SPLIT_MARKERS = [" var. ", " ssp. ", " subsp. ", " nothovar. ", " f. "]
WIZ_NAME_REWRITES = [(" h.v. ", " var. "), (" h.f. ", " f. "), (" v. ", " var. "), (" nm. ", " f. "), (" nv. ", " var. "),
 (" monstr. ", " f. "), (" subsp. ", " ssp. "), (" sp. ", " "), (" Br. fol. ", " var. ")]


def W(x: str) -> str:
    return f"translate(CAST({x} AS VARCHAR), '0123456789', 'aeioulmnrs')"


def CAP(w: str) -> str:
    return f"(upper(substr({w}, 1, 1)) || substr({w}, 2))"


def Q(c: str) -> str:
    return f'"{c}"'


_LI = f"""li AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate,
    {CAP(W('l_partkey'))} AS g,
    {W('l_suppkey')} AS e,
    {W('l_orderkey % 97')} AS i,
    CASE l_linenumber WHEN 1 THEN 'species' WHEN 2 THEN 'subspecies' WHEN 3 THEN 'variety'
      WHEN 4 THEN 'form' WHEN 5 THEN 'genus' WHEN 6 THEN 'species' ELSE 'unranked' END AS r
  FROM lineitem)"""

_GBIF_RAW = f"""gbif_raw AS (
  SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR)) AS taxonID,
    CASE WHEN r <> 'genus' THEN CAST(l_partkey AS VARCHAR) END AS parentNameUsageID,
    CASE WHEN l_returnflag = 'R' THEN CAST(l_suppkey AS VARCHAR) END AS acceptedNameUsageID,
    CASE WHEN l_linestatus = 'F' THEN CAST(l_orderkey AS VARCHAR) END AS originalNameUsageID,
    r AS taxonRank,
    CASE WHEN l_partkey % 17 <> 0 THEN g END AS genericName,
    CASE WHEN r <> 'genus' THEN e || 'us' END AS specificEpithet,
    CASE WHEN r IN ('subspecies', 'variety', 'form') THEN i || 'a' END AS infraspecificEpithet,
    CASE WHEN l_suppkey % 5 <> 0 THEN concat_ws(' ', g, CASE WHEN r <> 'genus' THEN e || 'us' END) END AS canonicalName,
    concat_ws(' ', g, CASE WHEN r <> 'genus' THEN e || 'us' END) || ' L.' AS scientificName,
    CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' AND l_tax > 0.06 THEN 'Animalia' ELSE 'Plantae' END AS kingdom,
    CASE WHEN l_partkey % 11 <> 0 THEN 'Tracheophyta' END AS phylum,
    CASE WHEN l_partkey % 3 = 0 THEN 'Liliopsida' WHEN l_partkey % 3 = 1 THEN 'Magnoliopsida' END AS "class",
    CASE WHEN l_partkey % 7 <> 0 THEN {CAP(W('l_partkey % 29'))} || 'ales' END AS "order",
    CASE WHEN l_partkey % 13 <> 0 THEN {CAP(W('l_partkey % 211'))} || 'aceae' END AS family,
    g AS genus,
    CASE WHEN l_discount > 0.08 THEN 'SYNONYM' WHEN l_discount < 0.02 THEN 'ACCEPTED' ELSE 'accepted' END AS taxonomicStatus,
    CASE WHEN l_tax > 0.05 THEN 'Legitimate' END AS nomenclaturalStatus
  FROM li)"""

_WFO_RAW = f"""wfo_li AS (
  SELECT *, CASE WHEN l_linenumber = 7 THEN 'section' ELSE r END AS r2 FROM li),
wfo_raw AS (
  SELECT 'wfo-' || CASE WHEN l_suppkey % 3 = 0 THEN '1000' ELSE '0000' END
           || lpad(CAST(l_orderkey AS VARCHAR), 8, '0') || '-' || CAST(l_linenumber AS VARCHAR) AS taxonid,
    CASE WHEN r2 <> 'genus' THEN 'wfo-p' || CAST(l_partkey AS VARCHAR) END AS parentnameusageid,
    CAST(NULL AS VARCHAR) AS acceptednameusageid,
    CASE WHEN l_returnflag = 'A' THEN 'wfo-o' || CAST(l_orderkey AS VARCHAR) END AS originalnameusageid,
    CASE WHEN l_orderkey % 101 = 0 THEN '  '
         WHEN r2 = 'section' THEN g || ' sect. ' || {CAP('e')}
         WHEN r2 = 'genus' THEN g
         ELSE g || ' ' || (e || 'us') || coalesce(
              CASE r2 WHEN 'subspecies' THEN ' subsp. ' WHEN 'variety' THEN ' var. ' WHEN 'form' THEN ' f. ' END
              || (CASE WHEN r2 IN ('subspecies', 'variety', 'form') THEN i || 'a' END), '') END AS scientificname,
    CASE WHEN r2 NOT IN ('genus', 'section') THEN e || 'us' END AS specificepithet,
    CASE WHEN r2 IN ('subspecies', 'variety', 'form') THEN i || 'a' END AS infraspecificepithet,
    CASE WHEN l_partkey % 13 <> 0 THEN {CAP(W('l_partkey % 211'))} || 'aceae' END AS family,
    CASE WHEN l_partkey % 4 <> 0 THEN {CAP(W('l_partkey % 53'))} || 'oideae' END AS subfamily,
    CASE WHEN l_partkey % 6 <> 0 THEN {CAP(W('l_partkey % 41'))} || 'eae' END AS tribe,
    CASE WHEN l_partkey % 5 <> 0 THEN {CAP(W('l_partkey % 37'))} || 'inae' END AS subtribe,
    g AS genus,
    CASE WHEN l_suppkey % 9 = 0 THEN {CAP('e')} END AS subgenus,
    r2 AS taxonrank,
    CASE WHEN l_returnflag = 'R' THEN 'Synonym' WHEN l_returnflag = 'N' THEN 'Accepted'
         WHEN l_linestatus = 'F' THEN 'Accepted' ELSE 'accepted' END AS taxonomicstatus,
    CASE WHEN l_tax > 0.06 THEN 'Illegitimate' WHEN l_tax > 0.03 THEN 'legitimate' END AS nomenclaturalstatus,
    CASE WHEN l_suppkey % 2 = 0 THEN 'urn:lsid:ipni.org:names:' || CAST(l_partkey AS VARCHAR) || '-1'
         ELSE 'ipni-' || CAST(l_partkey AS VARCHAR) END AS scientificnameid,
    CASE WHEN l_partkey % 8 = 0 THEN 'kew-' || CAST(l_partkey AS VARCHAR) END AS tplid,
    CASE WHEN l_partkey % 10 <> 0 THEN strftime(l_shipdate, '%Y-%m-%d') END AS created
  FROM wfo_li)"""

_PART = f"""pb AS (
  SELECT p_partkey, p_size, p_type, p_brand, sp,
    {CAP(W('sp'))} AS gname,
    upper(substr({W('sp')}, 1, 2)) || '.' AS gabbr,
    {W('p_size')} || 'ea' AS ep
  FROM (SELECT *, CAST(floor(p_partkey / 3) AS BIGINT) AS sp FROM part)),
wiz_sn AS (
  SELECT CASE WHEN p_partkey % 19 <> 0 THEN CAST(p_partkey AS VARCHAR) END AS SpName,
    CAST(sp AS VARCHAR) AS Species,
    CASE WHEN p_partkey % 23 <> 0 THEN gabbr END AS Genus,
    ep || CASE p_type WHEN 'SMALL' THEN ''
                      WHEN 'MEDIUM' THEN ' var. ' || {W('p_partkey % 13')}
                      WHEN 'LARGE' THEN ' subsp. ' || {W('p_partkey % 13')}
                      WHEN 'PROMO' THEN ' v. ' || {W('p_partkey % 13')}
                      WHEN 'ECONOMY' THEN ' h.f. ' || {W('p_partkey % 13')}
                      ELSE ' sp. ' END AS Name
  FROM pb),
wiz_inf AS (
  SELECT CAST(sp AS VARCHAR) AS Species, gabbr AS Genus,
    ep || CASE p_size % 4 WHEN 0 THEN ' ssp. ' WHEN 1 THEN ' var. ' WHEN 2 THEN ' nothovar. ' ELSE ' forma ' END
       || {W('p_partkey % 7')} || 'i' AS Name
  FROM pb),
wiz_gen AS (
  SELECT gabbr AS Genus, min(gname) AS Name,
    max({CAP(W('sp % 5'))} || 'oideae') AS Subfamily,
    max(CASE WHEN sp % 3 <> 0 THEN {CAP(W('sp % 11'))} || 'eae' END) AS Tribe,
    max({CAP(W('sp % 17'))} || 'inae') AS Subtribe
  FROM pb GROUP BY gabbr),
wiz_cls AS (
  SELECT CAST(sp AS VARCHAR) AS Species,
    max(CASE WHEN p_brand <> 'Brand#1' THEN {CAP(W('sp % 31'))} || 'ia' END) AS Subgenus,
    min({CAP(W('sp % 43'))} || 'ae') AS Section
  FROM pb GROUP BY CAST(sp AS VARCHAR))"""


def _status_case(col: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN upper({col}) = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {whens} ELSE lower({col}) END"


_CONF_COLS = [
    "id", "parent_id", "accepted_id", "original_id", "name", "generic_name", "specific_name", "infra_name",
    "kingdom", "phylum", "class", "order", "family", "subfamily", "tribe", "subtribe", "genus", "subgenus",
    "rank", "taxonomic_status", "nomenclatural_status", "ipni_id", "tpl_id", "data_source", "section",
]


def _sel(mapping: dict[str, str]) -> str:
    return ",\n    ".join(f"{mapping.get(c, 'CAST(NULL AS VARCHAR)')} AS {Q(c)}" for c in _CONF_COLS)


_WFO_CONF = """wfo_conf AS (
  SELECT {cols}
  FROM (SELECT *, row_number() OVER (PARTITION BY scientificname
          ORDER BY CASE WHEN taxonid LIKE 'wfo-0000%' THEN 1 ELSE 2 END, created DESC NULLS FIRST, taxonid) AS rn
        FROM wfo_raw
        WHERE taxonid IS NOT NULL AND scientificname IS NOT NULL AND trim(scientificname) <> ''
          AND taxonomicstatus = 'Accepted') d
  WHERE rn = 1)""".format(cols=_sel({
    "id": "taxonid", "parent_id": "parentnameusageid", "accepted_id": "acceptednameusageid",
    "original_id": "originalnameusageid", "name": "scientificname", "specific_name": "specificepithet",
    "infra_name": "infraspecificepithet", "family": "family", "subfamily": "subfamily", "tribe": "tribe",
    "subtribe": "subtribe", "genus": "genus", "subgenus": "subgenus", "rank": "taxonrank",
    "taxonomic_status": _status_case("taxonomicstatus", {"ACCEPTED": "accepted", "SYNONYM": "synonym", "INVALID": "invalid", "UNRESOLVED": "unresolved", "MISAPPLIED": "misapplied"}),
    "nomenclatural_status": _status_case("nomenclaturalstatus", {"LEGITIMATE": "legitimate", "ILLEGITIMATE": "illegitimate", "SUPERFLUOUS": "superfluous", "REJECTED": "rejected", "INVALID": "invalid"}),
    "ipni_id": "CASE WHEN scientificnameid LIKE 'urn:lsid:ipni.org:names:%' THEN split_part(scientificnameid, ':', -1) ELSE scientificnameid END",
    "tpl_id": "tplid", "data_source": "'WFO'",
}))


def _gbif_name() -> str:
    parts = []
    for rank, marker in (("subspecies", "subsp."), ("variety", "var."), ("form", "f.")):
        parts.append(
            f"WHEN taxonRank = '{rank}' AND infraspecificEpithet IS NOT NULL "
            f"THEN concat(genericName, ' ', specificEpithet, ' {marker} ', infraspecificEpithet)"
        )
    return "CASE " + " ".join(parts) + " ELSE coalesce(canonicalName, scientificName) END"


_GBIF_CONF = """gbif_conf AS (
  SELECT {cols}
  FROM gbif_raw WHERE kingdom = 'Plantae' AND lower(taxonomicStatus) = 'accepted')""".format(cols=_sel({
    "id": "concat('gbif-', taxonID)",
    "parent_id": "CASE WHEN parentNameUsageID IS NOT NULL THEN 'gbif-' || parentNameUsageID END",
    "accepted_id": "CASE WHEN acceptedNameUsageID IS NOT NULL THEN 'gbif-' || acceptedNameUsageID END",
    "original_id": "CASE WHEN originalNameUsageID IS NOT NULL THEN 'gbif-' || originalNameUsageID END",
    "name": _gbif_name(), "specific_name": "specificEpithet", "infra_name": "infraspecificEpithet",
    "kingdom": "kingdom", "phylum": "phylum", "class": '"class"', "order": '"order"', "family": "family",
    "genus": "genus", "generic_name": "genericName", "rank": "taxonRank",
    "taxonomic_status": "lower(taxonomicStatus)", "nomenclatural_status": "lower(nomenclaturalStatus)",
    "data_source": "'GBIF'",
}))


def _like_any(col: str, toks) -> str:
    return " OR ".join(f"{col} LIKE '%{t}%'" for t in toks)


def _wiz_part_sql(src: str, spname: str, rank_rules, markers, default_rank: str) -> str:
    rank = "CASE " + " ".join(f"WHEN {_like_any('Name', toks)} THEN '{lab}'" for toks, lab in rank_rules) + f" ELSE '{default_rank}' END"
    before = "CASE " + " ".join(f"WHEN Name LIKE '%{m}%' THEN split_part(Name, '{m}', 1)" for m in markers) + " ELSE Name END"
    after = "CASE " + " ".join(f"WHEN Name LIKE '%{m}%' THEN split_part(Name, '{m}', 2)" for m in markers) + " ELSE NULL END"
    return f"""SELECT {spname} AS spname_id, CAST(Species AS INTEGER) AS species_id, Genus AS genus_abbrev, Name AS full_name,
      {rank} AS determined_rank, {before} AS species_epithet, {after} AS infraspecific_epithet
    FROM {src}
    WHERE Name IS NOT NULL AND trim(Name) <> '' AND Genus IS NOT NULL AND trim(Genus) <> ''"""


def _wiz_conf() -> str:
    main = _wiz_part_sql("wiz_sn", "CAST(SpName AS INTEGER)", WIZ_MAIN_RANK_RULES, WIZ_MAIN_SPLIT_MARKERS, "species")
    infra = _wiz_part_sql("wiz_inf", "CAST(NULL AS INTEGER)", WIZ_INFRA_RANK_RULES, WIZ_INFRA_SPLIT_MARKERS, "subspecies")
    rewrite = "CASE " + " ".join(
        f"WHEN j.full_name LIKE '%{t}%' THEN replace(j.full_name, '{t}', '{r}')" for t, r in WIZ_NAME_REWRITES
    ) + " ELSE j.full_name END"
    cols = _sel({
        "id": "CASE WHEN j.spname_id IS NOT NULL THEN concat('wiz-', j.spname_id) ELSE concat('wiz-infra-', j.species_id, '-', j.seq) END",
        "parent_id": "CASE WHEN j.determined_rank IN ('subspecies', 'variety', 'form') AND p.species_id IS NOT NULL THEN concat('wiz-', p.parent_spname) END",
        "name": f"concat(coalesce(j.g_name, j.genus_abbrev), ' ', {rewrite})",
        "specific_name": "j.species_epithet", "infra_name": "j.infraspecific_epithet",
        "kingdom": "'Plantae'", "phylum": "'Tracheophyta'", "class": "'Liliopsida'", "order": "'Asparagales'",
        "family": "'Orchidaceae'", "subfamily": "j.g_subfamily", "tribe": "j.g_tribe", "subtribe": "j.g_subtribe",
        "genus": "coalesce(j.g_name, j.genus_abbrev)", "subgenus": "j.c_subgenus",
        "generic_name": "coalesce(j.g_name, j.genus_abbrev)", "rank": "j.determined_rank",
        "taxonomic_status": "'accepted'", "nomenclatural_status": "'valid'", "data_source": "'OrchidWiz'",
        "section": "j.c_section",
    })
    return f"""wiz_main AS (
    {main}),
wiz_infra AS (
    {infra}),
wiz_all AS (SELECT * FROM wiz_main UNION ALL SELECT * FROM wiz_infra),
wiz_joined AS (
  SELECT t.*, g.Name AS g_name, g.Subfamily AS g_subfamily, g.Tribe AS g_tribe, g.Subtribe AS g_subtribe,
    c.Subgenus AS c_subgenus, c.Section AS c_section,
    row_number() OVER (PARTITION BY t.species_id, t.genus_abbrev ORDER BY t.full_name NULLS LAST,
      t.spname_id NULLS LAST, g.Name NULLS LAST, g.Subfamily NULLS LAST, g.Tribe NULLS LAST, g.Subtribe NULLS LAST,
      c.Subgenus NULLS LAST, c.Section NULLS LAST, t.determined_rank NULLS LAST) AS seq
  FROM wiz_all t
  LEFT JOIN wiz_gen g ON t.genus_abbrev = g.Genus
  LEFT JOIN wiz_cls c ON CAST(t.species_id AS VARCHAR) = CAST(c.Species AS VARCHAR)),
wiz_par AS (
  SELECT species_id, genus_abbrev, species_epithet, min(spname_id) AS parent_spname
  FROM wiz_main WHERE determined_rank = 'species'
  GROUP BY species_id, genus_abbrev, species_epithet),
wiz_conf AS (
  SELECT {cols}
  FROM wiz_joined j
  LEFT JOIN wiz_par p ON j.species_id = p.species_id AND j.genus_abbrev = p.genus_abbrev
    AND j.species_epithet = p.species_epithet)"""


_MERGED_COLS = [
    "id", "parent_id", "accepted_id", "original_id", "name", "generic_name", "specific_name", "infra_name",
    "kingdom", "phylum", "class", "order", "family", "subfamily", "tribe", "subtribe", "genus", "subgenus",
    "section", "rank", "taxonomic_status", "nomenclatural_status", "ipni_id", "tpl_id", "data_source",
]


def _merged() -> str:
    norm = "name"
    for pat, rep in ((r" subsp\. ", " ssp. "), (r" fo\. ", " f. "), (r" sect\. [A-Z][a-z]*", ""), (r" subg\. [A-Z][a-z]*", "")):
        norm = f"regexp_replace({norm}, '{pat}', '{rep}', 'g')"
    m = {c: Q(c) for c in _MERGED_COLS}
    m["name"] = norm
    m["subgenus"] = "coalesce(subgenus, nullif(regexp_extract(name, ' subg\\. ([A-Z][a-z]*)', 1), ''))"
    m["section"] = "coalesce(section, nullif(regexp_extract(name, ' sect\\. ([A-Z][a-z]*)', 1), ''))"
    cols = ",\n    ".join(f"{m[c]} AS {Q(c)}" for c in _MERGED_COLS)
    conf = ", ".join(Q(c) for c in _CONF_COLS)
    return f"""unioned AS (
  SELECT {conf} FROM wfo_conf UNION ALL SELECT {conf} FROM gbif_conf UNION ALL SELECT {conf} FROM wiz_conf),
merged AS (
  SELECT {cols}
  FROM unioned WHERE rank <> 'unranked')"""


def _taxa() -> str:
    attrs = ",\n      ".join(f"max({Q(a)}) AS {Q(a)}" for a in MERGED_ATTRIBUTES)
    order = ", ".join(f"{Q(c)} NULLS LAST" for c in TAXA_ID_ORDER)
    return f"""grouped AS (
  SELECT name, rank,
      {attrs},
      list(id ORDER BY id NULLS FIRST, data_source NULLS FIRST) AS external_ids,
      list(data_source ORDER BY id NULLS FIRST, data_source NULLS FIRST) AS data_sources
  FROM merged WHERE rank IN ('species', 'subspecies', 'variety', 'form')
  GROUP BY name, rank),
taxa AS (
  SELECT CAST(row_number() OVER (ORDER BY {order}) AS BIGINT) AS id, * FROM grouped)"""


_TAXA_OUT = ["id", "name", "rank"] + MERGED_ATTRIBUTES + ["external_ids", "data_sources"]


def _dedup() -> str:
    cols = ", ".join(Q(c) for c in _TAXA_OUT)
    keep = ", ".join(
        "CASE WHEN c.grp_n > 1 THEN m.merged_ids ELSE c.external_ids END AS external_ids" if x == "external_ids" else f"c.{Q(x)}"
        for x in _TAXA_OUT
    )
    return f"""dup_candidates AS (
  SELECT t.*,
    count(*) OVER (PARTITION BY generic_name, specific_name, infra_name) AS grp_n,
    row_number() OVER (PARTITION BY generic_name, specific_name, infra_name
      ORDER BY len(data_sources) DESC, CASE rank WHEN 'subspecies' THEN 1 WHEN 'variety' THEN 2 WHEN 'form' THEN 3 ELSE 4 END,
               name NULLS FIRST, rank NULLS FIRST, id NULLS FIRST) AS rn
  FROM taxa t
  WHERE generic_name IS NOT NULL AND specific_name IS NOT NULL AND infra_name IS NOT NULL),
dup_ids AS (
  SELECT generic_name, specific_name, infra_name, list_sort(list_distinct(flatten(list(external_ids)))) AS merged_ids
  FROM dup_candidates GROUP BY generic_name, specific_name, infra_name),
dedup AS (
  SELECT {keep}
  FROM dup_candidates c JOIN dup_ids m
    ON c.generic_name = m.generic_name AND c.specific_name = m.specific_name AND c.infra_name = m.infra_name
  WHERE c.rn = 1
  UNION ALL
  SELECT {cols} FROM taxa
  WHERE generic_name IS NULL OR specific_name IS NULL OR infra_name IS NULL)"""


def _fill() -> str:
    levels = dict.fromkeys(lv for chain in FILL_ORDER.values() for lv in chain)
    lookups = {lv: [target for target, chain in FILL_ORDER.items() if lv in chain] for lv in levels}
    ctes = []
    for level, targets in lookups.items():
        counts = " UNION ALL ".join(
            f"SELECT {Q(level)} AS k, '{t}' AS target, {Q(t)} AS v, count(*) AS n FROM dedup "
            f"WHERE {Q(level)} IS NOT NULL AND {Q(t)} IS NOT NULL GROUP BY {Q(level)}, {Q(t)}"
            for t in targets
        )
        best = ", ".join(f"max(CASE WHEN target = '{t}' THEN v END) AS best_{t}" for t in targets)
        ctes.append(
            f"""m_{level} AS (
  SELECT k, {best} FROM (
    SELECT k, target, v, row_number() OVER (PARTITION BY k, target ORDER BY n DESC, v) AS rn
    FROM ({counts}) x) y
  WHERE rn = 1 GROUP BY k)"""
        )
    sel = []
    for c in _TAXA_OUT:
        if c in FILL_ORDER:
            chain = ", ".join(f"m_{lv}.best_{c}" for lv in FILL_ORDER[c])
            sel.append(f"coalesce(d.{Q(c)}, {chain}) AS {Q(c)}")
        elif c == "generic_name":
            sel.append('coalesce(d.generic_name, d.genus) AS generic_name')
        else:
            sel.append(f"d.{Q(c)}")
    joins = " ".join(f"LEFT JOIN m_{lv} ON d.{Q(lv)} = m_{lv}.k" for lv in lookups)
    return ",\n".join(ctes) + f""",
filled AS (
  SELECT {", ".join(sel)}
  FROM dedup d {joins})"""


def with_stages(upto: str) -> str:
    """``WITH`` clause defining every CTE up to and including ``upto``."""
    order = ["raw", "conf", "merged", "taxa", "dedup", "filled"]
    parts = [_LI, _GBIF_RAW, _WFO_RAW, _PART]
    if order.index(upto) >= 1:
        parts += [_WFO_CONF, _GBIF_CONF, _wiz_conf()]
    if order.index(upto) >= 2:
        parts.append(_merged())
    if order.index(upto) >= 3:
        parts.append(_taxa())
    if order.index(upto) >= 4:
        parts.append(_dedup())
    if order.index(upto) >= 5:
        parts.append(_fill())
    return "WITH " + ",\n".join(parts) + "\n"


def taxa_select(rel: str) -> str:
    cols = []
    for c in _TAXA_OUT:
        if c in ("external_ids", "data_sources"):
            cols.append(f"array_to_string({c}, ',') AS {c}")
        else:
            cols.append(Q(c))
    return f"SELECT {', '.join(cols)} FROM {rel}"


def conf_select(rel: str, cols=None) -> str:
    return f"SELECT {', '.join(Q(c) for c in (cols or _CONF_COLS))} FROM {rel}"


def sql_map() -> dict[str, str]:
    merged_cols = ", ".join(Q(c) for c in _MERGED_COLS)
    return {
        "pipe_conform_wfo": with_stages("conf") + conf_select("wfo_conf"),
        "pipe_conform_gbif": with_stages("conf") + conf_select("gbif_conf"),
        "pipe_conform_wiz": with_stages("conf") + conf_select("wiz_conf"),
        "pipe_merge": with_stages("merged") + f"SELECT {merged_cols} FROM merged",
        "pipe_taxa": with_stages("taxa") + taxa_select("taxa"),
        "rank_slice_genera": with_stages("taxa") + taxa_select("taxa") + " WHERE rank = 'genus'",
        "rank_slice_species": with_stages("taxa") + taxa_select("taxa") + " WHERE rank IN ('species', 'subspecies', 'variety', 'form')",
        "pipe_dedupe": with_stages("dedup") + taxa_select("dedup"),
        "pipe_fill": with_stages("filled") + taxa_select("filled"),
        "pipe_crosswalk": with_stages("taxa")
        + """SELECT t.id AS id, d.id AS external_id FROM taxa t JOIN merged d
  ON t.rank = d.rank AND t.generic_name = d.generic_name AND t.specific_name = d.specific_name AND t.infra_name = d.infra_name
  WHERE d.data_source = 'WFO'""",
        "pipe_crosswalk_gbif": with_stages("taxa")
        + """SELECT t.id AS id, d.id AS external_id FROM taxa t JOIN merged d
  ON t.rank = d.rank AND t.generic_name = d.generic_name AND t.specific_name = d.specific_name AND t.infra_name = d.infra_name
  WHERE d.data_source = 'GBIF'""",
        "crosswalk_from_ids": with_stages("filled")
        + "SELECT id, external_id FROM (SELECT id, unnest(external_ids) AS external_id FROM filled) x WHERE external_id LIKE 'wfo-%'",
        "pipe_coverage_check": with_stages("filled")
        + """SELECT s.source_id, s.source_name, 'WFO source record missing from final dataset' AS error_message
  FROM (SELECT DISTINCT id AS source_id, name AS source_name FROM wfo_conf WHERE id IS NOT NULL AND id LIKE 'wfo-%') s
  WHERE s.source_id NOT IN (SELECT e FROM (SELECT unnest(external_ids) AS e FROM filled) z WHERE e IS NOT NULL)""",
    }
