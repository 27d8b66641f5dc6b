"""Queries on similarity, candidate pairs and record linkage."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadmill import fixed_values as fixed
from leadmill.catalog.registry import QUERIES, duck, query, source, with_source
from leadmill.functions import similarity as S
from leadmill.operators import candidates as K
from leadmill.operators.joins import spread
from leadmill.plans import linkage as L

# --- similarity of two texts per part

TEXTS = """
SELECT p_partkey, CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE concat(p_name, ' ', p_brand) END AS a,
       CASE p_partkey % 5 WHEN 0 THEN concat(p_name, ' ', p_brand) WHEN 1 THEN concat(upper(p_name), ' brand#', p_size)
            WHEN 2 THEN concat(reverse(p_name), p_brand) WHEN 3 THEN concat(substr(p_name, 2), '  ', p_type) ELSE '' END AS b
FROM {part}
"""


def texts(spark, folder):
    """The rows of TEXTS over all tasks: a small file is one task, which says little about the work of comparing."""
    return spread(source(spark, folder, TEXTS), ["p_partkey", "a", "b"])


def gram_ctes(pairs: str) -> str:
    """CTE ``cosines`` (a, b, c) for the distinct texts of a CTE with columns a and b."""
    return rf"""
    texts AS (SELECT a AS s FROM {pairs} WHERE a IS NOT NULL UNION SELECT b FROM {pairs} WHERE b IS NOT NULL),
    words AS (SELECT s, unnest(string_split_regex(trim(lower(strip_accents(s))), '\s+')) AS w FROM texts),
    padded AS (SELECT s, ' ' || w || ' ' AS p FROM words WHERE w <> ''),
    places AS (SELECT s, p, unnest(generate_series(1, length(p) - 1)) AS i FROM padded),
    grams AS (SELECT s, substr(p, i, 2) AS g, count(*) AS n FROM places GROUP BY ALL),
    norms AS (SELECT s, sqrt(sum(n * n)) AS z FROM grams GROUP BY s),
    dots AS (SELECT p.a, p.b, sum(x.n * y.n) AS d FROM (SELECT DISTINCT a, b FROM {pairs}) p
             JOIN grams x ON x.s = p.a JOIN grams y ON y.s = p.b AND y.g = x.g GROUP BY ALL),
    cosines AS (SELECT p.a, p.b, coalesce(d, 0) / (na.z * nb.z) AS c FROM (SELECT DISTINCT a, b FROM {pairs}) p
                JOIN norms na ON na.s = p.a JOIN norms nb ON nb.s = p.b LEFT JOIN dots ON dots.a = p.a AND dots.b = p.b)
    """


@query("c1_bigram_cosine", with_source(TEXTS, f", {gram_ctes('src')} SELECT p_partkey, round(c, 9) AS score FROM src LEFT JOIN cosines ON src.a = cosines.a AND src.b = cosines.b"))
def c1(spark, folder):
    scored = S.with_cosine(texts(spark, folder), "a", "b", "score")
    return scored.select("p_partkey", F.round("score", 9).alias("score"))


@query("c2_jaro_winkler", with_source(TEXTS, "SELECT p_partkey, round(jaro_winkler_similarity(a, b), 9) AS score FROM src"))
def c2(spark, folder):
    return texts(spark, folder).select("p_partkey", F.round(S.jaro_winkler(F.col("a"), F.col("b")), 9).alias("score"))


@query(
    "c3_damerau_levenshtein",
    with_source(TEXTS, "SELECT p_partkey, round(1 - damerau_levenshtein(a, b) / greatest(length(a), length(b)), 9) AS score FROM src"),
)
def c3(spark, folder):
    score = S.damerau_levenshtein(F.col("a"), F.col("b"))
    return texts(spark, folder).select("p_partkey", F.round(score, 9).alias("score"))


@query("c4_exact", with_source(TEXTS, "SELECT p_partkey, CAST(coalesce(a = b, false) AS BIGINT) AS same FROM src"))
def c4(spark, folder):
    return source(spark, folder, TEXTS).select("p_partkey", S.exact_feature(F.col("a"), F.col("b")).alias("same"))


# --- candidate pairs

@query("j4_blocking", "SELECT l_orderkey * 10 + l_linenumber AS line, o_orderkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def j4(spark, folder, key_rows=None):
    lines = source(spark, folder, "SELECT l_orderkey * 10 + l_linenumber AS line, l_orderkey AS lk FROM {lineitem}")
    orders = source(spark, folder, "SELECT o_orderkey, o_orderkey AS ok FROM {orders}")
    return K.block_pairs(lines, orders, "line", "o_orderkey", "lk", "ok", key_rows)


@query("j4_blocking_skewed", QUERIES["j4_blocking"].sql)
def j4_skewed(spark, folder):
    return j4(spark, folder, key_rows=2)


LEFT_NAMES = "SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE concat('key ', c_custkey * 7) END AS name FROM {customer}"
RIGHT_NAMES = "SELECT s_suppkey, concat('key ', s_suppkey * 71) AS name FROM {supplier}"


def neighbour_sql(left: str, right: str, lid: str, rid: str, a: str, b: str, tag: str) -> str:
    """CTE ``{tag}`` (l, r) of the sorted neighbours of two CTEs."""
    return f"""
    {tag}_ranks AS (SELECT v, dense_rank() OVER (ORDER BY v) AS rank FROM (SELECT {a} AS v FROM {left} WHERE {a} IS NOT NULL
                    UNION SELECT {b} FROM {right} WHERE {b} IS NOT NULL)),
    {tag}_left AS (SELECT {lid} AS l, unnest([rank - 1, rank, rank + 1]) AS rank FROM {left} JOIN {tag}_ranks ON v = {a}),
    {tag} AS (SELECT l, {rid} AS r FROM {tag}_left JOIN {tag}_ranks ON {tag}_left.rank = {tag}_ranks.rank JOIN {right} ON {b} = v)
    """


@query(
    "j5_sorted_neighbourhood",
    f"WITH a AS ({duck(LEFT_NAMES)}), b AS ({duck(RIGHT_NAMES)}), "
    + neighbour_sql("a", "b", "c_custkey", "s_suppkey", "a.name", "b.name", "near")
    + " SELECT l AS c_custkey, r AS s_suppkey FROM near",
)
def j5(spark, folder, key_rows=None):
    left, right = source(spark, folder, LEFT_NAMES), source(spark, folder, RIGHT_NAMES)
    return K.neighbour_pairs(left, right, "c_custkey", "s_suppkey", "name", "name", key_rows=key_rows)


@query("j5_sorted_neighbourhood_skewed", QUERIES["j5_sorted_neighbourhood"].sql)
def j5_skewed(spark, folder):
    return j5(spark, folder, key_rows=1)


# --- linkage

ACCOUNTS = """
SELECT p_partkey AS SF_Index, concat('A', p_partkey) AS SF_AccountId, concat('D', p_partkey) AS SF_DNBCompanyProfile,
       concat(p_name, ' ', p_brand) AS SF_AccountName, p_name AS SF_AccountNameClean, p_name AS SF_CleanName,
       concat('www.', replace(p_name, ' ', '-'), '.com') AS SF_WebsiteClean, concat(replace(p_name, ' ', '-'), '.com') AS SF_DomainClean,
       p_type AS SF_BillingCity, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_brand END AS SF_BillingStateClean,
       concat('zip ', p_size) AS SF_BillingPostalCode, p_type AS SF_BillingCountryClean, concat('DUNS', p_size) AS SF_DUNSNumber,
       p_retailprice AS SF_AnnualRevenue, CAST(p_size AS DOUBLE) AS SF_NumberofEmployees, CAST(p_partkey % 9 AS BIGINT) AS SF_SIC,
       p_type AS SF_BillingState, p_brand AS SF_BillingCountry
FROM {part}
"""
PROVIDER = """
SELECT p_partkey + 1 AS {p}_Index, concat('{k}', p_partkey - p_partkey % 3) AS {p}_{id},
       CASE p_partkey % 3 WHEN 0 THEN concat(p_name, ' ', p_brand, 's') WHEN 1 THEN p_name ELSE concat('x', p_type) END AS {p}_{name},
       CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_name END AS {p}_{name}Clean,
       concat('www.', replace(p_name, ' ', '-'), '.com') AS {p}_WebsiteClean, concat(replace(p_name, ' ', '_'), '.com') AS {p}_DomainClean,
       lower(p_type) AS {p}_City, p_brand AS {p}_StateClean, concat('zip ', p_size) AS {p}_PostalCode, p_type AS {p}_CountryClean,
       concat('DUNS', p_size) AS {p}_DUNSNumber, p_retailprice AS {p}_AnnualRevenue,
       CAST(p_size AS DOUBLE) AS {p}_NumberofEmployees, CAST(p_partkey % 9 AS BIGINT) AS {p}_SICCode
FROM <part>
"""


def provider(prefix: str, key: str, id_name: str, name: str) -> str:
    filled = PROVIDER.replace("{p}", prefix).replace("{k}", key).replace("{id}", id_name).replace("{name}", name)
    return filled.replace("<part>", "{part}")


ZI = provider("ZI", "A", "AccountId", "AccountName")
DNB = provider("DNB", "D", "Id", "BusinessName")
INPUTS = """
SELECT s_suppkey AS INP_Index, concat(p_name, ' ', p_brand) AS INP_Company,
       CASE s_suppkey % 4 WHEN 0 THEN p_name WHEN 1 THEN concat(p_name, 's') WHEN 2 THEN NULL ELSE upper(p_name) END AS INP_Outreach_Account_Natural_Name,
       concat(upper(substr(p_name, 1, 1)), substr(p_name, 2), ' ', p_brand) AS INP_COMPANY_NAME,
       p_type AS INP_STATE, concat(p_brand, '0') AS INP_COUNTRY
FROM {supplier} JOIN {part} ON s_suppkey = p_partkey
"""


def link_sql(left: str, right: str, lid: str, rid: str, blocks, neighbours, features, method: str = "cosine") -> str:
    """CTEs up to ``matches`` (l, r, features) for the brute-force linkage.

    ``features`` are (left, right, label) with an optional own method.
    """
    parts = [f"lt AS ({left})", f"rt AS ({right})"]
    found = []
    for i, (a, b) in enumerate(blocks):
        parts.append(f"b{i} AS (SELECT lt.{lid} AS l, rt.{rid} AS r FROM lt JOIN rt ON lt.{a} = rt.{b})")
        found.append(f"SELECT l, r FROM b{i}")
    for i, (a, b) in enumerate(neighbours):
        parts.append(neighbour_sql("lt", "rt", f"lt.{lid}", f"rt.{rid}", f"lt.{a}", f"rt.{b}", f"n{i}"))
        found.append(f"SELECT l, r FROM n{i}")
    parts.append(f"cand AS ({' UNION '.join(found)})")
    own = [(*f, method)[:4] for f in features]
    joined = f"cand JOIN lt ON lt.{lid} = cand.l JOIN rt ON rt.{rid} = cand.r"
    cosine = [f for f in own if f[3] == "cosine"]
    if cosine:
        pairs = " UNION ".join(f"SELECT lt.{a} AS a, rt.{b} AS b FROM {joined}" for a, b, _, _ in cosine)
        parts.append(f"pairs AS ({pairs})")
        parts.append(gram_ctes("pairs"))
    cells, lookups = [], []
    for i, (a, b, label, how) in enumerate(own):
        if how == "cosine":
            lookups.append(f"LEFT JOIN cosines c{i} ON c{i}.a = lt.{a} AND c{i}.b = rt.{b}")
            hit = f"c{i}.c >= 0.85"
        elif how == "exact":
            hit = f"lt.{a} = rt.{b}"
        elif how == "jarowinkler":
            hit = f"jaro_winkler_similarity(lt.{a}, rt.{b}) >= 0.85"
        else:
            hit = f"1 - damerau_levenshtein(lt.{a}, rt.{b}) / greatest(length(lt.{a}), length(rt.{b})) >= 0.85"
        cells.append(f'CAST(coalesce({hit}, false) AS BIGINT) AS "{label}"')
    parts.append(f"scored AS (SELECT l, r, {', '.join(cells)} FROM {joined} {' '.join(lookups)})")
    total = " + ".join(f'"{f[2]}"' for f in own)
    parts.append(f"matches AS (SELECT * FROM scored WHERE {total} >= 1)")
    return "WITH " + ", ".join(parts)


def preset_features(rules, numbers: tuple[str, ...] = ("AnnualRevenue", "NumberofEmployees", "SIC")):
    return [
        (a, b, f"{a.replace('SF_', 'Match_')}_{b}", "exact" if a.removeprefix("SF_") in numbers else "cosine")
        for a, bs in rules["compare"].items()
        for b in bs
    ]


def labels_of(features) -> list[str]:
    return [f[2] for f in features]


def score_of(features) -> str:
    return " + ".join(f'"{f[2]}"' for f in features)


ZI_FEATURES = preset_features(fixed.LINK_RULES["ZoomInfo"])
DNB_FEATURES = preset_features(fixed.LINK_RULES["DNB"])
NAME_FEATURES = preset_features(fixed.LINK_RULES["name"])
ZI_SQL = link_sql(duck(ACCOUNTS), duck(ZI), "SF_Index", "ZI_Index", [("SF_AccountId", "ZI_AccountId")], [], ZI_FEATURES)


def filled(features) -> str:
    return ", ".join(f'coalesce("{f[2]}", 0) AS "{f[2]}"' for f in features)


@query(
    "k1_link_provider",
    ZI_SQL + f"""
    SELECT lt.SF_Index AS "SF_Index", lt.SF_AccountName AS "SF_AccountName", {filled(ZI_FEATURES)},
           coalesce({score_of(ZI_FEATURES)}, 0) AS "Match_zScore", r AS "ZI_Index", rt.ZI_AccountName AS "ZI_AccountName"
    FROM lt LEFT JOIN matches ON l = lt.SF_Index LEFT JOIN rt ON rt.ZI_Index = r
    """,
)
def k1(spark, folder, whole_blocks=None):
    linked = L.link_records(
        source(spark, folder, ACCOUNTS), source(spark, folder, ZI), "SF_Index", "ZI_Index", "ZoomInfo", whole_blocks=whole_blocks
    )
    return linked.select("SF_Index", "SF_AccountName", *labels_of(ZI_FEATURES), "Match_zScore", "ZI_Index", "ZI_AccountName")


@query("k1_link_provider_tokens", QUERIES["k1_link_provider"].sql)
def k1_tokens(spark, folder):
    return k1(spark, folder, whole_blocks=False)


@query(
    "k1_link_secondary",
    ZI_SQL + f"""
    SELECT rt.ZI_Index AS "ZI_Index", rt.ZI_AccountId AS "ZI_AccountId", coalesce({score_of(ZI_FEATURES)}, 0) AS "Match_zScore",
           l AS "SF_Index", lt.SF_AccountId AS "SF_AccountId"
    FROM rt LEFT JOIN matches ON r = rt.ZI_Index LEFT JOIN lt ON lt.SF_Index = l
    """,
)
def k1_secondary(spark, folder):
    linked = L.link_records(
        source(spark, folder, ACCOUNTS), source(spark, folder, ZI), "SF_Index", "ZI_Index", "ZoomInfo", secondary=True
    )
    return linked.select("ZI_Index", "ZI_AccountId", "Match_zScore", "SF_Index", "SF_AccountId")


NAME_SQL = link_sql(
    duck(ACCOUNTS), duck(INPUTS), "SF_Index", "INP_Index", [],
    [("SF_AccountName", "INP_Company"), ("SF_AccountName", "INP_Outreach_Account_Natural_Name"),
     ("SF_CleanName", "INP_Outreach_Account_Natural_Name")], NAME_FEATURES,
)


@query(
    "k1_link_names",
    NAME_SQL + f"""
    SELECT lt.SF_Index AS "SF_Index", {filled(NAME_FEATURES)}, coalesce({score_of(NAME_FEATURES)}, 0) AS "Match_zScore",
           r AS "INP_Index" FROM lt LEFT JOIN matches ON l = lt.SF_Index
    """,
)
def k1_names(spark, folder, whole_blocks=None):
    linked = L.link_records(
        source(spark, folder, ACCOUNTS), source(spark, folder, INPUTS), "SF_Index", "INP_Index", "name", whole_blocks=whole_blocks
    )
    return linked.select("SF_Index", *labels_of(NAME_FEATURES), "Match_zScore", "INP_Index")


@query("k1_link_names_tokens", QUERIES["k1_link_names"].sql)
def k1_names_tokens(spark, folder):
    return k1_names(spark, folder, whole_blocks=False)


# columns of unequal types are not compared, so the revenue pair below gives no feature
CHOICE_RULES = {
    "index": {"block": {"SF_AccountId": ["ZI_AccountId"]}},
    "compare": {"SF_AccountName": ["ZI_AccountName", "ZI_City"], "SF_SIC": ["ZI_SICCode"], "SF_AnnualRevenue": ["ZI_SICCode"]},
}
CHOICE_FEATURES = [
    ("SF_AccountName", "ZI_AccountName", "Match_AccountName_ZI_AccountName", "cosine"),
    ("SF_AccountName", "ZI_City", "Match_AccountName_ZI_City", "cosine"),
    ("SF_SIC", "ZI_SICCode", "Match_SIC_ZI_SICCode", "exact"),
]


@query(
    "k2_comparator_choice",
    link_sql(duck(ACCOUNTS), duck(ZI), "SF_Index", "ZI_Index", [("SF_AccountId", "ZI_AccountId")], [], CHOICE_FEATURES)
    + """ SELECT l AS "SF_Index", r AS "ZI_Index", * EXCLUDE (l, r) FROM matches""",
)
def k2(spark, folder):
    left, right = source(spark, folder, ACCOUNTS), source(spark, folder, ZI)
    return L.matching_pairs(left, right, "SF_Index", "ZI_Index", L.make_plan(left, right, CHOICE_RULES))


@query(
    "k3_rule_presets",
    link_sql(duck(ACCOUNTS), duck(DNB), "SF_Index", "DNB_Index", [("SF_DNBCompanyProfile", "DNB_Id")], [], DNB_FEATURES)
    + """ SELECT l AS "SF_Index", r AS "DNB_Index", * EXCLUDE (l, r) FROM matches""",
)
def k3(spark, folder):
    left, right = source(spark, folder, ACCOUNTS), source(spark, folder, DNB)
    plan = L.make_plan(left, right, L.link_rules("DNB"))
    return L.matching_pairs(left, right, "SF_Index", "DNB_Index", plan)


def any_hit(*words: str) -> str:
    named = [f'"{label}"' for label in labels_of(ZI_FEATURES) if any(w in label for w in words)]
    return " + ".join(named)


ACCOUNT_HITS = any_hit("Match_AccountName", "Match_WebsiteClean", "Match_Domain")


@query(
    "k4_confidence",
    ZI_SQL + f"""
    , points AS (SELECT l, r, {ACCOUNT_HITS} AS account, CASE WHEN {ACCOUNT_HITS} > 0 THEN 40 ELSE 0 END
      + CASE WHEN {any_hit('Match_BillingCity')} > 0 THEN 20 ELSE 0 END + CASE WHEN {any_hit('Match_BillingStateClean')} > 0 THEN 10 ELSE 0 END
      + CASE WHEN {any_hit('Match_BillingPostalCode')} > 0 THEN 20 ELSE 0 END
      + CASE WHEN {any_hit('Match_BillingCountryClean')} > 0 THEN 10 ELSE 0 END AS p FROM matches)
    SELECT lt.SF_Index AS "SF_Index", r AS "ZI_Index", coalesce(account, 0) AS "Match_zAccount", CAST(coalesce(p, 0) AS BIGINT) AS "Match_zConfidence",
           CASE WHEN p IS NULL THEN NULL WHEN p <= 0 THEN '0 to 0' WHEN p <= 50 THEN '1 to 50' WHEN p <= 60 THEN '51 to 60'
                WHEN p <= 70 THEN '61 to 70' WHEN p <= 80 THEN '71 to 80' ELSE '80+' END AS "Match_zConfidence_bins"
    FROM lt LEFT JOIN points ON l = lt.SF_Index
    """,
)
def k4(spark, folder):
    linked = L.link_records(
        source(spark, folder, ACCOUNTS), source(spark, folder, ZI), "SF_Index", "ZI_Index", "ZoomInfo", confidence_score=True
    )
    return linked.select("SF_Index", "ZI_Index", "Match_zAccount", "Match_zConfidence", "Match_zConfidence_bins")


OLD_FEATURES = [
    ("INP_Company", "SF_AccountName", "Match_AccountName_INP_Company", "jarowinkler"),
    ("INP_Outreach_Account_Natural_Name", "SF_AccountName", "Match_AccountName_INP_Outreach_Account_Natural_Name", "jarowinkler"),
    ("INP_Outreach_Account_Natural_Name", "SF_CleanName", "Match_CleanName_INP_Outreach_Account_Natural_Name", "jarowinkler"),
]


@query(
    "k5_old_matcher",
    link_sql(
        duck(INPUTS), duck(ACCOUNTS), "INP_Index", "SF_Index", [],
        [("INP_Company", "SF_AccountName"), ("INP_Outreach_Account_Natural_Name", "SF_AccountName"),
         ("INP_Outreach_Account_Natural_Name", "SF_CleanName")], OLD_FEATURES,
    ) + f"""
    SELECT lt.INP_Index AS "INP_Index", lt.INP_Company AS "INP_Company", {filled(OLD_FEATURES)},
           coalesce({score_of(OLD_FEATURES)}, 0) AS "Match_zScore", rt.SF_AccountId AS "SF_AccountId",
           coalesce(rt.SF_AnnualRevenue, 0) AS "SF_AnnualRevenue"
    FROM lt LEFT JOIN matches ON l = lt.INP_Index LEFT JOIN rt ON rt.SF_Index = r
    """,
)
def k5(spark, folder, whole_blocks=None):
    found = L.match_records(
        source(spark, folder, INPUTS), source(spark, folder, ACCOUNTS), "INP_Index", "SF_Index", "name", whole_blocks
    )
    return found.select(
        "INP_Index", "INP_Company", *labels_of(OLD_FEATURES), "Match_zScore", "SF_AccountId", "SF_AnnualRevenue"
    )


@query("k5_old_matcher_tokens", QUERIES["k5_old_matcher"].sql)
def k5_tokens(spark, folder):
    return k5(spark, folder, whole_blocks=False)


ADHOC = INPUTS.replace("INP_Company,", "INP_Company_0,").replace("INP_COMPANY_NAME", "INP_COMPANY")
LOWER_ADHOC = f"SELECT INP_Index, lower(INP_COMPANY) AS INP_COMPANY, lower(INP_Outreach_Account_Natural_Name) AS INP_Outreach_Account_Natural_Name, lower(INP_STATE) AS INP_STATE, lower(INP_COUNTRY) AS INP_COUNTRY FROM ({duck(ADHOC)})"
LOWER_ACCOUNTS = f"SELECT SF_AccountId, lower(SF_AccountName) AS SF_AccountName, lower(SF_CleanName) AS SF_CleanName, lower(SF_BillingState) AS SF_BillingState, lower(SF_BillingCountry) AS SF_BillingCountry FROM ({duck(ACCOUNTS)})"
FIELD_FEATURES = [
    ("INP_COMPANY", "SF_AccountName", "Match_AccountName", "damerau_levenshtein"),
    ("INP_Outreach_Account_Natural_Name", "SF_CleanName", "Match_CleanName", "jarowinkler"),
    ("INP_STATE", "SF_BillingState", "Match_BillingState", "damerau_levenshtein"),
    ("INP_COUNTRY", "SF_BillingCountry", "Match_BillingCountry", "damerau_levenshtein"),
]
FIELD_SQL = link_sql(
    LOWER_ADHOC, LOWER_ACCOUNTS, "INP_Index", "SF_AccountId", [("INP_COMPANY", "SF_CleanName")],
    [("INP_COMPANY", "SF_AccountName"), ("INP_Outreach_Account_Natural_Name", "SF_CleanName")], FIELD_FEATURES,
) + ', kept AS (SELECT * FROM matches WHERE "Match_AccountName" + "Match_CleanName" > 0)'


def _fields(spark, folder, whole_blocks=None, matcher=L.potential_matches):
    left, right = source(spark, folder, ADHOC), source(spark, folder, ACCOUNTS)
    return left, right, matcher(left, right, "INP_Index", "SF_AccountId", L.field_mapping("adhoc"), whole_blocks)


@query(
    "k6_potential_matches",
    FIELD_SQL + f"""
    SELECT l AS "INP_Index", r AS "SF_AccountId", {', '.join(f'"{f[2]}"' for f in FIELD_FEATURES)},
           {score_of(FIELD_FEATURES)} AS "Match_Score" FROM kept
    """,
)
def k6(spark, folder):
    return _fields(spark, folder)[2]


@query("k6_potential_matches_tokens", QUERIES["k6_potential_matches"].sql)
def k6_tokens(spark, folder):
    return _fields(spark, folder, whole_blocks=False)[2]


# the oldest comparison takes the method by field: Jaro-Winkler for the clean name, Damerau-Levenshtein elsewhere
@query(
    "k7_compare_strings",
    with_source(
        TEXTS,
        """
        SELECT p_partkey, CAST(coalesce(1 - damerau_levenshtein(a, b) / greatest(length(a), length(b)) >= 0.85, false) AS BIGINT) AS "Match_AccountName",
               CAST(coalesce(jaro_winkler_similarity(a, b) >= 0.85, false) AS BIGINT) AS "Match_CleanName" FROM src
        """,
    ),
)
def k7(spark, folder):
    df = texts(spark, folder).withColumnsRenamed({"a": "l:a", "b": "r:b"})
    cells = [L._feature(L.Feature("a", "b", f.label, f.method)).alias(f.label)
             for f in L.string_features({"SF_AccountName": "a", "SF_CleanName": "a"})]
    return df.select("p_partkey", *cells)


@query(
    "k8_format_matches",
    FIELD_SQL + f"""
    SELECT o.INP_Index AS "INP_Index", coalesce(o.INP_COMPANY, '') AS "INP_COMPANY",
           coalesce(o.INP_Outreach_Account_Natural_Name, '') AS "INP_Outreach_Account_Natural_Name",
           coalesce({score_of(FIELD_FEATURES)}, 0) AS "Match_Score", coalesce(r, '') AS "SF_AccountId",
           coalesce(s.SF_AccountName, '') AS "SF_AccountName", coalesce(s.SF_AnnualRevenue, 0) AS "SF_AnnualRevenue"
    FROM ({duck(ADHOC)}) o LEFT JOIN kept ON l = o.INP_Index LEFT JOIN ({duck(ACCOUNTS)}) s ON s.SF_AccountId = r
    """,
)
def k8(spark, folder, small=None):
    left, right, matches = _fields(spark, folder, matcher=L.potential_links)
    return L.format_matches(matches, left, right, "INP_Index", "SF_AccountId", small).select(
        "INP_Index", "INP_COMPANY", "INP_Outreach_Account_Natural_Name", "Match_Score", "SF_AccountId", "SF_AccountName",
        "SF_AnnualRevenue",
    )


@query("k8_format_matches_large", QUERIES["k8_format_matches"].sql)
def k8_large(spark, folder):
    return k8(spark, folder, small=False)


@query(
    "k9_field_presets",
    link_sql(
        f"SELECT ZI_Index, lower(ZI_AccountName) AS ZI_AccountName, lower(ZI_WebsiteClean) AS ZI_WebsiteClean FROM ({duck(ZI)})",
        f"SELECT SF_AccountId, lower(SF_AccountName) AS SF_AccountName, lower(SF_WebsiteClean) AS SF_WebsiteClean FROM ({duck(ACCOUNTS)})",
        "ZI_Index", "SF_AccountId", [], [("ZI_AccountName", "SF_AccountName")],
        [("ZI_AccountName", "SF_AccountName", "Match_AccountName", "damerau_levenshtein"),
         ("ZI_WebsiteClean", "SF_WebsiteClean", "Match_WebsiteClean", "damerau_levenshtein")],
    ) + """ SELECT l AS "ZI_Index", r AS "SF_AccountId", "Match_AccountName", "Match_WebsiteClean",
            "Match_AccountName" + "Match_WebsiteClean" AS "Match_Score" FROM matches WHERE "Match_AccountName" > 0""",
)
def k9(spark, folder):
    preset = L.field_mapping("ZoomInfo")
    fields = {k: preset[k] for k in ("SF_AccountName", "SF_WebsiteClean")}
    return L.potential_matches(source(spark, folder, ZI), source(spark, folder, ACCOUNTS), "ZI_Index", "SF_AccountId", fields)


@query(
    "j3_match_output",
    """
    SELECT c_custkey AS "L", n_name, p.score, p."R", s.s_name, s.s_acctbal FROM customer JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN (SELECT o_custkey AS "L", o_orderkey AS score, o_custkey % 60 AS "R" FROM orders) p ON p."L" = c_custkey
    LEFT JOIN supplier s ON s.s_suppkey = p."R"
    """,
)
def j3(spark, folder):
    left = source(spark, folder, "SELECT c_custkey AS L, n_name FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey")
    right = source(spark, folder, "SELECT s_suppkey AS R, s_name, s_acctbal FROM {supplier}")
    pairs = source(spark, folder, "SELECT o_custkey AS L, o_orderkey AS score, o_custkey % 60 AS R FROM {orders}")
    return L.join_output(left, pairs, right, "L", "R", ("_df1", "_df2"))
