"""Queries on text, company names, jobs and places."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadmill import fixed_values as fixed
from leadmill.catalog.registry import QUERIES, duck, query, read, source, with_source
from leadmill.functions import text
from leadmill.operators import cleanse, geo
from leadmill.operators.joins import attach

URLS = """
SELECT page_id, CASE page_id % 6
         WHEN 0 THEN url
         WHEN 1 THEN replace(url, '://', '://www.')
         WHEN 2 THEN concat('  ', url, '  ')
         WHEN 3 THEN replace(replace(url, '.com/', '.com:8080/'), '.net/', '.net:443/')
         WHEN 4 THEN nullif(concat('', replace(url, 'https://', '')), url)
         ELSE CASE WHEN page_id % 4 = 1 THEN '' END END AS url
FROM {pages}
"""


@query(
    "t1_website_domain",
    with_source(
        URLS,
        r"""
        , hosts AS (SELECT page_id, url, split_part(regexp_replace(regexp_replace(trim(url), '^(https?://)?(www\.)?', ''),
                    ':\d{2,5}', '', 'g'), '/', 1) AS host FROM src)
        SELECT page_id, CASE WHEN url <> '' THEN CASE WHEN host LIKE 'www.%' THEN host ELSE 'www.' || host END END AS website,
               CASE WHEN url <> '' THEN regexp_replace(host, '^www\.', '') END AS domain
        FROM hosts
        """,
    ),
)
def t1(spark, folder):
    found = cleanse.clean_website_domain(source(spark, folder, URLS), "url", "website", "domain")
    return found.select("page_id", "website", "domain")


# company names made of part names and types, with brackets, separators, legal forms and stopwords
NAMES = """
SELECT p_partkey, CASE p_partkey % 5
         WHEN 0 THEN concat(p_name, ' INC.')
         WHEN 1 THEN concat('the ', p_name, '-', lower(p_type), ', ', p_brand, ' GmbH')
         WHEN 2 THEN concat(p_name, ' (', p_brand, ') of asia')
         WHEN 3 THEN concat(p_name, ' [', p_brand)
         END AS name, p_name, p_brand, p_type
FROM {part}
"""
STOPWORDS = "SELECT DISTINCT CASE WHEN p_type = 'ECONOMY' THEN 'the' ELSE lower(p_type) END AS string_field_0 FROM {part}"
PLACES = "SELECT DISTINCT r_name AS string_field_0 FROM {region}"

# the pieces have one blank between words, so title case is upper case after a blank, digit, # or -
TITLE = (
    "list_reduce(list_prepend('', list_transform(generate_series(1, length({0})), lambda i: "
    "CASE WHEN i = 1 OR NOT regexp_matches({0}[i - 1], '[A-Za-z]') THEN upper({0}[i]) ELSE lower({0}[i]) END)), lambda a, b: a || b)"
)


@query(
    "n1_clean_names",
    with_source(
        NAMES,
        rf"""
        , cut AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN p_name
                  WHEN 1 THEN 'the ' || p_name || '-' || lower(p_type) || ', ' || p_brand ELSE name END AS c FROM src)
        , titled AS (SELECT p_partkey, CASE WHEN c IS NOT NULL THEN {TITLE.format('c')} END AS t FROM cut)
        , bare AS (SELECT p_partkey, trim(regexp_replace(regexp_replace(regexp_replace(t,
                   '\([^()]*\)|\[[^\[\]]*$', ' ', 'g'), '[,-]', ' ', 'g'), ' +', ' ', 'g')) AS t FROM titled)
        SELECT p_partkey, trim(regexp_replace(trim(regexp_replace(t, '\b(?:the|large|medium|promo|small|standard)\b', '', 'gi')),
               '\b(?:AFRICA|AMERICA|ASIA|EUROPE|MIDDLE EAST)\b', '', 'gi')) AS name FROM bare
        """,
    ),
)
def n1(spark, folder):
    cleaner = cleanse.BusinessNameCleaner(source(spark, folder, STOPWORDS), source(spark, folder, PLACES))
    return source(spark, folder, NAMES).select("p_partkey", cleaner.clean(F.col("name")).alias("name"))


@query(
    "n2_legal_forms",
    with_source(
        NAMES,
        f"""
        , cut AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN p_name
                  WHEN 1 THEN 'the ' || p_name || '-' || lower(p_type) || ', ' || p_brand ELSE name END AS c FROM src)
        SELECT p_partkey, CASE WHEN c IS NOT NULL THEN {TITLE.format('c')} END AS name FROM cut
        """,
    ),
)
def n2(spark, folder):
    return source(spark, folder, NAMES).select("p_partkey", text.business_name(F.col("name")).alias("name"))


@query(
    "n3_brackets",
    with_source(
        NAMES,
        r"""
        SELECT p_partkey, trim(regexp_replace(regexp_replace(regexp_replace(name,
               '\([^()]*\)|\[[^\[\]]*\]|\([^()]*$|\[[^\[\]]*$', ' ', 'g'), '[,-]', ' ', 'g'), '\s+', ' ', 'g')) AS name FROM src
        """,
    ),
)
def n3(spark, folder):
    return source(spark, folder, NAMES).select("p_partkey", text.drop_bracketed(F.col("name")).alias("name"))


@query(
    "n4_stopwords_countries",
    with_source(
        NAMES,
        r"""
        SELECT p_partkey, trim(regexp_replace(trim(regexp_replace(name, '\b(?:the|large|medium|promo|small|standard)\b', '', 'gi')),
               '\b(?:AFRICA|AMERICA|ASIA|EUROPE|MIDDLE EAST)\b', '', 'gi')) AS name FROM src
        """,
    ),
)
def n4(spark, folder):
    stopwords = cleanse.word_list(source(spark, folder, STOPWORDS))
    places = cleanse.word_list(source(spark, folder, PLACES))
    name = text.drop_pattern(F.col("name"), text.word_pattern(stopwords, literal=False))
    name = text.drop_pattern(name, text.word_pattern(places, literal=True))
    return source(spark, folder, NAMES).select("p_partkey", name.alias("name"))


# --- jobs

JOBS = """
SELECT o_orderkey, CASE o_orderkey % 9 WHEN 0 THEN 'C Level' WHEN 1 THEN 'C-Suite' WHEN 2 THEN 'VP Level' WHEN 3 THEN ''
         WHEN 4 THEN NULL WHEN 5 THEN 'Director' WHEN 6 THEN 'SVP' WHEN 7 THEN 'vp' ELSE o_orderpriority END AS level,
       CASE o_orderkey % 11 WHEN 0 THEN 'VP Finance' WHEN 1 THEN 'Head of Sales Operations' WHEN 2 THEN 'Security'
         WHEN 3 THEN NULL WHEN 4 THEN 'Marketing' WHEN 5 THEN 'LEGAL counsel' WHEN 6 THEN 'Talent partner'
         WHEN 7 THEN 'G&A' WHEN 8 THEN 'Logistics' WHEN 9 THEN 'Board' ELSE o_orderpriority END AS function
FROM {orders}
"""
LEVELS = "('C-Level', 'Director', 'Manager', 'SVP', 'VP')"


@query(
    "l1_job_level",
    with_source(
        JOBS,
        f"""
        , named AS (SELECT o_orderkey, CASE level WHEN 'C Level' THEN 'C-Level' WHEN 'C-Suite' THEN 'C-Level'
                    WHEN 'VP Level' THEN 'VP' WHEN '' THEN 'Others' ELSE level END AS level FROM src)
        SELECT o_orderkey, CASE WHEN level IN {LEVELS} THEN level ELSE 'Others' END AS level FROM named
        """,
    ),
)
def l1(spark, folder):
    return cleanse.fix_job_level(source(spark, folder, JOBS), "level", rename=True).select("o_orderkey", "level")


def _function_cases() -> str:
    return " ".join(
        f"WHEN regexp_matches(coalesce(function, 'Others'), '{'|'.join(words)}', 'i') THEN '{name}'"
        for name, words in fixed.JOB_FUNCTION_WORDS.items()
    )


@query(
    "l2_job_function",
    with_source(
        JOBS,
        f"""
        SELECT o_orderkey, CASE {_function_cases()} WHEN function IN ({', '.join(f"'{f}'" for f in fixed.JOB_FUNCTIONS)})
               THEN function ELSE 'Others' END AS function FROM src
        """,
    ),
)
def l2(spark, folder):
    return cleanse.fix_job_function(source(spark, folder, JOBS), "function", by_words=True).select("o_orderkey", "function")


# --- places: nations as countries, with codes that clash across columns

COUNTRY_DIM = """
SELECT n_nationkey AS Id, CASE WHEN n_nationkey = 3 THEN 'Russia' ELSE n_name END AS Name,
       CASE WHEN n_nationkey = 3 THEN 'Russian Federation' ELSE n_name END AS CountryName,
       concat('N', n_nationkey) AS ISO3, CASE WHEN n_nationkey = 7 THEN 'nation_8' ELSE concat('I', n_nationkey) END AS ISO2
FROM {nation}
"""
STATE_DIM = """
SELECT n_nationkey AS Id, n_name AS Name, n_name AS StateName, concat('S', n_nationkey % 20) AS Code FROM {nation}
"""
TYPED = """
SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN concat('NATION_', c_nationkey) WHEN 1 THEN concat(' nation_', c_nationkey, ' ')
         WHEN 2 THEN concat('i', c_nationkey) WHEN 3 THEN concat('n', c_nationkey) WHEN 4 THEN 'Russia'
         WHEN 5 THEN concat(' Atlantis ', c_nationkey) END AS place,
       CASE c_custkey % 4 WHEN 0 THEN concat('s', c_nationkey) WHEN 1 THEN concat('Nation_', c_nationkey)
         WHEN 2 THEN concat('NATION_', c_nationkey) END AS state
FROM {customer}
"""


def lookup_sql(dim: str, target: str, columns: list[str], key: str) -> str:
    """CTEs ``dim`` and ``lookup`` (k, name): later columns win, then later rows."""
    entries = " UNION ALL ".join(
        f"SELECT {key.format(c)} AS k, {target} AS name, {i} AS rank, Id FROM dim" for i, c in enumerate(columns)
    )
    return (
        f"dim AS ({duck(dim)}), entries AS ({entries}), lookup AS (SELECT k, arg_max(name, rank * 1000000 + Id) AS name "
        "FROM entries WHERE k IS NOT NULL GROUP BY k)"
    )


def standard_sql(dim, target, columns, column, names, trim: bool, keep: bool) -> str:
    key = "lower(trim({0}))" if trim else "lower({0})"
    clean, valid, clean_valid = names
    kept = f"coalesce(lookup.name, trim({column}))" if keep else "lookup.name"
    raw = f'CAST(coalesce({column} IN (SELECT {target} FROM dim), false) AS BIGINT) AS "{valid}", ' if valid else ""
    return (
        f"WITH src AS ({duck(TYPED)}), {lookup_sql(dim, target, columns, key)} "
        f'SELECT c_custkey, {kept} AS "{clean}", {raw}'
        f'CAST(coalesce({kept} IN (SELECT {target} FROM dim), false) AS BIGINT) AS "{clean_valid}" '
        f"FROM src LEFT JOIN lookup ON k = {key.format(column)}"
    )


def _geo(spark, folder) -> geo.GeoStandardiser:
    return geo.GeoStandardiser(source(spark, folder, COUNTRY_DIM), source(spark, folder, STATE_DIM))


@query(
    "g1_standardise_country",
    standard_sql(COUNTRY_DIM, "CountryName", ["CountryName", "Name", "Name", "ISO3", "ISO2"], "place",
                 ("placeClean", "placeValid", "placeCleanValid"), trim=True, keep=True),
)
def g1(spark, folder):
    found = _geo(spark, folder).standardise_country(source(spark, folder, TYPED), "place")
    return found.select("c_custkey", "placeClean", "placeValid", "placeCleanValid")


@query(
    "g2_standardise_state",
    standard_sql(STATE_DIM, "StateName", ["StateName", "Name", "Name", "Code"], "state",
                 ("stateClean", "stateValid", "stateCleanValid"), trim=True, keep=True),
)
def g2(spark, folder):
    found = _geo(spark, folder).standardise_state(source(spark, folder, TYPED), "state")
    return found.select("c_custkey", "stateClean", "stateValid", "stateCleanValid")


SPELT = """
SELECT c_custkey, CASE c_nationkey % 5 WHEN 0 THEN 'Russia' WHEN 1 THEN 'Man (Isle of)' WHEN 2 THEN 'South Korea'
         WHEN 3 THEN 'Spain' END AS Name,
       CASE c_nationkey % 5 WHEN 0 THEN 'Bavaria' WHEN 1 THEN 'Lower Saxony' WHEN 2 THEN 'Metro Manila' WHEN 3 THEN 'Texas' END AS State,
       CASE c_nationkey % 5 WHEN 0 THEN 'Cook County' WHEN 1 THEN 'City of York' WHEN 2 THEN 'London Borough of Barnet'
         WHEN 3 THEN 'Texas' END AS State_Name
FROM {customer}
"""
COUNTRY_CASE = "CASE Name WHEN 'Russia' THEN 'Russian Federation' WHEN 'Man (Isle of)' THEN 'Isle of Man' WHEN 'South Korea' THEN 'Korea, Republic of' ELSE Name END"


@query("g3_fix_country", with_source(SPELT, f'SELECT c_custkey, {COUNTRY_CASE} AS "CountryName" FROM src'))
def g3(spark, folder):
    return geo.fix_country(source(spark, folder, SPELT)).select("c_custkey", "CountryName")


@query(
    "g4_fix_states",
    with_source(
        SPELT,
        """SELECT c_custkey, CASE State WHEN 'Bavaria' THEN 'Bayern' WHEN 'Lower Saxony' THEN 'Niedersachsen'
           WHEN 'Metro Manila' THEN 'Manila' ELSE State END AS "StateName" FROM src""",
    ),
)
def g4(spark, folder):
    return geo.fix_states(source(spark, folder, SPELT), "State").select("c_custkey", "StateName")


# of the letters that do not decompose, the documents hold the sharp s only
@query("g5_ascii_names", "SELECT doc_id, strip_accents(replace(text, 'ß', 'ss')) AS ascii FROM documents")
def g5(spark, folder):
    documents = read(spark, folder, "documents")
    return documents.select("doc_id", text.to_ascii(F.col("text")).alias("ascii"))


OLD_COUNTRY_DIM = COUNTRY_DIM.replace("AS Name", "AS Country_Name").replace("AS ISO3", "AS Country_ISO3").replace(
    "AS ISO2", "AS Country_ISO2"
)
OLD_STATE_DIM = "SELECT n_nationkey AS Id, n_name AS State_Name, concat('S', n_nationkey % 20) AS State_Code FROM {nation}"
CITY_DIM = "SELECT n_nationkey AS Id, n_name AS City_Name FROM {nation}"


@query(
    "g6_old_countries",
    standard_sql(OLD_COUNTRY_DIM, "CountryName", fixed.OLD_COUNTRY_LOOKUP, "place",
                 ("StandardizedCountry", "ValidCountry", "ValidStandardizedCountry"), trim=False, keep=False),
)
def g6(spark, folder):
    found = geo.standardize_countries(source(spark, folder, TYPED), source(spark, folder, OLD_COUNTRY_DIM), "place", "Id")
    return found.select("c_custkey", "StandardizedCountry", "ValidCountry", "ValidStandardizedCountry")


@query(
    "g7_old_states",
    standard_sql(OLD_STATE_DIM, "State_Name", fixed.OLD_STATE_LOOKUP, "state",
                 ("StandardizedState", "ValidState", "ValidStandardizedState"), trim=False, keep=False),
)
def g7(spark, folder):
    found = geo.standardize_states(source(spark, folder, TYPED), source(spark, folder, OLD_STATE_DIM), "state", "Id")
    return found.select("c_custkey", "StandardizedState", "ValidState", "ValidStandardizedState")


@query(
    "g8_old_cities",
    standard_sql(CITY_DIM, "City_Name", fixed.OLD_CITY_LOOKUP, "state",
                 ("StandardizedCity", None, "ValidStandardizedCity"), trim=False, keep=False),
)
def g8(spark, folder):
    found = geo.standardize_cities(source(spark, folder, TYPED), source(spark, folder, CITY_DIM), "state", "Id")
    return found.select("c_custkey", "StandardizedCity", "ValidStandardizedCity")


@query(
    "g9_state_words",
    with_source(
        SPELT,
        f"""SELECT c_custkey, regexp_replace(State_Name, '{'|'.join(fixed.STATE_WORDS)}', '', 'g') AS "State_Name" FROM src""",
    ),
)
def g9(spark, folder):
    return geo.drop_state_words(source(spark, folder, SPELT)).select("c_custkey", "State_Name")


@query("g10_old_fix_country", with_source(SPELT.replace("AS Name", "AS Country_Name"),
                                          f'SELECT c_custkey, {COUNTRY_CASE.replace("Name ", "Country_Name ", 1).replace("ELSE Name", "ELSE Country_Name")} AS "CountryName" FROM src'))
def g10(spark, folder):
    named = source(spark, folder, SPELT.replace("AS Name", "AS Country_Name"))
    return geo.fix_country(named, "Country_Name").select("c_custkey", "CountryName")


@query(
    "j6_dictionary_lookup",
    "SELECT o_orderkey, n_name AS nation FROM orders LEFT JOIN customer ON c_custkey = o_custkey + 10 "
    "LEFT JOIN nation ON n_nationkey = c_nationkey",
)
def j6(spark, folder, small=None):
    named = source(
        spark, folder, "SELECT c_custkey AS key, n_name AS nation FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey"
    )
    orders = source(spark, folder, "SELECT o_orderkey, o_custkey + 10 AS key FROM {orders}")
    return attach(orders, named, ["key"], small=small).select("o_orderkey", "nation")


@query("j6_lookup_large", QUERIES["j6_dictionary_lookup"].sql)
def j6_large(spark, folder):
    return j6(spark, folder, small=False)


@query(
    "j7_membership",
    f"WITH src AS ({duck(TYPED)}) SELECT c_custkey, CAST(coalesce(state IN (SELECT n_name FROM nation), false) AS BIGINT) AS known FROM src",
)
def j7(spark, folder):
    names = source(spark, folder, "SELECT DISTINCT n_name AS state, true AS hit FROM {nation}")
    found = attach(source(spark, folder, TYPED), names, ["state"])
    return found.select("c_custkey", F.coalesce(F.col("hit").cast("bigint"), F.lit(0).cast("bigint")).alias("known"))
