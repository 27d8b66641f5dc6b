"""Queries on sources, sinks, columns, row order and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadmill.catalog.registry import duck, duck_text_of, query, read, source, text_of, with_source
from leadmill.operators import columns as C, reshape as R
from leadmill.session import scratch_path
from leadmill.sources import extracts, tables

# --- sources and sinks

REVENUE_SQL = """
SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS lines, sum(l_quantity) AS quantity
FROM {lineitem} GROUP BY l_returnflag, l_linestatus
"""

@query("s1_run_sql", duck(REVENUE_SQL))
def s1(spark, folder):
    return tables.run_sql(spark, REVENUE_SQL, lineitem=read(spark, folder, "lineitem"))


@query("s2_replace_table", "SELECT * FROM customer")
def s2(spark, folder):
    path = scratch_path(spark, "replaced")
    tables.replace_table(read(spark, folder, "orders"), path=path)
    tables.replace_table(read(spark, folder, "customer"), path=path)
    return spark.read.parquet(path)


@query("s3_append_table", "SELECT * FROM supplier UNION ALL SELECT * FROM supplier")
def s3(spark, folder):
    path = scratch_path(spark, "appended")
    tables.append_table(read(spark, folder, "supplier"), path=path)
    tables.append_table(read(spark, folder, "supplier"), path=path)
    return spark.read.parquet(path)


@query("s4_read_csv", "SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_size, p_retailprice FROM part")
def s4(spark, folder):
    path = scratch_path(spark, "parts")
    tables.write_csv(read(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice"), path)
    return tables.read_csv(spark, f"{path}.csv")


@query("s5_write_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def s5(spark, folder):
    path = scratch_path(spark, "customers")
    customers = read(spark, folder, "customer")
    tables.write_csv(customers, path)
    return tables.read_csv(spark, f"{path}.csv", schema=customers.schema)


WORDS = "SELECT DISTINCT lower(p_type) AS string_field_0 FROM {part}"
COUNTRY_WORDS = "SELECT DISTINCT CASE r_name WHEN 'EUROPE' THEN 'France' ELSE r_name END AS string_field_0 FROM {region}"
ACCOUNTS = """
SELECT concat('A', c_custkey) AS code, concat(c_name, ', Inc. (old) the France') AS Account_Name,
       c_name AS Outreach_Account_Natural_Name, c_mktsegment AS Type,
       CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE concat('https://www.c', c_custkey, '.example.com:8080/a') END AS Website,
       CASE WHEN c_custkey % 9 = 0 THEN 'n/a' ELSE CAST(c_custkey * 10 AS STRING) END AS Annual_Revenue,
       c_custkey % 13 AS NumberofEmployees,
       CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE '71.9' END AS SIC_Code,
       'P' AS IndustryProfileFinal, 'Q' AS IndustrySubPortfolio_GTMPlanningFinal, 'R' AS Primary_Industry_c,
       'S' AS Sub_Industry, 'City' AS Billing_City, 'State' AS BillingState, '00100' AS BillingPostalCode,
       'Country' AS BillingCountry, 'pod' AS Final_pod, 'geo' AS Final_Geo, 'D1' AS DNBDUNSNumber,
       'rec' AS DnBCompanyRecord
FROM {customer}
"""


@query(
    "s6_accounts",
    with_source(
        ACCOUNTS,
        """
        SELECT code AS "SF_AccountId", Account_Name AS "SF_AccountName", Type AS "SF_AccountType",
               'www.c' || substr(code, 2) || '.example.com' AS "SF_WebsiteClean",
               'c' || substr(code, 2) || '.example.com' AS "SF_DomainClean",
               Outreach_Account_Natural_Name || ' Inc. The' AS "SF_AccountNameClean",
               TRY_CAST(Annual_Revenue AS DOUBLE) AS "SF_AnnualRevenue",
               CAST(NumberofEmployees AS DOUBLE) AS "SF_NumberofEmployees",
               CASE WHEN SIC_Code IS NULL THEN 0 ELSE 71 END::BIGINT AS "SF_SIC",
               IndustryProfileFinal AS "SF_IndustryProtfolio", DNBDUNSNumber AS "SF_DUNSNumber"
        FROM src WHERE Type <> 'MACHINERY' AND Website IS NOT NULL
        """,
    ),
)
def s6(spark, folder):
    source(spark, folder, ACCOUNTS).createOrReplaceTempView("leadmill_account")
    source(spark, folder, WORDS).createOrReplaceTempView("leadmill_stopwords")
    source(spark, folder, COUNTRY_WORDS).createOrReplaceTempView("leadmill_country_words")
    found = extracts.accounts(
        spark,
        "aoa.Type <> 'MACHINERY' AND aoa.Website IS NOT NULL",
        table="leadmill_account",
        stopwords="leadmill_stopwords",
        country_words="leadmill_country_words",
    )
    return found.select(
        "SF_AccountId", "SF_AccountName", "SF_AccountType", "SF_WebsiteClean", "SF_DomainClean",
        "SF_AccountNameClean", "SF_AnnualRevenue", "SF_NumberofEmployees", "SF_SIC", "SF_IndustryProtfolio",
        "SF_DUNSNumber",
    )


OPPORTUNITIES = """
SELECT concat('A', o_custkey) AS AccountId, concat('O', o_orderkey) AS OpportunityId, 'Deal' AS Display_Name,
       o_orderstatus AS New_Or_Expand, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice END AS SF_ACV_New_Expand_Converted,
       o_orderpriority AS StageName, 'T' AS True_Stage, CAST(o_orderdate AS STRING) AS CreatedDate,
       o_orderdate AS First_Opp_Created_Date_c, o_orderdate + INTERVAL '5' DAY AS Stage1_Date,
       o_orderdate + INTERVAL '10' DAY AS Stage2_Date, o_orderdate + INTERVAL '15' DAY AS Stage3_Date,
       CAST(NULL AS STRING) AS Stage4_Date, o_orderdate + INTERVAL '36' HOUR AS Final_CloseDate,
       'st' AS SQL_Source_Type_c, 'sf' AS SQL_SourcefromSalesFcst, o_orderdate AS SQL_Created_Date_c,
       o_orderdate AS First_MQL_Created_Date_c, o_orderdate AS First_Approved_SDR_Meeting_Date__c,
       'rt' AS Record_Type_text_c, 're' AS Reason__c, 'rd' AS Reason_Details__c, 'dl' AS Duplicate_Opportunity_Link__c
FROM {orders}
"""


@query(
    "s7_opportunities",
    with_source(
        OPPORTUNITIES,
        f"""
        SELECT OpportunityId AS "OPP_OpportunityId", AccountId AS "OPP_AccountId",
               CAST(trunc(coalesce(SF_ACV_New_Expand_Converted, 0)) AS BIGINT) AS "OPP_ACVNewExpandConverted",
               New_Or_Expand AS "OPP_New_Or_Expand",
               {duck_text_of('CAST(CreatedDate AS TIMESTAMP)')} AS "OPP_CreatedDate",
               {duck_text_of("CAST(CreatedDate AS TIMESTAMP) - INTERVAL 13 MONTH")} AS "OPP_AdustedCreatedDate",
               {duck_text_of('Final_CloseDate')} AS "OPP_CloseDate", Stage4_Date AS "OPP_Stage4Date"
        FROM src WHERE StageName <> '5-LOW'
        """,
    ),
)
def s7(spark, folder):
    source(spark, folder, OPPORTUNITIES).createOrReplaceTempView("leadmill_opportunity")
    found = extracts.opportunities(spark, "StageName <> '5-LOW'", table="leadmill_opportunity")
    dates = ["OPP_CreatedDate", "OPP_AdustedCreatedDate", "OPP_CloseDate", "OPP_Stage4Date"]
    return found.select(
        "OPP_OpportunityId", "OPP_AccountId", "OPP_ACVNewExpandConverted", "OPP_New_Or_Expand",
        *[text_of(d).alias(d) for d in dates],
    )


CAMPAIGNS = """
SELECT concat('C', p_partkey) AS Code, p_name AS Name, p_brand AS Campaign_ParentID, p_brand AS Campaign_ParentName,
       p_type AS Final_Channel, 'lob' AS LOB, 'ind' AS Industry, p_size > 25 AS IsActive
FROM {part}
"""


@query(
    "s8_campaigns",
    with_source(
        CAMPAIGNS,
        """
        SELECT Code AS "CMP_CampaignId", Name AS "CMP_CampaignName", Campaign_ParentID AS "CMP_CampaignParentId",
               Campaign_ParentName AS "CMP_CampaignParentName", Final_Channel AS "CMP_CampaignChannel",
               LOB AS "CMP_CampaignLOB", Industry AS "CMP_CampaignIndustry",
               CASE WHEN IsActive THEN 'true' ELSE 'false' END AS "CMP_CampaignStatus"
        FROM src WHERE Final_Channel <> 'PROMO'
        """,
    ),
)
def s8(spark, folder):
    source(spark, folder, CAMPAIGNS).createOrReplaceTempView("leadmill_campaign")
    return extracts.campaigns(spark, "cm.Final_Channel <> 'PROMO'", table="leadmill_campaign", sort=True)


MEMBERS = """
SELECT concat('M', o_orderkey) AS Code, 'K' || nullif(o_custkey % 400, 7) AS ContactLeadID, o_orderstatus AS Type,
       'lob' AS LOB, concat('A', o_custkey) AS Final_AccountID, 'name' AS Account_Name, 'c1' AS CampaignId,
       'camp' AS Campaign, CASE WHEN o_orderkey % 3 = 0 THEN 'Responded' ELSE '2.7' END AS CampaignMember_Status,
       o_orderkey % 2 = 0 AS HasResponded, o_orderdate AS CreatedDate, o_orderdate AS FirstRespondedDate,
       'a' AS Channel_Campaign, 'b' AS Channel_Medium, 'c' AS Channel_Source, 'd' AS Channel_Campaign_Final,
       'e' AS Final_Campaign_Channel, 'f' AS edw_lead_channel, o_orderpriority AS Campaign_Channels
FROM {orders}
"""
CONTACTS = """
SELECT concat('K', c_custkey * 2) AS Code, c_name AS Name, concat(c_name, '@x') AS Email, 'VP' AS Job_Level,
       c_mktsegment AS Job_Function
FROM {customer}
"""
MEMBER_SQL = f"""
WITH m AS ({duck(MEMBERS)}), k AS ({duck(CONTACTS)})
SELECT m.Code AS "CM_MemberId", m.ContactLeadID AS "CM_ContactId", m.Final_AccountID AS "CM_AccountId",
       CASE WHEN m.CampaignMember_Status = '2.7' THEN 2 ELSE 0 END::BIGINT AS "CM_CampaignMemberStatus",
       CAST(m.HasResponded AS BIGINT) AS "CM_HasResponded", m.Campaign_Channels AS "CM_CampaignChannels",
       k.Name AS "CM_ContactName", k.Email AS "CM_Email", k.Job_Level AS "CM_JobLevel",
       k.Job_Function AS "CM_JobFunction", {duck_text_of('m.FirstRespondedDate')} AS "CM_FirstRespondedDate"
FROM m LEFT JOIN k ON k.Code = m.ContactLeadID
"""


def _members(spark, folder, filter_by=None):
    source(spark, folder, MEMBERS).createOrReplaceTempView("leadmill_member")
    source(spark, folder, CONTACTS).createOrReplaceTempView("leadmill_contact")
    found = extracts.campaign_members(spark, filter_by, table="leadmill_member", contacts="leadmill_contact")
    return found.select(
        "CM_MemberId", "CM_ContactId", "CM_AccountId", "CM_CampaignMemberStatus", "CM_HasResponded",
        "CM_CampaignChannels", "CM_ContactName", "CM_Email", "CM_JobLevel", "CM_JobFunction",
        text_of("CM_FirstRespondedDate").alias("CM_FirstRespondedDate"),
    )


@query("s9_campaign_members", MEMBER_SQL + " WHERE m.Type = 'F'")
def s9(spark, folder):
    return _members(spark, folder, "cm.Type = 'F'")


@query("j1_left_join", MEMBER_SQL)
def j1(spark, folder):
    return _members(spark, folder)


COUNTRIES = """
SELECT n_nationkey AS id, CASE WHEN n_nationkey = 3 THEN 'Russia' WHEN n_nationkey = 4 THEN 'Swaziland' ELSE n_name END AS name,
       concat('I', n_nationkey) AS iso3, concat('J', n_nationkey) AS iso2, 'cap' AS capital, 1.5 AS latitude,
       2.5 AS longitude, '.x' AS tld, n_name AS native, n_name AS nationality
FROM {nation}
"""
STATES = """
SELECT n_nationkey AS id, CASE WHEN n_nationkey = 5 THEN 'Bavaria' ELSE n_name END AS name, n_regionkey AS country_id,
       'cc' AS country_code, r_name AS country_name, concat('S', n_nationkey) AS state_code, 'state' AS type,
       1.5 AS latitude, 2.5 AS longitude
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
"""


@query(
    "s10_country_dimension",
    with_source(
        COUNTRIES,
        """
        SELECT id AS "Id", name AS "Name", iso3 AS "ISO3", iso2 AS "ISO2", native AS "Native",
               CASE name WHEN 'Russia' THEN 'Russian Federation' WHEN 'Swaziland' THEN 'Eswatini' ELSE name END AS "CountryName"
        FROM src
        """,
    ),
)
def s10(spark, folder):
    source(spark, folder, COUNTRIES).createOrReplaceTempView("leadmill_country")
    return extracts.countries(spark, "leadmill_country").select("Id", "Name", "ISO3", "ISO2", "Native", "CountryName")


@query(
    "s11_state_dimension",
    with_source(
        STATES,
        """
        SELECT id AS "Id", name AS "Name", country_name AS "CountryName", state_code AS "Code",
               CASE name WHEN 'Bavaria' THEN 'Bayern' ELSE name END AS "StateName" FROM src
        """,
    ),
)
def s11(spark, folder):
    source(spark, folder, STATES).createOrReplaceTempView("leadmill_state")
    return extracts.states(spark, "leadmill_state").select("Id", "Name", "CountryName", "Code", "StateName")


@query("s12_word_lists", with_source(WORDS, "SELECT p_partkey, list_contains((SELECT list(string_field_0) FROM src), lower(p_type)) AS listed, (SELECT count(*) FROM src) AS words FROM part"))
def s12(spark, folder):
    source(spark, folder, WORDS).createOrReplaceTempView("leadmill_words")
    listed = extracts.words(spark, "leadmill_words")
    parts = read(spark, folder, "part")
    return parts.select("p_partkey", F.lower("p_type").isin(listed).alias("listed"), F.lit(len(listed)).cast("bigint").alias("words"))


# --- columns

@query("p1_filter", "SELECT o_orderkey, o_totalprice FROM orders WHERE nullif(o_orderstatus, 'F') <> 'P' AND o_totalprice > 100000")
def p1(spark, folder):
    return C.filter_data(read(spark, folder, "orders"), F.expr("nullif(o_orderstatus, 'F') <> 'P' AND o_totalprice > 100000")).select("o_orderkey", "o_totalprice")


@query("p2_prefix", 'SELECT s_suppkey AS "SF_s_suppkey", s_name AS "SF_s_name", s_nationkey AS "SF_s_nationkey", s_acctbal AS "SF_s_acctbal" FROM supplier')
def p2(spark, folder):
    return C.prefix_columns(read(spark, folder, "supplier"), "SF_")


@query("p3_rename", 'SELECT s_suppkey AS id, s_name AS name, s_nationkey, s_acctbal FROM supplier')
def p3(spark, folder):
    return C.rename_columns(read(spark, folder, "supplier"), {"s_suppkey": "id", "s_name": "name", "absent": "x"})


@query("p4_calculated", "SELECT l_orderkey, l_linenumber, l_quantity * 2 AS l_quantity FROM lineitem")
def p4(spark, folder):
    doubled = C.add_calculated_column(read(spark, folder, "lineitem"), "l_quantity", lambda df: df["l_quantity"] * 2)
    return doubled.select("l_orderkey", "l_linenumber", "l_quantity")


MIXED = """
SELECT o_orderkey,
       CASE o_orderkey % 6 WHEN 0 THEN '1.9' WHEN 1 THEN '-2.7' WHEN 2 THEN 'x' WHEN 3 THEN NULL WHEN 4 THEN ' 12 '
            ELSE CAST(o_orderkey AS STRING) END AS number,
       CASE WHEN o_orderkey % 2 = 0 THEN '2024-02-30' ELSE '2024-03-01 10:20:30' END AS day,
       o_orderkey % 3 = 0 AS yes, o_totalprice AS price
FROM {orders}
"""


@query(
    "p5_convert_types",
    with_source(
        MIXED,
        f"""
        SELECT o_orderkey, CAST(trunc(coalesce(TRY_CAST(trim(number) AS DOUBLE), 0)) AS BIGINT) AS number,
               {duck_text_of('TRY_CAST(day AS TIMESTAMP)')} AS day, CAST(yes AS BIGINT) AS yes,
               CAST(trunc(price) AS BIGINT) AS price
        FROM src
        """,
    ),
)
def p5(spark, folder):
    converted = C.convert_column_types(
        source(spark, folder, MIXED), int_cols=["number", "yes", "price", "absent"], datetime_cols=["day"]
    )
    return converted.withColumn("day", text_of("day"))


@query(
    "p6_convert_strict",
    "SELECT o_orderkey, CAST(trunc(o_totalprice) AS BIGINT) AS o_totalprice, CAST(o_custkey AS DOUBLE) AS o_custkey, "
    "CAST(o_orderkey AS VARCHAR) AS key_text FROM orders",
)
def p6(spark, folder):
    df = read(spark, folder, "orders").withColumn("key_text", F.col("o_orderkey"))
    strict = C.convert_dtype(df, {"int": ["o_totalprice"], "float": ["o_custkey"], "str": ["key_text"]})
    return strict.select("o_orderkey", "o_totalprice", "o_custkey", "key_text")


@query("p7_dates_to_timestamps", f"SELECT o_orderkey, {duck_text_of('CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)')} AS day FROM orders")
def p7(spark, folder):
    dated = read(spark, folder, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return C.dates_to_timestamps(dated).withColumn("day", text_of("day"))


@query("p8_clean_names", 'SELECT s_suppkey AS "_2nd_key_", s_name AS "Name_of_supplier", s_acctbal AS s_acctbal FROM supplier')
def p8(spark, folder):
    raw = read(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("2nd key!?"), F.col("s_name").alias("Name  of-supplier"), "s_acctbal"
    )
    return raw.toDF(*C.clean_column_names(raw.columns))


@query("p9_unique_names", 'SELECT s_suppkey AS "a_b", s_name AS "A_B_2", s_acctbal AS "a_b_3" FROM supplier')
def p9(spark, folder):
    raw = read(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("a b"), F.col("s_name").alias("A-B"), F.col("s_acctbal").alias("a_b")
    )
    return C.unique_column_names(raw)


@query("p10_reorder", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def p10(spark, folder):
    return C.reorder_columns_by_prefix(read(spark, folder, "part"), ["p_s", "p_b", "p_"])


GAPPY = """
SELECT o_orderkey, nullif(o_custkey % 7, 0) AS number, nullif(o_orderstatus, 'F') AS status,
       CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS price, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 2 = 0 END AS yes
FROM {orders}
"""


@query(
    "p11_fill_missing",
    with_source(GAPPY, "SELECT o_orderkey, coalesce(number, 0) AS number, coalesce(status, '') AS status, coalesce(price, 0) AS price, yes FROM src"),
)
def p11(spark, folder):
    return C.fill_missing(source(spark, folder, GAPPY))


@query("p12_lowercase", "SELECT o_orderkey, lower(o_orderstatus) AS o_orderstatus, lower(o_orderpriority) AS o_orderpriority, o_totalprice FROM orders")
def p12(spark, folder):
    return C.lowercase_strings(read(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice"))


@query("o1_sort", with_source(GAPPY, "SELECT o_orderkey, number FROM src"))
def o1(spark, folder):
    return C.sort_data(source(spark, folder, GAPPY).select("o_orderkey", "number"), "number", ascending=False)


@query(
    "o2_drop_duplicates",
    "SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey, "
    "l_suppkey ORDER BY l_orderkey, l_linenumber, l_extendedprice) AS place FROM lineitem) WHERE place = 1",
)
def o2(spark, folder):
    lines = read(spark, folder, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    order = [F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_extendedprice")]
    return C.drop_duplicates(lines, ["l_partkey", "l_suppkey"], order).drop("l_extendedprice")


@query("o2_drop_duplicate_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def o2_rows(spark, folder):
    return C.drop_duplicates(read(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber"))


# --- reshape

PROVIDERS = """
SELECT o_orderkey AS id, o_orderstatus AS SF_Name, o_orderpriority AS DNB_Name, o_totalprice AS SF_Revenue,
       nullif(o_totalprice * 0.5, 0) AS DNB_Sales, o_totalprice * 2 AS ZI_Revenue
FROM {orders}
"""


@query(
    "r1_split_in_two",
    with_source(
        PROVIDERS,
        """
        SELECT id AS "GroupID", 'SF' AS "Source", SF_Name AS "SF_Name", SF_Revenue AS "SF_Revenue" FROM src
        UNION ALL SELECT id, 'DNB', DNB_Name, DNB_Sales FROM src
        """,
    ),
)
def r1(spark, folder):
    return R.split_dataframe(source(spark, folder, PROVIDERS), "id", {"SF_Name": "DNB_Name", "SF_Revenue": "DNB_Sales"})


@query(
    "r2_split_rows",
    with_source(
        PROVIDERS,
        """
        SELECT id AS "GroupID", 'SF' AS "Source", SF_Name AS "SF_Name", SF_Revenue AS "SF_Revenue" FROM src
        UNION ALL SELECT id, 'DNB', DNB_Name, DNB_Sales FROM src
        UNION ALL SELECT id, 'ZI', '0', ZI_Revenue FROM src
        """,
    ),
)
def r2(spark, folder):
    mapping = {"SF_Name": ["DNB_Name", "ZI_Name"], "SF_Revenue": ["DNB_Sales", "ZI_Revenue"]}
    return R.split_rows(source(spark, folder, PROVIDERS), "id", mapping, 3)


@query(
    "r3_union_all",
    "SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer "
    "UNION ALL SELECT s_name, s_acctbal, NULL FROM supplier",
)
def r3(spark, folder):
    customers = read(spark, folder, "customer").selectExpr("c_name AS name", "c_acctbal AS balance", "c_mktsegment AS segment")
    suppliers = read(spark, folder, "supplier").selectExpr("s_acctbal AS balance", "s_name AS name")
    return R.union_all([customers, suppliers])


@query(
    "r4_side_by_side",
    "SELECT coalesce(c_custkey, s_suppkey, p_partkey) AS key, c_name, s_name, s_acctbal, p_name FROM customer "
    "FULL JOIN supplier ON c_custkey = s_suppkey FULL JOIN part ON p_partkey = coalesce(c_custkey, s_suppkey)",
)
def r4(spark, folder):
    customers = read(spark, folder, "customer").selectExpr("c_custkey AS key", "c_name")
    suppliers = read(spark, folder, "supplier").selectExpr("s_suppkey AS key", "s_name", "s_acctbal")
    parts = read(spark, folder, "part").selectExpr("p_partkey AS key", "p_name")
    return R.side_by_side([customers, suppliers, parts], "key")
