"""Queries on bins, split amounts, velocity, touches and stage reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadmill import fixed_values as fixed
from leadmill.catalog.registry import QUERIES, duck, query, source, with_source
from leadmill.functions import values as V
from leadmill.operators import measures as M, touches as T
from leadmill.plans import stage_reports as S

# --- bins and amounts

AMOUNTS = """
SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) * CAST(floor(o_totalprice) AS BIGINT) AS big,
       CAST(o_custkey % 3000 AS BIGINT) AS small
FROM {orders}
"""
NUMBERS = """
SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_custkey % 130 - 20 END AS number, o_totalprice AS price
FROM {orders}
"""
SHORT = (
    "CASE WHEN {0} >= 1000000000 THEN (({0}) // 1000000000) || 'B' WHEN {0} >= 1000000 THEN (({0}) // 1000000) || 'M' "
    "WHEN {0} >= 1000 THEN (({0}) // 1000) || 'K' ELSE CAST({0} AS VARCHAR) END"
)


@query("b1_short_numbers", with_source(AMOUNTS, f"SELECT o_orderkey, {SHORT.format('big')} AS big, {SHORT.format('small')} AS small FROM src"))
def b1(spark, folder):
    df = source(spark, folder, AMOUNTS)
    return M.format_numbers(M.format_numbers(df, "big", "big"), "small", "small")


@query(
    "b2_bins",
    with_source(
        NUMBERS,
        """
        SELECT o_orderkey, coalesce(number, 0) AS number, CASE WHEN abs(coalesce(number, 0)) <= 0 THEN '0 to 0'
          WHEN abs(number) <= 3 THEN '1 to 3' WHEN abs(number) <= 10 THEN '4 to 10' WHEN abs(number) <= 25 THEN '11 to 25'
          WHEN abs(number) <= 50 THEN '26 to 50' WHEN abs(number) <= 75 THEN '51 to 75'
          WHEN abs(number) <= 100 THEN '76 to 100' ELSE '100+' END AS number_bins,
          CASE WHEN price < 1500 THEN NULL WHEN price <= 50000 THEN '1K to 50K' WHEN price <= 2000000 THEN '50K to 2M' ELSE '2M+' END AS price_bins
        FROM src
        """,
    ),
)
def b2(spark, folder):
    df = source(spark, folder, NUMBERS)
    binned = M.calculate_bins(M.calculate_bins(df, ["number"]), ["price"], [2000000, 1500, 50000], short=True)
    return binned.select("o_orderkey", "number", "number_bins", "price_bins")


SPLITS = """
SELECT l_orderkey, l_linenumber, l_extendedprice * 1000 AS amount, l_quantity AS w1,
       CASE WHEN l_linenumber = 2 THEN NULL ELSE l_discount * 100 END AS w2, l_tax * 100 AS w3
FROM {lineitem}
"""


def acv(weight: str) -> str:
    return f"coalesce(round_even(amount * {weight} / nullif(coalesce(w1, 0) + coalesce(w2, 0) + coalesce(w3, 0), 0) * 100.0, 0) / 100.0, 0)"


def revenue_bin(column: str) -> str:
    labels = ["0 to 0", "1 to 1M", "1M to 10M", "10M to 100M", "100M to 300M", "300M to 500M", "500M to 1B"]
    edges = [0, 1_000_000, 10_000_000, 100_000_000, 300_000_000, 500_000_000, 1_000_000_000]
    return "CASE " + " ".join(f"WHEN abs({column}) <= {e} THEN '{label}'" for e, label in zip(edges, labels)) + " ELSE '1B+' END"


@query(
    "b3_split_amounts",
    with_source(
        SPLITS,
        f"""
        , a AS (SELECT l_orderkey, l_linenumber, coalesce(w2, 0) AS w2, {acv('w1')} AS w1_ACV, {acv('w2')} AS w2_ACV, {acv('w3')} AS w3_ACV FROM src)
        , t AS (SELECT *, round_even((w1_ACV + w2_ACV + w3_ACV) * 100.0, 0) / 100.0 AS total FROM a)
        SELECT l_orderkey, l_linenumber, round(w2, 6) AS w2, round(w1_ACV, 2) AS w1_ACV, round(w2_ACV, 2) AS w2_ACV,
               round(w3_ACV, 2) AS w3_ACV, round(total, 2) AS "TotalSplitAmount",
               {revenue_bin('w1_ACV')} AS "w1_ACV_bins", {revenue_bin('total')} AS "TotalSplitAmount_bins"
        FROM t
        """,
    ),
)
def b3(spark, folder):
    split = M.calculate_split_amounts(source(spark, folder, SPLITS), ["w1", "w2", "w3"], "amount")
    money = ["w1_ACV", "w2_ACV", "w3_ACV", "TotalSplitAmount"]
    return split.select(
        "l_orderkey", "l_linenumber", F.round("w2", 6).alias("w2"), *[F.round(m, 2).alias(m) for m in money],
        "w1_ACV_bins", "TotalSplitAmount_bins",
    )


@query(
    "b3_split_amounts_equal",
    with_source(
        SPLITS,
        """
        , f AS (SELECT *, CAST(coalesce(w1 > 0, false) AS BIGINT) AS f1, CAST(coalesce(w2 > 0, false) AS BIGINT) AS f2 FROM src)
        SELECT l_orderkey, l_linenumber, f1 AS w1, f2 AS w2, round(amount * f1, 2) AS "w1_ACV", round(amount * f2, 2) AS "w2_ACV",
               round(amount * f1 + amount * f2, 2) AS "TotalSplitAmount",
               printf('$%.2fM', round_even((amount * f1 + amount * f2) / 1000000 * 100, 0) / 100) AS "TotalSplitAmount(M)"
        FROM f
        """,
    ),
)
def b3_equal(spark, folder):
    split = M.calculate_split_amounts(source(spark, folder, SPLITS), ["w1", "w2"], "amount", equal_weight=True, equal_amount=True)
    money = ["w1_ACV", "w2_ACV", "TotalSplitAmount"]
    return split.select("l_orderkey", "l_linenumber", "w1", "w2", *[F.round(m, 2).alias(m) for m in money], "`TotalSplitAmount(M)`")


def weighted(weight: str) -> str:
    return f"round_even(amount * {weight} / nullif(coalesce(w1, 0) + coalesce(w2, 0), 0) * 100.0, 0) / 100.0"


@query(
    "b4_old_split_amounts",
    with_source(
        SPLITS,
        f"""
        SELECT l_orderkey, l_linenumber, round({weighted('w1')}, 2) AS "w1_ACV", round({weighted('w2')}, 2) AS "w2_ACV",
               round(coalesce({weighted('w1')}, 0) + coalesce({weighted('w2')}, 0), 2) AS "TotalSplitAmount" FROM src
        """,
    ),
)
def b4(spark, folder):
    split = M.calculate_split_amounts(source(spark, folder, SPLITS), ["w1", "w2"], "amount", bins=False)
    return split.select("l_orderkey", "l_linenumber", *[F.round(m, 2).alias(m) for m in ("w1_ACV", "w2_ACV", "TotalSplitAmount")])


DEALS = """
SELECT l_orderkey, l_linenumber, o_orderdate + INTERVAL '12' HOUR AS created,
       CASE WHEN l_linenumber = 3 THEN NULL ELSE l_shipdate END AS stage1, l_shipdate + INTERVAL '36' HOUR AS closed
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""


def whole_days(a: str, b: str) -> str:
    return f"CAST(floor(date_diff('microsecond', {a}, {b}) / 86400000000.0) AS BIGINT)"


@query(
    "b5_deal_velocity",
    with_source(
        DEALS,
        f"""
        SELECT l_orderkey, l_linenumber, {whole_days('created', 'stage1')} AS "Velocity_created_to_stage1",
               {whole_days('stage1', 'closed')} AS "Velocity_stage1_to_closed",
               {whole_days('created', 'closed')} AS "Velocity_created_to_closed" FROM src
        """,
    ),
)
def b5(spark, folder):
    timed = M.calculate_deal_velocity(source(spark, folder, DEALS), ["created", "stage1", "closed"])
    return timed.drop("created", "stage1", "closed")


REVENUES = """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 0.0 ELSE o_totalprice END AS SF_AnnualRevenue,
       CASE o_orderkey % 5 WHEN 0 THEN o_totalprice WHEN 1 THEN o_totalprice * 0.95 WHEN 2 THEN 0.0 WHEN 3 THEN NULL
            ELSE o_totalprice * 1.2 END AS DNB_SalesVolumeUSDollars,
       CASE o_orderkey % 4 WHEN 0 THEN 0.0 WHEN 1 THEN o_totalprice * 1.05 WHEN 2 THEN NULL ELSE o_totalprice * 1.5 END AS ZI_AnnualRevenue,
       CASE WHEN o_orderkey % 11 = 0 THEN o_totalprice ELSE 5.0 END AS ZI_Revenue_Deviation,
       CASE o_orderkey % 5 WHEN 0 THEN 0.0 WHEN 1 THEN -5.0 WHEN 2 THEN -100.0 WHEN 4 THEN 20.0 END AS dnb_gap,
       CASE o_orderkey % 4 WHEN 0 THEN -100.0 WHEN 1 THEN 5.0 WHEN 3 THEN 50.0 END AS zi_gap
FROM {orders}
"""


@query(
    "b6_revenue_source",
    with_source(
        REVENUES,
        """
        SELECT o_orderkey, CASE WHEN SF_AnnualRevenue = DNB_SalesVolumeUSDollars THEN 'DNB_Exact_Match'
          WHEN SF_AnnualRevenue = ZI_Revenue_Deviation THEN 'ZI_Exact_Match'
          WHEN DNB_SalesVolumeUSDollars > 0 AND dnb_gap >= -10 AND dnb_gap <= 10
               AND (coalesce(ZI_AnnualRevenue = 0, false) OR coalesce(abs(dnb_gap) <= abs(zi_gap), false)) THEN 'DNB_Under_10'
          WHEN ZI_AnnualRevenue > 0 AND zi_gap >= -10 AND zi_gap <= 10
               AND (coalesce(DNB_SalesVolumeUSDollars = 0, false) OR coalesce(abs(dnb_gap) >= abs(zi_gap), false)) THEN 'ZI_Under_10'
          WHEN SF_AnnualRevenue = 0 AND DNB_SalesVolumeUSDollars > 0 THEN 'Update_Zero_from_DNB'
          WHEN SF_AnnualRevenue = 0 AND ZI_AnnualRevenue > 0 THEN 'Update_Zero_from_ZI'
          ELSE 'Needs_Review' END AS "Revenue_Source" FROM src
        """,
    ),
)
def b6(spark, folder):
    df = source(spark, folder, REVENUES).withColumnsRenamed({"dnb_gap": "DNB_Deviation(%)", "zi_gap": "ZI_Deviation(%)"})
    return M.add_revenue_source(df).select("o_orderkey", "Revenue_Source")


# --- touches: every event of a user beside the user's one opportunity

TOUCHES = """
SELECT event_id, concat('M', user_id % 60, event_type) AS CM_MemberId, event_type AS CM_CampaignChannels,
       CASE user_id % 5 WHEN 0 THEN 'C-Level' WHEN 1 THEN 'SVP' WHEN 2 THEN 'VP' WHEN 3 THEN 'Director' ELSE 'Others' END AS CM_JobLevel,
       CASE WHEN event_id % 29 = 0 THEN NULL ELSE ts END AS CM_FirstRespondedDate,
       concat('O', user_id) AS OPP_OpportunityId, nullif(concat('R', user_id % 4), 'R3') AS OPP_Region,
       first_ts AS OPP_AdustedCreatedDate, first_ts + INTERVAL '3' DAY AS OPP_Stage1Date,
       first_ts + INTERVAL '8' DAY AS OPP_Stage2Date,
       CASE WHEN user_id % 7 = 0 THEN NULL ELSE first_ts + INTERVAL '13' DAY END AS OPP_Stage3Date,
       first_ts + INTERVAL '18' DAY AS OPP_Stage4Date, first_ts + INTERVAL '25' DAY AS OPP_CloseDate
FROM {events} JOIN (SELECT user_id AS u, min(ts) AS first_ts FROM {events} GROUP BY user_id) f ON user_id = u
"""
STAGES = list(fixed.TOUCH_STAGES)


def flags_sql() -> str:
    bounds = [("OPP_AdustedCreatedDate", "OPP_Stage1Date", ">="), ("OPP_Stage1Date", "OPP_Stage2Date", ">"),
              ("OPP_Stage2Date", "OPP_Stage3Date", ">"), ("OPP_Stage3Date", "OPP_Stage4Date", ">"),
              ("OPP_Stage4Date", "OPP_CloseDate", ">")]
    return ", ".join(
        f'CAST(coalesce(CM_FirstRespondedDate {op} {a} AND CM_FirstRespondedDate <= {b}, false) AS BIGINT) AS "Stage{i}Touch"'
        for i, (a, b, op) in enumerate(bounds, 1)
    )


SUM_OF_FLAGS = " + ".join(f'"{s}"' for s in STAGES)
FLAGGED = with_source(TOUCHES, f', flagged AS (SELECT *, {flags_sql()} FROM src), touched AS (SELECT *, {SUM_OF_FLAGS} AS "StageTouch" FROM flagged)')


def touched(spark, folder):
    return T.campaign_touch_by_stage(source(spark, folder, TOUCHES))


@query("m1_touch_by_stage", FLAGGED + f""" SELECT event_id, {', '.join(f'"{s}"' for s in STAGES)}, "StageTouch" FROM touched""")
def m1(spark, folder):
    return touched(spark, folder).select("event_id", *STAGES, "StageTouch")


@query(
    "m1_unique_touches",
    FLAGGED + """ SELECT event_id, CM_MemberId AS "CM_MemberId", "StageTouch" FROM (SELECT *, row_number() OVER (PARTITION BY CM_MemberId, "StageTouch"
    ORDER BY CM_FirstRespondedDate ASC NULLS FIRST, event_id) AS place FROM touched) WHERE place = 1
    AND CM_FirstRespondedDate >= OPP_AdustedCreatedDate AND CM_FirstRespondedDate <= OPP_CloseDate""",
)
def m1_unique(spark, folder):
    order = [F.col("CM_FirstRespondedDate").asc_nulls_first(), F.col("event_id")]
    kept = T.campaign_touch_by_stage(source(spark, folder, TOUCHES), True, True, order)
    return kept.select("event_id", "CM_MemberId", "StageTouch")


@query(
    "p13_flag",
    with_source(TOUCHES, "SELECT event_id, CASE WHEN CM_FirstRespondedDate > OPP_Stage2Date THEN 1 ELSE 0 END::BIGINT AS late FROM src"),
)
def p13(spark, folder):
    df = source(spark, folder, TOUCHES)
    return df.select("event_id", V.flag(F.col("CM_FirstRespondedDate") > F.col("OPP_Stage2Date")).alias("late"))


@query(
    "p14_row_sum",
    with_source(SPLITS, "SELECT l_orderkey, l_linenumber, round(coalesce(w1, 0) + coalesce(w2, 0) + coalesce(w3, 0), 6) AS weight FROM src"),
)
def p14(spark, folder):
    df = source(spark, folder, SPLITS)
    return df.select("l_orderkey", "l_linenumber", F.round(V.null_safe_sum([F.col("w1"), F.col("w2"), F.col("w3")]), 6).alias("weight"))


CM = """
SELECT concat('M', event_id) AS CM_MemberId, concat('A', user_id) AS CM_AccountId, event_type AS CM_CampaignChannels,
       ts AS CM_FirstRespondedDate FROM {events}
"""
OPP = """
SELECT concat('O', o_orderkey) AS OPP_OpportunityId, concat('A', o_custkey) AS OPP_AccountId,
       o_orderdate + INTERVAL '9000' DAY AS OPP_AdustedCreatedDate, o_orderdate + INTERVAL '9400' DAY AS OPP_CloseDate FROM {orders}
"""


@query(
    "m2_members_with_opportunities",
    f"""
    WITH cm AS ({duck(CM)}), opp AS ({duck(OPP)})
    SELECT CM_MemberId AS "CM_MemberId", OPP_OpportunityId AS "OPP_OpportunityId" FROM cm JOIN opp ON CM_AccountId = OPP_AccountId
    WHERE CM_FirstRespondedDate BETWEEN OPP_AdustedCreatedDate AND OPP_CloseDate
    """,
)
def m2(spark, folder, key_rows=None):
    joined = T.members_with_opportunities(
        source(spark, folder, CM), source(spark, folder, OPP), within_opportunity=True, key_rows=key_rows
    )
    return joined.select("CM_MemberId", "OPP_OpportunityId")


@query("m2_members_skewed", QUERIES["m2_members_with_opportunities"].sql)
def m2_skewed(spark, folder):
    return m2(spark, folder, key_rows=1)


CHANNELS = ["click", "error", "purchase", "signup", "view"]
LONG = FLAGGED + ", long AS (" + " UNION ALL ".join(
    f"""SELECT '{s}' AS stage, OPP_OpportunityId AS opp, OPP_Region AS region, CM_JobLevel AS level, CM_CampaignChannels AS channel
        FROM touched WHERE "{s}" > 0""" for s in STAGES
) + ")"


@query(
    "m3_by_stage",
    LONG + """
    , counts AS (SELECT stage, opp, region, count(*) AS n FROM long WHERE opp IS NOT NULL AND region IS NOT NULL GROUP BY ALL)
    , means AS (SELECT stage, region, round_even(avg(n), 0) AS v FROM counts GROUP BY ALL)
    , rows AS (SELECT * FROM means UNION ALL SELECT stage, 'Total Average', round_even(avg(v), 0) FROM means GROUP BY stage)
    SELECT region AS "OPP_Region", """ + ", ".join(f"""max(v) FILTER (WHERE stage = '{s}') AS "Avg_{s}" """ for s in STAGES)
    + " FROM rows GROUP BY region",
)
def m3(spark, folder):
    return S.by_stage(touched(spark, folder), STAGES, ["OPP_OpportunityId", "OPP_Region"], "OPP_Region").averages


@query(
    "m3_stage_counts",
    LONG + """
    SELECT opp AS "OPP_OpportunityId", region AS "OPP_Region", count(*) AS "Stage2Touch" FROM long
    WHERE stage = 'Stage2Touch' AND region IS NOT NULL GROUP BY opp, region
    """,
)
def m3_counts(spark, folder):
    report = S.by_stage(touched(spark, folder), STAGES, ["OPP_OpportunityId", "OPP_Region"], "OPP_Region")
    return report.counts["Stage2Touch"]


@query(
    "m3_by_stage_pivoted",
    LONG + """
    , counts AS (SELECT stage, opp, region, channel, count(*) AS n FROM long WHERE region IS NOT NULL GROUP BY ALL)
    , means AS (SELECT stage, region, channel, round_even(avg(n), 0) AS v FROM counts GROUP BY ALL)
    , rows AS (SELECT * FROM means UNION ALL SELECT stage, 'Total Average', channel, round_even(avg(v), 0) FROM means GROUP BY ALL)
    SELECT region AS "OPP_Region", """
    + ", ".join(f"""max(v) FILTER (WHERE stage = '{s}' AND channel = '{c}') AS "{s}_Avg_{c}" """ for s in STAGES for c in CHANNELS)
    + " FROM rows GROUP BY region",
)
def m3_pivoted(spark, folder):
    report = S.by_stage(
        touched(spark, folder), STAGES, ["OPP_OpportunityId", "OPP_Region"], "OPP_Region", "CM_CampaignChannels"
    )
    return report.averages


def stage_cells(value: str) -> str:
    return ", ".join(value.format(c=c) for c in CHANNELS)


@query(
    "m4_channels_by_stage",
    LONG + f"""
    , g AS (SELECT opp AS "OPP_OpportunityId", region AS "OPP_Region", {stage_cells('''count(*) FILTER (WHERE channel = '{c}') AS "{c}"''')}
            FROM long WHERE stage = 'Stage3Touch' AND region IS NOT NULL GROUP BY opp, region)
    SELECT *, {' + '.join(f'"{c}"' for c in CHANNELS)} AS "RowTotal" FROM g
    """,
)
def m4(spark, folder):
    report = S.channels_by_stage(
        touched(spark, folder), STAGES, ["OPP_OpportunityId", "OPP_Region"], "CM_CampaignChannels", "OPP_Region"
    )
    return report.counts["Stage3Touch"]


@query(
    "m4_channel_averages",
    LONG + """
    , counts AS (SELECT opp, region, channel, count(*) AS n FROM long WHERE stage = 'Stage3Touch' AND region IS NOT NULL GROUP BY ALL)
    , means AS (SELECT region, channel, round_even(avg(n), 0) AS v FROM counts GROUP BY ALL)
    , rows AS (SELECT * FROM means UNION ALL SELECT 'Total Average', channel, round_even(avg(v), 0) FROM means GROUP BY ALL)
    SELECT region AS "OPP_Region", """
    + stage_cells("""coalesce(max(v) FILTER (WHERE channel = '{c}'), 0) AS "Avg_{c}" """) + " FROM rows GROUP BY region",
)
def m4_averages(spark, folder):
    report = S.channels_by_stage(
        touched(spark, folder), STAGES, ["OPP_OpportunityId", "OPP_Region"], "CM_CampaignChannels", "OPP_Region"
    )
    return report.averages["Stage3Touch"]


# --- leading channels

NAMES = [s.removesuffix("Touch") for s in STAGES]


def top_sql(keys: str, top: int, counts: bool) -> str:
    part = f"stage, {keys}" if keys else "stage"
    lead = f"{keys}, " if keys else ""
    cells = ", ".join(
        f"""max(channel) FILTER (WHERE stage = '{n}Touch') AS "{n}_Channels\""""
        + (f""", coalesce(max(n) FILTER (WHERE stage = '{n}Touch'), 0) AS "{n}_Count\"""" if counts else "")
        for n in NAMES
    )
    return LONG + f"""
    , counts AS (SELECT {part}, channel, count(*) AS n FROM long {'WHERE ' + keys + ' IS NOT NULL' if keys else ''} GROUP BY ALL)
    , ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY {part} ORDER BY n DESC, channel) AS INTEGER) AS rank FROM counts)
    , best AS (SELECT {lead}rank, {cells} FROM ranked WHERE rank <= {top} GROUP BY {lead}rank)
    """


@query("o3_top_channels", top_sql("", 3, False) + "SELECT * FROM best")
def o3(spark, folder):
    return T.top_channels_by_stage(touched(spark, folder), NAMES, 3)


@query("o4_top_channels_by_value", top_sql("level", 3, False) + 'SELECT level AS "CM_JobLevel", * EXCLUDE (level) FROM best')
def o4(spark, folder):
    return T.top_channels_by_stage_and_value(touched(spark, folder), "CM_JobLevel", NAMES, 3)


@query(
    "o5_top_channels_by_group",
    top_sql("region", 4, True) + 'SELECT region AS "OPP_Region", rank, '
    + ", ".join(f"""coalesce("{n}_Channels", '') AS "{n}_Channels", "{n}_Count\"""" for n in NAMES) + " FROM best",
)
def o5(spark, folder):
    return T.top_channels_by_stage_and_group(touched(spark, folder), "OPP_Region", NAMES, 4)
