"""Cleansing, places, measures, touches and extracts on hand-made cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from leadmill import fixed_values as fixed
from leadmill.functions import text, values as V
from leadmill.operators import cleanse, geo, measures as M, touches as T
from leadmill.plans import stage_reports as S
from leadmill.sources import extracts


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.out for r in df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


def test_web_addresses(spark):
    df = spark.createDataFrame(
        [(1, " https://www.a.com:8080/x:99 "), (2, "b.org"), (3, "www.www.c.de/"), (4, "ftp://d.com"), (5, ""), (6, None), (7, "HTTP://E.com")],
        "i int, u string",
    )
    got = {r.i: (r.w, r.d) for r in cleanse.clean_website_domain(df, "u", "w", "d").collect()}
    assert got == {
        1: ("www.a.com", "a.com"), 2: ("www.b.org", "b.org"), 3: ("www.c.de", "c.de"), 4: ("www.ftp:", "ftp:"),
        5: (None, None), 6: (None, None), 7: ("www.HTTP:", "HTTP:"),
    }


def test_title_case_follows_python(spark):
    words = ["o'neil 3m co-op", "ÉCOLE d'été", "a\tb", "中a x1y", "mcDONALD", "__a_b", "  two  blanks "]
    assert column(spark, words, text.title_case) == [w.title() for w in words]


def test_names(spark):
    assert column(spark, ["Acme Inc.", "Acme Corp, Ltd", "Müller GmbH & Co. KG", "Inc", None], text.business_name) == [
        "Acme", "Acme", "Müller", "Inc", None
    ]
    assert column(spark, ["a (b) c", "a [b", "a (b", "x, y - z", " many   blanks "], text.drop_bracketed) == [
        "a c", "a", "a", "x y z", "many blanks"
    ]
    cleaned = column(spark, ["The acme (old) of france ltd", None], lambda c: text.clean_name(c, ["the", "o."], ["France"]))
    assert cleaned == ["Acme", None]


def test_jobs(spark):
    levels = column(spark, ["C Level", "", None, "VP", "vp", "Manager"], lambda c: text.job_level(c, True))
    assert levels == ["C-Level", "Others", "Others", "VP", "Others", "Manager"]
    df = spark.createDataFrame([("Head of Finance",), ("security",), ("Partner",), (None,), ("G&A",), ("x",)], "v string")
    got = [r.v for r in cleanse.fix_job_function(df, "v", True).collect()]
    assert got == ["Finance", "Information Technology", "Others", "Others", "G&A", "Others"]
    assert [r.v for r in cleanse.fix_job_function(df, "v", False).collect()] == ["Others"] * 4 + ["G&A", "Others"]


def test_later_columns_and_rows_win_in_lookups(spark):
    dim = spark.createDataFrame(
        [(1, "Alpha", "AAA", "AA"), (2, "Beta", "ALPHA", "BB"), (3, "Côte", "CCC", "AA")], "Id int, Name string, ISO3 string, ISO2 string"
    )
    states = spark.createDataFrame([(1, "Bavaria", "BY")], "Id int, Name string, Code string")
    geography = geo.GeoStandardiser(geo.fix_country(dim), geo.fix_states(states))
    df = spark.createDataFrame([(1, " alpha "), (2, "Alpha"), (3, "aa"), (4, "cote"), (5, " No Where "), (6, None)], "i int, c string")
    got = rows(geography.standardise_country(df, "c").select("cClean", "cValid", "cCleanValid", "i"), "i")
    assert [g[:3] for g in got] == [
        ("Beta", 0, 1), ("Beta", 1, 1), ("Côte", 0, 1), ("Côte", 0, 1), ("No Where", 0, 0), (None, 0, 0)
    ]
    assert rows(geography.standardise_state(df.limit(1).withColumn("c", F.lit("by")), "c").select("cClean")) == [("Bayern",)]


def test_country_and_state_names(spark):
    df = spark.createDataFrame([("Cote D'Ivoire (Ivory Coast)",), ("Peru",), (None,)], "Name string")
    assert rows(geo.fix_country(df).select("CountryName")) == [("Côte d'Ivoire",), ("Peru",), (None,)]
    df = spark.createDataFrame([("Cook County",), ("London Borough of Barnet",)], "State_Name string")
    assert rows(geo.drop_state_words(df)) == [("Cook ",), ("Barnet",)]


def test_ascii(spark):
    assert column(spark, ["Côte", "Øre ß Łódź", "plain", None], text.to_ascii) == ["Cote", "Ore ss Lodz", "plain", None]


def test_short_numbers(spark):
    df = spark.createDataFrame([(999,), (1200,), (2_500_000,), (3_000_000_000,), (-5000,)], "n long")
    assert [r.t for r in M.format_numbers(df, "n", "t").collect()] == ["999", "1K", "2M", "3B", "-5000"]
    halves = spark.createDataFrame([(2500.0,)], "n double")
    assert rows(M.format_numbers(halves, "n", "t").select("t")) == [("2.0K",)]


def test_bins(spark):
    df = spark.createDataFrame([("0",), ("-3",), ("3.5",), ("100",), ("101",), ("x",), (None,)], "v string")
    got = [tuple(r) for r in M.calculate_bins(df, ["v"]).collect()]
    assert [g[1] for g in got] == ["0 to 0", "1 to 3", "4 to 10", "76 to 100", "100+", "0 to 0", "0 to 0"]
    assert got[5][0] == 0.0
    low = M.calculate_bins(spark.createDataFrame([(5,), (10,), (11,)], "v int"), ["v"], [20, 10])
    assert [r.v_bins for r in low.collect()] == [None, "11 to 20", "11 to 20"]
    assert V.bin_labels(fixed.REVENUE_BIN_EDGES, True)[:3] == ["0 to 0", "1 to 1M", "1M to 10M"]
    with pytest.raises(ValueError):
        M.calculate_bins(df, ["absent"])


def test_split_amounts(spark):
    df = spark.createDataFrame(
        [("Item 1", 100, 1, 5, 0.3), ("Item 2", 50, 2, 7, 0.5), ("Item 3", 200, 3, 9, 0.2), ("gap", 10, None, 0, 0.0)],
        "Item string, Amount int, w1 int, w2 int, w3 double",
    )
    split = M.calculate_split_amounts(df, ["w1", "w2", "w3"], "Amount")
    got = {r.Item: r for r in split.collect()}
    assert (got["Item 1"].w1_ACV, got["Item 1"].w2_ACV, got["Item 1"].w3_ACV) == (15.87, 79.37, 4.76)
    assert got["Item 2"].TotalSplitAmount == 50.0 and got["gap"].TotalSplitAmount == 0.0 and got["gap"].w1 == 0
    assert got["Item 3"]["TotalSplitAmount(M)"] == "$0.00M" and got["Item 3"].w1_ACV_bins == "1 to 1M"
    plain = {r.Item: r for r in M.calculate_split_amounts(df, ["w1", "w2", "w3"], "Amount", bins=False).collect()}
    assert plain["gap"].w1_ACV is None


def test_velocity_rounds_days_down(spark):
    df = spark.sql("select timestamp_ntz'2024-01-02 00:00:00' a, timestamp_ntz'2024-01-01 12:00:00' b, cast(null as timestamp_ntz) c")
    timed = M.calculate_deal_velocity(df, ["a", "b", "c"]).first()
    assert timed["Velocity_a_to_b"] == -1 and timed["Velocity_b_to_c"] is None and timed["Velocity_a_to_c"] is None
    two = M.calculate_deal_velocity(df, ["a", "b"]).first()
    assert two["Velocity_b_to_b"] == 0
    text_dates = spark.createDataFrame([("2024-01-01", "2024-01-03 23:00:00")], "a string, b string")
    assert M.calculate_deal_velocity(text_dates, ["a", "b"], convert=True).first()["Velocity_a_to_b"] == 2
    with pytest.raises(ValueError):
        M.calculate_deal_velocity(df, ["a"])


def touches(spark):
    day = dt.datetime(2024, 1, 1)
    at = [day + dt.timedelta(days=d) for d in range(0, 60, 10)]
    members = [("m1", at[0], "web"), ("m2", at[1], "web"), ("m3", at[1] + dt.timedelta(seconds=1), "mail"), ("m1", at[5], "mail"), ("m4", None, "mail")]
    made = [(m, when, channel, "o1", "r1", *at) for m, when, channel in members]
    names = "CM_MemberId string, CM_FirstRespondedDate timestamp_ntz, CM_CampaignChannels string, o string, r string, " + ", ".join(
        f"{c} timestamp_ntz" for c in ["OPP_AdustedCreatedDate", "OPP_Stage1Date", "OPP_Stage2Date", "OPP_Stage3Date", "OPP_Stage4Date", "OPP_CloseDate"]
    )
    return spark.createDataFrame(made, names)


def test_touch_bounds(spark):
    flagged = T.campaign_touch_by_stage(touches(spark))
    got = rows(flagged.select("CM_MemberId", *fixed.TOUCH_STAGES, "StageTouch"))
    assert got == [("m1", 1, 0, 0, 0, 0, 1), ("m2", 1, 0, 0, 0, 0, 1), ("m3", 0, 1, 0, 0, 0, 1), ("m1", 0, 0, 0, 0, 1, 1), ("m4", 0, 0, 0, 0, 0, 0)]
    unique = T.campaign_touch_by_stage(touches(spark), True, True, [F.col("CM_FirstRespondedDate")])
    assert unique.count() == 3


def test_stage_report(spark):
    flagged = T.campaign_touch_by_stage(touches(spark))
    flagged = flagged.union(flagged.where("CM_MemberId = 'm1'").withColumn("CM_CampaignChannels", F.lit("app")))
    report = S.by_stage(flagged, list(fixed.TOUCH_STAGES), ["o", "r"], "r", "CM_CampaignChannels", column_order=["web", "mail"])
    # a stage has columns for the values that occur in it
    assert report.averages.columns == [
        "r", "Stage1Touch_Avg_web", "Stage1Touch_Avg_app", "Stage2Touch_Avg_mail", "Stage5Touch_Avg_mail", "Stage5Touch_Avg_app"
    ]
    assert [r.r for r in report.averages.collect()] == ["r1", "Total Average"]
    assert rows(report.counts["Stage1Touch"]) == [("o1", "r1", 2, 1)]
    channels = S.channels_by_stage(flagged, ["Stage1Touch"], ["o", "r"], "CM_CampaignChannels", "r")
    assert rows(channels.counts["Stage1Touch"]) == [("o1", "r1", 1, 2, 3)]
    assert rows(channels.averages["Stage1Touch"]) == [("r1", 1.0, 2.0), ("Total Average", 1.0, 2.0)]


def test_top_channels_are_aligned_by_rank(spark):
    flagged = T.campaign_touch_by_stage(touches(spark))
    got = rows(T.top_channels_by_stage(flagged, ["Stage1", "Stage2", "Stage3"], 5))
    assert got == [(1, "web", "mail", None)]
    grouped = rows(T.top_channels_by_stage_and_group(flagged, "r", ["Stage1", "Stage3"], 5))
    assert grouped == [("r1", 1, "web", 2, "", 0)]


def test_members_meet_opportunities_in_time(spark):
    day = dt.datetime(2024, 1, 1)
    members = spark.createDataFrame(
        [("m", "a", day + dt.timedelta(days=d)) for d in (0, 40, 100, 101)] + [("n", None, day), ("p", "a", None)],
        "CM_MemberId string, CM_AccountId string, CM_FirstRespondedDate timestamp_ntz",
    )
    opportunities = spark.createDataFrame(
        [("a", day, day + dt.timedelta(days=100)), ("a", day + dt.timedelta(days=50), None), (None, day, day)],
        "OPP_AccountId string, OPP_AdustedCreatedDate timestamp_ntz, OPP_CloseDate timestamp_ntz",
    )
    assert T.members_with_opportunities(members, opportunities, True).count() == 3
    assert T.members_with_opportunities(members, opportunities).count() == 10


def test_extract_filters_see_source_names_and_aliases(spark):
    names = list(fixed.CAMPAIGN_COLUMNS)
    spark.createDataFrame([("1", *["x"] * 6, True), ("2", *["y"] * 6, False)], names).createOrReplaceTempView("t_campaign")
    got = extracts.campaigns(spark, "cm.Final_Channel = 'y'", table="t_campaign")
    assert got.columns[0] == "CMP_CampaignId" and rows(got.select("CMP_CampaignStatus")) == [("false",)]


def test_month_subtraction_clamps(spark):
    values = {c: None for c in fixed.OPPORTUNITY_COLUMNS} | {"OpportunityId": "1", "CreatedDate": "2024-03-31 08:00:00"}
    schema = ", ".join(f"{c} string" for c in values)
    spark.createDataFrame([tuple(values.values())], schema).createOrReplaceTempView("t_opportunity")
    got = extracts.opportunities(spark, table="t_opportunity").first()
    assert got["OPP_AdustedCreatedDate"] == dt.datetime(2023, 2, 28, 8) and got["OPP_ACVNewExpandConverted"] == 0


def test_long_word_lists_are_refused(spark, monkeypatch):
    monkeypatch.setattr(cleanse, "MOST_WORDS", 2)
    with pytest.raises(ValueError):
        cleanse.word_list(spark.range(3).selectExpr("string(id) as string_field_0"))


def test_row_local_operators_run_on_a_stream(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.createDataFrame([("https://www.a.com/x", 5, "VP Level")], "u string, n int, l string").write.parquet(path)
    stream = spark.readStream.schema("u string, n int, l string").parquet(path)
    shaped = M.calculate_bins(cleanse.clean_website_domain(cleanse.fix_job_level(stream, "l", True), "u", "w", "d"), ["n"])
    running = shaped.writeStream.format("memory").queryName("shaped").start()
    running.processAllAvailable()
    running.stop()
    assert rows(spark.table("shaped").select("d", "n_bins", "l")) == [("a.com", "4 to 10", "VP")]
