"""Candidates and linkage against brute force on small fixtures."""

import random
import re

import pytest
from pyspark.sql import functions as F

from leadmill import catalog
from leadmill.functions import batches, similarity as S
from leadmill.operators import candidates as K, joins as J
from leadmill.plans import linkage as L

WORDS = ["alpha", "alpho", "beta", "betta", "gamma corp", "gamma corps", "delta", "dleta", "x", "", "épée", "epee"]


def names(seed, n, rng_words=WORDS):
    rng = random.Random(seed)
    made = []
    for i in range(n):
        a = rng.choice(rng_words) + " " + rng.choice(rng_words)
        made.append((i, None if rng.random() < 0.1 else a.strip(), rng.choice(["b1", "b1", "b2", None]), rng.randint(0, 3)))
    return made


def frames(spark, n=60):
    left = spark.createDataFrame(names(1, n), "LId long, SF_Name string, SF_Block string, SF_Size long")
    right = spark.createDataFrame(names(2, n), "RId long, ZI_Name string, ZI_Block string, ZI_Size long")
    return left, right


RULES = {
    "index": {"block": {"SF_Block": ["ZI_Block"]}, "sortedneighbour": {"SF_Name": ["ZI_Name"]}},
    "compare": {"SF_Name": ["ZI_Name"], "SF_Size": ["ZI_Size"]},
}


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("method", [L.COSINE, L.JARO_WINKLER, L.DAMERAU])
def test_tokens_give_the_same_pairs_as_whole_blocks(spark, method):
    left, right = frames(spark)
    plan = L.make_plan(left, right, RULES, method)
    whole = L.matching_pairs(left, right, "LId", "RId", plan, whole_blocks=True)
    tokens = L.matching_pairs(left, right, "LId", "RId", plan, whole_blocks=False)
    assert rows(whole) == rows(tokens)
    assert whole.count() > 0


@pytest.mark.parametrize("method", [L.COSINE, L.JARO_WINKLER, L.DAMERAU])
def test_pairs_above_the_threshold_share_a_token(spark, method):
    rng = random.Random(7)
    texts = ["".join(rng.choice("abcd ") for _ in range(rng.randint(1, 14))) for _ in range(120)]
    texts += [t[:-1] + rng.choice("abcd") for t in texts[:60]] + ["ab" + t for t in texts[:30]]
    one = spark.createDataFrame([(t,) for t in sorted(set(texts))], "a string")
    feature = L.Feature("a", "a", "hit", method)
    rarity = [(i * 37) % 101 for i in range(S.RARITY_BUCKETS)]
    if method == L.COSINE:
        made = one.withColumn("v", F.expr(S.gram_vector("a")))
    else:
        made = one.withColumn("v", F.col("a"))
    side = made.selectExpr("a", "v", f"coalesce({L._token_sets(feature, 'v', rarity)}, cast(array() as array<string>)) as t")
    found = side.collect()
    token = {r.a: set(r.t) for r in found}

    def score(x, y):
        if method == L.JARO_WINKLER:
            return batches.jaro_winkler_score(x, y)
        if method == L.DAMERAU:
            return batches.damerau_levenshtein_score(x, y)
        gx, gy = ({e: r.v["grams"][e] for e in r.v["grams"]} for r in (by_text[x], by_text[y]))
        dot = sum(n * gy.get(g, 0) for g, n in gx.items())
        size = by_text[x].v["norm"] * by_text[y].v["norm"]
        return dot / size if size else 0.0

    by_text = {r.a: r for r in found}
    close = [(x, y) for x in token for y in token if score(x, y) >= 0.85]
    assert len(close) > len(token)
    assert all(token[x] & token[y] for x, y in close)


def test_rank_and_neighbours_equal_brute_force(spark):
    left, right = frames(spark)
    got = rows(K.neighbour_pairs(left, right, "LId", "RId", "SF_Name", "ZI_Name", window=5))
    ls, rs = left.collect(), right.collect()
    keys = sorted({r.SF_Name for r in ls if r.SF_Name is not None} | {r.ZI_Name for r in rs if r.ZI_Name is not None})
    rank = {k: i for i, k in enumerate(keys)}
    want = sorted(
        (a.LId, b.RId) for a in ls for b in rs
        if a.SF_Name is not None and b.ZI_Name is not None and abs(rank[a.SF_Name] - rank[b.ZI_Name]) <= 2
    )
    assert got == want


def test_blocks_never_pair_missing_keys(spark):
    left, right = frames(spark)
    got = rows(K.block_pairs(left, right, "LId", "RId", "SF_Block", "ZI_Block"))
    want = sorted(
        (a.LId, b.RId) for a in left.collect() for b in right.collect() if a.SF_Block and a.SF_Block == b.ZI_Block
    )
    assert got == want


@pytest.mark.parametrize("share", [1, 5, 40])
def test_salted_grid_equals_plain_join(spark, monkeypatch, share):
    monkeypatch.setattr(J, "KEY_ROWS", share)
    monkeypatch.setattr(J, "KEY_PAIRS", float(share * share))
    left = spark.range(300).selectExpr("id as l", "case when id % 3 = 0 then 0 else id % 40 end as k")
    right = spark.range(200).selectExpr("id as r", "case when id % 3 = 0 then 0 else id % 50 end as k")
    salted = J.pair_up(left, right, ["k"], skewed=True)
    assert rows(salted.select("l", "r")) == rows(left.join(right, "k").select("l", "r"))
    plan = salted._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("how", ["left", "inner"])
def test_large_dimension_is_joined_without_broadcast_of_the_whole(spark, monkeypatch, how):
    monkeypatch.setattr(J, "HOT_SHARE", 4)
    facts = spark.range(200).selectExpr("id", "case when id % 7 = 0 then null when id % 2 = 0 then 1 else id end as k")
    dim = spark.range(100).selectExpr("id as k", "concat('v', id) as v")
    joined = J.attach(facts, dim, ["k"], how, small=False)
    assert rows(joined.select("id", "k", "v").na.fill("")) == rows(
        facts.join(dim, "k", how).select("id", "k", "v").na.fill("")
    )


def test_cells_of_a_hot_key_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(J, "KEY_ROWS", 50)
    monkeypatch.setattr(J, "KEY_PAIRS", 2500.0)
    left = spark.range(2000).selectExpr("id as l", "case when id % 2 = 0 then 0 else id end as k")
    right = spark.range(3000).selectExpr("id as r", "case when id % 2 = 0 then 0 else id end as k")
    a, b, keys = J.deal_sides(left, right, ["k"], True)
    for side in (a, b):
        assert max(r["count"] for r in side.groupBy(*keys).count().collect()) < 150
        plan = side._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan  # the hot keys meet the side without a shuffle of its rows


@pytest.mark.parametrize("method", [L.COSINE, L.JARO_WINKLER, L.DAMERAU])
def test_tokens_equal_blocks_with_hot_tokens(spark, monkeypatch, method):
    left, right = frames(spark)
    plan = L.make_plan(left, right, RULES, method)
    whole = rows(L.matching_pairs(left, right, "LId", "RId", plan, whole_blocks=True))
    monkeypatch.setattr(J, "KEY_ROWS", 3)
    monkeypatch.setattr(J, "KEY_PAIRS", 9.0)
    assert rows(L.matching_pairs(left, right, "LId", "RId", plan, whole_blocks=False)) == whole


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "decimal(12,6)", "double", "int"])
def test_profiles_keep_what_differs_little(spark, kind):
    values = {"timestamp": ["2024-01-01 00:00:00.000001", "2024-01-01 00:00:00.000002"], "date": ["2024-01-01", "2024-01-02"]}
    values["timestamp_ntz"] = values["timestamp"]
    one, two = values.get(kind, ["1.000001", "1.000002"] if kind != "int" else ["1", "2"])
    def side(name, wide):
        df = spark.createDataFrame([(1, "b", one), (2, "b", two)], f"{name}Id long, {name}Block string, v string")
        return df.select(f"{name}Id", f"{name}Block", F.col("v").cast(wide).alias(f"{name}V"))
    left, right = side("L", kind), side("R", "bigint" if kind == "int" else kind)
    plan = L.make_plan(left, right, {"index": {"block": {"LBlock": ["RBlock"]}}, "compare": {"LV": ["RV"]}})
    for whole in (True, False):
        got = L.matching_pairs(left, right, "LId", "RId", plan, whole_blocks=whole)
        assert sorted((r.LId, r.RId) for r in got.collect()) == [(1, 1), (2, 2)]


def test_key_load(spark, monkeypatch):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (1,), (3,)], "k int")
    load = J.key_load(left, right, ["k"])
    assert load == J.KeyLoad(6.0, 7.0, 3, 6.0) and not load.skewed
    monkeypatch.setattr(J, "KEY_PAIRS", 5.0)
    assert load.skewed


def test_equal_numbers_of_either_sign_meet(spark):
    left = spark.createDataFrame([(1, "b", 0.0)], "LId long, SF_Block string, SF_N double")
    right = spark.createDataFrame([(2, "b", -0.0)], "RId long, ZI_Block string, ZI_N double")
    plan = L.make_plan(left, right, {"index": {"block": {"SF_Block": ["ZI_Block"]}}, "compare": {"SF_N": ["ZI_N"]}})
    for whole in (True, False):
        assert rows(L.matching_pairs(left, right, "LId", "RId", plan, whole)) == [(1, 2, 1)]


def test_size_check(spark, monkeypatch):
    assert J.fits_broadcast(spark.range(10))
    monkeypatch.setattr(J, "BROADCAST_ROWS", 5)
    assert not J.fits_broadcast(spark.range(10))


def test_published_similarities():
    assert batches.jaro_winkler_score("martha", "marhta") == pytest.approx(0.9611, abs=1e-4)
    assert batches.jaro_winkler_score("dixon", "dicksonx") == pytest.approx(0.8133, abs=1e-4)
    assert batches.damerau_levenshtein_distance("ca", "abc") == 2
    assert batches.damerau_levenshtein_distance("kitten", "sitting") == 3


def test_cosine_by_hand(spark):
    df = spark.createDataFrame([("ab", "ab"), ("ab", "ab cd"), ("Éa", "ea"), ("", "a"), (None, "a")], "a string, b string")
    got = [r.s for r in S.with_cosine(df, "a", "b", "s").collect()]
    assert got[0] == pytest.approx(1) and got[1] == pytest.approx(3 / (3**0.5 * 6**0.5)) and got[2] == pytest.approx(1)
    assert got[3] is None and got[4] is None


def test_link_records_keeps_the_leading_side_whole(spark):
    left, right = frames(spark, 20)
    linked = L.link_records(left, right, "LId", "RId", RULES, confidence_score=True)
    assert linked.select("LId").distinct().count() == 20
    assert linked.columns[0] == "LId" and "Match_zConfidence_bins" in linked.columns
    assert linked.where("Match_zScore is null").count() == 0
    second = L.link_records(left, right, "LId", "RId", RULES, secondary=True)
    assert second.select("RId").distinct().count() == 20


def test_clashing_names_get_suffixes(spark):
    left = spark.createDataFrame([(1, "a")], "LId long, same string")
    right = spark.createDataFrame([(2, "b")], "RId long, same string")
    pairs = spark.createDataFrame([(1, 2, 1)], "LId long, RId long, Match_x long")
    out = L.join_output(left, pairs, right, "LId", "RId", ("_df1", "_df2"))
    assert out.columns == ["LId", "same_df1", "Match_x", "RId", "same_df2"]


def test_rules_are_checked(spark):
    left, right = frames(spark, 5)
    with pytest.raises(ValueError, match="unknown match type"):
        L.link_rules("nothing")
    with pytest.raises(ValueError, match="missing"):
        L.make_plan(left, right, {"index": {}, "compare": {"SF_Name": ["ZI_Absent", None]}})
    lost = L.missing_columns(left, right, {"index": {"block": {"SF_No": [None, "ZI_Block"]}}, "compare": {"SF_X": "ZI_Y"}})
    assert lost == (["SF_No", "SF_X"], ["ZI_Y"])
    plan = L.make_plan(left, right, {**RULES, "compare": {"SF_Name": ["ZI_Name", "ZI_Size"]}})
    assert plan.labels == ["Match_Name_ZI_Name"] and len(plan.notes) == 1


def test_older_rules_are_keyed_by_the_right_side(spark):
    left, right = frames(spark, 10)
    rules = {"index": {"block": {"ZI_Block": ["SF_Block"]}}, "compare": {"ZI_Name": ["SF_Name"]}}
    plan = L.make_plan(left, right, rules, L.JARO_WINKLER, keyed_by="right")
    assert plan.blocks == (("SF_Block", "ZI_Block"),)
    assert plan.features[0] == L.Feature("SF_Name", "ZI_Name", "ZI_Name_SF_Name", L.JARO_WINKLER)


def test_score_counts_match_columns_only(spark):
    pairs = spark.createDataFrame([(1, 1)], "Match_a long, other long")
    assert L.add_score(pairs, ["Match_a", "other"]).first()["Match_zScore"] == 1


def test_edit_measures_in_the_jvm_equal_the_loops(spark):
    """Random texts over a small alphabet with accents and a character outside the BMP."""
    rng = random.Random(7)
    alphabet = "abcde fghABé\U0001F600"
    pairs = [
        ("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 14))), "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 14))))
        for _ in range(1500)
    ] + [("martha", "marhta"), ("dixon", "dicksonx"), ("a", "b"), ("ab", "ba")]
    rows = spark.createDataFrame(pairs, "a string, b string").select(
        "a", "b", S.jaro_winkler_scores(F.col("a"), F.col("b")).alias("s"),
        S.damerau_levenshtein_distances(F.col("a"), F.col("b")).alias("d"),
    ).collect()
    for r in rows:
        assert r.s == pytest.approx(batches.jaro_winkler_score(r.a, r.b), abs=1e-12), (r.a, r.b)
        assert r.d == batches.damerau_levenshtein_distance(r.a, r.b), (r.a, r.b)


def test_each_candidate_is_scored_once(spark, monkeypatch):
    """Several rules: the pairs that reach the features are the distinct candidates of all rules."""
    left, right = frames(spark)
    plan = L.make_plan(left, right, RULES, L.JARO_WINKLER)
    seen = []
    real = L._score

    def spy(pairs, plan, ids):
        seen.append(pairs)
        return real(pairs, plan, ids)

    monkeypatch.setattr(L, "_score", spy)
    got = rows(L.matching_pairs(left, right, "LId", "RId", plan, whole_blocks=True))
    assert len(seen) == 1
    scored = sorted(tuple(r) for r in seen[0].select("LId", "RId").collect())
    expected = set()
    for keys, rules in ((K.block_keys, plan.blocks), (K.neighbour_keys, plan.neighbours)):
        for a, b in rules:
            lefts, rights = keys(left, right, a, b)
            expected |= {(r.LId, r.RId) for r in lefts.join(rights, "__block").select("LId", "RId").collect()}
    assert scored == sorted(expected)
    monkeypatch.setattr(L, "_score", real)
    assert got == rows(L.matching_pairs(left, right, "LId", "RId", plan, whole_blocks=False))


def hot_frames(spark):
    """Few names, many rows: pairs of records are far more than pairs of profiles."""
    left = spark.range(400).selectExpr("id as LId", "element_at(array('large ring', 'blue bolt', 'tiny nut', null), cast(id % 4 + 1 as int)) as SF_Name", "id % 2 as SF_Size")
    right = spark.range(300).selectExpr("id as RId", "element_at(array('large ring', 'large rings', 'blue bolts'), cast(id % 3 + 1 as int)) as ZI_Name", "id % 3 as ZI_Size")
    return left, right


SEVERAL = {
    "index": {"block": {"SF_Name": ["ZI_Name"]}, "sortedneighbour": {"SF_Name": ["ZI_Name"], "SF_Size": ["ZI_Size"]}},
    "compare": {"SF_Name": ["ZI_Name"]},
}


@pytest.mark.parametrize("secondary", [False, True])
def test_hot_blocks_are_stored_as_pairs_of_profiles(spark, monkeypatch, secondary):
    """The tables written on the way stay small; the pairs of records are made by the last join only."""
    left, right = hot_frames(spark)
    whole = rows(L.link_records(left, right, "LId", "RId", SEVERAL, True, secondary, whole_blocks=True))
    written = []

    def spy(df, label):
        written.append((label, df.count()))
        return materialise(df, label)

    materialise = L.materialise
    monkeypatch.setattr(L, "materialise", spy)
    folded = rows(L.link_records(left, right, "LId", "RId", SEVERAL, True, secondary, whole_blocks=False))
    assert folded == whole and len(whole) > 10_000
    assert max(n for _, n in written) <= 400


def test_repeated_and_null_ids_keep_their_pairs(spark):
    left, right = frames(spark, 20)
    left = left.union(left.limit(5)).union(spark.createDataFrame([(None, "alpha beta", "b1", 1)], left.schema))
    plan = L.make_plan(left, right, RULES, L.JARO_WINKLER)
    got = L.matching_pairs(left, right, "LId", "RId", plan, whole_blocks=False)
    assert got.select("LId", "RId").distinct().count() == got.count()
    whole = L.matching_pairs(left, right, "LId", "RId", plan, whole_blocks=True)
    assert rows(got.where("LId is not null").select("LId", "RId")) == rows(whole.select("LId", "RId").distinct())


def doubled_frames(spark):
    """Few names, many rows; some ids stand for two records with unlike names, some are null."""
    left, right = hot_frames(spark)
    left = left.union(left.where("LId < 40").selectExpr("LId + 1", "SF_Name", "SF_Size"))
    left = left.union(left.where("LId < 9").selectExpr("cast(null as bigint)", "SF_Name", "SF_Size"))
    right = right.union(right.where("RId < 30").selectExpr("RId + 1", "ZI_Name", "ZI_Size")).union(right.where("RId < 20"))
    return left, right.union(right.where("RId < 5").selectExpr("cast(null as bigint)", "ZI_Name", "ZI_Size"))


def name_pairs(left, right):
    """Ids of the records whose names are equal or next to each other, and alike."""
    ls, rs = left.collect(), right.collect()
    ranks = {v: i for i, v in enumerate(sorted({r.SF_Name for r in ls if r.SF_Name} | {r.ZI_Name for r in rs}))}
    return [
        (a, b) for a in ls for b in rs
        if a.SF_Name and abs(ranks[a.SF_Name] - ranks[b.ZI_Name]) <= 1 and batches.jaro_winkler_score(a.SF_Name, b.ZI_Name) >= 0.85
    ]


@pytest.mark.parametrize("several, secondary", [(True, False), (False, True)])
def test_repeated_and_null_ids_stay_pairs_of_profiles(spark, monkeypatch, several, secondary):
    """No table written on the way holds pairs of records; two ids match once with several rules, once a record with one."""
    left, right = doubled_frames(spark)
    rules = [("SF_Name", "ZI_Name")]
    plan = L.LinkPlan(tuple(rules * several), tuple(rules), (L.Feature("SF_Name", "ZI_Name", "Match_Name", L.JARO_WINKLER),))
    near = name_pairs(left, right)
    if several:
        wanted = {(a.LId, b.RId): (a.LId, b.RId) for a, b in near}.values()
    else:
        wanted = [(a.LId, b.RId) for a, b in near]
    written = []
    materialise = L.materialise

    def spy(df, label):
        written.append((label, df.count()))
        return materialise(df, label)

    monkeypatch.setattr(L, "materialise", spy)
    linked = L.linked_pairs(left, right, "LId", "RId", plan, whole_blocks=False)
    order = lambda pairs: sorted(pairs, key=str)
    assert order(tuple(r) for r in linked.records("LId", "RId").select("LId", "RId").collect()) == order(wanted)
    out = L.linked_output(left, linked, right, "LId", "RId", ("_x", "_y"), secondary).collect()
    leading, other, lead, tail = (right, left, "RId", "LId") if secondary else (left, right, "LId", "RId")
    leads = [r[lead] for r in leading.collect()]
    tails = [r[tail] for r in other.collect()]
    met = [((b, a) if secondary else (a, b)) for a, b in wanted]
    # a match brings every row of its ids; a null id has none
    expected = [(a, b) for a, b in met if a is not None for _ in range(leads.count(a)) for _ in range(tails.count(b) if b is not None else 1)]
    expected += [(a, None) for a in leads if a is None or a not in {m for m, _ in met}]
    assert order((r[lead], r[tail]) for r in out) == order(expected)
    assert len(near) > 20_000 and max(n for _, n in written) <= 600


def test_an_id_pair_keeps_a_hit_of_any_of_its_records(spark):
    left = spark.createDataFrame([(1, "red bolt", "tiny nut"), (1, "blue ring", "old anvil"), (2, "red bolt", None)], "INP_Index long, INP_COMPANY string, INP_N string")
    right = spark.createDataFrame([("A", "red bolt", "tiny nut"), ("A", "dark plate", "old anvil"), ("B", "red bolts", "x")], "SF_Id string, SF_AccountName string, SF_CleanName string")
    fields = {"SF_AccountName": "INP_COMPANY", "SF_CleanName": "INP_N"}
    got = L.potential_matches(left, right, "INP_Index", "SF_Id", fields, whole_blocks=False)
    assert rows(got) == [(1, "A", 1, 1, 2), (1, "B", 1, 0, 1), (2, "A", 1, 0, 1), (2, "B", 1, 0, 1)]


def test_values_to_compare_are_not_dealt_out_by_token(spark, monkeypatch):
    left, right = frames(spark)
    met = []

    def spy(a, b, on, *more):
        met.append((on, len(a.columns), len(b.columns)))
        return J.pair_up(a, b, on, *more)

    monkeypatch.setattr(L, "pair_up", spy)
    plan = L.make_plan(left, right, RULES)
    L.matching_pairs(left, right, "LId", "RId", plan, whole_blocks=False).count()
    assert [m for m in met if m[0] == ["__token"]] == [(["__token"], 2, 2)] * 2


def test_whole_blocks_take_more_tasks_for_more_rows(spark, monkeypatch):
    left, right = frames(spark)
    plan = L.make_plan(left, right, {**RULES, "index": {"block": {"SF_Block": ["ZI_Block"]}}})
    monkeypatch.setattr(L, "ROWS_PER_TASK", 4)
    pairs = L.matching_pairs(left, right, "LId", "RId", plan, whole_blocks=True)
    numbers = [int(n) for n in re.findall(r"hashpartitioning\(__block#\d+, (\d+)\), REPARTITION_BY_NUM", pairs._jdf.queryExecution().executedPlan().toString())]
    assert numbers and min(numbers) > 20


def test_costly_comparisons_are_spread_over_tasks(spark, tmp_path):
    spark.range(5).selectExpr("id as p_partkey", "concat('ring ', id) as p_name", "'Brand#1' as p_brand", "'SMALL' as p_type", "1 as p_size").write.parquet(f"{tmp_path}/part.parquet")
    for name in ("c1_bigram_cosine", "c2_jaro_winkler", "c3_damerau_levenshtein", "k7_compare_strings"):
        df = catalog.runners()[name](spark, str(tmp_path))
        assert "REPARTITION_BY_NUM" in df._jdf.queryExecution().executedPlan().toString()


def test_a_step_of_jaro_winkler_looks_for_its_match_once(spark):
    """Work by length: each evaluation of the match window again for every character would show as its cube."""
    scores = str(S.jaro_winkler_scores(F.col("a"), F.col("b"))._jc)
    assert scores.count("filter(") <= 4


def tasks_of(spark, group, action):
    """What an action gives, and the tasks of all its stages."""
    context = spark.sparkContext
    context.setJobGroup(group, group)
    try:
        given = action()
        tracker = context.statusTracker()
        stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
        return given, sum(info.numTasks for s in stages if (info := tracker.getStageInfo(s)))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_tokens_are_counted_in_one_read_of_each_side(spark):
    """The tasks do not multiply by the features, and the counts are those of every feature apart."""
    left, right = frames(spark, 20)
    features = tuple(L.Feature("SF_Name", "ZI_Name", f"Match_{i}", L.DAMERAU) for i in range(6)) + (L.Feature("SF_Size", "ZI_Size", "n", L.EXACT),)
    plan = L.LinkPlan((("SF_Block", "ZI_Block"),), (), features)
    a = left.withColumnRenamed("SF_Name", "l:SF_Name").repartition(8, "LId")
    b = right.withColumnRenamed("ZI_Name", "r:ZI_Name").repartition(8, "RId")
    rarity, tasks = tasks_of(spark, "rarity", lambda: L._rarity(a, b, plan))
    alone = L.LinkPlan(plan.blocks, (), features[:1])
    assert tasks < 2 * tasks_of(spark, "rarity of one", lambda: L._rarity(a, b, alone))[1]
    assert len(rarity) == 7 and sum(rarity[6]) == 0
    grams = [g for side, name in ((left, "SF_Name"), (right, "ZI_Name")) for r in side.collect() if r[name] for g in zip("\2" + r[name], r[name] + "\3")]
    assert all(sum(counts) == len(grams) and counts == rarity[0] for counts in rarity[:6])


def test_vectors_are_made_once_for_counts_and_tokens(spark, monkeypatch):
    left, right = frames(spark, 20)
    seen = []
    real = L._rarity
    monkeypatch.setattr(L, "_rarity", lambda a, b, plan: seen.extend([a, b]) or real(a, b, plan))
    L.matching_pairs(left, right, "LId", "RId", L.make_plan(left, right, {**RULES, "index": {"block": {"SF_Block": ["ZI_Block"]}}}), whole_blocks=False)
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in seen]
    assert len(plans) == 2 and not any("Exchange" in p or "Python" in p for p in plans)


def test_few_candidates_take_few_tasks(spark, monkeypatch):
    """With many shuffle partitions, the tasks of pairing and scoring follow the pairs, not partitions times rules."""
    left, right = frames(spark)
    plan = L.make_plan(left, right, RULES, L.JARO_WINKLER)
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "300")
        pairs = L.matching_pairs(left, right, "LId", "RId", plan, whole_blocks=True)
        text = pairs._jdf.queryExecution().executedPlan().toString()
        many = L.spread(left, ["LId"], work=1e9).rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    numbers = [int(n) for n in re.findall(r"hashpartitioning\([^()]*, (\d+)\), REPARTITION_BY_NUM", text)]
    assert max(numbers, default=0) < 10 and many == 300


@pytest.mark.parametrize("feature, full, hopeless", [
    (S.jaro_winkler_feature, "jaro_winkler_scores", [("large ring", "lomboktuku"), ("cold bolt", "dusky nut")]),
    (S.damerau_levenshtein_feature, "damerau_levenshtein_scores", [("brand#12", "brand#34"), ("large ring", "lavxe ring")]),
])
def test_pairs_without_enough_common_characters_are_not_scored(spark, monkeypatch, feature, full, hopeless):
    monkeypatch.setattr(S, full, lambda a, b: F.raise_error(F.lit("scored in full")).cast("double"))
    df = spark.createDataFrame(hopeless, "a string, b string")
    assert [r.f for r in df.select(feature("a", "b").alias("f")).collect()] == [0, 0]


def test_features_equal_the_loops(spark):
    """Random texts with repeats, accents, a character outside the BMP and a zero character."""
    rng = random.Random(11)
    alphabet = "aab cé\U0001F600\0"
    pairs = []
    for _ in range(700):
        a = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 14)))
        b = list(a)
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(b) + 1)
            b[at:at + rng.randint(0, 2)] = rng.choice([[], [rng.choice(alphabet)], b[at:at + 2][::-1]])
        pairs.append((a, "".join(b) or "a"))
    found = spark.createDataFrame(pairs, "a string, b string").select(
        "a", "b", S.jaro_winkler_feature("a", "b").alias("j"), S.damerau_levenshtein_feature("a", "b").alias("d")
    ).collect()
    for r in found:
        assert r.j == int(batches.jaro_winkler_score(r.a, r.b) >= 0.85), (r.a, r.b)
        assert r.d == int(batches.damerau_levenshtein_score(r.a, r.b) >= 0.85 - S.SLACK), (r.a, r.b)
    assert 100 < sum(r.d for r in found) < 650 and 100 < sum(r.j for r in found) < 690
