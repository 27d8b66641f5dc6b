"""Chat formatting, URL rules and the pipeline."""

import hashlib
import random
import re

import pyarrow as pa
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from leadmill.llm import chat, queries, url_filter
from leadmill.llm.common import table

FOLDER = "/root/testdata/sf0.001"
TURNS = "conv_id bigint, turn bigint, role string, text string, segment string"


def conversations():
    draw = random.Random(3)
    bits = [*chat.CONTROLS, "\\", "\\\\", " ", "\n", "é", "<", "[", "s>", "INST]", "x", "日", "<\\/s>"]
    rows = []
    for conv in range(80):
        for turn in range(draw.randrange(1, 6)):
            role = draw.choice(["user", "assistant", "system", "tool", None, "a</s>\\"])
            text = None if draw.random() < 0.1 else "".join(draw.choice(bits) for _ in range(draw.randrange(12)))
            rows.append((conv, turn, role, text, "extra"))
    return rows + [(None, 0, "user", "no id", None), (5, 0, "user", "tie", None), (5, 0, "user", "tie", None), (5, None, "assistant", "first", None)]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_chat_reads_back(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, TURNS).repartition(3)
    segments = chat.format_turns(df)
    got = {r.conv_id: r for r in chat.digests(segments).collect()}
    whole = {r.conv_id: r.text for r in chat.conversations_text(segments).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv in got:
        turns = sorted((r[1] if r[1] is not None else -1, r[2] or "", r[3] or "") for r in rows if r[0] == conv)
        said = "".join(t for _, role, t in turns if role == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), digest("".join(f"{a}\n{b}\n" for _, a, b in turns)))
        assert (r.loss_chars, r.loss_sha256) == (len(said), digest(said))
        assert r.formatted_chars == len(whole[conv])
    assert chat.digests(chat.format_turns(df.limit(0))).count() == 0


def test_no_control_string_is_left_inside_a_text():
    texts = pa.array(["</s>[INST] ok [/INST]", "<<s>", "\\[INST]", "[INST[INST]", ""])
    hidden = chat.escape(texts)
    assert not any(c in t for c in chat.CONTROLS for t in hidden.to_pylist())
    assert chat.unescape(hidden).to_pylist() == texts.to_pylist()


def test_joined_copies_parts_of_each_row():
    a, b = pa.array(["x", "", "日本"]), pa.array(["é", "yy", ""]).slice(0)
    assert chat.joined([a, b, a]).to_pylist() == ["xéx", "yy", "日本日本"]
    assert chat.joined([a[:0], b[:0]]).to_pylist() == []


URLS = [
    "http://A.Example.NET/en/1?x", "https://example.net", "https://b.net/", "notexample.net://x", "http://sub.example.com/de/9#a",
    "http://example.com/den", "http://x.org/fr/", "http://org/fr/q", "//no", "", None, "http://user@h.net:80/p", "ftp://a.example.net/en", "x://y://z/de/",
    "http://one.example.com?u=/de/", "\nhttp://k.net/\n",
]


def test_fixed_rules(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(0, URLS[0])]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    none = spark.createDataFrame([], "url string, bad boolean")
    got = url_filter.judge(pages, url_filter.mine(none)).collect()
    assert len(got) == len(rows)
    for r in got:
        at = (r.url or "").find("://")
        rest = r.url[at + 3 :] if at >= 0 else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.translate(str.maketrans(url_filter.UPPER, url_filter.LOWER))
        fits = [(len(h + p), h + p, v) for h, p, v in url_filter.HOST_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        _, rule, verdict = max(fits, default=(0, None, "allow"))
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict)


def test_learned_rules_equal_counting(spark):
    draw = random.Random(1)
    rows = [(f"http://{'spam' if bad else draw.choice(['good', 'fine'])}.example.com/{draw.choice(['en', 'fr'])}/{i}", bad or draw.random() < 0.02) for i in range(600) for bad in [i % 5 == 0]]
    rules = url_filter.mine(spark.createDataFrame(rows, "url string, bad boolean")).collect()
    tokens = {r.url: set(r.t) for r in spark.createDataFrame(rows, "url string, bad boolean").select("url", url_filter.tokens(url_filter.F.col("url")).alias("t")).collect()}
    assert rules
    for rule in rules:
        met = [bad for url, bad in rows if set(rule.tokens) <= tokens[url]]
        assert sum(met) / len(rows) == pytest.approx(rule.support) and sum(met) / len(met) == pytest.approx(rule.confidence)
        assert sum(met) >= url_filter.LEAST_URLS and rule.confidence >= url_filter.MIN_CONFIDENCE
    pages = spark.createDataFrame([(1, "http://spam.example.com/en/7"), (2, "http://good.example.com/en/7"), (2, "http://good.example.com/en/7")], "page_id bigint, url string")
    judged = sorted((r.page_id, r.verdict) for r in url_filter.judge(pages, spark.createDataFrame(rules)).collect())
    assert judged == [(1, "block"), (2, "allow"), (2, "allow")]


def test_rules_of_more_than_four_tokens(spark):
    """Only five tokens together make a URL bad; without any one of them it is good."""
    bad = "http://x.example.com/a/b/c?d=1"
    good = ["http://y.example.com/a/b/c?d=1", "http://x.example.com/b/c?d=1", "http://x.example.com/a/c?d=1", "http://x.example.com/a/b?d=1", "http://x.example.com/a/b/c"]
    rows = [(bad, True)] * 60 + [(g, False) for g in good for _ in range(60)]
    rules = url_filter.mine(spark.createDataFrame(rows, "url string, bad boolean"))
    judged = url_filter.judge(spark.createDataFrame(list(enumerate([bad, *good])), "page_id bigint, url string"), rules)
    assert {r.page_id: r.verdict for r in judged.collect()} == {0: "block"} | {i: "allow" for i in range(1, 6)}


def test_queries_are_registered():
    names = entry.queries()
    assert {re.match(r"op\d+_", n)[0] for n in queries.QUERIES} == {f"op{i}_" for i in range(1, 11)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)


def test_pipeline_stages_by_hand(spark):
    from tests.llm.test_text_operators import counts_by_hand, linked_by_hand

    columns = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    draw = random.Random(2)
    vocabulary = ["".join(draw.choice(["th", "er", "in", "ou", "n", "st"]) for _ in range(3)) for _ in range(300)]
    plain = [" ".join(draw.choice(vocabulary) for _ in range(90)) for _ in range(40)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(plain)]
    rows += [(100, plain[0] + " more", "en", "s", 1), (101, 'token="abcdefgh1" ' + " ".join(draw.choice(vocabulary) for _ in range(90)), "en", "s", 1), (102, "short", "en", "s", 5), (103, None, None, None, None)]
    rows += [rows[5], (None, plain[7], "en", "s", 1)]
    docs = spark.createDataFrame(rows, columns)
    kept = corpus_pipeline.quality_rules(spark, docs, FOLDER)
    assert kept.schema == docs.schema
    failed = {r[0] for r in rows if counts_by_hand(r[1])[0] < 50}
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in rows} - failed
    left = corpus_pipeline.near_dedup_stage(spark, kept, FOLDER)
    assert left.columns == docs.columns
    roots = linked_by_hand([r for r in dict((x[0], x) for x in rows if x[0] is not None).values() if r[0] not in failed], 5)
    assert sorted(r.doc_id for r in left.where("doc_id is not null").collect()) == sorted(i for i, (_, root) in roots.items() if i == root)
    clean = corpus_pipeline.secret_scans(spark, left, FOLDER)
    assert clean.dtypes == docs.dtypes
    changed = {r.doc_id: r for r in clean.collect()}
    assert changed[101].text.startswith("[SECRET]") and changed[101].n_chars == len(changed[101].text)
    assert all(changed[i].text == t for i, t in enumerate(plain) if i in changed)
    assert corpus_pipeline.pack(spark, clean, FOLDER).select("doc_id").distinct().count() == clean.count()
    assert corpus_pipeline.pack(spark, corpus_pipeline.secret_scans(spark, corpus_pipeline.near_dedup_stage(spark, corpus_pipeline.quality_rules(spark, docs.limit(0), FOLDER), FOLDER), FOLDER), FOLDER).count() == 0


def test_pipeline_runs(spark):
    got = corpus_pipeline.run(spark, FOLDER)
    assert 0 < got.select("doc_id").distinct().count() <= table(spark, FOLDER, "documents").count()
