"""Preference formatting and URL rules on small fixtures; the registered queries against their SQL."""

import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from oracle import connect, difference
from stationflow.llm import preference_chat, queries, url_rules

SMALL = "/root/testdata/sf0.001"


def turns(spark, rows):
    return spark.createDataFrame(rows, "pair_id long, turn long, role string, text string").withColumn("prompt", F.lit("clash"))


def test_preferences(spark):
    chosen = [(1, 0, "user", "hi"), (1, 1, "assistant", "good"), (1, 2, "user", "more"), (1, 3, "assistant", "fine"), (2, 0, "user", "same"), (3, 0, None, None), (3, None, "system", "first"), (4, 0, "user", "only here"), (None, 0, "user", "x"), (5, 0, "user", "a"), (5, 0, "user", "a")]
    rejected = [(1, 1, "assistant", "good"), (1, 0, "user", "hi"), (1, 2, "user", "other"), (2, 0, "user", "same"), (3, None, "system", "first"), (3, 7, "assistant", "ü日"), (6, 0, "user", "only there"), (5, 0, "user", "a")]
    got = {r.pair_id: r for r in preference_chat.format_preferences(turns(spark, chosen), turns(spark, rejected)).collect()}
    assert set(got) == {1, 2, 3, 5}
    say = lambda role, text: f"<|{role}|>\n{text}<|end|>\n"
    assert (got[1].n_prompt_turns, got[1].prompt) == (2, say("user", "hi") + say("assistant", "good"))
    assert got[1].chosen == say("user", "more") + say("assistant", "fine") and got[1].rejected == say("user", "other")
    assert [got[1].chosen[s.start : s.end] for s in got[1].chosen_spans] == ["fine<|end|>\n"] and got[1].rejected_spans == []
    assert (got[2].prompt, got[2].chosen, got[2].rejected) == (say("user", "same"), "", "")
    assert got[3].prompt == say("system", "first") and got[3].chosen == say("unknown", "")
    assert [got[3].rejected[s.start : s.end] for s in got[3].rejected_spans] == ["ü日<|end|>\n"]
    assert (got[5].prompt, got[5].chosen, got[5].rejected) == (say("user", "a"), say("user", "a"), "")
    assert preference_chat.format_preferences(turns(spark, []), turns(spark, rejected)).count() == 0


def test_every_conversation_comes_back(spark, tmp_path):
    rows = [(5, 0, "user", "q5"), (5, 1, "assistant", "a5"), (5, 2, "user", "thanks"), (8, 0, "user", "q8"), (20, 0, "user", "q20"), (20, 1, "assistant", "a20"), (31, None, "assistant", "a31"), (33, 0, None, None)]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.pair_id: r for r in queries.op3_preference_chat(spark, str(tmp_path)).collect()}
    say = lambda role, text: f"<|{role}|>\n{text}<|end|>\n"
    assert {k: (r.prompt, r.chosen, r.rejected) for k, r in got.items()} == {
        5: (say("user", "q5"), say("assistant", "a5") + say("user", "thanks"), say("assistant", "a20")),
        8: (say("user", "q8"), "", ""),
        20: (say("user", "q20"), say("assistant", "a20"), say("assistant", "a31")),
        31: ("", say("assistant", "a31"), say("assistant", "a5")),
        33: (say("unknown", ""), "", ""),
    }
    assert queries.op3_preference_chat(spark, "/root/testdata/sf0.01").count() == spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id").distinct().count()


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash"))


def test_urls(spark):
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, decision string")
    link = '<html><LINK href="{}" rel="canonical"></html>'
    rows = [
        (1, "http://Blog.Example.com/en/1", None), (2, "https://www.example.com/en/1?x", ""), (3, "http://a.net/es/2#t", None), (4, "http://a.net/de/2", link.format("http://b.net/fr/9")),
        (5, "http://a.org/x", '<meta http-equiv="refresh" content="0; url=/y">'), (6, "http://a.org/y/", link.format("//a.net/de/2")), (7, "http://a.org/z", None), (8, None, None), (9, "mailto:x", "y"),
        (10, "http://c.com/k", link.format("http://b.net/fr/9")), (11, "http://example.com", None), (12, "http://badexample.com/en/", None), (7, "http://a.org/z", None), (13, "http://d.org/", link.format("rel/../")),
    ]
    got = sorted((r.page_id, r.rule, r.verdict, r.via) for r in url_rules.judge_urls(pages(spark, rows), rules).collect())
    assert got == [
        (1, "example.com/en/", "block", "rule"), (2, "www.example.com/en/", "allow", "rule"), (3, "net/es/", "block", "rule"), (4, None, "block", "alias"), (5, None, "block", "alias"), (6, None, "block", "alias"),
        (7, None, "allow", "default"), (7, None, "allow", "default"), (8, None, "allow", "default"), (9, None, "allow", "default"), (10, "com/", "allow", "rule"), (11, None, "allow", "default"), (12, "com/", "allow", "rule"), (13, None, "allow", "default"),
    ]
    told = {r.page_id: (r.host, r.path) for r in url_rules.judge_urls(pages(spark, rows), rules.limit(0)).collect()}
    assert told[1] == ("blog.example.com", "/en/1") and told[8] == ("", "") and told[9] == ("", "") and told[11] == ("example.com", "")
    assert url_rules.judge_urls(pages(spark, []), rules).count() == 0


def test_spellings_of_one_address(spark):
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, decision string")
    link = '<link rel=canonical href="{}">'
    rows = [
        (1, "http://a.org:80/x", link.format("http://a.net/fr/1")), (2, "http://a.org/x/", None), (3, "https://a.org:443/y/../x", None), (4, "https://a.org:80/x", None), (5, "http://b.org/p?a=1&b=2", None),
        (6, "http://b.org/q", link.format("./p?a=1&amp;b=2")), (7, "http://b.org/r", link.format("../q#top") + link.format("http://free.org/")), (8, "http://c.org/", link.format("http://a.net/es/")),
        (9, "http://d.org/", "<!-- " + link.format("http://a.net/es/") + " -->"), (10, "http://e.org/", "<script>" + link.format("http://a.net/es/") + "</script>"), (11, "http://f.org/", "<!-- " + link.format("http://a.net/es/")),
        (12, "http://b.org/p?a=1&b=2#x", link.format("http://b.net/es/..a/../.b/")), (13, "http://b.net:80/es/.b", None), (14, "http://a.org", link.format("http://a.org:/x")), (15, "http://a.org/../..", None),
    ]
    got = {r.page_id: (r.verdict, r.via) for r in url_rules.judge_urls(pages(spark, rows), rules).collect()}
    assert {k for k, v in got.items() if v == ("block", "alias")} == {1, 2, 3, 5, 6, 7, 8, 12, 13, 14, 15}  # 13: a host with a port fits no rule, its address does
    assert all(got[k] == ("allow", "default") for k in (4, 9, 10, 11))


def test_alias_chains_equal_sql(spark, tmp_path):
    deal = random.Random(5)
    urls = [f"{deal.choice(['http', 'https'])}://{deal.choice(['a.org', 'B.net', 'www.example.com', 'x.com', 'c.org:80', 'c.org', 'c.org:443'])}/{deal.choice(['en', 'es', 'fr', 'de'])}/{deal.choice(['', './', 'q/../', '../'])}{k % 40}{deal.choice(['', '/', '#t', '?k=1&l=2'])}" for k in range(160)]
    tags = ['<link rel="canonical" href="{}">', '<meta http-equiv=refresh content="0; url={}">', "<!-- <link rel=canonical href='{}'> -->", "<p>{}</p>"]
    html = [None if k % 11 == 0 else deal.choice(tags).format(deal.choice([*urls, f"../es/{k % 40}", f"/fr/{k % 40}", "//a.org/de/1", str(k % 7)]).replace("&", "&amp;")) for k in range(160)]
    pd.DataFrame({"page_id": range(160), "url": urls, "html": html}).to_parquet(tmp_path / "pages.parquet")
    ours = queries.op2_url_filters(spark, str(tmp_path)).toPandas()
    assert set(ours.via) == {"rule", "alias", "default"}
    assert difference(ours, connect(str(tmp_path)).execute(queries.SQL["op2_url_filters"]).df()) is None


def test_chat_and_fingerprints_equal_sql_on_odd_rows(spark, tmp_path):
    talk = [(5, 0, "user", "q5"), (5, 1, "assistant", "a5"), (5, 2, "user", "thanks"), (8, 0, "user", "q"), (20, 0, None, "日本"), (20, 1, "assistant", "é" * 9), (20, 1, "assistant", "b"), (31, None, "assistant", None), (33, 0, None, None), (40, 3, "assistant", "a5")]
    pd.DataFrame(talk, columns=["conv_id", "turn", "role", "text"]).astype({"turn": "Int64"}).to_parquet(tmp_path / "conversations.parquet")
    texts = ["ab\ncd\n" * 400, "", None, "x" * 301, "日本語é😀" * 50, "\n\n\n", "ab\ncd\n" * 400, "one line\r\nand more", " ".join(map(str, range(3000))), "q"]
    pd.DataFrame({"doc_id": range(7, 7 + len(texts)), "text": texts}).to_parquet(tmp_path / "documents.parquet")
    con = connect(str(tmp_path))
    for name in ("op3_preference_chat", "op6_merkle_fingerprints"):
        assert difference(queries.QUERIES[name](spark, str(tmp_path)).toPandas(), con.execute(queries.SQL[name]).df()) is None


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SMALL).toPandas(), connect(SMALL).execute(queries.SQL[name]).df()) is None


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    seen, before = docs, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        seen = stage(spark, seen, SMALL)
        assert seen.columns == docs.columns
        if name != "mixing":
            assert seen.count() <= before
    out = corpus_pipeline.run(spark, SMALL)
    assert out.count() > 0 and {"doc_id", "ids", "n_pieces"} <= set(out.columns)
    texts = [r.text for r in corpus_pipeline.STAGES[1][1](spark, docs, SMALL).collect()]
    assert len(texts) == len(set(texts)) == duckdb.sql(f"SELECT count(DISTINCT text) FROM '{SMALL}/documents.parquet'").fetchall()[0][0]
