import re

import pytest
from pyspark.sql import functions as F

from sampwise.llm import chat
from sampwise.llm.urls import judge_urls
from tests.llm.conftest import with_clashes

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/es/", "allow"), ("", "", "block"), (None, None, None),
         ("a.b", "/pre", "block")]
URLS = ["http://EXAMPLE.com/en/x?q#f", "https://www.example.com/en/", "http://x.net/es/1", "http://x.net/ES/1",
        "http://example.com", "http://example.com?x=/en/", "no scheme", None, "", "://", "http:///path",
        "http://a.b/prefix/more", "http://xa.b/prefix", "ftp://u:p@a.b:80/pre", "http://one://two/en/",
        "http://ÄÖ.com/é/漢", "http://example.com/" + "long/" * 5000, "http://a.b/pre\nx"]


def brute(url, rules):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m.group(1)) if m else ""
    path = m.group(2) if m else ""
    best = None
    for h, p, v in rules:
        h, p, v = h or "", p or "", v or ""
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (-1,), (len(h + p), len(h), v, h + p))
    return host, path, best[3] if best else None, best[2] if best else "allow"


@pytest.mark.parametrize("broadcast", [1000, 0])
def test_urls_match_brute_force(spark, broadcast):
    rows = list(enumerate(URLS)) + [(0, URLS[0]), (None, URLS[1])]
    df = with_clashes(spark.createDataFrame(rows, "page_id long, url string"))
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = judge_urls(df, rules, broadcast_rules=broadcast).collect()
    want = sorted(((i, *brute(u, RULES)) for i, u in rows), key=repr)
    assert sorted(((r["id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got), key=repr) == want


def test_long_hosts(spark):
    """Hosts of thousands of labels: only suffixes as long as a rule's host are built."""
    urls = ["http://" + "a." * n + tail for n in (0, 1, 9000) for tail in ("b/pre", "example.com/en/", "net/es/", "")]
    rows = list(enumerate(urls))
    df = spark.createDataFrame(rows, "page_id long, url string")
    rules = [*RULES, ("a." * 40 + "b", "/", "block"), (".b", "", "allow")]
    got = judge_urls(df, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()
    assert sorted((r["id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got) == sorted(
        (i, *brute(u, rules)) for i, u in rows)


def test_no_rules_and_no_urls(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert judge_urls(df.limit(0), rules).collect() == []
    got = judge_urls(df, rules.limit(0), default="block").collect()
    assert len(got) == len(URLS) and {r["verdict"] for r in got} == {"block"}


TURNS = [(1, 0, "user", "plain"), (1, 1, "user", "merged <|im_part|> <\\|im_end|>"), (1, 2, "assistant", "a\n"),
         (1, 3, "assistant", ""), (2, 5, None, None), (2, None, "assistant", "<|im_start|>assistant\nhi<|im_end|>\n"),
         (3, 0, "ro\nle\\n", "<<|<\\\\|>|"), (3, 0, "ro\nle\\n", "<<|<\\\\|>|"), (None, 0, "user", "漢🙂"),
         (4, 1, "assistant", "x" * 300_000), (4, 0, "system", " \t "), (5, 0, "assistant", "<|im_end|>" * 3)]


def test_chats_round_trip(spark):
    df = with_clashes(spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string"))
    out = (chat.format_chats(df).withColumn("back", chat.parse_chats(F.col("formatted")))
           .withColumn("loss", chat.unescaped_loss(F.col("segments"))))
    key = lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or "")
    rows = out.collect()
    assert {r["conv_id"] for r in rows} == {t[0] for t in TURNS}
    for r in rows:
        mine = [(t[2] or "", t[3] or "") for t in sorted((t for t in TURNS if t[0] == r["conv_id"]), key=key)]
        assert [(t["role"], t["text"]) for t in r["back"]] == mine
        assert r["loss"] == "".join(text for role, text in mine if role == "assistant")
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
        blocks = 1 + sum(a[0] != b[0] for a, b in zip(mine, mine[1:]))
        assert r["formatted"].count(chat.START) == r["formatted"].count(chat.END) == blocks


def test_no_chats(spark):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").limit(0)
    assert chat.format_chats(df).collect() == []


def test_plans_hold_no_python(spark):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    plan = chat.format_chats(df.select("conv_id", "turn", "role", "text"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
