"""The operators made of Spark expressions alone: chat formatting and URL filters."""

import math
import re
from collections import Counter, defaultdict

import brute
from boardsmith.llm import chat, url_filter
from boardsmith.llm.url_filter import ORDER, SMOOTHING, START, SYMBOLS, Rule

TURNS = "conv_id bigint, turn bigint, role string, text string, messages int, t string"


def chat_rows(turns):
    rows = chat.digests(chat.read_back(chat.format_conversations(turns)))
    return sorted((tuple(r)[:5] for r in rows.collect()), key=repr)


def chat_brute(turns):
    by = defaultdict(list)
    for r in turns.collect():
        by[r["conv_id"]].append((r["turn"] is not None, r["turn"], r["role"] or "", r["text"] or ""))
    out = []
    for conv, own in by.items():
        own.sort(key=lambda x: (x[0], x[1] or 0, x[2], x[3]))
        loss = "".join(t for *_, r, t in own if r == "assistant")
        out.append((conv, len(own), brute.sha("".join(f"{r}\n{t}\n" for *_, r, t in own)), len(loss), brute.sha(loss)))
    return sorted(out, key=repr)


def test_chat(spark, sf):
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    assert chat_rows(turns) == chat_brute(turns)


def test_chat_odd_rows(spark):
    rows = [(1, 0, "user", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "&lt;|x|>[TURN]<|user|>&amp;#91;"), (1, 2, "assistant", ""), (1, 3, "assistant", None), (1, None, None, "no role"),
            (2, 0, "a|b>c</s>", "x"), (2, 0, "a|b>c</s>", "x"), (2, 0, "user", "tie"), (None, 1, "user", "n"), (3, 1, "assistant", "long " * 50_000), (4, 5, "", "")]
    turns = spark.createDataFrame([(*r, 1, "z") for r in rows], TURNS)
    assert chat_rows(turns) == chat_brute(turns)
    assert chat_rows(turns.limit(0)) == []


def test_chat_merges_adjacent_turns(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")], "conv_id bigint, turn bigint, role string, text string")
    (row,) = chat.format_conversations(turns).collect()
    assert [(m["role"], m["texts"]) for m in row["messages"]] == [("user", ["a", "b"]), ("assistant", ["c"])]
    assert row["formatted"] == "<|user|>a[TURN]b</s><|assistant|>c</s>"


def parts(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    return ("".join(c.lower() if c.isascii() else c for c in m[1]), m[2]) if m else ("", "")


def ruled(url, rules):
    host, path = parts(url)
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.pattern), default=None)


def test_rules(spark):
    urls = ["https://a.ORG/x", "http://org/", "http://org", "http://xorg/", "https://b.example.org/es/1?q", "https://example.org/en/12", "https://example.org/en/2", "//no", None, "", "x://y.com/fr/#z",
            "http://y.com/de/", "http://y.com/d", "http://h?q://org/", "a://b://org/"]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id bigint, url string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"]) for r in url_filter.judge_urls(df).collect()}
    for i, u in enumerate(urls):
        rule = ruled(u, url_filter.RULES)
        assert got[i] == (*parts(u), rule and rule.pattern), u
    assert url_filter.judge_urls(df.limit(0)).count() == 0


def fold(url):
    return re.sub(r"[^a-z0/.\-]", "~", re.sub("[0-9]", "0", (url or "").lower()))


def model(train):
    count = {True: Counter(), False: Counter()}
    for text, good in train:
        for i in range(len(text)):
            whole = START * ORDER + text
            for k in range(ORDER + 1):
                count[good][whole[i + ORDER - k:i + ORDER + 1]] += 1
    seen = set(count[True]) | set(count[False])
    total = {g: Counter() for g in count}
    for g in count:
        for gram, n in count[g].items():
            total[g][len(gram), gram[:-1]] += n

    def p(g, gram):
        below = p(g, gram[1:]) if len(gram) > 1 else 1.0 / SYMBOLS
        return (count[g][gram] + SMOOTHING * below) / (total[g][len(gram), gram[:-1]] + SMOOTHING)

    def score(text):
        whole, out = START * ORDER + text, 0.0
        for i in range(len(text)):
            for k in range(ORDER, -1, -1):
                gram = whole[i + ORDER - k:i + ORDER + 1]
                if gram in seen:
                    out += math.log(p(True, gram) / p(False, gram))
                    break
        return out / len(text) if text else 0.0

    return score


def test_model_equals_brute_force(spark, sf):
    df = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url")
    odd = spark.createDataFrame([(9001, None), (9002, ""), (9003, "ftp://é.net/Ü?1"), (9003, "ftp://é.net/Ü?1"), (None, "http://q.net/")], df.schema)
    df = df.unionByName(odd)
    held = {r["url"]: r["h"] for r in df.selectExpr("url", f"pmod(xxhash64(url), {url_filter.HELD_OUT}) = 0 AS h").collect()}
    labelled = [(r["url"], ruled(r["url"], url_filter.RULES)) for r in df.collect()]
    train = [(fold(u), rule.verdict == "allow") for u, rule in labelled if rule and not held[u]]
    assert {g for _, g in train} == {True, False}
    score = model(train)
    rows = url_filter.judge_urls(df).collect()
    assert len(rows) == df.count()
    by_id = {r["page_id"]: r["url"] for r in df.collect()}
    for r in rows:
        assert abs(r["score"] - score(fold(by_id[r["page_id"]]))) < 1e-9
    good = sorted(score(fold(u)) for u, rule in labelled if rule and held[u] and rule.verdict == "allow")
    free = [r for r in rows if r["rule"] is None]
    blocked, allowed = [r["score"] for r in free if r["verdict"] == "block"], [r["score"] for r in free if r["verdict"] == "allow"]
    least = min([x for x in good if not blocked or x > max(blocked)], default=None)
    assert least is None or all(x >= least - 1e-9 for x in allowed) or not blocked or max(blocked) < min(allowed)


def test_without_one_class(spark):
    df = spark.createDataFrame([(1, "http://a.org/x"), (2, "http://b.net/y")], "page_id bigint, url string")
    assert {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(df).collect()} == {1: "allow", 2: "allow"}
    assert Rule("block", "a.b/c").host == "a.b" and Rule("block", "a.b/c").path == "/c"
