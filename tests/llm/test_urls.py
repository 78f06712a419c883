import re
from collections import Counter

import duckdb
from chartfold.llm import queries, urls

SF = "/root/testdata/sf0.01"


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest)[0]
    path = re.split("[?#]", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_query(spark):
    rows = queries.op1_urls(spark, SF).collect()
    pages = dict(duckdb.sql(f"select page_id, url from '{SF}/pages.parquet'").fetchall())
    assert len(rows) == len(pages)
    for r in rows:
        assert (r.host, r.path) == parts(pages[r.page_id])
        rule, verdict = rule_of(r.host, r.path)
        assert r.rule == rule and r.verdict in ("allow", "block") and (verdict is None or verdict == r.verdict)


def test_odd_urls(spark):
    odd = [None, "", "no scheme", "HTTP://WWW.Exämple.NET?x", "x://a.b.org/fr/1?y://z", "a://b://c/d", "s://net", "s://h\n/p", "s://fnet/",
           "://example.net/en/", "s://h/" + "a/" * 3000, "s://org/fr/", "s://h/%F0/é?"]
    rows = [(k, u, "clash") for k, u in enumerate(odd)] + [(None, odd[4], "x"), (4, odd[4], "x")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, template string")
    got = urls.judge(df, queries.URL_RULES).collect()
    want = [(k, *parts(u), rule_of(*parts(u))[0]) for k, u, _ in rows]
    assert Counter((r.page_id, r.host, r.path, r.rule) for r in got) == Counter(want)
    assert urls.judge(df.limit(0), queries.URL_RULES).count() == 0
    assert {r.rule for r in urls.judge(df, []).collect()} == {None}


def test_tree_generalises_merges_and_rejects(spark):
    made = []
    for k in range(200):
        made.append((f"s://h/item/name{k}x{k}/view", False))
        made.append((f"s://h/casino/{k}", True))
        made.append((f"s://h/en/{k}", k % 10 == 0))
        made.append((f"s://h/de/{k}", k % 9 == 0))
        made.append((f"s://h/user/p{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]}{'uv'[k // 100]}", False))
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(made)], "page_id bigint, url string")
    labels = spark.createDataFrame([(i, b) for i, (_, b) in enumerate(made) if i % 2 == 0 or i % 5 == 1], "page_id bigint, bad boolean")
    rows = {r.page_id: r for r in urls.judge(pages, [], labels).collect()}
    for i, (url, _) in enumerate(made):
        assert rows[i].verdict == ("block" if "/casino/" in url else "allow"), rows[i]
    template = lambda start: {rows[i].template for i, (u, _) in enumerate(made) if u.startswith("s://h/" + start)}
    assert template("casino/") == {"/casino/{n}"}
    # Two languages with the same rate are one branch, names of users too.
    assert len(template("user/")) == 1 and "pak" not in template("user/").pop()


def test_deviating_sections_of_wide_nodes_stay(spark):
    """Of 100 sections with a hundredth of the urls each, two are bad."""
    names = [f"{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    made = [(f"s://h/{name}/page{k}", name in ("ck", "hr")) for name in names for k in range(20)]
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(made)], "page_id bigint, url string")
    labels = spark.createDataFrame([(i, b) for i, (_, b) in enumerate(made) if i % 20 < 15], "page_id bigint, bad boolean")
    rows = urls.judge(pages, [], labels).collect()
    assert [r.verdict for r in sorted(rows)] == ["block" if b else "allow" for _, b in made]


def test_no_python_on_executors(spark, capsys):
    queries.op1_urls(spark, SF).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def verdicts(spark, made, labelled):
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(made)], "page_id bigint, url string")
    labels = spark.createDataFrame([(i, b) for i, (_, b) in enumerate(made) if labelled(i)], "page_id bigint, bad boolean")
    return sorted(urls.judge(pages, [], labels).collect())


def test_directories_that_part_at_any_depth(spark):
    """At segment 13 behind a common start, and behind forks above it."""
    start = "/".join("abcdefghijkl")
    made = [(f"s://h/{start}/{'bad' if k % 3 == 0 else 'good'}/page{k}", k % 3 == 0) for k in range(300)]
    made += [(f"s://g/{'xyz'[k % 3]}/{start}/{'bad' if k % 2 else 'good'}/page{k}", bool(k % 2)) for k in range(300)]
    rows = verdicts(spark, made, lambda i: i % 5 < 3)
    assert [r.verdict for r in rows] == ["block" if b else "allow" for _, b in made]


def test_numbers_that_tell_labels_apart_stay(spark):
    made = [(f"s://h/{2019 + k % 2}/page{k}", k % 2 == 0) for k in range(300)]
    made += [(f"s://g/v{k % 9}/item{k}", False) for k in range(100)] + [("s://g/x", True)] * 8
    rows = verdicts(spark, made, lambda i: i % 5 < 3 or i >= 400)
    assert [r.verdict for r in rows[:400]] == ["block" if b else "allow" for _, b in made[:400]]
    assert {r.template for r in rows[:300:2]} == {"/2019/page{n}"}
    assert {r.template for r in rows[300:400]} == {"/v{n}/item{n}"}


def test_purity_is_smoothed_once_per_labels(spark):
    """Segments that part nothing do not count the same labels again."""
    made = [(f"s://h/a/{'b' if k < 8 else 'c'}/d{k}/e/f", k < 8) for k in range(16)]
    rows = verdicts(spark, made, lambda i: True)
    host = (8 + 10 * 0.5) / (16 + 10)
    assert {round(r.purity, 9) for r in rows[:8]} == {round((8 + 10 * host) / 18, 9)}


def test_segments_that_read_like_marks(spark):
    made = [(f"s://h/{s}/p{k}", s == "*") for k in range(40) for s in ("*", "~", "u", "v")]
    rows = verdicts(spark, made, lambda i: True)
    assert [r.verdict for r in rows] == ["block" if b else "allow" for _, b in made]
