import random
import re
from collections import Counter, defaultdict

import pandas as pd
import pytest

from wapspark.llm import url_filter as U
from wapspark.llm.registry import URL_RULES, op1_url_filter


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(
        r"[^?#]*", rest[len(host):])[0]


def rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def brute(urls):
    """Templates grown by recursion over each host's paths."""
    parsed = [parse(u) for u in urls]
    fits = [rule(h, p) for h, p in parsed]
    hosts = defaultdict(list)
    for (h, p), (_, v) in zip(parsed, fits):
        hosts[h].append(([s for s in p.split("/") if s], p, v))
    lab = sum(v is not None for _, v in fits)
    overall = sum(v == "block" for _, v in fits) / lab if lab else 0
    share = {}

    def smooth(rows, rate):
        bad, n = sum(v == "block" for _, _, v in rows), sum(v is not None for _, _, v in rows)
        return (bad + U.SMOOTHING * rate) / (n + U.SMOOTHING)

    def down(host, rows, tokens, rate):
        depth = len(tokens)
        rate = smooth(rows, rate)
        ends = [r for r in rows if len(r[0]) == depth]
        for r in ends:
            share[host, r[1]] = ("/" + "/".join(tokens), rate)
        more = [r for r in rows if len(r[0]) > depth]
        bad, labelled = sum(v == "block" for _, _, v in more), sum(v is not None for _, _, v in more)
        if depth >= U.DEPTH and not 0 < bad < labelled:
            for r in more:
                share[host, r[1]] = ("/" + "/".join([*tokens, "**"]), smooth(more, rate))
            return
        count = Counter(r[0][depth] for r in more)
        kept = [s for s, n in count.items() if n >= U.LITERAL_URLS and n >= U.LITERAL_SHARE * len(more)]
        token = {}
        if kept:
            frame = pd.DataFrame([(host, "", s, sum(r[2] == "block" for r in more if r[0][depth] == s),
                                   sum(r[2] is not None for r in more if r[0][depth] == s))
                                  for s in kept], columns=["host", "prefix", "seg", "bad", "lab"])
            token = dict(U.merge_branches(frame)[["seg", "token"]].itertuples(index=False))
        branch = defaultdict(list)
        for r in more:
            branch[token.get(r[0][depth], "*")].append(r)
        for t, part in branch.items():
            down(host, part, [*tokens, t], rate)

    for h, rows in hosts.items():
        down(h, rows, [], overall)
    out = []
    for (h, p), (r, v) in zip(parsed, fits):
        template, s = share[h, p]
        out.append((h, p, r, v or ("block" if s >= U.REJECT else "allow"), template, pytest.approx(s)))
    return out


def differs(bad, lab, all_bad, all_lab):
    n, x = all_lab - lab, all_bad - bad
    if not lab or not n:
        return False
    p = all_bad / all_lab
    spread = (p * (1 - p) * (1 / lab + 1 / n)) ** 0.5
    return spread > 0 and abs(bad / lab - x / n) >= U.Z * spread


def brute_templates(rows, wide=None):
    """Per path its tokens; ``rows`` (path, n, bad, lab) of one host, domain or
    all hosts, ``wide`` the tokens of the wider tree by path."""
    out = {}

    def down(part, tokens):
        d = len(tokens)
        more = []
        for r in part:
            segs = [re.sub(r"([\\*{|}])", r"\\\1", s) for s in r[0].split("/") if s]
            if len(segs) > d:
                more.append((segs[d], *r))
            else:
                out[r[0]] = tokens
        if wide is None:
            divided = d < U.DEPTH or 0 < sum(r[3] for r in more) < sum(r[4] for r in more)
            around = {r[1]: "*" if divided else "**" for r in more}
        else:
            around = {r[1]: wide[r[1]][d] for r in more}
        for r in more:
            if around[r[1]] == "**":
                out[r[1]] = (*tokens, "**")
        more = [r for r in more if around[r[1]] != "**"]
        total = [sum(r[k] for r in more) for k in (2, 3, 4)]
        token, kept = {}, defaultdict(list)
        for seg in {r[0] for r in more}:
            n, bad, lab = (sum(r[k] for r in more if r[0] == seg) for k in (2, 3, 4))
            within = {around[r[1]] for r in more if r[0] == seg}
            assert len(within) == 1
            if n >= U.LITERAL_URLS and n >= U.LITERAL_SHARE * total[0]:
                kept[within.pop()].append(("", "", seg, bad, lab))
            elif differs(bad, lab, *total[1:]):
                token[seg] = seg
        for group in kept.values():
            frame = pd.DataFrame(group, columns=["host", "prefix", "seg", "bad", "lab"])
            token.update(U.merge_branches(frame)[["seg", "token"]].itertuples(index=False))
        branch = defaultdict(list)
        for r in more:
            branch[token.get(r[0], around[r[1]])].append(r[1:])
        for t, rest in branch.items():
            down(rest, (*tokens, t))

    down(rows, ())
    return out


def brute_across(urls):
    """As ``brute``, for trees over all hosts, domains and hosts."""
    parsed = [parse(u) for u in urls]
    fits = [rule(h, p) for h, p in parsed]
    keys = [("", ".".join(h.split(".")[-2:]), h) for h, _ in parsed]
    lab = sum(v is not None for _, v in fits)
    overall = sum(v == "block" for _, v in fits) / lab if lab else 0
    tokens, sums = [{}, {}, {}], [defaultdict(lambda: [0, 0]) for _ in range(3)]
    for k in range(3):
        trees = defaultdict(lambda: defaultdict(lambda: [0, 0, 0]))
        for key, (_, p), (_, v) in zip(keys, parsed, fits):
            for j, x in enumerate((1, v == "block", v is not None)):
                trees[key[k]][p][j] += x
        for name, paths in trees.items():
            above = next(key[k - 1] for key in keys if key[k] == name)
            wide = {p: tokens[k - 1][above, p] for p in paths} if k else None
            found = brute_templates([(p, *c) for p, c in paths.items()], wide)
            for p, c in paths.items():
                tokens[k][name, p] = found[p]
                for d in range(len(found[p]) + 1):
                    sums[k][name, found[p][:d]][0] += c[1]
                    sums[k][name, found[p][:d]][1] += c[2]
    out = []
    for key, (h, p), (r, v) in zip(keys, parsed, fits):
        share = overall
        for d in range(len(tokens[2][h, p]) + 1):
            for k in range(3):
                bad, n = sums[k][key[k], tokens[k][key[k], p][:d]]
                share = (bad + U.SMOOTHING * share) / (n + U.SMOOTHING)
        out.append((h, p, r, v or ("block" if share >= U.REJECT else "allow"),
                    "/" + "/".join(tokens[2][h, p]), pytest.approx(share)))
    return out


def urls():
    rng = random.Random(4)
    out = [None, "", "no scheme", "http://", "HTTP://Exa.ORG", "x://a.org/?q", "a://b://c/d#e",
           "http://example.org/en/1", "http://m.example.org/es/9", "http://bad.com/de/1",
           "http://notexample.org/es/1", "http://com/fr/", "http://\nx.com/de/\n1"]
    for i in range(700):
        host = rng.choice(["a.com", "b.example.org", "shop.net", "c.com", "org"])
        path = rng.choice([f"/{rng.choice(['fr', 'de', 'en'])}/{rng.randrange(900)}",
                           f"/de/item/{rng.randrange(50)}/x/y/z{i}", f"/{rng.randrange(300)}.html",
                           "/en/", "//en//7", "/de/list?page=2"])
        out.append(f"https://{host}{path}")
    return out


def test_matches_brute_force(spark):
    given = urls()
    frame = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(given)],
                                  "page_id long, url string, html string, host string")
    got = [tuple(r)[1:] for r in sorted(U.judge(frame, URL_RULES).collect())]
    assert got == brute(given)
    assert any(r[2] is None and r[3] == "block" for r in got)


def test_pages(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    given = sorted((r.page_id, r.url) for r in frame.collect())
    got = [tuple(r) for r in sorted(U.judge(frame, URL_RULES).collect())]
    assert got == [(i, *b) for (i, _), b in zip(given, brute([u for _, u in given]))]


def deep_urls():
    """Labels that differ below six common segments (over hosts alone), rare
    names, and segments that look like tokens."""
    rng = random.Random(7)
    out = [f"https://{host}/a/b/c/d/e/f/{rng.choice(['fr', 'de'])}/{i % 40}"
           for i in range(60) for host in ("m.example.org", "shop.com", "new.net")]
    out += [f"http://example.org/{'es' if i % 2 else 'en'}/a/b/c/d/e/{i % 7}/x" for i in range(90)]
    out += [f"http://{h}/{s}/{i}" for h in ("x.com", "y.x.com", "z.net")
            for s in ("*", "{de|es}", "**", "a|b", "de", "es", "\\") for i in range(9)]
    out += [f"http://{h}/de/a/b/c/d/{s}/{i}" for i in range(7) for s in ("p", "q")
            for h in ("m.example.org", "shop.com", "new.net")]
    return out + ["http://one.net/es/1", "http://one.net/a/b/c/d/e/f/g/h/i/j/k"]


def test_across_hosts_matches_brute_force(spark):
    given = urls() + deep_urls()
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(given)], "page_id long, url string")
    got = [tuple(r)[1:] for r in sorted(U.judge(frame, URL_RULES, across_hosts=True).collect())]
    assert got == brute_across(given)
    # Told apart below the common depth where labels differ, and only there.
    deep = {r[4] for r in got if r[1].startswith(("/de/a/", "/a/"))}
    assert any(t.count("/") > U.DEPTH + 1 for t in deep) and any(t.endswith("/**") for t in deep)


def test_registered_query_matches_brute_force(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    given = sorted((r.page_id, r.url) for r in frame.collect())
    rows = sorted(op1_url_filter(spark, "/root/testdata/sf0.1").collect())
    assert [tuple(r) for r in rows] == [
        (i, *b) for (i, _), b in zip(given, brute_across([u for _, u in given]))]
    verdicts = defaultdict(set)
    for r in rows:
        if r.rule is None:
            verdicts[r.host, r.template].add(r.verdict)
    assert len(verdicts) > 20 and all(len(v) == 1 for v in verdicts.values())


def test_labels_deeper_than_the_common_depth_count(spark):
    given = [f"http://h.net/a/b/c/d/e/{s}/{i}" for s in ("ok", "bad") for i in range(40)]
    frame = spark.createDataFrame(list(enumerate(given)), "page_id long, url string")
    labels = spark.createDataFrame([(u, "/bad/" in u) for u in given[::2]],
                                   "url string, blocked boolean")
    for across in (False, True):
        got = U.judge(frame, [], labels=labels, across_hosts=across).collect()
        assert all((r.verdict == "block") == ("/bad/" in r.path) for r in got)


def test_rows_repeat_and_empty(spark):
    schema = "page_id long, url string"
    frame = spark.createDataFrame([(None, "http://a.net/x"), (None, "http://a.net/x"), (1, None)], schema)
    got = sorted(((r.page_id, r.host, r.verdict) for r in U.judge(frame, URL_RULES).collect()), key=str)
    assert got == [(1, "", "allow"), (None, "a.net", "allow"), (None, "a.net", "allow")]
    assert U.judge(spark.createDataFrame([], schema), URL_RULES).count() == 0


def test_given_labels(spark):
    pages = spark.createDataFrame([(i, f"http://h.net/{'bad' if i % 2 else 'good'}/{i}")
                                   for i in range(100)], "page_id long, url string")
    labels = spark.createDataFrame([(f"http://h.net/{'bad' if i % 2 else 'good'}/{i}", bool(i % 2))
                                    for i in range(40)], "url string, blocked boolean")
    got = {r.page_id: r.verdict for r in U.judge(pages, [], labels=labels).collect()}
    assert got == {i: "block" if i % 2 else "allow" for i in range(100)}
