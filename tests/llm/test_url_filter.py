import random
import re

from silverline.llm.queries import URL_RULES
from silverline.llm.url_filter import judge_urls


def parse(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host = re.sub("[A-Z]", lambda x: x[0].lower(), m[1]) if m else ""
    return host, m[2] if m else ""


def ruled(host, path, rules):
    fits = [(len(h + p), v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else None


def test_hosts_paths_and_rules(spark):
    rnd = random.Random(1)
    urls = [None, "", "no scheme.example.org/es/1", "://", "http://", "HTTP://A.Example.ORG", "http://example.org/es/x?y=/de/", "http://notexample.org/es/",
            "x://y://z.com/de/1", "http://e.com?x=http://a.org/", "http://É.COM/de/", "http://a.com/de", "http://a.com\n/de/1\n2#f", "https://com/fr/1"]
    urls += ["".join(rnd.choices(["http://", "a.", "example.org", "b.com", "/de/", "/en/1", "/es/", "/fr/", "?", "#", "Z", "/", "7"], k=5)) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    for r in judge_urls(df, URL_RULES).collect():
        host, path = parse(r.url)
        rule = ruled(host, path, URL_RULES)
        assert (r.host, r.path, r.rule) == (host, path, rule[1] if rule else None)
        assert r.verdict in ("allow", "block") and (not rule or r.verdict == rule[0])


def test_templates_learn_from_labels(spark):
    rules = [("block", "s.com", "/ads/a"), ("allow", "s.com", "/news/1")]
    urls = [f"http://s.com/ads/a{k}" for k in range(60)] + [f"http://s.com/ads/b{k}" for k in range(40)]
    urls += [f"http://s.com/news/{k}" for k in range(100, 400)] + ["http://other.com/ads/b1"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    found = {r.url: (r.verdict, r.rule, r.template) for r in judge_urls(df, rules).collect()}
    assert found["http://s.com/ads/b7"] == ("block", None, "ads/*")  # its template's labels all say so
    assert found["http://s.com/news/300"] == ("allow", None, "news/{n}")
    assert found["http://other.com/ads/b1"][0] == "allow"


def test_without_rules_or_rows_and_clashing_columns(spark):
    df = spark.createDataFrame([("http://a.com/x", 1, 2)], "url string, Host int, segs int")
    row = judge_urls(df, []).first()
    assert (row.host, row.path, row.rule, row.verdict, row.segs) == ("a.com", "/x", None, "allow", 2)
    assert judge_urls(df.limit(0), URL_RULES).collect() == []
    # without labels nothing is split
    deep = spark.createDataFrame([("http://a.com/" + "/".join("abcdefghij"),)], "url string")
    assert judge_urls(deep, URL_RULES).first().template == "**"


def test_deep_branches_keep_their_own_templates(spark):
    rules = [("block", "s.com", "/a/b/c/d/e/f/g/ads/a"), ("allow", "s.com", "/a/b/c/d/e/f/g/news/1")]
    urls = [f"http://s.com/a/b/c/d/e/f/g/ads/{x}{k}" for x in "ab" for k in range(60)]
    urls += [f"http://s.com/a/b/c/d/e/f/g/news/{k}" for k in range(100, 400)]
    urls += [f"http://s.com/a/b/c/d/e/f/g/ads/{x}x/{k}/y" for x in "ab" for k in range(3)]
    found = {r.url: (r.verdict, r.template) for r in judge_urls(spark.createDataFrame([(u,) for u in urls], "url string"), rules).collect()}
    assert len(found) == len(urls)
    assert found["http://s.com/a/b/c/d/e/f/g/ads/b7"] == ("block", "a/b/c/d/e/f/g/ads/*")
    assert found["http://s.com/a/b/c/d/e/f/g/news/300"] == ("allow", "a/b/c/d/e/f/g/news/{n}")


def look(segment):
    m = re.search(r"\.[a-zA-Z]{1,5}$", segment)
    end = m[0] if m else ""
    base = segment[:len(segment) - len(end)]
    if re.fullmatch("[0-9]+", base):
        return "{n}" + end
    if re.fullmatch("[0-9]{4}-[0-9]{2}(-[0-9]{2})?", base):
        return "{date}" + end
    if re.fullmatch("(?=.*[0-9])[0-9a-fA-F-]{8,}", base):
        return "{hex}" + end
    parts = re.split("[-_]", base)
    return "{slug}" + end if len(parts) >= 4 and all(parts) and "." not in base else segment


def brute(urls, rules, min_labels, min_children, max_mean, strength=5.0, z=2.0, reject=0.8):
    """Level by level on whole lists of segments: [(verdict, template)] of the urls."""
    said, rows = [], []
    for url in urls:
        host, path = parse(url)
        rule = ruled(host, path, rules)
        said.append(rule[0] if rule else None)
        rows.append([host, *map(look, (path[1:] if path.startswith("/") else path).split("/"))])
    for level in range(1, max(map(len, rows))):
        below = {}
        for r in rows:
            if len(r) > level:
                below.setdefault(tuple(r[:level]), []).append(r[level])
        wide = {a for a, kids in below.items() if len(set(kids)) >= min_children and len(kids) <= len(set(kids)) * max_mean}
        rows = [r[:level] + ["*"] + r[level + 1:] if len(r) > level and tuple(r[:level]) in wide else r for r in rows]
    counts = {}
    for r, v in zip(rows, said):
        for k in range(1, len(r) + 1):
            b, n = counts.get(tuple(r[:k]), (0, 0))
            counts[tuple(r[:k])] = (b + (v == "block"), n + (v is not None))
    labelled = [v for v in said if v]
    prior = labelled.count("block") / len(labelled) if labelled else 0.0
    out = []
    for r, v in zip(rows, said):
        share, template = prior, "/".join(r[1:])
        for k in range(1, len(r) + 1):
            b, n = counts[tuple(r[:k])]
            if n and abs(b - n * share) > z * (n * share * (1 - share)) ** 0.5 + 0.5:
                share = (b + strength * share) / (n + strength)
            if n < min_labels:
                if k < len(r):
                    template = "/".join([*r[1:k], "**"])
                break
        out.append((v or ("block" if share >= reject else "allow"), template))
    return out


def test_learned_verdicts_equal_a_plain_tree(spark):
    rnd = random.Random(5)
    rules = [("block", "a.com", "/ads/"), ("allow", "a.com", "/news"), ("block", "b.com", "/u/k"), ("allow", "b.com", "/u/a"), ("block", "c.b.com", "/")]
    urls = []
    for _ in range(2500):
        host = rnd.choice(["a.com", "b.com", "c.b.com", "d.org", "x.a.com"])
        parts = rnd.choice([["ads", "x"], ["news"], ["u", rnd.choice("ak") + str(rnd.randrange(90)) + "q"], ["u", rnd.choice("akz"), "p"], ["t"], []])
        parts = parts + rnd.choices(["p", "q.html", "12", "2024-01-02", "one-two-three-four", "a__b-c-d", "deadbeef01", "v%d" % rnd.randrange(400), ""], k=rnd.randrange(4))
        urls.append(f"http://{host}/" + "/".join(parts))
    df = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    for options in ({"min_labels": 5, "min_children": 30, "max_mean": 4.0}, {"min_labels": 1, "min_children": 20, "max_mean": 6.0}):
        got = sorted((r.page_id, r.verdict, r.template) for r in judge_urls(df, rules, **options).collect())
        assert got == [(i, *w) for i, w in enumerate(brute(urls, rules, **options))]
        assert len({t for _, _, t in got}) > 5 and {v for _, v, _ in got} == {"allow", "block"}


def test_long_and_deep_urls(spark):
    rules = [("block", "s.com", "/a/")]
    urls = ["http://s.com/" + "x-" * 20_000 + "x", "http://s.com/" + "-" * 20_000, "http://s.com/" + "1" * 20_000, "http://s.com/a/" + "/".join("d" * 2000),
            *["http://s.com/a/" + "/".join(f"{k}q{j}" for j in range(42)) for k in range(6)]]
    found = {r.url: (r.verdict, r.template) for r in judge_urls(spark.createDataFrame([(u,) for u in urls], "url string"), rules).collect()}
    assert len(found) == len(urls) and found[urls[0]][1] == "{slug}" and found[urls[2]][1] == "{n}"
    assert found[urls[3]] == ("block", "a/d/**") and all(found[u][1] == f"a/{k}q0/**" for k, u in enumerate(urls[4:]))
