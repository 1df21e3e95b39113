from skyledger.llm import url_trust as U
from tests.conftest import SF

URLS = [
    ("http://WWW.Example.com/en/1", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("http://a.example.com/en/?q#x", "a.example.com", "/en/", "example.com/en/", "block"),
    ("http://example.com/de", "example.com", "/de", "com/", "allow"),
    ("ftp://x.net/es/1", "x.net", "/es/1", "net/es/", "block"),
    ("x://planet/fr/", "planet", "/fr/", None, "allow"),
    ("http://com", "com", "", None, "allow"),
    ("http://a.com?x=/en/", "a.com", "", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("a://b://c/d", "b:", "//c/d", None, "allow"),
]


def test_hosts_paths_and_rules(spark):
    rows = [(i, u[0], None, "clash") for i, u in enumerate(URLS)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = {r.page_id: r for r in U.judged(pages).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(URLS):
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict)
    assert U.judged(pages.limit(0)).count() == 0


def test_spread_equals_plain_iteration(spark):
    links = [("t", "a"), ("t", "a"), ("a", "b"), ("c", "bad"), ("d", "c"), ("d", "t"), ("b", "x"), ("e", "bad")]
    pages = [(f"{s}.org", f'<a href="//{t}.org/x">') for s, t in links]
    pages += [("t.org", None)] * 4 + [("bad.org", "")] * 3
    rows = [(i, f"http://{h}/{'ok' if h == 't.org' else 'no' if h == 'bad.org' else ''}", p) for i, (h, p) in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    rules = (("allow", "t.org", "/ok"), ("block", "bad.org", "/no"))
    got = {r.host: r for r in U.judged(df, rules).collect()}
    count = {}
    for s, t in links:
        count[s, t] = count.get((s, t), 0) + 1
    hosts = sorted({h for e in links for h in e})
    trust = {h: float(h == "t") for h in hosts}
    distrust = {h: float(h == "bad") for h in hosts}
    seeds = dict(trust), dict(distrust)
    for _ in range(200):
        new = {h: 0.15 * seeds[0][h] for h in hosts}, {h: 0.15 * seeds[1][h] for h in hosts}
        for (s, t), n in count.items():
            new[0][t] += 0.85 * trust[s] * n / sum(m for (a, _), m in count.items() if a == s)
            new[1][s] += 0.85 * distrust[t] * n / sum(m for (_, b), m in count.items() if b == t)
        trust, distrust = new
    for h in ("a", "b", "c", "d", "e"):
        r = got[f"{h}.org"]
        assert abs(r.trust - trust[h]) < 1e-9 and abs(r.distrust - distrust[h]) < 1e-9
        blocked = distrust[h] > 0 and distrust[h] / (trust[h] + distrust[h]) >= U.THRESHOLD - 1e-9
        assert r.verdict == ("block" if blocked else "allow")
    assert {got["c.org"].verdict, got["e.org"].verdict} == {"block"} and got["a.org"].verdict == "allow"


def test_query_returns_every_page(spark):
    out = U.op5_url_trust(spark, SF)
    assert out.columns[:5] == ["page_id", "host", "path", "rule", "verdict"]
    assert out.count() == spark.read.parquet(f"{SF}/pages.parquet").count()


def test_partly_blocked_hosts_seed_and_sites_meet_at_their_domain(spark):
    urls = ["http://a.x.net/es/1", "http://a.x.net/1", "http://a.x.net/2", "http://b.x.net/1", "http://c.y.net/1", "http://z.com/1"]
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in U.judged(pages).collect()}
    assert got == {0: "block", 1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow"}


def test_distrust_reaches_the_end_of_a_long_chain(spark):
    """Thirty hosts, each linking to the next; the last one is blocked by a rule."""
    pages = [(f"h{i}.org", f'<a href="http://h{i + 1}.org/">' * (1 + i % 2)) for i in range(30)] + [("h30.org", None)]
    rows = [(i, f"http://{h}/no", p) for i, (h, p) in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.host: r for r in U.judged(df, (("block", "h30.org", "/no"),)).collect()}
    for i in range(30):
        assert abs(got[f"h{i}.org"].distrust - 0.15 * 0.85 ** (30 - i)) < 1e-9
        assert (got[f"h{i}.org"].rule, got[f"h{i}.org"].verdict) == (None, "block")


def test_cycles_settle_within_the_tolerance(spark):
    hosts = spark.createDataFrame([("a", 1.0, 0.0), ("b", 0.0, 1.0), ("c", 0.0, 0.0)], "host string, trust_seed double, distrust_seed double")
    edges = spark.createDataFrame([("a", "b", 1), ("b", "c", 3), ("c", "a", 2), ("c", "b", 2)], "source string, target string, n long")
    got = {r.host: (r.trust, r.distrust) for r in U.spread(hosts, edges).collect()}
    trust, distrust = {"a": 1.0, "b": 0.0, "c": 0.0}, {"a": 0.0, "b": 1.0, "c": 0.0}
    for _ in range(400):
        trust = {
            "a": 0.15 + 0.85 * trust["c"] / 2, "b": 0.85 * (trust["a"] + trust["c"] / 2), "c": 0.85 * trust["b"],
        }
        distrust = {
            "a": 0.85 * distrust["b"] / 3, "b": 0.15 + 0.85 * distrust["c"],
            "c": 0.85 * (distrust["b"] * 2 / 3 + distrust["a"]),
        }
    for h in "abc":
        assert abs(got[h][0] - trust[h]) + abs(got[h][1] - distrust[h]) < 2 * U.TOLERANCE * 0.85 / 0.15


def test_long_and_repeated_pages(spark):
    long = '<a href="//b.org/">' + "x" * 3_000_000 + '<a href="//c.org/">'
    rows = [(1, "http://a.org/", long)] * 3 + [(2, "http://b.org/no", "")]
    got = U.judged(spark.createDataFrame(rows, "page_id long, url string, html string"), (("block", "b.org", "/no"),))
    assert sorted((r.page_id, r.verdict) for r in got.collect()) == [(1, "block")] * 3 + [(2, "block")]


def test_each_round_is_a_plan_of_its_own(spark, monkeypatch):
    """The driver holds one join at a time, however many rounds there are."""
    joins, plain = [], U.staged

    def staged(df, name):
        if name == "spread":
            joins.append(df._jdf.queryExecution().analyzed().toString().count("Join "))
        return plain(df, name)

    monkeypatch.setattr(U, "staged", staged)
    hosts = spark.createDataFrame([("a", 1.0, 0.0), ("b", 0.0, 1.0)], "host string, trust_seed double, distrust_seed double")
    edges = spark.createDataFrame([("a", "b", 1)], "source string, target string, n long")
    got = {r.host: (r.trust, r.distrust) for r in U.spread(hosts, edges, 0.1).collect()}
    assert set(joins) == {1}
    assert abs(got["b"][0] - 0.85 * 0.15) < 1e-9 and abs(got["a"][1] - 0.85 * 0.15) < 1e-9
