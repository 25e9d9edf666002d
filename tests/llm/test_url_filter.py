from datetime import date

from fleetscope.llm import url_filter as U

D = lambda m, d: date(2024, m, d)

LOG = [("domain", "bad.org", "add", D(2, 1)), ("domain", "bad.org", "remove", D(3, 1)), ("domain", "bad.org", "add", D(5, 1)),
       ("host", "www.x.net", "add", D(1, 10)), ("page", "y.com/a/b", "add", D(1, 1)), ("page", "y.com/a/b", "remove", D(1, 1)),
       ("host", "z.com", "add", D(4, 1)), ("host", "z.com", "add", D(4, 1)), ("host", "z.com", "add", D(6, 1)),
       ("domain", "3.4", "add", D(1, 1)), ("domain", "10.0.3.5", "add", D(1, 1)), (None, "q.com", "add", D(1, 1)), ("host", None, "add", D(1, 1)), ("host", "q.com", "add", None), ("host", "q.com", "keep", D(1, 1))]

CAPTURES = [
    (1, "http://bad.org/x", D(1, 31), 0), (2, "http://A.Bad.ORG:80/x?y#z", D(2, 1), 1), (3, "https://u:p@bad.org./", D(2, 29), 1),
    (4, "http://bad.org", D(3, 1), 0), (5, "http://bad.org", D(12, 1), 1), (6, "http://notbad.org", D(2, 5), 0),
    (7, "http://www.x.net/", D(1, 10), 1), (8, "http://x.net/", D(1, 11), 0), (9, "http://sub.www.x.net/", D(1, 11), 0),
    (10, "http://y.com/a/b/?q", D(2, 2), 0), (11, "http://z.com", D(5, 1), 1), (12, "http://z.com", D(7, 1), 1),
    (13, None, D(2, 2), 0), (14, "", D(2, 2), 0), (15, "no url", D(2, 2), 0), (16, "http://bad.org", None, 0),
    (None, "http://bad.org", D(2, 2), 1), (17, "http://q.com", D(2, 2), 0), (2, "http://A.Bad.ORG:80/x?y#z", D(2, 1), 1),
    (18, "http://bad.org/" + "a/" * 50_000, D(2, 2), 1),
    (19, "http://10.0.3.4/a", D(2, 2), 0), (20, "http://10.0.3.5:80/", D(2, 2), 1), (21, " \t http://z.com/b \n", D(5, 1), 1)]


def captures(spark, rows):
    return spark.createDataFrame([(a, b, c, "x", 1) for a, b, c, _ in rows], "page_id long, url string, fetched date, entry string, value int")


def log(spark, rows):
    return spark.createDataFrame(rows, "kind string, value string, action string, day date")


def test_entries_active_at_fetch_time(spark):
    got = U.judge(captures(spark, CAPTURES), log(spark, LOG)).collect()
    key = lambda r: (str(r[0]), str(r[1]), str(r[2]))
    assert sorted([(*r[:3], r["n_active"], r["blocked"]) for r in got], key=key) == sorted(
        [(a, b, c, n, n > 0) for a, b, c, n in CAPTURES], key=key)
    assert {r["entry"] for r in got if r["page_id"] == 2} == {"domain:bad.org"}


def test_empty_tables(spark):
    assert U.judge(captures(spark, []), log(spark, LOG)).collect() == []
    assert U.judge(captures(spark, CAPTURES), log(spark, [])).where("blocked").count() == 0


def test_intervals_close_at_the_next_change(spark):
    got = sorted(tuple(r) for r in U.intervals(log(spark, LOG)).where("value = 'bad.org'").collect())
    assert [(a, b) for _, _, a, b in got] == [(D(2, 1), D(3, 1)), (D(5, 1), None)]


def test_hot_hosts_pages_and_repeated_rows_are_salted(spark, monkeypatch):
    rows = ([(i, f"http://h{i % 50}.bad.org/p{i}", D(2, 2), 1) for i in range(600)] + [(7, "http://bad.org/x", D(2, 2), 1)] * 500
            + [(i, "http://www.x.net/", D(2, 2), 1) for i in range(400)] + [(i, f"http://n{i}.com/", D(2, 2), 0) for i in range(300)])
    want = sorted((a, b, c, n) for a, b, c, n in rows)
    for parts in (U.PARTS, 4, 1):
        monkeypatch.setattr(U, "PARTS", parts)
        got = U.judge(captures(spark, rows).repartition(5), log(spark, LOG))
        assert sorted(tuple(r)[:4] for r in got.collect()) == want


def test_the_as_of_join_sees_a_key_once_a_day(spark):
    places = U._places(captures(spark, [(i, "http://a.bad.org/x?" + str(i), D(2, 2), 1) for i in range(90)]))
    assert [tuple(r) for r in places.collect()] == [("a.bad.org/x", D(2, 2), 90)]


def test_the_list_of_the_query_holds_two_label_domains(spark):
    pages = spark.createDataFrame([(i, f"https://www.example.com/{i}") for i in range(20)], "page_id long, url string")
    listed = {(r["kind"], r["value"]) for r in U.derived_log(pages).collect()}
    assert ("domain", "example.com") in listed and ("domain", "com") not in listed
    got = U.judge(U.fetch_days(pages.withColumn("page_id", pages.page_id + 170)), U.derived_log(pages)).collect()
    assert all(r["blocked"] for r in got if r["page_id"] >= 170)
