"""DuckDB SQL equivalent of every catalog query (the correctness oracle).

In the plainest form: membership is a join on ``contains`` (a theta join, fine at
test scale), profiles are ``GROUP BY`` over the joined rows.  Arithmetic is that of the
registered queries, so that results compare bit by bit: sums of integer hundredths,
one division; ordered folds for sums of derived doubles.  The default mode (plain
``avg`` and ``sum``) has its own checks, with a tolerance, in ``tests/test_default_mode.py``.  Views ``events`` etc. are registered by the caller.
"""

from __future__ import annotations

# Fact table with internal column names (FIXTURES.md §2, DuckDB form).
_F = """f AS (
  SELECT concat((['acm','bet','cor','dyn','ech'])[user_id % 5 + 1], '-',
                substr('abcd', CAST((user_id // 5) % 4 + 1 AS INTEGER), 1),
                lpad(CAST(user_id AS VARCHAR), 3, '0'))                       AS server_name,
         date_trunc('hour', ts)                                                AS hr_time,
         CASE event_id % 3 WHEN 0 THEN '_Total' WHEN 1 THEN '0' ELSE '1' END   AS processor,
         CASE event_id % 3 WHEN 0 THEN '_total' WHEN 1 THEN 'c:' ELSE 'd:' END AS disk_name,
         value                                                                 AS cpu_pct,
         CAST(json_extract_string(props, '$.k') AS DOUBLE)                     AS mem_pct,
         value                                                                 AS disk_writes_avg,
         value + CAST(json_extract_string(props, '$.k') AS DOUBLE)             AS disk_writes_max,
         CAST(json_extract_string(props, '$.k') AS DOUBLE)                     AS disk_reads_avg,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) + event_id % 10     AS disk_reads_max
  FROM events)"""

# Membership by `contains`, level by level (client -> host -> disk).
_MEMBERS = """
names AS (SELECT DISTINCT server_name FROM f WHERE server_name IS NOT NULL),
ck AS (SELECT DISTINCT substr(server_name, 1, 3) AS client FROM names),
cm AS (SELECT n.server_name, ck.client FROM names n JOIN ck ON contains(n.server_name, ck.client)),
hk AS (SELECT DISTINCT client, substr(server_name, 5, 1) AS host FROM cm),
hm AS (SELECT cm.server_name, cm.client, hk.host FROM cm
       JOIN hk ON cm.client = hk.client AND contains(cm.server_name, hk.host)),
pairs AS (SELECT DISTINCT server_name, disk_name FROM f
          WHERE server_name IS NOT NULL AND disk_name IS NOT NULL),
hp AS (SELECT p.server_name, p.disk_name, hm.client, hm.host FROM pairs p JOIN hm USING (server_name)),
dk AS (SELECT DISTINCT client, host, substr(disk_name, 1, 1) AS disk FROM hp),
dm AS (SELECT hp.server_name, hp.disk_name, hp.client, hp.host, dk.disk FROM hp
       JOIN dk ON hp.client = dk.client AND hp.host = dk.host AND contains(hp.disk_name, dk.disk)),
cp AS (SELECT DISTINCT p.server_name, p.disk_name, cm.client FROM pairs p JOIN cm USING (server_name)),
cdk AS (SELECT DISTINCT client, substr(disk_name, 1, 1) AS disk FROM cp),
dnames AS (SELECT DISTINCT disk_name FROM f WHERE disk_name IS NOT NULL),
fdm AS (SELECT d.disk_name, cdk.client, cdk.disk FROM dnames d JOIN cdk ON contains(d.disk_name, cdk.disk))"""

_PRELUDE = "WITH " + _F + "," + _MEMBERS + ",\n"


def _q(ctes: str, select: str) -> str:
    """Full statement: fixture + membership CTEs, extra CTEs, final SELECT."""
    return _PRELUDE + (ctes + ",\n" if ctes else "") + "_last AS (" + select + ")\nSELECT * FROM _last"


def _mean(col: str) -> str:
    return (f"CAST(sum(CAST(round({col} * 100) AS BIGINT)) AS DOUBLE) / CAST(100 AS DOUBLE)"
            f" / CAST(NULLIF(count({col}), 0) AS DOUBLE)")


def _sum(col: str) -> str:
    return f"CAST(sum(CAST(round({col} * 100) AS BIGINT)) AS DOUBLE) / CAST(100 AS DOUBLE)"


def _ordered_sum(list_expr: str) -> str:
    lst = f"list_sort(list_filter({list_expr}, lambda v: v IS NOT NULL))"
    return f"CASE WHEN len({lst}) = 0 THEN NULL ELSE list_reduce({lst}, lambda a, b: a + b) END"


def _pct_label(share: str) -> str:
    t = f"CAST(floor({share} * 1000.0 + 0.5) AS BIGINT)"
    return (f"concat(CASE WHEN {t} < 0 THEN '-' ELSE '' END, CAST(abs({t}) // 10 AS VARCHAR), '.',"
            f" CAST(abs({t}) % 10 AS VARCHAR), '%')")


_PARTS = {
    "hourly": "CAST(hour(f.hr_time) AS INTEGER)",
    "weekly": "CAST(dayofweek(f.hr_time) + 1 AS INTEGER)",
    "monthly": "CAST(dayofmonth(f.hr_time) AS INTEGER)",
}
_DAY = "(['Sun','Mon','Tue','Wed','Thu','Fri','Sat'])[x]"


def _profile_select(metric: str, section: str) -> str:
    x = _PARTS[section]
    day = f", {_DAY} AS day_name" if section == "weekly" else ""
    inner = (f"SELECT hm.client, hm.host, {x} AS x, {_mean('f.' + metric)} AS y "
             f"FROM f JOIN hm USING (server_name) WHERE f.hr_time IS NOT NULL "
             f"GROUP BY hm.client, hm.host, {x}")
    return f"SELECT client, host, x{day}, y FROM ({inner}) p"


def _disk_profile_select(avg: str, mx: str) -> str:
    return (f"SELECT dm.client, dm.host, dm.disk, {_PARTS['hourly']} AS x, "
            f"{_mean('f.' + avg)} AS y, {_mean('f.' + mx)} AS y2 "
            f"FROM f JOIN dm USING (server_name, disk_name) WHERE f.hr_time IS NOT NULL "
            f"GROUP BY dm.client, dm.host, dm.disk, {_PARTS['hourly']}")


def _host_size(metric: str, agg: str) -> str:
    size = _sum("f." + metric) if agg == "sum" else _mean("f." + metric)
    return (f"SELECT hm.client, hm.host, {size} AS size FROM f JOIN hm USING (server_name) "
            f"GROUP BY hm.client, hm.host")


_CLIENT_SIZE = (f"SELECT cm.client, {_sum('f.cpu_pct')} AS size FROM cm "
                f"LEFT JOIN (SELECT * FROM f WHERE contains(processor, '_Total')) f "
                f"USING (server_name) GROUP BY cm.client")


def _share(sizes_cte: str, keys: str, within: str, agg: str) -> str:
    over = f"OVER (PARTITION BY {within})" if within else "OVER ()"
    if agg == "sum":  # sizes of two decimals: their total in hundredths
        tot = f"(CAST(sum(CAST(round(size * 100) AS BIGINT)) {over} AS DOUBLE) / CAST(100 AS DOUBLE))"
    else:
        tot = _ordered_sum(f"list(size) {over}")
    return (f"SELECT {keys}, size, share, {_pct_label('share')} AS pct_label FROM ("
            f"SELECT {keys}, size, size / NULLIF({tot}, 0) AS share FROM {sizes_cte}) s")


_CPU_COLS = "server_name, hr_time, processor, cpu_pct"
_DISK_COLS = "server_name, hr_time, disk_name, disk_writes_avg"
_WIDE = ("server_name, hr_time, processor, disk_name, cpu_pct, mem_pct, disk_writes_avg, "
         "disk_writes_max, disk_reads_avg, disk_reads_max")


def _titles() -> str:
    t = []
    null = "CAST(NULL AS VARCHAR)"
    for fam, word, pie in (("cpu", "CPU", "'Total Percentage Usage per Host in 1 month'"),
                           ("mem", "Memory", "'Percentage Memory Usage for ' || client || ' in 1 month'"),
                           ("disk", None, "'Percentage Disk Usage for ' || client || ' in 1 month'")):
        t.append(f"SELECT '{fam}' AS family, client, host, {null} AS disk, 'heading' AS chart, "
                 f"'Charts for ' || client || ' with host ' || host AS title FROM hk")
        t.append(f"SELECT DISTINCT '{fam}' AS family, client, {null} AS host, {null} AS disk, "
                 f"'share' AS chart, {pie} AS title FROM hk")
        if word is None:
            continue
        for chart, cap in (("hourly", "Hourly"), ("weekly", "Weekly"), ("monthly", "Monthly")):
            t.append(f"SELECT '{fam}' AS family, client, host, {null} AS disk, '{chart}' AS chart, "
                     f"'{cap} {word} Usage for ' || client || ' with host ' || host AS title FROM hk")
    for chart, text in (("writes", "Hourly Average Disk Write/Sec for "),
                        ("reads", "Hourly Average Disk Reads/Sec for ")):
        t.append(f"SELECT 'disk' AS family, client, host, disk, '{chart}' AS chart, "
                 f"'{text}' || client || ' with host ' || host || ' Disk: ' || upper(disk) || ':' "
                 f"AS title FROM dk")
    return " UNION ALL ".join(t)


def _report_rows(section, x, y, y2, title, disk="CAST(NULL AS VARCHAR)"):
    label = f"CAST({_DAY} AS VARCHAR)" if section == "weekly" else "CAST(NULL AS VARCHAR)"
    return (f"client, host, {disk} AS disk, '{section}' AS section, CAST({x} AS INTEGER) AS x, "
            f"{label} AS x_label, CAST({y} AS DOUBLE) AS y, CAST({y2} AS DOUBLE) AS y2, {title} AS title")


def _series_title(section: str, what: str) -> str:
    return f"'{section.capitalize()} {what} Usage for ' || client || ' with host ' || host"


def _cpu_report() -> str:
    ctes = (f"ph AS ({_profile_select('cpu_pct', 'hourly')}),\n"
            f"pw AS ({_profile_select('cpu_pct', 'weekly')}),\n"
            f"pm AS ({_profile_select('cpu_pct', 'monthly')}),\n"
            f"tot AS (SELECT client, host, {_ordered_sum('list(y)')} AS total_usage FROM pm "
            f"GROUP BY client, host)")
    sel = " UNION ALL ".join(
        [f"SELECT {_report_rows(s, 'x', 'y', 'NULL', _series_title(s, 'CPU'))} FROM {t}"
         for s, t in (("hourly", "ph"), ("weekly", "pw"), ("monthly", "pm"))]
        + [f"SELECT {_report_rows('total', 'NULL', 'total_usage', 'NULL', repr('Total Processor Time'))} FROM tot"])
    return _q(ctes, sel)


def _mem_report() -> str:
    ctes = (f"ph AS ({_profile_select('mem_pct', 'hourly')}),\n"
            f"pw AS ({_profile_select('mem_pct', 'weekly')}),\n"
            f"pm AS ({_profile_select('mem_pct', 'monthly')}),\n"
            f"hs AS ({_host_size('mem_pct', 'avg')}),\n"
            f"sh AS ({_share('hs', 'client, host', 'client', 'avg')})")
    pie = "'Percentage Memory Usage for ' || client || ' in 1 month'"
    sel = " UNION ALL ".join(
        [f"SELECT {_report_rows(s, 'x', 'y', 'NULL', _series_title(s, 'Memory'))} FROM {t}"
         for s, t in (("hourly", "ph"), ("weekly", "pw"), ("monthly", "pm"))]
        + [f"SELECT {_report_rows('share', 'NULL', 'size', 'share', pie)} FROM sh"])
    return _q(ctes, sel)


def _disk_report() -> str:
    ctes = (f"pw AS ({_disk_profile_select('disk_writes_avg', 'disk_writes_max')}),\n"
            f"pr AS ({_disk_profile_select('disk_reads_avg', 'disk_reads_max')}),\n"
            f"hs AS ({_host_size('disk_writes_avg', 'avg')}),\n"
            f"sh AS ({_share('hs', 'client, host', 'client', 'avg')})")
    pie = "'Percentage Disk Usage for ' || client || ' in 1 month'"
    rest = "client || ' with host ' || host || ' Disk: ' || upper(disk) || ':'"
    writes, reads = f"'Hourly Average Disk Write/Sec for ' || {rest}", f"'Hourly Average Disk Reads/Sec for ' || {rest}"
    sel = " UNION ALL ".join([
        f"SELECT {_report_rows('share', 'NULL', 'size', 'share', pie)} FROM sh",
        f"SELECT {_report_rows('writes', 'x', 'y', 'y2', writes, 'disk')} FROM pw",
        f"SELECT {_report_rows('reads', 'x', 'y', 'y2', reads, 'disk')} FROM pr",
    ])
    return _q(ctes, sel)


def _overall_report() -> str:
    ctes = (f"s1 AS ({_host_size('cpu_pct', 'sum')}),\n"
            f"s2 AS ({_CLIENT_SIZE}),\n"
            f"s3 AS ({_host_size('mem_pct', 'avg')}),\n"
            f"s4 AS ({_host_size('disk_writes_avg', 'avg')}),\n"
            f"w1 AS ({_share('s1', 'client, host', 'client', 'sum')}),\n"
            f"w2 AS ({_share('s2', 'client', '', 'sum')}),\n"
            f"w3 AS ({_share('s3', 'client, host', 'client', 'avg')}),\n"
            f"w4 AS ({_share('s4', 'client, host', 'client', 'avg')})")
    cpu, mem, disk = (f"'Percentage {w} usage of every client''s hosts'" for w in ("CPU", "Memory", "Disk"))
    sel = " UNION ALL ".join([
        f"SELECT 1 AS section_no, 'cpu_host_share' AS section, client, host, size, share, {cpu} AS title FROM w1",
        "SELECT 2, 'cpu_client_share', client, CAST(NULL AS VARCHAR), size, share, "
        "'Total Percentage Usage per Host in 1 month' FROM w2",
        f"SELECT 3, 'mem_host_share', client, host, size, share, {mem} FROM w3",
        f"SELECT 4, 'disk_host_share', client, host, size, share, {disk} FROM w4",
    ])
    return _q(ctes, f"SELECT CAST(section_no AS INTEGER) AS section_no, section, client, host, "
                    f"size, share, title FROM ({sel}) u")


def _distinct_parts(section: str) -> str:
    x = _PARTS[section]
    return _q("", f"SELECT DISTINCT hm.client, hm.host, {x} AS x FROM f JOIN hm USING (server_name) "
                  f"WHERE f.hr_time IS NOT NULL")


def oracle_sql() -> dict[str, str]:
    cpu_hourly = _q("", _profile_select("cpu_pct", "hourly"))
    return {
        "scan_metrics": _q("", f"SELECT {_WIDE} FROM f"),
        "ingest_append": _q("", f"SELECT {_CPU_COLS} FROM f"),
        "ingest_stream": _q("", f"SELECT {_CPU_COLS} FROM f"),
        "sql_view_scan": _q("", f"SELECT {_WIDE} FROM f"),
        "cached_scan": _q("", f"SELECT {_WIDE} FROM f"),
        "sink_skip_existing": cpu_hourly,
        "sink_overwrite": cpu_hourly,
        "client_key": _q("", "SELECT server_name, substr(server_name, 1, 3) AS client FROM f"),
        "host_key": _q("", "SELECT server_name, substr(server_name, 5, 1) AS host FROM f"),
        "disk_key": _q("", "SELECT disk_name, substr(disk_name, 1, 1) AS disk FROM f"),
        "project_metric": _q("", "SELECT server_name, cpu_pct, CAST(hour(hr_time) AS INTEGER) AS hour FROM f"),
        "scalar_date_parts": _q("", "SELECT hr_time, CAST(hour(hr_time) AS INTEGER) AS hour, "
                                    "CAST(dayofweek(hr_time) + 1 AS INTEGER) AS day_of_week, "
                                    "(['Sun','Mon','Tue','Wed','Thu','Fri','Sat'])[dayofweek(hr_time) + 1] AS day_name, "
                                    "CAST(dayofmonth(hr_time) AS INTEGER) AS day_of_month FROM f"),
        "report_titles": _q("", _titles()),
        "filter_client": _q("", f"SELECT {_CPU_COLS} FROM f WHERE contains(server_name, 'acm')"),
        "filter_host": _q("", f"SELECT {_CPU_COLS} FROM f WHERE contains(server_name, 'acm') "
                              f"AND contains(server_name, 'a')"),
        "filter_disk": _q("", f"SELECT {_DISK_COLS} FROM f WHERE contains(server_name, 'acm') "
                              f"AND contains(server_name, 'a') AND contains(disk_name, 'c')"),
        "filter_total": _q("", f"SELECT {_CPU_COLS} FROM f WHERE contains(server_name, 'acm') "
                               f"AND contains(processor, '_Total')"),
        "filter_hour": _q("", f"SELECT {_CPU_COLS} FROM f WHERE hour(hr_time) = 13"),
        "split_client": _q("", "SELECT cm.client, f.server_name, f.hr_time, f.processor, f.cpu_pct "
                               "FROM f JOIN cm USING (server_name)"),
        "split_host": _q("", "SELECT hm.client, hm.host, f.server_name, f.hr_time, f.processor, "
                             "f.cpu_pct FROM f JOIN hm USING (server_name)"),
        "split_disk": _q("", "SELECT dm.client, dm.host, dm.disk, f.server_name, f.hr_time, "
                             "f.disk_name, f.disk_writes_avg FROM f JOIN dm USING (server_name, disk_name)"),
        "split_disk_fleet": _q("", "SELECT fdm.client, fdm.disk, f.server_name, f.hr_time, "
                                   "f.disk_name, f.disk_writes_avg FROM f JOIN fdm USING (disk_name)"),
        "split_disk_factored": _q(
            "dcl AS (SELECT disk_name, string_agg(DISTINCT disk, ',' ORDER BY disk) AS disks FROM fdm GROUP BY disk_name)",
            "SELECT dcl.disks, f.server_name, f.hr_time, f.disk_name, f.disk_writes_avg FROM f JOIN dcl USING (disk_name)"),
        "distinct_clients": _q("", "SELECT client FROM ck"),
        "distinct_hosts": _q("", "SELECT client, host FROM hk"),
        "distinct_disks": _q("", "SELECT client, host, disk FROM dk"),
        "distinct_disks_client": _q("", "SELECT client, disk FROM cdk"),
        "distinct_hours": _distinct_parts("hourly"),
        "distinct_weekdays": _distinct_parts("weekly"),
        "distinct_monthdays": _distinct_parts("monthly"),
        "cpu_hourly": cpu_hourly,
        "cpu_weekly": _q("", _profile_select("cpu_pct", "weekly")),
        "cpu_monthly": _q("", _profile_select("cpu_pct", "monthly")),
        "mem_hourly": _q("", _profile_select("mem_pct", "hourly")),
        "mem_weekly": _q("", _profile_select("mem_pct", "weekly")),
        "mem_monthly": _q("", _profile_select("mem_pct", "monthly")),
        "disk_writes_hourly": _q("", _disk_profile_select("disk_writes_avg", "disk_writes_max")),
        "disk_reads_hourly": _q("", _disk_profile_select("disk_reads_avg", "disk_reads_max")),
        "cpu_total_usage": _q(f"pm AS ({_profile_select('cpu_pct', 'monthly')})",
                              f"SELECT client, host, {_ordered_sum('list(y)')} AS total_usage "
                              f"FROM pm GROUP BY client, host"),
        "cpu_host_sum": _q("", _host_size("cpu_pct", "sum")),
        "mem_host_avg": _q("", _host_size("mem_pct", "avg")),
        "disk_host_avg": _q("", _host_size("disk_writes_avg", "avg")),
        "cpu_client_sum": _q("", _CLIENT_SIZE),
        "cpu_host_share": _q(f"s AS ({_host_size('cpu_pct', 'sum')})",
                             _share("s", "client, host", "client", "sum")),
        "mem_host_share": _q(f"s AS ({_host_size('mem_pct', 'avg')})",
                             _share("s", "client, host", "client", "avg")),
        "disk_host_share": _q(f"s AS ({_host_size('disk_writes_avg', 'avg')})",
                              _share("s", "client, host", "client", "avg")),
        "cpu_client_share": _q(f"s AS ({_CLIENT_SIZE})", _share("s", "client", "", "sum")),
        "client_report_cpu": _cpu_report(),
        "client_report_mem": _mem_report(),
        "client_report_disk": _disk_report(),
        "client_report_incremental": _cpu_report(),
        "overall_report": _overall_report(),
        "chart_points": f"SELECT x, x_label, y, y2 FROM ({_cpu_report()}) "
                        "WHERE client = 'acm' AND host = 'a' AND section = 'weekly'",
    }
