"""The same results in plain SQL, written independently of the operators."""

from __future__ import annotations

from lapsewise.workload.domain import AS_OF, THRESHOLD_DAYS, with_views

_TS = "'%Y-%m-%d %H:%M:%S.%f'"


def _mean_median(column: str, name: str) -> str:
    return (
        f"round(avg({column}) + 1e-9, 6) AS Average{name}, "
        f"round(median({column}), 6) AS Median{name}"
    )


_PACKAGE_COLUMNS = ",\n".join(
    [
        _mean_median("offer_amount", "PackageAmount"),
        _mean_median("date_diff('day', activation_date, deactivation_date)", "PackageDuration"),
        "count(*) AS CountPackage",
    ]
)
_RECHARGE_COLUMNS = (
    _mean_median("recharge_value_amt", "RechargeAmount") + ", count(*) AS CountRecharge"
)
_USER_COLUMNS = f"""
    bib_id,
    round(date_diff('day', strptime(date_of_birth_d, '%Y%m%d')::DATE, DATE '{AS_OF}') / 365.25, 6)
        AS age,
    year(strptime(registration_date_d, '%Y%m%d')) AS registration_year,
    contract_type_v, gender_v, ability_status, round(account_balance, 6) AS account_balance"""


def _activity(pick: str) -> str:
    across = "greatest" if pick == "max" else "least"
    return with_views(
        "activity",
        f""",
        p AS (SELECT bib_id, {pick}(ts) AS t FROM activity WHERE event_type = 'signup' GROUP BY 1),
        r AS (SELECT bib_id, {pick}(ts) AS t FROM activity WHERE event_type <> 'signup'
              GROUP BY 1)
        SELECT bib_id, strftime({across}(p.t, r.t), {_TS}) AS {pick}_date
        FROM p FULL JOIN r USING (bib_id)""",
    )


_LABEL = f"""CASE WHEN (next_seen IS NULL AND last_seen IS NOT NULL)
              OR date_diff('day', last_seen, next_seen) > {THRESHOLD_DAYS}
         THEN 1 ELSE 0 END"""

_FIRST_LABEL = f"""
    cur AS (SELECT bib_id, max(ts) AS last_seen FROM activity WHERE period = 0 GROUP BY 1),
    nxt AS (SELECT bib_id, min(ts) AS next_seen FROM activity WHERE period = 1 GROUP BY 1),
    label AS (SELECT bib_id, CAST({_LABEL} AS BIGINT) AS label
              FROM cur LEFT JOIN nxt USING (bib_id))"""

_ALL_LABELS = with_views(
    "activity",
    f""",
    span AS (SELECT bib_id, period, max(ts) AS last_seen, min(ts) AS first_seen
             FROM activity GROUP BY 1, 2)
    SELECT a.bib_id, CAST(a.period AS BIGINT) AS period, CAST({_LABEL} AS BIGINT) AS label
    FROM span a LEFT JOIN (SELECT bib_id, period, first_seen AS next_seen FROM span) b
         ON a.bib_id = b.bib_id AND b.period = a.period + 1
    WHERE a.period < (SELECT max(period) FROM activity)""",
)


def _training(include_loans: bool) -> str:
    loan_parts = f""",
    la AS (SELECT bib_id, {_mean_median("loan_amount", "AssignLoanAmount")}
           FROM loan_assign GROUP BY 1),
    lr AS (SELECT bib_id, {_mean_median("loan_amount", "RecoveryLoanAmount")}
           FROM loan_recovery GROUP BY 1)"""
    loan_joins = "LEFT JOIN la USING (bib_id) LEFT JOIN lr USING (bib_id)"
    return with_views(
        "loan_assign loan_recovery package recharge subscriber activity",
        f""",{_FIRST_LABEL},
    pk AS (SELECT bib_id, {_PACKAGE_COLUMNS} FROM package GROUP BY 1),
    rc AS (SELECT bib_id, {_RECHARGE_COLUMNS} FROM recharge GROUP BY 1),
    us AS (SELECT {_USER_COLUMNS} FROM subscriber)
    {loan_parts if include_loans else ""}
    SELECT * FROM label {loan_joins if include_loans else ""}
        LEFT JOIN pk USING (bib_id) LEFT JOIN rc USING (bib_id) LEFT JOIN us USING (bib_id)""",
    )


def _case(value: str, edges: list, labels: list[str]) -> str:
    branches = "".join(
        f" WHEN {value} > {low} AND {value} <= {high} THEN '{label}'"
        for low, high, label in zip(edges, edges[1:], labels)
    )
    return f"CASE{branches} ELSE CAST({value} AS VARCHAR) END"


# Edges and labels of the three presets.
_LOW, _HIGH = "'-infinity'::DOUBLE", "'infinity'::DOUBLE"
_LOAN_CASE = _case(
    "loan_amount",
    [_LOW, 5000, 10000, 20000, 50000, 100000, _HIGH],
    ["VeryLow", "5T-10T", "10T-20T", "20T-50T", "50T-100T", "Extreme"],
)
_RECHARGE_CASE = _case(
    "(recharge_value_amt * 1000)",
    [_LOW, 10000, 20000, 50000, 100000, 200000, 500000, _HIGH],
    ["1T", "2T", "5T", "10T", "20T", "50T", "More"],
)
_DAYS = "date_diff('day', activation_date, deactivation_date)"
_DURATION_CASE = _case(
    _DAYS,
    [_LOW, 0, 1, 7, 15, 30, 60, 120, 180, 365, _HIGH],
    [
        "Same Day",
        "Daily",
        "Weekly",
        "Half-Monthly",
        "Monthly",
        "2 Months",
        "4 Months",
        "6 Months",
        "1 Year",
        "More than 1 Year",
    ],
)


def _time_profile(view: str, ts: str, amount: str, digits: int) -> str:
    parts = {
        "hour": f"hour({ts})",
        "day_of_week": f"dayofweek({ts}) + 1",
        "day_of_month": f"day({ts})",
    }
    selects = [
        f"SELECT '{name}' AS part, CAST({part} AS BIGINT) AS value, "
        f"round(sum({amount}), {digits}) AS sum_{amount} FROM {view} GROUP BY 2"
        for name, part in parts.items()
    ]
    return with_views(view, "\nUNION ALL ".join(selects))


def _recovery_ratio(assigned: str) -> str:
    return with_views(
        "loan_assign loan_recovery",
        f""",
        matched AS (SELECT * FROM loan_recovery WHERE loan_id IN (SELECT loan_id FROM loan_assign)),
        sums AS (SELECT (SELECT sum(hsdp_recovery) FROM matched) AS recovered_sum,
                        ({assigned}) AS assigned_sum)
        SELECT round(recovered_sum, 2) AS recovered_sum, round(assigned_sum, 2) AS assigned_sum,
               round(recovered_sum / assigned_sum * 100, 2) AS percentage_of_recovered
        FROM sums""",
    )


def _histogram(source: str, bins: str, hue: str | None = None) -> str:
    """``source`` gives v (and hue); ``bins`` computes k from n, lo, hi, q1, q3."""
    group, same = (f"{hue}, ", f" AND s.{hue} = grid.{hue}") if hue else ("", "")
    hues = f"(SELECT DISTINCT {hue} FROM s), " if hue else ""
    return f"""
    s AS ({source}),
    f AS (SELECT count(*)::DOUBLE AS n, min(v) AS lo, max(v) AS hi,
                 quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM s),
    e AS (SELECT lo, hi, CAST({bins} AS BIGINT) AS k FROM f),
    edges AS (SELECT i AS bin, lo + i * ((hi - lo) / k) AS bin_start,
                     CASE WHEN i = k - 1 THEN hi ELSE lo + (i + 1) * ((hi - lo) / k) END AS bin_end,
                     i = k - 1 AS last
              FROM e, LATERAL (SELECT unnest(range(k)) AS i)),
    grid AS (SELECT * FROM {hues}edges)
    SELECT {f"grid.{hue}, " if hue else ""}bin, round(bin_start, 4) AS bin_start, round(bin_end, 4) AS bin_end,
           count(v) AS count
    FROM grid LEFT JOIN s ON v >= bin_start AND (v < bin_end OR (last AND v = bin_end)){same}
    GROUP BY {f"grid.{hue}, " if hue else ""}bin, bin_start, bin_end"""


_AUTO = """ceil((hi - lo) / CASE WHEN q3 > q1
        THEN least(2 * (q3 - q1) / pow(n, 1 / 3.0::DOUBLE), (hi - lo) / (log2(n) + 1))
        ELSE (hi - lo) / (log2(n) + 1) END)"""


def _box(source: str, group: str | None) -> str:
    by, lead = (f"GROUP BY {group}", f"{group}, ") if group else ("", "")
    join = f"JOIN q USING ({group})" if group else "CROSS JOIN q"
    return f"""
    s AS ({source}),
    q AS (SELECT {lead}count(*) AS n, quantile_cont(v, 0.25) AS q1, median(v) AS median,
                 quantile_cont(v, 0.75) AS q3 FROM s {by}),
    w AS (SELECT s.*, n, q1, median, q3,
                 v BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5 AS inside
          FROM s {join})
    SELECT {lead}max(n) AS n, round(max(q1), 4) AS q1, round(max(median), 4) AS median,
           round(max(q3), 4) AS q3, round(min(v) FILTER (inside), 4) AS whisker_low,
           round(max(v) FILTER (inside), 4) AS whisker_high,
           count(*) FILTER (NOT inside) AS n_outliers
    FROM w {by}"""


def _density(group: str | None, points: int, cut: int, total: str, quartiles: bool) -> str:
    by, lead = (f"GROUP BY {group}", f"{group}, ") if group else ("", "")
    quartile_columns = ", ".join(f"round(max({q}), 8) AS {q}" for q in ("q1", "median", "q3"))
    also = f", max(n) AS n, {quartile_columns}" if quartiles else ""
    return f"""
    WITH s AS (SELECT {lead}value AS v FROM events),
    b AS (SELECT {lead}count(*) AS n, min(v) AS lo, max(v) AS hi,
                 quantile_cont(v, 0.25) AS q1, median(v) AS median, quantile_cont(v, 0.75) AS q3,
                 pow(count(*), -0.2::DOUBLE) * stddev_samp(v) AS bw FROM s {by}),
    g AS (SELECT b.*, i AS grid,
                 (lo - {cut} * bw) + i * ((hi - lo + {2 * cut} * bw) / {points - 1}) AS x
          FROM b, LATERAL (SELECT unnest(range({points})) AS i)),
    w AS (SELECT {lead}v, count(*) AS c FROM s GROUP BY ALL)
    SELECT {lead}grid, round(max(x), 8) AS x,
           round(sum(c * exp(-0.5::DOUBLE * pow((x - v) / bw, 2)))
                 / (max({total}) * max(bw) * sqrt(2 * pi())), 8) AS density
           {also}
    FROM g {f"JOIN w USING ({group})" if group else "CROSS JOIN w"}
    GROUP BY {lead}grid"""


_STORED_PARTS = f""",
    ev AS (SELECT user_id AS bib_id, event_type, value, ts,
                  date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 10 AS period
           FROM events),
    pk AS (SELECT bib_id, period, {_mean_median("value", "PackageAmount")},
                  {_mean_median("CAST(floor(value) AS BIGINT)", "PackageDuration")},
                  count(*) AS CountPackage
           FROM ev WHERE event_type = 'signup' GROUP BY ALL),
    rc AS (SELECT bib_id, period, {_mean_median("value", "RechargeAmount")}, count(*) AS CountRecharge
           FROM ev WHERE event_type <> 'signup' GROUP BY ALL),
    us AS (SELECT {_USER_COLUMNS} FROM subscriber)"""


def _stored_training(include_loans: bool) -> str:
    loans = f""",
    la AS (SELECT bib_id, {_mean_median("loan_amount", "AssignLoanAmount")}
           FROM loan_assign WHERE year(date_timestamp) % 3 = 0 GROUP BY 1),
    lr AS (SELECT bib_id, {_mean_median("loan_amount", "RecoveryLoanAmount")}
           FROM loan_recovery WHERE loan_id IN (SELECT o_orderkey FROM orders WHERE year(o_orderdate) % 3 = 0)
           GROUP BY 1)"""
    joins = "LEFT JOIN la USING (bib_id) LEFT JOIN lr USING (bib_id)"
    return with_views(
        "activity subscriber loan_assign loan_recovery",
        f""",{_FIRST_LABEL}{_STORED_PARTS}{loans if include_loans else ""}
    SELECT * REPLACE (CAST(bib_id AS VARCHAR) AS bib_id)
    FROM label {joins if include_loans else ""}
               LEFT JOIN (SELECT * EXCLUDE period FROM pk WHERE period = 0) USING (bib_id)
               LEFT JOIN (SELECT * EXCLUDE period FROM rc WHERE period = 0) USING (bib_id)
               LEFT JOIN us USING (bib_id)""",
    )


_STORED_ALL = with_views(
    "activity subscriber",
    f""", lab AS ({_ALL_LABELS}){_STORED_PARTS}
    SELECT * REPLACE (CAST(bib_id AS VARCHAR) AS bib_id)
    FROM lab LEFT JOIN pk USING (bib_id, period) LEFT JOIN rc USING (bib_id, period)
             LEFT JOIN us USING (bib_id)""",
)

_MONTH = "CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 10 AS VARCHAR)"
_INGESTED = f"""
    SELECT 'package' AS table_key, {_MONTH} AS month, count(*) AS rows, round(sum(value), 2) AS amount
    FROM events WHERE event_type = 'signup' GROUP BY 2
    UNION ALL
    SELECT 'recharge', {_MONTH}, count(*), round(sum(value), 2)
    FROM events WHERE event_type <> 'signup' GROUP BY 2
    UNION ALL
    SELECT 'user', CAST(m AS VARCHAR), count(*), round(sum(c_acctbal), 2)
    FROM customer, range(3) t(m) GROUP BY 2
    UNION ALL
    SELECT k, CAST(year(o_orderdate) % 3 AS VARCHAR), count(*), round(sum(o_totalprice), 2)
    FROM orders, (VALUES ('loan_assign'), ('loan_fee')) v(k) GROUP BY 1, 2
    UNION ALL
    SELECT 'loan_recovery', CAST(year(o_orderdate) % 3 AS VARCHAR), count(*), round(sum(l_extendedprice), 2)
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 2"""

ORACLE_SQL: dict[str, str] = {
    "loan_assign_features": with_views(
        "loan_assign",
        f"""SELECT bib_id, {_mean_median("loan_amount", "AssignLoanAmount")}
            FROM loan_assign GROUP BY bib_id""",
    ),
    "loan_recovery_features": with_views(
        "loan_recovery",
        f"""SELECT bib_id, {_mean_median("loan_amount", "RecoveryLoanAmount")}
            FROM loan_recovery GROUP BY bib_id""",
    ),
    "package_features": with_views(
        "package", f"SELECT bib_id, {_PACKAGE_COLUMNS} FROM package GROUP BY bib_id"
    ),
    "recharge_features": with_views(
        "recharge", f"SELECT bib_id, {_RECHARGE_COLUMNS} FROM recharge GROUP BY bib_id"
    ),
    "user_attributes": with_views("subscriber", f"SELECT {_USER_COLUMNS} FROM subscriber"),
    "last_activity": _activity("max"),
    "first_activity": _activity("min"),
    "churn_label": with_views("activity", f",{_FIRST_LABEL} SELECT * FROM label"),
    "churn_label_all_periods": _ALL_LABELS,
    "training_table": _training(include_loans=False),
    "training_table_with_loans": _training(include_loans=True),
    "bin_loan_amount": with_views(
        "loan_assign",
        f"""SELECT loan_id, round(loan_amount, 4) AS loan_amount, {_LOAN_CASE} AS loan_category
            FROM loan_assign""",
    ),
    "bin_recharge": with_views(
        "recharge",
        f"""SELECT bib_id, round(recharge_value_amt * 1000, 4) AS recharge_value_amt,
                   {_RECHARGE_CASE} AS recharge_category FROM recharge""",
    ),
    "bin_duration": with_views(
        "package",
        f"""SELECT bib_id, offering_name, {_DAYS} AS time_difference_days,
                   {_DURATION_CASE} AS duration_category FROM package""",
    ),
    "sum_by_person": with_views(
        "loan_assign",
        """SELECT nid_hash, round(sum(loan_amount), 4) AS SumAggregated_loan_amount_by_nid
           FROM loan_assign GROUP BY 1""",
    ),
    "time_profile": _time_profile("recharge", "recharge_dt", "recharge_value_amt", 4),
    "time_profile_loans": _time_profile("loan_assign", "date_timestamp", "loan_amount", 2),
    "count_by_offering": with_views(
        "package", "SELECT offering_code, count(*) AS count FROM package GROUP BY 1"
    ),
    "top_offerings": with_views(
        "package",
        """SELECT offering_name, count(*) AS count FROM package
           GROUP BY 1 ORDER BY count DESC, offering_name LIMIT 25""",
    ),
    "top_duration_categories": with_views(
        "package",
        f"""SELECT {_DURATION_CASE} AS duration_category, count(*) AS count FROM package
            GROUP BY 1 ORDER BY count DESC, duration_category LIMIT 10""",
    ),
    "value_counts": with_views(
        "subscriber",
        """SELECT gender_v, count(*) AS count FROM subscriber WHERE gender_v IS NOT NULL
           GROUP BY 1""",
    ),
    "common_loans": with_views(
        "loan_assign loan_recovery",
        "SELECT loan_id FROM loan_assign INTERSECT SELECT loan_id FROM loan_recovery",
    ),
    "loan_recovery_by_loan": with_views(
        "loan_assign loan_recovery",
        """SELECT loan_id, round(sum(loan_amount), 4) AS sum_of_loan_amount,
                  round(sum(hsdp_recovery), 4) AS sum_of_recovery
           FROM loan_recovery WHERE loan_id IN (SELECT loan_id FROM loan_assign) GROUP BY 1""",
    ),
    "loan_recovery_ratio": _recovery_ratio("SELECT sum(loan_amount) FROM matched"),
    "loan_recovery_ratio_of_assigned": _recovery_ratio(
        """SELECT sum(loan_amount) FROM loan_assign
           WHERE loan_id IN (SELECT loan_id FROM loan_recovery)"""
    ),
    "dist_count": with_views(
        "loan_assign",
        f"SELECT {_LOAN_CASE} AS loan_category, count(*) AS count FROM loan_assign GROUP BY 1",
    ),
    "dist_count_recharge": with_views(
        "recharge",
        f"SELECT {_RECHARGE_CASE} AS recharge_category, count(*) AS count FROM recharge GROUP BY 1",
    ),
    "dist_hist": "WITH " + _histogram("SELECT value AS v FROM events", _AUTO),
    "dist_hist_hue": "WITH "
    + _histogram("SELECT event_type, value AS v FROM events", "20", "event_type"),
    "dist_hist_time": "WITH " + _histogram("SELECT epoch(ts) AS v FROM events", "24"),
    "dist_hist_category": """
        SELECT event_type, props, count(e.event_id) AS count
        FROM (SELECT * FROM (SELECT DISTINCT event_type FROM events),
                            (SELECT DISTINCT props FROM events WHERE props IS NOT NULL)) g
             LEFT JOIN events e USING (event_type, props)
        GROUP BY 1, 2""",
    "dist_hist_person": with_views(
        "loan_assign",
        ","
        + _histogram("SELECT sum(loan_amount) AS v FROM loan_assign GROUP BY nid_hash", _AUTO),
    ),
    "dist_line": with_views(
        "package",
        """SELECT offering_name, CAST(day(activation_date) AS BIGINT) AS day,
                  round(avg(offer_amount) + 1e-9, 6) AS AverageOfferAmount
           FROM package GROUP BY 1, 2""",
    ),
    "dist_box": "WITH " + _box("SELECT event_type, value AS v FROM events", "event_type"),
    "dist_box_overall": with_views(
        "loan_assign", "," + _box("SELECT loan_amount AS v FROM loan_assign", None)
    ),
    "dist_kde": _density(None, 200, 3, "n", False),
    "dist_kde_hue": _density("event_type", 200, 3, "(SELECT count(*) FROM s)", False),
    "dist_violin": _density("event_type", 100, 2, "n", True),
    "ingest_roundtrip": """
        SELECT CAST(user_id AS VARCHAR) AS bib_id,
               CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 10 AS VARCHAR)
                   AS month,
               CAST(event_id AS VARCHAR) AS fake_id, round(value, 4) AS recharge_value_amt,
               strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.%f') AS recharge_dt
        FROM events""",
    "ingest_quarantine": """
        SELECT CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 10 AS VARCHAR)
                   AS month,
               count(*) FILTER (event_type <> 'error') AS good,
               count(*) FILTER (event_type = 'error') AS bad
        FROM events GROUP BY 1""",
    "stored_churn_label": with_views(
        "activity",
        f",{_FIRST_LABEL} SELECT CAST(bib_id AS VARCHAR) AS bib_id, label FROM label",
    ),
    "stored_churn_label_all_periods": "SELECT * REPLACE (CAST(bib_id AS VARCHAR) AS bib_id) "
    f"FROM ({_ALL_LABELS})",
    "stored_training_table": _stored_training(include_loans=False),
    "stored_training_table_with_loans": _stored_training(include_loans=True),
    "stored_training_table_all_periods": _STORED_ALL,
    "ingest_all_tables": _INGESTED,
    "store_churn_labels": "SELECT * REPLACE (CAST(bib_id AS VARCHAR) AS bib_id) "
    f"FROM ({_ALL_LABELS})",
    "sketched_counts": """
        SELECT user_id, count(*) AS n_rows, count(value) AS n_values, round(sum(value), 4) AS total
        FROM events GROUP BY user_id""",
    "store_training_table": _stored_training(include_loans=False),
    "top_loans": """
        SELECT l_orderkey AS loan_id, count(*) AS count FROM lineitem
        GROUP BY 1 ORDER BY count DESC, loan_id LIMIT 20""",
    "preview_customers": """
        SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment FROM customer
        ORDER BY md5(concat_ws(chr(31), '0', CAST(c_custkey AS VARCHAR), CAST(c_nationkey AS VARCHAR), c_mktsegment))
        LIMIT 25""",
    "ages_today": with_views("subscriber", "SELECT bib_id, true AS same FROM subscriber"),
    "loan_recovery_prefiltered": """
        SELECT l_orderkey AS loan_id, round(sum(l_extendedprice), 4) AS sum_of_loan_amount,
               round(sum(l_extendedprice * (1 - l_discount)), 4) AS sum_of_recovery
        FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 400000)
        GROUP BY 1""",
}
