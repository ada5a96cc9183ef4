"""DuckDB oracle SQL for the registered queries.

Each string runs on the driver's parquet tables registered as views. The
``tx`` CTE is the same fixture mapping as ``sources.tables.transactions``.
Outputs use BIGINT / DOUBLE / VARCHAR / BOOLEAN / TIMESTAMP, matching
``plans.outputs.comparable`` on the Spark side.
"""

from __future__ import annotations

AS_OF_SQL = "TIMESTAMP '2001-11-05 00:00:00'"
EVENTS_AS_OF_SQL = "TIMESTAMP '2024-01-31 00:00:00'"
SALT = "DEFAULT_SALT_CHANGE_ME"


def tx_cte(variant: str = "prod", status_case: str = "upper", name: str = "tx") -> str:
    """The fixture as a CTE. The copies of ``dup`` come a day later with an
    amount one higher, so that which copy is kept shows."""
    status = ("CASE l_returnflag WHEN 'A' THEN 'COMPLETED' WHEN 'N' THEN 'PENDING' "
              "WHEN 'R' THEN 'FAILED' END")
    if status_case == "lower":
        status = f"lower({status})"
    cols = f"""
        substr(m,1,8)||'-'||substr(m,9,4)||'-'||substr(m,13,4)||'-'||substr(m,17,4)||'-'||substr(m,21,12) AS transaction_id,
        CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE CAST(o_custkey AS INTEGER) END AS user_id,
        CASE WHEN l_partkey % 101 = 0 THEN NULL ELSE p_type END AS product_category,
        CAST(CASE WHEN (l_orderkey + l_linenumber) % 211 = 0 THEN NULL
             WHEN (l_orderkey + l_linenumber) % 53 = 0 THEN -CAST(l_extendedprice AS DECIMAL(12,2))
             WHEN l_linenumber = 7 THEN CAST(l_extendedprice AS DECIMAL(12,2))
             ELSE round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)), 2)
        END AS DECIMAL(10,2)) AS amount,
        CASE WHEN l_suppkey % 50 = 7 THEN 'JPYX' WHEN l_suppkey % 3 = 0 THEN 'USD'
             WHEN l_suppkey % 3 = 1 THEN 'EUR' ELSE 'GBP' END AS currency,
        l_shipdate + to_hours(CAST(l_orderkey % 24 AS BIGINT)) AS transaction_date,
        {status} AS status,
        o_orderdate AS ingested_at,
        'f' || CAST(l_orderkey % 10 AS VARCHAR) AS source_file,
        'PENDING' AS gx_validation_status,
        CAST(NULL AS VARCHAR) AS gx_validation_errors"""
    if variant != "audit":
        cols += """,
        l_shipdate + INTERVAL 1 DAY AS processed_at,
        CASE WHEN l_suppkey % 37 = 0 THEN NULL
             ELSE CAST((CAST(l_quantity AS DECIMAL(5,2)) + 50) / 100 AS DECIMAL(3,2)) END AS data_quality_score"""
    where = {"published": "WHERE l_orderkey % 3 = 0", "dup_extra": "WHERE l_orderkey % 89 = 0"}
    body = lambda w: f"""SELECT {cols}
    FROM (SELECT l.*, o.o_custkey, o.o_orderdate, p.p_type,
                 md5(concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber,
                               CAST(l_quantity AS INTEGER), strftime(l_shipdate, '%Y%m%d'))) AS m
          FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
               JOIN part p ON l.l_partkey = p.p_partkey {w}) s"""
    if variant == "dup":
        later = (f"SELECT * REPLACE (CAST(amount + 1 AS DECIMAL(10,2)) AS amount, "
                 f"ingested_at + INTERVAL 1 DAY AS ingested_at) FROM ({body(where['dup_extra'])})")
        return f"{name} AS ({body('')} UNION ALL {later})"
    return f"{name} AS ({body(where.get(variant, ''))})"


def _steps(value: str, labels: list[str], floors: list[str]) -> str:
    """The label of the highest floor reached; the first one below all floors
    and for NULL."""
    reached = " + ".join(f"COALESCE(CAST({value} >= {f} AS INTEGER), 0)" for f in floors)
    listed = ", ".join(f"'{x}'" for x in labels)
    return f"list_extract([{listed}], 1 + {reached})"


def stg_ctes(status_case: str = "lower") -> str:
    """Staged rows: parts of the date are cut from its text form, tiers are
    counted floors, and weekday numbers come from the ISO number."""
    part = lambda fmt: f"CAST(strftime(moment, '{fmt}') AS INTEGER)"
    return f"""{tx_cte('prod', status_case)},
typed AS (
    SELECT left(transaction_id, 50) AS transaction_id, user_id, lower(product_category) AS product_category,
           left(currency, 3) AS currency, amount, transaction_date AS moment,
           left(upper(status), 20) AS status, processed_at, data_quality_score
    FROM tx),
stg AS (
    SELECT transaction_id, user_id, product_category, currency, amount, status, processed_at,
           data_quality_score, moment AS transaction_date,
           CAST(CAST(moment AS DATE) AS TIMESTAMP) AS transaction_day,
           {part('%Y')} AS transaction_year, {part('%m')} AS transaction_month,
           {part('%d')} AS transaction_day_of_month, {part('%H')} AS transaction_hour,
           isodow(moment) % 7 AS transaction_day_of_week,
           {_steps('data_quality_score', ['low', 'medium', 'high'], ['0.7', '0.9'])} AS data_quality_tier,
           {_steps('amount', ['low_value', 'medium_value', 'high_value'], ['100', '1000'])}
               AS transaction_value_tier,
           {AS_OF_SQL} AS dbt_transformed_at,
           COALESCE(sign(amount) = -1, FALSE) AS is_anomaly,
           isodow(moment) >= 6 AS is_weekend
    FROM typed)"""


STG_SELECT = """
    transaction_id, CAST(user_id AS BIGINT) AS user_id, product_category, currency,
    CAST(amount AS DOUBLE) AS amount, transaction_date, transaction_day,
    CAST(transaction_year AS BIGINT) AS transaction_year,
    CAST(transaction_month AS BIGINT) AS transaction_month,
    CAST(transaction_day_of_month AS BIGINT) AS transaction_day_of_month,
    CAST(transaction_day_of_week AS BIGINT) AS transaction_day_of_week,
    CAST(transaction_hour AS BIGINT) AS transaction_hour,
    status, processed_at, CAST(data_quality_score AS DOUBLE) AS data_quality_score,
    data_quality_tier, transaction_value_tier, dbt_transformed_at, is_anomaly, is_weekend"""


def _bucket(rank: str, n: str, buckets: int) -> str:
    """Bucket of a 1-based rank among ``n``: the first ``n % buckets`` buckets
    hold one more than the others."""
    size, more = f"({n} // {buckets})", f"({n} % {buckets})"
    return (f"CASE WHEN {rank} <= {more} * ({size} + 1) THEN (({rank} - 1) // ({size} + 1)) + 1 "
            f"ELSE {more} + (({rank} - 1 - {more} * ({size} + 1)) // {size}) + 1 END")


def _position(measure: str) -> str:
    """Rows of ``spent`` by how many others stand before them: larger
    ``measure`` first (NULL largest), then the smaller user (NULL smallest)."""
    big = f"COALESCE(CAST({{0}}.{measure} AS DOUBLE), 'Infinity'::DOUBLE)"
    who = "COALESCE({0}.user_id, -1)"
    m, o = big.format("me"), big.format("other")
    return (f"SELECT me.who, 1 + COUNT(other.who) AS place FROM spent me LEFT JOIN spent other "
            f"ON {o} > {m} OR ({o} = {m} AND {who.format('other')} < {who.format('me')}) "
            f"GROUP BY me.who")


def _off_by(base: str) -> str:
    """Distance from a positive base in percent."""
    return (f"CASE WHEN {base} > 0 THEN "
            f"round((CAST(amount AS DOUBLE) - {base}) / {base} * 100, 2) END")


def enriched_ctes() -> str:
    """Metrics over COMPLETED rows by other means than the engine's: filtered
    aggregates of one pass over all rows, quartiles by counting who stands
    before, the median from the sorted list, and the moving average by a join
    on day numbers."""
    done = "FILTER (WHERE status = 'COMPLETED')"
    return f"""{stg_ctes('lower')},
spent AS (
    SELECT user_id, COALESCE(CAST(user_id AS VARCHAR), 'none') AS who, COUNT(*) {done} AS n,
           COUNT(DISTINCT transaction_day) {done} AS days,
           COUNT(DISTINCT product_category) {done} AS kinds,
           SUM(amount) {done} AS total, COUNT(amount) {done} AS priced,
           list_sort(list(CAST(amount AS DOUBLE)) FILTER (WHERE status = 'COMPLETED' AND amount IS NOT NULL)) AS sorted,
           stddev_samp(CAST(amount AS DOUBLE)) {done} AS spread
    FROM stg GROUP BY user_id HAVING COUNT(*) {done} > 0),
by_total AS ({_position('total')}),
by_count AS ({_position('n')}),
users AS (
    SELECT spent.*, CAST(total AS DOUBLE) / NULLIF(priced, 0) AS mean,
           sorted[(priced + 1) // 2] + (sorted[priced // 2 + 1] - sorted[(priced + 1) // 2]) * 0.5 AS middle,
           {_bucket('by_total.place', 'everyone.n', 4)} AS value_quartile,
           {_bucket('by_count.place', 'everyone.n', 4)} AS frequency_quartile
    FROM spent JOIN by_total USING (who) JOIN by_count USING (who),
         (SELECT COUNT(*) AS n FROM spent) everyone),
kinds AS (
    SELECT product_category AS kind, COUNT(*) {done} AS n, SUM(amount) {done} AS total,
           CAST(SUM(amount) {done} AS DOUBLE) / NULLIF(COUNT(amount) {done}, 0) AS mean,
           COUNT(DISTINCT user_id) {done} AS users
    FROM stg GROUP BY 1 HAVING COUNT(*) {done} > 0),
days AS (
    SELECT transaction_day AS day, COUNT(*) {done} AS n, SUM(amount) {done} AS total,
           CAST(SUM(amount) {done} AS DOUBLE) / NULLIF(COUNT(amount) {done}, 0) AS mean,
           COUNT(DISTINCT user_id) {done} AS users, row_number() OVER (ORDER BY transaction_day) AS nr
    FROM stg GROUP BY 1 HAVING COUNT(*) {done} > 0),
weeks AS (
    SELECT this.day, CAST(SUM(back.total) AS DOUBLE) / NULLIF(COUNT(back.total), 0) AS average
    FROM days this JOIN days back ON this.nr - back.nr BETWEEN 0 AND 6 GROUP BY this.day),
enriched AS (
    SELECT stg.*, users.n AS user_total_transactions, users.days AS user_active_days,
           users.kinds AS user_unique_categories, users.total AS user_total_amount,
           users.mean AS user_avg_transaction_amount, users.middle AS user_median_transaction_amount,
           users.spread AS user_stddev_transaction_amount, users.value_quartile AS user_value_quartile,
           users.frequency_quartile AS user_frequency_quartile,
           kinds.n AS category_total_transactions, kinds.total AS category_total_amount,
           kinds.mean AS category_avg_amount, kinds.users AS category_unique_users,
           days.n AS daily_transaction_count, days.total AS daily_total_amount,
           days.mean AS daily_avg_amount, days.users AS daily_unique_users,
           weeks.average AS daily_amount_7day_moving_avg,
           {_off_by('users.mean')} AS deviation_from_user_avg_pct,
           {_off_by('days.mean')} AS deviation_from_daily_avg_pct,
           round(0.2 + 0.4 * data_quality_score + 0.2 * COALESCE(CAST(users.n > 10 AS INTEGER), 0)
                 + 0.2 * COALESCE(CAST(amount > kinds.mean AS INTEGER), 0), 2) AS composite_reliability_score
    FROM stg LEFT JOIN users ON users.user_id = stg.user_id
             LEFT JOIN kinds ON kinds.kind = stg.product_category
             LEFT JOIN days ON days.day = stg.transaction_day
             LEFT JOIN weeks ON weeks.day = stg.transaction_day)"""


ENRICHED_EXTRA_SELECT = """,
    CAST(user_total_transactions AS BIGINT) AS user_total_transactions,
    CAST(user_active_days AS BIGINT) AS user_active_days,
    CAST(user_unique_categories AS BIGINT) AS user_unique_categories,
    CAST(user_total_amount AS DOUBLE) AS user_total_amount,
    user_avg_transaction_amount,
    round(CAST(user_median_transaction_amount AS DOUBLE), 4) AS user_median_transaction_amount,
    round(user_stddev_transaction_amount, 4) AS user_stddev_transaction_amount,
    CAST(user_value_quartile AS BIGINT) AS user_value_quartile,
    CAST(user_frequency_quartile AS BIGINT) AS user_frequency_quartile,
    CAST(category_total_transactions AS BIGINT) AS category_total_transactions,
    CAST(category_total_amount AS DOUBLE) AS category_total_amount,
    category_avg_amount,
    CAST(category_unique_users AS BIGINT) AS category_unique_users,
    CAST(daily_transaction_count AS BIGINT) AS daily_transaction_count,
    CAST(daily_total_amount AS DOUBLE) AS daily_total_amount,
    daily_avg_amount,
    CAST(daily_unique_users AS BIGINT) AS daily_unique_users,
    daily_amount_7day_moving_avg,
    deviation_from_user_avg_pct, deviation_from_daily_avg_pct,
    CAST(composite_reliability_score AS DOUBLE) AS composite_reliability_score"""


def fct_ctes() -> str:
    """Facts: labels by arithmetic on the month and by place in a list."""
    return f"""{enriched_ctes()},
fct AS (
    SELECT enriched.*, 'Q' || ((transaction_month + 2) // 3) AS transaction_quarter,
           'H' || ((transaction_month + 5) // 6) AS transaction_semester,
           ['Domingo', 'Lunes', 'Martes', 'Miercoles', 'Jueves', 'Viernes', 'Sabado']
               [transaction_day_of_week + 1] AS transaction_day_name,
           ['Dia Laboral', 'Fin de Semana'][1 + CAST(is_weekend AS INTEGER)] AS day_type
    FROM enriched SEMI JOIN (VALUES ('COMPLETED')) wanted(status) USING (status)
    WHERE NOT (data_quality_score < 0.7 OR data_quality_score IS NULL) AND amount > 0)"""


FCT_SELECT = """
    transaction_id, CAST(user_id AS BIGINT) AS user_id, product_category, currency, status,
    transaction_value_tier, data_quality_tier, transaction_date, transaction_day,
    CAST(transaction_day_of_week AS BIGINT) AS transaction_day_of_week, transaction_day_name,
    CAST(transaction_month AS BIGINT) AS transaction_month,
    CAST(transaction_year AS BIGINT) AS transaction_year,
    transaction_quarter, transaction_semester, day_type,
    CAST(amount AS DOUBLE) AS amount, CAST(data_quality_score AS DOUBLE) AS data_quality_score,
    CAST(composite_reliability_score AS DOUBLE) AS composite_reliability_score,
    CAST(user_total_transactions AS BIGINT) AS user_total_transactions,
    CAST(user_total_amount AS DOUBLE) AS user_total_amount, user_avg_transaction_amount,
    CAST(user_active_days AS BIGINT) AS user_active_days,
    CAST(user_value_quartile AS BIGINT) AS user_value_quartile,
    CAST(user_frequency_quartile AS BIGINT) AS user_frequency_quartile,
    category_avg_amount, CAST(daily_transaction_count AS BIGINT) AS daily_transaction_count,
    CAST(daily_total_amount AS DOUBLE) AS daily_total_amount, daily_amount_7day_moving_avg,
    is_anomaly, is_weekend, dbt_transformed_at"""


def sql_stg_raw_transactions() -> str:
    return f"WITH {stg_ctes('lower')}\nSELECT {STG_SELECT} FROM stg"


def sql_int_transactions_enriched() -> str:
    return f"WITH {enriched_ctes()}\nSELECT {STG_SELECT}{ENRICHED_EXTRA_SELECT} FROM enriched"


def sql_fct_transactions() -> str:
    return f"WITH {fct_ctes()}\nSELECT {FCT_SELECT} FROM fct"


def sql_analytics_transactions() -> str:
    return f"""WITH {fct_ctes()}
SELECT transaction_id,
    CASE WHEN user_id IS NULL THEN NULL
         ELSE 'U_' || substr(md5('{SALT}' || CAST(user_id AS VARCHAR)), 1, 16) END AS user_pseudo_id,
    product_category, CAST(amount AS DOUBLE) AS amount, currency, transaction_date, status,
    CAST(data_quality_score AS DOUBLE) AS data_quality_score, transaction_day, transaction_quarter,
    CAST(user_value_quartile AS BIGINT) AS user_value_quartile,
    CAST(user_frequency_quartile AS BIGINT) AS user_frequency_quartile
FROM fct"""


# ---------------------------------------------------------------------------
# Quality (Q*), publish (M10, M11, U4, B6/B7, O8, G11), dimensions (M5–M8).

def _sql_lit(v) -> str:
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    if v is None:
        return "NULL"
    return "'" + str(v).replace("'", "''") + "'"


def _between_sql(c: str, kw: dict) -> str:
    conds = []
    if kw.get("min_value") is not None:
        conds.append(f"{c} {'>' if kw.get('strict_min') else '>='} {_sql_lit(kw['min_value'])}")
    if kw.get("max_value") is not None:
        conds.append(f"{c} {'<' if kw.get('strict_max') else '<='} {_sql_lit(kw['max_value'])}")
    return " AND ".join(conds) or "TRUE"


def rule_fail_sql(rule) -> str | None:
    t, kw = rule.expectation_type, rule.kwargs
    c = kw.get("column")
    if t == "expect_column_values_to_not_be_null":
        return f"{c} IS NULL"
    if t == "expect_column_values_to_be_between":
        return f"{c} IS NOT NULL AND NOT ({_between_sql(c, kw)})"
    if t == "expect_column_values_to_be_in_set":
        return f"{c} IS NOT NULL AND {c} NOT IN ({', '.join(_sql_lit(v) for v in kw['value_set'])})"
    if t == "expect_column_values_to_match_regex":
        return f"{c} IS NOT NULL AND NOT regexp_matches({c}, {_sql_lit(kw['regex'])})"
    return None


def suite_sql(suite, source_cte: str, source: str) -> str:
    """Per-rule result rows for a suite over ``source`` (same columns as
    ``quality.run_suite``)."""
    parts = []
    for i, r in enumerate(suite.rules):
        t, kw = r.expectation_type, r.kwargs
        if t == "expect_table_row_count_to_be_between":
            counts = f"SELECT COUNT(*) AS e, COUNT(*) AS nn, 0 AS u FROM {source}"
        elif t == "expect_column_values_to_be_unique":
            c = r.column
            counts = (f"SELECT COALESCE(SUM(n), 0) AS e, COALESCE(SUM(n) FILTER (WHERE {c} IS NOT NULL), 0) AS nn, "
                      f"COALESCE(SUM(n) FILTER (WHERE {c} IS NOT NULL AND n > 1), 0) AS u "
                      f"FROM (SELECT {c}, COUNT(*) AS n FROM {source} GROUP BY {c})")
        else:
            counts = (f"SELECT COUNT(*) AS e, COUNT({r.column}) AS nn, "
                      f"COUNT(*) FILTER (WHERE {rule_fail_sql(r)}) AS u FROM {source}")
        base = "e" if t == "expect_column_values_to_not_be_null" else "nn"
        mostly = kw.get("mostly")
        if t == "expect_table_row_count_to_be_between":
            conds = []
            if kw.get("min_value") is not None:
                conds.append(f"e >= {_sql_lit(kw['min_value'])}")
            if kw.get("max_value") is not None:
                conds.append(f"e <= {_sql_lit(kw['max_value'])}")
            success = " AND ".join(conds) or "TRUE"
        elif mostly is None:
            success = "u = 0"
        else:
            success = (f"{base} = 0 OR CAST({base} - u AS DECIMAL(38,6)) >= "
                       f"CAST({_sql_lit(float(mostly))} AS DECIMAL(10,6)) * CAST({base} AS DECIMAL(28,0))")
        parts.append(
            f"SELECT {_sql_lit(suite.name)} AS suite, CAST({i} AS BIGINT) AS rule_index, "
            f"{_sql_lit(t)} AS expectation_type, CAST({_sql_lit(r.column)} AS VARCHAR) AS \"column\", "
            f"CAST({_sql_lit(r.severity)} AS VARCHAR) AS severity, {_sql_lit(suite.blocking)} AS blocking, "
            f"CAST(e AS BIGINT) AS element_count, CAST(nn AS BIGINT) AS nonnull_count, "
            f"CAST(u AS BIGINT) AS unexpected_count, ({success}) AS success FROM ({counts})")
    return f"WITH {source_cte}\n" + "\nUNION ALL\n".join(parts)


AUDIT_SELECT = """
    transaction_id, CAST(user_id AS BIGINT) AS user_id, product_category,
    CAST(amount AS DOUBLE) AS amount, currency, transaction_date, status, ingested_at,
    source_file, gx_validation_status, gx_validation_errors"""


def sql_quality_check() -> str:
    return f"""WITH {tx_cte('audit')}
SELECT COUNT(*) FILTER (WHERE amount < 0) AS negativos,
       COUNT(*) FILTER (WHERE user_id IS NULL) AS nulos FROM tx"""


def sql_validation_metrics() -> str:
    return f"""WITH {tx_cte('audit')},
c AS (SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE amount < 0) AS neg,
             COUNT(*) FILTER (WHERE user_id IS NULL) AS nulls FROM tx)
SELECT {AS_OF_SQL} AS validation_timestamp, 'raw_transactions' AS table_name,
       total AS total_records, neg + nulls AS failed_records,
       'transactions_critical_suite' AS expectation_suite_name, '' AS warning_messages,
       CASE WHEN total > 0 THEN round((total - (neg + nulls)) / total * 100, 2) ELSE 100.0 END AS success_rate,
       concat_ws(', ', CASE WHEN neg > 0 THEN 'amount negativos' END,
                       CASE WHEN nulls > 0 THEN 'user_id nulos' END) AS critical_failures,
       (neg + nulls) > 0 AS blocking_triggered
FROM c"""


def sql_row_verdicts(suite) -> str:
    labels = []
    joins = []
    for i, r in enumerate(suite.rules):
        label = f"{r.expectation_type}:{r.column}" if r.column else r.expectation_type
        if r.expectation_type == "expect_column_values_to_be_unique":
            joins.append(f"LEFT JOIN (SELECT {r.column} AS k{i}, TRUE AS d{i} FROM tx "
                         f"WHERE {r.column} IS NOT NULL GROUP BY {r.column} HAVING COUNT(*) > 1) u{i} "
                         f"ON tx.{r.column} = u{i}.k{i}")
            labels.append(f"CASE WHEN COALESCE(d{i}, FALSE) THEN {_sql_lit(label)} END")
        else:
            f = rule_fail_sql(r)
            if f is not None:
                labels.append(f"CASE WHEN COALESCE({f}, FALSE) THEN {_sql_lit(label)} END")
    errs = f"concat_ws(',', {', '.join(labels)})"
    return f"""WITH {tx_cte('dup')}
SELECT tx.transaction_id, CAST(tx.user_id AS BIGINT) AS user_id,
       CASE WHEN {errs} = '' THEN 'PASSED' ELSE 'FAILED' END AS gx_validation_status,
       {errs} AS gx_validation_errors
FROM tx {' '.join(joins)}"""


def model_tests_sql(model: str, tests, source_cte: str, source: str) -> str:
    parts = []
    for i, t in enumerate(tests):
        c = t.column
        if t.test == "not_null":
            q = f"SELECT COUNT(*) FILTER (WHERE {c} IS NULL) AS f FROM {source}"
        elif t.test == "unique":
            q = (f"SELECT COUNT(*) AS f FROM (SELECT {c} FROM {source} WHERE {c} IS NOT NULL "
                 f"GROUP BY {c} HAVING COUNT(*) > 1)")
        elif t.test == "accepted_values":
            q = (f"SELECT COUNT(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN "
                 f"({', '.join(_sql_lit(v) for v in t.args['values'])})) AS f FROM {source}")
        else:
            a, inc, conds = t.args, t.args.get("inclusive", True), []
            if a.get("min_value") is not None:
                conds.append(f"{c} {'>=' if inc else '>'} {_sql_lit(a['min_value'])}")
            if a.get("max_value") is not None:
                conds.append(f"{c} {'<=' if inc else '<'} {_sql_lit(a['max_value'])}")
            q = f"SELECT COUNT(*) FILTER (WHERE NOT ({' AND '.join(conds)})) AS f FROM {source}"
        parts.append(f"SELECT {_sql_lit(model)} AS model, CAST({i} AS BIGINT) AS test_index, "
                     f"{_sql_lit(c)} AS column_name, {_sql_lit(t.test)} AS test_name, "
                     f"CAST(f AS BIGINT) AS failures, f = 0 AS passed FROM ({q})")
    return f"WITH {source_cte}\n" + "\nUNION ALL\n".join(parts)


def sql_repair() -> str:
    return f"""WITH {tx_cte('audit')}
SELECT transaction_id, CAST(COALESCE(user_id, 0) AS BIGINT) AS user_id, product_category,
    CAST(CASE WHEN amount < 0 THEN 0 ELSE amount END AS DOUBLE) AS amount, currency,
    transaction_date, status, ingested_at, source_file, gx_validation_status, gx_validation_errors
FROM tx"""


def sql_publish_clean() -> str:
    return f"WITH {tx_cte('audit')}\nSELECT {AUDIT_SELECT} FROM tx WHERE amount >= 0"


_NEWEST = "QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY ingested_at DESC) = 1"


def sql_publish_incremental() -> str:
    return f"""WITH {tx_cte('dup')}, {tx_cte('published', name='prod')},
new AS (SELECT * FROM tx WHERE status = 'COMPLETED' AND amount > 0 AND user_id IS NOT NULL {_NEWEST})
SELECT {AUDIT_SELECT}, {AS_OF_SQL} AS processed_at, CAST(1.0 AS DOUBLE) AS data_quality_score
FROM new WHERE NOT EXISTS (SELECT 1 FROM prod WHERE prod.transaction_id = new.transaction_id)"""


def sql_publish_incremental_by_day() -> str:
    """The published rows' dates have moved, some new rows have no date and
    some no key: only the key decides, and a row without one isn't published."""
    return f"""WITH {tx_cte('dup')}, {tx_cte('published', name='prod')},
changed AS (
    SELECT * REPLACE (CASE WHEN day(ingested_at) % 5 = 0 THEN NULL ELSE transaction_date END AS transaction_date,
                      CASE WHEN user_id % 17 = 0 THEN NULL ELSE transaction_id END AS transaction_id)
    FROM tx),
new AS (SELECT * FROM changed WHERE status = 'COMPLETED' AND amount > 0 AND user_id IS NOT NULL
        AND transaction_id IS NOT NULL {_NEWEST})
SELECT {AUDIT_SELECT}, {AS_OF_SQL} AS processed_at, CAST(1.0 AS DOUBLE) AS data_quality_score,
       CAST(CAST(transaction_date AS DATE) AS TIMESTAMP) AS transaction_day
FROM new WHERE transaction_id NOT IN (SELECT transaction_id FROM prod)"""


def sql_dedup() -> str:
    return (f"WITH {tx_cte('dup')}\nSELECT {AUDIT_SELECT}, processed_at, "
            f"CAST(data_quality_score AS DOUBLE) AS data_quality_score FROM tx {_NEWEST}")


def sql_reconciliation() -> str:
    return f"""WITH {tx_cte('audit')}
SELECT (SELECT COUNT(*) FROM tx) AS total_audit,
       (SELECT COUNT(*) FROM tx WHERE amount >= 0) AS total_prod,
       (SELECT COUNT(*) FROM tx) - (SELECT COUNT(*) FROM tx WHERE amount >= 0) AS registros_filtrados"""


def sql_prod_summary() -> str:
    return f"""WITH {tx_cte('prod')}
SELECT COUNT(*) AS total_prod, COUNT(DISTINCT user_id) AS usuarios_unicos,
       CAST(SUM(amount) AS DOUBLE) / COUNT(amount) AS monto_promedio FROM tx"""


def _cleaned_cte() -> str:
    # DAG order: repair, then publish_clean (amount >= 0).
    return f"""{tx_cte('audit')},
cleaned AS (SELECT transaction_id, COALESCE(user_id, 0) AS user_id, product_category,
    CASE WHEN amount < 0 THEN 0 ELSE amount END AS amount, currency, status FROM tx
    WHERE (CASE WHEN amount < 0 THEN 0 ELSE amount END) >= 0)"""


def sql_fact_transactions() -> str:
    return f"""WITH {_cleaned_cte()}
SELECT transaction_id, CAST(user_id AS BIGINT) AS user_id, product_category,
       CAST(amount AS DOUBLE) AS amount, currency, status FROM cleaned"""


def sql_dim_users() -> str:
    return f"WITH {_cleaned_cte()}\nSELECT DISTINCT CAST(user_id AS BIGINT) AS user_id FROM cleaned"


def sql_dim_product_category() -> str:
    return f"WITH {_cleaned_cte()}\nSELECT DISTINCT product_category FROM cleaned"


def sql_stg_masked() -> str:
    return f"""WITH {stg_ctes('lower')}
SELECT transaction_id,
    CASE WHEN user_id IS NULL THEN NULL
         WHEN length(CAST(user_id AS VARCHAR)) <= 8 THEN '****'
         ELSE left(CAST(user_id AS VARCHAR), 2) || '****' || right(CAST(user_id AS VARCHAR), 4) END AS user_id_masked,
    product_category, CAST(amount AS DOUBLE) AS amount, currency, transaction_date, status
FROM stg"""


# --- privacy views and observability ----------------------------------------

def sql_audit_masked() -> str:
    return f"""WITH {tx_cte('audit')}
SELECT transaction_id, concat('user_', md5(CAST(user_id AS VARCHAR))) AS user_id_masked,
       product_category, CAST(amount AS DOUBLE) AS amount, currency, transaction_date, status FROM tx"""


def sql_prod_masked() -> str:
    return f"""WITH {tx_cte('prod')}
SELECT transaction_id, concat('U', left(md5(CAST(user_id AS VARCHAR)), 8)) AS user_short_id,
       product_category, CAST(amount AS DOUBLE) AS amount, currency,
       date_trunc('day', transaction_date) AS transaction_day, status FROM tx"""


def _pseudo(c: str) -> str:
    return (f"CASE WHEN {c} IS NULL THEN NULL "
            f"ELSE 'U_' || substr(md5('{SALT}' || CAST({c} AS VARCHAR)), 1, 16) END")


def sql_analytics_view() -> str:
    return f"""WITH {tx_cte('prod')}
SELECT transaction_id, {_pseudo('user_id')} AS user_pseudo_id, product_category,
       CAST(amount AS DOUBLE) AS amount, currency, transaction_date, status,
       CAST(data_quality_score AS DOUBLE) AS data_quality_score,
       date_trunc('day', transaction_date) AS transaction_day,
       CASE WHEN month(transaction_date) IN (1,2,3) THEN 'Q1' WHEN month(transaction_date) IN (4,5,6) THEN 'Q2'
            WHEN month(transaction_date) IN (7,8,9) THEN 'Q3' ELSE 'Q4' END AS transaction_quarter
FROM tx"""


def sql_masked_contacts() -> str:
    email = """CASE WHEN c_custkey % 29 = 0 THEN NULL WHEN c_custkey % 23 = 0 THEN 'a@b.c'
             WHEN c_custkey % 19 = 0 THEN lower(replace(c_name, '#', '.'))
             ELSE lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.test' END"""
    return f"""WITH c AS (SELECT c_custkey, c_name, {email} AS email FROM customer)
SELECT c_custkey,
    CASE WHEN email IS NULL THEN NULL WHEN length(email) <= 5 THEN '***'
         ELSE left(email, 2) || '***' ||
              CASE WHEN position('@' IN email) > 0 THEN right(email, length(email) - position('@' IN email) + 1)
                   ELSE '' END END AS email_masked,
    CASE WHEN email IS NULL THEN NULL WHEN length(email) <= 5 THEN '***'
         ELSE left(email, 2) || '***' || right(email, length(email) - position('@' IN email) + 1) END
      AS email_masked_reference,
    CASE WHEN c_name IS NULL THEN NULL ELSE left(c_name, 1) || '***' END AS name_masked,
    CASE WHEN length(CAST(c_custkey AS VARCHAR)) <= 8 THEN '****'
         ELSE left(CAST(c_custkey AS VARCHAR), 2) || '****' || right(CAST(c_custkey AS VARCHAR), 4) END AS id_masked
FROM c"""


def sql_rule_masking() -> str:
    return f"""WITH {tx_cte('audit')}
SELECT CASE WHEN transaction_id IS NULL THEN NULL
            ELSE repeat('*', greatest(length(transaction_id) - 4, 0)) || right(transaction_id, 4) END
         AS transaction_id,
       CAST(user_id AS BIGINT) AS user_id, product_category, CAST(amount AS DOUBLE) AS amount, currency,
       transaction_date, status, ingested_at, source_file, gx_validation_status, gx_validation_errors
FROM tx"""


def sql_freshness_record() -> str:
    now = EVENTS_AS_OF_SQL
    return f"""WITH a AS (
    SELECT event_type AS table_name,
           max(CASE WHEN ts > {now} - INTERVAL 24 HOUR AND ts <= {now} THEN ts END) AS actual_arrival_time
    FROM events GROUP BY event_type)
SELECT table_name, actual_arrival_time,
    CASE WHEN actual_arrival_time > {now} - INTERVAL 2 HOUR THEN 'FRESH'
         WHEN actual_arrival_time > {now} - INTERVAL 6 HOUR THEN 'STALE' ELSE 'MISSING' END AS status,
    {now} AS check_timestamp, CAST(120 AS BIGINT) AS threshold_minutes,
    (epoch_us({now}) - epoch_us(actual_arrival_time)) / 1e6 AS freshness_lag_seconds
FROM a"""


_ORDER_EDGES = """d AS (
    SELECT o_orderkey AS source_id, lead(o_orderkey) OVER c AS next_id, first_value(o_orderkey) OVER c AS first_id
    FROM orders WINDOW c AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
edges AS (SELECT source_id, coalesce(next_id, first_id) AS target_id FROM d
          WHERE next_id IS NOT NULL OR first_id <> source_id)"""


def sql_file_schema_drift() -> str:
    """The three writers' schemas as text; the rows of each from the orders."""
    return """WITH n AS (SELECT
    count(*) FILTER (o_orderdate < TIMESTAMP '1997-01-01') AS a,
    count(*) FILTER (o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1999-01-01') AS b,
    count(*) FILTER (o_orderdate >= TIMESTAMP '1999-01-01' OR o_orderdate IS NULL) AS c FROM orders)
SELECT 'o_orderkey' AS path, 'widened' AS change, 'int32,int64' AS types, 'int64' AS merged_type,
    a + b + c AS n_rows, 0::BIGINT AS lacking_rows FROM n
UNION ALL SELECT 'customer.id', 'widened', 'int32,int64', 'int64', a + b + c, 0 FROM n
UNION ALL SELECT 'customer.class', 'missing', 'string', 'string', b + c, a FROM n
UNION ALL SELECT 'o_totalprice', 'widened', 'decimal128(12, 2),decimal128(18, 4)', 'decimal128(18, 4)',
    a + b + c, 0 FROM n
UNION ALL SELECT 'o_orderpriority', 'conflict', 'int32,string', NULL, a + b + c, 0 FROM n
UNION ALL SELECT 'o_orderdate', 'missing', 'timestamp[us]', 'timestamp[us]', c, a + b FROM n"""


def sql_lineage_closure(max_hops: int = 4) -> str:
    return f"""WITH RECURSIVE {_ORDER_EDGES},
walk(node, reaches, hops) AS (
    SELECT source_id, target_id, 1 FROM edges
    UNION SELECT node, target_id, hops + 1 FROM walk JOIN edges ON reaches = source_id WHERE hops < {max_hops})
SELECT node, reaches, CAST(min(hops) AS BIGINT) AS hops FROM walk GROUP BY node, reaches"""


def sql_lineage_impact() -> str:
    """By recursion over sets, which end where a cycle closes; the farthest is
    one hop for each order of the customer, back to itself."""
    return f"""WITH RECURSIVE {_ORDER_EDGES},
walk(node, reaches) AS (
    SELECT source_id, target_id FROM edges
    UNION SELECT node, target_id FROM walk JOIN edges ON reaches = source_id)
SELECT node, COUNT(*) AS downstream, COUNT(*) AS farthest FROM walk GROUP BY node"""


def sql_freshness_changes(delay_minutes: int = 10) -> str:
    """Gaps between a feed's arrivals; told up to the watermark, which is behind
    the newest arrival of all, in whole milliseconds."""
    feed = "concat_ws('/', event_type, user_id)"
    return f"""WITH e AS (SELECT DISTINCT {feed} AS feed, ts FROM events WHERE ts IS NOT NULL),
w AS (SELECT epoch_us(max(ts)) // 1000 - {delay_minutes} * 60000 AS mark FROM e),
g AS (SELECT feed, ts, lag(ts) OVER o AS since, lead(ts) OVER o AS until FROM e
      WINDOW o AS (PARTITION BY feed ORDER BY ts)),
c AS (SELECT feed, 'FRESH' AS status, ts AS changed_at FROM g
      WHERE since IS NULL OR ts > since + INTERVAL 2 HOUR
      UNION ALL SELECT feed, 'STALE', ts + INTERVAL 2 HOUR FROM g
      WHERE until IS NULL OR until > ts + INTERVAL 2 HOUR
      UNION ALL SELECT feed, 'MISSING', ts + INTERVAL 6 HOUR FROM g
      WHERE until IS NULL OR until > ts + INTERVAL 6 HOUR)
SELECT feed, status, changed_at FROM c, w WHERE epoch_us(changed_at) // 1000 + 1 < mark"""


def sql_freshness_dashboard() -> str:
    base = EVENTS_AS_OF_SQL
    instants = [base, f"{base} + INTERVAL 4 HOUR", f"{base} + INTERVAL 8 HOUR", f"{base} + INTERVAL 1 DAY"]
    values = ", ".join(f"({i})" for i in instants)
    return f"""WITH m AS (SELECT event_type AS table_name, max(ts) AS last_data_arrival FROM events GROUP BY event_type),
n(as_of) AS (VALUES {values})
SELECT table_name, CAST(as_of AS TIMESTAMP) AS as_of, last_data_arrival,
    (epoch_us(as_of) - epoch_us(last_data_arrival)) / 60000000.0 AS minutes_since_last_update,
    CASE WHEN last_data_arrival > as_of - INTERVAL 2 HOUR THEN 'FRESH'
         WHEN last_data_arrival > as_of - INTERVAL 6 HOUR THEN 'STALE' ELSE 'MISSING' END AS freshness_status
FROM m, n"""


def _dashboard() -> str:
    """Per day of ingestion: faults as sums over rows turned into 0 and 1."""
    return f"""WITH {tx_cte('audit')},
marked AS (
    SELECT CAST(ingested_at AS DATE) AS fecha, CAST(amount IS NULL AS INTEGER) AS unpriced,
           COALESCE(CAST(amount < 0 AS INTEGER), 0) AS below, CAST(user_id IS NULL AS INTEGER) AS unknown
    FROM tx)
SELECT fecha, COUNT(*) AS total_registros, CAST(SUM(below) AS BIGINT) AS registros_monto_negativo,
       CAST(SUM(unpriced) AS BIGINT) AS registros_monto_nulo,
       CAST(SUM(unknown) AS BIGINT) AS registros_user_nulo,
       CAST(round(CAST(100 * (COUNT(*) - SUM(below) - SUM(unpriced)) AS DECIMAL(38,10)) / COUNT(*), 2)
            AS DOUBLE) AS porcentaje_calidad
FROM marked GROUP BY fecha"""


def sql_quality_dashboard() -> str:
    return _dashboard()


def sql_newest_quality_days() -> str:
    return f"{_dashboard()} ORDER BY fecha DESC LIMIT 7"


# --- shredding and RFM ------------------------------------------------------------

def sql_shred_readback() -> str:
    return """SELECT c_custkey, CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE c_name END AS c_name,
       c_custkey % 50 <> 0 AS key_active FROM customer"""


def sql_deletion_status() -> str:
    return f"""SELECT CAST(c_custkey AS BIGINT) AS user_id, c_custkey % 7 <> 0 AS found,
    CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_custkey % 50 <> 0 END AS key_active,
    CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 50 = 0 THEN {AS_OF_SQL} END AS key_revoked,
    CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 50 = 0 THEN 'completed' END AS deletion_status,
    CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 50 = 0 THEN {AS_OF_SQL} END AS completed_at,
    CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 50 = 0 THEN 'Solicitud del usuario' END AS notes
FROM customer"""


def rfm_ctes() -> str:
    return f"""{stg_ctes('lower')},
base AS (
    SELECT user_id, COUNT(*) AS total_transactions, COALESCE(SUM(amount), 0) AS lifetime_value,
        CAST(SUM(amount) AS DOUBLE) / COUNT(amount) AS avg_ticket_size,
        date_diff('day', CAST(max(transaction_date) AS DATE), CAST({AS_OF_SQL} AS DATE)) AS days_since_last_transaction
    FROM stg WHERE status = 'COMPLETED' AND user_id IS NOT NULL GROUP BY user_id),
rfm AS (
    SELECT *,
        NTILE(5) OVER (ORDER BY lifetime_value ASC, user_id ASC) AS value_segment,
        NTILE(5) OVER (ORDER BY total_transactions ASC, user_id ASC) AS frequency_segment,
        NTILE(5) OVER (ORDER BY days_since_last_transaction DESC, user_id ASC) AS recency_segment
    FROM base),
dim_users AS (
    SELECT user_id, total_transactions, lifetime_value, avg_ticket_size,
        value_segment, frequency_segment, recency_segment,
        round((value_segment + frequency_segment + recency_segment) / 3.0, 2) AS rfm_score,
        days_since_last_transaction <= 30 AS is_active_user,
        days_since_last_transaction > 30 AND days_since_last_transaction <= 90 AS is_at_risk_user,
        days_since_last_transaction > 90 AS is_churned_user,
        days_since_last_transaction
    FROM rfm)"""


def sql_rfm() -> str:
    return f"""WITH {rfm_ctes()}
SELECT CAST(user_id AS BIGINT) AS user_id, CAST(total_transactions AS BIGINT) AS total_transactions,
    CAST(lifetime_value AS DOUBLE) AS lifetime_value, avg_ticket_size,
    CAST(value_segment AS BIGINT) AS value_segment, CAST(frequency_segment AS BIGINT) AS frequency_segment,
    CAST(recency_segment AS BIGINT) AS recency_segment, CAST(rfm_score AS DOUBLE) AS rfm_score,
    is_active_user, is_at_risk_user, is_churned_user,
    CAST(days_since_last_transaction AS BIGINT) AS days_since_last_transaction
FROM dim_users"""


def sql_load_quarantine_counts() -> str:
    return f"""WITH {tx_cte('dup')},
b AS (SELECT CASE WHEN user_id % 13 = 0 THEN '' ELSE transaction_id END AS id FROM tx)
SELECT CAST(COUNT(*) FILTER (WHERE id IS NULL OR id IN ('', '0')) + COUNT(DISTINCT id) FILTER (WHERE NOT (id IS NULL OR id IN ('', '0'))) AS BIGINT) AS inserted,
       CAST(COUNT(*) FILTER (WHERE NOT (id IS NULL OR id IN ('', '0'))) - COUNT(DISTINCT id) FILTER (WHERE NOT (id IS NULL OR id IN ('', '0'))) AS BIGINT) AS discarded
FROM b"""


def sql_clustered_read() -> str:
    return f"""WITH {stg_ctes('lower')}
SELECT status, COUNT(*) AS n_rows, CAST(SUM(amount) AS DOUBLE) AS total FROM stg
WHERE transaction_date BETWEEN TIMESTAMP '1994-01-01' AND TIMESTAMP '1995-06-30' AND user_id BETWEEN 20 AND 60
GROUP BY status"""


def sql_sketched_quartiles() -> str:
    """Quartiles by the two neighbours of their place; what the sketches give
    must be within their bound."""
    points = [("q1", "0.25"), ("q2", "0.5"), ("q3", "0.75")]
    at = lambda p, f: f"MAX(v) FILTER (WHERE nth = 1 + {f}({p} * (n - 1)))"
    exact = ",\n    ".join(
        f"round({at(p, 'floor')} + ({at(p, 'ceil')} - {at(p, 'floor')}) "
        f"* (MAX({p} * (n - 1)) - floor(MAX({p} * (n - 1)))), 4) AS exact_{q}" for q, p in points)
    return f"""WITH {stg_ctes('lower')},
placed AS (SELECT currency, CAST(amount AS DOUBLE) AS v,
    row_number() OVER (PARTITION BY currency ORDER BY amount) AS nth,
    COUNT(*) OVER (PARTITION BY currency) AS n
    FROM stg WHERE status = 'COMPLETED' AND amount IS NOT NULL)
SELECT currency, {exact}, {', '.join(f'TRUE AS {q}_within' for q, _ in points)}
FROM placed GROUP BY currency"""


def sql_ntile_by_sketch() -> str:
    return f"""WITH {stg_ctes('lower')},
spent AS (SELECT user_id, SUM(amount) AS total FROM stg WHERE status = 'COMPLETED' GROUP BY user_id)
SELECT CAST(user_id AS BIGINT) AS user_id,
    CAST(ntile(4) OVER (ORDER BY total DESC NULLS FIRST, user_id ASC NULLS FIRST) AS BIGINT) AS value_quartile,
    TRUE AS "within"
FROM spent"""


def sql_weekly_users() -> str:
    """Users of the seven days up to each day, and those not in the seven before."""
    return f"""WITH {stg_ctes('lower')},
seen AS (SELECT DISTINCT transaction_day AS day, user_id FROM stg WHERE status = 'COMPLETED'),
days AS (SELECT DISTINCT day FROM seen)
SELECT d.day, COUNT(DISTINCT s.user_id) AS users,
    COUNT(DISTINCT CASE WHEN p.user_id IS NULL THEN s.user_id END) AS new_users,
    TRUE AS users_within, TRUE AS new_users_within
FROM days d
LEFT JOIN seen s ON s.day > d.day - INTERVAL 7 DAY AND s.day <= d.day AND s.user_id IS NOT NULL
LEFT JOIN (SELECT e.day, x.user_id FROM days e JOIN seen x
           ON x.day > e.day - INTERVAL 14 DAY AND x.day <= e.day - INTERVAL 7 DAY GROUP BY ALL) p
    ON p.day = d.day AND p.user_id = s.user_id
GROUP BY d.day"""


def sql_stream_ingest() -> str:
    """Whatever extract a record comes in: the first of an id is accepted, and
    every record without one."""
    return f"""WITH {tx_cte('dup')},
b AS (SELECT CASE WHEN user_id % 13 = 0 THEN '' ELSE transaction_id END AS id FROM tx),
n AS (SELECT id, COUNT(*) AS copies FROM b GROUP BY id)
SELECT outcome, CAST(SUM(copies) AS BIGINT) AS n_rows
FROM (SELECT 'accepted' AS outcome, CASE WHEN id = '' THEN copies ELSE 1 END AS copies FROM n
      UNION ALL SELECT 'duplicate_key', copies - 1 FROM n WHERE id <> '' AND copies > 1)
GROUP BY outcome"""


def sql_top_users() -> str:
    return f"""WITH {rfm_ctes()}
SELECT CAST(user_id AS BIGINT) AS user_id, CAST(total_transactions AS BIGINT) AS total_transactions,
    CAST(lifetime_value AS DOUBLE) AS lifetime_value, avg_ticket_size,
    CAST(value_segment AS BIGINT) AS value_segment, CAST(frequency_segment AS BIGINT) AS frequency_segment,
    CAST(recency_segment AS BIGINT) AS recency_segment, CAST(rfm_score AS DOUBLE) AS rfm_score,
    is_active_user, is_at_risk_user, is_churned_user,
    CAST(days_since_last_transaction AS BIGINT) AS days_since_last_transaction
FROM dim_users ORDER BY lifetime_value DESC, user_id ASC LIMIT 10"""


def sql_newest_facts() -> str:
    return f"""WITH {fct_ctes()}
SELECT transaction_id, CAST(user_id AS BIGINT) AS user_id, product_category, CAST(amount AS DOUBLE) AS amount,
    transaction_quarter, transaction_semester, transaction_day_name,
    CAST(data_quality_score AS DOUBLE) AS data_quality_score,
    CAST(composite_reliability_score AS DOUBLE) AS composite_reliability_score, is_anomaly
FROM fct ORDER BY transaction_date DESC, transaction_id ASC LIMIT 10"""


def sql_constraint_violations() -> str:
    return f"""WITH {tx_cte('dup')}, {tx_cte('published', name='prod')},
a AS (SELECT transaction_id, product_category, currency, amount, ingested_at,
             CASE WHEN user_id % 11 = 0 THEN lower(status) ELSE status END AS status FROM tx),
r AS (
    SELECT 'bad_status' AS reason, transaction_id, ingested_at FROM a
        WHERE status IS NOT NULL AND status NOT IN ('COMPLETED', 'PENDING', 'FAILED')
    UNION ALL SELECT 'null_key', transaction_id, ingested_at FROM a WHERE transaction_id IS NULL
    UNION ALL SELECT 'key_too_long', transaction_id, ingested_at FROM a WHERE length(transaction_id) > 50
    UNION ALL SELECT 'category_too_long', transaction_id, ingested_at FROM a WHERE length(product_category) > 50
    UNION ALL SELECT 'currency_too_long', transaction_id, ingested_at FROM a WHERE length(currency) > 10
    UNION ALL SELECT 'duplicate_key', transaction_id, ingested_at FROM a
        WHERE transaction_id IN (SELECT transaction_id FROM prod)),
good AS (SELECT transaction_id, ingested_at FROM a ANTI JOIN r USING (transaction_id, ingested_at)),
again AS (SELECT transaction_id, COUNT(*) - 1 AS n FROM good GROUP BY 1 HAVING COUNT(*) > 1)
SELECT reason, CAST(SUM(n) AS BIGINT) AS n_rows
FROM (SELECT reason, 1 AS n FROM r UNION ALL SELECT 'duplicate_key', n FROM again) GROUP BY reason"""
