"""DuckDB twins of the queries on feature tables, record lists and text columns."""

from __future__ import annotations

SAMPLES = """
samples AS (
  SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS rec_id,
         CASE WHEN l_orderkey % 97 = 0 THEN 'n/a'
              WHEN l_orderkey % 89 = 0 THEN NULL
              ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS size,
         CASE WHEN l_partkey % 53 = 0 THEN l_extendedprice * 10 ELSE l_extendedprice END AS weight,
         CASE WHEN l_partkey % 61 <> 0 THEN l_discount END AS sweetness,
         l_tax AS acidity,
         CASE l_returnflag WHEN 'A' THEN 'Good' WHEN 'N' THEN 'BAD' ELSE 'returned' END AS quality
  FROM lineitem),
samples_dup AS (
  SELECT * FROM samples
  UNION ALL
  SELECT * FROM samples WHERE CAST(split_part(rec_id, '-', 1) AS BIGINT) % 101 = 0)
"""
LABEL_CODE = """CASE lower(quality) WHEN 'bad' THEN 0 WHEN '0' THEN 0 WHEN 'false' THEN 0
  WHEN 'good' THEN 1 WHEN '1' THEN 1 WHEN 'true' THEN 1 END"""
TYPED = f"""{SAMPLES},
typed AS (
  SELECT rec_id, TRY_CAST(size AS DOUBLE) AS size, weight, sweetness, acidity, quality
  FROM samples),
coded AS (
  SELECT * FROM (SELECT * REPLACE (CAST({LABEL_CODE} AS INTEGER) AS quality) FROM typed)
  WHERE quality IS NOT NULL)
"""
CLEANED = f"""{SAMPLES},
cleaned AS (
  SELECT * FROM (
    SELECT TRY_CAST(size AS DOUBLE) AS size, weight, sweetness, acidity,
           CAST({LABEL_CODE} AS INTEGER) AS quality
    FROM (SELECT DISTINCT * FROM samples_dup
          WHERE size IS NOT NULL AND weight IS NOT NULL AND sweetness IS NOT NULL
            AND acidity IS NOT NULL AND quality IS NOT NULL))
  WHERE quality IS NOT NULL AND size IS NOT NULL)
"""
LEARN = """
learn AS (
  SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS rec_id,
         l_quantity, l_extendedprice, l_discount, l_tax,
         CAST(p_size AS DOUBLE) AS p_size, p_retailprice,
         CAST(l_extendedprice / l_quantity * (1 - l_discount) > 2400 AS INTEGER) AS quality
  FROM lineitem JOIN part ON l_partkey = p_partkey)
"""
FEATURES = ("size", "weight", "sweetness", "acidity")
LEARN_FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "p_size", "p_retailprice")


def union_each(names, template: str) -> str:
    return "\nUNION ALL\n".join(template.format(c=c) for c in names)


def long_table(source: str, names, keep: str = "") -> str:
    return union_each(names, f"SELECT {keep}'{{c}}' AS feature, {{c}} AS value FROM {source}")


CORR = f"""{CLEANED},
corr_rows AS (
  SELECT feature, corr(value, quality) AS r FROM ({long_table('cleaned', FEATURES, 'quality, ')})
  WHERE value IS NOT NULL GROUP BY feature)
"""
LEARN_CORR = f"""{LEARN},
learn_corr AS (
  SELECT feature, corr(value, quality) AS r FROM ({long_table('learn', LEARN_FEATURES, 'quality, ')})
  GROUP BY feature)
"""
PROFILE = f"""
stats AS (
  SELECT feature, avg(value) AS mean, stddev_pop(value) AS std,
         avg(value) FILTER (quality = 1) AS high, avg(value) FILTER (quality = 0) AS low
  FROM ({long_table('learn', LEARN_FEATURES, 'quality, ')}) GROUP BY feature),
scaled AS (
  SELECT feature, ((high - mean) / coalesce(nullif(std, 0), 1) + 3) / 6 * 10 AS high_quality,
         ((low - mean) / coalesce(nullif(std, 0), 1) + 3) / 6 * 10 AS low_quality
  FROM stats),
profile AS (SELECT *, high_quality - low_quality AS difference FROM scaled)
"""
HIST = f"""{TYPED},
long_rows AS ({long_table('coded', FEATURES, 'quality AS label, ')}),
limits AS (
  SELECT feature, min(value) AS lo, max(value) AS hi,
         CASE WHEN max(value) > min(value) THEN (max(value) - min(value)) / 20 ELSE 1.0 END AS width
  FROM long_rows WHERE value IS NOT NULL GROUP BY feature),
binned AS (
  SELECT feature, label, CAST(least(floor((value - lo) / width), 19) AS INTEGER) AS bin, lo, width,
         count(*) AS n
  FROM long_rows JOIN limits USING (feature) WHERE value IS NOT NULL GROUP BY ALL)
"""


def _corr_pair(a: str, b: str) -> str:
    return (
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS r FROM coded"
    )


def bounds(n: int, features=FEATURES) -> str:
    """CTE chain of the sequential outlier rule: step n filters on the bounds of column n."""
    parts = []
    for i, c in enumerate(features):
        parts.append(f"""
q{i} AS (SELECT quantile_cont({c}, 0.25) AS a, quantile_cont({c}, 0.75) AS b FROM rows{i}),
rows{i + 1} AS (
  SELECT rows{i}.* FROM rows{i} JOIN q{i}
    ON {c} >= a - 1.5 * (b - a) AND {c} <= b + 1.5 * (b - a))""")
    return ",".join(parts[:n])


def pick_order(seed: int, key: str) -> str:
    return f"substr(md5('{seed}:' || {key}), 1, 13), {key}"


DATED = "SELECT * REPLACE (strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate) FROM orders"
ORDERS_FILTER = "o_orderstatus = 'F' AND o_totalprice >= 50000 AND o_totalprice <= 300000"
REPORT_KEY = """
keys AS (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 31 = 0 THEN 'draft_' || strftime(o_orderdate, '%Y-%m-%d') || '_x'
         WHEN o_orderkey % 37 = 0 THEN strftime(o_orderdate, '%Y-%m-%d')
         ELSE strftime(o_orderdate, '%Y-%m-%d') || '_' ||
              lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || '-' ||
              lpad(CAST(o_custkey % 60 AS VARCHAR), 2, '0') || '_model_' || o_orderstatus END AS key
  FROM orders),
parsed AS (
  SELECT *, CASE WHEN len(string_split(key, '_')) >= 3 THEN try_strptime(
      string_split(key, '_')[1] || ' ' || replace(string_split(key, '_')[2], '-', ':'),
      '%Y-%m-%d %H:%M') END AS stamp
  FROM keys)
"""
_REPORT_METRIC = """
SELECT '{c}' AS class, unnest(['precision', 'recall', 'f1', 'support']) AS metric,
       unnest([p{c}, r{c}, f{c}, l{c}]) AS value FROM scores"""

ORACLES = {
    "scan_raw": DATED,
    "scan_query": """SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total_price
        FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 1000 GROUP BY 1""",
    "lookup": f"{DATED} WHERE o_orderkey = 77",
    "list_rows": f"{DATED} WHERE {ORDERS_FILTER} ORDER BY o_orderkey LIMIT 20 OFFSET 40",
    "list_info": f"""SELECT count(*) AS total, CAST(20 AS INTEGER) AS limit,
        CAST(40 AS INTEGER) AS offset, 60 < count(*) AS has_more FROM orders WHERE {ORDERS_FILTER}""",
    "limit_rows": f"{DATED} ORDER BY o_orderkey LIMIT 75",
    "page_rows": f"""{DATED} ORDER BY o_orderkey LIMIT 10
        OFFSET (SELECT 10 * (CAST(ceil(count(*) / 10.0) AS BIGINT) - 1) FROM orders)""",
    "page_rows_by_text": f"WITH {SAMPLES} SELECT * FROM samples ORDER BY rec_id LIMIT 10 OFFSET 1990",
    "page_rows_ties": f"""{DATED} ORDER BY o_custkey, o_orderkey, o_orderstatus, o_totalprice, orders.o_orderdate, o_orderpriority
        LIMIT 7 OFFSET 224""",
    "page_info": """SELECT count(*) AS total, CAST(10 AS INTEGER) AS per_page,
        CAST(greatest(ceil(count(*) / 10.0), 1) AS BIGINT) AS pages,
        CAST(greatest(ceil(count(*) / 10.0), 1) AS BIGINT) AS page FROM orders""",
    "chart_flags": f"""WITH {TYPED} SELECT count(*) AS total, true AS has_label,
        true AS has_numeric_features, true AS has_numeric_pair FROM typed""",
    "row_count": """SELECT count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS matching
        FROM orders""",
    "update_probe": """SELECT count(*) AS total, coalesce(max(o_orderkey), 0) AS max_id,
        coalesce(max(o_orderkey), 0) > 100 AS has_updates,
        CAST(greatest(coalesce(max(o_orderkey), 0) - 100, 0) AS BIGINT) AS new_records,
        count(*) FILTER (o_orderkey > 100) AS rows_after FROM orders""",
    "table_summary": """SELECT count(*) AS total, CAST(6 AS INTEGER) AS n_columns,
        'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' AS columns
        FROM orders""",
    "sample_rows": f"{DATED} ORDER BY o_orderkey LIMIT 5",
    "drop_nulls": f"""WITH {SAMPLES} SELECT * FROM samples WHERE size IS NOT NULL
        AND weight IS NOT NULL AND sweetness IS NOT NULL AND acidity IS NOT NULL
        AND quality IS NOT NULL""",
    "drop_duplicates": f"WITH {SAMPLES} SELECT DISTINCT * FROM samples_dup",
    "coerce_numeric": f"WITH {TYPED} SELECT * FROM typed",
    "map_labels": f"WITH {TYPED} SELECT rec_id, quality FROM coded",
    "clean": f"WITH {CLEANED} SELECT * FROM cleaned",
    "default_features": f"""WITH {TYPED} SELECT rec_id, coalesce(size, 0.0::DOUBLE) AS size,
        coalesce(weight, 0.0::DOUBLE) AS weight, coalesce(sweetness, 0.0::DOUBLE) AS sweetness,
        coalesce(acidity, 0.0::DOUBLE) AS acidity FROM typed""",
    "remove_outliers": f"""WITH {TYPED},
        rows0 AS (SELECT * FROM coded WHERE size IS NOT NULL AND sweetness IS NOT NULL),
        {bounds(4)} SELECT * FROM rows4""",
    "remove_outliers_text": f"""WITH {TYPED},
        rows0 AS (SELECT * FROM coded WHERE size IS NOT NULL AND sweetness IS NOT NULL),
        {bounds(3)} SELECT * REPLACE ('t' || CAST(acidity AS VARCHAR) AS acidity) FROM rows3""",
    "missing_values": f"WITH {TYPED} " + union_each(
        ("rec_id", *FEATURES, "quality"),
        "SELECT '{c}' AS feature, count(*) FILTER ({c} IS NULL) AS missing FROM typed"),
    "describe": f"WITH {TYPED} " + union_each(FEATURES, """
        SELECT '{c}' AS feature, count({c}) AS count, round(avg({c}), 6) AS mean,
          round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min,
          round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
          round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max FROM typed"""),
    "column_stats": f"WITH {TYPED} " + "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS feature, '{t}' AS dtype, {str(t == 'double').lower()} AS is_numeric,
          count(*) FILTER ({c} IS NULL) > 0 AS has_null,
          count(DISTINCT {c}) + CAST(count(*) FILTER ({c} IS NULL) > 0 AS BIGINT) AS distinct,
          {f'round(min({c}), 6)' if t == 'double' else 'CAST(NULL AS DOUBLE)'} AS min,
          {f'round(max({c}), 6)' if t == 'double' else 'CAST(NULL AS DOUBLE)'} AS max FROM typed"""
        for c, t in (("rec_id", "string"), *((f, "double") for f in FEATURES), ("quality", "string"))),
    "iqr_bounds": f"WITH {TYPED} " + union_each(FEATURES, """
        SELECT '{c}' AS feature, round(q1, 6) AS q1, round(q3, 6) AS q3,
          round(q1 - 1.5 * (q3 - q1), 6) AS lower, round(q3 + 1.5 * (q3 - q1), 6) AS upper
        FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM typed)"""),
    "class_counts": f"""WITH {CLEANED} SELECT quality AS label, count(*) AS n,
        CAST((SELECT count(*) FROM cleaned) AS BIGINT) AS total, CAST(4 AS INTEGER) AS n_features
        FROM cleaned GROUP BY quality""",
    "class_share": f"""WITH {CLEANED} SELECT quality AS label, count(*) AS n,
        round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM cleaned), 1) AS share
        FROM cleaned GROUP BY quality""",
    "class_balance": """WITH c AS (SELECT quality AS label, count(*) AS n FROM labels GROUP BY 1)
        SELECT count(*) AS n_classes, CAST(sum(n) AS BIGINT) AS total,
          (SELECT label FROM c ORDER BY n DESC, label LIMIT 1) AS majority, max(n) AS n_majority,
          (SELECT label FROM c ORDER BY n, label DESC LIMIT 1) AS minority, min(n) AS n_minority,
          round(min(n) / sum(n)::DOUBLE, 6) AS minority_ratio FROM c""",
    "histogram": f"""WITH {HIST} SELECT feature, label, bin, round(lo + bin * width, 6) AS bin_start,
        round(lo + bin * width + width, 6) AS bin_end, n,
        round(n / (sum(n) OVER (PARTITION BY feature, label) * width), 6) AS density FROM binned""",
    "top_bins": f"""WITH {HIST}, totals AS (
        SELECT feature, bin, CAST(sum(n) AS BIGINT) AS n FROM binned GROUP BY feature, bin)
        SELECT feature, bin, n, CAST(rank AS INTEGER) AS rank FROM (
          SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, bin) AS rank FROM totals)
        WHERE rank <= 3""",
    "label_correlation": f"WITH {CORR} SELECT feature, round(r, 6) AS r FROM corr_rows",
    "corr_matrix": f"WITH {TYPED} " + "\nUNION ALL\n".join(
        _corr_pair(a, b) for a in (*FEATURES, "quality") for b in (*FEATURES, "quality")),
    "standardize": f"""WITH {TYPED} SELECT rec_id, quality, """ + ", ".join(
        f"round(({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1), 6) AS {c}"
        for c in FEATURES) + " FROM coded",
    "class_profile": f"""WITH {LEARN}, {PROFILE}
        SELECT feature, round(high_quality, 6) AS high_quality, round(low_quality, 6) AS low_quality,
          round(difference, 6) AS difference,
          CASE WHEN difference > 0 THEN 'good_higher' WHEN difference < 0 THEN 'bad_higher'
               ELSE 'equal' END AS advantage,
          abs(difference) > 1 AS significant FROM profile""",
    "correlation_bands": f"""WITH {LEARN_CORR} SELECT feature, round(r, 6) AS r,
        CASE WHEN abs(r) >= 0.7 THEN 'strong' WHEN abs(r) >= 0.4 THEN 'medium' ELSE 'weak' END
          AS strength,
        CASE WHEN r > 0 THEN 'positive' WHEN r < 0 THEN 'negative' ELSE 'none' END AS direction,
        CASE WHEN abs(r) >= 0.3 THEN 'strong' WHEN abs(r) >= 0.15 THEN 'medium'
             WHEN abs(r) >= 0.05 THEN 'weak' ELSE 'very_weak' END AS documented_strength
        FROM learn_corr""",
    "correlation_rank": f"""WITH {LEARN_CORR} SELECT feature, round(r, 6) AS r FROM learn_corr
        ORDER BY abs(learn_corr.r) DESC, feature""",
    "correlation_extremes": f"""WITH {LEARN_CORR}
        SELECT arg_max(feature, r) FILTER (r > 0) AS strongest_positive,
          round(max(r) FILTER (r > 0), 6) AS strongest_positive_r,
          arg_min(feature, r) FILTER (r < 0) AS strongest_negative,
          round(min(r) FILTER (r < 0), 6) AS strongest_negative_r,
          arg_min(feature, abs(r)) AS weakest, round(arg_min(r, abs(r)), 6) AS weakest_r
        FROM learn_corr""",
    "feature_importance": f"""WITH {LEARN_CORR}, {PROFILE}
        SELECT feature, round(r, 6) AS r, round(difference, 6) AS difference,
          round(abs(r) * abs(difference), 6) AS score,
          CASE WHEN abs(r) >= 0.3 AND abs(difference) >= 1 THEN 'control'
               WHEN abs(r) >= 0.15 AND abs(r) < 0.3 THEN 'secondary' ELSE 'other' END AS role
        FROM learn_corr JOIN profile USING (feature)
        ORDER BY abs(learn_corr.r) * abs(profile.difference) DESC, feature LIMIT 5""",
    "balance_classes": f"""WITH n AS (
          SELECT count(*) FILTER (quality = 0) AS small, count(*) FILTER (quality = 1) AS big FROM labels),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY quality
            ORDER BY {pick_order(42, 'CAST(doc_id AS VARCHAR)')}) AS rn FROM labels)
        SELECT doc_id, quality, toxic FROM ranked, n
        WHERE quality = 0
           OR rn <= CAST(floor(small::DOUBLE * (1 - 0.4::DOUBLE) / 0.4::DOUBLE) AS BIGINT)""",
    "stratified_split": f"""WITH {TYPED},
        sizes AS (SELECT quality, count(*) AS n, sum(count(*)) OVER () AS total FROM coded GROUP BY 1),
        shares AS (SELECT quality, n * ceil(total * 0.3::DOUBLE) / total AS share,
            ceil(total * 0.3::DOUBLE) AS n_test FROM sizes),
        takes AS (SELECT quality, floor(share) + CASE WHEN row_number() OVER (
              ORDER BY share - floor(share) DESC, quality)
              <= n_test - sum(floor(share)) OVER () THEN 1 ELSE 0 END AS k FROM shares)
        SELECT rec_id, quality, row_number() OVER (PARTITION BY quality
            ORDER BY {pick_order(42, 'rec_id')}) <= k AS is_test
        FROM coded JOIN takes USING (quality)""",
    "accuracy": f"""WITH {LEARN} SELECT count(*) AS n,
        round(avg(CAST(quality = CAST(l_discount < 0.05 AS INTEGER) AS DOUBLE)), 6) AS accuracy
        FROM learn""",
    "class_report": f"""WITH {LEARN},
        preds AS (SELECT quality AS y, CAST(l_discount < 0.05 AS INTEGER) AS p FROM learn),
        c AS (SELECT count(*)::DOUBLE AS total,
          count(*) FILTER (y = 0 AND p = 0)::DOUBLE AS h0, count(*) FILTER (y = 0)::DOUBLE AS l0,
          count(*) FILTER (p = 0)::DOUBLE AS q0,
          count(*) FILTER (y = 1 AND p = 1)::DOUBLE AS h1, count(*) FILTER (y = 1)::DOUBLE AS l1,
          count(*) FILTER (p = 1)::DOUBLE AS q1 FROM preds),
        pr AS (SELECT *, coalesce(h0 / nullif(q0, 0), 0) AS p0, coalesce(h0 / nullif(l0, 0), 0) AS r0,
          coalesce(h1 / nullif(q1, 0), 0) AS p1, coalesce(h1 / nullif(l1, 0), 0) AS r1 FROM c),
        scores AS (SELECT *, coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) AS f0,
          coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) AS f1 FROM pr),
        report AS ({_REPORT_METRIC.format(c=0)} UNION ALL {_REPORT_METRIC.format(c=1)}
          UNION ALL SELECT 'macro avg', unnest(['precision', 'recall', 'f1', 'support']),
            unnest([(p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, total]) FROM scores
          UNION ALL SELECT 'weighted avg', unnest(['precision', 'recall', 'f1', 'support']),
            unnest([(p0 * l0 + p1 * l1) / total, (r0 * l0 + r1 * l1) / total,
                    (f0 * l0 + f1 * l1) / total, total]) FROM scores
          UNION ALL SELECT 'all', 'accuracy', (h0 + h1) / total FROM scores)
        SELECT class, metric, round(value, 6) AS value FROM report""",
    "strip_control": """SELECT doc_id, regexp_replace(text || chr(7) || chr(9) || chr(11) || chr(127)
        || ' end', '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]', '', 'g') AS text FROM documents""",
    "safe_name": """SELECT page_id, substr(regexp_replace(regexp_replace(url,
        '[<>:"/\\\\|?*]', '_', 'g'), '\\s+', '_', 'g'), 1, 50) AS name FROM pages""",
    "parse_report_key": f"""WITH {REPORT_KEY} SELECT o_orderkey,
        strftime(stamp, '%Y-%m-%d %H:%M') AS report_time,
        CASE WHEN stamp IS NULL THEN 'unknown'
             ELSE array_to_string(string_split(key, '_')[3:], ' ') END AS name FROM parsed""",
    "mask_secret": """WITH s AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN ''
          WHEN doc_id % 5 = 0 THEN substr(source, 1, 4)
          ELSE source || CAST(doc_id AS VARCHAR) || 'key' END AS secret FROM documents)
        SELECT doc_id, CASE WHEN coalesce(length(secret), 0) = 0 THEN ''
          WHEN length(secret) > 5 THEN repeat('*', 10) || right(secret, 5)
          ELSE '*****' END AS secret_preview FROM s""",
}
