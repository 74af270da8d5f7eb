"""DuckDB twins of the model queries that SQL can express."""

from __future__ import annotations

from gradeline.plans.table_oracles import LEARN, LEARN_FEATURES, bounds, pick_order


def split_ctes(source: str, label: str, key: str) -> str:
    """``{source}_split``: the rows with is_test, the same share of every class."""
    return f"""
{source}_sizes AS (
  SELECT {label}, count(*) AS n, sum(count(*)) OVER () AS total FROM {source} GROUP BY 1),
{source}_shares AS (
  SELECT {label}, n * ceil(total * 0.3::DOUBLE) / total AS share,
         ceil(total * 0.3::DOUBLE) AS n_test FROM {source}_sizes),
{source}_takes AS (
  SELECT {label}, floor(share) + CASE WHEN row_number() OVER (
      ORDER BY share - floor(share) DESC, {label})
      <= n_test - sum(floor(share)) OVER () THEN 1 ELSE 0 END AS k FROM {source}_shares),
{source}_split AS (
  SELECT {source}.*, row_number() OVER (PARTITION BY {source}.{label}
      ORDER BY {pick_order(42, key)}) <= k AS is_test
  FROM {source} JOIN {source}_takes USING ({label}))
"""


def _per_feature(template: str, join: str) -> str:
    return join.join(template.format(c=c) for c in LEARN_FEATURES)


# The training flow: no outliers, the larger of two classes thinned where the other has less than 0.4, then the split.
TRAINING = f"""{LEARN},
rows0 AS (SELECT * FROM learn),{bounds(6, LEARN_FEATURES)},
class_sizes AS (SELECT quality, count(*) AS n, sum(count(*)) OVER () AS total,
                row_number() OVER (ORDER BY count(*), quality DESC) AS size_rank FROM rows6 GROUP BY quality),
smallest AS (SELECT n AS small, n::DOUBLE / total < 0.4::DOUBLE AS thin,
             CAST(floor(n::DOUBLE * (1 - 0.4::DOUBLE) / 0.4::DOUBLE) AS BIGINT) AS needed
             FROM class_sizes WHERE size_rank = 1),
drawn AS (SELECT rows6.*, size_rank, row_number() OVER (PARTITION BY quality
            ORDER BY {pick_order(42, 'rec_id')}) AS rn FROM rows6 JOIN class_sizes USING (quality)),
train_rows AS (SELECT drawn.* EXCLUDE (size_rank, rn) FROM drawn, smallest
               WHERE NOT thin OR size_rank = 1 OR rn <= needed),
{split_ctes('train_rows', 'quality', 'rec_id')}"""
GAUSS = f"""{TRAINING},
moments AS (SELECT {_per_feature('avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}', ', ')}
            FROM train_rows_split WHERE NOT is_test),
z AS (SELECT rec_id, quality, is_test, {_per_feature('({c} - m_{c}) / s_{c} AS {c}', ', ')}
      FROM train_rows_split, moments),
boost AS (SELECT 1e-9 * greatest({_per_feature('var_pop({c})', ', ')}) AS e FROM z WHERE NOT is_test),
fit AS (SELECT quality AS cls, ln(count(*) / sum(count(*)) OVER ()) AS prior,
          {_per_feature('avg({c}) AS m_{c}, var_pop({c}) + (SELECT e FROM boost) AS v_{c}', ', ')}
        FROM z WHERE NOT is_test GROUP BY quality),
logs AS (SELECT rec_id, z.quality, cls, prior - 0.5 * (
          {_per_feature('ln(2 * pi() * v_{c}) + ({c} - m_{c}) * ({c} - m_{c}) / v_{c}', ' + ')}) AS ll
         FROM z, fit WHERE is_test)
"""



def _likelihood(cls: int) -> str:
    """Log-likelihood of class ``cls`` for a scaled row, from the fitted row named ``f{cls}``."""
    terms = _per_feature(
        f"ln(2 * pi() * f{cls}.v_{{c}}) + (x.{{c}} - f{cls}.m_{{c}}) * (x.{{c}} - f{cls}.m_{{c}}) / f{cls}.v_{{c}}", " + "
    )
    return f"f{cls}.prior - 0.5 * ({terms})"


N_WEIGHTS = len(LEARN_FEATURES) + 1
NEWTON_STEPS = 25


def _eliminated(source: str) -> str:
    """The system ``m`` of ``source`` (matrix and right side) solved by elimination, one subquery per pivot."""
    for k in range(1, N_WEIGHTS + 1):
        source = f"""(SELECT it, w, list_transform(m, lambda r, i: CASE WHEN i = {k} THEN list_transform(r, lambda v: v / r[{k}])
            ELSE list_transform(r, lambda v, j: v - r[{k}] * m[{k}][j] / m[{k}][{k}]) END) AS m FROM {source} AS s{k})"""
    return source


def _system() -> str:
    """Second derivatives and gradient of the logistic loss with a ridge of 1 on all weights but the intercept."""
    rows = []
    for i in range(1, N_WEIGHTS + 1):
        ridge = 0.0 if i == 1 else 1.0
        second = [f"sum(p * (1 - p) * x[{i}] * x[{j}])" + (f" + {ridge}" if i == j else "") for j in range(1, N_WEIGHTS + 1)]
        rows.append(f"[{', '.join(second)}, sum((p - y) * x[{i}]) + {ridge} * any_value(w)[{i}]]")
    return f"[{', '.join(rows)}]"


# Newton's method on the scaled training rows: the optimum of the penalised loss, then the predictions of the test rows.
LOGISTIC = f"""{GAUSS},
points AS MATERIALIZED (
  SELECT rec_id, quality, quality::DOUBLE AS y, is_test, [1.0::DOUBLE, {_per_feature('{c}', ', ')}] AS x FROM z),
newton AS (
  SELECT 0 AS it, {[0.0] * N_WEIGHTS}::DOUBLE[] AS w
  UNION ALL
  SELECT it + 1, list_transform(w, lambda v, i: v - m[i][{N_WEIGHTS + 1}]) FROM {_eliminated(f"""(
    SELECT it, any_value(w) AS w, {_system()} AS m FROM (
      SELECT it, w, x, y, 1 / (1 + exp(-list_dot_product(w, x))) AS p FROM newton, points
      WHERE it < {NEWTON_STEPS} AND NOT is_test) GROUP BY it)""")}),
logistic AS (
  SELECT rec_id, quality, CAST(list_dot_product(w, x) > 0 AS INTEGER) AS prediction
  FROM points, newton WHERE is_test AND it = {NEWTON_STEPS})
"""
BAYES = ", bayes AS (SELECT rec_id, quality, CAST(arg_max(cls, ll) AS INTEGER) AS prediction FROM logs GROUP BY rec_id, quality)"


# The five nearest training rows of each test row (keys may repeat), on the scaled features; five votes of two classes have no tie.
NEAREST = f"""{BAYES},
numbered AS MATERIALIZED (SELECT *, row_number() OVER () AS row_no FROM z),
voted AS (
  SELECT q.row_no, min_by(t.quality, {_per_feature('(q.{c} - t.{c}) * (q.{c} - t.{c})', ' + ')}, 5) AS votes
  FROM numbered q, numbered t WHERE q.is_test AND NOT t.is_test GROUP BY q.row_no),
nearest AS (SELECT rec_id, quality, CAST(list_sum(votes) > 2 AS INTEGER) AS prediction FROM voted JOIN numbered USING (row_no))"""


def _above_floor(model: str) -> str:
    """A model that is at least as good as naive Bayes reaches as many right rows."""
    return f"""WITH {GAUSS}{BAYES}
        SELECT '{model}' AS model, count(*) AS n_test, count(*) FILTER (prediction = quality) AS floor_hits,
          count(*) FILTER (prediction = quality) AS counted_hits FROM bayes"""


ORACLES = {
    "logistic_regression": f"WITH RECURSIVE {LOGISTIC} SELECT * FROM logistic",
    **{name: _above_floor(model) for name, model in (
        ("mlp", "neural_network"), ("random_forest", "random_forest"), ("bagging", "bagging"))},
    "model_ranking": f"""WITH RECURSIVE {LOGISTIC}{NEAREST},
        hits AS (
          SELECT 'logistic_regression' AS model, count(*) AS n, count(*) FILTER (prediction = quality) AS right_rows FROM logistic
          UNION ALL
          SELECT 'knn', count(*), count(*) FILTER (prediction = quality) FROM nearest
          UNION ALL
          SELECT unnest(['naive_bayes', 'neural_network', 'random_forest', 'bagging']), count(*),
            count(*) FILTER (prediction = quality) FROM bayes)
        SELECT model, n, round(right_rows / n, 6) AS accuracy_shown,
          CAST(rank() OVER (ORDER BY right_rows DESC) AS INTEGER) AS place FROM hits""",
    "score": f"""WITH {GAUSS},
        scaled AS (SELECT rec_id, {_per_feature('learn.{c}', ', ')},
            {_per_feature('({c} - m_{c}) / s_{c} AS z_{c}', ', ')} FROM learn, moments),
        judged AS (SELECT scaled.rec_id, {_per_feature('scaled.{c}', ', ')},
            CASE WHEN {_likelihood(1).replace('x.', 'scaled.z_')} > {_likelihood(0).replace('x.', 'scaled.z_')}
            THEN 1 ELSE 0 END AS prediction
          FROM scaled, fit AS f0, fit AS f1 WHERE f0.cls = 0 AND f1.cls = 1)
        SELECT * REPLACE (CAST(p_size AS INTEGER) AS p_size),
          CASE prediction WHEN 1 THEN 'good' ELSE 'bad' END AS class_name FROM judged""",
    "gaussian_nb": f"WITH {GAUSS}{BAYES} SELECT * FROM bayes",
    "knn_classify": f"""WITH vecs AS (
          SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS features FROM embeddings),
        {split_ctes('vecs', 'label', 'CAST(vec_id AS VARCHAR)')},
        near AS (
          SELECT q.vec_id, q.label AS own, t.label, list_distance(q.features, t.features) AS d,
            row_number() OVER (PARTITION BY q.vec_id
              ORDER BY list_distance(q.features, t.features), t.vec_id) AS rn
          FROM vecs_split q JOIN vecs_split t ON q.is_test AND NOT t.is_test),
        votes AS (SELECT vec_id, own, label, count(*) AS n, min(d) AS d FROM near
          WHERE rn <= 5 GROUP BY ALL)
        SELECT vec_id, own AS label,
          arg_max(label, n * 1000 - label) AS prediction, round(min(d), 6) AS nearest
        FROM votes GROUP BY vec_id, own""",
}
