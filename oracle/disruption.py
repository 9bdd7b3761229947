"""Oracle SQL for supplier features, scaling, cluster scores, density clusters and ranks."""

from __future__ import annotations

from oracle.base import oracle

NAMES = ["average_lead_time", "lead_time_std", "on_time_percentage", "defect_percentage",
         "fill_percentage", "supplier_delay_rate", "demand_mean", "demand_std", "demand_cv",
         "stockout_rate"]

FEATURES = """features AS (
  SELECT supplier, CAST(SUM(lead_time_days) AS DOUBLE) / COUNT(*) AS average_lead_time,
         COALESCE(STDDEV_SAMP(CAST(lead_time_days AS DOUBLE)), 0) AS lead_time_std,
         ROUND(AVG(on_time_rate), 12) * 100 AS on_time_percentage,
         ROUND(AVG(defect_rate), 12) * 100 AS defect_percentage,
         SUM(supplier_delay) AS total_delays,
         CAST(SUM(supplier_delay) AS DOUBLE) / COUNT(*) * 100 AS supplier_delay_rate,
         SUM(ordered_qty) AS total_ordered, SUM(received_qty) AS total_received,
         CAST(SUM(demand) AS DOUBLE) / COUNT(*) AS demand_mean,
         COALESCE(STDDEV_SAMP(CAST(demand AS DOUBLE)), 0) AS demand_std,
         CAST(SUM(stockout) AS DOUBLE) / COUNT(*) * 100 AS stockout_rate,
         COUNT(*) AS observations,
         COALESCE(CAST(SUM(received_qty) AS DOUBLE) / NULLIF(SUM(ordered_qty), 0), 0) * 100
           AS fill_percentage,
         COALESCE(COALESCE(STDDEV_SAMP(CAST(demand AS DOUBLE)), 0)
                  / NULLIF(CAST(SUM(demand) AS DOUBLE) / COUNT(*), 0), 0) AS demand_cv
  FROM fact GROUP BY supplier)"""
SCALED = FEATURES + """,
scaled AS (SELECT supplier, """ + ", ".join(
    f"COALESCE(({c} - AVG({c}) OVER ()) / NULLIF(STDDEV_POP({c}) OVER (), 0), 0) AS {c}"
    for c in NAMES) + " FROM features)"
VECTORS = SCALED + f""",
points AS (SELECT supplier AS entity, [{', '.join(NAMES)}] AS vec FROM scaled)"""

# Deterministic labelings: three groups along one scaled feature each.
BY_FEATURE = {"average_lead_time": 1, "on_time_percentage": 3, "fill_percentage": 5,
              "demand_mean": 7}
LABELLED = VECTORS + ",\nlabelled AS (" + " UNION ALL ".join(
    f"SELECT '{name}' AS run, entity, vec, CASE WHEN vec[{i}] < -0.5 THEN 0 "
    f"WHEN vec[{i}] < 0.5 THEN 1 ELSE 2 END AS label FROM points"
    for name, i in BY_FEATURE.items()) + """),
shape AS (SELECT run, COUNT(*) AS n, COUNT(DISTINCT label) AS k FROM labelled GROUP BY run)"""

SILHOUETTE = """toward AS (
  SELECT a.run, a.entity, a.label, b.label AS other, SUM(LIST_DISTANCE(a.vec, b.vec)) AS total,
         COUNT(*) AS n
  FROM labelled a JOIN labelled b ON a.run = b.run GROUP BY 1, 2, 3, 4),
widths AS (
  SELECT run, entity, MAX(n) FILTER (WHERE label = other) AS mates,
         MAX(total) FILTER (WHERE label = other)
           / NULLIF(MAX(n) FILTER (WHERE label = other) - 1, 0) AS a,
         MIN(total / n) FILTER (WHERE label <> other) AS b
  FROM toward GROUP BY 1, 2),
silhouettes AS (
  SELECT run, CASE WHEN k >= 2 AND shape.n > k THEN s END AS silhouette
  FROM (SELECT run, AVG(CASE WHEN mates = 1 THEN 0
                             ELSE COALESCE((b - a) / NULLIF(GREATEST(a, b), 0), 0) END) AS s
        FROM widths GROUP BY run) JOIN shape USING (run))"""
CENTERS = """parts AS (
  SELECT run, label, entity, UNNEST(vec) AS x, UNNEST(RANGE(1, 11)) AS axis FROM labelled),
axes AS (SELECT run, label, axis, AVG(x) AS c, COUNT(*) AS size FROM parts GROUP BY 1, 2, 3),
centers AS (
  SELECT run, label, LIST(c ORDER BY axis) AS center, MAX(size) AS size FROM axes GROUP BY 1, 2)"""
DAVIES = """spreads AS (
  SELECT l.run, l.label, ANY_VALUE(center) AS center, AVG(LIST_DISTANCE(vec, center)) AS spread
  FROM labelled l JOIN centers c ON c.run = l.run AND c.label = l.label GROUP BY 1, 2),
davies AS (
  SELECT run, CASE WHEN k >= 2 AND n > k THEN s END AS davies_bouldin
  FROM (SELECT run, AVG(worst) AS s FROM (
          SELECT a.run, a.label, MAX(CASE WHEN LIST_DISTANCE(a.center, b.center) > 0
                   THEN (a.spread + b.spread) / LIST_DISTANCE(a.center, b.center) ELSE 0 END)
                   AS worst
          FROM spreads a JOIN spreads b ON a.run = b.run AND a.label <> b.label GROUP BY 1, 2)
        GROUP BY run) JOIN shape USING (run))"""
CALINSKI = """middles AS (SELECT run, axis, AVG(x) AS m FROM parts GROUP BY 1, 2),
apart AS (
  SELECT a.run, SUM(a.size * (a.c - m.m) * (a.c - m.m)) AS between_ss
  FROM axes a JOIN middles m ON m.run = a.run AND m.axis = a.axis GROUP BY 1),
inside AS (
  SELECT p.run, SUM((p.x - a.c) * (p.x - a.c)) AS within_ss
  FROM parts p JOIN axes a ON a.run = p.run AND a.label = p.label AND a.axis = p.axis GROUP BY 1),
calinski AS (
  SELECT run, CASE WHEN k >= 2 AND n > k THEN CASE WHEN within_ss = 0 THEN 1.0
           ELSE between_ss * (n - k) / (within_ss * (k - 1)) END END AS calinski_harabasz
  FROM apart JOIN inside USING (run) JOIN shape USING (run))"""
SCORES = ",\n".join([LABELLED, SILHOUETTE, CENTERS, DAVIES, CALINSKI])


def ranked(column: str, name: str) -> str:
    """Average-tie percentile rank as a window expression."""
    return (f"(RANK() OVER (ORDER BY {column}) + (COUNT(*) OVER (PARTITION BY {column}) - 1) "
            f"/ 2.0) / COUNT(*) OVER () AS {name}")


CHOICE = SCORES + f""",
results AS (
  SELECT 'Hierarchical' AS model, 'feature=' || run AS parameters, k AS clusters, silhouette,
         davies_bouldin, calinski_harabasz
  FROM silhouettes JOIN davies USING (run) JOIN calinski USING (run) JOIN shape USING (run)),
valid AS (SELECT * FROM results WHERE silhouette IS NOT NULL),
summed AS (
  SELECT *, r1 + r2 + r3 AS rank_score FROM (
    SELECT *, {ranked('-silhouette', 'r1')}, {ranked('davies_bouldin', 'r2')},
           {ranked('-calinski_harabasz', 'r3')} FROM valid))"""

DBSCAN = VECTORS + """,
radii AS (SELECT UNNEST([0.5, 0.75, 1.0, 1.25, 1.5]) AS eps),
needed AS (SELECT GREATEST(3, LEAST(5, COUNT(*) // 4)) AS m FROM points),
close AS (
  SELECT eps, a.entity AS a, b.entity AS b
  FROM radii, points a, points b WHERE LIST_DISTANCE(a.vec, b.vec) <= eps),
cores AS (
  SELECT eps, a AS entity FROM close GROUP BY 1, 2 HAVING COUNT(*) >= (SELECT m FROM needed)),
links AS (
  SELECT c.eps, c.a, c.b FROM close c
  JOIN cores x ON x.eps = c.eps AND x.entity = c.a JOIN cores y ON y.eps = c.eps AND y.entity = c.b),
roots AS (
  SELECT eps, a AS entity, MIN(b) AS root FROM reach GROUP BY 1, 2),
placed AS (
  SELECT eps, entity, root FROM roots
  UNION ALL
  SELECT c.eps, c.a, MIN(r.root) FROM close c JOIN roots r ON r.eps = c.eps AND r.entity = c.b
  WHERE NOT EXISTS (SELECT 1 FROM cores k WHERE k.eps = c.eps AND k.entity = c.a) GROUP BY 1, 2),
numbered AS (
  SELECT eps, entity, DENSE_RANK() OVER (PARTITION BY eps ORDER BY root) - 1 AS label
  FROM placed)"""
REACH = """reach AS (
  SELECT eps, a, b FROM links
  UNION SELECT r.eps, r.a, l.b FROM reach r JOIN links l ON l.eps = r.eps AND l.a = r.b)"""
DBSCAN = DBSCAN.replace("roots AS (", REACH + ",\nroots AS (", 1)

SCORED = FEATURES + f""",
ranks AS (
  SELECT *, {ranked('stockout_rate', 'r_a')}, {ranked('average_lead_time', 'r_l')},
         {ranked('100 - on_time_percentage', 'r_t')}, {ranked('100 - fill_percentage', 'r_f')},
         {ranked('defect_percentage', 'r_d')} FROM features),
combined AS (
  SELECT *, ROUND(0.4 * r_a * 100 + 0.2 * r_l * 100 + 0.15 * r_t * 100 + 0.15 * r_f * 100
                  + 0.1 * r_d * 100 + 1e-9, 2) AS disruption_score FROM ranks),
leveled AS (
  SELECT *, CASE WHEN disruption_score > 80 THEN 'CRITICAL' WHEN disruption_score > 60 THEN 'HIGH'
                 WHEN disruption_score > 40 THEN 'MEDIUM' ELSE 'LOW' END AS disruption_level
  FROM combined)"""

FEATURE_COLUMNS = ("supplier total_delays:b total_ordered:b total_received:b observations:b "
                   + " ".join(f"{c}:d" for c in NAMES))

ORACLES = {
    "supplier_features": oracle(FEATURE_COLUMNS, "SELECT * FROM features", FEATURES),
    "scale_features": oracle("supplier " + " ".join(f"{c}:d" for c in NAMES),
                             "SELECT * FROM scaled", SCALED),
    "silhouette": oracle("run silhouette:d", "SELECT * FROM silhouettes",
                         f"{LABELLED},\n{SILHOUETTE}"),
    "davies_bouldin": oracle("run davies_bouldin:d", "SELECT * FROM davies",
                             f"{LABELLED},\n{CENTERS},\n{DAVIES}"),
    "calinski_harabasz": oracle("run calinski_harabasz:d", "SELECT * FROM calinski",
                                f"{LABELLED},\n{CENTERS},\n{CALINSKI}"),
    "dbscan_clusters": oracle(
        "run entity label:i",
        """SELECT 'eps=' || CAST(eps AS VARCHAR) AS run, p.entity,
                  COALESCE((SELECT MAX(label) FROM numbered n
                            WHERE n.eps = r.eps AND n.entity = p.entity), -1) AS label
           FROM (SELECT CAST(eps AS DOUBLE) AS eps FROM radii) r, points p""",
        DBSCAN).replace("WITH ", "WITH RECURSIVE ", 1),
    "choose_best": oracle(
        "choice_order model parameter:d rank_score:d",
        """SELECT 'best' AS choice_order, model, clusters AS parameter, rank_score
           FROM (SELECT * FROM summed ORDER BY rank_score, model, parameters LIMIT 1)
           UNION ALL
           SELECT 'reference', model, clusters, rank_score
           FROM (SELECT * FROM summed ORDER BY rank_score DESC, model, parameters LIMIT 1)""",
        CHOICE),
    "pct_rank": oracle(
        "store product stockout_days:b stockout_days_pct_rank:d",
        f"SELECT *, {ranked('stockout_days', 'stockout_days_pct_rank')} FROM pairs",
        "pairs AS (SELECT store, product, SUM(stockout) AS stockout_days FROM fact GROUP BY 1, 2)"),
    "disruption_score": oracle(f"{FEATURE_COLUMNS} disruption_score:d disruption_level",
                               "SELECT * FROM leveled", SCORED),
}
