"""Queries for k-nearest neighbours (M03) and SMOTE (B01) on `embeddings`.

The embeddings are split 80/20 per label with the same md5 order as the
fixture split; test rows query the training rows. The DuckDB twins
compute every test x train distance by brute force.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.operators import eda, neighbors, prep
from cohortlens.plans.registry import query
from cohortlens.sources.tables import load_table

EMB_SPLIT = """es AS (
  SELECT vec_id, label, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY md5(CAST(vec_id AS VARCHAR) || '|42'), vec_id)
    <= round(count(*) OVER (PARTITION BY label) * 0.2) THEN 'test' ELSE 'train' END AS split FROM embeddings),
ev AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x, unnest(range(len(embedding))) AS i FROM embeddings)"""


def _emb(spark, sf):
    return load_table(spark, sf, "embeddings")


def _emb_split(spark, sf):
    e = prep.stratified_split(_emb(spark, sf), "label", "vec_id")
    return prep.split_frames(e)


def _pairs_sql(k: int, metric: str) -> str:
    term = "abs(q.x - r.x)" if metric == "manhattan" else "(q.x - r.x) * (q.x - r.x)"
    dist = f"sum({term})" if metric == "manhattan" else f"sqrt(sum({term}))"
    return f"""WITH {EMB_SPLIT},
pairs AS (
  SELECT q.vec_id AS qid, r.vec_id AS rid, {dist} AS dist
  FROM ev q JOIN ev r ON q.i = r.i
  WHERE q.vec_id IN (SELECT vec_id FROM es WHERE split = 'test') AND r.vec_id IN (SELECT vec_id FROM es WHERE split = 'train')
  GROUP BY q.vec_id, r.vec_id),
nb AS (SELECT * FROM (SELECT qid, rid, dist, CAST(row_number() OVER (PARTITION BY qid ORDER BY dist, rid) AS INTEGER) AS rank
       FROM pairs) WHERE rank <= {k})"""


@query("knn_neighbors", _pairs_sql(5, "euclidean") + "\nSELECT * FROM nb", round_cols=["dist"], operators=["M03"])
def q_knn_neighbors(spark, sf):
    train, test = _emb_split(spark, sf)
    return neighbors.nearest_neighbors(test, train, 5, qid="vec_id", rid="vec_id", vec="embedding")


@query("knn_approximate_recall", operators=["M03"])
def q_knn_approximate_recall(spark, sf):
    """Approximate against exact neighbours of all test rows."""
    train, test = _emb_split(spark, sf)
    asked = dict(qid="vec_id", rid="vec_id", vec="embedding")
    found = neighbors.approximate_neighbors(test, train, 5, bucket_length=1.2, tables=4, **asked)
    return neighbors.recall(found, neighbors.nearest_neighbors(test, train, 5, **asked))


def _vote_sql(k: int, metric: str, weights: str) -> str:
    if weights == "uniform":
        w = "CAST(1.0 AS DOUBLE)"
    else:
        w = "CASE WHEN has_zero THEN CASE WHEN dist = 0 THEN 1.0 ELSE 0.0 END ELSE 1.0 / dist END"
    return _pairs_sql(k, metric) + f""",
lab AS (SELECT nb.*, e.label, max(CASE WHEN dist = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY qid) = 1 AS has_zero
        FROM nb JOIN embeddings e ON e.vec_id = nb.rid),
votes AS (SELECT qid, label, sum({w}) AS votes FROM lab GROUP BY qid, label)
SELECT qid, label AS prediction, votes FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY votes DESC, label) AS r FROM votes) WHERE r = 1"""


@query("knn_predict_uniform", _vote_sql(5, "euclidean", "uniform"), round_cols=["votes"], operators=["M03", "M16"])
def q_knn_predict_uniform(spark, sf):
    train, test = _emb_split(spark, sf)
    model = neighbors.KNNClassifier(k=5, weights="uniform", metric="euclidean", idCol="vec_id",
                                    vecCol="embedding").fit(train)
    return model.transform(test).select(F.col("vec_id").alias("qid"), "prediction", "votes")


@query("knn_predict_distance_l1", _vote_sql(7, "manhattan", "distance"), round_cols=["votes"], operators=["M03"])
def q_knn_predict_distance_l1(spark, sf):
    train, test = _emb_split(spark, sf)
    model = neighbors.KNNClassifier(k=7, weights="distance", metric="manhattan", idCol="vec_id",
                                    vecCol="embedding").fit(train)
    return model.transform(test).select(F.col("vec_id").alias("qid"), "prediction", "votes")


SMOTE_SQL = """WITH ev AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x, unnest(range(len(embedding))) AS i FROM embeddings),
pairs AS (
  SELECT q.vec_id AS qid, r.vec_id AS rid, sqrt(sum((q.x - r.x) * (q.x - r.x))) AS dist
  FROM ev q JOIN ev r ON q.i = r.i JOIN embeddings eq ON eq.vec_id = q.vec_id JOIN embeddings er ON er.vec_id = r.vec_id
  WHERE eq.label = er.label AND q.vec_id <> r.vec_id GROUP BY q.vec_id, r.vec_id),
nb AS (SELECT * FROM (SELECT qid, rid, dist, row_number() OVER (PARTITION BY qid ORDER BY dist, rid) AS rank FROM pairs) WHERE rank <= 5),
c AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label),
plan AS (SELECT label, n, ((SELECT max(n) FROM c) - n) % n AS quota, ((SELECT max(n) FROM c) - n) // n AS per FROM c),
sel AS (SELECT e.vec_id, e.label, per,
          row_number() OVER (PARTITION BY e.label ORDER BY md5(CAST(e.vec_id AS VARCHAR) || '|42'), e.vec_id) <= quota AS extra
        FROM embeddings e JOIN plan USING (label)),
gen AS (SELECT vec_id AS base_id, label, CAST(unnest(range(per + CAST(extra AS INT))) AS INTEGER) AS j FROM sel
        WHERE per + CAST(extra AS INT) > 0),
kk AS (SELECT qid, max(rank) AS kk FROM nb GROUP BY qid),
pick AS (SELECT gen.*,
           ((('0x' || substr(md5(CAST(base_id AS VARCHAR) || '|' || CAST(j AS VARCHAR) || '|42|nb'), 1, 8))::BIGINT) % kk) + 1 AS nrank,
           (('0x' || substr(md5(CAST(base_id AS VARCHAR) || '|' || CAST(j AS VARCHAR) || '|42|u'), 1, 8))::BIGINT) / 4294967296.0 AS u
         FROM gen JOIN kk ON kk.qid = gen.base_id),
syn AS (SELECT p.label, p.base_id, p.j, nb.rid AS nb_id, p.u FROM pick p JOIN nb ON nb.qid = p.base_id AND nb.rank = p.nrank),
coords AS (SELECT s.*, b.i, b.x + s.u * (r.x - b.x) AS v FROM syn s JOIN ev b ON b.vec_id = s.base_id
           JOIN ev r ON r.vec_id = s.nb_id AND r.i = b.i)"""


@query("smote_synthetic", SMOTE_SQL + """
SELECT label, base_id, j, nb_id, u, max(CASE WHEN i = 0 THEN v END) AS v0, sum(v) AS vsum FROM coords
GROUP BY label, base_id, j, nb_id, u""", round_cols=["u", "v0", "vsum"], operators=["B01"])
def q_smote_synthetic(spark, sf):
    syn = neighbors.smote(_emb(spark, sf), "label", "vec_id", "embedding")
    return syn.select("label", "base_id", "j", "nb_id", "u", F.col("embedding")[0].alias("v0"),
                      F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x).alias("vsum"))


@query("smote_class_counts", SMOTE_SQL + """,
after AS (SELECT label FROM embeddings UNION ALL SELECT label FROM syn)
SELECT 'before' AS stage, label AS value, count(*) AS count FROM embeddings GROUP BY label
UNION ALL SELECT 'after', label, count(*) FROM after GROUP BY label""", operators=["B01", "B04"])
def q_smote_class_counts(spark, sf):
    emb = _emb(spark, sf)
    syn = neighbors.smote(emb, "label", "vec_id", "embedding")
    after = emb.select("label").unionByName(syn.select("label"))
    return eda.compare_counts({"before": emb, "after": after}, "label")
