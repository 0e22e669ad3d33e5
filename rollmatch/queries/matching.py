"""Vector retrieval and term weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollmatch.operators import sparse, vectors
from rollmatch.queries.registry import query
from rollmatch.session import load

VECTORS = "SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings"
NEAR = """SELECT vec_id, CAST(rank AS INTEGER) AS rank, near_vec_id, round(score, 6) AS score FROM (
    SELECT q.vec_id, i.vec_id AS near_vec_id, {score} AS score,
      row_number() OVER (PARTITION BY q.vec_id ORDER BY round({score}, 9) DESC, i.vec_id) AS rank
    FROM ({vectors}) q CROSS JOIN ({vectors}) i) WHERE rank <= {k}"""
COSINE = NEAR.format(score="list_cosine_similarity(q.v, i.v)", vectors=VECTORS, k=3)
L2 = NEAR.format(score="-list_distance(q.v, i.v)", vectors=VECTORS, k=3)


def _near(spark, sf, metric, **options):
    table = load(spark, sf, "embeddings")
    found = vectors.nearest(table, table, 3, "vec_id", "embedding", "vec_id", "embedding", metric, **options)
    # Adding zero turns a negative zero into a plain one.
    return found.withColumn("score", F.round("score", 6) + F.lit(0.0))


@query(COSINE)
def v3_nearest_cosine(spark, sf):
    return _near(spark, sf, "cosine")


@query(COSINE)
def v3_nearest_cosine_blocks(spark, sf):
    return _near(spark, sf, "cosine", bound=0, block_bytes=128 * 1024)


@query(L2)
def v4_nearest_l2(spark, sf):
    return _near(spark, sf, "l2")


@query(L2)
def v4_nearest_l2_blocks(spark, sf):
    return _near(spark, sf, "l2", bound=0, block_bytes=128 * 1024)


NODES = """SELECT vec_id AS id, p_type AS title, p_name AS request, v FROM ({v}) JOIN part ON p_partkey = vec_id"""
# Queries labelled 0 to 2 count as having nothing to search with.
JOBS = f"""WITH n AS ({NODES.format(v=VECTORS)}), r AS (
      SELECT q.vec_id, n.title, n.request, list_cosine_similarity(q.v, n.v) AS score,
        row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(q.v, n.v), 9) DESC, n.id) AS rank
      FROM ({VECTORS}) q CROSS JOIN n WHERE q.label > 2)
    SELECT vec_id, CAST(rank AS INTEGER) AS rank, title, request, round(score, 6) AS score FROM r WHERE rank <= 3
    UNION ALL SELECT vec_id, CAST(k AS INTEGER), 'Ashram Support', '', 0.0 FROM ({VECTORS}) CROSS JOIN range(1, 4) t(k)
    WHERE label <= 2"""


def job_nodes(spark, sf):
    part = load(spark, sf, "part").select("p_partkey", "p_type", "p_name", "p_brand")
    vecs = load(spark, sf, "embeddings").select("vec_id", "embedding")
    return part.join(vecs, F.col("p_partkey") == F.col("vec_id")).selectExpr(
        "vec_id AS id", "p_type AS `Job Title`", "p_name AS `Request Name`", "p_brand AS Department", "embedding")


@query(JOBS)
def v5_retrieve_or_default(spark, sf):
    found = vectors.retrieve_jobs(
        load(spark, sf, "embeddings"), job_nodes(spark, sf), 3, "vec_id", "embedding", "id",
        {"title": "Job Title", "request": "Request Name"}, searchable=F.col("label") > 2,
        default={"title": "Ashram Support", "request": ""})
    return found.withColumn("score", F.round("score", 6))


@query(f"""WITH n AS ({NODES.format(v=VECTORS)})
       SELECT vec_id, CAST(rank AS INTEGER) AS rank, title, request, round(score, 6) AS score FROM (
         SELECT q.vec_id, n.title, n.request, list_cosine_similarity(q.v, n.v) AS score, row_number() OVER (PARTITION BY q.vec_id
           ORDER BY round(list_cosine_similarity(q.v, n.v), 9) DESC, n.id) AS rank FROM ({VECTORS}) q CROSS JOIN n)
       WHERE rank <= 5""")
def j8_vector_join(spark, sf):
    found = vectors.retrieve_jobs(load(spark, sf, "embeddings"), job_nodes(spark, sf), 5, "vec_id", "embedding", "id",
                                  {"title": "Job Title", "request": "Request Name"})
    return found.withColumn("score", F.round("score", 6))


TERMS = r"""WITH w AS (SELECT {key} AS id, unnest(regexp_split_to_array(lower(text), '\s+')) AS term FROM {table}),
    t AS (SELECT id, term, count(*) AS tf FROM w WHERE term <> '' GROUP BY ALL),
    d AS (SELECT term, count(*) AS df FROM t GROUP BY term)
    SELECT id AS {key}, term, round(tf * ln(((SELECT count(*) FROM {table}) + 1) / (df + 1)), 6) AS weight
    FROM t JOIN d USING (term)"""


@query(TERMS.format(key="item_id", table="benchmark"))
def v2_term_weights(spark, sf):
    found = vectors.term_weights(load(spark, sf, "benchmark"), "item_id", "text")
    return found.withColumn("weight", F.round("weight", 6))


@query(TERMS.format(key="doc_id", table="documents"))
def v2_term_weights_documents(spark, sf):
    found = vectors.term_weights(load(spark, sf, "documents"), "doc_id", "text")
    return found.withColumn("weight", F.round("weight", 6))


@query(r"""WITH w AS (SELECT item_id, unnest(regexp_split_to_array(lower(text), '\s+')) AS term FROM benchmark),
    t AS (SELECT item_id, term, count(*) AS tf FROM w WHERE term <> '' GROUP BY ALL),
    d AS (SELECT term, ln(((SELECT count(*) FROM benchmark) + 1) / (count(*) + 1)) AS idf FROM t GROUP BY term),
    p AS (SELECT item_id, ('0x' || substr(md5(term), 1, 8))::BIGINT % 64 AS place, sum(tf * idf)::FLOAT::DOUBLE AS x
      FROM t JOIN d USING (term) GROUP BY ALL)
    SELECT item_id, CAST(place AS INTEGER) AS place, round(x, 4) AS x FROM p WHERE round(x, 4) <> 0""")
def v2_embed_text(spark, sf):
    made = vectors.embed_text(load(spark, sf, "benchmark"), "item_id", "text", 64)
    cells = made.select("item_id", F.posexplode("embedding").alias("place", "x"))
    return cells.withColumn("x", F.round(F.col("x").cast("double"), 4)).where("x <> 0")


@query(r"""WITH w AS (SELECT doc_id AS i, unnest(regexp_split_to_array(lower(text), '\s+')) AS term FROM documents),
    f AS (SELECT i, term, count(*) AS tf FROM w WHERE term <> '' GROUP BY ALL),
    idf AS (SELECT term, ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)) AS idf FROM f GROUP BY term),
    held AS (SELECT i, term, tf * idf AS v FROM f JOIN idf USING (term) WHERE idf > 0),
    asked AS (SELECT q, term, tf * idf AS w FROM (SELECT q, term, count(*) AS tf FROM (
      SELECT item_id AS q, unnest(regexp_split_to_array(lower(text), '\s+')) AS term FROM benchmark) GROUP BY ALL)
      JOIN idf USING (term) WHERE idf > 0),
    dots AS (SELECT q, i, sum(w * v) AS dot FROM asked JOIN held USING (term) GROUP BY ALL),
    nq AS (SELECT q, sqrt(sum(w * w)) AS n FROM asked GROUP BY q), ni AS (SELECT i, sqrt(sum(v * v)) AS n FROM held GROUP BY i),
    r AS (SELECT q, i, dot / (nq.n * ni.n) AS score FROM dots JOIN nq USING (q) JOIN ni USING (i))
    SELECT q AS item_id, CAST(rank AS INTEGER) AS rank, i AS near_doc_id, round(score, 6) AS score FROM (
      SELECT *, row_number() OVER (PARTITION BY q ORDER BY round(score, 9) DESC, i) AS rank FROM r) WHERE rank <= 5""")
def v3_nearest_by_terms(spark, sf):
    """The passages against all documents, by their term weights themselves."""
    docs = load(spark, sf, "documents")
    fitted = vectors.fit_terms(docs, "doc_id", "text")
    asked = vectors.weigh_terms(load(spark, sf, "benchmark"), "item_id", "text", fitted)
    found = sparse.nearest_by_terms(asked, vectors.term_weights(docs, "doc_id", "text"), 5, "item_id", "doc_id")
    return found.withColumn("score", F.round("score", 6))
