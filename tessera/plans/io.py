"""Source / sink queries: each writes a driver table in
the reference's format to a scratch folder under the shared checkpoint
folder, reads it back through the reader under test and aggregates; the
oracle aggregates the original table."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as M
from ..sources import readers as R
from ..operators.prefix import exact_sum
from .registry import ESUM, register

_ORDERS_CSV_SCHEMA = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                      "o_orderdate string, o_orderpriority string")


@register("s01_csv_roundtrip", "S1 S2 S3 S4 S6 S10 S12", "o_orderstatus:s n:i total:f n_inferred:i n_subset:i",
          sql=f"""
SELECT o_orderstatus, count(*) AS n, {ESUM('o_totalprice')} AS total, count(*) AS n_inferred, count(*) AS n_subset
FROM orders GROUP BY o_orderstatus""")
def s01_csv_roundtrip(t):
    spark = t.spark
    path = R.write_csv(t.orders.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd")),
                       R.scratch_path(spark, "orders-csv"))
    declared = R.read_csv(spark, [f"{path}/part-*.csv"], schema=_ORDERS_CSV_SCHEMA)       # S1 + S6 shard glob
    inferred = R.read_csv(spark, path, infer=True)                                         # S2
    subset = R.read_csv(spark, path, schema=_ORDERS_CSV_SCHEMA, columns=["o_orderstatus"])  # S3
    a = declared.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), exact_sum("o_totalprice").alias("total"))
    b = inferred.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_inferred"))
    c = subset.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_subset"))
    return a.join(b, "o_orderstatus").join(c, "o_orderstatus")


@register("s07_many_files_scores", "S7 M6", "model:s score:f n:i", sql="""
WITH d AS (SELECT l.doc_id, l.quality AS y, 1 / (1 + exp(-(ln(dd.n_chars) - 7))) AS plen FROM labels l
           JOIN documents dd ON l.doc_id = dd.doc_id)
SELECT 'len' AS model, avg(-(y * ln(least(greatest(plen, 1e-15), 1 - 1e-15))
  + (1 - y) * ln(1 - least(greatest(plen, 1e-15), 1 - 1e-15)))) AS score, count(*) AS n FROM d""")
def s07_many_files_scores(t):
    spark = t.spark
    d = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").select(
        "doc_id", F.col("quality").alias("y"), (1 / (1 + F.exp(-(F.ln("n_chars") - 7)))).alias("pred"))
    score = M.log_loss(d, "y", "pred").first()["log_loss"]
    base = R.scratch_path(spark, "subs")
    R.write_csv(d.select("doc_id", "pred"), f"{base}/sub_{score:.12f}")                   # file name carries the score
    back = R.read_with_source(spark, f"{base}/sub_*/*.csv", "doc_id bigint, pred double", r"sub_([0-9.]+)/")
    return back.groupBy(F.lit("len").alias("model")).agg(F.first("source_value").alias("score"),
                                                          F.count(F.lit(1)).alias("n"))


@register("s08_geojson_points", "S8 F43", "nation:s n:i lat_sum:f", sql="""
SELECT CAST(c_nationkey AS VARCHAR) AS nation, count(*) AS n,
  sum(32.5 + 9.5 * CAST(('0x' || substr(md5(CAST(c_custkey AS VARCHAR) || ':21'), 1, 8)) AS BIGINT) / 4294967296.0)
  AS lat_sum FROM customer GROUP BY c_nationkey""")
def s08_geojson_points(t):
    from ..operators.ordering import uniform
    spark = t.spark
    c = t.customer.select("c_custkey", "c_nationkey", (32.5 + 9.5 * uniform("c_custkey", 21)).alias("lat"),
                          (-124.3 + 10 * uniform("c_custkey", 22)).alias("lon"))
    feats = c.select(F.to_json(F.struct(
        F.lit("Feature").alias("type"),
        F.create_map(F.lit("nation"), F.col("c_nationkey").cast("string")).alias("properties"),
        F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates")).alias("geometry")))
        .alias("value"))
    path = R.scratch_path(spark, "geojson")
    feats.write.mode("overwrite").text(path)                                               # one Feature per line
    pts = R.read_geojson_points(spark, path)
    return pts.groupBy(F.col("properties")["nation"].alias("nation")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("lat_sum"))


@register("s09_fixed_width_atoms", "S9", "label:i n:i x_sum:f", sql="""
SELECT label, count(*) AS n, sum(round(CAST(embedding[1] AS DOUBLE) * 100, 3)) AS x_sum FROM embeddings GROUP BY label""")
def s09_fixed_width_atoms(t):
    from ..sources.schemas import PROTEIN_ATOMS
    spark = t.spark
    e = t.embeddings.select("vec_id", "label", *[(F.col("embedding")[i].cast("double") * 100).alias(n)
                                                 for i, n in enumerate("xyz")])
    texts = {"record": F.lit("ATOM"), "atom_number": F.format_string("%d", "vec_id"), "atom_name": F.lit("CA"),
             "residue_name": F.lit("ALA"), "chain": F.lit("A"), "residue_number": F.format_string("%d", "label"),
             **{f"{n}_coord": F.format_string("%.3f", F.round(n, 3)) for n in "xyz"}}
    path = R.scratch_path(spark, "pdb")
    layout = R.write_fixed_width(e, path, PROTEIN_ATOMS, texts, left=("record", "atom_name"))
    atoms = R.read_fixed_width(spark, path, layout, record=(*layout[0][1:3], "ATOM"))
    return atoms.groupBy(F.col("residue_number").alias("label")).agg(F.count(F.lit(1)).alias("n"),
                                                                     F.sum("x_coord").alias("x_sum"))


@register("s11_parquet_stage", "S5 S11 S13 S14", "year:i n:i total:f", sql=f"""
SELECT year(o_orderdate) AS year, count(*) AS n, {ESUM('o_totalprice')} AS total FROM orders
WHERE year(o_orderdate) >= 1998 GROUP BY ALL""")
def s11_parquet_stage(t):
    spark = t.spark
    path = R.write_parquet(t.orders.withColumn("year", F.year("o_orderdate")), R.scratch_path(spark, "stage"),
                           partition_by=["year"])
    back = R.read_parquet(spark, path).where(F.col("year") >= 1998)                       # partition pruning
    return back.groupBy("year").agg(F.count(F.lit(1)).alias("n"), exact_sum("o_totalprice").alias("total"))


@register("s15_template_fill", "S15", "o_orderkey:i pred:f", sql="""
SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus = 'F' THEN o_totalprice / 1000 END, 0.0) AS pred FROM orders""")
def s15_template_fill(t):
    tmpl = t.orders.select("o_orderkey", F.lit(None).cast("double").alias("pred"))
    preds = t.orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", (F.col("o_totalprice") / 1000).alias("pred"))
    return R.fill_template(tmpl, preds, "o_orderkey", "pred", default=0.0)
