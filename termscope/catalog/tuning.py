"""Splits, folds, metrics and tuning summaries."""

from pyspark.sql import functions as F

from termscope.catalog.base import reviews, table
from termscope.operators import evaluation as ops
from termscope.operators.numbering import best_per_group as best
from termscope.operators.numbering import top_n


def split_assign(spark, sf_dir):
    return ops.assign_split(table(spark, sf_dir, "documents").select("doc_id"))


def split_counts(spark, sf_dir):
    return ops.split_counts(table(spark, sf_dir, "documents").select("doc_id"))


def train_val_union(spark, sf_dir):
    """Union of the two parts, over the whole table."""
    corpus = reviews(spark, sf_dir).select("doc_id", "category")
    return ops.split_part(corpus, "train").unionByName(ops.split_part(corpus, "validation"))


def cv_fold_assign(spark, sf_dir):
    return ops.assign_fold(table(spark, sf_dir, "documents").select("doc_id"))


def _toxicity_as_prediction(spark, sf_dir):
    return table(spark, sf_dir, "labels").select(
        F.col("quality").alias("label"), (1 - F.col("toxic")).alias("prediction")
    )


def confusion_matrix(spark, sf_dir):
    return ops.confusion_counts(_toxicity_as_prediction(spark, sf_dir))


def weighted_f1(spark, sf_dir):
    f1 = ops.weighted_f1(ops.confusion_counts(_toxicity_as_prediction(spark, sf_dir)))
    return f1.select(F.round("f1", 9).alias("f1"))


def best_per_group(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return best(orders, ["o_orderpriority"], [F.desc("o_totalprice"), F.asc("o_orderkey")])


def top_n_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return top_n(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")], 10)


def main_effects(spark, sf_dir):
    return ops.main_effects(
        table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "l_quantity"
    )


QUERIES = {
    "split_assign": split_assign,
    "split_counts": split_counts,
    "train_val_union": train_val_union,
    "cv_fold_assign": cv_fold_assign,
    "confusion_matrix": confusion_matrix,
    "weighted_f1": weighted_f1,
    "best_per_group": best_per_group,
    "top_n_rows": top_n_rows,
    "main_effects": main_effects,
}


def _sql_bucket(seed: int, buckets: int) -> str:
    return (
        f"CAST(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR) || '-{seed}'), 1, 8) AS BIGINT) "
        f"% {buckets} AS INT)"
    )


SQL_SPLIT = f"""split AS (SELECT doc_id, lang AS category,
  CASE WHEN b < 70 THEN 'train' WHEN b < 85 THEN 'validation' ELSE 'test' END AS split
FROM (SELECT *, {_sql_bucket(42, 100)} AS b FROM documents))"""

_CONFUSION = """c AS (SELECT quality AS label, 1 - toxic AS prediction, count(*) AS cnt
  FROM labels GROUP BY ALL)"""

ORACLES = {
    "split_assign": f"WITH {SQL_SPLIT} SELECT doc_id, split FROM split",
    "split_counts": f"WITH {SQL_SPLIT} SELECT split, count(*) AS docs FROM split GROUP BY split",
    "train_val_union": f"WITH {SQL_SPLIT} SELECT doc_id, category FROM split WHERE split <> 'test'",
    "cv_fold_assign": f"SELECT doc_id, {_sql_bucket(43, 2)} AS fold FROM documents",
    "confusion_matrix": f"WITH {_CONFUSION} SELECT label, prediction, cnt FROM c",
    "weighted_f1": f"""WITH {_CONFUSION},
p AS (SELECT label, sum(cnt) AS support,
        coalesce(sum(cnt) FILTER (WHERE label = prediction), 0) AS tp,
        (SELECT coalesce(sum(cnt), 0) FROM c d WHERE d.prediction = c.label) AS predicted
      FROM c GROUP BY label),
r AS (SELECT support, tp / support AS rec,
        CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted END AS prec FROM p)
SELECT round(sum(support * CASE WHEN rec + prec = 0 THEN 0 ELSE 2 * rec * prec / (rec + prec) END)
             / sum(support), 9) AS f1 FROM r""",
    "best_per_group": """SELECT o_orderpriority, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderpriority
                               ORDER BY o_totalprice DESC, o_orderkey) AS rk FROM orders)
WHERE rk = 1""",
    "top_n_rows": """SELECT o_orderkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
    "main_effects": """WITH m AS (
  SELECT 'l_returnflag' AS factor, l_returnflag AS level, avg(l_quantity) AS mean
  FROM lineitem GROUP BY l_returnflag
  UNION ALL
  SELECT 'l_linestatus', l_linestatus, avg(l_quantity) FROM lineitem GROUP BY l_linestatus)
SELECT factor, level, round(mean, 6) AS mean,
       round(mean - min(mean) OVER (PARTITION BY factor), 6) AS delta FROM m""",
}
