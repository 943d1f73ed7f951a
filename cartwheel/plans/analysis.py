"""Search and flexible analysis: student search, sale search with facets,
province and item sales."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import AGE_BANDS, GENDER_LABELS
from ..operators.search import SearchResult, TermsAgg, search
from ..functions.text import match


def student_search(students: DataFrame, sex: str, favo_token: str, offset: int = 0, size: int = 2,
                   agg_size: int = 10) -> SearchResult:
    """bool(filter term sex, must term favo) + terms(class_id) with max(age) + page."""
    return search(students, "doc_id", filter_terms={"sex": sex}, must_terms={"favo": favo_token},
                  aggs=TermsAgg("class_id", agg_size, "age"), offset=offset, size=size,
                  order_cols=[F.col("doc_id").cast("long"), F.col("doc_id")])


def gender_label(c) -> F.Column:
    expr = None
    for code, label in GENDER_LABELS:
        cond = F.col(c) == code
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.col(c))


def age_band(c) -> F.Column:
    under20, mid, over30 = AGE_BANDS
    a = F.col(c)
    return F.when(a < 20, F.lit(under20)).when(a < 30, F.lit(mid)).otherwise(F.lit(over30))


def _facet(df: DataFrame, key, name: str) -> DataFrame:
    """(name, count, share %).  The total is a scalar subquery over the
    facet rows (no join, no global window)."""
    g = df.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("value"))
    total = g.agg(F.sum("value").alias("total")).scalar()
    return g.select(name, "value",
                    F.round((F.lit(100.0) * F.col("value") / total).cast("double"), 2).alias("share"))


def facet_gender(sale: DataFrame) -> DataFrame:
    return _facet(sale, gender_label("user_gender"), "name")


def facet_age_band(sale: DataFrame) -> DataFrame:
    return _facet(sale, age_band("user_age"), "name")


def sale_hits(sale: DataFrame, date: str, keyword: str = "") -> DataFrame:
    """The sales of the day that match the keyword (all without one)."""
    hits = sale.where(F.col("dt") == date)
    return hits.where(match("sku_name", keyword)) if keyword else hits


def hit_counts(hits: DataFrame) -> DataFrame:
    """One row: total, and ``counts``, an array of (facet, name, value) of both facets.  One pass over the hits: they are counted per
    age band and gender, and that handful of rows is added up along either."""
    cube = hits.groupBy(age_band("user_age").alias("age"), gender_label("user_gender").alias("gender")).agg(F.count(F.lit(1)).alias("n"))
    each = F.explode(F.array(F.struct(F.lit("age").alias("facet"), F.col("age").alias("name")),
                             F.struct(F.lit("gender").alias("facet"), F.col("gender").alias("name")))).alias("f")
    return (cube.select("n", each).groupBy("f.facet", "f.name").agg(F.sum("n").alias("value"))
            .agg(F.coalesce(F.sum(F.when(F.col("facet") == "age", F.col("value"))), F.lit(0)).alias("total"),
                 F.collect_list(F.struct("facet", "name", "value")).alias("counts")))


def _share(value, total):
    return F.round((F.lit(100.0) * value / total).cast("double"), 2)


def sale_facets(hits: DataFrame) -> DataFrame:
    """(facet, name, value, share %) of the age and gender facets over all hits."""
    return (hit_counts(hits).select("total", F.explode("counts").alias("c"))
            .select("c.facet", "c.name", "c.value", _share(F.col("c.value"), F.col("total")).alias("share")))


PAGE_ORDER = ("order_detail_id", "order_id", "sku_id", "sku_price")


def sale_search(sale: DataFrame, date: str, keyword: str = "", offset: int = 0, size: int = 20):
    """total, page (ordered by order_detail_id with unique tie-breaks) and facets over all hits of the day/keyword."""
    hits = sale_hits(sale, date, keyword)
    facets = sale_facets(hits)
    one = lambda facet: facets.where(F.col("facet") == facet).drop("facet")
    return {"total": hits.agg(F.count(F.lit(1)).alias("total")), "detail": hits.orderBy(*PAGE_ORDER).offset(offset).limit(size),
            "facets": facets, "age": one("age"), "gender": one("gender")}


def sale_search_json(sale: DataFrame, date: str, keyword: str = "", offset: int = 0, size: int = 20) -> DataFrame:
    """The sale search as one document: total, stat[0] = age options, stat[1] = gender options, detail = the page's rows.
    Total and both facets take one pass over the hits, the page (with more columns) another.  Only facet rows (a
    handful) and one page are ever gathered."""
    hits = sale_hits(sale, date, keyword)
    page = hits.orderBy(*PAGE_ORDER).offset(offset).limit(size)
    placed = F.struct(*PAGE_ORDER, F.struct(*page.columns).alias("row"))
    detail = page.agg(F.transform(F.array_sort(F.collect_list(placed)), lambda r: r["row"]).alias("detail"))

    def options(facet):
        mine = F.filter("counts", lambda c: c["facet"] == facet)
        return F.struct(F.array_sort(F.transform(mine, lambda c: F.struct(c["name"].alias("name"), c["value"].alias("value"),
                                                                          _share(c["value"], F.col("total")).alias("share")))).alias("options"))
    return hit_counts(hits).withColumn("detail", detail.scalar()).select(F.to_json(F.struct(
        "total", F.array(options("age"), options("gender")).alias("stat"), F.col("detail"))).alias("json"))


def province_sales(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """(name, order_count, value) per province.  Orders are first reduced per
    customer (partial aggregation), so the customer join sees one row per
    buying customer instead of one per order; the nation table (25 rows by
    definition) is broadcast."""
    per_cust = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("v"))
    per_nat = (per_cust.join(customer.select("c_custkey", "c_nationkey"),
                             per_cust["o_custkey"] == customer["c_custkey"])
                       .groupBy("c_nationkey").agg(F.sum("n").alias("order_count"), F.sum("v").alias("v")))
    nat = F.broadcast(nation.select("n_nationkey", "n_name"))
    return per_nat.join(nat, per_nat["c_nationkey"] == nat["n_nationkey"]).select(
        F.col("n_name").alias("name"), F.col("order_count").cast("long").alias("order_count"),
        F.round("v", 2).alias("value"))


def province_topk(sales: DataFrame, k: int = 5) -> DataFrame:
    return sales.orderBy(F.desc("value"), F.asc("name")).limit(k)


def province_sales_bins(sales: DataFrame, width: int = 100, bins: int = 6) -> DataFrame:
    """Fixed-width bins of order_count (0-100, ..., 500-600, then the open top)."""
    b = F.least(F.floor(F.col("order_count") / width), F.lit(bins)).cast("int")
    label = F.when(b >= bins, F.concat(F.lit(str(bins * width)), F.lit("+"))).otherwise(
        F.concat((b * width).cast("string"), F.lit("-"), ((b + 1) * width).cast("string")))
    return sales.groupBy(label.alias("bin")).agg(F.count(F.lit(1)).alias("provinces"))


def sku_sales(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """(name, num): lines sold per item name.  Lines are reduced per part key
    before the part join."""
    per_part = lineitem.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    j = per_part.join(part.select("p_partkey", "p_name"), per_part["l_partkey"] == part["p_partkey"])
    return j.groupBy(F.col("p_name").alias("name")).agg(F.sum("n").cast("long").alias("num"))
