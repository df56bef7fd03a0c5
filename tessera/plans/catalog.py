"""Registered queries over the star schema, with the DuckDB SQL each is checked against.

Money is summed as decimals so that results do not depend on the order of rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.scalar import cosine, dot, host, safe_div
from tessera.operators.json_shapes import frequent, shapes, shred, type_of
from tessera.operators.quantiles import heavy_hitters, quantiles
from tessera.operators.relational import asof_join, latest_by, overlap_join, range_join, salted_join, sessionize, top_k_per_group
from tessera.operators.stored import new_folder
from tessera.operators.temporal import coalesce, valid_time_join
from tessera.sources import arrow_files
from tessera.sources.tables import Tables
from tessera.streaming.patterns import Pattern, match
from tessera.streaming.views import aggregate, aggregate_changes, join_changes, updated
from tessera.streaming.windows import first_seen, interval_join, session_counts, tumbling_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of (tables) under its own name, with its SQL."""

    def keep(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return keep


def money(c):
    return F.col(c).cast("decimal(18,2)") if isinstance(c, str) else c.cast("decimal(18,2)")


def dbl(c):
    return c.cast("double")


@query("""
SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price,
  round(avg(l_discount), 6) AS avg_disc, count(*) AS n
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""")
def pricing_summary(t):
    """Filter, group, aggregate; the filter reaches the scan."""
    return (
        t.lineitem.filter("l_shipdate <= TIMESTAMP_NTZ '1998-09-02'")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            dbl(F.sum(money("l_quantity"))).alias("sum_qty"),
            dbl(F.sum(money("l_extendedprice"))).alias("sum_price"),
            F.round(F.avg("l_discount"), 6).alias("avg_disc"),
            F.count("*").alias("n"),
        )
    )


@query("""
SELECT n_name, CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE r_name = 'ASIA' GROUP BY 1""")
def regional_revenue(t):
    """Six-table inner join; the planner picks the strategy of each join from sizes."""
    place = t.nation.join(t.region.filter("r_name = 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))
    sup = t.supplier.join(place, F.col("s_nationkey") == F.col("n_nationkey"))
    cust = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    rows = t.lineitem.join(sup, F.col("l_suppkey") == F.col("s_suppkey")).join(
        cust, (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("c_nationkey") == F.col("s_nationkey"))
    )
    value = money(F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return rows.groupBy("n_name").agg(dbl(F.sum(value)).alias("revenue"))


def _by_priority(how: str):
    def f(t):
        big = t.lineitem.filter("l_quantity > 49").select("l_orderkey")
        return t.orders.join(big, t.orders.o_orderkey == big.l_orderkey, how).groupBy("o_orderpriority").agg(F.count("*").alias("n"))

    return f


for _how, _word in (("left_semi", "EXISTS"), ("left_anti", "NOT EXISTS")):
    _f = _by_priority(_how)
    _f.__name__ = f"join_{_how}"
    query(f"""SELECT o_orderpriority, count(*) AS n FROM orders WHERE {_word}
      (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 49) GROUP BY 1""")(_f)


def _outer(how: str):
    def f(t):
        # Both sides are counted by key first, so the join has a row a key, not the pairs of each key's rows.
        a = t.customer.filter("c_acctbal < 0").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("a"), F.count("c_custkey").alias("ac"))
        b = t.supplier.filter("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("k2")).agg(F.count("*").alias("b"), F.count("s_suppkey").alias("bc"))
        nc = F.coalesce("ac", F.lit(0)) * F.coalesce("b", F.lit(1))
        ns = F.coalesce("bc", F.lit(0)) * F.coalesce("a", F.lit(1))
        return a.join(b, a.k == b.k2, how).groupBy("k", "k2").agg(F.sum(nc).alias("nc"), F.sum(ns).alias("ns"))

    return f


for _how in ("inner", "left", "right", "full"):
    _f = _outer(_how)
    _f.__name__ = f"join_{_how}"
    query(f"""SELECT k, k2, count(c_custkey) AS nc, count(s_suppkey) AS ns FROM
      (SELECT c_nationkey AS k, c_custkey FROM customer WHERE c_acctbal < 0) a
      {_how.upper()} JOIN (SELECT s_nationkey AS k2, s_suppkey FROM supplier WHERE s_acctbal > 5000) b ON k = k2
      GROUP BY 1, 2""")(_f)


def _grouping(kind: str):
    def f(t):
        rows = t.lineitem.select("l_returnflag", "l_linestatus", "l_quantity")
        aggs = [dbl(F.sum(money("l_quantity"))).alias("qty"), F.grouping_id().cast("long").alias("gid")]
        return getattr(rows, kind)("l_returnflag", "l_linestatus").agg(*aggs)

    return f


for _kind in ("cube", "rollup"):
    _f = _grouping(_kind)
    _f.__name__ = f"agg_{_kind}"
    query(f"""SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty,
      CAST(grouping_id(l_returnflag, l_linestatus) AS BIGINT) AS gid
      FROM lineitem GROUP BY {_kind.upper()}(l_returnflag, l_linestatus)""")(_f)


@query("""SELECT l_returnflag,
  CAST(sum(CASE WHEN l_linestatus = 'O' THEN l_linenumber END) AS BIGINT) AS "O",
  CAST(sum(CASE WHEN l_linestatus = 'F' THEN l_linenumber END) AS BIGINT) AS "F" FROM lineitem GROUP BY 1""")
def agg_pivot(t):
    """Pivot with stated values, so no extra pass finds them."""
    return t.lineitem.groupBy("l_returnflag").pivot("l_linestatus", ["O", "F"]).agg(F.sum("l_linenumber"))


@query("""SELECT event_type, count(DISTINCT user_id) AS users, count(*) FILTER (value > 50) AS big,
  arg_max(event_id, event_id) AS last_id, bool_or(value > 99) AS any_top FROM events GROUP BY 1""")
def agg_mixed(t):
    """Distinct, filtered, max_by and boolean aggregates together."""
    return t.events.groupBy("event_type").agg(
        F.countDistinct("user_id").alias("users"),
        F.count(F.when(F.col("value") > 50, 1)).alias("big"),
        F.max_by("event_id", "event_id").alias("last_id"),
        F.bool_or(F.col("value") > 99).alias("any_top"),
    )


@query("""SELECT l_returnflag, n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty FROM lineitem
  JOIN (SELECT l_returnflag, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1) USING (l_returnflag) GROUP BY 1, 2""")
def join_salted(t):
    """A join on a key of three values, whose rows are dealt to several tasks each; the small side is shuffled too."""
    kinds = t.lineitem.groupBy("l_returnflag").agg(F.countDistinct("l_suppkey").alias("n"))
    rows = t.lineitem.select("l_returnflag", "l_orderkey", "l_quantity")
    return salted_join(rows, kinds, ["l_returnflag"], hot=1000, salts=8, small=0).groupBy("l_returnflag", "n").agg(dbl(F.sum(money("l_quantity"))).alias("qty"))


@query("""SELECT l_returnflag, n, unnest([0.001, 0.25, 0.5, 0.9, 1.0])::DOUBLE AS q, unnest(v) AS l_extendedprice FROM (
  SELECT l_returnflag, count(l_extendedprice) AS n, quantile_disc(l_extendedprice, [0.001, 0.25, 0.5, 0.9, 1.0]) AS v FROM lineitem GROUP BY 1)""")
def agg_quantiles(t):
    """Exact quantiles of three groups that hold all rows, by narrowing histograms."""
    return quantiles(t.lineitem, ["l_returnflag"], "l_extendedprice", [0.001, 0.25, 0.5, 0.9, 1.0])


@query("""WITH word AS (SELECT unnest(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS word FROM documents),
found AS (SELECT word, count(*) AS n, rank() OVER (ORDER BY count(*) DESC) AS place FROM word GROUP BY 1)
SELECT word, n FROM found WHERE place <= 100""")
def agg_heavy_hitters(t):
    """The hundred most frequent words of all documents, counted exactly."""
    words = t.documents.select(F.explode(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("word"))
    return heavy_hitters(words, "word", 100)


@query("""SELECT * FROM (SELECT o_custkey, o_orderkey, o_totalprice,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 3""")
def window_top_k(t):
    return top_k_per_group(
        t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3
    )


@query("""SELECT o_orderkey, lag(o_orderkey) OVER w AS prev_key, lead(o_orderkey, 2) OVER w AS next2,
  rank() OVER w AS rk, dense_rank() OVER w AS drk, ntile(4) OVER w AS quart, first_value(o_orderkey) OVER w AS first_key
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def window_analytic(t):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return t.orders.select(
        "o_orderkey",
        F.lag("o_orderkey").over(w).alias("prev_key"),
        F.lead("o_orderkey", 2).over(w).alias("next2"),
        F.rank().over(w).cast("long").alias("rk"),
        F.dense_rank().over(w).cast("long").alias("drk"),
        F.ntile(4).over(w).cast("long").alias("quart"),
        F.first("o_orderkey").over(w).alias("first_key"),
    )


@query("""SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS day_n,
  CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DOUBLE) AS last3
FROM events""")
def window_frames(t):
    """A time range frame and a row frame."""
    secs = F.unix_micros(F.col("ts").cast("timestamp"))
    day = Window.partitionBy("user_id").orderBy("us").rangeBetween(-86_400_000_000, 0)
    last = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-2, 0)
    return t.events.withColumn("us", secs).select(
        "event_id", F.count("*").over(day).alias("day_n"), dbl(F.sum(money("value")).over(last)).alias("last3")
    )


def _set_op(name: str):
    def f(t):
        a, b = t.customer.select(F.col("c_nationkey").alias("k")), t.supplier.select(F.col("s_nationkey").alias("k"))
        return getattr(a, name)(b)

    return f


for _name, _word in (("intersect", "INTERSECT"), ("intersectAll", "INTERSECT ALL"), ("subtract", "EXCEPT"), ("exceptAll", "EXCEPT ALL"), ("unionAll", "UNION ALL")):
    _f = _set_op(_name)
    _f.__name__ = f"set_{_name.lower()}"
    query(f"SELECT c_nationkey AS k FROM customer {_word} SELECT s_nationkey AS k FROM supplier")(_f)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 10")
def sort_limit(t):
    """A top-k report: TakeOrderedAndProject keeps k rows a task."""
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").offset(10).limit(50)


@query("""SELECT event_id, (SELECT max(p.event_id) FROM events p WHERE p.user_id = e.user_id AND p.event_type = 'purchase' AND p.ts =
  (SELECT max(q.ts) FROM events q WHERE q.user_id = e.user_id AND q.event_type = 'purchase' AND q.ts <= e.ts)) AS purchase_id
FROM events e WHERE event_type = 'click'""")
def join_asof(t):
    """Each click with the user's last purchase so far."""
    clicks = t.events.filter("event_type = 'click'").select("event_id", "user_id", "ts")
    bought = t.events.filter("event_type = 'purchase'").select("user_id", F.col("ts").alias("bought"), F.col("event_id").alias("purchase_id"))
    return asof_join(clicks, bought, ["user_id"], "ts", "bought", ["purchase_id"], F.date_trunc("week", "_t")).select("event_id", "purchase_id")


@query("""SELECT o_orderkey, s.l_orderkey, s.l_linenumber FROM orders JOIN
  (SELECT l_orderkey, l_linenumber, o_custkey AS k, l_shipdate AS a, l_shipdate + to_days(CAST(l_quantity AS INTEGER)) AS b FROM lineitem JOIN orders ON l_orderkey = o_orderkey) s
  ON o_custkey = s.k AND o_orderdate < s.b AND s.a < o_orderdate + INTERVAL 20 DAY WHERE s.a < s.b""")
def join_overlap(t):
    """Shipments under way while an order of the same customer is open."""
    open_ = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", F.expr("o_orderdate + INTERVAL '20' DAY").alias("closed"))
    lines = t.lineitem.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey").hint("merge"), "l_orderkey")
    sent = lines.select("o_custkey", "l_orderkey", "l_linenumber", "l_shipdate", F.expr("l_shipdate + make_dt_interval(CAST(l_quantity AS INT))").alias("there"))
    pairs = overlap_join(open_, sent, ["o_custkey"], ("o_orderdate", "closed"), ("l_shipdate", "there"), unit=86_400 * 8)
    return pairs.select("l.o_orderkey", "r.l_orderkey", "r.l_linenumber")


_SPANS = """span AS (SELECT l_suppkey, l_shipdate AS a, l_shipdate + to_days(CAST(l_quantity AS INTEGER)) AS b FROM lineitem WHERE l_quantity >= 1),
marked AS (SELECT *, coalesce(a > max(b) OVER (PARTITION BY l_suppkey ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), TRUE) AS new FROM span),
numbered AS (SELECT *, count(*) FILTER (new) OVER (PARTITION BY l_suppkey ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS k FROM marked),
island AS (SELECT l_suppkey, min(a) AS busy_from, max(b) AS busy_to, count(*) AS n FROM numbered GROUP BY l_suppkey, k)"""


def _busy(t):
    """Per supplier the spans in which at least one of its lines is under way."""
    lines = t.lineitem.select("l_suppkey", F.col("l_shipdate").alias("busy_from"), F.expr("l_shipdate + make_dt_interval(CAST(l_quantity AS INT))").alias("busy_to"))
    return coalesce(lines, ["l_suppkey"], "busy_from", "busy_to", bucket=F.date_trunc("year", "_a"))


@query(f"WITH {_SPANS} SELECT * FROM island")
def temporal_coalesce(t):
    """Overlapping and touching shipments of a supplier merged to spans."""
    return _busy(t)


@query(f"""WITH {_SPANS},
active AS (SELECT l_suppkey AS k, l_returnflag, min(l_shipdate) AS seen_from, max(l_shipdate) AS seen_to FROM lineitem GROUP BY ALL)
SELECT k, l_returnflag, n, greatest(seen_from, busy_from) AS valid_from, least(seen_to, busy_to) AS valid_to
FROM active JOIN island ON k = l_suppkey AND seen_from < busy_to AND busy_from < seen_to WHERE seen_from < seen_to""")
def temporal_join(t):
    """A supplier's busy spans within the time from the first to the last line of each return flag."""
    seen = t.lineitem.groupBy("l_suppkey", "l_returnflag").agg(F.min("l_shipdate").alias("seen_from"), F.max("l_shipdate").alias("seen_to"))
    pairs = valid_time_join(seen, _busy(t), ["l_suppkey"], ("seen_from", "seen_to"), ("busy_from", "busy_to"), unit=86_400 * 32)
    return pairs.select(F.col("l.l_suppkey").alias("k"), "l.l_returnflag", "r.n", "valid_from", "valid_to")


@query("""SELECT l_orderkey, l_linenumber, l_quantity, s_suppkey FROM lineitem JOIN supplier
  ON l_suppkey = s_suppkey AND l_quantity >= s_nationkey AND l_quantity < s_nationkey + 5""")
def join_range(t):
    spans = t.supplier.select(F.col("s_suppkey"), F.col("s_suppkey").alias("k"), F.col("s_nationkey").alias("lo"), (F.col("s_nationkey") + 5).alias("hi"))
    rows = t.lineitem.withColumn("k", F.col("l_suppkey"))
    return range_join(rows, spans, ["k"], "l_quantity", "lo", "hi", 8.0).select("l_orderkey", "l_linenumber", "l_quantity", "s_suppkey")


@query("""WITH g AS (SELECT *, CASE WHEN epoch(ts) - epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) > 86400 THEN 1 ELSE 0 END AS new FROM events),
s AS (SELECT user_id, CAST(sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session FROM g)
SELECT user_id, session, count(*) AS n FROM s GROUP BY 1, 2""")
def sessions(t):
    return sessionize(t.events.select("user_id", "ts"), ["user_id"], "ts", 86400, bucket=F.date_trunc("week", "ts")).groupBy("user_id", "session").agg(F.count("*").alias("n"))


@query("SELECT user_id, arg_max(event_id, event_id) AS event_id FROM events GROUP BY 1")
def latest(t):
    return latest_by(t.events.select("user_id", "event_id"), ["user_id"], F.col("event_id"))


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, upper(event_type) AS u, length(event_type) AS len,
  substr(event_type, 2, 3) AS mid, md5(event_type) AS h, CAST(year(ts) AS INTEGER) AS y, CAST(month(ts) AS INTEGER) AS m, CAST(date_trunc('day', ts) AS TIMESTAMP) AS d FROM events""")
def scalar_functions(t):
    return t.events.select(
        "event_id",
        F.get_json_object("props", "$.k").cast("long").alias("k"),
        F.upper("event_type").alias("u"),
        F.length("event_type").cast("long").alias("len"),
        F.substring("event_type", 2, 3).alias("mid"),
        F.md5("event_type").alias("h"),
        F.year("ts").alias("y"),
        F.month("ts").alias("m"),
        F.date_trunc("day", F.col("ts").cast("timestamp")).cast("timestamp_ntz").alias("d"),
    )


@query("""SELECT label, CAST(count(*) AS BIGINT) AS n, round(sum(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])), 3) AS energy FROM embeddings GROUP BY 1""")
def vectors(t):
    """Array arithmetic without a UDF."""
    return t.embeddings.groupBy("label").agg(F.count("*").alias("n"), F.round(F.sum(dot(F.col("embedding"), F.col("embedding"))), 3).alias("energy"))


@query("""SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS similarity
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def vectors_cosine(t):
    """Cosine of each vector and the next, without a UDF."""
    a = t.embeddings.select(F.col("vec_id").alias("a"), F.col("embedding").alias("x"))
    b = t.embeddings.select(F.col("vec_id").alias("b"), F.col("embedding").alias("y"))
    return a.join(b, F.col("b") == F.col("a") + 1).select("a", "b", F.round(cosine(F.col("x"), F.col("y")), 6).alias("similarity"))


@query("""SELECT user_id, round(count(*) FILTER (event_type = 'purchase') / nullif(count(*) FILTER (event_type = 'click'), 0)::DOUBLE, 6) AS rate FROM events GROUP BY 1""")
def ratios(t):
    """A ratio that is null where its divisor is 0."""
    times = lambda kind: F.count(F.when(F.col("event_type") == kind, 1))
    return t.events.groupBy("user_id").agg(F.round(safe_div(times("purchase"), times("click")), 6).alias("rate"))


@query("""SELECT lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/:?#]+)', 1)) AS host, count(*) AS n FROM pages GROUP BY 1""")
def hosts(t):
    return t.pages.groupBy(host(F.col("url")).alias("host")).agg(F.count("*").alias("n"))


@query("""SELECT o_orderkey FROM orders o WHERE o_totalprice > (SELECT avg(i.o_totalprice) * 1.5 FROM orders i WHERE i.o_custkey = o.o_custkey)""")
def subquery_correlated(t):
    """A correlated scalar subquery, written as an aggregate and a join."""
    mean = t.orders.groupBy(F.col("o_custkey").alias("k")).agg(F.avg("o_totalprice").alias("mean"))
    return t.orders.join(mean, F.col("o_custkey") == F.col("k")).filter("o_totalprice > mean * 1.5").select("o_orderkey")


@query("""SELECT date_trunc('day', ts)::TIMESTAMP AS start, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY 1, 2""")
def stream_tumbling(t):
    """The streaming operator on a batch frame."""
    rows = t.events.withColumn("value", money("value"))
    out = tumbling_counts(rows, "ts", "1 day", "1 hour", "event_type")
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", dbl(F.col("total")).alias("total"))


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w >= INTERVAL 6 HOUR THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g)
SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k""")
def stream_sessions(t):
    out = session_counts(t.events.select("ts", "user_id"), "ts", "6 hours", "1 hour", "user_id")
    return out.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), "n")


@query("SELECT user_id, event_type, min(ts) AS ts FROM events GROUP BY ALL")
def stream_first_seen(t):
    """Streaming deduplication on a batch frame."""
    first = first_seen(t.events.select("ts", "user_id", "event_type"), "ts", "1 hour", "user_id", "event_type")
    return first.select("user_id", "event_type", F.col("ts").cast("timestamp_ntz").alias("ts"))


@query("""SELECT c.event_id AS click, p.event_id AS purchase FROM events c JOIN events p ON c.user_id = p.user_id
  AND p.ts >= c.ts AND p.ts < c.ts + INTERVAL 2 HOUR WHERE c.event_type = 'click' AND p.event_type = 'purchase'""")
def stream_interval_join(t):
    """The stream-stream join on batch frames: purchases within two hours of a click."""
    side = lambda kind: t.events.filter(F.col("event_type") == kind).select("event_id", "user_id", "ts")
    out = interval_join(side("click"), side("purchase"), "ts", "1 hour", "2 hours", "user_id")
    return out.select(F.col("a.event_id").alias("click"), F.col("b.event_id").alias("purchase"))


@query("""WITH RECURSIVE e AS (SELECT user_id, event_id, epoch_us(ts) AS t, event_type AS k, row_number() OVER w AS rn,
  coalesce(epoch_us(ts) - lag(epoch_us(ts)) OVER w > 172800000000, FALSE) AS broken FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
run AS (SELECT DISTINCT user_id, CAST(0 AS BIGINT) AS rn, 0 AS p, CAST(NULL AS BIGINT) AS start_t, CAST(NULL AS BIGINT) AS start_id, CAST(NULL AS BIGINT) AS end_t, CAST(NULL AS BIGINT) AS end_id FROM e
  UNION ALL SELECT user_id, rn, CASE WHEN on_ THEN q + 1 WHEN k = 'error' THEN 0 ELSE q END,
    CASE WHEN on_ AND q = 0 THEN t ELSE start_t END, CASE WHEN on_ AND q = 0 THEN event_id ELSE start_id END, t, event_id FROM (
    SELECT e.*, q, start_t, start_id, k = (['view', 'click', 'purchase'])[q + 1] AS on_ FROM (
      SELECT e.*, CASE WHEN broken OR p = 3 THEN 0 ELSE p END AS q, start_t, start_id FROM run JOIN e ON e.user_id = run.user_id AND e.rn = run.rn + 1) e) e)
SELECT user_id, start_t, start_id, end_t, end_id FROM run WHERE p = 3""")
def stream_patterns(t):
    """The streaming pattern automaton on a batch frame: a view, a click, then a purchase, with no error and no two idle
    days in between."""
    return match(t.events, ["user_id"], "ts", "event_id", "event_type", Pattern.of("view", "click", "purchase", never=["error"], gap=172_800))


@query("""SELECT o_custkey, count(*) AS n, CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS total, min(CAST(l_quantity AS BIGINT)) AS lo, max(CAST(l_quantity AS BIGINT)) AS hi
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE NOT (l_returnflag = 'R' AND l_shipdate < TIMESTAMP '1996-01-01')
  AND NOT (o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '1996-01-01') GROUP BY 1""")
def view_changes(t):
    """A view over a join, made of the rows before 1996 and then changed: later rows come, returned lines and finished orders
    of before 1996 go. Equals the view of what is left."""
    early = lambda c: F.col(c) < F.lit("1996-01-01").cast("timestamp_ntz")
    lines = t.lineitem.select("l_shipdate", "l_returnflag", F.col("l_orderkey").alias("k"), "l_linenumber", F.col("l_quantity").cast("int").alias("qty"))
    orders = t.orders.select("o_orderdate", "o_orderstatus", F.col("o_orderkey").alias("k"), "o_custkey")

    def parted(df, at, gone):
        old, new = df.filter(early(at)).withColumn("w", F.lit(1).cast("long")), df.filter(~early(at)).withColumn("w", F.lit(1).cast("long"))
        return old, new.unionByName(old.filter(gone).withColumn("w", F.lit(-1).cast("long")))

    (l, dl), (o, do) = parted(lines, "l_shipdate", "l_returnflag = 'R'"), parted(orders, "o_orderdate", "o_orderstatus = 'F'")
    none = lambda df: df.filter("false")
    before = join_changes(none(l), l, none(o), o, ["k"])
    changes = join_changes(l, dl, o, do, ["k"])
    now = updated(aggregate(before, ["o_custkey"], "qty"), aggregate_changes(before, changes, ["o_custkey"], "qty"), ["o_custkey"])
    return now.select("o_custkey", "n", *[F.col(c).cast("long").alias(c) for c in ("total", "lo", "hi")])


@query("""SELECT event_type, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, min(props) AS first_props
FROM events GROUP BY ALL""")
def source_arrow_files(t):
    """All events written as Arrow files and read back."""
    path = new_folder(t.events.sparkSession, "events-arrow")
    arrow_files.write(t.events, path)
    rows = arrow_files.read(t.events.sparkSession, path)
    day = F.date_trunc("day", F.col("ts").cast("timestamp")).cast("timestamp_ntz").alias("day")
    return rows.groupBy("event_type", day).agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"), dbl(F.sum(money("value"))).alias("total"), F.min("props").alias("first_props"))


@query("""WITH key AS (SELECT key AS path, json_type(props, '$."' || key || '"') AS kind FROM (SELECT props, unnest(json_keys(props)) AS key FROM events))
SELECT path, CASE WHEN bool_and(kind IN ('UBIGINT', 'BIGINT')) THEN 'bigint' WHEN bool_and(kind IN ('UBIGINT', 'BIGINT', 'DOUBLE')) THEN 'double' WHEN bool_and(kind = 'VARCHAR') THEN 'string' ELSE 'json' END AS type, count(*) AS n FROM key GROUP BY 1
UNION ALL SELECT '', 'object', count(*) FROM events""")
def json_shapes(t):
    """The paths of a JSON column with their types."""
    return shapes(t.events, "props").select("path", type_of(F.col("bits")).alias("type"), "n")


@query("SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, '{}' AS rest FROM events")
def json_shredded(t):
    """The frequent paths of a JSON column as typed columns."""
    events = t.events.select("event_id", "event_type", "props")
    return shred(events, "props", frequent(shapes(events, "props"), events.count(), 0.5)).drop("props")
