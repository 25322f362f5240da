"""The general operators on the star-schema and stream tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scalars
from tidemark.operators import dedupe, followon, series, views
from tidemark.plans.log import _pairs_sql
from tidemark.plans.registry import query
from tidemark.session import table

_EVENT_PAIRS = [("error", "purchase"), ("signup", "purchase"), ("view", "click"), ("click", "error")]
_LINE_PAIRS = [("R", "A"), ("A", "R"), ("N", "R"), ("R", "N")]


@query(_pairs_sql("SELECT user_id AS entity, event_type AS kind, ts::DATE AS day FROM events WHERE ts::DATE <= DATE '2024-01-20'", _EVENT_PAIRS, 3))
def followon_events(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_type", F.to_date("ts").alias("day"))
    return followon.follow_on(e, "user_id", "event_type", "day", _EVENT_PAIRS, 3, F.lit("2024-01-20").cast("date"))


@query(_pairs_sql("SELECT l_suppkey AS entity, l_returnflag AS kind, l_shipdate::DATE AS day FROM lineitem", _LINE_PAIRS, 540))
def followon_lineitem(spark, sf):
    e = table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", F.to_date("l_shipdate").alias("day"))
    as_of = F.lit(e.agg(F.max("day")).first()[0])
    return followon.follow_on(e, "l_suppkey", "l_returnflag", "day", _LINE_PAIRS, 540, as_of)


_O = "SELECT o_orderkey AS k, o_custkey AS c, o_orderpriority AS p, o_orderdate::DATE AS d, o_orderstatus AS s FROM orders"


def _orders(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.col("o_orderpriority").alias("p"), F.to_date("o_orderdate").alias("d"), F.col("o_orderstatus").alias("s"))


@query(f"WITH o AS ({_O}) SELECT k, max(d) OVER w AS prior_d, max(struct_pack(d := d, k := k)) OVER w AS x FROM o WINDOW w AS (PARTITION BY c, p ORDER BY d RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING)".replace("SELECT k, max(d) OVER w AS prior_d, max(struct_pack(d := d, k := k)) OVER w AS x", "SELECT k, max(d) OVER w AS prior_d, (max(struct_pack(d := d, k := k)) OVER w).k AS prior_k"))
def prior_orders(spark, sf):
    """The as-of self-join on orders: same customer and priority, strictly earlier day."""
    return series.prior_in_series(_orders(spark, sf), ["c", "p"], "d", "k", ["k"]).select("k", "prior_d", "prior_k")


@query(f"WITH o AS ({_O}), q AS (SELECT k, s, lag(s) OVER (PARTITION BY c ORDER BY d, k) AS prior_s FROM o) SELECT k, s, prior_s, CASE WHEN list_position(['O', 'P', 'F'], s) > list_position(['O', 'P', 'F'], prior_s) THEN 'escalated' ELSE 'eased' END AS direction FROM q WHERE s <> prior_s")
def order_transitions(spark, sf):
    stepped = series.previous(_orders(spark, sf), ["c"], "d", ["k"], "s")
    return series.transitions(stepped.select("k", "s", "prior_s"), "s", "prior_s", ["O", "P", "F"])


@query(f"""
WITH o AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY d, k) AS pos FROM ({_O})),
     b AS (SELECT a.k, a.pos, coalesce(max(x.pos), greatest(a.pos - 7, 0)) AS stop FROM o a LEFT JOIN o x ON x.c = a.c AND x.pos BETWEEN a.pos - 6 AND a.pos - 1 AND x.s <> 'F' GROUP BY a.k, a.pos)
SELECT o.k, (b.pos - 1 - b.stop)::INT AS run_len, (SELECT y.d FROM o y WHERE y.c = o.c AND y.pos = b.stop + 1 AND b.stop + 1 < b.pos) AS run_start FROM o JOIN b ON b.k = o.k
""")
def weakness_span(spark, sf):
    """For each order the unbroken run of finished ones right before it, at most six back."""
    return series.run_before(_orders(spark, sf), ["c"], "d", "k", F.col("s") == "F").select("k", "run_len", "run_start")


@query("""
WITH a AS (SELECT o_custkey AS cik, max(o_totalprice) AS assets, count(*) AS shares FROM orders GROUP BY 1)
SELECT c_custkey AS cik, c_acctbal * 1e3 AS val, c_acctbal > 0 AND c_acctbal * 1e3 < 1e13 AND coalesce(a.assets = 0 OR c_acctbal * 1e3 <= a.assets * 100, true) AND coalesce(a.shares = 0 OR c_acctbal * 1e3 <= a.shares * 10000.0, true) AS plausible
FROM customer LEFT JOIN a ON a.cik = c_custkey
""")
def plausible_float(spark, sf):
    """Values checked against two other measures where these are known."""
    o = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("cik")).agg(F.max("o_totalprice").alias("assets"), F.count(F.lit(1)).cast("double").alias("shares"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("cik"), (F.col("c_acctbal") * 1e3).alias("val"))
    return c.join(o, "cik", "left").select("cik", "val", scalars.plausible_float(F.col("val"), F.col("assets"), F.col("shares")).alias("plausible"))


@query("SELECT event_type, ts::DATE AS day, count(*) AS n, round(sum(value), 4) AS total, max(CAST(json_extract(props, '$.k') AS INT)) AS top_k FROM events GROUP BY ALL")
def events_by_day(spark, sf):
    e = table(spark, sf, "events").withColumn("k", F.from_json("props", "k int")["k"])
    return e.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"), F.max("k").alias("top_k"))


@query("WITH e AS (SELECT event_id, user_id, event_type FROM events UNION ALL SELECT event_id, user_id, event_type FROM events WHERE event_id % 3 = 0) SELECT event_id, any_value(user_id) AS user_id, count(*) AS seen FROM e GROUP BY 1")
def replayed_events(spark, sf):
    """A batch that is sent again adds nothing."""
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    both = e.unionByName(e.filter("event_id % 3 = 0"))
    return both.groupBy("event_id").agg(F.first("user_id").alias("user_id"), F.count(F.lit(1)).alias("seen"))


@query("WITH s AS (SELECT l_partkey AS p, l_suppkey AS s, lag(l_suppkey) OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber) AS f FROM lineitem), m AS (SELECT f AS k, 1 AS l, 0 AS j FROM s WHERE f <> s UNION ALL SELECT s, 0, 1 FROM s WHERE f <> s) SELECT k AS supplier, s_name AS name, sum(l)::BIGINT AS \"left\", sum(j)::BIGINT AS joined, sum(j)::BIGINT - sum(l)::BIGINT AS net FROM m JOIN supplier ON s_suppkey = k GROUP BY ALL")
def supplier_movement(spark, sf):
    """Suppliers that parts moved from and to."""
    lines = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber")
    stepped = series.previous(lines, ["l_partkey"], "l_shipdate", ["l_shipdate", "l_orderkey", "l_linenumber"], "l_suppkey")
    s = stepped.select(F.col("prior_l_suppkey").alias("f"), F.col("l_suppkey").alias("s")).filter("f <> s")
    m = s.select(F.inline(F.array(F.struct(F.col("f").alias("supplier"), F.lit(1).alias("l"), F.lit(0).alias("j")), F.struct(F.col("s").alias("supplier"), F.lit(0).alias("l"), F.lit(1).alias("j")))))
    counted = m.groupBy("supplier").agg(F.sum("l").alias("left"), F.sum("j").alias("joined"))
    names = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("supplier"), F.col("s_name").alias("name"))
    return counted.join(names, "supplier").select("supplier", "name", "left", "joined", (F.col("joined") - F.col("left")).alias("net"))


@query("SELECT o_orderpriority AS p, o_orderkey AS k, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders QUALIFY rank <= 12")
def top_orders(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("p"), F.col("o_orderkey").alias("k"), "o_totalprice")
    return series.top_per_group(o, ["p"], 12, F.desc("o_totalprice"), F.asc("k")).select("p", "k", "rank")


@query("SELECT n, CASE WHEN n >= 1e12 THEN CASE WHEN n/1e12 < 10 THEN printf('%.2f', n/1e12) WHEN n/1e12 < 100 THEN printf('%.1f', n/1e12) ELSE printf('%.0f', n/1e12) END || 'T' WHEN n >= 1e9 THEN CASE WHEN n/1e9 < 10 THEN printf('%.2f', n/1e9) WHEN n/1e9 < 100 THEN printf('%.1f', n/1e9) ELSE printf('%.0f', n/1e9) END || 'B' WHEN n >= 1e6 THEN CASE WHEN n/1e6 < 10 THEN printf('%.2f', n/1e6) WHEN n/1e6 < 100 THEN printf('%.1f', n/1e6) ELSE printf('%.0f', n/1e6) END || 'M' ELSE format('{:,}', n) END AS shown FROM (SELECT DISTINCT CAST(floor(o_totalprice * o_totalprice) AS BIGINT) AS n FROM orders)")
def figures(spark, sf):
    """Large numbers as headlines show them."""
    n = table(spark, sf, "orders").select(F.floor(F.col("o_totalprice") * F.col("o_totalprice")).cast("long").alias("n")).distinct()
    return n.select("n", scalars.figure(F.col("n")).alias("shown"))


@query("""
WITH l AS (SELECT timezone('America/New_York', timezone('UTC', ts::TIMESTAMP)) AS t FROM events)
SELECT CASE WHEN hour(t) >= 23 THEN t::DATE ELSE t::DATE - 1 END AS day, count(*) AS events FROM l GROUP BY 1
""")
def last_complete_day(spark, sf):
    """Events by the last filing day that was complete when they came."""
    return table(spark, sf, "events").groupBy(scalars.last_complete_day(F.col("ts")).alias("day")).agg(F.count(F.lit(1)).alias("events"))


@query("SELECT o_custkey AS c, min(o_orderkey) AS k, count(*) AS n FROM orders GROUP BY 1")
def first_orders(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("c"), F.col("o_orderkey").alias("k"))
    n = o.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    return dedupe.first_of(o, ["c"], "k").join(n, "c").select("c", "k", "n")


@query("SELECT event_type, count(*) AS events, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM events GROUP BY 1")
def event_mix(spark, sf):
    return views.mix(table(spark, sf, "events"), "event_type")
