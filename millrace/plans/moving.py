"""Sources, sinks, unions, samples and graph queries."""

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.functions import times
from millrace.operators import graph, sampling, sets
from millrace.plans.registry import query
from millrace.plans.tables import LEGS, legs, table
from millrace.session import stage, stage_dir
from millrace.sources import archives, readers, sinks


def _fresh(spark, name):
    return f"{stage_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("parquet_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'")
def parquet_scan(spark, sf):
    df = readers.read_table(spark, f"{sf}/orders.parquet")
    return df.filter(F.col("o_orderdate") >= "1999-01-01").select("o_orderkey", "o_totalprice")


@query("csv_text_round_trip", "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name FROM supplier")
def csv_text_round_trip(spark, sf):
    path = _fresh(spark, "csv")
    table(spark, sf, "supplier").select("s_suppkey", "s_name").write.option("header", True).csv(path)
    return readers.read_csv(spark, f"{path}/*.csv")


@query("csv_typed_gzip", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def csv_typed_gzip(spark, sf):
    path = _fresh(spark, "csvgz")
    df = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    df.write.option("header", True).option("compression", "gzip").csv(path)
    return readers.read_csv(spark, f"{path}/*.csv.gz", "c_custkey bigint, c_name string, c_acctbal double")


@query("csv_inferred", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def csv_inferred(spark, sf):
    path = _fresh(spark, "csvinfer")
    table(spark, sf, "nation").write.option("header", True).csv(path)
    return readers.read_csv(spark, path, infer=True)


@query("generic_reader", "SELECT r_regionkey, r_name FROM region")
def generic_reader(spark, sf):
    return readers.read_any(spark, "parquet", f"{sf}/region.parquet")


@query("text_lines_round_trip", "SELECT p_name || ' ' || p_brand AS value, count(*) AS n FROM part GROUP BY 1")
def text_lines_round_trip(spark, sf):
    path, df = _fresh(spark, "lines"), table(spark, sf, "part")
    sinks.write_lines(df, F.concat_ws(" ", "p_name", "p_brand"), path)
    return readers.read_lines(spark, path).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query("json_field", """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def json_field(spark, sf):
    return table(spark, sf, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query("json_files", """SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS k, count(*) AS n FROM events GROUP BY 1""")
def json_files(spark, sf):
    path = _fresh(spark, "json")
    sinks.write_lines(table(spark, sf, "events"), F.col("props"), path)
    return readers.read_json(spark, path, "k int").groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@query("period_files", "SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) IN (1997, 1998) AND month(o_orderdate) <= 6")
def period_files(spark, sf):
    path = _fresh(spark, "periods")
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"))
    df.repartition("y", "m").write.partitionBy("y", "m").parquet(path)
    return readers.read_table(spark, readers.period_paths(f"{path}/y={{year}}/m={{month}}", [1997, 1998], range(1, 7)))


@query("listed_csv_files", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE year(o_orderdate) IN (1997, 1998) AND month(o_orderdate) <= 6")
def listed_csv_files(spark, sf):
    path = _fresh(spark, "listed")
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"))
    df.repartition("y", "m").write.option("header", True).partitionBy("y", "m").csv(path)
    found = readers.read_csv(spark, readers.period_paths(f"{path}/y={{year}}/m={{month}}", [1997, 1998], range(1, 7)), infer=True)
    return found.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "o_totalprice", "o_orderstatus")


@query(
    "archived_csv",
    """SELECT year(o_orderdate) || '.tar.gz' AS archive, o_orderstatus || '.csv' AS member, CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority
    FROM orders WHERE o_orderstatus <> 'P'""",
)
def archived_csv(spark, sf):
    path = _fresh(spark, "archives")
    df = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"), "o_orderstatus", "o_orderkey", "o_orderpriority")
    archives.write_tar_csv(df, path, "year", "o_orderstatus").collect()  # one row for each archive
    found = archives.read_tar_csv(spark, path, ["o_orderkey", "o_orderpriority"], members="[!P].csv")
    return found.withColumn("archive", F.regexp_extract("archive", "[^/]+$", 0))


@query("write_refused", "SELECT r_regionkey, r_name, true AS refused FROM region")
def write_refused(spark, sf):
    path, df = _fresh(spark, "once"), table(spark, sf, "region").select("r_regionkey", "r_name")
    sinks.write_table(df, path)
    try:
        sinks.write_table(df.limit(1), path)
        refused = False
    except AnalysisException:
        refused = True
    return readers.read_table(spark, path).withColumn("refused", F.lit(refused))


@query("staged_parquet", "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1")
def staged_parquet(spark, sf):
    return stage(table(spark, sf, "lineitem").select("l_returnflag")).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query("partitioned_write", "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders GROUP BY 1")
def partitioned_write(spark, sf):
    path = _fresh(spark, "byyear")
    df = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    sinks.write_table(df, path, overwrite=True, by=["year"])
    return readers.read_table(spark, path).groupBy("year").agg(F.count(F.lit(1)).alias("n"))


@query("dataset_disk_size")
def dataset_disk_size(spark, sf):
    return sinks.disk_size(spark, sf)


# Levels: region (1), nation (2), market segment (3), priority (4); the last lies past the depth limit.
_TREE_SQL = """s AS (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY 1, 2)
    SELECT CAST(r_regionkey AS INTEGER) AS i, r_name AS s, 1 AS d FROM region
    UNION ALL SELECT n_nationkey, n_name, 2 FROM nation
    UNION ALL SELECT CAST(n AS INTEGER), c_mktsegment, 3 FROM s"""


@query("flatten_tree", "WITH " + _TREE_SQL)
def flatten_tree(spark, sf):
    seg = table(spark, sf, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).cast("int").alias("n"))
    leaf = F.struct(F.lit(0).alias("i"), F.lit("too deep").alias("s"), F.lit(4).alias("d"))
    node = lambda i, s, d, c: F.struct(F.col(i).alias("i"), F.col(s).alias("s"), F.lit(d).alias("d"), c.alias("c"))
    seg = seg.groupBy("c_nationkey").agg(F.collect_list(node("n", "c_mktsegment", 3, F.array(leaf))).alias("kids"))
    nat = table(spark, sf, "nation").join(seg, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    nat = nat.withColumn("kids", F.coalesce("kids", F.array().cast(seg.schema["kids"].dataType)))
    nat = nat.groupBy("n_regionkey").agg(F.collect_list(node("n_nationkey", "n_name", 2, F.col("kids"))).alias("kids"))
    reg = table(spark, sf, "region").join(nat, F.col("r_regionkey") == F.col("n_regionkey"))
    tree = reg.agg(F.collect_list(node("r_regionkey", "r_name", 1, F.col("kids"))).alias("c"))
    return readers.flatten_tree(tree, max_depth=3)


# Batch b holds hours [100 b, 100 b + 110): each overlaps the next by ten hours.
_BATCHES = """h AS (SELECT event_id, user_id % 25 AS symbol, ts, date_diff('hour', TIMESTAMP '2024-01-01', ts) AS h FROM events),
    b AS (SELECT event_id, symbol, ts, h // 100 AS batch FROM h UNION ALL SELECT event_id, symbol, ts, h // 100 - 1 FROM h WHERE h % 100 < 10 AND h >= 100)"""


def _batches(spark, sf):
    hours = times.minutes_between(F.lit("2024-01-01").cast("timestamp"), F.date_trunc("hour", "ts")) / 60
    df = table(spark, sf, "events").select("event_id", (F.col("user_id") % 25).alias("symbol"), "ts", hours.cast("int").alias("h"))
    home = F.floor(F.col("h") / 100).cast("int")
    late = F.when((F.col("h") % 100 < 10) & (F.col("h") >= 100), F.array(home, home - 1)).otherwise(F.array(home))
    return df.withColumn("batch", F.explode(late)).drop("h")


@query(
    "merge_overlapping_batches",
    f"""WITH {_BATCHES}, s AS (SELECT symbol, batch, min(ts) AS start FROM b GROUP BY 1, 2),
    c AS (SELECT symbol, batch, min(start) OVER (PARTITION BY symbol ORDER BY batch ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS cut FROM s)
    SELECT event_id, symbol, CAST(batch AS INTEGER) AS batch FROM b JOIN c USING (symbol, batch)
    WHERE (cut IS NULL OR ts < cut) AND ts <= TIMESTAMP '2024-01-28'""",
)
def merge_overlapping_batches(spark, sf):
    out = readers.merge_batches(_batches(spark, sf), "symbol", "ts", "batch", F.lit("2024-01-28").cast("timestamp"))
    return out.select("event_id", "symbol", "batch")


@query(
    "union_eras_by_name",
    """SELECT o_orderkey AS id, o_totalprice AS price, NULL::VARCHAR AS flag FROM orders WHERE year(o_orderdate) < 1998
    UNION ALL SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE year(o_orderdate) >= 1998""",
)
def union_eras_by_name(spark, sf):
    o = table(spark, sf, "orders").withColumnsRenamed({"o_orderkey": "id", "o_totalprice": "price", "o_orderstatus": "flag"})
    old, new = F.year("o_orderdate") < 1998, F.year("o_orderdate") >= 1998
    return sets.stack([o.filter(old).select("id", "price"), o.filter(new).select("flag", "price", "id")])


@query(
    "union_by_position",
    "SELECT c_nationkey AS nation, c_acctbal AS balance FROM customer UNION ALL SELECT s_nationkey, s_acctbal FROM supplier",
)
def union_by_position(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))
    return sets.stack_by_position([c, table(spark, sf, "supplier").select("s_nationkey", "s_acctbal")])


@query(
    "first_occurrences",
    "SELECT props, min(event_id) AS event_id FROM events GROUP BY props",
)
def first_occurrences(spark, sf):
    return sets.first_occurrences(table(spark, sf, "events"), ["props"], ["event_id"])


@query("remove_matching", "SELECT p_partkey, p_name FROM part WHERE NOT regexp_matches(p_name, '^(red|blue)')")
def remove_matching(spark, sf):
    return sets.remove_matching(table(spark, sf, "part").select("p_partkey", "p_name"), "p_name", "^(red|blue)")


@query(
    "remove_listed",
    "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')",
)
def remove_listed(spark, sf):
    seen = table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return sets.remove_listed(table(spark, sf, "customer").select("c_custkey"), seen, ["c_custkey"])


@query(
    "trim_list_ends",
    """WITH c AS (SELECT conv_id, turn + 1 AS pos, role, max(turn + 1) OVER (PARTITION BY conv_id) AS last FROM conversations)
    SELECT conv_id, pos, role FROM c WHERE pos > 1 AND pos <= last - 1
    UNION ALL SELECT DISTINCT conv_id, 0, 'head' FROM conversations""",
)
def trim_list_ends(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", (F.col("turn") + 1).alias("pos"), "role")
    heads = c.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit("head").alias("role")).distinct()
    return sets.with_heads(sets.trim_ends(c, ["conv_id"], "pos", 1, 1), heads, "pos")


_UNIT = "CAST('0x' || substr(md5(concat_ws('|', {key}, '{seed}')), 1, 8) AS BIGINT) / 4294967296.0"


@query(
    "bernoulli_sample",
    f"SELECT event_id FROM events WHERE {_UNIT.format(key='event_id', seed=42)} < 0.1",
)
def bernoulli_sample(spark, sf):
    return sampling.bernoulli(table(spark, sf, "events"), 0.1, ["event_id"]).select("event_id")


@query(
    "random_split",
    f"""WITH u AS (SELECT doc_id, {_UNIT.format(key='doc_id', seed=42)} AS u FROM documents)
    SELECT doc_id, CASE WHEN u < 0.98 THEN 'fit' ELSE 'held' END AS part FROM u""",
)
def random_split(spark, sf):
    return sampling.random_split(table(spark, sf, "documents"), {"fit": 0.98, "held": 0.02}, ["doc_id"]).select("doc_id", "part")


@query(
    "train_test_split",
    f"""WITH u AS (SELECT o_orderkey, {_UNIT.format(key='o_orderkey', seed=42)} AS u FROM orders)
    SELECT o_orderkey, CASE WHEN u < 0.8 THEN 'train' ELSE 'test' END AS part FROM u""",
)
def train_test_split(spark, sf):
    return sampling.random_split(table(spark, sf, "orders"), {"train": 0.8, "test": 0.2}, ["o_orderkey"]).select("o_orderkey", "part")


@query("first_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1000")
def first_rows(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return sampling.first_rows(df, 1000, [F.desc("o_totalprice"), F.asc("o_orderkey")])


@query("positional_slice", "SELECT event_id FROM events ORDER BY ts, event_id OFFSET 737")
def positional_slice(spark, sf):
    return sampling.slice_rows(table(spark, sf, "events"), ["ts", "event_id"], 737).select("event_id")


# Trade graph: customer nation to supplier nation per order year.
_TRADE = """trade AS (SELECT year(o_orderdate) AS year, c_nationkey AS src, s_nationkey AS dst, l_extendedprice AS price, c_mktsegment AS seg
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey)"""


def _trade(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("src"), F.col("c_mktsegment").alias("seg"))
    s = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("dst"))
    joined = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey"))
    joined = joined.join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    return joined.select("year", "src", "dst", F.col("l_extendedprice").alias("price"), "seg")


@query(
    "graph_vertices",
    f"""WITH {_TRADE}, e AS (SELECT year, src AS id, 0 AS p, seg AS label FROM trade UNION ALL SELECT year, dst, 1, 'supplier' FROM trade)
    SELECT CAST(year AS INTEGER) AS year, CAST(id AS INTEGER) AS id, arg_min(label, (p, label)) AS label FROM e GROUP BY 1, 2""",
)
def graph_vertices(spark, sf):
    df = _trade(spark, sf).withColumn("side", F.lit("supplier"))
    return graph.vertices(df, "year", {"id": "src", "label": "seg"}, {"id": "dst", "label": "side"})


@query(
    "edge_weights",
    f"WITH {_TRADE} SELECT CAST(year AS INTEGER) AS year, src, dst, round(CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / count(*), 6) AS weight FROM trade GROUP BY 1, 2, 3",
)
def edge_weights(spark, sf):
    trade = _trade(spark, sf).withColumn("price", F.col("price").cast("decimal(18,2)"))
    return graph.edge_weights(trade, "year", "src", "dst", "price").withColumn("weight", F.col("weight").cast("double"))


_DEG = f"""{LEGS}, q AS (SELECT year(day) || '-Q' || quarter(day) AS period, origin % 50 AS src, dest AS dst, leg_id, line, distance FROM legs),
    i AS (SELECT period, dst AS id, count(*) AS n FROM q GROUP BY 1, 2), o AS (SELECT period, src AS id, count(*) AS n FROM q GROUP BY 1, 2),
    g AS (SELECT coalesce(i.period, o.period) AS period, coalesce(i.id, o.id) AS id, coalesce(i.n, 0) AS in_degree, coalesce(o.n, 0) AS out_degree
      FROM i FULL JOIN o ON i.period = o.period AND i.id = o.id)"""


def _quarters(spark, sf):
    return legs(spark, sf).select(
        times.year_quarter(F.col("day")).alias("period"), (F.col("origin") % 50).alias("src"), F.col("dest").alias("dst"), "leg_id", "line", "distance"
    )


@query("degrees_by_period", f"WITH {_DEG} SELECT * FROM g")
def degrees_by_period(spark, sf):
    return graph.degrees(_quarters(spark, sf), "period", "src", "dst")


@query(
    "lagged_end_degrees",
    f"""WITH {_DEG}, l AS (SELECT *, coalesce(lag(in_degree) OVER w, in_degree) AS in_degree_lag, coalesce(lag(out_degree) OVER w, out_degree) AS out_degree_lag
      FROM g WINDOW w AS (PARTITION BY id ORDER BY period))
    SELECT leg_id, line, distance, a.in_degree AS src_in_degree, a.out_degree_lag AS src_out_degree_lag, b.in_degree_lag AS dst_in_degree_lag
    FROM q JOIN l a ON q.src = a.id AND q.period = a.period JOIN l b ON q.dst = b.id AND q.period = b.period""",
)
def lagged_end_degrees(spark, sf):
    df = _quarters(spark, sf)
    out = graph.attach_end_metrics(df, graph.degrees(df, "period", "src", "dst"), "period", ["src", "dst"], ["in_degree", "out_degree"])
    return out.select("leg_id", "line", "distance", "src_in_degree", "src_out_degree_lag", "dst_in_degree_lag")


def _yearly_routes(spark, sf):
    return legs(spark, sf).select(F.year("day").alias("year"), "origin", "dest")


def _rank_rounds(n: int) -> str:
    steps = ["r0 AS (SELECT year, id, 1.0::DOUBLE AS rank FROM v)"]
    for i in range(1, n + 1):
        steps.append(
            f"""r{i} AS (SELECT v.year, v.id, 0.15 + 0.85 * coalesce(sum(r.rank / o.n), 0) AS rank FROM v
            LEFT JOIN e ON e.year = v.year AND e.dst = v.id LEFT JOIN o ON o.year = e.year AND o.src = e.src
            LEFT JOIN r{i - 1} r ON r.year = e.year AND r.id = e.src GROUP BY 1, 2)"""
        )
    return ", ".join(steps)


@query(
    "pagerank_by_year",
    f"""WITH {LEGS}, e AS MATERIALIZED (SELECT DISTINCT year(day) AS year, origin AS src, dest AS dst FROM legs),
    v AS MATERIALIZED (SELECT year, src AS id FROM e UNION SELECT year, dst FROM e), o AS (SELECT year, src, count(*) AS n FROM e GROUP BY 1, 2), {_rank_rounds(8)}
    SELECT CAST(year AS INTEGER) AS year, id, round(rank * count(*) OVER (PARTITION BY year) / sum(rank) OVER (PARTITION BY year), 8) AS pagerank FROM r8""",
)
def pagerank_by_year(spark, sf):
    out = graph.pagerank(_yearly_routes(spark, sf), "year", "origin", "dest", tolerance=None, rounds=8)
    return out.withColumn("pagerank", F.round("pagerank", 8))


@query("pagerank_to_tolerance")
def pagerank_to_tolerance(spark, sf):
    return graph.pagerank(_yearly_routes(spark, sf), "year", "origin", "dest")
