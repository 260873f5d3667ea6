"""Link, paragraph, text-pair, scalar and overlap-score queries."""

from pyspark.sql import functions as F

from millrace.functions import conditions, maths, strings, times
from millrace.operators import joins, profile, sets, text, web
from millrace.plans.registry import query
from millrace.plans.tables import LEGS, legs, table

# Comments, scripts and style sheets are removed before anchors are read.
_VISIBLE = "regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script>|<style\\b.*?</style>', '', 'g')"
_LINKS = f"""v AS (SELECT page_id, url, {_VISIBLE} AS html FROM pages),
    a AS (SELECT page_id, url, regexp_extract_all(html, '(?is)<a\\s[^>]*?href\\s*=\\s*"([^"]*)"', 1) AS hrefs FROM v),
    links AS (SELECT page_id, url, unnest(range(len(hrefs))) AS pos, unnest(hrefs) AS href FROM a)"""
_SITE = "regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)', 1)"


def _links(spark, sf):
    return web.extract_links(table(spark, sf, "pages"))


@query("links", f"WITH {_LINKS} SELECT page_id, CAST(pos AS INTEGER) AS pos, href FROM links")
def links(spark, sf):
    return _links(spark, sf)


@query(
    "links_filtered",
    f"WITH {_LINKS} SELECT page_id, href, CAST(min(pos) AS INTEGER) AS pos FROM links WHERE regexp_matches(href, '^/[a-z]+') GROUP BY 1, 2",
)
def links_filtered(spark, sf):
    return web.matching_links(_links(spark, sf), "^/[a-z]+", ["page_id"])


@query("links_once_overall", f"WITH {_LINKS} SELECT href, min(page_id) AS page_id, CAST(arg_min(pos, (page_id, pos)) AS INTEGER) AS pos FROM links GROUP BY 1")
def links_once_overall(spark, sf):
    return sets.first_occurrences(_links(spark, sf), ["href"], ["page_id", "pos"])


@query(
    "pooled_start_pages",
    f"""WITH {_LINKS}, p AS (SELECT CASE WHEN url LIKE 'https:%' THEN 0 ELSE 1 END AS source_no, page_id, pos, href FROM links)
    SELECT href, min(source_no) AS source_no, CAST(arg_min(page_id, (source_no, page_id, pos)) AS BIGINT) AS page_id,
    CAST(arg_min(pos, (source_no, page_id, pos)) AS INTEGER) AS pos FROM p GROUP BY href""",
)
def pooled_start_pages(spark, sf):
    pages = table(spark, sf, "pages")
    lists = [web.extract_links(pages.filter(cond)) for cond in ("url LIKE 'https:%'", "NOT url LIKE 'https:%'")]
    return sets.first_occurrences(sets.stack_sources(lists), ["href"], ["source_no", "page_id", "pos"])


@query("service_links_dropped", f"WITH {_LINKS} SELECT page_id, CAST(pos AS INTEGER) AS pos, href FROM links WHERE NOT regexp_matches(href, '^/(The|De)')")
def service_links_dropped(spark, sf):
    return web.drop_service_links(_links(spark, sf), "^/(The|De)")


@query("absolute_urls", f"WITH {_LINKS} SELECT page_id, CAST(pos AS INTEGER) AS pos, href, {_SITE} || href AS url FROM links")
def absolute_urls(spark, sf):
    return web.absolute_links(_links(spark, sf), table(spark, sf, "pages"))


@query("path_segment", "SELECT page_id, split_part(split_part(url, '://', 2), '/', 2) AS segment FROM pages")
def path_segment(spark, sf):
    return table(spark, sf, "pages").select("page_id", strings.path_segment(F.col("url"), "://", 2).alias("segment"))


_TREE = f"""{_LINKS}, t AS (SELECT {_SITE} AS parent, page_id AS pos, url AS href FROM pages
      UNION ALL SELECT url, pos, {_SITE} || href FROM links),
    seeds AS (SELECT DISTINCT {_SITE} AS parent, 0 AS seed_pos FROM pages),
    one AS (SELECT href, min(pos) AS pos1 FROM t JOIN seeds USING (parent) GROUP BY href),
    two AS (SELECT t.href, min((pos1, t.pos)) AS spot FROM one JOIN t ON t.parent = one.href WHERE t.href NOT IN (SELECT href FROM one) GROUP BY t.href)"""


@query(
    "two_level_links",
    f"""WITH {_TREE} SELECT href, CAST(pos1 AS BIGINT) AS pos1, NULL::BIGINT AS pos2, 1 AS level FROM one
    UNION ALL SELECT href, CAST(spot[1] AS BIGINT), CAST(spot[2] AS BIGINT), 2 FROM two""",
)
def two_level_links(spark, sf):
    pages = table(spark, sf, "pages")
    site = strings.site_of(F.col("url"))
    top = pages.select(site.alias("parent"), F.col("page_id").alias("pos"), F.col("url").alias("href"))
    found = web.absolute_links(_links(spark, sf), pages)
    below = found.join(pages.select("page_id", F.col("url").alias("parent")), "page_id")
    every = top.unionByName(below.select("parent", F.col("pos").cast("long").alias("pos"), F.col("url").alias("href")))
    seeds = pages.select(site.alias("parent"), F.lit(0).alias("seed_pos")).distinct()
    return web.expand_links(every, seeds).drop("seed_pos")


@query(
    "contents_with_heads",
    f"""WITH {_LINKS}, g AS (SELECT *, substr(href, 2, 1) AS g FROM links),
    h AS (SELECT *, CASE WHEN lag(g) OVER w IS DISTINCT FROM g THEN 1 ELSE 0 END AS head FROM g WINDOW w AS (PARTITION BY page_id ORDER BY pos))
    SELECT page_id, CAST(pos AS INTEGER) AS pos, 1 AS kind, href AS entry FROM h
    UNION ALL SELECT page_id, CAST(pos AS INTEGER), 0, 'chapter ' || g FROM h WHERE head = 1""",
)
def contents_with_heads(spark, sf):
    group = F.substring("href", 2, 1)
    return web.contents_with_heads(_links(spark, sf), ["page_id"], "pos", group, F.concat(F.lit("chapter "), F.col("__g")))


_HEADS = ("The", "In", "De", "Is", "An", "En")


@query(
    "heading_paragraphs",
    f"""WITH v AS (SELECT page_id, regexp_replace({_VISIBLE}, '(?i)<p\\b', '</p><p', 'g') AS html FROM pages),
    p AS (SELECT page_id, regexp_extract_all(html, '(?is)<p\\b[^>]*>.*?</p>') AS ps FROM v),
    r AS (SELECT page_id, unnest(range(len(ps))) AS pos, unnest(ps) AS p FROM p),
    h(heading) AS (VALUES {", ".join(f"('{h}')" for h in _HEADS)})
    SELECT page_id, CAST(pos AS INTEGER) AS pos, heading, regexp_replace(p, '<.*?>', '', 'g') AS text FROM r, h WHERE contains(p, '<b>' || heading)""",
)
def heading_paragraphs(spark, sf):
    return web.heading_paragraphs(table(spark, sf, "pages"), _HEADS, mark="b")


@query("strip_tags", "SELECT page_id, md5(regexp_replace(html, '<.*?>', '', 'g')) AS text FROM pages")
def strip_tags(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.md5(strings.strip_tags(F.col("html"))).alias("text"))


@query(
    "clean_pages",
    f"""SELECT page_id, md5(regexp_replace(regexp_replace(regexp_replace(html, '<head>', '{strings.CHARSET_META}', 'g'),
    '<img alt.+?/>', '', 'g'), '<link href.+?/>', '', 'g')) AS html FROM pages""",
)
def clean_pages(spark, sf):
    return web.clean_pages(table(spark, sf, "pages")).select("page_id", F.md5("html").alias("html"))


def _code_lines(spark, sf):
    line = F.concat(F.col("p_name"), F.lit(" HS Code: "), F.col("p_partkey") % 700, F.lit("\n"))
    return table(spark, sf, "part").select("p_partkey", line.alias("line"))


@query(
    "find_codes",
    """SELECT DISTINCT unnest(regexp_extract_all(p_name || ' HS Code: ' || p_partkey % 700 || chr(10), 'HS Code: (\\d+)\\n', 1)) AS code FROM part""",
)
def find_codes(spark, sf):
    return text.label_codes(_code_lines(spark, sf), "line")


@query("code_count", "SELECT count(DISTINCT p_partkey % 700) AS n_distinct FROM part")
def code_count(spark, sf):
    return profile.distinct_count(text.label_codes(_code_lines(spark, sf), "line"), ["code"])


@query(
    "codes_still_to_do",
    "SELECT CAST(o_orderkey AS VARCHAR) AS code FROM orders WHERE o_orderkey NOT IN (SELECT p_partkey % 700 FROM part)",
)
def codes_still_to_do(spark, sf):
    todo = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("code"))
    return joins.unseen(todo, text.label_codes(_code_lines(spark, sf), "line"), ["code"])


_S = "p_name AS s1, CASE WHEN p_partkey % 5 <> 0 THEN p_brand END AS s2, p_type AS s3"


def _sentences(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", F.col("p_name").alias("s1"), F.when(F.col("p_partkey") % 5 != 0, F.col("p_brand")).alias("s2"), F.col("p_type").alias("s3")
    )


@query("story_pairs_strict", f"WITH t AS (SELECT p_partkey, {_S} FROM part) SELECT p_partkey, s1 || ' ' || s2 AS context, s3 AS ending FROM t")
def story_pairs_strict(spark, sf):
    return text.story_pairs(_sentences(spark, sf), "p_partkey", ["s1", "s2"], "s3")


@query("story_pairs_skip_null", f"WITH t AS (SELECT p_partkey, {_S} FROM part) SELECT p_partkey, concat_ws(' ', s1, s2) AS context, s3 AS ending FROM t")
def story_pairs_skip_null(spark, sf):
    return text.story_pairs(_sentences(spark, sf), "p_partkey", ["s1", "s2"], "s3", "skip")


@query(
    "cloze_pairs",
    """SELECT o_orderkey, o_orderstatus || ' ' || o_orderpriority AS context,
    CASE WHEN o_custkey % 2 + 1 = 1 THEN 'first ' || o_custkey ELSE 'second ' || o_orderdate::DATE END AS ending FROM orders""",
)
def cloze_pairs(spark, sf):
    df = table(spark, sf, "orders").withColumns(
        {
            "one": F.concat(F.lit("first "), F.col("o_custkey")),
            "two": F.concat(F.lit("second "), F.to_date("o_orderdate").cast("string")),
            "answer": F.col("o_custkey") % 2 + 1,
        }
    )
    return text.cloze_pairs(df, "o_orderkey", ["o_orderstatus", "o_orderpriority"], "one", "two", "answer")


@query("full_story", "SELECT p_partkey, p_name || ' ' || p_brand || ' ' || p_type AS story FROM part")
def full_story(spark, sf):
    df = table(spark, sf, "part")
    return text.full_story(text.story_pairs(df, "p_partkey", ["p_name", "p_brand"], "p_type")).select("p_partkey", "story")


_PROMPT_HEAD = f"{strings.PROMPT_HEAD}### Instruction:\n{strings.PROMPT_INSTRUCTION}\n\n{strings.INPUT_MARK}\n"
_PROMPT = f"'{_PROMPT_HEAD}' || text || '\n\n{strings.RESPONSE_MARK} '"


@query("prompt", f"SELECT doc_id, md5({_PROMPT}) AS prompt FROM documents")
def prompt(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(strings.prompt("text")).alias("prompt"))


@query("one_line_text", "SELECT doc_id, md5(replace(replace(replace(text, chr(10), ''), chr(13), ''), '<br>', '')) AS text FROM documents")
def one_line_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(strings.one_line(F.col("text"))).alias("text"))


@query(
    "parse_generated_text",
    f"""WITH g AS (SELECT doc_id, regexp_replace({_PROMPT} || source || ' it ends.', '\\n|\\r|<br>', '', 'g') AS t FROM documents),
    p AS (SELECT *, strpos(t, '### Input:') AS a, strpos(t, '### Response:') AS b FROM g)
    SELECT doc_id, md5(substr(t, a + 10, greatest(b - a - 10, 0))) AS beginning, substr(t, b + 13) AS ending FROM p""",
)
def parse_generated_text(spark, sf):
    df = table(spark, sf, "documents").withColumn("g", F.concat(strings.prompt("text"), F.col("source"), F.lit(" it ends.")))
    return text.parse_generated(df, "g").select("doc_id", F.md5("beginning").alias("beginning"), "ending")


@query(
    "drop_first_sentences",
    """WITH s AS (SELECT doc_id, string_split(regexp_replace(text, '([.!?])[\\s"]+', '\\1' || chr(1), 'g'), chr(1)) AS s FROM documents)
    SELECT doc_id, md5(array_to_string(s[5:], ' ')) AS text FROM s""",
)
def drop_first_sentences(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(strings.drop_sentences(F.col("text"))).alias("text"))


@query(
    "empty_after_drop",
    """WITH s AS (SELECT doc_id, string_split(regexp_replace(text, '([.!?])[\\s"]+', '\\1' || chr(1), 'g'), chr(1)) AS s FROM documents)
    SELECT doc_id FROM s WHERE trim(array_to_string(s[5:], ' ')) = ''""",
)
def empty_after_drop(spark, sf):
    df = table(spark, sf, "documents").select("doc_id", strings.drop_sentences(F.col("text")).alias("rest"))
    return text.empty_results(df, "rest").select("doc_id")


_PAIRS = """c AS (SELECT u.conv_id, u.turn, u.text AS p, a.text AS r FROM conversations u JOIN conversations a
      ON u.conv_id = a.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant'),
    w AS (SELECT conv_id, turn, regexp_extract_all(lower(p), '[a-z0-9]+') AS p, regexp_extract_all(lower(r), '[a-z0-9]+') AS r FROM c)"""
_GRAMS = {
    1: "{c}",
    2: "list_transform(range(1, len({c})), lambda i: {c}[i] || ' ' || {c}[i + 1])",
}


def _rouge_sql(n: int) -> str:
    g = _GRAMS[n]
    return f"""WITH {_PAIRS}, g AS (SELECT conv_id, turn, unnest({g.format(c="p")}) AS gram, 1 AS p, 0 AS r FROM w
      UNION ALL SELECT conv_id, turn, unnest({g.format(c="r")}), 0, 1 FROM w UNION ALL SELECT conv_id, turn, NULL, 0, 0 FROM w),
    k AS (SELECT conv_id, turn, gram, sum(p) AS p, sum(r) AS r FROM g GROUP BY 1, 2, 3),
    s AS (SELECT conv_id, turn, CAST(sum(least(p, r)) AS BIGINT) AS overlap, CAST(sum(p) AS BIGINT) AS n_pred, CAST(sum(r) AS BIGINT) AS n_ref FROM k GROUP BY 1, 2),
    q AS (SELECT *, coalesce(overlap / nullif(n_pred, 0), 0) AS a, coalesce(overlap / nullif(n_ref, 0), 0) AS b FROM s)"""


def _turn_pairs(spark, sf):
    c = table(spark, sf, "conversations")
    p = c.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("p"))
    r = c.filter("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("r"))
    return joins.pair_rows(p, r, ["conv_id", "turn"])


def _scores(df):
    return df.withColumns({c: F.round(c, 8) for c in ("precision", "recall", "f1")})


_ROUGE_COLS = """SELECT conv_id, turn, overlap, n_pred, n_ref, round(a, 8) AS precision, round(b, 8) AS recall,
    round(coalesce(2 * a * b / nullif(a + b, 0), 0), 8) AS f1 FROM q"""


@query("rouge1", _rouge_sql(1) + _ROUGE_COLS)
def rouge1(spark, sf):
    return _scores(text.rouge_n(_turn_pairs(spark, sf), ["conv_id", "turn"], "p", "r", 1))


@query("rouge2", _rouge_sql(2) + _ROUGE_COLS)
def rouge2(spark, sf):
    return _scores(text.rouge_n(_turn_pairs(spark, sf), ["conv_id", "turn"], "p", "r", 2))


@query("rouge_l")
def rouge_l(spark, sf):
    return _scores(text.rouge_l(_turn_pairs(spark, sf), ["conv_id", "turn"], "p", "r"))


@query(
    "mean_rouge1",
    _rouge_sql(1) + "SELECT round(avg(a), 6) AS precision, round(avg(b), 6) AS recall, round(avg(coalesce(2 * a * b / nullif(a + b, 0), 0)), 6) AS f1, count(*) AS n FROM q",
)
def mean_rouge1(spark, sf):
    out = text.mean_scores(text.rouge_n(_turn_pairs(spark, sf), ["conv_id", "turn"], "p", "r", 1))
    return out.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


# --- scalar functions over whole tables ---------------------------------------


@query(
    "iso_text_timestamps",
    """SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS seconds FROM events""",
)
def iso_text_timestamps(spark, sf):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return table(spark, sf, "events").select(
        "event_id", times.year_of_iso(iso).alias("year"), F.unix_timestamp(times.timestamp_of_iso(iso)).alias("seconds")
    )


@query(
    "packed_pair_split",
    "SELECT c_custkey, round(CAST(c_custkey / 8 AS FLOAT)::DOUBLE, 6) AS lon, round(CAST(-c_custkey / 16 AS FLOAT)::DOUBLE, 6) AS lat FROM customer",
)
def packed_pair_split(spark, sf):
    df = table(spark, sf, "customer").select(
        "c_custkey", F.concat_ws(", ", (F.col("c_custkey") / 8).cast("string"), (-F.col("c_custkey") / 16).cast("string")).alias("pair")
    )
    return df.select(
        "c_custkey", F.round(strings.packed_part("pair", 1).cast("double"), 6).alias("lon"), F.round(strings.packed_part("pair", 2).cast("double"), 6).alias("lat")
    )


@query(
    "clock_texts",
    f"""WITH {LEGS} SELECT leg_id, line, distance, lpad((hhmm // 100)::VARCHAR, 2, '0') || ':' || lpad((hhmm % 100)::VARCHAR, 2, '0') AS clock,
    lpad((hhmm // 100)::VARCHAR, 2, '0') || '00-' || lpad((hhmm // 100 + 1)::VARCHAR, 2, '0') || '59' AS block, (hhmm // 100) || '_' || (hhmm % 100 // 15) AS bucket FROM legs""",
)
def clock_texts(spark, sf):
    h = F.col("hhmm")
    return legs(spark, sf).select(
        "leg_id", "line", "distance", times.clock_text(h).alias("clock"), times.block_label(h).alias("block"), times.quarter_hour_bucket(h).alias("bucket")
    )


@query(
    "local_to_utc",
    f"""WITH {LEGS} SELECT leg_id, line, distance, CAST(epoch(timezone('America/Phoenix', day + INTERVAL 1 MINUTE * CAST(hhmm // 100 * 60 + hhmm % 100 AS INTEGER))) AS BIGINT) AS utc,
    CAST(epoch(date_trunc('hour', timezone('America/Phoenix', day + INTERVAL 1 MINUTE * CAST(hhmm // 100 * 60 + hhmm % 100 AS INTEGER)) - INTERVAL 4 HOUR)) AS BIGINT) AS bucket FROM legs""",
)
def local_to_utc(spark, sf):
    # A zone without clock changes: engines differ on skipped and repeated local times.
    df = legs(spark, sf)
    utc = times.to_utc(times.at_clock(F.col("day"), F.col("hhmm")), F.lit("America/Phoenix"))
    return df.select(
        "leg_id", "line", "distance", F.unix_timestamp(utc).alias("utc"), F.unix_timestamp(times.hour_bucket(times.shift_hours(utc, -4))).alias("bucket")
    )


@query(
    "us_date_texts",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso FROM orders",
)
def us_date_texts(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "M/d/yyyy h:mm:ss a").alias("us"))
    return df.select("o_orderkey", times.us_text_to_iso(F.col("us")).alias("iso"))


@query(
    "epoch_conversion",
    """SELECT event_id, epoch_us(ts) // 1000 AS ms, strftime(ts, '%Y-%m-%d %H:%M') AS bar, CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER) AS day_no,
    CAST(isodow(ts) AS INTEGER) AS weekday, strftime(ts, '%b') AS month FROM events""",
)
def epoch_conversion(spark, sf):
    ts = F.col("ts").cast("timestamp")
    back = times.from_epoch_ms(times.to_epoch_ms(ts))
    return table(spark, sf, "events").select(
        "event_id", times.to_epoch_ms(back).alias("ms"), times.bar_label(back, True).alias("bar"), times.day_number(ts).alias("day_no"),
        times.monday_weekday(ts).alias("weekday"), times.month_name(ts).alias("month"),
    )


def _elapsed_sql(compat: bool) -> str:
    if compat:
        return "CASE WHEN b < a THEN b + 2400 - a ELSE b - a END AS gap"
    return "b // 100 * 60 + b % 100 - (a // 100 * 60 + a % 100) AS gap"


@query(
    "elapsed_minutes",
    f"""WITH {LEGS}, t AS (SELECT leg_id, line, distance, hhmm AS a, CAST(leg_id % 24 * 100 + dest AS INTEGER) AS b FROM legs),
    g AS (SELECT *, {_elapsed_sql(True)} FROM t)
    SELECT leg_id, line, distance, CAST(gap // 100 * 60 + gap % 100 AS INTEGER) AS compat,
    CAST((b // 100 * 60 + b % 100 - (a // 100 * 60 + a % 100) + 1440) % 1440 AS INTEGER) AS minutes FROM g""",
)
def elapsed_minutes(spark, sf):
    a, b = F.col("hhmm"), (F.col("leg_id") % 24 * 100 + F.col("dest")).cast("int")
    return legs(spark, sf).select(
        "leg_id", "line", "distance", times.elapsed_minutes(a, b, compat=True).alias("compat"), times.elapsed_minutes(a, b).alias("minutes")
    )


@query(
    "heat_index",
    """WITH t AS (SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity + 60 AS t, l_partkey % 100 AS h FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_extendedprice, round(CASE WHEN t >= 80 AND h >= 40 THEN -42.379 + 2.04901523 * t + 10.14333127 * h - 0.22475541 * t * h
    - 6.83783e-3 * t * t - 5.481717e-2 * h * h + 1.22874e-3 * t * t * h + 8.5282e-4 * t * h * h - 1.99e-6 * t * t * h * h ELSE t END, 3) AS felt FROM t""",
)
def heat_index(spark, sf):
    felt = maths.heat_index(F.col("l_quantity") + 60, (F.col("l_partkey") % 100).cast("double"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", F.round(felt, 3).alias("felt"))


@query(
    "bands_and_picks",
    """SELECT o_orderkey, CASE WHEN hour(o_orderdate) BETWEEN 5 AND 9 THEN 'morning' ELSE 'night' END AS part,
    CASE WHEN o_totalprice / 1000000 < 0.15 THEN 'low_delay' WHEN o_totalprice / 1000000 < 0.25 THEN 'medium_delay' ELSE 'high_delay' END AS band,
    CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS done, round(ln(o_totalprice) + sqrt(abs(o_totalprice)) + sign(o_totalprice - 100000), 6) AS mixed FROM orders""",
)
def bands_and_picks(spark, sf):
    price = F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        conditions.day_part(F.hour("o_orderdate")).alias("part"),
        conditions.rate_band(price / 1000000).alias("band"),
        conditions.flag(F.col("o_orderstatus") == "F").alias("done"),
        F.round(F.ln(price) + F.sqrt(F.abs(price)) + F.signum(price - 100000), 6).alias("mixed"),
    )
