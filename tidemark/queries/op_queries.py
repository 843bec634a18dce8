"""Operators of the silver layer: projections, joins, windows, set operations, sources and merges."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.windows import Roll
from tidemark.operators.dedupe import keep_max
from tidemark.operators.intervals import interval_lookup
from tidemark.plans import bars as ba
from tidemark.plans import dimensions as di
from tidemark.plans import fundamentals as fu
from tidemark.queries.registry import query, rnd
from tidemark.queries.standin import _code, _symbol
from tidemark.sources import merge, sinks, snapshots, text, vendor
from tidemark.session import shared_folder
from tidemark.streaming import jobs


# --- bars and projections ----------------------------------------------------------------------------------
@query("adjusted_backward", ["bars", "adjust_factor"], """
    SELECT k.symbol, k.date, round(open * coalesce(hfq_factor, 1), 2) AS open, round(high * coalesce(hfq_factor, 1), 2) AS high, round(low * coalesce(hfq_factor, 1), 2) AS low,
           round(close * coalesce(hfq_factor, 1), 2) AS close, volume, amount, coalesce(hfq_factor, 1) AS hfq_factor
    FROM bars k LEFT JOIN adjust_factor f ON f.symbol = k.symbol AND f.date = k.date AND day(f.date) % 7 <> 0""")
def q_backward(r):
    return ba.backward_adjusted(r("bars"), r("adjust_factor").where(F.dayofmonth("date") % 7 != 0))


@query("adjusted_forward", ["bars", "adjust_factor"], """
    SELECT k.symbol, k.date, round(open * f.hfq_factor / lf, 2) AS open, round(high * f.hfq_factor / lf, 2) AS high, round(low * f.hfq_factor / lf, 2) AS low, round(close * f.hfq_factor / lf, 2) AS close, volume, amount
    FROM bars k JOIN adjust_factor f ON f.symbol = k.symbol AND f.date = k.date JOIN (SELECT symbol, arg_max(hfq_factor, date) AS lf FROM adjust_factor GROUP BY symbol) l ON l.symbol = k.symbol""")
def q_forward(r):
    return ba.forward_adjusted(r("bars"), r("adjust_factor"))


@query("trading_calendar", ["calendar_days"], "SELECT date, row_number() OVER (ORDER BY date) AS seq FROM calendar_days")
def q_calendar(r):
    return ba.trading_calendar(r("bars"))


@query("calendar_extension", ["calendar_days", "paused_days"], """
    SELECT date, false AS is_future FROM calendar_days UNION ALL
    SELECT d::DATE, true FROM (SELECT unnest(generate_series((SELECT max(date) + 1 FROM calendar_days), DATE '2002-02-28', INTERVAL 1 DAY)) AS d)
    WHERE isodow(d) < 6 AND d::DATE NOT IN (SELECT max(date) + 30 FROM calendar_days)""")
def q_extension(r):
    holidays = r("calendar_days").agg(F.date_add(F.max("date"), 30).alias("date"))
    return ba.extend_calendar(r("calendar_days"), holidays, F.to_date(F.lit("2002-02-28")))


@query("calendar_differences", ["calendar_days"], """
    WITH rule AS (SELECT d::DATE AS date FROM (SELECT unnest(generate_series((SELECT min(date) FROM calendar_days), (SELECT max(date) FROM calendar_days), INTERVAL 1 DAY)) AS d) WHERE isodow(d) < 6)
    SELECT date, 'actual' AS only_in FROM (SELECT date FROM calendar_days EXCEPT ALL SELECT date FROM rule) UNION ALL SELECT date, 'rule' FROM (SELECT date FROM rule EXCEPT ALL SELECT date FROM calendar_days)""")
def q_cal_diff(r):
    span = r("calendar_days").agg(F.min("date").alias("first"), F.max("date").alias("last"))
    rule = ba.weekday_calendar(span, r("calendar_days").where(F.lit(False)))
    return ba.calendar_differences(r("calendar_days"), rule)


@query("filing_load_rules", ["filings"], """
    SELECT count(*) AS n_in, count(*) FILTER (WHERE NOT good) AS n_bad_code, count(*) FILTER (WHERE good AND q % 2 <> 0) AS n_other_report, count(*) FILTER (WHERE good AND q % 2 = 0) AS n_kept
    FROM (SELECT q, regexp_matches(code, '^\\d{6}\\.XSH[EG]$') AS good FROM (SELECT q, CASE WHEN sk % 9 = 0 THEN replace(code, '.', '_') ELSE code END AS code FROM filings))""")
def q_load_rules(r):
    df = r("filings").withColumn("code", F.when(F.col("sk") % 9 == 0, F.replace("code", F.lit("."), F.lit("_"))).otherwise(F.col("code")))
    return fu.drop_counts(df.withColumn("report_type", F.when(F.col("q") % 2 == 0, "regular").otherwise("other")), "regular")


@query("placeholder_flag", ["filings"], "SELECT code, report_date, pub_date, pub_date <= report_date AS pub_date_is_placeholder FROM filings WHERE regexp_matches(code, '^\\d{6}\\.XSH[EG]$')")
def q_placeholder(r):
    return fu.regular_filings(r("filings").select("code", "report_date", "pub_date"))


@query("regular_reports", ["filings"], """
    SELECT code, report_date, pub_date, pub_date <= report_date AS pub_date_is_placeholder FROM filings WHERE q % 2 = 0 AND regexp_full_match(code, '[0-9]{6}[.]XSH[EG]')""")
def q_regular_reports(r):
    df = r("filings").withColumn("report_type", F.when(F.col("q") % 2 == 0, "regular").otherwise("other"))
    return fu.regular_filings(df, "regular").select("code", "report_date", "pub_date", "pub_date_is_placeholder")


@query("load_faults", ["indicator_q"], """
    SELECT n_without_pub_date, n_duplicate_keys, n_without_pub_date + n_duplicate_keys = 0 AS accepted
    FROM (SELECT count(*) FILTER (WHERE pub_date IS NULL) AS n_without_pub_date FROM indicator_q),
         (SELECT count(*) AS n_duplicate_keys FROM (SELECT 1 FROM indicator_q GROUP BY code, report_date HAVING count(*) > 1))""")
def q_load_faults(r):
    return fu.load_faults(r("indicator_q"))


@query("percent_to_fraction", ["indicator_q"], "SELECT code, report_date, pub_date, eps, roe / 100.0 AS roe, adjusted_profit, inc_net_profit_year_on_year / 100.0 AS inc_net_profit_year_on_year FROM indicator_q")
def q_percent(r):
    return fu.percent_to_fraction(r("indicator_q"), ["eps", "adjusted_profit"])


@query("express_dedupe", ["express"], """
    SELECT code, source, report_date, pub_date, net_profit FROM (SELECT *, row_number() OVER (PARTITION BY code, source, report_date ORDER BY pub_date DESC, net_profit DESC) AS rn FROM express) WHERE rn = 1""")
def q_express(r):
    return keep_max(r("express"), ["code", "source", "report_date"], ["pub_date", "net_profit"])


@query("prefer_sourced", ["express"], """
    SELECT code, report_date, pub_date, source_id, net_profit FROM (SELECT *, row_number() OVER (PARTITION BY code, report_date, pub_date ORDER BY source_id IS NULL, source_id DESC, net_profit DESC) AS rn
      FROM (SELECT code, report_date, pub_date, CASE WHEN source = 'express' AND net_profit % 2 = 0 THEN 'x' || source END AS source_id, net_profit FROM express)) WHERE rn = 1""")
def q_sourced(r):
    df = r("express").select("code", "report_date", "pub_date", F.when((F.col("source") == "express") & (F.col("net_profit") % 2 == 0), F.concat(F.lit("x"), "source")).alias("source_id"), "net_profit")
    return fu.prefer_sourced(df, ["code", "report_date", "pub_date"], "source_id", ["source_id", "net_profit"])


@query("share_change_newest", ["share_change"], """
    SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY code, change_date ORDER BY pub_date DESC, change_reason DESC, share_trade_total DESC) AS rn FROM share_change) WHERE rn = 1""")
def q_share_newest(r):
    return di.newest_share_change(r("share_change"))


@query("final_disclosure", ["disclosure"], "SELECT *, coalesce(third_date, second_date, first_date, appoint_date) AS final_date FROM disclosure")
def q_disclosure(r):
    return fu.final_disclosure(r("disclosure"))


@query("calendar_verified", ["calendar_days"], """
    SELECT date, false AS is_future FROM calendar_days WHERE isodow(date) < 6 UNION ALL
    SELECT d::DATE, true FROM (SELECT unnest(generate_series((SELECT max(date) + 1 FROM calendar_days WHERE isodow(date) < 6), DATE '2002-02-28', INTERVAL 1 DAY)) AS d) WHERE isodow(d) < 6""")
def q_verified(r):
    actual = r("calendar_days").where(~F.dayofweek("date").isin(1, 7))
    span = actual.agg(F.min("date").alias("first"), F.max("date").alias("last"))
    closed = ba.weekday_calendar(span, actual)  # weekdays without a bar
    return ba.verified_extension(actual, closed, F.to_date(F.lit("2002-02-28")))


def _unlocks(r):
    year = F.substring("pub_date", 1, 4).cast("int")
    want = r("filings").groupBy(F.year("pub_date").alias("year")).agg(F.count("*").alias("expected"))
    return fu.load_list(r("unlocks"), ["pub_date", "expected_unlimited_date", "actual_unlimited_date"], year, want)


@query("unlock_list", ["unlocks"], """
    SELECT replace(code, chr(13), '') AS code, CAST(pub_date AS DATE) AS pub_date, CAST(expected_unlimited_date AS DATE) AS expected_unlimited_date,
           TRY_CAST(actual_unlimited_date AS DATE) AS actual_unlimited_date, replace(limited_reason, chr(13), '') AS limited_reason, CAST(left(pub_date, 4) AS INTEGER) AS year FROM unlocks""")
def q_unlocks(r):
    return _unlocks(r)


@query("unlock_profile", ["unlocks"], """
    SELECT replace(limited_reason, chr(13), '') AS limited_reason, count(*) AS n, count(DISTINCT replace(code, chr(13), '')) AS n_codes, count(TRY_CAST(actual_unlimited_date AS DATE)) AS n_actual,
           min(CAST(expected_unlimited_date AS DATE)) AS first_expected, max(CAST(expected_unlimited_date AS DATE)) AS last_expected FROM unlocks GROUP BY 1""")
def q_unlock_profile(r):
    return fu.unlock_profile(_unlocks(r))


@query("carriage_returns", ["unlocks"], "SELECT CAST(sum(length(code) - length(replace(code, chr(13), '')) + length(limited_reason) - length(replace(limited_reason, chr(13), ''))) AS BIGINT) AS n FROM unlocks")
def q_returns(r):
    return fu.carriage_returns(r("unlocks"))


@query("disclosure_punctuality", ["disclosure"], """
    SELECT count(late) AS n, round(avg(CASE WHEN late <= 0 THEN 1.0 ELSE 0.0 END), 6) AS share_in_time, count(first_date) AS n_moved_1, count(second_date) AS n_moved_2, count(third_date) AS n_moved_3, CAST(median(late) AS DOUBLE) AS median_days
    FROM (SELECT *, pub_date - coalesce(third_date, second_date, first_date, appoint_date) AS late FROM disclosure)""")
def q_punctuality(r):
    return fu.disclosure_punctuality(r("disclosure")).withColumn("share_in_time", F.round("share_in_time", 6)).withColumn("median_days", F.col("median_days").cast("double"))


# --- dimensions --------------------------------------------------------------------------------------------
@query("security_universe", ["universe", "name_history", "security_status"], """
    SELECT c.code, u.display_name_current, u.list_date, u.delist_date, u.sec_type, u.code IS NOT NULL AS in_yearend_snapshot
    FROM (SELECT code FROM universe UNION SELECT code FROM name_history UNION SELECT code FROM security_status) c LEFT JOIN universe u ON u.code = c.code""")
def q_universe(r):
    return di.security_universe(r("universe"), r("name_history"), r("security_status"))


@query("name_intervals", ["o_names"], "SELECT * FROM o_names")
def q_names(r):
    return di.name_intervals(r("name_history"))


@query("industry_intervals", ["o_industry"], "SELECT * FROM o_industry")
def q_industry(r):
    return di.industry_intervals(r("industry_snapshot"))


@query("status_asof_rows", ["o_status"], "SELECT * FROM o_status")
def q_status(r):
    return di.status_asof(r("security_status"))


@query("interval_lookup", ["bars", "o_industry", "o_code_map"], """
    SELECT k.symbol, k.date, i.sw_l1_code, i.valid_from AS since FROM bars k JOIN o_code_map m ON m.tdx_symbol = k.symbol
    LEFT JOIN o_industry i ON i.code = m.jq_code AND i.valid_from <= k.date AND (i.valid_to IS NULL OR i.valid_to > k.date)""")
def q_lookup(r):
    from tidemark.queries.inputs import codes

    left = r("bars").select("symbol", "date").join(codes(r).select(F.col("tdx_symbol").alias("symbol"), "jq_code"), "symbol")
    out = interval_lookup(left, di.industry_intervals(r("industry_snapshot")), {"jq_code": "code"}, "date", {"sw_l1_code": "sw_l1_code", "since": "valid_from"})
    return out.drop("jq_code")


@query("most_specific_kind", ["bars"], """
    SELECT code, kind FROM (SELECT code, kind, row_number() OVER (PARTITION BY code ORDER BY CASE kind WHEN 'etf' THEN 1 WHEN 'lof' THEN 2 WHEN 'index' THEN 3 WHEN 'fund' THEN 4 ELSE 5 END, kind) AS rn FROM (
      SELECT DISTINCT symbol AS code, CASE volume % 5 WHEN 0 THEN 'fund' WHEN 1 THEN 'index' WHEN 2 THEN 'bond' WHEN 3 THEN 'lof' ELSE 'etf' END AS kind FROM bars)) WHERE rn = 1""")
def q_kind(r):
    v = F.col("volume") % 5
    kind = F.when(v == 0, "fund").when(v == 1, "index").when(v == 2, "bond").when(v == 3, "lof").otherwise("etf")
    return di.most_specific_kind(r("bars").select(F.col("symbol").alias("code"), kind.alias("kind")).distinct())


@query("restatements", ["income"], """
    SELECT code, report_date, DATE '2001-06-30' AS old_snapshot, DATE '2001-12-31' AS snapshot_date, a AS old_value, b AS new_value FROM (
      SELECT code, report_date, arg_min(net_profit, pub_date) AS a, arg_max(net_profit, pub_date) AS b, count(*) AS n FROM (SELECT code, report_date, pub_date, coalesce(net_profit, -1) AS net_profit FROM income) GROUP BY ALL) WHERE a <> b""")
def q_restatements(r):
    df = r("income").select("code", "report_date", "pub_date", F.coalesce("net_profit", F.lit(-1.0)).alias("net_profit"))
    keys = ["code", "report_date"]
    first = df.groupBy(*keys).agg(F.min_by("net_profit", "pub_date").alias("net_profit"))
    last = df.groupBy(*keys).agg(F.max_by("net_profit", "pub_date").alias("net_profit"))
    return fu.restatements(fu.stack_snapshots({"2001-06-30": first, "2001-12-31": last}), "net_profit")


# --- windows, aggregates, ordering -------------------------------------------------------------------------
@query("window_toolbox", ["bars"], """
    SELECT symbol, date, lag(close) OVER w AS prev, last_value(CASE WHEN volume % 3 = 0 THEN close END IGNORE NULLS) OVER u AS filled, row_number() OVER w AS bar,
           date - lag(date) OVER w AS gap, max(high) OVER u AS top, min(low) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS low10,
           median(close) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS med10, sum(volume) OVER u::BIGINT AS cum_volume
    FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date), u AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""".replace("OVER u::BIGINT", "OVER u"))
def q_windows(r):
    x = Roll("symbol", "date")
    close = F.col("close")
    return r("bars").select(
        "symbol", "date", x.shift(close, 1).alias("prev"), F.last(F.when(F.col("volume") % 3 == 0, close), ignorenulls=True).over(x.upto()).alias("filled"),
        x.ordinal().alias("bar"), F.datediff("date", F.lag("date").over(x.base())).alias("gap"), x.cummax(F.col("high")).alias("top"),
        F.min("low").over(x.before(10)).alias("low10"), x.median_before(close, 10).alias("med10"), x.cumsum(F.col("volume")).alias("cum_volume"))


@query("share_of_total", ["security_status"], """
    SELECT public_status, n, round(n / sum(n) OVER (), 6) AS share FROM (SELECT public_status, count(*) AS n FROM security_status GROUP BY 1)""")
def q_share(r):
    n = r("security_status").groupBy("public_status").agg(F.count("*").alias("n"))
    total = r("security_status").agg(F.count("*").alias("t"))  # one row
    return n.crossJoin(F.broadcast(total)).select("public_status", "n", rnd(F.col("n") / F.col("t")).alias("share"))


@query("rank_pivot", ["indicator_q"], """
    SELECT code, max(CASE WHEN rn = 1 THEN eps END) AS e1, max(CASE WHEN rn = 2 THEN eps END) AS e2, max(CASE WHEN rn = 3 THEN eps END) AS e3, max(CASE WHEN rn = 4 THEN eps END) AS e4, max(CASE WHEN rn = 5 THEN eps END) AS e5
    FROM (SELECT code, eps, row_number() OVER (PARTITION BY code ORDER BY report_date DESC) AS rn FROM indicator_q) WHERE rn <= 5 GROUP BY code HAVING count(*) = 5""")
def q_pivot(r):
    rn = F.row_number().over(Window.partitionBy("code").orderBy(F.col("report_date").desc()))
    top = r("indicator_q").select("code", "eps", rn.alias("rn")).where(F.col("rn") <= 5)
    return top.groupBy("code").agg(*[F.max(F.when(F.col("rn") == k, F.col("eps"))).alias(f"e{k}") for k in range(1, 6)], F.count("*").alias("n")).where(F.col("n") == 5).drop("n")


@query("busiest_days", ["paused_days"], "SELECT date, count(*) AS n FROM paused_days GROUP BY date ORDER BY n DESC, date LIMIT 5")
def q_busiest(r):
    return r("paused_days").groupBy("date").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), F.col("date").asc_nulls_last()).limit(5)


@query("exact_quantiles", ["lines"], """
    SELECT sk, round(quantile_cont(ext, 0.1), 4) AS p10, round(quantile_cont(ext, 0.5), 4) AS p50, round(quantile_cont(ext, 0.99), 4) AS p99, count(ext) AS n FROM lines GROUP BY sk""")
def q_quantiles(r):
    from tidemark.operators.ranking import exact_quantiles

    df = exact_quantiles(r("lines").withColumn("ext", F.col("ext").cast("double")), ["sk"], "ext", {"p10": 0.1, "p50": 0.5, "p99": 0.99})
    return df.select("sk", *[rnd(x, 4).alias(x) for x in ("p10", "p50", "p99")], "n")


@query("content_fingerprint", ["bars"], "SELECT symbol, md5(string_agg(CAST(CAST(close AS BIGINT) AS VARCHAR) || ':' || CAST(volume AS VARCHAR), ',' ORDER BY date)) AS fingerprint, count(*) AS n FROM bars GROUP BY symbol")
def q_fingerprint(r):
    """The ordered text fingerprint, per symbol (a symbol has one row per day)."""
    item = F.struct("date", F.concat(F.col("close").cast("long").cast("string"), F.lit(":"), F.col("volume").cast("string")).alias("v"))
    return r("bars").groupBy("symbol").agg(
        F.md5(F.array_join(F.transform(F.sort_array(F.collect_list(item)), lambda x: x["v"]), ",")).alias("fingerprint"), F.count("*").alias("n"))


@query("equal_content", ["bars"], "SELECT true AS equal, count(*) AS n_rows, count(*) AS other_n_rows FROM bars")
def q_equal(r):
    """Order-free content hash: equal after any repartitioning."""
    return snapshots.same_content(r("bars"), r("bars").repartition(7, "date"))


# --- sources and merges --------------------------------------------------------------------------------------
_HEAD = ["id", "company_id", "code", "name", "end_date", "report_type_id", "report_type", "pub_date", "type_id", "type", "profit_min", "profit_max", "profit_last", "ratio_min", "ratio_max", "content"]


def damaged_lines(r):
    """The documents as records of a damaged CSV: 15 scalar fields, then free text with line breaks."""
    sym = F.expr(_code(_symbol("doc_id % 4000")))
    d = F.col("doc_id").cast("string")
    head = F.concat_ws(",", d, F.lit("7"), sym, F.col("lang"), F.lit("1999-12-31"), F.lit("1"), F.lit("t"), F.lit("2000-01-31"), *[F.lit("0")] * 7)
    rec = r("documents").select("doc_id", "source", F.concat(head, F.lit(","), F.col("text")).alias("rec"))
    lines = rec.select("doc_id", "source", F.posexplode(F.split("rec", "\n")).alias("i", "line"))
    pos = F.col("doc_id") * 1_000_000 + F.col("i")
    return lines.select(F.col("source").alias("file"), F.floor(pos / 7_000_003).alias("block"), pos.alias("pos"), "line")


@query("repair_records", ["documents"], f"""
    SELECT CAST(doc_id AS VARCHAR) AS id, {_code(_symbol('(doc_id % 4000)'))} AS code, lang AS name, length(t) AS n_chars, md5(t) AS content_md5,
           CAST(length(text) - length(replace(text, chr(10), '')) + 1 AS BIGINT) AS n_lines FROM (
      SELECT *, CASE WHEN trim(text, ' ') LIKE '"%' THEN replace(regexp_replace(substr(trim(text, ' '), 2), '"$', ''), '""', '"') ELSE text END AS t FROM documents)""")
def q_repair(r):
    df = text.repair_records(damaged_lines(r), _HEAD)
    return df.select("id", "code", "name", F.length("content").cast("long").alias("n_chars"), F.md5("content").alias("content_md5"), "n_lines")


@query("repair_checks", ["documents"], "SELECT count(*) AS n, 0::BIGINT AS bad_id, 0::BIGINT AS bad_code, 0::BIGINT AS bad_date FROM documents")
def q_repair_checks(r):
    return text.record_checks(text.repair_records(damaged_lines(r), _HEAD))


@query("coercion_losses", ["lineitem"], """
    SELECT 'q' AS column_name, count(*) FILTER (WHERE l_quantity % 5 = 0) AS lost FROM lineitem UNION ALL SELECT 'd', count(*) FILTER (WHERE l_linenumber = 2) FROM lineitem""")
def q_losses(r):
    raw = r("lineitem").select(
        F.when(F.col("l_quantity") % 5 == 0, F.concat(F.col("l_quantity").cast("string"), F.lit("x"))).otherwise(F.col("l_quantity").cast("string")).alias("q"),
        F.when(F.col("l_linenumber") == 2, F.lit("1999-13-45")).otherwise(F.col("l_shipdate").cast("date").cast("string")).alias("d"))
    return text.coercion_losses(raw, {"q": "double", "d": "date"})


@query("manifest_mismatches", ["bars"], "SELECT y AS year, n, n + 1 AS expected FROM (SELECT CAST(year(date) AS INTEGER) AS y, count(*) AS n FROM bars GROUP BY 1) WHERE y % 2 = 0")
def q_manifest(r):
    df = r("bars").withColumn("year", F.year("date"))
    want = df.groupBy("year").agg((F.count("*") + F.when(F.col("year") % 2 == 0, 1).otherwise(0)).alias("expected"))
    return text.counts_against_manifest(df, "year", want)


@query("build_manifest", ["bars"], """
    SELECT count(*) AS n_rows, min(date) AS first_day, max(date) AS last_day, count(DISTINCT symbol) AS n_symbols, 1::BIGINT AS n_bad_days, DATE '2000-05-31' AS safe_end FROM bars""")
def q_build_manifest(r):
    bad = r("calendar_days").where(F.col("date") >= "2000-06-01").agg(F.lit("2000-06-01").cast("date").alias("date"))
    return sinks.manifest(r("bars"), bad)


@query("upsert", ["bars"], """
    SELECT symbol, date, CASE WHEN volume % 4 = 0 THEN close + 1 ELSE close END AS close FROM bars UNION ALL
    SELECT symbol || 'N', date, close FROM bars WHERE volume % 16 = 0""")
def q_upsert(r):
    old = r("bars").select("symbol", "date", "close")
    hit = r("bars").where(F.col("volume") % 4 == 0).select("symbol", "date", (F.col("close") + 1).cast("string").alias("close"), F.lit(1).alias("extra"))
    new = r("bars").where(F.col("volume") % 16 == 0).select(F.concat("symbol", F.lit("N")).alias("symbol"), "date", F.col("close").cast("string").alias("close"), F.lit(1).alias("extra"))
    return merge.upsert(old, hit.unionByName(new), ["symbol", "date"])


@query("upsert_null_keys", ["industry_snapshot"], """
    SELECT code, sw_l1_code, CASE WHEN sw_l1_code IS NULL THEN 'new' ELSE max(zjw_code) END AS v FROM industry_snapshot GROUP BY code, sw_l1_code""")
def q_upsert_null(r):
    old = r("industry_snapshot").groupBy("code", "sw_l1_code").agg(F.max("zjw_code").alias("v"))
    return merge.upsert(old, old.where(F.col("sw_l1_code").isNull()).withColumn("v", F.lit("new")), ["code", "sw_l1_code"])


@query("replace_guard", ["bars"], """
    SELECT CAST(year(date) AS INTEGER) AS year, count(*) FILTER (WHERE NOT (year(date) = 1999 AND volume % 3 = 0)) AS n_new, count(*) AS n_old, year(date) <> 1999 AS accepted FROM bars GROUP BY year(date)""")
def q_replace(r):
    old = r("bars").withColumn("year", F.year("date"))
    return merge.replace_guard(old, old.where(~((F.col("year") == 1999) & (F.col("volume") % 3 == 0))), "year")


@query("snapshot_key_changes", ["events"], """
    SELECT user_id, event_id, CASE WHEN event_id % 50 < 5 THEN 'added' ELSE 'removed' END AS change FROM events WHERE event_id % 50 < 5 OR event_id % 50 >= 45""")
def q_key_changes(r):
    """Two overlapping snapshots of the event keys that hold the whole table between them."""
    e, k = r("events"), F.col("event_id") % 50
    return snapshots.key_changes(e.where(k >= 5), e.where(k < 45), ["user_id", "event_id"])


_FACTOR_MONTHS = [f"m{m:02d}" for m in range(1, 13)]


@query("melt_wide", ["bars"], """
    SELECT symbol || '-' || year(date) AS date, 'm' || lpad(CAST(month(date) AS VARCHAR), 2, '0') AS code, max(close) AS factor FROM bars GROUP BY ALL""")
def q_melt(r):
    wide = r("bars").groupBy(F.concat_ws("-", "symbol", F.year("date")).alias("date")).agg(*[F.max(F.when(F.month("date") == i + 1, F.col("close"))).alias(m) for i, m in enumerate(_FACTOR_MONTHS)])
    return vendor.melt_wide(wide)


@query("vendor_conform", ["orders"], """
    SELECT CAST(o_custkey AS VARCHAR) AS MARKET_CODE, o_totalprice AS PRECLOSE, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey END AS HOLDERS, o_orderstatus AS more FROM orders""")
def q_conform(r):
    raw = r("orders").select(F.col("o_orderstatus").alias("more"), F.when(F.col("o_orderkey") % 3 == 0, "--").otherwise(F.col("o_orderkey").cast("string")).alias("HOLDERS"),
                             F.col("o_custkey").alias("MARKET_CODE"), F.col("o_totalprice").cast("string").alias("PRECLOSE"))
    return vendor.conform(raw, {"MARKET_CODE": "string", "PRECLOSE": "float", "HOLDERS": "int", "NEVER_SENT": "int"})


# --- streams ---------------------------------------------------------------------------------------------------
def _work_folder(r) -> str:
    """A new folder below the shared folder of the session."""
    return f"{shared_folder(r.spark)}/tidemark-stream-{uuid.uuid4().hex}"


@query("stream_bars", ["events"], """
    SELECT event_type, CAST(d AS DATE) AS date, open, high, low, close, n FROM (
      SELECT event_type, date_trunc('day', ts) AS d, arg_min(value, {'t': ts, 'i': event_id}) AS open, max(value) AS high, min(value) AS low, arg_max(value, {'t': ts, 'i': event_id}) AS close, count(*) AS n
      FROM events GROUP BY ALL) WHERE d + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""")
def q_stream(r):
    """Events arrive as a stream; finished days come out as bars."""
    schema = r("events").schema
    ticks = r.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(r.dir)
    ticks = ticks.withColumn("ts", F.col("ts").cast("timestamp"))
    folder = _work_folder(r)
    jobs.write_bars(jobs.bars_from_ticks(ticks, "event_type", "ts", "value", "event_id"), folder + "/bars", folder + "/state").awaitTermination()
    return r.spark.read.parquet(folder + "/bars")


@query("stream_upsert", ["events"], "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN value + 1 ELSE value END AS value FROM events")
def q_stream_upsert(r):
    """A stream of increments merged by key into a versioned table."""
    folder = _work_folder(r)
    base = r("events").select("event_id", "value")
    base.write.parquet(jobs.version_path(folder + "/table", 0))
    inc = r.spark.readStream.schema(r("events").schema).option("pathGlobFilter", "events.parquet").parquet(r.dir)
    inc = inc.where(F.col("event_id") % 3 == 0).select("event_id", (F.col("value") + 1).alias("value"))
    jobs.merge_stream(inc, folder + "/table", ["event_id"], folder + "/state").awaitTermination()
    return r.spark.read.parquet(jobs.version_path(folder + "/table", jobs.latest_version(r.spark, folder + "/table")))
