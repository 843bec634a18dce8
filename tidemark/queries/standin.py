"""Market-shaped relations derived from the driver's tables.

``/root/testdata`` holds no market data, so every role a query needs (bars, filings, share changes,
snapshots, ...) is derived from whole driver tables by plain SQL that Spark and DuckDB both accept.  The
same text feeds the Spark side (``relation``) and the oracle side (``with_ctes``), so both see equal
inputs; the work under test is what happens *after* these relations.

Prices are integers and ratios are dyadic, so sums are exact in any order and on any engine.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from types import MappingProxyType

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.fundamentals import BALANCE, CASHFLOW, INCOME

BASE = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
)

# The eight index codes of the panel and how often each publishes a snapshot (months).
INDEX_STEP = {
    "000300.XSHG": 1, "000905.XSHG": 1, "399303.XSHE": 3, "000852.XSHG": 1,
    "000016.XSHG": 3, "399006.XSHE": 2, "000688.XSHG": 1, "000906.XSHG": 6,
}


def _id4(k: str) -> str:
    return f"CASE WHEN {k} < 10000 THEN lpad(CAST({k} AS VARCHAR(20)), 4, '0') ELSE CAST({k} AS VARCHAR(20)) END"


def _symbol(k: str) -> str:
    return (
        f"concat(CASE WHEN {k} % 20 = 19 THEN 'sh51' WHEN {k} % 20 = 18 THEN 'sz39' WHEN {k} % 20 = 17 THEN 'sh90' "
        f"WHEN {k} % 4 = 0 THEN 'sh60' WHEN {k} % 4 = 1 THEN 'sh68' WHEN {k} % 4 = 2 THEN 'sz30' ELSE 'sz00' END, {_id4(k)})"
    )


def _code(sym: str) -> str:
    return f"concat(substr({sym}, 3), CASE WHEN {sym} LIKE 'sh%' THEN '.XSHG' ELSE '.XSHE' END)"


def _i(x: str) -> str:
    return f"CAST({x} AS INT)"


def _d(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def _statement(fields: tuple[str, ...], salt: int, miss: int) -> str:
    cols = ", ".join(
        f"CASE WHEN (sk + q * 5 + {i + salt}) % 13 = 0 THEN NULL ELSE "
        f"{_d(f'(CASE WHEN (sk + {i}) % 5 = 0 THEN -1 ELSE 1 END) * (rev_cum * {i % 7 + 1} + sk * 1000 + y * {i + 3})')} END AS {f}"
        for i, f in enumerate(fields)
    )
    first = f"SELECT code, report_date, pub_date, {cols} FROM filings WHERE (sk + q + y) % {miss} <> 0"
    again = (
        f"SELECT code, report_date, pub_date + {_i(str(30))} AS pub_date, "
        + ", ".join(f"{f} + 1 AS {f}" for f in fields)
        + " FROM first_filing WHERE substr(code, 6, 1) = '3'"
    )
    return f"WITH first_filing AS ({first}) SELECT * FROM first_filing UNION ALL {again}"


# name -> (relations it reads, SQL)
RELATIONS: dict[str, tuple[tuple[str, ...], str]] = {
    "lines": (("lineitem",), """
        SELECT l_suppkey AS sk, CAST(l_shipdate AS DATE) AS date, l_partkey AS pk, l_orderkey AS ok,
               l_orderkey * 100 + l_linenumber AS ln,
               100 + CAST(floor(l_extendedprice) AS BIGINT) % 21 AS px,
               CAST(l_quantity AS BIGINT) AS qty,
               CAST(floor(l_extendedprice) AS BIGINT) AS ext,
               CAST(floor(l_extendedprice * l_discount) AS BIGINT) AS disc
        FROM lineitem"""),
    "bars_sk": (("lines",), """
        SELECT sk, date, CAST(min(ln * 1000 + px) % 1000 AS DOUBLE) AS open, CAST(max(px) AS DOUBLE) AS high,
               CAST(min(px) AS DOUBLE) AS low, CAST(max(ln * 1000 + px) % 1000 AS DOUBLE) AS close,
               CAST(sum(qty) AS BIGINT) AS shares, CAST(sum(px * qty) AS DOUBLE) AS amount
        FROM lines GROUP BY sk, date"""),
    "bars": (("bars_sk",), f"""
        SELECT {_symbol('sk')} AS symbol, date, open, high, low, close,
               CAST(shares * CASE WHEN sk % 10 = 3 AND year(date) < 1997 THEN 10000
                                  WHEN sk % 10 = 4 AND month(date) = 2 THEN 1 ELSE 100 END AS BIGINT) AS volume, amount
        FROM bars_sk"""),
    "adjust_factor": (("bars_sk",), f"""
        SELECT {_symbol('sk')} AS symbol, date, 1 + 0.25E0 * ((year(date) - 1995) * (sk % 3)) AS hfq_factor
        FROM bars_sk"""),
    "basic_daily": (("bars_sk",), f"""
        SELECT symbol, date, close, preclose, change_pct, amplitude, turnover, floatmv, totalmv FROM (
          SELECT {_symbol('sk')} AS symbol, sk, date, close, preclose,
                 CASE WHEN preclose > 0 THEN (close / preclose - 1) * 100 END AS change_pct,
                 CASE WHEN preclose > 0 THEN (high - low) / preclose * 100 END AS amplitude,
                 shares / 1024E0 AS turnover,
                 CASE WHEN sk % 25 = 6 THEN 0E0 ELSE close * (100000 + sk * 10) END AS floatmv,
                 CASE WHEN sk % 25 = 6 THEN 0E0 ELSE close * (150000 + sk * 15) END AS totalmv
          FROM (SELECT b.*, lag(close) OVER (PARTITION BY sk ORDER BY date) AS preclose FROM bars_sk b) t
        ) u WHERE (sk + day(date)) % 13 <> 0"""),
    "symbol_class": (("supplier",), f"""
        SELECT {_symbol('s_suppkey')} AS symbol,
               CASE WHEN s_suppkey % 20 = 19 THEN 'etf' WHEN s_suppkey % 20 = 18 THEN 'index'
                    WHEN s_suppkey % 50 = 30 THEN 'unknown' ELSE 'stock' END AS class
        FROM supplier"""),
    "calendar_days": (("bars_sk",), "SELECT DISTINCT date FROM bars_sk"),
    "universe": (("bars_sk", "supplier"), f"""
        SELECT {_code(_symbol('sk'))} AS code, s_name AS display_name_current,
               CASE WHEN sk % 33 = 1 THEN NULL ELSE lo - {_i('(sk % 7) * 100')} END AS list_date,
               CASE WHEN sk % 17 = 3 THEN hi - {_i('400')} END AS delist_date, 'stock' AS sec_type
        FROM (SELECT sk, min(date) AS lo, max(date) AS hi FROM bars_sk GROUP BY sk) t JOIN supplier ON s_suppkey = sk
        WHERE sk % 20 <> 18 AND sk % 37 <> 36
        UNION ALL SELECT '999999.XSHE', 'never traded', DATE '1994-01-01', DATE '1995-06-30', 'stock'"""),
    "filings": (("lines",), f"""
        SELECT sk, {_code(_symbol('sk'))} AS code, y, q, last_day(make_date({_i('y')}, {_i('q * 3')}, 1)) AS report_date,
               CASE WHEN q = 4 AND sk % 5 = 0 THEN last_day(make_date({_i('y + 1')}, 3, 1)) + {_i('15 + (sk * 7 + 13) % 60')}
                    WHEN sk % 19 = 2 AND q = 2 THEN last_day(make_date({_i('y')}, {_i('q * 3')}, 1))
                    ELSE last_day(make_date({_i('y')}, {_i('q * 3')}, 1)) + {_i('15 + (sk * 7 + q * 13) % 60')} END AS pub_date,
               CAST(sum(rev) OVER (PARTITION BY sk, y ORDER BY q) AS BIGINT) AS rev_cum,
               CAST(sum(prof) OVER (PARTITION BY sk, y ORDER BY q) AS BIGINT) AS np_cum
        FROM (SELECT sk, CAST(year(date) AS BIGINT) AS y, CAST(quarter(date) AS BIGINT) AS q, CAST(sum(ext) AS BIGINT) AS rev,
                     CAST(sum(ext) - sum(disc) * 19 AS BIGINT) AS prof
              FROM lines GROUP BY sk, year(date), quarter(date)) t"""),
    "fin_core": (("filings",), f"""
        SELECT code, report_date, pub_date, {_d('rev_cum')} AS revenue, {_d('np_cum')} AS net_profit_parent,
               {_d('np_cum * 2 - rev_cum / 4')} AS net_profit_total, {_d('np_cum * 2')} AS profit_before_tax, np_cum / 1048576E0 AS eps_basic
        FROM filings WHERE (sk + q + y) % 17 <> 0"""),
    "fin_ratio": (("filings",), f"""
        SELECT code, report_date, pub_date, np_cum / 4194304E0 AS roe_parent, rev_cum / 65536E0 AS bps,
               {_d('rev_cum * 4')} AS total_assets, {_d('rev_cum * 2 - (sk % 9) * 60000')} AS equities
        FROM filings WHERE (sk * 3 + q + y) % 11 <> 0"""),
    "indicator_q": (("filings",), f"""
        SELECT code, report_date, pub_date, np_cum / 1048576E0 AS eps,
               CASE WHEN (sk + y + q) % 23 = 0 THEN NULL ELSE (np_cum % 8192) / 65536E0 END AS roe,
               {_d('np_cum - sk')} AS adjusted_profit, np_cum / 4096E0 AS inc_net_profit_year_on_year
        FROM filings WHERE (sk + q) % 29 <> 0"""),
    "income": (("filings",), _statement(INCOME, 0, 31)),
    "balance": (("filings",), _statement(BALANCE, 3, 37)),
    "cashflow": (("filings",), _statement(CASHFLOW, 6, 41)),
    "express": (("filings",), f"""
        SELECT code, CASE WHEN q % 2 = 0 THEN 'express' ELSE 'restated' END AS source, report_date,
               pub_date - {_i('(sk + q) % 12')} AS pub_date, {_d('np_cum')} AS net_profit
        FROM filings WHERE sk % 3 = 0
        UNION ALL SELECT code, 'express', report_date, pub_date, {_d('np_cum + 7')} FROM filings WHERE sk % 6 = 0"""),
    "share_change": (("filings",), f"""
        SELECT code, change_date, pub_date, change_reason, share_total, share_trade_total, share_b, share_h FROM (
          SELECT code, report_date AS change_date, pub_date, '定期报告' AS change_reason,
                 {_d('20000 + sk * 10 + (y - 1995) * 100')} AS share_total,
                 CASE WHEN (sk + y + q) % 27 = 5 THEN NULL ELSE {_d('12000 + sk * 10 + (y - 1995) * 100 - (q % 2) * 900 - CASE WHEN y >= 1999 AND sk % 6 = 1 THEN 3000 ELSE 0 END')} END AS share_trade_total,
                 {_d('CASE WHEN sk % 6 = 1 AND y < 1997 THEN 3000 WHEN sk % 6 = 1 AND y = 2001 THEN 500 END')} AS share_b,
                 {_d('CASE WHEN sk % 8 = 2 AND q <> 3 AND y < 2000 THEN 1500 END')} AS share_h
          FROM filings
          UNION ALL
          SELECT code, report_date - {_i('20 + sk % 30')}, report_date - {_i('45 - (sk % 9) * 10')},
                 CASE WHEN sk % 2 = 0 THEN '限售股份上市' ELSE '股份回购' END,
                 {_d('20000 + sk * 10 + (y - 1995) * 100')},
                 {_d('12100 + sk * 10 + (y - 1995) * 100 - CASE WHEN y >= 1999 AND sk % 6 = 1 THEN 3000 ELSE 0 END')}, NULL, NULL
          FROM filings WHERE (sk + q) % 4 = 1
        ) t"""),
    "security_status": (("bars_sk",), f"""
        SELECT {_code(_symbol('sk'))} AS code, d AS valid_from,
               d + {_i('(sk * 5 + y) % 15 - 5')} AS known_from,
               CASE (sk + y) % 6 WHEN 0 THEN 'ST' WHEN 1 THEN '*ST' WHEN 2 THEN '进入退市整理期' ELSE '正常上市' END AS public_status,
               concat('name', CAST(sk AS VARCHAR(20))) AS name
        FROM (SELECT sk, year(date) AS y, min(date) AS d FROM bars_sk GROUP BY sk, year(date)) t WHERE (sk + y) % 4 <> 0
        UNION ALL
        SELECT {_code(_symbol('sk'))}, d - {_i('1')}, d + {_i('(sk * 5 + y) % 15 - 5')}, '正常上市', 'tie'
        FROM (SELECT sk, year(date) AS y, min(date) AS d FROM bars_sk GROUP BY sk, year(date)) t WHERE (sk + y) % 9 = 1"""),
    "name_history": (("bars_sk", "supplier"), f"""
        SELECT {_code(_symbol('sk'))} AS code, sk AS company_id,
               concat(CASE WHEN (sk + y) % 7 = 0 THEN 'ST ' WHEN (sk + y) % 11 = 0 THEN '*' ELSE '' END, s_name,
                      CASE WHEN (sk + y) % 13 = 0 THEN '退' ELSE '' END) AS new_name,
               d AS start_date, d - {_i('sk % 4')} AS pub_date, 'rename' AS reason
        FROM (SELECT sk, year(date) AS y, min(date) AS d FROM bars_sk GROUP BY sk, year(date)) t JOIN supplier ON s_suppkey = sk
        WHERE (sk + y) % 3 <> 1"""),
    "industry_snapshot": (("lines", "part"), f"""
        SELECT {_code(_symbol('sk'))} AS code, last_day(make_date({_i('y')}, {_i('q * 3')}, 1)) AS as_of,
               CASE WHEN (sk + q) % 16 = 0 THEN NULL ELSE concat('L1-', p_type) END AS sw_l1_code,
               CASE p_type WHEN 'ECONOMY' THEN '银行I' WHEN 'SMALL' THEN '钢铁I' ELSE p_type END AS sw_l1_name,
               concat('L2-', CAST(p_size % 3 AS VARCHAR(9))) AS sw_l2_code, concat('L2 ', CAST(p_size % 3 AS VARCHAR(9))) AS sw_l2_name,
               'L3' AS sw_l3_code, 'L3 name' AS sw_l3_name, p_brand AS zjw_code, p_brand AS zjw_name
        FROM (SELECT sk, year(date) AS y, quarter(date) AS q, min(pk) AS pk FROM lines GROUP BY sk, year(date), quarter(date)) t
        JOIN part ON p_partkey = pk"""),
    "months": (("bars_sk",), """
        SELECT year(date) AS y, month(date) AS m, (year(date) - 1995) * 12 + month(date) AS mno, max(date) AS as_of
        FROM bars_sk GROUP BY year(date), month(date)"""),
    "active_months": (("bars_sk",), "SELECT DISTINCT sk, year(date) AS y, month(date) AS m FROM bars_sk"),
    "index_member_asof": (("active_months", "months"), f"""
        SELECT v.index_code, {_code(_symbol('sk'))} AS stock_code, as_of
        FROM active_months a JOIN months n ON n.y = a.y AND n.m = a.m
        JOIN (SELECT * FROM (VALUES {", ".join(f"('{ix}', {step}, {k + 3})" for k, (ix, step) in enumerate(INDEX_STEP.items()))})
              AS t(index_code, step, k)) v ON mno % v.step = 0 AND (sk * v.k + mno % 7) % 5 < 2"""),
    "dividend": (("filings",), f"""
        SELECT code, report_date, bonus_type, plan_progress, CAST(bonus_amount_rmb AS DOUBLE) AS bonus_amount_rmb,
               CAST(bonus_ratio_rmb AS DOUBLE) AS bonus_ratio_rmb, board_plan_pub_date, shareholders_plan_pub_date,
               implementation_pub_date, bonus_cancel_pub_date, a_registration_date, a_xr_date FROM (
          SELECT code, report_date, '年度分红' AS bonus_type, CASE WHEN sk % 4 = 1 THEN '董事会预案' ELSE '实施方案' END AS plan_progress,
                 rev_cum / 1024E0 AS bonus_amount_rmb, (sk % 8) / 4E0 AS bonus_ratio_rmb,
                 CASE WHEN sk % 7 = 0 THEN NULL ELSE pub_date END AS board_plan_pub_date,
                 CASE WHEN sk % 7 IN (0, 1) THEN NULL ELSE pub_date + {_i('30')} END AS shareholders_plan_pub_date,
                 CASE WHEN sk % 7 IN (0, 1, 2) THEN NULL ELSE pub_date + {_i('60')} END AS implementation_pub_date,
                 CASE WHEN (sk + y) % 15 = 0 THEN pub_date + {_i('90')} END AS bonus_cancel_pub_date,
                 CASE WHEN sk % 21 = 0 THEN NULL ELSE pub_date + {_i('65')} END AS a_registration_date, pub_date + {_i('66')} AS a_xr_date
          FROM filings WHERE q IN (2, 4)
          UNION ALL
          SELECT code, report_date, '年度分红', '股东大会预案', rev_cum / 1024E0 + 1, (sk % 8) / 4E0, pub_date + {_i('40')},
                 NULL, NULL, NULL, pub_date + {_i('65')}, pub_date + {_i('66')}
          FROM filings WHERE q = 4 AND sk % 3 = 0
        ) t"""),
    "gbbq": (("bars_sk",), f"""
        SELECT CAST(CASE WHEN (sk + y) % 12 = 0 THEN 5 ELSE 1 END AS BIGINT) AS category, {_symbol('sk')} AS symbol, d AS date,
               CASE WHEN (sk + y) % 10 = 0 THEN 1E0 ELSE 0E0 END AS c1, 0E0 AS c2,
               10 * ((1 + 0.25E0 * ((y - 1995) * (sk % 3))) / (1 + 0.25E0 * ((y - 1996) * (sk % 3))) - 1) AS c3, 0E0 AS c4
        FROM (SELECT sk, year(date) AS y, min(date) AS d FROM bars_sk GROUP BY sk, year(date)) t WHERE sk % 3 > 0 AND y > 1995"""),
    "price_limits": (("bars_sk",), f"""
        SELECT {_code(_symbol('sk'))} AS code, date, high - {_d('(sk + day(date)) % 3 - 1')} AS high_limit,
               low - {_d('(sk + month(date)) % 3 - 1')} AS low_limit
        FROM bars_sk WHERE (sk + day(date)) % 6 <> 0"""),
    "st_days": (("bars_sk",), f"""
        SELECT {_code(_symbol('sk'))} AS code, b.date + {_i('0')} AS date FROM bars_sk b WHERE (sk + year(date)) % 6 IN (0, 1)
        UNION ALL SELECT {_code(_symbol('sk'))}, date + {_i('1')} FROM bars_sk WHERE (sk + year(date)) % 6 = 0"""),
    "paused_days": (("bars_sk",), f"""
        SELECT {_code(_symbol('sk'))} AS code, date FROM bars_sk WHERE (sk * 3 + day(date)) % 40 = 0"""),
    "disclosure": (("filings",), f"""
        SELECT code, report_date AS end_date, pub_date AS appoint_date,
               CASE WHEN sk % 2 = 0 THEN pub_date + {_i('3')} END AS first_date,
               CASE WHEN sk % 4 = 0 THEN pub_date + {_i('5')} END AS second_date,
               CASE WHEN sk % 8 = 0 THEN pub_date + {_i('9')} END AS third_date, pub_date
        FROM filings"""),
    "unlocks": (("filings",), f"""
        SELECT code || CASE WHEN sk % 7 = 0 THEN chr(13) ELSE '' END AS code, CAST(pub_date AS VARCHAR(20)) AS pub_date,
               CAST(report_date + {_i('30 + sk % 90')} AS VARCHAR(20)) AS expected_unlimited_date,
               CASE WHEN sk % 11 = 0 THEN 'unknown' WHEN sk % 3 > 0 THEN CAST(report_date + {_i('31 + sk % 90')} AS VARCHAR(20)) END AS actual_unlimited_date,
               CASE WHEN q = 4 THEN 'placement' WHEN q = 2 THEN 'founders' || chr(13) ELSE 'incentive' END AS limited_reason
        FROM filings"""),
    "trades": (("orders",), f"""
        SELECT o_orderkey AS trade_id, {_code(_symbol('o_custkey % 100'))} AS code, CAST(o_orderdate AS DATE) AS buy_date,
               CAST(1 + o_orderkey % 15 AS BIGINT) AS hold_days, o_orderpriority AS strategy,
               CAST(CAST(floor(o_totalprice) AS BIGINT) % 513 - 250 AS DOUBLE) / 1024E0 AS ret,
               CAST(floor(o_totalprice) AS DOUBLE) AS order_amount
        FROM orders"""),
}


def _order(names: tuple[str, ...] | list[str], given: Collection[str] = BASE) -> list[str]:
    """``names`` and what they read, each after its own inputs; ``given`` relations are not looked into."""
    out: list[str] = []

    def visit(n: str) -> None:
        if n in given or n in out:
            return
        for dep in RELATIONS[n][0]:
            visit(dep)
        out.append(n)

    for n in names:
        visit(n)
    return out


def ctes(names: tuple[str, ...] | list[str]) -> str:
    return ",\n".join(f"{n} AS ({RELATIONS[n][1]})" for n in _order(names))


def with_ctes(names: tuple[str, ...] | list[str], body: str) -> str:
    """Oracle text: the stand-in relations as CTEs, then ``body`` (which may start with more CTEs)."""
    body = body.strip()
    head = "WITH RECURSIVE " if "RECURSIVE" in body[:30] else "WITH "
    if body.upper().startswith("WITH RECURSIVE "):
        return head + ctes(names) + ",\n" + body[15:]
    if body.upper().startswith("WITH "):
        return head + ctes(names) + ",\n" + body[5:]
    return head + ctes(names) + "\n" + body


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: What a relation groups or orders whole tables by: (the relation that it reads, the columns).
DEALT = {"bars_sk": ("lines", "sk, date"), "basic_daily": ("bars_sk", "sk")}


def relation(spark: SparkSession, sf_dir: str, name: str, stored: Mapping[str, str] = MappingProxyType({}), parts: int | None = None) -> DataFrame:
    """One derived relation as a DataFrame; the base tables, and relations ``stored`` under a path, are read straight from Parquet.

    With ``parts``, what ``name`` groups by (``DEALT``) is dealt into so many parts first, so that the rows which a task holds do
    not depend on the size of files or on the session's number of partitions.
    """
    source, by = DEALT.get(name, ("", "")) if parts else ("", "")
    hint = {source: f"/*+ REPARTITION({parts}, {by}) */ "}
    paths = {**{b: f"{sf_dir}/{b}.parquet" for b in BASE}, **stored}
    if name in paths:
        return spark.read.parquet(paths[name])
    order = _order([name], paths)
    bases = sorted({d for n in order for d in RELATIONS[n][0] if d in paths})
    heads = [f"{b} AS (SELECT {hint.get(b, '')}* FROM parquet.`{paths[b]}`)" for b in bases]
    bodies = [f"{n} AS (SELECT {hint[n]}* FROM ({RELATIONS[n][1]}))" if n in hint else f"{n} AS ({RELATIONS[n][1]})" for n in order]
    return spark.sql("WITH " + ",\n".join(heads + bodies) + f"\nSELECT * FROM {name}")
