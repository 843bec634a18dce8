"""Filings: load rules, TTM and single-quarter chains, statement layer, growth."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.scalars import safe_div
from tidemark.operators.asof import asof_join
from tidemark.operators.dedupe import keep_max, newest_report_asof
from tidemark.operators.ranking import exact_quantiles

# Statement fields.  Balance fields are stocks; the other two are cumulative within a year.
BALANCE = (
    "total_assets", "total_liability", "total_owner_equities", "equities_parent_company_owners",
    "total_current_assets", "total_current_liability", "total_non_current_assets",
    "total_non_current_liability", "fixed_assets", "intangible_assets", "inventories", "cash_equivalents",
    "trading_assets", "account_receivable", "accounts_payable", "shortterm_loan", "longterm_loan",
    "bonds_payable", "non_current_liability_in_one_year", "hold_to_maturity_investments",
    "preferred_shares_equity", "surplus_reserve_fund", "retained_profit", "capital_reserve_fund",
)
INCOME = (
    "total_profit", "net_profit", "np_parent_company_owners", "operating_revenue", "operating_cost",
    "operating_profit", "total_operating_revenue", "total_operating_cost", "financial_expense",
    "administration_expense", "sale_expense", "non_operating_revenue", "non_operating_expense",
    "operating_tax_surcharges", "asset_impairment_loss", "fair_value_variable_income", "investment_income",
    "invest_income_associates", "interest_expense", "interest_income",
)
CASHFLOW = (
    "net_operate_cash_flow", "net_invest_cash_flow", "net_finance_cash_flow", "cash_equivalent_increase",
    "goods_sale_and_service_render_cash", "cash_and_equivalents_at_end", "fix_intan_other_asset_acqui_cash",
    "fixed_assets_depreciation", "intangible_assets_amortization",
)

CODE_PATTERN = r"^\d{6}\.XSH[EG]$"


def regular_filings(df: DataFrame, report_type: str | None = None) -> DataFrame:
    """Rows with a well-formed code, of one ``report_type`` if given, with the placeholder flag (published on or before the
    period end).  ``drop_counts`` tells how many rows that leaves out."""
    kept = df.where(F.col("code").rlike(CODE_PATTERN))
    kept = kept if report_type is None else kept.where(F.col("report_type") == report_type)
    return kept.withColumn("pub_date_is_placeholder", F.col("pub_date") <= F.col("report_date"))


def load_faults(df: DataFrame, keys: Sequence[str] = ("code", "report_date")) -> DataFrame:
    """One row: how many rows lack a publication date, and how many keys occur twice.  A load with either is refused."""
    blank = df.agg(F.count_if(F.col("pub_date").isNull()).alias("n_without_pub_date"))
    twice = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1).alias("n_duplicate_keys"))
    return blank.crossJoin(twice).withColumn("accepted", (F.col("n_without_pub_date") == 0) & (F.col("n_duplicate_keys") == 0))


def accepted_filings(df: DataFrame, keys: Sequence[str] = ("code", "report_date")) -> DataFrame:
    """``df`` as it is, or an error when it is used if ``load_faults`` finds any."""
    verdict = load_faults(df, keys).select(F.when(~F.col("accepted"), F.raise_error(F.lit("filings without publication date or with duplicate keys"))).alias("__fault"))
    return df.crossJoin(verdict).where(F.col("__fault").isNull()).drop("__fault")


def drop_counts(df: DataFrame, report_type: str | None = None) -> DataFrame:
    """How many rows the load rules keep and drop, in one pass."""
    good = F.col("code").rlike(CODE_PATTERN)
    regular = F.lit(True) if report_type is None else F.col("report_type") == report_type
    return df.agg(
        F.count(F.lit(1)).alias("n_in"),
        F.count_if(~good).alias("n_bad_code"),
        F.count_if(good & ~regular).alias("n_other_report"),
        F.count_if(good & regular).alias("n_kept"),
    )


def percent_to_fraction(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Divide every double column by 100 except the listed ones."""
    return df.select(
        *[F.col(c) if t != "double" or c in keep else (F.col(c) / 100.0).alias(c) for c, t in df.dtypes]
    )


def prefer_sourced(df: DataFrame, keys: Sequence[str], source: str, tie: Sequence[str]) -> DataFrame:
    """Duplicates of a filing keep the row that names its source, then the largest tie columns."""
    return keep_max(df, keys, [F.col(source).isNotNull(), *tie])


def _month_window(lo: int, hi: int) -> WindowSpec:
    return Window.partitionBy("code").orderBy("__month").rangeBetween(lo, hi)


def _with_month(df: DataFrame) -> DataFrame:
    return df.withColumn("__month", F.year("report_date") * 12 + F.month("report_date"))


def months_back(cols: Sequence[str], k: int) -> Column:
    """The report that ended k months earlier, as a struct; NULL when it is missing.

    A range frame on the month number reads exactly one earlier report of the same code.  That replaces a
    self-join, so a whole chain of look-backs runs behind one exchange.
    """
    point = F.first(F.struct("report_date", *cols)).over(_month_window(-k, -k))
    return F.when(point["report_date"] == F.add_months("report_date", -k), point)


def last_annual(cols: Sequence[str]) -> Column:
    """The December report of the previous year, as a struct."""
    december = F.when((F.month("report_date") == 12) & (F.dayofmonth("report_date") == 31), F.struct("report_date", *cols))
    point = F.last(december, ignorenulls=True).over(_month_window(-12, -3))
    return F.when(F.year(point["report_date"]) == F.year("report_date") - 1, point)


def ttm(col: str) -> Column:
    """Trailing twelve months of a cumulative column: itself in December, else + last annual - last year."""
    x = F.col(col)
    return F.when(F.month("report_date") == 12, x).otherwise(x + F.col("__a")[col] - F.col("__p")[col])


def with_prior_points(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Attach last year's same period (``__p``) and the last annual report (``__a``)."""
    return _with_month(df).withColumns({"__p": months_back(cols, 12), "__a": last_annual(cols)})


def financial_chain(core: DataFrame, ratio: DataFrame) -> DataFrame:
    """All periods with ratio columns as-of, TTM, yoy and single-quarter values.

    Nothing is dropped here: the TTM of a quarter needs the annual report before it, even when both were
    published on one day.  Only the right side of a daily as-of is reduced (``newest_report_asof``).
    """
    fin = asof_join(
        core,
        ratio.withColumn("equities_report_date", F.col("report_date")),
        ["code"],
        "report_date",
        "report_date",
        ["roe_parent", "bps", "total_assets", "equities", "equities_report_date"],
        left_unique=True,
    ).withColumn("equities_is_stale", ~F.col("equities_report_date").eqNullSafe(F.col("report_date")))

    money = ["net_profit_parent", "revenue"]

    def over_positive(x: Column, base: Column) -> Column:
        return F.when(base > 0, x / base - 1)

    p = F.col("__p")
    fin = with_prior_points(fin, money).select(
        *fin.columns,
        "__month",
        ttm("net_profit_parent").alias("np_ttm"),
        ttm("revenue").alias("rev_ttm"),
        over_positive(F.col("revenue"), p["revenue"]).alias("rev_yoy"),
        over_positive(F.col("net_profit_parent"), p["net_profit_parent"]).alias("np_yoy"),
    )

    w = Window.partitionBy("code", F.year("report_date")).orderBy("report_date")
    q, prev_q = F.quarter("report_date"), F.quarter(F.lag("report_date").over(w))
    fin = fin.withColumn("q_ok", F.coalesce((q == 1) | (q - prev_q == 1), F.lit(False)))

    def single(col: str) -> Column:
        x = F.col(col)
        return F.when(q == 1, x).when(F.col("q_ok"), x - F.lag(x).over(w))

    fin = fin.withColumns({
        "np_q": single("net_profit_parent"), "rev_q": single("revenue"), "eps_q": single("eps_basic"),
    })
    quarter_cols = ["np_q", "rev_q"]
    fin = fin.withColumn("__b", months_back(quarter_cols, 12))
    return fin.withColumns(
        {f"{c}_yoy": over_positive(F.col(c), F.col("__b")[c]) for c in quarter_cols}
    ).drop("__b", "__month")


def indicator_asof(indicator: DataFrame) -> DataFrame:
    return newest_report_asof(indicator)


def merge_statements(income: DataFrame, balance: DataFrame, cashflow: DataFrame) -> DataFrame:
    """Latest filing of each statement, merged per (code, report_date); known when the last one is out."""

    def latest(df: DataFrame, cols: Sequence[str], name: str, prefix: str = "") -> DataFrame:
        one = keep_max(df.select("code", "report_date", "pub_date", *cols), ["code", "report_date"], ["pub_date"])
        return one.select("code", "report_date", F.col("pub_date").alias(f"__pub_{name}"), *[F.col(c).alias(prefix + c) for c in cols])

    parts = [latest(income, INCOME, "i"), latest(balance, BALANCE, "b", "b_"), latest(cashflow, CASHFLOW, "c")]
    base = reduce(lambda a, b: a.join(b, ["code", "report_date"], "full"), parts)
    pub = F.greatest("__pub_i", "__pub_b", "__pub_c")
    return base.withColumn("pub_date", pub).drop("__pub_i", "__pub_b", "__pub_c")


def statement_layer(income: DataFrame, balance: DataFrame, cashflow: DataFrame) -> DataFrame:
    """``b_*`` balances, ``t_*`` trailing twelve months and ``c_*`` cumulative flows per report."""
    base = merge_statements(income, balance, cashflow)
    flows = [*INCOME, *CASHFLOW]
    joined = with_prior_points(base, flows)
    return joined.select(
        "code", "report_date", "pub_date",
        *[f"b_{c}" for c in BALANCE],
        *[(F.col(c) + F.col("__a")[c] - F.col("__p")[c]).alias(f"t_{c}") for c in flows],
        *[F.col(c).alias(f"c_{c}") for c in flows],
    )


GROWTH = {"rev": "revenue", "tp": "profit_before_tax", "np": "net_profit_total", "npp": "net_profit_parent"}


def growth_rates(core: DataFrame) -> DataFrame:
    """TTM growth against the signed base, and the five-point slope over the mean of revenue and profit."""
    cols = list(GROWTH.values())
    t = with_prior_points(core, cols).select(
        "code", "report_date", "pub_date", *[ttm(c).alias(f"ttm_{k}") for k, c in GROWTH.items()]
    )
    names = [f"ttm_{k}" for k in GROWTH]
    out = _with_month(t).withColumns({f"__y{y}": months_back(names, 12 * y) for y in range(1, 5)})

    def growth(k: str) -> Column:
        base = F.col("__y1")[f"ttm_{k}"]
        return safe_div(F.col(f"ttm_{k}"), base) - 1

    def trend(k: str) -> Column:
        now, y1, y2, y3, y4 = [F.col(f"ttm_{k}"), *[F.col(f"__y{i}")[f"ttm_{k}"] for i in range(1, 5)]]
        mean = (now + y1 + y2 + y3 + y4) / 5.0
        slope = (2 * now + y1 - y3 - 2 * y4) / 10.0
        return F.when(y4.isNotNull() & (F.abs(mean) > 1), slope / F.abs(mean))

    return out.select(
        *t.columns, *[growth(k).alias(f"g_{k}") for k in GROWTH], trend("rev").alias("sg_approx"), trend("npp").alias("eg_approx")
    ).where(F.col("pub_date").isNotNull())


def stack_snapshots(parts: dict[str, DataFrame]) -> DataFrame:
    """Dated snapshots of one table, stacked."""
    frames = [df.withColumn("snapshot_date", F.to_date(F.lit(d))) for d, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def restatements(stacked: DataFrame, value: str) -> DataFrame:
    """Reports whose value differs between two consecutive snapshots."""
    w = Window.partitionBy("code", "report_date").orderBy("snapshot_date")
    return (
        stacked.withColumn("old_value", F.lag(value).over(w))
        .withColumn("old_snapshot", F.lag("snapshot_date").over(w))
        .where(F.col("old_snapshot").isNotNull() & ~F.col("old_value").eqNullSafe(F.col(value)))
        .select("code", "report_date", "old_snapshot", "snapshot_date", "old_value", F.col(value).alias("new_value"))
    )


def load_list(raw: DataFrame, dates: Sequence[str], year: Column, manifest: DataFrame) -> DataFrame:
    """A yearly text landing of an event list (unlocks, disclosure dates) as a typed table with its year.

    Stray carriage returns leave every text; the named dates are cast, what does not convert is NULL. Rows per year must be
    those that the extraction counted (``manifest``: year, expected); years without an expected number pass, others fail.
    """
    texts = [c for c, kind in raw.dtypes if kind == "string"]
    df = raw.withColumn("year", year).withColumns({c: F.replace(c, F.lit("\r"), F.lit("")) for c in texts})
    df = df.withColumns({c: F.col(c).try_cast("date") for c in dates})
    got = df.groupBy("year").agg(F.count(F.lit(1)).alias("__n"))  # a row a year, empty years included by the manifest
    both = got.join(manifest.select("year", "expected").where("expected is not null"), "year", "full")
    wrong = both.where(F.col("expected").isNotNull() & ~F.col("__n").eqNullSafe(F.col("expected")))
    told = wrong.agg(F.array_join(F.array_sort(F.collect_list(F.format_string("%s: %s rows, %s expected", "year", F.coalesce("__n", F.lit(0)), "expected"))), "; ").alias("__wrong"))
    checked = df.crossJoin(F.broadcast(told))  # one row
    fine = F.when(F.col("__wrong") != "", F.raise_error(F.col("__wrong")).cast("int")).otherwise(F.col("year"))
    return checked.withColumn("year", fine).drop("__wrong")


def carriage_returns(raw: DataFrame) -> DataFrame:
    """(n): the stray carriage returns in all texts of a landing."""
    each = [F.length(c) - F.length(F.replace(c, F.lit("\r"), F.lit(""))) for c, kind in raw.dtypes if kind == "string"]
    total = reduce(lambda a, b: a + b, [F.coalesce(F.sum(x), F.lit(0)) for x in each], F.lit(0))
    return raw.agg(total.cast("long").alias("n"))


def unlock_profile(unlocks: DataFrame) -> DataFrame:
    """Per reason: rows, codes, rows with an actual date, first and last expected date."""
    return unlocks.groupBy("limited_reason").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("code").alias("n_codes"), F.count("actual_unlimited_date").alias("n_actual"),
        F.min("expected_unlimited_date").alias("first_expected"), F.max("expected_unlimited_date").alias("last_expected"),
    )


def disclosure_punctuality(df: DataFrame) -> DataFrame:
    """(n, median_days, share_in_time, n_moved_1, n_moved_2, n_moved_3): final dates against the days of publication."""
    late = F.datediff("pub_date", "final_date")
    both = final_disclosure(df).withColumn("late", late)
    known = both.where("late is not null and appoint_date is not null")
    share = known.agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("late") <= 0).cast("int")).alias("share_in_time"))
    moved = df.agg(*[F.count(c).alias(f"n_moved_{i}") for i, c in enumerate(("first_date", "second_date", "third_date"), 1)])
    median = exact_quantiles(known, [], "late", {"median_days": 0.5}).select("median_days")
    return share.crossJoin(F.broadcast(moved)).join(F.broadcast(median), F.lit(True), "left")


def final_disclosure(df: DataFrame) -> DataFrame:
    """The disclosure date after up to three postponements."""
    return df.withColumn("final_date", F.coalesce("third_date", "second_date", "first_date", "appoint_date"))


def visible_dividends(df: DataFrame) -> DataFrame:
    """Earliest stage date that makes a plan known; without any, the registration date with a flag."""
    stage = F.coalesce("board_plan_pub_date", "shareholders_plan_pub_date", "implementation_pub_date")
    return df.withColumns({
        "visible_date": F.coalesce(stage, F.col("a_registration_date")),
        "visible_date_is_fallback": stage.isNull(),
    })
