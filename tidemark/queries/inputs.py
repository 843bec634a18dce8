"""Library inputs assembled from the stand-in relations."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.plans.bars import code_map
from tidemark.plans.dimensions import industry_intervals, name_intervals
from tidemark.plans.panel import PanelInputs, base_bars, panel_daily
from tidemark.queries.registry import Inputs


def codes(r: Inputs) -> DataFrame:
    return code_map(r("bars"), r("symbol_class"), r("universe"))


def known_codes(r: Inputs) -> DataFrame:
    """``codes``, computed once: bars meet them several times, and by its files the optimizer sees that the table is small."""
    return r.store("bars_sk", "universe").keep("code_map", codes)


def px(r: Inputs) -> DataFrame:
    known = known_codes(r)
    return base_bars(r("bars"), r("adjust_factor"), known, r.parts("bars_sk"))


def panel(r: Inputs) -> DataFrame:
    # nearly every input is derived from the first two; the others are small and read several times
    r.store("bars_sk", "filings", "universe", "index_member_asof")
    known = known_codes(r)
    return panel_daily(PanelInputs(
        bars=r("bars"), factor=r("adjust_factor"), basic=r("basic_daily"), codes=known, core=r("fin_core"),
        ratio=r("fin_ratio"), indicator=r("indicator_q"), share_change=r("share_change"), status=r("security_status"),
        names=name_intervals(r("name_history")), industries=industry_intervals(r("industry_snapshot")),
        universe=r("universe"), members=r("index_member_asof"),
    ), r.parts("bars_sk"))
