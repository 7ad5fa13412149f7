"""The named queries of the library and their SQL for another engine."""

from __future__ import annotations

from ..sources import trade
from . import analysis, concordance, dataframe, inference, quality, relational, tenday

SECTIONS = (relational, concordance, tenday, analysis, quality, inference)


def queries() -> dict:
    out = {}
    for section in SECTIONS:
        for name, text in section.SQL.items():
            out[name] = lambda spark, sf_dir, text=text: trade.run(spark, sf_dir, text)
    return out | dataframe.QUERIES


def oracle_sql() -> dict[str, str]:
    out = {name: trade.duck_text(text) for section in SECTIONS for name, text in section.SQL.items()}
    return out | {name: trade.duck_text(text) for name, text in dataframe.ORACLES.items()} | dataframe.DUCK
