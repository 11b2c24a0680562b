"""All queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from levyframe.llm import bpe, brown, chat, debruijn, hardneg, lcparse, linededup, mixing, quality, simhash, spelling, suffixdedup, urlfilter

MODULES = (mixing, quality, linededup, bpe, suffixdedup, simhash, lcparse, brown, chat, urlfilter, spelling, hardneg, debruijn)
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
SQL = {name: sql for m in MODULES for name, sql in m.SQL.items()}
