"""Schemas of the report tables."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _D, _TS = T.StringType(), T.IntegerType(), T.LongType(), T.DateType(), T.TimestampNTZType()


def _of(*cols: tuple) -> T.StructType:
    return T.StructType([T.StructField(n, t, null) for n, t, null in cols])


SW = [f"sw_l{k}_{x}" for k in (1, 2, 3) for x in ("code", "name")]
REPORTS = _of(("id", _L, False), ("stock_code", _S, False), ("stock_name", _S, True), ("report_year", _I, False), ("publish_date", _D, True), ("file_path", _S, True), ("created_at", _TS, True), ("score", _I, True), ("score_updated_at", _TS, True), *[(c, _S, True) for c in SW], ("industry_source", _S, True), ("industry_lookup_date", _D, True))
SECTIONS = _of(("id", _L, False), ("report_id", _L, False), *[(c, _S, True) for c in ("industry_section", "main_business_section", "future_section", "full_mda", "chairman_letter")], ("created_at", _TS, True))
HITS = _of(("id", _L, True), ("report_id", _L, False), ("keyword", _S, False), ("weight", _I, False), ("hit_count", _I, False), ("polarity", _S, False), ("updated_at", _TS, True), *[(c, _S, True) for c in ("example_text", "context", "context_sentence")])
STOCKS = _of(("id", _L, True), ("stock_code", _S, False), ("stock_name", _S, True), ("industry", _S, True), ("exchange", _S, True), *[(c, _S, True) for c in ("sw_l1", "sw_l1_code", "sw_l2", "sw_l2_code", "sw_l3", "sw_l3_code", "citic_l1", "citic_l1_code", "industry_source")], ("industry_lookup_date", _D, True), ("updated_at", _TS, True))
CANDIDATES = _of(("col", _S, True), ("title", _S, True), ("stock_code", _S, True), ("stock_name", _S, True), ("year", _I, True), ("publish_date", _S, True), ("ts", T.DoubleType(), True), ("ann", _S, True), ("file_path", _S, True), ("ordinal", _L, False))
POLARITIES = ("pos", "neg")
EXCHANGES = ("SSE", "SZSE", "BSE")
