"""Many reports from one scan.

The reference re-reads and re-parses its whole input once per report.  Here
all reports of a set are answered by a single grouping-sets aggregate: the
input is read once, each row is expanded once per grouping set inside the
same codegen stage, partially aggregated per map task, and only one row per
(set, key, task) is shuffled.  ``grouping_id`` tells a null key ("null
group") from "not grouped by this column", which both show as null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlens.operators.reports import REPORTS, ReportSpec

GID = "_gid"


def _specs(names_or_specs) -> list[ReportSpec]:
    return [REPORTS[s] if isinstance(s, str) else s for s in names_or_specs]


def _keys(specs: list[ReportSpec]) -> list[str]:
    keys: list[str] = []
    for s in specs:
        if s.key is not None and s.key not in keys:
            keys.append(s.key)
    return keys


def grouping_id_of(spec: ReportSpec, keys: list[str]) -> int:
    """Value of grouping_id() for the grouping set of ``spec``."""
    n = len(keys)
    gid = 0
    for j, k in enumerate(keys):
        if k != spec.key:
            gid |= 1 << (n - 1 - j)
    return gid


def _key_exprs(specs: list[ReportSpec]) -> dict[str, Column]:
    exprs: dict[str, Column] = {}
    for s in specs:
        if s.key is not None and s.key not in exprs:
            exprs[s.key] = s.key_column()
    return exprs


def fused_aggregate(df: DataFrame, names_or_specs) -> DataFrame:
    """One grouping-sets aggregate answering every report in the set.

    Output: one column per distinct key, ``_gid`` and one column per
    (report, measure) named ``<report>__<measure>``.  Identical aggregate
    expressions shared by several reports are computed once by Catalyst.
    """
    specs = _specs(names_or_specs)
    for s in specs:
        if s.drop_null_keys:
            raise ValueError(f"{s.name}: null-dropping reports cannot be fused")
    keys = _keys(specs)
    key_exprs = _key_exprs(specs)
    inputs: list[str] = []
    for s in specs:
        inputs += [c for m in s.measures for c in m.inputs]
    inputs = [c for c in dict.fromkeys(inputs) if c not in key_exprs]
    narrow = df.select(*[e.alias(k) for k, e in key_exprs.items()], *inputs)
    sets = [[k] if k is not None else [] for k in
            dict.fromkeys(s.key for s in specs)]
    aggs = [F.grouping_id().alias(GID)]
    for s in specs:
        aggs += [m.expr().alias(f"{s.name}__{m.name}") for m in s.measures]
    return narrow.groupingSets(sets, *keys).agg(*aggs)


def split_fused(fused: DataFrame, names_or_specs) -> dict[str, DataFrame]:
    """Slice the fused result back into one DataFrame per report."""
    specs = _specs(names_or_specs)
    keys = _keys(specs)
    out = {}
    for s in specs:
        cols = [F.col(s.key)] if s.key is not None else []
        cols += [F.col(f"{s.name}__{m.name}").alias(m.name) for m in s.measures]
        out[s.name] = fused.where(F.col(GID) == grouping_id_of(s, keys)).select(*cols)
    return out


def long_form(fused: DataFrame, names_or_specs, dimension_col: str = "dimension",
              value_col: str = "key_value") -> DataFrame:
    """Reports that share their measure names, stacked: one row per
    (dimension, key value) with the key as text."""
    specs = _specs(names_or_specs)
    keys = _keys(specs)
    measure_names = [m.name for m in specs[0].measures]
    for s in specs:
        if [m.name for m in s.measures] != measure_names:
            raise ValueError("long form needs reports with the same measures")
    gid = F.col(GID)
    dim = val = None
    meas = {m: None for m in measure_names}
    for s in specs:
        cond = gid == grouping_id_of(s, keys)
        dim = F.when(cond, F.lit(s.key)) if dim is None else dim.when(cond, F.lit(s.key))
        k = F.col(s.key).cast("string")
        val = F.when(cond, k) if val is None else val.when(cond, k)
        for m in measure_names:
            c = F.col(f"{s.name}__{m}")
            meas[m] = F.when(cond, c) if meas[m] is None else meas[m].when(cond, c)
    return fused.select(dim.alias(dimension_col), val.alias(value_col),
                        *[e.alias(m) for m, e in meas.items()])


def fraud_all_dimensions(df: DataFrame, names) -> DataFrame:
    """Fused fraud-rate reports in long form."""
    return long_form(fused_aggregate(df, names), names)
