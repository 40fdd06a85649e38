"""DuckDB SQL for every registered query (the correctness oracle).

Each model is one CTE; a query's SQL is its final SELECT preceded by the
CTEs it needs, resolved from the dependency lists below. The SQL is written
independently of the Spark code: same specification, other engine.
"""

from __future__ import annotations

import re

from tickwise.functions.num import NULL_KEY_TOKEN
from tickwise.params import DEFAULT_PARAMS
from tickwise.operators import staging as St, macro as Mc
from tickwise.sources import testdata as Td, landing as Ld

BENCH = DEFAULT_PARAMS.benchmark
VOLW = DEFAULT_PARAMS.vol_window
BETAW = DEFAULT_PARAMS.beta_window
ANN = DEFAULT_PARAMS.annualisation
MIN_PAIR = DEFAULT_PARAMS.min_pair_obs


def R(x: str, n: int) -> str:
    """Rounding rule R1 in SQL."""
    return f"CAST(round(CAST(({x}) AS DECIMAL(38,12)), {n}) AS DOUBLE)"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def inlist(vals) -> str:
    return ", ".join(q(v) for v in vals)


def md5key(*parts: str) -> str:
    tok = q(NULL_KEY_TOKEN)
    inner = " || '-' || ".join(f"coalesce(CAST({p} AS VARCHAR), {tok})" for p in parts)
    return f"md5({inner})"


def _case(col: str, pairs, default="NULL") -> str:
    body = " ".join(f"WHEN {q(k)} THEN {v}" for k, v in pairs)
    return f"CASE {col} {body} ELSE {default} END"


UNIT_CASE = _case("series", [(k, q(v)) for k, v in Ld.SERIES_UNITS.items()]
                  + [("ipca", q(Ld.IPCA_UNIT))], q(Ld.DEFAULT_UNIT))


def _series_select(key_col: str, table) -> str:
    name = _case(key_col, [(k, q(s)) for k, s, _, _ in table])
    grain_month = "(" + " OR ".join(f"{key_col} = {q(k)}" for k, _, g, _ in table if g == "month") + ")"
    qq = _case(key_col, [(k, str(x)) for k, _, _, x in table])
    return (f"SELECT {name} AS series, CASE WHEN {grain_month} THEN CAST(date_trunc('month', d) AS DATE)"
            f" ELSE d END AS obs_date, {qq} AS q, cents FROM ord")


W_SYM = "PARTITION BY symbol ORDER BY trade_date"


def _rows(n):
    return f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW"


RUN = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"

FREQ_CASE = (f"CASE WHEN series IN ({inlist(St.DAILY_SERIES)}) THEN 'diario' "
             f"WHEN series IN ({inlist(St.MONTHLY_SERIES)}) THEN 'mensal' ELSE 'outro' END")
GROUP_CASE = (f"CASE WHEN series IN ({inlist(St.RATE_SERIES)}) THEN 'juros' "
              f"WHEN series IN ({inlist(St.INFLATION_SERIES)}) THEN 'inflacao' "
              f"WHEN series IN ({inlist(St.FX_SERIES)}) THEN 'cambio' "
              f"WHEN series IN ({inlist(St.ACTIVITY_SERIES)}) THEN 'atividade' ELSE 'outro' END")

_TUP = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"

# name -> (dependencies, body)
CTES: dict[str, tuple[list[str], str]] = {}


def cte(name, deps, body):
    CTES[name] = (deps, body)


cte("li_part", [], f"""
  SELECT regexp_replace(upper(p.p_brand), '#', '') AS symbol,
         CAST(l.l_shipdate AS DATE) AS trade_date,
         CAST(round(l.l_extendedprice * 100) AS BIGINT) * CAST(round((1 - l.l_discount) * 100) AS BIGINT) AS x,
         CAST(l.l_quantity AS BIGINT) AS qty, l.l_orderkey, l.l_linenumber, l.l_partkey,
         l.l_suppkey, l.l_extendedprice
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey""")

_BAR_AGG = f"""
    first(l_extendedprice ORDER BY {_TUP}) AS open,
    max(l_extendedprice) AS high, min(l_extendedprice) AS low,
    first(l_extendedprice ORDER BY {_TUP.replace(', ', ' DESC, ')} DESC) AS close,
    CAST((200 * sum(x) + count(*)) // (2 * count(*)) AS DOUBLE) / 1e6 AS adj_close,
    CAST(sum(qty) AS BIGINT) AS volume, 'yahoo_finance' AS source"""

cte("raw_bars", ["li_part"], f"""
  SELECT symbol, trade_date, {_BAR_AGG}
  FROM li_part WHERE symbol IS NOT NULL GROUP BY symbol, trade_date
  UNION ALL
  SELECT {q(BENCH)} AS symbol, trade_date, {_BAR_AGG}
  FROM li_part GROUP BY trade_date""")

cte("ord", [], """
  SELECT o_orderpriority, o_orderstatus, CAST(o_orderdate AS DATE) AS d,
         CAST(round(o_totalprice * 100) AS BIGINT) AS cents
  FROM orders""")

cte("macro_obs", ["ord"], f"""
  {_series_select('o_orderpriority', Td.PRIORITY_SERIES)}
  UNION ALL
  {_series_select('o_orderstatus', Td.STATUS_SERIES)}""")

cte("raw_macro", ["macro_obs"], f"""
  SELECT obs_date, series,
         CAST((2 * sum(cents) + q * count(*)) // (2 * q * count(*)) AS DOUBLE) / 1e6 AS value,
         {UNIT_CASE} AS unit,
         CASE WHEN series = 'ipca' THEN 'ibge' ELSE 'bcb' END AS source
  FROM macro_obs WHERE series IS NOT NULL GROUP BY series, obs_date, q""")

cte("raw_assets", [], f"""
  SELECT symbol,
    CASE WHEN symbol = {q(BENCH)} THEN 'Benchmark index'
         WHEN n % 2 <> 0 THEN 'Company ' || symbol END AS name,
    CASE WHEN symbol = {q(BENCH)} THEN 'Index'
         WHEN n % 5 <> 0 THEN 'Sector ' || CAST(CAST(trunc(n / 10) AS INTEGER) AS VARCHAR) END AS sector,
    CASE WHEN symbol <> {q(BENCH)} THEN 'Industry ' || CAST(n % 10 AS VARCHAR) END AS subsector,
    CASE WHEN symbol = {q(BENCH)} THEN 'INDICE' ELSE 'ACAO' END AS kind,
    'Brasil' AS country, 'BRL' AS currency, true AS active
  FROM (SELECT symbol,
          CASE WHEN regexp_extract(symbol, '([0-9]+)$', 1) <> ''
               THEN CAST(regexp_extract(symbol, '([0-9]+)$', 1) AS INTEGER) END AS n
        FROM (SELECT DISTINCT regexp_replace(upper(p_brand), '#', '') AS symbol FROM part
              WHERE p_brand IS NOT NULL
              UNION SELECT {q(BENCH)}) u) s""")

cte("stg_bars", ["raw_bars"], """
  SELECT symbol, CAST(trade_date AS DATE) AS trade_date,
    CAST(nullif(open, 0) AS DECIMAL(18,6)) AS open,
    CAST(nullif(high, 0) AS DECIMAL(18,6)) AS high,
    CAST(nullif(low, 0) AS DECIMAL(18,6)) AS low,
    CAST(nullif(close, 0) AS DECIMAL(18,6)) AS close,
    CAST(nullif(adj_close, 0) AS DECIMAL(18,6)) AS adj_close,
    CAST(coalesce(volume, 0) AS BIGINT) AS volume, source
  FROM raw_bars
  WHERE adj_close IS NOT NULL AND adj_close > 0 AND trade_date IS NOT NULL""")

cte("stg_macro", ["raw_macro"], f"""
  SELECT CAST(obs_date AS DATE) AS obs_date, lower(series) AS series,
         CAST(value AS DECIMAL(18,6)) AS value, unit, source,
         {FREQ_CASE} AS frequency, {GROUP_CASE} AS series_group
  FROM raw_macro WHERE value IS NOT NULL""")

cte("stg_assets", ["raw_assets"], f"""
  SELECT symbol, coalesce(name, symbol) AS name,
         coalesce(sector, {q(St.SECTOR_FALLBACK)}) AS sector, subsector,
         upper(kind) AS kind, country, upper(currency) AS currency, active
  FROM raw_assets WHERE symbol IS NOT NULL""")

cte("lagged", ["stg_bars"], f"""
  SELECT symbol, trade_date, adj_close, volume,
    lag(adj_close) OVER ({W_SYM}) AS prev_adj_close,
    CAST(datediff('day', lag(trade_date) OVER ({W_SYM}), trade_date) AS INTEGER) AS days_since_prev
  FROM stg_bars""")

_A, _P = "CAST(adj_close AS DOUBLE)", "CAST(prev_adj_close AS DOUBLE)"
cte("returns", ["lagged"], f"""
  SELECT symbol, trade_date, adj_close, prev_adj_close, volume, days_since_prev,
    CASE WHEN prev_adj_close > 0 THEN {R(f'({_A} - {_P}) / {_P}', 8)} END AS simple_return,
    CASE WHEN prev_adj_close > 0 THEN {R(f'ln({_A} / {_P})', 8)} END AS log_return
  FROM lagged WHERE prev_adj_close IS NOT NULL""")

cte("bench", ["returns"], f"""
  SELECT trade_date, simple_return AS bench_return, CAST(adj_close AS DOUBLE) AS bench_level
  FROM returns WHERE symbol = {q(BENCH)}""")

cte("ret_b", ["returns", "bench"], """
  SELECT r.*, b.bench_return, b.bench_level, (b.bench_level IS NOT NULL) AS has_bench
  FROM returns r LEFT JOIN bench b ON b.trade_date = r.trade_date""")

_WB = f"PARTITION BY symbol, has_bench ORDER BY trade_date {_rows(BETAW)}"
cte("fact_win", ["ret_b"], f"""
  SELECT *,
    {R(f'stddev_samp(simple_return) OVER ({W_SYM} {_rows(VOLW)}) * sqrt({ANN}.0)', 6)} AS ann_vol,
    {R(f'avg(simple_return) OVER ({W_SYM} {_rows(VOLW)})', 8)} AS mean_return_window,
    {R(f'exp(sum(log_return) OVER ({W_SYM} {RUN})) - 1', 6)} AS cum_return,
    {R(f'exp(sum(log_return) OVER (PARTITION BY symbol, year(trade_date) ORDER BY trade_date {RUN})) - 1', 6)} AS ytd_return,
    CASE WHEN has_bench AND symbol <> {q(BENCH)} THEN
      {R(f'covar_pop(simple_return, bench_return) OVER ({_WB}) / nullif(var_pop(bench_return) OVER ({_WB}), 0)', 4)}
    END AS beta
  FROM ret_b""")

cte("spine", ["stg_macro"], "SELECT DISTINCT obs_date FROM stg_macro")

_PD = ",\n    ".join(f"max(CASE WHEN series = {q(s)} THEN value END) AS {o}" for s, o in Mc.DAILY_PIVOT)
_PM = ",\n    ".join(f"max(CASE WHEN series = {q(s)} THEN value END) AS {o}" for s, o in Mc.MONTHLY_PIVOT)
cte("pivot_daily", ["stg_macro"], f"""
  SELECT obs_date, {_PD} FROM stg_macro WHERE frequency = 'diario' GROUP BY obs_date""")
cte("pivot_monthly", ["stg_macro"], f"""
  SELECT CAST(date_trunc('month', obs_date) AS DATE) AS month, {_PM}
  FROM stg_macro WHERE frequency = 'mensal' GROUP BY 1""")

_DCOLS = [o for _, o in Mc.DAILY_PIVOT]
_MCOLS = [o for _, o in Mc.MONTHLY_PIVOT]
cte("macro_wide", ["spine", "pivot_daily", "pivot_monthly"], f"""
  SELECT s.obs_date, {', '.join('pd.' + c for c in _DCOLS)}, {', '.join('pm.' + c for c in _MCOLS)},
    sum(pd.cdi_daily) OVER (PARTITION BY date_trunc('month', s.obs_date) ORDER BY s.obs_date {RUN}) AS cdi_mtd_sum
  FROM spine s
  LEFT JOIN pivot_daily pd ON pd.obs_date = s.obs_date
  LEFT JOIN pivot_monthly pm ON pm.month = CAST(date_trunc('month', s.obs_date) AS DATE)""")

_r = "simple_return"
cte("price_fact", ["fact_win", "macro_wide"], f"""
  SELECT {md5key('f.symbol', 'f.trade_date')} AS id, f.symbol, f.trade_date,
    CAST(f.adj_close AS DOUBLE) AS adj_close, CAST(f.prev_adj_close AS DOUBLE) AS prev_adj_close,
    f.volume, f.simple_return, f.log_return, {R('f.simple_return * 100', 4)} AS return_pct,
    f.cum_return, f.ytd_return, f.ann_vol, f.beta,
    CAST(m.selic_daily AS DOUBLE) AS selic_daily, CAST(m.cdi_daily AS DOUBLE) AS cdi_daily,
    CAST(m.usd_brl AS DOUBLE) AS usd_brl, CAST(m.ipca_monthly AS DOUBLE) AS ipca_monthly,
    CAST(m.selic_target AS DOUBLE) AS selic_target,
    CASE WHEN m.ipca_monthly IS NOT NULL AND m.ipca_monthly <> 0 THEN
      {R('(1 + f.simple_return) / (1 + CAST(m.ipca_monthly AS DOUBLE) / 100) - 1', 8)} END AS real_return,
    CASE WHEN m.cdi_daily IS NOT NULL THEN
      {R('f.simple_return - CAST(m.cdi_daily AS DOUBLE) / 100', 8)} END AS excess_return,
    f.bench_return, f.bench_level, f.days_since_prev
  FROM fact_win f LEFT JOIN macro_wide m ON m.obs_date = f.trade_date""")


def build(final_sql: str, extra_deps: list[str] | None = None) -> str:
    """Prefix ``final_sql`` with every CTE it references (transitively)."""
    names = set(extra_deps or [])
    for name in CTES:
        if re.search(rf"\b{re.escape(name)}\b", final_sql):
            names.add(name)
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in sorted(names):
        visit(n)
    if not order:
        return final_sql
    body = ",\n".join(f"{n} AS ({CTES[n][1]}\n)" for n in order)
    head = final_sql.lstrip()
    if head[:4].upper() == "WITH":
        return f"WITH {body},\n{head[4:].lstrip()}"
    return f"WITH {body}\n{final_sql}"


# ---- asset dimension -------------------------------------------------------
_PX = "CAST(adj_close AS DOUBLE)"
cte("asset_agg", ["price_fact"], f"""
  SELECT symbol, count(*) AS sessions, min(trade_date) AS first_date, max(trade_date) AS last_date,
    {R(f'avg({_PX})', 2)} AS avg_price, {R(f'min({_PX})', 2)} AS min_price,
    {R(f'max({_PX})', 2)} AS max_price, {R('avg(CAST(volume AS DOUBLE))', 0)} AS avg_daily_volume,
    arg_max(struct_pack(snapshot_date := trade_date, last_price := adj_close,
                        cum_return_total := cum_return, ytd_return := ytd_return,
                        current_vol := ann_vol, current_beta := beta), trade_date) AS snap
  FROM price_fact GROUP BY symbol""")

RISK_CASE = ("CASE WHEN {v} < 0.20 THEN 'baixo' WHEN {v} < 0.40 THEN 'medio' ELSE 'alto' END")
cte("asset_dim", ["stg_assets", "asset_agg"], f"""
  SELECT {md5key('a.symbol')} AS id, a.symbol, a.name, a.sector, a.subsector, a.kind, a.country,
    a.currency, a.active, s.sessions, s.first_date, s.last_date, s.avg_price, s.min_price,
    s.max_price, s.avg_daily_volume, s.snap.last_price AS last_price,
    s.snap.cum_return_total AS cum_return_total, s.snap.ytd_return AS ytd_return,
    s.snap.current_vol AS current_vol, s.snap.current_beta AS current_beta,
    {RISK_CASE.format(v='s.snap.current_vol')} AS risk_profile
  FROM stg_assets a LEFT JOIN asset_agg s ON s.symbol = a.symbol""")

# ---- risk mart ---------------------------------------------------------------
cte("fact_nb", ["price_fact"], f"SELECT * FROM price_fact WHERE symbol <> {q(BENCH)}")
cte("fact_dd", ["fact_nb"], f"""
  SELECT *, {R('(CAST(adj_close AS DOUBLE) - running_peak) / nullif(running_peak, 0)', 6)} AS drawdown
  FROM (SELECT *, CAST(max(adj_close) OVER ({W_SYM} {RUN}) AS DOUBLE) AS running_peak FROM fact_nb) t""")

_VOL = f"stddev_samp(simple_return) * sqrt({ANN}.0)"
_NEG = "CASE WHEN simple_return < 0 THEN simple_return ELSE 0.0 END"
cte("annual", ["fact_dd"], f"""
  SELECT symbol, CAST(year(trade_date) AS INTEGER) AS year, count(*) AS sessions,
    {R('sum(simple_return)', 6)} AS annual_return,
    {R('exp(sum(log_return)) - 1', 6)} AS annual_return_comp,
    {R(_VOL, 6)} AS annual_vol,
    {R(f'avg(simple_return) * {ANN}', 6)} AS annual_mean_return,
    {R(f'(avg(simple_return) * {ANN} - avg(coalesce(cdi_daily, 0.0) / 100) * {ANN}) / nullif({_VOL}, 0)', 4)} AS sharpe,
    {R('quantile_cont(simple_return, 0.05)', 6)} AS var_95,
    {R('quantile_cont(simple_return, 0.01)', 6)} AS var_99,
    CAST(count_if(simple_return > 0) AS BIGINT) AS up_days,
    CAST(count_if(simple_return < 0) AS BIGINT) AS down_days,
    {R('avg(beta)', 4)} AS mean_beta,
    {R(f'(avg(simple_return) * {ANN}) / nullif(sqrt(sum(({_NEG}) * ({_NEG})) / nullif(count(*) - 1, 0)) * sqrt({ANN}.0), 0)', 4)} AS sortino,
    {R('min(drawdown)', 6)} AS max_drawdown
  FROM fact_dd GROUP BY symbol, year(trade_date)""")

SHARPE_CASE = ("CASE WHEN {v} >= 1 THEN 'excelente' WHEN {v} >= 0.5 THEN 'bom' "
               "WHEN {v} >= 0 THEN 'neutro' ELSE 'negativo' END")
cte("risk_mart", ["annual"], f"""
  SELECT {md5key('symbol', 'year')} AS id, symbol, year, sessions,
    {R('annual_return_comp * 100', 2)} AS annual_return_pct,
    {R('annual_vol * 100', 2)} AS volatility_pct, sharpe, sortino, mean_beta,
    {R('var_95 * 100', 4)} AS var_95_pct, {R('var_99 * 100', 4)} AS var_99_pct,
    {R('max_drawdown * 100', 4)} AS max_drawdown_pct, up_days, down_days,
    sessions AS total_sessions,
    {R('CAST(up_days AS DOUBLE) / nullif(CAST(sessions AS DOUBLE), 0) * 100', 2)} AS win_rate_pct,
    {SHARPE_CASE.format(v='sharpe')} AS sharpe_class
  FROM annual""")

# ---- correlation mart -------------------------------------------------------------
cte("pair_ret", ["price_fact"], f"""
  SELECT symbol, trade_date, simple_return AS r FROM price_fact
  WHERE simple_return IS NOT NULL AND symbol <> {q(BENCH)}""")
cte("pair_mom", ["pair_ret"], """
  SELECT a.symbol AS symbol_a, b.symbol AS symbol_b, CAST(year(a.trade_date) AS INTEGER) AS year,
    count(*) AS n_obs,
    covar_pop(a.r, b.r) / nullif(stddev_pop(a.r) * stddev_pop(b.r), 0) AS corr_raw
  FROM pair_ret a JOIN pair_ret b ON a.trade_date = b.trade_date AND a.symbol < b.symbol
  GROUP BY 1, 2, 3""")
CORR_CASE = ("CASE WHEN {v} >= 0.7 THEN 'alta_positiva' WHEN {v} >= 0.3 THEN 'moderada_positiva' "
             "WHEN {v} >= -0.3 THEN 'neutra' WHEN {v} >= -0.7 THEN 'moderada_negativa' "
             "ELSE 'alta_negativa' END")
DIV_CASE = ("CASE WHEN abs({v}) < 0.3 THEN 'alto' WHEN abs({v}) < 0.6 THEN 'moderado' "
            "ELSE 'baixo' END")
cte("pair_corr", ["pair_mom"], f"""
  SELECT symbol_a, symbol_b, year, n_obs,
    {R("CASE WHEN isnan(corr_raw) THEN NULL ELSE corr_raw END", 4)} AS correlation
  FROM pair_mom WHERE n_obs >= {MIN_PAIR}""")
cte("correlation_mart", ["pair_corr"], f"""
  SELECT {md5key('symbol_a', 'symbol_b', 'year')} AS id, symbol_a, symbol_b, year, n_obs,
    correlation, {CORR_CASE.format(v='correlation')} AS corr_class,
    {DIV_CASE.format(v='correlation')} AS diversification
  FROM pair_corr""")

cte("beta_global", ["ret_b"], f"""
  SELECT symbol, trade_date,
    {R(f'covar_pop(simple_return, bench_return) OVER ({W_SYM} {_rows(BETAW)}) / '
       f'nullif(var_pop(bench_return) OVER (ORDER BY trade_date, symbol {_rows(BETAW)}), 0)', 4)} AS beta
  FROM ret_b WHERE has_bench AND symbol <> {q(BENCH)}""")


# ---- data quality ---------------------------------------------------------------------------
cte("raw_bars_t", ["raw_bars"], f"SELECT {md5key('symbol', 'trade_date')} AS id, * FROM raw_bars")
cte("raw_macro_t", ["raw_macro"], f"SELECT {md5key('obs_date', 'series')} AS id, * FROM raw_macro")
cte("raw_assets_t", ["raw_assets"], f"SELECT {md5key('symbol')} AS id, * FROM raw_assets")

TEST_TABLES = {"raw_bars": "raw_bars_t", "raw_macro": "raw_macro_t", "raw_assets": "raw_assets_t",
               "stg_bars": "stg_bars", "stg_macro": "stg_macro", "stg_assets": "stg_assets",
               "daily_returns": "returns", "macro_wide": "macro_wide", "price_fact": "price_fact",
               "asset_dim": "asset_dim", "risk_mart": "risk_mart",
               "correlation_mart": "correlation_mart"}


def _test_count_sql(t) -> str:
    tb, c = TEST_TABLES[t.model], t.column
    if t.kind == "not_null":
        return f"SELECT count(*) FROM {tb} WHERE {c} IS NULL"
    if t.kind == "expression":
        w = f"({t.where}) AND " if t.where else ""
        return f"SELECT count(*) FROM {tb} WHERE {w}NOT ({c} {t.expr})"
    if t.kind == "unique":
        return (f"SELECT count(*) FROM (SELECT {c} FROM {tb} WHERE {c} IS NOT NULL "
                f"GROUP BY {c} HAVING count(*) > 1) d")
    return (f"SELECT count(*) FROM (SELECT DISTINCT {c} FROM {tb} WHERE {c} IS NOT NULL "
            f"AND {c} NOT IN ({inlist(t.values)})) d")


def tests_sql(tests) -> str:
    rows = [f"SELECT {q(t.test_id)} AS test_id, {q(t.model)} AS model, {q(t.kind)} AS kind, "
            f"{q(t.column)} AS column_name, CAST(({_test_count_sql(t)}) AS BIGINT) AS failures"
            for t in tests]
    return "SELECT *, failures = 0 AS passed FROM (\n" + "\nUNION ALL\n".join(rows) + "\n) t"


EXP_TABLES = {"suite_bars": "raw_bars", "suite_macro": "raw_macro"}


def _lit(v) -> str:
    return "NULL" if v is None else repr(v) if not isinstance(v, str) else q(v)


def _bounds_sql(c, lo, hi) -> str:
    parts = []
    if lo is not None:
        parts.append(f"{c} >= {lo}")
    if hi is not None:
        parts.append(f"{c} <= {hi}")
    return " AND ".join(parts) or "true"


def _mostly_sql(el, un, mostly) -> str:
    m = 1.0 if mostly is None else float(mostly)
    return (f"({el} = 0 OR (CAST({el} AS DOUBLE) - CAST({un} AS DOUBLE)) / "
            f"CAST({el} AS DOUBLE) >= {m})")


def expectation_sql(e, idx: int) -> str:
    tb = EXP_TABLES[e.suite]
    t = e.etype
    cond = e.kw("row_condition") or "true"
    c = e.column
    colname = e.column or ",".join(e.kw("column_list") or [e.kw("column_A") or "", e.kw("column_B") or ""])
    head = (f"SELECT {q(e.suite)} AS suite, {idx} AS expectation_idx, {q(t)} AS expectation_type, "
            f"{q(colname)} AS column_name, ")
    if t == "expect_table_row_count_to_be_between":
        inner = f"SELECT count(*) AS el, CAST(NULL AS BIGINT) AS un, CAST(count(*) AS DOUBLE) AS obs FROM {tb}"
        succ = f"coalesce({_bounds_sql('obs', e.kw('min_value'), e.kw('max_value'))}, false)"
    elif t == "expect_column_stdev_to_be_between":
        inner = (f"SELECT count({c}) AS el, CAST(NULL AS BIGINT) AS un, {R(f'stddev_samp({c})', 6)} AS obs "
                 f"FROM {tb}")
        succ = f"coalesce({_bounds_sql('obs', e.kw('min_value'), e.kw('max_value'))}, false)"
    elif t == "expect_compound_columns_to_be_unique":
        cols = e.kw("column_list")
        keep = " OR ".join(f"{x} IS NOT NULL" for x in cols)
        inner = (f"SELECT coalesce(sum(n), 0) AS el, coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS un, "
                 f"CAST(NULL AS DOUBLE) AS obs FROM (SELECT count(*) AS n FROM {tb} WHERE {keep} "
                 f"GROUP BY {', '.join(cols)}) g")
        succ = _mostly_sql("el", "un", e.kw("mostly"))
    else:
        if t == "expect_column_values_to_not_be_null":
            el, bad = f"({cond})", f"{c} IS NULL"
        elif t == "expect_column_pair_values_a_to_be_greater_than_b":
            a, b = e.kw("column_A"), e.kw("column_B")
            op = ">=" if e.kw("or_equal") else ">"
            el = f"({cond}) AND NOT ({a} IS NULL AND {b} IS NULL)"
            bad = f"NOT coalesce({a} {op} {b}, false)"
        else:
            el = f"({cond}) AND {c} IS NOT NULL"
            if t == "expect_column_values_to_be_between":
                bad = f"NOT ({_bounds_sql(c, e.kw('min_value'), e.kw('max_value'))})"
            elif t == "expect_column_values_to_be_in_set":
                bad = f"{c} NOT IN ({inlist(e.kw('value_set'))})"
            elif t == "expect_column_values_to_match_regex":
                bad = f"NOT regexp_matches({c}, {q(e.kw('regex'))})"
            else:   # dateutil parseable: the column is a DATE
                bad = "false"
        inner = (f"SELECT count(*) FILTER (WHERE {el}) AS el, "
                 f"count(*) FILTER (WHERE ({el}) AND ({bad})) AS un, CAST(NULL AS DOUBLE) AS obs FROM {tb}")
        succ = _mostly_sql("el", "un", e.kw("mostly"))
    return (f"{head}CAST(el AS BIGINT) AS element_count, CAST(un AS BIGINT) AS unexpected_count, "
            f"CAST(obs AS DOUBLE) AS observed_value, {succ} AS success FROM ({inner}) x")


def expectations_sql(exps, all_exps) -> str:
    idx = {id(e): i for i, e in enumerate(all_exps)}
    return "\nUNION ALL\n".join(expectation_sql(e, idx[id(e)]) for e in exps)
