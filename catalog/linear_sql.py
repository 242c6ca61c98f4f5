"""Least squares in DuckDB SQL: correlations, swept one predictor at a time."""

from __future__ import annotations

from collections.abc import Sequence

from switchflow.operators.models import ALIAS_TOLERANCE, READINGS, TARGET, expand_terms


def _expression(term: str) -> str:
    if term.endswith("^2"):
        return f"{term[:-2]} * {term[:-2]}"
    return term.replace(":", " * ")


def fit_sql(prelude: str, terms: Sequence[str], tag: str = "", rows: Sequence[str] = ()) -> str:
    """CTEs after `prelude` (which ends in a table `model`): coef{tag} and fit{tag}.

    A sweep of the correlation matrix turns its block of predictors into the inverse,
    the target's column into standardized coefficients, and the last cell into 1 - R².
    A predictor that earlier ones explain is passed over. Rows that lack one of the terms, or of the terms in
    `rows`, are left out.
    """
    terms = expand_terms(terms)
    p = len(terms)
    columns = [f"CAST({_expression(t)} AS DOUBLE) AS x{i}" for i, t in enumerate([*terms, TARGET])]
    whole = " AND ".join(f"({_expression(t)}) IS NOT NULL" for t in dict.fromkeys([*terms, *expand_terms(rows), TARGET]))
    pairs = [(i, j) for i in range(p + 1) for j in range(i, p + 1)]
    value = lambda i, j: f"CASE WHEN sd{i} > 0 THEN 1.0 ELSE 0.0 END" if i == j else f"CASE WHEN sd{i} > 0 AND sd{j} > 0 THEN c{i}_{j} ELSE 0.0 END"
    cells = ", ".join(f"{{'i': {i}, 'j': {j}, 'v': {value(min(i, j), max(i, j))}}}" for i in range(p + 1) for j in range(p + 1))
    out = [
        f"obs{tag} AS (SELECT {', '.join(columns)} FROM model WHERE {whole})",
        f"stat{tag} AS MATERIALIZED (SELECT count(*) AS n, {', '.join(f'stddev_pop(x{i}) AS sd{i}' for i in range(p + 1))}, "
        + ", ".join(f"CASE WHEN min(x{i}) < max(x{i}) AND min(x{j}) < max(x{j}) THEN corr(x{i}, x{j}) END AS c{i}_{j}" for i, j in pairs if i < j)
        + f" FROM obs{tag})",
        f"mat{tag}_0 AS MATERIALIZED (SELECT u.* FROM (SELECT unnest([{cells}]) AS u FROM stat{tag}))",
    ]
    for k in range(p):
        out.append(
            f"mat{tag}_{k + 1} AS MATERIALIZED (SELECT a.i, a.j, CASE WHEN p.v <= {ALIAS_TOLERANCE} THEN a.v WHEN a.i = {k} AND a.j = {k} THEN 1 / p.v"
            f" WHEN a.i = {k} THEN a.v / p.v WHEN a.j = {k} THEN -a.v / p.v ELSE a.v - r.v * c.v / p.v END AS v"
            f" FROM mat{tag}_{k} a JOIN mat{tag}_{k} p ON p.i = {k} AND p.j = {k} JOIN mat{tag}_{k} r ON r.i = a.i AND r.j = {k} JOIN mat{tag}_{k} c ON c.i = {k} AND c.j = a.j)"
        )
    kept = " UNION ALL ".join(f"SELECT {k} AS k, '{t}' AS variable, (SELECT sd{k} FROM stat{tag}) AS sd FROM mat{tag}_{k} WHERE i = {k} AND j = {k} AND v > {ALIAS_TOLERANCE}" for k, t in enumerate(terms))
    last = f"mat{tag}_{p}"
    out += [
        f"used{tag} AS MATERIALIZED ({kept})",
        f"fit{tag} AS MATERIALIZED (SELECT n, n - 1 - (SELECT count(*) FROM used{tag}) AS df, (SELECT v FROM {last} WHERE i = {p} AND j = {p}) AS rest, sd{p} AS sdy FROM stat{tag})",
        f"""unscaled{tag} AS MATERIALIZED (SELECT variable, b.v * sdy / sd AS coefficient, sqrt(d.v * rest / df) * sdy / sd AS std_error, d.v AS vif, df
 FROM used{tag} JOIN {last} b ON b.i = k AND b.j = {p} JOIN {last} d ON d.i = k AND d.j = k, fit{tag})""",
        # Two-sided p-value of Student's t: a finite series in cos(atan(t / sqrt(df))) for whole degrees of freedom.
        f"""tstat{tag} AS MATERIALIZED (SELECT *, coefficient / std_error AS t_value, atan(abs(coefficient / std_error) / sqrt(df)) AS angle FROM unscaled{tag})""",
        f"""steps{tag} AS MATERIALIZED (SELECT j, sum(CASE WHEN j = 0 THEN 0.0 WHEN df % 2 = 0 THEN ln((2.0 * j - 1) / (2.0 * j)) ELSE ln((2.0 * j) / (2.0 * j + 1)) END) OVER (ORDER BY j) AS lc
 FROM fit{tag}, generate_series(0, CAST(df // 2 - 1 AS BIGINT)) g(j))""",
        f"""coef{tag} AS MATERIALIZED (SELECT variable, coefficient, std_error, t_value, vif, greatest(0.0, 1 - CASE WHEN any_value(df) % 2 = 0 THEN sin(any_value(angle)) * sum(exp(lc + 2 * j * ln(cos(angle))))
 ELSE 2 / pi() * (any_value(angle) + sin(any_value(angle)) * sum(CASE WHEN 2 * j + 1 <= df - 2 THEN exp(lc + (2 * j + 1) * ln(cos(angle))) ELSE 0 END)) END) AS p_value
 FROM tstat{tag}, steps{tag} GROUP BY ALL)""",
    ]
    return prelude + ", " + ",\n".join(out)


def digits(column: str) -> str:
    """A double as text with six significant digits, so that ways of summing do not show."""
    return f"printf('%.5e', {column})"


def table_sql(prelude: str, terms: Sequence[str], level: float = 0.05, only: str = "") -> str:
    """The coefficient table with its readings."""
    reading = " ".join(
        f"WHEN variable = '{v}'" + (f" AND coefficient {'>' if sign > 0 else '<='} 0" if sign else "") + f" THEN '{text}'" for (v, sign), text in READINGS.items()
    )
    return f"""{fit_sql(prelude, terms)}
SELECT variable, {digits('coefficient')} AS coefficient, {digits('std_error')} AS std_error, {digits('t_value')} AS t_value, round(p_value, 6) AS p_value,
 CASE WHEN p_value < {level} THEN 'YES' ELSE 'NO' END AS significant, CASE WHEN coefficient > 0 THEN 'Positive (+)' ELSE 'Negative (-)' END AS direction,
 CASE WHEN p_value >= {level} THEN 'See coefficient' {reading} ELSE 'See coefficient' END AS interpretation FROM coef {only}"""


def vif_sql(prelude: str, terms: Sequence[str]) -> str:
    return f"{fit_sql(prelude, terms)} SELECT variable, {digits('vif')} AS vif, vif > 5 AS moderate, vif > 10 AS high FROM coef"


def nested_sql(prelude: str, small: Sequence[str], large: Sequence[str]) -> str:
    both = fit_sql(fit_sql(prelude, small, "1", large), large, "2", small)
    return f"""{both}, f AS (SELECT a.df AS residual_df_1, b.df AS residual_df_2, a.rest * a.n * a.sdy * a.sdy AS rss_1, b.rest * b.n * b.sdy * b.sdy AS rss_2 FROM fit1 a, fit2 b)
SELECT residual_df_1, residual_df_2, {digits('rss_1')} AS rss_1, {digits('rss_2')} AS rss_2, residual_df_1 - residual_df_2 AS df,
 {digits('(rss_1 - rss_2) / (residual_df_1 - residual_df_2) / (rss_2 / residual_df_2)')} AS f_value FROM f"""


def models_sql(prelude: str, formulas: dict[str, Sequence[str]]) -> str:
    """Fit quality of each formula on its own complete rows."""
    out, parts = prelude, []
    for i, (name, terms) in enumerate(formulas.items()):
        tag = f"_{i}"
        out = fit_sql(out, terms, tag)
        parts.append(
            f"SELECT '{name}' AS model, n, n - 1 - df AS n_terms, {digits('1 - rest')} AS r_squared, {digits('rest * n * sdy * sdy')} AS rss FROM fit{tag}"
        )
    return out + " " + " UNION ALL ".join(parts)
