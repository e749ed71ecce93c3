"""Regressions whose fact rows are summed by Spark; only a small system per group is solved in Python.

Terms are numeric columns. A linear fit needs the sums of their products, a logistic one the counts of every
combination of levels, which are its sufficient statistic: either is one aggregation, whatever the rows.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEPENDENT = 1e-9  # share of a column's own length below which it is a combination of the ones before it
STEPS, DONE = 50, 1e-10
LONGEST_STEP = 5.0
COEFFICIENTS = "term string, coefficient double, std_error double, statistic double"


def independent(gram: np.ndarray) -> list[int]:
    """Columns that are no combination of earlier ones, from the matrix of their products."""
    kept: list[int] = []
    for j in range(len(gram)):
        rest = gram[j, j]
        if kept:
            own = gram[np.ix_(kept, kept)]
            rest -= gram[j, kept] @ np.linalg.solve(own, gram[kept, j])
        if rest > DEPENDENT * max(gram[j, j], 1e-300):
            kept.append(j)
    return kept


def coefficient_rows(terms: list[str], kept: list[int], beta: np.ndarray, variance: np.ndarray) -> list[tuple]:
    """One row per term; a term that depends on earlier ones has NULLs."""
    out = []
    for j, term in enumerate(terms):
        if j not in kept:
            out.append((term, None, None, None))
            continue
        i = kept.index(j)
        error = float(np.sqrt(max(variance[i], 0.0))) if np.isfinite(variance[i]) else None
        out.append((term, float(beta[i]), error, float(beta[i] / error) if error else None))
    return out


def solve_linear(terms: list[str], gram: np.ndarray, moments: np.ndarray, yy: float, n: int) -> tuple[list[tuple], float | None]:
    """Coefficients of the normal equations, and the share of the variance about the mean that they explain."""
    kept = independent(gram)
    if not kept:
        return coefficient_rows(terms, [], np.zeros(0), np.zeros(0)), None
    own = gram[np.ix_(kept, kept)]
    beta = np.linalg.solve(own, moments[kept])
    rest = max(yy - float(beta @ moments[kept]), 0.0)
    spare = n - len(kept)
    variance = np.linalg.inv(own).diagonal() * (rest / spare if spare > 0 else np.nan)
    about_mean = yy - moments[0] ** 2 / gram[0, 0]
    return coefficient_rows(terms, kept, beta, variance), 1 - rest / about_mean if about_mean > 0 else None


def linear_regression(df: DataFrame, keys: list[str], y: Column, terms: dict[str, Column]) -> DataFrame:
    """keys, n, r_squared, term, coefficient, std_error, statistic: least squares of y on terms and an intercept."""
    names = ["intercept", *terms]
    k = len(names)
    columns = [F.lit(1.0), *[F.coalesce(c.cast("double"), F.lit(0.0)) for c in terms.values()]]
    rows = df.select(*keys, y.cast("double").alias("_y"), *[c.alias(f"_x{i}") for i, c in enumerate(columns)]).where("_y IS NOT NULL")
    x = [F.col(f"_x{i}") for i in range(k)]
    products = F.array(*[F.sum(x[i] * x[j]) for i in range(k) for j in range(i + 1)])
    sums = rows.groupBy(*keys).agg(
        products.alias("_products"), F.array(*[F.sum(c * F.col("_y")) for c in x]).alias("_moments"),
        F.sum(F.col("_y") * F.col("_y")).alias("_yy"), F.count("*").alias("n"),
    )

    @F.pandas_udf(f"r_squared double, rows array<struct<{', '.join(c.replace(' ', ':') for c in COEFFICIENTS.split(', '))}>>")
    def solved(products: pd.Series, moments: pd.Series, yy: pd.Series, n: pd.Series) -> pd.DataFrame:
        out = []
        for a, b, c, m in zip(products, moments, yy, n):
            gram = np.zeros((k, k))
            gram[np.tril_indices(k)] = a
            gram += np.tril(gram, -1).T
            rows, share = solve_linear(names, gram, np.asarray(b), float(c), int(m))
            out.append((share, [dict(zip(("term", "coefficient", "std_error", "statistic"), r)) for r in rows]))
        return pd.DataFrame(out, columns=["r_squared", "rows"])

    found = sums.withColumn("_fit", solved("_products", "_moments", "_yy", "n"))
    return found.select(*keys, "n", F.col("_fit.r_squared").alias("r_squared"), F.inline("_fit.rows"))


def solve_logistic(terms: list[str], x: np.ndarray, hits: np.ndarray, n: np.ndarray) -> list[tuple]:
    """Newton steps on the cells of a group: x terms of a cell, n its rows, hits those with y."""
    kept = independent(x.T @ (x * n[:, None]))
    own = x[:, kept]
    beta = np.zeros(len(kept))
    information = np.eye(len(kept))
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(own @ beta, -30, 30)))
        information = own.T @ (own * (n * p * (1 - p))[:, None]) + 1e-9 * np.eye(len(kept))
        step = np.linalg.solve(information, own.T @ (hits - n * p))
        step *= min(1.0, LONGEST_STEP / max(1e-300, float(np.abs(step).max(initial=0))))
        beta = beta + step
        if np.abs(step).max(initial=0) < DONE or np.abs(beta).max(initial=0) > 30:
            break  # done, or a level that all or none of the rows tell apart: its coefficient has no end
    return coefficient_rows(terms, kept, beta, np.linalg.inv(information).diagonal())


def logistic_regression(
    df: DataFrame, keys: list[str], y: Column, factors: dict[str, Column], base: dict[str, str], weight: Column | None = None
) -> DataFrame:
    """keys, rows, hits, term, coefficient, std_error, statistic: log odds of y on the levels of factors.

    A row counts once, or as often as its weight says.

    A factor's base level has no term of its own; where a group lacks it, its first level by name takes
    its place. Rows are counted per combination of levels first, so a group's task meets one row for each
    combination and not the facts.
    """
    names = list(factors)
    levels = [F.coalesce(c.cast("string"), F.lit("unknown")).alias(name) for name, c in factors.items()]
    times = (F.lit(1) if weight is None else weight).cast("long").alias("_w")
    rows = df.select(*keys, y.cast("int").alias("_y"), times, *levels).where("_y IS NOT NULL")
    cells = rows.groupBy(*keys, *names).agg(F.sum("_w").alias("_n"), F.sum(F.col("_y") * F.col("_w")).alias("_hits"))
    kinds = dict(cells.dtypes)

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(names)
        terms, columns = ["intercept"], [np.ones(len(part))]
        for name in names:
            own = sorted(part[name].unique())
            left_out = base[name] if base[name] in own else own[0]
            for level in own:
                if level != left_out:
                    terms.append(f"{name}={level}")
                    columns.append((part[name] == level).to_numpy(dtype=float))
        n, hits = part["_n"].to_numpy(dtype=float), part["_hits"].to_numpy(dtype=float)
        rows = solve_logistic(terms, np.stack(columns, axis=1), hits, n)
        out = pd.DataFrame(rows, columns=["term", "coefficient", "std_error", "statistic"])
        out.insert(0, "rows", int(n.sum()))
        out.insert(1, "hits", int(hits.sum()))
        for key in reversed(keys):
            out.insert(0, key, part[key].iloc[0])
        return out

    schema = ", ".join([*[f"{k} {kinds[k]}" for k in keys], "rows long, hits long", COEFFICIENTS])
    return cells.groupBy(*keys).applyInPandas(fit, schema)


