"""Random effects, and the three specification tests of a fitted panel model."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.econ.algebra import inverse, moment_columns, moment_matrix
from panelkit.econ.within import PanelFit
from panelkit.functions.dist import chi2_sf, f_sf, t_two_sided
from panelkit.operators.ordered import add_previous


@dataclass
class RandomEffectsFit:
    terms: list[str]
    beta: np.ndarray
    cov: np.ndarray
    sigma2_e: float
    sigma2_u: float
    n_obs: int

    def coefficients(self, spark) -> DataFrame:
        rows = []
        for i, term in enumerate(self.terms):
            se = float(np.sqrt(self.cov[i, i]))
            t = float(self.beta[i]) / se
            rows.append(
                (term, float(self.beta[i]), se, t, t_two_sided(t, self.n_obs - len(self.terms)))
            )
        return spark.createDataFrame(
            rows,
            "term string, coefficient double, std_error double, t_stat double, p_value double",
        )


def random_effects(fit: PanelFit) -> RandomEffectsFit:
    """GLS with Swamy-Arora variance components on the sample of ``fit``.

    Quasi-demeaned moments are the within moments plus entity means weighted by
    n_i (1 - theta_i)^2, so one aggregate over the entity means is enough.
    """
    k = len(fit.terms)
    n, groups = fit.n_obs, fit.n_entities
    within, between = fit.within_moments, fit.between_moments

    def ssr(moments: np.ndarray) -> float:
        b = inverse(moments[1:, 1:]) @ moments[1:, 0]
        return float(moments[0, 0] - b @ moments[1:, 0])

    sigma2_e = ssr(within) / (n - k - groups + 1)
    if groups <= k:
        raise ValueError("random effects need more entities than regressors")
    harmonic = fit.means.agg((F.count(F.lit(1)) / F.sum(1 / F.col("_n"))).alias("h")).first()["h"]
    sigma2_u = max(0.0, ssr(between) / (groups - k) - sigma2_e / harmonic)
    keep = F.sqrt(F.lit(sigma2_e) / (F.col("_n") * sigma2_u + sigma2_e))  # 1 - theta
    names = [f"_m_{c}" for c in [fit.spec.target, *fit.terms]]
    part = fit.means.agg(*moment_columns(names, F.col("_n") * keep * keep)).first()
    moments = within + moment_matrix(part.asDict(), k + 1)
    m_inv = inverse(moments[1:, 1:])
    beta = m_inv @ moments[1:, 0]
    left = moments[0, 0] - beta @ moments[1:, 0]
    return RandomEffectsFit(
        fit.terms, beta, m_inv * (left / (n - k)), float(sigma2_e), float(sigma2_u), n
    )


def hausman(fit: PanelFit, random: RandomEffectsFit | None = None) -> dict:
    """Fixed against random effects, both with classical covariance."""
    random = random or random_effects(fit)
    diff = fit.beta - random.beta
    v = fit.cov_unadjusted - random.cov
    try:
        v_inv = np.linalg.inv(v)
    except np.linalg.LinAlgError:
        v_inv = np.linalg.pinv(v)
    statistic = float(diff @ v_inv @ diff)
    p = chi2_sf(statistic, len(diff))
    return {
        "test": "hausman",
        "statistic": statistic,
        "df": len(diff),
        "p_value": p,
        "conclusion": "prefer fixed effects" if p < 0.05 else "random effects acceptable",
    }


def ar1_sums(residuals: DataFrame, fit_spec) -> DataFrame:
    """One row with what the AR(1) regression of residuals needs."""
    pairs = add_previous(residuals, fit_spec, {"e_lag": "e"}).where(F.col("e_lag").isNotNull())
    return pairs.agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.sum(F.col("e") * F.col("e_lag")).alias("cross"),
        F.sum(F.col("e_lag") * F.col("e_lag")).alias("lag_sq"),
        F.sum(F.col("e") * F.col("e")).alias("own_sq"),
    )


def ar1_table(residuals: DataFrame, fit_spec) -> DataFrame:
    """Slope and standard error of e on its lag, without constant."""
    rho = F.try_divide("cross", "lag_sq")
    left = F.col("own_sq") - rho * F.col("cross")
    se = F.sqrt(F.try_divide(F.try_divide(left, F.col("n") - 1), F.col("lag_sq")))
    return ar1_sums(residuals, fit_spec).select("n", rho.alias("rho"), se.alias("std_error"))


def ar1(fit: PanelFit) -> dict:
    """First-order autocorrelation of the residuals."""
    row = ar1_table(fit.residuals(), fit.spec).first()
    if not row["n"]:
        raise ValueError("no residual has a predecessor")
    p = t_two_sided(row["rho"] / row["std_error"], row["n"] - 1)
    return {
        "test": "autocorrelation",
        "statistic": row["rho"] / row["std_error"],
        "rho": row["rho"],
        "df": row["n"] - 1,
        "p_value": p,
        "conclusion": "AR(1) detected" if p < 0.05 else "no evidence of AR(1)",
    }


def breusch_pagan_statistics(rows: DataFrame, terms: list[str]) -> dict:
    """LM and F of regressing e^2 on a constant and ``terms``, from one aggregate.

    Covariances are taken about the mean, so large regressors lose no digits.
    """
    names = ["_e2", *terms]
    squared = rows.withColumn("_e2", F.col("e") * F.col("e"))
    covariances = [
        F.covar_pop(names[i], names[j]).alias(f"m_{i}_{j}")
        for i in range(len(names))
        for j in range(i, len(names))
    ]
    row = squared.agg(F.count(F.lit(1)).alias("n"), *covariances).first()
    n, k = row["n"], len(terms)
    c = moment_matrix(row.asDict(), k + 1)
    if c[0, 0] <= 0:
        raise ValueError("the residuals do not vary")
    r2 = float(c[1:, 0] @ inverse(c[1:, 1:]) @ c[1:, 0] / c[0, 0])
    lm = n * r2
    f = (r2 / k) / ((1 - r2) / (n - k - 1))
    return {
        "n": n,
        "lm_stat": lm,
        "lm_pvalue": chi2_sf(lm, k),
        "f_stat": f,
        "f_pvalue": f_sf(f, k, n - k - 1),
        "df": k,
    }


def breusch_pagan(fit: PanelFit) -> dict:
    """Heteroscedasticity of the residuals in the regressors."""
    rows = fit.sample.join(fit.residuals(), fit.spec.keys)
    out = breusch_pagan_statistics(rows, fit.terms)
    heteroscedastic = out["lm_pvalue"] < 0.05
    return {
        "test": "heteroscedasticity",
        "statistic": out["lm_stat"],
        "p_value": out["lm_pvalue"],
        "conclusion": (
            "heteroscedasticity detected" if heteroscedastic
            else "no evidence of heteroscedasticity"
        ),
        **out,
    }


#: Columns of the diagnostics table.
DIAGNOSTICS = (
    "test string, statistic double, df bigint, p_value double, conclusion string, error string"
)


def diagnostics(fit: PanelFit) -> dict[str, dict]:
    """All three tests; one that fails reports its error and spares the others."""
    out = {}
    for name, test in (
        ("hausman", hausman), ("autocorrelation", ar1), ("heteroscedasticity", breusch_pagan)
    ):
        try:
            out[name] = test(fit)
        except (ValueError, ArithmeticError, np.linalg.LinAlgError) as problem:
            out[name] = {"test": name, "error": str(problem)}
    return out


def diagnostics_table(fit: PanelFit) -> DataFrame:
    """The tests as three rows (test, statistic, df, p_value, conclusion, error)."""
    fields = ("test", "statistic", "df", "p_value", "conclusion", "error")
    rows = [tuple(r.get(f) for f in fields) for r in diagnostics(fit).values()]
    return fit.sample.sparkSession.createDataFrame(rows, DIAGNOSTICS)


