"""Holt-Winters (additive trend, additive season) and Holt linear, per series.

The recursion (after Holt 1957, Winters 1960), for period m and state
``x = (l, b, s_0 … s_{m-1})``::

    e_t = y_t − (l + b + s_0)                      sse += e_t²
    l'  = α (y_t − s_0) + (1 − α)(l + b)
    b'  = β (l' − l) + (1 − β) b
    s'  = (s_1 … s_{m−1}, γ (y_t − l − b) + (1 − γ) s_0)

Initial state: ``l = mean(y_1..y_m)``, ``b = 0``, ``s_i = y_i − l``; the recursion
runs from t = m+1.  Without season (Holt linear): ``l = y_1``, ``b = 0`` from t = 2.

For fixed (α, β, γ) one step is an affine map of the state, so a block of rows
is an affine map ``x ↦ M [x; 1]`` together with a quadratic form ``Q`` giving the
block's SSE as ``[x; 1]ᵀ Q [x; 1]``.  Blocks of ``block_rows`` positions are
summarised in parallel (numpy inside ``applyInPandas``, vectorised over all
candidate parameter triples), then composed in order by a tree reduction with
``fanout`` blocks per group and level.  No task ever holds a whole series, and
the result equals the sequential recursion.  Parameters are chosen per series
as the candidate with the least in-sample SSE.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import DEFAULT_COLS, SeriesCols
from . import grid, windows

# The candidate grid of smoothing parameters searched per series.
ALPHAS = (0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9)
BETAS = (0.01, 0.05, 0.1, 0.2, 0.3)
GAMMAS = (0.05, 0.1, 0.2, 0.3, 0.5)

BLOCK_ROWS = 4096
FANOUT = 64

_SUMMARY_SCHEMA = "series_id string, _blk long, cand int, M array<double>, Q array<double>"


def candidate_grid(seasonal: bool = True) -> np.ndarray:
    """``(C, 3)`` array of (α, β, γ); γ is 0 for the linear model."""
    gam = GAMMAS if seasonal else (0.0,)
    return np.array(list(itertools.product(ALPHAS, BETAS, gam)), dtype=float)


# Multiplicative steps of the refinement grid around a coarse optimum.
REFINE_STEPS = (0.5, 1.0, 1.6)


def local_grid(center: tuple[float, float, float], seasonal: bool) -> np.ndarray:
    """3×3×3 (or 3×3 without season) candidates around a coarse optimum, inside (0, 1)."""
    a, b, g = center
    axis = lambda c: sorted({min(max(c * f, 1e-4), 0.999) for f in REFINE_STEPS})
    gam = axis(g) if seasonal else [0.0]
    return np.array(list(itertools.product(axis(a), axis(b), gam)), dtype=float)


def _state_dim(m: int) -> int:
    return m + 2 if m > 1 else 2


def block_summary(y: np.ndarray, params: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Affine map ``M (C,k,k+1)`` and SSE form ``Q (C,k+1,k+1)`` of one block of values."""
    c = params.shape[0]
    k = _state_dim(m)
    a, b, g = (params[:, i][:, None] for i in range(3))
    X = np.zeros((c, k, k + 1))
    X[:, np.arange(k), np.arange(k)] = 1.0
    Q = np.zeros((c, k + 1, k + 1))
    unit = np.zeros(k + 1)
    unit[k] = 1.0
    for yt in y:
        yv = yt * unit
        L, Bt = X[:, 0], X[:, 1]
        if m > 1:
            S0 = X[:, 2]
            r = yv - (L + Bt + S0)
            Ln = a * (yv - S0) + (1 - a) * (L + Bt)
            Bn = b * (Ln - L) + (1 - b) * Bt
            Sn = g * (yv - L - Bt) + (1 - g) * S0
            X = np.concatenate([Ln[:, None], Bn[:, None], X[:, 3:], Sn[:, None]], axis=1)
        else:
            r = yv - (L + Bt)
            Ln = a * yv + (1 - a) * (L + Bt)
            Bn = b * (Ln - L) + (1 - b) * Bt
            X = np.stack([Ln, Bn], axis=1)
        Q += r[:, :, None] * r[:, None, :]
    return X, Q


def compose(parts: list[tuple[np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Compose consecutive block summaries (first block first)."""
    M_tot = np.zeros((k, k + 1))
    M_tot[np.arange(k), np.arange(k)] = 1.0
    Q_tot = np.zeros((k + 1, k + 1))
    for M, Q in parts:
        T = np.vstack([M_tot, np.eye(k + 1)[k]])
        Q_tot = Q_tot + T.T @ Q @ T
        M_tot = M @ T
    return M_tot, Q_tot


def _params_for(params: np.ndarray | None, row, m: int) -> np.ndarray:
    """Global candidates, or the local grid around this series' centre."""
    if params is not None:
        return params
    return local_grid((float(row["_a0"]), float(row["_b0"]), float(row["_g0"])), m > 1)


def _blocks_fn(params: np.ndarray | None, m: int):
    k = _state_dim(m)

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        p = _params_for(params, pdf.iloc[0], m)
        M, Q = block_summary(pdf["value"].to_numpy(dtype=float), p, m)
        return pd.DataFrame({
            "series_id": pdf["series_id"].iloc[0], "_blk": int(pdf["_blk"].iloc[0]),
            "cand": np.arange(len(p), dtype=np.int32),
            "M": list(M.reshape(len(p), k * (k + 1))),
            "Q": list(Q.reshape(len(p), (k + 1) * (k + 1)))})
    return fn


def _compose_fn(m: int):
    k = _state_dim(m)

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for cand, g in pdf.sort_values(["cand", "_blk"]).groupby("cand", sort=False):
            parts = [(np.asarray(M).reshape(k, k + 1), np.asarray(Q).reshape(k + 1, k + 1))
                     for M, Q in zip(g["M"], g["Q"])]
            M, Q = compose(parts, k)
            out.append((g["series_id"].iloc[0], int(g["_grp"].iloc[0]), int(cand),
                        M.ravel(), Q.ravel()))
        return pd.DataFrame(out, columns=["series_id", "_blk", "cand", "M", "Q"])
    return fn


def _finish_fn(params: np.ndarray | None, m: int):
    k = _state_dim(m)

    def fn(it):
        for pdf in it:
            rows = []
            for _, r in pdf.iterrows():
                z = np.append(np.asarray(r["x0"], dtype=float), 1.0)
                if r["M"] is None:  # nothing after the first rows: they are the state
                    a, b, g = _params_for(params, r, m)[0]
                    rows.append((r["series_id"], 0, float(a), float(b), float(g), float(z[0]), float(z[1]), list(map(float, z[2:-1])), 0.0))
                    continue
                M = np.asarray(r["M"]).reshape(k, k + 1)
                Q = np.asarray(r["Q"]).reshape(k + 1, k + 1)
                x = M @ z
                sse = float(max(z @ Q @ z, 0.0))
                a, b, g = _params_for(params, r, m)[int(r["cand"])]
                rows.append((r["series_id"], int(r["cand"]), float(a), float(b), float(g),
                             float(x[0]), float(x[1]), list(map(float, x[2:])), sse))
            yield pd.DataFrame(rows, columns=["series_id", "cand", "alpha", "beta", "gamma",
                                              "level", "trend", "season", "sse"])
    return fn


def fit(df: DataFrame, m: int, params: np.ndarray | None = None, cols: SeriesCols = DEFAULT_COLS,
        block_rows: int = BLOCK_ROWS, fanout: int = FANOUT, refine: bool = True) -> DataFrame:
    """Fit per series on a regular series frame; best candidate by SSE.

    Without fixed ``params``: the coarse grid, then (``refine``) a local grid
    around each series' coarse optimum; the least SSE over both wins.

    Series shorter than ``2m`` (or ``m ≤ 1``) use Holt linear; one observation is the level, without a trend.  Output
    ``(series_id, model, m, alpha, beta, gamma, level, trend, season, sse, n_obs, last_ts)``.
    """
    if windows.POS in df.columns and windows.N_ROWS in df.columns:
        d = df  # positions supplied (e.g. by ``grid.regularise(with_position=True)``)
    else:
        d = windows.with_position(df.select(cols.series, cols.ts, cols.value), cols,
                                  with_count=True)
    d = d.select(F.col(cols.series).alias("series_id"), F.col(cols.ts).alias("ts"),
                 F.col(cols.value).alias("value"), "pos", "n_rows")
    d = d.persist()
    is_seasonal = (F.col("n_rows") >= 2 * m) & F.lit(m > 1)
    seasonal, linear = d.where(is_seasonal), d.where(~is_seasonal)
    # which branches have series at all (two cheap existence probes on the persisted rows)
    has_seasonal = m > 1 and bool(seasonal.limit(1).count())
    has_linear = bool(linear.limit(1).count())
    parts = []
    if has_seasonal:
        parts.append(_search(seasonal, m, params, block_rows, fanout, refine))
    if has_linear or not parts:
        parts.append(_search(linear, 0, params, block_rows, fanout, refine))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _search(d: DataFrame, m: int, params, block_rows: int, fanout: int, refine: bool) -> DataFrame:
    """Fixed candidates; or the coarse grid, then a local grid around each series' best."""
    if params is not None:
        return _fit_one(d, m, params, block_rows, fanout)
    coarse = _fit_one(d, m, candidate_grid(m > 1), block_rows, fanout)
    if not refine:
        return coarse
    coarse = coarse.cache()
    centres = coarse.select("series_id", F.col("alpha").alias("_a0"), F.col("beta").alias("_b0"),
                            F.col("gamma").alias("_g0"))
    fine = _fit_one(d.join(centres, "series_id"), m, None, block_rows, fanout)
    both = coarse.unionByName(fine)
    cols = [c for c in both.columns if c != "series_id"]
    best = both.groupBy("series_id").agg(
        F.min_by(F.struct(*cols), F.struct("sse", "alpha", "beta", "gamma")).alias("b"))
    return best.select("series_id", *[F.col("b." + c).alias(c) for c in cols])


def _fit_one(d: DataFrame, m: int, params: np.ndarray, block_rows: int, fanout: int) -> DataFrame:
    start = m if m > 1 else 1
    k = _state_dim(m)
    init_rows = d.where(F.col("pos") <= start)
    if m > 1:
        x0 = (init_rows.groupBy("series_id")
              .agg(F.sort_array(F.collect_list(F.struct("pos", "value"))).alias("_v"))
              .select("series_id", F.transform("_v", lambda s: s["value"]).alias("_y")))
        x0 = x0.select("series_id", F.aggregate("_y", F.lit(0.0), lambda acc, v: acc + v)
                       .alias("_sum"), "_y")
        x0 = x0.select("series_id", F.concat(
            F.array((F.col("_sum") / m), F.lit(0.0)),
            F.transform("_y", lambda v: v - F.col("_sum") / m)).alias("x0"))
    else:
        x0 = init_rows.select("series_id", F.array(F.col("value"), F.lit(0.0)).alias("x0"))
    rec = d.where(F.col("pos") > start).withColumn(
        "_blk", ((F.col("pos") - start - 1) / block_rows).cast("long"))
    centre = ["_a0", "_b0", "_g0"] if params is None else []
    summ = (rec.select("series_id", "_blk", "pos", "value", *centre)
               .groupBy("series_id", "_blk").applyInPandas(_blocks_fn(params, m), _SUMMARY_SCHEMA))
    # tree reduction until one block per series; levels from the longest series
    longest = d.agg(F.max("n_rows")).first()[0] or 0
    n_blocks = max(1, -(-(max(longest - start, 1)) // block_rows))
    levels = 0
    while n_blocks > 1:
        n_blocks = -(-n_blocks // fanout)
        levels += 1
    if levels == 0:
        levels = 1  # one compose pass also turns a lone block into the series total
    for _ in range(levels):
        summ = (summ.withColumn("_grp", (F.col("_blk") / fanout).cast("long"))
                    .groupBy("series_id", "_grp").applyInPandas(_compose_fn(m), _SUMMARY_SCHEMA))
    last = d.groupBy("series_id").agg(F.max("ts").alias("last_ts"), F.max("n_rows").alias("n_obs"))
    if params is None:
        x0 = x0.join(d.select("series_id", *centre).distinct(), "series_id")
    fin = (x0.join(summ, "series_id", "left").select("series_id", "cand", "x0", "M", "Q", *centre)
               .mapInPandas(_finish_fn(params, m),
                            "series_id string, cand int, alpha double, beta double, gamma double, "
                            "level double, trend double, season array<double>, sse double"))
    best = fin.groupBy("series_id").agg(
        F.min_by(F.struct("alpha", "beta", "gamma", "level", "trend", "season", "sse"),
                 F.struct("sse", "alpha", "beta", "gamma")).alias("b"))
    model = "holt_winters" if m > 1 else "holt_linear"
    return (best.join(last, "series_id")
                .select("series_id", F.lit(model).alias("model"), F.lit(m).alias("m"),
                        "b.alpha", "b.beta", "b.gamma", "b.level", "b.trend", "b.season", "b.sse",
                        F.col("n_obs").cast("long"), "last_ts"))


def forecast(fitted: DataFrame, horizon: int, freq: str = "D") -> DataFrame:
    """``(series_id, model, step, timestamp, forecast)`` with ``l + h·b + s[(h−1) mod m]``."""
    steps = fitted.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    seas = F.when(F.col("m") > 1, F.element_at(
        "season", ((F.col("step") - 1) % F.greatest(F.col("m"), F.lit(1)) + 1).cast("int"))
    ).otherwise(F.lit(0.0))
    fc = F.col("level") + F.col("step") * F.col("trend") + seas
    return steps.select("series_id", "model", "step",
                        grid.shift(F.col("last_ts"), freq, F.col("step")).alias("timestamp"),
                        fc.alias("forecast"))


def fixed(alpha: float, beta: float, gamma: float = 0.0) -> np.ndarray:
    return np.array([[alpha, beta, gamma]], dtype=float)
