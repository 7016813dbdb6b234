"""Paired differential contacts on a long count table (loop_key, sample, count)."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.coords import paired_log2
from .blocks import BLOCK, carry, join_null_safe, within


def size_factors(counts: DataFrame) -> DataFrame:
    """Median of ratios to the geometric mean, over loops with contacts in all samples."""
    over = Window.partitionBy("loop_key")
    logs = counts.withColumn("least", F.min("count").over(over)).where("least > 0").withColumn("l", F.log(F.col("count").cast("double")))
    ratio = logs.withColumn("r", F.col("l") - F.avg("l").over(over))
    return ratio.groupBy("sample").agg(F.exp(F.median("r")).alias("size_factor"))


def normalised(counts: DataFrame, factors: DataFrame) -> DataFrame:
    return counts.join(F.broadcast(factors), "sample").withColumn("value", F.col("count") / F.col("size_factor"))


def pair_roster(design: DataFrame, case: str, control: str) -> DataFrame:
    """One row per complete pair: subject, its case and its control sample. Others aren't pairs."""
    arm = lambda name: F.when(F.col("arm") == name, F.col("sample_id"))
    return design.groupBy("subject_id").agg(F.count(arm(case)).alias("n_case"), F.count(arm(control)).alias("n_control"), F.max(arm(case)).alias("case_sample"), F.max(arm(control)).alias("control_sample"))


def paired_effects(values: DataFrame, roster: DataFrame) -> DataFrame:
    """log2 of (case + 1) / (control + 1) for every loop and pair."""
    v = values.select("loop_key", "sample", "value")
    case, control = v.toDF("loop_key", "case_sample", "case_value"), v.toDF("loop_key", "control_sample", "control_value")
    both = case.join(F.broadcast(roster), "case_sample").join(control, ["loop_key", "control_sample"])
    return both.withColumn("log2_ratio", paired_log2(F.col("case_value"), F.col("control_value")))


def benjamini_hochberg(df: DataFrame, by: list[str], p: str = "pvalue") -> DataFrame:
    """df with padj: p * n / rank, made monotone from the largest p down. Null and NaN p have none and aren't counted.

    Distinct p are ranked within blocks of like size (4096 equal steps down to 1 / 4096, 16 an octave
    below) that hand on their numbers and minima, so a group of all tests is not one task's.
    """
    x = F.col(p).cast("double")
    block = F.when(x >= 1 / 4096, F.floor(x * 4096)).when(x > 0, F.floor(F.log2(x) * 16)).otherwise(-20_000)
    tests = df.where(x.isNotNull() & ~F.isnan(x)).groupBy(*by, p).agg(F.count("*").alias("__c")).withColumn(BLOCK, block)
    tests = carry(tests, by, __before=(F.sum("__c"), F.sum, "earlier"), __n=(F.sum("__c"), F.sum, "all"))
    rank = F.sum("__c").over(within(by).orderBy(p)) + F.coalesce("__before", F.lit(0))  # ties share their last rank
    tests = carry(tests.withColumn("__q", x * F.col("__n") / rank), by, __least=(F.min("__q"), F.min, "later"))
    padj = F.least(F.lit(1.0), F.min("__q").over(within(by).orderBy(F.col(p).desc())), "__least")
    return join_null_safe(df, tests.select(*by, p, padj.alias("padj")), by, exact=(p,))


def design_rank(design: pd.DataFrame, factors: list[str]) -> tuple[int, int]:
    """Rank and width of the dummy-coded design; equal if nothing is confounded. A design is small and lives on the driver."""
    x = pd.get_dummies(design[factors].astype(str), drop_first=True).astype(float)
    x.insert(0, "intercept", 1.0)
    return int(np.linalg.matrix_rank(x.to_numpy())), x.shape[1]


def negative_binomial(counts: DataFrame, factors: DataFrame, design: pd.DataFrame, case: str) -> DataFrame:
    """Wald test of arm for each loop: a negative-binomial GLM with a pair term, dispersion by moments shrunk on the log scale.

    design (sample, subject_id, arm) and factors have a row for each sample of a study and
    live on the driver. Loops of a batch are fitted together; a loop's counts are one short row.
    """
    sf_of = {r["sample"]: r["size_factor"] for r in factors.collect()}
    design = design[design["sample"].isin(sf_of)].sort_values("sample").reset_index(drop=True)
    samples = design["sample"].tolist()
    x = np.column_stack([np.ones(len(design)), pd.get_dummies(design["subject_id"], drop_first=True).astype(float), (design["arm"] == case).astype(float)]).astype(float)
    sf = np.array([sf_of[s] for s in samples])

    def fit(batches):
        for pdf in batches:
            y = np.array([[c.get(s, 0) for s in samples] for c in map(dict, pdf["counts"])], float).reshape(len(pdf), len(samples))
            z = y / sf
            mean, free = z.mean(1), max(1, len(samples) - x.shape[1])
            safe = np.maximum(mean, 1e-9)
            alpha = np.clip(((z - mean[:, None]) ** 2).sum(1) / free / safe**2 - 1 / safe, 1e-4, 10.0)
            alpha = np.exp(0.5 * np.log(alpha) + 0.5 * np.log(0.1))[:, None]
            beta = np.zeros((len(pdf), x.shape[1]))
            beta[:, 0] = np.log(np.maximum(mean, 0.1))
            ridge = 1e-6
            for _ in range(50):
                mu = np.maximum(sf * np.exp(np.clip(beta @ x.T, -30, 30)), 1e-6)
                h = np.einsum("np,ln,nq->lpq", x, mu / (1 + alpha * mu), x) + ridge * np.eye(x.shape[1])
                step = np.linalg.solve(h, (((y - mu) / (1 + alpha * mu)) @ x - ridge * beta)[:, :, None])[:, :, 0]
                beta += np.clip(step, -5, 5)
                if not len(step) or np.abs(step).max() < 1e-8:
                    break
            se = np.sqrt(np.linalg.inv(h)[:, -1, -1])
            p = [math.erfc(abs(b / e) / math.sqrt(2)) for b, e in zip(beta[:, -1], se, strict=True)]
            yield pd.DataFrame({"loop_key": pdf["loop_key"], "base_mean": mean, "log2_fold_change": beta[:, -1] / math.log(2), "lfc_se": se / math.log(2), "pvalue": p})

    short = counts.groupBy("loop_key").agg(F.map_from_entries(F.collect_list(F.struct("sample", "count"))).alias("counts"))
    return short.mapInPandas(fit, "loop_key string, base_mean double, log2_fold_change double, lfc_se double, pvalue double")
