"""Learned operators: stage classifier, gap imputation, archetypes, isolation forests."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from furrow.operators.boosting import fit_boosting
from furrow.operators.joins import neighbour_means
from furrow.operators.mixture import GaussianMixture, Mixture, first_mixture, packed_blocks, predicted_sums, scales, together
from furrow.session import drop_staged, stage


def bounded_sample(df: DataFrame, key: str, rows: int, seed: int = 42) -> DataFrame:
    """Up to ``rows`` rows, always the same: those with the smallest hash of the key."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(rows)


def hash_split(df: DataFrame, key: str, seed: int, shares: Sequence[float], names: Sequence[str]) -> DataFrame:
    """``split``: rows dealt by a hash of the key and the seed to parts of about the given shares; no order, no shuffle."""
    u = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed).cast("string"), F.col(key).cast("string")).cast("binary")), 1, 8), 16, 10).cast("double") / float(2**32)
    out, upto = None, 0.0
    for share, name in list(zip(shares, names))[:-1]:
        upto += share
        out = F.when(u < upto, name) if out is None else out.when(u < upto, name)
    return df.withColumn("split", out.otherwise(names[-1]) if out is not None else F.lit(names[-1]))


def counted_split(df: DataFrame, key: str, seed: int, shares: tuple[float, float] = (0.8, 0.1), names: tuple[str, str, str] = ("train", "val", "test")) -> DataFrame:
    """``split`` with exact counts: int(n * share) rows for the first parts, the rest last, in the order of a hash.

    Ranks come from buckets of the hash, so they are counted in many tasks.
    """
    h = F.md5(F.concat_ws("|", F.lit(seed).cast("string"), F.col(key).cast("string")).cast("binary"))
    rows = df.withColumn("_h", h).withColumn("_b", F.substring("_h", 1, 3))
    sizes = rows.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))  # 4,096 buckets
    w = Window.partitionBy(F.lit(1)).orderBy("_b")
    sizes = sizes.select("_b", F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_o"), F.sum("_n").over(Window.partitionBy(F.lit(1))).alias("_all"))
    r = rows.withColumn("_i", F.row_number().over(Window.partitionBy("_b").orderBy("_h", key))).join(F.broadcast(sizes), "_b")
    place, a = F.col("_i") + F.col("_o"), F.floor(F.col("_all") * F.lit(shares[0]))
    b = a + F.floor(F.col("_all") * F.lit(shares[1]))
    return r.withColumn("split", F.when(place <= a, names[0]).when(place <= b, names[1]).otherwise(names[2])).drop("_h", "_b", "_i", "_o", "_all")


def train_stage_forest(df: DataFrame, features: Sequence[str], label: str, trees: int = 50, depth: int = 8, seed: int = 42) -> PipelineModel:
    """A random forest of the growth stage; missing features become 0."""
    rows = df.where(F.col(label).isNotNull()).select(label, *[F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.lit(0.0)).alias(c) for c in features])
    forest = RandomForestClassifier(labelCol="_label", featuresCol="_features", predictionCol="_pred", numTrees=trees, maxDepth=depth, seed=seed)
    return Pipeline(stages=[StringIndexer(inputCol=label, outputCol="_label", handleInvalid="keep"), VectorAssembler(inputCols=list(features), outputCol="_features"), forest]).fit(rows)


def predict_stage(model: PipelineModel, df: DataFrame, features: Sequence[str], out: str = "predicted_stage") -> DataFrame:
    labels = model.stages[0].labels
    cols = {f"_f_{c}": F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.lit(0.0)) for c in features}
    rows = df.withColumns(cols)
    assembled = VectorAssembler(inputCols=list(cols), outputCol="_features").transform(rows)
    pred = model.stages[2].transform(assembled)
    name = F.element_at(F.array(*map(F.lit, labels)), (F.col("_pred") + 1).cast("int"))
    drop = [*cols, "_features", "_pred", "rawPrediction", "probability"]
    return pred.withColumn(out, F.when(F.col("_pred") < len(labels), name)).drop(*drop)


def impute_by_boosting(df: DataFrame, id_col: str, x: str, y: str, targets: Sequence[str], base: Sequence[str], cell: float, label: str | None = None, mask: str | None = None, k: int = 8, trees: int = 400, depth: int = 5, rate: float = 0.05, seed: int = 42, least: int = 200, fit_rows: int = 200_000) -> tuple[DataFrame, dict[str, float]]:
    """(id, targets..., source), one row a row of ``df``, and R squared of each target on a fifth held out.

    A row is measured if it has every target and isn't labelled NOISE; a gap lacks the first target, isn't NOISE and has a mask. Gaps get
    all targets predicted, in three decimals (``predicted``), measured rows keep theirs (``measured``), other rows have no source and keep what they have. Features are
    the base columns (nulls as 0), the mean of each target over the k nearest measured rows, and their mean distance.
    The trees are fitted on at most ``fit_rows`` measured rows, those with the smallest hashes of the id; every gap is predicted.
    With fewer than ``least`` measured rows nothing is filled.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(x).alias("x"), F.col(y).alias("y"), *[F.col(t).cast("double").alias(t) for t in targets], *[F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.lit(0.0)).alias(f"_{c}") for c in base], *[F.col(c).alias(f"_{n}") for c, n in ((label, "label"), (mask, "mask")) if c])
    plain = ~F.col("_label").eqNullSafe(F.lit("NOISE")) if label else F.lit(True)
    whole = F.lit(True)
    for t in targets:
        whole = whole & F.col(t).isNotNull()
    gap = F.col(targets[0]).isNull() & plain & (F.col("_mask").isNotNull() if mask else F.lit(True))
    rows = stage(rows.withColumns({"_measured": whole & plain, "_gap": gap}), "gaps")
    has = rows.where("_measured")
    kept = [F.col(t) for t in targets]
    if has.count() < least:
        return rows.select("id", *kept, F.when(F.col("_measured"), "measured").alias("source")), {}
    near = neighbour_means(rows.where("_measured OR _gap"), has, targets, k, cell)
    features = [*[f"_{c}" for c in base], *[f"near_{t}" for t in targets], "near_distance"]
    both = stage(rows.join(near, "id", "left").fillna(0.0, [f for f in features if f.startswith("near_")]), "features")
    known = bounded_sample(both.where("_measured").select("id", *features, *targets), "id", fit_rows, seed).toPandas()
    xs = known[features].to_numpy(dtype=float)
    test = np.random.default_rng(seed).permutation(len(known)) < len(known) // 5
    models, r2 = {}, {}
    for t in targets:
        v = known[t].to_numpy(dtype=float)
        trial = fit_boosting(xs[~test], v[~test], trees, depth, rate, seed=seed)
        r2[t] = 1 - float(((v[test] - trial.predict(xs[test])) ** 2).sum() / max(((v[test] - v[test].mean()) ** 2).sum(), 1e-300))
        models[t] = fit_boosting(xs, v, trees, depth, rate, seed=seed)

    def predict(it):
        for pdf in it:
            q = pdf[features].to_numpy(dtype=float)
            yield pd.DataFrame({"id": pdf["id"], **{t: np.round(m.predict(q), 3) for t, m in models.items()}})

    kind = rows.schema["id"].dataType.simpleString()
    filled = both.where("_gap").select("id", *features).mapInPandas(predict, f"id {kind}, " + ", ".join(f"`{t}` double" for t in targets))
    rest = rows.where("NOT _gap").select("id", *kept, F.when(F.col("_measured"), "measured").alias("source"))
    return rest.unionByName(filled.withColumn("source", F.lit("predicted"))), r2


def archetypes(df: DataFrame, id_col: str, features: Sequence[str], k: int = 4, seed: int = 42, least: int = 50, starts: int = 3) -> DataFrame:
    """(id, archetype, confidence): Gaussian mixture over scaled features; archetypes numbered by their members' mean over all features, lowest first.

    Of ``starts`` fits from different seeds the likeliest is kept.

    Rows with a missing feature get -1 and no confidence, as all rows do if fewer than ``least`` are complete.
    """
    f = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in features]
    rows = df.select(F.col(id_col).alias("id"), *[c.alias(n) for c, n in zip(f, features)])
    found = fit_archetypes(rows, "id", features, k, seed, least, starts)
    if found is None:
        return rows.select("id", F.lit(-1).alias("archetype"), F.lit(None).cast("double").alias("confidence"))

    def name(it):
        for pdf in it:
            number, confidence = found.of(pdf[list(features)].to_numpy(dtype=float))
            yield pd.DataFrame({"id": pdf["id"], "archetype": number, "confidence": confidence})

    return rows.mapInPandas(name, f"id {rows.schema['id'].dataType.simpleString()}, archetype int, confidence double").withColumn("confidence", F.nanvl("confidence", F.lit(None).cast("double")))


@dataclass(frozen=True)
class Archetypes:
    """A fitted mixture, the scale of its features, and each component's number."""

    shift: np.ndarray
    scale: np.ndarray
    mixture: Mixture
    number: np.ndarray

    def of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and share of each row's likeliest component, in three decimals; -1 and NaN where a feature is missing."""
        number, confidence = np.full(len(x), -1, np.int32), np.full(len(x), np.nan)
        whole = ~np.isnan(x).any(1)
        if whole.any():
            share = self.mixture.posteriors((x[whole] - self.shift) * self.scale)
            number[whole], confidence[whole] = self.number[share.argmax(1)], np.rint(share.max(1) * 1000) / 1000
        return number, confidence


def fit_archetypes(rows: DataFrame, id_col: str, features: Sequence[str], k: int = 4, seed: int = 42, least: int = 50, starts: int = 3) -> Archetypes | None:
    """The mixture of ``archetypes``, fitted on all complete rows; None if they are fewer than ``least``. It reads ``rows`` several times, and packs them once for its passes."""
    whole = rows.na.drop(subset=list(features))
    if whole.count() < least:
        return None
    shift, scale = scales(whole, features)
    blocks = packed_blocks(whole, features, shift, scale)
    fits = []
    for i in range(starts):
        few = bounded_sample(whole.select(id_col, *features), id_col, 5 * k, seed + i).collect()  # only where it begins; the passes take all rows
        first = first_mixture((np.array([[r[f] for f in features] for r in few]) - shift) * scale, k)
        fits.append(GaussianMixture(first, 60).fit(blocks))
    fits = together(fits)
    best = max(fits, key=lambda m: m.log_likelihood)
    s = predicted_sums(blocks, best)
    drop_staged(blocks)
    raw = shift + s[:, 1:] / np.maximum(s[:, :1], 1) * np.divide(1.0, scale, out=np.zeros(len(scale)), where=scale > 0)
    order = sorted(range(k), key=lambda c: (s[c, 0] == 0, raw[c].sum() if s[c, 0] else 0.0, c))
    return Archetypes(shift, scale, best, np.array([order.index(c) for c in range(k)], np.int32))


# -- isolation forest -------------------------------------------------------------------------------


@dataclass(frozen=True)
class IsolationForest:
    """Trees as arrays: feature (-1 for a leaf), cut, left child, right child and the depth credited to a leaf."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    depth: np.ndarray
    sample: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """0.5 - 2^(-mean depth / expected depth): low for outliers."""
        if x.shape[1] == 2:
            total = self._looked_up(x)
        else:
            total = self._walked(x)
        return 0.5 - 2.0 ** (-total / len(self.feature) / max(expected_depth(self.sample), 1e-9))

    def _walked(self, x: np.ndarray) -> np.ndarray:
        """The sum of the depths over all trees, level by level."""
        total = np.zeros(len(x))
        for t in range(len(self.feature)):
            at = np.zeros(len(x), np.int64)
            while True:
                f = self.feature[t, at]
                go = f >= 0
                if not go.any():
                    break
                low = x[np.arange(len(x)), np.maximum(f, 0)] <= self.cut[t, at]
                at = np.where(go, np.where(low, self.left[t, at], self.right[t, at]), at)
            total += self.depth[t, at]
        return total

    @cached_property
    def _tables(self) -> tuple[list[np.ndarray], list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
        """For two features: all trees' cuts of each; and for each tree, from the place among all cuts to that among its own,
        and the depth of each cell that its own cuts make."""
        cuts = [np.unique(self.cut[self.feature == f]) for f in (0, 1)]
        trees = []
        for t in range(len(self.feature)):
            own = [np.unique(self.cut[t][self.feature[t] == f]) for f in (0, 1)]
            depth = np.empty((len(own[0]) + 1, len(own[1]) + 1))
            todo = [(0, 0, len(own[0]) + 1, 0, len(own[1]) + 1)]
            while todo:
                at, a, b, c, d = todo.pop()
                f = self.feature[t, at]
                if f < 0:
                    depth[a:b, c:d] = self.depth[t, at]
                    continue
                m = int(np.searchsorted(own[f], self.cut[t, at])) + 1
                todo += [(self.left[t, at], a, m, c, d), (self.right[t, at], m, b, c, d)] if f == 0 else [(self.left[t, at], a, b, c, m), (self.right[t, at], a, b, m, d)]
            place = [np.r_[0, np.searchsorted(o, every, "right")].astype(np.int32) for o, every in zip(own, cuts)]
            trees.append((place[0] * depth.shape[1], place[1], depth.ravel()))
        return cuts, trees

    def _looked_up(self, x: np.ndarray) -> np.ndarray:
        """As _walked, by two binary searches a row and a table a tree."""
        cuts, trees = self._tables
        i, j = (np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts))
        total = np.zeros(len(x))
        for rows, columns, depth in trees:
            total += depth[rows[i] + columns[j]]
        return total


def expected_depth(n: int | float) -> float:
    """Mean depth of an unsuccessful search in a binary tree of n."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def grow_forest(rows: np.ndarray, trees: int = 100, sample: int = 256, seed: int = 42) -> IsolationForest:
    rng = np.random.default_rng(seed)
    m = min(sample, len(rows))
    limit = int(np.ceil(np.log2(max(m, 2))))
    nodes = 2 ** (limit + 1)
    feature, cut = np.full((trees, nodes), -1), np.zeros((trees, nodes))
    left, right, depth = (np.zeros((trees, nodes), dtype=t) for t in (np.int64, np.int64, float))
    for t in range(trees):
        todo, used = [(0, rows[rng.choice(len(rows), m, replace=False)], 0)], 1
        while todo:
            at, part, level = todo.pop()
            low, high = (part.min(0), part.max(0)) if len(part) else (np.zeros(1), np.zeros(1))
            open_ = np.flatnonzero(high > low)
            if level >= limit or len(part) < 2 or not len(open_):
                depth[t, at] = level + expected_depth(len(part))
                continue
            f = int(rng.choice(open_))
            c = rng.uniform(low[f], high[f])
            feature[t, at], cut[t, at], left[t, at], right[t, at] = f, c, used, used + 1
            below = part[:, f] <= c
            todo += [(used, part[below], level + 1), (used + 1, part[~below], level + 1)]
            used += 2
    return IsolationForest(feature, cut, left, right, depth, m)


def isolation_scores(df: DataFrame, id_col: str, features: Sequence[str], cohort: str | None = None, trees: int = 100, sample: int = 256, seed: int = 42, least: int = 15, most_cohorts: int = 100) -> DataFrame:
    """(id, cohort, score): isolation scores, lower for outliers, in forests of their own for each cohort.

    A tree is grown from ``sample`` rows of its cohort, which is the method itself: a forest needs trees * sample rows. They are taken
    by a hash of the id at the rate that gives twice as many, in one pass for all cohorts, and each forest is grown in a task of its own;
    every row is scored. Missing features become the (approximate) median of the cohort, 0.5 where
    there is none. Cohorts are few (at most ``most_cohorts``, else an error); one below ``least`` rows has null scores.
    """
    c = F.col(cohort).cast("string") if cohort else F.lit("all")
    rows = df.select(F.col(id_col).alias("id"), c.alias("cohort"), *[F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")).alias(f) for f in features]).where(F.col("cohort").isNotNull())
    forests, medians = isolation_forests(rows, features, trees, sample, seed, least, most_cohorts)

    def f(it):
        for pdf in it:
            score = np.full(len(pdf), np.nan)
            for name, g in pdf.reset_index(drop=True).groupby("cohort"):
                if name in forests:
                    x = g[list(features)].to_numpy(dtype=float)
                    score[g.index] = forests[name].score(np.where(np.isnan(x), medians[name], x))
            yield pdf[["id", "cohort"]].assign(score=score)

    out = rows.mapInPandas(f, f"id {rows.schema['id'].dataType.simpleString()}, cohort string, score double")
    return out.withColumn("score", F.nanvl("score", F.lit(None).cast("double")))


def isolation_forests(rows: DataFrame, features: Sequence[str], trees: int = 100, sample: int = 256, seed: int = 42, least: int = 15, most_cohorts: int = 100) -> tuple[dict[str, IsolationForest], dict[str, np.ndarray]]:
    """The forests of ``isolation_scores`` over (id, cohort, features...), and the medians that stand for missing features, by cohort."""
    stats = rows.groupBy("cohort").agg(F.count(F.lit(1)).alias("n"), *[F.percentile_approx(f, 0.5, 10_000).alias(f) for f in features]).limit(most_cohorts + 1).collect()
    if len(stats) > most_cohorts:
        raise ValueError("too many cohorts for a forest each")
    medians = {r["cohort"]: np.array([0.5 if r[f] is None else r[f] for f in features]) for r in stats}
    rates = {r["cohort"]: min(1.0, 2 * trees * sample / r["n"]) for r in stats if r["n"] >= least}

    def grow(key, pdf):
        part = pdf.sort_values("id")[list(features)].to_numpy(dtype=float)
        forest = grow_forest(np.where(np.isnan(part), medians[key[0]], part), trees, sample, seed)
        return pd.DataFrame({"cohort": [key[0]], "forest": [pickle.dumps((forest.feature, forest.cut, forest.left, forest.right, forest.depth, forest.sample))]})

    forests: dict[str, IsolationForest] = {}
    if rates:
        u = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
        rate = F.element_at(F.create_map(*[F.lit(x) for p in rates.items() for x in p]), F.col("cohort"))
        took = rows.where(u < rate).groupBy("cohort").applyInPandas(grow, "cohort string, forest binary").collect()  # a forest a cohort
        forests = {r["cohort"]: IsolationForest(*pickle.loads(r["forest"])) for r in took}
    return forests, medians


def outliers(scores: DataFrame, contamination: float, by_cohort: bool = False) -> DataFrame:
    """Scores with ``outlier``: below the contamination quantile, which is within 1/10,000 in rank."""
    keys = ["cohort"] if by_cohort else []
    cut = scores.groupBy(*keys).agg(F.percentile_approx("score", contamination, 10_000).alias("_cut"))
    joined = scores.join(F.broadcast(cut), keys) if keys else scores.crossJoin(F.broadcast(cut))  # a row a cohort
    return joined.withColumn("outlier", F.coalesce(F.col("score") < F.col("_cut"), F.lit(False))).drop("_cut")


def with_archetypes(rows: DataFrame, id_col: str, features: Sequence[str], contamination: float, least: int) -> Callable[[DataFrame], DataFrame]:
    """What adds ``outlier``, ``archetype`` and ``confidence`` to rows, as outliers of ``isolation_scores`` and ``archetypes`` fitted on the complete ones.

    Both models are fitted first and applied together in one pass, so nothing is joined. ``rows`` is read several times, so stage it; features are doubles without NaN.
    """
    whole = rows.na.drop(subset=list(features)).select(F.col(id_col).alias("id"), F.lit("all").alias("cohort"), *features)
    forests, _ = isolation_forests(whole, features, least=least)
    found, forest, cut = fit_archetypes(whole, "id", features), forests.get("all"), -np.inf
    if forest is not None:

        def scored(it):
            for pdf in it:
                yield pd.DataFrame({"score": forest.score(pdf.to_numpy(dtype=float))})

        cut = whole.select(*features).mapInPandas(scored, "score double").agg(F.percentile_approx("score", contamination, 10_000)).first()[0]

    def add(it):
        for b in it:
            x = np.stack([b[f].cast("double").to_numpy(zero_copy_only=False) for f in features], 1)
            whole = ~np.isnan(x).any(1)
            outlier, number, confidence = np.zeros(len(x), bool), np.full(len(x), -1, np.int32), np.full(len(x), np.nan)
            if forest is not None and whole.any():
                outlier[whole] = forest.score(x[whole]) < cut
            if found is not None:
                number, confidence = found.of(x)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(outlier), pa.array(number), pa.array(confidence, mask=np.isnan(confidence))], [*b.schema.names, "outlier", "archetype", "confidence"])

    def named(df: DataFrame) -> DataFrame:
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        return df.mapInArrow(add, f"{fields}, outlier boolean, archetype int, confidence double")

    return named


def imputed_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing values of numeric columns as the column's (approximate) median."""
    return Imputer(inputCols=list(columns), outputCols=list(columns), strategy="median").fit(df).transform(df)


def save_stage_model(model: PipelineModel, path: str, features: Sequence[str], gsd: tuple[float, float]) -> None:
    """The fitted pipeline in path/model, and one JSON row with its feature names, labels and metres a pixel in path/params."""
    from pyspark.sql import SparkSession

    model.write().overwrite().save(f"{path}/model")
    row = [(list(features), list(model.stages[0].labels), float(gsd[0]), float(gsd[1]))]
    SparkSession.active().createDataFrame(row, "features array<string>, labels array<string>, gsd_x double, gsd_y double").coalesce(1).write.mode("overwrite").json(f"{path}/params")


def load_stage_model(path: str) -> tuple[PipelineModel, list[str], tuple[float, float]]:
    """What save_stage_model wrote: the pipeline, its feature names, metres a pixel."""
    from pyspark.sql import SparkSession

    p = SparkSession.active().read.json(f"{path}/params").first()
    return PipelineModel.load(f"{path}/model"), list(p["features"]), (p["gsd_x"], p["gsd_y"])
