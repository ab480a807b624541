"""Per-account linear models and pooled tree models.

Ridge models come from additive moments of each account's blocks of weeks, logistic ones from a grouped
Arrow call that fits every fold of an account; both give coefficients on the raw scale. All scoring is then a join and a dot product
in the JVM. Forests (grown by operators.trees) and boosted trees (by operators.boosting, few rows by ``pyspark.ml``) are fitted over the rows of all
accounts routed to them, as a tree ensemble per account would be one task's private work.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import model_family
from ledgerloom.operators.boosting import at_once, grow_boosted
from ledgerloom.operators.matrix import walk_forward_folds
from ledgerloom.operators.trees import grow_forest
from ledgerloom.sources.io import written

FINAL_FOLD = -1
RIDGE_ALPHAS = (0.01, 0.1, 1.0, 10.0, 100.0)
#: Contiguous parts of a training set on which ridge chooses its penalty.
INNER = 3

_KEYS = "account_id string, mode string, fold int, n_train int"
RIDGE_SCHEMA = f"{_KEYS}, alpha double, intercept double, coef array<double>"
LOGISTIC_SCHEMA = (
    f"{_KEYS}, classes array<int>, intercepts array<double>, coefs array<array<double>>"
)


# --- numerics of one fit ------------------------------------------------------------------------

def _standardise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 10 * np.finfo(float).eps * np.maximum(np.abs(mean), 1.0), scale, 1.0)
    return (x - mean) / scale, mean, scale


def _ridge_path(x: np.ndarray, y: np.ndarray, alphas) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients and intercepts for every penalty from one eigendecomposition."""
    mx, my = x.mean(axis=0), y.mean()
    values, vectors = np.linalg.eigh((x - mx).T @ (x - mx))
    rotated = vectors.T @ ((x - mx).T @ (y - my))
    coef = np.stack([vectors @ (rotated / (np.maximum(values, 0.0) + a)) for a in alphas])
    return coef, my - coef @ mx


def _r2(y: np.ndarray, yhat: np.ndarray) -> float:
    rss, tss = float(np.sum((y - yhat) ** 2)), float(np.sum((y - y.mean()) ** 2))
    if tss == 0.0:
        return 1.0 if rss == 0.0 else 0.0
    return 1.0 - rss / tss


def ridge_fit(x: np.ndarray, y: np.ndarray, alphas=RIDGE_ALPHAS, inner: int = INNER):
    """Standardised ridge, penalty by contiguous cross-validated R2; returns raw-scale weights."""
    z, mean, scale = _standardise(x)
    scores = np.zeros(len(alphas))
    for held in np.array_split(np.arange(len(y)), inner):
        rest = np.ones(len(y), dtype=bool)
        rest[held] = False
        coef, intercept = _ridge_path(z[rest], y[rest], alphas)
        scores += [_r2(y[held], z[held] @ c + b) for c, b in zip(coef, intercept)]
    best = int(np.argmax(scores))
    coef, intercept = _ridge_path(z, y, alphas[best : best + 1])
    raw = coef[0] / scale
    return alphas[best], float(intercept[0] - raw @ mean), raw


def logistic_fit(x: np.ndarray, labels: np.ndarray, c: float = 1.0, steps: int = 100, start: tuple | None = None):
    """L2 logistic regression by damped Newton; the intercepts carry no penalty.

    Two classes use one weight vector (the second class's), more use one per class. ``start``, what
    this function returned for other rows, spares steps where its classes are the same: the minimum is one.
    """
    classes = np.unique(labels)
    z, mean, scale = _standardise(x)
    design = np.column_stack([z, np.ones(len(z))])
    n, p = design.shape
    binary = len(classes) == 2
    k = 1 if binary else len(classes)
    across = np.ascontiguousarray(design.T)
    truth = ((classes[1:] if binary else classes)[:, None] == labels).astype(float)
    penalty = np.tile(np.append(np.ones(p - 1), 0.0), k) / c
    # Equal shifts of all classes' intercepts change nothing: without this the Hessian is singular.
    fixed = np.diag(penalty) + (0.0 if binary else np.outer(penalty == 0, penalty == 0))

    def tried(w):
        """The penalised loss at ``w`` and the classes' probabilities, one row a class."""
        score = w.reshape(k, p) @ across
        top = score.max(axis=0)
        if binary:
            top = np.maximum(top, 0.0)
        prob = np.exp(score - top)
        total = prob.sum(axis=0)
        if binary:
            total += np.exp(-top)
        value = float(np.sum(top + np.log(total)) - np.vdot(score, truth) + 0.5 * penalty @ (w * w))
        return value, prob / total

    w = np.zeros(k * p)
    if start is not None and np.array_equal(start[0], classes):
        weights = np.asarray(start[2])[-k:]
        w = np.column_stack([weights * scale, np.asarray(start[1])[-k:] + weights @ mean]).ravel()
    value, prob = tried(w)
    for _ in range(steps):
        gradient = ((prob - truth) @ design).ravel() + penalty * w
        if np.max(np.abs(gradient)) < 1e-8:
            break
        spread = (prob[:, None, :] * across).reshape(k * p, n)
        hessian = fixed - spread @ spread.T
        for a in range(k):
            own = slice(a * p, (a + 1) * p)
            hessian[own, own] += spread[own] @ design
        try:
            step = np.linalg.solve(hessian, gradient)
        except np.linalg.LinAlgError:
            step = np.linalg.lstsq(hessian, gradient, rcond=1e-12)[0]
        size = 1.0
        met = tried(w - step)
        while not met[0] <= value + 1e-12 * abs(value) and size > 1e-8:
            size /= 2
            met = tried(w - size * step)
        if size <= 1e-8:
            break
        w = w - size * step
        value, prob = met
    weights = w.reshape(k, p)
    raw = weights[:, :-1] / scale
    intercepts = weights[:, -1] - raw @ mean
    if binary:
        raw = np.vstack([np.zeros_like(raw), raw])
        intercepts = np.append(0.0, intercepts)
    return classes, intercepts, raw


# --- grouped fits ---------------------------------------------------------------------------------

def dealt_by_account(rows: DataFrame) -> DataFrame:
    """Rows by account over all of the session's shuffle partitions.

    Adaptive execution would join partitions of few bytes; a fit's time is not in its bytes.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "account_id")


def _train_ends(n: int, n_splits: int, test_size: int, min_train: int) -> list[tuple[int, int]]:
    """(fold, rows to train on); the final fold trains on everything."""
    ends = [(s, n - (s + 1) * test_size) for s in range(n_splits)]
    return [(s, e) for s, e in ends if e >= min_train] + [(FINAL_FOLD, n)]


def _grouped(
    matrix: DataFrame, x: str, target: str, mode: str, schema: str,
    fit: Callable[[np.ndarray, np.ndarray, dict | None], dict | None],
    n_splits: int, test_size: int, min_train: int, min_rows: int,
    worth: Callable[[np.ndarray], bool] = lambda targets: True,
) -> DataFrame:
    """Fit every fold of each account; a group is one account's weeks, bounded by the calendar.

    An account whose targets are not ``worth`` a model gets none. ``fit`` is given the fold before, to start from.
    """

    def per_account(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        features = np.stack(rows["x"].to_numpy()).astype(float)
        targets = rows["target"].to_numpy()
        out = []
        ends = _train_ends(len(rows), n_splits, test_size, min_train) if worth(targets) else []
        before = None
        for fold, end in ends:
            fitted = fit(features[:end], targets[:end], before)
            if fitted is not None:
                before = fitted
                out.append({
                    "account_id": rows["account_id"].iloc[0], "mode": rows["mode"].iloc[0],
                    "fold": fold, "n_train": end, **fitted,
                })
        columns = [part.split()[0] for part in schema.split(", ")]
        return pd.DataFrame(out, columns=columns)

    rows = matrix.where(F.col("n_rows") >= min_rows).select(
        "account_id", "pos", F.col(mode).alias("mode"), F.col(x).alias("x"), F.col(target).alias("target"))
    return dealt_by_account(rows).groupBy("account_id").applyInPandas(per_account, schema)


def _ridge_blocks(n: int, n_splits: int, test_size: int, min_train: int) -> list[int]:
    """Positions that bound the blocks of which every training set and its inner thirds are made."""
    cuts = set()
    for _, end in _train_ends(n, n_splits, test_size, min_train):
        cuts |= {part[-1] + 1 for part in np.array_split(np.arange(end), INNER) if len(part)}
    return sorted(cuts)


def _merged_moments(blocks: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, means and centred products of the union of blocks, pair by pair."""
    n, mean, products = blocks[0]
    for m, other, more in blocks[1:]:
        away = other - mean
        products = products + more + np.outer(away, away) * (n * m / (n + m))
        mean = mean + away * (m / (n + m))
        n += m
    return n, mean, products


def _ridge_of_moments(parts: list[list[tuple]], alphas=RIDGE_ALPHAS) -> tuple[float, float, np.ndarray]:
    """ridge_fit() from the moments of the training rows; ``parts`` are the blocks of each inner third.

    The response is the last column. The held third's residuals follow from its moments alone.
    """
    n, mean, products = _merged_moments([b for part in parts for b in part])
    scale = np.sqrt(np.diag(products)[:-1] / n)
    scale = np.where(scale > 10 * np.finfo(float).eps * np.maximum(np.abs(mean[:-1]), 1.0), scale, 1.0)
    unit = np.append(scale, 1.0)

    def path(blocks, alphas) -> tuple[np.ndarray, np.ndarray]:
        _, own, cross = _merged_moments(blocks)
        own, cross = (own - mean) / unit, cross / np.outer(unit, unit)
        values, vectors = np.linalg.eigh(cross[:-1, :-1])
        rotated = vectors.T @ cross[:-1, -1]
        coef = np.stack([vectors @ (rotated / (np.maximum(values, 0.0) + a)) for a in alphas])
        return coef, own[-1] - coef @ own[:-1]

    scores = np.zeros(len(alphas))
    for i, held in enumerate(parts):
        coef, intercept = path([b for j, part in enumerate(parts) if j != i for b in part], alphas)
        rows, own, cross = _merged_moments(held)
        own, cross = (own - mean) / unit, cross / np.outer(unit, unit)
        tss = cross[-1, -1]
        for k, (c, b) in enumerate(zip(coef, intercept, strict=True)):
            rss = tss - 2 * c @ cross[:-1, -1] + c @ cross[:-1, :-1] @ c + rows * (own[-1] - b - c @ own[:-1]) ** 2
            scores[k] += (1.0 if rss == 0 else 0.0) if tss == 0 else 1 - rss / tss
    best = int(np.argmax(scores))
    coef, intercept = path([b for part in parts for b in part], alphas[best : best + 1])
    raw = coef[0] / scale
    return alphas[best], float(intercept[0] + mean[-1] - raw @ mean[:-1]), raw


def block_moments(
    matrix: DataFrame, n_splits: int = 3, test_size: int = 4, min_train: int = 10, min_rows: int = 14
) -> DataFrame:
    """Per account the moments of its blocks: (account_id, mode, n_rows, blocks of (block, n, moments)).

    ``moments`` holds the means of the features and the response and their centred products, as
    doubles. Each batch of rows makes its own; they are additive, so rows need not be sorted or
    together, and an account is a few of them however many rows it has.
    """
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            names, modes = batch.column(0), batch.column(4).to_pylist()
            codes = names.dictionary_encode()
            pos, sizes, y = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
            x = batch.column(5)
            starts = np.concatenate(([0], np.cumsum(x.value_lengths().to_numpy(zero_copy_only=False))))
            values = x.flatten().to_numpy(zero_copy_only=False)
            for n in np.unique(sizes):
                if n not in cuts:
                    cuts[n] = np.array(_ridge_blocks(int(n), n_splits, test_size, min_train))
            block = np.array([np.searchsorted(cuts[n], p, "right") for n, p in zip(sizes, pos, strict=True)])
            code = codes.indices.to_numpy(zero_copy_only=False)
            order = np.lexsort((block, code))
            edges = np.flatnonzero(np.diff(code[order]) | np.diff(block[order])) + 1
            out = []
            for rows in np.split(order, edges):
                first = rows[0]
                wide = np.stack([np.append(values[starts[r] : starts[r + 1]], y[r]) for r in rows])
                mean = wide.mean(axis=0)
                away = wide - mean
                moments = np.concatenate((mean, (away.T @ away).ravel())).tobytes()
                out.append((codes.dictionary[code[first]].as_py(), modes[first], int(sizes[first]),
                            int(block[first]), len(rows), moments))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], columns
            )

    columns = ["account_id", "mode", "n_rows", "block", "n", "moments"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
    rows = matrix.where(F.col("n_rows") >= min_rows).select(
        "account_id", F.col("pos").cast("long"), F.col("n_rows").cast("long"), F.col("y").cast("double"),
        F.col("mode_reg").alias("mode"), F.col("x_reg").alias("x"),
    )
    return rows.mapInArrow(
        partial, "account_id string, mode string, n_rows long, block int, n long, moments binary"
    ).groupBy("account_id").agg(
        F.first("mode").alias("mode"), F.first("n_rows").alias("n_rows"),
        F.collect_list(F.struct("block", "n", "moments")).alias("blocks"),
    )


def fit_ridge(
    matrix: DataFrame, n_splits: int = 3, test_size: int = 4, min_train: int = 10, min_rows: int = 14
) -> DataFrame:
    """Ridge coefficients per account and fold, the final fit as fold -1 (alone with ``n_splits=0``).

    Every fold's training set, and each third that the penalty is chosen on, is a union of the blocks
    of block_moments(), so all fits of an account come from one pass over its rows and from moments
    only. An account is one row by the time it is fitted.
    """
    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name, mode, n, blocks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                cuts = _ridge_blocks(n, n_splits, test_size, min_train)
                met: list[list[tuple]] = [[] for _ in range(len(cuts) + 1)]
                for b in blocks:
                    data = np.frombuffer(b["moments"])
                    width = int((np.sqrt(4 * len(data) + 1) - 1) / 2 + 0.5)
                    met[b["block"]].append((b["n"], data[:width], data[width:].reshape(width, width)))
                for fold, end in _train_ends(n, n_splits, test_size, min_train):
                    ends = [0, *(part[-1] + 1 for part in np.array_split(np.arange(end), INNER))]
                    places = np.searchsorted([0, *cuts], ends)
                    parts = [
                        [m for i in range(a, b) for m in met[i]] for a, b in zip(places, places[1:])
                    ]
                    out.append((name, mode, fold, end, *_ridge_of_moments(parts)))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)],
                    ["account_id", "mode", "fold", "n_train", "alpha", "intercept", "coef"],
                )

    kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.float64())]
    return block_moments(matrix, n_splits, test_size, min_train, min_rows).mapInArrow(solved, RIDGE_SCHEMA)


def fit_logistic(
    matrix: DataFrame, n_splits: int = 3, test_size: int = 4, min_train: int = 10, min_rows: int = 14
) -> DataFrame:
    """Logistic coefficients per account and fold; a training set of one class gives no model.

    Nor does an account without any evaluable fold: its longest training set before a test block
    needs ``min_train`` rows of two classes, whether or not fold models are asked for.
    """

    def fit(x, labels, before):
        if len(np.unique(labels)) < 2:
            return None
        start = before and (before["classes"], before["intercepts"], before["coefs"])
        classes, intercepts, coefs = logistic_fit(x, labels, start=start)
        return {"classes": classes, "intercepts": intercepts, "coefs": list(coefs)}

    def evaluable(labels):
        longest = labels[: max(len(labels) - test_size, 0)]
        return len(longest) >= min_train and len(np.unique(longest)) > 1

    return _grouped(matrix, "x_clf", "label", "mode_clf", LOGISTIC_SCHEMA, fit,
                    n_splits, test_size, min_train, min_rows, evaluable)


# --- scoring in the JVM -----------------------------------------------------------------------------

def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda u, v: u * v), F.lit(0.0), lambda acc, v: acc + v)


def linear_prediction(x: Column) -> Column:
    return F.col("intercept") + dot(F.col("coef"), x)


def class_prediction(x: Column) -> Column:
    """Class of the largest score; equal scores go to the smaller class."""
    scores = F.zip_with(
        F.transform("coefs", lambda c: dot(c, x)), F.col("intercepts"), lambda s, b: s + b
    )
    return F.element_at("classes", F.array_position(scores, F.array_max(scores)).cast("int"))


def fold_predictions(
    folds: DataFrame, models: DataFrame, task: str, last_block: bool = False, test_size: int = 4
) -> DataFrame:
    """Test rows scored by their fold's model.

    ``last_block`` scores the newest rows with every fold's model instead.
    """
    x, yhat = {
        "regression": ("x_reg", linear_prediction(F.col("x_reg")).alias("yhat")),
        "classification": ("x_clf", class_prediction(F.col("x_clf")).alias("predicted")),
    }[task]
    fitted = models.where(F.col("fold") != FINAL_FOLD).drop("mode", "n_train")
    if last_block:
        rows = folds.where(F.col("pos") >= F.col("n_rows") - test_size)
        joined = rows.join(fitted, "account_id")
    else:
        joined = folds.where(F.col("role") == "test").join(fitted, ["account_id", "fold"])
    return joined.select("account_id", "fold", "pos", "y", "label", yhat)


# --- pooled tree models -----------------------------------------------------------------------------

def _vectors(rows: DataFrame, x: str) -> DataFrame:
    return rows.withColumn("_features", array_to_vector(F.col(x)))


#: Rows of one partition of few rows; sets of no more are boosted by ``pyspark.ml`` itself.
ROWS_PER_TASK = 50_000


def _compact(train: DataFrame, rows: int) -> DataFrame:
    """Few rows in few partitions; which rows candidate thresholds are drawn from depends on them."""
    return train.coalesce(max(1, -(-rows // ROWS_PER_TASK)))


def fit_forest(train: DataFrame, x: str = "x_pooled", trees: int = 100, depth: int = 5, seed: int = 42):
    """Random forest over the rows of all accounts routed to it."""
    forest = RandomForestRegressor(
        featuresCol="_features", labelCol="y", predictionCol="yhat",
        numTrees=trees, maxDepth=depth, seed=seed,
    )
    return grow_forest(train, x, forest)


def fit_boosted(
    train: DataFrame, x: str = "x_pooled", rounds: int = 100, rate: float = 0.05, depth: int = 4,
    seed: int = 42,
):
    """Gradient-boosted trees over the rows of all accounts routed to them."""
    return fit_boosted_sets([train], x, rounds, rate, depth, seed)[0]


def fit_boosted_sets(
    trains: list[DataFrame], x: str = "x_pooled", rounds: int = 100, rate: float = 0.05, depth: int = 4,
    seed: int = 42,
) -> list:
    """fit_boosted() of each set of rows; one job serves them all where they are large.

    In a set of one partition the order of its rows decides between equal splits, so ``pyspark.ml`` fits it.
    """
    boosted = GBTRegressor(
        featuresCol="_features", labelCol="y", predictionCol="yhat",
        maxIter=rounds, stepSize=rate, maxDepth=depth, seed=seed,
    )
    if not trains:
        return []
    spark = trains[0].sparkSession
    sizes = at_once(spark, lambda train: train.count(), trains)
    sets = [_compact(train, n) for train, n in zip(trains, sizes, strict=True)]
    few, many = ([k for k, n in enumerate(sizes) if (n > ROWS_PER_TASK) == large] for large in (False, True))
    models = dict(zip(few, at_once(spark, lambda k: boosted.fit(_vectors(sets[k], x)), few), strict=True))
    models.update(zip(many, grow_boosted([sets[k] for k in many], x, boosted), strict=True))
    return [models[k] for k in range(len(sets))]


def pooled_predictions(model, rows: DataFrame, x: str = "x_pooled") -> DataFrame:
    return model.transform(_vectors(rows, x)).drop("_features")


POOLED_FITS = {"rf": fit_forest, "lgbm": fit_boosted}
#: Families whose models of several sets of rows are fitted together.
SETS_FITS = {"lgbm": fit_boosted_sets}


def routed(rows: DataFrame, family: str) -> DataFrame:
    """Rows of the accounts whose policy names the family's model."""
    return rows.where(model_family(F.col("regression_model")) == family)


def calendar_folds(
    matrix: DataFrame, n_splits: int = 3, test_size: int = 4, min_train: int = 10, min_rows: int = 14,
    grid_weeks: int = 4,
) -> DataFrame:
    """Test rows of each fold with ``cut``: models trained on weeks before it know nothing of the test.

    A fold's test block is that of walk_forward_folds(). ``cut`` is its first week, put back to the
    start of a ``grid_weeks`` block of the calendar, so that accounts and folds share cuts and their
    number is bounded by the calendar. Each fold also scores the newest block, with ``block`` = 'last'.
    """
    tested = walk_forward_folds(matrix, n_splits, test_size, min_train, min_rows).where("role = 'test'")
    span = Window.partitionBy("account_id", "fold")
    day = F.datediff(F.min("week").over(span), F.lit("1970-01-05").cast("date"))
    cut = F.date_add(F.lit("1970-01-05").cast("date"), (day - F.pmod(day, F.lit(7 * grid_weeks))).cast("int"))
    own = tested.withColumn("cut", cut).withColumn("block", F.lit("test"))
    newest = matrix.where(F.col("pos") >= F.col("n_rows") - test_size)
    cuts = own.groupBy("account_id", "fold").agg(F.first("cut").alias("cut"))
    last = newest.join(cuts, "account_id").withColumn("block", F.lit("last"))
    columns = ["account_id", "fold", "block", "cut", "week", "pos", "y", "x_pooled"]
    return own.select(*columns).unionByName(last.select(*columns))


def pooled_fold_predictions(
    matrix: DataFrame, family: str, n_splits: int = 3, test_size: int = 4, min_rows: int = 14,
    grid_weeks: int = 4, **parameters,
) -> DataFrame:
    """Test rows of the family's accounts scored by models that saw no later week of any account.

    One model per cut of calendar_folds(), trained on all the family's rows of earlier weeks and
    used for every account and fold with that cut, for the fold's own block and the newest one.
    An account whose history, or any other's, begins at a cut has no earlier row and no model for it.
    """
    mine = written(
        routed(matrix, family).where(F.col("n_rows") >= min_rows)
        .select("account_id", "week", "pos", "n_rows", "y", "x_pooled"),
        "pooled-rows",
    )
    tested = written(calendar_folds(mine, n_splits, test_size, min_rows=min_rows, grid_weeks=grid_weeks), "pooled-folds")

    def fitted(trains: list[DataFrame]) -> list:
        if family in SETS_FITS:
            return SETS_FITS[family](trains, **parameters)
        return at_once(matrix.sparkSession, lambda train: POOLED_FITS[family](train, **parameters), trains)

    def scored(cut, model) -> DataFrame:
        return pooled_predictions(model, tested.where(F.col("cut") == F.lit(cut))).drop("x_pooled", "week")

    cuts = [r["cut"] for r in tested.select("cut").distinct().orderBy("cut").collect()]
    first = mine.agg(F.min("week").alias("week")).first()["week"]
    cuts = [cut for cut in cuts if cut is not None and first is not None and first < cut]
    models = fitted([mine.where(F.col("week") < F.lit(cut)) for cut in cuts])
    none = tested.where("false").drop("x_pooled", "week").withColumn("yhat", F.lit(0.0))
    found = [scored(cut, model) for cut, model in zip(cuts, models, strict=True)]
    return reduce(DataFrame.unionByName, found, none).withColumn("model_name", F.lit(family))
