"""Dwell-behaviour segmentation.

Clustering uses dwell, TEU, storage cost and weight only; categories describe
the segments afterwards. Identical feature rows are merged into weighted points
before any fit, which changes no objective and shrinks the data to the number
of distinct feature values.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside.functions import bands
from quayside.functions.exact import cents, mean_days, mean_money, quantiles_wide, sum_money
from quayside.functions.visit import dwell_micros
from quayside.operators import cells, kmeans
from quayside.operators.quality import adjusted_skewness
from quayside.session import cut_lineage

INPUTS = ["dwell_hours", "teu_equivalent", "storage_cost_usd", "weight_tons"]
LOGGED = ["dwell_hours", "storage_cost_usd"]
SKEW_LIMIT = 2
Z = [f"z_{c}" for c in INPUTS]
MAX_SELECTABLE_K = 8
SILHOUETTE = "simplified_euclidean"  # what the column `silhouette` holds


# --- feature matrix -----------------------------------------------------------

def _inputs(features: DataFrame) -> DataFrame:
    """Closed visits with absent feature values as zero.

    A feature that is null everywhere becomes constant, hence zero after
    scaling, and has no influence on any distance.
    """
    absent = [c for c in INPUTS if c not in features.columns]
    rows = features.where(F.col("dwell_hours").isNotNull())
    return rows.withColumns({
        f"x_{c}": F.lit(0.0) if c in absent else F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        for c in INPUTS})


def scaling(features: DataFrame) -> DataFrame:
    """Per feature: skewness, whether to take logs, and mean and deviation (one row)."""
    rows, aggs = _inputs(features), []
    for c in INPUTS:
        x = F.col(f"x_{c}")
        aggs += [F.avg(x).alias(f"{c}__mean"), F.stddev_pop(x).alias(f"{c}__std")]
        if c in LOGGED:
            aggs += [adjusted_skewness(x).alias(f"{c}__skew"),
                     F.avg(F.log1p(x)).alias(f"{c}__log_mean"),
                     F.stddev_pop(F.log1p(x)).alias(f"{c}__log_std")]
    return rows.agg(*aggs)


def scaled_features(features: DataFrame, scales: DataFrame | None = None) -> DataFrame:
    """Closed visits with one z-scored column per clustering feature.

    Skewed features (beyond +-2) are logged first; a constant feature is left
    undivided. The statistics enter as a one-row subquery, so the plan stays
    lazy although the log step depends on the data. ``scales`` takes them from a
    stored row of ``scaling``, so that every use has the same last digits.
    """
    rows = _inputs(features)
    one = scaling(features) if scales is None else scales
    stats = one.select(F.struct(*one.columns)).scalar()
    out = rows.withColumn("_s", stats)
    columns = {}
    for c in INPUTS:
        x, s = F.col(f"x_{c}"), F.col("_s")
        mean, std = s[f"{c}__mean"], s[f"{c}__std"]
        if c in LOGGED:
            take_log = F.abs(s[f"{c}__skew"]) > SKEW_LIMIT
            x = F.when(take_log, F.log1p(x)).otherwise(x)
            mean = F.when(take_log, s[f"{c}__log_mean"]).otherwise(mean)
            std = F.when(take_log, s[f"{c}__log_std"]).otherwise(std)
        columns[f"z_{c}"] = (x - mean) / F.when(std == 0, 1.0).otherwise(std)
    return out.withColumns(columns).drop("_s", *[f"x_{c}" for c in INPUTS])


def weighted_points(scaled: DataFrame) -> DataFrame:
    """Distinct feature rows with their number of visits."""
    money = F.coalesce("storage_cost_usd", F.lit(0.0)) \
        if "storage_cost_usd" in scaled.columns else F.lit(0.0)
    return scaled.groupBy(*Z, F.col("dwell_hours"), money.alias("cost")).agg(
        F.count(F.lit(1)).alias("w"))


# --- assignment and metrics for given centres ---------------------------------

def _squared_distance(centre: Sequence[float], columns: Sequence[str]) -> Column:
    total = None
    for name, value in zip(columns, centre):
        gap = F.col(name) - F.lit(float(value))
        total = gap * gap if total is None else total + gap * gap
    return total


def nearest_centroid(
    points: DataFrame, centres: Sequence[Sequence[float]], columns: Sequence[str] = tuple(Z),
) -> DataFrame:
    """Closest centre per row (the first one on a tie) and the squared distance.

    The label is declared non-null: otherwise a later join on it would make
    Catalyst push a null check, and with it the whole distance expression, down
    to the scan.
    """
    options = F.array(*[
        F.struct(_squared_distance(c, columns).alias("d"), F.lit(i).alias("i"))
        for i, c in enumerate(centres)])
    return points.withColumn("_best", F.array_min(options)).withColumns({
        "cluster": F.coalesce(F.col("_best.i"), F.lit(0)), "squared_distance": F.col("_best.d")}).drop("_best")


def _weight(points: DataFrame) -> Column:
    return F.col("w") if "w" in points.columns else F.lit(1).cast("bigint")


def cluster_stats(points: DataFrame, keys: Sequence[str] = ("cluster",),
                  columns: Sequence[str] = tuple(Z)) -> DataFrame:
    """Size, coordinate sums and sum of squared norms per cluster."""
    w = _weight(points)
    norm = None
    for c in columns:
        norm = F.col(c) * F.col(c) if norm is None else norm + F.col(c) * F.col(c)
    return points.groupBy(*keys).agg(
        F.sum(w).alias("n"), F.sum(w * norm).alias("ss"),
        *[F.sum(w * F.col(c)).alias(f"sum_{c}") for c in columns])


def _spread(columns: Sequence[str]) -> Column:
    """Squared norm of a cluster's coordinate sum, over its size."""
    total = None
    for c in columns:
        term = F.col(f"sum_{c}") * F.col(f"sum_{c}")
        total = term if total is None else total + term
    return total / F.col("n")


def dispersion_metrics(stats: DataFrame, model: Sequence[str] = (),
                       columns: Sequence[str] = tuple(Z)) -> DataFrame:
    """Inertia, Calinski-Harabasz and segment size range per model, in closed form."""
    totals = [F.sum(f"sum_{c}").alias(f"all_{c}") for c in columns]
    whole = None
    for c in columns:
        term = F.col(f"all_{c}") * F.col(f"all_{c}")
        whole = term if whole is None else whole + term
    within, between = F.col("ss") - F.col("between"), F.col("between") - F.col("grand")
    return (
        stats.withColumn("_spread", _spread(columns)).groupBy(*model).agg(
            F.count(F.lit(1)).alias("clusters"), F.sum("n").alias("rows"),
            F.sum("ss").alias("ss"), F.sum("_spread").alias("between"), *totals,
            F.min("n").alias("_least"), F.max("n").alias("_most"))
        .withColumn("grand", whole / F.col("rows"))
        .select(
            *model, "clusters", "rows", within.alias("inertia"),
            F.try_divide(between * (F.col("rows") - F.col("clusters")),
                         within * (F.col("clusters") - 1)).alias("calinski_harabasz"),
            (F.col("_least") / F.col("rows") * 100).alias("min_pct"),
            (F.col("_most") / F.col("rows") * 100).alias("max_pct"))
    )


def davies_bouldin(points: DataFrame, stats: DataFrame, model: Sequence[str] = (),
                   columns: Sequence[str] = tuple(Z)) -> DataFrame:
    """Mean over clusters of the worst (scatter + scatter) / separation ratio.

    Only the k cluster rows of a model are paired with each other.
    """
    model = list(model)
    on = [*model, "cluster"]
    means = stats.select(*on, *[(F.col(f"sum_{c}") / F.col("n")).alias(f"m_{c}") for c in columns])
    gap = None
    for c in columns:
        term = (F.col(c) - F.col(f"m_{c}")) ** 2
        gap = term if gap is None else gap + term
    w = _weight(points)
    scatter = points.join(means, on).groupBy(*on).agg(
        (F.sum(w * F.sqrt(gap)) / F.sum(w)).alias("s"),
        *[F.first(f"m_{c}").alias(f"m_{c}") for c in columns])
    packed = scatter.groupBy(*model).agg(
        F.sort_array(F.collect_list(F.struct("cluster", "s", *[f"m_{c}" for c in columns]))).alias("c"))

    def ratio(a: Column, b: Column) -> Column:
        apart = None
        for c in columns:
            term = (a[f"m_{c}"] - b[f"m_{c}"]) ** 2
            apart = term if apart is None else apart + term
        return F.try_divide(a["s"] + b["s"], F.sqrt(apart))

    worst = F.transform("c", lambda a: F.array_max(F.transform(
        F.filter("c", lambda b: b["cluster"] != a["cluster"]), lambda b: ratio(a, b))))
    total = F.aggregate(worst, F.lit(0.0), lambda acc, x: acc + x)
    return packed.select(*model, (total / F.size("c")).alias("davies_bouldin"))


def silhouette_squared(points: DataFrame, stats: DataFrame, columns: Sequence[str] = tuple(Z)) -> DataFrame:
    """Silhouette over all rows for squared Euclidean distance.

    The mean squared distance of a row to a cluster follows from the cluster's
    size, sum and squared norm, so no pair of rows is ever formed. The scale
    differs from the Euclidean silhouette.
    """
    packed = stats.agg(F.collect_list(F.struct(*stats.columns))).scalar()
    norm = None
    for c in columns:
        norm = F.col(c) * F.col(c) if norm is None else norm + F.col(c) * F.col(c)

    def distance_sum(s: Column) -> Column:
        dot = None
        for c in columns:
            term = F.col(c) * s[f"sum_{c}"]
            dot = term if dot is None else dot + term
        return s["n"] * norm - 2 * dot + s["ss"]

    own = F.element_at(F.filter("_c", lambda s: s["cluster"] == F.col("cluster")), 1)
    others = F.filter("_c", lambda s: s["cluster"] != F.col("cluster"))
    scored = (
        points.withColumn("_c", packed).withColumn("_own", own)
        .withColumn("_a", F.try_divide(distance_sum(F.col("_own")), F.col("_own.n") - 1))
        .withColumn("_b", F.array_min(F.transform(others, lambda s: distance_sum(s) / s["n"])))
    )
    a, b, w = F.col("_a"), F.col("_b"), _weight(points)
    score = F.when(F.col("_own.n") > 1, F.try_divide(b - a, F.greatest(a, b))).otherwise(0.0)
    return scored.agg((F.sum(w * F.coalesce(score, F.lit(0.0))) / F.sum(w)).alias("silhouette_squared"))


def centre_distances(centres: Sequence[Sequence[float]], label: Column,
                     columns: Sequence[str] = tuple(Z)) -> tuple[Column, Column]:
    """Distance of a row to its own centre and to the nearest other one."""
    gaps = F.array(*[F.sqrt(_squared_distance(c, columns)) for c in centres])
    others = F.filter(gaps, lambda d, i: i != label)
    return F.get(gaps, label), F.array_min(others)


def simplified_score(own: Column, other: Column) -> Column:
    """Silhouette of a row by its distances to centres; 0 where it stands between two."""
    return F.coalesce(F.try_divide(other - own, F.greatest(own, other)), F.lit(0.0))


def silhouette_simplified(points: DataFrame, centres: Sequence[Sequence[float]],
                          columns: Sequence[str] = tuple(Z)) -> DataFrame:
    """Simplified silhouette over all rows: distances to centres stand for means over rows.

    On the Euclidean scale, so the usual bands apply; a row costs k distances.
    """
    own, other = centre_distances(centres, F.col("cluster"), columns)
    w = _weight(points)
    return points.agg((F.sum(w * simplified_score(own, other)) / F.sum(w)).alias("silhouette"))


# --- sweep and selection ------------------------------------------------------

@dataclass
class Sweep:
    """Fitted models and the table of their metrics."""

    scaled: DataFrame
    metrics: DataFrame
    models: dict = field(default_factory=dict)
    points: DataFrame | None = None  # the weighted points of ``scaled`` with all labels, where stored

    def label(self, algorithm: str, k: int) -> DataFrame:
        """The closed visits with the labels of one model (no join needed)."""
        return _labelled(self.scaled, {(algorithm, k): self.models[algorithm, k]}).withColumnRenamed(
            _label_name(algorithm, k), "cluster")


def _label_name(algorithm: str, k: int) -> str:
    return f"label_{algorithm}_{k}"


def _labelled(points: DataFrame, models: dict) -> DataFrame:
    """Points with a label for each model; labels that are there already are kept."""
    models = {key: m for key, m in models.items() if _label_name(*key) not in points.columns}
    linked = {key: m for key, m in models.items() if isinstance(m, cells.WardModel)}
    out = points.withColumns({
        _label_name(*key): F.coalesce(_nearest(m.clusterCenters()), F.lit(0))
        for key, m in models.items() if key not in linked})
    if not linked:
        return out
    first = next(iter(linked.values()))  # all cuts of one tree
    names = {_label_name(*key): F.coalesce(F.get("labels", F.lit(m.index)), _nearest(m.centres))
             for key, m in linked.items()}
    return first.tree.at(out, first.table).withColumns(names).drop("path", "labels")


def _nearest(centres: Sequence[Sequence[float]]) -> Column:
    """Number of the closest centre, for rows that a model has no leaf for."""
    return F.array_min(F.array(*[F.struct(_squared_distance(c, Z).alias("d"), F.lit(i).alias("i"))
                                 for i, c in enumerate(centres)]))["i"]


def fit_kmeans(points: DataFrame, k: int, n_init: int, seed: int, max_iter: int = 300) -> kmeans.KMeansModel:
    """Best of ``n_init`` restarts by within-cluster sum of squares."""
    return kmeans.fit(points, Z, [k], n_init, seed, max_iter)[k]


def sweep(
    features: DataFrame,
    ks: Sequence[int] = range(2, 11),
    algorithms: Sequence[str] = ("KMeans", "Hierarchical"),
    n_init: int = 10,
    seed: int = 42,
    max_iter: int = 300,
    silhouette_leaves: int = cells.SILHOUETTE_LEAVES,
) -> Sweep:
    """Fit every algorithm and k, and measure all models in shared passes.

    The hierarchical models are cuts of one Ward dendrogram over all rows. ``silhouette``
    is the Euclidean one over all rows, to within ``silhouette_bound``; more
    ``silhouette_leaves`` make that smaller.
    """
    scaled = scaled_features(features, cut_lineage(scaling(features)))
    points = cut_lineage(weighted_points(scaled))
    models: dict = {}
    if "KMeans" in algorithms:
        fitted = kmeans.fit(points, Z, list(ks), n_init, seed, max_iter)
        models.update({("KMeans", k): m for k, m in fitted.items()})
    if "Hierarchical" in algorithms:
        models.update({("Hierarchical", k): m for k, m in cells.fit_ward(points, Z, list(ks)).items()})
    points = cut_lineage(_labelled(points, models))
    metrics = model_metrics(points, models).drop("silhouette", "silhouette_metric")
    scores = silhouettes(points, models, silhouette_leaves).withColumn("silhouette_metric", F.lit("euclidean"))
    return Sweep(scaled, cut_lineage(metrics.join(scores, ["algorithm", "k"])), models, points)


def silhouettes(points: DataFrame, models: dict, leaves: int = cells.SILHOUETTE_LEAVES) -> DataFrame:
    """Euclidean silhouette of every model over all rows: (algorithm, k, silhouette, silhouette_bound)."""
    linked = next((m for m in models.values() if isinstance(m, cells.WardModel)), None)
    tree = cells.cell_tree(points, Z, leaves) if linked is None else cells.coarser(linked.tree, leaves)
    names = {_label_name(a, k): (a, k) for a, k in models}
    placed = _labelled(points, models).select(*Z, "w", *[F.col(n).cast("int").alias(n) for n in names])
    found = cells.euclidean_silhouettes(placed, list(names), Z, tree)
    key = F.element_at(F.create_map(*[x for n, (a, k) in names.items() for x in (
        F.lit(n), F.struct(F.lit(a).alias("algorithm"), F.lit(k).alias("k")))]), F.col("label"))
    return found.select(key.alias("model"), "silhouette", "silhouette_bound").select(
        "model.*", "silhouette", "silhouette_bound")


def _long(points: DataFrame, models: dict) -> DataFrame:
    """Every point once for each model, with its label and distances to the model's centres."""
    return _labelled(points, models).select(*Z, "w", "dwell_hours", "cost", F.inline(F.array(*[
        _placed(a, k, F.col(_label_name(a, k)), model.clusterCenters())
        for (a, k), model in models.items()])))


def _placed(algorithm: str, k: int, label: Column, centres: Sequence[Sequence[float]]) -> Column:
    own, other = centre_distances([[float(x) for x in c] for c in centres], label)
    return F.struct(
        F.lit(algorithm).alias("algorithm"), F.lit(k).alias("k"), label.cast("int").alias("cluster"),
        own.alias("own"), other.alias("other"))


def metrics_of(long: DataFrame) -> DataFrame:
    """Metrics of every model from rows (algorithm, k, cluster, own, other, Z, w, dwell_hours, cost)."""
    model = ["algorithm", "k"]
    norm = sum((F.col(c) * F.col(c) for c in Z[1:]), F.col(Z[0]) * F.col(Z[0]))
    stats = cut_lineage(long.groupBy(*model, "cluster").agg(
        F.sum("w").alias("n"), F.sum(F.col("w") * norm).alias("ss"),
        *[F.sum(F.col("w") * F.col(c)).alias(f"sum_{c}") for c in Z],
        F.sum(F.col("w") * F.col("dwell_hours")).alias("dwell"),
        F.sum(F.col("w") * F.col("cost")).alias("cost"),
        F.sum(F.col("w") * simplified_score(F.col("own"), F.col("other"))).alias("score")))
    return (
        dispersion_metrics(stats, model)
        .join(davies_bouldin(long, stats, model), model)
        .join(stats.groupBy(*model).agg((F.sum("score") / F.sum("n")).alias("silhouette")), model)
        .join(segment_contrast(stats, model), model)
        .drop("clusters", "rows").withColumn("silhouette_metric", F.lit(SILHOUETTE))
    )


def model_metrics(points: DataFrame, models: dict) -> DataFrame:
    return metrics_of(_long(points, models))


def fixed_models(scaled: DataFrame, models: dict) -> DataFrame:
    """Rows for ``metrics_of`` from given centres: {(algorithm, k): centres}, labels by distance."""
    points = weighted_points(scaled)
    for (algorithm, k), centres in models.items():
        points = nearest_centroid(points, centres).withColumnRenamed(
            "cluster", _label_name(algorithm, k)).drop("squared_distance")
    return points.select(*Z, "w", "dwell_hours", "cost", F.inline(F.array(*[
        _placed(a, k, F.col(_label_name(a, k)), centres) for (a, k), centres in models.items()])))


def fit_facts(result: Sweep, tolerance: float = 0.01) -> DataFrame:
    """What holds for any good fit, for each model (one row).

    ``rows`` labelled and ``segments`` found; ``nearest``: no row of a k-means model
    lies nearer to another centre; ``settled``: one more step of moving centres to
    their means lowers the inertia by less than ``tolerance`` of it; ``falls``: the
    inertia is not above that of fewer segments.
    """
    points = weighted_points(result.scaled) if result.points is None else result.points
    long = _long(points, result.models)
    model = ["algorithm", "k"]
    w = F.col("w")
    by_cluster = long.groupBy(*model, "cluster").agg(
        F.sum("w").alias("n"), F.sum(w * F.col("own") * F.col("own")).alias("now"),
        F.sum(F.when(F.col("other") < F.col("own") - 1e-9, w).otherwise(0)).alias("nearer"),
        F.sum(w * sum((F.col(c) * F.col(c) for c in Z[1:]), F.col(Z[0]) * F.col(Z[0]))).alias("ss"),
        *[F.sum(w * F.col(c)).alias(f"sum_{c}") for c in Z])
    rows = by_cluster.groupBy(*model).agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("segments"), F.sum("nearer").alias("nearer"),
        F.sum("now").alias("now"), F.sum(F.col("ss") - _spread(Z)).alias("then"))
    fewer = F.lag("then").over(Window.partitionBy("algorithm").orderBy("k"))
    return rows.select(
        *model, "rows", "segments",
        (F.when(F.col("algorithm") == "KMeans", F.col("nearer") == 0).otherwise(True)).cast("int").alias("nearest"),
        (F.col("now") - F.col("then") <= tolerance * F.col("now")).cast("int").alias("settled"),
        F.coalesce(F.col("then") <= fewer, F.lit(True)).cast("int").alias("falls"))


def segment_contrast(stats: DataFrame, model: Sequence[str]) -> DataFrame:
    """Smallest relative gap of mean dwell and largest revenue share per model."""
    by_dwell = Window.partitionBy(*model).orderBy("mean")
    mean = stats.withColumn("mean", F.col("dwell") / F.col("n"))
    gap = F.try_divide(F.col("mean") - F.lag("mean").over(by_dwell), F.col("mean"))
    return mean.withColumn("gap", gap).groupBy(*model).agg(
        F.min("gap").alias("min_dwell_gap"),
        F.try_divide(F.max("cost"), F.sum("cost")).alias("max_revenue_share"))


def elbow_curve(metrics: DataFrame) -> DataFrame:
    """Inertia and silhouette over k."""
    return metrics.select("algorithm", "k", "inertia", "silhouette")


def select_best(
    metrics: DataFrame, min_pct: float | None = None, max_pct: float | None = None,
    max_k: int = MAX_SELECTABLE_K, tie_margin: float | None = None, strict: bool = False,
) -> DataFrame:
    """The model to use (one row) and the rule that picked it.

    Highest silhouette among models with acceptable segment sizes; failing
    that, few segments with looser sizes; failing that, four segments; failing
    that, the highest silhouette. ``tie_margin`` prefers fewer segments among
    near-equal scores; ``strict`` wants segments of 5 to 40 % of the rows (else 3 to 55)
    and also rejects neighbours with mean dwell within a tenth of each other, or one segment
    that earns most of the revenue.
    """
    min_pct = (5 if strict else 3) if min_pct is None else min_pct
    max_pct = (40 if strict else 55) if max_pct is None else max_pct
    sizes_ok = (F.col("min_pct") >= min_pct) & (F.col("max_pct") <= max_pct)
    if strict:
        sizes_ok = sizes_ok & (F.coalesce("min_dwell_gap", F.lit(1.0)) > 0.10) & (
            F.coalesce("max_revenue_share", F.lit(0.0)) <= 0.60)
    few_ok = (F.col("min_pct") >= 2) & (F.col("max_pct") <= 65) & (F.col("k") <= 5)
    rule = (F.when(sizes_ok, 1).when(few_ok, 2).when(F.col("k") == 4, 3).otherwise(4))
    # Ranked as reported, to four decimals, so that ties resolve by fewer segments.
    ranked = metrics.where(F.col("k") <= max_k).withColumns({
        "rule": rule, "silhouette": F.round("silhouette", 4)})
    preferred = F.when(F.col("algorithm") == "KMeans", 0).otherwise(1)
    order = [F.desc("silhouette"), F.asc("k"), preferred]
    if tie_margin is not None:
        top = F.max("silhouette").over(Window.partitionBy("rule"))  # a few dozen rows
        ranked = ranked.withColumn("near_top", F.col("silhouette") >= top - tie_margin)
        order = [F.desc("near_top"), F.asc(F.when(F.col("near_top"), F.col("k"))), *order]
    return (
        ranked.orderBy("rule", *order).limit(1)
        .withColumn("quality", bands.silhouette_quality(F.col("silhouette")))
        .withColumn("warning", F.when(F.col("rule") > 1, F.when(
            F.col("rule") == 2, "size checks failed; fewer segments preferred")
            .when(F.col("rule") == 3, "forced four segments")
            .otherwise("no model passed the size checks")))
    )


# --- describing segments ------------------------------------------------------

def dominant_values(labelled: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent value per segment and column, with its count."""
    pairs = F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
        for c in columns]))
    top = Window.partitionBy("cluster", "column").orderBy(F.desc("rows"), F.asc("value"))
    return (
        labelled.select("cluster", pairs).where(F.col("value").isNotNull())
        .groupBy("cluster", "column", "value").agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("_n", F.row_number().over(top)).where(F.col("_n") == 1).drop("_n")
    )


def segment_profiles(labelled: DataFrame, places: bool = True) -> DataFrame:
    """Size, dwell, TEU, cost, dominant categories and overstay share per segment.

    Labels, and the features read here, are written once and read three times: for
    the sums, the medians and the dominant values.
    """
    r = (lambda c, n: F.round(c, n)) if places else (lambda c, n: c)
    n = F.count(F.lit(1))
    described = [c for c in ("movement_type", "container_type", "flow_path")
                 if c in labelled.columns]
    labelled = cut_lineage(labelled.select("cluster", *[c for c in (
        "gate_in_time", "gate_out_time", "dwell_days", "teu_equivalent", "storage_cost_usd", "is_overstay",
        "container_type", "movement_type", "flow_path") if c in labelled.columns]))
    base = labelled.groupBy("cluster").agg(
        n.alias("count"),
        mean_days(dwell_micros()).alias("mean_dwell_days"),
        (F.sum("teu_equivalent") / n).alias("mean_teu"),
        mean_money(F.col("storage_cost_usd")).alias("mean_storage_cost"),
        (F.sum("is_overstay") / n * 100).alias("overstay_pct"),
        F.sum("teu_equivalent").alias("teu"),
        sum_money(F.col("storage_cost_usd")).alias("revenue"),
        (F.count_if(F.col("container_type") == "empty") / n).alias("empty_share"),
        (F.count_if(F.col("container_type") == "reefer") / n).alias("reefer_share"))
    medians = quantiles_wide(labelled, "dwell_days", {"median_dwell_days": 0.5}, ["cluster"])
    value = lambda c: F.max(F.when(F.col("column") == c, F.col("value")))
    rows = lambda c: F.max(F.when(F.col("column") == c, F.col("rows")))
    top = dominant_values(labelled, described).groupBy("cluster").agg(
        value("movement_type").alias("dominant_movement"),
        rows("movement_type").alias("_movement"),
        value("container_type").alias("dominant_container_type"),
        rows("container_type").alias("_type"),
        value("flow_path").alias("dominant_flow_path"))
    whole = Window.partitionBy(F.lit(0))  # one row per segment
    return base.join(medians, "cluster").join(top, "cluster", "left").select(
        "cluster", "count",
        r(F.col("mean_dwell_days"), 2).alias("mean_dwell_days"),
        r(F.col("median_dwell_days"), 2).alias("median_dwell_days"),
        r(F.col("mean_teu"), 2).alias("mean_teu"),
        r(F.col("mean_storage_cost"), 2).alias("mean_storage_cost"),
        "dominant_movement",
        r(F.col("_movement") / F.col("count") * 100, 1).alias("movement_pct"),
        "dominant_container_type",
        r(F.col("_type") / F.col("count") * 100, 1).alias("container_type_pct"),
        "dominant_flow_path",
        r(F.col("overstay_pct"), 1).alias("overstay_pct"),
        (F.col("teu") / F.sum("teu").over(whole) * 100).alias("teu_share_pct"),
        F.try_divide(F.col("revenue") * 100, F.sum("revenue").over(whole)).alias("revenue_share_pct"),
        "empty_share", "reefer_share")


def segment_labels(profiles: DataFrame, suffixes: bool = False) -> DataFrame:
    """Readable, distinct names for the segments.

    Segments that share an archetype are told apart by container size and, in
    groups of three or more, by their dwell rank. ``suffixes`` marks segments
    that are mostly empties or largely reefers.
    """
    base = bands.archetype(F.col("mean_dwell_days"))
    group = Window.partitionBy("base_label")
    size = F.when(F.coalesce("mean_teu", F.lit(1.5)) < 1.5, "20ft").otherwise("40ft")
    rank, count = F.col("_rank"), F.col("_count")
    tail = (F.when((count < 3) | (rank == 1), ")")
            .when(rank == count, ", longest dwell)").otherwise(", mid-range)"))
    label = F.when(count == 1, F.col("base_label")).otherwise(
        F.concat("base_label", F.lit(" ("), size, tail))
    if suffixes:
        label = F.concat(
            label,
            F.when(F.col("empty_share") > 0.6, " (Empties)").otherwise(""),
            F.when(F.col("reefer_share") > 0.4, " (Reefers)").otherwise(""))
    return (
        profiles.withColumn("base_label", base)
        .withColumns({
            "_count": F.count(F.lit(1)).over(group),
            "_rank": F.row_number().over(group.orderBy("mean_dwell_days", "cluster"))})
        .withColumns({"label": label, "colour": bands.archetype_colour(F.col("base_label"))})
        .drop("_count", "_rank")
    )


def recommendations(labelled_profiles: DataFrame, impact: DataFrame | None = None) -> DataFrame:
    """Advice per segment, longest dwell first (or highest opportunity cost)."""
    note = F.when(F.coalesce("mean_teu", F.lit(1.5)) >= 1.5, bands.FORTY_FOOT_NOTE).otherwise("")
    out = labelled_profiles.select(
        "cluster", "label", "count", "mean_dwell_days", "mean_teu",
        F.concat(bands.recommendation(F.col("label")), note).alias("recommendation"))
    if impact is None:
        return out.orderBy(F.desc("mean_dwell_days"), "cluster")
    return (out.join(impact.select("cluster", "opportunity_cost"), "cluster")
            .orderBy(F.desc("opportunity_cost"), "cluster"))


def centroid_comparison(labelled: DataFrame) -> DataFrame:
    """Mean standardised value of every feature per segment, long form."""
    means = labelled.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in Z])
    return means.select("cluster", F.inline(F.array(*[
        F.struct(F.lit(name).alias("feature"), F.col(c).alias("mean_z"))
        for name, c in zip(INPUTS, Z)])))


def radar_profile(profiles: DataFrame) -> DataFrame:
    """Segment metrics scaled to 0..1 over the segments, long form."""
    whole = Window.partitionBy("metric")
    metrics = ["mean_dwell_days", "mean_teu", "mean_storage_cost", "count"]
    long = profiles.select("cluster", F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
        for m in metrics])))
    lo, hi = F.min("value").over(whole), F.max("value").over(whole)
    return long.select("cluster", "metric", F.coalesce(
        F.try_divide(F.col("value") - lo, hi - lo), F.lit(0.0)).alias("scaled"))


# --- revenue by segment -------------------------------------------------------

def revenue_by_segment(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("visits"),
        F.coalesce(sum_money(F.col("storage_cost_usd")), F.lit(0.0)).alias("revenue"))


def join_labels(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Visits with separately stored labels, one label per visit."""
    return features.join(labels.select("visit_id", "cluster"), "visit_id")


def revenue_by_container_segment(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Revenue by segment when labels are matched by container id.

    Repeat visits of a container then count once per label row of that
    container. Both sides are reduced per container first, so the matching
    rows of a frequent container are multiplied as numbers, never as rows.
    """
    money = features.groupBy("container_id").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(
            F.sum(cents(F.col("storage_cost_usd"))), F.lit(0)).alias("cents"))
    counts = labels.groupBy("container_id", "cluster").agg(F.count(F.lit(1)).alias("m"))
    return money.join(counts, "container_id").groupBy("cluster").agg(
        F.sum(F.col("n") * F.col("m")).alias("visits"),
        (F.sum(F.col("cents") * F.col("m")) / 100.0).alias("revenue"))
