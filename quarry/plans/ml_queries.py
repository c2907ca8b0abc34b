"""Registered queries: sampling, features, regression, clustering, trees."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from quarry.operators import clusters as C
from quarry.operators import features as FE
from quarry.operators import linear as L
from quarry.operators import sampling as SA
from quarry.operators import series as S
from quarry.operators import trees as TR
from quarry.session import local_frame, persisted, remove_shared, shared_path
from quarry.sources.tables import spread
from quarry.sources.standins import (COVER_NAMES, COVER_NOMINAL, EVENT_SLOTS, PARTICLE_FEATURES, REGRESSION_INPUTS,
                                     REGRESSION_TARGETS, cover_features, cover_table, event_series_nested,
                                     particle_table, regression_table)

DEC = 6
COVER_CLASS = 2          # the class made positive, as in the reference
SAMPLE_FRACTION = 0.1
SPLIT_WEIGHTS = (0.7, 0.3)
# k-means parameters of the reference
K, RUNS, KMEANS_SEED, CONVERGE = 5, 25, 60295531, 0.1
MAX_ITER = 100
ROWS_PER_TASK = 1_000_000   # of the learners: a block that they keep stays below 0.2 GB
SWEEP_PARALLELISM = 3    # depths fitted at once; each fit of the stand-in is small
RULE_YEAR = 1997
MODEL_GRID = ((3, 0.5), (6, 0.3), (6, 0.5))
TARGET_ERROR = 0.2745    # the error below which the reference stops searching
DERIVE_PAIR = ("click", "view")        # stand-ins for the two temperature series
CONCAT_MEASUREMENTS = ("click", "view", "purchase")


def r(c, d=DEC):
    return F.round(c, d)


# ---- sampling ----------------------------------------------------------------

def q_sample_fraction(spark, sf_dir):
    p = particle_table(spark, sf_dir)
    return SA.sample_fraction(p, "key", SAMPLE_FRACTION).select("key")


def q_split_70_30(spark, sf_dir):
    c = cover_table(spark, sf_dir)
    return SA.split_by_weights(c, "vec_id", SPLIT_WEIGHTS).select("vec_id", "split")


def q_split_half(spark, sf_dir):
    return SA.split_half(regression_table(spark, sf_dir), "key").select("key", "split")


def q_mask_split(spark, sf_dir):
    d = SA.split_half(regression_table(spark, sf_dir), "key")
    train, test = SA.mask_split(d)
    return (train.agg(F.count(F.lit(1)).alias("n")).withColumn("split", F.lit("train"))
            .unionByName(test.agg(F.count(F.lit(1)).alias("n")).withColumn("split", F.lit("test"))))


# ---- features ------------------------------------------------------------------

def q_binarize_class(spark, sf_dir):
    c = cover_table(spark, sf_dir)
    return c.select("vec_id", FE.binarize_class(F.col("label"), COVER_CLASS).alias("label"))


def q_binarize_threshold(spark, sf_dir):
    p = particle_table(spark, sf_dir)
    return p.select("key", FE.binarize_threshold(F.col("label"), 0.5).alias("label"))


def q_decode_class(spark, sf_dir):
    c = cover_table(spark, sf_dir)
    return FE.decode_class(c.select("vec_id", "label"), "label", FE.class_lookup(spark))


def q_class_distribution(spark, sf_dir):
    return FE.class_distribution(cover_table(spark, sf_dir), "label", DEC)


def q_first_rows(spark, sf_dir):
    """A look at the first two rows (by key) of the class table."""
    return cover_table(spark, sf_dir).select("vec_id", "label").orderBy("vec_id").limit(2)


def q_to_labeled_last(spark, sf_dir):
    c = cover_table(spark, sf_dir)
    lab = c.select("vec_id", F.col("label").cast("double").alias("label"), array_to_vector("embedding").alias("features"))
    return lab.select("vec_id", "label", vector_to_array("features").alias("features"))


def q_to_labeled_first(spark, sf_dir):
    p = particle_table(spark, sf_dir)
    lab = FE.to_labeled(p, F.col("label"), PARTICLE_FEATURES)
    return lab.select("key", "label", vector_to_array("features").alias("features"))


def q_split_array_column(spark, sf_dir):
    c = cover_table(spark, sf_dir).select("vec_id", "embedding")
    return FE.split_array_column(c, "embedding", 64, "e")


def q_slice_columns(spark, sf_dir):
    return FE.slice_columns(regression_table(spark, sf_dir), ["key"] + REGRESSION_INPUTS)


def _series(spark, sf_dir):
    s = S.flatten_series(event_series_nested(spark, sf_dir))
    return s.where(F.size("values") == EVENT_SLOTS)


def q_concat_vectors(spark, sf_dir):
    s = _series(spark, sf_dir)
    wide = s.groupBy("station", "year").pivot("measurement", list(CONCAT_MEASUREMENTS)).agg(F.first("values"))
    v = FE.concat_vectors(*CONCAT_MEASUREMENTS)
    return wide.select("station", "year", F.transform(v, lambda x: r(x)).alias("vec")).where(F.col("vec").isNotNull())


def q_derive_measurements(spark, sf_dir):
    a, b = DERIVE_PAIR
    s = _series(spark, sf_dir)
    wide = s.groupBy("station", "year").pivot("measurement", [a, b]).agg(F.first("values")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull())
    avg = F.zip_with(a, b, lambda x, y: r((x + y) / 2))
    rng = F.zip_with(a, b, lambda x, y: r(x - y))
    return wide.select("station", "year", avg.alias("avg_values"), rng.alias("range_values"))


# ---- regression ---------------------------------------------------------------

def _linreg(spark, sf_dir):
    d = SA.split_half(spread(regression_table(spark, sf_dir)), "key")
    return L.linreg(spark, d, REGRESSION_INPUTS, REGRESSION_TARGETS)


SIG_DIGITS = 9


def q_linreg_gram(spark, sf_dir):
    """The data pass of the regression: every Gram sum per split.

    Sums reach ~1e15, so each is given as mantissa (9 significant digits)
    and power of ten.
    """
    d = SA.split_half(spread(regression_table(spark, sf_dir)), "key")
    g = L.gram_aggregates(d, REGRESSION_INPUTS, REGRESSION_TARGETS)
    terms = [c for c in g.columns if c != "split"]
    stacked = g.select("split", F.explode(F.array(*[
        F.struct(F.lit(t).alias("term"), F.col(t).alias("v")) for t in terms])).alias("e"))
    v = F.col("e.v")
    expo = F.when(v != 0, F.floor(F.log10(F.abs(v)))).otherwise(F.lit(0)).cast("int")
    return stacked.select("split", F.col("e.term").alias("term"), expo.alias("exponent"),
                          F.round(v / F.pow(F.lit(10.0), expo), SIG_DIGITS - 1).alias("mantissa"))


COEF_DEC = 4     # the intercepts are about 40,000


def q_linreg_fit(spark, sf_dir):
    return _linreg(spark, sf_dir)["coefficients"].select("target", "feature", r(F.col("coef"), COEF_DEC).alias("coef"))


def q_linreg_score(spark, sf_dir):
    s = _linreg(spark, sf_dir)["scores"]
    return s.select("target", *[r(F.col(c)).alias(c) for c in ("r2_train", "r2_test")])


def q_linreg_ablation(spark, sf_dir):
    a = _linreg(spark, sf_dir)["ablation"]
    return a.select("target", "removed", *[r(F.col(c)).alias(c) for c in ("drop_train", "drop_test")])


# ---- clustering ---------------------------------------------------------------

def _points(spark, sf_dir):
    return cover_table(spark, sf_dir).select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))


def _seeds(spark, sf_dir):
    return C.kmeanspp_seed(_points(spark, sf_dir), K, RUNS, KMEANS_SEED)


def q_kmeanspp_seed(spark, sf_dir):
    centres, ids = _seeds(spark, sf_dir)
    return C.seeds_frame(spark, ids, centres).select("run", "j", F.col("id").alias("vec_id"))


def q_index_to_point(spark, sf_dir):
    centres, ids = _seeds(spark, sf_dir)
    return C.seeds_frame(spark, ids, centres).select(
        "run", "j", F.col("id").alias("vec_id"), F.transform("center", lambda x: r(x)).alias("center"))


def q_nearest_center(spark, sf_dir):
    centres, _ = _seeds(spark, sf_dir)
    a = C.kmeans_assign(_points(spark, sf_dir), centres)
    return a.select(F.col("id").alias("vec_id"), F.posexplode(F.arrays_zip(F.col("labels").alias("j"), F.col("d2"))).alias("run", "near")).select(
        "vec_id", "run", F.col("near.j").alias("j"), r(F.col("near.d2")).alias("d2"))


def q_center_update(spark, sf_dir):
    centres, _ = _seeds(spark, sf_dir)
    u = C.lloyd_step(_points(spark, sf_dir), centres)
    return u.select("run", "j", "n", F.transform("center", lambda x: r(x)).alias("center"))


def q_potential_sum(spark, sf_dir):
    centres, _ = _seeds(spark, sf_dir)
    p = C.potential(_points(spark, sf_dir), centres)
    return p.select("run", r(F.col("potential")).alias("potential"))


def q_seed_signature_entropy(spark, sf_dir):
    """``signature_entropy`` of the labels given by the seeded centres."""
    centres, _ = _seeds(spark, sf_dir)
    lab = C.kmeans_assign(_points(spark, sf_dir), centres)
    e = C.signature_entropy(lab, RUNS)
    return e.select("i", r(F.col("entropy")).alias("entropy"), r(F.col("effective")).alias("effective"))


def q_seed_cost_summary(spark, sf_dir):
    """``cost_summary`` of the seeding's per-run potentials."""
    centres, _ = _seeds(spark, sf_dir)
    pot = C.potential(_points(spark, sf_dir), centres).withColumnRenamed("potential", "cost")
    s = C.cost_summary(pot)
    return s.select(*[r(F.col(c)).alias(c) for c in ("log2_max", "log2_min", "log2_mean")], "best_run")


def _kmeans(spark, sf_dir):
    res = C.kmeans_multi(_points(spark, sf_dir), K, RUNS, KMEANS_SEED, CONVERGE, MAX_ITER)
    if not res["converged"]:
        raise RuntimeError(f"k-means has not converged after {MAX_ITER} steps")
    return res


def q_kmeans_multi(spark, sf_dir):
    res = _kmeans(spark, sf_dir)
    return C.centres_frame(spark, res["centres"]).select("run", "j", F.transform("center", lambda x: r(x)).alias("center"))


def q_max_shift(spark, sf_dir):
    res = _kmeans(spark, sf_dir)
    rows = [(i + 1, round(float(s), DEC)) for i, s in enumerate(res["shifts"])]
    return local_frame(spark, rows, "iteration int, max_shift double")


def _labels(spark, sf_dir):
    res = _kmeans(spark, sf_dir)
    return res, C.kmeans_assign(_points(spark, sf_dir), res["centres"])


def q_kmeans_assign(spark, sf_dir):
    _, lab = _labels(spark, sf_dir)
    return lab.select(F.col("id").alias("vec_id"), "labels")


def q_run_cost(spark, sf_dir):
    _, lab = _labels(spark, sf_dir)
    return C.run_cost(lab).select("run", r(F.col("cost")).alias("cost"))


def q_cost_summary(spark, sf_dir):
    _, lab = _labels(spark, sf_dir)
    s = C.cost_summary(C.run_cost(lab))
    return s.select(*[r(F.col(c)).alias(c) for c in ("log2_max", "log2_min", "log2_mean")], "best_run")


def q_signature_entropy(spark, sf_dir):
    _, lab = _labels(spark, sf_dir)
    e = C.signature_entropy(lab, RUNS)
    return e.select("i", r(F.col("entropy")).alias("entropy"), r(F.col("effective")).alias("effective"))


def q_kmeans_best(spark, sf_dir):
    res, lab = _labels(spark, sf_dir)
    best = C.kmeans_best(spark, res["centres"], C.run_cost(lab))
    return best.select("run", "j", F.transform("center", lambda x: r(x)).alias("center"))


# ---- trees ------------------------------------------------------------------------

def _cover_split(spark, sf_dir, max_rows=ROWS_PER_TASK):
    c = spread(cover_features(spark, sf_dir), max_rows=max_rows)
    d = c.select("vec_id", FE.binarize_class(F.col("label"), COVER_CLASS).alias("label"),
                 array_to_vector("features").alias("features"))
    return TR.declare_features(SA.split_by_weights(d, "vec_id", SPLIT_WEIGHTS), COVER_NAMES, COVER_NOMINAL)


def _particle_split(spark, sf_dir, weights=SPLIT_WEIGHTS, names=("train", "test"), max_rows=ROWS_PER_TASK):
    p = spread(particle_table(spark, sf_dir), max_rows=max_rows)
    lab = FE.to_labeled(p.withColumn("label", FE.binarize_threshold(F.col("label"))), F.col("label"), PARTICLE_FEATURES)
    return TR.declare_features(SA.split_by_weights(lab, "key", weights, names), PARTICLE_FEATURES)


#: Data sets and the bins of their learners, (boosting, forest), as in the reference.
TREE_DATA = {"cover": (_cover_split, 20, 10), "particle": (_particle_split, 32, 32)}


def _fit(data, learner):
    """Fit on the train rows, which are dealt out and made into vectors once and kept for the learner's passes.

    Spark ML asks for the RDD of its input several times (to log it, for the
    classes, the rows and the summaries of the fit), and each time a plan
    with a shuffle runs that again.
    """
    with persisted(data.where(F.col("split") == "train").select("label", "features")) as train:
        return TR.pipeline(learner).fit(train)


def _fit_errors(spark, sf_dir, data, learner):
    """Errors of a fitted learner. Scoring keeps no rows: a scan of enough splits is scored without a shuffle."""
    return TR.error_rates(_fit(data(spark, sf_dir), learner), data(spark, sf_dir, max_rows=None))


def _per_data_set(spark, run):
    parts = [run(name, *how).withColumn("data_set", F.lit(name)) for name, how in TREE_DATA.items()]
    return parts[0].unionByName(parts[1])


def q_gbt_train(spark, sf_dir):
    def run(_, data, bins, __):
        return _fit_errors(spark, sf_dir, data, TR.gbt(3, max_bins=bins))
    return _per_data_set(spark, run)


def q_rf_train(spark, sf_dir):
    def run(_, data, __, bins):
        return _fit_errors(spark, sf_dir, data, TR.rf(6, max_bins=bins))
    return _per_data_set(spark, run)


def q_tree_predict(spark, sf_dir):
    m = _fit(_particle_split(spark, sf_dir), TR.gbt(3))
    return m.transform(_particle_split(spark, sf_dir, max_rows=None)).select("key", "split", "label", "prediction")


def _rule_scored(spark, sf_dir):
    """Labels and the rule's predictions of one table side by side, as a model's ``transform`` has them."""
    p = SA.split_by_weights(particle_table(spark, sf_dir), "key", SPLIT_WEIGHTS)
    return p.select("key", "split", "label", (F.col("ship_year") <= RULE_YEAR).cast("double").alias("prediction"))


def q_zip_predictions(spark, sf_dir):
    """Labels and a rule's predictions of two tables paired by row key (the reference pairs them by position)."""
    c = cover_table(spark, sf_dir)
    labels = SA.split_by_weights(c, "vec_id", SPLIT_WEIGHTS).select(
        "vec_id", "split", FE.binarize_class(F.col("label"), COVER_CLASS).alias("label"))
    predictions = c.select("vec_id", (F.col("embedding")[0] > 0).cast("double").alias("prediction"))
    return FE.pair_predictions(labels, predictions, "vec_id")


def q_error_rate(spark, sf_dir):
    e = TR.prediction_errors(_rule_scored(spark, sf_dir))
    return e.select("split", r(F.col("error")).alias("error"), "n")


def q_mismatched(spark, sf_dir):
    return TR.mismatched(_rule_scored(spark, sf_dir)).groupBy("split").agg(F.count(F.lit(1)).alias("n_mismatched"))


def _sweep(spark, sf_dir):
    """Both learners' sweeps over both data sets, each over one persisted split.

    The forest comes first and alone: while it is fitted, the driver holds its nodes.
    """
    def run(_, data, gbt_bins, rf_bins):
        with persisted(data(spark, sf_dir)) as d:
            f = TR.depth_sweep(spark, d, "rf", TR.RF_DEPTHS, persist=False, max_bins=rf_bins)
            g = TR.depth_sweep(spark, d, "gbt", TR.GBT_DEPTHS,
                               parallelism=SWEEP_PARALLELISM, persist=False, max_bins=gbt_bins)
            return g.unionByName(f)
    return _per_data_set(spark, run)


def q_depth_sweep(spark, sf_dir):
    return _sweep(spark, sf_dir).drop("seconds")


def q_curve_sorted(spark, sf_dir):
    return TR.curve_sorted(_sweep(spark, sf_dir))


def q_compare_curves(spark, sf_dir):
    return TR.compare_curves(_sweep(spark, sf_dir))


def q_select_model(spark, sf_dir):
    d = _particle_split(spark, sf_dir, (0.6, 0.2, 0.2), ("train", "validation", "test"))
    return TR.select_model(spark, d, MODEL_GRID, target_error=TARGET_ERROR)


def q_sink_model(spark, sf_dir):
    """Errors of a model after it was saved and loaded; the saved copy is removed again."""
    path = shared_path(spark, "models")
    try:
        TR.save_model(_fit(_cover_split(spark, sf_dir), TR.gbt(3, max_bins=20)), path)
        return TR.error_rates(TR.load_model(path), _cover_split(spark, sf_dir, max_rows=None))
    finally:
        remove_shared(path)


QUERIES = {
    "sample_fraction": q_sample_fraction,
    "split_70_30": q_split_70_30,
    "split_half": q_split_half,
    "mask_split": q_mask_split,
    "binarize_class": q_binarize_class,
    "binarize_threshold": q_binarize_threshold,
    "decode_class": q_decode_class,
    "class_distribution": q_class_distribution,
    "classes_sorted": q_class_distribution,
    "first_rows": q_first_rows,
    "to_labeled_last": q_to_labeled_last,
    "to_labeled_first": q_to_labeled_first,
    "split_array_column": q_split_array_column,
    "slice_columns": q_slice_columns,
    "concat_vectors": q_concat_vectors,
    "derive_measurements": q_derive_measurements,
    "linreg_gram": q_linreg_gram,
    "linreg_fit": q_linreg_fit,
    "linreg_score": q_linreg_score,
    "linreg_ablation": q_linreg_ablation,
    "kmeanspp_seed": q_kmeanspp_seed,
    "index_to_point": q_index_to_point,
    "nearest_center": q_nearest_center,
    "center_update": q_center_update,
    "potential_sum": q_potential_sum,
    "seed_signature_entropy": q_seed_signature_entropy,
    "seed_cost_summary": q_seed_cost_summary,
    "kmeans_multi": q_kmeans_multi,
    "max_shift": q_max_shift,
    "kmeans_assign": q_kmeans_assign,
    "run_cost": q_run_cost,
    "cost_summary": q_cost_summary,
    "signature_entropy": q_signature_entropy,
    "kmeans_best": q_kmeans_best,
    "gbt_train": q_gbt_train,
    "rf_train": q_rf_train,
    "tree_predict": q_tree_predict,
    "zip_predictions": q_zip_predictions,
    "error_rate": q_error_rate,
    "mismatched": q_mismatched,
    "depth_sweep": q_depth_sweep,
    "curve_sorted": q_curve_sorted,
    "compare_curves": q_compare_curves,
    "select_model": q_select_model,
    "sink_model": q_sink_model,
}
