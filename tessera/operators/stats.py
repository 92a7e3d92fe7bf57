"""Counts, reports, weights, histograms and checks over annotation tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tessera.functions.polygons import let
from tessera.operators.grouping import bounded_rows, broadcast_if_small
from tessera.operators.ordering import running
from tessera.operators.shapes import clip_boxes

EPSILON = 1e-7  # fixed value: guards the micro scores against a zero denominator


# ---------------------------------------------------------------- counts


def class_repartition(annotations: DataFrame, categories: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Objects per class, 0 for classes without objects; ``by`` adds grouping columns such as the split."""
    by = list(by)
    counts = annotations.groupBy(*by, "category_id").agg(F.count(F.lit(1)).alias("n"))
    names = categories.select("category_id", F.col("name").alias("label"))
    if by:
        listed = bounded_rows(names, "categories")
        every = F.array(*[F.struct(F.lit(r["category_id"]).alias("category_id"), F.lit(r["label"]).alias("label")) for r in listed])
        names = counts.select(*by).distinct().select(*by, F.explode(every).alias("_c")).select(*by, "_c.*")
    return names.join(counts, [*by, "category_id"], "left").select(
        *by, "category_id", "label", F.coalesce("n", F.lit(0)).alias("n")
    )


def require_known_labels(annotations: DataFrame, categories: DataFrame) -> None:
    """The strict variant: an annotation whose class is not in the label map is an error."""
    stray = annotations.join(broadcast_if_small(categories.select("category_id")), "category_id", "left_anti")
    if not stray.isEmpty():
        raise ValueError("annotations use a class that the label map does not have")


# ---------------------------------------------------------------- classification


def confusion_counts(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("true_class", "pred_class").agg(F.count(F.lit(1)).alias("n"))


def confusion_grid(pairs: DataFrame) -> DataFrame:
    """Full square confusion matrix as rows, zeros included."""
    counts = confusion_counts(pairs)
    classes = counts.select(F.explode(F.array("true_class", "pred_class")).alias("c")).distinct()
    listed = [r["c"] for r in bounded_rows(classes.orderBy("c"), "classes", 1000)]
    axis = F.array(*[F.lit(c) for c in listed])
    grid = classes.select(F.col("c").alias("true_class"), F.explode(axis).alias("pred_class"))
    return grid.join(counts, ["true_class", "pred_class"], "left").select(
        "true_class", "pred_class", F.coalesce("n", F.lit(0)).alias("n")
    )


def class_scores(pairs: DataFrame) -> DataFrame:
    """Precision, recall and F1 per class, 0 where undefined."""
    t, p, n = F.col("true_class"), F.col("pred_class"), F.col("n")
    sides = F.array(
        F.struct(t.alias("c"), F.when(t == p, n).otherwise(0).alias("hit"), n.alias("true_n"), F.lit(0).cast("long").alias("pred_n")),
        F.struct(p.alias("c"), F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("true_n"), n.alias("pred_n")),
    )
    sums = (
        confusion_counts(pairs)
        .select(F.explode(sides).alias("_s"))
        .groupBy(F.col("_s.c").alias("class"))
        .agg(*[F.sum(f"_s.{c}").alias(c) for c in ("hit", "true_n", "pred_n")])
    )
    hit = F.col("hit").cast("double")
    zero = F.lit(0.0)
    return sums.select(
        "class",
        F.coalesce(F.try_divide(hit, F.col("pred_n")), zero).alias("precision"),
        F.coalesce(F.try_divide(hit, F.col("true_n")), zero).alias("recall"),
        F.coalesce(F.try_divide(2 * hit, F.col("pred_n") + F.col("true_n")), zero).alias("f1"),
        F.col("true_n").alias("support"),
        F.col("hit"),
    )


def classification_report(pairs: DataFrame) -> DataFrame:
    """Accuracy and macro precision, recall and F1 in one row."""
    return class_scores(pairs).agg(
        (F.sum("hit") / F.sum("support")).alias("accuracy"),
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
    )


def micro_scores(values: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and F1 from rounded, clipped products of target and score."""

    def count(c: Column) -> Column:
        return F.sum(F.rint(F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))))

    y, p = F.col("target"), F.col("score")
    sums = values.groupBy(*by).agg(count(y * p).alias("_tp"), count(y).alias("_pos"), count(p).alias("_pred"))
    scored = sums.withColumn("precision", F.col("_tp") / (F.col("_pred") + EPSILON)).withColumn(
        "recall", F.col("_tp") / (F.col("_pos") + EPSILON)
    )
    pr, rc = F.col("precision"), F.col("recall")
    return scored.select(*by, "precision", "recall", (2 * ((pr * rc) / (pr + rc + EPSILON))).alias("f1"))


# ---------------------------------------------------------------- weights


def class_weights(labels: DataFrame, categories: DataFrame | None = None, class_ap: DataFrame | None = None) -> DataFrame:
    """Class weights.

    Without ``categories``: balanced weights n / (k * count) over the classes
    present.  With them: normalised inverse frequency times the number of
    classes (an absent class counts once), and with ``class_ap`` multiplied by
    (1 - ap)^2 / number of classes.
    """
    counts = labels.groupBy("category_id").agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy()  # one row per class
    if categories is None:
        return counts.select(
            "category_id",
            "n",
            (F.sum("n").over(every) / (F.count(F.lit(1)).over(every) * F.col("n"))).alias("weight"),
        )
    bounded_rows(categories, "categories")
    padded = categories.select("category_id").join(counts, "category_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    inverse = 1 / F.greatest(F.col("n"), F.lit(1))
    size = F.count(F.lit(1)).over(every)
    weighted = padded.select("category_id", "n", (inverse / F.sum(inverse).over(every) * size).alias("weight"), size.alias("_k"))
    if class_ap is not None:
        weighted = weighted.join(class_ap, "category_id", "left").withColumn(
            "weight", F.col("weight") * F.pow(1 - F.coalesce("ap", F.lit(0.0)), 2) / F.col("_k")
        )
    return weighted.select("category_id", "n", "weight")


def image_weights(annotations: DataFrame, weights: DataFrame) -> DataFrame:
    """Sum of class weights over the objects of each image.

    Objects are counted per image and class first, so a crowded image shuffles
    one row per class.
    """
    counts = annotations.groupBy("image_id", "category_id").agg(F.count(F.lit(1)).alias("_n"))
    joined = counts.join(broadcast_if_small(weights.select("category_id", "weight")), "category_id")
    return joined.groupBy("image_id").agg(F.sum(F.col("_n") * F.col("weight")).alias("weight"))


# ---------------------------------------------------------------- histograms


def value_ranges(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    row = df.agg(*[f(c).cast("double").alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]).first()
    return {c: (row[f"lo_{c}"], row[f"hi_{c}"]) for c in columns}


def bin_index(value: Column, low: float, high: float, bins: int) -> Column:
    """0-based bin of equal width; the top edge belongs to the last bin."""
    if high <= low:
        return F.lit(0)
    raw = F.floor((value - low) / (high - low) * bins).cast("int")
    return F.least(F.greatest(raw, F.lit(0)), F.lit(bins - 1))


def histograms(df: DataFrame, columns: Sequence[str], bins: int) -> DataFrame:
    """(variable, bin, n) for several columns in one pass after their ranges."""
    ranges = value_ranges(df, columns)
    cells = F.array(
        *[F.struct(F.lit(c).alias("variable"), bin_index(F.col(c), *ranges[c], bins).alias("bin")) for c in columns]
    )
    return df.select(F.explode(cells).alias("_c")).groupBy("_c.variable", "_c.bin").agg(F.count(F.lit(1)).alias("n"))


def histogram_2d(df: DataFrame, x: str, y: str, bins: int) -> DataFrame:
    ranges = value_ranges(df, [x, y])
    return df.groupBy(
        bin_index(F.col(x), *ranges[x], bins).alias("bin_x"), bin_index(F.col(y), *ranges[y], bins).alias("bin_y")
    ).agg(F.count(F.lit(1)).alias("n"))


def log_density(df: DataFrame, x: str, y: str, edges: int = 100) -> DataFrame:
    """Rows with the log count of their 2-D histogram cell; ``edges`` edges make one bin fewer per axis."""
    bins = edges - 1
    ranges = value_ranges(df, [x, y])
    binned = df.withColumn("bin_x", bin_index(F.col(x), *ranges[x], bins)).withColumn(
        "bin_y", bin_index(F.col(y), *ranges[y], bins)
    )
    cells = binned.groupBy("bin_x", "bin_y").agg(F.log(F.count(F.lit(1))).alias("log_density"))
    return binned.join(F.broadcast(cells), ["bin_x", "bin_y"]).drop("bin_x", "bin_y")  # at most bins^2 cells


def target_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(variable, mean, std) with the population deviation."""
    one = df.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("mean", F.avg), ("std", F.stddev_pop))])
    rows = F.array(
        *[F.struct(F.lit(c).alias("variable"), F.col(f"mean_{c}").alias("mean"), F.col(f"std_{c}").alias("std")) for c in columns]
    )
    return one.select(F.explode(rows).alias("_r")).select("_r.*")


# ---------------------------------------------------------------- meters


def _middle(values: str) -> Column:
    """Median of a short array: the middle value, or the mean of the two middle ones."""

    def pick(v: Column) -> Column:
        n = F.size(v)
        low, high = F.floor((n + 1) / 2).cast("int"), (F.floor(n / 2) + 1).cast("int")
        return (F.element_at(v, low) + F.element_at(v, high)) / 2

    return let(F.array_sort(values), pick)


def rolling_meters(values: DataFrame, window: int, keys: Sequence[str], order: Sequence[str], name_filter: str | None = None) -> DataFrame:
    """Mean and median of the last ``window`` values, latest, running total and global mean per series.

    The window is a fixed number of rows, so a series is cut into blocks of
    consecutive rows that carry the last ``window`` - 1 rows of the block
    before; a single long series still runs in many tasks.
    """
    keys, order = list(keys), list(order)
    if name_filter is not None:
        values = values.filter(F.col("name").contains(name_filter))
    totals = running(
        values.select(*dict.fromkeys([*keys, *order, "value"])),
        keys,
        order,
        sums={"total": F.col("value"), "seen": F.lit(1).cast("long")},
        name="meters",
    )
    block = max(4096, 16 * window)
    no = F.floor((F.col("seen") - 1) / block)
    # the last window-1 rows of a block are also needed by the next block
    offset = F.pmod(F.col("seen") - 1, F.lit(block))
    homes = F.array(F.struct(no.alias("block"), F.lit(True).alias("home")))
    lent = F.when(offset >= block - (window - 1), F.array(F.struct((no + 1).alias("block"), F.lit(False).alias("home")))).otherwise(
        F.array().cast("array<struct<block:bigint,home:boolean>>")
    )
    spread = totals.select("*", F.explode(F.concat(homes, lent)).alias("_b")).select("*", "_b.*").drop("_b")
    recent = Window.partitionBy(*keys, "block").orderBy("seen").rowsBetween(-(window - 1), 0)
    return (
        spread.withColumn("avg", F.avg("value").over(recent))
        .withColumn("_recent", F.collect_list("value").over(recent))  # at most ``window`` values
        .filter("home")
        .withColumn("median", _middle("_recent"))
        .select(
            *keys,
            *[c for c in order if c not in keys],
            "avg",
            "median",
            F.col("value").alias("latest"),
            "total",
            (F.col("total") / F.greatest(F.col("seen").cast("double"), F.lit(1e-5))).alias("global_avg"),
        )
    )


def best_epoch(results: DataFrame, keys: Sequence[str], epoch: str = "epoch", fitness: str = "fitness") -> DataFrame:
    """Each epoch with the best fitness so far and the epoch that set it (the first on a tie)."""
    keys = list(keys)
    best = running(
        results,
        keys,
        [epoch],
        maxima={"_best": F.struct(F.col(fitness).alias("f"), (-F.col(epoch)).alias("neg"))},
        name="best-epoch",
    )
    return best.select(
        *results.columns, F.col("_best.f").alias("best_fitness"), (-F.col("_best.neg")).alias("best_epoch")
    )


def best_row(results: DataFrame, keys: Sequence[str], epoch: str = "epoch", fitness: str = "fitness") -> DataFrame:
    """The whole row of the best epoch per run."""
    order = F.struct(F.col(fitness), (-F.col(epoch)).alias("neg"))
    return results.groupBy(*keys).agg(F.max_by(F.struct(*results.columns), order).alias("_r")).select("_r.*")


# ---------------------------------------------------------------- job counters and checks


def job_counters(df: DataFrame, name: str, conditions: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """Count rows per condition while ``df`` is written; read ``observation.get`` after the action."""
    seen = Observation(name)
    counts = [F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in conditions.items()]]
    return df.observe(seen, *counts), seen


def validate_coco(
    images: DataFrame, annotations: DataFrame, categories: DataFrame, label: str | None = None, min_size: float = 1.0
) -> DataFrame:
    """(rule, n): number of violations of each rule, zeros included.

    Shape rules are counted in one scan of the annotations; key rules use
    anti-joins and distinct counts on the key columns only.
    """
    spark = annotations.sparkSession

    def rule(name: str, counted: DataFrame) -> DataFrame:
        return counted.select(F.lit(name).alias("rule"), F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"))

    def stray(key: str, side: DataFrame, small: bool) -> DataFrame:
        known = side.select(key)
        known = broadcast_if_small(known) if small else known
        return annotations.join(known, key, "left_anti").agg(F.count(F.lit(1)).alias("n"))

    def repeated(df: DataFrame, key: str) -> DataFrame:
        return df.groupBy(key).agg(F.count(F.lit(1)).alias("c")).agg(F.sum(F.col("c") - 1).alias("n"))

    box_bad = (F.col("w") < min_size) | (F.col("h") < min_size) | (F.col("x") < 0) | (F.col("y") < 0)
    shapes = [F.count_if(box_bad).alias("invalid_box")]
    if "segmentation" in annotations.columns:
        shapes.append(F.count_if(F.exists("segmentation", lambda p: ~polygon_is_valid(p))).alias("invalid_polygon"))
    counted = annotations.agg(*shapes)
    names = [c for c in counted.columns]
    shape_rules = counted.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("rule"), F.col(c).alias("n")) for c in names])).alias("_r")
    ).select("_r.*")
    n_classes = F.lit(len(bounded_rows(categories, "categories")))
    out = shape_rules
    for extra in (
        rule("unknown_image", stray("image_id", images, False)),
        rule("unknown_category", stray("category_id", categories, True)),
        rule("class_beyond_count", annotations.agg(F.count_if(F.col("category_id") > n_classes).alias("n"))),
        rule("duplicate_annotation_id", repeated(annotations, "ann_id")),
        rule("duplicate_image_id", repeated(images, "image_id")),
        rule("too_few_images", images.agg((F.count(F.lit(1)) < 2).cast("long").alias("n"))),
    ):
        out = out.unionByName(extra)
    if label is not None:
        out = out.unionByName(
            rule("label_absent", categories.agg((F.count_if(F.col("name") == label) == 0).cast("long").alias("n")))
        )
    return out


def polygon_is_valid(flat: Column) -> Column:
    return (F.size(flat) >= 6) & F.forall(flat, lambda v: v >= 0)


def filter_valid_shapes(annotations: DataFrame, min_size: float = 1.0) -> DataFrame:
    """Annotations with a valid box and, when they carry polygons, only valid polygons."""
    keep = (F.col("w") >= min_size) & (F.col("h") >= min_size) & (F.col("x") >= 0) & (F.col("y") >= 0)
    if "segmentation" in annotations.columns:
        keep = keep & F.forall("segmentation", polygon_is_valid)
    return annotations.filter(keep)


def repair_coco(images: DataFrame, annotations: DataFrame, categories: DataFrame, min_size: float = 1.0) -> DataFrame:
    """Annotations after the repair: boxes cut to their image, then everything still invalid or stray dropped."""
    cut = clip_boxes(annotations, images, "shift")  # also drops annotations without an image
    known = cut.join(broadcast_if_small(categories.select("category_id")), "category_id", "left_semi")
    return filter_valid_shapes(known, min_size).select(*annotations.columns)
