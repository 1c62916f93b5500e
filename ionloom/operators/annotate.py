"""Ion-variant annotation: pairs that elute together meet the rules table; classes gate each other by priority."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ionloom.functions.scalars import aligned, annotation_text
from ionloom.operators.graph import cut
from ionloom.operators.joins import dealt, first_shared, interval_join
from ionloom.schema import ISOTOPE_STEP, PROTON_ELECTRON

# Fixed values.
WATER, AMMONIA, METHANOL = 18.01056, 17.02655, 32.02566
#: Classes by priority: what an earlier one explains, a later one leaves alone.
CLASSES = ("multicharge", "dimer", "fragment", "adduct", "neutral_loss", "isotope", "analog")
#: Edges of these run from the heavier ion to the lighter one; the others the other way.
FROM_HEAVIER = ("adduct", "dimer", "isotope")
#: Rules that are broadcast.
MOST_RULES = 5000


def coeluting(clusters: DataFrame, rt_tolerance: float, bucket: float | None = None) -> DataFrame:
    """l, r: pairs of clusters with l.id < r.id in one peak and one batch.

    clusters: id, mz, rt_mean, rt_min, rt_max, blanks_total, batches, ... Without any blank: centres meet and are aligned.
    With blanks: a blank's interval doesn't count, only its centre, within 4 tolerances. Pairs meet by batch and time.
    """
    ordered = (F.col("l.id") < F.col("r.id")) & first_shared("_batch")

    def paired(rows: DataFrame, extra) -> DataFrame:
        own = dealt(rows, F.col("batches"), "_batch")
        met = interval_join(own, own, rt_tolerance, bucket, extra, ["_batch"])
        return met.select(*[F.struct(*[F.col(f"{side}.{c}") for c in rows.columns]).alias(side) for side in ("l", "r")])

    any_blank = bool(clusters.where("blanks_total > 0").limit(1).count())
    if not any_blank:
        return paired(clusters, ordered & aligned("l", "r", rt_tolerance))
    # a blank's interval is its centre, four tolerances wide, as long as the other side doesn't reach for it
    reach = clusters.withColumns({
        "_low": F.when(F.col("blanks_total") > 0, F.col("rt_mean") - 3 * rt_tolerance).otherwise(F.col("rt_min")), "_high": F.when(F.col("blanks_total") > 0, F.col("rt_mean") + 3 * rt_tolerance).otherwise(F.col("rt_max")),
    }).withColumnsRenamed({"rt_min": "own_min", "rt_max": "own_max"}).withColumnsRenamed({"_low": "rt_min", "_high": "rt_max"})
    met = paired(reach, ordered)
    c = lambda side, name: F.col(f"{side}.{name}")
    straight = F.sqrt((F.pow(c("l", "own_min") - c("r", "own_min"), 2) + F.pow(c("l", "own_max") - c("r", "own_max"), 2)) / 2) <= 2 * rt_tolerance
    near = F.abs(c("l", "rt_mean") - c("r", "rt_mean")) <= 4 * rt_tolerance
    return met.where((c("l", "blanks_total") > 0) | (c("r", "blanks_total") > 0) | near | straight)


def isotopic_evidence(pairs: DataFrame, fragment_tolerance: float, ms1: bool = False) -> DataFrame:
    """id, charge (2 or 3): the cluster has an isotope at that charge's spacing, of two thirds of its area at most.

    pairs: l and r with id, mz, area. Evidence among MS1 peaks lies above the cluster, and for charge 3 uses the isotope
    step rather than the proton's.
    """
    gap = F.abs(F.bround(F.col("l.mz") - F.col("r.mz"), 4))
    weak = F.col("r.area") <= F.col("l.area") * 2 / 3
    step = {2: PROTON_ELECTRON / 2, 3: ISOTOPE_STEP / 3 if ms1 else PROTON_ELECTRON / 3}
    found = [pairs.where((F.abs(gap - s) <= fragment_tolerance) & weak & (F.col("r.mz") > F.col("l.mz") if ms1 else F.lit(True))).select(F.col("l.id").alias("id"), F.lit(z).alias("charge")) for z, s in step.items()]
    return found[0].unionByName(found[1]).distinct()


def _with_losses(rules: DataFrame) -> DataFrame:
    """Rules, and those that allow it once more without water or ammonia: ion, mzdiff, ..."""
    plain = rules.withColumn("loss", F.lit(0.0))
    named = lambda ion, mark: F.regexp_replace(ion, r"\]", f"-{mark}]")
    water = rules.where("neutral_loss_h2o = 1").withColumn("ion", named(F.col("ion"), "H2O")).withColumn("loss", F.lit(WATER))
    ammonia = rules.where("neutral_loss_nh3 = 1").withColumn("ion", named(F.col("ion"), "NH3")).withColumn("loss", F.lit(AMMONIA))
    return plain.unionByName(water).unionByName(ammonia)


def annotated_pairs(pairs: DataFrame, rules: DataFrame, evidence: DataFrame, mz_tolerance: float, fragment_tolerance: float, ion_mode: int = 1) -> DataFrame:
    """id_a, id_b (a is the smaller id), class, ion, mz_error, sim, and the edge's src and dst.

    pairs: l and r (id, mz, area, blanks_total, strong: a peak above its own mass, peaks) and sim, trim_sim. Each pair
    keeps the annotations of its first class by priority; several rules of that class may hold. Pairs are written once;
    they meet the rules, some dozens, by buckets of the mass that a rule asks for.
    """
    if rules.limit(MOST_RULES + 1).count() > MOST_RULES:
        raise ValueError(f"the rules table is meant to hold some dozens of rules, not more than {MOST_RULES}")
    e = PROTON_ELECTRON * (1 if ion_mode == 1 else -1)
    z_sign = F.col("charge") * (1 if ion_mode == 1 else -1)
    own = rules.where(z_sign > 0).withColumn("charge", F.abs("charge"))
    p = pairs.select("l", "r", F.coalesce("sim", F.lit(0.0)).alias("sim"), F.coalesce("trim_sim", F.lit(0.0)).alias("trim_sim"))
    ends = p.select(F.when(F.col("l.mz") >= F.col("r.mz"), F.struct(F.col("l").alias("h"), F.col("r").alias("w"))).otherwise(F.struct(F.col("r").alias("h"), F.col("l").alias("w"))).alias("x"), F.col("l.id").alias("id_a"), F.col("r.id").alias("id_b"), "sim", "trim_sim")
    ends = ends.select("id_a", "id_b", F.col("x.h").alias("h"), F.col("x.w").alias("w"), "sim", "trim_sim").withColumn("gap", F.bround(F.col("h.mz") - F.col("w.mz"), 4))
    ends = cut(ends, "ends")
    width = max(mz_tolerance, 1e-4) * 2

    def met(rows: DataFrame, wanted: Column, value: Column, times: str | None = None) -> DataFrame:
        """Pairs and rules whose wanted mass lies near the pair's value; with times, one value for each of the rules' numbers there."""
        near = rows.withColumn("_cell", F.explode(F.array(*[F.floor(wanted / width) + k for k in (-1, 0, 1)])))
        own = ends
        if times:
            numbers = sorted(r[0] for r in rows.select(times).distinct().collect())  # of a bounded table
            own = own.withColumn("_times", F.explode(F.array(*[F.lit(z) for z in numbers]).cast("array<int>")))
            near = near.withColumn("_times", F.col(times))
        own = own.withColumn("_cell", F.floor(value / width))
        return own.join(F.broadcast(near), ["_cell", "_times"] if times else ["_cell"])

    def out(rows: DataFrame, kind: str, ion: Column, error: Column) -> DataFrame:
        return rows.select("id_a", "id_b", F.lit(kind).alias("class"), ion.alias("ion"), error.alias("mz_error"), "sim", F.col("h.id").alias("heavier"), F.col("w.id").alias("lighter"))

    # several charges: the lighter ion is the heavier molecule's, and shows isotopes at that spacing
    multi = met(own.where("charge > 1").select("ion", "mzdiff", "charge"), F.col("mzdiff"), F.col("w.mz") - (F.col("h.mz") - e) / F.col("_times"), "charge")
    error = F.abs((F.col("h.mz") - e) / F.col("charge") + F.col("mzdiff") - F.col("w.mz"))
    multi = multi.where(error <= mz_tolerance).join(evidence.select(F.col("id").alias("_id"), F.col("charge").alias("_z")), (F.col("w.id") == F.col("_id")) & (F.col("charge") == F.col("_z")), "left_semi")
    found = out(multi, "multicharge", F.col("ion"), error)
    # dimers and trimers: the lighter one is the monomer; nothing of the heavier one lies between, or they are alike
    times = F.regexp_extract("ion", r"^\[([23])M", 1).cast("int")
    dimers = _with_losses(own.where(F.col("ion").rlike(r"^\[[23]M"))).withColumn("times", times).select("ion", "mzdiff", "times", "loss", "sim_cutoff")
    dimers = met(dimers, F.col("mzdiff") - F.col("loss"), F.col("h.mz") - (F.col("w.mz") - e) * F.col("_times"), "times")
    error = F.abs((F.col("w.mz") - e) * F.col("times") + F.col("mzdiff") - F.col("loss") - F.col("h.mz"))
    between = F.exists("h.peaks", lambda q: ((q["mz"] > F.col("w.mz") + F.col("mzdiff") + WATER + METHANOL) & (q["mz"] < F.col("h.mz") - fragment_tolerance)) | (q["mz"] > F.col("h.mz") + fragment_tolerance))
    dimers = dimers.where((error <= mz_tolerance) & ~F.coalesce(F.col("w.strong"), F.lit(False)) & (~F.coalesce(between, F.lit(False)) | (F.col("sim") >= F.col("sim_cutoff"))))
    found = found.unionByName(out(dimers, "dimer", F.col("ion"), error))
    # fragments: the lighter mass is a peak of the heavier ion
    held = F.exists("h.peaks", lambda q: F.abs(q["mz"] - F.col("w.mz")) <= fragment_tolerance)
    fragments = ends.where(F.coalesce(held, F.lit(False)) & (F.greatest("trim_sim", "sim") >= 0.2) & (F.coalesce(F.col("h.blanks_total"), F.lit(0)) == 0) & (F.coalesce(F.col("w.blanks_total"), F.lit(0)) == 0))
    nearest = F.array_min(F.transform("h.peaks", lambda q: F.abs(q["mz"] - F.col("w.mz"))))
    found = found.unionByName(out(fragments, "fragment", F.lit("fragment"), nearest))
    # adducts and neutral losses: by the difference alone
    plain = own.where(F.col("ion").rlike(r"^\[M") & (F.col("charge") == 1))
    adducts = _with_losses(plain.where((F.col("neutral_loss") == 0) & ~F.col("ion").rlike(r"^\[M\+[0-9]+\]"))).select("ion", "mzdiff", "loss", "sim_cutoff")
    adducts = met(adducts, F.col("mzdiff") - F.col("loss"), F.col("gap") + e)
    error = F.abs(F.col("gap") + e - (F.col("mzdiff") - F.col("loss")))
    found = found.unionByName(out(adducts.where((error <= mz_tolerance) & (F.col("sim") >= F.col("sim_cutoff"))), "adduct", F.col("ion"), error))
    losses = met(own.where("neutral_loss = 1").select("ion", "mzdiff", "sim_cutoff"), F.col("mzdiff"), F.col("gap"))
    error = F.abs(F.col("gap") - F.col("mzdiff"))
    found = found.unionByName(out(losses.where((error <= mz_tolerance) & (F.col("sim") >= F.col("sim_cutoff"))), "neutral_loss", F.col("ion"), error))
    steps = F.regexp_extract("ion", r"^\[M\+([0-9]+)\]", 1)
    isotopes = met(own.where(F.col("ion").rlike(r"^\[M\+[0-9]+\]")).withColumn("steps", steps.cast("int")).select("ion", "steps", "sim_cutoff"), F.col("steps") * ISOTOPE_STEP, F.col("gap"))
    error = F.abs(F.col("gap") - ISOTOPE_STEP * F.col("steps"))
    found = found.unionByName(out(isotopes.where((error <= mz_tolerance) & (F.col("sim") >= F.col("sim_cutoff"))), "isotope", F.col("ion"), error))
    analogs = ends.where(F.col("sim") >= 0.7)
    found = found.unionByName(out(analogs, "analog", F.lit("analog"), F.lit(0.0)))
    priority = F.array_position(F.array(*[F.lit(c) for c in CLASSES]), F.col("class"))
    best = F.min(priority).over(Window.partitionBy("id_a", "id_b"))
    kept = found.withColumn("_place", priority).withColumn("_best", best).where(F.col("_place") == F.col("_best")).drop("_place", "_best")
    down = F.col("class").isin(*FROM_HEAVIER)
    return kept.withColumns({"src": F.when(down, F.col("heavier")).otherwise(F.col("lighter")), "dst": F.when(down, F.col("lighter")).otherwise(F.col("heavier"))}).drop("heavier", "lighter")


def annotation_columns(annotated: DataFrame, details: DataFrame) -> DataFrame:
    """id and, for each class, its annotations as text, joined by ';'. Each end names the other. details: id_a, id_b, rt_error, n_common."""
    own = annotated.join(details, ["id_a", "id_b"], "left").fillna(0, ["n_common"]).fillna(0.0, ["rt_error"])
    text = lambda other: annotation_text(F.col("ion"), F.col("sim"), F.col("mz_error"), F.col("rt_error"), F.col(other), F.col("n_common"))
    both = own.select(F.col("src").alias("id"), F.col("dst").alias("other"), "class", text("dst").alias("t")).unionByName(own.where("class = 'analog'").select(F.col("dst").alias("id"), F.col("src").alias("other"), "class", text("src").alias("t")))
    name = {"multicharge": "multi_charges", "dimer": "dimers", "fragment": "fragments", "adduct": "adducts", "neutral_loss": "neutral_losses", "isotope": "isotopes", "analog": "analogs"}
    held = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("class") == c, F.struct("other", "t")))), lambda x: x["t"]), ";")
    return both.groupBy("id").agg(*[F.nullif(held(c), F.lit("")).alias(n) for c, n in name.items()])


def annotation_network(annotated: DataFrame, nodes: DataFrame, details: DataFrame) -> DataFrame:
    """Directed edges src, dst, cosine, annotation, mz_error, rt_error, n_common; lone nodes as loops. Analogs stay out.

    Edges that several rules explain are one: their names joined by ';', the first one's errors.
    """
    own = annotated.where("class <> 'analog'").join(details, ["id_a", "id_b"], "left")
    edges = own.groupBy("src", "dst").agg(F.max("sim").alias("cosine"), F.array_join(F.array_sort(F.collect_list("ion")), ";").alias("annotation"), F.min_by("mz_error", "ion").alias("mz_error"), F.first("rt_error").alias("rt_error"), F.first("n_common").alias("n_common"))
    touched = edges.select(F.col("src").alias("id")).unionByName(edges.select(F.col("dst").alias("id"))).distinct()
    alone = nodes.select("id").join(touched, "id", "left_anti")
    return edges.unionByName(alone.select(F.col("id").alias("src"), F.col("id").alias("dst"), F.lit(1.0).alias("cosine"), F.lit("").alias("annotation"), F.lit(0.0).alias("mz_error"), F.lit(0.0).alias("rt_error"), F.lit(0).cast(edges.schema["n_common"].dataType).alias("n_common")))


def direction_errors(annotated: DataFrame, clusters: DataFrame) -> DataFrame:
    """Edges that run the wrong way for their class; none is right."""
    mz = lambda s: clusters.select(F.col("id").alias(s), F.col("mz").alias(f"mz_{s}"))
    met = annotated.where("class <> 'analog'").join(mz("src"), "src").join(mz("dst"), "dst")
    down = F.col("class").isin(*FROM_HEAVIER)
    return met.where((down & (F.col("mz_src") < F.col("mz_dst"))) | (~down & (F.col("mz_src") > F.col("mz_dst"))))


def pair_details(pairs: DataFrame, samples: DataFrame) -> DataFrame:
    """id_a, id_b, rt_error, n_common. samples: id, samples (array)."""
    s = lambda k: samples.select(F.col("id").alias(f"id_{k}"), F.col("samples").alias(f"s_{k}"))
    own = pairs.select(F.col("l.id").alias("id_a"), F.col("r.id").alias("id_b"), F.bround(F.abs(F.col("l.rt_mean") - F.col("r.rt_mean")), 4).alias("rt_error"))
    return own.join(s("a"), "id_a", "left").join(s("b"), "id_b", "left").select("id_a", "id_b", "rt_error", F.coalesce(F.size(F.array_intersect("s_a", "s_b")), F.lit(0)).alias("n_common"))

