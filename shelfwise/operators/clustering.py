"""Cluster entities: k-means sweep, agglomerative linkages, density clusters; pick the best.

Entities are rows (entity, vec). Results are rows (run, entity, label); a run is one model with
one parameter, and runs of a kind are computed together.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.functions.jobs import side_by_side
from shelfwise.functions.ordering import number_rows, percentile_ranks
from shelfwise.functions.storage import discard, materialise
from shelfwise.operators.cluster_scores import cluster_scores
from shelfwise.operators.kmeans import assign_labels, fit_centers
from shelfwise.operators.pairs import BLOCK, blocks_needed, compare_blocks, distances
from shelfwise.operators.spatial import compare_near, near_pairs, spatial_blocks

# Fixed parameters of the comparison.
SEED = 42
INITS = 20
LINKAGES = ("ward", "complete", "average")
EPS = (0.5, 0.75, 1.0, 1.25, 1.5)
NOISE = -1
LAST = 512  #: clusters of a run that are merged in one task


def _number_labels(members: DataFrame) -> DataFrame:
    """Replace cluster names (run, entity, name) by 0..k-1 in name order; NULL is noise."""
    members = materialise(members)
    names = members.where(F.col("name").isNotNull()).select("run", "name").distinct()
    numbered = materialise(number_rows(names, [F.col("run"), F.col("name")], "_n"))
    start = numbered.groupBy("run").agg(F.min("_n").alias("_start"))
    labels = numbered.join(start, "run").select(
        "run", "name", (F.col("_n") - F.col("_start")).cast("int").alias("label"))
    return members.join(labels, ["run", "name"], "left").select(
        "run", "entity", F.coalesce("label", F.lit(NOISE)).alias("label"))


# --- k-means ---------------------------------------------------------------------------------

def kmeans_sweep(vectors: DataFrame, ks: list[int], n_init: int = INITS,
                 seed: int = SEED) -> DataFrame:
    """Best of ``n_init`` starts for each k, by within-cluster cost; runs are named ``k=<k>``."""
    return assign_labels(vectors, fit_centers(vectors, ks, n_init, seed))


# --- agglomerative clustering ----------------------------------------------------------------

def _ward_rows(state: DataFrame, width: int) -> DataFrame:
    """Ward needs only centroids: one row per cluster."""
    return state.where(F.col("run") == "ward").groupBy("run", "cluster").agg(
        F.array(*[F.avg(F.col("vec")[i]) for i in range(width)]).alias("vec"),
        F.max("size").alias("size"), F.max("top").alias("top")).select(
        "run", F.col("cluster").alias("entity"), "vec", "cluster", "size", "top",
        F.lit(1).cast("long").alias("members"))


def _pair_order(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A scattered order of pairs, the same from both sides, to settle equal distances.

    By name, all copies of an entity would point to the first copy and merge one pair per round;
    in a scattered order a share of them merges in every round.
    """
    mixed = (a[:, None] ^ b[None, :]).astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed ^ (mixed >> np.uint64(29))) >> np.uint64(1)).astype(np.int64)


def _cluster_rows(state: DataFrame, width: int) -> DataFrame:
    rows = state.where(F.col("run") != "ward").select(
        "run", "entity", "vec", "cluster", "size", "top", F.col("size").alias("members"))
    return rows.unionByName(_ward_rows(state, width)).withColumn("mark", F.xxhash64("cluster"))


def _cluster_pairs(left: DataFrame, right: DataFrame, blocks: int, every: bool) -> DataFrame:
    """Distances of the clusters of ``left`` to others, with the size and last merge height.

    Blocks are made of clusters; one with more than ``BLOCK`` members is spread over several.
    Two clusters that are whole in a pair of blocks are settled there, and only the nearest
    leaves, unless ``every`` pair is asked for. A pair with a spread cluster leaves as one partial
    sum or maximum, completed here.
    """
    pieces = F.ceil(F.col("members") / BLOCK)
    piece = F.when(pieces > 1, F.pmod(F.xxhash64("entity"), pieces)).otherwise(F.lit(0))

    def nearest(x: pd.DataFrame, y: pd.DataFrame, *_) -> pd.DataFrame:
        linkage = x["run"].iloc[0]
        x, y = (side.sort_values(["cluster", "entity"], kind="stable") for side in (x, y))
        (a, a_at), (b, b_at) = (np.unique(side["cluster"].to_numpy(), return_index=True)
                                for side in (x, y))
        a_size, b_size = x["size"].to_numpy()[a_at], y["size"].to_numpy()[b_at]
        a_top, b_top = x["top"].to_numpy()[a_at], y["top"].to_numpy()[b_at]
        order = _pair_order(x["mark"].to_numpy()[a_at], y["mark"].to_numpy()[b_at])
        combine = np.maximum if linkage == "complete" else np.add
        value = combine.reduceat(combine.reduceat(distances(x, y), a_at, axis=0), b_at, axis=1)
        if linkage == "ward":
            weight = 2.0 * a_size[:, None] * b_size / (a_size[:, None] + b_size)
            value = np.sqrt(weight) * value
        whole_a = x["members"].to_numpy()[a_at] <= BLOCK
        whole_b = y["members"].to_numpy()[b_at] <= BLOCK
        settled = whole_a[:, None] & whole_b[None, :] & (not every)
        other = a[:, None] != b[None, :]
        scale = a_size[:, None] * b_size if linkage == "average" else 1.0
        final = np.where(settled & other, np.round(value / scale, 10), np.inf)
        lowest = final == final.min(axis=1)[:, None]
        best = np.where(lowest, order, np.iinfo(np.int64).max).argmin(axis=1)
        found = np.isfinite(final[np.arange(a.size), best])
        open_a, open_b = np.nonzero(~settled & other)
        # Nearest settled pairs first, then every pair with a spread cluster.
        i = np.concatenate([np.flatnonzero(found), open_a])
        j = np.concatenate([best[found], open_b])
        partial = np.repeat([False, True], [found.sum(), open_a.size])
        return pd.DataFrame({
            "run": linkage, "cluster": a[i], "other": b[j],
            "value": np.where(partial, value[i, j], final[i, j]), "partial": partial,
            "turn": order[i, j], "size": a_size[i], "other_size": b_size[j],
            "top": np.maximum(a_top[i], b_top[j])})

    found = compare_blocks(
        left, right, blocks, nearest,
        "run string, cluster string, other string, value double, partial boolean, turn long, "
        "size long, other_size long, top double",
        key=F.xxhash64("cluster", piece))
    # A settled pair occurs once and passes through unchanged; partial ones are completed here.
    average = F.col("partial") & (F.col("run") == "average")
    total = F.when(average, F.sum("value") / (F.col("size") * F.col("other_size"))).otherwise(
        F.max("value"))
    pair = ["run", "cluster", "other", "partial", "turn", "size", "other_size", "top"]
    return found.groupBy(*pair).agg(F.round(total, 10).alias("value"))


def _nearest(pairs: DataFrame) -> DataFrame:
    near = F.struct("value", "turn", "other", (F.col("size") + F.col("other_size")).alias("size"), "top")
    return pairs.groupBy("run", "cluster").agg(F.min(near).alias("near")).select(
        "run", "cluster", "near.*")


def _mutual(near: DataFrame) -> DataFrame:
    """Clusters that are each other's nearest: (run, keep, gone, height, size)."""
    back = near.select("run", F.col("cluster").alias("other"), F.col("other").alias("cluster"))
    return near.where(F.col("cluster") < F.col("other")).join(
        back, ["run", "cluster", "other"], "left_semi").select(
        "run", F.col("cluster").alias("keep"), F.col("other").alias("gone"),
        F.greatest("value", "top").alias("height"), "size")


def _closest(near: DataFrame) -> DataFrame:
    """The closest pair of each run, in the same form."""
    pair = F.struct("value", "turn", F.least("cluster", "other").alias("keep"),
                    F.greatest("cluster", "other").alias("gone"), "top", "size")
    return near.groupBy("run").agg(F.min(pair).alias("m")).select(
        "run", "m.keep", "m.gone", F.greatest("m.value", "m.top").alias("height"), "m.size")


def _merge_all(keys: tuple, pairs: pd.DataFrame) -> pd.DataFrame:
    """All merges of one run, from the distances of all pairs of its clusters (``LAST`` at most)."""
    run = keys[0]
    names = np.unique(pairs["cluster"].to_numpy())
    at, to = (np.searchsorted(names, pairs[c].to_numpy()) for c in ("cluster", "other"))
    apart = np.full((len(names), len(names)), np.inf)
    turn = np.zeros((len(names), len(names)), np.int64)
    size = np.zeros(len(names), np.int64)
    apart[at, to], turn[at, to] = pairs["value"].to_numpy(), pairs["turn"].to_numpy()
    size[at] = pairs["size"].to_numpy()
    top = np.zeros(len(names))
    top[at] = pairs["own_top"].to_numpy()
    merges = []
    for step in range(len(names) - 1):
        shown = np.round(apart, 10)
        rows, columns = np.nonzero(shown == shown.min())
        closest = turn[rows, columns].argmin()
        keep, gone = sorted((int(rows[closest]), int(columns[closest])))
        height = max(shown[keep, gone], top[keep], top[gone])
        a, b, c = size[keep], size[gone], size
        if run == "complete":
            new = np.maximum(apart[keep], apart[gone])
        elif run == "average":
            new = (a * apart[keep] + b * apart[gone]) / (a + b)
        else:
            square = ((a + c) * apart[keep] ** 2 + (b + c) * apart[gone] ** 2
                      - c * apart[keep, gone] ** 2) / (a + b + c)
            new = np.sqrt(np.maximum(square, 0))
        new[[keep, gone]] = np.inf
        apart[keep], apart[:, keep] = new, new
        apart[gone], apart[:, gone] = np.inf, np.inf
        size[keep], top[keep] = a + b, height
        merges.append((run, names[keep], names[gone], height, int(a + b), step))
    return pd.DataFrame(merges, columns=["run", "keep", "gone", "height", "size", "turn"])


def _names_at_cut(merges: list, k: int) -> dict[tuple[str, str], str]:
    """Cluster of each merged entity when all but the k - 1 highest merges of its run are made."""
    above: dict[tuple[str, str], str] = {}
    for run in {m["run"] for m in merges}:
        own = sorted((m for m in merges if m["run"] == run),
                     key=lambda m: (m["height"], m["turn"], m["keep"]))
        for m in own[:len(own) - (k - 1)] if k > 1 else own:
            above[run, m["gone"]] = m["keep"]

    def root(run: str, name: str) -> str:
        while (run, name) in above:
            name = above[run, name]
        return name

    return {(run, gone): root(run, gone) for run, gone in above}


def hierarchical_clusters(vectors: DataFrame, linkages=LINKAGES, k: int = 4) -> DataFrame:
    """Agglomerative clusters for all linkages together, cut at ``k`` clusters each.

    While a run has more than ``LAST`` clusters, all mutually nearest ones merge in every round;
    the table of nearest clusters is kept, and only clusters that merged or whose nearest did are
    compared again. What is left merges in one task, from the distances of all pairs of clusters,
    which one pass over the entities gives. Ward, complete and average linkage are reducible, so
    this builds the same tree as merging one closest pair at a time (equal distances in a scattered
    but fixed order). The merges are a table of their own: what all but the k - 1 highest of them
    connect is a cluster.
    """
    start = vectors.select("entity", "vec").withColumn(
        "run", F.explode(F.array(*[F.lit(name) for name in linkages])))
    state = materialise(start.select(
        "run", "entity", "vec", F.col("entity").alias("cluster"),
        F.lit(1).cast("long").alias("size"), F.lit(0.0).alias("top")))
    first = state.first()
    if first is None:
        return _number_labels(state.select("run", "entity", F.col("cluster").alias("name")))
    width, blocks = len(first["vec"]), blocks_needed(state)
    turn, before, rounds, near, moved = 0, None, [], None, None
    while state.groupBy("run").agg(F.countDistinct("cluster").alias("n")).agg(
            F.max("n")).first()[0] > LAST:
        rows = materialise(_cluster_rows(state, width))
        if near is None:
            fresh = _nearest(_cluster_pairs(rows, rows, blocks, False))
        else:
            # Merging brings no cluster nearer, so only the nearest of these can have changed.
            kept = near.join(moved.select("run", "cluster"), ["run", "cluster"], "left_anti").join(
                moved.select("run", F.col("cluster").alias("other")), ["run", "other"], "left_anti")
            kept = materialise(kept.select(*near.columns))
            stale = rows.join(kept.select("run", "cluster"), ["run", "cluster"], "left_anti")
            fresh = kept.unionByName(_nearest(_cluster_pairs(stale, rows, blocks, False)))
        near = materialise(fresh)
        discard(rows)
        clusters, turn = near.count(), turn + 1
        # Sums of a spread cluster may differ in the last digit by side. Should that leave no
        # mutual pair, the closest pair merges, which is right in any case.
        merges = _closest(near) if clusters == before else _mutual(near)
        merges = materialise(merges.withColumn("turn", F.lit(turn)))
        rounds.append(merges)
        before = clusters
        moved = merges.select(
            "run", F.explode(F.array("keep", "gone")).alias("cluster"),
            F.col("keep").alias("_into"), F.col("size").alias("_size"),
            F.col("height").alias("_top"))
        done, state = state, materialise(state.join(moved, ["run", "cluster"], "left").select(
            "run", "entity", "vec", F.coalesce("_into", "cluster").alias("cluster"),
            F.coalesce("_size", "size").alias("size"), F.coalesce("_top", "top").alias("top")))
        discard(done)
    rows = materialise(_cluster_rows(state, width))
    tops = state.groupBy("run", "cluster").agg(F.max("top").alias("own_top"))
    last = materialise(_cluster_pairs(rows, rows, blocks, True).join(
        tops, ["run", "cluster"]).groupBy("run").applyInPandas(
        _merge_all, "run string, keep string, gone string, height double, size long, turn int"
    ).withColumn("turn", F.col("turn") + turn + 1))
    nodes = state.select("run", "entity")
    if not rounds:
        names = _names_at_cut(last.collect(), k)  # LAST - 1 rows of each run at most
        table = vectors.sparkSession.createDataFrame(
            [(run, gone, root) for (run, gone), root in names.items()],
            "run string, entity string, root string")
        return _number_labels(nodes.join(table, ["run", "entity"], "left").select(
            "run", "entity", F.coalesce("root", "entity").alias("name")))
    merge = reduce(DataFrame.unionByName, [*rounds, last]).select(
        "run", F.col("gone").alias("entity"), F.col("keep").alias("linked"),
        F.struct("height", "turn", F.col("keep").alias("cluster")).alias("m"))
    if k > 1:
        highest = F.row_number().over(W.partitionBy("run").orderBy(F.desc("m")))
        # k - 1 rows per linkage.
        limit = merge.withColumn("_n", highest).where(F.col("_n") <= k - 1).groupBy("run").agg(
            F.min("m").alias("_limit"))
        merge = merge.join(F.broadcast(limit), "run").where(F.col("m") < F.col("_limit"))
    # A merged cluster keeps the smaller name, so the root is the name it had at the cut.
    return _number_labels(_connected(merge, nodes).select("run", "entity", F.col("root").alias("name")))


# --- density clusters ------------------------------------------------------------------------

def _local_links(close: np.ndarray) -> np.ndarray:
    """For a 0/1 neighbour matrix over rows: index of the first row of each row's component."""
    label = np.arange(close.shape[0])
    while True:
        lowest = np.where(close, label[None, :], close.shape[0]).min(axis=1)
        lowest = np.minimum(lowest, label)
        lowest = lowest[lowest]
        if (lowest == label).all():
            return label
        label = lowest


def _connected(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """Smallest reachable node name per node: rows (run, entity, root).

    Each round takes the smallest root among linked nodes and then jumps to that root's root, so
    distances halve. ``links`` hold at most one row per node and block pair.
    """
    both = materialise(links.select("run", "entity", "linked").unionByName(
        links.select("run", F.col("linked").alias("entity"), F.col("entity").alias("linked"))))
    roots = materialise(nodes.select("run", "entity", F.col("entity").alias("root")))
    while True:
        offered = both.join(
            roots.select("run", F.col("entity").alias("linked"), F.col("root").alias("_offer")),
            ["run", "linked"]).groupBy("run", "entity").agg(F.min("_offer").alias("_offer"))
        lower = roots.join(offered, ["run", "entity"], "left").select(
            "run", "entity", F.col("root").alias("_was"),
            F.least("root", "_offer").alias("root"))
        lower = materialise(lower)
        jump = lower.select("run", F.col("entity").alias("root"), F.col("root").alias("_next"))
        changed = materialise(lower.join(jump, ["run", "root"], "left").select(
            "run", "entity", "_was", F.coalesce("_next", "root").alias("root")))
        roots = changed.drop("_was")
        if changed.where(F.col("_was") != F.col("root")).isEmpty():
            return roots


def dbscan_clusters(vectors: DataFrame, eps=EPS, min_samples: int = 5) -> DataFrame:
    """Density clusters for each radius together; runs are named ``eps=<eps>``, noise is -1.

    A core has ``min_samples`` entities within the radius, itself included. Cores within the
    radius of each other share a cluster; a border entity joins the first such cluster. Only blocks
    whose boxes are within the largest radius are compared, once to count neighbours for all radii
    and once to link them.
    """
    names, radii = [f"eps={e}" for e in eps], np.array([float(e) for e in eps])
    placed = spatial_blocks(vectors.select("entity", "vec"))
    if placed.isEmpty():
        return _number_labels(placed.select(F.lit("").alias("run"), "entity", F.lit(None).cast(
            "string").alias("name")))
    pairs = materialise(near_pairs(placed, float(radii.max())))

    def counts(x: pd.DataFrame, y: pd.DataFrame, same: bool) -> pd.DataFrame:
        close = distances(x, y)[:, :, None] <= radii
        found = [(x, close.sum(axis=1))] if same else [(x, close.sum(axis=1)),
                                                       (y, close.sum(axis=0))]
        return pd.DataFrame({"entity": np.concatenate([side["entity"] for side, _ in found]),
                             "n": np.concatenate([n for _, n in found]).tolist()})

    neighbours = compare_near(placed, pairs, ["entity", "vec"], counts,
                              "entity string, n array<long>")
    many = neighbours.groupBy("entity").agg(F.array(*[
        F.sum(F.col("n")[i]) >= min_samples for i in range(len(radii))]).alias("core"))
    placed = materialise(placed.join(many, "entity"))

    def links(x: pd.DataFrame, y: pd.DataFrame, same: bool) -> pd.DataFrame:
        apart, parts = distances(x, y), []
        core_x, core_y = (np.stack(side["core"].to_numpy()) for side in (x, y))
        name_x, name_y = x["entity"].to_numpy(), y["entity"].to_numpy()

        def tell(i: int, entity: np.ndarray, linked: np.ndarray, core: bool) -> None:
            parts.append(pd.DataFrame({"run": names[i], "entity": entity, "linked": linked,
                                       "core": core}))

        for i, radius in enumerate(radii):
            near, a, b = apart <= radius, core_x[:, i], core_y[:, i]
            # A spanning forest of the near cores: a dense group leaves one row per entity.
            between = near[np.ix_(a, b)]
            if same:
                own, close = name_x[a], between
            else:
                own = np.concatenate([name_x[a], name_y[b]])
                close = np.eye(own.size, dtype=bool)
                close[:a.sum(), a.sum():], close[a.sum():, :a.sum()] = between, between.T
            root = _local_links(close) if own.size else np.zeros(0, int)
            moved = root != np.arange(own.size)
            tell(i, own[moved], own[root[moved]], True)
            # A border entity has fewer than min_samples cores near it.
            row, column = np.nonzero(near & ~a[:, None] & b[None, :])
            tell(i, name_x[row], name_y[column], False)
            if not same:
                row, column = np.nonzero(near & a[:, None] & ~b[None, :])
                tell(i, name_y[column], name_x[row], False)
        return pd.concat(parts)

    linked = materialise(compare_near(placed, pairs, ["entity", "vec", "core"], links,
                                      "run string, entity string, linked string, core boolean"))
    by_run = placed.select("entity", F.posexplode("core").alias("i", "is_core")).withColumn(
        "run", F.element_at(F.array(*[F.lit(n) for n in names]), F.col("i") + 1))
    roots = _connected(linked.where("core"), by_run.where("is_core").select("run", "entity"))
    adopted = linked.where("not core").join(
        roots.withColumnRenamed("entity", "linked"), ["run", "linked"]).groupBy(
        "run", "entity").agg(F.min("root").alias("name"))
    members = roots.select("run", "entity", F.col("root").alias("name")).unionByName(adopted)
    return _number_labels(by_run.select("run", "entity").join(members, ["run", "entity"], "left"))


# --- comparison and choice -------------------------------------------------------------------

def min_samples_for(entities: int) -> int:
    return max(3, min(5, entities // 4))


def label_runs(vectors: DataFrame, n_init: int = INITS) -> DataFrame:
    """Rows (run, entity, label, vec) of every compared model, the run named ``model|parameters``."""
    vectors = materialise(vectors)
    n = vectors.count()
    k_cut = min(4, n - 1)
    # The models don't depend on each other, and their steps are small jobs.
    models = {
        "K-Means": lambda: kmeans_sweep(vectors, list(range(2, min(8, n - 1) + 1)), n_init),
        "Hierarchical": lambda: hierarchical_clusters(vectors, LINKAGES, k_cut),
        "DBSCAN": lambda: dbscan_clusters(vectors, EPS, min_samples_for(n))}
    runs = zip(models, side_by_side(
        vectors.sparkSession, lambda fit: materialise(fit()), models.values()), strict=True)
    labelled = reduce(DataFrame.unionByName, [
        labels.select(F.concat(F.lit(f"{model}|"), F.lit("linkage=" if model == "Hierarchical"
                                                         else ""), "run",
                               F.lit(f",k={k_cut}" if model == "Hierarchical" else "")
                               ).alias("run"), "entity", "label")
        for model, labels in runs])
    return materialise(labelled.join(vectors, "entity"))


def compare_clustering(vectors: DataFrame, n_init: int = INITS,
                       labelled: DataFrame | None = None) -> DataFrame:
    """One row per model and parameter: clusters, noise share and the three scores.

    Labels made before by ``label_runs`` may be handed in.
    """
    labelled = label_runs(vectors, n_init) if labelled is None else labelled
    is_cluster = F.col("label") != NOISE
    shape = labelled.groupBy("run", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("run").agg(
        F.count_if(is_cluster).cast("int").alias("clusters"),
        (100.0 * F.sum(F.when(is_cluster, 0).otherwise(F.col("n"))) / F.sum("n"))
        .alias("noise_pct"))
    model = F.split("run", r"\|")[0]
    parameters = F.split("run", r"\|")[1]
    # K-Means has the clusters that it was asked for, even if one stayed empty.
    asked = F.when(model == "K-Means", F.element_at(F.split(parameters, "="), -1).cast("int"))
    return cluster_scores(labelled).join(shape, "run").select(
        model.alias("model"), parameters.alias("parameters"),
        F.coalesce(asked, "clusters").alias("clusters"), "noise_pct", "silhouette", "davies_bouldin", "calinski_harabasz")


def choose_best(results: DataFrame, order: str = "best") -> DataFrame:
    """One row (model, parameter, rank_score) chosen by the sum of three percentile ranks.

    ``best`` takes the smallest sum, i.e. the best ranks. ``reference`` takes the largest sum, as
    the published pipeline does. Without any scored row the choice is K-Means with 4 clusters.
    """
    if order not in ("best", "reference"):
        raise ValueError(f"unknown order: {order}")
    scores = ["silhouette", "davies_bouldin", "calinski_harabasz"]
    valid = materialise(results.dropna(subset=scores))
    keys = ["model", "parameters"]
    ranks = percentile_ranks(valid, keys, {
        "r_s": -F.col("silhouette"), "r_d": F.col("davies_bouldin"),
        "r_c": -F.col("calinski_harabasz")})
    ranked = valid.join(ranks, keys).withColumn(
        "rank_score", F.col("r_s") + F.col("r_d") + F.col("r_c"))
    sort = F.col("rank_score").asc() if order == "best" else F.col("rank_score").desc()
    value = F.when(F.col("model") == "DBSCAN",
                   F.element_at(F.split("parameters", "="), -1).cast("double")).otherwise(
        F.col("clusters").cast("double"))
    if valid.isEmpty():
        return results.sparkSession.range(1).select(
            F.lit("K-Means").alias("model"), F.lit(4.0).alias("parameter"),
            F.lit(None).cast("double").alias("rank_score"))
    return ranked.orderBy(sort, *keys).limit(1).select(
        "model", value.alias("parameter"), "rank_score")


def labels_of_choice(labelled: DataFrame, model: str, parameter: float,
                     linkage: str = "ward") -> DataFrame:
    """Rows (entity, label) of the compared run that was chosen; none if there is no such run.

    A hierarchical choice stands for its ``linkage`` run, as ``fit_cluster`` would fit it.
    """
    value = F.element_at(F.split("run", "="), -1).cast("double")
    own = F.col("run").startswith(f"{model}|") & (value == float(parameter))
    if model == "Hierarchical":
        own &= F.col("run").contains(f"linkage={linkage},")
    return labelled.where(own).select("entity", "label")


def fit_cluster(vectors: DataFrame, model: str, parameter: float, n_init: int = INITS,
                linkage: str = "ward") -> DataFrame:
    """Label every entity with the chosen model: rows (entity, label)."""
    if model == "K-Means":
        labels = kmeans_sweep(vectors, [int(parameter)], n_init)
    elif model == "Hierarchical":
        labels = hierarchical_clusters(vectors, (linkage,), int(parameter))
    elif model == "DBSCAN":
        labels = dbscan_clusters(vectors, (parameter,), min_samples_for(vectors.count()))
    else:
        raise ValueError(f"unknown model: {model}")
    return labels.select("entity", "label")
