"""Similarity of groups by the sets of tokens seen in them.

Groups with exactly the same tokens are folded into one *profile* first, so a
large family of copies costs one row and no pairs. Pairs are found between
profiles, and `top_pairs` opens profiles again only as far as a top list needs.

Two ways to pair profiles, both with a distance threshold:

* `exact_pairs` joins on rare tokens (prefix filter): two sets that are similar
  enough must share one of their few rarest tokens, hence frequent tokens never
  become join keys.
* `lsh_pairs` joins on MinHash values. In an overfull bucket the pairs must
  additionally share a rare token. That changes no result, as all pairs below
  the threshold do share one.

Distances are Jaccard distances computed on the sets themselves.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaynet.functions.hashing import hash_int
from delaynet.operators.graph import connected_components
from delaynet.session import materialize

MAX_BUCKET = 1_000
BLOCK = 250
PAIRS_PER_TASK = 500_000
LADDER = 3  # halvings of the threshold that a top list starts from
# guards `ceil` against 0.7 * 10 = 7.000000000000001 and the like
_EPSILON = 1e-9


def token_bags(rows: DataFrame, group: Column, token: Column) -> DataFrame:
    """(group_id, tokens) with the sorted distinct tokens of each group.

    Pairs are made distinct before collecting, so a group's array holds at most
    the vocabulary, however many rows the group has.
    """
    pairs = rows.select(group.alias("group_id"), token.alias("token")).na.drop().distinct()
    return pairs.groupBy("group_id").agg(F.sort_array(F.collect_list("token")).alias("tokens"))


def token_vocabulary(rows: DataFrame, token: Column, size: int = 5000) -> DataFrame:
    """The `size` most frequent tokens, ties by token."""
    counts = rows.select(token.alias("token")).na.drop().groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "token").limit(size)


def with_fingerprint(bags: DataFrame) -> DataFrame:
    # length-prefixed tokens keep ["a,b"] and ["a", "b"] apart
    spelled = F.transform("tokens", lambda t: F.concat(F.length(t).cast("string"), F.lit(":"), t))
    return bags.withColumn("fingerprint", F.sha2(F.concat_ws(",", spelled), 256))


def profiles(bags: DataFrame) -> DataFrame:
    """One row per distinct token set: its smallest group, how many groups, the
    set, and `codes`, the set as numbers that ascend from rare to frequent tokens.
    """
    folded = (
        with_fingerprint(bags)
        .groupBy("fingerprint")
        .agg(F.min("group_id").alias("profile"), F.count(F.lit(1)).alias("members"), F.any_value("tokens").alias("tokens"))
        .withColumn("size", F.size("tokens"))
    )
    folded = materialize(folded, "profiles")
    long = folded.select("profile", F.explode("tokens").alias("token"))
    by_rarity = long.groupBy("token").agg(F.count(F.lit(1)).alias("df")).orderBy("df", "token")
    # written, as the numbers must be the same wherever they are used
    vocabulary = materialize(by_rarity.select("token", F.monotonically_increasing_id().alias("code")), "vocabulary")
    codes = long.join(vocabulary, "token").groupBy("profile").agg(F.sort_array(F.collect_list("code")).alias("codes"))
    return folded.join(codes, "profile")


def _prefix_length(threshold: float) -> Column:
    """How many of its rarest tokens a set must show, so that no two sets closer
    than the threshold can show disjoint ones."""
    length = F.col("size") - F.ceil(F.col("size") * (1.0 - threshold) - _EPSILON) + 1
    return F.least(length, F.col("size")).cast("int")


def _prefix(threshold: float) -> Column:
    return F.slice("codes", F.lit(1), _prefix_length(threshold))


def _paired(rows: DataFrame, keys: list[str], carried: list[str], block: int = BLOCK) -> DataFrame:
    """Rows of equal keys side by side, `carried` columns suffixed _a and _b.

    A key held by more than `block` rows is split: each row stands on the left
    in one block, and on the right in all of them, so no task gets a whole
    crowded key. Their number of partitions follows from the pairs that the counts
    of the keys stand for, which the size of the input says nothing about.
    """
    counts = materialize(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "keys")
    made = counts.agg(F.sum(F.col("n").cast("double") * F.col("n") / 2)).first()[0] or 0.0
    rows = rows.join(counts.select(*keys, F.ceil(F.col("n") / block).cast("int").alias("blocks")), keys)
    left = rows.withColumn("block", F.pmod(F.xxhash64("profile"), "blocks").cast("int"))
    right = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keys = [*keys, "block"]
    spark = rows.sparkSession
    cores = spark.sparkContext.defaultParallelism
    partitions = max(cores, int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(made / PAIRS_PER_TASK))

    def side(name: str, frame: DataFrame) -> DataFrame:
        picked = frame.select(*keys, *[F.col(column).alias(f"{column}_{name}") for column in carried])
        return picked.repartition(partitions, *keys)

    return side("a", left).join(side("b", right), keys).filter(F.col("profile_a") < F.col("profile_b"))


def _sizes_fit(threshold: float) -> Column:
    """A set much larger than the other cannot be similar to it."""
    bound = F.lit(1.0 - threshold - _EPSILON)
    return (F.col("size_a") >= F.col("size_b") * bound) & (F.col("size_b") >= F.col("size_a") * bound)


def _overlap_needed(threshold: float) -> Column:
    similarity = 1.0 - threshold
    return (F.col("size_a") + F.col("size_b")) * (similarity / (1.0 + similarity)) - _EPSILON


def _enough_left(threshold: float) -> Column:
    """If the sets share nothing before positions place_a and place_b, what is
    left from there on must still hold the overlap that the threshold asks for."""
    left = F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b"))
    return left >= _overlap_needed(threshold)


def _self_pairs(profile_rows: DataFrame) -> DataFrame:
    """Profiles with several groups: those are at distance 0 of each other."""
    return profile_rows.filter("members > 1").select(
        F.col("profile").alias("profile_a"),
        F.col("profile").alias("profile_b"),
        F.col("members").alias("members_a"),
        F.col("members").alias("members_b"),
        F.lit(0.0).alias("jaccard_distance"),
    )


_PAIR_COLUMNS = ["profile_a", "profile_b", "members_a", "members_b", "jaccard_distance"]


def _measured(pairs: DataFrame, threshold: float) -> DataFrame:
    """Pairs closer than `threshold`, with the distance and the rarest shared token.

    Generating `shared` as a row makes Spark intersect the sets once per pair
    instead of once per use of the result.
    """
    pairs = pairs.withColumn("shared", F.explode(F.array(F.array_intersect("codes_a", "codes_b"))))
    overlap = F.size("shared")
    distance = F.lit(1.0) - overlap / (F.col("size_a") + F.col("size_b") - overlap)
    return (
        pairs.withColumns({"jaccard_distance": distance, "rarest": F.get("shared", F.lit(0))})
        .filter(F.col("jaccard_distance") < threshold)
        .drop("shared")
    )


def exact_pairs(profile_rows: DataFrame, threshold: float, *extra: str) -> DataFrame:
    """All profile pairs (a <= b) at a distance strictly below `threshold`.

    A profile paired with itself stands for the pairs among its own groups.
    `extra` columns of the profiles come along with suffixes _a and _b.
    """
    keyed = profile_rows.select("*", F.posexplode(_prefix(threshold)).alias("place", "key"))
    candidates = _paired(keyed, ["key"], ["profile", "members", "size", "codes", "place", *extra])
    candidates = candidates.filter(_sizes_fit(threshold) & _enough_left(threshold))
    # a pair sharing several rare tokens is kept at the rarest only
    pairs = _measured(candidates, threshold).filter(F.col("key") == F.col("rarest"))
    copies = _self_pairs(profile_rows)
    if extra:
        attached = profile_rows.select(
            F.col("profile").alias("profile_a"),
            *[F.col(name).alias(f"{name}_{side}") for name in extra for side in ("a", "b")],
        )
        copies = copies.join(attached, "profile_a")
    return pairs.select(copies.columns).unionByName(copies)


def minhash_signatures(bags: DataFrame, tables: int = 3, method: str = "md5") -> DataFrame:
    """Adds h0..h{tables-1}: the smallest seeded token hash of each set."""
    return bags.select(
        "*", *[F.array_min(F.transform("tokens", _seeded(i, method))).alias(f"h{i}") for i in range(tables)]
    )


def _seeded(seed: int, method: str):
    return lambda token: hash_int(token, seed, method)


def bucket_occupancy(signatures: DataFrame, tables: int = 3) -> DataFrame:
    """Per MinHash bucket: groups in it and candidate pairs it stands for.

    `signatures` holds one row per profile, weighted by `members`.
    """
    buckets = signatures.select(
        F.posexplode(F.array(*[f"h{i}" for i in range(tables)])).alias("table", "minhash"), "members"
    )
    return (
        buckets.groupBy("table", "minhash")
        .agg(F.sum("members").alias("groups"))
        .withColumn("pairs", F.floor(F.col("groups") * (F.col("groups") - 1) / 2))
    )


def lsh_pairs(signatures: DataFrame, threshold: float, tables: int = 3, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Profile pairs sharing a MinHash value and closer than `threshold`."""
    hashes = [f"h{i}" for i in range(tables)]
    carried = ["profile", "members", "size", "codes", *hashes]
    bucketed = signatures.select(*carried, F.posexplode(F.array(*hashes)).alias("table", "minhash"))
    crowded = (
        bucketed.groupBy("table", "minhash")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > max_bucket)
        .select("table", "minhash", F.lit(True).alias("crowded"))
    )
    whole_bucket = F.array(F.lit(-1).cast("long"))
    keyed = bucketed.join(crowded, ["table", "minhash"], "left").withColumn(
        "key", F.explode(F.when(F.col("crowded"), _prefix(threshold)).otherwise(whole_bucket))
    )
    # a pair meeting in several tables, or at several rare tokens, is kept at the first
    first_table = F.coalesce(*[F.when(F.col(f"{h}_a") == F.col(f"{h}_b"), F.lit(i)) for i, h in enumerate(hashes)])
    candidates = _paired(keyed, ["table", "minhash", "key"], carried)
    candidates = candidates.filter(_sizes_fit(threshold) & (F.col("table") == first_table))
    pairs = _measured(candidates, threshold).filter((F.col("key") < 0) | (F.col("key") == F.col("rarest")))
    return pairs.select(_PAIR_COLUMNS).unionByName(_self_pairs(signatures))


def top_pairs(pairs: DataFrame, bags: DataFrame, k: int, digits: int | None = None, directed: bool = False) -> DataFrame:
    """The `k` closest group pairs, ordered by (distance, group_a, group_b).

    Exact, yet without opening all members of large profiles: the pair of the
    i-th and j-th smallest member has at least i*j/2 pairs ordered before it
    that are equally close, so it can only be listed while i*j <= 2k.
    """
    distance = F.col("jaccard_distance") if digits is None else F.round("jaccard_distance", digits)
    pairs = pairs.withColumn("distance", distance)
    # a rank filter is applied inside the tasks before the shuffle as well, so a
    # profile with very many members sends 2k of them per task
    by_id = Window.partitionBy("fingerprint").orderBy("group_id")
    members = (
        with_fingerprint(bags)
        .select("fingerprint", "group_id", F.row_number().over(by_id).alias("place"))
        .filter(F.col("place") <= 2 * k)
        .groupBy("fingerprint")
        .agg(F.sort_array(F.collect_list("group_id")).alias("ids"))
        .select(F.array_min("ids").alias("profile"), "ids")
    )
    opened = (
        pairs.join(members.select(F.col("profile").alias("profile_a"), F.col("ids").alias("ids_a")), "profile_a")
        .join(members.select(F.col("profile").alias("profile_b"), F.col("ids").alias("ids_b")), "profile_b")
        .select("profile_a", "profile_b", "distance", F.posexplode("ids_a").alias("i", "x"), "ids_b")
        .select("profile_a", "profile_b", "distance", "i", "x", F.posexplode("ids_b").alias("j", "y"))
        .filter((F.col("i") + 1) * (F.col("j") + 1) <= 2 * k)
        .filter((F.col("profile_a") != F.col("profile_b")) | (F.col("x") < F.col("y")))
    )
    ordered = opened.select(
        F.least("x", "y").alias("group_a"), F.greatest("x", "y").alias("group_b"), F.col("distance").alias("jaccard_distance")
    )
    if directed:
        ordered = ordered.select(
            F.explode(
                F.array(
                    F.struct("group_a", "group_b", "jaccard_distance"),
                    F.struct(F.col("group_b").alias("group_a"), F.col("group_a").alias("group_b"), "jaccard_distance"),
                )
            ).alias("p")
        ).select("p.*")
    return ordered.orderBy("jaccard_distance", "group_a", "group_b").limit(k)


def closest_pairs(
    pairs_below: Callable[[float], DataFrame], bags: DataFrame, k: int, threshold: float, digits: int, directed: bool = False
) -> DataFrame:
    """`top_pairs` of all pairs below `threshold`, without making them all.

    `pairs_below` gives the pairs closer than a distance. Starting from a small
    distance it is doubled until the list is full of pairs that no farther pair can
    come before, even after rounding; only a list that never fills needs them all.
    """
    for halvings in range(LADDER, -1, -1):
        limit = threshold / (1 << halvings)
        pairs = pairs_below(limit)
        if not halvings:
            break
        pairs = materialize(pairs, "closest")
        same = F.col("profile_a") == F.col("profile_b")
        stands_for = F.when(same, F.col("members_a") * (F.col("members_a") - 1) / 2).otherwise(F.col("members_a") * F.col("members_b"))
        settled = pairs.filter(F.round("jaccard_distance", digits) < limit - 10.0**-digits)
        if (settled.agg(F.sum(stands_for)).first()[0] or 0) >= k:
            break
    return top_pairs(pairs, bags, k, digits, directed)


def candidate_counts(signatures: DataFrame, tables: int = 3) -> DataFrame:
    """`tables, candidates`: group pairs that agree in any of the first 1..tables hashes.

    No pairs are made: the number of pairs agreeing in any of several tables
    follows from the sizes of the groups agreeing in each combination.
    """
    hashes = [f"h{i}" for i in range(tables)]
    combinations = list(range(1, 1 << tables))
    tagged = signatures.select(
        "members",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("combination"),
                        F.concat_ws(",", *[F.col(h).cast("string") for i, h in enumerate(hashes) if c >> i & 1]).alias("value"),
                    )
                    for c in combinations
                ]
            )
        ).alias("t"),
    )
    agreeing = (
        tagged.groupBy("t.combination", "t.value")
        .agg(F.sum("members").alias("groups"))
        .groupBy("combination")
        .agg(F.sum(F.floor(F.col("groups") * (F.col("groups") - 1) / 2)).alias("pairs"))
    )
    # inclusion and exclusion over the combinations drawn from the first t tables
    sign = F.when(F.bit_count("combination") % 2 == 1, F.lit(1)).otherwise(F.lit(-1))
    steps = F.explode(F.filter(F.lit(list(range(1, tables + 1))), lambda t: F.col("combination") < F.pow(F.lit(2), t)))
    return agreeing.withColumn("tables", steps).groupBy("tables").agg(F.sum(sign * F.col("pairs")).alias("candidates"))


def _agreed_from(tables: int) -> Column:
    """The first number of tables with which two profiles become candidates; tables + 1 if none does."""
    met = [F.when(F.col(f"h{i}_a") == F.col(f"h{i}_b"), F.lit(i + 1)) for i in range(tables)]
    return F.least(*met, F.lit(tables + 1))


def lsh_quality(signatures: DataFrame, pairs: DataFrame, tables: int = 3) -> DataFrame:
    """Precision and recall of MinHash candidates for 1..tables hash tables.

    `pairs` are exact profile pairs carrying the hashes of both sides.
    """
    same = F.col("profile_a") == F.col("profile_b")
    weight = F.when(same, F.floor(F.col("members_a") * (F.col("members_a") - 1) / 2)).otherwise(
        F.col("members_a") * F.col("members_b")
    )
    hits = (
        pairs.select(weight.alias("weight"), _agreed_from(tables).alias("agreed_from"))
        .withColumn("tables", F.explode(F.lit(list(range(1, tables + 1)))))
        .groupBy("tables")
        .agg(
            F.sum("weight").alias("true_pairs"),
            F.sum(F.when(F.col("agreed_from") <= F.col("tables"), F.col("weight")).otherwise(F.lit(0))).alias("hits"),
        )
    )
    counted = candidate_counts(signatures, tables).join(hits, "tables", "left").na.fill(0, ["true_pairs", "hits"])
    return counted.select(
        "tables",
        "candidates",
        "true_pairs",
        "hits",
        F.try_divide("hits", "candidates").alias("precision"),
        F.try_divide("hits", "true_pairs").alias("recall"),
    )


def stratified_sample(signatures: DataFrame, per_stratum: int, seed: int = 0, method: str = "xxhash64") -> DataFrame:
    """Profiles with `stratum` and `stratum_size`: all of a small stratum, `per_stratum` drawn by hash of a larger one.

    Strata are doublings of the set's size and of the groups that a profile stands
    for, so there are a few hundred at most and the sample is bounded. The rank filter
    works inside the tasks first: a stratum with most rows sends `per_stratum` per task.
    """
    doubling = lambda name: F.floor(F.log2(name)).cast("int")
    rows = signatures.withColumn("stratum", F.struct(doubling("members").alias("members"), doubling("size").alias("size")))
    sizes = rows.groupBy("stratum").agg(F.count(F.lit(1)).alias("stratum_size"))
    drawn = Window.partitionBy("stratum").orderBy(hash_int(F.col("profile"), seed, method), "profile")
    sample = rows.withColumn("place", F.row_number().over(drawn)).filter(F.col("place") <= per_stratum).drop("place")
    return sample.join(sizes, "stratum")


def sampled_partners(signatures: DataFrame, sample: DataFrame, threshold: float, tables: int = 3) -> DataFrame:
    """Per sampled profile and number of tables: its true group pairs with other profiles, and those that are candidates.

    Each sampled profile is searched exactly among all profiles through its rare
    tokens, so work follows the sample times the rows of those tokens.
    """
    hashes = [f"h{i}" for i in range(tables)]
    carried = ["profile", "members", "size", "codes", "place", *hashes]

    def side(name: str, frame: DataFrame) -> DataFrame:
        keyed = frame.select("*", F.posexplode(_prefix(threshold)).alias("place", "key"))
        return keyed.select("key", *[F.col(column).alias(f"{column}_{name}") for column in carried])

    met = side("b", signatures).join(side("a", sample), "key").filter("profile_a <> profile_b")
    near = _measured(met.filter(_sizes_fit(threshold) & _enough_left(threshold)), threshold).filter(F.col("key") == F.col("rarest"))
    weight = F.col("members_a") * F.col("members_b")
    agreed = _agreed_from(tables)
    found = near.groupBy(F.col("profile_a").alias("profile")).agg(
        F.sum(weight).alias("partners"),
        F.array(*[F.sum(F.when(agreed <= t, weight).otherwise(F.lit(0))) for t in range(1, tables + 1)]).alias("hits"),
    )
    rows = sample.select("profile", "stratum", "stratum_size").join(found, "profile", "left")
    none = F.array(*[F.lit(0).cast("long")] * tables)
    return rows.select(
        "stratum", "stratum_size", F.coalesce("partners", F.lit(0)).alias("partners"),
        F.posexplode(F.coalesce("hits", none)).alias("tables", "hits"),
    ).withColumn("tables", F.col("tables") + 1)


def sampled_quality(
    signatures: DataFrame, threshold: float, per_stratum: int = 400, tables: int = 3, seed: int = 0,
    method: str = "xxhash64", deviations: float = 1.96,
) -> DataFrame:
    """`lsh_quality` estimated from a stratified sample of profiles, with an interval for the recall.

    Candidates and the pairs inside profiles are counted exactly. Every other pair is
    seen from both of its ends, so half of the sampled profiles' pairs, scaled by
    stratum, estimates their number without a list of them. Recall is a ratio
    estimate; its variance is that of the residuals `hits - recall * partners`. With
    every stratum drawn whole the answer is exact and the interval a point. Recall is null
    without a true pair; strata ask for two profiles at least.
    """
    if per_stratum < 2:
        raise ValueError(f"a stratum needs two profiles at least, not {per_stratum}")
    sample = materialize(stratified_sample(signatures, per_stratum, seed, method), "sample")
    seen = sampled_partners(signatures, sample, threshold, tables)
    strata = materialize(
        seen.groupBy("stratum", "tables").agg(
            F.any_value("stratum_size").alias("profiles"), F.count(F.lit(1)).alias("sampled"),
            F.avg("partners").alias("mean_partners"), F.avg("hits").alias("mean_hits"),
            F.var_samp("partners").alias("var_partners"), F.var_samp("hits").alias("var_hits"),
            F.covar_samp("partners", "hits").alias("covariance"),
        ),
        "strata",
    )
    inside = signatures.agg(F.coalesce(F.sum(F.floor(F.col("members") * (F.col("members") - 1) / 2)), F.lit(0)).alias("inside"))
    totals = (
        strata.groupBy("tables")
        .agg(
            F.sum("profiles").alias("profiles"), F.sum("sampled").alias("sampled"),
            (F.sum(F.col("profiles") * F.col("mean_partners")) / 2).alias("partners"),
            (F.sum(F.col("profiles") * F.col("mean_hits")) / 2).alias("met"),
        )
        .crossJoin(inside)  # one row
        .select("tables", "profiles", "sampled", (F.col("partners") + F.col("inside")).alias("true_pairs"), (F.col("met") + F.col("inside")).alias("hits"))
        .withColumn("recall", F.try_divide("hits", "true_pairs"))
    )
    residual = F.col("var_hits") - 2 * F.col("recall") * F.col("covariance") + F.col("recall") * F.col("recall") * F.col("var_partners")
    unseen = F.col("profiles") * (F.col("profiles") - F.col("sampled")) / F.col("sampled")
    spread = strata.join(totals.select("tables", "recall"), "tables").groupBy("tables").agg(
        F.sum(F.when(F.col("profiles") > F.col("sampled"), unseen * F.greatest(residual, F.lit(0.0)) / 4).otherwise(F.lit(0.0))).alias("variance")
    )
    half = F.try_divide(F.lit(deviations) * F.sqrt("variance"), F.col("true_pairs"))
    counted = totals.join(spread, "tables").join(candidate_counts(signatures, tables), "tables")
    return counted.select(
        "tables", "profiles", "sampled", "candidates", "true_pairs", "hits",
        F.try_divide("hits", "candidates").alias("precision"),
        "recall",
        F.when(half.isNotNull(), F.greatest(F.col("recall") - half, F.lit(0.0))).alias("recall_low"),
        F.when(half.isNotNull(), F.least(F.col("recall") + half, F.lit(1.0))).alias("recall_high"),
    )


def pr_area(quality: DataFrame) -> DataFrame:
    """Area under the precision-recall points by trapezoids; one row per table count goes in."""
    points = quality.agg(F.sort_array(F.collect_list(F.struct("recall", "precision"))).alias("p"))
    area = F.aggregate(
        F.sequence(F.lit(2), F.size("p")),
        F.lit(0.0),
        lambda total, i: total
        + (F.element_at("p", i)["recall"] - F.element_at("p", i - 1)["recall"])
        * (F.element_at("p", i)["precision"] + F.element_at("p", i - 1)["precision"])
        / 2,
    )
    return points.select(F.coalesce(F.when(F.size("p") > 1, area), F.lit(0.0)).alias("pr_auc"))


def cluster_edges(pairs: DataFrame) -> DataFrame:
    """Similar profiles as graph edges for `graph.connected_components`."""
    return pairs.select(
        F.col("profile_a").alias("origin"), F.col("profile_b").alias("destination"), F.lit(1).alias("weight")
    )


_SET = ["profile", "size", "codes", "place"]


def _keyed(profile_rows: DataFrame, threshold: float) -> DataFrame:
    """Profiles at each of their rare tokens, with a hash that elects representatives."""
    rows = profile_rows.select("profile", "size", "codes", F.posexplode(_prefix(threshold)).alias("place", "key"))
    return rows.withColumn("draw", F.xxhash64("key", "profile"))


def _side(rows: DataFrame, name: str, *extra: str) -> DataFrame:
    return rows.select("key", *extra, *[F.col(column).alias(f"{column}_{name}") for column in _SET])


def star_links(keyed: DataFrame, threshold: float) -> DataFrame:
    """`profile_a, profile_b` of profiles closer than `threshold` to the representative of a rare token of theirs.

    At most one link for each profile and token, so a token that n similar profiles share
    costs n comparisons. Representatives are one row a token, which lets adaptive
    execution split the other side of the join where a token is crowded.
    """
    elected = keyed.groupBy("key").agg(F.min("draw").alias("draw"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    stars = _side(keyed.join(elected, ["key", "draw"]), "b")
    near = _side(keyed, "a").join(stars, "key").filter("profile_a <> profile_b").filter(_sizes_fit(threshold) & _enough_left(threshold))
    return _measured(near, threshold).select(F.least("profile_a", "profile_b").alias("profile_a"), F.greatest("profile_a", "profile_b").alias("profile_b")).distinct()


def cross_links(labelled: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """One link for every two components, by `component_id`, that some pair closer than `threshold` connects.

    Profiles of the same component need no comparison. A token that one component has
    for itself drops out, and the largest component of a token is only compared
    with the profiles of others.
    """
    sizes = labelled.groupBy("key", "component_id").agg(F.count(F.lit(1)).alias("n"))
    most = sizes.groupBy("key").agg(F.max(F.struct("n", "component_id")).alias("top"), F.count(F.lit(1)).alias("components"), F.sum("n").alias("all"))
    most = most.filter("components > 1").select("key", F.col("top.component_id").alias("largest"), F.col("top.n").alias("n"), (F.col("all") - F.col("top.n")).alias("others"))
    mixed = materialize(labelled.join(most, "key"), "mixed")
    large, others = mixed.filter("component_id = largest"), mixed.filter("component_id <> largest")

    made = most.agg(F.sum(F.col("n").cast("double") * F.col("others"))).first()[0] or 0.0
    spark = labelled.sparkSession
    partitions = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(made / PAIRS_PER_TASK))
    blocks = F.ceil(F.col("n") / block).cast("int")
    left = large.withColumn("block", F.pmod(F.xxhash64("profile"), blocks).cast("int"))
    right = others.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    sides = [
        _side(rows, name, "block", F.col("component_id").alias(f"component_{name}")).repartition(partitions, "key", "block")
        for rows, name in ((left, "a"), (right, "b"))
    ]
    among = _paired(others, ["key"], [*_SET, "component_id"], block).filter("component_id_a <> component_id_b")
    among = among.withColumnsRenamed({"component_id_a": "component_a", "component_id_b": "component_b"})
    columns = [*[f"{column}_{name}" for name in "ab" for column in _SET], "component_a", "component_b"]
    pairs = sides[0].join(sides[1], ["key", "block"]).select(columns).unionByName(among.select(columns))
    near = _measured(pairs.filter(_sizes_fit(threshold) & _enough_left(threshold)), threshold)
    return near.select(F.least("component_a", "component_b").alias("profile_a"), F.greatest("component_a", "component_b").alias("profile_b")).distinct()


def cluster_components(profile_rows: DataFrame, threshold: float) -> DataFrame:
    """`profile, component_id`: the smallest profile that pairs closer than `threshold` lead to.

    The components of all such pairs, without making the pairs: links to
    representatives join what is alike, and only what they left apart is compared.
    """
    keyed = materialize(_keyed(profile_rows, threshold), "keyed")

    def joined(links: DataFrame) -> DataFrame:
        return connected_components(cluster_edges(links)).withColumnRenamed("airport", "profile")

    stars = joined(materialize(star_links(keyed, threshold), "stars"))
    labels = profile_rows.select("profile").join(stars, "profile", "left").select("profile", F.coalesce("component_id", "profile").alias("component_id"))
    labels = materialize(labels, "labels")
    links = materialize(cross_links(keyed.join(labels, "profile"), threshold), "crossing")
    if links.isEmpty():
        return labels
    merged = joined(links).select(F.col("profile").alias("component_id"), F.col("component_id").alias("root"))
    return labels.join(merged, "component_id", "left").select("profile", F.coalesce("root", "component_id").alias("component_id"))


def clusters(bags: DataFrame, profile_rows: DataFrame, components: DataFrame) -> DataFrame:
    """Every group with the smallest group of its cluster; lone groups are their own."""
    labelled = profile_rows.join(components.withColumnRenamed("airport", "profile"), "profile", "left").select(
        "fingerprint", F.coalesce("component_id", "profile").alias("cluster_id")
    )
    return with_fingerprint(bags).join(labelled, "fingerprint").select("group_id", "cluster_id")
