"""Wells of different agencies that are one well: by identifiers, by place, and as groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators.components import smallest_labels
from ..operators.nearby import pairs_within, usable_point
from ..session import cut_lineage

POD_SOURCE = "NMOSEPOD"
#: Confidences of links.
EXPLICIT, SPATIAL_BASE, CLOSE_BONUS, DEPTH_BONUS, ELEVATION_BONUS, NAME_BONUS, SPATIAL_MOST = 0.95, 0.35, 0.10, 0.25, 0.12, 0.10, 0.9


def with_pods(sites: DataFrame, pods: DataFrame) -> DataFrame:
    """Sites and points of diversion as one table of sites."""
    as_sites = pods.select(F.col("pod_uid").alias("site_uid"), *[c for c in sites.columns if c in pods.columns])
    return sites.unionByName(as_sites, allowMissingColumns=True)


def canonical(sites: DataFrame) -> DataFrame:
    """First row per (source, id), with what it is known by and refers to, words and feet.

    A well is known by its id, its usgs_site_id and station numbers written in them or its name; it refers to
    its usgs_site_id, the identifiers in alternate_site_id and station numbers in these or its name.
    Placeholders (no digit but 0) name nothing.
    """
    key = F.concat(C.normalize_id(F.col("source")), F.lit(":"), F.trim("id"))
    rows = sites.where("source is not null and id is not null").withColumn("site_key", key)
    first = rows.groupBy("site_key").agg(F.min_by(F.struct("site_uid", "source", "id", "name", "latitude", "longitude", "elevation", "elevation_units", "well_depth", "well_depth_units", "usgs_site_id", "alternate_site_id"), "site_uid").alias("s")).select("site_key", "s.*")
    ft = lambda v, u: F.when(~F.isnan(v), C.length_in(F.col(v), F.col(u), "ft"))
    real = lambda a: F.filter(F.array_distinct(F.flatten(a)), lambda k: k.rlike("[1-9]"))
    stations = lambda *cols: F.flatten(F.array(*[C.station_keys(F.col(c)) for c in cols]))
    known = real(F.array(C.match_keys(F.col("id")), C.match_keys(F.col("usgs_site_id")), stations("id", "usgs_site_id", "name")))
    refs = real(F.array(C.match_keys(F.col("usgs_site_id")), F.flatten(F.transform(C.references(F.col("alternate_site_id")), C.match_keys)), stations("usgs_site_id", "alternate_site_id", "name")))
    words = F.array_union(C.name_tokens(F.col("name")), C.name_tokens(F.col("id")))
    return first.select("site_key", "site_uid", "source", "id", "name", "latitude", "longitude", "well_depth", ft("elevation", "elevation_units").alias("elevation_ft"), ft("well_depth", "well_depth_units").alias("depth_ft"),
                        known.alias("known"), refs.alias("refs"), words.alias("tokens"))


def explicit_links(c: DataFrame) -> DataFrame:
    """(a, b, a_uid, b_uid) with a < b: one well refers to an identifier the other is known by."""
    r = c.select(F.struct("site_key", "site_uid").alias("x"), F.explode("refs").alias("k"))
    k = c.select(F.struct("site_key", "site_uid").alias("y"), F.explode("known").alias("k"))
    pairs = r.join(k, "k").where("x.site_key <> y.site_key").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    return pairs.select(F.col("a.site_key").alias("a"), F.col("b.site_key").alias("b"), F.col("a.site_uid").alias("a_uid"), F.col("b.site_uid").alias("b_uid"))


def spatial_links(c: DataFrame, most_m: float = 150.0, most_depth: float = 50.0, most_elevation: float = 20.0) -> DataFrame:
    """(a, b, distance_m, confidence) of nearby wells of different agencies that nothing speaks against.

    Base 0.35; 0.10 within a third of the distance; 0.25 and 0.12 for depths and elevations that agree (a
    greater difference rejects); 0.10 for a shared word; at most 0.9.
    """
    near = pairs_within(c, "site_uid", "latitude", "longitude", most_m)
    cols = ["site_key", "source", "elevation_ft", "depth_ft", "tokens"]
    side = lambda p, key: c.select(F.col("site_uid").alias(key), *[F.col(x).alias(f"{p}_{x}") for x in cols])
    j = near.join(side("l", "left_key"), "left_key").join(side("r", "right_key"), "right_key").where("l_source <> r_source")
    gap = lambda x: F.abs(F.col(f"l_{x}") - F.col(f"r_{x}"))
    j = j.where((F.coalesce(gap("depth_ft"), F.lit(0.0)) <= most_depth) & (F.coalesce(gap("elevation_ft"), F.lit(0.0)) <= most_elevation))
    score = (
        SPATIAL_BASE + F.when(F.col("distance_m") <= most_m / 3, CLOSE_BONUS).otherwise(0.0) + F.when(gap("depth_ft").isNotNull(), DEPTH_BONUS).otherwise(0.0)
        + F.when(gap("elevation_ft").isNotNull(), ELEVATION_BONUS).otherwise(0.0) + F.when(F.arrays_overlap("l_tokens", "r_tokens"), NAME_BONUS).otherwise(0.0)
    )
    left_first = F.col("l_site_key") < F.col("r_site_key")
    pick = lambda x, first: F.when(left_first == F.lit(first), F.col(f"l_{x}")).otherwise(F.col(f"r_{x}"))
    return j.select(pick("site_key", True).alias("a"), pick("site_key", False).alias("b"), pick("source", True).alias("a_source"), pick("source", False).alias("b_source"), "distance_m", F.least(F.lit(SPATIAL_MOST), score).alias("confidence"),
                    F.when(left_first, F.col("left_key")).otherwise(F.col("right_key")).alias("a_uid"), F.when(left_first, F.col("right_key")).otherwise(F.col("left_key")).alias("b_uid"))


def mutual_best(links: DataFrame) -> DataFrame:
    """Links in which each side is the other's best within its agency: confidence, distance, key."""
    both = links.select("a", "b", F.col("b_source").alias("s"), "distance_m", "confidence").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("a_source").alias("s"), "distance_m", "confidence"))
    w = Window.partitionBy("a", "s").orderBy(F.desc("confidence"), "distance_m", "b")
    best = both.withColumn("rank", F.row_number().over(w)).where("rank = 1").select("a", "b")
    swapped = best.select(F.col("b").alias("a"), F.col("a").alias("b"))
    mutual = best.join(swapped, ["a", "b"]).where("a < b")
    return links.join(mutual, ["a", "b"], "left_semi")


def _quoted(x) -> F.Column:
    return F.concat(F.lit('"'), F.regexp_replace(x, r'(["\\\\])', r"\\\\$1"), F.lit('"'))


def crosswalk(sites: DataFrame, pods: DataFrame | None = None, pod_m: float = 150.0, most_listed: int | None = None) -> DataFrame:
    """Every well with its group: its size, agencies and other members, how and how surely it was matched, and its points of diversion.

    Points of diversion (source NMOSEPOD, in ``sites`` or ``pods``) are wells like others; a group without one
    gets the nearest within ``pod_m`` of a member, of equally near ones the smaller id. ``cluster_id`` is a digest
    of the sorted keys of the group. Every row lists all other members, so a group's rows grow as its size squared;
    large groups are spread over tasks. Only if a caller gives ``most_listed``, larger groups list no members (null) and
    their digest is that of counts and sums of key hashes.
    """
    c = cut_lineage(canonical(with_pods(sites, pods) if pods is not None else sites))
    explicit = cut_lineage(explicit_links(c))
    spatial = cut_lineage(mutual_best(spatial_links(c)))
    edges = explicit.select("a_uid", "b_uid", F.lit(None).cast("double").alias("confidence")).unionAll(spatial.select("a_uid", "b_uid", "confidence"))
    roots = cut_lineage(smallest_labels(edges.select(F.col("a_uid").alias("a"), F.col("b_uid").alias("b"))))
    per = edges.join(roots, edges["a_uid"] == roots["node"]).groupBy("root").agg(F.max(F.col("confidence").isNull()).alias("e"), F.max(F.col("confidence").isNotNull()).alias("s"), F.max("confidence").alias("best"))
    agency = C.normalize_id(F.col("source"))
    wells = c.select("site_key", "site_uid", "source", "id", "name", "latitude", "longitude", "well_depth", agency.alias("agency"), (agency == POD_SOURCE).alias("is_ose_pod"))
    wells = cut_lineage(wells.join(roots.select(F.col("node").alias("site_uid"), "root"), "site_uid", "left").withColumn("root", F.coalesce("root", "site_uid")))
    size = wells.groupBy("root").agg(F.count(F.lit(1)).alias("cluster_size"), F.count_distinct("agency").alias("n_agencies"), F.max("is_ose_pod").alias("has_pod"), F.bit_xor(F.xxhash64("site_key")).alias("x"), F.sum(F.xxhash64("site_key").cast("decimal(38,0)")).alias("y"))
    loose = F.concat_ws("|", F.col("cluster_size").cast("string"), F.col("x").cast("string"), F.col("y").cast("string"))
    held = wells if most_listed is None else wells.join(size.where(F.col("cluster_size") <= most_listed).select("root"), "root")
    listed = held.groupBy("root").agg(F.array_sort(F.collect_list(F.struct("site_key", "agency", "id", "is_ose_pod"))).alias("members"))
    keys = F.array_join(F.transform("members", lambda m: m["site_key"]), "|")
    group = size.join(listed, "root", "left").join(per, "root", "left").withColumn("cluster_id", F.concat(F.lit("wc_"), F.substring(F.sha1(F.coalesce(keys, loose)), 1, 12)))
    # groups without a point of diversion: the nearest one within reach of a member
    near = pods_within(wells.where("not is_ose_pod").join(size.where("not has_pod").select("root"), "root"), wells.where("is_ose_pod").select(F.col("site_uid").alias("pod_uid"), "latitude", "longitude"), pod_m)
    near = near.join(wells.select(F.col("site_uid").alias("pod_uid"), F.col("id").alias("pod_id")), "pod_uid").join(wells.select("site_uid", "root"), "site_uid").groupBy("root").agg(F.min(F.struct("distance_m", "pod_id")).alias("near"))
    # a large group's list is handed to several parts of its rows
    parts = F.ceil(F.col("cluster_size") / 250).cast("long")
    rows = wells.join(size.select("root", "cluster_size"), "root").withColumn("part", F.pmod(F.xxhash64("site_key"), parts)).drop("cluster_size")
    group = group.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    out = rows.join(group, ["root", "part"]).join(near.select("root", F.col("near.pod_id").alias("near_pod")), "root", "left")
    others = F.filter("members", lambda m: m["site_key"] != F.col("site_key"))
    agencies = F.array_sort(F.array_distinct(F.transform(others, lambda m: m["agency"])))
    by_agency = F.transform(agencies, lambda a: F.concat(_quoted(a), F.lit(": ["), F.array_join(F.transform(F.array_sort(F.transform(F.filter(others, lambda m: m["agency"] == a), lambda m: m["id"])), _quoted), ", "), F.lit("]")))
    own = F.array_sort(F.array_distinct(F.transform(F.filter(others, lambda m: m["is_ose_pod"]), lambda m: m["id"])))
    linked = F.col("cluster_size") > 1
    return out.select(
        "site_key", "source", "id", "name", "well_depth", "cluster_id", "cluster_size", "n_agencies", (F.col("cluster_size") - 1).alias("n_linked"),
        F.array_join(F.transform(others, lambda m: m["site_key"]), ",").alias("linked_site_ids"), F.concat(F.lit("{"), F.array_join(by_agency, ", "), F.lit("}")).alias("linked_by_agency"),
        F.coalesce("near_pod", F.array_join(own, ",")).alias("ose_pod_ids"), F.when(F.col("near_pod").isNotNull(), "spatial").when(F.size(own) > 0, "explicit").otherwise("none").alias("ose_pod_link_method"),
        F.when(~linked, "unmatched").when(F.col("e") & F.col("s"), "mixed").when(F.col("e"), "explicit").otherwise("spatial").alias("match_method"),
        F.when(~linked, 0.0).when(F.col("e"), EXPLICIT).otherwise(F.round("best", 3)).alias("match_confidence"), "is_ose_pod",
    )


def pods_within(sites: DataFrame, pods: DataFrame, most_m: float = 150.0) -> DataFrame:
    """(site_uid, pod_uid, distance_m) of the points of diversion within reach of each well."""
    a = sites.where("site_uid is not null").select(F.col("site_uid").alias("uid"), "latitude", "longitude", F.lit(False).alias("pod"))
    b = pods.where("pod_uid is not null").select(F.col("pod_uid").alias("uid"), "latitude", "longitude", F.lit(True).alias("pod"))
    both = a.unionAll(b)
    near = pairs_within(both, "uid", "latitude", "longitude", most_m)
    kind = both.select("uid", "pod")
    j = near.join(kind.select(F.col("uid").alias("left_key"), F.col("pod").alias("lp")), "left_key").join(kind.select(F.col("uid").alias("right_key"), F.col("pod").alias("rp")), "right_key").where("lp <> rp")
    site, pod = F.when(F.col("lp"), F.col("right_key")).otherwise(F.col("left_key")), F.when(F.col("lp"), F.col("left_key")).otherwise(F.col("right_key"))
    return j.select(site.alias("site_uid"), pod.alias("pod_uid"), "distance_m")


def nearest_pods(sites: DataFrame, pods: DataFrame, most_m: float = 150.0) -> DataFrame:
    """The nearest point of diversion of each well within reach; of equally near ones the smaller key."""
    best = pods_within(sites, pods, most_m).groupBy("site_uid").agg(F.min(F.struct("distance_m", "pod_uid")).alias("m"))
    return best.select("site_uid", F.col("m.pod_uid").alias("pod_uid"), F.round("m.distance_m", 3).alias("distance_m"))
