"""Consolidating pairwise links into groups by random graph contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_estimates, cut_lineage

#: What may stand between the identifiers of a reference text.
SEPARATORS = r"[,;|/\s]+"
STATION_BLANK = r"(?<=^|[,;|/\s]|USGS[-:]|NWIS[-:])(\d{6}) (\d{9})(?=$|[,;|/\s])"


def contract(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(vertex, label): vertices of one connected component share a label, a vertex of it.

    Each round, every vertex hooks to the neighbour (or itself) that comes first in a fresh random
    order; edges are relabelled, loops and repeats dropped. When no edge is left, the rounds' mappings
    are chained. A vertex may hold any share of the edges: its neighbours are reduced to one on the map
    side. The edges forget the planner's estimates, whose digits would triple each round. Rows with a null
    end and loops are ignored; an empty table gives an empty result.
    """
    a, b = F.col(u).cast("long"), F.col(v).cast("long")
    left = cut_estimates(edges.where(a.isNotNull() & b.isNotNull() & (a != b)).select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).distinct())
    rounds: list[DataFrame] = []
    while not left.isEmpty():
        mark = F.lit(len(rounds) + 1)
        order = lambda c, m=mark: F.struct(F.xxhash64(m, F.col(c)).alias("h"), F.col(c).alias("x"))
        both = left.select("u", order("v").alias("to")).unionAll(left.select(F.col("v").alias("u"), order("u").alias("to")))
        hooks = both.groupBy("u").agg(F.min("to").alias("to"))
        hooks = cut_lineage(hooks.select(F.col("u").alias("vertex"), F.least("to", order("u"))["x"].alias("parent")))
        rounds.append(hooks)
        first = hooks.select(F.col("vertex").alias("u"), F.col("parent").alias("a"))
        second = hooks.select(F.col("vertex").alias("v"), F.col("parent").alias("b"))
        moved = left.join(first, "u").join(second, "v").where("a <> b")
        left = cut_estimates(moved.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct())
    if not rounds:
        return left.select(F.col("u").alias("vertex"), F.col("v").alias("label"))
    labels = rounds.pop().select("vertex", F.col("parent").alias("label"))
    while rounds:
        later = labels.select(F.col("vertex").alias("parent"), "label")
        labels = rounds.pop().join(later, "parent", "left").select("vertex", F.coalesce("label", "parent").alias("label"))
        if len(rounds) % 4 == 0:
            labels = cut_lineage(labels)
    return labels


def groups(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(vertex, group_id): group_id is the component's smallest vertex."""
    labels = contract(edges, u, v)
    least = labels.groupBy("label").agg(F.min("vertex").alias("group_id"))
    return labels.join(least, "label").select("vertex", "group_id")


def _plain(x: Column) -> Column:
    """Upper case, no surrounding blanks, prefix or blank inside a station number; null if it names nothing."""
    bare = F.regexp_replace(F.upper(F.trim(x)), STATION_BLANK, "$1$2")
    bare = F.trim(F.regexp_replace(bare, r"^(USGS|NWIS)[-:]", ""))
    return F.when(bare.rlike("[1-9]"), bare)


def identifier_links(sites: DataFrame) -> DataFrame:
    """Edges (u, v) between site rows that name one another or are one delivery twice.

    For each identifier that at least one row is known by and at least one refers to, all those rows
    are tied to the smallest of them: that connects the same rows as all pairs would.
    """
    uid = F.col("site_uid").cast("long").alias("uid")
    own, station = _plain(F.col("id")), _plain(F.col("usgs_site_id"))
    text = F.regexp_replace(F.upper(F.trim("alternate_site_id")), STATION_BLANK, "$1$2")
    referred = F.transform(F.split(text, SEPARATORS), _plain)
    record = F.concat(F.upper(F.trim("source")), F.lit("\u0001"), own)
    entry = lambda key, ref, known: F.struct(key.alias("key"), F.lit(ref).alias("ref"), F.lit(known).alias("known"))
    named = F.concat(
        F.array(entry(own, False, True), entry(station, True, True), entry(record, True, True)),
        F.coalesce(F.transform(referred, lambda x: entry(x, True, False)), F.array().cast("array<struct<key:string,ref:boolean,known:boolean>>")),
    )
    roles = sites.where("site_uid is not null").select(uid, F.explode(named).alias("e")).select("uid", "e.*").where("key is not null")
    keys = roles.groupBy("key").agg(F.min("uid").alias("least"), F.max("uid").alias("most"), F.max("ref").alias("ref"), F.max("known").alias("known"))
    keys = keys.where("ref and known and least < most").select("key", "least")
    return roles.select("key", "uid").join(keys, "key").where("uid <> least").select(F.col("least").alias("u"), F.col("uid").alias("v"))


def site_groups(sites: DataFrame) -> DataFrame:
    """(site_uid, group_uid) of every site row linked with another, directly or in chains.

    A row is known by id and usgs_site_id; it refers to usgs_site_id and to each identifier in
    alternate_site_id. Null, empty and placeholder texts (no digit but 0) name nothing; rows with a null
    site_uid are ignored; repeated rows join their copies' group. Other columns are ignored, and an
    empty table gives an empty result.
    """
    return groups(identifier_links(sites)).select(F.col("vertex").alias("site_uid"), F.col("group_id").alias("group_uid"))
