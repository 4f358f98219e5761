"""Matching wells across two tables that share no identifier.

Candidate pairs agree in two of place name with number, depth and location. Each weighted rule of soft logic
becomes a squared hinge over the pairs' truth values: one per similarity or difference of a pair; exclusivity
(a well has at most one partner, firmly for the right table, loosely for the left); transitivity (rows of one well have the same partners, by way of the truth
of the pair of wells). Their sum is convex and is minimised by alternating directions: every hinge has its own
copies of the truth values and moves them by its proximal step, the copies' mean is the next value, and
multipliers carry the differences on, until primal and dual residuals vanish. The values at the optimum are
the confidences; a pair is a match if its own exceeds one half.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.nearby import M_PER_DEGREE, usable_point
from ..session import cut_lineage
from .components import groups

#: Abbreviations of landscape words, the landscape words, and words for kinds of wells.
LANDSCAPE = {
    "arr": "arroyo", "bsn": "basin", "cien": "cienega", "cyn": "canyon", "drw": "draw", "flt": "flat", "holw": "hollow", "msa": "mesa",
    "orch": "orchard", "past": "pasture", "rch": "ranch", "rdg": "ridge", "spg": "spring", "tk": "tank", "xing": "crossing",
}
MORE_LANDSCAPE = ["bench", "bluff", "llano", "siding", "wash"]
KINDS = {"irrigation": "irr", "irr": "irr", "windmill": "wm", "wm": "wm", "piezometer": "piez", "piez": "piez", "domestic": "dom", "dom": "dom"}
#: An id that names no record.
NO_ID = r"^(?:[^\p{L}\p{N}]|0)*$|^(?:N/?A|NAN|NULL|NONE|UNKNOWN|UNNAMED|MISSING|TBD)$"
#: The attributes that matching uses.
DESCRIPTION = ["place", "land", "kind", "number", "depth", "lat", "lon"]
FILLERS = ["well", "wl", "wells", "no", "nr", "at", "the", "unknown", "unnamed", "none", "na"]


@dataclass(frozen=True)
class Rules:
    """Weights of the rules. Positive evidence pulls a pair's truth to 1, negative to 0.

    ``exclusive`` (a well of the right table has at most one partner), ``exclusive_left`` (the same for the
    left one, whose wells the right table may list several times over) and ``transitive`` weigh the rules
    between pairs (0 switches one off). ``step`` is the
    penalty of the alternating directions; they stop when no residual exceeds ``tolerance``, looked at every
    ``block`` rounds, or after ``rounds``. ``hot`` is the number of pairs of a well from which its sums are
    aggregated and joined instead of computed in a window.
    """

    same_name: float = 3.0
    like_name: float = 1.0
    other_name: float = 5.0
    other_number: float = 4.0
    other_kind: float = 1.0
    same_depth: float = 2.7
    like_depth: float = 2.3
    other_depth: float = 4.0
    close: float = 1.7
    near: float = 1.5
    around: float = 0.8
    off: float = 1.0
    far: float = 2.5
    prior: float = 1.8
    exclusive: float = 12.0
    exclusive_left: float = 0.3
    transitive: float = 2.0
    step: float = 6.0
    rounds: int = 40
    block: int = 5
    tolerance: float = 0.01
    hot: int = 100_000
    accept: float = 0.5


def described(df: DataFrame, uid: str) -> DataFrame:
    """The attributes that matching uses: place, landscape, number, kind, depth in feet, coordinates, entity."""
    text = F.lower(F.coalesce("name", F.lit("")))
    full = F.create_map(*[F.lit(x) for kv in LANDSCAPE.items() for x in kv])
    kinds = F.create_map(*[F.lit(x) for kv in KINDS.items() for x in kv])
    words = F.transform(F.regexp_extract_all(text, F.lit(r"(\p{L}+)")), lambda w: F.coalesce(full[w], w))
    land = [*LANDSCAPE.values(), *MORE_LANDSCAPE]
    metres = F.lower(F.trim(F.coalesce("well_depth_units", F.lit("")))).rlike("^m")
    depth = F.when(F.col("well_depth").isNotNull() & ~F.isnan("well_depth") & (F.col("well_depth") > 0), F.when(metres, F.col("well_depth") * 3.28084).otherwise(F.col("well_depth")))
    ok = usable_point(F.col("latitude"), F.col("longitude"))
    # a row without an id cannot be known to be a copy: it is a record of its own
    own = F.upper(F.trim(F.coalesce("id", F.lit(""))))
    record = F.when(own.rlike(NO_ID), F.xxhash64(F.lit("row"), F.col(uid).cast("long"))).otherwise(F.xxhash64(F.upper(F.trim(F.coalesce("source", F.lit("")))), own))
    return df.where(F.col(uid).isNotNull()).select(
        F.col(uid).cast("long").alias("uid"),
        F.array_join(F.filter(words, lambda w: ~w.isin(*land) & ~w.isin(*KINDS) & ~w.isin(*FILLERS)), " ").alias("place"),
        F.element_at(F.concat(F.filter(words, lambda w: w.isin(*land)), F.array(F.lit(""))), 1).alias("land"),
        F.element_at(F.concat(F.filter(F.transform(words, lambda w: kinds[w]), lambda k: k.isNotNull()), F.array(F.lit(""))), 1).alias("kind"),
        F.regexp_replace(F.regexp_extract(text, r"(\d+)\D*$", 1), "^0+(?=.)", "").alias("number"),
        depth.alias("depth"),
        F.when(ok, F.col("latitude")).alias("lat"),
        F.when(ok, F.col("longitude")).alias("lon"),
        record.alias("record"),
    )


def _near(x: Column, size: float, spread: bool) -> Column:
    """The cell of x, and with ``spread`` the neighbouring one it is nearer to: values within half a ``size`` meet."""
    at = F.floor(x / size)
    return F.array(at, at + F.when(x / size - at >= 0.5, 1).otherwise(-1)) if spread else F.array(at)


def _keys(df: DataFrame, spread: bool, reach: float, name_reach: float, depth_reach: float) -> DataFrame:
    """(uid, key): blocking keys, each of two attributes; one side also takes neighbouring cells and bands."""
    bands = F.when(F.col("depth").isNotNull(), _near(F.log("depth"), 2 * depth_reach, spread))
    grid = lambda size: F.when(F.col("lat").isNotNull(), F.flatten(F.transform(_near(F.col("lat"), size, spread), lambda a: F.transform(_near(F.col("lon"), size, spread), lambda b: F.xxhash64(a, b)))))
    named = (F.col("place") != "") & (F.col("number") != "")
    p = F.col("place")
    # a slip in a name of seven letters or more leaves its first or its last three as they are
    short = F.concat(F.array(p), F.transform(F.sequence(F.lit(1), F.length(p)), lambda i: F.concat(F.substring(p, F.lit(1), i - 1), F.substring(p, i + 1, F.length(p)))))
    ends = F.array(F.concat(F.lit("^"), F.substring(p, 1, 3)), F.concat(F.lit("$"), F.substring(p, -3, 3)))
    # names a letter longer or shorter than seven meet by both ways
    variants = F.when(F.length(p) > 7, ends).when(F.length(p) < 6, short).otherwise(F.concat(ends, short))
    none = F.array().cast("array<bigint>")
    by_name = F.when(named, F.flatten(F.transform(variants, lambda v: F.transform(bands, lambda b: F.xxhash64(F.lit(1), v, F.col("number"), b)))))
    by_place = F.when(named, F.transform(grid(2 * name_reach), lambda c: F.xxhash64(F.lit(2), F.col("land"), F.col("number"), c)))
    by_depth = F.flatten(F.transform(grid(2 * reach), lambda c: F.transform(bands, lambda b: F.xxhash64(F.lit(3), c, b))))
    all_keys = F.concat(*[F.coalesce(k, none) for k in (by_name, by_place, by_depth)])
    return df.select("uid", F.explode(F.array_distinct(all_keys)).alias("key"))


def candidates(left: DataFrame, right: DataFrame, reach: float = 0.0037, name_reach: float = 0.01, depth_reach: float = 0.03) -> DataFrame:
    """Distinct (l, r) of the pairs that share a blocking key: within ``reach`` degrees and ``depth_reach`` (of the
    logarithm) of depth, or of like name with one of the two, the place then within ``name_reach``."""
    a = _keys(left, False, reach, name_reach, depth_reach).withColumnRenamed("uid", "l")
    b = _keys(right, True, reach, name_reach, depth_reach).withColumnRenamed("uid", "r")
    return a.join(b, "key").select("l", "r").distinct()


def _evidence(pairs: DataFrame, rules: Rules) -> DataFrame:
    """Adds ``metres`` and ``up`` and ``down``, the weights of the rules that speak for and against a pair."""
    named = (F.col("l_place") != "") & (F.col("r_place") != "")
    edits = F.levenshtein("l_place", "r_place")
    letters = lambda c: F.array_sort(F.split(F.col(c), ""))
    same = (F.col("l_land") == F.col("r_land")) & ((edits <= 1) | ((edits == 2) & (letters("l_place") == letters("r_place"))))
    numbers = (F.col("l_number") != "") & (F.col("r_number") != "")
    number = F.col("l_number") == F.col("r_number")
    kinds = (F.col("l_kind") != "") & (F.col("r_kind") != "") & (F.col("l_kind") != F.col("r_kind"))
    gap = F.abs(F.log(F.col("l_depth") / F.col("r_depth")))
    metres = _metres("l_lat", "l_lon", "r_lat", "r_lon")
    w = lambda cond, weight: F.when(F.coalesce(cond, F.lit(False)), F.lit(weight)).otherwise(0.0)
    d = F.col("metres")
    up = [
        w(named & numbers & number & same, rules.same_name), w(named & numbers & number & ~same & (edits <= 2), rules.like_name),
        w(gap <= 0.0125, rules.same_depth), w((gap > 0.0125) & (gap <= 0.025), rules.like_depth),
        w(d <= 50, rules.close), w((d > 50) & (d <= 150), rules.near), w((d > 150) & (d <= 300), rules.around),
    ]
    down = [
        F.lit(rules.prior), w(named & ~same & (edits > 2), rules.other_name), w(numbers & ~number, rules.other_number), w(kinds, rules.other_kind),
        w(gap > 0.05, rules.other_depth), w((d > 300) & (d <= 20_000), rules.off), w(d > 20_000, rules.far),
    ]
    held = lambda cols: F.filter(F.array(*cols), lambda w: w > 0)
    return pairs.withColumn("metres", metres).withColumn("up", held(up)).withColumn("down", held(down))


def _sum(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, w: a + w)


def _sums(state: DataFrame, sums: list[tuple[list[str], str, Column]], hot: bool) -> DataFrame:
    """Adds sums over groups, each (keys, name, what): by windows, or, where a group is ``hot``, by partial sums joined back."""
    if not hot:
        return state.withColumns({name: F.sum(x).over(Window.partitionBy(*keys)) for keys, name, x in sums})
    out = state
    for keys, name, x in sums:
        out = out.join(state.groupBy(*keys).agg(F.sum(x).alias(name)), keys)
    return out


def solve(pairs: DataFrame, rules: Rules) -> DataFrame:
    """Confidence of each pair: (l, r, l_well, r_well, member, up, down) gains ``confidence``.

    ``up`` and ``down`` are arrays of weights, one squared hinge each; ``member`` is how surely a row belongs
    to its well. Pairs that share no well with another have only hinges of their own, whose minimum is their
    weights' mean; the others take part in the rounds.
    """
    keep = ["l", "r", "l_well", "r_well", "member", "up", "down"]
    alone = _sum(F.col("up")) / (_sum(F.col("up")) + _sum(F.col("down")))
    state = pairs.select(*keep)
    for side in ("l_well", "r_well"):
        state = state.join(state.groupBy(side).agg(F.count(F.lit(1)).alias(f"n_{side}")), side)
    state = cut_lineage(state)
    single = state.where("n_l_well = 1 and n_r_well = 1").select(*keep, alone.alias("confidence"))
    state = state.where("n_l_well > 1 or n_r_well > 1")
    most = state.agg(F.max(F.greatest("n_l_well", "n_r_well"))).first()[0]
    if most is None:
        return single
    hot = most > rules.hot
    # rows of one well count once in a group, however often it was delivered
    both = ["l_well", "r_well"]
    cut = cut_lineage if hot else (lambda df: df)
    state = cut(_sums(state, [(both, "copies", F.lit(1.0))], hot).withColumn("w", 1 / F.col("copies")))
    square = F.pow("w", F.lit(2.0))
    state = _sums(state, [(["r_well"], "q_r", square), (["l_well"], "q_l", square)], hot)
    zeros = lambda c: F.transform(c, lambda _: F.lit(0.0))
    fixed = [*keep, "copies", "w", "q_r", "q_l"]
    singles = ["m_r", "m_l", "t1y", "t1z", "t2y", "t2z"]
    state = cut_lineage(state.select(*fixed, alone.alias("y"), alone.alias("z"), zeros(F.col("up")).alias("m_up"), zeros(F.col("down")).alias("m_down"), *[F.lit(0.0).alias(m) for m in singles], F.lit(0.0).alias("residual")))
    state = cut(_sums(state, [(both, "mean", F.col("y"))], hot).withColumn("z", F.col("mean") / F.col("copies")).drop("mean"))
    rho, t, weight = rules.step, rules.transitive, {"l": rules.exclusive_left, "r": rules.exclusive}
    y, z = F.col("y"), F.col("z")
    for k in range(1, rules.rounds + 1):
        # rows of a well have the partner the well has, and the other way round
        push = 2 * t / (rho + 4 * t)
        one = push * F.greatest(F.lit(0.0), (y - F.col("t1y")) + F.col("member") - 1 - (z - F.col("t1z")))
        two = push * F.greatest(F.lit(0.0), (z - F.col("t2z")) + F.col("member") - 1 - (y - F.col("t2y")))
        s = state.withColumns({"x1y": y - F.col("t1y") - one, "x1z": z - F.col("t1z") + one, "x2z": z - F.col("t2z") - two, "x2y": y - F.col("t2y") + two})
        # at most one partner; a well's pairs agree on the truth of the pair of wells
        s_z = (F.col("x1z") + F.col("t1z") + F.col("x2z") + F.col("t2z")) / 2
        s = _sums(s, [(both, "s_z", s_z), (["l_well"], "s_l", F.col("w") * (y - F.col("m_l"))), (["r_well"], "s_r", F.col("w") * (y - F.col("m_r")))], hot)
        over = lambda side: F.col("w") * 2 * weight[side] * F.greatest(F.lit(0.0), F.col(f"s_{side}") - 1) / (rho + 2 * weight[side] * F.col(f"q_{side}"))
        # what speaks for and against the pair, one hinge each
        for_it = F.zip_with("up", "m_up", lambda w, m: F.when(y - m < 1, (2 * w + rho * (y - m)) / (2 * w + rho)).otherwise(y - m))
        against = F.zip_with("down", "m_down", lambda w, m: F.when(y - m > 0, rho * (y - m) / (2 * w + rho)).otherwise(y - m))
        s = s.withColumns({"x_up": for_it, "x_down": against, "x_l": y - F.col("m_l") - over("l"), "x_r": y - F.col("m_r") - over("r")})
        copies = [("x_l", "m_l"), ("x_r", "m_r"), ("x1y", "t1y"), ("x2y", "t2y")]
        total = sum((F.col(x) + F.col(m) for x, m in copies), _sum(F.col("x_up")) + _sum(F.col("m_up")) + _sum(F.col("x_down")) + _sum(F.col("m_down")))
        clip = lambda v: F.least(F.lit(1.0), F.greatest(F.lit(0.0), v))
        s = s.withColumns({"y1": clip(total / (F.size("up") + F.size("down") + len(copies))), "z1": clip(F.col("s_z") / F.col("copies"))})
        moved = lambda m, x: F.zip_with(m, x, lambda a, b: a + b - F.col("y1"))
        apart = lambda x: F.array_max(F.transform(x, lambda v: F.abs(v - F.col("y1"))))
        primal = F.greatest(*[F.abs(F.col(x) - F.col("y1")) for x, _ in copies], apart("x_down"), F.coalesce(apart("x_up"), F.lit(0.0)), F.abs(F.col("x1z") - F.col("z1")), F.abs(F.col("x2z") - F.col("z1")))
        dual = F.greatest(F.abs(F.col("y1") - y), F.abs(F.col("z1") - z))
        state = s.select(
            *fixed, F.col("y1").alias("y"), F.col("z1").alias("z"), moved("m_up", "x_up").alias("m_up"), moved("m_down", "x_down").alias("m_down"), *[(F.col(m) + F.col(x) - F.col("y1")).alias(m) for x, m in copies],
            (F.col("t1z") + F.col("x1z") - F.col("z1")).alias("t1z"), (F.col("t2z") + F.col("x2z") - F.col("z1")).alias("t2z"), F.greatest(primal, dual).alias("residual"),
        )
        # joined sums name the state several times, so it is written each round
        if hot or k % rules.block == 0 or k == rules.rounds:
            state = cut_lineage(state)
            left = state.agg(F.max("residual")).first()[0]
            if left <= rules.tolerance:
                break
    return single.unionByName(state.select(*keep, y.alias("confidence")))


def wells(sites: DataFrame, cell: float = 0.005, band: float = 0.025) -> DataFrame:
    """The described sites with ``well``, which rows of one well share.

    Rows of one record are one well. So are rows of one name and number whose places connect: in the same
    or adjoining cells, or, where no place is given, in the same or adjoining bands of depth; the latter join
    the placed well of that name and depth if there is only one. Rows meet in cells and bands, not in pairs,
    so a name may have any share of the rows.
    """
    named = (F.col("place") != "") & (F.col("number") != "")
    name = F.when(named, F.xxhash64(F.lit("n"), "place", "land", "number"))
    around = round(360 / cell)
    rows = sites.withColumns({"_name": name, "_i": F.floor(F.col("lat") / cell), "_j": F.floor(F.col("lon") / cell), "_b": F.floor(F.log("depth") / band)})
    spot = lambda i, j: F.xxhash64(F.lit("spot"), F.col("_name"), i, F.pmod(j, F.lit(around)))
    deep = lambda b: F.xxhash64(F.lit("deep"), F.col("_name"), b)
    placed = F.col("lat").isNotNull()
    i, j, b = F.col("_i"), F.col("_j"), F.col("_b")
    node = F.when(named & placed, spot(i, j)).when(named & b.isNotNull(), deep(b))
    beside = F.when(placed, F.array(*[spot(i + x, j + y) for x, y in ((0, 1), (1, -1), (1, 0), (1, 1))])).otherwise(F.array(deep(b + 1)))
    rows = cut_lineage(rows.withColumns({"_node": node, "_beside": beside}))
    known = rows.where("_node is not null")
    nodes = known.groupBy("_node").agg(F.min("record").alias("_least"), F.max("record").alias("_most"), F.first("_beside").alias("_beside"))
    near = nodes.select(F.col("_node").alias("u"), F.explode("_beside").alias("v")).join(nodes.select(F.col("_node").alias("v")), "v").select("u", "v").where("u <> v")
    # a cell of one record, with no cell beside it, ties nothing
    tying = nodes.where("_least <> _most").select("_node").unionAll(near.select("u")).unionAll(near.select("v")).distinct()
    held = known.select("record", "_node").distinct().join(tying, "_node")
    label = groups(held.select(F.col("record").alias("u"), F.col("_node").alias("v")).unionAll(near)).select(F.col("vertex").alias("record"), F.col("group_id"))
    rows = cut_lineage(rows.join(label, "record", "left").withColumn("well", F.coalesce("group_id", "record")))
    at = rows.where(named & placed & b.isNotNull()).groupBy("_name", "_b").agg(F.min("well").alias("_lo"), F.max("well").alias("_hi"))
    lost = rows.groupBy("well").agg(F.max(placed).alias("_placed")).where("not _placed").select("well")
    asked = rows.where(named & ~placed & b.isNotNull()).join(lost, "well").select("well", "_name", F.explode(F.array(b - 1, b, b + 1)).alias("_b")).distinct()
    joined = asked.join(at, ["_name", "_b"]).groupBy("well").agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi")).where("_lo = _hi").select("well", "_lo")
    return rows.join(joined, "well", "left").select(*sites.columns, F.coalesce("_lo", "well").alias("well"))


def alike(rows: DataFrame) -> DataFrame:
    """Adds ``look``, a digest of the description, and gives wells with rows of exactly equal description one ``well``.

    Nothing that is known tells such wells apart, so they must not be each other's rivals, however many ids the
    well is listed under. Only descriptions with two of name with number, depth and location tie wells.
    """
    rows = cut_lineage(rows.withColumn("look", F.xxhash64(*DESCRIPTION, *[F.col(c).isNull() for c in DESCRIPTION])))
    named = (F.col("place") != "") & (F.col("number") != "")
    speaks = sum((x.cast("int") for x in (named, F.col("depth").isNotNull(), F.col("lat").isNotNull())), F.lit(0))
    known = rows.where(speaks >= 2).select("well", "look")
    shared = known.groupBy("look").agg(F.min("well").alias("u"), F.max("well").alias("most")).where("u <> most").select("look", "u")
    label = groups(known.join(shared, "look").select("u", F.col("well").alias("v"))).select(F.col("vertex").alias("well"), "group_id")
    return cut_lineage(rows.join(label, "well", "left").withColumn("well", F.coalesce("group_id", "well")).drop("group_id"))


def _distinct(rows: DataFrame, prefix: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of one well and equal description as one, named by the smallest uid; the records of each; all rows by record."""
    one = cut_lineage(rows.groupBy("well", "look", *DESCRIPTION).agg(F.min("uid").alias("uid"), F.max("member").alias("member")))
    records = rows.select("well", "look", F.col("record").alias(f"{prefix}_record")).distinct().join(one.select("well", "look", F.col("uid").alias(prefix)), ["well", "look"]).select(prefix, f"{prefix}_record")
    return one, records, rows.select(F.col("uid").alias(prefix), F.col("record").alias(f"{prefix}_record"), F.col("lat").alias(f"{prefix}_lat"), F.col("lon").alias(f"{prefix}_lon"))


def _metres(lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    h = F.pow(F.sin(F.radians(F.col(lat2) - F.col(lat1)) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(F.col(lon2) - F.col(lon1)) / 2), 2)
    return 360 / 3.141592653589793 * M_PER_DEGREE * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def match(sites: DataFrame, pods: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """(site_uid, pod_uid, confidence, distance_m) of the pairs held to be one well.

    Attributes may be null, empty, placeholders, misspelt or out of range; those say nothing. Pairs of which
    fewer than two of name with number, depth and location can be compared are never candidates. Rows with
    a null key are ignored; rows delivered again (same source and id) match as their copies do, whatever else
    they hold; rows without an id are copies of nothing. Rows of equal description are compared once, and the
    wells they describe count once, under however many ids. Sites of one name count as one well only where their
    places agree. Other columns, also of the same names in both tables, do no harm; an empty table gives an empty result.
    """
    # a row that shares its well by record is surely of it, one by name and place nearly so
    sure = F.when(F.col("well") == F.col("record"), 1.0).otherwise(0.9)
    left, left_records, left_rows = _distinct(alike(wells(cut_lineage(described(sites, "site_uid"))).withColumn("member", sure)), "l")
    right, right_records, right_rows = _distinct(alike(described(pods, "pod_uid").withColumns({"well": F.col("record"), "member": F.lit(1.0)})), "r")
    side = lambda df, p: df.select(*[F.col(c).alias(f"{p}_{c}") for c in df.columns]).withColumnRenamed(f"{p}_uid", p)
    pairs = _evidence(candidates(left, right).join(side(left, "l"), "l").join(side(right, "r"), "r"), rules)
    # pairs of which nothing but exclusivity, which only lowers them, and their copies could change the verdict
    hopeful = pairs.where(_sum(F.col("up")) >= 0.8 * rules.accept * (_sum(F.col("up")) + _sum(F.col("down"))))
    hopeful = cut_lineage(hopeful.select("l", "r", "l_well", "r_well", F.col("l_member").alias("member"), "up", "down"))
    solved = solve(hopeful, rules).where(F.col("confidence") >= rules.accept).select("l", "r", "confidence")
    held = solved.join(left_records, "l").join(right_records, "r").groupBy("l_record", "r_record").agg(F.max("confidence").alias("confidence"))
    rows = held.join(left_rows, "l_record").join(right_rows, "r_record")
    return rows.select(F.col("l").alias("site_uid"), F.col("r").alias("pod_uid"), "confidence", _metres("l_lat", "l_lon", "r_lat", "r_lon").alias("distance_m"))
