import json
from pathlib import Path

import numpy as np
import pytest

pytest.importorskip("wellframe.llm")
from wellframe.llm import components, encoding, leakage, linkage, percentiles, residue  # noqa: E402

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"


# percentiles


def exact(values, p):
    s = sorted(v for v in values if v is not None and v == v)
    return s[max(1, -(-len(s) * p // 100)) - 1]


def test_percentiles_are_exact(spark):
    rng = np.random.default_rng(1)
    v = [*map(float, rng.normal(0, 1e6, 300)), *map(float, rng.normal(0, 1e-300, 60)), 0.0, -0.0, 5e-324, -5e-324, 1e308, -1e308, float("inf"), float("-inf"), 1.0, 1.0, 2.0, None, float("nan")]
    rows = [("a", x, 1) for x in v] + [(None, 3.0, 1), (None, 4.0, 1), ("only null", None, 1)]
    got = {r.g: r for r in percentiles.percentiles(spark.createDataFrame(rows, "g string, v double, digit int"), ["g"], "v", [1, 25, 50, 99]).collect()}
    assert set(got) == {"a", None} and got["a"].n == len(v) - 2
    for p in (1, 25, 50, 99):
        assert got["a"][f"p{p:02d}"] == exact(v, p)
    assert got[None].p50 == 3.0 and got[None].p99 == 4.0
    assert percentiles.percentiles(spark.createDataFrame([], "g string, v double"), ["g"], "v", [50]).count() == 0


def test_parts_combine_within_bound(spark):
    rng = np.random.default_rng(2)
    rows = [("a", float(x), i % 7) for i, x in enumerate(rng.lognormal(0, 3, 2000) * rng.choice([-1, 1], 2000))]
    df = spark.createDataFrame(rows, "g string, v double, day int")
    parts = percentiles.histogram(df, ["g"], "v", [df["day"]])
    one = {r.percent: r for r in percentiles.histogram_percentiles(percentiles.merge(parts, ["g"]), ["g"], [1, 50, 99]).collect()}
    whole = {r.percent: r for r in percentiles.histogram_percentiles(percentiles.histogram(df, ["g"], "v"), ["g"], [1, 50, 99]).collect()}
    assert one == whole
    for p, r in one.items():
        true = exact([x[1] for x in rows], p)
        assert min(r.lower, r.upper) <= true <= max(r.lower, r.upper) and abs(r.value - true) <= abs(r.error) <= abs(true) * 2**-10


# components


def test_contraction_matches_union_find(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2001 + i) for i in range(50)] + [(5, 5), (None, 4), (1000, 1001)]
    got = {r.vertex: r.group_id for r in components.groups(spark.createDataFrame(edges, "u long, v long")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    assert got == {v: find(v) for v in parent}
    assert components.groups(spark.createDataFrame([], "u long, v long")).count() == 0


SITE = "site_uid long, source string, id string, usgs_site_id string, alternate_site_id string, key string, label long"


def site(uid, source, id, usgs=None, alt=None):
    return (uid, source, id, usgs, alt, "k", 1)


def test_identifiers_link_rows(spark):
    rows = [
        site(1, "A", "USGS-351803104515601"), site(2, "B", "X-1", "351803 104515601"), site(3, "C", "Y-9", None, "x-1; none"), site(4, "D", "Z-1", None, "shared"), site(5, "E", "Z-2", None, "shared"),
        site(6, "F", "Q-7"), site(7, "f ", " q-7 "), site(8, "G", "0"), site(9, "G", "0"), site(10, "H", "P-1", "000000000000000", "N/A"), site(11, "I", "P-2", "000000000000000", "UNKNOWN"), site(12, "J", None, None, None),
        site(None, "A", "X-1"), site(13, "K", "R-1", None, "361430 104542701|R-5"), site(14, "L", "NWIS:361430104542701"), site(15, "M", "R-1"), site(16, "N", "S", "S-5"), site(17, "O", "T", "s-5"),
    ]
    got = {r.site_uid: r.group_uid for r in components.site_groups(spark.createDataFrame(rows, SITE)).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 6: 6, 7: 6, 13: 13, 14: 13, 16: 16, 17: 16}  # no digit but 0, and names nobody is known by, link nothing


def test_numbered_identifiers_link(spark):
    rows = [site(16, "N", "S", "55"), site(17, "O", "T", " usgs-55")]
    assert {(r.site_uid, r.group_uid) for r in components.site_groups(spark.createDataFrame(rows, SITE)).collect()} == {(16, 16), (17, 16)}


# linkage

LEFT = "site_uid long, source string, id string, name string, latitude double, longitude double, well_depth double, well_depth_units string, place string, metres int"
RIGHT = LEFT.replace("site_uid", "pod_uid")


def test_linkage_decides(spark):
    left = [
        (1, "S", "a", "Selubvane Basin #11", 34.0, -106.0, 762.0, "ft", "", 1), (2, "S", "b", "Selubvane Basin 12", 34.0, -106.0, 344.0, "ft", "", 1), (3, "S", "c", None, 35.0, -105.0, 100.0, "ft", "", 1),
        (4, "S", "d", "Kelstow Bluff 9", None, None, 287.0, "ft", "", 1), (5, "S", "e", None, None, None, None, None, None, None), (None, "S", "f", "x 1", 34.0, -106.0, 1.0, "ft", "", 1), (6, "s", "A ", "SELUBVANE BASIN 11", 34.0, -106.0, 762.0, "ft", "", 1),
    ]
    right = [
        (101, "P", "p", "Sleubvane-Bsn 011", 34.0001, -106.0001, 232.4, "m", "", 1), (102, "P", "q", "", 35.0002, -105.0, 100.5, "FT", "", 1), (103, "P", "r", "kelstow bluf. windmill # 9", 36.0, -107.0, 288.0, "ft", "", 1),
        (104, "P", "s", "Selubvane Basin 40", 34.0001, -106.0001, 55.0, "ft", "", 1), (105, "P", "t", "well", None, None, 762.0, "ft", "", 1),
    ]
    got = {(r.site_uid, r.pod_uid): r.confidence for r in linkage.match(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)).collect()}
    assert set(got) == {(1, 101), (6, 101), (3, 102)} and all(0.5 <= c <= 1 for c in got.values())
    assert linkage.match(spark.createDataFrame([], LEFT), spark.createDataFrame(right, RIGHT)).count() == 0


@pytest.mark.parametrize("blank", [None, " ", "N/A"])
def test_rows_without_id_are_no_copies(spark, blank):
    left = [(i, "S", f"s{i}", f"Place{'abcdefghijkl'[i]} Basin {i + 11}", 33.0 + i / 10, -106.0, 100.0 + 20 * i, "ft", "", 1) for i in range(12)] + [(50 + i, "S", blank, None, 38.0 + i / 10, -104.0, 500.0 + 20 * i, "ft", "", 1) for i in range(12)]
    right = [(100 + r[0], "P", blank if r[0] < 50 else f"p{r[0]}", *r[3:]) for r in left]
    got = {(r.site_uid, r.pod_uid): r.confidence for r in linkage.match(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)).collect()}
    assert set(got) == {(r[0], 100 + r[0]) for r in left} and min(got.values()) > 0.7


def test_like_named_sites_apart_are_no_rivals(spark):
    left = [(i, "S", f"s{i}", "Kelstow Bluff 9", 32.0 + i / 10, -106.0, None, "ft", "", 1) for i in range(12)]
    right = [(100 + r[0], "P", f"p{r[0]}", *r[3:]) for r in left]
    got = {(r.site_uid, r.pod_uid): r.confidence for r in linkage.match(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)).collect()}
    assert set(got) == {(i, 100 + i) for i in range(12)} and min(got.values()) > 0.7


def optimum(pairs, rules, steps=60_000):
    """The minimum of the same hinges by projected gradient descent, pairs of wells included."""
    groups = sorted({(p["l_well"], p["r_well"]) for p in pairs})
    of = np.array([groups.index((p["l_well"], p["r_well"])) for p in pairs])
    w = 1 / np.bincount(of)[of]
    y, z = np.full(len(pairs), 0.5), np.full(len(groups), 0.5)
    up, down, member = (np.array([p[c] if c == "member" else sum(p[c]) for p in pairs]) for c in ("up", "down", "member"))
    for _ in range(steps):
        gy, gz = -2 * up * (1 - y) + 2 * down * y, np.zeros(len(groups))
        for side, weight in (("l_well", rules.exclusive_left), ("r_well", rules.exclusive)):
            for g in {p[side] for p in pairs}:
                m = np.array([p[side] == g for p in pairs])
                gy[m] += 2 * weight * max(0.0, (w[m] * y[m]).sum() - 1) * w[m]
        one, two = np.maximum(0, y + member - 1 - z[of]), np.maximum(0, z[of] + member - 1 - y)
        gy += 2 * rules.transitive * (one - two)
        np.add.at(gz, of, 2 * rules.transitive * (two - one))
        y, z = np.clip(y - 0.003 * gy, 0, 1), np.clip(z - 0.003 * gz, 0, 1)
    return y


@pytest.mark.parametrize("hot", [100_000, 1])
def test_alternating_directions_reach_the_minimum(spark, hot):
    rng = np.random.default_rng(8)
    pairs = [{"l": i, "r": int(rng.integers(0, 4)), "l_well": int(rng.integers(0, 5)), "r_well": int(rng.integers(0, 4)), "member": float(rng.choice([1.0, 0.9])), "up": [float(x) for x in rng.uniform(0.5, 4, 3)], "down": [1.8, float(rng.uniform(0.1, 3))]} for i in range(14)]
    pairs.append({"l": 99, "r": 99, "l_well": 99, "r_well": 99, "member": 1.0, "up": [3.0], "down": [1.8]})
    rules = linkage.Rules(rounds=60, block=10, tolerance=1e-3, hot=hot)
    df = spark.createDataFrame(pairs, "l long, r long, l_well long, r_well long, member double, up array<double>, down array<double>")
    got = {(r.l, r.r): r.confidence for r in linkage.solve(df, rules).collect()}
    want = optimum(pairs, rules)
    assert max(abs(got[p["l"], p["r"]] - y) for p, y in zip(pairs, want)) < 0.01


def test_rules_between_pairs_decide(spark):
    """Of two sites that could be one well of the other table only the better stays; a poorly described copy follows its well."""
    from dataclasses import replace

    left = [(1, "S", "a", "Kelstow Bluff 9", 34.0, -106.0, 300.0, "ft", "", 1), (2, "T", "b", None, 34.0005, -106.0, 301.0, "ft", "", 1), (3, "U", "c", "Rusimphar Llano 4", 35.0, -106.0, 200.0, "ft", "", 1), (4, "u", "C ", None, None, None, None, "ft", "", 1)]
    right = [(101, "P", "p", "Kelstow Bluff 9", 34.0001, -106.0, 300.0, "ft", "", 1), (102, "P", "q", "Rusimphar Llano 4", 35.0001, -106.0, 201.0, "ft", "", 1)]
    l, r = spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)
    found = lambda **kw: {(x.site_uid, x.pod_uid) for x in linkage.match(l, r, replace(linkage.Rules(), **kw)).collect()}
    assert found() == {(1, 101), (3, 102), (4, 102)}
    assert found(exclusive=0.0) == {(1, 101), (2, 101), (3, 102), (4, 102)}


def test_sites_of_one_well(spark):
    name = "Kelstow Bluff 9"
    rows = [
        (1, "S", "a", name, 34.0, -106.0, 300.0, "ft", "", 1), (2, "T", "b", name, 34.001, -106.001, None, "ft", "", 1), (3, "U", "c", name, 36.0, -106.0, 500.0, "ft", "", 1), (4, "V", "d", name, None, None, 300.0, "ft", "", 1),
        (5, "W", "e", name, None, None, 302.0, "ft", "", 1), (6, "X", "f", name, None, None, 900.0, "ft", "", 1), (7, "s", "A ", None, None, None, None, "ft", "", 1), (8, "Y", "g", "Kelstow Bluff 8", 34.0, -106.0, 300.0, "ft", "", 1),
        (9, "Z", None, None, 34.0, -106.0, 300.0, "ft", "", 1), (10, "Z", None, None, 34.0, -106.0, 300.0, "ft", "", 1), (11, "Q", "h", name, None, None, None, "ft", "", 1), (12, "T", "i", name, 34.0, 179.9999, None, "ft", "", 1), (13, "T", "j", name, 34.0, -179.9999, None, "ft", "", 1),
    ]
    got = {}
    for r in linkage.wells(linkage.described(spark.createDataFrame(rows, LEFT), "site_uid")).collect():
        got.setdefault(r.well, set()).add(r.uid)
    assert sorted(map(sorted, got.values())) == [[1, 2, 4, 5, 7], [3], [6], [8], [9], [10], [11], [12, 13]]


def test_wells_under_many_ids_are_no_rivals(spark):
    """Rows of exactly equal description under other ids are one well: neither table's listings push one another out."""
    left = [(i, "S", f"s{i}", None, 35.0, -105.0, 300.0, "ft", "", 1) for i in range(4)] + [(20 + i, "S", f"t{i}", "Rusimphar Llano 4", 34.0, -106.0, 200.0, "ft", "", 1) for i in range(3)]
    right = [(100 + i, "P", f"p{i}", "Kelstow Bluff 9", 35.0001, -105.0, 301.0, "ft", "", 1) for i in range(30)] + [(200 + i, "P", f"q{i}", "Rusimphar Llano 4", 34.0001, -106.0, 201.0, "ft", "", 1) for i in range(30)]
    got = {(r.site_uid, r.pod_uid) for r in linkage.match(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)).collect()}
    assert got == {(l[0], r[0]) for l in left for r in right if (l[0] < 20) == (r[0] < 200)}


def test_estimates_of_contracted_groups_stay_small(spark):
    """The digits of the planner's estimate must not triple each round, or every later join works on millions of them."""
    order = np.random.default_rng(1).permutation(300)
    labels = components.groups(spark.createDataFrame([(int(a), int(b)) for a, b in zip(order[:-1], order[1:])], "u long, v long"))
    assert len(str(labels._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 1000
    assert {r.group_id for r in labels.collect()} == {0}


# encoding


@pytest.mark.skipif(not Path(VOCABULARY).exists(), reason="no vocabulary files")
def test_encoding_equals_the_library(spark):
    from tokenizers import Tokenizer

    rng = np.random.default_rng(4)
    texts = [None, "", "  ", "hello  world\n\n x", "héllo 😀😀 ½² ​ 漢字", "<|endoftext|>'s 're", "a" * 3000, "b" * 9000, "".join(rng.choice(list("aeinorstxy "), 30000, p=[0.09999] * 10 + [0.0001])), "".join(rng.choice(list("abcdefgh"), 2500)), "Depth 12.5 ft; " * 300, "aaa aa a aaaa", "\udc80bad".encode("utf-8", "replace").decode()]
    df = spark.createDataFrame([(i, t, [1]) for i, t in enumerate(texts)] + [(3, texts[3], [2])], "doc_id long, text string, ids array<int>")
    library = Tokenizer.from_file(VOCABULARY)
    library.encode_special_tokens = True
    rows = encoding.encode(df, VOCABULARY).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        assert r.ids == library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
    back = {v: k for k, v in json.load(open(VOCABULARY, encoding="utf-8"))["model"]["vocab"].items()}
    char = {c: b for b, c in encoding.byte_characters().items()}
    assert all(bytes(char[c] for i in r.ids for c in back[i]).decode() == (texts[r.doc_id] or "") for r in rows)
    assert encoding.encode(df.limit(0), VOCABULARY).count() == 0


@pytest.mark.skipif(not Path(VOCABULARY).exists(), reason="no vocabulary files")
def test_a_full_cache_and_endless_words():
    """A cache too small for the words of a few texts, and a word of thousands of letters, change nothing."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(VOCABULARY)
    rng = np.random.default_rng(4)
    texts = ["well one two three", "a" * 9000, None, "", "".join(rng.choice(list("abcdefghij"), 3000)), "four five six seven", "well one again", "  \n \t x"]
    small = encoding.Contractor(VOCABULARY, most_words=3)
    for part in (texts[:4], texts[4:], texts):
        offsets, ids = small.encode(part)
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [library.encode(t, add_special_tokens=False).ids if t else [] for t in part]


# leakage

ITEM = " ".join(f"word{i}" for i in range(60))


def test_runs_and_edited_copies(spark):
    w = ITEM.split()
    edited = w.copy()
    for i in (9, 19, 29, 39, 49):
        edited[i] = "other"
    docs = [
        (1, "before " + "-- ".join(w[10:23]).upper() + " after", 0), (2, " ".join(w[10:22]) + " after", 0), (3, " ".join(edited), 0), (4, None, 0), (5, "", 0), (6, "x " * 20000 + ITEM + " y" * 20000, 0), (None, ITEM, 0), (7, ITEM, 0), (7, ITEM, 0),
        (8, " ".join(w[:12]) + " z " + " ".join(w[12:24]), 0),
    ]
    items = [(100, ITEM), (101, None), (102, ""), (103, "short text"), (None, ITEM)]
    d, i = spark.createDataFrame(docs, "doc_id long, text string, item_id long"), spark.createDataFrame(items, "item_id long, text string")
    for most in (64_000_000, 200):
        rows = {r.doc_id: r for r in leakage.leaks(d, i, most_bytes=most).collect()}
        assert set(rows) == {1, 3, 6, 7} and rows[1].longest_run == 13 and rows[3].longest_run < 13 and rows[3].similarity >= 0.8 and rows[6].longest_run == 60
    assert {(r.doc_id, r.item_id) for r in leakage.found(d, i).collect()} == {(1, 100), (6, 100), (7, 100)}
    assert leakage.found(d, i.limit(0)).count() == 0 and leakage.found(d.limit(0), i).count() == 0


def test_edited_and_short_copies_of_shared_items(spark):
    w = [f"word{i}" for i in range(70)]
    edited = [x if i % 10 != 9 else "other" for i, x in enumerate(w)]
    stuffed = [x for i, v in enumerate(w) for x in ([v, "and"] if i % 4 == 3 else [v])]
    docs = [(1, "so " + " ".join(edited) + " end"), (2, "we said five words stand right here today"), (3, " ".join(stuffed)), (4, "nothing of note"), (5, "the very unlikely"), (6, " ".join(w[:40])), (7, "five words and then words stand far here right")]
    items = [(100 + i, " ".join(w)) for i in range(20)] + [(200, "Five words stand right here"), (201, "unlikely"), (202, None), (203, " ,. ")]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    wanted = {(1, 100 + k) for k in range(20)} | {(3, 100 + k) for k in range(20)} | {(6, 100 + k) for k in range(20)} | {(2, 200), (5, 201)}
    results = [sorted(map(tuple, leakage.leaks(d, i, most_bytes=most).collect())) for most in (64_000_000, 900)]
    assert results[0] == results[1] and {r[:2] for r in results[0]} == wanted and {r[2] for r in results[0] if r[0] == 3} == {4}


def test_all_copies_are_aligned():
    rng, words = np.random.default_rng(6), leakage.Words()
    for _ in range(300):
        item = [f"w{x}" for x in rng.integers(0, 30, rng.integers(1, 40))]
        text = [x for x in item for x in {0: [], 1: ["new"], 2: [x, "new"]}.get(int(rng.integers(0, 14)), [x])]
        text = [f"w{x}" for x in rng.integers(0, 30, 20)] + text + [f"w{x}" for x in rng.integers(0, 30, 20)]
        a, b = words.of(" ".join(text)), words.of(" ".join(item))
        score = leakage.align(a, b)[0]
        got = leakage.Items([(1, " ".join(item))], 5, words).compare(a, 13)
        assert score / (2 * len(b)) < 0.8 or (got and got[0][2] == score)
    # a text that holds a repeated pair once keeps too few of them
    assert leakage.Items([(1, "a b " * 20)], 5, words).compare(words.of("a b a"), 13) == []


def test_planted_copies_are_found():
    """Recall over edited copies of every similarity from 0.8 on, and equal rows for texts compared alone or together."""
    rng, words = np.random.default_rng(9), leakage.Words()
    names = [f"v{x}" for x in range(400)]
    items = [(k, " ".join(rng.choice(names, 70))) for k in range(12)] + [(50 + k, "one text that many items share " * 4) for k in range(12)]
    index = leakage.Items(items, 5, words)
    texts, planted = [], set()
    for k in range(400):
        i = int(rng.integers(0, 12))
        copy = items[i][1].split()
        for at in rng.choice(70, int(rng.integers(0, 10)), replace=False):
            copy[at] = "edited"
        texts.append(" ".join([*rng.choice(names, 30), *copy, *rng.choice(names, 30)]))
        if leakage.align(words.of(texts[-1]), index.words[i])[0] >= 0.8 * 140:
            planted.add((k, i))
    flat, starts = words.flat(leakage.pa.array(texts))
    rows = index.compare_all(flat, starts, 13)
    assert len(planted) > 200 and planted <= {(r[0], r[1]) for r in rows if r[4] >= 0.8}
    alone = [(k, *r) for k, t in enumerate(texts) for r in index.compare(words.of(t), 13)]
    assert sorted(alone) == sorted(rows)
    assert {r[0] for r in index.compare(words.of("so " + items[-1][1]), 13)} == set(range(50, 62))


def test_alignment_scores():
    a = np.array([9, 9, 1, 2, 3, 4, 5, 9], np.uint64)
    assert leakage.align(a, np.array([1, 2, 3, 4, 5], np.uint64)) == (10.0, 2, 7)
    assert leakage.align(a, np.array([1, 2, 7, 3, 4, 5], np.uint64))[0] == 9.0
    assert leakage.align(a, np.array([1, 2, 4, 5], np.uint64))[0] == 7.0


# residue

BAD = [
    "Depth to water at {{ site_name }} was {{depth}} ft.", "Dear ${OWNER_NAME}, your well", "Well [WELL NUMBER] is in use.", "Level %(level)s ft", "From {0} to {1}", "near <<site_name>>", "<INSERT SITE NAME>", "[insert count here] visits", "Casing undefined mm steel.",
    "on XX/XX/XXXX", "File: ________", "<?= $x ?>", "{% for a in b %}", "@@color@@", "#COUNT# ft", "~SITE NAME~", "__COUNTY__", "((LEVEL))", "&lt;site_name&gt;", "%year%", "$$LEVEL$$", "the map lorem ipsum dolor sit amet", "Edit me.", "xxxx xxx xxxx", "Depth: TBD\nOwner: TODO\nSite: xxx",
    "502 Bad Gateway\nnginx", "Access denied. Reference number 12.", "Please enable JavaScript to view this page. Cookie settings", "Traceback (most recent call last):\n  File \"render.py\", line 12, in page\nKeyError: 'well_depth'", "Loading...", '{"error": "unauthorized", "status": 401}', "Acceso denegado. No tiene permiso para ver este registro.",
    "On [date], [name of driller] drilled to [total depth] ft.", "Because of undefined, the well inventory was redrawn.", "Los datos de NaN son provisionales.", "The undefined cuttings suggest basalt.", "Texto de relleno Texto de relleno Texto de relleno", "Dummy text for layout Dummy text for layout Dummy text for layout",
    "Template: {{owner}} {{street}} {{phone}} {{date}}",
]
GOOD = [
    None, "", " \n\t", "Fields are written between double braces such as {{name}} and filled before printing; ours were filled.", "Formula used with {u < 0.01} for late time.", "Bracketed values [sic] are as written.", "In the code book, %s stands for percent saturation and $ for cost.",
    '{"place": "Ash", "depth": 646, "ok": true}', "Owners are listed as <unknown> in the 1956 ledger.", "Salt content is TBD for one sample only; the other 232 samples are reported below and were checked.", "After the portal move several users saw error 404 for a week, but the sampling round itself was never lost and the crew continued.",
    "The draft said lorem ipsum in one margin note, which the driller found funny; the final text has none.", "Well construction is unknown, though the gray cuttings suggest clay.", 'The pump controller showed "Error 12" on its panel because of low voltage, and the driller cleared it.', "Use `{{ site }}` in the form.\n```\n{{ a }} {{ b }}\n```", "## Heading one\n\nText with 5% loss and #3 casing.",
    "The driller wrote [sic] twice [sic] here.", "The log says [hard rock] at 40 ft.", "The null hypothesis was kept and the undefined value left out.", "The merge field is a name in braces. {{owner}} would be one, and the crew filled all of ours before the letters went out to the owners in June.",
    "A template has fields. {{owner}} is filled with the name. Fields such as {{street}} and {{phone}} follow, and the office checks each of the letters against the register before it prints and posts them to the owners of the wells.",
]


def test_residue_found_and_spared(spark):
    rows = [(i, t, "x") for i, t in enumerate(BAD)] + [(100 + i, t, "x") for i, t in enumerate(GOOD)] + [(None, BAD[0], "x"), (200, "fine text. " * 30000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, reason string")
    got = [r.doc_id for r in residue.residue(df).collect()]
    assert [BAD[i] for i in range(len(BAD)) if i not in got] == [] and [GOOD[i - 100] for i in got if i is not None and 100 <= i < 200] == []
    assert got.count(None) == 1 and 200 not in got
    assert residue.clean(df).count() == len(GOOD) + 1
    assert residue.residue(df.limit(0)).count() == 0


def test_context_and_density_decide(spark, monkeypatch):
    """Without the sentence's talk, texts about templates are taken for residue; without the density, templates that talk are spared; without company, every bracketed word counts."""
    texts = ["Fields such as {{name}} stand in the template and are filled before the letters are printed and sent to the owners.", "Template: {{owner}} {{street}} {{phone}} {{date}}", "The log says [hard rock] at 40 ft."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = lambda **kw: {r.doc_id for r in residue.residue(df, **kw).collect()}
    assert found() == {1}
    assert found(dense=2.0) == set() and found(several=1) == {1}
    monkeypatch.setattr(residue, "TALK", "(?!)")
    assert found() == {0, 1}


UNGATED = [
    "Dear (insert owner name here), the well was measured.", "Depth to water: NULL. Well visited in May.", "Static level from NULL to NULL", "Depth to water: nan. Well visited.", "Level NULL ft.", "INVALID DATE", "Level: UNDEFINED.", "YOUR`x`NAME HERE", "Sed do eiusmod tempor.",
    "test,test,test, test", "Test  test  test  test", "Code: 404", "Estado #500", "código: 503", "Vuelva a iniciar.", "Anmeldung erforderlich", "at run.main(App.scala:12)",
]


def samples(pattern, rng, n=40):
    """Texts that every alternative of a pattern matches, case changed at random."""
    from re import _parser as parser

    def one(parsed, branch):
        out = ""
        for kind, v in parsed:
            kind = str(kind)
            if kind == "LITERAL":
                out += chr(v)
            elif kind in ("NOT_LITERAL", "ANY"):
                out += "a"
            elif kind == "IN":
                names = [(str(k), x) for k, x in v]
                options = [chr(x) for k, x in names if k == "LITERAL"] + [chr(c) for k, x in names if k == "RANGE" for c in (x[0], x[1])] + ["4" for k, x in names if k == "CATEGORY" and "DIGIT" in str(x)] + ["b" for k, x in names if k == "CATEGORY" and "WORD" in str(x)] + [" " for k, x in names if k == "CATEGORY" and "SPACE" in str(x)]
                out += "k" if names[0][0] == "NEGATE" else options[rng.integers(len(options))] if "CATEGORY_NOT_WORD" not in str(v) else "-"
            elif kind in ("MAX_REPEAT", "MIN_REPEAT"):
                for _ in range(v[0] + int(rng.integers(0, min(v[1], v[0] + 2) - v[0] + 1))):
                    out += one(v[2], None)
            elif kind == "SUBPATTERN":
                out += one(v[-1], None)
            elif kind == "BRANCH":
                out += one(v[1][branch if branch is not None else rng.integers(len(v[1]))], None)
        return out

    plain = pattern.replace(r"[\p{Lu}_]", "[A-Z_]").replace(r"\p{Lu}", "[A-Z]").replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9")
    parsed = parser.parse(plain)
    tops = [len(v[1]) for k, v in parsed if str(k) == "BRANCH"]
    for branch in range(tops[0]) if tops else [None]:
        for _ in range(n):
            text = one(parsed, branch)
            yield text
            yield text.upper()


def test_cheap_tests_pass_what_grammars_match(spark):
    from pyspark.sql import functions as F

    got = {r.doc_id for r in residue.residue(spark.createDataFrame(list(enumerate(UNGATED)), "doc_id long, text string")).collect()}
    assert [t for i, t in enumerate(UNGATED) if i not in got] == []
    rng = np.random.default_rng(5)
    gate = residue.gates()
    text = F.col("text")
    filler = [v for k, v in residue.FILLER.items() if k != "repeated"]
    for patterns, name in ((residue.PLACEHOLDERS.values(), "may_mark"), (filler, "may_filler"), ([residue.NOTICES], "may_notice"), ([residue.FIELD], "may_fields")):
        for p in patterns:
            matched = [r.text for r in spark.createDataFrame([(t,) for t in samples(p, rng)], "text string").where(text.rlike(p)).collect()]
            passes = leakage.pc.match_substring_regex(leakage.pa.array(matched, leakage.pa.string()), gate[name]).to_pylist()
            assert matched and [t for t, ok in zip(matched, passes) if not ok] == []
