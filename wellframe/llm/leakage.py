"""Held-out test passages inside corpus texts.

Five-word seeds of the test items are looked up in every text; runs of equal words show as runs of seeds, so
none is missed. Edited copies are found by pairs of words: an item of L words that aligns with similarity s
keeps all but 2(1 - s)L of its L - 1 pairs (a word put in breaks one pair for 1 of the 2L points, a changed or
dropped word two for 3). Of one pair more than may break, any choice holds one that is kept; the item's
rarest are looked up, then all its pairs counted, and stretches with enough of them are aligned with the item
word by word (Smith-Waterman). Rarity only orders the work, so results do not depend on the other items.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread

ALIGNED = "doc_id long, item_id long, longest_run int, score double, similarity double, seeds int, doc_start int, doc_end int"
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Words:
    """Texts as arrays of word numbers: equal words, case ignored, have equal hashes in every process."""

    def __init__(self, most: int = 1_000_000):
        import xxhash

        self.hash = xxhash.xxh64_intdigest
        self.known: dict[str, int] = {}
        self.most = most

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The words of all texts one after the other, and the place of each text's first word (and the end)."""
        lists = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")), r"[^\p{L}\p{N}]+")
        codes = lists.flatten().dictionary_encode()
        if len(self.known) > self.most:
            self.known.clear()
        known = self.known
        for w in codes.dictionary.to_pylist():
            if w not in known:
                known[w] = self.hash(w)
        numbers = np.fromiter((known[w] for w in codes.dictionary.to_pylist()), np.uint64, len(codes.dictionary))
        empty = codes.dictionary.index(pa.scalar("", codes.dictionary.type)).as_py()
        index, real = codes.indices.to_numpy(), np.ones(len(codes), bool)
        if empty >= 0:
            real = index != empty
        starts = np.r_[0, np.cumsum(real)][lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        return numbers[index[real]] if len(numbers) else np.zeros(0, np.uint64), starts

    def of(self, text: str | None) -> np.ndarray:
        return self.flat(pa.array([text], pa.string()))[0]


def seeds_of(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each position on."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            out = (out * _MIX) ^ words[i : len(words) - n + 1 + i]
            out ^= out >> np.uint64(29)
    return out


def align(a: np.ndarray, b: np.ndarray, match: float = 2.0, miss: float = -1.0, gap: float = -1.0) -> tuple[float, int, int]:
    """Best local alignment of two word arrays: score, and the stretch of ``a`` it starts from and ends in."""
    return align_all([(a, b)], match, miss, gap)[0]


def align_all(pairs: list[tuple[np.ndarray, np.ndarray]], match: float = 2.0, miss: float = -1.0, gap: float = -1.0, cells: int = 200_000) -> list[tuple[float, int, int]]:
    """``align`` of many pairs at once (Smith-Waterman): a row of every pair's table per step, pairs of like size together."""
    out: list[tuple[float, int, int]] = [(0.0, 0, 0)] * len(pairs)
    order = sorted(range(len(pairs)), key=lambda i: (len(pairs[i][1]), len(pairs[i][0])))
    at = 0
    while at < len(order):
        wide = len(pairs[order[at]][1])
        take = [i for i in order[at : at + max(1, cells // max(1, wide + 1))] if len(pairs[i][1]) <= 1.25 * wide + 8]
        at += len(take)
        tall, wide = max(len(pairs[i][0]) for i in take), max(len(pairs[i][1]) for i in take)
        if not tall or not wide:
            continue
        a, b = np.zeros((len(take), tall), np.uint64), np.zeros((len(take), wide), np.uint64)
        in_a, in_b = np.zeros(a.shape, bool), np.zeros(b.shape, bool)
        for k, i in enumerate(take):
            x, y = pairs[i]
            a[k, : len(x)], in_a[k, : len(x)], b[k, : len(y)], in_b[k, : len(y)] = x, True, y, True
        n = len(take)
        row, start = np.zeros((n, wide + 1)), np.zeros((n, wide + 1), np.int64)
        best, best_from, best_to = np.zeros(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
        slope, column = gap * np.arange(wide + 1), np.arange(wide + 1)
        every = np.arange(n)
        for i in range(tall):
            diagonal = row[:, :-1] + np.where((b == a[:, i, None]) & in_b, match, miss)
            up = row[:, 1:] + gap
            take_diagonal = diagonal >= up
            level = np.zeros((n, wide + 1))
            level[:, 1:] = np.maximum(0.0, np.where(take_diagonal, diagonal, up))
            origin = np.full((n, wide + 1), i + 1)
            origin[:, 1:] = np.where(level[:, 1:] > 0, np.where(take_diagonal, np.where(row[:, :-1] > 0, start[:, :-1], i), start[:, 1:]), i + 1)
            # gaps in a: each cell may continue the best one to its left
            lifted = level - slope
            most = np.maximum.accumulate(lifted, axis=1)
            left = np.maximum.accumulate(np.where(lifted >= most - 1e-9, column, 0), axis=1)
            row, start = most + slope, np.take_along_axis(origin, left, axis=1)
            j = np.argmax(row, axis=1)
            top = row[every, j]
            better = (top > best) & in_a[:, i]
            best, best_from, best_to = np.where(better, top, best), np.where(better, start[every, j], best_from), np.where(better, i + 1, best_to)
        for k, i in enumerate(take):
            out[i] = (float(best[k]), int(best_from[k]), int(best_to[k]))
    return out


def _spans(lo: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The numbers from ``lo`` on, ``many`` of them, one span after the other."""
    return np.repeat(lo - np.cumsum(many) + many, many) + np.arange(int(many.sum()))


def longest_run(a: np.ndarray, b: np.ndarray, below: int) -> int:
    """Most consecutive words that stand in both, where fewer than ``below`` do."""
    return next((n for n in range(below - 1, 0, -1) if np.isin(seeds_of(b, n), seeds_of(a, n)).any()), 0)


class _Index:
    """Sorted hashes with their postings; a bit table answers for most words that they are not in it."""

    def __init__(self, keys: np.ndarray, *postings: np.ndarray, bits: int = 22):
        order = np.argsort(keys, kind="stable")
        self.keys, self.postings = keys[order], [p[order] for p in postings]
        self.mask = np.uint64((1 << bits) - 1)
        self.bits = np.zeros(1 << bits, bool)
        self.bits[keys & self.mask] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, ...]:
        """(place in ``hashes``, postings...) of every entry met."""
        at = np.flatnonzero(self.bits[hashes & self.mask])
        lo, hi = np.searchsorted(self.keys, hashes[at]), np.searchsorted(self.keys, hashes[at], side="right")
        entry = _spans(lo, hi - lo)
        return np.repeat(at, hi - lo), *(p[entry] for p in self.postings)


class Items:
    """The test items' words, an index of their seeds, and one of the pairs of words (single words, where pairs prove nothing) of which a copy must keep some.

    Items of the same words are one: they are compared once and reported under every id.
    """

    def __init__(self, rows: list[tuple[int, str | None]], n: int, words: Words, similarity: float = 0.8):
        self.n = n
        flat, starts = words.flat(pa.array([t for _, t in rows], pa.string()))
        known: dict[bytes, int] = {}
        self.words: list[np.ndarray] = []
        self.ids: list[list[int]] = []
        for k, (i, _) in enumerate(rows):
            own = flat[starts[k] : starts[k + 1]]
            at = known.setdefault(own.tobytes(), len(self.words))
            if at == len(self.words):
                self.words.append(own)
                self.ids.append([])
            self.ids[at].append(int(i))
        at = [seeds_of(w, n) for w in self.words]
        joined = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        self.seeds = _Index(joined(at, np.uint64), np.repeat(np.arange(len(at)), [len(x) for x in at]), joined([np.arange(len(x)) for x in at], np.int64))
        sizes = np.array([len(w) for w in self.words], np.int64)
        self.slack = np.floor(2 * (1 - similarity) * sizes + 1e-9).astype(np.int64)
        self.by_pair = sizes - 1 > self.slack
        self.least = np.where(self.by_pair, sizes - 1 - self.slack, np.maximum(1, np.ceil(similarity * sizes - 1e-9)).astype(np.int64))
        grams = [seeds_of(w, 2 if two else 1) for w, two in zip(self.words, self.by_pair)]
        self.many = np.array([len(x) for x in grams], np.int64)
        self.first = np.cumsum(self.many) - self.many
        self.gram = joined(grams, np.uint64)
        holder = np.repeat(np.arange(len(grams)), self.many)
        _, back, often = np.unique(self.gram, return_inverse=True, return_counts=True)
        order = np.lexsort((often[back], holder))
        rank = np.arange(len(order)) - self.first[holder[order]]
        chosen = order[rank <= (self.many - self.least)[holder[order]]]
        self.keys = _Index(self.gram[chosen], holder[chosen]) if len(chosen) else None

    def copies(self, words: np.ndarray, starts: np.ndarray, most: int = 4_000_000) -> set[tuple[int, int]]:
        """(text, item) of the items that keep as many of their pairs among those of a text as a copy must."""
        if self.keys is None or not len(words):
            return set()
        text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        grams, of = [], []
        for size in (2, 1):
            hashes = seeds_of(words, size)
            within = text[: len(hashes)] == text[size - 1 :] if size > 1 else np.ones(len(hashes), bool)
            grams.append(hashes[within])
            of.append(text[: len(hashes)][within])
        gram, of_text = np.concatenate(grams), np.concatenate(of)
        at, item = self.keys.find(gram)
        met = np.unique(of_text[at] * len(self.words) + item)
        with np.errstate(over="ignore"):
            mixed = np.sort((gram ^ (of_text.astype(np.uint64) * _MIX)) * _MIX)
        out: set[tuple[int, int]] = set()
        done = 0
        while done < len(met):
            part = met[done : done + max(1, most // max(1, int(self.many.max())))]
            done += len(part)
            t, i = part // len(self.words), part % len(self.words)
            with np.errstate(over="ignore"):
                own = (self.gram[_spans(self.first[i], self.many[i])] ^ (np.repeat(t, self.many[i]).astype(np.uint64) * _MIX)) * _MIX
            place = np.minimum(np.searchsorted(mixed, own), len(mixed) - 1)
            kept = np.add.reduceat((mixed[place] == own).astype(np.int64), np.cumsum(self.many[i]) - self.many[i])
            good = kept >= self.least[i]
            out.update(zip(t[good].tolist(), i[good].tolist()))
        return out

    def stretches(self, item: int, words: np.ndarray) -> list[tuple[int, int]]:
        """The stretches of a text, in words, that hold as many pairs of the item as a copy must."""
        own = self.gram[self.first[item] : self.first[item] + self.many[item]]
        places = np.flatnonzero(np.isin(seeds_of(words, 2 if self.by_pair[item] else 1), own))
        reach, least = len(self.words[item]) + self.slack[item], self.least[item]
        if len(places) < least:
            return []
        starts = np.flatnonzero(places[least - 1 :] - places[: len(places) - least + 1] < reach)
        return [(int(places[i]) - reach, int(places[i + least - 1]) + reach + 2) for i in starts]

    def compare(self, words: np.ndarray, min_run: int) -> list[tuple]:
        """``compare_all`` of one text, without the text's number."""
        return [r[1:] for r in self.compare_all(words, np.array([0, len(words)]), min_run)]

    def compare_all(self, words: np.ndarray, starts: np.ndarray, min_run: int) -> list[tuple[int, int, int, float, float, int, int, int]]:
        """(text, item id, longest run, score, similarity, seeds, start, end) of the items worth aligning.

        Seeds that follow one another in both texts make a run of equal words, so each item's longest run
        is known before; an item is aligned if that is ``min_run``, or if a stretch keeps as many pairs of
        the item as a copy must.
        """
        if not len(words):
            return []
        text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        seeds = seeds_of(words, self.n)
        within = np.flatnonzero(text[: len(seeds)] == text[self.n - 1 :]) if len(seeds) else np.zeros(0, np.int64)
        at, owner, pos = self.seeds.find(seeds[within])
        at = within[at]
        runs: dict[tuple[int, int], int] = {}
        bounds: dict[tuple[int, int], tuple[int, int]] = {}
        if len(at):
            order = np.lexsort((at, at - pos, owner, text[at]))
            at, owner, pos = at[order], owner[order], pos[order]
            of = text[at]
            pair = np.r_[True, (of[1:] != of[:-1]) | (owner[1:] != owner[:-1])]
            step = pair | np.r_[True, ((at - pos)[1:] != (at - pos)[:-1]) | (at[1:] != at[:-1] + 1)]
            run = np.bincount(np.cumsum(step) - 1) + self.n - 1
            first = np.flatnonzero(pair)
            longest = np.maximum.reduceat(run[np.cumsum(step) - 1], first)
            named = list(zip(of[first].tolist(), owner[first].tolist()))
            runs = dict(zip(named, longest.tolist()))
            bounds = dict(zip(named, zip(first.tolist(), [*first[1:].tolist(), len(at)])))
        kept = self.copies(words, starts)
        jobs, pairs = [], []
        for t, item in sorted(kept | {k for k, r in runs.items() if r >= min_run}):
            own, whole = self.words[item], words[starts[t] : starts[t + 1]]
            a, b = bounds.get((t, item), (0, 0))
            places = np.unique(at[a:b]) - starts[t]
            parts = self.stretches(item, whole) if (t, item) in kept else []
            if not parts and runs.get((t, item), 0) < min_run:
                continue
            for part in np.split(places, np.flatnonzero(np.diff(places) > 2 * len(own)) + 1) if len(places) else []:
                parts.append((int(part[0]) - len(own), int(part[-1]) + self.n + len(own)))
            merged: list[list[int]] = []
            for lo, hi in sorted(parts):
                if merged and lo <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], hi)
                else:
                    merged.append([lo, hi])
            spans = [(max(0, lo), min(len(whole), hi)) for lo, hi in merged]
            jobs.append((t, item, len(places), whole, spans))
            pairs.extend((whole[lo:hi], own) for lo, hi in spans)
        scores = iter(align_all(pairs))
        out = []
        for t, item, many, whole, spans in jobs:
            best = max((score, lo + a, lo + b) for (lo, _), (score, a, b) in zip(spans, scores))
            own = self.words[item]
            run = runs.get((t, item)) or longest_run(whole, own, self.n)
            out.extend((t, i, run, best[0], best[0] / (2.0 * max(1, len(own))), many, int(best[1]), int(best[2])) for i in self.ids[item])
        return out


def leaks(documents: DataFrame, items: DataFrame, min_run: int = 13, similarity: float = 0.8, seed_words: int = 5, most_bytes: int = 64_000_000) -> DataFrame:
    """Texts that hold a run of ``min_run`` words of an item, or the item edited but for a share.

    Columns: doc_id, item_id, longest_run, score, similarity (alignment score over the score of the item
    itself), seeds, doc_start, doc_end (the aligned stretch, in words). Words are runs of letters and
    digits, case ignored; whatever stands between them is. Null, empty and wordless texts on either side
    have no leak; an item of a few words leaks wherever they stand. Rows with a null key are ignored; repeated texts each give their rows. Texts of any
    length are read whole. Other columns are ignored; empty tables give an empty result.

    Items go to every task in blocks of about ``most_bytes`` of text (sized before), each compared with all
    texts; no text is shuffled, and the blocks change no result.
    """
    seed_words = min(seed_words, min_run)
    spark = documents.sparkSession
    wanted = items.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("item_text")).distinct()
    texts = spread(documents.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    keep = F.expr(f"longest_run >= {int(min_run)} or similarity >= {float(similarity)}")
    size = wanted.agg(F.sum(F.length("item_text") + 16)).first()[0] or 0
    blocks = max(1, -(-size // max(1, most_bytes)))

    def block(b: int) -> DataFrame:
        part = wanted if blocks == 1 else wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
        shared = spark.sparkContext.broadcast(sorted((r[0], r[1]) for r in part.collect()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words = Words()
            index = Items(shared.value, seed_words, words, similarity)
            for batch in batches:
                for at in range(0, batch.num_rows, 2_000):
                    some = batch.slice(at, 2_000)
                    docs = some.column("doc_id").to_pylist()
                    yield _batch([(docs[r[0]], *r[1:]) for r in index.compare_all(*words.flat(some.column("text")), min_run)])

        return texts.mapInArrow(run, ALIGNED).where(keep)

    return reduce(DataFrame.unionAll, (block(b) for b in range(blocks)))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "item_id", "longest_run", "score", "similarity", "seeds", "doc_start", "doc_end"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.int32(), pa.int32(), pa.int32()]
    cols = list(zip(*rows)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names)


def found(documents: DataFrame, items: DataFrame, min_run: int = 13) -> DataFrame:
    """(doc_id, item_id) sharing at least ``min_run`` consecutive words.

    Pairs come by seeds and alignment: a shared run aligns with two points a word, so a pair that scores less
    is none; of the others the longest run is checked.
    """
    # no copy is as similar as this, so none is looked for
    aligned = leaks(documents, items, min_run, similarity=2.0).where(F.col("score") >= 2 * min_run)
    return aligned.where(F.col("longest_run") >= min_run).select("doc_id", "item_id").distinct()
