"""Byte-pair encoding of whole texts by recursive SQL inside each task.

A text is cut into words by the tokenizer's pattern. In each task, words not met before become
(word, position, token) rows of an in-memory database; a recursive query joins neighbouring tokens to the
merge table, contracts each word's minimum-rank pair, from the left, until no pair is left, and ordered
aggregation gives the word's ids. A text's ids are those of its words in order.
The recursion is keyed by (word, position): each step overwrites the tokens it changes, so no steps are
kept and a word of any length needs the memory of its letters.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread

#: Fixed value: how this tokenizer family cuts a text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: All occurrences of a word's minimum-rank pair are contracted in one step: a pair with the new token has
#: a higher rank, so taking them one after the other ends the same. Of overlapping ones (x x x) every
#: second is taken, from the left.
#: Tokens swallowed by their left neighbour stay as -1.
CONTRACT = """
with recursive state(word, pos, tok) using key (word, pos) as (
  select word, pos, tok from bytes
  union all
  select word, pos, case when swallowed then -1 when taken then merged else tok end
  from (
    select *, coalesce(lag(taken) over (partition by word order by pos), false) as swallowed
    from (
      select *, hit and (row_number() over (partition by word, run, hit order by pos)) % 2 = 1 as taken
      from (
        select *, sum(case when hit then 0 else 1 end) over (partition by word order by pos) as run
        from (
          select *, coalesce(rank = least_rank, false) as hit
          from (
            select word, pos, tok, rank, merged, min(rank) over (partition by word) as least_rank
            from (select word, pos, tok, lead(tok) over (partition by word order by pos) as following from state where tok >= 0) s
            left join merges m on m.a = s.tok and m.b = s.following
          ) where least_rank is not null
        )
      )
    )
  )
)
select word, list(tok order by pos) as ids from state where tok >= 0 group by word order by word
"""


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in this family's vocabulary files."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names = {b: chr(b) for b in shown}
    hidden = (b for b in range(256) if b not in names)
    return names | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Contractor:
    """The merge table in an in-memory database, and the ids of the words met so far in one flat array."""

    def __init__(self, path: str, most_words: int = 500_000):
        import duckdb
        import regex

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab = model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.first = np.array([vocab[c] for _, c in sorted(byte_characters().items())], np.int32)
        self.most_words = most_words
        self.pattern = regex.compile(PATTERN)
        self.forget()
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "512MB", "temp_directory": ""})
        merges = pa.table({"a": [vocab[x] for x, _ in pairs], "b": [vocab[y] for _, y in pairs], "rank": range(len(pairs)), "merged": [vocab[x + y] for x, y in pairs]})
        self.db.register("landed", merges)
        self.db.execute("create table merges as select a::integer as a, b::integer as b, rank::integer as rank, merged::integer as merged from landed")
        self.db.unregister("landed")

    def forget(self) -> None:
        """Drop the ids of all words."""
        self.place: dict[str, int] = {}
        self.start, self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def learn(self, words: list[str], bytes_at_once: int = 100_000) -> None:
        """Encode words not met before and keep their ids."""
        sizes, flat = [self.size], [self.ids]
        at = 0
        while at < len(words):
            upto, size = at, 0
            while upto < len(words) and (size == 0 or size + len(words[upto]) <= bytes_at_once):
                size += len(words[upto])
                upto += 1
            raw = [np.frombuffer(w.encode("utf-8", "replace"), np.uint8) for w in words[at:upto]]
            length = np.array([len(r) for r in raw])
            rows = pa.table({
                "word": np.repeat(np.arange(len(raw), dtype=np.int32), length),
                "pos": (np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)).astype(np.int32),
                "tok": self.first[np.concatenate(raw)],
            })
            self.db.register("bytes", rows)
            found = self.db.sql(CONTRACT).to_arrow_table().column("ids").combine_chunks()
            self.db.unregister("bytes")
            sizes.append(np.diff(found.offsets.to_numpy()).astype(np.int64))
            flat.append(found.flatten().to_numpy())
            at = upto
        known = len(self.place)
        self.place.update(zip(words, range(known, known + len(words))))
        self.size, self.ids = np.concatenate(sizes), np.concatenate(flat).astype(np.int32)
        self.start = np.cumsum(self.size) - self.size

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and ids of the texts' lists; null and empty texts have empty lists."""
        cut = [self.pattern.findall(t) if t else [] for t in texts]
        wanted = set(chain.from_iterable(cut))
        new = sorted(wanted - self.place.keys())
        if new and len(self.place) + len(new) > self.most_words:
            self.forget()
            new = sorted(wanted)
        if new:
            self.learn(new)
        many = np.array([len(words) for words in cut], np.int64)
        at = np.fromiter(map(self.place.__getitem__, chain.from_iterable(cut)), np.int64, int(many.sum()))
        size = self.size[at]
        ends = np.r_[0, np.cumsum(size)]
        ids = self.ids[np.repeat(self.start[at] - ends[:-1], size) + np.arange(ends[-1])]
        return ends[np.r_[0, np.cumsum(many)]].astype(np.int32), ids


_WORKER: dict[str, Contractor] = {}


def encode(documents: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): each row's text as the list of its token ids, without special tokens.

    ``vocabulary`` is the path of a byte-level BPE file on every executor. Null and empty texts give an
    empty list; blank texts are encoded as they stand, strings of special tokens as ordinary text. Texts
    of any length are encoded whole. Rows keep their (also null or repeated) keys; other columns are
    ignored; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _WORKER:
            _WORKER[vocabulary] = Contractor(vocabulary)
        worker = _WORKER[vocabulary]
        for batch in batches:
            for at in range(0, batch.num_rows, 2_500):
                part = batch.slice(at, 2_500)
                offsets, ids = worker.encode(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))], ["key", "ids"])

    rows = documents.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return spread(rows).mapInArrow(run, "key long, ids array<int>").withColumnRenamed("key", key)
