"""Benchmark decontamination by a distributed positional inverted index (operator 12).

``write_index`` turns texts into shards of about half a MB, each with the postings of all
its words: a dictionary of terms and, per term, its places in ascending order. Shards are
the rows of a Parquet table; a search goes to all of them, and nothing is shuffled to
build or to search it.

An exact phrase is found in a shard by its rarest term there: the places of that term,
less its offset in the phrase, are candidates, and they are intersected with the lists of
the other terms, offset-adjusted too, rarest first. Phrases with a term that the shard
lacks fall out at once. A proximity search takes the places of all terms and keeps the
shortest runs of at most ``within`` words that hold them all.

A text longer than a shard is cut behind a word, and the next part repeats the last
``reach`` - 1 words, so that every phrase or run of up to ``reach`` words stands whole in
a part; one that ends in repeated words is the part before's.

Decontamination takes as phrases all windows of ``window`` consecutive words of the
benchmark's items (shorter items: all their words). Queries are sent to the shards in
blocks of ``BLOCK_QUERIES``, which bounds what the driver and a task hold; the intervals of
hit words are united per document in the end.

Defined cases: a null or empty text has no words, is in the index and never hit; rows of
equal id stay rows of their own; an item without words has no window; an item without id
makes its words hit but isn't counted or named; items of one id are one; an empty
benchmark or table of texts gives no hits or no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fairgauge.llm.alnum import PIECE_BYTES, Block, blocks, equal_rows
from fairgauge.llm.common import materialise, number_rows, scratch_path

WINDOW = 10
#: Longest phrase or run that is found across the parts of a long text.
REACH = 16
#: Phrases that are searched at a time, and candidates of them that a task holds.
BLOCK_QUERIES = 1 << 16
CANDIDATES = 1 << 20
#: Bytes of a row group: what a reader of the index holds.
GROUP_BYTES = 16 << 20

INDEX_SCHEMA = (
    "row_keys array<long>, doc_ids array<long>, bases array<long>, carried array<int>, first array<int>, "
    "terms binary, counts binary, places binary"
)


def _terms(block: Block) -> tuple[list[bytes], np.ndarray]:
    """The block's different words and each word's number among them; words of one
    length are compared whole."""
    lengths = block.ends - block.starts
    numbers, terms = np.empty(len(lengths), np.int64), []
    for size in np.unique(lengths).tolist():
        which = np.flatnonzero(lengths == size)
        matrix = block.data[block.starts[which][:, None] + np.arange(size)]
        once, inverse = equal_rows(matrix)
        numbers[which] = inverse + len(terms)
        terms += [row.tobytes() for row in matrix[once]]
    return terms, numbers


def _index(batches: Iterator[pa.RecordBatch], reach: int, size: int) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in INDEX_SCHEMA.split(", ")]
    lists = [pa.list_(pa.int64())] * 3 + [pa.list_(pa.int32())] * 2
    for batch in batches:
        keys, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        seen = dict.fromkeys(range(batch.num_rows), 0)
        for block in blocks(batch.column(2), reach - 1, size):
            bases = []
            for row, n, carried in zip(block.rows.tolist(), np.diff(block.first).tolist(), block.carried.tolist(), strict=True):
                bases.append(seen[row] - carried)
                seen[row] += n - carried
            terms, numbers = _terms(block)
            places = np.argsort(numbers, kind="stable").astype("<u4")
            counts = np.bincount(numbers, minlength=len(terms)).astype("<u4")
            values = [[keys[r] for r in block.rows], [ids[r] for r in block.rows], bases, block.carried.tolist(), block.first.tolist()]
            columns = [pa.array([v], t) for v, t in zip(values, lists, strict=True)]
            columns += [pa.array([v], pa.binary()) for v in (b" ".join(terms), counts.tobytes(), places.tobytes())]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def write_index(docs: DataFrame, path: str, reach: int = REACH, id_col: str = "doc_id", shard_bytes: int = PIECE_BYTES) -> None:
    """The index of ``text`` as a Parquet table at ``path``."""
    rows = docs.select(F.monotonically_increasing_id().alias("key"), F.col(id_col).cast("long").alias("doc_id"), "text")
    index = rows.mapInArrow(lambda x: _index(x, reach, shard_bytes), INDEX_SCHEMA)
    index.write.option("parquet.block.size", GROUP_BYTES).parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX_SCHEMA).parquet(path)


class Shard:
    """A row of the index, opened. Places are numbers of words in the shard."""

    def __init__(self, row: dict):
        self.row_keys, self.doc_ids = row["row_keys"], row["doc_ids"]
        self.bases, self.carried, self.first = (np.array(row[c], np.int64) for c in ("bases", "carried", "first"))
        terms = row["terms"].split(b" ") if row["counts"] else []
        self.number = {t: k for k, t in enumerate(terms)}
        self.counts = np.frombuffer(row["counts"], "<u4").astype(np.int64)
        self.places = np.frombuffer(row["places"], "<u4").astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        #: Term and place of each posting as one ascending number.
        self.postings = (np.repeat(np.arange(len(self.counts)), self.counts) << 32) | self.places

    def part(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, place, side="right") - 1

    def whole(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Which runs of places lie in one part and aren't its predecessor's."""
        part = self.part(first)
        return (part == self.part(last)) & (last - self.first[part] >= self.carried[part])

    def phrases(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row of ``wanted``, first place) of each occurrence of a phrase; ``wanted`` holds
        a phrase's term numbers (negative: a term that the shard lacks) in each row."""
        able = np.flatnonzero((wanted >= 0).all(axis=1))
        found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        if len(able):
            sizes = self.counts[wanted[able]]
            rarest = np.argsort(sizes, axis=1, kind="stable")
            many = sizes[np.arange(len(able)), rarest[:, 0]]
            cuts = np.searchsorted(np.cumsum(many), np.arange(CANDIDATES, many.sum(), CANDIDATES))
            for some in np.split(np.arange(len(able)), np.unique(cuts)):
                found.append(self._intersect(able[some], wanted[able[some]], rarest[some], many[some]))
        phrase, place = (np.concatenate(x) for x in zip(*found, strict=True))
        good = self.whole(place, place + wanted.shape[1] - 1)
        return phrase[good], place[good]

    def _intersect(
        self, names: np.ndarray, wanted: np.ndarray, rarest: np.ndarray, many: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        at = np.repeat(np.arange(len(names)), many)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
        offset = rarest[at, 0]
        place = self.places[self.starts[wanted[at, offset]] + nth] - offset
        kept = place >= 0
        at, place = at[kept], place[kept]
        for k in range(1, wanted.shape[1]):
            offset = rarest[at, k]
            posting = (wanted[at, offset] << 32) | (place + offset)
            there = np.searchsorted(self.postings, posting)
            there[there == len(self.postings)] = 0
            kept = self.postings[there] == posting
            at, place = at[kept], place[kept]
        return names[at], place

    def near(self, terms: Sequence[int], within: int) -> tuple[np.ndarray, np.ndarray]:
        """(first, last place) of the shortest runs that hold all terms."""
        lists = [self.places[self.starts[t] : self.starts[t + 1]] for t in set(terms)]
        first = np.unique(np.concatenate(lists))
        last = first.copy()
        for places in lists:
            at = np.searchsorted(places, first)
            last = np.maximum(last, np.append(places, np.iinfo(np.int64).max)[at])
        short = last - first < within
        first, last = first[short], last[short]
        latest = np.append(last[1:] != last[:-1], True)[: len(first)]  # no later start ends there
        first, last = first[latest], last[latest]
        good = self.whole(first, last)
        return first[good], last[good]


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield Shard(batch.slice(k, 1).to_pylist()[0])


class _Queries:
    """A block of phrases: their names and, by number of words, their terms."""

    def __init__(self, rows: list[tuple[str | None, str]]):
        self.vocabulary: dict[bytes, int] = {}
        by_size: dict[int, list[tuple[str | None, list[int]]]] = {}
        for name, phrase in rows:
            words = phrase.encode().split(b" ")
            by_size.setdefault(len(words), []).append((name, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]))
        self.sized = [([n for n, _ in some], np.array([t for _, t in some])) for some in by_size.values()]

    def occurrences(self, shard: Shard) -> Iterator[tuple[list[str | None], int, np.ndarray, np.ndarray]]:
        """(names, words of a phrase, phrases, places) by number of words."""
        local = np.array([shard.number.get(w, -1) for w in self.vocabulary] + [-1])
        for names, terms in self.sized:
            phrase, place = shard.phrases(local[terms])
            yield names, terms.shape[1], phrase, place


def _query_blocks(queries: DataFrame) -> Iterator[_Queries]:
    """``name, phrase`` rows, at most ``BLOCK_QUERIES`` at a time."""
    numbered = number_rows(queries, [F.col("phrase"), F.col("name")], "place")
    blocks_of = materialise(numbered.withColumn("block", F.floor(F.col("place") / BLOCK_QUERIES)), "queries")
    n = blocks_of.agg(F.max("block")).first()[0]
    for k in range(0 if n is None else n + 1):
        yield _Queries([(r["name"], r["phrase"]) for r in blocks_of.where(F.col("block") == k).collect()])


def find_phrases(index: DataFrame, queries: DataFrame) -> DataFrame:
    """A row per occurrence of a query's ``text``, all words in order, none between them:
    row_key, doc_id, query_id, start, n_words (places in the document, from 0). ``queries``
    holds ``query_id, text``, of at most the index's reach of words."""
    whole = queries.select(F.col("query_id").cast("string").alias("name"), "text").mapInArrow(lambda x: _windows(x, None), "name string, phrase string")
    schema = "row_key long, doc_id long, query_id string, start long, n_words int"

    def search(batches: Iterator[pa.RecordBatch], block: _Queries) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches):
            for names, size, phrase, place in block.occurrences(shard):
                part = shard.part(place)
                rows = [(shard.row_keys[p], shard.doc_ids[p], names[q], int(s), size)
                        for p, q, s in zip(part, phrase, shard.bases[part] + place - shard.first[part], strict=True)]
                yield _batch(rows, schema)

    found = [materialise(index.mapInArrow(lambda x, b=block: search(x, b), schema), "phrases") for block in _query_blocks(whole)]
    return _union(found, index.sparkSession, schema)


def find_near(index: DataFrame, words: Sequence[str], within: int = REACH) -> DataFrame:
    """A row per shortest run of at most ``within`` words (at most the index's reach) that
    holds all ``words`` in any order: row_key, doc_id, start, n_words."""
    wanted = [w.encode() for w in words]
    schema = "row_key long, doc_id long, start long, n_words int"

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches):
            numbers = [shard.number.get(w, -1) for w in wanted]
            if wanted and min(numbers) >= 0:
                first, last = shard.near(numbers, within)
                part = shard.part(first)
                at = shard.bases[part] + first - shard.first[part]
                yield _batch([(shard.row_keys[p], shard.doc_ids[p], int(s), int(n)) for p, s, n in zip(part, at, last - first + 1, strict=True)], schema)

    return index.mapInArrow(search, schema)


def _arrow_type(name: str) -> pa.DataType:
    plain = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    return pa.list_(plain[name[6:-1]]) if name.startswith("array<") else plain[name]


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [c.split() for c in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, _arrow_type(t)) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _union(found: list[DataFrame], spark: SparkSession, schema: str) -> DataFrame:
    out = spark.createDataFrame([], schema)
    for part in found:
        out = out.unionByName(part)
    return out


def _windows(batches: Iterator[pa.RecordBatch], window: int | None) -> Iterator[pa.RecordBatch]:
    """(name, phrase) of each window of the texts, or of each whole text."""
    for batch in batches:
        names, seen = batch.column(0).to_pylist(), dict.fromkeys(range(batch.num_rows), 0)
        for block in blocks(batch.column(1), overlap=(window or REACH) - 1):
            rows: list[tuple[str | None, str]] = []
            for p, row in enumerate(block.rows.tolist()):
                i, j, old = int(block.first[p]), int(block.first[p + 1]), int(block.carried[p])
                words = [block.data[s:e].tobytes().decode() for s, e in zip(block.starts[i:j].tolist(), block.ends[i:j].tolist(), strict=True)]
                seen[row] += len(words) - old
                if window is None:
                    if seen[row] > REACH:
                        raise ValueError(f"a phrase of more than {REACH} words")
                    rows += [(names[row], " ".join(words))] if block.last[p] and words else []
                elif block.last[p] and 0 < seen[row] < window:
                    rows.append((names[row], " ".join(words)))
                else:
                    rows += [(names[row], " ".join(words[k : k + window])) for k in range(max(0, old - window + 1), len(words) - window + 1)]
            yield _batch(rows, "name string, phrase string")


def _hits(batches: Iterator[pa.RecordBatch], block: _Queries | None, schema: str) -> Iterator[pa.RecordBatch]:
    """Of each part of a document: its own words (once), merged intervals of hit words,
    named items."""
    for shard in _shards(batches):
        n = len(shard.row_keys)
        words = np.diff(shard.first) - shard.carried if block is None else np.zeros(n, np.int64)
        spans: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        items: list[set[str]] = [set() for _ in range(n)]
        for names, size, phrase, place in block.occurrences(shard) if block else ():
            part = shard.part(place)
            for p, q in set(zip(part.tolist(), phrase.tolist(), strict=True)):
                if names[q] is not None:
                    items[p].add(names[q])
            hits = np.unique(place)
            ends = hits + size
            new = np.flatnonzero(np.concatenate([[True], hits[1:] > ends[:-1]])) if len(hits) else np.empty(0, np.int64)
            for k, until in zip(new.tolist(), [*new[1:].tolist(), len(hits)], strict=False):
                i, j = int(hits[k]), int(ends[until - 1])
                for p in range(int(shard.part(hits[k])), int(shard.part(ends[until - 1] - 1)) + 1):
                    low, high = max(i, int(shard.first[p])), min(j, int(shard.first[p + 1]))
                    shift = int(shard.bases[p] - shard.first[p])
                    spans[p] += [(low + shift, high + shift)] if low < high else []
        rows = [(shard.row_keys[p], shard.doc_ids[p], int(words[p]), [a for a, _ in spans[p]], [b for _, b in spans[p]], list(items[p]))
                for p in range(n) if block is None or spans[p]]
        yield _batch(rows, schema)


def _united(spans: Column) -> Column:
    """Places in any of the (begin, end) intervals, which may overlap."""
    zero = F.struct(F.lit(0).cast("long").alias("upto"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        F.array_sort(spans),
        zero,
        lambda a, x: F.struct(
            F.greatest(a["upto"], x["end"]).alias("upto"),
            (a["n"] + F.greatest(F.lit(0).cast("long"), x["end"] - F.greatest(a["upto"], x["begin"]))).alias("n"),
        ),
        lambda a: a["n"],
    )


def contamination(index: DataFrame, benchmark: DataFrame, window: int = WINDOW, item_col: str = "item_id") -> DataFrame:
    """A row per indexed document: row_key, doc_id, n_words, n_hit, items (the ids, sorted as
    text, of the benchmark's items with an occurring window), contaminated. ``window`` is
    at most the index's reach."""
    schema = "row_key long, doc_id long, words long, begins array<long>, ends array<long>, items array<string>"
    named = benchmark.select(F.col(item_col).cast("string").alias("name"), "text")
    windows = named.mapInArrow(lambda x: _windows(x, window), "name string, phrase string").distinct()
    found = [materialise(index.mapInArrow(lambda x, b=block: _hits(x, b, schema), schema), "hits") for block in _query_blocks(windows)]
    own = index.mapInArrow(lambda x: _hits(x, None, schema), schema)
    spans = F.arrays_zip(F.col("begins").alias("begin"), F.col("ends").alias("end"))
    rows = _union(found, index.sparkSession, schema).unionByName(own).select("row_key", "doc_id", "words", spans.alias("spans"), "items")
    together = rows.groupBy("row_key", "doc_id").agg(
        F.sum("words").alias("n_words"),
        _united(F.flatten(F.collect_list("spans"))).alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return together.withColumn("contaminated", F.col("n_hit") > 0)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", item_col: str = "item_id",
    shard_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """``contamination`` of texts that have no index yet: one is written to the scratch folder."""
    if window > REACH:
        raise ValueError(f"a window of more than {REACH} words")
    path = scratch_path(docs.sparkSession, "postings")
    write_index(docs, path, id_col=id_col, shard_bytes=shard_bytes)
    return contamination(read_index(docs.sparkSession, path), benchmark, window, item_col)
