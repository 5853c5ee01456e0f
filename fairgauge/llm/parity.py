"""N-gram Jaccard join by parity sketches (operator 8).

A document's set holds its distinct n-word shingles. A parity sketch has a bit for each
hash position; every element flips one. Elements that two sets share cancel out, so the
Hamming distance of their sketches is at most their symmetric difference, which a
similarity of at least t bounds by (1 - t) / (1 + t) of the two sizes' sum.

Candidates come from a pigeonhole join per size band: a sketch of 2**60 positions, kept
as the list of its ones, is cut into more slices than a pair of the band may differ in,
so some slice is equal; a slice's key is the XOR of its positions' hashes. Slices are
spared so that empty ones needn't be joined. A set joins in its own band, and in the
lower ones where its partner may be the smaller set.

Documents with equal sets are one node throughout. For keys with up to ``SMALL_KEY``
nodes all pairs are candidates. A key that more nodes share is cut into blocks, whose
pairs are compared by dense sketches inside a task; a node gives its
nearest partners of other components, round after round, until no node has more of them
within the Hamming bound than it gives (or, once a round links nothing, gives all). So no pair of different texts
is lost to a cap, and a group of g near copies never emits its g * g pairs. Candidates
pass the Hamming bound first and are then verified on their whole sets.

Elements are 64-bit hashes of shingles, and nodes 64-bit hashes of sets: their equality
is taken for the texts' own.

Defined cases: fewer words than n make the whole sequence one shingle; a document
without words (or null) has an empty set and is linked with nothing; repeated rows and
ids are linked like other documents; a null id never is the smallest of a component
with ids; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fairgauge.llm.common import materialise
from fairgauge.llm.components import components
from fairgauge.llm.words import Words, chunks, mix, words_of

#: Upper over lower set size of a band.
BAND_RATIO = 1.4
#: Nodes of a key up to which all its pairs are candidates; nodes of a block of others.
SMALL_KEY = 8
BLOCK = 1024
#: Least bits of a dense sketch, and bits of the filter that spares most texts a second reading.
SKETCH_BITS = 2048
FILTER_BITS = 1 << 22
#: Rounds of nearest partners at most, before all pairs left are tried.
ROUNDS = 12
#: Nearest partners that a node of a large key gives in a round after the first.
KEPT_PARTNERS = 8


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's n-word shingles; of its whole sequence if
    it has fewer words; empty without words."""
    w: Words = words_of(texts)
    first, h = w.first.tolist(), w.hashes
    m = len(h) - n + 1
    grams = np.zeros(max(m, 0), np.uint64)
    for k in range(n if m > 0 else 0):
        grams = mix(grams * np.uint64(0x9E3779B97F4A7C15) + h[k : k + m])
    out = []
    for i, j in zip(first, first[1:], strict=False):
        if j - i >= n:
            out.append(np.unique(grams[i : j - n + 1]))
        else:
            short = np.zeros(min(j - i, 1), np.uint64)
            for k in range(i, j):
                short = mix(short * np.uint64(0x9E3779B97F4A7C15) + h[k : k + 1])
            out.append(mix(short + np.uint64(j - i)))
    return out


class Bands:
    """Size bands for a threshold: band b holds the sizes lows[b] ... lows[b + 1] - 1 and
    cuts sketches into ``slices(b)``. Two sets of similarity >= threshold differ in at
    most (1 - t) / t elements per element of the smaller one."""

    def __init__(self, threshold: Fraction):
        self.threshold = threshold
        lows = [1]
        while lows[-1] < 1 << 40:
            lows.append(max(lows[-1] + 1, int(lows[-1] * BAND_RATIO)))
        self.lows = np.array(lows)

    def of(self, size: int) -> int:
        return int(np.searchsorted(self.lows, size, side="right")) - 1

    def most_changes(self, band: int) -> int:
        largest = int(self.lows[band + 1]) - 1
        return math.floor((1 - self.threshold) / self.threshold * largest)

    def spare(self, band: int) -> int:
        """Slices beyond those that changes can hit, so that as many may be empty."""
        changes = self.most_changes(band)
        return 2 + changes // 32 if changes else 0

    def slices(self, band: int) -> int:
        return self.most_changes(band) + 1 + self.spare(band)

    def joined(self, size: int) -> Iterator[int]:
        """Bands in which a set of ``size`` looks for partners of at most its size."""
        band, least = self.of(size), math.ceil(self.threshold * size)
        while band >= 0 and int(self.lows[band + 1]) - 1 >= least:
            yield band
            band -= 1


def slice_keys(elements: np.ndarray, band: int, bands: Bands) -> np.ndarray:
    """Join keys of a set's non-empty slices in a band; of its empty ones too if it has
    more than can be spared."""
    k = bands.slices(band)
    slot = ((elements >> np.uint64(32)) % np.uint64(k)).astype(np.int64)
    order = np.argsort(slot, kind="stable")
    slot, bits = slot[order], mix(elements[order] ^ np.uint64(band + 1))
    first = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
    parity = np.bitwise_xor.reduceat(bits, first)
    used = slot[first]
    if k - len(used) > bands.spare(band):
        full = np.zeros(k, np.uint64)
        full[used] = parity
        used, parity = np.arange(k), full
    return mix(parity + mix(used.astype(np.uint64) + np.uint64(band << 40)))


def node_of(elements: np.ndarray) -> int | None:
    """A set's identity; None for the empty set."""
    if not len(elements):
        return None
    parts = np.array([np.bitwise_xor.reduce(mix(elements)), np.add.reduce(elements), len(elements)], np.uint64)
    return int(mix(mix(mix(parts[:1]) + parts[1:2]) + parts[2:]).view(np.int64)[0])


def dense_sketch(elements: np.ndarray) -> bytes:
    """Parity of the elements per position; a power of two of positions, at least
    ``SKETCH_BITS`` and four per element, so that few differences cancel out."""
    bits = max(SKETCH_BITS, 1 << (4 * len(elements) - 1).bit_length())
    place = (mix(elements ^ np.uint64(0x5BD1E995)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(sketch: bytes, size: int) -> np.ndarray:
    """The sketch of ``size`` bytes that a larger one contains: halves XORed."""
    return np.bitwise_xor.reduce(np.frombuffer(sketch, np.uint64).reshape(-1, size // 8), axis=0)


def within_bound(distance: np.ndarray, sizes: np.ndarray, t: Fraction) -> np.ndarray:
    """Whether sets whose sizes' sum is ``sizes`` may differ in ``distance`` elements."""
    return distance * (t.denominator + t.numerator) <= sizes * (t.denominator - t.numerator)


def _nodes(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in chunks(batch):
            sets = shingle_sets(texts, n)
            columns = [pa.array([node_of(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], *columns], names=[*part.schema.names[:-1], "node", "n_shingles"]
            )


def _keys(batches: Iterator[pa.RecordBatch], n: int, t: Fraction) -> Iterator[pa.RecordBatch]:
    bands, empty = Bands(t), np.zeros(0, np.uint64)
    for batch in batches:
        for _, texts in chunks(batch):
            seen: dict[int, np.ndarray] = {}
            for s in shingle_sets(texts, n):
                node = node_of(s)
                if node is not None and node not in seen:  # copies in a part join once
                    seen[node] = np.concatenate([slice_keys(s, b, bands) for b in bands.joined(len(s))])
            counts = [len(k) for k in seen.values()]
            keys = np.concatenate([empty, *seen.values()])
            nodes = np.repeat(np.fromiter(seen, np.int64, len(seen)), counts)
            for k in range(0, len(keys), 1 << 17):
                yield pa.RecordBatch.from_pydict({"key": keys[k : k + (1 << 17)].view(np.int64), "node": nodes[k : k + (1 << 17)]})


def _filter_places(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.view(np.uint64)) % np.uint64(FILTER_BITS)).astype(np.int64)


def _filter_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = np.zeros(FILTER_BITS // 64, np.uint64)
    for batch in batches:
        place = _filter_places(batch.column(0).to_numpy(zero_copy_only=False))
        np.bitwise_or.at(words, place // 64, np.uint64(1) << (place % 64).astype(np.uint64))
    some = np.flatnonzero(words)
    yield pa.RecordBatch.from_pydict({"word": some.astype(np.int32), "bits": words[some].view(np.int64)})


def _passes(ids: pa.Array, words: np.ndarray) -> np.ndarray:
    place = _filter_places(ids.fill_null(0).to_numpy(zero_copy_only=False))
    hit = (words[place // 64] >> (place % 64).astype(np.uint64) & np.uint64(1)).astype(bool)
    return hit | ids.is_null().to_numpy(zero_copy_only=False)


def id_filter(ids: DataFrame) -> np.ndarray:
    """A filter of FILTER_BITS that every id of the one column passes, and few others
    while the ids are fewer than its bits; a join behind it is exact at any number."""
    words = np.zeros(FILTER_BITS // 64, np.uint64)
    filled = ids.dropna().mapInArrow(_filter_words, "word int, bits long")
    for r in filled.groupBy("word").agg(F.bit_or("bits").alias("bits")).collect():  # FILTER_BITS / 64 rows at most
        words[r.word] = np.uint64(r.bits & 0xFFFFFFFFFFFFFFFF)
    return words


def _sets(batches: Iterator[pa.RecordBatch], words: np.ndarray, n: int) -> Iterator[pa.RecordBatch]:
    """Sets and sketches of the documents that pass the filter of ids."""
    for batch in batches:
        for part, texts in chunks(batch.filter(pa.array(_passes(batch.column("id"), words)))):
            sets = shingle_sets(texts, n)
            yield pa.RecordBatch.from_pydict(
                {
                    "id": part.column("id"),
                    "node": pa.array([node_of(s) for s in sets], pa.int64()),
                    "size": pa.array([len(s) for s in sets], pa.int64()),
                    "sketch": pa.array([dense_sketch(s) for s in sets], pa.binary()),
                    "elements": pa.array([s.tobytes() for s in sets], pa.binary()),
                }
            )


def _near(batches: Iterator[pa.RecordBatch], t: Fraction) -> Iterator[pa.RecordBatch]:
    """Pairs whose sketches are within the Hamming bound."""
    for batch in batches:
        distance = np.zeros(batch.num_rows, np.int64)
        for k, (x, y) in enumerate(zip(batch.column("sketch_a"), batch.column("sketch_b"), strict=True)):
            x, y = x.as_py(), y.as_py()
            size = min(len(x), len(y))
            distance[k] = np.bitwise_count(folded(x, size) ^ folded(y, size)).sum()
        sizes = batch.column("size_a").to_numpy() + batch.column("size_b").to_numpy()
        yield batch.select(["a", "b"]).filter(pa.array(within_bound(distance, sizes, t)))


def _similar(batches: Iterator[pa.RecordBatch], t: Fraction) -> Iterator[pa.RecordBatch]:
    """Pairs whose whole sets are similar enough."""
    for batch in batches:
        linked = []
        for x, y in zip(batch.column("elements_a"), batch.column("elements_b"), strict=True):
            x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
            shared = len(np.intersect1d(x, y, assume_unique=True))
            linked.append(shared * t.denominator >= (len(x) + len(y) - shared) * t.numerator)
        yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))


def _block_pairs(unit: dict[str, np.ndarray], sketches: np.ndarray, t: Fraction, keep: int | None) -> tuple[list, bool]:
    """Candidates between the blocks of one unit: of each node of the first block its
    ``keep`` nearest partners of other components (all if None); whether that left any."""
    p, q = np.flatnonzero(unit["side"] == 0), np.flatnonzero(unit["side"] == 1)
    q = q if len(q) else p
    node, size, component, found, more = unit["node"], unit["size"], unit["component"], [], False
    for i in p:
        distance = np.bitwise_count(sketches[i] ^ sketches[q]).sum(axis=1, dtype=np.int64)
        ok = np.flatnonzero(within_bound(distance, size[q] + size[i], t) & (component[q] != component[i]))
        if keep is not None and len(ok) > keep:
            ok, more = ok[np.argsort(distance[ok], kind="stable")[:keep]], True
        found += [(node[i], node[q[j]]) for j in ok]
    return found, more


def _unit_pairs(group: pd.DataFrame, t: Fraction, keep: int | None) -> pd.DataFrame:
    """Candidates of all units that were dealt to one bin."""
    group = group.sort_values(["key", "p", "q", "node"], kind="stable")
    columns = {c: group[c].to_numpy() for c in ("side", "node", "size", "component")}
    raw = group["sketch"].tolist()
    ids = group[["key", "p", "q"]].to_numpy()
    bounds = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]).any(axis=1), [True]]))
    pairs, more = set(), False
    for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        least = min(map(len, raw[i:j]))
        sketches = np.stack([folded(x, least) for x in raw[i:j]])
        found, left = _block_pairs({c: v[i:j] for c, v in columns.items()}, sketches, t, keep)
        pairs.update((min(x, y), max(x, y)) for x, y in found)
        more |= left
    out = np.array(sorted(pairs), np.int64).reshape(-1, 2)
    rows = pd.DataFrame({"a": out[:, 0], "b": out[:, 1]}, dtype="Int64")
    return pd.concat([rows, pd.DataFrame({"a": [None], "b": [None]}, dtype="Int64")]) if more else rows


def hot_bins(hot: DataFrame) -> int:
    """Bins of about two blocks of rows: every node of a key is there once for each block."""
    dealt = hot.agg(F.sum(F.ceil(F.col("nodes") / BLOCK))).first()[0] or 0
    return max(1, math.ceil(dealt / (2 * BLOCK)))


class _Join:
    def __init__(self, sets: DataFrame, threshold: Fraction):
        self.sets, self.t = sets, threshold

    def _sides(self, pairs: DataFrame, *columns: str, sets: DataFrame | None = None) -> DataFrame:
        for side in ("a", "b"):
            other = (sets or self.sets).select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns])
            pairs = pairs.join(other, side)
        return pairs

    def links(self, pairs: DataFrame, sketched: bool) -> DataFrame:
        t = self.t
        if not sketched:
            pairs = self._sides(pairs, "sketch", "size").mapInArrow(lambda x: _near(x, t), "a long, b long")
        near = materialise(pairs, "parity-near")
        used = id_filter(near.select(F.explode(F.array("a", "b")).alias("node")))
        # Only sets of candidates are shuffled.
        sets = self.sets.select("node", "elements").mapInArrow(
            lambda x: (b.filter(pa.array(_passes(b.column("node"), used))) for b in x), "node long, elements binary"
        )
        checked = self._sides(near, "elements", sets=sets).mapInArrow(lambda x: _similar(x, t), "a long, b long")
        return materialise(checked, "parity-links")

    def hot_pairs(self, hot: DataFrame, parts: DataFrame | None, keep: int | None) -> DataFrame:
        """Candidates of keys with many nodes, between nodes of different components; a
        row of nulls tells that nodes had more than ``keep`` partners."""
        t = self.t
        rows = hot.withColumn("component", F.col("node"))
        if parts is not None:
            rows = hot.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
        ends = rows.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
        open_keys = rows.join(ends.select("key"), "key")
        place = F.row_number().over(Window.partitionBy("key").orderBy("component", "node")) - 1
        blocks = F.ceil(F.col("nodes") / BLOCK).cast("int")
        dealt = open_keys.withColumn("block", F.floor(place / BLOCK).cast("int")).withColumn(
            "other", F.explode(F.sequence(F.lit(0), blocks - 1))
        )
        units = dealt.select(
            "key",
            F.least("block", "other").alias("p"),
            F.greatest("block", "other").alias("q"),
            (F.col("block") > F.col("other")).cast("int").alias("side"),
            "node",
            "component",
        ).join(self.sets.select("node", "size", "sketch"), "node")
        # Units are dealt to bins of about two blocks of rows, since a call per unit costs more
        # than most units do.
        bins = hot_bins(hot)
        dealt_units = units.withColumn("bin", F.pmod(F.xxhash64("key", "p", "q"), F.lit(bins)))
        pairs = dealt_units.groupBy("bin").applyInPandas(lambda g: _unit_pairs(g, t, keep), "a long, b long")
        return materialise(pairs.distinct(), "parity-pairs")


def group_similar(
    docs: DataFrame, words: int = 5, threshold: Fraction = Fraction(4, 5), id_col: str = "doc_id"
) -> DataFrame:
    """``id_col``, text_hash, n_shingles, component_id (smallest id linked directly or
    by others) of each document."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64("text").alias("text_hash"), "text")
    nodes = materialise(
        rows.mapInArrow(lambda x: _nodes(x, words), "id long, text_hash long, node long, n_shingles long"), "parity-nodes"
    )
    by_key = Window.partitionBy("key")
    keys = rows.select("text").mapInArrow(lambda x: _keys(x, words, threshold), "key long, node long")
    live = materialise(
        keys.withColumns({"low": F.min("node").over(by_key), "high": F.max("node").over(by_key)})
        .where("low < high")
        .select("key", "node")
        .distinct()
        .withColumn("nodes", F.count("*").over(by_key)),
        "parity-keys",
    )
    classes = nodes.where(F.col("node").isNotNull()).groupBy("node").agg(F.min("id").alias("id"))
    needed = materialise(classes.join(live.select("node").distinct(), "node"), "parity-needed")
    words_set = id_filter(needed.select("id"))
    found = rows.select("id", "text").mapInArrow(
        lambda x: _sets(x, words_set, words), "id long, node long, size long, sketch binary, elements binary"
    )
    # Some that the filter lets through are of no use; none that is needed is missing.
    sets = materialise(found.drop("id").dropna(subset=["node"]).dropDuplicates(["node"]), "parity-sets")

    join = _Join(sets, threshold)
    x, y = live.where(F.col("nodes") <= SMALL_KEY).select("key", F.col("node").alias("a")), live.where(F.col("nodes") <= SMALL_KEY).select("key", F.col("node").alias("b"))
    links = join.links(x.join(y, "key").where("a < b").select("a", "b").distinct(), sketched=False)
    hot = materialise(live.where(F.col("nodes") > SMALL_KEY), "parity-hot")
    if not hot.isEmpty():
        for turn in range(ROUNDS):
            pairs = join.hot_pairs(hot, components(links) if turn else None, 1 if turn == 0 else KEPT_PARTNERS)
            new = join.links(pairs.dropna(), sketched=True)
            links = links.unionByName(new)
            if pairs.where(F.col("a").isNull()).isEmpty():
                break  # every pair between components was among them
            if new.isEmpty() or turn == ROUNDS - 1:
                links = links.unionByName(join.links(join.hot_pairs(hot, components(links), None), sketched=True))
                break
    parts = components(links)
    known = classes.join(parts, "node", "left").select(
        "node", "id", F.coalesce("component", "node").alias("component")
    )
    smallest = known.groupBy("component").agg(F.min("id").alias("component_id"))
    by_node = known.join(smallest, "component").select("node", "component_id")
    return nodes.join(by_node, "node", "left").select(
        F.col("id").alias(id_col),
        "text_hash",
        "n_shingles",
        F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def drop_similar(docs: DataFrame, words: int = 5, threshold: Fraction = Fraction(4, 5), id_col: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each group of similar texts, that with the smallest id."""
    groups = group_similar(docs, words, threshold, id_col)
    dropped = groups.where(~F.col(id_col).eqNullSafe(F.col("component_id"))).select(
        F.col(id_col).cast("long").alias("gone_id"), F.col("text_hash").alias("gone_hash")
    )
    gone = materialise(dropped.distinct(), "parity-dropped")
    same = docs[id_col].cast("long").eqNullSafe(gone.gone_id) & (F.xxhash64(docs["text"]) == gone.gone_hash)
    return docs.join(gone, same, "left_anti")
