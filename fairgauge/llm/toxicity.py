"""Toxicity: gradient-boosted trees over dense features, calibrated (operator 10).

The features of a text are densities of a lexicon (words and beginnings of words that
the training rows' toxic texts use far more often than the others, and a short fixed
list), how often its words stand near a second-person word, capitals, punctuation, and
obfuscation: letters mixed with digits or marks, and lexicon words that appear only
once such characters are read as letters. Trees are boosted by Spark ML on one part of
the training rows; isotonic regression maps their margin to a probability on the rest.

Only rows outside the held-out fold are learned from, and of these at most
``SAMPLE_ROWS`` of each class, those of least id hash; texts that occur more than once
count once. A score depends on the text alone.

Defined cases: a null or empty text has all features 0 and is scored like any other; an
id labelled both ways counts as toxic; null labels and ids are ignored; without training
rows of both classes every score is the share of toxic ones (0 without any); an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairgauge.llm.common import materialise
from fairgauge.llm.words import LOWER, Words, chunks, words_of

#: Training rows of a class that are learned from at most.
SAMPLE_ROWS = 20_000
#: Entries of the learned lexicon, the texts that an entry needs, and how many times
#: likelier it must be in a toxic text (at the low end of its 95 % interval).
LEXICON_SIZE = 4_000
LEAST_TEXTS = 3
LEAST_RATIO = 4.0
#: Bytes of the beginnings of words in the lexicon.
PREFIXES = (4, 5, 6)
#: Words between a lexicon word and a second-person word.
NEAR = 5
FOLDS, HELD_OUT = 5, 0
SEED = 23

# Words that start the lexicon, and second-person words.
INSULTS = """
bastard clown coward creep cretin damn disgusting dumb dumbass fool freak garbage hate idiot idiotic imbecile jerk
kill liar loser lunatic moron moronic nasty pathetic pig rat scum shit stupid swine trash ugly vermin worthless
""".split()
SECOND_PERSON = """
you your yours yourself yourselves u ur tu te toi ton ta tes vous votre vos du dich dir dein deine euch ihr euer
tú ti tuyo tuya usted ustedes vosotros vuestro
""".split()

LETTERS = np.zeros(256, bool)
LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
#: What a digit or mark inside a word is read as.
DISGUISE = dict(zip(b"013457@$!|", b"oieastasil", strict=True))
DISGUISED = LOWER.copy()
DISGUISED[list(DISGUISE)] = list(DISGUISE.values())
INSIDE = LETTERS.copy()
INSIDE[list(DISGUISE)] = True

FEATURES = (
    "words", "lexicon", "lexicon_words", "beginnings", "beginning_words", "insults", "near_you", "you", "capitals",
    "shouted", "exclamations", "questions", "marks", "obfuscated", "undisguised",
)


def _plain(texts: list[bytes]) -> Words:
    return words_of(texts, ~LETTERS)


def _hashes(words: list[str]) -> np.ndarray:
    return np.sort(_plain([w.encode() for w in words]).hashes)


def _in(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _terms(w: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hash and text of each word, then of each beginning of a word."""
    doc = w.doc
    yield w.hashes, doc
    for n in PREFIXES:
        h, at = w.prefixes(n)
        yield h ^ np.uint64(n), doc[at]


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and other texts of a part each term occurs."""
    for batch in batches:
        for part, texts in chunks(batch):
            toxic = part.column("toxic").to_numpy(zero_copy_only=False).astype(bool)
            for h, doc in _terms(_plain(texts)):
                order = np.lexsort((doc, h))
                h, doc = h[order], doc[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                h, doc = h[new], doc[new]
                first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, int)
                n = np.diff(np.append(first, len(h)))
                bad = np.add.reduceat(toxic[doc].astype(np.int64), first) if len(h) else n
                yield pa.RecordBatch.from_pydict({"term": h[first].view(np.int64), "toxic": bad, "other": n - bad})


def learn_lexicon(texts: DataFrame) -> np.ndarray:
    """Sorted hashes of the lexicon's terms. ``texts``: text, toxic (boolean)."""
    total = texts.agg(F.sum(F.col("toxic").cast("long")), F.sum((~F.col("toxic")).cast("long"))).first()
    counts = (
        texts.mapInArrow(_term_counts, "term long, toxic long, other long")
        .groupBy("term")
        .agg(F.sum("toxic").alias("a"), F.sum("other").alias("b"))
        .where(F.col("a") >= LEAST_TEXTS)
    )
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    ratio = F.log(a / (total[0] + 1.0)) - F.log(b / (total[1] + 1.0))
    low = ratio - 1.96 * F.sqrt(1 / a + 1 / b)
    best = counts.withColumn("low", low).where(low > float(np.log(LEAST_RATIO)))
    rows = best.orderBy(F.desc(F.col("low") * F.col("a")), "term").limit(LEXICON_SIZE).select("term").collect()
    return np.sort(np.array([r.term for r in rows], np.int64).view(np.uint64))


def features(texts: list[bytes], lexicon: np.ndarray, insults: np.ndarray, you: np.ndarray) -> np.ndarray:
    """A row of FEATURES for each text."""
    n_docs, w = len(texts), _plain(texts)
    doc, n = w.doc, np.diff(w.first)

    def per_doc(mask: np.ndarray, of: np.ndarray = doc) -> np.ndarray:
        return np.bincount(of[mask], minlength=n_docs).astype(float)

    hits = [_in(h, lexicon) for h, _ in _terms(w)]
    begun = np.zeros(len(w.hashes), bool)
    for k, size in enumerate(PREFIXES, 1):
        begun[w.prefixes(size)[1][hits[k]]] = True
    known, second = _in(w.hashes, insults), _in(w.hashes, you)
    bad = hits[0] | begun | known
    near = np.zeros(len(bad), bool)
    for k in range(1, NEAR + 1):
        same = doc[k:] == doc[:-k]
        near[k:] |= second[:-k] & same
        near[:-k] |= second[k:] & same
    shouted = np.zeros(len(bad), bool)
    if len(bad):
        upper = np.concatenate([[0], np.cumsum((w.data >= 65) & (w.data <= 90))])
        shouted = (upper[w.ends] - upper[w.starts] == w.ends - w.starts) & (w.ends - w.starts > 2)

    lengths = np.fromiter((len(t) for t in texts), np.int64, n_docs)
    ends = 1 + np.cumsum(lengths + 1)

    def in_text(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask)])
        return (sums[ends - 1] - sums[ends - 1 - lengths]).astype(float)

    d = words_of(texts, ~INSIDE, DISGUISED)
    letters, inside = (np.concatenate([[0], np.cumsum(t[d.data])]) for t in (LETTERS, INSIDE))
    kept, whole = letters[d.ends] - letters[d.starts], inside[d.ends] - inside[d.starts]
    mixed = (kept > 0) & (kept < whole) & LETTERS[d.data[d.ends - 1]] & LETTERS[d.data[d.starts]]
    plain = (kept > 0) & (kept < whole)
    undone = plain & (_in(d.hashes, lexicon) | _in(d.hashes, insults))

    words, size = np.maximum(n, 1), np.maximum(lengths, 1)
    marks = (w.data > 32) & (w.data < 127) & ~LETTERS[w.data] & ~((w.data >= 48) & (w.data <= 57))
    columns = [
        np.log1p(n),
        per_doc(hits[0]) / words,
        np.log1p(per_doc(hits[0])),
        per_doc(begun) / words,
        np.log1p(per_doc(begun)),
        np.log1p(per_doc(known)),
        np.log1p(per_doc(bad & near)),
        per_doc(second) / words,
        in_text((w.data >= 65) & (w.data <= 90)) / size,
        per_doc(shouted) / words,
        in_text(w.data == 33) / words,
        in_text(w.data == 63) / words,
        in_text(marks) / size,
        per_doc(mixed, d.doc) / words,
        np.log1p(per_doc(undone, d.doc)),
    ]
    return np.stack(columns, axis=1)


def with_features(docs: DataFrame, lexicon: np.ndarray) -> DataFrame:
    """``docs`` (its last column: text) with FEATURES in place of the text."""
    insults, you = _hashes(INSULTS), _hashes(SECOND_PERSON)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in chunks(batch):
                values = features(texts, lexicon, insults, you)
                others = [part.column(i) for i in range(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays(
                    [*others, *(pa.array(values[:, k]) for k in range(len(FEATURES)))], names=[*part.schema.names[:-1], *FEATURES]
                )

    schema = docs.drop("text").schema
    for name in FEATURES:
        schema = schema.add(name, "double")
    return docs.mapInArrow(run, schema)


def held_out(id_: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) == HELD_OUT


def _training(docs: DataFrame, labels: DataFrame, sample_rows: int) -> DataFrame:
    """text, toxic and ``calibrates`` of the bounded sample, a row per distinct text."""
    rated = (
        labels.where(F.col("id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("id")))
        .groupBy("id")
        .agg((F.max("toxic") == 1).alias("toxic"))
    )
    order = F.xxhash64("id", F.lit(SEED))
    parts = [rated.where(F.col("toxic") == x).orderBy(order, "id").limit(sample_rows) for x in (True, False)]
    ids = parts[0].unionByName(parts[1])
    texts = docs.join(F.broadcast(ids), "id").groupBy("text").agg(F.max("toxic").alias("toxic"))
    return texts.select("toxic", (F.pmod(F.xxhash64("text", F.lit(SEED)), F.lit(5)) == 0).alias("calibrates"), "text")


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Callable[[DataFrame], DataFrame]:
    """A function that adds ``score`` to a frame whose last column is text.
    ``docs``: id, text; ``labels``: id, toxic."""
    texts = materialise(_training(docs, labels, sample_rows), "toxicity-training")
    n = {(r.toxic, r.calibrates): r["count"] for r in texts.groupBy("toxic", "calibrates").count().collect()}
    bad, good = (sum(v for (t, _), v in n.items() if t is x) for x in (True, False))
    if not bad or not good:
        share = F.lit(1.0 if bad else 0.0)
        return lambda frame: frame.drop("text").withColumn("score", share)
    fits = texts.where(~F.col("calibrates")) if n.get((True, False)) and n.get((False, False)) else texts
    lexicon = learn_lexicon(fits.select("toxic", "text"))
    rows = materialise(with_features(texts, lexicon), "toxicity-features")
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    labelled = assembler.transform(rows.withColumn("label", F.col("toxic").cast("double")))
    fitted = labelled.where(~F.col("calibrates")) if fits is not texts else labelled
    trees = GBTClassifier(maxIter=20, maxDepth=4, stepSize=0.2, minInstancesPerNode=2, seed=SEED).fit(fitted)
    rest = labelled.where("calibrates") if n.get((True, True)) and n.get((False, True)) else labelled
    steps = IsotonicRegression(featuresCol="margin").fit(_margin(trees, rest).select("label", "margin"))

    def score(frame: DataFrame) -> DataFrame:
        others = frame.drop("text").columns
        known = _margin(trees, assembler.transform(with_features(frame, lexicon)))
        # The step function alone would tie most rows; a hundredth keeps their order.
        smooth = 1 / (1 + F.exp(-2 * F.col("margin")))
        return steps.transform(known).select(*others, (0.99 * F.col("prediction") + 0.01 * smooth).alias("score"))

    return score


def _margin(trees: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    out = trees.transform(rows)
    return out.withColumn("margin", vector_to_array("rawPrediction")[1]).drop("prediction", "probability", "rawPrediction")


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``id_col``, held_out, score and predicted of each document. ``labels`` has
    ``id_col`` and ``toxic``."""
    texts = docs.select(F.col(id_col).alias("id"), "text")
    score = fit(texts, labels.select(F.col(id_col).alias("id"), "toxic"), sample_rows)
    return score(texts).select(
        F.col("id").alias(id_col),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
