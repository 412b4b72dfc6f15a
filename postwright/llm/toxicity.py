"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

Examples are a bounded sample of labelled documents.  Terms are lower-cased
words and their beginnings of ``STEMS`` letters; those are indexed whose
presence depends on the label (chi-square of the 2 x 2 table of examples at
least ``MIN_CHI``).  All words without an indexed term count as one more term of
idf 1, their number rounded to a power of two, so that a cosine also tells a
dense text from a long one with a single term.  A vector holds (1 + ln tf) * idf,
scaled to length 1.

The index is inverted: per term a list of (example, weight), examples dealt into
blocks of ``BLOCK``, and per term and block the greatest weight.  A query sums
its own weights times these maxima: a bound on the cosine of any example of the
block.  Blocks are opened from the greatest bound down until no bound exceeds
the k-th best cosine found, so the k nearest are exact; of equal cosines the
example that stands first in the index wins.

The score is a vote of the ``K`` nearest, each weighted by its cosine, together
with ``PRIOR`` votes at the rate of toxic examples, and is calibrated on the
examples themselves: each is scored without itself, and the rate of toxic ones
is made a non-decreasing function of the vote (pooling adjacent violators, ties
pooled).  A document with no indexed term has no neighbour; it gets the rate of
toxic examples among those without an indexed term.

Cases: null and empty texts are scored as documents without a term; null labels
and ids are not learned from; a labelled id that occurs in several documents
gives an example for each; without examples every score is 0; an empty table
gives an empty one; extra columns are not read, and no column but the text
enters a score.  Texts are read whole.

The sample, and so the index, is bounded by ``MAX_EXAMPLES`` rows on average,
whatever the size of the corpus; term counts are summed by the cluster and only
the indexed terms reach the driver.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postwright.llm.common import map_rows, stage, with_fields

#: Examples on average.
MAX_EXAMPLES = 8000
#: Least chi-square of an indexed term, and examples it stands in.
MIN_CHI = 20.0
MIN_EXAMPLES = 3
#: Most indexed terms, the most telling ones.
MAX_TERMS = 20_000
#: Neighbours that vote, and votes of the overall rate among them.
K = 25
PRIOR = 1.0
#: Examples of a block.
BLOCK = 64
#: Letters of the word beginnings that are terms too.
STEMS = (3, 5, 7)
#: Words a task remembers.
CACHE = 400_000
#: A score from here on is predicted toxic.
CUT = 0.3

_LETTERS = bytes(x if 0x61 <= x <= 0x7A or x >= 0x80 else 0x20 for x in range(256))


def held_out(key: str = "doc_id") -> F.Column:
    """Documents whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def word_counts(text: str | None) -> Counter[bytes]:
    """Counts of the lower-cased words of a text: runs of letters and non-ASCII characters."""
    if not text:
        return Counter()
    raw = text.lower().encode("utf-8", "surrogatepass")
    return Counter(raw.translate(_LETTERS).split())


def terms_of(word: bytes) -> list[str]:
    """The terms a word stands for: itself and its beginnings."""
    text = word.decode("utf-8", "replace")
    return [text, *[text[:n] + "*" for n in STEMS if len(text) > n]]


class Index:
    """Block-max inverted index over labelled examples.

    Examples are (counts of indexed terms, number of other words), and a label.
    """

    def __init__(self, idf: dict[str, float],
                 examples: list[tuple[dict[str, int], int, float]]) -> None:
        names = sorted(idf)
        self.names = {t: k for k, t in enumerate(names)}
        self.rest = len(names)
        self.idf = np.array([*[idf[t] for t in names], 1.0])
        self.labels = np.array([y for *_, y in examples], dtype=float)
        self.rate = float(self.labels.mean()) if examples else 0.0
        self.blocks = -(-len(examples) // BLOCK)
        self.words: dict[bytes, tuple[int, ...]] = {}
        self.vectors = [
            self.vector({self.names[t]: n for t, n in counts.items()}, rest)
            for counts, rest, _ in examples
        ]
        # examples of alike weights stand together, so that the maxima of a block are tight
        place = [
            (int(at[w.argmax()]), -float(w.max()), k) if len(at) else (-1, 0.0, k)
            for k, (at, w) in enumerate(self.vectors)
        ]
        self.order = np.array([k for *_, k in sorted(place)], dtype=np.int64)
        self.vectors = [self.vectors[k] for k in self.order.tolist()]
        self.labels = self.labels[self.order]
        lists: list[list[tuple[int, float]]] = [[] for _ in self.idf]
        for example, (at, weights) in enumerate(self.vectors):
            for term, weight in zip(at.tolist(), weights.tolist(), strict=True):
                lists[term].append((example, weight))
        self.postings = [
            (np.array([e for e, _ in x], dtype=np.int64), np.array([w for _, w in x]))
            for x in lists
        ]
        self.maxima = np.zeros((len(lists), self.blocks))
        self.starts = []
        for term, (ids, weights) in enumerate(self.postings):
            np.maximum.at(self.maxima[term], ids // BLOCK, weights)
            self.starts.append(np.searchsorted(ids, np.arange(self.blocks + 1) * BLOCK))
        bare = [y for (at, _), y in zip(self.vectors, self.labels, strict=True) if not len(at)]
        # with the overall rate as one more example, so that few examples decide little
        self.bare = float((sum(bare) + self.rate) / (len(bare) + 1))
        self.steps = self._calibrate()
        self.seen: dict[tuple, tuple[float, list]] = {}

    def vector(self, counts: dict[int, int], rest: int) -> tuple[np.ndarray, np.ndarray]:
        """Terms and weights, of length 1 together; nothing without an indexed term."""
        if not counts:
            return np.zeros(0, dtype=np.int64), np.zeros(0)
        if rest > 0:
            counts = counts | {self.rest: 1 << round(math.log2(rest))}
        ids = np.array(sorted(counts), dtype=np.int64)
        weights = np.array([1 + math.log(counts[k]) for k in ids.tolist()]) * self.idf[ids]
        return ids, weights / math.sqrt(float(weights @ weights))

    def counts(self, text: str | None) -> tuple[dict[int, int], int]:
        """Counts of the indexed terms of a text, and the number of its other words."""
        found: dict[int, int] = {}
        rest = 0
        known, names = self.words, self.names
        if len(known) > CACHE:
            known.clear()
        for word, n in word_counts(text).items():
            at = known.get(word)
            if at is None:
                at = known[word] = tuple(names[t] for t in terms_of(word) if t in names)
            if at:
                for term in at:
                    found[term] = found.get(term, 0) + n
            else:
                rest += n
        return found, rest

    def nearest(self, ids: np.ndarray, weights: np.ndarray, k: int = K,
                without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of greatest positive cosine, and the cosines."""
        bounds = weights @ self.maxima[ids]
        best_ids, best = np.zeros(0, dtype=np.int64), np.zeros(0)
        for block in np.lexsort((np.arange(self.blocks), -bounds)):
            # an equal bound may still bring an equal cosine of a smaller number
            if bounds[block] <= 0 or (len(best) == k and bounds[block] < best[-1] - 1e-12):
                break
            sums = np.zeros(BLOCK)
            for term, weight in zip(ids, weights, strict=True):
                a, b = self.starts[term][block : block + 2]
                if a < b:
                    at, held = self.postings[term]
                    sums[at[a:b] - block * BLOCK] += weight * held[a:b]
            if without // BLOCK == block:
                sums[without % BLOCK] = 0.0
            places = np.flatnonzero(sums > 0)
            best_ids = np.concatenate([best_ids, places + block * BLOCK])
            best = np.round(np.concatenate([best, sums[places]]), 12)
            order = np.lexsort((best_ids, -best))[:k]
            best_ids, best = best_ids[order], best[order]
        return best_ids, best

    def vote(self, found: np.ndarray, cosines: np.ndarray) -> float:
        """Share of toxic neighbours by cosine, the overall rate among them."""
        return float(
            (cosines @ self.labels[found] + PRIOR * self.rate) / (cosines.sum() + PRIOR)
        )

    def _calibrate(self) -> tuple[np.ndarray, np.ndarray]:
        """Votes and the rates they stand for: a step function through the examples."""
        points: dict[float, list[float]] = {}
        for number, (ids, weights) in enumerate(self.vectors):
            if len(ids):
                vote = round(self.vote(*self.nearest(ids, weights, without=number)), 9)
                point = points.setdefault(vote, [0.0, 0.0])
                point[0] += 1
                point[1] += self.labels[number]
        pooled: list[list[float]] = []  # weight, sum, vote up to here
        for vote in sorted(points):
            n, toxic = points[vote]
            pooled.append([n, toxic, vote])
            while len(pooled) > 1 and pooled[-2][1] * pooled[-1][0] >= pooled[-1][1] * pooled[-2][0]:
                last = pooled.pop()
                pooled[-1] = [pooled[-1][0] + last[0], pooled[-1][1] + last[1], last[2]]
        rate = self.rate
        return (
            np.array([v for _, _, v in pooled]),
            np.array([(s + rate) / (n + 1) for n, s, _ in pooled]),
        )

    def score(self, text: str | None) -> tuple[float, list[tuple[int, float]]]:
        """Calibrated score of a text and its evidence: (example, cosine)."""
        ids, weights = self.vector(*self.counts(text))
        if not len(ids):
            return self.bare, []
        key = (ids.tobytes(), weights.tobytes())
        if key not in self.seen:
            if len(self.seen) > 50_000:
                self.seen.clear()
            found, cosines = self.nearest(ids, weights)
            vote = round(self.vote(found, cosines), 9)
            votes, rates = self.steps
            if len(votes):
                step = min(int(np.searchsorted(votes, vote)), len(votes) - 1)
                vote = float(rates[step])
            own = self.order[found].tolist()
            self.seen[key] = vote, list(zip(own, cosines.tolist(), strict=True))
        return self.seen[key]


def sample(documents: DataFrame, labels: DataFrame, key: str, text: str, label: str,
           max_examples: int) -> DataFrame:
    """(id, text, y) of a bounded sample of labelled documents that are not held out.

    Labels are thinned by a hash of the id first; only those meet the documents.
    """
    usable = labels.filter(
        F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(key)
    ).select(F.col(key).alias("l_key"), F.col(label).cast("double").alias("y"))
    n = usable.count()
    place = F.pmod(F.xxhash64(F.col("l_key").cast("string")), F.lit(1_000_003)) / F.lit(1_000_003.0)
    thin = usable.filter(place < min(1.0, max_examples / max(n, 1)))
    # bounded by max_examples on average, so a broadcast whatever the corpus
    source = documents.select(F.col(key).alias("d_key"), F.col(text).alias("text"))
    return source.join(F.broadcast(thin), F.col("d_key") == F.col("l_key")).select(
        F.col("d_key").cast("string").alias("id"), "text", "y"
    )


def fit(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
        label: str = "toxic", max_examples: int = MAX_EXAMPLES) -> tuple[dict, list, list]:
    """idf of the indexed terms; examples as (term counts, other words, label); their ids."""
    found = sample(documents, labels, key, text, label, max_examples)
    schema = with_fields(found, ["id", "y"], "words map<binary,int>, terms array<string>")

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            words = [word_counts(t) for t in batch.column(1).to_pylist()]
            return {
                "id": batch.column(0), "y": batch.column(2),
                "words": [list(x.items()) for x in words],
                "terms": [list({t for w in x for t in terms_of(w)}) for x in words],
            }

        return work

    counted = stage(map_rows(found, schema, make), "examples")
    facts = counted.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("toxic")).first()
    n, toxic = facts["n"], facts["toxic"] or 0.0
    if not n:
        return {}, [], []
    # chi-square of the 2 x 2 table of term and label
    a, df = F.col("a"), F.col("df")
    cross = a * n - df * toxic
    chi = n * cross * cross / (df * (n - df + 1e-9) * (toxic + 1e-9) * (n - toxic + 1e-9))
    telling = (
        counted.select("y", F.explode("terms").alias("term"))
        .groupBy("term").agg(F.sum("y").alias("a"), F.count(F.lit(1)).cast("double").alias("df"))
        .filter(df >= MIN_EXAMPLES).withColumn("chi", chi).filter(F.col("chi") >= MIN_CHI)
        .orderBy(F.desc("chi"), "term").limit(MAX_TERMS)
    )
    idf = {r["term"]: math.log((1 + n) / (1 + r["df"])) + 1 for r in telling.collect()}
    wanted = documents.sparkSession.sparkContext.broadcast(frozenset(idf))
    thin_schema = with_fields(counted, ["id", "y"], "terms map<string,int>, rest bigint")

    def thin_make():
        def work(batch: pa.RecordBatch) -> dict:
            known = wanted.value
            held, rest = [], []
            for words in batch.column(2).to_pylist():
                own: dict[str, int] = {}
                other = 0
                for word, n in words:
                    at = [t for t in terms_of(word) if t in known]
                    for term in at:
                        own[term] = own.get(term, 0) + n
                    other += 0 if at else n
                held.append(list(own.items()))
                rest.append(other)
            return {"id": batch.column(0), "y": batch.column(1), "terms": held, "rest": rest}

        return work

    thin = map_rows(counted.select("id", "y", "words"), thin_schema, thin_make).collect()
    rows = sorted((r["id"], sorted(r["terms"].items()), r["rest"], r["y"]) for r in thin)
    return idf, [(dict(t), n, y) for _, t, n, y in rows], [i for i, *_ in rows]


def score(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          label: str = "toxic", max_examples: int = MAX_EXAMPLES, cut: float = CUT,
          evidence: int = 3) -> DataFrame:
    """(key, held_out, score, predicted, evidence) of each document.

    ``evidence`` lists the nearest examples as structs of id and cosine.
    """
    idf, examples, names = fit(documents, labels, key, text, label, max_examples)
    # bounded by max_examples; a worker process loads it once for all its tasks
    held = documents.sparkSession.sparkContext.broadcast((Index(idf, examples), names))
    source = documents.select(key, F.col(text).alias("_text"), held_out(key).alias("held_out"))
    schema = with_fields(
        source, [key, "held_out"],
        "score double, predicted int, evidence array<struct<example:string,cosine:double>>",
    )

    def make():
        index, ids = held.value

        def work(batch: pa.RecordBatch) -> dict:
            found = [index.score(t) for t in batch.column(1).to_pylist()]
            return {
                key: batch.column(0),
                "held_out": batch.column(2),
                "score": [s for s, _ in found],
                "predicted": [int(s >= cut) for s, _ in found],
                "evidence": [
                    [{"example": ids[i], "cosine": c} for i, c in near[:evidence]]
                    for _, near in found
                ],
            }

        return work

    return map_rows(source, schema, make)
