"""Language identification by unigram pieces, summed over all segmentations.

The pieces are a fixed public vocabulary; nothing is learned about it.  Per
language, piece probabilities are fitted by expectation-maximisation: expected
piece counts over all segmentations of the training words (forward-backward),
then normalised.  A text is scored by the forward algorithm: the probability of
a word is the sum over all its segmentations of the products of piece
probabilities, and a text is the product over its words.  The answer is the
language of greatest posterior under equal priors; the score is that posterior,
with the evidence per text scaled to ``TEMPER`` words, so that long texts do not
all score 1.

Words are runs of letters, lower-cased, with the vocabulary's mark of a word
start in front.  A word of more than ``MAX_WORD`` characters is scored in
stretches of that length.  Words that share a spelling share a score, so each
task scores the different words of a batch once, as one matrix.

Training data: a bounded sample of labelled rows, ``PER_LANGUAGE`` rows of each
language on average, picked by a hash of the id.  Only word counts of the sample
are shuffled; only one row per (language, piece) reaches the driver, of which
there are (pieces x languages) at most.

Cases: null texts and texts without a letter are ``und`` with score 0; labels
that are null are not learned from; equal posteriors go to the language that
sorts first; repeated rows are scored each; without any training row every text
is ``und``; an empty table gives an empty one; extra columns are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postwright.llm.common import map_rows, with_fields

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "piece_bpe_32k.model"
#: Training rows per language, on average.
PER_LANGUAGE = 2000
#: Labels that are learned, the most frequent ones.
MAX_LANGUAGES = 256
#: Rounds of expectation-maximisation.
ROUNDS = 2
#: Characters of a word that are scored together.
MAX_WORD = 32
#: Longest piece that is used.
MAX_PIECE = 8
#: Words whose evidence the score stands for.
TEMPER = 10.0
#: Count added to every piece, and probability of a character outside the vocabulary.
SMOOTHING = 0.05
UNKNOWN = 1e-6
#: Each character scales the forward sums by this, so that they stay in range.
SCALE = 100.0
#: Words whose scores a task remembers; words and characters it works on at once.
CACHE = 200_000
WORDS_AT_ONCE = 20_000
CHARS_AT_ONCE = 1 << 19

START = "▁"
LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
UNDETERMINED = "und"


@cache
def pieces(folder: str = TOKENIZERS, name: str = VOCABULARY) -> tuple[str, ...]:
    """The pieces of the vocabulary that can occur in a word, in sorted order."""
    import sentencepiece

    if folder not in sys.path:
        sys.path.insert(0, folder)
    import public_tokenizers

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
    wanted = set()
    for k in range(model.vocab_size()):
        piece = model.id_to_piece(k)
        body = piece.removeprefix(START)
        if model.is_control(k) or model.is_unknown(k) or model.is_byte(k):
            continue
        if len(piece) <= MAX_PIECE and (LETTERS.fullmatch(body) or piece == START):
            if body == body.lower():
                wanted.add(piece)
    return tuple(sorted(wanted))


_BASE = np.uint64(0x9E3779B97F4A7C15)


class Lattice:
    """Finds the pieces of words: one look-up per start and length for a whole matrix of words.

    Substrings are compared by a 64-bit polynomial hash.  The hash table is an
    array of twice-doubled size with linear probing.
    """

    def __init__(self, vocabulary: tuple[str, ...]) -> None:
        self.n = len(vocabulary)
        size = 1 << (4 * max(self.n, 1)).bit_length()
        self.mask = np.uint64(size - 1)
        self.keys = np.zeros(size, dtype=np.uint64)
        self.ids = np.full(size, -1, dtype=np.int32)
        self.longest = max((len(p) for p in vocabulary), default=1)
        for k, piece in enumerate(vocabulary):
            h = np.uint64(0)
            with np.errstate(over="ignore"):
                for c in piece:
                    h = h * _BASE + np.uint64(ord(c))
            slot = self._slot(h)
            while self.ids[slot] >= 0:
                slot = (slot + 1) & int(self.mask)
            self.keys[slot], self.ids[slot] = h, k

    def _slot(self, h: np.uint64) -> int:
        return int((h ^ (h >> np.uint64(29))) & self.mask)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece numbers of substring hashes; -1 where there is none."""
        slot = (hashes ^ (hashes >> np.uint64(29))) & self.mask
        ids = self.ids[slot]
        hit = self.keys[slot] == hashes
        found = np.where(hit, ids, np.int32(-1))
        # slots held by another piece: look on, for these alone
        rest = np.flatnonzero((ids >= 0) & ~hit)
        wanted, at = hashes.ravel()[rest], slot.ravel()[rest]
        while len(rest):
            at = (at + np.uint64(1)) & self.mask
            ids = self.ids[at]
            hit = (ids >= 0) & (self.keys[at] == wanted)
            found.ravel()[rest[hit]] = ids[hit]
            on = (ids >= 0) & ~hit
            rest, wanted, at = rest[on], wanted[on], at[on]
        return found

    def edges(self, codes: np.ndarray) -> list[np.ndarray]:
        """For each piece length l, the piece that covers characters j..j+l-1 of each word."""
        rows, width = codes.shape
        out = []
        running = np.zeros((rows, width), dtype=np.uint64)
        for length in range(1, self.longest + 1):
            if length > width:
                break
            span = width - length + 1
            running = running[:, :span] * _BASE + codes[:, length - 1 :]
            out.append(self.find(running))
        return out


def matrices(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words of equal length as matrices of code points, with their places in the list."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        flat = "".join([words[k] for k in at]).encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(flat, dtype="<u4").reshape(len(at), length).astype(np.uint64)
        yield codes, at


def _weights(edge: np.ndarray, scaled: np.ndarray, length: int) -> np.ndarray:
    """Probability of each edge for one language; unknown single characters have their own."""
    weight = scaled[edge]
    if length > 1:
        weight[edge < 0] = 0.0
    else:
        weight[edge < 0] = UNKNOWN * SCALE
    return weight


def forward(edges: list[np.ndarray], scaled: list[np.ndarray], width: int) -> np.ndarray:
    """Scaled sums over all segmentations of each beginning; column j covers j characters."""
    rows = edges[0].shape[0]
    alpha = np.zeros((rows, width + 1))
    alpha[:, 0] = 1.0
    weights = [_weights(e, scaled[k], k + 1) for k, e in enumerate(edges)]
    for j in range(1, width + 1):
        total = alpha[:, j]
        for k in range(min(j, len(edges))):
            total += alpha[:, j - k - 1] * weights[k][:, j - k - 1]
    return alpha


def expected(edges: list[np.ndarray], scaled: list[np.ndarray], width: int, n: int,
             times: np.ndarray) -> np.ndarray:
    """Expected piece counts of words that occur ``times`` each."""
    alpha = forward(edges, scaled, width)
    beta = np.zeros_like(alpha)
    beta[:, width] = 1.0
    weights = [_weights(e, scaled[k], k + 1) for k, e in enumerate(edges)]
    for j in range(width - 1, -1, -1):
        for k in range(min(width - j, len(edges))):
            beta[:, j] += weights[k][:, j] * beta[:, j + k + 1]
    scale = times / alpha[:, width]
    counts = np.zeros(n)
    for k, edge in enumerate(edges):
        for j in range(edge.shape[1]):
            held = alpha[:, j] * weights[k][:, j] * beta[:, j + k + 1] * scale
            known = edge[:, j] >= 0
            counts += np.bincount(edge[known, j], weights=held[known], minlength=n)
    return counts


def scaled_rows(probabilities: np.ndarray, longest: int) -> list[np.ndarray]:
    """Piece probabilities times SCALE per character, by piece length."""
    padded = np.append(probabilities, 0.0)  # place -1 stands for no piece
    return [padded * SCALE ** (k + 1) for k in range(longest)]


def split_words(text: str) -> list[str]:
    """Lower-cased words, in stretches of MAX_WORD characters, the first with the start mark."""
    out = []
    for word in LETTERS.findall(text.lower()):
        if len(word) <= MAX_WORD:
            out.append(START + word)
        else:
            marked = START + word
            out += [marked[k : k + MAX_WORD] for k in range(0, len(marked), MAX_WORD)]
    return out


class Model:
    """Piece probabilities of each language."""

    def __init__(self, languages: list[str], probabilities: np.ndarray,
                 vocabulary: tuple[str, ...]) -> None:
        self.languages = languages
        self.lattice = Lattice(vocabulary)
        self.scaled = [scaled_rows(p, self.lattice.longest) for p in probabilities]
        self.known: dict[str, int] = {}
        self.table = np.zeros((0, len(languages)))

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log probability of each word (rows) in each language (columns)."""
        out = np.zeros((len(words), len(self.languages)))
        for start in range(0, len(words), WORDS_AT_ONCE):
            for codes, at in matrices(words[start : start + WORDS_AT_ONCE]):
                width = codes.shape[1]
                edges = self.lattice.edges(codes)
                for column, scaled in enumerate(self.scaled):
                    total = forward(edges, scaled, width)[:, width]
                    out[start + at, column] = np.log(total) - width * np.log(SCALE)
        return out

    def score(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text; a few texts at a time, so that memory is bounded."""
        if not self.languages:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts)
        names: list[str] = []
        scores: list[float] = []
        part: list[str | None] = []
        held = 0
        for text in texts:
            part.append(text)
            held += len(text or "") + 100
            if held > CHARS_AT_ONCE:
                self._score_into(part, names, scores)
                part, held = [], 0
        self._score_into(part, names, scores)
        return names, scores

    def _score_into(self, texts: list[str | None], names: list[str], scores: list[float]) -> None:
        lists = [split_words(t) if t else [] for t in texts]
        if len(self.known) > CACHE:
            self.known, self.table = {}, self.table[:0]
        known = self.known
        new = list({w for words in lists for w in words if w not in known})
        if new:
            known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
            self.table = np.concatenate([self.table, self.word_scores(new)])
        for words in lists:
            if not words:
                names.append(UNDETERMINED)
                scores.append(0.0)
                continue
            at = np.fromiter((known[w] for w in words), dtype=np.int64, count=len(words))
            total = self.table[at].sum(axis=0)
            best = int(total.argmax())
            relative = (total - total[best]) * min(1.0, TEMPER / len(words))
            names.append(self.languages[best])
            scores.append(float(1.0 / np.exp(relative).sum()))


def held_out(key: str = "doc_id") -> F.Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_words(documents: DataFrame, key: str, text: str, lang: str,
                   per_language: int) -> DataFrame:
    """(lang, word, times) over the sample."""
    labelled = documents.filter(
        ~held_out(key) & F.col(lang).isNotNull() & F.col(text).isNotNull()
    ).select(F.col(lang).alias("lang"), F.col(text).alias("text"), key)
    share = {
        r["lang"]: min(1.0, per_language / r["n"])
        for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).collect()
    }
    if not share:
        return None
    cut = F.create_map(*[F.lit(x) for pair in share.items() for x in pair])[F.col("lang")]
    place = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1_000_003)) / F.lit(1_000_003.0)
    sample = labelled.filter(place < cut).select("lang", "text")

    def run(batches):
        for batch in batches:
            frames = []
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                   strict=True):
                words, times = np.unique(split_words(value), return_counts=True)
                if not len(words):
                    continue
                frames.append(pd.DataFrame({"lang": name, "word": words, "times": times}))
            if frames:
                whole = pd.concat(frames).groupby(["lang", "word"], as_index=False)["times"].sum()
                yield pa.RecordBatch.from_pandas(whole, preserve_index=False, schema=pa.schema(
                    [("lang", pa.string()), ("word", pa.string()), ("times", pa.int64())]))

    counted = sample.mapInArrow(run, "lang string, word string, times bigint")
    return counted.groupBy("lang", "word").agg(F.sum("times").alias("times"))


def fit(documents: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
        per_language: int = PER_LANGUAGE, folder: str = TOKENIZERS,
        name: str = VOCABULARY) -> tuple[list[str], np.ndarray]:
    """Languages and their piece probabilities."""
    from postwright.llm.common import stage

    vocabulary = pieces(folder, name)
    words = training_words(documents, key, text, lang, per_language)
    if words is None:
        return [], np.zeros((0, len(vocabulary)))
    counted = stage(words, "words")
    languages = sorted(r["lang"] for r in counted.select("lang").distinct().collect())
    n = len(vocabulary)
    probabilities = np.full((len(languages), n), 1.0 / max(n, 1))
    for _ in range(ROUNDS):
        sums = _expected_counts(counted, languages, probabilities, folder, name)
        probabilities = (sums + SMOOTHING) / (sums + SMOOTHING).sum(axis=1, keepdims=True)
    return languages, probabilities


def _expected_counts(counted: DataFrame, languages: list[str], probabilities: np.ndarray,
                     folder: str, name: str) -> np.ndarray:
    """Sums of expected counts, added up per (language, piece) by the cluster."""
    held: SparkSession = counted.sparkSession.sparkContext.broadcast(probabilities)

    def run(batches):
        vocabulary = pieces(folder, name)
        lattice = Lattice(vocabulary)
        sums = np.zeros((len(languages), len(vocabulary)))
        for batch in batches:
            frame = batch.to_pandas()
            for row, language in enumerate(languages):
                own = frame[frame["lang"] == language]
                if not len(own):
                    continue
                scaled = scaled_rows(held.value[row], lattice.longest)
                times = own["times"].to_numpy(dtype=float)
                for codes, at in matrices(own["word"].tolist()):
                    sums[row] += expected(
                        lattice.edges(codes), scaled, codes.shape[1], len(vocabulary), times[at]
                    )
        row, piece = np.nonzero(sums)
        yield pa.RecordBatch.from_pydict({
            "row": pa.array(row, pa.int32()), "piece": pa.array(piece, pa.int32()),
            "n": pa.array(sums[row, piece], pa.float64()),
        })

    found = (
        counted.mapInArrow(run, "row int, piece int, n double")
        .groupBy("row", "piece").agg(F.sum("n").alias("n")).toPandas()
    )
    held.unpersist()
    sums = np.zeros_like(probabilities)
    sums[found["row"], found["piece"]] = found["n"]
    return sums


def identify(documents: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
             per_language: int = PER_LANGUAGE, folder: str = TOKENIZERS,
             name: str = VOCABULARY) -> DataFrame:
    """(key, held_out, lang_pred, score) of each document, learned from the labelled ones."""
    languages, probabilities = fit(documents, key, text, lang, per_language, folder, name)
    # bounded by pieces x languages; a worker process loads it once for all its tasks
    model = Model(languages, probabilities, pieces(folder, name))
    held = documents.sparkSession.sparkContext.broadcast(model)
    source = documents.select(key, F.col(text).alias("_text"), held_out(key).alias("held_out"))
    schema = with_fields(source, [key, "held_out"], "lang_pred string, score double")

    def make():
        model = held.value

        def work(batch: pa.RecordBatch) -> dict:
            names, scores = model.score(batch.column(1).to_pylist())
            return {key: batch.column(0), "held_out": batch.column(2), "lang_pred": names,
                    "score": scores}

        return work

    return map_rows(source, schema, make)
