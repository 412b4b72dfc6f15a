"""TF-IDF index over the taxonomy and the similarity join.

Weights: (1 + ln tf) * (ln((1 + N) / (1 + df)) + 1), scaled to unit length per
document.  A phrase meets a taxonomy skill only through a shared term, and only
through those of its terms that can lift the cosine over the needed bound, so
neither a cross join nor the pairs of very common terms are ever formed.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postwright import fixed
from postwright.functions import phrases
from postwright.functions.sql import let
from postwright.operators.shaping import (
    HOT_SHARE,
    Reference,
    Skew,
    first_per,
    join_spread,
    measured,
    probe,
)
from postwright.operators.taxonomy import best_per_skill
from postwright.session import stored, work_path

_COSINE_DIGITS = 9
_SLACK = 1e-9


@dataclass(frozen=True)
class SimilarityIndex:
    vocabulary: Reference  # term, df, idf
    documents: Reference  # doc, taxonomy columns, weights: map term -> weight
    postings: Reference  # term, doc


def corpus(taxonomy: DataFrame, prefix: int | None = None) -> DataFrame:
    """One document per taxonomy skill: its name and its description.

    With ``prefix``, only that many characters of the description.
    """
    name = F.coalesce("taxonomy_skill", F.lit(""))
    start = F.coalesce("taxonomy_description", F.lit(""))
    if prefix is not None:
        start = F.substring(start, 1, prefix)
    # "=" keeps a skill with an empty name apart from one without a name
    doc = F.coalesce(F.concat(F.lit("="), F.col("taxonomy_skill")), F.lit(""))
    return best_per_skill(taxonomy).select(
        doc.alias("doc"),
        "taxonomy_skill",
        "taxonomy_description",
        "taxonomy_source",
        "correlation",
        F.concat_ws(" ", name, start).alias("text"),
    )


def term_counts(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, tf) rows; terms are counted map-side, then per key."""
    terms = texts.select(key, F.explode(F.expr(phrases.index_terms(text))).alias("term"))
    return terms.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def vocabulary(counts: DataFrame, documents: int, max_terms: int | None = None) -> DataFrame:
    """All terms, or the ``max_terms`` most frequent, with document frequency and smoothed idf."""
    terms = counts.groupBy("term").agg(
        F.sum("tf").alias("frequency"), F.count(F.lit(1)).alias("df")
    )
    if max_terms is not None:
        terms = terms.orderBy(F.col("frequency").desc(), F.col("term").asc()).limit(max_terms)
    return terms.withColumn("idf", F.log((1.0 + documents) / (1.0 + F.col("df"))) + 1.0)


def _vectors(
    counts: DataFrame, terms: Reference, key: str, limit: int | None = None
) -> DataFrame:
    """Unit vector per key as an array of (weight, term), heaviest first."""
    weighted = probe(counts, terms.only("term", "idf"), "term", [key], "inner", limit).select(
        key, ((1.0 + F.log("tf")) * F.col("idf")).alias("weight"), "term"
    )
    gathered = weighted.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("weight", "term")), asc=False).alias("_raw")
    )
    norm = "sqrt(aggregate(_raw, 0D, (s, x) -> s + x.weight * x.weight))"
    scaled = "transform(_raw, x -> named_struct('weight', x.weight / norm, 'term', x.term))"
    return gathered.select(key, F.expr(let(norm, "norm", scaled)).alias("vector"))


def build_index(
    taxonomy: DataFrame,
    max_terms: int | None = None,
    prefix: int | None = None,
    path: str | None = None,
) -> SimilarityIndex:
    """Fit the index once; every posting batch reuses it.

    Its tables are written under ``path`` (a folder of its own in the work folder
    unless given) and read back, so no plan that uses them repeats the fit.
    """
    path = path or work_path(taxonomy.sparkSession, f"index-{uuid.uuid4().hex}")

    def kept(df: DataFrame, name: str, **facts: F.Column) -> Reference:
        return measured(stored(df, f"{path}/{name}"), persist=False, **facts)

    docs = kept(corpus(taxonomy, prefix), "corpus")
    counts = stored(term_counts(docs.table, "doc", "text"), f"{path}/counts")
    terms = kept(vocabulary(counts, docs.rows, max_terms), "vocabulary")
    as_map = F.map_from_entries(
        F.transform("vector", lambda x: F.struct(x["term"], x["weight"]))
    )
    vectors = _vectors(counts, terms, "doc").select("doc", as_map.alias("weights"))
    documents = kept(
        docs.table.drop("text").join(vectors, "doc"),
        "documents",
        best=F.max("correlation"),
        terms=F.coalesce(F.sum(F.size("weights")), F.lit(0)),
    )
    postings = kept(
        documents.table.select(F.explode(F.map_keys("weights")).alias("term"), "doc"), "postings"
    )
    return SimilarityIndex(terms, documents, postings)


def index_weights(index: SimilarityIndex) -> DataFrame:
    """The fitted matrix in long form: (taxonomy_skill, term, weight)."""
    return index.documents.table.select(
        "taxonomy_skill", F.explode("weights").alias("term", "weight")
    )


def phrase_vectors(
    distinct_phrases: DataFrame, index: SimilarityIndex, limit: int | None = None
) -> DataFrame:
    """Unit vector per phrase in the fitted vocabulary; phrases without known terms drop out."""
    return _vectors(
        term_counts(distinct_phrases.withColumn("_text", F.col("phrase")), "phrase", "_text"),
        index.vocabulary,
        "phrase",
        limit,
    )


def _leading_terms(vector: str, bound: float) -> str:
    """Shortest head of the vector (heaviest terms first) whose tail is shorter than ``bound``.

    A document that shares only tail terms with the phrase has a cosine of at
    most the tail's length, so every document that reaches the bound shares a
    term of the head.
    """
    safe = bound * (1.0 - 1e-6) - _SLACK
    step = (
        f"(s, x) -> CASE WHEN sqrt(greatest(s.rest, 0D)) >= {safe!r}D "
        "THEN named_struct('rest', s.rest - x.weight * x.weight, 'n', s.n + 1) ELSE s END"
    )
    head = f"aggregate({vector}, named_struct('rest', 1D, 'n', 0), {step}, s -> s.n)"
    return f"transform(slice({vector}, 1, {head}), x -> x.term)"


def similar_skills(
    distinct_phrases: DataFrame,
    index: SimilarityIndex,
    min_confidence: float = fixed.MIN_CONFIDENCE,
    top_k: int = 1,
    limit: int | None = None,
) -> DataFrame:
    """Best ``top_k`` taxonomy skills per phrase, by cosine, with enough confidence.

    Confidence is cosine times correlation, so no pair below
    ``min_confidence / highest correlation`` can survive, and leaving such pairs
    out cannot change the rank of one that does.
    """
    best = index.documents.facts["best"] or 0.0
    bound = max(fixed.MIN_COSINE, min_confidence / best if best > 0 else fixed.MIN_COSINE)
    vectors = phrase_vectors(distinct_phrases.select("phrase"), index, limit)
    headed = vectors.withColumn("_head", F.expr(_leading_terms("vector", bound)))
    leads = headed.select("phrase", "vector", "_head", F.posexplode("_head").alias("_at", "term"))
    pairs = probe(leads, index.postings, "term", ["phrase"], "inner", limit)
    scored = probe(pairs, index.documents, "doc", ["phrase", "term"], "inner", limit)
    # a document met through several head terms counts once: through the first
    earlier = F.expr("exists(slice(_head, 1, _at), t -> map_contains_key(weights, t))")
    cosine = F.expr(
        "aggregate(vector, 0D, "
        "(s, x) -> s + x.weight * coalesce(try_element_at(weights, x.term), 0D))"
    )
    cosines = (
        scored.filter(~earlier)
        .withColumn("cosine", F.bround(cosine, _COSINE_DIGITS))
        .select(
            "phrase", "cosine", "correlation", "taxonomy_skill", "taxonomy_description",
            "taxonomy_source",
        )
    )
    order = [F.col("cosine").desc(), F.col("taxonomy_skill").asc_nulls_last()]
    return (
        first_per(cosines, ["phrase"], order, top_k)
        # only now: before the ranking this would compute every cosine twice
        .filter(F.col("cosine") >= fixed.MIN_COSINE)
        .withColumn("_confidence", F.col("cosine") * F.col("correlation"))
        .filter(F.col("_confidence") >= min_confidence)
        .select(
            F.col("phrase").alias("raw_skill"),
            "taxonomy_skill",
            "taxonomy_description",
            "taxonomy_source",
            F.bround("_confidence", 4).alias("confidence"),
            F.lit("tfidf").alias("match_method"),
        )
    )


def similarity_matches(
    candidates: DataFrame,
    index: SimilarityIndex,
    min_confidence: float = fixed.MIN_CONFIDENCE,
    top_k: int = 1,
    limit: int | None = None,
) -> DataFrame:
    """Similarity mappings of every candidate row.

    Each distinct phrase is compared once.  The distinct phrases are counted and
    stored first; the few that fill much of the candidates (at most
    1 / HOT_SHARE) are known by then and are spread over several tasks when the
    result goes back to the rows that hold them.
    """
    path = work_path(candidates.sparkSession, f"phrases-{uuid.uuid4().hex}")
    counts = measured(
        stored(candidates.groupBy("phrase").agg(F.count(F.lit(1)).alias("n")), path),
        persist=False,
        total=F.sum("n"),
    )
    least = max(2.0, HOT_SHARE * (counts.facts["total"] or 0))
    hot = [r["phrase"] for r in counts.table.filter(F.col("n") >= least).collect()]
    matches = similar_skills(counts.table, index, min_confidence, top_k, limit)
    renamed = candidates.withColumnRenamed("phrase", "raw_skill")
    spread = [c for c in renamed.columns if c != "raw_skill"]
    return join_spread(renamed, matches, "raw_skill", spread, "inner", Skew(hot))
