"""Skill candidates, exact mapping, per-posting ranking and job summaries.

A posting is identified by a row key, not by its job id: candidates, the
one-row-per-taxonomy-skill rule and the skill limit apply to each posting row,
while counts and the top-skill text are per job id.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postwright import fixed
from postwright.functions import phrases
from postwright.operators.postings import ROW_KEY, with_row_key
from postwright.operators.shaping import Reference, first_per, join_spread, measured, probe
from postwright.operators.taxonomy import exact_lookup
from postwright.operators.tries import scan_tokens

ID = "system_job_id"


def build_lookup(taxonomy: DataFrame, max_words: int | None = None) -> Reference:
    """Best row per raw skill, cached and measured once for all postings.

    The fact ``sizes`` lists the phrase lengths, in words, that a window can
    match: all that occur, or those up to ``max_words``.
    """
    table = exact_lookup(taxonomy).withColumnRenamed("raw_skill", "phrase")
    words = F.size(F.split("phrase", " "))
    usable = F.length("phrase") >= fixed.MIN_PHRASE_LENGTH
    if max_words is not None:
        usable = usable & (words <= max_words)
    return measured(table, sizes=F.array_sort(F.collect_set(F.when(usable, words))))


def phrase_arrays(
    postings: DataFrame, keep: Sequence[str], sizes: Sequence[int] | None = None, text: str = "description_clean"
) -> DataFrame:
    """The distinct window phrases of each posting as one array; only ``keep`` columns travel along."""
    sizes = range(1, fixed.MAX_PHRASE_TOKENS + 1) if sizes is None else sizes
    found = phrases.skill_phrases(phrases.skill_tokens(text), sizes)
    # as the row of a generator: a later filter on a column would be moved in front of any
    # exchange below, and the arrays be built twice, the first time in the tasks of the scan
    return postings.select(*keep, F.explode(F.array(F.expr(found))).alias("phrases"))


def exploded_phrases(
    postings: DataFrame, keep: Sequence[str], sizes: Sequence[int] | None = None, text: str = "description_clean"
) -> DataFrame:
    """One row per posting and distinct window phrase; only ``keep`` columns travel along."""
    sizes = range(1, fixed.MAX_PHRASE_TOKENS + 1) if sizes is None else sizes
    found = phrases.skill_phrases(phrases.skill_tokens(text), sizes)
    # exploded as an expression: over a column, Spark would add a filter on the array's
    # size and build the array twice
    return postings.select(*keep, F.explode(F.expr(found)).alias("phrase"))


def without_noise(candidates: DataFrame) -> DataFrame:
    """Benefit words on their own are no skills."""
    return candidates.filter(~F.col("phrase").isin(fixed.BENEFIT_NOISE))


def phrase_candidates(
    postings: DataFrame,
    lookup: Reference,
    keep: Sequence[str] = (ROW_KEY, ID),
    text: str = "description_clean",
    limit: int | None = None,
) -> DataFrame:
    """Phrases of each posting that may be in the lookup.

    A lookup within the limit is held by every task as a trie, and only phrases
    that are in it come out.  Beyond it, all windows do whose length occurs there.
    """
    sizes = lookup.facts["sizes"]
    if not sizes:
        return postings.select(*keep, F.lit("").alias("phrase")).filter(F.lit(False))
    if not lookup.fits(limit):
        return without_noise(exploded_phrases(postings, keep, sizes, text))
    usable = F.length("phrase") >= fixed.MIN_PHRASE_LENGTH
    usable &= F.size(F.split("phrase", " ")).isin(sizes)
    entries = [r[0] for r in lookup.table.filter(usable).select("phrase").distinct().collect()]
    tokens = postings.select(*keep, F.expr(phrases.skill_tokens(text)).alias("_tokens"))
    return without_noise(scan_tokens(tokens, "_tokens", entries, keep, "phrase"))


def vocabulary_scan(
    postings: DataFrame,
    lookup: Reference,
    keep: Sequence[str] = (ROW_KEY, ID),
    text: str = "description_clean",
    limit: int | None = None,
) -> DataFrame:
    """Candidates: phrases of the text that are in the lookup."""
    found = phrase_candidates(postings, lookup, keep, text, limit)
    if lookup.fits(limit):
        return found
    return probe(found, lookup.only("phrase"), "phrase", keep, "left_semi", limit)


def union_candidates(vocabulary: DataFrame, extra: DataFrame) -> DataFrame:
    """Vocabulary hits plus phrases from another source, which need not be in the lookup."""
    allowed = extra.filter(
        (F.length("phrase") >= fixed.MIN_PHRASE_LENGTH)
        & ~F.col("phrase").isin(fixed.SKILL_STOPWORDS)
    )
    return without_noise(vocabulary.unionByName(allowed)).dropDuplicates()


def _exact_side(lookup: Reference, min_confidence: float) -> Reference:
    kept = replace(lookup, table=lookup.table.filter(F.col("correlation") >= min_confidence))
    return kept.only(
        "phrase",
        "taxonomy_skill",
        F.bround("correlation", 4).alias("confidence"),
        F.lit("exact").alias("match_method"),
    )


def exact_matches(
    candidates: DataFrame,
    lookup: Reference,
    min_confidence: float = fixed.MIN_CONFIDENCE,
    limit: int | None = None,
) -> DataFrame:
    """Candidates found in the lookup with enough correlation."""
    spread = [c for c in candidates.columns if c != "phrase"]
    side = _exact_side(lookup, min_confidence)
    found = probe(candidates, side, "phrase", spread, "inner", limit)
    return found.withColumnRenamed("phrase", "raw_skill")


def residual_candidates(
    candidates: DataFrame, lookup: Reference, limit: int | None = None
) -> DataFrame:
    """Candidates absent from the lookup: the only ones that go to similarity."""
    spread = [c for c in candidates.columns if c != "phrase"]
    return probe(candidates, lookup.only("phrase"), "phrase", spread, "left_anti", limit)


def with_details(mapped: DataFrame, lookup: Reference, limit: int | None = None) -> DataFrame:
    """Add description and source of exact matches.

    Done after ranking, so that the long texts are not shuffled with every candidate.
    """
    side = lookup.only(
        F.col("phrase").alias("raw_skill"), "taxonomy_description", "taxonomy_source"
    )
    spread = [c for c in mapped.columns if c != "raw_skill"]
    return probe(mapped, side, "raw_skill", spread, "left", limit)


def _best_order() -> list:
    return [F.col("confidence").desc(), F.col("match_method").asc(), F.col("raw_skill").asc()]


def one_per_taxonomy_skill(mapped: DataFrame, key: str = ROW_KEY) -> DataFrame:
    """Best mapping per posting and taxonomy skill."""
    return first_per(mapped, [key, "taxonomy_skill"], _best_order())


def top_skills_per_posting(
    mapped: DataFrame, max_skills: int | None = None, key: str = ROW_KEY
) -> DataFrame:
    """The ``max_skills`` most confident mappings per posting; all of them unless given."""
    if max_skills is None:
        return mapped
    confidence, *ties = _best_order()
    order = [confidence, F.col("taxonomy_skill").asc_nulls_last(), *ties]
    return first_per(mapped, [key], order, max_skills)


def rank_mappings(
    mapped: DataFrame, max_skills: int | None = None, key: str = ROW_KEY
) -> DataFrame:
    """One row per posting and taxonomy skill, or the best ``max_skills`` of these."""
    return top_skills_per_posting(one_per_taxonomy_skill(mapped, key), max_skills, key)


def map_postings(
    postings: DataFrame,
    lookup: Reference,
    min_confidence: float = fixed.MIN_CONFIDENCE,
    max_skills: int | None = None,
    text: str = "description_clean",
    id_col: str = ID,
    limit: int | None = None,
) -> DataFrame:
    """Long skills table of cleaned postings.

    Every vocabulary candidate is in the lookup, so scan and exact mapping are
    one join and nothing is left over for similarity.
    """
    keyed = with_row_key(postings)
    found = phrase_candidates(keyed, lookup, (ROW_KEY, id_col), text, limit)
    mapped = exact_matches(found, lookup, min_confidence, limit)
    # Row keys are unique and a posting's phrases are bounded by its text, so one
    # exchange on the row key serves both rankings.  Candidates from elsewhere have no
    # such bound: rank_mappings alone groups those by (key, skill) first.
    ranked = rank_mappings(mapped.repartition(ROW_KEY), max_skills)
    columns = [id_col if c == ID else c for c in fixed.SKILL_OUTPUT_COLUMNS]
    return with_details(ranked, lookup, limit).select(*columns)


def skill_summary(skills: DataFrame, key: str = ID, n: int = 3) -> DataFrame:
    """Skill count and top-``n`` text per job id, from one pass over the skills.

    Rows are first summed per (id, skill), map-side, so that even a job id with
    very many rows brings at most one row per taxonomy skill to its group.
    """
    per_skill = (
        skills.filter(F.col(key).isNotNull())
        .groupBy(key, "taxonomy_skill")
        .agg(F.max("confidence").alias("confidence"), F.count(F.lit(1)).alias("n"))
    )
    order = Window.partitionBy(key).orderBy(
        F.col("taxonomy_skill").isNull(), F.col("confidence").desc(), F.col("taxonomy_skill")
    )
    ranked = per_skill.withColumn("rank", F.row_number().over(order))
    top = F.when(
        (F.col("rank") <= n) & F.col("taxonomy_skill").isNotNull(),
        F.struct("rank", "taxonomy_skill"),
    )
    in_order = F.array_sort(F.collect_list(top))
    return ranked.groupBy(key).agg(
        F.sum("n").alias("skill_count"),
        F.array_join(F.transform(in_order, lambda x: x["taxonomy_skill"]), " | ").alias(
            "top_3_skills"
        ),
    )


def _attach(jobs: DataFrame, per_id: DataFrame, key: str, defaults: dict) -> DataFrame:
    """Left join on the job id; the copies of a very common id are spread by row key."""
    joined = join_spread(with_row_key(jobs), per_id, key, [ROW_KEY]).fillna(defaults)
    return joined.select(*jobs.columns, *defaults)


def attach_skill_count(jobs: DataFrame, skills: DataFrame, key: str = ID) -> DataFrame:
    """Number of skill rows per job id, zero where there are none."""
    counts = (
        skills.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("skill_count"))
    )
    return _attach(jobs, counts, key, {"skill_count": 0})


def attach_top_skills(jobs: DataFrame, skills: DataFrame, key: str = ID, n: int = 3) -> DataFrame:
    """Top-``n`` taxonomy skills per job id as one text, empty where there are none."""
    return _attach(jobs, skill_summary(skills, key, n), key, {"top_3_skills": ""})


def attach_summary(jobs: DataFrame, skills: DataFrame, key: str = ID, n: int = 3) -> DataFrame:
    """Skill count and top-skill text with one join."""
    summary = skill_summary(skills, key, n)
    return _attach(jobs, summary, key, {"skill_count": 0, "top_3_skills": ""})
