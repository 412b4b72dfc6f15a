"""One callable per query: (spark, folder of Parquet tables) -> DataFrame."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postwright import fixed
from postwright.functions import coerce, phrases, text
from postwright.operators import mapping, postings, report, similarity, skills, taxonomy
from postwright.operators.shaping import Reference
from postwright.plans import structure as plans
from postwright.session import stored, work_path
from postwright.sinks import tables as sinks
from postwright.sources import tables as sources
from postwright.streaming import incremental
from workload import views

ID = "system_job_id"
SAMPLE = 1000


# ------------------------------------------------------------------ shared inputs


def _prepared(spark: SparkSession, folder: str) -> DataFrame:
    return postings.prepare_postings(views.postings(spark, folder))


def _cleaned(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned postings; their ids are unique and serve as row keys."""
    cleaned = postings.clean_postings(_prepared(spark, folder))
    return cleaned.withColumn(skills.ROW_KEY, F.col(ID))


def _fields(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return postings.structure_fields(_prepared(spark, folder)).select(ID, *columns)


def _taxonomy(spark: SparkSession, folder: str) -> DataFrame:
    return taxonomy.clean_taxonomy(views.taxonomy(spark, folder), fixed.MIN_CONFIDENCE)


def _lookup(spark: SparkSession, folder: str) -> Reference:
    return skills.build_lookup(_taxonomy(spark, folder))


def _index(spark: SparkSession, folder: str) -> similarity.SimilarityIndex:
    return similarity.build_index(_taxonomy(spark, folder))


def _scan(spark: SparkSession, folder: str) -> DataFrame:
    return skills.vocabulary_scan(_cleaned(spark, folder), _lookup(spark, folder))


def _mapped(spark: SparkSession, folder: str) -> DataFrame:
    lookup = _lookup(spark, folder)
    return skills.exact_matches(
        skills.vocabulary_scan(_cleaned(spark, folder), lookup), lookup
    )


def _long(spark: SparkSession, folder: str) -> DataFrame:
    return skills.map_postings(_cleaned(spark, folder), _lookup(spark, folder))


def _title_phrases(df: DataFrame) -> DataFrame:
    """The title and its words as candidates from another source."""
    title = F.lower("title")
    found = F.array_distinct(F.concat(F.array(title), F.split(title, " ")))
    return df.select(skills.ROW_KEY, ID, F.explode(found).alias("phrase"))


def _candidates(spark: SparkSession, folder: str, lookup: Reference | None = None) -> DataFrame:
    keyed = _cleaned(spark, folder)
    scan = skills.vocabulary_scan(keyed, lookup or _lookup(spark, folder))
    return skills.union_candidates(scan, _title_phrases(keyed))


def _structured(spark: SparkSession, folder: str) -> plans.Structured:
    keyed = _prepared(spark, folder).withColumn(skills.ROW_KEY, F.col(ID))
    return plans.structure(keyed, _lookup(spark, folder))


def _epochs(df: DataFrame) -> DataFrame:
    """Timestamps as seconds, so that no session time zone enters the comparison."""
    return df.withColumns(
        {c: F.unix_timestamp(c) for c in fixed.TIMESTAMP_COLUMNS if c in df.columns}
    )


# ------------------------------------------------------------------ scans and typing


def scan_postings(spark, folder):
    return _epochs(_prepared(spark, folder))


def scan_postings_csv(spark, folder):
    """The raw postings written as CSV, one half with its columns in another order, and scanned back."""
    path = work_path(spark, f"csv-{uuid.uuid4().hex}")
    raw = views.postings(spark, folder)
    even = F.col(ID).cast("long") % 2 == 0
    sinks.write_table(raw.filter(even), path)
    sinks.write_table(raw.filter(~even).select(*reversed(raw.columns)), path, mode="append")
    return _epochs(sources.scan_postings(spark, path)).drop(skills.ROW_KEY)


def scan_postings_lines(spark, folder):
    """Descriptions of several lines, with quotes, in one CSV file that is read by splits."""
    path = work_path(spark, f"csv-{uuid.uuid4().hex}")
    lined = F.concat("description", F.expr(views.LINES.format("title")))
    raw = views.postings(spark, folder).withColumn("description", lined)
    # dealt to one task after the join: coalesced, that task would run the whole join
    sinks.write_table(raw.repartition(1), path)
    return _epochs(sources.scan_postings(spark, path)).drop(skills.ROW_KEY)


def scan_taxonomy_csv(spark, folder):
    """The taxonomy written as CSV under its source headings and scanned back."""
    path = work_path(spark, f"csv-{uuid.uuid4().hex}")
    headings = {name: source for source, name in fixed.TAXONOMY_COLUMNS.items()}
    sinks.write_table(views.taxonomy(spark, folder).withColumnsRenamed(headings), path)
    return sources.scan_taxonomy(spark, path, fixed.MIN_CONFIDENCE)


def active_only(spark, folder):
    return postings.prepare_postings(views.postings(spark, folder), active_only=True).select(
        ID, "expired"
    )


def tri_bool(spark, folder):
    return views.postings(spark, folder).select(
        ID, F.col("expired").alias("raw"), F.expr(coerce.tri_state("expired")).alias("expired")
    )


def numeric_coerce(spark, folder):
    return views.postings(spark, folder).select(
        ID,
        *[
            F.expr(coerce.to_number(c)).alias(c)
            for c in ("parameters_salary_min", "parameters_salary_max")
        ],
    )


def timestamp_coerce(spark, folder):
    typed = postings.type_postings(
        views.postings(spark, folder).select(ID, *fixed.TIMESTAMP_COLUMNS)
    )
    return _epochs(typed)


def null_tokens(spark, folder):
    return postings.null_missing(views.postings(spark, folder).select(ID, "job_id", "created_date"))


def sample_limit(spark, folder):
    raw = views.postings(spark, folder).orderBy(ID)
    return postings.prepare_postings(raw, active_only=True, sample_size=SAMPLE).select(
        ID, "title", "expired"
    )


def sample_in_order(spark, folder):
    """The first active postings in file order, read from files in the order of their ids."""
    path = work_path(spark, f"csv-{uuid.uuid4().hex}")
    number = F.col(ID).cast("long")
    in_order = views.postings(spark, folder).repartitionByRange(8, number)
    sinks.write_table(in_order.sortWithinPartitions(number), path)
    return sources.scan_postings(spark, path, active_only=True, sample_size=SAMPLE).select(
        ID, "title", "expired"
    )


def union_sources(spark, folder):
    raw = views.postings(spark, folder)
    narrow = raw.drop("parameters_salary_min", "parameters_salary_max", "expired")
    both = postings.union_sources([narrow, raw])
    return postings.prepare_postings(both).select(ID, "title", "parameters_salary_min", "expired")


def bool_render(spark, folder):
    return sinks.render_booleans(_prepared(spark, folder).select(ID, "expired"))


def float_rounding(spark, folder):
    third = _prepared(spark, folder).select(
        ID, (F.col("parameters_salary_min") / 7.0).alias("parameters_salary_min")
    )
    return sinks.round_doubles(third)


# ------------------------------------------------------------------ cleaning


def mask_pii(spark, folder):
    documents = views.table(spark, folder, "documents")
    return text.chain(documents, "text", text.MASK_CONTACTS, "masked").select("doc_id", "masked")


def strip_html(spark, folder):
    pages = views.table(spark, folder, "pages")
    steps = (*text.STRIP_MARKUP, coerce.strip)
    return text.chain(pages, "html", steps, "stripped").select("page_id", "stripped")


def tidy_layout(spark, folder):
    documents = views.table(spark, folder, "documents")
    return text.chain(documents, "text", text.TIDY_LAYOUT, "tidied").select("doc_id", "tidied")


def clean_text(spark, folder):
    pages = views.table(spark, folder, "pages")
    return text.clean_description(pages, "html", "cleaned").select("page_id", "cleaned")


def clean_documents(spark, folder):
    documents = views.table(spark, folder, "documents")
    return text.clean_description(documents, "text", "cleaned").select("doc_id", "cleaned")


def clean_conversations(spark, folder):
    turns = views.table(spark, folder, "conversations")
    return text.clean_description(turns, "text", "cleaned").select("conv_id", "turn", "cleaned")


def description_stats(spark, folder):
    cleaned = postings.clean_postings(views.table(spark, folder, "documents"), "text")
    return report.description_stats(cleaned)


# ------------------------------------------------------------------ fields


def extract_salary(spark, folder):
    return _fields(spark, folder, "salary_text_min", "salary_text_max", "salary_text_unit")


def extract_education(spark, folder):
    return _fields(spark, folder, "education_min")


def extract_experience(spark, folder):
    return _fields(spark, folder, "experience_min_years", "experience_max_years")


def employment_flags(spark, folder):
    return _fields(spark, folder, *fixed.EMPLOYMENT_FLAGS)


def remote_flag(spark, folder):
    return _fields(spark, folder, "is_remote")


def benefit_flags(spark, folder):
    return _fields(spark, folder, *fixed.BENEFIT_FLAGS)


def merge_salary(spark, folder):
    return _fields(spark, folder, "salary_final_min", "salary_final_max", "salary_final_unit")


def pay_by_unit(spark, folder):
    """Mean final minimum pay per unit over all postings."""
    fields = _fields(spark, folder, "salary_final_min", "salary_final_unit")
    return fields.groupBy("salary_final_unit").agg(
        F.count(F.lit(1)).alias("postings"),
        F.bround(F.avg("salary_final_min"), 4).alias("mean_min"),
    )


# ------------------------------------------------------------------ taxonomy


def taxonomy_clean(spark, folder):
    return _taxonomy(spark, folder)


def taxonomy_stats(spark, folder):
    return taxonomy.taxonomy_stats(views.taxonomy(spark, folder))


def taxonomy_lookup(spark, folder):
    return taxonomy.exact_lookup(_taxonomy(spark, folder))


def unknown_sources(spark, folder):
    return taxonomy.unknown_sources(_taxonomy(spark, folder))


# ------------------------------------------------------------------ skills


def skill_tokens(spark, folder):
    tokens = F.expr(phrases.skill_tokens("text"))
    return (
        views.table(spark, folder, "documents")
        .select("doc_id", tokens.alias("tokens"))
        .select(
            "doc_id",
            F.size("tokens").cast("long").alias("n_tokens"),
            F.array_join("tokens", " ").alias("tokens"),
        )
    )


def skill_ngrams(spark, folder):
    """Counts and extremes of each document's phrases, taken from its array."""
    documents = views.table(spark, folder, "documents")
    return skills.phrase_arrays(documents, ["doc_id"], text="text").select(
        "doc_id",
        F.size("phrases").cast("long").alias("n_phrases"),
        F.length(F.array_join("phrases", "")).cast("long").alias("n_chars"),
        F.array_min("phrases").alias("first_phrase"),
        F.array_max("phrases").alias("last_phrase"),
    ).filter("n_phrases > 0")


def skill_vocab_scan(spark, folder):
    return _scan(spark, folder).select(ID, "phrase")


def skill_candidates_union(spark, folder):
    return _candidates(spark, folder).select(ID, "phrase")


def skill_exact_match(spark, folder):
    return _mapped(spark, folder).drop(skills.ROW_KEY)


def skill_residual(spark, folder):
    lookup = _lookup(spark, folder)
    found = _candidates(spark, folder, lookup)
    return skills.residual_candidates(found, lookup).select(ID, "phrase")


def skill_map_dedup(spark, folder):
    return skills.one_per_taxonomy_skill(_mapped(spark, folder)).drop(skills.ROW_KEY)


def skill_topk(spark, folder):
    deduped = skills.one_per_taxonomy_skill(_mapped(spark, folder))
    return skills.top_skills_per_posting(deduped, 1).drop(skills.ROW_KEY)


def skill_count(spark, folder):
    jobs = _prepared(spark, folder).select(ID, "title")
    return skills.attach_skill_count(jobs, _long(spark, folder))


def top3_skills(spark, folder):
    jobs = _prepared(spark, folder).select(ID, "title")
    return skills.attach_top_skills(jobs, _long(spark, folder))


def structured_skills(spark, folder):
    return sinks.format_skills(_long(spark, folder))


def ids_padded_or_missing(spark, folder):
    """Skills of postings a third of whose ids are padded and one of which has none."""
    raw = views.postings(spark, folder)
    prepared = postings.prepare_postings(raw.withColumn(ID, F.expr(views.LOOSE_IDS.format(ID))))
    cleaned = postings.clean_postings(prepared)
    return sinks.format_skills(skills.map_postings(cleaned, _lookup(spark, folder)))


def structured_jobs(spark, folder):
    return sinks.format_jobs(_epochs(_structured(spark, folder).jobs))


# ------------------------------------------------------------------ similarity


def tfidf_corpus(spark, folder):
    return similarity.corpus(_taxonomy(spark, folder)).select(
        "taxonomy_skill", "correlation", "text"
    )


def tfidf_vocab(spark, folder):
    docs = similarity.corpus(_taxonomy(spark, folder))
    counts = similarity.term_counts(docs, "doc", "text")
    return similarity.vocabulary(counts, docs.count()).select(
        "term", "frequency", "df", F.bround("idf", 6).alias("idf")
    )


def tfidf_vocab_capped(spark, folder):
    docs = similarity.corpus(_taxonomy(spark, folder))
    counts = similarity.term_counts(docs, "doc", "text")
    return similarity.vocabulary(counts, docs.count(), 50).select("term", "frequency", "df")


def tfidf_index(spark, folder):
    return similarity.index_weights(_index(spark, folder)).select(
        "taxonomy_skill", "term", F.bround("weight", 6).alias("weight")
    )


def _all_phrases(spark, folder):
    windows = skills.exploded_phrases(_cleaned(spark, folder), [ID])
    return windows.select("phrase").distinct()


def skill_tfidf_match(spark, folder):
    return similarity.similar_skills(_all_phrases(spark, folder), _index(spark, folder))


def skill_tfidf_top3(spark, folder):
    index = _index(spark, folder)
    return similarity.similar_skills(_all_phrases(spark, folder), index, 0.2, 3)


def map_to_taxonomy(spark, folder):
    path = work_path(spark, f"candidates-{uuid.uuid4().hex}")
    lookup = _lookup(spark, folder)
    found = mapping.map_to_taxonomy(
        stored(_candidates(spark, folder, lookup), path), lookup, _index(spark, folder)
    )
    return sinks.format_skills(skills.rank_mappings(found))


# ------------------------------------------------------------------ report and whole runs


def coverage(spark, folder):
    return report.coverage(_structured(spark, folder).jobs)


def top_skills(spark, folder):
    return report.top_skills(_long(spark, folder))


def _flat(summary: DataFrame) -> DataFrame:
    return summary.select(
        "cleaning_stats.*",
        "totals.*",
        "extraction_coverage.*",
        F.transform("top_20_taxonomy_skills", lambda x: x["taxonomy_skill"])[0].alias("top_skill"),
        F.transform("top_20_taxonomy_skills", lambda x: x["job_count"])[0].alias("top_count"),
        F.size("top_20_taxonomy_skills").cast("long").alias("top_listed"),
    )


def quality_report(spark, folder):
    out = work_path(spark, f"report-{uuid.uuid4().hex}")
    keyed = _prepared(spark, folder).withColumn(skills.ROW_KEY, F.col(ID))
    result = plans.write_structured(keyed, _lookup(spark, folder), out, fmt="parquet")
    return _flat(report.quality_report(result.jobs, result.skills, result.jobs, plans.LENGTH))


def full_run(spark, folder):
    """CSV files in, title phrases as further candidates, three outputs written, the report read back."""
    base = work_path(spark, f"run-{uuid.uuid4().hex}")
    headings = {name: source for source, name in fixed.TAXONOMY_COLUMNS.items()}
    sinks.write_table(views.postings(spark, folder), f"{base}/in/postings")
    sinks.write_table(
        views.taxonomy(spark, folder).withColumnsRenamed(headings), f"{base}/in/taxonomy"
    )
    return _flat(plans.run(
        spark, f"{base}/in/postings", f"{base}/in/taxonomy", f"{base}/out", extra=_title_phrases
    ))


def _streamed(spark, folder):
    """The postings as a stream of files, one batch per file, structured batch by batch."""
    base = work_path(spark, f"stream-{uuid.uuid4().hex}")
    stored_orders = spark.read.parquet(f"{folder}/orders.parquet")
    stored_orders.repartitionByRange(3, "o_orderkey").write.parquet(f"{base}/in")
    orders = (
        spark.readStream.schema(stored_orders.schema).option("maxFilesPerTrigger", 1)
        .parquet(f"{base}/in")
    )
    # the narrow rows are dealt before the texts are made: a file is one task's
    orders = orders.repartition(spark.sparkContext.defaultParallelism)
    raw = views.postings_from(orders, views.table(spark, folder, "part"))
    query = incremental.structure_stream(
        raw, _lookup(spark, folder), f"{base}/out", f"{base}/checkpoint", buckets=8
    )
    query.awaitTermination()
    return f"{base}/out"


def stream_structured_jobs(spark, folder):
    out = _streamed(spark, folder)
    return _epochs(spark.read.parquet(f"{out}/structured_jobs").drop("batch"))


def stream_structured_skills(spark, folder):
    return spark.read.parquet(f"{_streamed(spark, folder)}/structured_skills").drop("batch")


def stream_files_jobs(spark, folder):
    """Files of two headings arriving in one folder; each batch reads its files by heading."""
    base = work_path(spark, f"stream-{uuid.uuid4().hex}")
    # which rows share a file, and so a batch, shows in the counts of an id that comes twice
    raw = views.postings_from(
        views.table(spark, folder, "orders"), views.table(spark, folder, "part")
    )
    even = F.col(ID).cast("long") % 2 == 0
    sinks.write_table(raw.filter(even).coalesce(2), f"{base}/in")
    other = raw.filter(~even).select(*reversed(raw.columns)).coalesce(2)
    sinks.write_table(other, f"{base}/in", mode="append")
    incremental.structure_stream(
        incremental.stream_files(spark, f"{base}/in", 3), _lookup(spark, folder), f"{base}/out",
        f"{base}/checkpoint", buckets=8,
    ).awaitTermination()
    return _epochs(spark.read.parquet(f"{base}/out/structured_jobs").drop("batch"))


def stream_totals(spark, folder):
    return incremental.running_totals(spark, _streamed(spark, folder))


def _sent_again(spark, folder):
    """The postings as a stream whose first quarter is sent again, with other job numbers, at last."""
    base = work_path(spark, f"stream-{uuid.uuid4().hex}")
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    part = views.table(spark, folder, "part")
    lookup = _lookup(spark, folder)
    n = orders.count()
    key = F.col("o_orderkey")
    changed = (F.col("o_custkey") + 1).cast(orders.schema["o_custkey"].dataType)
    for sending in (
        orders.filter(key < n // 2),
        orders.filter(key >= n // 2),
        orders.filter(key < n // 4).withColumn("o_custkey", changed),
    ):
        sending.write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(orders.schema).parquet(f"{base}/in")
        stream = stream.repartition(spark.sparkContext.defaultParallelism)
        incremental.structure_stream(
            views.postings_from(stream, part), lookup, f"{base}/out", f"{base}/checkpoint", buckets=8
        ).awaitTermination()
    return f"{base}/out"


def stream_upsert_jobs(spark, folder):
    return _epochs(incremental.merged(spark, _sent_again(spark, folder)).jobs)


def stream_upsert_counts(spark, folder):
    """Mappings per taxonomy skill over the last sendings."""
    return report.top_skills(incremental.merged(spark, _sent_again(spark, folder)).skills)


def stream_report(spark, folder):
    """The report over the last sendings, from the sums that each batch stored."""
    return _flat(incremental.running_report(spark, _sent_again(spark, folder)))


ALL = [
    scan_postings, scan_postings_csv, scan_postings_lines, scan_taxonomy_csv, active_only, tri_bool, numeric_coerce,
    timestamp_coerce, null_tokens, sample_limit, sample_in_order, union_sources, bool_render, float_rounding,
    mask_pii, strip_html, tidy_layout, clean_text, clean_documents, clean_conversations,
    description_stats,
    extract_salary, extract_education, extract_experience, employment_flags, remote_flag,
    benefit_flags, merge_salary, pay_by_unit,
    taxonomy_clean, taxonomy_stats, taxonomy_lookup, unknown_sources,
    skill_tokens, skill_ngrams, skill_vocab_scan, skill_candidates_union, skill_exact_match,
    skill_residual, skill_map_dedup, skill_topk, skill_count, top3_skills, structured_skills,
    ids_padded_or_missing, structured_jobs,
    tfidf_corpus, tfidf_vocab, tfidf_vocab_capped, tfidf_index, skill_tfidf_match,
    skill_tfidf_top3, map_to_taxonomy,
    coverage, top_skills, quality_report, full_run,
    stream_structured_jobs, stream_structured_skills, stream_files_jobs, stream_totals,
    stream_upsert_jobs, stream_upsert_counts, stream_report,
]
QUERIES = {query.__name__: query for query in ALL}
