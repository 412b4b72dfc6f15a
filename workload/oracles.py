"""The same queries as DuckDB SQL over the whole tables.

``compare.py`` and the tests run them against the Spark results.  Patterns and word lists
are the fixed values; RE2 takes them with ``(?i)`` where Java takes ``(?iU)``.
"""

from __future__ import annotations

from postwright import fixed
from workload import views

SAMPLE = 1000


def q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def listed(values) -> str:
    return ", ".join(q(v) for v in values)


def sub(text: str, pattern: str, by: str, flags: str = "") -> str:
    by = q(by) if "\n" not in by else f"repeat(chr(10), {len(by)})"
    prefix = f"(?{flags})" if flags else ""
    return f"regexp_replace({text}, {q(prefix + pattern)}, {by}, 'g')"


def found(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, {q('(?i)' + pattern)})"


def strip(text: str) -> str:
    return sub(text, rf"\A{fixed.SPACE}+|{fixed.SPACE}+\z", "")


# ------------------------------------------------------------------ scans and typing


def not_null_token(column: str) -> str:
    return f"CASE WHEN {column} NOT IN ({listed(fixed.NULL_TOKENS)}) THEN {column} END"


def tri(column: str) -> str:
    word = f"upper({strip(column)})"
    return f"CASE WHEN {word} = 'TRUE' THEN TRUE WHEN {word} = 'FALSE' THEN FALSE END"


def number(column: str) -> str:
    grammar = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
    return (
        f"CASE WHEN regexp_matches({column}, {q(grammar)}) "
        f"THEN TRY_CAST(trim({column}) AS DOUBLE) END"
    )


def epoch(column: str) -> str:
    return f"CAST(epoch(TRY_CAST({column} AS TIMESTAMP)) AS BIGINT)"


TEXTS = ["system_job_id", "job_id", "title", "description", "date_acquired", "created_date",
         "expired", "parameters_salary_min", "parameters_salary_max", "parameters_salary_unit"]

RAW = f"postings AS ({views.POSTINGS})"
NULLED = "nulled AS (SELECT " + ", ".join(
    f"{not_null_token(c)} AS {c}" for c in TEXTS
) + " FROM postings)"
TYPED = f"""typed AS (SELECT
  {strip('system_job_id')} AS system_job_id, job_id, title, description,
  {epoch('date_acquired')} AS date_acquired, {epoch('created_date')} AS created_date,
  parameters_salary_unit,
  {number('parameters_salary_min')} AS parameters_salary_min,
  {number('parameters_salary_max')} AS parameters_salary_max,
  {tri('expired')} AS expired
FROM nulled)"""
ACTIVE = "active AS (SELECT * FROM nulled WHERE upper(expired) IS DISTINCT FROM 'TRUE')"


# ------------------------------------------------------------------ cleaning


ENTITIES = [
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"),
    ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"),
]


def masked(text: str) -> str:
    text = sub(text, fixed.URL, " <URL> ", "i")
    text = sub(text, fixed.PHONE, " <PHONE> ")
    return sub(text, fixed.EMAIL, " <EMAIL> ")


def tidied(text: str) -> str:
    text = sub(text, fixed.BULLET, "\n", "m")
    text = sub(text, fixed.HORIZONTAL_SPACE, " ")
    return strip(sub(text, fixed.NEWLINE_RUN, "\n\n"))


def markup_stripped(text: str) -> str:
    return sub(sub(text, fixed.HTML_TAG, " "), fixed.HTML_ENTITY, " ")


def cleaned(text: str) -> str:
    """Whole cleaning, for tables whose entities are those listed and whose text is NFKC."""
    text = f"coalesce({text}, '')"
    for entity, character in ENTITIES:
        text = f"replace({text}, {q(entity)}, {q(character)})"
    return tidied(masked(markup_stripped(text)))


CLEAN = f"clean AS MATERIALIZED (SELECT *, {cleaned('description')} AS text FROM typed)"


def stats(length: str) -> str:
    return f"""count(*) AS "count", count(*) FILTER ({length} = 0) AS empty,
  CAST(round_even(avg({length}), 1) AS DOUBLE) AS mean_length,
  CAST(round_even(quantile_cont({length}, 0.5), 1) AS DOUBLE) AS median_length,
  max({length}) AS max_length,
  coalesce(min({length}) FILTER ({length} > 0), 0) AS min_nonzero_length"""


# ------------------------------------------------------------------ fields


def groups(text: str, pattern: str, *names: str) -> str:
    """The groups of the first match as a struct: the pattern is run once."""
    return f"regexp_extract({text}, {q('(?i)' + pattern)}, [{listed(names)}])"


def amount(text: str, scale: str) -> str:
    return f"TRY_CAST(replace({text}, ',', '') AS DOUBLE) * {scale}"


def unit(text: str) -> str:
    return "CASE " + " ".join(
        f"WHEN {found(text, p)} THEN {q(label)}" for label, p, *_ in fixed.PAY_UNITS
    ) + " END"


def pay_columns(name: str, scale: str) -> str:
    return f"""{amount(f'{name}.a', scale)} AS {name}_a,
  nullif({amount(f'{name}.b', scale)}, 0) AS {name}_b, {unit(f'{name}.u')} AS {name}_u"""


def in_bounds(name: str) -> str:
    bounds = " ".join(
        f"WHEN {q(label)} THEN least({name}_a, {name}_b) BETWEEN {lo} AND {hi}"
        for label, _, lo, hi in fixed.PAY_UNITS
    )
    return f"coalesce(CASE {name}_u {bounds} END, FALSE) AS {name}_ok"


def of_pay(value: str) -> str:
    """The dollar amount's value where it counts, else that of the amount in thousands."""
    return (
        f"CASE WHEN dollar_ok THEN {value.format('dollar')} "
        f"WHEN kilo_ok THEN {value.format('kilo')} END"
    )


def education(text: str) -> str:
    return "CASE " + " ".join(
        f"WHEN {found(text, p)} THEN {q(label)}" for label, p in fixed.EDUCATION_TIERS
    ) + f" ELSE {q(fixed.NO_EDUCATION)} END"


WORDS = "CASE lower(y1) " + " ".join(
    f"WHEN {q(w)} THEN {i}" for i, w in enumerate(fixed.NUMBER_WORDS, 1)
) + " ELSE TRY_CAST(y1 AS DOUBLE) END"
FLAGS = ", ".join(f"{found('text', p)} AS {n}" for n, p in fixed.FLAGS.items())

FIELDS = f"""matched AS (SELECT *, {groups('text', fixed.SALARY_DOLLAR, 'a', 'b', 'u')} AS dollar,
  {groups('text', fixed.SALARY_K, 'a', 'b', 'u')} AS kilo,
  {groups('text', fixed.EXPERIENCE, 'y1', 'y2')} AS years FROM clean),
read AS (SELECT * EXCLUDE (dollar, kilo, years), {pay_columns('dollar', '1.0')},
  {pay_columns('kilo', '1000.0')}, years.y1 AS y1, years.y2 AS y2 FROM matched),
bounded AS (SELECT *, {in_bounds('dollar')}, {in_bounds('kilo')},
  CAST({WORDS} AS DOUBLE) AS lo_year, TRY_CAST(y2 AS DOUBLE) AS hi_year FROM read),
fields AS (SELECT *,
  {of_pay('coalesce(least({0}_a, {0}_b), {0}_a)')} AS salary_text_min,
  {of_pay('CASE WHEN {0}_b IS NOT NULL THEN greatest({0}_a, {0}_b) END')} AS salary_text_max,
  {of_pay('{0}_u')} AS salary_text_unit,
  {education('text')} AS education_min,
  CASE WHEN lo_year > 0 AND lo_year <= 50 THEN lo_year END AS experience_min_years,
  CASE WHEN lo_year > 0 AND lo_year <= 50 AND hi_year > 0 AND hi_year <= 50
       AND hi_year >= lo_year THEN hi_year END AS experience_max_years,
  {FLAGS}
  FROM bounded),
merged AS (SELECT *,
  coalesce(parameters_salary_min, salary_text_min) AS salary_final_min,
  coalesce(parameters_salary_max, salary_text_max) AS salary_final_max,
  coalesce(nullif(parameters_salary_unit, ''), salary_text_unit,
    CASE WHEN coalesce(parameters_salary_min, salary_text_min) IS NOT NULL THEN 'annual' END)
    AS salary_final_unit
  FROM fields)"""

POSTINGS = f"{RAW}, {NULLED}, {TYPED}, {CLEAN}"
MERGED = f"{POSTINGS}, {FIELDS}"


def fields(*columns: str) -> str:
    return f"WITH {MERGED} SELECT system_job_id, {', '.join(columns)} FROM merged"


# ------------------------------------------------------------------ taxonomy


def best(source: str, keys: list[str], rest: list[str]) -> str:
    ties = ", ".join(f"{c} ASC NULLS LAST" for c in rest)
    return (
        f"SELECT * FROM {source} QUALIFY row_number() OVER "
        f"(PARTITION BY {', '.join(keys)} ORDER BY correlation DESC, {ties}) = 1"
    )


LOWERED = ", ".join(f"lower({strip(c)}) AS {c}" for c in fixed.TAXONOMY_TEXT_COLUMNS)


def taxonomy_ctes(threshold: float) -> str:
    kept = f"""kept AS (SELECT research_id, {LOWERED}, taxonomy_source, correlation
  FROM taxonomy WHERE correlation >= {threshold})"""
    rest = ["taxonomy_skill", "taxonomy_description", "taxonomy_source"]
    return f"""taxonomy AS ({views.TAXONOMY}), {kept},
tax AS ({best('kept', ['research_id', 'raw_skill'], rest)})"""


TAX = taxonomy_ctes(fixed.MIN_CONFIDENCE)
LOOKUP = "lookup AS ({})".format(
    best("(SELECT * FROM tax WHERE raw_skill IS NOT NULL)", ["raw_skill"],
         ["research_id", "taxonomy_skill", "taxonomy_description", "taxonomy_source"])
)
DOCS = "best_skill AS ({}), docs AS ({})".format(
    best("tax", ["taxonomy_skill"],
         ["research_id", "raw_skill", "taxonomy_description", "taxonomy_source"]),
    """SELECT taxonomy_skill, taxonomy_description, taxonomy_source, correlation,
  coalesce(taxonomy_skill, '') || ' ' || coalesce(taxonomy_description, '') AS text
  FROM best_skill""",
)


# ------------------------------------------------------------------ skills


def tokens(text: str) -> str:
    return (
        f"list_filter(string_split_regex(lower({text}), {q(fixed.TOKEN_SEPARATOR)}), "
        f"lambda t: length(t) >= {fixed.MIN_TOKEN_LENGTH} "
        f"AND t NOT IN ({listed(fixed.SKILL_STOPWORDS)}))"
    )


def phrase_ctes(source: str, key: str, text: str) -> str:
    """(key, phrase) of all window phrases, without benefit words."""
    size = fixed.MAX_PHRASE_TOKENS
    leads = ", ".join(f"lead(t1, {n - 1}) OVER w AS t{n}" for n in range(2, size + 1))
    # a window that would run past the last token is null
    joined = [" || ' ' || ".join(f"t{i}" for i in range(1, n + 1)) for n in range(1, size + 1)]
    return f"""tok AS (SELECT {key}, {tokens(text)} AS ts FROM {source}),
placed AS (SELECT {key}, unnest(ts) AS t1, generate_subscripts(ts, 1) AS i FROM tok),
runs AS (SELECT {key}, t1, {leads} FROM placed WINDOW w AS (PARTITION BY {key} ORDER BY i)),
phrases AS (SELECT DISTINCT {key}, phrase FROM
  (SELECT {key}, unnest([{', '.join(joined)}]) AS phrase FROM runs)
  WHERE length(phrase) >= {fixed.MIN_PHRASE_LENGTH})"""


NOISE = f"phrase NOT IN ({listed(fixed.BENEFIT_NOISE)})"
SCAN = f"""{phrase_ctes('clean', 'system_job_id', 'text')},
scan AS (SELECT system_job_id, phrase FROM phrases
  WHERE phrase IN (SELECT raw_skill FROM lookup) AND {NOISE})"""
EXTRA = f"""extra AS (SELECT system_job_id, unnest(list_distinct(
    list_concat([lower(title)], string_split(lower(title), ' ')))) AS phrase FROM typed),
candidates AS (SELECT system_job_id, phrase FROM scan UNION SELECT system_job_id, phrase
  FROM extra WHERE length(phrase) >= {fixed.MIN_PHRASE_LENGTH}
  AND phrase NOT IN ({listed(fixed.SKILL_STOPWORDS)}) AND {NOISE})"""


def exact(source: str) -> str:
    return f"""SELECT system_job_id, phrase AS raw_skill, taxonomy_skill,
  taxonomy_description, taxonomy_source,
  CAST(round_even(correlation, 4) AS DOUBLE) AS confidence, 'exact' AS match_method
  FROM {source} JOIN lookup ON phrase = raw_skill WHERE correlation >= {fixed.MIN_CONFIDENCE}"""


def ranked(source: str, limit: int | None = None) -> str:
    within = "" if limit is None else f"<= {limit}"
    return f"""dedup AS (SELECT * FROM {source} QUALIFY row_number() OVER (
  PARTITION BY system_job_id, taxonomy_skill
  ORDER BY confidence DESC, match_method, raw_skill) = 1),
long AS (SELECT * FROM dedup QUALIFY row_number() OVER (PARTITION BY system_job_id
  ORDER BY confidence DESC, taxonomy_skill NULLS LAST, match_method, raw_skill) {within or '> 0'})"""


BASE = f"{POSTINGS}, {TAX}, {LOOKUP}, {SCAN}, mapped AS ({exact('scan')})"
LONG = f"{BASE}, {ranked('mapped')}"
SUMMARY = """placed_skills AS (SELECT system_job_id, taxonomy_skill, row_number() OVER (
    PARTITION BY system_job_id ORDER BY confidence DESC, taxonomy_skill) AS place FROM long),
summary AS (SELECT system_job_id, CAST(count(*) AS BIGINT) AS skill_count,
  string_agg(taxonomy_skill, ' | ' ORDER BY place) FILTER (place <= 3) AS top_3_skills
  FROM placed_skills GROUP BY system_job_id)"""
SKILL_COLUMNS = ", ".join(fixed.SKILL_OUTPUT_COLUMNS)

JOINED = """jobs AS (SELECT m.*, coalesce(skill_count, 0) AS skill_count,
  coalesce(top_3_skills, '') AS top_3_skills
  FROM merged m LEFT JOIN summary USING (system_job_id))"""
WHOLE = f"""{MERGED}, {TAX}, {LOOKUP}, {SCAN}, mapped AS ({exact('scan')}),
{ranked('mapped')}, {SUMMARY}, {JOINED}"""


def yes_no(name: str) -> str:
    return f"CASE WHEN {name} THEN 'Yes' WHEN NOT {name} THEN 'No' END AS {name}"


def rounded(name: str, digits: int = 4) -> str:
    return f"CAST(round_even({name}, {digits}) AS DOUBLE) AS {name}"


JOBS = f"""SELECT system_job_id, job_id, title, date_acquired, created_date,
  {rounded('salary_final_min')}, {rounded('salary_final_max')}, salary_final_unit,
  education_min, {rounded('experience_min_years')}, {rounded('experience_max_years')},
  {', '.join(yes_no(n) for n in fixed.FLAGS)}, skill_count, top_3_skills FROM jobs"""


# ------------------------------------------------------------------ similarity


def term_ctes(name: str, source: str, key: str, text: str) -> str:
    """(key, term, tf) of word 1- to 3-grams."""
    words = f"regexp_extract_all(lower({text}), {q(fixed.INDEX_WORD)})"
    return f"""{name}_words AS (SELECT {key}, {words} AS ws FROM {source}),
{name}_starts AS (SELECT {key}, ws, unnest(range(1, len(ws) + 1)) AS i FROM {name}_words),
{name}_spans AS (SELECT {key}, ws, i,
  unnest(range(i, least(i + {fixed.MAX_TERM_WORDS - 1}, len(ws)) + 1)) AS j FROM {name}_starts),
{name}_counts AS (SELECT {key}, array_to_string(ws[i:j], ' ') AS term, count(*) AS tf
  FROM {name}_spans GROUP BY ALL)"""


def vocab(limit: int | None = None) -> str:
    top = "" if limit is None else f"ORDER BY frequency DESC, term LIMIT {limit}"
    return f"""vocab AS (SELECT term, CAST(sum(tf) AS BIGINT) AS frequency, count(*) AS df,
  ln((1.0 + (SELECT count(*) FROM docs)) / (1.0 + count(*))) + 1.0 AS idf
  FROM doc_counts GROUP BY term {top})"""


def vector_ctes(name: str, key: str) -> str:
    return f"""{name}_raw AS (SELECT {key}, term, (1.0 + ln(tf)) * idf AS w
  FROM {name}_counts JOIN vocab USING (term)),
{name}_norm AS (SELECT {key}, sqrt(sum(w * w)) AS norm FROM {name}_raw GROUP BY {key}),
{name}_vectors AS (SELECT r.{key}, term, w / norm AS weight FROM {name}_raw r
  JOIN {name}_norm n ON r.{key} = n.{key})"""


DOC_TERMS = f"{TAX}, {DOCS}, {term_ctes('doc', 'docs', 'taxonomy_skill', 'text')}"
INDEX = f"{DOC_TERMS}, {vocab()}, {vector_ctes('doc', 'taxonomy_skill')}"


def similar(source: str, min_confidence: float, top_k: int) -> str:
    return f"""{term_ctes('ph', source, 'phrase', 'phrase')}, {vector_ctes('ph', 'phrase')},
cosines AS (SELECT p.phrase, d.taxonomy_skill, round_even(sum(p.weight * d.weight), 9) AS cosine
  FROM ph_vectors p JOIN doc_vectors d ON p.term = d.term GROUP BY ALL),
topped AS (SELECT * FROM cosines WHERE cosine >= {fixed.MIN_COSINE} QUALIFY row_number() OVER (
  PARTITION BY phrase ORDER BY cosine DESC, taxonomy_skill) <= {top_k}),
similar_rows AS (SELECT phrase AS raw_skill, taxonomy_skill, taxonomy_description,
  taxonomy_source, CAST(round_even(cosine * correlation, 4) AS DOUBLE) AS confidence,
  'tfidf' AS match_method FROM topped JOIN docs USING (taxonomy_skill)
  WHERE cosine * correlation >= {min_confidence})"""


ALL_PHRASES = f"""{phrase_ctes('clean', 'system_job_id', 'text')},
distinct_phrases AS (SELECT DISTINCT phrase FROM phrases)"""


def share(condition: str) -> str:
    return (
        f"CAST(round_even(count(*) FILTER ({condition}) * 100.0 / count(*), 1) AS DOUBLE)"
    )


COVERAGE = f"""SELECT {share('salary_final_min IS NOT NULL')} AS salary_coverage_pct,
  {share(f"education_min <> {q(fixed.NO_EDUCATION)}")} AS education_coverage_pct,
  {share('experience_min_years IS NOT NULL')} AS experience_coverage_pct,
  {share('skill_count IS NOT NULL')} AS skill_coverage_pct,
  {share('is_remote')} AS remote_pct, {share('is_fulltime')} AS fulltime_pct,
  {share('is_parttime')} AS parttime_pct, {share('is_contract')} AS contract_pct,
  {share('skill_count > 0')} AS jobs_with_skills_pct FROM jobs"""
TOP = """SELECT taxonomy_skill, count(*) AS job_count FROM long GROUP BY taxonomy_skill
  ORDER BY job_count DESC, taxonomy_skill LIMIT 20"""
SIMILAR_TOO = (
    f"{INDEX}, {LOOKUP}, {SCAN}, {EXTRA}, "
    "residual AS (SELECT * FROM candidates WHERE phrase NOT IN (SELECT raw_skill FROM lookup)), "
    "residual_phrases AS (SELECT DISTINCT phrase FROM residual), "
    f"{similar('residual_phrases', fixed.MIN_CONFIDENCE, 1)}, "
    f"mapped AS ({exact('candidates')} UNION ALL SELECT system_job_id, raw_skill, "
    "taxonomy_skill, taxonomy_description, taxonomy_source, confidence, match_method "
    "FROM residual JOIN similar_rows ON phrase = raw_skill)"
)
WHOLE_EXTRA = f"""{MERGED}, {SIMILAR_TOO}, {ranked('mapped')}, {SUMMARY}, {JOINED}"""


def report(whole: str) -> str:
    return f"""WITH {whole}, cover AS ({COVERAGE}), top20 AS ({TOP}),
texts AS (SELECT {stats('length(text)')} FROM clean)
SELECT "count" AS total_rows, empty AS total_empty_descriptions,
  mean_length AS avg_mean_length_chars,
  (SELECT count(*) FROM jobs) AS total_jobs_processed,
  (SELECT count(*) FROM long) AS total_skill_mappings, cover.*,
  (SELECT taxonomy_skill FROM top20 ORDER BY job_count DESC, taxonomy_skill LIMIT 1) AS top_skill,
  (SELECT max(job_count) FROM top20) AS top_count,
  (SELECT count(*) FROM top20) AS top_listed
FROM texts, cover"""


REPORT, REPORT_EXTRA = report(WHOLE), report(WHOLE_EXTRA)

AGAIN = (
    "FROM (SELECT * REPLACE (CASE WHEN o_orderkey < (SELECT count(*) // 4 FROM orders) "
    "THEN o_custkey + 1 ELSE o_custkey END AS o_custkey) FROM orders) JOIN part"
)

SCANNED = f"WITH {RAW}, {NULLED}, {TYPED} SELECT * FROM typed"
LINED = SCANNED.replace(") AS description", f") || {views.LINES.format('p_name')} AS description", 1)

CLEAN_TAXONOMY = f"WITH {TAX} SELECT * FROM tax"

LOOSE = LONG.replace(
    "CAST(o_orderkey AS STRING) AS system_job_id",
    f"{views.LOOSE_IDS.format('CAST(o_orderkey AS STRING)')} AS system_job_id",
)
LOOSE_COLUMNS = SKILL_COLUMNS.replace(
    "system_job_id", "coalesce(system_job_id, 'nan') AS system_job_id"
)

ORACLES = {
    "scan_postings": SCANNED,
    "scan_postings_csv": SCANNED,
    "scan_taxonomy_csv": CLEAN_TAXONOMY,
    "scan_postings_lines": LINED,
    "active_only": f"WITH {RAW}, {NULLED}, {ACTIVE} SELECT system_job_id, "
    f"{tri('expired')} AS expired FROM active",
    "tri_bool": f"WITH {RAW} SELECT system_job_id, expired AS raw, {tri('expired')} AS expired "
    "FROM postings",
    "numeric_coerce": f"WITH {RAW} SELECT system_job_id, "
    f"{number('parameters_salary_min')} AS parameters_salary_min, "
    f"{number('parameters_salary_max')} AS parameters_salary_max FROM postings",
    "timestamp_coerce": f"WITH {RAW} SELECT system_job_id, "
    f"{epoch('date_acquired')} AS date_acquired, {epoch('created_date')} AS created_date "
    "FROM postings",
    "null_tokens": f"WITH {RAW}, {NULLED} SELECT system_job_id, job_id, created_date FROM nulled",
    "sample_limit": f"WITH {RAW}, {NULLED}, {ACTIVE} SELECT system_job_id, title, "
    f"{tri('expired')} AS expired FROM active ORDER BY system_job_id LIMIT {SAMPLE}",
    "sample_in_order": f"WITH {RAW}, {NULLED}, {ACTIVE} SELECT system_job_id, title, "
    f"{tri('expired')} AS expired FROM active ORDER BY CAST(system_job_id AS BIGINT) LIMIT {SAMPLE}",
    "union_sources": f"WITH {RAW}, {NULLED}, {TYPED} SELECT system_job_id, title, "
    "parameters_salary_min, expired FROM typed UNION ALL "
    "SELECT system_job_id, title, NULL, NULL FROM typed",
    "bool_render": f"WITH {RAW}, {NULLED}, {TYPED} SELECT system_job_id, {yes_no('expired')} "
    "FROM typed",
    "float_rounding": f"WITH {RAW}, {NULLED}, {TYPED} SELECT system_job_id, "
    "CAST(round_even(parameters_salary_min / 7.0, 4) AS DOUBLE) AS parameters_salary_min "
    "FROM typed",
    "mask_pii": f"SELECT doc_id, {masked('text')} AS masked FROM documents",
    "strip_html": f"SELECT page_id, {strip(markup_stripped('html'))} AS stripped FROM pages",
    "tidy_layout": f"SELECT doc_id, {tidied('text')} AS tidied FROM documents",
    "clean_text": f"SELECT page_id, {cleaned('html')} AS cleaned FROM pages",
    "clean_documents": f"SELECT doc_id, {cleaned('text')} AS cleaned FROM documents",
    "clean_conversations": f"SELECT conv_id, turn, {cleaned('text')} AS cleaned "
    "FROM conversations",
    "description_stats": f"WITH c AS (SELECT {cleaned('text')} AS t FROM documents) "
    f"SELECT {stats('length(t)')} FROM c",
    "extract_salary": fields("salary_text_min", "salary_text_max", "salary_text_unit"),
    "extract_education": fields("education_min"),
    "extract_experience": fields("experience_min_years", "experience_max_years"),
    "employment_flags": fields(*fixed.EMPLOYMENT_FLAGS),
    "remote_flag": fields("is_remote"),
    "benefit_flags": fields(*fixed.BENEFIT_FLAGS),
    "merge_salary": fields("salary_final_min", "salary_final_max", "salary_final_unit"),
    "pay_by_unit": f"WITH {MERGED} SELECT salary_final_unit, count(*) AS postings, "
    "CAST(round_even(avg(salary_final_min), 4) AS DOUBLE) AS mean_min "
    "FROM merged GROUP BY salary_final_unit",
    "taxonomy_clean": CLEAN_TAXONOMY,
    "taxonomy_stats": f"WITH {taxonomy_ctes(fixed.TAXONOMY_THRESHOLD)} SELECT "
    "(SELECT count(*) FROM taxonomy) AS rows_before, (SELECT count(*) FROM kept) AS rows_after, "
    "count(*) AS mappings, count(DISTINCT research_id) AS distinct_jobs FROM tax",
    "taxonomy_lookup": f"WITH {TAX}, {LOOKUP} SELECT * FROM lookup",
    "unknown_sources": f"WITH {TAX} SELECT DISTINCT taxonomy_source FROM tax WHERE "
    f"taxonomy_source IS NULL OR taxonomy_source NOT IN ({listed(fixed.KNOWN_SOURCES)})",
    "skill_tokens": f"WITH t AS (SELECT doc_id, {tokens('text')} AS ts FROM documents) "
    "SELECT doc_id, CAST(len(ts) AS BIGINT) AS n_tokens, "
    "coalesce(array_to_string(ts, ' '), '') AS tokens FROM t",
    "skill_ngrams": f"WITH {phrase_ctes('documents', 'doc_id', 'text')} SELECT doc_id, "
    "count(*) AS n_phrases, CAST(sum(length(phrase)) AS BIGINT) AS n_chars, "
    "min(phrase) AS first_phrase, max(phrase) AS last_phrase FROM phrases GROUP BY doc_id",
    "skill_vocab_scan": f"WITH {BASE} SELECT system_job_id, phrase FROM scan",
    "skill_candidates_union": f"WITH {BASE}, {EXTRA} SELECT system_job_id, phrase FROM candidates",
    "skill_exact_match": f"WITH {BASE} SELECT system_job_id, raw_skill, taxonomy_skill, "
    "confidence, match_method FROM mapped",
    "skill_residual": f"WITH {BASE}, {EXTRA} SELECT system_job_id, phrase FROM candidates "
    "WHERE phrase NOT IN (SELECT raw_skill FROM lookup)",
    "skill_map_dedup": f"WITH {LONG} SELECT system_job_id, raw_skill, taxonomy_skill, "
    "confidence, match_method FROM dedup",
    "skill_topk": f"WITH {BASE}, {ranked('mapped', 1)} SELECT system_job_id, raw_skill, "
    "taxonomy_skill, confidence, match_method FROM long",
    "skill_count": f"WITH {LONG}, {SUMMARY} SELECT system_job_id, title, "
    "coalesce(skill_count, 0) AS skill_count FROM typed LEFT JOIN summary USING (system_job_id)",
    "top3_skills": f"WITH {LONG}, {SUMMARY} SELECT system_job_id, title, "
    "coalesce(top_3_skills, '') AS top_3_skills FROM typed "
    "LEFT JOIN summary USING (system_job_id)",
    "structured_skills": f"WITH {LONG} SELECT {SKILL_COLUMNS} FROM long",
    "ids_padded_or_missing": f"WITH {LOOSE} SELECT {LOOSE_COLUMNS} FROM long",
    "structured_jobs": f"WITH {WHOLE} {JOBS}",
    "tfidf_corpus": f"WITH {TAX}, {DOCS} SELECT taxonomy_skill, correlation, text FROM docs",
    "tfidf_vocab": f"WITH {DOC_TERMS}, {vocab()} SELECT term, frequency, df, "
    f"{rounded('idf', 6)} FROM vocab",
    "tfidf_vocab_capped": f"WITH {DOC_TERMS}, {vocab(50)} SELECT term, frequency, df FROM vocab",
    "tfidf_index": f"WITH {INDEX} SELECT taxonomy_skill, term, {rounded('weight', 6)} "
    "FROM doc_vectors",
    "skill_tfidf_match": f"WITH {POSTINGS}, {INDEX}, {ALL_PHRASES}, "
    f"{similar('distinct_phrases', fixed.MIN_CONFIDENCE, 1)} SELECT * FROM similar_rows",
    "skill_tfidf_top3": f"WITH {POSTINGS}, {INDEX}, {ALL_PHRASES}, "
    f"{similar('distinct_phrases', 0.2, 3)} SELECT * FROM similar_rows",
    "map_to_taxonomy": f"WITH {POSTINGS}, {SIMILAR_TOO}, {ranked('mapped')} "
    f"SELECT {SKILL_COLUMNS} FROM long",
    "coverage": f"WITH {WHOLE} {COVERAGE}",
    "top_skills": f"WITH {LONG} {TOP}",
    "quality_report": REPORT,
    "full_run": REPORT_EXTRA,
    "stream_structured_jobs": f"WITH {WHOLE} {JOBS}",
    "stream_upsert_jobs": f"WITH {WHOLE} {JOBS}".replace("FROM orders JOIN part", AGAIN),
    "stream_upsert_counts": f"WITH {LONG} {TOP}".replace("FROM orders JOIN part", AGAIN),
    "stream_files_jobs": f"WITH {WHOLE} {JOBS}",
    "stream_report": REPORT.replace("FROM orders JOIN part", AGAIN),
    "stream_structured_skills": f"WITH {LONG} SELECT {SKILL_COLUMNS} FROM long",
    "stream_totals": f"WITH {LONG} SELECT (SELECT count(*) FROM typed) AS jobs, "
    "(SELECT count(*) FROM long) AS mappings",
}
