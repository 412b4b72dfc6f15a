"""Column lists, word lists, tables, patterns and labels.

Everything in this module is data that results depend on letter by letter.
Patterns are written without flags; callers add ``(?iU)`` (case-insensitive,
Unicode classes) or whatever the step needs.
"""

# ---------------------------------------------------------------- fixed values: columns

POSTING_COLUMNS = [
    "system_job_id", "job_id", "title", "description",
    "date_acquired", "created_date",
    "zipcode", "city", "state", "country",
    "parameters_salary_unit", "parameters_salary_min", "parameters_salary_max",
    "parameters_hours_per_week_max",
    "classifications_onet_code", "classifications_naics_code",
    "requirements_min_education", "requirements_experience", "requirements_license",
    "application_company",
    "expired", "fedcontractor", "ghostjob",
    "jobclass", "cip_codes", "moc_codes",
]
BOOLEAN_COLUMNS = ["expired", "fedcontractor", "ghostjob"]
NUMERIC_COLUMNS = [
    "parameters_salary_min", "parameters_salary_max", "parameters_hours_per_week_max",
]
TIMESTAMP_COLUMNS = ["date_acquired", "created_date"]

TAXONOMY_COLUMNS = {
    "Research ID": "research_id",
    "Raw Skill": "raw_skill",
    "Taxonomy Skill": "taxonomy_skill",
    "Taxonomy Description": "taxonomy_description",
    "Taxonomy Source": "taxonomy_source",
    "Correlation Coefficient": "correlation",
}
TAXONOMY_TEXT_COLUMNS = ["raw_skill", "taxonomy_skill", "taxonomy_description"]
KNOWN_SOURCES = ["esco", "onet_tech", "onet_skill"]

JOB_OUTPUT_COLUMNS = [
    "system_job_id", "job_id", "title",
    "city", "state", "zipcode", "country",
    "date_acquired", "created_date",
    "classifications_onet_code", "classifications_naics_code", "cip_codes", "moc_codes",
    "fedcontractor", "ghostjob", "jobclass", "application_company",
    "parameters_hours_per_week_max",
    "salary_final_min", "salary_final_max", "salary_final_unit",
    "education_min", "experience_min_years", "experience_max_years",
    "is_fulltime", "is_parttime", "is_contract", "is_internship", "is_remote",
    "has_health_insurance", "has_401k", "has_pto", "has_tuition", "has_relocation", "has_bonus",
    "skill_count", "top_3_skills",
    "requirements_min_education", "requirements_experience", "requirements_license",
]
SKILL_OUTPUT_COLUMNS = [
    "system_job_id", "raw_skill", "taxonomy_skill", "taxonomy_description",
    "taxonomy_source", "confidence", "match_method",
]

# ---------------------------------------------------------------- fixed values: null tokens

NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# ---------------------------------------------------------------- fixed values: thresholds

TAXONOMY_THRESHOLD = 0.60
MIN_CONFIDENCE = 0.40
MIN_PHRASE_LENGTH = 3
MAX_PHRASE_TOKENS = 6
MIN_TOKEN_LENGTH = 2
MIN_COSINE = 0.01
MAX_TERM_WORDS = 3

# ---------------------------------------------------------------- fixed values: cleaning patterns

# White space as the input's producers count it: Unicode white space and the
# four ASCII separators U+001C..U+001F.
SPACE = r"[\s\x1c-\x1f]"
NON_SPACE = r"[^\s\x1c-\x1f]"
SPACE_CHARACTERS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
ASCII_SPACE_CHARACTERS = " \t\n\x0b\x0c\r"

HTML_TAG = r"<[^>]{0,200}>"
HTML_ENTITY = r"&[a-zA-Z0-9#]{1,10};"
URL = rf"https?://{NON_SPACE}+|www\.{NON_SPACE}+"
PHONE = r"\(?\d{3}\)?[\s\x1c-\x1f.\-/]?\d{3}[\s\x1c-\x1f.\-/]?\d{4}"
EMAIL = r"[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_-]+\.[a-zA-Z]{2,}"
BULLET = rf"^{SPACE}*[•·▪▸►◆*+\-–—]{SPACE}+"
HORIZONTAL_SPACE = r"[ \t\r\f\x0B]+"
# the same, except for the single blank, which would be replaced by itself
HORIZONTAL_SPACE_TO_CHANGE = r"[ \t\r\f\x0B](?:[ \t\r\f\x0B]+|(?<! ))"
NEWLINE_RUN = r"\n{3,}"

# ---------------------------------------------------------------- fixed values: field patterns

DOLLAR_AMOUNT = r"\$\s*(\d{1,3}(?:,\d{3})*(?:\.\d{1,2})?)"
RANGE_SEPARATOR = r"\s*[-–—to]+\s*"
PAY_UNIT = (
    r"(?:per\s+)?(?:hour|hr\.?|hourly)"
    r"|(?:per\s+)?(?:year|yr\.?|annual(?:ly)?)"
    r"|(?:per\s+)?(?:month|monthly|mo\.?)"
    r"|(?:per\s+)?(?:week|weekly|wk\.?)"
)
SALARY_DOLLAR = (
    rf"{DOLLAR_AMOUNT}(?:{RANGE_SEPARATOR}{DOLLAR_AMOUNT})?\s*(?:/\s*)?({PAY_UNIT})"
)
SALARY_K = (
    rf"(\d{{2,3}})k\s*(?:[-–—to]+\s*(\d{{2,3}})k)?\s*(?:/\s*)?({PAY_UNIT})"
)
# unit label, pattern on the matched unit text (first hit wins), lowest and highest plausible minimum
PAY_UNITS = [
    ("hourly", "hour|hr", 1.0, 500.0),
    ("annual", "year|annual|yr", 1_000.0, 1_000_000.0),
    ("monthly", "month|mo", 100.0, 100_000.0),
    ("weekly", "week|wk", 50.0, 25_000.0),
]

# highest tier first
EDUCATION_TIERS = [
    ("Doctoral Degree", r"\b(?:ph\.?d|doctorate|doctoral|d\.d\.s|m\.d\.?|j\.d\.?)\b"),
    ("Master's Degree", r"\b(?:master'?s?|m\.?s\.?|m\.?a\.?|m\.?b\.?a\.?|m\.?eng)\b"),
    ("Bachelor's Degree",
     r"\b(?:bachelor'?s?|b\.?s\.?|b\.?a\.?|undergraduate|4-year college|four.year)\b"),
    ("Associate's Degree", r"\b(?:associate'?s?|2-year|two.year|a\.?a\.?s?\.?)\b"),
    ("High School Diploma / GED",
     r"\b(?:high\s+school|ged|h\.?s\.?d\.?|secondary\s+school|hsed)\b"),
]
NO_EDUCATION = "No Requirement Stated"

NUMBER_WORDS = ["one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten"]
EXPERIENCE = (
    rf"(\d+(?:\.\d+)?|\b(?:{'|'.join(NUMBER_WORDS)})\b)\+?\s*"
    r"(?:to\s+(\d+(?:\.\d+)?)\+?\s*)?"
    r"(?:years?|yrs?)(?:\s+of)?\s+(?:relevant\s+|related\s+|prior\s+|previous\s+)?"
    r"(?:work\s+)?experience"
)
MAX_EXPERIENCE_YEARS = 50

FLAGS = {
    "is_fulltime": r"\b(?:full[- ]?time|full\s+time)\b",
    "is_parttime": r"\b(?:part[- ]?time|part\s+time)\b",
    "is_contract": r"\b(?:contract|temp(?:orary)?|contingent|freelance|gig)\b",
    "is_internship": r"\b(?:intern(?:ship)?|co-?op|trainee)\b",
    "is_remote":
        r"\b(?:remote|work\s+from\s+home|wfh|telecommut|tele-?work|virtual\s+work"
        r"|distributed\s+team|hybrid)\b",
    "has_health_insurance":
        r"\b(?:health\s+insurance|medical\s+(?:benefits?|coverage)|dental|vision)\b",
    "has_401k": r"\b(?:401k|retirement|pension|403b)\b",
    "has_pto": r"\b(?:paid\s+(?:time\s+off|vacation|pto|leave)|pto|vacation\s+days?)\b",
    "has_tuition": r"\b(?:tuition\s+(?:reimburse|assist|benefit)|education\s+benefit)\b",
    "has_relocation": r"\b(?:relocation\s+(?:assist|allowance|package|benefit))\b",
    "has_bonus":
        r"\b(?:sign(?:ing)?[\s-]on\s+bonus|performance\s+bonus|annual\s+bonus)\b",
}
EMPLOYMENT_FLAGS = ["is_fulltime", "is_parttime", "is_contract", "is_internship"]
BENEFIT_FLAGS = [
    "has_health_insurance", "has_401k", "has_pto", "has_tuition", "has_relocation", "has_bonus",
]

# ---------------------------------------------------------------- fixed values: skill words

TOKEN_SEPARATOR = r"""[\s\x1c-\x1f,;:()\[\]{}'"]+"""
SKILL_STOPWORDS = [
    "experience", "years", "ability", "knowledge", "skills", "skill",
    "understanding", "work", "working", "strong", "excellent", "good",
    "required", "preferred", "plus", "must", "will", "our", "the", "and",
    "or", "to", "in", "of", "a", "an", "with", "for", "on", "at", "by",
    "as", "is", "are", "be", "been", "being",
]
BENEFIT_NOISE = [
    "dental", "vision", "medical", "health", "insurance",
    "401k", "retirement", "pension", "pto", "vacation",
    "tuition", "relocation", "bonus",
]
INDEX_WORD = r"[\p{L}\p{N}_]{2,}"

# ---------------------------------------------------------------- fixed values: coverage

COVERAGE_RATES = {
    "salary_coverage_pct": "salary_final_min",
    "education_coverage_pct": "education_min",
    "experience_coverage_pct": "experience_min_years",
    "skill_coverage_pct": "skill_count",
}
COVERAGE_FLAGS = {
    "remote_pct": "is_remote",
    "fulltime_pct": "is_fulltime",
    "parttime_pct": "is_parttime",
    "contract_pct": "is_contract",
}
YES_TEXTS = ["Yes", "True", "true", "1"]
