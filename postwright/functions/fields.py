"""Structured fields from cleaned text, as native expressions.

Patterns are run only where a cheap substring test allows a match.  Intermediate
values sit in columns of their own, so that no pattern runs twice on a row; the
temporary columns start with ``_`` and are dropped at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postwright import fixed
from postwright.functions.sql import ahead, any_of, ascii_only, cases, has, quote

# One of these is in every lower-cased text that the pattern matches.
_FLAG_HINTS = {
    "is_fulltime": ["full"],
    "is_parttime": ["part"],
    "is_contract": ["contract", "temp", "contingent", "freelance", "gig"],
    "is_internship": ["intern", "coop", "co-op", "trainee"],
    "is_remote": ["remote", "work", "wfh", "telecommut", "distributed", "hybrid"],
    "has_health_insurance": ["health", "medical", "dental", "vision"],
    "has_401k": ["401k", "403b", "retirement", "pension"],
    "has_pto": ["paid", "pto", "vacation"],
    "has_tuition": ["tuition", "education"],
    "has_relocation": ["relocation"],
    "has_bonus": ["bonus"],
}
_TIER_HINTS = {
    "Doctoral Degree": ["phd", "ph.d", "doctor", "d.d.s", "m.d", "j.d"],
    "Master's Degree": ["ma", "m.a", "ms", "m.s", "mb", "m.b", "meng", "m.eng"],
    "Bachelor's Degree": ["ba", "b.a", "bs", "b.s", "undergrad", "4-year", "four"],
    "Associate's Degree": ["associate", "2-year", "two", "aa", "a.a"],
    "High School Diploma / GED": ["school", "ged", "hsd", "h.s", "hs.d", "hsed"],
}
# Characters that the matches in lower-cased ASCII text start with.
_STARTS = {
    "is_fulltime": "f", "is_parttime": "p", "is_contract": "ctfg", "is_internship": "ict",
    "is_remote": "rwtvdh", "has_health_insurance": "hmdv", "has_401k": "4rp", "has_pto": "pv",
    "has_tuition": "te", "has_relocation": "r", "has_bonus": "spa",
    "Doctoral Degree": "pdmj", "Master's Degree": "m", "Bachelor's Degree": "bu4f",
    "Associate's Degree": "a2t", "High School Diploma / GED": "hgs",
}
# Letters that match i, s or k regardless of case but do not become one in lower case.
_ODD_LETTERS = ["İ", "ı", "ſ", "K"]


def _pattern(pattern: str) -> str:
    return quote("(?iU)" + pattern)


def _first(text: str, pattern: str, starts: str) -> str:
    """First match, null if none.  Groups are read from this short span, not the text.

    In ASCII text the plain classes and cases, which are faster, match the same.
    """
    plain = quote("(?i)" + ahead(starts, pattern))
    return (
        f"nullif(CASE WHEN {ascii_only(text)} THEN regexp_extract({text}, {plain}, 0) "
        f"ELSE regexp_extract({text}, {_pattern(pattern)}, 0) END, '')"
    )


def _group(span: str, pattern: str, n: int) -> str:
    """Capture group of a span; empty if it took no part."""
    return f"regexp_extract({span}, {_pattern(pattern)}, {n})"


def _matches(text: str, pattern: str, hints: list[str], starts: str) -> str:
    """Case-insensitive search, skipped where no hint is in ``_low``.

    In ASCII text the pattern, which is in lower case, is searched for in ``_low`` as it is.
    """
    plain = quote(ahead(starts, pattern))
    found = f"CASE WHEN _ascii THEN _low RLIKE {plain} ELSE {text} RLIKE {_pattern(pattern)} END"
    return f"({any_of(['_odd', *(has('_low', h) for h in hints)])} AND {found})"


def _add(df: DataFrame, **columns: str) -> DataFrame:
    return df.withColumns({name: F.expr(text) for name, text in columns.items()})


def _amount(text: str, scale: float) -> str:
    # an empty text would be refused by an exception
    return f"try_cast(nullif(replace({text}, ',', ''), '') AS DOUBLE) * {scale}D"


def _with_pay(df: DataFrame, span: str, pattern: str, scale: float, pay: str) -> DataFrame:
    """Add the struct (min, max, unit) of a matched pay span, null if implausible."""
    df = _add(
        df,
        _a=_group(span, pattern, 1),
        _b=_group(span, pattern, 2),
        _u=_group(span, pattern, 3),
    )
    unit = cases(
        (f"_u RLIKE {_pattern(words)}", quote(label)) for label, words, *_ in fixed.PAY_UNITS
    )
    df = _add(df, _a=_amount("_a", scale), _b=_amount("_b", scale), _u=unit)
    df = _add(df, _b="CASE WHEN _b <> 0 THEN _b END")
    # least and greatest skip nulls
    plausible = any_of(
        f"(_u = {quote(label)} AND least(_a, _b) BETWEEN {lo}D AND {hi}D)"
        for label, _, lo, hi in fixed.PAY_UNITS
    )
    record = (
        "named_struct('min', least(_a, _b), "
        "'max', CASE WHEN _b IS NOT NULL THEN greatest(_a, _b) END, 'unit', _u)"
    )
    return _add(df, **{pay: f"CASE WHEN {plausible} THEN {record} END"})


def with_salary(df: DataFrame, text: str) -> DataFrame:
    """Add text pay: the dollar form, else the K form, else nulls."""
    dollar = f"CASE WHEN {has(text, '$')} THEN {_first(text, fixed.SALARY_DOLLAR, '$')} END"
    df = _with_pay(_add(df, _s=dollar), "_s", fixed.SALARY_DOLLAR, 1.0, "_dollar")
    kilo = f"CASE WHEN _dollar IS NULL THEN {_first(text, fixed.SALARY_K, r'\d')} END"
    df = _with_pay(_add(df, _s=kilo), "_s", fixed.SALARY_K, 1_000.0, "_kilo")
    df = _add(df, _pay="coalesce(_dollar, _kilo)")
    return _add(df, **{f"salary_text_{part}": f"_pay.{part}" for part in ("min", "max", "unit")})


def with_experience(df: DataFrame, text: str) -> DataFrame:
    """Add minimum and maximum years, null where none or out of range."""
    # "xper", "year" and "yr" hold no letter with an odd case variant: safe on any text
    df = _add(df, _low=f"lower({text})")
    needed = any_of(has("_low", hint) for hint in ("year", "yr"))
    needed += f" AND contains(_low, CASE WHEN {ascii_only(text)} THEN 'xperience' ELSE 'xper' END)"
    df = _add(df, _y=f"CASE WHEN {needed} THEN {_first(text, fixed.EXPERIENCE, r'\dotfsen')} END")
    df = _add(
        df,
        _low_year=f"lower({_group('_y', fixed.EXPERIENCE, 1)})",
        _high_year=f"try_cast(nullif({_group('_y', fixed.EXPERIENCE, 2)}, '') AS DOUBLE)",
    )
    words = [
        (f"_low_year = {quote(word)}", f"{value}D")
        for value, word in enumerate(fixed.NUMBER_WORDS, 1)
    ]
    df = _add(df, _low_year=cases(words, "try_cast(_low_year AS DOUBLE)"))
    limit = fixed.MAX_EXPERIENCE_YEARS
    valid = f"_low_year > 0 AND _low_year <= {limit}"
    upper = f"_high_year > 0 AND _high_year <= {limit} AND _high_year >= _low_year"
    return _add(
        df,
        experience_min_years=f"CASE WHEN {valid} THEN _low_year END",
        experience_max_years=f"CASE WHEN {valid} AND {upper} THEN _high_year END",
    )


def with_wording(df: DataFrame, text: str) -> DataFrame:
    """Add the highest education tier mentioned and the eleven wording flags."""
    odd = any_of(has(text, letter) for letter in _ODD_LETTERS)
    df = _add(df, _low=f"lower({text})", _ascii=ascii_only(text), _odd=f"NOT {ascii_only(text)} AND {odd}")
    tier = cases(
        (
            (_matches(text, pattern, _TIER_HINTS[label], _STARTS[label]), quote(label))
            for label, pattern in fixed.EDUCATION_TIERS
        ),
        quote(fixed.NO_EDUCATION),
    )
    flags = {
        name: f"coalesce({_matches(text, pattern, _FLAG_HINTS[name], _STARTS[name])}, FALSE)"
        for name, pattern in fixed.FLAGS.items()
    }
    return _add(df, education_min=tier, **flags)
