import pytest
from pyspark.sql import functions as F

from postwright import fixed
from postwright.operators import postings


@pytest.fixture(scope="module")
def extract(spark):
    def run(texts):
        df = spark.createDataFrame(list(enumerate(texts)), "i int, description_clean string")
        return sorted(postings.extract_fields(df.coalesce(2)).collect())

    return run


SALARY = [
    ("$25 - $30 per hour", (25.0, 30.0, "hourly")),
    ("$40,000 to $55,500 annually", (40000.0, 55500.0, "annual")),
    ("$30/hr", (30.0, None, "hourly")),
    ("$60000 per year", (None, None, None)),
    ("$500 more", (500.0, None, "monthly")),
    ("$20 - $60,000 hourly", (20.0, 60000.0, "hourly")),
    ("$5 monthly then 70k year", (70000.0, None, "annual")),
    ("65-75K/yr", (75000.0, None, "annual")),
    ("65K-75k / YR", (65000.0, 75000.0, "annual")),
    ("401k year plan", (401000.0, None, "annual")),
    ("65k a year", (None, None, None)),
    ("$30 - $0 hourly", (30.0, None, "hourly")),
    ("$55,000 – $45,000 annual", (45000.0, 55000.0, "annual")),
    ("$49 weekly", (None, None, None)),
    ("$50 wk", (50.0, None, "weekly")),
    ("nothing", (None, None, None)),
]


def test_salary(extract):
    rows = extract([t for t, _ in SALARY])
    got = [(r.salary_text_min, r.salary_text_max, r.salary_text_unit) for r in rows]
    assert got == [s for _, s in SALARY]


EXPERIENCE = [
    ("2-5 years of experience", (5.0, None)),
    ("2 to 5 years experience", (2.0, 5.0)),
    ("two to five years experience", (5.0, None)),
    ("5 to 2 years experience", (5.0, None)),
    ("three (3) years of experience", (None, None)),
    ("0 years experience", (None, None)),
    ("60 years experience", (None, None)),
    ("at least TEN+ yrs of related work EXPERIENCE", (10.0, None)),
    ("1.5 to 60 years prior experience", (1.5, None)),
    ("experience wanted", (None, None)),
]


def test_experience(extract):
    rows = extract([t for t, _ in EXPERIENCE])
    assert [(r.experience_min_years, r.experience_max_years) for r in rows] == [
        e for _, e in EXPERIENCE
    ]


EDUCATION = [
    ("MS Office", "Master's Degree"),
    ("Boston, MA", "Master's Degree"),
    ("M.S. degree", "Master's Degree"),
    ("Sales associate", "Associate's Degree"),
    ("maître d", "No Requirement Stated"),
    ("Bachelor degree or MBA", "Master's Degree"),
    ("Ph.D or B.A.", "Doctoral Degree"),
    ("four-year program", "Bachelor's Degree"),
    ("two year program", "Associate's Degree"),
    ("A.A.S. accepted", "Associate's Degree"),
    ("HSED, H.S.D. or G.E.D.", "High School Diploma / GED"),
    ("secondary school", "High School Diploma / GED"),
    ("", "No Requirement Stated"),
]


def test_education(extract):
    rows = extract([t for t, _ in EDUCATION])
    assert [r.education_min for r in rows] == [e for _, e in EDUCATION]


FLAGS = [
    ("telecommuting", "is_remote", False),
    ("hybrıd work from  home", "is_remote", True),
    ("HYBRİD", "is_remote", True),
    ("virtual work", "is_remote", True),
    ("tele-work", "is_remote", True),
    ("tuition reimbursement", "has_tuition", False),
    ("tuition benefit", "has_tuition", True),
    ("signing bonus", "has_bonus", False),
    ("sign-on bonus", "has_bonus", True),
    ("401(k)", "has_401k", False),
    ("401K match", "has_401k", True),
    ("full time", "is_fulltime", True),
    ("fulltime", "is_fulltime", True),
    ("Part-Time", "is_parttime", True),
    ("contractor", "is_contract", False),
    ("temp work", "is_contract", True),
    ("Co-op student", "is_internship", True),
    ("internal", "is_internship", False),
    ("medical coverage", "has_health_insurance", True),
    ("paid leave", "has_pto", True),
    ("relocation package", "has_relocation", True),
]


def test_flags(extract):
    rows = extract([t for t, *_ in FLAGS])
    assert [(t, r[name]) for r, (t, name, _) in zip(rows, FLAGS)] == [
        (t, flag) for t, _, flag in FLAGS
    ]


def test_hints_never_hide_a_match(spark):
    """The substring tests in front of the patterns change nothing on mixed wording."""
    words = (
        "full time part-time contract temporary gig intern co-op coop trainee remote wfh telework "
        "virtual work distributed team hybrid health insurance dental 403b pension paid pto "
        "vacation days education benefit tuition assist relocation allowance annual bonus ph.d "
        "d.d.s m.d. j.d. associate's 2-year two-year a.a. a.a.s high school ged h.s.d hs.d hsed"
    ).split()
    pairs = [f"{a} {b}" for a in words for b in words]
    df = spark.createDataFrame([(p,) for p in pairs + [p.upper() for p in pairs]],
                               "description_clean string")
    plain = {
        f"p_{n}": F.col("description_clean").rlike("(?iU)" + p) for n, p in fixed.FLAGS.items()
    }
    tiers = F.coalesce(
        *[F.when(F.col("description_clean").rlike("(?iU)" + p), F.lit(label))
          for label, p in fixed.EDUCATION_TIERS], F.lit(fixed.NO_EDUCATION))
    out = postings.extract_fields(df).withColumns({**plain, "p_tier": tiers})
    wrong = " OR ".join([f"p_{n} <> {n}" for n in fixed.FLAGS] + ["p_tier <> education_min"])
    assert out.filter(wrong).count() == 0


def test_missing_text_column(spark):
    df = spark.createDataFrame([(1,)], "i int")
    assert postings.extract_fields(df).columns == ["i"]
    assert postings.clean_postings(df).collect()[0].description_clean == ""


def test_merge_salary(spark):
    df = spark.createDataFrame(
        [
            (1, 10.0, None, None, None, 99.0, "hourly"),
            (2, 10.0, None, "", None, None, None),
            (3, None, 7.0, None, None, None, None),
            (4, 10.0, None, "Year", 5.0, 6.0, "hourly"),
        ],
        "i int, parameters_salary_min double, parameters_salary_max double, "
        "parameters_salary_unit string, salary_text_min double, salary_text_max double, "
        "salary_text_unit string",
    )
    got = [tuple(r)[-3:] for r in postings.merge_salary(df).orderBy("i").collect()]
    assert got == [
        (10.0, 99.0, "hourly"), (10.0, None, "annual"), (None, 7.0, None), (10.0, 6.0, "Year")
    ]
    bare = postings.merge_salary(df.select("i")).first()
    assert (bare.salary_final_min, bare.salary_final_max, bare.salary_final_unit) == (None,) * 3
