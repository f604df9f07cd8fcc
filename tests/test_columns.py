import datetime as dt

import pytest
from pyspark.sql import functions as F

from jobweave.functions import company, keys, location, quality, roles, salary, signals, skills, title

TITLES = {
    "architect/engineer": "architect engineer",
    "architectengineer": "architect engineer",
    "Engineer III": "engineer",
    "Data Engineer Ssr": "data engineer",
    "Programmer 61096": "programmer",
    "Architect Is002": "architect",
    "Engineer Uk": "engineer",
    "Engineer Remote Contract": "engineer",
    "Engineer Public Trust": "engineer",
    "Engineer Strong Sql Skills": "engineer",
    "Head Of Engineering Productivity": "head of engineering",
    "Lead Engineer Epic Bridges": "lead engineer",
    "Engineer Job At X In Y": "engineer",
    "Engineer - Metamask": "engineer",
    "Engineer – Metamask": "engineer",
    "Sr Engineer": "senior engineer",
    "SWE": "software engineer",
    "Data   Engineer": "data engineer",
    "Front-End Engineer": "front-end engineer",
    "C# Dev": "c# dev",
    "   ": None,
    "": None,
    None: None,
}


def test_title_passes(values):
    assert values(title.normalize_job_title("x"), list(TITLES)) == list(TITLES.values())


def test_seniority(values):
    cases = {
        "chief data officer": ("C-Suite", 9),
        "vp": ("Director+", 8),
        "head of data": ("Director+", 8),
        "principal engineer": ("Principal", 7),
        "staff engineer": ("Staff", 6),
        "lead senior engineer": ("Lead", 5),
        "senior engineer": ("Senior", 4),
        "engineer": ("Mid", 3),
        "associate engineer": ("Junior", 2),
        "graduate engineer": ("Intern", 1),
        "leadership coach": ("Mid", 3),
        None: ("Mid", 3),
    }
    level = title.derive_seniority_level("x")
    assert values(level, list(cases)) == [c[0] for c in cases.values()]
    assert values(title.derive_seniority_rank(level), list(cases)) == [c[1] for c in cases.values()]


def test_valid_titles(values):
    got = values(F.coalesce(title.is_valid_title("x"), F.lit(False)), ["vp", "req-123", "AB-1", "data", None])
    assert got == [False, False, False, True, False]


def test_employer_names(values):
    got = values(company.employer_name_normalization("x"), ["Acme, Inc.", "Foo Co Ltd", "Inc", "A&B GmbH", None])
    assert got == ["acme", "foo", "inc", "a b", None]


TEXTS = [
    "c# dev", "r analyst", "ci/cd engineer", "Spark SQL and R.", "sparkling sql", "Deep learning, ML",
    "generative AI", "c sharp/CI/CD", "github actions or git", "machine  learning", "", None, "r+d r# c++",
]


def test_skill_flags_agree_with_single_pass(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "x string")
    found = skills.with_skill_flags(df, "x")
    for skill, terms in skills.SKILL_TERMS.items():
        rows = found.select(f"skill_{skill}", skills.skill_flag("x", terms).alias("single"), "x").collect()
        assert all(r[0] == r[1] for r in rows), (skill, rows)
    counts = {r.x: r.skill_count for r in found.collect()}
    assert counts["c# dev"] == 1 and counts["Spark SQL and R."] == 3 and counts[None] == 0
    assert counts["r+d r# c++"] == 0 and counts["ci/cd engineer"] == 1


def test_locations(values):
    cases = [None, "kenya", "nairobi, kenya", "london, england, uk", " , kenya", "a, b, c, d"]
    parts = location.split_location("x")
    assert values(location.parsed_city(parts), cases) == [None, None, "Nairobi", "London", "", "A"]
    assert values(location.parsed_region(parts), cases) == [None, None, None, "England", None, "B"]
    assert values(location.parsed_country(parts), cases) == [None, "Kenya", "Kenya", "Uk", "Kenya", "D"]
    got = values(location.parsed_location_key(parts), cases)
    same = values(location.location_key(F.lit("Nairobi "), F.lit("KENYA")), [None])
    alone = values(location.location_key(F.lit(None).cast("string"), F.lit("Kenya")), [None])
    assert got[0] == "-1" and got[2] == same[0] and got[1] == alone[0]
    assert values(location.location_resolution(parts), cases)[:3] == ["missing", "country", "city"]


def test_markets(values):
    cases = ["Kenya", "Kenya Republic", "uk", "USA", "India", None]
    assert values(location.location_market("x"), cases) == ["Kenya", "Kenya", "UK", "US", "Other", "Unknown"]
    assert values(company.company_market("x"), cases) == ["Kenya", "Other", "UK", "US", "Other", "Unknown"]
    assert values(location.geo_region("x"), cases) == [
        "Africa", "Other", "Europe", "North America", "Asia Pacific", "Unknown"
    ]
    assert values(location.is_benchmark_market("x"), cases) == [True, False, True, True, False, False]
    assert values(location.tech_hub_label("x"), ["LONDON", "Paris", None]) == ["UK Tech Hub", None, None]


def test_buckets_at_their_edges(values):
    for code, (bounds, labels) in salary.BUCKETS.items():
        amounts = [b - 0.5 for b in bounds] + [float(b) for b in bounds]
        got = values(salary.salary_bucket("x", F.lit(code)), amounts, "double")
        assert got == labels[:-1] + labels[1:]
    assert values(salary.salary_bucket("x", F.lit("EUR")), [1.0, None], "double") == ["Undisclosed"] * 2


def test_pay(spark):
    rows = [(100.0, 200.0), (None, 200.0), (None, None)]
    df = spark.createDataFrame(rows, "lo double, hi double")
    got = df.select(
        salary.midpoint_strict("lo", "hi"), salary.midpoint_zero_filled("lo", "hi"), salary.range_width("lo", "hi"),
        salary.percent_of("lo", "hi", 1), salary.annualize_posting("hi", F.lit(" hourly ")),
        salary.annualize_posting("hi", F.lit("x")), salary.annualize_estimate("lo", F.lit("month")),
    ).collect()
    assert [tuple(r) for r in got] == [
        (150.0, 150.0, 100.0, 50.0, 416000.0, None, 1200.0),
        (None, 100.0, None, None, 416000.0, None, None),
        (None, 0.0, None, None, None, None, None),
    ]
    assert df.select(salary.percent_of("lo", F.lit(0.0), 1)).first()[0] is None


def test_reliability(spark):
    cases = [
        ("HIGH", 30, 1.0, 10.0, "high"), ("high", 10, 1.0, 10.0, "medium"), ("high", 1, 1.0, 200.0, "medium"),
        ("medium", 10, None, 10.0, "medium"), ("medium", 4, 1.0, 10.0, "low"), ("low", 99, 1.0, 1.0, "low"),
        ("medium", 7, None, 1.0, "low"), ("medium", 7, 1.0, 101.0, "low"), ("medium", 7, 1.0, 100.0, "medium"),
        ("high", None, None, 1.0, "low"), (None, 50, 1.0, None, "medium"),
    ]
    df = spark.createDataFrame(cases, "c string, n int, m double, p double, want string")
    assert df.filter(salary.estimate_reliability("c", "n", "m", "p") != F.col("want")).count() == 0


def test_roles(values):
    cases = {
        "senior security engineer": "Cybersecurity", "ml engineer": "AI/ML", "data architect": "Data Architecture",
        "senior data engineer": "Data Engineering", "data scientist": "Data Science", "data analyst": "Data & BI",
        "software quality engineer": "Software Engineering", "sre": "Infrastructure", "gis engineer": "Domain Engineering",
        "pre-sales engineer": "Pre-Sales & Solutions", "product manager": "Product & Program", "vp of data": "Leadership",
        "vp": "Unmapped", "qa manager": "Engineering Management", "civil engineer": "Out Of Scope",
        "civil engineer ai": "Unmapped", "gardener": "Unmapped", None: "Unmapped",
    }
    assert values(roles.role_family("x"), list(cases)) == list(cases.values())
    assert values(roles.is_management("x"), ["tech lead", "leader", None]) == [True, False, False]
    assert values(roles.is_technical("x"), ["scrum master", "engineer", None]) == [False, True, True]


def test_quality(values):
    got = values(quality.employment_type("x"), ["fulltime", " intern ", "per diem", None])
    assert got == ["Full-Time", "Internship", "Per Diem", "Unknown"]
    assert values(company.posting_volume_band("x"), [50, 49, 20, 5, 4], "int") == [
        "High (50+)", "Active (20–49)", "Active (20–49)", "Moderate (5–19)", "Low (1–4)"
    ]


def test_title_key(values):
    got = values(keys.job_title_key("x"), ["data engineer", None])
    assert got[0] == int(__import__("hashlib").md5(b"data engineer").hexdigest()[:8], 16) and got[1] == -1


@pytest.mark.parametrize("day", ["2020-01-01", "2021-01-01", "2024-02-29", "2030-12-30"])
def test_calendar(spark, day):
    value = dt.date.fromisoformat(day)
    df = spark.createDataFrame([(value,)], "d date")
    row = df.select(*[col.alias(n) for n, col in signals.calendar_columns("d").items()]).first()
    week = value.isocalendar().week
    assert row.date_key == int(day.replace("-", "")) and row.week_of_year == week
    assert row.year_week == f"{value.year}-W{week:02d}" and row.day_of_week_num == value.isoweekday()
    assert row.month_name == value.strftime("%B") and row.is_weekday == (value.isoweekday() <= 5)
    assert row.is_last_day_of_month == ((value + dt.timedelta(days=1)).day == 1)


def test_trend(spark):
    df = spark.createDataFrame([(103.0, 100.0), (102.0, 100.0), (97.0, 100.0), (1.0, None)], "v double, p double")
    got = [r[0] for r in df.select(signals.trend_direction("v", "p")).collect()]
    assert got == ["increasing", "stable", "decreasing", "first observation"]
