"""Role families and role flags of a normalized title."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobweave.functions import as_col

# Family, and the terms of which one must occur. First match wins.
# A third list, where given, names terms of which one must occur as well; a
# fourth names terms that rule the family out.
ROLE_RULES: list[tuple[str, list[str], list[str], list[str]]] = [
    ("Cybersecurity", [
        "cyber security", "cybersecurity", "information security", "infosec", "sso", "single sign on",
        "data protection engineer", "security automation", "security architect", "security engineer",
    ], [], []),
    ("AI/ML", [
        "machine learning", "ml engineer", "ai engineer", "llm", "deep learning", "ai trainer", "nlp",
        "computer vision",
    ], [], []),
    ("Data Architecture", [
        "data architect", "big data architect", "enterprise data architect", "edw architect",
        "solutions architect data",
    ], [], []),
    ("Data Engineering", [
        "data engineer", "data platform", "analytics engineer", "etl", "elt", "data engineering",
        "databricks engineer", "data integration", "integration engineer", "integration lead",
        "database engineer", "data pipeline", "gis data engineer", "gisdata engineer",
    ], [], []),
    ("Data Science", ["data scientist", "data science", "research scientist", "applied scientist"], [], []),
    ("Data & BI", [
        "data analyst", "business intelligence", "bi engineer", "bi developer", "power platform", "powerbi",
        "power bi", "analyst engineer", "reporting analyst", "insights analyst", "grafana analyst",
    ], [], []),
    ("Software Engineering", [
        "software engineer", "software developer", "swe", "sde", "backend", "frontend", "front end",
        "front-end", "fullstack", "full stack", "developer", "android", "ios", "qa engineer",
        "test engineer", "design engineer", "db development engineer", " software engineers",
    ], [], []),
    ("Software Engineering", ["software"], ["engineer"], []),
    ("Infrastructure", [
        "devops", "platform engineer", "site reliability", "sre", "cloud engineer",
        "infrastructure engineer", "systems engineer",
    ], [], []),
    ("Domain Engineering", ["geospatial", "gis engineer", "virtualization engineer"], [], []),
    ("Pre-Sales & Solutions", [
        "solution engineer", "solutions engineer", "sales engineer", "presales", "pre-sales",
        "field engineer", "enterprise solutions",
    ], [], []),
    ("Product & Program", [
        "product manager", "product analyst", "program manager", "project manager", "scrum master",
    ], [], []),
    ("Leadership", ["director", "vp ", "vice president", "head of", "chief", "svp", "evp"], [], []),
    ("Engineering Management", [
        "engineering manager", "data manager", "team lead", "tech lead", "manager engineering",
        "qa manager", "manager engineer", "lead engineer", "manager software engineering",
        "principal software engineering", "lead software engineering",
    ], [], []),
    ("Out Of Scope", [
        "structural engineer", "mechanical engineer", "electrical engineer", "civil engineer",
        "reservoir engineer", "fixed wire", "flight software", "basing programmer",
    ], [], ["data", "software", "platform", "cloud", "ml", "ai"]),
]
UNMAPPED = "Unmapped"
EXCLUDED_FAMILIES = ["Out Of Scope", "Unmapped"]

# Terms of management and of non-technical roles.
MANAGEMENT_TERMS = ["manager", "director", "vp ", "head of", "chief", "lead"]
NON_TECHNICAL_TERMS = [
    "product manager", "project manager", "program manager", "scrum", "agile", "recruiter", "hr ", "people ops",
]


def any_word(terms: list[str]) -> str:
    return r"\b(" + "|".join(terms) + r")\b"


def role_family(title: Column | str) -> Column:
    text = F.lower(as_col(title))
    out = F
    for family, terms, also, never in ROLE_RULES:
        test = text.rlike(any_word(terms))
        if also:
            test = test & text.rlike(any_word(also))
        if never:
            test = test & ~text.rlike(any_word(never))
        out = out.when(test, F.lit(family))
    return out.otherwise(F.lit(UNMAPPED))


def is_management(title: Column | str) -> Column:
    return F.coalesce(F.lower(as_col(title)).rlike(any_word(MANAGEMENT_TERMS)), F.lit(False))


def is_technical(title: Column | str) -> Column:
    return ~F.coalesce(F.lower(as_col(title)).rlike(any_word(NON_TECHNICAL_TERMS)), F.lit(False))
