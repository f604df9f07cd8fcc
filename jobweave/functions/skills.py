"""Skill detection in free text.

The text is split into words once and one array intersection finds all
single-word terms and the first words of all phrases. A phrase is searched for
only where its first word occurs. Fifty-five separate regexes over every
description would read each text fifty-five times.
"""

from __future__ import annotations

import re
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobweave.functions import as_col

# Skill and the terms that reveal it.
SKILL_TERMS: dict[str, list[str]] = {
    "python": ["python"],
    "r": ["r", "r language"],
    "sql": ["sql"],
    "bigquery": ["bigquery", "big query"],
    "javascript": ["javascript", "java script"],
    "postgres": ["postgres", "postgresql"],
    "csharp": ["c#", "c sharp"],
    "machine_learning": ["machine learning", "ml"],
    "artificial_intelligence": ["artificial intelligence", "ai"],
    "spark": ["spark", "apache spark", "pyspark", "spark sql"],
    "databricks": ["databricks"],
    "snowflake": ["snowflake"],
    "redshift": ["redshift"],
    "mongodb": ["mongodb", "mongo db"],
    "redis": ["redis"],
    "elasticsearch": ["elasticsearch", "elastic search"],
    "delta_lake": ["delta lake"],
    "iceberg": ["iceberg"],
    "kafka": ["kafka"],
    "airflow": ["airflow"],
    "dagster": ["dagster"],
    "prefect": ["prefect"],
    "flink": ["flink"],
    "nifi": ["nifi"],
    "dbt": ["dbt"],
    "aws": ["aws", "amazon web services"],
    "azure": ["azure", "microsoft azure"],
    "gcp": ["gcp", "google cloud platform"],
    "docker": ["docker"],
    "kubernetes": ["kubernetes", "k8s"],
    "terraform": ["terraform"],
    "deep_learning": ["deep learning", "dl"],
    "mlflow": ["mlflow"],
    "pytorch": ["pytorch"],
    "tensorflow": ["tensorflow"],
    "scikit_learn": ["scikit learn", "sklearn"],
    "langchain": ["langchain"],
    "llm": ["llm", "large language model"],
    "generative_ai": ["generative ai", "generative artificial intelligence"],
    "great_expectations": ["great expectations"],
    "soda": ["soda"],
    "monte_carlo": ["monte carlo"],
    "data_lineage": ["data lineage"],
    "data_governance": ["data governance"],
    "powerbi": ["power bi", "powerbi"],
    "tableau": ["tableau"],
    "looker": ["looker"],
    "metabase": ["metabase"],
    "superset": ["superset"],
    "excel": ["excel"],
    "git": ["git"],
    "cicd": ["ci/cd", "continuous integration", "continuous delivery"],
    "jenkins": ["jenkins"],
    "github_actions": ["github actions"],
    "agile": ["agile"],
}

# Skills kept as flags on a posting, with label and category.
STORED_SKILLS: dict[str, tuple[str, str]] = {
    "python": ("Python", "Data Stack"),
    "sql": ("SQL", "Data Stack"),
    "spark": ("Spark", "Data Stack"),
    "dbt": ("dbt", "Data Stack"),
    "airflow": ("Airflow", "Data Stack"),
    "kafka": ("Kafka", "Data Stack"),
    "databricks": ("Databricks", "Data Stack"),
    "bigquery": ("BigQuery", "Cloud"),
    "aws": ("AWS", "Cloud"),
    "azure": ("Azure", "Cloud"),
    "gcp": ("GCP", "Cloud"),
    "snowflake": ("Snowflake", "Cloud"),
    "deep_learning": ("Deep Learning", "AI/ML"),
    "llm": ("LLM", "AI/ML"),
}

# Spelled out instead of ranges: Java tests such a class with one bit lookup,
# which makes the split about seven times faster.
WORD_CHARS = string.ascii_lowercase + string.digits + "+#"
_WORD = re.compile(f"[{WORD_CHARS}]+")


def bounded(terms: list[str]) -> str:
    """Pattern for any of the terms standing alone; valid in Java and RE2."""
    words = "|".join(t.replace("+", r"\+") for t in terms)
    return f"(^|[^{WORD_CHARS}])({words})([^{WORD_CHARS}]|$)"


def standing(term: str) -> str:
    """Java pattern that finds a term where ``bounded`` does, in a fraction of the time.

    It begins with the term itself, so most places of a text fail at their first
    sign; what stands around it is looked at only where the term occurs.
    """
    word = term.replace("+", r"\+")
    return f"{word}(?![{WORD_CHARS}])(?<![{WORD_CHARS}]{word})"


def least_terms(terms: list[str]) -> list[str]:
    """The terms without those in which another one stands alone: where such a term occurs, the other one does."""
    return [t for t in terms if not any(u != t and re.search(bounded([u]), t) for u in terms)]


def skill_flag(text: Column | str, terms: list[str], lowered: bool = False) -> Column:
    """1 when any term occurs in the text, else 0; a null text gives 0.

    A plain substring search comes first: it is far cheaper than the bounded
    pattern, and most terms are absent from most texts. For several flags of one
    text, lower it once in a column of its own and say so.
    """
    low = as_col(text) if lowered else F.lower(as_col(text))
    found = F.lit(False)
    for term in least_terms([t.lower() for t in terms]):
        found = found | (low.contains(term) & low.rlike(standing(term)))
    return F.coalesce(found, F.lit(False)).cast("int")


def _owners(skills: dict[str, list[str]]) -> dict[str, list[str]]:
    """Skills per term; a term may reveal several."""
    owners: dict[str, list[str]] = {}
    for skill, terms in skills.items():
        for term in terms:
            owners.setdefault(term.lower(), []).append(skill)
    return owners


def with_found_skills(
    df: DataFrame,
    text: str,
    name: str,
    skills: dict[str, list[str]] | None = None,
    also: dict[str, dict[str, list[str]]] | None = None,
) -> DataFrame:
    """Add the names of all skills in the text as an array; ``also`` gives further columns and their skills.

    The text is split once, whatever the number of columns.
    """
    lists = {name: _owners(skills or SKILL_TERMS), **{column: _owners(more) for column, more in (also or {}).items()}}
    heads = {column: _heads(owners) for column, owners in lists.items()}
    words = list(dict.fromkeys(word for found in heads.values() for word in found[0]))
    df = df.withColumn("_low", F.lower(as_col(text))).withColumn(
        "_words", F.expr(f"array_intersect(split(_low, {_sql(f'[^{WORD_CHARS}]+')}), {_sql_array(words)})")
    )
    columns = {c: F.expr(_found_names(owners, *heads[c], only=len(lists) > 1)) for c, owners in lists.items()}
    return df.withColumns(columns).drop("_low", "_words")


def _heads(owners: dict[str, list[str]]) -> tuple[list[str], dict[str, str]]:
    """(the words that are terms or begin one, the first word of each phrase)."""
    phrases = {t: _WORD.search(t).group() for t in owners if not _WORD.fullmatch(t)}
    for term, head in phrases.items():
        if not term.startswith(head):
            raise ValueError(f"a term must start with a word character: {term!r}")
    return list(dict.fromkeys([t for t in owners if t not in phrases] + list(phrases.values()))), phrases


def _found_names(owners: dict[str, list[str]], words: list[str], phrases: dict[str, str], only: bool) -> str:
    """SQL of the skills found, from ``_words`` and ``_low``; ``only`` if there are words of other lists, too."""
    checks = [
        f"if(array_contains(_words, {_sql(head)}) and contains(_low, {_sql(t)}) "
        f"and _low rlike {_sql(standing(t))}, {_sql(t)}, null)"
        for t, head in phrases.items()
    ]
    known = f"array_intersect(_words, {_sql_array(words)})" if only else "_words"
    terms = f"concat({known}, array_compact(array({', '.join(checks)})))" if checks else known
    # a first word that is no term of its own has no entry
    pairs = ", ".join(f"{_sql(t)}, {_sql_array(names)}" for t, names in owners.items())
    names = f"transform({terms}, t -> coalesce(element_at(map({pairs}), t), array()))"
    return f"coalesce(array_distinct(flatten({names})), cast(array() as array<string>))"


def _sql(text: str) -> str:
    """SQL string literal; backslashes are escapes there."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sql_array(values: list[str]) -> str:
    return "array(" + ", ".join(_sql(v) for v in values) + ")"


def with_skill_flags(
    df: DataFrame,
    text: str,
    skills: dict[str, list[str]] | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Add ``skill_<name>`` for the kept skills and ``skill_count`` over all."""
    skills = skills or SKILL_TERMS
    keep = list(skills) if keep is None else keep
    found = with_found_skills(df, text, "_found", skills)
    flags = {f"skill_{s}": F.array_contains("_found", s).cast("int") for s in keep}
    return found.withColumns({**flags, "skill_count": F.size("_found")}).drop("_found")
