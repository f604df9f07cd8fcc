"""Job titles: cleaning passes, seniority and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobweave.functions import as_col, fold_replace

# Ordered cleaning passes as (name, pattern, replacement). Patterns are valid in
# both Java and RE2 and see lower-cased text. Suffix passes tolerate the blanks
# earlier passes leave behind.
TITLE_PASSES: list[tuple[str, str, str]] = [
    ("punctuation to space", r"[^\p{L}\p{N}+#-]+", " "),
    (
        "split fused words",
        r"(architect|engineer|developer|analyst|scientist|manager|designer|administrator)"
        r"(architect|engineer|developer|analyst|scientist|manager|designer|administrator|lead)",
        "$1 $2",
    ),
    ("roman numeral suffix", r" +(i|ii|iii|iv|v|vi) *$", ""),
    ("seniority suffix", r" +(ssr|snr|sr|jr) *$", ""),
    ("numeric id suffix", r" +[0-9]{4,} *$", ""),
    ("alphanumeric id suffix", r" +[a-z]{1,3}[0-9]{2,} *$", ""),
    ("country code suffix", r" +(uk|gb|usa|us|ke|eu|emea|apac|latam) *$", ""),
    (
        "contract and work type suffix",
        r"( +(remote|hybrid|onsite|on-site|contractor|contract|freelance|temporary|permanent"
        r"|full time|full-time|part time|part-time))+ *$",
        "",
    ),
    (
        "clearance suffix",
        r"( +(public trust|top secret|secret clearance|security clearance|clearance required|clearance|ts sci))+ *$",
        "",
    ),
    (
        "qualification suffix",
        r" +(strong|with|must have|proficient in|experienced in|experience in|knowledge of) .*$",
        "",
    ),
    ("organisation suffix", r" +(productivity|enablement|department|division|organization|organisation) *$", ""),
    ("product suffix", r" +(epic bridges|epic|salesforce|servicenow|workday|guidewire) *$", ""),
    ("job at X in Y", r" +job at .*$", ""),
    ("dash suffix", r" +-+ .*$", ""),
    ("expand sr", r"\bsr\b", "senior"),
    ("expand swe", r"\bswe\b", "software engineer"),
    ("collapse spaces", r" +", " "),
]

# Label, rank and keywords, best rank first. Mid is the fallback.
SENIORITY: list[tuple[str, int, list[str]]] = [
    ("C-Suite", 9, ["chief", "cto", "cdo"]),
    ("Director+", 8, ["director", "head of", "vp", "vice president"]),
    ("Principal", 7, ["principal"]),
    ("Staff", 6, ["staff"]),
    ("Lead", 5, ["lead"]),
    ("Senior", 4, ["senior"]),
    ("Junior", 2, ["junior", "associate", "level i"]),
    ("Intern", 1, ["intern", "graduate", "trainee"]),
]
MID_LABEL, MID_RANK = "Mid", 3

# Requisition codes such as AB-123 are not titles. Titles arrive lower-cased, so
# the test ignores case.
REQUISITION_CODE = r"(?i)^[A-Z]{2,}-[0-9]+"


def normalize_job_title(title: Column | str) -> Column:
    """Cleaned title, or null when nothing is left."""
    passes = [(pattern, replacement) for _, pattern, replacement in TITLE_PASSES]
    dashes = F.translate(F.lower(F.trim(as_col(title))), "–—", "--")
    return F.nullif(F.trim(fold_replace(dashes, passes)), F.lit(""))


def seniority_pattern(keywords: list[str]) -> str:
    return r"\b(" + "|".join(keywords) + r")\b"


def derive_seniority_level(title: Column | str) -> Column:
    """First label whose keyword occurs in the normalized title."""
    text = F.lower(as_col(title))
    out = F
    for label, _, words in SENIORITY:
        out = out.when(text.rlike(seniority_pattern(words)), F.lit(label))
    return out.otherwise(F.lit(MID_LABEL))


def derive_seniority_rank(level: Column | str) -> Column:
    """Rank 1-9 of a seniority label."""
    label = as_col(level)
    out = F
    for name, rank, _ in SENIORITY:
        out = out.when(label == name, F.lit(rank))
    return out.otherwise(F.lit(MID_RANK))


def is_valid_title(title: Column | str) -> Column:
    """Longer than two characters and not a requisition code."""
    text = as_col(title)
    return text.isNotNull() & (F.length(F.trim(text)) > 2) & ~text.rlike(REQUISITION_CODE)
