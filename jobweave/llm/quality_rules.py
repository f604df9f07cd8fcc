"""Quality rules as a short-circuit cascade.

Every rule measures one thing of a text and rejects by it. On a sample each
rule's cost and share of rejections are estimated; the cascade then runs the
rules in descending order of rejections per cost and stops at the first that
rejects. The order changes the work, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobweave.llm.common import map_batches, words_of
from jobweave.session import ship_package

SAMPLE_ROWS = 1000

_SPACES = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_NO_LETTERS = bytes(b for b in range(128) if not chr(b).isalpha())


class TextView:
    """One text; what several rules share is computed once."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        return words_of(self.text)

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def lines(self) -> list[str]:
        """Lines that hold a word."""
        return [x for x in self.text.split("\n") if x.strip(_SPACES)]

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, _SPACES))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, _SYMBOLS))

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words that lie in a three-word window found at least twice."""
        if self.n_words < 4:
            return 0
        ids = pd.factorize(np.array(self.words, dtype=object))[0].astype(np.int64)
        # Two steps, so that the pair of a pair and a word fits 64 bits whatever the number of words.
        pairs = pd.factorize(ids[:-1] * (ids.max() + 1) + ids[1:])[0].astype(np.int64)
        windows = pd.factorize(pairs[:-1] * (ids.max() + 1) + ids[2:])[0]
        often = np.bincount(windows)[windows] > 1
        covered = np.zeros(self.n_words, dtype=bool)
        for k in range(3):
            covered[k : k + len(often)] |= often
        return int(covered.sum())

    @cached_property
    def n_letter_words(self) -> int:
        """Words with an ASCII letter or a sign beyond ASCII."""
        return sum(1 for w in self.words if w.translate(None, _NO_LETTERS))


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[TextView], bool]


# A text that fails one of these has no verdict to ask for.
BASE_RULES = (
    Rule("few_words", lambda v: v.n_words < 50),
    Rule("repetitive", lambda v: 100 * v.n_repeat_words > 50 * v.n_words),
)

RULES = (
    Rule("short_or_long_words", lambda v: not 2 * v.n_words <= v.word_chars <= 15 * v.n_words),
    Rule("symbols", lambda v: 10 * v.n_symbols > v.n_words),
    Rule("duplicate_lines", lambda v: 10 * v.n_dup_lines > 3 * len(v.lines)),
    Rule("few_letter_words", lambda v: 10 * v.n_letter_words < 7 * v.n_words),
)


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    seconds: float
    rejected: int
    rows: int

    @property
    def rejections_per_second(self) -> float:
        return self.rejected / max(self.seconds, 1e-9)


def estimate(
    docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS
) -> list[Estimate]:
    """Cost and rejections of every rule on ``sample_rows`` rows, best rule first.

    The sample is what the first partitions yield: it is cheap at any size of
    the table, and a poor sample can only cost time. Each rule is timed on a
    view of its own, so it pays for what it needs. The driver gets a row per
    rule and task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, hits, rows = [0.0] * len(rules), [0] * len(rules), 0
        for batch in batches:
            values = batch[0].to_pylist()
            rows += len(values)
            for k, rule in enumerate(rules):
                start = time.perf_counter()
                hits[k] += sum(1 for t in values if t and rule.rejects(TextView(t)))
                spent[k] += time.perf_counter() - start
        columns = [range(len(rules)), spent, hits, [rows] * len(rules)]
        names = ["rule", "seconds", "rejected", "rows"]
        yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in columns], names=names)

    sample = docs.select(F.col(text)).limit(sample_rows)
    totals = map_batches(sample, run, "rule long, seconds double, rejected long, rows long")
    sums = totals.groupBy("rule").agg(F.sum("seconds"), F.sum("rejected"), F.sum("rows")).collect()
    found = {r[0]: Estimate(rules[r[0]], *r[1:]) for r in sums}
    all_rules = [found.get(k, Estimate(rule, 0.0, 0, 0)) for k, rule in enumerate(rules)]
    return sorted(all_rules, key=lambda e: (-e.rejections_per_second, e.seconds, e.rule.name))


def apply_cascade(
    docs: DataFrame,
    text: str = "text",
    rules: tuple[Rule, ...] = RULES,
    base_rules: tuple[Rule, ...] = BASE_RULES,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """All rows and columns of ``docs`` with measures and verdict, replacing columns of these names.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long),
    base_failed and kept (boolean). The base rules come first, in the given
    order; the others only see texts that pass them, in the order of
    ``estimate``. Null and empty texts have zero counts and fail the base.
    Repeated rows get equal verdicts; whole texts are read.
    """
    order = tuple(e.rule for e in estimate(docs, text, rules, sample_rows))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    out = pa.struct([(c, pa.int64()) for c in counts] + [("base_failed", pa.bool_()), ("kept", pa.bool_())])
    kind = "struct<" + ", ".join(f"{c}: bigint" for c in counts) + ", base_failed: boolean, kept: boolean>"

    def judge(value: str | None) -> dict:
        view = TextView(value)
        failed = any(rule.rejects(view) for rule in base_rules)
        kept = not failed and not any(rule.rejects(view) for rule in order)
        return {c: getattr(view, c) for c in counts} | {"base_failed": failed, "kept": kept}

    @F.arrow_udf(kind)
    def judged(values: pa.Array) -> pa.Array:
        return pa.array([judge(t) for t in values.to_pylist()], out)

    ship_package(docs.sparkSession)
    with_verdict = docs.withColumn("_qr_found", judged(F.col(text)))
    return with_verdict.withColumns({c: F.col("_qr_found")[c] for c in (*counts, "base_failed", "kept")}).drop("_qr_found")
