"""Near copies that the fingerprints miss: texts that differ by a block, and large families."""

import random

import pytest

from jobweave.llm.simhash import near_groups

SIZES = [10, 14, 22, 40, 90, 200, 400, 1000]


def shingles(words):
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def words(draw, n):
    return [f"w{draw.randrange(5000)}" for _ in range(n)]


def components(spark, texts):
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    found = near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return {r.doc: r.component for r in found}


def expected(texts):
    """The smallest number of each text's group by brute force."""
    sets, group = [shingles(t) for t in texts], list(range(len(texts)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if 0.8 * len(sets[i]) <= len(sets[j]) <= len(sets[i]) / 0.8 and jaccard(sets[i], sets[j]) >= 0.8:
                group[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(texts))]


def same_grouping(found, want):
    leads = {}
    for i, c in found.items():
        leads[c] = min(leads.get(c, i), i)
    return [leads[found[i]] for i in range(len(want))] == want


def block_edits(draw, text, share):
    block = words(draw, max(1, int(share * len(text))))
    at = draw.randrange(len(text))
    return [text + block, text[: len(text) - len(block)], text[:at] + block + text[at:], text[:at] + text[at + len(block) :]]


@pytest.mark.parametrize("share", [0.05, 0.12, 0.19])
def test_blocks(spark, share):
    draw, texts = random.Random(7), []
    for n in SIZES * 4:
        text = words(draw, n)
        texts += [text, draw.choice(block_edits(draw, text, share))]
    want = expected(texts)
    assert sum(w != i for i, w in enumerate(want)) > len(SIZES)
    assert same_grouping(components(spark, texts), want)


@pytest.mark.parametrize("changes", [4, 5])
def test_large_family(spark, changes):
    """Members of one template, too far apart to link, each with one near copy."""
    draw = random.Random(changes)
    template, texts = words(draw, 200), []
    for _ in range(400):
        member = list(template)
        for at in draw.sample(range(200), changes):
            member[at] = words(draw, 1)[0]
        copy = list(member)
        for at in draw.sample(range(200), 3):
            copy[at] = words(draw, 1)[0]
        texts += [member, copy]
    assert same_grouping(components(spark, texts), expected(texts))
