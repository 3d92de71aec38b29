"""Fixtures of the training-data operators: small tables with every awkward case, and brute-force versions."""

from __future__ import annotations

import random
import re

from vaultmart.llm.common import stored

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row long, node string, value int, `key` string, spans string"
WORDS = "alpha beta gamma delta river stone garden light window paper quiet morning".split()


def store(spark):
    return lambda df, name: stored(spark, df, name)


def docs_frame(spark, rows):
    """``rows``: (doc_id, text[, lang[, source]]); further columns clash with names the operators use inside."""
    full = []
    for i, r in enumerate(rows):
        r = tuple(r) + (None,) * (4 - len(r))
        full.append((*r[:4], len(r[1]) if r[1] else 0, i, "x", 7, "k", "s"))
    return spark.createDataFrame(full, DOCS)


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ",", "."]) for _ in range(n))


def awkward_rows(seed=3):
    """Nulls, empties, white space, ties, repeated rows, upper case, non-ASCII, one very long text, null ids."""
    rng = random.Random(seed)
    rows = [(i, sentence(rng, rng.randint(1, 60)), "en", f"s{i % 3}") for i in range(20)]
    rows += [(20, None, None, None), (21, "", "en", "s0"), (22, " \t\n ", "en", "s0"), (23, rows[0][1].upper(), "en", "s1"),
             (24, rows[0][1], "en", "s1"), (24, rows[0][1], "en", "s1"), (25, "Été à Zürich — ÉTÉ", "fr", "é"),
             (26, sentence(rng, 30_000), "en", "long"), (27, "a", "en", "s2"), (28, "x" * 20_000, "en", "s2"),
             (None, "no id here", "en", "s0"), (None, rows[1][1], None, "s0"), (29, "\U0001F600 　 ok", "en", None)]
    return rows


def words_between_spaces(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
