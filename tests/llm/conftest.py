"""Fixtures of the operator tests: awkward documents and plain reference versions."""

from __future__ import annotations

import collections
import os
import re

import pytest

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


def words(text):
    return WORD.findall(text or "")


def shingles(text, n=5):
    w = words(text)
    if len(w) < n:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i: i + n]) for i in range(len(w) - n + 1))


def roots(nodes, links):
    """Smallest node that each node reaches."""
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


PROSE = " ".join(f"word{i % 97}x{i}" for i in range(120))
OTHER = " ".join(f"term{i}y" for i in range(80))

#: Nulls in every column, empty and blank texts, a long text, ties and repeated rows.
AWKWARD = [
    (1, PROSE, "en", "a"),
    (1, PROSE, "en", "a"),
    (2, PROSE.replace("word5x5 ", "changed "), "en", "a"),
    (3, None, "en", "a"),
    (4, "", None, None),
    (5, " \n\t ", "en", "b"),
    (6, "three short words", "en", "b"),
    (7, "three short words", None, "b"),
    (None, OTHER, None, None),
    (None, OTHER, "de", "a"),
    (8, "\n".join([OTHER, "own line here", PROSE]), "de", "c"),
    (9, "ünïcode ▁ text <|im_end|> 日本 " * 30, "de", "c"),
    (10, " ".join(f"long{i}" for i in range(60_000)), "en", "a"),
    (11, "x" * 5_000, "en", "a"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """The awkward documents with extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(AWKWARD, "doc_id long, text string, lang string, source string")
    df = df.withColumn("n_chars", F.length("text").cast("long"))
    for name in ("rid", "row", "size", "score", "n_words", "kept", "class_rid", "ids", "new_text", "weight", "copies", "my col.x"):
        df = df.withColumn(name, F.lit("mine"))
    return df


@pytest.fixture(scope="session")
def documents(spark):
    path = f"{SF}/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("needs the driver's tables")
    return spark.read.parquet(path)


def counter(rows):
    return collections.Counter(rows)
