"""The SQL of the line query states the operator's rule: both agree on lines made to tell rules apart."""

from __future__ import annotations

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from kinfold.llm import lines
from kinfold.llm.sql import LINES_SQL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def both(spark, rows):
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, lang varchar, source varchar, n_chars bigint)")
    con.executemany("insert into documents values (?, ?, ?, ?, ?)", rows)
    want = sorted(con.execute(f"select doc_id, n_lines, n_dropped, kept_md5 from ({LINES_SQL})").fetchall(), key=repr)
    cleaned = lines.drop_lines(spark.createDataFrame(rows, SCHEMA).repartition(3))
    got = cleaned.select("doc.doc_id", "cleaned.n_lines", "cleaned.n_dropped", F.md5(F.col("cleaned.text"))).collect()
    return sorted(map(tuple, got), key=repr), want


def words(rng, k):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(k))


def crowded(rng):
    lead, tail, middle, end = "the same four words", words(rng, 16), words(rng, 6), words(rng, 6)
    made = [f"{lead} {tail}"] * 12 + [f"{lead} {words(rng, 2)} {middle} {words(rng, 2)} {end}" for _ in range(12)]
    variant = tail.split(" ")
    made += [" ".join([lead, *variant[:7], words(rng, 1), *variant[8:]]) for _ in range(3)]
    return made + [f"{lead} {words(rng, 16)}" for _ in range(60)]


def begin_alike(rng):
    made = [f"it is known that {words(rng, 4)}" for _ in range(10)]
    return made + [" ".join(str(rng.randrange(10**6)) for _ in range(6)) for _ in range(10)] + ["17 18 19"] * 10


def mixed(rng):
    parts = ["a", "b", "c 1", "d 22", "e", "f", "g", "", "  h", "i j k l m n"]
    return ["\n".join(" ".join(rng.choice(parts) for _ in range(rng.randint(0, 4))) for _ in range(rng.randint(0, 9))) for _ in range(150)]


@pytest.mark.parametrize("make", [crowded, begin_alike, mixed])
def test_sql_and_operator_agree(spark, make):
    rng = random.Random(3)
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(make(rng))]
    rows += [(None, rows[0][1], None, None, None), (None, None, None, None, None), (0, rows[1][1], "en", "a", 1), (7777, "", "en", "a", 1)]
    got, want = both(spark, rows)
    assert got == want
    assert any(r[2] for r in got)
