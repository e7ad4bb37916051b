"""Leaks that must be found whatever their case, the benchmark's rows and the items' length."""

import os
import subprocess
import sys

import pytest

from conftest import ROOT, SF_SMALL
from riskframe.llm import decontaminate

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def pairs(docs, bench):
    return {(r["doc_id"], r["item_id"]): r["share"] for r in decontaminate.leaks(docs, bench).collect()}


@pytest.mark.parametrize("case", [str, str.upper, str.lower, str.title])
def test_copies_in_other_case_are_found(spark, case):
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    docs = spark.createDataFrame([(i, "it is said here: " + case(t) + " and so on") for i, t in items], DOCS)
    got = pairs(docs, bench)
    assert {i for i, _ in items} == {d for d, i in got if d == i}


def test_item_in_other_case_and_copy_partly_in_capitals(spark):
    item = "Near the old mill the farmer Maria Lopez sold 12 kg of apples and then walked 7 miles along the river to the town of Lund for bread."
    half = item.replace("Maria Lopez sold 12 kg of apples and then walked", "MARIA LOPEZ SOLD 12 KG OF APPLES AND THEN WALKED").replace("Lund", "Visby")
    docs = spark.createDataFrame([(1, item.lower()), (2, half), (3, "a farmer sold apples in town and nothing else of it is here")], DOCS)
    got = pairs(docs, spark.createDataFrame([(1, item), (2, item.upper())], ITEMS))
    assert set(got) == {(1, 1), (1, 2), (2, 1), (2, 2)}


def test_repeated_rows_and_two_texts_under_one_id(spark):
    one = "the quick brown fox jumps over the lazy dog near the river bank every single morning"
    two = "seven old sailors sang quiet songs about distant harbours while the storm came closer to shore"
    docs = spark.createDataFrame([(1, "so " + one + " again"), (2, "so " + two + " again"), (3, "neither of them is to be found in here at all")], DOCS)
    bench = spark.createDataFrame([(1, one), (1, one), (1, one), (2, one), (2, two), (2, None)], ITEMS)
    assert pairs(docs, bench) == {(1, 1): 1.0, (1, 2): 1.0, (2, 2): 1.0}


def test_items_without_evidence_windows_are_searched_word_for_word(spark):
    bench = spark.createDataFrame([(1, "Who wrote Pride?"), (2, "3 4 5 6 7 8 9 10"), (3, "12 + 30 = 42"), (4, "?!"), (5, None)], ITEMS)
    docs = spark.createDataFrame([(1, "They asked: WHO WROTE PRIDE and left."), (2, "count 3, 4, 5, 6, 7, 8, 9, 10 now"), (3, "so 12 + 30 = 42 holds"),
                                  (4, "who wrote it with pride"), (5, "count 3 4 5 6 8 9 10 11 now"), (6, "so 12 + 31 = 43 holds"), (7, None), (8, "")], DOCS)
    assert pairs(docs, bench) == {(1, 1): 1.0, (2, 2): 1.0, (3, 3): 1.0}


def test_rows_are_dropped_by_their_own_text(spark):
    item = "the quick brown fox jumps over the lazy dog near the river bank every single morning"
    half = len(item.split()) // 2
    first, second = " ".join(item.split()[:half + 2]), " ".join(item.split()[half - 2:])
    rows = [(None, item, "a"), (None, "clean words only", "b"), (1, item, "c"), (1, "clean words only", "d"), (2, first, "e"), (2, second, "f"), (3, None, "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _path string")
    kept = decontaminate.drop_contaminated(docs, spark.createDataFrame([(1, item)], ITEMS))
    assert kept.columns == docs.columns and sorted(r["_path"] for r in kept.collect()) == ["b", "d", "e", "f", "g"]


@pytest.mark.parametrize("text", [" ".join(["NORTH"] * 200_000), " ".join(["North-Sea"] * 200_000), ",".join(["7"] * 200_000), "so " + "Ab'Cd " * 200_000],
                         ids=["upper", "title", "numbers", "joined"])
def test_long_runs_of_names_and_numbers_pass(spark, text):
    item = "the quick brown fox jumps over the lazy dog near the river bank every single morning"
    docs = spark.createDataFrame([(1, "a " + text), (2, "a " + text + " " + item)], DOCS)
    assert pairs(docs, spark.createDataFrame([(1, item)], ITEMS)) == {(2, 1): 1.0}


def test_joins_by_shuffle_find_the_same(spark, monkeypatch):
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = pairs(docs, bench)
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    assert pairs(docs, bench) == want and want


#: A document of 12,000 words that quotes all of a benchmark twice, on a heap of 1 GB: nearly each of its windows matches.
QUOTES = """
from itertools import product
from pyspark.sql import SparkSession
from riskframe.llm import decontaminate

spark = (SparkSession.builder.master("local[1]").config("spark.driver.memory", "1g").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {folder!r}).getOrCreate())
words = ["".join(w) for w in product("abcdefghiklmnopqrstu", repeat=3)][:6000]
items = [(i, " ".join(words[60 * i:60 * i + 60])) for i in range(100)]
docs = [(1, " ".join(2 * [t for _, t in items])), (2, "nothing of it stands in here at all")]
got = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
print("FOUND", len(got), sorted({{(r["doc_id"], r["share"]) for r in got}}))
"""


def test_document_that_quotes_the_benchmark_fits_a_small_heap(tmp_path):
    env = os.environ | {"PYTHONPATH": os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")]), "TMPDIR": str(tmp_path)}
    run = subprocess.run([sys.executable, "-c", QUOTES.format(folder=str(tmp_path))], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "FOUND 100 [(1, 1.0)]" in run.stdout, run.stderr[-3000:]


def test_slot_values_taken_in_the_join_are_those_of_the_window(spark):
    rows = [(1, ["a", decontaminate.NUM + "7", "b", "c", decontaminate.NAME + "ada", "d"]), (2, list("abcdef"))]
    at = spark.createDataFrame(rows, "k int, tokens array<string>").selectExpr("*", "explode(array(0, 1)) as pos")
    got = at.select("k", "pos", decontaminate._slots("tokens", at["pos"], 5), decontaminate._slots_in_join("tokens", at["pos"], 5)).collect()
    assert len(got) == 4 and all(r[2] == r[3] for r in got)
    assert {(r[0], r[1]): r[3] for r in got}[1, 1] == [decontaminate.NUM + "7", decontaminate.NAME + "ada"]
