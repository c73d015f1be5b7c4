"""The training-data operators against brute force, on small tables and odd rows."""

from __future__ import annotations

import hashlib
import html as entities
import itertools
import math
import os
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skygauge.llm import (
    chat, decontaminate, html, language_model, lines, mixing, ngram_join, quality, toxicity, urls)
from skygauge.llm.common import stored
from skygauge.llm.components import connected_components
from skygauge.llm.oracle import EXPECTED_SQL
from skygauge.llm.queries import QUERIES
from tests.conftest import plan

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def frame(spark, texts, source="s", first=0):
    return spark.createDataFrame(
        [(first + i, t, "en", source, len(t or "")) for i, t in enumerate(texts)], DOCS)


def pseudo(n, seed=0):
    return " ".join(f"w{(i * 7919 + seed * 104729) % 99991}x" for i in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, clashing and extra columns."""
    rows = [(1, None, None), (2, "", "b"), (None, "some words here", "b"), (4, pseudo(60), None), (4, pseudo(60), None),
            (5, pseudo(40_000, 3), "c"), (6, "   \n\t ", "c")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn(
        "n_words", F.lit(7)).withColumn("key", F.lit("k")).withColumn("quality", F.lit(1.5))


# --- components -------------------------------------------------------------

def test_components_of_a_chain_a_star_and_a_loop(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7777, 7777)]
    found = dict(connected_components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect())
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 7777: 7777}


def test_components_without_edges(spark):
    assert connected_components(spark.createDataFrame([], "x long, y long"), "x", "y").collect() == []


# --- 10 quality rules -------------------------------------------------------

def repeat_words(words):
    seen = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    return len({i + k for i in range(len(words) - 2) if seen[tuple(words[i:i + 3])] > 1 for k in range(3)})


@pytest.mark.parametrize("text", ["", "a b", "a b c", "a b c a b c", "a a a a", "x a b c y a b c z a b c", "a b c d a b"])
def test_repeated_words(spark, text):
    found = spark.createDataFrame([(text,)], "text string").select(
        quality.n_repeat_words(quality.words(F.col("text")))).first()[0]
    assert found == repeat_words(text.split())


@tables
def test_quality_equals_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    answer = connection.execute(EXPECTED_SQL["op10_quality_rules"])
    names = [c[0] for c in answer.description]
    found = QUERIES["op10_quality_rules"](spark, SF_DIR)
    assert sorted(map(tuple, found.select(*names).collect())) == sorted(answer.fetchall())


def test_quality_of_odd_rows(spark, odd):
    rows = quality.judge(odd).collect()
    assert len(rows) == 7 and all(r["n_words"] == 7 for r in rows)
    assert {r["doc_id"]: r["quality"]["base_failed"] for r in rows} == {
        1: True, 2: True, None: True, 4: False, 5: False, 6: True}
    assert quality.judge(odd.limit(0)).count() == 0
    assert sorted(r["doc_id"] for r in quality.good(odd).collect()) == [4, 4, 5]


# --- 1 line dedup -----------------------------------------------------------

def test_lines_like_each_other_stay_once(spark):
    line = pseudo(40)
    near = line.replace(line.split()[20], "other")
    docs = frame(spark, [f"first own line of one\n{line}", f"{line}\nanother line of its own here", near, "short one\nshort one"])
    found = {r["doc_id"]: r["text"] for r in lines.dedup_lines(docs).collect()}
    assert found == {0: f"first own line of one\n{line}", 1: "another line of its own here", 2: "", 3: "short one\nshort one"}


def test_lines_edited_at_random_places_are_found(spark):
    rng = random.Random(7)
    first, second, alike = [], [], []
    for n in (5, 6, 7, 9, 10, 11, 12, 14, 15, 19, 20, 25, 30, 40, 60, 80, 100):
        for k in range(40):
            line = [f"w{rng.randrange(20_000)}x" for _ in range(n)]
            near = list(line)
            edits = rng.randint(1, n // 5)
            if k % 4 == 3:  # twice as many words as the limit allows
                edits = 2 * (n // 5) + 1
            for at in rng.sample(range(n), edits):
                near[at] = f"new{rng.randrange(10**6)}"
            if k % 4 == 2:
                at = rng.randrange(n)
                near = near[:at] + near[at + 1:] if edits == 1 else line[:at] + ["put", *line[at:]]
            if len(near) < lines.MIN_WORDS:
                continue
            first.append(" ".join(line))
            second.append(" ".join(near))
            alike.append(edit_distance(line, near) <= max(len(line), len(near)) * 20 // 100)
    found = {r["doc_id"]: r["line_dedup"]["n_removed"] for r in lines.dedup_lines(frame(spark, first + second)).collect()}
    removed = [found[len(first) + i] == 1 for i in range(len(second))]
    assert not any(r and not a for r, a in zip(removed, alike, strict=True))
    recall = sum(removed) / sum(alike)
    print(f"recall {recall:.4f} of {sum(alike)} pairs")
    assert recall >= 0.99


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def grouped_by_brute_force(texts):
    """Which lines go: all but the first of each group of lines that edits connect."""
    kinds = [re.findall(r"[^\W_]+", t.lower()) for t in texts]
    bags, part = [Counter(k) for k in kinds], list(range(len(texts)))
    for i, a in enumerate(kinds):
        for j in range(i):
            b = kinds[j]
            longer = max(len(a), len(b))
            limit = longer * 20 // 100
            # No fewer edits than the longer line has words that the other lacks.
            if part[i] == part[j] or min(len(a), len(b)) < max(lines.MIN_WORDS, longer - limit) or longer - sum(
                    (bags[i] & bags[j]).values()) > limit:
                continue
            if edit_distance(a, b) <= limit:
                old, new = max(part[i], part[j]), min(part[i], part[j])
                part = [new if p == old else p for p in part]
    return [p != i for i, p in enumerate(part)]


def test_groups_of_many_lines_are_joined(spark):
    """Chains and clouds of copies of copies, among lines that are like nothing."""
    rng = random.Random(4)
    texts = [pseudo(rng.randrange(5, 40), 1000 + i) for i in range(30)]
    for size in (6, 11, 18, 30):
        line = [f"w{rng.randrange(9999)}x" for _ in range(size)]
        for _ in range(25):
            near = list(line)
            for at in rng.sample(range(size), max(1, size // 10)):
                near[at] = f"n{rng.randrange(10**6)}"
            texts.append(" ".join(near))
            if rng.random() < 0.3:
                line = near
    found = {r["doc_id"]: r["line_dedup"]["n_removed"] == 1 for r in lines.dedup_lines(frame(spark, texts)).collect()}
    expected = grouped_by_brute_force(texts)
    wrong = [i for i in range(len(texts)) if found[i] != expected[i]]
    assert sum(expected) > 60 and len(wrong) <= 0.02 * sum(expected)


def test_signatures_are_shuffled_once_as_two_numbers(spark):
    texts = [pseudo(5 + i % 40, i % 90) for i in range(120)]
    _, table, live = lines._line_tables(frame(spark, texts), lines.MIN_WORDS)
    assert "signs" not in table.columns and live.columns == ["sig", "h1", "least"]
    signed = spark.createDataFrame([(1, [7, 8]), (2, [7, 9]), (3, [9, 9]), (4, [5])], "h1 long, signs array<long>")
    shared = lines.shared_signatures(signed)
    text = plan(shared)
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 1 and "Join" not in text
    assert sorted(map(tuple, shared.collect())) == [(7, 1, 1), (7, 2, 1), (9, 2, 2), (9, 3, 2)]


def test_no_pair_of_lines_is_compared_twice(spark):
    """Of (sig, h1, least, part): what the least line was compared with, or two leads, is not taken again."""
    rows = [(1, 10, 10, 1), (1, 11, 10, 2),  # the two were compared already
            (2, 10, 10, 1), (2, 11, 10, 2), (2, 12, 10, 3), (2, 13, 10, 3), (2, 14, 10, 1),
            (3, 20, 20, 5), (3, 21, 20, 6), (3, 22, 20, 7)]
    some = lines.mixed(spark.createDataFrame(rows, "sig long, h1 long, least long, part long")).cache()
    assert sorted((r["sig"], r["h1"], r["lead"]) for r in some.collect()) == [
        (2, 11, True), (2, 12, True), (2, 13, False), (2, 14, False), (3, 21, True), (3, 22, True)]
    texts = spark.createDataFrame([(h, f"n{h}", 5, "abcde", 0, 0) for h in (11, 12, 13, 14, 21, 22)],
                                  "h1 long, node string, size int, norm string, even long, odd long")
    leads = {tuple(sorted(r)) for r in lines.lead_pairs(some, texts).collect()}
    rest = {tuple(sorted(r)) for r in lines.cross_pairs(some, texts).collect()}
    assert leads == {("n11", "n12"), ("n21", "n22")}
    assert rest == {("n11", "n13"), ("n11", "n14"), ("n12", "n14"), ("n13", "n14")}


def test_pairs_are_told_apart_without_their_words(spark):
    """Stars need sketches alone, in numbers; a pair whose parities differ is no candidate."""
    live = spark.createDataFrame([(1, 10, 10), (1, 11, 10), (1, 12, 10), (2, 10, 10), (2, 11, 10)],
                                 "sig long, h1 long, least long")
    sketches = spark.createDataFrame([(10, 10, 5, 0, 0), (11, 11, 5, 3, 0), (12, 12, 5, 255, 0)],
                                     "h1 long, node long, size int, even long, odd long")
    assert [tuple(r) for r in lines.star_pairs(live, sketches).collect()] == [(10, 11)]


def test_lines_are_cut_like_a_regular_expression_cuts_them(spark):
    texts = ["", None, "Ünï cöde 3rd lìne, Ж-5 κ9\n\none two\n" + pseudo(30), "a b c d e\nA, b; C d e!\na b c e d", "x\n" * 3]
    cut = lines.marked_lines(frame(spark, texts), 2).collect()
    expected = [(i, at, len(found)) for i, t in enumerate(texts) for at, line in enumerate((t or "").split("\n"))
                for found in [re.findall(r"[^\W_]+", line)] if len(found) >= 2]
    assert sorted((r["doc_id"], r["pos"], r["size"]) for r in cut) == expected
    same = {r["pos"]: (r["h1"], r["h2"], r["even"], r["odd"], r["signs"]) for r in cut if r["doc_id"] == 3}
    assert same[0] == same[1] and same[0][0] != same[2][0] and same[0][1] != same[2][1]
    assert same[0][2:4] == same[2][2:4]  # parities do not know the order of words


def test_line_dedup_runs_no_python_on_executors(spark, monkeypatch):
    """Every stored step and the result are DataFrame functions only."""
    plans, store = [], lines.stored
    monkeypatch.setattr(lines, "stored", lambda df, *a, **b: plans.append(plan(df)) or store(df, *a, **b))
    found = lines.dedup_lines(frame(spark, [pseudo(40, i % 7) + f"\n{pseudo(30, i)}" for i in range(20)]))
    assert len(plans) > 4 and not any(re.search("MapIn|EvalPython|InPandas|PythonUDF", p) for p in [*plans, plan(found)])


def test_later_links_join_components_and_do_not_walk_through_their_lines(spark, monkeypatch):
    """What is found after the stars links whole components; the result is that of all links at once."""
    first = [(1, k) for k in range(2, 30)] + [(40, 41), (41, 42), (50, 51), (60, 61)]
    more = [(29, 42), (41, 7), (51, 70), (80, 81), (2, 3)]
    links, found, walked = "a long, b long", lines.connected_components, []

    def walk(edges, a, b):
        walked.append({tuple(r) for r in edges.select(a, b).collect()})
        return found(edges, a, b)

    parts = found(spark.createDataFrame(first, links), "a", "b")
    monkeypatch.setattr(lines, "connected_components", walk)
    together = lines.joined(parts, spark.createDataFrame(more, links))
    expected = found(spark.createDataFrame(first + more, links), "a", "b")
    assert sorted(map(tuple, together.collect())) == sorted(map(tuple, expected.collect()))
    assert walked == [{(1, 40), (40, 1), (50, 70), (80, 81), (1, 1)}]


def test_words_are_numbered_and_sketched_without_steps_for_each_word(spark):
    """Words are counted only in lines that repeat one; a sketch takes its bit from a table, the parity of the words there."""
    texts = ["one two three four five six", "one two one four five one", "ж ab cde fgh ijk lm no ab"]
    rows = frame(spark, texts).select("doc_id", lines.line_words(F.col("text")).alias("found"))
    rows = rows.select("*", lines.word_keys(F.col("found")).alias("keys"))
    marked = rows.select("*", lines.parity(F.col("keys"), 0).alias("even"), lines.parity(F.col("keys"), 1).alias("odd"),
                         lines.word_triples(F.col("found")).alias("triples"))
    for r in marked.collect():
        bits = [0, 0]
        for k in r["keys"]:
            bits[k >> 6 & 1] ^= 1 << (k & 63)
        assert [r["even"] % 2**64, r["odd"] % 2**64] == bits and len(r["triples"]) == 4
    text = plan(marked)
    assert "shiftleft(cast" not in text and "array_distinct" in text and "bit_not" not in text and "~" not in text


def test_a_pair_of_lines_is_compared_in_one_signature(spark):
    """Two lines that share signatures are compared in the least one; unlike ones are left out before their words are read."""
    rows = [(s, h, h, False) for s in (1, 2, 3) for h in (11, 12, 13)]
    some = spark.createDataFrame(rows, "sig long, h1 long, part long, lead boolean")
    sketches = spark.createDataFrame([(11, 11, 5, 0, 0), (12, 12, 5, 3, 0), (13, 13, 5, 0, 255)],
                                     "h1 long, node long, size int, even long, odd long")
    left = lines.plausible(some, sketches).cache()
    assert sorted((r["sig"], r["h1"]) for r in left.collect()) == [(s, h) for s in (1, 2, 3) for h in (11, 12)]
    texts = sketches.selectExpr("*", "IF(h1 = 11, 'abcde', 'abcdx') AS norm")
    pairs = lines._alike(left, texts, F.lit(True))
    assert [tuple(sorted(r)) for r in pairs.collect()] == [(11, 12)] and "arrays_overlap" in plan(pairs)


def test_words_that_the_other_line_lacks_settle_long_lines(spark):
    """Counting them changes no verdict of the edit distance."""
    rng = random.Random(5)
    rows = []
    for n in (lines.FAR - 1, lines.FAR, 300):
        for edits in (0, n // 50, n // 10, n // 5, n // 5 + 1, n // 2):
            a = [chr(0x1000 + rng.randrange(9000)) for _ in range(n)]
            b = list(a)
            for at in rng.sample(range(n), edits):
                b[at] = chr(0x5000 + at)
            rows.append(("".join(a), "".join(b), edits <= n * 20 // 100))
    found = spark.createDataFrame(rows, "a string, b string, alike boolean")
    assert found.filter(lines.edit_similar(F.col("a"), F.col("b")) != F.col("alike")).count() == 0


def test_dedup_of_odd_rows(spark, odd):
    rows = lines.dedup_lines(odd).collect()
    assert len(rows) == 7 and all(r["quality"] == 1.5 for r in rows)
    assert [r["text"] for r in rows if r["doc_id"] == 4] == [pseudo(60)] * 2
    assert lines.dedup_lines(odd.limit(0)).count() == 0


# --- 7 n-gram join ----------------------------------------------------------

def components(texts, size, percent):
    sets = []
    for text in texts:
        w = (text or "").encode().lower().split()
        k = min(size, len(w))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set())
    part = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                old, new = max(part[i], part[j]), min(part[i], part[j])
                part = [new if p == old else p for p in part]
    return [(len(s), p) for s, p in zip(sets, part, strict=True)]


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80)])
def test_join_equals_brute_force(spark, size, percent):
    base = [pseudo(200, s).split() for s in range(4)]
    texts = [None, "", "one two", "One two", "A b c d e f"]
    for b in base:
        for change in range(9):
            w = list(b)
            for k in range(change):
                w[17 * k + 3 * change] = f"c{change}"
            texts.append(" ".join(w))
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"])
             for r in ngram_join.ngram_components(frame(spark, texts), size, percent).collect()}
    assert [found[i] for i in range(len(texts))] == components(texts, size, percent)


def test_join_of_odd_rows(spark, odd):
    rows = ngram_join.ngram_components(odd, 3, 90).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in rows) == [
        (0, 0), (1, 1), (2, 2), (4, 4), (4, 4), (5, 5), (6, 6)]
    assert ngram_join.ngram_components(odd.limit(0)).count() == 0


# --- 4 decontamination ------------------------------------------------------

def test_planted_items_are_found_and_clean_texts_are_not(spark):
    items = [pseudo(n, 50 + n) for n in (15, 30, 59)]
    changed = items[2].replace(items[2].split()[10], "other")
    texts = [pseudo(500, 1), f"{pseudo(90, 2)} {items[0]} {pseudo(33, 3)}", changed.upper(), pseudo(300, 4), None, "",
             f"{items[1]} {pseudo(7, 5)} {items[0]}"]
    bench = spark.createDataFrame(list(enumerate(items)) + [(9, None)], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(frame(spark, texts), bench).collect()}
    assert found == {(1, 0), (2, 2), (6, 1), (6, 0)}
    assert decontaminate.contaminated(frame(spark, texts), bench.limit(0)).count() == 0


def test_near_copies_with_edits_at_every_place_are_found():
    items = [(n, decontaminate.words_of(pseudo(size, n + 1).encode())) for n, size in enumerate((8, 12, 19, 30, 60))]
    frequency = Counter(w for _, found in items for w in set(found))
    index = decontaminate.build_index(items, frequency, len(items))
    texts, wanted = [], []
    for number, (_, found) in enumerate(index.items):
        for at in range(len(found)):
            near = [*found[:at], b"other", *found[at + 1:]]
            texts.append([b"before"] * 5 + near + [b"after"] * 5)
            wanted.append(number)
    pairs = {(t, i) for t, i, q, a in decontaminate.search(index, texts, decontaminate.THRESHOLD)
             if q >= decontaminate.QUESTION and a >= decontaminate.ANSWER}
    assert pairs == set(enumerate(wanted))


def test_punctuation_does_not_hide_an_item(spark):
    item = " ".join(f"{w}," for w in pseudo(20).split()) + "."
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = frame(spark, [f"before {pseudo(20)} after", "nothing of it here"])
    assert [r["doc_id"] for r in decontaminate.contaminated(docs, benchmark).collect()] == [0]


def test_a_pair_is_kept_if_one_passage_passes_both_limits():
    found = decontaminate.words_of(pseudo(60).encode())
    index = decontaminate.build_index([(1, found)], Counter(found), 1)
    question, answer = decontaminate.question_answer(found)
    far = [b"x"] * 300
    text = question + [b"y"] * len(answer) + far + question[:-4] + [b"z"] * 4 + answer
    (_, _, q, a), = decontaminate.search(index, [text], decontaminate.THRESHOLD)
    assert q >= decontaminate.QUESTION and a >= decontaminate.ANSWER


def test_items_are_found_wherever_runs_of_a_long_text_meet():
    items = [(n, decontaminate.words_of(pseudo(40, n + 60).encode())) for n in range(20)]
    frequency = Counter(w for _, found in items for w in set(found))
    index = decontaminate.build_index(items, frequency, len(items))
    run = decontaminate.RUN * decontaminate.CELL
    text = [b"other"] * (3 * run)
    for number, at in enumerate(range(2 * run - 60, 2 * run + 21, 8)):
        near = [*text[:at], *items[number][1], *text[at:]]
        assert {index.items[i][0] for _, i, q, a in decontaminate.search(
            index, [[], near, [b"other"]], decontaminate.THRESHOLD) if (q, a) == (1, 1)} == {number}
    index = decontaminate.build_index([], Counter(), 0)
    assert not list(decontaminate.search(index, [text], decontaminate.THRESHOLD))


def test_repeated_rows_of_a_contaminated_text_give_one_pair(spark):
    docs = frame(spark, [f"{pseudo(3000, 7)} {pseudo(20)} {pseudo(9, 8)}"]).withColumn("item_id", F.lit(5))
    benchmark = spark.createDataFrame([(1, pseudo(20)), (2, pseudo(20, 3))], "item_id long, text string")
    pairs = decontaminate.contaminated(docs.union(docs), benchmark).select("doc_id", "item_id").collect()
    assert [tuple(r) for r in pairs] == [(0, 1)]
    assert decontaminate.contaminated(docs.limit(0), benchmark).count() == 0


def test_wand_retrieves_what_full_scoring_does():
    items = [(i, [f"w{(i * k) % 23}".encode() for k in range(1, 12)]) for i in range(40)]
    frequency = Counter(w for _, found in items for w in set(found))
    index = decontaminate.build_index(items, frequency, len(items))
    terms = [index.words[w] for w in sorted({b"w1", b"w2", b"w4", b"w8", b"w16", b"w9", b"w0"}) if w in index.words]
    scores = Counter()
    for t in terms:
        for item, share in zip(*index.postings[t], strict=True):
            scores[item] += share
    for threshold in (0.2, 0.5, 0.8):
        found = [i for b in range(len(index.spans)) for i in decontaminate.retrieve(index, b, terms, threshold)]
        assert found == sorted(i for i, s in scores.items() if s >= threshold)


# --- 9 mixing ---------------------------------------------------------------

def levels(sizes, cap=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    fixed, total = {}, sum(sizes.values())
    while True:
        free = [s for s in order if s not in fixed]
        rest = total - sum(fixed.values())
        target = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if target[s] > cap * sizes[s]]
        if not over:
            return {**fixed, **target}
        fixed.update({s: cap * sizes[s] for s in over})


def test_mix_comes_near_its_targets(spark):
    docs = frame(spark, [pseudo(5 + i % 40, i) for i in range(300)], "a")
    for k, (source, n) in enumerate([("b", 20), (None, 120), ("c", 3)]):
        docs = docs.union(frame(spark, [pseudo(5 + i % 30, i + k) for i in range(n)], source, 1000 * (k + 1)))
    rows = mixing.mix(docs).collect()
    assert rows and sorted(rows) == sorted(mixing.mix(docs.repartition(5)).collect())
    sizes, taken = Counter(), Counter()
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    for source, target in levels(sizes).items():
        assert {round(r["target"], 6) for r in rows if r["source"] == source} == {round(target, 6)}
        assert abs(taken[source] - target) <= 40


def test_mix_of_odd_rows(spark, odd):
    assert mixing.mix(odd).count() == 7
    assert mixing.mix(odd.limit(0)).count() == 0


# --- 2 toxicity -------------------------------------------------------------

def test_insults_are_found_with_letters_put_in_between(spark):
    bad, fair = ["grumbleface", "nitwit", "bonehead"], 240
    texts = [pseudo(30, i) + f". You {bad[i // 4 % 3] if i % 4 == 0 else 'friend'} there." for i in range(fair)]
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(fair)], "doc_id long, quality int, toxic int")
    probe = ["you n i t w i t", "a bone-head!", "grumbxleface", "plain words only", "", None]
    model = toxicity.fit(docs, labels)
    found = {r["doc_id"]: r for r in toxicity.score(frame(spark, probe), model).collect()}
    assert [found[i]["predicted"] for i in range(6)] == [1, 1, 1, 0, 0, 0]
    assert all(found[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(6))
    assert all(r["predicted"] == 0 for r in toxicity.toxicity(docs, labels.limit(0)).collect())


def test_a_word_is_scored_by_the_kernel_of_its_landmarks():
    def occurrences(word):
        found = {}
        for i, j, k in itertools.combinations(range(len(word)), 3):
            if k - i < toxicity.SPAN:
                key = word[i], word[j], word[k]
                found[key] = max(found.get(key, 0), toxicity.DECAY ** (k - i - 2))
        return found

    def compared(x, y):
        return sum(v * y.get(key, 0) for key, v in x.items())

    names, weights = ["nitwit", "ass", "bonehead"], np.array([0.7, 1.5, -0.4])
    maps = [occurrences(n) for n in names]
    model = toxicity.Model(toxicity.Landmarks(names).table @ weights[:, None], -0.25)
    for word in ["nitwit", "nxixtxwxixt", "a", "", "assassin", "boneheadednesses", "as", "abracadabraaaaaass"]:
        wanted = sum(w * compared(occurrences(word), m) / compared(m, m) ** 0.5 for w, m in zip(weights, maps, strict=True))
        assert model.margins([word])[0] == pytest.approx(wanted - 0.25)
    assert model.worst(["x y n i t w i t z", "bone-head", ""])[2] == (-0.25, "")
    assert model.margins(["b-o.n3ehead"]) == model.margins(["bonehead"])


def test_toxicity_of_odd_rows_is_that_of_their_texts(spark):
    bad, fair = ["grumbleface", "nitwit", "oaf"], 240
    docs = frame(spark, [pseudo(30, i) + f" You {bad[i // 4 % 3] if i % 4 == 0 else 'friend'} there" for i in range(fair)])
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(fair)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    long = " ".join(["plain words"] * 30_000)
    probe = ["you oaf", "you oaf", long, f"{long} nitwit {long}", "gxrumbleface", "x" * 5000, f"{'.' * 4000}nitwit", None]
    table = frame(spark, probe).withColumns({"score": F.lit("x"), "held_out": F.lit(1), "toxic": F.lit(None)})
    rows = toxicity.score(table.union(table.limit(1)), model).orderBy("doc_id").collect()
    assert [r["predicted"] for r in rows] == [1, 1, 1, 0, 1, 1, 0, 1, 0]
    assert rows[0] == rows[1] and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0
    spelt = [w[:at] + "x" + w[at:] for w in bad[:2] for at in range(1, len(w))]
    assert sum(model.score(m) >= 0.5 for m, _ in model.worst(spelt)) >= 0.9 * len(spelt)


# --- 3 language model -------------------------------------------------------

@tables
def test_language_model_base_is_exact_and_the_model_better(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").union(frame(spark, [None, ""], first=10**6))
    held = toxicity.held_out(F.col("doc_id"), 1)
    rows = {r["doc_id"]: r for r in language_model.score(docs, ~held).collect()}
    texts = {r["doc_id"]: (r["text"] or "").encode().lower().split() for r in docs.collect()}
    counts = Counter()
    for i, w in texts.items():
        if zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update([*w, b""])
    n, total = sum(counts.values()), sum(counts.values()) + 0.5 * (len(counts) + 1)
    for i, w in texts.items():
        base = sum(math.log10((counts[x] + 0.5) / total) for x in [*w, b""])
        assert rows[i]["base_score"] == pytest.approx(base, rel=1e-9)
        assert (rows[i]["n_tokens"], rows[i]["n_known"], rows[i]["train_tokens"]) == (
            len(w) + 1, sum(x in counts for x in [*w, b""]), n)
    assert sum(r["score"] for r in rows.values()) > sum(r["base_score"] for r in rows.values())


def test_language_model_does_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(language_model, "MIXED_TOKENS", 300)
    texts = [pseudo(5 + i * 7 % 60, i % 13) for i in range(120)]
    docs = frame(spark, [*texts, None, "", texts[3]])
    models = []
    for parts in (1, 5, 16):
        rows = docs.repartition(parts).select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
        own = [f"w{(i * 7919) % 99991}x".encode() for i in range(20)]
        mass = language_model.class_mass(language_model.count_words(rows), own)
        models.append(language_model.fit(rows, own, mass, tokens=4000, shard_tokens=900).flat())
    assert abs(models[0] - models[1]).max() < 1e-6 and abs(models[0] - models[2]).max() < 1e-6
    held = F.col("doc_id") % 3 == 0
    scores = [{r["doc_id"]: r["score"] for r in language_model.score(docs.repartition(n), ~held).collect()} for n in (1, 16)]
    assert all(abs(scores[0][i] - scores[1][i]) < 1e-6 for i in scores[0])


def test_language_model_of_odd_tables(spark, odd):
    rows = language_model.score(odd, F.col("doc_id") != 5).collect()
    assert len(rows) == 7 and sorted(r["n_tokens"] for r in rows) == [1, 1, 1, 4, 61, 61, 40_001]
    assert language_model.score(odd.limit(0), F.lit(True)).count() == 0
    nothing = language_model.score(odd, F.lit(False)).collect()
    assert {(r["base_score"], r["train_tokens"], r["n_known"]) for r in nothing if r["n_tokens"] == 1} == {(0.0, 0, 0)}


def test_sums_by_number():
    import numpy as np

    rng = np.random.default_rng(1)
    rows, at = rng.normal(size=(500, 3)), rng.integers(0, 20, 500)
    expected = np.zeros((25, 3))
    np.add.at(expected, at, rows)
    assert np.allclose(language_model.summed(rows, at, 25), expected)


def test_every_position_is_trained_on():
    texts = [language_model.words_of(pseudo(n, n).encode()) for n in (0, 1, 30, 77)]
    classes = language_model.Classes([b"w0x"])
    target, context, _ = language_model.contexts(texts, classes)
    trained, before = language_model.examples(texts, classes, 5)
    assert len(trained) == sum(len(t) + 1 for t in texts)
    assert sorted([t, *c] for t, c in zip(trained.tolist(), before.tolist(), strict=True)) == sorted(
        [t, *c] for t, c in zip(target.tolist(), context.tolist(), strict=True))


def test_rare_words_are_classed_once_an_ending(monkeypatch):
    found = [f"{i}{e}".encode() for i in range(500) for e in ("ing", "ion", "é")] + [b"x"]
    expected = language_model.class_numbers(found, language_model.Classes([b"the"])).tolist()
    seen, ending_class = [], language_model.ending_class
    monkeypatch.setattr(language_model, "ending_class", lambda e: seen.append(e) or ending_class(e))
    endings = language_model.Endings()
    assert language_model.ending_numbers(found, endings).tolist() == expected
    assert len(seen) == len({w[-3:] for w in found})


@pytest.mark.parametrize("size", [0.1, 30])
def test_class_probabilities_equal_their_formula(size):
    rng = np.random.default_rng(2)
    p = language_model.Parameters.start(rng.random(language_model._CLASSES - 1) + 0.1)
    p.q[:] = rng.normal(0, size, p.q.shape)
    target = rng.integers(0, len(p.q), 300)
    context = rng.integers(0, language_model._CLASSES, (300, language_model.CONTEXT))
    guess = sum(p.r.astype(float)[context[:, k]] * p.c[k] for k in range(language_model.CONTEXT))
    logits = np.clip(guess @ p.q.T.astype(float) + p.b, -60, 60)
    expected = (logits[np.arange(300), target] - np.log(np.exp(logits).sum(axis=1))) / math.log(10)
    assert language_model.class_log10(p, target, context) == pytest.approx(expected, abs=1e-4)


def test_class_probabilities_sum_to_one():
    import numpy as np

    p = language_model.Parameters.start(np.arange(1.0, language_model._CLASSES))
    p.q += 0.3
    target = np.arange(language_model._CLASSES - 1)
    context = np.tile(np.arange(4), (len(target), 1))
    assert (10 ** language_model.class_log10(p, target, context)).sum() == pytest.approx(1, abs=1e-4)


# --- 5 urls -----------------------------------------------------------------

def test_block_decisions_follow_links_and_allow_goes_first(spark):
    pages = [(1, "http://a.net/x", '<link rel="canonical" href="http://b.com/y">'), (2, "http://b.com/y#f", ""),
             (3, "http://c.com/z", "<meta http-equiv=refresh content='0; url=/y2'>"),
             (4, "https://C.com/y2?q=1", '<link href="http://b.com/y" rel=canonical>'), (5, None, None), (6, "nothing", ""),
             (7, "http://www.example.net/en/1", '<link rel=canonical href="http://d.com/1">'), (8, "http://d.com/1", None),
             (9, "http://e.net/1", '<link rel=canonical href="http://d.com/1">'), (10, "http://x.com?a/b", "")]
    found = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge_urls(
        spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert found == {
        1: ("a.net", "/x", "net/", "block"), 2: ("b.com", "/y", None, "block"), 3: ("c.com", "/z", None, "allow"),
        4: ("c.com", "/y2", None, "block"), 5: ("", "", None, "allow"), 6: ("", "", None, "allow"),
        7: ("www.example.net", "/en/1", "example.net/en/", "allow"), 8: ("d.com", "/1", None, "allow"),
        9: ("e.net", "/1", "net/", "block"), 10: ("x.com", "", None, "allow")}


# --- 6 chat -----------------------------------------------------------------

def test_conversations_are_read_back(spark):
    says = "</s>[INST] ok [/INST] [\\INST] <<SYS>> <\\\\s> \n"
    talks = {1: [("system", says), ("user", says), ("assistant", says), ("user", "tail")],
             2: [("assistant", "a"), ("assistant", ""), ("tool[ROLE]", "x</s>")], 3: [("user", None)], None: [(None, "r")]}
    rows = [(c, i, r, t) for c, turns in talks.items() for i, (r, t) in enumerate(turns)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r["conv_id"]: r for r in chat.read_back(chat.examples(table)).collect()}
    for conv, turns in talks.items():
        whole = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
        loss = "".join(t or "" for r, t in turns if r == "assistant")
        assert (found[conv]["n_turns"], found[conv]["turns_sha256"]) == (len(turns), hashlib.sha256(whole.encode()).hexdigest())
        assert (found[conv]["loss_chars"], found[conv]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.examples(table.limit(0)).count() == 0


# --- 8 html -----------------------------------------------------------------

PAGE = """<html><head><title>T &amp; x</title><style>p{}</style></head><body><header>Site name</header>
<nav><ul><li><a href=/>Home</a></li></ul></nav><div class="cookie-notice"><p>We use cookies here</p></div>
<article><h1>A  title</h1><p>First <b>bold&nbsp;text</b> here &amp; there<br>goes<p>Second part
of it.<form><label>Mail</label><input></form></p><aside>See also this</aside><p>Last.</p></article>
<section class="comments"><p>I like it very much indeed</p></section><footer>&copy; all</footer>"""


def test_article_is_found(spark):
    pages = spark.createDataFrame([(1, "u", PAGE), (2, None, None), (3, "v", ""), (4, "w", "a < b <p"),
                                   (5, "x", "<p>only this text</p>")], "page_id long, url string, html string")
    found = {r["page_id"]: (r["text"], r["n_chars"]) for r in html.extract(pages).collect()}
    text = "A title\nFirst bold text here & there goes\nSecond part of it.\nLast."
    assert found[1] == (text, len(text))
    assert found[2] == found[3] == ("", 0)
    assert found[5] == ("only this text", 14)


WEIGHTS = {"p": 3.0, "h1": 3.0, "div": 1.0, "ad": -3.0, "aside": -3.0, "form": -3.0, "comments": -3.0, "sidebar": -3.0}
BODY = "<h1>ten words of a heading that stands before it all</h1>{}<p>" + "body " * 200 + "</p>{}<p>the last words</p>"


@pytest.mark.parametrize("part", ["<div class='ad'>{}</div>", "<aside>{}</aside>", "<form>{}</form>"])
@pytest.mark.parametrize("size", [5, 12, 500])
def test_removable_parts_do_not_part_an_article(part, size):
    long = part.format("<b>spam</b> " * size)
    found = html.main_text(f"<nav>menu here</nav><article>{BODY.format(long, long)}</article><p></p>", WEIGHTS)
    assert found.split("\n") == ["ten words of a heading that stands before it all", ("body " * 200).strip(), "the last words"]


@pytest.mark.parametrize("names", ["class='content with-sidebar'", "class='no-sidebar'", "class='has-comments'",
                                   "id='main-nav-wrapper'"])
@pytest.mark.parametrize("element", ["article", "div"])
def test_wrapper_names_do_not_remove_the_article(names, element):
    side = "<div class='sidebar'>" + "other " * 60 + "</div>"
    page = f"<body><div {names}><{element}>{BODY.format('', '')}</{element}>{side}</div>{side}</body>"
    found = html.main_text(page, WEIGHTS)
    assert found.startswith("ten words") and found.endswith("the last words") and "other" not in found


def test_comments_with_more_words_than_the_article_are_removed():
    page = "<article><p>a short article</p></article><div id='comments'><p>" + "reply " * 90 + "</p></div>"
    assert html.main_text(page, WEIGHTS) == "a short article"


@pytest.mark.parametrize("names", ["form-of-government", "share-market", "adHocRules", "cookie-recipes", "social-history"])
@pytest.mark.parametrize("element", ["article", "div"])
def test_names_with_other_words_are_no_parts(names, element):
    inner = f"<section class='{names}'><p>a paragraph that belongs to it</p></section>"
    page = f"<{element}><p>{'body ' * 20}</p>{inner}<p>the last words</p></{element}>"
    assert html.main_text(page, {}).split("\n")[1:] == ["a paragraph that belongs to it", "the last words"]


@pytest.mark.parametrize("other", [
    "<div class='header'>slogan of the site</div>", "<ul class='commentlist'><li>" + "reply " * 30 + "</li></ul>",
    "<div class='copyright'>by us</div>", "<div id='siteFooter'>by us</div>", "<div class='cookie-box'>accept it</div>",
    "<ul>" + "<li><a href='/x'>another page here</a></li>" * 30 + "</ul>"])
def test_other_parts_of_a_page_without_markup_of_its_content_are_left_out(other):
    body = f"<h1>A heading</h1><p>{'body ' * 40}<a href='/y'>with a link</a></p><p>the last words</p>"
    wanted = f"A heading\n{'body ' * 40}with a link\nthe last words"
    assert html.main_text(f"<body>{other}<div>{body}</div>{other}</body>", {}) == wanted


def test_links_at_the_edges_of_an_article_belong_to_it():
    body = "<ul><li><a href='#a'>first part</a></li></ul><p>some words</p><p><a href='/b'>read on</a></p>"
    found = html.main_text(f"<article>{body}</article>", {"li a": -3.0, "p a": -3.0, "p": 3.0})
    assert found == "first part\nsome words\nread on"


def test_odd_pages_are_extracted_alike(spark):
    long = "<p>" + "some words " * 50_000 + "</p>"
    rows = [(1, "u", long), (1, "u", long), (2, None, "<div class>plain</div>"), (None, None, "<p>no id"), (3, "v", "<<<>")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {"text": F.lit(1), "n_chars": F.lit("x"), "place": F.lit(None)})
    found = sorted((r["page_id"] or 0, r["url"], r["text"]) for r in html.extract(table).collect() if r["page_id"] != 3)
    text = ("some words " * 50_000).strip()
    assert found == [(0, None, "no id"), (1, "u", text), (1, "u", text), (2, None, "plain")]
    assert html.extract(table.limit(0)).count() == 0


def test_best_run():
    assert html.best_run([-1, 2, -1, 3, -5, 4]) == (1, 4)
    assert html.best_run([-1.0, 0.0]) == html.best_run([]) == (0, 0)


@tables
def test_pages_equal_their_articles(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    for r in QUERIES["op8_html_extraction"](spark, SF_DIR).collect():
        article = re.search(r"(?s)<article>(.*)</article>", pages[r["page_id"]])[1].replace("<br>", " ")
        blocks = (re.sub(r"\s+", " ", entities.unescape(re.sub(r"<[^>]*>", "", b))).strip()
                  for b in re.split(r"</?(?:p|h1)>", article))
        assert r["text"] == "\n".join(b for b in blocks if b)


# --- pipeline ---------------------------------------------------------------

@tables
def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    leaks = {r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()}
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, before, SF_DIR), "test-stage").table
        if name != "source mixing":
            assert after.columns == docs.columns and after.count() <= before.count()
        if name == "quality rules":
            good = {r["doc_id"] for r in QUERIES["op10_quality_rules"](spark, SF_DIR).collect() if r["kept"]}
            assert {r["doc_id"] for r in after.collect()} == good
        if name == "line dedup":
            rows = sorted(before.collect(), key=lambda r: r["doc_id"])
            spots = [(r["doc_id"], i, line) for r in rows for i, line in enumerate(r["text"].split("\n"))]
            long = [s for s in spots if len(re.findall(r"[^\W_]+", s[2])) >= lines.MIN_WORDS]
            gone = {s[:2] for s, g in zip(long, grouped_by_brute_force([s[2] for s in long]), strict=True) if g}
            expected = {}
            for i, at, line in spots:
                expected.setdefault(i, []).extend([] if (i, at) in gone else [line])
            found = {r["doc_id"]: r["text"] for r in after.collect()}
            texts = {i: "\n".join(kept) for i, kept in expected.items()}
            assert found == {i: t for i, t in texts.items() if t.strip()}
        if name == "n-gram Jaccard join":
            texts = [r["text"] for r in after.collect()]
            assert [p for _, p in components(texts, 5, 80)] == list(range(len(texts)))
        if name == "benchmark decontamination":
            assert not any(item in r["text"] for r in after.collect() for item in leaks)
        before = after
    assert before.count() > 0 and "epoch" in before.columns


CLASHES = ["txt", "copies", "row", "id", "hash", "__id", "__txt", "judged_at", "quality", "line_dedup", "whole_row",
           "size", "part", "epochs", "key", "a b", "found", "gone", "n_words"]


@tables
@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_of_odd_rows_and_clashing_names(spark, odd, name, stage):
    docs = odd.select("doc_id", "text", "source")
    for number, column in enumerate(CLASHES):
        docs = docs.withColumn(column, F.lit(number))
    found = stage(spark, docs, SF_DIR)
    assert found.columns == [*docs.columns, *(["epoch"] if name == "source mixing" else [])]
    rows = found.collect()
    assert all(r[c] == i for r in rows for i, c in enumerate(CLASHES))
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows)
    if name == "quality rules":
        assert ids == [(False, 4), (False, 4), (False, 5)]
    elif name == "n-gram Jaccard join":
        assert ids == [(False, 1), (False, 2), (False, 4), (False, 5), (False, 6), (True, 0)]
    elif name != "source mixing":
        assert len(ids) == 7 and {r["text"] for r in rows} == {r["text"] for r in docs.collect()}
    assert stage(spark, docs.limit(0), SF_DIR).count() == 0
    if name == "source mixing":
        replaced = stage(spark, docs.withColumn("epoch", F.lit(99)), SF_DIR)
        assert replaced.columns == [*docs.columns, "epoch"] and replaced.filter("epoch = 99").count() == 0
