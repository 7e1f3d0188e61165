from __future__ import annotations

import re

from pyspark.sql import functions as F

from roomledger.llm import decontamination as D
from tests.llm.cases import empty, messy

SF = "/root/testdata/sf0.01"
ITEM = "Then Anna has 12 apples and gives 5 km to Berta before the long trip home today. So Anna keeps 12."


def leaks(spark, texts, items=((7, ITEM),)):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {(r.doc_id, r.item_id) for r in D.contaminated(docs, spark.createDataFrame(list(items), "item_id long, text string")).collect()}


def test_templates(spark):
    row = spark.createDataFrame([("Well, Anna paid 1,250.5 km to San Juan. Then THE end 7%",)], "text string")
    words = row.select(D.template_words(F.col("text"), True).alias("v"), D.template_words(F.col("text")).alias("w")).first()
    assert words.v == ["well", "ⓐanna", "paid", "ⓝ1250ⓓ5", "ⓤkm", "to", "ⓐsan", "ⓐjuan", "then", "the", "end", "ⓝ7", "ⓤ"]
    assert words.w == [re.sub("^([ⓐⓝⓤ]).*", r"\1", w) for w in words.v]


def test_templates_of_mixed_case_names(spark):
    texts = ["eats at McDonald today", "on YouTube, LinkedIn and GitHub; a PhD there", "the Covid19a wave of 5 Ab²c", "in İstanbul near O'Neill",
             "a sign ⓐnna and Ⓝine ⓤ of 3 km", "von MacBook-Pro zu iPhone", "by Zu\u0308rich"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in rows.select("text", D.template_words(F.col("text")).alias("w"), F.transform(D.template_words(F.col("text"), True), D.kind_of).alias("k")).collect():
        assert r.w == r.k, r.text
    item = "Once more the McDonald costs were too high"
    assert leaks(spark, ["They said: once more the McDonald costs were too high.", "once more the YouTube costs were too high"], [(1, item)]) == {(0, 1), (1, 1)}


def test_questions_with_other_names_and_numbers_are_found(spark):
    other = ITEM.replace("Anna", "Carla").replace("Berta", "Doris").replace("12", "30").replace(" 5 ", " 7 ")
    texts = [ITEM, "before it. " + other + " after it", other.replace("keeps 30", "keeps 31").replace("So Carla", "So Emma"),
             "words of no meaning at all that go on and on without any likeness to it", "Anna has 12 apples.", None, ""]
    assert leaks(spark, texts) == {(0, 7), (1, 7)}


def test_any_agreeing_alignment_holds_an_item(spark):
    other = ITEM.replace("Anna", "Carla").replace("Berta", "Doris").replace("12", "30").replace(" 5 ", " 7 ")
    wrong = other.replace("keeps 30", "keeps 31").replace("So Carla", "So Emma")
    part = "and gives 7 km to Doris before the long trip home today. So Carla keeps 30."
    texts = [f"{wrong} And now {other}", f"{wrong} And now {wrong}", f"{wrong} And now {part}", f"{part} And now {wrong}"]
    assert leaks(spark, texts) == {(0, 7), (2, 7), (3, 7)}


def test_all_planted_passages_and_nothing_else(spark):
    docs, benchmark = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    bare = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    texts = {r.doc_id: bare(r.text) for r in docs.collect()}
    want = {(d, r.item_id) for r in benchmark.collect() for d, t in texts.items() if bare(r.text) in t}
    found = {(r.doc_id, r.item_id) for r in D.contaminated(docs, benchmark).collect()}
    assert len(want) > 20 and found == want
    left = D.remove_contaminated(docs, benchmark)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == set(texts) - {d for d, _ in want}


def test_copies_of_items_with_few_literal_words_are_found(spark):
    items = ["What is 12 plus 15?", "Who wrote Hamlet?", "Add 3 km, 5 km, 7 km and 9 km to 11 km.", "Where did Anna Berta Carla Doris meet?", "Why?"]
    texts = [f"Here it goes, Question: {t} Then the answer." for t in items]
    others = ["Who wrote Faust? Where did Emma Berta Carla meet?", "12 plus", "What is 12 plus", ""]
    assert leaks(spark, texts + others, list(enumerate(items))) == {(i, i) for i in range(len(items))}
    # Items of one id, or without one, are judged one by one.
    assert leaks(spark, texts, [(None, items[0]), (None, items[2]), (1, items[1]), (1, items[1]), (1, items[3])]) == {(0, None), (2, None), (1, 1), (3, 1)}


BAKER = "A baker sells 12 loaves for 3 dollars each, 5 cakes for 20 dollars each and 40 rolls for 1 dollar each. How many dollars in all?"


def test_short_and_dense_questions_with_other_values_are_found(spark):
    items = [(0, "What is 12 plus 15?"), (1, "Add 3 km, 5 km, 7 km and 9 km to 11 km."), (2, BAKER), (3, "Pay 3.5 or 35 or 3.5 now")]
    texts = [
        "So it goes. What is 13 plus 99? Say.", "what is 13 plus 13", "Add 4 km, 6 km, 8 km and 10 km to 12 km.", "Add 4 km, 6 km, 8 km and 8 km to 12 km.",
        BAKER.replace("12", "14").replace("40", "60").replace(" 5 ", " 9 "), "They say: pay 7 or 2.5 or 7 now", "They say: pay 7 or 7 or 7 now",
    ]
    assert leaks(spark, texts, items) == {(0, 0), (2, 1), (4, 2), (5, 3)}


def test_chance_likenesses_are_left_alone(spark):
    texts = [
        "Tickets to the museum and a meal were bought by two friends for 41 dollars. How many dollars in all?",
        "At the zoo a family bought 3 tickets and some cakes for 7 dollars. How many dollars in all?",
        "3 4 5 6 7 8 9 10 11 12 km 13 km 14 km and 15 km", "what is 12 of the plus 15",
    ]
    assert leaks(spark, texts, [(0, BAKER), (1, "Add 3 km, 5 km, 7 km and 9 km to 11 km."), (2, "What is 12 plus 15?")]) == set()


def test_an_excerpt_of_a_long_item_is_found_by_its_run(spark):
    words = [f"w{chr(97 + i // 8)}{chr(97 + i % 8)}" for i in range(59)]
    texts = ["so " + " ".join(words[k : k + n]) + " it goes" for k, n in ((20, 26), (0, 13), (46, 13), (20, 12))]
    scattered = " and ".join(" ".join(words[k : k + 7]) for k in (0, 10, 20, 30, 40))
    assert leaks(spark, [*texts, scattered], [(1, " ".join(words))]) == {(0, 1), (1, 1), (2, 1)}


def test_texts_of_one_id_are_judged_one_by_one(spark):
    other = ITEM.replace("Anna", "Carla").replace("Berta", "Doris").replace("12", "30").replace(" 5 ", " 7 ")
    more = ["a wholly different text with the same id and many more words in it " * 3, "and yet another text of the id that has its own words"]
    for name in (7, None):
        assert leaks(spark, [other], [(name, ITEM), *[(name, t) for t in more]]) == {(0, name)}


def test_figures_are_of_the_template_where_it_is_held(spark):
    docs = spark.createDataFrame([(0, ITEM), (0, ITEM), (1, "What is 12 plus 15?")], "doc_id long, text string")
    items = spark.createDataFrame([(7, ITEM), (8, "what is 12 plus 15")], "item_id long, text string")
    rows = {r.doc_id: (r.item_id, r.n_matched, r.n_windows, r.covered) for r in D.contaminated(docs, items).collect()}
    n = rows[0][2]
    assert rows == {0: (7, n, n, 1.0), 1: (8, 1, 1, 1.0)}


def test_short_items_and_messy_rows(spark):
    short = "one two three four"
    assert leaks(spark, ["zero one two three four five", "one two four"], [(1, short), (2, None), (3, ""), (4, "...")]) == {(0, 1)}
    items = spark.createDataFrame([(1, "three four five six seven eight nine"), (None, "a text without an id that has a few words")], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in D.contaminated(messy(spark), items).collect()}
    assert found == {(1, 1), (2, 1), (None, None)}
    left = D.remove_contaminated(messy(spark), items)
    assert left.columns == messy(spark).columns and left.count() == messy(spark).count() - 4
    none = items.limit(0)
    assert D.contaminated(messy(spark), none).count() == 0 and D.contaminated(empty(spark), items).count() == 0
    assert D.remove_contaminated(messy(spark), none).count() == messy(spark).count()


def test_the_main_path_runs_no_python(spark):
    docs, benchmark = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    plan = D.contaminated(docs, benchmark)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|InArrow", plan)
