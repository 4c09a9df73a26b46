import random

import pytest
from pyspark.sql import functions as F

from loquela.llm import truncation as T


@pytest.mark.parametrize(
    ("text", "how"),
    [("Va bene.", "closed"), ("Va bene", "word"), ("Va [...]", "marked"), ("Va…", "ellipsis"), ("Va...", "dots"), ("Va,", "open"), ("per�", "broken"), ("ok 🙂", "closed")],
)
def test_ends(text, how):
    assert T.body(text)[1] == how


def test_hashes_are_of_the_last_characters():
    keys, places, _ = T.context_hashes(["un gatto dorme", "il gatto dorme"])
    n = keys.shape[1] // 2
    assert keys.shape[0] == len(T.ORDERS) and len(places) == 2 * n
    assert (keys[:, n - 1] == keys[:, -1]).all() and keys[2][2] != keys[2][n + 2]
    last, _, _ = T.context_hashes(["un gatto dorme", "", "dorme"], last_only=True)
    assert (last[:, 0] == keys[:, n - 1]).all() and (last[:3, 2] == last[:3, 0]).all() and last[3][2] != last[3][0]


def test_model_counts_ends():
    model = T.EndModel(["La zia dorme. La zia dorme. La zia ride"] * 2 + ["Il pane, la zia"] * 2)
    word, end, *_ = model.final(["la zia dorme", "la zia", "la zi", "xyz"])
    assert word[0] > 0.8 and end[0] > 0.8 and word[1] > 0.8 and end[1] < 0.2 and word[2] < 0.2
    assert word[3] == pytest.approx(model.word_rate) and T.EndModel([]).final(["zia"])[0][0] == pytest.approx(T.EndModel([]).word_rate)


def test_held_out_cuts(spark):
    rng = random.Random(5)
    who, did, what, when = ["la zia", "il nonno", "mia cugina"], ["ha visto", "ha perso", "ha venduto"], ["il pane nero", "la bicicletta vecchia", "il tavolo lungo"], ["ieri", "verso sera", "dopo pranzo"]
    say = lambda: " ".join(map(rng.choice, (who, did, what, when)))
    rows = []
    for i in range(1500):
        marked = i % 3
        parts = [say() for _ in range(rng.randrange(3, 7))]
        text = ". ".join(p.capitalize() for p in parts) + "." if marked else " ".join(parts)
        if i % 10 == 0:
            cut = rng.randrange(30, len(text) - 12)
            while not (text[cut - 1].isalpha() and text[cut].isalpha()):
                cut -= 1
            text = text[:cut]
        rows.append((i, text, "it", "src"))
    rows += [(2000 + i, None, None, None) for i in range(3)] + [(2010, "", "it", "src"), (2011, "  \n", "it", None), (2012, rows[10][1], "IT", None), (2013, "parola " * 60_000 + "fine.", "it", "src")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("token", F.lit("x")).withColumn("id", F.lit("x"))
    got = {r["id"] for r in T.judge_ends(df).filter("truncated").collect()}
    want = {i for i in range(0, 1500, 10)} | {2012}
    assert len(got & want) >= 0.95 * len(want) and len(got - want) <= 0.05 * len(want)
    assert T.judge_ends(df.limit(0)).count() == 0


def test_limits(spark):
    rows = [(i, ("Un testo che finisce bene. " * 20)[: 100 if i % 2 else 27 * (1 + i % 3)].strip() if i % 2 == 0 else ("Parole senza fine e poi ancora " * 9)[:100], "it", "a") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    judged = {r["id"]: r for r in T.judge_ends(df).collect()}
    assert all(judged[i]["at_limit"] == (i % 2 == 1) for i in range(40))
    rates = T.truncation_rates(T.judge_ends(df)).collect()
    assert rates[0]["texts"] == 40


@pytest.mark.parametrize("copies", [5, 400])
def test_copies_of_a_cut_text_do_not_acquit_each_other(spark, copies):
    rng = random.Random(7)
    nouns, ends = ["il pane nero", "la bicicletta vecchia", "il tavolo lungo", "un quaderno a righe"], ["ieri", "verso sera", "dopo pranzo", "prima di partire"]
    say = lambda: f"{rng.choice(['La zia', 'Il nonno', 'Mia cugina'])} ha visto {rng.choice(nouns)} {rng.choice(ends)}."
    rows = [(i, " ".join(say() for _ in range(rng.randrange(3, 7))), "it", "a") for i in range(400)]
    rows += [(500 + i, f"Foglio {i}. {say()} detto da tutti noi", "it", "a") for i in range(12)]  # an end of its own
    cut = say() + " La zia ha visto il tavolo lungo e poi anche una bicicletta"
    rows += [(1000 + i, cut if i % 2 else cut.replace(" ", "  "), "it", "a") for i in range(copies)]
    rows += [(2000 + i, "Mia cugina ha visto. " * 45 + "La zia ha visto il pane nero e il", "it", "b") for i in range(copies)]  # at the limit of its source
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["id"] for r in T.judge_ends(df).filter("truncated").collect()}
    assert got == {1000 + i for i in range(copies)} | {2000 + i for i in range(copies)}


def test_distinct_texts_cut_at_their_limit_alike(spark):
    rows = [(i, f"Foglio {i:02d}. La zia ha visto il pane nero e poi anche una bicicletta", "it", "a") for i in range(10)]
    rows += [(20 + i, "Va tutto bene. " * (1 + i % 2), "it", "a") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert {r["id"] for r in T.judge_ends(df).filter("truncated").collect()} == set(range(10))


def test_the_model_decides(spark):
    rng = random.Random(11)
    what, when = ["il pane nero", "la bicicletta vecchia", "il tavolo lungo", "un quaderno a righe"], ["ieri", "verso sera", "dopo pranzo", "prima di partire"]
    say = lambda: f"{rng.choice(['la zia', 'il nonno', 'mia cugina'])} ha visto {rng.choice(what)} {rng.choice(when)}"
    rows = [(i, " ".join(say().capitalize() + "." for _ in range(rng.randrange(3, 7))), "it", "a") for i in range(400)]
    rows += [(1000 + i, " ".join(say() for _ in range(rng.randrange(3, 7))), "it", "b") for i in range(400)]  # sentences without marks
    cuts = {1000 + i for i in range(0, 400, 10)}
    for i, (key, text, *rest) in enumerate(rows):
        if key in cuts:
            rows[i] = (key, text[: text.rindex(" ", 0, -25) - 2], *rest)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = lambda model: {r["id"] for r in T.judge_ends(df, model=model).filter("truncated").collect()}
    got = found(None)
    assert len(got & cuts) >= 0.9 * len(cuts) and len(got - cuts) <= 0.05 * len(cuts)
    # A model of no contexts gives every end the same probabilities.
    assert len(found(T.EndModel([])) & cuts) < 0.5 * len(cuts)


def test_all_texts_count(spark):
    rows = [(i, f"La zia {chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)} dorme. Il nonno ride e poi torna.", "it", "a") for i in range(9000)] + [(9001, "La zia dorme. Il nonno rid", "it", "a")]
    df = spark.createDataFrame(rows + rows[:50], "doc_id long, text string, lang string, source string")
    asked = df.filter("doc_id >= 9000").select(F.col("doc_id").alias("id"), *(F.lit(0).cast(t).alias(c) for c, t in (("folded", "long"), ("source", "string"), ("lang", "string"), ("style", "string"), ("chars", "int"), ("bytes", "int"), ("blank_tail", "boolean"))), F.col("text").alias("tail"))
    ends, rate, texts = T.counted_ends(df.select("text"), asked.mapInArrow(T._ends, T._END_SCHEMA))
    got, model = ends.collect(), T.EndModel([t for _, t, *_ in rows])
    word, end, short, long, *_ = model.final([T.stream("La zia dorme. Il nonno rid")[0]])
    assert texts == 9001 and rate == pytest.approx(model.end_rate)  # the sample ended at 8,000
    assert [got[0][c] for c in ("p_word", "p_end", "short_times", "long_times")] == pytest.approx([word[0], end[0], short[0], long[0]], rel=1e-4)
    assert got[0]["short_times"] == 9000
