import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from loquela.functions.voices import bare_text, head_label, label_key
from loquela.llm import turns
from loquela.llm.boosting import BoostedTrees

SEG = "segment_id long, stem string, idx int, speaker string, text string, start_sec double, end_sec double"
MAP = "stem string, local_label string, global_id string"


@pytest.mark.parametrize(
    ("label", "want"),
    [("GLOBAL_00000062", "GLOBAL_00000062"), ("G00000062", "GLOBAL_00000062"), (" global_64 ", "GLOBAL_00000064"), ("Global 7", "GLOBAL_00000007"), ("spk5", "SPEAKER_05"), ("S02", "SPEAKER_02"), ("Speaker 10", "SPEAKER_10"), ("unknown", None), ("", None), (None, None)],
)
def test_labels(label, want):
    assert label_key(label) == want


@pytest.mark.parametrize(
    ("text", "head", "bare"),
    [
        ("[SPEAKER_03] Ho buttato [19:33] il pane (ride)", "SPEAKER_03", "Ho buttato il pane"),
        ("[22m20s] >> GLOBAL_00000112: Per fortuna", "GLOBAL_00000112", "Per fortuna"),
        ("00:32:14.321 Speaker 2 - Ci vediamo alle 17:30 vicino", "SPEAKER_02", "Ci vediamo alle 17:30 vicino"),
        ("GLOBAL_00000145> 05:35 - Ciao", "GLOBAL_00000145", "Ciao"),
        ("[applausi] SPEAKER_01: *sospira* {rumore di fondo} ♪♪ sì", "SPEAKER_01", "sì"),
        ("Ne servono 6", None, "Ne servono 6"),
        (None, None, None),
    ],
)
def test_heads(text, head, bare):
    assert head_label(text) == head
    if text:
        assert " ".join(bare_text(text).split()) == bare


#: A corpus in which hesitations stand between any two words; "e" and "ma" join, "cioè" opens, "mancava" has one place.
def _corpus(n=2500, seed=3):
    rng = random.Random(seed)
    who, did, what = ["la zia", "il nonno", "mia cugina", "mio zio"], ["ha visto", "ha perso", "ha venduto", "mi ha chiesto"], ["il pane nero", "la bicicletta", "il tavolo lungo", "me"]
    out = []
    for _ in range(n):
        words = f"{rng.choice(['cioè, ', '', ''])}{rng.choice(who)} {rng.choice(did)} {rng.choice(what)} {rng.choice(['e', 'ma'])} {rng.choice(who)} {rng.choice(did)} {rng.choice(what)} perché mancava la luce.".split()
        for _ in range(rng.randrange(3)):
            words.insert(rng.randrange(1, len(words)), rng.choice(["ehm,", "Mmm", "uhm...", "ah", "mh,", "eeh"]))
        out.append(" ".join(words))
    return out


def test_the_corpus_tells_hesitations():
    found = {t for t, yes in turns.hesitation_examples(_corpus()).items() if yes}
    assert found >= {"ehm", "mmm", "uhm", "ah", "mh", "eeh"} and not found & {"e", "ma", "cioè", "mancava", "ha", "mi", "me", "mia"}


def test_letters_of_unseen_tokens():
    speech = turns.Speech(turns.token_model(_corpus()))
    assert speech.words("Ehm, allora eehm... cioè mmmh ho MHM. visto - 6, me") == ["allora", "cioè", "ho", "visto", "6,", "me"]
    assert speech.words(None) == [] and speech.words("") == [] and speech.words("♪♪ Mmm.") == []
    assert not [w for w in ("hai", "mai", "mamma", "io", "e", "uomo", "sì", "bene") if speech.is_filler(w)]
    none = turns.Speech(BoostedTrees(bias=-1.0))
    assert none.words("Ehm, allora") == ["Ehm,", "allora"]


def test_boosting_column_is_score(spark):
    rng = np.random.default_rng(0)
    x = rng.random((400, 2))
    model = BoostedTrees(rounds=6).fit(x, (x[:, 0] > 0.5) ^ (x[:, 1] > 0.3))
    assert ((model.score(x) > 0) == ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3))).mean() > 0.95
    df = spark.createDataFrame(x[:50].tolist(), "a double, b double")
    assert np.allclose([r[0] for r in df.select(model.column([F.col("a"), F.col("b")])).collect()], model.score(x[:50]))
    assert BoostedTrees().fit(np.zeros((0, 2)), np.zeros(0)).trees == []


def test_turns(spark):
    rows = [
        (1, "s", 0, "SPEAKER_00", "Ciao a tutti", 0.0, 1.0),
        (2, "s", 2, "spk1", "ehm, bene", 5.0, 6.0),
        (3, "s", 1, "GLOBAL_9", "come va", 2.0, 3.0),
        (4, "s", 1, "GLOBAL_9", "come va", 2.0, 3.0),
        (5, "s", 3, None, "[SPEAKER_01] 01:02 - sì", 7.0, 8.0),
        (6, "s", 4, "boh", "grazie", 9.0, 10.0),
        (7, "s", 5, "SPEAKER_00", "Mmm.", 11.0, 12.0),
        (8, "s", 6, "SPEAKER_00", "senza tempo", None, None),
        (9, "s", 7, "SPEAKER_00", None, 12.0, 13.0),
        (10, "t", 0, "SPEAKER_00", "x" * 100_000, 1.0, 2.0),
    ]
    smap = [("s", "SPEAKER_00", "GLOBAL_00000009"), ("s", "SPEAKER_00", "GLOBAL_00000009"), ("s", "SPEAKER_01", "GLOBAL_00000004")]
    df, m = spark.createDataFrame(rows, SEG).withColumn("voice", F.lit("x")).withColumn("words", F.lit(1)), spark.createDataFrame(smap, MAP)
    got = sorted(tuple(r) for r in turns.speaker_turns(df, m).select("stem", "speaker", "first_idx", "last_idx", "n_words").collect())
    assert got == [("s", "GLOBAL_00000004", 2, 3, 2), ("s", "GLOBAL_00000009", 0, 1, 5), ("s", "UNKNOWN", 4, 4, 1), ("t", "UNKNOWN", 0, 0, 1)]
    text = turns.speaker_turns(df, m, with_text=True).filter("first_idx = 0 and stem = 's'").first()["text"]
    assert text == "Ciao a tutti come va" and re.search("ehm", text) is None
    assert turns.speaker_turns(df.limit(0), m.limit(0)).count() == 0


def _talk(spark, sessions=40):
    rng = random.Random(9)
    segs, smap = [], []
    for s in range(sessions):
        smap += [(f"s{s}", f"SPEAKER_{v:02d}", f"GLOBAL_{10 * s + v:08d}") for v in range(3)]
        v = 0
        for i in range(20):
            v = rng.randrange(3) if rng.random() < 0.3 else v
            name, place = rng.choice([f"SPEAKER_{v:02d}", f"spk{v}", f"GLOBAL_{10 * s + v:08d}"]), rng.random()
            text = rng.choice(_TEXTS)
            segs.append((20 * s + i, f"s{s}", i, name if place < 0.8 else None, text if place < 0.7 or place > 0.95 else f"{name}: {text}", 10.0 * i, 10.0 * i + 8))
    return spark.createDataFrame(segs, SEG), spark.createDataFrame(smap, MAP)


_TEXTS = _corpus(60)


def test_the_boundary_model_decides(spark):
    df, m = _talk(spark)
    rows = lambda models: {tuple(r) for r in turns.speaker_turns(df, m, models).collect()}
    tokens, boundaries = turns.fit_models(df, m)
    cleaned = turns.clean_segments(df, m, tokens).orderBy("stem", "start_sec").toPandas()
    run = ((cleaned["stem"] != cleaned["stem"].shift()) | (cleaned["voice"] != cleaned["voice"].shift())).cumsum()
    grouped = cleaned.groupby(run).agg(stem=("stem", "first"), speaker=("voice", "first"), a=("idx", "first"), b=("idx", "last"), n=("n_words", "sum"))
    want = {tuple(r) for r in grouped.itertuples(index=False)}
    got = rows((tokens, boundaries))
    assert len(got & want) >= 0.99 * len(want) and len(got - want) <= 0.01 * len(got)
    for constant in (BoostedTrees(bias=5.0), BoostedTrees(bias=-5.0)):
        assert len(rows((tokens, constant)) & want) < 0.5 * len(want)
    assert len(rows((BoostedTrees(bias=-5.0), boundaries)) & want) < 0.5 * len(want)
