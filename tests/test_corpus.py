import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loquela.functions import text as T
from loquela.operators import alignment, corpus, identity, publish, quality, ranges, sequence
from loquela.sources import files


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("f", "value", "want"),
    [
        (T.words_letters, "C'è, l'Università!", ["c", "è", "l", "università"]),
        (T.words_alnum, "C'è, l'Università 2!", ["c", "è", "l", "università", "2"]),
        (T.index_word, " «Oggi», ", "oggi"),
        (T.correction_word, "l'al.tro!", "laltro"),
        (T.keep_two_repeats, "Sì. sì. Sì. No.", "Sì. sì. No."),
        (T.sentences, "Io vado. Tu vieni? ...", ["Io vado.", " Tu vieni?"]),
    ],
)
def test_text(spark, f, value, want):
    assert one(spark, f(F.col("x")), value) == want
    one(spark, f(F.col("x")), None)
    one(spark, f(F.col("x")), "")


def test_times(spark):
    assert one(spark, T.hms(F.col("x")), 88260.0, "double") == "24:31:00"
    assert one(spark, T.srt_time(F.col("x")), 59.9996, "double") == "00:01:00,000"
    assert one(spark, T.dotted(F.col("x")), 1234567, "long") == "1.234.567"
    assert one(spark, T.recording_time(F.col("x")), "R2025-10-05_09-39-09.WAV").isoformat() == "2025-10-05T09:39:09"
    names = {"20251005_093909": "2025-10-05T09:39:09", "REC 05-10-2025 09.39.09.wav": "2025-10-05T09:39:09", "05102025-093909.wav": "2025-10-05T09:39:09", "202510050939": "2025-10-05T09:39:00", "00000101_000000": None, "20251331_093909": None, "R2025-10-05-09-39-09.WAV": None, "untitled.mp3": None}
    df = spark.createDataFrame(list(names.items()), "x string, want string")
    got = {x["x"]: x["at"] for x in df.select("x", T.recording_time(F.col("x")).alias("at")).collect()}
    assert {k: v and v.isoformat() for k, v in got.items()} == names
    assert one(spark, T.srt_time_cut(F.col("x")), 59.9996, "double") == "00:00:59,999"
    assert one(spark, F.array_join(T.index_words(F.col("x")), "|"), "Oggi, l'altro «2» — …sì!") == "oggi|l'altro|2|sì"
    assert one(spark, F.from_json(T.salvaged_object(F.col("x")), "a array<int>")["a"], 'Ecco ```json {"a": [1, 2,], } ``` ok') == [1, 2]
    assert one(spark, T.salvaged_object(F.col("x")), "niente") is None


def test_blocks_and_conversations(spark):
    rows = [(1, 0.0, 3600.0), (2, 3720.0, 7320.0), (3, 8400.0, 9000.0), (4, 9300.0, 9400.0)]
    df = spark.createDataFrame(rows, "id long, a double, b double").withColumn("k", F.lit(1))
    assert [r["block"] for r in sequence.blocks_by_gap(df, ["k"], "a", "b", 300, "id").orderBy("id").collect()] == [1, 1, 2, 2]
    turns = spark.createDataFrame([(1, 0.0, 100.0), (2, 10.0, 20.0), (3, 159.9, 160.0), (4, 220.0, 230.0)], "id long, a double, b double").withColumn("k", F.lit(1))
    assert [r["conversation"] for r in sequence.conversations(turns, ["k"], "a", "b", 60, "id").orderBy("id").collect()] == [1, 1, 1, 2]


def test_moving_vocabulary(spark):
    same = [("a", i, "x") for i in range(60)] + [("b", i, f"w{i}") for i in range(60)] + [("c", i, "x") for i in range(10)]
    got = {r["k"]: r["mattr"] for r in sequence.moving_type_token_ratio(spark.createDataFrame(same, "k string, i int, w string"), ["k"], ["i"], "w").collect()}
    assert got == {"a": 0.02, "b": 1.0, "c": None}


def test_range_joins(spark):
    p = spark.createDataFrame([(1, 5.0), (1, 10.0), (1, 95.0)], "k int, at double")
    i = spark.createDataFrame([(1, 0.0, 10.0, "a"), (1, 90.0, 200.0, "b")], "k int, s double, e double, v string")
    got = sorted((r["at"], r["v"]) for r in ranges.points_in_intervals(p, i, ["k"], "at", "s", "e", 30.0).collect())
    assert got == [(5.0, "a"), (10.0, "a"), (95.0, "b")]
    assert ranges.points_in_intervals(p, i, ["k"], "at", "s", "e", 30.0, closed=False, how="left_anti").count() == 1


def test_quality_rules(spark):
    def judge(text, seconds, prob=None, probs=None):
        df = spark.createDataFrame([(text, seconds, prob, probs)], "t string, s double, n double, p array<double>")
        r = df.select(quality.reasons(F.col("t"), F.col("s"), F.col("n"), F.coalesce("p", F.array().cast("array<double>"))).alias("r"))
        return tuple(r.select(F.array_join("r", ";"), quality.level(F.col("r"))).first())

    assert judge("no no no no no no no", 3.0) == ("ripetizione_n3", "unreliable")
    assert judge("che dice che dice che cosa dice", 3.0) == ("", "ok")
    assert judge("", 3.0) == ("testo_vuoto", "unreliable") and judge(None, 3.0)[1] == "unreliable"
    assert judge("va bene", 1.0) == ("pochi_parole:2", "low")
    assert judge("uno due tre quattro", 0.4)[0] == "ritmo_fuori_scala:10.0wps"
    assert judge("uno due tre quattro", 2.0, 0.6)[0] == "no_speech:0.6"
    assert judge("uno due tre quattro", 2.0, 0.1, [0.1, 0.9, 0.9, 0.9]) == ("troppe_parole_insicure:25%", "low")
    assert judge("uno due tre quattro", 2.0, 0.1, [0.3, 0.2, 0.3, 0.3]) == ("prob_parole_bassa:0.28;troppe_parole_insicure:100%", "low")
    assert judge("Grazie per la visione!", 3.0)[0] == "allucinazione_tipica" and judge("Sottotitoli a cura di tutti noi", 3.0)[1] == "unreliable"
    assert judge("Grazie a tutti.", 2.0) == ("", "ok") and judge("Grazie a tutti.", 6.0)[0] == "allucinazione_tipica" and judge("Grazie mille", 1.0, None, [0.7, 0.6])[0] == "pochi_parole:2;allucinazione_tipica"
    assert judge("Frasi brevi, punteggiatura completa e poi", 3.0)[0] == "prompt_nel_testo"


def test_word_errors(spark):
    assert alignment.error_counts("oggi andiamo al mare va bene".split(), "oggi andiamo a mare va bene grazie".split()) == (1, 0, 1, 5)
    df = spark.createDataFrame([(["a", "b"], ["a"]), ([], []), (None, ["x"])], "r array<string>, h array<string>")
    assert [r["wer"] for r in df.select(alignment.word_errors(F.col("r"), F.col("h")).alias("e")).select("e.*").collect()][:2] == [0.5, None]


def test_alignment():
    assert alignment.align_probabilities(["c'è", "pane"], [("c", 0.9), ("'è", 0.5), ("pane", 0.8)]) == [0.5, 0.8]
    assert alignment.align_probabilities(["il", "zzz", "c'è", "", "pane"], [("il", 0.9), ("c", None), ("'è", 0.5), ("pane", None)]) == [0.9, None, 0.5, None, None]
    assert alignment.align_probabilities(["a"], []) == [None]
    spoken = [("ciao", "A", 0.0), ("come", "A", 0.4), ("stai", "A", 0.8), ("bene", "B", 2.0), ("grazie", "B", 2.4)]
    assert alignment.turn_split("Ciao come stai bene grazie".split(), spoken) == [(0, 3, "A", 0.0), (3, 5, "B", 2.0)]
    assert alignment.turn_split([], spoken) == [] and alignment.turn_split(["a"], []) == [(0, 1, "UNKNOWN", None)]
    lone = [("ciao", "B"), ("come", "A"), ("stai", "A"), ("oggi", "B"), ("qui", "A"), ("bene", "B"), ("grazie", "B")]
    assert alignment.turn_split("Ciao come stai oggi qui bene grazie".split(), lone) == [(0, 5, "A", None), (5, 7, "B", None)]
    assert alignment.turn_split("Ciao carissimo come bene molte grazie".split(), spoken) == [(0, 3, "A", 0.0), (3, 6, "B", 2.0)]


def test_edit_alignment_against_brute_force():
    rng = random.Random(2)
    for _ in range(60):
        a, b = ([rng.choice("xyz") for _ in range(rng.randrange(7))] for _ in range(2))
        cost = {}
        for i in range(len(a) + 1):
            for j in range(len(b) + 1):
                ways = [cost[i - 1, j - 1] + (a[i - 1] != b[j - 1])] if i and j else []
                cost[i, j] = min(ways + ([cost[i - 1, j] + 1] if i else []) + ([cost[i, j - 1] + 1] if j else []), default=0)
        pairs = alignment.edit_alignment(a, b)
        assert [i for i, _ in pairs if i is not None] == list(range(len(a))) and [j for _, j in pairs if j is not None] == list(range(len(b)))
        assert sum(i is None or j is None or a[i] != b[j] for i, j in pairs) == cost[len(a), len(b)]
    assert alignment.edit_alignment(["a", "b"], ["b"]) == [(0, None), (1, 0)] and alignment.edit_alignment(["a", "a"], ["a"]) == [(0, None), (1, 0)]


def test_session_folds(spark):
    rows = [(i, "s", i, "parola " * n if n else t, float(30 * i), float(30 * i + d)) for i, (n, t, d) in enumerate([(500, "", 5), (300, "", 5), (1, "", 70), (0, "  ", 5), (900, "", 5), (0, None, 5)])]
    df = spark.createDataFrame([*rows, (99, "s", 0, "doppio", None, None)], "segment_id long, stem string, idx int, text string, start_sec double, end_sec double").withColumn("part", F.lit(0))
    assert [tuple(r) for r in corpus.llm_parts(df, 800).orderBy("part").collect()] == [("s", 0, 0, 1, 800), ("s", 1, 2, 2, 1), ("s", 2, 4, 4, 900)]
    got = [tuple(r)[1:] for r in corpus.pack_by_time(df, 35.5).orderBy("chunk").collect()]
    assert got == [(0, 0.0, 35.0, 2), (1, 60.0, 95.5, 1), (2, 95.5, 130.0, 1), (3, 90.0, 125.0, 2), (4, 150.0, 155.0, 1)]
    assert corpus.llm_parts(df.limit(0), 800).count() == 0 and corpus.pack_by_time(df.limit(0), 29.0).count() == 0


def test_names_of_several_words(spark):
    docs = spark.createDataFrame([(1, "Ieri Anna Maria Rossi, qui"), (2, "anna e maria rossi"), (3, None), (4, "")], "k int, t string")
    names = spark.createDataFrame([("Anna Maria",), ("rossi",), (None,), (" ",)], "n string")
    assert {tuple(r) for r in publish.names_in_texts(docs, "k", "t", names, "n").collect()} == {(1, "anna maria"), (1, "rossi"), (2, "rossi")}


@pytest.mark.parametrize("broadcast_chars", [publish.BROADCAST_CHARS, 0])
def test_names_meet_texts_as_whole_names(spark, broadcast_chars):
    docs = spark.createDataFrame([(1, "Voce Anna, voce anna rossi."), (1, "voce Anna"), (2, "voce di Rossi"), (3, None), (4, "!"), (None, "rossi")], "k long, t string")
    names = spark.createDataFrame([("Voce Anna",), ("voce anna rossi",), ("rossi",), *((f"voce {chr(97 + i // 26)}{chr(97 + i % 26)}",) for i in range(600))], "n string")
    held = publish.names_in_texts(docs, "k", "t", names, "n", broadcast_chars)
    assert sorted(map(tuple, held.filter("k is not null").collect())) == [(1, "rossi"), (1, "voce anna"), (1, "voce anna rossi"), (2, "rossi"), (2, "voce di")]
    assert [tuple(r) for r in held.filter("k is null").collect()] == [(None, "rossi")]
    long = spark.createDataFrame([(1, " ".join(chr(97 + i % 26) * (i // 26 + 1) for i in range(2000)))], "k long, t string")
    runs = publish.word_runs(long, "k", "t", [1, 3, 5000])
    assert runs.columns == ["k", "name"] and runs.count() == 2000 + 1998  # no copy of the text, nor runs of words longer than it
    assert publish.names_in_texts(docs, "k", "t", names.limit(0), "n", broadcast_chars).count() == 0


def test_guard(spark):
    df = spark.createDataFrame([("matiala", "materia", 0.3), ("anna", "Anna", 0.3), ("pane", "pan", 0.95), ("pane", "", 0.1), ("casa", "zebre", 0.1)], "a string, b string, p double")
    assert [r["blocked"] for r in alignment.guard(df, "a", "b", "p").collect()] == [None, "name", "certain", "shape", "distance"]


def test_publish(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, c string")
    new = spark.createDataFrame([(2, "B"), (3, None), (4, "d")], "k int, c string")
    assert {tuple(r) for r in publish.changes(old, new, "k", "c").collect()} == {(1, "delete"), (2, "update"), (4, "insert")}
    docs = spark.createDataFrame([(1, "Ieri Mario, ieri."), (2, None), (3, "")], "k int, t string")
    got = {r["k"]: r["t"] for r in publish.anonymise(docs, "k", "t", publish.lower_vocabulary(docs, "t")).collect()}
    assert got[1] == "Ieri M., ieri."


def test_identity(spark):
    df = spark.createDataFrame([("a", [1.0, 0.0], 3.0), ("a", [0.0, 1.0], 1.0), ("b", [1.0, 1.0], 1.0)], "g string, v array<double>, w double")
    c = identity.weighted_centroids(df, "g", "v", F.col("w"))
    assert {r["g"]: r["centroid"] for r in c.collect()} == {"a": [0.75, 0.25], "b": [1.0, 1.0]}
    assert identity.centroid_pairs(c, "g").count() == 1
    edges = spark.createDataFrame([("x", "y"), ("y", "z"), ("p", "p")], "alias string, target string")
    assert {tuple(r) for r in identity.resolve_aliases(edges).collect()} == {("x", "z"), ("y", "z"), ("p", "p")}
    rows = [("s", "big", 500.0, [1.0, 0.0]), ("s", "weak", 10.0, [0.9, 0.1]), ("s", "far", 10.0, [0.0, 1.0])]
    merged = identity.merge_weak_clusters(spark.createDataFrame(rows, "stem string, label string, seconds double, embedding array<double>"))
    assert {r["label"]: r["target"] for r in merged.collect()} == {"big": "big", "weak": "big", "far": "far"}


def test_files(spark, tmp_path):
    doc = '{"meta": {"stem": null}, "segments": [{"idx": 0, "text": "ciao", "prosody": {"f0_mean_hz": 130.0}}, {"idx": 1, "text": "ehi"}]}'
    (tmp_path / "s1").mkdir()
    (tmp_path / "s1" / "transcript.json").write_text(doc)
    d = files.session_documents(spark, str(tmp_path / "*" / "transcript.json"))
    rows = files.document_segments(d).orderBy("idx").collect()
    assert [(r["stem"], r["f0_mean_hz"], r["shimmer_local"]) for r in rows] == [("s1", 130.0, None), ("s1", None, None)]
    (tmp_path / "x.jsonl").write_text('{"a": 1}\nbroken\n{"a": 2}\n')
    assert files.json_lines(spark, str(tmp_path / "x.jsonl"), "a int").count() == 2
    with pytest.raises(Exception):
        files.json_lines(spark, str(tmp_path / "x.jsonl"), "a int", strict=True).collect()
    (tmp_path / "g.txt").write_text("uno # nota\n\n# solo nota\ndue\n")
    assert {r["entry"] for r in files.glossary(spark, str(tmp_path / "g.txt")).collect()} == {"uno", "due"}
    lines = spark.createDataFrame([(1, "[A] ciao a tutti"), (2, "# nota"), (3, "come va"), (4, "[B] bene")], "n int, l string")
    assert [(r["speaker"], r["word"]) for r in files.annotated_reference(lines, "n", "l").orderBy("n", "pos").collect()][3:] == [("A", "come"), ("A", "va"), ("B", "bene")]
    files.write_partitioned(spark.createDataFrame([("s1", 1), ("s2", 1)], "stem string, v int"), str(tmp_path / "t"), ["stem"])
    files.write_partitioned(spark.createDataFrame([("s1", 2)], "stem string, v int"), str(tmp_path / "t"), ["stem"])
    assert {(r["stem"], r["v"]) for r in spark.read.parquet(str(tmp_path / "t")).collect()} == {("s1", 2), ("s2", 1)}


def test_parts_and_blocks(spark):
    rows = [(1, "s", 0, "A", "uno due"), (2, "s", 1, "A", "tre"), (3, "s", 1, "A", "tre"), (4, "s", 2, "B", None), (5, "s", 3, None, "")]
    df = spark.createDataFrame(rows, "segment_id long, stem string, idx int, speaker string, text string")
    assert [(r["speaker"], r["text"]) for r in corpus.speaker_blocks(df).orderBy("block").collect()] == [("A", "uno due tre"), ("B", None), (None, "")]
    assert [(r["part"], r["words"]) for r in corpus.llm_parts(df, 2).orderBy("part").collect()] == [(0, 2), (1, 1)]
    assert corpus.bigrams(df.limit(0)).count() == 0


def test_weak_clusters():
    unit = lambda *x: np.array(x, float) / np.linalg.norm(x)
    many = {f"c{i:02d}": unit(1, 0.001 * i) for i in range(60)}
    heirs = identity.absorb_weak(sorted(many), {k: 1.0 + (k == "c00") * 500 for k in many}, dict(many), 90.0, 0.45)
    assert set(heirs.values()) == {"c00"}  # no bound on the number of merges
    names, vectors = ["a", "b", "c"], {"a": unit(1, 0), "b": unit(1, 0.1), "c": unit(0, 1)}
    assert identity.absorb_weak(names, {"a": 80.0, "b": 10.0, "c": 5.0}, dict(vectors), 90.0, 0.45) == {"a": "a", "b": "a", "c": "c"}
    assert identity.absorb_weak(names, {"a": 500.0, "b": 400.0, "c": 300.0}, dict(vectors), 90.0, 0.45) == {k: k for k in names}
    assert identity.absorb_weak(["a", "b"], {"a": 1.0, "b": 2.0}, {"a": None, "b": unit(1, 0)}, 90.0, 0.45) == {"a": "a", "b": "b"}


def test_packing(spark):
    rows = [("s", 0.0, 10.0), ("s", 10.0, 29.0), ("s", 29.0, 30.0), ("s", 31.0, 99.0), ("s", 100.0, 101.0), ("s", None, 5.0), ("t", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "stem string, start_sec double, end_sec double")
    got = sorted((r["stem"], r["chunk"], r["first_start"], r["last_end"]) for r in corpus.pack_by_time(df, 29.0).collect())
    assert got == [("s", 0, 0.0, 29.0), ("s", 1, 29.0, 30.0), ("s", 2, 31.0, 60.0), ("s", 3, 60.0, 89.0), ("s", 4, 89.0, 99.0), ("s", 5, 100.0, 101.0), ("t", 0, 1.0, 1.0)]
    assert corpus.pack_by_time(df.limit(0), 29.0).count() == 0


def test_latest_wins(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", None, "z")], "k string, t int, v string")
    assert {(r["k"], r["v"]) for r in publish.latest_wins(df, ["k"], [F.col("t").desc_nulls_last()]).collect()} == {("a", "y"), ("b", "z")}
    names = spark.createDataFrame([("Mario",), (None,), ("mario",)], "name string")
    texts = spark.createDataFrame([(1, "Ieri Mario"), (2, None), (3, "amarioso")], "k int, t string")
    assert [tuple(r) for r in publish.names_in_texts(texts, "k", "t", names, "name").collect()] == [(1, "mario")]
