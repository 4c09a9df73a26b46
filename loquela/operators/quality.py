"""Rule-based quality of transcribed segments: each rule has its own level, the worst one counts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from loquela.functions.text import words_letters


@dataclass(frozen=True)
class Thresholds:
    """Fixed values of the rules."""

    min_words: int = 3
    low_prob: float = 0.35
    low_share: float = 0.25
    no_speech: float = 0.60
    ngram: int = 3
    times: int = 4
    slowest: float = 0.3
    fastest: float = 6.0
    invented_seconds: float = 5.0
    invented_prob: float = 0.75


#: Texts a recogniser invents on silence: always, if long or unsure, and pieces of its own prompt.
INVENTED = r"(?i)^(grazie per la visione|grazie per l'attenzione|sottotitoli\b.*|sottotitolato\b.*|a cura di qtss.*|amara\.org.*)[.!]*$"
INVENTED_IF_LONG = r"(?i)^(grazie( a tutti| mille| ancora)?|ciao a tutti|buona visione)[.!]*$"
PROMPT = r"(?i)frasi brevi, punteggiatura completa|mai unire due frasi in una|trascrizione di una conversazione in italiano parlato|interlocutori diversi e sovrapposizioni di voce"


def ngram_loop(words: Column, n: int, times: int) -> Column:
    """True if some run of n words occurs `times` times or more (overlaps count)."""
    n_words = F.greatest(F.size(words), F.lit(1))
    grams = words
    for k in range(2, n + 1):  # joined slices, so that no lambda holds the whole array
        grams = F.zip_with(grams, F.slice(words, k, n_words), lambda a, b: F.concat(a, F.lit(" "), b))
    ordered = F.array_sort(F.filter(grams, lambda g: g.isNotNull()))
    pairs = F.zip_with(ordered, F.slice(ordered, times, n_words), lambda a, b: F.coalesce(a == b, F.lit(False)))
    return F.exists(pairs, lambda x: x)


def reasons(text: Column, seconds: Column, no_speech: Column, probs: Column, t: Thresholds = Thresholds()) -> Column:
    """The reasons against a segment, in the order of the rules; numbers follow a colon."""
    words = words_letters(F.coalesce(text, F.lit("")))
    n = F.size(words)
    rate = n / seconds
    known = F.filter(probs, lambda p: p.isNotNull())
    low = F.size(F.filter(known, lambda p: p < t.low_prob)) / F.size(known)
    mean = F.aggregate(known, F.lit(0.0), lambda a, p: a + p) / F.size(known)
    some = F.size(known) > 0
    said = F.trim(F.coalesce(text, F.lit("")))
    doubtful = (seconds >= t.invented_seconds) | (some & (mean < t.invented_prob))
    shown = lambda x, digits: F.round(x, digits).cast("string")
    return F.array_compact(
        F.array(
            F.when(n == 0, "testo_vuoto"),
            F.when((n > 0) & (n < t.min_words), F.concat(F.lit("pochi_parole:"), n.cast("string"))),
            F.when(said.rlike(PROMPT), "prompt_nel_testo").when(said.rlike(INVENTED) | (said.rlike(INVENTED_IF_LONG) & F.coalesce(doubtful, F.lit(False))), "allucinazione_tipica"),
            F.when(no_speech >= t.no_speech, F.concat(F.lit("no_speech:"), shown(no_speech, 2))),
            F.when(ngram_loop(words, t.ngram, t.times), f"ripetizione_n{t.ngram}"),
            F.when((n > 0) & (seconds > 0) & ((rate < t.slowest) | (rate > t.fastest)), F.concat(F.lit("ritmo_fuori_scala:"), shown(rate, 1), F.lit("wps"))),
            F.when(some & (mean < t.low_prob), F.concat(F.lit("prob_parole_bassa:"), shown(mean, 2))),
            F.when(some & (low >= t.low_share), F.concat(F.lit("troppe_parole_insicure:"), F.round(low * 100).cast("int").cast("string"), F.lit("%"))),
        )
    )


def level(found: Column) -> Column:
    """'unreliable' if a hard reason is there, 'low' if a soft one is, else 'ok'."""
    soft = F.forall(found, lambda r: r.rlike("^(pochi_parole|prob_parole_bassa|troppe_parole_insicure):"))
    return F.when(F.size(found) == 0, "ok").when(soft, "low").otherwise("unreliable")
