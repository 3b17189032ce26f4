"""Small documents for the tests, with every odd case."""

from __future__ import annotations

import random

SYLLABLES = {
    "en": "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split(),
    "de": "sch ich ein ung ver ber gen ach heit keit lich zu ge be tz pf ö ü ä ß".split(),
    "fr": "eau oi ou ment tion que elle ier aux tre ch è é ç ê pa vi ré".split(),
    "es": "ción mente ado ez ar os ll rr ñ í ó que ga mi bo ja cie".split(),
}


def prose(rng: random.Random, lang: str, words: int) -> str:
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(words))


def documents(seed: int = 1, each: int = 12, words: int = 60) -> list[tuple]:
    """(doc_id, text, lang, source, n_chars) in four languages."""
    rng = random.Random(seed)
    rows = []
    for k in range(each * 4):
        lang = ("en", "de", "fr", "es")[k % 4]
        text = prose(rng, lang, rng.randint(words // 2, words))
        rows.append((k, text, lang, "s", len(text)))
    return rows


COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ODD = [
    (900, None, "en", None, None), (901, "", None, "s", 0), (902, " \t\n", "de", "s", 3), (903, "1234 --", "en", "s", 7),
    (904, "x", "en", "s", 1), (None, "no id here", "en", "s", 10), (905, "twice the same", "en", "s", 14),
    (905, "twice the same", "en", "s", 14),
]


def frame(spark, rows: list[tuple], columns: str = COLUMNS):
    return spark.createDataFrame(rows, columns)
