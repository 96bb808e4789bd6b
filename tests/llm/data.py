"""Small awkward tables: NULLs, empty and long texts, ties, repeated rows, clashing names."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng, n, vocabulary=900):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def documents(seed=1):
    rng = random.Random(seed)
    shared = sentence(rng, 80)
    base = sentence(rng, 120).split()
    rows = [
        (1, None, "en", "b", 0),
        (2, "", "en", None, 0),
        (3, " \t\n ", None, "a", 4),
        (4, "one", "en", "a", 3),
        (5, "One two\tthree  four", "en", "a", 18),
        (6, "one two three four", "en", "b", 18),
        (None, "no id " + sentence(rng, 50), "en", "b", 0),
        (7, sentence(rng, 40) + " " + shared, "en", "c", 0),
        (8, shared + "\n" + sentence(rng, 60), "en", "c", 0),
        (9, sentence(rng, 30) + " " + shared + " " + sentence(rng, 30), None, None, 0),
        (10, "la " * 100, "en", "b", 0),
        (11, sentence(rng, 20000), "en", "d", 0),
        (12, " ".join(base), "en", "a", 0),
        (13, " ".join(base), "en", "b", 0),
        (13, " ".join(base), "en", "b", 0),
        (14, " ".join([*base[:60], "new", *base[61:]]), "en", "b", 0),
        (15, " ".join([*base[:118], "x", "y"]), "fr", "b", 0),
        (16, "é ü <|im_end|> <\\|x ␣ \x0b ö", "fr", "c", 0),
        (16, "same id " + sentence(rng, 40), "fr", "c", 0),
    ]
    return rows + [(100 + i, sentence(rng, rng.randrange(1, 90)), "en", f"s{i % 3}", 0) for i in range(40)]


def words(text):
    return WORD.findall(text or "")
