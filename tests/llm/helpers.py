"""Tables and plain reference versions for the tests of the text operators."""

import random
import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def spaced(text):
    return SPACED.findall(text or "")


def plain(text):
    return PLAIN.findall(lower(text))


def documents(spark, texts, first=0, **more):
    """documents with ids from `first`, and the given extra columns, each of one value."""
    rows = [(first + i, t, "en", "src", len(t or ""), *more.values()) for i, t in enumerate(texts)]
    names = ["doc_id long", "text string", "lang string", "source string", "n_chars long"]
    return spark.createDataFrame(rows, ", ".join(names + [f"{k} string" for k in more]))


def words(rnd, n, letters="abcdefgh", size=3):
    return ["".join(rnd.choice(letters) for _ in range(size)) for _ in range(n)]


def corpus(seed, n=60, length=40):
    """Texts with exact and near copies, shared passages, empty, null and odd ones."""
    rnd = random.Random(seed)
    texts = [" ".join(words(rnd, rnd.randrange(1, length))) for _ in range(n)]
    shared = " ".join(words(rnd, 20))
    for i in range(0, n, 5):
        texts.append(texts[i])
        edited = texts[i].split()
        edited[rnd.randrange(len(edited))] = "new"
        texts.append(" ".join(edited))
        texts.append(f"{texts[i]}\n{shared} {texts[i - 1]}")
    return [*texts, None, "", "  \n", "a", "A\tb", "é ß  x", "x" * 5000]
